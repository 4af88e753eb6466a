"""Personal data: exact patterns first, then a skip-chain conditional random field.

Nodes are the tokens that hold a digit or an at sign; all other tokens can't be personal data here and act as
fixed neighbours without a label. Each node has a unary potential by its shape, adjacent tokens share a chain potential, and
repeated or similar tokens of a document (same text, same digits, the same name before an at sign) share a skip
potential, however far apart they are. Tokens inside a pattern's match are fixed to its kind. Loopy
belief propagation runs for all documents of a slice at once; a free token whose belief in one kind
is high becomes a further span.

Potentials are trained piecewise: each factor's table is the smoothed relative frequency of its labels in the
corpus, with the pattern matches as labels, counted over all documents. The skip table counts agreement on pairs of
matched tokens only, as patterns can't see the rest. Chain potentials are bounded, so a token needs a distant twin
to become a span.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tallyhouse.llm.words import slices

KINDS = ["email", "ip", "card", "phone"]
LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
EVIDENCE = re.compile(r"[0-9@]")
SPACES = frozenset(" \t\n\v\f\r")
EDGES = ".,;:!?()[]{}<>\"'"
SHAPES = 16
ROUNDS = 12
BELIEF = 0.9


def luhn(digits: str) -> bool:
    total = sum(map(int, digits[-1::-2])) + sum(sum(divmod(2 * int(d), 10)) for d in digits[-2::-2])
    return total % 10 == 0


def emails(text: str) -> Iterator[tuple[int, int]]:
    """Matches of the email pattern; every character before an at sign is looked at once."""
    last = 0
    at = text.find("@")
    while at >= 0:
        a = at
        while a > last and text[a - 1] in LOCAL:
            a -= 1
        m = DOMAIN.match(text, at + 1) if a < at else None
        if m:
            yield a, m.end()
            last = m.end()
        at = text.find("@", max(at + 1, last))


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind, end) of all pattern matches that pass their check, in order; a match that fails is dropped, not retried."""
    out = [(a, 0, b) for a, b in emails(text)]
    if not re.search("[0-9]", text):
        return sorted(out)
    out += [(m.start(), 1, m.end()) for m in IP.finditer(text) if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in m[0].split("."))]
    for m in CARD.finditer(text):
        if 14 <= len(m[0]):
            digits = m[0].replace(" ", "").replace("-", "")
            if 14 <= len(digits) <= 19 and luhn(digits):
                out.append((m.start(), 2, m.end()))
    if "+" in text:
        out += [(m.start(), 3, m.end()) for m in PHONE.finditer(text) if 10 <= sum(c.isdigit() for c in m[0]) <= 15]
    return sorted(out)


def tokens(text: str) -> list[tuple[int, int]]:
    """Tokens with a digit or an at sign, without marks at their edges."""
    out, end = [], 0
    for m in EVIDENCE.finditer(text):
        if m.start() < end:
            continue
        a, end = m.start(), m.start()
        while a > 0 and text[a - 1] not in SPACES:
            a -= 1
        while end < len(text) and text[end] not in SPACES:
            end += 1
        b = end
        while text[a] in EDGES and a < b - 1:
            a += 1
        while text[b - 1] in EDGES and b > a + 1:
            b -= 1
        out.append((a, b))
    return out


def shape(token: str) -> int:
    """Class of a token: at sign, plus, dotted numbers, or how many digits it has and whether letters stand among them."""
    digits = sum(c.isdigit() for c in token)
    if "@" in token:
        return 0 if "." in token.partition("@")[2] else 1
    if token[0] == "+":
        return 2 if digits >= 10 else 3
    if any(c.isalpha() for c in token):
        return 4 if "." in token or "_" in token else 5
    if token.count(".") == 3 and digits <= 12:
        return 6
    return next(k for k, most in zip(range(7, 15), (2, 4, 6, 9, 13, 15, 16, 10**9), strict=True) if digits <= most)


def similar(token: str) -> set[str]:
    """Keys under which tokens count as repeated or similar."""
    low = token.lower()
    keys = {low}
    digits = "".join(c for c in token if c.isdigit())
    if len(digits) >= 9:
        keys.add(f"#{digits}")
    if "@" in low:
        keys.add(low.partition("@")[0])
    return {k for k in keys if len(k) >= 4}


class Graph:
    """Nodes and edges of the documents of one slice."""

    def __init__(self):
        self.shape, self.label, self.doc, self.span, self.chain, self.skip, self.alone = [], [], [], [], [], [], []

    def add(self, doc: int, text: str, base: list[tuple[int, int, int]]) -> None:
        last: dict[str, int] = {}
        before, k, reach = None, 0, 0
        starts = sorted(base)
        for a, b in tokens(text):
            node = len(self.shape)
            # spans that reach over the token; base spans of one kind don't overlap, so few are open at a time
            while k < len(starts) and starts[k][0] < b:
                k += 1
            over = [s for s in starts[max(0, k - 8) : k] if s[2] > a]
            self.shape.append(shape(text[a:b]))
            self.label.append(over[0][1] + 1 if over else 0)
            self.doc.append(doc)
            self.span.append((a, b, bool(over)))
            joined = before is not None and a - reach <= 8 and not text[reach:a].strip(EDGES + " \t\n\v\f\r")
            if joined:
                self.chain.append((before, node))
            self.alone.append((not joined) and a > 0)
            for key in similar(text[a:b]):
                if key in last:
                    self.skip.append((last[key], node))
                last[key] = node
            before, reach = node, b


def infer(graph: Graph, unary: np.ndarray, chain: np.ndarray, skip: np.ndarray) -> np.ndarray:
    """Beliefs of all nodes by damped sum-product messages; matched nodes are fixed to their kind."""
    n, k = len(graph.shape), len(KINDS) + 1
    label, fixed = np.array(graph.label, np.int64), np.array([s[2] for s in graph.span], bool)
    own = unary[np.array(graph.shape, np.int64)] * np.where(np.array(graph.alone, bool)[:, None], chain[0], 1.0)
    own[fixed] = 1e-9
    own[fixed, label[fixed]] = 1.0
    edges = np.array(graph.chain + graph.skip, np.int64).reshape(-1, 2)
    kind = np.repeat([0, 1], [len(graph.chain), len(graph.skip)])
    source, target = np.concatenate([edges[:, 0], edges[:, 1]]), np.concatenate([edges[:, 1], edges[:, 0]])
    table = np.stack([chain, skip])
    factor = np.concatenate([table[kind], table[kind].transpose(0, 2, 1)])  # [edge, source label, target label]
    message, back = np.full((len(source), k), 1.0 / k), np.concatenate([np.arange(len(edges)) + len(edges), np.arange(len(edges))])
    belief = own
    for _ in range(ROUNDS):
        total = np.zeros((n, k))
        np.add.at(total, target, np.log(message))
        belief = np.log(own) + total
        out = np.exp((cavity := belief[source] - np.log(message[back])) - cavity.max(1, keepdims=True))
        new = np.einsum("es,est->et", out, factor) + 1e-12
        new /= new.sum(1, keepdims=True)
        done = len(new) == 0 or np.abs(new - message).max() < 1e-4
        message = 0.5 * message + 0.5 * new
        if done:
            break
    belief = np.exp(belief - belief.max(1, keepdims=True)) if n else np.zeros((0, k))
    return belief / belief.sum(1, keepdims=True) if n else belief


def train(docs: DataFrame, text: str = "text") -> dict:
    """The three tables, from counts over all documents; at most ``16 * 5 + 50`` rows come back."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        k = len(KINDS) + 1
        unary, chain, skip = np.zeros((SHAPES, k), np.int64), np.zeros((k, k), np.int64), np.zeros((k, k), np.int64)
        for batch in batches:
            for a, b in slices(batch.column(0)):
                graph = Graph()
                for i, t in enumerate(batch.column(0).slice(a, b - a).to_pylist()):
                    if t and EVIDENCE.search(t):
                        graph.add(i, t, base_spans(t))
                label = np.array(graph.label, np.int64)
                np.add.at(unary, (np.array(graph.shape, np.int64), label), 1)
                for table, edges in ((chain, graph.chain), (skip, graph.skip)):
                    e = np.array(edges, np.int64).reshape(-1, 2)
                    np.add.at(table, (label[e[:, 0]], label[e[:, 1]]), 1)
                chain[0] += np.bincount(label[np.array(graph.alone, bool)], minlength=k)
        for name, table in (("unary", unary), ("chain", chain), ("skip", skip)):
            x, y = np.nonzero(table)
            yield pa.RecordBatch.from_pydict({"factor": pa.array([name] * len(x), pa.string()), "x": x, "y": y, "n": table[x, y]})

    rows = docs.select(F.col(f"`{text}`").alias("text")).mapInArrow(count, "factor string, x long, y long, n long").groupBy("factor", "x", "y").agg(F.sum("n").alias("n")).collect()
    k = len(KINDS) + 1
    tables = {"unary": np.full((SHAPES, k), 0.1), "chain": np.ones((k, k)), "skip": np.zeros((k, k))}
    for r in rows:
        tables[r.factor][r.x, r.y] += r.n
    # the patterns have seen a free token and let it pass, so its shape alone never speaks for a kind
    tables["unary"][:, 0] = np.maximum(tables["unary"][:, 0], tables["unary"][:, 1:].sum(1))
    unary = tables["unary"] / tables["unary"].sum(1, keepdims=True)
    # log-linear factors: the chain counts association only, as the unary already holds how common a label is
    chain = (tables["chain"] / tables["chain"].sum()) / np.maximum(1e-12, np.outer(tables["chain"].sum(1), tables["chain"].sum(0)) / tables["chain"].sum() ** 2)
    both = tables["skip"][1:, 1:]
    agree = (np.trace(both) + 1) / (both.sum() + 2)
    skip = np.full((k, k), (1 - agree) / len(KINDS))
    np.fill_diagonal(skip, agree)
    return {"unary": np.maximum(unary, 1e-4), "chain": np.clip(chain, 0.5, 2.0), "skip": np.maximum(skip, 1e-4)}


def find(docs: DataFrame, model: dict, text: str = "text", key: str = "doc_id") -> DataFrame:
    """One row per input row: key, ``base`` and ``added``, arrays of (kind, start, end) in code points, in order of start and kind.

    A null text is empty and has no spans. Repeated rows and keys give repeated rows.
    """
    unary, chain, skip = model["unary"], model["chain"], model["skip"]
    span = pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b in slices(batch.column(1)):
                graph, base, added = Graph(), [[] for _ in range(b - a)], [[] for _ in range(b - a)]
                for i, t in enumerate(batch.column(1).slice(a, b - a).to_pylist()):
                    if t and EVIDENCE.search(t):
                        base[i] = base_spans(t)
                        graph.add(i, t, base[i])
                if graph.skip or graph.chain or graph.shape:
                    belief = infer(graph, unary, chain, skip)
                    best = belief[:, 1:].argmax(1)
                    for node in np.flatnonzero(belief[:, 1:].max(1) >= BELIEF):
                        start, end, matched = graph.span[node]
                        if not matched:
                            added[graph.doc[node]].append((start, int(best[node]), end))
                rows = [pa.array([[{"kind": KINDS[k], "start": s, "end": e} for s, k, e in sorted(x)] for x in of], pa.list_(span)) for of in (base, added)]
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(a, b - a), *rows], names=["_key", "base", "added"])

    kind = docs.select(f"`{key}`").schema[0].dataType.simpleString()
    spans = "array<struct<kind:string,start:long,end:long>>"
    return docs.select(F.col(f"`{key}`").alias("_key"), F.col(f"`{text}`").alias("_text")).mapInArrow(run, f"_key {kind}, base {spans}, added {spans}").withColumnRenamed("_key", key)
