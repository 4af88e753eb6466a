"""Language by segmentation-marginalised unigrams.

The pieces of a fixed public vocabulary have a probability in each language: their relative frequency in the texts of
that language, counted over all learning rows, smoothed. A word's probability is the sum over all its
segmentations into pieces, found by the forward algorithm; single bytes may stand for themselves, so every word has one. Pieces never span
words, hence a text's likelihood is the product over its words and every distinct word is summed once a slice.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F

from tallyhouse.llm.words import slices, word_codes

BASE = np.uint64(0x9E3779B97F4A7C15)
SHORT = 32
SMOOTH = 0.5
FILTER = 1 << 20
SHIFT = np.uint64(44)
CACHE = 400_000
UNKNOWN = "und"


class Pieces:
    """The vocabulary as hashes of byte strings; a word starts with a blank."""

    def __init__(self, path: str):
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        n = self.model.get_piece_size()
        self.size = n + 256
        plain = {i: self.model.id_to_piece(i).replace("▁", " ").encode() for i in range(n) if not (self.model.is_control(i) or self.model.is_unknown(i) or self.model.is_byte(i))}
        self.bytes = {i: int(self.model.id_to_piece(i)[3:5], 16) for i in range(n) if self.model.is_byte(i)}
        rows = sorted((self.hash(b), i, len(b)) for i, b in plain.items() if b)
        self.hashes = np.array([r[0] for r in rows], np.uint64)
        self.ids = np.array([r[1] for r in rows], np.int64)
        self.longest = min(SHORT, max(r[2] for r in rows))
        self.some = np.zeros(FILTER, bool)
        self.some[(self.hashes >> SHIFT).astype(np.int64)] = True

    @staticmethod
    def hash(b: bytes) -> int:
        h = 0
        for x in b:
            h = (h * int(BASE) + x + 1) % (1 << 64)
        return h

    def find(self, h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Places whose hash is that of a piece, and the pieces."""
        at = np.flatnonzero(self.some[(h >> SHIFT).astype(np.int64)])
        k = np.minimum(np.searchsorted(self.hashes, h[at]), len(self.hashes) - 1)
        hit = self.hashes[k] == h[at]
        return at[hit], self.ids[k[hit]]


def log_forward(words: list[bytes], pieces: Pieces, table: np.ndarray) -> np.ndarray:
    """Log probability of each word in each language; ``table`` has a row per piece and byte, a column per language.

    Words of one length class are summed together, position by position. Each position is scaled, so words of any length keep
    their digits.
    """
    out = np.zeros((len(words), table.shape[1]))
    size = np.fromiter(map(len, words), np.int64, len(words)) + 1
    order = np.argsort(size, kind="stable")
    for group in np.split(order, np.flatnonzero(np.diff(np.ceil(np.log2(size[order])))) + 1) if len(words) else ():
        for part in np.array_split(group, max(1, int(size[group].sum()) // 1_000_000)):
            n, ends = int(size[part].max()), np.searchsorted(size[part], np.arange(int(size[part].max()) + 2))
            blob = np.frombuffer(b"".join(b" " + words[i] for i in part), np.uint8)
            text = np.zeros((n, len(part)), np.uint8)
            row = np.repeat(np.arange(len(part)), size[part])
            text[np.arange(len(blob)) - np.repeat(np.cumsum(size[part]) - size[part], size[part]), row] = blob
            span = pieces.longest + 1
            latest = np.zeros((span, len(part)), np.uint64)  # hashes of the latest substrings, by length
            alpha = np.ones((span, len(part), table.shape[1]))  # by position modulo
            scale = np.zeros((len(part), table.shape[1]))
            for e in range(1, n + 1):
                live = ends[e]  # shorter words are done
                byte, longest = text[e - 1, live:].astype(np.int64), min(e, pieces.longest)
                latest[1 : longest + 1, live:] = latest[:longest, live:] * BASE + (byte + 1).astype(np.uint64)
                here = alpha[(e - 1) % span, live:] * table[pieces.size - 256 + byte]
                for length in range(1, longest + 1):
                    at, piece = pieces.find(latest[length, live:])
                    if len(at):
                        here[at] += alpha[(e - length) % span, live:][at] * table[piece]
                alpha[e % span, live:] = here
                if e % 16 == 0:
                    alpha[:, live:] /= here
                    scale[live:] += np.log(here)
                done = ends[e + 1]
                out[part[live:done]] = np.log(alpha[e % span, live:done]) + scale[live:done]
    return out


def train(docs: DataFrame, vocabulary: str, text: str = "text", lang: str = "lang") -> dict:
    """Piece counts per language over all rows with a text and a language. ``vocabulary`` is a file on every worker.

    The result has one row per piece and language at most, a bound that the fixed vocabulary sets.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces, found, texts = None, {}, {}
        for batch in batches:
            pieces = pieces or Pieces(vocabulary)
            for a, b in slices(batch.column(0)):
                langs = batch.column(1).slice(a, b - a).dictionary_encode()
                codes, bounds, distinct = word_codes(batch.column(0).slice(a, b - a), lower=False)
                ids = pieces.model.encode([w.decode(errors="replace") for w in distinct.to_pylist()], num_threads=1)
                size = np.fromiter(map(len, ids), np.int64, len(ids))
                flat, of = np.fromiter((i for w in ids for i in w), np.int64, size.sum()), np.repeat(np.arange(len(ids)), size)
                of_doc = langs.indices.to_numpy(zero_copy_only=False)
                of_word = np.repeat(of_doc, np.diff(bounds))
                for k, name in enumerate(langs.dictionary.to_pylist()):
                    words = np.bincount(codes[of_word == k], minlength=len(ids))
                    found[name] = found.get(name, 0) + np.bincount(flat, words[of], pieces.size)
                    texts[name] = texts.get(name, 0) + int((of_doc == k).sum())
        for name, n in found.items():
            at = np.flatnonzero(n)
            yield pa.RecordBatch.from_pydict({"lang": [name] * (len(at) + 1), "piece": np.append(at, -1), "n": np.append(n[at], texts[name]).astype(np.int64)})

    learn = docs.where(F.col(f"`{text}`").isNotNull() & F.col(f"`{lang}`").isNotNull()).select(F.col(f"`{text}`").alias("text"), F.col(f"`{lang}`").alias("lang"))
    counts = learn.mapInArrow(count, "lang string, piece long, n long").groupBy("lang", "piece").agg(F.sum("n").alias("n")).toPandas()
    langs = sorted(counts.lang.unique())
    if not langs:
        return {"langs": [], "table": None, "prior": None}
    size = Pieces(vocabulary).size
    n, prior = np.full((size, len(langs)), SMOOTH), np.zeros(len(langs))
    column = counts.lang.map({x: i for i, x in enumerate(langs)}).to_numpy()
    piece = counts.piece.to_numpy()
    n[piece[piece >= 0], column[piece >= 0]] += counts.n.to_numpy()[piece >= 0]
    prior[column[piece < 0]] = counts.n.to_numpy()[piece < 0]
    return {"langs": langs, "table": n / n.sum(0), "prior": np.log(prior / prior.sum())}


def predict(docs: DataFrame, model: dict, vocabulary: str, text: str = "text", key: str = "doc_id") -> DataFrame:
    """Key, ``lang_pred`` and ``score`` of every row.

    A null text, a text without a letter and every text under a model without languages is ``und`` with score 0. The score is the posterior
    probability of the language; ties go to the first name in order.
    """
    langs, table, prior = model["langs"], model["table"], model["prior"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces, old, young = None, {}, {}
        for batch in batches:
            for a, b in slices(batch.column(1)):
                texts = batch.column(1).slice(a, b - a)
                letters = pc.fill_null(pc.match_substring_regex(texts, r"\pL"), False).to_numpy(zero_copy_only=False)
                if not langs or not letters.any():
                    yield pa.RecordBatch.from_arrays([batch.column(0).slice(a, b - a), pa.array([UNKNOWN] * (b - a)), pa.array(np.zeros(b - a))], names=["_key", "lang_pred", "score"])
                    continue
                pieces = pieces or Pieces(vocabulary)
                codes, bounds, distinct = word_codes(texts, lower=False)
                words = distinct.to_pylist()
                if len(young) > CACHE:
                    old, young = young, {}
                new = []
                for w in words:
                    if w not in young:
                        if w in old:
                            young[w] = old[w]
                        else:
                            new.append(w)
                young.update(zip(new, log_forward(new, pieces, table), strict=True))
                value = np.array([young[w] for w in words]).reshape(len(words), len(langs))
                total = np.stack([np.bincount(np.repeat(np.arange(b - a), np.diff(bounds)), value[codes, k], b - a) for k in range(len(langs))], 1) + prior
                total -= total.max(1, keepdims=True)
                best = total.argmax(1)
                score = np.where(letters, 1 / np.exp(total).sum(1), 0.0)
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(a, b - a), pa.array([langs[k] if ok else UNKNOWN for k, ok in zip(best, letters, strict=True)]), pa.array(score)], names=["_key", "lang_pred", "score"])

    kind = docs.select(f"`{key}`").schema[0].dataType.simpleString()
    return docs.select(F.col(f"`{key}`").alias("_key"), F.col(f"`{text}`").alias("_text")).mapInArrow(run, f"_key {kind}, lang_pred string, score double").withColumnRenamed("_key", key)
