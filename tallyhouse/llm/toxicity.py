"""Toxicity by a counterfactual-regularised linear classifier.

Features are the hashed five- and six-byte pieces of a text's distinct words, edges included, so inflected
and invented words count too. Which features matter is decided on all labelled rows: one aggregation counts, for every feature, the toxic and
other texts that hold it. A logistic regression over the ``FEATURES`` most telling ones is then fitted on
``SAMPLE`` labelled rows in expectation. The loss adds ``weight * (score(x) - score(x'))**2`` for
the counterfactual x' of each text that names a group: every identity term is swapped with another of its kind. That draws
the weights of identity terms together, and by the prior towards zero.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, functions as F

from tallyhouse.llm.bloom import possible
from tallyhouse.llm.words import lean, mix, over_rows, slices, word_codes

BUCKETS = 1 << 18
FEATURES = 2048
SAMPLE = 20_000
#: Bytes of text at once: a text has several pieces a word, each held as numbers in several arrays.
SLICE = 1 << 20
THRESHOLD = 0.7
#: Interchangeable group names, in rows of one kind. Fixed values.
IDENTITY = [
    ("women", "men"), ("woman", "man"), ("girls", "boys"), ("muslims", "christians", "jews", "hindus", "buddhists", "atheists"), ("muslim", "christian", "jewish", "hindu", "buddhist", "atheist"),
    ("black", "white", "asian", "latino"), ("gay", "straight", "lesbian", "bisexual"), ("disabled", "deaf", "blind"), ("immigrants", "refugees", "natives"), ("old", "young"),
]
SWAP = {a: row[(i + 1) % len(row)] for row in IDENTITY for i, a in enumerate(row)}
LENGTHS = (5, 6)
EDGE = 60
PLAIN = np.full(256, EDGE, np.uint8)
PLAIN[[*range(48, 58), *range(97, 123), *range(128, 256)]] = [*range(48, 58), *range(97, 123), *range(128, 256)]


def pieces(words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(word, bucket) of all pieces of the words; a word is framed by edges, and marks inside it are edges too."""
    size = pc.binary_length(words).to_numpy(zero_copy_only=False).astype(np.int64)
    data = np.full(int((size + 2).sum()), EDGE, np.uint8)
    end = np.cumsum(size + 2)
    solid = np.ones(len(data), bool)
    solid[end - 1] = solid[end - size - 2] = False
    data[solid] = PLAIN[np.frombuffer(b"".join(words.to_pylist()), np.uint8)]
    owner = np.repeat(np.arange(len(words)), size + 2)
    of, bucket = [], []
    for n in LENGTHS:
        if len(data) < n:
            continue
        inside = owner[: len(data) - n + 1] == owner[n - 1 :]
        h = np.full(len(inside), n, np.uint64)
        for k in range(n):
            h = h * np.uint64(0x9E3779B97F4A7C15) + data[k : len(data) - n + 1 + k]
        of.append(owner[: len(inside)][inside])
        bucket.append((mix(h[inside]) % np.uint64(BUCKETS)).astype(np.int64))
    return np.concatenate([*of, np.zeros(0, np.int64)]), np.concatenate([*bucket, np.zeros(0, np.int64)])


def distinct(rows: np.ndarray, columns: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """(row, column) without repeats, in order."""
    pair = np.sort(rows * max(1, size) + columns)
    pair = pair[np.diff(pair, prepend=-1) > 0]
    return pair // max(1, size), pair % max(1, size)


def present(texts: pa.Array, place: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(row, feature) of the features that a text holds; ``place`` has a bucket's feature or -1."""
    codes, bounds, words = word_codes(texts)
    of, bucket = pieces(words)
    kept = place[bucket] >= 0
    of, bucket = of[kept], bucket[kept]
    order = np.argsort(of, kind="stable")
    feature, size = place[bucket[order]], np.bincount(of, minlength=len(words))
    rows = np.repeat(np.arange(len(texts)), np.diff(bounds))
    live = size[codes] > 0
    rows, codes = distinct(rows[live], codes[live], len(words))
    each, begin = size[codes], np.cumsum(size) - size
    ends = np.cumsum(each)
    return distinct(np.repeat(rows, each), feature[np.repeat(begin[codes] - ends + each, each) + np.arange(ends[-1] if len(ends) else 0)], BUCKETS)


def places(buckets: np.ndarray) -> np.ndarray:
    out = np.full(BUCKETS, -1, np.int64)
    out[buckets] = np.arange(len(buckets))
    return out


def swapped(text: str) -> str | None:
    """The text with every identity term replaced by the next of its kind; None if it has none."""
    if not any(w.lower() in SWAP for w in re.findall(r"\w+", text)):
        return None
    return re.sub(r"\w+", lambda m: SWAP.get(m[0].lower(), m[0]), text)


def labelled(docs: DataFrame, labels: DataFrame, share: float | None = None, text: str = "text", key: str = "doc_id") -> DataFrame:
    """Rows (key, text, toxic) of the documents labelled 0 or 1; a repeated label counts once.

    Only texts that pass a filter of bounded size over the labelled keys are moved to the join, however many documents have none.
    With ``share``, only the labels drawn by a hash of the key take part. If they are counted to be at most twice ``SAMPLE``, which
    only labels without documents can exceed, they go to the texts instead.
    """
    wanted = labels.where("toxic IN (0, 1)").select(F.col(f"`{key}`").alias(key), "toxic")
    texts = docs.select(F.col(f"`{key}`").alias(key), F.col(f"`{text}`").alias("text"))
    wanted = wanted.distinct() if share is None else wanted.where(_drawn(F.xxhash64(key), share)).distinct()
    if share is not None and wanted.count() <= 2 * SAMPLE:
        return texts.join(F.broadcast(wanted), key)
    return possible(texts, wanted.select(key), key).join(wanted, key)


def _drawn(at: Column, share: float) -> Column:
    return F.pmod(at, F.lit(1 << 30)) < int(min(1.0, share) * (1 << 30))


def train(labelled: DataFrame, weight: float = 1.0, prior: float = 0.05, rounds: int = 300, key: str = "doc_id", draw: Callable[[float], DataFrame] | None = None) -> dict:
    """Fit on rows (key, text, toxic); toxic is 0 or 1, rows with other labels and null texts do nothing.

    The key only decides by hash which rows are drawn, so a run that is repeated, whole or in part, draws the same. ``draw`` gives the
    rows drawn for a share, if there is a cheaper way than a filter on ``labelled``.

    Without rows of both labels the model gives every text the share of toxic rows (0 if there are none).
    """
    def real(rows: DataFrame) -> DataFrame:
        at = F.xxhash64(f"`{key}`" if key in rows.columns else "text")
        return rows.where("toxic IN (0, 1) AND text IS NOT NULL").select("text", F.col("toxic").cast("long").alias("toxic"), at.alias("at"))

    rows = real(labelled)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found, place = np.zeros((2, BUCKETS + 1), np.int64), np.arange(BUCKETS)
        for batch in batches:
            for a, b in slices(batch.column(0), SLICE):
                label = batch.column(1).slice(a, b - a).to_numpy(zero_copy_only=False)
                row, bucket = present(batch.column(0).slice(a, b - a), place)
                found[:, :BUCKETS] += np.bincount(bucket + BUCKETS * label[row], minlength=2 * BUCKETS).reshape(2, -1)
                found[:, BUCKETS] += np.bincount(label, minlength=2)
        at = np.flatnonzero(found.sum(0) > 0)
        yield pa.RecordBatch.from_pydict({"bucket": at.astype(np.int64), "clean": found[0, at], "toxic": found[1, at]})

    counts = rows.select("text", "toxic").mapInArrow(lean(count), "bucket long, clean long, toxic long").groupBy("bucket").agg(F.sum("clean").alias("clean"), F.sum("toxic").alias("toxic")).toPandas()  # at most BUCKETS rows
    total = counts[counts.bucket == BUCKETS]
    clean, toxic = (int(total.clean.iloc[0]), int(total.toxic.iloc[0])) if len(total) else (0, 0)
    base = toxic / max(1, clean + toxic)
    if not clean or not toxic:
        return {"buckets": np.zeros(0, np.int64), "weights": np.zeros(0), "bias": 40.0 if base == 1 else -40.0}
    counts = counts[counts.bucket != BUCKETS].sort_values("bucket")
    p, q = (counts.toxic.to_numpy() + 0.5) / (toxic + 1), (counts.clean.to_numpy() + 0.5) / (clean + 1)
    # surprise of the label given the feature, for either label: binomial deviance
    n, y = (counts.toxic + counts.clean).to_numpy(), counts.toxic.to_numpy()
    part = np.clip((y + base) / (n + 1), 1e-9, 1 - 1e-9)
    gain = n * (part * np.log(part / base) + (1 - part) * np.log((1 - part) / (1 - base))) * np.where(p > q, 1.0, 0.25)
    best = np.argsort(-gain, kind="stable")[:FEATURES]
    best = best[gain[best] > np.log(BUCKETS)]  # more than the best of so many features would show by chance
    buckets = np.sort(counts.bucket.to_numpy()[best])

    def features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place = places(buckets)
        for batch in batches:
            for a, b in slices(batch.column(0), SLICE):
                texts = batch.column(0).slice(a, b - a)
                other = [swapped(t) for t in texts.to_pylist()]
                (r, f), (s, g) = present(texts, place), present(pa.array(other, pa.string()), place)
                cut, cut2 = np.searchsorted(r, np.arange(b - a + 1)), np.searchsorted(s, np.arange(b - a + 1))
                yield pa.RecordBatch.from_arrays([pa.array([f[cut[i] : cut[i + 1]] for i in range(b - a)], pa.list_(pa.int64())), pa.array([None if other[i] is None else g[cut2[i] : cut2[i + 1]] for i in range(b - a)], pa.list_(pa.int64())), batch.column(1).slice(a, b - a), batch.column(2).slice(a, b - a)], names=["own", "other", "toxic", "at"])

    # SAMPLE rows in expectation, whatever the table's size; copies of a text are drawn one by one
    share = SAMPLE / (clean + toxic)
    drawn = real(draw(share)) if draw else rows.where(_drawn(F.col("at"), share))
    got = drawn.mapInArrow(lean(features), "own array<long>, other array<long>, toxic long, at long").toPandas().sort_values("at", kind="stable")
    weights, bias = fit(list(got.own), list(got.other), got.toxic.to_numpy(float), len(buckets), weight, prior, rounds)
    return {"buckets": buckets, "weights": weights, "bias": bias}


def fit(own: list, other: list, y: np.ndarray, size: int, weight: float, prior: float, rounds: int) -> tuple[np.ndarray, float]:
    """Logistic regression by accelerated gradient steps, from the share of toxic rows as first bias."""

    def stack(lists):
        n = np.array([0 if x is None else len(x) for x in lists])
        return np.repeat(np.arange(len(lists)), n), np.concatenate([*[np.asarray(x, np.int64) for x in lists if x is not None], np.zeros(0, np.int64)])

    (r, f), (s, g) = stack(own), stack(other)
    has = np.array([x is not None for x in other])
    n, each = len(y), np.full(len(y), 1 / max(1, len(y)))
    score = lambda w, b, rows, cols: b + np.bincount(rows, w[cols], n)
    sigmoid = lambda z: 1 / (1 + np.exp(-np.clip(z, -40, 40)))
    share = min(max(y.mean(), 1e-3), 1 - 1e-3) if n else 0.5
    w, b, v, vb = np.zeros(size), np.log(share / (1 - share)), np.zeros(size), 0.0
    width = np.bincount(r, minlength=n) + np.bincount(s, minlength=n) + 1
    step = 4 / ((1 + 4 * weight * has.any()) * (each * width).sum() + prior)
    for t in range(rounds):
        aw, ab = w + v * t / (t + 3), b + vb * t / (t + 3)
        z = score(aw, ab, r, f)
        p = sigmoid(z)
        d, e = each * (p - y), np.zeros(n)
        if has.any():
            q = sigmoid(score(aw, ab, s, g))
            gap = np.where(has, p - q, 0) * 2 * weight * each
            d, e = d + gap * p * (1 - p), -gap * q * (1 - q)
        grad = np.bincount(f, d[r], size) + np.bincount(g, e[s], size) + prior / max(1, size) * aw
        nw, nb = aw - step * grad, ab - step * (d.sum() + e.sum())
        v, vb, w, b = nw - w, nb - b, nw, nb
    return w, float(b)


def scored(docs: DataFrame, model: dict, text: str = "text", key: str = "doc_id") -> DataFrame:
    """Key and ``score`` of every row; a null or empty text has the score of a text without features."""
    w, bias, buckets = model["weights"], model["bias"], model["buckets"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place = places(buckets)
        for batch in batches:
            for a, b in slices(batch.column(1), SLICE):
                row, feature = present(batch.column(1).slice(a, b - a), place)
                z = bias + (np.bincount(row, w[feature], b - a) if len(row) else np.zeros(b - a))
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(a, b - a), pa.array(1 / (1 + np.exp(-np.clip(z, -40, 40))))], names=["_key", "score"])

    kind = docs.select(f"`{key}`").schema[0].dataType.simpleString()
    return docs.select(F.col(f"`{key}`").alias("_key"), F.col(f"`{text}`").alias("_text")).mapInArrow(lean(run), f"_key {kind}, score double").withColumnRenamed("_key", key)


def clean(docs: DataFrame, model: dict, threshold: float = THRESHOLD, text: str = "text") -> DataFrame:
    """The rows whose score is below the threshold, with all their columns; nothing is shuffled."""
    w, bias, buckets = model["weights"], model["bias"], model["buckets"]
    at = docs.columns.index(text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place = places(buckets)
        for batch in batches:
            for a, b in slices(batch.column(at), SLICE):
                row, feature = present(batch.column(at).slice(a, b - a), place)
                z = bias + (np.bincount(row, w[feature], b - a) if len(row) else np.zeros(b - a))
                yield batch.slice(a, b - a).filter(pa.array(1 / (1 + np.exp(-np.clip(z, -40, 40))) < threshold))

    return over_rows(docs, run)
