"""Passages of benchmark items in documents, up to a number of word edits.

Words are embedded by the random walk of Chakraborty, Goldenberg and Koucky: at every step the walk writes the
current word's hash and moves on or not by a random bit of (step, word), so that a few edits shift two walks only for
a short while and edit distance becomes Hamming distance of the written strings. Keys are samples of positions of that
string (bit-sampling LSH), drawn anew in each repetition. All windows of an item's words are keyed, so are all
windows of the documents; the walk of a document window stops as soon as one sampled word can't be any item's.
Every window pair with one key goes to an exact semi-global edit distance between the whole item and the document.

The keys alone miss passages at the full number of edits, one in three of some short lengths. So each item is also cut into one piece
more than it may have edits: an edit touches one piece at most, so some piece of 2 to 5 words (or the whole of an item without room for
edits) stands in the document word by word, no further from its place than there are edits. Those places go to the edit distance too,
so every held item is found and ``edits`` is the least of all places.

A walk makes two steps a word of a window of at most 14 words; what lies behind the window reads as blank. With
``REPEATS = 5`` repetitions of ``SAMPLES = 5`` positions an unedited window always shares its keys; one edit leaves a key intact
with probability near one half. The tests ask for all passages, at each number of edits of items of each length.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tallyhouse.llm.words import SPACE, lean, mix, over_rows, slices, word_hashes

WINDOW = 14
SAMPLES = 5
REPEATS = 5
EDITS = 0.2
BLOCK_BYTES = 4 << 20
#: Bytes of text at once: every byte and word of a slice is held as 8-byte numbers in several arrays.
SLICE = 1 << 20
PARTS = SPACE.copy()
PARTS[list(b".,;:!?()[]{}<>\"")] = True


class Index:
    """Keys of all windows of the items, for each window size and repetition, and of all pieces; items go by their place in ``texts``."""

    def __init__(self, texts: list[str]):
        words, bounds = word_hashes(pa.array(texts, pa.large_string()), space=PARTS)
        self.items = {k: words[bounds[k] : bounds[k + 1]] for k in range(len(texts)) if bounds[k + 1] > bounds[k]}
        self.half = np.maximum(1, np.minimum(WINDOW, np.diff(bounds)) // 2)
        self.pieces = pieces(self.items)
        self.sizes = sorted({min(WINDOW, len(w)) for w in self.items.values()})
        self.reps = []
        for size in self.sizes:
            own = {i: w for i, w in self.items.items() if min(WINDOW, len(w)) == size}
            flat = np.concatenate([*own.values()])
            starts = np.concatenate([np.arange(len(w) - size + 1) for w in own.values()])
            item = np.repeat(np.array([*own]), [len(w) - size + 1 for w in own.values()])
            base = np.repeat(np.cumsum([0, *map(len, own.values())])[:-1], [len(w) - size + 1 for w in own.values()])
            for rep in range(REPEATS):
                steps = sample(size, rep)
                symbols = mix(flat + np.uint64(rep + 1))
                allowed, keys = [], np.zeros(len(starts), np.uint64)
                at = base + starts
                for step in range(steps[-1] + 1):
                    s = inside(symbols, at, base + starts + size)
                    if step in steps:
                        allowed.append(np.zeros(1 << 16, bool))
                        allowed[-1][(s >> np.uint64(48)).astype(np.int64)] = True
                        keys = mix(keys + s)
                    at = at + ((s >> np.uint64(step)) & np.uint64(1)).astype(np.int64)
                order = np.argsort(keys, kind="stable")
                self.reps.append((size, rep, steps, allowed, keys[order], item[order], starts[order]))


def pieces(items: dict[int, np.ndarray]) -> list[tuple[list[np.ndarray], np.ndarray, np.ndarray, np.ndarray]]:
    """Each item cut into one piece more than it may have edits: for each length which words may stand where, and sorted keys with item and start."""
    cut: dict[int, list[tuple[int, int]]] = {}
    for i, w in items.items():
        count = int(EDITS * len(w)) + 1
        for k in range(count):
            a, b = k * len(w) // count, (k + 1) * len(w) // count
            cut.setdefault(b - a, []).append((i, a))
    out = []
    for size, places in sorted(cut.items()):
        words = np.stack([items[i][a : a + size] for i, a in places])
        allowed, keys = np.zeros((size, 1 << 16), bool), np.zeros(len(places), np.uint64)
        for k in range(size):
            allowed[k, (words[:, k] >> np.uint64(48)).astype(np.int64)] = True
            keys = mix(keys + words[:, k])
        order = np.argsort(keys, kind="stable")
        item, start = np.array(places, np.int64).T
        out.append((list(allowed), keys[order], item[order], start[order]))
    return out


def sample(size: int, rep: int) -> list[int]:
    """The positions that a repetition samples, of a walk of two steps a word, which passes most windows whole."""
    return sorted(np.random.default_rng([size, rep]).choice(2 * size, min(SAMPLES, 2 * size), replace=False).tolist())


def inside(symbols: np.ndarray, at: np.ndarray, end: np.ndarray) -> np.ndarray:
    """The symbol under each walk; a walk that has left its window reads a blank."""
    return np.where(at < end, symbols[np.minimum(at, len(symbols) - 1)], np.uint64(0))


def candidates(words: np.ndarray, bounds: np.ndarray, index: Index) -> set[tuple[int, int, int]]:
    """(row, item, word at which the item would begin, in blocks of half a window) of all window pairs with one key and all pieces that stand in a row."""
    found: set[tuple[int, int, int]] = set()
    counts = np.diff(bounds)
    pad = max(index.sizes, default=0)
    row = np.repeat(np.arange(len(counts)), counts)
    # words of all texts with room behind each, so that no walk runs into the next text
    place = np.arange(len(words)) + row * pad
    for size, rep, steps, allowed, keys, item, start in index.reps:
        symbol = np.zeros(len(words) + pad * (len(counts) + 1), np.uint64)
        symbol[place] = mix(words + np.uint64(rep + 1))
        for part in np.array_split(np.arange(len(words)), max(1, len(words) // 100_000)):
            own, at, key, k = part, place[part], np.zeros(len(part), np.uint64), 0
            end = at + size
            for step in range(steps[-1] + 1):
                s = inside(symbol, at, end)
                if step == steps[k]:
                    ok = allowed[k][(s >> np.uint64(48)).astype(np.int64)]
                    own, at, end, s, key = own[ok], at[ok], end[ok], s[ok], mix(key[ok] + s[ok])
                    k += 1
                at = at + ((s >> np.uint64(step)) & np.uint64(1)).astype(np.int64)
            first, last = np.searchsorted(keys, key, "left"), np.searchsorted(keys, key, "right")
            for i in np.flatnonzero(last > first):
                r = int(row[own[i]])
                for j in range(first[i], last[i]):
                    found.add((r, int(item[j]), int((own[i] - bounds[r] - start[j]) // max(1, size // 2))))
    return found | standing(words, bounds, row, index)


def standing(words: np.ndarray, bounds: np.ndarray, row: np.ndarray, index: Index) -> set[tuple[int, int, int]]:
    """As ``candidates``, of all pieces of items that stand in a row word by word."""
    found: set[tuple[int, int, int]] = set()
    for allowed, keys, item, start in index.pieces:
        for part in np.array_split(np.arange(len(words)), max(1, len(words) // 100_000)):
            at, key = part[part + len(allowed) <= bounds[row[part] + 1]], np.uint64(0)
            for k, table in enumerate(allowed):
                s = words[at + k]
                ok = table[(s >> np.uint64(48)).astype(np.int64)]
                at, key = at[ok], mix((key[ok] if k else key) + s[ok])
            first, last = np.searchsorted(keys, key, "left"), np.searchsorted(keys, key, "right")
            many = last - first
            j = np.repeat(first - np.cumsum(many) + many, many) + np.arange(many.sum())
            at = np.repeat(at, many)
            found.update(zip(row[at].tolist(), item[j].tolist(), ((at - bounds[row[at]] - start[j]) // index.half[item[j]]).tolist(), strict=True))
    return found


def distance(item: np.ndarray, words: np.ndarray) -> tuple[int, int]:
    """Fewest word edits that turn the item into some part of the words, and where that part ends."""
    row = np.zeros(len(words) + 1, np.int64)
    step = np.arange(len(words) + 1)
    for k, w in enumerate(item):
        new = np.empty_like(row)
        new[0] = k + 1
        new[1:] = np.minimum(row[:-1] + (words != w), row[1:] + 1)
        row = np.minimum.accumulate(new - step) + step
    return int(row.min()), int(row.argmin())


def passages(docs: DataFrame, items: DataFrame, text: str = "text", key: str = "doc_id", item_text: str = "text", item_key: str = "item_id") -> DataFrame:
    """One row per row of ``docs`` and item it holds: key, item, ``edits``, ``words`` (of the item), ``ends_at`` (word in the document).

    Held means at most ``EDITS`` of the item's words are edits. Items are searched in blocks of at most ``BLOCK_BYTES`` of text (or one
    longer item), each a pass over the documents; an item or text without words is held by nothing. Rows of ``items`` are
    reported each, with their own ``item_id``: equal items, several items of one id, and an item with a null id as null.
    """
    spark = docs.sparkSession
    kind, item_kind = docs.select(f"`{key}`").schema[0].dataType.simpleString(), "long"
    chosen = docs.select(F.col(f"`{key}`").alias("_key"), F.col(f"`{text}`").alias("_text"))
    schema = f"_key {kind}, item_id {item_kind}, edits long, words long, ends_at long"
    out = spark.createDataFrame([], schema)
    for ids, texts in blocks(items.select(F.col(f"`{item_key}`").cast("long"), F.col(f"`{item_text}`")).where(F.col(f"`{item_text}`").isNotNull())):
        out = out.unionByName(chosen.mapInArrow(lean(searcher(ids, texts)), schema))
    return out.withColumnRenamed("_key", key)


def blocks(items: DataFrame) -> Iterator[tuple[list[int | None], list[str]]]:
    ids, texts, size = [], [], 0
    for i, t in items.toLocalIterator():
        if ids and size + len(t) > BLOCK_BYTES:
            yield ids, texts
            ids, texts, size = [], [], 0
        ids.append(i)
        texts.append(t)
        size += len(t)
    if ids:
        yield ids, texts


def clean(docs: DataFrame, items: DataFrame, text: str = "text", item_text: str = "text") -> DataFrame:
    """The rows that hold no item, with all their columns, whatever their keys; nothing is shuffled."""
    at = docs.columns.index(text)
    for _, texts in blocks(items.select(F.lit(None).cast("long"), F.col(f"`{item_text}`")).where(F.col(f"`{item_text}`").isNotNull())):
        docs = over_rows(docs, cleaner(texts, at))
    return docs


def cleaner(texts: list[str], at: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = None
        for batch in batches:
            index = index or Index(texts)
            for a, b in slices(batch.column(at), SLICE):
                keep = np.ones(b - a, bool)
                keep[[r for r, _ in held(batch.column(at).slice(a, b - a), index)]] = False
                yield batch.slice(a, b - a).filter(pa.array(keep))

    return run


def held(texts: pa.Array, index: Index) -> dict[tuple[int, int], tuple[int, int]]:
    """Of each row and item it holds the least edits, and where such a passage ends first."""
    words, bounds = word_hashes(texts, space=PARTS)
    best: dict[tuple[int, int], tuple[int, int]] = {}
    for r, i, block in sorted(candidates(words, bounds, index)):
        item, half = index.items[i], int(index.half[i])
        most = int(EDITS * len(item))
        first = max(0, block * half - most - half)
        edits, end = distance(item, words[bounds[r] + first : min(bounds[r + 1], bounds[r] + block * half + len(item) + most + 2 * half)])
        if edits <= most:
            best[r, i] = min(best.get((r, i), (edits, first + end)), (edits, first + end))
    return best


def searcher(ids: list[int | None], texts: list[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = None
        for batch in batches:
            index = index or Index(texts)
            for a, b in slices(batch.column(1), SLICE):
                keys = batch.column(0).slice(a, b - a)
                hits = sorted(held(batch.column(1).slice(a, b - a), index).items())
                yield pa.RecordBatch.from_arrays([keys.take(pa.array([r for (r, _), _ in hits], pa.int64())), *[pa.array(c, pa.int64()) for c in ([ids[i] for (_, i), _ in hits], [e for _, (e, _) in hits], [len(index.items[i]) for (_, i), _ in hits], [e for _, (_, e) in hits])]], names=["_key", "item_id", "edits", "words", "ends_at"])

    return run
