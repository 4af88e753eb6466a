"""Words of many texts at once, on Arrow buffers inside tasks.

White space is ``[\\x20\\x09-\\x0D]`` and only A-Z are lower-cased, so all steps work on UTF-8 bytes.
"""

from __future__ import annotations

import ctypes
import gc
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

SLICE_BYTES = 4 << 20
SPACE = np.zeros(256, bool)
SPACE[[32, 9, 10, 11, 12, 13]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
TABLE = np.random.default_rng(20).integers(0, 1 << 64, 64 * 256, dtype=np.uint64)


def lean(run):
    """``run`` with the memory given back to the system that a worker no longer needs, before and after: workers are used again by other stages."""

    def wrapped(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release()
        try:
            yield from run(batches)
        finally:
            release()

    return wrapped


def over_rows(docs: DataFrame, run) -> DataFrame:
    """Whole rows of ``docs`` through ``run``, which leaves their columns as they are; names that a query can't spell don't matter."""
    plain = docs.toDF(*[f"c{i}" for i in range(len(docs.columns))])
    return plain.mapInArrow(lean(run), plain.schema).toDF(*docs.columns)


def release() -> None:
    gc.collect()
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (OSError, AttributeError):  # not every C library has it
        pass


def slices(texts: pa.Array, limit: int = SLICE_BYTES, rows: int = 5000) -> Iterator[tuple[int, int]]:
    """Row ranges of at most ``rows`` rows and ``limit`` bytes of text, or of one longer text."""
    if len(texts) == 0:
        return
    ends = np.cumsum(pc.binary_length(texts).fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64))
    start = 0
    while start < len(texts):
        done = ends[start - 1] if start else 0
        stop = max(start + 1, min(start + rows, int(np.searchsorted(ends, done + limit, side="right"))))
        yield start, stop
        start = stop


def raw(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of all texts one after another, and where each begins and ends; a null is empty."""
    texts = pc.fill_null(texts.cast(pa.large_string()), "")
    texts = pa.concat_arrays([texts])
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
    data = texts.buffers()[2]
    whole = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return whole[offsets[0] : offsets[-1]], offsets - offsets[0]


def packed_words(texts: pa.Array, lower: bool, space: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bytes of all words without what parts them, where each word begins (one more at the end), and the first word of each text."""
    data, offsets = raw(texts)
    solid = ~space[data]
    first = solid.copy()
    if len(data):
        first[1:] &= ~solid[:-1]
        edges = offsets[:-1][offsets[:-1] < len(data)]
        first[edges] = solid[edges]
    starts = np.flatnonzero(first)
    packed = data[solid]
    # bytes left out before each word: a running count at the words only
    parted = np.concatenate([[0], np.cumsum(~solid)])
    return LOWER[packed] if lower else packed, np.append(starts - parted[starts], len(packed)), np.searchsorted(starts, offsets)


def word_codes(texts: pa.Array, lower: bool = True, space: np.ndarray = SPACE) -> tuple[np.ndarray, np.ndarray, pa.Array]:
    """Code of every word, first word of each text (one more at the end), and the distinct words as bytes."""
    packed, at, bounds = packed_words(texts, lower, space)
    words = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(at) - 1, [None, pa.py_buffer(at.astype(np.int64)), pa.py_buffer(packed)])
    coded = words.dictionary_encode()
    return coded.indices.to_numpy(zero_copy_only=False).astype(np.int64), bounds, coded.dictionary


def word_hashes(texts: pa.Array, lower: bool = True, space: np.ndarray = SPACE) -> tuple[np.ndarray, np.ndarray]:
    """A 64-bit hash of every word, the same in every task, and the first word of each text.

    Tabulation hashing: the sum of one random number per (place, byte), with further factors for places beyond the table.
    """
    packed, at, bounds = packed_words(texts, lower, space)
    if len(at) == 1:
        return np.zeros(0, np.uint64), bounds
    size = np.diff(at)
    place = np.arange(len(packed)) - np.repeat(at[:-1], size)
    value = TABLE[(place & 63) << 8 | packed]
    far = place > 63
    if far.any():
        value[far] *= mix((place[far] >> 6).astype(np.uint64)) | np.uint64(1)
    return mix(np.add.reduceat(value, at[:-1]) + size.astype(np.uint64)), bounds


def mix(x: np.ndarray) -> np.ndarray:
    """Finish a 64-bit hash so that all bits depend on all others."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def shingle_sets(texts: pa.Array, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct hashes of the ``size``-word shingles of each text, and where each set begins.

    A text with fewer words has one shingle, the whole sequence; a text without words has none.
    """
    word, bounds = word_hashes(texts)
    counts = np.diff(bounds)
    rows = np.repeat(np.arange(len(counts)), np.where(counts >= size, counts - size + 1, np.minimum(counts, 1)))
    made = np.bincount(rows, minlength=len(counts)) if len(rows) else np.zeros(len(counts), np.int64)
    begin = np.concatenate([[0], np.cumsum(made)])
    at = np.arange(len(rows)) - begin[rows] + bounds[rows]
    length = np.minimum(counts, size)[rows]
    out = length.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    for k in range(size):
        live = length > k
        step = np.zeros(len(rows), np.uint64)
        step[live] = word[at[live] + k]
        out = mix(out + step + np.uint64(k + 1))
    order = np.lexsort((out, rows))
    out, rows = out[order], rows[order]
    fresh = np.ones(len(out), bool)
    fresh[1:] = (out[1:] != out[:-1]) | (rows[1:] != rows[:-1])
    out, rows = out[fresh], rows[fresh]
    return out, np.searchsorted(rows, np.arange(len(counts) + 1))
