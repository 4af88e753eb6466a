"""Packing of token sequences by minimum bin slack.

Every task tokenises its documents and packs them at once: nothing is shuffled, and memory holds one
slice of text, a bounded pool of remainders and a bounded cache of encoded chunks.

Long documents fill whole sequences by themselves; their remainders go to the pool. Each sequence
starts with the longest remainder, and a subset-sum over the multiset of the other lengths, held
as bits of one integer, finds the fill nearest to the capacity; walking the stages back gives how many
of each length take part. If some slack is left, one remainder is cut to fill it. What is left at the
end of a task is cut into sequences whose lengths are powers of two, which need no padding.
"""

from __future__ import annotations

import base64
import os
import zlib
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from tallyhouse.llm.words import lean, raw, slices

CAPACITY = 2048
END_ID = 1
POOL = 192
CACHE = 100_000
SLICE = 2 << 20
OUT = pa.schema([(c, pa.int64()) for c in ("doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")])


def chunk_codes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, pa.Array]:
    """Texts cut before white space that follows something solid, where the tokenizer always cuts too.

    Returns the code of every chunk, the first chunk of each text (one more at the end) and the distinct chunks. Only a blank or
    line feed after a byte that can't end a wider white-space character counts, so a chunk is encoded as in its text.
    """
    data, offsets = raw(texts)
    at = np.flatnonzero((data == 32) | (data == 10))
    before = data[at - 1]  # of a first byte the last one, but texts are cut at their first byte anyway
    wide = before >= 128
    ok = (before > 32) & (before < 127) | wide
    if wide.any():
        w = at[wide]
        second, third = data[w - 2], data[w - 3]
        ok[wide] = (second != 0xC2) & ((third < 0xE1) | (third > 0xE3))
    starts = np.sort(np.concatenate([at[ok], offsets[:-1][np.diff(offsets) > 0]]))
    starts = starts[np.diff(starts, prepend=-1) > 0]
    chunks = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(starts), [None, pa.py_buffer(np.append(starts, len(data)).astype(np.int64).tobytes()), pa.py_buffer(data)])
    coded = chunks.dictionary_encode()
    return coded.indices.to_numpy(zero_copy_only=False).astype(np.int64), np.searchsorted(starts, offsets), coded.dictionary


class Encoder:
    """Token ids of texts through a cache of chunks.

    ``tokenizer`` is a file for the library tokenizers. With ``ranks``, the same vocabulary for tiktoken,
    chunks that begin with white space and end with a letter, digit or mark of ASCII are encoded many at once: their
    borders are cuts of the pre-tokeniser, and the tokens' byte lengths tell where each chunk ends.
    The cache has two generations, so frequent chunks outlive rare ones; each holds at most ``CACHE`` and one slice's chunks.
    """

    def __init__(self, tokenizer: str, ranks: str | None = None, pattern: str | None = None):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer, self.fast = Tokenizer.from_file(tokenizer), None
        self.special = [t.content.encode() for t in self.tokenizer.get_added_tokens_decoder().values()]
        if ranks:
            import tiktoken

            with open(ranks, "rb") as f:
                table = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, f)}
            self.width = np.zeros(max(table.values()) + 1, np.int64)
            for token, rank in table.items():
                self.width[rank] = len(token)
            self.fast = tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=table, special_tokens={})
        self.young: dict[bytes, bytes] = {}
        self.old: dict[bytes, bytes] = {}

    def _learn(self, new: list[bytes]) -> None:
        joined, single = [], []
        for k in new:
            plain = self.fast and k[0] in (10, 32) and 32 < k[-1] < 127 and not (b"<" in k and any(s in k for s in self.special))
            (joined if plain else single).append(k)
        if joined:
            ids = np.array(self.fast.encode_ordinary(b"".join(joined).decode()), "<u4")
            ends = np.concatenate([[0], np.searchsorted(np.cumsum(self.width[ids]), np.cumsum([len(k) for k in joined])) + 1]) * 4
            blob = ids.tobytes()
            self.young.update((k, blob[ends[i] : ends[i + 1]]) for i, k in enumerate(joined))
        for k, e in zip(single, self.tokenizer.encode_batch_fast([k.decode() for k in single], add_special_tokens=False), strict=True):
            self.young[k] = np.array(e.ids, "<u4").tobytes()

    def ids(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts, each followed by ``END_ID``, and where each text begins (one more at the end)."""
        codes, bounds, distinct = chunk_codes(texts)
        keys = distinct.to_pylist()
        if len(self.young) > CACHE:
            self.old, self.young = self.young, {}
        new = []
        for k in keys:
            if k not in self.young:
                if k in self.old:
                    self.young[k] = self.old[k]
                else:
                    new.append(k)
        self._learn(new)
        parts = [self.young[k] for k in keys]
        sizes = np.fromiter(map(len, parts), np.int64, len(parts)) // 4
        flat = np.frombuffer(b"".join(parts), "<u4")
        begin = np.cumsum(sizes) - sizes
        each = sizes[codes]
        ends = np.concatenate([[0], np.cumsum(each)])
        doc = ends[bounds] + np.arange(len(bounds))  # with the closing ids before it
        out = np.full(doc[-1], END_ID, "<u4")
        places = np.ones(doc[-1], bool)
        places[doc[1:] - 1] = False
        out[places] = flat[np.repeat(begin[codes] - ends[:-1], each) + np.arange(ends[-1])]
        return out, doc


def best_fill(lengths: list[int], capacity: int) -> dict[int, int]:
    """How many of each length come closest to the capacity from below."""
    count: dict[int, int] = defaultdict(int)
    for n in lengths:
        count[n] += 1
    mask, reach, stages = (1 << capacity + 1) - 1, 1, []
    for n in sorted(count, reverse=True):
        if n > capacity:
            continue
        stages.append((n, count[n], reach))
        left, part = min(count[n], capacity // n), 1
        while left:  # multiples by doubling
            part = min(part, left)
            reach |= reach << n * part & mask
            left -= part
            part *= 2
        if reach >> capacity & 1:
            break
    total, taken = reach.bit_length() - 1, {}
    for n, most, before in reversed(stages):
        k = 0
        while not before >> total & 1:
            total, k = total - n, k + 1
        if k:
            taken[n] = k
    return taken


class Packer:
    """Pieces go in, rows of full sequences come out."""

    def __init__(self, first: int, capacity: int = CAPACITY):
        self.capacity, self.sequence, self.pool, self.rows = capacity, first, defaultdict(list), []
        self.held = 0

    def put(self, doc, ids: np.ndarray) -> None:
        n, whole = len(ids), len(ids) // self.capacity * self.capacity
        for a in range(0, whole, self.capacity):
            self._emit([(doc, a, ids[a : a + self.capacity], n)])
        if whole < n:
            self._hold((doc, whole, ids[whole:].copy(), n))

    def _hold(self, piece) -> None:
        self.pool[len(piece[2])].append(piece)
        self.held += 1

    def _take(self, n: int):
        self.held -= 1
        piece = self.pool[n].pop()
        if not self.pool[n]:
            del self.pool[n]
        return piece

    def _emit(self, pieces: list) -> None:
        at = 0
        for doc, start, ids, n in pieces:
            self.rows.append((doc, start, len(ids), zlib.crc32(ids.tobytes()), n, self.sequence, at))
            at += len(ids)
        self.sequence += 1

    def _fill(self, capacity: int) -> None:
        """One sequence of exactly ``capacity`` tokens; the pool must hold that many."""
        longest = max((n for n in self.pool if n <= capacity), default=0)
        pieces = [self._take(longest)] if longest else []
        left = capacity - longest
        for n, k in best_fill([n for n, of in self.pool.items() for _ in of], left).items() if left else ():
            pieces += [self._take(n) for _ in range(k)]
            left -= n * k
        if left:  # every remaining piece is longer than the slack: cut the shortest
            doc, start, ids, n = self._take(min(self.pool))
            pieces.append((doc, start, ids[:left], n))
            self._hold((doc, start + left, ids[left:], n))
        self._emit(pieces)

    def shrink(self, to: int) -> None:
        while self.held > to and sum(n * len(of) for n, of in self.pool.items()) >= self.capacity:
            self._fill(self.capacity)

    def finish(self) -> None:
        self.shrink(0)
        rest = sum(n * len(of) for n, of in self.pool.items())
        for bit in reversed(range(rest.bit_length())):
            if rest >> bit & 1:
                self._fill(1 << bit)

    def batch(self) -> pa.RecordBatch:
        rows, self.rows = self.rows, []
        return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in (zip(*rows, strict=True) if rows else [[]] * len(OUT))], schema=OUT)


def pack(docs: DataFrame, tokenizer: str, ranks: str | None = None, pattern: str | None = None, text: str = "text", key: str = "doc_id") -> DataFrame:
    """One row per piece: key, start, length, ids_crc32, doc_tokens, sequence_id, offset.

    A null or empty text is its closing id alone. A repeated row or key is packed once for each row, a null key stays null.
    ``tokenizer``, ``ranks`` and ``pattern`` are those of ``Encoder``; the files are on every worker. No sequence is padded: those
    shorter than the capacity are powers of two, at most eleven a task.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, packer = None, Packer(TaskContext.get().partitionId() << 33)
        for batch in batches:
            keys, texts = batch.column(0).to_pylist(), batch.column(1)
            for a, b in slices(texts, SLICE):
                encoder = encoder or Encoder(tokenizer, ranks, pattern)
                ids, bounds = encoder.ids(texts.slice(a, b - a))
                for i in range(a, b):
                    packer.put(keys[i], ids[bounds[i - a] : bounds[i - a + 1]])
                    if packer.held >= POOL:
                        packer.shrink(POOL // 2)
                yield packer.batch()
        packer.finish()
        yield packer.batch()

    names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
    packed = docs.select(F.col(f"`{key}`").cast("long").alias("doc_id"), F.col(f"`{text}`").alias("text")).mapInArrow(lean(run), ", ".join(f"{c} long" for c in names))
    return packed.withColumnRenamed("doc_id", key)
