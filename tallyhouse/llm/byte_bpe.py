"""Byte-level BPE over a table of ranks: encoding by a fold of ranked merges, decoding by joining pieces.

The work on words is a Spark higher-order function. A word's bytes are the first pieces; each step of the fold looks up
every neighbouring pair in a literal map of ranked merges and merges the pair of the least rank wherever it stands, from
the left, until no pair is in the map. Words that are frequent in the whole corpus are folded once (``HEAD`` of them at
most, a bounded dictionary that goes to the tasks); every other word is folded once in each document that holds it. No
text is shuffled.

While it is folded, a word is a string with one character for each piece, whose code point is the piece's id plus
``FIRST``; so the least rank is the least string, and a merge is a replacement.

This needs a table in which each piece encodes to itself alone, by merges of rising rank, as every table from training has
(``ranked_merges`` checks it). Then a merge only makes pairs of higher rank, and a piece is always made of the same two
parts. It also makes an encoding right exactly if each two neighbouring pieces are: so a word above ``WINDOW`` bytes is
folded in overlapping windows, which are joined at a piece that two windows share. Where two share none, the word is
folded whole, which takes time with the square of its length.
"""

from __future__ import annotations

import base64
import json
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tallyhouse.session import work_dir

#: Words of the dictionary that goes to every task, and the longest of them in bytes: 16 MB of words at the very most.
HEAD, LONGEST = 1 << 18, 64
#: Words or ids that a task works on at once.
SLICE = 1 << 18
#: Bytes of a window of a long word. Windows begin every half window; a multiple of 3 and of powers of two keeps runs of one letter in step.
WINDOW = 192
#: Lists of the literal map; a list has one or two merges on average.
SLOTS = 1 << 15
#: Code point of id 0. Surrogates are skipped.
FIRST, SURROGATES = 256, range(0xD800, 0xE000)
MISSING = -1
#: Stands before a word that has no more merges.
DONE = "!"


def read_ranks(path: str) -> dict[bytes, int]:
    """Rank of each piece, from lines of base64 and number."""
    with open(path, "rb") as lines:
        return {base64.b64decode(piece): int(rank) for piece, rank in map(bytes.split, lines)}


def ranked_merges(ranks: dict[bytes, int]) -> dict[tuple[bytes, bytes], int]:
    """The two parts that each piece is made of, with its rank.

    A piece's bytes are merged by least rank, from the left. ``ValueError`` if a byte has no rank, or if a piece does not
    become itself alone by merges of rising rank.
    """
    if missing := [i for i in range(256) if bytes([i]) not in ranks]:
        raise ValueError(f"no rank for the bytes {missing}")
    made: dict[tuple[bytes, bytes], int] = {}
    for piece, rank in ranks.items():
        parts, last = [piece[i : i + 1] for i in range(len(piece))], -1
        while len(parts) > 1:
            least, i = min(((ranks[x + y], i) for i, (x, y) in enumerate(zip(parts, parts[1:])) if x + y in ranks), default=(-1, 0))
            if least < last or least < 0:
                raise ValueError(f"the piece {piece!r} is not made by merges of rising rank")
            last = least
            if len(parts) == 2:
                made[parts[0], parts[1]] = rank
            parts[i : i + 2] = [parts[i] + parts[i + 1]]
    return made


def _sign(number: int) -> str:
    """The character of an id."""
    point = number + FIRST
    return chr(point if point < SURROGATES.start else point + len(SURROGATES))


class Merges:
    """The rank table as literals of a query. Each stands once in an expression: their text is up to a megabyte."""

    def __init__(self, spark: SparkSession, ranks: dict[bytes, int]):
        rows = [(_sign(ranks[x]) + _sign(ranks[y]), _sign(rank)) for (x, y), rank in ranked_merges(ranks).items()]
        lists: list[dict[str, str]] = [{} for _ in range(SLOTS)]
        for pair, sign, slot in spark.createDataFrame(rows or [("", "")], "pair string, sign string").select("pair", "sign", _slot(F.col("pair"))).collect():
            lists[slot][pair] = sign
        top = max(ranks.values())
        by_rank = {rank: piece for piece, rank in ranks.items()}
        self.map = _literal(lists, "array<map<string,string>>")
        self.sizes = _literal([len(by_rank.get(i, b"")) for i in range(top + 1)], "array<int>")
        self.pieces = _literal([by_rank.get(i, b"").hex() for i in range(top + 1)], "array<string>")
        self.bytes = "".join(map(chr, range(256))), "".join(_sign(ranks[bytes([i])]) for i in range(256))

    def encoded(self, word: Column) -> Column:
        """Ids of one word, given with a character per byte."""
        signs = F.translate(word, *self.bytes)

        def folded(merges: Column) -> Column:
            return F.when(F.length(signs) <= WINDOW, _ids(_folded(signs, merges))).otherwise(_let(self._windows(signs, merges), lambda windows: _joined(signs, merges, windows)))

        return _let(self.map, folded)

    def _windows(self, signs: Column, merges: Column) -> Column:
        """Of each window, its pieces as (begin, end, id) in the word."""
        half = WINDOW // 2
        nothing = F.array().cast("array<struct<b:int,e:int,id:int>>")

        def placed(begin: Column, sizes: Column) -> Column:
            def add(s: Column, number: Column) -> Column:
                end = s["at"] + F.get(sizes, number)
                return F.struct(F.concat(s["done"], F.array(F.struct(s["at"].alias("b"), end.alias("e"), number.alias("id")))).alias("done"), end.alias("at"))

            return F.aggregate(_ids(_folded(F.substring(signs, begin + 1, F.lit(WINDOW)), merges)), F.struct(nothing.alias("done"), begin.alias("at")), add, lambda s: s["done"])

        return _let(self.sizes, lambda sizes: F.transform(F.sequence(F.lit(0), F.length(signs) - half - 1, F.lit(half)), lambda begin: placed(begin, sizes)))

    def decoded(self, ids: Column) -> Column:
        """The bytes of an array of ids: their pieces one after another. Ids without a piece and nulls add nothing."""
        return _let(self.pieces, lambda pieces: F.unhex(F.array_join(F.transform(ids, lambda i: F.get(pieces, i)), "")))


def _literal(value: list, kind: str) -> Column:
    return F.from_json(F.lit(json.dumps(value, ensure_ascii=False, separators=(",", ":"))), F.lit(kind))


def _slot(pair: Column) -> Column:
    return F.xxhash64(pair).bitwiseAND(F.lit(SLOTS - 1)).cast("int")


def _folded(signs: Column, merges: Column) -> Column:
    """The pieces of one word by ranked merges, each a character."""

    def step(state: Column, _: Column) -> Column:
        pairs = F.transform(F.sequence(F.lit(1), F.length(state) - 1), lambda i: F.substring(state, i, F.lit(2)))
        found = F.transform(pairs, lambda pair: F.try_element_at(F.get(merges, _slot(pair)), pair))

        def merge(found: Column) -> Column:
            least = F.array_min(found)
            pair = F.substring(state, F.array_position(found, least).cast("int"), F.lit(2))
            return F.when(least.isNull(), F.concat(F.lit(DONE), state)).otherwise(F.replace(state, pair, least))

        return F.when(F.startswith(state, F.lit(DONE)) | (F.length(state) < 2), state).otherwise(_let(found, merge))

    return F.aggregate(F.sequence(F.lit(1), F.length(signs)), signs, step, lambda state: F.ltrim(state, F.lit(DONE)))


def _ids(signs: Column) -> Column:
    def number(sign: Column) -> Column:
        return _let(F.ascii(sign), lambda point: F.when(point < SURROGATES.start, point - FIRST).otherwise(point - FIRST - len(SURROGATES)))

    return F.transform(F.split(signs, ""), number)


def _joined(signs: Column, merges: Column, windows: Column) -> Column:
    """Each window gives what lies between the first piece it shares with the one before and the first it shares with the next."""
    last = F.size(windows) - 1
    # the first pieces of a window may be cut by its edge, but not one that the window before has too
    shared = F.transform(F.sequence(F.lit(0), last - 1), lambda k: F.array_min(F.array_intersect(F.get(windows, k), F.get(windows, k + 1)))["b"])

    def spliced(seams: Column) -> Column:
        part = lambda k: F.filter(F.get(windows, k), lambda p: (p["b"] >= F.coalesce(F.get(seams, k - 1), F.lit(0))) & ((k == last) | (p["b"] < F.get(seams, k))))
        ids = F.transform(F.flatten(F.transform(F.sequence(F.lit(0), last), part)), lambda p: p["id"])
        return F.when(F.exists(seams, lambda s: s.isNull()), _ids(_folded(signs, merges))).otherwise(ids)

    return F.when(last == 0, F.transform(F.get(windows, 0), lambda p: p["id"])).otherwise(_let(shared, spliced))


def _let(value: Column, use) -> Column:
    """``use`` with a value that is computed once."""
    return F.get(F.transform(F.array(value), use), 0)


def _bytes(word: Column) -> Column:
    return F.decode(word.cast("binary"), "ISO-8859-1")


def words_of(text: Column, pattern: str) -> Column:
    """All matches of the pattern, with the character classes of Unicode."""
    return F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(f"(?U){pattern}"), F.lit(0))


def frequent(docs: DataFrame, merges: Merges, pattern: str, column: str, head: int) -> pa.Table:
    """(word, ids) of the most frequent words of all texts, ``head`` of them at most. Each is folded once.

    Words are counted in the tasks and then by Spark, and the counts are written. How many words occur how often tells the
    least count that ``head`` words reach, so nothing is sorted and no task sees more than its share; words that just miss it are
    folded in their documents.
    """
    spark, path = docs.sparkSession, work_dir(docs.sparkSession, "words")
    words = docs.select(F.explode(words_of(F.col(f"`{column}`"), pattern)).alias("word")).where(F.octet_length("word") <= LONGEST)
    words.groupBy("word").agg(F.count(F.lit(1)).alias("n")).write.parquet(path)
    counted = spark.read.parquet(path)
    # counts above a thousand differ by a tenth at least, so that there are few of them
    grade = F.when(F.col("n") <= 1000, F.col("n")).otherwise(F.floor(1000 * F.pow(F.lit(1.1), F.floor(F.log(1.1, F.col("n") / 1000))))).cast("long")
    left, least = head, None
    for n, held in counted.groupBy(grade.alias("n")).agg(F.count(F.lit(1)).alias("held")).orderBy(F.desc("n")).collect():
        if held > left:
            break
        left, least = left - held, n
    top = counted.where(grade >= least) if least is not None else counted.limit(0)
    spread = top.select("word").repartition(spark.sparkContext.defaultParallelism * 4)
    return spread.select("word", merges.encoded(_bytes(F.col("word"))).alias("ids")).toArrow()


def encode(docs: DataFrame, path: str, pattern: str, column: str = "text", keep: tuple[str, ...] = ("doc_id",), head: int = HEAD) -> DataFrame:
    """``keep`` columns of every row, with ``ids`` (array of int) and ``ids_le`` (the same as unsigned 32-bit integers, little-endian).

    ``path`` has the ranks, which are the ids, ``pattern`` cuts texts into words; what it does not match is left out. Null
    and empty texts have no ids. Each row is encoded by itself, so nulls, ties and repeats in other columns, and further columns of any name, make no difference; an empty table gives no rows.
    Columns named ``ids`` or ``ids_le`` cannot be kept.
    """
    spark = docs.sparkSession
    merges = Merges(spark, read_ranks(path))
    known = frequent(docs, merges, pattern, column, head)
    rest = F.transform(F.col("_rest"), lambda word: merges.encoded(_bytes(word)))
    kept = [F.col(f"`{c}`").alias(f"k{i}") for i, c in enumerate(keep)]
    fields = [f"k{i} {docs.schema[c].dataType.simpleString()}" for i, c in enumerate(keep)]
    split = docs.select(*kept, words_of(F.col(f"`{column}`"), pattern).alias("_words"))
    looked = split.mapInArrow(_look_up(known), ", ".join([*fields, "_ids array<int>", "_rest array<string>"]))
    names = [f"k{i}" for i in range(len(keep))]
    whole = looked.select(*names, "_ids", rest.alias("_rest")).mapInArrow(_fill, ", ".join([*fields, "ids array<int>", "ids_le binary"]))
    return whole.select(*[F.col(n).alias(c) for n, c in zip(names, keep)], "ids", "ids_le")


def _look_up(known: pa.Table):
    """Replace known words by their ids and others by -1 minus their place among the row's further words."""
    words, ids = known["word"].combine_chunks(), known["ids"].combine_chunks()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        starts, flat = ids.offsets.to_numpy(), ids.flatten().to_numpy(zero_copy_only=False).astype(np.int32)
        for batch in _slices(batches, "_words"):
            texts = batch.column("_words")
            all_words, first = texts.flatten(), texts.offsets.to_numpy() - texts.offsets[0].as_py()
            place = pc.index_in(all_words, value_set=words.cast(all_words.type)).fill_null(MISSING).to_numpy(zero_copy_only=False) if len(words) else np.full(len(all_words), MISSING, np.int32)
            unknown = np.flatnonzero(place == MISSING)
            row = np.repeat(np.arange(len(texts)), np.diff(first))[unknown]
            # distinct unknown words of each row, numbered in it
            code = all_words.take(pa.array(unknown)).dictionary_encode()
            code, names = code.indices.to_numpy(zero_copy_only=False).astype(np.int64), code.dictionary
            pairs, back = np.unique(row * max(1, len(names)) + code, return_inverse=True)
            owner = pairs // max(1, len(names))
            begin = np.searchsorted(owner, np.arange(len(texts) + 1))
            rest = pa.ListArray.from_arrays(pa.array(begin.astype(np.int32)), names.take(pa.array(pairs % max(1, len(names)))))
            size = np.ones(len(place), np.int64)
            found = place != MISSING
            size[found] = (starts[1:] - starts[:-1])[place[found]]
            ends = np.concatenate([[0], np.cumsum(size)])
            out = np.empty(ends[-1], np.int32)
            out[ends[:-1][unknown]] = -1 - (back - begin[row])
            p = place[found]
            out[_ranges(ends[:-1][found], size[found])] = flat[_ranges(starts[p], size[found])]
            numbers = pa.ListArray.from_arrays(pa.array(ends[first].astype(np.int32)), pa.array(out))
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], numbers, rest], names=[*batch.schema.names[:-1], "_ids", "_rest"])

    return run


def _slices(batches: Iterator[pa.RecordBatch], column: str) -> Iterator[pa.RecordBatch]:
    """The rows in slices whose lists have ``SLICE`` items together, or of one row with more."""
    for batch in batches:
        offsets = batch.column(column).offsets.to_numpy()
        start = 0
        while start < len(batch):
            stop = max(start + 1, int(np.searchsorted(offsets, offsets[start] + SLICE, side="right")) - 1)
            yield batch.slice(start, stop - start)
            start = stop


def _ranges(begin: np.ndarray, size: np.ndarray) -> np.ndarray:
    """All numbers of the ranges, one range after another."""
    ends = np.cumsum(size)
    return np.arange(ends[-1] if len(ends) else 0) - np.repeat(ends - size, size) + np.repeat(begin, size)


def _fill(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Put the ids of further words in their places."""
    for batch in _slices(batches, "_ids"):
        numbers, rest = batch.column("_ids"), batch.column("_rest")
        flat, first = numbers.flatten().to_numpy(zero_copy_only=False), numbers.offsets.to_numpy() - numbers.offsets[0].as_py()
        inner = rest.flatten()
        word, ids = rest.offsets.to_numpy() - rest.offsets[0].as_py(), inner.flatten().to_numpy(zero_copy_only=False)
        starts = inner.offsets.to_numpy() - (inner.offsets[0].as_py() if len(inner.offsets) else 0)
        row = np.repeat(np.arange(len(batch)), np.diff(first))
        open_ = np.flatnonzero(flat < 0)
        which = word[row[open_]] + (-1 - flat[open_])
        size = np.ones(len(flat), np.int64)
        size[open_] = (starts[1:] - starts[:-1])[which]
        ends = np.concatenate([[0], np.cumsum(size)])
        out = np.empty(ends[-1], np.int32)
        done = flat >= 0
        out[ends[:-1][done]] = flat[done]
        out[_ranges(ends[:-1][open_], size[open_])] = ids[_ranges(starts[which], size[open_])]
        bounds = ends[first]
        whole = pa.ListArray.from_arrays(pa.array(bounds.astype(np.int32)), pa.array(out))
        raw = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(batch), [None, pa.py_buffer((bounds * 4).astype(np.int64)), pa.py_buffer(out.astype("<u4"))]).cast(pa.binary())
        yield pa.RecordBatch.from_arrays([*batch.columns[:-2], whole, raw], names=[*batch.schema.names[:-2], "ids", "ids_le"])


def decode(encoded: DataFrame, path: str, ids: str = "ids", name: str = "decoded") -> DataFrame:
    """The rows with a column of the bytes that an array of ids stands for; a null array gives null, an empty one no bytes."""
    merges = Merges(encoded.sparkSession, read_ranks(path))
    return encoded.withColumn(name, merges.decoded(F.col(f"`{ids}`")))
