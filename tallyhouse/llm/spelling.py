"""Spelling variants: words one edit apart, found by k-d trees over counts of letters.

A word is a vector of letter counts. One replaced letter moves it by a distance of two (sum of absolute differences), one
inserted or deleted letter by one. So for each length there is a k-d tree over its words, searched by words of the same
length within distance two and by words one shorter within distance one. A node splits the words by the count of one
letter; a search skips every box that is further away than that. What is left is verified letter by letter.

The upper levels of the trees are fitted on a bounded sample and go to the tasks; they only decide how words are dealt
out. A leaf is a group of a shuffle: its words, and the words whose search reaches its box. Each task builds the lower
levels for its own leaf and searches them in whole blocks of words. Of two words of one length, the one of the lower leaf
visits the other's, so a pair is met once.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tallyhouse.session import work_dir

#: Words that a leaf of the upper levels should hold, and words the levels are fitted on at most, in expectation.
LEAF, SAMPLE = 8192, 200_000
#: Words of a leaf of the lower levels, and searching words that meet it at once.
BUCKET, BLOCK = 48, 8192


class Tree:
    """Nodes that split by the count of one letter: at most ``cut``, or more."""

    def __init__(self, counts: np.ndarray, letters: np.ndarray, limit: int):
        self.nodes: list[tuple] = []
        self.leaves: list[np.ndarray] = []
        self.letters = letters
        self._grow(counts, np.arange(len(counts)), limit)

    def _grow(self, counts: np.ndarray, rows: np.ndarray, limit: int) -> int:
        at = len(self.nodes)
        self.nodes.append(())
        best = None
        if len(rows) > limit:
            mine = counts[rows]
            middle = np.sort(mine, axis=0)[len(rows) // 2]
            for cut in (middle, middle - 1):
                low = (mine <= cut).sum(axis=0)
                even = np.minimum(low, len(rows) - low)
                f = int(even.argmax())
                if even[f] and (best is None or even[f] > best[0]):
                    best = (even[f], f, int(cut[f]))
        if best is None:
            self.nodes[at] = (-1, len(self.leaves), 0, 0)
            self.leaves.append(rows)
            return at
        _, f, cut = best
        low = counts[rows, f] <= cut
        left, right = self._grow(counts, rows[low], limit), self._grow(counts, rows[~low], limit)
        self.nodes[at] = (f, cut, left, right)
        return at

    def home(self, counts: np.ndarray) -> np.ndarray:
        """The leaf of each vector."""
        out = np.zeros(len(counts), np.int64)
        todo = [(0, np.arange(len(counts)))]
        while todo:
            at, rows = todo.pop()
            f, x, left, right = self.nodes[at]
            if f < 0:
                out[rows] = x
            elif len(rows):
                low = counts[rows, f] <= x
                todo += [(left, rows[low]), (right, rows[~low])]
        return out

    def reach(self, counts: np.ndarray, radius: np.ndarray, extra: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
        """Each leaf whose box is within the radius of some vectors, with these. ``extra`` is what a vector has outside the tree's letters: no box has it."""
        todo = [(0, np.arange(len(counts)), extra.astype(np.int64), {})]
        while todo:
            at, rows, gap, box = todo.pop()
            f, x, left, right = self.nodes[at]
            if f < 0:
                yield x, rows
                continue
            low, high = box.get(f, (0, 1 << 40))
            mine = counts[rows, f].astype(np.int64)
            before = np.maximum(0, low - mine) + np.maximum(0, mine - high)
            for child, lo, hi in ((left, low, min(high, x)), (right, max(low, x + 1), high)):
                now = gap - before + np.maximum(0, lo - mine) + np.maximum(0, mine - hi)
                near = now <= radius[rows]
                if near.any():
                    todo.append((child, rows[near], now[near], box | {f: (lo, hi)}))


def points(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Code points of all words one after another, and their numbers."""
    flat = np.frombuffer("".join(words).encode("utf-32-le", "surrogatepass"), "<u4")
    return flat, np.fromiter(map(len, words), np.int64, len(words))


def letter_counts(words: list[str], letters: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """How often each word has each of the (sorted) letters, and how many other letters it has."""
    flat, sizes = points(words)
    row = np.repeat(np.arange(len(words)), sizes)
    at = np.searchsorted(letters, flat)
    known = at < len(letters)
    known[known] = letters[at[known]] == flat[known]
    width = max(1, len(letters))
    counts = np.bincount(row[known] * width + at[known], minlength=len(words) * width).reshape(len(words), width)
    return counts.astype(np.int32), np.bincount(row[~known], minlength=len(words))


def corpus_words(docs: DataFrame, key: str = "doc_id", column: str = "text", modulus: int = 97, shortest: int = 5, least: int = 3) -> DataFrame:
    """(word, n): runs of Latin letters in whole texts, A-Z lower-cased, of at least ``shortest`` letters, that occur ``least`` times.

    A run loses one letter if ``modulus`` divides the checksum of key and run. Null and empty texts have no words; a null
    key counts as empty text; repeated rows count as often as they stand.
    """
    runs = docs.select(F.coalesce(F.col(f"`{key}`").cast("string"), F.lit("")).alias("k"), F.explode(F.regexp_extract_all(F.coalesce(F.col(f"`{column}`"), F.lit("")), F.lit("[A-Za-zÀ-ÿ]+"), F.lit(0))).alias("run"))
    low = runs.where(F.length("run") >= shortest).select("k", F.translate("run", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz").alias("run"))
    marked = low.select("run", F.crc32(F.concat("k", F.lit(":"), "run").cast("binary")).alias("h"))
    at = F.pmod(F.col("h"), F.length("run")).cast("int")
    cut = F.concat(F.substring(F.col("run"), F.lit(1), at), F.substring(F.col("run"), at + 2, F.length("run")))
    words = marked.select(F.when(F.pmod(F.col("h"), F.lit(modulus)) == 0, cut).otherwise(F.col("run")).alias("word")).where(F.length("word") >= shortest)
    return words.groupBy("word").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= least)


def variants(words: DataFrame) -> DataFrame:
    """(word, form, root, n, n_near, form_n) for a table of distinct ``word`` and ``n``.

    Near words differ by exactly one inserted, deleted or replaced code point. The form is the near word of largest n, of
    equal ones the first in code-point order, if that is at least twice the word's n; the root is reached by following
    forms, and is the word itself without one. Null words are left out, a null n counts as 0, of repeated words the one with the largest n
    stays; an empty table gives no rows.
    """
    spark, folder = words.sparkSession, work_dir(words.sparkSession, "spelling")
    words.where(F.col("word").isNotNull()).groupBy("word").agg(F.max(F.coalesce(F.col("n").cast("long"), F.lit(0).cast("long"))).alias("n")).write.parquet(f"{folder}/words")
    words = spark.read.parquet(f"{folder}/words")
    dealt = words.mapInArrow(_deal(_upper_levels(words)), "size int, leaf int, home boolean, word string, n long")
    found = dealt.groupBy("size", "leaf").applyInArrow(_search, "word string, n_near long, best_n long, best string")
    best = found.groupBy("word").agg(F.sum("n_near").alias("n_near"), F.min(F.struct((-F.col("best_n")).alias("n"), F.col("best").alias("word"))).alias("best"))
    joined = words.join(best, "word", "left")
    firm = -F.col("best.n") >= 2 * F.col("n")
    forms = joined.select("word", F.when(firm, F.col("best.word")).alias("form"), "n", F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"), F.when(firm, -F.col("best.n")).alias("form_n"))
    forms.write.parquet(f"{folder}/forms")
    forms = spark.read.parquet(f"{folder}/forms")
    roots = _roots(forms, folder)
    return forms.join(roots, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def _roots(forms: DataFrame, folder: str) -> DataFrame:
    """(word, root) of all words with a form. Each round doubles the steps that were followed; n doubles with every step, so rounds are few."""
    spark, turn = forms.sparkSession, 0
    forms.where("form IS NOT NULL").select("word", F.col("form").alias("root"), F.lit(True).alias("moved")).write.parquet(f"{folder}/roots0")
    while True:
        now = spark.read.parquet(f"{folder}/roots{turn}")
        if not now.where("moved").limit(1).count():
            return now.select("word", "root")
        turn += 1
        after = now.select(F.col("word").alias("root"), F.col("root").alias("next"))
        now.join(after, "root", "left").select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")).write.parquet(f"{folder}/roots{turn}")


def _upper_levels(words: DataFrame) -> dict[int, Tree]:
    """A tree for each length, fitted on a sample that a hash of the word draws; a length without sampled words has one leaf."""
    total = words.count()
    share = min(1.0, SAMPLE / max(1, total))
    drawn = words.where(F.pmod(F.xxhash64(F.lit("draw"), "word"), F.lit(1 << 20)) < int(share * (1 << 20))) if share < 1 else words
    by_size: dict[int, list[str]] = {}
    for (word,) in drawn.where(F.length("word") <= 64).select("word").toLocalIterator():
        by_size.setdefault(len(word), []).append(word)
    trees = {}
    for size, members in by_size.items():
        members.sort()
        letters = np.unique(points(members)[0])
        trees[size] = Tree(letter_counts(members, letters)[0], letters, max(8, int(LEAF * share)))
    return trees


def _deal(trees: dict[int, Tree]):
    """Each word to its own leaf, to further leaves of its length with a higher number, and to leaves of the next length, if in reach."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            words, n = batch.column("word").to_pylist(), batch.column("n").to_numpy(zero_copy_only=False)
            sizes = np.fromiter(map(len, words), np.int64, len(words))
            for size in np.unique(sizes):
                rows = np.flatnonzero(sizes == size)
                mine = [words[i] for i in rows]
                for goal, radius in ((size, 2), (size + 1, 1)):
                    tree = trees.get(int(goal))
                    if tree is None or len(tree.nodes) == 1:
                        parts = [(0, np.arange(len(rows)))]
                        home = np.zeros(len(rows), np.int64)
                    else:
                        counts, extra = letter_counts(mine, tree.letters)
                        home = tree.home(counts)
                        # the sample may lack letters that other words of a box have, so letters outside the tree count for nothing
                        parts = tree.reach(counts, np.full(len(rows), radius), np.zeros(len(rows), np.int64))
                    for leaf, some in parts:
                        if goal == size:
                            some = some[home[some] <= leaf]
                        if len(some):
                            at = rows[some]
                            own = (home[some] == leaf) & (goal == size)
                            yield pa.RecordBatch.from_arrays(
                                [pa.array(np.full(len(at), goal, np.int32)), pa.array(np.full(len(at), leaf, np.int32)), pa.array(own), batch.column("word").take(pa.array(at)), pa.array(n[at])], names=["size", "leaf", "home", "word", "n"]
                            )

    return run


def _unary(counts: np.ndarray) -> np.ndarray:
    """Counts as bits, so that the distance of two vectors is the number of bits in which they differ."""
    top = counts.max(axis=0) if len(counts) else np.zeros(0, int)
    bits = np.concatenate([np.zeros((len(counts), 0), bool), *[counts[:, [f]] > np.arange(t) for f, t in enumerate(top) if t]], axis=1)
    bits = np.pad(bits, ((0, 0), (0, -bits.shape[1] % 64)))
    return np.packbits(bits, axis=1).view(np.uint64) if bits.shape[1] else np.zeros((len(counts), 1), np.uint64)


def _search(table: pa.Table) -> pa.Table:
    """How many near words each word has in one leaf, and the best of them."""
    words, n, home = table["word"].to_pylist(), table["n"].to_numpy(), table["home"].to_numpy()
    sizes = np.fromiter(map(len, words), np.int64, len(words))
    inside = np.flatnonzero(home)
    pairs = [np.zeros((2, 0), np.int64)]
    if len(inside):
        size = int(sizes[inside[0]])
        flat, _ = points(words)
        begin = np.concatenate([[0], np.cumsum(sizes)[:-1]])
        letters = np.unique(flat)
        counts, none = letter_counts(words, letters)
        bits = _unary(counts)
        tree = Tree(counts[inside], letters, BUCKET)
        radius = np.where(sizes == size, 2, 1)
        for leaf, some in tree.reach(counts, radius, none):
            members = inside[tree.leaves[leaf]]
            for k in range(0, len(some), BLOCK):
                block = some[k : k + BLOCK]
                gap = np.zeros((len(block), len(members)), np.int64)
                for w in range(bits.shape[1]):
                    gap += np.bitwise_count(bits[block, w][:, None] ^ bits[members, w][None, :])
                a, b = np.nonzero(gap == radius[block][:, None])
                a, b = block[a], members[b]
                # two words of this leaf meet twice
                once = ~home[a] | (a < b)
                pairs.append(_one_edit(flat, begin, sizes, a[once], b[once]))
    a, b = np.concatenate(pairs, axis=1)
    one, other = np.concatenate([a, b]), np.concatenate([b, a])
    order = np.empty(len(words), np.int64)
    order[sorted(range(len(words)), key=words.__getitem__)] = np.arange(len(words))
    ranked = np.lexsort((order[other], -n[other], one))
    rows, first, times = np.unique(one[ranked], return_index=True, return_counts=True)
    best = other[ranked][first]
    names = table["word"].combine_chunks()
    return pa.table({"word": names.take(pa.array(rows)), "n_near": pa.array(times.astype(np.int64)), "best_n": pa.array(n[best]), "best": names.take(pa.array(best))})


def _one_edit(flat: np.ndarray, begin: np.ndarray, sizes: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Those pairs that one replaced letter tells apart, or one letter that the second has more."""
    out = []
    same = sizes[a] == sizes[b]
    for some, longer in ((np.flatnonzero(same), 0), (np.flatnonzero(~same), 1)):
        if not len(some):
            continue
        size = int(sizes[a[some[0]]])
        step = max(1, (1 << 22) // max(1, size))
        for k in range(0, len(some), step):
            x, y = a[some[k : k + step]], b[some[k : k + step]]
            place = np.arange(size)
            left = flat[begin[x][:, None] + place]
            front = left == flat[begin[y][:, None] + place]
            if longer:
                back = left == flat[begin[y][:, None] + place + 1]
                head = np.logical_and.accumulate(front, axis=1).sum(axis=1)
                tail = np.logical_and.accumulate(back[:, ::-1], axis=1).sum(axis=1)
                good = head + tail >= size
            else:
                good = front.sum(axis=1) == size - 1
            out.append(np.stack([x[good], y[good]]))
    return np.concatenate(out, axis=1) if out else np.zeros((2, 0), np.int64)
