"""Similarity join of documents by the Jaccard distance of their word shingles, as a metric-space join.

Documents that are unrelated all have distance 1 of each other, so regions around sampled documents would hold
everything. The join therefore descends through metrics that never exceed the distance in question, and in each the
triangle inequality says which documents a region must also receive:

1. *Size.* The pivots are sizes in geometric order and a document's home is the region of its size. Linked sets differ in size by
   the threshold at most, so the documents within that window below a region are replicated into it.
2. *Projections.* In a region, linked sets differ by at most ``m`` shingles. The shingles are dealt into more than
   ``m`` classes by hash, so linked sets are equal in some class; the distance there is 0. Each
   distinct projection is a pivot, its Voronoi region (a cell) holds the documents with exactly this projection, and the window is
   empty. A third more classes are dealt than needed and each set uses its ``m + 1`` fullest only: linked sets are still equal in one that
   both use, and classes of one or two shingles, which unrelated documents share by chance, drop out. Cells with equal members are one cell.
3. *Distance to a pivot document.* In a cell, the least document is the pivot. Documents linked to it need no
   comparison with each other for their component. Cells that then still hold several components are joined:
   a parity sketch maps sets into Hamming space, where distances never exceed the number of differing shingles. A large cell is cut
   into rings by sketch distance to its pivot; linked documents lie in one ring or in neighbours, so each
   ring also receives the ring before it. In a ring only members of different components are compared: blocks of the
   largest component meet blocks of the others, and these each other.

Whatever passes goes to an exact comparison of the sets. Pairs inside one component are never compared. A round compares the
nearest only; the next one goes on in those groups alone that have left out pairs between components that are still apart, until
no group has, so the components are those of all links.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from tallyhouse.llm.bloom import possible
from tallyhouse.llm.components import components, files
from tallyhouse.llm.words import lean, mix, shingle_sets, slices
from tallyhouse.session import work_dir

RATIO = 1.5
SPARE = 3
BITS = 1024
BLOCK = 1024
#: Bytes of text at once: every byte, word and shingle of a slice is held as 8-byte numbers in several arrays.
SLICE = 1 << 20


def region_starts(most: int) -> np.ndarray:
    """Least size of each region, up to the one that holds ``most`` and one more."""
    out = [1]
    while out[-1] <= most:
        out.append(max(out[-1] + 1, int(np.ceil(out[-1] * RATIO))))
    return np.array([*out, max(out[-1] + 1, int(np.ceil(out[-1] * RATIO)))])


def differing(a, b, percent: int):
    """Most shingles in which linked sets of sizes a and b differ."""
    return (100 - percent) * (a + b) // (100 + percent)


def cells(flat: np.ndarray, bounds: np.ndarray, percent: int) -> tuple[np.ndarray, np.ndarray]:
    """Cells of each set, and where each set's begin."""
    n = np.diff(bounds)
    starts = region_starts(int(n.max(initial=1)) * 100 // percent + 1)
    home, last = np.searchsorted(starts, n, "right") - 1, np.searchsorted(starts, n * 100 // percent, "right") - 1
    doc = np.repeat(np.arange(len(n)), n)
    mixed = mix(flat + np.uint64(0x5851F42D4C957F2D))
    out, owner = [], []
    step = 0
    while True:
        region = home + step
        live = (n > 0) & (region <= last)
        if not live.any():
            break
        region = np.where(live, region, 0)
        high = starts[region + 1] - 1
        m = differing(high, high, percent)
        live &= m > 0
        k = np.where(live, m + 2 + m // SPARE, 0)
        begin = np.cumsum(k) - k
        element = live[doc]
        d = doc[element]
        at = begin[d] + (flat[element] % k[d].astype(np.uint64)).astype(np.int64)
        total = int(k.sum())
        sums = np.zeros(total, np.uint64)
        np.add.at(sums, at, mixed[element])
        held = np.bincount(at, minlength=total)
        of = np.repeat(np.arange(len(n)), k)
        # by number of shingles, then place: the first of the equal classes is among the first m + 1 of both sets
        order = np.argsort(of * (int(held.max(initial=0)) + 1) - held, kind="stable")
        use = np.empty(total, bool)
        use[order] = np.arange(total) - begin[of] <= m[of]
        place = (region[of].astype(np.uint64) << np.uint64(32)) + (np.arange(total) - begin[of]).astype(np.uint64)
        out.append(mix(sums + mix(place))[use])
        owner.append(of[use])
        step += 1
    if not out:
        return np.zeros(0, np.int64), np.zeros(len(n) + 1, np.int64)
    out, owner = np.concatenate(out), np.concatenate(owner)
    order = np.argsort(owner, kind="stable")
    return out[order].view(np.int64), np.searchsorted(owner[order], np.arange(len(n) + 1))


def sketches(flat: np.ndarray, bounds: np.ndarray) -> list[bytes]:
    """Parities of each set by hash: two sketches differ in at most as many bits as the sets in shingles.

    A set has at least two bits a shingle and ``BITS``, a power of two, so a sketch folds into a shorter one by halves.
    """
    n = np.diff(bounds)
    bits = np.maximum(BITS, 1 << np.ceil(np.log2(np.maximum(n, 1) * 2)).astype(np.int64))
    begin = np.cumsum(bits) - bits
    doc = np.repeat(np.arange(len(n)), n)
    at = begin[doc] + (mix(flat) % bits[doc].astype(np.uint64)).astype(np.int64)
    odd = np.zeros(int(bits.sum()), bool)
    where, times = np.unique(at, return_counts=True)
    odd[where[times % 2 == 1]] = True
    packed = np.packbits(odd).tobytes()
    return [packed[a // 8 : (a + b) // 8] for a, b in zip(begin.tolist(), bits.tolist(), strict=True)]


def folded(sketch: list[bytes], size: int) -> np.ndarray:
    """Sketches at one length in bytes, as rows of words."""
    out = np.zeros((len(sketch), size // 8), np.uint64)
    lengths = np.fromiter(map(len, sketch), np.int64, len(sketch))
    for length in np.unique(lengths):
        at = np.flatnonzero(lengths == length)
        rows = np.frombuffer(b"".join(sketch[i] for i in at), np.uint64).reshape(len(at), -1, size // 8)
        out[at] = np.bitwise_xor.reduce(rows, axis=1)
    return out


def distances(left: list[bytes], right: list[bytes], size: np.ndarray | None = None) -> np.ndarray:
    """Sketch distance of each pair, at its ``size`` in bytes or else at the shorter length of the two."""
    if size is None:
        size = np.minimum(np.fromiter(map(len, left), np.int64, len(left)), np.fromiter(map(len, right), np.int64, len(right)))
    out = np.zeros(len(left), np.int64)
    for length in np.unique(size):
        at = np.flatnonzero(size == length)
        out[at] = np.bitwise_count(folded([left[i] for i in at], int(length)) ^ folded([right[i] for i in at], int(length))).sum(1)
    return out


def embed(docs: DataFrame, words: int, percent: int, text: str, key: str) -> DataFrame:
    """Key, size, 128-bit print, sketch and cells of each document."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b in slices(batch.column(1), SLICE, rows=2000):
                flat, bounds = shingle_sets(batch.column(1).slice(a, b - a), words)
                of, begin = cells(flat, bounds, percent)
                prints = [xxhash.xxh3_128_digest(flat[bounds[i] : bounds[i + 1]].tobytes()) for i in range(b - a)]
                sketch = sketches(flat, bounds)
                yield pa.RecordBatch.from_arrays([
                    batch.column(0).slice(a, b - a), pa.array(np.diff(bounds), pa.int64()), pa.array(prints, pa.binary()), pa.array(sketch, pa.binary()), pa.ListArray.from_arrays(pa.array(begin, pa.int32()), pa.array(of, pa.int64())),
                ], names=["key", "n", "print", "sketch", "cells"])

    return docs.select(F.col(f"`{key}`").cast("long").alias("key"), F.col(f"`{text}`").alias("text")).mapInArrow(lean(run), "key long, n long, print binary, sketch binary, cells array<long>")


def shared_cells(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of rows (cell, rep) sorted by both, each once, those whose cell has other documents; a cell at the edge of the partition may, so it stays."""
    held_cell, held_rep, first = np.zeros(0, np.int64), np.zeros(0, np.int64), True
    for batch in batches:
        cell = np.concatenate([held_cell, batch.column(0).to_numpy()])
        rep = np.concatenate([held_rep, batch.column(1).to_numpy()])
        if not len(cell):
            continue
        fresh = np.ones(len(cell), bool)  # a repeated row is no further member
        fresh[1:] = (cell[1:] != cell[:-1]) | (rep[1:] != rep[:-1])
        cell, rep = cell[fresh], rep[fresh]
        keep = np.zeros(len(cell), bool)
        same = cell[1:] == cell[:-1]
        keep[1:] |= same
        keep[:-1] |= same
        if first:
            keep |= cell == cell[0]
        tail = int(np.searchsorted(cell, cell[-1]))  # may go on in the next batch
        first = first and not tail
        held_cell, held_rep = cell[tail:], rep[tail:]
        yield pa.RecordBatch.from_pydict({"cell": cell[:tail][keep[:tail]], "rep": rep[:tail][keep[:tail]]})
    yield pa.RecordBatch.from_pydict({"cell": held_cell, "rep": held_rep})


def verified(pairs: DataFrame, texts: DataFrame, words: int, percent: int) -> DataFrame:
    """The pairs (a, b) whose sets are linked, by exact comparison."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b in slices(batch.column(2), SLICE):
                part = batch.slice(a, b - a)
                left, right = part.column(2).dictionary_encode(), part.column(3).dictionary_encode()
                sets = [shingle_sets(x.dictionary, words) for x in (left, right)]
                keep = []
                for i, j in zip(left.indices.to_pylist(), right.indices.to_pylist(), strict=True):
                    x, y = (s[0][s[1][k] : s[1][k + 1]] for s, k in zip(sets, (i, j), strict=True))
                    both = len(np.intersect1d(x, y, assume_unique=True))
                    keep.append(100 * both >= percent * (len(x) + len(y) - both) > 0)
                yield part.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    # only texts that some pair may need are shuffled; the filter has a bounded size and lets through some more
    needed = pairs.select(F.col("a").alias("rep")).unionByName(pairs.select(F.col("b").alias("rep"))).distinct()
    texts = possible(texts, needed, "rep")
    left = texts.select(F.col("rep").alias("a"), F.col("text").alias("text_a"))
    right = texts.select(F.col("rep").alias("b"), F.col("text").alias("text_b"))
    return pairs.select("a", "b").join(left, "a").join(right, "b").select("a", "b", "text_a", "text_b").mapInArrow(lean(run), "a long, b long").distinct()


def near(far: np.ndarray, n: np.ndarray, k: np.ndarray, percent: int) -> np.ndarray:
    """Whether sketches are so near, and sizes so alike, that the sets may be linked."""
    return (far <= differing(n, k, percent)) & (np.minimum(n, k) * 100 >= percent * np.maximum(n, k))


def close_to_pivot(percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            far = distances(batch.column("sketch_a").to_pylist(), batch.column("sketch_b").to_pylist())
            yield batch.select(["a", "b"]).filter(pa.array(near(far, batch.column("n_a").to_numpy(), batch.column("n_b").to_numpy(), percent)))

    return run


def across(percent: int, most: int):
    """Pairs (a, b) of one group in different components whose sketches are near, for each document the ``most`` nearest of each component.

    Rows with a ``group`` are no pairs: there document a has nearer and further documents of component b, and the further were left out.
    """

    def pairs(rows: list[pa.RecordBatch]) -> pa.RecordBatch:
        t = pa.Table.from_batches(rows)
        rep, comp, n, block, home = (t.column(c).to_numpy() for c in ("rep", "component", "n", "block", "home"))
        sketch = t.column("sketch").to_pylist()
        sketch = folded(sketch, min(map(len, sketch)))
        lone = (block == block[0]).all()
        a, b, cut = [], [], []
        for i in range(len(t) - 1):
            rest = slice(i + 1, None)
            other = (comp[rest] != comp[i]) & (home[rest] | home[i])
            if not lone:
                other &= block[rest] != block[i]
            at = np.flatnonzero(other) + i + 1
            if not len(at):
                continue
            far = np.bitwise_count(sketch[at] ^ sketch[i]).sum(1).astype(np.int64)
            ok = near(far, n[at], np.full(len(at), n[i]), percent)
            at, far = at[ok], far[ok]
            order = np.lexsort((rep[at], far, comp[at]))
            at = at[order]
            c = comp[at]
            nth = np.arange(len(at)) - np.searchsorted(c, c)
            cut += [(rep[i], x) for x in c[nth == most].tolist()]
            at = at[nth < most]
            a += [rep[i]] * len(at)
            b += rep[at].tolist()
        a, b, cut = np.array(a, np.int64), np.array(b, np.int64), np.array(cut, np.int64).reshape(-1, 2)
        group = pa.array([None] * len(a) + [t.column("group")[0].as_py()] * len(cut), pa.int64())
        return pa.RecordBatch.from_pydict({"a": np.concatenate([np.minimum(a, b), cut[:, 0]]), "b": np.concatenate([np.maximum(a, b), cut[:, 1]]), "group": group})

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        for batch in batches:
            if not len(batch):
                continue
            group = batch.column("group").to_numpy()
            edges = [0, *(np.flatnonzero(np.diff(group)) + 1).tolist(), len(batch)]
            for a, b in zip(edges, edges[1:], strict=False):
                if held and held[0].column("group")[0].as_py() != group[a]:
                    yield pairs(held)
                    held = []
                held.append(batch.slice(a, b - a))
        if held:
            yield pairs(held)

    return run


def linked_components(docs: DataFrame, words: int = 5, percent: int = 80, text: str = "text", key: str = "doc_id") -> DataFrame:
    """One row per input row: key, ``n_shingles`` and ``component_id``, the least key reachable over links.

    Two documents link when they share at least ``percent`` of the shingles that either has. A text with fewer words has one
    shingle, its whole sequence; a null text or one without words has none and links with nothing. Rows with one key are one document. A null key keeps its
    row, links with nothing and has no component. An empty table gives no rows.
    """
    spark, folder = docs.sparkSession, work_dir(docs.sparkSession, "jaccard")
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))

    def saved(df: DataFrame, name: str, rows: int | None = None) -> DataFrame:
        """``rows``: about how many rows the last, light stage of ``df`` makes, so that it doesn't write a tiny file per shuffle partition."""
        (df if rows is None else df.coalesce(files(rows))).write.option("compression", "zstd").parquet(f"{folder}/{name}")
        return spark.read.parquet(f"{folder}/{name}")

    embedded = saved(embed(docs, words, percent, text, key), "embedded")
    real = embedded.where("n > 0 AND key IS NOT NULL")
    same = real.groupBy("print").agg(F.min("key").alias("rep"), F.count(F.lit(1)).alias("copies"))
    # every row's cells, so that only 16 bytes a cell are moved; copies leave again where cells turn out to be shared.
    # Rows of one key meet in one partition and count once: marks over repeated rows would cancel, and unequal cells pass for equal
    found = real.select(F.explode("cells").alias("cell"), F.col("key").alias("rep")).repartitionByRange(parts, "cell", "rep").sortWithinPartitions("cell", "rep").mapInArrow(lean(shared_cells), "cell long, rep long")
    documents = embedded.count()
    multi = saved(found.join(same.select("rep").distinct(), "rep", "left_semi"), "multi", 4 * documents)
    held = multi.count()
    sizes = multi.groupBy("cell").agg(F.min("rep").alias("pivot"), F.count(F.lit(1)).alias("size"), F.bit_xor(F.xxhash64("rep")).alias("x"), F.bit_xor(F.xxhash64(F.lit(1), "rep")).alias("y")).where("size > 1")
    distinct_cells = sizes.groupBy("pivot", "size", "x", "y").agg(F.min("cell").alias("cell")).select("cell", "pivot", "size")
    members = saved(multi.join(distinct_cells, "cell").distinct(), "members", held)
    wanted = members.select("rep").distinct()
    sketch = saved(real.select(F.col("key").alias("rep"), "n", "sketch").join(wanted, "rep", "left_semi").dropDuplicates(["rep"]), "sketches", documents)
    texts = docs.select(F.col(f"`{key}`").cast("long").alias("rep"), F.col(f"`{text}`").alias("text"))

    side = lambda c: sketch.select(F.col("rep").alias(c), F.col("n").alias(f"n_{c}"), F.col("sketch").alias(f"sketch_{c}"))
    stars = members.where("rep <> pivot").select(F.col("rep").alias("a"), F.col("pivot").alias("b")).distinct()
    tried = saved(stars.join(side("a"), "a").join(side("b"), "b").mapInArrow(lean(close_to_pivot(percent)), "a long, b long"), "tried-0", held)
    links = saved(verified(tried, texts, words, percent), "links-0", tried.count())
    component = components(links)
    tried = tried.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
    # a pivot has met all members of its cell, so only the others are compared
    placed = saved(grouped(saved(measured(members.where(F.col("size") > BLOCK), sketch, side("pivot")), "far", held), members, percent), "placed", held)
    # dealt once: later rounds go on in the groups that have left out pairs
    groups = saved(paired(named(placed, component)), "groups", held)
    open_groups, turn, most = groups, 0, 1
    while True:
        turn += 1
        rows = named(open_groups.drop("component"), component).join(sketch, "rep").select("group", "rep", "component", "n", "sketch", "block", "home")
        found = saved(rows.repartition(parts, "group").sortWithinPartitions("group").mapInArrow(lean(across(percent, most)), "a long, b long, group long").distinct(), f"pairs-{turn}", held)
        pairs = found.where("group IS NULL").select("a", "b")
        new = saved(pairs.join(tried, ["a", "b"], "left_anti"), f"tried-{turn}", pairs.count())
        tried = tried.unionByName(new)
        fresh = None if new.isEmpty() else saved(verified(new, texts, words, percent), f"links-{turn}", new.count())
        if fresh is None or fresh.isEmpty():
            most *= 16
        else:
            component = components(fresh.unionByName(component.select(F.col("node").alias("a"), F.col("component").alias("b"))))
        live = saved(still_open(found.where("group IS NOT NULL"), component), f"open-{turn}", held)
        if live.isEmpty():
            break
        open_groups = groups.join(live, "group", "left_semi")
    # copies and linked documents only; all others are their own component
    known = same.join(component.withColumnRenamed("node", "rep"), "rep", "left").where("copies > 1 OR component IS NOT NULL").select("print", F.coalesce("component", "rep").alias("component"))
    salts = 8
    known = known.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    rows = embedded.select("key", "n", "print", F.pmod(F.xxhash64("key"), F.lit(salts)).cast("int").alias("salt"))
    out = rows.join(known.hint("merge"), ["print", "salt"], "left")
    own = F.when(F.col("key").isNotNull(), F.when(F.col("n") > 0, F.coalesce("component", "key")).otherwise(F.col("key")))
    return out.select(F.col("key").alias(key), F.col("n").alias("n_shingles"), own.alias("component_id"))


def named(rows: DataFrame, component: DataFrame) -> DataFrame:
    """``rows`` with the component of their ``rep``; a document without links is its own."""
    return rows.join(component.withColumnRenamed("node", "rep"), "rep", "left").withColumn("component", F.coalesce("component", "rep"))


def still_open(cut: DataFrame, component: DataFrame) -> DataFrame:
    """The groups in which a document and a component, from rows (a, b, group) of pairs left out, are still apart.

    A component is named by its least document, so its name leads to what it has become part of. All other groups are
    done: their near pairs were compared or lie inside one component, and components only grow.
    """
    of = lambda c: component.select(F.col("node").alias(c), F.col("component").alias(f"{c}_in"))
    ends = cut.join(of("a"), "a", "left").join(of("b"), "b", "left")
    return ends.where(F.coalesce("a_in", "a") != F.coalesce("b_in", "b")).select("group").distinct()


def measured(large: DataFrame, sketch: DataFrame, pivots: DataFrame) -> DataFrame:
    """Members of large cells, without the pivot, with their size and their sketch distance to it.

    All sketches of a cell are folded to its shortest, the pivot's included: only in one space do two distances to the pivot
    differ by no more than the members do from each other.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            far = distances(batch.column("sketch").to_pylist(), batch.column("sketch_pivot").to_pylist(), batch.column("least").to_numpy())
            yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in ("cell", "rep", "n")], pa.array(far)], names=["cell", "rep", "n", "far"])

    least = large.join(sketch.select("rep", F.length("sketch").cast("long").alias("bytes")), "rep").groupBy("cell").agg(F.min("bytes").alias("least"))
    rows = large.where("rep <> pivot").join(least, "cell").join(sketch, "rep").join(pivots, "pivot")
    return rows.select("cell", "rep", "n", "sketch", "sketch_pivot", "least").mapInArrow(lean(run), "cell long, rep long, n long, far long")


def grouped(far: DataFrame, members: DataFrame, percent: int) -> DataFrame:
    """Members that are no pivots, with their ring: cells of up to a block are one ring, large ones are cut by distance to the pivot."""
    small = members.where((F.col("size") > 2) & (F.col("size") <= BLOCK) & (F.col("rep") != F.col("pivot")))
    small = small.select("cell", "rep", F.lit(0).cast("long").alias("ring"), F.lit(True).alias("home"))
    # no pair of the cell is linked over more than this sketch distance
    width = far.groupBy("cell").agg(F.greatest(F.lit(1), F.expr(f"(100 - {percent}) * 2 * max(n) div (100 + {percent})")).alias("width"))
    ring = (F.col("far") / F.col("width")).cast("long")
    rings = far.join(width, "cell").select("cell", "rep", F.explode(F.array(F.struct(ring.alias("ring"), F.lit(True).alias("home")), F.struct((ring + 1).alias("ring"), F.lit(False).alias("home")))).alias("r"))
    return small.unionByName(rings.select("cell", "rep", "r.ring", "r.home"))


def paired(named: DataFrame) -> DataFrame:
    """Members of rings with several components, dealt into groups of at most about two blocks in which pairs are compared.

    Pairs of one component need no comparison, so the largest component of a ring, its body, is never compared with itself: each
    block of the body meets each block of the others, the strays, and blocks of strays meet each other. A ring that is
    nearly all body thus has about a row per member, however large it is. Rows: ``group``, and ``block``, which two members of
    a group must differ in unless it is the same for the whole group.
    """
    shape = (
        named.groupBy("cell", "ring", "component").agg(F.count(F.lit(1)).alias("n"))
        .groupBy("cell", "ring").agg(F.max(F.struct("n", "component")).alias("body"), F.sum("n").alias("all"), F.count(F.lit(1)).alias("kinds")).where("kinds > 1")
    )
    blocks = lambda n: F.ceil(n / F.lit(BLOCK)).cast("int")
    shape = shape.select("cell", "ring", F.col("body.component").alias("body"), blocks(F.col("body.n")).alias("bodies"), blocks(F.col("all") - F.col("body.n")).alias("strays"), (F.col("all") <= BLOCK).alias("lone"))
    inside = F.col("component") == F.col("body")
    rows = named.join(shape, ["cell", "ring"]).withColumn("own", F.pmod(F.xxhash64("rep"), F.when(inside, F.col("bodies")).otherwise(F.col("strays"))).cast("int"))
    place = lambda kind, x, y, block: F.struct(F.lit(kind).alias("kind"), x.alias("x"), y.alias("y"), block.alias("block"))
    none, own = F.lit(0), F.col("own")
    upto = lambda n: F.sequence(F.lit(0), F.col(n) - 1)
    body = F.transform(upto("strays"), lambda j: place(1, own, j, none))
    stray = F.concat(F.transform(upto("bodies"), lambda i: place(1, i, own, F.lit(1))), F.transform(upto("strays"), lambda j: place(2, F.least(own, j), F.greatest(own, j), own)))
    places = F.when(F.col("lone"), F.array(place(0, none, none, none))).when(inside, body).otherwise(stray)
    return rows.withColumn("p", F.explode(places)).select(F.xxhash64("cell", "ring", "p.kind", "p.x", "p.y").alias("group"), "rep", "component", "home", F.col("p.block").alias("block"))


def representatives(docs: DataFrame, words: int = 5, percent: int = 80, text: str = "text", key: str = "doc_id") -> DataFrame:
    """The rows of ``docs`` that are the least document of their component, with all their columns, whatever their names; rows with a null key stay."""
    found = linked_components(docs, words, percent, text, key)
    name = "_gone"
    while name in docs.columns:
        name += "_"
    gone = found.where(F.col("component_id") != F.col(key)).select(F.col(key).alias(name)).distinct()
    return docs.join(gone, docs[f"`{key}`"].cast("long") == gone[name], "left_anti")
