"""Vector compression by codebooks for the parts of vectors, with norm-of-sum bounds.

Components become whole numbers, a vector is cut into equal parts, and each part position has a codebook. Rounds assign
every part to the nearest entry of its codebook and move each entry to the mean of its parts. All sums and distances
that decide are whole numbers, so results do not depend on the order of execution.

A part keeps an upper bound (distance to its entry) and a lower bound (distance to the nearest other entry), each with the
round it was measured in. The codebooks of all rounds are kept: they are small. In a later round a bound is moved by the
true distance between an entry's place then and now, which is at most the sum of the entry's moves in between and mostly
much less. Only parts whose bounds meet are measured anew, first against their own entry, then against all.

The state of a round is written to the shared folder in turn to one of two places, so a lost executor repeats a part of one
round, and the disk holds two states at most. Only codebooks and sums by codebook entry reach the driver.
"""

from __future__ import annotations

import hashlib
import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tallyhouse.session import work_dir

PARTS, ENTRIES, ROUNDS, SCALE = 8, 16, 6, 4096
#: Components from this size on are taken as this size: their squares exceed every result type.
LARGEST = 1 << 60
#: Up to this size 64-bit integers hold all squared distances; larger ones go through Python's integers.
SMALL = 1 << 26
#: Share by which bounds are widened against rounding.
SLACK = 1e-6
STATE = "code binary, near binary, far binary, near_round binary, far_round binary, scans int"


def kept_vectors(vectors: DataFrame, column: str, parts: int) -> DataFrame:
    """Rows whose vector has components, in equal parts, all of them finite numbers."""
    v = F.col(f"`{column}`")
    odd = F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return vectors.where(v.isNotNull() & (F.size(v) > 0) & (F.size(v) % parts == 0) & ~odd)


def whole(vector, scale: int) -> list[int]:
    """Components as whole numbers, rounded down."""
    return [max(-LARGEST, min(LARGEST, int(np.floor(x * scale)) if abs(x) < 1e300 else int(np.sign(x)) * LARGEST)) for x in map(float, vector)]


def compress(vectors: DataFrame, key: str = "vec_id", column: str = "embedding", label: str | None = "label", parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS, scale: int = SCALE) -> tuple[DataFrame, list]:
    """(``key``, ``label``, code binary, error, scans) of every kept vector, and the codebooks as lists by part, entry and position.

    Rows without a vector, or with one that holds a null, NaN or infinity, or that does not cut into equal parts, are left
    out; so are those of another length than the first kept one. First means smallest key, nulls last, equal keys by
    vector. With fewer vectors than ``entries`` the codebooks are that much smaller; an empty table gives no rows and no
    codebooks. Repeated rows count as often as they stand. Columns of other names make no difference. ``scans`` counts
    how often a part of the vector was measured against all entries. An error beyond a long is the largest long.
    """
    if not 0 < entries <= 256:
        raise ValueError("a code has one byte: 1 to 256 entries")
    spark, folder = vectors.sparkSession, work_dir(vectors.sparkSession, "codes")
    rows = kept_vectors(vectors, column, parts).select(F.col(f"`{key}`").alias("k"), (F.col(f"`{label}`") if label else F.lit(None).cast("int")).alias("l"), F.col(f"`{column}`").cast("array<double>").alias("x"))
    least = rows.orderBy(F.col("k").asc_nulls_last(), "x").limit(entries).collect()
    length = len(least[0].x) if least else parts
    first = [whole(r.x, scale) for r in least if len(r.x) == length]
    if least and len(first) < len(least):
        first = [whole(r.x, scale) for r in rows.where(F.size("x") == length).orderBy(F.col("k").asc_nulls_last(), "x").limit(entries).collect()]
    width = length // parts
    history = [_books([[v[p * width : (p + 1) * width] for v in first] for p in range(parts)])] if first else []
    schema = f"k {rows.schema['k'].dataType.simpleString()}, l {rows.schema['l'].dataType.simpleString()}, x array<double>, {STATE}"
    state = rows.where(F.size("x") == length).mapInArrow(_begin(parts, scale), schema)
    for turn in range(rounds + 1 if history else 0):
        place = f"{folder}/state{turn % 2}"
        state.mapInArrow(_assign(history), schema).write.mode("overwrite").parquet(place)
        state = spark.read.parquet(place)
        if turn < rounds:
            history.append(_moved(history[-1], _sums(state, parts)))
    books = [[[int(x) for x in entry] for entry in book] for book in history[-1]] if history else []
    out = state.mapInArrow(_errors(history[-1] if history else None), f"{schema.split(', x ')[0]}, code binary, error bigint, scans int")
    return out.withColumnsRenamed({"k": key, "l": label or "l"}), books


def _books(lists: list) -> np.ndarray:
    large = any(abs(x) > SMALL for part in lists for entry in part for x in entry)
    return np.array(lists, dtype=object if large else np.int64)


def _numbers(column: pa.Array) -> np.ndarray:
    """Components of all rows as whole numbers; they were rounded before, so only the type changes."""
    flat = column.flatten().to_numpy(zero_copy_only=False)
    flat = flat.reshape(len(column), -1) if len(column) else flat.reshape(0, 0)
    if not flat.size or np.abs(flat).max() <= SMALL:
        return flat.astype(np.int64)
    return np.array([[int(x) for x in row] for row in flat], dtype=object)


def _distances(x: np.ndarray, book: np.ndarray) -> np.ndarray:
    """Squared distances of parts to all entries, exactly."""
    gap = x[:, None, :] - book[None, :, :]
    return (gap * gap).sum(axis=2)


def _root(squares: np.ndarray) -> np.ndarray:
    return np.sqrt(squares.astype(np.float64))


def _begin(parts: int, scale: int):
    """Whole components, and a state in which nothing is known."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x, n = batch.column("x"), len(batch)
            with np.errstate(over="ignore"):
                flat = np.clip(np.floor(x.flatten().to_numpy(zero_copy_only=False) * scale), -float(LARGEST), float(LARGEST))
            vectors = pa.ListArray.from_arrays(pa.array((x.offsets.to_numpy() - x.offsets[0].as_py()).astype(np.int32)), pa.array(flat))
            fixed = lambda cell: pa.array([cell] * n, pa.binary())
            unknown = [fixed(bytes(parts)), fixed(struct.pack(f"<{parts}f", *[float("inf")] * parts)), fixed(struct.pack(f"<{parts}f", *[0.0] * parts)), fixed(bytes(parts)), fixed(bytes(parts))]
            yield pa.RecordBatch.from_arrays([*batch.columns[:2], vectors, *unknown, pa.array(np.zeros(n, np.int32))], names=[*batch.schema.names, *[f.split()[0] for f in STATE.split(", ")]])

    return run


def _cells(column: pa.Array, kind: str) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), kind).reshape(len(column), -1).copy()


def _binary(values: np.ndarray) -> pa.Array:
    return pa.array([row.tobytes() for row in values], pa.binary())


def _assign(history: list[np.ndarray]):
    """Give each part the nearest entry of the newest codebook; of equally near ones the first."""
    now = len(history) - 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        moves = [[_root(((history[now][p] - old[p]) ** 2).sum(axis=1)) for p in range(len(old))] for old in history]
        for batch in batches:
            if not len(batch):
                continue
            x = _numbers(batch.column("x"))
            code, near_round, far_round = (_cells(batch.column(c), "u1") for c in ("code", "near_round", "far_round"))
            near, far = (_cells(batch.column(c), "<f4") for c in ("near", "far"))
            scans = batch.column("scans").to_numpy(zero_copy_only=False).copy()
            width = x.shape[1] // code.shape[1]
            for p, book in enumerate(history[now]):
                part = x[:, p * width : (p + 1) * width]
                drift = np.array([m[p] for m in moves])
                own = code[:, p]
                # of the other entries, the one that moved furthest since the lower bound's round
                order = np.sort(drift, axis=1)
                top = order[:, -1]
                second = order[:, -2] if book.shape[0] > 1 else np.zeros(len(drift))
                theirs = drift[far_round[:, p], own]
                others = np.where(theirs >= top[far_round[:, p]], second[far_round[:, p]], top[far_round[:, p]])
                lower = (far[:, p].astype(np.float64) - others) * (1 - SLACK) - SLACK
                upper = (near[:, p].astype(np.float64) + drift[near_round[:, p], own]) * (1 + SLACK) + SLACK
                doubt = np.flatnonzero(upper >= lower)
                if len(doubt):
                    gap = part[doubt] - book[own[doubt]]
                    exact = _root((gap * gap).sum(axis=1))
                    near[doubt, p], near_round[doubt, p] = exact, now
                    doubt = doubt[exact * (1 + SLACK) + SLACK >= lower[doubt]]
                if len(doubt):
                    squares = _distances(part[doubt], book)
                    best = squares.argmin(axis=1) if squares.dtype != object else np.array([min(range(len(row)), key=row.__getitem__) for row in squares])
                    rows = np.arange(len(doubt))
                    roots = _root(squares)
                    near[doubt, p], near_round[doubt, p] = roots[rows, best], now
                    roots[rows, best] = np.inf
                    far[doubt, p], far_round[doubt, p] = roots.min(axis=1), now
                    code[doubt, p] = best
                    scans[doubt] += 1
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], _binary(code), _binary(near), _binary(far), _binary(near_round), _binary(far_round), pa.array(scans)], names=batch.schema.names)

    return run


def _sums(state: DataFrame, parts: int) -> dict[tuple[int, int], tuple[int, list[int]]]:
    """Count and component sums of each codebook entry, added up per task and then by Spark."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[tuple[int, int], list[int]] = {}
        for batch in batches:
            if not len(batch):
                continue
            x, code = _numbers(batch.column("x")), _cells(batch.column("code"), "u1")
            width = x.shape[1] // parts
            for p in range(parts):
                part = x[:, p * width : (p + 1) * width]
                for entry in np.unique(code[:, p]):
                    mine = part[code[:, p] == entry]
                    more = [len(mine), *mine.sum(axis=0)]
                    old = sums.get((p, int(entry)), [0] * len(more))
                    sums[p, int(entry)] = [int(a) + int(b) for a, b in zip(old, more)]
        rows = [(p, e, i, str(v)) for (p, e), values in sums.items() for i, v in enumerate(values)]
        columns = list(zip(*rows)) if rows else [[], [], [], []]
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, (pa.int32(), pa.int32(), pa.int32(), pa.string()))], names=["p", "e", "i", "v"])

    partial = state.select("x", "code").mapInArrow(run, "p int, e int, i int, v string")
    out: dict[tuple[int, int], dict[int, int]] = {}
    for p, e, i, v in partial.groupBy("p", "e", "i").agg(F.sum(F.col("v").cast("decimal(38,0)")).alias("v")).collect():
        out.setdefault((p, e), {})[i] = int(v)
    return {slot: (values[0], [values[i] for i in range(1, len(values))]) for slot, values in out.items()}


def _moved(books: np.ndarray, sums: dict) -> np.ndarray:
    """Each entry at the mean of its parts, rounded down; an entry without parts stays."""
    lists = [[[int(x) for x in entry] for entry in book] for book in books]
    for (p, e), (n, totals) in sums.items():
        lists[p][e] = [t // n for t in totals]
    return _books(lists)


def _errors(books: np.ndarray | None):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not len(batch):
                continue
            x, code = _numbers(batch.column("x")), _cells(batch.column("code"), "u1")
            entries = np.concatenate([books[p][code[:, p]] for p in range(len(books))], axis=1)
            gap = x - entries
            total = [min(int(e), (1 << 63) - 1) for e in (gap * gap).astype(object).sum(axis=1)] if gap.dtype == object else (gap * gap).sum(axis=1)
            yield pa.RecordBatch.from_arrays([*batch.columns[:2], batch.column("code"), pa.array(total, pa.int64()), batch.column("scans")], names=["k", "l", "code", "error", "scans"])

    return run


def digest(books: list) -> str:
    """SHA-256 of all components by part, entry and position, as decimal numbers with commas."""
    return hashlib.sha256(",".join(str(x) for book in books for entry in book for x in entry).encode()).hexdigest()


def with_label_error(codes: DataFrame, label: str = "label") -> DataFrame:
    """The rows with ``label_error``, the sum of errors over equal labels; nulls are one label."""
    total = codes.groupBy(F.col(label).alias("_label")).agg(F.least(F.sum(F.col("error").cast("decimal(38,0)")), F.lit((1 << 63) - 1).cast("decimal(38,0)")).cast("long").alias("label_error"))
    return codes.join(total, F.col(label).eqNullSafe(F.col("_label"))).drop("_label")
