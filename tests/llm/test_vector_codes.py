"""Codes, errors and codebooks against a plain version without bounds."""

import math
import random
from collections import defaultdict

from tallyhouse.llm import queries, vector_codes


def plain(rows, parts=8, entries=16, rounds=6):
    """(vec_id, code, error) per row and the codebooks, by measuring everything in every round."""
    kept = [(k, lab, [math.floor(4096 * x) for x in v]) for k, v, lab in rows if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    kept.sort(key=lambda r: (r[0] is None, r[0] or 0, r[2]))
    if not kept:
        return [], []
    width = len(kept[0][2]) // parts
    cut = lambda v, p: v[p * width : (p + 1) * width]
    books = [[cut(v, p) for _, _, v in kept[:entries]] for p in range(parts)]
    gap = lambda a, b: sum((x - y) ** 2 for x, y in zip(a, b))
    nearest = lambda a, book: min(range(len(book)), key=lambda e: (gap(a, book[e]), e))
    for _ in range(rounds):
        groups = defaultdict(list)
        for _, _, v in kept:
            for p in range(parts):
                groups[p, nearest(cut(v, p), books[p])].append(cut(v, p))
        for (p, e), members in groups.items():
            books[p][e] = [sum(c) // len(members) for c in zip(*members)]
    out = []
    for k, lab, v in kept:
        code = [nearest(cut(v, p), books[p]) for p in range(parts)]
        out.append((k, lab, "".join(f"{c:02x}" for c in code), sum(gap(cut(v, p), books[p][c]) for p, c in enumerate(code))))
    return out, books


def found(spark, rows, kind="float"):
    frame = spark.createDataFrame(rows, f"vec_id long, embedding array<{kind}>, label int").repartition(3)
    codes, books = vector_codes.compress(frame)
    got = [(r.vec_id, r.label, bytes(r.code).hex(), r.error) for r in codes.collect()]
    return sorted(got, key=str), books


def test_the_query(spark, sf_dir):
    rows = [(r.vec_id, list(r.embedding), r.label) for r in queries.table(spark, sf_dir, "embeddings").collect()]
    want, books = plain(rows)
    sums = defaultdict(int)
    for _, lab, _, e in want:
        sums[lab] += e
    got = queries.op12_vector_codes(spark, sf_dir).collect()
    assert sorted((r.vec_id, r.code, r.error, r.label_error, r.codebooks_sha256) for r in got) == sorted((k, c, e, sums[lab], vector_codes.digest(books)) for k, lab, c, e in want)
    assert sum(r.n_scans for r in got) < 8 * 7 * len(got) * 0.8


def test_ties_repeats_and_rows_left_out(spark):
    r = random.Random(3)
    rows = [(i % 60, [float(r.randint(-2, 2)) / 4096 for _ in range(16)], r.choice([None, 1, 2])) for i in range(150)]
    rows += [(None, [0.5] * 16, 1), (7, None, 1), (-5, [None] + [1.0] * 15, 1), (-6, [float("nan")] * 16, 2), (-7, [float("inf")] + [0.0] * 15, None), (3, rows[3][1], None)]
    want, books = plain(rows)
    assert found(spark, rows) == (sorted(want, key=str), books)


def test_few_rows_large_numbers_and_clusters(spark):
    assert found(spark, []) == ([], [])
    few = [(i, [float(i * j) for j in range(8)], None) for i in range(5)]
    want, books = plain(few)
    assert found(spark, few) == (sorted(want, key=str), books)
    large = [(i, [float((i * 7919 + j * 104729) % 1000) * 100.0 - 20000 for j in range(16)], 1) for i in range(40)]
    want, books = plain(large)
    assert found(spark, large, "double") == (sorted(want, key=str), books)
    r = random.Random(8)
    spread = [(i, [r.gauss((i % 20) * 3, 0.05) for _ in range(16)], i % 3) for i in range(400)]
    want, books = plain(spread)
    assert found(spark, spread, "double") == (sorted(want, key=str), books)


def test_other_lengths_and_clashing_names(spark):
    frame = spark.createDataFrame([(1, [0.1] * 16, 1, "a", 9), (2, [0.2] * 8, 1, "b", 9), (3, [0.3] * 9, 1, "c", 9), (4, [], 1, "d", 9), (5, [0.4] * 16, None, "e", 9)], "vec_id long, embedding array<float>, label int, code string, k int")
    codes, books = vector_codes.compress(frame)
    assert sorted(r.vec_id for r in codes.collect()) == [1, 5] and len(books[0]) == 2
    assert sorted((r.vec_id, r.label_error) for r in vector_codes.with_label_error(codes).collect()) == [(1, 0), (5, 0)]
