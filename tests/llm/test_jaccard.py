import random
import re

import pytest

from tallyhouse.llm import jaccard


def brute(rows, size, percent):
    words = lambda t: re.findall(r"[^\x20\x09-\x0d]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
    sets = []
    for i, t in rows:
        w = words(t)
        sets.append((i, {tuple(w[k : k + size]) for k in range(max(1, len(w) - size + 1))} if w else set()))
    parent = {i: i for i, _ in rows if i is not None}

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for k, (i, a) in enumerate(sets):
        for j, b in sets[:k]:
            if None not in (i, j) and a and b and 100 * len(a & b) >= percent * len(a | b):
                x, y = sorted((root(i), root(j)))
                parent[y] = x
    return sorted(((i, len(s), None if i is None else root(i)) for i, s in sets), key=str)


@pytest.mark.parametrize(("size", "percent"), [(3, 90), (5, 80)])
def test_components_match_brute_force(spark, documents, edge_cases, size, percent):
    rng = random.Random(size)
    vocabulary = [f"w{i}" for i in range(300)]
    rows = []
    for group in range(25):
        text = [rng.choice(vocabulary) for _ in range(rng.choice([4, 12, 40, 150, 400]))]
        for _ in range(rng.choice([1, 2, 8, 20])):
            copy = list(text)
            for _ in range(rng.choice([0, 0, 1, 1, 2, 4, 9])):
                at = rng.randrange(len(copy) or 1)
                copy[at : at + 1] = rng.choice([[], [rng.choice(vocabulary)], [*copy[at : at + 1], "extra"]])
            rows.append((100 + len(rows), " ".join(copy)))
    rng.shuffle(rows)
    rows += edge_cases
    got = jaccard.linked_components(documents(rows), size, percent).collect()
    assert sorted(((r.doc_id, r.n_shingles, r.component_id) for r in got), key=str) == brute(rows, size, percent)


def test_large_cells_are_joined_in_rings_and_blocks(spark, documents, monkeypatch):
    """Many near copies of one text whose links differ: with tiny blocks the answer stays the same."""
    monkeypatch.setattr(jaccard, "BLOCK", 5)
    rng = random.Random(3)
    text = [f"w{rng.randrange(200)}" for _ in range(120)]
    rows = []
    for i in range(80):
        copy = list(text)
        for _ in range(rng.choice([1, 2, 3, 4, 6])):
            copy[rng.randrange(len(copy))] = f"x{rng.randrange(50)}"
        rows.append((i, " ".join(copy)))
    got = jaccard.linked_components(documents(rows), 3, 90).collect()
    assert sorted(((r.doc_id, r.n_shingles, r.component_id) for r in got), key=str) == brute(rows, 3, 90)


def test_empty_table(documents):
    assert jaccard.linked_components(documents([]), 3, 90).count() == 0


def test_one_row_of_each_group_stays(documents):
    text = " ".join(f"w{i}" for i in range(60))
    kept = jaccard.representatives(documents([(3, text), (1, text + " more"), (2, "other words here"), (4, None), (5, "")]))
    assert sorted(r.doc_id for r in kept.collect()) == [1, 2, 4, 5]
    assert kept.columns == documents([]).columns


def test_linked_sets_share_a_cell():
    import numpy as np

    from tallyhouse.llm.jaccard import cells

    rng = np.random.default_rng(7)
    for percent in (80, 90):
        for size in (1, 4, 9, 10, 19, 20, 50, 333, 2000):
            for _ in range(20):
                one = rng.integers(0, 1 << 63, size, dtype=np.uint64)
                lost = int(rng.integers(0, size * (100 - percent) // 100 + 1))
                grown = int(rng.integers(0, 3)) * size // 100
                other = np.concatenate([one[lost:], rng.integers(0, 1 << 63, grown, dtype=np.uint64)])
                if 100 * (size - lost) < percent * (size + grown) or not (lost or grown):
                    continue
                found, begin = cells(np.concatenate([np.sort(one), np.sort(other)]), np.array([0, size, size + len(other)]), percent)
                assert set(found[: begin[1]]) & set(found[begin[1] :])


def test_repeated_rows_keep_links(spark, documents):
    """q and r each differ from p by one word at an edge and stand twice: no cell may take them for the same member."""
    rng = random.Random(11)
    rows = []
    for i in range(0, 90, 3):
        p = [f"w{rng.randrange(100_000)}" for _ in range(22)]
        rows += [(i, " ".join(p)), *[(i + 1, " ".join([*p[:-1], "x"]))] * 2, *[(i + 2, " ".join(["y", *p[1:]]))] * 2]
    rng.shuffle(rows)
    got = jaccard.linked_components(documents(rows), 3, 90).collect()
    assert sorted(((r.doc_id, r.n_shingles, r.component_id) for r in got), key=str) == brute(rows, 3, 90)


def test_rows_of_a_cell_count_once_over_batches():
    import pyarrow as pa

    from tallyhouse.llm.jaccard import shared_cells

    rows = [(1, 5)] * 3 + [(2, 6)] * 4 + [(3, 6)] * 2 + [(3, 7)] * 3 + [(4, 8)] * 2
    for size in (1, 2, 3, 20):
        parts = [rows[k : k + size] for k in range(0, len(rows), size)]
        batches = [pa.RecordBatch.from_pydict({"cell": [c for c, _ in part], "rep": [r for _, r in part]}) for part in parts]
        got = [(r["cell"], r["rep"]) for b in shared_cells(iter(batches)) for r in b.to_pylist()]
        assert got == [(1, 5), (3, 6), (3, 7), (4, 8)]


def test_distances_to_a_pivot_are_of_one_space(spark):
    """Sets around 512 shingles have sketches of two lengths: linked ones still lie in one ring or in neighbours."""
    import numpy as np

    rng = np.random.default_rng(4)
    make = lambda n: rng.integers(0, 1 << 63, n, dtype=np.uint64)
    pivot, one = make(560), make(510)
    sets = [np.sort(x) for x in (pivot, one, np.concatenate([one, make(8)]))]
    sketch = jaccard.sketches(np.concatenate(sets), np.cumsum([0, *map(len, sets)]))
    assert len(sketch[1]) < len(sketch[2])
    rows = spark.createDataFrame([(i, len(s), bytearray(k)) for i, (s, k) in enumerate(zip(sets, sketch, strict=True))], "rep long, n long, sketch binary")
    large = spark.createDataFrame([(9, i, 0, 3) for i in range(3)], "cell long, rep long, pivot long, size long")
    got = jaccard.measured(large, rows, rows.toDF("pivot", "n_pivot", "sketch_pivot")).collect()
    far = {r.rep: r.far for r in got}
    assert sorted(far) == [1, 2] and abs(far[1] - far[2]) <= 8


def test_rows_of_a_ring_grow_with_its_members(spark):
    """A ring that is nearly all one component has a row per member and block of strays, not one per member and block."""
    made = []
    for size in (4096, 16384):
        named = spark.range(size).selectExpr("1L AS cell", "0L AS ring", "id AS rep", "TRUE AS home", "CASE WHEN id % 512 = 7 THEN id ELSE 0 END AS component")
        made.append(jaccard.paired(named).count())
        assert made[-1] < 2 * size
    assert made[1] < 5 * made[0]


def test_all_pairs_of_components_meet_once(spark, monkeypatch):
    monkeypatch.setattr(jaccard, "BLOCK", 4)
    for kinds in (2, 3, 30):
        component = {i: i % kinds if i % 3 else 0 for i in range(60)}
        named = spark.createDataFrame([(1, 0, i, True, c) for i, c in component.items()], "cell long, ring long, rep long, home boolean, component long")
        groups = {}
        for r in jaccard.paired(named).collect():
            groups.setdefault(r.group, []).append((r.rep, r.component, r.block))
        met = []
        for rows in groups.values():
            lone = len({b for _, _, b in rows}) == 1
            met += [tuple(sorted((x, y))) for k, (x, cx, bx) in enumerate(rows) for y, cy, by in rows[:k] if cx != cy and (lone or bx != by)]
        assert set(met) == {(i, j) for i in range(60) for j in range(i + 1, 60) if component[i] != component[j]}
        assert max(map(len, groups.values())) <= 8 * 4


def test_later_rounds_go_on_in_open_groups_only(spark):
    """Of pairs left out, only those between components that are still apart open their group again."""
    cut = spark.createDataFrame([(5, 1, 10), (6, 1, 10), (5, 2, 20), (7, 8, 30), (7, 3, 40)], "a long, b long, group long")
    component = spark.createDataFrame([(0, 0), (1, 0), (5, 0), (6, 0), (3, 3), (7, 3)], "node long, component long")
    assert sorted(r.group for r in jaccard.still_open(cut, component).collect()) == [20, 30]


def test_rings_are_dealt_once(spark, documents, monkeypatch):
    """Near copies whose links take several rounds: members go into groups once, and all links are found."""
    monkeypatch.setattr(jaccard, "BLOCK", 5)
    dealt, paired = [], jaccard.paired
    monkeypatch.setattr(jaccard, "paired", lambda named: dealt.append(1) or paired(named))
    rng = random.Random(8)
    text = [f"w{rng.randrange(200)}" for _ in range(90)]
    rows = []
    for i in range(60):
        copy = list(text)
        for _ in range(rng.choice([1, 2, 3, 4])):
            copy[rng.randrange(len(copy))] = f"x{rng.randrange(30)}"
        rows.append((i, " ".join(copy)))
    got = jaccard.linked_components(documents(rows), 3, 90).collect()
    assert sorted(((r.doc_id, r.n_shingles, r.component_id) for r in got), key=str) == brute(rows, 3, 90)
    assert len(dealt) == 1
