import random
import tracemalloc

import numpy as np
import pyarrow as pa
import pytest

from tallyhouse.llm import decontaminate, line_dedup


def edit_distance(item, words):
    row = [0] * (len(words) + 1)
    for k, w in enumerate(item):
        new = [k + 1]
        for j, x in enumerate(words):
            new.append(min(row[j] + (x != w), row[j + 1] + 1, new[j] + 1))
        row = new
    return min(row)


def test_distance_is_exact():
    rng = np.random.default_rng(1)
    for _ in range(200):
        a, b = rng.integers(0, 4, rng.integers(1, 9)).astype(np.uint64), rng.integers(0, 4, rng.integers(0, 20)).astype(np.uint64)
        assert decontaminate.distance(a, b)[0] == edit_distance(a.tolist(), b.tolist())


def test_recall_and_precision_against_brute_force(spark, documents):
    rng = random.Random(8)
    words = [f"w{i}" for i in range(400)]
    items = [(i, " ".join(rng.choice(words) for _ in range(rng.choice([3, 9, 14, 20, 45])))) for i in range(40)]
    items += [(40, None), (41, ""), (42, "..."), (43, items[3][1])]
    rows = []
    for i in range(300):
        text = [rng.choice(words) for _ in range(80)]
        if i % 2:
            passage = rng.choice(items[:40])[1].split()
            for _ in range(rng.choice([0, 0, 1, 2, len(passage) // 5])):
                at = rng.randrange(len(passage))
                passage[at : at + 1] = rng.choice([[], ["new"], [passage[at], "new"]])
            text[30:30] = passage
        rows.append((i, " ".join(w.upper() if rng.random() < 0.1 else w + rng.choice(["", "", ",", "."]) for w in text)))
    rows += [(900, None), (901, ""), (902, "w1")]
    plain = lambda t: t.lower().replace(",", " ").replace(".", " ").split()
    want = {(d, i) for d, t in rows if t for i, u in items if u and plain(u) and edit_distance(plain(u), plain(t)) <= int(0.2 * len(plain(u)))}
    got = decontaminate.passages(documents(rows), spark.createDataFrame(items, "item_id long, text string")).collect()
    found = {(r.doc_id, r.item_id) for r in got}
    assert len(found) == len(got) and found <= want
    assert len(found) >= 0.95 * len(want)
    exact = {(d, i) for d, t in rows if t for i, u in items if u and plain(u) and " ".join(plain(u)) in " ".join(plain(t))}
    assert exact & want <= found


def test_passages_are_dropped_in_little_memory():
    """All words of 4 MB of text at once take some 140 MB."""
    texts = pa.array([" ".join(f"word{(i * j) % 9973}" for j in range(400)) for i in range(1200)], pa.string())
    item = texts[5].as_py().split()[100:130]
    batch = pa.RecordBatch.from_arrays([pa.array(range(1200), pa.int64()), texts], names=["c0", "c1"])
    run = decontaminate.cleaner([" ".join(item)], 1)
    list(run(iter([batch.slice(0, 10)])))
    tracemalloc.start()
    try:
        kept = [k for b in run(iter([batch])) for k in b.column(0).to_pylist()]
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert texts.nbytes > 4_000_000 and 5 not in kept and len(kept) > 1000
    assert peak < 80e6, peak


def test_no_items_no_documents(spark, documents, edge_cases):
    none = spark.createDataFrame([], "item_id long, text string")
    assert decontaminate.passages(documents(edge_cases), none).count() == 0
    one = spark.createDataFrame([(1, "one two three four five six seven")], "item_id long, text string")
    assert sorted(str(r.doc_id) for r in decontaminate.passages(documents(edge_cases), one).collect()) == ["12", "4", "4", "5", "None"]
    assert decontaminate.passages(documents([]), one).count() == 0


@pytest.mark.parametrize("block", [10, 1 << 20])
def test_blocks_of_items(spark, monkeypatch, block):
    monkeypatch.setattr(decontaminate, "BLOCK_BYTES", block)
    items = spark.createDataFrame([(1, "abc"), (2, "defghijk"), (3, "lm")], "item_id long, text string")
    assert sorted(i for ids, _ in decontaminate.blocks(items) for i in ids) == [1, 2, 3]


@pytest.mark.parametrize("sites", [2, 5])
def test_lines_on_many_sites_go(spark, sites):
    rng = random.Random(9)
    lines = [f"line {i}" for i in range(60)] + ["", " "]
    rows = [(i, rng.choice(["\n", "\n\n"]).join(rng.choice(lines[: rng.choice([10, 62])]) for _ in range(rng.randrange(0, 9))), rng.choice([None, *[f"s{k}" for k in range(12)]]), 5) for i in range(150)]
    rows += [(1000, None, "s1", 5), (1001, "", "s2", 5), rows[3]]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, line long")
    where = {}
    for _, t, s, _ in rows:
        for x in (t or "").split("\n"):
            if x.strip() and s is not None:
                where.setdefault(x.strip(), set()).add(s)
    want = []
    for i, t, _, _ in rows:
        parts = (t or "").split("\n")
        kept = [x for x in parts if not x.strip() or len(where.get(x.strip(), ())) < sites]
        want.append((i, len(parts), len(parts) - len(kept), "\n".join(kept)))
    got = line_dedup.without_boilerplate(docs, sites)
    assert sorted((r.doc_id, r.lines, r.removed, r.clean) for r in got.collect()) == sorted(want)
    assert line_dedup.without_boilerplate(docs.limit(0), sites).count() == 0


@pytest.mark.parametrize("size", [1, 4, 5, 6, 8, 10, 12, 14, 15, 16, 18, 20, 25, 45])
def test_every_edited_passage_is_found(size):
    """For each item length all passages at each number of edits, with the least number of edits."""
    import pyarrow as pa

    rng = random.Random(size)
    for edits in range(int(0.2 * size) + 1):
        items, texts = [], []
        for _ in range(60):
            item = [f"w{rng.randrange(5000)}" for _ in range(size)]
            passage = list(item)
            for at in sorted(rng.sample(range(size), edits), reverse=True):
                passage[at : at + 1] = rng.choice([[], ["new"], [passage[at], "new"]])
            items.append(" ".join(item))
            texts.append([f"v{rng.randrange(5000)}" for _ in range(rng.randrange(30))] + passage + [f"v{rng.randrange(5000)}" for _ in range(rng.randrange(30))])
        keys, docs = pa.array(range(60), pa.int64()), pa.array([" ".join(t) for t in texts])
        (got,) = decontaminate.searcher(list(range(60)), items)(iter([pa.RecordBatch.from_arrays([keys, docs], names=["_key", "_text"])]))
        found = {(r["_key"], r["item_id"]): r["edits"] for r in got.to_pylist()}
        assert all(found[i, i] == edit_distance(items[i].split(), texts[i]) for i in range(60))


def test_items_with_null_and_repeated_ids(spark, documents):
    items = [(0, "zero one two three four"), (None, "red green blue white black"), (None, "salt pepper sugar flour yeast"), (7, "mon tue wed thu fri"), (7, "jan feb mar apr may"), (7, "jan feb mar apr may")]
    rows = [(i, f"before {t} behind") for i, (_, t) in enumerate(items[:5])]
    got = decontaminate.passages(documents(rows), spark.createDataFrame(items, "item_id long, text string")).collect()
    assert sorted([(r.doc_id, r.item_id) for r in got], key=str) == sorted([(0, 0), (1, None), (2, None), (3, 7), (4, 7), (4, 7)], key=str)
