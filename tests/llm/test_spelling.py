"""Variants against a dictionary of all single deletions, and the trees against all distances."""

import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from tallyhouse.llm import queries, spelling


def plain_words(rows):
    n = Counter()
    for i, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = re.sub("[A-Z]", lambda m: m[0].lower(), run)
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            if h % 97 == 0:
                at = h % len(run)
                run = run[:at] + run[at + 1 :]
            if len(run) >= 5:
                n[run] += 1
    return {w: k for w, k in n.items() if k >= 3}


def near(a, b):
    if len(a) > len(b):
        a, b = b, a
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def plain(n):
    """Words meet under each of their single deletions and themselves."""
    keys = defaultdict(set)
    for w in n:
        for k in {w, *[w[:i] + w[i + 1 :] for i in range(len(w))]}:
            keys[k].add(w)
    close = defaultdict(set)
    for group in keys.values():
        for a in group:
            close[a] |= {b for b in group if b not in close[a] and near(a, b)}
    form = {}
    for w in n:
        best = min(close[w], key=lambda v: (-n[v], v), default=None)
        form[w] = best if best and n[best] >= 2 * n[w] else None
    out = []
    for w in n:
        root = w
        while form[root]:
            root = form[root]
        out.append((w, form[w], root, n[w], len(close[w]), n[form[w]] if form[w] else None))
    return sorted(out)


def got(df):
    assert df.columns == ["word", "form", "root", "n", "n_near", "form_n"]
    return sorted(tuple(r) for r in df.collect())


def test_the_query(spark, sf_dir):
    rows = [(r.doc_id, r.text) for r in queries.table(spark, sf_dir, "documents").collect()]
    want = plain(plain_words(rows))
    assert len(want) > 500 and sum(w[4] for w in want) > 100
    assert got(queries.op11_spelling_variants(spark, sf_dir)) == want


@pytest.mark.parametrize("leaf", [4, 8192])
def test_random_words(spark, monkeypatch, leaf):
    monkeypatch.setattr(spelling, "LEAF", leaf)
    r = random.Random(leaf)
    n = {"".join(r.choice("abcé") for _ in range(r.randint(1, 7))): r.randint(1, 40) for _ in range(1500)} | {"x" * 70 + "y": 5, "x" * 70: 20, "x" * 71: 3, "": 4, "漢字": 2, "漢": 9}
    frame = spark.createDataFrame([*n.items(), (None, 5)], "word string, n long").repartition(4)
    assert got(spelling.variants(frame)) == plain(n)


def test_a_sample_that_lacks_letters(spark, monkeypatch):
    monkeypatch.setattr(spelling, "LEAF", 16)
    monkeypatch.setattr(spelling, "SAMPLE", 300)
    r = random.Random(1)
    n = {"".join(r.choice("abcdefgzßý") for _ in range(r.choice([5, 5, 6]))): r.randint(3, 99) for _ in range(3000)}
    assert got(spelling.variants(spark.createDataFrame(list(n.items()), "word string, n long"))) == plain(n)


def test_edge_rows(spark, documents, edge_cases):
    assert got(spelling.variants(spelling.corpus_words(documents([])))) == []
    more = [(30, "STRASSE straße Straße ÉCOLE école " * 3), (31, "a" * 50000 + " hello hellp " * 3), (31, "a" * 50000 + " hellos"), (None, "a" * 50000 + " hellos hellos")]
    rows = edge_cases + more
    assert got(spelling.variants(spelling.corpus_words(documents(rows)))) == plain(plain_words(rows))


def test_tree_reaches_all_in_range():
    r = np.random.default_rng(4)
    counts = r.integers(0, 3, (400, 6))
    tree = spelling.Tree(counts, np.arange(6), 10)
    leaf = tree.home(counts)
    for radius in (1, 2):
        met = {(int(q), x) for x, rows in tree.reach(counts, np.full(400, radius), np.zeros(400)) for q in rows}
        gap = np.abs(counts[:, None] - counts[None]).sum(axis=2)
        assert all((int(q), int(leaf[v])) in met for q, v in zip(*np.nonzero(gap <= radius)))
        assert len(met) < 400 * len(tree.leaves)
