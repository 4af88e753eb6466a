import math
import random
import tracemalloc

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tallyhouse.llm import language, queries, toxicity
from tallyhouse.llm.words import slices

VOCABULARY = public_tokenizers.path("piece_bpe_32k.model")


def test_forward_sums_all_segmentations():
    pieces = language.Pieces(VOCABULARY)
    table = np.random.default_rng(0).random((pieces.size, 2))
    table /= table.sum(0)
    known = dict(zip(pieces.hashes.tolist(), pieces.ids.tolist(), strict=True))

    def total(s):
        if not s:
            return np.ones(2, np.longdouble)
        out = table[pieces.size - 256 + s[0]] * total(s[1:])
        for n in range(1, len(s) + 1):
            k = known.get(pieces.hash(s[:n]))
            if k is not None:
                out = out + table[k] * total(s[n:])
        return out

    words = [b"the", b"house", "straße".encode(), b"x", b"\xff\xfe", b"aaaaaaaa"]
    got = language.log_forward(words, pieces, table)
    for w, g in zip(words, got, strict=True):
        assert np.allclose(np.log(total(b" " + w)).astype(float), g)
    assert np.isfinite(language.log_forward([b"ab" * 20000], pieces, table)).all()


def test_language_on_held_out_documents(spark, sf_dir):
    got = queries.op3_language(spark, sf_dir).join(queries.table(spark, sf_dir, "documents"), "doc_id").where("held_out AND lang_pred <> 'und'").agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("int"))).first()[0]
    assert got > 0.95


def test_language_edge_cases(documents, edge_cases):
    docs = documents(edge_cases)
    got = language.predict(docs, language.train(docs, VOCABULARY), VOCABULARY).collect()
    assert len(got) == len(edge_cases)
    by = {r.doc_id: r for r in got}
    assert [by[i].lang_pred for i in (1, 2, 3, 11, 4)] == ["und"] * 4 + ["en"]
    assert all(0 <= r.score <= 1 for r in got)
    none = language.train(documents([]), VOCABULARY)
    assert {r.lang_pred for r in language.predict(docs, none, VOCABULARY).collect()} == {"und"}
    assert language.predict(documents([]), none, VOCABULARY).count() == 0


def test_toxicity_on_held_out_documents(spark):
    sf = "/root/testdata/sf0.1"
    got = queries.op4_toxicity(spark, sf).join(queries.table(spark, sf, "labels"), "doc_id").where("held_out")
    table = {(r.toxic, r.predicted): r["count"] for r in got.groupBy("toxic", "predicted").count().collect()}
    # half of the toxic texts here share no word piece with the few learning rows
    assert table[1, 1] >= 0.6 * (table[1, 1] + table[1, 0])
    assert table.get((0, 1), 0) <= 0.01 * table[0, 0]


def test_swapping_groups_changes_scores_less_with_the_penalty(spark):
    rng = random.Random(4)
    rows = []
    for i in range(400):
        bad = rng.random() < 0.5
        group = "muslims" if rng.random() < (0.9 if bad else 0.3) else "christians"
        rows.append((f"{group} in town {rng.choice(['horrible', 'dreadful']) if bad and rng.random() < 0.8 else rng.choice(['friendly', 'cheerful'])} people {rng.randrange(50)}", int(bad)))
    train = spark.createDataFrame(rows, "text string, toxic int")
    probe = spark.createDataFrame([(0, "muslims in town people"), (1, "christians in town people"), (2, "horrible muslims"), (3, "friendly muslims")], "doc_id long, text string")
    score = lambda weight: {r.doc_id: r.score for r in toxicity.scored(probe, toxicity.train(train, weight=weight)).collect()}
    plain, regular = score(0.0), score(20.0)
    assert abs(regular[0] - regular[1]) < 0.5 * abs(plain[0] - plain[1])
    assert regular[2] > regular[3]


def test_swap():
    assert toxicity.swapped("Women and muslims") == "men and christians"
    assert toxicity.swapped("nobody named") is None


@pytest.mark.parametrize("labels", [[], [0], [1], [0, 1, None, 5]])
def test_toxicity_edge_cases(spark, documents, edge_cases, labels):
    train = spark.createDataFrame([("some words", y) for y in labels] + [(None, 1)], "text string, toxic int")
    docs = documents(edge_cases)
    model = toxicity.train(train)
    got = toxicity.scored(docs, model).collect()
    assert len(got) == len(edge_cases) and all(0 <= r.score <= 1 and not math.isnan(r.score) for r in got)
    assert toxicity.clean(docs, model).columns == docs.columns
    assert toxicity.clean(docs, model).count() == sum(r.score < toxicity.THRESHOLD for r in got)
    assert toxicity.scored(documents([]), model).count() == 0


def test_features_are_counted_in_little_memory():
    """All features of 4 MB of text at once take some 200 MB; in slices they are the same."""
    texts = pa.array([" ".join(f"word{(i * j) % 9973}" for j in range(400)) for i in range(1200)], pa.string())
    place = np.arange(toxicity.BUCKETS)
    whole = sum(len(toxicity.present(texts.slice(a, 400), place)[0]) for a in range(0, 1200, 400))
    tracemalloc.start()
    try:
        found = sum(len(toxicity.present(texts.slice(a, b - a), place)[0]) for a, b in slices(texts, toxicity.SLICE))
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert found == whole and texts.nbytes > 4_000_000
    assert peak < 120e6, peak
