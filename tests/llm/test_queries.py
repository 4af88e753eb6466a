"""The registered queries against their check SQL, and the pipeline stage by stage."""

import duckdb
import pytest

import corpus_pipeline
from tallyhouse.llm import decontaminate, queries
from tools_check import TABLES, normal


@pytest.mark.parametrize("name", sorted(queries.CHECKS))
def test_check_sql(spark, sf_dir, name):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    a, b = normal(queries.QUERIES[name](spark, sf_dir).toPandas()), normal(con.execute(queries.CHECKS[name]).df())
    assert a.equals(b)


@pytest.mark.parametrize("name", sorted(set(queries.QUERIES) - set(queries.CHECKS) - {"pipeline"}))
def test_each_document_has_its_rows(spark, sf_dir, name):
    got = queries.QUERIES[name](spark, sf_dir)
    key, table = {"op10": ("page_id", "pages"), "op11": ("word", None), "op12": ("vec_id", "embeddings")}.get(name.split("_")[0], ("doc_id", "documents"))
    if not table:
        return
    all_ids = {r[0] for r in queries.table(spark, sf_dir, table).select(key).collect()}
    ids = [r[0] for r in got.select(key).collect()]
    if name.startswith("op7"):
        assert set(ids) <= all_ids
    elif name.startswith("op8"):
        assert set(ids) == all_ids
    else:
        assert sorted(ids) == sorted(all_ids)


def test_stages_take_effect(spark, sf_dir):
    docs = queries.table(spark, sf_dir, "documents")
    held = decontaminate.passages(docs, queries.table(spark, sf_dir, "benchmark"))
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert len(names) == 5
    for name, stage in corpus_pipeline.STAGES[1:-1]:
        kept = stage(spark, docs, sf_dir)
        assert kept.columns == docs.columns
        assert 0 < kept.count() <= docs.count()
        if name == "decontamination":
            gone = {r.doc_id for r in held.collect()}
            assert {r.doc_id for r in kept.collect()} == {r.doc_id for r in docs.collect()} - gone


def test_pipeline_on_an_empty_table(spark, tmp_path, sf_dir):
    for t in ("documents", "labels", "benchmark"):
        spark.read.parquet(f"{sf_dir}/{t}.parquet").limit(0).write.parquet(str(tmp_path / f"{t}.parquet"))
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0


def test_contaminated_rows_go_whatever_their_key(spark, tmp_path, documents):
    """A null key with a passage goes; a clean row stays though another row of its key goes."""
    item = "salt pepper sugar flour yeast water"
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    docs = documents([(None, f"take {item} now"), (None, "clean"), (5, f"again {item}"), (5, "clean too"), (6, None), (7, "")])
    kept = corpus_pipeline.drop_contaminated(spark, docs, str(tmp_path))
    assert kept.columns == docs.columns
    assert sorted(((r.doc_id, r.text) for r in kept.collect()), key=str) == sorted([(None, "clean"), (5, "clean too"), (6, None), (7, "")], key=str)


@pytest.fixture
def odd_tables(spark, tmp_path):
    """Documents whose columns are named like what the stages make, with null and repeated keys, null and long texts, ties and copies."""
    bench = "salt pepper sugar flour yeast water butter"
    rude = "you stupid idiot go away now"
    labels = [(1000 + i, 1, int(i % 2)) for i in range(60)]
    near = " ".join(f"w{i}" for i in range(80))
    rows = [(1000 + i, f"{rude} {i % 7}" if i % 2 else f"a calm day by the sea {i % 7} with {i} boats") for i in range(60)]
    rows += [(1, "same text"), (1, "same text"), (2, "same  text"), (None, "same text"), (None, "nobody's"), (None, None), (3, None), (4, ""), (5, near), (6, near + " more"), (5, "another row of key five")]
    rows += [(7, f"take {bench} home"), (None, f"and {bench} again"), (8, " ".join(f"long{i * i % 4001}" for i in range(30_000))), (9, rude)]
    columns = "doc_id long, text string, keep_id string, group_size int, kept boolean, text_sha256 string, _gone long, _id long, _row string, sketch string, `a.b` string"
    docs = spark.createDataFrame([(i, t, f"mine {n}", n, n % 2 == 0, "yes", n, -n, "r", "s", "dot") for n, (i, t) in enumerate(rows)], columns)
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    spark.createDataFrame([(1, bench), (None, None)], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    return str(tmp_path)


def test_each_stage_keeps_rows_as_they_are(spark, odd_tables):
    docs = queries.table(spark, odd_tables, "documents")
    before = {tuple(r) for r in docs.collect()}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        kept = stage(spark, docs, odd_tables)
        assert kept.columns == docs.columns and kept.schema == docs.schema, name
        rows = [tuple(r) for r in kept.collect()]
        assert set(rows) <= before and 0 < len(rows) < docs.count(), name
        texts = [r[1] for r in rows]
        if name == "toxicity":
            assert sum("stupid" in (t or "") for t in texts) == 0 and sum("calm" in (t or "") for t in texts) == 30
        if name == "exact_dedup":
            assert sum(r[1] in ("same text", "same  text") for r in rows) == 1
        if name == "jaccard_join":
            assert sum((t or "").startswith("w0 w1") for t in texts) == 1 and None in texts
        if name == "decontamination":
            assert sum("flour" in (t or "") for t in texts) == 0


def test_pipeline_over_odd_tables(spark, odd_tables):
    docs = queries.table(spark, odd_tables, "documents")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, odd_tables)
    packed = corpus_pipeline.run(spark, odd_tables)
    assert sorted({r.doc_id for r in packed.collect()}, key=str) == sorted({r.doc_id for r in docs.collect()}, key=str)
