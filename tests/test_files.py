"""Files in and out: layouts, increments, sinks, streams, vectors and generators."""

import json
import time

import numpy as np
import pyarrow.parquet as pq
import pytest
from pyspark.sql import Window, functions as F

from tallyhouse.config import rules_for
from tallyhouse.operators import narrative, profile as ex, retrieval as rt, star
from tallyhouse.sources import ingest, sinks
from tallyhouse.streaming import streams


def write(folder, name, text):
    path = folder / name
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text(text)


def test_csv_layouts_meet_by_name(spark, tmp_path, rows):
    raw = tmp_path / "raw"
    write(raw, "Region 1/customers_1.csv", "customer_id,city,state\n1,Houston,TX\n")
    write(raw, "Region 4/customers_4.csv", "state,city,CustomerID\nCA,Fresno,2\n")
    write(raw, "other.csv", "x\n1\n")
    df = ingest.ingest_csv(spark, str(raw), "customers_*.csv")
    assert rows(df, "customer_id", "customerid", "city", "state") == [("1", None, "Houston", "TX"), (None, "2", "Fresno", "CA")]
    assert {"source_file", "load_timestamp"} <= set(df.columns)


def test_csv_stream_loads_every_file_once(spark, tmp_path, rows):
    raw, out, mark = tmp_path / "raw", str(tmp_path / "out"), str(tmp_path / "mark")
    write(raw, "orders_1.csv", "order_id,a\n1,x\n")
    ingest.ingest_csv_stream(spark, str(raw), out, mark)
    write(raw, "sub/orders_2.csv", "b,order_id\ny,2\n")
    ingest.ingest_csv_stream(spark, str(raw), out, mark)
    ingest.ingest_csv_stream(spark, str(raw), out, mark)
    assert rows(ingest.read_bronze(spark, out), "order_id", "a", "b") == [("1", "x", None), ("2", None, "y")]


def test_json_with_differing_fields(spark, tmp_path, rows):
    raw = tmp_path / "raw"
    write(raw, "returns_1.json", '[{"order_id": "1", "refund_amount": "$5"},\n {"order_id": "2", "refund_amount": "6"}]')
    write(raw, "returns_2.json", '[{"OrderId": "3", "amount": "7"}]')
    df = ingest.ingest_json(spark, str(raw))
    assert rows(df, "order_id", "orderid", "amount") == [("1", None, None), ("2", None, None), (None, "3", "7")]
    ingest.ingest_json_stream(spark, str(raw), str(tmp_path / "o"), str(tmp_path / "c"), "order_id string, refund_amount string, OrderId string, amount string")
    assert spark.read.parquet(str(tmp_path / "o")).count() == 3


def test_contracts(spark):
    data = [("/raw/customers_1.csv", "customers_1.csv", ["CustomerID", "country", "region", "a", "b", "c", "d"]), ("/raw/customers_9.csv", "customers_9.csv", ["name", "country"]),
            ("/raw/returns_1.json", "returns_1.json", ["OrderId", "a", "b", "c"]), ("/raw/notes.csv", "notes.csv", ["x"])]
    df = spark.createDataFrame(data, "path string, file_name string, columns array<string>")
    got = {r.file_name: (r.status, r.key_check, r.required_check, r.min_columns_check, r.issues) for r in ingest.contract_check(df).collect()}
    assert got["customers_1.csv"] == ("PASS", "PASS", "PASS", "PASS", "None")
    assert got["customers_9.csv"][:4] == ("WARN", "WARN", "WARN", "WARN") and "absent: region" in got["customers_9.csv"][4]
    assert got["returns_1.json"][0] == "PASS" and "notes.csv" not in got


def test_drift_and_matrix(spark):
    df = spark.createDataFrame([("a.csv", ["id", "x"]), ("b.csv", ["ID", "y"])], "file_name string, columns array<string>")
    got = {r.file_name: (r.added_columns, r.missing_columns, r.status) for r in ingest.drift_report(df, ["id", "x"]).collect()}
    assert got == {"a.csv": ("", "", "SAME"), "b.csv": ("y", "x", "DRIFT")}
    matrix = {r.column_name: (r.a, r.b) for r in ex.schema_matrix(spark.createDataFrame([("a", ["id", "x"]), ("b", ["ID", "y"])], "file_name string, columns array<string>"), ["a", "b"]).collect()}
    assert matrix == {"id": ("id", "ID"), "x": ("x", "MISSING"), "y": ("MISSING", "y")}


def test_rescue(spark):
    df = spark.createDataFrame([(1, "a", None), (2, None, None)], "id int, extra string, more string")
    assert [r._rescued_data for r in ingest.rescue(df, ["id"]).collect()] == ['{"extra":"a"}', None]


def test_load_folder(spark, tmp_path):
    write(tmp_path, "raw/a.csv", "x,y\n1,2\n")
    write(tmp_path, "raw/b.json", '[{"z": 1}]')
    frames = ingest.load_folder(spark, str(tmp_path / "raw"))
    assert {n: d.columns for n, d in frames.items()} == {"a": ["x", "y"], "b": ["z"]}


def test_load_folder_names_entries_by_the_whole_root_and_columns_by_name(spark, tmp_path, rows):
    root = tmp_path / "data/data"
    write(root, "x.csv", "a,b\n1,2\n")
    write(root, "y.csv", "c\n3\n")
    write(root, "places/1.csv", "city,state\nFresno,CA\n")
    write(root, "places/2.csv", "state,city\nTX,Austin\n")
    write(root, "places/3.json", '[{"city": "Reno"}]')
    frames = ingest.load_folder(spark, str(root))
    assert {n: sorted(d.columns) for n, d in frames.items()} == {"places": ["city", "state"], "x": ["a", "b"], "y": ["c"]}
    assert rows(frames["places"], "city", "state") == [("Austin", "TX"), ("Fresno", "CA"), ("Reno", None)]


def test_json_stream_keeps_fields_outside_the_schema(spark, tmp_path, rows):
    raw, out, mark = tmp_path / "raw", str(tmp_path / "o"), str(tmp_path / "c")
    write(raw, "1.json", '[{"id": 1, "a": "x"}]')
    ingest.ingest_json_stream(spark, str(raw), out, mark, "id long, a string")
    write(raw, "2.json", '[{"id": 2, "extra_new": 5}]')
    ingest.ingest_json_stream(spark, str(raw), out, mark, "id long, a string")
    assert rows(ingest.read_bronze(spark, out), "id", "a", "extra_new") == [(1, "x", None), (2, None, "5")]


def test_quoted_header_with_a_line_break(spark, tmp_path):
    write(tmp_path, "q.csv", '"first\nname",b\n1,2\n')
    assert ingest.csv_headers(spark, str(tmp_path)).first()["columns"] == ["first\nname", "b"]


def test_headers_of_odd_files(spark, tmp_path):
    """A byte-order mark, Windows line ends, names with blanks and signs, a header alone, an empty file, and many lines over several pieces."""
    write(tmp_path, "in/Region 1/a+b%20c.csv", "\ufeffid,x\r\n1,2\r\n")
    write(tmp_path, "in/only.csv", "p,q")
    write(tmp_path, "in/empty.csv", "")
    write(tmp_path, "in/long.csv", "k,v\n" + "".join(f"{i},w\n" for i in range(200_000)))
    spark.conf.set("spark.sql.files.maxPartitionBytes", "200k")
    try:
        got = {r.file_name: r["columns"] for r in ingest.csv_headers(spark, str(tmp_path / "in"), "*.csv").collect()}
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert got == {"a+b%20c.csv": ["id", "x"], "only.csv": ["p", "q"], "long.csv": ["k", "v"]}
    assert sorted(ingest.ingest_csv(spark, str(tmp_path / "in/Region 1")).select("id", "x").first()) == ["1", "2"]


def test_json_headers(spark, tmp_path):
    write(tmp_path, "l/a.json", '{"id": 1, "b": null}\nnot json\n{"id": 2, "c": {"d": 1}}\n')
    write(tmp_path, "m/b.json", '[{"x": 1},\n {"y": [1, 2]}]')
    write(tmp_path, "m/c.json", '{"z": 1}')
    assert {r.file_name: r["columns"] for r in ingest.json_headers(spark, str(tmp_path / "l")).collect()} == {"a.json": ["b", "c", "id"]}
    assert {r.file_name: r["columns"] for r in ingest.json_headers(spark, str(tmp_path / "m"), multi_line=True).collect()} == {"b.json": ["x", "y"], "c.json": ["z"]}


def test_csv_rescue_loses_nothing(spark, tmp_path):
    write(tmp_path, "r/1.csv", "id,price,note\n1,2.50,a\nx,3,b\n3,cheap,\n4,5\n5,6,c,d\n")
    write(tmp_path, "r/2.csv", "PRICE,ID,more\n7,6,extra\n")
    rows = ingest.read_csv_rescued(spark, str(tmp_path / "r"), "id int, price decimal(6,2), absent date")
    got = sorted(((r.id, None if r.price is None else float(r.price), r.absent, r._rescued_data and json.loads(r._rescued_data)) for r in rows.collect()), key=str)
    assert got == sorted([
        (1, 2.5, None, {"note": "a"}), (None, 3.0, None, {"id": "x", "note": "b"}), (3, None, None, {"price": "cheap"}),
        (None, None, None, {"_line": "4,5"}), (None, None, None, {"_line": "5,6,c,d"}), (6, 7.0, None, {"more": "extra"})], key=str)


def test_json_rescue_loses_nothing(spark, tmp_path):
    write(tmp_path, "j/1.json", '{"id": 1, "at": "2020-01-02", "o\'n": 1}\n{"id": "x", "new": {"a": [1, null]}}\n{"id": 3, "at": null\n\n[1]\n{"id": 4, "at": "soon", "deep": "q"}\n{}\n')
    rows = ingest.read_json_rescued(spark, str(tmp_path / "j"), "id int, at date, `o'n` int")
    got = sorted(((r.id, r.at and str(r.at), r["o'n"], r._rescued_data and json.loads(r._rescued_data)) for r in rows.collect()), key=str)
    assert got == sorted([
        (1, "2020-01-02", 1, None), (None, None, None, {"id": "x", "new": {"a": [1, None]}}), (None, None, None, {"_line": '{"id": 3, "at": null'}),
        (None, None, None, {"_line": "[1]"}), (4, None, None, {"at": "soon", "deep": "q"}), (None, None, None, None)], key=str)
    write(tmp_path, "k/1.json", '[{"id": 1},\n {"id": "y"}]')
    again = ingest.read_json_rescued(spark, str(tmp_path / "k"), "id int", multi_line=True)
    assert sorted(((r.id, r._rescued_data) for r in again.collect()), key=str) == [(1, None), (None, '{"id":"y"}')]


def test_sinks(spark, tmp_path, rows):
    path = str(tmp_path / "t")
    sinks.append(spark.createDataFrame([(1,)], "a int"), path)
    sinks.append(spark.createDataFrame([(2, "x")], "a int, b string"), path)
    assert rows(sinks.read_merged(spark, path), "a", "b") == [(1, None), (2, "x")]
    current = str(tmp_path / "r")
    sinks.replace(spark.range(3), current)
    sinks.replace(sinks.read_current(spark, current).selectExpr("id + 1 AS next"), current)
    assert rows(sinks.read_current(spark, current)) == [(1,), (2,), (3,)]
    assert sinks.exists(spark, path) and not sinks.exists(spark, str(tmp_path / "none"))
    sinks.log_run(spark, str(tmp_path / "log"), "n", 5, review=1)
    assert sinks.read_merged(spark, str(tmp_path / "log")).first().status == "PARTIAL_REVIEW"


def test_stream_equals_batch_over_several_runs(spark, tmp_path, rows):
    src, out = str(tmp_path / "in"), str(tmp_path / "out")
    data = [("1", "2017-01-02 10:00", "First Class"), (None, "n/a", None), ("3", "02/01/2017 10:00", None)]
    frames = [spark.createDataFrame([d], "order_id string, order_purchase_date string, ship_mode string") for d in data]
    for f in frames:
        f.write.mode("append").parquet(src)
        streams.silver_stream(streams.file_stream(spark, src, "*.parquet", 1), "orders", rules_for("orders"), out, str(tmp_path / "c"))
    assert rows(spark.read.parquet(out), "order_id") == [("1",), ("3",)]


def test_quarantine_keeps_step_with_the_stream(spark, tmp_path):
    src = str(tmp_path / "in")
    spark.createDataFrame([("1", "5.00", "Pending"), (None, "0", "Lost")], "order_id string, refund_amount string, return_status string").write.parquet(src)
    streams.silver_with_quarantine(streams.file_stream(spark, src, "*.parquet"), "returns", rules_for("returns"), "r", f"{tmp_path}/clean", f"{tmp_path}/bad", f"{tmp_path}/c")
    assert spark.read.parquet(f"{tmp_path}/clean").count() == 1
    names = {r[0] for r in spark.read.parquet(f"{tmp_path}/bad").where("order_id IS NULL").select("_expectation_name").collect()}
    assert names == {"order_id_not_null", "valid_return_status", "valid_return_reason", "valid_refund_amount"}


def _shuffle_files(spark):
    disk = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
    return {f for f in disk.getAllFiles().mkString(" ").split() if "/shuffle_" in f}


def test_sales_stream_keeps_little_on_disk(spark, tmp_path, rows):
    """Batches equal the batch fact, a second run adds only new files, keys are packed and shuffle files go with the write."""
    src, out = str(tmp_path / "in"), str(tmp_path / "out")
    lines = spark.range(3000).selectExpr(
        "id % 500 AS order_id", "id % 90 AS product_id", "id % 11 AS vendor_id", "CAST(id AS DECIMAL(10,2)) AS sales", "1 AS quantity",
        "CAST(0 AS DECIMAL(4,2)) AS discount", "CAST(0 AS DECIMAL(14,4)) AS profit", "'x' AS payment_type", "1 AS payment_installments")
    orders = spark.range(400).selectExpr("id AS order_id", "id % 40 AS customer_id", "TIMESTAMP '2020-01-02 00:00:00' AS order_purchase_timestamp")
    customers = spark.range(30).selectExpr("id AS customer_id", "'West' AS region", "'Consumer' AS segment")
    sides = orders, customers, spark.range(80).selectExpr("id AS product_id"), spark.range(5).selectExpr("id AS vendor_id").unionAll(spark.range(2).selectExpr("id AS vendor_id"))
    want = rows(star.fact_sales(lines, *sides))
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
        for part in lines.where("sales < 1000"), lines.where("sales >= 1000"):
            part.repartition(2).write.mode("append").parquet(src)
            before, until = _shuffle_files(spark), time.time() + 20
            streams.fact_sales_stream(streams.file_stream(spark, src, "*.parquet", 1), *sides, out, str(tmp_path / "c"))
            while (left := _shuffle_files(spark) - before) and time.time() < until:
                time.sleep(0.2)
            assert not left
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
    got = spark.read.parquet(out)
    assert got.select("batch").distinct().count() == 4 and rows(got.drop("batch")) == want
    written = {pq.ParquetFile(f).metadata.row_group(0).column(0).compression for f in (tmp_path / "out").rglob("*.parquet")}
    assert written == {"ZSTD"}


# --- vectors and generators -----------------------------------------------------------------------------


@pytest.mark.parametrize("parts", [1, 7])
def test_nearest_is_exact(spark, parts):
    rng = np.random.default_rng(1)
    x, q = rng.normal(size=(200, 8)), rng.normal(size=(5, 8))
    x[10] = x[20]  # a tie goes to the smaller id
    vectors = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "id int, embedding array<double>").repartition(parts)
    queries = spark.createDataFrame([(f"q{i}", v.tolist()) for i, v in enumerate(q)], "qid string, embedding array<double>")
    got = {}
    for r in rt.nearest(vectors, queries, "id", "qid", 4).orderBy("qid", "rank").collect():
        got.setdefault(r.qid, []).append(r.id)
    dist = ((x[None] - q[:, None]) ** 2).sum(-1)
    want = {f"q{j}": [int(i) for i in np.lexsort((np.arange(200), dist[j]))[:4]] for j in range(5)}
    assert got == want


def test_queries_are_searched_in_blocks(spark, monkeypatch):
    rows = [(i, [float(i), float(i * i % 7)]) for i in range(30)]
    v = spark.createDataFrame(rows, "id bigint, embedding array<float>")
    search = lambda: sorted(tuple(r) for r in rt.nearest(v, v.withColumnRenamed("id", "q"), "id", "q", 3).collect())
    whole = search()
    monkeypatch.setattr(rt, "QUERY_BLOCK_BYTES", 100)
    assert search() == whole and len(whole) == 90


def test_embedding_is_unit_length_and_word_based(spark):
    df = spark.createDataFrame([(1, "Red bolt, red nut"), (2, "red BOLT red nut"), (3, "")], "i int, t string")
    got = [np.array(r.embedding) for r in rt.embed(df, "t", 32).orderBy("i").collect()]
    assert abs(np.linalg.norm(got[0]) - 1) < 1e-6 and np.allclose(got[0], got[1]) and not got[2].any()


def test_zorder_narrows_every_column(spark, tmp_path, rows):
    import datetime as dt

    rng = np.random.default_rng(5)
    data = [(int(a), f"k{b:04d}", dt.date(2020, 1, 1) + dt.timedelta(days=int(c)), i) for i, (a, b, c) in enumerate(zip(rng.integers(0, 500, 4000), rng.integers(0, 500, 4000), rng.integers(0, 500, 4000)))]
    df = spark.createDataFrame([*data, (None, None, None, -1)], "a int, b string, c date, _z int")
    path = str(tmp_path / "z")
    sinks.write_zordered(df, path, "a", "b", "c", partitions=27)
    assert rows(spark.read.parquet(path)) == rows(df)
    for column, span in (("a", 500), ("b", 500), ("c", 500)):
        rank = F.dense_rank().over(Window.orderBy(column))
        ranges = spark.read.parquet(path).where("a IS NOT NULL").withColumn("f", F.input_file_name()).withColumn("r", rank).groupBy("f").agg((F.max("r") - F.min("r")).alias("width"))
        assert ranges.agg(F.avg("width")).first()[0] < 0.62 * span
    sinks.write_zordered(df.limit(0), str(tmp_path / "e"), "a", "b", partitions=2)


def test_buckets_are_replaced_alone(spark, tmp_path):
    path = str(tmp_path / "b")
    make = lambda ids, v: sinks.with_bucket(spark.createDataFrame([(i, v) for i in ids], "k int, v string"), "k", 8)
    assert sinks.read_buckets(spark, path) is None
    sinks.replace_buckets(make(range(40), "old"), path, batch="one")
    some = make(range(5), "new")
    touched = [r[0] for r in some.select("_bucket").distinct().collect()]
    keep = sinks.read_buckets(spark, path, touched).where("k > 4")
    sinks.replace_buckets(some.unionByName(keep.select(*some.columns)), path, touched, batch="two")
    got = {r.k: r.v for r in sinks.read_buckets(spark, path).collect()}
    assert got == {i: "new" if i < 5 else "old" for i in range(40)}
    version, folders, batches = sinks.bucket_state(spark, path)
    assert version == 2 and batches == {"one", "two"} and {b for b, v in folders.items() if v == 2} == set(touched)


def test_store_embeds_only_what_has_changed(spark, tmp_path):
    make = lambda rows: spark.createDataFrame(rows, "id int, t string")
    rows, path = [(i, f"text {i}") for i in range(200)], str(tmp_path / "store")
    refresh = lambda rows: rt.refresh_store(make(rows), "id", "t", path, 8, buckets=16)
    assert refresh(rows)[1] == 200
    assert refresh(rows[::-1])[1] == 0
    rows[5], rows[6] = (5, "changed"), (6, "changed too")
    vectors, n = refresh(rows + [(900, "new"), (900, "new"), (None, None)])
    assert n == 4 and vectors.count() == 202
    parts = lambda v: sorted(p.name for p in (tmp_path / f"store/version={v}").glob("_part=*"))
    assert len(parts(1)) == 16 and 1 <= len(parts(2)) <= 4
    got = {r.id: r.embedding for r in vectors.collect()}
    want = {r.id: r.embedding for r in rt.embed(make(rows), "t", 8).collect()}
    assert all(got[i] == want[i] for i in want)
    vectors, n = refresh(rows[:3])
    assert n == 0 and sorted(r.id for r in vectors.collect()) == [0, 1, 2]
    assert refresh([])[0].count() == 0 and refresh([])[1] == 0
    assert refresh(rows[:1])[1] == 1


def test_approximate_neighbours(spark, tmp_path):
    rng = np.random.default_rng(3)
    centres = rng.normal(size=(30, 24)) * 2
    x = np.concatenate([centres[rng.integers(0, 30, 3000)] + rng.normal(size=(3000, 24)) * 0.6])
    vectors = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)] + [(9999, None), (9998, [1.0])], "id int, embedding array<double>").repartition(4)
    queries = vectors.where("id % 50 = 0 OR id = 9999").withColumnRenamed("id", "q")
    rt.build_index(vectors, str(tmp_path / "i"), "id")
    found = rt.approximate_nearest(queries, str(tmp_path / "i"), "id", "q").collect()
    exact = {(r.q, r.id) for r in rt.nearest(vectors.where("id < 9000"), queries.where("q < 9000"), "id", "q", 5).collect()}
    hits = {(r.q, r.id) for r in found}
    assert len(hits & exact) >= 0.9 * len(exact)
    assert sum({r.q: r.compared for r in found}.values()) / 60 < 0.75 * 3000
    distance = {(r.q, r.id): r.distance for r in found}
    assert all(abs(d - ((x[q] - x[i]) ** 2).sum()) < 1e-9 for (q, i), d in distance.items())
    rt.build_index(vectors.limit(0), str(tmp_path / "none"), "id")
    assert rt.approximate_nearest(queries, str(tmp_path / "none"), "id", "q").count() == 0


def test_index_holds_every_vector_once_and_compares_copies_once(spark, tmp_path):
    rng = np.random.default_rng(5)
    rows = [(i, v.tolist()) for i, v in enumerate(rng.normal(size=(400, 8)))]
    vectors = spark.createDataFrame(rows + rows[:50], "id int, embedding array<double>").repartition(3)
    rt.build_index(vectors, str(tmp_path / "i"), "id")
    assert spark.read.parquet(str(tmp_path / "i" / "buckets")).count() == 400
    found = rt.approximate_nearest(vectors.where("id < 9").withColumnRenamed("id", "q"), str(tmp_path / "i"), "id", "q", 5, probes=256).collect()
    x = np.array([v for _, v in rows])
    want = {(q, int(i)) for q in range(9) for i in np.argsort(((x - x[q]) ** 2).sum(axis=1), kind="stable")[:5]}
    assert {(r.q, r.id) for r in found} == want and len(found) == 45 and {r.compared for r in found} == {400}


def test_answers_refuse_far_questions(spark):
    docs = spark.createDataFrame([(1, "red bolt from west"), (2, "blue nut from east")], "product_id int, document string")
    asked = spark.createDataFrame([(1, "red bolt"), (2, "zzz")], "qid int, question string")
    hits = rt.nearest(rt.embed(docs, "document", 64), rt.embed(asked, "question", 64), "product_id", "qid", 1)
    got = {r.qid: r.answer for r in rt.answers(hits, docs, asked, "qid", "product_id", 0.9).collect()}
    assert got == {1: "red bolt from west", 2: rt.NOT_FOUND}


def test_generator_failure_is_marked_not_raised(spark):
    def broken(prompts):
        raise RuntimeError("down")

    df = spark.createDataFrame([(1, "p")], "i int, prompt string")
    out = narrative.checked(narrative.generate(df, "prompt", broken, retries=2, wait=0.0), "text").first()
    assert out.llm_check == "REVIEW" and "llm_call_failed" in out.llm_check_detail


def test_only_texts_under_review_are_generated_again(spark, tmp_path):
    def first(prompts):
        return [p if p == "short" else p + " word" * 40 for p in prompts]

    def second(prompts):
        return [p + " again" * 40 for p in prompts]

    df = spark.createDataFrame([(1, "short"), (2, "long")], "i int, prompt string")
    out = {r.i: (r.llm_check, "again" in r.text) for r in narrative.generate_with_retry(df, "prompt", first, second, str(tmp_path / "s")).collect()}
    assert out == {1: ("PASS", True), 2: ("PASS", False)}


def test_profile_tables(spark):
    df = spark.createDataFrame([("1", " "), ("1", None), (None, "$5")], "k string, v string")
    got = {r.column_name: (r.null_or_empty_count, r.pct_missing) for r in ex.missing_values({"t": df}).collect()}
    assert got == {"k": (1, 33.33), "v": (2, 66.67)}
    one = ex.duplicate_keys({"t": (df, "k")}).first()
    assert (one.total_rows, one.distinct_keys, one.duplicate_rows) == (3, 2, 1)
    share = ex.prefix_share([("t", df, "v")]).first()
    assert (share.with_prefix, share.without_prefix, share.status) == (1, 2, "MIXED")
    overlap = ex.key_overlap({"r": (df, F.col("k"), df.where("k = '1'"), F.col("k"))}).first()
    assert (overlap.source_distinct_keys, overlap.matched_in_target, overlap.orphaned_keys) == (2, 1, 1)
