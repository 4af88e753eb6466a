"""Cleaning, harmonisation and quality rules on hand-made rows."""

import datetime as dt
import random
from decimal import Decimal as D

import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from tallyhouse.config import MAPPINGS, RULES, Mapping, Rule, rules_for
from tallyhouse.functions import clean as cl
from tallyhouse.functions.numbers import ratio
from tallyhouse.operators import harmonize as hz, quality as dq, setup


def values(spark, texts, fn):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, c string")
    return [r[0] for r in df.orderBy("i").select(fn(F.col("c"))).collect()]


def test_currency(spark):
    assert values(spark, ["$45.10", "45.1", "-3", "abc", None, "4$5"], cl.currency) == [D("45.100"), D("45.100"), D("-3.000"), None, None, None]


def test_refund(spark):
    assert values(spark, ["$45.10", "?", "1,234.50", "-7.00", ""], cl.refund) == [D("45.10"), None, D("1234.50"), D("7.00"), None]


def test_discount(spark):
    assert values(spark, ["0.2", "20", "20%", "1", "0", "x"], cl.discount_fraction) == [D("0.20000"), D("0.20000"), D("0.20000"), D("0.01000"), D("0.00000"), None]


def test_codes(spark):
    assert values(spark, ["CONS", "Cosumer", "CORP", "HO", "Other", None], cl.segment) == ["Consumer", "Consumer", "Corporate", "Home Office", "Other", None]
    assert values(spark, [" s", "C", "w ", "E", "n", "South", None], cl.region) == ["South", "Central", "West", "East", "North", "South", None]
    assert values(spark, ["PENDG", "APPRVD", "RJCTD", "Lost"], cl.return_status) == ["Pending", "Approved", "Rejected", "Lost"]


def test_timestamps(spark):
    got = values(spark, ["03/04/2017 18:05", "2017-03-04 18:05", "2017-03-04 8:05", "n/a", None], lambda c: cl.timestamp(c).cast("string"))
    assert got == ["2017-03-04 18:05:00", "2017-03-04 18:05:00", "2017-03-04 08:05:00", None, None]


def test_dates(spark):
    day = dt.date(2017, 3, 4)
    assert values(spark, ["2017-03-04", "03-04-2017", "NULL", "soon", None], cl.date) == [day, day, None, None, None]
    assert values(spark, ["2017-03-04T18:38:00.000Z", "2017-03-04"], cl.date_part_of) == [day, day]


@settings(max_examples=15, deadline=None)
@given(n=st.integers(-10**9, 10**9), d=st.integers(1, 10**6))
def test_ratio_rounds_half_away_from_zero(spark, n, d):
    from decimal import ROUND_HALF_UP, localcontext

    with localcontext() as ctx:
        ctx.prec = 60
        want = float((D(n) * 100 / D(d)).quantize(D("0.01"), ROUND_HALF_UP))
    df = spark.createDataFrame([(n, d)], "n bigint, d bigint")
    assert df.select(ratio(F.col("n"), F.col("d"), 2, 100)).first()[0] == want


def test_ratio_guards(spark):
    df = spark.createDataFrame([(1, 0), (1, None), (None, 1)], "n bigint, d bigint")
    assert [r[0] for r in df.select(ratio(F.col("n"), F.col("d"), 2)).collect()] == [None, None, None]


def test_sanitize_columns(spark):
    df = spark.createDataFrame([(1, None, "a", 4), (None, 2, "b", 5)], "` Order_id ` int, `Order-ID` int, `Sale$$ Price_` string, x int")
    out = hz.sanitize_columns(df)
    assert out.columns == ["order_id", "sale_price", "x"]
    assert [tuple(r) for r in out.collect()] == [(1, "a", 4), (2, "b", 5)]


def test_harmonize_coalesces_in_order_and_types_missing_columns(spark):
    df = spark.createDataFrame([("1", None, "f"), (None, "2", "g"), ("3", "4", "h")], "orderid string, order_id string, source_file string")
    out = hz.harmonize_entity(df, "returns")
    assert [r.order_id for r in out.collect()] == ["1", "2", "4"]
    assert dict(out.dtypes)["refund_amount"] == "decimal(10,2)"
    assert {"_source_file", "_mapping_source"} <= set(out.columns)


def test_harmonize_takes_sql_templates(spark):
    df = spark.createDataFrame([("7",), ("x",)], "qty string")
    out = hz.harmonize(df, [Mapping("transactions", "qty", "quantity", "try_cast({col} AS int) * 2")])
    assert [r.quantity for r in out.collect()] == [14, None]


def test_location_swap(spark):
    df = spark.createDataFrame([("TX", "Houston"), ("Texas", "Houston"), ("New York", "Albany"), ("New York", "NY"), ("Houston 2", "TX"), (None, "TX")], "state string, city string")
    out = [(r.state, r.city, r._location_swapped) for r in hz.repair_location_swap(df).collect()]
    assert out == [("TX", "Houston", False), ("Texas", "Houston", False), ("New York", "Albany", False), ("NY", "New York", True), ("TX", "Houston 2", True), (None, "TX", False)]


def test_suggested_mappings(spark):
    df = spark.createDataFrame([("1", "$4.00", "n", "01/02/2017 10:00")], "customer_idd string, sale string, zzzzqq string, order_purchase_timestam string")
    got = {r.source_column: (r.canonical_column, r.transformation, r.mapping_source) for r in hz.suggest_mappings(df, "transactions").collect()}
    assert got["sale"] == ("sales", "currency", "name_match")
    assert got["zzzzqq"][2] == "unmapped"
    got = {r.source_column: (r.canonical_column, r.mapping_source) for r in hz.suggest_mappings(df, "orders").collect()}
    assert got["order_purchase_timestam"] == ("order_purchase_timestamp", "name_match")


# --- rules ----------------------------------------------------------------------------------------

PEOPLE = [("1", "a@x", "A", "Consumer", "TX"), (None, "b@x", "B", "Corporate", "TX"), ("3", None, None, "Other", "TX"), ("4", "d@x", "D", None, "New York")]


@pytest.fixture
def people(spark):
    return spark.createDataFrame(PEOPLE, "customer_id string, customer_email string, customer_name string, segment string, state string")


def test_counts_of_configuration():
    assert len(RULES) == 27 and len(MAPPINGS) == 58


def test_quarantine_has_one_row_per_broken_rule(people):
    q = dq.quarantine(people, rules_for("customers"), "run")
    got = sorted((r.customer_id or "", r._expectation_name) for r in q.collect())
    assert got == [("", "customer_id_not_null"), ("3", "valid_customer_email"), ("3", "valid_customer_name"), ("3", "valid_segment"), ("4", "detect_location_swap")]
    assert set(dq.AUDIT_COLUMNS) <= set(q.columns)


def test_unknown_counts_as_broken_on_request_and_in_the_scorecard(people):
    q = dq.quarantine(people, rules_for("customers"), "run", null_fails=True)
    assert ("4", "valid_segment") in {(r.customer_id, r._expectation_name) for r in q.collect()}
    card = {r.rule_name: (r.passed, r.failed, r.pass_rate_pct) for r in dq.scorecard(people, rules_for("customers")).collect()}
    assert card["valid_segment"] == (2, 2, 50.0)


def test_no_rules_give_an_empty_typed_quarantine(people):
    q = dq.quarantine(people, [], "run")
    assert q.count() == 0 and set(dq.AUDIT_COLUMNS) <= set(q.columns)


def test_clean_and_dropped_make_up_the_input(people):
    rules = rules_for("customers")
    kept = dq.drop_violations(people, rules).count()
    dropped = dq.quarantine(people, [r for r in rules if r.consequence == "drop"], "run").count()
    assert kept + dropped == people.count()


def test_expectations_are_observed_without_a_job_of_their_own(people):
    df, seen = dq.expect(people, "people", rules_for("customers"))
    df.collect()
    assert seen.get["rows"] == 4 and seen.get["valid_segment"] == 2 and seen.get["customer_id_not_null"] == 1


def test_text_check(spark):
    long = "word " * 40
    texts = [long, "short", "LLM_UNAVAILABLE: down " + long, "As an AI " + long, "the pipeline " + long, "", "**bold** # " + long]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    cols = dq.text_check(F.col("t"), jargon=("the pipeline",))
    got = [tuple(r) for r in df.orderBy("i").select(cols["llm_check"], cols["llm_check_detail"]).collect()]
    assert got == [("PASS", "none"), ("REVIEW", "too_short"), ("REVIEW", "llm_call_failed"), ("REVIEW", "refusal_detected"), ("REVIEW", "technical_jargon_detected"),
                   ("REVIEW", "too_short"), ("PASS", "none")]
    text = [r[0] for r in df.orderBy("i").select(cols["text"]).collect()]
    assert text[5].startswith("[REVIEW REQUIRED") and text[6].startswith("bold")
    sections = dq.text_check(F.col("t"), sections=("HERE:",))
    assert df.where("i = 0").select(sections["llm_check_detail"]).first()[0] == "missing_section"


def test_findings_with_and_without_fences(spark):
    body = '[{"column_name":"a","issue_type":"outlier","severity":null,"suggested_rule":"a > 0","description":"d"},{"column_name":"b","issue_type":"x","severity":"CRITICAL"}]'
    df = spark.createDataFrame([(1, body), (2, f"```json\n{body}\n```"), (3, "[]"), (4, "no json")], "i int, t string")
    got = [(r.i, r.column_name, r.severity) for r in dq.parse_findings(df, "t").orderBy("i", "column_name").collect()]
    assert got == [(1, "a", "WARNING"), (1, "b", "CRITICAL"), (2, "a", "WARNING"), (2, "b", "CRITICAL")]


def test_issue_discovery(spark):
    data = [("2017-01-01", "$1.00", " a")] * 60 + [("01/02/2017", "2.00", "b")] * 60 + [("?", "3.00", "z")]
    many = [(f"k{i % 30}",) for i in range(3000)] + [("odd",)]  # more than twenty frequent kinds
    assert [(r.issue_type, r.hits) for r in dq.discover_issues({"x": spark.createDataFrame(many, "c string")}).collect()] == [("suspicious_distribution", 1)]
    found = {(r.column_name, r.issue_type) for r in dq.discover_issues({"x": spark.createDataFrame(data, "d string, m string, c string")}).collect()}
    assert {("d", "unexpected_values"), ("d", "format_inconsistency"), ("m", "format_inconsistency"), ("c", "encoding_issue"), ("c", "suspicious_distribution")} <= found


def test_increment_without_and_with_an_earlier_report(spark, rows):
    df = spark.createDataFrame([(1, dt.datetime(2024, 1, 1)), (2, dt.datetime(2024, 1, 3))], "i int, at timestamp")
    report = spark.createDataFrame([(dt.datetime(2024, 1, 2),)], "done timestamp")
    assert rows(dq.newer_than(df, "at", report, "done"), "i") == [(2,)]
    assert rows(dq.newer_than(df, "at", report.limit(0), "done"), "i") == [(1,), (2,)]


def test_severity_and_sources(spark):
    df = spark.createDataFrame([("null_primary_key", 1), ("format_error", 1), ("other", 101), ("other", 31), ("other", 30)], "i string, n int")
    assert [r[0] for r in df.select(dq.severity_class(F.col("i"), F.col("n"))).collect()] == ["CRITICAL", "HIGH", "CRITICAL", "HIGH", "MEDIUM"]
    paths = spark.createDataFrame([("/v/Region 3/customers_3.csv",), ("plain.csv",)], "p string")
    assert [r[0] for r in paths.select(dq.pretty_source(F.col("p"))).collect()] == ["customers_3.csv (Region 3)", "plain.csv"]


def test_anomalies(spark):
    df = spark.createDataFrame([("a", 1, 10), ("a", 2, 25), ("a", 3, 26), ("b", 1, 5)], "entity string, run_at int, rejected_count bigint")
    got = [(r.entity, r.detected_at, r.delta_pct, r.severity_tag) for r in dq.anomaly_alerts(df).collect()]
    assert got == [("a", 2, 150.0, "CRITICAL")]


def test_configuration_round_trip(spark):
    loaded = setup.load(setup.config_table(spark, "dq_rules"), Rule)
    assert loaded["orders"] == rules_for("orders")


def test_bootstrap_is_idempotent(spark):
    names = {r[0] for r in setup.bootstrap(spark, prefix="t_").collect()}
    assert {"t_bronze", "t_gold"} <= names
    setup.bootstrap(spark, prefix="t_")
    for layer in setup.LAYERS:
        spark.sql(f"DROP DATABASE t_{layer}")


def test_issue_groups_gather_no_whole_sets(spark):
    """The first reasons and files of each rule, with nulls and repeats, without a set of all of them."""
    import random

    rng = random.Random(2)
    rows = [(rng.choice(["a", None]), rng.choice(["r1", "r2"]), rng.choice([None, *[f"why {i}" for i in range(40)]]), rng.choice([None, *[f"f{i}" for i in range(90)]]), i) for i in range(800)]
    rows += [("b", "r3", None, None, 5)] * 2
    frame = spark.createDataFrame(rows, "_issue_type string, _expectation_name string, _failure_reason string, _source_file string, _quarantine_timestamp long")
    got = dq.issue_groups({"returns": frame})
    assert "collect_set" not in got._jdf.queryExecution().optimizedPlan().toString()
    want = {}
    for issue, rule, why, file, at in rows:
        want.setdefault((issue, rule), []).append((why, file, at))
    few = lambda part, c, k: sorted({x[c] for x in part} - {None})[:k]
    want = [(*key, len(part), min(x[2] for x in part), max(x[2] for x in part), few(part, 0, 3), few(part, 1, 5)) for key, part in want.items()]
    found = [(r.issue_type, r.field_affected, r.rejected_count, r.earliest_failure, r.latest_failure, r.sample_reasons, r.source_files) for r in got.collect()]
    assert sorted(found, key=str) == sorted(want, key=str)


def test_quartiles_are_exact_even_if_a_bracket_misses(spark, monkeypatch):
    r = random.Random(2)
    data = [("a", float(r.randint(0, 50))) for _ in range(3000)] + [("b", r.gauss(0, 1)) for _ in range(5001)] + [("c", 1.0)] * 7 + [("d", 5.0), ("d", 9.0)]
    raw = spark.createDataFrame(data, "k string, x double").repartition(5)
    counted = raw.groupBy("k", "x").agg(F.count(F.lit(1)).alias("n"))
    want = {}
    for k in "abcd":
        xs = sorted(x for key, x in data if key == k)
        want[k] = (xs[(len(xs) + 3) // 4 - 1], xs[(3 * len(xs) + 3) // 4 - 1])
    for width in (dq.BRACKET, 0.0, -0.2):
        monkeypatch.setattr(dq, "BRACKET", width)
        assert {r.k: (r.q1, r.q3) for r in dq.exact_quartiles(raw, counted, ["k"]).collect()} == want


def test_outliers_and_order_of_dates(spark):
    rows = [(f"${i % 10}.50", "2024-01-02", f"01/0{1 + i % 3}/2024 10:00") for i in range(50)] + [("900%", "2023-12-01", "soon"), ("?", None, None)]
    found = {(r.column_name, r.issue_type): (r.hits, r.suggested_rule) for r in dq.discover_issues({"x": spark.createDataFrame(rows, "m string, due_date string, paid_at string")}).collect()}
    assert found["m", "outlier"][0] == 1
    # 17 rows are paid on the day before; on the day itself the hour is later
    assert found["due_date", "date_order"] == (17, "due_date <= paid_at")
    assert dq.date_order({"x": spark.createDataFrame([(1,)], "a int")}).count() == 0


def test_discovery_counts_the_cells_once(spark):
    """The detectors read the counted values, which were written; only the sketches read the cells again, and no join does."""
    df = spark.createDataFrame([(str(i % 20), str(i)) for i in range(200)] + [("?", "9000"), ("?", None)], "kind string, amount string").repartition(3)
    found = dq.discover_issues({"goods": df})
    assert {(r.column_name, r.issue_type, r.hits) for r in found.collect()} == {("kind", "unexpected_values", 2), ("kind", "suspicious_distribution", 2), ("amount", "outlier", 1)}
    assert found._jdf.queryExecution().optimizedPlan().toString().count("LogicalRDD") <= 2  # the sketches and the empty list of date pairs
    assert "hashpartitioning(at" in dq.column_values({"goods": df})._jdf.queryExecution().executedPlan().toString()
