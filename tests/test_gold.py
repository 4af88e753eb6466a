"""Golden records, returns matching and marts against brute force on hand-made rows."""

import datetime as dt
import hashlib
import random
from decimal import Decimal as D

import pytest
from pyspark.sql import Window, functions as F

from tallyhouse.config import SURVIVORSHIP
from tallyhouse.operators import basket as mb, fraud, kpis, marts, mdm, metrics, pricing as pr, quality as dq, star

LINES = "order_id bigint, product_id bigint, sales decimal(10,3), quantity int, discount decimal(4,2), profit decimal(10,2)"


def test_golden_record(spark):
    t1, t2 = dt.datetime(2024, 1, 1), dt.datetime(2024, 1, 2)
    data = [
        ("1", None, "A1", "s1", "c1", "x1", "/r/customers_1.csv", t1), ("1", "e6", "A6", "s6", "c6", "x6", "/r/customers_6.csv", t2),
        ("2", "e2", None, "s2", "c2", "x2", "/r/customers_2.csv", t1), ("2", "e6", "B6", "s6", "c6", "x6", "/r/customers_6.csv", t1),
        ("3", None, "C9", "s9", "c9", "x9", "/r/other.csv", t1),
    ]
    df = spark.createDataFrame(data, "customer_id string, customer_email string, customer_name string, segment string, city string, region string, _source_file string, _load_timestamp timestamp")
    rules = [r for r in SURVIVORSHIP if r.canonical_column in df.columns]
    got = {r.customer_id: (r.customer_email, r.customer_name, r.city) for r in mdm.golden_record(df, "customer_id", rules).collect()}
    # a NULL name of the best source survives; the tie in load time goes to the better source
    assert got == {"1": ("e6", "A1", "c6"), "2": ("e2", None, "c2"), "3": (None, "C9", "c9")}


def test_keep_latest(spark):
    df = spark.createDataFrame([(1, "a", 1), (1, "b", 2), (2, "c", 1)], "k int, v string, _load_timestamp int")
    assert {(r.k, r.v) for r in mdm.keep_latest(df, "k").collect()} == {(1, "b"), (2, "c")}


def test_calendar_defaults(spark):
    orders = spark.createDataFrame([], "order_purchase_timestamp timestamp")
    returns = spark.createDataFrame([], "return_date date")
    days = star.dim_dates(orders, returns)
    assert days.agg(F.min("date_key"), F.max("date_key")).first()[:] == (20150101, 20221231)
    assert days.where("date_key = 20170304").select("day_name", "month_name", "quarter", "is_weekend").first()[:] == ("Saturday", "March", 1, True)


# --- returns --------------------------------------------------------------------------------------


@pytest.fixture
def returned(spark):
    lines = [(1, 10, "50.000"), (1, 11, "80.000"), (2, 20, "30.000"), (2, 21, "30.000"), (3, 30, "40.000"), (3, 31, "60.000"), (4, 40, None), (4, 41, "90.000"), (6, 60, "10.005")]
    lines = spark.createDataFrame([(o, p, D(s) if s else None, 1, D("0.00"), D("0.00")) for o, p, s in lines], LINES)
    returns = [(1, "50.00"), (1, "70.00"), (2, "30.00"), (3, "50.00"), (4, "1.00"), (5, "9.00"), (None, "9.00"), (3, None), (3, "400.00"), (6, "10.00")]
    returns = spark.createDataFrame([(o, D(r) if r else None, dt.date(2020, 1, 1)) for o, r in returns], "order_id bigint, refund_amount decimal(10,2), return_date date")
    return returns, lines


WANT = [
    (1, D("50.00"), 10, "EXACT"), (1, D("70.00"), 11, "ESTIMATED"), (2, D("30.00"), 20, "AMBIGUOUS"), (3, D("50.00"), 30, "ESTIMATED"), (3, D("400.00"), 31, "ESTIMATED"),
    (3, None, 30, "ESTIMATED"), (4, D("1.00"), 40, "ESTIMATED"), (5, D("9.00"), None, "ORPHAN"), (6, D("10.00"), 60, "EXACT"), (None, D("9.00"), None, "ORPHAN"),
]


def test_match_returns(returned):
    returns, lines = returned
    got = star.match_returns(returns, lines).collect()
    assert sorted(((r.order_id, r.refund_amount, r.product_id, r.match_confidence) for r in got), key=str) == sorted(WANT, key=str)


def test_matching_against_brute_force(spark):
    rnd = random.Random(7)
    lines = [(o, rnd.randrange(50), D(rnd.randrange(1, 60000)) / 100 if rnd.random() > 0.05 else None, 1, D("0.00"), D("0.00")) for o in range(6) for _ in range(rnd.randrange(1, 200))]
    returns = [(rnd.randrange(7), D(rnd.randrange(1, 60000)) / 100 if rnd.random() > 0.05 else None, dt.date(2020, 1, 1)) for _ in range(300)]
    returns += [(o, s, dt.date(2020, 1, 2)) for o, _, s, *_ in lines[:100] if s is not None]
    of = {}
    for o, p, s, *_ in lines:
        of.setdefault(o, []).append((p, s))
    want = []
    for o, refund, day in returns:
        near = min(((abs((s or 0) - (refund or 0)), p, s is not None, s) for p, s in of.get(o, [])), default=None)
        same = sum(s is not None and refund is not None and abs(s - refund) < D("0.01") for _, s in of.get(o, []))
        kind = "ORPHAN" if near is None else "EXACT" if same == 1 else "AMBIGUOUS" if same else "ESTIMATED"
        want.append((o, refund, near and near[1], near and near[3], kind))
    lines = spark.createDataFrame(lines, LINES)
    returns = spark.createDataFrame(returns, "order_id bigint, refund_amount decimal(10,2), return_date date")
    got = [(r.order_id, r.refund_amount, r.product_id, r.original_sales, r.match_confidence) for r in star.match_returns(returns, lines).collect()]
    assert sorted(got, key=str) == sorted(want, key=str)


@pytest.mark.parametrize("width", [16, star.BUCKET])
def test_matching_in_cents_over_buckets(spark, monkeypatch, width):
    monkeypatch.setattr(star, "BUCKET", width)
    rnd = random.Random(9)
    lines = [(o, rnd.randrange(50), D(rnd.randrange(1, 9000 if o else 20_000_000)) / 100) for o in range(5) for _ in range(150)]
    asked = [(rnd.randrange(6), D(rnd.randrange(-500, 9000)) / 100) for _ in range(200)] + [(o, s) for o, _, s in lines[::20]]
    want = []
    for o, refund in asked:
        near = min(((abs(s - refund), p, s) for k, p, s in lines if k == o), default=(None, None, None))
        same = sum(s == refund for k, _, s in lines if k == o)
        want.append((o, refund, near[1], near[2], "ORPHAN" if near[1] is None else "EXACT" if same == 1 else "AMBIGUOUS" if same else "ESTIMATED"))
    lines = spark.createDataFrame(lines, "order_id bigint, product_id int, sales decimal(10,2)")
    found = star.match_returns(spark.createDataFrame(asked, "order_id bigint, refund_amount decimal(10,2)"), lines)
    got = [(r.order_id, r.refund_amount, r.product_id, r.original_sales, r.match_confidence) for r in found.collect()]
    assert sorted(got, key=str) == sorted(want, key=str)


@pytest.mark.parametrize(("long", "width"), [(0, 16), (0, 1 << 16), (200, 7), (1 << 18, 16)])
def test_matching_of_long_orders(spark, monkeypatch, long, width):
    """Orders are cut into price buckets or not; null keys and prices, equal lines and repeated returns make no difference."""
    monkeypatch.setattr(star, "LONG", long)
    monkeypatch.setattr(star, "BUCKET", width)
    rnd = random.Random(long + width)
    cents = lambda lo, hi: D(rnd.randrange(lo, hi)) / 100 if rnd.random() > 0.1 else None
    lines = [(o, rnd.choice([None, *range(9)]), cents(-300, 9000) if o else cents(0, 20_000_000), v) for o in [0, 1, 2, 3, None] for v in [None, *range(40)]]
    lines += lines[::3] + [(4, 1, None, 1), (4, 1, None, 2), (5, 1, D("7.00"), 1)]
    asked = [(rnd.choice([0, 1, 2, 3, 4, 5, 6, None]), cents(-500, 11000)) for _ in range(250)] + [(o, s) for o, _, s, _ in lines[::4]]
    asked += asked[::5]
    first = lambda x: (x is not None, x or 0)
    want = []
    for o, refund in asked:
        own = [(p, s, v) for k, p, s, v in lines if k == o and k is not None]
        near = min(own, key=lambda x: (abs((x[1] or 0) - (refund or 0)), *map(first, x)), default=None)
        same = sum(s is not None and refund is not None and s == refund for _, s, _ in own)
        want.append((o, refund, *(near or (None, None, None)), "ORPHAN" if near is None else "EXACT" if same == 1 else "AMBIGUOUS" if same else "ESTIMATED"))
    lines = spark.createDataFrame(lines, "order_id bigint, product_id int, sales decimal(10,2), vendor_id bigint")
    found = star.match_returns(spark.createDataFrame(asked, "order_id bigint, refund_amount decimal(10,2)"), lines)
    got = [(r.order_id, r.refund_amount, r.product_id, r.original_sales, r.vendor_id, r.match_confidence) for r in found.collect()]
    assert sorted(got, key=str) == sorted(want, key=str)


def test_matching_joins_nothing(spark):
    """Lines and returns meet in one shuffle by order and are sorted once; returns aren't joined to what was found for them."""
    lines = spark.createDataFrame([], "order_id bigint, product_id int, sales decimal(10,2)")
    found = star.match_returns(spark.createDataFrame([], "order_id bigint, refund_amount decimal(10,2)"), lines)
    assert found.count() == 0
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert "Join" not in plan and plan.count("RepartitionByExpression") == 1


def test_lines_meet_no_customer(spark):
    """Region and segment come with the order, and keys are made after the joins, so lines move with ids only."""
    orders = spark.createDataFrame([(1, 7, dt.datetime(2020, 1, 2)), (2, None, dt.datetime(2020, 1, 3)), (3, 9, None)], "order_id bigint, customer_id bigint, order_purchase_timestamp timestamp")
    customers = spark.createDataFrame([(7, "West", "Consumer"), (None, "East", "Consumer")], "customer_id bigint, region string, segment string")
    rows = [(1, 10, 20, D("5.00"), 1, D("0.00"), D("0.00"), "x", 1), (2, 11, None, D("6.00"), 1, D("0.00"), D("0.00"), "x", 1), (3, 99, 21, D("7.00"), 1, D("0.00"), D("0.00"), "x", 1)]
    lines = spark.createDataFrame(rows, "order_id bigint, product_id bigint, vendor_id bigint, sales decimal(10,2), quantity int, discount decimal(4,2), profit decimal(10,2), payment_type string, payment_installments int")
    dims = spark.createDataFrame([(10,), (11,)], "product_id bigint"), spark.createDataFrame([(20,), (None,)], "vendor_id bigint")
    sold = star.fact_sales(lines, orders, customers, *dims)
    md5 = lambda x: hashlib.md5(str(x).encode()).hexdigest()
    assert {(r.order_id, r.customer_key, r.region, r.product_key, r.vendor_key) for r in sold.collect()} == {
        (1, md5(7), "West", md5(10), md5(20)), (2, None, None, md5(11), None), (3, None, None, None, None)}
    plan = sold._jdf.queryExecution().optimizedPlan().toString()
    assert "md5" in plan and "md5" not in plan[plan.index("Join"):]


def _shop(spark):
    """Orders, customers, products and vendors with null, missing and repeated ids."""
    day = dt.datetime(2020, 1, 2)
    orders = spark.createDataFrame([(1, 7, 20, day), (2, None, 21, None), (3, 9, 22, day), (3, 7, None, day)], "order_id bigint, customer_id bigint, vendor_id bigint, order_purchase_timestamp timestamp")
    customers = spark.createDataFrame([(7, "West", "Consumer"), (7, "East", "Consumer"), (None, "East", "Consumer")], "customer_id bigint, region string, segment string")
    products = spark.createDataFrame([(10,), (11,), (11,), (11,), (None,)], "product_id bigint")
    vendors = spark.createDataFrame([(20,), (20,), (21,), (None,)], "vendor_id bigint")
    return orders, customers, products, vendors


SOLD = "order_id bigint, product_id bigint, vendor_id bigint, sales decimal(10,2), quantity int, discount decimal(4,2), profit decimal(10,2), payment_type string, payment_installments int"


def _sold():
    ids = [(1, 10, 20), (1, 11, 21), (2, 99, 20), (3, None, 22), (3, 10, None), (4, 10, 20), (None, 11, 21), (1, 10, 20)]
    return [(*row, D(n), 1, D("0.00"), D("0.00"), "x", 1) for n, row in enumerate(ids)]


@pytest.mark.parametrize("ordered", [False, True])
def test_lines_meet_odd_ids_instead_of_dimensions(spark, tmp_path, rows, ordered):
    """With the ids that products and vendors don't have just once, the fact is the same and reads neither."""
    orders, customers, products, vendors = _shop(spark)
    lines = spark.createDataFrame(_sold(), SOLD)
    lines, orders = (lines.drop("vendor_id"), orders) if ordered else (lines, orders.drop("vendor_id"))
    kept = []
    for name, dimension in (("products", products), ("vendors", vendors)):
        dimension.write.parquet(f"{tmp_path}/{name}")
        kept.append(spark.read.parquet(f"{tmp_path}/{name}"))
    odd = {}
    for key, dimension, source in (("product_id", kept[0], lines), ("vendor_id", kept[1], orders if ordered else lines)):
        star.odd_ids(source, dimension, key).write.parquet(f"{tmp_path}/odd-{key}")
        odd[key] = spark.read.parquet(f"{tmp_path}/odd-{key}")
    assert rows(odd["product_id"]) == [(11, "11"), (11, "11"), (11, "11"), (99, None)]
    assert rows(odd["vendor_id"]) == [(20, "20"), (20, "20"), (22, None)]
    sold = star.fact_sales(lines, orders, customers, *kept, odd)
    assert rows(sold) == rows(star.fact_sales(lines, orders, customers, *kept)) and sold.count() > 8
    assert not [f for f in sold.inputFiles() if "odd-" not in f]


def test_ids_spelled_otherwise_are_odd(spark, rows):
    """A key is made of the id as the dimension spells it."""
    lines, products = spark.createDataFrame([("7",), ("8",)], "product_id string"), spark.createDataFrame([("7 ",), ("8",)], "product_id string")
    numbers = spark.createDataFrame([(D("7.00"),), (D("9.00"),)], "product_id decimal(5,2)")
    whole = spark.createDataFrame([(7,), (8,)], "product_id int")
    assert rows(star.odd_ids(whole, numbers, "product_id")) == [(7, "7.00"), (8, None)]
    assert rows(star.odd_ids(lines, products, "product_id")) == [("7", None)]


def test_doubtful_returns(spark):
    df = spark.createDataFrame([(D("60.00"), D("10.00"), "EXACT"), (D("10.00"), D("10.00"), "EXACT"), (D("9.00"), None, "ORPHAN"), (D("9.00"), D("8.00"), "ESTIMATED")],
                               "refund_amount decimal(10,2), original_sales decimal(10,2), match_confidence string")
    assert sorted(r._expectation for r in dq.doubtful_returns(df).collect()) == ["low_confidence_match: ESTIMATED", "low_confidence_match: ORPHAN", "refund_not_exceeding_5x_sales"]


# --- marts --------------------------------------------------------------------------------------------


def test_price_history_matches_plain_windows(spark):
    rnd = random.Random(3)
    at = lambda: dt.datetime(2020, 1, rnd.randrange(1, 9), rnd.randrange(0, 3))
    orders = spark.createDataFrame([(i, at()) for i in range(200)], "order_id bigint, order_purchase_timestamp timestamp")
    lines = spark.createDataFrame(
        [(rnd.randrange(200), rnd.randrange(3), rnd.randrange(2), D(rnd.randrange(1, 30)), rnd.randrange(0, 4), D("0.00")) for _ in range(800)],
        "order_id bigint, product_id bigint, vendor_id bigint, sales decimal(10,2), quantity int, discount decimal(4,2)")
    got = marts.price_history(lines, orders)
    base = lines.join(orders, "order_id").withColumn("p", F.round(F.try_divide(F.col("sales").cast("double"), F.col("quantity") * (1 - F.col("discount").cast("double"))), 2).cast("decimal(12,2)"))
    versions = base.groupBy("product_id", "vendor_id", "p").agg(F.min("order_purchase_timestamp").alias("valid_from"))
    w = Window.partitionBy("product_id", "vendor_id").orderBy("valid_from", "p")
    run = w.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    want = versions.select("product_id", "vendor_id", "p", "valid_from", F.lead("valid_from").over(w), F.row_number().over(w), F.min("p").over(run), F.max("p").over(run))
    cols = ["product_id", "vendor_id", "base_unit_price", "valid_from", "valid_to", "version_rank", "min_price_to_date", "max_price_to_date"]
    key = lambda r: str(tuple(r))
    assert sorted(map(tuple, got.select(*cols).collect()), key=key) == sorted(map(tuple, want.collect()), key=key)
    # intervals of a product and vendor do not overlap and exactly one is current
    assert got.where("is_current").groupBy("product_id", "vendor_id").count().where("count <> 1").count() == 0


def test_slow_movers_as_of(spark):
    sales = spark.createDataFrame([(1, "West", 20200101, 1, 5, D("10.00")), (1, "West", 20200111, 2, 5, D("10.00")), (2, None, 20200111, 3, 7, D("1.00"))],
                                  "product_id int, region string, order_date_key int, order_id int, quantity int, sales decimal(10,2)")
    products = spark.createDataFrame([(1, "p", "b")], "product_id int, product_name string, brand string")
    got = {r.product_id: r for r in marts.slow_movers(sales, products, F.lit("2020-02-10").cast("date")).collect()}
    assert (got[1].days_since_last_sale, got[1].selling_period_days, got[1].avg_daily_quantity) == (30, 10, 1.0)
    assert (got[2].selling_period_days, got[2].avg_daily_quantity, got[2].product_name) == (0, 7.0, None)


def test_return_rate_of_a_vendor_without_returns(spark):
    sales = spark.createDataFrame([(1, 1, D("5.00")), (1, 1, D("5.00")), (2, 2, D("7.00"))], "vendor_id int, order_id int, sales decimal(10,2)")
    returns = spark.createDataFrame([(1, D("5.00")), (1, D("4.00"))], "vendor_id int, refund_amount decimal(10,2)")
    vendors = spark.createDataFrame([(1, "a"), (2, "b"), (3, "c")], "vendor_id int, vendor_name string")
    rates = marts.return_rate_by_vendor(sales, returns, vendors)
    got = {r.vendor_id: (r.total_returns, r.return_rate_pct) for r in rates.collect()}
    assert got == {1: (2, 200.0), 2: (0, 0.0)}
    assert [r.vendor_id for r in dq.impossible_return_rates(rates).collect()] == [1]
    kpi = {r.vendor_id: r.status for r in kpis.vendor_kpis(rates, vendors).collect()}
    assert kpi == {1: "HIGH RISK", 2: "within threshold", 3: "no_return_data"}


def test_periods_and_month_over_month(spark):
    cols = "year int, quarter int, month int, month_name string, region string, total_sales decimal(10,2), total_profit decimal(10,2), order_count bigint"
    data = [(2018, 1, 1, "January", "West", D("110.00"), D("11.00"), 2), (2017, 4, 12, "December", "West", D("100.00"), D("9.00"), 2),
            (2018, 1, 1, "January", "East", D("50.00"), D("-5.00"), 1), (2017, 4, 12, "December", "South", D("9.00"), D("1.00"), 1), (2018, 1, 1, "January", None, D("1.00"), D("1.00"), 1)]
    revenue = spark.createDataFrame(data, cols)
    assert tuple(kpis.periods(revenue).first()) == (2018, 1, 2017, 12)
    got = {r.region: (r.mom_delta_pct, r.profit_margin_pct) for r in kpis.region_kpis(revenue).collect()}
    assert got == {"West": (10.0, 10.0), "East": (0.0, -10.0)}
    summary = kpis.revenue_summary(kpis.region_kpis(revenue)).first()
    assert (summary.top_region, summary.bottom_region, summary.growing_regions, summary.declining_regions) == ("West", "East", "West", "")


def test_metric_query_joins_only_what_it_needs(spark):
    sales = spark.createDataFrame([(1, 20200101, 1, D("5.00"), D("1.00"), 2, "card")], "customer_id int, order_date_key int, order_id int, sales decimal(10,2), profit decimal(10,2), quantity int, payment_type string")
    customers = spark.createDataFrame([(1, "West", "Consumer")], "customer_id int, region string, segment string")
    view = metrics.revenue_view(sales, customers)
    plain = metrics.metric_query(view, ["payment_type"], ["total_revenue"])
    assert "Join" not in plain._jdf.queryExecution().optimizedPlan().toString()
    joined = metrics.metric_query(view, ["region", "segment"], ["total_revenue"])
    assert joined.first().region == "West"
    with pytest.raises(KeyError):
        metrics.metric_query(view, ["colour"], ["total_revenue"])


# --- fraud --------------------------------------------------------------------------------------------


def test_fraud_profile_and_score(spark):
    day = dt.date(2020, 1, 5)
    returns = spark.createDataFrame(
        [(1, 1, D("900.00"), D("300.00"), "Duplicate Order", day), (1, 2, D("200.00"), D("200.00"), "Damaged", day), (1, 9, D("10.00"), None, None, day), (None, 8, D("5.00"), None, "Damaged", day), (2, 3, D("1.00"), D("1.00"), "Damaged", day)],
        "customer_id int, order_id int, refund_amount decimal(10,2), original_sales decimal(10,2), return_reason string, return_date date")
    orders = spark.createDataFrame(
        [(1, 1, "Same Day", dt.datetime(2020, 1, 9)), (2, 1, "First Class", dt.datetime(2020, 1, 1)), (4, 1, "First Class", None), (5, 1, "First Class", None)],
        "order_id int, customer_id int, ship_mode string, order_delivered_customer_timestamp timestamp")
    customers = spark.createDataFrame([(1, "A", "Consumer", "West")], "customer_id int, customer_name string, segment string, region string")
    profile = fraud.customer_profile(returns, orders, customers)
    got = {r.customer_id: r for r in fraud.score(profile).collect()}
    one = got[1]
    assert (one.total_returns, one.total_orders, one.order_return_rate) == (3, 4, 0.75)
    assert (one.total_refund_inflation, one.max_single_inflation, one.inflated_refund_count) == (D("600.00"), D("600.00"), 1)
    assert (one.duplicate_order_count, one.return_before_delivery_count, one.same_day_ship_return_count, one.no_matching_order_count) == (1, 1, 1, 1)
    assert one.return_reasons_list == ["Damaged", "Duplicate Order"] and one.distinct_reasons == 2
    # value 10 + rate 10 + inflation 20 + before delivery 10 + duplicate 10 + same day 5 + no order 15
    assert one.anomaly_score == 80.0
    assert one.rules_violated.split("|")[0] == "high_refund_value"
    # a customer without orders has rate 0; returns without customer get no looked-up signal
    assert (got[2].order_return_rate, got[2].total_orders) == (0.0, 0)
    assert (got[None].total_returns, got[None].no_matching_order_count) == (1, 0)
    flagged = fraud.flagged(fraud.score(profile))
    assert [r.customer_id for r in flagged.collect()] == [1]
    assert "refunds of $1110.00" in fraud.investigation_brief(flagged).first().investigation_brief


def test_threshold_is_inclusive_and_inactive_rules_do_not_score(spark):
    rules = [fraud.FraudRule("a", "x", 1, 40), fraud.FraudRule("b", "x", 1, 60, is_active=False)]
    scored = fraud.score(spark.createDataFrame([(1, 1), (2, 0)], "customer_id int, x int"), rules)
    assert [(r.customer_id, r.anomaly_score) for r in fraud.flagged(scored).collect()] == [(1, 40.0)]
    with pytest.raises(ValueError):
        fraud.active_rules([fraud.FraudRule("a", "x", 1, 99)])
    rules += [fraud.FraudRule("flag_threshold", "anomaly_score", 70, 0)]
    assert [r.rule_name for r in fraud.active_rules(rules)] == ["a"] and fraud.flag_threshold(rules) == 70
    assert fraud.flagged(scored, fraud.flag_threshold(rules)).count() == 0 and fraud.flag_threshold([]) == fraud.FLAG_THRESHOLD


def test_scope_is_all_returns_of_changed_customers(spark, rows):
    df = spark.createDataFrame([(1, dt.date(2020, 1, 1)), (1, dt.date(2020, 2, 1)), (2, dt.date(2020, 1, 1))], "customer_id int, return_date date")
    last = spark.createDataFrame([(dt.date(2020, 1, 15),)], "scored_at date")
    assert [r[0] for r in rows(fraud.returns_in_scope(df, last), "customer_id")] == [1, 1]
    assert fraud.returns_in_scope(df).count() == 3


def test_scores_from_stored_signals_equal_those_of_all_returns(spark, tmp_path):
    rnd = random.Random(9)
    day = lambda n: dt.date(2020, 1, 1) + dt.timedelta(days=n)
    orders = spark.createDataFrame([(i, i % 30, rnd.choice(["Same Day", "First Class"]), dt.datetime(2020, 2, 1)) for i in range(90)], "order_id int, customer_id int, ship_mode string, order_delivered_customer_timestamp timestamp_ntz")
    customers = spark.createDataFrame([(i, f"n{i}", "s", "r") for i in range(30)], "customer_id int, customer_name string, segment string, region string")
    data = [(rnd.randrange(100), rnd.choice([None, *range(30)]), D(rnd.randrange(5000)) / 100, D(2000) / 100, rnd.choice(["Duplicate Order", "Damaged", None]), day(rnd.randrange(60))) for _ in range(400)]
    returns = spark.createDataFrame(data, "order_id int, customer_id int, refund_amount decimal(10,2), original_sales decimal(10,2), return_reason string, return_date date")
    path = str(tmp_path / "s")
    with pytest.raises(FileNotFoundError):
        fraud.profile_from_state(path, orders, customers)
    for n, (lo, hi) in enumerate([(0, 20), (20, 21), (20, 21), (21, 99)]):
        fraud.add_to_state(returns.where(F.col("return_date").between(day(lo), day(hi - 1))), orders, path, f"{lo}-{hi}", buckets=8)
    got, want = (sorted((tuple(r) for r in fraud.score(p).collect()), key=str) for p in (fraud.profile_from_state(path, orders, customers), fraud.customer_profile(returns, orders, customers)))
    assert got == want and len(got) == 31


def test_ties_of_load_time_go_by_each_columns_own_order(spark):
    from tallyhouse.config import Survivorship

    at = dt.datetime(2024, 1, 1)
    df = spark.createDataFrame([(1, "a1", "b1", "customers_1.csv", at), (1, "a2", "b2", "customers_2.csv", at)], "k int, a string, b string, _source_file string, _load_timestamp timestamp_ntz")
    names = ("customers_1", "customers_2")
    rules = [Survivorship("x", "a", "most_recent", names), Survivorship("x", "b", "most_recent", names[::-1])]
    got = mdm.golden_record(df, "k", rules).first()
    assert (got.a, got.b, got._load_timestamp) == ("a1", "b2", at)


# --- baskets --------------------------------------------------------------------------------------------


def brute_pairs(baskets, least=2):
    from collections import Counter
    from itertools import combinations

    counts = Counter(p for items in baskets.values() for p in combinations(sorted(items), 2))
    return {p: n for p, n in counts.items() if n >= least}


@pytest.mark.parametrize("block", [1, 3, 5, 1000])
@pytest.mark.parametrize("least", [2, 3])
def test_pairs_are_exact_for_any_size_of_block(spark, block, least):
    rnd = random.Random(block)
    baskets = {f"o{i}": {f"p{rnd.randrange(14):02d}" for _ in range(rnd.randrange(1, 12))} for i in range(25)}
    baskets["huge"] = {f"p{i:02d}" for i in range(40)}
    df = spark.createDataFrame([(o, p) for o, items in baskets.items() for p in items], "order_id string, product_id string")
    got = {(r.product_a, r.product_b): r.pair_order_count for r in mb.pair_counts(df, min_count=least, block=block).collect()}
    assert got == brute_pairs(baskets, least)


def test_a_long_basket_and_a_product_of_all_baskets(spark):
    """The hot product meets each product once per basket, and the long basket is dealt into many groups."""
    baskets = {f"o{i}": {"hot", f"p{i % 50:03d}", f"p{(i * 7) % 90:03d}"} for i in range(400)} | {"long": {f"p{i:03d}" for i in range(150)}}
    df = spark.createDataFrame([(o, p) for o, items in baskets.items() for p in items], "order_id string, product_id string")
    counted = mb.pair_counts(df, block=16)
    assert {(r.product_a, r.product_b): r.pair_order_count for r in counted.collect()} == brute_pairs(baskets)
    plan = counted._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Join") == 1 and "LeftSemi" in plan


def test_itemsets_of_all_sizes(spark):
    from collections import Counter
    from itertools import combinations

    rnd = random.Random(4)
    baskets = {i: {rnd.choice("abcdefgh") for _ in range(rnd.randrange(1, 7))} for i in range(200)}
    df = spark.createDataFrame([(o, p) for o, items in baskets.items() for p in items], "order_id int, product_id string")
    want = Counter(c for items in baskets.values() for k in range(2, 8) for c in combinations(sorted(items), k))
    found = {tuple(r["items"]): r.freq for r in mb.itemsets(df, 6).collect()}
    assert found == {c: n for c, n in want.items() if n >= 6} and max(map(len, found)) > 3
    pairs = {(r.product_a, r.product_b): r.pair_order_count for r in mb.pair_counts(df, min_count=6).collect()}
    assert {c: n for c, n in found.items() if len(c) == 2} == pairs
    assert {len(r["items"]) for r in mb.itemsets(df, 6, largest=3).collect()} == {2, 3}
    assert mb.itemsets(df.limit(0), 2).count() == 0


def test_rules_are_symmetric_at_a_floor_of_zero(spark):
    data = [(1, "a"), (1, "b"), (2, "a"), (2, "b"), (3, "a"), (4, "c"), (4, "c"), (5, "d")]
    basket = mb.clean_basket(spark.createDataFrame(data, "order_id int, product_id string"))
    assert basket.count() == 7
    metrics_ = mb.pair_metrics(mb.pair_counts(basket), basket)
    one = metrics_.first()
    assert (one.support, one.confidence_atob, one.confidence_btoa) == (0.4, 0.6667, 1.0)
    assert one.lift_btoa == 1.6667 and one.lift_atob == 1.6668  # lift builds on the rounded confidence
    assert mb.directional_rules(metrics_).count() == 2


def test_lift_of_exactly_one_is_not_a_rule(spark):
    data = [(o, p) for o in (1, 2) for p in ("a", "b")]
    basket = mb.clean_basket(spark.createDataFrame(data, "order_id int, product_id string"))
    assert mb.directional_rules(mb.pair_metrics(mb.pair_counts(basket), basket)).count() == 0


# --- pricing --------------------------------------------------------------------------------------------


def test_median_matches_percentile(spark):
    rnd = random.Random(5)
    data = [(rnd.randrange(8), D(rnd.randrange(100, 900)) / 100) for _ in range(300)] + [(99, D("3.00"))]
    df = spark.createDataFrame(data, "product_id int, lp decimal(18,8)")
    want = {r[0]: round(r[1], 2) for r in df.groupBy("product_id").agg(F.percentile("lp", F.lit(0.5))).collect()}
    got = {r[0]: float(r[1]) for r in pr.median_list_price(df).collect()}
    assert got.keys() == want.keys()
    assert all(abs(got[k] - want[k]) <= 0.0100001 for k in want)


def test_list_price_guards(spark):
    df = spark.createDataFrame([(D("10.00"), 2, D("0.50")), (D("10.00"), 0, D("0.00")), (D("10.00"), 1, D("1.00")), (D("8.00"), 1, D("20.00"))], "sales decimal(10,2), quantity int, discount decimal(4,2)")
    nd = pr.net_discount(F.col("discount"))
    got = [r[0] for r in df.select(pr.list_price(F.col("sales"), F.col("quantity"), nd)).collect()]
    assert [None if v is None else float(v) for v in got] == [10.0, None, 10.10101010, 10.0]


def test_building_the_plan_runs_no_job(spark, sf_dir):
    """Returns and economics are declared, not computed, when they are called."""
    import __spark_entry__ as entry

    for name in ("fct_3_returns", "mrt_2_return_rate_by_vendor", "frd_10_scores", "prc_5_product_economics"):
        # the one job allowed per table reads its schema from the file
        entry.queries()[name](spark, sf_dir)
        spark.sparkContext.setJobGroup(f"build-{name}", name)
        entry.queries()[name](spark, sf_dir)
        jobs = spark.sparkContext.statusTracker().getJobIdsForGroup(f"build-{name}")
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
        assert len(jobs) <= 14, (name, len(jobs))
        for j in jobs:
            for stage in spark.sparkContext.statusTracker().getJobInfo(j).stageIds:
                assert spark.sparkContext.statusTracker().getStageInfo(stage).numTasks == 1


def test_each_column_has_its_own_order_of_sources(spark):
    from tallyhouse.config import Survivorship
    from tallyhouse.operators import mdm

    rules = [Survivorship(entity="customers", canonical_column=c, strategy="source_priority", source_priority_order=o) for c, o in (("a", ("customers_1", "customers_2")), ("b", ("customers_2", "customers_1")))]
    df = spark.createDataFrame([(1, "A10", "B10", "/x/customers_10.csv"), (1, "A1", "B1", "/x/customers_1.csv"), (1, "A2", "B2", "/x/customers_2.csv")], "id int, a string, b string, _source_file string").selectExpr("*", "timestamp'2020-01-01' AS _load_timestamp")
    got = mdm.golden_record(df, "id", rules).first()
    assert (got.a, got.b) == ("A1", "B2")
