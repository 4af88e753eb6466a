"""Data-quality rules, quarantine, scorecards and audit reports."""

from __future__ import annotations

import re
from collections.abc import Iterable
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, Window, functions as F

from tallyhouse.config import (
    CRITICAL_COUNT,
    CRITICAL_ISSUES,
    ENTITY_REPORTS,
    FAILED_CALL_PREFIX,
    HIGH_COUNT,
    HIGH_ISSUES,
    IMPACT,
    JARGON_PHRASES,
    LINEAGE_COLUMNS,
    REFUND_LIMIT_FACTOR,
    REFUSAL_PHRASES,
    REPORT_SECTIONS,
    Rule,
)
from tallyhouse.functions.numbers import count_if, ratio
from tallyhouse.session import work_dir

AUDIT_COLUMNS = (
    "_run_id", "_run_timestamp", "_expectation_name", "_severity", "_issue_type", "_failure_reason", "_quarantine_timestamp",
)


def holds(rule: Rule | str) -> Column:
    return F.expr(rule if isinstance(rule, str) else rule.rule_expression)


def text(value: str) -> str:
    """A SQL string literal."""
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def rule_rows(rules: list[Rule], template: str) -> Column:
    """One row per rule from the counters of a one-row aggregate.

    Built as a single piece of SQL text: a few dozen rules would otherwise cost hundreds of
    round trips to the JVM.
    """
    rows = [
        template.format(i=i, rule_id=text(r.rule_id), rule_name=text(r.rule_name), expression=text(r.rule_expression), consequence=text(r.consequence))
        for i, r in enumerate(rules)
    ]
    return F.expr(f"inline(array({', '.join(f'named_struct({row})' for row in rows)}))")


def expect(df: DataFrame, name: str, rules: Iterable[Rule]) -> tuple[DataFrame, Observation]:
    """Keep all rows and count violations while they pass by, without a job of its own."""
    seen = Observation(name)
    metrics = [count_if(~F.coalesce(holds(r), F.lit(False))).alias(r.rule_name) for r in rules]
    return df.observe(seen, F.count(F.lit(1)).alias("rows"), *metrics), seen


def violation_counts(df: DataFrame, rules: Iterable[Rule]) -> DataFrame:
    """``rule_id, rule_name, violations`` for all rules in one pass; NULL counts as violated."""
    rules = list(rules)
    counted = df.agg(*[F.expr(f"count_if(NOT coalesce({r.rule_expression}, false)) AS v{i}") for i, r in enumerate(rules)])
    return counted.select(rule_rows(rules, "'rule_id', {rule_id}, 'rule_name', {rule_name}, 'violations', v{i}"))


def drop_violations(df: DataFrame, rules: Iterable[Rule]) -> DataFrame:
    """Remove rows that break a rule whose consequence is ``drop``."""
    keep = [F.coalesce(holds(r), F.lit(False)) for r in rules if r.consequence == "drop"]
    return df.where(reduce(lambda a, b: a & b, keep)) if keep else df


def quarantine(
    df: DataFrame, rules: Iterable[Rule], run_id: str, run_timestamp: Column | None = None, null_fails: bool = False
) -> DataFrame:
    """One output row per row and broken rule, in a single pass over the input.

    With ``null_fails=False`` a predicate that is NULL counts as not broken (``NOT NULL`` is
    NULL in SQL), which is how the rule text reads; ``True`` treats it as broken.
    """
    at = run_timestamp if run_timestamp is not None else F.current_timestamp()
    broken = [
        f"CASE WHEN NOT ({f'coalesce({r.rule_expression}, false)' if null_fails else r.rule_expression}) THEN named_struct("
        f"'_expectation_name', {text(r.rule_name)}, '_severity', {text(r.severity)}, '_issue_type', {text(r.issue_type)}, '_failure_reason', {text(r.failure_reason)}) END"
        for r in rules
    ]
    meta = "array<struct<_expectation_name:string,_severity:string,_issue_type:string,_failure_reason:string>>"
    tags = F.expr(f"array_compact(array({', '.join(broken)}))" if broken else f"cast(array() AS {meta})")
    columns = df.columns
    # the outer form keeps Spark from adding a filter that would evaluate every rule, and the
    # cleaning below it, a second time
    return df.withColumn("_tag", F.explode_outer(tags)).where("_tag IS NOT NULL").select(
        *columns,
        F.lit(run_id).alias("_run_id"),
        at.alias("_run_timestamp"),
        "_tag._expectation_name", "_tag._severity", "_tag._issue_type", "_tag._failure_reason",
        at.alias("_quarantine_timestamp"),
    )


def scorecard(df: DataFrame, rules: Iterable[Rule]) -> DataFrame:
    """Passed, failed and pass rate per rule from one aggregation."""
    rules = list(rules)
    counted = df.agg(F.expr("count(1) AS n"), *[F.expr(f"count_if({r.rule_expression}) AS p{i}") for i, r in enumerate(rules)])
    lines = counted.select("n", rule_rows(rules, (
        "'rule_id', {rule_id}, 'rule_name', {rule_name}, 'expression', {expression}, 'consequence', {consequence}, 'passed', p{i}, 'failed', n - p{i}")))
    return lines.withColumn("pass_rate_pct", ratio(F.col("passed"), F.col("n"), 1, 100)).drop("n")


def stack_entities(frames: dict[str, DataFrame], columns: list[str] | None = None) -> DataFrame:
    """Union of frames with different layouts, tagged by entity."""
    parts = [(d.select(*columns) if columns else d).withColumn("entity", F.lit(e)) for e, d in frames.items()]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)


def quarantine_breakdown(frames: dict[str, DataFrame]) -> DataFrame:
    keys = ["_expectation_name", "_severity", "_issue_type", "_failure_reason"]
    return stack_entities(frames, keys).groupBy("entity", *keys).agg(F.count(F.lit(1)).alias("cnt"))


def clean_vs_quarantined(clean: dict[str, DataFrame], quarantined: dict[str, DataFrame]) -> DataFrame:
    """Row counts of both sides per entity and the quarantined share."""
    sides = stack_entities({e: d.select(F.lit(0).alias("bad")) for e, d in clean.items()}).unionByName(
        stack_entities({e: d.select(F.lit(1).alias("bad")) for e, d in quarantined.items()})
    )
    counted = sides.groupBy("entity").agg(
        F.count(F.lit(1)).alias("total_bronze_rows"),
        count_if(F.col("bad") == 0).alias("silver_clean_rows"),
        count_if(F.col("bad") == 1).alias("quarantined_rows"),
    )
    return counted.withColumn("quarantine_rate_pct", ratio(F.col("quarantined_rows"), F.col("total_bronze_rows"), 1, 100))


def before_after(before: DataFrame, after: DataFrame, column_before: Column, column_after: Column) -> DataFrame:
    """Value distribution of a column on both sides of a transformation."""
    both = before.select(column_before.cast("string").alias("value"), F.lit(1).alias("b"), F.lit(0).alias("a")).unionByName(
        after.select(column_after.cast("string").alias("value"), F.lit(0).alias("b"), F.lit(1).alias("a"))
    )
    return both.groupBy("value").agg(F.sum("b").alias("before_count"), F.sum("a").alias("after_count"))


def assert_clean(df: DataFrame, conditions: dict[str, Column]) -> DataFrame:
    """Rows that still match a dirt pattern, per check; expected 0."""
    counted = df.agg(*[count_if(c).alias(f"d{i}") for i, c in enumerate(conditions.values())])
    rows = [
        F.struct(
            F.lit(n).alias("check_name"), F.col(f"d{i}").alias("residual"),
            F.when(F.col(f"d{i}") == 0, "OK").otherwise("DIRTY").alias("status"),
        )
        for i, n in enumerate(conditions)
    ]
    return counted.select(F.inline(F.array(*rows)))


# --- gold expectations ----------------------------------------------------------------------


def _flag(df: DataFrame, bad: Column, name: Column | str, impact: Column | str) -> DataFrame:
    as_col = lambda v: v if isinstance(v, Column) else F.lit(v)
    return df.where(bad).withColumns(
        {"_expectation": as_col(name), "_severity": F.lit("WARNING"), "_business_impact": as_col(impact)}
    )


def orphan_sales(sales: DataFrame, key: str = "customer_id") -> DataFrame:
    """Sales without customer; ``key`` may also name the surrogate key."""
    return _flag(sales, F.col(key).isNull(), "no_orphan_customers", "Revenue without customer, segment and region")


def doubtful_returns(returns: DataFrame) -> DataFrame:
    """Refunds above five times the sale, or returns without a certain match."""
    match = F.col("match_confidence")
    over = F.col("original_sales").isNotNull() & (F.col("refund_amount") > F.col("original_sales") * REFUND_LIMIT_FACTOR)
    weak = match.isin("AMBIGUOUS", "ESTIMATED", "ORPHAN")
    name = F.when(match == "EXACT", "refund_not_exceeding_5x_sales").otherwise(F.concat_ws(": ", F.lit("low_confidence_match"), match))
    impact = (
        F.when(match == "ORPHAN", "No line found for the returned order")
        .when(match == "AMBIGUOUS", "Several lines share the refunded price")
        .when(match == "ESTIMATED", "No line with the refunded price, nearest one taken")
        .otherwise("Refund above five times the sale")
    )
    return _flag(returns, F.coalesce(over, F.lit(False)) | weak, name, impact)


def revenue_without_region(revenue: DataFrame) -> DataFrame:
    return _flag(revenue, F.col("region").isNull(), "region_not_null", "Revenue without region")


def impossible_return_rates(rates: DataFrame) -> DataFrame:
    r = F.col("return_rate_pct")
    return _flag(rates, r.isNotNull() & ((r < 0) | (r > 100)), "return_rate_in_range", "Return rate outside 0 to 100")


def invalid_idle_days(slow: DataFrame) -> DataFrame:
    d = F.col("days_since_last_sale")
    return _flag(slow, d.isNull() | (d < 0), "valid_days_since_sale", "Idle stock stays unseen")


def gold_rule_report(quarantines: dict[str, DataFrame], rules: DataFrame) -> DataFrame:
    """Failing rows and one sample of evidence per gold rule; a missing table counts 0.

    ``rules`` has one row per rule (``rule_name, table_checked, field_checked,
    business_failure, trigger_condition``).
    """
    parts = [
        d.agg(F.count(F.lit(1)).alias("failing_count"), F.min("_business_impact").alias("sample_evidence"))
        .withColumn("rule_name", F.lit(n))
        for n, d in quarantines.items()
    ]
    counted = reduce(DataFrame.unionByName, parts)
    return rules.join(counted, "rule_name", "left").fillna({"failing_count": 0})


# --- column profile and findings ---------------------------------------------------------------


def _value_columns(df: DataFrame) -> list[str]:
    return [c for c in df.columns if c not in LINEAGE_COLUMNS and f"_{c}" not in LINEAGE_COLUMNS]


def _cells(frames: dict[str, DataFrame]) -> tuple[DataFrame, list[tuple[str, str]]]:
    """All values of all columns as texts, ``at, value``, and the entity and column that each ``at`` stands for."""
    parts, names = [], []
    for entity, df in frames.items():
        cells = []
        for c in _value_columns(df):
            cells.append(F.struct(F.lit(len(names)).alias("at"), F.col(f"`{c}`").cast("string").alias("value")))
            names.append((entity, c))
        parts.append(df.select(F.inline(F.array(*cells))))
    return reduce(DataFrame.unionByName, parts), names


def _named(names: list[tuple[str, str]]) -> list[Column]:
    """``entity, column_name`` of ``at``."""
    return [F.array(*[F.lit(n[i]) for n in names])[F.col("at")].alias(c) for i, c in enumerate(("entity", "column_name"))]


def column_values(frames: dict[str, DataFrame]) -> DataFrame:
    """Distinct values with their counts, per column: ``entity, column_name, value, n``.

    All entities go through one shuffle, in which a number stands for entity and column. Values are counted map-side before it,
    and it is by column and value, so a value that fills a third of the table costs one row per task.
    """
    cells, names = _cells(frames)
    return cells.groupBy("at", "value").agg(F.count(F.lit(1)).alias("n")).select(*_named(names), "value", "n")


def smallest_values(values: DataFrame, keys: list[str], k: int) -> DataFrame:
    """The ``k`` smallest values per key as a sorted list, from distinct ``value`` and ``n``.

    The rank filter lets every task keep ``k`` rows per key before the shuffle, so the list is
    never gathered whole. Ranking keeps ``n`` and the missing values, so that the count of
    values is the same shuffle for this and for the totals and Spark runs it once.
    """
    w = Window.partitionBy(*keys).orderBy(F.col("value").asc_nulls_last())
    ranked = values.withColumn("_rank", F.row_number().over(w)).where(F.col("_rank") <= k)
    return ranked.groupBy(*keys).agg(
        F.array_compact(F.transform(F.sort_array(F.collect_list(F.struct("value", "n"))), lambda s: s["value"])).alias("samples"))


def column_profile(frames: dict[str, DataFrame], k: int = 5) -> DataFrame:
    """Share of missing values, distinct values and up to ``k`` sample values per column of every entity."""
    values = column_values(frames)
    missing = F.col("value").isNull() | (F.trim("value") == "")
    keys = ["entity", "column_name"]
    counts = values.groupBy(*keys).agg(
        F.sum("n").alias("rows"),
        F.sum(F.when(missing, F.col("n")).otherwise(0)).alias("missing"),
        count_if(~missing).alias("distinct_values"),
    )
    out = counts.join(smallest_values(values, keys, k), keys, "left")
    return out.select(
        *keys, "rows", ratio(F.col("missing"), F.col("rows"), 1, 100).alias("null_pct"), "distinct_values",
        F.coalesce(F.array_join("samples", ", "), F.lit("")).alias("samples"),
    )


NUMBER = r"^\$?-?[0-9]+(\.[0-9]+)?%?$"
#: Half the width of the ranks around a quartile that a sketch brackets; its own error at the default size is about 0.013.
BRACKET = 0.03


def _number(value: Column) -> Column:
    return F.when(value.rlike(NUMBER), F.regexp_replace(value, "[$%]", "").cast("double"))


def exact_quartiles(raw: DataFrame, counted: DataFrame, keys: list[str]) -> DataFrame:
    """``q1`` and ``q3`` per key: the least value that a quarter (three quarters) of all values do not exceed.

    ``raw`` has a row per value ``x``, ``counted`` a row per distinct ``x`` with its count ``n``. Mergeable sketches
    bracket each quartile first; values below a bracket are only counted, and only those inside are put in order. Where
    the count shows that a bracket has missed its quartile, all values of that key take part, so the result is exact.
    """
    sketches = raw.groupBy(*keys).agg(F.kll_sketch_agg_double("x").alias("_s"))
    at = lambda rank: F.kll_sketch_get_quantile_double("_s", F.lit(min(1.0, max(0.0, rank))))
    brackets = sketches.select(*keys, F.inline(F.array(*[F.struct(F.lit(k).alias("_k"), at(k / 4 - BRACKET).alias("_lo"), at(k / 4 + BRACKET).alias("_hi")) for k in (1, 3)])))
    n = F.col("n")
    counts = counted.join(brackets, keys).groupBy(*keys, "_k", "_lo", "_hi").agg(
        F.sum(n).alias("_all"), F.sum(F.when(F.col("x") < F.col("_lo"), n).otherwise(0)).alias("_below"), F.sum(F.when(F.col("x") <= F.col("_hi"), n).otherwise(0)).alias("_upto"))
    place = F.floor((F.col("_k") * F.col("_all") + 3) / 4)
    sure = (F.col("_below") < place) & (place <= F.col("_upto"))
    ranges = counts.select(
        *keys, "_k", place.alias("_place"), F.when(sure, F.col("_lo")).otherwise(float("-inf")).alias("_lo"), F.when(sure, F.col("_hi")).otherwise(float("inf")).alias("_hi"),
        F.when(sure, F.col("_below")).otherwise(0).alias("_below"))
    running = F.col("_below") + F.sum(n).over(Window.partitionBy(*keys, "_k").orderBy("x"))
    near = counted.join(ranges, keys).where(F.col("x").between(F.col("_lo"), F.col("_hi"))).withColumn("_running", running)
    hit = near.where(F.col("_running") >= F.col("_place"))
    return hit.groupBy(*keys).agg(F.min(F.when(F.col("_k") == 1, F.col("x"))).alias("q1"), F.min(F.when(F.col("_k") == 3, F.col("x"))).alias("q3"))


def _outliers(frames: dict[str, DataFrame], values: DataFrame, stats: DataFrame, keys: list[str]) -> DataFrame:
    """Columns of numbers (nine in ten of the values that are no placeholder) with values far outside their quartiles."""
    numeric = stats.where(F.col("numeric_n") * 10 >= (F.col("rows") - F.col("placeholder_n")) * 9).where("numeric_n > 0").select(*keys)
    counted = values.withColumn("x", _number(F.col("value"))).where("x IS NOT NULL").groupBy(*keys, "x").agg(F.sum("n").alias("n")).join(numeric, keys, "left_semi")
    cells, names = _cells(frames)
    # sketched for all columns, as the cells themselves are not to be shuffled; ``counted`` has the numeric ones
    raw = cells.select(*_named(names), _number(F.col("value")).alias("x")).where("x IS NOT NULL")
    spread = F.col("q3") - F.col("q1")
    fences = exact_quartiles(raw, counted, keys).select(*keys, (F.col("q1") - 1.5 * spread).alias("lo"), (F.col("q3") + 1.5 * spread).alias("hi"))
    out = counted.join(fences, keys).where((F.col("x") < F.col("lo")) | (F.col("x") > F.col("hi"))).groupBy(*keys, "lo", "hi").agg(F.sum("n").alias("hits"))
    rule = F.concat("column_name", F.lit(" BETWEEN "), F.floor("lo").cast("string"), F.lit(" AND "), F.ceil("hi").cast("string"))
    return out.select(*keys, F.lit("outlier").alias("issue_type"), F.lit("WARNING").alias("severity"), F.col("hits").cast("bigint").alias("hits"), rule.alias("suggested_rule"))


STAMPS = ("yyyy-MM-dd H:mm", "MM/dd/yyyy H:mm", "yyyy-MM-dd'T'HH:mm:ss", "yyyy-MM-dd", "MM-dd-yyyy", "yyyy-MM-dd HH:mm:ss")
DATE_TYPES = ("date", "timestamp", "timestamp_ntz")


def _stamp(df: DataFrame, name: str) -> Column:
    if df.schema[name].dataType.typeName() in DATE_TYPES:
        return F.col(f"`{name}`").cast("timestamp_ntz")
    return F.coalesce(*[F.try_to_timestamp(F.col(f"`{name}`"), F.lit(p)) for p in STAMPS]).cast("timestamp_ntz")


def date_columns(df: DataFrame) -> list[str]:
    """Columns of a date type, and text columns whose name speaks of a date or time."""
    kinds = {f.name: f.dataType.typeName() for f in df.schema.fields}
    return [c for c in _value_columns(df) if kinds[c] in DATE_TYPES or kinds[c] == "string" and re.search(r"date|time|_at$", c)]


def date_order(frames: dict[str, DataFrame]) -> DataFrame:
    """Pairs of date columns of which most rows keep one order and some do not; equal dates keep both orders.

    All pairs of an entity are compared in one pass and summed per task. Values that are no dates are left out.
    """
    parts = []
    for entity, df in frames.items():
        names = date_columns(df)
        pairs = [(a, b) for i, a in enumerate(names) for b in names[i + 1 :]]
        if not pairs:
            continue
        at = {c: F.col(f"d{i}") for i, c in enumerate(names)}
        counts = [c for i, (a, b) in enumerate(pairs) for c in (count_if(at[a] > at[b]).alias(f"more{i}"), count_if(at[a] < at[b]).alias(f"less{i}"))]
        sums = df.select(*[_stamp(df, c).alias(f"d{i}") for i, c in enumerate(names)]).agg(*counts)
        found = []
        for i, (a, b) in enumerate(pairs):
            more, less = F.col(f"more{i}"), F.col(f"less{i}")
            kept = more <= less
            found.append(F.struct(
                F.lit(entity).alias("entity"), F.when(kept, a).otherwise(b).alias("column_name"), F.least(more, less).cast("bigint").alias("hits"),
                F.when(kept, f"{a} <= {b}").otherwise(f"{b} <= {a}").alias("suggested_rule")))
        parts.append(sums.select(F.inline(F.array(*found))).where("hits > 0"))
    spark = next(iter(frames.values())).sparkSession
    out = reduce(DataFrame.unionByName, parts) if parts else spark.createDataFrame([], "entity string, column_name string, hits bigint, suggested_rule string")
    return out.select("entity", "column_name", F.lit("date_order").alias("issue_type"), F.lit("CRITICAL").alias("severity"), "hits", "suggested_rule")


def discover_issues(frames: dict[str, DataFrame], rare_share: float = 0.02, most_rare: float = 0.25) -> DataFrame:
    """Findings beyond the configured rules, over all columns of all entities, from the distinct values of each column.

    Detectors: placeholder texts, currency signs among plain numbers, two date layouts in one
    column, stray blanks around values, rare values (below ``rare_share`` of the rows) of a column that is mostly
    frequent ones (rare values together have at most ``most_rare`` of the rows), numbers further than one and a half
    times the distance of the quartiles outside them, and pairs of dates in the order that fewer rows have.
    """
    keys = ["entity", "column_name"]
    # every detector reads the distinct values, so they are counted and written once
    spark = next(iter(frames.values())).sparkSession
    path = work_dir(spark, "values")
    column_values(frames).where(F.col("value").isNotNull()).write.parquet(path)
    values = spark.read.parquet(path)
    v, n = F.col("value"), F.col("n")
    total = lambda cond: F.sum(F.when(cond, n).otherwise(0))
    stats = values.groupBy(*keys).agg(
        F.sum(n).alias("rows"),
        total(F.trim(v).isin("?", "NULL", "n/a", "N/A", "")).alias("placeholder_n"),
        total(v.rlike(r"^\$-?[0-9]")).alias("money_n"),
        total(v.rlike(r"^-?[0-9]+(\.[0-9]+)?$")).alias("number_n"),
        total(v.rlike(r"^[0-9]{4}-[0-9]{2}-[0-9]{2}")).alias("iso_n"),
        total(v.rlike(r"^([0-9]{2}/[0-9]{2}/[0-9]{4}|[0-9]{2}-[0-9]{2}-[0-9]{4})")).alias("us_n"),
        total(v != F.trim(v)).alias("blank_n"),
        total(v.rlike(NUMBER)).alias("numeric_n"),
    )
    c = F.col
    finding = lambda issue, severity, hits, rule: F.struct(
        F.lit(issue).alias("issue_type"), F.lit(severity).alias("severity"), hits.cast("bigint").alias("hits"), rule.alias("suggested_rule"))
    both = lambda a, b: F.when((c(a) > 0) & (c(b) > 0), F.least(c(a), c(b)))
    name = F.col("column_name")
    checks = [
        F.when(c("placeholder_n") > 0, finding("unexpected_values", "WARNING", c("placeholder_n"), F.concat(name, F.lit(" NOT IN ('?', 'NULL', 'n/a', 'N/A', '')")))),
        F.when(both("money_n", "number_n").isNotNull(), finding("format_inconsistency", "WARNING", both("money_n", "number_n"), F.concat(name, F.lit(" NOT LIKE '$%'")))),
        F.when(both("iso_n", "us_n").isNotNull(), finding("format_inconsistency", "CRITICAL", both("iso_n", "us_n"), F.concat(F.lit("one date layout in "), name))),
        F.when(c("blank_n") > 0, finding("encoding_issue", "WARNING", c("blank_n"), F.concat(name, F.lit(" = TRIM("), name, F.lit(")")))),
    ]
    by_column = stats.withColumn("f", F.explode(F.array_compact(F.array(*checks)))).select("entity", "column_name", "f.*")
    rare = (
        values.join(stats.select(*keys, "rows"), keys)
        .groupBy("entity", "column_name").agg(F.sum(F.when(n < F.lit(rare_share) * c("rows"), n).otherwise(0)).cast("bigint").alias("hits"), F.sum(n).alias("all"))
        .where((c("hits") > 0) & (c("hits") <= F.lit(most_rare) * c("all")))
        .select("entity", "column_name", F.lit("suspicious_distribution").alias("issue_type"), F.lit("WARNING").alias("severity"), "hits",
                F.concat(name, F.lit(" within its frequent values")).alias("suggested_rule"))
    )
    return by_column.unionByName(rare).unionByName(_outliers(frames, values, stats, keys)).unionByName(date_order(frames)).withColumns({
        "description": F.format_string("%s.%s: %s in %d rows", c("entity"), name, c("issue_type"), c("hits")),
        "discovery_source": F.lit("profile"),
        "_discovery_status": F.lit("pending_review"),
    })


FINDINGS = "array<struct<column_name:string,issue_type:string,severity:string,suggested_rule:string,description:string>>"


def parse_findings(df: DataFrame, text: str) -> DataFrame:
    """Rows of a JSON list of findings found in a text column, with or without code fences."""
    body = F.regexp_replace(F.regexp_replace(F.trim(F.col(text)), r"^```[a-z]*\n", ""), r"\n```$", "")
    others = [c for c in df.columns if c != text]
    return (
        df.withColumn("_f", F.explode(F.from_json(body, FINDINGS)))
        .select(*others, "_f.column_name", "_f.issue_type", F.coalesce("_f.severity", F.lit("WARNING")).alias("severity"),
                "_f.suggested_rule", "_f.description")
    )


# --- audit report --------------------------------------------------------------------------------


def newer_than(df: DataFrame, stamp: str, report: DataFrame, report_stamp: str) -> DataFrame:
    """Rows later than the newest stamp of an earlier report; all rows if there is none.

    The mark is a scalar subquery, so it reaches the scan as a filter value.
    """
    mark = report.agg(F.max(report_stamp)).scalar()
    return df.where(mark.isNull() | (F.col(stamp) > mark))


SAMPLE_SALTS = 64


def issue_groups(frames: dict[str, DataFrame], sample_reasons: int = 3, sample_files: int = 5) -> DataFrame:
    """Rejections per entity, issue and rule with the first reasons and files as evidence.

    One scan: distinct reasons and files per rule with their counts, numbered per salt of the
    text and cut to the first few, then per rule. No set of texts is gathered before it is cut,
    and no task sees more than a share of a rule's texts.
    """
    keys = ["entity", "_issue_type", "_expectation_name"]
    rows = stack_entities(frames, [*keys[1:], "_failure_reason", "_source_file", "_quarantine_timestamp"])
    texts = F.array(*[F.struct(F.lit(is_file).alias("is_file"), F.col(c).alias("value")) for is_file, c in ((False, "_failure_reason"), (True, "_source_file"))])
    values = rows.select(*keys, "_quarantine_timestamp", F.explode(texts).alias("_t")).select("*", "_t.is_file", "_t.value")
    distinct = values.groupBy(*keys, "is_file", "value").agg(F.count(F.lit(1)).alias("n"), F.min("_quarantine_timestamp").alias("lo"), F.max("_quarantine_timestamp").alias("hi"))
    ranked = distinct.withColumn("_salt", F.pmod(F.hash("value"), F.lit(SAMPLE_SALTS))).withColumn("nth", F.row_number().over(Window.partitionBy(*keys, "is_file", "_salt").orderBy(F.col("value").asc_nulls_last())))
    few = F.when(F.col("nth") <= F.when(F.col("is_file"), sample_files).otherwise(sample_reasons), F.col("value"))
    salted = ranked.groupBy(*keys, "is_file", "_salt").agg(F.sum("n").alias("n"), F.min("lo").alias("lo"), F.max("hi").alias("hi"), F.collect_list(few).alias("few"))
    merged = lambda kind, k: F.slice(F.array_sort(F.flatten(F.collect_list(F.when(kind, F.col("few"))))), 1, k)
    return salted.groupBy(*keys).agg(
        F.sum(F.when(~F.col("is_file"), F.col("n"))).alias("rejected_count"), F.min("lo").alias("earliest_failure"), F.max("hi").alias("latest_failure"),
        merged(~F.col("is_file"), sample_reasons).alias("sample_reasons"), merged(F.col("is_file"), sample_files).alias("source_files"),
    ).withColumnsRenamed({"_issue_type": "issue_type", "_expectation_name": "field_affected"})


def severity_class(issue_type: Column, count: Column) -> Column:
    issue = F.lower(issue_type)
    return (
        F.when(issue.isin(*CRITICAL_ISSUES) | (count > CRITICAL_COUNT), "CRITICAL")
        .when(issue.isin(*HIGH_ISSUES) | (count > HIGH_COUNT), "HIGH")
        .otherwise("MEDIUM")
    )


def severity_rank(severity: Column) -> Column:
    return F.when(severity == "CRITICAL", 1).when(severity == "HIGH", 2).otherwise(3)


def with_business_impact(df: DataFrame, entity: str = "entity", issue: str = "issue_type") -> DataFrame:
    """Impact text by entity and issue, else a sentence by entity."""
    table = F.create_map(*[x for (e, i), text in IMPACT.items() for x in (F.lit(f"{e}|{i}"), F.lit(text))])
    reports = F.create_map(*[x for e, text in ENTITY_REPORTS.items() for x in (F.lit(e), F.lit(text))])
    key = F.concat_ws("|", F.lower(entity), F.lower(issue))
    fallback = F.concat(F.lit("These records are missing from "), F.coalesce(F.try_element_at(reports, F.lower(entity)), F.lit("the reports")), F.lit("."))
    return df.withColumn("business_impact", F.coalesce(F.try_element_at(table, key), fallback))


def pretty_source(path: Column) -> Column:
    """File name, followed by its region folder in brackets."""
    name = F.element_at(F.split(path, "/"), -1)
    folder = F.regexp_extract(path, r"(?:^|/)([^/]*[Rr]egion[^/]*)(?=/)", 1)
    return F.concat(name, F.when(folder != "", F.concat(F.lit(" ("), folder, F.lit(")"))).otherwise(F.lit("")))


def pretty_sources(paths: Column, k: int = 4) -> Column:
    return F.array_join(F.transform(F.slice(paths, 1, k), pretty_source), " | ")


def audit_report(groups: DataFrame) -> DataFrame:
    """Audit rows with severity, evidence, impact and a three-part explanation."""
    count = F.col("rejected_count")
    rated = with_business_impact(groups).withColumn("severity", severity_class(F.col("issue_type"), count))
    evidence = F.array_join("sample_reasons", " | ")
    sources = pretty_sources(F.col("source_files"))
    explanation = F.concat_ws(
        "\n",
        F.format_string("WHAT IS THE PROBLEM: %d %s records were set aside because they failed the check %s (%s).",
                        count, F.col("entity"), F.col("field_affected"), evidence),
        F.format_string("WHY THIS RECORD TYPE CANNOT BE ACCEPTED: records with the issue %s cannot be relied on in any total or report.", F.col("issue_type")),
        F.format_string("WHAT IS AT RISK: %s The owner of %s must correct the source files (%s).", F.col("business_impact"), F.col("entity"), sources),
    )
    return rated.withColumn("explanation", explanation).select(
        "entity", "field_affected", "issue_type", "rejected_count", "severity",
        F.concat(F.lit("silver."), F.col("entity"), F.lit("_quarantine")).alias("source_table"),
        sources.alias("source_files"), "earliest_failure", "latest_failure", evidence.alias("sample_evidence"), "explanation",
        *[c.alias(n) for n, c in text_check(F.col("explanation"), sections=REPORT_SECTIONS, jargon=JARGON_PHRASES).items()],
    )


def by_severity(df: DataFrame, *then: str) -> DataFrame:
    """Presentation order of the audit report."""
    return df.orderBy(severity_rank(F.col("severity")), F.col("rejected_count").desc(), *then)


# --- checks of generated text ----------------------------------------------------------------------


def text_check(text: Column, min_words: int = 30, sections: tuple[str, ...] = (), jargon: tuple[str, ...] = ()) -> dict[str, Column]:
    """``text`` without markdown, ``llm_check`` (PASS or REVIEW) and ``llm_check_detail``."""
    text = F.coalesce(text, F.lit(""))
    low = F.lower(text)
    any_of = lambda phrases: reduce(lambda a, b: a | b, [low.contains(p) for p in phrases])
    words = F.size(F.filter(F.split(text, r"\s+"), lambda w: w != ""))
    found = [
        F.when(words < min_words, "too_short"),
        F.when(text.startswith(FAILED_CALL_PREFIX), "llm_call_failed"),
        F.when(any_of(REFUSAL_PHRASES), "refusal_detected"),
    ]
    if jargon:
        found.append(F.when(any_of(jargon), "technical_jargon_detected"))
    if sections:
        found.append(F.when(~reduce(lambda a, b: a & b, [text.contains(s) for s in sections]), "missing_section"))
    issues = F.array_join(F.array_compact(F.array(*found)), ", ")
    stripped = F.trim(F.regexp_replace(F.regexp_replace(text, r"(?m)^ {0,3}#+\s+", ""), r"(\*\*?)(?=\S)(.+?)(?<=\S)\1", "$2"))
    return {
        "text": F.when(stripped == "", F.concat(F.lit("[REVIEW REQUIRED: empty text. Issues: "), issues, F.lit("]"))).otherwise(stripped),
        "llm_check": F.when(issues == "", "PASS").otherwise("REVIEW"),
        "llm_check_detail": F.when(issues == "", "none").otherwise(issues),
    }


def anomaly_alerts(counts: DataFrame, min_delta_pct: float = 20.0) -> DataFrame:
    """Rejections of a run against the run before it, per entity.

    ``counts`` has ``entity, run_at, rejected_count``, one row per entity and run.
    """
    w = Window.partitionBy("entity").orderBy("run_at")
    delta = ratio(F.col("current_count") - F.col("previous_count"), F.col("previous_count"), 1, 100)
    return (
        counts.select("entity", F.col("run_at").alias("detected_at"), F.col("rejected_count").alias("current_count"),
                      F.lag("rejected_count").over(w).alias("previous_count"))
        .withColumn("delta_pct", delta)
        .where(F.col("delta_pct") >= min_delta_pct)
        .withColumn("severity_tag", F.when(F.col("delta_pct") >= 100, "CRITICAL").when(F.col("delta_pct") >= 50, "HIGH").otherwise("MEDIUM"))
    )
