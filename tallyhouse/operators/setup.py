"""Configuration tables and database bootstrap."""

from __future__ import annotations

from collections import defaultdict
from dataclasses import asdict, astuple, fields

from pyspark.sql import DataFrame, SparkSession

from tallyhouse import config

LAYERS = ("raw", "bronze", "silver", "mdm", "gold", "config")

CONFIG_TABLES = {
    "column_mapping": (config.MAPPINGS, "entity string, source_column string, canonical_column string, transformation string"),
    "dq_rules": (
        config.RULES,
        "rule_id string, entity string, rule_name string, rule_expression string, severity string, "
        "consequence string, issue_type string, failure_reason string",
    ),
    "mdm_rules": (config.SURVIVORSHIP, "entity string, canonical_column string, strategy string, source_priority_order array<string>"),
    "fraud_rule_config": (config.FRAUD_CONFIG, "rule_name string, signal string, threshold double, weight double, is_active boolean, description string, human_reasoning string"),
}


def bootstrap(spark: SparkSession, layers: tuple[str, ...] = LAYERS, prefix: str = "") -> DataFrame:
    """Create one database per layer; running it again changes nothing."""
    for layer in layers:
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {prefix}{layer}")
    return spark.sql("SHOW DATABASES")


def config_table(spark: SparkSession, name: str) -> DataFrame:
    rows, schema = CONFIG_TABLES[name]
    typed = [tuple(float(v) if type(v) is int else list(v) if type(v) is tuple else v for v in astuple(r)) for r in rows]
    return spark.createDataFrame(typed, schema)


def seed(spark: SparkSession, database: str) -> None:
    """Write the built-in configuration as tables that can then be edited."""
    for name in CONFIG_TABLES:
        config_table(spark, name).write.mode("overwrite").saveAsTable(f"{database}.{name}")


def load(df: DataFrame, kind: type) -> dict[str, list]:
    """Configuration rows (a few dozen by nature) as typed objects, grouped by entity."""
    names = [f.name for f in fields(kind)]
    grouped = defaultdict(list)
    for row in df.select(*[n for n in names if n in df.columns]).collect():
        values = row.asDict()
        if isinstance(values.get("source_priority_order"), list):
            values["source_priority_order"] = tuple(values["source_priority_order"])
        item = kind(**values)
        grouped[asdict(item).get("entity", "")].append(item)
    return dict(grouped)
