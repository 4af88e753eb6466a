"""Column harmonisation: many source layouts into one canonical layout."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, functions as F

from tallyhouse.config import LINEAGE_COLUMNS, SCHEMAS, Mapping, mappings_for
from tallyhouse.functions.clean import CLEANERS


def clean_name(name: str) -> str:
    """Trimmed, lower-case name of word characters and single inner underscores."""
    return re.sub(r"_+", "_", re.sub(r"\W", "_", name.strip())).strip("_").lower()


def sanitize_columns(df: DataFrame) -> DataFrame:
    """Rename all columns with :func:`clean_name`; columns that meet are coalesced in order."""
    groups: dict[str, list[str]] = {}
    for original in df.columns:
        groups.setdefault(clean_name(original), []).append(original)
    positions = {c: i for i, c in enumerate(df.columns)}
    bare = df.toDF(*[f"c{i}" for i in range(len(df.columns))])
    return bare.select(
        *[F.coalesce(*[F.col(f"c{positions[o]}") for o in originals]).alias(name) for name, originals in groups.items()]
    )


def _apply(source: str, transformation: str | None) -> Column:
    if transformation is None:
        return F.col(source)
    if "{col}" in transformation:
        return F.expr(transformation.replace("{col}", f"`{source}`"))
    return CLEANERS[transformation](F.col(source))


def harmonize(df: DataFrame, mappings: list[Mapping], label: str = "static_config", entity: str | None = None) -> DataFrame:
    """One projection from any source layout to the canonical columns of an entity.

    All sources of a canonical column are cleaned and coalesced in mapping order. A column no
    source has becomes a NULL of its declared type. Works on streams and batches alike.
    """
    types = SCHEMAS.get(entity or (mappings[0].entity if mappings else ""), {})
    present = {c.lower() for c in df.columns}
    groups: dict[str, list[Column]] = {}
    for m in mappings:
        parts = groups.setdefault(m.canonical_column, [])
        if m.source_column.lower() in present:
            parts.append(_apply(m.source_column, m.transformation))
    out = []
    for canonical, parts in groups.items():
        kind = types.get(canonical, ("string", ""))[0]
        value = F.coalesce(*parts) if parts else F.lit(None)
        out.append(value.cast(kind).alias(canonical))
    for lineage in LINEAGE_COLUMNS:
        source = next((c for c in (lineage, lineage[1:]) if c in df.columns), None)
        if source:
            out.append(F.col(source).alias(lineage))
    out.append(F.lit(label).alias("_mapping_source"))
    return df.select(*out)


def harmonize_entity(df: DataFrame, entity: str, mappings: list[Mapping] | None = None, label: str = "static_config") -> DataFrame:
    return harmonize(df, mappings or mappings_for(entity), label, entity)


# --- state and city entered the wrong way round ---------------------------------------------


def looks_like_state(c: Column) -> Column:
    """Two capital letters, or one capitalised word."""
    return c.rlike("^[A-Z]{2}$") | ((F.length(c) > 2) & ~c.like("% %") & c.rlike("^[A-Z][a-z]+$"))


def repair_location_swap(df: DataFrame, state: str = "state", city: str = "city") -> DataFrame:
    """Swap both columns where only the swapped reading gives a state code."""
    swapped = F.coalesce(~looks_like_state(F.col(state)) & F.col(city).rlike("^[A-Z]{2}$"), F.lit(False))
    return df.withColumns(
        {
            state: F.when(swapped, F.col(city)).otherwise(F.col(state)),
            city: F.when(swapped, F.col(state)).otherwise(F.col(city)),
            "_location_swapped": swapped,
        }
    )


# --- mapping suggestion -----------------------------------------------------------------------

VALUE_CLASSES = {
    "email": r"^[^@\s]+@[^@\s]+$",
    "money": r"^\$?-?[0-9]+(\.[0-9]+)?$",
    "timestamp": r"^([0-9]{4}-[0-9]{2}-[0-9]{2}|[0-9]{2}/[0-9]{2}/[0-9]{4})[ T]",
}


def value_profile(df: DataFrame) -> DataFrame:
    """Share of values per pattern class, for all columns in one aggregation.

    Rows: ``source_column, n, email, money, timestamp``.
    """
    columns = [c for c in df.columns if c not in LINEAGE_COLUMNS and f"_{c}" not in LINEAGE_COLUMNS]
    aggs = []
    for i, c in enumerate(columns):
        text = F.col(f"`{c}`").cast("string")
        aggs.append(F.count(text).alias(f"n_{i}"))
        aggs += [F.count(F.when(text.rlike(p), 1)).alias(f"{k}_{i}") for k, p in VALUE_CLASSES.items()]
    rows = [
        F.struct(
            F.lit(c).alias("source_column"),
            F.col(f"n_{i}").alias("n"),
            *[F.try_divide(F.col(f"{k}_{i}"), F.col(f"n_{i}")).alias(k) for k in VALUE_CLASSES],
        )
        for i, c in enumerate(columns)
    ]
    return df.agg(*aggs).select(F.inline(F.array(*rows)))


def suggest_mappings(df: DataFrame, entity: str) -> DataFrame:
    """Propose a canonical column for every source column.

    Static configuration wins (``static_config``). Any other column is scored against the
    canonical names by edit distance (``name_match``, at least half of the letters agree) and
    gets a cleaner from the pattern class that most of its values follow. The pairing runs
    over column names only, a few dozen rows whatever the size of the data.
    """
    spark = df.sparkSession
    known = spark.createDataFrame(
        [(m.source_column, m.canonical_column, m.transformation) for m in mappings_for(entity)],
        "source_column string, known_column string, known_transformation string",
    )
    targets = F.array(*[F.lit(c) for c in SCHEMAS[entity]])
    compact = lambda c: F.regexp_replace(F.lower(c), "[^a-z0-9]", "")
    scored = F.transform(
        targets,
        lambda t: F.struct(
            (F.lit(1.0) - F.levenshtein(compact(F.col("source_column")), compact(t))
             / F.greatest(F.length(compact(F.col("source_column"))), F.length(compact(t)))).alias("score"),
            t.alias("canonical"),
        ),
    )
    profiled = value_profile(df).withColumn("best", F.array_max(scored))
    guess = F.when(F.col("best.score") >= 0.5, F.col("best.canonical"))
    cleaner = (
        F.when(F.col("timestamp") >= 0.5, F.lit("timestamp"))
        .when((F.col("money") >= 0.5) & guess.isin("sales", "profit", "refund_amount"), F.lit("currency"))
    )
    known_hit = F.col("known_column").isNotNull()
    return (
        profiled.join(known, "source_column", "left")
        .select(
            F.lit(entity).alias("entity"),
            "source_column",
            F.when(known_hit, F.col("known_column")).otherwise(guess).alias("canonical_column"),
            F.when(known_hit, F.col("known_transformation")).otherwise(cleaner).alias("transformation"),
            F.when(known_hit, F.lit("static_config")).when(guess.isNotNull(), F.lit("name_match"))
            .otherwise(F.lit("unmapped")).alias("mapping_source"),
            F.when(known_hit, F.lit(1.0)).otherwise(F.round("best.score", 4)).alias("score"),
        )
    )
