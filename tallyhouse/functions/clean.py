"""Scalar cleaning of raw text columns, as column expressions.

ANSI mode is on in Spark 4, so every parse uses a ``try_`` form: text that cannot be read
becomes NULL and is then caught by the quality rules instead of failing the job.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, functions as F

from tallyhouse.config import (
    DATE_FORMATS,
    PLACEHOLDER,
    REGION_CODES,
    RETURN_STATUS_CODES,
    SEGMENT_CODES,
    TIMESTAMP_FORMATS,
)


def _lookup(value: Column, table: dict[str, str], otherwise: Column) -> Column:
    out = None
    for key, label in table.items():
        hit = value == F.lit(key)
        out = F.when(hit, F.lit(label)) if out is None else out.when(hit, F.lit(label))
    return out.otherwise(otherwise)


def currency(c: Column, kind: str = "decimal(10,3)") -> Column:
    """Drop a leading currency sign, then read as a decimal."""
    return F.when(c.startswith("$"), F.substring(c, 2, 2**31 - 1)).otherwise(c).try_cast(kind)


def refund(c: Column, kind: str = "decimal(10,2)") -> Column:
    """As :func:`currency`, dropping everything that is not a digit or a point."""
    return F.regexp_replace(placeholder(c), r"[^0-9.]", "").try_cast(kind)


def discount_fraction(c: Column, kind: str = "decimal(10,3)") -> Column:
    """Bring whole percentages and fractions to one scale."""
    number = F.regexp_replace(c, r"[^0-9.]", "").try_cast(kind)
    return F.when(number >= 1, number / F.lit(100)).otherwise(number).cast("decimal(12,5)")


def segment(c: Column) -> Column:
    return _lookup(c, SEGMENT_CODES, c)


def return_status(c: Column) -> Column:
    return _lookup(c, RETURN_STATUS_CODES, c)


def region(c: Column) -> Column:
    """Region code to name; anything else stays as it is."""
    return _lookup(F.upper(F.trim(c)), REGION_CODES, c)


def placeholder(c: Column) -> Column:
    return F.nullif(c, F.lit(PLACEHOLDER))


def timestamp(c: Column) -> Column:
    """First timestamp format that fits."""
    return F.coalesce(*[F.try_to_timestamp(c, F.lit(f)) for f in TIMESTAMP_FORMATS])


def date(c: Column) -> Column:
    """First date format that fits; the text ``NULL`` counts as missing."""
    text = F.nullif(c, F.lit("NULL"))
    return F.coalesce(*[F.try_to_timestamp(text, F.lit(f)) for f in DATE_FORMATS]).cast("date")


def iso_timestamp(c: Column) -> Column:
    return c.try_cast("timestamp")


def integer(c: Column) -> Column:
    return c.try_cast("int")


def date_part_of(c: Column) -> Column:
    """Date of an ISO timestamp text, ignoring the time part."""
    return F.regexp_replace(c.cast("string"), "[T ].*", "").try_cast("date")


CLEANERS: dict[str, Callable[[Column], Column]] = {
    "currency": currency,
    "refund": refund,
    "discount": discount_fraction,
    "segment": segment,
    "return_status": return_status,
    "region": region,
    "placeholder": placeholder,
    "timestamp": timestamp,
    "date": date,
    "iso_timestamp": iso_timestamp,
    "integer": integer,
}
