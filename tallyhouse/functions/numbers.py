"""Guarded arithmetic shared by marts, metrics and checks."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def ratio(num: Column, den: Column, digits: int, scale: int = 1) -> Column:
    """``round(scale * num / den, digits)``; NULL where the divisor is 0 or NULL.

    The quotient is a decimal with twelve digits: a double would put many exact halves (half a
    cent per line, say) on the wrong side. Room for sums up to 10**22.
    """
    quotient = F.try_divide((num * F.lit(scale)).cast("decimal(30,8)"), den.cast("decimal(20,4)"))
    return F.round(quotient, digits).cast("double")


def mean(total: Column, n: Column, digits: int = 2) -> Column:
    """Rounded average built from a sum and a count, so that both can be combined map-side."""
    return ratio(total, n, digits)


def count_if(cond: Column) -> Column:
    """Rows for which ``cond`` is true, 0 for none."""
    return F.count(F.when(cond, F.lit(1)))


def unit_price(sales: Column, quantity: Column) -> Column:
    """Money per unit with eight digits; NULL for no units."""
    qty = F.when(quantity != 0, quantity).cast("decimal(10,0)")
    return (sales / qty).cast("decimal(18,8)")
