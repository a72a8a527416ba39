"""Ratios, guards and display labels."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def ratio(numerator: Column, denominator: Column) -> Column:
    """Double ratio, NULL where the denominator is zero or missing."""
    return F.try_divide(numerator.cast("double"), denominator.cast("double"))


def percent_change(current: Column, base: Column) -> Column:
    """Change against ``base`` in percent, NULL where there is no usable base."""
    return ratio(current - base, base) * 100


def clip_low(value: Column, bound: float = 0.0) -> Column:
    """Lower bound that keeps NULL (``greatest`` would turn it into the bound)."""
    return F.when(value < bound, F.lit(bound)).otherwise(value)


def money_label(amount: Column) -> Column:
    x = amount.cast("double")
    return (
        F.when(x.isNull(), "-")
        .when(F.abs(x) >= 1e6, F.format_string("$%.2fM", x / 1e6))
        .when(F.abs(x) >= 1e3, F.format_string("$%.1fK", x / 1e3))
        .otherwise(F.concat(F.lit("$"), F.format_number(x, 0)))
    )


def percent_label(percent: Column) -> Column:
    return F.when(percent.isNull(), "-").otherwise(F.format_string("%+.1f%%", percent))
