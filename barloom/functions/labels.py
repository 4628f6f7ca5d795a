"""Names: thresholds, quantiles, intervals, models."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def whole(price: Column) -> Column:
    """Price truncated toward zero, as text."""
    return price.cast("bigint").cast("string")


def above_name(price: Column) -> Column:
    return F.concat(F.lit("above_"), whole(price))


def below_name(price: Column) -> Column:
    return F.concat(F.lit("below_"), whole(price))


def between_name(low: Column, high: Column) -> Column:
    return F.concat(F.lit("between_"), whole(low), F.lit("_"), whole(high))


def percent_label(fraction: Column) -> Column:
    """``0.05 -> '5'``; rounded first so 0.29 does not become 28."""
    return F.round(fraction * 100).cast("bigint").cast("string")


def display_name(model: Column) -> Column:
    return F.initcap(F.replace(model, F.lit("_"), F.lit(" ")))


def query_operator(name: Column) -> Column:
    return (
        F.when(name.contains("between"), F.lit("between"))
        .when(name.contains("above"), F.lit("above"))
        .when(name.contains("below"), F.lit("below"))
    )


def query_bounds(name: Column) -> tuple[Column, Column]:
    """Thresholds spelled in a query name, with sign and decimals: two numbers for ``between``, else the first.

    A name that does not spell its numbers has no thresholds: both are NULL.
    """
    numbers = F.transform(F.regexp_extract_all(name, F.lit(r"-?\d+(?:\.\d+)?"), F.lit(0)), lambda d: d.cast("double"))
    is_range = name.contains("between")
    readable = F.when(is_range, F.size(numbers) >= 2).otherwise(F.size(numbers) >= 1)
    return F.when(readable, F.get(numbers, F.lit(0))), F.when(readable & is_range, F.get(numbers, F.lit(1)))


def round_to_hundred(price: Column) -> Column:
    """Nearest hundred, ties to even."""
    return F.bround(price / 100) * 100
