"""From ticks or raw bars to clean bar tables."""

from __future__ import annotations

from collections.abc import Sequence
from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from barloom.functions.timeparts import time_bucket
from barloom.operators.layout import attach


def packed(*parts: tuple[str, int]) -> Column:
    """Whole-number columns as the digits of one decimal, so that a hash aggregate can hold it.

    ``parts`` names columns with the digits each may take; a value beyond them fails the query (NULL sorts first). 38 digits fit.
    """
    if sum(n for _, n in parts) > 38:
        raise ValueError("an order key has at most 38 digits")
    out = F.lit(0).cast("decimal(38,0)")
    for name, digits in parts:
        value = F.coalesce(F.col(name).cast("bigint"), F.lit(-1)) + 1
        fits = (value >= 0) & (value < F.lit(Decimal(10**digits)).cast("decimal(38,0)"))
        checked = F.when(fits, value).otherwise(F.raise_error(F.concat(F.lit(f"{name} has more than {digits} digits: "), value)).cast("bigint"))
        out = (out * F.lit(Decimal(10**digits)).cast("decimal(38,0)") + checked).cast("decimal(38,0)")
    return out


def resample(ticks: DataFrame, step_seconds: int, order: Sequence[str] | Column) -> DataFrame:
    """OHLCV bars from ``(series, ts, price, volume)`` ticks.

    ``order`` puts the ticks of a bar in a total order: one column (see ``packed``), with which Spark aggregates by hashing, or
    the names of several, for which it sorts. All aggregates combine map-side, so a crowded bar costs one row per task.
    """
    rank = order if isinstance(order, Column) else F.struct(*order)
    return (
        ticks.groupBy("series", time_bucket(F.col("ts"), step_seconds).alias("ts"))
        .agg(
            F.min_by("price", rank).alias("open"),
            F.max("price").alias("high"),
            F.min("price").alias("low"),
            F.max_by("price", rank).alias("close"),
            F.sum("volume").alias("volume"),
        )
    )


def keep_first(bars: DataFrame, sequence: str | Column) -> DataFrame:
    """One row per (series, ts): the one ingested first.

    An aggregate rather than a ranking window: copies of one key shrink map-side. ``sequence`` is an order key (see ``packed``) that
    sets all different copies of a bar apart; numbers are then kept side by side by hashing. With a column's name, equal
    sequences are told apart by the other columns, for which Spark aggregates whole rows by sorting.
    """
    rest = [c for c in bars.columns if c not in ("series", "ts")]
    if isinstance(sequence, Column):
        ordered = bars.withColumn("_order", sequence)
        return ordered.groupBy("series", "ts").agg(*[F.min_by(c, "_order").alias(c) for c in rest]).select(*bars.columns)
    first = F.min_by(F.struct(*rest), F.struct(sequence, *[c for c in rest if c != sequence])).alias("_row")
    return bars.groupBy("series", "ts").agg(first).select("series", "ts", "_row.*").select(*bars.columns)


def combine(parts: Sequence[DataFrame]) -> DataFrame:
    """All rows of all parts; columns a part lacks are NULL."""
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part, allowMissingColumns=True)
    return out


def recent(bars: DataFrame, minutes: int) -> DataFrame:
    """The last ``minutes`` of each series, counted back from its newest bar."""
    newest = bars.groupBy("series").agg(F.max("ts").alias("_newest"))
    since = F.col("_newest") - F.make_dt_interval(mins=F.lit(minutes))
    return attach(bars, newest).where(F.col("ts") >= since).drop("_newest")


def history_flags(bars: DataFrame, needed: int = 240) -> DataFrame:
    """Rows per series and whether they are too few for the longest window."""
    rows = F.count(F.lit(1))
    return bars.groupBy("series").agg(rows.alias("rows"), (rows < needed).alias("too_short"))


def as_of(bars: DataFrame, moment: str) -> DataFrame:
    """Bars known at ``moment``: a historical replay is the same job on this input."""
    return bars.where(F.col("ts") <= F.lit(moment).cast("timestamp"))


def thinned(bars: DataFrame, step_seconds: int) -> DataFrame:
    """One point per step for plotting: last close and summed volume."""
    return bars.groupBy("series", time_bucket(F.col("ts"), step_seconds).alias("bucket")).agg(
        F.max_by("close", "ts").alias("close"), F.sum("volume").alias("volume")
    ).withColumnRenamed("bucket", "ts")
