"""Sessions: stretches of ticks of a series without a longer gap."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from barloom.operators.layout import Layout, running_totals, with_previous

SESSION = ("ticks", "volume", "low", "high")


def session_columns(ticks: Column, price: Column, volume: Column) -> dict[str, Column]:
    return {"ticks": F.sum(ticks), "volume": F.sum(volume), "low": F.min(price), "high": F.max(price)}


def sessions(ticks: DataFrame, gap_seconds: int, layout: Layout) -> DataFrame:
    """``(series, start_ts, end_ts, ticks, volume, low, high)``; a session ends ``gap_seconds`` after its last tick.

    The same as on a stream (see ``streaming.intake.sessions``), but a series is never sorted in one task: ticks of one stamp are
    added up map-side, then numbered by the gaps before them with counts per time slot. ``layout`` is that of the stamps.
    """
    stamps = ticks.groupBy("series", "ts").agg(
        *[c.alias(k) for k, c in session_columns(F.lit(1), F.col("price"), F.col("volume")).items()]
    )
    moved = with_previous(stamps, layout, "ts", "_previous")
    gap = F.make_dt_interval(secs=F.lit(gap_seconds))
    opens = (F.col("_previous").isNull() | (F.col("ts") > F.col("_previous") + gap)).cast("bigint")
    numbered = running_totals(moved, layout, {"_session": opens})
    return (
        numbered.groupBy("series", "_session")
        .agg(
            F.min("ts").alias("start_ts"),
            (F.max("ts") + gap).alias("end_ts"),
            F.sum("ticks").alias("ticks"),
            F.sum("volume").alias("volume"),
            F.min("low").alias("low"),
            F.max("high").alias("high"),
        )
        .drop("_session")
    )
