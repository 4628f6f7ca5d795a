"""Completeness, gaps and basic statistics of bar tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, WindowSpec
from pyspark.sql import functions as F

from barloom.operators.layout import Layout, attach, over_chunks

VALUES = ("open", "high", "low", "close", "volume")


def quality_report(bars: DataFrame) -> DataFrame:
    """Missing cells, repeated stamps and zero-volume rows per series.

    Repeats are counted from per-stamp counts, which also tames a stamp that repeats a lot.
    """
    missing = sum((F.count_if(F.col(c).isNull() | F.isnan(c)) for c in VALUES[1:]),
                  F.count_if(F.col(VALUES[0]).isNull() | F.isnan(VALUES[0])))
    per_stamp = bars.groupBy("series", "ts").agg(
        F.count(F.lit(1)).alias("n"),
        missing.alias("missing"),
        F.count_if(F.col("volume") == 0).alias("zero_volume"),
    )
    return per_stamp.groupBy("series").agg(
        F.sum("n").alias("rows"),
        F.sum("missing").alias("missing_values"),
        F.sum(F.col("n") - 1).alias("duplicate_stamps"),
        F.sum("zero_volume").alias("zero_volume_rows"),
    )


def price_stats(bars: DataFrame) -> DataFrame:
    """Range, mean, sample deviation of the close and the span of days covered."""
    start, end = F.min("ts"), F.max("ts")
    return bars.groupBy("series").agg(
        F.count(F.lit(1)).alias("rows"),
        start.alias("first_ts"),
        end.alias("last_ts"),
        F.expr("(unix_seconds(max(ts)) - unix_seconds(min(ts))) div 86400").alias("duration_days"),
        F.min("close").alias("min_price"),
        F.max("close").alias("max_price"),
        F.avg("close").alias("mean_price"),
        F.stddev_samp("close").alias("std_price"),
    )


def completeness(bars: DataFrame, expected: int) -> DataFrame:
    """Rows present against the number a gap-free history would hold, in percent."""
    actual = F.count(F.lit(1))
    return bars.groupBy("series").agg(
        actual.alias("actual_rows"),
        F.lit(expected).cast("bigint").alias("expected_rows"),
        (actual / F.lit(float(expected)) * 100).alias("completeness_pct"),
    )


def gap_report(bars: DataFrame, layout: Layout) -> DataFrame:
    """Stretches where bars are missing: the bars around each and how many fit in between."""

    def build(df: DataFrame, w: WindowSpec) -> DataFrame:
        return df.withColumn("gap_end", F.lead("ts").over(w))

    following = over_chunks(bars, layout, 0, 1, build, columns=["series", "ts"])
    missing = F.expr(f"(unix_seconds(gap_end) - unix_seconds(ts)) div {layout.step_seconds} - 1")
    return following.select("series", F.col("ts").alias("gap_start"), "gap_end", missing.alias("missing_bars")).where(
        "missing_bars > 0"
    )


def histogram(table: DataFrame, column: str, bins: int = 50) -> DataFrame:
    """Equal-width bins between each series' extremes; the last bin is closed on both sides."""
    x = F.col(column)
    present = table.where(x.isNotNull() & ~F.isnan(x))
    limits = present.groupBy("series").agg(F.min(x).alias("_lo"), F.max(x).alias("_hi"))
    width = (F.col("_hi") - F.col("_lo")) / bins
    index = F.when(width == 0, F.lit(0)).otherwise(
        F.least(F.floor((x - F.col("_lo")) / F.nullif(width, F.lit(0.0))), F.lit(bins - 1))
    )
    binned = attach(present.select("series", "ts", column), limits).select(
        "series", "_lo", width.alias("_width"), index.cast("int").alias("bin")
    )
    counted = binned.groupBy("series", "_lo", "_width", "bin").agg(F.count(F.lit(1)).alias("count"))
    low = F.col("_lo") + F.col("bin") * F.col("_width")
    return counted.select(
        "series", "bin", low.alias("bin_lower"), (low + F.col("_width")).alias("bin_upper"), "count"
    )
