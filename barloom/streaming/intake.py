"""Streams of ticks and bars: reading, repeat suppression, tick-to-bar and sliding windows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from barloom.operators.sessions import SESSION, session_columns
from barloom.session import prepare, scratch_path

DELAY = "10 minutes"


def read_files(
    spark: SparkSession, folder: str, schema: StructType, *, fmt: str = "parquet", name: str = "*", max_files: int = 1000
) -> DataFrame:
    """Files landing in ``folder`` as a stream; the schema is given, never inferred."""
    reader = prepare(spark).readStream.schema(schema).format(fmt)
    return reader.option("pathGlobFilter", name).option("maxFilesPerTrigger", max_files).load(folder)


def without_repeats(stream: DataFrame, delay: str = DELAY) -> DataFrame:
    """First arrival of each (series, ts); state is dropped once the watermark passes."""
    return stream.withWatermark("ts", delay).dropDuplicatesWithinWatermark(["series", "ts"])


def bars(ticks: DataFrame, step: str, order: Sequence[str], delay: str = DELAY) -> DataFrame:
    """OHLCV bars, each emitted once when the watermark closes it; later ticks are dropped."""
    rank = F.struct(*order)
    return (
        ticks.withWatermark("ts", delay)
        .groupBy(F.window("ts", step), "series")
        .agg(
            F.min_by("price", rank).alias("open"),
            F.max("price").alias("high"),
            F.min("price").alias("low"),
            F.max_by("price", rank).alias("close"),
            F.sum("volume").alias("volume"),
        )
        .select("series", F.col("window.start").alias("ts"), "open", "high", "low", "close", "volume")
    )


def sliding_stats(stream: DataFrame, length: str, slide: str, delay: str = DELAY, column: str = "price") -> DataFrame:
    """Mean, deviation, range and count over sliding time windows."""
    x = F.col(column)
    return (
        stream.withWatermark("ts", delay)
        .groupBy(F.window("ts", length, slide), "series")
        .agg(
            F.avg(x).alias("mean"),
            F.stddev_samp(x).alias("std"),
            F.min(x).alias("low"),
            F.max(x).alias("high"),
            F.count(x).alias("count"),
        )
        .select("series", F.col("window.start").alias("start_ts"), F.col("window.end").alias("end_ts"),
                "mean", "std", "low", "high", "count")
    )


def sessions(stream: DataFrame, gap: str, delay: str = DELAY) -> DataFrame:
    """Stretches of ticks of a series, each less than ``gap`` after the one before; emitted once the watermark closes them.

    State is one row for each open session: sessions that a late tick joins are merged.
    """
    return (
        stream.withWatermark("ts", delay)
        .groupBy(F.session_window("ts", gap), "series")
        .agg(*[c.alias(k) for k, c in session_columns(F.lit(1), F.col("price"), F.col("volume")).items()])
        .select("series", F.col("session_window.start").alias("start_ts"), F.col("session_window.end").alias("end_ts"), *SESSION)
    )


def drain(stream: DataFrame, name: str, *, mode: str = "append", path: str | None = None) -> DataFrame:
    """Run a stream over everything available into files of the shared folder, and read them.

    With the ``path`` of an earlier run it goes on from there.
    """
    spark = stream.sparkSession
    path = path or scratch_path(spark, name)
    query = (
        stream.writeStream.format("parquet")
        .outputMode(mode)
        .option("path", f"{path}/data")
        .option("checkpointLocation", f"{path}/checkpoint")
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return spark.read.schema(stream.schema).parquet(f"{path}/data")
