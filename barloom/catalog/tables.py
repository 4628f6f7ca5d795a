"""Bar tables built from the driver tables, and the shape results are returned in."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from barloom.operators.layout import Layout
from barloom.session import prepare
from barloom.sources.bars import packed, resample

DAILY = Layout(step_seconds=86_400, chunk_rows=65_536)
HOURLY = Layout(step_seconds=3_600, chunk_rows=65_536)
SECONDS = Layout(step_seconds=1, chunk_rows=65_536)
#: Trades of one price and quantity are alike, so this order decides every open and close.
TRADE_ORDER = ("l_orderkey", "l_linenumber", "l_quantity", "cents")


def trade_rank() -> Column:
    return packed(("l_orderkey", 15), ("l_linenumber", 4), ("l_quantity", 6), ("cents", 13))


def tick_rank() -> Column:
    """Stamps to the microsecond, then the id."""
    return packed(("micros", 18), ("event_id", 19))




def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return prepare(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def trades(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items as ticks of three series."""
    return table(spark, sf_dir, "lineitem").select(
        F.col("l_returnflag").alias("series"),
        F.col("l_shipdate").cast("timestamp").alias("ts"),
        (F.col("l_extendedprice") / F.col("l_quantity")).alias("price"),
        F.col("l_quantity").alias("volume"),
        "l_orderkey", "l_linenumber", "l_quantity", "l_suppkey",
        F.round(F.col("l_extendedprice") * 100).cast("bigint").alias("cents"),
    )


def ticks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as ticks of five series."""
    return table(spark, sf_dir, "events").select(
        F.col("event_type").alias("series"),
        F.col("ts").cast("timestamp").alias("ts"),
        F.col("value").alias("price"),
        F.get_json_object("props", "$.k").cast("double").alias("volume"),
        "event_id",
        F.unix_micros(F.col("ts").cast("timestamp")).alias("micros"),
    )


def bars_1d(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resample(trades(spark, sf_dir), DAILY.step_seconds, trade_rank())


def bars_1h(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resample(ticks(spark, sf_dir), HOURLY.step_seconds, tick_rank())


def bars_1s(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One-second bars: as many as there are events, give or take."""
    return resample(ticks(spark, sf_dir), SECONDS.step_seconds, tick_rank())


def supplier_bars(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Daily bars of many series, one per supplier."""
    sold = trades(spark, sf_dir).withColumn("series", F.col("l_suppkey").cast("string"))
    return resample(sold, DAILY.step_seconds, trade_rank())


def finish(df: DataFrame, digits: int = 6) -> DataFrame:
    """Doubles rounded, whole numbers as BIGINT, naive timestamps."""

    def shaped(field: T.StructField):
        c = F.col(f"`{field.name}`")
        if isinstance(field.dataType, T.DoubleType):
            c = F.round(c, digits)
        elif isinstance(field.dataType, (T.IntegerType, T.ShortType, T.ByteType)):
            c = c.cast("bigint")
        elif isinstance(field.dataType, T.TimestampType):
            c = c.cast("timestamp_ntz")
        return c.alias(field.name)

    return df.select(*[shaped(f) for f in df.schema.fields])
