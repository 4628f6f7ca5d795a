"""Bar, metric and forecast tables on storage."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from barloom.operators.metrics import present
from barloom.plans import live
from barloom.session import prepare

OHLCV_SCHEMA = T.StructType(
    [T.StructField("timestamp", T.TimestampType())]
    + [T.StructField(c, T.DoubleType()) for c in ("open", "high", "low", "close", "volume")]
)


def read_bars_csv(spark: SparkSession, path: str, series: str | None = None) -> DataFrame:
    """Bars from CSV files with a header; ``timestamp`` is the first column.

    Unreadable stamps become NULL and are kept for ``split_rejects`` to separate.
    Without ``series`` the file must be partitioned by it on disk (``series=.../``).
    """
    schema = OHLCV_SCHEMA if series is not None else T.StructType([*OHLCV_SCHEMA, T.StructField("series", T.StringType())])
    raw = prepare(spark).read.schema(schema).option("header", True).csv(path)
    key = F.lit(series) if series is not None else F.col("series")
    return raw.select(key.alias("series"), F.col("timestamp").alias("ts"), *OHLCV_SCHEMA.fieldNames()[1:])


def split_rejects(bars: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Usable bars, and those without a stamp or a close."""
    usable = F.coalesce(F.col("ts").isNotNull() & present(F.col("close")), F.lit(False))
    return bars.where(usable), bars.where(~usable)


def write_bars(bars: DataFrame, path: str, fmt: str = "parquet") -> None:
    """Bars partitioned by day, so time filters skip folders; CSV keeps a header."""
    dated = bars.withColumn("day", F.to_date("ts"))
    writer = dated.repartition("day", "series").sortWithinPartitions("series", "ts").write.partitionBy("day")
    (writer.option("header", True) if fmt == "csv" else writer).format(fmt).mode("overwrite").save(path)


def write_bars_csv(bars: DataFrame, path: str) -> None:
    """CSV in the layout ``read_bars_csv`` expects: one folder per series, stamp first."""
    ordered = bars.select("series", F.col("ts").alias("timestamp"), "open", "high", "low", "close", "volume")
    ordered.write.partitionBy("series").option("header", True).mode("overwrite").csv(path)


def write_metrics(metrics: DataFrame, path: str) -> None:
    """One folder per model."""
    metrics.write.partitionBy("model").mode("overwrite").parquet(path)


def read_metrics(
    spark: SparkSession, path: str, schema: T.StructType, models: Sequence[str] | None = None
) -> DataFrame:
    """Metrics of all models found, or of those asked for that exist; absent ones are skipped.

    The schema is given, so a table without any rows can be read as well.
    """
    table = spark.read.schema(schema).parquet(path)
    return table if models is None else table.where(F.col("model").isin(*models))


def write_quantiles(quantiles: DataFrame, path: str) -> None:
    """One table for all levels, a folder per level."""
    quantiles.write.partitionBy("q").mode("overwrite").parquet(path)


def write_documents(documents: DataFrame, path: str, form: str = "json") -> None:
    """Forecast documents as JSON lines, or as CSV with a row for each field; a folder for each series either way."""
    if form == "json":
        live.as_json(documents).select("series", "document").write.partitionBy("series").mode("overwrite").text(path)
    elif form == "flat":
        live.flattened(documents).write.partitionBy("series").option("header", True).mode("overwrite").csv(path)
    else:
        raise ValueError(f"documents are written as json or flat, not as {form}")


def read_documents(spark: SparkSession, path: str, form: str = "json") -> DataFrame:
    """Point forecasts and probabilities of stored documents: ``(series, ts, current_price, field, value)``."""
    if form == "flat":
        schema = "ts timestamp, current_price double, field string, value double, series string"
        return prepare(spark).read.schema(schema).option("header", True).csv(path)
    inner = "map<string,double>"
    body = f"timestamp timestamp, current_price double, {live.POINT} {inner}, {live.PROBABILITY} map<string,{inner}>"
    text = prepare(spark).read.schema("document string, series string").text(path)
    told = text.select("series", F.from_json("document", body).alias("d")).select("series", F.col("d.timestamp").alias("ts"), "d.current_price", f"d.{live.POINT}", f"d.{live.PROBABILITY}")
    return live.flattened(told)
