"""Loading, cleaning and inspecting bars."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from barloom.catalog import Query
from barloom.catalog.tables import DAILY, HOURLY, bars_1d, bars_1h, finish, table, ticks, trades
from barloom.functions import timeparts
from barloom.operators import quality, splits
from barloom.operators.layout import with_previous
from barloom.plans import features
from barloom.session import publish, scratch_path
from barloom.sources import bars as bar_ops
from barloom.sources import files, payloads, requests


def daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    return finish(bars_1d(spark, sf_dir), 8)


def hourly(spark: SparkSession, sf_dir: str) -> DataFrame:
    return finish(bars_1h(spark, sf_dir))


def payload_decode(spark: SparkSession, sf_dir: str) -> DataFrame:
    landed = payloads.encode_candles(bars_1h(spark, sf_dir).withColumn("day", F.to_date("ts")), ["series", "day"])
    return finish(payloads.decode_candles(landed.drop("day")))


def _messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ticker messages: the price as text, the volume only in every other type of event."""
    t = ticks(spark, sf_dir)
    body = F.to_json(
        F.struct(
            F.col("price").cast("string").alias("price"),
            (F.col("price") - 0.5).cast("string").alias("bid"),
            F.when(F.col("series") != "error", F.col("volume").cast("string")).alias("volume"),
        )
    )
    return t.select("series", "ts", body.alias("message"))


def ticker_decode(spark: SparkSession, sf_dir: str) -> DataFrame:
    return finish(payloads.decode_tickers(_messages(spark, sf_dir)))


def latest_quote(spark: SparkSession, sf_dir: str) -> DataFrame:
    return finish(payloads.latest_quote(payloads.decode_tickers(_messages(spark, sf_dir))))


def _spans(bars: DataFrame) -> DataFrame:
    return bars.groupBy("series").agg(F.min("ts").alias("start_ts"), F.max("ts").alias("end_ts"))


def chunk_plan_300m(spark: SparkSession, sf_dir: str) -> DataFrame:
    return finish(requests.forward_chunks(_spans(bars_1h(spark, sf_dir))))


def chunk_plan_30d(spark: SparkSession, sf_dir: str) -> DataFrame:
    return finish(requests.backward_chunks(_spans(bars_1d(spark, sf_dir)), 730, 30))


def timeframe_seconds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Timeframe strings spelled from line items, counted by length in seconds."""
    unit = F.element_at(F.array(F.lit("m"), F.lit("h"), F.lit("d")), F.pmod("l_suppkey", F.lit(3)).cast("int") + 1)
    frames = table(spark, sf_dir, "lineitem").select(
        F.concat(F.col("l_quantity").cast("int").cast("string"), unit).alias("timeframe")
    )
    return finish(
        frames.groupBy("timeframe").agg(F.count(F.lit(1)).alias("n")).withColumn(
            "seconds", timeparts.timeframe_seconds(F.col("timeframe"))
        )
    )


def recent_slice(spark: SparkSession, sf_dir: str) -> DataFrame:
    return finish(bar_ops.recent(bars_1h(spark, sf_dir), 120 * 60))


def min_history_flag(spark: SparkSession, sf_dir: str) -> DataFrame:
    return finish(bar_ops.history_flags(bar_ops.recent(bars_1h(spark, sf_dir), 120 * 60)))


def _repeated(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw trades as one-tick bars: many stamps repeat within a series."""
    price = F.col("price")
    return trades(spark, sf_dir).select(
        "series", "ts", price.alias("open"), price.alias("high"), price.alias("low"), price.alias("close"), "volume",
        F.col("l_orderkey").alias("batch"),
    )


def dedup_first(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The batch decides, then the price (different ones are over a millionth apart) and the volume."""
    copies = _repeated(spark, sf_dir).withColumn("_price", F.round(F.col("open") * 1_000_000).cast("bigint"))
    order = bar_ops.packed(("batch", 15), ("_price", 17), ("volume", 6))
    return finish(bar_ops.keep_first(copies, order).drop("_price"), 8)


def completeness(spark: SparkSession, sf_dir: str) -> DataFrame:
    return finish(quality.completeness(bars_1h(spark, sf_dir), 30 * 24))


def gap_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return finish(quality.gap_report(bars_1h(spark, sf_dir), HOURLY))


def quality_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    damaged = _repeated(spark, sf_dir).withColumns(
        {
            "open": F.when(F.col("batch") % 7 != 0, F.col("open")),
            "close": F.when(F.col("batch") % 11 == 0, F.lit(float("nan"))).otherwise(F.col("close")),
            "volume": F.when(F.col("volume") == 1, F.lit(0.0)).otherwise(F.col("volume")),
        }
    )
    return finish(quality.quality_report(damaged))


def price_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return finish(quality.price_stats(bars_1d(spark, sf_dir)), 8)


def histogram_50(spark: SparkSession, sf_dir: str) -> DataFrame:
    return finish(quality.histogram(bars_1h(spark, sf_dir), "close"))


def union_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two feeds that overlap, combined with the first one preferred."""
    d = bars_1d(spark, sf_dir)
    first = d.where(F.year("ts") <= 1998).withColumn("seq", F.lit(1))
    second = d.where(F.year("ts") >= 1998).withColumns({"seq": F.lit(2), "volume": F.col("volume") + 1})
    return finish(bar_ops.keep_first(bar_ops.combine([first, second]), bar_ops.packed(("seq", 1))), 8)


def _keys(bars: DataFrame) -> DataFrame:
    return bars.select("series", "ts")


def key_intersect(spark: SparkSession, sf_dir: str) -> DataFrame:
    b = bars_1h(spark, sf_dir)
    return finish(_keys(b.where(F.col("volume") > 100)).intersect(_keys(b.where(F.col("close") > 20))))


def key_difference(spark: SparkSession, sf_dir: str) -> DataFrame:
    b = bars_1h(spark, sf_dir)
    return finish(_keys(b).join(_keys(b.where(F.col("close") > 20)), ["series", "ts"], "left_anti"))


def distinct_series(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ticks(spark, sf_dir).select("series").distinct()


def head_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return finish(splits.head(bars_1h(spark, sf_dir), 100, HOURLY))


def tail_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return finish(splits.tail(bars_1h(spark, sf_dir), 100, HOURLY))


def latest_bar(spark: SparkSession, sf_dir: str) -> DataFrame:
    return finish(splits.latest(bars_1d(spark, sf_dir)), 8)


def time_slice(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Half-open time range."""
    b = bars_1h(spark, sf_dir)
    since, until = F.lit("2024-01-08").cast("timestamp"), F.lit("2024-01-15").cast("timestamp")
    return finish(b.where((F.col("ts") >= since) & (F.col("ts") < until)))


def as_of_replay(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Simple features of the newest bar known at a past moment."""
    known = bar_ops.as_of(bars_1h(spark, sf_dir), "2024-01-20 12:00:00")
    table_ = features.simple_features(bar_ops.recent(known, 120 * 60), HOURLY, ())
    return finish(splits.latest(table_))


def active_hours(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = ticks(spark, sf_dir).where(timeparts.active_hours(F.col("ts")))
    return finish(t.groupBy("series", F.date_trunc("day", "ts").alias("day")).agg(F.count(F.lit(1)).alias("n")))


def rolling_splits(spark: SparkSession, sf_dir: str) -> DataFrame:
    return finish(splits.rolling_splits(bars_1h(spark, sf_dir), min_train_rows=150).drop("raw_split"))


def split_assignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    b = bars_1h(spark, sf_dir)
    rows = splits.assign(b.select("series", "ts"), splits.rolling_splits(b, min_train_rows=150))
    return finish(rows)


def positional_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    return finish(splits.positional_split(bars_1d(spark, sf_dir).select("series", "ts"), DAILY))


def walk_forward_splits(spark: SparkSession, sf_dir: str) -> DataFrame:
    sizes = bars_1d(spark, sf_dir).groupBy("series").agg(F.count(F.lit(1)).alias("size"))
    return finish(splits.walk_forward_splits(sizes))


def csv_bars(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bars written as CSV, one folder per series, and read back with their schema."""
    path = scratch_path(spark, "csv")
    files.write_bars_csv(bars_1h(spark, sf_dir), path)
    good, _ = files.split_rejects(files.read_bars_csv(spark, path))
    return finish(good)


def stored_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One day of bars from a table partitioned by day."""
    path = scratch_path(spark, "bars")
    files.write_bars(bars_1h(spark, sf_dir), path)
    return finish(spark.read.parquet(path).where("day = date'2024-01-10'").drop("day"))


def overview_daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hourly bars thinned to one point per day."""
    return finish(bar_ops.thinned(bars_1h(spark, sf_dir), 86_400))


def change_histogram(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Distribution of the relative change from bar to bar."""
    b = with_previous(bars_1h(spark, sf_dir), HOURLY, "close", "previous")
    change = F.try_divide(F.col("close"), F.col("previous")) - 1
    return finish(quality.histogram(b.withColumn("change", change), "change"))


def sql_views(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Plain SQL over a published bar table."""
    publish({"hourly_bars": bars_1h(spark, sf_dir)})
    return finish(
        spark.sql("SELECT series, avg(close) AS mean_close, sum(volume) AS volume FROM hourly_bars GROUP BY series")
    )


QUERIES: dict[str, Query] = {
    "csv_bars": csv_bars,
    "stored_day": stored_day,
    "overview_daily": overview_daily,
    "change_histogram": change_histogram,
    "sql_views": sql_views,
    "bars_1d": daily,
    "bars_1h": hourly,
    "payload_decode": payload_decode,
    "ticker_decode": ticker_decode,
    "latest_quote": latest_quote,
    "chunk_plan_300m": chunk_plan_300m,
    "chunk_plan_30d": chunk_plan_30d,
    "timeframe_seconds": timeframe_seconds,
    "recent_slice": recent_slice,
    "min_history_flag": min_history_flag,
    "dedup_first": dedup_first,
    "completeness": completeness,
    "gap_report": gap_report,
    "quality_report": quality_report,
    "price_stats": price_stats,
    "histogram_50": histogram_50,
    "union_sources": union_sources,
    "key_intersect": key_intersect,
    "key_difference": key_difference,
    "distinct_series": distinct_series,
    "head_rows": head_rows,
    "tail_rows": tail_rows,
    "latest_bar": latest_bar,
    "time_slice": time_slice,
    "as_of_replay": as_of_replay,
    "active_hours": active_hours,
    "rolling_splits": rolling_splits,
    "split_assignment": split_assignment,
    "positional_split": positional_split,
    "walk_forward_splits": walk_forward_splits,
}
