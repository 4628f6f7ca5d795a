"""Streaming jobs run over everything available, results read from where they wrote."""

from __future__ import annotations

from functools import partial

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from barloom.catalog import Query
from barloom.catalog.learning import SPEC, forest, prepared
from barloom.catalog.tables import HOURLY, bars_1h, finish, table, ticks
from barloom.operators.layout import Layout
from barloom.operators.sessions import sessions
from barloom.plans import live
from barloom.session import materialized, scratch_path
from barloom.streaming import features as live_stream
from barloom.streaming import intake, scoring, stateful


def tick_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    schema = table(spark, sf_dir, "events").schema
    raw = intake.read_files(spark, sf_dir, schema, name="events.parquet")
    return raw.select(
        F.col("event_type").alias("series"),
        F.col("ts").cast("timestamp").alias("ts"),
        F.col("value").alias("price"),
        F.get_json_object("props", "$.k").cast("double").alias("volume"),
        "event_id",
    )


def deliveries(spark: SparkSession, sf_dir: str, parts: int = 3) -> tuple[str, DataFrame, list[DataFrame]]:
    """A landing folder, the stream that reads it, and hourly bars to land there: equal parts of the time they span."""
    bars = materialized(bars_1h(spark, sf_dir), "bars")
    span = bars.agg(F.min(F.unix_seconds("ts")).alias("first"), F.max(F.unix_seconds("ts")).alias("last")).first()
    landed = scratch_path(spark, "landed")
    bars.limit(0).write.parquet(landed)
    first, width = span.first or 0, ((span.last or 0) - (span.first or 0)) // parts + 1
    part = F.expr(f"(unix_seconds(ts) - {first}) div {width}")
    return landed, intake.read_files(spark, landed, bars.schema, name="*.parquet"), [bars.where(part == k) for k in range(parts)]


def land(delivery: DataFrame, folder: str) -> None:
    delivery.write.mode("append").parquet(folder)


def stream_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every tick arrives twice."""
    once = tick_stream(spark, sf_dir)
    twice = once.unionByName(tick_stream(spark, sf_dir))
    return finish(intake.drain(intake.without_repeats(twice), "dedup"))


def stream_bars(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bars the watermark has closed by the end of the data."""
    return finish(intake.drain(intake.bars(tick_stream(spark, sf_dir), "1 hour", ("ts", "event_id")), "bars"))


def stream_sliding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return finish(intake.drain(intake.sliding_stats(tick_stream(spark, sf_dir), "120 minutes", "60 minutes"), "sliding"))


SESSION_GAP = 1800
#: Stamps have microseconds, so a slot of this many seconds is not bounded by its steps; it is by the rate of ticks.
STAMPS = Layout(step_seconds=1, chunk_rows=65_536)


def session_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sessions of all ticks, in batch."""
    return finish(sessions(ticks(spark, sf_dir), SESSION_GAP, STAMPS))


def stream_sessions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sessions the watermark has closed by the end of the data."""
    return finish(intake.drain(intake.sessions(tick_stream(spark, sf_dir), f"{SESSION_GAP} seconds"), "sessions"))


def featured(spark: SparkSession, sf_dir: str, again: bool = False) -> DataFrame:
    """Stream features of bars that land and are read in turn, the first delivery once more at the end if ``again``."""
    landed, bars, parts = deliveries(spark, sf_dir)
    path = scratch_path(spark, "features")
    for delivery in [*parts, *parts[: int(again)]]:
        land(delivery, landed)
        rows = intake.drain(stateful.simple_features(bars), "features", path=path)
    return rows


def live_features(spark: SparkSession, sf_dir: str, kind: str) -> DataFrame:
    """A whole feature set on bars that land in turn."""
    landed, bars, parts = deliveries(spark, sf_dir)
    path = scratch_path(spark, "live")
    for delivery in parts:
        land(delivery, landed)
        live_stream.feature_stream(bars, path, f"{path}/checkpoint", HOURLY, kind=kind).awaitTermination()
    return finish(live_stream.read_features(spark, path, kind).where("not late").drop("late", "batch_id"), 7)


def stream_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    return finish(featured(spark, sf_dir).where("not late").drop("late"))


def stream_late_bars(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bars that came after later ones of their series, counted apart from those that got features."""
    rows = featured(spark, sf_dir, again=True).groupBy("series")
    return finish(rows.agg(F.sum((~F.col("late")).cast("bigint")).alias("in_time"), F.sum(F.col("late").cast("bigint")).alias("late")))


def scored(spark: SparkSession, sf_dir: str) -> tuple[str, DataFrame]:
    """Where the scores of landed bars are, and the bars."""
    train, _ = prepared(spark, sf_dir)
    model = forest(train)
    path = scratch_path(spark, "scores")
    landed, bars, parts = deliveries(spark, sf_dir)
    rows = stateful.simple_features(bars).where("not late").select("series", "ts", "close", *SPEC.features)
    for delivery in parts:
        land(delivery, landed)
        query = scoring.score_stream(rows, model, f"{path}/scores", f"{path}/checkpoint", keep_input=f"{path}/rows")
        query.awaitTermination()
        scoring.keep_progress(query, f"{path}/progress")
    return path, spark.read.schema(bars.schema).parquet(landed)


def stream_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Features of landed bars scored by a forest, one document per series and batch."""
    return finish(scoring.read_scores(spark, f"{scored(spark, sf_dir)[0]}/scores"))


def live_health(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Health five minutes after the newest bar, from the forecasts that a stream has made."""
    path, bars = scored(spark, sf_dir)
    now = bars.agg(F.date_format(F.max("ts") + F.make_dt_interval(mins=F.lit(5)), "yyyy-MM-dd HH:mm:ss").alias("t")).first().t
    return finish(live.health(scoring.read_scores(spark, f"{path}/scores"), bars, now))


def stream_snapshots(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What each micro-batch took in: rows of its snapshot, as its progress report says, and documents made of them."""
    path, _ = scored(spark, sf_dir)
    kept = spark.read.schema("series string, ts timestamp, batch_id bigint").parquet(f"{path}/rows").groupBy("batch_id").agg(F.count(F.lit(1)).alias("kept"))
    made = scoring.read_scores(spark, f"{path}/scores").groupBy("batch_id").agg(F.count(F.lit(1)).alias("documents"))
    return finish(kept.join(made, "batch_id").join(scoring.read_progress(spark, f"{path}/progress"), "batch_id").drop("at"))


QUERIES: dict[str, Query] = {
    "stream_dedup": stream_dedup,
    "stream_bars": stream_bars,
    "stream_sliding": stream_sliding,
    "session_windows": session_windows,
    "stream_sessions": stream_sessions,
    "stream_features": stream_features,
    "stream_basic_features": partial(live_features, kind="basic"),
    "stream_enhanced_features": partial(live_features, kind="enhanced"),
    "stream_late_bars": stream_late_bars,
    "stream_scoring": stream_scoring,
    "live_health": live_health,
    "stream_snapshots": stream_snapshots,
}
