"""Ensemble forecasts over hourly bars: quantiles, probabilities, calibration, documents."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from barloom.catalog import Query
from barloom.catalog.tables import HOURLY, bars_1d, bars_1h, finish
from barloom.functions import labels
from barloom.operators import calibration, probability, splits
from barloom.plans import live
from barloom.session import materialized, publish, register_functions, scratch_path
from barloom.sources import files

HORIZONS = (1, 2, 5, 10, 20)
MEMBERS = 20


def ensemble(spark: SparkSession, sf_dir: str) -> DataFrame:
    return probability.error_ensemble(bars_1h(spark, sf_dir), HOURLY, HORIZONS, MEMBERS)


def prices(bars: DataFrame) -> DataFrame:
    return bars.groupBy("series").agg(F.max_by("close", "ts").alias("price"))


def member_quantiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    return finish(probability.member_quantiles(ensemble(spark, sf_dir)))


def pinball_loss(spark: SparkSession, sf_dir: str) -> DataFrame:
    return finish(probability.pinball_loss(probability.member_quantiles(ensemble(spark, sf_dir), keep=["actual"])))


def stored_quantiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quantiles written with a folder per level; one level is read."""
    path = scratch_path(spark, "quantiles")
    quantiles = probability.member_quantiles(ensemble(spark, sf_dir))
    files.write_quantiles(quantiles, path)
    return finish(spark.read.schema(quantiles.schema).parquet(path).where(F.col("q") == 0.25))


def prediction_intervals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return finish(probability.prediction_intervals(ensemble(spark, sf_dir)))


def interval_coverage(spark: SparkSession, sf_dir: str) -> DataFrame:
    return finish(probability.interval_coverage(probability.prediction_intervals(ensemble(spark, sf_dir), keep=["actual"])))


def threshold_set(spark: SparkSession, sf_dir: str) -> DataFrame:
    return finish(probability.live_thresholds(prices(bars_1d(spark, sf_dir))), 8)


def percent_threshold_set(spark: SparkSession, sf_dir: str) -> DataFrame:
    return finish(probability.percent_thresholds(prices(bars_1d(spark, sf_dir))), 8)


def query_name_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Thresholds read back from generated names of every daily close."""
    p = F.col("close")
    names = bars_1d(spark, sf_dir).select(
        "series",
        "ts",
        F.explode(
            F.array(
                labels.above_name(p), labels.below_name(p * 0.98), labels.between_name(p * 0.995, p * 1.005), F.lit("price")
            )
        ).alias("query"),
    )
    low, high = labels.query_bounds(F.col("query"))
    op = labels.query_operator(F.col("query"))
    return finish(names.select("series", "ts", "query", op.alias("op"), low.alias("low"), high.alias("high")))


def event_probabilities(spark: SparkSession, sf_dir: str) -> DataFrame:
    thresholds = probability.live_thresholds(prices(bars_1h(spark, sf_dir)))
    rows = probability.event_probabilities(ensemble(spark, sf_dir), thresholds)
    return finish(rows.withColumn("event", F.col("event").cast("double")))


def scored(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Probabilities relative to each row's close, at nine digits so bin edges are unambiguous."""
    rows = probability.relative_probabilities(ensemble(spark, sf_dir))
    return rows.withColumn("probability", F.round("probability", 9))


def probabilities_long(spark: SparkSession, sf_dir: str) -> DataFrame:
    return finish(scored(spark, sf_dir).withColumn("event", F.col("event").cast("double")), 9)


def probabilities_wide(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Long probabilities as one column per query."""
    names = ["above_0.5pct", "below_0.5pct", "above_1pct", "below_1pct", "between_0.2pct"]
    wide = scored(spark, sf_dir).groupBy("series", "ts", "horizon").pivot("query", names).agg(F.first("probability"))
    return finish(wide.toDF("series", "ts", "horizon", "up_half", "down_half", "up_one", "down_one", "flat"), 9)


def sampled_distribution(spark: SparkSession, sf_dir: str) -> DataFrame:
    return finish(probability.sampled_distribution(ensemble(spark, sf_dir)), 5)


def sampled_probabilities(spark: SparkSession, sf_dir: str) -> DataFrame:
    return finish(probability.sampled_probabilities(ensemble(spark, sf_dir)))


def sql_probabilities(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Event probabilities asked for in SQL alone, by the functions that the session registers."""
    register_functions(spark)
    publish({"ensemble_forecasts": ensemble(spark, sf_dir)})
    return finish(spark.sql("""
        WITH gridded AS (SELECT series, ts, horizon, close, percentile_grid(members) AS grid FROM ensemble_forecasts)
        SELECT series, ts, horizon, above_name(close * 1.01D) AS up, between_name(close * 0.998D, close * 1.002D) AS band,
          sorted_quantile(grid, 0.5D) AS middle, event_probability(grid, 'above', close * 1.01D, NULL) AS p_up,
          event_probability(grid, 'below', close * 0.99D, NULL) AS p_down,
          event_probability(grid, 'between', close * 0.998D, close * 1.002D) AS p_band FROM gridded"""))


def sql_splits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rolling windows of each series by the session's table function, with the rows they train on."""
    register_functions(spark)
    publish({"hourly_bars": materialized(bars_1h(spark, sf_dir).select("series", "ts"), "bars")})
    return finish(spark.sql("""
        WITH days AS (SELECT b.series, first, unix_seconds(ts) - unix_seconds(first) AS age FROM hourly_bars b
            JOIN (SELECT series, min(ts) AS first FROM hourly_bars GROUP BY series) USING (series)),
        windows AS (SELECT s.series, w.* FROM (SELECT series, min(ts) AS first, max(ts) AS last FROM hourly_bars GROUP BY series) s,
            LATERAL split_windows(s.first, s.last, 7, 1, 1) w),
        trained AS (SELECT series, number, count(*) AS train_samples FROM (SELECT series,
            explode(sequence(greatest(0L, age div 86400 - 6), age div 86400)) AS number FROM days) GROUP BY series, number)
        SELECT series, number, train_start, test_start, test_end, train_samples FROM windows JOIN trained USING (series, number)"""))


def probability_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return finish(probability.probability_summary(scored(spark, sf_dir)))


def brier_logloss(spark: SparkSession, sf_dir: str) -> DataFrame:
    return finish(calibration.scores(scored(spark, sf_dir)))


def ece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return finish(calibration.calibration_metrics(scored(spark, sf_dir)))


def calibration_curve(spark: SparkSession, sf_dir: str) -> DataFrame:
    return finish(calibration.calibration_curve(scored(spark, sf_dir)))


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents of the newest bar: only the bars that its forecast reaches back to are forecast from."""
    bars = materialized(splits.tail(bars_1h(spark, sf_dir), MEMBERS + max(HORIZONS), HOURLY), "newest")
    newest = splits.latest(probability.error_ensemble(bars, HOURLY, HORIZONS, MEMBERS))
    return live.forecast_documents(newest, probability.live_thresholds(prices(bars)))


def stored_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents written as JSON lines and as flat rows, read back: every field of either."""
    told, path = materialized(documents(spark, sf_dir), "documents"), scratch_path(spark, "forecasts")
    for form in ("json", "flat"):
        files.write_documents(told, f"{path}/{form}", form)
    whole = files.read_documents(spark, f"{path}/json", "json").select("series", "ts", F.lit("json").alias("form"), "current_price", "field", "value")
    flat = files.read_documents(spark, f"{path}/flat", "flat").select("series", "ts", F.lit("flat").alias("form"), "current_price", "field", "value")
    return finish(whole.unionByName(flat))


def forecast_document(spark: SparkSession, sf_dir: str) -> DataFrame:
    return finish(live.as_json(documents(spark, sf_dir)))


def forecast_flat(spark: SparkSession, sf_dir: str) -> DataFrame:
    return finish(live.flattened(documents(spark, sf_dir)))


def document_quantiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quantiles and intervals of the written JSON, read back."""
    text = live.as_json(documents(spark, sf_dir))
    inner = "map<string,map<string,double>>"
    body = F.from_json("document", f"{live.QUANTILE} {inner}, {live.INTERVAL} map<string,map<string,struct<lower:double,upper:double>>>")
    parsed = text.select("series", "ts", body.alias("d"))
    q = parsed.select("series", "ts", F.explode(f"d.{live.QUANTILE}").alias("label", "m")).select(
        "series", "ts", "label", F.explode("m").alias("horizon", "low")
    )
    i = parsed.select("series", "ts", F.explode(f"d.{live.INTERVAL}").alias("label", "m")).select(
        "series", "ts", "label", F.explode("m").alias("horizon", "b")
    )
    return finish(
        q.withColumn("high", F.col("low")).unionByName(
            i.select("series", "ts", "label", "horizon", F.col("b.lower").alias("low"), F.col("b.upper").alias("high"))
        )
    )


def forecast_health(spark: SparkSession, sf_dir: str) -> DataFrame:
    b = bars_1h(spark, sf_dir)
    return finish(live.health(b.select("series", "ts"), b, "2024-01-20 12:05:00"))


QUERIES: dict[str, Query] = {
    "member_quantiles": member_quantiles,
    "pinball_loss": pinball_loss,
    "stored_quantiles": stored_quantiles,
    "prediction_intervals": prediction_intervals,
    "interval_coverage": interval_coverage,
    "threshold_set": threshold_set,
    "percent_threshold_set": percent_threshold_set,
    "query_name_parse": query_name_parse,
    "event_probabilities": event_probabilities,
    "probabilities_long": probabilities_long,
    "probabilities_wide": probabilities_wide,
    "sampled_distribution": sampled_distribution,
    "sampled_probabilities": sampled_probabilities,
    "sql_probabilities": sql_probabilities,
    "sql_splits": sql_splits,
    "probability_summary": probability_summary,
    "brier_logloss": brier_logloss,
    "ece": ece,
    "calibration_curve": calibration_curve,
    "forecast_document": forecast_document,
    "stored_documents": stored_documents,
    "forecast_flat": forecast_flat,
    "document_quantiles": document_quantiles,
    "forecast_health": forecast_health,
}
