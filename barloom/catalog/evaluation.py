"""Forecast errors under rolling splits, and the comparisons built on them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from barloom.catalog import Query
from barloom.catalog.tables import HOURLY, bars_1h, finish
from barloom.operators import metrics, scaling, splits
from barloom.plans import features
from barloom.session import materialized, scratch_path
from barloom.sources import files

HORIZONS = features.SIMPLE_HORIZONS
MODELS = {"persistence": "close", "moving_average_5": "close_ma_5", "moving_average_20": "close_ma_20"}
SHOWN = (1, 5, 10, 20)
MIN_TRAIN = 150


def clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The feature table of the evaluation: written once, then read column by column."""
    rows = features.clean_rows(features.simple_features(bars_1h(spark, sf_dir), HOURLY), features.simple_spec())
    return materialized(rows, "features")


def forecasts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Forecasts of every model on the test rows of every split."""
    rows = clean(spark, sf_dir)
    tested = splits.assign(rows, splits.rolling_splits(rows, min_train_rows=MIN_TRAIN)).where("part = 'test'")
    return metrics.long_predictions(tested, MODELS, HORIZONS, ["split"])


def by_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    return metrics.error_metrics(forecasts(spark, sf_dir), ["model", "series", "split", "horizon"])


def split_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Errors with the window bounds and sample counts of their split."""
    rows = clean(spark, sf_dir)
    windows = splits.rolling_splits(rows, min_train_rows=MIN_TRAIN)
    assigned = splits.assign(rows, windows).where("part = 'test'")
    tested = assigned.groupBy("series", "split").agg(F.count(F.lit(1)).alias("test_samples"))
    errors = metrics.error_metrics(
        metrics.long_predictions(assigned, {"persistence": "close"}, HORIZONS, ["split"]),
        ["model", "series", "split", "horizon"],
    )
    return finish(errors.join(windows.drop("raw_split"), ["series", "split"]).join(tested, ["series", "split"]))


def metrics_by_horizon(spark: SparkSession, sf_dir: str) -> DataFrame:
    return finish(metrics.mean_errors(by_split(spark, sf_dir), ["horizon"]))


def metrics_by_model_horizon(spark: SparkSession, sf_dir: str) -> DataFrame:
    return finish(metrics.mean_errors(by_split(spark, sf_dir), ["model", "horizon"]))


def metrics_pivot(spark: SparkSession, sf_dir: str) -> DataFrame:
    wide = metrics.pivot_errors(by_split(spark, sf_dir), "model", "horizon", HORIZONS)
    return finish(wide.toDF("model", *[f"h{h}" for h in HORIZONS]))


def split_heatmap(spark: SparkSession, sf_dir: str) -> DataFrame:
    wide = metrics.pivot_errors(by_split(spark, sf_dir), "split", "horizon", HORIZONS)
    return finish(wide.toDF("split", *[f"h{h}" for h in HORIZONS]))


def strict_mape(spark: SparkSession, sf_dir: str) -> DataFrame:
    return finish(metrics.strict_mape(forecasts(spark, sf_dir), ["model", "horizon"]))


def leaderboard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return finish(metrics.leaderboard(by_split(spark, sf_dir)))


def best_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    return finish(metrics.leaderboard(by_split(spark, sf_dir)).orderBy("avg_rmse", "model").limit(1))


def model_detail(spark: SparkSession, sf_dir: str) -> DataFrame:
    return finish(metrics.model_detail(by_split(spark, sf_dir)))


def summary_row(spark: SparkSession, sf_dir: str) -> DataFrame:
    return finish(metrics.overall_summary(by_split(spark, sf_dir)))


def boxplot_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return finish(metrics.box_stats(materialized(by_split(spark, sf_dir), "errors"), "rmse", ["model", "series"]))


def residual_quantiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quantiles of every model's residuals by horizon, over single forecasts: groups grow with the table."""
    rows = materialized(metrics.residuals(forecasts(spark, sf_dir)).select("model", "horizon", "residual"), "residuals")
    levels = (0.05, 0.5, 0.95)
    found = scaling.group_quantiles(rows, ["model", "horizon"], "residual", levels, limit=64)
    return finish(found.select("model", "horizon", *[F.get("quantiles", F.lit(k)).alias(f"q{round(100 * q)}") for k, q in enumerate(levels)]))


def boxplot_by_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Spread of each model's error over all series, splits and horizons."""
    return finish(metrics.box_stats(materialized(by_split(spark, sf_dir), "errors"), "rmse", ["model"]))


def residuals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return finish(metrics.residuals(forecasts(spark, sf_dir)).drop("actual", "prediction"))


def pred_vs_actual(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Predictions matched with targets on their keys, for the plotted horizons."""
    rows = clean(spark, sf_dir)
    predicted = metrics.long_predictions(rows, {"moving_average_5": "close_ma_5"}, SHOWN).drop("actual")
    return finish(metrics.align(predicted, metrics.long_targets(rows, SHOWN)))


def stored_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Metrics of all models written by model; two are asked for, and one that was never written."""
    path = scratch_path(spark, "metrics")
    found = by_split(spark, sf_dir)
    files.write_metrics(found, path)
    return finish(files.read_metrics(spark, path, found.schema, ["persistence", "moving_average_5", "absent"]))


FEATURES = features.simple_spec().features


def _train(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    rows = materialized(splits.positional_split(clean(spark, sf_dir), HOURLY), "parts")
    return rows.where("part = 'train'"), rows


def robust_scale(spark: SparkSession, sf_dir: str) -> DataFrame:
    train, rows = _train(spark, sf_dir)
    fitted = scaling.robust_scaling(train, FEATURES)
    return finish(fitted.apply(rows).select("series", "ts", *FEATURES))


def standard_scale(spark: SparkSession, sf_dir: str) -> DataFrame:
    train, rows = _train(spark, sf_dir)
    fitted = scaling.standard_scaling(train, FEATURES)
    return finish(fitted.apply(rows).select("series", "ts", *FEATURES))


QUERIES: dict[str, Query] = {
    "split_metrics": split_metrics,
    "stored_metrics": stored_metrics,
    "metrics_by_horizon": metrics_by_horizon,
    "metrics_by_model_horizon": metrics_by_model_horizon,
    "metrics_pivot": metrics_pivot,
    "split_heatmap": split_heatmap,
    "strict_mape": strict_mape,
    "leaderboard": leaderboard,
    "best_model": best_model,
    "model_detail": model_detail,
    "summary_row": summary_row,
    "boxplot_stats": boxplot_stats,
    "boxplot_by_model": boxplot_by_model,
    "residual_quantiles": residual_quantiles,
    "residuals": residuals,
    "pred_vs_actual": pred_vs_actual,
    "robust_scale": robust_scale,
    "standard_scale": standard_scale,
}
