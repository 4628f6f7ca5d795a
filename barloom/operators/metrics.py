"""Forecast error metrics and the tables built from them.

Forecasts are long: one row per (series, ts, horizon) and model with ``actual`` and
``prediction``. Everything here is an aggregate of plain sums, combined map-side.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from barloom.functions.labels import display_name
from barloom.operators import scaling
from barloom.operators.layout import attach

ERRORS = ("rmse", "mae", "mape")


def present(value: Column) -> Column:
    """Neither NULL nor NaN; NaN sorts above every number and must not reach a comparison."""
    return value.isNotNull() & ~F.isnan(value)


def long_targets(table: DataFrame, horizons: Sequence[int], keep: Sequence[str] = ()) -> DataFrame:
    """``target_h`` columns as rows ``(series, ts, horizon, actual)``."""
    pairs = F.array(*[F.struct(F.lit(h).alias("horizon"), F.col(f"target_{h}").alias("actual")) for h in horizons])
    return table.select("series", "ts", *keep, F.inline(pairs))


def long_predictions(table: DataFrame, models: dict[str, str], horizons: Sequence[int], keep: Sequence[str] = ()) -> DataFrame:
    """Rows (model x horizon) from columns that forecast every horizon with the same value."""
    targets = long_targets(table, horizons, [*keep, *models.values()])
    named = F.array(*[F.struct(F.lit(m).alias("model"), F.col(c).alias("prediction")) for m, c in models.items()])
    return targets.select("series", "ts", *keep, "horizon", "actual", F.inline(named))


def align(predictions: DataFrame, targets: DataFrame) -> DataFrame:
    """Predictions with the value that came true, matched on the keys and never by row order."""
    return predictions.join(targets, ["series", "ts", "horizon"])


def error_columns(actual: Column, prediction: Column) -> dict[str, Column]:
    valid = present(actual) & present(prediction)
    error = F.when(valid, actual - prediction)
    relative = F.when(valid & (actual != 0), F.abs(error / F.nullif(actual, F.lit(0.0))))
    return {
        "rmse": F.sqrt(F.avg(error * error)),
        "mae": F.avg(F.abs(error)),
        "mape": F.avg(relative) * 100,
    }


def error_metrics(forecasts: DataFrame, by: Sequence[str]) -> DataFrame:
    """RMSE, MAE and MAPE per group; a group without valid pairs has NULL metrics."""
    columns = error_columns(F.col("actual"), F.col("prediction"))
    return forecasts.groupBy(*by).agg(*[c.alias(k) for k, c in columns.items()])


def strict_mape(forecasts: DataFrame, by: Sequence[str]) -> DataFrame:
    """MAPE without the guard for zero actuals: any zero among them leaves the group NULL."""
    actual, error = F.col("actual"), F.abs(F.col("actual") - F.col("prediction"))
    valid = present(actual) & present(F.col("prediction"))
    zeros = F.count_if(valid & (actual == 0))
    mean = F.avg(F.when(valid, F.try_divide(error, F.abs(actual)))) * 100
    return forecasts.groupBy(*by).agg(F.when(zeros == 0, mean).alias("mape"))


def mean_errors(metrics: DataFrame, by: Sequence[str]) -> DataFrame:
    return metrics.groupBy(*by).agg(*[F.avg(e).alias(e) for e in ERRORS])


def pivot_errors(metrics: DataFrame, row: str, column: str, values: Sequence, error: str = "rmse") -> DataFrame:
    """Mean error as a matrix; the column values are given, so no extra pass looks for them."""
    return metrics.groupBy(row).pivot(column, list(values)).agg(F.avg(error))


def _extreme_horizons() -> dict[str, Column]:
    """Horizon of the smallest and largest RMSE; the first split and horizon win ties."""
    place = ("split", "horizon")
    return {
        "best_horizon": F.min_by("horizon", F.struct("rmse", *place)),
        "worst_horizon": F.max_by("horizon", F.struct("rmse", *[(-F.col(p)).alias(p) for p in place])),
    }


def leaderboard(metrics: DataFrame) -> DataFrame:
    """Models by mean RMSE. The ranking window sees one row per model."""
    board = metrics.groupBy("model").agg(
        *[F.avg(e).alias(f"avg_{e}") for e in ERRORS],
        *[c.alias(k) for k, c in _extreme_horizons().items()],
        F.count(F.lit(1)).alias("total_predictions"),
    )
    named = board.withColumn("model", display_name(F.col("model")))
    return named.withColumn("rank", F.row_number().over(Window.orderBy("avg_rmse", "model")))


def model_detail(metrics: DataFrame) -> DataFrame:
    """Mean and sample deviation of each error, with the best and worst horizon."""
    stats = [f(e).alias(f"{p}_{e}") for e in ERRORS for p, f in (("mean", F.avg), ("std", F.stddev_samp))]
    return metrics.groupBy("model").agg(
        F.count(F.lit(1)).alias("total_predictions"),
        *stats,
        *[c.alias(k) for k, c in _extreme_horizons().items()],
        F.min("rmse").alias("best_rmse"),
        F.max("rmse").alias("worst_rmse"),
    )


def overall_summary(metrics: DataFrame) -> DataFrame:
    """Per model: the mean over horizons of each horizon's mean error, and the extreme horizons."""
    by_horizon = mean_errors(metrics, ["model", "horizon"])
    return by_horizon.groupBy("model").agg(
        *[F.avg(e).alias(f"avg_{e}") for e in ERRORS],
        F.min_by("horizon", F.struct("rmse", "horizon")).alias("best_horizon"),
        F.max_by("horizon", F.struct("rmse", (-F.col("horizon")).alias("h"))).alias("worst_horizon"),
        F.count(F.lit(1)).alias("horizons"),
    )


def box_stats(metrics: DataFrame, error: str = "rmse", by: Sequence[str] = ("model",)) -> DataFrame:
    """Quartiles and 1.5 IQR whiskers clipped to the data. ``metrics`` is read several times: hand in a stored table."""
    keys = list(by)
    quartiles = scaling.group_quantiles(metrics, keys, error, (0.25, 0.5, 0.75))
    q1, q2, q3 = (F.get("quantiles", F.lit(i)) for i in range(3))
    reach = (q3 - q1) * 1.5
    bounds = quartiles.select(*keys, q1.alias("q1"), q2.alias("median"), q3.alias("q3"), (q1 - reach).alias("_lo"), (q3 + reach).alias("_hi"))
    bounded = attach(metrics.select(*keys, error), bounds, keys, spread=[error])
    value = F.col(error)
    return bounded.groupBy(*keys, "q1", "median", "q3").agg(
        F.min(F.when(value >= F.col("_lo"), value)).alias("whisker_low"),
        F.max(F.when(value <= F.col("_hi"), value)).alias("whisker_high"),
        F.count_if((value < F.col("_lo")) | (value > F.col("_hi"))).alias("outliers"),
    )


def residuals(forecasts: DataFrame) -> DataFrame:
    return forecasts.withColumn("residual", F.col("actual") - F.col("prediction"))
