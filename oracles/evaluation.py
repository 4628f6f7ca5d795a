"""SQL for forecast errors under rolling splits and for scaling."""

from __future__ import annotations

from oracles.base import BARS_1H, shaped
from oracles.data import SPLITS
from oracles.features import SIMPLE, SIMPLE_HORIZONS, clean_table

MODELS = {"persistence": "close", "moving_average_5": "close_ma_5", "moving_average_20": "close_ma_20"}


def long(models: dict[str, str], source: str, keep: str, horizons: tuple[int, ...] = SIMPLE_HORIZONS) -> str:
    return " UNION ALL ".join(
        f"SELECT series, ts, {keep} '{m}' AS model, {h} AS horizon, {c} AS prediction, target_{h} AS actual FROM {source}"
        for m, c in models.items()
        for h in horizons
    )


BASE = f"WITH bars AS ({clean_table(BARS_1H)}), {SPLITS}"
TESTED = """tested AS (SELECT b.*, split FROM bars b JOIN splits s
  ON b.series = s.series AND b.ts >= s.test_start AND b.ts < s.test_end)"""
ERRORS = """sqrt(avg((actual - prediction) ** 2)) AS rmse, avg(abs(actual - prediction)) AS mae,
  avg(abs((actual - prediction) / nullif(actual, 0))) * 100 AS mape"""
METRICS = f"""{BASE}, {TESTED}, forecasts AS ({long(MODELS, "tested", "split,")}),
metrics AS (SELECT model, series, split, horizon, {ERRORS} FROM forecasts GROUP BY ALL)"""
MEANS = "avg(rmse) AS rmse, avg(mae) AS mae, avg(mape) AS mape"
AVGS = "avg(rmse) AS avg_rmse, avg(mae) AS avg_mae, avg(mape) AS avg_mape"
PIVOT = ", ".join(f"avg(rmse) FILTER (horizon = {h}) AS h{h}" for h in SIMPLE_HORIZONS)
WIDE = " ".join(f"h{h}" for h in SIMPLE_HORIZONS)
EXTREMES = """first(horizon ORDER BY rmse, split, horizon) AS best_horizon,
  first(horizon ORDER BY rmse DESC, split, horizon) AS worst_horizon"""
TITLE = """list_aggregate(list_transform(string_split(model, '_'), lambda x: upper(x[1]) || x[2:]), 'string_agg', ' ')"""
BOARD = f"""{METRICS}, board AS (SELECT {TITLE} AS model, {AVGS}, {EXTREMES}, count(*) AS total_predictions
  FROM metrics GROUP BY metrics.model)"""
TRAIN = f"""WITH clean AS ({clean_table(BARS_1H)}), numbered AS (SELECT *,
  row_number() OVER (PARTITION BY series ORDER BY ts) - 1 AS pos, count(*) OVER (PARTITION BY series) AS size FROM clean),
train AS (SELECT * FROM numbered WHERE pos < floor(size * 0.8::DOUBLE))"""


def scaled(shift: str, divisor: str) -> str:
    stats = ", ".join(f"{shift.format(c)} AS m_{c}, {divisor.format(c)} AS d_{c}" for c in SIMPLE)
    cols = ", ".join(f"({c} - m_{c}) / CASE WHEN d_{c} = 0 THEN 1 ELSE d_{c} END AS {c}" for c in SIMPLE)
    return shaped(
        f"{TRAIN}, fit AS (SELECT {stats} FROM train) SELECT series, ts, {cols} FROM clean CROSS JOIN fit", " ".join(SIMPLE)
    )


ORACLES = {
    "split_metrics": shaped(
        f"""{BASE}, {TESTED}, forecasts AS ({long({"persistence": "close"}, "tested", "split,")}),
metrics AS (SELECT model, series, split, horizon, {ERRORS} FROM forecasts GROUP BY ALL)
SELECT m.*, train_start, train_end, test_start, test_end, train_samples,
  (SELECT count(*) FROM tested t WHERE t.series = m.series AND t.split = m.split) AS test_samples
FROM metrics m JOIN splits USING (series, split)""",
        "rmse mae mape",
        "horizon"
    ),
    "stored_metrics": shaped(
        f"{METRICS} SELECT * FROM metrics WHERE model IN ('persistence', 'moving_average_5')", "rmse mae mape", "horizon"
    ),
    "metrics_by_horizon": shaped(
        f"{METRICS} SELECT horizon, {MEANS} FROM metrics GROUP BY horizon", "rmse mae mape", "horizon"
    ),
    "metrics_by_model_horizon": shaped(
        f"{METRICS} SELECT model, horizon, {MEANS} FROM metrics GROUP BY model, horizon", "rmse mae mape", "horizon"
    ),
    "metrics_pivot": shaped(f"{METRICS} SELECT model, {PIVOT} FROM metrics GROUP BY model", WIDE),
    "split_heatmap": shaped(f"{METRICS} SELECT split, {PIVOT} FROM metrics GROUP BY split", WIDE),
    "strict_mape": shaped(
        f"""{METRICS} SELECT model, horizon, CASE WHEN count(*) FILTER (actual = 0) = 0
  THEN avg(abs(actual - prediction) / nullif(abs(actual), 0)) * 100 END AS mape FROM forecasts GROUP BY model, horizon""",
        "mape",
        "horizon"
    ),
    "leaderboard": shaped(
        f"{BOARD} SELECT *, row_number() OVER (ORDER BY avg_rmse, model) AS rank FROM board",
        "avg_rmse avg_mae avg_mape",
        "best_horizon worst_horizon"
    ),
    "best_model": shaped(
        f"{BOARD} SELECT *, 1::BIGINT AS rank FROM board ORDER BY avg_rmse LIMIT 1",
        "avg_rmse avg_mae avg_mape",
        "best_horizon worst_horizon"
    ),
    "model_detail": shaped(
        f"""{METRICS} SELECT model, count(*) AS total_predictions, avg(rmse) AS mean_rmse, stddev_samp(rmse) AS std_rmse,
  avg(mae) AS mean_mae, stddev_samp(mae) AS std_mae, avg(mape) AS mean_mape, stddev_samp(mape) AS std_mape, {EXTREMES},
  min(rmse) AS best_rmse, max(rmse) AS worst_rmse FROM metrics GROUP BY model""",
        "mean_rmse std_rmse mean_mae std_mae mean_mape std_mape best_rmse worst_rmse",
        "best_horizon worst_horizon"
    ),
    "summary_row": shaped(
        f"""{METRICS}, h AS (SELECT model, horizon, {MEANS} FROM metrics GROUP BY model, horizon)
SELECT model, {AVGS}, first(horizon ORDER BY rmse, horizon) AS best_horizon,
  first(horizon ORDER BY rmse DESC, horizon) AS worst_horizon, count(*) AS horizons FROM h GROUP BY model""",
        "avg_rmse avg_mae avg_mape",
        "best_horizon worst_horizon"
    ),
    "boxplot_stats": shaped(
        f"""{METRICS}, q AS (SELECT model, series, quantile_cont(rmse, 0.25) AS q1, quantile_cont(rmse, 0.5) AS median,
  quantile_cont(rmse, 0.75) AS q3 FROM metrics GROUP BY model, series)
SELECT model, series, q1, median, q3, min(rmse) FILTER (rmse >= q1 - 1.5::DOUBLE * (q3 - q1)) AS whisker_low,
  max(rmse) FILTER (rmse <= q3 + 1.5::DOUBLE * (q3 - q1)) AS whisker_high,
  count(*) FILTER (rmse < q1 - 1.5::DOUBLE * (q3 - q1) OR rmse > q3 + 1.5::DOUBLE * (q3 - q1)) AS outliers
FROM metrics JOIN q USING (model, series) GROUP BY model, series, q1, median, q3""",
        "q1 median q3 whisker_low whisker_high"
    ),
    "boxplot_by_model": shaped(
        f"""{METRICS}, q AS (SELECT model, quantile_cont(rmse, 0.25) AS q1, quantile_cont(rmse, 0.5) AS median,
  quantile_cont(rmse, 0.75) AS q3 FROM metrics GROUP BY model)
SELECT model, q1, median, q3, min(rmse) FILTER (rmse >= q1 - 1.5::DOUBLE * (q3 - q1)) AS whisker_low,
  max(rmse) FILTER (rmse <= q3 + 1.5::DOUBLE * (q3 - q1)) AS whisker_high,
  count(*) FILTER (rmse < q1 - 1.5::DOUBLE * (q3 - q1) OR rmse > q3 + 1.5::DOUBLE * (q3 - q1)) AS outliers
FROM metrics JOIN q USING (model) GROUP BY model, q1, median, q3""",
        "q1 median q3 whisker_low whisker_high"
    ),
    "residual_quantiles": shaped(
        f"""{METRICS} SELECT model, horizon, quantile_cont(actual - prediction, 0.05) AS q5, quantile_cont(actual - prediction, 0.5) AS q50,
  quantile_cont(actual - prediction, 0.95) AS q95 FROM forecasts GROUP BY model, horizon""",
        "q5 q50 q95",
        "horizon",
    ),
    "residuals": shaped(
        f"{METRICS} SELECT series, ts, split, model, horizon, actual - prediction AS residual FROM forecasts",
        "residual",
        "horizon",
    ),
    "pred_vs_actual": shaped(
        f"""WITH clean AS ({clean_table(BARS_1H)})
{long({"moving_average_5": "close_ma_5"}, "clean", "", (1, 5, 10, 20))}""",
        "prediction actual",
        "horizon",
    ),
    "robust_scale": scaled("median({0})", "(quantile_cont({0}, 0.75) - quantile_cont({0}, 0.25))"),
    "standard_scale": scaled("avg({0})", "stddev_pop({0})"),
}
