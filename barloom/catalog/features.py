"""Feature families over hourly bars, and the three complete feature sets."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, WindowSpec
from pyspark.sql import functions as F

from barloom.catalog import Query
from barloom.catalog.tables import DAILY, HOURLY, SECONDS, bars_1d, bars_1h, bars_1s, finish, supplier_bars
from barloom.functions import timeparts
from barloom.operators import rolling, technical
from barloom.operators.layout import Layout, map_rows, over_chunks
from barloom.operators.metrics import error_metrics, long_predictions
from barloom.operators.recurrence import Smooth, with_smoothed
from barloom.plans import features
from barloom.session import materialized

KEYS = ("series", "ts")
#: One-second bars in chunks of a few hundred rows.
SHORT = Layout(step_seconds=1, chunk_rows=64)
Build = Callable[[DataFrame, WindowSpec], DataFrame]


def windowed(
    build: Build, before: int, after: int = 0, inputs: tuple[str, ...] = ("close",), *, heavy: bool = False,
    digits: int = 6,
) -> Query:
    """Query that adds one feature family to hourly bars and drops the input columns."""

    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        # indicators and frames are over bars with a close; the ticks are read once
        bars = materialized(features.priced(bars_1h(spark, sf_dir)).select(*KEYS, *inputs), "bars")
        out = over_chunks(bars, HOURLY, before, after, build, columns=[*KEYS, *inputs], heavy=heavy)
        return finish(out.drop(*inputs), digits)

    return query


def columns(make: Callable[[WindowSpec], dict[str, Column]]) -> Build:
    return lambda df, w: df.withColumns(make(w))


def rolled(*stats: str) -> Query:
    # a digit more than elsewhere: some ratios of two-decimal prices end in a 5 at the seventh place
    return windowed(
        lambda df, w: rolling.with_rolling(df, w, "close", rolling.WINDOWS, stats), 240, heavy=True, digits=7
    )


def scalar(make: Callable[[], dict[str, Column]]) -> Query:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        return finish(bars_1h(spark, sf_dir).select(*KEYS, *[c.alias(k) for k, c in make().items()]))

    return query


def obv(spark: SparkSession, sf_dir: str) -> DataFrame:
    bars = materialized(features.priced(bars_1h(spark, sf_dir)).select(*KEYS, "close", "volume"), "bars")
    return finish(features.with_obv(bars, HOURLY).select(*KEYS, "obv"))


def ema(df: DataFrame, w: WindowSpec) -> DataFrame:
    return with_smoothed(df, w, [Smooth(f"ema_{n}", F.col("close"), technical.span_alpha(n)) for n in (9, 12, 26)])


RSI = {"rsi_14": 14, "rsi_21": 21}


def rsi(spark: SparkSession, sf_dir: str) -> DataFrame:
    bars = materialized(features.priced(bars_1h(spark, sf_dir)).select(*KEYS, "close"), "bars")
    return finish(features.with_rsi(bars, HOURLY, RSI).select(*KEYS, *RSI))


def rsi_flat_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One-second bars whose price moves on two days in thirty and else stands still, in chunks far shorter than that."""
    moving = F.pmod(F.expr("unix_seconds(ts)"), F.lit(2_592_000)) < 172_800
    held = F.when(moving, F.col("close")).otherwise(F.lit(100.0))
    bars = features.priced(bars_1s(spark, sf_dir)).select(*KEYS, held.alias("close"))
    return finish(features.with_rsi(materialized(bars, "bars"), SHORT, RSI).select(*KEYS, *RSI))


def second_indicators(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Smoothed, rolling and oscillating indicators over one-second bars: many chunks per series."""
    inputs = ("high", "low", "close")
    bars = materialized(features.priced(bars_1s(spark, sf_dir)).select(*KEYS, *inputs), "bars")

    def build(df: DataFrame, w: WindowSpec) -> DataFrame:
        df = rolling.with_rolling(df, w, "close", (5, 60, 240), ("ma", "std", "median"))
        return technical.with_cci(technical.with_ranges(df, w), w)

    return finish(over_chunks(bars, SHORT, LONG, 0, build, columns=[*KEYS, *inputs], heavy=True).drop(*inputs))


def simple_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    return finish(features.simple_features(bars_1h(spark, sf_dir), HOURLY))


def simple_clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    spec = features.simple_spec()
    return features.clean_rows(features.simple_features(bars_1d(spark, sf_dir), DAILY), spec)


def clean_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = simple_clean(spark, sf_dir).groupBy("series").agg(
        F.count(F.lit(1)).alias("rows"), F.min("ts").alias("first_ts"), F.max("ts").alias("last_ts")
    )
    return finish(rows)


def feature_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Features only, in creation order, cut to the first eight."""
    spec = features.simple_spec()
    return finish(simple_features(spark, sf_dir).select(*KEYS, *spec.features[:8]))


def persistence_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ticks to bars to features and targets to errors of the unchanged-price forecast."""
    spec = features.simple_spec()
    forecasts = long_predictions(simple_clean(spark, sf_dir), {"persistence": "close"}, spec.horizons)
    return finish(error_metrics(forecasts, ["series", "horizon"]))


def basic_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    return finish(features.basic_features(bars_1h(spark, sf_dir), HOURLY), 7)


def enhanced_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    return finish(features.enhanced_features(bars_1h(spark, sf_dir), HOURLY), 7)


def second_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Simple features and targets over one-second bars, a table that grows with the events."""
    return finish(features.simple_features(materialized(bars_1s(spark, sf_dir), "bars"), SECONDS))


def supplier_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Persistence errors of every supplier's daily bars."""
    spec = features.simple_spec()
    bars = materialized(supplier_bars(spark, sf_dir), "bars")
    rows = features.clean_rows(features.simple_features(bars, DAILY), spec)
    forecasts = long_predictions(rows, {"persistence": "close"}, spec.horizons)
    return finish(error_metrics(forecasts, ["series", "horizon"]))


SLOPE_ROWS = 60


def slopes(chunk: pd.DataFrame) -> pd.DataFrame:
    """Slope of a straight line through the last ``SLOPE_ROWS`` closes: a function as a caller may bring one."""
    x = np.arange(SLOPE_ROWS) - (SLOPE_ROWS - 1) / 2
    found = np.full(len(chunk), np.nan)
    if len(chunk) >= SLOPE_ROWS:
        windows = np.lib.stride_tricks.sliding_window_view(chunk["close"].to_numpy(float), SLOPE_ROWS)
        found[SLOPE_ROWS - 1 :] = windows @ x / (x @ x)
    return pd.DataFrame({"slope": found})


def mapped_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    bars = materialized(features.priced(bars_1h(spark, sf_dir)).select(*KEYS, "close"), "bars")
    rows = map_rows(bars, HOURLY, SLOPE_ROWS - 1, 0, slopes, "slope double").drop("close")
    return finish(rows.withColumn("slope", F.nanvl("slope", F.lit(None).cast("double"))))


HLC = ("high", "low", "close")
LONG = technical.HISTORY_ROWS

QUERIES: dict[str, Query] = {
    "persistence_metrics": persistence_metrics,
    "simple_features": simple_features,
    "second_features": second_features,
    "supplier_metrics": supplier_metrics,
    "clean_rows": clean_rows,
    "feature_columns": feature_columns,
    "targets": windowed(columns(rolling.target_columns), 0, max(rolling.HORIZONS)),
    "lag_features": windowed(columns(rolling.lag_columns), max(rolling.LAGS)),
    "rolling_mean_std": rolled("ma", "std"),
    "rolling_min_max_range": rolled("min", "max", "range"),
    "rolling_median": rolled("median"),
    "rolling_skew_kurt": rolled("skew", "kurt"),
    "rolling_rel_zscore": rolled("rel_ma", "zscore"),
    "volume_features": windowed(
        columns(lambda w: technical.volume_columns(w, "volume_sma", technical.VOLUME_ROWS)), 20, inputs=("volume",)
    ),
    "returns": windowed(
        columns(
            lambda w: technical.return_columns(w)
            | rolling.change_columns(w, "close", {"price_change_1": 1, "price_change_5": 5})
        ),
        5,
    ),
    "candle_shape": scalar(technical.candle_columns),
    "calendar_features": scalar(lambda: timeparts.calendar_columns(F.col("ts"))),
    "cyclic_features": scalar(lambda: timeparts.cyclic_columns(F.col("ts"))),
    "session_flags": scalar(lambda: timeparts.session_flags(F.col("ts"))),
    "bollinger": windowed(columns(technical.bollinger_columns), 20),
    "stochastic": windowed(technical.with_stochastic, 16, inputs=HLC),
    "williams_r": windowed(columns(lambda w: {"williams_r": technical.williams_column(w)}), 14, inputs=HLC),
    "cci": windowed(technical.with_cci, 20, inputs=HLC),
    "mapped_rows": mapped_rows,
    "obv": obv,
    "ema": windowed(ema, LONG),
    "rsi": rsi,
    "rsi_flat_runs": rsi_flat_runs,
    "second_indicators": second_indicators,
    "macd": windowed(technical.with_macd, LONG),
    "atr": windowed(technical.with_atr, LONG, inputs=HLC),
    "basic_features": basic_features,
    "enhanced_features": enhanced_features,
}
