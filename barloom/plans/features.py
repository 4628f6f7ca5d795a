"""The three feature sets and the modelling table, bars in, wide rows out."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, WindowSpec
from pyspark.sql import functions as F

from barloom.functions import timeparts
from barloom.operators import rolling, technical
from barloom.operators.layout import Layout, carried_forward, over_chunks, running_totals, with_previous
from barloom.operators.metrics import present
from barloom.session import materialized

KEYS = ("series", "ts")
OHLCV = ("open", "high", "low", "close", "volume")

# What each feature set holds.
SIMPLE_LAGS, SIMPLE_WINDOWS, SIMPLE_VOLUME_ROWS = (1, 2, 5, 10), (5, 20), 5
SIMPLE_HORIZONS = (1, 2, 5, 10, 20)
BASIC_WINDOWS = (5, 10, 15, 30, 60)
BASIC_STATS = ("ma", "std", "min", "max", "rel_ma")
ENHANCED_STATS = ("ma", "std", "min", "max", "median", "skew", "kurt", "rel_ma", "zscore", "range")
BASIC_CALENDAR = (
    "hour", "hour_sin", "hour_cos", "day_of_week", "dow_sin", "dow_cos", "minute", "minute_sin", "minute_cos",
)
INDICATORS = (
    "macd", "macd_signal", "macd_diff", "bb_high", "bb_low", "bb_mid", "bb_width", "bb_position",
    "stoch_k", "stoch_d", "atr",
)


@dataclass(frozen=True)
class FeatureSpec:
    """Column roles of a feature table; names are declared, never guessed from prefixes."""

    features: tuple[str, ...]
    horizons: tuple[int, ...]

    @property
    def targets(self) -> tuple[str, ...]:
        return tuple(f"target_{h}" for h in self.horizons)

    def columns(self) -> list[str]:
        return [*KEYS, *OHLCV, *self.features, *self.targets]


def _lag_names(lags: Sequence[int]) -> list[str]:
    return [f"close_lag_{k}" for k in lags]


def simple_spec(horizons: Sequence[int] = SIMPLE_HORIZONS) -> FeatureSpec:
    rolled = rolling.rolling_names("close", SIMPLE_WINDOWS, ("ma", "std"))
    names = [*_lag_names(SIMPLE_LAGS), *rolled, "price_change_1", "price_change_5", "volume_ma_5", "volume_ratio"]
    return FeatureSpec(tuple(names), tuple(horizons))


def basic_spec(horizons: Sequence[int] = rolling.HORIZONS) -> FeatureSpec:
    names = [
        *_lag_names(rolling.LAGS),
        *rolling.rolling_names("close", BASIC_WINDOWS, BASIC_STATS),
        "rsi", *INDICATORS, "volume_sma", "volume_ratio", "price_change", "price_change_abs",
        "hl_spread", "oc_spread",
        *BASIC_CALENDAR,
    ]
    return FeatureSpec(tuple(names), tuple(horizons))


def enhanced_spec(horizons: Sequence[int] = rolling.HORIZONS) -> FeatureSpec:
    calendar = [*timeparts.CALENDAR_NAMES, *timeparts.CYCLIC_NAMES, *timeparts.FLAG_NAMES]
    names = [
        *_lag_names(rolling.LAGS),
        *rolling.rolling_names("close", rolling.WINDOWS, ENHANCED_STATS),
        "rsi", "rsi_14", "rsi_21", *INDICATORS, "williams_r", "cci", "volume_sma", "volume_ratio", "obv",
        "price_change", "price_change_abs", "log_return", "hl_spread", "oc_spread", "ho_spread", "lo_spread",
        *calendar,
    ]
    return FeatureSpec(tuple(names), tuple(horizons))


def priced(bars: DataFrame) -> DataFrame:
    """Bars without a close cannot enter an indicator; the quality report counts them."""
    return bars.where(present(F.col("close")))


def simple_features(bars: DataFrame, layout: Layout, horizons: Sequence[int] = SIMPLE_HORIZONS) -> DataFrame:
    spec = simple_spec(horizons)

    def build(df: DataFrame, w: WindowSpec) -> DataFrame:
        close = F.col("close")
        cols: dict[str, Column] = dict(rolling.lag_columns(w, "close", SIMPLE_LAGS))
        for n in SIMPLE_WINDOWS:
            cols[f"close_ma_{n}"] = rolling.full(w, n, close, F.avg(close))
            cols[f"close_std_{n}"] = rolling.full(w, n, close, F.stddev_samp(close))
        cols |= rolling.change_columns(w, "close", {"price_change_1": 1, "price_change_5": 5})
        cols |= technical.volume_columns(w, "volume_ma_5", SIMPLE_VOLUME_ROWS)
        cols |= rolling.target_columns(w, "close", spec.horizons)
        return df.withColumns(cols)

    wide = over_chunks(bars, layout, max(SIMPLE_WINDOWS), max(horizons, default=0), build, columns=[*KEYS, *OHLCV])
    return wide.select(*spec.columns())


def with_obv(bars: DataFrame, layout: Layout) -> DataFrame:
    """On-balance volume, and the row position that falls out of the same pass."""
    stepped = with_previous(bars, layout, "close", "_previous")
    totals = {"pos": F.lit(1), "obv": technical.signed_volume(F.col("_previous"))}
    return running_totals(stepped, layout, totals).drop("_previous").withColumn("pos", F.col("pos") - 1)


def with_rsi(bars: DataFrame, layout: Layout, periods: dict[str, int]) -> DataFrame:
    """Relative strength of priced bars, and ``pos``.

    While the close stands still both averages fade alike and the index keeps its value, however long that lasts. So it is
    computed where the close moves, where fading history is enough, and carried forward from there over any number of chunks.
    """
    def build(df: DataFrame, w: WindowSpec) -> DataFrame:
        return technical.with_rsi(df, w, periods)

    kept = [c for c in bars.columns if c != "pos"]
    moved = over_chunks(bars, layout, technical.HISTORY_ROWS, 0, build, columns=kept, keep_position=True)
    carried = carried_forward(materialized(moved, "rsi"), layout, list(periods))
    # before the first move there was no loss
    return carried.withColumns({k: technical.from_row(n - 1, F.coalesce(F.col(k), F.lit(100.0))) for k, n in periods.items()})


def technical_table(
    bars: DataFrame,
    layout: Layout,
    spec: FeatureSpec,
    windows: Sequence[int],
    stats: Sequence[str],
    rsi: dict[str, int],
) -> DataFrame:
    """Every column of a basic or enhanced table: one chunked pass over narrow rows."""
    wanted = set(spec.features)

    def build(df: DataFrame, w: WindowSpec) -> DataFrame:
        df = rolling.with_rolling(df, w, "close", windows, stats)
        df = technical.with_ranges(df, w)
        df = technical.with_stochastic(df, w)
        if "cci" in wanted:
            df = technical.with_cci(df, w)
        cols: dict[str, Column] = {
            **rolling.lag_columns(w),
            **technical.bollinger_columns(w),
            "williams_r": technical.williams_column(w),
            **technical.volume_columns(w, "volume_sma", technical.VOLUME_ROWS),
            **technical.return_columns(w),
            **rolling.target_columns(w, "close", spec.horizons),
        }
        return df.withColumns({k: c for k, c in cols.items() if k in wanted or k in spec.targets})

    before = max(technical.HISTORY_ROWS, *windows, *rolling.LAGS)
    inputs = [*KEYS, *OHLCV, *rsi]
    # the ticks are read once, for a table that the passes below share
    rows = materialized(priced(bars).select(*KEYS, *OHLCV), "bars")
    if "obv" in wanted:
        rows, inputs = with_obv(rows, layout), [*inputs, "obv"]
    rows = with_rsi(rows, layout, rsi)
    wide = over_chunks(rows, layout, before, max(spec.horizons, default=0), build, columns=inputs, heavy=True)
    ts = F.col("ts")
    scalars = {
        **technical.candle_columns(),
        **timeparts.calendar_columns(ts),
        **timeparts.cyclic_columns(ts),
        **timeparts.session_flags(ts),
    }
    return wide.withColumns({k: c for k, c in scalars.items() if k in wanted}).select(*spec.columns())


def basic_features(bars: DataFrame, layout: Layout, horizons: Sequence[int] = rolling.HORIZONS) -> DataFrame:
    return technical_table(bars, layout, basic_spec(horizons), BASIC_WINDOWS, BASIC_STATS, {"rsi": 14})


def enhanced_features(bars: DataFrame, layout: Layout, horizons: Sequence[int] = rolling.HORIZONS) -> DataFrame:
    rsi = {"rsi": 14, "rsi_14": 14, "rsi_21": 21}
    return technical_table(bars, layout, enhanced_spec(horizons), rolling.WINDOWS, ENHANCED_STATS, rsi)


def clean_rows(table: DataFrame, spec: FeatureSpec | None = None) -> DataFrame:
    """Rows with every feature and target present; NULL and NaN both count as missing."""
    return table.na.drop("any", subset=None if spec is None else [*spec.features, *spec.targets])


def reconcile(table: DataFrame, needed: Sequence[str], *, strict: bool = True) -> tuple[list[str], list[str]]:
    """Model features found in and missing from a table; missing ones raise when strict."""
    present = [c for c in needed if c in table.columns]
    missing = [c for c in needed if c not in table.columns]
    if missing and strict:
        raise ValueError(f"table lacks model features: {missing}")
    return present, missing
