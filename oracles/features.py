"""SQL for the feature families: plain frames and a row-by-row recursion for smoothed values."""

from __future__ import annotations

from oracles.base import BARS_1D, BARS_1H, BARS_1S, OHLCV, SUPPLIER_BARS, WITH_1H, shaped

LAGS = (1, 2, 3, 5, 10, 15, 30, 60)
WINDOWS = (5, 10, 15, 30, 60, 120, 240)
BASIC_WINDOWS = (5, 10, 15, 30, 60)
HORIZONS = tuple(range(1, 21))


def frame(n: int) -> str:
    return f"(PARTITION BY series ORDER BY ts ROWS BETWEEN {n - 1} PRECEDING AND CURRENT ROW)"


def full(n: int, stat: str, value: str) -> str:
    return f"CASE WHEN count({value}) OVER {frame(n)} = {n} THEN {stat} OVER {frame(n)} END"


W = "(PARTITION BY series ORDER BY ts)"

LAG = {f"close_lag_{k}": f"lag(close, {k}) OVER {W}" for k in LAGS}
TARGET = {f"target_{h}": f"lead(close, {h}) OVER {W}" for h in HORIZONS}


def rolled(windows: tuple[int, ...]) -> dict[str, str]:
    out = {}
    for n in windows:
        ma, std = full(n, "avg(close)", "close"), full(n, "stddev_samp(close)", "close")
        out |= {
            f"close_ma_{n}": ma,
            f"close_std_{n}": std,
            f"close_min_{n}": full(n, "min(close)", "close"),
            f"close_max_{n}": full(n, "max(close)", "close"),
            f"close_median_{n}": full(n, "median(close)", "close"),
            f"close_skew_{n}": full(n, "skewness(close)", "close"),
            f"close_kurt_{n}": full(n, "kurtosis(close)", "close"),
            f"close_rel_ma_{n}": f"close / {ma}",
            f"close_zscore_{n}": f"(close - {ma}) / {std}",
            f"close_range_{n}": f"{full(n, 'max(close)', 'close')} - {full(n, 'min(close)', 'close')}",
        }
    return out


ROLLED = rolled(WINDOWS)
VOLUME = {
    "volume_sma": full(20, "avg(volume)", "volume"),
    "volume_ratio": f"volume / nullif({full(20, 'avg(volume)', 'volume')}, 0)",
}
CHANGE = f"close / lag(close) OVER {W} - 1"
RETURN = {
    "price_change": CHANGE,
    "price_change_abs": f"abs({CHANGE})",
    "log_return": f"ln(close / lag(close) OVER {W})",
}
CHANGES = {"price_change_1": CHANGE, "price_change_5": f"close / lag(close, 5) OVER {W} - 1"}
CANDLE = {
    "hl_spread": "(high - low) / close",
    "oc_spread": "(close - open) / open",
    "ho_spread": "(high - open) / open",
    "lo_spread": "(low - open) / open",
}
CALENDAR = {
    "hour": "hour(ts)",
    "day_of_week": "isodow(ts) - 1",
    "day_of_month": "day(ts)",
    "month": "month(ts)",
    "quarter": "quarter(ts)",
    "minute": "minute(ts)",
}
CYCLIC = {
    f"{name}_{f}": f"{f}(2 * pi() * {part} / {period})"
    for name, part, period in (
        ("hour", "hour(ts)", 24),
        ("dow", "(isodow(ts) - 1)", 7),
        ("month", "month(ts)", 12),
        ("minute", "minute(ts)", 60),
    )
    for f in ("sin", "cos")
}
FLAGS = {
    "is_weekend": "isodow(ts) >= 6",
    "is_market_hours": "hour(ts) BETWEEN 9 AND 16",
    "is_overnight": "hour(ts) >= 22 OR hour(ts) <= 6",
}
MID, SIGMA = full(20, "avg(close)", "close"), full(20, "stddev_pop(close)", "close")
BOLLINGER = {
    "bb_high": f"{MID} + 2 * {SIGMA}",
    "bb_low": f"{MID} - 2 * {SIGMA}",
    "bb_mid": MID,
    "bb_width": f"4 * {SIGMA}",
    "bb_position": f"(close - ({MID} - 2 * {SIGMA})) / nullif(4 * {SIGMA}, 0)",
}
LOW, HIGH = full(14, "min(low)", "low"), full(14, "max(high)", "high")
STOCH_K = f"100 * (close - {LOW}) / nullif({HIGH} - {LOW}, 0)"
WILLIAMS = {"williams_r": f"-100 * ({HIGH} - close) / nullif({HIGH} - {LOW}, 0)"}

# Second-level tables: values that need another value first.
STAGES = f"""bars0 AS ({BARS_1H}),
bars1 AS (SELECT *, (high + low + close) / 3 AS tp, row_number() OVER {W} - 1 AS pos, lag(close) OVER {W} AS prev,
  {STOCH_K} AS stoch_k FROM bars0),
bars2 AS (SELECT *, greatest(high - low, abs(high - prev), abs(low - prev)) AS tr,
  {full(20, "avg(tp)", "tp")} AS tp_mean, list(tp) OVER {frame(20)} AS tps,
  {full(3, "avg(stoch_k)", "stoch_k")} AS stoch_d,
  CASE WHEN close < prev THEN -volume ELSE volume END AS signed FROM bars1),
bars AS (SELECT *, {full(14, "avg(tr)", "tr")} AS tr_mean,
  (tp - tp_mean) / nullif(0.015 * list_avg(list_transform(tps, lambda x: abs(x - tp_mean))), 0) AS cci,
  sum(signed) OVER {W} AS obv FROM bars2)"""

# One row at a time along each series.
SMOOTHED = """smoothed AS (
  SELECT series, ts, pos, close, close AS e9, close AS e12, close AS e26, NULL::DOUBLE AS signal,
    0.0::DOUBLE AS g14, 0.0::DOUBLE AS l14, 0.0::DOUBLE AS g21, 0.0::DOUBLE AS l21, 0.0::DOUBLE AS atr
  FROM bars WHERE pos = 0
  UNION ALL
  SELECT b.series, b.ts, b.pos, b.close,
    s.e9 + (b.close - s.e9) * 2 / 10, s.e12 + (b.close - s.e12) * 2 / 13, s.e26 + (b.close - s.e26) * 2 / 27,
    CASE WHEN b.pos = 25 THEN (s.e12 + (b.close - s.e12) * 2 / 13) - (s.e26 + (b.close - s.e26) * 2 / 27)
      WHEN b.pos > 25 THEN s.signal
        + ((s.e12 + (b.close - s.e12) * 2 / 13) - (s.e26 + (b.close - s.e26) * 2 / 27) - s.signal) / 5 END,
    s.g14 + (greatest(b.close - s.close, 0) - s.g14) / 14, s.l14 + (greatest(s.close - b.close, 0) - s.l14) / 14,
    s.g21 + (greatest(b.close - s.close, 0) - s.g21) / 21, s.l21 + (greatest(s.close - b.close, 0) - s.l21) / 21,
    CASE WHEN b.pos = 13 THEN b.tr_mean WHEN b.pos > 13 THEN (s.atr * 13 + b.tr) / 14 ELSE 0 END
  FROM smoothed s JOIN bars b ON b.series = s.series AND b.pos = s.pos + 1)"""

WITH_STAGES = f"WITH RECURSIVE {STAGES}, {SMOOTHED}"


def rsi(n: int) -> str:
    return f"CASE WHEN pos >= {n - 1} THEN CASE WHEN l{n} = 0 THEN 100 ELSE 100 - 100 / (1 + g{n} / l{n}) END END"


RSI = {"rsi_14": rsi(14), "rsi_21": rsi(21)}
MACD = {
    "macd": "CASE WHEN pos >= 25 THEN e12 - e26 END",
    "macd_signal": "CASE WHEN pos >= 33 THEN signal END",
    "macd_diff": "CASE WHEN pos >= 33 THEN e12 - e26 - signal END",
}
EMA = {f"ema_{n}": f"e{n}" for n in (9, 12, 26)}
STOCHASTIC = {"stoch_k": "stoch_k", "stoch_d": "stoch_d"}


def picked(cols: dict[str, str]) -> str:
    return ", ".join(f"{sql} AS {name}" for name, sql in cols.items())


def select(cols: dict[str, str], with_: str = WITH_1H, source: str = "bars", digits: int = 6) -> str:
    return shaped(f"{with_} SELECT series, ts, {picked(cols)} FROM {source}", " ".join(cols), digits=digits)


def whole(cols: dict[str, str]) -> str:
    return shaped(f"{WITH_1H} SELECT series, ts, {picked(cols)} FROM bars", "", " ".join(cols))


# Prices that move on two days in thirty.
FLAT_1S = f"""SELECT * REPLACE (CASE WHEN epoch(ts)::BIGINT % 2592000 < 172800 THEN close ELSE 100.0 END AS close) FROM ({BARS_1S})"""


def stats(*names: str) -> dict[str, str]:
    return {f"close_{s}_{n}": ROLLED[f"close_{s}_{n}"] for n in WINDOWS for s in names}


SECOND = {**stats("ma", "std", "median")}
SECOND = {k: v for k, v in SECOND.items() if k.rsplit("_", 1)[1] in ("5", "60", "240")} | {"cci": "CASE WHEN tp_mean IS NOT NULL THEN cci END"}
SECOND_INDICATORS = shaped(
    f"""WITH RECURSIVE {STAGES.replace(BARS_1H, BARS_1S)}, {SMOOTHED},
framed AS (SELECT series, ts, {picked(SECOND)} FROM bars),
smooth AS (SELECT series, ts, {picked({**MACD, "atr": "atr"})} FROM smoothed)
SELECT * FROM framed JOIN smooth USING (series, ts)""",
    " ".join([*SECOND, *MACD, "atr"]),
)


SIMPLE = {
    **{f"close_lag_{k}": LAG[f"close_lag_{k}"] for k in (1, 2, 5, 10)},
    **{f"close_{s}_{n}": rolled((5, 20))[f"close_{s}_{n}"] for n in (5, 20) for s in ("ma", "std")},
    **CHANGES,
    "volume_ma_5": full(5, "avg(volume)", "volume"),
    "volume_ratio": f"volume / nullif({full(5, 'avg(volume)', 'volume')}, 0)",
}
SIMPLE_HORIZONS = (1, 2, 5, 10, 20)
SIMPLE_TARGET = {f"target_{h}": TARGET[f"target_{h}"] for h in SIMPLE_HORIZONS}


def simple_table(bars: str) -> str:
    return f"SELECT *, {picked({**SIMPLE, **SIMPLE_TARGET})} FROM ({bars})"


def clean_table(bars: str) -> str:
    present = " AND ".join(f"{c} IS NOT NULL" for c in (*SIMPLE, *SIMPLE_TARGET))
    return f"SELECT * FROM ({simple_table(bars)}) WHERE {present}"


LEVEL1 = {**LAG, **BOLLINGER, **VOLUME, **RETURN, **TARGET}
INTS = [*CALENDAR, *FLAGS]


def complete(windows: tuple[int, ...], keep: list[str]) -> str:
    """All columns of a feature set: frames over the bars beside the recursive values."""
    level1 = {**LEVEL1, **rolled(windows), **CANDLE, **CALENDAR, **CYCLIC, **FLAGS, **WILLIAMS}
    framed = f"SELECT *, {picked({k: v for k, v in level1.items() if k in keep})} FROM bars"
    recursive = {**MACD, **RSI, "rsi": rsi(14), "atr": "atr"}
    smooth = f"SELECT series, ts, {picked(recursive)} FROM smoothed"
    names = ["open", "high", "low", "close", "volume", *keep]
    doubles = [c for c in names if c not in INTS]
    sql = f"{WITH_STAGES}, framed AS ({framed}), smooth AS ({smooth}) SELECT series, ts, {', '.join(names)} FROM framed JOIN smooth USING (series, ts)"
    return shaped(sql, " ".join(doubles), " ".join(c for c in names if c in INTS), 7)


BASIC = [
    *LAG,
    *[f"close_{s}_{n}" for n in BASIC_WINDOWS for s in ("ma", "std", "min", "max", "rel_ma")],
    "rsi", *MACD, *BOLLINGER, *STOCHASTIC, "atr", *VOLUME, "price_change", "price_change_abs", "hl_spread", "oc_spread",
    "hour", "hour_sin", "hour_cos", "day_of_week", "dow_sin", "dow_cos", "minute", "minute_sin", "minute_cos",
    *TARGET,
]
ENHANCED = [
    *LAG, *ROLLED, "rsi", *RSI, *MACD, *BOLLINGER, *STOCHASTIC, "atr", *WILLIAMS, "cci", *VOLUME, "obv", *RETURN,
    *CANDLE, *CALENDAR, *CYCLIC, *FLAGS, *TARGET,
]

def persistence(bars: str) -> str:
    return shaped(
        f"""WITH clean AS ({clean_table(bars)}),
long AS (SELECT series, close AS prediction, unnest([{", ".join(map(str, SIMPLE_HORIZONS))}]) AS horizon,
  unnest([{", ".join(SIMPLE_TARGET)}]) AS actual FROM clean)
SELECT series, horizon, sqrt(avg((actual - prediction) ** 2)) AS rmse, avg(abs(actual - prediction)) AS mae,
  avg(abs((actual - prediction) / actual)) * 100 AS mape FROM long GROUP BY series, horizon""",
        "rmse mae mape",
        "horizon"
    )


ORACLES = {
    "persistence_metrics": persistence(BARS_1D),
    "supplier_metrics": persistence(SUPPLIER_BARS),
    "second_features": shaped(simple_table(BARS_1S), " ".join([OHLCV, *SIMPLE, *SIMPLE_TARGET])),
    "simple_features": shaped(simple_table(BARS_1H), " ".join([OHLCV, *SIMPLE, *SIMPLE_TARGET])),
    "clean_rows": f"""SELECT series, count(*) AS rows, min(ts) AS first_ts, max(ts) AS last_ts
FROM ({clean_table(BARS_1D)}) GROUP BY series""",
    "feature_columns": select({k: SIMPLE[k] for k in list(SIMPLE)[:8]}),
    "targets": select(TARGET),
    "lag_features": select(LAG),
    "rolling_mean_std": select(stats("ma", "std"), digits=7),
    "rolling_min_max_range": select(stats("min", "max", "range"), digits=7),
    "rolling_median": select(stats("median"), digits=7),
    "rolling_skew_kurt": select(stats("skew", "kurt"), digits=7),
    "rolling_rel_zscore": select(stats("rel_ma", "zscore"), digits=7),
    "volume_features": select(VOLUME),
    "mapped_rows": shaped(
        f"""{WITH_1H}, n AS (SELECT series, ts, close, row_number() OVER {W} AS pos FROM bars WHERE close IS NOT NULL)
SELECT series, ts, CASE WHEN count(*) OVER w = 60 THEN regr_slope(close, pos) OVER w END AS slope
FROM n WINDOW w AS (PARTITION BY series ORDER BY ts ROWS BETWEEN 59 PRECEDING AND CURRENT ROW)""",
        "slope",
    ),
    "returns": select({**RETURN, **CHANGES}),
    "candle_shape": select(CANDLE),
    "calendar_features": whole(CALENDAR),
    "cyclic_features": select(CYCLIC),
    "session_flags": whole(FLAGS),
    "bollinger": select(BOLLINGER),
    "stochastic": select(STOCHASTIC, f"WITH {STAGES}"),
    "williams_r": select(WILLIAMS),
    "cci": select({"cci": "CASE WHEN tp_mean IS NOT NULL THEN cci END"}, f"WITH {STAGES}"),
    "obv": select({"obv": "obv"}, f"WITH {STAGES}"),
    "ema": select(EMA, WITH_STAGES, "smoothed"),
    "rsi": select(RSI, WITH_STAGES, "smoothed"),
    "rsi_flat_runs": select(RSI, f"WITH RECURSIVE {STAGES.replace(BARS_1H, FLAT_1S)}, {SMOOTHED}", "smoothed"),
    "second_indicators": SECOND_INDICATORS,
    "macd": select(MACD, WITH_STAGES, "smoothed"),
    "atr": select({"atr": "atr"}, WITH_STAGES, "smoothed"),
    "basic_features": complete(BASIC_WINDOWS, BASIC),
    "enhanced_features": complete(WINDOWS, ENHANCED),
}
