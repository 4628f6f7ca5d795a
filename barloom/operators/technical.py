"""Technical indicators over priced bars, following their published definitions.

Each function adds columns inside one ``layout.over_chunks`` pass. Division by zero gives NULL.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, WindowSpec
from pyspark.sql import functions as F

from barloom.operators.layout import BLOCK
from barloom.operators.recurrence import Smooth, memory_rows, with_smoothed
from barloom.operators.rolling import full, trailing

# Indicator periods.
RSI_PERIODS = (14, 21)
MACD_FAST, MACD_SLOW, MACD_SIGNAL = 12, 26, 9
BOLLINGER_ROWS, BOLLINGER_WIDTH = 20, 2.0
STOCHASTIC_ROWS, STOCHASTIC_SMOOTH = 14, 3
ATR_ROWS = 14
WILLIAMS_ROWS = 14
CCI_ROWS, CCI_SCALE = 20, 0.015
VOLUME_ROWS = 20


def span_alpha(span: int) -> float:
    return 2.0 / (span + 1)


# Rows of history after which every indicator below no longer depends on earlier bars.
HISTORY_ROWS = BLOCK + max(
    memory_rows(span_alpha(MACD_SLOW)) + memory_rows(span_alpha(MACD_SIGNAL)),
    memory_rows(1.0 / max(RSI_PERIODS)),
    memory_rows(1.0 / ATR_ROWS),
)


def from_row(first: int, value: Column) -> Column:
    return F.when(F.col("pos") >= first, value)


@dataclass(frozen=True)
class Smoothed:
    """An indicator that needs smoothing: columns before it, what to smooth, columns after it.

    Indicators that are computed together share the window passes of one smoothing step.
    """

    inputs: dict[str, Column]
    specs: list[Smooth]
    outputs: dict[str, Column]


def with_smoothed_indicators(df: DataFrame, w: WindowSpec, parts: Sequence[Smoothed]) -> DataFrame:
    inputs = {k: c for p in parts for k, c in p.inputs.items()}
    specs = [s for p in parts for s in p.specs]
    df = df.withColumns(inputs) if inputs else df
    df = with_smoothed(df, w, specs)
    df = df.withColumns({k: c for p in parts for k, c in p.outputs.items()})
    return df.drop(*inputs, *[s.name for s in specs])


def rsi(w: WindowSpec, periods: dict[str, int]) -> Smoothed:
    """Relative strength index of the bars whose close moved; NULL where it stands still (see ``features.with_rsi``).

    The first bar counts as no change.
    """
    change = F.coalesce(F.col("close") - F.lag("close").over(w), F.lit(0.0))
    lengths = sorted(set(periods.values()))

    def index(n: int) -> Column:
        gain, loss = F.col(f"_gain_{n}"), F.col(f"_loss_{n}")
        value = F.when(loss == 0, F.lit(100.0)).otherwise(100 - 100 / (1 + F.try_divide(gain, loss)))
        return F.when((F.col("_gain") > 0) | (F.col("_loss") > 0), value)

    return Smoothed(
        {"_gain": F.greatest(change, F.lit(0.0)), "_loss": F.greatest(-change, F.lit(0.0))},
        [Smooth(f"_{side}_{n}", F.col(f"_{side}"), 1.0 / n) for n in lengths for side in ("gain", "loss")],
        {name: index(n) for name, n in periods.items()},
    )


def macd() -> Smoothed:
    close = F.col("close")
    specs = [Smooth("_fast", close, span_alpha(MACD_FAST)), Smooth("_slow", close, span_alpha(MACD_SLOW))]
    return Smoothed({}, specs, {"macd": from_row(MACD_SLOW - 1, F.col("_fast") - F.col("_slow"))})


def macd_signal() -> Smoothed:
    """Signal line over ``macd``: a second smoothing step."""
    signal = from_row(MACD_SLOW + MACD_SIGNAL - 2, F.col("_signal"))
    specs = [Smooth("_signal", F.col("macd"), span_alpha(MACD_SIGNAL), start=MACD_SLOW - 1)]
    return Smoothed({}, specs, {"macd_signal": signal, "macd_diff": F.col("macd") - signal})


def true_range(w: WindowSpec) -> Column:
    before = F.lag("close").over(w)
    return F.greatest(F.col("high") - F.col("low"), F.abs(F.col("high") - before), F.abs(F.col("low") - before))


def atr(w: WindowSpec) -> Smoothed:
    """Average true range over ``_range``: mean of the first 14, then Wilder smoothing; 0 before that."""
    first = ATR_ROWS - 1
    # the mean range of the first rows seeds the recurrence, later rows enter as they are
    seed = F.avg("_range").over(trailing(w, ATR_ROWS))
    value = F.when(F.col("pos") == first, F.col("_seed")).otherwise(F.col("_range"))
    return Smoothed(
        {"_seed": seed},
        [Smooth("_atr", value, 1.0 / ATR_ROWS, start=first)],
        {"atr": F.coalesce(F.col("_atr"), F.lit(0.0))},
    )


def with_rsi(df: DataFrame, w: WindowSpec, periods: dict[str, int]) -> DataFrame:
    return with_smoothed_indicators(df, w, [rsi(w, periods)])


def with_macd(df: DataFrame, w: WindowSpec) -> DataFrame:
    return with_smoothed_indicators(with_smoothed_indicators(df, w, [macd()]), w, [macd_signal()])


def with_atr(df: DataFrame, w: WindowSpec) -> DataFrame:
    return with_smoothed_indicators(df.withColumn("_range", true_range(w)), w, [atr(w)]).drop("_range")


def with_ranges(df: DataFrame, w: WindowSpec) -> DataFrame:
    """MACD and ATR in two smoothing steps."""
    ranged = df.withColumn("_range", true_range(w))
    df = with_smoothed_indicators(ranged, w, [macd(), atr(w)]).drop("_range")
    return with_smoothed_indicators(df, w, [macd_signal()])


def bollinger_columns(w: WindowSpec) -> dict[str, Column]:
    close = F.col("close")
    mid = full(w, BOLLINGER_ROWS, close, F.avg(close))
    spread = full(w, BOLLINGER_ROWS, close, F.stddev_pop(close)) * BOLLINGER_WIDTH
    high, low = mid + spread, mid - spread
    return {
        "bb_high": high,
        "bb_low": low,
        "bb_mid": mid,
        "bb_width": high - low,
        "bb_position": F.try_divide(close - low, high - low),
    }


def _extremes(w: WindowSpec, rows: int) -> tuple[Column, Column]:
    low = full(w, rows, F.col("low"), F.min("low"))
    high = full(w, rows, F.col("high"), F.max("high"))
    return low, high


def with_stochastic(df: DataFrame, w: WindowSpec) -> DataFrame:
    low, high = _extremes(w, STOCHASTIC_ROWS)
    df = df.withColumn("stoch_k", F.try_divide(F.col("close") - low, high - low) * 100)
    k = F.col("stoch_k")
    return df.withColumn("stoch_d", full(w, STOCHASTIC_SMOOTH, k, F.avg(k)))


def williams_column(w: WindowSpec) -> Column:
    low, high = _extremes(w, WILLIAMS_ROWS)
    return F.try_divide(high - F.col("close"), high - low) * -100


def with_cci(df: DataFrame, w: WindowSpec) -> DataFrame:
    """Commodity channel index; the deviation is taken around each frame's own mean."""
    df = df.withColumn("_typical", (F.col("high") + F.col("low") + F.col("close")) / 3)
    typical = F.col("_typical")
    df = df.withColumns(
        {
            "_mean": full(w, CCI_ROWS, typical, F.avg(typical)),
            "_frame": F.collect_list(typical).over(trailing(w, CCI_ROWS)),
        }
    )
    deviation = F.aggregate("_frame", F.lit(0.0), lambda acc, v: acc + F.abs(v - F.col("_mean"))) / CCI_ROWS
    return df.withColumn(
        "cci", F.try_divide(typical - F.col("_mean"), deviation * CCI_SCALE)
    ).drop("_typical", "_mean", "_frame")


def volume_columns(w: WindowSpec, name: str, rows: int) -> dict[str, Column]:
    volume = F.col("volume")
    average = full(w, rows, volume, F.avg(volume))
    return {name: average, "volume_ratio": F.try_divide(volume, average)}


def return_columns(w: WindowSpec) -> dict[str, Column]:
    ratio = F.try_divide(F.col("close"), F.lag("close").over(w))
    return {"price_change": ratio - 1, "price_change_abs": F.abs(ratio - 1), "log_return": F.ln(ratio)}


def candle_columns() -> dict[str, Column]:
    o, h, low, c = (F.col(x) for x in ("open", "high", "low", "close"))
    return {
        "hl_spread": F.try_divide(h - low, c),
        "oc_spread": F.try_divide(c - o, o),
        "ho_spread": F.try_divide(h - o, o),
        "lo_spread": F.try_divide(low - o, o),
    }


def signed_volume(previous: Column) -> Column:
    """Volume counted down when the close fell, up otherwise; its running sum is OBV."""
    return F.when(F.col("close") < previous, -F.col("volume")).otherwise(F.col("volume"))
