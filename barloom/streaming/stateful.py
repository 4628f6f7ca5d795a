"""Row-based features on a stream: Spark rejects lag and ROWS frames there, so each series
keeps its last bars as state. The state is bounded by the longest window, not by the series.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import types as T

# executors need not have this package installed
cloudpickle.register_pickle_by_value(sys.modules[__name__])

# The simple feature set.
LAGS, WINDOWS, CHANGES, VOLUME_ROWS = (1, 2, 5, 10), (5, 20), (1, 5), 5
KEPT = 20

VALUES = ("open", "high", "low", "close", "volume")
NAMES = (
    *[f"close_lag_{k}" for k in LAGS],
    *[f"close_{s}_{n}" for n in WINDOWS for s in ("ma", "std")],
    *[f"price_change_{k}" for k in CHANGES],
    "volume_ma_5",
    "volume_ratio",
)
STATE = "bars array<struct<ts:timestamp,close:double,volume:double>>"
OUTPUT = T.StructType(
    [T.StructField("series", T.StringType()), T.StructField("ts", T.TimestampType())]
    + [T.StructField(c, T.DoubleType()) for c in (*VALUES, *NAMES)]
    + [T.StructField("late", T.BooleanType())]
)


def simple_columns(close: pd.Series, volume: pd.Series) -> pd.DataFrame:
    """The simple feature set of consecutive bars, positional like its batch twin."""
    out: dict[str, pd.Series] = {f"close_lag_{k}": close.shift(k) for k in LAGS}
    for n in WINDOWS:
        out[f"close_ma_{n}"] = close.rolling(n).mean()
        out[f"close_std_{n}"] = close.rolling(n).std()
    for k in CHANGES:
        base = close.shift(k)
        out[f"price_change_{k}"] = close / base.where(base != 0) - 1
    out["volume_ma_5"] = volume.rolling(VOLUME_ROWS).mean()
    out["volume_ratio"] = volume / out["volume_ma_5"].where(out["volume_ma_5"] != 0)
    return pd.DataFrame(out)


def extend(key: tuple, batches: Iterator[pd.DataFrame], state) -> Iterator[pd.DataFrame]:
    """Features of the new bars of one series, from them and the bars kept from before.

    Holds the bars one micro-batch brings for one series: at most one per time step.
    """
    columns = ["ts", "close", "volume"]
    new = pd.concat(list(batches), ignore_index=True).sort_values("ts", ignore_index=True)
    history = new[columns]
    known = 0
    if state.exists:
        kept = pd.DataFrame([tuple(bar) for bar in state.get[0]], columns=columns)
        kept["ts"] = pd.to_datetime(kept["ts"])
        # a bar at or before the last one seen came too late for features; it is handed on as it is, marked
        late = new["ts"] <= kept["ts"].iloc[-1]
        if late.any():
            yield new.loc[late, ["series", "ts", *VALUES]].assign(**dict.fromkeys(NAMES, float("nan")), late=True)[OUTPUT.names]
        new = new[~late].reset_index(drop=True)
        if new.empty:
            return
        known, history = len(kept), pd.concat([kept, new[columns]], ignore_index=True)
    features = simple_columns(history["close"].astype(float), history["volume"].astype(float))
    tail = history.iloc[-KEPT:]
    state.update(([(t.to_pydatetime(), c, v) for t, c, v in tail.itertuples(index=False)],))
    yield pd.concat([new[["series", "ts", *VALUES]], features.iloc[known:].reset_index(drop=True)], axis=1).assign(late=False)


def simple_features(bars: DataFrame) -> DataFrame:
    """Simple features of a bar stream, one row per bar in time order per series.

    Bars that arrive after a later one of their series are marked ``late`` and have no features: count or store them apart.
    """
    ordered = bars.select("series", "ts", *VALUES)
    return ordered.groupBy("series").applyInPandasWithState(extend, OUTPUT, STATE, "append", "NoTimeout")
