import numpy as np
import pandas as pd
import pytest
from conftest import collected, same, walk
from pyspark.sql import functions as F

from barloom.operators import rolling
from barloom.operators.layout import Layout, over_chunks
from barloom.plans import features

LAYOUT = Layout(60, 512)
N = 1400


@pytest.fixture(scope="module")
def frame():
    f = walk(N, 7)
    f.loc[600:900, ["open", "high", "low", "close"]] = 77.0  # constant frames
    f.loc[300:330, "volume"] = 0.0
    return f


@pytest.fixture(scope="module")
def out(spark, frame):
    return collected(features.enhanced_features(spark.createDataFrame(frame), LAYOUT))


def test_feature_counts():
    assert len(features.simple_spec().features) == 12
    assert len(features.basic_spec().features) == 60
    assert len(features.enhanced_spec().features) == 121
    assert len(features.enhanced_spec().columns()) == 2 + 5 + 121 + 20


@pytest.mark.parametrize("n", rolling.WINDOWS)
def test_rolling_statistics(out, frame, n):
    r = frame.close.rolling(n)
    same(out[f"close_ma_{n}"], r.mean())
    same(out[f"close_std_{n}"], r.std(), 1e-6)
    same(out[f"close_min_{n}"], r.min())
    same(out[f"close_max_{n}"], r.max())
    same(out[f"close_median_{n}"], r.median())
    exact = frame.close.rolling(n).apply(lambda x: pd.Series(x).skew(), raw=True)
    same(out[f"close_skew_{n}"], exact, 1e-6)
    exact = frame.close.rolling(n).apply(lambda x: pd.Series(x).kurt() if x.min() < x.max() else -3.0, raw=True)
    same(out[f"close_kurt_{n}"], exact, 1e-6)
    flat = r.min() == r.max()
    assert out.loc[flat, f"close_zscore_{n}"].isna().all()
    same(out[f"close_range_{n}"], r.max() - r.min())


def test_smoothed_indicators(out, frame):
    c = frame.close
    fast = c.ewm(span=12, min_periods=12, adjust=False).mean()
    slow = c.ewm(span=26, min_periods=26, adjust=False).mean()
    macd = fast - slow
    signal = macd.ewm(span=9, min_periods=9, adjust=False).mean()
    same(out.macd, macd)
    same(out.macd_signal, signal)
    same(out.macd_diff, macd - signal)
    d = c.diff()
    up, down = d.where(d > 0, 0.0), -d.where(d < 0, 0.0)
    for n in (14, 21):
        g, s = (x.ewm(alpha=1 / n, min_periods=n, adjust=False).mean() for x in (up, down))
        same(out[f"rsi_{n}"], (100 - 100 / (1 + g / s)).where(s != 0, 100).where(g.notna()))
    before = c.shift(1)
    tr = pd.concat([frame.high - frame.low, (frame.high - before).abs(), (frame.low - before).abs()], axis=1).max(axis=1)
    atr = np.zeros(N)
    atr[13] = tr[:14].mean()
    for i in range(14, N):
        atr[i] = (atr[i - 1] * 13 + tr[i]) / 14
    same(out.atr, atr)


def test_window_indicators(out, frame):
    tp = (frame.high + frame.low + frame.close) / 3
    dev = tp.rolling(20).apply(lambda x: np.abs(x - x.mean()).mean(), raw=True)
    moving = dev > 1e-9
    same(out.cci[moving], ((tp - tp.rolling(20).mean()) / (0.015 * dev))[moving], 1e-6)
    lo, hi = frame.low.rolling(14).min(), frame.high.rolling(14).max()
    width = (hi - lo).where(hi > lo)
    k = 100 * (frame.close - lo) / width
    same(out.stoch_k, k)
    same(out.stoch_d, k.rolling(3).mean())
    same(out.williams_r, -100 * (hi - frame.close) / width)
    same(out.obv, np.where(frame.close < frame.close.shift(1), -frame.volume, frame.volume).cumsum())
    v = frame.volume.rolling(20).mean()
    same(out.volume_ratio, (frame.volume / v.where(v != 0)))
    same(out.bb_mid + 2 * frame.close.rolling(20).std(ddof=0), out.bb_high, 1e-6)


def test_incomplete_frames_and_missing_closes(spark):
    f = walk(60, 3)
    f.loc[20, "close"] = np.nan
    bars = spark.createDataFrame(f).withColumn("close", F.nanvl("close", F.lit(None).cast("double")))
    got = collected(
        over_chunks(bars, LAYOUT, 60, 0, lambda d, w: rolling.with_rolling(d, w, "close", (5, 10, 60), ("ma", "median", "min")))
    )
    for n in (5, 10, 60):
        same(got[f"close_ma_{n}"], f.close.rolling(n).mean())
        same(got[f"close_median_{n}"], f.close.rolling(n).median())
        same(got[f"close_min_{n}"], f.close.rolling(n).min())


def test_single_row_and_zero_open(spark):
    f = walk(1, 1)
    f["open"] = 0.0
    row = features.enhanced_features(spark.createDataFrame(f), LAYOUT).first()
    assert row.oc_spread is None and row.close_ma_5 is None and row.target_1 is None
    assert row.obv == f.volume[0] and row.atr == 0.0


def test_missing_bars_are_not_filled(spark):
    f = walk(50, 2).drop(index=[20, 21, 22]).reset_index(drop=True)
    got = collected(features.simple_features(spark.createDataFrame(f), LAYOUT))
    same(got.close_lag_5, f.close.shift(5))
    same(got.target_10, f.close.shift(-10))


def test_clean_rows_of_ten_thousand_bars(spark):
    spec = features.simple_spec()
    table = features.clean_rows(features.simple_features(spark.createDataFrame(walk(10_000, 5)), Layout(60, 4096)), spec)
    from barloom.operators.splits import positional_split

    parts = {r.part: r["count"] for r in positional_split(table, LAYOUT).groupBy("part").count().collect()}
    assert parts == {"train": 7968, "test": 1993}


def test_reconcile_reports_missing_features(spark):
    table = spark.createDataFrame(walk(3))
    assert features.reconcile(table, ["open", "rsi"], strict=False) == (["open"], ["rsi"])
    with pytest.raises(ValueError, match="rsi"):
        features.reconcile(table, ["open", "rsi"])


def test_rsi_keeps_its_value_while_the_price_stands(spark):
    """200 moving bars, 4 000 flat ones, 50 moving ones, and one close that is not a number."""
    f = walk(4250, 3)
    f.loc[200:4199, "close"] = f.close[199]
    f.loc[100, "close"] = float("nan")
    bars = features.priced(spark.createDataFrame(f)).select("series", "ts", "close")
    got = collected(features.with_rsi(bars, Layout(60, 64), {"rsi_14": 14, "rsi_21": 21}))
    close = f.close.drop(100).reset_index(drop=True)
    for n in (14, 21):
        gain = loss = 0.0
        want = []
        for k, d in enumerate(close.diff().fillna(0.0)):
            gain, loss = gain + (max(d, 0) - gain) / n, loss + (max(-d, 0) - loss) / n
            want.append(np.nan if k < n - 1 else 100.0 if loss == 0 else 100 - 100 / (1 + gain / loss))
        same(got[f"rsi_{n}"], want, 1e-7)


def test_a_close_that_is_not_a_number_is_missing(spark):
    f = walk(700, 4)
    f.loc[300, "close"] = float("nan")
    got = collected(features.basic_features(spark.createDataFrame(f), Layout(60, 64)))
    want = collected(features.basic_features(spark.createDataFrame(f.drop(300)), Layout(60, 64)))
    for c in ("rsi", "macd", "macd_signal", "atr", "close_ma_60"):
        same(got[c], want[c])


@pytest.mark.parametrize("name", ["bars_1d", "bars_1h"])
def test_bars_aggregate_by_hashing(spark, name):
    import __spark_entry__ as entry

    plan = entry.queries()[name](spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    assert "SortAggregate" not in plan and plan.count("HashAggregate") == 2
