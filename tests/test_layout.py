import numpy as np
import pandas as pd
import pytest
from conftest import collected, same, walk
from pyspark.sql import functions as F

from barloom.operators import layout, quality, sessions, splits
from barloom.operators.layout import Layout, attach, over_chunks, positions, running_totals, with_previous
from barloom.plans import features

SMALL = Layout(step_seconds=60, chunk_rows=64)


@pytest.fixture(scope="module")
def frame():
    hot = walk(1500, 1, "hot")
    hot = hot.drop(index=range(400, 470)).reset_index(drop=True)  # missing bars
    return pd.concat([hot, walk(300, 2, "cold"), walk(1, 3, "single")], ignore_index=True)


@pytest.fixture(scope="module")
def bars(spark, frame):
    return spark.createDataFrame(frame).persist()


def test_positions_count_rows_in_time_order(bars, frame):
    got = collected(positions(bars, SMALL))
    expected = frame.sort_values(["series", "ts"]).groupby("series").cumcount()
    assert (got.pos.values == expected.values).all()


def test_running_totals_match_cumulative_sum(bars, frame):
    got = collected(running_totals(bars, SMALL, {"total": F.col("volume")}))
    expected = frame.sort_values(["series", "ts"]).groupby("series").volume.cumsum()
    same(got.total, expected.values)


def test_previous_value_crosses_slots(bars, frame):
    got = collected(with_previous(bars, SMALL, "close", "prev"))
    expected = frame.sort_values(["series", "ts"]).groupby("series").close.shift(1)
    same(got.prev, expected.values)


@pytest.mark.parametrize("before,after", [(0, 0), (30, 0), (0, 20), (200, 90)])
def test_chunked_windows_equal_whole_series(bars, frame, before, after):
    def build(df, w):
        return df.withColumns(
            {
                "total": F.sum("close").over(w.rowsBetween(-before, after)),
                "n": F.count("close").over(w.rowsBetween(-before, after)),
            }
        )

    got = collected(over_chunks(bars, SMALL, before, after, build))
    parts = []
    for _, g in frame.sort_values(["series", "ts"]).groupby("series"):
        c = np.concatenate([[0], g.close.cumsum()])
        i = np.arange(len(g))
        lo, hi = np.maximum(i - before, 0), np.minimum(i + after + 1, len(g))
        parts.append(pd.DataFrame({"total": c[hi] - c[lo], "n": hi - lo}))
    expected = pd.concat(parts, ignore_index=True)
    assert len(got) == len(frame)
    same(got.total, expected.total)
    assert (got.n == expected.n).all()


def test_chunk_size_does_not_change_features(bars):
    spec = features.simple_spec()
    small, large = (collected(features.simple_features(bars, Layout(60, n))) for n in (64, 1_000_000))
    for c in (*spec.features, *spec.targets):
        same(small[c], large[c])


def test_future_rows_do_not_change_trailing_features(bars):
    cut = F.lit("2024-01-01 10:00:00").cast("timestamp")
    early = bars.where(F.col("ts") < cut)
    whole = collected(features.enhanced_features(bars, SMALL).where(F.col("ts") < cut))
    part = collected(features.enhanced_features(early, SMALL))
    for c in features.enhanced_spec().features:
        same(part[c], whole[c], 1e-7)


def test_attach_keeps_every_row(bars, frame):
    sizes = bars.groupBy("series").count()
    assert attach(bars, sizes).count() == len(frame)


def test_gap_report_finds_the_missing_stretch(bars):
    rows = quality.gap_report(bars, SMALL).collect()
    assert [(r.series, r.missing_bars) for r in rows] == [("hot", 70)]


def test_head_and_tail(bars, frame):
    assert splits.head(bars, 5, SMALL).groupBy("series").count().collect().__len__() == 3
    got = collected(splits.tail(bars, 10, SMALL).where("series = 'hot'"))
    expected = frame[frame.series == "hot"].tail(10)
    assert (got.ts.values == expected.ts.values.astype("datetime64[us]")).all()


def test_no_window_covers_a_whole_series(bars):
    plan = features.simple_features(bars, SMALL)._jdf.queryExecution().executedPlan().toString()
    main = [line for line in plan.splitlines() if "hashpartitioning(series#" in line and "close" in line]
    assert all("_chunk" in line or "_slot" in line for line in main)
    assert "Python" not in plan and "Pandas" not in plan


def test_function_over_rows_does_not_depend_on_chunks(spark):
    bars = pd.concat([walk(500, 1, "a"), walk(37, 2, "b")], ignore_index=True)

    def last_minus_next(chunk):
        return pd.DataFrame({"d": chunk.close.rolling(20).mean() - chunk.close.shift(-3), "n": chunk.pos + 1})

    expected = bars.sort_values(["series", "ts"], ignore_index=True)
    d = expected.groupby("series").close.transform(lambda c: c.rolling(20).mean() - c.shift(-3))
    for rows in (25, 64, 4096):
        got = collected(layout.map_rows(spark.createDataFrame(bars), layout.Layout(60, rows), 19, 3, last_minus_next, "d double, n bigint", columns=["series", "ts", "close"]))
        same(got.d, d)
        assert got.n.tolist() == (expected.groupby("series").cumcount() + 1).tolist()
    with pytest.raises(Exception, match="returned 1 rows"):
        layout.map_rows(spark.createDataFrame(bars), layout.Layout(60, 64), 1, 0, lambda c: c[["pos"]].head(1), "pos bigint").count()


@pytest.mark.parametrize("rows", [3, 4096])
def test_ends_of_series(spark, rows):
    bars = pd.concat([walk(50, 1, "a"), walk(4, 2, "b")], ignore_index=True)
    df = spark.createDataFrame(bars)
    for n in (1, 7, 60):
        assert collected(splits.tail(df, n, layout.Layout(60, rows))).equals(bars.groupby("series").tail(n).reset_index(drop=True))
        assert collected(splits.head(df, n, layout.Layout(60, rows))).equals(bars.groupby("series").head(n).reset_index(drop=True))


@pytest.mark.parametrize("rows", [2, 4096])
def test_sessions_end_at_gaps(spark, rows):
    seconds = [0, 10, 10, 40, 71, 300, 330, 1000]  # a gap of exactly 30 seconds still joins
    stamps = pd.Timestamp("2024-01-01") + pd.to_timedelta(seconds, unit="s")
    ticks = spark.createDataFrame(pd.DataFrame({"series": "a", "ts": stamps, "price": [float(s) for s in seconds], "volume": 1.0}))
    got = collected(sessions.sessions(ticks, 30, layout.Layout(1, rows)), ["series", "start_ts"])
    assert got.ticks.tolist() == [4, 1, 2, 1] and got.high.tolist() == [40.0, 71.0, 330.0, 1000.0]
    spark_own = ticks.groupBy("series", F.session_window("ts", "30 seconds")).agg(F.count("*").alias("n")).select("session_window.*", "n").orderBy("start").toPandas()
    assert spark_own.n.tolist() == got.ticks.tolist() and spark_own.end.tolist() == got.end_ts.tolist()
