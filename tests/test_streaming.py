import json

import pandas as pd
import pytest
from conftest import collected, same, walk
from pyspark.sql import functions as F

from barloom.operators.layout import Layout
from barloom.plans import features, live, models
from barloom.streaming import features as live_features
from barloom.streaming import intake, scoring, stateful

LAYOUT = Layout(60, 4096)
TICK = "series string, ts timestamp, price double, volume double, id bigint"


def delivered(spark, folder, parts):
    for p in parts:
        spark.createDataFrame(p).coalesce(1).write.mode("append").parquet(str(folder))
    return intake.read_files(spark, str(folder), spark.createDataFrame(parts[0]).schema, name="*.parquet", max_files=1)


def test_features_across_batches_equal_the_batch_job(spark, tmp_path):
    whole = pd.concat([walk(90, 1, "a"), walk(70, 2, "b")], ignore_index=True)
    edges = [pd.Timestamp("2024-01-01 00:07"), pd.Timestamp("2024-01-01 00:50"), pd.Timestamp("2024-01-02")]
    parts, since = [], whole.ts.min()
    for until in edges:
        parts.append(whole[(whole.ts >= since) & (whole.ts < until)].sample(frac=1, random_state=3))
        since = until
    got = collected(intake.drain(stateful.simple_features(delivered(spark, tmp_path / "in", parts)), "f"))
    expected = collected(features.simple_features(spark.createDataFrame(whole), LAYOUT, ()))
    assert len(got) == len(whole)
    for c in features.simple_spec(()).features:
        same(got[c], expected[c])


def test_late_bar_is_handed_on_without_features(spark, tmp_path):
    whole = walk(30)
    late = whole.iloc[[2]].assign(close=1.0)
    parts = [whole.iloc[:20].drop(index=2), late, whole.iloc[20:]]
    got = collected(intake.drain(stateful.simple_features(delivered(spark, tmp_path / "in", parts)), "late"))
    assert len(got) == 30 and set(got[got.late].close) == {1.0} and got[got.late].close_ma_5.isna().all()


def test_watermark_closes_bars_and_counts_late_ticks(spark, tmp_path):
    # a batch drops what was late for the batch before it, so the late tick comes two batches on
    def ticks(*rows):
        return spark.createDataFrame([("a", pd.Timestamp(f"2024-01-01 {t}").to_pydatetime(), p, 1.0, i) for i, (t, p) in enumerate(rows)], TICK)

    folder = str(tmp_path / "ticks")
    for part in (ticks(("00:00:10", 5.0), ("00:00:50", 7.0)), ticks(("00:30:00", 9.0)), ticks(("00:35:00", 4.0)),
                 ticks(("00:00:20", 99.0), ("01:00:00", 8.0))):
        part.coalesce(1).write.mode("append").parquet(folder)
    stream = intake.read_files(spark, folder, spark.createDataFrame([], TICK).schema, name="*.parquet", max_files=1)
    query = (
        intake.bars(stream, "1 minute", ["ts", "id"]).writeStream.format("parquet").option("path", str(tmp_path / "out"))
        .option("checkpointLocation", str(tmp_path / "cp")).trigger(availableNow=True).start()
    )
    query.awaitTermination()
    got = collected(spark.read.parquet(str(tmp_path / "out")))
    assert got[["open", "high", "close"]].values.tolist() == [[5.0, 7.0, 7.0], [9.0, 9.0, 9.0], [4.0, 4.0, 4.0]]
    assert scoring.late_rows(query) == 1


@pytest.fixture(scope="module")
def model(spark):
    spec = features.FeatureSpec(features.simple_spec().features, (1, 5))
    rows = features.clean_rows(features.simple_features(spark.createDataFrame(walk(400, 3)), LAYOUT), features.simple_spec())
    return models.fit(rows, spec, "random_forest", {"numTrees": 4, "maxDepth": 3, "seed": 1})


def test_scoring_twice_writes_once(spark, model, tmp_path):
    rows = features.simple_features(spark.createDataFrame(pd.concat([walk(60, 5, "a"), walk(60, 6, "b")])), LAYOUT, ())
    rows.write.parquet(str(tmp_path / "rows"))
    for attempt in ("one", "two"):  # a lost checkpoint replays the batch
        stream = intake.read_files(spark, str(tmp_path / "rows"), rows.schema, name="*.parquet")
        scoring.score_stream(stream, model, str(tmp_path / "out"), str(tmp_path / attempt)).awaitTermination()
    docs = collected(scoring.read_scores(spark, str(tmp_path / "out")))
    assert docs.series.tolist() == ["a", "b"]
    doc = json.loads(docs.document[0])
    assert set(doc) == {"timestamp", "current_price", live.POINT, live.QUANTILE, live.INTERVAL, live.PROBABILITY}
    assert set(doc[live.POINT]) == {"horizon_1min", "horizon_5min"}
    assert set(doc[live.QUANTILE]) == {"q5", "q25", "q50", "q75", "q95"} and set(doc[live.INTERVAL]) == {"68pct", "95pct"}
    assert len(doc[live.PROBABILITY]) == 15
    band = doc[live.INTERVAL]["95pct"]["horizon_5min"]
    assert band["lower"] <= doc[live.QUANTILE]["q50"]["horizon_5min"] <= band["upper"]


def test_health(spark):
    f = spark.sql("SELECT 'a' series, timestamp'2024-01-01 11:30:00' ts UNION ALL SELECT 'b', timestamp'2024-01-01 08:00:00'")
    bars = spark.sql("SELECT 'a' series, timestamp'2024-01-01 11:55:00' ts UNION ALL SELECT 'b', timestamp'2024-01-01 11:59:00'")
    got = {r.series: (r.forecast_ok, r.data_ok, r.healthy) for r in live.health(f, bars, "2024-01-01 12:00:00").collect()}
    assert got == {"a": (True, True, True), "b": (False, True, False)}


def test_sliding_windows_match_batch(spark, tmp_path):
    f = walk(180).rename(columns={"close": "price"})
    parts = [f.iloc[:90], f.iloc[90:]]
    got = intake.drain(intake.sliding_stats(delivered(spark, tmp_path / "in", parts), "30 minutes", "10 minutes"), "s")
    batch = (
        spark.createDataFrame(f).groupBy(F.window("ts", "30 minutes", "10 minutes"), "series")
        .agg(F.avg("price").alias("mean")).select(F.col("window.start").alias("start_ts"), F.col("mean").alias("expected"))
    )
    joined = got.join(batch, "start_ts")
    assert joined.count() == got.count() > 10
    assert joined.where("abs(mean - expected) > 1e-9").count() == 0


def test_whole_feature_sets_behind_a_history(spark):
    """A stretch of one close longer than the history, and one late bar."""
    whole = walk(1600, 6)
    whole.loc[60:1550, ["open", "high", "low", "close"]] = whole.close[60]
    known = spark.createDataFrame([], live_features.STATE)
    parts = [whole.iloc[:1500], pd.concat([whole.iloc[1500:], whole.iloc[[10]].assign(close=1.0)])]
    seen = []
    for part in parts:
        found, known = live_features.featured(known, spark.createDataFrame(part), LAYOUT, "enhanced")
        seen.append(found.toPandas())
    assert known.count() == live_features.HISTORY_ROWS < 1440
    got = pd.concat(seen, ignore_index=True)
    assert got[got.late].close.tolist() == [1.0] and got[got.late].rsi.isna().all()
    got = got[~got.late].sort_values("ts", ignore_index=True)
    expected = collected(features.enhanced_features(spark.createDataFrame(whole), LAYOUT, ()))
    for c in features.enhanced_spec(()).features:
        same(got[c], expected[c], 1e-6)


def test_idle_series_leave_the_state(spark, tmp_path):
    old, new = walk(30, 1, "old", "2024-01-01"), walk(30, 2, "new", "2024-03-01")
    stream = delivered(spark, tmp_path / "in", [old, new])
    live_features.feature_stream(stream, str(tmp_path / "out"), str(tmp_path / "cp"), LAYOUT, kind="simple").awaitTermination()
    got = live_features.read_features(spark, str(tmp_path / "out"), "simple")
    assert got.count() == 60
    state = spark.read.schema(live_features.STATE).parquet(str(tmp_path / "out/state/batch_id=1"))
    assert {r.series for r in state.select("series").distinct().collect()} == {"new"}


def test_stream_sessions_merge(spark, tmp_path):
    def ticks(*seconds):
        return pd.DataFrame({"series": "a", "ts": [pd.Timestamp("2024-01-01") + pd.Timedelta(seconds=s) for s in seconds], "price": 1.0, "volume": 1.0})

    # the second delivery joins two sessions of the first
    stream = delivered(spark, tmp_path / "in", [ticks(0, 50), ticks(25), ticks(5000), ticks(9000)])
    got = collected(intake.drain(intake.sessions(stream, "30 seconds"), "sessions"), ["series", "start_ts"])
    assert got.ticks.tolist()[:1] == [3]
