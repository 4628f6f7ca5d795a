import json

import pandas as pd
import pytest
from conftest import collected, same, walk
from pyspark.sql import functions as F

from barloom.operators import quality
from barloom.sources import bars as bar_ops
from barloom.sources import files, payloads, requests


def test_csv_round_trip_and_rejects(spark, tmp_path):
    bars = spark.createDataFrame(pd.concat([walk(20, 1, "a"), walk(10, 2, "b")]))
    files.write_bars_csv(bars, str(tmp_path / "csv"))
    again = files.read_bars_csv(spark, str(tmp_path / "csv"))
    assert again.exceptAll(bars.select(*again.columns)).count() == 0 and again.count() == 30
    (tmp_path / "one.csv").write_text(
        "timestamp,open,high,low,close,volume\n2024-01-01 00:00:00,1,2,0.5,1.5,10\nnonsense,1,2,0.5,1.5,10\n2024-01-01 00:01:00,1,2,0.5,,1\n"
    )
    good, bad = files.split_rejects(files.read_bars_csv(spark, str(tmp_path / "one.csv"), "x"))
    assert (good.count(), bad.count()) == (1, 2) and good.first().series == "x"


def test_bars_are_pruned_by_day(spark, tmp_path):
    files.write_bars(spark.createDataFrame(walk(48, 1, freq="h")), str(tmp_path / "bars"))
    day = spark.read.parquet(str(tmp_path / "bars")).where("day = date'2024-01-02'")
    assert day.count() == 24
    assert "PartitionFilters: [isnotnull(day" in day._jdf.queryExecution().executedPlan().toString()


def test_metrics_by_model(spark, tmp_path):
    df = spark.createDataFrame([("m1", 1, 2.0), ("m2", 1, 3.0)], "model string, horizon int, rmse double")
    files.write_metrics(df, str(tmp_path / "m"))
    assert files.read_metrics(spark, str(tmp_path / "m"), df.schema, ["m2", "absent"]).count() == 1
    assert files.read_metrics(spark, str(tmp_path / "m"), df.schema).count() == 2
    files.write_metrics(df.limit(0), str(tmp_path / "none"))
    assert files.read_metrics(spark, str(tmp_path / "none"), df.schema).count() == 0


def test_candle_order(spark):
    text = json.dumps([[1704067260, 1.0, 4.0, 2.0, 3.0, 9.5], [1704067200, 0.5, 2.0, 1.0, 2.0, 1.0]])
    got = collected(payloads.decode_candles(spark.createDataFrame([("a", text)], "series string, payload string")))
    assert got.iloc[1][["open", "high", "low", "close", "volume"]].tolist() == [2.0, 4.0, 1.0, 3.0, 9.5]
    assert str(got.ts[0]) == "2024-01-01 00:00:00"


def test_ticker_defaults(spark):
    rows = [("a", '{"price": "10.5", "bid": "10.4"}'), ("a", '{"bid": "1"}'), ("a", "junk")]
    got = payloads.decode_tickers(spark.createDataFrame(rows, "series string, message string")).collect()
    assert [(r.price, r.bid, r.ask, r.volume) for r in got] == [(10.5, 10.4, 0.0, 0.0)]


def test_request_plan_for_two_years(spark):
    spans = spark.sql("SELECT 'a' series, timestamp'2022-01-01' start_ts, timestamp'2022-01-01' + interval 730 days end_ts")
    plan = requests.forward_chunks(spans)
    assert plan.count() == 3504
    assert plan.where("chunk_end > chunk_start + interval 300 minutes").count() == 0
    back = requests.backward_chunks(spans, 730).orderBy("chunk").collect()
    assert len(back) == 25 and (back[-1].chunk_end - back[-1].chunk_start).days == 10


def test_first_copy_wins_even_when_one_key_dominates(spark):
    copies = spark.range(3000).select(
        F.lit("a").alias("series"), F.lit("2024-01-01").cast("timestamp").alias("ts"),
        (F.col("id") * 1.0).alias("close"), (3000 - F.col("id")).alias("seq"),
    )
    rest = spark.sql("SELECT 'a' series, timestamp'2024-01-02' ts, double(7) close, bigint(1) seq")
    for order in ("seq", bar_ops.packed(("seq", 9))):
        kept = bar_ops.keep_first(bar_ops.combine([copies, rest]), order)
        assert collected(kept).close.tolist() == [2999.0, 7.0] and kept.columns == copies.columns
    assert "SortAggregate" not in kept._jdf.queryExecution().executedPlan().toString()


def test_resample_open_and_close_follow_the_order(spark):
    rows = [("a", "2024-01-01 00:00:10", 5.0, 1.0, 2), ("a", "2024-01-01 00:00:10", 4.0, 1.0, 1), ("a", "2024-01-01 00:00:59", 9.0, 2.0, 3)]
    ticks = spark.createDataFrame(rows, "series string, ts string, price double, volume double, id int").withColumn("ts", F.col("ts").cast("timestamp"))
    r = bar_ops.resample(ticks, 60, ["ts", "id"]).first()
    assert (r.open, r.high, r.low, r.close, r.volume) == (4.0, 9.0, 4.0, 9.0, 4.0)


def test_quality_counts(spark):
    f = walk(10)
    f.loc[3, "close"] = float("nan")
    f.loc[4, "volume"] = 0.0
    bars = spark.createDataFrame(pd.concat([f, f.iloc[[0, 0]]]))
    r = quality.quality_report(bars).first()
    assert (r["rows"], r.missing_values, r.duplicate_stamps, r.zero_volume_rows) == (12, 1, 2, 1)


def test_histogram_keeps_every_value(spark):
    f = walk(500)
    got = quality.histogram(spark.createDataFrame(f), "close", 50).toPandas()
    counts, _ = __import__("numpy").histogram(f.close, bins=50)
    assert got["count"].sum() == 500
    same(got.sort_values("bin")["count"].astype(float).values, counts[counts > 0])
    one = quality.histogram(spark.createDataFrame(f.iloc[:1]), "close").collect()
    assert len(one) == 1 and one[0]["count"] == 1


@pytest.mark.parametrize("minutes,rows", [(0, 1), (5, 6), (1000, 20)])
def test_recent_slice(spark, minutes, rows):
    assert bar_ops.recent(spark.createDataFrame(walk(20)), minutes).count() == rows
