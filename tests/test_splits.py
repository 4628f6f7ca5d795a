from datetime import timedelta

import pandas as pd
import pytest
from conftest import walk
from pyspark.sql import functions as F

from barloom.operators import splits


@pytest.fixture(scope="module")
def frame():
    f = pd.concat([walk(24 * 15, 1, "a", freq="h"), walk(24 * 9 + 5, 2, "b", start="2024-02-01 03:00", freq="h")])
    return f[~((f.series == "a") & (f.ts >= "2024-01-04") & (f.ts < "2024-01-06"))].reset_index(drop=True)


def stepped(f, minimum):
    """Window after window, as a loop over dates."""
    out, day = [], timedelta(days=1)
    now = f.ts.min() + 7 * day
    while now + day <= f.ts.max():
        n = ((f.ts >= now - 7 * day) & (f.ts < now)).sum()
        if n >= minimum:
            out.append((now - 7 * day, now, now + day, n))
        now += day
    return out


@pytest.mark.parametrize("minimum", [1, 130, 168])
def test_rolling_splits_follow_the_calendar(spark, frame, minimum):
    got = splits.rolling_splits(spark.createDataFrame(frame), min_train_rows=minimum).orderBy("series", "split").collect()
    for name, g in frame.groupby("series"):
        mine = [(r.train_start, r.train_end, r.test_end, r.train_samples) for r in got if r.series == name]
        assert mine == [tuple(x) for x in stepped(g, minimum)]
        assert [r.split for r in got if r.series == name] == list(range(1, len(mine) + 1))


def test_assignment_never_mixes_train_and_test(spark, frame):
    bars = spark.createDataFrame(frame)
    windows = splits.rolling_splits(bars, min_train_rows=1)
    rows = splits.assign(bars, windows)
    checked = rows.join(windows.select("series", "split", "train_start", "train_end", "test_start", "test_end"), ["series", "split"])
    inside = F.when(F.col("part") == "train", (F.col("ts") >= F.col("train_start")) & (F.col("ts") < F.col("train_end"))).otherwise(
        (F.col("ts") >= F.col("test_start")) & (F.col("ts") < F.col("test_end"))
    )
    assert checked.where(~inside).count() == 0
    counts = rows.where("part = 'train'").groupBy("series", "split").count()
    assert counts.join(windows, ["series", "split"]).where("count <> train_samples").count() == 0


def test_walk_forward_windows(spark):
    sizes = spark.createDataFrame([("a", 1000), ("short", 4)], "series string, size bigint")
    got = [tuple(r) for r in splits.walk_forward_splits(sizes).orderBy("series", "split").collect() if r.series == "a"]
    assert got == [("a", i + 1, 800 - 40 * i, 800 - 40 * i, 1000 - 40 * i) for i in range(5)]
