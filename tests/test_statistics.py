import numpy as np
import pandas as pd
import pytest
from conftest import collected, walk
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from barloom.functions import arrays, labels, timeparts
from barloom.operators import calibration, metrics, probability, scaling


@pytest.mark.parametrize("limit", [5, 200])
def test_exact_quantiles_narrow_to_the_right_values(spark, limit):
    rng = np.random.default_rng(4)
    n = 5000
    f = pd.DataFrame(
        {
            "normal": rng.normal(size=n),
            "heavy": np.exp(rng.normal(size=n) * 4),
            "tied": rng.choice([0.0, 1.0, 2.0], size=n, p=[0.1, 0.8, 0.1]),
            "flat": np.full(n, 3.5),
        }
    )
    qs = (0.0, 0.25, 0.5, 0.75, 0.99, 1.0)
    got = scaling.exact_quantiles(spark.createDataFrame(f), list(f), qs, limit=limit, accuracy=50)
    for c in f:
        assert np.allclose(got[c], np.quantile(f[c], qs), rtol=1e-12), c


def test_scaling_shifts_constant_columns_only(spark):
    df = spark.createDataFrame([(float(i), 2.0) for i in range(9)], "x double, k double")
    s = scaling.robust_scaling(df, ["x", "k"])
    assert s.shift == {"x": 4.0, "k": 2.0} and s.divisor == {"x": 4.0, "k": 1.0}
    s = scaling.standard_scaling(df, ["x", "k"])
    assert s.divisor["k"] == 1.0 and abs(s.divisor["x"] - np.std(range(9))) < 1e-12


def grid_probability(members, threshold):
    """Expected share of draws below the threshold: segment by segment over the 99 percentiles."""
    q = np.arange(1, 100) / 100
    g = np.quantile(members, q)
    total = 0.01 * (g[0] < threshold) + 0.01 * (g[-1] < threshold)
    for a, b in zip(g[:-1], g[1:], strict=True):
        total += 0.01 * (np.clip((threshold - a) / (b - a), 0, 1) if b > a else float(a < threshold))
    return total


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.integers(-20, 20), min_size=5, max_size=25), st.lists(st.floats(-25, 25), min_size=8, max_size=8))
def test_event_probability_is_the_measure_below_the_threshold(spark, members, thresholds):
    values = sorted(float(m) for m in members)
    rows = [(values, t) for t in [*thresholds, *values[:4]]]
    df = spark.createDataFrame(rows, "members array<double>, t double")
    got = [r.p for r in df.select(arrays.ensemble_cdf(F.col("members"), F.col("t")).alias("p")).collect()]
    assert np.allclose(got, [grid_probability(values, t) for _, t in rows], atol=1e-9)


def test_probabilities_of_a_partition_sum_to_one(spark):
    df = spark.createDataFrame([([1.0, 2.0, 2.0, 5.0, 9.0],)], "members array<double>")
    m = F.col("members")

    def p(op, low, high=None):
        return probability.event_probability(m, F.lit(op), F.lit(low), F.lit(high).cast("double"))

    row = df.select((p("below", 2.0) + p("between", 2.0, 6.0) + p("above", 6.0)).alias("s"), p("odd", 2.0).alias("z")).first()
    assert abs(row.s - 1) < 1e-12 and row.z == 0.0


def test_sampled_distribution_agrees_with_closed_form(spark):
    rows = spark.createDataFrame([("a", 1, 1, [1.0, 2.0, 4.0, 8.0])], "series string, ts int, horizon int, members array<double>")
    draws = probability.sampled_distribution(rows, 20_000)
    share = draws.select(F.avg((F.col("value") < 3.0).cast("double"))).first()[0]
    assert abs(share - grid_probability([1, 2, 4, 8], 3.0)) < 0.02


def test_quantiles_are_monotone_and_match_numpy(spark):
    values = [3.0, 1.0, 7.0, 7.0, 2.5]
    df = spark.createDataFrame([(values,)], "v array<double>")
    qs = (0.0, 0.1, 0.5, 0.73, 1.0)
    got = df.select(*[arrays.array_quantile(F.col("v"), q) for q in qs]).first()
    assert np.allclose(got, np.quantile(values, qs)) and list(got) == sorted(got)


def brute_calibration(p, e, bins=20):
    edges = np.linspace(0, 1, bins + 1)
    ece, curve = 0.0, []
    for lo, hi in zip(edges[:-1], edges[1:], strict=True):
        inside = (p > lo) & (p <= hi)
        if inside.any():
            ece += abs(p[inside].mean() - e[inside].mean()) * inside.mean()
            curve.append((round(lo, 6), inside.sum(), p[inside].mean(), e[inside].mean()))
    clipped = np.clip(p, 1e-15, 1 - 1e-15)
    loss = -np.mean(e * np.log(clipped) + (1 - e) * np.log(1 - clipped))
    return np.mean((p - e) ** 2), loss, ece, curve


def test_calibration_against_brute_force(spark):
    rng = np.random.default_rng(9)
    p = np.concatenate([rng.uniform(size=500), [0.0, 0.0, 1.0, 0.05, 0.25, 0.999999]])
    e = (rng.uniform(size=len(p)) < p).astype(int)
    rows = [("q", 1, float(a), int(b)) for a, b in zip(p, e, strict=True)] + [("q", 1, 0.4, None)]
    df = spark.createDataFrame(rows, "query string, horizon int, probability double, event int")
    brier, loss, ece, curve = brute_calibration(p, e)
    row = calibration.calibration_metrics(df).first()
    assert row.n_samples == len(p)
    assert np.allclose([row.brier_score, row.log_loss, row.calibration_error], [brier, loss, ece])
    got = calibration.calibration_curve(df).orderBy("bin_lower").collect()
    assert [(round(r.bin_lower, 6), r["count"]) for r in got] == [(lo, n) for lo, n, _, _ in curve]
    assert np.allclose([(r.confidence, r.accuracy) for r in got], [(c, a) for _, _, c, a in curve])


def test_error_metrics_skip_missing_pairs_and_zero_actuals(spark):
    nan = float("nan")
    rows = [("g", 2.0, 1.0), ("g", 0.0, 1.0), ("g", nan, 1.0), ("g", 4.0, None), ("empty", nan, 1.0)]
    df = spark.createDataFrame(rows, "k string, actual double, prediction double")
    got = {r.k: r for r in metrics.error_metrics(df, ["k"]).collect()}
    assert (got["g"].rmse, got["g"].mae, got["g"].mape) == (1.0, 1.0, 50.0)
    assert got["empty"].rmse is None and got["empty"].mape is None
    strict = {r.k: r.mape for r in metrics.strict_mape(df, ["k"]).collect()}
    assert strict["g"] is None


def test_nan_is_no_event(spark):
    df = spark.createDataFrame([(float("nan"),), (5.0,)], "actual double")
    got = [r[0] for r in df.select(probability.event_outcome(F.col("actual"), F.lit("above"), F.lit(4.0), F.lit(None))).collect()]
    assert got == [None, 1]


def test_interpolation_clamps_both_ends(spark):
    xs, ys, at = [1.0, 2.0, 4.0], [10.0, 20.0, 0.0], [0.0, 1.0, 1.5, 3.0, 4.0, 9.0]
    df = spark.createDataFrame([(x, xs, ys) for x in at], "x double, xs array<double>, ys array<double>")
    got = [r[0] for r in df.select(arrays.interpolate(F.col("x"), F.col("xs"), F.col("ys"))).collect()]
    assert np.allclose(got, np.interp(at, xs, ys))


def test_evenly_spaced_grid(spark):
    got = spark.range(1).select(arrays.evenly_spaced(0.01, 0.99, 99).alias("g")).first().g
    assert np.allclose(got, np.linspace(0.01, 0.99, 99))


def test_names(spark):
    df = spark.createDataFrame([("between_10_20",), ("above_500",), ("below_-0.5pct",), ("other",)], "q string")
    low, high = labels.query_bounds(F.col("q"))
    got = [tuple(r) for r in df.select(low, high).collect()]
    assert got == [(10.0, 20.0), (500.0, None), (-0.5, None), (None, None)]
    one = spark.range(1)
    assert one.select(labels.round_to_hundred(F.lit(1250.0))).first()[0] == 1200.0
    assert one.select(labels.percent_label(F.lit(0.29))).first()[0] == "29"
    assert one.select(labels.display_name(F.lit("random_forest"))).first()[0] == "Random Forest"


def test_unknown_timeframe_raises(spark):
    assert spark.range(1).select(timeparts.timeframe_seconds(F.lit("4h"))).first()[0] == 14_400
    with pytest.raises(Exception, match="unsupported timeframe"):
        spark.range(1).select(timeparts.timeframe_seconds(F.lit("4w"))).collect()


def test_leaderboard_breaks_ties_by_first_row(spark):
    rows = [("one_model", 1, 1, 2.0, 1.0, 1.0), ("one_model", 1, 5, 2.0, 1.0, 1.0), ("b", 1, 1, 1.0, 1.0, 1.0)]
    df = spark.createDataFrame(rows, "model string, split int, horizon int, rmse double, mae double, mape double")
    got = metrics.leaderboard(df).orderBy("rank").collect()
    assert [(r.model, r.best_horizon, r.worst_horizon, r.rank) for r in got] == [("B", 1, 1, 1), ("One Model", 1, 1, 2)]


def test_walk_is_usable():
    assert (walk(50).high >= walk(50).low).all()


@pytest.mark.parametrize("limit", [20, 10_000])
def test_quantiles_by_group(spark, limit):
    rng = np.random.default_rng(1)
    rows = pd.DataFrame({"g": rng.choice(["a", "b", "c"], 4000, p=[0.9, 0.08, 0.02]), "h": rng.integers(0, 2, 4000), "x": rng.normal(size=4000).round(2)})
    rows.loc[rows.g == "b", "x"] = rng.choice([1.0, 2.0, 5.5], (rows.g == "b").sum())  # mostly ties
    rows.loc[rng.random(4000) < 0.02, "x"] = np.nan
    levels = (0.0, 0.05, 0.5, 0.77, 1.0)
    got = scaling.group_quantiles(spark.createDataFrame(rows), ["g", "h"], "x", levels, limit=limit).toPandas()
    expected = rows.dropna().groupby(["g", "h"]).x.quantile(levels).unstack()
    for r in got.itertuples():
        assert np.allclose(r.quantiles, expected.loc[(r.g, r.h)])
    assert len(got) == len(expected)


def test_quantiles_of_no_rows(spark):
    none = spark.createDataFrame([("a", None), (None, 1.0)], "g string, x double")
    assert scaling.group_quantiles(none.where("x is null"), ["g"], "x", [0.5]).count() == 0


def test_draws_are_repeatable_and_follow_their_distribution(spark):
    members = sorted(np.random.default_rng(2).normal(100, 3, 20))
    hours = spark.range(60).select(F.lit("a").alias("series"), F.timestamp_seconds(F.col("id") * 3600).alias("ts"), F.lit(1).alias("horizon"))
    df = hours.withColumns({"close": F.lit(100.0), "actual": F.lit(100.0), "members": F.array(*map(F.lit, map(float, members)))})
    drawn = collected(probability.sampled_probabilities(df), ["series", "ts", "query"])
    again = collected(probability.sampled_probabilities(df.repartition(7)), ["series", "ts", "query"])
    assert drawn.probability.equals(again.probability)
    exact = collected(probability.relative_probabilities(df), ["series", "ts", "query"])
    # 60 rows of 1 000 independent draws
    mean = drawn.groupby("query").probability.mean()
    for q, p in exact.groupby("query").probability.mean().items():
        assert abs(mean[q] - p) < 5 * np.sqrt(max(p * (1 - p), 1e-4) / 60_000)
    told = probability.sampled_distribution(df, draws=500).toPandas()
    assert (told.low >= members[0]).all() and (told.high <= members[-1]).all() and told["mean"].nunique() == 60
    assert set(probability.sampled_distribution(df, draws=500, seed=7).toPandas()["mean"]).isdisjoint(told["mean"])
