import numpy as np
import pandas as pd
import pytest
from conftest import collected, walk
from pyspark.sql import functions as F

from barloom.operators import probability
from barloom.operators.layout import Layout
from barloom.plans import boosting, features, models

LAYOUT = Layout(60, 4096)
SPEC = features.FeatureSpec(features.simple_spec().features, (1, 5))
TREES = {"numTrees": 5, "maxDepth": 4, "seed": 1}


@pytest.fixture(scope="module")
def table(spark):
    rows = features.clean_rows(features.simple_features(spark.createDataFrame(walk(1500, 11)), LAYOUT), features.simple_spec())
    return rows.persist()


@pytest.fixture(scope="module")
def parts(table):
    cut = F.lit("2024-01-01 20:00:00").cast("timestamp")
    return table.where(F.col("ts") < cut), table.where(F.col("ts") >= cut)


@pytest.fixture(scope="module")
def forest(parts):
    return models.fit(parts[0], SPEC, "random_forest", TREES)


def test_reloaded_model_predicts_the_same(spark, forest, parts, tmp_path):
    models.save(forest, spark, str(tmp_path / "m"))
    again = models.load(spark, str(tmp_path / "m"))
    assert (again.kind, again.features, again.horizons) == ("random_forest", SPEC.features, SPEC.horizons)
    keys = ["series", "ts", "horizon"]
    a, b = (collected(m.predict(parts[1]), keys).prediction for m in (forest, again))
    assert np.allclose(a, b)
    names = models.stored_features(spark, str(tmp_path / "m")).orderBy("position").collect()
    assert [r.feature for r in names] == list(SPEC.features)


def test_trees_average_to_the_forest(forest, parts):
    keys = ["series", "ts", "horizon"]
    trees, whole = collected(forest.tree_members(parts[1]), keys), collected(forest.predict(parts[1]), keys)
    assert np.allclose(trees.prediction, whole.prediction)
    assert all(len(m) == 5 and list(m) == sorted(m) for m in trees.members)


def test_quantiles_never_cross(forest, parts):
    q = probability.member_quantiles(forest.tree_members(parts[1]))
    wide = q.groupBy("ts", "horizon").pivot("q", [0.05, 0.25, 0.5, 0.75, 0.95]).agg(F.first("value"))
    assert wide.where("`0.05` > `0.25` or `0.25` > `0.5` or `0.5` > `0.75` or `0.75` > `0.95`").count() == 0
    f = models.fallback_quantiles(forest.predict(parts[1])).groupBy("ts", "horizon").pivot("q", [0.05, 0.5, 0.95]).agg(F.first("value"))
    assert f.where("not (`0.05` < `0.5` and `0.5` < `0.95`)").count() == 0


def test_ridge_solves_the_normal_equations(parts):
    train, test = parts
    model = models.fit(train, SPEC, "ridge")
    t, e = train.toPandas(), collected(test)
    cols = list(SPEC.features)
    mid = t[cols].median()
    iqr = (t[cols].quantile(0.75) - t[cols].quantile(0.25)).replace(0, 1)
    x, y = ((t[cols] - mid) / iqr).to_numpy(), t.target_5.to_numpy()
    xc, yc = x - x.mean(0), y - y.mean()
    w = np.linalg.solve(xc.T @ xc + np.eye(len(cols)), xc.T @ yc)
    expected = (((e[cols] - mid) / iqr).to_numpy() - x.mean(0)) @ w + y.mean()
    got = collected(model.predict(test).where("horizon = 5"))
    assert np.allclose(got.prediction, expected, atol=1e-3)


def test_linear_beats_the_mean(parts):
    train, test = parts
    rmse = {r.horizon: r.rmse for r in models.evaluate(models.fit(train, SPEC, "linear"), test).collect()}
    e, mean = collected(test), train.agg(F.avg("target_1")).first()[0]
    assert rmse[1] < np.sqrt(((e.target_1 - mean) ** 2).mean())


def test_importances(spark, forest):
    per_horizon = forest.importances(spark).groupBy("horizon").agg(F.sum("importance").alias("s")).collect()
    assert all(abs(r.s - 1) < 1e-9 for r in per_horizon)
    top = models.mean_importance(forest.importances(spark), 3).collect()
    assert len(top) == 3 and top[0].importance >= top[1].importance >= top[2].importance


def test_bootstrap_members(parts):
    resampled = models.bootstrap(parts[0], SPEC, 3, "ridge")
    rows = models.bootstrap_members(resampled, parts[1]).select(F.size("members").alias("n")).distinct().collect()
    assert [r.n for r in rows] == [3]


def test_validation_loops(spark, table):
    hourly = walk(24 * 14, 4, freq="h")
    rows = features.clean_rows(features.simple_features(spark.createDataFrame(hourly), LAYOUT), features.simple_spec())

    def fit_one(train):
        return models.fit(train, SPEC, "ridge")

    got = models.rolling_validation(rows, fit_one, min_train_rows=100).toPandas()
    assert sorted(set(got.split)) == list(range(1, got.split.max() + 1)) and set(got.horizon) == {1, 5} and (got.test_samples > 0).all()
    assert (got.train_end == got.test_start).all() and (got.train_samples >= 100).all()
    forward = models.walk_forward(table, fit_one, LAYOUT, n_splits=2).toPandas()
    assert set(forward.split) == {1, 2}


def test_missing_feature_is_named(forest, parts):
    with pytest.raises(ValueError, match="close_lag_1"):
        forest.predict(parts[1].drop("close_lag_1"))


@pytest.fixture(scope="module")
def boosted(parts):
    return models.fit(parts[0], SPEC, "boosting", {"rounds": 12})


def plain_tree(bins, residual, params):
    """Best-first growth with whole counts for every leaf: nodes as (rows, value)."""
    def gain_of(rows):
        best = None
        for f in range(bins.shape[1]):
            for b in range(bins[:, f].max() + 1):
                left = rows & (bins[:, f] <= b)
                right = rows & ~left
                if min(left.sum(), right.sum()) >= params.leaf_rows:
                    gain = residual[left].sum() ** 2 / left.sum() + residual[right].sum() ** 2 / right.sum() - residual[rows].sum() ** 2 / rows.sum()
                    if best is None or gain > best[0] + 1e-9:
                        best = (gain, left, right)
        return best

    leaves = [(np.ones(len(residual), bool), gain_of(np.ones(len(residual), bool)))]
    while len(leaves) < params.leaves:
        found = [(g[0], k) for k, (_, g) in enumerate(leaves) if g and g[0] > 1e-9]
        if not found:
            break
        k = max(found, key=lambda x: (x[0], -x[1]))[1]
        _, (_, left, right) = leaves.pop(k)
        leaves += [(side, gain_of(side)) for side in (left, right)]
    out = np.zeros(len(residual))
    for rows, _ in leaves:
        out[rows] = params.rate * residual[rows].mean()
    return out


def test_trees_grow_best_first():
    rng = np.random.default_rng(2)
    bins = rng.integers(0, 12, (300, 4)).astype(np.uint8)
    target = (bins[:, 0] > 5) * 3.0 + bins[:, 1] * 0.2 + rng.normal(size=300) * 0.3
    params = boosting.Params(rounds=3, leaves=9, leaf_rows=8)
    trees, losses = boosting.boosted_in_block(bins, target, np.zeros(300), [np.arange(11.0)] * 4, params)
    residual = target.copy()
    for tree in trees:
        assert tree.leaves == 9 and np.allclose(tree.scores(bins), plain_tree(bins, residual, params))
        residual -= tree.scores(bins)
    assert losses == sorted(losses, reverse=True)


def test_boosting_in_passes_is_that_in_one_block(parts, boosted, monkeypatch):
    monkeypatch.setattr(boosting, "BLOCK_ROWS", 100)
    monkeypatch.setattr(boosting, "FAN_IN", 2)
    monkeypatch.setattr(boosting, "STORED_ROUNDS", 2)
    passes = models.fit(parts[0], SPEC, "boosting", {"rounds": 3})
    assert np.allclose(np.array(passes.losses), np.array(boosted.losses)[:, :4])
    assert [[t.feature for t in trees] for trees in passes.trees] == [[t.feature for t in trees[:3]] for trees in boosted.trees]


def test_boosting(spark, boosted, parts, tmp_path):
    assert all(t.leaves <= 31 and min(n for n, f in zip(t.rows, t.feature, strict=True) if f < 0) >= 20 for trees in boosted.trees for t in trees)
    models.save(boosted, spark, str(tmp_path / "b"))
    again, keys = models.load(spark, str(tmp_path / "b")), ["series", "ts", "horizon"]
    assert collected(boosted.predict(parts[1]), keys).prediction.equals(collected(again.predict(parts[1]), keys).prediction)
    rmse = models.evaluate(boosted, parts[0]).toPandas().set_index("horizon").rmse.sort_index()
    assert np.allclose(rmse**2, [loss[-1] for loss in boosted.losses])
    shares = boosted.importances(spark).groupBy("horizon").agg(F.sum("importance").alias("s")).collect()
    assert all(abs(r.s - 1) < 1e-9 for r in shares)


def test_boosting_of_few_and_no_rows(spark, parts):
    one = models.fit(parts[0].limit(30), SPEC, "boosting", {"rounds": 2})
    assert all(t.leaves == 1 for trees in one.trees for t in trees)
    assert models.fit(parts[0].limit(0), SPEC, "boosting", {"rounds": 2}).trees == ((), ())


def test_resamples_weigh_rows_like_draws(spark, parts):
    train, test = parts
    keyed = train.select("series", "ts", models.poisson_weights(probability.draw_key(42, F.col("series"), F.unix_seconds("ts")), 40).alias("w"))
    w = np.stack(collected(keyed).w)
    assert abs(w.mean() - 1) < 0.02 and abs(w.var() - 1) < 0.05 and len({tuple(x) for x in w.T}) == 40
    fitted = models.ridge_bootstrap(train, SPEC, resamples=40)
    t, e = collected(train), collected(test)
    cols = list(SPEC.features)
    mid, width = t[cols].median(), t[cols].quantile(0.75) - t[cols].quantile(0.25)
    x, z, y = ((t[cols] - mid) / width).to_numpy(), ((e[cols] - mid) / width).to_numpy(), t.target_5.to_numpy()
    found = []
    for k in range(40):
        n = w[:, k]
        mx, my = (n @ x) / n.sum(), (n @ y) / n.sum()
        weights = np.linalg.solve((x - mx).T @ ((x - mx) * n[:, None]) + np.eye(len(cols)), (x - mx).T @ (n * (y - my)))
        found.append((z - mx) @ weights + my)
    got = collected(fitted.members(test, ["close"]).where("horizon = 5"))
    assert np.allclose(np.stack(got.members), np.sort(np.array(found).T, axis=1), atol=1e-6) and "close" in got


def test_scores_from_sums_are_those_of_single_fits(spark, table):
    hourly = pd.concat([walk(24 * 12, 4, "a", freq="h"), walk(24 * 11, 5, "b", freq="h")], ignore_index=True)
    rows = features.clean_rows(features.simple_features(spark.createDataFrame(hourly), LAYOUT), features.simple_spec()).persist()

    def fit_one(train):
        return models.fit(train, SPEC, "linear")

    one = models.rolling_validation(rows, fit_one, min_train_rows=100).toPandas()
    both = models.rolling_scores(rows, SPEC, min_train_rows=100, alpha=0.0).toPandas()
    keys = ["split", "horizon"]
    one, both = (d.sort_values(keys, ignore_index=True) for d in (one, both))
    same_columns = ["split", "horizon", "train_start", "test_end", "train_samples", "test_samples"]
    assert both[same_columns].equals(one[same_columns].astype(both[same_columns].dtypes.to_dict()))
    assert np.allclose(both[["rmse", "mae", "mape"]], one[["rmse", "mae", "mape"]], rtol=1e-4)
    ahead = models.walk_forward(table, fit_one, LAYOUT, n_splits=2).toPandas().sort_values(keys)
    sums = models.walk_forward_scores(table, SPEC, LAYOUT, n_splits=2).toPandas().sort_values(keys)
    assert np.allclose(sums[["rmse", "mae", "mape"]], ahead[["rmse", "mae", "mape"]], rtol=1e-4)
    assert sums.train_samples.tolist() == ahead.train_samples.tolist()


def test_scores_of_too_short_a_table(spark, table):
    assert models.rolling_scores(table, SPEC).count() == 0  # a day of minutes
    assert models.rolling_scores(table.limit(0), SPEC).count() == 0
