"""Forecasters fitted and applied on hourly bars.

Fitted values depend on the library's random numbers, so besides the forecasts themselves there are checks of what must hold
for any fit: row keys and counts, order and mean of members, normal equations, equality after storage.
"""

from __future__ import annotations

from functools import partial
from itertools import pairwise

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from barloom.catalog import Query
from barloom.catalog.evaluation import clean
from barloom.catalog.tables import HOURLY, bars_1h, finish
from barloom.operators import calibration, probability, splits
from barloom.plans import boosting, features, models
from barloom.session import materialized, scratch_path

HORIZONS = (1, 5, 20)
SPEC = features.FeatureSpec(features.simple_spec().features, HORIZONS)


def prepared(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Training and test rows of the feature table."""
    rows = materialized(splits.positional_split(clean(spark, sf_dir), HOURLY), "parts")
    return rows.where("part = 'train'").drop("part"), rows.where("part = 'test'").drop("part")


def forecast(spark: SparkSession, sf_dir: str, kind: str, params: dict, digits: int = 6) -> DataFrame:
    train, test = prepared(spark, sf_dir)
    return finish(models.fit(train, SPEC, kind, params).predict(test, ["close"]), digits)


def forest(train: DataFrame) -> models.Forecaster:
    return models.fit(train, SPEC, "random_forest", models.QUICK_FOREST)


def rf_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    train, test = prepared(spark, sf_dir)
    return finish(models.evaluate(forest(train), test))


def rf_quantiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    train, test = prepared(spark, sf_dir)
    return finish(probability.member_quantiles(forest(train).tree_members(test)))


def rf_calibration(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Train, ensemble, relative thresholds, calibration: the whole probabilistic run."""
    train, test = prepared(spark, sf_dir)
    members = forest(train).tree_members(test, ["close", *SPEC.targets])
    cases = F.coalesce(*[F.when(F.col("horizon") == h, F.col(f"target_{h}")) for h in HORIZONS])
    scored = probability.relative_probabilities(members.withColumn("actual", cases))
    return finish(calibration.calibration_metrics(scored))


def feature_importance(spark: SparkSession, sf_dir: str) -> DataFrame:
    train, _ = prepared(spark, sf_dir)
    return finish(models.mean_importance(forest(train).importances(spark)))


def gbt_quantiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    train, test = prepared(spark, sf_dir)
    model = models.fit(train, SPEC, "boosting")
    return finish(models.fallback_quantiles(model.predict(test)))


def boosting_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per horizon: trees, whether leaves keep to their number and have rows enough, rounds in which the training loss rose, and rows of the test
    part whose forecast isn't what SQL makes of the dumped nodes."""
    train, test = prepared(spark, sf_dir)
    model = models.fit(train, SPEC, "boosting")
    nodes = materialized(model.nodes(spark), "nodes")
    per_tree = nodes.groupBy("horizon", "tree").agg(F.count_if(F.col("feature").isNull()).alias("leaves"), F.min("rows").alias("fewest"))
    shape = per_tree.groupBy("horizon").agg(
        F.count(F.lit(1)).alias("trees"), (F.max("leaves") <= boosting.Params().leaves).alias("leaves_bounded"), (F.min("fewest") >= boosting.Params().leaf_rows).alias("leaves_filled")
    )
    losses = spark.createDataFrame([(h, sum(b > a * (1 + 1e-12) for a, b in pairwise(loss))) for h, loss in zip(model.horizons, model.losses, strict=True)], "horizon int, rises int")
    told = model.predict(test, list(SPEC.features)).withColumn("_x", F.array(*SPEC.features))
    again = boosted_by_sql(told, nodes, dict(zip(model.horizons, model.start, strict=True)))
    off = F.abs(F.col("prediction") - F.col("again")) > 1e-6 * F.abs(F.col("prediction"))
    checked = again.groupBy("horizon").agg(F.count(F.lit(1)).alias("rows"), F.count_if(off).alias("off"))
    return finish(shape.join(losses, "horizon").join(checked, "horizon"))


def boosted_by_sql(rows: DataFrame, nodes: DataFrame, start: dict[int, float]) -> DataFrame:
    """``again``: forecasts of rows with features ``_x`` by walking the nodes, given as one array for each horizon."""
    place = F.create_map(*[F.lit(x) for pair in ((f, k) for k, f in enumerate(SPEC.features)) for x in pair])
    node = F.struct("node", F.coalesce(place[F.col("feature")], F.lit(-1)).alias("f"), "threshold", "left", "right", "value")
    trees = nodes.groupBy("horizon", "tree").agg(F.array_sort(F.collect_list(node)).alias("nodes"))
    forests = trees.groupBy("horizon").agg(F.collect_list("nodes").alias("trees"))

    def walked(tree: Column) -> Column:
        def step(at: Column, _: Column) -> Column:
            n = F.get(tree, at)
            return F.when(n["f"] < 0, at).when(F.get(F.col("_x"), n["f"]) <= n["threshold"], n["left"]).otherwise(n["right"])

        last = F.aggregate(F.sequence(F.lit(1), F.lit(boosting.Params().depth)), F.lit(0), step)
        return F.get(tree, last)["value"]

    base = F.create_map(*[F.lit(x) for pair in start.items() for x in pair])[F.col("horizon")]
    joined = rows.join(F.broadcast(forests), "horizon")  # one row a horizon, of bounded size
    return joined.withColumn("again", F.aggregate("trees", base, lambda s, t: s + walked(t)))


def bootstrap_quantiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    train, test = prepared(spark, sf_dir)
    return finish(probability.member_quantiles(models.ridge_bootstrap(train, SPEC).members(test)), 4)


def rolling_validation(spark: SparkSession, sf_dir: str) -> DataFrame:
    return finish(models.rolling_scores(clean(spark, sf_dir), SPEC, min_train_rows=150), 4)


def walk_forward(spark: SparkSession, sf_dir: str) -> DataFrame:
    return finish(models.walk_forward_scores(clean(spark, sf_dir), SPEC, HOURLY, n_splits=3), 4)


def model_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Predictions of a stored and reloaded model beside those of the original."""
    train, test = prepared(spark, sf_dir)
    model, path = forest(train), scratch_path(spark, "model")
    models.save(model, spark, path)
    again = models.load(spark, path).predict(test).withColumnRenamed("prediction", "reloaded")
    return finish(model.predict(test).join(again, ["series", "ts", "horizon"]))


def stored_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    train, _ = prepared(spark, sf_dir)
    path = scratch_path(spark, "model")
    models.save(models.fit(train, SPEC, "linear"), spark, path)
    return finish(models.stored_features(spark, path))


def quick_train(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The small demonstration run: small forest, errors on the held-out rows."""
    model, held_out = models.quick_train(bars_1h(spark, sf_dir), HOURLY, SPEC)
    return finish(models.evaluate(model, held_out))


def member_check(members: DataFrame) -> DataFrame:
    """Per series and horizon: rows, members each, rows whose quantiles fall or whose mean of members isn't the forecast."""
    q = probability.member_quantiles(members).groupBy("series", "ts", "horizon").agg(F.array_sort(F.collect_list(F.struct("q", "value"))).alias("v"))
    values = F.transform("v", lambda x: x["value"])
    falls = F.exists(F.zip_with(F.slice(values, 1, F.size(values) - 1), F.slice(values, 2, F.size(values) - 1), lambda a, b: b < a), lambda x: x)
    mean = F.aggregate("members", F.lit(0.0), lambda s, x: s + x) / F.size("members")
    off = F.abs(mean - F.col("prediction")) > 1e-6 * F.abs(F.col("prediction"))
    rows = members.join(q.select("series", "ts", "horizon", falls.alias("falls")), ["series", "ts", "horizon"])
    return rows.groupBy("series", "horizon").agg(
        F.count(F.lit(1)).alias("rows"), F.max(F.size("members")).alias("members"),
        F.sum(F.col("falls").cast("bigint")).alias("falling"), F.sum(off.cast("bigint")).alias("off_mean"),
    )


def forest_check(spark: SparkSession, sf_dir: str, params: dict) -> DataFrame:
    train, test = prepared(spark, sf_dir)
    model = models.fit(train, SPEC, "random_forest", params)
    return finish(member_check(materialized(model.tree_members(test), "members")))


def importance_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Importances of a forecaster add up to 1."""
    train, _ = prepared(spark, sf_dir)
    found = forest(train).importances(spark).groupBy("horizon")
    return finish(found.agg(F.sum("importance").alias("total"), F.sum((F.col("importance") < 0).cast("bigint")).alias("negative")))


def normal_equations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What is left of the gradient of the linear and ridge losses, relative to the label's spread: nothing."""
    train, _ = prepared(spark, sf_dir)
    out = []
    for kind, penalty in (("linear", 0.0), ("ridge", models.RIDGE_ALPHA)):
        model = models.fit(train, SPEC, kind)
        fitted = model.pipeline.transform(train)
        for h, m in model.regressors.items():
            left = F.col(f"target_{h}") - F.col(f"prediction_{h}")
            parts = [
                F.struct(F.lit(f).alias("feature"), ((F.sum(F.col(f"scaled_{f}") * left) - penalty * float(w)) / (F.count(F.lit(1)) * F.stddev_pop(f"target_{h}"))).alias("gradient"))
                for f, w in zip(model.features, m.coefficients.toArray(), strict=True)
            ]
            out.append(fitted.agg(F.array(*parts).alias("g")).select(F.lit(kind).alias("kind"), F.lit(h).alias("horizon"), F.inline("g")))
    return finish(models._stacked(out).withColumn("gradient", F.abs(F.round("gradient", 4))))


def rolling_windows_fitted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Windows that were fitted and scored, with their bounds and row counts."""
    bounds = ["split", "train_start", "train_end", "test_start", "test_end", "train_samples", "test_samples"]
    return finish(rolling_validation(spark, sf_dir).groupBy(*bounds).agg(F.count(F.lit(1)).alias("scores")))


def walk_forward_fitted(spark: SparkSession, sf_dir: str) -> DataFrame:
    return finish(walk_forward(spark, sf_dir).groupBy("split", "train_samples", "test_samples").agg(F.count(F.lit(1)).alias("scores")))


def roundtrip_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A reloaded model forecasts what the stored one does."""
    gap = F.abs(F.col("prediction") - F.col("reloaded"))
    return finish(model_roundtrip(spark, sf_dir).select("series", "ts", "horizon", gap.alias("gap")))


QUERIES: dict[str, Query] = {
    "rf_member_check": partial(forest_check, params=models.QUICK_FOREST),
    "rf_member_check_small": partial(forest_check, params=models.SMALL_FOREST),
    "rf_member_check_full": partial(forest_check, params=models.FOREST),
    "boosting_check": boosting_check,
    "importance_check": importance_check,
    "normal_equations": normal_equations,
    "rolling_windows_fitted": rolling_windows_fitted,
    "walk_forward_fitted": walk_forward_fitted,
    "roundtrip_check": roundtrip_check,
    "rf_forecast": partial(forecast, kind="random_forest", params=models.QUICK_FOREST),
    "gbt_forecast": partial(forecast, kind="boosting", params={}),
    "linear_forecast": partial(forecast, kind="linear", params={}, digits=4),
    "ridge_forecast": partial(forecast, kind="ridge", params={}, digits=4),
    "rf_metrics": rf_metrics,
    "quick_train": quick_train,
    "rf_quantiles": rf_quantiles,
    "rf_calibration": rf_calibration,
    "feature_importance": feature_importance,
    "gbt_quantiles": gbt_quantiles,
    "bootstrap_quantiles": bootstrap_quantiles,
    "rolling_validation": rolling_validation,
    "walk_forward": walk_forward,
    "model_roundtrip": model_roundtrip,
    "stored_features": stored_features,
}
