"""Multi-horizon forecasters on Spark ML: fitting, prediction, ensembles, validation, storage."""

from __future__ import annotations

import json
import math
import re
from collections.abc import Callable, Iterable, Iterator, Sequence
from dataclasses import dataclass
from multiprocessing.pool import ThreadPool

import numpy as np
import pyarrow as pa
from pyspark.ml import PipelineModel
from pyspark.ml.base import Estimator, Model
from pyspark.ml.functions import vector_to_array
from pyspark.ml.feature import SQLTransformer, VectorAssembler
from pyspark.ml.regression import LinearRegression, RandomForestRegressor
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType, IntegerType, StructField, StructType

from barloom.operators import metrics, regression, scaling, splits
from barloom.operators.layout import Layout, attach, positions
from barloom.operators.probability import PRIME, QUANTILES, draw_key, uniform_draws
from barloom.plans import boosting
from barloom.plans.features import FeatureSpec, clean_rows, reconcile, simple_features
from barloom.session import materialized

PARALLEL_FITS = 4

# Parameters of the named forecasters.
FOREST = {"numTrees": 200, "maxDepth": 15, "minInstancesPerNode": 2, "seed": 42}
SMALL_FOREST = {"numTrees": 100, "maxDepth": 10, "seed": 42}
QUICK_FOREST = {"numTrees": 10, "maxDepth": 5, "seed": 42}
RESAMPLES = 100
RIDGE_ALPHA = 1.0
BOOSTING_SPREAD = 0.02


def estimator(kind: str, rows: int, label_std: float, params: dict | None = None) -> Estimator:
    """Regressor of a forecaster kind.

    The ridge penalty is given for the summed loss; Spark takes it for the loss per row of
    the label divided by its deviation, hence ``rows`` and ``label_std``.
    """
    if kind == "random_forest":
        return RandomForestRegressor(featureSubsetStrategy="all", **{**FOREST, **(params or {})})
    if kind == "linear":
        return LinearRegression(standardization=False, **(params or {}))
    if kind == "ridge":
        penalty = RIDGE_ALPHA / rows * (label_std or 1.0)
        return LinearRegression(regParam=penalty, elasticNetParam=0.0, standardization=False, **(params or {}))
    raise ValueError(f"unknown forecaster kind: {kind}")


@dataclass(frozen=True)
class Forecaster:
    """A fitted pipeline with one regressor per horizon, and what it needs to be applied."""

    kind: str
    features: tuple[str, ...]
    horizons: tuple[int, ...]
    pipeline: PipelineModel

    @property
    def regressors(self) -> dict[int, Model]:
        return dict(zip(self.horizons, self.pipeline.stages[2:], strict=True))

    def wide(self, table: DataFrame) -> DataFrame:
        """``table`` with a column ``prediction_<h>`` for each horizon."""
        return self.pipeline.transform(table)

    def _vectors(self, table: DataFrame) -> DataFrame:
        reconcile(table, self.features)
        return PipelineModel(self.pipeline.stages[:2]).transform(table)

    def predict(self, table: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
        """Long ``(series, ts, horizon, prediction)``."""
        reconcile(table, self.features)
        wide = self.pipeline.transform(table)
        pairs = [
            F.struct(F.lit(h).alias("horizon"), F.col(f"prediction_{h}").alias("prediction")) for h in self.horizons
        ]
        return wide.select("series", "ts", *keep, F.inline(F.array(*pairs)))

    def tree_members(self, table: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
        """Long rows with the sorted predictions of the single trees as ``members``."""
        stages = [m.copy().setLeafCol(f"_leaf_{h}") for h, m in self.regressors.items()]
        voted = PipelineModel(stages).transform(self._vectors(table))

        def members(h: int, forest: Model) -> Column:
            # one vector of leaf numbers for a row; the leaves' values are one literal
            values = F.from_json(F.lit(json.dumps([leaf_values(t) for t in forest.trees])), "array<array<double>>")
            leaves = vector_to_array(F.col(f"_leaf_{h}"))
            return F.sort_array(F.transform(leaves, lambda leaf, tree: F.get(F.get(values, tree), leaf.cast("int"))))

        pairs = [
            F.struct(F.lit(h).alias("horizon"), F.col(f"prediction_{h}").alias("prediction"), members(h, m).alias("members"))
            for h, m in self.regressors.items()
        ]
        return voted.select("series", "ts", *keep, F.inline(F.array(*pairs)))

    def importances(self, spark: SparkSession) -> DataFrame:
        """Long ``(feature, horizon, importance)``: one row per model and feature."""
        rows = [
            (name, h, float(value))
            for h, model in self.regressors.items()
            for name, value in zip(self.features, model.featureImportances.toArray(), strict=True)
        ]
        return spark.createDataFrame(rows, "feature string, horizon int, importance double")


def leaf_values(tree: Model) -> list[float]:
    """Predictions of a tree's leaves, in the order of their numbers: left before right."""
    return [float(x) for x in re.findall(r"Predict: (\S+)", tree.toDebugString)]


def vectorizer(train: DataFrame, features: Sequence[str]) -> PipelineModel:
    """Robust scaling learned on the training rows, then one feature vector."""
    scale = scaling.robust_scaling(train, features)
    return PipelineModel(
        [
            SQLTransformer(statement=scale.statement()),
            VectorAssembler(inputCols=[f"scaled_{c}" for c in features], outputCol="vector"),
        ]
    )


def fit(
    train: DataFrame,
    spec: FeatureSpec,
    kind: str = "random_forest",
    params: dict | None = None,
    vectors: PipelineModel | None = None,
) -> Forecaster | boosting.Boosted:
    """One regressor per horizon over the same vectors, fitted side by side; boosting needs no scaling and has a class of its own."""
    if kind == "boosting":
        return boosting.fit(train, spec.features, spec.horizons, boosting.Params(**(params or {})))
    vectors = vectors or vectorizer(train, spec.features)
    ready = vectors.transform(train).select("vector", *spec.targets).persist()
    stats = ready.agg(F.count(F.lit(1)).alias("rows"), *[F.stddev_pop(t).alias(t) for t in spec.targets]).first()

    def fit_horizon(h: int) -> Model:
        one = estimator(kind, stats["rows"], stats[f"target_{h}"], params)
        one.setFeaturesCol("vector").setLabelCol(f"target_{h}").setPredictionCol(f"prediction_{h}")
        return one.fit(ready)

    with ThreadPool(PARALLEL_FITS) as pool:
        fitted = pool.map(fit_horizon, spec.horizons)
    ready.unpersist()
    return Forecaster(kind, tuple(spec.features), tuple(spec.horizons), PipelineModel([*vectors.stages, *fitted]))


def mean_importance(importances: DataFrame, top: int = 20) -> DataFrame:
    """Features by importance averaged over horizons."""
    mean = importances.groupBy("feature").agg(F.avg("importance").alias("importance"))
    return mean.orderBy(F.desc("importance"), "feature").limit(top)


def fallback_quantiles(predictions: DataFrame, quantiles: Sequence[float] = QUANTILES) -> DataFrame:
    """Quantiles for a forecaster without members: a spread of 2 % of the level per unit of q around it."""
    p = F.col("prediction")

    def value(q: float) -> Column:
        return p + F.abs(p) * BOOSTING_SPREAD * (q - 0.5)

    pairs = [F.struct(F.lit(q).alias("q"), value(q).alias("value")) for q in quantiles]
    return predictions.select("series", "ts", "horizon", F.inline(F.array(*pairs)))


@dataclass(frozen=True)
class Resampled:
    """Ridge forecasters on resamples of one table: intercepts [resample, horizon] and weights [resample, horizon, feature] of scaled features."""

    features: tuple[str, ...]
    horizons: tuple[int, ...]
    scale: scaling.Scaling
    intercepts: np.ndarray
    weights: np.ndarray

    def members(self, table: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
        """Long rows with the sorted forecasts of the resamples as ``members``."""
        model = self
        scaled = [self.scale.column(c).alias(f"_x_{c}") for c in self.features]
        rows = table.select("series", "ts", *keep, *scaled)
        told = rows.select("series", "ts", *keep).schema
        schema = StructType([*told.fields, StructField("horizon", IntegerType()), StructField("members", ArrayType(DoubleType()))])

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                x = np.stack([batch.column(f"_x_{c}").to_numpy(zero_copy_only=False) for c in model.features], axis=1)
                base = [batch.column(k) for k in range(len(told))]
                for h, horizon in enumerate(model.horizons):
                    found = np.sort(x @ model.weights[:, h].T + model.intercepts[:, h], axis=1)
                    edges = pa.array(np.arange(len(x) + 1, dtype=np.int32) * found.shape[1])
                    listed = pa.ListArray.from_arrays(edges, pa.array(found.ravel()))
                    yield pa.RecordBatch.from_arrays([*base, pa.array(np.full(len(x), horizon, np.int32)), listed], schema.fieldNames())

        return rows.mapInArrow(run, schema)


def poisson_weights(key: Column, resamples: int) -> Column:
    """How often each resample takes a row: draws of the Poisson distribution of mean 1, a function of the row's key alone."""
    cuts = np.cumsum([math.exp(-1) / math.factorial(k) for k in range(10)])
    levels = F.array(*[F.lit(math.floor(c * PRIME)) for c in cuts])
    return F.transform(uniform_draws(key, resamples), lambda u: F.size(F.filter(levels, lambda c: u >= c)))


def ridge_bootstrap(train: DataFrame, spec: FeatureSpec, resamples: int = RESAMPLES, alpha: float = RIDGE_ALPHA, seed: int = 42) -> Resampled:
    """Ridge forecasters on ``resamples`` resamples with replacement, in one pass over the rows.

    A row's number of copies in each resample comes from the hash of its key, so resamples need no table and no second reading, and
    do not depend on partitions. The sums of all resamples are one product of matrices in each task. Scaling is learned once.
    """
    scale = scaling.robust_scaling(train, spec.features)
    scaled = train.select("series", "ts", *spec.targets, *[scale.column(c).alias(c) for c in spec.features])
    centers = regression.centers_of(scaled, [*spec.features, *spec.targets])
    problem = regression.Problem(centers, len(spec.features), len(spec.targets), alpha)
    weights = poisson_weights(draw_key(seed, F.col("series"), F.unix_seconds("ts")), resamples)
    sums = regression.summaries(scaled, F.lit(0), spec.features, spec.targets, centers, weights)
    fits = sorted(regression.solved(sums, problem).collect(), key=lambda r: r.part)  # resamples x horizons x features numbers
    intercepts = np.array([[f.intercept for f in r.fits] for r in fits])
    return Resampled(tuple(spec.features), tuple(spec.horizons), scale, intercepts, np.array([[f.weights for f in r.fits] for r in fits]))


def bootstrap(
    train: DataFrame, spec: FeatureSpec, resamples: int = RESAMPLES, kind: str = "random_forest", params: dict | None = None
) -> list[Forecaster]:
    """Forecasters of any kind fitted on resamples one after another; scaling is learned once on all rows."""
    vectors = vectorizer(train, spec.features)
    return [
        fit(train.sample(withReplacement=True, fraction=1.0, seed=i), spec, kind, params, vectors)
        for i in range(resamples)
    ]


def bootstrap_members(forecasters: Sequence[Forecaster], table: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """Long rows with one member per resampled forecaster, computed in a single pass."""
    first = forecasters[0]
    stages = list(first.pipeline.stages[:2])
    for i, f in enumerate(forecasters):
        stages += [m.copy().setPredictionCol(f"_member_{h}_{i}") for h, m in f.regressors.items()]
    wide = PipelineModel(stages).transform(table)

    def members(h: int) -> Column:
        return F.sort_array(F.array(*[f"_member_{h}_{i}" for i in range(len(forecasters))]))

    pairs = [F.struct(F.lit(h).alias("horizon"), members(h).alias("members")) for h in first.horizons]
    return wide.select("series", "ts", *keep, F.inline(F.array(*pairs)))


def evaluate(model: Forecaster, table: DataFrame, by: Sequence[str] = ("horizon",)) -> DataFrame:
    """Errors per horizon, predictions matched with targets by key."""
    targets = [
        F.struct(F.lit(h).alias("horizon"), F.col(f"target_{h}").alias("actual")) for h in model.horizons
    ]
    wide = model.wide(table)
    pairs = F.arrays_zip(
        F.array(*targets).alias("t"), F.array(*[F.col(f"prediction_{h}") for h in model.horizons]).alias("p")
    )
    long = wide.select("series", "ts", F.explode(pairs).alias("r")).select(
        "series", "ts", F.col("r.t.horizon").alias("horizon"), F.col("r.t.actual").alias("actual"),
        F.col("r.p").alias("prediction"),
    )
    return metrics.error_metrics(long, by).withColumn("model", F.lit(model.kind))


def quick_train(
    bars: DataFrame,
    layout: Layout,
    spec: FeatureSpec,
    kind: str = "random_forest",
    params: dict | None = None,
) -> tuple[Forecaster, DataFrame]:
    """Fit a small forest on the first 80 % of the bars of each series; returns the held-out rows, too."""
    table = clean_rows(simple_features(bars, layout, spec.horizons), spec)
    parts = materialized(splits.positional_split(table, layout), "quick")
    model = fit(parts.where("part = 'train'"), spec, kind, params or QUICK_FOREST)
    return model, parts.where("part = 'test'").drop("part")


FitOne = Callable[[DataFrame], Forecaster]


def rolling_scores(
    table: DataFrame,
    spec: FeatureSpec,
    train_days: int = 7,
    test_days: int = 1,
    step_days: int = 1,
    min_train_rows: int = 1000,
    alpha: float = RIDGE_ALPHA,
) -> DataFrame:
    """Errors of a ridge forecaster fitted anew on every sliding window over all series, features in units of their deviation there.

    The windows' fits come from sums by day (see ``operators.regression``): rows are not read once for each window, and the
    driver walks nothing. ``table`` is read several times: hand in a stored one.
    """
    unit = math.gcd(train_days, test_days, step_days)
    train, test, step = train_days // unit, test_days // unit, step_days // unit
    seconds = unit * splits.DAY
    span = table.agg(F.unix_seconds(F.min("ts")).alias("first"), F.unix_seconds(F.max("ts")).alias("last")).first()
    first, room = span.first or 0, (span.last or 0) - (span.first or 0) - (train + test) * seconds
    windows = table.sparkSession.range(room // (step * seconds) + 1 if room >= 0 else 0).withColumnRenamed("id", "split")
    part = F.expr(f"(unix_seconds(ts) - {first}) div {seconds}")
    trains = windows.select("split", F.explode(F.sequence(F.col("split") * step, F.col("split") * step + train - 1)).alias("part"))
    low = F.greatest(F.lit(0).cast("bigint"), F.ceil((part - train - test + 1) / step))
    high = F.floor((part - train) / step)
    tests = F.when(low <= high, F.sequence(low, F.greatest(low, high)))
    scored = regression.cross_validated(table, part, trains, tests, spec.features, spec.horizons, alpha=alpha, min_rows=min_train_rows)
    start = F.lit(first) + F.col("split") * step * seconds
    middle, end = start + train * seconds, start + (train + test) * seconds
    bounds = {"train_start": start, "train_end": middle, "test_start": middle, "test_end": end}
    told = scored.withColumns({k: F.timestamp_seconds(c) for k, c in bounds.items()}).withColumn("model", F.lit("ridge"))
    # numbers of the windows that are kept, without a gap
    kept = scored.select("split").distinct().withColumn("_number", F.row_number().over(Window.orderBy("split")))
    return told.join(kept, "split").withColumn("split", F.col("_number")).drop("_number")


def walk_forward_scores(
    table: DataFrame, spec: FeatureSpec, layout: Layout, n_splits: int = 5, test_size: float = 0.2, alpha: float = 0.0
) -> DataFrame:
    """Errors of a linear forecaster in expanding-window validation by row position, the same share of every series in each split.

    A row trains for the first few splits, as they reach back less and less, so sums by that number of splits make all fits.
    """
    placed = materialized(positions(table, layout), "placed")
    sizes = placed.groupBy("series").agg((F.max("pos") + 1).alias("size"))
    cut = F.struct("split", F.col("test_start_pos").alias("begin"), F.col("test_end_pos").alias("end"))
    cuts = splits.walk_forward_splits(sizes, n_splits, test_size).groupBy("series").agg(F.collect_list(cut).alias("_cuts"))
    rows = materialized(attach(placed, cuts), "placed")
    trained = F.array_max(F.transform(F.filter("_cuts", lambda c: F.col("pos") < c["begin"]), lambda c: c["split"]))
    tests = F.transform(F.filter("_cuts", lambda c: (F.col("pos") >= c["begin"]) & (F.col("pos") < c["end"])), lambda c: c["split"])
    numbers = table.sparkSession.range(1, n_splits + 1)
    trains = numbers.select(F.col("id").alias("part"), F.explode(F.sequence(F.lit(1).cast("bigint"), "id")).alias("split"))
    scored = regression.cross_validated(rows, trained, trains, tests, spec.features, spec.horizons, alpha=alpha)
    return scored.withColumn("split", F.col("split").cast("int")).withColumn("model", F.lit("linear"))


def rolling_validation(
    table: DataFrame,
    fit_one: FitOne,
    train_days: int = 7,
    test_days: int = 1,
    step_days: int = 1,
    min_train_rows: int = 1000,
) -> DataFrame:
    """Fit and score a fresh forecaster on every sliding window over all series.

    The driver walks the split table (one row per window); rows stay distributed, and each
    window reads its own time range only.
    """
    pooled = table.select(F.lit("all").alias("series"), "ts")
    windows = splits.rolling_splits(pooled, train_days, test_days, step_days, min_train_rows).orderBy("split").collect()
    tested = [F.sum(((F.col("ts") >= w.test_start) & (F.col("ts") < w.test_end)).cast("bigint")).alias(f"_{w.split}") for w in windows]
    counts = table.agg(F.count(F.lit(1)), *tested).first()
    out = []
    for w in windows:
        train = table.where((F.col("ts") >= w.train_start) & (F.col("ts") < w.train_end))
        test = table.where((F.col("ts") >= w.test_start) & (F.col("ts") < w.test_end))
        scored = evaluate(fit_one(train), test)
        out.append(
            scored.select(
                "*",
                F.lit(w.split).alias("split"),
                *[F.lit(w[c]).alias(c) for c in ("train_start", "train_end", "test_start", "test_end")],
                F.lit(w.train_samples).alias("train_samples"),
                F.lit(counts[f"_{w.split}"]).alias("test_samples"),
            )
        )
    return _stacked(out)


def walk_forward(
    table: DataFrame, fit_one: FitOne, layout: Layout, n_splits: int = 5, test_size: float = 0.2
) -> DataFrame:
    """Expanding-window validation by row position, the same share of every series in each split."""
    placed = materialized(positions(table, layout), "placed")
    sizes = placed.groupBy("series").agg((F.max("pos") + 1).alias("size"))
    cuts = splits.walk_forward_splits(sizes, n_splits, test_size).drop("train_rows")
    out = []
    for i in range(1, n_splits + 1):
        rows = materialized(attach(placed, cuts.where(F.col("split") == i)), "split")
        train, test = rows.where("pos < test_start_pos"), rows.where("pos >= test_start_pos and pos < test_end_pos")
        counts = {"train_samples": train.count(), "test_samples": test.count()}
        if not counts["train_samples"]:
            break
        scored = evaluate(fit_one(train), test).withColumn("split", F.lit(i))
        out.append(scored.withColumns({k: F.lit(v) for k, v in counts.items()}))
    return _stacked(out)


def _stacked(parts: Iterable[DataFrame]) -> DataFrame:
    parts = list(parts)
    if not parts:
        raise ValueError("no split has enough rows")
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def save(model: Forecaster | boosting.Boosted, spark: SparkSession, path: str) -> None:
    """Pipeline (or trees) and its description side by side; the kind is stored, not read off the path."""
    if isinstance(model, boosting.Boosted):
        spark.createDataFrame([(model.dumped(),)], "trees string").write.mode("overwrite").text(f"{path}/trees")
    else:
        model.pipeline.write().overwrite().save(f"{path}/pipeline")
    about = json.dumps({"kind": model.kind, "features": model.features, "horizons": model.horizons})
    spark.createDataFrame([(about,)], "about string").write.mode("overwrite").text(f"{path}/about")


def load(spark: SparkSession, path: str) -> Forecaster | boosting.Boosted:
    about = json.loads(spark.read.text(f"{path}/about").first()[0])
    if about["kind"] == "boosting":
        return boosting.Boosted.loaded(spark.read.text(f"{path}/trees").first()[0])
    pipeline = PipelineModel.load(f"{path}/pipeline")
    return Forecaster(about["kind"], tuple(about["features"]), tuple(about["horizons"]), pipeline)


def stored_features(spark: SparkSession, path: str) -> DataFrame:
    """Kind, position and name of the features a stored model was fitted on."""
    about = F.from_json("value", "kind string, features array<string>, horizons array<int>")
    return (
        spark.read.text(f"{path}/about")
        .select(about.alias("a"))
        .select("a.kind", F.posexplode("a.features").alias("position", "feature"))
    )
