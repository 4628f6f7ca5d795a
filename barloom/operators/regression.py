"""Linear and ridge regression from mergeable summaries.

All that a least-squares fit needs of its rows is sums of products, and those of two sets of rows add up. So rows are read once,
whatever the number of fits: sums are kept by the smallest part that fits share (a day, a stretch of positions, a resample), and
each fit adds up the parts it trains on. A summary is a few hundred numbers, so adding and solving is small work, done in Spark for
all fits side by side. Rows are scored in one more pass, each under the fits that test on it.

Sums are taken around given centers (any value near the mean), so that squares of large values don't swallow small differences.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from barloom.operators.layout import attach
from barloom.operators.metrics import error_columns

SUMMARY = "part long, cell int, value double"


def cells(features: int, targets: int) -> tuple[np.ndarray, np.ndarray]:
    """The products that are summed: pairs of (1, features, targets), but not those of two targets."""
    i, j = np.triu_indices(1 + features + targets)
    keep = (i <= features) & ((j <= features) | (i < j))
    return i[keep], j[keep]


def matrix_of(batch: pa.RecordBatch, columns: Sequence[str], centers: Sequence[float]) -> np.ndarray:
    """A column of ones, then the columns less their centers."""
    parts = [batch.column(c).to_numpy(zero_copy_only=False).astype(float) - m for c, m in zip(columns, centers, strict=True)]
    return np.stack([np.ones(batch.num_rows), *parts], axis=1)


def summaries(rows: DataFrame, part: Column, features: Sequence[str], targets: Sequence[str], centers: Sequence[float], weights: Column | None = None) -> DataFrame:
    """``SUMMARY`` rows: the sum of each product, by the row's ``part``.

    With ``weights``, an array of whole numbers in each row, part k holds all rows, each as often as its k-th weight says.
    """
    columns = [*features, *targets]
    i, j = cells(len(features), len(targets))
    weighted = weights is not None
    few = rows.select(*columns, part.cast("bigint").alias("_part"), *([weights.alias("_weights")] if weighted else []))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: dict[int, np.ndarray] = {}
        for batch in batches:
            if not batch.num_rows:
                continue
            z = matrix_of(batch, columns, centers)
            products = z[:, i] * z[:, j]
            if not weighted:
                own, at = np.unique(batch.column("_part").to_numpy(), return_inverse=True)
                sums = np.zeros((len(own), len(i)))
                np.add.at(sums, at, products)
            else:
                listed = batch.column("_weights")
                many = listed.flatten().to_numpy().reshape(batch.num_rows, -1).astype(float)
                own, sums = np.arange(many.shape[1]), many.T @ products
            for k, s in zip(own.tolist(), sums, strict=True):
                found[k] = found[k] + s if k in found else s
        for k, s in found.items():
            yield pa.RecordBatch.from_pydict({"part": np.full(len(s), k), "cell": np.arange(len(s), dtype=np.int32), "value": s})

    # as many rows as tasks, parts and products: Spark adds them up
    return few.mapInArrow(run, SUMMARY).groupBy("part", "cell").agg(F.sum("value").alias("value"))


@dataclass(frozen=True)
class Problem:
    """How fits are put: centers of features and targets, and the penalty on squared weights.

    The penalty is for the summed loss. With ``standard`` it is on weights of features divided by their own deviation in the fit.
    """

    centers: tuple[float, ...]
    features: int
    targets: int
    alpha: float = 0.0
    standard: bool = False

    def solve(self, sums: np.ndarray) -> tuple[int, np.ndarray, np.ndarray]:
        """Rows, intercepts [target] and weights [target, feature] from one summary."""
        d, size = self.features, 1 + self.features + self.targets
        full = np.zeros((size, size))
        i, j = cells(d, self.targets)
        full[i, j] = full[j, i] = sums
        n = full[0, 0]
        mean = full[0] / max(n, 1)
        moved = full - n * np.outer(mean, mean)
        xx, xy = moved[1 : d + 1, 1 : d + 1], moved[1 : d + 1, d + 1 :]
        penalty = np.diag(xx) / max(n, 1) if self.standard else np.ones(d)
        scale = np.sqrt(np.maximum(np.diag(xx), 1e-300))
        left = (xx + self.alpha * np.diag(penalty)) / np.outer(scale, scale)
        w = (np.linalg.lstsq(left, xy / scale[:, None], rcond=1e-12)[0] / scale[:, None]).T
        centers = np.asarray(self.centers)
        intercept = mean[d + 1 :] + centers[d:] - w @ (mean[1 : d + 1] + centers[:d])
        return int(round(n)), intercept, w


def solved(sums: DataFrame, problem: Problem) -> DataFrame:
    """``(part, rows, fits)`` from ``SUMMARY`` rows: an array of (intercept, weights) for each part, by target."""
    gathered = sums.groupBy("part").agg(F.array_sort(F.collect_list(F.struct("cell", "value"))).alias("sums"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.list_(pa.struct([("intercept", pa.float64()), ("weights", pa.list_(pa.float64()))]))
        for batch in batches:
            found = [problem.solve(np.array([c["value"] for c in one])) for one in batch.column(1).to_pylist()]
            fits = [[{"intercept": a, "weights": w} for a, w in zip(intercept.tolist(), weights.tolist(), strict=True)] for _, intercept, weights in found]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([n for n, _, _ in found], pa.int64()), pa.array(fits, kind)], ["part", "rows", "fits"])

    return gathered.mapInArrow(run, "part long, rows long, fits array<struct<intercept:double,weights:array<double>>>")


def centers_of(rows: DataFrame, columns: Sequence[str]) -> tuple[float, ...]:
    return tuple(v or 0.0 for v in rows.agg(*[F.avg(c) for c in columns]).first())


def cross_validated(
    rows: DataFrame,
    part: Column,
    trains: DataFrame,
    tests: Column,
    features: Sequence[str],
    horizons: Sequence[int],
    *,
    alpha: float = 0.0,
    min_rows: int = 1,
) -> DataFrame:
    """Errors ``(split, horizon, rmse, mae, mape, train_samples, test_samples)`` of one fit for each split.

    ``part`` is the part that a row trains in (NULL for none), ``trains`` names the parts of each split as ``(part, split)``, and
    ``tests`` is a row's array of the splits that test on it. Splits with fewer than ``min_rows`` training rows are left out.
    ``rows`` is read three times: hand in a stored table.
    """
    targets = [f"target_{h}" for h in horizons]
    centers = centers_of(rows, [*features, *targets])
    problem = Problem(centers, len(features), len(targets), alpha, standard=True)
    parts = summaries(rows.where(part.isNotNull()), part, features, targets, centers)
    sums = parts.join(trains, "part").groupBy(F.col("split").cast("bigint").alias("part"), "cell").agg(F.sum("value").alias("value"))
    fits = solved(sums, problem).where(F.col("rows") >= min_rows).select(F.col("part").alias("split"), F.col("rows").alias("train_samples"), "fits")
    inputs = F.array(*features)

    def forecast(fit: Column) -> Column:
        return F.aggregate(F.zip_with(fit["weights"], inputs, lambda w, x: w * x), fit["intercept"], lambda s, v: s + v)

    tested = attach(rows.withColumn("split", F.explode(tests.cast("array<bigint>"))), fits, ["split"])
    told = F.arrays_zip(
        F.array(*map(F.lit, horizons)).alias("horizon"), F.array(*targets).alias("actual"), F.transform("fits", forecast).alias("prediction")
    )
    long = tested.select("split", "train_samples", F.inline(told))
    errors = [c.alias(k) for k, c in error_columns(F.col("actual"), F.col("prediction")).items()]
    return long.groupBy("split", "horizon", "train_samples").agg(*errors, F.count(F.lit(1)).alias("test_samples"))
