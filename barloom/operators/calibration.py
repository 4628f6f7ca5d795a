"""How well event probabilities match what happened."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from barloom.operators.metrics import present

BINS = 20
EPSILON = 1e-15
BY = ("query", "horizon")


def usable(probabilities: DataFrame) -> DataFrame:
    """Rows with a probability and a known outcome."""
    return probabilities.where(present(F.col("probability")) & F.col("event").isNotNull())


def bin_number(p: Column, bins: int = BINS) -> Column:
    """1-based bin of ``((k-1)/bins, k/bins]``; NULL for p = 0, which no bin holds.

    The arithmetic guess is checked against the exact bin edges.
    """
    guess = F.ceil(p * bins)
    exact = (
        F.when(p > guess / F.lit(float(bins)), guess + 1)
        .when(p <= (guess - 1) / F.lit(float(bins)), guess - 1)
        .otherwise(guess)
    )
    return F.when((p > 0) & (p <= 1), exact.cast("int"))


def scores(probabilities: DataFrame, by: Sequence[str] = BY) -> DataFrame:
    """Brier score, log loss and sample count per group."""
    p, e = F.col("probability"), F.col("event")
    clipped = F.greatest(F.least(p, F.lit(1 - EPSILON)), F.lit(EPSILON))
    loss = -(e * F.ln(clipped) + (1 - e) * F.ln(1 - clipped))
    return usable(probabilities).groupBy(*by).agg(
        F.avg(F.pow(p - e, F.lit(2))).alias("brier_score"),
        F.avg(loss).alias("log_loss"),
        F.count(F.lit(1)).alias("n_samples"),
    )


def _by_bin(probabilities: DataFrame, by: Sequence[str], bins: int) -> DataFrame:
    """Sums per bin: the only pass over the probabilities, combined map-side."""
    p, e = F.col("probability"), F.col("event")
    clipped = F.greatest(F.least(p, F.lit(1 - EPSILON)), F.lit(EPSILON))
    return (
        usable(probabilities)
        .withColumn("bin", bin_number(p, bins))
        .groupBy(*by, "bin")
        .agg(
            F.avg(p).alias("confidence"),
            F.avg(e).alias("accuracy"),
            F.count(F.lit(1)).alias("count"),
            F.sum(F.pow(p - e, F.lit(2))).alias("_brier"),
            F.sum(-(e * F.ln(clipped) + (1 - e) * F.ln(1 - clipped))).alias("_loss"),
        )
    )


def calibration_curve(probabilities: DataFrame, by: Sequence[str] = BY, bins: int = BINS) -> DataFrame:
    """Mean probability, hit rate and count of every non-empty bin."""
    edge = F.col("bin") / F.lit(float(bins))
    return _by_bin(probabilities, by, bins).where("bin is not null").select(
        *by,
        ((F.col("bin") - 1) / F.lit(float(bins))).alias("bin_lower"),
        edge.alias("bin_upper"),
        "confidence",
        "accuracy",
        "count",
    )


def calibration_metrics(probabilities: DataFrame, by: Sequence[str] = BY, bins: int = BINS) -> DataFrame:
    """Brier score, log loss, expected calibration error and sample count per group.

    The error weighs each bin by its share of all samples; those in no bin (p = 0) count
    toward the total only.
    """
    gap = F.abs(F.col("confidence") - F.col("accuracy")) * F.col("count")
    n = F.sum("count")
    return _by_bin(probabilities, by, bins).groupBy(*by).agg(
        (F.sum("_brier") / n).alias("brier_score"),
        (F.sum("_loss") / n).alias("log_loss"),
        (F.coalesce(F.sum(F.when(F.col("bin").isNotNull(), gap)), F.lit(0.0)) / n).alias("calibration_error"),
        n.alias("n_samples"),
    )
