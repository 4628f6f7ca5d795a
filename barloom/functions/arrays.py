"""Quantiles and distribution functions over array columns."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

GRID_POINTS = 99  # quantile levels 0.01 .. 0.99


def sorted_quantile(values: Column, q: Column | float) -> Column:
    """Linearly interpolated quantile of an ascending, NULL-free array."""
    rank = (q if isinstance(q, Column) else F.lit(float(q))) * (F.size(values) - 1)
    low = F.floor(rank).cast("int")
    high = F.ceil(rank).cast("int")
    a = F.get(values, low)
    b = F.get(values, high)
    return a + (b - a) * (rank - low)


def array_quantile(values: Column, q: Column | float) -> Column:
    return sorted_quantile(F.sort_array(values), q)


def evenly_spaced(start: float, stop: float, points: int) -> Column:
    """``points`` values from ``start`` to ``stop`` inclusive."""
    step = (stop - start) / (points - 1)
    return F.transform(F.sequence(F.lit(0), F.lit(points - 1)), lambda k: F.lit(start) + k * F.lit(step))


def quantile_grid(sorted_values: Column) -> Column:
    """The 99 percentiles of an ascending array: the predictive distribution of one forecast."""
    return F.transform(
        F.sequence(F.lit(1), F.lit(GRID_POINTS)),
        lambda k: sorted_quantile(sorted_values, k / F.lit(100.0)),
    )


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of ``value``, computed once however often the body uses it.

    A plain column would be copied into every place that uses it when the optimizer merges
    projections or moves a filter below them.
    """
    return F.get(F.transform(F.array(value), body), F.lit(0))


def ensemble_cdf(members: Column, threshold: Column) -> Column:
    """P(x < threshold) for x drawn by inverting the percentile grid of ascending ``members``.

    With m grid values below the threshold the probability is 0 for m = 0, 1 for m = 99, else
    (m + share of segment m .. m+1 below the threshold) / 100. The grid itself is never built:
    the members give the level at which their quantile line crosses the threshold, hence m,
    and only the two ends of that segment are interpolated.
    """
    n = F.size(members)

    def segment(count: Column) -> Column:
        a, b = F.get(members, count - 1), F.get(members, count)
        level = (count - 1 + F.try_divide(threshold - a, b - a)) / (n - 1)
        m = F.least(F.greatest(F.ceil(level * 100) - 1, F.lit(0)), F.lit(GRID_POINTS))
        return F.when(count == 0, F.lit(0)).when(count == n, F.lit(GRID_POINTS)).otherwise(m)

    def probability(m: Column) -> Column:
        def share(a: Column) -> Column:
            b = sorted_quantile(members, (m + 1) / 100)
            return F.coalesce(let(b, lambda top: F.try_divide(threshold - a, top - a)), F.lit(0.0))

        part = F.least(F.greatest(let(sorted_quantile(members, m / 100), share), F.lit(0.0)), F.lit(1.0))
        return F.when(m == 0, F.lit(0.0)).when(m == GRID_POINTS, F.lit(1.0)).otherwise((m + part) / 100)

    return let(let(F.size(F.filter(members, lambda v: v < threshold)), segment), probability)


def interpolate(x: Column, xs: Column, ys: Column) -> Column:
    """Piecewise-linear ``y(x)`` through ascending ``xs``, clamped at both ends."""
    below = F.size(F.filter(xs, lambda v: v < x))
    n = F.size(xs)
    x0, x1 = F.get(xs, below - 1), F.get(xs, below)
    y0, y1 = F.get(ys, below - 1), F.get(ys, below)
    return (
        F.when(below == 0, F.get(ys, F.lit(0)))
        .when(below == n, F.get(ys, n - 1))
        .otherwise(y0 + (y1 - y0) * (x - x0) / (x1 - x0))
    )
