"""Lags, targets and rolling statistics over row frames.

Frames need all their rows: a statistic is NULL until N values are present.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, WindowSpec
from pyspark.sql import functions as F

# Default lag, window and horizon lists.
LAGS = (1, 2, 3, 5, 10, 15, 30, 60)
WINDOWS = (5, 10, 15, 30, 60, 120, 240)
HORIZONS = tuple(range(1, 21))

MOMENTS = ("mean", "m2", "m3", "m4", "min", "max")


def trailing(w: WindowSpec, rows: int) -> WindowSpec:
    return w.rowsBetween(-(rows - 1), 0)


def full(w: WindowSpec, rows: int, value: Column, stat: Column) -> Column:
    """``stat`` over the trailing frame, NULL unless all ``rows`` values are there."""
    frame = trailing(w, rows)
    return F.when(F.count(F.nanvl(value, F.lit(None).cast("double"))).over(frame) == rows, stat.over(frame))


def lag_columns(w: WindowSpec, column: str = "close", lags: Sequence[int] = LAGS) -> dict[str, Column]:
    return {f"{column}_lag_{k}": F.lag(column, k).over(w) for k in lags}


def target_columns(w: WindowSpec, column: str = "close", horizons: Sequence[int] = HORIZONS) -> dict[str, Column]:
    return {f"target_{h}": F.lead(column, h).over(w) for h in horizons}


def change_columns(w: WindowSpec, column: str, steps: dict[str, int]) -> dict[str, Column]:
    """Relative change against the value ``k`` rows back; NULL where that is 0."""
    return {name: F.try_divide(F.col(column), F.lag(column, k).over(w)) - 1 for name, k in steps.items()}


def _split(rows: int, built: Sequence[int]) -> tuple[int, int] | None:
    """Two already built frame lengths that add up to ``rows``, the longer one first."""
    for older in sorted(built, reverse=True):
        if rows - older in built:
            return older, rows - older
    return None


def _frame_moments(w: WindowSpec, column: str, n: int) -> dict[str, Column]:
    x = F.col(column)
    m2 = F.var_pop(x).over(trailing(w, n)) * n
    flat = F.min(x).over(trailing(w, n)) == F.max(x).over(trailing(w, n))
    complete = F.count(x).over(trailing(w, n)) == n
    shape3 = F.skewness(x).over(trailing(w, n)) * F.pow(m2, F.lit(1.5)) / math.sqrt(n)
    shape4 = (F.kurtosis(x).over(trailing(w, n)) + 3) * m2 * m2 / n
    zero = F.lit(0.0)
    return {
        "mean": F.when(complete, F.avg(x).over(trailing(w, n))),
        "m2": F.when(complete, F.when(flat, zero).otherwise(m2)),
        "m3": F.when(complete, F.when(flat, zero).otherwise(shape3)),
        "m4": F.when(complete, F.when(flat, zero).otherwise(shape4)),
        "min": F.when(complete, F.min(x).over(trailing(w, n))),
        "max": F.when(complete, F.max(x).over(trailing(w, n))),
    }


def _merged_moments(w: WindowSpec, column: str, a: int, b: int) -> dict[str, Column]:
    """Moments of the last a+b rows from those of the last b rows and the a rows before them.

    The pairwise update is the one partial aggregation uses, so it does not cancel the way
    differences of running sums do.
    """
    n = a + b
    old = {k: F.lag(f"_{column}_{k}_{a}", b).over(w) for k in MOMENTS}
    new = {k: F.col(f"_{column}_{k}_{b}") for k in MOMENTS}
    d = new["mean"] - old["mean"]
    return {
        "mean": old["mean"] + d * (b / n),
        "m2": old["m2"] + new["m2"] + d * d * (a * b / n),
        "m3": old["m3"]
        + new["m3"]
        + d * d * d * (a * b * (a - b) / n**2)
        + d * (new["m2"] * a - old["m2"] * b) * (3 / n),
        "m4": old["m4"]
        + new["m4"]
        + d * d * d * d * (a * b * (a * a - a * b + b * b) / n**3)
        + d * d * (new["m2"] * (a * a) + old["m2"] * (b * b)) * (6 / n**2)
        + d * (new["m3"] * a - old["m3"] * b) * (4 / n),
        # least/greatest skip NULLs; an incomplete half must leave the frame incomplete
        "min": F.when(old["min"].isNotNull() & new["min"].isNotNull(), F.least(old["min"], new["min"])),
        "max": F.when(old["max"].isNotNull() & new["max"].isNotNull(), F.greatest(old["max"], new["max"])),
    }


def _frame_run(w: WindowSpec, column: str, n: int) -> Column:
    return F.sort_array(F.collect_list(column).over(trailing(w, n)))


def _merged_run(w: WindowSpec, column: str, a: int, b: int) -> Column:
    """The last a+b values in order, from two runs that are already sorted."""
    return F.sort_array(F.concat(F.lag(f"_{column}_run_{a}", b).over(w), F.col(f"_{column}_run_{b}")))


def with_frames(df: DataFrame, w: WindowSpec, column: str, windows: Sequence[int], *, moments: bool, runs: bool) -> DataFrame:
    """Add hidden moment columns and sorted runs ``_<column>_<moment>_<N>`` for every frame length.

    Long frames are put together from two shorter ones where the lengths allow it
    (240 = 120 + 120), which costs one lag per row instead of visiting N rows per row.
    """
    built: list[int] = []
    for n in sorted(set(windows)):
        parts = _split(n, built)
        hidden: dict[str, Column] = {}
        if moments:
            found = _frame_moments(w, column, n) if parts is None else _merged_moments(w, column, *parts)
            hidden |= {f"_{column}_{k}_{n}": c for k, c in found.items()}
        if runs:
            hidden[f"_{column}_run_{n}"] = (
                _frame_run(w, column, n) if parts is None else _merged_run(w, column, *parts)
            )
        df = df.withColumns(hidden)
        built.append(n)
    return df


def rolling_columns(column: str, n: int) -> dict[str, Column]:
    """Statistics of one frame length from its moments (all but the median)."""
    m = {k: F.col(f"_{column}_{k}_{n}") for k in MOMENTS}
    flat = m["min"] == m["max"]
    x = F.col(column)
    std = F.when(flat, F.lit(0.0)).otherwise(F.sqrt(m["m2"] / (n - 1)))
    g1 = math.sqrt(n) * m["m3"] / F.pow(m["m2"], F.lit(1.5))
    g2 = n * m["m4"] / (m["m2"] * m["m2"]) - 3
    skew = F.when(flat, F.lit(0.0)).otherwise(g1 * (math.sqrt(n * (n - 1)) / (n - 2)))
    kurt = F.when(flat, F.lit(-3.0)).otherwise((g2 * (n + 1) + 6) * ((n - 1) / ((n - 2) * (n - 3))))
    return {
        f"{column}_ma_{n}": m["mean"],
        f"{column}_std_{n}": std,
        f"{column}_min_{n}": m["min"],
        f"{column}_max_{n}": m["max"],
        f"{column}_skew_{n}": skew,
        f"{column}_kurt_{n}": kurt,
        f"{column}_rel_ma_{n}": F.try_divide(x, m["mean"]),
        f"{column}_zscore_{n}": F.try_divide(x - m["mean"], std),
        f"{column}_range_{n}": m["max"] - m["min"],
    }


def median_column(column: str, n: int) -> Column:
    run = F.col(f"_{column}_run_{n}")
    middle = F.get(run, F.lit((n - 1) // 2)) + F.get(run, F.lit(n // 2))
    return F.when(F.size(run) == n, middle / 2)


def rolling_names(column: str, windows: Sequence[int], stats: Sequence[str]) -> list[str]:
    return [f"{column}_{s}_{n}" for n in windows for s in stats]


def with_rolling(
    df: DataFrame, w: WindowSpec, column: str, windows: Sequence[int], stats: Sequence[str]
) -> DataFrame:
    """Add ``<column>_<stat>_<N>`` for the chosen statistics and frame lengths."""
    runs, moments = "median" in stats, set(stats) != {"median"}
    df = with_frames(df, w, column, windows, moments=moments, runs=runs)
    available: dict[str, Column] = {}
    for n in windows:
        available |= rolling_columns(column, n) if moments else {}
        available |= {f"{column}_median_{n}": median_column(column, n)} if runs else {}
    df = df.withColumns({name: available[name] for name in rolling_names(column, windows, stats)})
    return df.drop(*[f"_{column}_{k}_{n}" for k in (*MOMENTS, "run") for n in set(windows)])
