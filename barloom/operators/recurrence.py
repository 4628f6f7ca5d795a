"""Exponential smoothing x[t] = (1-a) x[t-1] + a v[t] as window sums.

Inside a block of rows the recurrence is a running sum of v / (1-a)^k scaled back by (1-a)^k.
Blocks are chained through the last values of the few blocks before them; older ones have
faded below the precision of a double. The same fading lets a chunk start from a bounded
number of earlier rows instead of the start of the series.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from barloom.operators.layout import BLOCK

FADED = 41.0  # exp(-41) is below half an ulp of the result


@dataclass(frozen=True)
class Smooth:
    """One smoothed column: starts at row ``start`` of the series with the value itself."""

    name: str
    value: Column
    alpha: float
    start: int = 0

    @property
    def decay(self) -> float:
        return -math.log1p(-self.alpha)


def memory_rows(alpha: float) -> int:
    """Rows after which an old value no longer shows at this smoothing factor."""
    return math.ceil(FADED / -math.log1p(-alpha))


def with_smoothed(df: DataFrame, w: WindowSpec, specs: Sequence[Smooth]) -> DataFrame:
    """Add the smoothed columns; ``df`` and ``w`` come from ``layout.over_chunks``.

    Values must not be NULL from row ``start`` on.
    """
    for s in specs:
        if s.decay * BLOCK > 600:
            raise ValueError(f"alpha {s.alpha} is too close to 1 for blocks of {BLOCK} rows")
    block = (
        Window.partitionBy("series", "_chunk", "_block")
        .orderBy("pos")
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    k = F.pmod(F.col("pos"), F.lit(BLOCK)).cast("double")

    def weight(s: Smooth) -> Column:
        return F.when(F.col("pos") == s.start, F.lit(1.0)).otherwise(F.lit(s.alpha))

    local = {
        f"_local_{s.name}": F.exp(k * -s.decay)
        * F.sum(
            F.when(F.col("pos") >= s.start, weight(s) * s.value * F.exp(k * s.decay)).otherwise(F.lit(0.0))
        ).over(block)
        for s in specs
    }
    df = df.withColumns(local)

    def carried(s: Smooth) -> Column:
        ends = [
            F.coalesce(F.lag(f"_local_{s.name}", 1 + i * BLOCK).over(w), F.lit(0.0))
            * math.exp(-s.decay * BLOCK * i)
            for i in range(math.ceil(memory_rows(s.alpha) / BLOCK) + 1)
        ]
        return F.when(k == 0, sum(ends[1:], ends[0]))

    df = df.withColumns({f"_carry_{s.name}": carried(s) for s in specs})
    smoothed = {
        s.name: F.when(
            F.col("pos") >= s.start,
            F.col(f"_local_{s.name}")
            + F.exp((k + 1) * -s.decay)
            * F.coalesce(F.first(f"_carry_{s.name}", ignorenulls=True).over(block), F.lit(0.0)),
        )
        for s in specs
    }
    return df.withColumns(smoothed).drop(*[f"_{p}_{s.name}" for s in specs for p in ("local", "carry")])
