"""Row positions and row-based windows for series of any length.

A window partitioned by series alone puts a whole series into one task. Here a series is
cut twice: by time slot to number its rows, then by row position into chunks that carry the
few rows a frame can reach beyond their edge. Both cuts are bounded by ``chunk_rows``.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

BLOCK = 512  # rows per recurrence block, see operators.recurrence


@dataclass(frozen=True)
class Layout:
    """Bar spacing and the most rows one window task should sort.

    Bars are unique per (series, ts) and at least ``step_seconds`` apart, so a time slot of
    ``step_seconds * chunk_rows`` never holds more than ``chunk_rows`` of them.
    """

    step_seconds: int = 60
    chunk_rows: int = 65_536

    @property
    def slot_seconds(self) -> int:
        return self.step_seconds * self.chunk_rows


def _slotted(bars: DataFrame, layout: Layout) -> DataFrame:
    """Bars with their time slot; an existing one is kept, and with it the partitioning by it."""
    if "_slot" in bars.columns:
        return bars
    return bars.withColumn("_slot", F.expr(f"unix_seconds(ts) div {layout.slot_seconds}"))


def with_previous(bars: DataFrame, layout: Layout, column: str, name: str) -> DataFrame:
    """Add the value one row back, also across slots. Keeps ``_slot`` for ``running_totals``."""
    slotted = _slotted(bars, layout)
    last = slotted.groupBy("series", "_slot").agg(F.max_by(column, "ts").alias("_last"))
    earlier = last.select(
        "series", "_slot", F.lag("_last").over(Window.partitionBy("series").orderBy("_slot")).alias("_before")
    )
    within = Window.partitionBy("series", "_slot").orderBy("ts")
    opening = F.row_number().over(within) == 1
    value = F.when(opening, F.col("_before")).otherwise(F.lag(column).over(within))
    return slotted.join(earlier, ["series", "_slot"]).withColumn(name, value).drop("_before")


def carried_forward(rows: DataFrame, layout: Layout, columns: Sequence[str]) -> DataFrame:
    """Replace NULLs by the last value before them, also across slots. Reads ``rows`` twice: hand in a stored table."""
    slotted = _slotted(rows, layout)
    last = slotted.groupBy("series", "_slot").agg(
        *[F.max_by(c, F.when(F.col(c).isNotNull(), F.col("ts"))).alias(c) for c in columns]
    )
    earlier = Window.partitionBy("series").orderBy("_slot").rowsBetween(Window.unboundedPreceding, -1)
    before = last.select("series", "_slot", *[F.last(c, ignorenulls=True).over(earlier).alias(f"_before_{c}") for c in columns])
    within = Window.partitionBy("series", "_slot").orderBy("ts").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    joined = slotted.join(before, ["series", "_slot"])
    filled = {c: F.coalesce(F.last(c, ignorenulls=True).over(within), F.col(f"_before_{c}")) for c in columns}
    return joined.withColumns(filled).select(*rows.columns)


def running_totals(bars: DataFrame, layout: Layout, totals: Mapping[str, Column]) -> DataFrame:
    """Add inclusive running sums per series in time order.

    Slot totals are map-side combined; only that small table is summed up per series. Rows
    then need a running sum inside their own slot plus the offset of the slots before it.
    """
    kept = [c for c in bars.columns if c != "_slot"]
    slotted = _slotted(bars, layout)
    per_slot = slotted.groupBy("series", "_slot").agg(*[F.sum(c).alias(f"_sum_{k}") for k, c in totals.items()])
    earlier = Window.partitionBy("series").orderBy("_slot").rowsBetween(Window.unboundedPreceding, -1)
    offsets = per_slot.select(
        "series",
        "_slot",
        *[F.sum(f"_sum_{k}").over(earlier).alias(f"_before_{k}") for k in totals],
    )
    within = (
        Window.partitionBy("series", "_slot").orderBy("ts").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    joined = slotted.join(offsets, ["series", "_slot"])
    return joined.select(
        *kept,
        *[(F.sum(c).over(within) + F.coalesce(F.col(f"_before_{k}"), F.lit(0))).alias(k) for k, c in totals.items()],
    )


def positions(bars: DataFrame, layout: Layout) -> DataFrame:
    """Add ``pos``: 0-based row number per series in time order."""
    numbered = running_totals(bars, layout, {"pos": F.lit(1)})
    return numbered.withColumn("pos", F.col("pos") - 1)


def over_chunks(
    bars: DataFrame,
    layout: Layout,
    before: int,
    after: int,
    build: Callable[[DataFrame, WindowSpec], DataFrame],
    *,
    columns: Sequence[str] | None = None,
    keep_position: bool = False,
    heavy: bool = False,
) -> DataFrame:
    """Run row-based window logic on overlapping chunks of each series.

    ``build(df, w)`` may use frames over ``w`` that reach ``before`` rows back and ``after``
    rows ahead. Rows near an edge are copied to the neighbour that needs them; copies are
    dropped again afterwards, so the result equals windows over the whole series.

    ``heavy`` marks work that costs far more per row than its bytes suggest: the number of
    tasks is then fixed, so that adaptive execution does not merge chunks by size.
    """
    kept = [c for c in (columns or bars.columns) if c != "pos"]
    placed = bars.select(*kept, "pos") if "pos" in bars.columns else positions(bars.select(*kept), layout)
    size = max(layout.chunk_rows, before + after, BLOCK)
    first = F.greatest(F.lit(0).cast("bigint"), F.expr(f"(pos - {after}) div {size}"))
    last = F.expr(f"(pos + {before}) div {size}")
    spread = placed.withColumn("_chunk", F.explode(F.sequence(first, last))).withColumn(
        "_block", F.expr(f"pos div {BLOCK}")
    )
    if heavy:
        tasks = int(bars.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        spread = spread.repartition(tasks, "series", "_chunk")
    w = Window.partitionBy("series", "_chunk").orderBy("_block", "pos")
    core = build(spread, w).where(F.expr(f"pos div {size} = _chunk"))
    return core.drop("_chunk", "_block", *([] if keep_position else ["pos"]))


def map_rows(
    bars: DataFrame,
    layout: Layout,
    before: int,
    after: int,
    function: Callable[[pd.DataFrame], pd.DataFrame],
    schema: str,
    *,
    columns: Sequence[str] | None = None,
) -> DataFrame:
    """Columns by a function of the caller's over consecutive rows, where Spark has no expression for it.

    ``function`` gets a stretch of one series in time order as a pandas frame with ``pos``, the row's number in its series. It returns
    as many rows, with the columns of ``schema``. What it says of a row may depend on ``before`` rows before and ``after`` rows
    behind it, no more: a series is cut into chunks that carry these neighbours, so the result is that over whole series
    while no task ever holds one.
    """
    kept = [c for c in (columns or bars.columns) if c != "pos"]
    added = StructType.fromDDL(schema)
    placed = bars.select(*kept, "pos") if "pos" in bars.columns else positions(bars.select(*kept), layout)
    size = max(layout.chunk_rows, before + after, 1)
    first, last = F.greatest(F.lit(0).cast("bigint"), F.expr(f"(pos - {after}) div {size}")), F.expr(f"(pos + {before}) div {size}")
    spread = placed.withColumn("_chunk", F.explode(F.sequence(first, last)))
    out = StructType([*placed.select(*kept).schema.fields, *added.fields])

    def run(key: tuple, chunk: pd.DataFrame) -> pd.DataFrame:
        chunk = chunk.sort_values("pos", ignore_index=True).drop(columns="_chunk")
        found = function(chunk)
        if len(found) != len(chunk):
            raise ValueError(f"the function returned {len(found)} rows for {len(chunk)}")
        own = (chunk["pos"] // size == key[1]).to_numpy()
        told = {n: found[n].to_numpy()[own] for n in added.fieldNames()}
        return chunk.loc[own, kept].assign(**told)

    return spread.groupBy("series", "_chunk").applyInPandas(run, out)


def attach(
    bars: DataFrame, per_key: DataFrame, keys: Sequence[str] = ("series",), *, how: str = "inner", salts: int = 16, spread: Sequence[str] = ("ts",)
) -> DataFrame:
    """Join values known per key onto rows; ``spread`` names columns in which the rows of one key differ.

    Small tables are broadcast by their measured size. Beyond that limit a hot key is spread
    over ``salts`` tasks, each with its own copy of the one-row-per-key side.
    """
    salted = per_key.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    keyed = bars.withColumn("_salt", F.pmod(F.xxhash64(*spread), F.lit(salts)).cast("int"))
    return keyed.join(salted, [*keys, "_salt"], how).drop("_salt")
