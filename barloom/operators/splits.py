"""Train/test splits as tables, and rows assigned to them by arithmetic."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from barloom.operators.layout import Layout, attach, positions

DAY = 86_400


def head(bars: DataFrame, rows: int, layout: Layout) -> DataFrame:
    """The first ``rows`` bars of each series."""
    return _end(bars, rows, layout, first=True)


def tail(bars: DataFrame, rows: int, layout: Layout) -> DataFrame:
    """The last ``rows`` bars of each series."""
    return _end(bars, rows, layout, first=False)


def _end(bars: DataFrame, rows: int, layout: Layout, *, first: bool) -> DataFrame:
    """Counts per time slot tell which slots hold the end of a series; only their rows are put in order."""
    slotted = bars.withColumn("_slot", F.expr(f"unix_seconds(ts) div {layout.slot_seconds}"))
    outwards = (lambda c: F.asc(c)) if first else (lambda c: F.desc(c))
    nearer = Window.partitionBy("series").orderBy(outwards("_slot")).rowsBetween(Window.unboundedPreceding, -1)
    counts = slotted.groupBy("series", "_slot").agg(F.count(F.lit(1)).alias("_n"))
    needed = counts.select("series", "_slot", F.coalesce(F.sum("_n").over(nearer), F.lit(0)).alias("_nearer")).where(F.col("_nearer") < rows)
    inside = Window.partitionBy("series", "_slot").orderBy(outwards("ts"))
    placed = slotted.join(needed, ["series", "_slot"]).withColumn("_number", F.row_number().over(inside) + F.col("_nearer"))
    return placed.where(F.col("_number") <= rows).select(*bars.columns)


def latest(bars: DataFrame) -> DataFrame:
    """The newest row of each series; stamps are unique within a series.

    The newest stamp is found first: an aggregate that carried whole rows would have to sort them.
    """
    newest = bars.groupBy("series").agg(F.max("ts").alias("_newest"))
    return attach(bars, newest).where(F.col("ts") == F.col("_newest")).drop("_newest")


def with_size(placed: DataFrame) -> DataFrame:
    """Add ``size``: rows per series, from rows that carry ``pos``."""
    return attach(placed, placed.groupBy("series").agg((F.max("pos") + 1).alias("size")))


def positional_split(bars: DataFrame, layout: Layout, train_share: float = 0.8) -> DataFrame:
    """Label rows ``train`` or ``test`` by position; the first ``int(share * n)`` train."""
    sized = with_size(positions(bars, layout))
    cut = F.floor(F.col("size") * F.lit(train_share))
    label = F.when(F.col("pos") < cut, F.lit("train")).otherwise(F.lit("test"))
    return sized.withColumn("part", label).drop("pos", "size")


def _span(bars: DataFrame) -> DataFrame:
    return bars.groupBy("series").agg(
        F.unix_seconds(F.min("ts")).alias("_first"), F.unix_seconds(F.max("ts")).alias("_last")
    )


def _instant(seconds: Column) -> Column:
    return F.timestamp_seconds(seconds)


def rolling_splits(
    bars: DataFrame,
    train_days: int = 7,
    test_days: int = 1,
    step_days: int = 1,
    min_train_rows: int = 1000,
) -> DataFrame:
    """Sliding train/test windows per series that fit its span and hold enough training rows.

    Row counts come from the same arithmetic assignment as ``assign``: a row names its
    windows itself, no range join is involved.
    """
    train, test, step = train_days * DAY, test_days * DAY, step_days * DAY
    span = _span(bars)
    room = F.col("_last") - F.col("_first") - (train + test)
    windows = span.where(room >= 0).select(
        "series", "_first", F.explode(F.sequence(F.lit(0).cast("bigint"), F.floor(room / step))).alias("raw_split")
    )
    train_rows = (
        _numbered(bars.select("series", "ts"), span, train, step, 0)
        .groupBy("series", "raw_split")
        .agg(F.count(F.lit(1)).alias("train_samples"))
        .where(F.col("train_samples") >= min_train_rows)
    )
    start = F.col("_first") + F.col("raw_split") * step
    kept = windows.join(train_rows, ["series", "raw_split"]).select(
        "series",
        "raw_split",
        _instant(start).alias("train_start"),
        _instant(start + train).alias("train_end"),
        _instant(start + train).alias("test_start"),
        _instant(start + train + test).alias("test_end"),
        "train_samples",
    )
    # one row per window, never per bar
    order = Window.partitionBy("series").orderBy("raw_split")
    return kept.withColumn("split", F.row_number().over(order))


def _numbered(bars: DataFrame, span: DataFrame, length: int, step: int, offset: int) -> DataFrame:
    """One row per bar and window ``[first + offset + k*step, +length)`` that holds it, as ``raw_split`` k."""
    age = F.unix_seconds("ts") - F.col("_first") - offset
    low = F.greatest(F.lit(0).cast("bigint"), F.floor((age - length) / step) + 1)
    high = F.floor(age / step)
    aged = attach(bars, span.select("series", "_first"))
    return (
        aged.where(age >= 0)
        .withColumn("raw_split", F.when(low <= high, F.sequence(low, F.greatest(low, high))))
        .where(F.col("raw_split").isNotNull())
        .withColumn("raw_split", F.explode("raw_split"))
        .drop("_first")
    )


def assign(
    bars: DataFrame, splits: DataFrame, train_days: int = 7, test_days: int = 1, step_days: int = 1
) -> DataFrame:
    """Bars with every split they belong to and their part in it (``train`` or ``test``)."""
    train, test, step = train_days * DAY, test_days * DAY, step_days * DAY
    span = _span(bars)
    trained = _numbered(bars, span, train, step, 0).withColumn("part", F.lit("train"))
    tested = _numbered(bars, span, test, step, train).withColumn("part", F.lit("test"))
    named = splits.select("series", "raw_split", "split")
    return attach(trained.unionByName(tested), named, ["series", "raw_split"]).drop("raw_split")


def walk_forward_splits(sizes: DataFrame, n_splits: int = 5, test_size: float = 0.2) -> DataFrame:
    """Expanding-window splits by row position from ``(series, size)``.

    Each split ends a fraction of a test set earlier than the one before and needs more
    training than test rows.
    """
    test = F.floor(F.col("size") * F.lit(test_size))
    cuts = sizes.select("series", "size", test.alias("_test"), F.explode(F.sequence(F.lit(0), F.lit(n_splits - 1))).alias("_i"))
    end = F.col("size") - F.col("_i") * F.floor(F.col("_test") / n_splits)
    start = end - F.col("_test")
    return cuts.select(
        "series",
        (F.col("_i") + 1).alias("split"),
        start.alias("train_rows"),
        start.alias("test_start_pos"),
        end.alias("test_end_pos"),
        "_test",
    ).where(F.col("train_rows") > F.col("_test")).drop("_test")
