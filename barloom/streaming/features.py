"""The basic and enhanced feature sets on bars that keep arriving, by the same plans as in batch.

Spark has no row frames on streams. So each micro-batch is put behind the bars that its features can reach back to, and the batch
plan runs over both: its chunks spread a series over tasks, and there is no second copy of any formula. The state is a table of
the last ``HISTORY_ROWS`` bars of each series, after which smoothed values have faded below the precision of a double. What does
not fade is carried beside them: the running on-balance volume, and the strength index, which keeps its value while the close stands
still. State and output of a micro-batch are folders of its number, so that a repeated batch overwrites itself, and a series
without bars for ``idle`` days is dropped from the state.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from barloom.operators import rolling, splits, technical
from barloom.operators.layout import Layout, attach, running_totals, with_previous
from barloom.plans import features
from barloom.plans.features import KEYS, OHLCV
from barloom.session import materialized

#: Bars that any feature reaches back to.
HISTORY_ROWS = max(technical.HISTORY_ROWS, *rolling.WINDOWS, *rolling.LAGS) + 1
PLANS: dict[str, Callable[[DataFrame, Layout, Sequence[int]], DataFrame]] = {
    "simple": features.simple_features,
    "basic": features.basic_features,
    "enhanced": features.enhanced_features,
}
RSI = ("rsi", "rsi_14", "rsi_21")
CARRIED = ("obv", *RSI)
STATE = T.StructType(
    [T.StructField("series", T.StringType()), T.StructField("ts", T.TimestampType())] + [T.StructField(c, T.DoubleType()) for c in (*OHLCV, *CARRIED)]
)


def output_schema(kind: str) -> T.StructType:
    spec = {"simple": features.simple_spec, "basic": features.basic_spec, "enhanced": features.enhanced_spec}[kind](())
    calendar = {n: T.IntegerType() for n in ("hour", "day_of_week", "minute", "day_of_month", "month", "quarter", *features.timeparts.FLAG_NAMES)}
    fields = [T.StructField(c, calendar.get(c, T.DoubleType())) for c in spec.features]
    return T.StructType([*STATE.fields[:2], *STATE.fields[2 : 2 + len(OHLCV)], *fields, T.StructField("late", T.BooleanType())])


def featured(history: DataFrame, new: DataFrame, layout: Layout, kind: str) -> tuple[DataFrame, DataFrame]:
    """Features of the new bars behind those of the history, and the history that follows.

    A bar not after its series' last one is handed on as ``late``, without features. Both inputs are read several times.
    """
    last = history.groupBy("series").agg(F.max("ts").alias("_last"))
    marked = attach(new.dropDuplicates(list(KEYS)).select(*KEYS, *OHLCV), last, how="left")
    late = F.coalesce(F.col("ts") <= F.col("_last"), F.lit(False))
    marked = materialized(marked.withColumn("late", late), "arrived")
    bars = materialized(history.select(*KEYS, *OHLCV).unionByName(marked.where("not late").select(*KEYS, *OHLCV)), "bars")
    table = materialized(PLANS[kind](bars, layout, ()), "featured")
    carried = [c for c in CARRIED if c in table.columns]
    # what was carried up to the last known bar
    before = attach(history, last).where(F.col("ts") == F.col("_last")).select("series", "_last", *[F.col(c).alias(f"_then_{c}") for c in carried])
    if carried:
        moved = with_previous(features.priced(bars), layout, "close", "_previous")
        moves = running_totals(moved, layout, {"_moves": (F.col("close") != F.col("_previous")).cast("bigint")})
        table = table.join(moves.select(*KEYS, "_moves"), [*KEYS], "left")
    if "obv" in carried:
        again = attach(table.select(*KEYS, "obv"), before.select("series", "_last")).where(F.col("ts") == F.col("_last"))
        before = before.join(again.select("series", F.col("obv").alias("_now_obv")), "series", "left")
    table = attach(table, before, how="left")
    told = {}
    if "obv" in carried:
        told["obv"] = F.col("obv") + F.coalesce(F.col("_then_obv") - F.col("_now_obv"), F.lit(0.0))
    for c in (c for c in carried if c in RSI):
        told[c] = F.when((F.coalesce("_moves", F.lit(0)) == 0) & F.col(f"_then_{c}").isNotNull(), F.col(f"_then_{c}")).otherwise(F.col(c))
    whole = table.withColumns(told) if told else table
    names = output_schema(kind).fieldNames()[:-1]
    fresh = whole.where(F.col("_last").isNull() | (F.col("ts") > F.col("_last"))).select(*names).withColumn("late", F.lit(False))
    missed = marked.where("late").select(*KEYS, *OHLCV, "late")
    out = fresh.unionByName(missed, allowMissingColumns=True)
    kept = whole.select(*KEYS, *OHLCV, *[F.col(c) if c in carried else F.lit(None).cast("double").alias(c) for c in CARRIED])
    return out, splits.tail(kept, HISTORY_ROWS, layout)


def feature_stream(
    bars: DataFrame, out: str, checkpoint: str, layout: Layout, *, kind: str = "enhanced", idle: int = 30
) -> StreamingQuery:
    """Features of every micro-batch of a bar stream under ``out``; read them with ``read_features``."""
    spark = bars.sparkSession

    def write(batch: DataFrame, number: int) -> None:
        empty = spark.createDataFrame([], STATE)
        history = spark.read.schema(STATE).parquet(f"{out}/state/batch_id={number - 1}") if number else empty
        found, after = featured(history, materialized(batch.select(*KEYS, *OHLCV), "batch"), layout, kind)
        found.write.mode("overwrite").parquet(f"{out}/features/batch_id={number}")
        after = materialized(after, "history")
        newest = after.groupBy("series").agg(F.max("ts").alias("_newest"))
        since = (after.agg(F.max("ts").alias("ts")).first().ts,)
        alive = newest.where(F.col("_newest") >= F.lit(since[0]) - F.make_dt_interval(days=F.lit(idle))).select("series")
        attach(after, alive).select(*STATE.fieldNames()).write.mode("overwrite").parquet(f"{out}/state/batch_id={number}")

    return bars.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def read_features(spark: SparkSession, out: str, kind: str = "enhanced") -> DataFrame:
    return spark.read.schema(output_schema(kind)).parquet(f"{out}/features")
