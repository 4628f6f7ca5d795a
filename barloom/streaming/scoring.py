"""Scoring of newly arrived feature rows, one forecast document per bar."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from barloom.operators.probability import live_thresholds
from barloom.operators.splits import latest
from barloom.plans import live
from barloom.plans.features import clean_rows
from barloom.plans.models import Forecaster


def score_latest(model: Forecaster, rows: DataFrame) -> DataFrame:
    """Forecast documents for the newest complete row of each series."""
    newest = latest(clean_rows(rows))
    members = model.tree_members(newest, ["close"])
    thresholds = live_thresholds(newest.select("series", newest.close.alias("price")))
    return live.as_json(live.forecast_documents(members, thresholds))


def score_stream(
    features: DataFrame, model: Forecaster, out: str, checkpoint: str, *, keep_input: str | None = None
) -> StreamingQuery:
    """Score each micro-batch into its own folder; a repeated batch overwrites itself.

    ``keep_input`` also stores the rows as they came in, per batch.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.persist()  # it is read several times, and its features need not be made again each time
        if keep_input:
            batch.write.mode("overwrite").parquet(f"{keep_input}/batch_id={batch_id}")
        score_latest(model, batch).write.mode("overwrite").parquet(f"{out}/batch_id={batch_id}")
        batch.unpersist()

    return (
        features.writeStream.foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def read_scores(spark: SparkSession, out: str) -> DataFrame:
    return spark.read.schema("series string, ts timestamp, document string, batch_id bigint").parquet(out)


def late_rows(query: StreamingQuery) -> int:
    """Rows the watermark dropped, from the progress reports of a query."""
    return sum(
        op["numRowsDroppedByWatermark"] for p in query.recentProgress for op in p["stateOperators"]
    )


def keep_progress(query: StreamingQuery, path: str) -> None:
    """Adds a finished query's progress reports to a table: rows taken in and rows dropped as late, by micro-batch."""
    spark = SparkSession.active()
    rows = [
        (p["batchId"], p["timestamp"], p["numInputRows"], sum(op["numRowsDroppedByWatermark"] for op in p["stateOperators"]))
        for p in query.recentProgress
        if p["numInputRows"]
    ]
    spark.createDataFrame(rows, "batch_id long, at string, input_rows long, late_rows long").write.mode("append").parquet(path)


def read_progress(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema("batch_id long, at string, input_rows long, late_rows long").parquet(path)
