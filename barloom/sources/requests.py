"""Time ranges to load: the request plan as a table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

CANDLES_PER_REQUEST = 300


def forward_chunks(spans: DataFrame, step_seconds: int = 60, rows: int = CANDLES_PER_REQUEST) -> DataFrame:
    """Tile ``[start_ts, end_ts)`` per series into consecutive ranges of at most ``rows`` bars."""
    width = step_seconds * rows
    start, end = F.unix_seconds("start_ts"), F.unix_seconds("end_ts")
    count = F.ceil((end - start) / width)
    numbered = spans.where(F.col("start_ts") < F.col("end_ts")).select(
        "series", "start_ts", "end_ts", F.explode(F.sequence(F.lit(0).cast("bigint"), count - 1)).alias("chunk")
    )

    def edge(k: Column) -> Column:
        return F.timestamp_seconds(F.unix_seconds("start_ts") + k * width)

    return numbered.select(
        "series",
        "chunk",
        edge(F.col("chunk")).alias("chunk_start"),
        F.least(edge(F.col("chunk") + 1), F.col("end_ts")).alias("chunk_end"),
    )


def backward_chunks(spans: DataFrame, total_days: int, chunk_days: int = 30) -> DataFrame:
    """Ranges of ``chunk_days`` counted back from ``end_ts``; the oldest one may be shorter."""
    chunks = (total_days + chunk_days - 1) // chunk_days
    numbered = spans.select(
        "series", "end_ts", F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(chunks - 1).cast("bigint"))).alias("chunk")
    )

    def back(days: Column) -> Column:
        return F.timestamp_seconds(F.unix_seconds("end_ts") - days * 86400)

    oldest = F.least((F.col("chunk") + 1) * chunk_days, F.lit(total_days).cast("bigint"))
    return numbered.select(
        "series",
        "chunk",
        back(oldest).alias("chunk_start"),
        back(F.col("chunk") * chunk_days).alias("chunk_end"),
    )
