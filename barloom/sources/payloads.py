"""Decoding of landed exchange messages."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from barloom.operators.layout import attach


def decode_candles(payloads: DataFrame, payload: str = "payload") -> DataFrame:
    """Bars from JSON arrays of ``[epoch_s, low, high, open, close, volume]``.

    Other columns of the payload row (series, ingest sequence) are carried along.
    """
    carried = [c for c in payloads.columns if c != payload]
    candles = payloads.select(*carried, F.explode(F.from_json(payload, "array<array<double>>")).alias("_c"))

    def item(i: int) -> Column:
        return F.get("_c", F.lit(i))

    return candles.select(
        *carried,
        F.timestamp_seconds(item(0)).alias("ts"),
        item(3).alias("open"),
        item(2).alias("high"),
        item(1).alias("low"),
        item(4).alias("close"),
        item(5).alias("volume"),
    )


def encode_candles(bars: DataFrame, by: list[str]) -> DataFrame:
    """Candle payloads, one per ``by`` group; groups must be small (one series and day)."""
    candle = F.array(
        F.unix_seconds("ts").cast("double"), "low", "high", "open", "close", "volume"
    )
    grouped = bars.groupBy(*by).agg(F.sort_array(F.collect_list(candle)).alias("_candles"))
    return grouped.select(*by, F.to_json("_candles").alias("payload"))


def decode_tickers(messages: DataFrame, message: str = "message") -> DataFrame:
    """Quotes from ticker JSON: the price is required, bid, ask and volume default to 0."""
    carried = [c for c in messages.columns if c != message]

    def number(field: str) -> Column:
        return F.get_json_object(message, f"$.{field}").try_cast("double")

    zero = F.lit(0.0)
    return messages.select(
        *carried,
        number("price").alias("price"),
        F.coalesce(number("bid"), zero).alias("bid"),
        F.coalesce(number("ask"), zero).alias("ask"),
        F.coalesce(number("volume"), zero).alias("volume"),
    ).where(F.col("price").isNotNull())


def latest_quote(quotes: DataFrame) -> DataFrame:
    """Newest quote per series; of several at the same instant, the one with the highest values."""
    newest = quotes.groupBy("series").agg(F.max("ts").alias("_newest"))
    last = attach(quotes, newest).where(F.col("ts") == F.col("_newest"))
    fields = [c for c in quotes.columns if c not in ("series", "ts")]
    return last.groupBy("series", "ts").agg(F.max(F.struct(*fields)).alias("_q")).select("series", "ts", "_q.*")
