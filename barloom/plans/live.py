"""Forecast documents for the newest bar of each series, and the health of the live tables."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from barloom.functions.arrays import sorted_quantile
from barloom.functions.labels import percent_label
from barloom.operators.layout import attach
from barloom.operators.probability import INTERVALS, QUANTILES, event_probability

POINT, QUANTILE, INTERVAL, PROBABILITY = (
    "point_forecasts",
    "quantile_forecasts",
    "prediction_intervals",
    "probabilities",
)


def _horizon_label(row: Column) -> Column:
    return F.concat(F.lit("horizon_"), row["horizon"].cast("string"), F.lit("min"))


def _per_horizon(value: Callable[[Column], Column]) -> Column:
    return F.map_from_entries(
        F.transform("_rows", lambda r: F.struct(_horizon_label(r).alias("key"), value(r).alias("value")))
    )


def forecast_documents(
    forecasts: DataFrame,
    thresholds: DataFrame,
    quantiles: Sequence[float] = QUANTILES,
    levels: Sequence[float] = INTERVALS,
) -> DataFrame:
    """One nested forecast per (series, ts): point, quantile, interval and probability sections.

    Everything but the final nesting is computed per forecast row; a document gathers one row
    per horizon.
    """
    members = F.col("members")
    per_series = thresholds.groupBy("series").agg(
        F.sort_array(F.collect_list(F.struct("query", "op", "low", "high"))).alias("_rules")
    )
    scored = attach(forecasts, per_series)
    row = F.struct(
        "horizon",
        "prediction",
        F.array(*[sorted_quantile(members, q) for q in quantiles]).alias("quantiles"),
        F.array(*[sorted_quantile(members, (1 - level) / 2) for level in levels]).alias("lower"),
        F.array(*[sorted_quantile(members, 1 - (1 - level) / 2) for level in levels]).alias("upper"),
        F.transform(
            "_rules", lambda r: event_probability(members, r["op"], r["low"], r["high"])
        ).alias("odds"),
        F.transform("_rules", lambda r: r["query"]).alias("queries"),
    )
    gathered = scored.groupBy("series", "ts", "close").agg(F.sort_array(F.collect_list(row)).alias("_rows"))

    def labelled(names: Sequence[Column], sections: Sequence[Column]) -> Column:
        return F.map_from_arrays(F.array(*names), F.array(*sections))

    def quantile_section(i: int) -> Column:
        return _per_horizon(lambda r: F.get(r["quantiles"], F.lit(i)))

    def interval_section(i: int) -> Column:
        return _per_horizon(
            lambda r: F.struct(
                F.get(r["lower"], F.lit(i)).alias("lower"), F.get(r["upper"], F.lit(i)).alias("upper")
            )
        )

    queries = F.get("_rows", F.lit(0))["queries"]
    odds = F.map_from_entries(
        F.transform(
            queries,
            lambda q, i: F.struct(q.alias("key"), _per_horizon(lambda r: F.get(r["odds"], i)).alias("value")),
        )
    )
    return gathered.select(
        "series",
        "ts",
        F.col("close").alias("current_price"),
        _per_horizon(lambda r: r["prediction"]).alias(POINT),
        labelled(
            [F.concat(F.lit("q"), percent_label(F.lit(q))) for q in quantiles],
            [quantile_section(i) for i in range(len(quantiles))],
        ).alias(QUANTILE),
        labelled(
            [F.concat(percent_label(F.lit(level)), F.lit("pct")) for level in levels],
            [interval_section(i) for i in range(len(levels))],
        ).alias(INTERVAL),
        odds.alias(PROBABILITY),
    )


def as_json(documents: DataFrame) -> DataFrame:
    """Documents as JSON text beside their keys."""
    stamp = F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss").alias("timestamp")
    body = F.struct(stamp, "current_price", POINT, QUANTILE, INTERVAL, PROBABILITY)
    return documents.select("series", "ts", F.to_json(body).alias("document"))


def flattened(documents: DataFrame) -> DataFrame:
    """Point forecasts and probabilities as fields: ``point_<horizon>``, ``prob_<query>_<horizon>``."""
    point = F.transform(
        F.map_entries(POINT), lambda e: F.struct(F.concat(F.lit("point_"), e["key"]).alias("field"), e["value"].alias("value"))
    )
    odds = F.flatten(
        F.transform(
            F.map_entries(PROBABILITY),
            lambda q: F.transform(
                F.map_entries(q["value"]),
                lambda e: F.struct(
                    F.concat(F.lit("prob_"), q["key"], F.lit("_"), e["key"]).alias("field"), e["value"].alias("value")
                ),
            ),
        )
    )
    return documents.select("series", "ts", "current_price", F.inline(F.concat(point, odds)))


def health(
    forecasts: DataFrame, bars: DataFrame, now: str, forecast_hours: int = 1, fresh_minutes: int = 10
) -> DataFrame:
    """Per series: forecasts made lately, age of the newest bar, and whether both are in order."""
    moment = F.lit(now).cast("timestamp")
    made = forecasts.where(F.col("ts") <= moment).groupBy("series").agg(
        F.count_if(F.col("ts") > moment - F.make_dt_interval(hours=F.lit(forecast_hours))).alias("recent_forecasts")
    )
    fed = bars.where(F.col("ts") <= moment).groupBy("series").agg(F.max("ts").alias("_last"))
    age = (F.unix_seconds(moment) - F.unix_seconds("_last")) / 60
    recent = F.coalesce(F.col("recent_forecasts"), F.lit(0))
    return made.join(fed, "series", "full_outer").select(
        "series",
        recent.alias("recent_forecasts"),
        age.alias("data_age_minutes"),
        (recent > 0).alias("forecast_ok"),
        F.coalesce(age < fresh_minutes, F.lit(False)).alias("data_ok"),
        ((recent > 0) & F.coalesce(age < fresh_minutes, F.lit(False))).alias("healthy"),
    )
