"""Registered queries: each takes ``(spark, sf_dir)`` and returns a DataFrame."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]


def registered() -> dict[str, Query]:
    from barloom.catalog import data, evaluation, features, forecasts, learning, streams

    return {**data.QUERIES, **features.QUERIES, **forecasts.QUERIES, **evaluation.QUERIES, **learning.QUERIES, **streams.QUERIES}
