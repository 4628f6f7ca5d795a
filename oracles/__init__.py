"""Independent SQL for the registered queries, written for DuckDB."""

from __future__ import annotations


def registered() -> dict[str, str]:
    from oracles import data, evaluation, features, forecasts, learning, streams

    return {**data.ORACLES, **features.ORACLES, **forecasts.ORACLES, **evaluation.ORACLES, **learning.ORACLES, **streams.ORACLES}
