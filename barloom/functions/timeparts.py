"""Timestamp expressions: bucketing, calendar parts, timeframe strings."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


# Feature prefix, calendar part and period of the cyclic columns.
CYCLES = (("hour", "hour", 24), ("dow", "day_of_week", 7), ("month", "month", 12), ("minute", "minute", 60))

CALENDAR_NAMES = ("hour", "day_of_week", "day_of_month", "month", "quarter", "minute")
CYCLIC_NAMES = tuple(f"{prefix}_{f}" for prefix, _, _ in CYCLES for f in ("sin", "cos"))
FLAG_NAMES = ("is_weekend", "is_market_hours", "is_overnight")


def time_bucket(ts: Column, step_seconds: int) -> Column:
    """Start of the ``step_seconds`` wide bucket that holds ``ts``."""
    seconds = F.unix_seconds(ts)
    return F.timestamp_seconds(seconds - F.pmod(seconds, F.lit(step_seconds)))


def timeframe_seconds(timeframe: Column) -> Column:
    """``'5m' -> 300``; minutes, hours and days only, anything else raises."""
    unit = F.right(timeframe, F.lit(1))
    count = F.substring(timeframe, F.lit(1), F.length(timeframe) - 1).cast("bigint")
    return (
        F.when(unit == "m", count * 60)
        .when(unit == "h", count * 3600)
        .when(unit == "d", count * 86400)
        .otherwise(F.raise_error(F.concat(F.lit("unsupported timeframe unit: "), unit)).cast("bigint"))
    )


def calendar_columns(ts: Column) -> dict[str, Column]:
    """Integer calendar parts; weeks start on Monday = 0."""
    return {
        "hour": F.hour(ts),
        "day_of_week": F.weekday(ts),
        "day_of_month": F.dayofmonth(ts),
        "month": F.month(ts),
        "quarter": F.quarter(ts),
        "minute": F.minute(ts),
    }


def cyclic_columns(ts: Column) -> dict[str, Column]:
    parts = calendar_columns(ts)
    out: dict[str, Column] = {}
    for prefix, part, period in CYCLES:
        angle = parts[part] * F.lit(2 * math.pi) / F.lit(float(period))
        out[f"{prefix}_sin"] = F.sin(angle)
        out[f"{prefix}_cos"] = F.cos(angle)
    return out


def session_flags(ts: Column) -> dict[str, Column]:
    """Weekend, market-hours (9-16h) and overnight (22-6h) markers as 0/1."""
    hour = F.hour(ts)
    return {
        "is_weekend": (F.weekday(ts) >= 5).cast("int"),
        "is_market_hours": hour.between(9, 16).cast("int"),
        "is_overnight": ((hour >= 22) | (hour <= 6)).cast("int"),
    }


def active_hours(
    ts: Column,
    hours: tuple[int, int] = (9, 17),
    minutes: tuple[int, int] = (40, 59),
    every: int = 5,
    weekdays: Sequence[int] = (0, 1, 2, 3, 4),
) -> Column:
    """True where the live schedule fires: weekday, hour range, every n-th minute of a range."""
    minute = F.minute(ts)
    return (
        F.hour(ts).between(*hours)
        & F.weekday(ts).isin(*weekdays)
        & minute.between(*minutes)
        & (F.pmod(minute - minutes[0], F.lit(every)) == 0)
    )
