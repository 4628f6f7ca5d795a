"""Forecast ensembles to quantiles, intervals and event probabilities.

A forecast row carries its ensemble as an array ``members`` of bounded size, so quantiles are
row-local expressions: no samples table, no shuffle.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, WindowSpec
from pyspark.sql import functions as F

from barloom.functions import labels
from barloom.functions.arrays import GRID_POINTS, ensemble_cdf, let, quantile_grid, sorted_quantile
from barloom.operators.layout import Layout, attach, over_chunks
from barloom.operators.metrics import present

# Default levels.
QUANTILES = (0.05, 0.25, 0.5, 0.75, 0.95)
INTERVALS = (0.68, 0.95)
DRAWS = 1000
#: Draws are numbers below this prime; the steps set draws of one key apart.
PRIME = 2**31 - 1
STEPS = (1_000_003, 7_919)
LIVE_PERCENTS = (0.5, 1.0, 2.0, 5.0)
LIVE_DELTAS = (500, 1000, 2000)


def error_ensemble(bars: DataFrame, layout: Layout, horizons: Sequence[int], members: int) -> DataFrame:
    """Persistence forecasts spread by their own last ``members`` errors.

    Long rows ``(series, ts, horizon, close, prediction, actual, members)``; rows without a
    full set of past errors are left out.
    """

    def build(df: DataFrame, w: WindowSpec) -> DataFrame:
        df = df.withColumns({f"_step_{h}": F.col("close") - F.lag("close", h).over(w) for h in horizons})
        frame = w.rowsBetween(-(members - 1), 0)
        cols: dict[str, Column] = {f"target_{h}": F.lead("close", h).over(w) for h in horizons}
        cols |= {f"_steps_{h}": F.collect_list(f"_step_{h}").over(frame) for h in horizons}
        return df.withColumns(cols)

    wide = over_chunks(bars, layout, members + max(horizons), max(horizons), build, columns=["series", "ts", "close"], heavy=True)
    per_horizon = F.array(
        *[
            F.struct(
                F.lit(h).alias("horizon"),
                F.col(f"target_{h}").alias("actual"),
                F.col(f"_steps_{h}").alias("_steps"),
            )
            for h in horizons
        ]
    )
    rows = wide.select("series", "ts", "close", F.inline(per_horizon)).where(F.size("_steps") == members)
    spread = F.sort_array(F.transform("_steps", lambda s: s + F.col("close")))
    return rows.select(
        "series", "ts", "horizon", "close", F.col("close").alias("prediction"), "actual", spread.alias("members")
    )


def member_quantiles(
    forecasts: DataFrame, quantiles: Sequence[float] = QUANTILES, keep: Sequence[str] = ()
) -> DataFrame:
    """Long ``(series, ts, horizon, q, value)`` from sorted members."""
    levels = F.array(
        *[F.struct(F.lit(q).alias("q"), sorted_quantile(F.col("members"), q).alias("value")) for q in quantiles]
    )
    return forecasts.select("series", "ts", "horizon", *keep, F.inline(levels))


def prediction_intervals(forecasts: DataFrame, levels: Sequence[float] = INTERVALS, keep: Sequence[str] = ()) -> DataFrame:
    """Central intervals ``(level, lower, upper)`` per forecast."""
    bounds = F.array(
        *[
            F.struct(
                F.lit(level).alias("level"),
                sorted_quantile(F.col("members"), (1 - level) / 2).alias("lower"),
                sorted_quantile(F.col("members"), 1 - (1 - level) / 2).alias("upper"),
            )
            for level in levels
        ]
    )
    return forecasts.select("series", "ts", "horizon", *keep, F.inline(bounds))


def _rule(name: Column, op: str, low: Column, high: Column | None = None) -> Column:
    return F.struct(
        name.alias("query"),
        F.lit(op).alias("op"),
        low.cast("double").alias("low"),
        (F.lit(None) if high is None else high).cast("double").alias("high"),
    )


def live_thresholds(prices: DataFrame, price: str = "price") -> DataFrame:
    """Threshold queries around each series' current price: percent, round-number and band rules."""
    p = F.col(price)
    rules: list[Column] = []
    for pct in LIVE_PERCENTS:
        rules.append(_rule(F.lit(f"above_{pct}pct"), "above", p * (1 + pct / 100)))
        rules.append(_rule(F.lit(f"below_{pct}pct"), "below", p * (1 - pct / 100)))
    base = labels.round_to_hundred(p)
    for delta in LIVE_DELTAS:
        rules.append(_rule(labels.above_name(base + delta), "above", base + delta))
        rules.append(_rule(labels.below_name(base - delta), "below", base - delta))
    low, high = p * 0.995, p * 1.005
    rules.append(_rule(labels.between_name(low, high), "between", low, high))
    return prices.select("series", F.inline(F.array(*rules)))


def percent_thresholds(
    prices: DataFrame, percents: Sequence[float] = (1.0, 2.0), band: float = 0.5, price: str = "price"
) -> DataFrame:
    """Threshold queries named by rounded-down price: above and below at each percentage, and one band."""
    p = F.col(price)
    rules: list[Column] = []
    for pct in percents:
        up, down = p * (1 + pct / 100), p * (1 - pct / 100)
        rules.append(_rule(labels.above_name(up), "above", up))
        rules.append(_rule(labels.below_name(down), "below", down))
    low, high = p * (1 - band / 100), p * (1 + band / 100)
    rules.append(_rule(labels.between_name(low, high), "between", low, high))
    return prices.select("series", F.inline(F.array(*rules)))


def relative_rules(percents: Sequence[float], band: float) -> Column:
    """Rules relative to the forecast row's own close, as an array for ``F.inline``."""
    p = F.col("close")
    rules: list[Column] = []
    for pct in percents:
        rules.append(_rule(F.lit(f"above_{pct:g}pct"), "above", p * (1 + pct / 100)))
        rules.append(_rule(F.lit(f"below_{pct:g}pct"), "below", p * (1 - pct / 100)))
    rules.append(_rule(F.lit(f"between_{band:g}pct"), "between", p * (1 - band / 100), p * (1 + band / 100)))
    return F.array(*rules)


def event_probability(members: Column, op: Column, low: Column, high: Column) -> Column:
    """P(x >= low), P(x < low) or P(low <= x < high); 0 for any other rule."""
    under = ensemble_cdf(members, low)
    return (
        F.when(op == "between", ensemble_cdf(members, high) - under)
        .when(op == "above", 1 - under)
        .when(op == "below", under)
        .otherwise(F.lit(0.0))
    )


def event_outcome(actual: Column, op: Column, low: Column, high: Column) -> Column:
    """1 if the realised value satisfies the rule, 0 if not, NULL without a value."""
    hit = (
        F.when(op == "between", (actual >= low) & (actual < high))
        .when(op == "above", actual >= low)
        .when(op == "below", actual < low)
    )
    return F.when(present(actual), hit.cast("int"))


def _scored(asked: DataFrame) -> DataFrame:
    op, low, high = F.col("op"), F.col("low"), F.col("high")
    return asked.select(
        "series", "ts", "horizon", "query",
        event_probability(F.col("members"), op, low, high).alias("probability"),
        event_outcome(F.col("actual"), op, low, high).alias("event"),
    )


def relative_probabilities(
    forecasts: DataFrame, percents: Sequence[float] = (0.5, 1.0), band: float = 0.2
) -> DataFrame:
    """Event probabilities for thresholds relative to each row's own close."""
    rules = F.inline(relative_rules(percents, band))
    return _scored(forecasts.select("series", "ts", "horizon", "actual", "members", rules))


def event_probabilities(forecasts: DataFrame, thresholds: DataFrame) -> DataFrame:
    """Event probabilities for a table of threshold queries per series.

    The queries of a series travel as one short array, so the join meets each forecast once
    and the fan-out happens row-locally.
    """
    rule = F.struct("query", "op", "low", "high")
    per_series = thresholds.groupBy("series").agg(F.collect_list(rule).alias("_rules"))
    joined = attach(forecasts, per_series)
    return _scored(joined.select("series", "ts", "horizon", "actual", "members", F.inline("_rules")))


def probability_summary(probabilities: DataFrame, by: Sequence[str] = ("query", "horizon")) -> DataFrame:
    p = F.col("probability")
    return probabilities.groupBy(*by).agg(
        F.avg(p).alias("mean_probability"),
        F.stddev_pop(p).alias("std_probability"),
        F.min(p).alias("min_probability"),
        F.max(p).alias("max_probability"),
    )


def interval_coverage(intervals: DataFrame, by: Sequence[str] = ("level", "horizon")) -> DataFrame:
    """Share of realised values inside their interval; rows without one do not count."""
    inside = F.col("actual").between(F.col("lower"), F.col("upper"))
    return (
        intervals.where(present(F.col("actual")))
        .groupBy(*by)
        .agg(
            F.avg(inside.cast("double")).alias("coverage"),
            F.avg(F.col("upper") - F.col("lower")).alias("mean_width"),
            F.count(F.lit(1)).alias("n_samples"),
        )
    )


def pinball_loss(quantiles: DataFrame, by: Sequence[str] = ("q", "horizon")) -> DataFrame:
    """Mean quantile loss of ``(q, value, actual)`` rows; rows without an actual value do not count."""
    left = F.col("actual") - F.col("value")
    loss = F.greatest(F.col("q") * left, (F.col("q") - 1) * left)
    return quantiles.where(present(F.col("actual"))).groupBy(*by).agg(F.avg(loss).alias("loss"), F.count(F.lit(1)).alias("n_samples"))


def uniform_draws(key: Column, draws: int) -> Column:
    """``draws`` numbers below ``PRIME`` for a whole-number key, each a function of the key and the draw's number alone.

    Fifth powers permute the numbers below this prime, and products of two of them fit a BIGINT.
    """
    p = F.lit(PRIME)

    def fifth(x: Column) -> Column:
        return (x * x % p) * (x * x % p) % p * x % p

    def numbered(k: Column) -> Column:
        first = F.transform(F.sequence(F.lit(1), F.lit(draws)), lambda d: (k + d.cast("bigint") * F.lit(STEPS[0])) % p)
        second = F.transform(F.transform(first, fifth), lambda x, i: (x + (i.cast("bigint") + 1) * F.lit(STEPS[1])) % p)
        return F.transform(second, fifth)

    return let(key, numbered)


def draw_key(seed: int, *parts: Column) -> Column:
    """A whole number below ``PRIME`` from the hash of a row's key."""
    text = F.concat_ws("|", F.lit(str(seed)), *[x.cast("string") for x in parts])
    return F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("bigint") % F.lit(PRIME)


def sampled_values(forecasts: DataFrame, draws: int, seed: int) -> Column:
    """Draws from the percentile grid of each row's members, as an array that lives within the row."""
    key = draw_key(seed, forecasts["series"], F.unix_seconds(forecasts["ts"]), forecasts["horizon"])

    def values(grid: Column) -> Column:
        def value(x: Column) -> Column:
            spot = (x + 0.5) * 100 / F.lit(float(PRIME))
            k = F.floor(spot).cast("int")
            low = F.get(grid, k - 1)
            inner = low + (F.get(grid, k) - low) * (spot - k)
            return F.when(k < 1, F.get(grid, F.lit(0))).when(k >= GRID_POINTS, F.get(grid, F.lit(GRID_POINTS - 1))).otherwise(inner)

        return F.transform(uniform_draws(key, draws), value)

    return let(quantile_grid(forecasts["members"]), values)


def sampled_distribution(forecasts: DataFrame, draws: int = DRAWS, seed: int = 42) -> DataFrame:
    """Mean, deviation and range of ``draws`` values drawn per forecast.

    Draws are repeatable: they depend on the row's key, the seed and their number, not on partitions. They are folded within
    their row, so nothing but the forecasts themselves ever moves.
    """
    def told(values: Column) -> Column:
        n = F.lit(float(draws))
        mean = F.aggregate(values, F.lit(0.0), lambda s, v: s + v) / n

        def around(m: Column) -> Column:
            spread = F.sqrt(F.aggregate(values, F.lit(0.0), lambda s, v: s + (v - m) * (v - m)) / n)
            return F.struct(m.alias("mean"), spread.alias("deviation"), F.array_min(values).alias("low"), F.array_max(values).alias("high"))

        return let(mean, around)

    drawn = forecasts.select("series", "ts", "horizon", let(sampled_values(forecasts, draws, seed), told).alias("_told"))
    return drawn.select("series", "ts", "horizon", F.lit(draws).alias("draws"), "_told.*")


def sampled_probabilities(
    forecasts: DataFrame, percents: Sequence[float] = (0.5, 1.0), band: float = 0.2, draws: int = DRAWS, seed: int = 42
) -> DataFrame:
    """Share of the draws that meet thresholds relative to each row's own close; ``event_probability`` is its expectation."""
    def shares(values: Column) -> Column:
        def met(rule: Column) -> Column:
            low, high = rule["low"], rule["high"]
            hits = (
                F.when(rule["op"] == "between", F.size(F.filter(values, lambda v: (v >= low) & (v < high))))
                .when(rule["op"] == "above", F.size(F.filter(values, lambda v: v >= low)))
                .otherwise(F.size(F.filter(values, lambda v: v < low)))
            )
            return F.struct(rule["query"].alias("query"), (hits / F.lit(float(draws))).alias("probability"))

        return F.transform(relative_rules(percents, band), met)

    return forecasts.select("series", "ts", "horizon", F.inline(let(sampled_values(forecasts, draws, seed), shares)))
