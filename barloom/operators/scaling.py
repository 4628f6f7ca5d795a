"""Exact quantiles of whole columns, and feature scaling built on them."""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from barloom.operators.layout import attach
from barloom.session import materialized


@dataclass
class _Search:
    """Bracket ``[low, high]`` known to hold two neighbouring order statistics."""

    column: str
    q: float
    low: float
    high: float
    below: int  # values under the bracket
    inside: int  # values in the bracket
    first: int  # 0-based ranks wanted
    second: int
    known: tuple[float, float] | None = None

    def values(self) -> Column:
        x = F.col(self.column)
        return F.when((x >= self.low) & (x <= self.high), x)

    def settled(self, limit: int) -> bool:
        if self.low == self.high:
            self.known = (self.low, self.low)
        return self.known is not None or self.inside <= limit


def exact_quantiles(
    df: DataFrame, columns: Sequence[str], quantiles: Sequence[float], *, limit: int = 10_000, accuracy: int = 10_000
) -> dict[str, list[float | None]]:
    """Linearly interpolated quantiles of each column over all rows.

    Each pass narrows a bracket around the wanted ranks with a mergeable sketch, then counts
    exactly; only a bracket of at most ``limit`` values is ever gathered. Rows never shuffle.
    """
    stats = df.agg(
        *[f(_present(c)).alias(f"{n}_{c}") for c in columns for n, f in (("n", F.count), ("lo", F.min), ("hi", F.max))]
    ).first()
    searches: list[_Search] = []
    for c in columns:
        n = stats[f"n_{c}"]
        for q in quantiles:
            if n:
                rank = q * (n - 1)
                searches.append(
                    _Search(c, q, stats[f"lo_{c}"], stats[f"hi_{c}"], 0, n, math.floor(rank), math.ceil(rank))
                )
    while open_ := [s for s in searches if not s.settled(limit)]:
        _narrow(df, open_, accuracy)
    pairs = _gather(df, searches)
    out: dict[str, list[float | None]] = {c: [None] * len(quantiles) for c in columns}
    for s, (a, b) in zip(searches, pairs, strict=True):
        n = stats[f"n_{s.column}"]
        share = s.q * (n - 1) - s.first
        out[s.column][list(quantiles).index(s.q)] = a + (b - a) * share
    return out


def _present(c: str) -> Column:
    x = F.col(c).cast("double")
    return F.when(~F.isnan(x) & (F.abs(x) < float("inf")), x)  # an infinite end could never be halved


def _narrow(df: DataFrame, searches: Sequence[_Search], accuracy: int) -> None:
    slack = 2.0 / accuracy

    def level(s: _Search, rank: int, shift: float) -> float:
        return min(1.0, max(0.0, (rank - s.below) / s.inside + shift))

    cuts = df.agg(
        *[
            F.percentile_approx(
                s.values(), F.array(F.lit(level(s, s.first, -slack)), F.lit(level(s, s.second, slack))), accuracy
            ).alias(f"c{i}")
            for i, s in enumerate(searches)
        ]
    ).first()
    trial = [cuts[f"c{i}"] for i in range(len(searches))]
    counts = df.agg(
        *[
            f.alias(f"{n}{i}")
            for i, s in enumerate(searches)
            for n, f in (
                ("b", F.count_if(s.values() < trial[i][0])),
                ("i", F.count_if((s.values() >= trial[i][0]) & (s.values() <= trial[i][1]))),
            )
        ]
    ).first()
    for i, s in enumerate(searches):
        below, inside = s.below + counts[f"b{i}"], counts[f"i{i}"]
        if below <= s.first and s.second < below + inside and inside < s.inside:
            s.low, s.high, s.below, s.inside = trial[i][0], trial[i][1], below, inside
        else:
            _halve(df, s)


def _halve(df: DataFrame, s: _Search) -> None:
    """Fallback when the sketch did not help: bisect the value range."""
    middle = s.low + (s.high - s.low) / 2
    x = s.values()
    left, top, bottom = df.agg(
        F.count_if(x <= middle), F.max(F.when(x <= middle, x)), F.min(F.when(x > middle, x))
    ).first()
    split = s.below + left
    if s.second < split:
        s.high, s.inside = top, left
    elif s.first >= split:
        s.low, s.below, s.inside = bottom, split, s.inside - left
    else:
        s.known = (top, bottom)  # the wanted ranks are the neighbours on either side


def _gather(df: DataFrame, searches: Sequence[_Search]) -> list[tuple[float, float]]:
    wanted = [s for s in searches if s.known is None]
    lists = (
        df.agg(*[F.sort_array(F.collect_list(s.values())).alias(f"v{i}") for i, s in enumerate(wanted)])
        .select(
            *[
                F.array(F.get(f"v{i}", F.lit(s.first - s.below)), F.get(f"v{i}", F.lit(s.second - s.below))).alias(f"v{i}")
                for i, s in enumerate(wanted)
            ]
        )
        .first()
        if wanted
        else None
    )
    found = iter(lists) if lists is not None else iter(())
    return [tuple(next(found)[0:2]) if s.known is None else s.known for s in searches]


#: Parts into which a pass cuts the bracket of a group's quantile.
CUTS = 128


def group_quantiles(df: DataFrame, by: Sequence[str], column: str, quantiles: Sequence[float], *, limit: int = 10_000) -> DataFrame:
    """Linearly interpolated quantiles of a column by group: ``by`` and ``quantiles``, an array.

    Exact like ``exact_quantiles``, for any number of groups of any size. Each pass cuts the bracket around every group's wanted
    ranks at sketched quantiles, counts what lies between and at the cuts, and keeps the part that holds the ranks, about 1 / CUTS of
    it. Only brackets of at most ``limit`` values are gathered, so no task ever holds a group. ``df`` is read once for each pass:
    hand in a stored table. Missing values do not count; groups without others, or with a NULL key, are left out.
    """
    keys, limit = list(by), max(limit, 2)  # two neighbouring ranks may be wanted
    rows = df.select(*keys, F.col(column).cast("double").alias("_x")).where("_x is not null and not isnan(_x)")
    sizes = rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("inside"), F.min("_x").alias("lo"), F.max("_x").alias("hi"))
    ranks = [F.struct(F.lit(k).alias("k"), F.lit(float(q)).alias("q"), (F.col("inside") - 1).alias("top")) for k, q in enumerate(quantiles)]
    start = sizes.select(*keys, "inside", "lo", "hi", F.lit(0).cast("bigint").alias("below"), F.inline(F.array(*ranks)))
    rank = F.col("q") * F.col("top")
    brackets = start.withColumns({"first": F.floor(rank), "second": F.ceil(rank), "share": rank - F.floor(rank)}).drop("q", "top")
    brackets = materialized(brackets, "brackets")
    wide = (F.col("inside") > limit) & (F.col("lo") < F.col("hi"))
    while brackets.where(wide).head(1):
        brackets = materialized(_narrowed(rows, keys, brackets.where(wide)).unionByName(brackets.where(~wide)), "brackets")
    loose = F.col("lo") < F.col("hi")
    held = _in_brackets(rows, keys, brackets.where(loose)).groupBy(*keys, "k").agg(F.sort_array(F.collect_list("_x")).alias("_held"))
    told = brackets.join(held, [*keys, "k"], "left")
    a, b = (F.coalesce(F.get("_held", (F.col(r) - F.col("below")).cast("int")), F.col("lo")) for r in ("first", "second"))
    found = told.select(*keys, "k", (a + (b - a) * F.col("share")).alias("_v"))
    gathered = found.groupBy(*keys).agg(F.array_sort(F.collect_list(F.struct("k", "_v"))).alias("_q"))
    return gathered.select(*keys, F.transform("_q", lambda s: s["_v"]).alias("quantiles"))


def _in_brackets(rows: DataFrame, keys: list[str], brackets: DataFrame, *extra: str) -> DataFrame:
    """Rows once for each bracket of their group that holds them."""
    bracket = F.struct("k", "lo", "hi", *extra)
    per_group = brackets.groupBy(*keys).agg(F.collect_list(bracket).alias("_b"))
    inside = F.filter("_b", lambda b: (F.col("_x") >= b["lo"]) & (F.col("_x") <= b["hi"]))
    return attach(rows, per_group, keys, spread=["_x"]).select(*keys, "_x", F.inline(inside))


def _narrowed(rows: DataFrame, keys: list[str], brackets: DataFrame) -> DataFrame:
    levels = F.array(*[F.lit(k / CUTS) for k in range(1, CUTS)])
    sketched = _in_brackets(rows, keys, brackets).groupBy(*keys, "k").agg(F.array_distinct(F.percentile_approx("_x", levels, 100 * CUTS)).alias("cuts"))
    cut = brackets.join(sketched, [*keys, "k"])
    # values between two cuts have an even number, those equal to a cut an odd one
    number = F.size(F.filter("cuts", lambda c: c < F.col("_x"))) * 2 + F.array_contains("cuts", F.col("_x")).cast("int")
    counts = (
        _in_brackets(rows, keys, cut, "cuts")
        .groupBy(*keys, "k", number.alias("number"))
        .agg(F.count(F.lit(1)).alias("n"), F.min("_x").alias("least"), F.max("_x").alias("most"))
    )
    listed = counts.groupBy(*keys, "k").agg(F.array_sort(F.collect_list(F.struct("number", "n", "least", "most"))).alias("parts"))
    joined = brackets.join(listed, [*keys, "k"])
    # running counts, and the parts that hold either rank
    told = F.aggregate(
        "parts",
        F.struct(F.col("below").alias("seen"), F.col("below").alias("below"), F.lit(0).cast("bigint").alias("inside"), F.lit(None).cast("double").alias("lo"), F.lit(None).cast("double").alias("hi")),
        lambda s, p: F.when(
            (F.col("first") < s["seen"] + p["n"]) & (F.col("second") >= s["seen"]),
            F.struct(
                (s["seen"] + p["n"]).alias("seen"),
                F.when(s["lo"].isNull(), s["seen"]).otherwise(s["below"]).alias("below"),
                (s["inside"] + p["n"]).alias("inside"),
                F.coalesce(s["lo"], p["least"]).alias("lo"),
                p["most"].alias("hi"),
            ),
        ).otherwise(F.struct((s["seen"] + p["n"]).alias("seen"), s["below"].alias("below"), s["inside"].alias("inside"), s["lo"].alias("lo"), s["hi"].alias("hi"))),
    )
    return joined.withColumn("_t", told).select(*keys, "k", "first", "second", "share", *[F.col(f"_t.{c}").alias(c) for c in ("inside", "lo", "hi", "below")])


@dataclass(frozen=True)
class Scaling:
    """Shift and divisor per column, learned on training rows and kept with the model."""

    shift: dict[str, float]
    divisor: dict[str, float]

    def column(self, name: str) -> Column:
        return (F.col(name) - F.lit(self.shift[name])) / F.lit(self.divisor[name])

    def apply(self, df: DataFrame) -> DataFrame:
        return df.withColumns({c: self.column(c) for c in self.shift})

    def statement(self, prefix: str = "scaled_") -> str:
        """The same projection as SQL over ``__THIS__``, for use inside an ML pipeline."""
        cols = [
            f"(`{c}` - double('{self.shift[c]!r}')) / double('{self.divisor[c]!r}') AS `{prefix}{c}`" for c in self.shift
        ]
        return "SELECT *, " + ", ".join(cols) + " FROM __THIS__"


def robust_scaling(train: DataFrame, columns: Sequence[str]) -> Scaling:
    """Median and interquartile range; a constant column is only shifted."""
    found = exact_quantiles(train, columns, (0.25, 0.5, 0.75))
    spread = {c: (v[2] - v[0]) if v[0] is not None else 0.0 for c, v in found.items()}
    return Scaling(
        {c: v[1] if v[1] is not None else 0.0 for c, v in found.items()},
        {c: s if s != 0 else 1.0 for c, s in spread.items()},
    )


def standard_scaling(train: DataFrame, columns: Sequence[str]) -> Scaling:
    """Mean and population deviation; a constant column is only shifted."""
    row = train.agg(
        *[f(_present(c)).alias(f"{n}_{c}") for c in columns for n, f in (("m", F.avg), ("s", F.stddev_pop))]
    ).first()
    return Scaling(
        {c: row[f"m_{c}"] if row[f"m_{c}"] is not None else 0.0 for c in columns},
        {c: row[f"s_{c}"] or 1.0 for c in columns},
    )
