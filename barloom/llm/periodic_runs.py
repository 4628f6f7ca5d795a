"""Operator 12: periodic runs of words, by uniting suffix classes in order of decreasing common prefixes.

A run is a stretch of consecutive words with smallest period q, at least ``max(SHORTEST, TIMES * q)`` long, that no neighbouring
word extends. Its start s and s + q begin suffixes whose common prefix is exactly as long as the run less q. So suffixes are
united by decreasing length of their common prefix, as in Kruskal's algorithm: a union-find over classes of suffixes, each with
its ordered set of positions. Where a union makes positions i < j neighbours in the set, no other occurrence lies between
them, hence j - i is the smallest period of the stretch that they begin; if it is within the common prefix and the words before
i and j differ, the stretch is a run, already as long as it can be. Every run shows once, at its own start.

Only prefixes of ``SEED`` words and more can make a run, so suffixes whose first five words occur once in their document never
enter. The others are put in order by doubling, many documents at a time; the classes of five words are independent, and those
whose nearest positions are too far apart for their longest common prefix are left out before the unions.

A row's text is read whole, and rows are independent: no shuffle, and a lost task repeats its rows only. Memory grows with the
longest text of a task, time like n log n. Null texts count as empty; texts without words have no runs. Equal rows get equal
results, ties between runs are kept apart by start and period. An empty table gives no rows. Columns named like the ones added
are replaced.
"""

from __future__ import annotations

from bisect import bisect_left, insort
from collections.abc import Iterator
from itertools import chain, compress

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from barloom.functions.arrays import let
from barloom.llm.common import CACHE, SPACE, documents, slices, text_of

SHORTEST = 6
TIMES = 4
#: Common prefix that any run needs: SHORTEST - 1 at period 1, and more at longer periods.
SEED = SHORTEST - 1
#: Fewer positions than this are put into an ordered set one by one, more by merging.
FEW = 8

Run = tuple[int, int, int]
FOUND = "runs array<struct<start:long,length:long,period:long>>, collapsed string"


class WordIds:
    """Whole numbers for the words of many texts, different for different words."""

    def __init__(self):
        self.known: dict[bytes, int] = {}

    def __call__(self, words: list[list[bytes]]) -> np.ndarray:
        if len(self.known) > CACHE:
            self.known.clear()
        for w in set().union(*words).difference(self.known):
            self.known[w] = len(self.known)
        return np.fromiter(map(self.known.__getitem__, chain.from_iterable(words)), np.int64, sum(map(len, words)))


def repeated(ids: np.ndarray, doc: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Positions whose next SEED words may stand in their document twice (a clash of hashes adds positions, never loses one)."""
    n = len(ids) - SEED + 1
    if n < 2:
        return np.empty(0, np.int64)
    with np.errstate(over="ignore"):
        mixed = doc[:n].astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        for k in range(SEED):
            mixed = (mixed ^ ids[k : n + k].astype(np.uint64)) * np.uint64(0xD6E8FEB86659FD93)
            mixed ^= mixed >> np.uint64(32)
    at = np.flatnonzero(end[:n] - np.arange(n) >= SEED)
    order = at[np.argsort(mixed[at], kind="stable")]
    same = mixed[order[1:]] == mixed[order[:-1]]
    flag = np.zeros(n, bool)
    flag[order[1:][same]] = True
    flag[order[:-1][same]] = True
    return np.flatnonzero(flag)


def group_starts(new: np.ndarray) -> np.ndarray:
    """For rows in order: the index at which each row's group begins, where ``new`` marks first rows."""
    return np.maximum.accumulate(np.where(new, np.arange(len(new)), 0))


def neighbours(ids: np.ndarray, doc: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Suffixes next to each other in order, with a common prefix of SEED words or more: positions, its length, their class."""
    first = repeated(ids, doc, end)
    if not len(first):
        return (np.empty(0, np.int64),) * 4
    follow = first + SEED
    held = np.union1d(first, follow[follow < end[first]])
    m = len(held)
    place = np.full(len(ids) + 1, -1, np.int64)
    place[held] = np.arange(m)

    def word(k: int) -> np.ndarray:
        at = held + k
        return np.where(at < end[held], ids[np.minimum(at, len(ids) - 1)], -1)

    keys = [doc[held], *[word(k) for k in range(SEED)]]
    order = np.lexsort(keys[::-1])
    new = np.ones(m, bool)
    new[1:] = np.any([k[order[1:]] != k[order[:-1]] for k in keys], axis=0)
    starts = group_starts(new)
    rank = np.empty(m, np.int64)
    rank[order] = starts
    ranks, length = [rank], SEED
    active = order[np.bincount(starts, minlength=m)[starts] > 1]
    while len(active):
        # groups of equal prefixes are split by what follows; a rank is the index at which its group begins
        at = held[active] + length
        behind = np.where(at < end[held[active]], rank[place[np.minimum(at, len(ids))]], -1)
        by = np.lexsort((behind, rank[active]))
        active, behind, old = active[by], behind[by], rank[active][by]
        new = np.ones(len(active), bool)
        new[1:] = (old[1:] != old[:-1]) | (behind[1:] != behind[:-1])
        begun = np.ones(len(active), bool)
        begun[1:] = old[1:] != old[:-1]
        starts = group_starts(new)
        rank = rank.copy()
        rank[active] = old + starts - group_starts(begun)
        ranks.append(rank)
        active = active[np.bincount(starts, minlength=len(active))[starts] > 1]
        length *= 2
    order = np.empty(m, np.int64)
    order[rank] = np.arange(m)
    seed_class = ranks[0][order]
    pairs = np.flatnonzero(seed_class[1:] == seed_class[:-1])
    i, j = held[order[pairs]], held[order[pairs + 1]]
    common = np.zeros(len(i), np.int64)
    for r in range(len(ranks) - 1, -1, -1):
        a, b = i + common, j + common
        inside = np.flatnonzero((a < end[i]) & (b < end[j]))
        equal = ranks[r][place[a[inside]]] == ranks[r][place[b[inside]]]
        common[inside[equal]] += SEED << r
    for _ in range(SEED - 1):
        a, b = i + common, j + common
        inside = np.flatnonzero((a < end[i]) & (b < end[j]))
        common[inside[ids[a[inside]] == ids[b[inside]]]] += 1
    return i, j, common, seed_class[pairs]


def promising(i: np.ndarray, j: np.ndarray, common: np.ndarray, seed_class: np.ndarray) -> np.ndarray:
    """Pairs of the classes that can hold a run: some neighbouring positions within a third of the longest common prefix."""
    names, number = np.unique(seed_class, return_inverse=True)
    longest = np.zeros(len(names), np.int64)
    np.maximum.at(longest, number, common)
    member = np.concatenate([i, j])
    owner = np.concatenate([number, number])
    by = np.lexsort((member, owner))
    member, owner = member[by], owner[by]
    gap = np.where((owner[1:] == owner[:-1]) & (member[1:] > member[:-1]), member[1:] - member[:-1], np.iinfo(np.int64).max)
    nearest = np.full(len(names), np.iinfo(np.int64).max)
    np.minimum.at(nearest, owner[1:], gap)
    return (nearest <= longest // (TIMES - 1))[number]


def united(at: list[int], before: list[int], pairs: Iterator[tuple[int, int, int]]) -> list[Run]:
    """Runs (start, length, period) from pairs of suffixes by decreasing common prefix.

    Suffixes are numbered by position; ``at`` has their positions, ``before`` the words before them (none at a text's start).
    """
    parent = list(range(len(at)))
    members = [[k] for k in parent]
    runs: list[Run] = []

    def root(k: int) -> int:
        while parent[k] != k:
            parent[k] = parent[parent[k]]
            k = parent[k]
        return k

    def met(i: int, j: int, common: int) -> None:
        period = at[j] - at[i]
        if (TIMES - 1) * period <= common and common + period >= SHORTEST and (before[i] < 0 or before[i] != before[j]):
            runs.append((at[i], common + period, period))

    for x, y, common in pairs:
        a, b = root(x), root(y)
        if len(members[a]) < len(members[b]):
            a, b = b, a
        big, small = members[a], members[b]
        last = len(small) - 1
        for n, v in enumerate(small):
            k = bisect_left(big, v)
            # a neighbour from the other set, with none from the own set in between
            if k and (n == 0 or small[n - 1] < big[k - 1]):
                met(big[k - 1], v, common)
            if k < len(big) and (n == last or big[k] < small[n + 1]):
                met(v, big[k], common)
        if last < FEW:
            for v in small:
                insort(big, v)
        else:
            big += small
            big.sort()
        parent[b], members[b] = a, []
    return runs


def runs_of(words: list[list[bytes]], known: WordIds) -> list[list[Run]]:
    """Runs of each document, by start and period."""
    sizes = np.fromiter(map(len, words), np.int64, len(words))
    ids = known(words)
    ends = np.cumsum(sizes)
    doc = np.repeat(np.arange(len(words)), sizes)
    out: list[list[Run]] = [[] for _ in words]
    i, j, common, seed_class = neighbours(ids, doc, ends[doc])
    if not len(i):
        return out
    keep = promising(i, j, common, seed_class)
    i, j, common = i[keep], j[keep], common[keep]
    by = np.argsort(-common, kind="stable")
    at, number = np.unique(np.concatenate([i[by], j[by]]), return_inverse=True)
    begin = ends[doc[at]] - sizes[doc[at]]
    before = np.where(at > begin, ids[at - 1], -1)
    n = len(by)
    found = united(at.tolist(), before.tolist(), zip(number[:n].tolist(), number[n:].tolist(), common[by].tolist(), strict=True))
    for start, length, period in sorted(found, key=lambda r: (r[0], r[2])):
        d = doc[start]
        out[d].append((int(start - ends[d] + sizes[d]), length, period))
    return out


def collapsed(words: list[bytes], runs: list[Run]) -> bytes:
    """The words that are in no run, or among a run's first period, joined by a blank."""
    if runs:
        edge = np.zeros(len(words) + 1, np.int64)
        for start, length, period in runs:
            edge[start + period] += 1
            edge[start + length] -= 1
        words = list(compress(words, (np.cumsum(edge[:-1]) == 0).tolist()))
    return b" ".join(words)


def detected(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with the runs of each text, by start and period, and the text without their repeats."""
    added = T.StructType.fromDDL(FOUND)
    rows = docs.drop(*added.fieldNames())
    schema = T.StructType([*rows.schema.fields, *added.fields])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = WordIds()
        kind = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))
        for batch in batches:
            for part, texts in slices(batch, text):
                words = [(t or "").encode().split() for t in texts]
                runs = runs_of(words, known)
                flat = np.array(list(chain.from_iterable(runs)), np.int64).reshape(-1, 3)
                edges = np.concatenate([[0], np.cumsum([len(r) for r in runs])]).astype(np.int32)
                parts = pa.StructArray.from_arrays([pa.array(flat[:, k]) for k in range(3)], fields=list(kind.value_type))
                listed = pa.ListArray.from_arrays(pa.array(edges), parts, type=kind)
                plain = pa.array([collapsed(w, r).decode() for w, r in zip(words, runs, strict=True)], pa.string())
                yield pa.RecordBatch.from_arrays([*part.columns, listed, plain], schema.fieldNames())

    return rows.mapInArrow(run, schema)


def looped(doc_id: Column, text: Column) -> Column:
    """The text, of every tenth document (by the checksum of its id) with its later part replaced by a loop of words."""
    h = F.crc32(doc_id.cast("string"))
    g = F.floor(h / 10)

    def rewritten(words: Column) -> Column:
        n = F.size(words)
        a = g % n
        p = 1 + F.floor((n - a) / (3 + g % 8))
        loop = F.slice(words, (a + 1).cast("int"), p.cast("int"))
        many = F.flatten(F.array_repeat(loop, F.ceil((n - a) / p).cast("int")))
        return F.when(n == 0, F.lit("")).otherwise(F.array_join(F.slice(F.concat(F.slice(words, F.lit(1), a.cast("int")), many), F.lit(1), n), " "))

    words = F.filter(F.split(text, f"{SPACE}+"), lambda w: w != "")
    return F.when(h % 10 == 0, let(words, rewritten)).otherwise(text)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A document without an id is taken as it is."""
    docs = documents(spark, sf_dir)
    texts = docs.select("doc_id", looped(F.col("doc_id"), text_of(docs)).alias("text"))
    best = F.array_max(F.transform("runs", lambda r: F.struct(r["length"], (-r["start"]).alias("start"), (-r["period"]).alias("period"))))
    lines = F.transform("runs", lambda r: F.concat_ws(",", r["start"], r["length"], r["period"]))
    listed = F.when(F.size("runs") > 0, F.concat(F.array_join(lines, "\n"), F.lit("\n"))).otherwise(F.lit(""))
    found = detected(texts).withColumn("_best", best)
    length, start, period = F.col("_best.length"), -F.col("_best.start"), -F.col("_best.period")
    return found.select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), start.alias("start"), length.alias("length"), period.alias("period"),
        F.floor(length * 1000 / period).cast("long").alias("exponent_milli"),
        F.sha2(listed, 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )
