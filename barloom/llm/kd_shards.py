"""Operator 7: shards of equal bytes by a k-d tree over document metadata, in DataFrame operations alone.

Dimensions are the id, the length, the source and the language, each scaled to the range it has over all documents. A node is
split across the dimension in which its documents spread widest, at the weighted median of their bytes (or the weighted
quantile, where the two sides get different numbers of shards). Medians of all nodes of a level are found together, by
histograms that Spark sums: each pass narrows every node's cut to one of ``BINS`` bins, until the bin weighs next to
nothing. Ties within a dimension are ordered by a hash, so any node can be cut. The tree is a nested conditional
expression. The driver sees nodes x bins numbers.

Equal texts stay together. A group takes the place of its first document in the tree; one that weighs more than a sixteenth of a
shard, too much for a cut to pass beside it, is given a shard beforehand (heaviest first, where least room is left), and the tree
deals the other documents into the room around it. There are at most 16 such groups a shard. Only what fits in no shard, as
it is heavier than a whole one or no room is left, is dealt by document, or shards could not be near equal.

Size is the UTF-8 length of the text plus 8; a null text has length 0. Null metadata take the lowest place of their
dimension. Repeated rows are rows of their own. An empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from barloom.llm.common import documents
from barloom.session import materialized

SHARDS = 24
BINS = 1024
#: A cut is good enough where the bin it lies in holds this part of a shard.
CLOSE = 1 / 1000
#: Groups above this part of a shard are given one.
HEAVY = 1 / 16
#: Documents numbered by one task.
NUMBERED = 100_000
TIE_BITS = 40


def weighed(docs: DataFrame) -> DataFrame:
    """doc_id, rid, size, text_crc32, g1 and g2 (of the text) and m (metadata as doubles in [0, 1) or raw numbers)."""
    text = F.coalesce(F.col("text"), F.lit(""))
    name = lambda c: F.when(F.col(c).isNull(), 0.0).otherwise(F.pmod(F.xxhash64(F.col(c).cast("string")), F.lit(1 << 20)) + 1.0)
    m = F.struct(F.col("doc_id").cast("double").alias("d0"), F.log1p(F.length(text)).alias("d1"), name("source").alias("d2"), name("lang").alias("d3"))
    return docs.select("doc_id", F.xxhash64(F.lit(9), "doc_id", text).alias("rid"), (F.octet_length(text) + 8).cast("long").alias("size"),
        F.crc32(F.encode(text, "UTF-8")).alias("text_crc32"), F.xxhash64(text).alias("g1"), F.xxhash64(text, F.lit(9)).alias("g2"), m.alias("m"))


def pinned(weights: list[int], shards: int, room: float) -> tuple[list[int | None], list[int]]:
    """For weights in falling order the shard that each is given (None: it fits in none), and what each shard then holds."""
    held = [0] * shards
    out: list[int | None] = []
    for w in weights:
        k = min((k for k in range(shards) if held[k] + w <= room), key=lambda k: (-held[k], k), default=None)
        out.append(k)
        if k is not None:
            held[k] += w
    return out, held


def placed(docs: DataFrame, shards: int) -> tuple[DataFrame, list[int]]:
    """doc_id, rid, size, text_crc32, given (a shard, or null) and c0 to c3: places on each axis, as whole numbers with ties
    broken. Then what the shards are given."""
    rows = materialized(weighed(docs), "weighed")
    dims = [f"d{k}" for k in range(4)]
    total = rows.agg(F.sum("size").alias("size"), *(F.struct(F.min(f"m.{d}").alias("lo"), F.max(f"m.{d}").alias("hi")).alias(d) for d in dims)).first()
    room = (total["size"] or 0) / shards
    groups = rows.groupBy("g1", "g2").agg(F.sum("size").alias("together"), F.min(F.struct("doc_id", "rid", "m")).alias("first"), F.count("*").alias("n"))
    groups = materialized(groups.filter("n > 1").select("g1", "g2", "together", F.col("first.m").alias("own")), "groups")
    heavy = groups.filter(F.col("together") > room * HEAVY).select("together", "g1", "g2").orderBy(F.desc("together"), "g1", "g2").collect()
    shard, held = pinned([g.together for g in heavy], shards, room)
    # rows of heavy groups, at most shards / HEAVY of them, are known by a small broadcast table and spread over the tasks of the join
    if heavy:
        values = ", ".join(f"({g.g1}L, {g.g2}L, {'NULL' if k is None else k})" for g, k in zip(heavy, shard, strict=True)).replace("-9223372036854775808L", "(-9223372036854775807L - 1L)")
        names = docs.sparkSession.sql(f"SELECT h1 AS g1, h2 AS g2, CAST(given AS INT) AS given, true AS heavy FROM VALUES {values} AS t(h1, h2, given)")
        rows = rows.join(F.broadcast(names), ["g1", "g2"], "left")
    else:
        rows = rows.select("*", F.lit(None).cast("int").alias("given"), F.lit(None).cast("boolean").alias("heavy"))
    rows = rows.withColumn("salt", F.when(F.col("heavy"), F.col("rid")).otherwise(F.lit(0)))
    light = groups.filter(F.col("together") <= room * HEAVY).select("g1", "g2", F.lit(0).cast("long").alias("salt"), "own")
    joined = rows.join(light, ["g1", "g2", "salt"], "left")
    grouped = F.col("own").isNotNull()
    tie = F.shiftrightunsigned(F.when(grouped, F.xxhash64("g1", "g2")).otherwise(F.xxhash64("rid")), 64 - TIE_BITS)

    def axis(d: str) -> Column:
        lo, hi = total[d]["lo"], total[d]["hi"]
        v = F.coalesce(F.when(grouped, F.col("own")[d]).otherwise(F.col("m")[d]), F.lit(lo))
        part = (v - F.lit(lo)) / F.lit((hi - lo) or 1.0) if lo is not None else F.lit(0.0)
        return F.least((part * ((1 << 21) - 1)).cast("long"), F.lit((1 << 21) - 1)) * (1 << TIE_BITS) + tie

    places = joined.select("doc_id", "rid", "size", "text_crc32", "given", *(axis(d).alias(f"c{k}") for k, d in enumerate(dims)))
    return materialized(places, "places"), held


class Node:
    """A range of shards, and once it is split, the axis, the cut and the two sides."""

    def __init__(self, first: int, count: int):
        self.first, self.count = first, count
        self.axis: int | None = None
        self.cut = 0
        self.sides: tuple[Node, Node] | None = None

    def leaves(self) -> list[Node]:
        return [self] if self.sides is None else [x for s in self.sides for x in s.leaves()]

    def expression(self) -> Column:
        """The first shard of the leaf that a document lies in."""
        if self.sides is None:
            return F.lit(self.first)
        return F.when(F.col(f"c{self.axis}") < self.cut, self.sides[0].expression()).otherwise(self.sides[1].expression())


def tree(places: DataFrame, room: list[float]) -> Node:
    """The tree over documents that are given no shard, by the room of each shard."""
    root, places = Node(0, len(room)), places.filter("given is null")
    while open_ := {n.first: n for n in root.leaves() if n.count > 1}:
        rows = places.withColumn("node", root.expression())
        found = {r.node: r for r in rows.groupBy("node").agg(F.sum("size").alias("size"), *(F.min(f"c{k}").alias(f"lo{k}") for k in range(4)), *(F.max(f"c{k}").alias(f"hi{k}") for k in range(4))).collect()}
        cuts: dict[int, dict] = {}
        for first, node in open_.items():
            r = found.get(first)
            node.axis = max(range(4), key=lambda k: (r[f"hi{k}"] - r[f"lo{k}"], -k)) if r else 0
            lo, hi = (r[f"lo{node.axis}"], r[f"hi{node.axis}"] + 1) if r else (0, 1)
            half = node.count // 2
            left, right = (sum(room[a : a + n]) for a, n in ((first, half), (first + half, node.count - half)))
            part = left / (left + right) if left + right else half / node.count
            cuts[first] = {"lo": lo, "hi": hi, "want": (r.size if r else 0) * part, "close": (r.size if r else 0) / node.count * CLOSE, "below": 0, "done": hi - lo < 2}
        while live := {k: c for k, c in cuts.items() if not c["done"]}:
            narrow(rows, open_, live)
        for first, node in open_.items():
            node.cut = cuts[first]["lo"]
            half = node.count // 2
            node.sides = Node(first, half), Node(first + half, node.count - half)
    return root


def narrow(rows: DataFrame, nodes: dict[int, Node], cuts: dict[int, dict]) -> None:
    """Narrows each cut to the bin in which the wanted weight is reached; ``lo`` becomes the cut."""
    at, low, step = F.lit(None).cast("long"), F.lit(0).cast("long"), F.lit(1).cast("long")
    for k, c in cuts.items():
        c["step"] = -(-(c["hi"] - c["lo"]) // BINS)
        own = F.col("node") == k
        place = F.col(f"c{nodes[k].axis}")
        at = F.when(own & (place >= c["lo"]) & (place < c["hi"]), place).otherwise(at)
        low, step = F.when(own, F.lit(c["lo"])).otherwise(low), F.when(own, F.lit(c["step"])).otherwise(step)
    binned = rows.select("node", at.alias("at"), low.alias("low"), step.alias("step"), "size").filter("at is not null")
    sums: dict[int, dict[int, int]] = {}
    for node, b, size in binned.groupBy("node", F.expr("(at - low) div step").alias("bin")).agg(F.sum("size")).collect():
        sums.setdefault(node, {})[b] = size
    for k, c in cuts.items():
        below = c["below"]
        for b, size in sorted(sums.get(k, {}).items()):
            if below + size >= c["want"]:
                break
            below += size
        lo = c["lo"] + b * c["step"]
        hi = min(lo + c["step"], c["hi"])
        if size <= c["close"] or hi - lo < 2:
            # the nearer edge of the last bin
            c["lo"], c["done"] = (lo if c["want"] - below < below + size - c["want"] else hi), True
        else:
            c["lo"], c["hi"], c["below"] = lo, hi, below


def sharded(docs: DataFrame, shards: int = SHARDS) -> DataFrame:
    """doc_id, size, text_crc32, shard and slot."""
    places, held = placed(docs, shards)
    count, size = places.agg(F.count("*"), F.coalesce(F.sum("size"), F.lit(0))).first()
    buckets = max(8, -(-count // (shards * NUMBERED)))
    leaf = tree(places, [max(size / shards - h, 0.0) for h in held]).expression().cast("int")
    rows = places.select("doc_id", "rid", "size", "text_crc32", F.coalesce("given", leaf).alias("shard"), F.pmod(F.xxhash64("rid", "size"), F.lit(buckets)).alias("bucket"))
    rows = materialized(rows, "shards")
    sums = rows.groupBy("shard", "bucket").agg(F.count("*").alias("n"))
    before = sums.select("shard", "bucket", (F.sum("n").over(Window.partitionBy("shard").orderBy("bucket")) - F.col("n")).alias("before"))
    own = F.row_number().over(Window.partitionBy("shard", "bucket").orderBy("doc_id", "rid", "text_crc32"))
    return rows.withColumn("own", own).join(before, ["shard", "bucket"]).select("doc_id", "size", "text_crc32", "shard", (F.col("before") + F.col("own") - 1).alias("slot"))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    done = sharded(documents(spark, sf_dir))
    return done.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))
