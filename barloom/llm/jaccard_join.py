"""Operator 9: n-gram Jaccard join by MinHash banding, with verification on full n-gram sets.

A text's set holds the hashes of its runs of five words. Texts with equal sets are a class, known by its first document;
only classes go on, so copies are never paired. Band and row counts follow from the threshold and the recall asked for.
Classes that share a band form candidate components, found from one link for each band entry to the least member of its
bucket, not from pairs. Components are cut into blocks; a task verifies one pair of blocks on full sets and returns
each document's number of links and a spanning forest of what it linked, so output is linear in the documents while
every link between different texts is counted. The forests give the final classes.

Texts of one to four words have one n-gram, the whole text. Texts without words (null, empty, blank) link to nothing, but their
sets are equal, so only one of them, that of the least doc_id, is the ``first`` of its class and stays. Repeated
rows are copies of each other. class_id is the least doc_id of a class; a null doc_id is less than any number (and a class
of such rows has a null id). An empty table gives no rows.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from barloom.llm.common import WordHashes, documents, slices
from barloom.llm.recompression import BASES, Ranges, mixed, squeezed, texts_of, unpacked
from barloom.session import materialized

WORDS = 5
SIMILARITY = 0.8
RECALL = 0.99999
HASHES = 100
#: Documents of a block, and of the small components that a task takes together.
BLOCK = 256
TOGETHER = 1000
#: Word hashes that a worker keeps, and characters it works on at a time: executors hold several workers beside Spark's own memory.
CACHE = 200_000
SLICE = 1_500_000


def banding(similarity: float = SIMILARITY, recall: float = RECALL, hashes: int = HASHES) -> tuple[int, int]:
    """Bands and rows: the most rows for which the bands that the recall needs stay within ``hashes``."""
    fits = [(math.ceil(math.log(1 - recall) / math.log(1 - similarity**r)), r) for r in range(1, hashes + 1)]
    return max((b, r) for b, r in fits if b * r <= hashes and r == max(x for n, x in fits if n * x <= hashes))


class Shingles:
    """Sorted distinct n-gram hashes of texts, as one flat array with its ends."""

    def __init__(self):
        self.hashes = WordHashes(CACHE)

    def __call__(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        words = [t.split() for t in texts]
        names = self.hashes(words)
        lens = np.fromiter(map(len, words), np.int64, len(words))
        grams = np.where(lens > WORDS, lens - WORDS + 1, np.minimum(lens, 1))
        doc = np.repeat(np.arange(len(words)), grams)
        begin = (np.cumsum(lens) - lens)[doc] + np.arange(len(doc)) - (np.cumsum(grams) - grams)[doc]
        h = Ranges(names, BASES[0])(begin, begin + np.minimum(lens, WORDS)[doc]) if len(doc) else np.zeros(0, np.uint64)
        order = np.lexsort((h, doc))
        h, doc = h[order], doc[order]
        new = np.ones(len(h), bool)
        new[1:] = (h[1:] != h[:-1]) | (doc[1:] != doc[:-1])
        h, doc = h[new], doc[new]
        return h, np.searchsorted(doc, np.arange(len(words) + 1))


def signatures(docs: DataFrame, bands: int, rows: int) -> DataFrame:
    """doc_id, rid, k1, k2 (of the set), n (n-grams) and bands of every document."""
    factors = mixed(np.arange(1, bands * rows + 1, dtype=np.uint64)) | np.uint64(1)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingles = Shingles()
        for batch in batches:
            for part, texts in slices(batch, "text", SLICE):
                h, ends = shingles([t.encode() for t in texts])
                n = np.diff(ends)
                some = np.flatnonzero(n)
                at = ends[some]
                table = np.zeros((len(n), bands), np.uint64)
                keys = np.zeros((2, len(n)), np.uint64)
                if len(some):
                    for b in range(bands):
                        own = np.full(len(some), b + 1, np.uint64)
                        for r in range(rows):
                            own = mixed(own * BASES[0] + np.minimum.reduceat(h * factors[b * rows + r], at))
                        table[some, b] = own
                    for k in (0, 1):
                        keys[k, some] = np.add.reduceat(mixed(h + BASES[k]), at)
                ends = np.concatenate([[0], np.cumsum(np.where(n > 0, bands, 0))])
                listed = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(table[some].ravel().view(np.int64)))
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array(keys[0].view(np.int64)), pa.array(keys[1].view(np.int64)), pa.array(n.astype(np.int32)), listed], ["doc_id", "rid", "k1", "k2", "n", "bands"])

    return docs.mapInArrow(run, "doc_id long, rid long, k1 long, k2 long, n int, bands array<long>")


def components(edges: DataFrame) -> DataFrame:
    """node, label (least node of its component) of the nodes of edges (a, b). Labels spread and jump until none changes."""
    both = materialized(edges.union(edges.select("b", "a")).distinct(), "edges")
    labels = materialized(both.groupBy(F.col("a").alias("node")).agg(F.least(F.min("b"), F.first("a")).alias("label")), "labels")
    while True:
        near = both.join(labels, both["b"] == labels["node"]).groupBy(F.col("a").alias("node")).agg(F.min("label").alias("near"))
        spread = labels.join(near, "node").select("node", "label", F.least("label", "near").alias("new"))
        jumps = labels.select(F.col("node").alias("new"), F.col("label").alias("far"))
        found = spread.join(jumps, "new").select("node", F.least("new", "far").alias("label"), (F.least("new", "far") != F.col("label")).alias("moved"))
        found = materialized(found, "labels")
        labels = found.select("node", "label")
        if not found.filter("moved").head(1):
            return labels


def sets(docs: DataFrame) -> DataFrame:
    """Replaces the compressed text by its n-gram set, as sorted little-endian numbers."""
    names = [c for c in docs.columns if c != "packed"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingles = Shingles()
        for batch in batches:
            for part, texts in unpacked(batch, batch.schema.get_field_index("packed")):
                h, ends = shingles(texts)
                held = [h[a:b].tobytes() for a, b in zip(ends, ends[1:], strict=False)]
                yield pa.RecordBatch.from_arrays([*(part.column(part.schema.get_field_index(c)) for c in names), pa.array(held, pa.binary())], [*names, "grams"])

    return docs.mapInArrow(run, docs.select(*names, F.lit(b"").alias("grams")).schema)


def common_grams(held: list[np.ndarray]) -> np.ndarray:
    """Sizes of all intersections of some sets."""
    m = len(held)
    if m <= 6:
        out = np.zeros((m, m), np.int64)
        for i in range(m):
            out[i, i] = len(held[i])
            for j in range(i):
                out[i, j] = out[j, i] = len(np.intersect1d(held[i], held[j], assume_unique=True))
        return out
    _, column = np.unique(np.concatenate(held), return_inverse=True)
    row = np.repeat(np.arange(m), [len(h) for h in held])
    out = np.zeros((m, m), np.float64)
    order = np.argsort(column, kind="stable")
    column, row = column[order], row[order]
    width = 2048
    for begin in range(0, int(column[-1]) + 1 if len(column) else 0, width):
        a, b = np.searchsorted(column, [begin, begin + width])
        part = np.zeros((m, width), np.float32)
        part[row[a:b], column[a:b] - begin] = 1
        out += part @ part.T
    return out.astype(np.int64)


def linked(held: list[np.ndarray], block: np.ndarray, similarity: float) -> np.ndarray:
    """Which documents link. Where there are two blocks, only across them."""
    n = np.array([len(h) for h in held])
    both = common_grams(held)
    yes = both >= similarity * (n[:, None] + n[None, :] - both) - 1e-9
    np.fill_diagonal(yes, False)
    if len(np.unique(block)) > 1:
        yes &= block[:, None] != block[None, :]
    return yes


def forest(yes: np.ndarray) -> list[tuple[int, int]]:
    """Edges of a spanning forest."""
    out, left = [], np.ones(len(yes), bool)
    for root in range(len(yes)):
        if not left[root]:
            continue
        left[root] = False
        stack = [root]
        while stack:
            u = stack.pop()
            new = np.flatnonzero(yes[u] & left)
            left[new] = False
            out.extend((u, v) for v in new.tolist())
            stack.extend(new.tolist())
    return out


def verified(placed: DataFrame, similarity: float) -> DataFrame:
    """a, b, w: links of a document (b null, w their number), and the links of spanning forests."""

    def run(table: pa.Table) -> pa.Table:
        comp = table.column("comp").to_numpy()
        order = np.argsort(comp, kind="stable")
        cuts = np.flatnonzero(np.diff(comp[order], prepend=comp[order[0]] - 1)).tolist() + [len(comp)]
        rid, block, copies = (table.column(c).to_numpy() for c in ("rid", "block", "copies"))
        grams = table.column("grams")
        a, b, w = [], [], []
        for begin, end in zip(cuts, cuts[1:], strict=False):
            own = order[begin:end]
            yes = linked([np.frombuffer(grams[i].as_py(), np.uint64) for i in own.tolist()], block[own], similarity)
            weight = yes @ copies[own]
            some = np.flatnonzero(weight)
            a.extend(rid[own[some]].tolist())
            b.extend([None] * len(some))
            w.extend(weight[some].tolist())
            for u, v in forest(yes):
                a.append(int(rid[own[u]]))
                b.append(int(rid[own[v]]))
                w.append(0)
        return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64()), "w": pa.array(w, pa.int64())})

    return placed.groupBy("g", "i", "j").applyInArrow(run, "a long, b long, w long")


def joined(docs: DataFrame, similarity: float = SIMILARITY, recall: float = RECALL) -> DataFrame:
    """doc_id, rid, class_id, n_links, first of every document; ``first``: it is the one of its class to stay."""
    docs = texts_of(docs)
    bands, rows = banding(similarity, recall)
    signed = materialized(signatures(docs, bands, rows), "signatures")
    worded = signed.filter("n > 0")
    classes = worded.groupBy("k1", "k2").agg(F.min(F.struct("doc_id", "rid", "bands")).alias("rep"), F.count("*").alias("copies"))
    classes = materialized(classes.select("k1", "k2", "rep.doc_id", "rep.rid", "rep.bands", "copies"), "classes")
    entries = classes.select("rid", F.explode("bands").alias("band"))
    hubs = entries.groupBy("band").agg(F.min("rid").alias("hub"), F.count("*").alias("n")).filter("n > 1").drop("n")
    # stored, so that both sides of the join are dealt anew and Spark can split a band that very many texts share
    hubs = materialized(hubs, "hubs")
    # a document is linked to the least of its hubs, and so are its other hubs: copies share these few links between hubs
    own = entries.join(hubs, "band").groupBy("rid").agg(F.collect_set("hub").alias("hubs")).select("rid", "hubs", F.array_min("hubs").alias("least"))
    among = own.select(F.explode("hubs").alias("a"), F.col("least").alias("b")).distinct()
    edges = own.select(F.col("rid").alias("a"), F.col("least").alias("b")).union(among).filter("a != b")
    nodes = components(edges).withColumnsRenamed({"node": "rid", "label": "comp"})
    sizes = nodes.groupBy("comp").agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("blocks"))
    placed = nodes.join(sizes, "comp").join(classes.select("rid", "copies"), "rid")
    placed = placed.withColumn("block", F.pmod(F.xxhash64("rid"), F.col("blocks")).cast("int"))
    placed = materialized(placed, "blocks")
    bins = -(-placed.filter("blocks = 1").count() // TOGETHER)
    # the texts move whatever the number of candidates: broadcast for few of them would only hide how this grows
    held = sets(squeezed(docs).drop("doc_id").join(placed.hint("shuffle_merge"), "rid").dropDuplicates(["rid"]))
    other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other")
    spread = held.select("*", other).select("rid", "comp", "copies", "block", "grams",
        F.when(F.col("blocks") == 1, F.pmod(F.xxhash64("comp"), F.lit(max(bins, 1)))).otherwise(F.col("comp")).alias("g"),
        F.when(F.col("blocks") == 1, -1).otherwise(F.least("block", "other")).alias("i"),
        F.when(F.col("blocks") == 1, -1).otherwise(F.greatest("block", "other")).alias("j"))
    found = materialized(verified(spread, similarity), "links")
    counts = found.filter("b is null").groupBy(F.col("a").alias("rid")).agg(F.sum("w").alias("others"))
    labels = components(found.filter("b is not null").select("a", "b")).withColumnsRenamed({"node": "rid", "label": "comp"})
    known = classes.drop("bands").join(labels, "rid", "left").withColumn("comp", F.coalesce("comp", "rid"))
    least = known.groupBy("comp").agg(F.min(F.struct("doc_id", "rid")).alias("least"))
    known = known.join(least, "comp").join(counts, "rid", "left")
    blank = signed.filter("n = 0").agg(F.min(F.struct("doc_id", "rid")).alias("least")).select("least.rid").first()[0]
    known = known.select("k1", "k2", "least", (F.col("copies") - 1 + F.coalesce("others", F.lit(0))).alias("links"))
    return signed.join(known, ["k1", "k2"], "left").select(
        "doc_id", "rid",
        F.when(F.col("n") > 0, F.col("least.doc_id")).otherwise(F.col("doc_id")).alias("class_id"),
        F.when(F.col("n") > 0, F.col("links")).otherwise(F.lit(0).cast("long")).alias("n_links"),
        (F.col("rid") == F.when(F.col("n") > 0, F.col("least.rid")).otherwise(F.lit(blank).cast("long"))).alias("first"))


def one_of_each(docs: DataFrame) -> DataFrame:
    """The documents without near copies: of each class of linked ones, and of those without words, the one with the least doc_id stays."""
    flags = joined(docs).filter("first").select("rid").distinct()
    text = F.coalesce(docs["text"], F.lit(""))
    rows = docs.select(F.struct(*(docs[c] for c in docs.columns)).alias("row"), F.xxhash64(F.lit(6), docs["doc_id"], text).alias("rid"))
    kept = rows.join(flags.hint("shuffle_merge"), "rid", "left_semi").dropDuplicates(["rid"])
    return kept.select(*(F.col("row")[c].alias(c) for c in docs.columns))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return joined(documents(spark, sf_dir)).select("doc_id", "class_id", "n_links")
