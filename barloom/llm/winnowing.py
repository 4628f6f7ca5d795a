"""Operator 5: document fingerprints by winnowing.

A text's k-grams of characters get rolling hashes. Of every window of ``WINDOW`` consecutive hashes the least is chosen, the
rightmost where several are least, and chosen hashes are kept with their positions. Any common stretch of at least
``WINDOW + GRAM - 1`` characters gives both texts a common fingerprint, and none shorter than ``GRAM`` does.

The query compares each text with an edited one, which ends in the beginning of the next document by doc_id. Documents are
dealt to ranges of doc_id by quantiles; the first document of each range is sent to the range before it as well, so every
document finds its successor in its own range, and texts are shuffled once.

Null texts count as empty. A text shorter than a window has the least of its hashes, one shorter than a k-gram the hash of all
of it, an empty one no fingerprint; two empty fingerprints are alike (1), an empty and another are not (0). A null doc_id
comes first; rows that share a doc_id are ordered by a hash of their text. One document alone is its own successor. An empty
table gives no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from barloom.llm.common import documents

GRAM = 24
WINDOW = 24
#: Documents of a range, and the most ranges.
RANGE, RANGES = 2000, 20_000
BASE = np.uint64(0xD6E8FEB86659FD93)
ODD = np.uint64(0x9E3779B97F4A7C15)


def mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * ODD
    return x ^ (x >> np.uint64(29))


def gram_hashes(codes: np.ndarray, gram: int = GRAM) -> np.ndarray:
    """Polynomial hashes of all k-grams: those of 2n characters come from those of n."""
    have, size, power = codes.astype(np.uint64) + np.uint64(1), 1, BASE
    done, done_size = None, 0
    with np.errstate(over="ignore"):
        while True:
            if gram & size:
                if done is None:
                    done = have
                else:  # what is done stands before
                    n = len(have) - done_size
                    done = done[:n] * power + have[done_size : done_size + n]
                done_size += size
            if done_size == gram:
                return mixed(done)
            have = have[:-size] * power + have[size:]
            size, power = 2 * size, power * power


def winnowed(text: str, gram: int = GRAM, window: int = WINDOW) -> tuple[np.ndarray, np.ndarray]:
    """Positions and hashes chosen."""
    codes = np.frombuffer(text.encode("utf-32-le"), np.uint32)
    if not len(codes):
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    h = gram_hashes(codes, min(gram, len(codes)))
    window = min(window, len(h))
    # the least of 1, 2, 4 ... hashes, then of whole windows from two stretches that overlap; of equals the right one
    at, least, size = np.arange(len(h)), h, 1
    while size < window:
        step = min(size, window - size)
        right = least[step:] <= least[:-step]
        at, least = np.where(right, at[step:], at[:-step]), np.where(right, least[step:], least[:-step])
        size += step
    at = at[np.flatnonzero(np.diff(at, prepend=-1))]
    return at, h[at]


def alike(a: np.ndarray, b: np.ndarray) -> float:
    """Jaccard likeness of two sets of hashes."""
    a, b = np.unique(a), np.unique(b)
    if not len(a) or not len(b):
        return float(len(a) == len(b))
    both = len(np.intersect1d(a, b, assume_unique=True))
    return both / (len(a) + len(b) - both)


def written(at: np.ndarray, h: np.ndarray) -> str:
    """position:hash pairs."""
    return ",".join([f"{p}:{x:x}" for p, x in zip(at.tolist(), h.tolist(), strict=True)])


def fingerprints(docs: DataFrame, text: str = "text") -> DataFrame:
    """Adds positions (array<long>) and hashes (array<long>) to the documents: the general interface."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [winnowed(t or "") for t in batch.column(batch.schema.get_field_index(text)).to_pylist()]
            made = [pa.array([f[0].tolist() for f in found], pa.list_(pa.int64())), pa.array([f[1].view(np.int64).tolist() for f in found], pa.list_(pa.int64()))]
            yield pa.RecordBatch.from_arrays([*batch.columns, *made], [*batch.schema.names, "positions", "hashes"])

    empty = F.array().cast("array<long>")
    return docs.mapInArrow(run, docs.select("*", empty.alias("positions"), empty.alias("hashes")).schema)


def neighboured(docs: DataFrame) -> DataFrame:
    """part, of, doc_id, text: documents by range, in order; the first of the next range (the very first after the last) comes last, with ``of`` true."""
    text = F.coalesce("text", F.lit(""))
    rows = docs.select("doc_id", text.alias("text"), F.coalesce("doc_id", F.lit(-(1 << 63))).alias("at"))
    found = rows.agg(F.count("*").alias("n"), F.min("at").alias("first")).first()
    ranges = min(RANGES, -(-found.n // RANGE))
    cuts = sorted(set(rows.agg(F.percentile_approx("at", [k / ranges for k in range(1, ranges)] or [0.5], 20 * ranges)).first()[0] or [])) if ranges > 1 else []
    edges = F.array(*(F.lit(c) for c in cuts)) if cuts else F.array().cast("array<long>")
    part = F.size(F.filter(edges, lambda e: e < F.col("at")))
    rows = rows.withColumn("part", part)
    parts = rows.groupBy("part").agg(F.min(F.struct("at", F.xxhash64("text").alias("h"))).alias("head")).orderBy("part").collect()
    heads = [(r.part, r.head.at, r.head.h, parts[k - 1].part) for k, r in enumerate(parts)]
    before, is_head = F.lit(None).cast("int"), F.lit(False)
    at, h, to = (F.array(*(F.lit(x[k]) for x in heads)) if heads else F.array().cast("array<long>") for k in (1, 2, 3))
    where = F.array_position(at, F.col("at"))
    is_head = (where > 0) & (F.get(h, where.cast("int") - 1) == F.xxhash64("text"))
    before = F.get(to, where.cast("int") - 1).cast("int")
    own = F.struct(F.col("part").cast("int").alias("part"), F.lit(False).alias("of"))
    sent = F.when(is_head, F.array(own, F.struct(before.alias("part"), F.lit(True).alias("of")))).otherwise(F.array(own))
    rows = rows.select("doc_id", "at", "text", F.explode(sent).alias("x")).select("x.part", "x.of", "at", "doc_id", "text")
    return rows.repartition(max(len(parts), 1), "part").sortWithinPartitions("part", "of", "at", F.xxhash64("text"))


def compared(docs: DataFrame) -> DataFrame:
    """doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited and near_next."""
    shape = "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows: list[tuple] = []
        held = None
        for batch in batches:
            for part, of, doc_id, text in zip(*(batch.column(k).to_pylist() for k in (0, 1, 3, 4)), strict=True):
                print_ = winnowed(text)
                if held and held[0] == part:
                    rows.append(row(*held[1:], text, print_))
                # repeated rows may send a range's head more than once: the first of them ends the range
                held = None if of else (part, doc_id, text, print_)
                if len(rows) >= 500:
                    yield table(rows)
                    rows = []
        if rows:
            yield table(rows)

    def row(doc_id, text: str, own, after: str, next_) -> tuple:
        half = len(text) // 2
        edited = text[: len(text) - half] + after[:half]
        changed = winnowed(edited)
        return doc_id, len(text), hashlib.sha256(edited.encode()).hexdigest(), written(*own), written(*changed), alike(own[1], changed[1]), alike(own[1], next_[1])

    def table(rows: list[tuple]) -> pa.RecordBatch:
        kinds = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64()]
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), kinds, strict=True)], [x.split()[0] for x in shape.split(", ")])

    return neighboured(docs).mapInArrow(run, shape)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return compared(documents(spark, sf_dir))
