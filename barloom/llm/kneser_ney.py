"""Operator 10: interpolated modified Kneser-Ney bigram model, counted in Spark and looked up in memory-mapped arrays.

Counting. Tasks turn texts into sorted (key, count) blocks, dealt to shards by a hash of the key; Spark shuffles the
blocks and every shard adds up its own. The number of shards follows from the number of training tokens, so a shard
holds about ``SHARD_KEYS`` keys at any input size. Pairs are dealt by their first word, so that the totals of a context
are complete in its shard; words with more than a shard's share of the tokens are dealt by the pair instead, and
their totals come together from the shards.

Store. Each shard is a pair of sorted arrays in the shared folder (``spark.checkpoint.dir``, which must be a path that
executors can open): vocabulary (word hash, count), pairs (first id, second id as one key, count), contexts (totals),
continuations (distinct words before a word). Workers map the files into memory and search whole batches of sorted
keys at once; nothing of the model passes through the driver but its list of shards, the totals, and the frequent
contexts (at most one for each shard).

Model. p(v|u) = (n(u,v) - D(n)) / n(u) + g(u) p(v), with p(v) discounted likewise from continuation counts and mixed with
the uniform 1 / (V + 1). Discounts come from counts of counts. A text is scored from a start mark to an end token.

Nulls count as empty texts, which are one end token. A null doc_id is trained on. Repeated rows count each time. With
nothing to train on, every token has the uniform probability 1. Words are known by 64-bit hashes. An empty table gives no rows.
"""

from __future__ import annotations

import os
import uuid
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import zlib
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from barloom.llm.common import WordHashes, documents, slices
from barloom.session import scratch_path

SHARD_KEYS = 1_500_000
ODD = np.uint64(0x9E3779B97F4A7C15)
#: Hash of the end token: that of a string that is no word.
END = b" "
BLOCK = "shard int, keys binary, counts binary"


def spread(x: np.ndarray, shards: int) -> np.ndarray:
    x = x.astype(np.uint64) * ODD
    return ((x ^ (x >> np.uint64(31))) * ODD >> np.uint64(33)).astype(np.int64) % shards


def squeezed(keys: np.ndarray, counts: np.ndarray) -> tuple[bytes, bytes]:
    """Sorted keys as byte planes of their differences, and counts, both deflated."""
    steps = np.diff(keys.astype(np.uint64), prepend=np.uint64(0))
    return tuple(zlib.compress(np.ascontiguousarray(x.view(np.uint8).reshape(-1, 8).T).tobytes(), 1) for x in (steps, counts.astype(np.uint64)))


def opened(keys: bytes, counts: bytes) -> tuple[np.ndarray, np.ndarray]:
    planes = [np.frombuffer(zlib.decompress(x), np.uint8) for x in (keys, counts)]
    steps, n = (np.ascontiguousarray(x.reshape(8, -1).T).view(np.uint64).ravel() for x in planes)
    return np.cumsum(steps, dtype=np.uint64), n.astype(np.int64)


def summed(keys: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    order = np.argsort(keys, kind="stable")
    keys, counts = keys[order], counts[order]
    first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])) if len(keys) else np.zeros(0, np.int64)
    return keys[first], np.add.reduceat(counts, first) if len(first) else counts


def blocks(shard: np.ndarray, keys: np.ndarray, counts: np.ndarray) -> pa.RecordBatch:
    """Keys by shard, each shard's part sorted and without repeats."""
    order = np.lexsort((keys, shard))
    shard, keys, counts = shard[order], keys[order], counts[order]
    cuts = np.flatnonzero(np.diff(shard, prepend=-1, append=-1)) if len(shard) else np.zeros(1, np.int64)
    packed = [squeezed(keys[a:b], counts[a:b]) for a, b in zip(cuts, cuts[1:], strict=False)]
    return pa.RecordBatch.from_arrays([pa.array(shard[cuts[:-1]], pa.int32()), pa.array([k for k, _ in packed], pa.binary()), pa.array([c for _, c in packed], pa.binary())], ["shard", "keys", "counts"])


def local(path: str) -> str:
    """The shared folder as a path to open: anything but a mounted folder is refused."""
    plain = path.removeprefix("file://")
    if "://" in plain or plain.startswith("file:") and not plain.removeprefix("file:").startswith("/"):
        raise ValueError(f"the model needs a shared folder that executors can open; spark.checkpoint.dir is {path}")
    return plain.removeprefix("file:")


def save(path: str, *arrays: np.ndarray) -> None:
    """Whole or not at all, so that a repeated task does no harm."""
    for i, a in enumerate(arrays):
        own = f"{path}.{i}.{uuid.uuid4().hex}"
        a.tofile(own)
        os.replace(own, f"{path}.{i}")


@dataclass
class Store:
    """Sorted arrays in shards: keys (uint64) and values (int64), one file each."""

    path: str
    sizes: dict[int, int]
    width: int = 1
    maps: dict = field(default_factory=dict)

    def arrays(self, shard: int) -> list[np.ndarray]:
        if shard not in self.maps:
            self.maps[shard] = [np.memmap(f"{self.path}-{shard}.{i}", np.uint64 if i == 0 else np.int64, "r") for i in range(1 + self.width)]
        return self.maps[shard]

    def find(self, shard: np.ndarray, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Place within the shard (-1 if absent) and values (0 if absent) of each key."""
        place, found = np.full(len(keys), -1), np.zeros((self.width, len(keys)), np.int64)
        order = np.lexsort((keys, shard))
        cuts = np.flatnonzero(np.diff(shard[order], prepend=-1, append=-1)) if len(keys) else np.zeros(1, np.int64)
        for a, b in zip(cuts, cuts[1:], strict=False):
            own = order[a:b]
            if not self.sizes.get(k := int(shard[own[0]])):
                continue
            have, *values = self.arrays(k)
            at = np.minimum(np.searchsorted(have, keys[own]), len(have) - 1)
            hit = have[at] == keys[own]
            place[own[hit]] = at[hit]
            for i, v in enumerate(values):
                found[i, own[hit]] = v[at[hit]]
        return place, found


@dataclass
class Vocabulary(Store):
    """Words by the upper bits of their hash, so that the place in all shards together is an id."""

    bits: int = 0
    before: np.ndarray | None = None

    def ids(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        shard = (hashes >> np.uint64(64 - self.bits)).astype(np.int64) if self.bits else np.zeros(len(hashes), np.int64)
        place, values = self.find(shard, hashes)
        return np.where(place >= 0, place + self.before[shard], -1), values[0]


class Tokens:
    """Word hashes of texts with an end token each; the words' first places mark where a text begins."""

    def __init__(self):
        self.hashes = WordHashes()

    def __call__(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        words = [[*(t or "").encode().lower().split(), END] for t in texts]
        return self.hashes(words), np.cumsum([len(w) for w in words])


def gathered(rows: DataFrame, finish, schema: str) -> DataFrame:
    """One call of ``finish`` for each shard, on its summed keys and counts."""

    def run(table: pa.Table) -> pa.Table:
        shard = table.column("shard")[0].as_py()
        parts = [opened(k.as_py(), c.as_py()) for k, c in zip(table.column("keys"), table.column("counts"), strict=True)]
        return finish(shard, *summed(*(np.concatenate(x) for x in zip(*parts, strict=True))))

    return rows.groupBy("shard").applyInArrow(run, schema)


def counts_of(n: np.ndarray) -> list[int]:
    return [int((n == k).sum()) for k in (1, 2, 3, 4)]


def discounts(n: list[int]) -> list[float]:
    """Of counts 0, 1, 2 and 3 or more; a plain half where counts of counts are missing."""
    if min(n) == 0:
        return [0.0, 0.5, 0.5, 0.5]
    y = n[0] / (n[0] + 2 * n[1])
    return [0.0, *(min(max(k - (k + 1) * y * n[k] / n[k - 1], 0.05), k - 0.05) for k in (1, 2, 3))]


@dataclass
class Model:
    words: Vocabulary
    pairs: Store
    contexts: Store
    continuations: Store
    shards: int
    frequent: np.ndarray
    tokens: int
    types: int
    #: distinct pairs, discounts of pairs and of continuations, and what the latter leave for the uniform part
    distinct: int = 0
    d2: list = field(default_factory=list)
    d1: list = field(default_factory=list)
    rest: float = 1.0
    often: dict = field(default_factory=dict)

    def start(self) -> int:
        """Id of the start mark: one past the vocabulary."""
        return self.types

    def pair_shard(self, first: np.ndarray, second: np.ndarray) -> np.ndarray:
        by_pair = np.isin(first, self.frequent)
        return spread(np.where(by_pair, first + (second + 1) * (self.types + 1), first), self.shards)

    def key(self, first: np.ndarray, second: np.ndarray) -> np.ndarray:
        return first.astype(np.uint64) * np.uint64(self.types + 1) + second.astype(np.uint64)

    def contexts_of(self, ids: np.ndarray, ends: np.ndarray) -> np.ndarray:
        before = np.concatenate([[self.start()], ids[:-1]]) if len(ids) else ids
        before[ends[:-1]] = self.start()
        return before

    def unigram(self, n: np.ndarray) -> np.ndarray:
        """Probability of words by their number of continuations."""
        d = np.array(self.d1)[np.minimum(n, 3)]
        return (n - d) / max(self.distinct, 1) + self.rest / (self.types + 1)

    def log10(self, ids: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """log10 probability of every token."""
        before = self.contexts_of(ids, ends)
        word, of_word = np.unique(ids, return_inverse=True)
        p = self.unigram(self.continuations.find(spread(word, self.shards), word.astype(np.uint64))[1][0])[of_word]
        given, of_given = np.unique(before, return_inverse=True)
        totals = self.contexts.find(spread(given, self.shards), given.astype(np.uint64))[1]
        for i, u in enumerate(given.tolist()):
            if u in self.often:
                totals[:, i] = self.often[u]
        n, n1, n2, n3 = totals
        left = np.where(n > 0, (self.d2[1] * n1 + self.d2[2] * n2 + self.d2[3] * n3) / np.maximum(n, 1), 1.0)[of_given]
        n = n[of_given]
        known = np.flatnonzero((ids >= 0) & (before >= 0))
        key, at, of = np.unique(self.key(before[known], ids[known]), return_index=True, return_inverse=True)
        shard = self.pair_shard(before[known][at], ids[known][at])
        c = np.zeros(len(ids), np.int64)
        c[known] = self.pairs.find(shard, key)[1][0][of]
        return np.log10((c - np.array(self.d2)[np.minimum(c, 3)]) / np.maximum(n, 1) + left * p)


def train(docs: DataFrame) -> Model:
    """Counts the texts of ``docs`` (column text) and stores the model in the shared folder."""
    spark = docs.sparkSession
    base = local(scratch_path(spark, "ngrams"))
    os.makedirs(base)
    docs = docs.select("text")
    volume = docs.agg(F.sum(F.length("text"))).first()[0] or 0
    # at most as many distinct words as words; a fifth of the letters is a generous guess of that, only to size the shards
    bits = max(0, int(volume / 5 / SHARD_KEYS).bit_length())
    parts = 1 << bits

    def words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = Tokens()
        for batch in batches:
            for _, texts in slices(batch, "text"):
                key, n = np.unique(tokens(texts)[0], return_counts=True)
                yield blocks((key >> np.uint64(64 - bits)).astype(np.int64) if bits else np.zeros(len(key), np.int64), key, n)

    def keep_words(shard: int, key: np.ndarray, n: np.ndarray) -> pa.Table:
        save(f"{base}/words-{shard}", key, n)
        return pa.table({"shard": pa.array([shard], pa.int32()), "size": [len(key)], "total": [int(n.sum())]})

    found = gathered(docs.mapInArrow(words, BLOCK), keep_words, "shard int, size long, total long").collect()
    sizes = {r.shard: r.size for r in found}
    before = np.cumsum([0, *(sizes.get(k, 0) for k in range(parts))])[:-1]
    vocabulary = Vocabulary(f"{base}/words", sizes, bits=bits, before=before)
    tokens, types = sum(r.total for r in found), sum(sizes.values())
    shards = max(4, -(-tokens // SHARD_KEYS))
    frequent = often(spark, vocabulary, parts, tokens // shards)
    model = Model(vocabulary, Store(f"{base}/pairs", {}), Store(f"{base}/contexts", {}, 4), Store(f"{base}/after", {}), shards, frequent, tokens, types)

    def pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        read = Tokens()
        for batch in batches:
            for _, texts in slices(batch, "text"):
                hashes, ends = read(texts)
                own, of = np.unique(hashes, return_inverse=True)
                ids = model.words.ids(own)[0][of]
                first = model.contexts_of(ids, ends)
                key, at, n = np.unique(model.key(first, ids), return_index=True, return_counts=True)
                yield blocks(model.pair_shard(first[at], ids[at]), key, n)

    def keep_pairs(shard: int, key: np.ndarray, n: np.ndarray) -> pa.Table:
        save(f"{base}/pairs-{shard}", key, n)
        first, second = key // np.uint64(types + 1), key % np.uint64(types + 1)
        context, at = np.unique(first, return_index=True)
        of = np.repeat(np.arange(len(context)), np.diff(at, append=len(key)))
        totals = [np.bincount(of, n, len(context)).astype(np.int64), *(np.bincount(of[m], minlength=len(context)) for m in (n == 1, n == 2, n > 2))]
        shared = np.isin(context, frequent)
        save(f"{base}/contexts-{shard}", context[~shared], *(t[~shared] for t in totals))
        rows = np.stack([context[shared].astype(np.int64), *(t[shared] for t in totals)])
        word, times = np.unique(second, return_counts=True)
        to = blocks(spread(word, shards), word, times)
        k = to.num_rows
        none = pa.nulls(1)
        head = {"shard": [shard], "keys": none, "counts": none, "pairs": [len(key)], "contexts": [int((~shared).sum())], "n": [counts_of(n)], "often": [rows.ravel().tolist()]}
        more = {"shard": to.column(0), "keys": to.column(1), "counts": to.column(2), "pairs": pa.nulls(k), "contexts": pa.nulls(k), "n": pa.nulls(k), "often": pa.nulls(k)}
        shape = pa.schema([("shard", pa.int32()), ("keys", pa.binary()), ("counts", pa.binary()), ("pairs", pa.int64()), ("contexts", pa.int64()), ("n", pa.list_(pa.int64())), ("often", pa.list_(pa.int64()))])
        return pa.concat_tables([pa.table(x, schema=shape) for x in (head, more)])

    path = f"{base}/counted"
    gathered(docs.mapInArrow(pairs, BLOCK), keep_pairs, f"{BLOCK}, pairs long, contexts long, n array<long>, often array<long>").write.parquet(f"file://{path}")
    counted = spark.read.parquet(f"file://{path}")
    heads = counted.filter("pairs is not null").select("shard", "pairs", "contexts", "n", "often").collect()
    model.pairs.sizes = {r.shard: r.pairs for r in heads}
    model.contexts.sizes = {r.shard: r.contexts for r in heads}
    model.distinct = sum(model.pairs.sizes.values())
    model.d2 = discounts([sum(r.n[k] for r in heads) for k in range(4)])
    for r in heads:
        for u, *totals in np.array(r.often, np.int64).reshape(5, -1).T.tolist():
            model.often[u] = (np.array(model.often.get(u, [0] * 4)) + totals).tolist()

    def keep_after(shard: int, key: np.ndarray, n: np.ndarray) -> pa.Table:
        save(f"{base}/after-{shard}", key, n)
        return pa.table({"shard": pa.array([shard], pa.int32()), "size": [len(key)], "n": pa.array([[*counts_of(n), int((n > 2).sum())]], pa.list_(pa.int64()))})

    after = gathered(counted.filter("pairs is null").select("shard", "keys", "counts"), keep_after, "shard int, size long, n array<long>").collect()
    model.continuations.sizes = {r.shard: r.size for r in after}
    n = [sum(r.n[k] for r in after) for k in range(5)]
    model.d1 = discounts(n[:4])
    model.rest = (model.d1[1] * n[0] + model.d1[2] * n[1] + model.d1[3] * n[4]) / model.distinct if model.distinct else 1.0
    return model


def often(spark: SparkSession, words: Vocabulary, parts: int, least: int) -> np.ndarray:
    """Ids of the words with more than ``least`` tokens: at most one for each shard, and the start mark."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in batch.column(0).to_pylist():
                if words.sizes.get(k):
                    ids = np.flatnonzero(words.arrays(k)[1] > least) + words.before[k]
                    yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64())], ["id"])

    found = [r.id for r in spark.range(0, parts, 1, min(parts, 200)).mapInArrow(run, "id long").collect()]
    return np.array([*found, sum(words.sizes.values())], np.int64)


def scored(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score and perplexity of every whole text."""
    sent = docs.sparkSession.sparkContext.broadcast(model)
    shape = "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double, perplexity double"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m, read = sent.value, Tokens()
        for batch in batches:
            for part, texts in slices(batch, "text"):
                hashes, ends = read(texts)
                own, of = np.unique(hashes, return_inverse=True)
                ids, n = (x[of] for x in m.words.ids(own))
                first = np.concatenate([[0], ends[:-1]])
                base = np.log10((n + 0.1) / (m.tokens + 0.1 * (m.types + 1)))
                lens = np.diff(ends, prepend=0)
                score = np.add.reduceat(m.log10(ids, ends), first)
                made = [pa.array(lens), pa.array(np.add.reduceat((n > 0).astype(np.int64), first)), pa.array(np.full(len(ends), m.tokens)), pa.array(np.add.reduceat(base, first)), pa.array(score), pa.array(10 ** (-score / lens))]
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), *made], [x.split()[0] for x in shape.split(", ")])

    return docs.select("doc_id", "held_out", "text").mapInArrow(run, shape)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    out = F.coalesce(F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(10)) == 0, F.lit(False))
    docs = docs.select("doc_id", out.alias("held_out"), "text")
    return scored(docs, train(docs.filter(~F.col("held_out"))))
