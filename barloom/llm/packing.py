"""Operator 3: best-fit packing with large-item matching.

A document is its token ids and a closing 0; longer ones are cut into pieces of the capacity. What has to be decided
depends on lengths alone, so the plan is made on the histogram of lengths (at most ``capacity`` numbers, whatever the
input): lengths above a third of the capacity are matched greedily, at most two of them to a sequence (the longest
takes the longest partner that fits); smaller ones go, longest first, to the fullest sequence they fit. Sequences
that look alike are planned once, with a count. Spark then numbers the pieces of each length, in salted buckets, and
the runs of the plan turn a piece's number into its sequence and offset.

Null and empty texts are one piece holding the closing 0. Repeated rows are packed like any others. An empty table
gives no rows. The plan has no gaps: offsets of a sequence are contiguous from 0.
"""

from __future__ import annotations

import bisect
import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from barloom.llm.common import documents, slices
from barloom.session import materialized

CAPACITY = 2048
#: Encoded words kept by a Python worker between batches.
CACHE = 1_200_000
#: Pieces of one length that are numbered in one bucket, on average.
BUCKET_ROWS = 50_000


class WordIds:
    """Ids of whole texts. The tokenizer drops white space and never joins across it, so distinct words are encoded once."""

    def __init__(self, path: str):
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        size = self.tokenizer.get_vocab_size()
        self.closes = np.array([str(self.tokenizer.id_to_token(i)).endswith("</w>") for i in range(size)])
        self.cache: dict[bytes, bytes] = {}

    def learn(self, new: set[bytes]) -> None:
        """Words of letters are one token group each, so they are encoded as one text and cut at word ends.

        A full stop or comma after a letter is a token of its own, so words are encoded without it.
        """
        marked = [w for w in new if w[-1] in b".," and w[-2:-1].isalpha()]
        wanted = {w[:-1] for w in marked} | {b".", b","} | new.difference(marked)
        words = list(map(bytes.decode, wanted.difference(self.cache)))
        plain = list(filter(str.isalpha, words))
        rest = [w for w in words if not w.isalpha()]
        for at in range(0, len(plain), 5000):
            part = plain[at : at + 5000]
            ids = np.array(self.tokenizer.encode_batch_fast([" ".join(part)], add_special_tokens=False)[0].ids, "<u4")
            ends = (4 * np.flatnonzero(self.closes[ids]) + 4).tolist()
            if len(ends) == len(part):
                raw = ids.tobytes()
                self.cache.update(zip(map(str.encode, part), [raw[a:b] for a, b in zip([0, *ends], ends, strict=False)], strict=True))
            else:  # letters whose lower case is no letter alone break words up
                rest += part
        for w, e in zip(rest, self.tokenizer.encode_batch_fast(rest, add_special_tokens=False), strict=True):
            self.cache[w.encode()] = np.array(e.ids, "<u4").tobytes()
        for w in marked:
            self.cache[w] = self.cache[w[:-1]] + self.cache[w[-1:]]

    def ids(self, texts: list[str]) -> list[bytes]:
        """Little-endian unsigned 32-bit ids of every text, the closing 0 included."""
        cut = [t.encode().split() for t in texts]
        if len(self.cache) > CACHE:
            self.cache.clear()
        self.learn(set().union(*cut).difference(self.cache))
        found = self.cache.__getitem__
        return [b"".join(map(found, words)) + b"\0\0\0\0" for words in cut]


@lru_cache(maxsize=2)
def word_ids(path: str) -> WordIds:
    return WordIds(path)


def pieces(docs: DataFrame, path: str, capacity: int = CAPACITY) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32 of every piece."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        w = word_ids(path)
        for batch in batches:
            for part, texts in slices(batch, "text"):
                cols: list[list] = [[], [], [], [], []]
                for doc_id, ids in zip(part.column(0).to_pylist(), w.ids([t or "" for t in texts]), strict=True):
                    for k in range(0, -(-len(ids) // (4 * capacity))):
                        own = ids[4 * capacity * k : 4 * capacity * (k + 1)]
                        for c, v in zip(cols, (doc_id, k, capacity * k, len(own) // 4, zlib.crc32(own)), strict=True):
                            c.append(v)
                kinds = [part.schema.field(0).type, pa.int32(), pa.int64(), pa.int64(), pa.int64()]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, kinds, strict=True)], ["doc_id", "piece", "start", "length", "ids_crc32"])

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id long, piece int, start long, length long, ids_crc32 long")


@dataclass
class Sequences:
    """``count`` sequences alike: runs of (length, how many in each, offset), and what is free in each."""

    count: int
    runs: list[tuple[int, int, int]]
    free: int

    def parted(self, count: int) -> Sequences:
        self.count -= count
        return Sequences(count, list(self.runs), self.free)

    def add(self, length: int, each: int, capacity: int) -> None:
        self.runs.append((length, each, capacity - self.free))
        self.free -= length * each


class Open:
    """Sequences by the room they have left."""

    def __init__(self):
        self.room: dict[int, list[Sequences]] = {}
        self.keys: list[int] = []

    def put(self, s: Sequences) -> None:
        if s.free not in self.room:
            bisect.insort(self.keys, s.free)
            self.room[s.free] = []
        self.room[s.free].append(s)

    def tightest(self, length: int) -> Sequences | None:
        """One group of the fullest sequences that ``length`` fits."""
        k = bisect.bisect_left(self.keys, length)
        if k == len(self.keys):
            return None
        free = self.keys[k]
        s = self.room[free].pop()
        if not self.room[free]:
            del self.room[free], self.keys[k]
        return s

    def all(self) -> list[Sequences]:
        return [s for k in self.keys for s in self.room[k]]


def plan(histogram: dict[int, int], capacity: int = CAPACITY) -> list[Sequences]:
    """Sequences for the given numbers of pieces by length."""
    left = {n: c for n, c in histogram.items() if c}
    large = sorted(n for n in left if 3 * n > capacity)
    closed: list[Sequences] = []
    opened = Open()
    while large:
        n = large[-1]
        count = left[n]
        k = bisect.bisect_right(large, capacity - n) - 1
        if k >= 0 and large[k] == n and count == 1:
            k -= 1  # the last one of its length takes the next shorter partner
        if k < 0:
            made = Sequences(count, [], capacity)
            made.add(n, 1, capacity)
        else:
            m = large[k]
            count = count // 2 if m == n else min(count, left[m])
            made = Sequences(count, [], capacity)
            made.add(n, 1, capacity)
            made.add(m, 1, capacity)
            left[m] -= count
        left[n] -= made.count
        (opened.put if made.free else closed.append)(made)
        large = [x for x in large if left[x]]
    for n in sorted((n for n in left if 3 * n <= capacity), reverse=True):
        count = left[n]
        while count:
            s = opened.tightest(n)
            if s is None:
                each = min(capacity // n, count)
                s = Sequences(max(1, count // each), [], capacity)
            each = min(s.free // n, count)
            filled = min(s.count, count // each)
            if filled < s.count:  # these remain as they are
                rest = s.parted(s.count - filled)
                opened.put(rest)
            s.add(n, each, capacity)
            count -= filled * each
            (opened.put if s.free else closed.append)(s)
    return closed + opened.all()


def runs_of(sequences: list[Sequences]) -> list[tuple[int, int, int, int, int]]:
    """(length, first rank, first sequence, how many in each, offset), by length and rank."""
    used: dict[int, int] = {}
    out, first = [], 0
    for s in sequences:
        for length, each, offset in s.runs:
            out.append((length, used.get(length, 0), first, each, offset))
            used[length] = used.get(length, 0) + s.count * each
        first += s.count
    return sorted(out)


def packed(found: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """Adds sequence_id and offset to pieces (any columns, with ``length``). ``found`` is read more than once: hand in a stored table."""
    spark = found.sparkSession
    # a frequent length has as many buckets as its pieces need
    buckets = [1] * (capacity + 1)
    for length, n in found.groupBy("length").count().collect():
        buckets[length] += n // BUCKET_ROWS
    spread = F.pmod(F.xxhash64("doc_id", "piece"), F.get(F.lit(buckets), F.col("length").cast("int")))
    salted = found.withColumn("bucket", spread)
    counts = salted.groupBy("length", "bucket").count().collect()  # capacity and pieces / BUCKET_ROWS numbers
    begin: dict[tuple[int, int], int] = {}
    histogram: dict[int, int] = {}
    for length, bucket, n in sorted(counts):
        begin[length, bucket] = histogram.get(length, 0)
        histogram[length] = begin[length, bucket] + n
    table = np.array(runs_of(plan(histogram, capacity)), np.int64).reshape(-1, 5)
    lengths = sorted(histogram)
    cuts = [*np.searchsorted(table[:, 0], lengths).tolist(), len(table)]
    at = {n: table[a:b, 1:] for n, a, b in zip(lengths, cuts, cuts[1:], strict=False)}
    sent = spark.sparkContext.broadcast((begin, at))
    order = [c for c in ("doc_id", "piece", "start", "ids_crc32") if c in found.columns]
    ranked = salted.withColumn("rank", F.row_number().over(Window.partitionBy("length", "bucket").orderBy(*order)) - 1)
    names = found.columns

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        begin, at = sent.value
        for batch in batches:
            t = batch.select([*names])
            length, bucket, rank = (batch.column(batch.schema.get_field_index(c)).to_numpy() for c in ("length", "bucket", "rank"))
            sequence, offset = np.zeros(len(rank), np.int64), np.zeros(len(rank), np.int64)
            for n in np.unique(length).tolist():
                own = np.flatnonzero(length == n)
                r = rank[own].astype(np.int64) + np.array([begin[n, b] for b in bucket[own].tolist()], np.int64)
                first, seq, each, base = at[n].T
                k = np.searchsorted(first, r, side="right") - 1
                inside = r - first[k]
                sequence[own] = seq[k] + inside // each[k]
                offset[own] = base[k] + inside % each[k] * n
            yield pa.RecordBatch.from_arrays([*t.columns, pa.array(sequence), pa.array(offset)], [*names, "sequence_id", "offset"])

    shape = found.withColumns({"sequence_id": F.lit(0).cast("long"), "offset": F.lit(0).cast("long")}).schema
    return ranked.mapInArrow(place, shape)


def pack_documents(docs: DataFrame, path: str, capacity: int = CAPACITY) -> DataFrame:
    return packed(materialized(pieces(docs, path, capacity), "pieces"), capacity)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return pack_documents(documents(spark, sf_dir), public_tokenizers.path("word_bpe_49k.json"))
