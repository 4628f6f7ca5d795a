"""What the text operators share: the documents table, words, and batches of bounded size."""

from __future__ import annotations

from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from barloom.session import prepare

#: The words of the contracts: runs of anything but ASCII white space. ``bytes.split()`` cuts at the same six bytes.
SPACE = r"[ \t-\r]"
WORD = r"[^ \t-\r]"

#: Characters of text that an Arrow task works on at a time.
SLICE = 4_000_000

#: Word hashes kept by a Python worker between batches.
CACHE = 800_000


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prepare(spark).read.parquet(f"{sf_dir}/documents.parquet")


def text_of(df: DataFrame, name: str = "text") -> Column:
    """The text; a null counts as empty."""
    return F.coalesce(df[name], F.lit(""))


def slices(batch: pa.RecordBatch, column: str, most: int = SLICE) -> Iterator[tuple[pa.RecordBatch, list[str]]]:
    """Parts of a batch with at most ``most`` characters (or one row), and their texts."""
    texts = batch.column(batch.schema.get_field_index(column)).to_pylist()
    begin, size = 0, 0
    for i, text in enumerate(texts):
        n = len(text or "")
        if size and size + n > most:
            yield batch.slice(begin, i - begin), texts[begin:i]
            begin, size = i, 0
        size += n
    if begin < len(texts):
        yield batch.slice(begin), texts[begin:]


def arrow_schema(df: DataFrame) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema

    return to_arrow_schema(df.schema)


class WordHashes:
    """64-bit hashes of the words of many texts, as one flat array."""

    def __init__(self, most: int = CACHE):
        self.most = most
        self.cache: dict[bytes, int] = {}

    def __call__(self, words: list[list[bytes]]) -> np.ndarray:
        if len(self.cache) > self.most:
            self.cache.clear()
        for w in set().union(*words).difference(self.cache):
            self.cache[w] = xxhash.xxh3_64_intdigest(w)
        return np.fromiter(map(self.cache.__getitem__, chain.from_iterable(words)), np.uint64, sum(map(len, words)))
