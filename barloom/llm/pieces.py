"""Operator 2: SentencePiece BPE encoding and decoding by vectorised merge rounds.

All distinct words of a batch lie in one flat symbol array. A round finds the least pair rank of every word
(a segmented minimum), merges the leftmost occurrences of that pair in all words at once, closes the gaps and looks up
only the pairs that changed. Words with nothing left to merge leave the arrays. The result is exactly the library's:
where a merge would make a pair that ranks before the one just merged, only the leftmost occurrence is merged in
that round, as the sequential algorithm does.

Nulls count as empty texts, which have no ids. Texts of any length are encoded whole.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from barloom.llm.common import documents, slices

MARK = "▁"
NONE = np.int64(1 << 40)
#: Encoded words kept by a Python worker between batches.
CACHE = 600_000


class PieceModel:
    """Vocabulary and pair ranks of a SentencePiece BPE model with byte fallback."""

    def __init__(self, path: str):
        import sentencepiece

        sp = sentencepiece.SentencePieceProcessor(model_file=path)
        size = sp.get_piece_size()
        self.pieces = [sp.id_to_piece(i) for i in range(size)]
        normal = [i for i in range(size) if not (sp.is_control(i) or sp.is_unknown(i) or sp.is_byte(i) or sp.is_unused(i))]
        self.bytes = {int(self.pieces[i][3:5], 16): i for i in range(size) if sp.is_byte(i)}
        known = {self.pieces[i]: i for i in normal}
        probe = " a  ½ﬁ\tÅ "
        if sp.normalize(probe) != MARK + probe.replace(" ", MARK) or len(self.bytes) != 256:
            raise ValueError("only models that keep their text as it is and fall back to bytes are supported")
        if any(re.search(f"[^{MARK}]{MARK}", p) for p in known) or any(c not in known for p in known for c in p):
            raise ValueError("pieces across words, or of unknown characters, are not supported")
        self.single = np.full(0x110000, -1, np.int64)
        for p, i in known.items():
            if len(p) == 1:
                self.single[ord(p)] = i
        by_score = sorted((i for i in normal if len(self.pieces[i]) > 1), key=lambda i: (-sp.get_score(i), i))
        self.made = np.array(by_score, np.int64)
        pairs: dict[int, int] = {}
        for rank, i in enumerate(by_score):
            p = self.pieces[i]
            for cut in range(1, len(p)):
                if (a := known.get(p[:cut])) is not None and (b := known.get(p[cut:])) is not None:
                    pairs[a << 32 | b] = rank
        self.keys = np.array(sorted(pairs), np.int64)
        self.ranks = np.array([pairs[k] for k in self.keys.tolist()], np.int64)
        self.names = [str(i) for i in range(size)]
        self.decoded = [p.replace(MARK, " ").encode() for p in self.pieces]
        for value, i in self.bytes.items():
            self.decoded[i] = bytes([value])
        for i in range(size):
            if sp.is_control(i):
                self.decoded[i] = b""
        # a line end that is no piece never merges, so it parts words as well as blanks do
        self.words = re.compile(r"\n| +[^ \n]*|[^ \n]+" if self.single[10] < 0 else r" +[^ ]*|[^ ]+")
        self.cache: dict[str, tuple[int, str, bytes]] = {}

    def rank(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Rank of each pair, NONE if it makes no piece."""
        key = left << 32 | right
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where((self.keys[at] == key) & (left >= 0) & (right >= 0), self.ranks[at], NONE)

    def merged(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Symbols of all words, and where each word begins. Unknown characters are -1 - code point."""
        codes = np.frombuffer("".join(words).replace(" ", MARK).encode("utf-32-le"), np.uint32).astype(np.int64)
        lens = np.fromiter(map(len, words), np.int64, len(words))
        word = np.repeat(np.arange(len(words)), lens)
        sym = self.single[codes]
        sym = np.where(sym < 0, -1 - codes, sym)
        rank = np.full(len(sym), NONE)
        inner = np.flatnonzero(word[:-1] == word[1:])
        rank[inner] = self.rank(sym[inner], sym[inner + 1])
        done: list[tuple[np.ndarray, np.ndarray]] = []
        while len(sym):
            first = np.flatnonzero(np.diff(word, prepend=-1))
            length = np.diff(first, append=len(sym))
            least = np.minimum.reduceat(rank, first)
            live = np.repeat(least < NONE, length)
            if not live.all():  # words without a pair left go
                done.append((word[~live], sym[~live]))
                sym, rank, word = sym[live], rank[live], word[live]
                if not len(sym):
                    break
                kept = least < NONE
                least, length = least[kept], length[kept]
            target = np.repeat(least, length)
            hit = rank == target
            at = np.arange(len(sym))
            run = at - np.maximum.accumulate(np.where(hit, -1, at))  # 1, 2, 3 ... within adjacent hits
            take = hit & (run & 1 == 1)
            out = self.joined(sym, rank, word, take)
            early = np.unique(word[take][self.overtaken(out, target[take])])
            if len(early):
                several = np.isin(word, early)
                seen = np.flatnonzero(take)
                leading = np.zeros(len(sym), bool)
                leading[seen[np.flatnonzero(np.diff(word[seen], prepend=-1))]] = True
                out = self.joined(sym, rank, word, take & (leading | ~several))
            sym, rank, word, _ = out
        word, sym = (np.concatenate(x) for x in zip(*done, strict=True)) if done else (np.zeros(0, np.int64),) * 2
        order = np.argsort(word, kind="stable")
        return sym[order], np.searchsorted(word[order], np.arange(len(words) + 1))

    def joined(self, sym, rank, word, take):
        """One round of merges at ``take``, and the new places of the merged symbols."""
        sym, keep = sym.copy(), np.ones(len(sym), bool)
        at = np.flatnonzero(take)
        sym[at] = self.made[rank[at]]
        keep[at + 1] = False
        place = np.cumsum(keep) - 1
        sym, rank, word, at = sym[keep], rank[keep], word[keep], place[at]
        touched = np.zeros(len(sym) + 1, bool)
        touched[at] = touched[at - 1] = True
        changed = np.flatnonzero(touched[:-1])
        last = changed == len(sym) - 1
        after = np.where(last, changed, changed + 1)
        inside = ~last & (word[changed] == word[after])
        rank[changed] = np.where(inside, self.rank(sym[changed], sym[after]), NONE)
        return sym, rank, word, at

    @staticmethod
    def overtaken(out, target: np.ndarray) -> np.ndarray:
        """Which merges made a pair that ranks before the pair just merged."""
        _, rank, word, at = out
        before = np.maximum(at - 1, 0)
        return (rank[at] < target) | ((at > 0) & (word[before] == word[at]) & (rank[before] < target))

    def ids(self, symbols: list[int]) -> list[int]:
        if min(symbols, default=0) >= 0:
            return symbols
        out: list[int] = []
        for s in symbols:
            out.extend([s] if s >= 0 else [self.bytes[b] for b in chr(-1 - s).encode()])
        return out

    def learn(self, words: list[str]) -> None:
        sym, ends = self.merged(words)
        flat, ends = sym.tolist(), ends.tolist()
        name, back = self.names.__getitem__, self.decoded.__getitem__
        for word, begin, end in zip(words, ends, ends[1:], strict=False):
            ids = self.ids(flat[begin:end])
            self.cache[word] = len(ids), ",".join(map(name, ids)), b"".join(map(back, ids))

    def split(self, text: str) -> list[str]:
        return self.words.findall(" " + text.replace(MARK, " ")) if text else []

    def encode(self, texts: list[str]) -> list[list[tuple[int, str, bytes]]]:
        """For every text its words as (number of ids, ids, decoded bytes)."""
        cut = list(map(self.split, texts))
        if len(self.cache) > CACHE:
            self.cache.clear()
        if new := list(set().union(*cut).difference(self.cache)):
            self.learn(new)
        found = self.cache.__getitem__
        return [list(map(found, words)) for words in cut]

    def encode_ids(self, text: str) -> list[int]:
        return [int(x) for _, ids, _ in self.encode([text])[0] for x in ids.split(",")]

    def decode(self, ids: list[int]) -> str:
        """The text of ids: without the blank that encoding put before it; broken byte runs become U+FFFD."""
        raw = b"".join(map(self.decoded.__getitem__, ids))
        return raw.removeprefix(b" ").decode("utf-8", "replace")


@lru_cache(maxsize=2)
def model(path: str) -> PieceModel:
    return PieceModel(path)


def encoded(docs: DataFrame, path: str, text: str = "text", with_ids: bool = True) -> DataFrame:
    """Adds ``token_ids`` (array<int>) to the documents: the general interface."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = model(path)
        for batch in batches:
            for part, texts in slices(batch, text):
                ids = [[int(x) for _, s, _ in words for x in s.split(",")] for words in m.encode([t or "" for t in texts])]
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(ids, pa.list_(pa.int32()))], [*part.schema.names, "token_ids"])

    return docs.mapInArrow(run, docs.select("*", F.array(F.lit(0)).alias("token_ids")).schema)


def digests(docs: DataFrame, path: str) -> DataFrame:
    """doc_id, n_tokens, ids_sha256 and decoded_sha256 of every whole text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = model(path)
        for batch in batches:
            for part, texts in slices(batch, "text"):
                counts, ids, back = [], [], []
                for words in m.encode([t or "" for t in texts]):
                    counts.append(sum([w[0] for w in words]))
                    ids.append(hashlib.sha256(",".join([w[1] for w in words]).encode()).hexdigest())
                    back.append(hashlib.sha256(b"".join([w[2] for w in words]).removeprefix(b" ")).hexdigest())
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(counts, pa.int64()), pa.array(ids), pa.array(back)], ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return digests(documents(spark, sf_dir), public_tokenizers.path("piece_bpe_32k.model"))
