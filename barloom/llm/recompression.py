"""Operator 6: removal of repeated 20-word windows, found by recompression.

Every text is a string of word names. Recompression names its maximal runs of one word, and then in every round the adjacent
pairs whose left symbol falls in the left half of the alphabet and whose right symbol in the right half. Names are
64-bit hashes of what they stand for, so all tasks give equal things equal names without a table of names. Each symbol
carries the range of words that its existence depended on; a symbol whose range lies inside a window is found in every
copy of that window. Each window picks one such interior symbol by a rule on content alone (a wide range, then the least
name), so equal windows pick equal symbols. Spark counts the picked symbols over all texts: a window whose symbol
occurs once is unique. The windows that are left, and those without an interior symbol, are verified by hashes of all
their words (128 bits with the symbol): the earliest stays and the words of all others go.

Equal texts need no windows: all but the earliest lose every word, if there are at least 20.

Null texts count as empty: no words, nothing removed, the hash of an empty string. Texts under 20 words are kept whole.
A null doc_id is earlier than any number. Repeated rows are one document; texts that share a doc_id are ordered by a hash.
An empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from barloom.llm.common import SLICE, WordHashes, documents, slices
from barloom.session import materialized

WINDOW = 20
ROUNDS = 2
#: Words of a symbol's range from which on only its name counts in picking.
WIDE = 7
#: Places from which on a symbol's windows are compared one by one.
FREQUENT = 10_000
ODD = np.uint64(0x9E3779B97F4A7C15)
BASES = (np.uint64(0xD6E8FEB86659FD93), np.uint64(0xA0761D6478BD642F))
#: The symbol of windows that have none: always verified.
NO_SYMBOL = 0


def mixed(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser, so that sums and products become names."""
    x = (x ^ (x >> np.uint64(32))) * ODD
    x = (x ^ (x >> np.uint64(29))) * BASES[1]
    return x ^ (x >> np.uint64(32))


def powers(base: np.uint64, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of an odd number and of its inverse modulo 2^64."""
    out = []
    for b in (int(base), pow(int(base), -1, 1 << 64)):
        p = np.full(n, b, np.uint64)
        p[0] = 1
        out.append(np.multiply.accumulate(p))
    return out[0], out[1]


class Ranges:
    """Hashes of any ranges of words of a flat array."""

    def __init__(self, names: np.ndarray, base: np.uint64):
        up, self.down = powers(base, len(names) + 1)
        self.sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(names * up[:-1], dtype=np.uint64)])

    def __call__(self, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
        return mixed((self.sums[end] - self.sums[begin]) * self.down[begin] + (end - begin).astype(np.uint64) * ODD)


def parse(names: np.ndarray, doc: np.ndarray, rounds: int = ROUNDS) -> tuple[np.ndarray, np.ndarray]:
    """First and last word of what each symbol depends on, after the given rounds. Ranges may reach past their text."""
    sym, lo, hi = mixed(names), np.arange(len(names)), np.arange(len(names))
    if len(sym):
        # maximal runs of one word: each depends on the word before and after
        first = np.flatnonzero(np.concatenate([[True], (sym[1:] != sym[:-1]) | (doc[1:] != doc[:-1])]))
        count = np.diff(first, append=len(sym))
        lo, hi = first - 1, first + count
        sym = np.where(count > 1, mixed(sym[first] * BASES[0] + count.astype(np.uint64)), sym[first])
        doc = doc[first]
    for k in range(rounds):
        if len(sym) < 2:
            break
        # pairs of a left and a right symbol; the others depend on the neighbour they failed to pair with
        left = (sym >> np.uint64(17 + k)) & np.uint64(1) == 0
        joint = doc[1:] == doc[:-1]
        pair = left[:-1] & ~left[1:] & joint
        starts, follows = np.append(pair, False), np.concatenate([[False], pair])
        edge_after, edge_before = np.append(~joint, True), np.concatenate([[True], ~joint])
        single = ~starts & ~follows
        reach_hi = np.where(edge_after, hi + 1, np.append(hi[1:], 0))
        reach_lo = np.where(edge_before, lo - 1, np.concatenate([[0], lo[:-1]]))
        new_hi = np.where(single & left, np.maximum(hi, reach_hi), hi)
        new_lo = np.where(single & ~left, np.minimum(lo, reach_lo), lo)
        # a pair's range holds both of its symbols' ranges
        new_lo = np.where(starts, np.minimum(lo, np.append(lo[1:], 0)), new_lo)
        new_hi = np.where(starts, np.maximum(hi, np.append(hi[1:], 0)), new_hi)
        new_sym = np.where(starts, mixed(sym * BASES[1] + np.append(sym[1:], np.uint64(0)) + np.uint64(k)), sym)
        kept = ~follows
        sym, lo, hi, doc = new_sym[kept], new_lo[kept], new_hi[kept], doc[kept]
    return lo, hi


def picked(names: np.ndarray, ends: np.ndarray, window: int = WINDOW) -> tuple[np.ndarray, ...]:
    """Every window's first word, its symbol (NO_SYMBOL if none is interior), where that begins, and its document."""
    lens = np.diff(ends, prepend=0)
    doc = np.repeat(np.arange(len(ends)), lens)
    lo, hi = parse(names, doc)
    begin = np.repeat(ends - lens, lens)
    n = len(names)
    width = hi - lo + 1
    at = np.minimum(np.maximum(lo, 0), max(n - 1, 0))
    inside = (width <= window) & (lo >= 0) & (hi < n)
    inside &= (lo >= begin[at]) & (hi < ends[doc[at]])
    lo, hi, width = lo[inside], hi[inside], width[inside]
    name = Ranges(names, BASES[0])(lo, hi + 1) | np.uint64(1) if len(lo) else np.zeros(0, np.uint64)
    # wide ones first, then the least name: as one number, so that later writes win
    rank = np.minimum(width, WIDE).astype(np.uint64) << np.uint64(58) | (~name >> np.uint64(6))
    order = np.argsort(rank, kind="stable")
    lo, name, width, rank = lo[order], name[order], width[order], rank[order]
    best, held, place = np.zeros(n, np.uint64), np.zeros(n, np.uint64), np.full(n, -1)
    for back in range(window):
        able = (width + back <= window) & (lo >= back)
        s = lo[able] - back
        better = rank[able] > best[s]
        best[s[better]] = rank[able][better]
        held[s[better]] = name[able][better]
        place[s[better]] = lo[able][better]
    starts = np.flatnonzero(np.arange(n) + window <= ends[doc]) if n else np.zeros(0, np.int64)
    return starts, held[starts], place[starts], doc[starts]


def texts_of(docs: DataFrame) -> DataFrame:
    """doc_id, rid (of equal rows the same), text."""
    text = F.coalesce(F.col("text"), F.lit(""))
    return docs.select("doc_id", F.xxhash64(F.lit(6), "doc_id", text).alias("rid"), text.alias("text"))


def symbols(docs: DataFrame) -> DataFrame:
    """sym, rid, n: the symbols that the windows of each document picked, and in how many places."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = WordHashes()
        for batch in batches:
            for part, texts in slices(batch, "text"):
                words = [t.encode().split() for t in texts]
                _, sym, place, doc = picked(hashes(words), np.cumsum([len(w) for w in words]))
                rid = part.column(0).to_numpy(zero_copy_only=False)
                order = np.lexsort((place, sym, doc))
                sym, place, doc = sym[order], place[order], doc[order]
                new = np.ones(len(sym), bool)
                new[1:] = (sym[1:] != sym[:-1]) | (doc[1:] != doc[:-1])
                moved = new.copy()
                moved[1:] |= place[1:] != place[:-1]
                n = np.diff(np.cumsum(moved)[np.append(new[1:], True)], prepend=0) if len(sym) else new
                yield pa.RecordBatch.from_arrays([pa.array(sym[new].view(np.int64)), pa.array(rid[doc[new]]), pa.array(n, pa.int32())], ["sym", "rid", "n"])

    return docs.select("rid", "text").mapInArrow(run, "sym long, rid long, n int")


def squeezed(docs: DataFrame) -> DataFrame:
    """The texts as compressed bytes: half of what Spark's own compression leaves to a shuffle."""
    import zstandard

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pack = zstandard.ZstdCompressor(level=3).compress
        for batch in batches:
            packed = [pack(t.encode()) for t in batch.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns[:2], pa.array(packed, pa.binary())], ["doc_id", "rid", "packed"])

    return docs.select("doc_id", "rid", "text").mapInArrow(run, "doc_id long, rid long, packed binary")


def unpacked(batch: pa.RecordBatch, k: int) -> Iterator[tuple[pa.RecordBatch, list[bytes]]]:
    """Parts of a batch by the size of their texts."""
    import zstandard

    open_ = zstandard.ZstdDecompressor().decompress
    begin, size, texts = 0, 0, []
    for i, x in enumerate(batch.column(k)):
        texts.append(open_(x.as_py()))
        size += len(texts[-1])
        if size >= SLICE:
            yield batch.slice(begin, i + 1 - begin), texts
            begin, size, texts = i + 1, 0, []
    if texts:
        yield batch.slice(begin), texts


def member(lists: pa.ListArray, sym: np.ndarray, doc: np.ndarray) -> np.ndarray:
    """Whether a symbol is in the list of its document."""
    listed = lists.flatten().to_numpy(zero_copy_only=False)
    of = np.repeat(np.arange(len(lists)), np.diff(lists.offsets.to_numpy()))
    pairs = np.sort(mixed(listed.view(np.uint64) + of.astype(np.uint64) * ODD))
    if not len(pairs):
        return np.zeros(len(sym), bool)
    key = mixed(sym + doc.astype(np.uint64) * ODD)
    return pairs[np.minimum(np.searchsorted(pairs, key), len(pairs) - 1)] == key


def units(docs: DataFrame) -> DataFrame:
    """p, rid, doc_id, s, hashes: windows of shared symbols, to be compared within one p.

    Consecutive windows that picked one place of a symbol are a unit, and p is the symbol. Windows of frequent symbols, and those
    without a symbol, are units of their own, and p is the window: so no symbol gathers more than ``FREQUENT`` units. Of
    these a batch sends the earliest of equal windows only. The starts of the others are sent as they are (hashes null).
    """
    shape = "p long, rid long, doc_id long, s int, hashes binary, starts array<int>"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = WordHashes()
        for batch in batches:
            for part, texts in unpacked(batch, 2):
                words = [t.split() for t in texts]
                names = hashes(words)
                ends = np.cumsum([len(w) for w in words])
                starts, sym, place, doc = picked(names, ends)
                few, many = member(part.column(3), sym, doc), member(part.column(4), sym, doc)
                own = starts - np.concatenate([[0], ends[:-1]])[doc]
                h = Ranges(names, BASES[0])
                rid, ids = part.column(1).to_numpy(zero_copy_only=False), part.column(0)
                first = np.flatnonzero(few & ~(np.concatenate([[False], few[:-1]]) & (np.diff(place, prepend=-2) == 0) & (np.diff(starts, prepend=-2) == 1) & (np.diff(doc, prepend=-1) == 0)))
                raw = h(starts[few], starts[few] + WINDOW).tobytes()
                cut = (8 * np.append(np.cumsum(few)[first] - 1, few.sum())).tolist()
                held = [raw[a:b] for a, b in zip(cut, cut[1:], strict=False)]
                yield table(sym[first], rid, ids, doc[first], own[first], held, None)
                begin, doc, own = starts[many], doc[many], own[many]
                one, two = h(begin, begin + WINDOW), Ranges(mixed(names + BASES[1]), BASES[1])(begin, begin + WINDOW) if len(begin) else begin
                # the order of documents here is that of (doc_id, rid)
                rank = np.empty(part.num_rows, np.int64)
                rank[np.lexsort((rid, filled(ids)))] = np.arange(part.num_rows)
                order = np.lexsort((own, rank[doc], two, one))
                same = (one[order[1:]] == one[order[:-1]]) & (two[order[1:]] == two[order[:-1]])
                group = np.concatenate([[True], ~same])[: len(order)]
                lead = order[np.maximum.accumulate(np.where(group, np.arange(len(order)), 0))]
                sent = np.sort(order[group])
                # rows that are given twice (repeated documents) are one: neither sent again nor later
                later = np.zeros(len(one), bool)
                later[order] = (rid[doc[order]] != rid[doc[lead]]) | (own[order] != own[lead])
                yield table(one[sent], rid, ids, doc[sent], own[sent], [two[i : i + 1].tobytes() for i in sent], None)
                doc, own = doc[later], own[later]
                cut = np.flatnonzero(np.diff(doc, prepend=-1, append=-1)) if len(doc) else np.zeros(1, np.int64)
                found = [own[a:b].tolist() for a, b in zip(cut, cut[1:], strict=False)]
                yield table(rid[doc[cut[:-1]]].view(np.uint64), rid, ids, doc[cut[:-1]], own[cut[:-1]], [None] * len(found), found)

    def table(p, rid, ids, doc, s, held, starts) -> pa.RecordBatch:
        starts = pa.nulls(len(p), pa.list_(pa.int32())) if starts is None else pa.array(starts, pa.list_(pa.int32()))
        return pa.RecordBatch.from_arrays([pa.array(p.view(np.int64)), pa.array(rid[doc]), ids.take(pa.array(doc)), pa.array(s, pa.int32()), pa.array(held, pa.binary()), starts], [x.split()[0] for x in shape.split(", ")])

    return docs.select("doc_id", "rid", "packed", "few", "many").mapInArrow(run, shape)


def filled(ids: pa.Array) -> np.ndarray:
    """Numbers with nulls least."""
    return ids.fill_null(-(1 << 63)).to_numpy(zero_copy_only=False)


def later_windows(sent: DataFrame) -> DataFrame:
    """rid and the starts of windows that are not the earliest of their kind. Takes whole groups of p, sorted, a batch at a time."""
    fields = ("p", "rid", "doc_id", "s", "hashes", "starts")

    def compared(held: pa.Table) -> pa.RecordBatch:
        p, rid, s = (held.column(c).to_numpy() for c in ("p", "rid", "s"))
        ids = filled(held.column("doc_id").combine_chunks())
        blocks = held.column("hashes").to_pylist()
        count = np.array([len(x or b"") // 8 for x in blocks], np.int64)
        unit = np.repeat(np.arange(len(blocks)), count)
        h = np.frombuffer(b"".join(x or b"" for x in blocks), np.uint64)
        start = s[unit] + np.arange(len(h)) - (np.cumsum(count) - count)[unit]
        order = np.lexsort((start, rid[unit], ids[unit], h, p[unit]))
        at = unit[order]
        # rows that are given twice (repeated documents) are one
        same = (h[order][1:] == h[order][:-1]) & (p[at][1:] == p[at][:-1])
        twin = same & (rid[at][1:] == rid[at][:-1]) & (start[order][1:] == start[order][:-1])
        group = np.concatenate([[True], ~same])[: len(order)]
        lead = np.maximum.accumulate(np.where(group, np.arange(len(order)), 0))
        leading = np.concatenate([[True], ~twin])[: len(order)]
        block = np.maximum.accumulate(np.where(leading, np.arange(len(order)), 0))
        late = order[block != lead]
        late = late[np.lexsort((start[late], rid[unit[late]]))]
        of = rid[unit[late]]
        cut = np.flatnonzero(np.concatenate([[True], of[1:] != of[:-1], [True]])) if len(of) else np.zeros(1, np.int64)
        listed = [start[late[a:b]].tolist() for a, b in zip(cut, cut[1:], strict=False)]
        given = [(r, x) for r, x in zip(rid.tolist(), held.column("starts").to_pylist(), strict=True) if x]
        return pa.RecordBatch.from_arrays([pa.array([*of[cut[:-1]].tolist(), *(r for r, _ in given)], pa.int64()), pa.array([*listed, *(x for _, x in given)], pa.list_(pa.int32()))], ["rid", "starts"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        for batch in batches:
            if not batch.num_rows:
                continue
            p = batch.column(0).to_numpy()
            if p[-1] != p[0]:  # the last group may go on in the next batch
                cut = int(np.flatnonzero(p != p[-1])[-1]) + 1
                yield compared(pa.Table.from_batches([*held, batch.slice(0, cut)]))
                held = [batch.slice(cut)]
            elif held and held[-1].column(0)[0].as_py() != p[0]:
                yield compared(pa.Table.from_batches(held))
                held = [batch]
            else:
                held.append(batch)
        if held:
            yield compared(pa.Table.from_batches(held))

    sorted_ = sent.select(*fields).repartition("p").sortWithinPartitions("p")
    return sorted_.mapInArrow(run, "rid long, starts array<int>")


def removed(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """rid of later copies of whole texts; rid and the starts of later windows of the other documents. Takes texts_of()."""
    rows = docs.select("rid", "doc_id", F.xxhash64("text").alias("t1"), F.xxhash64("text", F.lit(1)).alias("t2"))
    first = rows.groupBy("t1", "t2").agg(F.min(F.struct("doc_id", "rid")).alias("first"), F.count("*").alias("n")).filter("n > 1").drop("n")
    copies = materialized(rows.join(first, ["t1", "t2"]).filter(F.col("rid") != F.col("first.rid")).select("rid").distinct(), "copies")
    found = materialized(symbols(docs), "symbols")
    repeated = found.filter(F.col("sym") != NO_SYMBOL).groupBy("sym").agg(F.sum("n").alias("n")).filter("n > 1")
    # stored, so that both sides of the join are dealt anew and Spark can split a symbol that very many texts share
    repeated = materialized(repeated.select("sym", (F.col("n") > FREQUENT).alias("often")), "repeated")
    shared = found.select("sym", "rid").join(repeated, "sym").union(found.filter(F.col("sym") == NO_SYMBOL).select("sym", "rid", F.lit(True)))
    by_row = shared.groupBy("rid").agg(
        F.collect_set(F.when(~F.col("often"), F.col("sym"))).alias("few"), F.collect_set(F.when(F.col("often"), F.col("sym"))).alias("many"))
    by_row = by_row.join(copies, "rid", "left_anti")
    late = later_windows(units(squeezed(docs).join(by_row, "rid")))
    return copies, late.groupBy("rid").agg(F.array_distinct(F.flatten(F.collect_list("starts"))).alias("starts"))


def deduplicated(docs: DataFrame) -> DataFrame:
    """Adds to the columns doc_id and text: n_words, n_removed, kept_text (kept words joined by one blank)."""
    docs = texts_of(docs)
    copies, later = removed(docs)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, texts in unpacked(batch, 1):
                cols: list[list] = [[], [], [], []]
                for text, copy, starts in zip(texts, part.column(2).to_pylist(), part.column(3), strict=True):
                    words = text.split()
                    n = len(words)
                    if copy and n >= WINDOW:
                        words = []
                    elif starts.is_valid:
                        cover = np.zeros(n + 1, np.int32)
                        s = starts.values.to_numpy(zero_copy_only=False)
                        cover[s] += 1
                        cover[s + WINDOW] -= 1
                        words = [words[i] for i in np.flatnonzero(np.cumsum(cover)[:n] == 0).tolist()]
                    for c, v in zip(cols, (text.decode(), n, n - len(words), b" ".join(words).decode()), strict=True):
                        c.append(v)
                made = [pa.array(c, t) for c, t in zip(cols, (pa.string(), pa.int64(), pa.int64(), pa.string()), strict=True)]
                yield pa.RecordBatch.from_arrays([part.column(0), *made], ["doc_id", "text", "n_words", "n_removed", "kept_text"])

    joined = squeezed(docs).join(later, "rid", "left").join(copies.withColumn("copy", F.lit(True)), "rid", "left")
    rows = joined.select("doc_id", "packed", F.coalesce("copy", F.lit(False)).alias("copy"), "starts")
    return rows.mapInArrow(run, "doc_id long, text string, n_words long, n_removed long, kept_text string")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    done = deduplicated(documents(spark, sf_dir))
    return done.select("doc_id", "n_words", "n_removed", F.sha2(F.encode("kept_text", "UTF-8"), 256).alias("kept_sha256"))
