"""The text operators beside brute-force versions, on small tables and on the odd cases all of them must stand."""

import collections
import functools
import hashlib
import math
import random
import re
import time
import zlib

import duckdb
import numpy as np
import public_tokenizers
import pytest
from compare import DATA, connect, difference

from barloom.llm import (
    decision_list, jaccard_join, kd_shards, kneser_ney, packing, pieces, recompression, site_lines, skip_chain, winnowing,
)
from barloom.llm.catalog import ORACLES, QUERIES

SF = f"{DATA}/sf0.001"
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, row int, rid string, line string, bucket int"
PIECES = public_tokenizers.path("piece_bpe_32k.model")
WORDS = public_tokenizers.path("word_bpe_49k.json")


def odd_rows():
    """Nulls in every column, empty, blank and very long texts, ties, repeated rows and ids."""
    rng = random.Random(1)
    long = " ".join(rng.choice("lorem ipsum dolor sit amet".split()) + str(rng.randrange(3000)) for _ in range(12_000))
    texts = [None, "", " \n\t ", "a", "a", "x y z", "same words " * 40, "same words " * 40, long, long + " end", "é😀\0 ﬁ ½ " * 30, "|" * 500, "La " * 700]
    rows = [(k, t, "en", f"s{k % 3}", len(t or ""), k, "r", "l", 1) for k, t in enumerate(texts)]
    return [*rows, rows[6], rows[8], (None, "no id " * 30, None, None, None, None, None, None, None), (3, "another text of id three", None, "s1", None, 0, "", "", 0), (None,) * 9]


@pytest.fixture(scope="module")
def odd(spark):
    return spark.createDataFrame(odd_rows(), SCHEMA)


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="module")
def small():
    return duckdb.sql(f"SELECT doc_id, text FROM '{SF}/documents.parquet' ORDER BY doc_id").fetchall()


def result(spark, name):
    return QUERIES[name](spark, SF).toPandas().set_index("doc_id").sort_index()


def sha(text):
    return hashlib.sha256(text.encode() if isinstance(text, str) else text).hexdigest()


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_sql(spark, name):
    assert difference(QUERIES[name](spark, SF).toPandas(), connect(SF).execute(ORACLES[name]).df()) is None


# 1


PATTERNS = ("[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\\.[A-Za-z0-9-]+)+", "[0-9]+(\\.[0-9]+)(\\.[0-9]+)(\\.[0-9]+)", "[0-9]([ -]?[0-9])+", "\\+[0-9][ ().0-9-]+[0-9]")


def plain_spans(text):
    out = []
    for k, p in enumerate(PATTERNS):
        for m in re.finditer(p, text):
            digits = re.sub("[^0-9]", "", m.group())
            total = sum(sum(divmod(2 * int(d), 10)) if i % 2 else int(d) for i, d in enumerate(reversed(digits)))
            if (
                k == 1 and any(int(x) > 255 for x in m.group().split("."))
                or k == 2 and not (13 <= len(digits) <= 19 and total % 10 == 0)
                or k == 3 and not 9 <= len(digits) <= 15
            ):
                continue
            out.append((k, *m.span()))
    return out


def test_base_spans():
    rng = random.Random(5)
    for _ in range(30_000):
        text = "".join(rng.choice("a@@..1122+-() 3.b4242") for _ in range(rng.randint(0, 40)))
        assert skip_chain.base_spans(text) == plain_spans(text), text
    assert skip_chain.base_spans("1" * 200_000) == [] and skip_chain.base_spans("a" * 200_000 + "@") == []


def test_personal_data(spark, small):
    got = result(spark, "op1_skip_chain")
    for doc_id, text in small:
        base = plain_spans(text or "")
        assert got.base_sha256[doc_id] == sha(skip_chain.written(base))
        assert set(skip_chain.written(base).split(",")) - {""} <= set(got.spans[doc_id].split(","))
        assert [got[f"n_{k}"][doc_id] for k in skip_chain.KINDS] == [sum(s[0] == k for s in base) for k in range(4)]


@pytest.fixture(scope="module")
def personal_field(spark):
    return skip_chain.fitted(spark.read.parquet(f"{DATA}/sf0.01/documents.parquet"))


def added_words(field, text: str) -> list[tuple[str, str]]:
    return [(skip_chain.KINDS[k], text[a:b]) for k, a, b in skip_chain.added([text], [skip_chain.base_spans(text)], field)[0]]


@pytest.mark.parametrize("kind, evidence, restated", [
    ("phone", "+1 829-555-7292", "829-555-7292"), ("phone", "+1 829-555-7292", "829 555-7292"), ("phone", "+18295557292", "8295557292"),
    ("phone", "+1 (829) 555-7292", "829 555-7292"), ("phone", "+44 20 7946 0958", "020 7946 0958"), ("card", "4111 1111 1111 1111", "1111-1111"),
])
def test_restatements_are_found_by_evidence_alone(personal_field, kind, evidence, restated):
    far = "and " * 500
    assert added_words(personal_field, f"call {evidence} now {far} or {restated} in 2021") == [(kind, restated)]
    assert added_words(personal_field, f"call {restated} now {far} or {evidence} in 2021") == [(kind, restated)]
    assert added_words(personal_field, f"call us now {far} or {restated} in 2021") == []
    assert added_words(personal_field, f"call +7 12 3456 78901 now {far} or {restated} in 2021") == []


def test_links_join_repeats_to_the_nearest_evidence(personal_field):
    text = "1234567 " + "x +1 829-555-7292 y 829-555-7292 z 829-555-7292 x +1 829-555-7292 " + "w 829-555-7292 " + "a 2021 b 2021 1234567"
    w = skip_chain.read([text], [skip_chain.base_spans(text)])
    words = [text[a:b] for a, b in zip(w.begin, w.end, strict=True)]
    assert words == ["1234567", "+1", "829-555-7292", "829-555-7292", "829-555-7292", "+1", "829-555-7292", "829-555-7292", "2021", "2021", "1234567"]
    assert set(map(tuple, w.skip.tolist())) == {(1, 5), (2, 3), (2, 4), (2, 6), (6, 7), (8, 9), (0, 10)}


def test_many_repeats_take_linear_time(personal_field):
    text = "call +1 829-555-7292 " + "and 829-555-7292 " * 20_000
    begin = time.monotonic()
    assert added_words(personal_field, text) == [("phone", "829-555-7292")] * 20_000
    assert time.monotonic() - begin < 30


def test_spans_replaced():
    assert skip_chain.replaced("a 1.2.3.4 b", [(1, 2, 9)]) == "a <IP> b"


def test_found_replaces_columns_of_its_names(spark, personal_field):
    rows = spark.createDataFrame([(1, "to a@b.cd", 5, 6), (2, None, None, None)], "doc_id long, text string, base int, more int")
    got = {r.doc_id: ([tuple(s) for s in r.base], r.more) for r in skip_chain.found(rows, personal_field).collect()}
    assert got == {1: ([(0, 3, 9)], []), 2: ([], [])}


def test_messages_agree_with_enumeration():
    """On a tree message passing is exact: compare with all labellings."""
    rng = np.random.default_rng(3)
    n, labels = 4, skip_chain.LABELS
    field = skip_chain.Field(rng.normal(size=(skip_chain.BITS + 1, labels)), (lambda x: x + x.transpose(0, 2, 1))(rng.normal(size=(2, labels, labels))))
    words = skip_chain.Words(np.zeros(n, int), np.arange(n), np.arange(n), rng.integers(0, 1 << 16, n), np.full(n, skip_chain.OTHER), np.array([[0, 1], [1, 2]]), np.array([[0, 3]]))
    unary, p = field.unary(words.code), np.zeros((n, labels))
    for y in np.ndindex(*[labels] * n):
        weight = math.exp(sum(unary[i, y[i]] for i in range(n)) + field.links[0][y[0], y[1]] + field.links[0][y[1], y[2]] + field.links[1][y[0], y[3]])
        for i in range(n):
            p[i, y[i]] += weight
    assert np.allclose(field.posteriors(words), p / p.sum(1, keepdims=True), atol=2e-3)


def test_evidence_reaches_far_repeats():
    """Neutral words in one line of links behind one base span, beside a document that is done at once."""
    n, labels, phone = 50, skip_chain.LABELS, 3
    field = skip_chain.Field(np.zeros((skip_chain.BITS + 1, labels)), np.stack([6 * np.eye(labels)] * 2))
    label = np.full(n + 2, skip_chain.OTHER)
    label[0] = phone
    links = np.array([[i, i + 1] for i in range(n - 1)] + [[n, n + 1]])
    doc = np.repeat([0, 1], [n, 2])
    words = skip_chain.Words(doc, np.arange(n + 2), np.arange(n + 2), np.zeros(n + 2, int), label, np.zeros((0, 2), int), links)
    fading = (math.exp(6) - 1) / (math.exp(6) + labels - 1)
    want = 1 / labels + (1 - 1 / labels) * fading ** np.arange(n)
    got = field.posteriors(words)
    assert np.allclose(got[:n, phone], want, atol=0.01) and (got[:n, phone] > skip_chain.SURE).all()
    assert np.allclose(got[n:], 1 / labels)


# 2


def test_encoding_is_that_of_the_library(spark, small):
    import sentencepiece

    library, own = sentencepiece.SentencePieceProcessor(model_file=PIECES), pieces.model(PIECES)
    rng = random.Random(2)
    alphabet = " \n\t▁abcABC éß½中文字😀\0aaa aaabbb<s></s><0x41>'.,0123   ing tion er"
    texts = [t or "" for _, t in small] + ["".join(rng.choice(alphabet) for _ in range(rng.randint(0, 60))) for _ in range(2000)] + [r[1] or "" for r in odd_rows()]
    for text, words in zip(texts, own.encode(texts), strict=True):
        ids = library.encode(text, num_threads=1)
        assert [int(x) for _, s, _ in words for x in s.split(",")] == ids and own.decode(ids) == library.decode(ids)
    got = result(spark, "op2_pieces")
    for doc_id, text in small:
        ids = library.encode(text or "")
        assert tuple(got.loc[doc_id]) == (len(ids), sha(",".join(map(str, ids))), sha(library.decode(ids)))


# 3


def test_packing(spark, small):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(WORDS)
    got = QUERIES["op3_packing"](spark, SF).toPandas()
    by = got.set_index(["doc_id", "piece"]).sort_index()
    for doc_id, text in small:
        ids = np.array([*tokenizer.encode(text or "", add_special_tokens=False).ids, 0], "<u4")
        for k in range(-(-len(ids) // 2048)):
            own = ids[2048 * k : 2048 * (k + 1)]
            r = by.loc[(doc_id, k)]
            assert (r.start, r.length, r.ids_crc32) == (2048 * k, len(own), zlib.crc32(own.tobytes()))
    gapless(got)
    assert got.sequence_id.nunique() <= 1.02 * -(-got.length.sum() // 2048) + 1


def gapless(got):
    ordered = got.sort_values(["sequence_id", "offset"])
    ends = ordered.groupby("sequence_id").length.cumsum()
    assert (ends - ordered.length == ordered.offset).all() and ends.max() <= 2048


def test_plan_holds_every_piece():
    rng = random.Random(4)
    for _ in range(200):
        histogram = {rng.randint(1, 100): rng.randint(1, 50) for _ in range(rng.randint(1, 40))}
        used = collections.Counter()
        for s in packing.plan(histogram, 100):
            end = 0
            for length, each, offset in s.runs:
                assert offset == end
                end += length * each
                used[length] += each * s.count
            assert end == 100 - s.free <= 100 and sum(e for n, e, _ in s.runs if 3 * n > 100) <= 2
        assert used == histogram


# 4


def test_single_pieces_find_partners():
    for each, most in ((1, 151), (101, 15_201)):
        assert sum(s.count for s in packing.plan(dict.fromkeys(range(700, 1001), each))) <= most


@pytest.mark.parametrize("seed", range(5))
def test_large_pieces_fill_as_few_sequences_as_can_be(seed):
    # two large pieces at most fit, so the least number of sequences is pieces less the largest matching
    rng = random.Random(seed)
    lengths = [rng.randrange(683, 1500) for _ in range(12)]

    @functools.cache
    def matched(left):
        if not left:
            return 0
        rest = left[1:]
        pairs = [matched(rest[:k] + rest[k + 1 :]) + 1 for k, n in enumerate(rest) if n + left[0] <= 2048]
        return max([matched(rest), *pairs])

    got = sum(s.count for s in packing.plan(dict(collections.Counter(lengths))))
    assert got == len(lengths) - matched(tuple(sorted(lengths)))


def test_quality_counts(spark, small):
    got = result(spark, "op4_decision_list")
    for doc_id, text in small:
        words = re.findall("[^ \t-\r]+", text or "")
        at = collections.defaultdict(list)
        for i in range(len(words) - 2):
            at[tuple(words[i : i + 3])].append(i)
        repeated = len({j for p in at.values() if len(p) > 1 for i in p for j in (i, i + 1, i + 2)})
        lines = [x for x in (text or "").split("\n") if re.search("[^ \t-\r]", x)]
        want = [len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text or ""), len(lines) - len(set(lines)), repeated]
        failed = len(words) < 50 or 100 * repeated > 50 * len(words)
        assert list(got.loc[doc_id])[:6] == [*want, failed] and not (failed and got.kept[doc_id])


def test_rules_are_learned(spark):
    """Documents are bad if they are full of symbols, or short of distinct words: two rules find them."""
    rng = random.Random(6)
    rows, labels = [], []
    for k in range(900):
        words = [f"w{rng.randrange(400)}" for _ in range(100)]
        kind = k % 9
        if kind == 0:
            words = [w + "###" for w in words]
        if kind == 1:
            words = [f"w{i % 45 + rng.randrange(2)}" for i in range(100)]
        rows.append((k, " ".join(words)))
        labels.append((k, int(kind > 1)))
    docs, said = spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(labels, "doc_id long, quality int")
    rules = decision_list.learned(decision_list.counted(docs).select("row.doc_id", "s"), said)
    assert rules and all(1 <= len(r) <= 4 for r in rules)
    kept = {r.doc_id for r in decision_list.accepted(docs, said).collect()}
    assert not kept & {k for k in range(900) if k % 9 < 2} and len(kept) == 700
    nothing = spark.createDataFrame([], "doc_id long, quality int")
    assert decision_list.learned(decision_list.counted(docs).select("row.doc_id", "s"), nothing) == []


# 5


def plain_winnowing(text, gram=winnowing.GRAM, window=winnowing.WINDOW):
    codes = [ord(c) + 1 for c in text]
    if not codes:
        return []
    gram = min(gram, len(codes))
    hashes = []
    for i in range(len(codes) - gram + 1):
        value = 0
        for c in codes[i : i + gram]:
            value = (value * int(winnowing.BASE) + c) % (1 << 64)
        hashes.append(int(winnowing.mixed(np.array([value], np.uint64))[0]))
    window, out = min(window, len(hashes)), []
    for i in range(len(hashes) - window + 1):
        least = min(hashes[i : i + window])
        at = max(j for j in range(i, i + window) if hashes[j] == least)
        if not out or out[-1][0] != at:
            out.append((at, least))
    return out


def test_winnowing(spark, small):
    rng = random.Random(2)
    for n in (0, 1, 5, 23, 24, 25, 46, 47, 48, 60, 200):
        for alphabet in ("a", "ab", "abcdefé😀"):
            text = "".join(rng.choice(alphabet) for _ in range(n))
            at, h = winnowing.winnowed(text)
            assert list(zip(at.tolist(), h.tolist(), strict=True)) == plain_winnowing(text)
    got = result(spark, "op5_winnowing")
    texts = [t or "" for _, t in small]
    for k, (doc_id, _) in enumerate(small):
        text, after, r = texts[k], texts[(k + 1) % len(texts)], got.loc[doc_id]
        edited = text[: len(text) - len(text) // 2] + after[: len(text) // 2]
        prints = [winnowing.winnowed(x) for x in (text, edited, after)]
        assert (r.n_chars, r.edited_sha256, r.fingerprint, r.edited_fingerprint) == (len(text), sha(edited), winnowing.written(*prints[0]), winnowing.written(*prints[1]))
        assert (r.near_edited, r.near_next) == (winnowing.alike(prints[0][1], prints[1][1]), winnowing.alike(prints[0][1], prints[2][1]))


# 6


def plain_removal(rows, window=20):
    """Kept words of rows in order of doc_id."""
    seen, out = set(), []
    for text in rows:
        words = (text or "").encode().split()
        cover = [False] * len(words)
        for s in range(len(words) - window + 1):
            if (k := tuple(words[s : s + window])) in seen:
                cover[s : s + window] = [True] * window
            seen.add(k)
        out.append((len(words), b" ".join(w for w, c in zip(words, cover, strict=True) if not c)))
    return out


def test_repeated_windows(spark, small):
    got = result(spark, "op6_recompression")
    for (doc_id, _), (n, kept) in zip(small, plain_removal([t for _, t in small]), strict=True):
        assert tuple(got.loc[doc_id]) == (n, n - len(kept.split()), sha(kept))


def test_repeated_windows_of_few_words(spark, monkeypatch):
    """Runs, periods and frequent symbols: nearly every window repeats."""
    rng = random.Random(9)
    texts = [" ".join(rng.choice("a b".split() if k % 2 else "a b c d e f g".split()) for _ in range(rng.randint(0, 120))) for k in range(60)]
    texts += [" ".join(t.split()[10:60]) for t in texts[:20]] + ["x " * 90, "x y " * 40, "x " * 25]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    for most in (recompression.FREQUENT, 2):
        monkeypatch.setattr(recompression, "FREQUENT", most)
        got = {r.doc_id: r.kept_text for r in recompression.deduplicated(docs).collect()}
        assert [got[k] for k in range(len(texts))] == [kept.decode() for _, kept in plain_removal(texts)]


@pytest.mark.parametrize("parts", [1, 7])
def test_repeated_windows_of_repeated_rows(spark, monkeypatch, parts):
    """Rows given several times are one document, also where a batch holds all of them and their symbols are frequent."""
    rng = random.Random(4)
    texts = [" ".join(rng.choice("a b c d e f g".split()) for _ in range(rng.randint(0, 90))) for k in range(20)]
    texts += [" ".join(t.split()[5:60]) for t in texts[:8]] + ["x y " * 40, " ".join(f"w{k}" for k in range(50))]
    rows = [(k, t) for k, t in enumerate(texts) for _ in range(1 + k % 4)]
    rng.shuffle(rows)
    docs = spark.createDataFrame(rows, "doc_id long, text string").coalesce(1).repartition(parts)
    want = {k: kept.decode() for k, (_, kept) in enumerate(plain_removal(texts))}
    for most in (recompression.FREQUENT, 2):
        monkeypatch.setattr(recompression, "FREQUENT", most)
        got = recompression.deduplicated(docs).collect()
        assert sorted((r.doc_id, r.kept_text) for r in got) == sorted((k, want[k]) for k, _ in rows)


def test_equal_windows_share_their_symbol():
    rng = np.random.default_rng(1)
    names = rng.integers(1, 12, 4000).astype(np.uint64)
    starts, symbols, _, _ = recompression.picked(recompression.mixed(names), np.array([1000, 2500, 4000]))
    of = {}
    for s, y in zip(starts.tolist(), symbols.tolist(), strict=True):
        assert of.setdefault(tuple(names[s : s + 20].tolist()), y) == y


# 7


def test_shards(spark, small):
    got = QUERIES["op7_kd_shards"](spark, SF).toPandas()
    whole_shards(got, 24)
    by = got.set_index("doc_id")
    for doc_id, text in small:
        raw = (text or "").encode()
        assert (by["size"][doc_id], by.text_crc32[doc_id]) == (len(raw) + 8, zlib.crc32(raw))
    larger = QUERIES["op7_kd_shards"](spark, f"{DATA}/sf0.1").toPandas().groupby("shard")["size"].sum()
    assert len(larger) == 24 and larger.max() < 1.05 * larger.min()


def whole_shards(got, count):
    assert set(got.shard) <= set(range(count))
    for _, own in got.groupby("shard"):
        assert sorted(own.slot) == list(range(len(own)))


def test_groups_fill_shards_where_they_fit():
    assert kd_shards.pinned([9, 7, 4, 3, 3, 2], 3, 10.0) == ([0, 1, 2, 1, 2, 2], [9, 10, 9])
    assert kd_shards.pinned([12, 10, 6, 6], 2, 10.0) == ([None, 0, 1, None], [10, 6])
    assert kd_shards.pinned([], 2, 0.0) == ([], [0, 0])


def test_groups_of_equal_texts_stay_whole_up_to_a_shard(spark):
    rng = random.Random(3)
    shards, room = 6, 100_000
    groups = {"a": 1.5, "b": 0.9, "c": 0.7, "d": 0.5, "e": 0.3, "f": 0.1, "g": 0.05}
    texts = [name * 92 for name, part in groups.items() for _ in range(int(part * room / 100))]
    texts += ["".join(rng.choices("hijklm", k=192)) for _ in range((shards * room - 100 * len(texts)) // 200)]
    rng.shuffle(texts)
    docs = spark.createDataFrame([(k, t, rng.choice("xyz"), rng.choice("uv"), len(t)) for k, t in enumerate(texts)], "doc_id long, text string, source string, lang string, n_chars long")
    got = kd_shards.sharded(docs, shards).toPandas()
    whole_shards(got, shards)
    sizes = got.groupby("shard")["size"].sum()
    assert len(got) == len(texts) and len(sizes) == shards and sizes.max() < 1.02 * sizes.min()
    of = {name: {s for d, s in zip(got.doc_id, got.shard, strict=True) if texts[d] == name * 92} for name in groups}
    assert [name for name in groups if len(of[name]) > 1] == ["a"]


# 8


def test_lines_near_the_threshold_are_counted(spark):
    rows = [(100 * n + k, f"only here {n} {k}\nseen on {n} sites today\nseen on {n} sites today", f"s{k}") for n in range(1, 16) for k in range(n)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    got = {r.doc_id: r.text.split("\n") for r in site_lines.deduplicated(docs, sites=10).collect()}
    for n in range(1, 16):
        left = [len(got[100 * n + k]) - 1 for k in range(n)]
        assert left == ([2] * n if n < 10 else [1] + [0] * (n - 1))


def test_lines_of_one_word_are_examined(spark):
    short = ["這是一行沒有空格的文字", "https://a.example/b", "Read more", "  ", ""]
    rows = [(k, "\n".join([*short, f"own{k}"]), f"s{k}") for k in range(12)]
    got = {r.doc_id: r.text.split("\n") for r in site_lines.deduplicated(spark.createDataFrame(rows, "doc_id long, text string, source string")).collect()}
    assert got == {k: [*(short if k == 0 else short[3:]), f"own{k}"] for k in range(12)}


# 9


def plain_links(texts, similarity=0.8):
    grams = []
    for text in texts:
        words = (text or "").encode().split()
        grams.append({tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))} if words else set())
    links, root = [0] * len(texts), list(range(len(texts)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, a in enumerate(grams):
        for j in range(i):
            both = len(a & grams[j])
            if both and both >= similarity * (len(a) + len(grams[j]) - both) - 1e-9:
                links[i] += 1
                links[j] += 1
                x, y = find(i), find(j)
                root[max(x, y)] = min(x, y)
    return links, [find(k) for k in range(len(texts))]


def test_links(spark, small):
    got = result(spark, "op9_jaccard_join")
    links, least = plain_links([t for _, t in small])
    ids = [i for i, _ in small]
    assert got.n_links.tolist() == links and got.class_id.tolist() == [ids[k] for k in least]


def test_links_of_a_large_group_across_blocks(spark, monkeypatch):
    monkeypatch.setattr(jaccard_join, "BLOCK", 16)
    rng = random.Random(8)
    base = [f"w{k}" for k in range(120)]
    texts = []
    for k in range(90):
        words = list(base)
        for _ in range(k % 4):
            words[rng.randrange(120)] = f"x{k}"
        texts.append(" ".join(words))
    texts += [texts[5]] * 7 + [" ".join(f"z{k}{i}" for i in range(50)) for k in range(10)]
    got = jaccard_join.joined(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).toPandas().sort_values("doc_id")
    links, least = plain_links(texts)
    assert got.n_links.tolist() == links and got.class_id.tolist() == least


def test_banding_reaches_its_recall():
    bands, rows = jaccard_join.banding(0.8, 0.99999, 100)
    assert bands * rows <= 100 and 1 - (1 - 0.8**rows) ** bands >= 0.99999


# 10


def test_model(spark, small):
    got = result(spark, "op10_kneser_ney")
    tokens = {i: [*(t or "").encode().lower().split(), b" "] for i, t in small}
    out = {i: zlib.crc32(str(i).encode()) % 10 == 0 for i in tokens}
    count = collections.Counter(w for i, ws in tokens.items() if not out[i] for w in ws)
    pair = collections.Counter(p for i, ws in tokens.items() if not out[i] for p in zip([None, *ws[:-1]], ws, strict=True))
    total, before = sum(count.values()), collections.Counter(v for _, v in pair)
    context, kinds = collections.Counter(), collections.defaultdict(lambda: [0, 0, 0, 0])
    for (u, _), n in pair.items():
        context[u] += n
        kinds[u][min(n, 3)] += 1
    d2, d1 = (kneser_ney.discounts([sum(n == k for n in c.values()) for k in (1, 2, 3, 4)]) for c in (pair, before))
    rest = sum(d1[min(n, 3)] for n in before.values()) / len(pair)

    def low(v):
        return (before[v] - d1[min(before[v], 3)]) / len(pair) + rest / (len(count) + 1)

    def p(u, v):
        if not context[u]:
            return low(v)
        n = pair[u, v]
        return (n - d2[min(n, 3)] + sum(d2[k] * kinds[u][k] for k in (1, 2, 3)) * low(v)) / context[u]

    assert abs(sum(p(b"the", v) for v in count) + p(b"the", b"unseen") - 1) < 1e-9
    for i, ws in tokens.items():
        r = got.loc[i]
        assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == (out[i], len(ws), sum(count[w] > 0 for w in ws), total)
        assert np.isclose(r.score, sum(math.log10(p(u, v)) for u, v in zip([None, *ws[:-1]], ws, strict=True)), rtol=1e-9)
        assert np.isclose(r.base_score, sum(math.log10((count[w] + 0.1) / (total + 0.1 * (len(count) + 1))) for w in ws), rtol=1e-9)
    held = got[got.held_out]
    assert held.score.sum() > held.base_score.sum()


def test_frequent_contexts_are_dealt_by_pair(spark, small, monkeypatch):
    docs = spark.createDataFrame(small, "doc_id long, text string").selectExpr("doc_id", "doc_id % 10 = 0 AS held_out", "text")
    whole = kneser_ney.scored(docs, kneser_ney.train(docs.filter("not held_out"))).toPandas()
    monkeypatch.setattr(kneser_ney, "SHARD_KEYS", 2000)
    model = kneser_ney.train(docs.filter("not held_out"))
    assert model.shards > 10 and len(model.often) > 1
    cut = kneser_ney.scored(docs, model).toPandas()
    assert np.allclose(whole.sort_values("doc_id").score, cut.sort_values("doc_id").score)


# all


def label_table(spark):
    return spark.createDataFrame([(1, 1), (6, 0), (None, 0), (8, None), (8, 1)], "doc_id long, quality int")


def each_operator(spark, docs):
    """Every operator's general interface over a table."""
    field = skip_chain.fitted(docs)
    held = docs.selectExpr("doc_id", "false AS held_out", "text")
    return {
        "1": skip_chain.masked(docs, field), "1 spans": skip_chain.found(docs.select("doc_id", "text"), field),
        "2": pieces.encoded(docs, PIECES), "3": packing.pack_documents(docs, WORDS), "4": decision_list.accepted(docs, label_table(spark)),
        "5": winnowing.compared(docs), "5 prints": winnowing.fingerprints(docs), "6": recompression.deduplicated(docs), "7": kd_shards.sharded(docs),
        "8": site_lines.deduplicated(docs, sites=2), "9": jaccard_join.joined(docs), "9 kept": jaccard_join.one_of_each(docs),
        "10": kneser_ney.scored(held, kneser_ney.train(held)),
    }


def test_odd_rows(spark, odd):
    rows = odd_rows()
    got = {k: df.toPandas() for k, df in each_operator(spark, odd).items()}
    n = len(rows)
    for k in ("1", "1 spans", "2", "5", "5 prints", "6", "7", "8", "9", "10"):
        assert len(got[k]) == n, k
    for k in ("1", "4", "8", "9 kept"):
        assert list(got[k].columns) == odd.columns, k
    assert got["1"].text.isna().sum() == got["8"].text.isna().sum() == 2  # nulls stay null
    assert sorted(map(len, got["2"].token_ids)) == sorted(len(pieces.model(PIECES).encode_ids(r[1] or "")) if r[1] else 0 for r in rows)
    gapless(got["3"])
    assert got["3"].length.sum() == sum(len(packing.word_ids(WORDS).ids([r[1] or ""])[0]) // 4 for r in rows)
    assert set(got["4"].doc_id.dropna()) <= {6, 7, 8, 9, 10}
    six = got["6"][got["6"].doc_id == 7]
    assert six.n_removed.tolist() == [80] and (got["6"][got["6"].doc_id == 6].n_removed == 78).all()
    whole_shards(got["7"], 24)
    nine = got["9"]
    assert (nine[nine.doc_id == 7].class_id == 6).all() and (nine[nine.doc_id == 6].n_links == 2).all()  # one repeated row, one copy
    assert (nine[nine.doc_id.isin([1, 2])].n_links == 0).all()
    kept = got["9 kept"]
    assert len(kept[kept.doc_id == 6]) == 1 and not len(kept[kept.doc_id.isin([7, 9])])
    assert np.isfinite(got["10"].score).all()
    assert got["5"][got["5"].doc_id == 3].near_edited.between(0, 1).all()


def test_empty_table(spark, none):
    for k, df in each_operator(spark, none).items():
        assert df.count() == 0, k
