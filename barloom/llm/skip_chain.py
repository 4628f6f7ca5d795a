"""Operator 1: personal data by patterns and a skip-chain conditional random field.

Patterns find e-mail addresses, IP addresses, card and phone numbers (the base spans, which always stay). The field then labels
every word that has a digit or an @ sign. Neighbouring words are linked in a chain. Skip links join words of one document, however
far apart, that are equal (without outer punctuation and case), or after which the last seven digits, counted over neighbouring
words, are the same: a repeat is linked to the nearest base span of its key, repeats without one to each other in turn. Loopy
message passing over both kinds of links makes labels consistent in each document, so a number seen once with its country code is
found where it stands without, and is not found where nothing in its document says what it is. Words of base spans are evidence.
A word that the field gives a kind with a probability of at least ``SURE`` becomes a span, if it touches no base span. Equal
words of under seven digits and without an @ sign say too little to be linked to a base span.

Weights are trained by pseudo-likelihood on the base labels of all documents: Spark counts how often each combination of a word's
features and its neighbours' labels occurs with each label. Unlabelled words that are linked to a base span are left out, as theirs is
the question. To answer it, each base word with seven digits is also shown in a form that the patterns miss, without its own
span: with a link to a base word it has its kind, and without one it is an ordinary word. Features are a fixed set of
yes-or-no questions, so the table of counts, and what the driver fits, is bounded however many documents there are.

Null texts count as empty and have no spans. Texts are read whole, in linear time. Equal rows get equal results. An empty table
gives no rows; without any word to learn from, the weights are 0 and nothing is added. Labels of equal probability: the first kind.
Of two base spans as near, the earlier one is linked. ``masked`` keeps all columns; ``found`` calls its own ``base`` and ``more``,
and drops columns of these names.
"""

from __future__ import annotations

import hashlib
import re
from bisect import bisect
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from barloom.llm.common import documents, slices

KINDS = ("email", "ip", "card", "phone")
OTHER = len(KINDS)
LABELS = OTHER + 1
SURE = 0.5
DAMPING = 0.5
#: Changes under which messages are done.
STILL = 1e-4

DOMAIN = re.compile(r"[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
IP = re.compile(r"(?<![0-9])[0-9]++(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([ -]?[0-9])+")
PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
HINT = re.compile("[0-9@]")
BLANK = re.compile("[ \t-\r]")
Span = tuple[int, int, int]


def luhn(digits: str) -> bool:
    odd = sum(map(int, digits[::-2]))
    return (odd + sum(sum(divmod(2 * int(d), 10)) for d in digits[-2::-2])) % 10 == 0


def digits_of(text: str) -> str:
    return "".join([c for c in text if "0" <= c <= "9"])


def emails(text: str) -> Iterator[tuple[int, int]]:
    """Leftmost matches, each found from its @ sign: the part before it is as long as it can be."""
    end, at = 0, text.find("@")
    while at >= 0:
        begin = at
        while begin > end and text[begin - 1] in LOCAL:
            begin -= 1
        m = DOMAIN.match(text, at + 1) if begin < at else None
        if m:
            end = m.end()
            yield begin, end
        at = text.find("@", max(end, at + 1))


def base_spans(text: str) -> list[Span]:
    """(kind, begin, end) by kind and begin."""
    out = [(0, a, b) for a, b in emails(text)] if "@" in text else []
    if HINT.search(text):
        out += [(1, *m.span()) for m in IP.finditer(text) if all(len(x.lstrip("0")) < 4 and int(x.lstrip("0") or 0) < 256 for x in m.group().split("."))]
        for m in CARD.finditer(text):
            if m.end() - m.start() >= 13 and 13 <= len(d := digits_of(m.group())) <= 19 and luhn(d):
                out.append((2, *m.span()))
        if "+" in text:
            out += [(3, *m.span()) for m in PHONE.finditer(text) if 9 <= len(digits_of(m.group())) <= 15]
    return out


def written(spans: list[Span]) -> str:
    return ",".join([f"{KINDS[k]}:{a}:{b}" for k, a, b in sorted(spans)])


def tokens(text: str) -> list[tuple[int, int]]:
    """Words with a digit or an @ sign."""
    out, end = [], 0
    while m := HINT.search(text, end):
        begin = max(text.rfind(c, end, m.start()) for c in " \t\n\x0b\f\r") + 1 or end
        stop = BLANK.search(text, m.end())
        end = stop.start() if stop else len(text)
        out.append((begin, end))
    return out


def features(word: str) -> int:
    """Answers to the fixed questions, one bit each."""
    digits = digits_of(word)
    n = len(digits)
    letters = sum(map(str.isalpha, word))
    bare = word.strip(".,;:!?\"'")
    asked = (
        1 <= n <= 2, 3 <= n <= 4, 5 <= n <= 8, 9 <= n <= 12, 13 <= n <= 19, n >= 20,
        "@" in word, bare.count(".") == 3, "." in bare, "-" in bare, "(" in word or ")" in word, word.startswith("+"),
        letters > 0, letters > n, "=" in word or '"' in word, 13 <= n <= 19 and luhn(digits),
    )
    return sum(1 << i for i, yes in enumerate(asked) if yes)


BITS = 16


@dataclass
class Words:
    """The words of many documents, their links and labels by the base spans; for training the span and the features of a form that patterns miss (or -1)."""

    doc: np.ndarray
    begin: np.ndarray
    end: np.ndarray
    code: np.ndarray
    label: np.ndarray
    chain: np.ndarray
    skip: np.ndarray
    span: np.ndarray | None = None
    hidden: np.ndarray | None = None


def hidden_form(word: str) -> int:
    """Features of a base word as it may be restated: without its plus sign, or the end of it that no pattern matches; -1 if that has too few digits."""
    form = word.lstrip("+")
    while base_spans(form):
        form = form[len(form) // 2 :]
    return features(form) if digits_of(form) and (form != word or not base_spans(word)) else -1


def skip_links(keys: dict[str, list[int]], label: list[int]) -> set[tuple[int, int]]:
    """Links of the words of one document by their keys; those that begin with w are too weak to say what a word is."""
    out: set[tuple[int, int]] = set()
    for key, at in keys.items():
        known = [i for i in at if label[i] != OTHER]
        unknown = [i for i in at if label[i] == OTHER]
        if known and unknown and key[0] != "w":
            for i in unknown:
                k = bisect(known, i)
                out.add(tuple(sorted((i, min(known[max(k - 1, 0) : k + 1], key=lambda j: (abs(i - j), j))))))
        else:
            out.update(zip(unknown, unknown[1:]))
        out.update(zip(known, known[1:]))
    return out


def read(texts: list[str], base: list[list[Span]], train: bool = False) -> Words:
    rows: list[tuple[int, ...]] = []
    chain: list[tuple[int, int]] = []
    skip: list[tuple[int, int]] = []
    label: list[int] = []
    for d, text in enumerate(texts):
        keys: dict[str, list[int]] = {}
        spans = sorted((a, b, k) for k, a, b in base[d])
        k, tail = 0, ""
        for begin, end in tokens(text):
            while k < len(spans) and spans[k][1] <= begin:
                k += 1
            own = next((x for x in range(k, min(k + 4, len(spans))) if spans[x][0] < end and spans[x][1] > begin), -1)
            word, i = text[begin:end], len(rows)
            if rows and rows[-1][0] == d and (end_ := rows[-1][2]) <= begin and not text[end_:begin].strip(" \t\n\x0b\f\r"):
                chain.append((i - 1, i))
            else:
                tail = ""
            digits = digits_of(word)
            tail = (tail + digits)[-7:]
            full = len(tail) == 7 and digits != ""
            if len(digits) < 7:
                keys.setdefault(("e" if "@" in word else "w") + word.strip(".,;:!?\"'()[]<>").lower(), []).append(i)
            if full:
                keys.setdefault("d" + tail, []).append(i)
            label.append(spans[own][2] if own >= 0 else OTHER)
            rows.append((d, begin, end, features(word), label[i], own, hidden_form(word) if train and full and own >= 0 else -1))
        skip.extend(sorted(skip_links(keys, label)))
    table = np.array(rows, np.int64).reshape(-1, 7)
    return Words(*table.T[:5], *(np.array(x, np.int64).reshape(-1, 2) for x in (chain, skip)), *table.T[5:])


def neighbour_counts(w: Words, links: list[np.ndarray], seen: np.ndarray) -> np.ndarray:
    """For every word how many neighbours that are seen (3 at most) have each label, by each of two kinds of links."""
    out = np.zeros((len(w.doc), 2, LABELS), np.int64)
    for k, own in enumerate(links):
        for a, b in (own.T, own.T[::-1]):
            on = seen[b]
            np.add.at(out, (a[on], k, w.label[b[on]]), 1)
    return np.minimum(out, 3)


def examples(w: Words) -> np.ndarray:
    """Rows of code, near (neighbours' labels, two bits a count) and label to train on."""
    a, b = w.skip.T
    asked = np.zeros(len(w.doc), bool)
    asked[a[(w.label[a] == OTHER) & (w.label[b] != OTHER)]] = True
    asked[b[(w.label[b] == OTHER) & (w.label[a] != OTHER)]] = True
    packed = lambda near: (near.reshape(-1, 2 * LABELS) << 2 * np.arange(2 * LABELS)).sum(1)
    plain = np.stack([w.code, packed(neighbour_counts(w, [w.chain, w.skip], ~asked)), w.label], 1)[~asked]
    x, y = w.chain.T
    outside = w.chain[(w.span[x] < 0) | (w.span[x] != w.span[y])]
    shown = np.flatnonzero(w.hidden >= 0)
    near = neighbour_counts(w, [outside, w.skip[:0]], ~asked)[shown]
    without = np.stack([w.hidden[shown], packed(near), np.full(len(shown), OTHER)], 1)
    near[np.arange(len(shown)), 1, w.label[shown]] = 1
    linked = np.stack([w.hidden[shown], packed(near), w.label[shown]], 1)
    return np.concatenate([plain, without, linked])


def observations(docs: DataFrame) -> DataFrame:
    """code, near, label, n: how often each example occurs."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, texts in slices(batch, "text"):
                texts = [t or "" for t in texts]
                rows, n = np.unique(examples(read(texts, [base_spans(t) for t in texts], True)), axis=0, return_counts=True)
                yield pa.RecordBatch.from_arrays([*(pa.array(c) for c in rows.reshape(-1, 3).T), pa.array(n)], ["code", "near", "label", "n"])

    return docs.select("text").mapInArrow(run, "code long, near long, label long, n long").groupBy("code", "near", "label").agg(F.sum("n").alias("n"))


@dataclass
class Field:
    """Weights of features (bits and a constant) and of linked labels, chain and skip."""

    own: np.ndarray
    links: np.ndarray

    def unary(self, code: np.ndarray) -> np.ndarray:
        return bits(code) @ self.own

    def posteriors(self, w: Words) -> np.ndarray:
        """Label probabilities by loopy message passing over chain and skip links. Words of base spans are evidence."""
        unary = self.unary(w.code)
        known = w.label != OTHER
        unary[known] = -30.0
        unary[known, w.label[known]] = 0.0
        edges = np.concatenate([w.chain, w.skip])
        kind = np.repeat([0, 1], [len(w.chain), len(w.skip)])
        source, target = np.concatenate([edges, edges[:, ::-1]]).T if len(edges) else (np.zeros(0, np.int64),) * 2
        weight = self.links[np.concatenate([kind, kind])]
        back = np.roll(np.arange(len(source)), len(edges))
        weight, doc = np.exp(weight), w.doc[source]
        message = np.zeros((len(source), LABELS))
        belief = unary.copy()
        order = np.argsort(source, kind="stable")
        first = np.searchsorted(source[order], np.arange(len(w.doc) + 1))
        # a document whose loops never settle ends at many more rounds than it has words
        most = 100 + 4 * np.bincount(w.doc)
        on, rounds = np.arange(len(source)), 0
        while len(on):
            out = normal(belief[source[on]] - message[back[on]])
            new = normal(np.log(np.einsum("el,elk->ek", np.exp(out), weight[on]) + 1e-300))
            step = new - message[on]
            moved = np.abs(step).max(1) >= STILL
            message[on] += (1 - DAMPING) * step
            np.add.at(belief, target[on], (1 - DAMPING) * step)
            rounds += 1
            # a message is still once it and all that go into it are
            on = on[moved]
            heard = np.unique(target[on])
            n = first[heard + 1] - first[heard]
            after = order[np.repeat(first[heard] - np.cumsum(n) + n, n) + np.arange(n.sum())]
            on = np.union1d(on, after)
            on = on[rounds < most[doc[on]]]
        return np.exp(normal(belief))


def normal(logs: np.ndarray) -> np.ndarray:
    """Log probabilities of rows."""
    top = logs.max(1, keepdims=True) if len(logs) else np.zeros((0, 1))
    return logs - top - np.log(np.exp(logs - top).sum(1, keepdims=True))


def bits(code: np.ndarray) -> np.ndarray:
    return np.concatenate([(code[:, None] >> np.arange(BITS)) & 1, np.ones((len(code), 1), np.int64)], 1).astype(float)


def fitted(docs: DataFrame, steps: int = 400, rate: float = 0.1, ridge: float = 1.0) -> Field:
    """Maximises the pseudo-likelihood of the base labels, from their counts."""
    rows = np.array(observations(docs).orderBy("code", "near", "label").collect(), np.int64).reshape(-1, 4)
    code, near, label, n = rows.T
    x = np.concatenate([bits(code), ((near[:, None] >> 2 * np.arange(2 * LABELS)) & 3).astype(float)], 1)
    y = np.eye(LABELS)[label]
    w = np.zeros((x.shape[1], LABELS))
    first, second = np.zeros_like(w), np.zeros_like(w)
    total = max(n.sum(), 1)
    for k in range(1, steps + 1 if len(n) else 1):
        gradient = (x.T @ (n[:, None] * (y - np.exp(normal(x @ w)))) - ridge * w) / total
        links = gradient[BITS + 1 :].reshape(2, LABELS, LABELS)
        gradient[BITS + 1 :] = ((links + links.transpose(0, 2, 1)) / 2).reshape(-1, LABELS)  # links have no direction
        first = 0.9 * first + 0.1 * gradient
        second = 0.999 * second + 0.001 * gradient**2
        w += rate * first / (1 - 0.9**k) / (np.sqrt(second / (1 - 0.999**k)) + 1e-8)
    return Field(w[: BITS + 1], w[BITS + 1 :].reshape(2, LABELS, LABELS))


def added(texts: list[str], base: list[list[Span]], field: Field) -> list[list[Span]]:
    """Spans that the field adds: neighbouring words of one kind are one span."""
    out: list[list[Span]] = [[] for _ in texts]
    w = read(texts, base)
    if not len(w.doc):
        return out
    p = field.posteriors(w)
    kind = p.argmax(1)
    joined = set(map(tuple, w.chain.tolist()))
    for i in np.flatnonzero((kind != OTHER) & (p.max(1) >= SURE) & (w.label == OTHER)).tolist():
        text, a, b = texts[w.doc[i]], int(w.begin[i]), int(w.end[i])
        while a < b and not (text[a].isalnum() or text[a] in "+("):
            a += 1
        while a < b and not (text[b - 1].isalnum() or text[b - 1] == ")"):
            b -= 1
        own = out[w.doc[i]]
        if a == b or any(x < b and y > a for _, x, y in base[w.doc[i]]):
            continue
        if own and own[-1][0] == kind[i] and (i - 1, i) in joined and own[-1][2] > int(w.begin[i - 1]):
            own[-1] = (own[-1][0], own[-1][1], b)
        else:
            own.append((int(kind[i]), a, b))
    return out


def found(docs: DataFrame, field: Field) -> DataFrame:
    """Adds base (array of kind, begin, end) and more (what the field adds) to the documents."""
    sent = docs.sparkSession.sparkContext.broadcast(field)
    docs = docs.drop("base", "more")
    kind = "array<struct<kind:int,begin:int,end:int>>"
    shape = docs.select("*", F.array().cast(kind).alias("base"), F.array().cast(kind).alias("more")).schema
    arrow = pa.list_(pa.struct([("kind", pa.int32()), ("begin", pa.int32()), ("end", pa.int32())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, texts in slices(batch, "text"):
                texts = [t or "" for t in texts]
                base = [base_spans(t) for t in texts]
                more = added(texts, base, sent.value)
                made = [pa.array([[dict(zip(("kind", "begin", "end"), s, strict=True)) for s in spans] for spans in x], arrow) for x in (base, more)]
                yield pa.RecordBatch.from_arrays([*part.columns, *made], [*part.schema.names, "base", "more"])

    return docs.mapInArrow(run, shape)


def masked(docs: DataFrame, field: Field) -> DataFrame:
    """The documents with every span replaced by its kind in angle brackets; nulls stay null."""
    sent = docs.sparkSession.sparkContext.broadcast(field)
    names = docs.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        k = names.index("text")
        for batch in batches:
            for part, texts in slices(batch, "text"):
                full = [t or "" for t in texts]
                base = [base_spans(t) for t in full]
                more = added(full, base, sent.value)
                done = [None if t is None else replaced(t, [*b, *m]) for t, b, m in zip(texts, base, more, strict=True)]
                yield pa.RecordBatch.from_arrays([*part.columns[:k], pa.array(done, part.column(k).type), *part.columns[k + 1 :]], schema=part.schema)

    return docs.mapInArrow(run, docs.schema)


def replaced(text: str, spans: list[Span]) -> str:
    """Spans that overlap are replaced together, by the kind of the first."""
    out, end = [], 0
    for kind, a, b in sorted(spans, key=lambda s: (s[1], -s[2], s[0])):
        if a >= end:
            out += [text[end:a], f"<{KINDS[kind].upper()}>"]
        end = max(end, b)
    return "".join([*out, text[end:]])


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir).select("doc_id", "text")
    sent = spark.sparkContext.broadcast(fitted(docs))
    shape = "doc_id long, " + ", ".join(f"n_{k} long" for k in KINDS) + ", base_sha256 string, spans string, n_added long"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, texts in slices(batch, "text"):
                texts = [t or "" for t in texts]
                base = [base_spans(t) for t in texts]
                more = added(texts, base, sent.value)
                counts = [pa.array([sum(s[0] == k for s in b) for b in base], pa.int64()) for k in range(OTHER)]
                digest = pa.array([hashlib.sha256(written(b).encode()).hexdigest() for b in base], pa.string())
                spans = pa.array([written([*b, *m]) for b, m in zip(base, more, strict=True)], pa.string())
                yield pa.RecordBatch.from_arrays([part.column(0), *counts, digest, spans, pa.array(list(map(len, more)), pa.int64())], [x.split()[0] for x in shape.split(", ")])

    return docs.mapInArrow(run, shape)
