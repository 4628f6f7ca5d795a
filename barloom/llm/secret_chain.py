"""Operator 11: secrets by patterns and a linear-chain conditional random field.

Patterns find assignments to names like ``password``, access keys and long hexadecimal strings: the base spans, which always stay.
The field then tags every token (a run of word characters, or another character) of every text as outside, begin or inside of a
secret. It sees the token's shape (kind of characters, length, variety, vowels, first letters), the words around it and features
of the whole file (source, language, shares of punctuation and of numbers). The best tags of a document are found by Viterbi's
algorithm. A tagged stretch becomes a span of kind ``secret``, if it is of ``LEAST`` characters or more and touches no base span.

Weights are trained by likelihood on windows around the base spans and on others, from a sample of about ``SAMPLE`` documents and
at most ``WINDOWS`` windows of either sort, whatever the size of the table. Each window with a secret is trained once with all
features, once with its words, exact shapes and first letters hidden, and once with its context hidden, so that neither the names
of the base patterns nor one form of secret become the only evidence. Long plain numbers, which the pattern for hexadecimal strings
takes as well, are not taught as secrets.

Weights of a token in its places (itself, one to three back, one ahead) are sums over its features, made once for tokens that
share all of them. Most tokens are so far from a secret that no path of tags through them can win, whatever the tags beside: exact bounds
from the transitions leave them out, and Viterbi's algorithm runs on the short stretches in between.

Null texts count as empty and have no spans. Texts are read whole, in time linear in their length; rows are independent. Equal rows
get equal results. Equal scores go to the tag listed first: outside, begin, inside. An empty table gives no rows, and without any
secret to learn from nothing is added. Null sources, languages and ids are features or values like others. Only the named columns are read.
"""

from __future__ import annotations

import hashlib
import re
import zlib
from bisect import bisect_left
from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from barloom.llm.common import CACHE, documents, slices

KINDS = ("assign", "access", "hex", "secret")
ADDED = len(KINDS) - 1
ASSIGN = re.compile(r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.ASCII)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{16,}")
ASSIGNED, KEY = 12, 18  # fewest characters of a value, of an access key

TOKEN = re.compile(r"\w+|[^\w\s]")
LEAST = 8
#: The bounds of what the field is fitted on: documents, and windows of each sort.
SAMPLE = 20_000
WINDOWS = 500
LENGTH, BEFORE = 20, 8  # tokens of a window, and how many of them stand before the secret
FILE = ("source", "lang")
O, B, I = 0, 1, 2
#: Weights of transitions stay within this, so that what can be ruled out has a bound.
FIRM = 8.0
SHRINK = 0.02
ROUNDS, RATE = 80, 0.15
PLACES = (0, -1, -2, -3, 1)  # where a token's features count, from the token that is tagged

Span = tuple[int, int, int]
#: Whether it has a secret, tokens, tags, features of the file.
Window = tuple[bool, list[str], list[int], list[str]]


def base_spans(text: str) -> tuple[list[Span], list[tuple[int, int]]]:
    """Spans (kind, begin, end), and the secrets that they hold."""
    spans, secrets = [], []
    if "=" in text or ":" in text:
        for m in ASSIGN.finditer(text):
            if m.end(1) - m.start(1) >= ASSIGNED:
                spans.append((0, *m.span()))
                secrets.append(m.span(1))
    if "AKIA" in text:
        for m in ACCESS.finditer(text):
            if m.end() - m.start() >= KEY:
                spans.append((1, *m.span()))
                secrets.append(m.span())
    for m in HEX.finditer(text):
        spans.append((2, *m.span()))
        if not m.group().isdigit():
            secrets.append(m.span())
    return spans, secrets


def written(spans: Sequence[Span]) -> str:
    return ",".join([f"{KINDS[k]}:{a}:{b}" for k, a, b in sorted(spans, key=lambda s: (s[1], s[0], s[2]))])


#: Upper ends of the classes of length.
LENGTHS = (1, 2, 4, 7, 9, 11, 15, 19, 31, 63)
HEXADECIMAL = "0123456789abcdefABCDEF"
Shape = tuple[str, int, int, int]


def shape_of(word: str) -> Shape:
    """Kind of characters and class of length; for those that mix letters and digits, variety and vowels, too."""
    n = len(word)
    size = bisect_left(LENGTHS, n)
    if n == 1 and not word.isalnum():
        return word, 0, 0, 0
    if not word.isascii():
        return "other", size, 0, 0
    case = "lower" if word.islower() else "upper" if word.isupper() else "title" if word.istitle() else "mixed"
    if word.isalpha():
        return case, size, 0, 0
    if word.isdigit():
        return "number", size, 0, 0
    if not any(map(str.isdigit, word)):
        return f"{case} _", size, 0, 0
    kind = f"{case} +" if word.strip(HEXADECIMAL) else "hex"
    return kind, size, len(set(word)) * 5 // min(n, 16), sum(map(word.count, "aeiouAEIOU")) * 5 // n


def group_of(shape: Shape) -> str:
    kind = shape[0]
    return "mark" if len(kind) == 1 else "number" if kind == "number" else "mixture" if kind == "hex" or kind.endswith("+") else "letters"


def own(shape: Shape, lower: str, start: str) -> tuple[list[str], list[str]]:
    """Features of a token by itself: those that any secret may share, and those of one form of it."""
    kind, size, variety, vowels = shape
    group = group_of(shape)
    broad = ["any", f"group {group}", f"group {group} {size}"]
    if group == "mixture":
        broad += [f"variety {variety}", f"vowels {vowels}"]
    return broad, [f"kind {kind} {size}", f"word {lower}", f"begins {start}"]


def beside(shape: Shape, lower: str, place: int) -> list[str]:
    """What a token says about the one that stands ``-place`` from it."""
    kind = "short" if shape[1] == 0 else shape[0]
    return [f"{place} {lower}", f"{place} kind {kind}", *([f"near {lower}"] if place < 0 else [])]


def start_of(word: str) -> str:
    return word[:4] if len(word) >= LEAST else ""


def files_of(batch: pa.RecordBatch) -> list[list[str]]:
    """Features of each row's file, from those of the columns ``FILE`` that the table has."""
    columns = [(c, batch.column(c).to_pylist()) for c in FILE if c in batch.schema.names]
    return [[f"{c} {values[k]}" for c, values in columns] for k in range(batch.num_rows)]


def shares(tokens: int, marks: int, numbers: int) -> list[str]:
    return [f"marks {marks * 8 // max(tokens, 1)}", f"numbers {numbers * 8 // max(tokens, 1)}"]


def labels_of(text: str, secrets: Sequence[tuple[int, int]]) -> tuple[list[str], list[int]]:
    """Tokens of a text with their tags by the secrets that the patterns found."""
    tokens, tags = [], []
    ordered, k, last = sorted(secrets), 0, None
    for m in TOKEN.finditer(text):
        begin, end = m.span()
        while k < len(ordered) and ordered[k][1] <= begin:
            k += 1
        inside = k < len(ordered) and ordered[k][0] < end
        tags.append((I if last == k else B) if inside else O)
        last = k if inside else None
        tokens.append(m.group())
    return tokens, tags


def windows_of(text: str, secrets: Sequence[tuple[int, int]], file: Sequence[str], seed: int) -> Iterator[Window]:
    """Windows of a text: one around each secret, and two without, of which one is at a token that mixes letters and digits."""
    tokens, tags = labels_of(text, secrets)
    if not tokens:
        return
    marks = sum(len(t) == 1 and not t.isalnum() for t in tokens)
    numbers = sum(map(str.isdigit, tokens))
    about = [*file, *shares(len(tokens), marks, numbers)]
    mixed = [k for k, t in enumerate(tokens) if tags[k] == O and len(t) >= LEAST and any(map(str.isdigit, t))]
    chosen = [seed % len(tokens), *([mixed[seed % len(mixed)]] if mixed else [])]
    for k in [k for k, t in enumerate(tags) if t == B] + chosen:
        begin = max(k - BEFORE, 0)
        part = tags[begin : begin + LENGTH]
        yield any(part), tokens[begin : begin + LENGTH], part, about


@dataclass
class Field:
    """Weights of the tags begin and inside against outside, by feature (the first is none), and of transitions."""

    names: dict[str, int]
    weights: np.ndarray
    moves: np.ndarray

    def of(self, names: Sequence[str]) -> np.ndarray:
        return self.weights[[self.names.get(n, 0) for n in names]].sum(axis=0)

    @property
    def bounds(self) -> np.ndarray:
        """How much any tags beside a token can favour begin and inside over outside."""
        t = self.moves
        return ((t - t[:, [O]]).max(axis=0) + (t - t[[O], :]).max(axis=1))[1:]


def rows_of(windows: Sequence[Window]) -> tuple[dict[str, int], np.ndarray, np.ndarray, np.ndarray]:
    """Features by name, their numbers [window, token, feature] (0 stands for none), tags and presence."""
    names: dict[str, int] = {"": 0}
    made = []
    for secret, tokens, tags, about in windows:
        told = [(shape_of(t), t.lower(), start_of(t)) for t in tokens]
        for hidden in ("", "exact", "context") if secret else ("",):
            rows = []
            for k, token in enumerate(told):
                broad, exact = own(*token)
                listed = [*broad, *about, *(exact if hidden != "exact" else [])]
                if hidden != "context":
                    for place in PLACES[1:]:
                        if 0 <= k + place < len(told):
                            listed += beside(*told[k + place][:2], place)
                rows.append([names.setdefault(n, len(names)) for n in listed])
            made.append((rows, tags))
    most = max((len(r) for rows, _ in made for r in rows), default=1)
    x = np.zeros((len(made), LENGTH, most), np.int64)
    y, there = np.zeros((len(made), LENGTH), np.int64), np.zeros((len(made), LENGTH), bool)
    for n, (rows, tags) in enumerate(made):
        for k, row in enumerate(rows):
            x[n, k, : len(row)] = row
        y[n, : len(tags)] = tags
        there[n, : len(tags)] = True
    return names, x, y, there


def gradient(x: np.ndarray, y: np.ndarray, there: np.ndarray, field: Field) -> tuple[np.ndarray, np.ndarray]:
    """Of the log-likelihood of the tags, by forward and backward sums; text before and after a window counts as outside."""
    n, length, _ = x.shape
    score = np.zeros((n, length, 3))
    score[:, :, 1:] = field.weights[x].sum(axis=2)
    score[~there] = (0.0, -1e9, -1e9)

    def total(a: np.ndarray) -> np.ndarray:
        top = a.max(axis=1)
        return top + np.log(np.exp(a - top[:, None]).sum(axis=1))

    ahead = np.empty((n, length, 3))
    ahead[:, 0] = score[:, 0] + field.moves[O]
    for t in range(1, length):
        ahead[:, t] = score[:, t] + total(ahead[:, t - 1, :, None] + field.moves)
    behind = np.zeros((n, length, 3))
    behind[:, -1] = field.moves[:, O]
    for t in range(length - 2, -1, -1):
        behind[:, t] = total((behind[:, t + 1] + score[:, t + 1])[:, :, None] + field.moves.T)
    whole = total(ahead[:, -1] + field.moves[:, O])
    tag = np.exp(ahead + behind - whole[:, None, None])
    missed = (np.eye(3)[y] - tag) * there[:, :, None]
    by_feature = np.stack([np.bincount(x.ravel(), np.repeat(missed[:, :, k].ravel(), x.shape[2]), len(field.weights)) for k in (B, I)], axis=1)
    by_feature[0] = 0
    pair = np.exp(ahead[:, :-1, :, None] + field.moves + (score[:, 1:] + behind[:, 1:])[:, :, None, :] - whole[:, None, None, None])
    seen = np.eye(3)[y[:, :-1]][:, :, :, None] * np.eye(3)[y[:, 1:]][:, :, None, :]
    both = (there[:, 1:] & there[:, :-1])[:, :, None, None]
    return by_feature, ((seen - pair) * both).sum(axis=(0, 1))


def fit(windows: Sequence[Window]) -> Field | None:
    """The field that makes the tags of the windows likely, with a penalty on large weights; none without secrets."""
    if not any(w[0] for w in windows):
        return None
    names, x, y, there = rows_of(windows)
    field = Field(names, np.zeros((len(names), 2)), np.zeros((3, 3)))
    field.moves[O, I] = -FIRM / 2
    slope, size = [np.zeros_like(field.weights), np.zeros_like(field.moves)], [np.zeros_like(field.weights), np.zeros_like(field.moves)]
    for step in range(1, ROUNDS + 1):
        found = gradient(x, y, there, field)
        for k, (value, g) in enumerate(zip((field.weights, field.moves), found, strict=True)):
            g = g - SHRINK * len(x) / 100 * value
            slope[k] = 0.9 * slope[k] + 0.1 * g
            size[k] = 0.99 * size[k] + 0.01 * g * g
            value += RATE * (slope[k] / (1 - 0.9**step)) / (np.sqrt(size[k] / (1 - 0.99**step)) + 1e-8)
        np.clip(field.moves, -FIRM, FIRM, out=field.moves)
    return field


def best_tags(scores: Sequence[Sequence[float]], moves: Sequence[Sequence[float]]) -> list[int]:
    """Viterbi's algorithm over tokens between two that are outside; ``scores`` are those of begin and inside against outside."""
    best, back = None, []
    for b, i in scores:
        own = (0.0, b, i)
        if best is None:
            best = [own[y] + moves[O][y] for y in (O, B, I)]
            continue
        before = [max((O, B, I), key=lambda a, y=y: best[a] + moves[a][y]) for y in (O, B, I)]
        best = [best[before[y]] + moves[before[y]][y] + own[y] for y in (O, B, I)]
        back.append(before)
    tag = max((O, B, I), key=lambda y: best[y] + moves[y][O])
    tags = [tag]
    for before in reversed(back):
        tag = before[tag]
        tags.append(tag)
    return tags[::-1]


class Tagger:
    """Finds what the field adds to the base spans of many texts; keeps the weights of tokens between batches."""

    def __init__(self, field: Field):
        self.field = field
        self.moves = field.moves.tolist()
        self.floor = -field.bounds - 1e-3  # for the rounding of single precision
        self.words = {n.split(" ", 1)[1] for n in field.names if " " in n}
        self.clear()

    def clear(self) -> None:
        self.known: dict[str, int] = {}  # of tokens; those that differ in no feature have one number
        self.alike: dict[tuple, int] = {}
        self.weights = np.zeros((len(PLACES), 1024, 2), np.float32)
        self.sort = np.zeros(1024, np.int8)
        self.files: dict[tuple[str, ...], np.ndarray] = {}
        self.number("")  # beyond the ends of a text

    def number(self, token: str) -> int:
        lower, start = token.lower(), start_of(token)
        shape = shape_of(token)
        features = (shape, lower if lower in self.words else None, start if f"begins {start}" in self.field.names else None)
        k = self.known[token] = self.alike.setdefault(features, len(self.alike))
        if k == len(self.alike) - 1:
            if k >= len(self.sort):
                self.weights = np.concatenate([self.weights, np.zeros_like(self.weights)], axis=1)
                self.sort = np.concatenate([self.sort, np.zeros_like(self.sort)])
            if token:
                names = [sum(own(shape, lower, start), []), *[beside(shape, lower, place) for place in PLACES[1:]]]
                self.weights[:, k] = [self.field.of(n) for n in names]
                self.sort[k] = ("mark", "number").index(group) + 1 if (group := group_of(shape)) in ("mark", "number") else 0
        return k

    def file_weight(self, names: tuple[str, ...]) -> np.ndarray:
        if names not in self.files:
            self.files[names] = self.field.of(names)
        return self.files[names]

    def spans(self, texts: Sequence[str], base: Sequence[Sequence[Span]], files: Sequence[Sequence[str]]) -> list[list[Span]]:
        if len(self.known) > CACHE or len(self.files) > CACHE:
            self.clear()
        tokens = [TOKEN.findall(t) for t in texts]
        for t in set().union(*tokens).difference(self.known):
            self.number(t)
        sizes = np.fromiter(map(len, tokens), np.int64, len(tokens))
        out: list[list[Span]] = [[] for _ in texts]
        if not sizes.sum():
            return out
        flat = np.fromiter(map(self.known.__getitem__, chain.from_iterable(tokens)), np.int64, int(sizes.sum()))
        doc = np.repeat(np.arange(len(texts)), sizes)
        ends = np.cumsum(sizes)
        spot = np.arange(len(flat)) - (ends - sizes)[doc]
        sort = self.sort[flat]
        marks, numbers = (np.bincount(doc, sort == k, len(texts)).astype(int) for k in (1, 2))
        shared = zip(files, sizes.tolist(), marks.tolist(), numbers.tolist(), strict=True)
        about = np.stack([self.file_weight((*f, *shares(n, m, d))) for f, n, m, d in shared]).astype(np.float32)
        score = self.weights[0][flat] + about[doc]
        for p, place in enumerate(PLACES[1:], 1):
            other = np.zeros_like(flat)
            if place < 0:
                other[-place:] = flat[:place]
                other[spot < -place] = 0
            else:
                other[:-place] = flat[place:]
                other[spot >= sizes[doc] - place] = 0
            score += self.weights[p][other]
        open_ = np.flatnonzero((score >= self.floor).any(axis=1))
        if not len(open_):
            return out
        cut = np.flatnonzero((np.diff(open_) > 1) | (doc[open_[1:]] != doc[open_[:-1]])) + 1
        places: dict[int, list[tuple[int, int]]] = {}
        for stretch in np.split(open_, cut):
            tags = best_tags(score[stretch].tolist(), self.moves)
            if not any(tags):
                continue
            d, first = int(doc[stretch[0]]), int(spot[stretch[0]])
            if d not in places:
                places[d] = [m.span() for m in TOKEN.finditer(texts[d])]
            begin = None
            for k, tag in enumerate([*tags, O]):
                if begin is not None and tag != I:
                    out[d].append((ADDED, places[d][first + begin][0], places[d][first + k - 1][1]))
                    begin = None
                if tag == B or (tag == I and begin is None):
                    begin = k
        for d, found in enumerate(out):
            if found:
                taken = sorted((a, b) for _, a, b in base[d])
                out[d] = [s for s in found if s[2] - s[1] >= LEAST and not any(a < s[2] and s[1] < b for a, b in taken)]
        return out


def fitted(docs: DataFrame) -> Field | None:
    """The field for a table with a column ``text`` and perhaps those of ``FILE``, from a bounded sample of it."""
    share = min(1.0, SAMPLE / max(docs.count(), 1))
    some = docs.select("text", *[c for c in FILE if c in docs.columns]).where("text is not null")
    if share < 1:
        some = some.sample(share, seed=11)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, texts in slices(batch, "text"):
                rows = []
                for text, file in zip(texts, files_of(part), strict=True):
                    seed = zlib.crc32(text.encode())
                    for n, w in enumerate(windows_of(text, base_spans(text)[1], file, seed)):
                        rows.append((w[0], zlib.crc32(f"{n} {seed}".encode()), *w[1:]))
                columns = list(zip(*rows, strict=True)) if rows else [[]] * 5
                kinds = (pa.bool_(), pa.int64(), pa.list_(pa.string()), pa.list_(pa.int32()), pa.list_(pa.string()))
                yield pa.RecordBatch.from_arrays([pa.array(list(c), k) for c, k in zip(columns, kinds, strict=True)], ["secret", "rank", "tokens", "tags", "about"])

    # equal windows count once
    found = some.mapInArrow(run, "secret boolean, rank long, tokens array<string>, tags array<int>, about array<string>").distinct()
    order = ["rank", "tokens", "tags", "about"]
    kept = [found.where(F.col("secret") == s).orderBy(*order).limit(WINDOWS).collect() for s in (True, False)]
    return fit([(r.secret, list(r.tokens), list(r.tags), list(r.about)) for rows in kept for r in rows])


def found(docs: DataFrame, field: Field | None) -> DataFrame:
    """``docs`` with ``secrets``: kind, begin and end of each span by begin. A column of that name is replaced."""
    rows = docs.drop("secrets")
    sent = rows.sparkSession.sparkContext.broadcast(field)
    shape = rows.withColumn("secrets", F.lit(None).cast("array<struct<kind:string,begin:long,end:long>>")).schema
    kind = pa.list_(pa.struct([("kind", pa.string()), ("begin", pa.int64()), ("end", pa.int64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tagger = Tagger(sent.value) if sent.value else None
        for batch in batches:
            for part, texts in slices(batch, "text"):
                full = [t or "" for t in texts]
                base = [base_spans(t)[0] for t in full]
                more = tagger.spans(full, base, files_of(part)) if tagger else [[]] * len(full)
                spans = [[{"kind": KINDS[k], "begin": a, "end": b} for k, a, b in sorted([*x, *y], key=lambda s: (s[1], s[0], s[2]))] for x, y in zip(base, more, strict=True)]
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(spans, kind)], shape.fieldNames())

    return rows.mapInArrow(run, shape)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir).select("doc_id", "text", *FILE)
    sent = spark.sparkContext.broadcast(fitted(docs))
    names = ["doc_id", *[f"n_{k}" for k in KINDS[:ADDED]], "base_sha256", "spans", "n_added"]
    shape = "doc_id long, n_assign long, n_access long, n_hex long, base_sha256 string, spans string, n_added long"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tagger = Tagger(sent.value) if sent.value else None
        for batch in batches:
            for part, texts in slices(batch, "text"):
                full = [t or "" for t in texts]
                base = [base_spans(t)[0] for t in full]
                more = tagger.spans(full, base, files_of(part)) if tagger else [[]] * len(full)
                counts = [pa.array([sum(s[0] == k for s in b) for b in base], pa.int64()) for k in range(ADDED)]
                digest = pa.array([hashlib.sha256(written(b).encode()).hexdigest() for b in base], pa.string())
                spans = pa.array([written([*b, *m]) for b, m in zip(base, more, strict=True)], pa.string())
                yield pa.RecordBatch.from_arrays([part.column(0), *counts, digest, spans, pa.array(list(map(len, more)), pa.int64())], names)

    return docs.mapInArrow(run, shape)
