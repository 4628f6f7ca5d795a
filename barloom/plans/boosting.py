"""Gradient-boosted trees grown best-first over binned features, for several horizons at once.

A tree grows where the loss falls most: the leaf with the largest gain is split next, until there are ``leaves`` of them. What
Spark does is counting. Features are cut into bins once, rows become blocks of small arrays in a stored table, and a pass over the
blocks returns sums of residuals and rows by leaf, feature and bin, added up in a tree of tasks. Of two new leaves only the
smaller one is counted; its sibling is the difference from their parent. A pass counts for all horizons and for every leaf that
may be split under the best outcome of the others, so a tree takes as many passes as it is deep, not one for each split.

The driver holds counts (leaves x features x bins), never rows. Scores of rows are not sent around: tasks derive them from the
few trees that are newer than the stored blocks, which are rewritten every ``STORED_ROUNDS`` rounds. Rows that fit one block
are boosted by the same code within one task for each horizon, which saves the passes; beyond a block they are always counted in passes.
"""

from __future__ import annotations

import heapq
import json
from collections.abc import Iterator, Mapping, Sequence
from dataclasses import asdict, dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from barloom.session import materialized

#: Rows of a block.
BLOCK_ROWS = 65_536
#: Partial counts that are added up in one task, or on the driver.
FAN_IN = 32
STORED_ROUNDS = 10


@dataclass(frozen=True)
class Params:
    """How trees grow. Rounds, rate, leaves and depth are those of the named forecaster, the rest its library's defaults."""

    rounds: int = 200
    rate: float = 0.1
    leaves: int = 31
    depth: int = 15
    leaf_rows: int = 20
    bins: int = 255


@dataclass
class Tree:
    """Nodes in the order they were made; a leaf has feature -1. ``x <= threshold`` goes left, so a missing value goes right."""

    feature: list[int] = field(default_factory=list)
    bin: list[int] = field(default_factory=list)
    threshold: list[float] = field(default_factory=list)
    left: list[int] = field(default_factory=list)
    right: list[int] = field(default_factory=list)
    value: list[float] = field(default_factory=list)
    rows: list[int] = field(default_factory=list)

    def add(self, value: float, rows: int) -> int:
        for name, v in (("feature", -1), ("bin", 0), ("threshold", 0.0), ("left", 0), ("right", 0), ("value", value), ("rows", rows)):
            getattr(self, name).append(v)
        return len(self.feature) - 1

    @property
    def leaves(self) -> int:
        return sum(f < 0 for f in self.feature)

    def leaf_of(self, x: np.ndarray, cuts: Sequence[float]) -> np.ndarray:
        """The leaf of each row of ``x``, by cuts in its units."""
        f, cut, left, right = (np.asarray(a) for a in (self.feature, cuts, self.left, self.right))
        at, rows = np.zeros(len(x), np.int64), np.arange(len(x))
        while len(rows) and (rows := rows[f[at[rows]] >= 0]).size:
            here = at[rows]
            at[rows] = np.where(x[rows, f[here]] <= cut[here], left[here], right[here])
        return at

    def predict(self, x: np.ndarray) -> np.ndarray:
        return np.asarray(self.value)[self.leaf_of(x, self.threshold)]

    def scores(self, bins: np.ndarray) -> np.ndarray:
        return np.asarray(self.value)[self.leaf_of(bins, self.bin)]


@dataclass
class Split:
    gain: float
    feature: int
    bin: int
    left: tuple[float, int]  # sum of residuals, rows
    right: tuple[float, int]


def best_split(sums: np.ndarray, rows: np.ndarray, least: int) -> Split | None:
    """The split of largest gain in squared loss from sums and rows by feature and bin; the first of equal ones."""
    g, n = sums.cumsum(axis=1), rows.cumsum(axis=1)
    total, count = g[:, -1:], n[:, -1:]
    other, left = count - n, np.maximum(n, 1)
    with np.errstate(divide="ignore", invalid="ignore"):
        gain = g * g / left + (total - g) ** 2 / np.maximum(other, 1) - total * total / np.maximum(count, 1)
    gain[(n < least) | (other < least)] = -np.inf
    k = int(gain.argmax())
    f, b = divmod(k, gain.shape[1])
    if not gain[f, b] > 1e-12 * max(1.0, float(total[f, 0] ** 2)):
        return None
    return Split(float(gain[f, b]), f, b, (float(g[f, b]), int(n[f, b])), (float(total[f, 0] - g[f, b]), int(other[f, b])))


class Growth:
    """A tree while it grows: says which nodes to count next, and takes the counts."""

    def __init__(self, params: Params):
        self.params = params
        self.tree = Tree()
        self.tree.add(0.0, 0)
        self.depth = [0]
        self.counts: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        self.split: dict[int, Split | None] = {}
        self.sibling: dict[int, tuple[int, int]] = {}
        self.wanted = [0]

    def take(self, counts: Mapping[int, tuple[np.ndarray, np.ndarray]]) -> None:
        """Counts of the wanted nodes; those of their siblings follow. Then the next ones are named."""
        for node, (sums, rows) in counts.items():
            self.counts[node] = sums, rows
            if node in self.sibling:
                parent, other = self.sibling[node]
                above = self.counts.pop(parent)
                self.counts[other] = above[0] - sums, above[1] - rows
        for node in [n for n in self.counts if n not in self.split]:
            sums, rows = self.counts[node]
            n = int(rows[0].sum())
            if node == 0:
                self.tree.value[0], self.tree.rows[0] = self.params.rate * float(sums[0].sum()) / max(n, 1), n
            self.split[node] = best_split(sums, rows, self.params.leaf_rows) if self.may_split(node) else None
        self.wanted = []
        self.chosen()

    def may_split(self, node: int) -> bool:
        return self.tree.rows[node] >= 2 * self.params.leaf_rows and self.depth[node] < self.params.depth

    def chosen(self) -> list[int]:
        """Nodes in the order in which they are split, as far as is known; new leaves are made and named on the way."""
        heap, order = [], []

        def push(node: int) -> None:
            if split := self.split.get(node):
                heapq.heappush(heap, (-split.gain, node))

        push(0)
        while heap and len(order) + 1 < self.params.leaves:
            _, node = heapq.heappop(heap)
            order.append(node)
            if self.tree.feature[node] < 0:
                self.divide(node)
            push(self.tree.left[node])
            push(self.tree.right[node])
        return order

    def divide(self, node: int) -> None:
        split, tree = self.split[node], self.tree
        tree.feature[node], tree.bin[node] = split.feature, split.bin
        made = [tree.add(self.params.rate * g / n, n) for g, n in (split.left, split.right)]
        tree.left[node], tree.right[node] = made
        self.depth += [self.depth[node] + 1] * 2
        if any(map(self.may_split, made)):
            small, large = sorted(made, key=lambda k: (tree.rows[k], k))
            self.sibling[small] = node, large
            self.wanted.append(small)
        else:
            self.counts.pop(node, None)

    def finished(self, edges: Sequence[Sequence[float]]) -> Tree:
        """The tree of the chosen splits only, with thresholds in the features' own units."""
        kept, out = set(self.chosen()), Tree()

        def copy(node: int) -> int:
            k = out.add(self.tree.value[node], self.tree.rows[node])
            if node in kept:
                f, b = self.tree.feature[node], self.tree.bin[node]
                out.feature[k], out.bin[k], out.threshold[k] = f, b, float(edges[f][b])
                out.left[k], out.right[k] = copy(self.tree.left[node]), copy(self.tree.right[node])
            return k

        copy(0)
        return out


def counted(bins: np.ndarray, residual: np.ndarray, tree: Tree, wanted: Sequence[int], width: int) -> tuple[np.ndarray, np.ndarray]:
    """Sums of residuals and rows [node, feature, bin] of the wanted leaves of an unfinished tree."""
    slot = np.full(len(tree.feature), -1, np.int64)
    slot[list(wanted)] = np.arange(len(wanted))
    own = slot[tree.leaf_of(bins, tree.bin)]
    rows = np.flatnonzero(own >= 0)
    features = bins.shape[1]
    at = ((own[rows, None] * features + np.arange(features)) * width + bins[rows]).ravel()
    size = len(wanted) * features * width
    shape = (len(wanted), features, width)
    sums = np.bincount(at, np.repeat(residual[rows], features), size)
    return sums.reshape(shape), np.bincount(at, minlength=size).reshape(shape)


@dataclass(frozen=True)
class Boosted:
    """Fitted trees by horizon, on top of the targets' means; ``losses`` has the mean squared error before each round and after the last."""

    features: tuple[str, ...]
    horizons: tuple[int, ...]
    start: tuple[float, ...]
    trees: tuple[tuple[Tree, ...], ...]
    losses: tuple[tuple[float, ...], ...]
    kind: str = "boosting"

    def wide(self, table: DataFrame) -> DataFrame:
        """``table`` with a column ``prediction_<h>`` for each horizon."""
        names = [f"prediction_{h}" for h in self.horizons]
        rows = table.drop(*names)
        schema = T.StructType([*rows.schema.fields, *[T.StructField(n, T.DoubleType()) for n in names]])
        model = self

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                x = np.stack([batch.column(c).to_numpy(zero_copy_only=False).astype(float) for c in model.features], axis=1)
                found = [start + sum(t.predict(x) for t in trees) for start, trees in zip(model.start, model.trees, strict=True)]
                yield pa.RecordBatch.from_arrays([*batch.columns, *[pa.array(p + np.zeros(len(x))) for p in found]], schema.fieldNames())

        return rows.mapInArrow(run, schema)

    def predict(self, table: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
        """Long ``(series, ts, horizon, prediction)``."""
        pairs = [F.struct(F.lit(h).alias("horizon"), F.col(f"prediction_{h}").alias("prediction")) for h in self.horizons]
        return self.wide(table).select("series", "ts", *keep, F.inline(F.array(*pairs)))

    def importances(self, spark: SparkSession) -> DataFrame:
        """Long ``(feature, horizon, importance)``: a feature's share of the splits."""
        rows = []
        for h, trees in zip(self.horizons, self.trees, strict=True):
            used = np.bincount([f for t in trees for f in t.feature if f >= 0], minlength=len(self.features))
            rows += [(name, h, float(n) / max(int(used.sum()), 1)) for name, n in zip(self.features, used, strict=True)]
        return spark.createDataFrame(rows, "feature string, horizon int, importance double")

    def nodes(self, spark: SparkSession) -> DataFrame:
        """Every node of every tree as a row."""
        rows = [
            (h, k, n, self.features[t.feature[n]] if t.feature[n] >= 0 else None, t.threshold[n], t.left[n], t.right[n], t.value[n], t.rows[n])
            for h, trees in zip(self.horizons, self.trees, strict=True)
            for k, t in enumerate(trees)
            for n in range(len(t.feature))
        ]
        return spark.createDataFrame(
            rows, "horizon int, tree int, node int, feature string, threshold double, `left` int, `right` int, value double, rows long"
        )

    def dumped(self) -> str:
        return json.dumps(asdict(self))

    @staticmethod
    def loaded(text: str) -> Boosted:
        told = json.loads(text)
        trees = tuple(tuple(Tree(**t) for t in trees) for trees in told["trees"])
        rest = {k: tuple(told[k]) for k in ("features", "horizons", "start")}
        return Boosted(**rest, trees=trees, losses=tuple(map(tuple, told["losses"])), kind=told["kind"])


def edges_of(table: DataFrame, features: Sequence[str], bins: int) -> list[np.ndarray]:
    """Upper ends of all bins but the last, from quantile sketches made in one pass."""
    found = table.approxQuantile(list(features), [k / bins for k in range(1, bins)], 1 / (8 * bins))
    return [np.unique(np.asarray(q, float)) for q in found]


def blocks_of(table: DataFrame, features: Sequence[str], targets: Sequence[str], edges: Sequence[np.ndarray], start: Sequence[float]) -> DataFrame:
    """Rows as stored blocks: bins (a byte for each feature), targets and scores as arrays of whole blocks."""
    kind = np.uint8 if max(map(len, edges), default=0) < 256 else np.uint16
    size = BLOCK_ROWS

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, np.ndarray]] = []

        def block() -> pa.RecordBatch:
            bins, y = (np.concatenate([h[k] for h in held]) for k in (0, 1))
            held.clear()
            score = np.broadcast_to(np.asarray(start), y.shape)
            return pa.RecordBatch.from_pydict({"rows": [len(y)], "bins": [bins.tobytes()], "targets": [y.tobytes()], "scores": [score.tobytes()]})

        for batch in batches:
            x = [np.searchsorted(e, batch.column(f).to_numpy(zero_copy_only=False).astype(float)) for f, e in zip(features, edges, strict=True)]
            y = np.stack([batch.column(t).to_numpy(zero_copy_only=False).astype(float) for t in targets], axis=1)
            bins = np.stack(x, axis=1).astype(kind)
            while len(y):
                room = size - sum(len(h[1]) for h in held)
                held.append((bins[:room], y[:room]))
                bins, y = bins[room:], y[room:]
                if room <= len(held[-1][1]):
                    yield block()
        if held:
            yield block()

    few = table.select(*features, *targets)
    return materialized(few.mapInArrow(run, "rows long, bins binary, targets binary, scores binary"), "binned")


def opened(batch: pa.RecordBatch, k: int, features: int, kinds: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    n = batch.column(0)[k].as_py()
    raw = batch.column(1)[k].as_buffer()
    bins = np.frombuffer(raw, np.uint8 if raw.size == n * features else np.uint16).reshape(n, features)
    return bins, *[np.frombuffer(batch.column(c)[k].as_buffer(), float).reshape(n, kinds) for c in (2, 3)]


def gathered(parts: DataFrame, partitions: int) -> np.ndarray:
    """The sum of one array of numbers a task, added up in a tree of tasks of bounded fan-in."""

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            for value in batch.column(0):
                one = np.frombuffer(value.as_buffer(), float)
                total = one.copy() if total is None else total + one
        if total is not None:
            yield pa.RecordBatch.from_pydict({"sums": [total.tobytes()]})

    while partitions > FAN_IN:
        partitions = -(-partitions // FAN_IN)
        parts = parts.repartition(partitions).mapInArrow(add, "sums binary")
    return sum(np.frombuffer(r.sums, float) for r in parts.collect())


def pass_over(blocks: DataFrame, recent: Sequence[Sequence[Tree]], growths: Sequence[Growth], features: int, width: int) -> np.ndarray:
    """One pass: by horizon, counts of the wanted nodes and the sum of squared residuals, one flat array."""
    unfinished = [(g.tree, list(g.wanted)) for g in growths]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            for k in range(batch.num_rows):
                bins, targets, scores = opened(batch, k, features, len(unfinished))
                parts = []
                for h, (tree, wanted) in enumerate(unfinished):
                    residual = targets[:, h] - scores[:, h] - sum(t.scores(bins) for t in recent[h])
                    parts += [c.ravel() for c in counted(bins, residual, tree, wanted, width)]
                    parts.append(np.array([float(residual @ residual)]))
                one = np.concatenate(parts).astype(float)
                total = one if total is None else total + one
        if total is not None:
            yield pa.RecordBatch.from_pydict({"sums": [total.tobytes()]})

    return gathered(blocks.mapInArrow(run, "sums binary"), blocks.rdd.getNumPartitions())


def boosted_in_passes(blocks: DataFrame, kinds: int, edges: Sequence[np.ndarray], params: Params) -> tuple[list[list[Tree]], list[list[float]]]:
    """All horizons side by side, counted by Spark."""
    features, width = len(edges), max(map(len, edges)) + 1
    trees: list[list[Tree]] = [[] for _ in range(kinds)]
    losses: list[list[float]] = [[] for _ in range(kinds)]
    stored = 0
    for done in range(params.rounds + 1):
        growths = [Growth(params) for _ in range(kinds)]
        first = True
        while first or any(g.wanted for g in growths):
            flat, at = pass_over(blocks, [t[stored:] for t in trees], growths, features, width), 0
            for h, g in enumerate(growths):
                shape = (len(g.wanted), features, width)
                size = int(np.prod(shape))
                sums, rows = flat[at : at + size].reshape(shape), flat[at + size : at + 2 * size].reshape(shape)
                at += 2 * size + 1
                if first:
                    losses[h].append(float(flat[at - 1] / max(rows[0, 0].sum(), 1)))
                if g.wanted and done < params.rounds:
                    g.take({node: (sums[k], rows[k]) for k, node in enumerate(g.wanted)})
            first = False
            if done == params.rounds:
                return trees, losses
        for h, g in enumerate(growths):
            trees[h].append(g.finished(edges))
        if (done + 1) % STORED_ROUNDS == 0:
            blocks, stored = rescored(blocks, [t[stored:] for t in trees], features), done + 1
    return trees, losses


def rescored(blocks: DataFrame, recent: Sequence[Sequence[Tree]], features: int) -> DataFrame:
    """Blocks whose scores include the given trees."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for k in range(batch.num_rows):
                bins, _, scores = opened(batch, k, features, len(recent))
                out.append(np.stack([scores[:, h] + sum(t.scores(bins) for t in trees) for h, trees in enumerate(recent)], axis=1).tobytes())
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], pa.array(out, pa.binary())], batch.schema.names)

    return materialized(blocks.mapInArrow(run, blocks.schema), "binned")


def boosted_in_block(bins: np.ndarray, target: np.ndarray, score: np.ndarray, edges: Sequence[np.ndarray], params: Params) -> tuple[list[Tree], list[float]]:
    """The same for the rows of one block and one horizon."""
    width, residual = max(map(len, edges)) + 1, target - score
    trees: list[Tree] = []
    losses = [float(residual @ residual) / max(len(residual), 1)]
    for _ in range(params.rounds):
        growth = Growth(params)
        while growth.wanted:
            sums, rows = counted(bins, residual, growth.tree, growth.wanted, width)
            growth.take({node: (sums[k], rows[k]) for k, node in enumerate(growth.wanted)})
        trees.append(growth.finished(edges))
        residual = residual - trees[-1].scores(bins)
        losses.append(float(residual @ residual) / max(len(residual), 1))
    return trees, losses


def fit(train: DataFrame, features: Sequence[str], horizons: Sequence[int], params: Params = Params()) -> Boosted:
    """Trees for every target ``target_<h>``; rows without a feature or target must have been left out."""
    targets = [f"target_{h}" for h in horizons]
    start = [v or 0.0 for v in train.agg(*[F.avg(t) for t in targets]).first()]
    edges = edges_of(train, features, params.bins)
    blocks = blocks_of(train, features, targets, edges, start)
    rows = blocks.agg(F.sum("rows")).first()[0] or 0
    if 0 < rows <= BLOCK_ROWS:
        trees, losses = fitted_in_block(blocks, len(targets), edges, params)
    elif rows:
        trees, losses = boosted_in_passes(blocks, len(targets), edges, params)
    else:
        trees, losses = [[] for _ in targets], [[] for _ in targets]
    return Boosted(tuple(features), tuple(horizons), tuple(start), tuple(map(tuple, trees)), tuple(map(tuple, losses)))


def fitted_in_block(blocks: DataFrame, kinds: int, edges: Sequence[np.ndarray], params: Params) -> tuple[list[list[Tree]], list[list[float]]]:
    """One task for each horizon; the block is given to each."""
    features = len(edges)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts: dict[int, list[tuple[np.ndarray, np.ndarray, np.ndarray]]] = {}
        for batch in batches:
            for k in range(batch.num_rows):
                parts.setdefault(batch.column(4)[k].as_py(), []).append(opened(batch, k, features, kinds))
        for h, found in parts.items():
            bins, target, score = (np.concatenate([p[c] for p in found]) for c in range(3))
            trees, losses = boosted_in_block(bins, target[:, h], score[:, h], edges, params)
            yield pa.RecordBatch.from_pydict({"horizon": [h], "model": [json.dumps([[asdict(t) for t in trees], losses])]})

    given = blocks.select("*", F.explode(F.sequence(F.lit(0), F.lit(kinds - 1))).alias("horizon"))
    found = given.repartition(kinds, "horizon").mapInArrow(run, "horizon long, model string").collect()
    told = [json.loads(r.model) for r in sorted(found, key=lambda r: r.horizon)]
    return [[Tree(**t) for t in trees] for trees, _ in told], [losses for _, losses in told]
