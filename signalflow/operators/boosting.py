"""Histogram gradient boosting: second-order trees with a leaf limit, L2 on the leaves, and gamma deviance.

Features are binned once. A tree grows from sums of gradients and hessians per (node, feature, bin): the split
of a node is read off their running sums, and the tree takes the best split of all its leaves
next until it has enough leaves. Where the sums come from is left open: :func:`fit` gets them by one
aggregation over all rows for every round of new nodes, however many rows there are, and :func:`fit_rows`
from rows in memory, which is how many series are fitted side by side (``series_models``).
"""

from __future__ import annotations

import heapq
import json
from collections.abc import Callable, Iterator, Sequence
from dataclasses import asdict, dataclass, field, replace

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from signalflow.session import written

# Trees after which rows are written with the predictions so far, so that a row never walks through more than these.
REFRESH = 10
# Gains that agree to so many digits are equal: the order in which sums were added up must not decide. Then the
# first feature and the lowest bin count.
DIGITS = 9
LEAST_HESSIAN = 1e-3


@dataclass(frozen=True)
class BoostSpec:
    """Settings of a model. ``max_features`` is the share of features that each split may choose from.

    ``early_stop`` holds ``validation`` of the rows back from the fit and ends it when their loss has not
    improved by ``tolerance`` over ``patience`` trees.
    """

    loss: str = "squared"
    iterations: int = 100
    rate: float = 0.1
    max_leaves: int = 31
    max_depth: int | None = None
    min_leaf: int = 20
    l2: float = 0.0
    max_bins: int = 255
    max_features: float = 1.0
    seed: int = 42
    early_stop: bool = False
    validation: float = 0.1
    patience: int = 10
    tolerance: float = 1e-7


DEFAULT = BoostSpec()
RESTRICTED = BoostSpec("gamma", rate=0.05, max_leaves=10, max_depth=3, min_leaf=10, l2=1.0, max_features=0.8, validation=0.2)


def baseline(loss: str, mean: float) -> float:
    """Raw prediction before the first tree; that of the gamma loss is a logarithm."""
    if loss != "gamma":
        return mean
    if not mean > 0:
        raise ValueError("the gamma loss needs positive targets")
    return float(np.log(mean))


def slopes(loss: str, y: np.ndarray, raw: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First and second derivative of the loss (half the squared error, half the gamma deviance) by the raw prediction."""
    if loss == "gamma":
        ratio = y * np.exp(-raw)
        return 1 - ratio, ratio
    return raw - y, np.ones(len(y))


def losses(loss: str, y: np.ndarray, raw: np.ndarray) -> np.ndarray:
    return raw + y * np.exp(-raw) if loss == "gamma" else (y - raw) ** 2 / 2


def _link(loss: str, raw: np.ndarray) -> np.ndarray:
    return np.exp(raw) if loss == "gamma" else raw


def thresholds_of(column: np.ndarray, max_bins: int) -> np.ndarray:
    """Upper ends of the bins: midpoints of the distinct values, or of quantiles where there are too many."""
    values = np.unique(column)
    if len(values) <= max_bins:
        return (values[:-1] + values[1:]) / 2
    return np.unique(np.percentile(column, np.linspace(0, 100, max_bins + 1)[1:-1], method="midpoint"))


def binned(x: np.ndarray, thresholds: Sequence[np.ndarray]) -> np.ndarray:
    """Bin of each value; bin b holds the values up to threshold b."""
    out = np.empty(x.shape, np.int32)
    for f, ends in enumerate(thresholds):
        out[:, f] = np.searchsorted(ends, x[:, f], side="left")
    return out


@dataclass
class Tree:
    """Nodes in the order in which they were made: feature (-1: leaf), bin and threshold, children, value."""

    feature: list[int] = field(default_factory=list)
    bin: list[int] = field(default_factory=list)
    threshold: list[float] = field(default_factory=list)
    left: list[int] = field(default_factory=list)
    right: list[int] = field(default_factory=list)
    value: list[float] = field(default_factory=list)
    gain: list[float] = field(default_factory=list)

    def add(self, value: float) -> int:
        for column, x in zip((self.feature, self.bin, self.threshold, self.left, self.right, self.value, self.gain), (-1, -1, 0.0, -1, -1, value, 0.0)):
            column.append(x)
        return len(self.feature) - 1

    def leaves(self, x: np.ndarray, ends: Sequence) -> np.ndarray:
        """Node of every row of ``x``, whose columns are compared with ``ends`` (bins or thresholds)."""
        feature, ends, left, right = map(np.asarray, (self.feature, ends, self.left, self.right))
        node = np.zeros(len(x), np.int64)
        at = np.flatnonzero(feature[node] >= 0)
        while len(at):
            here = node[at]
            goes_left = x[at, feature[here]] <= ends[here]
            node[at] = np.where(goes_left, left[here], right[here])
            at = at[feature[node[at]] >= 0]
        return node

    def apply(self, x: np.ndarray, ends: Sequence) -> np.ndarray:
        return np.asarray(self.value)[self.leaves(x, ends)]


@dataclass
class _Leaf:
    """A leaf that may grow: its sums, its depth and its best split (gain, feature, bin, sums of the left side)."""

    node: int
    depth: int
    total: tuple[float, float, float]
    split: tuple[float, int, int, tuple[float, float, float]] | None = None


Sums = Callable[[Tree, list[int]], dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]]]


def _best(sums: tuple[np.ndarray, np.ndarray, np.ndarray], leaf: _Leaf, spec: BoostSpec, allowed: np.ndarray):
    """The best split of a leaf from its sums per (feature, bin), or None."""
    left = [np.cumsum(s, axis=1)[:, :-1] for s in sums]
    right = [t - s for t, s in zip(leaf.total, left)]
    (gl, hl, nl), (gr, hr, nr) = left, right
    score = leaf.total[0] ** 2 / (leaf.total[1] + spec.l2) if leaf.total[1] + spec.l2 > 0 else 0.0
    fits = (nl >= spec.min_leaf) & (nr >= spec.min_leaf) & (hl >= LEAST_HESSIAN) & (hr >= LEAST_HESSIAN) & allowed[:, None]
    if not fits.any():
        return None
    with np.errstate(divide="ignore", invalid="ignore"):
        gain = np.where(fits, gl**2 / (hl + spec.l2) + gr**2 / (hr + spec.l2) - score, -np.inf)
    top = gain.max()
    # what rounding leaves of no gain at all is none
    if not top > 1e-12 * max(score, 1e-300):
        return None
    # argmax takes the first of equal ones: the first feature, then the lowest bin
    f, b = divmod(int(np.argmax(np.round(gain / top, DIGITS) >= 1)), gain.shape[1])
    return float(gain[f, b]), f, b, (float(gl[f, b]), float(hl[f, b]), float(nl[f, b]))


def grow(spec: BoostSpec, number: int, thresholds: Sequence[np.ndarray], total: tuple[float, float, float], sums: Sums) -> Tree:
    """One tree. ``sums(tree, nodes)`` gives the sums per (feature, bin) of nodes that were made but not split yet.

    The next split is the one of largest gain among the leaves. So that rows are not read once a split, both
    children of every leaf that could be split next are summed in one round, and the tree grows as far as
    the splits it knows decide.
    """
    features = len(thresholds)
    drawn = max(1, int(spec.max_features * features))

    def value(t: tuple[float, float, float]) -> float:
        return -spec.rate * t[0] / (t[1] + spec.l2) if t[1] + spec.l2 > 0 else 0.0

    def choice(path: int) -> np.ndarray:
        if drawn == features:
            return np.ones(features, bool)
        rng = np.random.default_rng((spec.seed, number, path))
        return np.isin(np.arange(features), rng.choice(features, drawn, replace=False))

    # the tree of all splits known, of which the tree to be returned is a part
    known = Tree()
    leaves = {known.add(value(total)): _Leaf(0, 0, total)}
    paths = {0: 1}
    waiting = [0]
    while True:
        for node, s in (sums(known, waiting) if waiting else {}).items():
            leaf = leaves[node]
            leaf.split = _best(s, leaf, spec, choice(paths[node]))
        # open every known split, so that the children's sums come with the next round
        heap, order, n_leaves, missing = [], [], 1, []

        def push(node: int) -> None:
            if leaves[node].split is not None:
                heapq.heappush(heap, (-leaves[node].split[0], paths[node], node))

        push(0)
        while heap and n_leaves < spec.max_leaves:
            _, _, node = heapq.heappop(heap)
            leaf = leaves[node]
            order.append(node)
            n_leaves += 1
            if known.feature[node] < 0:
                _, f, b, left = leaf.split
                known.feature[node], known.bin[node], known.threshold[node] = f, b, float(thresholds[f][b])
                known.gain[node] = leaf.split[0]
                right = tuple(t - x for t, x in zip(leaf.total, left))
                for side, t in ((known.left, left), (known.right, right)):
                    side[node] = known.add(value(t))
                    paths[side[node]] = 2 * paths[node] + (side is known.right)
                    leaves[side[node]] = _Leaf(side[node], leaf.depth + 1, t)
                    deepest = spec.max_depth is not None and leaf.depth + 1 >= spec.max_depth
                    if not deepest and t[2] >= 2 * spec.min_leaf:
                        missing.append(side[node])
            if missing and (known.left[node] in missing or known.right[node] in missing):
                continue
            push(known.left[node])
            push(known.right[node])
        if not missing:
            return _pruned(known, set(order))
        waiting = missing


def _pruned(tree: Tree, split: set[int]) -> Tree:
    """``tree`` with just these nodes split."""
    out = Tree()
    todo = [(0, out.add(tree.value[0]))]
    for node, made in todo:
        if node not in split:
            continue
        for column in ("feature", "bin", "threshold", "gain"):
            getattr(out, column)[made] = getattr(tree, column)[node]
        out.left[made], out.right[made] = out.add(tree.value[tree.left[node]]), out.add(tree.value[tree.right[node]])
        todo += [(tree.left[node], out.left[made]), (tree.right[node], out.right[made])]
    return out


@dataclass
class BoostedTrees:
    """A fitted model: it keeps thresholds, so it scores values that were never binned."""

    spec: BoostSpec
    features: list[str]
    base: float
    trees: list[Tree]

    def raw(self, x: np.ndarray) -> np.ndarray:
        out = np.full(len(x), self.base)
        for tree in self.trees:
            out += tree.apply(x, tree.threshold)
        return out

    def predict_rows(self, x: np.ndarray) -> np.ndarray:
        return _link(self.spec.loss, self.raw(np.asarray(x, np.float64)))

    def predict(self, df: DataFrame) -> DataFrame:
        """``df`` with the prediction column ``yhat``."""
        columns = F.array(*[F.col(f"`{c}`").cast("double") for c in self.features])

        @F.pandas_udf("double")
        def scored(values: pd.Series) -> pd.Series:
            return pd.Series(self.predict_rows(np.stack(values.to_numpy())) if len(values) else np.zeros(0))

        return df.withColumn("yhat", scored(columns))

    def packed(self) -> str:
        return json.dumps({"kind": "boost", "spec": asdict(self.spec), "features": self.features, "base": self.base, "trees": [asdict(t) for t in self.trees]})

    @staticmethod
    def unpacked(text: str) -> BoostedTrees:
        held = json.loads(text)
        return BoostedTrees(BoostSpec(**held["spec"]), held["features"], held["base"], [Tree(**t) for t in held["trees"]])

    def save(self, df: DataFrame, path: str) -> None:
        """Write the model as a text file; ``df`` is any frame of the session."""
        df.sparkSession.createDataFrame([(self.packed(),)], "value string").coalesce(1).write.mode("overwrite").text(path)

    @staticmethod
    def load(df: DataFrame, path: str) -> BoostedTrees:
        return BoostedTrees.unpacked(df.sparkSession.read.text(path, wholetext=True).first()[0])

    def splits(self) -> list[tuple]:
        """``(tree, node, feature, threshold, gain, value)`` of all nodes; leaves have no feature."""
        return [
            (k, n, self.features[f] if f >= 0 else None, t if f >= 0 else None, g if f >= 0 else None, v)
            for k, tree in enumerate(self.trees)
            for n, (f, t, g, v) in enumerate(zip(tree.feature, tree.threshold, tree.gain, tree.value))
        ]


def _histogram(x: np.ndarray, node: np.ndarray, g: np.ndarray, h: np.ndarray, nodes: Sequence[int], bins: int):
    """Sums per (node, feature, bin) of the rows in ``nodes``: three arrays of that shape."""
    place = np.full(int(node.max(initial=0)) + 1 if len(node) else 1, -1)
    wanted = [n for n in nodes if n < len(place)]
    place[wanted] = [nodes.index(n) for n in wanted]
    at = np.flatnonzero(place[node] >= 0) if len(node) else np.zeros(0, np.int64)
    features = x.shape[1]
    cell = ((place[node[at]][:, None] * features + np.arange(features)) * bins + x[at]).ravel()
    size = len(nodes) * features * bins
    shape = (len(nodes), features, bins)
    return [np.bincount(cell, weights=np.repeat(w[at], features), minlength=size).reshape(shape) for w in (g, h, np.ones(len(node)))]


class _Stopper:
    """Whether the loss of the rows held back has stopped to improve."""

    def __init__(self, spec: BoostSpec):
        self.spec, self.seen = spec, []

    def done(self, loss: float) -> bool:
        self.seen.append(loss)
        if len(self.seen) <= self.spec.patience:
            return False
        best = self.seen[-self.spec.patience - 1]
        return not any(x < best - self.spec.tolerance for x in self.seen[-self.spec.patience :])


def held_back(key: np.ndarray, spec: BoostSpec) -> np.ndarray:
    """Rows that early stopping holds back, by a hash of their key."""
    return key % 10_000 < int(spec.validation * 10_000) if spec.early_stop else np.zeros(len(key), bool)


def fit_rows(x: np.ndarray, y: np.ndarray, features: Sequence[str], spec: BoostSpec, key: np.ndarray | None = None) -> BoostedTrees:
    """Fit on rows in memory; ``key`` decides which of them early stopping holds back."""
    x, y = np.asarray(x, np.float64), np.asarray(y, np.float64)
    back = held_back(np.arange(len(y)) * 7919 if key is None else key, spec)
    kept_x, kept_y = x[back], y[back]
    x, y = x[~back], y[~back]
    if spec.loss == "gamma" and (y <= 0).any():
        raise ValueError("the gamma loss needs positive targets")
    ends = [thresholds_of(x[:, f], spec.max_bins) for f in range(x.shape[1])]
    bins = max((len(e) for e in ends), default=0) + 1
    codes = binned(x, ends)
    model = BoostedTrees(spec, list(features), baseline(spec.loss, float(y.mean())), [])
    raw, stopper = np.full(len(y), model.base), _Stopper(spec)
    for number in range(spec.iterations):
        g, h = slopes(spec.loss, y, raw)

        def sums(tree: Tree, nodes: list[int]):
            made = _histogram(codes, tree.leaves(codes, tree.bin), g, h, nodes, bins)
            return {n: tuple(m[i] for m in made) for i, n in enumerate(nodes)}

        tree = grow(spec, number, ends, (float(g.sum()), float(h.sum()), float(len(y))), sums)
        model.trees.append(tree)
        raw += tree.apply(codes, tree.bin)
        if spec.early_stop and len(kept_y) and stopper.done(float(losses(spec.loss, kept_y, model.raw(kept_x)).mean())):
            break
    return model


def _quantiles(df: DataFrame, features: Sequence[str], spec: BoostSpec) -> list[np.ndarray]:
    """Bin ends of all features: of the distinct values where they are few, else of approximate quantiles over all rows."""
    columns = [f"`{c}`" for c in features]
    distinct = df.agg(*[F.approx_count_distinct(c).alias(f"n{i}") for i, c in enumerate(columns)]).first()
    few = [i for i in range(len(columns)) if distinct[i] <= 2 * spec.max_bins]
    out: list[np.ndarray] = [np.zeros(0)] * len(columns)
    if few:
        pairs = F.inline(F.array(*[F.struct(F.lit(i).alias("f"), F.col(columns[i]).cast("double").alias("v")) for i in few]))
        # at most a few times max_bins values a feature, by the count before
        values = df.select(pairs).distinct().toPandas()
        for i in few:
            out[i] = thresholds_of(values.v[values.f == i].to_numpy(), 1 << 31)
    many = [i for i in range(len(columns)) if i not in few or len(out[i]) >= spec.max_bins]
    if many:
        shares = np.linspace(0, 1, spec.max_bins + 1)[1:-1].tolist()
        found = df.agg(*[F.percentile_approx(F.col(columns[i]).cast("double"), shares, 10 * spec.max_bins).alias(f"q{i}") for i in many]).first()
        for i, ends in zip(many, found):
            out[i] = np.unique(np.array(ends or [], np.float64))
    return out


_CELLS = "node int, feature int, bin int, g double, h double, n double"


def fit(df: DataFrame, features: Sequence[str], spec: BoostSpec = DEFAULT, target: str = "y", key: Sequence[str] = ()) -> BoostedTrees:
    """Fit one model on all rows of ``df``, distributed over them.

    Rows are binned and written once. For every round of new nodes each task adds up its rows per (node, feature,
    bin), Spark adds up the tasks, and the driver gets those sums, whose number doesn't depend on the rows: at most
    leaves x features x bins. Tasks walk the rows through the trees since the last time predictions were
    written. With early stopping ``key`` names the columns by whose hash rows are held back.
    """
    features = list(features)
    if spec.early_stop and not key:
        raise ValueError("early stopping needs key columns to hold rows back by")
    y = F.col(target).cast("double")
    known = df.agg(F.avg(y).alias("mean"), F.min(y).alias("least"), F.count(y).alias("n")).first()
    if not known.n:
        raise ValueError("no rows to fit on")
    if spec.loss == "gamma" and known.least <= 0:
        raise ValueError("the gamma loss needs positive targets")
    ends = _quantiles(df, features, spec)
    bins = max((len(e) for e in ends), default=0) + 1
    wide = np.int16 if bins < 1 << 15 else np.int32
    model = BoostedTrees(spec, features, baseline(spec.loss, float(known.mean)), [])
    draw = F.pmod(F.xxhash64(F.lit(spec.seed), *key), F.lit(10_000)) if spec.early_stop else F.lit(10_000)
    values = F.array(*[F.col(f"`{c}`").cast("double") for c in features])

    def coded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = batch.column("x").values.to_numpy(zero_copy_only=False).reshape(len(batch), len(features))
            codes = binned(x, ends).astype(wide)
            rows = pa.array([r.tobytes() for r in codes], pa.binary())
            yield pa.RecordBatch.from_arrays([rows, batch.column("y"), batch.column("draw"), batch.column("raw")], names=["x", "y", "draw", "raw"])

    start = df.select(values.alias("x"), y.alias("y"), draw.cast("int").alias("draw"), F.lit(model.base).alias("raw")).filter("y IS NOT NULL")
    schema = "x binary, y double, draw int, raw double"
    rows = written(start.mapInArrow(coded, schema), "boost-rows")
    back = int(spec.validation * 10_000) if spec.early_stop else 0

    def opened(batch: pa.RecordBatch, trees: list[Tree]):
        x = np.frombuffer(b"".join(batch.column("x").to_pylist()), wide).reshape(len(batch), len(features)).astype(np.int64)
        raw = batch.column("raw").to_numpy().copy()
        for tree in trees:
            raw += tree.apply(x, tree.bin)
        return x, batch.column("y").to_numpy(), raw

    def advance(rows: DataFrame, trees: list[Tree]) -> DataFrame:
        def moved(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                raw = pa.array(opened(batch, trees)[2])
                yield pa.RecordBatch.from_arrays([batch.column("x"), batch.column("y"), batch.column("draw"), raw], names=["x", "y", "draw", "raw"])

        return written(rows.mapInArrow(moved, schema), "boost-rows")

    def cells(rows: DataFrame, trees: list[Tree], current: Tree, nodes: list[int]) -> pd.DataFrame:
        """Sums of all rows per (node, feature, bin); node -1 holds the totals, node -2 the loss of the rows held back."""

        def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            kept = None
            for batch in batches:
                x, y, raw = opened(batch, trees)
                out = batch.column("draw").to_numpy() < back
                g, h = slopes(spec.loss, y, raw)
                made = _histogram(x[~out], current.leaves(x[~out], current.bin), g[~out], h[~out], nodes, bins)
                sums = [*made, np.array([g[~out].sum(), h[~out].sum(), (~out).sum()]), np.array([losses(spec.loss, y[out], raw[out]).sum(), 0, out.sum()])]
                kept = sums if kept is None else [a + b for a, b in zip(kept, sums)]
            if kept is None:
                return
            at = np.nonzero(kept[2])
            columns = [np.array(nodes)[at[0]], at[1], at[2], *[k[at] for k in kept[:3]]]
            for node, extra in ((-1, kept[3]), (-2, kept[4])):
                columns = [np.append(c, v) for c, v in zip(columns, (node, 0, 0, *extra))]
            types = [pa.int32()] * 3 + [pa.float64()] * 3
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names=["node", "feature", "bin", "g", "h", "n"])

        found = rows.mapInArrow(partial, _CELLS).groupBy("node", "feature", "bin").agg(*[F.sum(c).alias(c) for c in ("g", "h", "n")])
        return found.toPandas()

    recent: list[Tree] = []
    stopper = _Stopper(spec)
    for number in range(spec.iterations):
        root = cells(rows, recent, Tree([-1], [-1], [0.0], [-1], [-1], [0.0], [0.0]), [0])
        loss = root[root.node == -2].iloc[0]
        if spec.early_stop and number and loss.n and stopper.done(loss.g / loss.n):
            break

        def arrays(found: pd.DataFrame, nodes: list[int]):
            out = {}
            for node in nodes:
                mine = found[found.node == node]
                made = [np.zeros((len(features), bins)) for _ in range(3)]
                for array, column in zip(made, ("g", "h", "n")):
                    array[mine.feature.to_numpy(), mine.bin.to_numpy()] = mine[column].to_numpy()
                out[node] = tuple(made)
            return out

        def sums(tree: Tree, nodes: list[int]):
            return arrays(root if nodes == [0] else cells(rows, recent, tree, nodes), nodes)

        total = root[root.node == -1].iloc[0]
        tree = grow(spec, number, ends, (float(total.g), float(total.h), float(total.n)), sums)
        model.trees.append(tree)
        recent.append(tree)
        if len(recent) >= REFRESH and number + 1 < spec.iterations:
            rows, recent = advance(rows, recent), []
    return model


def with_settings(kind: BoostSpec, **settings) -> BoostSpec:
    return replace(kind, **settings)
