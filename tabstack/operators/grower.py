"""Trees grown level by level from histograms that Spark adds up.

``pyspark.ml`` trees know no sign constraints, no random cut points and no
quantile leaves.  This grower does, for several trees (fold models, a forest)
over one table at a time:

* Features are binned once (``Binner``): up to ``bins`` cut points a feature
  from approximate quantiles, bin 0 for missing values.  A row then carries its
  bins as bytes; the raw columns are not read again.
* A level is one job for all trees: tasks add up, for every open node, feature
  and bin, the statistics of their rows (NumPy ``bincount`` over Arrow batches);
  one aggregate merges them by cell; one group per node (at most features x
  bins rows, whatever the table's size) picks the split.  The driver receives
  one row per open node.  A task keeps trees x nodes x features x bins numbers.
* Statistics are whole multiples of a small unit, so sums do not depend on the
  order or number of tasks, and a tree is the same on any cluster.
* Splits come from a ``splitter``: the best cut under sign constraints
  (``BestCut``), or a random cut inside the node's range (``RandomCut``).
* Boosting keeps the running predictions as a column that each round adds one
  tree to, persisted in turn; every CUT_EVERY rounds the lineage is cut.

Rows never move between tasks and no group of rows is collected, so a hot
value or class costs nothing extra.

Null or NaN features go to bin 0, the lowest; rows with a null or NaN target
teach nothing and are scored all the same.  Without any row to learn from a
tree is one leaf of value 0.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabstack.session import cut_lineage

MAX_BINS = 256
CUT_EVERY = 10          # boosting rounds after which the running predictions are checkpointed
UNIT_BITS = 20          # statistics are multiples of 2^-20 of their scale


# ------------------------------------------------------------------- binning

@dataclass(frozen=True)
class Binner:
    """Sorted cut points of each feature; bin k holds values in (cut[k-2], cut[k-1]], bin 0 missing ones."""
    features: tuple[str, ...]
    cuts: tuple[tuple[float, ...], ...]

    def __post_init__(self):
        if self.n_bins > MAX_BINS:
            raise ValueError(f"at most {MAX_BINS - 2} cut points a feature")

    @property
    def n_bins(self) -> int:
        return max((len(c) for c in self.cuts), default=0) + 2

    def codes(self, values: np.ndarray) -> np.ndarray:
        """Rows x features of doubles -> bins (NaN: 0)."""
        out = np.zeros(values.shape, np.uint8)
        for j, cuts in enumerate(self.cuts):
            known = ~np.isnan(values[:, j])
            out[known, j] = np.searchsorted(np.array(cuts), values[known, j], side="left") + 1
        return out

    def apply(self, df: DataFrame, keep: Sequence[str]) -> DataFrame:
        """``keep`` and ``bins`` (a byte a feature)."""
        vector = F.array(*[F.coalesce(F.col(c).cast("double"), F.lit(float("nan"))) for c in self.features])
        src = df.select(*keep, vector.alias("bins"))
        width = len(self.features)

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in batches:
                values = b.column(len(keep)).flatten().to_numpy(zero_copy_only=False).reshape(-1, width)
                yield pa.RecordBatch.from_arrays([*b.columns[: len(keep)], _bytes(self.codes(values))], names=[*keep, "bins"])

        return src.mapInArrow(run, _schema(src, keep) + "bins binary")


def _schema(df: DataFrame, names: Sequence[str]) -> str:
    return "".join(f"`{n}` {df.schema[n].dataType.simpleString()}, " for n in names)


def _bytes(matrix: np.ndarray) -> pa.Array:
    """Rows of a matrix as binary values."""
    raw = np.ascontiguousarray(matrix)
    size = raw.shape[1] * raw.itemsize
    offsets = np.arange(len(raw) + 1, dtype=np.int32) * np.int32(size)
    return pa.Array.from_buffers(pa.binary(), len(raw), [None, pa.py_buffer(offsets), pa.py_buffer(raw.tobytes())])


def _matrix(column: pa.Array, kind=np.uint8) -> np.ndarray:
    """Binary values of equal size as rows of a matrix."""
    if not len(column):
        return np.zeros((0, 1), kind)
    at = np.frombuffer(column.buffers()[1], np.int32)[column.offset: column.offset + len(column) + 1]
    return np.frombuffer(column.buffers()[2], np.uint8)[at[0]: at[-1]].view(kind).reshape(len(column), -1)


def _known(column: str) -> Column:
    return F.when(~F.isnan(F.col(column).cast("double")), F.col(column).cast("double"))


def fit_binner(df: DataFrame, features: Sequence[str], bins: int = 64, accuracy: int = 10_000) -> Binner:
    """Cut points from one aggregate of approximate quantiles (``accuracy`` as in ``percentile_approx``).

    A feature's largest value is no cut: nothing would lie above it."""
    probs = [k / bins for k in range(1, bins)]
    row = df.agg(*[F.percentile_approx(_known(c), probs, accuracy).alias(f"q{j}") for j, c in enumerate(features)],
                 *[F.max(_known(c)).alias(f"x{j}") for j, c in enumerate(features)]).first()
    return Binner(tuple(features), tuple(tuple(sorted({float(v) for v in row[f"q{j}"] or [] if v < row[f"x{j}"]})) for j in range(len(features))))


# --------------------------------------------------------------------- trees

@dataclass
class Tree:
    """Nodes in the order of their making; ``feature`` -1: a leaf.  A row goes left where its bin is at most ``cut``."""
    feature: list[int] = field(default_factory=lambda: [-1])
    cut: list[int] = field(default_factory=lambda: [0])
    left: list[int] = field(default_factory=lambda: [0])
    right: list[int] = field(default_factory=lambda: [0])
    value: list = field(default_factory=lambda: [0.0])
    low: list[float] = field(default_factory=lambda: [-np.inf])
    high: list[float] = field(default_factory=lambda: [np.inf])

    def split(self, node: int, feature: int, cut: int) -> tuple[int, int]:
        self.feature[node], self.cut[node] = feature, cut
        for side in (self.left, self.right):
            side[node] = len(self.feature)
            for column, x in ((self.feature, -1), (self.cut, 0), (self.left, 0), (self.right, 0), (self.value, self.value[node]),
                              (self.low, self.low[node]), (self.high, self.high[node])):
                column.append(x)
        return self.left[node], self.right[node]

    def leaves(self, bins: np.ndarray) -> np.ndarray:
        """The node that each row of ``bins`` ends in."""
        feature, cut, left, right = map(np.array, (self.feature, self.cut, self.left, self.right))
        at, rows = np.zeros(len(bins), np.int64), np.arange(len(bins))
        while True:
            go = feature[at] >= 0
            if not go.any():
                return at
            here = at[go]
            at[go] = np.where(bins[rows[go], feature[here]] <= cut[here], left[here], right[here])

    def predict(self, bins: np.ndarray) -> np.ndarray:
        return np.array(self.value)[self.leaves(bins)]


# ------------------------------------------------------------------ splitters

@dataclass(frozen=True)
class BestCut:
    """The cut of highest gain in squared gradients over Hessians (stats: gradient, Hessian), under sign constraints.

    ``signs`` (+1 rising, -1 falling, 0 free) by feature.  A cut of a
    constrained feature whose children's values are in the wrong order is not
    taken; the children of one that is are bounded by the middle of their
    values, and every value stays within its node's bounds.  So the tree is
    monotone along each constrained feature."""
    min_hessian: float = 5.0
    reg: float = 1.0
    min_gain: float = 1e-9
    signs: tuple[int, ...] = ()

    def value(self, stats: np.ndarray, low: float, high: float) -> np.ndarray:
        with np.errstate(divide="ignore", invalid="ignore"):
            return np.clip(np.nan_to_num(-stats[..., 0] / (stats[..., 1] + self.reg)), low, high)

    def _fit(self, stats: np.ndarray, v: np.ndarray) -> np.ndarray:
        return -(stats[..., 0] * v + 0.5 * (stats[..., 1] + self.reg) * v * v)

    def choose(self, sums: np.ndarray, low: float, high: float, rng: np.random.Generator) -> tuple[int, int] | None:
        total = sums[0].sum(axis=0)
        left = np.cumsum(sums, axis=1)[:, :-1]
        right = total - left
        a, b = self.value(left, low, high), self.value(right, low, high)
        gain = self._fit(left, a) + self._fit(right, b) - self._fit(total, self.value(total, low, high))
        gain = np.where((left[..., 1] >= self.min_hessian) & (right[..., 1] >= self.min_hessian), gain, -np.inf)
        for f, sign in enumerate(self.signs):
            if sign:
                gain[f] = np.where(sign * (b[f] - a[f]) >= 0, gain[f], -np.inf)
        f, c = np.unravel_index(int(np.argmax(gain)), gain.shape)
        return (int(f), int(c)) if gain[f, c] > self.min_gain else None


@dataclass(frozen=True)
class RandomCut:
    """Extremely randomised trees: for ``tries`` features that vary in the node, one cut drawn evenly between its
    lowest and highest bin; of those the one that takes away most variance (Gini impurity for class stats).

    Stats: weight, then the target's sum, or the weight of each class.  A leaf's value is their mean (shares)."""
    tries: int
    min_weight: float = 2.0
    classes: int = 0
    signs: tuple[int, ...] = ()

    def value(self, stats: np.ndarray, low: float, high: float):
        mean = stats[1:] / max(float(stats[0]), 1e-300)
        return mean.tolist() if self.classes else float(mean[0])

    def impurity(self, stats: np.ndarray) -> float:
        """Weight times impurity, up to a term that no split changes."""
        return -float((stats[1:] ** 2).sum() / max(float(stats[0]), 1e-300))

    def choose(self, sums: np.ndarray, low: float, high: float, rng: np.random.Generator) -> tuple[int, int] | None:
        total = sums[0].sum(axis=0)
        if total[0] < self.min_weight:
            return None
        best, tried = None, 0
        for f in rng.permutation(len(sums)).tolist():
            there = np.flatnonzero(sums[f, :, 0] > 0)
            if len(there) < 2 or tried == self.tries:
                continue
            tried += 1
            cut = int(rng.integers(there[0], there[-1]))
            left = sums[f, : cut + 1].sum(axis=0)
            gain = self.impurity(total) - self.impurity(left) - self.impurity(total - left)
            if best is None or gain > best[0]:
                best = (gain, f, cut)
        return best[1:] if best and best[0] > 1e-9 else None


# -------------------------------------------------------------------- growing

Stats = Callable[[dict[str, np.ndarray], int], tuple[np.ndarray, np.ndarray]]


def _level(binned: DataFrame, trees: Sequence[Tree], opened: Sequence[Sequence[int]], width: int, n_bins: int, splitter,
           columns: Sequence[str], stats: Stats, n_stats: int, units: np.ndarray, seed: int) -> dict[tuple[int, int], tuple]:
    """(tree, node) -> (feature or -1, cut, stats of the left and of the right part) of every open node that rows reach."""
    names = [f"s{k}" for k in range(n_stats)]
    cells = width * n_bins
    place = [np.full(len(tree.feature), -1) for tree in trees]
    for p, nodes in zip(place, opened):
        p[list(nodes)] = np.arange(len(nodes))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = [np.zeros((n_stats, len(nodes) * cells)) for nodes in opened]
        for b in batches:
            got = {c: _matrix(b.column(c), np.float64) if c == "state" else b.column(c).to_numpy(zero_copy_only=False) for c in columns}
            bins = _matrix(b.column("bins"))
            for t, tree in enumerate(trees):
                if not len(opened[t]):
                    continue
                values, weight = stats(got, t)
                node = place[t][tree.leaves(bins)]
                rows = np.flatnonzero((node >= 0) & (weight > 0))
                whole = np.rint(values[rows] / units) * weight[rows, None]
                for f in range(width):
                    cell = (node[rows] * width + f) * n_bins + bins[rows, f]
                    for k in range(n_stats):
                        total[t][k] += np.bincount(cell, whole[:, k], minlength=total[t].shape[1])
        for t, sums in enumerate(total):
            there = np.flatnonzero(sums.any(axis=0))
            if len(there):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(there), t, np.int32)), pa.array(np.array(opened[t], np.int32)[there // cells]),
                     pa.array((there % cells).astype(np.int32)), *[pa.array(s[there].astype(np.int64)) for s in sums]],
                    names=["tree", "node", "cell", *names])

    bounds = {(t, n): (tree.low[n], tree.high[n]) for t, tree in enumerate(trees) for n in opened[t]}

    def pick(key, rows):
        sums = np.zeros((cells, n_stats))
        sums[rows["cell"].to_numpy()] = rows[names].to_numpy()
        sums = sums.reshape(width, n_bins, n_stats) * units
        found = splitter.choose(sums, *bounds[key], np.random.default_rng([seed, *map(int, key)]))
        f, cut = found or (-1, 0)
        left = sums[max(f, 0), : cut + 1].sum(axis=0)
        return pd.DataFrame({"tree": [key[0]], "node": [key[1]], "feature": [f], "cut": [cut], "left": [left.tolist()],
                             "right": [(sums[max(f, 0)].sum(axis=0) - left).tolist()]})

    merged = (binned.select("bins", *columns).mapInArrow(run, "tree int, node int, cell int, " + ", ".join(f"{n} bigint" for n in names))
              .groupBy("tree", "node", "cell").agg(*[F.sum(n).alias(n) for n in names]))
    picked = merged.groupBy("tree", "node").applyInPandas(pick, "tree int, node int, feature int, cut int, left array<double>, right array<double>")
    return {(r.tree, r.node): (r.feature, r.cut, np.array(r.left), np.array(r.right)) for r in picked.collect()}   # a row a node


def grow(binned: DataFrame, n_trees: int, depth: int, width: int, n_bins: int, splitter, columns: Sequence[str], stats: Stats, n_stats: int,
         units: np.ndarray, seed: int = 0) -> list[Tree]:
    """``n_trees`` trees side by side, a job per level.

    ``stats(columns, tree)`` gives rows x n_stats and the rows' weights
    (whole numbers; 0: the row does not teach this tree)."""
    trees, opened = [Tree() for _ in range(n_trees)], [[0] for _ in range(n_trees)]
    for _ in range(depth):
        found = _level(binned, trees, opened, width, n_bins, splitter, columns, stats, n_stats, units, seed) if any(opened) else {}
        opened = [[] for _ in range(n_trees)]
        for (t, node), (f, cut, left, right) in sorted(found.items()):
            tree = trees[t]
            low, high = tree.low[node], tree.high[node]
            tree.value[node] = splitter.value(left + right, low, high)
            if f < 0:
                continue
            a, b = tree.split(node, f, cut)
            sign = splitter.signs[f] if splitter.signs else 0
            if sign:
                middle = float(splitter.value(left, low, high) + splitter.value(right, low, high)) / 2
                under, over = (a, b) if sign > 0 else (b, a)
                tree.high[under], tree.low[over] = middle, middle
            tree.value[a], tree.value[b] = splitter.value(left, tree.low[a], tree.high[a]), splitter.value(right, tree.low[b], tree.high[b])
            opened[t] += [a, b]
    return trees


# ------------------------------------------------------------------ ensembles

@dataclass
class Ensemble:
    """Trees whose values are added to ``base`` (boosting), or averaged where ``mean``; ``classes``: a share for each."""
    binner: Binner
    trees: list[Tree]
    base: float = 0.0
    rate: float = 1.0
    mean: bool = False
    classes: int = 0

    def score(self, bins: np.ndarray) -> np.ndarray:
        total = np.zeros((len(bins), self.classes) if self.classes else len(bins))
        for t in self.trees:
            if self.classes and not isinstance(t.value[0], list):
                continue                # nothing was learned
            total += t.predict(bins)
        return total / max(1, len(self.trees)) if self.mean else self.base + self.rate * total


def score_with(df: DataFrame, models: dict[str, Ensemble], keep: Sequence[str]) -> DataFrame:
    """``keep`` and a column of predictions for each model (which share a binner), in one pass."""
    models = dict(models)
    binner = next(iter(models.values())).binner
    src = binner.apply(df, keep)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            bins = _matrix(b.column("bins"))
            scored = [m.score(bins) for m in models.values()]
            yield pa.RecordBatch.from_arrays([*[b.column(c) for c in keep], *[pa.array(list(s) if s.ndim == 2 else s) for s in scored]],
                                             names=[*keep, *models])

    kinds = ", ".join(f"`{n}` {'array<double>' if m.classes else 'double'}" for n, m in models.items())
    return src.mapInArrow(run, _schema(src, keep) + kinds)


def _learning(df: DataFrame, binner: Binner, label: str, fold: str | None, extra: Sequence[Column] = ()) -> DataFrame:
    """``y, fold, .., bins`` of the rows with a target."""
    src = df.where(_known(label).isNotNull()).withColumn("_y", _known(label)).withColumn("_fold", F.coalesce(F.col(fold).cast("int"), F.lit(-1)) if fold else F.lit(-1))
    src = src.select(*binner.features, F.col("_y").alias("y"), F.col("_fold").alias("fold"), *extra)
    return binner.apply(src, ["y", "fold", *src.columns[len(binner.features) + 2:]])


@dataclass(frozen=True)
class Squared:
    """Squared error: gradient prediction - target, Hessian 1."""

    def start(self, y: Column) -> Column:
        return F.avg(y)

    def __call__(self, y: np.ndarray, p: np.ndarray) -> np.ndarray:
        return np.stack([p - y, np.ones(len(y))], axis=1)


@dataclass(frozen=True)
class Pinball:
    """Pinball loss of quantile ``q``: gradient 1 - q above the target and -q below, smoothed linearly over
    ``width`` around it.  Its slope there is the Hessian, so a leaf's step is its error of coverage over its
    density; rows further away have a tenth of it, which bounds steps where no target is near."""
    q: float
    width: float

    def start(self, y: Column) -> Column:
        return F.percentile_approx(y, self.q, 10_000)

    def __call__(self, y: np.ndarray, p: np.ndarray) -> np.ndarray:
        r = (p - y) / self.width
        gradient = np.clip(0.5 - self.q + r, -self.q, 1 - self.q)
        return np.stack([gradient, np.where(np.abs(r) <= 0.5, 1.0, 0.1) / self.width], axis=1)


def boost(df: DataFrame, features: Sequence[str], label: str, losses: Sequence, *, rounds: int = 30, depth: int = 3, rate: float = 0.2, bins: int = 64,
          splitter: BestCut | None = None, fold: str | None = None, folds: Sequence[int] = (-1,), binner: Binner | None = None, seed: int = 0) -> dict[tuple[int, int], Ensemble]:
    """(fold, place of the loss) -> boosted trees, all grown side by side.

    The models of fold k learn from the rows whose ``fold`` isn't k (rows
    without a fold teach every model; filter them before if they shouldn't)."""
    splitter, binner = splitter or BestCut(), binner or fit_binner(df, features, bins)
    width = len(binner.features)
    keys = [(k, j) for k in folds for j in range(len(losses))]
    y = _known(label)
    own = [F.when(F.coalesce(F.col(fold).cast("int"), F.lit(-1)) != k, y) if fold else y for k, _ in keys]
    row = df.agg(*[losses[j].start(c).alias(f"b{i}") for i, ((_, j), c) in enumerate(zip(keys, own))], F.stddev_pop(y).alias("spread")).first()
    models = {key: Ensemble(binner, [], float(row[f"b{i}"] or 0.0), rate) for i, key in enumerate(keys)}
    scale = 2.0 ** np.ceil(np.log2(max(float(row["spread"] or 0.0), 1e-6)))
    units = np.array([max(1.0, scale), 1.0]) / (1 << UNIT_BITS)

    def add(batches: Iterator[pa.RecordBatch], trees: list[Tree] | None) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if trees is None:
                state = np.tile([m.base for m in models.values()], (b.num_rows, 1))
            else:
                bins = _matrix(b.column("bins"))
                state = _matrix(b.column("state"), np.float64) + rate * np.stack([t.predict(bins) for t in trees], axis=1)
            yield pa.RecordBatch.from_arrays([b.column("y"), b.column("fold"), b.column("bins"), _bytes(state)], names=["y", "fold", "bins", "state"])

    def stats(got: dict[str, np.ndarray], t: int) -> tuple[np.ndarray, np.ndarray]:
        k, j = keys[t]
        return losses[j](got["y"], got["state"][:, t]), (got["fold"] != k).astype(np.int64) if fold else np.ones(len(got["y"]), np.int64)

    def stepped(d: DataFrame, trees: list[Tree] | None) -> DataFrame:
        return d.mapInArrow(lambda batches: add(batches, trees), "y double, fold int, bins binary, state binary").persist(StorageLevel.MEMORY_AND_DISK)

    now, before = stepped(_learning(df, binner, label, fold), None), None
    for r in range(rounds):
        trees = grow(now, len(keys), depth, width, binner.n_bins, splitter, ["y", "fold", "state"], stats, 2, units, seed + r)
        for m, tree in zip(models.values(), trees):
            m.trees.append(tree)
        if before is not None:
            before.unpersist()
        if r + 1 < rounds:
            now, before = stepped(now, trees), now
            if (r + 1) % CUT_EVERY == 0:
                now, done = cut_lineage(now), now
                done.unpersist()
    now.unpersist()
    return models


def extra_trees(df: DataFrame, features: Sequence[str], label: str, *, trees: int = 20, depth: int = 6, classes: int = 0, tries: int | None = None,
                bins: int = 64, fold: str | None = None, folds: Sequence[int] = (-1,), binner: Binner | None = None, seed: int = 42) -> dict[int, Ensemble]:
    """Fold -> extremely randomised trees (no bootstrap); with ``classes`` the label is 0 .. classes - 1 and the prediction their shares."""
    binner = binner or fit_binner(df, features, bins)
    width = len(binner.features)
    splitter = RandomCut(tries or max(1, round(width ** 0.5 if classes else width / 3)), classes=classes)
    spread = 1.0 if classes else 2.0 ** np.ceil(np.log2(max(float(df.agg(F.max(F.abs(_known(label)))).first()[0] or 0.0), 1e-6)))
    units = np.array([1.0, *([1.0] * classes if classes else [spread / (1 << UNIT_BITS)])])

    def stats(got: dict[str, np.ndarray], t: int) -> tuple[np.ndarray, np.ndarray]:
        y = got["y"]
        value = (y[:, None] == np.arange(classes)).astype(float) if classes else y[:, None]
        weight = (got["fold"] != folds[t // trees]).astype(np.int64) if fold else np.ones(len(y), np.int64)
        return np.concatenate([np.ones((len(y), 1)), value], axis=1), weight

    d = _learning(df, binner, label, fold).persist(StorageLevel.MEMORY_AND_DISK)
    grown = grow(d, trees * len(folds), depth, width, binner.n_bins, splitter, ["y", "fold"], stats, len(units), units, seed)
    d.unpersist()
    return {k: Ensemble(binner, grown[i * trees: (i + 1) * trees], mean=True, classes=classes) for i, k in enumerate(folds)}


def out_of_fold(df: DataFrame, models: dict[int, Ensemble], key: str, fold: str, out: str = "pred") -> DataFrame:
    """``key, fold, out``: rows of fold k by the model that did not see it, rows without a fold by the mean of all."""
    scored = score_with(df, {f"_m{k}": m for k, m in models.items()}, [key, fold])
    classes = next(iter(models.values())).classes
    columns = [F.col(f"_m{k}") for k in models]
    if classes:
        mean = F.array(*[sum((c[j] for c in columns[1:]), columns[0][j]) / len(columns) for j in range(classes)])
    else:
        mean = sum(columns[1:], columns[0]) / len(columns)
    own = F.coalesce(*[F.when(F.col(fold) == k, F.col(f"_m{k}")) for k in models])
    return scored.select(key, fold, F.when(F.col(fold).isNull(), mean).otherwise(own).alias(out))
