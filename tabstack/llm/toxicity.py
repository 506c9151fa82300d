"""Counterfactually regularised toxicity classifier (operator 5).

Logistic regression on the presence of words.  Besides the log loss, training
penalises the squared change of the logit when the identity terms of a text
are swapped for others of their group, so that a neutral mention of a group
does not raise the score.

Training rows may be a sample: at most about ``sample_per_class`` labelled rows
of each class, chosen by a hash of the id, with weights that restore the class
balance.  The vocabulary is the ``vocabulary`` words that tell the classes
apart best among the sampled rows.  So the fit has a fixed size bound and runs
on the driver; scoring is one narrow pass over all rows.

Edge cases: null or empty text scores by the intercept alone; null labels do
not train; of several labels of one id the largest counts.  Without labelled
rows of both classes every score is the share of label 1 (0 if none).  Rows
are independent, so repeated rows give repeated results; an empty table gives
an empty result.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabstack.llm.common import map_batches

SAMPLE_PER_CLASS = 10_000
VOCABULARY = 4096
MIN_DF = 4
SWAP_WEIGHT = 1.0
L2 = 2e-4
STEPS = 150

#: Groups of identity terms that may stand for one another.
IDENTITY_GROUPS = (
    ("women", "men"), ("woman", "man"), ("girls", "boys"), ("girl", "boy"), ("female", "male"),
    ("christians", "muslims", "jews", "hindus", "buddhists", "atheists"),
    ("christian", "muslim", "jewish", "hindu", "buddhist", "atheist"),
    ("gay", "straight", "lesbian", "bisexual", "transgender"),
    ("black", "white", "asian", "latino", "african", "european", "american", "arab"),
    ("blind", "deaf", "disabled"), ("young", "old", "elderly"), ("immigrants", "natives", "refugees"),
    ("frauen", "männer"), ("christen", "muslime", "juden"), ("femmes", "hommes"), ("chrétiens", "musulmans", "juifs"),
    ("mujeres", "hombres"), ("cristianos", "musulmanes", "judíos"),
)
_WORD = re.compile(r"[^\W\d_]+")


def words(text: str | None) -> set[str]:
    return set(_WORD.findall(text.lower())) if text else set()


def swap_table(groups=IDENTITY_GROUPS) -> dict[str, tuple[str, ...]]:
    """Each identity term and the others of its group."""
    return {t: g[i + 1:] + g[:i] for g in groups for i, t in enumerate(g)}


def swapped(found: set[str], table: dict[str, tuple[str, ...]], salt: int) -> set[str]:
    """``found`` with each identity term replaced by another one that ``salt`` picks."""
    out = set(found)
    for t in found & table.keys():
        out.discard(t)
    for t in found & table.keys():
        out.add(table[t][salt % len(table[t])])
    return out


@dataclass
class Model:
    weights: dict[str, float] = field(default_factory=dict)
    intercept: float = 0.0

    def score(self, text: str | None) -> float:
        w = self.weights
        z = self.intercept + sum(w[t] for t in words(text) & w.keys())
        return float(1.0 / (1.0 + np.exp(-np.clip(z, -30, 30))))


def _csr(lists: list[list[int]]) -> tuple[np.ndarray, np.ndarray]:
    """Row number and column of every entry."""
    sizes = [len(x) for x in lists]
    return np.repeat(np.arange(len(lists)), sizes), np.fromiter((j for x in lists for j in x), np.int64, sum(sizes))


def fit_logistic(plain: list[list[int]], other: list[list[int]], y: np.ndarray, weight: np.ndarray, size: int,
                 swap_weight: float = SWAP_WEIGHT, l2: float = L2, steps: int = STEPS) -> tuple[np.ndarray, float]:
    """Weights and intercept by Adam on log loss + swap penalty + L2.

    ``plain`` and ``other`` list each row's features before and after the swap.
    """
    r1, c1 = _csr(plain)
    gone = [sorted(set(a) - set(b)) for a, b in zip(plain, other)]
    come = [sorted(set(b) - set(a)) for a, b in zip(plain, other)]
    rg, cg = _csr(gone)
    rc, cc = _csr(come)
    moved = max(1, len(set(rg.tolist()) | set(rc.tolist())))
    share = weight / weight.sum()
    base = float(share @ y)
    w, b = np.zeros(size), float(np.log(base / (1 - base)))
    m, v, mb, vb = np.zeros(size), np.zeros(size), 0.0, 0.0
    n = len(y)
    for t in range(1, steps + 1):
        z = np.bincount(r1, w[c1], minlength=n) + b
        err = share * (1 / (1 + np.exp(-np.clip(z, -30, 30))) - y)
        g = np.bincount(c1, err[r1], minlength=size) + 2 * l2 * w
        diff = np.bincount(rg, w[cg], minlength=n) - np.bincount(rc, w[cc], minlength=n)
        pull = 2 * swap_weight / moved * diff
        g += np.bincount(cg, pull[rg], minlength=size) - np.bincount(cc, pull[rc], minlength=size)
        gb = err.sum()
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        mb, vb = 0.9 * mb + 0.1 * gb, 0.999 * vb + 0.001 * gb * gb
        rate, c1t, c2t = 0.1, 1 - 0.9 ** t, 1 - 0.999 ** t
        w = w - rate * (m / c1t) / (np.sqrt(v / c2t) + 1e-8)
        b = b - rate * (mb / c1t) / (np.sqrt(vb / c2t) + 1e-8)
    return w, b


def fit(docs: DataFrame, labels: DataFrame, train: Column, id_col: str = "doc_id", text_col: str = "text",
        label_col: str = "toxic", sample_per_class: int = SAMPLE_PER_CLASS, vocabulary: int = VOCABULARY,
        groups=IDENTITY_GROUPS) -> Model:
    """Fit on the labelled rows whose id satisfies ``train`` (a condition on ``id_col``)."""
    known = (labels.filter(train & F.col(label_col).isin(0, 1))
             .groupBy(F.col(id_col).alias("id")).agg(F.max(label_col).cast("int").alias("y")))
    sizes = {r.y: r.n for r in known.groupBy("y").agg(F.count(F.lit(1)).alias("n")).collect()}
    if not sizes.get(0) or not sizes.get(1):
        return Model({}, 30.0 if sizes.get(1) else -30.0)
    part = {y: min(1.0, sample_per_class / n) for y, n in sizes.items()}
    place = F.pmod(F.xxhash64(F.col("id").cast("string")), F.lit(1 << 20)) / F.lit(float(1 << 20))
    chosen = known.filter(place < F.when(F.col("y") == 1, part[1]).otherwise(part[0]))
    # at most about 2 x sample_per_class rows of (id, y)
    texts = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).join(F.broadcast(chosen), "id").select("id", "y", "text")
    table = swap_table(groups)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = Counter(), Counter()
        for b in batches:
            for y, text in zip(b.column(1).to_pylist(), b.column(2)):
                seen[y].update(words(text.as_py()))
        names = list(seen[0].keys() | seen[1].keys())
        for at in range(0, len(names), 50_000):
            some = names[at: at + 50_000]
            yield pa.RecordBatch.from_arrays([pa.array(some, pa.string()), pa.array([seen[0][t] for t in some], pa.int64()),
                                              pa.array([seen[1][t] for t in some], pa.int64())], names=["word", "n0", "n1"])

    t0, t1 = sizes[0] * part[0], sizes[1] * part[1]
    p0, p1 = (F.col("n0") + 0.5) / (t0 + 1), (F.col("n1") + 0.5) / (t1 + 1)
    odds = F.log(p1) - F.log(p0)
    contrast = F.abs(odds) / F.sqrt(1 / (F.col("n0") + 0.5) + 1 / (F.col("n1") + 0.5))
    best = (map_batches(texts, count, "word string, n0 bigint, n1 bigint").groupBy("word")
            .agg(F.sum("n0").alias("n0"), F.sum("n1").alias("n1"))
            .filter((F.col("n0") + F.col("n1") >= MIN_DF) | F.col("word").isin(*table))
            .orderBy(F.col("word").isin(*table).desc(), contrast.desc(), "word").limit(vocabulary).collect())
    index = {r.word: j for j, r in enumerate(best)}
    for t in table:
        index.setdefault(t, len(index))

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            plain, other = [], []
            for key, text in zip(b.column(0).to_pylist(), b.column(2)):
                found = words(text.as_py())
                changed = swapped(found & table.keys(), table, zlib.crc32(str(key).encode()))
                plain.append(sorted(index[t] for t in found & index.keys()))
                other.append(sorted(index[t] for t in ((found - table.keys()) | changed) & index.keys()))
            kind = pa.list_(pa.int32())
            yield pa.RecordBatch.from_arrays([b.column(1), pa.array(plain, kind), pa.array(other, kind)], names=["y", "plain", "other"])

    rows = map_batches(texts, encode, "y int, plain array<int>, other array<int>").toPandas()
    # a fixed order: the sums of the fit do not depend on task order
    rows = rows.assign(key=[zlib.crc32(np.asarray(x, np.int32).tobytes()) for x in rows["plain"]]).sort_values(["key", "y"], kind="stable")
    y = rows["y"].to_numpy(np.float64)
    if not 0 < y.sum() < len(y):
        return Model({}, 30.0 if y.sum() else -30.0)
    weight = np.where(y == 1, 1 / part[1], 1 / part[0])
    w, b = fit_logistic([list(x) for x in rows["plain"]], [list(x) for x in rows["other"]], y, weight, len(index))
    return Model({t: float(w[j]) for t, j in index.items() if abs(w[j]) > 1e-6}, float(b))


def score(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text", keep: tuple[str, ...] = ()) -> DataFrame:
    """``id_col``, the columns in ``keep`` and ``score`` of every row."""
    src = docs.select(F.col(text_col).alias("body"), F.struct(id_col, *keep).alias("row"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            scores = [model.score(t.as_py()) for t in b.column(0)]
            yield pa.RecordBatch.from_arrays([b.column(1), pa.array(scores, pa.float64())], names=["row", "score"])

    row = src.schema["row"].dataType.simpleString()
    return map_batches(src, run, f"row {row}, score double").select("row.*", "score")
