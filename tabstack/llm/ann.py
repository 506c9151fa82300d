"""Approximate nearest neighbours with a hash-prefix forest (operator 4).

Each tree draws a sequence of random directions; the signs of a vector's
projections are its hash string, and the tree is the sorted array of all
strings.  A query descends to its longest matching prefix in every tree, by
binary search, and then ascends in all trees at once, one bit at a time, until
the vectors below it are enough; those are compared exactly.

Rows are dealt by a hash to shards of about ``shard_rows`` rows.  Each shard
holds a forest of its own rows, so every row is indexed once, no key can make
a shard hot, and a task's memory is bounded.  Blocks of ``query_block``
queries meet every shard, and each query's best of all shards are merged.

A forest's ``trees`` and the ``share`` of a shard at which the ascent stops set
the recall; see the README for its measured values.

Edge cases: vectors that are null, zero or hold null or non-finite components
and rows with a null id take no part; only vectors of equal length meet.
Equal vectors share one entry of the forest and are all candidates, ties go to
the smaller id.  Rows with the query's own id are no candidates; a repeated
query row answers once.  An empty table gives an empty result.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tabstack.llm.common import blocks_for, materialise

TREES = 160
BITS = 32
SHARE = 0.3
LEAST = 400       # candidates at least, where a shard has as many vectors
SHARD_ROWS = 16_000
QUERY_BLOCK = 2_000
SEED = 20_011


class Forest:
    """Sorted arrays of hash strings over the rows of ``x``."""

    def __init__(self, x: np.ndarray, trees: int = TREES, bits: int = BITS, seed: int = SEED):
        self.x, self.bits, dim = x, bits, x.shape[1]
        rng = np.random.default_rng(seed)
        self.centre = x.mean(axis=0)
        self.planes = [self._directions(rng, dim, bits) for _ in range(trees)]
        self.sorted, self.order = [], []
        for p in self.planes:
            h = self._strings(x, p)
            o = np.argsort(h, kind="stable")
            self.sorted.append(h[o])
            self.order.append(o.astype(np.int32))

    @staticmethod
    def _directions(rng: np.random.Generator, dim: int, bits: int) -> np.ndarray:
        """Random directions, orthogonal as far as the dimension allows."""
        blocks = [np.linalg.qr(rng.standard_normal((dim, dim)))[0] for _ in range(-(-bits // dim))]
        return np.concatenate(blocks, axis=1)[:, :bits]

    def _strings(self, x: np.ndarray, planes: np.ndarray) -> np.ndarray:
        """Hash strings as integers, the first bit the highest."""
        signs = (x - self.centre) @ planes > 0
        return signs @ (np.int64(1) << np.arange(self.bits - 1, -1, -1, dtype=np.int64))

    def candidates(self, q: np.ndarray, least: int):
        """For each row of ``q``: the rows below the highest level that has to be climbed for ``least`` of them."""
        levels = np.arange(self.bits, -1, -1)
        low = np.empty((len(self.planes), len(q), self.bits + 1), np.int32)
        high = np.empty_like(low)
        for t, p in enumerate(self.planes):
            h = self._strings(q, p)[:, None]
            up = (self.bits - levels)[None, :]
            first = (h >> up) << up
            low[t] = np.searchsorted(self.sorted[t], first)
            high[t] = np.searchsorted(self.sorted[t], first + (np.int64(1) << up))
        sizes = (high - low).sum(axis=0)
        for k in range(len(q)):
            step = int(np.argmax(sizes[k] >= min(least, sizes[k, -1])))
            while True:
                seen = np.zeros(len(self.x), bool)
                for t in range(len(self.planes)):
                    seen[self.order[t][low[t, k, step]: high[t, k, step]]] = True
                if step == self.bits or seen.sum() >= min(least, len(self.x)):
                    break
                step += 1
            yield np.flatnonzero(seen)


def nearest_in(q_ids: np.ndarray, q: np.ndarray, ids: np.ndarray, x: np.ndarray, k: int, trees: int, bits: int, share: float) -> pd.DataFrame:
    """The ``k`` nearest found of each query among the rows of a shard."""
    distinct, member = np.unique(x, axis=0, return_inverse=True)
    by_member = np.lexsort((ids, member))
    start = np.searchsorted(member[by_member], np.arange(len(distinct) + 1))
    forest = Forest(distinct, trees, bits)
    least = max(LEAST, 4 * k, int(np.ceil(share * len(distinct))))
    out = []
    for j, found in enumerate(forest.candidates(q, least)):
        far = np.sqrt(((distinct[found] - q[j]) ** 2).sum(axis=1))
        some = found[far <= np.partition(far, min(k, len(far) - 1))[min(k, len(far) - 1)]]     # k + 1, as one may be the query
        rows = np.concatenate([by_member[start[m]: start[m + 1]][: k + 1] for m in some])
        rows = rows[ids[rows] != q_ids[j]]
        score = np.sqrt(((x[rows] - q[j]) ** 2).sum(axis=1))
        best = np.lexsort((ids[rows], score))[:k]
        out.append(pd.DataFrame({"query_id": q_ids[j], "vec_id": ids[rows[best]], "score": score[best]}))
    return pd.concat(out) if out else pd.DataFrame({"query_id": q_ids[:0], "vec_id": ids[:0], "score": np.zeros(0)})


def usable(vec: Column) -> Column:
    """Neither null nor zero, all components finite."""
    finite = F.forall(vec, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < F.lit(float("inf"))))
    return vec.isNotNull() & F.coalesce(finite, F.lit(False)) & F.exists(vec, lambda v: v != 0)


def search(vectors: DataFrame, is_query: Column, k: int = 10, id_col: str = "vec_id", vec_col: str = "embedding",
           trees: int = TREES, bits: int = BITS, share: float = SHARE, shard_rows: int = SHARD_ROWS,
           query_block: int = QUERY_BLOCK) -> DataFrame:
    """``query_id, rank, vec_id, score``: the nearest rows found for the rows where ``is_query`` holds, by Euclidean distance."""
    id_type = vectors.schema[id_col].dataType.simpleString()
    vec = F.col(vec_col).cast("array<double>")
    src = vectors.select(F.col(id_col).alias("vec_id"), vec.alias("vec"), F.coalesce(is_query, F.lit(False)).alias("asks"))
    rows = materialise(src.filter(F.col("vec_id").isNotNull() & usable(F.col("vec"))).withColumn("_row", F.monotonically_increasing_id()), "vectors")
    size = rows.agg(F.count(F.lit(1)).alias("n"), F.sum(F.col("asks").cast("long")).alias("q")).first()
    shards, blocks = blocks_for(size.n, shard_rows), blocks_for(size.q or 0, query_block)
    dim = F.size("vec").alias("dim")
    held = rows.select("vec_id", "vec", dim, F.pmod(F.xxhash64("_row"), F.lit(shards)).cast("int").alias("shard"),
                       F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("block"))
    asked = rows.filter("asks").dropDuplicates(["vec_id", "vec"]).select(
        "vec_id", "vec", dim, F.pmod(F.xxhash64("vec_id", F.lit(7)), F.lit(blocks)).cast("int").alias("block"),
        F.explode(F.sequence(F.lit(0), F.lit(shards - 1))).alias("shard"))

    def meet(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        if not len(left) or not len(right):
            return pd.DataFrame({"query_id": [], "vec_id": [], "score": []})
        left = left.sort_values("vec_id", kind="stable")
        return nearest_in(right["vec_id"].to_numpy(), np.stack(right["vec"].to_numpy()), left["vec_id"].to_numpy(),
                          np.stack(left["vec"].to_numpy()), k, trees, bits, share)

    keys = ["shard", "block", "dim"]
    found = held.groupBy(*keys).cogroup(asked.groupBy(*keys)).applyInPandas(meet, f"query_id {id_type}, vec_id {id_type}, score double")
    place = F.row_number().over(Window.partitionBy("query_id").orderBy("score", "vec_id"))
    return found.withColumn("rank", place).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
