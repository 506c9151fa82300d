"""Exact k-nearest-neighbour target features, blocked.

Every query row must see every eligible reference row (exact k-NN has no
index), but no pair is ever materialised as a row: queries and references
are cut into hash blocks; each (query block, reference block) pair is one
``cogroup`` task that finds its local top-k per query.  A per-query window over
at most ``n_ref_blocks * k`` candidates merges them.  Block sizes bound every
task's memory; the work is |Q| x |R| distances spread over
``n_q_blocks * n_ref_blocks`` tasks, so it grows with the square of the rows.

A task gets the distances of a slab of queries from one matrix product.  Its
rounding error has a proven bound: every reference that may be among the k
nearest stays, and these few are measured again, exactly, and ranked.

Leakage rule: a train query only sees references from other folds; a query
without a fold (test) sees all references.  Rows whose vector is null or has a
component that is null or not finite have no distance and take no part.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

SLAB_CELLS = 4_000_000      # distances a task holds at once (a slab of queries x its reference block)
LOOK = 8                    # every so many references of a block bound the k-th distance
BLOCK_ROWS = 16_384


def _block(col: str, n: int):
    return F.pmod(F.xxhash64(F.col(col)), F.lit(n)).cast("int")


def _vectors(table: pa.Table, column: str) -> np.ndarray:
    """The (not null, equally long) vectors of an Arrow column, a row each."""
    v = table.column(column).combine_chunks()
    v = v.chunk(0) if isinstance(v, pa.ChunkedArray) else v
    return v.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(v), -1)


def _ints(table: pa.Table, column: str) -> np.ndarray:
    return table.column(column).to_numpy()


def _exact(q: np.ndarray, r: np.ndarray) -> np.ndarray:
    """Squared distances along the last axis, added up dimension by dimension
    (the order a SQL list reduction uses)."""
    d2 = np.zeros(np.broadcast_shapes(q.shape[:-1], r.shape[:-1]))
    for j in range(q.shape[-1]):
        diff = q[..., j] - r[..., j]
        d2 += diff * diff
    return d2


def _ranked(Q: np.ndarray, R: np.ndarray, n_id: np.ndarray, rows: np.ndarray, cols: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The pairs (query row, reference row), measured exactly, cut to ``k`` a query."""
    dist = np.concatenate([np.zeros(0)] + [np.sqrt(_exact(Q[rows[i:i + 100_000]], R[cols[i:i + 100_000]])) for i in range(0, len(rows), 100_000)])
    known = np.isfinite(dist)
    rows, cols, dist = rows[known], cols[known], dist[known]
    order = np.lexsort((n_id[cols], dist, rows))
    rows, cols, dist = rows[order], cols[order], dist[order]
    start = np.flatnonzero(np.diff(rows, prepend=-1))
    rank = np.arange(len(rows)) - np.repeat(start, np.diff(np.r_[start, len(rows)]))
    return rows[rank < k], cols[rank < k], dist[rank < k]


def nearest_in_block(Q: np.ndarray, q_fold: np.ndarray, R: np.ndarray, n_id: np.ndarray, n_fold: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(query row, reference row, distance) of each query's k nearest references
    of other folds (fold -1: none), ties to the smaller id."""
    k, dim = min(k, len(R)), Q.shape[1]
    with np.errstate(over="ignore", invalid="ignore"):
        qq, rr = np.einsum("ij,ij->i", Q, Q), np.einsum("ij,ij->i", R, R)
        safe = bool(np.isfinite(4 * (qq.max() + rr.max())))
        # |computed - true| of both ways is below 2 (dim + 3) eps (|q|^2 + |r|^2); twice that parts two references
        slack = 8 * (dim + 4) * np.finfo(float).eps * (qq + rr.max()) if safe else np.zeros(len(Q))
        parts = []
        of_fold = {f: np.flatnonzero(n_fold == f) for f in np.unique(q_fold) if f >= 0}
        slab = max(1, SLAB_CELLS // len(R))
        for at in range(0, len(Q), slab):
            here = slice(at, min(at + slab, len(Q)))
            q, folds = Q[here], q_fold[here]
            if safe:
                d2 = q @ R.T
                d2 *= -2.0
                d2 += qq[here, None]
                d2 += rr[None, :]
            else:               # the squares overflow: the plain way keeps what is finite
                d2 = _exact(q[:, None, :], R[None, :, :])
            for f, columns in of_fold.items():
                own = np.flatnonzero(folds == f)
                if len(own) and len(columns):
                    d2[np.ix_(own, columns)] = np.inf
            some = d2[:, ::LOOK]
            kth = np.partition(some, k - 1, axis=1)[:, k - 1] if some.shape[1] >= k else np.full(len(q), np.inf)
            for i in np.flatnonzero(~np.isfinite(kth)):
                kth[i] = np.partition(d2[i], k - 1)[k - 1]
            within = np.minimum(kth + slack[here], np.finfo(float).max)
            cells = np.flatnonzero(d2 <= within[:, None])
            rows, cols = np.divmod(cells, len(R))
            near = d2.reshape(-1)[cells]
            # the k-th of what is left is nearer: most of it goes before it is measured again
            order = np.lexsort((near, rows))
            rows, cols, near = rows[order], cols[order], near[order]
            start = np.searchsorted(rows, np.arange(len(q)))
            ends = np.searchsorted(rows, np.arange(len(q)), "right")
            last = np.minimum(start + k, ends) - 1
            bound = np.where(ends - start >= k, near[last] if len(near) else 0.0, np.inf) + slack[here]
            keep = near <= bound[rows]
            rows, cols = rows[keep], cols[keep]
            parts.append(_ranked(Q, R, n_id, rows + at, cols, k))
    return tuple(np.concatenate(x) for x in zip(*parts))


def knn_candidates(query: DataFrame, ref: DataFrame, key: str, vec: str, k: int,
                   fold: str | None = "fold", payload: Sequence[str] = (),
                   block_rows: int | None = None) -> DataFrame:
    """(q_id, n_id, dist, payload...) -- the k nearest references of every
    query (ties -> smaller neighbour id).  ``block_rows=None`` sizes blocks to
    about sixteen per side, between 256 and 16,384 rows: more rows would not fit
    a task, fewer would copy each row to more blocks than the cores need."""
    def rows_of(df: DataFrame, *names: str) -> DataFrame:
        # floats stay floats on the way: their doubles are the same numbers
        kind = "array<float>" if df.schema[vec].dataType == T.ArrayType(T.FloatType()) else "array<double>"
        v = F.col(vec).cast(kind)
        usable = v.isNotNull() & F.forall(v, lambda x: F.coalesce(F.abs(x) < float("inf"), F.lit(False)))
        at = F.coalesce(F.col(fold).cast("int"), F.lit(-1)) if fold else F.lit(-1)
        return df.where(usable).select(F.col(key).cast("long").alias(names[0]), at.alias(names[1]), v.alias(names[2]), *names[3:])

    n_q, n_r = query.count(), ref.count()
    if block_rows is None:
        block_rows = min(BLOCK_ROWS, max(256, math.ceil(max(n_q, n_r) / 16)))
    nq = max(1, math.ceil(n_q / block_rows))
    nr = max(1, math.ceil(n_r / block_rows))
    q, r = rows_of(query, "q_id", "q_fold", "q_vec"), rows_of(ref, "n_id", "n_fold", "n_vec", *payload)
    # replicate each query to every reference block and vice versa; the
    # block-pair id is the cogroup key
    q = q.withColumn("_pair", F.explode(F.transform(F.sequence(F.lit(0), F.lit(nr - 1)), lambda b: _block("q_id", nq) * nr + b)))
    r = r.withColumn("_pair", F.explode(F.transform(F.sequence(F.lit(0), F.lit(nq - 1)), lambda b: b * nr + _block("n_id", nr))))
    pay_schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in ref.select(*payload).schema.fields)
    schema = "q_id long, n_id long, dist double" + (f", {pay_schema}" if payload else "")

    def topk(qt: pa.Table, rt: pa.Table) -> pa.Table:
        none = np.zeros(0, dtype=np.int64)
        rows, cols, dist = none, none, np.zeros(0)
        if qt.num_rows and rt.num_rows:
            rows, cols, dist = nearest_in_block(_vectors(qt, "q_vec"), _ints(qt, "q_fold"), _vectors(rt, "n_vec"), _ints(rt, "n_id"), _ints(rt, "n_fold"), k)
        return pa.table({"q_id": qt.column("q_id").take(pa.array(rows)), "n_id": rt.column("n_id").take(pa.array(cols)), "dist": pa.array(dist)}
                        | {c: rt.column(c).take(pa.array(cols)) for c in payload})

    cands = q.groupBy("_pair").cogroup(r.groupBy("_pair")).applyInArrow(topk, schema)
    w = Window.partitionBy("q_id").orderBy("dist", "n_id")  # <= nr * k rows per query
    return cands.withColumn("_rk", F.row_number().over(w)).where(F.col("_rk") <= k).drop("_rk")


def knn_target(query: DataFrame, ref: DataFrame, key: str, vec: str, k: int, target: str,
               label: str | None = None, classes: Sequence[int] = (), fold: str | None = "fold",
               block_rows: int | None = None) -> DataFrame:
    """Per query: mean and population std of ``target`` over its k nearest
    references, and the share of each class of ``label``."""
    payload = [target] + ([label] if label else [])
    c = knn_candidates(query, ref, key, vec, k, fold, payload, block_rows)
    aggs = [F.avg(target).alias("knn_mean"), F.stddev_pop(target).alias("knn_std"),
            F.count(F.lit(1)).alias("knn_n")]
    aggs += [F.avg((F.col(label) == cl).cast("double")).alias(f"knn_frac_{cl}") for cl in classes]
    return c.groupBy(F.col("q_id").alias(key)).agg(*aggs)
