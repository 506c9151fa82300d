"""Nearest-neighbour mutual information of numeric features with a class or a number.

The estimator counts, around every row, how far its ``k``-th nearest row of the
same class lies in one feature and how many rows of any class are that near:
``psi(N) + <psi(k_i)> - <psi(N_class)> - <psi(m_i)>``, never below 0.  Where
plug-in bins blur a narrow dependence, the distances adapt to the data.

Everything is sorted once per need and never gathered: equal values of a class
are one row with a count (a hot value costs nothing), positions inside a
(feature, class) come from running totals over range partitions, neighbours from
blocks of positions that overlap by ``k`` rows, and the rows inside a radius
from running totals at its two ends.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tabstack.operators._util import bounded_broadcast
from tabstack.operators.aggregates import unpivot
from tabstack.session import cut_lineage

BLOCK_ROWS = 20_000     # positions of a (feature, class) that meet in one window
CELL_POINTS = 512       # least points of a cell of the plane; below twice as many meet
VISITORS = 4096         # points that visit a cell in one task
EDGE = 1e-15            # rows this near to the radius, relative to value and radius, lie on it


def digamma(x: Column) -> Column:
    """psi of a positive number: the asymptotic series at x + 8, stepped back."""
    y = x.cast("double") + 8.0
    z = F.lit(1.0) / (y * y)
    series = F.ln(y) - F.lit(0.5) / y - z * (F.lit(1 / 12) - z * (F.lit(1 / 120) - z / 252.0))
    for j in range(8):
        series = series - F.lit(1.0) / (x.cast("double") + float(j))
    return series


def running_total(df: DataFrame, group: Sequence[str], order: Sequence[str], amount: str, out: str) -> DataFrame:
    """``out``: sum of ``amount`` over the rows of the group up to this one in
    ``order`` (itself included; the order is to be total).

    Rows are range-partitioned by group and order; a partition's share of a
    group is summed by a window, what lies before it by a table of one row per
    partition and group.  The partitions are written before their numbers are
    used, so a lost executor cannot change them."""
    d = df.repartitionByRange(*group, *order).withColumn("_part", F.spark_partition_id())
    d = cut_lineage(d)
    sums = d.groupBy(*group, "_part").agg(F.sum(amount).alias("_sum"))
    before = Window.partitionBy(*group).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.select(*group, "_part", F.coalesce(F.sum("_sum").over(before), F.lit(0)).alias("_before"))
    here = Window.partitionBy(*group, "_part").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    d = d.withColumn("_here", F.sum(amount).over(here))
    d = d.join(bounded_broadcast(sums), [*group, "_part"])
    return d.withColumn(out, F.col("_before") + F.col("_here")).drop("_part", "_before", "_here")


def _radius(values: DataFrame, k: int, block_rows: int) -> DataFrame:
    """``values`` (feature, y, x, c, ny) with ``r``: distance to the k-th nearest
    other row of the class, or the farthest where the class is smaller."""
    d = running_total(values.withColumn("_one", F.lit(1)), ["feature", "y"], ["x"], "_one", "_pos").drop("_one")
    block, place = F.floor((F.col("_pos") - 1) / block_rows), F.pmod(F.col("_pos") - 1, F.lit(block_rows))
    # the first and last k rows of a block are also seen by the block beside it
    beside = F.array(block, F.when(place < k, block - 1), F.when(place >= block_rows - k, block + 1))
    d = d.withColumn("_own", block).withColumn("_block", F.explode(F.array_compact(beside)))
    near = Window.partitionBy("feature", "y", "_block").orderBy("_pos").rowsBetween(-k, k)
    d = d.withColumn("_near", F.collect_list(F.struct("x", "c")).over(near)).where("_own = _block")
    ranked = F.array_sort(F.transform("_near", lambda a: F.struct(F.abs(a["x"] - F.col("x")).alias("d"), a["c"].alias("c"))))
    need = F.least(F.lit(k), F.col("ny") - 1) + 1      # the row itself lies at distance 0
    return d.withColumn("r", _walk(ranked, need)["r"]).drop("_pos", "_own", "_block", "_near")


def _inside(d: DataFrame, at: str, other: Sequence[str]) -> DataFrame:
    """(feature, at, other, inside): how many of the counted rows ``c`` lie within
    the radius ``r`` of a row along ``at``, itself included, those on it not."""
    x = F.col(at)
    inner = F.greatest(F.lit(0.0), F.col("r") - F.lit(EDGE) * (F.abs(x) + F.col("r")))
    # a low end comes before the rows of its value (0 before 1), a high end after them
    rows = d.groupBy("feature", at).agg(F.sum("c").alias("c")).select(
        "feature", x.alias("pos"), F.lit(1).alias("kind"), at, *[F.lit(None).cast(d.schema[o].dataType).alias(o) for o in other], "c")
    ends = d.select("feature", at, *other, F.explode(F.array(
        F.struct((x - inner).alias("pos"), F.lit(0).alias("kind")),
        F.struct((x + inner).alias("pos"), F.lit(2).alias("kind")))).alias("e"))
    events = rows.unionByName(ends.select("feature", "e.pos", "e.kind", at, *other, F.lit(0).cast("long").alias("c")))
    events = running_total(events, ["feature"], ["pos", "kind", at, *other], "c", "upto").where("kind <> 1")
    return events.groupBy("feature", at, *other).agg(
        F.sum(F.when(F.col("kind") == 2, F.col("upto")).otherwise(-F.col("upto"))).alias("inside"))


def knn_mutual_information(df: DataFrame, features: Sequence[str], label: str, k: int = 3,
                           block_rows: int = BLOCK_ROWS) -> DataFrame:
    """(feature, n, mi): the estimate in nats for every feature.

    A row counts for a feature where value and label are there (NULL and NaN do
    not); a class of one row is left out, a class of up to ``k`` rows uses all
    its others.  Rows on the radius are not inside it.  Where the k-th neighbour
    is an equal value, ``k_i`` is the number of equal rows of the class, the
    limit of breaking the ties at random.  A feature without two rows of one
    class has n = 0 and mi = 0.  An infinite value is not finite and goes too."""
    if block_rows <= 2 * k:
        raise ValueError("block_rows must be above 2 * k")
    long = unpivot(df, features, ids=[label], cast="double", name="feature", value="x").withColumnRenamed(label, "y")
    long = long.where(F.col("x").isNotNull() & ~F.isnan("x") & (F.abs("x") < float("inf")) & F.col("y").isNotNull())
    # -0.0 and 0.0 are one value
    values = long.groupBy("feature", "y", (F.col("x") + F.lit(0.0)).alias("x")).agg(F.count(F.lit(1)).alias("c"))
    values = cut_lineage(values)
    sizes = values.groupBy("feature", "y").agg(F.sum("c").alias("ny")).where("ny > 1")  # a row per feature and class
    d = cut_lineage(_radius(values.join(bounded_broadcast(sizes), ["feature", "y"]), k, block_rows))
    d = d.join(_inside(d, "x", ["y"]).withColumnRenamed("inside", "m"), ["feature", "y", "x"])
    ki = F.when(F.col("r") == 0, F.col("c")).otherwise(F.least(F.lit(k), F.col("ny") - 1))
    term = F.col("c") * (digamma(ki) - digamma(F.col("ny")) - digamma(F.col("m")))
    sums = d.groupBy("feature").agg(F.sum("c").alias("n"), F.sum(term).alias("_t"))
    sums = sums.select("feature", "n", F.greatest(F.lit(0.0), digamma(F.col("n")) + F.col("_t") / F.col("n")).alias("mi"))
    every = df.sparkSession.createDataFrame([(f,) for f in features], "feature string")
    return every.join(sums, "feature", "left").select("feature", F.coalesce("n", F.lit(0)).cast("long").alias("n"),
                                                      F.coalesce("mi", F.lit(0.0)).alias("mi"))


# ------------------------------------------------------------ numeric target

def _nearest(qx, qy, x, y, c, k, within=None) -> tuple[list, list]:
    """Per query the ``k + 1`` nearest points: distances and counts, nearest first."""
    d = np.maximum(np.abs(qx[:, None] - x[None, :]), np.abs(qy[:, None] - y[None, :]))
    take = min(k + 1, len(x))
    at = np.argpartition(d, take - 1, axis=1)[:, :take]
    near = np.take_along_axis(d, at, axis=1)
    order = np.argsort(near, axis=1, kind="stable")
    near, count = np.take_along_axis(near, order, axis=1), c[np.take_along_axis(at, order, axis=1)]
    if within is None:
        return list(near), list(count)
    keep = near <= within[:, None]
    return [a[m] for a, m in zip(near, keep)], [a[m] for a, m in zip(count, keep)]


def _walk(near: Column, need: Column) -> Column:
    """(n, r): the distance at which the counts of the sorted ``near`` reach ``need``."""
    start = F.struct(F.lit(0).cast("long").alias("n"), F.lit(0.0).alias("r"))
    return F.aggregate(near, start, lambda acc, a: F.when(acc["n"] >= need, acc).otherwise(
        F.struct((acc["n"] + a["c"]).alias("n"), a["d"].alias("r"))))


def _cells(points: DataFrame, cell_points: int) -> DataFrame:
    """``points`` (feature, x, y, c, np) with their ``stripe`` and ``cell``."""
    d = running_total(points.withColumn("_one", F.lit(1)), ["feature"], ["x", "y"], "_one", "_pos")
    wide = F.ceil(F.sqrt(F.col("np") * F.lit(float(cell_points))))
    last = F.greatest(F.lit(1), F.floor(F.col("np") / wide)) - 1
    d = d.withColumn("stripe", F.least(F.floor((F.col("_pos") - 1) / wide), last)).drop("_pos")
    d = running_total(d, ["feature", "stripe"], ["y", "x"], "_one", "_pos").drop("_one")
    held = d.groupBy("feature", "stripe").agg(F.count(F.lit(1)).alias("held"))
    d = d.join(bounded_broadcast(held.select("feature", "stripe", "held")), ["feature", "stripe"])
    last = F.greatest(F.lit(1), F.floor(F.col("held") / cell_points)) - 1
    return d.withColumn("cell", F.least(F.floor((F.col("_pos") - 1) / cell_points), last)).drop("_pos", "held")


def _reached(d: DataFrame, group: Sequence[str], at: str, place: str, lo: Column, hi: Column) -> DataFrame:
    """A row of ``d`` for every ``place`` of its group whose span of ``at`` meets
    [lo, hi].  The spans of a group's places follow one another (they may touch),
    so those met are neighbours: the first and last come from two running totals."""
    spans = d.where("visitor = 0").groupBy(*group, place).agg(F.min(at).alias("_from"), F.max(at).alias("_to"))
    ids = ["feature", "x", "y"]
    zero = F.lit(0).cast("long")
    tail = [F.lit(None).cast("double").alias(f"_{c}") for c in ("x", "y")]
    # places that end before lo; places that begin up to hi
    marks = spans.select(*group, F.explode(F.array(
        F.struct(F.col("_to").alias("pos"), F.lit(1).alias("kind"), F.lit(1).cast("long").alias("ends"), zero.alias("starts")),
        F.struct(F.col("_from").alias("pos"), F.lit(1).alias("kind"), zero.alias("ends"), F.lit(1).cast("long").alias("starts")))).alias("e"),
        F.col(place).alias("_place"), *tail)
    asks = d.where("visitor = 1").select(*group, F.explode(F.array(
        F.struct(lo.alias("pos"), F.lit(0).alias("kind"), zero.alias("ends"), zero.alias("starts")),
        F.struct(hi.alias("pos"), F.lit(2).alias("kind"), zero.alias("ends"), zero.alias("starts")))).alias("e"),
        F.lit(None).cast("long").alias("_place"), F.col("x").alias("_x"), F.col("y").alias("_y"))
    events = marks.unionByName(asks).select(*group, "e.*", "_place", "_x", "_y")
    order = ["pos", "kind", "_place", "_x", "_y", "ends"]
    events = running_total(events, group, order, "ends", "_ended")
    events = running_total(events, group, order, "starts", "_started").where("kind <> 1")
    ask = events.groupBy(*group, F.col("_x").alias("x"), F.col("_y").alias("y")).agg(
        F.max(F.when(F.col("kind") == 0, F.col("_ended"))).alias("_first"),
        F.max(F.when(F.col("kind") == 2, F.col("_started"))).alias("_stop"))
    ask = ask.where("_stop > _first").select(*group, "x", "y", F.explode(F.sequence(F.col("_first"), F.col("_stop") - 1)).alias(place))
    keys = [*dict.fromkeys([*group, *ids])]
    return d.where("visitor = 1").drop(place).join(ask, keys)


def knn_mutual_information_numeric(df: DataFrame, features: Sequence[str], target: str, k: int = 3,
                                   cell_points: int = CELL_POINTS, visitors: int = VISITORS) -> DataFrame:
    """(feature, n, mi): the estimate in nats of what each feature tells of a numeric target.

    ``psi(N) + <psi(k_i)> - <psi(nx)> - <psi(ny)>`` with both columns divided by
    their standard deviation; ``nx`` and ``ny`` count the rows nearer than the
    k-th neighbour along each column.  Rows with a null, NaN or infinite value or
    target do not count; equal pairs are one point with a count, and where the
    k-th neighbour is an equal pair ``k_i`` is their number.  Fewer than two rows
    give mi = 0."""
    if cell_points <= k + 1:
        raise ValueError("cell_points must be above k + 1")
    spark = df.sparkSession
    long = unpivot(df.withColumn("_target", F.col(target).cast("double")), features, ids=["_target"], cast="double", name="feature", value="x")
    for c in ("x", "_target"):
        long = long.where(F.col(c).isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
    pairs = long.groupBy("feature", (F.col("x") + F.lit(0.0)).alias("x"), (F.col("_target") + F.lit(0.0)).alias("y")).agg(F.count(F.lit(1)).alias("c"))
    pairs = cut_lineage(pairs)
    n = F.sum("c")
    mx, my = F.sum(F.col("x") * F.col("c")) / n, F.sum(F.col("y") * F.col("c")) / n
    means = bounded_broadcast(pairs.groupBy("feature").agg(mx.alias("mx"), my.alias("my"), n.alias("n"), F.count(F.lit(1)).alias("np")))
    near_mean = pairs.join(means, "feature")
    dev = near_mean.groupBy("feature", "n", "np").agg(
        F.sqrt(F.sum(F.col("c") * (F.col("x") - F.col("mx")) ** 2) / F.first("n")).alias("sx"),
        F.sqrt(F.sum(F.col("c") * (F.col("y") - F.col("my")) ** 2) / F.first("n")).alias("sy"))
    dev = bounded_broadcast(dev.where("n > 1"))     # a row per feature
    scaled = [(F.col(c) / F.when(F.col(f"s{c}") > 0, F.col(f"s{c}")).otherwise(1.0)).alias(c) for c in ("x", "y")]
    points = pairs.join(dev, "feature").select("feature", *scaled, "c", "n", "np")
    # two values may fall together when divided
    points = points.groupBy("feature", "x", "y", "n", "np").agg(F.sum("c").alias("c"))
    d = cut_lineage(_cells(points, cell_points))

    near_type = "near array<struct<d: double, c: long>>"
    place = ["feature", "stripe", "cell"]

    def entries(ds, cs):
        return [[{"d": float(a), "c": int(b)} for a, b in zip(x, y)] for x, y in zip(ds, cs)]

    def own(g: pd.DataFrame) -> pd.DataFrame:
        x, y, c = g["x"].to_numpy(), g["y"].to_numpy(), g["c"].to_numpy()
        found = [_nearest(x[s:s + 256], y[s:s + 256], x, y, c, k) for s in range(0, len(x), 256)]
        return g.assign(near=[e for ds, cs in found for e in entries(ds, cs)])

    d = d.groupBy(*place).applyInPandas(own, f"feature string, stripe long, x double, y double, n long, np long, c long, cell long, {near_type}")
    need = F.least(F.lit(k), F.col("n") - 1) + 1
    first = _walk(F.col("near"), need)
    d = cut_lineage(d.withColumn("r0", F.when(first["n"] >= need, first["r"]).otherwise(F.lit(float("inf")))))

    # the cells that a point's square meets, its own left out
    slack = F.col("r0") * (1 + 1e-12)
    base = d.select(*place, "x", "y", "r0", F.lit(0).alias("visitor"))
    home = F.struct(F.col("stripe").alias("s"), F.col("cell").alias("c")).alias("home")
    asks = d.where("r0 > 0").select(*place, "x", "y", "r0", F.lit(1).alias("visitor"), home)
    both = base.withColumn("home", F.lit(None).cast(asks.schema["home"].dataType)).unionByName(asks)
    to = _reached(both, ["feature"], "x", "stripe", F.col("x") - slack - F.abs("x") * EDGE, F.col("x") + slack + F.abs("x") * EDGE)
    tall = d.groupBy("feature", "stripe").agg(F.min("y").alias("y0"), F.max("y").alias("y1"))
    to = to.join(bounded_broadcast(tall), ["feature", "stripe"]).where((F.col("y") - slack <= F.col("y1")) & (F.col("y") + slack >= F.col("y0")))
    to = cut_lineage(to.select(*place, "x", "y", "r0", "visitor", "home"))
    both = base.withColumn("home", F.lit(None).cast(asks.schema["home"].dataType)).unionByName(to)
    to = _reached(both, ["feature", "stripe"], "y", "cell", F.col("y") - slack - F.abs("y") * EDGE, F.col("y") + slack + F.abs("y") * EDGE)
    to = to.where((F.col("stripe") != F.col("home.s")) | (F.col("cell") != F.col("home.c")))
    to = running_total(to.select(*place, "x", "y", "r0").withColumn("_one", F.lit(1)), place, ["x", "y"], "_one", "_pos")
    to = cut_lineage(to.withColumn("chunk", F.floor((F.col("_pos") - 1) / visitors)).drop("_pos", "_one"))
    chunks = to.groupBy(*place).agg(F.max("chunk").alias("last"))
    hosts = d.select(*place, "x", "y", "c").join(chunks, place).withColumn("chunk", F.explode(F.sequence(F.lit(0).cast("long"), "last"))).drop("last")

    def visit(q: pd.DataFrame, g: pd.DataFrame) -> pd.DataFrame:
        cols = ["feature", "x", "y"]
        if q.empty or g.empty:
            return pd.DataFrame({c: [] for c in [*cols, "near"]})
        x, y, c = g["x"].to_numpy(), g["y"].to_numpy(), g["c"].to_numpy()
        qx, qy, r = (q[c].to_numpy() for c in ("x", "y", "r0"))
        found = [_nearest(qx[s:s + 256], qy[s:s + 256], x, y, c, k, r[s:s + 256]) for s in range(0, len(q), 256)]
        return q[cols].assign(near=[e for ds, cs in found for e in entries(ds, cs)])

    keys = [*place, "chunk"]
    to = to.toDF(*to.columns)       # ``hosts`` comes from it, too: columns of its own
    met = to.groupBy(*keys).cogroup(hosts.groupBy(*keys)).applyInPandas(visit, f"feature string, x double, y double, {near_type}")
    ids = ["feature", "x", "y"]
    every = d.select(*ids, "near").unionByName(met)
    every = every.groupBy(*ids).agg(F.array_sort(F.flatten(F.collect_list("near"))).alias("near"))
    d = d.select(*ids, "c", "n").join(every, ids).withColumn("r", _walk(F.col("near"), need)["r"]).drop("near")
    d = cut_lineage(d)
    d = d.join(_inside(d, "x", ["y"]).withColumnRenamed("inside", "nx"), ids).join(_inside(d, "y", ["x"]).withColumnRenamed("inside", "ny"), ids)
    ki = F.when(F.col("r") == 0, F.col("c")).otherwise(F.least(F.lit(k), F.col("n") - 1))
    term = F.col("c") * (digamma(ki) - digamma(F.col("nx")) - digamma(F.col("ny")))
    sums = d.groupBy("feature", "n").agg(F.sum(term).alias("_t"))
    sums = sums.select("feature", "n", F.greatest(F.lit(0.0), digamma(F.col("n")) + F.col("_t") / F.col("n")).alias("mi"))
    listed = spark.createDataFrame([(f,) for f in features], "feature string")
    return listed.join(sums, "feature", "left").select("feature", F.coalesce("n", F.lit(0)).cast("long").alias("n"),
                                                       F.coalesce("mi", F.lit(0.0)).alias("mi"))
