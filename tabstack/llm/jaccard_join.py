"""N-gram Jaccard join by universe partition (operator 7).

Documents are sets of word shingles; two link when 100 |x & y| >= T |x | y|.

1. Equal sets form one class; from here on a class is one set.
2. Sets are handled by size band, and around each band edge by another
   instance, so that every pair that can link meets in one instance.  There
   the hash universe is cut into units.  A linked pair differs in at most H
   shingles, so with H + 1 units some unit holds equal subsets on both sides.
   Two units may join to a double segment, which is indexed with its
   one-deletion neighbourhood, finds pairs that differ once in it, and counts
   for two: more entries, but far fewer sets that meet by chance.  How many
   join is chosen for each instance by cost: index entries against chance
   meetings of the sets that it holds.
   There are more units than H + 1, and most sets have fewer than H differences
   to bear, so each can leave out some segments without a loss: the smallest,
   which are those that sets share by chance or with one common passage (see
   ``Plan``).
3. Sets that share an index entry are candidates.  In each entry's bucket the
   few sets with the most company are its hubs; each set is compared first with
   the hubs that it shares most entries with, and links join components.  Then only pairs of different components remain and
   are all compared.  So a bucket of copies costs a few comparisons for each
   member, and no link between different components is lost.
4. A comparison takes exact bounds first (parity and count sketches: their
   distance is at most the symmetric difference), then the exact sets, which
   are made again from the texts of the remaining classes.

Edge cases: null and word-less texts have empty sets, link with nothing and
are their own component.  Rows of equal id count as one document with the
links of all its texts.  A row with a null id has a null component unless its
set is that of, or links with, a known id.  An empty table gives an empty
result.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from itertools import count

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tabstack.llm.common import map_batches, materialise, range_of

BAND_RATIO = 1.5
HUBS = 3                 # sets of a bucket that are compared with all its others first
BUCKET_BLOCK = 2_048     # members of a bucket that meet in one task when all pairs are due
SKETCH_WORDS = 8         # 64-bit words of the parity sketch
COUNT_CELLS = 512        # bytes of the count sketch
SURPLUS = 0.15           # units of the universe beyond those that the pigeonhole needs, for each of them
OVERLAP, RELATED = 0.3, 0.01     # cost model: sets with a common passage share so much, and so many of all pairs are such
BEST_HUBS = 2            # hubs a set is compared with first: those it shares most entries with


def shingles(text: str | None, words: int) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the word n-grams; the whole sequence where it is shorter."""
    found = text.encode("utf-8", "replace").lower().split() if text else []
    if not found:
        return np.zeros(0, np.uint64)
    h = np.fromiter(map(xxhash.xxh64_intdigest, found), np.uint64, len(found))
    n = min(words, len(h))
    out = np.full(len(h) - n + 1, np.uint64(n * 0x9E3779B97F4A7C15 % (1 << 64)))
    for k in range(n):
        out = (out ^ h[k: len(h) - n + 1 + k]) * np.uint64(0xD6E8FEB86659FD93)
        out ^= out >> np.uint64(32)
    return np.unique(out)


def sketch(s: np.ndarray) -> np.ndarray:
    """Parity of the number of shingles in each of 64 x SKETCH_WORDS cells."""
    bits = 64 * SKETCH_WORDS
    odd = np.bincount((s % np.uint64(bits)).astype(np.int64), minlength=bits) & 1
    return np.packbits(odd.astype(np.uint8)).view(np.int64)


def cell_counts(s: np.ndarray) -> bytes:
    """Number of shingles in each of COUNT_CELLS cells (255 stands for more)."""
    cells = np.bincount(((s >> np.uint64(16)) % np.uint64(COUNT_CELLS)).astype(np.int64), minlength=COUNT_CELLS)
    return np.minimum(cells, 255).astype(np.uint8).tobytes()


def max_difference(size_sum: int, percent: int) -> int:
    """The largest symmetric difference of linked sets whose sizes add up to ``size_sum``."""
    return size_sum * (100 - percent) // (100 + percent)


def band_edges(limit: int, ratio: float = BAND_RATIO) -> list[int]:
    """Sizes at which bands 1, 2, .. start (band 0 starts at 1); the last lies above ``limit``."""
    out = [2]
    while out[-1] <= limit:
        out.append(max(out[-1] + 1, int(out[-1] * ratio)))
    return out


class Plan:
    """Segments of one instance.

    The hash universe is cut into ``units`` equal units, ``bound`` + 1 and a
    surplus; the first 2 ``d`` units form ``d`` double segments, each other
    unit is a segment.  A segment that is equal on both sides, or a double one
    that differs once at most, weighs as many units as it has; a pair that
    differs h times has matches of weight ``units`` - h or more.

    A set of n shingles differs from no partner in this instance more than
    h(n) times, so matches of weight ``units`` - h(n) - 1 can go without a loss:
    it leaves out its smallest segments, which are those that others share by
    chance.  Segments rank by their size and a hash of what they hold, the same
    on both sides; a double segment's size may differ by one there, so it
    counts against the weight as soon as its size reaches the limit and is left
    out one later.  (If all matches of a pair were left out by one side or the
    other, those of the higher limit alone would exceed its weight.)
    """

    def __init__(self, low: int, high: int, bound: int, sets: int, percent: int, d: int | None = None):
        self.low, self.high, self.bound, self.percent = low, high, bound, percent
        self.units = bound + 1 + math.ceil(bound * SURPLUS)
        tried = range(0, self.units // 2 + 1, max(1, self.units // 32))
        self.d = min(tried, key=lambda d: (self.cost(d, sets), d)) if d is None else d
        self.m = self.units - self.d

    def spare(self, n: int) -> int:
        """Weight of matches that a set of ``n`` shingles can do without."""
        partner = min(self.high, n * 100 // self.percent)
        return self.units - 1 - min(self.bound, max_difference(n + partner, self.percent))

    def cost(self, d: int, sets: int) -> float:
        """Index entries, and chance meetings of unrelated sets and of those that share a passage, over sizes of the band.

        An estimate (segments hold Poisson numbers of shingles); it decides what is fast, not what is found."""
        entries = meets = 0.0
        sizes = [self.low + (self.high - self.low) * k / 4 for k in range(5)]
        for n in sizes:
            mean, singles, spare = n / self.units, self.units - 2 * d, self.spare(int(n))
            entries += max(0, singles - spare) + d * (1 + 2 * mean)
            for share, weight in ((0.0, 1.0), (OVERLAP, RELATED)):
                kinds = [(singles, 1, mean, lambda own: 1.0), (d, 2, 2 * mean, lambda own: 1 + own)]     # number, weight, mean size, ways to match
                left, met = float(spare), 0.0
                for j in range(int(2 * mean) + 8):      # segments of j shingles, the smallest left out first
                    there = sum(number * w * _poisson(j, mu) for number, w, mu, _ in kinds)
                    kept = max(0.0, 1 - left / there) if there > 1e-9 else 0.0
                    left = max(0.0, left - there)
                    for number, _, mu, ways in kinds:
                        own = 2 * (1 - share) * mu
                        met += number * kept * kept * _poisson(j, share * mu) * math.exp(-own) * ways(own)
                meets += weight * met
        return (entries * sets + meets * sets * sets / 2) / len(sizes)

    def entries(self, s: np.ndarray, instance: int) -> np.ndarray:
        """Index entries of the set ``s`` (64-bit)."""
        unit = ((s >> np.uint64(32)) * np.uint64(self.units) >> np.uint64(32)).astype(np.int64)   # s is sorted, so is this
        d = self.d
        segment = np.where(unit < 2 * d, unit >> 1, unit - d) if d else unit
        mixed = (s ^ (s >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
        mixed ^= mixed >> np.uint64(32)
        total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(mixed)])
        at = np.searchsorted(segment, np.arange(self.m + 1))
        size, sums = np.diff(at), total[at[1:]] - total[at[:-1]]
        place = np.arange(self.m, dtype=np.uint64) + np.uint64(instance << 32) + np.uint64(1)
        key = _entry(sums, place)
        rank = size.astype(np.float64)
        rank[d:] += (key[d:] >> np.uint64(40)).astype(np.float64) / (1 << 24)
        limit = self._limit(rank, len(s))
        kept = rank > limit
        kept[:d] = rank[:d] + 1 > limit
        found = [key[kept]]
        if d:
            inner = np.flatnonzero(kept[segment[:at[d]]])
            found.append(_entry(sums[segment[inner]] - mixed[inner], place[segment[inner]]))
        return np.unique(np.concatenate(found))

    def _limit(self, rank: np.ndarray, n: int) -> float:
        """The highest rank up to which all segments together weigh no more than can be spared."""
        order = np.argsort(rank, kind="stable")
        weight = np.cumsum(np.where(order < self.d, 2, 1))
        k = int(np.searchsorted(weight, self.spare(n), side="right"))
        ranks = rank[order]
        while 0 < k < len(ranks) and ranks[k] == ranks[k - 1]:
            k -= 1
        return float(ranks[k - 1]) if k else -1.0


def _poisson(j: int, mean: float) -> float:
    return mean ** j * math.exp(-mean) / math.factorial(j)


def _entry(sums: np.ndarray, place: np.ndarray) -> np.ndarray:
    key = (sums + place * np.uint64(0x9E3779B97F4A7C15)) * np.uint64(0x94D049BB133111EB)
    return key ^ (key >> np.uint64(31))


def instances_of(size: int, edges: list[int], percent: int) -> list[int]:
    """Instances a set of ``size`` takes part in: 2 k for band k, 2 k + 1 for the edge above it."""
    k = int(np.searchsorted(edges, size, side="right"))
    out = [2 * k]
    if size * 100 >= edges[k] * percent:                         # may meet larger sets of the next band
        out.append(2 * k + 1)
    if k and size * percent <= (edges[k - 1] - 1) * 100:         # may meet smaller ones of the band before
        out.append(2 * k - 1)
    return out


def make_plans(counts: dict[int, int], edges: list[int], percent: int) -> dict[int, Plan]:
    """A plan for each instance; ``counts`` has the number of sets in each band."""
    plans = {}
    for k, edge in enumerate(edges):
        low, high = (edges[k - 1] if k else 1), edge - 1
        plans[2 * k] = Plan(low, high, max_difference(2 * high, percent), counts.get(k, 0), percent)
        above = high * 100 // percent
        plans[2 * k + 1] = Plan(-(-edge * percent // 100), above, max_difference(high + above, percent),
                                (counts.get(k, 0) + counts.get(k + 1, 0)) // 2, percent)
    return plans


def components(edges: DataFrame) -> DataFrame:
    """``id, component`` (the smallest id) of the ends of ``edges`` (a, b), by alternating star contraction."""
    now = edges.filter("a != b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    now, seen = materialise(now, "edges"), None
    while True:
        mark = now.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b") % F.lit(1 << 31))).first()
        if mark == seen or not mark[0]:
            break
        seen = mark
        both = now.unionByName(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.join(low, "a").filter("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(least, "a").filter("b != m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        small = small.unionByName(least.select("a", F.col("m").alias("b"))).filter("a != b")
        now = materialise(small.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges")
    return now.select(F.col("a").alias("id"), F.col("b").alias("component")).unionByName(
        now.select(F.col("b").alias("id"), F.col("b").alias("component")).distinct())


def _profile(docs: DataFrame, words: int) -> DataFrame:
    """``doc_id, n, key`` and the sketches of every row; ``key`` identifies the set."""
    id_type = docs.schema["doc_id"].dataType.simpleString()
    names = [f"s{k}" for k in range(SKETCH_WORDS)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            sizes, keys, marks, counts = [], [], [], []
            for text in b.column(1):
                s = shingles(text.as_py(), words)
                sizes.append(len(s))
                counts.append(cell_counts(s))
                keys.append(xxhash.xxh64_intdigest(s.tobytes()))
                marks.append(sketch(s))
            cells = np.array(marks).reshape(len(marks), SKETCH_WORDS)
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array(sizes, pa.int64()), pa.array(np.array(keys, np.uint64).view(np.int64)),
                 *[pa.array(np.ascontiguousarray(cells[:, k])) for k in range(SKETCH_WORDS)], pa.array(counts, pa.binary())],
                names=["doc_id", "n", "key", *names, "counts"])

    return map_batches(docs, run, f"doc_id {id_type}, n bigint, key bigint, " + ", ".join(f"{x} bigint" for x in names) + ", counts binary")


def _index(docs: DataFrame, words: int, edges: list[int], plans: dict[int, Plan], percent: int) -> DataFrame:
    """``entry, key`` for every index entry of every set; a task emits equal sets once."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def out(parts, keys):
            return pa.RecordBatch.from_arrays([pa.array(np.concatenate(parts).view(np.int64)), pa.array(np.concatenate(keys).view(np.int64))],
                                              names=["entry", "key"])
        done: set[int] = set()
        for b in batches:
            parts, keys, size = [], [], 0
            for text in b.column(1):
                s = shingles(text.as_py(), words)
                key = xxhash.xxh64_intdigest(s.tobytes())
                if not len(s) or key in done:
                    continue
                done.add(key)
                for i in instances_of(len(s), edges, percent):
                    if plans[i].bound:      # without a difference to bear, only equal sets link
                        own = plans[i].entries(s, i)
                        parts.append(own)
                        keys.append(np.full(len(own), key, np.uint64))
                        size += len(own)
                if size >= 1 << 19:
                    yield out(parts, keys)
                    parts, keys, size = [], [], 0
            if parts:
                yield out(parts, keys)

    return map_batches(docs, run, "entry bigint, key bigint")


def _sets(docs: DataFrame, words: int) -> DataFrame:
    """``key, items`` (the set) of every set; a task emits equal sets once."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        done: set[int] = set()
        for b in batches:
            for at in range(0, b.num_rows, 256):
                found = {}
                for t in b.column(1).slice(at, 256):
                    s = shingles(t.as_py(), words)
                    key = xxhash.xxh64_intdigest(s.tobytes())
                    if key not in done:
                        done.add(key)
                        found[key] = s
                if not found:
                    continue
                offsets = np.concatenate([[0], np.cumsum([len(s) for s in found.values()])]).astype(np.int32)
                items = pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate(list(found.values())).view(np.int64)))
                yield pa.RecordBatch.from_arrays([pa.array(np.array(list(found), np.uint64).view(np.int64)), items], names=["key", "items"])

    return map_batches(docs, run, "key bigint, items array<bigint>")


def _may_link(percent: int) -> Column:
    """Exact bound: sizes and parity sketches of the rows ``x`` and ``y`` allow a link."""
    distance = sum((F.bit_count(F.col(f"x.s{k}").bitwiseXOR(F.col(f"y.s{k}"))) for k in range(SKETCH_WORDS)), F.lit(0))
    return ((F.least("x.n", "y.n") * 100 >= F.greatest("x.n", "y.n") * percent)
            & (distance * (100 + percent) <= (F.col("x.n") + F.col("y.n")) * (100 - percent)))


def _bounded(pairs: DataFrame, narrow: DataFrame, percent: int) -> DataFrame:
    """Those of ``pairs`` (a, b) that pass the first bound, with the sum of their sizes."""
    return (pairs.join(narrow.alias("x"), F.col("a") == F.col("x.key")).join(narrow.alias("y"), F.col("b") == F.col("y.key"))
            .filter(_may_link(percent)).select("a", "b", (F.col("x.n") + F.col("y.n")).alias("both")))


def _near(pairs: DataFrame, classes: DataFrame, percent: int) -> DataFrame:
    """Those of ``pairs`` (a, b, both) whose count sketches allow a link: their distance is at most the symmetric difference."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            x, y = (np.frombuffer(b"".join(b.column(k).to_pylist()), np.uint8).reshape(-1, COUNT_CELLS).astype(np.int16) for k in (3, 4))
            distance = np.abs(x - y).sum(axis=1, dtype=np.int64)
            keep = distance * (100 + percent) <= b.column(2).to_numpy() * (100 - percent)
            yield pa.RecordBatch.from_arrays([b.column(k).filter(pa.array(keep)) for k in range(3)], names=["a", "b", "both"])

    both = (pairs.join(classes.select(F.col("key").alias("a"), F.col("counts").alias("ca")), "a")
            .join(classes.select(F.col("key").alias("b"), F.col("counts").alias("cb")), "b"))
    return materialise(map_batches(both.select("a", "b", "both", "ca", "cb"), run, "a bigint, b bigint, both bigint"), "near")


def _links(near: DataFrame, classes: DataFrame, src: DataFrame, words: int, percent: int) -> DataFrame:
    """Those of ``near`` that link, by the sets themselves, which are made again from the texts of these classes only."""
    keys = near.select(F.col("a").alias("key")).unionByName(near.select(F.col("b").alias("key"))).distinct()
    wanted = materialise(classes.join(keys, "key").select("key", F.col("first").alias("_first")), "wanted")
    texts = src.join(wanted.select("_first").distinct(), F.col("doc_id").eqNullSafe(F.col("_first")), "left_semi")
    items = materialise(_sets(texts, words), "sets")
    found = (near.join(items.select(F.col("key").alias("a"), F.col("items").alias("ia")), "a")
             .join(items.select(F.col("key").alias("b"), F.col("items").alias("ib")), "b"))
    common = F.size(F.array_intersect("ia", "ib"))
    return materialise(found.filter(common * 100 >= (F.col("both") - common) * percent).select("a", "b").distinct(), "links")


def _pair(x: str, y: str) -> list[Column]:
    return [F.least(x, y).alias("a"), F.greatest(x, y).alias("b")]


def _open_buckets(shared: DataFrame, parts: DataFrame) -> DataFrame:
    """Rows of the buckets whose members lie in several components, with their component."""
    rows = shared.join(parts.select(F.col("id").alias("key"), "component"), "key", "left").select(
        "entry", "key", "members", F.coalesce("component", "key").alias("component"))
    mixed = rows.groupBy("entry").agg(F.min("component").alias("low"), F.max("component").alias("high")).filter("low != high")
    return rows.join(mixed.select("entry"), "entry")


def _cross_pairs(rows: DataFrame, narrow: DataFrame, percent: int) -> DataFrame:
    """All pairs of a bucket from different components that may link; large buckets meet in blocks."""
    blocks = F.ceil(F.col("members") / BUCKET_BLOCK).cast("int")
    full = rows.join(narrow, "key")
    x = full.withColumn("block", F.pmod(F.xxhash64("key"), blocks).cast("int")).alias("x")
    y = full.withColumn("block", F.explode(F.sequence(F.lit(0), blocks - 1))).alias("y")
    met = (F.col("x.entry") == F.col("y.entry")) & (F.col("x.block") == F.col("y.block"))
    apart = (F.col("x.key") < F.col("y.key")) & (F.col("x.component") != F.col("y.component"))
    return (x.join(y, met & apart & _may_link(percent))
            .select(F.col("x.key").alias("a"), F.col("y.key").alias("b"), (F.col("x.n") + F.col("y.n")).alias("both")).distinct())


def _members(src: DataFrame, words: int, percent: int) -> tuple[DataFrame, DataFrame]:
    """``doc_id, n_shingles, key`` (null: empty set) of every row; ``key, component, component_id`` of every set."""
    marks = [f"s{k}" for k in range(SKETCH_WORDS)]
    profile = materialise(_profile(src, words), "profiles")
    sets = profile.filter("n > 0")
    classes = materialise(sets.groupBy("key").agg(F.min("doc_id").alias("first"), F.max("n").alias("n"), *[F.max(c).alias(c) for c in [*marks, "counts"]]), "classes")
    edges = band_edges(classes.agg(F.max("n")).first()[0] or 0)
    bands = classes.groupBy(range_of(F.col("n"), edges).alias("band")).agg(F.count(F.lit(1)).alias("sets")).collect()   # a row per band
    plans = make_plans({r.band: r.sets for r in bands}, edges, percent)

    # one exchange by entry serves the removal of repeats and the count
    index = _index(src, words, edges, plans, percent).repartition("entry").dropDuplicates(["entry", "key"])
    members = F.count(F.lit(1)).over(Window.partitionBy("entry"))
    shared = materialise(index.withColumn("members", members).filter("members > 1"), "index")

    company = shared.groupBy("key").agg(F.sum(F.col("members") - 1).alias("company"))
    place = F.row_number().over(Window.partitionBy("entry").orderBy(F.desc("company"), "key"))
    hubs = shared.join(company, "key").withColumn("place", place).filter(F.col("place") <= HUBS).select("entry", F.col("key").alias("hub"))
    narrow = materialise(classes.join(company.select("key"), "key").select("key", "n", *marks), "classes-shared")

    twice = sets.groupBy("doc_id").agg(F.min("key").alias("a"), F.max("key").alias("high")).filter("a != high and doc_id is not null")
    same_id = sets.join(twice, "doc_id").select("a", F.col("key").alias("b")).filter("a != b").distinct()
    star = shared.select("entry", "key").join(hubs, "entry").filter("key != hub").groupBy("key", "hub").agg(F.count(F.lit(1)).alias("met"))
    best = F.row_number().over(Window.partitionBy("key").orderBy(F.desc("met"), "hub"))
    star = star.withColumn("best", best).filter(F.col("best") <= BEST_HUBS).select(*_pair("key", "hub")).distinct()
    near = _near(_bounded(star, narrow, percent), classes, percent)
    linked = materialise(same_id, "links").unionByName(_links(near, classes, src, words, percent))
    parts = materialise(components(linked), "components")
    rest = _near(_cross_pairs(_open_buckets(shared, parts), narrow, percent).join(near, ["a", "b"], "left_anti"), classes, percent)
    if not rest.isEmpty():
        linked = linked.unionByName(_links(rest, classes, src, words, percent))
    parts = components(linked)

    placed = classes.select("key", "first").join(parts.select(F.col("id").alias("key"), "component"), "key", "left").select(
        "key", "first", F.coalesce("component", "key").alias("component"))
    smallest = placed.groupBy("component").agg(F.min("first").alias("component_id"))
    named = placed.join(smallest, "component").select("key", "component", "component_id")
    return profile.select("doc_id", F.col("n").alias("n_shingles"), F.when(F.col("n") > 0, F.col("key")).alias("key")), named


def jaccard_components(docs: DataFrame, words: int = 5, percent: int = 80, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, n_shingles, component_id`` (smallest id reachable by links) of every row of ``docs``."""
    rows, named = _members(docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")), words, percent)
    out = rows.join(named, "key", "left")
    return out.select("doc_id", "n_shingles", F.coalesce("component_id", "doc_id").alias("component_id"))


def keep_first(docs: DataFrame, words: int = 5, percent: int = 80) -> DataFrame:
    """One row of each component of ``docs``, and every row with an empty set.

    The row with the smallest id stays (null ids last); of rows of equal id, or
    of a component without ids, the one whose text's hash, then whole row, is
    smallest.
    """
    rows, named = _members(docs.select("doc_id", "text"), words, percent)
    id_ = next(x for x in (f"_id{k}" for k in count()) if x not in {c.lower() for c in docs.columns})
    gone = rows.join(named, "key").filter(F.col("component_id") < F.col("doc_id")).select(F.col("doc_id").alias(id_)).distinct()
    again = rows.groupBy(F.col("doc_id").alias(id_)).agg(F.count(F.lit(1)).alias("n")).filter(F.col(id_).isNull() | (F.col("n") > 1)).select(id_)
    if again.isEmpty():
        return docs.join(gone, F.col("doc_id") == F.col(id_), "left_anti")
    same = F.col("doc_id").eqNullSafe(F.col(id_))
    single = docs.join(again, same, "left_anti").join(gone, F.col("doc_id") == F.col(id_), "left_anti")
    # rows without an id of their own are told apart by their sets, which are made again
    found = _profile(docs.join(again, same, "left_semi").select(F.struct("*").alias("doc_id"), "text"), words).select(F.col("doc_id").alias("row"), "n", "key")
    empty = found.filter("n = 0").select("row.*")
    rivals = found.filter("n > 0").join(named, "key").filter(F.col("component_id").isNull() | (F.col("component_id") == F.col("row.doc_id")))
    best = rivals.groupBy("component").agg(F.min(F.struct(F.xxhash64("row.text").alias("hash"), "row")).alias("best"))
    return single.unionByName(empty).unionByName(best.select("best.row.*"))
