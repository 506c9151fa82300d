"""Source divergence audit by token-start pointer sort (operator 12).

How differently do the sources of a language use its words?  A word's share in
a source, in units of 10^-9 with ``ADD`` added to every count, is
p = 1 + floor(10^9 (count + 5) / (N + 5 V)); sources are compared by the sum of
|p - q| over all kept words, and each source lists the words that it holds
more of than its language.

1. A task reads its texts in Arrow's own buffer, a shard of rows at a time.
   One pointer is kept for each word start; a multikey quicksort orders the
   pointers by the words they point at, eight bytes at a time: three-way
   partitions around a pivot until a slice is small, then one sort of the next
   eight bytes for all runs of the slice that are still equal.  Runs of equal
   words yield, for each (lang, source), the count and the number of documents.
2. Counts are added up by (lang, source, word), partial sums first, so neither
   a frequent word nor a large source meets in one task before it is summed.
   Words in at least ``min_docs`` documents of the language are kept.
3. Pairs of sources: kept words are dealt into blocks; a block holds the
   matrix of its words and the language's sources (about CELLS cells, a source
   without a word has its share of count 0) and adds up |p - q| for a tile of
   about TILE sources against all; the blocks' sums are added.  No row per pair
   and word is made.
4. Words of a source: differences by columns, ranked in a window whose limit
   Spark applies in each task before the exchange.

All arithmetic is exact in whole numbers.

Edge cases: null text, lang and source are empty strings; a group without
words has p of count 0; without kept words every pair's value is 0; repeated
rows (and null ids) are documents of their own; an empty table gives an empty
result; other columns are ignored.  Memory follows the shard, which is bounded
by bytes, or one very long text.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tabstack.llm.common import map_batches, materialise

MIN_DOCS = 30
ADD = 5
UNIT = 1_000_000_000
TOP = 50
LEAF = 1 << 15          # slices of at most so many pointers are finished by sorting
LONG = 64               # bytes after which the few words still equal are compared whole
SHARD_BYTES = 2 << 20
CELLS = 1 << 20         # words x sources of a block
TILE = 256              # sources of a tile

WORD_BYTE = np.ones(256, bool)        # all bytes but 00-40, 5B-60 and 7B-7F (hexadecimal)
WORD_BYTE[:0x41] = WORD_BYTE[0x5B:0x61] = WORD_BYTE[0x7B:0x80] = False
LOWER = np.arange(256, dtype=np.uint8)
LOWER[ord("A"):ord("Z") + 1] += 32


def word_pointers(text: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and lengths of the words of a buffer whose documents begin at ``offsets`` (and end at the last)."""
    word = WORD_BYTE[text]
    starts, ends = word.copy(), word.copy()
    starts[1:] &= ~word[:-1]
    ends[:-1] &= ~word[1:]
    inner = offsets[1:-1]
    inner = inner[(inner > 0) & (inner < len(text))]        # words end with their document
    starts[inner] = word[inner]
    ends[inner - 1] = word[inner - 1]
    start = np.flatnonzero(starts)
    return start, np.flatnonzero(ends) + 1 - start


class Words:
    """The words of a buffer, read eight bytes at a time as numbers that sort as the bytes do; 0 after the end (no word holds a zero byte)."""

    def __init__(self, text: np.ndarray, start: np.ndarray, length: np.ndarray):
        self.text, self.start, self.length = text, start, length
        padded = np.concatenate([text, np.zeros(8, np.uint8)])
        self.at = np.ndarray(len(text) + 1, ">u8", padded, strides=(1,))

    def slices(self, pointers: np.ndarray, depth: int) -> np.ndarray:
        raw = self.at[np.minimum(self.start[pointers] + depth, len(self.text))].astype(np.uint64)
        left = np.clip(self.length[pointers] - depth, 0, 8)
        cut = np.uint64(8) * np.minimum(8 - left, 7).astype(np.uint64)
        return np.where(left == 0, np.uint64(0), (raw >> cut) << cut)

    def whole(self, pointer: int) -> bytes:
        return self.text[self.start[pointer]: self.start[pointer] + self.length[pointer]].tobytes()


def _goes_on(key: np.ndarray) -> np.ndarray:
    return (key & np.uint64(0xFF)) != 0


def _finish(words: Words, own: np.ndarray, depth: int) -> tuple[np.ndarray, np.ndarray]:
    """Sort a small slice whose words agree up to ``depth``; also the places where runs of equal words begin."""
    key = words.slices(own, depth)
    place = np.argsort(key)
    own, key = own[place], key[place]
    new = np.concatenate([[True], key[1:] != key[:-1]])
    while True:
        depth += 8
        run = np.cumsum(new) - 1
        at = np.flatnonzero((np.bincount(run)[run] > 1) & _goes_on(key))
        if not len(at):
            return own, np.flatnonzero(new)
        inside = run[at]
        if depth >= LONG:
            rest = [words.whole(p) for p in own[at]]
            place = np.array(sorted(range(len(at)), key=lambda i: (inside[i], rest[i])))
            differs = np.array([rest[i] != rest[j] for i, j in zip(place[1:], place[:-1])], bool)
            key[:] = 0
        else:
            following = words.slices(own[at], depth)
            place = np.lexsort((following, inside))
            following = following[place]
            differs = following[1:] != following[:-1]
            key[:] = 0
            key[at] = following
        own[at] = own[at][place]
        new[at[1:]] |= differs & (inside[1:] == inside[:-1])


def sort_pointers(words: Words) -> tuple[np.ndarray, np.ndarray]:
    """Pointers in the order of their words, and the places where runs of equal words begin."""
    order, first, done = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)], 0
    todo: list[tuple[np.ndarray, int | None]] = [(np.arange(len(words.start)), 0)]
    while todo:
        own, depth = todo.pop()
        if not len(own):
            continue
        if depth is None:                   # equal words
            runs = np.zeros(1, np.int64)
        elif len(own) <= LEAF:
            own, runs = _finish(words, own, depth)
        else:
            key = words.slices(own, depth)
            sample = np.sort(key[:: len(key) // 64 + 1])
            pivot = sample[len(sample) // 2]
            todo += [(own[key > pivot], depth), (own[key == pivot], depth + 8 if _goes_on(pivot) else None), (own[key < pivot], depth)]
            continue
        order.append(own)
        first.append(runs + done)
        done += len(own)
    return np.concatenate(order), np.concatenate(first)


def shard_counts(text: np.ndarray, offsets: np.ndarray, group: np.ndarray) -> tuple[list[bytes], np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Words of a shard; then, for each word and group that holds it: word, group, occurrences, documents."""
    start, length = word_pointers(text, offsets)
    words = Words(text, start, length)
    order, first = sort_pointers(words)
    run = np.zeros(len(order), np.int64)
    run[first[1:]] = 1
    run = np.cumsum(run)
    doc = np.searchsorted(offsets, start[order], side="right") - 1
    groups, documents = int(group.max(initial=0)) + 1, len(group)
    code, n = np.unique(run * groups + group[doc], return_counts=True)
    once = np.unique(run * documents + doc)
    docs = np.unique(once // documents * groups + group[once % documents], return_counts=True)[1]
    return [words.whole(p) for p in order[first]], code // groups, code % groups, n, docs


def _shards(offsets: np.ndarray) -> Iterator[tuple[int, int]]:
    at = 0
    while at < len(offsets) - 1:
        end = max(at + 1, int(np.searchsorted(offsets, offsets[at] + SHARD_BYTES, side="right")) - 1)
        yield at, end
        at = end


def word_counts(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """``lang, source, term (bytes), n, docs`` of every word of every group; a group's row without term says that it occurs."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            lang, source, texts = b.columns
            _, starts, data = texts.buffers()
            width = np.int64 if pa.types.is_large_binary(texts.type) else np.int32
            at = np.frombuffer(starts, width)[texts.offset: texts.offset + len(texts) + 1].astype(np.int64)
            raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
            places = list(zip(lang.to_pylist(), source.to_pylist()))
            for lo, hi in _shards(at):
                code = {g: k for k, g in enumerate(dict.fromkeys(places[lo:hi]))}
                group = np.array([code[g] for g in places[lo:hi]])
                words, word, own, n, docs_of = shard_counts(LOWER[raw[at[lo]: at[hi]]], at[lo: hi + 1] - at[lo], group)
                names = pa.array([*words, None], pa.binary())
                none = np.zeros(len(code), np.int64)
                own = np.concatenate([own, np.arange(len(code))])
                of = lambda k: pa.array([g[k] for g in code], pa.string()).take(pa.array(own))
                yield pa.RecordBatch.from_arrays(
                    [of(0), of(1), names.take(pa.array(np.concatenate([word, none + len(words)]))),
                     pa.array(np.concatenate([n, none])), pa.array(np.concatenate([docs_of, none]))],
                    names=["lang", "source", "term", "n", "docs"])

    named = [F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("lang", "source")]
    src = docs.select(*named, F.coalesce(F.col(text_col), F.lit("")).cast("binary").alias("text"))
    found = map_batches(src, run, "lang string, source string, term binary, n bigint, docs bigint")
    return found.groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))


def share(count: np.ndarray, total: np.ndarray) -> np.ndarray:
    """1 + floor(10^9 (count + ADD) / total), by long division in steps of 1000, so that 64 bits hold all of it."""
    rest, out = count + ADD, np.zeros(np.broadcast_shapes(count.shape, total.shape), np.int64)
    for _ in range(3):
        rest = rest * 1000
        out = out * 1000 + rest // total
        rest = rest % total
    return out + 1


def _share(count: str, total: str) -> Column:
    return F.expr(f"1 + (CAST({UNIT} AS DECIMAL(10,0)) * CAST({count} + {ADD} AS DECIMAL(20,0))) div CAST({total} + {ADD} * v AS DECIMAL(20,0))")


def _pair_sums(words: pd.DataFrame, groups: pd.DataFrame) -> pd.DataFrame:
    """One block and tile: sums of |p - q| over the block's words, of the tile's sources and all others."""
    groups = groups.sort_values("source")
    source = groups["source"].to_numpy()
    term, names = pd.factorize(words["term"])
    count = np.zeros((len(source), len(names)), np.int64)
    place = {s: k for k, s in enumerate(source)}
    count[words["source"].map(place).to_numpy(np.int64), term] = words["n"].to_numpy()
    p = share(count, (groups["own"] + ADD * groups["v"]).to_numpy()[:, None]) if len(names) else count
    out = []
    for k in np.flatnonzero(groups["mine"].to_numpy()):
        value = np.abs(p - p[k]).sum(axis=1)
        other = np.arange(len(source)) != k
        out.append(pd.DataFrame({"lang": groups["lang"].iloc[0], "source": source[k], "item": source[other], "value": value[other]}))
    return pd.concat(out) if out else pd.DataFrame({"lang": [], "source": [], "item": [], "value": np.zeros(0, np.int64)})


def source_pairs(table: DataFrame, groups: DataFrame) -> DataFrame:
    """``lang, source, item, value`` of every ordered pair of a language's sources."""
    sizes = groups.groupBy("lang").agg(F.count(F.lit(1)).alias("sources"), F.max("v").alias("v"))
    dealt = sizes.select("lang", F.greatest(F.lit(1), F.ceil(F.col("v") * F.col("sources") / CELLS)).cast("int").alias("blocks"),
                         F.ceil(F.col("sources") / TILE).cast("int").alias("tiles"))
    every = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    left = (table.join(dealt, "lang").withColumn("block", F.pmod(F.xxhash64("term"), F.col("blocks")).cast("int"))
            .withColumn("tile", every("tiles")).select("lang", "block", "tile", "source", "term", "n"))
    right = (groups.join(dealt, "lang").withColumn("block", every("blocks")).withColumn("tile", every("tiles"))
             .withColumn("mine", F.pmod(F.xxhash64("source"), F.col("tiles")) == F.col("tile")).select("lang", "block", "tile", "source", "own", "v", "mine"))
    key = ("lang", "block", "tile")
    parts = left.groupBy(*key).cogroup(right.groupBy(*key)).applyInPandas(_pair_sums, "lang string, source string, item string, value bigint")
    return parts.groupBy("lang", "source", "item").agg(F.sum("value").alias("value"))


def audit(docs: DataFrame, min_docs: int = MIN_DOCS, top: int = TOP, text_col: str = "text") -> DataFrame:
    """``lang, source, part, item, value, rank``: parts ``pair`` (other sources of the language) and ``term`` (words in excess)."""
    counts = materialise(word_counts(docs, text_col), "divergence-counts")
    words = counts.filter("term is not null")
    kept = words.groupBy("lang", "term").agg(F.sum("docs").alias("docs"), F.sum("n").alias("everywhere")).filter(F.col("docs") >= min_docs).drop("docs")
    table = materialise(words.drop("docs").join(kept, ["lang", "term"]), "divergence-kept")
    totals = kept.groupBy("lang").agg(F.count(F.lit(1)).alias("v"), F.sum("everywhere").alias("total"))
    own = table.groupBy("lang", "source").agg(F.sum("n").alias("own"))
    groups = materialise(counts.filter("term is null").select("lang", "source").join(own, ["lang", "source"], "left").join(totals, "lang", "left")
                         .fillna(0, ["own", "v", "total"]), "divergence-groups")

    def ranked(part: str, rows: DataFrame, item: Column) -> DataFrame:
        order = F.row_number().over(Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item"))
        return rows.withColumn("rank", order).select("lang", "source", F.lit(part).alias("part"), item.alias("item"), "value", "rank")

    more = (table.join(groups, ["lang", "source"]).withColumn("value", _share("n", "own") - _share("everywhere", "total"))
            .filter("value > 0").select("lang", "source", F.col("term").alias("item"), "value"))
    # bytes sort as UTF-8 does
    return ranked("pair", source_pairs(table, groups), F.col("item")).unionByName(
        ranked("term", more, F.col("item").cast("string")).filter(F.col("rank") <= top))
