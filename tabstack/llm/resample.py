"""Target-distribution importance resampling by batch concatenation (operator 11).

A text's features are its words and pairs of neighbouring words, hashed into
buckets.  A bucket's gain compares how often target texts and the corpus hold
it; a text's weight is the mean gain of its features; weight plus Gumbel noise
(drawn from a hash of the id) ranks the texts, and the highest are drawn.

Features are found a batch at a time: the batch's texts are joined with a
sentinel that no word can hold, one regex pass finds all words, the documents'
offsets (searchsorted) tell whose each word is and mask pairs that cross from
one document into the next, and bincount adds up buckets and weights.  A pair's
crc32 follows from those of its words, for all pairs of the batch at once.

Over a corpus: each task adds up its own bucket counts (at most ``buckets``
rows a task go into the sum), and a second pass over the texts, which now know
the gains, yields the scores.  Making the features twice costs CPU time, but
writes nothing; keeping them would write more than the texts.

Ranks need no global sort: a score is a whole number, so one count per score
value (gains lie between -ln and +ln of the largest count, the noise between
-3131 and 22874: some 10^5 values at any size of the corpus) gives the cut and
the rank before each score, and rows of equal score are ordered among
themselves.  The noise differs from id to id, so no score is hot.

Edge cases: null text has no features and weight 0; a null id draws its noise
as empty text and ranks after all ids of its score; repeated rows each have a
row and a rank; an empty corpus gives an empty result, an empty target the
gains that follow from T = 0; other columns are ignored.  Memory follows the
batch, which is bounded by bytes, or one very long text.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections.abc import Iterator
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tabstack.llm.common import map_batches, materialise

BUCKETS = 10_000
MIN_WORDS = 20
PERCENT = 25
SEED = "7"
WORD = re.compile(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
WORD_BYTE = np.array([bool(WORD.match(bytes([k]))) for k in range(256)])
SENTINEL = b"\x00"            # no word holds it
SHORT = 64                    # bytes of a word up to which tables continue a crc32
JOINED_BYTES = 1 << 20        # texts are joined up to about this size


def joined(texts: list[bytes | None], size: int = JOINED_BYTES) -> Iterator[tuple[int, int, bytes, np.ndarray]]:
    """(first, last + 1, joined texts, their offsets) for runs of texts of about ``size`` bytes, A-Z lower-cased."""
    first, total = 0, 0
    for k, t in enumerate(texts):
        total += len(t or b"") + 1
        if total >= size or k == len(texts) - 1:
            part = [t or b"" for t in texts[first: k + 1]]
            offsets = np.concatenate([[0], np.cumsum([len(t) + 1 for t in part])[:-1]])
            yield first, k + 1, SENTINEL.join(part).lower(), offsets     # bytes.lower() changes A-Z only
            first, total = k + 1, 0


def _shift_tables() -> np.ndarray:
    """[length, byte, value]: the crc32 of ``value`` in that byte after ``length`` zero bytes; crc32 is linear, so a whole crc is the xor of its bytes."""
    byte = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        byte = np.where(byte & 1, (byte >> 1) ^ np.uint32(0xEDB88320), byte >> 1)
    out = [np.arange(256, dtype=np.uint32)[None] << np.uint32(8) * np.arange(4, dtype=np.uint32)[:, None]]
    for _ in range(SHORT):
        out.append((out[-1] >> np.uint32(8)) ^ byte[out[-1] & np.uint32(255)])
    return np.array(out)


SHIFT = _shift_tables()


def continued(before: np.ndarray, length: np.ndarray, after: np.ndarray) -> np.ndarray:
    """crc32 of two texts in a row, from the crc32 of each and the length (at most SHORT) of the second."""
    for k in range(4):
        after = after ^ SHIFT[length, k, (before >> np.uint32(8 * k)) & np.uint32(255)]
    return after


def features(text: bytes, offsets: np.ndarray, buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """Bucket and document (place in ``offsets``) of every feature of the joined texts."""
    words = WORD.findall(text)
    inside = np.concatenate([[False], WORD_BYTE[np.frombuffer(text, np.uint8)], [False]])
    edge = np.flatnonzero(inside[1:] != inside[:-1])
    start, length = edge[::2], edge[1::2] - edge[::2]
    first = np.searchsorted(start, offsets)                     # the first word of each document
    doc = np.repeat(np.arange(len(offsets)), np.diff(first, append=len(words)))
    one = np.fromiter(map(crc32, words), np.uint32, len(words))
    spaced = continued(one, np.ones(len(one), np.int64), np.uint32(crc32(b" ")))
    two = continued(spaced[:-1], np.minimum(length[1:], SHORT), one[1:])
    for k in np.flatnonzero(length[1:] > SHORT).tolist():
        two[k] = crc32(words[k + 1], int(spaced[k]))
    same = doc[1:] == doc[:-1]
    h = np.concatenate([one, two[same]])
    return (h % np.uint32(buckets)).astype(np.int64), np.concatenate([doc, doc[1:][same]])


def bucket_counts(texts: DataFrame, text_col: str = "text", buckets: int = BUCKETS) -> DataFrame:
    """``bucket, n``: how many features of all texts each bucket holds; buckets without any are left out."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros(buckets, np.int64)
        for b in batches:
            for _, _, text, offsets in joined(b.column(0).to_pylist()):
                sums += np.bincount(features(text, offsets, buckets)[0], minlength=buckets)
        at = np.flatnonzero(sums)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(sums[at])], names=["bucket", "n"])

    own = map_batches(texts.select(F.col(text_col).cast("binary").alias("text")), run, "bucket bigint, n bigint")
    return own.groupBy("bucket").agg(F.sum("n").alias("n"))


def gains(corpus: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Gain of each bucket from the feature counts of corpus and target."""
    n, s, t = len(corpus), float(corpus.sum()), float(target.sum())
    return np.array([math.floor(1000 * math.log((float(y) + 1) * (s + n) / ((float(x) + 1) * (t + n)))) for x, y in zip(corpus.tolist(), target.tolist())], np.int64)


def noise(doc_id, seed: str = SEED) -> int:
    h = int(hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()[:8], 16)
    return math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))


def scores(docs: DataFrame, gain: np.ndarray, id_col: str = "doc_id", text_col: str = "text", seed: str = SEED) -> DataFrame:
    """``doc_id, n_features, weight, score`` of every row."""
    id_type = docs.schema[id_col].dataType.simpleString()
    buckets = len(gain)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            size, total = np.zeros(b.num_rows, np.int64), np.zeros(b.num_rows, np.int64)
            for first, last, text, offsets in joined(b.column(1).to_pylist()):
                bucket, doc = features(text, offsets, buckets)
                size[first:last] = np.bincount(doc, minlength=last - first)
                # whole numbers far below 2^53, so the doubles are exact
                total[first:last] = np.bincount(doc, gain[bucket], minlength=last - first).astype(np.int64)
            weight = total // np.maximum(size, 1)
            drawn = np.fromiter((noise(x, seed) for x in b.column(0).to_pylist()), np.int64, b.num_rows)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(size), pa.array(weight), pa.array(weight + drawn)],
                                             names=["doc_id", "n_features", "weight", "score"])

    src = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("binary").alias("text"))
    return map_batches(src, run, f"doc_id {id_type}, n_features bigint, weight bigint, score bigint")


def rank_highest(scored: DataFrame, eligible: str, percent: int) -> DataFrame:
    """``scored`` with ``rank`` (from 1) of the ``percent`` % highest scores among the eligible rows, ties to smaller ids; null for others."""
    counts = scored.filter(eligible).groupBy("score").agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("score")).collect()   # a row per score value
    left = percent * sum(r.n for r in counts) // 100
    before, place = [], 0
    for r in counts:
        if place >= left:
            break
        before.append((r.score, place))
        place += r.n
    scored = scored.withColumn("rank", F.lit(None).cast("long"))
    if not before:
        return scored
    high = f"({eligible}) AND score >= {before[-1][0]}"
    # one row per drawn score value, so within the bound of the counts
    offsets = F.broadcast(scored.sparkSession.createDataFrame(before, "score long, before long"))
    inside = F.row_number().over(Window.partitionBy("score").orderBy(F.col("doc_id").asc_nulls_last()))
    ranked = scored.filter(high).drop("rank").withColumn("inside", inside).join(offsets, "score")
    rank = F.col("before") + F.col("inside")
    ranked = ranked.withColumn("rank", F.when(rank <= left, rank)).select(*scored.columns)
    return scored.filter(f"NOT ({high})").unionByName(ranked)


def resample(spark: SparkSession, docs: DataFrame, target: DataFrame, id_col: str = "doc_id", text_col: str = "text",
             buckets: int = BUCKETS, min_words: int = MIN_WORDS, percent: int = PERCENT, seed: str = SEED) -> DataFrame:
    """``doc_id, n_features, weight, score, rank`` of every row of ``docs``; the target's texts stand in its column ``text``."""
    def counted(texts: DataFrame, col: str) -> np.ndarray:
        out = np.zeros(buckets, np.int64)
        for r in bucket_counts(texts, col, buckets).collect():     # at most ``buckets`` rows
            out[r.bucket] = r.n
        return out

    gain = gains(counted(docs, text_col), counted(target, "text"))
    scored = materialise(scores(docs, gain, id_col, text_col, seed), "resample-scores")
    # n words have 2 n - 1 features
    return rank_highest(scored, f"n_features >= {max(0, 2 * min_words - 1)}", percent).withColumnRenamed("doc_id", id_col)
