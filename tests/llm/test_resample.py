import hashlib
import math
import random
import re
from zlib import crc32

import numpy as np
import pytest
from pyspark.sql import functions as F

from tabstack.llm import resample as R

LOWER = {c: c + 32 for c in range(65, 91)}


def words(text):
    return re.findall("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", (text or "").translate(LOWER))


def buckets_of(text, n):
    w = words(text)
    return [crc32(x.encode()) % n for x in w + [a + " " + b for a, b in zip(w, w[1:])]]


def brute(rows, target, n, least, percent):
    s, t = np.zeros(n, int), np.zeros(n, int)
    for _, x in rows:
        np.add.at(s, buckets_of(x, n), 1)
    for x in target:
        np.add.at(t, buckets_of(x, n), 1)
    out = []
    for i, x in rows:
        f = buckets_of(x, n)
        gain = [math.floor(1000 * math.log((t[b] + 1) * (s.sum() + n) / ((s[b] + 1) * (t.sum() + n)))) for b in f]
        weight = sum(gain) // len(gain) if gain else 0
        h = int(hashlib.sha256(f"7:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        out.append((i, len(f), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))))
    fit = sorted((r for r, (_, x) in zip(out, rows) if len(words(x)) >= least), key=lambda r: (-r[3], r[0] is None, r[0]))
    return out, [r[0] for r in fit[: percent * len(fit) // 100]]


def check(spark, docs, rows, target, n=97, least=3, percent=40):
    goal = spark.createDataFrame([(k, x) for k, x in enumerate(target)], "item_id long, text string")
    got = R.resample(spark, docs, goal, buckets=n, min_words=least, percent=percent).collect()
    want, drawn = brute(rows, target, n, least, percent)
    key = lambda r: (r[0] is None, r[0] or 0, *r[1:])
    assert sorted([tuple(r)[:4] for r in got], key=key) == sorted(want, key=key)
    assert [r.doc_id for r in sorted((r for r in got if r.rank is not None), key=lambda r: r.rank)] == drawn
    assert sorted(r.rank for r in got if r.rank is not None) == list(range(1, len(drawn) + 1))


def test_equals_brute_force(spark, docs_of):
    rng = random.Random(3)
    bits = ["the", "The", "cat", "Öl", "öl", "x1", "42", "naïve", "中文", "😀", "K", "--", ".", "\x00", "\n", "a\x7fb", " ", "İx", "q" * 63, "q" * 64, "q" * 65, "é" * 100]
    rows = [(k, rng.choice(["", " "]).join(rng.choices(bits, k=rng.randint(0, 60)))) for k in range(300)]
    check(spark, docs_of(rows), rows, ["the cat", "42 x1 öl", ""])


def test_edge_rows(spark, docs_of):
    long = "one two three " * 100_000
    rows = [(1, None), (2, ""), (3, "a b c d"), (3, "a b c d"), (None, "x y z"), (4, long), (5, "w" * 3_000_000), (6, "... !!"), (7, "a\x00b c d")]
    docs = docs_of(rows)
    check(spark, docs, rows, ["a b", None], percent=100)
    clash = docs.withColumn("score", F.lit("x")).withColumn("rank", F.lit(1)).withColumn("n", F.lit(1)).withColumn("before", F.lit(0))
    check(spark, clash, rows, [])
    check(spark, docs.limit(0), [], ["a b"])
    check(spark, docs_of([(1, "a b c")]), [(1, "a b c")], ["q"], percent=25)      # a quarter of one row: none


@pytest.mark.parametrize("size", [1, 40, 1 << 20])
def test_pairs_never_cross_documents(size):
    texts = [b"a b", None, b"", b"C d e", b"f"]
    seen = []
    for first, last, text, offsets in R.joined(texts, size):
        bucket, doc = R.features(text, offsets, 1 << 20)
        seen += [(first + int(d), int(b)) for d, b in zip(doc, bucket)]
        assert last - first == len(offsets)
    h = lambda x: crc32(x) % (1 << 20)
    assert sorted(seen) == sorted([(0, h(b"a")), (0, h(b"b")), (0, h(b"a b")), (3, h(b"c")), (3, h(b"d")), (3, h(b"e")), (3, h(b"c d")), (3, h(b"d e")), (4, h(b"f"))])


def test_ties_of_score_go_by_id(spark):
    scored = spark.createDataFrame([(k, 50, 0, k % 3) for k in range(30)] + [(99, 5, 0, 9)], "doc_id long, n_features long, weight long, score long")
    got = {r.doc_id: r["rank"] for r in R.rank_highest(scored, "n_features >= 39", 50).collect()}
    order = [k for s in (2, 1, 0) for k in range(30) if k % 3 == s]
    assert got == {k: (order.index(k) + 1 if order.index(k) < 15 else None) for k in range(30)} | {99: None}
