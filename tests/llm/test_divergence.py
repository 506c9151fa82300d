import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from tabstack.llm import divergence as D

LOWER = {c: c + 32 for c in range(65, 91)}
SCHEMA = "doc_id long, text string, lang string, source string"


def words(text):
    return re.findall("[^\x00-\x40\x5b-\x60\x7b-\x7f]+", (text or "").translate(LOWER))


def brute(rows, least=30, top=50):
    df, n, groups = defaultdict(Counter), defaultdict(Counter), defaultdict(set)
    for _, text, lang, source in rows:
        lang, source = lang or "", source or ""
        groups[lang].add(source)
        w = words(text)
        df[lang].update(set(w))
        n[lang, source].update(w)
    out = []
    for lang, sources in groups.items():
        kept = sorted(t for t, c in df[lang].items() if c >= least)
        v = len(kept)
        share = lambda count: {t: 1 + 10**9 * (count[t] + 5) // (sum(count[x] for x in kept) + 5 * v) for t in kept}
        p = {s: share(n[lang, s]) for s in sources}
        q = share(sum((n[lang, s] for s in sources), Counter()))
        for s in sources:
            pairs = sorted(((sum(abs(p[s][t] - p[o][t]) for t in kept), o) for o in sources if o != s), key=lambda x: (-x[0], x[1].encode()))
            terms = sorted(((p[s][t] - q[t], t) for t in kept if n[lang, s][t] and p[s][t] > q[t]), key=lambda x: (-x[0], x[1].encode()))[:top]
            out += [(lang, s, part, item, value, k) for part, found in (("pair", pairs), ("term", terms)) for k, (value, item) in enumerate(found, 1)]
    return sorted(out)


def rows_of(rng, n):
    bits = ["The", "the", "cat", "Öl", "öl", "naïve", "中文字", "😀", "x1y", "K", "a" * 7, "a" * 8, "a" * 9, "a" * 17, "a" * 80, "a" * 79 + "b", "A" * 8 + "é", "-", "\x00", "é"]
    return [(k, rng.choice(["", " ", "\n"]).join(rng.choices(bits, k=rng.randint(0, 30))), rng.choice(["en", "de", None]), rng.choice(["s1", "s2", "é", "", None, "z"])) for k in range(n)]


def test_equals_brute_force(spark):
    rows = rows_of(random.Random(8), 400)
    got = D.audit(spark.createDataFrame(rows, SCHEMA), min_docs=12, top=9)
    assert sorted(map(tuple, got.collect())) == brute(rows, 12, 9)


def test_blocks_and_tiles_agree(spark, monkeypatch):
    rows = [(k, t, "en", f"s{k % 23}") for k, (_, t, _, _) in enumerate(rows_of(random.Random(2), 300))]
    monkeypatch.setattr(D, "CELLS", 40)
    monkeypatch.setattr(D, "TILE", 5)
    got = D.audit(spark.createDataFrame(rows, SCHEMA), min_docs=3)
    assert sorted(map(tuple, got.collect())) == brute(rows, 3)


def test_edge_rows(spark):
    rows = [(1, None, "en", "a"), (2, "", "en", "b"), (3, "cat dog", "en", "c"), (3, "cat dog", "en", "c"), (None, "cat", None, None), (4, "42 !", "de", "x"),
            (5, "x" * 3_000_000 + " cat", "en", "a"), (6, "dog " * 200_000, "en", "a"), (7, "x" * 3_000_000, "en", "b")]
    df = spark.createDataFrame(rows, SCHEMA).withColumn("term", F.lit("clash")).withColumn("n", F.lit(1)).withColumn("docs", F.lit(2)).withColumn("v", F.lit(3))
    got = sorted(map(tuple, D.audit(df, min_docs=2).collect()))
    assert got == brute(rows, 2) and any(len(r[3]) == 3_000_000 for r in got)
    assert sorted(map(tuple, D.audit(df).collect())) == brute(rows) and {r[4] for r in brute(rows)} == {0}
    assert D.audit(df.limit(0)).count() == 0


@pytest.mark.parametrize("leaf", [3, 100, 1 << 15])
def test_pointers_sort_as_words(monkeypatch, leaf):
    monkeypatch.setattr(D, "LEAF", leaf)
    monkeypatch.setattr(D, "LONG", 24)
    rng = random.Random(leaf)
    docs = ["".join(rng.choices(["a", "b", "ab", " ", "é", "a" * 8, "b" * 30], k=rng.randint(0, 60))).encode() for _ in range(200)]
    text, offsets = np.frombuffer(b"".join(docs), np.uint8), np.cumsum([0, *map(len, docs)])
    start, length = D.word_pointers(text, offsets)
    want = [w for d in docs for w in re.findall(rb"[^\x00-\x40\x5b-\x60\x7b-\x7f]+", d)]
    found = D.Words(text, start, length)
    assert [found.whole(k) for k in range(len(start))] == want
    order, first = D.sort_pointers(found)
    ordered = [found.whole(p) for p in order]
    assert ordered == sorted(want) and first.tolist() == [k for k in range(len(ordered)) if not k or ordered[k] != ordered[k - 1]]


def test_share_is_exact():
    rng = random.Random(1)
    for _ in range(500):
        total = rng.randint(1, 9 * 10**15)
        c = rng.randint(0, max(0, total - 5))
        assert int(D.share(np.array([c]), np.array([total]))[0]) == 1 + 10**9 * (c + 5) // total
