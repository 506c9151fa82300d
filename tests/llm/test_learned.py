import math
from collections import Counter
from zlib import crc32

import numpy as np
from pyspark.sql import functions as F

from tabstack.llm import langid, lm, toxicity
from tabstack.llm.common import id_remainder
from tabstack.llm.queries import QUERIES

SF = "/root/testdata/sf0.01"


def test_language_held_out_accuracy(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "lang")
    got = QUERIES["op2_language_id"](spark, SF).join(docs, "doc_id").collect()
    held = [r for r in got if r.held_out]
    assert len(got) == 1000 and all(r.held_out == (crc32(str(r.doc_id).encode()) % 4 == 2) for r in got)
    assert np.mean([r.lang == r.lang_pred for r in held]) > 0.98
    assert all(0 <= r.score <= 1 for r in got)


def test_em_finds_the_mixture():
    rng = np.random.default_rng(0)
    p = rng.dirichlet(np.full(500, 0.05), size=3).T + 1e-6
    p /= p.sum(axis=0)
    one = np.bincount(rng.choice(500, 3000, p=p[:, 2] / p[:, 2].sum()), minlength=500)
    mix = p[:, 0] * 0.7 + p[:, 1] * 0.3
    two = np.bincount(rng.choice(500, 3000, p=mix / mix.sum()), minlength=500)
    for counts, want in ((one, {2: 1.0}), (two, {0: 0.7, 1: 0.3})):
        at = np.flatnonzero(counts)
        got = dict(langid.infer(p, at, counts[at]))
        assert got.keys() == want.keys() and all(abs(got[k] - v) < 0.05 for k, v in want.items())


def test_language_edge_rows(spark, docs_of):
    docs = docs_of([(1, "the cat and the dog"), (2, None), (3, ""), (4, "12 34 !!"), (4, "12 34 !!"), (None, "the dog"), (5, "x" * 50_000)])
    langs, model = langid.fit(docs.withColumn("lang", F.when(F.col("doc_id") == 1, "en")), F.lit(True))
    got = sorted((r.doc_id or 0, r.lang_pred, r.score) for r in langid.predict(docs.withColumn("score", F.lit("clash")), langs, model).collect())
    assert got == [(0, "en", 1.0), (1, "en", 1.0), (2, "und", 0.0), (3, "und", 0.0), (4, "und", 0.0), (4, "und", 0.0), (5, "en", 1.0)]
    none = langid.fit(docs.limit(0), F.lit(True))
    assert none[0] == [] and {r.lang_pred for r in langid.predict(docs, *none).collect()} == {"und"}
    assert langid.predict(docs.limit(0), langs, model).count() == 0


def test_letters_of_every_plane_are_letters():
    text = "".join(chr(c) for c in range(0x31350, 0x31390))
    assert len(langid.trigrams(text)[0]) and not len(langid.trigrams("\U0001F600 12 \U000E0020")[0])


def test_training_rows_alone_teach(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    train = id_remainder("doc_id", 4) != 2
    other = docs.withColumn("lang", F.when(train, F.col("lang")).otherwise("zz"))
    assert langid.fit(other, train)[0] == langid.fit(docs, train)[0]


def test_toxicity_held_out(spark):
    labels = spark.read.parquet("/root/testdata/sf0.1/labels.parquet").select("doc_id", "toxic")
    got = QUERIES["op5_toxicity"](spark, "/root/testdata/sf0.1").join(labels, "doc_id").filter("held_out").collect()
    y, s = np.array([r.toxic for r in got]), np.array([r.score for r in got])
    order = np.argsort(s)
    rank = np.empty(len(s))
    rank[order] = np.arange(len(s))
    auc = (rank[y == 1].sum() - y.sum() * (y.sum() - 1) / 2) / (y.sum() * (len(y) - y.sum()))
    assert np.mean((s >= 0.5) == y) > 0.93 and auc > 0.8
    assert np.mean(s[y == 0] < 0.5) > 0.98 and all(r.predicted == (r.score >= 0.5) for r in got)


def test_swap_penalty_evens_out_identity_terms():
    rng = np.random.default_rng(2)
    n = 600
    insult, group = rng.random(n) < 0.3, rng.random(n) < 0.5
    y = (insult | ((rng.random(n) < 0.3) & group)).astype(float)     # the group is named in toxic rows more often
    plain = [[0] * bool(a) + ([1] if g else [2]) for a, g in zip(insult, group)]
    other = [[0] * bool(a) + ([2] if g else [1]) for a, g in zip(insult, group)]
    free, _ = toxicity.fit_logistic(plain, other, y, np.ones(n), 3, swap_weight=0.0)
    even, _ = toxicity.fit_logistic(plain, other, y, np.ones(n), 3, swap_weight=1.0)
    assert abs(even[1] - even[2]) < 0.3 * abs(free[1] - free[2]) and even[0] > 1


def test_toxicity_edge_rows(spark, docs_of):
    docs = docs_of([(k, "you idiot moron" if k % 2 else "a fine day") for k in range(40)] + [(100, None), (101, ""), (None, "you idiot moron"), (7, "you idiot moron")])
    labels = spark.createDataFrame([(k, 1, k % 2) for k in range(40)] + [(100, None, None), (3, 0, None), (5, 0, 0)], "doc_id long, quality int, toxic int")
    model = toxicity.fit(docs, labels, F.lit(True))
    got = toxicity.score(docs.withColumn("score", F.lit("clash")), model).collect()
    assert len(got) == 44 and len({r.score for r in got if r.doc_id in (100, 101)}) == 1
    assert all((r.score >= 0.5) == ((1 if r.doc_id is None else r.doc_id) % 2 == 1) for r in got if r.doc_id not in (100, 101))
    flat = toxicity.fit(docs, labels.limit(0), F.lit(True))
    assert {round(r.score, 6) for r in toxicity.score(docs, flat).collect()} == {0.0}
    assert toxicity.score(docs.limit(0), model).count() == 0


def brute_counts(rows):
    grams, pairs = Counter(), Counter()
    seqs = {}
    for k, (i, text, train) in enumerate(rows):
        words = [*(text or "").encode().lower().split(), None]
        seqs[k] = words
        if train:
            grams.update(words)
            pairs.update(zip([None, *words], words))
    return seqs, grams, pairs


def test_lm_counts_and_scores(spark, docs_of):
    rows = [(1, "The cat sat on the mat", True), (2, "the cat ran", False), (3, None, True), (4, "", False), (5, "a\tB\x0bc  the", True),
            (5, "the cat sat on the mat", True), (6, "Über über", True), (None, "cat", True)]
    docs = docs_of([(i, t) for i, t, _ in rows]).withColumn("n_tokens", F.lit("clash"))
    train = F.coalesce(~F.col("doc_id").isin(2, 4), F.lit(True))
    out = {(r.doc_id, r.n_tokens, round(r.base_score, 9)): r for r in lm.score(docs, train, chunk_tokens=9, bucket_tokens=3).collect()}
    seqs, grams, pairs = brute_counts(rows)
    n, v = sum(grams.values()), len(grams)
    whole = lm.score(docs, train).collect()
    assert len(whole) == len(rows)
    for k, (i, _, _) in enumerate(rows):
        base = sum(math.log10((grams[w] + 0.1) / (n + 0.1 * (v + 1))) for w in seqs[k])
        r = out[(i, len(seqs[k]), round(base, 9))]
        assert r.train_tokens == n and r.n_known == sum(grams[w] > 0 for w in seqs[k])
        # the same whatever the chunks
        assert any(x.doc_id == i and abs(x.score - r.score) < 1e-9 and abs(x.base_score - base) < 1e-9 for x in whole)
    assert lm.score(docs.limit(0), train).count() == 0


def test_lm_model_is_a_distribution():
    """Over all known words and the unknown one, the successors of each state have total probability 1."""
    words = np.array([1, 2, 1, 3, 0, 2, 1, 0])
    before = np.array([0, 1, 2, 1, 3, 0, 2, 1])
    pairs, at = np.unique((before << 32) | words, return_inverse=True)
    pair, word = np.bincount(at), np.bincount(words, minlength=5)    # word 4 is unknown
    weights = np.full(lm.CLASSES, 0.4)
    machine = lm.BackoffAutomaton.of(pairs, pair, word, len(words), 4, weights)
    for state in range(5):
        assert abs(sum(10 ** machine.traverse([w], state) for w in range(5)) - 1) < 1e-9
    assert abs(machine.traverse([1, 4, 3]) - (machine.traverse([1]) + machine.traverse([4], 1) + machine.traverse([3], 4))) < 1e-12


def brute_lambda(seqs, trains, grams, pairs):
    """The weight of each class of contexts by EM, token by token."""
    n, v = sum(grams.values()), len(grams)
    seen = {}
    for words, train in zip(seqs, trains):
        for a, b in zip([None, *words], words) if train else ():
            if grams[a] > 1:
                k, own = min(int(math.log2(grams[a])), lm.CLASSES - 1), pairs[a, b] - 1
                ratio = own / (grams[a] - 1) * (n - 1 + 0.1 * (v + 1)) / (grams[b] - 1 + 0.1)
                place = min(max(round(2 * math.log2(ratio)) + 21, 1), lm.BINS - 1) if own else 0
                seen.setdefault(k, Counter())[place] += 1
    every = sum(seen.values(), Counter())
    value = lambda j: 2 ** ((j - 21) / 2) if j else 0.0
    out, last = [], 0.1
    for k in range(lm.CLASSES):
        n_of = {j: seen.get(k, Counter())[j] + 50 * c / every.total() for j, c in every.items()}
        if k in seen:
            last = 0.3
            for _ in range(60):
                last = sum(c * last * value(j) / (last * value(j) + 1 - last) for j, c in n_of.items()) / sum(n_of.values())
            last = min(max(last, 1e-4), 0.95)
        out.append(last)
    if 0 not in seen:
        out[0] = out[1]
    return out


def test_lm_scores_equal_brute_force(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    rows = [(r.doc_id, r.text, crc32(str(r.doc_id).encode()) % 10 != 0) for r in docs.collect()]
    seqs, grams, pairs = brute_counts(rows)
    seqs = [seqs[k] for k in range(len(rows))]
    weights = brute_lambda(seqs, [t for _, _, t in rows], grams, pairs)
    n, v = sum(grams.values()), len(grams)
    got = {r.doc_id: r.score for r in lm.score(docs, id_remainder("doc_id", 10) != 0, chunk_tokens=3000, bucket_tokens=5000).collect()}
    assert len(got) == len(rows)
    for (i, _, _), words in zip(rows, seqs):
        want = 0.0
        for a, b in zip([None, *words], words):
            root = (grams[b] + 0.1) / (n + 0.1 * (v + 1))
            mix = weights[min(int(math.log2(grams[a])), lm.CLASSES - 1)] if grams[a] else 0.0
            want += math.log10((mix * pairs[a, b] / grams[a] if grams[a] else 0.0) + (1 - mix) * root)
        assert abs(got[i] - want) < 1e-6 * max(1, abs(want)), i


def test_lm_text_longer_than_a_chunk(spark, docs_of):
    long = "one two three " * 40_000
    got = {r.doc_id: r for r in lm.score(docs_of([(1, long), (2, "one two")]), F.lit(True), chunk_tokens=1000).collect()}
    assert got[1].n_tokens == 120_001 and got[1].n_known == 120_001 and got[1].score > got[1].base_score


def test_lm_beats_base_on_held_out(spark):
    got = [r for r in QUERIES["op9_lm_scoring"](spark, SF).collect() if r.held_out]
    assert sum(r.score for r in got) > sum(r.base_score for r in got)
    assert np.mean([r.score >= r.base_score for r in got]) > 0.85


def test_pairs_whose_keys_differ_in_the_last_bits_are_asked_for_apart():
    for bits in (0, 3):
        chunk = lm.Chunk([True], [4], lm.pack_ints(np.array([1, 2, 1, 3]))).with_keys(np.arange(4, dtype=np.uint64).tobytes())
        chunk.keys["pair"] = np.uint64(0x9D8F1A6C3B5E7420) + np.arange(len(chunk.pairs), dtype=np.uint64)
        chunk.order["pair"] = np.argsort(chunk.keys["pair"], kind="stable")
        asked = [k for kind, _, keys, _ in chunk.asks(bits) if kind == "pair" for k in lm.unpack_sorted(keys).tolist()]
        assert len(set(asked)) == len(chunk.pairs) == 4
