import random
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from tabstack.llm import jaccard_join as J
from tabstack.llm import langid
from tabstack.llm.common import id_remainder
from tabstack.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"


def grams(text, words):
    w = text.encode().lower().split() if text else []
    if not w:
        return frozenset()
    n = min(words, len(w))
    return frozenset(tuple(w[i: i + n]) for i in range(len(w) - n + 1))


def brute(rows, words, percent):
    """doc_id -> component by all pairs that share a gram."""
    sets = [(i, grams(t, words)) for i, t in rows]
    where = defaultdict(list)
    for k, (_, s) in enumerate(sets):
        for g in s:
            where[g].append(k)
    parent = {i: i for i, _ in sets}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x
    for a, (i, s) in enumerate(sets):
        shared = defaultdict(int)
        for g in s:
            for b in where[g]:
                if b > a:
                    shared[b] += 1
        for b, c in shared.items():
            if 100 * c >= percent * (len(s) + len(sets[b][1]) - c):
                x, y = find(i), find(sets[b][0])
                parent[max(x, y)] = min(x, y)
    return [(i, len(s), find(i)) for i, s in sets]


def near_copies(rng, n=120):
    """Texts with copies at all distances around the threshold, and a passage that many share."""
    word = lambda: "".join(rng.choices("abcdefgh", k=rng.randint(1, 4)))
    passage = [word() for _ in range(30)]
    rows, base = [], []
    for k in range(n):
        if base and rng.random() < 0.6:
            own = list(rng.choice(base))
            for _ in range(rng.randint(0, max(1, len(own) // 12))):
                at = rng.randrange(len(own))
                own[at: at + rng.randint(0, 1)] = [word()] * rng.randint(0, 1)
        else:
            own = [word() for _ in range(rng.choice([1, 2, 3, 4, 6, 9, 20, 60, 150]))]
            if rng.random() < 0.4:
                own += passage
            base.append(own)
        rows.append((k, " ".join(own)))
    return rows


@pytest.mark.parametrize("words,percent,seed", [(4, 85, 1), (5, 80, 2), (2, 60, 3)])
def test_components_equal_brute_force(spark, docs_of, words, percent, seed):
    rows = near_copies(random.Random(seed))
    got = J.jaccard_components(docs_of(rows), words, percent).collect()
    assert sorted((r.doc_id, r.n_shingles, r.component_id) for r in got) == sorted(brute(rows, words, percent))


def test_every_linked_pair_shares_an_entry():
    rng = np.random.default_rng(4)
    for percent, doubles in [(p, d) for p in (60, 80, 85, 95) for d in (None, 0.0, 0.3, 1.0)]:
        edges = J.band_edges(3000)
        plans = J.make_plans({k: 10_000_000 for k in range(len(edges) + 1)}, edges, percent)
        if doubles is not None:   # the other kinds of plan, too
            plans = {k: J.Plan(p.low, p.high, p.bound, 1, percent, int(doubles * (p.units // 2))) for k, p in plans.items()}
        for _ in range(150):
            n = int(np.exp(rng.uniform(0, np.log(2500))))
            x = np.unique(rng.integers(0, 1 << 63, n).astype(np.uint64) * np.uint64(2))
            gone = int(rng.integers(0, n + 1)) if n < 4 else int(rng.integers(0, n // 4 + 1))
            come = int(rng.integers(0, n // 4 + 2))
            y = np.unique(np.concatenate([x[gone:], rng.integers(0, 1 << 63, come).astype(np.uint64)]))
            common = len(np.intersect1d(x, y))
            if not len(y) or 100 * common < percent * (len(x) + len(y) - common) or len(x) == len(y) == common:
                continue
            shared = set(J.instances_of(len(x), edges, percent)) & set(J.instances_of(len(y), edges, percent))
            assert any(set(plans[i].entries(x, i).tolist()) & set(plans[i].entries(y, i).tolist()) for i in shared if plans[i].bound)


def test_cost_joins_units_as_sets_grow_in_number():
    few, many = (J.Plan(200, 299, 66, n, 80) for n in (1_000, 10**9))
    assert few.d == 0 and many.d > 0


def test_keep_first_with_clashing_columns(spark, docs_of):
    docs = docs_of([(1, "a b c d e f"), (2, "a b c d e f"), (2, "g h i j k l"), (3, None)])
    for c in ("_id", "_n", "_id0", "_ID1", "n", "key", "component", "row", "best"):
        docs = docs.withColumn(c, F.lit(c))
    got = J.keep_first(docs)
    assert got.columns == docs.columns and sorted(r.doc_id for r in got.collect()) == [1, 3]


def test_join_edge_rows(spark, docs_of):
    rows = [(1, None), (2, ""), (3, " \t\n"), (4, "One two"), (5, "one TWO"), (6, "one two three"), (7, "x " * 5000), (8, "x " * 4000), (9, "Ä b c d"), (9, "Ä b c d"), (10, "ä b c d"), (11, "Ä b c d")]
    got = J.jaccard_components(docs_of(rows).withColumn("n", F.lit("clash")).withColumn("key", F.lit(1)), 4, 85).collect()
    assert sorted((r.doc_id, r.n_shingles, r.component_id) for r in got) == [
        (1, 0, 1), (2, 0, 2), (3, 0, 3), (4, 1, 4), (5, 1, 4), (6, 1, 6), (7, 1, 7), (8, 1, 7), (9, 1, 9), (9, 1, 9), (10, 1, 10), (11, 1, 9)]
    assert J.jaccard_components(docs_of(rows).limit(0)).count() == 0
    null = J.jaccard_components(docs_of([(None, "a b c d e"), (3, "a b c d e"), (None, "lone text")]), 4, 85).collect()
    assert sorted((r.doc_id or 0, r.component_id or 0) for r in null) == [(0, 0), (0, 3), (3, 3)]


def test_components_of_a_chain_and_a_star(spark):
    pairs = [(k, k + 1) for k in range(1, 40)] + [(100, k) for k in range(101, 140)] + [(7, 7)]
    got = J.components(spark.createDataFrame(pairs, "a long, b long")).collect()
    assert sorted((r.id, r.component) for r in got) == sorted([(k, 1) for k in range(1, 41)] + [(k, 100) for k in range(100, 140)])


def test_join_query(spark):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    got = QUERIES["op7_ngram_jaccard_join"](spark, SF).collect()
    assert sorted((r.doc_id, r.n_shingles, r.component_id) for r in got) == sorted(brute(rows, 4, 85))


def test_pipeline(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    kept = [docs]
    for name, stage in corpus_pipeline.STAGES[:-1]:
        kept.append(stage(spark, kept[-1], SF).cache())
        assert kept[-1].columns == docs.columns
    ids = [{r.doc_id for r in k.select("doc_id").collect()} for k in kept]
    assert ids[0] >= ids[1] >= ids[2] >= ids[3] and len(ids[3]) > 0.5 * len(ids[0])
    rows = [(r.doc_id, r.text) for r in kept[2].collect()]
    assert ids[3] == {i for i, _, c in brute(rows, 5, 80) if i == c}
    placed = corpus_pipeline.run(spark, SF).collect()
    assert {r.doc_id for r in placed} == ids[3] and {"sequence_id", "offset", "start", "length"} <= set(placed[0].asDict())


def test_pipeline_of_an_empty_table(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        docs_out = stage(spark, docs, SF)
        assert docs_out.count() == 0


def test_language_stage_drops_texts_that_no_learned_language_fits(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    rng = np.random.default_rng(3)
    letters = "abcdefghijklmnopqrstuvwxyz"
    gibberish = " ".join("".join(rng.choice(list(letters), rng.integers(2, 9))) for _ in range(200))
    finnish = ("Kaikki ihmiset syntyvät vapaina ja tasavertaisina arvoltaan ja oikeuksiltaan. Heille on annettu järki ja omatunto, "
               "ja heidän on toimittava toisiaan kohtaan veljeyden hengessä.")
    russian = "Все люди рождаются свободными и равными в своем достоинстве и правах. Они наделены разумом и совестью."
    with open(langid.__file__) as f:
        strange = [gibberish, finnish, russian, f.read(), rng.bytes(500).hex()]
    rows = [(-1 - k, t, label, "src0", len(t)) for k, t in enumerate(strange * 2) for label in ("en" if k % 2 else None,)]
    mixed = docs.select(*corpus_pipeline.COLUMNS).unionByName(spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long"))
    kept = {r.doc_id for r in corpus_pipeline.keep_language(spark, mixed, "").select("doc_id").collect()}
    langs, model = langid.fit(mixed, id_remainder("doc_id", 4) != 2)
    before = {r.doc_id for r in langid.predict(docs, langs, model).filter((F.col("lang_pred") != "und") & (F.col("score") >= 0.5)).collect()}
    assert kept == before and not any(k < 0 for k in kept)


def test_one_row_of_each_component_stays(spark, docs_of):
    lone, other, third = "a b c d e f g", "h i j k l m n o", "p q r s t u v w"
    rows = [(1, lone), (1, lone), (1, lone.upper()), (2, lone), (None, lone), (None, other), (None, other), (None, other + " "),
            (5, third), (4, third), (4, third), (4, "a text of its own in the same document"), (4, None), (6, ""), (6, ""), (None, None), (None, " "), (7, "one more text")]
    want = [(0, None), (0, " "), (0, other), (1, lone), (4, third), (4, None), (6, ""), (6, ""), (7, "one more text")]
    got = [(r.doc_id or 0, r.text) for r in J.keep_first(docs_of(rows)).collect()]

    def plain(found):    # of texts with equal sets either may stay; a document's texts are one component
        texts = {"a text of its own in the same document": third}
        return sorted((i, texts.get(t, t) if not t or not t.strip() else texts.get(t, t).strip().lower()) for i, t in found if t is not None), sum(t is None for _, t in found)
    assert plain(got) == plain(want)
    assert sorted(map(str, got)) == sorted(str((r.doc_id or 0, r.text)) for r in J.keep_first(docs_of(rows[::-1]).repartition(5)).collect())
