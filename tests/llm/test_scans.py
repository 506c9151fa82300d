import base64
import hashlib
import random
import re
import textwrap

import numpy as np
import zstandard
from pyspark.sql import functions as F

from tabstack.llm import ann, licenses, spotsigs, warc
from tabstack.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"


# --- licenses ---

def brute_licenses(text):
    """Every block against every template by wording alone."""
    out = set()
    for a, b in licenses.blocks(text or ""):
        for name, notice in licenses.TEMPLATES:
            own = licenses.tokens(notice)
            edits, touched = licenses.differences(own, licenses.tokens(text[a:b]))
            if licenses.allowed(edits, touched, len(own)):
                out.add(name)
    return sorted(out)


def test_differences_equal_brute_force():
    rng = np.random.default_rng(5)
    for _ in range(200):
        t, b = ([str(x) for x in rng.integers(0, 4, rng.integers(1, 6))], [str(x) for x in rng.integers(0, 4, rng.integers(0, 9))])
        best = len(t)
        for i in range(len(b) + 1):
            for j in range(i, len(b) + 1):
                part = b[i:j]
                d = np.arange(len(part) + 1)
                for k, w in enumerate(t):
                    new = [k + 1]
                    for m, v in enumerate(part):
                        new.append(min(d[m] + (w != v), d[m + 1] + 1, new[m] + 1))
                    d = np.array(new)
                best = min(best, int(d[-1]))
        assert licenses.differences(t, b)[0] == best


def test_license_query_equals_brute_force(spark):
    texts = {r.doc_id: r.text for r in spark.read.parquet("/root/testdata/sf0.01/documents.parquet").collect()}
    got = QUERIES["op3_license_scan"](spark, "/root/testdata/sf0.01").collect()
    assert len(got) == len(texts) and any(r.licenses for r in got)
    for r in got:
        assert r.licenses == brute_licenses(texts[r.doc_id])
        assert all(licenses._CUE.search(texts[r.doc_id][f.start: f.start + f.length]) for f in r.findings)


def test_license_edge_rows(spark, docs_of):
    mit = dict(licenses.TEMPLATES[::-1])["MIT"]
    long_mit = licenses.TEMPLATES[4][1]
    rows = [(1, None), (2, ""), (3, "word " * 30_000 + "\nLicensed under the Apache License, Version 2.0.\n" + "word " * 10),
            (4, "This work is licensed under the GNU General Public License, version 2."), (5, "This work is licensed under the GNU General Public License, version 9."),
            (6, long_mit.replace("deal in", "trade in").replace("furnished", "given")), (6, mit), (None, "Licensed under CC BY-NC 4.0."), (7, "A licence to kill.")]
    got = licenses.scan(docs_of(rows).withColumn("findings", F.lit("clash"))).collect()
    assert sorted((r.doc_id or 0, tuple(r.licenses)) for r in got) == [
        (0, ("CC-BY-NC-4.0",)), (1, ()), (2, ()), (3, ("Apache-2.0",)), (4, ("GPL-2.0",)), (5, ()), (6, ("MIT",)), (6, ("MIT",)), (7, ())]
    assert licenses.scan(docs_of(rows).limit(0)).count() == 0


def whole_text(text):
    """Every template aligned with the whole text, without blocks, parts or compression."""
    words, out = licenses.tokens(text), set()
    for name, notice in licenses.TEMPLATES:
        own = licenses.tokens(notice)
        edits, touched = licenses.differences(own, words, licenses.fixed)
        if licenses.allowed(edits, touched, len(own)):
            out.add(name)
    return sorted(out)


def test_wrapped_notices_equal_alignment_with_whole_text():
    scanner = licenses.Scanner()
    for name, notice in licenses.TEMPLATES:
        for width in (20, 40, 60, 72, 78, 10_000):
            for mark in ("", "# ", " * "):
                lines = textwrap.wrap(notice, width)
                for body in (lines, [x for line in lines for x in (line, "", "--", "", "~")]):
                    text = "Some code.\n" + "\n".join(mark + x for x in body) + "\nint main()\n"
                    found = sorted({f["license"] for f in scanner.scan(text)})
                    assert name in found and found == whole_text(text)


def test_edited_notices_equal_alignment_with_whole_text(spark, docs_of):
    rng = np.random.default_rng(11)
    texts = ["2.0licensed under\u00e9the_APACHE License, Version 2.0or later", "\u0130\u0130 Licensed under CC BY 4.0. \u0130"]
    for k in range(400):
        words = []
        for t in rng.integers(0, len(licenses.TEMPLATES), rng.integers(1, 4)):
            own = licenses.TEMPLATES[t][1].split()
            for _ in range(rng.integers(0, len(own) // 10 + 2)):
                at = int(rng.integers(0, len(own)))
                own[at: at + int(rng.integers(0, 2))] = ["other"] * int(rng.integers(0, 2))
            words += own + ["filler"] * int(rng.integers(0, 30))
        texts.append(textwrap.fill(" ".join(words), int(rng.integers(20, 100))))
    found = {r.doc_id: r.licenses for r in licenses.scan(docs_of(list(enumerate(texts)))).collect()}
    for k, text in enumerate(texts):
        assert found[k] == whole_text(text), text


def test_exact_notices_in_long_blocks():
    rng = np.random.default_rng(12)
    scanner = licenses.Scanner()
    vocabulary = ["".join(chr(97 + c) for c in rng.integers(0, 26, rng.integers(2, 9))) for _ in range(3_000)]
    for size in (1_000, 5_000, 20_000, 100_000):
        words = [vocabulary[k] for k in rng.integers(0, len(vocabulary), size)]
        for cues in (0, 7):     # with license words all along the line or without
            line = [w if not cues or k % cues else "redistributed" for k, w in enumerate(words)]
            for name, notice in licenses.TEMPLATES:
                at = int(rng.integers(0, size))
                assert name in {f["license"] for f in scanner.scan(" ".join([*line[:at], notice, *line[at:]]))}
    # one dense block of several KB: every notice, again and again
    order = [int(k) for _ in range(10) for k in rng.permutation(len(licenses.TEMPLATES))]
    dense = " ".join(licenses.TEMPLATES[k][1] for k in order)
    assert len(licenses.blocks(dense)) == 1
    assert {f["license"] for f in scanner.scan(dense)} == {name for name, _ in licenses.TEMPLATES}
    # every notice once, in the middle of one block of another's
    for name, notice in licenses.TEMPLATES:
        others = " ".join(t for n, t in licenses.TEMPLATES * 4 if n != name)
        assert name in {f["license"] for f in scanner.scan(f"{others} {notice} {others}")}
    blob = rng.bytes(100_000).hex()
    for name, notice in licenses.TEMPLATES:
        assert name in {f["license"] for f in scanner.scan(f"{blob} {notice} {blob}")}


def test_bsd_clauses_tell_the_licenses_apart():
    notices = {n: t for n, t in licenses.TEMPLATES if n.startswith("BSD")}
    head = notices["BSD"] + ":\n1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.\n2. "
    binary, _, disclaimer = notices["BSD-2-Clause"].partition(" THIS SOFTWARE")
    disclaimer = "THIS SOFTWARE" + disclaimer + " AND ANY EXPRESS OR IMPLIED WARRANTIES ARE DISCLAIMED."
    two, three = f"{head}{binary}\n\n{disclaimer}", f"{head}{binary}\n3. {notices['BSD-3-Clause']}.\n\n{disclaimer}"
    scanner = licenses.Scanner()
    for width in (40, 78, 10_000):
        got = [{f["license"] for f in scanner.scan(textwrap.fill(t, width))} for t in (notices["BSD"], two, three)]
        assert got == [{"BSD"}, {"BSD", "BSD-2-Clause"}, {"BSD", "BSD-3-Clause"}]


# --- WARC ---

def expected(rows):
    pay = [(i, (h or "").encode()) for i, h in rows]
    sha = [base64.b32encode(hashlib.sha1(p).digest()).decode() for _, p in pay]
    first = {}
    for (i, _), s in zip(pay, sha):
        if i is not None:
            first[s] = min(first.get(s, i), i)
    return sorted(((i is None, i or 0), len(p), s, *(("response", None) if first.get(s, i) == i else ("revisit", first[s]))) for (i, p), s in zip(pay, sha))


def test_warc_rows(spark, tmp_path):
    rows = [(5, "<p>a</p>"), (3, "<p>a</p>"), (9, None), (4, ""), (7, "é" * 70_000), (3, "<p>a</p>"), (8, "x\r\n\r\ny"), (None, "<p>a</p>"), (None, "only")]
    pages = spark.createDataFrame([(i, "http://a.example/ b" if k % 2 else None, h, 1) for k, (i, h) in enumerate(rows)], "page_id long, url string, html string, payload_digest int")
    got = warc.round_trip(pages.repartition(2), str(tmp_path / "w")).collect()
    assert sorted(((r.page_id is None, r.page_id or 0), r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in got) == expected(rows)
    assert warc.round_trip(pages.limit(0), str(tmp_path / "none")).count() == 0


def test_archives_are_plain_zstandard_with_a_leading_dictionary(spark, tmp_path):
    pages = spark.read.parquet(f"{SF}/pages.parquet")
    path = str(tmp_path / "w")
    warc.write_archives(pages, path)
    files = [p for p in (tmp_path / "w").iterdir() if p.name.startswith("part") and p.stat().st_size]
    found = 0
    for f in files:
        raw = f.read_bytes()
        assert raw[:4] == warc.DICTIONARY_MAGIC
        size = int.from_bytes(raw[4:8], "little")
        reader = zstandard.ZstdDecompressor(dict_data=zstandard.ZstdCompressionDict(raw[8: 8 + size])).stream_reader(raw, read_across_frames=True)
        whole = reader.read()     # an ordinary reader passes over all skippable frames
        found += len(re.findall(rb"WARC/1\.1\r\nWARC-Type: (?:response|revisit)", whole))
    html = sum(len((r.html or "").encode()) for r in pages.collect())
    assert found == pages.count() and sum(f.stat().st_size for f in files) < html


def test_warc_query(spark):
    rows = [(r.page_id, r.html) for r in spark.read.parquet(f"{SF}/pages.parquet").collect()]
    got = QUERIES["op6_warc"](spark, SF).collect()
    assert sorted(((False, r.page_id), r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in got) == expected(rows)


# --- spot signatures ---

def brute_spots(text, chain=2):
    words = [w for w in re.split(r"[^\w]+|_", text.lower()) if w]
    anchors = set(spotsigs.ANCHORS)
    out = set()
    for i, w in enumerate(words):
        if w in anchors:
            rest = [x for x in words[i + 1:] if x not in anchors][:chain]
            if len(rest) == chain:
                out.add((w, *rest))
    return out


def jaccard(a, b):
    return 1.0 if not a and not b else len(a & b) / len(a | b)


def brute_edited(rows):
    rows = sorted(((i, t or "") for i, t in rows))
    out = []
    for k, (i, t) in enumerate(rows):
        nxt = rows[(k + 1) % len(rows)][1]
        half = len(t) // 2
        out.append((i, t, t[: len(t) - half] + nxt[:half], nxt))
    return out


def check_spots(got, rows):
    sets = lambda t: brute_spots(t) or ({("whole", *re.split(r"[^\w]+|_", t.lower()))} if t else set())
    got = {r.doc_id: r for r in got}
    assert len(got) == len(rows)
    for i, text, edited, nxt in brute_edited(rows):
        r = got[i]
        assert r.n_chars == len(text) and r.edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
        assert len([x for x in r.fingerprint.split(",") if x]) == len(sets(text))
        assert abs(r.near_edited - jaccard(sets(text), sets(edited))) < 1e-9
        assert abs(r.near_next - jaccard(sets(text), sets(nxt))) < 1e-9


def test_spotsigs_equals_brute_force(spark):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    check_spots(QUERIES["op8_spotsigs"](spark, SF).collect(), rows)


def test_spotsigs_edge_rows_and_many_ranges(spark, docs_of, monkeypatch):
    rows = [(1, "the cat sat on the mat"), (7, None), (30, ""), (31, "Über 🙂 naïve"), (40, "the " * 3000), (41, "plain words only here"), (500, "the cat sat on the mat"), (501, "x")]
    docs = docs_of(rows).withColumn("sigs", F.lit("clash"))
    check_spots(spotsigs.compare_edited(docs).collect(), rows)
    monkeypatch.setattr(spotsigs.with_next, "__defaults__", (spotsigs.with_next.__defaults__[0], 2))
    check_spots(spotsigs.compare_edited(docs).collect(), rows)
    check_spots(spotsigs.compare_edited(docs.filter("doc_id = 1")).collect(), rows[:1])
    assert spotsigs.compare_edited(docs.limit(0)).count() == 0
    odd = spotsigs.compare_edited(docs_of([(None, "a b"), (2, "the old man sat"), (2, "the old man sat")])).collect()
    assert len(odd) == 3 and len({r.fingerprint for r in odd if r.doc_id == 2}) == 1


def test_spotsigs_plan_has_no_python(spark):
    plan = QUERIES["op8_spotsigs"](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow", plan)


def test_spot_near_duplicates_equal_brute_force(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").filter("doc_id < 400")
    sets = {r.doc_id: brute_spots(r.text or "") for r in docs.collect()}
    member, pairs = spotsigs.near_duplicates(docs, 0.8)
    member = {r.id: r.class_id for r in member.collect()}
    ids = sorted(i for i in sets if sets[i] and member[i] == i)
    want = {(a, b) for k, a in enumerate(ids) for b in ids[k + 1:] if jaccard(sets[a], sets[b]) >= 0.8}
    assert {(r.a, r.b) for r in pairs.collect()} == want
    assert all(sets[i] == sets[c] for i, c in member.items() if sets[i])


# --- nearest neighbours ---

def test_forest_recall_and_order(spark):
    d = "/root/testdata/sf0.1"
    rows = spark.read.parquet(f"{d}/embeddings.parquet").toPandas()
    x, ids = np.array([np.asarray(v, float) for v in rows["embedding"]]), rows["vec_id"].to_numpy()
    got = QUERIES["op4_ann"](spark, d).toPandas()
    hit = total = 0
    for q in ids[ids % 100 == 0]:
        far = np.sqrt(((x - x[ids == q][0]) ** 2).sum(axis=1))
        far[ids == q] = np.inf
        own = got[got["query_id"] == q].sort_values("rank")
        assert own["rank"].tolist() == list(range(1, 11)) and own["score"].is_monotonic_increasing
        assert np.allclose(own["score"], [far[ids == v][0] for v in own["vec_id"]], atol=1e-12)
        hit += len(set(ids[np.lexsort((ids, far))[:10]]) & set(own["vec_id"]))
        total += 10
    assert hit / total >= 0.9


def test_nearest_edge_rows(spark):
    nan = float("nan")
    rows = [(0, [1.0, 0.0]), (100, [0.0, 2.0]), (1, [1.0, 0.0]), (2, [1.0, 0.0]), (3, None), (4, [0.0, 0.0]), (5, [nan, 1.0]), (6, [1.0, None]), (7, [float("inf"), 0.0]),
            (8, [3.0, 4.0]), (None, [1.0, 0.1]), (200, [0.0, 0.0]), (9, [1.0, 0.0, 0.0]), (100, [0.0, 2.0])]
    vectors = spark.createDataFrame(rows, "vec_id long, embedding array<float>").withColumn("rank", F.lit("clash"))
    got = [(r.query_id, r["rank"], r.vec_id, round(r.score, 6)) for r in ann.search(vectors, F.col("vec_id") % 100 == 0, k=3, shard_rows=3).orderBy("query_id", "rank").collect()]
    assert got == [(0, 1, 1, 0.0), (0, 2, 2, 0.0), (0, 3, 100, 2.236068), (100, 1, 0, 2.236068), (100, 2, 1, 2.236068), (100, 3, 2, 2.236068)]
    assert ann.search(vectors.limit(0), F.col("vec_id") % 100 == 0).count() == 0


def test_spot_near_duplicates_of_many_lengths_and_hot_hashes(spark, docs_of):
    rng = random.Random(5)
    rows = []
    for k in range(120):     # sets of 4 to 60 signatures out of few words, so that hashes are shared by many
        base = [f"the red{rng.randrange(12)} fox{rng.randrange(3)}" for _ in range(rng.choice([4, 9, 10, 25, 60]))]
        rows.append((2 * k, " ".join(base)))
        rows.append((2 * k + 1, " ".join(base[: max(1, len(base) - rng.randrange(3))])))
    rows += [(900, None), (901, ""), (902, "no spots")]
    sets = {i: brute_spots(t or "") for i, t in rows}
    for threshold, block in ((0.8, 7), (0.5, 1000)):
        member, pairs = spotsigs.near_duplicates(docs_of(rows), threshold, block=block)
        member = {r.id: r.class_id for r in member.collect()}
        ids = sorted(i for i in sets if sets[i] and member[i] == i)
        want = {(a, b) for k, a in enumerate(ids) for b in ids[k + 1:] if jaccard(sets[a], sets[b]) >= threshold}
        got = [(r.a, r.b) for r in pairs.collect()]
        assert len(got) == len(set(got)) and set(got) == want and len(want) > 20
        assert all(sets[i] == sets[c] for i, c in member.items() if sets[i])
