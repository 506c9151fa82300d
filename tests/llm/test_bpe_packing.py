import random
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tabstack.llm import bpe, packing
from tabstack.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"


def library():
    return Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))


def test_codec_equals_library_on_awkward_texts():
    codec, lib = bpe.ForcedBoundaryCodec(memo_entries=50), library()
    rng = random.Random(3)
    parts = ["a", "é", "'s", "'", "!", "?", "\n", " ", "  ", "\t", "x", "1", "中", " ", "　", " ", "'ll",
             "<|endoftext|>", "<|endof", "̀", "🙂", "\x1c", "\x85", "²", "\r\n", "ß", "'S", "-", "​"]
    texts = ["", " ", "\n" * 3000, "a" * 5000, " word" * 3000] + ["".join(rng.choices(parts, k=rng.randint(0, 14))) for _ in range(4000)]
    for t in texts:
        ids = lib.encode(t, add_special_tokens=False).ids
        assert codec.encode(t) == ids, repr(t)
        assert codec.decode(ids) == lib.decode(ids, skip_special_tokens=False)


def test_round_trip_rows(spark, docs_of):
    docs = docs_of([(1, "Hello world"), (2, None), (3, ""), (3, ""), (None, "x  y\n")]).withColumn("ids", F.lit("clash"))
    got = sorted(((r.doc_id or 0, r.ids, r.decoded) for r in bpe.round_trip(docs).collect()))
    want = [(i or 0, library().encode(t or "", add_special_tokens=False).ids, t or "") for i, t in
            [(1, "Hello world"), (2, None), (3, ""), (3, ""), (None, "x  y\n")]]
    assert got == sorted(want)
    assert bpe.round_trip(docs.limit(0)).count() == 0


def brute_best_fit(lengths, window):
    rooms, out = [], []
    for k in sorted(range(len(lengths)), key=lambda k: -lengths[k]):
        fit = [r for r in range(len(rooms)) if rooms[r] >= lengths[k]]
        best = min((rooms[r] for r in fit), default=None)
        if best is None:
            rooms.append(window - lengths[k])
        else:
            rooms[next(r for r in fit if rooms[r] == best)] -= lengths[k]
        out.append(k)
    return len(rooms), sorted(rooms)


def test_best_fit_equals_brute_force():
    rng = np.random.default_rng(1)
    for n in (0, 1, 5, 200):
        lengths = rng.integers(1, 65, n)
        number, offset = packing.best_fit_decreasing(lengths, 64)
        used = defaultdict(int)
        for k in np.lexsort((offset, number)) if n else []:
            assert offset[k] == used[number[k]]
            used[number[k]] += lengths[k]
        rooms = sorted(64 - v for v in used.values())
        assert (len(rooms), rooms) == brute_best_fit(lengths.tolist(), 64)


def check_packed(rows, texts, window=2048):
    lib = library()
    ids = {i: [*lib.encode(t or "", add_special_tokens=False).ids, 1] for i, t in texts.items()}
    held, used = defaultdict(list), defaultdict(list)
    for r in rows:
        part = ids[r.doc_id][r.start: r.start + r.length]
        assert r.length == len(part) <= window and r.doc_tokens == len(ids[r.doc_id])
        assert r.ids_crc32 == zlib.crc32(np.array(part, "<u4").tobytes())
        held[r.doc_id].append((r.start, r.length))
        used[r.sequence_id].append((r.offset, r.length))
    for i, seq in ids.items():
        at = 0
        for s, n in sorted(held[i]):
            assert s == at
            at += n
        assert at == len(seq)
    for spans in used.values():
        at = 0
        for s, n in sorted(spans):
            assert s == at
            at += n
        assert at <= window
    return sum(map(len, ids.values())), len(used)


def test_pack_documents(spark, docs_of):
    rows = {1: "one two three", 2: None, 3: "", 4: "word " * 9000, 5: "x" * 40, 6: "x" * 40}
    got = packing.pack_documents(docs_of(list(rows.items())).withColumn("sequence_id", F.lit(1)), per_block=3).collect()
    check_packed(got, rows)
    assert packing.pack_documents(docs_of([(1, "a")]).limit(0)).count() == 0


def test_query_whole_table(spark):
    got = QUERIES["op1_packing"](spark, SF).collect()
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    tokens, windows = check_packed(got, texts)
    assert tokens / (windows * 2048) > 0.98


def test_sequences_hold_the_ids(spark, docs_of):
    docs = docs_of([(1, "alpha beta"), (2, "gamma " * 50), (3, None)])
    pieces = packing.cut_documents(docs, window=16)
    out = packing.sequences(packing.pack(pieces.drop("ids"), 16), pieces, 16).collect()
    assert sum(r.used for r in out) == sum(r.length for r in pieces.collect())
    assert all(len(r.ids) == 16 for r in out)


def test_op10_query(spark):
    import hashlib
    texts = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    lib = library()
    got = QUERIES["op10_bpe"](spark, SF).collect()
    assert len(got) == len(texts)
    for r in got:
        ids = lib.encode(texts[r.doc_id], add_special_tokens=False).ids
        assert r.n_tokens == len(ids)
        assert r.ids_sha256 == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(texts[r.doc_id].encode()).hexdigest()
