"""Language-model scoring with a weighted backoff automaton (operator 9).

The model is an interpolated bigram model over words and one end mark:

    p(v | u) = l(u) c(uv) / c(u) + (1 - l(u)) p(v),    p(v) = (c(v) + a) / (N + a (V + 1))

``l(u)`` depends on the size class of c(u) and is fitted by deleted
interpolation over all training tokens.  As an automaton: every seen word is a
state with one arc per seen successor; its failure arc leads to the root with
weight log(1 - l(u)), and the root has an arc per word.  A text starts in the
state of the end mark.

The counts of a corpus fit no single task, the part that one chunk of
documents can reach does.  So:

1. texts become chunks of about ``chunk_tokens`` tokens: local word numbers
   and the words' 64-bit hashes (a written table);
2. each chunk asks for its distinct words and pairs, with its own training
   counts, in sorted blocks dealt over hash buckets; a bucket adds them up and
   answers every chunk in the order of its request;
3. the answers meet their chunk again (a written table), which also yields the
   statistics for l; then each chunk builds its automaton and reads its texts
   from left to right, carrying the state.

A text longer than ``chunk_tokens`` is a chunk of its own size.

A frequent word is one entry per chunk and bucket, so no key is hot; buckets
grow in number with the tokens, and no task or group grows with the corpus.

Edge cases: null text counts as empty and has the end mark only; repeated rows
each count and score; with no training row N = V = 0 and each token has
p = 1; an empty table gives an empty result.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from itertools import count

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabstack.llm.common import map_batches, materialise

ADD = 0.1
CHUNK_TOKENS = 400_000
BUCKET_TOKENS = 2_000_000     # tokens per bucket, from which the number of buckets follows
END = np.uint64(0x9D8F1A6C3B5E7421)   # stands for the end mark (and, as a state, for the start)
CLASSES, BINS = 40, 80


def pack_ints(a: np.ndarray) -> bytes:
    """Unsigned integers, byte plane by byte plane, compressed."""
    planes = np.ascontiguousarray(a.astype("<u8")).view(np.uint8).reshape(-1, 8).T
    return zstandard.ZstdCompressor(level=1).compress(planes.tobytes())


def unpack_ints(raw: bytes) -> np.ndarray:
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(raw), np.uint8).reshape(8, -1)
    return np.ascontiguousarray(planes.T).view("<u8").ravel()


def pack_sorted(a: np.ndarray) -> bytes:
    """Sorted unsigned integers by their differences."""
    return pack_ints(np.diff(a, prepend=np.uint64(0)))


def unpack_sorted(raw: bytes) -> np.ndarray:
    return np.cumsum(unpack_ints(raw), dtype=np.uint64)


def chunk_table(docs: DataFrame, train: Column, id_col: str, text_col: str, chunk_tokens: int) -> DataFrame:
    """One row per chunk: ids, training flags and token numbers of its documents, and the words' hashes."""
    id_type = docs.schema[id_col].dataType.simpleString()
    src = docs.select(F.col(id_col).alias("id"), F.coalesce(train, F.lit(False)).alias("train"),
                      F.coalesce(F.col(text_col), F.lit("")).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, number = TaskContext.get().partitionId(), 0
        keys, flags, parts, tokens = [], [], [], 0
        local: dict = defaultdict(count().__next__)
        _ = local[None]     # the end mark is word 0

        def emit() -> pa.RecordBatch:
            names = list(local)
            hashes = np.fromiter(map(xxhash.xxh64_intdigest, names[1:]), np.uint64, len(names) - 1)
            hashes = np.concatenate([[END], hashes])
            row = {"chunk": (part << 32) + number, "tokens": tokens, "ids": keys, "train": flags,
                   "sizes": [len(p) for p in parts], "words": pack_ints(np.concatenate(parts)), "hashes": hashes.tobytes()}
            return pa.RecordBatch.from_pylist([row], schema=schema)

        schema = None
        for b in batches:
            if schema is None:
                schema = pa.schema([("chunk", pa.int64()), ("tokens", pa.int64()), ("ids", pa.list_(b.schema.field(0).type)),
                                    ("train", pa.list_(pa.bool_())), ("sizes", pa.list_(pa.int32())),
                                    ("words", pa.binary()), ("hashes", pa.binary())])
            for key, flag, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(2)):
                found = text.as_py().encode("utf-8", "replace").lower().split()
                own = np.zeros(len(found) + 1, np.int32)
                own[:-1] = np.fromiter(map(local.__getitem__, found), np.int32, len(found))
                keys.append(key)
                flags.append(flag)
                parts.append(own)
                tokens += len(own)
                if tokens >= chunk_tokens:
                    yield emit()
                    number += 1
                    keys, flags, parts, tokens = [], [], [], 0
                    local = defaultdict(count().__next__)
                    _ = local[None]
        if keys:
            yield emit()

    return map_batches(src, run, f"chunk bigint, tokens bigint, ids array<{id_type}>, train array<boolean>, sizes array<int>, "
                               "words binary, hashes binary")


class Chunk:
    """The arrays of one chunk, and its distinct words and pairs in the order of their hash keys."""

    def __init__(self, train, sizes, words: bytes):
        self.sizes = np.asarray(sizes, np.int64)
        self.words = unpack_ints(words).astype(np.int64)
        self.start = np.concatenate([[0], np.cumsum(self.sizes)[:-1]])
        self.trains = np.repeat(np.asarray(train, bool), self.sizes)
        self.before = np.concatenate([[0], self.words[:-1]])
        self.before[self.start] = 0     # word 0: a text starts where the last one ended
        self.pairs, self.pair = np.unique((self.before << 32) | self.words, return_inverse=True)

    def with_keys(self, hashes: bytes) -> Chunk:
        h = np.frombuffer(hashes, np.uint64)
        mixed = h[self.pairs >> 32] * np.uint64(0x9E3779B97F4A7C15) + h[self.pairs & 0xFFFFFFFF]
        mixed = (mixed ^ (mixed >> np.uint64(31))) * np.uint64(0xD6E8FEB86659FD93)
        self.keys = {"word": h, "pair": mixed ^ (mixed >> np.uint64(32))}
        self.order = {k: np.argsort(v, kind="stable") for k, v in self.keys.items()}
        return self

    def asks(self, bits: int) -> Iterator[tuple[str, int, bytes, bytes]]:
        """(kind, bucket, keys, training counts) for each bucket that has any; words and pairs are asked for by 64 bits."""
        own = {"word": np.bincount(self.words[self.trains], minlength=len(self.keys["word"])),
               "pair": np.bincount(self.pair[self.trains], minlength=len(self.pairs))}
        for kind, order in self.order.items():
            keys, counts = self.keys[kind][order], own[kind][order]
            for bucket, lo, hi in self._buckets(kind, bits):
                yield kind, bucket, pack_sorted(keys[lo:hi]), pack_ints(counts[lo:hi])

    def _buckets(self, kind: str, bits: int) -> Iterator[tuple[int, int, int]]:
        keys = self.keys[kind][self.order[kind]]
        place = (keys >> np.uint64(64 - bits)).astype(np.int64) if bits else np.zeros(len(keys), np.int64)
        first = np.flatnonzero(np.concatenate([[True], place[1:] != place[:-1]]))
        for lo, hi in zip(first.tolist(), [*first[1:].tolist(), len(keys)]):
            yield int(place[lo]), lo, hi

    def totals(self, kind: str, bits: int, answers: dict[int, bytes]) -> np.ndarray:
        """Corpus counts in the order of the chunk's own words or pairs."""
        out = np.zeros(len(self.keys[kind]), np.int64)
        for bucket, lo, hi in self._buckets(kind, bits):
            out[self.order[kind][lo:hi]] = unpack_ints(answers[bucket])
        return out


def size_class(c: np.ndarray) -> np.ndarray:
    return np.minimum(np.log2(np.maximum(c, 1)).astype(np.int64), CLASSES - 1)


def ratio_counts(chunk: Chunk, word: np.ndarray, pair: np.ndarray, total: int, kinds: int) -> np.ndarray:
    """CLASSES x BINS: training tokens by class of c(u) and log-ratio of the two estimates, the token itself left out.

    Bin 0 holds pairs that no other place has.
    """
    t = np.flatnonzero(chunk.trains)
    cu, cuv, cv = word[chunk.before[t]], pair[chunk.pair[t]], word[chunk.words[t]]
    some = cu > 1
    cu, cuv, cv = cu[some], cuv[some], cv[some]
    ratio = (cuv - 1) / (cu - 1) * (total - 1 + ADD * (kinds + 1)) / (cv - 1 + ADD)
    bins = np.zeros(len(cu), np.int64)
    seen = cuv > 1
    bins[seen] = np.clip(np.round(2 * np.log2(ratio[seen])) + 21, 1, BINS - 1).astype(np.int64)
    return np.bincount(size_class(cu) * BINS + bins, minlength=CLASSES * BINS).reshape(CLASSES, BINS)


def fit_lambda(counts: np.ndarray) -> np.ndarray:
    """EM for the weight of the pair estimate in each class; classes with few tokens borrow from smaller ones."""
    ratio = np.concatenate([[0.0], 2.0 ** ((np.arange(1, BINS) - 21) / 2)])
    out, last = np.zeros(CLASSES), 0.1
    prior = counts.sum(axis=0) / max(1, counts.sum()) * 50     # 50 tokens' worth of the overall shape
    for k in range(CLASSES):
        n, x = counts[k] + prior, last
        if counts[k].sum():
            x = 0.3
            for _ in range(60):
                x = float(n @ (x * ratio / (x * ratio + 1 - x)) / n.sum())
            x = min(max(x, 1e-4), 0.95)
        out[k] = last = x
    if counts[0].sum() == 0:
        out[0] = out[1]     # contexts seen once: nothing is left when the token itself is left out
    return out


class BackoffAutomaton:
    """States: word numbers, each with an arc per seen successor and a failure arc to the root.

    ``arcs``: state << 32 | word -> weight.  The root has an arc per word; every
    arc by a word leads to that word's state.
    """

    def __init__(self, arcs: dict[int, float], fail_weight: list[float], root_weight: list[float]):
        self.arcs, self.fail_weight, self.root_weight = arcs, fail_weight, root_weight

    @classmethod
    def of(cls, pairs: np.ndarray, pair: np.ndarray, word: np.ndarray, total: int, kinds: int, weights: np.ndarray) -> BackoffAutomaton:
        root = (word + ADD) / (total + ADD * (kinds + 1))
        mix = np.where(word > 0, weights[size_class(word)], 0.0)
        seen = pair > 0
        arcs = pairs[seen]
        u, v = arcs >> 32, arcs & 0xFFFFFFFF
        direct = mix[u] * pair[seen] / word[u] + (1 - mix[u]) * root[v]
        return cls(dict(zip(arcs.tolist(), np.log10(direct).tolist())), np.log10(1 - mix).tolist(), np.log10(root).tolist())

    def traverse(self, words: list[int], state: int = 0) -> float:
        """Sum of the weights on the path that reads ``words`` from left to right, starting in ``state``."""
        step, fail, root, total = self.arcs.get, self.fail_weight, self.root_weight, 0.0
        for word in words:
            weight = step(state << 32 | word)
            total += fail[state] + root[word] if weight is None else weight
            state = word
        return total


def _add_up(rows: pd.DataFrame) -> pd.DataFrame:
    """One bucket: sums of equal keys, answered block by block; first row: distinct keys in use, and their sum."""
    keys = [unpack_sorted(x) for x in rows["keys"]]
    own = np.concatenate([unpack_ints(x) for x in rows["counts"]]).astype(np.int64)
    _, at = np.unique(np.concatenate(keys), return_inverse=True)
    total = np.bincount(at, own).astype(np.int64)
    answer = np.split(total[at], np.cumsum([len(k) for k in keys])[:-1])
    return pd.DataFrame({"chunk": rows["chunk"], "kind": rows["kind"], "bucket": rows["bucket"],
                         "totals": [pack_ints(a) for a in answer],
                         "used": [int((total > 0).sum())] + [0] * (len(rows) - 1),
                         "sum": [int(total.sum())] + [0] * (len(rows) - 1)})


def score(docs: DataFrame, train: Column, id_col: str = "doc_id", text_col: str = "text",
          chunk_tokens: int = CHUNK_TOKENS, bucket_tokens: int = BUCKET_TOKENS) -> DataFrame:
    """``id_col, train, n_tokens, n_known, train_tokens, base_score, score`` of every row of ``docs``.

    The model learns from the rows where ``train`` holds.
    """
    id_type = docs.schema[id_col].dataType.simpleString()
    chunks = materialise(chunk_table(docs, train, id_col, text_col, chunk_tokens), "lm-chunks")
    tokens = chunks.agg(F.sum("tokens")).first()[0] or 0
    bits = max(3, int(np.ceil(np.log2(max(1, tokens / bucket_tokens)))))

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for k in range(b.num_rows):
                row = {n: b.column(j)[k].as_py() for j, n in enumerate(b.schema.names)}
                own = list(Chunk(row["train"], row["sizes"], row["words"]).with_keys(row["hashes"]).asks(bits))
                yield pa.RecordBatch.from_arrays(
                    [pa.array([row["chunk"]] * len(own), pa.int64()), pa.array([x[0] for x in own]), pa.array([x[1] for x in own], pa.int32()),
                     pa.array([x[2] for x in own], pa.binary()), pa.array([x[3] for x in own], pa.binary())],
                    names=["chunk", "kind", "bucket", "keys", "counts"])

    asked = map_batches(chunks.select("chunk", "train", "sizes", "words", "hashes"),
        ask, "chunk bigint, kind string, bucket int, keys binary, counts binary")
    answers = materialise(asked.groupBy("kind", "bucket").applyInPandas(
        _add_up, "chunk bigint, kind string, bucket int, totals binary, used bigint, sum bigint"), "lm-counts")
    stat = answers.filter("kind = 'word'").agg(F.sum("used"), F.sum("sum")).first()
    kinds, total = int(stat[0] or 0), int(stat[1] or 0)

    def meet(key, left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        row = left.iloc[0]
        chunk = Chunk(row["train"], row["sizes"], row["words"]).with_keys(row["hashes"])
        back = {k: dict(zip(g["bucket"], g["totals"])) for k, g in right.groupby("kind")}
        word, pair = chunk.totals("word", bits, back["word"]), chunk.totals("pair", bits, back["pair"])
        ratios = ratio_counts(chunk, word, pair, total, kinds)
        return left.drop(columns="hashes").assign(word=pack_ints(word), pair=pack_ints(pair), ratios=ratios.astype(np.int64).tobytes())

    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in chunks.schema if f.name != "hashes")
    met = materialise(chunks.groupBy("chunk").cogroup(answers.select("chunk", "kind", "bucket", "totals").groupBy("chunk"))
                      .applyInPandas(meet, f"{schema}, word binary, pair binary, ratios binary"), "lm-chunks-counted")

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros(CLASSES * BINS, np.int64)
        for b in batches:
            for x in b.column(0):
                sums += np.frombuffer(x.as_py(), np.int64)
        at = np.flatnonzero(sums)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(sums[at])], names=["cell", "n"])

    cells = np.zeros(CLASSES * BINS)
    for r in map_batches(met.select("ratios"), add, "cell bigint, n bigint").groupBy("cell").agg(F.sum("n").alias("n")).collect():
        cells[r.cell] = r.n     # at most CLASSES x BINS rows
    weights = fit_lambda(cells.reshape(CLASSES, BINS))

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for k in range(b.num_rows):
                row = {n: b.column(j)[k].as_py() for j, n in enumerate(b.schema.names) if n != "ids"}
                chunk = Chunk(row["train"], row["sizes"], row["words"])
                word, pair = unpack_ints(row["word"]).astype(np.int64), unpack_ints(row["pair"]).astype(np.int64)
                machine = BackoffAutomaton.of(chunk.pairs, pair, word, total, kinds, weights)
                root = np.array(machine.root_weight)
                scores = [machine.traverse(chunk.words[at: at + n].tolist()) for at, n in zip(chunk.start, chunk.sizes)]
                ids = b.column(b.schema.get_field_index("ids"))
                lo = ids.offsets[k].as_py()
                yield pa.RecordBatch.from_arrays(
                    [ids.values.slice(lo, len(chunk.sizes)), pa.array(row["train"], pa.bool_()), pa.array(chunk.sizes),
                     pa.array(np.add.reduceat((word > 0)[chunk.words].astype(np.int64), chunk.start)),
                     pa.array(np.full(len(chunk.sizes), total)),
                     pa.array(np.add.reduceat(root[chunk.words], chunk.start)),
                     pa.array(scores, pa.float64())],
                    names=["id", "train", "n_tokens", "n_known", "train_tokens", "base_score", "score"])

    return map_batches(met.select("ids", "train", "sizes", "words", "word", "pair"),
        walk, f"id {id_type}, train boolean, n_tokens bigint, n_known bigint, train_tokens bigint, base_score double, score double"
    ).withColumnRenamed("id", id_col)
