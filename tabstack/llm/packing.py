"""Packing documents into training windows by best fit decreasing (operator 1).

1. A narrow Python stage turns each document into token ids, closes it with
   ``end_id`` and cuts it into pieces: full windows first, then the rest.
2. The pieces' lengths (not their ids) are dealt by a hash of their row into
   blocks of about ``per_block`` pieces.  Every block is a fair mixture of all
   lengths, whatever group of copies or source is hot, and bounded, so one
   task packs it: pieces by decreasing length, each into the open window with
   the smallest sufficient capacity, found by a segment tree over capacities.

The more pieces a block has, the less its last windows matter: at 65,536
pieces a block leaves about one badly filled window.

Edge cases: null text counts as empty; an empty document is one piece that
holds the end id only.  Equal lengths are placed in row order; repeated rows
are packed each.  An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabstack.llm.bpe import OUT_BYTES, codec_of
from tabstack.llm.common import blocks_for, map_batches, materialise

WINDOW = 2048
END_ID = 1
PER_BLOCK = 65_536


def cut_documents(docs: DataFrame, window: int = WINDOW, end_id: int = END_ID, id_col: str = "doc_id",
                  text_col: str = "text", path: str | None = None) -> DataFrame:
    """Pieces of every document: ``id_col, start, length, ids, doc_tokens``.

    ``ids`` are the piece's token ids as little-endian unsigned 32-bit bytes.
    """
    id_type = docs.schema[id_col].dataType.simpleString()
    src = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    step, tail = 4 * window, np.array([end_id], dtype="<u4").tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = codec_of(path)
        for batch in batches:
            keys, texts = batch.column(0), batch.column(1)
            rows, starts, parts, totals, size = [], [], [], [], 0
            for k in range(batch.num_rows):
                raw = codec.encode_bytes(texts[k].as_py()) + tail
                for at in range(0, len(raw), step):
                    rows.append(k)
                    starts.append(at // 4)
                    parts.append(raw[at: at + step])
                    totals.append(len(raw) // 4)
                size += len(raw)
                if size >= OUT_BYTES or k + 1 == batch.num_rows:
                    yield pa.RecordBatch.from_arrays(
                        [keys.take(pa.array(rows, pa.int32())), pa.array(starts, pa.int64()),
                         pa.array([len(p) // 4 for p in parts], pa.int64()), pa.array(parts, pa.binary()),
                         pa.array(totals, pa.int64())],
                        names=["id", "start", "length", "ids", "doc_tokens"])
                    rows, starts, parts, totals, size = [], [], [], [], 0

    schema = f"id {id_type}, start bigint, length bigint, ids binary, doc_tokens bigint"
    return map_batches(src, run, schema).withColumnRenamed("id", id_col)


class CapacityTree:
    """Segment tree over remaining capacities; a leaf is set while a window of that capacity is open."""

    def __init__(self, window: int):
        self.leaves = 1 << (window + 1).bit_length()
        self.node = bytearray(2 * self.leaves)

    def set(self, capacity: int, value: int) -> None:
        i = self.leaves + capacity
        self.node[i] = value
        while i > 1:
            i >>= 1
            now = self.node[2 * i] | self.node[2 * i + 1]
            if self.node[i] == now:
                return
            self.node[i] = now

    def tightest(self, least: int) -> int:
        """The smallest open capacity of at least ``least``, or -1."""
        node, i = self.node, self.leaves + least
        if node[i]:
            return least
        while i > 1:            # up to the first set subtree on the right
            if not i & 1 and node[i + 1]:
                i += 1
                break
            i >>= 1
        else:
            return -1
        while i < self.leaves:  # down to its leftmost set leaf
            i <<= 1
            if not node[i]:
                i += 1
        return i - self.leaves


def best_fit_decreasing(lengths: np.ndarray, window: int) -> tuple[np.ndarray, np.ndarray]:
    """(window number, offset in it) for each length, all between 1 and ``window``."""
    number, offset = np.empty(len(lengths), np.int64), np.empty(len(lengths), np.int64)
    tree, open_at, made = CapacityTree(window), [[] for _ in range(window + 1)], 0
    order = np.argsort(-lengths, kind="stable")
    for k, need in zip(order.tolist(), lengths[order].tolist()):
        room = tree.tightest(need)
        if room < 0:
            room, w = window, made
            made += 1
        else:
            w = open_at[room].pop()
            if not open_at[room]:
                tree.set(room, 0)
        number[k], offset[k] = w, window - room
        left = room - need
        if left:
            if not open_at[left]:
                tree.set(left, 1)
            open_at[left].append(w)
    return number, offset


def pack(pieces: DataFrame, window: int = WINDOW, per_block: int = PER_BLOCK, length_col: str = "length") -> DataFrame:
    """``pieces`` (any columns, kept) plus ``sequence_id`` and ``offset``.

    Carry narrow rows here: the ids of a piece need not be shuffled.
    """
    names = pieces.columns
    numbered = materialise(pieces.select("*", F.monotonically_increasing_id().alias("_row")), "pieces")
    blocks = blocks_for(numbered.count(), per_block)
    dealt = numbered.withColumn("_block", F.pmod(F.xxhash64("_row"), F.lit(blocks)))

    def run(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("_row")
        number, offset = best_fit_decreasing(rows[length_col].to_numpy(np.int64), window)
        return rows[names].assign(sequence_id=(rows["_block"].to_numpy(np.int64) << 32) + number, offset=offset)

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in pieces.schema)
    return dealt.groupBy("_block").applyInPandas(run, f"{schema}, sequence_id bigint, offset bigint")


def pack_documents(docs: DataFrame, window: int = WINDOW, per_block: int = PER_BLOCK, path: str | None = None) -> DataFrame:
    """Pieces of all documents with their places, and a checksum of each piece's ids."""
    pieces = cut_documents(docs, window, path=path)
    narrow = pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens")
    return pack(narrow, window, per_block)


def sequences(placed: DataFrame, pieces: DataFrame, window: int = WINDOW, pad_id: int = 0, id_col: str = "doc_id") -> DataFrame:
    """The packed windows themselves: ``sequence_id, ids (array), used``.

    ``placed`` comes from :func:`pack`, ``pieces`` from :func:`cut_documents`;
    ``id_col`` must be unique among the documents.  A window holds at most
    ``window`` ids, so the groups are bounded.
    """

    def run(rows: pd.DataFrame) -> pd.DataFrame:
        raw = b"".join(rows.sort_values("offset")["ids"])
        ids = np.frombuffer(raw, dtype="<u4").astype(np.int64)
        full = np.full(window, pad_id, dtype=np.int64)
        full[: len(ids)] = ids
        return pd.DataFrame({"sequence_id": [rows["sequence_id"].iloc[0]], "ids": [full], "used": [len(ids)]})

    joined = placed.select(id_col, "start", "sequence_id", "offset").join(pieces.select(id_col, "start", "ids"), [id_col, "start"])
    return joined.groupBy("sequence_id").applyInPandas(run, "sequence_id bigint, ids array<bigint>, used bigint")
