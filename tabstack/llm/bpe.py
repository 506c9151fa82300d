"""BPE encoding and decoding by forced-boundary splitting (operator 10).

A pair of bytes that stands in no vocabulary token can never be merged, so
every place where such a pair occurs is a certain cut: the fragments between
cuts are encoded one by one and their ids concatenated.  Most fragments are
words that return again and again, so each task keeps a bounded memo of
fragment -> ids; a fragment that is not in it is merged by a library.

The tokenizer first splits text by a pattern that looks ahead over white space
and knows English contractions.  Cuts are therefore taken only where the split
of the fragments equals the split of the whole text:

* never right after white space (a run of it is split by what follows it),
* never right before an apostrophe (``!'s`` and ``x's`` split differently),
* only between whole code points.

Edge cases: null text counts as empty and gives no ids; ids, texts and extra
columns of any row are independent of all other rows, so repeated rows give
repeated results; an empty table gives an empty result.
"""

from __future__ import annotations

import json
import re
from array import array
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabstack.llm.common import map_batches

TOKENIZER = "byte_bpe_50k.json"
MEMO_ENTRIES = 200_000   # fragments a task remembers before it starts afresh
MEMO_BYTES = 48          # longer fragments seldom return: not remembered
OUT_BYTES = 4 << 20      # ids (as bytes) per output batch

#: Fixed value: how byte-level vocabularies of this kind split text.
PATTERN = r"""'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
LONG = 500               # bytes from which a fragment goes to the tokenizers library

#: White space outside ASCII in UTF-8.
_WIDE_SPACE = re.compile("[\\u0085\\u00a0\\u1680\\u2000-\\u200a\\u2028\\u2029\\u202f\\u205f\\u3000]")
_ASCII_SPACE = b"\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f "


def tokenizer_path(path: str | None) -> str:
    """``path`` itself, or where the public tokenizer lies on this machine."""
    if path:
        return path
    import public_tokenizers
    return public_tokenizers.path(TOKENIZER)


def byte_alphabet() -> dict[str, int]:
    """The printable stand-in of every byte in a byte-level vocabulary."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(shown)]
    return {chr(b): b for b in shown} | {chr(256 + k): b for k, b in enumerate(rest)}


class ForcedBoundaryCodec:
    """Encoder and decoder of one byte-level BPE vocabulary file."""

    def __init__(self, path: str | None = None, memo_entries: int = MEMO_ENTRIES):
        from tokenizers import Tokenizer

        self.tok = Tokenizer.from_file(tokenizer_path(path))
        self.tok.no_truncation()
        self.tok.no_padding()
        self.special = {t.content: i for i, t in self.tok.get_added_tokens_decoder().items()}
        alphabet = byte_alphabet()
        vocab = {t: i for t, i in self.tok.get_vocab(with_added_tokens=False).items() if t not in self.special}
        self.token_bytes: list[bytes] = [b""] * (1 + max([*vocab.values(), *self.special.values()]))
        joined = np.zeros((256, 256), dtype=bool)
        for token, i in vocab.items():
            raw = bytes(alphabet[c] for c in token)
            self.token_bytes[i] = raw
            for pair in zip(raw, raw[1:]):
                joined[pair] = True
        for token, i in self.special.items():
            self.token_bytes[i] = token.encode()
        cut = ~joined
        cut[:, 0x80:0xC0] = False           # inside a code point
        cut[:, ord("'")] = False
        cut[list(_ASCII_SPACE), :] = False
        self.cut = cut.ravel()
        self.special_at = re.compile("(" + "|".join(map(re.escape, self.special)) + ")") if self.special else None
        self.merge = self._merger()
        self.memo: dict[bytes, bytes] = {}
        self.memo_entries = memo_entries

    def fragments(self, text: str) -> list[bytes]:
        """The pieces of ``text`` between certain cuts."""
        raw = text.encode("utf-8", "surrogatepass")
        if len(raw) < 2:
            return [raw] if raw else []
        a = np.frombuffer(raw, dtype=np.uint8)
        pair = a[:-1].astype(np.uint16)
        pair <<= 8
        pair |= a[1:]
        forced = self.cut[pair]
        if len(raw) != len(text):
            for m in _WIDE_SPACE.finditer(text):   # rare: no cut after these
                end = len(text[: m.end()].encode("utf-8", "surrogatepass"))
                if end <= len(forced):
                    forced[end - 1] = False
        # 0xFF stands in no UTF-8 text: marked there, the cuts are split in one call
        return np.insert(a, np.flatnonzero(forced) + 1, 0xFF).tobytes().split(b"\xff")

    def _merger(self):
        """A faster merger of the same vocabulary for short fragments, if ids are in merge order (so they are ranks)."""
        model = json.loads(self.tok.to_str())["model"]
        pairs = [m if isinstance(m, list) else m.split(" ") for m in model["merges"]]
        if any(model["vocab"].get(a + b) != 256 + k for k, (a, b) in enumerate(pairs)):
            return None
        import tiktoken
        ranks = {raw: i for i, raw in enumerate(self.token_bytes) if i not in self.special.values()}
        return tiktoken.Encoding("fragments", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={}).encode_ordinary

    def _ids(self, fragment: bytes) -> bytes:
        text = fragment.decode("utf-8", "replace")
        if self.merge is not None and len(fragment) < LONG:
            return array("I", self.merge(text)).tobytes()
        return array("I", self.tok.encode(text, add_special_tokens=False).ids).tobytes()

    def _learn(self, missing: list[bytes]) -> dict[bytes, bytes]:
        return {m: self._ids(m) for m in missing}

    def _encode_plain(self, text: str) -> list[bytes]:
        parts = self.fragments(text)
        found = list(map(self.memo.get, parts))
        if None in found:
            new = self._learn(list({p for p, f in zip(parts, found) if f is None}))
            found = [new[p] if f is None else f for p, f in zip(parts, found)]
            if len(self.memo) + len(new) > self.memo_entries:
                self.memo.clear()
            self.memo.update((k, v) for k, v in new.items() if len(k) <= MEMO_BYTES)
        return found

    def encode_bytes(self, text: str | None) -> bytes:
        """The ids of ``text`` as little-endian unsigned 32-bit integers."""
        if not text:
            return b""
        if self.special_at is None or not any(s in text for s in self.special):
            return b"".join(self._encode_plain(text))
        out: list[bytes] = []
        for part in self.special_at.split(text):
            if part in self.special:
                out.append(np.array([self.special[part]], dtype="<u4").tobytes())
            elif part:
                out += self._encode_plain(part)
        return b"".join(out)

    def encode(self, text: str | None) -> list[int]:
        return np.frombuffer(self.encode_bytes(text), dtype="<u4").tolist()

    def decode(self, ids) -> str:
        """The text of ``ids``; bytes that are no UTF-8 become U+FFFD."""
        return b"".join(map(self.token_bytes.__getitem__, ids)).decode("utf-8", "replace")


@lru_cache(maxsize=1)
def codec_of(path: str | None) -> ForcedBoundaryCodec:
    """The codec of a worker process: its tasks load the vocabulary once and share the memo."""
    return ForcedBoundaryCodec(path)


def round_trip(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", path: str | None = None) -> DataFrame:
    """``id_col``, ``ids`` (array of int) and ``decoded`` (string) of every row.

    A narrow transformation: no shuffle, each worker process loads the vocabulary once.
    """
    id_type = docs.schema[id_col].dataType.simpleString()
    src = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = codec_of(path)
        for batch in batches:
            keys, texts = batch.column(0), batch.column(1)
            start, size, raws, backs = 0, 0, [], []
            for k in range(batch.num_rows):
                raw = codec.encode_bytes(texts[k].as_py())
                raws.append(raw)
                backs.append(codec.decode(np.frombuffer(raw, dtype="<u4").tolist()))
                size += len(raw)
                if size >= OUT_BYTES or k + 1 == batch.num_rows:
                    lens = np.fromiter((len(r) // 4 for r in raws), dtype=np.int64, count=len(raws))
                    offsets = np.concatenate([[0], np.cumsum(lens)]).astype(np.int32)
                    flat = np.frombuffer(b"".join(raws), dtype="<u4").astype(np.int32)
                    ids = pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat))
                    yield pa.RecordBatch.from_arrays([keys.slice(start, k + 1 - start), ids, pa.array(backs, pa.string())],
                                                     names=["id", "ids", "decoded"])
                    start, size, raws, backs = k + 1, 0, [], []

    return map_batches(src, run, f"id {id_type}, ids array<int>, decoded string").withColumnRenamed("id", id_col)
