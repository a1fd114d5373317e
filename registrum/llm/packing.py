"""Packing by concatenate and cut.

Pass 1 tokenizes each document once and writes its ids with the partition and the
position inside it.  The totals of the partitions give, by a running sum over one small
row per partition, each partition's global offset.  Pass 2 lays the documents on the
line of all tokens and cuts it at fixed windows; a document over a border becomes
several records.  Only the last window is short.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from . import kernel as K
from .workspace import Workspace

LENGTH = 2048
END_ID = 1


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


#: fixed value: the piece expression of byte-level BPE
PIECE = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
_PROBE = "It's  a probe\n\n of 12 ²x Ⅷ, 'tis\u00a0é中文\x1c\x85!? (tabs\t)  end "


def _byte_of() -> dict[str, int]:
    """Byte-level BPE writes a printable Latin-1 byte as its character, the others as U+0100 onward."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(rest)}


class Encoder:
    """Token ids of whole texts, those of the tokenizer file at path.

    A byte-level BPE whose ids are its merge order is run by tiktoken, three times as fast; the
    two libraries' ids are compared on a probe first, unless `trusted` says that they were.  A
    text that holds a special token's string, and any other tokenizer, goes through
    `tokenizers`, which is loaded only then: it takes more memory than all else in a worker.
    """

    def __init__(self, path: str, trusted: bool | None = None):
        import json

        self.path, self._slow = path, None
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        self.special = [t["content"] for t in spec.get("added_tokens", [])]
        pre = spec.get("pre_tokenizer") or {}
        self.fast = None
        if trusted is not False and pre.get("type") == "ByteLevel" and not pre.get("add_prefix_space") and pre.get("use_regex", True) and spec.get("normalizer") is None:
            import tiktoken

            byte, vocab = _byte_of(), spec["model"]["vocab"]
            del spec
            ranks = {bytes(byte[c] for c in t): i for t, i in vocab.items() if t not in self.special}
            fast = tiktoken.Encoding("file", pat_str=PIECE, mergeable_ranks=ranks, special_tokens={})
            if trusted or fast.encode_ordinary(_PROBE) == self.slow(_PROBE):
                self.fast = fast.encode_ordinary

    def slow(self, text: str) -> list[int]:
        if self._slow is None:
            from tokenizers import Tokenizer

            self._slow = Tokenizer.from_file(self.path)
        return self._slow.encode(text, add_special_tokens=False).ids

    def encode(self, text: str) -> np.ndarray:
        if self.fast is None or any(s in text for s in self.special):
            return np.array(self.slow(text), dtype="<u4")
        return np.array(self.fast(text), dtype="<u4")


_encoders: dict[str, Encoder] = {}


def encoder(path: str, trusted: bool | None = None) -> Encoder:
    """One per process."""
    if path not in _encoders:
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        _encoders[path] = Encoder(path, trusted)
    return _encoders[path]


@lru_cache
def _agrees(path: str) -> bool:
    """Whether the fast library gives the file's ids on the probe; the driver compares once and keeps neither."""
    out = Encoder(path).fast is not None
    K.release()
    return out


def tokenized(docs: DataFrame, key: str, text: str, tokenizer: str, end_id: int) -> DataFrame:
    """part, begin (inside the part), id, n (tokens) and ids of every document."""
    trusted = _agrees(tokenizer)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part, at, enc = TaskContext.get().partitionId(), 0, encoder(tokenizer, trusted)
        end = np.array([end_id], dtype="<u4")
        for batch in batches:
            ids = [np.concatenate([enc.encode(t or ""), end]) for t in batch.column(1).to_pylist()]
            n = np.array([len(x) for x in ids], dtype=np.int64)
            begin = at + np.cumsum(n) - n
            at += int(n.sum())
            # two bytes an id where they suffice; pass 2 tells by the length
            ids = [(x.astype("<u2") if x.max() < 65536 else x).tobytes() for x in ids]
            yield pa.RecordBatch.from_arrays([pa.array([part] * len(n), pa.int32()), pa.array(begin), batch.column(0), pa.array(n), pa.array(ids, pa.binary())], ["part", "begin", "id", "n", "ids"])

    return docs.select(F.col(key).cast("long").alias("id"), F.col(text).cast("string").alias("text")).mapInArrow(K.sliced(run), "part int, begin long, id long, n long, ids binary")


def packed(docs: DataFrame, key: str = "doc_id", text: str = "text", tokenizer: str | None = None, length: int = LENGTH, end_id: int = END_ID) -> DataFrame:
    """One row per piece: id, start, length, ids (little-endian unsigned 32-bit), ids_crc32, doc_tokens, sequence_id, offset.

    A document is its text's ids and end_id.  Sequence k holds tokens k * length up to
    (k + 1) * length of all documents in file order, so padding is under one sequence in all.

    A null or empty text is end_id alone.  Null ids and repeated rows are packed like others.
    A text of any length is cut as needed.  Other columns are not read.  No rows give no rows.
    """
    ws = Workspace(docs.sparkSession, "packing")
    tokens = ws.save(tokenized(docs, key, text, tokenizer or default_tokenizer(), end_id), "tokens")
    parts = tokens.groupBy("part").agg(F.sum("n").alias("total"))
    # one row per partition of the input; written, so that its size is known and decides how it is joined
    offsets = ws.save(parts.select("part", (F.sum("total").over(W.orderBy("part")) - F.col("total")).alias("base")), "offsets")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[list] = [[] for _ in range(8)]
            for begin, doc, n, ids in zip(*(batch.column(k).to_pylist() for k in range(4)), strict=True):
                own = np.frombuffer(ids, dtype="<u2" if len(ids) == 2 * n else "<u4").astype("<u4")
                at = 0
                while at < n:
                    seq, off = divmod(begin + at, length)
                    take = min(n - at, length - off)
                    cut = own[at : at + take].tobytes()
                    for k, v in enumerate((doc, at, take, cut, zlib.crc32(cut), n, seq, off)):
                        out[k].append(v)
                    at += take
            kinds = [pa.int64()] * 3 + [pa.binary()] + [pa.int64()] * 4
            yield pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(out, kinds, strict=True)], ["id", "start", "length", "ids", "ids_crc32", "doc_tokens", "sequence_id", "offset"])

    rows = tokens.join(offsets, "part").select((F.col("base") + F.col("begin")).alias("begin"), "id", "n", "ids")
    return rows.mapInArrow(K.sliced(run), "id long, start long, length long, ids binary, ids_crc32 long, doc_tokens long, sequence_id long, offset long")
