"""Problem 8: the corpus as ids of a public tokenizer.

Byte-level BPE.  The symbols of a piece form a doubly linked list; a priority queue
holds the merge ranks of neighbouring pairs, and entries whose symbols have changed
meanwhile are skipped when they come up.  Pieces repeat, so a worker keeps the packed
ids of those it has met, in a bounded table.
"""

from __future__ import annotations

import base64
import heapq
import json
import os
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.functions import pandas_udf

from quillmill.session import ship_package

VOCABULARY = os.environ.get("QUILLMILL_TOKENIZER", "/opt/tokenizers/byte_bpe_50k.json")
#: Pieces a worker remembers; beyond, the table starts anew.
REMEMBERED = 400_000


def byte_letters() -> dict[str, int]:
    """The printable letter that stands for each byte in vocabulary files: printable bytes for themselves, the rest from 256 on."""
    own = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    out = {chr(b): b for b in own}
    for b in range(256):
        if b not in own:
            out[chr(256 + len(out) - len(own))] = b
    return out


def load_vocabulary(path: str) -> dict[bytes, int]:
    """Bytes to id, from a ``.json`` tokenizer file or a ``.tiktoken`` rank file."""
    if path.endswith(".tiktoken"):
        with open(path, "rb") as f:
            return {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    with open(path, encoding="utf-8") as f:
        model = json.load(f)["model"]
    letters = byte_letters()
    return {bytes(letters[c] for c in w): i for w, i in model["vocab"].items() if all(c in letters for c in w)}


class Tokenizer:
    """Encodes and decodes with one vocabulary; merges are ranked by id, as such vocabularies are ordered by merge."""

    def __init__(self, path: str = VOCABULARY, pattern: str | None = None) -> None:
        import regex

        if pattern is None:
            # Fixed value: how the vocabulary's texts are cut into pieces.
            pattern = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
        self.ranks = load_vocabulary(path)
        self.pieces = regex.compile(pattern)
        self.words = {i: w for w, i in self.ranks.items()}
        self.packed: dict[str, bytes] = {}

    def merge(self, piece: bytes) -> list[int]:
        """Ids of one piece."""
        ranks = self.ranks
        whole = ranks.get(piece)
        if whole is not None:
            return [whole]
        n = len(piece)
        left = list(range(-1, n - 1))
        right = [*range(1, n), -1]
        text: list[bytes | None] = [piece[i : i + 1] for i in range(n)]
        queue: list[tuple[int, int, int]] = []
        for i in range(n - 1):
            r = ranks.get(piece[i : i + 2])
            if r is not None:
                queue.append((r, i, 2))
        heapq.heapify(queue)
        while queue:
            r, i, size = heapq.heappop(queue)
            a = text[i]
            j = right[i]
            if a is None or j < 0 or len(a) + len(text[j]) != size or ranks.get(a + text[j]) != r:
                continue  # stale: one of the two has been merged since
            text[i] = a + text[j]
            text[j] = None
            right[i] = k = right[j]
            if k >= 0:
                left[k] = i
                both = text[i] + text[k]
                r = ranks.get(both)
                if r is not None:
                    heapq.heappush(queue, (r, i, len(both)))
            h = left[i]
            if h >= 0:
                both = text[h] + text[i]
                r = ranks.get(both)
                if r is not None:
                    heapq.heappush(queue, (r, h, len(both)))
        return [ranks[t] for t in text if t is not None]

    def _pack(self, piece: str) -> bytes:
        got = np.array(self.merge(piece.encode("utf-8", "replace")), dtype=np.int32).tobytes()
        if len(piece) <= 64:
            if len(self.packed) >= REMEMBERED:
                self.packed.clear()
            self.packed[piece] = got
        return got

    def encode_packed(self, text: str) -> bytes:
        """Ids as little-endian 32-bit integers."""
        known, pack = self.packed.get, self._pack
        return b"".join([known(p) or pack(p) for p in self.pieces.findall(text)])

    def encode(self, text: str) -> list[int]:
        return np.frombuffer(self.encode_packed(text), dtype=np.int32).tolist()

    def decode(self, ids) -> str:
        return b"".join(self.words[i] for i in ids).decode("utf-8", "replace")


_made: dict[str, Tokenizer] = {}


def tokenizer(path: str) -> Tokenizer:
    if path not in _made:
        _made[path] = Tokenizer(path)
    return _made[path]


def encoded(docs: DataFrame, key: str = "doc_id", text: str = "text", path: str = VOCABULARY, out: str = "ids") -> DataFrame:
    """``key, ids``: each row's text as it stands. The empty text gives the empty list, NULL gives NULL; repeated rows stay."""
    ship_package(docs.sparkSession)
    schema = T.StructType([docs.schema[key], T.StructField(out, T.ArrayType(T.IntegerType()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tok = tokenizer(path)
        item = pa.field("element", pa.int32())
        for b in batches:
            texts = b.column(1).to_pylist()
            for at in range(0, len(texts), 2000):
                part = texts[at : at + 2000]
                packed = [None if t is None else tok.encode_packed(t) for t in part]
                ends = np.cumsum([0] + [len(p) // 4 if p else 0 for p in packed]).astype(np.int32)
                values = pa.array(np.frombuffer(b"".join(p for p in packed if p), dtype=np.int32))
                nulls = [p is None for p in packed]
                lists = pa.ListArray.from_arrays(pa.array(ends), values, type=pa.list_(item), mask=pa.array(nulls) if any(nulls) else None)
                yield pa.RecordBatch.from_arrays([b.column(0).slice(at, len(part)), lists], names=[key, out])

    return docs.select(key, text).mapInArrow(run, schema)


def decoded(ids: Column, path: str = VOCABULARY) -> Column:
    """The text behind a column of ids."""

    @pandas_udf(T.StringType())
    def run(s):
        tok = tokenizer(path)
        return s.map(lambda x: None if x is None else tok.decode(x))

    return run(ids)


def token_counts(docs: DataFrame, by: str = "source", path: str = VOCABULARY) -> DataFrame:
    """Tokens, texts and characters per value of a column; NULL texts count as texts without tokens."""
    t = docs.select("doc_id", by, "text").withColumn("key_", F.struct("doc_id", by, F.length("text").alias("chars")))
    got = encoded(t, key="key_", path=path)
    return got.groupBy(F.col(f"key_.{by}").alias(by)).agg(F.count("*").alias("texts"), F.sum(F.coalesce(F.size("ids"), F.lit(0))).alias("tokens"), F.sum("key_.chars").alias("chars"))
