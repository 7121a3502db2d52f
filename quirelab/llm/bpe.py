"""Byte-level BPE encoding of a whole corpus with a public vocabulary (problem 8).

Each pre-token is merged with a priority queue of merge ranks over a doubly linked list of symbols;
queue entries whose symbols have changed are stale and skipped, so a run of n bytes costs O(n log n)
however long it is. Distinct pre-tokens are memoised per Python worker. Decoding concatenates vocabulary
strings.

Defined cases: a null and an empty text give the empty list; texts are encoded whole; strings that
look like special tokens are ordinary text; a null doc_id stays null; repeated rows give repeated rows.
"""

from __future__ import annotations

import base64
import heapq
from array import array
from collections.abc import Iterator

import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession, functions as F

DEFAULT_VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"
#: Fixed value: the pre-token pattern published with the vocabulary.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
#: Memoised pre-tokens per worker; the memo is emptied when full, results do not depend on it.
MEMO = 400_000


def parse_ranks(raw: bytes) -> dict[bytes, int]:
    """Vocabulary bytes -> id, from a rank file (base64 token, blank, id per line)."""
    return {base64.b64decode(a): int(b) for a, b in (line.split() for line in raw.splitlines() if line)}


def merge(word: bytes, ranks: dict[bytes, int]) -> list[int]:
    """Ids of one pre-token."""
    whole = ranks.get(word)
    if whole is not None:
        return [whole]
    n = len(word)
    end, after, before = list(range(1, n + 1)), list(range(1, n + 1)), list(range(-1, n - 1))
    queue = [(r, i, i + 2) for i in range(n - 1) if (r := ranks.get(word[i : i + 2])) is not None]
    heapq.heapify(queue)
    while queue:
        _, i, stop = heapq.heappop(queue)
        j = after[i]
        if end[i] == 0 or j >= n or end[j] != stop:
            continue
        k = after[j]
        end[i], end[j], after[i] = stop, 0, k
        if k < n:
            before[k] = i
            if (r := ranks.get(word[i : end[k]])) is not None:
                heapq.heappush(queue, (r, i, end[k]))
        h = before[i]
        if h >= 0 and (r := ranks.get(word[h:stop])) is not None:
            heapq.heappush(queue, (r, h, stop))
    out, i = [], 0
    while i < n:
        out.append(ranks[word[i : end[i]]])
        i = after[i]
    return out


class Encoder:
    """Text -> ids and back, with a memo of pre-tokens."""

    def __init__(self, ranks: dict[bytes, int], pattern: str = PATTERN):
        self.ranks, self.split, self.memo = ranks, regex.compile(pattern).findall, {}

    def encode(self, text: str | None) -> array:
        out = array("i")
        if not text:
            return out
        memo, extend = self.memo, out.extend
        for piece in self.split(text):
            ids = memo.get(piece)
            if ids is None:
                ids = array("i", merge(piece.encode("utf-8", "surrogatepass"), self.ranks))
                if len(memo) >= MEMO:
                    memo.clear()
                if len(piece) <= 64:
                    memo[piece] = ids
            extend(ids)
        return out

    def decode(self, ids) -> str:
        strings = self.__dict__.setdefault("strings", {i: b for b, i in self.ranks.items()})
        return b"".join(strings[i] for i in ids).decode("utf-8", "replace")


_HELD: dict[str, Encoder] = {}


def _encoder(shared, pattern: str) -> Encoder:
    """The worker's encoder for a broadcast rank file; built once per worker."""
    key = f"{shared.value[1]}|{pattern}"
    if key not in _HELD:
        _HELD.clear()
        _HELD[key] = Encoder(parse_ranks(shared.value[0]), pattern)
    return _HELD[key]


def share_vocabulary(spark: SparkSession, path: str = DEFAULT_VOCABULARY):
    """Broadcast of the rank file as it is (under 1 MB, independent of the data)."""
    with open(path, "rb") as f:
        return spark.sparkContext.broadcast((f.read(), path))


def encode(docs: DataFrame, path: str = DEFAULT_VOCABULARY, pattern: str = PATTERN) -> DataFrame:
    """doc_id, ids of every row of `docs` (needs doc_id, text). One narrow stage, no shuffle."""
    shared = share_vocabulary(docs.sparkSession, path)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        one = _encoder(shared, pattern).encode
        for b in batches:
            values, offsets = array("i"), array("i", [0])
            for t in b.column("text"):
                values.extend(one(t.as_py()))
                offsets.append(len(values))
            lists = pa.ListArray.from_arrays(pa.array(memoryview(offsets), pa.int32()), pa.array(memoryview(values), pa.int32()))
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), lists], ["doc_id", "ids"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(run, "doc_id long, ids array<int>")


def count_tokens(rows: DataFrame, text: str = "text", path: str = DEFAULT_VOCABULARY, pattern: str = PATTERN) -> DataFrame:
    """`rows` without `text`, with n_tokens; 0 for null and empty text."""
    shared = share_vocabulary(rows.sparkSession, path)
    keep = [c for c in rows.columns if c != text]
    schema = ", ".join(f"`{c}` {t}" for c, t in rows.dtypes if c != text) + ", n_tokens long"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        one = _encoder(shared, pattern).encode
        for b in batches:
            n = pa.array([len(one(t.as_py())) for t in b.column(text)], pa.int64())
            yield pa.RecordBatch.from_arrays([*(b.column(c) for c in keep), n], [*keep, "n_tokens"])

    return rows.mapInArrow(run, schema)


def decode(encoded: DataFrame, path: str = DEFAULT_VOCABULARY) -> DataFrame:
    """doc_id, text from doc_id, ids; the inverse of `encode` (null text comes back empty)."""
    shared = share_vocabulary(encoded.sparkSession, path)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        one = _encoder(shared, PATTERN).decode
        for b in batches:
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array([one(x.as_py() or []) for x in b.column("ids")], pa.string())], ["doc_id", "text"])

    return encoded.select("doc_id", "ids").mapInArrow(run, "doc_id long, text string")
