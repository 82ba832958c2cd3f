"""BPE encoding and decoding with a contiguous rank array.

A word is held as its part boundaries, one part between two of them, next to an
array of the merge ranks of adjacent parts. The array is scanned for its least
rank, that boundary is deleted and the ranks left and right of it are looked up
anew, until no adjacent pair has a rank. That suits short words, which almost
all are; a word of many parts takes the same merges in the same order from a heap.
Ids of words are kept in a bounded table per worker.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillflow.llm.common import boxed, unboxed
from tillflow.llm.vocabulary import END, Splitter, Vocabulary, load

#: Words with more parts are merged with a heap.
SHORT = 200
#: Words whose ids a worker remembers.
REMEMBER = 100_000
#: Rows and characters of an output batch, about.
ROWS, CHARS = 1000, 1 << 20

_NONE = 1 << 60
_workers: dict[tuple, Codec] = {}


class Codec(dict):
    """Ids of words, packed; looking up an unknown word encodes it."""

    def __init__(self, vocabulary: Vocabulary):
        super().__init__()
        ids = vocabulary.id_of
        self._split = Splitter(vocabulary)
        self._tokens = vocabulary.tokens
        self._special = {s: np.array([ids[s]], "<u4").tobytes() for s in vocabulary.special}
        self._first = [0] * 256
        self._last = [0] * 256
        for letter, byte in vocabulary.byte_of.items():
            self._first[byte], self._last[byte] = ids[letter], ids[letter + END]
        self._rank = {left << 32 | right: rank for rank, (left, right, _) in enumerate(vocabulary.merges)}
        self._merged = [m for _, _, m in vocabulary.merges]

    def __missing__(self, word: str) -> bytes:
        out = np.array(self.word_ids(word), "<u4").tobytes()
        self[word] = out
        return out

    def word_ids(self, word: str) -> list[int]:
        data = word.encode("utf-8", "replace")
        parts = [self._first[b] for b in data]
        parts[-1] = self._last[data[-1]]
        return self._merge_short(parts) if len(parts) <= SHORT else self._merge_long(parts)

    def _merge_short(self, parts: list[int]) -> list[int]:
        rank, merged = self._rank.get, self._merged
        ranks = [rank(a << 32 | b, _NONE) for a, b in zip(parts, parts[1:])]
        while ranks:
            least = min(ranks)
            if least == _NONE:
                break
            i = ranks.index(least)
            part = parts[i] = merged[least]
            del parts[i + 1], ranks[i]
            if i:
                ranks[i - 1] = rank(parts[i - 1] << 32 | part, _NONE)
            if i < len(ranks):
                ranks[i] = rank(part << 32 | parts[i + 1], _NONE)
        return parts

    def _merge_long(self, parts: list[int]) -> list[int]:
        rank, merged = self._rank.get, self._merged
        n = len(parts)
        before, after = list(range(-1, n - 1)), list(range(1, n + 1))
        heap = [(r, i, a, b) for i, (a, b) in enumerate(zip(parts, parts[1:])) if (r := rank(a << 32 | b, _NONE)) != _NONE]
        heapq.heapify(heap)
        while heap:
            least, i, a, b = heapq.heappop(heap)
            j = after[i]
            if parts[i] != a or j >= n or parts[j] != b:
                continue  # one of the two has been merged since
            part = parts[i] = merged[least]
            parts[j] = -1
            after[i] = after[j]
            if after[i] < n:
                before[after[i]] = i
                if (r := rank(part << 32 | parts[after[i]], _NONE)) != _NONE:
                    heapq.heappush(heap, (r, i, part, parts[after[i]]))
            if (h := before[i]) >= 0 and (r := rank(parts[h] << 32 | part, _NONE)) != _NONE:
                heapq.heappush(heap, (r, h, parts[h], part))
        return [p for p in parts if p >= 0]

    def encode(self, text: str | None) -> bytes:
        """Ids as little-endian unsigned 32-bit integers; special tokens written in the text are recognised."""
        if not text:
            return b""
        if len(self) > REMEMBER:
            self.clear()
        look = self.__getitem__
        return b"".join([self._special[words[0]] if special else b"".join(map(look, words)) for special, words in self._split.parts(text)])

    def decode(self, ids: bytes) -> str:
        """The tokens' own spellings with a blank between two, as a tokenizer without a decoder gives them."""
        return " ".join(map(self._tokens.__getitem__, np.frombuffer(ids, "<u4").tolist()))


def _codec(shared) -> Codec:
    """One codec per worker process, whatever the number of its tasks."""
    v = shared.value
    key = (len(v.tokens), len(v.merges), hash(v.tokens))
    if key not in _workers:
        _workers.clear()
        _workers[key] = Codec(v)
    return _workers[key]


def _pieces(batch: pa.RecordBatch, texts: list) -> Iterator[tuple[int, int]]:
    start = chars = 0
    for i, t in enumerate(texts):
        chars += len(t or "")
        if chars >= CHARS or i + 1 - start >= ROWS:
            yield start, i + 1
            start, chars = i + 1, 0
    if start < len(texts):
        yield start, len(texts)


def round_trip(docs: DataFrame, vocabulary: Vocabulary | None = None) -> DataFrame:
    """``docs`` with ``n_tokens``, ``ids`` (binary: little-endian unsigned 32-bit) and ``decoded`` of the ``text`` column.

    A null or empty text has no tokens, an empty ``ids`` and an empty
    ``decoded``. Columns of those names in ``docs`` are replaced, all others
    pass through; rows are independent, so repeated ones give equal results.
    """
    rest = unboxed(boxed(docs, adds=("n_tokens", "ids", "decoded")))
    shared = docs.sparkSession.sparkContext.broadcast(vocabulary or load())
    at = [c.lower() for c in rest.columns].index("text")
    schema = T.StructType(
        [
            *rest.schema.fields,
            T.StructField("n_tokens", T.LongType()),
            T.StructField("ids", T.BinaryType()),
            T.StructField("decoded", T.StringType()),
        ]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = _codec(shared)
        for batch in batches:
            texts = batch.column(at).to_pylist()
            for a, b in _pieces(batch, texts):
                ids = [codec.encode(t) for t in texts[a:b]]
                new = [
                    pa.array([len(x) // 4 for x in ids], pa.int64()),
                    pa.array(ids, pa.binary()),
                    pa.array([codec.decode(x) for x in ids], pa.string()),
                ]
                yield pa.RecordBatch.from_arrays([*batch.slice(a, b - a).columns, *new], names=schema.names)

    return rest.mapInArrow(run, schema)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Digests of the ids and of the decoded text of every document."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return round_trip(docs).select(
        "doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"), F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256")
    )
