"""Token counts by a longest-match automaton that never builds a token.

Greedy longest-match word pieces are counted in one pass over a word: the
vocabulary is a trie, and every node knows, for the moment no edge fits, to
which node the unmatched rest leads (its failure link) and how many tokens are
popped on the way. A byte is looked at once, and the number of links followed
is at most the number of bytes, so a word costs time in proportion to its length.

A token with a word-end mark fits at the end of a word only; the mark alone is
no token, so a word may also end in a token without one. A word with a byte that
no token starts with counts as one unknown token.
"""

from __future__ import annotations

from collections import deque

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillflow.llm.common import boxed, unboxed
from tillflow.llm.vocabulary import END, Splitter, Vocabulary, load

#: Words whose counts a worker remembers.
REMEMBER = 100_000

_END = 256
_workers: dict[tuple, Counter] = {}


def pieces_of(vocabulary: Vocabulary) -> list[tuple[int, ...]]:
    """The vocabulary's tokens as bytes, the word-end mark as a symbol of its own; special tokens are left out."""
    out = []
    for token in vocabulary.tokens:
        if token and token not in vocabulary.special:
            body, end = (token[: -len(END)], (_END,)) if token.endswith(END) and token != END else (token, ())
            out.append(tuple(vocabulary.byte_of[c] for c in body) + end)
    return out


class Automaton:
    """Trie with failure links and popped counts. Nodes are numbers; an edge is keyed by node * 512 + symbol."""

    def __init__(self, pieces: list[tuple[int, ...]]):
        edge: dict[int, int] = {}
        symbol, parent, costs = [0], [0], {}
        for piece, cost in [*((p, 1) for p in pieces if p), ((_END,), 0)]:
            node = 0
            for s in piece:
                nxt = edge.get(node << 9 | s)
                if nxt is None:
                    nxt = edge[node << 9 | s] = len(symbol)
                    symbol.append(s)
                    parent.append(node)
                node = nxt
            costs.setdefault(node, cost)
        fail, popped = [-1] * len(symbol), [0] * len(symbol)
        below: dict[int, list[int]] = {}
        for child in range(1, len(symbol)):
            below.setdefault(parent[child], []).append(child)
        queue = deque(below.get(0, ()))
        while queue:
            node = queue.popleft()
            queue.extend(below.get(node, ()))
            if node in costs:
                fail[node], popped[node] = 0, costs[node]
                continue
            up, count = fail[parent[node]], popped[parent[node]]
            while up >= 0 and (up << 9 | symbol[node]) not in edge:
                count += popped[up]
                up = fail[up]
            if up >= 0:
                fail[node], popped[node] = edge[up << 9 | symbol[node]], count
        self._edge, self._fail, self._popped = edge, fail, popped

    def count(self, word: bytes) -> int:
        """Tokens of a non-empty word; 1 if it cannot be cut."""
        edge, fail, popped = self._edge.get, self._fail, self._popped
        node = total = 0
        for s in (*word, _END):
            nxt = edge(node << 9 | s)
            while nxt is None:
                total += popped[node]
                node = fail[node]
                if node < 0:
                    return 1
                nxt = edge(node << 9 | s)
            node = nxt
        while node:
            total += popped[node]
            node = fail[node]
            if node < 0:
                return 1
        return total


class Counter(dict):
    """Token counts of words, made when first looked up."""

    def __init__(self, vocabulary: Vocabulary):
        super().__init__()
        self._split = Splitter(vocabulary)
        self._automaton = Automaton(pieces_of(vocabulary))

    def __missing__(self, word: str) -> int:
        out = self[word] = self._automaton.count(word.encode("utf-8", "replace"))
        return out

    def text(self, text: str | None) -> tuple[int, int]:
        """(words, tokens); a special token written in the text is one of each."""
        if not text:
            return 0, 0
        if len(self) > REMEMBER:
            self.clear()
        words = tokens = 0
        for special, found in self._split.parts(text):
            words += len(found)
            tokens += len(found) if special else sum(map(self.__getitem__, found))
        return words, tokens


def _counter(shared) -> Counter:
    v = shared.value
    key = (len(v.tokens), hash(v.tokens))
    if key not in _workers:
        _workers.clear()
        _workers[key] = Counter(v)
    return _workers[key]


def token_counts(docs: DataFrame, vocabulary: Vocabulary | None = None) -> DataFrame:
    """``docs`` with ``n_words`` and ``n_tokens`` (long) of its ``text`` column.

    A null or empty text has none of either. Columns of those names in ``docs``
    are replaced, all others pass through; repeated rows are counted one by one.
    """
    shared = docs.sparkSession.sparkContext.broadcast(vocabulary or load())

    @F.pandas_udf("n_words long, n_tokens long")
    def counted(text: pd.Series) -> pd.DataFrame:
        counter = _counter(shared)
        return pd.DataFrame([counter.text(t) for t in text], columns=["n_words", "n_tokens"], dtype="int64")

    names = ("n_words", "n_tokens")
    return unboxed(boxed(docs, counted(F.col("text")).alias("n"), adds=names), *[F.col(f"n.{x}").alias(x) for x in names])


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words and greedy word pieces of every document."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return token_counts(docs).select("doc_id", "n_words", "n_tokens")
