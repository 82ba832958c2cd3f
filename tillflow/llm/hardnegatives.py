"""Hard-negative mining on exact integer scores.

Anchors are a stated query set that is held against all rows. They are taken in
blocks of bounded size; each block is broadcast, the rows stream past it in
tiles, and a tile of scores is one Strassen product of int64 matrices. Per
anchor two kinds of heaps follow, both mergeable: the best rows of its own label
(positives), and for each positive the best rows of other labels whose score
lies in a window below the positive's. A task merges the heaps of its tiles,
Spark those of the tasks.

Strassen adds and subtracts before it multiplies, and int64 arithmetic is exact
modulo 2**64. A score fits into 63 bits because larger components take no part,
so the result is exact however large the sums in between.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tillflow.llm.common import durable, table

#: Positives of an anchor, and negatives of each positive.
POSITIVES, NEGATIVES = 5, 10
#: A negative's score lies within these percentages of the positive's.
LEAST, MOST = 30, 90
#: Components are multiplied by this and rounded down.
SCALE = 256
#: Anchors times components of a broadcast block: 16 MB of int64.
BLOCK_VALUES = 1 << 21
#: Anchors and rows of one tile of scores.
TILE = (512, 4096)
#: Strassen's recursion ends at matrices with a side of this or less.
LEAF = 32


def strassen(a: np.ndarray, b: np.ndarray, leaf: int = LEAF) -> np.ndarray:
    """The product of two int64 matrices, exact modulo 2**64.

    Seven products of half-size matrices instead of eight; sides of odd length
    are padded with a zero row or column.
    """
    (m, k), n = a.shape, b.shape[1]
    if min(m, k, n) <= leaf:
        return a @ b
    if m % 2 or k % 2 or n % 2:
        a = np.pad(a, ((0, m % 2), (0, k % 2)))
        b = np.pad(b, ((0, k % 2), (0, n % 2)))
    y, x, z = a.shape[0] // 2, a.shape[1] // 2, b.shape[1] // 2
    a11, a12, a21, a22 = a[:y, :x], a[:y, x:], a[y:, :x], a[y:, x:]
    b11, b12, b21, b22 = b[:x, :z], b[:x, z:], b[x:, :z], b[x:, z:]
    p1 = strassen(a11 + a22, b11 + b22, leaf)
    p2 = strassen(a21 + a22, b11, leaf)
    p3 = strassen(a11, b12 - b22, leaf)
    p4 = strassen(a22, b21 - b11, leaf)
    p5 = strassen(a11 + a12, b22, leaf)
    p6 = strassen(a21 - a11, b11 + b12, leaf)
    p7 = strassen(a12 - a22, b21 + b22, leaf)
    out = np.empty((2 * y, 2 * z), np.int64)
    out[:y, :z], out[:y, z:] = p1 + p4 - p5 + p7, p3 + p5
    out[y:, :z], out[y:, z:] = p2 + p4, p1 - p2 + p3 + p6
    return out[:m, :n]


def largest_component(width: int) -> int:
    """The largest magnitude for which 100 times any inner product of ``width`` components fits into 63 bits."""
    return math.isqrt((2**63 - 1) // (100 * max(width, 1)))


def rows_of(vectors: DataFrame, vec_id: Column, label: Column, embedding: Column) -> DataFrame:
    """(vec_id, label, q array<long>) of the rows that take part."""
    x = embedding.cast("array<double>")
    out = vectors.select(vec_id.cast("long").alias("vec_id"), label.cast("long").alias("label"), x.alias("x"))
    whole = F.forall("x", lambda v: F.coalesce(~F.isnan(v) & (F.abs(v) < float("inf")), F.lit(False)))
    out = out.where(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & F.col("x").isNotNull() & whole)
    top = F.floor(F.sqrt(F.lit((2**63 - 1) // 100) / F.greatest(F.size("x"), F.lit(1))))
    fits = F.forall("x", lambda v: F.abs(v * SCALE) <= top - 1)
    return out.where(fits).select("vec_id", "label", F.transform("x", lambda v: F.floor(v * SCALE).cast("long")).alias("q"))


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    """Rows of a list column as int64, shorter ones padded with zeros."""
    lengths = np.diff(column.offsets.to_numpy())
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
    out = np.zeros((len(lengths), max(width, int(lengths.max(initial=0)))), np.int64)
    out[np.arange(out.shape[1]) < lengths[:, None]] = flat
    return out


def _best(scores: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Places of the first k: highest score first, ties by smaller id."""
    if len(scores) > k:
        at = np.flatnonzero(scores >= np.partition(scores, -k)[-k])
        return at[np.lexsort((ids[at], -scores[at]))[:k]]
    return np.lexsort((ids, -scores))


class Heap:
    """The first k (score, id) offered so far."""

    __slots__ = ("k", "scores", "ids")

    def __init__(self, k: int):
        self.k, self.scores, self.ids = k, np.zeros(0, np.int64), np.zeros(0, np.int64)

    def offer(self, scores: np.ndarray, ids: np.ndarray) -> None:
        if len(self.scores) == self.k:
            near = scores >= self.scores[-1]
            scores, ids = scores[near], ids[near]
        if len(scores):
            scores, ids = np.concatenate([self.scores, scores]), np.concatenate([self.ids, ids])
            first = _best(scores, ids, self.k)
            self.scores, self.ids = scores[first], ids[first]


def _tiles(batches: Iterator[pa.RecordBatch], anchors: dict) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
    """(first anchor, scores, row ids, row labels) of every tile."""
    for batch in batches:
        for at in range(0, batch.num_rows, TILE[1]):
            b = batch.slice(at, TILE[1])
            q = _matrix(b.column(2), anchors["q"].shape[1])
            ids, labels = b.column(0).to_numpy(), b.column(1).to_numpy()
            a = anchors["q"]
            if q.shape[1] > a.shape[1]:
                a = np.pad(a, ((0, 0), (0, q.shape[1] - a.shape[1])))
            for first in range(0, len(a), TILE[0]):
                yield first, strassen(a[first : first + TILE[0]], np.ascontiguousarray(q.T)), ids, labels


def _positives(rows: DataFrame, block) -> DataFrame:
    """(anchor_id, score, id): each task's best rows of the anchor's own label."""

    def run(batches):
        anchors = block.value
        heaps = [Heap(POSITIVES) for _ in anchors["ids"]]
        for first, scores, ids, labels in _tiles(batches, anchors):
            for k, row in enumerate(scores, first):
                mine = np.flatnonzero((labels == anchors["labels"][k]) & (ids != anchors["ids"][k]))
                heaps[k].offer(row[mine], ids[mine])
        yield from _heap_rows(heaps, anchors["ids"], np.zeros(len(heaps), np.int64))

    return rows.mapInArrow(run, "anchor_id long, place long, score long, id long").drop("place")


def _negatives(rows: DataFrame, block) -> DataFrame:
    """(anchor_id, place, score, id): each task's best rows of other labels in the window below each positive, by its place."""

    def run(batches):
        anchors = block.value
        owner, place, positive = anchors["owner"], anchors["place"], anchors["positive"]
        starts = np.searchsorted(owner, np.arange(len(anchors["ids"]) + 1))
        heaps = [Heap(NEGATIVES) for _ in owner]
        for first, scores, ids, labels in _tiles(batches, anchors):
            for k, row in enumerate(scores, first):
                if starts[k] == starts[k + 1]:
                    continue
                other = (labels != anchors["labels"][k]) & (ids != anchors["ids"][k])
                hundred = 100 * row
                for j in range(starts[k], starts[k + 1]):
                    mine = np.flatnonzero(other & (hundred >= LEAST * positive[j]) & (hundred <= MOST * positive[j]))
                    heaps[j].offer(row[mine], ids[mine])
        yield from _heap_rows(heaps, anchors["ids"][owner], place)

    return rows.mapInArrow(run, "anchor_id long, place long, score long, id long")


def _heap_rows(heaps: list[Heap], anchors: np.ndarray, places: np.ndarray, rows: int = 1 << 16) -> Iterator[pa.RecordBatch]:
    sizes = np.array([len(h.ids) for h in heaps], np.int64)
    if not sizes.sum():
        return
    columns = [np.repeat(anchors, sizes), np.repeat(places, sizes), np.concatenate([h.scores for h in heaps]), np.concatenate([h.ids for h in heaps])]
    for at in range(0, len(columns[0]), rows):
        yield pa.RecordBatch.from_arrays([pa.array(c[at : at + rows]) for c in columns], ["anchor_id", "place", "score", "id"])


def _ranked(heaps: DataFrame, by: list[str], k: int, name: str) -> DataFrame:
    """The heaps of all tasks merged: the first k of each, numbered from 1."""
    order = Window.partitionBy(*by).orderBy(F.desc("score"), "id")
    return heaps.withColumn(name, F.row_number().over(order)).where(F.col(name) <= k)


def _block(spark: SparkSession, anchors: DataFrame, positives: DataFrame | None = None):
    """The anchors of one block, by id, and their positives, in a broadcast."""
    rows = anchors.toArrow().sort_by("vec_id")
    lists = rows.column("q").combine_chunks()
    out = {"ids": rows.column("vec_id").to_numpy(), "labels": rows.column("label").to_numpy(), "q": _matrix(lists, 0)}
    if positives is not None:
        p = positives.select("anchor_id", "place", "score").toArrow().sort_by([("anchor_id", "ascending"), ("place", "ascending")])
        out |= {
            "owner": np.searchsorted(out["ids"], p.column("anchor_id").to_numpy()),
            "place": p.column("place").to_numpy().astype(np.int64),
            "positive": p.column("score").to_numpy(),
        }
    return spark.sparkContext.broadcast(out)


def hard_negatives(vectors: DataFrame, is_anchor: Column, label: Column | None = None, embedding: str = "embedding") -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score).

    ``is_anchor`` tells, from the columns vec_id and label, which rows are
    anchors. A score is the inner product of ``floor(256 * x)``; higher ones
    come first, ties by smaller vec_id. Each anchor's first 5 other rows of its
    label are its positives; for each of them the first 10 rows of other labels
    follow whose score is between 30 and 90 percent of the positive's.

    Rows with a null vec_id, label or vector, or a null or non-finite component,
    take no part; nor do those with a component so large that 100 times a score
    would not fit into a long (``largest_component``). A shorter vector counts
    as padded with zeros, an empty one scores 0. Repeated rows count one by one,
    but rows with the anchor's own vec_id are no partners of it; of several
    anchors that share a vec_id the one with least (label, vector) stays. A
    positive without a row in its window, an anchor without a positive, and an
    empty table give no rows. Other columns are ignored.
    """
    spark = vectors.sparkSession
    rows = durable(rows_of(vectors, F.col("vec_id"), F.col("label") if label is None else label, F.col(embedding)))
    anchors = rows.where(is_anchor).groupBy("vec_id").agg(F.min(F.struct("label", "q")).alias("least")).select("vec_id", "least.*")
    anchors = durable(anchors)
    size = anchors.agg(F.count("*").alias("n"), F.max(F.size("q")).alias("width")).first()
    blocks = max(1, math.ceil(size["n"] * max(size["width"] or 1, 1) / BLOCK_VALUES))
    parts = []
    for k in range(blocks):
        mine = anchors.where(F.pmod(F.xxhash64("vec_id"), F.lit(blocks)) == k)
        block = _block(spark, mine)
        positives = durable(_ranked(_positives(rows, block), ["anchor_id"], POSITIVES, "place"))
        block.unpersist()
        block = _block(spark, mine, positives)
        negatives = _ranked(_negatives(rows, block), ["anchor_id", "place"], NEGATIVES, "rank")
        found = positives.select("anchor_id", "place", F.col("id").alias("positive_id"), F.col("score").alias("positive_score")).join(
            negatives.select("anchor_id", "place", "rank", F.col("id").alias("negative_id"), F.col("score").alias("negative_score")), ["anchor_id", "place"]
        )
        parts.append(durable(found))
        block.unpersist()
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hard negatives for every hundredth vector; every seventh row has the next label."""
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0, label)


#: Scores stay far below 2**53 here, so that sums of doubles are exact.
ORACLE = """
WITH taken AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
    list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS q
  FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scored AS (
  SELECT a.vec_id AS anchor_id, a.label = c.label AS same, c.vec_id AS id, list_inner_product(a.q, c.q)::BIGINT AS score
  FROM taken a JOIN taken c ON c.vec_id <> a.vec_id WHERE a.vec_id % 100 = 0
), positives AS (
  SELECT anchor_id, id AS positive_id, score AS positive_score FROM scored WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, id) <= 5
), negatives AS (
  SELECT p.*, s.id AS negative_id, s.score AS negative_score,
    row_number() OVER (PARTITION BY p.anchor_id, p.positive_id ORDER BY s.score DESC, s.id) AS rank
  FROM positives p JOIN scored s ON s.anchor_id = p.anchor_id AND NOT s.same
    AND 30 * p.positive_score <= 100 * s.score AND 100 * s.score <= 90 * p.positive_score
)
SELECT anchor_id, positive_id, rank::INTEGER AS rank, negative_id, positive_score, negative_score FROM negatives WHERE rank <= 10
"""
