"""Near-duplicate embeddings by tiles of int8 products.

Equal vectors are one class. Classes are dealt into blocks of bounded size, and
every two blocks meet in one task, which works through them tile by tile:

1. A vector, scaled to length 1, is held as a scale times int8 components. What
   that rounding takes away is a vector whose length is known, so the product of
   two rounded vectors differs from their cosine by at most
   ``scale_x |q_x| lost_y + lost_x scale_y |q_y| + lost_x lost_y``.
2. A tile of products tells most pairs: surely below the threshold, or surely at
   or above it. Only the pairs for which the bound leaves it open are computed
   again in double precision.
3. The task adds up the links of each class and joins what is linked. It returns
   one row per class that has links, never the pairs, so a group of very many
   similar vectors returns as many rows as it has members.

Block rows are taken in waves, so that a wave writes a bounded multiple of the
input to the shuffle however many blocks there are.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillflow.llm.common import Tables, table
from tillflow.llm.components import components

#: Least cosine of a link.
THRESHOLD = 0.95
#: Components in a block, its classes times their length: 16 MB of doubles.
BLOCK_VALUES = 1 << 21
#: A small table has so many blocks too, to be shared out among tasks.
BLOCKS = 6
#: Blocks that each class is sent to in one wave.
WAVE = 6
#: Classes of a tile on either side.
TILE = 1024
#: More than the rounding of doubles adds to any bound.
SLACK = 1e-9

#: A class with links in a task: how many, and the representative of its component there.
_LINKS = "digest binary, rep long, links long, other long"


class Quantised:
    """Vectors of one length: unit vectors, int8 components (as float32, in which their products are exact), and bounds."""

    def __init__(self, x: np.ndarray):
        # largest component first: no square overflows or vanishes
        x = x / np.abs(x).max(axis=1, keepdims=True)
        self.unit = x / np.sqrt(np.einsum("ij,ij->i", x, x))[:, None]
        self.scale = np.abs(self.unit).max(axis=1) / 127
        q = np.rint(self.unit / self.scale[:, None]).astype(np.int8)
        self.lost = np.linalg.norm(self.unit - self.scale[:, None] * q, axis=1) + SLACK
        self.q = q.astype(np.float32)
        self.length = self.scale * np.linalg.norm(self.q.astype(np.float64), axis=1) + SLACK

    def __len__(self) -> int:
        return len(self.unit)

    def rough(self, mine: slice, other: Quantised, theirs: slice) -> tuple[np.ndarray, np.ndarray]:
        """Estimated cosines of a tile, and by how much the true ones may differ."""
        # int8 products of up to 1040 components sum below 2**24; longer ones go in pieces
        a, b = self.q[mine], other.q[theirs]
        dot = sum((a[:, k : k + 1024] @ b[:, k : k + 1024].T).astype(np.float64) for k in range(0, a.shape[1], 1024))
        dot *= self.scale[mine][:, None]
        dot *= other.scale[theirs]
        bound = np.outer(self.length[mine] + self.lost[mine], other.lost[theirs]) + np.outer(self.lost[mine], other.length[theirs])
        return dot, bound + SLACK


def linked(a: Quantised, mine: slice, b: Quantised, theirs: slice, threshold: float = THRESHOLD) -> tuple[np.ndarray, int]:
    """The links of a tile as booleans, and how many pairs were computed in double precision."""
    dot, bound = a.rough(mine, b, theirs)
    sure = dot - bound >= threshold
    rows, columns = np.nonzero((dot + bound >= threshold) & ~sure)
    for at in range(0, len(rows), 1 << 16):
        r, c = rows[at : at + (1 << 16)], columns[at : at + (1 << 16)]
        exact = np.einsum("ij,ij->i", a.unit[mine][r], b.unit[theirs][c])
        sure[r, c] = exact >= threshold
    return sure, len(rows)


def _joined(root: np.ndarray, a: np.ndarray, b: np.ndarray) -> None:
    """Join the components of a[k] and b[k]; ``root`` holds the least member of each."""
    while True:
        x, y = root[a], root[b]
        apart = x != y
        if not apart.any():
            return
        a, b, x, y = a[apart], b[apart], x[apart], y[apart]
        np.minimum.at(root, np.maximum(x, y), np.minimum(x, y))
        while True:
            after = root[root]
            if (after == root).all():
                break
            root[:] = after


def compared(left: Quantised, right: Quantised | None, copies: np.ndarray, threshold: float = THRESHOLD) -> tuple[np.ndarray, np.ndarray]:
    """Links of each class (copies counted) and its component, for two blocks, or for one with itself if ``right`` is None.

    Places count the left block's classes first, then the right's.
    """
    alone = right is None
    right = left if alone else right
    shift = 0 if alone else len(left)
    count = np.zeros(len(copies), np.int64)
    root = np.arange(len(copies))
    for i in range(0, len(left), TILE):
        for j in range(i if alone else 0, len(right), TILE):
            mine, theirs = slice(i, i + TILE), slice(j, j + TILE)
            links, _ = linked(left, mine, right, theirs, threshold)
            if alone and i == j:
                links = np.triu(links, 1)
            if not links.any():
                continue
            rows, columns = slice(i, i + links.shape[0]), slice(j + shift, j + shift + links.shape[1])
            count[rows] += links @ copies[columns]
            count[columns] += links.T @ copies[rows]
            links &= root[rows][:, None] != root[columns]
            r, c = np.nonzero(links)
            _joined(root, r + rows.start, c + columns.start)
    return count, root


def _vectors(vectors: DataFrame, embedding: str) -> DataFrame:
    """vec_id, digest and x (doubles, as bytes) of each row; the latter two are null if it links with nothing."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 4096):
                b = batch.slice(at, 4096)
                data = []
                for row in b.column(1):
                    x = row.values.to_numpy(zero_copy_only=False) + 0.0 if row.is_valid and row.values.null_count == 0 else np.zeros(0)
                    data.append(x.tobytes() if np.isfinite(x).all() and x.any() else None)
                data = [x if i else None for x, i in zip(data, b.column(0).is_valid().to_pylist())]
                digests = [None if x is None else xxhash.xxh3_128_digest(x) for x in data]
                yield pa.RecordBatch.from_arrays([b.column(0), pa.array(digests, pa.binary()), pa.array(data, pa.binary())], ["vec_id", "digest", "x"])

    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col(embedding).cast("array<double>").alias("x"))
    return rows.mapInArrow(run, "vec_id long, digest binary, x binary")


def _compare(threshold: float):
    """One task: two blocks, or one, of classes."""

    def run(t: pa.Table) -> pa.Table:
        kind = (t.column("i")[0].as_py(), t.column("j")[0].as_py())
        width = t.column("width")[0].as_py()
        own = np.asarray(t.column("block"))
        order = np.argsort(own != kind[0], kind="stable")
        n = int((own == kind[0]).sum())
        x = np.frombuffer(b"".join(t.column("x").to_pylist()), np.float64).reshape(-1, width)[order]
        right = Quantised(x[n:]) if kind[0] != kind[1] and n < len(x) else None
        copies = np.asarray(t.column("copies"))[order]
        reps = np.asarray(t.column("rep"))[order]
        if kind[0] != kind[1] and (right is None or n == 0):
            count, root = np.zeros(len(x), np.int64), np.arange(len(x))
        else:
            count, root = compared(Quantised(x[:n]), right, copies, threshold)
        at = np.flatnonzero(count)
        digests = t.column("digest").take(pa.array(order[at]))
        return pa.table({"digest": digests, "rep": reps[at], "links": count[at], "other": reps[root[at]]})

    return run


def near_duplicates(vectors: DataFrame, embedding: str = "embedding", threshold: float = THRESHOLD) -> DataFrame:
    """(vec_id, n_links, component_id, kept) for every row of ``vectors`` (vec_id and the vector; other columns are ignored).

    Two vectors are linked when their cosine in double precision is at least
    ``threshold`` (between 0 and 1). n_links counts the other rows linked
    directly, component_id is the least vec_id reachable, and kept says that it
    is the row's own. Vectors that are null, empty or zero, or hold null or
    non-finite components, link with nothing, and vectors of different lengths
    are not linked. Rows that share a vec_id are one node: what either is linked
    with belongs to one component, but each has its own n_links. A row without a
    vec_id links with nothing; its component_id is null and it is kept. An empty
    table gives an empty result.
    """
    with Tables(vectors.sparkSession) as keep:
        return keep.result(_groups(vectors, embedding, threshold, keep))


def _groups(vectors: DataFrame, embedding: str, threshold: float, keep: Tables) -> DataFrame:
    rows = keep(_vectors(vectors, embedding))
    real = rows.where("digest IS NOT NULL")
    classes = keep(
        real.groupBy("digest")
        .agg(F.min("vec_id").alias("rep"), F.count("*").alias("copies"), F.first("x").alias("x"))
        .withColumn("width", (F.length("x") / 8).cast("long"))
    )
    sizes = {r["width"]: r["n"] for r in classes.groupBy("width").agg(F.count("*").alias("n")).collect()}
    links = vectors.sparkSession.createDataFrame([], _LINKS)
    for width, n in sorted(sizes.items()):
        for wave in _waves(classes.where(F.col("width") == width), width, n, threshold):
            links = links.unionByName(keep(wave))

    several = real.groupBy("vec_id").agg(F.min("digest").alias("x"), F.max("digest").alias("y")).where("x <> y")
    named = real.select("vec_id", "digest").join(several.select("vec_id"), "vec_id", "left_semi").join(classes.select("digest", "rep"), "digest")
    edges = links.select(F.col("rep").alias("a"), F.col("other").alias("b")).unionByName(named.select(F.col("rep").alias("a"), F.col("vec_id").alias("b")))
    comp = components(edges, keep)
    counted = links.groupBy("digest").agg(F.sum("links").alias("links"))
    told = (
        classes.select("digest", "rep", "copies")
        .join(counted, "digest", "left")
        .join(comp.withColumnRenamed("node", "rep"), "rep", "left")
        .where("copies > 1 OR links IS NOT NULL OR component IS NOT NULL")
        .select("digest", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"), F.coalesce("component", "rep").alias("component_id"))
    )
    return rows.select("vec_id", "digest").join(told, "digest", "left").select(
        "vec_id",
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        F.coalesce("component_id", "vec_id").alias("component_id"),
        F.coalesce(F.col("vec_id") == F.coalesce("component_id", "vec_id"), F.lit(True)).alias("kept"),
    )


def _waves(classes: DataFrame, width: int, n: int, threshold: float) -> Iterator[DataFrame]:
    """Links of classes of one width, for every pair of blocks, wave by wave."""
    blocks = max(math.ceil(n * width / BLOCK_VALUES), min(BLOCKS, math.ceil(n / TILE)))
    dealt = classes.withColumn("block", F.pmod(F.xxhash64("digest"), F.lit(blocks)).cast("int"))
    for first in range(0, blocks, WAVE):
        # pairs (i, j), i <= j, whose lesser block belongs to this wave
        rows = F.sequence(F.lit(first), F.lit(min(first + WAVE, blocks) - 1))
        lesser = F.transform(F.filter(rows, lambda i: i <= F.col("block")), lambda i: F.struct(i.alias("i"), F.col("block").alias("j")))
        greater = F.transform(F.sequence(F.col("block") + 1, F.lit(blocks - 1)), lambda j: F.struct(F.col("block").alias("i"), j.alias("j")))
        own = F.when(F.col("block").between(first, first + WAVE - 1) & (F.col("block") < blocks - 1), F.concat(lesser, greater)).otherwise(lesser)
        pairs = dealt.select("*", F.explode(own).alias("pair")).select("*", "pair.i", "pair.j").drop("pair")
        yield pairs.groupBy("i", "j").applyInArrow(_compare(threshold), _LINKS)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links and groups among all vectors, whatever their labels."""
    return near_duplicates(table(spark, sf_dir, "embeddings"))


#: Cosines of all pairs in doubles; components by recursion.
ORACLE = """
WITH RECURSIVE taken AS (
  SELECT vec_id, list_transform(embedding, lambda x: x::DOUBLE) AS x FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0
), links AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM taken a JOIN taken b
  ON a.vec_id <> b.vec_id AND len(a.x) = len(b.x) AND list_cosine_similarity(a.x, b.x) >= 0.95
), reach AS (SELECT vec_id AS v, vec_id AS c FROM embeddings UNION SELECT l.b, r.c FROM reach r JOIN links l ON l.a = r.v),
comp AS (SELECT v, min(c) AS c FROM reach GROUP BY v),
counted AS (SELECT a, count(*) AS n FROM links GROUP BY a)
SELECT e.vec_id, coalesce(n, 0) AS n_links, c AS component_id, e.vec_id = c AS kept
FROM embeddings e JOIN comp ON v = e.vec_id LEFT JOIN counted ON a = e.vec_id
"""
