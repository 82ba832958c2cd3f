"""Connected components of an edge list, as alternating star joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillflow.llm.common import Tables


def components(edges: DataFrame, keep: Tables | None = None) -> DataFrame:
    """``(node, component)`` for every node of ``edges`` (columns a, b: long); component is the least node reachable.

    Large-star and small-star steps alternate until nothing changes, about
    log(nodes) times. A step is one aggregation with partial sums and one join,
    never a collected neighbourhood, so a node with very many edges is no group
    in one task: the join's large side is split by adaptive execution. Each
    step's table is deleted once the next is written; ``keep`` holds the last
    one, which the result reads. Nulls and self-loops are ignored; an empty list
    gives an empty result.
    """
    keep = keep or Tables(edges.sparkSession)
    edges = keep(
        edges.where("a IS NOT NULL AND b IS NOT NULL AND a <> b")
        .select(F.greatest("a", "b").alias("hi"), F.least("a", "b").alias("lo"))
        .distinct()
    )
    state = _state(edges)
    while state[0]:
        before, edges = edges, keep(_small_star(_large_star(edges)))
        keep.drop(before)
        after = _state(edges)
        if after == state:
            break
        state = after
    nodes = edges.select(F.col("hi").alias("node"), F.col("lo").alias("component"))
    roots = edges.select(F.col("lo").alias("node")).distinct()
    return nodes.unionByName(roots.withColumn("component", F.col("node")))


def _state(edges: DataFrame) -> tuple:
    """What stays the same once no edge changes: count and an order-free hash."""
    r = edges.agg(F.count("*").alias("n"), F.sum(F.xxhash64("hi", "lo").cast("decimal(38,0)")).alias("h")).first()
    return r["n"], r["h"]


def _large_star(edges: DataFrame) -> DataFrame:
    """Link each larger neighbour of a node to the least of the node and its neighbours."""
    both = edges.select(F.col("hi").alias("v"), F.col("lo").alias("u")).unionByName(
        edges.select(F.col("lo").alias("v"), F.col("hi").alias("u"))
    )
    least = both.groupBy("v").agg(F.min("u").alias("m")).select("v", F.least("v", "m").alias("m"))
    return (
        both.where("u > v").join(least, "v").where("u <> m").select(F.col("u").alias("hi"), F.col("m").alias("lo")).distinct()
    )


def _small_star(edges: DataFrame) -> DataFrame:
    """Link each smaller neighbour of a node, and the node, to the least of them."""
    least = edges.groupBy("hi").agg(F.min("lo").alias("m"))
    moved = edges.join(least, "hi").where("lo <> m").select(F.col("lo").alias("hi"), F.col("m").alias("lo"))
    return moved.unionByName(least.select("hi", F.col("m").alias("lo"))).distinct()
