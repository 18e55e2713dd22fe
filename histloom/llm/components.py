"""Connected components of a distributed edge list."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources.io import cut_lineage


def connected_components(edges: DataFrame) -> DataFrame:
    """(node, component) of every node of ``edges`` (a, b; any ordered type);
    the component is its smallest node.  Self-loops only make their node known;
    no edges give no rows.

    Alternating large-star and small-star steps: each node's larger (smaller)
    neighbours are linked to its smallest one, until nothing changes.  Minima
    are combined before the shuffle and the joins can split hot nodes
    (``split_join``); edges never grow in number.  Each step's edges are stored, so a lost executor
    costs at most one step."""
    nodes = edges.select(F.col("a").alias("n")).union(edges.select("b")).distinct()
    now = cut_lineage(_oriented(edges))
    state = _state(now)
    while True:
        now = cut_lineage(_small_star(_large_star(now)))
        seen = _state(now)
        if seen == state:
            break
        state = seen
    return (nodes.join(now.select(F.col("a").alias("n"), F.col("b").alias("m")), "n", "left")
            .select(F.col("n").alias("node"), F.coalesce("m", "n").alias("component")))


def split_join(rows: DataFrame, keyed: DataFrame, key: str, how: str = "inner") -> DataFrame:
    """``rows`` joined with ``keyed`` (one row per non-null ``key``, often fresh
    from an aggregate on it), keeping the key of ``rows``.  The null-safe
    condition puts an exchange of its own on both sides, so that AQE can split
    a hot key of ``rows``; under a plain one the aggregate's exchange would serve
    the join, which then cannot be split."""
    other = keyed.withColumnRenamed(key, "_split_key")
    return rows.join(other, F.col(key).eqNullSafe(F.col("_split_key")), how).drop("_split_key")


def _oriented(edges: DataFrame) -> DataFrame:
    return (edges.where("a <> b")
            .select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())


def _state(edges: DataFrame) -> tuple:
    """A fingerprint of the edge set: its size and two sums of hashes."""
    h = F.xxhash64("a", "b")
    row = edges.agg(F.count(F.lit(1)).alias("n"), F.bit_xor(h).alias("x"),
                    F.sum(F.shiftright(h, 20)).alias("s")).first()
    return tuple(row)


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
    return (split_join(both.where("b > a"), least, "a")
            .select(F.col("b").alias("a"), F.col("m").alias("b")).distinct())


def _small_star(edges: DataFrame) -> DataFrame:
    least = edges.groupBy("a").agg(F.min("b").alias("m"))
    moved = (split_join(edges, least, "a").where("b <> m")
             .select(F.col("b").alias("a"), F.col("m").alias("b")))
    return moved.unionByName(least.select("a", F.col("m").alias("b"))).distinct()
