"""Connected components of an edge table, by alternating star contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from isallobar.llm.common import discard, settle

#: Rounds double the reach of the least node, so this is far beyond any real graph.
MOST_ROUNDS = 60


def _large_star(edges: DataFrame) -> DataFrame:
    """Every node hands its larger neighbours to its least neighbour."""
    both = edges.select(F.col("a").alias("u"), F.col("b").alias("v")).unionByName(edges.select(F.col("b").alias("u"), F.col("a").alias("v")))
    least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
    return both.where("v > u").join(least, "u").select(F.col("m").alias("a"), F.col("v").alias("b")).where("a <> b")


def _small_star(edges: DataFrame) -> DataFrame:
    """Every node hands itself and its smaller neighbours to the least of them."""
    down = edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
    least = down.groupBy("u").agg(F.min("v").alias("m"))
    moved = down.join(least, "u").select(F.col("m").alias("a"), F.col("v").alias("b")).where("a <> b")
    return moved.unionByName(least.select(F.col("m").alias("a"), F.col("u").alias("b")))


def components(edges: DataFrame) -> DataFrame:
    """Least node reachable from every node that has an edge.

    ``edges`` has comparable columns ``a`` and ``b``; direction, repeats and loops do
    not matter.  Returns ``node`` and ``component``.  Each round is settled in the
    shared folder, and only its count and checksum come to the driver.
    """
    now = settle(edges.where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "edges")
    seen = None
    for _ in range(MOST_ROUNDS):
        after = settle(_small_star(_large_star(now)).distinct(), "edges")
        discard(now)
        now = after
        state = now.agg(F.count("*"), F.sum(F.xxhash64("a", "b") % 1_000_003), F.bit_xor(F.xxhash64("b", "a"))).first()
        if state == seen:
            break
        seen = state
    else:
        raise RuntimeError("star contraction did not settle")
    # Every edge now joins the least node of its component with another node.
    return now.select(F.col("b").alias("node"), F.col("a").alias("component")).unionByName(now.select(F.col("a").alias("node"), F.col("a").alias("component")).distinct())
