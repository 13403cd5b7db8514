"""Connected components of a table of links, by rounds of alternating large and small stars.

Each round connects neighbours to the smallest node around them.  A node's smallest neighbour is
found in two steps, first for each of ``SALTS`` parts of its links and then for the node, and is
joined back by node and part; so a node with very many links is dealt over as many tasks.  A
round's links are written to the shared folder, which cuts lineage.  Every table of links, small
or large, takes this path.

Rows: links with a null end or of a node to itself are not used; repeated links count once.  Of an
empty table the result is empty.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import store

#: Parts that a node's links are dealt over.
SALTS = 64


def _with_least(links: DataFrame, node: str, other: str) -> DataFrame:
    """``links`` with ``m``, the smallest of all ``other`` that ``node`` is linked with."""
    salted = links.withColumn("salt", F.pmod(F.xxhash64(other), F.lit(SALTS)).cast("int"))
    parts = salted.groupBy(node, "salt").agg(F.min(other).alias("low"))
    least = parts.groupBy(node).agg(F.min("low").alias("m"))
    return salted.join(parts.select(node, "salt").join(least, node), [node, "salt"]).drop("salt")


def _large_star(links: DataFrame) -> DataFrame:
    both = links.select("a", "b").union(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    found = _with_least(both, "a", "b").where("b > a")
    return found.select(F.least("m", "a").alias("a"), "b").distinct()


def _small_star(links: DataFrame) -> DataFrame:
    found = _with_least(links, "b", "a")
    over = found.where("m < a").select(F.col("m").alias("a"), F.col("a").alias("b"))
    return over.union(found.select(F.col("m").alias("a"), "b")).distinct()


def components(links: DataFrame, rounds: int = 60) -> DataFrame:
    """``links`` (a < b) to (node, component) of every linked node; a component is its smallest node."""
    links = store(links.where("a < b").distinct(), "links")
    for _ in range(rounds):
        # Settled: every node is either a centre or hangs on one centre.
        ends = links.select(F.col("a").alias("node"), F.lit(0).alias("hangs")).union(links.select("b", F.lit(1)))
        seen = ends.groupBy("node").agg(F.min("hangs").alias("low"), F.sum("hangs").alias("n"))
        if seen.where("n > 1 OR low = 0 AND n > 0").isEmpty():
            break
        links = store(_small_star(_large_star(links)), "links")
    else:
        raise RuntimeError("components did not settle")
    nodes = links.select(F.col("b").alias("node"), F.col("a").alias("component"))
    return nodes.union(links.select(F.col("a").alias("node"), F.col("a").alias("component")).distinct())
