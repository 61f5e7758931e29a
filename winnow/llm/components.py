"""Connected components of an edge table by alternating star contraction.

Every step is a partial aggregate (the smallest neighbour) and an equi-join of
two written tables, so a hub node is split by adaptive execution instead of
landing in one task.  Both star operations keep connectivity and only ever
point a node at a smaller one; the loop ends when the edge set is a fixed
point, which is then a star around the smallest node of each component.
"""

from __future__ import annotations

import logging

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from winnow.llm.common import materialize

log = logging.getLogger(__name__)


def _signature(edges: DataFrame) -> tuple:
    r = edges.agg(F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("h")).first()
    return r["n"], r["h"]


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    low = materialize(both.groupBy("a").agg(F.min("b").alias("m")), "star-min")
    out = (both.join(low, "a").where(F.col("b") > F.col("a"))
           .select(F.col("b").alias("a"), F.least("a", "m").alias("b")))
    return materialize(out.distinct(), "large-star")


def _small_star(edges: DataFrame) -> DataFrame:
    low = materialize(edges.groupBy("a").agg(F.min("b").alias("m")), "star-min")
    moved = (edges.join(low, "a").where(F.col("b") != F.col("m"))
             .select(F.col("b").alias("a"), F.col("m").alias("b")))
    return materialize(moved.unionByName(low.select("a", F.col("m").alias("b"))).distinct(), "small-star")


def connected(edges: DataFrame) -> DataFrame:
    """(node, component) for every node that is not the smallest of its
    component; ``edges`` has bigint columns a and b in any orientation.
    Self-edges and repeated edges have no effect; no edges give no rows."""
    cur = materialize(edges.where(F.col("a") != F.col("b"))
                      .select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges")
    seen, rounds = _signature(cur), 0
    while seen[0]:
        cur = _small_star(_large_star(cur))
        now, rounds = _signature(cur), rounds + 1
        if now == seen:
            break
        seen = now
    log.info("connected components: %d rounds, %d edges left", rounds, seen[0])
    return cur.select(F.col("a").alias("node"), F.col("b").alias("component"))
