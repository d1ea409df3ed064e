"""Connected components of a link table, without collecting links anywhere.

Rounds of large-star and small-star: every node's links are re-hung on the
smallest node it knows, until nothing changes. Each step is one grouping with
map-side minima and one join; hot nodes are split by the skew handling of joins.
Every round is written to the shared folder, so lineage stays short.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pulsegrid.llm.frames import written

ROUNDS = 60


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, component): the smallest node reachable; nodes without a link to another are absent."""
    pairs = written(_oriented(links.select(F.col(a).alias("u"), F.col(b).alias("v"))), "component-links")
    before = None
    for _ in range(ROUNDS):
        pairs = written(_small_star(_large_star(pairs)), "component-links")
        now = pairs.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if before == tuple(now):
            break
        before = tuple(now)
    else:
        raise RuntimeError("components did not settle")
    # stars: every link is (node, its root)
    roots = pairs.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return pairs.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(roots)


def _oriented(pairs: DataFrame) -> DataFrame:
    """Each link once, larger node first."""
    return (
        pairs.filter("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()
    )


def _large_star(pairs: DataFrame) -> DataFrame:
    """Hang every larger neighbour of a node on the smallest node it knows (itself included)."""
    both = pairs.unionByName(pairs.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select(
        F.col("u").alias("w"), F.least("u", "m").alias("m")
    )
    return _oriented(
        both.filter("v > u").join(least, F.col("u") == F.col("w")).select(F.col("v").alias("u"), F.col("m").alias("v"))
    )


def _small_star(pairs: DataFrame) -> DataFrame:
    """Hang every smaller neighbour of a node, and the node, on the smallest of them."""
    least = pairs.groupBy("u").agg(F.min("v").alias("m")).select(F.col("u").alias("w"), "m")
    joined = pairs.join(least, F.col("u") == F.col("w"))
    return _oriented(
        joined.select(F.col("v").alias("u"), F.col("m").alias("v"))
        .unionByName(least.select(F.col("w").alias("u"), F.col("m").alias("v")))
    )
