"""Connected components of a link table, by alternating large-star and small-star rounds."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from driftloom.llm.common import Steps


def _large(links: DataFrame, steps: Steps) -> DataFrame:
    """Every node's larger neighbours are linked to its smallest neighbour (itself counts).

    Minima are stored before they are joined: only a join of two plain tables is split where a node has very many links.
    """
    both = links.union(links.select("v", "u"))
    least = steps.keep(both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m")))
    out = steps.keep(both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct())
    steps.drop(least)
    return out


def _small(links: DataFrame, steps: Steps) -> DataFrame:
    """Every node and its smaller neighbours are linked to the smallest of them."""
    down = links.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).where("u > v")
    least = steps.keep(down.groupBy("u").agg(F.min("v").alias("m")))
    moved = down.join(least, "u").where("v > m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    out = steps.keep(moved.union(least.select("u", F.col("m").alias("v"))).distinct())
    steps.drop(least)
    return out


def _stars(links: DataFrame) -> bool:
    """Whether every node has one smaller neighbour and no larger one, or only larger ones."""
    ends = links.where("u < v").limit(1).count()
    sides = links.select(F.col("u").alias("node"), F.lit(1).alias("down"), F.lit(0).alias("up")).union(
        links.select("v", F.lit(0), F.lit(1))
    )
    nodes = sides.groupBy("node").agg(F.sum("down").alias("down"), F.max("up").alias("up"))
    return not ends and nodes.where("down > 1 or down = 1 and up = 1").agg(F.count(F.lit(1))).first()[0] == 0


def components(links: DataFrame, steps: Steps) -> DataFrame:
    """(node, component) of every node with a link, where component is the smallest node reachable.

    links: columns u, v of one orderable type; direction, repeats and self-links don't matter. Links with a null end
    are left out. Minima are taken before the shuffle, so a node with very many links is one row per task; the joins
    on such a node are ordinary sort-merge joins that adaptive execution splits. Each round is written to the durable
    folder and the round before is removed. No table is collected.
    """
    now = steps.keep(links.where("u is not null and v is not null and u <> v").distinct())
    while not _stars(now):
        large = _large(now, steps)
        after = _small(large, steps)
        steps.drop(now, large)
        now = after
    roots = now.select(F.col("v").alias("node")).distinct()
    return now.select(F.col("u").alias("node"), F.col("v").alias("component")).union(
        roots.select("node", F.col("node").alias("component"))
    )
