"""Connected components of a table of links, by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import kept, release


def components(links: DataFrame, label: str = "components") -> DataFrame:
    """``node, root`` for every node of ``links`` (a, b: long, not null); the root is the smallest node reachable.

    Self-links and repeated links do no harm; no links give no rows. Every round is written to the shared folder, and
    only two flags of it reach the driver.
    """
    held = kept(links.selectExpr("greatest(a, b) AS a", "least(a, b) AS b").where("a <> b").distinct(), label)
    while not _are_stars(held):
        release(held.sparkSession)
        # Large star: every larger neighbour moves to the smallest neighbour.
        both = held.unionAll(held.selectExpr("b AS a", "a AS b"))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = (both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
                 .where("a <> b"))
        # Small star: smaller neighbours, and the node itself, move to the smallest of them.
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).unionAll(
            least.select("a", F.col("m").alias("b")))
        held = kept(small.where("a <> b").distinct(), label)
    return held.selectExpr("a AS node", "b AS root").unionAll(held.select("b", "b").distinct().toDF("node", "root"))


def _are_stars(links: DataFrame) -> bool:
    """Whether every node is either a root or linked to one root only."""
    ends = links.selectExpr("a AS node", "1 AS up", "0 AS down").unionAll(links.selectExpr("b", "0", "1"))
    nodes = ends.groupBy("node").agg(F.sum("up").alias("up"), F.max("down").alias("down"))
    return nodes.where("up > 1 OR up = 1 AND down = 1").isEmpty()
