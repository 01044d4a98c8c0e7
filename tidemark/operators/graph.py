"""Iterative ranks on a graph."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.operators.aggregates import distinct_rows
from tidemark.operators.joins import inner_equi
from tidemark.session import scratch_path, shared_dir

# The two weights of a round.
BASE = 0.15
DAMPING = 0.85

HUB_EDGES = 1_000_000


def _bucketed(df: DataFrame, key: str, buckets: int, path: str) -> tuple[str, DataFrame]:
    """The rows as a table of one sorted file for each bucket of ``key``, and its name."""
    name = f"tidemark_{uuid.uuid4().hex}"
    (df.repartition(buckets, key).write.bucketBy(buckets, key).sortBy(key).option("path", path).saveAsTable(name))
    return name, df.sparkSession.table(name)


def pagerank(edges: DataFrame, rounds: int = 10, checkpoint_every: int = 3, hub_edges: int = HUB_EDGES,
             buckets: int | None = None, repeats: bool = True) -> DataFrame:
    """Ranks (node, rank) after some rounds, not normalised.

    A node passes ``rank / out-degree`` along each distinct edge; only nodes that got a share keep a rank. Edges and
    degrees lie in tables bucketed by their source in the shared folder, and the sums of a round come out in the same
    layout, so a round moves its shares once and no edge. Edges of nodes with more than ``hub_edges`` lie apart,
    unbucketed, and meet the few ranks of their sources. Every ``checkpoint_every`` rounds the ranks are written down, so
    a lost executor costs no more than the rounds since. ``repeats=False`` says that no edge comes twice.
    """
    spark = edges.sparkSession
    shared_dir(spark)
    buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
    path = scratch_path(spark, "ranks")
    edges = edges.select("src", "dst")
    (distinct_rows(edges) if repeats else edges).write.parquet(f"{path}/unique")
    unique = spark.read.parquet(f"{path}/unique")
    degree_table, degrees = _bucketed(unique.groupBy("src").agg(F.count(F.lit(1)).alias("degree")), "src", buckets, f"{path}/degrees")
    hubs = degrees.where(F.col("degree") > hub_edges).select("src")  # no more than edges / hub_edges rows
    any_hubs = not hubs.isEmpty()
    light = unique.join(hubs, "src", "left_anti") if any_hubs else unique
    link_table, links = _bucketed(light, "src", buckets, f"{path}/links")
    if any_hubs:
        inner_equi(unique, hubs, "src").write.parquet(f"{path}/hub-links")
        hub_links = spark.read.parquet(f"{path}/hub-links")
    ranks = degrees.select(F.col("src").alias("node"), F.lit(1.0).alias("rank"))
    for done in range(1, rounds + 1):
        shares = ranks.join(degrees, F.col("node") == F.col("src")).select("src", (F.col("rank") / F.col("degree")).alias("share"))
        passed = inner_equi(links, shares, "src").select("dst", "share")
        if any_hubs:
            passed = passed.unionByName(inner_equi(hub_links, inner_equi(shares, hubs, "src"), "src").select("dst", "share"))
        ranks = passed.groupBy(F.col("dst").alias("node")).agg(
            (F.lit(BASE) + F.lit(DAMPING) * F.sum("share")).alias("rank"))
        if done % checkpoint_every == 0 or done == rounds:
            ranks = ranks.checkpoint()
    for name in (degree_table, link_table) if rounds else ():
        spark.sql(f"DROP TABLE {name}")
    return ranks
