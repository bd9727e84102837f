"""Connected components of an edge table by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from pactlens.llm.common import kept_table


def _stars(edges: DataFrame) -> DataFrame:
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    low = both.groupBy("a").agg(F.min("b").alias("low"))
    large = (
        both.join(low, "a")
        .where("b > a")
        .select(F.col("b").alias("a"), F.least("a", "low").alias("b"))
    )
    low = large.groupBy("a").agg(F.min("b").alias("low"))
    joined = large.join(low, "a")
    small = joined.where("b > low").select(F.col("b").alias("a"), F.col("low").alias("b"))
    return small.unionByName(low.select("a", F.col("low").alias("b"))).distinct()


def _kept(edges: DataFrame, name: str) -> tuple[DataFrame, tuple]:
    """The written edges, with their number and a checksum that are counted while writing."""
    seen = Observation()
    rows = F.count(F.lit(1)).alias("rows")
    mixed = F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("mixed")
    table = kept_table(edges.observe(seen, rows, mixed), name)
    return table, (seen.get.get("rows"), seen.get.get("mixed"))


def components(edges: DataFrame) -> DataFrame:
    """(node, component) for every node of ``edges`` (a, b); the component is its smallest node.

    The edge table shrinks towards one edge per node. Every round is written, and only a row count
    and a checksum come to the driver.
    """
    now, state = _kept(
        edges.where("a <> b")
        .select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        .distinct(),
        "edges",
    )
    while True:
        was = state
        now, state = _kept(_stars(now), "stars")
        if was == state:
            break
    ends = now.select(F.col("a").alias("node"), F.col("b").alias("component"))
    tops = now.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    return ends.unionByName(tops)
