"""Connected components of a table of links, by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textmill.llm._stage import Stage


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """Links every node's neighbours to the least of them. edges: (u, v), u > v. The minimum is pre-aggregated
    by task; a node with very many neighbours is a skewed join key, which adaptive execution splits."""
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v"))) if large else edges
    least = both.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("u", "m"))
    joined = both.join(least, "u")
    if large:
        out = joined.where(F.col("v") > F.col("u")).select(F.col("v").alias("u"), F.col("m").alias("v"))
    else:
        out = joined.select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(least.select("u", F.col("m").alias("v")))
    return out.where(F.col("u") > F.col("v")).distinct()


def components(links: DataFrame, stage: Stage) -> DataFrame:
    """(node, class_id) for every node of the links (a, b); class_id is the least node of the component."""
    edges = links.where(F.col("a") != F.col("b")).select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct()
    edges, mark, step = stage.save(edges, "edges0"), None, 0
    while True:
        now = edges.agg(F.count(F.lit(1)), F.coalesce(F.sum(F.pmod(F.xxhash64("u", "v"), F.lit(1 << 40))), F.lit(0))).first()
        if now == mark:
            break
        mark, step = now, step + 1
        edges = stage.save(_star(_star(edges, True), False), f"edges{step}")
        stage.drop(f"edges{step - 1}")
    return edges.select(F.col("u").alias("node"), F.col("v").alias("class_id")).unionByName(
        edges.select(F.col("v").alias("node"), F.col("v").alias("class_id")).distinct()
    )
