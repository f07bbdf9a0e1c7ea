"""Connected components of a graph of links, by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .words import written


def _least(edges: DataFrame) -> DataFrame:
    """The smallest neighbour of each node; combined before the shuffle, so a node with most of the links is no burden."""
    return edges.groupBy("u").agg(F.min("v").alias("m")).withColumnRenamed("u", "node")


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.unionAll(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = _least(both).withColumn("m", F.least("m", "node"))
    up = both.where("v > u").join(least, F.col("u") == F.col("node"))
    return up.select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = _least(down)
    moved = down.join(least, F.col("u") == F.col("node")).where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.unionAll(least.select(F.col("node").alias("u"), F.col("m").alias("v"))).distinct()


def components(edges: DataFrame, u: str, v: str) -> DataFrame:
    """node, root: for each node with a link the smallest node it reaches. Each round is written to the shared folder; the
    driver sees counts alone."""
    links = edges.select(F.col(u).alias("u"), F.col(v).alias("v")).where("u <> v").distinct()
    state = None
    while True:
        links = written(_small_star(_large_star(links)), "links")
        now = links.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == state:
            break
        state = now
    roots = links.select(F.col("v").alias("node")).distinct().select("node", F.col("node").alias("root"))
    return links.select(F.col("u").alias("node"), F.col("v").alias("root")).unionAll(roots)
