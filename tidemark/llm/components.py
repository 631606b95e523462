"""Connected components by alternating large and small stars.

Both steps are a grouped minimum and a join on the vertex; the edges shrink
to one star per component around its smallest vertex.  Every round is written
to the shared folder, so a lost executor costs one round at most, and nothing
is gathered in one task or on the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.session import scratch_path


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to the shared folder and read again."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def connected_components(edges: DataFrame) -> DataFrame:
    """(node, root) of every vertex of ``edges`` (a, b); the root is the
    smallest vertex of the component.  Loops and repeats do not matter."""
    now = stored(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(),
                 "edges")
    seen = None
    while True:
        mark = now.agg(F.count(F.lit(1)).alias("n"),
                       F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("s")).first()
        if not mark.n or mark == seen:
            break
        seen = mark
        both = now.select(F.col("a").alias("u"), F.col("b").alias("v")).unionByName(
            now.select(F.col("b").alias("u"), F.col("a").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("u", "m"))
        large = both.join(low, "u").where("v > u").select(F.col("v").alias("a"), F.col("m").alias("b")).distinct()
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(least, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        now = stored(small.unionByName(least.select("a", F.col("m").alias("b"))).distinct(), "edges")
    return now.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(
        now.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())
