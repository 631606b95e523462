"""Applies per-document decisions to the documents themselves."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.components import stored
from tidemark.operators.joins import checked_broadcast

#: Ids that are sent to all executors (a few MB); more are joined by a shuffle.
BROADCAST_ROWS = 1_000_000


def retain(docs: DataFrame, decisions: DataFrame, digest: Column) -> DataFrame:
    """The rows of ``docs`` whose decision (doc_id, text_sha256, kept) is to
    stay.  Ids that occur once are decided by id; ids that repeat, and null
    ids, by id and ``digest`` of the text, and of rows equal in both one
    stays."""
    made = stored(decisions.select("doc_id", "text_sha256", "kept"), "decisions")
    ids = made.groupBy("doc_id").agg(F.count(F.lit(1)).alias("n"), F.max("kept").alias("k"))
    odd = stored(ids.where("n > 1 OR doc_id IS NULL").select("doc_id"), "odd-ids")
    leave = ids.where("doc_id IS NOT NULL AND (n > 1 OR NOT k)").select("doc_id")
    once = docs.where("doc_id IS NOT NULL").join(checked_broadcast(stored(leave, "leave"), BROADCAST_ROWS), "doc_id",
                                                 "left_anti").select(*docs.columns)
    if odd.isEmpty():
        return once
    keys = made.where("kept").join(odd.select(F.col("doc_id").alias("o")), F.col("doc_id").eqNullSafe(F.col("o"))).select(
        F.col("doc_id").alias("__id"), F.col("text_sha256").alias("__d")).distinct()
    marked = docs.withColumn("__digest", digest)
    found = marked.join(keys, F.col("doc_id").eqNullSafe(F.col("__id")) & (F.col("__digest") == F.col("__d")), "left_semi")
    return once.unionByName(found.dropDuplicates(["doc_id", "__digest"]).drop("__digest"))
