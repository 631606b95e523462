"""Exact dedup: fuse-filter screening, exact buckets, byte checks.

A snapshot is immutable: its digests (SHA-256 of the text with each run of
ASCII white space as one space) are written once, with one binary fuse filter
per hash bucket of digests.  An incoming batch is first grouped by its own
digests, so its duplicates meet each other, map-side combined, without the
snapshot.  Its distinct digests are screened by the filter of their bucket;
the positives alone join the snapshot's exact digests.  Rows whose digest
is not alone are read again and their texts compared byte by byte with that of
the row that stays; where a digest covers two texts, its rows are grouped by
the texts themselves.

``exact_dedup`` of one table takes the rows with the smaller half of the id
range as the snapshot and the others as the batch.  A digest that holds a
third of all rows is one row on the small side of each join; the text
comparison deals its rows out by salt.

Defined results: null text counts as empty and equals empty and differs from
a single space (which white space alone becomes); of equal texts the row of
the smallest id stays, null ids last; of rows that repeat whole one stays; the
empty table gives no rows.  Extra columns are not read.
"""

from __future__ import annotations

from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm import fuse
from tidemark.llm.arrow import with_code
from tidemark.operators.joins import checked_broadcast
from tidemark.session import scratch_path

#: Distinct digests a bucket holds on average.
BUCKET = 100_000
#: Rows of one digest whose texts one task compares.
SALT = 1024
#: Digests that are sent to all executors; more are joined by a shuffle.
BROADCAST_ROWS = 50_000


def one_spaced(text: Column) -> Column:
    return F.regexp_replace(F.coalesce(text, F.lit("")), r"[\x20\x09-\x0D]+", " ")


def _stored(df: DataFrame, name: str) -> DataFrame:
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _keys(digests: list[str]) -> np.ndarray:
    """64 bits of each hex digest; short ones are filled up."""
    return np.array([int(d[:16].ljust(16, "0"), 16) for d in digests], dtype=np.uint64)


def _grouped(rows: DataFrame) -> DataFrame:
    """One row per digest: the row that stays and how many there are."""
    return rows.groupBy("digest").agg(F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "row")).alias("keep"),
                                      F.count(F.lit(1)).alias("n"))


FILTER = "bucket long, seed decimal(20,0), segment long, starts long, cells binary"


def build_filters(digests: DataFrame) -> DataFrame:
    """One filter per bucket of (bucket, digest)."""
    def one(rows: pa.Table) -> pa.Table:
        made = fuse.build(_keys(rows.column("digest").to_pylist()))
        return pa.table({"bucket": rows.column("bucket").slice(0, 1), "seed": pa.array([Decimal(made.seed)], pa.decimal128(20, 0)),
                         "segment": pa.array([made.segment], pa.int64()), "starts": pa.array([made.starts], pa.int64()),
                         "cells": pa.array([made.cells.tobytes()], pa.binary())})

    return digests.select("bucket", "digest").groupBy("bucket").applyInArrow(one, FILTER)


def screen(incoming: DataFrame, filters: DataFrame) -> DataFrame:
    """(digest, maybe) of distinct incoming (bucket, digest)."""
    def one(rows: pa.Table, made: pa.Table) -> pa.Table:
        digests = rows.column("digest").to_pylist()
        maybe = np.zeros(len(digests), bool)
        if digests and made.num_rows:
            f = made.slice(0, 1).to_pylist()[0]
            known = fuse.Fuse(int(f["seed"]), f["segment"], f["starts"], np.frombuffer(f["cells"], np.uint8))
            maybe = known.has(_keys(digests))
        return pa.table({"digest": pa.array(digests, pa.string()), "maybe": pa.array(maybe, pa.bool_())})

    return (incoming.select("bucket", "digest").groupBy("bucket").cogroup(filters.groupBy("bucket"))
                    .applyInArrow(one, "digest string, maybe boolean"))


def digest_groups(snapshot: DataFrame, incoming: DataFrame) -> DataFrame:
    """(digest, keep, n) over the rows (doc_id, row, digest) of both."""
    known, fresh = _stored(_grouped(snapshot), "dedup-snapshot"), _stored(_grouped(incoming), "dedup-batch")
    buckets = 1 + max(known.count(), fresh.count()) // BUCKET
    placed = lambda df: df.withColumn("bucket", F.pmod(F.xxhash64("digest"), F.lit(buckets)))
    filters = _stored(build_filters(placed(known)), "dedup-filters")
    verdict = _stored(screen(placed(fresh), filters), "dedup-screened")
    fresh = fresh.join(verdict, "digest")
    positive = fresh.where("maybe").select("digest", F.col("keep").alias("k2"), F.col("n").alias("n2"))
    met = known.join(positive, "digest", "left").select(
        "digest", F.least("keep", F.coalesce("k2", "keep")).alias("keep"), (F.col("n") + F.coalesce("n2", F.lit(0))).alias("n"))
    unmet = positive.join(known.select("digest"), "digest", "left_anti").select(
        "digest", F.col("k2").alias("keep"), F.col("n2").alias("n"))
    return _stored(met.unionByName(unmet).unionByName(fresh.where("NOT maybe").select("digest", "keep", "n")),
                   "dedup-groups")


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", digest_hex: int = 64) -> DataFrame:
    """One row per document: doc_id, keep_id, group_size, kept, text_sha256.
    ``digest_hex`` shortens the digest that groups (the byte checks make up
    for it)."""
    with_code(docs.sparkSession)
    texts = docs.select(F.col(id_col).alias("doc_id"), one_spaced(F.col(text_col)).alias("t"))
    texts = texts.withColumn("text_sha256", F.sha2("t", 256))
    rows = _stored(texts.select("doc_id", "text_sha256", F.substring("text_sha256", 1, digest_hex).alias("digest"),
                                F.monotonically_increasing_id().alias("row")), "dedup-rows")
    ends = rows.agg(F.min("doc_id").alias("a"), F.max("doc_id").alias("b")).first()
    old = F.coalesce(F.col("doc_id") <= F.lit(((ends.a or 0) + (ends.b or 0)) // 2), F.lit(False))
    groups = digest_groups(rows.where(old), rows.where(~old))
    several = groups.where("n > 1")
    # The texts of rows that are not alone against the text of the row that stays.
    narrow = several.select("digest", F.col("keep.doc_id").alias("keep_id"),
                            F.ceil(F.col("n") / F.lit(SALT)).alias("salts"))
    suspects = (texts.withColumn("digest", F.substring("text_sha256", 1, digest_hex))
                     .join(checked_broadcast(narrow, BROADCAST_ROWS), "digest"))
    salted = suspects.withColumn("salt", F.pmod(F.xxhash64("doc_id"), "salts"))
    stays = (suspects.where(F.col("doc_id").eqNullSafe(F.col("keep_id"))).groupBy("digest")
                     .agg(F.min("t").alias("kept_text"), F.first("salts").alias("s"))
                     .withColumn("salt", F.explode(F.sequence(F.lit(0).cast("long"), F.col("s") - 1))).drop("s"))
    unlike = _stored(salted.join(stays, ["digest", "salt"]).where(F.col("t") != F.col("kept_text"))
                           .select("digest").distinct(), "dedup-unlike")
    alike = several.join(unlike, "digest", "left_anti").select("digest", "keep", "n")
    single = rows.join(unlike, "digest", "left_anti") if not unlike.isEmpty() else rows
    plain = single.join(alike, "digest", "left").select(
        "doc_id", F.when(F.col("n").isNull(), F.col("doc_id")).otherwise(F.col("keep.doc_id")).alias("keep_id"),
        F.coalesce("n", F.lit(1)).cast("long").alias("group_size"),
        F.coalesce(F.col("keep.row") == F.col("row"), F.lit(True)).alias("kept"), "text_sha256")
    if unlike.isEmpty():
        return plain
    split = _stored(texts.withColumn("digest", F.substring("text_sha256", 1, digest_hex)).join(unlike, "digest")
                         .withColumn("row", F.monotonically_increasing_id()), "dedup-split")
    exact = _grouped(split.select("doc_id", "row", F.struct("digest", "t").alias("digest")))
    again = split.join(exact.select(F.col("digest.digest").alias("digest"), F.col("digest.t").alias("t"), "keep", "n"),
                       ["digest", "t"])
    return plain.unionByName(again.select(
        "doc_id", F.col("keep.doc_id").alias("keep_id"), F.col("n").alias("group_size"),
        (F.col("keep.row") == F.col("row")).alias("kept"), "text_sha256"))


def op5_exact_dedup(spark, sf_dir: str) -> DataFrame:
    """Every document with the equal one that stays."""
    return exact_dedup(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text"))


OP5_SQL = r"""
WITH d AS (
  SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS t FROM documents)
SELECT doc_id, min(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size,
       row_number() OVER (PARTITION BY t ORDER BY doc_id NULLS LAST) = 1 AS kept, sha256(t) AS text_sha256
FROM d WINDOW w AS (PARTITION BY t)
"""
