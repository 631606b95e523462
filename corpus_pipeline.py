"""The corpus pipeline: quality filter, exact dedup, near dedup, mixing, BPE.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame that is
written as Parquet and read again as the next stage's documents.  All stages
but the last return the columns of ``documents``; the last encodes every
document that the mix takes, a row for each copy, decodes the token ids again
in the same pass and fails if the decoded text is not the document's.  ``run``
returns its rows, decoded texts included.

Defined results: texts that are null count as empty; rows that repeat are
documents of their own until exact dedup; empty tables pass; extra columns of
the documents pass through to the last stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import bpe, exact_dedup, mixing, ngram_join, quality, retain
from tidemark.session import apply_engine_conf, scratch_path


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier rejects go."""
    model = quality.fit_quality(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    scored = quality.quality_scores(docs, model, out="__score")
    return scored.where(F.col("__score") >= quality.THRESHOLD).drop("__score")


def exact_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents with equal texts, the one of the smallest id stays."""
    return retain.retain(docs, exact_dedup.exact_dedup(docs), F.sha2(exact_dedup.one_spaced(F.col("text")), 256))


def near_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near-duplicates, the document of the smallest id stays."""
    return retain.retain(docs, ngram_join.ngram_join(docs), F.sha2(F.coalesce("text", F.lit("")), 256))


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them."""
    return mixing.mix(docs, carry=True)


def bpe_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every document and the text decoded from them: doc_id,
    lang, source, n_tokens, ids, decoded."""
    both = bpe.bpe_round_trip(docs.select("doc_id", "lang", "source", "text"), "text", _vocabulary())
    return both.select("doc_id", "lang", "source", F.size("ids").cast("long").alias("n_tokens"), "ids", "decoded")


def _vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


STAGES = [
    ("quality classifier", quality_stage),
    ("exact dedup", exact_dedup_stage),
    ("n-gram Jaccard join", near_dedup_stage),
    ("mixing to target weights", mixing_stage),
    ("BPE encoding and decoding", bpe_stage),
]

#: SQL can express neither the classifier nor BPE.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written and read again."""
    apply_engine_conf(spark)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        path = scratch_path(spark, name.replace(" ", "-"))
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
