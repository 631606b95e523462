"""The pipeline, stage by stage, against brute force."""

import os
import re

from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline as C
import public_tokenizers
from tests.conftest import SF_SMALL
from tests.llm import test_exact_dedup, test_mixing, test_ngram_join
from tidemark.llm import quality

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_run(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    model = quality.fit_quality(docs, spark.read.parquet(f"{SF_SMALL}/labels.parquet"))
    rows = [tuple(r) for r in docs.collect()]
    import pyarrow as pa

    good = [r for r, s in zip(rows, model.score(pa.array([r[1] for r in rows], pa.string()))) if s >= 0.7]
    keep = {i for i, k, *_ in test_exact_dedup.by_hand([r[:2] for r in good]) if i == k}
    unique = [r for r in good if r[0] in keep]
    near = {i for i, c, _ in test_ngram_join.by_hand([r[:2] for r in unique]) if i == c}
    single = [r for r in unique if r[0] in near]
    stage = spark.createDataFrame(rows, docs.schema)
    for (_, fn), want in zip(C.STAGES, (good, unique, single)):
        stage = spark.createDataFrame(fn(spark, stage, SF_SMALL).collect(), docs.schema)
        assert rows_of(stage) == sorted(want, key=repr)
        assert stage.columns == docs.columns
    mixed = C.mixing_stage(spark, stage, SF_SMALL).collect()
    copies = {}
    for r in mixed:
        copies[r.doc_id] = copies.get(r.doc_id, 0) + 1
    assert {tuple(r) for r in mixed} <= set(single) and max(copies.values()) <= 2
    want = test_mixing.by_hand([(r[0], r[1], r[3]) for r in single])
    size = lambda t: len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))
    for source, (_, target) in want.items():
        own = [r for r in single if r[3] == source]
        assert abs(sum(size(r[1]) * copies.get(r[0], 0) for r in own) - target) <= max(size(r[1]) for r in own) / 2 + 1e-6
    library = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    out = C.run(spark, SF_SMALL).collect()
    text = {r[0]: r[1] for r in single}
    assert sorted(r.doc_id for r in out) == sorted(r.doc_id for r in mixed)
    assert all(r.ids == library.encode(text[r.doc_id], add_special_tokens=False).ids and r.n_tokens == len(r.ids) for r in out)


def test_odd_rows(spark, scratch):
    good = "the of and to in " * 8
    rows = [(1, good + "one two", "en", "a", 1), (1, good + "one two", "en", "a", 1), (1, good + "x" * 5, "en", None, 1),
            (2, good + "one  two", "en", "a", 1), (None, good + "null id", None, "b", None), (None, good + "null id", None, "b", None),
            (3, None, None, None, None), (4, "", None, None, None), (5, good * 3000, "en", "b", 2)]
    docs = spark.createDataFrame(rows, SCHEMA).withColumn("row", F.lit(7))
    spark.createDataFrame([(1, 1, 0), (5, 1, 0), (77, 0, 0)], "doc_id long, quality int, toxic int").write.parquet(
        os.path.join(scratch, "labels.parquet"))
    for k, (_, fn) in enumerate(C.STAGES):
        docs = fn(spark, docs, scratch)
        if k == 1:
            assert sorted((r.doc_id for r in docs.collect()), key=repr) == [1, 1, 3, 5, None]
        if k < 4:
            assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars", "row"]
            docs = spark.createDataFrame(docs.collect(), docs.schema)
    assert docs.columns == ["doc_id", "lang", "source", "n_tokens", "ids", "decoded"] and docs.count() > 0
    none = spark.createDataFrame([], SCHEMA)
    for _, fn in C.STAGES:
        assert fn(spark, none, scratch).count() == 0
