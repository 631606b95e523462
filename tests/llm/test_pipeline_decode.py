"""The pipeline's last stage decodes what it encoded."""

import pytest
from tokenizers import Tokenizer

import corpus_pipeline as C
import public_tokenizers
from tests.conftest import SF_SMALL
from tidemark.llm import bpe

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def test_run_returns_decoded_texts(spark):
    library = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    text = {r.doc_id: r.text for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect()}
    out = C.run(spark, SF_SMALL).collect()
    assert out
    for r in out:
        assert r.decoded == library.decode(r.ids, skip_special_tokens=False) == (text[r.doc_id] or "")


def test_stage_compares_the_round_trip(spark):
    rows = [(1, "one two <|endoftext|> é中 �\n", "en", "a", 1), (2, None, None, None, None), (None, "", None, None, None)]
    docs = spark.createDataFrame(rows, SCHEMA)
    got = C.bpe_stage(spark, docs, SF_SMALL)
    assert got.columns == ["doc_id", "lang", "source", "n_tokens", "ids", "decoded"]
    assert [r.decoded for r in got.collect()] == [t or "" for _, t, *_ in rows]
    assert got.limit(0).count() == 0
    with open(public_tokenizers.path("byte_bpe_50k.json"), encoding="utf-8") as f:
        whole = f.read()
    vocab, pieces = bpe._vocabulary(whole), bpe._token_bytes(whole)
    ids, back = bpe.round_trip(vocab, pieces, "one two")
    assert back == "one two" and len(ids)
    with pytest.raises(ValueError, match="another text"):
        bpe.round_trip(vocab, pieces.take(bpe.pa.array([5] * len(pieces))), "one two")
