"""BPE by prefix table against the tokenizers library."""

import random

import pytest
from tokenizers import Tokenizer

import public_tokenizers
from tidemark.llm import bpe
from tests.conftest import SF_SMALL

PATH = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


@pytest.fixture(scope="module")
def vocab():
    with open(PATH, encoding="utf-8") as f:
        return bpe.Vocabulary(f.read())


def test_random_texts(library, vocab):
    rng = random.Random(3)
    letters = "aaabcdeeetttths   \n\t\r'stre!!0129ßéñ漢字　\x1c\x85\xa0.,-_ŝ🙂²"
    for i in range(4000):
        text = "".join(rng.choice(letters) for _ in range(rng.randint(0, 60)))
        if i % 10 == 0:
            text += "<|endoftext|>" + text
        assert list(vocab.encode(text)) == library.encode(text, add_special_tokens=False).ids


def test_long_runs(library, vocab):
    for text in ("a" * 6000, "ab" * 3000, " " * 3000, "\n" * 999 + "x", "", " "):
        assert list(vocab.encode(text)) == library.encode(text, add_special_tokens=False).ids


def test_every_token_of_the_vocabulary_is_reachable_or_left_out(library, vocab):
    for i in range(0, 50256, 97):
        text = vocab.raw[i].decode("utf-8", "ignore")
        if text.encode() == vocab.raw[i]:
            assert list(vocab.encode(text)) == library.encode(text, add_special_tokens=False).ids


def test_frames_nulls_repeats_and_clashing_columns(spark, library):
    rows = [(1, None, "x"), (2, "", "y"), (3, "word " * 30000, None), (3, "word " * 30000, None), (4, "é\n é", "z")]
    df = spark.createDataFrame(rows, "doc_id long, text string, decoded_note string")
    out = bpe.bpe_decode(bpe.bpe_encode(df, "text", PATH), "ids", PATH).collect()
    assert len(out) == 5
    for r in out:
        assert r.ids == library.encode(r.text or "", add_special_tokens=False).ids
        assert r.decoded == (r.text or "")
    with pytest.raises(ValueError):
        bpe.bpe_encode(df.withColumnRenamed("decoded_note", "ids"), "text", PATH)
    assert bpe.bpe_encode(df.limit(0), "text", PATH).count() == 0


def test_decode_of_odd_ids(spark):
    df = spark.createDataFrame([(1, [50256, -4, 99999]), (2, None), (3, [127])], "k long, ids array<int>")
    got = {r.k: r.decoded for r in bpe.bpe_decode(df, "ids", PATH).collect()}
    assert got[1] == "<|endoftext|>" and got[2] == "" and got[3] == "�"


def test_query_matches_library(spark, library):
    import hashlib

    docs = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect()}
    out = bpe.op9_bpe(spark, SF_SMALL).collect()
    assert len(out) == len(docs)
    for r in out:
        ids = library.encode(docs[r.doc_id], add_special_tokens=False).ids
        assert r.n_tokens == len(ids)
        assert r.ids_sha256 == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        text = library.decode(ids, skip_special_tokens=False)
        assert r.decoded_sha256 == hashlib.sha256(text.encode()).hexdigest()
