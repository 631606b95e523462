"""Packing against the tokenizers library and a plain best-fit."""

import random
import zlib
from itertools import product

import numpy as np
import pyarrow as pa
import pytest

from tests.conftest import SF_SMALL
from tidemark.llm import byte_tokens as T
from tidemark.llm import pattern_packing as P

public_tokenizers = pytest.importorskip("public_tokenizers")
PATH = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def library():
    from tokenizers import Tokenizer

    tok = Tokenizer.from_file(PATH)
    tok.no_truncation()
    tok.no_padding()
    return lambda t: tok.encode(t or "", add_special_tokens=False).ids


@pytest.fixture(scope="module")
def coder():
    with open(PATH, encoding="utf-8") as f:
        return T.Encoder(f.read())


def lists(coder, texts):
    bounds, ids = coder.encode(pa.array(texts, pa.string()))
    assert len(bounds) == len(texts) + 1 and bounds[-1] == len(ids)
    return [ids[a:b].tolist() for a, b in zip(bounds, bounds[1:])]


def test_ids_equal_the_library(coder, library, monkeypatch):
    rng = random.Random(3)
    marks = ["a", "B", "é", "1", "²", " ", "  ", "\n", "\n\n", "\t", "\r\n", "'", "'s", "'re", "'ll", "’", "t", ".", "!?",
             "<|endoftext|>", "\x85", "\xa0", "一", "Ω", "ж", "€", "\x1c", "\x00", "😀", "ſ", "it's", "donau", "x" * 40]
    texts = ["".join(rng.choice(marks) for _ in range(rng.randint(0, 14))) for _ in range(3000)] + [None, "", "a" * 5000]
    want = [library(t) for t in texts]
    assert lists(coder, texts) == want
    assert lists(coder, texts) == want  # now from memory
    assert lists(coder, texts[:1]) == want[:1] and lists(coder, []) == []
    bounds, ids = coder.encode(pa.array(texts, pa.string()).slice(7, 50))
    assert ids.tolist() == sum(want[7:57], [])
    monkeypatch.setattr(T, "LONG", 60)
    monkeypatch.setattr(T, "MEMO", 50)
    with open(PATH, encoding="utf-8") as f:
        small = T.Encoder(f.read())
    longer = ["the cat sat on it's mat. " * 9, "", None, "x" * 300, "ab cd " * 40 + "<|endoftext|>" + " ef gh" * 30]
    assert lists(small, longer + texts[:300]) == [library(t) for t in longer] + want[:300]


def test_patterns():
    for capacity in (7, 12, 31):
        lengths = [n for n in range(1, capacity + 1) if n % 5]
        want = {tuple(sorted(c, reverse=True)) for c in product([0, *lengths], repeat=3) if sum(c) == capacity}
        assert set(map(tuple, P.exact_patterns(np.array(lengths), capacity).tolist())) == want


def test_plan_holds_every_piece_and_stays_near_best_fit():
    rng = np.random.default_rng(4)
    cases = [rng.integers(1, 1025, 9000), np.full(500, 1024), np.ones(3000, int), np.array([5]), rng.integers(600, 1025, 900),
             np.where(rng.random(6000) < 0.33, 700, rng.integers(1, 1025, 6000)), np.repeat([600, 424, 1000, 24], 50)]
    for lengths in cases:
        counts = {int(n): int(c) for n, c in zip(*np.unique(lengths, return_counts=True))}
        made, held = P.plan(counts), {}
        for pattern, repeats in made:
            assert repeats > 0 and 0 < sum(n * c for n, c in pattern.items()) <= 1024
            for n, c in pattern.items():
                held[n] = held.get(n, 0) + c * repeats
        assert held == counts
        n = sum(r for _, r in made)
        assert n >= -(-lengths.sum() // 1024)
        assert n <= 1.01 * sum(r for _, r in P.best_fit(counts, 1024)) + 1
    assert sum(r for _, r in P.plan({600: 50, 424: 50, 1000: 50, 24: 50})) == 100
    assert P.plan({}) == []


def check(out, docs, library, capacity=P.CAPACITY):
    """Rows of the query against documents (doc_id, text)."""
    want = {}
    for doc_id, text in docs:
        ids = [*library(text), 2]
        n = -(-len(ids) // capacity)
        cuts = [0, *[len(ids) - capacity * (n - k) for k in range(1, n)], len(ids)]
        for k, (a, b) in enumerate(zip(cuts, cuts[1:])):
            key = (doc_id, k, a, b - a, zlib.crc32(np.array(ids[a:b], "<u4").tobytes()))
            want[key] = want.get(key, 0) + 1
    got, filled = {}, {}
    for r in out:
        key = (r.doc_id, r.piece, r.start, r.length, r.ids_crc32)
        got[key] = got.get(key, 0) + 1
        filled.setdefault(r.sequence_id, []).append((r.offset, r.length))
    assert got == want
    for parts in filled.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= capacity
    return len(filled), sum(r.length for r in out)


def test_edges(spark, library, monkeypatch):
    monkeypatch.setattr(P, "BLOCK_BITS", 3)
    rows = [(1, None), (2, ""), (2, ""), (None, "a b"), (3, "word " * 5000), (4, "x" * 30000), (5, "a " * 1023), (6, "a " * 511),
            *[(10 + i, "same text here") for i in range(200)], (2**62, "é 😀"), (-1, "<|endoftext|>")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 AS length", "2 AS offset", "3 AS ids")
    out = P.pack(P.token_pieces(docs, PATH, with_ids=False)).collect()
    n, total = check(out, rows, library)
    assert n <= 1.05 * total / 1024 + 1
    assert P.pack(P.token_pieces(docs.limit(0), PATH)).count() == 0
    with pytest.raises(ValueError):
        P.pack(spark.createDataFrame([(2000,)], "length long"))


def test_sequences_hold_the_ids(spark, library):
    rows = [(i, "some words here " * (i % 90)) for i in range(150)]
    out = P.packed_sequences(spark.createDataFrame(rows, "doc_id long, text string").repartition(3), PATH, capacity=64).collect()
    texts, seen = dict(rows), {}
    for r in out:
        assert len(r.ids) <= 64
        for at, after in zip(r.pieces, [p.offset for p in r.pieces[1:]] + [len(r.ids)]):
            seen.setdefault(at.doc_id, {})[at.piece] = r.ids[at.offset:after]
    assert {i: sum((p for _, p in sorted(parts.items())), []) for i, parts in seen.items()} == {
        i: [*library(t), 2] for i, t in texts.items()}


def test_query(spark, library):
    out = P.op13_pattern_packing(spark, SF_SMALL)
    kinds = dict(out.dtypes)
    assert [kinds[c] for c in ("piece", "start", "length", "ids_crc32", "sequence_id", "offset")] == ["int"] + ["bigint"] * 5
    docs = [tuple(r) for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("doc_id", "text").collect()]
    n, total = check(out.collect(), docs, library)
    assert n <= 1.03 * total / 1024 + 1
