"""Phrase mining against a plain count."""

import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tests.conftest import SF_SMALL
from tidemark.llm import collocations as C


def by_hand(rows, min_count=10, longest=3, top=2000):
    f, n = Counter(), Counter()
    for text, lang in rows:
        lang = "und" if lang is None else lang
        lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", lower):
            words = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(words)
            for k in range(1, longest + 1):
                f.update((lang, *words[i:i + k]) for i in range(len(words) - k + 1))
    cand = {p: a for p, a in f.items() if a >= min_count and len(p) > 2}
    held = Counter()
    for p, a in cand.items():
        for k in range(2, len(p) - 1):
            for i in range(1, len(p) - k + 1):
                held[p[0], *p[i:i + k]] = max(held[p[0], *p[i:i + k]], a)
    out = {}
    for p, a in cand.items():
        if 100 * held[p] >= 50 * a:
            continue
        lang, words = p[0], p[1:]
        cuts = []
        for k in range(1, len(words)):
            left, right = f[lang, *words[:k]], f[lang, *words[k:]]
            cuts.append((1000000 * a * a // (left * right), k, left, right))
        score, _, left, right = min(cuts)
        out.setdefault(lang, []).append((-score, -a, " ".join(words).encode(), left, right))
    return sorted((lang, i + 1, p.decode(), -a, left, right, n[lang], -s) for lang, found in out.items()
                  for i, (s, a, p, left, right) in enumerate(sorted(found)[:top]))


def got(df):
    return sorted(tuple(r) for r in df.select("lang", "rank", "phrase", "a", "l", "r", "n", "score").collect())


def texts(spark, rows):
    return spark.createDataFrame(rows, "text string, lang string").selectExpr("*", "1 AS k", "'x' AS word", "2 AS n", "3 AS h1")


def corpus(seed, docs=120):
    rng = random.Random(seed)
    vocab = [f"w{i}" for i in range(30)] + ["The", "OF", "ßé", "x" * 40, "y" * 33]
    rows = []
    for _ in range(docs):
        words = [rng.choice(vocab[:rng.choice([3, 6, 35])]) for _ in range(rng.randint(0, 60))]
        rows.append(("".join(w + rng.choice([" "] * 20 + ["  ", "\t", ". ", ",", "\n", " ! "]) for w in words),
                     rng.choice(["en", "en", "de", None, "und"])))
    return rows


@pytest.mark.parametrize("sampling", [{}, {"sample": 0.0}, {"sample": 0.05, "lowered": 1}, {"sample": 1.0, "lowered": 10}])
def test_whatever_the_sample(spark, sampling):
    """Without a sample every phrase is a failure of the border and found by
    expansion passes; a lucky sample needs none."""
    rows = corpus(1, 500)
    want = by_hand(rows)
    assert len(want) > 100 and any(len(r[2].split()) == 3 for r in want)
    assert got(C.collocations(texts(spark, rows), **sampling)) == want


def test_longer_phrases_and_short_lists(spark):
    rows = corpus(2, 60)
    assert got(C.collocations(texts(spark, rows), min_count=3, longest=4, top=7)) == by_hand(rows, 3, 4, 7)


def test_edges(spark):
    rows = [(None, "en"), ("", None), (" \t .,;:!?\n\r\x0b\x0c", "en"), ("a b" * 1, None), ("z" * 100000, "en"),
            *[("New York, new york. NEW  york\tnew york", "en")] * 5, *[("o p", None)] * 6, *[("o p", "und")] * 6,
            ("q r " * 40000, "fr"), ("a\x85b c\xa0d e\x1cf " * 12, "x"), ("b'ö ÄÖ ÄÖ " * 12, "x")]
    docs = texts(spark, rows)
    assert got(C.collocations(docs)) == by_hand(rows)
    assert C.collocations(docs.limit(0)).count() == 0
    assert C.collocations(docs.where("text IS NULL")).count() == 0


def test_a_text_on_a_third_of_the_rows(spark):
    rows = corpus(3, 40) + [("hot words in a hot text. again hot words", "en")] * 200
    assert got(C.collocations(texts(spark, rows).repartition(5))) == by_hand(rows)


def test_words_that_share_a_hash(spark, monkeypatch):
    """With hashes of few bits under the first seeds the mining starts anew."""

    rows, seeds = corpus(4, 30), []
    whole = C.counts

    def weak(texts, filters, power, seed, longest, least):
        out = whole(texts, filters, power, seed, longest, least)
        seeds.append(seed)
        return out.withColumn("h1", F.when(F.lit(seed < 2), F.col("h1") % 4).otherwise(F.col("h1")))

    monkeypatch.setattr(C, "counts", weak)
    assert got(C.collocations(texts(spark, rows), min_count=4)) == by_hand(rows, 4)
    assert max(seeds) == 2


def test_scores_are_exact(spark):
    cases = [(10**12 + 7, 10**12 + 9, 10**12 + 11), (10, 10, 10), (3 * 10**11, 9 * 10**12, 7 * 10**11)]
    df = spark.createDataFrame(cases, "a long, l long, r long")
    out = df.select("a", "l", "r", C.cut_score(F.col("a"), F.col("l"), F.col("r")).alias("s")).collect()
    assert all(r.s == 10**6 * r.a * r.a // (r.l * r.r) for r in out)


def test_words_of_slices():
    rows = [*corpus(5, 50), (None, "en"), ("", "en")]
    arr = pa.array([t for t, _ in rows], pa.string())
    whole = C.Words(arr, [g or "und" for _, g in rows], 0)
    part = C.Words(arr.slice(10, 30), [g or "und" for _, g in rows[10:40]], 0)
    inside = (whole.owner >= 10) & (whole.owner < 40)
    assert np.array_equal(whole.hash[inside], part.hash)
    assert len({(whole.langs[o], whole.spelling(i)) for i, o in enumerate(whole.owner)}) == len(np.unique(whole.hash))


def test_query(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("text", "lang").collect()]
    out = C.op12_collocations(spark, SF_SMALL)
    assert got(out) == by_hand(rows)
    assert {t for c, t in out.dtypes if c not in ("lang", "phrase")} == {"bigint"}
