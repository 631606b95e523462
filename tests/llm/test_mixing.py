"""Entropy balancing against a plain reading of the contract."""

import hashlib
import re

import pytest

from tests.conftest import SF_SMALL
from tidemark.llm import mixing as M


def by_hand(rows, weights=(3, 1, 2), share=1.5, cap=2.0):
    """rows of (doc_id, text, source) -> {source: (size, target)}."""
    size = {}
    for _, text, source in rows:
        size[source] = size.get(source, 0) + len(re.findall(r"[^\x20\x09-\x0D]+", text or ""))
    order = sorted(size, key=lambda s: (s is None, s or ""))
    w = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    target, open_, left = {}, set(order), share * sum(size.values())
    while open_:
        unit = left / sum(w[s] for s in open_)
        above = {s for s in open_ if unit * w[s] >= cap * size[s]}
        if not above:
            target |= {s: unit * w[s] for s in open_}
            break
        for s in above:
            target[s] = cap * size[s]
            left -= target[s]
        open_ -= above
    return {s: (size[s], target[s]) for s in order}


def check(rows, out):
    want = by_hand(rows)
    assert len(out) == len(rows)
    taken, longest = {}, {}
    for r in out:
        n, t = want[r.source]
        assert r.source_size == n and r.target == pytest.approx(t, rel=1e-9, abs=1e-9)
        assert 0 <= r.copies <= 2 and r.taken == r.copies * r["size"]
        taken[r.source] = taken.get(r.source, 0) + r.taken
        longest[r.source] = max(longest.get(r.source, 0), r["size"])
    for s, (n, t) in want.items():
        assert abs(taken[s] - t) <= longest[s] / 2 + 1e-6, (s, taken[s], t, longest[s])


def test_edges(spark):
    rows = [(i, "w " * (i * 7 % 23), ["b", "a", None, "é", "Z"][i % 5 if i % 3 else 0]) for i in range(300)]
    rows += [(7, "w w w", "a"), (7, "w w w", "a"), (900, None, "a"), (None, "q r", None), (901, "", "empty"),
             (902, "long " * 40000, "b"), (903, "\x0b\x0c w　w\x85 x\n", "a")]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string").withColumn("size", M.F.lit("clash"))
    first = M.mix(df).collect()
    check(rows, first)
    assert sorted(map(repr, first)) == sorted(map(repr, M.mix(df).collect()))
    assert M.mix(df.limit(0)).count() == 0
    alone = M.mix(df.where("source = 'empty'")).collect()
    assert [(r.target, r.taken) for r in alone] == [(0.0, 0)]


def test_one_source_and_many(spark):
    rows = [(i, "w " * (1 + i % 9), f"s{i % 150:03d}") for i in range(2000)]
    check(rows, M.mix(spark.createDataFrame(rows, "doc_id long, text string, source string")).collect())
    rows = [(i, "w " * (1 + i % 9), "only") for i in range(500)]
    check(rows, M.mix(spark.createDataFrame(rows, "doc_id long, text string, source string")).collect())


def test_newton_reaches_far_targets(spark):
    df = spark.createDataFrame([(1000, t) for t in (1e-6, 0.5, 10.0, 1000.0, 2000.0, 5e4)], "n long, t double")
    for r in df.withColumn("rate", M.newton_rate(M.F.col("n"), M.F.col("t"))).collect():
        assert r.rate == pytest.approx(r.t / r.n, rel=1e-9)


def test_query(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("doc_id", "text", "source").collect()
    source = {r.doc_id: r.source for r in docs}
    out = M.mix(spark.read.parquet(f"{SF_SMALL}/documents.parquet")).collect()
    check([tuple(r) for r in docs], out)
    assert all(r.source == source[r.doc_id] for r in out)
    assert M.op6_mixing(spark, SF_SMALL).columns == ["doc_id", "size", "source_size", "target", "taken", "copies"]
