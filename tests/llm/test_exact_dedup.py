"""Exact dedup against grouping of normalised texts."""

import hashlib
import re

import numpy as np
import pytest

from tidemark.llm import exact_dedup as D
from tidemark.llm import fuse


def by_hand(rows):
    norm = lambda t: re.sub(r"[\x20\x09-\x0D]+", " ", t or "")
    groups = {}
    for i, t in rows:
        groups.setdefault(norm(t), []).append(i)
    out = []
    for i, t in rows:
        g = groups[norm(t)]
        keep = min((x for x in g if x is not None), default=None)
        out.append((i, keep, len(g), hashlib.sha256(norm(t).encode()).hexdigest()))
    return sorted(out, key=repr)


def check(spark, rows, **kw):
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("digest", D.F.lit("clash"))
    got = D.exact_dedup(df, **kw).collect()
    assert sorted(((r.doc_id, r.keep_id, r.group_size, r.text_sha256) for r in got), key=repr) == by_hand(rows)
    kept = [r for r in got if r.kept]
    assert len(kept) == len({r.text_sha256 for r in got})
    assert all(r.doc_id == r.keep_id for r in kept)


ROWS = ([(i, f"text {i % 37}\t x") for i in range(400)] + [(1000 + i, "hot\n copy") for i in range(3000)]
        + [(5000, None), (5001, ""), (5002, " "), (5003, "\x0b\r\n"), (5004, "a\xa0b"), (5005, "a b"), (None, "text 3 x"),
           (None, None), (None, "alone"), (None, "alone"), (7, "text 7\t x"), (7, "text 7 x"), (7, "other"),
           (6000, "long " * 60000), (6001, "long\t" * 60000)])


@pytest.mark.parametrize("digest_hex", [64, 1])
def test_groups(spark, digest_hex):
    check(spark, ROWS, digest_hex=digest_hex)


def test_shuffled_texts(spark, monkeypatch):
    monkeypatch.setattr(D, "BROADCAST_ROWS", 1)
    monkeypatch.setattr(D, "BUCKET", 20)
    check(spark, ROWS)


def test_empty(spark):
    check(spark, [])
    check(spark, [(3, None)])


@pytest.mark.parametrize("n", [0, 1, 2, 3, 10, 100, 5000, 120_000])
def test_filter_has_every_member_and_few_others(n):
    rng = np.random.default_rng(n)
    keys = rng.integers(0, 1 << 63, n, dtype=np.uint64)
    made = fuse.build(np.concatenate([keys, keys[:5]]))
    assert made.has(keys).all()
    others = rng.integers(1 << 63, (1 << 64) - 1, 20_000, dtype=np.uint64)
    assert made.has(others).mean() < 0.01
    if n >= 100_000:
        assert len(made.cells) < 1.2 * n
