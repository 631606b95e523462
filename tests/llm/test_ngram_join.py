"""Chosen-path join against all pairs."""

import random

import numpy as np
import pyarrow as pa
import pytest

from tests.conftest import SF_SMALL
from tidemark.llm import ngram_join as J
from tidemark.llm.components import connected_components
from tidemark.llm.shingles import shingle_sets


def sets_of(text):
    w = [x for x in __import__("re").split(r"[\x20\x09-\x0D]+", text or "") if x]
    return frozenset(tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4))) if w else frozenset()


def by_hand(rows):
    sets = [sets_of(t) for _, t in rows]
    token = {}
    for i, s in enumerate(sets):
        for x in s:
            token.setdefault(x, []).append(i)
    near = [set() for _ in rows]
    for i, s in enumerate(sets):
        for j in {j for x in s for j in token[x]} - {i}:
            if 5 * len(s & sets[j]) >= 4 * len(s | sets[j]):
                near[i].add(j)
    root = [-1] * len(rows)
    for i in range(len(rows)):
        if root[i] < 0:
            todo, root[i] = [i], i
            while todo:
                for j in near[todo.pop()]:
                    if root[j] < 0:
                        root[j] = i
                        todo.append(j)
    low = {}
    for i, (d, _) in enumerate(rows):
        if d is not None:
            low[root[i]] = min(low.get(root[i], d), d)
    return sorted(((d, low.get(root[i]), len(near[i])) for i, (d, _) in enumerate(rows)), key=repr)


def run(spark, rows):
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("node", J.F.lit("clash"))
    got = J.ngram_join(df).collect()
    kept = [r for r in got if r.kept]
    assert {r.class_id for r in kept} == {r.class_id for r in got}
    assert all(r.doc_id == r.class_id for r in kept)
    return sorted(((r.doc_id, r.class_id, r.n_links) for r in got), key=repr)


def corpus(rng, n):
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(4))
    passage = " ".join(word() for _ in range(60))
    rows = []
    while len(rows) < n:
        base = [word() for _ in range(rng.randint(30, 150))]
        for _ in range(rng.choice([1, 1, 1, 2, 3, 8])):
            w = list(base)
            for _ in range(rng.randint(0, 4)):
                w[rng.randrange(len(w))] = word()
            rows.append(" ".join(w) + (" " + passage if rng.random() < 0.3 else ""))
    hot = [word() for _ in range(120)]
    for _ in range(n // 2):
        w = list(hot)
        w[rng.randrange(len(w))] = word()
        rows.append(" ".join(w))
    rows += [" ".join(hot)] * 40
    return [(i, t) for i, t in enumerate(rows)]


EDGES = [(9000, None), (9001, ""), (9002, " \n"), (9003, "one two"), (9004, "one\ttwo"), (9005, "a b c d e"),
         (9006, "a b c d e"), (None, "a b c d e"), (None, "null id alone here now"), (9006, "a b c d e"),
         (9007, "long " * 30000), (9008, "long " * 20000), (9009, "a a a a a a a a"), (9010, "x" * 100000)]


@pytest.mark.parametrize("block,limit", [(512, 1024), (16, 6)])
def test_all_links(spark, monkeypatch, block, limit):
    monkeypatch.setattr(J, "BLOCK", block)
    monkeypatch.setattr(J, "LIMIT", limit)
    rows = corpus(random.Random(block), 200) + EDGES
    assert run(spark, rows) == by_hand(rows)


def test_empty(spark):
    assert run(spark, []) == []
    assert run(spark, [(1, None), (2, "")]) == [(1, 1, 0), (2, 2, 0)]


def test_query(spark):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect()]
    got = J.op7_ngram_join(spark, SF_SMALL).collect()
    assert sorted(((r.doc_id, r.class_id, r.n_links) for r in got), key=repr) == by_hand(rows)
    assert sorted(r.doc_id for r in got if r.kept) == sorted({r.class_id for r in got})


def test_shingles_are_whole_sets():
    texts = ["a b c d e f", None, "", "p q", "a b c d e f a b c d e f", "  a  b\tc\nd e f "]
    got = shingle_sets(pa.array(texts, pa.string()))
    assert [len(x) for x in got] == [len(sets_of(t)) for t in texts]
    assert np.array_equal(got[0], got[5]) and set(got[0]) <= set(got[4])


def test_runs():
    assert J.miss(J.runs_for(J.RECALL, 0.8), 0.8) <= 1 - J.RECALL < J.miss(J.runs_for(J.RECALL, 0.8) - 1, 0.8)
    assert J.runs_for(J.RECALL, 0.8) * J.CHOICES <= J.SIGNATURE - J.DEPTH - 1
    assert J.runs_for(0.9, 0.8) < J.runs_for(J.RECALL, 0.8)
    with pytest.raises(ValueError):
        J.runs_for(J.RECALL, 0.2)


def test_miss_is_what_paths_lose(spark, monkeypatch):
    """Pairs of signatures that agree on each function with probability 0.8,
    one pair a place, sent down the real paths: all buckets are hot until the
    last step, and the share of pairs that end apart is the formula's."""
    size, depth, pairs, runs = 24, 3, 1500, 1
    for name, value in (("SIGNATURE", size), ("DEPTH", depth), ("LIMIT", 1), ("DENSE", 2.0), ("ALIKE", 0.0)):
        monkeypatch.setattr(J, name, value)
    rng = np.random.default_rng(5)
    rows = []
    for i in range(pairs):  # the first value names the pair, so that buckets hold one pair each
        one = rng.integers(0, 1 << 30, size)
        two = np.where(rng.random(size) < 0.8, one, one + 1)
        rows += [(b"%d.0" % i, one.tolist()), (b"%d.1" % i, two.tolist())]
    nodes = spark.createDataFrame(rows, "node binary, sig array<int>")
    _, alike = J.chosen_paths(nodes, 2 * pairs, runs)
    met = {bytes(r.node).split(b".")[0] for r in alike.collect()}
    want = J.miss(runs, 0.8, depth, size)
    assert abs((pairs - len(met)) / pairs - want) < 4 * (want * (1 - want) / pairs) ** 0.5


def test_components(spark):
    rng = random.Random(1)
    edges = [(i, i + 1) for i in range(60)] + [(100, k) for k in range(101, 400)] + [(7, 7)]
    edges += [(rng.randint(500, 900), rng.randint(500, 900)) for _ in range(250)]
    root = {}
    find = lambda x: x if root.setdefault(x, x) == x else find(root[x])
    for a, b in edges:
        if a != b:
            a, b = sorted((find(a), find(b)))
            root[b] = a
    got = connected_components(spark.createDataFrame(edges, "a long, b long")).collect()
    assert {r.node: r.root for r in got} == {x: find(x) for x in list(root)} and len(got) == len(root)
