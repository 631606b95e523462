"""The filter audit against a plain reading of the contract."""

import random
import re
from itertools import permutations

from tests.conftest import SF_SMALL
from tidemark.llm import filter_audit as A


def masks(rows, labels):
    """(part, set of failed filters, good, toxic) of rows (doc_id, text, source)."""
    out = []
    for doc_id, text, source in rows:
        text = text or ""
        words = re.findall(r"[^\x20\x09-\x0D]+", text)
        fails = {"A": len(words) < 200, "B": 100 * len(set(words)) < 50 * len(words),
                 "C": 100 * len(re.findall("[A-Z]", text)) > 2 * len(text), "D": bool(re.search("[#$%&*|]", text)),
                 "E": doc_id is not None and any(i is not None and i < doc_id and (t or "") == text for i, t, _ in rows)}
        mine = [x for x in labels if x[0] == doc_id and doc_id is not None]
        out.append((source or "", {f for f, bad in fails.items() if bad}, any(q == 1 for _, q, _ in mine),
                    any(t == 1 for _, _, t in mine)))
    return out


def by_hand(rows, labels):
    docs, out = masks(rows, labels), {}
    for part in {p for p, *_ in docs}:
        own = [d for d in docs if d[0] == part]
        gone = dict.fromkeys("ABCDE", 0)
        for order in permutations("ABCDE"):
            left = own
            for k, f in enumerate(order):
                removed = [d for d in left if f in d[1]]
                left = [d for d in left if f not in d[1]]
                gone[f] += len(removed)
                out[part, "".join(order), k + 1] = [
                    len(left), len(removed), sum(f in d[1] for d in own) - len(removed),
                    sum(d[1] == {f} for d in own), sum(d[2] for d in removed), sum(d[3] for d in removed), f]
        for key, v in out.items():
            if key[0] == part:
                v[-1] = gone[v[-1]] if isinstance(v[-1], str) else v[-1]
    return {k: tuple(v) for k, v in out.items()}


def got(df):
    return {(r.part, r.filter_order, r.step): (r.kept, r.removed, r.redundant, r.unique_fails, r.good_lost, r.toxic_lost,
                                               r.shapley) for r in df.collect()}


DOCS = "doc_id long, text string, source string"
LABELS = "doc_id long, quality int, toxic int"


def test_edges(spark):
    long = " ".join(f"w{i}" for i in range(250))
    rows = [(1, None, None), (2, "", "a"), (3, "x" * 70000 + " y", "a"), (4, long, "a"), (5, long, None), (5, long, None),
            (None, long, "b"), (None, None, ""), (6, "A% b", "b"), (7, "same " * 300, "b"), (8, "same " * 300, "clean"),
            (9, long + " é　\x85\x1c", "clean"), (10, "AB" * 3, "ß"), (2**62, "#", "a"), (-2**62, "#", "b")]
    labels = [(1, 1, 0), (4, 1, 1), (5, 1, None), (5, 0, 1), (None, 1, 1), (7, None, 1), (99, 1, 1)]
    docs = spark.createDataFrame(rows, DOCS).selectExpr("*", "'x' AS part", "0 AS row", "1 AS digest")
    marks = spark.createDataFrame(labels, LABELS)
    assert got(A.audit(docs, marks)) == by_hand(rows, labels)
    assert A.audit(docs.limit(0), marks).count() == 0
    assert got(A.audit(docs, marks.limit(0))) == by_hand(rows, [])
    clean = [(1, long, "s"), (2, long + " z", "s")]
    out = got(A.audit(spark.createDataFrame(clean, DOCS), marks))
    assert len(out) == 600 and all(v == (2, 0, 0, 0, 0, 0, 0) for v in out.values())


def test_hot_parts_and_copies(spark, monkeypatch):
    """A part and a text on a third of the rows, ranges of four rows."""
    monkeypatch.setattr(A, "RANGE_BITS", 2)
    monkeypatch.setattr(A, "HOT", 4)
    rng = random.Random(5)
    texts = ["#", "ABC d", *(" ".join(rng.choice("abcdefg") * rng.randint(1, 3) for _ in range(rng.choice([3, 210, 400])))
                             for _ in range(40))]
    rows = [(i, "hot" if i % 3 == 0 else rng.choice(texts), "s" if i % 3 else rng.choice("tu")) for i in range(400)]
    labels = [(i, rng.randint(0, 1), rng.randint(0, 1)) for i in range(0, 400, 3)]
    docs = spark.createDataFrame(rows, DOCS).repartition(5)
    assert got(A.audit(docs, spark.createDataFrame(labels, LABELS))) == by_hand(rows, labels)


def test_merges():
    rng = random.Random(2)
    for n in range(300):
        lists = [sorted(rng.sample(range(200), rng.choice([0, 1, 5, 60, 150]))) for _ in range(rng.randint(1, 5))]
        assert A.union(lists) == sorted(set().union(*lists))
        a, b = lists[0], lists[-1]
        assert A.difference(a, b) == sorted(set(a) - set(b)) and A.overlap(a, b) == len(set(a) & set(b))
        bound = rng.randint(-1, 201)
        start = next((i for i, x in enumerate(a) if x >= bound), len(a))
        for at in range(start + 1):
            assert A.gallop(a, at, bound) == start


def test_query(spark):
    out = A.op11_filter_audit(spark, SF_SMALL)
    docs = [tuple(r) for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("doc_id", "text", "source").collect()]
    labels = [tuple(r) for r in spark.read.parquet(f"{SF_SMALL}/labels.parquet").select("doc_id", "quality", "toxic").collect()]
    assert got(out) == by_hand(docs, labels)
    assert dict(out.dtypes)["step"] == "int" and dict(out.dtypes)["removed"] == "bigint"
