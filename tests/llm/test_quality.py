"""Quality votes against plain cosines, and held-out accuracy."""

from zlib import crc32

import numpy as np
import pyarrow as pa
import pytest

from tests.conftest import SF_MED
from tidemark.llm import quality as Q


def model(texts, labels):
    doc, term, weight = Q.terms(pa.array(texts, pa.string()))
    cut = np.searchsorted(doc, np.arange(len(texts) + 1))
    return Q.Model.of_terms([term[a:b] for a, b in zip(cut, cut[1:])], [weight[a:b] for a, b in zip(cut, cut[1:])], labels)


def test_terms_by_hand():
    texts = ["The the\tTHE", None, "", " \n ", "b1 b1 b22", "x " * 5000]
    doc, term, weight = Q.terms(pa.array(texts, pa.string()))
    want = {}
    for i, t in enumerate(texts):
        words = (t or "").split()
        for w in words:
            for x in (crc32(w.lower().encode()) % Q.WORDS, Q.WORDS + crc32(Q.shape(w).encode()) % Q.SHAPES):
                want[i, x] = want.get((i, x), 0) + 1
    got = {(d, t): w for d, t, w in zip(doc.tolist(), term.tolist(), weight.tolist()) if t < Q.WORDS + Q.SHAPES}
    assert got == pytest.approx({k: 1 + np.log(n) for k, n in want.items()})
    assert set(doc.tolist()) == {0, 4, 5}
    assert Q.shape("ThIS-is99!") == "AaA-a0!"


def test_votes_by_hand():
    rng = np.random.default_rng(4)
    good, bad = ["the", "of", "and", "to", "in", "is"], ["&&&", "BUY!!", "$$$", "|", "###"]
    texts = [" ".join(rng.choice(good if i % 3 else bad, 30)) for i in range(120)]
    m = model(texts, [int(i % 3 > 0) for i in range(120)])
    new = [" ".join(rng.choice(good if i % 2 else bad, 25)) for i in range(40)] + ["", "漢"]
    scores = m.score(pa.array(new))
    doc, term, weight = Q.terms(pa.array(new))
    latent = Q.project(doc, term, Q.weighted(doc, term, weight, m.idf, len(new)), m.space, len(new))
    for x, s in zip(latent, scores):
        like = m.voters @ x
        near = np.argsort(-like)[:Q.NEIGHBOURS]
        w = np.maximum(like[near], 0)
        assert s == pytest.approx((w * m.labels[near]).sum() / w.sum() if w.sum() > 1e-9 else m.prior, abs=1e-3)
    assert all((s >= 0.7) == bool(i % 2) for i, s in enumerate(scores[:40]))
    assert scores[40] == pytest.approx(m.prior)


def test_frame_edges(spark):
    docs = spark.createDataFrame([(1, "a b", 9), (2, None, 9), (2, None, 9), (3, "w " * 60000, 9), (None, "x", 9)],
                                 "doc_id long, text string, quality int")
    none = spark.createDataFrame([(1, None)], "doc_id long, quality int")
    m = Q.fit_quality(docs, none)
    assert [r.score for r in Q.quality_scores(docs, m).collect()] == [0.5] * 5
    some = spark.createDataFrame([(1, 1), (1, 1), (3, 0), (99, 1), (None, 0)], "doc_id long, quality int")
    got = Q.quality_scores(docs, Q.fit_quality(docs, some)).collect()
    assert len(got) == 5 and all(0 <= r.score <= 1 for r in got) and got[0].score > got[3].score
    assert Q.quality_scores(docs.limit(0), m).count() == 0
    with pytest.raises(ValueError):
        Q.quality_scores(docs, m, out="quality")


def test_held_out_accuracy(spark):
    out = Q.op8_quality_knn(spark, SF_MED).collect()
    label = {r.doc_id: r.quality for r in spark.read.parquet(f"{SF_MED}/labels.parquet").collect()}
    assert len(out) == spark.read.parquet(f"{SF_MED}/documents.parquet").count()
    assert all(r.held_out == (crc32(str(r.doc_id).encode()) % 4 == 2) for r in out)
    assert all(r.predicted == (r.score >= 0.7) for r in out)
    test = [(r.predicted, label[r.doc_id]) for r in out if r.held_out and r.doc_id in label]
    assert sum(p == y for p, y in test) / len(test) > 0.95
    assert sorted(map(repr, out)) == sorted(map(repr, Q.op8_quality_knn(spark, SF_MED).collect()))


def test_a_labelled_id_on_a_third_of_the_rows_votes_once(spark):
    """Repeats of a labelled document, of its label or of both change no score."""
    docs = [(i, f"good words number {i} of a plain text" if i % 2 else f"$$ BUY {i} now !!! {i}") for i in range(60)]
    labels = [(i, i % 2) for i in range(60)]
    frame = lambda d, l: (spark.createDataFrame(d, "doc_id long, text string"),
                          spark.createDataFrame(l, "doc_id long, quality int"))
    plain = frame(docs, labels)
    hot = frame(docs + [docs[4]] * 30, labels + [labels[4]] * 5)
    a, b = (Q.fit_quality(*f) for f in (plain, hot))
    score = lambda m: {r.doc_id: r.score for r in Q.quality_scores(plain[0], m).collect()}
    assert score(a) == score(b)
    two = frame(docs + [(4, "another text of the same id")] * 30, labels)
    assert score(Q.fit_quality(*two)) == score(Q.fit_quality(two[0].orderBy("text").repartition(3), two[1]))
