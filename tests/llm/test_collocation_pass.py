"""One counting pass: rows added up in tasks, dealt without an aggregate there."""

import contextlib
import io

import pyarrow as pa
import pytest

from tests.llm.test_collocations import by_hand, corpus, got, texts
from tidemark.llm import collocations as C


def plan_of(df):
    text = io.StringIO()
    with contextlib.redirect_stdout(text):
        df.explain()
    return text.getvalue()


def test_texts_are_dealt_before_the_aggregate(spark):
    """An aggregate before the shuffle holds nearly all distinct phrases of a
    task and spills."""
    docs = texts(spark, corpus(6, 20)).select("text", "lang").where("lang IS NOT NULL")
    lines = plan_of(C.counts(docs, {1: None, 2: None}, 0, 0, 3, 2)).splitlines()
    at = next(i for i, x in enumerate(lines) if "MapInArrow" in x)
    dealt = next(i for i, x in enumerate(lines) if "Exchange" in x)
    assert dealt < at and not any("Aggregate" in x for x in lines[dealt:at])


def test_a_task_gives_a_phrase_out_once(spark):
    """However many texts a task reads, as long as its rows are few."""
    docs = texts(spark, [("one two three four", "en")] * 3000).select("text", "lang").coalesce(1)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "100")
    try:
        out = C.counts(docs, {1: None, 2: None, 3: None}, 0, 0, 3, 1)
        assert sorted((r.k, r.n) for r in out.collect()) == [(1, 3000)] * 4 + [(2, 3000)] * 3 + [(3, 3000)] * 2
        assert out.columns == ["k", "lang", "word", "h1", "h2", "h3", "n"]
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


@pytest.mark.parametrize("held", [1, 60, 5000])
def test_whatever_a_task_holds(spark, monkeypatch, held):
    rows = corpus(7, 300)
    monkeypatch.setattr(C, "HELD", held)
    assert got(C.collocations(texts(spark, rows).repartition(3))) == by_hand(rows)


def test_counts_of_equal_keys_are_added_up():
    parts = [pa.RecordBatch.from_pydict({"h1": [1, 2, None], "n": [1, 2, 3]}), pa.RecordBatch.from_pydict({"h1": [None, 1], "n": [10, 20]})]
    out = pa.Table.from_batches(C.added_up(parts, ["h1"])).to_pylist()
    assert sorted((str(r["h1"]), r["n"]) for r in out) == [("1", 21), ("2", 2), ("None", 13)]
    assert list(C.added_up([], ["h1"])) == []
