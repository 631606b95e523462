"""Overlapping windows against a plain loop, and late records of a stream."""

import random

import pytest
from pyspark.sql import functions as F

from tidemark.operators import windows as W
from tidemark.plans import api
from tidemark.streaming import late_stream as L

EVENTS = "event_id string, table_name string, start_watermark long, end_watermark long"
ROWS = "table_name string, id long, updated_at long"


def plain(rows, events):
    inside = lambda e, r: e[1] == r[0] and None not in (e[2], e[3], r[2]) and e[2] <= r[2] <= e[3]
    return ({e[0]: sum(inside(e, r) for r in rows) for e in events},
            sorted(r for r in rows if any(inside(e, r) for e in events)))


@pytest.mark.parametrize("block", [3, W.BLOCK])
def test_counts_and_single_landing(spark, monkeypatch, block):
    monkeypatch.setattr(W.running_sum, "__defaults__", (block,))
    rng = random.Random(block)
    rows = [(rng.choice("aab"), i, rng.choice([None, rng.randint(-50, 400)])) for i in range(300)] + [("a", 1000, 7)] * 3
    events = [(f"e{i}", rng.choice("aaabc"), s := rng.randint(-60, 380), s + rng.choice([-5, 0, 1, 30, 400])) for i in range(80)]
    events += [("same1", "a", 10, 20), ("same2", "a", 10, 20), ("touch", "a", 21, 30), ("none", "a", None, 5), ("open", "b", 3, None)]
    source, asked = spark.createDataFrame(rows, ROWS).repartition(4), spark.createDataFrame(events, EVENTS)
    out = W.replay_overlaps(source, asked)
    counts, landed = plain(rows, events)
    assert {r.event_id: r.records_processed for r in out.counts.collect()} == counts
    assert sorted(tuple(r)[:3] for r in out.landed.collect()) == landed
    spans = sorted((r.table_name, r.start, r.end) for r in out.intervals.collect())
    assert all(a[0] != b[0] or a[2] < b[1] for a, b in zip(spans, spans[1:]))
    # The bridge names the intervals of a window, in which its records lie.
    n = {(r.table_name, r.id): r.n for r in out.landed.collect()}
    bridge = {r.event_id: r for r in out.bridge.collect()}
    for e in events:
        if e[0] in bridge:
            b = bridge[e[0]]
            assert sum(b.first_n <= k <= b.last_n for (t, _), k in n.items() if t == e[1]) == len(
                {r[:2] for r in rows if r[0] == e[1] and r[2] is not None and e[2] <= r[2] <= e[3]})


def test_nothing_to_replay(spark):
    none, rows = spark.createDataFrame([], EVENTS), spark.createDataFrame([("a", 1, 1)], ROWS)
    assert W.replay_overlaps(rows, none).counts.count() == 0
    one = spark.createDataFrame([("e", "a", 0, 5)], EVENTS)
    out = W.replay_overlaps(rows.limit(0), one)
    assert out.counts.first().records_processed == 0 and out.landed.count() == 0


def test_late_records(spark, scratch):
    pages = [[("a", 1, 10), ("b", 2, 5), ("a", 3, 30)], [("a", 4, 29), ("a", 5, 30), ("b", 6, 4), ("a", 7, None), (None, 8, 1)],
             [("c", 9, 1), ("a", 10, 2), ("a", 11, 40), ("a", 12, 35)]]
    paths = L.LatePaths(f"{scratch}/landing", f"{scratch}/rows", f"{scratch}/marks", f"{scratch}/checkpoint")
    store = api.LogStore(spark, f"{scratch}/logs")
    schema = spark.createDataFrame([], ROWS).schema
    for n, page in enumerate(pages):
        spark.createDataFrame(page, schema).write.parquet(f"{paths.landing}/p{n}")
        assert L.run_late_stream(spark, schema, paths, store) == 1
    assert L.run_late_stream(spark, schema, paths, store) == 0
    late = sorted((r.epoch, r.id) for r in L.read_rows(spark, schema, paths, True).collect())
    assert late == [(1, 4), (1, 6), (2, 10)]
    assert L.read_rows(spark, schema, paths, False).count() == 9
    events = lambda: sorted((r.table_name, r.start_watermark, r.end_watermark, r.status)
                            for r in store.read("fallback_events").collect())
    want = [("a", 2, 2, "PENDING"), ("a", 29, 29, "PENDING"), ("b", 4, 4, "PENDING")]
    assert events() == want
    # A micro-batch that is tried again changes nothing, though the marks have moved on.
    L.take_batch(spark.createDataFrame(pages[1], schema), 1, paths, store)
    assert events() == want and late == sorted((r.epoch, r.id) for r in L.read_rows(spark, schema, paths, True).collect())
    # One mark row per table and micro-batch at most.
    assert paths.marks_log().versions(spark).groupBy("table_name", "_seq").agg(F.max("mark")).count() == 5
