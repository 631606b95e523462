"""Reads of the past against plain loops; a hot key, ties, nulls, no rows."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from tidemark.operators import versions as V

SCHEMA = "k long, t timestamp_ntz, id long, v string, gone boolean"
ARGS = {"key": "k", "time": "t", "tie": "id"}


def moment(n):
    return dt.datetime(2024, 1, 1) + dt.timedelta(minutes=n)


def made(rows=600):
    """A third of the rows has one key; times repeat; some keys, times, values and flags are null."""
    rng = random.Random(3)
    out = []
    for i in range(rows):
        key = 0 if i % 3 == 0 else rng.choice([None, *range(1, 40)])
        time = moment(rng.randint(0, 200)) if rng.random() > 0.05 else None
        out.append((key, time, i, rng.choice([None, "a", "b"]), rng.choice([None, False, False, True])))
    return out


def last(rows, key, at):
    found = [r for r in rows if r[0] == key and r[1] is not None and r[1] <= at]
    return max(found, key=lambda r: (r[1], r[2])) if found else None


def test_state_and_feed(spark):
    rows = made()
    df = spark.createDataFrame(rows, SCHEMA)
    keys = {r[0] for r in rows} - {None}
    for a, b in ((50, 120), (0, 0), (-5, 300), (190, 400)):
        lit = lambda n: F.lit(moment(n).isoformat(" ")).cast("timestamp_ntz")
        state = {k: last(rows, k, moment(b)) for k in keys}
        want = {(k, r[1], r[2], r[3]) for k, r in state.items() if r and not r[4]}
        got = V.as_of(df, lit(b), **ARGS, values=["v"], deleted="gone").collect()
        assert {tuple(r) for r in got} == want and len(got) == len(want)
        feed = set()
        for k in keys:
            old, new = last(rows, k, moment(a)), state[k]
            old, new = (r if r and not r[4] else None for r in (old, new))
            between = [r for r in rows if r[0] == k and r[1] is not None and moment(a) < r[1] <= moment(b)]
            op = "insert" if new and not old else "delete" if old and not new else \
                "update" if old and new and old[3] != new[3] else None
            if op:
                feed.add((k, op, old and old[3], new and new[3], max(r[1] for r in between), len(between)))
        got = V.change_feed(df, lit(a), lit(b), **ARGS, values=["v"], deleted="gone").collect()
        assert {tuple(r) for r in got} == feed and len(got) == len(feed)
    assert V.as_of(df.limit(0), F.col("t"), **ARGS, values=["v"]).count() == 0
    assert V.change_feed(df.limit(0), lit(0), lit(9), **ARGS, values=["v"]).count() == 0


def test_as_of_join(spark):
    rows = made()
    rng = random.Random(4)
    asked = [(i, 0 if i % 3 == 0 else rng.choice([None, *range(45)]), moment(rng.randint(-5, 230)) if i % 11 else None)
             for i in range(500)]
    asked += asked[:5]
    probes = spark.createDataFrame(asked, "probe long, k long, at timestamp_ntz")
    df = spark.createDataFrame(rows, SCHEMA).repartition(7)
    join = lambda p, v: V.as_of_join(p, v, key="k", at="at", time="t", tie="id", values=["id", "v"])
    want = []
    for p in asked:
        r = last(rows, p[1], p[2]) if p[1] is not None and p[2] is not None else None
        want.append((*p, *((r[1], r[2], r[3]) if r else (None, None, None))))
    assert sorted(map(str, (tuple(r) for r in join(probes, df).collect()))) == sorted(map(str, want))
    assert join(probes.limit(0), df).count() == 0
    assert {r.id for r in join(probes, df.limit(0)).collect()} == {None}
    with pytest.raises(ValueError):
        join(probes.withColumnRenamed("probe", "v"), df)


def test_a_hot_key_is_spread(spark):
    """One key with all rows lies in many ranges, and its carries are right."""
    n = 4000
    df = spark.range(n).select(F.lit(1).cast("long").alias("k"), F.timestamp_seconds(F.col("id") * 10).cast("timestamp_ntz").alias("t"), "id")
    probes = spark.range(n).select("id", F.lit(1).cast("long").alias("k"),
                                   F.timestamp_seconds(F.col("id") * 10 + 5).cast("timestamp_ntz").alias("at"))
    out = V.as_of_join(probes.withColumnRenamed("id", "probe"), df, key="k", at="at", time="t", tie="id", values=["id"])
    assert out.where(F.col("id") != F.col("probe")).count() == 0 and out.where("id IS NOT NULL").count() == n
