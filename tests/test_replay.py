"""Replay windows (FIXTURES.md section C, replay events)."""

from pyspark.sql import functions as F

from tidemark.contracts import registry_frame
from tidemark.operators import merge, select
from tidemark.operators.joins import range_join
from tidemark.plans import ingest


def source(spark):
    rows = [("GameSchema", i, 100 + i) for i in range(20)] + [("GenreSchema", 100 + i, 100 + i) for i in range(5)]
    return spark.createDataFrame(rows, "table_name string, id long, updated_at long")


def events(spark):
    rows = [
        ("e1", "GameSchema", "RAW", 105, 109, "PENDING"),     # bounds included: 5 rows
        ("e2", "GameSchema", "RAW", 300, 400, "PENDING"),     # covers nothing
        ("e3", "GameSchema", "RAW", 110, 105, "PENDING"),     # end before start
        ("e4", "GameSchema", "RAW", 100, 119, "PENDING"),     # second event on one table
        ("e5", "NoSuchSchema", "RAW", 0, 999, "PENDING"),     # unknown table
        ("e6", "GenreSchema", "ANALYTICS", 0, 999, "PENDING"),  # other layer
        ("e7", "GenreSchema", "RAW", 0, 999, "COMPLETED"),    # not pending
    ]
    return spark.createDataFrame(rows, "event_id string, table_name string, layer string, start_watermark long, "
                                       "end_watermark long, status string")


def test_replay_counts_and_state(spark):
    plan = ingest.plan_replay(source(spark), events(spark), registry_frame(spark))
    counts = {r["event_id"]: r["records_processed"] for r in plan["counts"].collect()}
    assert counts == {"e1": 5, "e2": 0, "e3": 0, "e4": 20}
    assert [r["event_id"] for r in plan["unknown"].collect()] == ["e5"]
    changes = plan["counts"].select("event_id", F.lit("COMPLETED").alias("status"), "records_processed",
                                    F.lit(None).cast("string").alias("error_message"))
    ev = events(spark).withColumn("records_processed", F.lit(3).cast("long")) \
                      .withColumn("error_message", F.lit("old")) \
                      .withColumn("completed_at", F.lit(None).cast("timestamp_ntz"))
    now = F.lit("2024-06-01 00:00:00").cast("timestamp_ntz")
    out = {r["event_id"]: r for r in merge.event_state_change(ev, changes, now).collect()}
    assert out["e1"]["status"] == "COMPLETED" and out["e1"]["records_processed"] == 8
    assert out["e1"]["error_message"] is None and out["e1"]["completed_at"] is not None
    assert out["e5"]["status"] == "PENDING" and out["e5"]["error_message"] == "old"
    assert out["e5"]["completed_at"] is None


def test_in_progress_keeps_end_time_null(spark):
    ev = events(spark).withColumn("records_processed", F.lit(0).cast("long")) \
                      .withColumn("error_message", F.lit(None).cast("string")) \
                      .withColumn("completed_at", F.lit(None).cast("timestamp_ntz"))
    ch = spark.createDataFrame([("e1", "IN_PROGRESS", 0, None), ("e2", "FAILED", 0, "boom")],
                               "event_id string, status string, records_processed long, error_message string")
    out = {r["event_id"]: r for r in
           merge.event_state_change(ev, ch, F.lit("2024-06-01 00:00:00").cast("timestamp_ntz")).collect()}
    assert out["e1"]["status"] == "IN_PROGRESS" and out["e1"]["completed_at"] is None
    assert out["e2"]["status"] == "FAILED" and out["e2"]["error_message"] == "boom"
    assert out["e2"]["completed_at"] is not None


def test_range_join_matches_all_pairs(spark):
    import random
    rng = random.Random(9)
    wins = [(f"w{i}", rng.choice("AB"), a, a + rng.choice([-3, 0, 1, 3, 4, 15, 16, 17, 300, 5000, 2 ** 62]))
            for i, a in enumerate(rng.randint(-500, 900) for _ in range(120))] + [("n", "A", None, 5), ("m", None, 1, 5)]
    rows = [(i, rng.choice("AABC"), rng.randint(-600, 1500)) for i in range(700)] + [(9999, "A", None)]
    src = spark.createDataFrame(rows, "id long, table_name string, updated_at long")
    ev = spark.createDataFrame(wins, "event_id string, table_name string, start_watermark long, end_watermark long")
    out = range_join(src, ev, key="table_name", point="updated_at", start="start_watermark", end="end_watermark")
    want = sorted((w, i) for w, t, a, b in wins for i, s, p in rows
                  if t == s and None not in (a, p) and a <= p <= b)
    got = out.select(F.col("__w.event_id").alias("e"), F.col("__l.id").alias("i"))
    assert sorted(tuple(r) for r in got.collect()) == want
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan
    none = range_join(src, ev.limit(0), key="table_name", point="updated_at", start="start_watermark", end="end_watermark")
    assert none.count() == 0


def test_known_unknown_split(spark):
    reg = registry_frame(spark)
    ev = events(spark)
    known = {r["event_id"] for r in select.known_events(ev, reg).collect()}
    unknown = {r["event_id"] for r in select.unknown_events(ev, reg).collect()}
    assert unknown == {"e5"} and known | unknown == {f"e{i}" for i in range(1, 8)}
