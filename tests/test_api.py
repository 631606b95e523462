"""The API routes over a log store."""

import os

from pyspark.sql import functions as F

from tidemark.plans import api

NOW = "2024-06-01 00:00:00"


def seeded_store(spark, scratch):
    store = api.LogStore(spark, os.path.join(scratch, "logs"))
    ts = lambda s: F.lit(s).cast("timestamp_ntz")
    runs = spark.createDataFrame([("r1", "2024-01-01 00:00:00", "2024-01-01 00:00:03", "RAW", "COMPLETED", None),
                                  ("r2", "2024-01-02 00:00:00", None, "RAW", "RUNNING", None),
                                  ("r3", "2024-01-03 00:00:00", "2024-01-03 00:01:00", "RAW", "FAILED", "boom")],
                                 "run_id string, started_at string, completed_at string, layer string, status string, "
                                 "error_message string") \
        .withColumn("started_at", F.col("started_at").cast("timestamp_ntz")) \
        .withColumn("completed_at", F.col("completed_at").cast("timestamp_ntz"))
    store.write("ingestion_runs", runs, seq=1, changed_at=ts("2024-01-01"))
    cps = spark.createDataFrame([("GameSchema", 100, 90, 7, "RAW", 0, False, "r1"),
                                 ("GenreSchema", 200, 190, 3, "RAW", 0, False, "r1")],
                                "table_name string, current_watermark long, fallback_watermark long, last_id long, "
                                "layer string, offset_val int, is_override_active boolean, "
                                "last_successful_run_id string").withColumn("updated_at", ts(NOW))
    store.write("ingestion_checkpoints", cps, seq=1)
    b = spark.createDataFrame([(1, "r1", "GameSchema", "RAW", "SUCCESS", 100, 0, 500, 12, "q", None),
                               (2, "r1", "GenreSchema", "RAW", "FAILED", 200, 0, 0, 3, "q", "timeout")],
                              "batch_id long, run_id string, table_name string, layer string, status string, "
                              "cursor_value long, offset_value int, records_count int, duration_ms int, "
                              "query_sent string, error_message string").withColumn("created_at", ts(NOW))
    store.write("batch_logs", b, seq=1)
    return store


def test_get_routes(spark, scratch):
    store = seeded_store(spark, scratch)
    s = api.stats(store).first()
    assert (s["total_runs"], s["successful_runs"], s["failed_runs"], s["total_tables"]) == (3, 1, 1, 2)
    assert (s["active_overrides"], s["total_records_ingested"], s["total_schema_changes"]) == (0, 500, 0)
    r = api.runs(store, limit=2).collect()
    assert [x["run_id"] for x in r] == ["r3", "r2"] and r[0]["duration_seconds"] == 60
    assert r[1]["duration_seconds"] is None
    assert [x["table_name"] for x in api.checkpoints(store).collect()] == ["GameSchema", "GenreSchema"]
    assert [x["batch_id"] for x in api.batches(store, table_name="GenreSchema").collect()] == [2]
    assert [x["batch_id"] for x in api.batches(store, q="TIMEOUT").collect()] == [2]
    assert api.schema_history(store).count() == 0 and api.fallback_events(store).count() == 0


def test_post_routes_are_idempotent(spark, scratch):
    store = seeded_store(spark, scratch)
    assert api.override_checkpoint(store, "GameSchema", 42, True, now=NOW, seq=2)
    assert not api.override_checkpoint(store, "NoSuchSchema", 1, True, now=NOW, seq=3)
    cps = {r["table_name"]: r for r in store.read("ingestion_checkpoints").collect()}
    assert cps["GameSchema"]["fallback_watermark"] == 42 and cps["GameSchema"]["is_override_active"]
    assert cps["GenreSchema"]["fallback_watermark"] == 190
    assert api.stats(store).first()["active_overrides"] == 1
    ev = api.create_fallback_event(store, "GameSchema", 10, 5, now=NOW, seq=4).first()
    again = api.create_fallback_event(store, "GameSchema", 10, 5, now=NOW, seq=5).first()
    assert ev["event_id"] == again["event_id"] and ev["status"] == "PENDING"
    assert [r["event_id"] for r in api.fallback_events(store).collect()] == [ev["event_id"]]
    later = api.create_fallback_event(store, "GameSchema", 10, 5, now="2024-06-02 00:00:00", seq=6).first()
    assert later["event_id"] != ev["event_id"] and api.fallback_events(store, sort_by="created_at").count() == 2


def test_inserts_leave_rows_alone_and_search_sees_all(spark, scratch):
    store = seeded_store(spark, scratch)
    again = store.read("ingestion_runs").where("run_id = 'r1'").withColumn("status", F.lit("RUNNING"))
    store.insert("ingestion_runs", again, seq=9)
    assert {r["run_id"]: r["status"] for r in api.runs(store).collect()}["r1"] == "COMPLETED"
    assert [r["run_id"] for r in api.runs(store, limit=1, q="completed").collect()] == ["r1"]
    assert [r["run_id"] for r in api.runs(store, limit=2, sort_by="run_id").collect()] == ["r1", "r2"]
    assert [r["table_name"] for r in api.checkpoints(store, sort_by="last_id").collect()] == ["GenreSchema", "GameSchema"]
