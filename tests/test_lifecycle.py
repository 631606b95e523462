"""Run-level decisions: replay before incremental (T6), event claims and
failures (M6, T7), run start (M1)."""

from pyspark.sql import functions as F

from tidemark.contracts import registry_frame
from tidemark.operators import merge
from tidemark.plans import ingest

def now():
    return F.lit("2024-06-01 00:00:00").cast("timestamp_ntz")


def src(spark):
    return spark.createDataFrame([("GenreSchema", i, 1577836800 + i) for i in range(10)],
                                 "table_name string, id long, updated_at long")


def cps(spark):
    return spark.createDataFrame([("GenreSchema", 1577836805, 0, 3, "RAW", 0, False)],
                                 "table_name string, current_watermark long, fallback_watermark long, last_id long, "
                                 "layer string, offset_val int, is_override_active boolean")


def events(spark, rows):
    return spark.createDataFrame(rows, "event_id string, table_name string, layer string, start_watermark long, "
                                       "end_watermark long, status string")


def test_pending_known_event_means_replay_first(spark):
    ev = events(spark, [("e1", "GenreSchema", "RAW", 1577836800, 1577836802, "PENDING")])
    plan = ingest.plan_run(src(spark), registry_frame(spark), cps(spark), ev)
    assert plan["mode"] == "replay"
    assert {r["event_id"]: r["records_processed"] for r in plan["counts"].collect()} == {"e1": 3}


def test_unknown_or_other_layer_events_do_not_block(spark):
    ev = events(spark, [("e1", "Nope", "RAW", 0, 10, "PENDING"),
                        ("e2", "GenreSchema", "ANALYTICS", 0, 10, "PENDING"),
                        ("e3", "GenreSchema", "RAW", 0, 10, "COMPLETED")])
    plan = ingest.plan_run(src(spark), registry_frame(spark), cps(spark), ev)
    assert plan["mode"] == "incremental"
    got = {r["table_name"]: (r["current_watermark"], r["records"]) for r in plan["run"].checkpoints.collect()}
    assert got["GenreSchema"] == (1577836809, 5)     # inclusive: 805..809
    assert got["GameSchema"] == (1577836800, 0)      # seeded at its start, nothing to read


def test_claim_then_fail(spark):
    ev = events(spark, [("e1", "GenreSchema", "RAW", 0, 10, "PENDING")]) \
        .withColumn("records_processed", F.lit(0).cast("long")) \
        .withColumn("error_message", F.lit(None).cast("string")) \
        .withColumn("completed_at", F.lit(None).cast("timestamp_ntz"))
    claimed = merge.event_state_change(ev, ingest.claim_events(ev), now())
    assert claimed.first()["status"] == "IN_PROGRESS" and claimed.first()["completed_at"] is None
    failed = merge.event_state_change(claimed, ingest.fail_events(claimed, "parse error"), now()).first()
    assert (failed["status"], failed["error_message"]) == ("FAILED", "parse error")
    assert failed["completed_at"] is not None


def test_start_run_is_insert_if_absent(spark):
    runs = spark.createDataFrame([("r0", None, None, "RAW", "COMPLETED", None)],
                                 "run_id string, started_at timestamp_ntz, completed_at timestamp_ntz, layer string, "
                                 "status string, error_message string")
    once = ingest.start_run(runs, "r1", "RAW", "2024-06-01 00:00:00")
    twice = ingest.start_run(once, "r1", "RAW", "2024-06-02 00:00:00")
    rows = {r["run_id"]: r for r in twice.collect()}
    assert len(rows) == 2 and rows["r1"]["status"] == "RUNNING"
    assert str(rows["r1"]["started_at"]).startswith("2024-06-01")


def test_update_one_is_a_projection(spark):
    runs = spark.createDataFrame([("r0", "RUNNING"), ("r1", "RUNNING")], "run_id string, status string")
    batches = spark.createDataFrame([("FAILED",), ("SUCCESS",)], "status string")
    verdict = batches.agg(F.when(F.bool_or(F.col("status") == "FAILED"), "FAILED").otherwise("COMPLETED")).scalar()
    out = merge.update_one(runs, "run_id", "r1", {"status": verdict})
    assert {r["run_id"]: r["status"] for r in out.collect()} == {"r0": "RUNNING", "r1": "FAILED"}
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan
