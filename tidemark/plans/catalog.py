"""Registered queries: one Spark plan and one DuckDB oracle per operator.

Every query reads whole driver tables through ``tidemark.sources.standins``
(or data Spark derives from them); parameters such as page size, table name
or run time are plain arguments.  The oracle text builds the same stand-in
views as CTEs and computes the expected rows directly, without the engine's
shortcuts, so a match checks the operator, not just the plumbing.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.contracts import columns_frame, registry_frame, table_contract
from tidemark.functions.scalars import alert_text, empty_if_null, page_path, page_path_parts, truncate_message
from tidemark.operators import history, merge, nested, progress, quality, relations, select, versions, windows
from tidemark.operators.joins import checked_broadcast
from tidemark.plans import api, execute, ingest, load, reports
from tidemark.session import literal_frame, materialize, scratch_path
from tidemark.sources import landing, tables
from tidemark.streaming import landing_stream, late_stream
from tidemark.sources import standins as S
from tidemark.sources.standins import with_views as V

# Column names, statuses and the names of the report columns below are fixed
# values: they must equal the source system's tables and reports.
RUN_TIME = S.RUN_TIME
RUN_ID = "run-0001"

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return deco


def _now() -> F.Column:
    return F.lit(RUN_TIME).cast("timestamp_ntz")


def _registry(spark):
    return registry_frame(spark, S.source_contracts())


def _run(spark, sf):
    src = S.source_records(spark, sf)
    return ingest.plan_incremental(src, _registry(spark), S.checkpoint_seed(spark), native_time="o_orderdate")


# Oracle building blocks ------------------------------------------------------------------
_WORK = """
work AS (
    SELECT c.table_name,
           CASE WHEN s.current_watermark > 0 THEN s.current_watermark ELSE 788918400 END AS cursor,
           coalesce(s.last_id, 0) AS last_id, coalesce(s.offset_val, 0) AS offset_val,
           s.table_name IS NULL AS seeded
    FROM contracts c LEFT JOIN (SELECT * FROM seed WHERE layer = 'RAW') s USING (table_name)),
sel AS (SELECT src.*, work.cursor, work.last_id FROM src JOIN work USING (table_name)
        WHERE updated_at >= cursor)"""

_ADVANCED = _WORK + """,
hw AS (SELECT table_name, max(updated_at) AS mx, count(*) AS n FROM sel GROUP BY 1),
hwid AS (SELECT s.table_name, max(s.id) AS mid FROM sel s JOIN hw ON s.table_name = hw.table_name
         AND s.updated_at = hw.mx GROUP BY 1),
adv AS (
    SELECT w.table_name,
           CASE WHEN hw.mx IS NULL OR hw.mx < w.cursor THEN w.cursor ELSE hw.mx END AS current_watermark,
           CASE WHEN hw.mx IS NULL OR hw.mx < w.cursor THEN w.last_id
                WHEN hw.mx > w.cursor THEN hwid.mid ELSE greatest(w.last_id, hwid.mid) END AS last_id,
           0 AS offset_val, coalesce(hw.n, 0) AS records
    FROM work w LEFT JOIN hw USING (table_name) LEFT JOIN hwid USING (table_name))"""


# =========================================================================================
# Selection and progress
# =========================================================================================
@register("advance_checkpoints", V("src", "seed", "contracts") + ", " + _ADVANCED.lstrip() + """
SELECT table_name, current_watermark, last_id, offset_val, records FROM adv""")
def q_advance_checkpoints(spark, sf):
    """The flagship: one incremental run's new
    checkpoints."""
    return _run(spark, sf).checkpoints


@register("high_watermark", V("src") + """
, m AS (SELECT table_name, max(updated_at) AS mx, count(*) AS n FROM src GROUP BY 1)
SELECT s.table_name, m.mx AS max_updated_at, max(s.id) AS last_id, m.n AS records
FROM src s JOIN m ON s.table_name = m.table_name AND s.updated_at = m.mx
GROUP BY s.table_name, m.mx, m.n""")
def q_high_watermark(spark, sf):
    """A4 + A5 over whole source tables."""
    return progress.high_watermark(S.source_records(spark, sf))


@register("work_items", V("src", "seed", "contracts") + ", " + _WORK.lstrip() + """
SELECT w.table_name, w.cursor, w.last_id, w.offset_val, w.seeded,
       (SELECT count(*) FROM sel WHERE sel.table_name = w.table_name) AS rows_to_read
FROM work w""")
def q_work_items(spark, sf):
    """Seeded and stored checkpoints resolved to cursors, with
    the number of source rows each will read."""
    reg = _registry(spark)
    seed = S.checkpoint_seed(spark)
    work = select.work_items(reg, seed)
    unseeded = select.unseeded_tables(reg, seed).select("table_name", F.lit(True).alias("seeded"))
    chosen = select.incremental_select(S.source_records(spark, sf), work, native_time="o_orderdate")
    counts = chosen.groupBy("table_name").agg(F.count(F.lit(1)).alias("rows_to_read"))
    return (work.join(unseeded, "table_name", "left").join(counts, "table_name", "left")
                .select("table_name", "cursor", "last_id", "offset_val",
                        F.coalesce("seeded", F.lit(False)).alias("seeded"),
                        F.coalesce("rows_to_read", F.lit(0)).cast("long").alias("rows_to_read")))


@register("incremental_select", V("src", "seed", "contracts") + ", " + _WORK.lstrip() + """
SELECT table_name, id, updated_at, cursor FROM sel""")
def q_incremental_select(spark, sf):
    """Every source row at or after its table's cursor."""
    return _run(spark, sf).selected.select("table_name", "id", "updated_at", "cursor")


_PAGES_CTE = _WORK + """,
num AS (SELECT table_name, id, updated_at,
               row_number() OVER (PARTITION BY table_name ORDER BY updated_at, id) AS rn FROM sel),
pg AS (SELECT *, (rn - 1) // {size} AS page_no FROM num),
pages AS (
    SELECT table_name, page_no, (page_no * {size}) // {wrap} AS block_no,
           CAST((page_no * {size}) % {wrap} AS INTEGER) AS offset_value, count(*) AS records,
           arg_min(id, rn) AS first_id, arg_max(id, rn) AS page_last_id, max(updated_at) AS page_max_updated_at
    FROM pg GROUP BY table_name, page_no),
blocks AS (SELECT table_name, block_no + 1 AS block_no, max(page_max_updated_at) AS bmax
           FROM pages GROUP BY table_name, block_no),
run AS (
    SELECT p.*, max({{'ts': page_max_updated_at, 'id': page_last_id}}) OVER (
               PARTITION BY p.table_name ORDER BY page_no ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS rmax,
           w.cursor, w.last_id, b.bmax
    FROM pages p JOIN work w USING (table_name) LEFT JOIN blocks b USING (table_name, block_no)),
out AS (
    SELECT table_name, page_no, block_no, offset_value, coalesce(bmax, cursor) AS cursor_value, records,
           first_id, page_last_id, page_max_updated_at,
           struct_extract(greatest(rmax, {{'ts': cursor, 'id': last_id}}), 'ts') AS running_watermark,
           struct_extract(greatest(rmax, {{'ts': cursor, 'id': last_id}}), 'id') AS running_last_id,
           records < {size} AS is_last
    FROM run),
tot AS (SELECT w.table_name, w.cursor, w.last_id, count(sel.id) AS total
        FROM work w LEFT JOIN sel USING (table_name) GROUP BY 1, 2, 3),
term AS (
    SELECT t.table_name, t.total // {size} AS page_no, (t.total // {size}) * {size} // {wrap} AS block_no,
           CAST(((t.total // {size}) * {size}) % {wrap} AS INTEGER) AS offset_value,
           CASE WHEN ((t.total // {size}) * {size}) % {wrap} = 0 AND t.total > 0 THEN o.running_watermark
                ELSE coalesce(o.cursor_value, t.cursor) END AS cursor_value,
           0 AS records, CAST(NULL AS BIGINT) AS first_id, CAST(NULL AS BIGINT) AS page_last_id,
           CAST(NULL AS BIGINT) AS page_max_updated_at,
           coalesce(o.running_watermark, t.cursor) AS running_watermark,
           coalesce(o.running_last_id, t.last_id) AS running_last_id, TRUE AS is_last
    FROM tot t LEFT JOIN out o ON o.table_name = t.table_name AND o.page_no = t.total // {size} - 1
    WHERE t.total % {size} = 0)"""

_PAGES_SQL = _PAGES_CTE + """
SELECT * FROM out UNION ALL SELECT * FROM term"""


@register("page_summary", V("src", "seed", "contracts") + ", " + _PAGES_SQL.format(size=100, wrap=1000).lstrip())
def q_page_summary(spark, sf):
    """Pages of 100 with an offset wrap at 1000: records,
    first / last key, block cursor, running watermark and last id."""
    return ingest.run_pages(_run(spark, sf), page_size=100, wrap=1000)


@register("page_summary_full_size", V("src", "seed", "contracts") + ", " + _PAGES_SQL.format(size=500, wrap=10000).lstrip())
def q_page_summary_full_size(spark, sf):
    """The same with the source system's sizes: pages of 500, wrap at
    10,000."""
    return ingest.run_pages(_run(spark, sf))


@register("cursor_advance", V("src") + """
, num AS (SELECT table_name, updated_at,
                 row_number() OVER (PARTITION BY table_name ORDER BY updated_at, id) AS rn FROM src)
SELECT table_name, (rn - 1) // 1000 AS block_no, count(*) AS records, max(updated_at) AS block_max_updated_at,
       max(updated_at) AS next_cursor
FROM num GROUP BY 1, 2""")
def q_cursor_advance(spark, sf):
    """Blocks of 1,000 rows per table and the cursor each hands on."""
    keys = S.source_records(spark, sf).select("table_name", "id", "updated_at")   # the row index moves these only
    return progress.cursor_advance(progress.assign_pages(keys, page_size=100, wrap=1000))


@register("page_query", V("src") + """
SELECT id, name, updated_at, o_custkey, o_totalprice FROM src
WHERE table_name = '3-MEDIUM' AND updated_at >= 820454400 AND (o_totalprice > 100000)
ORDER BY updated_at, id LIMIT 500 OFFSET 500""")
def q_page_query(spark, sf):
    """The second page of 500 of one table from a watermark
    (1996-01-01) with an extra filter."""
    c = S.source_contracts()["3-MEDIUM"]
    src = S.source_records(spark, sf).where(F.col("table_name") == "3-MEDIUM")
    return select.page_query(src, contract=c, last_update_value=820454400, filters="o_totalprice > 100000",
                             limit=5000, offset=500, native_time="o_orderdate")


# =========================================================================================
# Replay
# =========================================================================================
@register("replay_counts", V("src", "windows") + """
SELECT w.event_id, w.table_name, w.start_watermark, w.end_watermark, count(s.id) AS records_processed
FROM windows w LEFT JOIN src s ON s.table_name = w.table_name
     AND s.updated_at BETWEEN w.start_watermark AND w.end_watermark
GROUP BY 1, 2, 3, 4""")
def q_replay_counts(spark, sf):
    """Records per replay window (closed interval), zero for
    empty windows and unknown tables."""
    return select.replay_counts(S.source_records(spark, sf), S.replay_windows(spark, sf))


@register("replay_rows", V("src", "windows", "contracts") + """
SELECT w.event_id, s.table_name, s.id, s.updated_at
FROM windows w JOIN src s ON s.table_name = w.table_name
     AND s.updated_at BETWEEN w.start_watermark AND w.end_watermark
WHERE w.status = 'PENDING' AND w.layer = 'RAW' AND w.table_name IN (SELECT table_name FROM contracts)""")
def q_replay_rows(spark, sf):
    """3.2: pending events with a contract, every source row of each
    window (two events over one table both replay)."""
    plan = ingest.plan_replay(S.source_records(spark, sf), S.replay_windows(spark, sf), _registry(spark))
    return plan["rows"].select("event_id", "table_name", "id", "updated_at")


@register("replay_overlaps", V("src", "queue", "contracts") + f"""
SELECT q.event_id, q.table_name, q.start_watermark, q.end_watermark,
       count(s.id) AS records_processed,
       (SELECT count(*) FROM src x WHERE EXISTS (SELECT 1 FROM queue e WHERE e.table_name = x.table_name
          AND x.updated_at BETWEEN e.start_watermark AND e.end_watermark)) AS landed
FROM queue q JOIN contracts USING (table_name) LEFT JOIN src s ON s.table_name = q.table_name
     AND s.updated_at BETWEEN q.start_watermark AND q.end_watermark
GROUP BY ALL""")
def q_replay_overlaps(spark, sf):
    """An event per order, each a window of a week, so that windows
    overlap everywhere: records landed once, records per window."""
    known = select.known_events(S.event_queue(spark, sf), _registry(spark))
    out = windows.replay_overlaps(S.source_records(spark, sf).select("table_name", "id", "updated_at"), known)
    return out.counts.withColumn("landed", out.landed.agg(F.count(F.lit(1))).scalar())


@register("known_events", V("queue", "contracts") + """
SELECT event_id, table_name, status FROM queue WHERE table_name IN (SELECT table_name FROM contracts)""")
def q_known_events(spark, sf):
    """Queued replay events whose table has a contract."""
    return select.known_events(S.event_queue(spark, sf), _registry(spark)).select("event_id", "table_name",
                                                                                   "status")


@register("unknown_events", V("queue", "contracts") + """
SELECT event_id, table_name, status FROM queue
WHERE table_name NOT IN (SELECT table_name FROM contracts)""")
def q_unknown_events(spark, sf):
    """Queued events naming a table with no contract; they stay as
    they are and are reported."""
    return select.unknown_events(S.event_queue(spark, sf), _registry(spark)).select("event_id", "table_name",
                                                                                     "status")


@register("event_state_change", V("src", "windows", "contracts") + f"""
, cnt AS (SELECT w.event_id, count(s.id) AS n FROM windows w
          LEFT JOIN src s ON s.table_name = w.table_name AND s.updated_at BETWEEN w.start_watermark AND w.end_watermark
          WHERE w.table_name IN (SELECT table_name FROM contracts) GROUP BY 1)
SELECT w.event_id, coalesce(CASE WHEN cnt.event_id IS NOT NULL THEN 'COMPLETED' END, w.status) AS status,
       CAST(w.records_processed + coalesce(cnt.n, 0) AS BIGINT) AS records_processed,
       CASE WHEN cnt.event_id IS NOT NULL THEN NULL ELSE w.error_message END AS error_message,
       CASE WHEN cnt.event_id IS NOT NULL THEN TIMESTAMP '{RUN_TIME}' ELSE w.completed_at END AS completed_at
FROM windows w LEFT JOIN cnt USING (event_id)""")
def q_event_state_change(spark, sf):
    """Replayed events become COMPLETED with their count added
    and an end time; unknown-table events are left as they are."""
    windows = S.replay_windows(spark, sf)
    plan = ingest.plan_replay(S.source_records(spark, sf), windows, _registry(spark))
    changes = plan["counts"].select("event_id", F.lit("COMPLETED").alias("status"),
                                    F.col("records_processed"), F.lit(None).cast("string").alias("error_message"))
    out = merge.event_state_change(windows, changes, _now())
    return out.select("event_id", "status", "records_processed", "error_message", "completed_at")


# =========================================================================================
# Reports
# =========================================================================================
@register("success_ratio", V("runs") + """
SELECT count(*) AS total_runs, count(*) FILTER (WHERE status = 'COMPLETED') AS successful_runs,
       count(*) FILTER (WHERE status = 'FAILED') AS failed_runs,
       round(count(*) FILTER (WHERE status = 'COMPLETED') / nullif(count(*), 0), 6) AS success_ratio,
       round(count(*) FILTER (WHERE status = 'FAILED') / nullif(count(*), 0), 6) AS failure_ratio
FROM runs""")
def q_success_ratio(spark, sf):
    """A10."""
    return reports.success_ratio(S.runs(spark, sf))


@register("run_status_rollup", V("batches") + """
SELECT run_id, count(*) AS batches, count(*) FILTER (WHERE status = 'FAILED') AS failed_batches,
       CASE WHEN bool_or(status = 'FAILED') THEN 'FAILED' ELSE 'COMPLETED' END AS run_status
FROM batches GROUP BY run_id""")
def q_run_status_rollup(spark, sf):
    """A9."""
    return reports.run_status_rollup(S.batches(spark, sf))


@register("run_durations", V("runs") + """
SELECT run_id, started_at, completed_at, layer, status, error_message,
       CAST(round(epoch(completed_at) - epoch(started_at)) AS INTEGER) AS duration_seconds
FROM runs ORDER BY started_at DESC, run_id LIMIT 50""")
def q_run_durations(spark, sf):
    """L1 + F1: the 50 latest runs with their duration (null while
    running)."""
    return reports.runs_history(S.runs(spark, sf), 50)


_BATCH_TIES = ("batch_id", "run_id", "status", "cursor_value", "offset_value", "records_count", "duration_ms",
               "error_message")


@register("recent_batches", V("batches") + """
SELECT batch_id, run_id, table_name, layer, status, cursor_value, offset_value, records_count, duration_ms,
       query_sent, error_message, created_at
FROM batches ORDER BY created_at DESC, batch_id, run_id, status, cursor_value, offset_value, records_count,
     duration_ms, error_message LIMIT 100""")
def q_recent_batches(spark, sf):
    """L2 without a table (P8 unset)."""
    return reports.recent_batches(S.batches(spark, sf), 100, None, tie_break=_BATCH_TIES)


@register("recent_batches_table", V("batches") + """
SELECT batch_id, run_id, table_name, layer, status, cursor_value, offset_value, records_count, duration_ms,
       query_sent, error_message, created_at
FROM batches WHERE table_name = 'R'
ORDER BY created_at DESC, batch_id, run_id, status, cursor_value, offset_value, records_count,
     duration_ms, error_message LIMIT 100""")
def q_recent_batches_table(spark, sf):
    """L2 + P8 with a table."""
    return reports.recent_batches(S.batches(spark, sf), 100, "R", tie_break=_BATCH_TIES)


@register("pending_events", V("queue") + """
SELECT event_id, table_name, layer, start_watermark, end_watermark, status, created_at,
       row_number() OVER (ORDER BY created_at, event_id) AS fifo_position
FROM queue WHERE status = 'PENDING' AND layer = 'RAW'""")
def q_pending_events(spark, sf):
    """P7 + W5: the FIFO queue of one layer with positions."""
    return reports.pending_queue(S.event_queue(spark, sf), "RAW").select(
        "event_id", "table_name", "layer", "start_watermark", "end_watermark", "status", "created_at",
        "fifo_position")


@register("event_history", V("queue") + """
SELECT event_id, table_name, layer, start_watermark, end_watermark, status, records_processed,
       error_message, created_at, completed_at
FROM queue ORDER BY created_at DESC, event_id LIMIT 50""")
def q_event_history(spark, sf):
    """L3."""
    return reports.event_history(S.event_queue(spark, sf), 50)


_CHECKPOINT_TABLE = _ADVANCED + """,
stored AS (SELECT table_name, current_watermark, fallback_watermark, last_id, layer, offset_val,
                  is_override_active FROM seed),
merged AS (
    SELECT coalesce(a.table_name, s.table_name) AS table_name,
           coalesce(a.current_watermark, s.current_watermark) AS current_watermark,
           CASE WHEN a.table_name IS NOT NULL THEN a.current_watermark ELSE s.fallback_watermark END
               AS fallback_watermark,
           coalesce(a.last_id, s.last_id) AS last_id,
           CASE WHEN a.table_name IS NOT NULL THEN 'RAW' ELSE s.layer END AS layer,
           CASE WHEN a.table_name IS NOT NULL THEN CAST(a.offset_val AS INTEGER) ELSE s.offset_val END AS offset_val,
           CASE WHEN a.table_name IS NOT NULL THEN FALSE ELSE s.is_override_active END AS is_override_active,
           CASE WHEN a.table_name IS NOT NULL THEN '{run}' END AS last_successful_run_id,
           CASE WHEN a.table_name IS NOT NULL THEN TIMESTAMP '{now}' END AS updated_at
    FROM adv a FULL OUTER JOIN stored s USING (table_name))""".format(run=RUN_ID, now=RUN_TIME)


def _checkpoint_table(spark, sf) -> DataFrame:
    """Stored checkpoints after the run: M5 upsert of the advanced
    checkpoints (current watermark, last id, layer, offset, run, override
    off, time) and M5b (the safety watermark := the new watermark)."""
    run = _run(spark, sf)
    stored = S.checkpoint_seed(spark).withColumn("last_successful_run_id", F.lit(None).cast("string")) \
        .withColumn("updated_at", F.lit(None).cast("timestamp_ntz"))
    incoming = run.checkpoints.select(
        "table_name", "current_watermark", "last_id", F.lit("RAW").alias("layer"), "offset_val",
        F.lit(RUN_ID).alias("last_successful_run_id"), F.lit(False).alias("is_override_active"),
        _now().alias("updated_at"))
    cols = ["current_watermark", "last_id", "layer", "offset_val", "last_successful_run_id",
            "is_override_active", "updated_at"]
    out = merge.upsert_columns(stored, incoming, "table_name", cols,
                               defaults={"fallback_watermark": F.lit(0)})
    safety = run.checkpoints.select("table_name", F.col("current_watermark").alias("fallback_watermark"))
    return merge.upsert_columns(out, safety, "table_name", ["fallback_watermark"])


@register("checkpoint_list", V("src", "seed", "contracts") + ", " + _CHECKPOINT_TABLE.lstrip() + """
SELECT * FROM merged WHERE layer = 'RAW' ORDER BY table_name""")
def q_checkpoint_list(spark, sf):
    """L4 + P6 over the checkpoint table written by M5 / M5b."""
    return reports.checkpoint_list(_checkpoint_table(spark, sf), "RAW")


@register("override_checkpoint", V("src", "seed", "contracts") + ", " + _CHECKPOINT_TABLE.lstrip() + f"""
, req AS (SELECT * FROM (VALUES ('1-URGENT', 900000000::BIGINT, TRUE), ('3-MEDIUM', NULL::BIGINT, TRUE),
                                ('5-LOW', NULL::BIGINT, FALSE), ('NO_SUCH_TABLE', 5::BIGINT, TRUE))
             AS t(table_name, custom_watermark, activate_fallback))
SELECT m.table_name, m.current_watermark,
       CASE WHEN r.table_name IS NULL THEN m.fallback_watermark
            ELSE coalesce(r.custom_watermark, m.fallback_watermark) END AS fallback_watermark,
       CASE WHEN r.table_name IS NULL THEN m.is_override_active ELSE r.activate_fallback END AS is_override_active,
       CASE WHEN r.table_name IS NULL THEN m.updated_at ELSE TIMESTAMP '{RUN_TIME}' END AS updated_at,
       r.table_name IS NOT NULL AS matched
FROM merged m LEFT JOIN req r USING (table_name)""")
def q_override_checkpoint(spark, sf):
    """Override requests on the checkpoint table; an unknown table
    matches nothing."""
    cps = _checkpoint_table(spark, sf)
    req = literal_frame(
        spark, [("1-URGENT", 900000000, True), ("3-MEDIUM", None, True), ("5-LOW", None, False),
                ("NO_SUCH_TABLE", 5, True)], "table_name string, custom_watermark bigint, activate_fallback boolean")
    out = merge.override_checkpoint(cps, req, _now())
    hit = merge.matched_keys(cps, req, "table_name").withColumn("matched", F.lit(True))
    return (out.join(hit, "table_name", "left")
               .select("table_name", "current_watermark", "fallback_watermark", "is_override_active", "updated_at",
                       F.coalesce("matched", F.lit(False)).alias("matched")))


# =========================================================================================
# Referential and uniqueness checks
# =========================================================================================
@register("orphan_batches", V("runs", "batches") + """
SELECT batch_id, run_id FROM batches WHERE run_id IS NOT NULL AND run_id NOT IN (SELECT run_id FROM runs)""")
def q_orphan_batches(spark, sf):
    """Batch rows pointing at no run."""
    return quality.orphans(S.batches(spark, sf), S.runs(spark, sf), "run_id").select("batch_id", "run_id")


@register("runs_without_batches", V("runs", "batches") + """
SELECT run_id, status FROM runs WHERE run_id NOT IN (SELECT run_id FROM batches)""")
def q_runs_without_batches(spark, sf):
    """J5 the other way: runs that logged no batch."""
    return quality.orphans(S.runs(spark, sf), S.batches(spark, sf), "run_id").select("run_id", "status")


@register("duplicate_keys", """
SELECT l_orderkey, l_linenumber, count(*) AS occurrences FROM lineitem
GROUP BY 1, 2 HAVING count(*) > 1""")
def q_duplicate_keys(spark, sf):
    """Q3: keys that are not unique."""
    return quality.duplicate_keys(S.read(spark, sf, "lineitem"), ["l_orderkey", "l_linenumber"])


# =========================================================================================
# Merges
# =========================================================================================
@register("latest_per_key", """
SELECT user_id, event_id, ts, event_type, value FROM (
    SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rn FROM events)
WHERE rn = 1""")
def q_latest_per_key(spark, sf):
    """The latest event per user."""
    ev = S.read(spark, sf, "events").select("user_id", "event_id", "ts", "event_type", "value")
    return merge.latest_per_key(ev, "user_id", ["ts", "event_id"])


@register("upsert_idempotent", """
SELECT user_id, event_id, ts, event_type, value FROM (
    SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rn FROM events)
WHERE rn = 1""")
def q_upsert_idempotent(spark, sf):
    """M8 R2: a target loaded up to mid-January, then the batch from the
    15th applied twice (one day of overlap): the same table as one load."""
    ev = S.read(spark, sf, "events").select("user_id", "event_id", "ts", "event_type", "value")
    mid = F.lit("2024-01-16 00:00:00").cast("timestamp_ntz")
    overlap = F.lit("2024-01-15 00:00:00").cast("timestamp_ntz")
    target = merge.latest_per_key(ev.where(F.col("ts") < mid), "user_id", ["ts", "event_id"])
    batch = ev.where(F.col("ts") >= overlap)
    once = merge.upsert_latest(target, batch, "user_id", "ts")
    return merge.upsert_latest(once, batch, "user_id", "ts")


_CUST_OLD = "c_mktsegment IN ('AUTOMOBILE', 'BUILDING', 'FURNITURE')"
_CUST_NEW = "c_mktsegment IN ('FURNITURE', 'HOUSEHOLD', 'MACHINERY')"


@register("insert_if_absent", f"""
SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment FROM customer WHERE {_CUST_OLD}
UNION ALL
SELECT c_custkey, 'new ' || c_name AS c_name, c_nationkey, c_acctbal, c_mktsegment FROM customer
WHERE {_CUST_NEW} AND NOT ({_CUST_OLD})""")
def q_insert_if_absent(spark, sf):
    """M1 / M4: customers of three segments, then an insert of three
    segments (one shared): shared keys keep the stored row."""
    c = S.read(spark, sf, "customer").select("c_custkey", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment")
    target = c.where(_CUST_OLD)
    new = c.where(_CUST_NEW).withColumn("c_name", F.concat(F.lit("new "), F.col("c_name")))
    return merge.insert_if_absent(target, new, "c_custkey")


@register("column_upsert", f"""
SELECT c_custkey, CASE WHEN {_CUST_OLD} THEN c_name ELSE 'unknown' END AS c_name, c_nationkey,
       CASE WHEN {_CUST_NEW} THEN c_acctbal + 100 ELSE c_acctbal END AS c_acctbal, c_mktsegment
FROM customer""")
def q_column_upsert(spark, sf):
    """M5: upsert of the listed columns only; the name of stored rows
    survives, new rows get the default."""
    c = S.read(spark, sf, "customer").select("c_custkey", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment")
    target = c.where(_CUST_OLD)
    incoming = c.where(_CUST_NEW).withColumn("c_acctbal", F.col("c_acctbal") + 100)
    return merge.upsert_columns(target, incoming, "c_custkey", ["c_nationkey", "c_acctbal", "c_mktsegment"],
                                defaults={"c_name": F.lit("unknown")})


@register("keyed_update", """
WITH failed AS (SELECT o_custkey, count(*) AS n FROM orders WHERE o_orderstatus = 'F' GROUP BY 1)
SELECT c_custkey, c_name, c_nationkey,
       CASE WHEN f.o_custkey IS NULL THEN c_acctbal ELSE c_acctbal - f.n * 10.0 END AS c_acctbal,
       CASE WHEN f.o_custkey IS NULL THEN c_mktsegment ELSE 'FLAGGED' END AS c_mktsegment
FROM customer c LEFT JOIN failed f ON c.c_custkey = f.o_custkey""")
def q_keyed_update(spark, sf):
    """M2: customers with failed orders get flagged and charged; updates
    for keys that are not customers change nothing."""
    c = S.read(spark, sf, "customer").select("c_custkey", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment")
    failed = (S.read(spark, sf, "orders").where(F.col("o_orderstatus") == "F").groupBy("o_custkey")
              .agg(F.count(F.lit(1)).alias("n")).withColumnRenamed("o_custkey", "c_custkey"))
    return merge.keyed_update(c, failed, "c_custkey", {
        "c_acctbal": F.col("c_acctbal") - F.col("u__n") * 10.0,
        "c_mktsegment": F.lit("FLAGGED"),
    })


@register("run_completion", V("runs", "batches") + f"""
, roll AS (SELECT run_id, bool_or(status = 'FAILED') AS failed FROM batches GROUP BY 1)
SELECT r.run_id, CASE WHEN roll.run_id IS NULL THEN r.status WHEN roll.failed THEN 'FAILED' ELSE 'COMPLETED' END
           AS status,
       CASE WHEN roll.run_id IS NULL THEN r.error_message END AS error_message,
       CASE WHEN roll.run_id IS NULL THEN r.completed_at ELSE TIMESTAMP '{RUN_TIME}' END AS completed_at
FROM runs r LEFT JOIN roll USING (run_id)""")
def q_run_completion(spark, sf):
    """M2 + A9: close each run with the roll-up of its batches."""
    rl = reports.run_status_rollup(S.batches(spark, sf)).select(
        "run_id", F.col("run_status").alias("status"), F.lit(None).cast("string").alias("error_message"))
    out = merge.run_completion(S.runs(spark, sf), rl, _now())
    return out.select("run_id", "status", "error_message", "completed_at")


@register("quick_replay_events", V("src", "seed", "contracts") + ", " + _ADVANCED.lstrip() + f"""
SELECT substr(h, 1, 8) || '-' || substr(h, 9, 4) || '-' || substr(h, 13, 4) || '-' || substr(h, 17, 4) || '-'
           || substr(h, 21, 12) AS event_id, table_name, layer, start_watermark, end_watermark, status,
       records_processed, created_at
FROM (SELECT sha256(table_name || chr(1) || CAST(current_watermark - 2592000 AS VARCHAR) || chr(1)
                    || CAST(current_watermark AS VARCHAR) || chr(1) || '{RUN_TIME}') AS h,
             table_name, 'RAW' AS layer, current_watermark - 2592000 AS start_watermark,
       current_watermark AS end_watermark, 'PENDING' AS status, CAST(0 AS BIGINT) AS records_processed,
       TIMESTAMP '{RUN_TIME}' AS created_at
      FROM adv)""")
def q_quick_replay_events(spark, sf):
    """One new PENDING replay event per checkpoint covering its last
    30 days (the dashboard's quick-replay button); the id is derived from
    the request, so submitting it twice creates one event."""
    cps = _run(spark, sf).checkpoints
    req = cps.select("table_name", F.lit("RAW").alias("layer"),
                     (F.col("current_watermark") - 2592000).alias("start_watermark"),
                     F.col("current_watermark").alias("end_watermark"))
    ev = merge.new_events(req, _now(), ["table_name", "start_watermark", "end_watermark"])
    return ev.select("event_id", "table_name", "layer", "start_watermark", "end_watermark", "status", "records_processed",
                     "created_at")


# =========================================================================================
# Quality and drift
# =========================================================================================
_ISSUE_SQL = """CASE WHEN o_orderstatus = 'P' THEN 'wrong_type'
                     WHEN o_orderstatus = 'F' AND table_name = '4-NOT SPECIFIED' THEN 'missing_name' END"""


def _flagged(spark, sf):
    contracts = S.source_contracts()
    raw = S.raw_records(spark, sf)
    c = next(iter(contracts.values()))  # the five stand-in contracts share one field list
    return quality.flag_records(quality.parse_records(raw.drop("id"), c), c)


@register("quarantine_split", V("src") + f"""
SELECT table_name, coalesce({_ISSUE_SQL}, 'good') AS outcome, count(*) AS records
FROM src GROUP BY 1, 2""")
def q_quarantine_split(spark, sf):
    """Q2 Q4: every record is good or quarantined, per table and issue."""
    f = _flagged(spark, sf)
    return (f.groupBy("table_name", F.coalesce("quality_issue", F.lit("good")).alias("outcome"))
             .agg(F.count(F.lit(1)).alias("records")))


@register("required_keys", V("src") + f"""
SELECT table_name, count(*) AS records, 0::BIGINT AS bad_records, false AS table_fails FROM src GROUP BY 1""")
def q_required_keys(spark, sf):
    """Q1: per table the source system's verdict: a record without ``id`` or
    ``updated_at`` fails the table.  The stand-in's records all carry both
    (some with a wrong type, some without ``name``): those are quarantined,
    and no table fails."""
    return quality.table_failures(_flagged(spark, sf))


@register("missing_keys", V("src") + """
SELECT table_name, count(*) AS records, count(*) FILTER (WHERE o_custkey % 97 = 0 OR o_totalprice > 400000) AS bad_records,
       count(*) FILTER (WHERE o_custkey % 97 = 0 OR o_totalprice > 400000) > 0 AS table_fails
FROM src GROUP BY 1""")
def q_missing_keys(spark, sf):
    """Q1 where keys are missing: records of some customers come without
    ``id``, those of the largest orders without ``updated_at``."""
    r = S.source_records(spark, sf)
    raw = r.select("table_name", F.to_json(F.struct(
        F.when(F.col("o_custkey") % 97 != 0, F.col("id")).alias("id"), "name",
        F.when(F.col("o_totalprice") <= 400000, F.col("updated_at")).alias("updated_at"), "o_custkey", "o_totalprice")).alias("raw"))
    c = next(iter(S.source_contracts().values()))
    return quality.table_failures(quality.flag_records(quality.parse_records(raw, c), c))


@register("good_records", V("src") + f"""
SELECT table_name, id, name, updated_at, o_custkey, o_totalprice FROM src WHERE {_ISSUE_SQL} IS NULL""")
def q_good_records(spark, sf):
    """Q4 good side, projected to the contract."""
    contracts = S.source_contracts()
    c = next(iter(contracts.values()))
    good, _ = quality.split_good_quarantine(_flagged(spark, sf), c)
    return good.select("table_name", "id", "name", "updated_at", "o_custkey", "o_totalprice")


_KEYS_SQL = """
, kv AS (
    SELECT table_name, 'id' AS column_name, 'integer' AS data_type FROM src
    UNION ALL SELECT table_name, 'name', 'string' FROM src
        WHERE NOT (o_orderstatus = 'F' AND table_name = '4-NOT SPECIFIED')
    UNION ALL SELECT table_name, 'updated_at', CASE WHEN o_orderstatus = 'P' THEN 'string' ELSE 'integer' END FROM src
    UNION ALL SELECT table_name, 'o_custkey', 'integer' FROM src
    UNION ALL SELECT table_name, 'o_totalprice', 'number' FROM src
    UNION ALL SELECT table_name, 'rush', 'boolean' FROM src WHERE table_name = '1-URGENT' AND o_totalprice > 300000)"""


@register("observed_columns", V("src") + _KEYS_SQL + """
SELECT table_name, column_name, data_type, count(*) AS records FROM kv GROUP BY 1, 2, 3""")
def q_observed_columns(spark, sf):
    """U1 input: every key of the raw records with its JSON type."""
    return quality.observed_keys(S.raw_records(spark, sf))


@register("new_columns", V("src") + _KEYS_SQL + """
SELECT table_name, column_name, data_type, count(*) AS records FROM kv
WHERE column_name NOT IN ('id', 'name', 'updated_at', 'o_custkey', 'o_totalprice') GROUP BY 1, 2, 3""")
def q_new_columns(spark, sf):
    """Undeclared keys per table."""
    return quality.new_columns(quality.observed_keys(S.raw_records(spark, sf)), _registry(spark))


@register("schema_snapshot", V("src") + _KEYS_SQL + """
, cols AS (SELECT DISTINCT table_name, column_name FROM kv)
SELECT table_name, string_agg(column_name, ',' ORDER BY column_name) AS column_list,
       sha256(string_agg(column_name, ' ' ORDER BY column_name)) AS schema_hash, count(*) AS n_columns
FROM cols GROUP BY 1""")
def q_schema_snapshot(spark, sf):
    """One snapshot per table, hashed over its sorted names."""
    snaps = quality.schema_snapshots(quality.observed_keys(S.raw_records(spark, sf)))
    return snaps.select("table_name", F.array_join("columns", ",").alias("column_list"), "schema_hash",
                        F.size("columns").cast("long").alias("n_columns"))


_DRIFT_SQL = """
, typ AS (SELECT table_name, column_name, string_agg(DISTINCT data_type, '|' ORDER BY data_type) AS data_type,
                 bool_or(column_name = 'updated_at' AND data_type = 'string') AS retyped,
                 bool_or(column_name NOT IN ('id', 'name', 'updated_at', 'o_custkey', 'o_totalprice')) AS added
          FROM kv GROUP BY 1, 2),
drift AS (
  SELECT table_name, sha256(string_agg(column_name || ':' || data_type, ' ' ORDER BY column_name)) AS schema_hash,
         list(column_name ORDER BY column_name) FILTER (WHERE retyped OR added) AS changed,
         CASE WHEN bool_or(retyped) THEN 'QUARANTINE' ELSE 'NEW_COLUMN' END AS status,
         CASE WHEN bool_or(retyped) THEN 'records set aside' ELSE 'logged, load went on' END AS action_taken
  FROM typ GROUP BY 1 HAVING bool_or(retyped OR added))"""


def _drift(spark, sf, run_id=RUN_ID):
    """schema_history rows detected in the raw records (one scan)."""
    observed = materialize(quality.observed_keys(S.raw_records(spark, sf)))
    return quality.drift_rows(observed, _registry(spark), columns_frame(spark, S.source_contracts()),
                              run_id=F.lit(run_id), detected_at=_now())


@register("drift_list", V("src") + _KEYS_SQL + _DRIFT_SQL + f"""
, one AS (SELECT table_name, status, action_taken, unnest(changed) AS column_name FROM drift)
SELECT table_name, column_name, data_type, TIMESTAMP '{RUN_TIME}' AS detected_at,
       '{RUN_ID}' AS detected_in_run_id, CAST(NULL AS TIMESTAMP) AS included_at, status, action_taken
FROM one JOIN typ USING (table_name, column_name)""")
def q_drift_list(spark, sf):
    """Schema-history rows from the raw records (undeclared
    columns and type changes), listed one per changed column with its
    types, newest first."""
    return reports.drift_list(_drift(spark, sf)).select(
        "table_name", "column_name", "data_type", "detected_at", "detected_in_run_id", "included_at", "status",
        "action_taken")


@register("message_truncate", """
WITH m AS (SELECT p_partkey, p_name || ' | ' || p_type || ' | ' || p_brand AS msg FROM part)
SELECT p_partkey, length(msg) AS msg_len,
       CASE WHEN length(msg) > 40 THEN substr(msg, 1, 10) || chr(10) || '...' || chr(10) || right(msg, 30)
            ELSE msg END AS message
FROM m""")
def q_message_truncate(spark, sf):
    """F9 with a 40-character limit and a 10-character head."""
    p = S.read(spark, sf, "part")
    msg = F.concat_ws(" | ", "p_name", "p_type", "p_brand")
    return p.select("p_partkey", F.length(msg).cast("long").alias("msg_len"),
                    truncate_message(msg, 40, 10).alias("message"))


@register("alert_feed", V("runs", "batches", "queue", "src") + _KEYS_SQL + _DRIFT_SQL + """
, msgs AS (
    SELECT 'runs' AS source, run_id AS ref, CASE WHEN status = 'FAILED' THEN 'ERROR' ELSE 'WARNING' END AS level,
           CASE WHEN status = 'FAILED' THEN 'run ' || run_id || ' ended in failure (' || error_message || ')'
                ELSE 'run ' || run_id || ' is still open' END AS msg
    FROM runs WHERE status IN ('FAILED', 'RUNNING')
    UNION ALL
    SELECT 'batches', CAST(batch_id AS VARCHAR), 'WARNING',
           'batch of ' || table_name || ' not landed (' || error_message || ')'
    FROM batches WHERE status = 'FAILED'
    UNION ALL
    SELECT 'events', event_id, 'ERROR', 'replay of ' || table_name || ' failed' FROM queue WHERE status = 'FAILED'
    UNION ALL
    SELECT 'drift', table_name || '.' || column_name, CASE WHEN status = 'NEW_COLUMN' THEN 'INFO' ELSE 'ERROR' END,
           'column ' || column_name || ' of ' || table_name || ': ' || status
    FROM (SELECT table_name, status, unnest(changed) AS column_name FROM drift))
SELECT source, ref, level,
       '[' || level || '] ' || msg || CASE WHEN level = 'ERROR' THEN ' @everyone' ELSE '' END AS content
FROM msgs""")
def q_alert_feed(spark, sf):
    """Alerts for failed and unfinished runs, failed batches,
    failed replay events, new columns and breaking changes, as chat messages."""
    r = S.runs(spark, sf).where(F.col("status").isin("FAILED", "RUNNING"))
    runs = r.select(F.lit("runs").alias("source"), F.col("run_id").alias("ref"),
                    F.when(F.col("status") == "FAILED", "ERROR").otherwise("WARNING").alias("level"),
                    F.when(F.col("status") == "FAILED",
                           F.concat(F.lit("run "), F.col("run_id"), F.lit(" ended in failure ("), F.col("error_message"),
                                    F.lit(")")))
                     .otherwise(F.concat(F.lit("run "), F.col("run_id"), F.lit(" is still open")))
                     .alias("message"))
    b = S.batches(spark, sf).where(F.col("status") == "FAILED")
    batches = b.select(F.lit("batches").alias("source"), F.col("batch_id").cast("string").alias("ref"),
                       F.lit("WARNING").alias("level"),
                       F.concat(F.lit("batch of "), F.col("table_name"), F.lit(" not landed ("), F.col("error_message"),
                                F.lit(")")).alias("message"))
    e = S.event_queue(spark, sf).where(F.col("status") == "FAILED")
    events = e.select(F.lit("events").alias("source"), F.col("event_id").alias("ref"), F.lit("ERROR").alias("level"),
                      F.concat(F.lit("replay of "), F.col("table_name"), F.lit(" failed")).alias("message"))
    d = reports.drift_list(_drift(spark, sf))
    drift = d.select(F.lit("drift").alias("source"), F.concat_ws(".", "table_name", "column_name").alias("ref"),
                     F.when(F.col("status") == "NEW_COLUMN", "INFO").otherwise("ERROR").alias("level"),
                     F.concat(F.lit("column "), F.col("column_name"), F.lit(" of "), F.col("table_name"), F.lit(": "),
                              F.col("status")).alias("message"))
    return quality.alert_feed(runs.unionByName(batches).unionByName(events).unionByName(drift))


# =========================================================================================
# Streams, relations, search
# =========================================================================================
@register("late_rows", """
SELECT event_id, ts, user_id FROM events
WHERE ts < TIMESTAMP '2024-01-16 00:00:00'
  AND event_id NOT IN (SELECT event_id FROM events WHERE ts >= TIMESTAMP '2024-01-10 00:00:00')""")
def q_late_rows(spark, sf):
    """With the stream's watermark at Jan 16 and the target loaded from
    Jan 10, the rows before the watermark that no load has seen."""
    ev = S.read(spark, sf, "events")
    loaded = ev.where(F.col("ts") >= F.lit("2024-01-10 00:00:00").cast("timestamp_ntz"))
    out = reports.late_rows(ev, loaded, F.lit("2024-01-16 00:00:00").cast("timestamp_ntz"), key="event_id", ts="ts")
    return out.select("event_id", "ts", "user_id")


#: Arrival of the late-data stream: a quarter of the events each, some of
#: them one or two pages later.
_ARRIVAL = ("least(4, event_id * 4 // ((SELECT max(event_id) FROM events) + 1) "
            "+ CASE WHEN event_id % 10 = 0 THEN 1 ELSE 0 END + CASE WHEN event_id % 25 = 0 THEN 1 ELSE 0 END)")


def _event_pages(spark, sf) -> list[DataFrame]:
    """The events as records of a table per type, page by page."""
    ev = S.read(spark, sf, "events")
    top = ev.agg(F.max("event_id")).first()[0]
    page = F.least(F.lit(4), F.floor(F.col("event_id") * 4 / F.lit(top + 1)) + (F.col("event_id") % 10 == 0).cast("int")
                   + (F.col("event_id") % 25 == 0).cast("int"))
    rows = ev.select(F.col("event_type").alias("table_name"), F.col("event_id").alias("id"),
                     F.unix_seconds(F.col("ts").cast("timestamp")).alias("updated_at"), page.alias("page"))
    return [rows.where(F.col("page") == n).drop("page") for n in range(5)]


@register("late_stream", f"""
WITH e AS (SELECT event_type AS table_name, event_id AS id, CAST(floor(epoch(ts)) AS BIGINT) AS updated_at,
                  CAST({_ARRIVAL} AS INTEGER) AS page FROM events),
p AS (SELECT table_name, page, max(updated_at) AS top FROM e GROUP BY 1, 2),
m AS (SELECT table_name, page, max(top) OVER (PARTITION BY table_name ORDER BY page
             ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS mark FROM p),
late AS (SELECT e.* FROM e JOIN m USING (table_name, page) WHERE updated_at < mark)
SELECT table_name, id, updated_at, page AS epoch, min(updated_at) OVER w AS start_watermark,
       max(updated_at) OVER w AS end_watermark, 'PENDING' AS status
FROM late WINDOW w AS (PARTITION BY table_name, page)""")
def q_late_stream(spark, sf):
    """Events that reach a stream page by page, the stream stopped and
    started again for each: records below the mark of their table, with the
    replay window that was asked for them."""
    root = scratch_path(spark, "late")
    paths = late_stream.LatePaths(landing=f"{root}/landing", rows=f"{root}/rows", marks=f"{root}/marks",
                                  checkpoint=f"{root}/checkpoint")
    store = api.LogStore(spark, f"{root}/logs")
    for n, page in enumerate(_event_pages(spark, sf)):
        page.write.parquet(f"{paths.landing}/page-{n}")
        late_stream.run_late_stream(spark, page.schema, paths, store)
    late = late_stream.read_rows(spark, page.schema, paths, True)
    asked = store.read("fallback_events").select(
        "table_name", "start_watermark", "end_watermark", "status",
        F.unix_seconds(F.col("created_at").cast("timestamp")).cast("int").alias("epoch"))
    return late.join(asked, ["table_name", "epoch"])


@register("stream_dedupe", "SELECT event_id, ts, user_id FROM events")
def q_stream_dedupe(spark, sf):
    """R2: a stream that brings the records of Jan 19 twice, by a re-read from
    an inclusive mark, into an append-only table: every record once."""
    root = scratch_path(spark, "dedupe")
    ev = S.read(spark, sf, "events").select("event_id", F.col("ts").cast("timestamp").alias("ts"), "user_id")
    for n, part in enumerate([ev.where("ts < '2024-01-20'"), ev.where("ts >= '2024-01-19'")]):
        part.write.parquet(f"{root}/landing/page-{n}")
        stream = spark.readStream.option("recursiveFileLookup", "true").schema(ev.schema).parquet(f"{root}/landing")
        query = (landing_stream.dedupe_stream(stream, "event_id", "ts", "2 days").writeStream.trigger(availableNow=True)
                 .option("checkpointLocation", f"{root}/checkpoint").format("parquet").start(f"{root}/table"))
        query.awaitTermination()
    return spark.read.schema(ev.schema).parquet(f"{root}/table").withColumn("ts", F.col("ts").cast("timestamp_ntz"))


@register("relation_bridge", """
SELECT l_orderkey, count(l_partkey) AS n_ids, count(p.p_name) AS n_resolved,
       min(p.p_name) AS first_p_name, max(p.p_name) AS last_p_name
FROM lineitem LEFT JOIN part p ON l_partkey = p.p_partkey GROUP BY 1""")
def q_relation_bridge(spark, sf):
    """Each order's part references resolved to the part dimension."""
    li = S.read(spark, sf, "lineitem")
    return relations.resolve_refs(li, "l_orderkey", "l_partkey", S.read(spark, sf, "part"), "p_partkey", "p_name")


@register("text_search", """
SELECT p_partkey, p_name, p_brand FROM part WHERE contains(lower(p_name || ' ' || p_brand), 'red')""")
def q_text_search(spark, sf):
    """Case-insensitive search over name and brand."""
    p = S.read(spark, sf, "part").select("p_partkey", "p_name", "p_brand")
    return select.text_filter(p, ["p_name", "p_brand"], "RED")


# =========================================================================================
# Landing, loading, streaming, log tables
# =========================================================================================
def _landed(spark, sf) -> str:
    """Land the run's selection; returns the folder."""
    path = f"{scratch_path(spark, 'landing')}/run-1"
    ingest.land_run(_run(spark, sf), path, S.raw_json)
    return path


_ISSUE_SEL = _ISSUE_SQL.replace("table_name", "sel.table_name")
_GOOD_SQL = V("src", "seed", "contracts") + ", " + _WORK.lstrip() + f"""
SELECT id, name, updated_at, o_custkey, o_totalprice FROM sel WHERE ({_ISSUE_SEL}) IS NULL"""


@register("landing_roundtrip", V("src", "seed", "contracts") + ", " + _PAGES_CTE.format(size=500, wrap=10000).lstrip()
          + f"""
SELECT {S.ENDPOINT_SQL} AS endpoint, cursor_value, offset_value, records FROM out""")
def q_landing_roundtrip(spark, sf):
    """A run landed and read back record by record; records
    per page with its cursor and offset."""
    pages = landing.read_run_pages(spark, _landed(spark, sf))
    return (pages.groupBy("endpoint", "page_no", "cursor_value", "offset_value").agg(F.count(F.lit(1)).alias("records"))
                 .drop("page_no"))


def _as_layout(spark, sf, layout):
    """The run's pages written in a page layout and read back."""
    base = scratch_path(spark, f"landing-{layout}")
    landing.write_pages(landing.read_run_pages(spark, _landed(spark, sf)), base, layout=layout)
    return landing.page_counts(landing.read_pages(spark, base, layout=layout))


_LAYOUT_SQL = (V("src", "seed", "contracts") + ", " + _PAGES_CTE.format(size=500, wrap=10000).lstrip() + f"""
SELECT {S.ENDPOINT_SQL} AS endpoint, cursor_value, offset_value, records FROM out""")


@register("landing_page_layout", _LAYOUT_SQL)
def q_landing_page_layout(spark, sf):
    """One folder per page, as the source system keeps them."""
    return _as_layout(spark, sf, "page")


@register("landing_block_layout", _LAYOUT_SQL)
def q_landing_block_layout(spark, sf):
    """One folder per cursor block, offsets in envelopes."""
    return _as_layout(spark, sf, "block")


@register("landing_ties", """
SELECT CAST(count(*) AS BIGINT) AS records, CAST(ceil(count(*) / 500.0) AS BIGINT) AS pages,
       CAST(ceil(count(*) / 10000.0) AS BIGINT) AS blocks, CAST(max(l_orderkey * 10 + l_linenumber) AS BIGINT) AS last_id
FROM lineitem""")
def q_landing_ties(spark, sf):
    """One table whose records all share a second: the pages stay
    apart though their cursors do not."""
    li = S.read(spark, sf, "lineitem").select(
        F.lit("TIED").alias("table_name"), F.lit("/tied").alias("endpoint"), F.lit(S.SOURCE_START).cast("long").alias("cursor"),
        (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("id"), F.lit(S.SOURCE_START).cast("long").alias("updated_at"),
        F.to_json(F.struct("l_orderkey", "l_partkey")).alias("raw"))
    path = scratch_path(spark, "ties")
    landing.write_run(li, path)
    pages = landing.read_run_pages(spark, path, columns=("id",)).groupBy("table_name", "page_no", "block_no").agg(
        F.count(F.lit(1)).alias("n"), F.max("id").alias("top"))
    return pages.agg(F.sum("n").alias("records"), F.count(F.lit(1)).alias("pages"),
                     F.countDistinct("block_no").alias("blocks"), F.max("top").alias("last_id"))


@register("load_raw_pages", _GOOD_SQL)
def q_load_raw_pages(spark, sf):
    """Landed pages parsed, bad records quarantined, good ones merged
    into the target twice (the second load changes nothing)."""
    raw = landing.read_run(spark, _landed(spark, sf))
    c = next(iter(S.source_contracts().values()))
    first = load.load_pages(raw, c).table
    return load.load_pages(raw, c, target=first).table


@register("quarantine_report", V("src", "seed", "contracts") + ", " + _WORK.lstrip() + f"""
SELECT {S.ENDPOINT_SQL} AS endpoint, count(*) FILTER (WHERE ({_ISSUE_SEL}) IS NULL) AS good,
       count(*) FILTER (WHERE ({_ISSUE_SEL}) IS NOT NULL) AS quarantined
FROM sel GROUP BY 1""")
def q_quarantine_report(spark, sf):
    """Q4 over landed pages: good and quarantined records per endpoint."""
    raw = landing.read_run(spark, _landed(spark, sf))
    return load.load_pages(raw, next(iter(S.source_contracts().values()))).report


@register("stream_load", _GOOD_SQL)
def q_stream_load(spark, sf):
    """The landing folder consumed as a file stream (availableNow),
    each micro-batch parsed, split and appended to a change log; then every
    record landed again by a second run and the stream run once more: the
    latest-per-id table is unchanged."""
    base = _landed(spark, sf).rsplit("/", 1)[0]
    c = next(iter(S.source_contracts().values()))
    root = scratch_path(spark, "stream")
    paths = landing_stream.StreamPaths(landing=base, target=f"{root}/target", quarantine=f"{root}/quarantine",
                                       checkpoint=f"{root}/checkpoint")
    landing_stream.run_landing_stream(spark, c, paths, layout="run")
    spark.read.schema(landing.RUN_ROWS).parquet(f"{base}/run-1").write.parquet(f"{base}/run-2")
    landing_stream.run_landing_stream(spark, c, paths, layout="run")
    return landing_stream.current_table(spark, paths, c).select("id", "name", "updated_at", "o_custkey",
                                                                "o_totalprice")


_LANDED = V("src", "seed", "contracts") + ", " + _ADVANCED.lstrip()


def _store(spark):
    """An empty store of the five log tables, seeded with the stored
    checkpoints; (store, folder)."""
    root = scratch_path(spark, "store")
    store = api.LogStore(spark, f"{root}/logs")
    store.write("ingestion_checkpoints", S.checkpoint_seed(spark).withColumns(
        {"last_successful_run_id": F.lit(None).cast("string"), "updated_at": _now()}), seq=0, changed_at=_now())
    return store, root


def _execute(spark, sf, store, root, run_id, now, seq, to_json=S.raw_json, source=None):
    source = S.source_records(spark, sf) if source is None else source
    return execute.run(store, source, _registry(spark), run_id=run_id, root=root, to_json=to_json, now=now, seq=seq,
                       native_time="o_orderdate")


def _breaks(table):
    """raw_json of a source one of whose tables cannot be read."""
    def to_json(df):
        bad = F.when(F.col("table_name") == table, F.raise_error(F.lit("source gone")))
        return S.raw_json(df.withColumn("id", F.coalesce(bad.cast("long"), F.col("id"))))
    return to_json


@register("batch_log", _LANDED + f"""
SELECT '{RUN_ID}' AS run_id, adv.table_name, CASE WHEN adv.table_name = '3-MEDIUM' THEN 'FAILED' ELSE 'SUCCESS' END AS status,
       w.cursor AS cursor_value, 0 AS offset_value,
       CAST(CASE WHEN adv.table_name = '3-MEDIUM' THEN 0 ELSE records END AS INTEGER) AS records_count,
       adv.table_name = '3-MEDIUM' AS has_error, true AS timed
FROM adv JOIN work w USING (table_name)""")
def q_batch_log(spark, sf):
    """What the landing writes of a run really did, one row each, a
    failed table included; running it again under the same id adds nothing."""
    store, root = _store(spark)
    _execute(spark, sf, store, root, RUN_ID, RUN_TIME, 1, _breaks("3-MEDIUM"))
    log = store.read("batch_logs")
    store.insert("batch_logs", materialize(log.withColumn("status", F.lit("AGAIN"))), seq=2)
    return store.read("batch_logs").select(
        "run_id", "table_name", "status", "cursor_value", "offset_value", "records_count",
        F.col("error_message").isNotNull().alias("has_error"), (F.col("duration_ms") > 0).alias("timed"))


@register("run_incremental", _LANDED + f"""
SELECT adv.table_name, CASE WHEN adv.table_name = '3-MEDIUM' THEN NULL ELSE adv.current_watermark END AS current_watermark,
       CASE WHEN adv.table_name = '3-MEDIUM' THEN NULL ELSE adv.current_watermark END AS fallback_watermark,
       CASE WHEN adv.table_name = '3-MEDIUM' THEN NULL ELSE adv.last_id END AS last_id,
       CASE WHEN adv.table_name = '3-MEDIUM' THEN NULL ELSE '{RUN_ID}' END AS last_successful_run_id,
       'FAILED' AS run_status, TIMESTAMP '{RUN_TIME}' AS completed_at
FROM adv""")
def q_run_incremental(spark, sf):
    """A whole run with one table that fails: the others'
    checkpoints move to the marks of what was landed, the failed one's does
    not, and the run is closed FAILED."""
    store, root = _store(spark)
    _execute(spark, sf, store, root, RUN_ID, RUN_TIME, 1, _breaks("3-MEDIUM"))
    cps = store.read("ingestion_checkpoints").select("table_name", "current_watermark", "fallback_watermark", "last_id",
                                                     "last_successful_run_id")
    run = store.read("ingestion_runs").where(F.col("run_id") == RUN_ID)   # one row
    return _registry(spark).select("table_name").join(cps, "table_name", "left").withColumns({
        "run_status": run.agg(F.max("status")).scalar(), "completed_at": run.agg(F.max("completed_at")).scalar()})


@register("resume_run", V("src", "seed", "contracts") + ", " + _WORK.lstrip() + """
, late AS (SELECT table_name, id, CASE WHEN o_orderstatus = 'P' THEN 1893456000 ELSE updated_at END AS updated_at FROM src)
SELECT late.table_name, id, updated_at FROM late JOIN work USING (table_name) WHERE updated_at >= cursor""")
def q_resume_run(spark, sf):
    """A run that loses a table, the source moving rows to a later second
    meanwhile, and the run that follows: together they hold every record of
    the source as it is then."""
    store, root = _store(spark)
    _execute(spark, sf, store, root, "run-a", RUN_TIME, 1, _breaks("4-NOT SPECIFIED"))
    moved = F.col("o_orderstatus") == "P"
    later = S.source_records(spark, sf).withColumns({
        "updated_at": F.when(moved, F.lit(1893456000)).otherwise(F.col("updated_at")).cast("long"),
        "o_orderdate": F.when(moved, F.lit("2030-01-01 00:00:00").cast("timestamp_ntz")).otherwise(F.col("o_orderdate"))})
    _execute(spark, sf, store, root, "run-b", "2024-06-01 01:00:00", 2, source=later)
    rows = execute.landed_runs(spark, root, ["run-a", "run-b"])
    return merge.latest_per_key(rows.select("table_name", "id", "updated_at"), ["table_name", "id"], ["updated_at"],
                                keep=["updated_at"])


class _Stop(BaseException):
    """Ends a run as a lost driver would: nothing after it runs."""


def _stopped_once(steps: list[str]):
    """Stops at each step that has not been met before."""
    def stop(step: str) -> None:
        if step not in steps:
            steps.append(step)
            raise _Stop(step)
    return stop


@register("run_recovery", _LANDED + f"""
SELECT adv.table_name, adv.current_watermark, adv.last_id, '{RUN_ID}' AS last_successful_run_id, records AS landed,
       records AS logged, 'COMPLETED' AS run_status,
       CAST(2 + 2 * (SELECT count(*) FROM adv) + 2 AS INTEGER) AS stops
FROM adv""")
def q_run_recovery(spark, sf):
    """A run that is stopped after every step it stores and called
    again under its id each time: what it has landed is taken over, committed
    once, logged once, and it ends as an unbroken run does."""
    store, root = _store(spark)
    steps: list[str] = []
    status = None
    while status is None:
        try:
            _, status = execute.run(store, S.source_records(spark, sf), _registry(spark), run_id=RUN_ID, root=root,
                                    to_json=S.raw_json, now=RUN_TIME, seq=len(steps) + 1, native_time="o_orderdate",
                                    on_step=_stopped_once(steps))
        except _Stop:
            pass
    landed = execute.landed_runs(spark, root, [RUN_ID]).groupBy("table_name").agg(F.count(F.lit(1)).alias("landed"))
    logged = store.read("batch_logs").groupBy("table_name").agg(F.sum("records_count").alias("logged"))
    cps = store.read("ingestion_checkpoints").select("table_name", "current_watermark", "last_id", "last_successful_run_id")
    done = store.read("ingestion_runs").where(F.col("run_id") == RUN_ID)   # one row
    return (cps.join(landed, "table_name").join(logged, "table_name")
               .withColumns({"run_status": done.agg(F.max("status")).scalar(), "stops": F.lit(len(steps))}))


_REPLAYED = """
, known AS (SELECT w.*, (SELECT count(*) FROM src s WHERE s.table_name = w.table_name
                         AND s.updated_at BETWEEN w.start_watermark AND w.end_watermark) AS n
            FROM windows w WHERE w.table_name IN (SELECT table_name FROM contracts))"""


@register("run_replay", V("src", "windows", "contracts") + _REPLAYED.lstrip("\n") + f"""
SELECT w.event_id, CASE WHEN k.event_id IS NULL THEN 'PENDING' ELSE 'COMPLETED' END AS status,
       CAST(coalesce(k.n, 0) AS BIGINT) AS records_processed,
       CASE WHEN k.event_id IS NOT NULL THEN TIMESTAMP '{RUN_TIME}' END AS completed_at,
       CAST(k.n AS INTEGER) AS logged_records
FROM windows w LEFT JOIN known k USING (event_id)""")
def q_run_replay(spark, sf):
    """Pending events replayed by a run: claimed, landed, counted
    from what was landed, completed, one batch-log row each; events of
    unknown tables stay pending and the checkpoints do not move."""
    store, root = _store(spark)
    store.insert("fallback_events", S.replay_windows(spark, sf), seq=0, changed_at=_now())
    before = store.read("ingestion_checkpoints")
    mode, status = _execute(spark, sf, store, root, RUN_ID, RUN_TIME, 1)
    if (mode, status) != ("replay", "COMPLETED") or not before.exceptAll(store.read("ingestion_checkpoints")).isEmpty():
        raise ValueError("a replay must complete and leave the checkpoints alone")
    log = store.read("batch_logs").select("batch_id", F.col("records_count").alias("logged_records"))
    events = store.read("fallback_events").withColumn("batch_id", F.xxhash64(F.lit(RUN_ID), "event_id"))
    return events.join(log, "batch_id", "left").select("event_id", "status", "records_processed", "completed_at",
                                                       "logged_records")


@register("repeat_replay", V("src", "seed", "contracts") + ", " + _ADVANCED.lstrip() + """
, t AS (SELECT table_name, current_watermark - 2592000 AS lo, current_watermark AS hi FROM adv)
SELECT table_name, n AS request, CASE WHEN n = 1 THEN 'COMPLETED' ELSE 'PENDING' END AS status,
       CAST(CASE WHEN n = 1 THEN (SELECT count(*) FROM src s WHERE s.table_name = t.table_name
                                  AND s.updated_at BETWEEN lo AND hi) ELSE 0 END AS BIGINT) AS records_processed
FROM t, (VALUES (1), (2)) v(n)""")
def q_repeat_replay(spark, sf):
    """M7: the last 30 days of every table asked for, replayed, and asked for
    again: the first events keep their history, the second ones wait; a
    retried request adds nothing."""
    store, root = _store(spark)
    cps = materialize(_run(spark, sf).checkpoints)
    req = cps.select("table_name", F.lit("RAW").alias("layer"), (F.col("current_watermark") - 2592000).alias("start_watermark"),
                     F.col("current_watermark").alias("end_watermark"))
    keys = ["table_name", "layer", "start_watermark", "end_watermark"]
    times = ("2024-05-31 00:00:00", "2024-06-02 00:00:00")
    ask = lambda n: store.insert("fallback_events", merge.new_events(
        req, F.lit(times[n]).cast("timestamp_ntz"), keys), seq=n, changed_at=F.lit(times[n]).cast("timestamp_ntz"))
    ask(0)
    _execute(spark, sf, store, root, RUN_ID, RUN_TIME, 1)
    ask(0)
    ask(1)
    n = F.when(F.col("created_at") == F.lit(times[0]).cast("timestamp_ntz"), 1).otherwise(2)
    return store.read("fallback_events").select("table_name", n.alias("request"), "status", "records_processed")


@register("log_restart", """
SELECT o_orderkey, o_custkey + CASE WHEN o_orderstatus = 'F' THEN 1000000 ELSE 0 END AS o_custkey, o_orderstatus FROM orders""")
def q_log_restart(spark, sf):
    """M8: a keyed log written, attached anew under another number of shuffle
    partitions, appended to and read: every key once, in its last version."""
    path = scratch_path(spark, "restart")
    rows = S.read(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_orderstatus")
    n = spark.conf.get("spark.sql.shuffle.partitions")
    tables.KeyedLog(path, "o_orderkey").append(rows, changed_at=_now(), seq=1)
    spark.conf.set("spark.sql.shuffle.partitions", str(int(n) * 2 + 1))
    try:
        again = tables.KeyedLog(path, "o_orderkey")
        new = rows.where("o_orderstatus = 'F'").withColumn("o_custkey", F.col("o_custkey") + 1000000)
        again.append(new, changed_at=_now(), seq=2)
        return materialize(again.latest(spark))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", n)


@register("table_modes", """
SELECT o_orderstatus, CAST(CASE WHEN o_orderstatus = 'P' THEN 2 * count(*) ELSE count(*) END AS BIGINT) AS records
FROM orders GROUP BY 1""")
def q_table_modes(spark, sf):
    """A table created (fail if there), replaced by itself, and appended
    to; failing on one that is there is checked on the way."""
    path = scratch_path(spark, "modes")
    rows = S.read(spark, sf, "orders").select("o_orderkey", "o_orderstatus")
    tables.write_table(rows.where("o_orderstatus <> 'F'"), path, "fail")
    try:
        tables.write_table(rows, path, "fail")
    except Exception as e:
        if "PATH_ALREADY_EXISTS" not in str(e):
            raise
    else:
        raise ValueError("a table that is there was written over")
    tables.write_table(rows, path, "replace")
    tables.write_table(rows.where("o_orderstatus = 'P'"), path, "append")
    return tables.read_table(spark, path).groupBy("o_orderstatus").agg(F.count(F.lit(1)).alias("records"))


@register("relation_arrays", """
WITH ids AS (SELECT DISTINCT l_orderkey, l_partkey FROM lineitem),
d AS (SELECT p_partkey, p_name FROM part WHERE p_size > 25)
SELECT o_orderkey, count(l_partkey) AS n_ids, count(p_name) AS n_resolved, min(p_name) AS first_p_name, max(p_name) AS last_p_name
FROM orders LEFT JOIN ids ON o_orderkey = l_orderkey LEFT JOIN d ON l_partkey = p_partkey GROUP BY 1""")
def q_relation_arrays(spark, sf):
    """Each order's array of part ids resolved to the dimension; ids
    without a dimension row count as unresolved, orders without items have
    an empty array."""
    ids = S.read(spark, sf, "lineitem").groupBy("l_orderkey").agg(F.collect_set("l_partkey").alias("parts"))
    o = S.read(spark, sf, "orders").join(ids, F.col("o_orderkey") == F.col("l_orderkey"), "left")
    arrays = o.select("o_orderkey", empty_if_null("parts").alias("parts"))
    return relations.resolve_ids(arrays, "o_orderkey", "parts", S.read(spark, sf, "part").where("p_size > 25"), "p_partkey",
                                 "p_name")


@register("orphan_checkpoints", V("runs") + """
SELECT c_custkey, CAST(c_custkey * 4 AS VARCHAR) AS last_successful_run_id FROM customer
WHERE CAST(c_custkey * 4 AS VARCHAR) NOT IN (SELECT run_id FROM runs WHERE status = 'COMPLETED')""")
def q_orphan_checkpoints(spark, sf):
    """Checkpoints (one per customer) whose last successful run is no
    completed run."""
    c = S.read(spark, sf, "customer").select("c_custkey", (F.col("c_custkey") * 4).cast("string").alias("last_successful_run_id"))
    done = S.runs(spark, sf).where(F.col("status") == "COMPLETED")
    return quality.orphans(c, done, "last_successful_run_id", "run_id").select("c_custkey", "last_successful_run_id")


@register("page_paths", _LAYOUT_SQL.rsplit("SELECT", 1)[0] + f"""
SELECT {S.ENDPOINT_SQL} || '/' || cursor_value || '_' || offset_value || '.json' AS path,
       {S.ENDPOINT_SQL} AS endpoint, cursor_value, offset_value FROM out""")
def q_page_paths(spark, sf):
    """F8: the path of every page of a run and what it says."""
    pages = ingest.run_pages(_run(spark, sf)).where("records > 0")
    reg = _registry(spark).select("table_name", "endpoint")
    paths = pages.join(reg, "table_name").select(page_path("endpoint", "cursor_value", "offset_value").alias("path"))
    ep, cur, off = page_path_parts("path")
    return paths.select("path", ep.alias("endpoint"), cur.alias("cursor_value"), off.alias("offset_value"))


@register("search_before_limit", V("runs") + """
SELECT run_id, status, error_message FROM runs WHERE contains(lower(error_message), 'customer 7')
ORDER BY started_at DESC, run_id LIMIT 50""")
def q_search_before_limit(spark, sf):
    """The newest 50 runs among all that match the search."""
    return api.search_and_sort(reports.runs_history(S.runs(spark, sf), None), "Customer 7", columns=["error_message"],
                               limit=50).select("run_id", "status", "error_message")


@register("log_tables", V("src", "seed", "contracts") + ", " + _CHECKPOINT_TABLE.lstrip() + """
SELECT * FROM merged""")
def q_log_tables(spark, sf):
    """The five log tables created if absent, the checkpoint
    table written into its table (replace), read back whole."""
    root = scratch_path(spark, "logs")
    prefix = "logs_" + root.rsplit("-", 1)[-1] + "_"
    names = tables.create_log_tables(spark, root, prefix=prefix)
    cps = _checkpoint_table(spark, sf)
    target = f"{prefix}ingestion_checkpoints"
    assert target in names
    bad = tables.not_null_violations(cps.where(F.col("updated_at").isNotNull()), "ingestion_checkpoints")
    if bad.limit(1).count():
        raise ValueError("checkpoint rows break NOT NULL columns")
    cps.select(*tables.log_schema("ingestion_checkpoints").names).write.insertInto(target, overwrite=True)
    for name in names:   # the files stay; the catalog entries were this run's
        spark.sql(f"DROP TABLE {name}")
    return spark.read.schema(tables.log_schema("ingestion_checkpoints")).parquet(f"{root}/ingestion_checkpoints")


@register("orphan_log_rows", V("src", "runs", "batches") + _KEYS_SQL + _DRIFT_SQL + """
, kept AS (SELECT run_id FROM runs WHERE started_at >= TIMESTAMP '1998-01-01 00:00:00')
SELECT 'batch' AS kind, CAST(batch_id AS VARCHAR) AS row_id, run_id FROM batches WHERE run_id NOT IN (SELECT run_id FROM kept)
UNION ALL
SELECT 'drift', table_name, CASE WHEN table_name < '3' THEN (SELECT max(run_id) FROM kept) ELSE 'run-0001' END FROM drift
WHERE table_name >= '3'""")
def q_orphan_log_rows(spark, sf):
    """After runs before 1998 have been purged, the batch rows and the
    drift rows that name a run which is not there."""
    kept = S.runs(spark, sf).where(F.col("started_at") >= F.lit("1998-01-01 00:00:00").cast("timestamp_ntz"))
    some = kept.agg(F.max("run_id")).scalar()
    drift = _drift(spark, sf).withColumn("detected_in_run_id", F.when(F.col("table_name") < "3", some).otherwise(F.lit(RUN_ID)))
    lost = quality.orphans(S.batches(spark, sf), kept, "run_id")
    loose = quality.orphans(drift, kept, "detected_in_run_id", "run_id")
    return lost.select(F.lit("batch").alias("kind"), F.col("batch_id").cast("string").alias("row_id"), "run_id").unionByName(
        loose.select(F.lit("drift").alias("kind"), F.col("table_name").alias("row_id"),
                     F.col("detected_in_run_id").alias("run_id")))


def _versions():
    """Two versions of the contracts: the second takes ``rush`` in for one
    table; both ask another table for a column that it never sends."""
    first = S.source_contracts()
    fields = [(f.name, f.dtype.simpleString(), f.required) for f in first["5-LOW"].fields]
    first["5-LOW"] = table_contract("5-LOW", [*fields, ("o_comment", "string", True)], endpoint=S.endpoint_of("5-LOW"),
                                    start=S.SOURCE_START)
    second = first | {"1-URGENT": table_contract("1-URGENT", [*fields, ("rush", "boolean", False)],
                                                 endpoint=S.endpoint_of("1-URGENT"), start=S.SOURCE_START)}
    return [("2024-01-01 00:00:00", first), (RUN_TIME, second)]


def _plain_json(spark, sf):
    """Every source record as JSON without wrong types: urgent orders above
    300,000 carry ``rush``, failed orders of priority 4 no ``name``."""
    rush = F.when((F.col("table_name") == "1-URGENT") & (F.col("o_totalprice") > 300000), F.lit(True))
    name = F.when((F.col("o_orderstatus") != "F") | (F.col("table_name") != "4-NOT SPECIFIED"), F.col("name"))
    return S.source_records(spark, sf).select(
        "table_name", (F.year("o_orderdate") * 366 + F.dayofyear("o_orderdate")).cast("int").alias("snapshot"),
        F.to_json(F.struct("id", name.alias("name"), "updated_at", "o_custkey", "o_totalprice", rush.alias("rush"))).alias("raw"))


@register("column_history", V("src") + f"""
, k AS (SELECT table_name, CAST(year(o_orderdate) * 366 + dayofyear(o_orderdate) AS INTEGER) AS snapshot,
               unnest(CASE WHEN o_orderstatus = 'F' AND table_name = '4-NOT SPECIFIED' THEN ['id', 'updated_at', 'o_custkey', 'o_totalprice']
                           ELSE ['id', 'updated_at', 'o_custkey', 'o_totalprice', 'name'] END
                      || CASE WHEN table_name = '1-URGENT' AND o_totalprice > 300000 THEN ['rush'] ELSE [] END) AS column_name FROM src),
g AS (SELECT table_name, snapshot, column_name, count(*) AS records FROM k GROUP BY ALL),
n AS (SELECT table_name, snapshot, row_number() OVER (PARTITION BY table_name ORDER BY snapshot) AS n
      FROM (SELECT DISTINCT table_name, snapshot FROM g)),
i AS (SELECT g.*, n.n, n.n - row_number() OVER (PARTITION BY table_name, column_name ORDER BY n.n) AS island
      FROM g JOIN n USING (table_name, snapshot))
SELECT table_name, column_name, min(snapshot) AS first_seen, max(snapshot) AS last_seen, count(*) AS snapshots,
       sum(records)::BIGINT AS records, max(n) = (SELECT max(n) FROM n x WHERE x.table_name = i.table_name) AS open,
       CASE WHEN column_name <> 'rush' THEN TIMESTAMP '2024-01-01 00:00:00' ELSE TIMESTAMP '{RUN_TIME}' END AS included_at
FROM i GROUP BY table_name, column_name, island""")
def q_column_history(spark, sf):
    """Every column of the raw records, day by day: the runs of days
    that carry it, and the contract version that took it in."""
    return history.column_history(_plain_json(spark, sf), _versions())


@register("accepted_drift", V("src") + f"""
, h AS (SELECT DISTINCT table_name FROM src WHERE table_name = '5-LOW' OR (table_name = '1-URGENT' AND o_totalprice > 300000))
SELECT table_name, CASE WHEN table_name = '5-LOW' THEN 'o_comment' ELSE 'rush' END AS changed,
       CASE WHEN table_name = '5-LOW' THEN 'BREAKING_CHANGE' ELSE 'NEW_COLUMN' END AS status,
       CASE WHEN table_name = '1-URGENT' THEN TIMESTAMP '{RUN_TIME}' END AS included_at FROM h""")
def q_accepted_drift(spark, sf):
    """Q6 Q8: drift rows stored under the first contracts (a new column, and a
    required column that no record carries), then marked by the second: the
    new column is included, the breaking change is not."""
    (_, first), (since, second) = _versions()
    store, _ = _store(spark)
    observed = materialize(quality.observed_keys(_plain_json(spark, sf).select("table_name", "raw")))
    found = quality.drift_rows(observed, registry_frame(spark, first), columns_frame(spark, first), run_id=F.lit(RUN_ID),
                               detected_at=F.lit("2024-02-01 00:00:00").cast("timestamp_ntz"))
    store.insert("schema_history", found, seq=1, changed_at=F.lit("2024-02-01 00:00:00").cast("timestamp_ntz"))
    marked = quality.mark_included(store.read("schema_history"), registry_frame(spark, second), F.lit(since).cast("timestamp_ntz"))
    store.write("schema_history", materialize(marked), seq=2, changed_at=_now())
    return store.read("schema_history").select("table_name", F.array_join("changed_columns", ",").alias("changed"), "status",
                                               "included_at")


@register("breaking_changes", V("src") + _KEYS_SQL + """
SELECT table_name, column_name, 'bigint' AS declared_type, data_type AS observed_type, count(*) AS records
FROM kv WHERE column_name = 'updated_at' AND data_type <> 'integer' GROUP BY 1, 2, 3, 4""")
def q_breaking_changes(spark, sf):
    """Q6: declared columns arriving with a type the contract cannot take."""
    observed = materialize(quality.observed_keys(S.raw_records(spark, sf)))   # one scan, two uses
    return quality.breaking_changes(observed, columns_frame(spark, S.source_contracts()), _registry(spark))


@register("schema_history_insert", V("src") + _KEYS_SQL + _DRIFT_SQL + f"""
SELECT table_name, schema_hash, status, list_aggregate(changed, 'string_agg', ',') AS changed,
       CASE WHEN table_name < '3' THEN 'run-0000' ELSE '{RUN_ID}' END AS detected_in_run_id FROM drift
UNION ALL SELECT 'legacy', 'old-hash', 'NEW_COLUMN', 'x', 'run-0000'""")
def q_schema_history_insert(spark, sf):
    """M4: drift rows inserted through the store only where (table, hash) is
    new: the tables of an earlier run keep their rows, the others get one."""
    store, _ = _store(spark)
    rows = materialize(_drift(spark, sf))
    old = rows.where("table_name < '3'").withColumn("detected_in_run_id", F.lit("run-0000"))
    legacy = literal_frame(spark, [(1, "legacy", "old-hash", "{}", ["x"], RUN_TIME, "run-0000", None, "NEW_COLUMN", "-")],
                           tables.LOG_TABLES["schema_history"])
    store.insert("schema_history", old.select(*legacy.columns).unionByName(legacy), seq=1, changed_at=_now())
    store.insert("schema_history", rows, seq=2, changed_at=_now())
    return store.read("schema_history").select("table_name", "schema_hash", "status",
                                               F.array_join("changed_columns", ",").alias("changed"), "detected_in_run_id")


@register("null_report", V("runs", "batches") + """
SELECT (SELECT count(*) FILTER (WHERE completed_at IS NULL) FROM runs) AS completed_at_nulls,
       (SELECT count(*) FILTER (WHERE error_message IS NULL) FROM runs) AS error_message_nulls,
       (SELECT count(*) FILTER (WHERE run_id IS NULL OR started_at IS NULL OR layer IS NULL OR status IS NULL)
        FROM runs) AS not_null_violations,
       (SELECT count(*) FILTER (WHERE error_message IS NULL) FROM batches) AS batch_error_message_nulls""")
def q_null_report(spark, sf):
    """Q3 not-null checks and the NOT NULL columns of the runs table."""
    r = S.runs(spark, sf).select(F.lit("r").alias("t"), "completed_at", "error_message",
                                 tables.not_null_violations_flag("ingestion_runs").alias("bad"))
    b = S.batches(spark, sf).select(F.lit("b").alias("t"), F.lit(None).cast("timestamp_ntz").alias("completed_at"),
                                    "error_message", F.lit(False).alias("bad"))
    # one tagged stream, one conditional aggregate: no join of one-row frames
    u, t = r.unionByName(b), F.col("t")
    return u.agg(F.count_if((t == "r") & F.col("completed_at").isNull()).alias("completed_at_nulls"),
                 F.count_if((t == "r") & F.col("error_message").isNull()).alias("error_message_nulls"),
                 F.count_if((t == "r") & F.col("bad")).alias("not_null_violations"),
                 F.count_if((t == "b") & F.col("error_message").isNull()).alias("batch_error_message_nulls"))


@register("running_watermark", V("src", "seed", "contracts") + ", " + _PAGES_CTE.format(size=100, wrap=1000).lstrip()
          + """
SELECT table_name, page_no, page_max_updated_at, running_watermark FROM out""")
def q_running_watermark(spark, sf):
    """The watermark after each page of 100, seeded with the stored
    cursor."""
    return ingest.run_pages(_run(spark, sf), page_size=100, wrap=1000).where(F.col("records") > 0).select(
        "table_name", "page_no", "page_max_updated_at", "running_watermark")


@register("running_last_id", V("src", "seed", "contracts") + ", " + _PAGES_CTE.format(size=100, wrap=1000).lstrip()
          + """
SELECT table_name, page_no, page_last_id, running_last_id FROM out""")
def q_running_last_id(spark, sf):
    """The id carried with the watermark after each page (largest id at
    the highest second seen so far)."""
    return ingest.run_pages(_run(spark, sf), page_size=100, wrap=1000).where(F.col("records") > 0).select(
        "table_name", "page_no", "page_last_id", "running_last_id")


@register("unseeded_tables", V("src", "seed", "contracts") + """
SELECT c.table_name, CAST(788918400 AS BIGINT) AS start_watermark,
       (SELECT count(*) FROM src WHERE src.table_name = c.table_name AND updated_at >= 788918400) AS rows_from_start
FROM contracts c WHERE c.table_name NOT IN (SELECT table_name FROM seed WHERE layer = 'RAW')""")
def q_unseeded_tables(spark, sf):
    """Tables with no checkpoint get a seed at their start, and read
    everything from it."""
    reg = _registry(spark)
    missing = select.unseeded_tables(reg, S.checkpoint_seed(spark)).select("table_name", "start_watermark")
    seeds = materialize(missing)
    counts = (S.source_records(spark, sf).join(checked_broadcast(seeds), "table_name")
              .where(F.col("updated_at") >= F.col("start_watermark"))
              .groupBy("table_name").agg(F.count(F.lit(1)).alias("rows_from_start")))
    return (seeds.join(counts, "table_name", "left")
                 .select("table_name", F.col("start_watermark").cast("long").alias("start_watermark"),
                         F.coalesce("rows_from_start", F.lit(0)).cast("long").alias("rows_from_start")))


@register("run_lifecycle", V("runs", "batches") + f"""
, own AS (SELECT run_id, bool_or(status = 'FAILED') AS failed FROM batches GROUP BY 1)
SELECT r.run_id, started_at, CASE WHEN r.status = 'RUNNING' THEN TIMESTAMP '{RUN_TIME}' ELSE completed_at END AS completed_at,
       layer, CASE WHEN r.status <> 'RUNNING' THEN r.status WHEN own.failed THEN 'FAILED' ELSE 'COMPLETED' END AS status,
       CASE WHEN r.status = 'RUNNING' THEN NULL ELSE error_message END AS error_message
FROM runs r LEFT JOIN own USING (run_id)
UNION ALL SELECT '{RUN_ID}', TIMESTAMP '{RUN_TIME}', NULL, 'RAW', 'RUNNING', NULL""")
def q_run_lifecycle(spark, sf):
    """Every open run is closed with the roll-up of its own
    batches; a new run is started (starting it twice adds nothing)."""
    runs = S.runs(spark, sf)
    opened = runs.where("status = 'RUNNING'").select("run_id")
    rolled = opened.join(reports.run_status_rollup(S.batches(spark, sf)), "run_id", "left").select(
        "run_id", F.coalesce("run_status", F.lit("COMPLETED")).alias("status"), F.lit(None).cast("string").alias("error_message"))
    closed = merge.run_completion(runs, rolled, _now())
    return ingest.start_run(ingest.start_run(closed, RUN_ID, "RAW", RUN_TIME), RUN_ID, "RAW", RUN_TIME)


@register("kpi_summary", V("runs", "batches", "src", "seed", "contracts") + ", " + _CHECKPOINT_TABLE.lstrip()
          + _KEYS_SQL + _DRIFT_SQL + """
SELECT r.*, c.*, b.*, h.* FROM
  (SELECT count(*) AS total_runs, count(*) FILTER (WHERE status = 'COMPLETED') AS successful_runs,
          count(*) FILTER (WHERE status = 'FAILED') AS failed_runs FROM runs) r,
  (SELECT count(*) AS total_tables, count(*) FILTER (WHERE table_name = '1-URGENT' OR is_override_active) AS active_overrides
   FROM merged) c,
  (SELECT CAST(coalesce(sum(records_count), 0) AS BIGINT) AS total_records_ingested FROM batches) b,
  (SELECT count(*) AS total_schema_changes FROM drift) h""")
def q_kpi_summary(spark, sf):
    """A1-A3: the dashboard row over the runs, the checkpoint table after
    an override on one table (M7b), the batch log and the schema history
    detected from the raw records."""
    req = literal_frame(spark, [("1-URGENT", None, True)],
                        "table_name string, custom_watermark bigint, activate_fallback boolean")
    cps = merge.override_checkpoint(_checkpoint_table(spark, sf), req, _now())
    history = _drift(spark, sf)
    return reports.kpi_summary(S.runs(spark, sf), cps, S.batches(spark, sf), history)


_EVENT_VALUES = ["event_type", "value"]
_STATE_SQL = """(SELECT user_id, ts, event_id, event_type, value FROM (
  SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS n FROM events
  WHERE user_id IS NOT NULL AND ts <= TIMESTAMP '{at}') WHERE n = 1 AND event_type IS DISTINCT FROM 'error')"""
_AFTER, _UNTIL = "2024-01-01 08:00:00", "2024-01-02 12:00:00"


def _time(text: str) -> F.Column:
    return F.lit(text).cast("timestamp_ntz")


@register("as_of_state", "SELECT * FROM " + _STATE_SQL.format(at=_UNTIL))
def q_as_of_state(spark, sf):
    """The rows as they were at a time, deleted ones left out."""
    return versions.as_of(S.event_versions(spark, sf), _time(_UNTIL), key="user_id", time="ts", tie="event_id",
                          values=_EVENT_VALUES, deleted="deleted")


@register("change_feed", f"""
WITH old AS {_STATE_SQL.format(at=_AFTER)}, new AS {_STATE_SQL.format(at=_UNTIL)},
moved AS (SELECT user_id, max(ts) AS ts, count(*) AS versions FROM events
          WHERE user_id IS NOT NULL AND ts > TIMESTAMP '{_AFTER}' AND ts <= TIMESTAMP '{_UNTIL}' GROUP BY user_id)
SELECT m.user_id, CASE WHEN old.user_id IS NULL THEN 'insert' WHEN new.user_id IS NULL THEN 'delete' ELSE 'update' END AS operation,
       old.event_type AS before_event_type, old.value AS before_value, new.event_type AS after_event_type,
       new.value AS after_value, m.ts, m.versions
FROM moved m LEFT JOIN old USING (user_id) LEFT JOIN new ON new.user_id = m.user_id
WHERE (old.user_id IS NULL) <> (new.user_id IS NULL) OR (old.user_id IS NOT NULL AND (
      old.event_type IS DISTINCT FROM new.event_type OR old.value IS DISTINCT FROM new.value))""")
def q_change_feed(spark, sf):
    """Inserts, updates and deletes between two times, with the images
    before and after."""
    return versions.change_feed(S.event_versions(spark, sf), _time(_AFTER), _time(_UNTIL), key="user_id", time="ts",
                                tie="event_id", values=_EVENT_VALUES, deleted="deleted")


@register("as_of_rows", """
WITH v AS (SELECT user_id, ts, event_id, event_type, value FROM (
  SELECT *, row_number() OVER (PARTITION BY user_id, ts ORDER BY event_id DESC) AS n FROM events) WHERE n = 1),
p AS (SELECT o_orderkey AS probe_id, o_custkey % 200 AS user_id,
             TIMESTAMP '2024-01-01 00:00:00' + to_seconds(o_orderkey * 7919 % 2000000) AS at FROM orders)
SELECT p.probe_id, p.user_id, p.at, v.ts, v.event_id, v.event_type, v.value
FROM p ASOF LEFT JOIN v ON p.user_id = v.user_id AND p.at >= v.ts""")
def q_as_of_rows(spark, sf):
    """Every probe with the version of its user that held at its time."""
    return versions.as_of_join(S.order_probes(spark, sf), S.event_versions(spark, sf), key="user_id", at="at", time="ts",
                               tie="event_id", values=["event_id", *_EVENT_VALUES])


@register("nested_schema", V("src") + f"""
, n AS (SELECT table_name, updated_at < {S.NESTED_CHANGE} AS stored, {S.NESTED_TEXT} AS raw FROM src),
tree AS (
  SELECT table_name, stored, regexp_replace(fullkey, '\\[\\d+\\]', '[]', 'g') AS path,
         CASE WHEN t.type IN ('UBIGINT', 'BIGINT') THEN 'INTEGER' WHEN t.type = 'DOUBLE' THEN 'NUMBER'
              WHEN t.type = 'VARCHAR' THEN 'STRING' ELSE t.type END AS kind
  FROM (SELECT * FROM n WHERE json_valid(raw)) x, json_tree(x.raw) t
  UNION ALL SELECT table_name, stored, '$', 'INVALID' FROM n WHERE NOT json_valid(raw)),
scoped AS (SELECT 'old' AS scope, * FROM tree WHERE stored UNION ALL SELECT 'all', * FROM tree),
typed AS (
  SELECT scope, table_name, path, records, nulls, in_run,
         CASE WHEN len(k) = 0 THEN 'NULL' WHEN len(k) = 1 THEN k[1]
              WHEN list_has_any(k, ['OBJECT', 'ARRAY', 'INVALID']) THEN 'MIXED'
              WHEN k = ['INTEGER', 'NUMBER'] THEN 'NUMBER' ELSE 'STRING' END AS type
  FROM (SELECT scope, table_name, path, count(*) AS records, count(*) FILTER (WHERE kind = 'NULL') AS nulls,
               bool_or(NOT stored) AS in_run,
               list_sort(coalesce(list(DISTINCT kind) FILTER (WHERE kind <> 'NULL'), [])) AS k
        FROM scoped GROUP BY ALL))
SELECT a.table_name, a.path, o.type AS type_before, a.type AS type_after, a.records, a.nulls,
       CASE WHEN o.type IS NULL THEN 'NEW_COLUMN' WHEN NOT a.in_run THEN 'GONE' WHEN o.type = a.type THEN 'SAME'
            WHEN a.type = 'MIXED' THEN 'BREAKING_CHANGE' ELSE 'WIDENED' END AS change
FROM typed a LEFT JOIN typed o ON o.scope = 'old' AND o.table_name = a.table_name AND o.path = a.path
WHERE a.scope = 'all'""")
def q_nested_schema(spark, sf):
    """Q5 Q7: the nested schema of the records of 1997 and later, merged into
    that of those before: type and change of every path."""
    raw = S.nested_records(spark, sf)
    new = F.col("updated_at") >= S.NESTED_CHANGE
    return nested.schema_changes(nested.path_counts(raw.where(~new)), nested.path_counts(raw.where(new)))
