"""Runs that execute: open the run, land, commit, log, move
the checkpoints, close the run; pending replay events first.

The driver walks the contracts (control state, one row each); records are
scanned, shuffled and written by Spark jobs.  A run scans its source once, for
all tables, into a staged selection in page order; every table then lands from
its own part of it, into a folder of its attempt, and is committed by a record
of the folder and of the marks taken from the files in it, before the next
table starts.  A table that fails is logged FAILED and the others go on.

What a run has done is kept beside its landing folders (``_runs/<run_id>``:
cursors, staged selection, commit records), so a run that is stopped at any
point can be called again under its id: it goes on where it was, takes landed
but uncommitted tables over, and ends as if it had not been stopped.  If
another run starts instead, it first recovers the stopped one: what was
committed is logged and moves the checkpoints, claimed events wait again, and
the stopped run is closed FAILED.  One run works on a layer at a time.
"""

from __future__ import annotations

import time
from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.operators import merge, progress, select
from tidemark.plans import ingest
from tidemark.plans.api import LogStore
from tidemark.session import literal_frame, materialize
from tidemark.sources import landing

RUN = ("run_id string, started_at timestamp_ntz, completed_at timestamp_ntz, layer string, status string, "
       "error_message string")
BATCH = ("run_id string, table_name string, layer string, status string, cursor_value bigint, offset_value int, "
         "records_count int, duration_ms int, query_sent string, error_message string, created_at timestamp_ntz, part string")


def _tried(job: Callable[[], None]) -> tuple[int, str | None]:
    """Milliseconds that ``job`` took, and its error if it failed."""
    start = time.perf_counter()
    try:
        job()
        error = None
    except Exception as e:  # the outcome is logged; other tables go on
        error = _text_of(e)
    return int((time.perf_counter() - start) * 1000), error


def _text_of(e: Exception) -> str:
    return str(e).split("\n")[0][:500] or type(e).__name__


def _log_batches(store: LogStore, rows: list[tuple], seq: int, at) -> None:
    made = literal_frame(store.spark, rows, BATCH)
    store.insert("batch_logs", made.withColumn("batch_id", F.xxhash64("run_id", "table_name", "part")), seq=seq, changed_at=at)


def _close(store: LogStore, run_id: str, errors: list[str], now: str, seq: int) -> str:
    """M2: the run's terminal state, FAILED if anything in it failed."""
    status = "FAILED" if errors else "COMPLETED"
    current = store.read("ingestion_runs").where(F.col("run_id") == run_id)
    closed = merge.update_one(current, "run_id", run_id, {
        "status": F.lit(status), "completed_at": F.lit(now).cast("timestamp_ntz"),
        "error_message": F.lit("; ".join(errors)[:2000] or None).cast("string")})
    store.write("ingestion_runs", materialize(closed), seq=seq, changed_at=F.lit(now).cast("timestamp_ntz"))
    return status


def _notes(root: str, run_id: str) -> str:
    return f"{root.rstrip('/')}/_runs/{run_id}"


def _kept(spark, path: str, make: Callable[[], DataFrame]) -> DataFrame:
    """The rows that an earlier attempt wrote to ``path``, else ``make``'s,
    written there."""
    if not landing.done(spark, path):
        make().write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)


def _attempt(spark, folder: str) -> tuple[str, bool]:
    """The landing folder of a complete attempt, or a new one: (path, complete)."""
    k = 0
    while landing._exists(spark, f"{folder}/attempt={k}"):
        if landing.done(spark, f"{folder}/attempt={k}"):
            return f"{folder}/attempt={k}", True
        k += 1
    return f"{folder}/attempt={k}", False


COMMIT = ("table_name string, path string, cursor bigint, records bigint, mark_time bigint, mark_id bigint, "
          "duration_ms int")


def committed(spark, root: str, run_id: str) -> list:
    """The commit records of a run: a row per table that has landed."""
    work = f"{_notes(root, run_id)}/work"
    if not landing.done(spark, work):
        return []
    paths = [f"{_notes(root, run_id)}/commits/table={n}" for n in range(spark.read.parquet(work).count())]
    paths = [p for p in paths if landing.done(spark, p)]
    return spark.read.schema(COMMIT).parquet(*paths).orderBy("table_name").collect() if paths else []


def run_incremental(store: LogStore, source: DataFrame, registry: DataFrame, *, run_id: str, root: str, to_json, now: str,
                    seq: int, layer: str = "RAW", native_time: str | None = None,
                    on_step: Callable[[str], None] = lambda step: None) -> str:
    """Land every registered table from its checkpoint, each under
    ``root/run=<run_id>/table=<n>``; returns the run's status.  Every call has
    a ``seq`` of its own, a repeated one too.  ``on_step`` is told of each step
    that has been stored."""
    _open(store, run_id, layer, now, seq)
    on_step("opened")
    failed, errors = [], []
    try:
        failed = _land_tables(store, source, registry, run_id, root, to_json, layer, native_time, on_step)
        errors = [f"{table}: {error}" for table, _, error, _ in failed]
    except Exception as e:  # the run is closed whatever failed in it
        errors.append(_text_of(e))
    _, error = _tried(lambda: _settle(store, root, run_id, failed, layer, now, seq, on_step))
    return _close(store, run_id, errors + ([error] if error else []), now, seq)


def _land_tables(store, source, registry, run_id, root, to_json, layer, native_time, on_step) -> list[tuple]:
    """Lands and commits what is not committed yet; (table, cursor, error, ms)
    of each table that failed."""
    spark, notes = store.spark, _notes(root, run_id)
    work = _kept(spark, f"{notes}/work", lambda: select.work_items(registry, store.read("ingestion_checkpoints"), layer))
    items = work.orderBy("table_name").collect()
    chosen = select.incremental_select(source, work, native_time=native_time)
    todo = [n for n, _ in enumerate(items) if not landing.done(spark, f"{notes}/commits/table={n}")]
    ready = [n for n in todo if not _attempt(spark, f"{root}/run={run_id}/table={n}")[1]]
    whole, error = f"{notes}/staged", None
    if ready and not landing.done(spark, whole):
        _, error = _tried(lambda: landing.stage_run(chosen, whole))
        if error is None:
            on_step("staged")
    failed = []
    for n in todo:
        item = items[n]
        ms, error_here = _tried(lambda: _land_one(spark, chosen, item, n, run_id, root, to_json, error is None, on_step))
        if error_here:
            failed.append((item.table_name, item.cursor, error_here, ms))
    return failed


def _land_one(spark, chosen, item, n, run_id, root, to_json, whole, on_step) -> None:
    """One table: staged by itself if the scan for all of them failed, landed
    unless an attempt is complete, and committed."""
    notes, started = _notes(root, run_id), time.perf_counter()
    path, complete = _attempt(spark, f"{root}/run={run_id}/table={n}")
    if not complete:
        staged = f"{notes}/staged" if whole else f"{notes}/staged-table={n}"
        if not landing.done(spark, staged):
            landing.stage_run(chosen.where(F.col("table_name") == item.table_name), staged)
        landing.land_table(spark, staged, chosen.schema, item.table_name, item.endpoint, path, to_json)
        on_step(f"landed {item.table_name}")
    # Records without a time or an id land for the load to quarantine; they set no mark.
    marked = F.col("updated_at").isNotNull() & F.col("id").isNotNull()
    mark = landing.landed_keys(spark, path).agg(F.max(F.when(marked, F.struct("updated_at", "id"))).alias("m"),
                                                F.count(F.lit(1)).alias("n")).first()
    top = max((item.cursor, item.last_id), tuple(mark.m) if mark.m else (item.cursor, item.last_id))
    ms = int((time.perf_counter() - started) * 1000)
    record = literal_frame(spark, [(item.table_name, path, item.cursor, mark.n, *top, ms)], COMMIT)
    record.write.mode("overwrite").parquet(f"{notes}/commits/table={n}")
    on_step(f"committed {item.table_name}")


def _settle(store, root, run_id, failed, layer, now, seq, on_step=lambda step: None) -> None:
    """Logs what a run has landed, and what of it failed, and moves the
    checkpoints to the committed marks.  All of it can be done again."""
    at, found = F.lit(now).cast("timestamp_ntz"), committed(store.spark, root, run_id)
    asked = "updated_at >= {}, by updated_at and id"
    rows = [(run_id, r.table_name, layer, "SUCCESS", r.cursor, 0, r.records, r.duration_ms, asked.format(r.cursor), None, now,
             "land") for r in found]
    rows += [(run_id, table, layer, "FAILED", cursor, 0, 0, ms, asked.format(cursor), error, now, f"failed {seq}")
             for table, cursor, error, ms in failed]
    if rows:
        _log_batches(store, rows, seq, at)
    on_step("logged")
    current = store.read("ingestion_checkpoints")
    if found:
        # Both watermarks move together; an override that was asked for stays on.
        marks = [(r.table_name, r.mark_time, r.mark_time, r.mark_id, layer, 0, False, run_id, now) for r in found]
        new = literal_frame(store.spark, marks, "table_name string, current_watermark bigint, fallback_watermark bigint, "
                            "last_id bigint, layer string, offset_val int, is_override_active boolean, "
                            "last_successful_run_id string, updated_at timestamp_ntz")
        # A run that is recovered late takes no mark back.
        ahead = current.where("current_watermark IS NOT NULL").select(
            "table_name", F.struct("current_watermark", F.coalesce("last_id", F.lit(0))).alias("there"))
        new = new.join(ahead, "table_name", "left").where(
            F.col("there").isNull() | (F.struct("current_watermark", "last_id") >= F.col("there"))).drop("there")
        merged = merge.upsert_columns(current, new, "table_name",
                                      ["current_watermark", "fallback_watermark", "last_id", "offset_val",
                                       "last_successful_run_id", "updated_at"],
                                      {"layer": F.lit(layer), "is_override_active": F.lit(False)})
        store.write("ingestion_checkpoints", materialize(merged.join(new.select("table_name"), "table_name", "left_semi")),
                    seq=seq, changed_at=at)
    on_step("moved")


def _open(store: LogStore, run_id: str, layer: str, now: str, seq: int) -> None:
    """M1: the RUNNING row, if the id is new."""
    store.insert("ingestion_runs", literal_frame(store.spark, [(run_id, now, None, layer, "RUNNING", None)], RUN), seq=seq,
                 changed_at=F.lit(now).cast("timestamp_ntz"))


def recover(store: LogStore, *, run_id: str, root: str, now: str, seq: int, layer: str = "RAW") -> list[str]:
    """Closes the runs of ``layer``, other than ``run_id``, that were stopped:
    committed tables are logged and move their checkpoints, claimed events are
    PENDING again, the run is FAILED.  Returns their ids."""
    stopped = store.read("ingestion_runs").where((F.col("status") == "RUNNING") & (F.col("layer") == layer)
                                                 & (F.col("run_id") != run_id)).select("run_id").collect()
    for r in stopped:
        _settle(store, root, r.run_id, [], layer, now, seq)
        events = f"{_notes(root, r.run_id)}/events"
        if landing.done(store.spark, events):
            claimed = store.spark.read.parquet(events).select("event_id", F.lit("PENDING").alias("status"), F.lit(0).cast(
                "long").alias("records_processed"), F.lit(None).cast("string").alias("error_message"))
            _change_events(store, claimed, now, seq, "status = 'IN_PROGRESS'")
        _close(store, r.run_id, ["stopped before its end"], now, seq)
    return [r.run_id for r in stopped]


def _change_events(store: LogStore, changes: DataFrame, now: str, seq: int, only: str = "true") -> None:
    """M6 for the events of ``changes`` whose rows are as ``only`` says."""
    at = F.lit(now).cast("timestamp_ntz")
    current = store.read("fallback_events").where(only).join(changes.select("event_id"), "event_id", "left_semi")
    store.write("fallback_events", materialize(merge.event_state_change(current, changes, at)), seq=seq, changed_at=at)


def run_replay(store: LogStore, source: DataFrame, registry: DataFrame, *, run_id: str, root: str, to_json, now: str,
               seq: int, layer: str = "RAW", on_step: Callable[[str], None] = lambda step: None) -> str:
    """Replay every pending event of ``layer`` whose table has a contract:
    claimed, landed under ``root/replay=<run_id>`` with their event, counted
    from what was landed, completed, or FAILED whatever the error was in.
    Checkpoints do not move.  Steps take ``seq`` and the number after it."""
    spark, at = store.spark, F.lit(now).cast("timestamp_ntz")
    _open(store, run_id, layer, now, seq)
    on_step("opened")
    mine = _kept(spark, f"{_notes(root, run_id)}/events", lambda: select.known_events(
        select.pending_events(store.read("fallback_events"), layer), registry))
    on_step("chosen")
    counts: list[DataFrame] = []

    def replay() -> None:
        _change_events(store, ingest.claim_events(mine), now, seq, "status = 'PENDING'")
        on_step("claimed")
        path, complete = _attempt(spark, f"{root}/replay={run_id}")
        if not complete:
            rows = to_json(select.replay_select(source, mine)).select("event_id", "table_name", "id", "updated_at", "raw")
            rows.write.parquet(path)
            on_step("landed")
        found = spark.read.parquet(path).groupBy("event_id").agg(F.count(F.lit(1)).alias("n"))
        counts.append(materialize(mine.join(found, "event_id", "left").select(
            "event_id", F.lit("COMPLETED").alias("status"), F.coalesce("n", F.lit(0)).cast("long").alias("records_processed"),
            F.lit(None).cast("string").alias("error_message"))))

    ms, error = _tried(replay)
    done = ingest.fail_events(mine, error) if error else counts[0]
    _change_events(store, done, now, seq + 1, "status NOT IN ('COMPLETED', 'FAILED')")
    on_step("changed")
    log = mine.join(done.select("event_id", F.col("records_processed").alias("n")), "event_id").select(
        F.xxhash64(F.lit(run_id), "event_id").alias("batch_id"), F.lit(run_id).alias("run_id"), "table_name", "layer",
        F.lit("SUCCESS" if error is None else "FAILED").alias("status"), F.col("start_watermark").alias("cursor_value"),
        F.lit(0).alias("offset_value"), F.col("n").cast("int").alias("records_count"), F.lit(ms).alias("duration_ms"),
        F.format_string("updated_at between %d and %d", "start_watermark", "end_watermark").alias("query_sent"),
        F.lit(error).cast("string").alias("error_message"), at.alias("created_at"))
    _, logged = _tried(lambda: store.insert("batch_logs", log, seq=seq, changed_at=at))
    on_step("logged")
    return _close(store, run_id, [e for e in (error, logged) if e], now, seq + 1)


def run(store: LogStore, source: DataFrame, registry: DataFrame, *, run_id: str, root: str, to_json, now: str, seq: int,
        layer: str = "RAW", native_time: str | None = None,
        on_step: Callable[[str], None] = lambda step: None) -> tuple[str, str]:
    """One run: stopped runs are recovered; then a replay if known events are
    pending, else incremental.  A run that was stopped and is called again
    stays what it was.  (mode, status)."""
    spark = store.spark
    recover(store, run_id=run_id, root=root, now=now, seq=seq, layer=layer)
    begun = {kind: landing.done(spark, f"{_notes(root, run_id)}/{kind}") for kind in ("events", "work")}
    if not any(begun.values()):
        pending = select.known_events(select.pending_events(store.read("fallback_events"), layer), registry)
        begun["events"] = not pending.isEmpty()
    if begun["events"]:
        return "replay", run_replay(store, source, registry, run_id=run_id, root=root, to_json=to_json, now=now, seq=seq,
                                    layer=layer, on_step=on_step)
    return "incremental", run_incremental(store, source, registry, run_id=run_id, root=root, to_json=to_json, now=now,
                                          seq=seq, layer=layer, native_time=native_time, on_step=on_step)


def landed_runs(spark, root: str, run_ids: list[str]) -> DataFrame:
    """(table_name, id, updated_at, raw) of everything the runs committed."""
    paths = [r.path for run_id in run_ids for r in committed(spark, root, run_id)]
    rows = spark.read.schema(landing.RUN_ROWS).parquet(*paths) if paths else spark.createDataFrame([], landing.RUN_ROWS)
    return rows.select("table_name", "id", "updated_at", "raw")
