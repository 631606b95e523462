"""Whole-run plans: an incremental run and a replay run as one DataFrame
job each (SURVEY 3.1 and 3.2).

The source system loops table by table and page by page.  Here the plan is
``source x broadcast(work items) -> filter -> page numbering -> grouped
progress``; the driver only plans, executors scan, shuffle and write.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.contracts import OFFSET_WRAP, PAGE_SIZE
from tidemark.operators import progress, select
from tidemark.operators.joins import checked_broadcast
from tidemark.session import materialize


@dataclass
class IncrementalRun:
    work: DataFrame          # one row per table: cursor, last_id, offset
    selected: DataFrame      # source rows at or after their cursor
    checkpoints: DataFrame   # new checkpoint per table


def plan_incremental(source: DataFrame, registry: DataFrame, checkpoints: DataFrame, *,
                     layer: str = "RAW", native_time: str | None = None) -> IncrementalRun:
    # One row per table, written once: every use below sees the same cursors.
    work = materialize(select.work_items(registry, checkpoints, layer))
    chosen = select.incremental_select(source, work, native_time=native_time)
    new_cps = progress.advance_checkpoints(work, chosen)
    return IncrementalRun(work=work, selected=chosen, checkpoints=new_cps)


def run_pages(run: IncrementalRun, *, page_size: int = PAGE_SIZE, wrap: int = OFFSET_WRAP) -> DataFrame:
    """Per-page progress of an incremental run (what the source system logs
    one batch at a time)."""
    # Number only the keys: the row index materialises its input.
    keys = run.selected.select("table_name", "id", "updated_at")
    paged = progress.assign_pages(keys, page_size=page_size, wrap=wrap)
    return progress.page_summary(paged, run.work, page_size=page_size, wrap=wrap)


def land_run(run: IncrementalRun, path: str, to_json) -> None:
    """S1 for a run: its selection as landed rows (``landing.write_run``).
    ``to_json`` adds the ``raw`` text of each selected record (S5)."""
    from tidemark.sources import landing

    endpoints = checked_broadcast(run.work.select("table_name", "endpoint"))
    landing.write_run(to_json(run.selected).join(endpoints, "table_name"), path)


def plan_replay(source: DataFrame, events: DataFrame, registry: DataFrame, *, layer: str = "RAW") -> dict:
    """Replay every pending event of ``layer`` whose table has a contract;
    events for unknown tables stay pending and are reported."""
    pending = select.pending_events(events, layer)
    known = select.known_events(pending, registry)
    return {
        "rows": select.replay_select(source, known),
        "counts": select.replay_counts(source, known),
        "unknown": select.unknown_events(pending, registry),
    }


def plan_run(source: DataFrame, registry: DataFrame, checkpoints: DataFrame, events: DataFrame, *,
             layer: str = "RAW", native_time: str | None = None) -> dict:
    """One run's plan.  Pending events of ``layer`` whose table has a
    contract are replayed first and the checkpoints stay where they are;
    only a run with no such event reads incrementally.  Events for unknown
    tables never block a run (they are reported)."""
    pending_known = select.known_events(select.pending_events(events, layer), registry)
    if not pending_known.isEmpty():
        return {"mode": "replay", **plan_replay(source, events, registry, layer=layer)}
    return {"mode": "incremental", "run": plan_incremental(source, registry, checkpoints, layer=layer,
                                                           native_time=native_time)}


def start_run(runs: DataFrame, run_id: str, layer: str, started_at: str) -> DataFrame:
    """M1: the run's RUNNING row, inserted only if the id is new."""
    from tidemark.operators import merge
    from tidemark.session import literal_frame

    row = literal_frame(runs.sparkSession, [(run_id, started_at, None, layer, "RUNNING", None)],
                        "run_id string, started_at timestamp_ntz, completed_at timestamp_ntz, layer string, "
                        "status string, error_message string")
    return merge.insert_if_absent(runs, row.select(*runs.columns), "run_id")


def claim_events(known: DataFrame) -> DataFrame:
    """Status changes marking claimed events IN_PROGRESS (M6 input)."""
    return known.select("event_id", F.lit("IN_PROGRESS").alias("status"),
                        F.lit(0).cast("long").alias("records_processed"),
                        F.lit(None).cast("string").alias("error_message"))


def fail_events(known: DataFrame, message: str) -> DataFrame:
    """Status changes marking events FAILED with the error text, whatever
    stage failed (M6 input)."""
    return known.select("event_id", F.lit("FAILED").alias("status"),
                        F.lit(0).cast("long").alias("records_processed"),
                        F.lit(message).alias("error_message"))
