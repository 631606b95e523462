"""Governance reports over the log tables (SURVEY A1-A3, A9, A10, L1-L5,
P6-P8, P11, W5, F1, R3).

Each report is a function of DataFrames returning a DataFrame; a web layer
(not built) would serialise the rows.  Top-k reports sort by the requested
column and then by the table key, so ties resolve the same way every time.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.scalars import duration_seconds, safe_ratio
from tidemark.operators.select import optional_eq
from tidemark.operators.sequence import row_index


# -- A1 + A2 + A3 ------------------------------------------------------------------------
def kpi_summary(runs: DataFrame, checkpoints: DataFrame, batches: DataFrame, schema_history: DataFrame) -> DataFrame:
    """One row: total / completed / failed runs, tables, active overrides,
    records ingested (0 when there are no batches) and schema changes.

    The four tables are tagged and unioned into one narrow stream that a
    single conditional aggregate reads: one scan of each, one partial +
    final aggregation, no join."""
    zero = F.lit(None).cast("string")
    u = (runs.select(F.lit("r").alias("t"), F.col("status").alias("s"), F.lit(None).cast("boolean").alias("o"),
                     F.lit(None).cast("long").alias("n"))
         .unionByName(checkpoints.select(F.lit("c").alias("t"), zero.alias("s"),
                                         F.col("is_override_active").alias("o"), F.lit(None).cast("long").alias("n")))
         .unionByName(batches.select(F.lit("b").alias("t"), zero.alias("s"), F.lit(None).cast("boolean").alias("o"),
                                     F.col("records_count").cast("long").alias("n")))
         .unionByName(schema_history.select(F.lit("h").alias("t"), zero.alias("s"),
                                            F.lit(None).cast("boolean").alias("o"), F.lit(None).cast("long").alias("n"))))
    t = F.col("t")
    return u.agg(
        F.count_if(t == "r").alias("total_runs"),
        F.count_if((t == "r") & (F.col("s") == "COMPLETED")).alias("successful_runs"),
        F.count_if((t == "r") & (F.col("s") == "FAILED")).alias("failed_runs"),
        F.count_if(t == "c").alias("total_tables"),
        F.count_if((t == "c") & F.col("o")).alias("active_overrides"),
        F.coalesce(F.sum(F.when(t == "b", F.col("n"))), F.lit(0)).cast("long").alias("total_records_ingested"),
        F.count_if(t == "h").alias("total_schema_changes"))


def success_ratio(runs: DataFrame) -> DataFrame:
    """A10: completed / total runs (null when there are none)."""
    agg = runs.agg(F.count(F.lit(1)).alias("total_runs"),
                   F.count_if(F.col("status") == "COMPLETED").alias("successful_runs"),
                   F.count_if(F.col("status") == "FAILED").alias("failed_runs"))
    return agg.withColumn("success_ratio", F.round(safe_ratio("successful_runs", "total_runs"), 6)) \
              .withColumn("failure_ratio", F.round(safe_ratio("failed_runs", "total_runs"), 6))


# -- A9 ----------------------------------------------------------------------------------------
def run_status_rollup(batches: DataFrame) -> DataFrame:
    """Per run: FAILED if any of its batches failed, else COMPLETED."""
    failed = F.bool_or(F.col("status") == "FAILED")
    return batches.groupBy("run_id").agg(
        F.count(F.lit(1)).alias("batches"),
        F.count_if(F.col("status") == "FAILED").alias("failed_batches"),
        F.when(failed, "FAILED").otherwise("COMPLETED").alias("run_status"))


# -- L1 + F1 ----------------------------------------------------------------------------------
def _first(df: DataFrame, limit: int | None) -> DataFrame:
    return df if limit is None else df.limit(limit)


def runs_history(runs: DataFrame, limit: int | None = 50) -> DataFrame:
    return _first(runs.select("run_id", "started_at", "completed_at", "layer", "status", "error_message",
                        duration_seconds("started_at", "completed_at").alias("duration_seconds"))
                .orderBy(F.col("started_at").desc(), F.col("run_id").asc()), limit)


# -- L2 + P8 ----------------------------------------------------------------------------------
BATCH_COLUMNS = ("batch_id", "run_id", "table_name", "layer", "status", "cursor_value", "offset_value",
                 "records_count", "duration_ms", "query_sent", "error_message", "created_at")


def recent_batches(batches: DataFrame, limit: int | None = 100, table_name: str | None = None,
                   tie_break: tuple[str, ...] = ("batch_id",)) -> DataFrame:
    out = batches.where(optional_eq("table_name", table_name))   # P8: unset means all
    return _first(out.orderBy(F.col("created_at").desc(), *[F.col(c).asc() for c in tie_break]),
                  limit).select(*BATCH_COLUMNS)


# -- L3 ---------------------------------------------------------------------------------------
EVENT_COLUMNS = ("event_id", "table_name", "layer", "start_watermark", "end_watermark", "status",
                 "records_processed", "error_message", "created_at", "completed_at")


def event_history(events: DataFrame, limit: int | None = 50) -> DataFrame:
    return _first(events.orderBy(F.col("created_at").desc(), F.col("event_id").asc()), limit).select(*EVENT_COLUMNS)


# -- L4 + P6 ----------------------------------------------------------------------------------
def checkpoint_list(checkpoints: DataFrame, layer: str | None = None) -> DataFrame:
    out = checkpoints if layer is None else checkpoints.where(F.col("layer") == layer)
    return out.orderBy("table_name")


# -- L5 ---------------------------------------------------------------------------------------
def drift_list(schema_history: DataFrame) -> DataFrame:
    """One row per changed column of each drift row, newest first, with the
    column's observed JSON types from the stored snapshot (null for a required
    column that no record carries)."""
    types = F.from_json("columns_snapshot", "map<string,string>")
    rows = (schema_history.select("id", "table_name", "schema_hash", types.alias("t"),
                                  F.explode("changed_columns").alias("column_name"), "detected_at",
                                  "detected_in_run_id", "included_at", "status", "action_taken")
            .withColumn("data_type", F.try_element_at("t", "column_name")).drop("t"))
    return rows.orderBy(F.col("detected_at").desc(), "table_name", "column_name")


# -- P7 + W5 ---------------------------------------------------------------------------------
def pending_queue(events: DataFrame, layer: str = "RAW") -> DataFrame:
    """Pending events of a layer with their FIFO position (created_at, then
    event_id).  The position is a global row number computed without a
    single-task window."""
    pending = events.where((F.col("status") == "PENDING") & (F.col("layer") == layer)).withColumn("__all", F.lit(0))
    ranked = row_index(pending, "__all", ["created_at", "event_id"], name="fifo_position")
    return ranked.drop("__all")


# -- R3 ---------------------------------------------------------------------------------------
def late_rows(rows: DataFrame, loaded: DataFrame, watermark_ts, *, key: str, ts: str) -> DataFrame:
    """Rows older than the watermark that the target does not hold: the
    source system only sees them through a replay."""
    older = rows.where(F.col(ts) < watermark_ts)
    # distinct keys first (combined map-side), so the anti-join sees each once
    return older.join(loaded.select(key).distinct(), key, "left_anti")
