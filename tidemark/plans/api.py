"""The operational API as DataFrame functions.

Each route of the source system's dashboard becomes a function of a
``LogStore`` (the five log tables kept as change logs in a shared folder) returning a DataFrame; list routes take the text search and sort of
P11.  Writes (override, new replay event) append new row versions, so a
retried request leaves the same state.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators import merge, select
from tidemark.plans import reports
from tidemark.session import literal_frame
from tidemark.sources import tables

# Order used to pick the current version of a row in each table.
_VERSION_ORDER = {"ingestion_runs": [], "ingestion_checkpoints": ["updated_at"], "fallback_events": [],
                  "batch_logs": [], "schema_history": []}


class LogStore:
    """The five log tables under ``root``, each a ``KeyedLog`` on its key."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")
        self.logs = {name: tables.KeyedLog(f"{self.root}/{name}", tables.LOG_KEYS[name]) for name in tables.LOG_TABLES}

    def write(self, name: str, rows: DataFrame, *, seq: int, changed_at: Column | None = None) -> None:
        """New versions of rows: the last write of a key counts."""
        cols = tables.log_schema(name).names
        typed = rows.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in tables.log_schema(name).fields])
        bad = tables.not_null_violations(typed, name)
        if not bad.isEmpty():
            raise ValueError(f"rows for {name} break its NOT NULL columns")
        at = changed_at if changed_at is not None else F.current_timestamp().cast("timestamp_ntz")
        self.logs[name].append(typed.select(*cols), changed_at=at, seq=seq)

    def insert(self, name: str, rows: DataFrame, *, seq: int, changed_at: Column | None = None) -> None:
        """Insert-if-absent (M1, M4): keys that are there keep their rows; of
        new rows of one key the first by its columns counts."""
        keys, cols = tables.LOG_KEYS[name], tables.log_schema(name).names
        first = rows.groupBy(*keys).agg(F.min(F.struct(*cols)).alias("r")).select("r.*")
        self.write(name, first.join(self.read(name).select(*keys), keys, "left_anti"), seq=seq, changed_at=changed_at)

    def read(self, name: str) -> DataFrame:
        """Current rows of a table (empty with its schema if never written)."""
        log = self.logs[name]
        if not log.exists(self.spark):
            return self.spark.createDataFrame([], tables.log_schema(name))
        return log.latest(self.spark, _VERSION_ORDER[name]).select(*tables.log_schema(name).names)


def search_and_sort(df: DataFrame, q: str | None = None, sort_by: str | None = None, descending: bool = False,
                    columns: list[str] | None = None, limit: int | None = None) -> DataFrame:
    """The list toolbar: case-insensitive search over the shown columns
    of the whole list, a sort on any column (ties by the others), then the
    list's length."""
    out = df if not q else select.text_filter(df, columns or df.columns, q)
    if sort_by:
        first = F.col(sort_by).desc() if descending else F.col(sort_by).asc()
        plain = [c for c, t in df.dtypes if c != sort_by and not t.startswith(("map", "variant"))]
        out = out.orderBy(first, *plain)
    return out if limit is None else out.limit(limit)


# -- GET routes ---------------------------------------------------------------------------
def stats(store: LogStore) -> DataFrame:
    """GET /api/stats."""
    return reports.kpi_summary(store.read("ingestion_runs"), store.read("ingestion_checkpoints"),
                               store.read("batch_logs"), store.read("schema_history"))


def runs(store: LogStore, limit: int = 50, q: str | None = None, sort_by: str | None = None,
         descending: bool = False) -> DataFrame:
    """GET /api/runs?limit=."""
    return search_and_sort(reports.runs_history(store.read("ingestion_runs"), None), q, sort_by, descending, limit=limit)


def checkpoints(store: LogStore, q: str | None = None, sort_by: str | None = None, descending: bool = False) -> DataFrame:
    """GET /api/checkpoints."""
    return search_and_sort(reports.checkpoint_list(store.read("ingestion_checkpoints")), q, sort_by, descending)


def fallback_events(store: LogStore, limit: int = 50, q: str | None = None, sort_by: str | None = None,
                    descending: bool = False) -> DataFrame:
    """GET /api/fallback-events."""
    return search_and_sort(reports.event_history(store.read("fallback_events"), None), q, sort_by, descending,
                           limit=limit)


def batches(store: LogStore, limit: int = 100, table_name: str | None = None, q: str | None = None,
            sort_by: str | None = None, descending: bool = False) -> DataFrame:
    """GET /api/batches?limit=&table_name=."""
    return search_and_sort(reports.recent_batches(store.read("batch_logs"), None, table_name,
                                                  tie_break=("batch_id", "run_id")), q, sort_by, descending, limit=limit)


def schema_history(store: LogStore, q: str | None = None, sort_by: str | None = None,
                   descending: bool = False) -> DataFrame:
    """GET /api/schema-history: one row per changed column with its observed
    type, newest first."""
    return search_and_sort(reports.drift_list(store.read("schema_history")), q, sort_by, descending)


# -- POST routes --------------------------------------------------------------------------
def override_checkpoint(store: LogStore, table_name: str, custom_watermark: int | None = None,
                        activate_fallback: bool = True, *, now: str, seq: int) -> bool:
    """POST /api/checkpoints/override: True when a checkpoint matched."""
    spark = store.spark
    req = literal_frame(spark, [(table_name, custom_watermark, activate_fallback)],
                        "table_name string, custom_watermark bigint, activate_fallback boolean")
    current = store.read("ingestion_checkpoints")
    hit = merge.matched_keys(current, req, "table_name")
    changed = merge.override_checkpoint(current.join(hit, "table_name", "left_semi"), req,
                                        F.lit(now).cast("timestamp_ntz"))
    if changed.isEmpty():
        return False
    store.write("ingestion_checkpoints", changed, seq=seq)
    return True


def create_fallback_event(store: LogStore, table_name: str, start_watermark: int, end_watermark: int,
                          layer: str = "RAW", *, now: str, seq: int) -> DataFrame:
    """POST /api/fallback-events: a PENDING event; both bounds required, no
    start <= end check (as in the source system).  The id is derived from
    the request and its time ``now``: a retried request creates one event and
    leaves one that is under way alone, a later request for the same window
    is a new event."""
    spark = store.spark
    req = literal_frame(spark, [(table_name, layer, int(start_watermark), int(end_watermark))],
                        "table_name string, layer string, start_watermark bigint, end_watermark bigint")
    row = merge.new_events(req, F.lit(now).cast("timestamp_ntz"),
                           ["table_name", "layer", "start_watermark", "end_watermark"])
    store.insert("fallback_events", row, seq=seq)
    return row.select("event_id", "table_name", "layer", "start_watermark", "end_watermark", "status",
                      "created_at")
