"""Log tables and the append-only change log.

Parquet tables have no UPDATE or MERGE and cannot be overwritten while being
read.  Keyed state is therefore kept as a change log: every write appends
the new versions of rows with a change time and sequence; readers take the
latest version per key (an aggregate, so hot keys are combined map-side);
``compact`` writes the latest versions to a *new* folder.
"""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.operators.merge import latest_per_key

# -- S8: the five log tables ---------------------------------------------------------
# Column names and order of the source system's log tables.
LOG_TABLES: dict[str, str] = {
    "ingestion_runs": ("run_id string, started_at timestamp_ntz, completed_at timestamp_ntz, layer string, "
                       "status string, error_message string"),
    "ingestion_checkpoints": ("table_name string, current_watermark bigint, fallback_watermark bigint, "
                              "last_id bigint, layer string, offset_val int, is_override_active boolean, "
                              "last_successful_run_id string, updated_at timestamp_ntz"),
    "fallback_events": ("event_id string, table_name string, layer string, start_watermark bigint, "
                        "end_watermark bigint, status string, records_processed bigint, error_message string, "
                        "created_at timestamp_ntz, completed_at timestamp_ntz"),
    "batch_logs": ("batch_id bigint, run_id string, table_name string, layer string, status string, "
                   "cursor_value bigint, offset_value int, records_count int, duration_ms int, query_sent string, "
                   "error_message string, created_at timestamp_ntz"),
    "schema_history": ("id bigint, table_name string, schema_hash string, columns_snapshot string, "
                       "changed_columns array<string>, detected_at timestamp_ntz, detected_in_run_id string, "
                       "included_at timestamp_ntz, status string, action_taken string"),
}

# Keys and NOT NULL columns, checked on write since parquet does not.
LOG_KEYS = {"ingestion_runs": ["run_id"], "ingestion_checkpoints": ["table_name"],
            "fallback_events": ["event_id"], "batch_logs": ["run_id", "table_name", "batch_id"],
            "schema_history": ["table_name", "schema_hash"]}
LOG_REQUIRED = {
    "ingestion_runs": ["run_id", "started_at", "layer", "status"],
    "ingestion_checkpoints": ["table_name", "current_watermark", "fallback_watermark", "last_id", "layer",
                              "offset_val", "is_override_active", "updated_at"],
    "fallback_events": ["event_id", "table_name", "layer", "start_watermark", "end_watermark", "status"],
    "batch_logs": ["run_id", "table_name", "layer", "status", "cursor_value", "offset_value", "records_count",
                   "duration_ms", "created_at"],
    "schema_history": ["table_name", "schema_hash", "columns_snapshot", "detected_at", "status"],
}


def log_schema(name: str) -> T.StructType:
    return T.StructType.fromDDL(LOG_TABLES[name])


def create_log_tables(spark: SparkSession, location: str, *, prefix: str = "logs_") -> list[str]:
    """``CREATE TABLE IF NOT EXISTS ... USING parquet`` for the five tables
    under ``location``; returns the table names."""
    names = []
    for name, ddl in LOG_TABLES.items():
        full = f"{prefix}{name}"
        spark.sql(f"CREATE TABLE IF NOT EXISTS {full} ({ddl}) USING parquet "
                  f"LOCATION '{location.rstrip('/')}/{name}'")
        names.append(full)
    return names


def not_null_violations_flag(name: str) -> Column:
    """True for a row breaking one of the table's NOT NULL columns."""
    cond = None
    for c in LOG_REQUIRED[name]:
        e = F.col(c).isNull()
        cond = e if cond is None else (cond | e)
    return cond


def not_null_violations(df: DataFrame, name: str) -> DataFrame:
    """Rows breaking the table's NOT NULL columns (the check parquet does
    not make)."""
    return df.where(not_null_violations_flag(name))


# -- S6 / S7 ---------------------------------------------------------------------------
_MODES = {"append": "append", "fail": "errorifexists", "replace": "overwrite"}


def read_table(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """Whole table by path; an absent table reads as empty with ``schema``."""
    from tidemark.sources.landing import _exists
    if not _exists(spark, path):
        if schema is None:
            raise FileNotFoundError(path)
        return spark.createDataFrame([], schema)
    return spark.read.parquet(path)


def write_table(df: DataFrame, path: str, if_table_exists: str = "append",
                partition_by: list[str] | None = None) -> None:
    """Write with the source system's modes: append, fail, replace (the
    whole table, every partition)."""
    w = df.write.mode(_MODES[if_table_exists])
    if if_table_exists == "replace":
        w = w.option("partitionOverwriteMode", "static")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)


# -- change log -----------------------------------------------------------------------
def append_changes(df: DataFrame, path: str, *, changed_at: Column, seq: int,
                   partition_by: list[str] | None = None) -> None:
    """Append new row versions (M3 for logs, M1-M8 results for keyed
    tables) with the change time and a writer sequence number (the run or
    the stream's epoch)."""
    out = df.withColumn("_changed_at", changed_at).withColumn("_seq", F.lit(int(seq)).cast("long"))
    w = out.write.mode("append")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)


def read_latest(spark: SparkSession, path: str, key, order: list[str] | None = None,
                schema: T.StructType | None = None) -> DataFrame:
    """The current table: latest version per key by ``order`` (default:
    change time and sequence), ties to the later write."""
    from tidemark.sources.landing import _exists
    if not _exists(spark, path):
        if schema is None:
            raise FileNotFoundError(path)
        return spark.createDataFrame([], schema)
    log = spark.read.parquet(path)
    ordering = [*(order or []), "_changed_at", "_seq"]
    keys = [key] if isinstance(key, str) else list(key)
    keep = [c for c in log.columns if c not in keys]
    return latest_per_key(log, keys, ordering, keep=keep).drop("_changed_at", "_seq")


def compact(spark: SparkSession, path: str, new_path: str, key, order: list[str] | None = None,
            partition_by: list[str] | None = None) -> None:
    """Write the latest versions to ``new_path`` (never over the folder
    being read); readers switch to it afterwards."""
    if new_path.rstrip("/") == path.rstrip("/"):
        raise ValueError("compact into a new folder, not over the one being read")
    cur = read_latest(spark, path, key, order)
    out = cur.withColumn("_changed_at", F.current_timestamp().cast("timestamp_ntz")).withColumn(
        "_seq", F.lit(0).cast("long"))
    w = out.write.mode("errorifexists")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(new_path)


# -- keyed change log --------------------------------------------------------------------
class KeyedLog:
    """Append-only change log of a keyed table in the folder ``path``.

    The key is stored beside the data (``_key.json``) and checked on every
    use, so a log cannot be read or appended to under another key.  Nothing
    else decides how it is read: there is no catalog entry, no bucket count
    and no session setting that a restart could change.  ``latest`` combines
    versions on the map side, so a key with many versions is one row per task
    before the shuffle; ``compact_into`` drops the superseded versions."""

    def __init__(self, path: str, key):
        self.path = path.rstrip("/")
        self.key = [key] if isinstance(key, str) else list(key)

    def _check(self, spark: SparkSession, create: bool = False) -> bool:
        """True if the log exists; its stored key must be ours."""
        jvm = spark.sparkContext._jvm
        note = jvm.org.apache.hadoop.fs.Path(f"{self.path}/_key.json")
        fs = note.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
        if not fs.exists(note):
            if create:
                out = fs.create(note, True)
                out.write(bytearray(json.dumps(self.key).encode()))
                out.close()
            return create
        stream = fs.open(note)
        try:
            stored = json.loads(jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
        finally:
            stream.close()
        if stored != self.key:
            raise ValueError(f"{self.path} is keyed by {stored}, not by {self.key}")
        return True

    def exists(self, spark: SparkSession) -> bool:
        return self._check(spark)

    def append(self, df: DataFrame, *, changed_at: Column, seq: int) -> None:
        self._check(df.sparkSession, create=True)
        append_changes(df, f"{self.path}/rows", changed_at=changed_at, seq=seq)

    def latest(self, spark: SparkSession, order: list[str] | None = None) -> DataFrame:
        """Latest version per key by ``order``, then change time and
        sequence (a retried append is hidden)."""
        if not self._check(spark):
            raise FileNotFoundError(self.path)
        return read_latest(spark, f"{self.path}/rows", self.key, order)

    def versions(self, spark: SparkSession) -> DataFrame:
        """Every stored version, superseded ones included."""
        return spark.read.parquet(f"{self.path}/rows")

    def compact_into(self, spark: SparkSession, other: "KeyedLog", order: list[str] | None = None) -> None:
        """Write the latest versions into another (new, empty) log."""
        if other.path == self.path:
            raise ValueError("compact into a new folder, not over the one being read")
        other.append(self.latest(spark, order), changed_at=F.current_timestamp().cast("timestamp_ntz"), seq=0)
