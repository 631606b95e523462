"""Keyed mutations as DataFrame -> DataFrame functions.

Parquet tables have no MERGE or UPDATE, so each mutation returns the new
state of the table; ``tidemark.sources.tables`` stores it as an append-only
change log read back through ``latest_per_key``.

Latest-row selection is an aggregate (``max`` of a struct whose first fields
are the ordering), never ``row_number`` over a per-key window: the aggregate
is combined on the map side, so a key holding a third of all rows never
reaches one task whole.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.scalars import on_status


def _keys(key) -> list[str]:
    return [key] if isinstance(key, str) else list(key)


# -- W6 ---------------------------------------------------------------------------------
def latest_per_key(df: DataFrame, key, order: list[Column | str], *, keep: list[str] | None = None) -> DataFrame:
    """One row per key: the row with the greatest ``order`` tuple (nulls
    lowest).  Rows equal on ``order`` are ranked by their remaining columns,
    so the choice is deterministic."""
    keys = _keys(key)
    cols = keep or [c for c in df.columns if c not in keys]
    ord_cols = [F.col(o) if isinstance(o, str) else o for o in order]
    packed = F.struct(*[o.alias(f"__o{i}") for i, o in enumerate(ord_cols)],
                      F.struct(*[F.col(c) for c in cols]).alias("__row"))
    best = df.groupBy(*keys).agg(F.max(packed).alias("__best"))
    return best.select(*keys, *[F.col(f"__best.__row.{c}").alias(c) for c in cols])


# -- M8 + R2 ----------------------------------------------------------------------------
def upsert_latest(target: DataFrame, batch: DataFrame, key, order: str = "updated_at") -> DataFrame:
    """Latest-row upsert by ``key``: for each key the row with the highest
    ``order``; on a tie the incoming row wins.  Applying the same batch twice
    gives the same table (idempotent under re-reads).

    This form re-aggregates the whole target; a stored target takes the batch
    as an append to its ``sources.tables.KeyedLog`` instead."""
    cols = target.columns
    t = target.withColumn("__incoming", F.lit(0))
    b = batch.select(*cols).withColumn("__incoming", F.lit(1))
    both = t.unionByName(b)
    out = latest_per_key(both, key, [order, "__incoming"], keep=[c for c in cols if c not in _keys(key)])
    return out.select(*cols)


# -- M1 / M4 ----------------------------------------------------------------------------
def insert_if_absent(target: DataFrame, new_rows: DataFrame, key, *, order: list[str] | None = None) -> DataFrame:
    """``INSERT ... ON CONFLICT DO NOTHING``: rows of ``new_rows`` whose key
    is not in ``target`` are appended; among new rows sharing a key the first
    in ``order`` (default: all columns) is kept."""
    keys = _keys(key)
    cols = target.columns
    rest = [c for c in cols if c not in keys]
    ordering = [F.col(c) for c in (order or rest)]
    # One row per new key first (a map-side combined aggregate), so the
    # anti-join below sees unique keys and no hot key lands on one task.
    first = (new_rows.groupBy(*keys)
                     .agg(F.min(F.struct(*[o.alias(f"__o{i}") for i, o in enumerate(ordering)],
                                         F.struct(*[F.col(c) for c in rest]).alias("__row"))).alias("__m"))
                     .select(*keys, *[F.col(f"__m.__row.{c}").alias(c) for c in rest]))
    # The keys that are there already come from a semi-join, whose small side
    # the planner broadcasts by its measured size: a small batch does not
    # shuffle the target.
    there = target.select(*keys).join(first.select(*keys), keys, "left_semi").distinct()
    return target.unionByName(first.join(there, keys, "left_anti").select(*cols))


# -- M2 / M7b ---------------------------------------------------------------------------
def one_per_key(rows: DataFrame, key) -> DataFrame:
    """One row per key, the greatest by its remaining columns: two updates of
    one key must not double the row they update."""
    keys = _keys(key)
    rest = [c for c in rows.columns if c not in keys]
    return latest_per_key(rows, keys, rest, keep=rest) if rest else rows.distinct()


def keyed_update(target: DataFrame, updates: DataFrame, key, set_cols: dict[str, Column]) -> DataFrame:
    """``UPDATE target SET c = expr WHERE key = updates.key``.

    Of several updates of one key the greatest row counts (``one_per_key``);
    ``set_cols`` maps a target column to a Column over the current row (its own names) and the update
    row (names prefixed ``u__``).  Unmatched updates change nothing."""
    keys = _keys(key)
    u = one_per_key(updates, keys).withColumn("__matched", F.lit(True))
    u = u.select(*[F.col(c).alias(f"u__{c}") if c not in keys else F.col(c) for c in u.columns])
    joined = target.join(u, keys, "left")
    matched = F.col("u____matched").isNotNull()
    out = []
    for c in target.columns:
        if c in set_cols:
            out.append(F.when(matched, set_cols[c]).otherwise(F.col(c)).alias(c))
        else:
            out.append(F.col(c))
    return joined.select(*out)


def update_one(target: DataFrame, key: str, value, set_cols: dict[str, Column]) -> DataFrame:
    """``UPDATE target SET c = expr WHERE key = value`` for a single key: a
    projection, no join.  New values may be scalar subqueries
    (``DataFrame.scalar()``), evaluated once."""
    hit = F.col(key) == F.lit(value)
    return target.select(*[F.when(hit, set_cols[c]).otherwise(F.col(c)).alias(c) if c in set_cols else F.col(c)
                           for c in target.columns])


def matched_keys(target: DataFrame, updates: DataFrame, key) -> DataFrame:
    """The keys of ``updates`` that hit a row (``rowcount > 0`` per key)."""
    keys = _keys(key)
    return updates.select(*keys).join(target.select(*keys), keys, "left_semi")


# -- M5 / M5b ---------------------------------------------------------------------------
def upsert_columns(target: DataFrame, incoming: DataFrame, key, columns: list[str],
                   defaults: dict[str, Column] | None = None) -> DataFrame:
    """``INSERT ... ON CONFLICT (key) DO UPDATE SET`` the listed columns.

    Existing rows take the listed columns from ``incoming`` and keep the
    others; new keys take the listed columns and ``defaults`` (or null) for
    the rest.  Of several incoming rows of one key the greatest counts."""
    keys = _keys(key)
    defaults = defaults or {}
    inc = one_per_key(incoming.select(*keys, *columns), keys)
    inc = inc.select(*keys, *[F.col(c).alias(f"i__{c}") for c in columns]).withColumn("__in", F.lit(True))
    cur = target.withColumn("__cur", F.lit(True))
    joined = cur.join(inc, keys, "full_outer")
    out = []
    for c in target.columns:
        if c in keys:
            out.append(F.col(c))
        elif c in columns:
            out.append(F.when(F.col("__in").isNotNull(), F.col(f"i__{c}")).otherwise(F.col(c)).alias(c))
        else:
            d = defaults.get(c, F.lit(None))
            out.append(F.when(F.col("__cur").isNull(), d.cast(target.schema[c].dataType))
                        .otherwise(F.col(c)).alias(c))
    return joined.select(*out)


# -- M6 ---------------------------------------------------------------------------------
TERMINAL = ("COMPLETED", "FAILED")


def event_state_change(events: DataFrame, changes: DataFrame, now: Column) -> DataFrame:
    """Apply status changes to replay events: status replaced, the count
    added to ``records_processed``, ``error_message`` replaced (also by
    null), ``completed_at`` set to ``now`` only for a terminal status.

    ``changes``: event_id, status, records_processed, error_message."""
    return keyed_update(events, changes, "event_id", {
        "status": F.col("u__status"),
        "records_processed": (F.coalesce(F.col("records_processed"), F.lit(0))
                              + F.coalesce(F.col("u__records_processed"), F.lit(0))).cast("long"),
        "error_message": F.col("u__error_message"),
        "completed_at": on_status("u__status", TERMINAL, now, F.col("completed_at")),
    })


# -- M7 ---------------------------------------------------------------------------------
def new_events(requests: DataFrame, created_at: Column, id_cols: list[str]) -> DataFrame:
    """Replay-event rows from requests (table_name, layer, start_watermark,
    end_watermark): PENDING, zero records, an id derived from ``id_cols`` and
    the time of the request, so that a retry of one request is idempotent and
    a later request for the same window is an event of its own.  No start <=
    end check, as in the source system."""
    from tidemark.functions.scalars import natural_uuid
    return requests.select(
        natural_uuid(*id_cols, created_at).alias("event_id"), "table_name",
        F.coalesce(F.col("layer"), F.lit("RAW")).alias("layer"),
        F.col("start_watermark").cast("long").alias("start_watermark"),
        F.col("end_watermark").cast("long").alias("end_watermark"),
        F.lit("PENDING").alias("status"), F.lit(0).cast("long").alias("records_processed"),
        F.lit(None).cast("string").alias("error_message"),
        created_at.alias("created_at"), F.lit(None).cast("timestamp_ntz").alias("completed_at"))


def override_checkpoint(checkpoints: DataFrame, requests: DataFrame, now: Column) -> DataFrame:
    """Per request (table_name, custom_watermark or null,
    activate_fallback) set ``is_override_active``, the fallback watermark
    when given, and ``updated_at``.  Tables not requested are unchanged."""
    return keyed_update(checkpoints, requests, "table_name", {
        "fallback_watermark": F.coalesce(F.col("u__custom_watermark"), F.col("fallback_watermark")),
        "is_override_active": F.col("u__activate_fallback"),
        "updated_at": now,
    })


def run_completion(runs: DataFrame, outcomes: DataFrame, now: Column) -> DataFrame:
    """M2 for runs: status and error text from ``outcomes`` (run_id, status,
    error_message), ``completed_at`` = now."""
    return keyed_update(runs, outcomes, "run_id", {
        "status": F.col("u__status"),
        "error_message": F.col("u__error_message"),
        "completed_at": now,
    })
