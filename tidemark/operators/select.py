"""Choosing what to read: work items, watermark selection, page queries and
replay windows (SURVEY S3, P1-P5, P9, L6-L8, J1-J4, J2a, U2)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.contracts import PAGE_SIZE, Contract
from tidemark.functions.scalars import clamp_limit, epoch_literal_ntz
from tidemark.operators.joins import checked_broadcast, range_join

CHECKPOINT_COLUMNS = ("table_name", "current_watermark", "fallback_watermark", "last_id", "layer",
                      "offset_val", "is_override_active")


# -- J2a + U2: seed missing checkpoints ---------------------------------------
def seed_checkpoints(registry: DataFrame, checkpoints: DataFrame, layer: str = "RAW") -> DataFrame:
    """Existing checkpoints of ``layer`` plus one seed row (watermark = the
    table's start) for each registered table that has none."""
    cps = checkpoints.where(F.col("layer") == layer).select(*CHECKPOINT_COLUMNS)
    # Checkpoints are keyed by table; the planner broadcasts them by their
    # measured size, no hint needed.
    missing = registry.join(cps.select("table_name"), "table_name", "left_anti")
    seeds = missing.select(
        "table_name",
        F.col("start_watermark").cast("long").alias("current_watermark"),
        F.col("start_watermark").cast("long").alias("fallback_watermark"),
        F.lit(0).cast("long").alias("last_id"),
        F.lit(layer).alias("layer"),
        F.lit(0).cast("int").alias("offset_val"),
        F.lit(False).alias("is_override_active"))
    return cps.unionByName(seeds)


def unseeded_tables(registry: DataFrame, checkpoints: DataFrame, layer: str = "RAW") -> DataFrame:
    """J2a alone: registered tables with no checkpoint in ``layer``."""
    cps = checkpoints.where(F.col("layer") == layer).select("table_name")
    return registry.join(cps, "table_name", "left_anti")


# -- J3 + P9: work items ------------------------------------------------------
def work_items(registry: DataFrame, checkpoints: DataFrame, layer: str = "RAW") -> DataFrame:
    """One row per registered table: the cursor to read from (stored
    watermark when positive, else the table's start), the stored ``last_id``
    and ``offset``.  Registry and checkpoints hold one row per table."""
    cps = seed_checkpoints(registry, checkpoints, layer)
    cursor = F.when(F.col("current_watermark") > 0, F.col("current_watermark")).otherwise(F.col("start_watermark"))
    return (registry.join(cps, "table_name")
                    .select("table_name", "endpoint", "page_size",
                            cursor.cast("long").alias("cursor"),
                            F.col("last_id").cast("long").alias("last_id"),
                            F.col("offset_val").cast("int").alias("offset_val")))


# -- S3 + P3: incremental selection --------------------------------------------
def incremental_select(source: DataFrame, work: DataFrame, *, order: str = "updated_at",
                       native_time: str | None = None) -> DataFrame:
    """Source rows at or after their table's cursor (inclusive, so ties at
    the high-water second are read again; the latest-row merge makes that
    idempotent), with ``cursor``, ``last_id`` and the stored ``offset_val``
    of the table attached (0 where they are not stored).  Rows with no
    ``order`` value are before no cursor: every run reads them, for the load
    to quarantine.

    The work table holds one row per table and is joined (broadcast after a
    count, shuffled beyond it).  The smallest cursor is pushed into the scan,
    on ``native_time`` too if that names the timestamp ``order`` comes from."""
    offset = F.col("offset_val") if "offset_val" in work.columns else F.lit(0)
    items = work.where(F.col("cursor").isNotNull()).select(
        "table_name", "cursor", F.coalesce(F.col("last_id"), F.lit(0)).cast("long").alias("last_id"),
        F.coalesce(offset, F.lit(0)).cast("int").alias("offset_val"))
    low = items.agg(F.min("cursor")).first()[0]
    src = source
    if low is not None:
        src = src.where(F.col(order).isNull() | (F.col(order) >= F.lit(int(low))))
        if native_time is not None:
            src = src.where(F.col(native_time).isNull() | (F.col(native_time) >= epoch_literal_ntz(int(low))))
    return src.join(checked_broadcast(items), "table_name").where(
        F.col(order).isNull() | (F.col(order) >= F.col("cursor")))


def watermark_filter(df: DataFrame, watermark: int, order: str = "updated_at",
                     native_time: str | None = None) -> DataFrame:
    """P3 for one table: ``order >= watermark``, left out when 0."""
    if not watermark:
        return df
    out = df.where(F.col(order) >= F.lit(int(watermark)))
    if native_time is not None:
        out = out.where(F.col(native_time) >= epoch_literal_ntz(int(watermark)))
    return out


# -- P1 P2 P4 L6-L8: one page query -------------------------------------------
def page_query(df: DataFrame, *, contract: Contract | None = None, columns: list[str] | None = None,
               last_update_value: int = 0, filters: str = "", sort: tuple[str, ...] = ("updated_at", "id"),
               limit: int = PAGE_SIZE, offset: int = 0, native_time: str | None = None) -> DataFrame:
    """Fields, inclusive watermark, extra filter (AND-ed), sort with the key
    as tie-break, limit capped at the page size, offset.  Plans to a single
    ``TakeOrderedAndProject``."""
    out = watermark_filter(df, last_update_value, native_time=native_time)
    if filters:
        out = out.where(F.expr(f"({filters})"))
    if contract is not None:
        out = out.select(*contract.projection())
    elif columns:
        out = out.select(*columns)
    out = out.orderBy(*[F.col(c).asc() for c in sort])
    if offset:
        out = out.offset(int(offset))
    return out.limit(clamp_limit(limit))


# -- J1 / J2b: replay events with and without a contract ---------------------
def known_events(events: DataFrame, registry: DataFrame) -> DataFrame:
    return events.join(registry.select("table_name"), "table_name", "left_semi")


def unknown_events(events: DataFrame, registry: DataFrame) -> DataFrame:
    return events.join(registry.select("table_name"), "table_name", "left_anti")


# -- P7: pending events of a layer --------------------------------------------
def pending_events(events: DataFrame, layer: str = "RAW") -> DataFrame:
    return events.where((F.col("status") == "PENDING") & (F.col("layer") == layer))


# -- P5 + J4: replay windows ----------------------------------------------------
def replay_select(source: DataFrame, events: DataFrame, *, order: str = "updated_at") -> DataFrame:
    """Source rows inside each event's closed window ``[start, end]`` on the
    event's table.  One output row per (event, record): two events over one
    table are both replayed."""
    ev = events.select("event_id", "table_name", "start_watermark", "end_watermark")
    joined = range_join(source, ev, key="table_name", point=order, start="start_watermark",
                        end="end_watermark")
    src_cols = [F.col(f"__l.{c}").alias(c) for c in source.columns]
    return joined.select(F.col("__w.event_id").alias("event_id"), *src_cols)


def replay_counts(source: DataFrame, events: DataFrame, *, order: str = "updated_at") -> DataFrame:
    """Records per event, zero for events whose window or table matches
    nothing.  The count is a partial aggregate over the joined rows; the left
    join back to the (small) events keeps zero-row events."""
    counts = replay_select(source, events, order=order).groupBy("event_id").agg(
        F.count(F.lit(1)).alias("records_processed"))
    return (events.select("event_id", "table_name", "start_watermark", "end_watermark")
                  .join(counts, "event_id", "left")
                  .withColumn("records_processed", F.coalesce(F.col("records_processed"), F.lit(0)).cast("long")))


def text_filter(df: DataFrame, columns: list[str], needle: str) -> DataFrame:
    """Case-insensitive substring search over the given columns."""
    hay = F.lower(F.concat_ws(" ", *[F.col(c).cast("string") for c in columns]))
    return df.where(F.contains(hay, F.lower(F.lit(needle))))


def optional_eq(col: str, value) -> Column:
    """``value IS NULL OR col = value``: always-true when unset."""
    return F.lit(True) if value is None else (F.col(col) == F.lit(value))
