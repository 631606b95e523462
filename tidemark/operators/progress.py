"""Paging arithmetic and high-water marks.

The source system walks a table page by page and carries its progress in
loop variables.  Here the whole selection is numbered once in
``(updated_at, id)`` order (keyset order, no overlapping re-reads) and every
per-page quantity is a grouped aggregate over that numbering:

* page = (row - 1) div page_size;
* offset = page * page_size mod wrap; block = page * page_size div wrap;
* the cursor of block b is the highest ``updated_at`` of block b - 1, the
  table's cursor for block 0;
* the running watermark after a page is the larger of the page's highest
  ``struct(updated_at, id)`` and the stored ``(cursor, last_id)``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.contracts import OFFSET_WRAP, PAGE_SIZE
from tidemark.operators.joins import checked_broadcast
from tidemark.operators.sequence import row_index
from tidemark.session import materialize


# -- A4 + A5 ----------------------------------------------------------------------
def high_watermark(selected: DataFrame, *, group: str = "table_name", order: str = "updated_at",
                   key: str = "id") -> DataFrame:
    """Per table: highest ``order`` value and the largest ``key`` at it, plus
    the row count.  ``max(struct(ts, id))`` is an ordinary partial
    aggregate: a table holding a third of the rows is pre-aggregated on every
    map task.  Rows without ``order`` or ``key`` count but set no mark."""
    hw = F.max(F.when(F.col(order).isNotNull() & F.col(key).isNotNull(),
                      F.struct(F.col(order).alias("ts"), F.col(key).alias("id"))))
    return (selected.groupBy(group)
                    .agg(hw.alias("__hw"), F.count(F.lit(1)).alias("records"))
                    .select(group, F.col("__hw.ts").alias("max_updated_at"), F.col("__hw.id").alias("last_id"),
                            "records"))


def advance_checkpoints(work: DataFrame, selected: DataFrame, *, order: str = "updated_at",
                        key: str = "id") -> DataFrame:
    """New checkpoint per work item after a complete run: the larger of the
    stored ``(cursor, last_id)`` and the selection's high-water mark; offset
    back to 0.  Tables with nothing selected keep their cursor."""
    hw = high_watermark(selected, order=order, key=key)
    seed = F.struct(F.col("cursor").alias("ts"), F.col("last_id").alias("id"))
    seen = F.struct(F.col("max_updated_at").alias("ts"), F.col("hw_id").alias("id"))
    best = F.greatest(seed, seen)
    return (work.join(hw.withColumnRenamed("last_id", "hw_id"), "table_name", "left")
                .select("table_name",
                        best.ts.alias("current_watermark"),
                        best.id.alias("last_id"),
                        F.lit(0).cast("int").alias("offset_val"),
                        F.coalesce(F.col("records"), F.lit(0)).cast("long").alias("records")))


# -- W3 ------------------------------------------------------------------------------
def page_numbers(row_no, page_size: int = PAGE_SIZE, wrap: int = OFFSET_WRAP) -> dict:
    """page_no, block_no and offset_value of a 1-based row number."""
    page = F.floor((row_no - 1) / page_size).cast("long")
    return {"page_no": page, "block_no": F.floor(page * page_size / wrap).cast("long"),
            "offset_value": ((page * page_size) % wrap).cast("int")}


def assign_pages(selected: DataFrame, *, page_size: int = PAGE_SIZE, wrap: int = OFFSET_WRAP,
                 group: str = "table_name", order: tuple[str, ...] = ("updated_at", "id")) -> DataFrame:
    """Add ``row_no`` (1-based per table, counted from the cursor),
    ``page_no``, ``block_no`` and ``offset_value``.

    A table that was interrupted is read again from its cursor: rows that
    were landed before land again under the same key and the latest-row merge
    hides them.  A stored offset never skips rows, as the order behind it may
    have changed since."""
    numbered = row_index(selected, group, list(order), name="row_no")
    return numbered.withColumns(page_numbers(F.col("row_no"), page_size, wrap))


def block_cursors(blocks: DataFrame, group: str = "table_name") -> DataFrame:
    """``blocks`` (group, block_no, high) with ``before``: the ``high`` of the
    block before.  Blocks are cut in keyset order, so the highest mark before
    a block is that of its predecessor: a join, not a window over a table."""
    prior = blocks.select(group, (F.col("block_no") + 1).alias("block_no"), F.col("high").alias("before"))
    return blocks.join(prior, [group, "block_no"], "left")


# -- A6 + A8 + W1 + W2 + W4 -----------------------------------------------------------
def page_summary(paged: DataFrame, work: DataFrame | None = None, *, page_size: int = PAGE_SIZE,
                 wrap: int = OFFSET_WRAP, group: str = "table_name", order: str = "updated_at",
                 key: str = "id") -> DataFrame:
    """One row per page: records (A6), first and last key, the page's own
    high-water mark, the running watermark and ``last_id`` after it (W1,
    W2), the block cursor the page was read from (W4), and whether it is the
    last page (A8: shorter than a page).

    Pages are cut in keyset order, so the running mark after a page is the
    larger of its own mark and the stored ``(cursor, last_id)``, and a block's
    cursor is the mark of the block before.  The page table (one row per
    ``page_size`` records) is written once and everything else derives from
    it by equi-joins: no window, no second pass over the records.  With
    ``work`` (one row per table: cursor, last_id) a table whose selection is
    empty or ends on a page boundary gets the terminal empty page the source
    system asks for.  Keys and marks are those of rows that have both
    ``order`` and ``key``; the others count as records only."""
    rn = F.when(F.col(order).isNotNull() & F.col(key).isNotNull(), F.col("row_no"))
    mark = lambda t, i: F.struct(F.col(t).alias("ts"), F.col(i).alias("id"))
    # min_by / max_by over the row number keep fixed-width buffers (a hash aggregate).
    pages = materialize(
        paged.groupBy(group, "page_no", "block_no", "offset_value")
             .agg(F.count(F.lit(1)).cast("long").alias("records"),
                  F.min_by(F.col(order), rn).alias("lo_ts"), F.min_by(F.col(key), rn).alias("lo_id"),
                  F.max_by(F.col(order), rn).alias("hi_ts"), F.max_by(F.col(key), rn).alias("hi_id")))
    blocks = block_cursors(pages.groupBy(group, "block_no").agg(
        F.max(mark("hi_ts", "hi_id")).alias("high"), F.min("lo_ts").alias("low"), F.sum("records").alias("n")), group)
    none = F.lit(None).cast(pages.select(mark("hi_ts", "hi_id")).schema[0].dataType)
    if work is not None:
        seeds = checked_broadcast(work.select(group, F.struct(F.col("cursor").alias("ts"),
                                                              F.col("last_id").alias("id")).alias("seed")))
        blocks = blocks.join(seeds, group, "left").withColumn("block_cursor", F.greatest("before", "seed").getField("ts"))
    else:
        blocks = blocks.withColumn("seed", none).withColumn("block_cursor", F.coalesce(F.col("before.ts"), F.col("low")))
    running = F.greatest(mark("hi_ts", "hi_id"), F.col("seed"))
    out = (pages.join(blocks.select(group, "block_no", "seed", "block_cursor"), [group, "block_no"])
                .select(group, "page_no", "block_no", "offset_value",
                        F.col("block_cursor").cast("long").alias("cursor_value"), "records",
                        F.col("lo_id").alias("first_id"), F.col("hi_id").alias("page_last_id"),
                        F.col("hi_ts").alias("page_max_updated_at"),
                        running.ts.alias("running_watermark"), running.id.alias("running_last_id"),
                        (F.col("records") < page_size).alias("is_last")))
    if work is None:
        return out
    per_table = blocks.groupBy(group).agg(
        F.sum("n").alias("total"), F.max(F.greatest("high", "seed")).alias("top"),
        F.max_by("block_cursor", "block_no").alias("last_cursor"))
    t = (work.select(group, "cursor", "last_id").join(per_table, group, "left")
             .withColumn("total", F.coalesce("total", F.lit(0)).cast("long"))
             .where(F.col("total") % page_size == 0))
    end = (F.col("total") / page_size).cast("long")
    top = F.coalesce("top", F.struct(F.col("cursor").alias("ts"), F.col("last_id").alias("id")))
    wrapped = (F.col("total") > 0) & (F.col("total") % wrap == 0)
    null = F.lit(None).cast("long")
    terminal = t.select(
        group, end.alias("page_no"), F.floor(end * page_size / wrap).cast("long").alias("block_no"),
        ((end * page_size) % wrap).cast("int").alias("offset_value"),
        F.when(wrapped, top.ts).otherwise(F.coalesce("last_cursor", "cursor")).cast("long").alias("cursor_value"),
        F.lit(0).cast("long").alias("records"), null.alias("first_id"), null.alias("page_last_id"),
        null.alias("page_max_updated_at"), top.ts.cast("long").alias("running_watermark"),
        top.id.cast("long").alias("running_last_id"), F.lit(True).alias("is_last"))
    return out.unionByName(terminal)


def cursor_advance(paged: DataFrame, *, group: str = "table_name", order: str = "updated_at") -> DataFrame:
    """W4 per block: rows, highest ``order`` of the block, and the cursor the
    next block starts from (= that highest value)."""
    return (paged.groupBy(group, "block_no")
                 .agg(F.count(F.lit(1)).alias("records"), F.max(order).alias("block_max_updated_at"))
                 .withColumn("next_cursor", F.col("block_max_updated_at")))
