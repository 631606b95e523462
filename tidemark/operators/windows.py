"""Overlapping replay windows as disjoint intervals.

The edges of all windows of a table, swept in order, cut its time line into
intervals that no window begins or ends inside of.  A record lies in one of
them at most, so it is joined and landed once however many windows cover it,
and what a window holds is a difference of two running counts over the
intervals: nothing is ever paired with every window that covers it.  Edges are
numbered by a range shuffle and summed by blocks, so a table with most of the
windows is not one task's work.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.operators.joins import range_join
from tidemark.operators.sequence import row_index
from tidemark.session import materialize

#: Rows of a key that one window function sums.
BLOCK = 4096


def running_sum(df: DataFrame, key: str, index: str, values: dict[str, str], block: int = BLOCK) -> DataFrame:
    """``df`` with the running sums (name -> column) of each ``key`` in the
    order of ``index`` (1, 2, ... without gaps): sums of blocks, then of the
    rows inside a block."""
    rows = materialize(df.withColumn("__block", F.floor((F.col(index) - 1) / F.lit(block))))
    before = Window.partitionBy(key).orderBy("__block").rowsBetween(Window.unboundedPreceding, -1)
    blocks = rows.groupBy(key, "__block").agg(*[F.sum(c).alias(f"__{n}") for n, c in values.items()])
    blocks = blocks.select(key, "__block", *[F.coalesce(F.sum(f"__{n}").over(before), F.lit(0)).alias(f"__{n}") for n in values])
    inside = Window.partitionBy(key, "__block").orderBy(index).rowsBetween(Window.unboundedPreceding, 0)
    return (rows.withColumns({n: F.sum(c).over(inside) for n, c in values.items()})
                .join(blocks, [key, "__block"])
                .select(*df.columns, *[(F.col(n) + F.col(f"__{n}")).alias(n) for n in values]))


@dataclass
class Replay:
    intervals: DataFrame   # table_name, n, start, end, active: what windows cover, disjoint
    landed: DataFrame      # source rows in any window, once each, with their interval n
    bridge: DataFrame      # event_id, table_name, first_n, last_n: the intervals of each window
    counts: DataFrame      # event_id, table_name, start_watermark, end_watermark, records_processed


def window_edges(events: DataFrame) -> DataFrame:
    """(table_name, point, n, active, until): the edges of closed windows in
    order, how many windows cover the interval that begins there, and the
    next edge."""
    open_ = events.where("start_watermark <= end_watermark")
    steps = open_.select("table_name", F.col("start_watermark").alias("point"), F.lit(1).alias("step")).unionByName(
        open_.select("table_name", (F.col("end_watermark") + 1).alias("point"), F.lit(-1).alias("step")))
    edges = row_index(steps.groupBy("table_name", "point").agg(F.sum("step").alias("step")), "table_name", "point", "n")
    swept = materialize(running_sum(edges, "table_name", "n", {"active": "step"}).drop("step"))
    follows = swept.select("table_name", (F.col("n") - 1).alias("n"), F.col("point").alias("until"))
    return swept.join(follows, ["table_name", "n"], "left")


def replay_overlaps(source: DataFrame, events: DataFrame, *, order: str = "updated_at") -> Replay:
    """Every record of ``source`` inside any window, once, and the number of
    records of each window.  Windows that end before they start, have no
    bounds, or name a table without records hold nothing."""
    edges = materialize(window_edges(events))
    intervals = edges.where("active > 0").select("table_name", "n", F.col("point").alias("start"),
                                                 (F.col("until") - 1).alias("end"), "active")
    joined = range_join(source, intervals, key="table_name", point=order, start="start", end="end")
    landed = joined.select(*[F.col(f"__l.{c}").alias(c) for c in source.columns], F.col("__w.n").alias("n"))
    held = materialize(landed.groupBy("table_name", "n").agg(F.count(F.lit(1)).alias("records")))
    every = edges.select("table_name", "n", "point").join(held, ["table_name", "n"], "left").withColumn(
        "records", F.coalesce("records", F.lit(0)))
    sums = materialize(running_sum(every, "table_name", "n", {"upto": "records"})
                       .select("table_name", "point", "n", (F.col("upto") - F.col("records")).alias("before")))
    first = sums.select("table_name", F.col("point").alias("start_watermark"), F.col("n").alias("first_n"), F.col("before").alias("b1"))
    last = sums.select("table_name", (F.col("point") - 1).alias("end_watermark"), (F.col("n") - 1).alias("last_n"),
                       F.col("before").alias("b2"))
    found = (events.where("start_watermark <= end_watermark").select("event_id", "table_name", "start_watermark", "end_watermark")
                   .join(first, ["table_name", "start_watermark"]).join(last, ["table_name", "end_watermark"]))
    found = materialize(found)
    counts = events.select("event_id", "table_name", "start_watermark", "end_watermark").join(
        found.select("event_id", (F.col("b2") - F.col("b1")).alias("records_processed")), "event_id", "left").withColumn(
        "records_processed", F.coalesce("records_processed", F.lit(0)).cast("long"))
    return Replay(intervals, landed, found.select("event_id", "table_name", "first_n", "last_n"), counts)
