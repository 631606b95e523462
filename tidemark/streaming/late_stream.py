"""Late records of a stream.

A stream of source records knows a mark per table: the largest time that an
earlier micro-batch has brought.  Records below it came late.  They go to a
side output and are asked for again as replay windows (M7), one per table and
micro-batch; the others are the stream's table.

The marks are the stream's only state, a row per table and micro-batch in a
keyed log, so state does not grow with the records, and a table that brings a
third of them is not one task's work: records meet the marks by a broadcast
that is checked, are written once, and the new marks come from a pruned read of
what was written.  A micro-batch that is tried again overwrites its own folder,
sees the marks from before it, and asks for the same windows.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tidemark.operators import merge
from tidemark.operators.joins import checked_broadcast
from tidemark.plans.api import LogStore
from tidemark.session import literal_frame
from tidemark.sources import tables

MARKS = "table_name string, mark bigint"


@dataclass
class LatePaths:
    landing: str      # parquet files with table_name, id, updated_at and any other columns
    rows: str         # the records, by micro-batch and by whether they came late
    marks: str        # keyed log of marks
    checkpoint: str

    def marks_log(self) -> tables.KeyedLog:
        return tables.KeyedLog(self.marks, "table_name")


def marks_before(spark: SparkSession, paths: LatePaths, epoch: int) -> DataFrame:
    """The marks that micro-batches before ``epoch`` have left."""
    log = paths.marks_log()
    if not log.exists(spark):
        return literal_frame(spark, [], MARKS)
    return log.versions(spark).where(F.col("_seq") < epoch).groupBy("table_name").agg(F.max("mark").alias("mark"))


def split_late(batch: DataFrame, marks: DataFrame) -> DataFrame:
    """``batch`` with ``late``: below the mark of its table.  Records without
    a time are not late."""
    found = batch.join(checked_broadcast(marks), "table_name", "left")
    return found.withColumn("late", F.coalesce(F.col("updated_at") < F.col("mark"), F.lit(False))).drop("mark")


def take_batch(batch: DataFrame, epoch: int, paths: LatePaths, store: LogStore, layer: str = "RAW") -> None:
    """One micro-batch: split, written, marks moved, windows asked for."""
    spark = batch.sparkSession
    folder = f"{paths.rows}/epoch={epoch}"
    split_late(batch, marks_before(spark, paths, epoch)).write.mode("overwrite").partitionBy("late").parquet(folder)
    schema = StructType([*batch.schema.fields]).add("late", "boolean")
    written = spark.read.schema(schema).parquet(folder)
    at = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz") + F.make_dt_interval(secs=F.lit(epoch))
    top = written.where("NOT late").groupBy("table_name").agg(F.max("updated_at").alias("mark")).where(
        "table_name IS NOT NULL AND mark IS NOT NULL")
    paths.marks_log().append(top, changed_at=at, seq=epoch)
    windows = written.where("late").groupBy("table_name").agg(
        F.min("updated_at").alias("start_watermark"), F.max("updated_at").alias("end_watermark")).withColumn(
        "layer", F.lit(layer))
    asked = merge.new_events(windows, at, ["table_name", "layer", "start_watermark", "end_watermark"])
    store.insert("fallback_events", asked, seq=epoch, changed_at=at)


def run_late_stream(spark: SparkSession, schema, paths: LatePaths, store: LogStore, *, layer: str = "RAW",
                    max_files_per_trigger: int = 1000) -> int:
    """Takes everything that has landed so far; the number of micro-batches."""
    stream = spark.readStream.option("maxFilesPerTrigger", max_files_per_trigger).option(
        "recursiveFileLookup", "true").schema(schema).parquet(paths.landing)
    done: list[int] = []

    def each(batch: DataFrame, epoch: int) -> None:
        take_batch(batch, epoch, paths, store, layer)
        done.append(epoch)

    query = (stream.writeStream.trigger(availableNow=True).option("checkpointLocation", paths.checkpoint)
                   .foreachBatch(each).start())
    query.awaitTermination()
    return len(done)


def read_rows(spark: SparkSession, schema: StructType, paths: LatePaths, late: bool) -> DataFrame:
    """What came late, or in time, with its micro-batch."""
    whole = StructType([*schema.fields]).add("epoch", "integer").add("late", "boolean")
    return spark.read.schema(whole).parquet(paths.rows).where(F.col("late") == late).drop("late")
