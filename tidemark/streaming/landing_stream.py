"""Landing zone -> typed table as a Structured Streaming job.

The source system resumes from a stored ``(cursor, offset)`` after each
page.  Here the landing folder is the stream's source: each new page file is
picked up once (the file source's checkpoint records which files were read),
``trigger(availableNow=True)`` processes everything landed so far and stops,
and a restart continues where the checkpoint left off.

Each micro-batch is parsed record-wise, split into good and quarantined rows,
and appended to change logs; the target table is read as the latest row per
key, so a page processed twice (a batch retried after a failure, or the
same record landed on two pages) leaves the table unchanged (R2).
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.contracts import Contract
from tidemark.operators import quality
from tidemark.sources import landing, tables


@dataclass
class StreamPaths:
    landing: str       # landing folder (runs, or pages in one of their layouts)
    target: str        # change log of good records, by the contract key
    quarantine: str    # change log of rejected records, by endpoint and text
    checkpoint: str    # the stream's own checkpoint folder

    def target_log(self, contract: Contract) -> tables.KeyedLog:
        return tables.KeyedLog(self.target, contract.key)

    def quarantine_log(self) -> tables.KeyedLog:
        return tables.KeyedLog(self.quarantine, ["endpoint", "record_hash"])


def load_batch(raw: DataFrame, contract: Contract, paths: StreamPaths, seq: int, changed_at) -> None:
    """Parse, flag and append one batch of raw records (S9 for a batch)."""
    parsed = quality.parse_records(raw, contract)
    flagged = quality.flag_records(parsed, contract).persist()
    try:
        good, bad = quality.split_good_quarantine(flagged, contract)
        paths.target_log(contract).append(good, changed_at=changed_at, seq=seq)
        # Keyed by its text: a bad record that lands again is one row.
        hashed = bad.select("endpoint", F.sha2("raw", 256).alias("record_hash"), "cursor", "offset", "raw", "quality_issue")
        paths.quarantine_log().append(hashed, changed_at=changed_at, seq=seq)
    finally:
        flagged.unpersist()


def run_landing_stream(spark: SparkSession, contract: Contract, paths: StreamPaths, *,
                       max_files_per_trigger: int = 1000, layout: str = "page") -> int:
    """Process every page landed so far (availableNow) and return the
    number of micro-batches run."""
    reader = spark.readStream.option("maxFilesPerTrigger", max_files_per_trigger)
    if layout == "run":
        rows = reader.schema(landing.RUN_ROWS).option("recursiveFileLookup", "true").parquet(paths.landing)
    elif layout == "block":
        lines = (reader.schema(landing.ENVELOPE).json(paths.landing)
                       .select("offset", "raw", F.col("_metadata.file_path").alias("__p")))
    else:
        lines = reader.format("text").load(paths.landing).select("value", F.col("_metadata.file_path").alias("__p"))
    raw = landing.run_records(rows) if layout == "run" else landing.pages_from_lines(lines, layout)
    batches = []

    def each(batch: DataFrame, epoch: int) -> None:
        load_batch(batch, contract, paths, epoch, F.current_timestamp().cast("timestamp_ntz"))
        batches.append(epoch)

    q = (raw.writeStream.trigger(availableNow=True)
            .option("checkpointLocation", paths.checkpoint)
            .foreachBatch(each)
            .start())
    q.awaitTermination()
    return len(batches)


def current_table(spark: SparkSession, paths: StreamPaths, contract: Contract) -> DataFrame:
    """The target as of now: latest version per key by ``updated_at``."""
    return paths.target_log(contract).latest(spark, [contract.order])


def dedupe_stream(stream: DataFrame, key: str, ts_col: str, delay: str = "1 hour") -> DataFrame:
    """R2 for an append-only sink: drop re-reads of the same ``(key,
    ts_col)`` arriving within ``delay`` of each other (state is bounded by
    the watermark)."""
    return stream.withWatermark(ts_col, delay).dropDuplicatesWithinWatermark([key, ts_col])
