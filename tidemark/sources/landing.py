"""Raw landing zone: write pages, read them back record by record
(SURVEY S1, S2, S4, S5, S9, F8).

A run lands parquet files with the place of every record (``write_run``).
Two page layouts are written and read as well:

* **partitioned** (what ``write_pages`` produces):
  ``<base>/endpoint=<e>/cursor=<c>/offset=<o>/part-*.txt``, one JSON object
  per line.  The writer uses dynamic partition overwrite, so rewriting a page
  replaces that page only (last write wins per ``(endpoint, cursor, offset)``).
* **array files** as the source system stores them:
  ``<base>/<endpoint>/<cursor>_<offset>.json``, each a JSON array of records.

Either way the output is one row per record with its raw text, so one bad
record never spoils the rest of its page.
"""

from __future__ import annotations

import logging

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.contracts import OFFSET_WRAP, PAGE_SIZE
from tidemark.functions.scalars import page_path_parts

log = logging.getLogger("tidemark.landing")

RAW_SCHEMA = T.StructType([
    T.StructField("endpoint", T.StringType()),
    T.StructField("cursor", T.LongType()),
    T.StructField("offset", T.IntegerType()),
    T.StructField("position", T.IntegerType()),
    T.StructField("raw", T.StringType()),
])

_PART_DIR = r"endpoint=([^/]+)/cursor=(-?\d+)/offset=(\d+)/"
_BLOCK_DIR = r"endpoint=([^/]+)/cursor=(-?\d+)/"


def _empty(spark: SparkSession, path: str) -> DataFrame:
    """A missing page folder reads as nothing, with a warning (first runs)."""
    log.warning("landing path %s not found; reading no records", path)
    return spark.createDataFrame([], RAW_SCHEMA)


def _exists(spark: SparkSession, path: str) -> bool:
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return bool(fs.exists(p))


# -- S5 -------------------------------------------------------------------------------
def encode_records(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """One JSON object per record (null fields left out, as ``json.dumps``
    of a dict without them would)."""
    cols = columns or df.columns
    return df.select(F.to_json(F.struct(*[F.col(c) for c in cols])).alias("raw"))


# -- S1 -------------------------------------------------------------------------------
# Layouts of the partitioned landing zone.  "page": one folder per page, one
# raw JSON object per line (the source system's granularity).  "block": one
# folder per cursor block (up to 10,000 records), each line an envelope
# {"offset": ..., "raw": "..."}; twenty times fewer files for large volumes.
ENVELOPE = "offset int, raw string"


def write_pages(records: DataFrame, base: str, *, endpoint: str = "endpoint", cursor: str = "cursor_value",
                offset: str = "offset_value", value: str = "raw", layout: str = "page",
                cluster: bool = True) -> None:
    """Land records under their page (or block) folder.

    With ``cluster`` rows are hash-clustered by folder before the write so
    that each folder is written by one task; callers whose rows already come
    in page order (the run's range-partitioned row index) pass ``False`` and
    skip that shuffle (a page cut by a range boundary gets two files).
    Dynamic partition overwrite replaces only the folders present in
    ``records``, so a retried or re-run page replaces itself."""
    rows = records.select(F.regexp_replace(F.col(endpoint), "^/", "").alias("endpoint"),
                          F.col(cursor).cast("long").alias("cursor"), F.col(offset).cast("int").alias("offset"),
                          F.col(value).alias("raw"))
    if layout == "page":
        keys = ["endpoint", "cursor", "offset"]
        out = rows.withColumnRenamed("raw", "value")
        (out.repartition(*keys) if cluster else out).write.mode("overwrite") \
            .option("partitionOverwriteMode", "dynamic").partitionBy(*keys).text(base)
    elif layout == "block":
        keys = ["endpoint", "cursor"]
        (rows.repartition(*keys) if cluster else rows).write.mode("overwrite") \
            .option("partitionOverwriteMode", "dynamic").partitionBy(*keys).json(base)
    else:
        raise ValueError(f"unknown landing layout {layout!r}")


# -- S1 / S2: a run's landing folder ---------------------------------------------------
# The layout a run writes: parquet files of any size, rows in page order, each
# with its place (writing task and position).  Pages are derived from places
# when read, so a page is no file of its own and its key stays unique when many
# records share a second.
RUN_ROWS = "table_name string, endpoint string, cursor bigint, id bigint, updated_at bigint, raw string, part int, pos bigint"


def write_run(rows: DataFrame, path: str) -> None:
    """Land rows (table_name, endpoint, cursor, id, updated_at, raw) of a run.
    They move once, by range of (table, updated_at, id), so a hot table is
    cut into as many ranges as its size asks for."""
    order = ["table_name", "updated_at", "id", F.xxhash64("raw")]
    placed = (rows.repartitionByRange(*order).sortWithinPartitions(*order)
                  .withColumns({"part": F.spark_partition_id(), "pos": F.monotonically_increasing_id()}))
    typed = [F.col(n).cast(t).alias(n) for n, t in (c.split() for c in RUN_ROWS.split(", "))]
    placed.select(*typed).write.parquet(path)


def done(spark: SparkSession, path: str) -> bool:
    """True if a write to ``path`` has ended."""
    return _exists(spark, f"{path}/_SUCCESS")


def _placed_schema(schema: T.StructType) -> T.StructType:
    return T.StructType([*schema.fields, T.StructField("part", T.IntegerType()), T.StructField("pos", T.LongType())])


def stage_run(rows: DataFrame, path: str) -> None:
    """The selection of a run, for all its tables: one scan, one shuffle by
    range of (table, updated_at, id), a folder per table."""
    order = ["table_name", "updated_at", "id"]
    ties = [c for c, t in rows.dtypes if c not in order and not t.startswith(("map", "variant"))]
    placed = (rows.repartitionByRange(*order).sortWithinPartitions(*order, F.xxhash64(*(ties or order)))
                  .withColumns({"part": F.spark_partition_id(), "pos": F.monotonically_increasing_id()}))
    placed.write.mode("overwrite").partitionBy("table_name").parquet(path)


def land_table(spark: SparkSession, staged: str, schema: T.StructType, table: str, endpoint: str, path: str, to_json) -> None:
    """Land one table of a staged selection: its folder alone is read, and
    nothing moves.  ``to_json`` adds the ``raw`` text of each record (S5)."""
    rows = spark.read.schema(_placed_schema(schema)).parquet(staged).where(F.col("table_name") == table)
    made = to_json(rows).withColumn("endpoint", F.lit(endpoint))
    typed = [F.col(n).cast(t).alias(n) for n, t in (c.split() for c in RUN_ROWS.split(", "))]
    made.select(*typed).write.parquet(path)


def landed_keys(spark: SparkSession, path: str) -> DataFrame:
    """(table_name, id, updated_at) of a landed run: a pruned read, for marks."""
    return spark.read.schema(RUN_ROWS).parquet(path).select("table_name", "id", "updated_at")


def read_run(spark: SparkSession, path: str) -> DataFrame:
    """The records of a landed run without their pages (loads need none)."""
    rows = spark.read.schema(RUN_ROWS).option("recursiveFileLookup", "true").parquet(path)
    return run_records(rows)


def run_records(rows: DataFrame) -> DataFrame:
    """RUN_ROWS rows as RAW_SCHEMA rows; also used by the stream."""
    none = F.lit(None).cast("int")
    return rows.select("endpoint", "cursor", none.alias("offset"), none.alias("position"), "raw")


def read_run_pages(spark: SparkSession, path: str, *, page_size: int = PAGE_SIZE, wrap: int = OFFSET_WRAP,
                   columns: tuple[str, ...] = ("raw",)) -> DataFrame:
    """The records of one landed run with page_no, block_no, offset_value and
    the cursor their block was read from.  Row numbers come from a table of
    spans (a row per table and writing task, broadcast after a count)."""
    from tidemark.operators.joins import checked_broadcast
    from tidemark.operators.progress import block_cursors, page_numbers
    from tidemark.session import materialize

    rows = spark.read.schema(RUN_ROWS).parquet(path)
    spans = rows.groupBy("table_name", "part").agg(F.count(F.lit(1)).alias("n"), F.min("pos").alias("first"))
    before = Window.partitionBy("table_name").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    spans = materialize(spans.withColumn("before", F.coalesce(F.sum("n").over(before), F.lit(0))).drop("n"))
    number = F.col("pos") - F.col("first") + F.col("before") + 1
    numbered = rows.join(checked_broadcast(spans), ["table_name", "part"]).withColumns(page_numbers(number, page_size, wrap))
    blocks = block_cursors(numbered.groupBy("table_name", "block_no").agg(F.max("updated_at").alias("high")))
    starts = materialize(blocks.select("table_name", "block_no", F.col("before").alias("block_start")))
    return (numbered.drop("before").join(checked_broadcast(starts), ["table_name", "block_no"])
            .select("table_name", "endpoint", "page_no", "block_no", "offset_value",
                    F.coalesce("block_start", "cursor").alias("cursor_value"), *columns))


# -- S2 + S4 --------------------------------------------------------------------------
def read_pages(spark: SparkSession, base: str, *, endpoint: str | None = None, layout: str = "page") -> DataFrame:
    """Records of the partitioned layout: endpoint (with its leading slash),
    cursor, offset, position in the page file, raw text.  A missing folder
    gives an empty frame."""
    path = base if endpoint is None else f"{base.rstrip('/')}/endpoint={endpoint.lstrip('/')}"
    if not _exists(spark, path):
        return _empty(spark, path)
    reader = spark.read.option("basePath", base)
    if layout == "block":
        df = reader.schema(ENVELOPE).json(path).select("offset", "raw", F.col("_metadata.file_path").alias("__p"))
    else:
        df = reader.text(path).select("value", F.col("_metadata.file_path").alias("__p"))
    return pages_from_lines(df, layout)


def pages_from_lines(lines: DataFrame, layout: str = "page") -> DataFrame:
    """File rows -> RAW_SCHEMA rows: endpoint and cursor (and, for pages,
    offset) come from the folder names.  Also used by the stream, whose file
    source does not discover partitions."""
    p = F.col("__p")
    if layout == "block":
        return lines.select(
            F.concat(F.lit("/"), F.regexp_extract(p, _BLOCK_DIR, 1)).alias("endpoint"),
            F.regexp_extract(p, _BLOCK_DIR, 2).cast("long").alias("cursor"),
            F.col("offset").cast("int").alias("offset"),
            F.lit(None).cast("int").alias("position"),
            F.col("raw"))
    return lines.where(F.length(F.trim("value")) > 0).select(
        F.concat(F.lit("/"), F.regexp_extract(p, _PART_DIR, 1)).alias("endpoint"),
        F.regexp_extract(p, _PART_DIR, 2).cast("long").alias("cursor"),
        F.regexp_extract(p, _PART_DIR, 3).cast("int").alias("offset"),
        F.lit(None).cast("int").alias("position"),
        F.col("value").alias("raw"))


def read_array_pages(spark: SparkSession, base: str, *, endpoint: str | None = None) -> DataFrame:
    """Records of array files ``<endpoint>/<cursor>_<offset>.json``: each
    file is read whole (a page is at most a few hundred records), split with
    ``from_json(array<string>)`` and exploded with its position.  Empty pages
    yield no rows; a missing folder gives an empty frame."""
    folder = base.rstrip("/") + ("/*" if endpoint is None else "/" + endpoint.lstrip("/"))
    if endpoint is not None and not _exists(spark, folder):
        return _empty(spark, folder)
    if endpoint is None and not _exists(spark, base):
        return _empty(spark, base)
    files = spark.read.text(f"{folder}/*.json", wholetext=True).select(
        "value", F.col("_metadata.file_path").alias("__p"))
    ep, cur, off = page_path_parts(F.col("__p"))
    items = files.select(ep.alias("endpoint"), cur.alias("cursor"), off.alias("offset"),
                         F.posexplode(F.from_json("value", "array<string>")).alias("position", "raw"))
    return items.select("endpoint", "cursor", "offset", F.col("position").cast("int"), "raw")


def page_counts(raw: DataFrame) -> DataFrame:
    """A6 over landed data: records per page."""
    return raw.groupBy("endpoint", F.col("cursor").alias("cursor_value"), F.col("offset").alias("offset_value")) \
              .agg(F.count(F.lit(1)).alias("records"))
