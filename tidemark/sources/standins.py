"""Engine inputs derived from the driver's parquet tables.

The source system's records and log tables are not shipped, so each input
is a projection of a driver table (FIXTURES.md section D).  Every function
reads whole tables; the matching DuckDB text in ``SQL`` defines the same
rows for the oracle check.

* ``source_records``: ``orders`` as five source tables (one per priority),
  ``id`` = order key, ``updated_at`` = Unix seconds of the order date.
* ``runs``: ``orders`` as ingestion runs, completed at the last ship date.
* ``batches``: ``lineitem`` as batch logs.
* ``replay_windows``: ``nation`` as replay events over the source tables.
* ``event_queue``: ``orders`` as a large replay-event queue.
* ``customer_state`` and friends: keyed targets for the mutations.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.contracts import Contract, table_contract
from tidemark.functions.scalars import epoch_seconds
from tidemark.session import literal_frame

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations")

# Fixed values of the stand-in: the five source tables are the order
# priorities; their contracts start on 1995-01-01 (first order date).
SOURCE_TABLES = ("1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW")
SOURCE_START = 788918400
RUN_TIME = "2024-06-01 00:00:00"


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def source_contracts() -> dict[str, Contract]:
    fields = [("id", "bigint", True), ("name", "string", True), ("updated_at", "bigint", False),
              ("o_custkey", "bigint", False), ("o_totalprice", "double", False)]
    return {t: table_contract(t, fields, endpoint=endpoint_of(t), start=SOURCE_START) for t in SOURCE_TABLES}


def endpoint_of(table: str) -> str:
    """``/`` + the lower-case table name with runs of other characters as
    ``_`` (safe as a folder name)."""
    return "/" + re.sub("[^a-z0-9]+", "_", table.lower())


ENDPOINT_SQL = "'/' || regexp_replace(lower(table_name), '[^a-z0-9]+', '_', 'g')"


def source_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = read(spark, sf_dir, "orders")
    return o.select(
        F.col("o_orderpriority").alias("table_name"),
        F.col("o_orderkey").alias("id"),
        epoch_seconds("o_orderdate").alias("updated_at"),
        F.concat_ws("-", F.col("o_orderstatus"), F.col("o_custkey").cast("string")).alias("name"),
        "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate")


def checkpoint_seed(spark: SparkSession) -> DataFrame:
    """Stored checkpoints of the stand-in: two tables have one, one of them
    with a zero watermark (falls back to the start); three have none."""
    rows = [("1-URGENT", 978307200, 0, 45, "RAW", 0, False),   # 2001-01-01, id 45 seen
            ("2-HIGH", 0, 0, 0, "RAW", 0, False)]
    schema = ("table_name string, current_watermark bigint, fallback_watermark bigint, last_id bigint, "
              "layer string, offset_val int, is_override_active boolean")
    return literal_frame(spark, rows, schema)


def runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = read(spark, sf_dir, "orders")
    last_ship = (read(spark, sf_dir, "lineitem").groupBy("l_orderkey")
                 .agg(F.max("l_shipdate").alias("last_ship")))
    status = (F.when(F.col("o_orderstatus") == "F", "FAILED")
               .when(F.col("o_orderstatus") == "O", "COMPLETED").otherwise("RUNNING"))
    return (o.join(last_ship, o.o_orderkey == last_ship.l_orderkey, "left")
             .select(F.col("o_orderkey").cast("string").alias("run_id"),
                     F.col("o_orderdate").alias("started_at"),
                     F.when(F.col("o_orderstatus") == "P", F.lit(None)).otherwise(F.col("last_ship"))
                      .alias("completed_at"),
                     F.lit("RAW").alias("layer"),
                     status.alias("status"),
                     F.when(F.col("o_orderstatus") == "F",
                            F.concat(F.lit("stopped at "), F.col("o_orderpriority"),
                                     F.lit(", customer "), F.col("o_custkey").cast("string")))
                      .alias("error_message")))


def batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = read(spark, sf_dir, "lineitem")
    cursor = epoch_seconds("l_shipdate")
    offset = ((F.col("l_linenumber") - 1) * 500).cast("int")
    return li.select(
        (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("batch_id"),
        F.col("l_orderkey").cast("string").alias("run_id"),
        F.col("l_returnflag").alias("table_name"),
        F.lit("RAW").alias("layer"),
        F.when(F.col("l_linestatus") == "F", "FAILED").otherwise("SUCCESS").alias("status"),
        cursor.alias("cursor_value"),
        offset.alias("offset_value"),
        F.col("l_quantity").cast("int").alias("records_count"),
        F.floor("l_extendedprice").cast("int").alias("duration_ms"),
        F.concat(F.lit("where updated_at >= "), cursor.cast("string"), F.lit("; offset "),
                 offset.cast("string")).alias("query_sent"),
        F.when(F.col("l_linestatus") == "F", F.concat(F.lit("part "), F.col("l_partkey").cast("string")))
         .alias("error_message"),
        F.col("l_shipdate").alias("created_at"),
        F.col("l_orderkey"), F.col("l_linenumber"), F.col("l_partkey"))


def event_versions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``events`` as versions of a row per user; an ``error`` deletes the row."""
    return read(spark, sf_dir, "events").select(
        "user_id", F.col("ts").cast("timestamp_ntz").alias("ts"), "event_id", "event_type", "value",
        (F.col("event_type") == "error").alias("deleted"))


def order_probes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``orders`` as questions after a user's version at a time."""
    return read(spark, sf_dir, "orders").selectExpr(
        "o_orderkey AS probe_id", "o_custkey % 200 AS user_id",
        "CAST(timestampadd(SECOND, CAST(o_orderkey * 7919 % 2000000 AS INT), TIMESTAMP_NTZ'2024-01-01 00:00:00') AS TIMESTAMP_NTZ) AS at")


#: Nested raw text of an order, in words that Spark and DuckDB share; the
#: records of 1997 and later have other fields and types than those before.
NESTED_CHANGE = 852076800
NESTED_TEXT = """'{"id":' || CAST(id AS STRING) || ',"customer":{"key":' ||
CASE WHEN o_orderstatus = 'P' THEN '"' || CAST(o_custkey AS STRING) || '"' ELSE CAST(o_custkey AS STRING) END ||
CASE WHEN o_orderstatus = 'F' THEN ',"clerk name":null' ELSE '' END || '},"total":{"amount":' ||
CASE WHEN updated_at < 852076800 OR o_custkey % 2 = 0 THEN CAST(o_custkey AS STRING)
     ELSE CAST(CAST(o_totalprice AS DECIMAL(15,2)) AS STRING) END ||
',"paid":' || CASE WHEN o_orderstatus = 'F' THEN 'true' ELSE 'null' END || '},"tags":' ||
CASE o_custkey % 4 WHEN 0 THEN '[]' WHEN 1 THEN '["a",5]' WHEN 2 THEN '[{"name":"x","weight":1},{"weight":1.5}]' ELSE 'null' END ||
CASE WHEN updated_at >= 852076800 THEN ',"gift":{"wrap":[[1],[]]},"note":{"text":"n"}' ELSE ',"note":"n","ship":1' END ||
CASE WHEN id % 97 = 0 THEN '' ELSE '}' END"""


def nested_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Source records as nested JSON texts; one in 97 is cut off."""
    return source_records(spark, sf_dir).select("table_name", "updated_at", F.expr(NESTED_TEXT).alias("raw"))


def replay_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Replay events from ``nation``: one window of 30 x region days per
    nation, every sixth names a table with no contract, region 0 ends before
    it starts."""
    n = read(spark, sf_dir, "nation")
    k = F.col("n_nationkey")
    names = F.array(*[F.lit(t) for t in SOURCE_TABLES])
    table = F.when(k % 6 == 5, F.concat(F.lit("LEGACY_"), F.col("n_name"))).otherwise(
        F.element_at(names, (k % 6 + 1).cast("int")))
    start = F.lit(SOURCE_START).cast("long") + k.cast("long") * 7776000
    return n.select(
        F.concat(F.lit("evt-"), F.lpad(k.cast("string"), 3, "0")).alias("event_id"),
        table.alias("table_name"),
        F.lit("RAW").alias("layer"),
        start.alias("start_watermark"),
        (start + (F.col("n_regionkey").cast("long") - 1) * 2592000).alias("end_watermark"),
        F.lit("PENDING").alias("status"),
        F.lit(0).alias("records_processed"),
        F.lit(None).cast("string").alias("error_message"),
        (F.lit("2024-01-01 00:00:00").cast("timestamp_ntz") + F.make_dt_interval(F.lit(0), k)).alias("created_at"),
        F.lit(None).cast("timestamp_ntz").alias("completed_at"))


def event_queue(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A replay queue that grows with the data: one event per order."""
    o = read(spark, sf_dir, "orders")
    status = (F.when(F.col("o_orderstatus") == "P", "PENDING")
               .when(F.col("o_orderstatus") == "F", "FAILED").otherwise("COMPLETED"))
    start = epoch_seconds("o_orderdate")
    # failed low-priority orders ask to replay a retired table with no contract
    table = F.when((F.col("o_orderpriority") == "5-LOW") & (F.col("o_orderstatus") == "F"),
                   F.lit("LEGACY_LOW")).otherwise(F.col("o_orderpriority"))
    return o.select(
        F.concat(F.lit("ord-"), F.col("o_orderkey").cast("string")).alias("event_id"),
        table.alias("table_name"),
        F.when(F.col("o_orderpriority").isin("1-URGENT", "2-HIGH"), "ANALYTICS").otherwise("RAW").alias("layer"),
        start.alias("start_watermark"),
        (start + 86400 * 7).alias("end_watermark"),
        status.alias("status"),
        F.lit(0).alias("records_processed"),
        F.lit(None).cast("string").alias("error_message"),
        F.col("o_orderdate").alias("created_at"),
        F.lit(None).cast("timestamp_ntz").alias("completed_at"))


def raw_json(records: DataFrame) -> DataFrame:
    """Add ``raw``: each source record as JSON text, with the faults the
    quality checks look for, all decided by the data itself:

    * orders with status P come from a feed that sends ``updated_at`` as a
      date string (wrong type);
    * failed orders of priority 4 arrive without ``name`` (missing required);
    * urgent orders above 300,000 carry an undeclared ``rush`` flag (new
      column); ``to_json`` drops null fields, so the key is absent elsewhere.
    """
    name = F.when((F.col("o_orderstatus") == "F") & (F.col("table_name") == "4-NOT SPECIFIED"),
                  F.lit(None)).otherwise(F.col("name"))
    rush = F.when((F.col("table_name") == "1-URGENT") & (F.col("o_totalprice") > 300000), F.lit(True))
    common = [F.col("id"), name.alias("name")]
    tail = [F.col("o_custkey"), F.col("o_totalprice"), rush.alias("rush")]
    as_text = F.to_json(F.struct(*common, F.date_format("o_orderdate", "yyyy-MM-dd").alias("updated_at"), *tail))
    as_num = F.to_json(F.struct(*common, F.col("updated_at"), *tail))
    return records.withColumn("raw", F.when(F.col("o_orderstatus") == "P", as_text).otherwise(as_num))


def raw_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(table_name, id, raw) for every source record."""
    return raw_json(source_records(spark, sf_dir)).select("table_name", "id", "raw")


# ---------------------------------------------------------------------------
# The same inputs as DuckDB views (used as CTEs by the oracle SQL).
# ---------------------------------------------------------------------------
_PRIORITY_CASE = ("CASE n_nationkey % 6 WHEN 0 THEN '1-URGENT' WHEN 1 THEN '2-HIGH' WHEN 2 THEN '3-MEDIUM' "
                  "WHEN 3 THEN '4-NOT SPECIFIED' WHEN 4 THEN '5-LOW' ELSE 'LEGACY_' || n_name END")

SQL = {
    "src": """
        SELECT o_orderpriority AS table_name, o_orderkey AS id,
               CAST(epoch(o_orderdate) AS BIGINT) AS updated_at,
               o_orderstatus || '-' || CAST(o_custkey AS VARCHAR) AS name,
               o_custkey, o_orderstatus, o_totalprice, o_orderdate
        FROM orders""",
    "seed": """
        SELECT * FROM (VALUES ('1-URGENT', 978307200::BIGINT, 0::BIGINT, 45::BIGINT, 'RAW', 0, FALSE),
                              ('2-HIGH', 0::BIGINT, 0::BIGINT, 0::BIGINT, 'RAW', 0, FALSE))
            AS t(table_name, current_watermark, fallback_watermark, last_id, layer, offset_val,
                 is_override_active)""",
    "contracts": """
        SELECT * FROM (VALUES ('1-URGENT'), ('2-HIGH'), ('3-MEDIUM'), ('4-NOT SPECIFIED'), ('5-LOW'))
            AS t(table_name)""",
    "runs": """
        SELECT CAST(o_orderkey AS VARCHAR) AS run_id, o_orderdate AS started_at,
               CASE WHEN o_orderstatus = 'P' THEN NULL ELSE ls.last_ship END AS completed_at,
               'RAW' AS layer,
               CASE o_orderstatus WHEN 'F' THEN 'FAILED' WHEN 'O' THEN 'COMPLETED' ELSE 'RUNNING' END AS status,
               CASE WHEN o_orderstatus = 'F' THEN 'stopped at ' || o_orderpriority
                    || ', customer ' || CAST(o_custkey AS VARCHAR) END AS error_message
        FROM orders LEFT JOIN (SELECT l_orderkey, max(l_shipdate) AS last_ship FROM lineitem GROUP BY 1) ls
             ON o_orderkey = ls.l_orderkey""",
    "batches": """
        SELECT l_orderkey * 10 + l_linenumber AS batch_id, CAST(l_orderkey AS VARCHAR) AS run_id,
               l_returnflag AS table_name, 'RAW' AS layer,
               CASE WHEN l_linestatus = 'F' THEN 'FAILED' ELSE 'SUCCESS' END AS status,
               CAST(epoch(l_shipdate) AS BIGINT) AS cursor_value,
               CAST((l_linenumber - 1) * 500 AS INTEGER) AS offset_value,
               CAST(l_quantity AS INTEGER) AS records_count,
               CAST(floor(l_extendedprice) AS INTEGER) AS duration_ms,
               'where updated_at >= ' || CAST(CAST(epoch(l_shipdate) AS BIGINT) AS VARCHAR) || '; offset '
                   || CAST((l_linenumber - 1) * 500 AS VARCHAR) AS query_sent,
               CASE WHEN l_linestatus = 'F' THEN 'part ' || CAST(l_partkey AS VARCHAR) END AS error_message,
               l_shipdate AS created_at, l_orderkey, l_linenumber, l_partkey
        FROM lineitem""",
    "windows": f"""
        SELECT 'evt-' || lpad(CAST(n_nationkey AS VARCHAR), 3, '0') AS event_id,
               {_PRIORITY_CASE} AS table_name, 'RAW' AS layer,
               {SOURCE_START}::BIGINT + n_nationkey * 7776000::BIGINT AS start_watermark,
               {SOURCE_START}::BIGINT + n_nationkey * 7776000::BIGINT + (n_regionkey - 1) * 2592000::BIGINT
                   AS end_watermark,
               'PENDING' AS status, 0 AS records_processed, CAST(NULL AS VARCHAR) AS error_message,
               TIMESTAMP '2024-01-01 00:00:00' + n_nationkey * INTERVAL 1 HOUR AS created_at,
               CAST(NULL AS TIMESTAMP) AS completed_at
        FROM nation""",
    "queue": """
        SELECT 'ord-' || CAST(o_orderkey AS VARCHAR) AS event_id,
               CASE WHEN o_orderpriority = '5-LOW' AND o_orderstatus = 'F' THEN 'LEGACY_LOW'
                    ELSE o_orderpriority END AS table_name,
               CASE WHEN o_orderpriority IN ('1-URGENT', '2-HIGH') THEN 'ANALYTICS' ELSE 'RAW' END AS layer,
               CAST(epoch(o_orderdate) AS BIGINT) AS start_watermark,
               CAST(epoch(o_orderdate) AS BIGINT) + 604800 AS end_watermark,
               CASE o_orderstatus WHEN 'P' THEN 'PENDING' WHEN 'F' THEN 'FAILED' ELSE 'COMPLETED' END AS status,
               0 AS records_processed, CAST(NULL AS VARCHAR) AS error_message,
               o_orderdate AS created_at, CAST(NULL AS TIMESTAMP) AS completed_at
        FROM orders""",
}


def with_views(*names: str) -> str:
    """``WITH name AS (...), ...`` prefix for an oracle query."""
    return "WITH " + ",\n".join(f"{n} AS ({SQL[n]})" for n in names) + "\n"
