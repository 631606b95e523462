"""Record checks, quarantine, uniqueness, schema drift and alerts
(SURVEY Q1-Q9, U1, J5, P10).

Raw records arrive as JSON text, one record per row.  Parsing is
record-wise with ``from_json`` so one bad record never spoils its page; every
record lands in exactly one of *good* or *quarantine*.
"""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.contracts import Contract
from tidemark.functions.scalars import alert_text, name_signature, truncate_message

CORRUPT = "_corrupt_record"
#: Rows that a task of a large anti-join sorts, and buckets that tell hot keys.
PIECE, BUCKETS = 500_000, 1024
#: Into more pieces than this, Spark's shuffle holds a task's rows in memory;
#: they are taken only where pieces would pass so many times ``PIECE``.
FEW, GROWN = 200, 4


# -- S4 + Q2 + P10 ---------------------------------------------------------------------------
def parse_records(raw: DataFrame, contract: Contract, *, value: str = "raw") -> DataFrame:
    """Parse ``value`` (one JSON object per row) against the contract.

    Undeclared keys are dropped (P10); a value of the wrong type makes the
    field null and keeps the text in ``_corrupt_record`` (Q2).  The other
    columns of ``raw`` are carried along."""
    schema = contract.schema().add(T.StructField(CORRUPT, T.StringType(), True))
    parsed = F.from_json(F.col(value), schema, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT})
    fields = [F.col("__rec").getField(f.source_name).alias(f.name) for f in contract.fields]
    keep = [F.col(c) for c in raw.columns]
    return raw.select(*keep, parsed.alias("__rec")).select(*keep, *fields, F.col("__rec").getField(CORRUPT).alias(CORRUPT))


# -- Q1 + Q3 (row part) + Q4 ---------------------------------------------------------------------
def flag_records(parsed: DataFrame, contract: Contract, *, value: str = "raw") -> DataFrame:
    """Add ``quality_issue``: null when the record is good, else the first
    failed check: ``not_an_object``, ``wrong_type``, ``missing_id``,
    ``missing_updated_at`` or ``missing_<required>``.  A key that is present
    but null counts as missing."""
    checks: list[tuple[Column, str]] = [
        (F.col(CORRUPT).isNotNull() & F.col(contract.key).isNull() & ~F.trim(F.col(value)).startswith("{"),
         "not_an_object"),
        (F.col(CORRUPT).isNotNull(), "wrong_type"),
        (F.col(contract.key).isNull(), f"missing_{contract.key}"),
        (F.col(contract.order).isNull(), f"missing_{contract.order}"),
    ]
    for r in contract.required:
        if r not in (contract.key, contract.order):
            checks.append((F.col(r).isNull(), f"missing_{r}"))
    issue = F.lit(None).cast("string")
    for cond, label in reversed(checks):
        issue = F.when(cond, F.lit(label)).otherwise(issue)
    return parsed.withColumn("quality_issue", issue)


def split_good_quarantine(flagged: DataFrame, contract: Contract) -> tuple[DataFrame, DataFrame]:
    """Q4: (good rows projected to the contract, quarantined rows with their
    raw text and issue).  Both come from one flagged frame; cache it when
    both are consumed."""
    good = flagged.where(F.col("quality_issue").isNull())
    quarantine = flagged.where(F.col("quality_issue").isNotNull())
    extra = [c for c in flagged.columns if c not in contract.names and c not in (CORRUPT, "quality_issue")]
    return good.select(*extra, *contract.parsed()), quarantine


def table_failures(flagged: DataFrame, group: str = "table_name", *, value: str = "raw",
                   keys: tuple[str, ...] = ("id", "updated_at")) -> DataFrame:
    """Q1 at table level, as the source system judges it: a table fails
    when any of its records lacks one of ``keys`` (or has null there).  Other issues quarantine
    the record alone; a key that is there with a value of the wrong type is
    such an issue."""
    bad = reduce(or_, [F.get_json_object(value, f"$.{k}").isNull() for k in keys])
    return flagged.groupBy(group).agg(
        F.count(F.lit(1)).alias("records"),
        F.count_if(bad).alias("bad_records"),
        F.bool_or(bad).alias("table_fails"))


# -- Q3: uniqueness --------------------------------------------------------------------------
def duplicate_keys(df: DataFrame, key) -> DataFrame:
    """Keys that occur more than once, with their count."""
    keys = [key] if isinstance(key, str) else list(key)
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("occurrences")).where(F.col("occurrences") > 1)


def null_counts(df: DataFrame, columns: list[str]) -> DataFrame:
    """Q3 not-null check: one row with the null count of each column."""
    return df.agg(*[F.count_if(F.col(c).isNull()).alias(f"{c}_nulls") for c in columns])


# -- U1 + Q5 + Q6 ----------------------------------------------------------------------------
def json_type_family(variant_type: Column) -> Column:
    """Spark's variant type name folded to a JSON value family: integer,
    number, string, boolean, array, object, null."""
    t = F.upper(variant_type)
    return (F.when(t.isNull() | t.isin("VOID", "NULL"), "null")
             .when(t.isin("BIGINT", "INT", "SMALLINT", "TINYINT"), "integer")
             .when(t.startswith("DECIMAL") | t.isin("DOUBLE", "FLOAT"), "number")
             .when(t == "STRING", "string").when(t == "BOOLEAN", "boolean")
             .when(t.startswith("ARRAY"), "array").when(t.startswith("OBJECT"), "object")
             .otherwise(F.lower(t)))


def observed_keys(raw: DataFrame, *, value: str = "raw", group: str = "table_name") -> DataFrame:
    """(group, column_name, data_type, records): every top-level key seen in
    the raw objects with the JSON family of its values.  Records are parsed
    to ``map<string, variant>`` and exploded, then aggregated right away, so
    the data shrinks to the distinct keys (partial aggregation)."""
    kv = F.explode(F.from_json(F.col(value), "map<string,variant>"))
    pairs = raw.select(group, kv)
    typed = pairs.select(group, F.col("key").alias("column_name"),
                         json_type_family(F.schema_of_variant("value")).alias("data_type"))
    return typed.groupBy(group, "column_name", "data_type").agg(F.count(F.lit(1)).alias("records"))


def new_columns(observed: DataFrame, registry: DataFrame, group: str = "table_name") -> DataFrame:
    """U1 observed minus declared: keys a contract does not declare (Q5:
    logged, the load goes on)."""
    decl = registry.select(F.col("table_name").alias(group), "declared_columns")
    return (observed.join(decl, group)
                    .where(~F.array_contains("declared_columns", F.col("column_name")))
                    .drop("declared_columns"))


def missing_required(observed: DataFrame, registry: DataFrame, group: str = "table_name") -> DataFrame:
    """U1 declared-required minus observed (Q6 breaking change): required
    columns never seen in a table's records."""
    seen = observed.groupBy(group).agg(F.collect_set("column_name").alias("__seen"))
    req = registry.select(F.col("table_name").alias(group), "required_columns")
    return (seen.join(req, group)
                .select(group, F.explode(F.array_except("required_columns", "__seen")).alias("column_name")))


def type_changes(observed: DataFrame, declared: DataFrame, group: str = "table_name") -> DataFrame:
    """Q6 type change: declared columns seen with a JSON type the declared
    type cannot take (numbers accept integers; null fits anything)."""
    d = declared.select(F.col("table_name").alias(group), "column_name",
                                    F.col("data_type").alias("declared_type"), "json_family")
    fits = ((F.col("data_type") == F.col("json_family")) | (F.col("data_type") == "null")
            | ((F.col("json_family") == "number") & (F.col("data_type") == "integer")))
    return (observed.join(d, [group, "column_name"])
                    .where(~fits)
                    .select(group, "column_name", "declared_type", F.col("data_type").alias("observed_type"),
                            "records"))


def breaking_changes(observed: DataFrame, declared: DataFrame, registry: DataFrame,
                     group: str = "table_name") -> DataFrame:
    """Q6: type changes, plus required columns no record of a table
    carries (observed type ``missing``, no records)."""
    types = type_changes(observed, declared, group)
    missing = (missing_required(observed, registry, group)
               .join(declared.select(F.col("table_name").alias(group), "column_name",
                                                 F.col("data_type").alias("declared_type")),
                     [group, "column_name"], "left")
               .select(group, "column_name", "declared_type", F.lit("missing").alias("observed_type"),
                       F.lit(0).cast("long").alias("records")))
    return types.unionByName(missing)


# -- Q7 + Q8 + drift rows -------------------------------------------------------------------------
def schema_snapshots(observed: DataFrame, group: str = "table_name") -> DataFrame:
    """One row per table: sorted observed column names, their JSON snapshot
    and its hash (JSON key order is not stable, so names are sorted)."""
    # One entry per column first: the types of a column are few, whatever the records.
    columns = observed.groupBy(group, "column_name").agg(
        F.array_join(F.array_sort(F.collect_set("data_type")), "|").alias("data_type"))
    entries = F.array_sort(F.collect_list(F.struct("column_name", "data_type")))
    snap = columns.groupBy(group).agg(entries.alias("entries"))
    names = F.transform("entries", lambda e: e["column_name"])
    return snap.select(group, names.alias("columns"), "entries",
                       F.to_json(F.map_from_entries("entries")).alias("columns_snapshot"),
                       name_signature(names).alias("schema_hash"))


def drift_rows(observed: DataFrame, registry: DataFrame, declared: DataFrame, *, run_id: Column, detected_at: Column,
               group: str = "table_name") -> DataFrame:
    """schema_history rows: one per (table, snapshot hash) with the changed
    columns: undeclared ones, required ones that no record carries, and
    declared ones seen with a type they cannot take.

    The hash covers names and types, so a type change is a row of its own.
    Status: ``BREAKING_CHANGE`` when a required column is missing everywhere,
    ``QUARANTINE`` when records of a wrong type are set aside while others
    load, else ``NEW_COLUMN``.  ``included_at`` stays null until the contract
    takes the new columns in (Q8, ``mark_included``)."""
    reg = registry.select(F.col("table_name").alias(group), "declared_columns", "required_columns")
    retyped = type_changes(observed, declared, group).groupBy(group).agg(F.collect_set("column_name").alias("retyped"))
    none = F.array().cast("array<string>")
    j = (schema_snapshots(observed, group).join(reg, group).join(retyped, group, "left")
         .withColumn("retyped", F.coalesce("retyped", none)))
    missing = F.array_except("required_columns", "columns")
    changed = F.array_sort(F.array_union(F.array_union(F.array_except("columns", "declared_columns"), missing), F.col("retyped")))
    signature = name_signature(F.transform("entries", lambda e: F.concat_ws(":", e["column_name"], e["data_type"])))
    breaking, aside = F.size(missing) > 0, F.size("retyped") > 0
    return j.select(
        F.xxhash64(F.col(group), signature).alias("id"), group, signature.alias("schema_hash"), "columns_snapshot",
        changed.alias("changed_columns"),
        detected_at.alias("detected_at"), run_id.alias("detected_in_run_id"),
        F.lit(None).cast("timestamp_ntz").alias("included_at"),
        F.when(breaking, "BREAKING_CHANGE").when(aside, "QUARANTINE").otherwise("NEW_COLUMN").alias("status"),
        F.when(breaking | aside, "records set aside").otherwise("logged, load went on").alias("action_taken"),
    ).where(F.size("changed_columns") > 0)


def mark_included(history: DataFrame, registry: DataFrame, now: Column, group: str = "table_name") -> DataFrame:
    """Q8 on stored drift rows: once the contract declares every column of a
    NEW_COLUMN row, set its ``included_at`` (kept if already set).  Rows of
    breaking changes name declared columns, so declaration resolves nothing
    there."""
    decl = registry.select(F.col("table_name").alias(group), F.col("declared_columns").alias("__decl"))
    j = history.join(decl, group, "left")
    covered = F.size(F.array_except("changed_columns", F.coalesce("__decl", F.array().cast("array<string>")))) == 0
    new = F.col("status") == "NEW_COLUMN"
    return j.withColumn("included_at", F.coalesce(F.col("included_at"), F.when(covered & new, now))).drop("__decl")


# -- J5 --------------------------------------------------------------------------------------
def pieces(key: str, *sides: DataFrame) -> int:
    """Into how many pieces by ``key`` the rows of ``sides`` are dealt so that
    each has about ``PIECE``, or ``GROWN`` times that where it would take more
    than ``FEW``; 0 leaves it to Spark: few rows, or a key with more than a
    piece of its own, which Spark's skewed joins cut up and its map-side
    distinct shrinks."""
    keys = reduce(DataFrame.unionByName, [d.select(key) for d in sides])
    found = (keys.groupBy(F.pmod(F.xxhash64(key), F.lit(BUCKETS)).alias("bucket")).agg(F.count(F.lit(1)).alias("n"))
                 .agg(F.sum("n").alias("rows"), F.max("n").alias("most")).first())
    n = -(-(found.rows or 0) // PIECE)
    if n <= keys.sparkSession.sparkContext.defaultParallelism or found.most - found.rows // BUCKETS > PIECE:
        return 0
    return max(min(n, FEW), -(-found.rows // (GROWN * PIECE)))


def orphans(child: DataFrame, parent: DataFrame, key: str, parent_key: str | None = None) -> DataFrame:
    """Child rows whose non-null ``key`` has no parent row (a shuffle
    anti-join: both sides grow with the data).  Large sides are dealt by
    number of rows: Spark joins partitions up to a size in compressed bytes,
    of which such keys take very few, and a task would sort millions."""
    pk = parent_key or key
    child = child.where(F.col(key).isNotNull())
    parents = parent.select(F.col(pk).alias(key)).where(F.col(key).isNotNull())
    n = pieces(key, child, parents)
    if n:
        child, parents = child.repartition(n, key), parents.repartition(n, key)
    return child.join(parents.distinct(), key, "left_anti")


# -- Q9 --------------------------------------------------------------------------------------
def alert_feed(alerts: DataFrame, *, max_len: int = 1900, head: int = 200) -> DataFrame:
    """Alert messages (source, ref, level, message) rendered as chat text:
    long messages cut to head + marker + tail, ``[LEVEL] msg``, a mention
    for ERROR."""
    return alerts.select("source", "ref", "level",
                         alert_text("level", truncate_message("message", max_len, head)).alias("content"))
