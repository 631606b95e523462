"""Nested schemas of raw records: every path, its kinds and type.

The schema of a set of records is a relation (group, path, kind, records): how
often a path holds an object, an array, an integer and so on.  Two such
relations merge by adding up, so a stored schema takes a new run in without
reading old records, and Spark combines the counts map-side.  The type of a
path is the least one that holds all its kinds:

    NULL < INTEGER < NUMBER < STRING, BOOLEAN < STRING; a container and
    anything else that is not null: MIXED

Records are walked level by level, a scan per level of nesting, until a level
holds no containers.  Elements of an array share the path ``[]``; keys of other
characters than letters, digits and ``_`` are quoted.  Texts that are null or
no JSON (a repeated key included) have the kind INVALID at ``$``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.session import materialize


def _kind(v: Column) -> Column:
    name = F.schema_of_variant(v)
    return (F.when(v.isNull(), "INVALID").when(name == "VOID", "NULL")
             .when(name.startswith("OBJECT"), "OBJECT").when(name.startswith("ARRAY"), "ARRAY")
             .when((name == "BIGINT") | name.rlike(r"^DECIMAL\(\d+,0\)$"), "INTEGER")
             .when(name.startswith("DECIMAL") | name.isin("DOUBLE", "FLOAT"), "NUMBER")
             .when(name == "BOOLEAN", "BOOLEAN").otherwise("STRING"))


def path_counts(raw: DataFrame, *, value: str = "raw", group: str = "table_name") -> DataFrame:
    """(group, path, kind, records) of the JSON texts in ``value``."""
    nodes = raw.select(group, F.lit("$").alias("path"), F.try_parse_json(value).alias("v"))
    levels = None
    while True:
        level = materialize(nodes.groupBy(group, "path", _kind(F.col("v")).alias("kind"))
                                 .agg(F.count(F.lit(1)).alias("records")))
        levels = level if levels is None else levels.unionByName(level)
        if level.where(F.col("kind").isin("OBJECT", "ARRAY")).isEmpty():
            return levels
        key = F.when(F.col("key").rlike("^[A-Za-z0-9_]+$"), F.col("key")).otherwise(
            F.concat(F.lit('"'), F.replace("key", F.lit('"'), F.lit('\\"')), F.lit('"')))
        step = F.when(F.col("key").isNull(), "[]").otherwise(F.concat(F.lit("."), key))
        inner = raw.sparkSession.tvf.variant_explode(F.col("v").outer()).select(
            "key", F.col("value").alias("inner"))
        nodes = nodes.lateralJoin(inner).select(group, F.concat("path", step).alias("path"), F.col("inner").alias("v"))


def merge_counts(*states: DataFrame, group: str = "table_name") -> DataFrame:
    """One schema relation of several (of runs, of parts)."""
    whole = states[0]
    for s in states[1:]:
        whole = whole.unionByName(s)
    return whole.groupBy(group, "path", "kind").agg(F.sum("records").alias("records"))


def _held(own: Column) -> Column:
    """The kinds that are not null, of the rows ``own`` names."""
    return F.array_sort(F.collect_set(F.when(own & (F.col("kind") != "NULL"), F.col("kind"))))  # at most seven


def _least(k: Column) -> Column:
    """The least type that holds all kinds of ``k``."""
    mixed = F.arrays_overlap(k, F.array(F.lit("OBJECT"), F.lit("ARRAY"), F.lit("INVALID")))
    return (F.when(F.size(k) == 0, "NULL").when(F.size(k) == 1, k[0]).when(mixed, "MIXED")
             .when(k == F.array(F.lit("INTEGER"), F.lit("NUMBER")), "NUMBER").otherwise("STRING"))


def _nulls() -> Column:
    return F.sum(F.when(F.col("kind") == "NULL", F.col("records")).otherwise(0))


def path_types(state: DataFrame, *, group: str = "table_name") -> DataFrame:
    """(group, path, type, records, nulls): the least type that holds all
    kinds of a path."""
    return state.groupBy(group, "path").agg(
        _least(_held(F.lit(True))).alias("type"), F.sum("records").alias("records"), _nulls().alias("nulls"))


def schema_changes(stored: DataFrame, run: DataFrame, *, group: str = "table_name") -> DataFrame:
    """Per path of the stored schema and a run's: type before and after the
    run is merged, its records in both, and the change: NEW_COLUMN, SAME,
    WIDENED (the old type goes into the new one), BREAKING_CHANGE (MIXED now),
    GONE (not in the run).  One aggregate over both relations."""
    both = stored.withColumn("__run", F.lit(False)).unionByName(run.withColumn("__run", F.lit(True)))
    old, new = F.col("__old") > 0, F.col("__new") > 0
    found = both.groupBy(group, "path").agg(
        F.count_if(~F.col("__run")).alias("__old"), F.count_if(F.col("__run")).alias("__new"),
        _least(_held(~F.col("__run"))).alias("__before"), _least(_held(F.lit(True))).alias("type_after"),
        F.sum("records").alias("records"), _nulls().alias("nulls"))
    before, after = F.when(old, F.col("__before")), F.col("type_after")
    change = (F.when(~old, "NEW_COLUMN").when(~new, "GONE").when(before == after, "SAME")
               .when(after == "MIXED", "BREAKING_CHANGE").otherwise("WIDENED"))
    return found.select(group, "path", before.alias("type_before"), after, "records", "nulls", change.alias("change"))
