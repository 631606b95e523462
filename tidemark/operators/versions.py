"""Reads of the past over version rows: state as of a time,
the change feed between two times, and as-of joins.

A version is a row of a key with a time; of equal times the larger ``tie`` is
the later one.  Rows with a null key or time are no versions.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.session import materialize


def _versions(df: DataFrame, key: str, time: str) -> DataFrame:
    return df.where(F.col(key).isNotNull() & F.col(time).isNotNull())


def _image(time: str, tie: str, values: list[str]) -> Column:
    return F.struct(time, tie, *values)


def as_of(versions: DataFrame, at: Column, *, key: str, time: str, tie: str, values: list[str],
          deleted: str | None = None) -> DataFrame:
    """The last version of every key at or before ``at``; keys whose last
    version is ``deleted`` are left out.  Combined map-side, so a hot key
    sends one row per task."""
    cols = [*values, *([deleted] if deleted else [])]
    last = (_versions(versions, key, time).where(F.col(time) <= at)
            .groupBy(key).agg(F.max(_image(time, tie, cols)).alias("v")))
    if deleted:
        last = last.where(~F.coalesce(F.col("v")[deleted], F.lit(False)))
    return last.select(key, *[F.col("v")[c].alias(c) for c in (time, tie, *values)])


def change_feed(versions: DataFrame, after: Column, until: Column, *, key: str, time: str, tie: str,
                values: list[str], deleted: str | None = None) -> DataFrame:
    """Keys whose state as of ``until`` is another one than as of ``after``:
    the operation (insert, update, delete), the images ``before_`` and
    ``after_`` of each value (null where there is none), the time of the last
    version and how many versions lie between.  One pass and one aggregate:
    both images are conditional maxima that combine map-side."""
    flag = F.coalesce(F.col(deleted), F.lit(False)) if deleted else F.lit(False)
    rows = _versions(versions, key, time).where(F.col(time) <= until).withColumn("__gone", flag)
    image = _image(time, tie, ["__gone", *values])
    old, new = F.col("old"), F.col("new")
    found = rows.groupBy(key).agg(
        F.max(F.when(F.col(time) <= after, image)).alias("old"), F.max(image).alias("new"),
        F.count_if(F.col(time) > after).alias("versions")).where(F.col("versions") > 0)
    was = old.isNotNull() & ~F.coalesce(old["__gone"], F.lit(True))
    there = ~new["__gone"]
    same = reduce(Column.__and__, [old[c].eqNullSafe(new[c]) for c in values], F.lit(True))
    op = F.when(~was & there, "insert").when(was & ~there, "delete").when(was & there & ~same, "update")
    images = [F.when(was, old[c]).alias(f"before_{c}") for c in values] + [
        F.when(there, new[c]).alias(f"after_{c}") for c in values]
    return (found.withColumn("operation", op).where(F.col("operation").isNotNull())
                 .select(key, "operation", *images, new[time].alias(time), "versions"))


def as_of_join(probes: DataFrame, versions: DataFrame, *, key: str, at: str, time: str, tie: str,
               values: list[str]) -> DataFrame:
    """``probes`` with ``values`` and ``time`` of the last version of their key
    at or before ``at`` (nulls where there is none, or a null key or time).

    Versions and probes are laid in one order of (key, time) and cut into
    ranges of like size, so a hot key is spread over many ranges; each range
    carries its last version on, and a key's first probes in a range take the
    last version that the ranges before it carried (a row per key and range)."""
    clash = {time, *values} & set(probes.columns)
    if clash:
        raise ValueError(f"there are columns {sorted(clash)} already")
    seen = _versions(versions, key, time).select(
        F.col(key).alias("k"), F.col(time).alias("t"), F.lit(0).alias("probe"),
        F.struct(F.col(tie).alias("tie"), F.col(time).alias("time"), *[F.col(c).alias(f"v{i}") for i, c in enumerate(values)]).alias("v"),
        F.lit(None).cast(_struct_of(probes)).alias("p"))
    asked = probes.select(
        F.col(key).alias("k"), F.col(at).alias("t"), F.lit(1).alias("probe"),
        F.lit(None).cast(seen.schema["v"].dataType).alias("v"), F.struct(*probes.columns).alias("p"))
    laid = materialize(seen.unionByName(asked).repartitionByRange("k", "t").withColumn("piece", F.spark_partition_id()))
    inside = Window.partitionBy("piece", "k").orderBy("t", "probe", F.col("v")["tie"]).rowsBetween(
        Window.unboundedPreceding, Window.currentRow)
    carried = (laid.where(F.col("v").isNotNull()).groupBy("k", "piece")
                   .agg(F.max(F.struct("t", F.col("v")["tie"].alias("tie"), "v")).alias("m")))
    groups = laid.select("k", "piece").distinct().join(carried, ["k", "piece"], "left")
    before = Window.partitionBy("k").orderBy("piece").rowsBetween(Window.unboundedPreceding, -1)
    carry = groups.select("k", "piece", F.last(F.col("m")["v"], ignorenulls=True).over(before).alias("carry"))
    near = laid.withColumn("near", F.last("v", ignorenulls=True).over(inside)).where(F.col("probe") == 1)
    both = near.join(carry, near["k"].eqNullSafe(carry["k"]) & (near["piece"] == carry["piece"]), "left")
    v = F.when(near["k"].isNotNull() & near["t"].isNotNull(), F.coalesce("near", "carry"))
    out = both.select("p", v.alias("v"))
    return out.select("p.*", F.col("v")["time"].alias(time), *[F.col("v")[f"v{i}"].alias(c) for i, c in enumerate(values)])


def _struct_of(df: DataFrame):
    return df.select(F.struct(*df.columns).alias("p")).schema["p"].dataType
