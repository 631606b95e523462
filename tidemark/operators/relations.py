"""Resolve id arrays and foreign ids to dimension tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def resolve_refs(refs: DataFrame, key: str, ref: str, dim: DataFrame, dim_key: str, label: str) -> DataFrame:
    """Per ``key``: references, resolved references, and the first and last
    resolved ``label`` of the dimension.

    One row per reference, a left join (ids with no dimension row are kept
    and counted), then bounded aggregates combined map-side, so a key
    holding a third of all references is never gathered in one task.  The
    dimension is not broadcast by hand: it grows with the data and AQE picks
    the join from its runtime size."""
    d = dim.select(F.col(dim_key).alias("__ref"), F.col(label).alias("__label"))
    joined = refs.select(key, F.col(ref).alias("__ref")).join(d, "__ref", "left")
    return joined.groupBy(key).agg(
        F.count("__ref").alias("n_ids"),
        F.count("__label").alias("n_resolved"),
        F.min("__label").alias(f"first_{label}"),
        F.max("__label").alias(f"last_{label}"))


def explode_ids(df: DataFrame, key: str, ids_col: str) -> DataFrame:
    """A record's id array as one row per id (``explode_outer`` keeps records
    with an empty or null list, with a null id)."""
    return df.select(key, F.explode_outer(ids_col).alias(ids_col))


def resolve_ids(df: DataFrame, key: str, ids_col: str, dim: DataFrame, dim_key: str, label: str) -> DataFrame:
    """J6 for the contracts' id-array fields (genres, platforms, ...)."""
    return resolve_refs(explode_ids(df, key, ids_col), key, ids_col, dim, dim_key, label)


def resolved_lists(df: DataFrame, key: str, ids_col: str, dim: DataFrame, dim_key: str, label: str) -> DataFrame:
    """The id array of each record replaced by the sorted labels it points
    to.  The regrouping collects one record's own list, so it is bounded by
    the record, not by the data."""
    d = dim.select(F.col(dim_key).alias("__ref"), F.col(label).alias("__label"))
    rows = explode_ids(df, key, ids_col).withColumnRenamed(ids_col, "__ref").join(d, "__ref", "left")
    return rows.groupBy(key).agg(F.array_sort(F.collect_list("__label")).alias(f"{label}s"))
