"""Column history: when each column of a table was seen,
and since when the contract declares it.

Records shrink to (table, snapshot, column) by a partial aggregate; intervals
are gaps and islands over the numbered snapshots of a table, so the windows
work on snapshots and columns, never on records.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.contracts import Contract
from tidemark.session import literal_frame, materialize


def column_presence(raw: DataFrame, *, value: str = "raw", group: str = "table_name", at: str = "snapshot") -> DataFrame:
    """(group, at, column_name, records): the top-level keys of the raw
    objects of each snapshot.  Texts that are no objects have none."""
    key = F.explode(F.json_object_keys(value)).alias("column_name")
    return raw.select(group, at, key).groupBy(group, at, "column_name").agg(F.count(F.lit(1)).alias("records"))


def column_intervals(presence: DataFrame, *, group: str = "table_name", at: str = "snapshot") -> DataFrame:
    """One row per column and run of neighbouring snapshots of its table that
    hold it: first and last snapshot, snapshots, records, and whether the run
    reaches the table's last snapshot."""
    seen = materialize(presence)
    order = Window.partitionBy(group).orderBy(at)
    number = seen.select(group, at).distinct().withColumn("n", F.row_number().over(order))
    last = number.groupBy(group).agg(F.max("n").alias("last_n"))
    own = Window.partitionBy(group, "column_name").orderBy("n")
    runs = seen.join(number, [group, at]).withColumn("island", F.col("n") - F.row_number().over(own))
    found = runs.groupBy(group, "column_name", "island").agg(
        F.min(at).alias("first_seen"), F.max(at).alias("last_seen"), F.count(F.lit(1)).alias("snapshots"),
        F.sum("records").alias("records"), F.max("n").alias("n"))
    return found.join(last, group).select(group, "column_name", "first_seen", "last_seen", "snapshots", "records",
                                          (F.col("n") == F.col("last_n")).alias("open"))


def contract_versions(spark: SparkSession, versions: list[tuple[str, dict[str, Contract]]]) -> DataFrame:
    """(table_name, column_name, included_at): the time of the first version of
    the contracts (time, contracts) that declares a column."""
    first: dict[tuple[str, str], str] = {}
    for since, contracts in sorted(versions, key=lambda v: v[0]):
        for table, contract in contracts.items():
            for name in contract.names:
                first.setdefault((table, name), since)
    rows = [(t, c, since) for (t, c), since in sorted(first.items())]
    return literal_frame(spark, rows, "table_name string, column_name string, included_at timestamp_ntz")


def column_history(raw: DataFrame, versions: list[tuple[str, dict[str, Contract]]], *, at: str = "snapshot") -> DataFrame:
    """The intervals of every column with the time a contract took it in
    (null: none has)."""
    declared = contract_versions(raw.sparkSession, versions)
    return column_intervals(column_presence(raw, at=at), at=at).join(declared, ["table_name", "column_name"], "left")
