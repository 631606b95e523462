"""Raw pages -> typed tables in batch: read landed pages, parse
record-wise, quarantine bad records, merge the latest version of each record
into the target."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.contracts import Contract
from tidemark.operators import merge, quality


@dataclass
class Loaded:
    table: DataFrame        # target after the merge
    quarantine: DataFrame   # rejected records with their issue
    report: DataFrame       # per endpoint: good, quarantined, new columns


def load_pages(raw: DataFrame, contract: Contract, target: DataFrame | None = None) -> Loaded:
    """``raw``: endpoint, cursor, offset, position, raw (landing layout).
    Good records are merged into ``target`` by ``id`` keeping the highest
    ``updated_at`` (incoming wins ties), so loading the same pages twice
    gives the same table."""
    parsed = quality.parse_records(raw, contract)
    flagged = quality.flag_records(parsed, contract)
    good, bad = quality.split_good_quarantine(flagged, contract)
    rows = good.select(*contract.names)
    if target is None:
        # Records re-read on several pages: one version per id.
        rows = merge.latest_per_key(rows, contract.key, [contract.order])
    else:
        # The upsert's single aggregation by id also settles re-read records.
        rows = merge.upsert_latest(target.select(*contract.names), rows, contract.key, contract.order)
    report = flagged.groupBy("endpoint").agg(
        F.count_if(F.col("quality_issue").isNull()).alias("good"),
        F.count_if(F.col("quality_issue").isNotNull()).alias("quarantined"))
    return Loaded(table=rows.select(*contract.names), quarantine=bad, report=report)
