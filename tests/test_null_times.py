"""Source rows with no time or no id land, are counted and quarantined, and
set no mark."""

from pyspark.sql import functions as F

from tests.conftest import SF_SMALL
from tidemark.contracts import registry_frame
from tidemark.operators import progress, select
from tidemark.plans import api, execute, load
from tidemark.sources import landing
from tidemark.sources import standins as S


def test_selection_and_marks(spark):
    rows = [("a", 1, 50), ("a", 2, 150), ("a", 3, None), ("a", None, 200), ("a", None, None), ("b", 4, None), ("x", 5, None)]
    src = spark.createDataFrame(rows, "table_name string, id long, updated_at long")
    work = spark.createDataFrame([("a", 100, 0), ("b", 100, 7)], "table_name string, cursor long, last_id long")
    chosen = select.incremental_select(src, work)
    got = sorted(((r.table_name, r.id, r.updated_at) for r in chosen.collect()), key=repr)
    assert got == sorted([r for r in rows if r[0] != "x" and (r[2] is None or r[2] >= 100)], key=repr)
    cps = {r.table_name: (r.current_watermark, r.last_id, r.records) for r in progress.advance_checkpoints(work, chosen).collect()}
    assert cps == {"a": (150, 2, 4), "b": (100, 7, 1)}
    pages = progress.page_summary(progress.assign_pages(chosen.select("table_name", "id", "updated_at"), page_size=2, wrap=4),
                                  work, page_size=2, wrap=4).orderBy("table_name", "page_no").collect()
    assert {t: sum(r.records for r in pages if r.table_name == t) for t in "ab"} == {"a": 4, "b": 1}
    assert [(r.running_watermark, r.running_last_id) for r in pages if r.table_name == "b"] == [(100, 7)]
    assert [(r.running_watermark, r.running_last_id) for r in pages if r.table_name == "a"][-1] == (150, 2)


def test_run_lands_and_quarantines(spark, scratch):
    contracts = S.source_contracts()
    gone = F.col("id") % 8 == 0
    source = S.source_records(spark, SF_SMALL).withColumns({
        "updated_at": F.when(~gone, F.col("updated_at")), "o_orderdate": F.when(~gone, F.col("o_orderdate"))})
    # One table's newest record has no id, another table has no times at all.
    source = source.withColumns({
        "id": F.when((F.col("table_name") != "2-HIGH") | (F.col("updated_at") < 890000000) | F.col("updated_at").isNull(), F.col("id")),
        "updated_at": F.when(F.col("table_name") != "5-LOW", F.col("updated_at")),
        "o_orderdate": F.when(F.col("table_name") != "5-LOW", F.col("o_orderdate"))})
    store = api.LogStore(spark, f"{scratch}/logs")
    args = dict(root=scratch, to_json=S.raw_json, native_time="o_orderdate")
    reg = registry_frame(spark, contracts)
    assert execute.run(store, source, reg, run_id="r1", now="2024-06-01 00:00:00", seq=1, **args) == ("incremental", "COMPLETED")
    landed = landing.read_run(spark, f"{scratch}/run=r1")
    want = source.where(F.col("updated_at").isNull() | (F.col("updated_at") >= S.SOURCE_START))
    assert landed.count() == want.count()
    assert sum(r.records_count for r in store.read("batch_logs").collect()) == want.count()
    raw = landing.read_run(spark, f"{scratch}/run=r1")
    quarantined = load.load_pages(raw, next(iter(contracts.values()))).quarantine.count()
    bad = S.raw_json(want).where(F.col("id").isNull() | F.col("updated_at").isNull()).count()
    assert bad > 0 and quarantined >= bad
    marks = {r.table_name: (r.current_watermark, r.last_id) for r in store.read("ingestion_checkpoints").collect()}
    known = want.where(F.col("id").isNotNull() & F.col("updated_at").isNotNull())
    top = {r.table_name: tuple(r.m) for r in known.groupBy("table_name").agg(F.max(F.struct("updated_at", "id")).alias("m")).collect()}
    assert marks == {"5-LOW": (S.SOURCE_START, 0)} | top
    assert execute.run(store, source, reg, run_id="r2", now="2024-06-02 00:00:00", seq=2, **args) == ("incremental", "COMPLETED")
