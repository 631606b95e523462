"""Property tests: merge idempotence, split runs = one run,
replays covering the range = full load, good / quarantine partition."""

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tidemark.operators import merge, progress, select
from tidemark.operators.joins import range_join

SETTINGS = settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))

records = st.lists(st.tuples(st.integers(0, 30), st.integers(0, 40), st.integers(0, 5)), min_size=1, max_size=60)


def frame(spark, rows):
    return spark.createDataFrame([(i, t, v) for i, t, v in rows], "id long, updated_at long, v long")


def rows_of(df):
    return sorted(tuple(r) for r in df.collect())


@SETTINGS
@given(records, records)
def test_upsert_twice_equals_once(spark, a, b):
    t, batch = frame(spark, a), frame(spark, b)
    once = merge.upsert_latest(merge.latest_per_key(t, "id", ["updated_at", "v"]), batch, "id")
    twice = merge.upsert_latest(once, batch, "id")
    assert rows_of(once) == rows_of(twice)
    # every key present, with its highest updated_at
    best = {}
    for i, ts, _ in a + b:
        best[i] = max(best.get(i, ts), ts)
    assert {r["id"]: r["updated_at"] for r in once.collect()} == best


@SETTINGS
@given(records, st.integers(0, 40))
def test_split_runs_equal_one_run(spark, rows, cut):
    """Run 1 reads from 0; its checkpoint feeds run 2.  The union of what
    both read, merged latest-per-id, equals one run over everything."""
    src = frame(spark, rows).withColumn("table_name", F.lit("T"))
    first_src = src.where(F.col("updated_at") < cut)
    work0 = spark.createDataFrame([("T", 0, 0)], "table_name string, cursor long, last_id long")
    run1 = select.incremental_select(first_src, work0)
    cp = progress.advance_checkpoints(work0, run1).select("table_name", F.col("current_watermark").alias("cursor"),
                                                          "last_id")
    run2 = select.incremental_select(src, cp)
    merged = merge.latest_per_key(run1.unionByName(run2).select("id", "updated_at", "v"), "id", ["updated_at", "v"])
    full = merge.latest_per_key(src.select("id", "updated_at", "v"), "id", ["updated_at", "v"])
    assert rows_of(merged) == rows_of(full)


@SETTINGS
@given(records, st.lists(st.integers(0, 40), min_size=1, max_size=4))
def test_replays_covering_range_equal_full_load(spark, rows, cuts):
    src = frame(spark, rows).withColumn("table_name", F.lit("T"))
    bounds = sorted(set([0, 41] + cuts))
    wins = [(f"w{i}", "T", lo, hi - 1) for i, (lo, hi) in enumerate(zip(bounds, bounds[1:]))]
    ev = spark.createDataFrame(wins, "event_id string, table_name string, start_watermark long, end_watermark long")
    got = range_join(src, ev, key="table_name", point="updated_at", start="start_watermark", end="end_watermark")
    replayed = got.select(F.col("__l.id").alias("id"), F.col("__l.updated_at").alias("updated_at"),
                          F.col("__l.v").alias("v"))
    assert rows_of(replayed) == rows_of(src.select("id", "updated_at", "v"))


@SETTINGS
@given(st.lists(st.sampled_from(['{"id":1,"name":"a","updated_at":2}', '{"id":"x","name":"a","updated_at":2}',
                                 '{"name":"a","updated_at":2}', '{"id":2,"updated_at":null,"name":"b"}',
                                 '[1]', 'nope', '{"id":3,"name":"c","updated_at":4,"zz":[1]}']),
                min_size=1, max_size=30))
def test_good_and_quarantine_partition_input(spark, raws):
    from tidemark.contracts import CONTRACTS
    from tidemark.operators import quality
    c = CONTRACTS["GenreSchema"]
    raw = spark.createDataFrame([(r,) for r in raws], "raw string")
    flagged = quality.flag_records(quality.parse_records(raw, c), c)
    good, bad = quality.split_good_quarantine(flagged, c)
    assert good.count() + bad.count() == len(raws)
    assert good.where(F.col("id").isNull() | F.col("updated_at").isNull()).count() == 0


@settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.dictionaries(st.sampled_from(["A", "B", "C"]),
                       st.tuples(st.integers(0, 60), st.integers(0, 4), st.integers(0, 3)), min_size=1))
def test_page_summary_matches_loop_model(spark, tables_spec):
    """Random tables (rows, resume pages, cursor shift): pages of 7 with a
    wrap at 21 equal the page-by-page model of the source system's loop."""
    from tests.test_progress import model
    size, wrap = 7, 21
    parts, work_rows = [], []
    for t, (n, resume_pages, shift) in tables_spec.items():
        parts.append(spark.range(n).select(F.lit(t).alias("table_name"), ((F.col("id") * 13) % max(n, 1) + 1).alias("id"),
                                           (F.lit(1000) + F.col("id") / 2).cast("long").alias("updated_at")))
        work_rows.append((t, 1000 + shift, shift, resume_pages * size))
    src = parts[0]
    for p in parts[1:]:
        src = src.unionByName(p)
    work = spark.createDataFrame(work_rows, "table_name string, cursor long, last_id long, offset_val int")
    sel = src.join(work, "table_name").where(F.col("updated_at") >= F.col("cursor"))
    pages = progress.page_summary(progress.assign_pages(sel, page_size=size, wrap=wrap),
                                  work, page_size=size, wrap=wrap)
    got = {}
    for r in pages.collect():
        got.setdefault(r["table_name"], []).append(
            (r["page_no"], r["offset_value"], r["cursor_value"], r["records"], r["running_watermark"],
             r["running_last_id"], r["is_last"]))
    rows = {t: [] for t in tables_spec}
    for r in sel.collect():
        rows[r["table_name"]].append((r["updated_at"], r["id"]))
    for t, cur, lid, off in work_rows:
        assert sorted(got[t]) == model(rows[t], size, wrap, cur, lid), t
