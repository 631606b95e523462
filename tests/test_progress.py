"""Paging arithmetic against a page-by-page Python model of the source
system's loop (pages of ``size``, offset wrapping at ``wrap``, running
``max_seen`` / ``last_id``), and the distributed row index against
``row_number``."""

from pyspark.sql import Window
from pyspark.sql import functions as F

from tidemark.operators import progress
from tidemark.operators.sequence import row_index


def model(rows, size, wrap, cursor, last_id):
    """rows: (ts, id) of one table, all >= cursor.  One output per page
    plus the terminal empty page when the table ends on a page boundary."""
    rows = sorted(rows)
    max_seen, lid, block_cursor = cursor, last_id, cursor
    out, p = [], 0
    while True:
        chunk = rows[p * size:(p + 1) * size]
        offset = (p * size) % wrap
        if offset == 0 and p > 0:
            block_cursor = max_seen
        if not chunk:
            out.append((p, offset, block_cursor, 0, max_seen, lid, True))
            break
        bmax = max(t for t, _ in chunk)
        bid = max(i for t, i in chunk if t == bmax)
        if bmax > max_seen:
            max_seen, lid = bmax, bid
        else:
            lid = max(lid, bid)
        out.append((p, offset, block_cursor, len(chunk), max_seen, lid, len(chunk) < size))
        if len(chunk) < size:
            break
        p += 1
    return out


def make_source(spark, sizes):
    parts = []
    for t, n in sizes.items():
        parts.append(spark.range(n).select(
            F.lit(t).alias("table_name"),
            ((F.col("id") * 7919) % n + 1).alias("id"),
            (F.lit(1000) + F.col("id") / 3).cast("long").alias("updated_at")))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def test_pages_match_loop_model(spark):
    sizes = {"A": 49, "B": 50, "C": 101, "D": 7}
    src = make_source(spark, sizes)
    work = spark.createDataFrame([("A", 1000, 0), ("B", 1000, 0), ("C", 1000, 5), ("D", 1002, 2), ("E", 5000, 3)],
                                 "table_name string, cursor long, last_id long")
    sel = src.join(work, "table_name").where(F.col("updated_at") >= F.col("cursor"))
    pages = progress.page_summary(progress.assign_pages(sel, page_size=10, wrap=50), work, page_size=10, wrap=50)
    got = {}
    for r in pages.collect():
        got.setdefault(r["table_name"], []).append(
            (r["page_no"], r["offset_value"], r["cursor_value"], r["records"], r["running_watermark"],
             r["running_last_id"], r["is_last"]))
    local = {(r["table_name"]): [] for r in work.collect()}
    for r in sel.collect():
        local[r["table_name"]].append((r["updated_at"], r["id"]))
    for w in work.collect():
        expect = model(local[w["table_name"]], 10, 50, w["cursor"], w["last_id"])
        assert sorted(got[w["table_name"]]) == expect, w["table_name"]
    # E selects nothing: one empty terminal page at the stored cursor
    assert got["E"] == [(0, 0, 5000, 0, 5000, 3, True)]
    # B ends exactly on a page boundary: 5 full pages + an empty one
    assert [p[3] for p in sorted(got["B"])] == [10] * 5 + [0]


def test_advance_keeps_cursor_when_nothing_selected(spark):
    work = spark.createDataFrame([("A", 10, 4), ("B", 10, 4)], "table_name string, cursor long, last_id long")
    sel = spark.createDataFrame([("A", 7, 10), ("A", 2, 10), ("A", 3, 12)], "table_name string, id long, updated_at long")
    out = {r["table_name"]: (r["current_watermark"], r["last_id"], r["records"])
           for r in progress.advance_checkpoints(work, sel).collect()}
    assert out == {"A": (12, 3, 3), "B": (10, 4, 0)}
    # max equal to the stored cursor: keep the larger id
    sel2 = spark.createDataFrame([("A", 2, 10)], "table_name string, id long, updated_at long")
    out2 = progress.advance_checkpoints(work.where("table_name = 'A'"), sel2).first()
    assert (out2["current_watermark"], out2["last_id"]) == (10, 4)


def test_row_index_matches_row_number_under_skew(spark):
    n = 3000
    # key 0 holds a third of all rows; many ties on ts
    df = spark.range(n).select(
        F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id") % 17).alias("k"),
        (F.col("id") % 50).alias("ts"), F.col("id").alias("pk"))
    ref = df.withColumn("rn", F.row_number().over(Window.partitionBy("k").orderBy("ts", "pk")).cast("long"))
    b = sorted(tuple(r) for r in ref.select("k", "ts", "pk", "rn").collect())
    for n in (7, None):   # a fixed count, and AQE-sized ranges
        ours = row_index(df, "k", ["ts", "pk"], name="rn", num_partitions=n)
        assert sorted(tuple(r) for r in ours.select("k", "ts", "pk", "rn").collect()) == b


def test_row_index_with_fully_tied_keys(spark):
    # a third of the rows share one (key, ts) and have no unique column
    df = spark.range(900).select(F.when(F.col("id") < 300, F.lit(0)).otherwise(F.col("id") % 5 + 1).alias("k"),
                                 F.when(F.col("id") < 300, F.lit(7)).otherwise(F.col("id")).alias("ts"))
    out = row_index(df, "k", ["ts"], name="rn", num_partitions=6)
    got = out.where("k = 0").agg(F.min("rn"), F.max("rn"), F.countDistinct("rn")).first()
    assert tuple(got) == (1, 300, 300)


def test_hot_group_is_split_across_ranges(spark):
    """One table holds a third of the rows, all at the same second: the range
    shuffle still spreads it (the row-index tie-breaker keeps keys unique)."""
    from tidemark.operators import sequence
    n = 6000
    df = spark.range(n).select(
        F.when(F.col("id") < n // 3, F.lit("HOT")).otherwise(F.concat(F.lit("t"), (F.col("id") % 40).cast("string")))
         .alias("table_name"),
        F.when(F.col("id") < n // 3, F.lit(5)).otherwise(F.col("id")).alias("updated_at"),
        F.lit(1).alias("id"))   # no unique column at all
    captured = {}
    real = sequence.materialize

    def spy(frame):
        out = real(frame)
        if "__pid" in frame.columns and "__n" not in frame.columns:
            captured["sizes"] = [r["c"] for r in out.where("table_name = 'HOT'").groupBy("__pid")
                                 .agg(F.count(F.lit(1)).alias("c")).collect()]
        return out

    sequence.materialize = spy
    try:
        out = row_index(df, "table_name", ["updated_at", "id"], name="rn", num_partitions=8)
        hot = out.where("table_name = 'HOT'").agg(F.min("rn"), F.max("rn"), F.countDistinct("rn")).first()
    finally:
        sequence.materialize = real
    assert tuple(hot) == (1, n // 3, n // 3)
    assert len(captured["sizes"]) >= 2 and max(captured["sizes"]) < n // 3


def test_stored_offset_never_skips_rows(spark):
    """A table interrupted at an offset is read from its cursor again, so rows
    that moved since are not lost."""
    from tidemark.operators import select
    src = make_source(spark, {"A": 67, "B": 60})
    work = spark.createDataFrame([("A", 1000, None, 30), ("B", 1010, 4, None)],
                                 "table_name string, cursor long, last_id long, offset_val int")
    sel = select.incremental_select(src, work)
    pages = progress.page_summary(progress.assign_pages(sel, page_size=10, wrap=50), work.fillna(0), page_size=10, wrap=50)
    got, local = {}, {"A": [], "B": []}
    for r in pages.collect():
        got.setdefault(r["table_name"], []).append(
            (r["page_no"], r["offset_value"], r["cursor_value"], r["records"], r["running_watermark"],
             r["running_last_id"], r["is_last"]))
    for r in sel.collect():
        local[r["table_name"]].append((r["updated_at"], r["id"]))
        assert r["last_id"] == {"A": 0, "B": 4}[r["table_name"]] and r["offset_val"] == {"A": 30, "B": 0}[r["table_name"]]
    assert len(local["A"]) == 67 and len(local["B"]) == 30
    assert sorted(got["A"]) == model(local["A"], 10, 50, 1000, 0)
    assert sorted(got["B"]) == model(local["B"], 10, 50, 1010, 4)


def test_fixture_sizes_with_real_constants(spark):
    """499 rows: one short last page; 500: a full page then an empty one;
    10,001: the offset wraps to 0 and the cursor moves to the highest
    updated_at of the first 10,000 rows."""
    src = make_source(spark, {"S": 499, "E": 500, "W": 10001})
    work = spark.createDataFrame([("S", 1000, 0), ("E", 1000, 0), ("W", 1000, 0)],
                                 "table_name string, cursor long, last_id long")
    sel = src.join(work, "table_name").where(F.col("updated_at") >= F.col("cursor"))
    pages = {}
    for r in progress.page_summary(progress.assign_pages(sel), work).collect():
        pages.setdefault(r["table_name"], {})[r["page_no"]] = r
    assert [(p["records"], p["is_last"]) for _, p in sorted(pages["S"].items())] == [(499, True)]
    assert [(p["records"], p["is_last"]) for _, p in sorted(pages["E"].items())] == [(500, False), (0, True)]
    w = pages["W"]
    assert len(w) == 21 and w[19]["offset_value"] == 9500 and w[19]["cursor_value"] == 1000
    first_10k_max = 1000 + (10000 - 1) // 3
    assert (w[20]["offset_value"], w[20]["block_no"], w[20]["records"], w[20]["is_last"]) == (0, 1, 1, True)
    assert w[20]["cursor_value"] == first_10k_max
