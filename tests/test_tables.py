"""Log tables, table modes, the change log and its compaction (S6-S8, M3),
drift acceptance (Q8), scalar helpers (F1, F8-F10)."""

import os

import pytest
from pyspark.sql import functions as F

from tidemark.contracts import registry_frame
from tidemark.functions import scalars
from tidemark.operators import quality
from tidemark.sources import tables


def test_table_modes(spark, scratch):
    p = os.path.join(scratch, "t")
    df = spark.createDataFrame([(1, "a")], "id long, v string")
    tables.write_table(df, p, "fail")
    with pytest.raises(Exception):
        tables.write_table(df, p, "fail")
    tables.write_table(df, p, "append")
    assert tables.read_table(spark, p).count() == 2
    tables.write_table(df, p, "replace")
    assert tables.read_table(spark, p).count() == 1
    empty = tables.read_table(spark, os.path.join(scratch, "none"), tables.log_schema("batch_logs"))
    assert empty.count() == 0 and empty.columns[0] == "batch_id"


def test_change_log_latest_and_compact(spark, scratch):
    p = os.path.join(scratch, "log")
    v1 = spark.createDataFrame([(1, "a", 10), (2, "b", 10)], "id long, v string, updated_at long")
    v2 = spark.createDataFrame([(1, "a2", 11)], "id long, v string, updated_at long")
    tables.append_changes(v1, p, changed_at=F.lit("2024-01-01").cast("timestamp_ntz"), seq=1)
    tables.append_changes(v2, p, changed_at=F.lit("2024-01-02").cast("timestamp_ntz"), seq=2)
    tables.append_changes(v2, p, changed_at=F.lit("2024-01-02").cast("timestamp_ntz"), seq=3)  # retried write
    cur = {r["id"]: r["v"] for r in tables.read_latest(spark, p, "id", ["updated_at"]).collect()}
    assert cur == {1: "a2", 2: "b"}
    with pytest.raises(ValueError):
        tables.compact(spark, p, p, "id", ["updated_at"])
    q = os.path.join(scratch, "log2")
    tables.compact(spark, p, q, "id", ["updated_at"])
    assert spark.read.parquet(q).count() == 2
    assert {r["id"]: r["v"] for r in tables.read_latest(spark, q, "id", ["updated_at"]).collect()} == cur


def test_create_log_tables_and_not_null(spark, scratch):
    names = tables.create_log_tables(spark, os.path.join(scratch, "logs"), prefix="t_logs_")
    assert len(names) == 5
    names2 = tables.create_log_tables(spark, os.path.join(scratch, "logs"), prefix="t_logs_")   # if absent
    assert names == names2
    assert spark.table("t_logs_batch_logs").columns == tables.log_schema("batch_logs").names
    runs = spark.createDataFrame([("r1", None, "RAW", "RUNNING")], "run_id string, started_at timestamp_ntz, "
                                                                   "layer string, status string")
    assert tables.not_null_violations(runs, "ingestion_runs").count() == 1


def test_mark_included(spark):
    hist = spark.createDataFrame(
        [("GameSchema", "h1", ["rating"], None, "NEW_COLUMN"), ("GameSchema", "h2", ["zz"], None, "NEW_COLUMN"),
         ("GameSchema", "h3", ["name"], None, "BREAKING_CHANGE")],
        "table_name string, schema_hash string, changed_columns array<string>, included_at timestamp_ntz, status string")
    now = F.lit("2024-06-01 00:00:00").cast("timestamp_ntz")
    out = {r["schema_hash"]: r["included_at"] for r in quality.mark_included(hist, registry_frame(spark), now).collect()}
    assert out["h1"] is not None and out["h2"] is None and out["h3"] is None


def test_scalars(spark):
    row = spark.range(1).select(
        scalars.duration_seconds(F.lit("2024-01-01 00:00:00").cast("timestamp_ntz"),
                                 F.lit("2024-01-01 00:00:02.5").cast("timestamp_ntz")).alias("d"),
        scalars.duration_seconds(F.lit("2024-01-01 00:00:00").cast("timestamp_ntz"),
                                 F.lit(None).cast("timestamp_ntz")).alias("running"),
        scalars.page_path(F.lit("/games"), F.lit(100), F.lit(500)).alias("path"),
        scalars.alert_text(F.lit("ERROR"), F.lit("x")).alias("err"),
        scalars.alert_text(F.lit("INFO"), F.lit("y")).alias("info"),
        scalars.truncate_message(F.lit("a" * 1000 + "b" * 1000)).alias("cut"),
        scalars.epoch_seconds(F.lit("2020-01-01 00:00:00").cast("timestamp_ntz")).alias("e"),
    ).first()
    assert row["d"] == 3 and row["running"] is None
    assert row["path"] == "/games/100_500.json"
    assert row["err"] == "[ERROR] x @everyone" and row["info"] == "[INFO] y"
    assert len(row["cut"]) == 1900 + 5 and row["cut"].startswith("a" * 200 + "\n...\n")
    assert row["cut"].endswith("b" * 1000) and row["e"] == 1577836800
    parts = spark.range(1).select(*scalars.page_path_parts(F.lit("x/games/1577836800_9500.json"))).first()
    assert tuple(parts) == ("/games", 1577836800, 9500)


def test_id_arrays_resolve(spark):
    from tidemark.operators import relations
    games = spark.createDataFrame([(1, [10, 11, 99]), (2, []), (3, None)], "id long, genres array<long>")
    genres = spark.createDataFrame([(10, "rpg"), (11, "action")], "gid long, name string")
    out = {r["id"]: (r["n_ids"], r["n_resolved"]) for r in
           relations.resolve_ids(games, "id", "genres", genres, "gid", "name").collect()}
    assert out == {1: (3, 2), 2: (0, 0), 3: (0, 0)}
    lists = {r["id"]: r["names"] for r in relations.resolved_lists(games, "id", "genres", genres, "gid", "name").collect()}
    assert lists[1] == ["action", "rpg"] and lists[2] == []


def test_replace_drops_untouched_partitions(spark, scratch):
    p = os.path.join(scratch, "parts")
    tables.write_table(spark.createDataFrame([(1, "a"), (2, "b")], "id long, part string"), p, "fail", ["part"])
    tables.write_table(spark.createDataFrame([(3, "a")], "id long, part string"), p, "replace", ["part"])
    assert sorted(r["id"] for r in tables.read_table(spark, p).collect()) == [3]


def test_keyed_log_survives_restarts(spark, scratch):
    """Two paths that share a long tail, another number of shuffle partitions,
    a retried append, another key, and compaction."""
    tail = "x" * 60 + "/k"
    log, twin = (tables.KeyedLog(os.path.join(scratch, d, tail), "id") for d in ("one", "two"))
    v1 = spark.range(1000).select("id", F.lit("a").alias("v"), F.lit(10).alias("updated_at"))
    v2 = v1.where("id < 300").select("id", F.lit("b").alias("v"), F.lit(11).alias("updated_at"))
    log.append(v1, changed_at=F.lit("2024-01-01").cast("timestamp_ntz"), seq=1)
    assert not twin.exists(spark)
    old = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "11")
    try:
        again = tables.KeyedLog(log.path, "id")
        for _ in range(2):
            again.append(v2, changed_at=F.lit("2024-01-02").cast("timestamp_ntz"), seq=2)
        rows = again.latest(spark, ["updated_at"]).collect()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)
    assert len(rows) == 1000 and sum(r["v"] == "b" for r in rows) == 300
    with pytest.raises(ValueError):
        tables.KeyedLog(log.path, ["id", "v"]).latest(spark)
    with pytest.raises(FileNotFoundError):
        twin.latest(spark)
    log.compact_into(spark, twin, ["updated_at"])
    assert twin.versions(spark).count() == 1000
    with pytest.raises(ValueError):
        log.compact_into(spark, log)


def test_two_updates_of_one_key_keep_one_row(spark):
    from tidemark.operators import merge
    target = spark.createDataFrame([(1, "a"), (2, "b")], "id long, v string")
    twice = spark.createDataFrame([(1, "x"), (1, "y"), (3, "z"), (3, "z")], "id long, v string")
    out = merge.keyed_update(target, twice, "id", {"v": F.col("u__v")})
    assert sorted(map(tuple, out.collect())) == [(1, "y"), (2, "b")]
    up = merge.upsert_columns(target, twice, "id", ["v"])
    assert sorted(map(tuple, up.collect())) == [(1, "y"), (2, "b"), (3, "z")]


def test_aliased_fields(spark):
    from pyspark.sql import types as T

    from tidemark.contracts import Contract, FieldSpec
    c = Contract(name="T", endpoint="/t", fields=(
        FieldSpec("id", T.LongType(), True), FieldSpec("updated_at", T.LongType(), False),
        FieldSpec("kind", T.StringType(), True, alias="type")))
    raw = spark.createDataFrame([("T", '{"id":1,"updated_at":2,"type":"x"}'), ("T", '{"id":1,"updated_at":2}')],
                                "table_name string, raw string")
    flagged = quality.flag_records(quality.parse_records(raw, c), c)
    assert sorted(str(r["quality_issue"]) for r in flagged.collect()) == ["None", "missing_kind"]
    good, _ = quality.split_good_quarantine(flagged, c)
    assert good.select("kind").first()[0] == "x"
    assert quality.new_columns(quality.observed_keys(raw), registry_frame(spark, {"T": c})).count() == 0


def test_small_helpers(spark):
    r = spark.range(1).select(
        scalars.elapsed_ms(F.lit(10), F.lit(12)).alias("ms"),
        scalars.from_epoch(F.lit(1577836800)).alias("ts"),
        scalars.empty_if_null(F.lit(None).cast("array<bigint>")).alias("empty"),
        F.lit(scalars.clamp_limit(900)).alias("lim"),
        scalars.safe_ratio(F.lit(1), F.lit(0)).alias("ratio"),
    ).first()
    assert r["ms"] == 2000 and str(r["ts"]) == "2020-01-01 00:00:00"
    assert r["empty"] == [] and r["lim"] == 500 and r["ratio"] is None
    nulls = quality.null_counts(spark.createDataFrame([(1, None), (None, None)], "a long, b string"), ["a", "b"])
    assert tuple(nulls.first()) == (1, 2)
