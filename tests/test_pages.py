"""Hand-made raw pages (FIXTURES.md section C) through landing, parsing,
quality checks, drift detection and the latest-row merge."""

import json
import os

from pyspark.sql import functions as F

from tidemark.contracts import CONTRACTS, columns_frame, registry_frame
from tidemark.operators import merge, progress, quality
from tidemark.plans import load
from tidemark.sources import landing

GAME = CONTRACTS["GameSchema"]


def land_array(base, endpoint, cursor, offset, records):
    d = os.path.join(base, endpoint.lstrip("/"))
    os.makedirs(d, exist_ok=True)
    with open(os.path.join(d, f"{cursor}_{offset}.json"), "w") as f:
        f.write(json.dumps(records) if not isinstance(records, str) else records)


def load_cases(spark, scratch, pages):
    for (cursor, offset), recs in pages.items():
        land_array(scratch, "/games", cursor, offset, recs)
    raw = landing.read_array_pages(spark, scratch, endpoint="/games")
    flagged = quality.flag_records(quality.parse_records(raw, GAME), GAME)
    return raw, flagged


def issues(flagged):
    return {r["raw"]: r["quality_issue"] for r in flagged.select("raw", "quality_issue").collect()}


def test_plain_record_types_and_defaults(spark, scratch):
    _, flagged = load_cases(spark, scratch, {
        (10, 0): [{"id": 1, "name": "a", "updated_at": 10, "genres": [1, 2], "rating": 3}],
        (10, 500): [{"id": 7, "name": "g", "updated_at": 15}],
    })
    good, bad = quality.split_good_quarantine(flagged, GAME)
    rows = {r["id"]: r for r in good.collect()}
    assert bad.count() == 0
    assert rows[1]["rating"] == 3.0 and rows[1]["genres"] == [1, 2]
    assert rows[7]["genres"] == [] and rows[7]["platforms"] == []   # F13 default


def test_bad_records_are_quarantined_one_by_one(spark, scratch):
    page = [
        {"name": "x", "updated_at": 13},                 # missing id
        {"id": 3, "updated_at": None},                   # null updated_at (T16)
        {"id": "bad", "name": "c", "updated_at": 12},    # wrong type
        {"id": "6", "name": "f", "updated_at": 3},       # numeric text
        {"id": 5, "name": "e", "updated_at": 1.5},       # fraction in an integer
        {"id": 4, "name": "d", "updated_at": 14, "zz": 1},   # extra key: good
        {"id": 8, "updated_at": 20},                     # required name missing
    ]
    _, flagged = load_cases(spark, scratch, {(0, 0): page})
    got = sorted((r["quality_issue"] or "good") for r in flagged.collect())
    assert got == sorted(["missing_id", "missing_updated_at", "wrong_type", "wrong_type", "wrong_type", "good",
                          "missing_name"])
    # every record lands in exactly one side
    good, bad = quality.split_good_quarantine(flagged, GAME)
    assert good.count() + bad.count() == len(page)
    # the source system's table-level verdict: the table fails
    verdict = quality.table_failures(flagged.withColumn("table_name", F.lit("GameSchema"))).first()
    assert verdict["table_fails"] and verdict["bad_records"] == 2   # no id, null updated_at


def test_empty_page_and_missing_folder(spark, scratch):
    raw, flagged = load_cases(spark, scratch, {(0, 0): []})
    assert raw.count() == 0 and flagged.count() == 0
    assert landing.read_array_pages(spark, scratch, endpoint="/nothing").count() == 0
    assert landing.read_pages(spark, os.path.join(scratch, "absent")).count() == 0


def test_page_path_is_parsed(spark, scratch):
    raw, _ = load_cases(spark, scratch, {(1577836800, 9500): [{"id": 1, "name": "a", "updated_at": 1}]})
    r = raw.first()
    assert (r["endpoint"], r["cursor"], r["offset"], r["position"]) == ("/games", 1577836800, 9500, 0)


def test_new_column_reported(spark, scratch):
    raw, _ = load_cases(spark, scratch, {(0, 0): [{"id": 4, "name": "d", "updated_at": 14, "zz": 1},
                                                  {"id": 5, "name": "e", "updated_at": 15}]})
    observed = quality.observed_keys(raw.withColumn("table_name", F.lit("GameSchema")))
    new = quality.new_columns(observed, registry_frame(spark)).collect()
    assert [(r["column_name"], r["data_type"], r["records"]) for r in new] == [("zz", "integer", 1)]
    drift = quality.drift_rows(observed, registry_frame(spark), columns_frame(spark), run_id=F.lit("r1"),
                               detected_at=F.current_timestamp()).collect()
    assert len(drift) == 1 and drift[0]["status"] == "NEW_COLUMN" and drift[0]["changed_columns"] == ["zz"]
    assert drift[0]["included_at"] is None


def test_tie_at_the_mark_takes_largest_id(spark):
    df = spark.createDataFrame([("T", 8, 100), ("T", 9, 100), ("T", 3, 99)], "table_name string, id long, updated_at long")
    r = progress.high_watermark(df).first()
    assert (r["max_updated_at"], r["last_id"]) == (100, 9)


def test_re_read_record_keeps_newer_version(spark, scratch):
    raw, _ = load_cases(spark, scratch, {
        (0, 0): [{"id": 1, "name": "old", "updated_at": 10}],
        (10, 0): [{"id": 1, "name": "new", "updated_at": 11}],
    })
    loaded = load.load_pages(raw, GAME)
    rows = loaded.table.collect()
    assert len(rows) == 1 and rows[0]["name"] == "new"
    again = load.load_pages(raw, GAME, target=loaded.table).table.collect()
    assert [(r["id"], r["name"]) for r in again] == [(1, "new")]


def test_partitioned_landing_roundtrip_and_overwrite(spark, scratch):
    base = os.path.join(scratch, "landing")
    recs = spark.createDataFrame(
        [("/games", 10, 0, '{"id":1}'), ("/games", 10, 0, '{"id":2}'), ("/games", 10, 500, '{"id":3}')],
        "endpoint string, cursor_value long, offset_value int, raw string")
    landing.write_pages(recs, base)
    counts = {(r["cursor_value"], r["offset_value"]): r["records"]
              for r in landing.page_counts(landing.read_pages(spark, base)).collect()}
    assert counts == {(10, 0): 2, (10, 500): 1}
    # rewriting one page replaces that page only (dynamic partition overwrite)
    landing.write_pages(spark.createDataFrame([("/games", 10, 0, '{"id":9}')],
                                              "endpoint string, cursor_value long, offset_value int, raw string"),
                        base)
    counts = {(r["cursor_value"], r["offset_value"]): r["records"]
              for r in landing.page_counts(landing.read_pages(spark, base)).collect()}
    assert counts == {(10, 0): 1, (10, 500): 1}


def test_signature_matches_declaration_order():
    import hashlib
    names = [f.name for f in GAME.fields]
    assert names[:5] == ["id", "name", "slug", "summary", "storyline"] and names[-1] == "checksum"
    assert GAME.signature() == hashlib.sha256(" ".join(names).encode()).hexdigest()
    assert len(CONTRACTS) == 5 and all(c.start == 1577836800 for c in CONTRACTS.values())


def test_latest_per_key_ties_incoming_wins(spark):
    target = spark.createDataFrame([(1, 10, "t")], "id long, updated_at long, v string")
    batch = spark.createDataFrame([(1, 10, "b"), (2, 5, "b")], "id long, updated_at long, v string")
    out = {r["id"]: r["v"] for r in merge.upsert_latest(target, batch, "id").collect()}
    assert out == {1: "b", 2: "b"}


def test_encode_and_missing_required(spark):
    df = spark.createDataFrame([(1, None, 10)], "id long, name string, updated_at long")
    assert landing.encode_records(df).first()["raw"] == '{"id":1,"updated_at":10}'   # nulls left out
    raw = spark.createDataFrame([("GenreSchema", '{"id":1,"updated_at":2}'), ("GenreSchema", '{"id":"x"}')],
                                "table_name string, raw string")
    from tidemark.contracts import columns_frame
    observed = quality.observed_keys(raw)
    got = sorted((r["column_name"], r["observed_type"])
                 for r in quality.breaking_changes(observed, columns_frame(spark), registry_frame(spark)).collect())
    assert got == [("id", "string"), ("name", "missing")]
