"""Stream = batch and resume after new pages land."""

import os

from pyspark.sql import functions as F

from tidemark.contracts import CONTRACTS
from tidemark.plans import load
from tidemark.sources import landing
from tidemark.streaming import landing_stream

GENRE = CONTRACTS["GenreSchema"]


def pages(spark, rows):
    return spark.createDataFrame(rows, "endpoint string, cursor_value long, offset_value int, raw string")


def test_stream_equals_batch_and_resumes(spark, scratch):
    base = os.path.join(scratch, "landing")
    first = [("/genres", 0, 0, '{"id":1,"name":"a","updated_at":5}'),
             ("/genres", 0, 0, '{"id":2,"name":"b","updated_at":6}'),
             ("/genres", 0, 500, '{"id":"bad","name":"c","updated_at":7}'),
             ("/genres", 0, 500, '{"id":1,"name":"a2","updated_at":8}')]
    landing.write_pages(pages(spark, first), base)
    paths = landing_stream.StreamPaths(landing=base, target=os.path.join(scratch, "t"),
                                       quarantine=os.path.join(scratch, "q"), checkpoint=os.path.join(scratch, "c"))
    n1 = landing_stream.run_landing_stream(spark, GENRE, paths, max_files_per_trigger=1)
    assert n1 == 2   # one micro-batch per page file
    streamed = landing_stream.current_table(spark, paths, GENRE).select(*GENRE.names)
    batch = load.load_pages(landing.read_pages(spark, base), GENRE).table
    assert sorted(map(tuple, streamed.collect())) == sorted(map(tuple, batch.collect()))
    assert {r["id"]: r["name"] for r in streamed.collect()} == {1: "a2", 2: "b"}
    assert paths.quarantine_log().latest(spark).count() == 1
    # a new page lands; the restarted stream reads only it
    landing.write_pages(pages(spark, [("/genres", 8, 0, '{"id":2,"name":"b2","updated_at":9}')]), base)
    n2 = landing_stream.run_landing_stream(spark, GENRE, paths, max_files_per_trigger=1)
    assert n2 == 1
    now = {r["id"]: r["name"] for r in landing_stream.current_table(spark, paths, GENRE).collect()}
    assert now == {1: "a2", 2: "b2"}


def test_dedupe_within_watermark(spark, scratch):
    src = os.path.join(scratch, "in")
    spark.createDataFrame([(1, "2024-01-01 00:00:00"), (1, "2024-01-01 00:00:00"), (2, "2024-01-01 00:00:05")],
                          "id long, ts string").write.parquet(src)
    stream = spark.readStream.schema("id long, ts string").parquet(src).withColumn("ts", F.col("ts").cast("timestamp"))
    out = landing_stream.dedupe_stream(stream, "id", "ts", "1 minute")
    got = []
    q = (out.writeStream.trigger(availableNow=True).option("checkpointLocation", os.path.join(scratch, "ck"))
            .foreachBatch(lambda b, e: got.extend(b.collect())).start())
    q.awaitTermination()
    assert sorted(r["id"] for r in got) == [1, 2]


def test_restart_after_failed_batch(spark, scratch, monkeypatch):
    """A micro-batch that dies after appending its good rows is replayed on
    restart; the latest-per-key read hides the duplicate append."""
    import pytest
    from pyspark.errors import StreamingQueryException

    base = os.path.join(scratch, "landing")
    rows = [("/genres", 0, off, '{"id":%d,"name":"n%d","updated_at":%d}' % (i, i, i))
            for off in (0, 500, 1000) for i in range(off, off + 3)]
    landing.write_pages(pages(spark, rows), base)
    paths = landing_stream.StreamPaths(landing=base, target=os.path.join(scratch, "t"),
                                       quarantine=os.path.join(scratch, "q"), checkpoint=os.path.join(scratch, "c"))
    real = landing_stream.load_batch
    calls = {"n": 0}

    def flaky(raw, contract, p, seq, changed_at):
        calls["n"] += 1
        if calls["n"] == 2:   # second batch: write the good rows, then die
            from tidemark.operators import quality
            good, _ = quality.split_good_quarantine(
                quality.flag_records(quality.parse_records(raw, contract), contract), contract)
            p.target_log(contract).append(good, changed_at=changed_at, seq=seq)
            raise RuntimeError("executor lost")
        return real(raw, contract, p, seq, changed_at)

    monkeypatch.setattr(landing_stream, "load_batch", flaky)
    with pytest.raises(StreamingQueryException):
        landing_stream.run_landing_stream(spark, GENRE, paths, max_files_per_trigger=1)
    monkeypatch.setattr(landing_stream, "load_batch", real)
    landing_stream.run_landing_stream(spark, GENRE, paths, max_files_per_trigger=1)
    table = landing_stream.current_table(spark, paths, GENRE)
    assert sorted(r["id"] for r in table.collect()) == sorted(int(r[3].split(",")[0].split(":")[1]) for r in rows)
    assert paths.target_log(GENRE).versions(spark).count() > table.count()   # the replayed append is there, and hidden


def test_block_layout_matches_page_layout(spark, scratch):
    rows = [("/genres", 0, off, '{"id":%d,"name":"n","updated_at":%d}' % (i, i))
            for off in (0, 500) for i in range(off, off + 4)] + [("/genres", 0, 500, 'not json')]
    df = pages(spark, rows)
    a, b = os.path.join(scratch, "page"), os.path.join(scratch, "block")
    landing.write_pages(df, a)
    landing.write_pages(df, b, layout="block")
    key = ["endpoint", "cursor", "offset", "raw"]
    pa = sorted(map(tuple, landing.read_pages(spark, a).select(*key).collect()))
    pb = sorted(map(tuple, landing.read_pages(spark, b, layout="block").select(*key).collect()))
    assert pa == pb and len(pa) == 9
    # one folder per block instead of one per page
    assert len(os.listdir(os.path.join(b, "endpoint=genres"))) == 1
    paths = landing_stream.StreamPaths(landing=b, target=os.path.join(scratch, "t"),
                                       quarantine=os.path.join(scratch, "q"), checkpoint=os.path.join(scratch, "c"))
    landing_stream.run_landing_stream(spark, GENRE, paths, layout="block")
    assert landing_stream.current_table(spark, paths, GENRE).count() == 8
