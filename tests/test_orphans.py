"""Anti-joins of large sides: tasks of bounded rows, whatever their bytes."""

from pyspark.sql import functions as F

from tidemark.operators import quality


def keyed(spark, n, key):
    return spark.range(n).select("id", F.expr(key).cast("string").alias("run_id"))


def test_a_task_joins_a_bounded_number_of_rows(spark):
    child = keyed(spark, 3_600_000, "id DIV 4")
    parent = keyed(spark, 1_000_000, "id * 10")
    out = quality.orphans(child, parent, "run_id")
    found = out.groupBy(F.spark_partition_id().alias("task")).agg(F.count(F.lit(1)).alias("n"), F.sum("id").alias("s")).collect()
    want = [i for i in range(3_600_000) if i // 4 % 10]
    assert sum(r.n for r in found) == len(want) and sum(r.s for r in found) == sum(want)
    assert max(r.n for r in found) < 650_000


def test_keys_that_repeat_or_are_null(spark, monkeypatch):
    monkeypatch.setattr(quality, "PIECE", 300)
    child = keyed(spark, 4000, "CASE WHEN id % 7 > 0 THEN id % 900 END")
    parent = keyed(spark, 3000, "CASE WHEN id % 5 > 0 THEN id % 400 END")
    there = {i % 400 for i in range(3000) if i % 5}
    want = sorted(i for i in range(4000) if i % 7 and i % 900 not in there)
    assert quality.pieces("run_id", child.dropna(), parent.dropna()) > 4
    assert sorted(r.id for r in quality.orphans(child, parent, "run_id").collect()) == want


def test_a_hot_key_is_left_to_the_skewed_join(spark, monkeypatch):
    monkeypatch.setattr(quality, "PIECE", 300)
    child = keyed(spark, 4000, "CASE WHEN id < 1500 THEN -1 ELSE id END")
    parent = keyed(spark, 2000, "id")
    assert quality.pieces("run_id", child, parent) == 0
    assert quality.pieces("run_id", child.limit(0), parent.limit(0)) == 0
    assert sorted(r.id for r in quality.orphans(child, parent, "run_id").collect()) == [*range(1500), *range(2000, 4000)]


def test_pieces_grow_first_and_their_number_later(spark, monkeypatch):
    keys = keyed(spark, 100_000, "id")
    for piece, n in ((5000, 20), (500, 200), (200, 200), (100, 250)):
        monkeypatch.setattr(quality, "PIECE", piece)
        monkeypatch.setattr(quality, "BUCKETS", 10_000)
        assert quality.pieces("run_id", keys) == n
