"""Control-frame helpers: literal frames, checked broadcasts, the checkpoint
folder."""

from pyspark.sql import functions as F

from tidemark.operators.joins import checked_broadcast
from tidemark.session import checkpoint_dir, literal_frame


def test_literal_frame_escaping_and_types(spark):
    df = literal_frame(spark, [("a'b\\c", 1, 2 ** 40, 1.5, True, ["x"], None), ("z", None, None, None, None, [], "q")],
                       "s string, i int, l bigint, d double, b boolean, arr array<string>, n string")
    rows = df.collect()
    assert rows[0]["s"] == "a'b\\c" and rows[0]["l"] == 2 ** 40 and rows[0]["arr"] == ["x"]
    assert rows[1]["i"] is None and rows[1]["arr"] == [] and rows[1]["n"] == "q"
    assert [f.dataType.simpleString() for f in df.schema.fields] == \
        ["string", "int", "bigint", "double", "boolean", "array<string>", "string"]
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "PythonRDD" not in plan and "ExistingRDD" not in plan


def test_checked_broadcast_respects_the_bound(spark):
    small = spark.range(10)
    big = spark.range(100).join(checked_broadcast(small, max_rows=5), "id")
    assert "strategy=broadcast" not in big._jdf.queryExecution().optimizedPlan().toString()
    ok = spark.range(100).join(checked_broadcast(small, max_rows=50), "id")
    assert "strategy=broadcast" in ok._jdf.queryExecution().optimizedPlan().toString()


def test_checkpoint_dir_is_read_from_the_session(spark):
    d = checkpoint_dir(spark)
    assert d and d == spark.sparkContext.getCheckpointDir()
