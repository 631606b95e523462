"""Plan guards for every registered query: no nested-loop or cartesian join
and no Python evaluation, in the final plan and in the jobs that run while the
query is built (read from Spark's event log)."""

import os

import __spark_entry__ as E
from tests.conftest import SF_SMALL
from tidemark.plans import catalog

FORBIDDEN = ("BroadcastNestedLoopJoin", "CartesianProduct", "BatchEvalPython", "ArrowEvalPython",
             "FlatMapGroupsInPandas", "MapInPandas", "MapInArrow")


def logged_plans(spark, start=0):
    """Lines of the session's event log from byte ``start`` that hold a plan."""
    bus = spark.sparkContext._jsc.sc().listenerBus()
    bus.waitUntilEmpty(60_000)
    folder = spark.conf.get("spark.eventLog.dir")
    (path,) = [os.path.join(folder, f) for f in os.listdir(folder)]
    with open(path, encoding="utf-8") as f:
        f.seek(start)
        text = f.read()
    return start + len(text.encode()), [x for x in text.splitlines() if '"sparkPlanInfo"' in x]


def test_no_cross_joins_or_python_in_any_plan(spark):
    bad, (at, _) = {}, logged_plans(spark)
    for name, fn in sorted(E.queries().items()):
        if name not in catalog.QUERIES:
            continue
        plan = fn(spark, SF_SMALL)._jdf.queryExecution().executedPlan().toString()
        at, built = logged_plans(spark, at)
        hits = [f for f in FORBIDDEN if f in plan or any(f in x for x in built)]
        if hits:
            bad[name] = hits
    assert bad == {}
