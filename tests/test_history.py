"""Column intervals against a plain loop."""

import random

from tidemark.contracts import table_contract
from tidemark.operators import history as H


def plain(rows):
    """rows (table, snapshot, columns) -> intervals."""
    out = []
    for table in {t for t, _, _ in rows}:
        days = sorted({s for t, s, c in rows if t == table and c})
        for column in {c for t, _, cs in rows if t == table for c in cs}:
            has = [any(t == table and s == day and column in cs for t, s, cs in rows) for day in days]
            start = None
            for n, there in enumerate([*has, False]):
                if there and start is None:
                    start = n
                if not there and start is not None:
                    records = sum(column in cs for t, s, cs in rows if t == table and days[start] <= s <= days[n - 1])
                    out.append((table, column, days[start], days[n - 1], n - start, records, n == len(days)))
                    start = None
    return sorted(out)


def test_intervals(spark):
    rng = random.Random(8)
    rows = [(rng.choice("ab"), rng.randint(1, 12), sorted(rng.sample(["x", "y", "z", "q w"], rng.randint(1, 3)))) for _ in range(40)]
    raws = [(t, s, "{" + ",".join(f'"{c}":{n}' for n, c in enumerate(cs)) + "}") for t, s, cs in rows]
    raws += [("a", 3, None), ("a", 4, "no object"), ("a", 40, "{}"), ("b", 5, "[1,2]")]
    raw = spark.createDataFrame(raws, "table_name string, snapshot int, raw string")
    out = H.column_intervals(H.column_presence(raw))
    cols = ("table_name", "column_name", "first_seen", "last_seen", "snapshots", "records", "open")
    assert sorted(tuple(r[c] for c in cols) for r in out.collect()) == plain(rows)
    assert H.column_intervals(H.column_presence(raw.limit(0))).count() == 0


def test_included_by_the_first_version_that_declares(spark):
    old = {"a": table_contract("a", [("x", "bigint", True)])}
    new = {"a": table_contract("a", [("x", "bigint", True), ("y", "bigint", False)])}
    raw = spark.createDataFrame([("a", 1, '{"x":1,"y":2,"z":3}'), ("b", 1, '{"x":1}')], "table_name string, snapshot int, raw string")
    out = H.column_history(raw, [("2024-03-01 00:00:00", new), ("2024-01-01 00:00:00", old)]).collect()
    assert {(r.table_name, r.column_name): r.included_at and str(r.included_at) for r in out} == {
        ("a", "x"): "2024-01-01 00:00:00", ("a", "y"): "2024-03-01 00:00:00", ("a", "z"): None, ("b", "x"): None}
