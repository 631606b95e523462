"""Nested schemas against a plain walk of the parsed texts."""

import json
import random
from collections import Counter

from tidemark.operators import nested as N


def kind(v):
    if v is None:
        return "NULL"
    if isinstance(v, bool):
        return "BOOLEAN"
    return {dict: "OBJECT", list: "ARRAY", int: "INTEGER", float: "NUMBER", str: "STRING"}[type(v)]


def walk(v, path="$"):
    yield path, kind(v)
    if isinstance(v, dict):
        for k, x in v.items():
            plain = k.isascii() and k.replace("_", "a").isalnum()
            yield from walk(x, f"{path}.{k}" if plain else path + '."' + k.replace('"', '\\"') + '"')
    if isinstance(v, list):
        for x in v:
            yield from walk(x, path + "[]")


def made(rng, depth=0):
    pick = rng.randint(0, 8 if depth < 4 else 5)
    if pick < 6:
        return (None, True, 7, 2.5, "x", 12345678901234)[pick]
    if pick == 6:
        return [made(rng, depth + 1) for _ in range(rng.randint(0, 3))]
    return {k: made(rng, depth + 1) for k in rng.sample(["a", "b_1", "c d", "e.f", 'q"', "é", ""], rng.randint(0, 4))}


def least(kinds):
    kinds = kinds - {"NULL"}
    if len(kinds) < 2:
        return next(iter(kinds), "NULL")
    if kinds & {"OBJECT", "ARRAY", "INVALID"}:
        return "MIXED"
    return "NUMBER" if kinds == {"INTEGER", "NUMBER"} else "STRING"


def test_counts_types_and_changes(spark):
    rng = random.Random(6)
    rows = [(rng.choice("ttu"), json.dumps(made(rng), ensure_ascii=False)) for _ in range(150)]
    rows += [("t", None), ("t", ""), ("u", "{"), ("u", '{"a":1,"a":2}'), ("w", "{}"), (None, "[]")]
    want = Counter()
    for table, text in rows:
        try:
            pairs = json.loads(text, object_pairs_hook=lambda p: dict(p) if len(dict(p)) == len(p) else 1 / 0)
            want.update((table, *x) for x in walk(pairs))
        except (TypeError, ValueError, ZeroDivisionError):
            want[table, "$", "INVALID"] += 1
    df = spark.createDataFrame(rows, "table_name string, raw string")
    counts = N.path_counts(df)
    assert {(r.table_name, r.path, r.kind): r.records for r in counts.collect()} == dict(want)
    types = {(r.table_name, r.path): r.type for r in N.path_types(counts).collect()}
    assert types == {p: least({k for t, q, k in want if (t, q) == p}) for p in {(t, q) for t, q, _ in want}}
    halves = N.merge_counts(N.path_counts(df.where("hash(raw) % 2 = 0")), N.path_counts(df.where("NOT (hash(raw) % 2 <=> 0)")))
    assert sorted(map(tuple, halves.collect()), key=str) == sorted(map(tuple, counts.select(halves.columns).collect()), key=str)
    assert N.path_counts(df.limit(0)).count() == 0


def test_each_change(spark):
    old = ['{"a":1,"b":1,"c":"x","d":null,"e":1}']
    new = ['{"a":1,"b":1.5,"c":{"x":1},"d":[],"f":2}']
    state = lambda texts: N.path_counts(spark.createDataFrame([("t", x) for x in texts], "table_name string, raw string"))
    got = {r.path: (r.type_before, r.type_after, r.change) for r in N.schema_changes(state(old), state(new)).collect()}
    assert got == {
        "$": ("OBJECT", "OBJECT", "SAME"), "$.a": ("INTEGER", "INTEGER", "SAME"), "$.b": ("INTEGER", "NUMBER", "WIDENED"),
        "$.c": ("STRING", "MIXED", "BREAKING_CHANGE"), "$.c.x": (None, "INTEGER", "NEW_COLUMN"),
        "$.d": ("NULL", "ARRAY", "WIDENED"), "$.e": ("INTEGER", "INTEGER", "GONE"), "$.f": (None, "INTEGER", "NEW_COLUMN")}
    none = lambda texts: N.path_counts(spark.createDataFrame([(None, x) for x in texts], "table_name string, raw string"))
    assert {r.path: (r.type_before, r.type_after, r.change) for r in N.schema_changes(none(old), none(new)).collect()} == got
