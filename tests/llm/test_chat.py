"""Snapshot collapse against comparison of whole turn lists."""

import hashlib
import random

from tidemark.llm import chat as C


def by_hand(rows):
    none = lambda v: (v is not None, v if v is not None else "")
    mark = lambda v: f"1{v}" if v is not None else "0"
    content = lambda r, x: hashlib.md5(f"{mark(r)}\x1f{mark(x)}".encode()).hexdigest()
    convs = {}
    for c, t, r, x in {*rows}:
        convs.setdefault(c, []).append(((t is not None, t or 0), content(r, x), none(r), none(x)))
    seqs = {c: tuple((r, x) for _, _, r, x in sorted(v)) for c, v in convs.items()}
    inner = {s[:k] for s in seqs.values() for k in range(1, len(s))}
    out = {}
    for c, s in seqs.items():
        if s not in inner:
            out.setdefault(s, []).append(c)
    text = lambda s: "".join(f"<|im_start|>{r[1]}\n{x[1]}<|im_end|>\n" for r, x in s)
    first = lambda ids: min((i for i in ids if i is not None), default=None)
    return sorted(((first(ids), len(s), len(ids), text(s)) for s, ids in out.items()), key=repr)


def run(spark, rows):
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumn("pos", C.F.lit(0))
    return sorted((tuple(r) for r in C.render_chat(df).collect()), key=repr)


def test_random_snapshots(spark):
    rng = random.Random(11)
    rows = []
    for c in range(160):
        gap, start = rng.choice([1, 1, 2]), rng.choice([0, 0, 5])
        for k in range(rng.randint(1, 6)):
            role, text = "user" if k % 2 == 0 else "assistant", f"{rng.choice('ab')}{k}"
            rows.append((c, start + gap * k, role, text))
    rows += rows[:40]
    rows += [(500, 0, None, None), (501, 0, None, ""), (502, 0, "", None), (503, None, "user", "x"), (503, 0, "user", "y"),
             (None, 0, "user", "lost"), (None, 1, "user", "rows"), (504, 0, "user", "lost"), (505, 0, "u", "é" * 50000),
             (505, 0, "u", "b"), (506, -3, "u", "b"), (506, 7, "u", "é" * 50000), (507, 1, "u", "b")]
    assert run(spark, rows) == by_hand(rows)


def test_long_conversation_spans_blocks(spark):
    rows = [(1, t, "user", f"t{t}") for t in range(1500)] + [(2, t, "user", f"t{t}") for t in range(1100)]
    rows += [(3, t, "user", f"t{t}") for t in range(1099)] + [(3, 1099, "user", "other")]
    got = run(spark, rows)
    assert got == by_hand(rows) and sorted(r[0] for r in got) == [1, 3]


def test_empty(spark):
    assert run(spark, []) == []
