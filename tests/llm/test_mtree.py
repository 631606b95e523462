"""M-tree search against all inner products."""

import math

import numpy as np

from tidemark.llm import mtree as M


def by_hand(rows, k=5, step=50):
    fine = [(i, v) for i, v in rows if i is not None and v and all(x is not None and math.isfinite(x) for x in v)]
    sizes = [len(v) for _, v in fine]
    dim = min((n for n in set(sizes)), key=lambda n: (-sizes.count(n), n), default=0)
    fine = [(i, [math.floor(256 * x) for x in v]) for i, v in fine if len(v) == dim]
    out = set()
    for i, q in {(i, tuple(v)) for i, v in fine if i % step == 0}:
        scored = sorted((-sum(a * b for a, b in zip(q, v)), j) for j, v in fine if j != i)[:k]
        out |= {(i, r + 1, j, -s) for r, (s, j) in enumerate(scored)}
    return sorted(out)


def run(spark, rows, **kw):
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").withColumn("v", M.F.lit("clash"))
    use = M.usable_vectors(df, "vec_id", "embedding")
    return sorted(tuple(r) for r in M.top_k(use.where("id % 50 = 0"), use, 5, **kw).collect())


def test_odd_rows(spark):
    rng = np.random.default_rng(2)
    rows = [(i, [float(x) for x in rng.normal(size=4)]) for i in range(260)]
    rows += [(i, [0.5, 0.5, -0.25, 0.125]) for i in range(300, 420)]  # ties and a hot group
    rows += [(7, rows[7][1]), (50, rows[50][1]), (500, None), (501, [None, 1.0, 1.0, 1.0]), (502, [float("nan")] * 4),
             (503, [float("inf")] * 4), (550, [1.0]), (None, [1.0] * 4), (600, []), (650, [0.0] * 4)]
    want = by_hand(rows)
    assert run(spark, rows) == want
    assert run(spark, rows, pivots=5, tree=40, page=8) == want


def test_few_rows_and_none(spark):
    rows = [(0, [1.0, 2.0]), (1, [1.0, -2.0]), (2, [3.0, 0.5])]
    assert run(spark, rows) == by_hand(rows)
    assert run(spark, rows[:1]) == [] and run(spark, []) == []


def test_bounds_save_work_and_lose_nothing():
    rng = np.random.default_rng(7)
    centres = rng.normal(size=(20, 8)) * 400
    vectors = np.floor(centres[rng.integers(0, 20, 3000)] + rng.normal(size=(3000, 8)) * 10).astype(np.int64)
    longest = float((vectors ** 2).sum(1).max())
    tree = M.Tree(M.bulk_load(np.arange(3000), vectors, M.lifted(vectors[:1], longest)[0], longest, 32))
    for i in range(0, 3000, 300):
        ids, scores = tree.search(i, vectors[i].astype(float), 5, longest, -np.inf)
        all_scores = vectors @ vectors[i]
        want = [j for j in np.lexsort((np.arange(3000), -all_scores)) if j != i][:5]
        assert ids.tolist() == want and scores.tolist() == all_scores[want].tolist()
    assert tree.computed < 10 * 3000 / 2


def test_identical_vectors_make_bounded_pages():
    v = np.ones((5000, 3), np.int64)
    pages = M.bulk_load(np.arange(5000), v, M.lifted(v[:1], 3.0)[0], 3.0, 64)
    assert sum(len(p["ids"]) // 8 for p in pages) == 5000 and max(len(p["ids"]) // 8 for p in pages) <= 64
    ids, _ = M.Tree(pages).search(3, np.ones(3), 5, 3.0, -np.inf)
    assert ids.tolist() == [0, 1, 2, 4, 5]


def test_no_pair_of_query_and_tree_is_broadcast(spark):
    """Many queries and many trees in a small file: by the file's size the pairs look small enough to broadcast."""
    rng = np.random.default_rng(3)
    rows = [(50 * i, [float(x) for x in rng.normal(size=4)]) for i in range(900)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    use = M.usable_vectors(df, "vec_id", "embedding")
    found = M.top_k(use, use, 5, pivots=30, tree=10, page=4)
    assert sorted(tuple(r) for r in found.collect()) == by_hand(rows)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "isFinalPlan=true" in plan and "Broadcast" not in plan and "Join" not in plan


def test_small_cells_part_queries_and_trees(spark):
    rng = np.random.default_rng(5)
    rows = [(10 * i, [float(x) for x in rng.normal(size=3)]) for i in range(200)]
    rows += [(10 * i, [0.5, -0.25, 1.0]) for i in range(200, 260)] + [(-50, [300.0, 1.0, 2.0]), (2 ** 62, [-200.0, 0.0, 1.0])]
    assert run(spark, rows, pivots=4, tree=16, page=4, cell=300) == by_hand(rows)


def test_a_block_of_queries_finds_what_each_finds():
    rng = np.random.default_rng(9)
    for scale in (20, 60_000):  # products within and beyond single precision
        vectors = (rng.normal(size=(700, 5)) * scale).astype(np.int64)
        vectors[100:250] = vectors[100]
        ids, longest = np.arange(700) // 2, float((vectors ** 2).sum(1).max())
        tree = M.Tree(M.bulk_load(ids, vectors, M.lifted(vectors[:1], longest)[0], longest, 16))
        asked, scores = np.arange(60, 160), vectors @ vectors[60:160].T
        floors = np.where(asked % 3 == 0, -np.inf, np.sort(scores, 0)[-9].astype(float))
        floors[asked % 7 == 0] = np.inf
        best = M.Best(ids[asked], floors, 5)
        tree.search_block(best, np.arange(50), vectors[60:110], longest)
        tree.search_block(best, np.arange(50, 100), vectors[110:160], longest)
        got = list(zip(*(x.tolist() for x in best.rows())))
        want = [(n, i, s) for n in range(100) for s, i in
                sorted((-s, i) for s, i in zip(scores[:, n].tolist(), ids.tolist()) if i != ids[asked[n]] and s >= floors[n])[:5]]
        assert got == [(n, i, -s) for n, i, s in want]


def test_home_tree_without_rows(spark):
    """Trees of a row each: often none of a routing object's rows has the salt 0."""
    rng = np.random.default_rng(11)
    rows = [(50 * i, [float(x) for x in rng.normal(size=3)]) for i in range(70)]
    assert run(spark, rows, pivots=8, tree=1, page=4) == by_hand(rows)
