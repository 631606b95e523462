"""Exact top-k inner products by best-first search of an M-tree.

Largest inner product becomes smallest distance: with ``m`` the longest
vector's squared length, ``x`` gets one more component
``sqrt(m - |x|^2)`` and a query gets 0, so ``d(q, x)^2 = |q|^2 + m - 2 <q, x>``
is a Euclidean metric that falls as the product grows.

The index is a forest of M-trees.  At most ``PIVOTS`` routing objects (a
bounded sample by hash of the id, so a bounded broadcast) deal the vectors
out; a routing object with more than ``TREE`` vectors gets several trees by
hash of the id, so no tree grows with the data and none is a hot group.
Inside a tree, pages of at most ``PAGE`` entries hold routing objects with
covering radius and distance to the parent, or vectors with distance to their
routing object.  Pages are rows of a table in the shared folder.

Search: every query first visits the tree of its nearest routing object; the
k-th score there bounds the rest.  Trees whose covering ball lies beyond the
bound are left out.  Queries and trees meet in cells: a cell has the pages of a
run of trees and those queries, packed in rows of many, that reach one of them,
each side of at most about ``CELL`` bytes.  The two sides are dealt out by the
number of the cell and never joined, so no row holds a query and a tree, and
nothing is broadcast but the routing objects, however wrong Spark's estimate of
a size may be.  In a tree a heap yields pages by lower bound, for a block of
queries at a time; a query takes part in a page only within its own bound, and
the stored parent distances rule out entries by the triangle inequality before
any distance is computed.  Floating-point bounds carry a margin, scores are
exact integers (in single precision only where no sum can pass 2^24), so nothing
is lost.

Defined results: vectors that are null, or hold a null or a number that is not
finite, or are not of the commonest length, take no part, as query or
candidate; nor do rows without id.  Rows that repeat are rows of their own;
a query leaves out all rows of its own id.  Ties go to the smaller id.
Components are integers below 2^24.  Empty tables give no rows.  Extra
columns are not read.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.arrow import _TRIM, with_code
from tidemark.session import scratch_path

PIVOTS = 1024
TREE = 4096
PAGE = 256
#: Queries that are searched together.
BLOCK = 4096
#: Rows that are compared to all routing objects at a time.
STEP = 512
#: Bytes of vectors, and of queries, that one task holds at a time.
CELL = 16 << 20
#: Runs of trees in small tables, so that there are enough tasks; and the most tasks.
RUNS = 64
TASKS = 2000
MARGIN = 1e-6


def quantised(col: str, scale: float = 256.0) -> Column:
    """floor(scale * x) of every component, null for vectors that take no part."""
    x = F.transform(col, lambda v: v.cast("double"))
    fine = F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < F.lit(float("inf"))))
    return F.when(F.col(col).isNotNull() & fine, F.transform(x, lambda v: F.floor(v * F.lit(scale)).cast("long")))


def lifted(vectors: np.ndarray, longest: float) -> np.ndarray:
    """The vectors with the component that makes all as long as the longest."""
    v = vectors.astype(np.float64)
    rest = np.sqrt(np.maximum(longest - (v * v).sum(1), 0.0))
    return np.hstack([v, rest[:, None]])


def _gap(points: np.ndarray, to: np.ndarray) -> np.ndarray:
    return np.sqrt(((points - to) ** 2).sum(1))


def bulk_load(ids: np.ndarray, vectors: np.ndarray, root: np.ndarray, longest: float, page: int = PAGE) -> list[dict]:
    """The pages of one tree under the routing object ``root`` (lifted)."""
    points, pages = lifted(vectors, longest), []

    def add(rows: np.ndarray, routing: np.ndarray, parent: int, to_parent: float) -> None:
        gaps = _gap(points[rows], routing)
        leaf = len(rows) <= page
        pages.append({"page": len(pages), "parent": parent, "leaf": leaf, "routing": routing.tobytes(),
                      "radius": float(gaps.max(initial=0.0)), "to_parent": to_parent,
                      "ids": ids[rows].astype("<i8").tobytes() if leaf else b"",
                      "vectors": packed(vectors[rows]) if leaf else b"",
                      "gaps": gaps.tobytes() if leaf else b""})
        if leaf:
            return
        mine, wanted = len(pages) - 1, min(page, -(-len(rows) // (page // 2)))
        # Routing objects far apart: each is the row farthest from those before it.
        chosen = [int(gaps.argmax())]
        near = _gap(points[rows], points[rows[chosen[0]]])
        owner = np.zeros(len(rows), np.int64)
        while len(chosen) < wanted and near.max() > 0:
            chosen.append(int(near.argmax()))
            new = _gap(points[rows], points[rows[chosen[-1]]])
            owner[new < near] = len(chosen) - 1
            near = np.minimum(near, new)
        if len(chosen) == 1 or np.bincount(owner).max() > 0.9 * len(rows):
            owner, chosen = np.arange(len(rows)) % wanted, [chosen[0]] * wanted
        for k, c in enumerate(chosen):
            own = rows[owner == k]
            if len(own):
                to = points[rows[c]]
                add(own, to, mine, float(_gap(to[None], routing)[0]))

    add(np.arange(len(ids)), root, -1, 0.0)
    return pages


class Best:
    """The k best (id, score) so far of each of some queries, best first, of at
    least the query's floor, which rises as better ones are found."""

    def __init__(self, own: np.ndarray, floors: np.ndarray, k: int):
        self.own, self.floors = own, floors.astype(np.float64)
        self.ids, self.scores = np.full((len(own), k), np.iinfo(np.int64).max), np.full((len(own), k), -np.inf)
        self.waiting: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        self.held = 0

    def add(self, who: np.ndarray, ids: np.ndarray, scores: np.ndarray) -> None:
        """Candidates: numbers of queries, ids and scores, one of each."""
        scores = scores.astype(np.float64)
        floor, last = self.floors[who], self.ids[who, -1]
        good = (ids != self.own[who]) & ((scores > floor) | (scores == floor) & (ids <= last))
        self.waiting.append((who[good], ids[good], scores[good]))
        self.held += len(self.waiting[-1][0])

    def settle(self) -> None:
        if not self.held:
            return
        who, ids, scores = (np.concatenate(x) for x in zip(*self.waiting))
        self.waiting, self.held = [], 0
        asked, k = np.unique(who), self.ids.shape[1]
        old = np.isfinite(self.scores[asked]).ravel()
        who = np.append(who, np.repeat(asked, k)[old])
        ids, scores = np.append(ids, self.ids[asked].ravel()[old]), np.append(scores, self.scores[asked].ravel()[old])
        order = np.lexsort((ids, -scores, who))
        who, ids, scores = who[order], ids[order], scores[order]
        rank = np.arange(len(who)) - np.searchsorted(who, who)
        top = rank < k
        self.ids[asked], self.scores[asked] = np.iinfo(np.int64).max, -np.inf
        self.ids[who[top], rank[top]], self.scores[who[top], rank[top]] = ids[top], scores[top]
        self.floors[asked] = np.maximum(self.floors[asked], self.scores[asked, -1])

    def rows(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Numbers of queries, ids and scores."""
        self.settle()
        who, rank = np.nonzero(np.isfinite(self.scores))
        return who, self.ids[who, rank], self.scores[who, rank]


def packed(vectors: np.ndarray) -> bytes:
    """Whole vectors in 2 bytes a component, or 4."""
    return vectors.astype("<i2" if np.abs(vectors).max(initial=0) < 2 ** 15 else "<i4").tobytes()


def unpacked(data: bytes, dim: int, n: int) -> np.ndarray:
    return np.frombuffer(data, "<i2" if len(data) == 2 * dim * n else "<i4").reshape(n, dim)


def exact(lengths: np.ndarray, longest: float) -> type:
    """A type that holds every partial sum of an inner product exactly: none is
    over the product of the two lengths."""
    return np.float32 if lengths.max(initial=0.0) * longest < 2.0 ** 48 else np.float64


def reach(lengths: np.ndarray, longest: float, floors: np.ndarray) -> np.ndarray:
    """The distance beyond which no product is at least the floor; lengths: of the queries, squared."""
    with np.errstate(invalid="ignore"):
        return np.sqrt(np.maximum(lengths + longest - 2 * floors, 0.0)) * (1 + MARGIN) + MARGIN


class Tree:
    """Pages of one tree, ready to search."""

    def __init__(self, pages: list[dict]):
        self.pages = sorted(pages, key=lambda p: p["page"])
        # Routing objects are vectors: without the lifted component products with queries are whole numbers.
        self.routing = np.stack([np.frombuffer(p["routing"])[:-1] for p in self.pages])
        self.radius = np.array([p["radius"] for p in self.pages])
        self.to_parent = np.array([p["to_parent"] for p in self.pages])
        parent = np.array([p["parent"] for p in self.pages])
        self.children = {i: np.flatnonzero(parent == i) for i, p in enumerate(self.pages) if not p["leaf"]}
        dim = self.routing.shape[1]
        self.entries = {i: (np.frombuffer(p["ids"], "<i8"), unpacked(p["vectors"], dim, len(p["ids"]) // 8),
                            np.frombuffer(p["gaps"])) for i, p in enumerate(self.pages) if p["leaf"]}
        self.computed = 0

    def search(self, own_id: int, q: np.ndarray, k: int, longest: float, floor: float) -> tuple[np.ndarray, np.ndarray]:
        """The k best (ids, scores) of at least ``floor``, best first."""
        best = Best(np.array([own_id]), np.array([floor]), k)
        self.search_block(best, np.zeros(1, np.int64), q[None], longest)
        return best.rows()[1:]

    def search_block(self, best: Best, asked: np.ndarray, q: np.ndarray, longest: float) -> None:
        """Adds to ``best`` what the queries numbered ``asked`` find, whose vectors are ``q``."""
        lengths = (q.astype(np.float64) ** 2).sum(1)
        kind = exact(lengths, longest)
        q = q.astype(kind)

        def products(who: np.ndarray, vectors: np.ndarray) -> np.ndarray:
            self.computed += len(who) * len(vectors)
            return (q if len(who) == len(q) else q[who]) @ vectors.astype(kind).T

        def gaps_to(who: np.ndarray, pages: np.ndarray) -> np.ndarray:
            """Distances between lifted vectors."""
            return np.sqrt(np.maximum((lengths[who] + longest)[:, None] - 2.0 * products(who, self.routing[pages]), 0.0))

        bound = lambda who: reach(lengths[who], longest, best.floors[asked[who]])
        everyone = np.arange(len(q))
        heap = [(0.0, 0, everyone, gaps_to(everyone, np.zeros(1, np.int64))[:, 0])]
        while heap:
            _, i, who, gap = heapq.heappop(heap)
            bounds = bound(who)
            near = np.maximum(0.0, gap - self.radius[i]) <= bounds
            if not near.any():
                continue
            if not near.all():
                who, gap, bounds = who[near], gap[near], bounds[near]
            if i in self.children:
                kids = self.children[i]
                near = np.abs(gap[:, None] - self.to_parent[kids]) - self.radius[kids] <= bounds[:, None]
                kids, near = kids[near.any(0)], near[:, near.any(0)]
                gaps = gaps_to(who, kids)
                low = np.maximum(0.0, gaps - self.radius[kids])
                near &= low <= bounds[:, None]
                for k, c in enumerate(kids.tolist()):
                    if (own := near[:, k]).any():
                        heapq.heappush(heap, (float(low[own, k].min()), c, who[own], gaps[own, k]))
                continue
            ids, vectors, gaps = self.entries[i]
            near = (gaps >= (gap - bounds).min()) & (gaps <= (gap + bounds).max())
            if not near.all():
                ids, vectors = ids[near], vectors[near]
            for s in range(0, len(who), 1024):
                part = who if len(who) <= 1024 else who[s:s + 1024]
                scores = products(part, vectors)
                # In one dimension this takes a fraction of the time.
                good = np.flatnonzero(scores >= best.floors[asked[part]].astype(kind)[:, None])
                if len(good):
                    row, col = np.divmod(good, len(ids))
                    best.add(asked[part[row]], ids[col], scores[row, col])
                    if best.held >= 2 * len(q):
                        best.settle()
        best.settle()


PAGES = ("pivot int, salt int, page int, parent int, leaf boolean, routing binary, radius double, to_parent double, "
         "ids binary, vectors binary, gaps binary, run int")
#: Queries in rows of many; pivot: the one tree to search (its salt is 0), or -1 for all of the cell.
BLOCKS = "cell int, n int, ids binary, keys binary, pivots binary, floors binary, q binary"
FOUND = "query_id long, query_key long, vec_id long, score long"


class Index:
    """Page table, routing objects and radii of one set of vectors.  Trees are
    numbered by routing object and salt and fall into ``runs`` runs of about
    equal numbers of vectors."""

    def __init__(self, longest: float, routing: np.ndarray, counts: np.ndarray, tree: int, cell: int):
        self.longest, self.pivots = longest, routing
        self.dim = routing.shape[1] - 1
        self.salts = np.maximum(-(-counts // tree), 1)
        self.each = -(-counts // self.salts)
        self.start = np.cumsum(counts) - counts
        #: Vectors in a run.
        self.span = max(tree, min(cell // (self.dim * (2 if longest < 2 ** 30 else 4) + 16), int(counts.sum()) // RUNS))
        self.first, self.last = self.run(np.arange(len(routing)), 0), self.run(np.arange(len(routing)), self.salts - 1)
        self.runs = int(self.last.max()) + 1
        self.radii = np.full(len(routing), -np.inf)

    def run(self, pivot, salt):
        """The run that a tree is in."""
        return (self.start[pivot] + salt * self.each[pivot]) // self.span


def build_index(vectors: DataFrame, pivots: int = PIVOTS, tree: int = TREE, page: int = PAGE,
                cell: int = CELL) -> tuple[Index, DataFrame] | None:
    """Index of ``vectors`` (id long, v array<long>) and its pages; None if there are none."""
    spark = vectors.sparkSession
    with_code(spark)
    norm = F.aggregate("v", F.lit(0).cast("long"), lambda a, x: a + x * x)
    size = vectors.agg(F.count(F.lit(1)).alias("n"), F.max(norm).alias("m")).first()
    if not size.n:
        return None
    longest = float(size.m)
    wanted = max(1, min(pivots, size.n // tree))
    # Every task sends its first ids; vectors come only from those that were chosen.
    named = vectors.withColumn("h", F.xxhash64("id"))
    h, i = max((r.h, r.id) for r in named.select("h", "id").orderBy("h", "id").limit(wanted).collect())
    chosen = named.where((F.col("h") < F.lit(h)) | (F.col("h") == F.lit(h)) & (F.col("id") <= F.lit(i)))
    sample = sorted((r.id, r.v) for r in chosen.groupBy("id").agg(F.min("v").alias("v")).collect())  # wanted at most
    routing = lifted(np.array([v for _, v in sample]).reshape(len(sample), -1), longest)
    shared = spark.sparkContext.broadcast(routing)

    def nearest(f: pd.DataFrame) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Vectors and the number of each one's routing object, some rows at a time."""
        routing = shared.value
        for s in range(0, len(f), STEP):
            vectors = np.stack(f["v"].iloc[s:s + STEP].to_numpy())
            yield vectors, ((routing ** 2).sum(1) - 2 * lifted(vectors, longest) @ routing.T).argmin(1)

    def count(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        counts = np.zeros(len(shared.value), np.int64)
        for f in frames:
            for _, pivot in nearest(f):
                counts += np.bincount(pivot, minlength=len(counts))
        yield pd.DataFrame({"pivot": np.flatnonzero(counts), "n": counts[counts > 0]})

    counts = np.zeros(len(routing), np.int64)
    for r in vectors.select("v").mapInPandas(count, "pivot int, n long").groupBy("pivot").agg(F.sum("n").alias("n")).collect():
        counts[r.pivot] = r.n  # PIVOTS at most
    index = Index(longest, routing, counts, tree, cell)
    dealt_by = spark.sparkContext.broadcast(index)

    def assign(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        index = dealt_by.value
        for f in frames:
            for k, (vectors, pivot) in enumerate(nearest(f)):
                part, data = f.iloc[k * STEP:(k + 1) * STEP], packed(vectors)
                size = len(data) // len(vectors)
                yield pd.DataFrame({"id": part["id"].to_numpy(),
                                    "v": [data[i:i + size] for i in range(0, len(data), size)],
                                    "pivot": pivot.astype(np.int32),
                                    "salt": np.mod(part["h"].to_numpy(), index.salts[pivot]).astype(np.int32)})

    def load(f: pd.DataFrame) -> pd.DataFrame:
        index = dealt_by.value
        pivot, salt = int(f["pivot"].iloc[0]), int(f["salt"].iloc[0])
        vectors = np.stack([unpacked(v, index.dim, 1)[0].astype(np.int32) for v in f["v"]])
        rows = bulk_load(f["id"].to_numpy(), vectors, index.pivots[pivot], index.longest, page)
        rows = pd.DataFrame(rows).assign(pivot=pivot, salt=salt, run=int(index.run(pivot, salt)))
        return rows[[c.split()[0] for c in PAGES.split(", ")]]

    path = scratch_path(spark, "mtree-pages")
    dealt = vectors.withColumn("h", F.xxhash64("id", "v")).mapInPandas(assign, "id long, v binary, pivot int, salt int")
    dealt.groupBy("pivot", "salt").applyInPandas(load, PAGES).write.parquet(path)
    pages = spark.read.parquet(path)
    for r in pages.where("parent < 0").groupBy("pivot").agg(F.max("radius").alias("r")).collect():
        index.radii[r.pivot] = r.r
    return index, pages


def _block(cell: int, ids: np.ndarray, keys: np.ndarray, pivots: np.ndarray, floors: np.ndarray, q: np.ndarray) -> tuple:
    return (cell, len(ids), ids.astype("<i8").tobytes(), keys.astype("<i8").tobytes(), pivots.astype("<i4").tobytes(),
            floors.astype("<f8").tobytes(), packed(q))


def _unblocked(f: pd.DataFrame, dim: int) -> tuple[np.ndarray, ...]:
    """Ids, keys, pivots, floors and vectors of the queries of some rows."""
    some = lambda c, kind: np.frombuffer(b"".join(f[c]), kind)
    q = [unpacked(data, dim, n) for data, n in zip(f["q"], f["n"])]
    return some("ids", "<i8"), some("keys", "<i8"), some("pivots", "<i4"), some("floors", "<f8"), np.concatenate(q)


def _give_back() -> None:
    """What a worker keeps counts against its executor for as long as it lives."""
    pa.default_memory_pool().release_unused()
    if _TRIM:
        _TRIM(0)


def _part(ids: np.ndarray, keys: np.ndarray, parts: int) -> np.ndarray:
    """One of so many parts for each query."""
    mixed = ids.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) ^ keys.astype(np.uint64)
    return ((mixed >> np.uint64(20)) % np.uint64(parts)).astype(np.int64)


def _visit(index, dim: int, parts: int, tasks: int, pages: DataFrame, asked: DataFrame, k: int, rows: bool) -> DataFrame:
    """Searches the queries of ``asked`` (BLOCKS) in the trees of their cells:
    rows of FOUND, or else BLOCKS again with the floors that were found.
    index: a broadcast Index."""

    def run(pages: pd.DataFrame, blocks: pd.DataFrame) -> pd.DataFrame:
        _give_back()
        if not len(blocks) or rows and not len(pages):
            return pd.DataFrame([], columns=[c.split()[0] for c in (FOUND if rows else BLOCKS).split(", ")])
        ids, keys, pivots, floors, q = _unblocked(blocks, dim)
        best, longest = Best(ids, floors, k), index.value.longest
        for (pivot, _), own in pages.groupby(["pivot", "salt"]):
            tree, asked = Tree(own.to_dict("records")), np.flatnonzero((pivots < 0) | (pivots == pivot))
            for s in range(0, len(asked), BLOCK):
                tree.search_block(best, asked[s:s + BLOCK], q[asked[s:s + BLOCK]], longest)
        if rows:
            who, found, scores = best.rows()
            return pd.DataFrame({"query_id": ids[who], "query_key": keys[who], "vec_id": found, "score": scores.astype(np.int64)})
        out = [slice(s, s + BLOCK) for s in range(0, len(ids), BLOCK)]
        return pd.DataFrame([_block(0, ids[x], keys[x], pivots[x], best.floors[x], q[x]) for x in out],
                            columns=[c.split()[0] for c in BLOCKS.split(", ")])

    pages = (pages.withColumn("cell", F.explode(F.sequence(F.lit(0), F.lit(parts - 1))))
                  .withColumn("cell", F.col("run") * F.lit(parts) + F.col("cell")))
    return (pages.repartition(tasks, "cell").groupBy("cell").cogroup(asked.repartition(tasks, "cell").groupBy("cell"))
                 .applyInPandas(run, FOUND if rows else BLOCKS))


def top_k(queries: DataFrame, vectors: DataFrame, k: int = 5, pivots: int = PIVOTS, tree: int = TREE,
          page: int = PAGE, cell: int = CELL) -> DataFrame:
    """The k largest inner products of each query among ``vectors``, both of
    (id long, v array<long>): query_id, rank, vec_id, score."""
    spark = vectors.sparkSession
    built = build_index(vectors, pivots, tree, page, cell)
    if built is None:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    index, pages = built
    asked = queries.select(F.col("id").alias("query_id"), F.xxhash64("v").alias("query_key"), F.col("v").alias("q"))
    asked = asked.dropDuplicates(["query_id", "query_key"])
    shared = spark.sparkContext.broadcast(index)
    dim = index.dim
    parts = max(1, -(-queries.count() // max(1, cell // (2 * dim + 28))))
    tasks = min(index.runs * parts, TASKS)
    names = [c.split()[0] for c in BLOCKS.split(", ")]

    def home(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        """Each query to the tree of its nearest routing object."""
        index = shared.value
        there = np.flatnonzero(np.isfinite(index.radii))
        for f in frames:
            if not len(f):
                continue
            ids, keys, q = f["query_id"].to_numpy(), f["query_key"].to_numpy(), np.stack(f["q"].to_numpy())
            pivots = there[((index.pivots[there] ** 2).sum(1) - 2.0 * q @ index.pivots[there, :-1].T).argmin(1)]
            cells, floors = index.first[pivots] * parts + _part(ids, keys, parts), np.full(len(f), -np.inf)
            yield pd.DataFrame([_block(c, *(x[cells == c] for x in (ids, keys, pivots, floors, q))) for c in np.unique(cells).tolist()],
                               columns=names)

    path = scratch_path(spark, "mtree-bounds")
    first = asked.mapInPandas(home, BLOCKS)
    _visit(shared, dim, parts, tasks, pages.where("salt = 0"), first, k, False).write.parquet(path)

    def within(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        """The cells with trees whose covering ball the query's bound reaches."""
        index = shared.value
        span = [np.flatnonzero((index.first <= r) & (index.last >= r)) for r in range(index.runs)]
        for f in frames:
            for b in range(len(f)):
                ids, keys, _, floors, q = _unblocked(f.iloc[b:b + 1], dim)
                wide, part = q.astype(np.float64), _part(ids, keys, parts)
                lengths = (wide ** 2).sum(1)
                bounds, near = reach(lengths, index.longest, floors), np.empty((len(ids), len(index.radii)), bool)
                for s in range(0, len(ids), STEP):
                    x = slice(s, s + STEP)
                    gaps = (lengths[x] + index.longest)[:, None] - 2 * wide[x] @ index.pivots[:, :-1].T
                    near[x] = np.sqrt(np.maximum(gaps, 0.0)) - index.radii <= bounds[x, None]
                out, held = [], 0
                for r, own in enumerate(span):
                    reached = near[:, own].any(1)
                    for p in np.unique(part[reached]).tolist():
                        x = np.flatnonzero(reached & (part == p))
                        out.append(_block(r * parts + p, ids[x], keys[x], np.full(len(x), -1), floors[x], q[x]))
                        held += len(x)
                    if held > 4 * BLOCK:
                        yield pd.DataFrame(out, columns=names)
                        out, held = [], 0
                if out:
                    yield pd.DataFrame(out, columns=names)

    second = spark.read.parquet(path).mapInPandas(within, BLOCKS)
    order = Window.partitionBy("query_id", "query_key").orderBy(F.desc("score"), "vec_id")
    return (_visit(shared, dim, parts, tasks, pages, second, k, True).withColumn("rank", F.row_number().over(order))
            .where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score"))


def usable_vectors(df: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """(id, v): the rows that take part, quantised; written once, as they are read several times."""
    rows = df.select(F.col(id_col).cast("long").alias("id"), quantised(vector_col).alias("v"))
    path = scratch_path(df.sparkSession, "mtree-vectors")
    rows.where("id IS NOT NULL AND v IS NOT NULL AND size(v) > 0").write.parquet(path)
    rows = df.sparkSession.read.parquet(path)
    common = rows.groupBy(F.size("v").alias("n")).count().orderBy(F.desc("count"), "n").first()
    return rows.where(F.size("v") == (common.n if common else 0))


def op3_mtree(spark, sf_dir: str) -> DataFrame:
    """Top 5 of every vector whose id is divisible by 50 among all others."""
    rows = usable_vectors(spark.read.parquet(f"{sf_dir}/embeddings.parquet"), "vec_id", "embedding")
    return top_k(rows.where("id % 50 = 0"), rows, 5)


OP3_SQL = r"""
WITH e AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
  FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT a.vec_id AS query_id, b.vec_id, CAST(list_dot_product(CAST(a.v AS DOUBLE[]), CAST(b.v AS DOUBLE[])) AS BIGINT) AS score
  FROM e a JOIN e b ON a.vec_id <> b.vec_id WHERE a.vec_id % 50 = 0)
SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score
FROM s QUALIFY row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) <= 5
"""
