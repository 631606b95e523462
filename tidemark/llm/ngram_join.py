"""N-gram Jaccard join by chosen paths.

Texts are sets of five-word shingles; documents with the same set are one
node.  A run sends every node down a tree of paths: at each step a bucket
samples ``CHOICES`` min-hash functions, and each node goes on along the token
that is smallest in its set under them, so two nodes share the next step with
the probability of their Jaccard similarity.  A first step has functions of
its run alone; below it every bucket draws, by a hash of its path, from all
``SIGNATURE`` functions that its path has not used.  Buckets of at most ``LIMIT``
nodes are compared by brute force on signatures; buckets that hardly shrink
(``DENSE``: their nodes are alike already) or reach ``DEPTH`` are taken as
alike whole; all others split on.  ``runs_for`` repeats runs until ``miss``, the
chance that a pair at the threshold meets in none, is below the target.

Links found this way make candidate components.  Each component's shingle
sets then meet once, in blocks of ``BLOCK`` nodes against ``BLOCK`` nodes, where every
pair is compared exactly; pairs are counted there and never emitted, only
each node's count and one edge to its cluster.  Hence the result has no false
links, and every link inside a component is found whether a path found it or not.

Defined results: a text of one to four words is one shingle of all; a text
without words (or null) has no links and is its own class; ``n_links`` counts
the other documents at ``similarity`` or more, copies included; ``class_id`` is the
smallest doc_id of the documents linked directly or through others (null
where all those ids are null); repeated rows are documents of their own; the
empty table gives no rows.  Extra columns are not read.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.arrow import slices, with_code
from tidemark.llm.components import connected_components, stored
from tidemark.llm.shingles import shingle_sets, signatures
from tidemark.operators.joins import checked_broadcast

SIMILARITY = (4, 5)  # 0.8 as a fraction, for exact comparison
RECALL = 0.999999
CHOICES = 2
SIGNATURE = 96
LIMIT = 1024
DENSE = 0.7
DEPTH = 9
BLOCK = 512
#: Signatures that agree on this share are worth an exact comparison: six
#: standard deviations below the threshold (``miss`` counts those beyond).
ALIKE = 0.55
BROADCAST_ROWS = 1_000_000


def miss(runs: int, similarity: float, depth: int = DEPTH, size: int = SIGNATURE) -> float:
    """Chance that a pair at ``similarity`` is in no common bucket ``depth``
    steps down in any run, or fails the signature test in one.

    The runs draw from the same ``size`` functions, so the chance is taken for each
    number of them on which the pair may agree, then averaged.  Given that
    number, a bucket draws two of the functions that its path has left: it loses
    the pair if both disagree, and has two paths to lose if both agree."""
    out = 0.0
    for agree in range(size + 1):
        lost = 0.0
        for used in reversed(range(depth)):
            left, same = size - used, max(0, agree - used)
            pairs, apart = left * (left - 1), left - same
            none, both = apart * (apart - 1) / pairs, same * (same - 1) / pairs
            lost = none + (1 - none - both) * lost + both * lost * lost
        chance = math.comb(size, agree) * similarity ** agree * (1 - similarity) ** (size - agree)
        out += chance * (lost ** runs if agree >= ALIKE * size else 1.0)
    return out


def runs_for(recall: float, similarity: float, depth: int = DEPTH, size: int = SIGNATURE) -> int:
    """The fewest runs whose ``miss`` is at most 1 - ``recall``."""
    for runs in range(1, size // CHOICES + 1):
        if miss(runs, similarity, depth, size) <= 1 - recall:
            return runs
    raise ValueError(f"recall {recall} at similarity {similarity} needs a longer signature than {size}")


def _of_texts(docs: DataFrame) -> DataFrame:
    """(doc_id, text_sha256, node, sig, row) of every document; node is a
    digest of the shingle set, null for an empty one."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for b in slices(whole, "text"):
                sets = shingle_sets(b.column("text"))
                node = [hashlib.blake2b(s.tobytes(), digest_size=16).digest() if len(s) else None for s in sets]
                sig = signatures(sets, SIGNATURE).view(np.int32)
                flat = pa.ListArray.from_arrays(pa.array(np.arange(len(sets) + 1, dtype=np.int32) * SIGNATURE),
                                                pa.array(sig.ravel()))
                yield pa.RecordBatch.from_arrays([b.column("doc_id"), b.column("text_sha256"), pa.array(node, pa.binary()),
                                                  flat], ["doc_id", "text_sha256", "node", "sig"])

    hashed = docs.withColumn("text_sha256", F.sha2(F.coalesce("text", F.lit("")), 256))
    return (hashed.mapInArrow(run, "doc_id long, text_sha256 string, node binary, sig array<int>")
                  .withColumn("row", F.monotonically_increasing_id()))


def _sized(steps: DataFrame) -> DataFrame:
    """(path, node, used, above) with the bucket's size n, buckets of one left out."""
    sizes = steps.groupBy("path").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    return steps.join(sizes, "path")


def chosen_paths(nodes: DataFrame, total: int, runs: int) -> tuple[DataFrame, DataFrame]:
    """Buckets that the paths end in, as (path, node): small ones and those
    taken as alike whole."""
    first = nodes.select("node", F.posexplode(F.slice("sig", 1, runs * CHOICES)).alias("place", "token"))
    steps = stored(_sized(first.select(F.xxhash64("place", "token").alias("path"), "node",
                                       F.array("place").alias("used"), F.lit(total).cast("long").alias("above"))), "paths")
    small, alike = [], []
    for level in range(1, DEPTH + 1):
        dense = (F.col("n") >= F.lit(DENSE) * F.col("above")) | F.lit(level == DEPTH)
        small.append(steps.where(F.col("n") <= LIMIT).select("path", "node"))
        alike.append(steps.where((F.col("n") > LIMIT) & dense).select("path", "node"))
        more = steps.where((F.col("n") > LIMIT) & ~dense)
        if more.isEmpty():
            break
        # A path of this length has used as many functions; two others are drawn.
        free = F.array_except(F.sequence(F.lit(0), F.lit(SIGNATURE - 1)), F.col("used"))
        left = SIGNATURE - level
        one = F.pmod(F.xxhash64("path", F.lit(0)), F.lit(left))
        two = F.pmod(one + 1 + F.pmod(F.xxhash64("path", F.lit(1)), F.lit(left - 1)), F.lit(left))
        drawn = F.transform(F.array(one, two), lambda i: F.element_at(free, i.cast("int") + 1))
        on = more.join(nodes.select("node", "sig"), "node").withColumn("place", F.explode(drawn))
        token = F.element_at("sig", F.col("place") + 1)
        steps = stored(_sized(on.select(F.xxhash64("path", "place", token).alias("path"), "node",
                                        F.concat("used", F.array("place")).alias("used"),
                                        F.col("n").alias("above"))), "paths")
    union = lambda frames: frames[0] if len(frames) == 1 else frames[0].unionByName(union(frames[1:]))
    return union(small), union(alike)


def _by_run(frames: Iterator[pd.DataFrame], keys: list[str]) -> Iterator[pd.DataFrame]:
    """The groups of a stream sorted by ``keys``, one frame each."""
    held: list[pd.DataFrame] = []
    for f in frames:
        if not len(f):
            continue
        new = (f[keys] != f[keys].shift()).any(axis=1).to_numpy()
        new[0] = bool(held) and tuple(held[0][keys].iloc[0]) != tuple(f[keys].iloc[0])
        cuts = [0, *np.flatnonzero(new), len(f)]
        for a, b in zip(cuts, cuts[1:]):
            if new[a] and held:
                yield pd.concat(held, ignore_index=True) if len(held) > 1 else held[0]
                held = []
            if b > a:
                held.append(f.iloc[a:b])
    if held:
        yield pd.concat(held, ignore_index=True) if len(held) > 1 else held[0]


def _roots(like: np.ndarray) -> np.ndarray:
    """The smallest member of each row's component in a symmetric matrix."""
    root = np.full(len(like), -1)
    for i in range(len(like)):
        if root[i] < 0:
            todo, root[i] = [i], i
            while todo:
                near = np.flatnonzero(like[todo.pop()] & (root < 0))
                root[near] = i
                todo += near.tolist()
    return root


def bucket_links(small: DataFrame, nodes: DataFrame) -> DataFrame:
    """Edges (a, b) that join what is alike by signature in each small bucket."""
    rows = small.join(nodes.select("node", "sig"), "node").repartition("path").sortWithinPartitions("path")

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        a, b = [], []
        for g in _by_run(frames, ["path"]):
            sig = np.stack(g["sig"].to_numpy())
            agree = np.zeros((len(sig), len(sig)), np.uint8)
            for column in sig.T:  # a column at a time, so that a task holds n x n bytes
                agree += column[:, None] == column[None]
            like = agree >= ALIKE * SIGNATURE
            root, node = _roots(like), g["node"].to_numpy()
            for i in np.flatnonzero(root != np.arange(len(root))):
                a.append(node[i])
                b.append(node[root[i]])
            if len(a) > 10_000:
                yield pd.DataFrame({"a": a, "b": b})
                a, b = [], []
        yield pd.DataFrame({"a": a, "b": b})

    return rows.mapInPandas(run, "a binary, b binary")


def common_counts(left: list[np.ndarray], right: list[np.ndarray]) -> np.ndarray:
    """Sizes of all intersections, from 0/1 columns of tokens that both sides
    hold, a few thousand columns at a time."""
    out = np.zeros((len(left), len(right)), np.float32)
    if not left or not right:
        return out
    lt, rt = np.concatenate(left), np.concatenate(right)
    shared = np.intersect1d(lt, rt)
    li, ri = np.repeat(np.arange(len(left)), [*map(len, left)]), np.repeat(np.arange(len(right)), [*map(len, right)])
    lp, rp = np.searchsorted(shared, lt), np.searchsorted(shared, rt)
    lk = lp < len(shared)
    lk[lk] = shared[lp[lk]] == lt[lk]
    rk = rp < len(shared)
    rk[rk] = shared[rp[rk]] == rt[rk]
    li, lp, ri, rp = li[lk], lp[lk], ri[rk], rp[rk]
    lo, ro = np.argsort(lp, kind="stable"), np.argsort(rp, kind="stable")
    li, lp, ri, rp = li[lo], lp[lo], ri[ro], rp[ro]
    for s in range(0, len(shared), 4096):
        e = min(s + 4096, len(shared))
        a, b = np.searchsorted(lp, (s, e))
        c, d = np.searchsorted(rp, (s, e))
        x, y = np.zeros((len(left), e - s), np.float32), np.zeros((len(right), e - s), np.float32)
        x[li[a:b], lp[a:b] - s] = 1
        y[ri[c:d], rp[c:d] - s] = 1
        out += x @ y.T
    return out


def _counted(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Exact links in each block pair: for every node the copies of its
    partners and the smallest row of its cluster."""
    up, down = SIMILARITY
    for g in _by_run(frames, ["comp", "one", "two"]):
        g = g.drop_duplicates("node")
        same = g["one"].iloc[0] == g["two"].iloc[0]
        parts = [g] if same else [g[g["block"] == g["one"].iloc[0]], g[g["block"] == g["two"].iloc[0]]]
        sets = [[np.frombuffer(x, np.uint64) for x in p["shingles"]] for p in parts]
        sets = sets * 2 if same else sets
        size = [np.array([len(x) for x in s], np.float64) for s in sets]
        common = common_counts(*sets).astype(np.float64)
        like = common * (up + down) >= up * (size[0][:, None] + size[1][None])
        copies = [p["copies"].to_numpy() for p in parts]
        if same:
            np.fill_diagonal(like, False)
            links, whole, node = like @ copies[0], like, g["node"].to_numpy()
        else:
            links = np.concatenate([like @ copies[1], like.T @ copies[0]])
            n, m = like.shape
            whole = np.block([[np.zeros((n, n), bool), like], [like.T, np.zeros((m, m), bool)]])
            node = np.concatenate([p["node"].to_numpy() for p in parts])
        root = _roots(whole)
        yield pd.DataFrame({"node": node, "root": node[root], "links": links.astype(np.int64)})


def ngram_join(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", recall: float = RECALL) -> DataFrame:
    """One row per document: doc_id, class_id, n_links, kept (one document of
    each class: that of the smallest id) and text_sha256."""
    with_code(docs.sparkSession)
    texts = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    of = stored(_of_texts(texts), "sets")
    nodes = stored(of.where("node IS NOT NULL").groupBy("node")
                     .agg(F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "row")).alias("keep"),
                          F.count(F.lit(1)).alias("copies"), F.first("sig").alias("sig"))
                     .withColumn("first", F.col("keep.doc_id")), "nodes")
    runs = runs_for(recall, SIMILARITY[0] / SIMILARITY[1])
    small, alike = chosen_paths(nodes, nodes.count(), runs)
    star = alike.join(alike.groupBy("path").agg(F.min("node").alias("b")), "path").select(F.col("node").alias("a"), "b")
    comps = stored(connected_components(bucket_links(small, nodes).unionByName(star)), "components")
    sizes = comps.groupBy("root").agg(F.count(F.lit(1)).alias("m"))
    active = stored(comps.join(sizes, "root").join(nodes.select("node", "first", "copies"), "node")
                    .select("node", "first", "copies", F.xxhash64("root").alias("comp"),
                            F.ceil(F.col("m") / F.lit(BLOCK)).alias("blocks")), "active")
    wanted = checked_broadcast(active.where("first IS NOT NULL").select(F.col("first").alias("doc_id")).distinct(),
                               BROADCAST_ROWS)
    again = texts.join(wanted, "doc_id", "left_semi").unionByName(texts.where("doc_id IS NULL"))

    def shingled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for b in slices(whole, "text"):
                sets = [s.tobytes() for s in shingle_sets(b.column("text"))]
                node = [hashlib.blake2b(s, digest_size=16).digest() if s else None for s in sets]
                yield pa.RecordBatch.from_arrays([pa.array(node, pa.binary()), pa.array(sets, pa.binary())],
                                                 ["node", "shingles"])

    sets = again.mapInArrow(shingled, "node binary, shingles binary").where("node IS NOT NULL")
    block = F.pmod(F.xxhash64("node"), F.col("blocks"))
    placed = sets.join(checked_broadcast(active.drop("first"), BROADCAST_ROWS), "node").withColumn("block", block)
    dealt = placed.withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)))
    pairs = dealt.select("comp", F.least("block", "other").alias("one"), F.greatest("block", "other").alias("two"), "block",
                         "node", "copies", "shingles")
    met = stored(pairs.repartition("comp", "one", "two").sortWithinPartitions("comp", "one", "two")
                      .mapInPandas(_counted, "node binary, root binary, links long"), "met")
    linked = met.groupBy("node").agg(F.sum("links").alias("links"))
    clusters = connected_components(met.select(F.col("node").alias("a"), F.col("root").alias("b")))
    of_class = clusters.join(nodes.select("node", "keep"), "node").groupBy("root").agg(F.min("keep").alias("best"))
    named = clusters.join(of_class, "root").select("node", "best")
    known = (nodes.select("node", "keep", "copies").join(linked, "node", "left").join(named, "node", "left")
                  .where("copies > 1 OR links > 0")
                  .select("node", F.when(F.col("links") > 0, F.col("best")).otherwise(F.col("keep")).alias("best"),
                          (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links")))
    return of.select("doc_id", "text_sha256", "node", "row").join(stored(known, "known"), "node", "left").select(
        "doc_id", F.when(F.col("n_links").isNull(), F.col("doc_id")).otherwise(F.col("best.doc_id")).alias("class_id"),
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        F.coalesce(F.col("best.row") == F.col("row"), F.lit(True)).alias("kept"), "text_sha256")


def op7_ngram_join(spark, sf_dir: str) -> DataFrame:
    """Near-duplicate class and links of every document."""
    return ngram_join(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text"))
