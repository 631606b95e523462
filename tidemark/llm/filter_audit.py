"""Filter interaction audit: what each filter removes, in every order.

Every document that fails a filter is posted: for each part (source value) and
each range of row ids there is one sorted list of failing ids per filter, next
to the lists of good and of toxic ids.  Unions and differences of those lists
are worked out range by range with galloping k-way merges, and only their
sizes leave a range.  What a filter removes when some others came before it is
the size of its list without the union of theirs; orders share these sizes, so
five filters need 80 differences a range for all 120 orders.

A range holds at most 65,536 rows of the table, so no list grows with a part.
Copies are found by the texts' digests: the digests that hold over a
thousandth of all rows (there are fewer than a thousand) are broadcast, the
others joined by a shuffle.

Defined results: null text counts as empty and a null source as the empty
string; rows that repeat are documents of their own; a row without an id is no
copy of anything and has no label; a document counts as good (toxic) if any of
its label rows says 1; parts without failing documents have rows of zeros; the
empty table gives no rows.  Extra columns are not read.
"""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Iterator
from heapq import heapify, heappop, heapreplace
from itertools import permutations
from math import factorial

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.arrow import with_code
from tidemark.llm.components import stored
from tidemark.session import literal_frame

FILTERS = "ABCDE"
SPACE = r"[\x20\x09-\x0D]+"
#: Bits of a row id inside of one range.
RANGE_BITS = 16
#: A digest of more than this share of all rows (one in ...) is broadcast.
HOT = 1000


# Merges of sorted lists ------------------------------------------------------

def gallop(ids: list, start: int, bound) -> int:
    """The first place from ``start`` on whose id is not below ``bound``:
    steps double until they pass it, then the last step is halved."""
    step, low = 1, start
    while low + step < len(ids) and ids[low + step] < bound:
        low += step
        step *= 2
    return bisect_left(ids, bound, low, min(low + step + 1, len(ids)))


def union(lists: list[list]) -> list:
    """The distinct ids of sorted lists, in order.  The list with the lowest
    head gives all it has below the next head at once."""
    heap = [(ids[0], n, 0) for n, ids in enumerate(lists) if ids]
    heapify(heap)
    out: list = []
    while heap:
        head, n, at = heap[0]
        ids = lists[n]
        if len(heap) == 1:
            out += ids[at:]
            break
        bound = min(heap[1:3])[0]
        if bound == head:
            at += 1  # the other list gives it
        else:
            end = gallop(ids, at, bound)
            out += ids[at:end]
            at = end
        if at < len(ids):
            heapreplace(heap, (ids[at], n, at))
        else:
            heappop(heap)
    return out


def difference(ids: list, taken: list) -> list:
    """The ids that are not in ``taken``; both sorted."""
    out: list = []
    at = other = 0
    while at < len(ids):
        other = gallop(taken, other, ids[at])
        if other == len(taken):
            out += ids[at:]
            break
        if taken[other] == ids[at]:
            at += 1
        else:
            end = gallop(ids, at, taken[other])
            out += ids[at:end]
            at = end
    return out


def overlap(ids: list, others: list) -> int:
    """How many ids are in both."""
    short, long = sorted((ids, others), key=len)
    return len(short) - len(difference(short, long))


# Flags and posting lists -----------------------------------------------------

def _flags(text: Column) -> dict[str, Column]:
    bare = F.btrim(text, F.lit(" \t\n\x0b\x0c\r"))
    split = F.split(bare, SPACE)
    none = (bare == "").cast("int")  # an empty text splits into one empty word
    n, distinct = F.size(split) - none, F.size(F.array_distinct(split)) - none
    capitals = F.octet_length(F.regexp_replace(text, "[^A-Z]+", ""))
    return {"A": n < 200, "B": 100 * distinct.cast("long") < 50 * n.cast("long"),
            "C": 100 * capitals.cast("long") > 2 * F.length(text).cast("long"), "D": text.rlike("[#$%&*|]")}


def failing(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", part_col: str = "source") -> DataFrame:
    """One row per document: row, doc_id, part and a boolean per filter (true:
    fails)."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    flags = _flags(text)
    rows = stored(docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(part_col), F.lit("")).alias("part"),
                              *[v.alias(k) for k, v in flags.items()], F.unhex(F.sha2(text, 256)).alias("digest"))
                      .withColumn("row", F.monotonically_increasing_id()), "audit-rows")
    copies = stored(rows.groupBy("digest").agg(F.min("doc_id").alias("least"), F.count(F.lit(1)).alias("n"))
                        .where("n > 1"), "audit-copies")
    limit = F.lit(rows.count() // HOT)
    hot = copies.where(F.col("n") > limit).select("digest", "least", F.lit(True).alias("hot"))
    met = rows.join(F.broadcast(hot), "digest", "left")
    cold = met.where("hot IS NULL").drop("least").join(
        copies.where(F.col("n") <= limit).select("digest", "least"), "digest", "left")
    later = F.coalesce(F.col("doc_id") > F.col("least"), F.lit(False)).alias("E")
    return (met.where("hot").unionByName(cold)
               .select("row", "doc_id", "part", *flags, later))


def posting_lists(fails: DataFrame, labels: DataFrame) -> DataFrame:
    """One row per part and range: sorted ids that fail each filter, and of
    those that fail any the good and the toxic ones."""
    marks = labels.where("doc_id IS NOT NULL").groupBy("doc_id").agg(
        F.max(F.coalesce(F.col("quality") == 1, F.lit(False))).alias("good"),
        F.max(F.coalesce(F.col("toxic") == 1, F.lit(False))).alias("toxic")).where("good OR toxic")
    marked = fails.where(" OR ".join(FILTERS)).join(marks, "doc_id", "left")
    posts = [F.array_sort(F.collect_list(F.when(F.col(c), F.col("row")))).alias(c) for c in (*FILTERS, "good", "toxic")]
    return marked.groupBy("part", F.shiftright("row", RANGE_BITS).alias("range")).agg(*posts)


SIZES = "part string, filter string, before int, fails long, taken long, removed long, good long, toxic long"


def range_sizes(lists: dict[str, list]) -> list[tuple]:
    """(filter, before, fails, taken, removed, good, toxic) of one range: for
    each filter and each set of others before it (a bit each), the sizes of
    its list, of the union of theirs, and of the difference: all, good, toxic."""
    unions = [union([lists[f] for k, f in enumerate(FILTERS) if subset >> k & 1]) for subset in range(1 << len(FILTERS))]
    out = []
    for k, f in enumerate(FILTERS):
        for subset, taken in enumerate(unions):
            if not subset >> k & 1:
                left = difference(lists[f], taken)
                out.append((f, subset, len(lists[f]), len(taken), len(left),
                            overlap(left, lists["good"]), overlap(left, lists["toxic"])))
    return out


def merged_sizes(posts: DataFrame) -> DataFrame:
    """``SIZES`` of every part: the sizes of its ranges summed."""
    with_code(posts.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for n in range(batch.num_rows):
                row = batch.slice(n, 1).to_pylist()[0]
                sizes = list(zip(*range_sizes(row)))
                names = ["part", "filter", "before", "fails", "taken", "removed", "good", "toxic"]
                types = [pa.string(), pa.string(), pa.int32(), *[pa.int64()] * 5]
                cols = [[row["part"]] * len(sizes[0]), *sizes]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types)], names)

    sums = [F.sum(c).alias(c) for c in ("fails", "taken", "removed", "good", "toxic")]
    return posts.mapInArrow(run, SIZES).groupBy("part", "filter", "before").agg(*sums)


# The audit -------------------------------------------------------------------

def _steps(spark: SparkSession) -> DataFrame:
    """Every step of every order, with the set of filters before it."""
    rows = [("".join(order), k + 1, f, sum(1 << FILTERS.index(g) for g in order[:k]))
            for order in permutations(FILTERS) for k, f in enumerate(order)]
    return literal_frame(spark, rows, "filter_order string, step int, filter string, before int")


def audit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
          part_col: str = "source") -> DataFrame:
    """One row per part, order of the filters and step."""
    spark = docs.sparkSession
    fails = stored(failing(docs, id_col, text_col, part_col), "audit-fails")
    sizes = merged_sizes(stored(posting_lists(fails, labels), "audit-posts"))
    cases = F.array(*[F.struct(F.lit(f).alias("filter"), F.lit(s).alias("before")) for k, f in enumerate(FILTERS)
                      for s in range(1 << len(FILTERS)) if not s >> k & 1])
    parts = (fails.groupBy("part").agg(F.count(F.lit(1)).alias("documents"))
                  .select("part", "documents", F.inline(cases)))
    every = parts.join(sizes, ["part", "filter", "before"], "left").fillna(0, ["fails", "taken", "removed", "good", "toxic"])
    last = len(FILTERS) - 1
    orders = F.element_at(F.array(*[F.lit(factorial(n) * factorial(last - n)) for n in range(last + 1)]),
                          F.bit_count("before") + 1)
    whole = every.groupBy("part", "filter").agg(
        F.sum(F.when(F.bit_count("before") == last, F.col("removed"))).alias("unique_fails"),
        F.sum(F.col("removed") * orders).alias("shapley"))
    return (every.join(whole, ["part", "filter"]).join(F.broadcast(_steps(spark)), ["filter", "before"])
                 .select("part", "filter_order", "step", (F.col("documents") - F.col("taken") - F.col("removed")).alias("kept"),
                         "removed", (F.col("fails") - F.col("removed")).alias("redundant"), "unique_fails",
                         F.col("good").alias("good_lost"), F.col("toxic").alias("toxic_lost"), "shapley"))


def op11_filter_audit(spark, sf_dir: str) -> DataFrame:
    """The five filters over all documents, per source, order and step."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text", "source")
    return audit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet").select("doc_id", "quality", "toxic"))


OP11_SQL = r"""
WITH d AS (
  SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS t,
         regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
l AS (
  SELECT doc_id, max(CASE WHEN quality = 1 THEN 1 ELSE 0 END) AS good,
         max(CASE WHEN toxic = 1 THEN 1 ELSE 0 END) AS toxic FROM labels GROUP BY doc_id),
f AS (
  SELECT part, coalesce(good, 0) AS good, coalesce(toxic, 0) AS toxic,
         CASE WHEN len(w) < 200 THEN 1 ELSE 0 END
         + CASE WHEN 100 * len(list_distinct(w)) < 50 * len(w) THEN 2 ELSE 0 END
         + CASE WHEN 100 * len(regexp_extract_all(t, '[A-Z]')) > 2 * length(t) THEN 4 ELSE 0 END
         + CASE WHEN regexp_matches(t, '[#$%&*|]') THEN 8 ELSE 0 END
         + CASE WHEN d.doc_id > min(d.doc_id) OVER (PARTITION BY t) THEN 16 ELSE 0 END AS m
  FROM d LEFT JOIN l ON l.doc_id = d.doc_id),
c AS (SELECT part, m, count(*) AS n, sum(good) AS good, sum(toxic) AS toxic FROM f GROUP BY part, m),
x AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS a, unnest([1, 2, 4, 8, 16]) AS b),
o AS (
  SELECT x1.a || x2.a || x3.a || x4.a || x5.a AS filter_order, [x1.b, x2.b, x3.b, x4.b, x5.b] AS bits
  FROM x x1, x x2, x x3, x x4, x x5 WHERE x1.b + x2.b + x3.b + x4.b + x5.b = 31
    AND len(list_distinct([x1.b, x2.b, x3.b, x4.b, x5.b])) = 5),
s AS (
  SELECT filter_order, CAST(step AS INTEGER) AS step, bits[step] AS bit, coalesce(list_sum(bits[1:step - 1]), 0) AS seen
  FROM o, unnest([1, 2, 3, 4, 5]) AS t(step)),
r AS (
  SELECT part, filter_order, step, bit,
         coalesce(sum(n) FILTER (m & (seen + bit)::INT = 0), 0)::BIGINT AS kept,
         coalesce(sum(n) FILTER (m & bit > 0 AND m & seen::INT = 0), 0)::BIGINT AS removed,
         coalesce(sum(n) FILTER (m & bit > 0 AND m & seen::INT > 0), 0)::BIGINT AS redundant,
         coalesce(sum(n) FILTER (m = bit), 0)::BIGINT AS unique_fails,
         coalesce(sum(good) FILTER (m & bit > 0 AND m & seen::INT = 0), 0)::BIGINT AS good_lost,
         coalesce(sum(toxic) FILTER (m & bit > 0 AND m & seen::INT = 0), 0)::BIGINT AS toxic_lost
  FROM c, s GROUP BY part, filter_order, step, bit)
SELECT part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost,
       sum(removed) OVER (PARTITION BY part, bit)::BIGINT AS shapley
FROM r
"""
