"""Mixing sources to target token weights by entropy balancing [native].

Among all document rates that give each source its target number of words,
entropy balancing takes those closest (in relative entropy, by words) to one
copy of everything.  The dual of that problem is convex: with one multiplier
``lam`` per source it is ``sum(size * exp(lam)) - lam * target``, and a
document's rate is the exponential tilt ``exp(lam)`` of its source.  Sources
do not overlap, so the Hessian is diagonal: after one pre-aggregation the
Newton iterations of all sources run on the executors, each on its own row,
in one column expression.

Targets are shares of ``total`` by weight, none above ``cap`` times the
source's own words; what a capped source cannot take is shared again by
weight among the others until none is above (a few aggregations; each hands
the driver two numbers).

Rates become whole copies: every document gets the whole part, and one more
copy goes to documents in the order of a hash of their id until the source's
words are spent, so a source is off by half of one document at most.  The
order is cut into 4,096 hash buckets per source; words before a bucket come
from bucket sums, so most buckets are in or out as a whole and only the one
that crosses the line is ordered: no task orders a source, and rows of any
width stay where they are but for that bucket.

Defined results: null text has size 0; the null source is a source of its own
and comes last; documents of size 0 take 0 words; a source without words has
target 0; repeated rows are documents of their own and ties of the order
between them are interchangeable; the empty table gives no rows.  Extra
columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.operators.joins import checked_broadcast
from tidemark.operators.sequence import row_index
from tidemark.session import scratch_path

WORD = r"[^\x20\x09-\x0D]+"
NEWTON_STEPS = 64
NEAR = 1e-9


def words(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def _stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to the shared folder and read again."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def capped_targets(sources: DataFrame, total_share: float, cap: float) -> DataFrame:
    """``sources`` (skey, source_size, weight) with ``target``."""
    one = sources.agg(F.sum("source_size").alias("n"), F.sum("weight").alias("w")).first()
    if not one.w:
        return sources.withColumn("target", F.lit(0.0))
    total = total_share * one.n
    level, before = total / one.w, -1
    top = F.col("source_size") * F.lit(cap)
    while True:
        full = sources.where(top <= F.lit(level) * F.col("weight"))
        got = full.agg(F.count(F.lit(1)).alias("k"), F.sum(top).alias("n"), F.sum("weight").alias("w")).first()
        if got.k == before or got.w == one.w:
            break
        before, level = got.k, (total - (got.n or 0)) / (one.w - (got.w or 0))
    return sources.withColumn("target", F.least(top.cast("double"), F.lit(level) * F.col("weight")))


def newton_rate(size: Column, target: Column) -> Column:
    """exp of the dual multiplier of one source."""
    step = lambda lam, _: lam - (size * F.exp(lam) - target) / (size * F.exp(lam))
    lam = F.aggregate(F.sequence(F.lit(1), F.lit(NEWTON_STEPS)), F.lit(0.0).cast("double"), step)
    rate = F.when((size > 0) & (target > 0), F.exp(lam)).otherwise(F.lit(0.0))
    return F.when(F.abs(rate - F.round(rate)) < NEAR, F.round(rate)).otherwise(rate)


def mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
        weights=(3, 1, 2), total_share: float = 1.5, cap: float = 2.0, carry: bool = False) -> DataFrame:
    """One row per document: id, source, size, source_size, target, rate,
    copies and taken (= copies * size).  With ``carry`` the rows of ``docs``
    come back as they are, each repeated as often as the mix takes it."""
    order = F.md5(F.coalesce(F.col(id_col).cast("string"), F.lit("")))
    # A key that is never null, in code point order with the null source last.
    skey = F.when(F.col(source_col).isNull(), F.lit("1")).otherwise(F.concat(F.lit("0"), F.col(source_col)))
    own = {"skey": skey, "size": words(F.col(text_col)), "ord": order, "bucket": F.substring(order, 1, 3)}
    sizes = _stored(docs.select(F.col(id_col).alias("doc_id"), F.col(source_col).alias("source"),
                                *[v.alias(k) for k, v in own.items()]), "mix-sizes")
    sources = _stored(sizes.groupBy("skey").agg(F.sum("size").alias("source_size")), "mix-sources")
    pick = F.element_at(F.array(*[F.lit(w) for w in weights]), (F.pmod(F.col("n") - 1, len(weights)) + 1).cast("int"))
    ranked = row_index(sources, [], ["skey"], "n").withColumn("weight", pick).drop("n")
    solved = (capped_targets(_stored(ranked, "mix-ranked"), total_share, cap)
              .withColumn("rate", newton_rate(F.col("source_size"), F.col("target")))
              .withColumn("spare", F.round((F.col("rate") - F.floor("rate")) * F.col("source_size"), 6)))
    prior = Window.partitionBy("skey").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    buckets = (sizes.groupBy("skey", "bucket").agg(F.sum("size").alias("n"))
                    .withColumn("before", F.coalesce(F.sum("n").over(prior), F.lit(0)))
                    .join(solved.drop("weight"), "skey"))
    buckets = checked_broadcast(_stored(buckets, "mix-buckets"))
    mixed = {f"__{k}": v for k, v in own.items()} | {"__id": F.col(id_col)}
    rows = (docs.withColumns(mixed) if carry else
            sizes.select("doc_id", "source", *[F.col(k).alias(f"__{k}") for k in own], F.col("doc_id").alias("__id")))
    facts = ["n", "before", "source_size", "target", "rate", "spare"]
    rows = rows.join(buckets.select(F.col("skey").alias("__skey"), F.col("bucket").alias("__bucket"),
                                    *[F.col(f).alias(f"__{f}") for f in facts]), ["__skey", "__bucket"])
    whole = F.floor("__rate").cast("long")
    inside = F.col("__before") + F.col("__n") <= F.col("__spare")
    crossing = ~inside & (F.col("__before") <= F.col("__spare"))
    running = (Window.partitionBy("__skey", "__bucket").orderBy("__ord", "__id", "__size")
                     .rowsBetween(Window.unboundedPreceding, 0))
    middle = F.col("__before") + F.sum("__size").over(running) - F.col("__size") / 2
    placed = (rows.where(~crossing).withColumn("__copies", whole + inside.cast("long")).unionByName(
              rows.where(crossing).withColumn("__copies", whole + (middle <= F.col("__spare")).cast("long"))))
    if carry:
        # ``sequence`` counts down to 0, so a document that is not taken needs its own filter.
        taken = placed.where("__copies > 0")
        return taken.withColumn("__copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("__copies")))).select(*docs.columns)
    return placed.select("doc_id", "source", *[F.col(f"__{c}").alias(c) for c in
                                               ("size", "source_size", "target", "rate", "copies")],
                         (F.col("__copies") * F.col("__size")).alias("taken"))


def op6_mixing(spark, sf_dir: str) -> DataFrame:
    """All documents mixed to the weights 3, 1, 2 at 150 % of their words."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text", "source")
    return mix(docs).select("doc_id", "size", "source_size", "target", "taken", "copies")


OP6_SQL = r"""
WITH RECURSIVE d AS (
  SELECT doc_id, source, md5(coalesce(CAST(doc_id AS VARCHAR), '')) AS ord,
         coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size
  FROM documents),
s AS (
  SELECT source, sum(size)::BIGINT AS n,
         CASE (row_number() OVER (ORDER BY encode(source) NULLS LAST) - 1) % 3 WHEN 0 THEN 3 WHEN 1 THEN 1 ELSE 2 END AS w
  FROM d GROUP BY source),
lv AS (
  SELECT 0 AS step, (SELECT 1.5::DOUBLE * sum(n) / sum(w) FROM s) AS level
  UNION ALL
  SELECT step + 1,
         (SELECT (1.5::DOUBLE * sum(n) - coalesce(sum(2.0::DOUBLE * n) FILTER (2.0::DOUBLE * n <= lv.level * w), 0))
                 / nullif(sum(w) - coalesce(sum(w) FILTER (2.0::DOUBLE * n <= lv.level * w), 0), 0) FROM s)
  FROM lv WHERE step < 40 AND level IS NOT NULL),
top AS (SELECT max(level) AS level FROM lv),
t AS (
  SELECT source, n, least(2.0::DOUBLE * n, level * w) AS target,
         CASE WHEN n > 0 THEN least(2.0::DOUBLE * n, level * w) / n ELSE 0 END AS rate
  FROM s, top),
r AS (
  SELECT *, round((rate - floor(rate)) * n, 6) AS spare FROM (
    SELECT source, n, target, CASE WHEN abs(rate - round(rate)) < 1e-9 THEN round(rate) ELSE rate END AS rate FROM t)),
p AS (
  SELECT d.doc_id, d.size, r.n AS source_size, r.target, r.rate, r.spare,
         sum(d.size) OVER (PARTITION BY d.source ORDER BY d.ord, d.doc_id, d.size
                           ROWS UNBOUNDED PRECEDING) - d.size / 2.0 AS middle
  FROM d JOIN r ON d.source IS NOT DISTINCT FROM r.source)
SELECT doc_id, size, source_size, target, (c * size)::BIGINT AS taken, c AS copies
FROM (SELECT *, (floor(rate) + CASE WHEN middle <= spare THEN 1 ELSE 0 END)::BIGINT AS c FROM p)
"""
