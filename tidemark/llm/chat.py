"""Chat formatting after cumulative-snapshot collapse [native].

Chat logs often hold the same conversation again and again, one snapshot per
turn.  A turn's content is known by the MD5 of its role and text, so texts are
not shuffled to compare them.  Every turn gets the rolling hash of its
conversation up to and with it (two 64-bit hashes of position and content, each
summed over the prefix as exact decimals).  A conversation whose last hash is some longer conversation's
hash at that position is a prefix of it; anti-joins leave the maximal
conversations, of equal ones that with the smallest id, and only those are
rendered.

Running sums over a conversation are taken in two steps, inside blocks of
``BLOCK`` turn numbers and over the sums of blocks, so that no window sees
the rows of a long conversation whole.  Rendering alone gathers a
conversation, as its result is one text.

Defined results: turns are in order of their number, nulls first, and of equal
number in order of their content's MD5; rows that repeat whole are one turn; null role or text renders empty and differs
from an empty one; rows without conv_id are one conversation of null id; the
empty table gives no rows.  Extra columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.components import stored

BLOCK = 256
_WIDE = "decimal(38,0)"


def _content() -> Column:
    """MD5 of role and text; null differs from empty."""
    mark = lambda c: F.concat(F.col(c).isNotNull().cast("int").cast("string"), F.coalesce(F.col(c), F.lit("")))
    return F.md5(F.concat(mark("role"), F.lit("\x1f"), mark("text")))


def prefix_hashes(turns: DataFrame) -> DataFrame:
    """(conv_id, pos, h1, h2): position from 1 and rolling hashes of every
    turn."""
    keys = ["conv_id", "block"]
    rows = (turns.select("conv_id", "turn", _content().alias("content")).distinct()
                 .withColumn("block", F.floor(F.coalesce(F.col("turn"), F.lit(-1)) / BLOCK)))
    inside = Window.partitionBy(*keys).orderBy("turn", "content").rowsBetween(Window.unboundedPreceding, 0)
    prior = Window.partitionBy("conv_id").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)

    def carried(df: DataFrame, sums: dict[str, Column]) -> DataFrame:
        """``df`` with running sums: inside the block plus all blocks before."""
        totals = df.groupBy(*keys).agg(*[F.sum(v).alias(f"_{k}") for k, v in sums.items()])
        before = totals.select(*[F.col(k).alias(f"_{k}") for k in keys], *[
            F.coalesce(F.sum(f"_{k}").over(prior), F.lit(0)).alias(f"_before_{k}") for k in sums])
        joined = df.withColumns({f"_in_{k}": F.sum(v).over(inside) for k, v in sums.items()}).join(
            before, F.col("conv_id").eqNullSafe(F.col("_conv_id")) & (F.col("block") == F.col("_block")))
        return joined.withColumns({k: F.col(f"_in_{k}") + F.col(f"_before_{k}") for k in sums}).drop(
            "_conv_id", "_block", *[f"_in_{k}" for k in sums], *[f"_before_{k}" for k in sums])

    placed = carried(rows, {"pos": F.lit(1)})
    part = lambda salt: F.xxhash64(F.lit(salt), "pos", "content").cast(_WIDE)
    hashed = carried(placed, {"h1": part("a"), "h2": part("b")})
    return hashed.select("conv_id", "pos", F.col("h1").cast(_WIDE).alias("h1"), F.col("h2").cast(_WIDE).alias("h2"))


def maximal_conversations(turns: DataFrame) -> DataFrame:
    """(conv_id, n_turns, n_equal): conversations that are no prefix of a
    longer one, one for each set of equal ones."""
    hashes = stored(prefix_hashes(turns), "prefixes")
    last = hashes.groupBy("conv_id").agg(F.max_by(F.struct("pos", "h1", "h2"), "pos").alias("end"))
    # Equal conversations fall together before the anti-join, so no end is frequent.
    ends = (last.groupBy("end.pos", "end.h1", "end.h2")
                .agg(F.min("conv_id").alias("conv_id"), F.count(F.lit(1)).alias("n_equal")))
    grown = (hashes.join(last.select(F.col("conv_id").alias("c"), F.col("end.pos").alias("n")),
                         F.col("conv_id").eqNullSafe(F.col("c")) & (F.col("pos") < F.col("n")))
                   .select("pos", "h1", "h2").distinct())
    return (ends.join(grown, ["pos", "h1", "h2"], "left_anti")
                .select("conv_id", F.col("pos").alias("n_turns"), "n_equal"))


def render_chat(turns: DataFrame) -> DataFrame:
    """Maximal conversations as one text each: conv_id, n_turns, n_equal (as
    many equal conversations were logged) and text."""
    kept = maximal_conversations(turns)
    empty = lambda c: F.coalesce(F.col(c), F.lit(""))
    line = F.concat(F.lit("<|im_start|>"), empty("role"), F.lit("\n"), empty("text"), F.lit("<|im_end|>\n"))
    rows = turns.select(F.col("conv_id").alias("c"), F.struct("turn", _content().alias("content"), line.alias("line")).alias("t"))
    # The set of a conversation's turns is its result, and drops rows that repeat.
    texts = F.transform(F.array_sort(F.collect_set("t")), lambda t: t["line"])
    return (rows.join(kept, F.col("conv_id").eqNullSafe(F.col("c"))).groupBy("conv_id", "n_turns", "n_equal")
                .agg(F.concat_ws("", texts).alias("text")).select("conv_id", "n_turns", "n_equal", "text"))


def op2_chat_format(spark, sf_dir: str) -> DataFrame:
    """All conversations, collapsed and rendered."""
    turns = spark.read.parquet(f"{sf_dir}/conversations.parquet")
    return render_chat(turns).select("conv_id", F.col("n_turns").cast("long").alias("n_turns"), "n_equal", "text")


OP2_SQL = r"""
WITH t AS (
  SELECT DISTINCT conv_id, turn, role, text,
         md5(CASE WHEN role IS NULL THEN '0' ELSE '1' || role END || chr(31)
             || CASE WHEN text IS NULL THEN '0' ELSE '1' || text END) AS content
  FROM conversations),
p AS (
  SELECT conv_id, row_number() OVER w AS pos,
         list(struct_pack(r := role, t := text)) OVER w AS prefix,
         string_agg('<|im_start|>' || coalesce(role, '') || chr(10) || coalesce(text, '') || '<|im_end|>' || chr(10), '')
           OVER w AS body
  FROM t WINDOW w AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, content ROWS UNBOUNDED PRECEDING)),
n AS (SELECT conv_id, max(pos) AS n FROM p GROUP BY conv_id),
e AS (SELECT p.prefix, p.pos AS n_turns, min(p.conv_id) AS conv_id, count(*) AS n_equal, any_value(p.body) AS text
      FROM p JOIN n ON p.conv_id IS NOT DISTINCT FROM n.conv_id AND p.pos = n.n GROUP BY p.prefix, p.pos),
g AS (SELECT DISTINCT p.prefix FROM p JOIN n ON p.conv_id IS NOT DISTINCT FROM n.conv_id AND p.pos < n.n)
SELECT conv_id, n_turns::BIGINT AS n_turns, n_equal::BIGINT AS n_equal, text FROM e
WHERE NOT EXISTS (SELECT 1 FROM g WHERE g.prefix IS NOT DISTINCT FROM e.prefix)
"""
