"""Join strategies with a checked broadcast.

Spark's planner broadcasts on size estimates; for the few joins where the
engine knows a side is a bounded control table (contracts, checkpoints,
replay windows, per-partition spans) we broadcast explicitly, but only after
counting it.  Above the bound the caller gets the shuffle plan instead.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Rows a side may hold to be broadcast by the engine itself.  Control tables
# (one row per table, per replay event, per partition) sit far below it.
BROADCAST_MAX_ROWS = 200_000


def checked_broadcast(small: DataFrame, max_rows: int = BROADCAST_MAX_ROWS) -> DataFrame:
    """``broadcast(small)`` if it holds at most ``max_rows`` rows, else
    ``small`` unchanged (the planner then shuffles both sides).

    The count runs a job on ``small``; callers pass control tables or
    materialised summaries, for which it is cheap."""
    n = small.limit(max_rows + 1).count()
    return F.broadcast(small) if n <= max_rows else small


#: Window lengths are rounded up to powers of this many seconds.
_STEP = 4


def range_join(left: DataFrame, windows: DataFrame, *, key: str, point: str, start: str, end: str) -> DataFrame:
    """Pairs (left row, window) with the same ``key`` and ``point`` inside
    the window's closed interval ``[start, end]``, as two struct columns
    ``__l`` and ``__w`` (select ``__l.<col>`` / ``__w.<col>``).

    Every window goes to the level of its length (a power of four) and covers
    at most two bins of that width; every left row looks in one bin of each
    level that occurs.  The join is an equi-join on (key, level, bin) with the
    interval as a residual, whatever the number and length of the windows: no
    pairs outside of a bin are compared, a window of any length takes two rows
    at most, and a key with many rows spreads over its bins.  The levels (some
    thirty at most, as lengths are 64-bit) are read once to plan."""
    length = F.greatest(F.col(end) - F.col(start), F.lit(0)).cast("double") + 1
    level = F.least(F.ceil(F.log(float(_STEP), length)), F.lit(31)).cast("int")
    width = lambda lv: F.pow(F.lit(_STEP), lv).cast("long")
    bin_of = lambda x, w: x - F.pmod(x, w)  # noqa: E731  (where the bin starts)
    w = (windows.where(F.col(end) >= F.col(start))
                .select(F.struct(*windows.columns).alias("__w"), level.alias("__level"))
                .withColumn("__width", width(F.col("__level"))))
    levels = sorted(r[0] for r in w.select("__level").distinct().collect())
    first, last = (bin_of(F.col(f"__w.{c}").cast("long"), F.col("__width")) for c in (start, end))
    binned = (w.withColumn("__bin", F.explode(F.sequence(first, last, F.col("__width"))))
               .withColumn("__key", F.col(f"__w.{key}")).drop("__width"))
    looks = F.array(*[F.lit(lv) for lv in levels]).cast("array<int>")
    rows = (left.select(F.struct(*left.columns).alias("__l"))
                .withColumn("__level", F.explode(looks))
                .withColumn("__bin", bin_of(F.col(f"__l.{point}").cast("long"), width(F.col("__level"))))
                .withColumn("__key", F.col(f"__l.{key}")))
    inside = (F.col(f"__l.{point}") >= F.col(f"__w.{start}")) & (F.col(f"__l.{point}") <= F.col(f"__w.{end}"))
    return rows.join(binned, ["__key", "__level", "__bin"]).where(inside).select("__l", "__w")
