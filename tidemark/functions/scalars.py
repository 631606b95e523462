"""Scalar column functions, all built from Spark's JVM-side
functions so they stay inside whole-stage codegen."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidemark.contracts import PAGE_SIZE


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


# -- F14: Unix seconds <-> timestamps ----------------------------------------
def epoch_seconds(ts) -> Column:
    """Unix seconds of a timestamp or timestamp_ntz column (session zone UTC).
    ``unix_seconds`` rejects timestamp_ntz, so cast first."""
    return F.unix_seconds(_c(ts).cast("timestamp"))


def from_epoch(seconds) -> Column:
    """Unix seconds -> timestamp_ntz (wall clock in UTC)."""
    return F.timestamp_seconds(_c(seconds)).cast("timestamp_ntz")


def epoch_literal_ntz(seconds: int) -> Column:
    """A timestamp_ntz literal for a Unix second, used to push a watermark
    down to a parquet scan on the native time column."""
    return F.lit(seconds).cast("long").cast("timestamp").cast("timestamp_ntz")


# -- F1: duration in whole seconds, rounded, null while running --------------
def duration_seconds(start, end) -> Column:
    micros = F.unix_micros(_c(end).cast("timestamp")) - F.unix_micros(_c(start).cast("timestamp"))
    return F.round(micros / F.lit(1_000_000.0)).cast("int")


# -- F3: value that changes only on a terminal status ------------------------
def on_status(status, statuses: tuple[str, ...], new, old) -> Column:
    return F.when(_c(status).isin(*statuses), _c(new)).otherwise(_c(old))


# -- F6: deterministic identifier from a natural key -------------------------
def natural_uuid(*parts) -> Column:
    """UUID-shaped id from a SHA-256 of the natural key, so re-runs produce
    the same id (``uuid()`` is random and not repeatable)."""
    h = F.sha2(F.concat_ws("\u0001", *[_c(p).cast("string") for p in parts]), 256)
    return F.concat_ws("-", F.substring(h, 1, 8), F.substring(h, 9, 4), F.substring(h, 13, 4),
                       F.substring(h, 17, 4), F.substring(h, 21, 12))


# -- F7: schema signature -----------------------------------------------------
def name_signature(names) -> Column:
    """SHA-256 hex of the space-joined names of an array<string> column."""
    return F.sha2(F.array_join(_c(names), " "), 256)


# -- F8: page path and its inverse -------------------------------------------
def page_path(endpoint, cursor, offset) -> Column:
    """``{endpoint}/{cursor}_{offset}.json`` (endpoint keeps its slash)."""
    return F.format_string("%s/%d_%d.json", _c(endpoint), _c(cursor), _c(offset))


PAGE_FILE_PATTERN = r"([^/]+)/(-?\d+)_(\d+)\.json$"


def page_path_parts(path) -> tuple[Column, Column, Column]:
    """(endpoint, cursor, offset) parsed back from a page path."""
    p = _c(path)
    endpoint = F.concat(F.lit("/"), F.regexp_extract(p, PAGE_FILE_PATTERN, 1))
    cursor = F.regexp_extract(p, PAGE_FILE_PATTERN, 2).cast("long")
    offset = F.regexp_extract(p, PAGE_FILE_PATTERN, 3).cast("int")
    return endpoint, cursor, offset


# -- F9: long message cut to head + marker + tail ----------------------------
# 1900 characters at most, first 200 kept, "\n...\n" between,
# the last (1900 - 200) characters kept.
MESSAGE_MAX = 1900
MESSAGE_HEAD = 200
MESSAGE_MARK = "\n...\n"


def truncate_message(msg, max_len: int = MESSAGE_MAX, head: int = MESSAGE_HEAD,
                     mark: str = MESSAGE_MARK) -> Column:
    m = _c(msg)
    tail = max_len - head
    cut = F.concat(F.substring(m, 1, head), F.lit(mark), F.substring(m, -tail, tail))
    return F.when(F.length(m) > max_len, cut).otherwise(m)


# -- F10: alert text ----------------------------------------------------------
# Levels ERROR / WARNING / INFO; text "[LEVEL] msg"; ERROR gets
# the suffix " @everyone".
ALERT_LEVELS = ("ERROR", "WARNING", "INFO")
ERROR_MENTION = " @everyone"


def alert_text(level, msg) -> Column:
    lv = _c(level)
    base = F.concat(F.lit("["), lv, F.lit("] "), _c(msg))
    return F.when(lv == "ERROR", F.concat(base, F.lit(ERROR_MENTION))).otherwise(base)


# -- F11: limit clamp, elapsed ms --------------------------------------------
def clamp_limit(n: int, cap: int = PAGE_SIZE) -> int:
    return min(int(n), cap)


def elapsed_ms(start_seconds, end_seconds) -> Column:
    return ((_c(end_seconds) - _c(start_seconds)) * 1000).cast("int")


# -- F13: list default ----------------------------------------------------------
def empty_if_null(c, element_type: str = "bigint") -> Column:
    return F.coalesce(_c(c), F.array().cast(f"array<{element_type}>"))


# -- A10 -----------------------------------------------------------------------
def safe_ratio(num, den) -> Column:
    """num / nullif(den, 0) as double."""
    d = _c(den)
    return F.when(d == 0, F.lit(None).cast("double")).otherwise(_c(num).cast("double") / d)
