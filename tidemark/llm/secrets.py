"""Secret scan: fixed patterns plus guess costs of credential values.

Three patterns give the base spans: ``assign`` (a credential word, a sign of
assignment, a value of 12 or more characters), ``access`` (AKIA keys of 18 or
more) and ``hex`` (runs of 16 or more).  Matches are the leftmost
non-overlapping ones of each kind; one whose length falls short is dropped
with all it covered.  A base span covers its whole match, an assign span so the
credential word as well as the value.

The method adds ``guess`` spans: values that follow a wider set of credential
words are cut into dictionary words, dates, repeats, keyboard walks and
brute-force characters so that the product of the parts' guess counts is
smallest (dynamic programming over the value's positions, in log10).  Words are
the fixed passwords below and then the corpus's own words by the number of
documents that hold them (``corpus_words``).  Repeats and walks count at every
length from 3 up, dates in every form.  A value
that costs at least ``min_guesses`` is a secret; placeholders such as
``password1`` or ``qwerty`` are cheap and stay out.  A guess span covers the
value alone, and is left out where a base span overlaps it.

Defined results: null text counts as empty and has no spans; texts are scanned
whole; offsets are code points, end exclusive; spans are in order of start,
then kind as listed; repeated rows are scanned each on its own; other columns
pass through, and a clash with the output column is refused.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.arrow import extended, slices, with_code

KINDS = ("assign", "access", "hex", "guess")

ASSIGN = re.compile(r"(password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)",
                    re.ASCII | re.IGNORECASE)
ACCESS = re.compile(r"AKIA[A-Z0-9]+", re.ASCII)
HEX = re.compile(r"[0-9a-f]+", re.ASCII)
LONG_HEX = re.compile(r"[0-9a-f]{16,}", re.ASCII)
CONTEXT = re.compile(
    r"(?:pass(?:word|wd|phrase|code)|pwd|secret|token|credentials?|auth|(?:api|access|private|signing)[_-]?key)"
    r"[\"']?[\x20\t]*(?::=|=>|[:=]|\bis\b)[\x20\t]*[\"'`]?([^\s\"'`<>,;(){}\[\]]+)", re.ASCII | re.IGNORECASE)
#: A text without any of these words has no assign or guess span.
HINT = "(?i)pass|pwd|secret|token|credential|auth|key"

#: Frequent passwords and password parts, commonest first.
COMMON = (
    "password", "123456", "qwerty", "admin", "welcome", "letmein", "secret", "login", "master", "dragon", "monkey",
    "shadow", "sunshine", "princess", "football", "baseball", "iloveyou", "trustno", "superman", "batman", "hello",
    "freedom", "whatever", "michael", "jordan", "hunter", "ranger", "buster", "thomas", "tigger", "robert", "soccer",
    "test", "guest", "root", "user", "default", "changeme", "change", "example", "sample", "dummy", "foo", "bar",
    "baz", "null", "none", "true", "false", "your", "my", "token", "key", "api", "pass", "word", "value", "here",
    "insert", "enter", "replace", "placeholder", "redacted", "hidden", "private", "public", "server", "client",
    "database", "spring", "summer", "autumn", "winter", "january", "february", "march", "april", "june", "july",
    "august", "september", "october", "november", "december", "monday", "friday", "love", "money", "angel", "star",
    "computer", "internet", "samsung", "google", "apple", "cookie", "cheese", "pepper", "ginger", "orange", "purple",
    "os", "env", "environ", "getenv", "config", "settings", "required", "optional", "self", "args", "request", "get",
)
RANK = {w: i + 1 for i, w in enumerate(COMMON)}
#: The longest word that is looked up, and how many corpus words are ranked.
LONGEST = 20
RANKED = 50_000
LEET = str.maketrans("@4301$57!", "aaeolssti")
ROWS = ("`1234567890-=", "qwertyuiop[]", "asdfghjkl;'", "zxcvbnm,./")
NEXT = {(a, b) for row in ROWS for a, b in zip(row, row[1:])}
NEXT |= {(b, a) for a, b in NEXT}
NEXT |= {(a, b) for s in ("abcdefghijklmnopqrstuvwxyz", "0123456789") for a, b in zip(s, s[1:])}
_DAY, _MONTH, _YEAR = r"(?:0[1-9]|[12]\d|3[01])", r"(?:0[1-9]|1[0-2])", r"(?:19|20)\d{2}"
DATES = [(re.compile(f"{_YEAR}[-/.]?{_MONTH}[-/.]?{_DAY}", re.ASCII), math.log10(365 * 120)),
         (re.compile(f"{_DAY}[-/.]?{_MONTH}[-/.]?{_YEAR}", re.ASCII), math.log10(365 * 120)),
         (re.compile(_YEAR, re.ASCII), 2.1)]
CUT = math.log10(2)


def char_cost(c: str) -> float:
    """log10 of the guesses for one brute-force character."""
    if c.isdigit():
        return 1.0
    if c.isalpha():
        return math.log10(26 if c.isascii() else 100)
    return math.log10(33)


def word_cost(typed: str, words: dict[str, int]) -> float | None:
    """log10 of the guesses of a word as typed (capitals and signs for letters
    cost extra), or None if it is none."""
    low = typed.lower()
    plain = low.translate(LEET)
    found = [len(RANK) + words[w] if w in words else None for w in (plain, low)] + [RANK.get(plain), RANK.get(low)]
    rank = min((r for r in found if r), default=None)
    if rank is None:
        return None
    cased = 0.0 if typed == low else CUT if typed[1:] == low[1:] else 1.0
    return math.log10(rank + 1) + cased + CUT * (low not in RANK and low not in words)


class _Runs:
    """The cheapest run (repeat or walk) that ends at the place asked for.

    A run from i to j costs ``base(i) + log10(j - i)``.  The lead of an earlier
    start over a later one only grows with j, so a start that is no better than
    an earlier one when it is first long enough never will be, and one whose
    base a later start does not exceed is done with."""

    def __init__(self) -> None:
        self.live: list[tuple[int, float]] = []

    def add(self, i: int, base: float) -> None:
        if all(b + math.log10(i + 3 - a) > base + math.log10(3) for a, b in self.live):
            self.live = [(a, b) for a, b in self.live if b < base] + [(i, base)]

    def best(self, j: int) -> float:
        return min((b + math.log10(j - a) for a, b in self.live), default=math.inf)


def guess_cost(value: str, words: dict[str, int] | None = None) -> float:
    """log10 of the guesses that the cheapest segmentation needs: each part
    multiplies the count, and each part after the first costs a factor 2 for
    the choice of cutting there (brute-force characters do not).  ``words`` are
    ranks from 1 of words beyond the fixed ones."""
    words, low, n = words or {}, value.lower(), len(value)
    if len(low) != n:  # a letter whose small form has two characters
        low = "".join(c.lower() if len(c.lower()) == 1 else c for c in value)
    best = [0.0] + [math.inf] * n
    kinds = [(lambda a, b: a == b, None), (lambda a, b: (a, b) in NEXT, math.log10(47))]
    runs, starts = [_Runs(), _Runs()], [0, 0]
    for j in range(n + 1):
        if j >= 2:  # a step that is none ends the run
            for k, (step, _) in enumerate(kinds):
                if not step(low[j - 2], low[j - 1]):
                    runs[k], starts[k] = _Runs(), j - 1
        for k, (_, first) in enumerate(kinds):
            i = j - 3
            if i >= starts[k]:
                runs[k].add(i, best[i] + CUT * (i > 0) + (char_cost(value[i]) if first is None else first))
            best[j] = min(best[j], runs[k].best(j))
        if j == n:
            break
        best[j + 1] = min(best[j + 1], best[j] + char_cost(value[j]))
        before = best[j] + CUT * (j > 0)
        for e in range(j + 2, min(n, j + LONGEST) + 1):
            cost = word_cost(value[j:e], words)
            if cost is not None and before + cost < best[e]:
                best[e] = before + cost
        if value[j].isdigit():
            for pattern, cost in DATES:
                m = pattern.match(value, j)
                if m:
                    best[m.end()] = min(best[m.end()], before + cost)
    return best[-1]


def corpus_words(df: DataFrame, text_col: str, most: int = RANKED, least: int = 20) -> dict[str, int]:
    """Ranks from 1 of the ``most`` words that the most rows of ``df`` hold
    (``least`` at least): words of 2 to 20 letters a-z in either case that
    stand alone, with a punctuation mark after them at most."""
    alone = F.regexp_extract_all(F.lower(text_col), F.lit(r"(?<!\S)([a-z]{2,20})(?=[.,;:!?]?(?!\S))"), F.lit(1))
    held = df.select(F.explode(F.array_distinct(alone)).alias("word")).groupBy("word").agg(F.count(F.lit(1)).alias("n"))
    top = held.where(F.col("n") >= least).orderBy(F.desc("n"), "word").limit(most).collect()
    return {r.word: i for i, r in enumerate(top, 1)}


def base_spans(text: str) -> list[tuple[int, str, int]]:
    """(start, kind, end) of the three fixed patterns."""
    found = [(m.start(), "assign", m.end()) for m in ASSIGN.finditer(text) if m.end(2) - m.start(2) >= 12]
    found += [(m.start(), "access", m.end()) for m in ACCESS.finditer(text) if m.end() - m.start() >= 18]
    found += [(m.start(), "hex", m.end()) for m in LONG_HEX.finditer(text)]  # runs are maximal either way
    return found


def scan(text: str, min_cost: float = 10.0, words: dict[str, int] | None = None) -> list[dict]:
    """All spans of one text, in order."""
    found = [(s, k, e, None) for s, k, e in base_spans(text)]
    taken = [(s, e) for s, _, e, _ in found]
    for m in CONTEXT.finditer(text):
        s, e = m.span(1)
        value = m[1].rstrip(".!?*#$%&:")
        e = s + len(value)
        if len(value) >= 8 and all(e <= a or b <= s for a, b in taken):
            cost = guess_cost(value, words)
            if cost >= min_cost:
                found.append((s, "guess", e, cost))
    found.sort(key=lambda x: (x[0], KINDS.index(x[1]), x[2]))
    return [{"kind": k, "start": s, "end": e, "log10_guesses": c} for s, k, e, c in found]


SPANS = "array<struct<kind:string,start:long,end:long,log10_guesses:double>>"
_ARROW = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()),
                             ("log10_guesses", pa.float64())]))


def secret_spans(df: DataFrame, text_col: str, out: str = "secrets", min_guesses: float = 1e10,
                 words: dict[str, int] | None = None) -> DataFrame:
    """``df`` with ``out``: every secret in ``text_col`` as kind, start, end
    and, for guess spans, the cost.  ``words`` (at most ``RANKED``) are
    broadcast.  One narrow pass; a column-wise filter
    leaves most texts to two vectorised searches."""
    with_code(df.sparkSession)
    least = math.log10(min_guesses)
    if len(words or {}) > RANKED:
        raise ValueError(f"more than {RANKED} words")
    shared = df.sparkSession.sparkContext.broadcast(words or {})

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in slices(whole, text_col):
                text = batch.column(text_col)
                maybe = pc.match_substring_regex(text, f"[0-9a-f]{{16}}|AKIA|{HINT}")
                maybe = pc.fill_null(maybe, False).to_pylist()
                rows = [scan(text[i].as_py(), least, shared.value) if hit else [] for i, hit in enumerate(maybe)]
                yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(rows, _ARROW)],
                                                 [*batch.schema.names, out])

    return df.mapInArrow(run, extended(df, out, SPANS))


def op10_secret_scan(spark, sf_dir: str) -> DataFrame:
    """Secrets of every document, its words ranked over all documents: counts by base kind, the digest of the base
    spans and all spans as text."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    found = secret_spans(docs, "text", words=corpus_words(docs, "text")).drop("text")
    count = lambda kind: F.size(F.filter("secrets", lambda s: s["kind"] == kind)).cast("long")
    line = lambda spans: F.array_join(F.transform(spans, lambda s: F.concat_ws(
        ":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")
    return found.select(
        "doc_id", count("assign").alias("n_assign"), count("access").alias("n_access"), count("hex").alias("n_hex"),
        F.sha2(line(F.filter("secrets", lambda s: s["kind"] != "guess")), 256).alias("base_sha256"),
        line(F.col("secrets")).alias("spans"))
