"""Phrase collocation mining by Toivonen's method.

A sample of the documents proposes words and phrases (at a lowered threshold).
One pass over all documents then counts, exactly, all words and every phrase
whose two parts (it without its last, and without its first word) are both
proposed: the proposals together with their negative border.  A border phrase
that turns out frequent is a failure of the sample: it is proposed after all,
and a further pass counts only what that adds to the border, until a pass
brings no failure.  As a frequent phrase has frequent parts, nothing frequent
is missed whatever the sample was.

Proposals are known to a pass as bits of a hash table of fixed size, so what
is broadcast does not grow with the corpus.  Bits can only propose too much,
and what has been counted before is told by the same bits, so every phrase is
counted once and wholly.  Words are named by 64-bit hashes of language and
word; all distinct words are counted by their spelling, and if two of them
share a hash the mining starts anew with another seed.  Tasks add up what they
find in runs of texts, of a bounded number of rows; Spark deals the rows by
their hashes and adds up the rest.

A phrase is scored at its worst cut in two; a phrase is dropped where a longer
candidate holds at least half of its occurrences.  Scores are whole numbers
from decimals of 38 digits, exact for counts below 10^13.

Defined results: null text counts as empty; a null language is ``und``; rows
that repeat count each; texts without words add nothing; the empty table gives
no rows.  Extra columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.arrow import slices, with_code
from tidemark.llm.byte_tokens import text_buffers
from tidemark.llm.components import stored

#: Share of the documents in the sample, and the least count there.
SAMPLE, LOWERED = 0.2, 2
#: The bits that tell proposals: at most 2 to this power (16 MB).
MOST_BITS = 27
#: Rows of a length that a task adds up before it gives them out, and rows of
#: the batches given out.
HELD, BATCH_ROWS = 1 << 20, 1 << 16
#: Words of so many bytes at most are hashed as numbers.
WIDE = 32
WORD, BLANK, BREAK = range(3)
_U = np.uint64


def _byte_kinds() -> tuple[np.ndarray, np.ndarray]:
    kind, lower = np.zeros(256, np.uint8), np.arange(256, dtype=np.uint8)
    kind[[0x20, 0x09]] = BLANK
    kind[[*b".,;:!?", *range(0x0A, 0x0E)]] = BREAK
    lower[65:91] += 32
    return kind, lower


KIND, LOWER = _byte_kinds()


# Words and phrases of a column of texts -------------------------------------

def mixed(*parts: np.ndarray) -> np.ndarray:
    """64 bits of several integer columns."""
    h = np.zeros(len(parts[0]), _U)
    with np.errstate(over="ignore"):
        for p in parts:
            h = (h ^ p.astype(_U)) * _U(0x9E3779B97F4A7C15)
            h = (h ^ (h >> _U(32))) * _U(0xD6E8FEB86659FD93)
            h ^= h >> _U(29)
    return h


class Words:
    """The words of a column of texts: hash, spelling, language, and whether a
    word is followed by another in its piece."""

    def __init__(self, texts: pa.Array, langs: list[str], seed: int):
        bounds, raw = text_buffers(texts)
        raw = LOWER[raw]
        kind = KIND[raw]
        edge = np.zeros(len(raw) + 1, bool)
        edge[bounds] = True
        word = kind == WORD
        start, end = word.copy(), word.copy()
        start[1:] &= ~word[:-1] | edge[1:-1]
        end[:-1] &= ~word[1:] | edge[1:-1]
        self.start, self.end = np.flatnonzero(start), np.flatnonzero(end) + 1
        piece = np.cumsum((kind == BREAK) | edge[:-1])[self.start]
        self.raw, self.langs = raw, langs
        self.owner = np.searchsorted(bounds, self.start, side="right") - 1
        self.follows = np.zeros(len(self.start), bool)
        self.follows[:-1] = piece[1:] == piece[:-1]
        self.hash = self._hashes(seed)

    def __len__(self) -> int:
        return len(self.start)

    def spelling(self, n: int) -> str:
        return self.raw[self.start[n]:self.end[n]].tobytes().decode()

    def _hashes(self, seed: int) -> np.ndarray:
        size = self.end - self.start
        padded = np.concatenate([self.raw, np.zeros(WIDE + 8, np.uint8)])
        eight = np.ndarray((len(self.raw) + WIDE,), "<u8", padded, strides=(1,))
        masks = np.array([(1 << 8 * n) - 1 for n in range(9)], _U)
        own = {lang: xxhash.xxh64_intdigest(lang, seed) for lang in set(self.langs)}
        lang = np.array([own[x] for x in self.langs], _U)[self.owner] if len(self.owner) else np.empty(0, _U)
        parts = [eight[np.minimum(self.start + 8 * k, len(self.raw))] & masks[np.clip(size - 8 * k, 0, 8)]
                 for k in range(WIDE // 8)]
        out = mixed(lang, size, *parts)
        for n in np.flatnonzero(size > WIDE):
            out[n] = xxhash.xxh64_intdigest(self.raw[self.start[n]:self.end[n]].tobytes(), int(lang[n]))
        return out


def bits_of(keys: np.ndarray, power: int) -> np.ndarray:
    return (keys >> _U(64 - power)).astype(np.int64)


def has(bits: np.ndarray, keys: np.ndarray, power: int) -> np.ndarray:
    at = bits_of(keys, power)
    return (bits[at >> 6] >> (at & 63).astype(_U)) & _U(1) != 0


def _counted(parts: list[np.ndarray], keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(places, counts) of groups of equal rows of ``parts``; rows of one key
    but different parts end a group (then a row may be in several)."""
    order = np.argsort(keys)
    new = np.ones(len(order), bool)
    new[1:] = False
    for p in parts:
        s = p[order]
        new[1:] |= s[1:] != s[:-1]
    first = np.flatnonzero(new)
    return order[first], np.diff(np.append(first, len(order)))


def phrase_counts(words: Words, filters: dict[int, tuple], power: int) -> Iterator[tuple]:
    """(places, length, counts) of the phrases of length k in ``filters``: with
    (new, old) those whose parts both have a bit in new and not both in old;
    with None all of them."""
    if 1 in filters:
        at, n = _counted([words.hash], words.hash)
        yield at, 1, n
    alive, key = np.arange(len(words)), words.hash
    for k in range(2, max(filters) + 1):
        # ``key[i]`` is that of the phrase of k - 1 words at ``alive[i]``.
        whole = np.zeros(len(words), _U)
        whole[alive] = key
        there = np.zeros(len(words) + 1, bool)
        there[alive] = True
        on = words.follows[alive] & there[alive + 1]
        at = alive[on]
        if k in filters:
            keep = np.ones(len(at), bool)
            if filters[k] is not None:
                new, old = filters[k]
                keep = has(new, whole[at], power) & has(new, whole[at + 1], power)
                if old is not None:
                    keep &= ~(has(old, whole[at], power) & has(old, whole[at + 1], power))
            own = at[keep]
            parts = [words.hash[own + j] for j in range(k)]
            first, n = _counted(parts, mixed(*parts))
            yield own[first], k, n
        alive, key = at, mixed(whole[at], words.hash[at + k - 1])


def phrase_keys(columns: list[np.ndarray]) -> np.ndarray:
    """The key of a phrase from the hashes of its words."""
    key = columns[0]
    for h in columns[1:]:
        key = mixed(key, h)
    return key


# Passes ----------------------------------------------------------------------

def _hashes(k: int) -> list[str]:
    return [f"h{j}" for j in range(1, k + 1)]


def added_up(found: list[pa.RecordBatch], keys: list[str]) -> Iterator[pa.RecordBatch]:
    """The rows of ``found`` with the counts of equal keys added up."""
    if found:
        table = pa.Table.from_batches(found).group_by(keys, use_threads=False).aggregate([("n", "sum")])
        yield from table.rename_columns([*keys, "n"]).to_batches(BATCH_ROWS)


def counts(texts: DataFrame, filters: dict[int, tuple], power: int, seed: int, longest: int, least: int) -> DataFrame:
    """One pass over (text, lang): words (all of them) and phrases with their
    counts of at least ``least``."""
    spark = texts.sparkSession
    shared = spark.sparkContext.broadcast(filters)
    keys = ["k", "lang", "word", *_hashes(longest)]

    def found(words: Words) -> Iterator[tuple[int, pa.RecordBatch]]:
        for at, k, n in phrase_counts(words, shared.value, power):
            columns = [pa.array(words.hash[at + j].view(np.int64)) for j in range(k)] + [pa.array(n.astype(np.int64))]
            if k == 1:
                columns = [pa.array([words.langs[o] for o in words.owner[at]], pa.string()),
                           pa.array([words.spelling(i) for i in at], pa.string()), *columns]
            yield k, pa.RecordBatch.from_arrays(columns, [*(keys[1:3] if k == 1 else []), *_hashes(k), "n"])

    def whole(k: int, part: pa.RecordBatch) -> pa.RecordBatch:
        m, there = part.num_rows, dict(zip(part.schema.names, part.columns))
        columns = [pa.array(np.full(m, k, np.int32))]
        columns += [there[c] if c in there else pa.nulls(m, pa.string()) for c in keys[1:3]]
        columns += [there[c] if c in there else pa.nulls(m, pa.int64()) for c in [*keys[3:], "n"]]
        return pa.RecordBatch.from_arrays(columns, [*keys, "n"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, list[pa.RecordBatch]] = {}

        def out(k: int) -> Iterator[pa.RecordBatch]:
            part = held.pop(k)
            yield from (whole(k, b) for b in added_up(part, part[0].schema.names[:-1]))

        for wide in batches:
            for batch in slices(wide, "text"):
                for k, part in found(Words(batch.column("text"), batch.column("lang").to_pylist(), seed)):
                    held.setdefault(k, []).append(part)
                    if sum(b.num_rows for b in held[k]) >= HELD:
                        yield from out(k)
        for k in list(held):
            yield from out(k)

    kinds = f"k int, lang string, word string, {', '.join(f'{h} long' for h in _hashes(longest))}, n long"
    # Dealt first: most phrases are rare, so an aggregate of Spark's in each
    # task of texts would fill memory, spill and save little.
    return (texts.mapInArrow(run, kinds).repartition(*_hashes(longest)).groupBy(*keys).agg(F.sum("n").alias("n"))
                 .where((F.col("k") == 1) | (F.col("n") >= least)))


def proposal_bits(phrases: DataFrame, k: int, power: int) -> np.ndarray:
    """The bits of phrases of k words: gathered as at most 2^power / 64 numbers."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = bits_of(phrase_keys([c.to_numpy().view(_U) for c in batch.columns]), power)
            ones = (_U(1) << (at & 63).astype(_U)).view(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(at >> 6), pa.array(ones)], ["place", "ones"])

    found = (phrases.select(*_hashes(k)).mapInArrow(run, "place long, ones long")
                    .groupBy("place").agg(F.bit_or("ones").alias("ones")).toArrow())
    bits = np.zeros(1 << (power - 6), _U)
    bits[found.column("place").to_numpy()] = found.column("ones").to_numpy().view(_U)
    return bits


def frequent(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", min_count: int = 10, longest: int = 3,
             sample: float = SAMPLE, lowered: int = LOWERED) -> tuple[DataFrame, list[DataFrame]]:
    """(words, phrases): all words (lang, word, h1, n), and a table for each
    length from 1 to ``longest`` of the phrases of at least ``min_count``
    (h1, ..., n)."""
    with_code(docs.sparkSession)
    texts = docs.select(F.coalesce(F.col(text_col), F.lit("")).alias("text"),
                        F.coalesce(F.col(lang_col), F.lit("und")).alias("lang"))
    seed = 0
    while True:
        every = range(1, longest)
        proposed = stored(counts(texts.sample(sample, seed=seed), dict.fromkeys(every), 0, seed, longest, lowered)
                          .where(F.col("n") >= lowered), "phrases-sample")
        n = max([r["count"] for r in proposed.groupBy("k").count().collect()], default=0)
        power = min(MOST_BITS, max(16, (16 * n).bit_length()))
        bits = {k: proposal_bits(proposed.where(F.col("k") == k), k, power) for k in every}
        done = stored(counts(texts, {1: None} | {k + 1: (bits[k], None) for k in every}, power, seed, longest, min_count),
                      "phrases-counted")
        words = done.where("k = 1").select("lang", "word", "h1", "n")
        if not words.groupBy("h1").count().where("count > 1").isEmpty():
            seed += 1  # two words of one hash
            continue
        tables = [done.where((F.col("k") == k) & (F.col("n") >= min_count)).select(*_hashes(k), "n")
                  for k in range(1, longest + 1)]
        fresh = tables[:-1]
        while True:
            failed = {}
            for k, table in zip(every, fresh):
                wider = bits[k] | proposal_bits(table, k, power) if table is not None else bits[k]
                if (wider != bits[k]).any():
                    failed[k], bits[k] = bits[k], wider
            if not failed:
                return words, tables
            more = stored(counts(texts, {k + 1: (bits[k], old) for k, old in failed.items()}, power, seed, longest,
                                 min_count), "phrases-expanded")
            fresh = [None] * (longest - 1)
            for k in failed:
                found = more.where(F.col("k") == k + 1).select(*_hashes(k + 1), "n")
                tables[k] = tables[k].unionByName(found)
                if k < longest - 1:
                    fresh[k] = found


# Scores ----------------------------------------------------------------------

def cut_score(a: Column, left: Column, right: Column) -> Column:
    """floor(1000000 * a * a / (left * right)), exact."""
    a, left, right = (c.cast("decimal(13,0)") for c in (a, left, right))
    return F.call_function("div", F.lit(1000000).cast("decimal(7,0)") * (a * a), left * right)


def collocations(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", min_count: int = 10,
                 longest: int = 3, top: int = 2000, **sampling) -> DataFrame:
    """The ``top`` phrases of 2 to ``longest`` words of each language: lang,
    rank, phrase, a, l, r, n, score."""
    words, tables = frequent(docs, text_col, lang_col, min_count, longest, **sampling)
    spelt = words.where(F.col("n") >= min_count).select("lang", "word", "h1")
    totals = words.groupBy("lang").agg(F.sum("n").alias("n"))

    def part(k: int, first: int, name: str) -> DataFrame:
        return tables[k - 1].select(*[F.col(h).alias(f"h{first + j}") for j, h in enumerate(_hashes(k))],
                                    F.col("n").alias(name))

    found = []
    for k in range(2, longest + 1):
        rows = part(k, 1, "a")
        longer = [tables[m - 1].select(*[F.col(f"h{i + j}").alias(f"h{j}") for j in range(1, k + 1)], F.col("n").alias("within"))
                  for m in range(k + 1, longest + 1) for i in range(m - k + 1)]
        if longer:
            most = reduce(DataFrame.unionByName, longer).groupBy(*_hashes(k)).agg(F.max("within").alias("within"))
            rows = (rows.join(most, _hashes(k), "left")
                        .where("within IS NULL OR 100 * within < 50 * a").drop("within"))
        for cut in range(1, k):
            rows = (rows.join(part(cut, 1, f"l{cut}"), _hashes(cut))
                        .join(part(k - cut, cut + 1, f"r{cut}"), [f"h{j}" for j in range(cut + 1, k + 1)])
                        .withColumn(f"s{cut}", cut_score(F.col("a"), F.col(f"l{cut}"), F.col(f"r{cut}"))))
        for j in range(1, k + 1):
            names = [F.col("h1").alias(f"h{j}"), F.col("word").alias(f"w{j}"), *([F.col("lang")] if j == 1 else [])]
            rows = rows.join(spelt.select(*names), f"h{j}")
        worst = F.least(*[F.struct(F.col(f"s{c}").alias("score"), F.lit(c).alias("cut"), F.col(f"l{c}").alias("l"),
                                   F.col(f"r{c}").alias("r")) for c in range(1, k)]) if k > 2 else F.struct(
            F.col("s1").alias("score"), F.lit(1).alias("cut"), F.col("l1").alias("l"), F.col("r1").alias("r"))
        found.append(rows.withColumn("worst", worst).select(
            "lang", F.concat_ws(" ", *[f"w{j}" for j in range(1, k + 1)]).alias("phrase"), "a", "worst.l", "worst.r",
            "worst.score"))
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    ranked = (reduce(DataFrame.unionByName, found).withColumn("rank", F.row_number().over(order).cast("long"))
              .where(F.col("rank") <= top))
    return ranked.join(totals, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")


def op12_collocations(spark, sf_dir: str) -> DataFrame:
    """The first 2,000 phrases of two and three words of each language."""
    return collocations(spark.read.parquet(f"{sf_dir}/documents.parquet").select("text", "lang"))


OP12_SQL = r"""
WITH d AS (
  SELECT coalesce(lang, 'und') AS lang, string_split_regex(
           translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
           '[.,;:!?\x0A-\x0D]') AS pieces FROM documents),
p AS (SELECT lang, unnest(pieces) AS piece FROM d),
w AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS ws FROM p),
u AS (SELECT lang, ws, unnest(range(1, len(ws) + 1)) AS i FROM w),
f1 AS (SELECT lang, ws[i] AS a1, count(*) AS f FROM u GROUP BY 1, 2),
f2 AS (SELECT lang, ws[i] AS a1, ws[i + 1] AS a2, count(*) AS f FROM u WHERE i + 1 <= len(ws)
       GROUP BY 1, 2, 3 HAVING count(*) >= 10),
f3 AS (SELECT lang, ws[i] AS a1, ws[i + 1] AS a2, ws[i + 2] AS a3, count(*) AS f FROM u WHERE i + 2 <= len(ws)
       GROUP BY 1, 2, 3, 4 HAVING count(*) >= 10),
n AS (SELECT lang, sum(f)::BIGINT AS n FROM f1 GROUP BY lang),
c2 AS (
  SELECT f2.lang, f2.a1 || ' ' || f2.a2 AS phrase, f2.f AS a, x.f AS l, y.f AS r
  FROM f2 JOIN f1 x ON x.lang = f2.lang AND x.a1 = f2.a1 JOIN f1 y ON y.lang = f2.lang AND y.a1 = f2.a2
  WHERE NOT EXISTS (SELECT 1 FROM f3 t WHERE t.lang = f2.lang AND t.a1 = f2.a1 AND t.a2 = f2.a2 AND 100 * t.f >= 50 * f2.f)
    AND NOT EXISTS (SELECT 1 FROM f3 t WHERE t.lang = f2.lang AND t.a2 = f2.a1 AND t.a3 = f2.a2 AND 100 * t.f >= 50 * f2.f)),
c3 AS (
  SELECT f3.lang, f3.a1 || ' ' || f3.a2 || ' ' || f3.a3 AS phrase, f3.f AS a, x.f AS l1, yz.f AS r1, xy.f AS l2, z.f AS r2
  FROM f3 JOIN f1 x ON x.lang = f3.lang AND x.a1 = f3.a1 JOIN f1 z ON z.lang = f3.lang AND z.a1 = f3.a3
       JOIN f2 xy ON xy.lang = f3.lang AND xy.a1 = f3.a1 AND xy.a2 = f3.a2
       JOIN f2 yz ON yz.lang = f3.lang AND yz.a1 = f3.a2 AND yz.a2 = f3.a3),
s AS (
  SELECT lang, phrase, a, l, r, (1000000::HUGEINT * a * a // (l::HUGEINT * r))::BIGINT AS score FROM c2
  UNION ALL
  SELECT lang, phrase, a, CASE WHEN s1 <= s2 THEN l1 ELSE l2 END, CASE WHEN s1 <= s2 THEN r1 ELSE r2 END, least(s1, s2)
  FROM (SELECT *, (1000000::HUGEINT * a * a // (l1::HUGEINT * r1))::BIGINT AS s1,
               (1000000::HUGEINT * a * a // (l2::HUGEINT * r2))::BIGINT AS s2 FROM c3)),
k AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, encode(phrase)) AS rank FROM s)
SELECT k.lang, rank, phrase, a, l, r, n.n, score FROM k JOIN n ON n.lang = k.lang WHERE rank <= 2000
"""
