"""Byte-level BPE encoding and decoding by per-prefix dynamic programming.

For every prefix of a pre-token exactly one token can be the last token of
its BPE encoding: a vocabulary token that ends there (found with the
Aho-Corasick automaton of the vocabulary's byte strings) and that is pair-compatible
with the last token of the prefix before it.  The table of last tokens is
filled left to right; following it back from the end gives the ids that the
merge rules give, in time linear in the pre-token's length.

Two tokens are pair-compatible when undoing their merges, latest first, never
meets a pair across the boundary that the merge rules would have joined
earlier.  A token takes part only if its own bytes encode to itself.

Defined results: null text counts as empty and has no ids; a text that spells
out a special token of the vocabulary gets that token's id; repeated rows
are encoded each on its own; other columns pass through.  ``bpe_encode`` and
``bpe_decode`` refuse an output column that is already there.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain

import ahocorasick
import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, StringType

from tidemark.llm.arrow import extended, slices, with_code

#: White space as the byte-level splitter sees it (Unicode White_Space).
_SPACE = r"\t-\r\x20\x85\xa0  -     　"
#: Fixed value: the splitting pattern of byte-level vocabularies.
SPLIT = (r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^" + _SPACE + r"\p{L}\p{N}]+|["
         + _SPACE + r"]+(?![^" + _SPACE + r"])|[" + _SPACE + r"]+")
#: Pre-tokens whose ids a Python worker remembers; beyond it the memory starts
#: anew, so it changes time, never results.
MEMO = 300_000


def byte_chars() -> dict[str, int]:
    """The printable character that stands for each byte in the vocabulary
    file -> the byte: printable Latin-1 stands for itself, the rest is
    counted up from U+0100."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in set(shown)]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}


def token_bytes(spec: dict) -> dict[int, bytes]:
    """The bytes that each id of a parsed vocabulary file stands for."""
    chars = byte_chars()
    raw = {i: bytes(chars[c] for c in t) for t, i in spec["model"]["vocab"].items() if all(c in chars for c in t)}
    return raw | {t["id"]: t["content"].encode() for t in spec["added_tokens"]}


class Vocabulary:
    """Tokens, merge ranks and the automaton of one vocabulary file's text."""

    def __init__(self, text: str):
        spec = json.loads(text)
        self.raw = token_bytes(spec)
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        ids = spec["model"]["vocab"]
        self.pair_rank: dict[tuple[int, int], int] = {}
        self.rank, self.halves = {}, {}
        for r, m in enumerate(spec["model"]["merges"]):
            a, b = m.split(" ") if isinstance(m, str) else m
            pair, whole = (ids[a], ids[b]), ids[a + b]
            self.pair_rank[pair] = r
            self.rank.setdefault(whole, r)
            self.halves.setdefault(whole, pair)
        self.compatible = lru_cache(maxsize=1 << 18)(self._compatible)
        self.automaton = ahocorasick.Automaton()
        special = set(self.special.values())
        for i, b in self.raw.items():
            if i not in special and self._canonical(i):
                self.automaton.add_word(b.decode("latin-1"), (len(b), i))
        self.automaton.make_automaton()
        self.split = regex.compile(SPLIT)
        marks = "|".join(regex.escape(t) for t in sorted(self.special, key=len, reverse=True))
        self.marks = regex.compile(f"({marks})") if marks else None
        self.memo: dict[str, tuple[int, ...]] = {}

    def _canonical(self, t: int) -> bool:
        """True if the bytes of ``t`` encode to ``t`` alone."""
        if t not in self.halves:
            return len(self.raw[t]) == 1
        a, b = self.halves[t]
        return self._canonical(a) and self._canonical(b) and self._compatible(a, b, self.rank[t])

    def _compatible(self, a: int, b: int, limit: int = 1 << 60) -> bool:
        """True if the merge rules keep ``a`` and ``b`` apart: undo the later
        of their last merges again and again (of equal ranks the right one is
        later) and look for a pair across the boundary that ranks before what
        was undone."""
        rank, halves, pairs = self.rank, self.halves, self.pair_rank
        while True:
            joined = pairs.get((a, b))
            if joined is not None and joined < limit:
                return False
            of_a, of_b = rank.get(a, -1), rank.get(b, -1)
            if of_a > of_b:
                limit, a = of_a, halves[a][1]
            elif of_b >= 0:
                limit, b = of_b + 1, halves[b][0]
            else:
                return True

    def piece(self, word: str) -> tuple[int, ...]:
        """Ids of one pre-token."""
        coded = word.encode("utf-8").decode("latin-1")
        last = [-1] * (len(coded) + 1)
        size = [0] * (len(coded) + 1)
        for end, (n, token) in self.automaton.iter(coded):  # at each end, the longest first
            end += 1
            if last[end] < 0:
                before = end - n
                if not before or (last[before] >= 0 and self.compatible(last[before], token)):
                    last[end], size[end] = token, n
        ids, at = [], len(coded)
        while at:
            ids.append(last[at])
            at -= size[at]
        return tuple(reversed(ids))

    def encode(self, text: str) -> np.ndarray:
        memo = self.memo
        if len(memo) > MEMO:
            memo.clear()
        parts: list[tuple[int, ...]] = []
        for k, span in enumerate(self.marks.split(text) if self.marks else [text]):
            if k % 2:
                parts.append((self.special[span],))
                continue
            for word in self.split.findall(span):
                ids = memo.get(word)
                if ids is None:
                    ids = self.piece(word)
                    if len(word) <= 64:
                        memo[word] = ids
                parts.append(ids)
        return np.fromiter(chain.from_iterable(parts), dtype=np.int32)


@lru_cache(maxsize=2)
def _vocabulary(text: str) -> Vocabulary:
    return Vocabulary(text)


@lru_cache(maxsize=2)
def _token_bytes(text: str) -> pa.Array:
    raw = token_bytes(json.loads(text))
    return pa.array([raw.get(i, b"") for i in range(max(raw) + 1)], pa.binary())


def _read_once(spark, path: str):
    """The vocabulary file's text, sent to each executor once (a few MB)."""
    with open(path, encoding="utf-8") as f:
        return spark.sparkContext.broadcast(f.read())


def bpe_encode(df: DataFrame, text_col: str, vocabulary: str, out: str = "ids") -> DataFrame:
    """``df`` with ``out``: the token ids of ``text_col`` (array of int) under
    the byte-level BPE vocabulary file at ``vocabulary``."""
    with_code(df.sparkSession)
    shared = _read_once(df.sparkSession, vocabulary)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocab = _vocabulary(shared.value)
        for whole in batches:
            for batch in slices(whole, text_col):
                rows = [vocab.encode(t or "") for t in batch.column(text_col).to_pylist()]
                offsets = np.cumsum([0, *map(len, rows)]).astype(np.int32)
                flat = np.concatenate([np.empty(0, np.int32), *rows])
                ids = pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat))
                yield pa.RecordBatch.from_arrays([*batch.columns, ids], [*batch.schema.names, out])

    return df.mapInArrow(run, extended(df, out, ArrayType(IntegerType())))


def bpe_decode(df: DataFrame, ids_col: str, vocabulary: str, out: str = "decoded") -> DataFrame:
    """``df`` with ``out``: the text of the token ids in ``ids_col``, special
    tokens spelled out.  Null ids give an empty text, ids outside of the
    vocabulary nothing; bytes that are not UTF-8 become U+FFFD."""
    with_code(df.sparkSession)
    shared = _read_once(df.sparkSession, vocabulary)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = _token_bytes(shared.value)
        for whole in batches:
            for batch in slices(whole, ids_col):
                texts = []
                for ids in batch.column(ids_col):
                    ids = np.asarray(ids.values if ids.is_valid else [], dtype=np.int64)
                    ids = ids[(ids >= 0) & (ids < len(pieces))]
                    got = pieces.take(pa.array(ids))
                    _, ends, data = got.buffers()
                    n = int(np.frombuffer(ends, np.int32)[len(ids)]) if len(ids) else 0
                    texts.append(bytes(data[:n]).decode("utf-8", "replace") if n else "")
                yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(texts, pa.string())],
                                                 [*batch.schema.names, out])

    return df.mapInArrow(run, extended(df, out, StringType()))


def round_trip(vocab: Vocabulary, pieces: pa.Array, text: str) -> tuple[np.ndarray, str]:
    """(ids, the text they spell); raises if that is not ``text``."""
    ids = vocab.encode(text)
    got = pieces.take(pa.array(ids))
    _, ends, data = got.buffers()
    n = int(np.frombuffer(ends, np.int32)[len(ids)]) if len(ids) else 0
    back = bytes(data[:n]).decode("utf-8", "replace") if n else ""
    if back != text:
        raise ValueError(f"the token ids of a text of {len(text)} characters give another text")
    return ids, back


def bpe_round_trip(df: DataFrame, text_col: str, vocabulary: str, out: str = "ids", decoded: str = "decoded") -> DataFrame:
    """``df`` without ``text_col``, with the token ids and the text decoded
    from them: encoded, decoded and compared in one pass of one worker, which
    fails if a text does not come back."""
    with_code(df.sparkSession)
    shared = _read_once(df.sparkSession, vocabulary)
    kept = df.drop(text_col)
    names = kept.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocab, pieces = _vocabulary(shared.value), _token_bytes(shared.value)
        for whole in batches:
            for batch in slices(whole, text_col):
                pairs = [round_trip(vocab, pieces, t or "") for t in batch.column(text_col).to_pylist()]
                rows, texts = [ids for ids, _ in pairs], [back for _, back in pairs]
                offsets = np.cumsum([0, *map(len, rows)]).astype(np.int32)
                flat = np.concatenate([np.empty(0, np.int32), *rows])
                ids = pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat))
                yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in names], ids, pa.array(texts, pa.string())],
                                                 [*names, out, decoded])

    return df.mapInArrow(run, extended(kept, out, ArrayType(IntegerType())).add(decoded, StringType()))


def op9_bpe(spark, sf_dir: str) -> DataFrame:
    """Every document encoded and decoded again: doc_id, n_tokens, ids_sha256,
    decoded_sha256.  One narrow pass over the texts, no shuffle."""
    import public_tokenizers

    path = public_tokenizers.path("byte_bpe_50k.json")
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    coded = bpe_encode(docs, "text", path).drop("text")
    both = bpe_decode(coded, "ids", path)
    return both.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ","), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"))
