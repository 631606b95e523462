"""Quality classifier: nearest-neighbour votes in a latent-semantic space.

A text becomes a sparse vector of terms: hashed words, hashed word shapes
(runs of capitals, small letters and digits as one sign each, other signs as
they are) and buckets of a few ratios (distinct lines, distinct words, word length,
share of signs, words that repeat the one before).  Each of the three blocks is weighted by log counts
and inverse document frequency and normalised.  A truncated SVD of labelled
rows gives the latent space.  Up to ``VOTERS`` labelled vectors are broadcast
(a fixed bound: ``VOTERS * RANK`` floats, about 2 MB), every document's cosine
to every one of them is computed in exact blocked products, and the
``NEIGHBOURS`` nearest vote for their label, weighted by similarity.

The fit is bounded: voters are the ``VOTERS`` labelled rows of smallest id
hash, the SVD sees the first ``FIT_ROWS`` of them.  Scoring is one narrow pass
over all documents and whole texts.

Defined results: null text counts as empty; a text without terms, or with no
neighbour of positive similarity, scores the voters' share of label 1; without
any label all score 0.5; labels that are null are left out and repeated labels
vote each; repeated rows are scored each on its own; other columns pass
through, and a clash with an output column is refused.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from zlib import crc32

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.arrow import extended, slices, with_code

VOTERS = 8192
FIT_ROWS = 2048
RANK = 64
NEIGHBOURS = 15
WORDS, SHAPES, RATIOS = 4096, 1024, 80
DIMS = WORDS + SHAPES + RATIOS
#: How much each block of terms weighs.
BLOCKS = (0.5, 1.0, 0.7)
THRESHOLD = 0.7

_UPPER, _LOWER, _DIGIT = re.compile(r"[A-ZÀ-ÖØ-Þ]+"), re.compile(r"[^\W\d_A-ZÀ-ÖØ-Þa]+|a+"), re.compile(r"\d+")


def shape(word: str) -> str:
    return _UPPER.sub("A", _LOWER.sub("a", _DIGIT.sub("0", word)))


def _bucket(share: float) -> int:
    return min(15, int(share * 16))


def _ratios(text: str, words: int, distinct: int, repeats: int) -> list[int]:
    """Term numbers of the text's ratios; none for an empty text."""
    if not words:
        return []
    lines = text.split("\n")
    signs = len(text) - sum(map(text.count, " \n")) - words * 4
    return [_bucket(len(set(lines)) / len(lines)), 16 + _bucket(distinct / words),
            32 + _bucket(len(text) / words / 24), 48 + _bucket(max(0, signs) / len(text)),
            64 + _bucket(repeats / words)]


def terms(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(document, term, log-count weight) of all texts, by document and term."""
    texts = pc.fill_null(texts, "")
    lists = pc.ascii_split_whitespace(texts)
    coded = pc.dictionary_encode(lists.flatten())
    known = coded.dictionary.to_pylist()
    word_id = np.array([crc32(w.lower().encode()) % WORDS for w in known], np.int64)
    shape_id = np.array([WORDS + crc32(shape(w).encode()) % SHAPES for w in known], np.int64)
    real = np.array([bool(w) for w in known], bool)
    codes = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
    doc = np.repeat(np.arange(len(texts)), np.diff(lists.offsets.to_numpy()))
    use = real[codes] if len(codes) else np.zeros(0, bool)
    codes, doc = codes[use], doc[use]
    words = np.bincount(doc, minlength=len(texts))
    distinct = np.bincount(np.unique(doc * max(1, len(known)) + codes) // max(1, len(known)), minlength=len(texts))
    again = np.bincount(doc[1:][(codes[1:] == codes[:-1]) & (doc[1:] == doc[:-1])], minlength=len(texts))
    own = [(i, WORDS + SHAPES + t) for i, text in enumerate(texts.to_pylist())
           for t in _ratios(text, int(words[i]), int(distinct[i]), int(again[i]))]
    own = np.array(own, np.int64).reshape(-1, 2)
    keys = np.concatenate([doc * DIMS + word_id[codes], doc * DIMS + shape_id[codes], own[:, 0] * DIMS + own[:, 1]]
                          if len(codes) else [own[:, 0] * DIMS + own[:, 1]])
    keys, counts = np.unique(keys, return_counts=True)
    return keys // DIMS, keys % DIMS, 1 + np.log(counts)


def weighted(doc: np.ndarray, term: np.ndarray, weight: np.ndarray, idf: np.ndarray, n: int) -> np.ndarray:
    """The weights by idf, each block of a document at its own length."""
    value = weight * idf[term]
    block = np.digitize(term, (WORDS, WORDS + SHAPES))
    length = np.sqrt(np.bincount(doc * 3 + block, value * value, minlength=3 * n))
    return value * np.array(BLOCKS)[block] / np.maximum(length, 1e-12)[doc * 3 + block]


def project(doc: np.ndarray, term: np.ndarray, value: np.ndarray, space: np.ndarray, n: int) -> np.ndarray:
    """Unit latent vectors of ``n`` documents (zero where there are no terms)."""
    out = np.zeros((n, space.shape[1]), np.float32)
    starts = np.flatnonzero(np.diff(doc, prepend=-1))
    cuts = [*starts[np.unique(np.searchsorted(starts, np.arange(0, len(doc), 100_000)).clip(0, max(0, len(starts) - 1)))],
            len(doc)] if len(doc) else []
    for a, b in zip(cuts, cuts[1:]):
        first = np.flatnonzero(np.diff(doc[a:b], prepend=-1))
        out[doc[a:b][first]] = np.add.reduceat(space[term[a:b]] * value[a:b, None].astype(np.float32), first, axis=0)
    return out / np.maximum(np.sqrt((out * out).sum(1, keepdims=True)), 1e-12)


class Model:
    """Latent space and voters."""

    def __init__(self, idf, space, voters, labels):
        self.idf, self.space, self.voters, self.labels = idf, space, voters, labels
        self.prior = float(labels.mean()) if len(labels) else 0.5

    @classmethod
    def of_terms(cls, term_lists: list[np.ndarray], weight_lists: list[np.ndarray], labels: list[int]) -> Model:
        """The fit, from the terms and labels of the voters."""
        n = len(labels)
        if not n:
            return cls(np.ones(DIMS), np.zeros((DIMS, 1), np.float32), np.zeros((0, 1), np.float32), np.zeros(0))
        doc = np.repeat(np.arange(n), [len(t) for t in term_lists])
        term, weight = np.concatenate(term_lists), np.concatenate(weight_lists)
        idf = np.log((1 + n) / (1 + np.bincount(term, minlength=DIMS))) + 1
        value = weighted(doc, term, weight, idf, n)
        rows = min(n, FIT_ROWS)
        dense = np.zeros((rows, DIMS), np.float32)
        some = doc < rows
        dense[doc[some], term[some]] = value[some]
        # Randomised range finder with two power steps, fixed seed.
        rank = max(1, min(RANK, rows))
        probe = np.random.default_rng(0).normal(size=(DIMS, rank + 16)).astype(np.float32)
        for _ in range(3):
            basis, _ = np.linalg.qr(dense @ probe)
            probe = dense.T @ basis
        _, _, right = np.linalg.svd(probe.T, full_matrices=False)
        space = np.ascontiguousarray(right[:rank].T).astype(np.float32)
        return cls(idf, space, project(doc, term, value, space, n), np.array(labels, np.float32))

    def score(self, texts: pa.Array) -> np.ndarray:
        n = len(texts)
        if not len(self.labels):
            return np.full(n, 0.5)
        doc, term, weight = terms(texts)
        latent = project(doc, term, weighted(doc, term, weight, self.idf, n), self.space, n)
        k, out = min(NEIGHBOURS, len(self.labels)), np.empty(n)
        for s in range(0, n, 512):
            like = latent[s:s + 512] @ self.voters.T
            near = np.argpartition(-like, k - 1, axis=1)[:, :k]
            vote = np.maximum(np.take_along_axis(like, near, 1), 0).astype(np.float64)
            total = vote.sum(1)
            yes = (vote * self.labels[near]).sum(1)
            out[s:s + 512] = np.where(total > 1e-9, yes / np.maximum(total, 1e-9), self.prior)
        return np.clip(out, 0.0, 1.0)


def held_out(doc_id: Column) -> Column:
    """Rows that no label may be learned from: crc32 of the id's text mod 4 is 2."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % 4 == 2, F.lit(False))


def fit_quality(docs: DataFrame, labels: DataFrame, voters: int = VOTERS) -> Model:
    """The model of the labelled documents that are not held out: at most
    ``voters`` votes, one for each id and label.  Of document rows that share
    an id the one with the least terms (as bytes) votes."""
    with_code(docs.sparkSession)
    usable = labels.where(F.col("quality").isNotNull() & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))
    chosen = (usable.select("doc_id", (F.col("quality") > 0).cast("int").alias("label"))
                    .orderBy(F.xxhash64("doc_id"), "doc_id", "label").limit(voters))
    rows = (docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
                .join(F.broadcast(chosen.distinct()), "doc_id")  # at most ``voters`` rows of labels
                .select("doc_id", "text", "label", F.xxhash64("doc_id").alias("h")))
    # Texts of the voters stay on the executors: the driver gets their terms, a few hundred numbers each.
    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for b in slices(whole, "text"):
                doc, term, weight = terms(b.column("text"))
                cut = np.searchsorted(doc, np.arange(b.num_rows + 1))
                pack = lambda x, t: pa.array([x[a:z].astype(t).tobytes() for a, z in zip(cut, cut[1:])], pa.binary())
                yield pa.RecordBatch.from_arrays([b.column("h"), b.column("doc_id"), b.column("label"),
                                                  pack(term, "<i4"), pack(weight, "<f4")],
                                                 ["h", "doc_id", "label", "term", "weight"])

    packed = rows.mapInArrow(of, "h long, doc_id long, label int, term binary, weight binary")
    votes = packed.groupBy("h", "doc_id", "label").agg(F.min(F.struct("term", "weight")).alias("v"))
    got = votes.select("h", "doc_id", "label", "v.term", "v.weight").collect()
    got.sort(key=lambda r: (r.h, r.doc_id, r.label))
    return Model.of_terms([np.frombuffer(r.term, "<i4").astype(np.int64) for r in got],
                          [np.frombuffer(r.weight, "<f4").astype(np.float64) for r in got], [r.label for r in got])


def quality_scores(df: DataFrame, model: Model, text_col: str = "text", out: str = "score") -> DataFrame:
    """``df`` with ``out``: the share of similarity-weighted votes for label 1."""
    with_code(df.sparkSession)
    shared = df.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for b in slices(whole, text_col):
                score = pa.array(shared.value.score(b.column(text_col)), pa.float64())
                yield pa.RecordBatch.from_arrays([*b.columns, score], [*b.schema.names, out])

    return df.mapInArrow(run, extended(df, out, "double"))


def op8_quality_knn(spark, sf_dir: str) -> DataFrame:
    """Quality score of every document."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    model = fit_quality(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return quality_scores(docs, model).select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), "score",
        (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))
