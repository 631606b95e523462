"""Packing documents into sequences by patterns of lengths.

Documents are token ids with an end mark; one longer than a sequence is cut
into full sequences from its end, so only its first piece may be shorter.
What is to be packed is then known by its histogram alone, a number for each
length up to the capacity.  Patterns of up to three lengths that fill a
sequence exactly are enumerated, and non-negative least squares (an active-set
method on the histogram) says how often to repeat each; the repeats are
rounded down, and what is left over is packed best-fit, longest first, again
by length and number, into the room of patterns that ran out of a length and
into further sequences.  The plan is at most some thousand patterns, whatever
the number of documents.

The pieces find their places without being gathered: pieces of a length are
numbered by blocks of 65,536 rows (sums of the blocks before, then the row's
place in its block), and a number of a length names a sequence and an offset
in the plan, which is broadcast.

Defined results: null and empty texts are documents of the end mark alone;
documents that repeat are packed each on its own; ids may be null; the empty
table gives no rows.  Extra columns are not read.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.arrow import slices, with_code
from tidemark.llm.byte_tokens import encoder
from tidemark.llm.components import stored

CAPACITY = 1024
BLOCK_BITS = 16
#: Patterns that join the fit in one step.
STEP = 48
#: Steps without progress after which the fit ends.
PATIENCE = 4
#: Weight of the shortest lengths in the fit; the longest weigh 1.
FLOOR = 0.1
#: Shares of the fitted repeats that are tried; the rest is packed best-fit.
SHARES = (1.0, 0.9, 0.7, 0.4)


# The plan --------------------------------------------------------------------

def exact_patterns(lengths: np.ndarray, capacity: int) -> np.ndarray:
    """Rows of up to three of ``lengths`` (0: none) that sum to ``capacity``;
    a length may repeat."""
    there = np.zeros(capacity + 1, bool)
    there[lengths] = True
    there[0] = True
    out = []
    for a in np.flatnonzero(there[1:]) + 1:  # the longest of the pattern
        b = np.arange((capacity - a + 1) // 2, min(a, capacity - a) + 1)
        c = capacity - a - b
        fits = there[b] & there[c]
        out.append(np.stack([np.full(fits.sum(), a), b[fits], c[fits]], axis=1))
    return np.concatenate([np.empty((0, 3), np.int64), *out])


def fit_repeats(patterns: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Non-negative x that makes ``patterns``, x times each, come near
    ``counts`` (by length) in the least-squares sense, a length weighing by
    its share of a sequence, as long leftovers are the dear ones.  Active set:
    the patterns of steepest descent, no length twice among them, join the
    fitted set, which is solved anew without those that turn negative."""
    weight = FLOOR + (1 - FLOOR) * np.arange(len(counts)) / len(counts)
    weight[0] = 0
    b = weight * counts
    best = np.zeros(len(patterns))
    active, z = np.empty(0, np.int64), np.empty(0)
    least, left, stale = np.linalg.norm(b), b, 0
    while stale < PATIENCE and least > 0.5:
        slope = (weight * left)[patterns].sum(axis=1) / np.sqrt((weight[patterns] ** 2).sum(axis=1))
        slope[active] = 0
        order = np.argpartition(-slope, min(len(slope) - 1, 40 * STEP))[:40 * STEP]
        used, fresh = {0}, []
        for j in order[np.argsort(-slope[order], kind="stable")]:
            own = set(patterns[j].tolist()) - {0}
            if slope[j] <= 1e-3 or len(fresh) == STEP:
                break
            if not own & used:
                used |= own
                fresh.append(j)
        if not fresh:
            break
        active = np.concatenate([active, np.array(fresh, np.int64)])
        while len(active):
            a = np.zeros((len(b), len(active)))
            np.add.at(a, (patterns[active], np.arange(len(active))[:, None]), 1.0)
            a *= weight[:, None]
            gram = a.T @ a
            gram[np.diag_indices_from(gram)] += 1e-9
            z = np.linalg.solve(gram, a.T @ b)
            if (z > 0).all():
                break
            active = active[z > 0]
        left = b - a @ z if len(active) else b
        now = np.linalg.norm(left)
        stale = 0 if now < 0.98 * least else stale + 1
        if now < least:
            least = now
            best = np.zeros(len(patterns))
            best[active] = z
    return best


def best_fit(counts: dict[int, int], capacity: int, begun=()) -> list[tuple[dict[int, int], int]]:
    """Packs ``counts`` of lengths: (pattern, repeats), a pattern being
    {length: number}.  Longest first, each into the fullest sequence with room,
    those of ``begun`` included; sequences that look alike are one entry."""
    room: dict[int, list[tuple[dict[int, int], int]]] = {}
    for pattern, repeats in begun:
        room.setdefault(capacity - sum(n * c for n, c in pattern.items()), []).append((pattern, repeats))
    for length in sorted(counts, reverse=True):
        n = counts[length]
        while n:
            fits = [r for r in room if r >= length]
            if not fits:
                each = capacity // length
                room.setdefault(capacity, []).append(({}, -(-n // each)))
                continue
            space = min(fits)
            pattern, repeats = room[space].pop()
            if not room[space]:
                del room[space]
            each = min(space // length, n)
            filled = min(repeats, n // each)
            for some, number in ((filled, each), (repeats - filled, 0)):
                if some:
                    room.setdefault(space - number * length, []).append(
                        (pattern | {length: pattern.get(length, 0) + number} if number else pattern, some))
            n -= filled * each
            if not filled:
                raise AssertionError("no sequence was filled")
    return [entry for entries in room.values() for entry in entries if entry[0]]


def plan(counts: dict[int, int], capacity: int = CAPACITY) -> list[tuple[dict[int, int], int]]:
    """(pattern, repeats) that pack all ``counts`` of lengths 1 to capacity:
    of the fit, each of ``SHARES`` is tried, and the fewest sequences win."""
    counts = {n: c for n, c in counts.items() if c}
    full = [({capacity: 1}, counts.pop(capacity))] if capacity in counts else []
    patterns = exact_patterns(np.array(sorted(counts), np.int64), capacity)
    if not len(patterns):
        return full + best_fit(counts, capacity)
    dense = np.zeros(capacity + 1, np.int64)
    dense[list(counts)] = list(counts.values())
    x = fit_repeats(patterns, dense)
    tried = [packed(patterns, share * x, dense.copy(), capacity) for share in SHARES]
    return full + min(tried, key=lambda made: sum(repeats for _, repeats in made))


def packed(patterns: np.ndarray, x: np.ndarray, left: np.ndarray, capacity: int) -> list[tuple[dict[int, int], int]]:
    """``x`` rounded to repeats of ``patterns``, and the rest of the counts
    ``left`` best-fit around them."""
    out = []
    some = np.flatnonzero(x > 1e-6)
    for up in (False, True):  # rounded down; then once more where all its lengths are left
        for j in some[np.argsort(-x[some] % 1, kind="stable")]:
            lengths, number = np.unique(patterns[j][patterns[j] > 0], return_counts=True)
            want = 1 if up else int(x[j] + 1e-6)
            while want and len(lengths):
                have = left[lengths] // number
                repeats = min(want, int(have.min()))
                if repeats:
                    left[lengths] -= repeats * number
                    out.append((dict(zip(lengths.tolist(), number.tolist())), repeats))
                    want -= repeats
                if up:
                    break
                # Without the lengths that are used up the other sequences keep room.
                lengths, number = lengths[have > repeats], number[have > repeats]
    return best_fit({n: int(left[n]) for n in np.flatnonzero(left)}, capacity, out)


def places(made: list[tuple[dict[int, int], int]]) -> dict[str, np.ndarray]:
    """The plan as intervals of numbers per length: interval ``k`` holds the
    numbers from ``lo[k]`` of length ``length[k]``, ``each[k]`` of them in a
    sequence from ``sequence[k]`` on, at ``offset[k]`` and behind each other."""
    rows, number, sequence = [], {}, 0
    for pattern, repeats in made:
        offset = 0
        for length, each in sorted(pattern.items(), reverse=True):
            rows.append((length, number.get(length, 0), each, sequence, offset))
            number[length] = number.get(length, 0) + each * repeats
            offset += length * each
        sequence += repeats
    table = np.array(sorted(rows), np.int64).reshape(-1, 5).T
    return dict(zip(("length", "lo", "each", "sequence", "offset"), table))


# Pieces and their places -----------------------------------------------------

PIECES = "doc_id {id}, piece int, start long, length long, ids_crc32 long, ids array<int>"


def token_pieces(docs: DataFrame, vocabulary: str, end_id: int = 2, capacity: int = CAPACITY, id_col: str = "doc_id",
                 text_col: str = "text", with_ids: bool = True) -> DataFrame:
    """The pieces of all documents: doc_id, piece, start, length, ids_crc32 (of
    the ids as little-endian unsigned 32-bit numbers) and ids (null without
    ``with_ids``)."""
    spark = docs.sparkSession
    with_code(spark)
    with open(vocabulary, encoding="utf-8") as f:
        shared = spark.sparkContext.broadcast(f.read())  # one vocabulary file, a few MB

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = encoder(shared.value)
        for whole in batches:
            for batch in slices(whole, "text"):
                bounds, ids = coder.encode(batch.column("text"))
                owner, piece, start, length, crc, lists = [], [], [], [], [], []
                for n in range(batch.num_rows):
                    own = np.append(ids[bounds[n]:bounds[n + 1]], end_id).astype("<u4")
                    at = len(own) % capacity or capacity
                    edges = [0, *range(at, len(own) + 1, capacity)] if len(own) > capacity else [0, len(own)]
                    for k, (a, b) in enumerate(zip(edges, edges[1:])):
                        owner.append(n)
                        piece.append(k)
                        start.append(a)
                        length.append(b - a)
                        crc.append(zlib.crc32(own[a:b].tobytes()))
                        lists.append(own[a:b].astype(np.int32) if with_ids else None)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id").take(pa.array(owner, pa.int64())), pa.array(piece, pa.int32()),
                     *[pa.array(c, pa.int64()) for c in (start, length, crc)], pa.array(lists, pa.list_(pa.int32()))],
                    ["doc_id", "piece", "start", "length", "ids_crc32", "ids"])

    texts = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    return texts.mapInArrow(run, PIECES.format(id=texts.schema["doc_id"].dataType.simpleString()))


def pack(pieces: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """``pieces`` (any rows with a ``length`` of 1 to ``capacity``) with
    sequence_id and offset."""
    spark = pieces.sparkSession
    with_code(spark)
    rows = stored(pieces.withColumn("__row", F.monotonically_increasing_id()), "pack-pieces")
    block = F.shiftright("__row", BLOCK_BITS)
    blocks = stored(rows.groupBy("length", block.alias("__block")).agg(F.count(F.lit(1)).alias("__n")), "pack-blocks")
    found = blocks.groupBy("length").agg(F.sum("__n").alias("n")).collect()  # at most ``capacity`` rows
    if any(r["length"] is None or not 1 <= r["length"] <= capacity for r in found):
        raise ValueError(f"a length is not in 1 to {capacity}")
    shared = spark.sparkContext.broadcast(places(plan({r["length"]: r.n for r in found}, capacity)))
    before = F.sum("__n").over(Window.partitionBy("length").orderBy("__block").rowsBetween(
        Window.unboundedPreceding, 0)) - F.col("__n")
    nth = F.row_number().over(Window.partitionBy("length", "__block").orderBy("__row")) - 1
    numbered = (rows.withColumn("__block", block).withColumn("__nth", nth)
                    .join(blocks.withColumn("__before", before).drop("__n"), ["length", "__block"])
                    .select(*pieces.columns, (F.col("__before") + F.col("__nth")).alias("sequence_id")))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = shared.value
        keys = table["length"] << 40 | table["lo"]
        for batch in batches:
            length = batch.column("length").to_numpy().astype(np.int64)
            number = batch.column("sequence_id").to_numpy()
            k = np.searchsorted(keys, length << 40 | number, side="right") - 1
            nth, each = number - table["lo"][k], table["each"][k]
            columns = dict(zip(batch.schema.names, batch.columns))
            columns["sequence_id"] = pa.array(table["sequence"][k] + nth // each)
            columns["offset"] = pa.array(table["offset"][k] + nth % each * length)
            yield pa.RecordBatch.from_pydict(columns)

    return numbered.mapInArrow(run, numbered.withColumn("offset", F.lit(0).cast("long")).schema)


def packed_sequences(docs: DataFrame, vocabulary: str, end_id: int = 2, capacity: int = CAPACITY,
                     id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The sequences themselves: sequence_id, ids and the pieces in them
    (offset, doc_id, piece).  A group holds ``capacity`` ids at most."""
    placed = pack(token_pieces(docs, vocabulary, end_id, capacity, id_col, text_col), capacity)
    parts = F.array_sort(F.collect_list(F.struct("offset", "doc_id", "piece", "ids")))
    return placed.groupBy("sequence_id").agg(parts.alias("p")).select(
        "sequence_id", F.flatten(F.col("p.ids")).alias("ids"),
        F.transform("p", lambda p: F.struct(p["offset"].alias("offset"), p["doc_id"].alias("doc_id"),
                                            p["piece"].alias("piece"))).alias("pieces"))


def op13_pattern_packing(spark, sf_dir: str) -> DataFrame:
    """All documents packed into sequences of 1,024 tokens."""
    import public_tokenizers

    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    pieces = token_pieces(docs, public_tokenizers.path("byte_bpe_50k.json"), with_ids=False)
    return pack(pieces.drop("ids"))
