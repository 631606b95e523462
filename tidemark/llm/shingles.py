"""Word shingles of whole texts as 64-bit hashes, on Arrow arrays."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash

WIDTH = 5
_STEP = np.uint64(0x9E3779B97F4A7C15)


def spread(h: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        h = (h ^ (h >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return h ^ (h >> np.uint64(32))


def shingle_sets(texts: pa.Array, width: int = WIDTH) -> list[np.ndarray]:
    """For each text the sorted distinct hashes of its ``width``-word
    shingles; a text of fewer words has one shingle of all of them, a text
    without words none.  Words are what ASCII white space separates."""
    lists = pc.ascii_split_whitespace(pc.fill_null(texts, ""))
    coded = pc.dictionary_encode(lists.flatten())
    hashes = np.array([xxhash.xxh64_intdigest(w) for w in coded.dictionary.to_pylist()], np.uint64)
    codes = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
    doc = np.repeat(np.arange(len(texts)), np.diff(lists.offsets.to_numpy()))
    full = np.array([bool(w) for w in coded.dictionary.to_pylist()], bool)
    use = full[codes] if len(codes) else np.zeros(0, bool)
    words = hashes[codes[use]] if len(codes) else np.zeros(0, np.uint64)
    ends = np.cumsum(np.bincount(doc[use], minlength=len(texts)))
    rolled = np.zeros(len(words), np.uint64)
    with np.errstate(over="ignore"):
        for j in range(min(width, len(words))):  # the shingle that starts at each word
            rolled[:len(words) - j] = rolled[:len(words) - j] * _STEP + words[j:]
    rolled = spread(rolled)
    out, start = [], 0
    for end in ends.tolist():
        n = end - start
        if n >= width:
            out.append(np.unique(rolled[start:end - width + 1]))
        elif n:
            out.append(np.array([xxhash.xxh64_intdigest(words[start:end].tobytes(), seed=n)], np.uint64))
        else:
            out.append(np.empty(0, np.uint64))
        start = end
    return out


_SEEDS = np.random.default_rng(20240229)
_XOR = _SEEDS.integers(0, 1 << 63, 256, dtype=np.uint64)
_MUL = _SEEDS.integers(0, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def signatures(sets: list[np.ndarray], size: int) -> np.ndarray:
    """Min-hash values (rows: sets, columns: hash functions); 0 for empty sets."""
    out = np.zeros((len(sets), size), np.uint32)
    some = [i for i, s in enumerate(sets) if len(s)]
    if some:
        flat = np.concatenate([sets[i] for i in some])
        starts = np.cumsum([0, *(len(sets[i]) for i in some[:-1])])
        with np.errstate(over="ignore"):
            for k in range(size):
                out[some, k] = np.minimum.reduceat(((flat ^ _XOR[k]) * _MUL[k]) >> np.uint64(32), starts).astype(np.uint32)
    return out
