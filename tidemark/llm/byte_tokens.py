"""Token ids of a byte-level BPE vocabulary for whole Arrow columns of texts.

The ids are those of the ``tokenizers`` library.  Texts of common Latin, Greek
and Cyrillic letters and punctuation are cut into pre-tokens by array
operations over a whole column at once (the vocabulary's splitting rule, read
off the classes of neighbouring characters).  A worker keeps the ids of the
pre-tokens it has met in a hash table over their bytes; those it meets for the
first time are merged together, a pair of each in every step, lowest rank
first.  Any other text, and any pre-token of over 32 bytes, goes to the library.
"""

from __future__ import annotations

import json
import os
import re
import unicodedata
from functools import lru_cache

import numpy as np
import pyarrow as pa

LETTER, NUMBER, BLANK, SPACE, OTHER, FOREIGN = range(6)
#: Code points whose class the tables here give; texts with others go to the
#: library.  Fixed values: block bounds of Unicode.
KNOWN = [(0, 0x530), (0x2010, 0x2028), (0x2030, 0x205F), (0x20AC, 0x20AD)]
#: Fixed value: what may follow an apostrophe that starts a pre-token.
ENDINGS = (b"s", b"t", b"re", b"ve", b"m", b"ll", b"d")
#: Pre-tokens of up to so many bytes are kept as words of 8 bytes.
WIDE = 32
#: Pre-tokens that a Python worker remembers; beyond it the memory starts anew,
#: so it changes time, never results.
MEMO = 1 << 19
#: Bytes of text that are encoded at once.
LONG = 1 << 20
#: A place inside of a text where two pre-tokens meet.
BETWEEN = re.compile(rb"[a-z] [a-z]")
NEVER = np.int32(2**31 - 1)
_U = np.uint64


@lru_cache(maxsize=1)
def classes() -> np.ndarray:
    """The class of each code point below U+10000."""
    out = np.full(1 << 16, FOREIGN, np.uint8)
    for low, high in KNOWN:
        for cp in range(low, high):
            kind = unicodedata.category(chr(cp))
            if cp in (0x85, 0xA0) or 9 <= cp <= 13:
                out[cp] = SPACE
            elif kind != "Cn":
                out[cp] = BLANK if cp == 32 else {"L": LETTER, "N": NUMBER}.get(kind[0], OTHER)
    return out


def text_buffers(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bounds, bytes) of a string column, null as empty."""
    texts = texts.cast(pa.large_binary()).fill_null(b"")
    n = len(texts)
    _, ends, data = texts.buffers()
    bounds = np.frombuffer(ends, np.int64)[texts.offset:texts.offset + n + 1]
    raw = np.frombuffer(data, np.uint8)[bounds[0]:bounds[-1]] if data is not None and n else np.empty(0, np.uint8)
    return bounds - bounds[0], raw


def _pre_tokens(bounds: np.ndarray, raw: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(starts, foreign): the byte places where pre-tokens start, text by text
    (none for a foreign text), and which texts are foreign."""
    lead = np.flatnonzero((raw & 0xC0) != 0x80)
    first = raw[lead].astype(np.int32)
    if len(lead) < len(raw):
        padded = np.concatenate([raw, np.zeros(3, np.uint8)])
        b1, b2 = padded[lead + 1].astype(np.int32) & 63, padded[lead + 2].astype(np.int32) & 63
        two, three = (first & 0xE0) == 0xC0, (first & 0xF0) == 0xE0
        code = np.where(two, (first & 31) << 6 | b1, np.where(three, (first & 15) << 12 | b1 << 6 | b2,
                                                              np.where(first < 128, first, 0xFFFF)))
        del two, three, b1, b2, padded
    else:
        code = first
    kind = classes()[code]
    del code, first
    owner = np.searchsorted(lead, bounds)  # the first character of each text
    foreign = np.zeros(len(bounds) - 1, bool)
    strange = np.flatnonzero(kind == FOREIGN)
    foreign[np.searchsorted(owner, strange, side="right") - 1] = True
    n = len(kind)
    if not n:
        return np.empty(0, np.int64), foreign
    begins = np.zeros(n + 1, bool)
    begins[owner] = True
    begins = begins[:n]
    white = (kind == BLANK) | (kind == SPACE)
    group = np.where(white, SPACE, kind)
    start = np.ones(n, bool)
    start[1:] = group[1:] != group[:-1]
    # The last white space before another character leaves its run ...
    last = np.zeros(n, bool)
    last[:-1] = white[:-1] & ~white[1:] & ~begins[1:]
    start |= last
    # ... and a blank joins what follows.
    start[1:] &= ~(last[:-1] & (kind[:-1] == BLANK))
    start |= begins
    for at in np.flatnonzero((raw[lead] == 39) & start):
        place = lead[at]
        end = bounds[np.searchsorted(bounds, place, side="right")]
        after = raw[place + 1:min(place + 3, end)].tobytes()
        for ending in ENDINGS:
            if after.startswith(ending):
                start[at + 1:at + 1 + len(ending)] = False
                if at + 1 + len(ending) < n:
                    start[at + 1 + len(ending)] = True
                break
    places = lead[start]
    if foreign.any():
        places = places[~foreign[np.searchsorted(bounds, places, side="right") - 1]]
    return places, foreign


def _mixed(*parts: np.ndarray) -> np.ndarray:
    """64 bits of several integer columns (multiply-xorshift)."""
    h = np.zeros(len(parts[0]), _U)
    with np.errstate(over="ignore"):
        for p in parts:
            h = (h ^ p.astype(_U)) * _U(0xFF51AFD7ED558CCD)
            h ^= h >> _U(32)
    return h


class Table:
    """Rows of integers -> the place where they were added (-1: not yet),
    by open addressing; rows are compared whole."""

    def __init__(self, width: int, room: int):
        self.room, self.n = room, 0
        self.mask = _U((1 << (4 * room - 1).bit_length()) - 1)
        self.slots = np.full(int(self.mask) + 1, -1, np.int32)
        self.rows = np.empty((room, width), _U)

    def _start(self, rows: np.ndarray) -> np.ndarray:
        return (_mixed(*rows.T) & self.mask).astype(np.int64)

    def _unlike(self, entry: np.ndarray, rows: np.ndarray) -> np.ndarray:
        there = self.rows[entry]
        differ = there[:, 0] != rows[:, 0]
        for k in range(1, rows.shape[1]):
            differ |= there[:, k] != rows[:, k]
        return differ & (entry >= 0)

    def find(self, rows: np.ndarray) -> np.ndarray:
        slot = self._start(rows)
        found = self.slots[slot]
        left = np.flatnonzero(self._unlike(found, rows))
        slot = slot[left]
        while len(left):
            slot = (slot + 1) & int(self.mask)
            entry = self.slots[slot]
            found[left] = entry
            unlike = self._unlike(entry, rows[left])
            left, slot = left[unlike], slot[unlike]
        return found

    def add(self, rows: np.ndarray) -> None:
        """Adds rows that differ from each other and from those there."""
        places = np.arange(self.n, self.n + len(rows), dtype=np.int32)
        self.rows[places] = rows
        self.n += len(rows)
        slot = self._start(rows)
        while len(places):
            free = self.slots[slot] < 0
            self.slots[slot[free]] = places[free]
            left = self.slots[slot] != places
            places, slot = places[left], (slot[left] + 1) & int(self.mask)


class Merges:
    """The merge rules of a vocabulary, for many pre-tokens at once."""

    def __init__(self, model: dict):
        ids = model["vocab"]
        shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
        hidden = [b for b in range(256) if b not in set(shown)]
        chars = {b: chr(b) for b in shown} | {b: chr(256 + i) for i, b in enumerate(hidden)}
        self.byte = np.array([ids[chars[b]] for b in range(256)], np.int32)
        pairs = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
        self.whole = np.array([ids[a + b] for a, b in pairs], np.int32)
        self.pairs = Table(1, len(pairs))
        self.pairs.add(self._key(*np.array([(ids[a], ids[b]) for a, b in pairs], np.int64).T))

    @staticmethod
    def _key(a: np.ndarray, b: np.ndarray) -> np.ndarray:
        return (a.astype(_U) << _U(32) | b.astype(_U))[:, None]

    def rank(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """The rank of each pair; pairs with a gap (-1) have none."""
        out = np.full(a.shape, NEVER)
        there = (a >= 0) & (b >= 0)
        got = self.pairs.find(self._key(a[there], b[there]))
        out[there] = np.where(got < 0, NEVER, got)
        return out

    def ids(self, symbols: np.ndarray) -> np.ndarray:
        """Rows of byte symbols, filled up with -1 -> rows of ids, likewise.
        Each step joins, in every row, the leftmost pair of the lowest rank."""
        out = symbols
        rows, work = np.arange(len(out)), out.copy()
        rank = self.rank(work[:, :-1], work[:, 1:])
        column = np.arange(work.shape[1])
        while len(rows):
            at = rank.argmin(axis=1)
            best = rank[np.arange(len(rows)), at]
            on = best != NEVER
            out[rows[~on]] = work[~on]
            rows, at, best = rows[on], at[on], best[on]
            work, rank = work[on], rank[on]
            each = np.arange(len(rows))
            later = column > at[:, None]
            work = np.where(later, np.pad(work[:, 1:], ((0, 0), (0, 1)), constant_values=-1), work)
            work[each, at] = self.whole[best]
            rank = np.where(later[:, :-1], np.pad(rank[:, 1:], ((0, 0), (0, 1)), constant_values=NEVER), rank)
            before = np.maximum(at - 1, 0)
            rank[each, before] = self.rank(work[each, before], work[each, before + 1])
            after = np.minimum(at, rank.shape[1] - 1)
            rank[each, after] = self.rank(work[each, after], work[each, after + 1])
        return out


class Encoder:
    """Ids of texts under one vocabulary file's text."""

    def __init__(self, text: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        spec = json.loads(text)
        self.library = Tokenizer.from_str(text)
        self.library.no_truncation()
        self.library.no_padding()
        self.marks = [t["content"].encode() for t in spec["added_tokens"]]
        self.merges = Merges(spec["model"])
        self._forget(MEMO)

    def _forget(self, room: int) -> None:
        self.known = Table(WIDE // 8 + 1, room)
        self.first, self.count = np.empty(room, np.int64), np.empty(room, np.int32)
        self.ids, self.used = np.empty(4 * room, np.int32), 0

    def _ids(self, text: str) -> np.ndarray:
        return np.array(self.library.encode(text, add_special_tokens=False).ids, np.int32)

    def _learn(self, rows: np.ndarray) -> None:
        """Keeps the ids of distinct pre-tokens (words of 8 bytes, length)."""
        size = rows[:, -1].astype(np.int64)
        raw = np.ascontiguousarray(rows[:, :-1]).view(np.uint8)
        first, count = np.empty(len(rows), np.int64), np.empty(len(rows), np.int32)
        parts, low = [], 0
        for high in (4, 8, 16, WIDE):
            own = np.flatnonzero((size > low) & (size <= high))
            symbols = self.merges.byte[raw[own, :high]]
            symbols[np.arange(high) >= size[own, None]] = -1
            got = self.merges.ids(symbols)
            count[own] = (got >= 0).sum(axis=1)
            before = self.used + sum(map(len, parts))
            first[own] = before + np.cumsum(count[own]) - count[own]
            parts.append(got[got >= 0])
            low = high
        n, fresh = self.known.n, np.concatenate(parts)
        if self.used + len(fresh) > len(self.ids):
            self.ids = np.concatenate([self.ids[:self.used], np.empty(2 * len(fresh) + self.used, np.int32)])
        self.ids[self.used:self.used + len(fresh)] = fresh
        self.used += len(fresh)
        self.known.add(rows)
        self.first[n:n + len(rows)], self.count[n:n + len(rows)] = first, count

    def _short(self, rows: np.ndarray) -> np.ndarray:
        """The places of pre-tokens in memory; new ones are learnt."""
        while True:
            found = self.known.find(rows)
            new = np.flatnonzero(found < 0)
            if not len(new):
                return found
            # Of different rows with one hash, the others come in the next turn.
            fresh = rows[new][np.unique(_mixed(*rows[new].T), return_index=True)[1]]
            if self.known.n + len(fresh) > self.known.room:
                self._forget(max(MEMO, 2 * len(rows)))
            else:
                self._learn(fresh)

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(bounds, ids): the ids of all texts one after the other.  Works on
        some ``LONG`` bytes at once; longer texts are cut between two words,
        where a pre-token ends in any case."""
        bounds, raw = text_buffers(texts)
        edges, last = [0], [0]
        for end in bounds[1:].tolist():
            while end - edges[-1] > LONG:
                near = BETWEEN.search(raw[edges[-1] + LONG:end])
                if not near:
                    break
                edges.append(edges[-1] + LONG + near.start() + 1)
            edges.append(end)
            last.append(len(edges) - 1)
        edges = np.array(edges, np.int64)
        counts, parts, at = [], [], 0
        while at < len(edges) - 1:
            to = max(at + 1, int(np.searchsorted(edges, edges[at] + LONG, side="right")) - 1)
            count, ids = self._encode(edges[at:to + 1] - edges[at], raw[edges[at]:edges[to]])
            counts.append(count)
            parts.append(ids)
            at = to
        before = np.concatenate([[0], np.cumsum(np.concatenate([np.empty(0, np.int64), *counts]))])
        return before[last], np.concatenate([np.empty(0, np.int32), *parts])

    def _encode(self, bounds: np.ndarray, raw: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(counts, ids) of the texts between bounds."""
        places, foreign = _pre_tokens(bounds, raw)
        whole = raw.tobytes()
        for mark in self.marks:
            at = whole.find(mark)
            while at >= 0:
                foreign[np.searchsorted(bounds, at, side="right") - 1] = True
                at = whole.find(mark, at + 1)
        own = np.searchsorted(bounds, places, side="right") - 1
        if foreign.any():
            places, own = places[~foreign[own]], own[~foreign[own]]
        ends = np.minimum(np.concatenate([places[1:], bounds[-1:]]), bounds[own + 1])
        size = ends - places
        wide = size > WIDE
        rows = np.empty((len(places), WIDE // 8 + 1), _U)
        eight = np.ndarray((len(raw) + WIDE,), "<u8", raw_padded := np.concatenate([raw, np.zeros(WIDE + 8, np.uint8)]),
                           strides=(1,))
        for k in range(WIDE // 8):
            keep = np.clip(size - 8 * k, 0, 8)
            mask = np.array([(1 << 8 * n) - 1 for n in range(9)], _U)[keep]
            rows[:, k] = eight[np.minimum(places + 8 * k, len(raw))] & mask
        rows[:, -1] = size
        del eight, raw_padded
        # Whole texts and wide pre-tokens are encoded by the library, each a piece of its own.
        extra = [whole[a:b] for a, b in zip(places[wide].tolist(), ends[wide].tolist())]
        odd = np.flatnonzero(foreign)
        extra += [whole[bounds[n]:bounds[n + 1]] for n in odd]
        found = np.empty(len(places), np.int64)
        found[~wide] = self._short(rows[~wide])
        known = {t: self._ids(t.decode()) for t in set(extra)}
        more = [known[t] for t in extra]
        table = np.concatenate([self.ids[:self.used], *more])
        sizes = np.array([len(m) for m in more], np.int64)
        starts = self.used + np.cumsum(sizes) - sizes
        n_wide = int(wide.sum())
        first, count = np.empty(len(places) + len(odd), np.int64), np.empty(len(places) + len(odd), np.int64)
        short = np.flatnonzero(~wide)
        first[short], count[short] = self.first[found[short]], self.count[found[short]]
        first[np.flatnonzero(wide)], count[np.flatnonzero(wide)] = starts[:n_wide], sizes[:n_wide]
        first[len(places):], count[len(places):] = starts[n_wide:], sizes[n_wide:]
        if len(odd):
            own = np.concatenate([own, odd])
            order = np.argsort(own, kind="stable")
            first, count, own = first[order], count[order], own[order]
        ends = np.cumsum(count)
        total = int(ends[-1]) if len(ends) else 0
        ids = table[np.repeat(first - ends + count, count) + np.arange(total)]
        per_text = np.bincount(own, weights=count, minlength=len(bounds) - 1).astype(np.int64)
        return per_text, ids


@lru_cache(maxsize=1)
def encoder(text: str) -> Encoder:
    return Encoder(text)
