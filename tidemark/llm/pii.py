"""Surrogates for personal data.

Detected entities (e-mail addresses, phone numbers, IPv4 addresses, card
numbers, US social-security numbers, IBANs, personal names) are replaced by
surrogates of the same type, drawn with a secret key: digits stay digits and
separators stay where they are, country codes, card issuers and top-level
domains are kept, numbers that carry a valid check digit get one, names keep
gender, script and case.

Each distinct entity, in a normal form (digits of a number, lower-case
address, one name part), is a unit with one surrogate everywhere, so mentions
that corefer still do, whatever their format.  Units propose a surrogate by
keyed hash of type, normal form and attempt; a proposal that equals another
unit's surrogate or any unit of the input is refused and proposed again, until
all are distinct.  The checks are joins on (type, surrogate) over the distinct
units; texts that hold entities meet their units by the text's digest, all
other texts pass without a shuffle.

Defined results: null text stays null with no entities; texts are read whole;
spans do not overlap, the first and longest wins in the order of ``KINDS``;
repeated rows are replaced alike; rows without entities come back unchanged;
the empty table gives no rows; a clash with the output column is refused.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.arrow import extended, slices, with_code
from tidemark.llm.components import stored

#: Titles and given names by gender, and cues of names.
MALE = ("Mr", "Herr", "Señor", "Sr", "Monsieur", "Mister", "Signor", "г-н", "господин")
FEMALE = ("Mrs", "Ms", "Miss", "Frau", "Señora", "Sra", "Madame", "Mme", "Signora", "г-жа", "госпожа")
NEUTRAL = ("Dr", "Prof", "Doctor", "Professor", "доктор")
HIM = ("James", "John", "Robert", "Michael", "William", "David", "Richard", "Joseph", "Thomas", "Charles", "Daniel",
       "Matthew", "Mark", "Paul", "Steven", "Andrew", "George", "Kevin", "Brian", "Edward", "Peter", "Hans", "Klaus",
       "Jürgen", "Wolfgang", "Stefan", "Jean", "Pierre", "Jacques", "François", "Luis", "Carlos", "José", "Juan", "Pedro",
       "Miguel", "Иван", "Сергей", "Алексей", "Дмитрий")
HER = ("Mary", "Patricia", "Jennifer", "Linda", "Elizabeth", "Barbara", "Susan", "Jessica", "Sarah", "Karen", "Nancy",
       "Lisa", "Margaret", "Sandra", "Emily", "Anna", "Laura", "Julia", "Emma", "Alice", "Ursula", "Monika", "Sabine",
       "Petra", "Marie", "Sophie", "Camille", "Chloé", "María", "Carmen", "Lucía", "Isabel", "Elena", "Ольга", "Мария",
       "Наталья")
KINDS = ("email", "iban", "ssn", "card", "phone", "ip", "name")

_CAP = r"[A-ZÀ-ÖØ-ÞА-ЯЁ][a-zà-öø-ÿа-яё]+(?:-[A-ZÀ-ÖØ-ÞА-ЯЁ][a-zà-öø-ÿа-яё]+)?"
_TITLE = "|".join(re.escape(t) for t in sorted((*MALE, *FEMALE, *NEUTRAL), key=len, reverse=True))
_KNOWN = "|".join(sorted((*HIM, *HER), key=len, reverse=True))
PATTERNS = {
    "email": re.compile(r"(?<![\w.+-])[A-Za-z0-9_%+-]+(?:\.[A-Za-z0-9_%+-]+)*@(?:[A-Za-z0-9-]+\.)+[A-Za-z]{2,}(?![\w-])"),
    "iban": re.compile(r"(?<!\w)[A-Z]{2}\d{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?(?!\w)"),
    "ssn": re.compile(r"(?<![\w.-])\d{3}-\d{2}-\d{4}(?![\w-])"),
    "card": re.compile(r"(?<![\w.+-])(?:\d{13,19}|\d{4}(?:[ -]\d{4}){3})(?!\w|[.-]\d)"),
    "phone": re.compile(r"(?<![\w.+-])(?:\+\d{1,3}[ .-]?(?:\(\d{1,4}\)[ .-]?)?\d{2,4}(?:[ .-]?\d{2,4}){1,4}"
                        r"|(?:1[ .-])?(?:\(\d{3}\)[ .-]?\d{3}[ .-]?\d{4}|\d{3}[.-]\d{3}[.-]\d{4}))(?!\w|[.-]\d)"),
    "ip": re.compile(r"(?<![\w.-])(?:(?:25[0-5]|2[0-4]\d|1?\d?\d)\.){3}(?:25[0-5]|2[0-4]\d|1?\d?\d)(?!\w|\.\d|-)"),
    "name": re.compile(rf"(?<!\w)(?:(?P<title>{_TITLE})\.?[ ]+(?P<a>{_CAP})(?:[ ]+(?P<b>{_CAP}))?"
                       rf"|(?P<given>{_KNOWN})[ ]+(?P<last>{_CAP})|(?:[Mm]y name is|I am called)[ ]+(?P<x>{_CAP})[ ]+(?P<y>{_CAP}))"
                       r"(?!\w)"),
}
#: A text without any of these has no entity.
HINT = r"@|\d\d|\d[.-]\d|[A-Z]{2}\d\d|" + "|".join((_TITLE, _KNOWN, "y name is|I am called"))


def _script(word: str) -> str:
    return "cyrillic" if re.match("[А-яЁё]", word) else "latin"


def detect(text: str) -> list[dict]:
    """Entities of one text in order: start, end, kind of unit, normal form,
    gender (of given names). A name gives one unit for each part."""
    found: list[dict] = []
    taken: list[tuple[int, int]] = []

    def add(start, end, kind, norm, gender=None):
        found.append({"start": start, "end": end, "kind": kind, "norm": norm, "gender": gender})

    for kind, pattern in PATTERNS.items():
        fresh = []
        for m in pattern.finditer(text):
            s, e = m.span()
            if any(a < e and s < b for a, b in taken):
                continue
            raw = m.group()
            if kind == "name":
                title = m["title"]
                by_title = "m" if title in MALE else "f" if title in FEMALE else None
                parts = [p for p in ("a", "b", "given", "last", "x", "y") if m[p]]
                if title and parts == ["a"] and m["a"] not in HIM + HER:
                    roles = ["surname"]
                else:
                    roles = ["given", "surname"][:len(parts)]
                for p, role in zip(parts, roles):
                    known = "m" if m[p] in HIM else "f" if m[p] in HER else by_title
                    add(*m.span(p), f"{role}:{_script(m[p])}", m[p].lower(), known if role == "given" else None)
            elif kind == "phone":
                digits = re.sub(r"\D", "", raw)
                if not 8 <= len(digits) <= 15:
                    continue
                add(s, e, "phone", digits)
            elif kind in ("email", "ip"):
                add(s, e, kind, raw.lower())
            else:
                add(s, e, kind, re.sub(r"[ -]", "", raw))
            fresh.append((s, e))
        taken += fresh
    return sorted(found, key=lambda x: x["start"])


def luhn(digits: str) -> bool:
    total = sum(d if i % 2 == 0 else d * 2 - 9 * (d > 4) for i, d in enumerate(map(int, reversed(digits))))
    return total % 10 == 0


def _mod97(iban: str) -> int:
    return int("".join(str(int(c, 36)) for c in iban[4:] + iban[:4])) % 97


class _Draw:
    """Numbers drawn from a keyed hash."""

    def __init__(self, key: bytes, *what: str):
        self.key, self.what, self.n, self.pool = key, "\x1f".join(what).encode(), 0, 0
        self.left = 0

    def below(self, n: int) -> int:
        if self.left < 8:
            h = hashlib.blake2b(self.what + self.n.to_bytes(4, "big"), key=self.key, digest_size=64)
            self.pool, self.left, self.n = int.from_bytes(h.digest(), "big"), 60, self.n + 1
        self.left -= 8
        self.pool, got = divmod(self.pool, 1 << 64)
        return got % n


_SOUNDS = {"latin": (("b", "br", "d", "f", "g", "h", "k", "l", "m", "n", "p", "r", "s", "st", "t", "v", "w", "z"),
                     ("a", "e", "i", "o", "u"), {"m": ("n", "rt", "ld", "s"), "f": ("a", "ina", "elle", "ia"),
                                                  None: ("y", "in", "el"), "last": ("son", "berg", "mann", "ley", "ard")}),
           "cyrillic": (("б", "в", "г", "д", "к", "л", "м", "н", "п", "р", "с", "т"), ("а", "е", "и", "о", "у"),
                        {"m": ("н", "р", "слав"), "f": ("на", "ра", "ла"), None: ("й", "ль"),
                         "last": ("ов", "ин", "енко", "ский")})}


def propose(key: bytes, kind: str, norm: str, gender: str | None, attempt: int) -> str:
    """A surrogate of the normal form ``norm``, in normal form."""
    draw = _Draw(key, kind, norm, str(attempt))
    digit = lambda c: str(draw.below(10)) if c.isdigit() else c
    if kind == "email":
        wide = "abcdefghijklmnopqrstuvwxyz"
        one = lambda c: wide[draw.below(26)] if c.isalpha() else digit(c)
        body, _, top = norm.rpartition(".")
        local, _, domain = body.partition("@")
        local += wide[draw.below(26)] * (attempt // 8)  # short addresses run out of room
        return "".join(map(one, local)) + "@" + "".join(map(one, domain)) + "." + top
    if kind == "ip":
        lows = {1: (1, 9), 2: (10, 99), 3: (100, 255)} if attempt < 8 else {n: (1, 254) for n in (1, 2, 3)}
        return ".".join(str(a + draw.below(b - a + 1)) for a, b in (lows[len(o)] for o in norm.split(".")))
    if kind == "phone":
        keep = max(0, len(norm) - 10)  # country code
        return norm[:keep] + str(2 + draw.below(8)) + "".join(map(digit, norm[keep + 1:]))
    if kind == "card":
        body = norm[0] + "".join(map(digit, norm[1:-1]))
        last = [d for d in "0123456789" if luhn(body + d)][0]
        return body + (last if luhn(norm) else [d for d in "0123456789" if d != last][draw.below(9)])
    if kind == "ssn":
        return f"{1 + draw.below(899):03d}{1 + draw.below(99):02d}{1 + draw.below(9999):04d}"
    if kind == "iban":
        wide = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
        body = "".join(digit(c) if c.isdigit() else wide[draw.below(26)] for c in norm[4:])
        check = 98 - _mod97(norm[:2] + "00" + body)
        return norm[:2] + (f"{check:02d}" if _mod97(norm) == 1 else f"{(check + 1 + draw.below(50)) % 97:02d}") + body
    role, _, script = kind.partition(":")
    onset, vowel, ends = _SOUNDS[script]
    body = "".join(onset[draw.below(len(onset))] + vowel[draw.below(len(vowel))] for _ in range(2 + attempt // 4))
    tail = ends["last" if role == "surname" else gender]
    return body + tail[draw.below(len(tail))]


def dressed(raw: str, kind: str, surrogate: str) -> str:
    """The surrogate in the format of the mention ``raw``."""
    if kind in ("phone", "card", "ssn", "iban"):
        new = iter(surrogate)
        return "".join(next(new) if c.isalnum() else c for c in raw)
    if kind == "email":
        return surrogate.upper() if raw.isupper() else surrogate
    if kind == "ip":
        return surrogate
    return surrogate.upper() if raw.isupper() else "-".join(p.capitalize() for p in surrogate.split("-"))


def _maybe(text: pa.Array) -> list[bool]:
    return pc.fill_null(pc.match_substring_regex(text, HINT), False).to_pylist()


def _units(docs: DataFrame, text_col: str) -> DataFrame:
    """(digest, kind, norm, gender) of every text that has entities."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for b in slices(whole, text_col):
                text, rows = b.column(text_col), []
                for i, hit in enumerate(_maybe(text)):
                    if hit:
                        raw = text[i].as_py()
                        units = {(x["kind"], x["norm"], x["gender"]) for x in detect(raw)}
                        if units:
                            digest = hashlib.sha256(raw.encode()).hexdigest()
                            rows += [(digest, *u) for u in sorted(units, key=str)]
                columns = list(zip(*rows)) if rows else [[]] * 4
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.string()) for c in columns],
                                                 ["digest", "kind", "norm", "gender"])

    return docs.select(text_col).mapInArrow(run, "digest string, kind string, norm string, gender string").distinct()


def surrogates(units: DataFrame, key: bytes) -> DataFrame:
    """(kind, norm, surrogate) of distinct units (kind, norm, gender), all
    surrogates of a kind distinct from each other and from all units."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            made = [propose(key, **x) for x in b.select(["kind", "norm", "gender", "attempt"]).to_pylist()]
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(made, pa.string())], [*b.schema.names, "surrogate"])

    with_code(units.sparkSession)
    accepted, pending = None, units.withColumn("attempt", F.lit(0))
    schema = "kind string, norm string, gender string, attempt int, surrogate string"
    while True:
        tried = stored(pending.mapInArrow(run, schema), "pii-tried")
        first = tried.groupBy("kind", "surrogate").agg(F.min("norm").alias("norm"))
        first = first.join(units.select("kind", F.col("norm").alias("surrogate")), ["kind", "surrogate"], "left_anti")
        if accepted is not None:
            first = first.join(accepted.select("kind", "surrogate"), ["kind", "surrogate"], "left_anti")
        won = stored(first.select("kind", "norm", "surrogate"), "pii-won")
        accepted = won if accepted is None else accepted.unionByName(won)
        pending = stored(tried.drop("surrogate").join(won.select("kind", "norm"), ["kind", "norm"], "left_anti")
                              .withColumn("attempt", F.col("attempt") + 1), "pii-pending")
        if pending.isEmpty():
            return accepted


def replace_pii(docs: DataFrame, text_col: str, key: bytes, out: str = "n_replaced") -> DataFrame:
    """``docs`` with every entity in ``text_col`` replaced, and their number
    in ``out`` (long)."""
    with_code(docs.sparkSession)
    schema = extended(docs, out, "long")
    found = stored(_units(docs, text_col), "pii-found")
    # One gender for a name everywhere: a mention without a cue follows those that have one.
    units = stored(found.groupBy("kind", "norm").agg(F.min("gender").alias("gender")), "pii-units")
    given = surrogates(units, key)
    of_text = (found.select("digest", "kind", "norm").distinct().join(given, ["kind", "norm"]).groupBy("digest")
                    .agg(F.collect_list(F.struct("kind", "norm", "surrogate")).alias("__given")))
    marked = extended(docs, "__has", "boolean")

    def mark(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for b in slices(whole, text_col):
                text = b.column(text_col)
                has = [bool(hit and detect(text[i].as_py())) for i, hit in enumerate(_maybe(text))]
                yield pa.RecordBatch.from_arrays([*b.columns, pa.array(has, pa.bool_())], [*b.schema.names, "__has"])

    def swap(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for b in slices(whole, text_col):
                texts, counts = [], []
                for raw, units in zip(b.column(text_col).to_pylist(), b.column("__given").to_pylist()):
                    new, at, known = [], 0, {(u["kind"], u["norm"]): u["surrogate"] for u in units}
                    mentions = detect(raw)
                    for m in mentions:
                        new += [raw[at:m["start"]],
                                dressed(raw[m["start"]:m["end"]], m["kind"], known[m["kind"], m["norm"]])]
                        at = m["end"]
                    texts.append("".join([*new, raw[at:]]))
                    counts.append(len(mentions))
                made = {text_col: pa.array(texts, pa.string()), out: pa.array(counts, pa.int64())}
                yield pa.RecordBatch.from_arrays([made[c] if c in made else b.column(c) for c in schema.names], schema.names)

    rows = docs.mapInArrow(mark, marked)
    plain = rows.where("NOT __has").drop("__has").withColumn(out, F.lit(0).cast("long"))
    held = rows.where("__has").drop("__has").withColumn("__digest", F.sha2(F.col(text_col), 256))
    joined = held.join(of_text.withColumnRenamed("digest", "__digest"), "__digest").drop("__digest")
    return joined.mapInArrow(swap, schema).unionByName(plain)


#: The key of the registered query; a production run passes its own secret.
QUERY_KEY = b"registered query"


def op1_pii_surrogates(spark, sf_dir: str) -> DataFrame:
    """Every document with its personal data replaced."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return replace_pii(docs, "text", QUERY_KEY)
