"""Secret scan against a character-by-character reading of the patterns and
against all segmentations of short values."""

import hashlib
import math
import random
import string

import pytest

from tests.conftest import SF_SMALL
from tidemark.llm import secrets as S

WORDS = ("password", "passwd", "secret", "token", "api_key", "apikey")
VALUE = set(string.ascii_letters + string.digits + "+/_.=-")


def assign_by_hand(text):
    at, out = 0, []
    low = "".join(c.lower() if c in string.ascii_uppercase else c for c in text)
    while at < len(text):
        end = None
        for w in WORDS:
            if low.startswith(w, at):
                for quote in (1, 0):
                    i = at + len(w)
                    if quote:
                        if text[i:i + 1] not in ("'", '"') or not text[i:i + 1]:
                            continue
                        i += 1
                    while text[i:i + 1] == " ":
                        i += 1
                    if text[i:i + 1] not in (":", "=") or not text[i:i + 1]:
                        continue
                    i += 1
                    while text[i:i + 1] == " ":
                        i += 1
                    if text[i:i + 1] in ("'", '"') and text[i:i + 1]:
                        i += 1
                    v = i
                    while v < len(text) and text[v] in VALUE:
                        v += 1
                    if v > i:
                        end = (i, v)
                        break
                if end:
                    break
        if end:
            if end[1] - end[0] >= 12:
                out.append((at, "assign", end[1]))
            at = end[1]
        else:
            at += 1
    return out


def runs_by_hand(text, kind, lead, chars, least):
    at, out = 0, []
    while at < len(text):
        if text.startswith(lead, at):
            e = at + len(lead)
            while e < len(text) and text[e] in chars:
                e += 1
            if e > at + len(lead):
                if e - at >= least:
                    out.append((at, kind, e))
                at = e
                continue
        at += 1
    return out


def test_base_spans_by_hand():
    rng = random.Random(5)
    bits = [*WORDS, "PassWord", "ſecret", "toKen", ":", "=", " ", "  ", '"', "'", "AKIA", "AKIAAKIA", "ABCDEFGH1234567",
            "deadbeef", "0123456789abcdef", "é", "\n", "x", "longvalue-1234/5", "=="]
    for _ in range(4000):
        text = "".join(rng.choice(bits) for _ in range(rng.randint(0, 14)))
        want = assign_by_hand(text)
        want += runs_by_hand(text, "access", "AKIA", set(string.ascii_uppercase + string.digits), 18)
        want += runs_by_hand(text, "hex", "", set("0123456789abcdef"), 16)
        assert sorted(S.base_spans(text)) == sorted(want), text


KNOWN = {"patience": 1, "sun": 2, "flower": 3, "sunflower": 400, "os": 5}


def part_by_hand(value, i, j):
    """The cheapest reading of value[i:j] as one part, from the definitions."""
    typed = value[i:j]
    low, n = typed.lower(), j - i
    plain = "".join({"@": "a", "4": "a", "3": "e", "0": "o", "1": "l", "$": "s", "5": "s", "7": "t", "!": "i"}.get(c, c) for c in low)
    costs = []
    for w in (low, plain):
        for rank in ([S.COMMON.index(w) + 1] if w in S.COMMON else []) + ([len(S.COMMON) + KNOWN[w]] if w in KNOWN else []):
            extra = 0 if typed == low else math.log10(2) if typed[0] != low[0] and typed[1:] == low[1:] else 1
            costs.append(math.log10(rank + 1) + extra + (0 if low in S.COMMON or low in KNOWN else math.log10(2)))
    if n >= 3 and len(set(low)) == 1:
        costs.append(S.char_cost(value[i]) + math.log10(n))
    rows = ["`1234567890-=", "qwertyuiop[]", "asdfghjkl;'", "zxcvbnm,./", string.ascii_lowercase, string.digits]
    beside = lambda a, b: any(a + b in r or b + a in r for r in rows[:4]) or any(a + b in r for r in rows[4:])
    if n >= 3 and all(beside(a, b) for a, b in zip(low, low[1:])):
        costs.append(math.log10(47) + math.log10(n))
    bare = "".join(c for c in typed if c in string.digits)
    if n == 4 and len(bare) == 4 and bare[:2] in ("19", "20"):
        costs.append(2.1)
    signs = [k for k, c in enumerate(typed) if c not in string.digits]
    if len(bare) == 8 and all(typed[k] in "-/." for k in signs):
        for y, m, d, allowed in ((bare[:4], bare[4:6], bare[6:], {(), (4,), (6,), (4, 7)}),
                                 (bare[4:], bare[2:4], bare[:2], {(), (2,), (4,), (2, 5)})):
            if y[:2] in ("19", "20") and 1 <= int(m) <= 12 and 1 <= int(d) <= 31 and tuple(signs) in allowed:
                costs.append(math.log10(365 * 120))
    return min(costs, default=math.inf)


def cheapest_by_hand(value):
    best = [0.0]
    for j in range(1, len(value) + 1):
        best.append(min([best[j - 1] + S.char_cost(value[j - 1])] + [
            best[i] + part_by_hand(value, i, j) + (math.log10(2) if i else 0) for i in range(j)]))
    return best[-1]


def test_cost_of_odd_values():
    rng = random.Random(12)
    bits = ["s", "ss", "secret", "Sun", "flower", "sunflower", "aaa", "AAAA", "abc", "qwe", "4321", "2024", "2024-01-31", "31.12.1999",
            "p4ss", "w0rd", "x", "$", "9", "zz", "İ", "é", "01"]
    for _ in range(600):
        value = "".join(rng.choice(bits) for _ in range(rng.randint(0, 6)))
        assert S.guess_cost(value, KNOWN) == pytest.approx(cheapest_by_hand(value)), value
    for _ in range(200):
        value = "".join(rng.choice("abc1") for _ in range(rng.randint(0, 40)))
        assert S.guess_cost(value, KNOWN) == pytest.approx(cheapest_by_hand(value)), value


def test_plain_sentences_hold_no_secret():
    for text in ("The secret is patience", "auth: required", "api_key = os.environ", "password: changeme!"):
        assert S.scan(text, 10.0, KNOWN) == [], text


def test_corpus_words(spark):
    rows = [("the sun, The SUN shines.",)] * 3 + [("sun x1y2 half-sun under_sun the",)] * 2 + [(None,), ("",), ("the",)]
    df = spark.createDataFrame(rows, "text string")
    assert S.corpus_words(df, "text", least=1) == {"the": 1, "sun": 2, "shines": 3}
    assert S.corpus_words(df, "text", most=1, least=1) == {"the": 1}
    assert S.corpus_words(df, "text") == {} == S.corpus_words(df.limit(0), "text", least=1)
    with pytest.raises(ValueError):
        S.secret_spans(df, "text", words={str(i): i for i in range(S.RANKED + 1)})


@pytest.mark.parametrize("value", ["password", "p4ssw0rd1", "qwerty123", "aaaaB1", "20240131x", "Summer2024", "zq7#", ""])
def test_cost_is_the_cheapest_segmentation(value):
    assert S.guess_cost(value) == pytest.approx(cheapest_by_hand(value))


def test_cheap_and_costly_values():
    for cheap in ("password", "Password123", "qwertyuiop", "aaaaaaaaaaaa", "changeme", "letmein2024", "12345678"):
        assert S.guess_cost(cheap) < 10, cheap
    for costly in ("x9$kQ2vLw8!t", "fT7-pQz9rWm2", "8s7df68s7d6f"):
        assert S.guess_cost(costly) >= 10, costly


def test_long_values_take_linear_time():
    assert S.guess_cost("a1" * 20000) > 0
    assert S.guess_cost("a" * 50000) < 10


def test_frame_edges(spark):
    rows = [(1, None), (2, ""), (3, 'pwd is x9$kQ2vLw8!t ok'), (3, 'pwd is x9$kQ2vLw8!t ok'), (4, "password: changeme!"),
            (5, "é" * 70000 + ' token = "11acdfb36bb72224148e6160f674b4be45601bff" end')]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = [(r.doc_id, [(s.kind, s.start, s.end) for s in r.secrets]) for r in S.secret_spans(df, "text").collect()]
    by = dict(got)
    assert len(got) == 6 and by[1] == by[2] == by[4] == []
    assert by[3] == [("guess", 7, 19)]
    assert by[5] == [("assign", 70001, 70050), ("hex", 70010, 70050)]
    with pytest.raises(ValueError):
        S.secret_spans(df.withColumnRenamed("doc_id", "secrets"), "text")
    assert S.secret_spans(df.limit(0), "text").count() == 0


def test_query(spark):
    docs = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect()}
    out = S.op10_secret_scan(spark, SF_SMALL).collect()
    assert len(out) == len(docs)
    for r in out:
        want = assign_by_hand(docs[r.doc_id])
        want += runs_by_hand(docs[r.doc_id], "access", "AKIA", set(string.ascii_uppercase + string.digits), 18)
        want += runs_by_hand(docs[r.doc_id], "hex", "", set("0123456789abcdef"), 16)
        want.sort(key=lambda x: (x[0], S.KINDS.index(x[1])))
        line = ",".join(f"{k}:{s}:{e}" for s, k, e in want)
        assert r.base_sha256 == hashlib.sha256(line.encode()).hexdigest()
        assert (r.n_assign, r.n_access, r.n_hex) == tuple(sum(x[1] == k for x in want) for k in S.KINDS[:3])
