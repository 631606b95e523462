"""Surrogates: types, formats, distinctness, coreference, key."""

import re

import pytest

from tests.conftest import SF_MED
from tidemark.llm import pii as P

KEY = b"k1"


def kinds(text):
    return [(text[m["start"]:m["end"]], m["kind"]) for m in P.detect(text)]


def test_detection():
    assert kinds("mail a.b9@Mail2.example.com, call +1 (663) 555-6869.") == [
        ("a.b9@Mail2.example.com", "email"), ("+1 (663) 555-6869", "phone")]
    assert kinds("from 233.233.171.252 4465758382889437 4465758382889437 x") == [
        ("233.233.171.252", "ip"), ("4465758382889437", "card"), ("4465758382889437", "card")]
    assert kinds("ssn 123-45-6789, DE89 3704 0044 0532 0130 00!") == [
        ("123-45-6789", "ssn"), ("DE89 3704 0044 0532 0130 00", "iban")]
    assert kinds("Mrs. Anna Schmidt met Herr Meier and John Miller") == [
        ("Anna", "given:latin"), ("Schmidt", "surname:latin"), ("Meier", "surname:latin"), ("John", "given:latin"),
        ("Miller", "surname:latin")]
    assert kinds("г-жа Ольга Иванова") == [("Ольга", "given:cyrillic"), ("Иванова", "surname:cyrillic")]
    for clean in ("", "version 2.0. In 2024, 300 of 1999", "token = \"aebccd4559894937c75946a5f6a3ed5b13ef9ee9\"", "1.2.3",
                  "Licensed under the Apache License, Version 2.0.", "A sentence. The end", "1999-2024"):
        assert kinds(clean) == [], clean


def test_proposals_keep_type_and_format():
    for n in range(200):
        card = P.propose(KEY, "card", "4111111111111111", None, n)
        assert len(card) == 16 and card[0] == "4" and P.luhn(card)
        assert not P.luhn(P.propose(KEY, "card", "4111111111111112", None, n))
        ip = P.propose(KEY, "ip", "10.2.233.4", None, n % 8)
        assert [len(o) for o in ip.split(".")] == [2, 1, 3, 1] and kinds(ip) == [(ip, "ip")]
        phone = P.propose(KEY, "phone", "16635556869", None, n)
        assert len(phone) == 11 and phone[0] == "1" and phone.isdigit()
        mail = P.propose(KEY, "email", "a.b9@mail2.example.com", None, 0)
        assert re.fullmatch(r"[a-z]\.[a-z]\d@[a-z]{4}\d\.[a-z]{7}\.com", mail) and kinds(mail) == [(mail, "email")]
        iban = P.propose(KEY, "iban", "DE89370400440532013000", None, n)
        assert iban[:2] == "DE" and P._mod97(iban) == 1 and len(iban) == 22
    her, him = ({P.propose(KEY, "given:latin", f"n{i}", g, 0)[-1] for i in range(300)} for g in "fm")
    assert not her & him
    assert re.fullmatch("[а-я]+", P.propose(KEY, "surname:cyrillic", "иванов", None, 0))
    assert P.dressed("+1 (663) 555-6869", "phone", "12223334444") == "+1 (222) 333-4444"


def run(spark, rows, key=KEY):
    df = spark.createDataFrame(rows, "doc_id long, text string, digest string")
    return sorted((tuple(r) for r in P.replace_pii(df, "text", key).collect()), key=repr)


ROWS = [(1, "call +1 (663) 555-6869 or 1-663-555-6869 x", "c"), (2, "Call +1 663 555 6869 now", None), (3, None, None), (4, "", "c"),
        (5, "no data", "c"), (5, "no data", "c"), (6, "Mr. John Smith wrote. Then Mr. Smith left; JOHN", "c"),
        (7, "Mail A.B@X.COM and a.b@x.com", "c"), (7, "Mail A.B@X.COM and a.b@x.com", "c"), (None, "ip 1.2.3.4", None),
        (8, "pad " * 40000 + "ip 1.2.3.4 end", "c")]


def test_coreference_and_rows(spark):
    out = run(spark, ROWS)
    assert len(out) == len(ROWS)
    text = {r[0]: r for r in out}
    a, b = re.findall(r"[+\d][\d ()-]{9,}\d", text[1][1])
    digits = re.sub(r"\D", "", a)
    assert digits == re.sub(r"\D", "", b) != "16635556869" and re.sub(r"\D", "", text[2][1]) == digits
    m = re.fullmatch(r"Mr\. (\w+) (\w+) wrote\. Then Mr\. (\w+) left; JOHN", text[6][1])
    assert m and m[2] == m[3] and m[1] != "John" and m[2] != "Smith" and m[1][0].isupper()
    assert text[3][1] is None and text[4][1] == "" and text[5][1] == "no data" and text[5][3] == 0
    assert text[1][3] == 2 and text[7][3] == 2
    ip = text[None][1].split()[1]
    assert ip != "1.2.3.4" and text[8][1] == "pad " * 40000 + f"ip {ip} end"
    assert out == run(spark, ROWS) != run(spark, ROWS, b"k2")
    assert run(spark, []) == []
    with pytest.raises(ValueError):
        P.replace_pii(spark.createDataFrame([("a", 1)], "text string, n_replaced int"), "text", KEY)


def test_distinct_in_a_narrow_space(spark):
    """All one-digit quads from 1 to 9 on two places: proposals collide and
    hit other units, yet all surrogates are distinct and new."""
    units = [("ip", f"{a}.{b}.{c}.{d}", None) for a in range(1, 10) for b in range(1, 10) for c in range(1, 10)
             for d in range(1, 4)]
    units += [("given:latin", f"name{i}", "f") for i in range(3000)]
    df = spark.createDataFrame(units, "kind string, norm string, gender string")
    got = P.surrogates(df, KEY).collect()
    assert len(got) == len(units) == len({(r.kind, r.norm) for r in got})
    assert len({(r.kind, r.surrogate) for r in got}) == len(units)
    assert not {(r.kind, r.surrogate) for r in got} & {(k, n) for k, n, _ in units}


def test_query(spark):
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{SF_MED}/documents.parquet").collect()}
    out = {r.doc_id: r for r in P.op1_pii_surrogates(spark, SF_MED).collect()}
    assert set(out) == set(docs)
    seen = {}
    for i, raw in docs.items():
        old, new = P.detect(raw or ""), P.detect(out[i].text or "")
        assert out[i].n_replaced == len(old)
        if not old:
            assert out[i].text == raw
            continue
        rest = lambda t, ms: "|".join(t[a:b] for a, b in zip([0, *(m["end"] for m in ms)], [*(m["start"] for m in ms), len(t)]))
        assert [m["kind"] for m in new] == [m["kind"] for m in old] and rest(out[i].text, new) == rest(raw, old)
        for a, b in zip(old, new):
            assert seen.setdefault((a["kind"], a["norm"]), b["norm"]) == b["norm"]
    assert len({(k[0], v) for k, v in seen.items()}) == len(seen) > 20
    assert not {(k[0], v) for k, v in seen.items()} & set(seen)
