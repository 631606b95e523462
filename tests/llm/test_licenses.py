"""Licence scan against plain Python sets."""

import re
import textwrap

import duckdb
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tidemark.llm import licenses as L


def by_hand(text, templates=L.TEMPLATES, least=L.LEAST):
    grams = lambda t: set(L.template_bigrams(t))
    known = {k: grams(v) for k, v in sorted(templates.items())}
    out = []
    text = text or ""
    for line, passage in enumerate([text, *text.split("\n")]):
        g = grams(passage)
        scores = [(2 * len(g & b) / (len(g) + len(b)), k) for k, b in known.items() if g]
        best = max((s for s, _ in scores), default=0)
        if best >= least:
            out.append((line, next(k for s, k in scores if s == best), round(best, 9)))
    return out


def test_passages_by_hand(spark):
    mit, gpl = L.TEMPLATES["MIT"], L.TEMPLATES["GPL-3.0/notice"]
    texts = [None, "", "one", "Released under the MIT License.", "x\nReleased&&& under*** the MIT### License\ny z",
             mit, mit.upper(), mit.replace(". ", ".\n"), " ".join(mit.split()[:-20]), gpl + " " + " ".join(["w"] * 20),
             "Licensed under CC BY 4.0.\nLicensed under CC BY-SA 4.0.\nLicensed under CC BY-NC 4.0.",
             "This work is licensed under the GNU General Public License, version 2.",
             "pre " * 30000 + "\nReleased under the MIT License.\n" + "post " * 30000, "a b " * 400, "É ñ_b 漢 字\n\n\n"]
    rows = [(i, t, "k") for i, t in enumerate(texts)] + [(3, texts[3], "k")]
    df = spark.createDataFrame(rows, "doc_id long, text string, license string")
    got = L.license_matches(df, "text").collect()
    assert len(got) == len(rows)
    for r in got:
        assert [(m.line, m.license, round(m.dice, 9)) for m in r.licenses] == by_hand(r.text), r.doc_id
    found = {r.doc_id: [m.license for m in r.licenses] for r in got}
    assert found[5] and found[8] and found[10] and len(found[10]) >= 3 and not found[13]
    with pytest.raises(ValueError):
        L.license_matches(df, "text", out="license")
    assert L.license_matches(df.limit(0), "text").count() == 0


def test_bounds_lose_nothing():
    """Every pair that reaches the score is inside of the size bounds."""
    low, high = L.LEAST / (2 - L.LEAST), (2 - L.LEAST) / L.LEAST
    for b in range(1, 60):
        for a in range(1, 120):
            if 2 * min(a, b) / (a + b) >= L.LEAST:
                assert b * low <= a + 1e-9 and a <= b * high + 1e-9


def test_templates_find_themselves():
    for name, text in L.TEMPLATES.items():
        assert by_hand(text)[0][1] == name, name
        assert re.search(r"\w", name)


def runs_by_hand(text, found):
    """Runs of two or more lines, tried one by one, the best ones first."""
    rows = [(i, p) for i, p in enumerate(text.split("\n"), 1) if re.search(r"[^\W_]", p)]
    tried = []
    for k, t in L.TEMPLATES.items():
        b, most = set(L.template_bigrams(t)), len(re.sub(r"[\W_]+", " ", t).split()) * 1.5
        for i in range(len(rows)):
            for j in range(i + 1, len(rows)):
                words = re.sub(r"[\W_]+", " ", " ".join(p for _, p in rows[i:j + 1]).lower()).split()
                if len(words) > most + 1e-9:
                    break
                g = set(zip(words, words[1:]))
                d = 2 * len({f"{x} {y}" for x, y in g} & b) / (len(g) + len(b))
                if d >= L.LEAST and not any(s >= d and (n == 0 or rows[i][0] <= n <= rows[j][0]) for n, _, s in found):
                    tried.append((-d, k, j - i, rows[i][0], rows[j][0]))
    kept = []
    for r in sorted(tried):
        if not any(k[3] <= r[4] and r[3] <= k[4] for k in kept):
            kept.append(r)
    return [(r[3], r[4], r[1], round(-r[0], 9)) for r in kept]


def test_wrapped_blocks(spark):
    """Notices wrapped over the lines of a longer text are found, each once."""
    code = "\n".join(f"value_{i} = compute(item_{i}, {i})" for i in range(60))
    wrap = lambda k, w=76: "\n".join("# " + x for x in textwrap.wrap(L.TEMPLATES[k], w))
    names = ["MIT", "GPL-3.0/notice", "Apache-2.0/notice", "BSD-2-Clause", "MPL-2.0/notice", "CC-BY-SA-4.0/notice"]
    texts = [wrap(k) + "\n" + code for k in names]
    texts += ["#!/bin/sh\n\n" + wrap("MIT", 40).replace(". ", ".\n#\n# ") + "\n" + code + "\n\n" + wrap("ISC") + "\nx\n" + wrap("ISC"),
              code + "\n/* " + wrap("MIT").replace("# ", " * "), "the of and or to in this software\n" * 300, code]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: r for r in L.license_matches(df, "text").collect()}
    for i, t in enumerate(texts):
        single = by_hand(t)
        want = sorted([(n, n, k, d) for n, k, d in single] + runs_by_hand(t, single))
        assert [(m.line, m.last, m.license, round(m.dice, 9)) for m in got[i].licenses] == want, i
    for i, k in enumerate(names):
        assert max((m.dice, m.license) for m in got[i].licenses)[1] == k
    assert [m.license for m in got[6].licenses] == ["MIT", "ISC", "ISC"] and len(got[7].licenses) == 1
    assert not got[8].licenses and not got[9].licenses


def test_hashes_are_sparks(spark):
    grams = ["the software", "a", "", "é 漢 字 of a longer bigram than thirty two bytes"]
    got = spark.createDataFrame([(g,) for g in grams], "g string").select(F.xxhash64("g")).collect()
    assert [r[0] for r in got] == [L.hashed(g) for g in grams]


def test_sql_has_the_runs(spark, tmp_path):
    """The SQL gives the operator's rows where only runs of lines match."""
    code = "\n".join(f"value_{i} = compute(item_{i}, {i})" for i in range(60))
    wrap = lambda k, w=76: "\n".join("# " + x for x in textwrap.wrap(L.TEMPLATES[k], w))
    names = [k for k in L.TEMPLATES if not k.endswith("/line")]
    texts = [wrap(k) + "\n" + code for k in names] + [
        wrap("MIT", 40) + "\n\n" + code + "\n" + wrap("MIT") + "\nx\n" + wrap("ISC") + "\n" + L.TEMPLATES["MIT/line"],
        None, "", "\n\n", code, wrap("MIT"), wrap("MIT")]
    rows = list(enumerate(texts))
    df = spark.createDataFrame(rows, "doc_id long, text string")
    df.write.parquet(str(tmp_path / "documents.parquet"))
    got = [tuple(r) for r in L.op4_license_scan(spark, str(tmp_path)).collect()]
    con = duckdb.connect()
    con.register("documents", pa.table({"doc_id": pa.array([i for i, _ in rows], pa.int64()),
                                        "text": pa.array([t for _, t in rows], pa.string())}))
    assert sorted(got, key=lambda r: r[0]) == sorted(con.execute(L.OP4_SQL).fetchall(), key=lambda r: r[0])
    by_id = {r[0]: r for r in got}
    assert [by_id[i][2] for i in range(len(names))] == names and by_id[len(names)][1] >= 4


def test_a_text_full_of_notices(spark):
    """Repeated notices are found one by one, beside the whole text, whose set
    of bigrams is that of one notice and little more."""
    block = "\n".join(textwrap.wrap(L.TEMPLATES["MIT"], 76)) + "\n\npackage of its own\n\n"
    df = spark.createDataFrame([(1, block * 40)], "doc_id long, text string")
    found = L.license_matches(df, "text").collect()[0].licenses
    assert [m.license for m in found] == ["MIT"] * 41
    assert [m.line for m in found[:3]] == [0, 1, 1 + block.count("\n")]
