"""Licence scan by Dice coefficient over word bigrams [native].

Each passage of a text (the whole text, every line of it, and runs of
consecutive lines) is normalised to lower-case words of letters and digits and
compared to licence templates by
``2 * common / (a + b)`` over sets of word bigrams.  A passage of ``a`` bigrams
can only reach ``least`` with a template of ``b`` if
``b * least / (2 - least) <= a <= b * (2 - least) / least``, so templates
outside of these size bounds are pruned before any comparison.  Such a passage
shares ``b * least / (2 - least)`` bigrams at least with the template, and so
does the whole text: a text that does so with no template is done after one
pass over its bigrams, and the others are compared only to the templates with
which they do.  Everything is one projection over the rows: no shuffle, no join.

Runs are two or more lines with words, of at most ``(2 - least) / least`` times
the template's words, at any place of the text; within them bigrams are known
by 64-bit hashes, made once for each line.  Of runs that overlap the best one counts (of equal
scores the shorter one, then the earlier one), and only if no line in it and
not the whole text scores as much.

Defined results: null text counts as empty; passages of fewer than two words
match nothing; of equal scores the template named first in code point order
wins; repeated rows are scanned each on its own; other columns pass through
and a clash with the output column is refused.
"""

from __future__ import annotations

import re
from itertools import chain

import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

LEAST = 0.8

#: Wording of public licences and of their usual notices.
TEMPLATES = {
    "Apache-2.0/line": "Licensed under the Apache License, Version 2.0.",
    "Apache-2.0/notice": "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file "
    "except in compliance with the License. You may obtain a copy of the License at "
    "http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, software "
    "distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, "
    "either express or implied. See the License for the specific language governing permissions and limitations under "
    "the License.",
    "BSD-2-Clause/line": "This software is released under the BSD 2-Clause License.",
    "BSD-2-Clause": "Redistribution and use in source and binary forms, with or without modification, are permitted "
    "provided that the following conditions are met: 1. Redistributions of source code must retain the above copyright "
    "notice, this list of conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the "
    "above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other "
    "materials provided with the distribution. THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "
    "\"AS IS\" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF "
    "MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR "
    "CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES "
    "(INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR "
    "BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR "
    "TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF "
    "THE POSSIBILITY OF SUCH DAMAGE.",
    "BSD-3-Clause": "Redistribution and use in source and binary forms, with or without modification, are permitted "
    "provided that the following conditions are met: 1. Redistributions of source code must retain the above copyright "
    "notice, this list of conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the "
    "above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other "
    "materials provided with the distribution. 3. Neither the name of the copyright holder nor the names of its "
    "contributors may be used to endorse or promote products derived from this software without specific prior written "
    "permission. THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS \"AS IS\" AND ANY EXPRESS OR IMPLIED "
    "WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR "
    "PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, "
    "INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE "
    "GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF "
    "LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT "
    "OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE.",
    "BSD-3-Clause/line": "This software is released under the BSD 3-Clause License.",
    "CC0-1.0/line": "To the extent possible under law, the author has waived all copyright and related rights to this "
    "work.",
    "CC-BY-4.0/line": "Licensed under CC BY 4.0.",
    "CC-BY-4.0/notice": "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    "CC-BY-NC-4.0/line": "Licensed under CC BY-NC 4.0.",
    "CC-BY-NC-4.0/notice": "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International "
    "License.",
    "CC-BY-SA-4.0/line": "Licensed under CC BY-SA 4.0.",
    "CC-BY-SA-4.0/notice": "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International "
    "License.",
    "AGPL-3.0/line": "This work is licensed under the GNU Affero General Public License, version 3.",
    "AGPL-3.0/notice": "This program is free software: you can redistribute it and/or modify it under the terms of the "
    "GNU Affero General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later "
    "version. This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the "
    "implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU Affero General Public License for more details. You should "
    "have received a copy of the GNU Affero General Public License along with this program. If not, see <https://www.gnu.org/licenses/>.",
    "GPL-2.0/line": "This work is licensed under the GNU General Public License, version 2.",
    "GPL-2.0/notice": "This program is free software; you can redistribute it and/or modify it under the terms of the "
    "GNU General Public License as published by the Free Software Foundation; either version 2 of the License, or (at "
    "your option) any later version. This program is distributed in the hope that it will be useful, but WITHOUT ANY "
    "WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU "
    "General Public License for more details. You should have received a copy of the GNU General Public License along "
    "with this program; if not, write to the Free Software Foundation, Inc., 51 Franklin Street, Fifth Floor, Boston, MA "
    "02110-1301 USA.",
    "GPL-3.0/line": "This work is licensed under the GNU General Public License, version 3.",
    "GPL-3.0/notice": "This program is free software: you can redistribute it and/or modify it under the terms of the "
    "GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at "
    "your option) any later version. This program is distributed in the hope that it will be useful, but WITHOUT ANY "
    "WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU "
    "General Public License for more details. You should have received a copy of the GNU General Public License along "
    "with this program. If not, see <https://www.gnu.org/licenses/>.",
    "LGPL-3.0/line": "This work is licensed under the GNU Lesser General Public License, version 3.",
    "LGPL-2.1/notice": "This library is free software; you can redistribute it and/or modify it under the terms of the "
    "GNU Lesser General Public License as published by the Free Software Foundation; either version 2.1 of the License, or (at your option) any later "
    "version. This library is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the "
    "implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU Lesser General Public License for more details. You should "
    "have received a copy of the GNU Lesser General Public License along with this library; if not, write to the Free Software Foundation, Inc., 51 Franklin "
    "Street, Fifth Floor, Boston, MA 02110-1301 USA.",
    "LGPL-3.0/notice": "This program is free software: you can redistribute it and/or modify it under the terms of the "
    "GNU Lesser General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later "
    "version. This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the "
    "implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU Lesser General Public License for more details. You should "
    "have received a copy of the GNU Lesser General Public License along with this program. If not, see <https://www.gnu.org/licenses/>.",
    "ISC": "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is "
    "hereby granted, provided that the above copyright notice and this permission notice appear in all copies. THE "
    "SOFTWARE IS PROVIDED \"AS IS\" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL "
    "IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, "
    "INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER "
    "IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR "
    "PERFORMANCE OF THIS SOFTWARE.",
    "MIT/line": "Released under the MIT License.",
    "MIT": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and "
    "associated documentation files (the \"Software\"), to deal in the Software without restriction, including without "
    "limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the "
    "Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions: "
    "The above copyright notice and this permission notice shall be included in all copies or substantial portions of "
    "the Software. THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT "
    "NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO "
    "EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN "
    "ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER "
    "DEALINGS IN THE SOFTWARE.",
    "MPL-2.0/notice": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy "
    "of the MPL was not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/.",
    "Unlicense": "This is free and unencumbered software released into the public domain. Anyone is free to copy, "
    "modify, publish, use, compile, sell, or distribute this software, either in source code form or as a compiled "
    "binary, for any purpose, commercial or non-commercial, and by any means.",
}


def template_words(text: str) -> list[str]:
    return re.sub(r"[\W_]+", " ", text.lower()).split()


def template_bigrams(text: str) -> list[str]:
    words = template_words(text)
    return sorted({f"{a} {b}" for a, b in zip(words, words[1:])})


def hashed(gram: str) -> int:
    """``F.xxhash64`` of a bigram."""
    return int.from_bytes(xxhash.xxh64_digest(gram.encode(), seed=42), "big", signed=True)


def _plain(text: Column) -> Column:
    """Lower-case words of letters and digits, one space between them."""
    return F.trim(F.regexp_replace(F.lower(text), r"[^\p{L}\p{N}]+", " "))


def _bigrams(plain: Column) -> Column:
    """The word bigrams of a plain text in their order, repeats included."""
    return F.regexp_extract_all(plain, F.lit(r"(?<![^ ])(?=([^ ]+ [^ ]+))"), F.lit(1))


def _let(value: Column, use) -> Column:
    """``use(value)`` with ``value`` worked out once."""
    return F.transform(F.array(value), use)[0]


def _singles(whole: Column, lines: Column, near: Column, least: float) -> Column:
    """The whole text and the lines that reach ``least`` with their best template."""
    passages = F.concat(F.array(F.struct(F.lit(0).alias("line"), _bigrams(whole).alias("grams"))),
                        F.transform(lines, lambda p: F.struct(p["line"].alias("line"), p["grams"].alias("grams"))))

    def best(g: Column) -> Column:
        a = F.size(g)
        fits = lambda t: (a >= t["low"]) & (a <= t["high"])
        return F.array_max(F.transform(F.filter(near, fits), lambda t: F.struct(
            (F.lit(2.0) * F.size(F.array_intersect(g, t["grams"])) / (a + t["n"])).alias("dice"),
            (-t["place"]).alias("place"), t["license"].alias("license"))))

    scored = F.transform(passages, lambda p: F.struct(
        p["line"].alias("line"), _let(F.array_distinct(p["grams"]), best).alias("best")))
    return F.transform(F.filter(scored, lambda p: p["best"]["dice"] >= least), lambda p: F.struct(
        p["line"].alias("line"), p["line"].alias("last"), p["best"]["license"].alias("license"),
        p["best"]["dice"].alias("dice")))


def _runs(lines: Column, t: Column, least: float) -> Column:
    """Runs of ``lines`` (line, words, own: its bigrams, all: and the one
    across its end, joint) that reach ``least`` with the template ``t``: an
    array of (down, place, size, line, last, license), the best first in sort
    order.  A run that starts or ends with a line that brings no bigram of the
    template is beaten by the run without it."""
    hit = F.transform(lines, lambda p: F.struct(
        p["line"].alias("line"), p["words"].alias("words"), p["own"].alias("own"), p["all"].alias("all"),
        F.size(F.array_intersect(p["own"], t["hashes"])).alias("hit"),
        F.coalesce(F.array_contains(t["hashes"], p["joint"]).cast("int"), F.lit(0)).alias("across")))

    def sized(h: Column, i: Column) -> Column:
        def step(s: Column, q: Column) -> Column:
            at, n, hits = s["at"] + 1, s["n"] + q["words"], s["hits"] + s["across"] + q["hit"]
            ends = (at > 1) & (n <= t["most"]) & (hits >= t["common"]) & (s["across"] + q["hit"] > 0)
            return F.when(s["n"] > t["most"], s).otherwise(F.struct(
                at.alias("at"), n.alias("n"), hits.alias("hits"), q["across"].alias("across"),
                F.when(ends, F.concat(s["sizes"], F.array(at))).otherwise(s["sizes"]).alias("sizes")))
        start = F.struct(*[F.lit(0).alias(c) for c in ("at", "n", "hits", "across")],
                         F.array().cast("array<int>").alias("sizes"))
        return F.aggregate(F.slice(h, i + 1, t["most"]), start, step, lambda s: F.transform(
            s["sizes"], lambda k: F.struct(i.alias("start"), k.alias("size"))))

    def scored(h: Column) -> Column:
        spans = F.flatten(F.transform(h, lambda p, i: F.when(p["hit"] + p["across"] > 0, sized(h, i)).otherwise(
            F.array().cast("array<struct<start:int,size:int>>"))))
        return F.transform(spans, lambda s: _let(
            F.array_distinct(F.concat(
                F.flatten(F.transform(F.slice(h, s["start"] + 1, s["size"] - 1), lambda p: p["all"])),
                F.get(h, s["start"] + s["size"] - 1)["own"])),
            lambda g: F.struct(
                (F.lit(-2.0) * F.size(F.array_intersect(g, t["hashes"])) / (F.size(g) + t["n"])).alias("down"),
                t["place"].alias("place"), s["size"].alias("size"), F.get(h, s["start"])["line"].alias("line"),
                F.get(h, s["start"] + s["size"] - 1)["line"].alias("last"), t["license"].alias("license"))))

    return F.filter(_let(hit, scored), lambda r: r["down"] <= -least)


def _blocks(lines: Column, single: Column, near: Column, least: float) -> Column:
    """The best runs that overlap no better one and hold no line of ``single``
    that scores as much."""
    def joined(full: Column) -> Column:
        joint = lambda p, q: F.xxhash64(F.concat_ws(" ", F.element_at(p["words"], -1), q["words"][0]))
        return F.transform(full, lambda p, i: _let(F.transform(p["grams"], lambda g: F.xxhash64(g)), lambda own: _let(
            F.when(i + 1 < F.size(full), joint(p, F.get(full, i + 1))), lambda j: F.struct(
                p["line"].alias("line"), F.size(p["words"]).alias("words"), own.alias("own"), j.alias("joint"),
                F.when(j.isNull(), own).otherwise(F.concat(own, F.array(j))).alias("all")))))

    full = _let(F.filter(lines, lambda p: F.size(p["words"]) > 0), joined)
    runs = _let(full, lambda h: F.flatten(F.transform(near, lambda t: _runs(h, t, least))))
    better = F.array_sort(F.filter(runs, lambda r: ~F.exists(single, lambda p: (p["dice"] >= -r["down"]) & (
        (p["line"] == 0) | p["line"].between(r["line"], r["last"])))))
    chosen = _let(better, lambda rs: F.aggregate(rs, F.slice(rs, 1, 0), lambda kept, r: F.when(
        F.exists(kept, lambda k: (k["line"] <= r["last"]) & (r["line"] <= k["last"])), kept).otherwise(
        F.concat(kept, F.array(r)))))
    return F.transform(chosen, lambda r: F.struct(
        r["line"].alias("line"), r["last"].alias("last"), r["license"].alias("license"), (-r["down"]).alias("dice")))


def license_matches(df: DataFrame, text_col: str, out: str = "licenses", templates: dict[str, str] | None = None,
                    least: float = LEAST) -> DataFrame:
    """``df`` with ``out``: one entry for each passage that reaches ``least``
    with a template: line (0 for the whole text, else the first line's number
    from 1), last (the last line's number), license (the best template) and
    dice.  ``templates`` (name to wording) stands in for ``TEMPLATES``, for
    instance with whole licence texts read from files."""
    if out in df.columns:
        raise ValueError(f"there is a column {out} already")
    wording = dict(sorted((TEMPLATES if templates is None else templates).items()))
    known = {k: template_bigrams(v) for k, v in wording.items()}
    known = {k: b for k, b in known.items() if b}
    low, high = least / (2 - least), (2 - least) / least
    array = lambda xs: F.array(*[F.lit(x) for x in xs])
    table = F.array(*[F.struct(
        F.lit(k).alias("license"), F.lit(i).alias("place"), F.lit(len(b)).alias("n"), array(b).alias("grams"),
        array(map(hashed, b)).alias("hashes"), F.lit(len(b) * low - 1e-9).alias("common"),
        F.lit(len(b) * low).alias("low"), F.lit(len(b) * high).alias("high"),
        F.lit(int(len(template_words(wording[k])) * high + 1e-9)).alias("most")) for i, (k, b) in enumerate(known.items())])
    none = F.array().cast("array<struct<line:int,last:int,license:string,dice:double>>")
    if not known:
        return df.withColumn(out, none)
    text = F.coalesce(F.col(text_col), F.lit(""))
    fewest = min(map(len, known.values())) * low - 1e-9
    # A passage shares bigrams with a template only if the whole text does.
    shared = F.array_intersect(_bigrams(_plain(text)), array(sorted(set(chain.from_iterable(known.values())))))
    near = _let(shared, lambda h: F.when(F.size(h) >= fewest, F.filter(
        table, lambda t: F.size(F.array_intersect(h, t["grams"])) >= t["common"])).otherwise(F.slice(table, 1, 0)))
    lines = F.transform(F.split(text, "\n"), lambda x, i: _let(_plain(x), lambda p: F.struct(
        (i + 1).alias("line"), _bigrams(p).alias("grams"),
        F.when(p != "", F.split(p, " ")).otherwise(F.array().cast("array<string>")).alias("words"))))

    def found(ns: Column) -> Column:
        return F.when(F.size(ns) == 0, none).otherwise(_let(lines, lambda ls: _let(
            _singles(_plain(text), ls, ns, least), lambda single: F.array_sort(
                F.concat(single, _blocks(ls, single, ns, least))))))

    return df.withColumn(out, _let(near, found))


def op4_license_scan(spark, sf_dir: str) -> DataFrame:
    """Licence passages of every document: their number, and the best one's
    licence, line and score (nulls where there is none)."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    found = license_matches(docs, "text").drop("text")
    best = F.array_max(F.transform("licenses", lambda m: F.struct(
        m["dice"].alias("dice"), (-m["line"]).alias("up"), m["license"].alias("license"))))
    return found.select("doc_id", F.size("licenses").cast("long").alias("n_matches"),
                        best["license"].alias("license"), (-best["up"]).cast("long").alias("line"),
                        F.round(best["dice"], 9).alias("dice"))


def _quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


#: Passages as the operator has them: whole text, lines, and runs of lines of
#: which the best that overlap no better one are taken one after the other.
OP4_SQL = r"""
WITH RECURSIVE t(license, place, words, grams) AS (VALUES """ + ", ".join(
    f"({_quoted(k)}, {i}, {len(template_words(v))}, [{', '.join(map(_quoted, template_bigrams(v)))}])"
    for i, (k, v) in enumerate(sorted(TEMPLATES.items()))) + r"""),
u AS (
  SELECT doc_id, text, 0 AS line FROM documents
  UNION ALL
  SELECT doc_id, unnest(l) AS text, unnest(range(1, len(l) + 1)) AS line
  FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS l FROM documents)),
w AS (
  SELECT doc_id, line, CASE WHEN p = '' THEN [] ELSE string_split(p, ' ') END AS w
  FROM (SELECT doc_id, line, trim(regexp_replace(lower(coalesce(text, '')), '[^\p{L}\p{N}]+', ' ', 'g')) AS p FROM u)),
g AS (
  SELECT doc_id, line, list_distinct(list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])) AS g FROM w),
s AS (
  SELECT doc_id, line, license,
         2.0::DOUBLE * len(list_intersect(g, grams)) / (len(g) + len(grams)) AS dice
  FROM g JOIN t ON len(g) BETWEEN 1 AND 2 * len(grams)),
b AS (
  SELECT doc_id, line, first(license ORDER BY dice DESC, license) AS license, max(dice) AS dice
  FROM s GROUP BY doc_id, line HAVING max(dice) >= 0.8),
near AS (  -- a run shares two thirds of the template's bigrams at least, and so does its text
  SELECT doc_id, license, place, words, grams
  FROM g JOIN t ON line = 0 AND 3 * len(list_intersect(g, grams)) >= 2 * len(grams)),
l AS (
  SELECT doc_id, line, w, row_number() OVER o AS at, sum(len(w)) OVER o AS upto
  FROM w WHERE line > 0 AND len(w) > 0 AND doc_id IN (SELECT doc_id FROM near)
  WINDOW o AS (PARTITION BY doc_id ORDER BY line)),
whole AS (SELECT doc_id, flatten(list(w ORDER BY line)) AS w FROM l GROUP BY doc_id),
r AS (
  SELECT x.doc_id, x.line, y.line AS last, y.at - x.at + 1 AS size, n.license, n.place, n.grams,
         whole.w[x.upto - len(x.w) + 1:y.upto] AS w
  FROM near n JOIN l x USING (doc_id)
  JOIN l y ON y.doc_id = x.doc_id AND y.at > x.at AND 2 * (y.upto - x.upto + len(x.w)) <= 3 * n.words
  JOIN whole ON whole.doc_id = x.doc_id),
q AS (
  SELECT doc_id, line, last, size, license, place,
         2.0::DOUBLE * len(list_intersect(g, grams)) / (len(g) + len(grams)) AS dice
  FROM (SELECT *, list_distinct(list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])) AS g FROM r)),
c AS (
  SELECT * FROM q WHERE dice >= 0.8 AND NOT EXISTS (
    SELECT 1 FROM b WHERE b.doc_id = q.doc_id AND b.dice >= q.dice AND (b.line = 0 OR b.line BETWEEN q.line AND q.last))),
pick AS (
  SELECT doc_id, runs[1] AS best,
         list_filter(runs, lambda z: z.line > runs[1].last OR z.last < runs[1].line) AS rest
  FROM (SELECT doc_id, list({'line': line, 'last': last, 'license': license, 'dice': dice}
                            ORDER BY dice DESC, place, size, line) AS runs FROM c GROUP BY doc_id)
  UNION ALL
  SELECT doc_id, rest[1] AS best, list_filter(rest, lambda z: z.line > rest[1].last OR z.last < rest[1].line) AS rest
  FROM pick WHERE len(rest) > 0),
a AS (
  SELECT doc_id, line, license, dice FROM b
  UNION ALL
  SELECT doc_id, best.line, best.license, best.dice FROM pick),
f AS (
  SELECT doc_id, count(*) AS n, first(license ORDER BY dice DESC, line, license DESC) AS license,
         first(line ORDER BY dice DESC, line) AS line, max(dice) AS dice
  FROM a GROUP BY doc_id)
SELECT d.doc_id, coalesce(n, 0)::BIGINT AS n_matches, license, f.line::BIGINT AS line, round(dice, 9) AS dice
FROM documents d LEFT JOIN f USING (doc_id)
"""
