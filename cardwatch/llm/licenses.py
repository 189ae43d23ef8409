"""Licence scan by Dice coefficient over word bigrams (operator 9, native).

Units of a text - each line, the sentences of a line of several, each paragraph of several
lines, and runs of consecutive paragraphs - are normalised and compared with licence
templates. A Dice coefficient of t or more needs ``t/(2-t) <= |unit| / |template| <= (2-t)/t``,
so a unit is compared only with the templates whose size is within those bounds. The same
bounds say that a unit holds ``t/(2-t)`` of a template's bigrams, so it has one of a few words
(``key_words``) that occur in the others; texts and units without any are not taken apart.
One pass over the documents, no shuffle: the templates are a fixed list.
"""

from __future__ import annotations

import json
import math
import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

THRESHOLD = 0.8

# Published licence texts, their paragraphs apart, the year and holder left out.
MIT_GRANT = (
    "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
    "documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation "
    "the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and "
    "to permit persons to whom the Software is furnished to do so, subject to the following conditions:")
MIT_NOTICE = ("The above copyright notice and this permission notice shall be included in all copies or substantial portions of "
              "the Software.")
MIT_WARRANTY = (
    "THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE "
    "WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR "
    "COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR "
    "OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.")
ISC_GRANT = (
    "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby "
    "granted, provided that the above copyright notice and this permission notice appear in all copies.")
ISC_WARRANTY = (
    "THE SOFTWARE IS PROVIDED \"AS IS\" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL "
    "IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, "
    "INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN "
    "ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF "
    "THIS SOFTWARE.")
BSD_GRANT = ("Redistribution and use in source and binary forms, with or without modification, are permitted provided that the "
             "following conditions are met:")
BSD_SOURCE = ("1. Redistributions of source code must retain the above copyright notice, this list of conditions and the "
              "following disclaimer.")
BSD_BINARY = ("2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the "
              "following disclaimer in the documentation and/or other materials provided with the distribution.")
BSD_NAMES = ("3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote "
             "products derived from this software without specific prior written permission.")
BSD_WARRANTY = (
    "THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS \"AS IS\" AND ANY EXPRESS OR IMPLIED WARRANTIES, "
    "INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE "
    "DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, "
    "SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR "
    "SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, "
    "WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF "
    "THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE.")
GNU_GRANT = ("This {work} is free software: you can redistribute it and/or modify it under the terms of the GNU {kind} Public "
             "License as published by the Free Software Foundation, either version {version} of the License, or (at your "
             "option) any later version.")
GNU_WARRANTY = ("This {work} is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the "
                "implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU {kind} Public License for "
                "more details.")
GNU_COPY = ("You should have received a copy of the GNU {kind} Public License along with this {work}. If not, see "
            "<https://www.gnu.org/licenses/>.")
GNU = [("AGPL-3.0", "program", "Affero General", "3"), ("GPL-2.0", "program", "General", "2"), ("GPL-3.0", "program", "General", "3"),
       ("LGPL-2.1", "library", "Lesser General", "2.1"), ("LGPL-3.0", "library", "Lesser General", "3")]
APACHE_USE = ("Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in "
              "compliance with the License.")
APACHE_COPY = "You may obtain a copy of the License at"
APACHE_URL = "http://www.apache.org/licenses/LICENSE-2.0"
APACHE_WARRANTY = (
    "Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an "
    "\"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the "
    "specific language governing permissions and limitations under the License.")
MPL_FORM = "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."
MPL_COPY = "If a copy of the MPL was not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/."

# One-line notices, by SPDX id (All-Rights-Reserved is ours).
NOTICES = [
    ("AGPL-3.0", "This work is licensed under the GNU Affero General Public License, version 3."),
    ("All-Rights-Reserved", "All rights reserved."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("BSD-2-Clause", "Released under the BSD 2-Clause License."),
    ("BSD-3-Clause", "Released under the BSD 3-Clause License."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC0-1.0", "Released into the public domain under CC0 1.0 Universal."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("ISC", "Released under the ISC License."),
    ("LGPL-3.0", "This work is licensed under the GNU Lesser General Public License, version 3."),
    ("MIT", "Released under the MIT License."),
    ("MPL-2.0", MPL_FORM),
    ("Unlicense", "This is free and unencumbered software released into the public domain."),
]


def _whole(*paragraphs: str) -> str:
    return "\n\n".join(paragraphs)


def _gnu(text: str, row) -> str:
    return text.format(work=row[1], kind=row[2], version=row[3])


#: (SPDX id, text): notices, identifying paragraphs, whole texts (paragraphs between blank lines), and SPDX tags.
TEMPLATES = NOTICES + [
    ("MIT", MIT_GRANT + " " + MIT_NOTICE),
    ("MIT", MIT_GRANT),
    ("MIT", _whole(MIT_GRANT, MIT_NOTICE, MIT_WARRANTY)),
    ("ISC", ISC_GRANT),
    ("ISC", _whole(ISC_GRANT, ISC_WARRANTY)),
    ("BSD-2-Clause", _whole(BSD_GRANT, BSD_SOURCE, BSD_BINARY, BSD_WARRANTY)),
    ("BSD-3-Clause", _whole(BSD_GRANT, BSD_SOURCE, BSD_BINARY, BSD_NAMES, BSD_WARRANTY)),
    ("Apache-2.0", APACHE_USE),
    ("Apache-2.0", _whole(APACHE_USE, APACHE_COPY, APACHE_URL, APACHE_WARRANTY)),
    ("MPL-2.0", MPL_FORM + " " + MPL_COPY),
]
TEMPLATES += [(row[0], _gnu(GNU_GRANT, row)) for row in GNU]
TEMPLATES += [(row[0], _gnu(_whole(GNU_GRANT, GNU_WARRANTY, GNU_COPY), row)) for row in GNU]
TEMPLATES += [(i, f"SPDX-License-Identifier: {i}") for i in sorted({i for i, _ in TEMPLATES} - {"All-Rights-Reserved"})]

#: Words too common in prose to look for; taken as key words only where a template has no others.
COMMON = set("a all an and any are as at be by can for free from if in into is it may not of on or see that the this to under use "
             "version with without work you public source code form copy file above one written following terms either".split())


def template_words(text: str) -> list[str]:
    return re.sub("[^a-z0-9]+", " ", text.lower()).strip().split(" ")


def template_bigrams(text: str) -> list[str]:
    words = template_words(text)
    return sorted({f"{a} {b}" for a, b in zip(words, words[1:])})


def template_width(text: str) -> int:
    return len(text.split("\n\n"))


def key_words(templates, threshold: float) -> list[str]:
    """Words of which every unit that matches a template has at least one.

    A match holds ``need`` of a template's n bigrams, so words that occur in more than n - need of them
    cannot all be missing. The longest words first, common ones last.
    """
    out: set[str] = set()
    for _, text in templates:
        left = set(template_bigrams(text))
        need = math.ceil(len(left) * threshold / (2 - threshold) - 1e-9)
        words = sorted(set(template_words(text)), key=lambda w: (w not in out, w in COMMON or len(w) < 3, -len(w), w))
        for w in words:
            if len(left) < need:
                break
            out.add(w)
            left = {b for b in left if w not in b.split(" ")}
    return sorted(out)


def _let(value: Column, body) -> Column:
    """Evaluate ``value`` once and use it several times in ``body``."""
    return F.element_at(F.transform(F.array(value), body), 1)


def _of_width(texts: Column, width: int) -> Column:
    return F.transform(texts, lambda t: F.struct(F.lit(width).alias("w"), t.alias("t")))


def units(text: Column, widest: int) -> Column:
    """(w, t): lines, sentences of lines of several, paragraphs (between blank lines) of several lines; runs of 2 to ``widest`` paragraphs (w)."""
    lines = F.split(text, "\n")
    sentences = F.transform(lines, lambda x: F.filter(F.split(x, r"[.!?][ \t\r]+"), lambda y: y != ""))
    paragraphs = F.split(text, r"\n[ \t\r]*\n")
    several = F.filter(paragraphs, lambda p: F.trim(p).contains("\n"))

    def runs(p: Column, w: int) -> Column:
        first = F.when(F.size(p) >= w, F.sequence(F.lit(1), F.size(p) - w + 1)).otherwise(F.array().cast("array<int>"))
        return F.transform(first, lambda i: F.struct(F.lit(w).alias("w"), F.array_join(F.slice(p, i, w), " ").alias("t")))

    single = F.concat(lines, F.flatten(F.filter(sentences, lambda s: F.size(s) > 1)), several)
    if widest < 2:
        return _of_width(single, 1)
    return F.concat(_of_width(single, 1), _let(paragraphs, lambda p: F.concat(*[runs(p, w) for w in range(2, widest + 1)])))


def unit_bigrams(unit: Column) -> Column:
    words = F.split(F.trim(F.regexp_replace(F.lower(unit), "[^a-z0-9]+", " ")), " ")
    return _let(words, lambda w: F.array_distinct(F.zip_with(
        F.slice(w, 1, F.greatest(F.size(w) - 1, F.lit(0))), F.slice(w, 2, F.greatest(F.size(w) - 1, F.lit(0))),
        lambda a, b: F.concat(a, F.lit(" "), b))))


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", templates=None,
         threshold: float = THRESHOLD) -> DataFrame:
    """One row per document: doc_id, licenses, best_license, best_dice, n_hits.

    A unit matches the template closest to it with a Dice coefficient of ``threshold`` or
    more; a part that is equally close to several (a line of a notice without its version) names them all. A line, sentence or paragraph is compared with
    every template, a run of paragraphs with the templates of several paragraphs.
    ``licenses``: ids that any unit matches, sorted, comma-joined ('' if none).
    ``best_license`` and ``best_dice``: the closest template of all units that match
    (ties: the smallest id), else null. ``n_hits``: units that match. Null and empty
    texts match nothing. Case, punctuation and letters outside a-z are as white space.
    Repeated rows each give a row; other columns are not read.
    """
    templates = [(i, t) for i, t in (templates or TEMPLATES) if template_bigrams(t)]
    known = [{"id": i, "n": len(b), "k": template_width(t), "b": b} for i, t in templates for b in [template_bigrams(t)]]
    listed = F.from_json(F.lit(json.dumps(known)), "array<struct<id: string, n: int, k: int, b: array<string>>>")
    # a little wider, so that rounding excludes no size on the bound; the coefficient itself decides
    low, high = threshold / (2 - threshold) * (1 - 1e-9), (2 - threshold) / threshold * (1 + 1e-9)
    # a unit has as many words as bigrams, plus one, or more: too short ones go before their bigrams are built
    least = min(k["n"] for k in known) * low
    longest = max(k["n"] for k in known) * high
    key = "(?<![a-z0-9])(?:" + "|".join(key_words(templates, threshold)) + ")(?![a-z0-9])"

    def matches(u: Column) -> Column:
        sized = F.filter(listed, lambda t: (F.size(u["b"]) >= t["n"] * low) & (F.size(u["b"]) <= t["n"] * high) & ((u["w"] == 1) | (t["k"] > 1)))
        scored = F.transform(sized, lambda t: F.struct(
            (F.lit(2.0) * F.size(F.array_intersect(u["b"], t["b"])) / (F.size(u["b"]) + t["n"])).alias("dice"), t["id"].alias("id")))
        near = F.filter(scored, lambda s: s["dice"] >= threshold)
        return _let(near, lambda n: F.filter(n, lambda s: s["dice"] == F.array_max(F.transform(n, lambda o: o["dice"]))))

    text = F.coalesce(F.col(f"`{text_col}`"), F.lit(""))
    nothing = F.array().cast("array<struct<w: int, t: string>>")
    found = docs.select(F.col(f"`{id_col}`").alias("doc_id"),
                        F.when(F.lower(text).rlike(key), units(text, max(k["k"] for k in known))).otherwise(nothing).alias("units"))
    found = found.select("doc_id", F.transform(
        F.filter("units", lambda u: (F.length(u["t"]) > least) & F.lower(u["t"]).rlike(key)),
        lambda u: F.struct(u["w"].alias("w"), unit_bigrams(u["t"]).alias("b"))).alias("grams"))
    found = found.select("doc_id", F.filter("grams", lambda u: (F.size(u["b"]) >= least) & (F.size(u["b"]) <= longest)).alias("grams"))
    found = found.select("doc_id", F.filter(F.transform("grams", matches), lambda m: F.size(m) > 0).alias("hits"))
    found = found.select("doc_id", F.size("hits").cast("long").alias("n_hits"), F.flatten("hits").alias("hits"))
    best = F.array_min(F.transform("hits", lambda h: F.struct((-h["dice"]).alias("dice"), h["id"].alias("id"))))
    return found.select("doc_id",
                        F.array_join(F.array_sort(F.array_distinct(F.transform("hits", lambda h: h["id"]))), ",").alias("licenses"),
                        best["id"].alias("best_license"), (-best["dice"]).alias("best_dice"), "n_hits")


def _template_values() -> str:
    return ", ".join(f"({k}, '{i}', {template_width(t)}, '{g}')" for k, (i, t) in enumerate(TEMPLATES) for g in template_bigrams(t))


# Documents of the given tables have no blank lines, but the SQL splits paragraphs all the same.
ORACLE_SQL = rf"""
WITH t(t_no, id, k, gram) AS (VALUES {_template_values()}),
tn AS (SELECT t_no, id, k, count(*) AS n FROM t GROUP BY ALL),
d AS (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS lines,
             string_split_regex(coalesce(text, ''), '\n[ \t\r]*\n') AS paras FROM documents),
u AS (SELECT doc_id, 1 AS w, unnest(lines) AS unit FROM d
      UNION ALL
      SELECT doc_id, 1, unnest(flatten(list_filter(list_transform(lines, lambda x:
                 list_filter(string_split_regex(x, '[.!?][ \t\r]+'), lambda y: y <> '')), lambda s: len(s) > 1))) FROM d
      UNION ALL
      SELECT doc_id, 1, unnest(list_filter(paras, lambda p: contains(trim(p, ' '), chr(10)))) FROM d
      UNION ALL
      SELECT doc_id, w, array_to_string(paras[i:i + w - 1], ' ')
      FROM (SELECT doc_id, paras, w, unnest(range(1, len(paras) - w + 2)) AS i
            FROM (SELECT doc_id, paras, unnest(range(2, {max(template_width(t) for _, t in TEMPLATES) + 1})) AS w FROM d))),
un AS MATERIALIZED (SELECT doc_id, w, unit, row_number() OVER () AS u_no FROM u),
g AS (SELECT doc_id, w, u_no, string_split(trim(regexp_replace(lower(unit), '[^a-z0-9]+', ' ', 'g')), ' ') AS words FROM un),
b AS (SELECT DISTINCT doc_id, w, u_no, unnest(list_transform(range(1, len(words)), lambda i: words[i] || ' ' || words[i + 1])) AS gram FROM g),
bn AS (SELECT u_no, count(*) AS n FROM b GROUP BY ALL),
m AS (SELECT b.doc_id, b.u_no, tn.id, 2.0::DOUBLE * count(*) / (any_value(bn.n) + any_value(tn.n)) AS dice
      FROM b JOIN t USING (gram) JOIN tn USING (t_no) JOIN bn ON bn.u_no = b.u_no WHERE b.w = 1 OR tn.k > 1
      GROUP BY b.doc_id, b.u_no, tn.t_no, tn.id HAVING 2.0::DOUBLE * count(*) / (any_value(bn.n) + any_value(tn.n)) >= {THRESHOLD}),
c AS (SELECT * FROM m QUALIFY dice = max(dice) OVER (PARTITION BY u_no)),
r AS (SELECT doc_id, string_agg(DISTINCT id, ',' ORDER BY id) AS licenses, arg_min(id, (-dice, id)) AS best_license,
             max(dice) AS best_dice, count(DISTINCT u_no) AS n_hits FROM c GROUP BY doc_id)
SELECT d.doc_id, coalesce(licenses, '') AS licenses, best_license, best_dice, coalesce(n_hits, 0)::BIGINT AS n_hits
FROM documents d LEFT JOIN r ON r.doc_id = d.doc_id
"""
