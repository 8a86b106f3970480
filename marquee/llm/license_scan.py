"""Op 10, licence scans with DataFrame functions only.

Text is normalised (lower case, runs of anything but letters and digits are one space) and compared with licence templates
by the Dice coefficient of distinct word bigrams. A unit is a window of as many words as the template has, wherever in
the text it begins with one of the template's bigrams, so a notice inside a line, a licence wrapped over lines or behind
comment marks, and one amid other text are all found.

Two bounds prune the templates. A window that reaches the least Dice value shares a known number of the template's bigrams
(size bounds), so it has one of any subset that leaves fewer out: the longest bigrams of each template, which prose
rarely has, are the anchors, and a text without any is done. And a template of which a text holds too few different
bigrams has no window. Row by row, so nothing is shuffled.
"""

from __future__ import annotations

import math
import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from marquee.llm.common import table

#: Least Dice coefficient of a match.
MIN_DICE = 0.75

#: Notices and licence texts, by SPDX identifier.
TEMPLATES: tuple[tuple[str, str], ...] = (
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0"),
    ("Apache-2.0", "Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions and limitations under the License."),
    ("BSD-2-Clause", "This software is released under the BSD 2-Clause License."),
    ("BSD-2-Clause", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution. THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS \"AS IS\" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."),
    ("BSD-3-Clause", "This software is released under the BSD 3-Clause License."),
    ("BSD-3-Clause", "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission."),
    ("BSL-1.0", "Distributed under the Boost Software License, Version 1.0. (See accompanying file LICENSE_1_0.txt or copy at https://www.boost.org/LICENSE_1_0.txt)"),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC0-1.0", "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work."),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."),
    ("AGPL-3.0", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."),
    ("LGPL-2.1", "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation; either version 2.1 of the License, or (at your option) any later version."),
    ("ISC", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies."),
    ("MIT", "Released under the MIT License."),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software. THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/."),
    ("Unlicense", "This is free and unencumbered software released into the public domain."),
    ("Zlib", "This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable for any damages arising from the use of this software. Permission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it and redistribute it freely, subject to the following restrictions: 1. The origin of this software must not be misrepresented; you must not claim that you wrote the original software. If you use this software in a product, an acknowledgment in the product documentation would be appreciated but is not required. 2. Altered source versions must be plainly marked as such, and must not be misrepresented as being the original software. 3. This notice may not be removed or altered from any source distribution."),
)


def template_words(text: str) -> list[str]:
    return re.sub(r"[\W_]+", " ", text.lower()).split()


def template_bigrams(text: str) -> list[str]:
    words = template_words(text)
    return list(dict.fromkeys(f"{a} {b}" for a, b in zip(words, words[1:])))


def templates_from(spark: SparkSession, folder: str) -> tuple[tuple[str, str], ...]:
    """Templates of a folder of licence texts, one file each, named by the file. The texts come to the driver, as those
    above: they are the query, not the data."""
    rows = spark.read.text(folder, wholetext=True).select(F.element_at(F.split(F.input_file_name(), "/"), -1).alias("name"), "value").collect()
    return tuple(sorted((re.sub(r"\.txt$", "", r["name"]), r["value"]) for r in rows))


def least_shared(size: int, min_dice: float = MIN_DICE) -> int:
    """Bigrams that a set must share with ``size`` bigrams to reach ``min_dice`` at all: with c of them it has at least c,
    and 2 c / (c + size) at best."""
    return next(c for c in range(1, size + 1) if 2 * c >= min_dice * (c + size))


def anchors(grams: list[str], min_dice: float = MIN_DICE) -> list[str]:
    """The longest bigrams of a template, as many as no matching window can do without."""
    return sorted(grams, key=lambda g: (-len(g), g))[: len(grams) - least_shared(len(grams), min_dice) + 1]


def _list(values: list[str]) -> Column:
    return F.split(F.lit("\n".join(values)), "\n")


def _templates(templates, min_dice: float) -> Column:
    rows = []
    for name, text in templates:
        grams = template_bigrams(text)
        rows.append(F.struct(F.lit(name).alias("license"), F.lit(len(template_words(text)) - 1).alias("length"), F.lit(least_shared(len(grams), min_dice)).alias("least"), _list(grams).alias("grams")))
    return F.array(*rows)


def scan_licenses(docs: DataFrame, templates=TEMPLATES, min_dice: float = MIN_DICE, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: doc_id, license (the best match or null), dice, start (number of the window's first word, from
    0), licenses (all names that match, in order, comma-joined; empty without any).

    The best match has the highest Dice value, then the last name in order, then the first place. Null, empty and
    one-word texts match nothing. Repeated rows are judged alike; other columns are not read. Templates have two words
    or more.
    """
    every = [template_bigrams(t) for _, t in templates]
    known = sorted(set().union(*every))
    rare = sorted(set().union(*[anchors(g, min_dice) for g in every]))
    clean = F.regexp_replace(F.lower(F.coalesce(F.col(text_col).cast("string"), F.lit(""))), r"[^\p{L}\p{N}]+", " ")
    rows = docs.select(F.col(id_col).alias("doc_id"), F.split(F.trim(clean), " ").alias("words"))
    pairs = F.zip_with(F.slice("words", 1, F.size("words") - 1), F.slice("words", 2, F.size("words") - 1), lambda a, b: F.concat(a, F.lit(" "), b))
    rows = rows.select("doc_id", F.when(F.size("words") > 1, pairs).otherwise(F.array().cast("array<string>")).alias("grams"))
    rows = rows.withColumn("anchored", F.exists("grams", lambda g: g.isin(rare)))
    places = F.filter(F.transform("grams", lambda g, at: F.when(g.isin(known), at)), lambda at: at.isNotNull())
    rows = rows.withColumn("hits", F.when(F.col("anchored"), places).otherwise(F.array().cast("array<int>")))
    gram = lambda at: F.element_at("grams", at + 1)

    def best_window(t):
        own = F.filter("hits", lambda at: F.array_contains(t["grams"], gram(at)))
        enough = F.size(F.array_distinct(F.transform(own, gram))) >= t["least"]

        def window(at):
            part = F.array_distinct(F.slice("grams", at + 1, t["length"]))
            dice = F.lit(2.0) * F.size(F.array_intersect(part, t["grams"])) / (F.size(part) + F.size(t["grams"]))
            return F.struct(dice.alias("dice"), t["license"].alias("license"), (-at).alias("back"))

        return F.when(enough, F.array_max(F.filter(F.transform(own, window), lambda m: m["dice"] >= min_dice)))

    found = F.filter(F.transform(_templates(templates, min_dice), best_window), lambda m: m.isNotNull())
    rows = rows.withColumn("found", F.when(F.size("hits") > 0, found))
    best = F.array_max("found")
    names = F.array_join(F.array_sort(F.array_distinct(F.transform("found", lambda m: m["license"]))), ",")
    return rows.select("doc_id", best["license"].alias("license"), best["dice"].alias("dice"), (-best["back"]).cast("int").alias("start"), F.coalesce(names, F.lit("")).alias("licenses"))


def op10(spark, sf_dir: str) -> DataFrame:
    return scan_licenses(table(spark, sf_dir, "documents", "doc_id", "text"))


def _sql_list(grams: list[str]) -> str:
    return "[" + ", ".join("'" + g.replace("'", "''") + "'" for g in grams) + "]"


def oracle(templates=TEMPLATES, min_dice: float = MIN_DICE) -> str:
    values = ", ".join(f"('{name}', {len(template_words(text)) - 1}, {_sql_list(template_bigrams(text))})" for name, text in templates)
    return f"""
WITH template(license, size, grams) AS (VALUES {values}),
clean AS (SELECT doc_id, list_filter(string_split(regexp_replace(lower(coalesce(text, '')), '[^\\p{{L}}\\p{{N}}]+', ' ', 'g'), ' '), lambda x: x <> '') AS w FROM documents),
doc AS (SELECT doc_id, list_transform(generate_series(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1]) AS g FROM clean WHERE len(w) > 1),
place AS (SELECT doc_id, unnest(g) AS gram, unnest(generate_series(1, len(g))) AS i FROM doc),
owner AS (SELECT license, size, grams, unnest(grams) AS gram FROM template),
win AS (
  SELECT p.doc_id, i, license, grams, list_distinct(list_slice(doc.g, i, i + size - 1)) AS part
  FROM place p JOIN owner o ON o.gram = p.gram JOIN doc ON doc.doc_id = p.doc_id),
dice AS (SELECT doc_id, i - 1 AS start, license, 2.0 * len(list_intersect(part, grams)) / (len(part) + len(grams)) AS dice FROM win),
hit AS (
  SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY dice DESC, license DESC, start) AS k FROM dice WHERE dice >= {min_dice}),
total AS (SELECT doc_id, string_agg(license, ',' ORDER BY license) AS licenses FROM (SELECT DISTINCT doc_id, license FROM hit) GROUP BY doc_id)
SELECT documents.doc_id, license, CAST(dice AS DOUBLE) AS dice, CAST(start AS INTEGER) AS start, coalesce(licenses, '') AS licenses
FROM documents LEFT JOIN hit ON hit.doc_id = documents.doc_id AND k = 1 LEFT JOIN total ON total.doc_id = documents.doc_id
"""
