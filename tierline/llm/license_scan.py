"""Licence scans: whole units of text against the digests of known licences.

A unit (a whole text, a paragraph, several paragraphs in a row or a line) is brought into a
canonical form in which case, punctuation, white space, copyright lines and equivalent
spellings make no difference; its digest is then looked up. A unit counts only as a whole.

The usual licence file has a title and a copyright line above the licence's paragraphs:
these are found as paragraphs in a row, wherever in a text they begin. Canonical paragraphs
put one behind the other are the canonical form of all of them, however they are wrapped.
"""

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Spellings that mean the same, as whole words of a canonical text.
EQUIVALENT = [
    ("licence", "license"),
    ("licences", "licenses"),
    ("licenced", "licensed"),
    ("sub licence", "sublicense"),
    ("sub license", "sublicense"),
    ("non commercial", "noncommercial"),
    ("merchantibility", "merchantability"),
    ("per cent", "percent"),
    ("copyright owner", "copyright holder"),
    ("copyright owners", "copyright holders"),
    ("v2 0", "version 2 0"),
    ("v3", "version 3"),
    ("http", "https"),
]

# Public licence texts and the notices that name a licence.
KNOWN = [
    ("MIT", "Released under the MIT License."),
    ("MIT", "Licensed under the MIT License."),
    ("MIT", "This project is licensed under the MIT License."),
    (
        "MIT",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:\nThe above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.\nTHE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.",
    ),
    (
        "ISC",
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.\nTHE SOFTWARE IS PROVIDED \"AS IS\" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE.",
    ),
    (
        "0BSD",
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted.\nTHE SOFTWARE IS PROVIDED \"AS IS\" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE.",
    ),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "Released under the Apache License, Version 2.0."),
    (
        "Apache-2.0",
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License. You may obtain a copy of the License at\nhttp://www.apache.org/licenses/LICENSE-2.0\nUnless required by applicable law or agreed to in writing, software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions and limitations under the License.",
    ),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0", "Licensed under the GNU General Public License, version 3."),
    (
        "GPL-3.0-or-later",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.\nThis program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public License for more details.\nYou should have received a copy of the GNU General Public License along with this program. If not, see <https://www.gnu.org/licenses/>.",
    ),
    (
        "BSD-2-Clause",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:\n1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.\n2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution.\nTHIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS \"AS IS\" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE.",
    ),
    (
        "BSD-3-Clause",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:\n1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.\n2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution.\n3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission.\nTHIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS \"AS IS\" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE.",
    ),
    (
        "Zlib",
        "This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable for any damages arising from the use of this software.\nPermission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it and redistribute it freely, subject to the following restrictions:\n1. The origin of this software must not be misrepresented; you must not claim that you wrote the original software. If you use this software in a product, an acknowledgment in the product documentation would be appreciated but is not required.\n2. Altered source versions must be plainly marked as such, and must not be misrepresented as being the original software.\n3. This notice may not be removed or altered from any source distribution.",
    ),
    (
        "Unlicense",
        "This is free and unencumbered software released into the public domain.\nAnyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in source code form or as a compiled binary, for any purpose, commercial or non-commercial, and by any means.\nIn jurisdictions that recognize copyright laws, the author or authors of this software dedicate any and all copyright interest in the software to the public domain. We make this dedication for the benefit of the public at large and to the detriment of our heirs and successors. We intend this dedication to be an overt act of relinquishment in perpetuity of all present and future rights to this software under copyright law.\nTHE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.\nFor more information, please refer to <https://unlicense.org>",
    ),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-NC-4.0", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC-BY-SA-4.0", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."),
]

# Titles that stand above a licence's text.
TITLES = [
    ("MIT", "MIT License"),
    ("MIT", "The MIT License"),
    ("MIT", "The MIT License (MIT)"),
    ("ISC", "ISC License"),
    ("ISC", "The ISC License"),
    ("0BSD", "BSD Zero Clause License"),
    ("BSD-2-Clause", "BSD 2-Clause License"),
    ("BSD-2-Clause", "The 2-Clause BSD License"),
    ("BSD-3-Clause", "BSD 3-Clause License"),
    ("BSD-3-Clause", "The 3-Clause BSD License"),
    ("Zlib", "zlib License"),
    ("Unlicense", "The Unlicense"),
]

# Long public licences, by the first words, the length and the SHA-256 of their
# canonical form.
DIGESTS = [
    ("Apache-2.0", "apache license version 2", 9868, "94ab2db69513be8875470e3a4d39d5a437c91da93f172411d69d7552938f539a"),
    ("CC0-1.0", "creative commons legal code", 6692, "96bdc7f63190fb4bd1ae584b890300ed7517d858b34c945642a3b9b2f1612a5f"),
    ("GPL-2.0", "gnu general public license", 17117, "efe73660e5476cf0368fc0fc143f624ff9d1b73c4484b14a9969dd20c5786821"),
    ("GPL-3.0", "gnu general public license", 33409, "a8cd54d6683aa630f0b8d05d56184ad91dc486756da2df61c94d3e4e8d5ecb68"),
    ("LGPL-2.1", "gnu lesser general public", 25217, "4d55922bdeafabde164d75448bbfb0b474bf952bbb541325364010900acd9891"),
    ("LGPL-3.0", "gnu lesser general public", 7104, "aae2b222477171fb64e298e7965e768a9a6f85320646b266c94399ac029d42be"),
    ("MPL-2.0", "mozilla public license version", 14272, "3dacd2c104719e7227969cbdcc7d581518827199e830b9379627eec0a32f8ab7"),
]

#: A line that only says who holds the copyright, with or without years.
_COPYRIGHT_LINE = r"(?m)^[^\p{L}\p{N}\n(©]*(?:copyright[ \t]*(?:\(c\)|©|:|[0-9]{4}|by )|\(c\)|©|all rights reserved)[^\n]*$"

#: Between two paragraphs.
_BLANK_LINE = r"\n[ \t\r]*\n"

#: Words a licence of several paragraphs is looked for by.
HEAD_WORDS = 4


def _spelled(words: Column) -> Column:
    """Equivalent spellings as one. Words stand two blanks apart, so that of adjoining ones
    each has its own."""
    out = F.concat(F.lit("  "), F.replace(words, F.lit(" "), F.lit("  ")), F.lit("  "))
    for a, b in EQUIVALENT:
        out = F.replace(out, F.lit(f" {a} ".replace(" ", "  ")[1:-1]), F.lit(f" {b} ".replace(" ", "  ")[1:-1]))
    return F.trim(F.replace(out, F.lit("  "), F.lit(" ")))


def _has_spellings(text: Column) -> Column:
    some = F.lit(False)
    for a, _ in EQUIVALENT:
        some = some | text.contains(a)
    return some


def _without_copyright_lines(text: Column) -> Column:
    marked = text.contains("copyright") | text.contains("(c)") | text.contains("©") | text.contains("all rights reserved")
    return F.when(marked, F.regexp_replace(text, _COPYRIGHT_LINE, "")).otherwise(text)


def _words(text: Column) -> Column:
    return F.trim(F.regexp_replace(text, r"[^\p{L}\p{N}]+", " "))


def canonical(df: DataFrame, unit: str) -> DataFrame:
    """``df`` with the column ``unit`` in canonical form: lower-case words with one space
    between them.

    A copyright line begins with the sign, or with the word and a year, a sign or a name;
    a line of a wrapped licence that begins with "copyright holders" is not one. Each step
    is a projection of its own, so that none is computed twice.
    """
    text = F.col(unit)
    return (
        df.withColumn(unit, F.lower(unit))
        .withColumn(unit, _without_copyright_lines(text))
        .withColumn(unit, _words(text))
        .withColumn(unit, F.when(_has_spellings(text), _spelled(text)).otherwise(text))
    )


def _canonical_items(texts: Column) -> Column:
    """An array of texts in canonical form, those of no word left out."""
    for step in (F.lower, _without_copyright_lines, _words, lambda t: F.when(_has_spellings(t), _spelled(t)).otherwise(t)):
        texts = F.transform(texts, step)
    return F.filter(texts, lambda t: t != "")


def known_texts(spark: SparkSession, licenses: list[tuple[str, str]], titles: list[tuple[str, str]]) -> DataFrame:
    """``license``, canonical ``text`` and ``titled`` of known texts, by themselves and below
    a title; the lists' lengths bound the table."""
    # A name in a title says which licence; a text is one if it has several lines.
    below = [(name, f"{title}\n{text}", True) for name, title in titles for of, text in licenses if of == name and "\n" in text]
    texts = spark.createDataFrame([*((name, text, False) for name, text in licenses), *below], "license string, text string, titled boolean")
    return canonical(texts, "text").where("text <> ''").distinct()


def known_digests(
    spark: SparkSession, licenses: list[tuple[str, str]] = KNOWN, titles: list[tuple[str, str]] = TITLES, digests: list[tuple] = DIGESTS
) -> DataFrame:
    """``license, head, chars, digest`` of known texts, and whether they are ``titled``."""
    texts = known_texts(spark, licenses, titles)
    by_text = texts.select("license", _head(F.col("text")).alias("head"), F.length("text").alias("chars"), F.sha2("text", 256).alias("digest"), "titled")
    by_digest = spark.createDataFrame(digests, "license string, head string, chars int, digest string").withColumn("titled", F.lit(False))
    return by_text.unionByName(by_digest).distinct()


def read_licenses(spark: SparkSession, folder: str) -> list[tuple[str, str]]:
    """Licences from a folder of text files, each named after the licence: the ``licenses``
    of :func:`scan`, beside or in place of KNOWN. The folder's size bounds the list."""
    files = spark.read.text(folder, wholetext=True)
    name = F.regexp_replace(F.element_at(F.split("_metadata.file_path", "/"), -1), r"\.(txt|md)$", "")
    return [(r["name"], r["value"]) for r in files.select(F.url_decode(name).alias("name"), "value").collect()]


def _head(text: Column) -> Column:
    return F.substring_index(text, " ", HEAD_WORDS)


def _in_a_row(picked: DataFrame, known: DataFrame, whole: Column) -> DataFrame:
    """``key, license`` of every place where two or more paragraphs in a row are a known
    licence. ``whole`` is the canonical form of the whole text: only texts that have the
    first words of a licence somewhere are cut into paragraphs."""
    known = known.where((F.length("head") < F.col("chars")) & ~F.col("titled")).drop("titled")
    heads = [r["head"] for r in known.select("head").distinct().collect()]
    if not heads:
        return picked.sparkSession.createDataFrame([], picked.select("key").schema.add("license", "string"))
    some = F.lit(False)
    for head in heads:
        some = some | whole.contains(head)
    cut = picked.where(some).select("key", _canonical_items(F.split("text", _BLANK_LINE)).alias("parts")).where(F.size("parts") > 1)
    begins = F.filter(F.sequence(F.lit(1), F.size("parts")), lambda i: _head(F.get(F.col("parts"), i - 1)).isin(heads))
    begun = cut.select("key", F.explode(begins).alias("at"), "parts").select("key", F.slice("parts", F.col("at"), F.size("parts") - F.col("at") + 1).alias("parts"))
    begun = begun.select("key", "parts", _head(F.get("parts", F.lit(0))).alias("head"), F.array_join("parts", " ").alias("text"))
    met = begun.join(F.broadcast(known), "head").where(F.sha2(F.substring("text", F.lit(1), F.col("chars")), 256) == F.col("digest"))
    # The licence ends where a paragraph ends, after the first one.
    ends = F.exists(F.sequence(F.lit(2), F.greatest(F.size("parts"), F.lit(2))), lambda n: F.length(F.array_join(F.slice("parts", F.lit(1), n), " ")) == F.col("chars"))
    return met.where((F.size("parts") > 1) & ends).select("key", "license")


def scan(df: DataFrame, licenses: list[tuple[str, str]] = KNOWN, key: str = "doc_id", text: str = "text", titles: list[tuple[str, str]] = TITLES, digests: list[tuple] = DIGESTS) -> DataFrame:
    """One row per document, licence and kind of unit found: ``key, license, unit, n``.

    ``unit`` is ``text`` (the whole text is the licence, with or without a title),
    ``paragraph`` (one of several parts between blank lines is, over several lines),
    ``paragraphs`` (two or more parts in a row are) or ``line``; ``n`` counts them.
    Documents without any, null and empty texts give no row. Repeated rows of a document
    add up in ``n``. Other columns are left out.
    """
    picked = df.select(df[key].alias("key"), df[text].cast("string").alias("text")).where("text is not null")
    paragraphs = F.filter(F.split("text", _BLANK_LINE), lambda p: p.contains("\n"))
    lines = F.split("text", "\n")

    def tagged(units: Column, name: str) -> Column:
        return F.transform(units, lambda u: F.struct(F.lit(name).alias("unit"), u.alias("text")))

    units = F.concat(
        F.array(F.struct(F.lit("text").alias("unit"), F.col("text"))),
        F.when(F.size(F.split("text", _BLANK_LINE)) > 1, tagged(paragraphs, "paragraph")).otherwise(F.array().cast("array<struct<unit:string,text:string>>")),
        F.when(F.size(lines) > 1, tagged(lines, "line")).otherwise(F.array().cast("array<struct<unit:string,text:string>>")),
    )
    every = picked.select("key", F.explode(units).alias("u")).select("key", "u.unit", "u.text")
    # Never null: a filter for that, put before the join, would compute all of it again.
    every = canonical(every, "text").select("key", "unit", F.coalesce(F.sha2("text", 256), F.lit("")).alias("digest"))
    known = known_digests(df.sparkSession, licenses, titles, digests)
    found = every.join(F.broadcast(known.select("license", "digest").distinct()), "digest").select("key", "license", "unit")
    several = picked.where(F.col("text").rlike(_BLANK_LINE)).withColumn("whole", F.col("text"))
    rows = _in_a_row(canonical(several, "whole"), known, F.col("whole")).withColumn("unit", F.lit("paragraphs"))
    return found.unionByName(rows).groupBy(F.col("key").alias(key), "license", "unit").agg(F.count(F.lit(1)).alias("n"))
