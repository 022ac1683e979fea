"""Licence scans by canonical digests.

A text is brought into a canonical form: lower case, copyright lines dropped, everything but letters and
digits read as blanks, equivalent spellings written one way.  Its SHA-256 is joined with the digests of
known licences, so a document that *is* a licence is found whatever its case, punctuation, line breaks,
holder or spelling.  The same lookup runs over the entire text of each line for one-line notices.

Only functions of Spark are used.  The licence table is stored and counted and broadcast if it is small, else
the join shuffles.  Lines are joined before they are grouped, so a document's group holds only its hits.

Defined cases.  Null texts are empty; texts and lines without letters or digits match nothing, nor do known texts of
that kind.  Texts known under several names give all names in order.  Documents are told apart by id and
text, so repeated rows and null ids are fine.  Columns that bear an output's name are replaced.
"""

from __future__ import annotations

from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidegate.llm.common import renewed, same, sized, text_or_empty

# Spellings that count as equal, in canonical words.
SPELLINGS = (
    ("acknowledgement", "acknowledgment"),
    ("analogue", "analog"),
    ("analyse", "analyze"),
    ("authorisation", "authorization"),
    ("authorised", "authorized"),
    ("cancelled", "canceled"),
    ("catalogue", "catalog"),
    ("centre", "center"),
    ("emphasised", "emphasized"),
    ("favour", "favor"),
    ("favourite", "favorite"),
    ("fulfil", "fulfill"),
    ("fulfilment", "fulfillment"),
    ("https", "http"),
    ("initialise", "initialize"),
    ("judgement", "judgment"),
    ("labelling", "labeling"),
    ("labour", "labor"),
    ("licence", "license"),
    ("licences", "licenses"),
    ("modelled", "modeled"),
    ("non  commercial", "noncommercial"),
    ("organisation", "organization"),
    ("owner", "holder"),
    ("owners", "holders"),
    ("per  cent", "percent"),
    ("practise", "practice"),
    ("programme", "program"),
    ("realise", "realize"),
    ("recognise", "recognize"),
    ("signalling", "signaling"),
    ("sub  license", "sublicense"),
    ("sub  licence", "sublicense"),
    ("sublicence", "sublicense"),
    ("utilisation", "utilization"),
    ("whilst", "while"),
    ("wilful", "willful"),
)
#: Lines that name a holder or only reserve rights, in lower case.
COPYRIGHT_LINE = r"(?m)^[^\p{L}\p{N}\n]*(portions )?(copyright\b|\(c\)|©|all rights reserved\b)[^\n]*$"
OTHER = r"[^\p{L}\p{N}\n]+"

# The texts of short public licences.
_MIT = """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files
(the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge,
publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so,
subject to the following conditions:

The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.

THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF
MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY
CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE
SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."""
_ISC = """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted,
provided that the above copyright notice and this permission notice appear in all copies.

THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF
MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY
DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION,
ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE."""
_BSD_HEAD = """Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following
conditions are met:

1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.

2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the
documentation and/or other materials provided with the distribution.
"""
_BSD_THIRD = """
3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this
software without specific prior written permission.
"""
_BSD_TAIL = """
THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT
LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT
HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT
LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY
THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF
THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."""
_ZLIB = """This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable for any
damages arising from the use of this software.

Permission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it and redistribute
it freely, subject to the following restrictions:

1. The origin of this software must not be misrepresented; you must not claim that you wrote the original software. If you use this
software in a product, an acknowledgment in the product documentation would be appreciated but is not required.
2. Altered source versions must be plainly marked as such, and must not be misrepresented as being the original software.
3. This notice may not be removed or altered from any source distribution."""
# Long texts are files named by their id; appendices on how to apply a licence may be missing in a copy of it.
TEXTS = Path(__file__).parent / "licence_texts"
END = "END OF TERMS AND CONDITIONS"


def _shipped() -> list[tuple[str, str]]:
    """Every text of ``TEXTS``, also as far as ``END``, and a line for every SPDX id."""
    found = []
    for path in sorted(TEXTS.glob("*.txt")):
        text = path.read_text(encoding="utf-8")
        found.append((path.stem, text))
        if END in text:
            found.append((path.stem, text[: text.index(END) + len(END)]))
            found.append((path.stem, text[: text.index(END)]))
    ids = (TEXTS / "spdx_ids").read_text(encoding="utf-8").split()
    return found + [(i, f"SPDX-License-Identifier: {i}") for i in ids]


KNOWN = (
    ("MIT", _MIT),
    ("MIT", "MIT License\n\n" + _MIT),
    ("MIT", "The MIT License\n\n" + _MIT),
    ("MIT", "The MIT License (MIT)\n\n" + _MIT),
    ("ISC", _ISC),
    ("ISC", "ISC License\n\n" + _ISC),
    ("BSD-2-Clause", _BSD_HEAD + _BSD_TAIL),
    ("BSD-2-Clause", "BSD 2-Clause License\n\n" + _BSD_HEAD + _BSD_TAIL),
    ("BSD-3-Clause", _BSD_HEAD + _BSD_THIRD + _BSD_TAIL),
    ("BSD-3-Clause", "BSD 3-Clause License\n\n" + _BSD_HEAD + _BSD_THIRD + _BSD_TAIL),
    ("Zlib", _ZLIB),
    ("Zlib", "zlib License\n\n" + _ZLIB),
    ("MIT", "Released under the MIT License."),
    ("MIT", "Licensed under the MIT License."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    *_shipped(),
)


def folded(text: Column) -> Column:
    """Words between pairs of blanks and line breaks; copyright lines are empty."""
    return F.regexp_replace(F.regexp_replace(F.lower(text), COPYRIGHT_LINE, ""), OTHER, "  ")


def whole(text: Column) -> Column:
    """A folded text as one line: each word between two blanks, empty if there is no word."""
    return F.trim(F.regexp_replace(text, " *\n[ \n]*", "  "))


def spelled(line: Column) -> Column:
    """The canonical form of a trimmed line of words."""
    words = F.concat(F.lit(" "), line, F.lit(" "))
    for one, other in SPELLINGS:
        words = F.replace(words, F.lit(f" {one} "), F.lit(f" {other} "))
    return F.trim(words)


def canonical(text: Column) -> Column:
    return spelled(whole(folded(text)))


def first_word(line: Column) -> Column:
    return F.substring_index(line, " ", 1)


def known_licenses(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(KNOWN, "license string, text string")


def digests(licenses: DataFrame, license_id: str = "license", text: str = "text") -> DataFrame:
    """(digest, licenses): the lookup table."""
    forms = licenses.select(F.col(license_id).alias("license"), canonical(text_or_empty(text)).alias("form")).filter("form <> ''")
    return forms.groupBy(F.sha2("form", 256).alias("digest")).agg(F.array_sort(F.collect_set("license")).alias("licenses"))


def _openings(known: DataFrame) -> DataFrame:
    """The words that a line may begin with if its canonical form is a known one: the form's own first word, or one whose spelling
    changes."""
    changed = known.sparkSession.createDataFrame([(one.split()[0],) for one, _ in SPELLINGS], "opening string")
    return known.select("opening").unionByName(changed).distinct()


def scan(docs: DataFrame, licenses: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """All columns of ``docs`` and ``digest`` (of the canonical text), ``licenses`` (what the whole text is) and
    ``notices`` (line, license: lines, from 0, that are a known text).

    A text is folded at once and then cut into lines; spelling and digest follow only for lines that begin like a known text."""
    known = sized(digests(licenses), weight=F.size("licenses"))
    forms = licenses.select(canonical(text_or_empty("text")).alias("form")).filter("form <> ''")
    openings = sized(_openings(forms.select(first_word(F.col("form")).alias("opening"))))
    known = known.select(F.col("digest").alias("known_digest"), F.col("licenses").alias("known_as"))
    source = docs.select(F.col(doc_id).alias("id"), text_or_empty(text).alias("t")).withColumn("h", F.xxhash64("t"))
    lines = source.select("id", "h", F.posexplode(F.split(folded(F.col("t")), "\n", -1)).alias("line", "one"))
    lines = lines.withColumn("one", F.trim("one")).withColumn("opening", first_word(F.col("one"))).join(openings, "opening", "left_semi")
    lines = lines.select("id", "h", "line", F.sha2(spelled(F.col("one")), 256).alias("digest"))
    hits = lines.join(known, F.col("digest") == F.col("known_digest"))
    hits = hits.select(F.col("id").alias("hit_id"), F.col("h").alias("hit_h"), F.explode(F.transform("known_as", lambda x: F.struct("line", x.alias("license")))).alias("hit"))
    by_doc = sized(hits.groupBy("hit_id", "hit_h").agg(F.array_sort(F.collect_set("hit")).alias("hits")), weight=F.size("hits"))
    full = text_or_empty(f"row.`{text}`")
    out = docs.select(F.struct("*").alias("row")).withColumn("digest", F.sha2(canonical(full), 256))
    out = out.join(known, F.col("digest") == F.col("known_digest"), "left")
    out = out.join(by_doc, same(F.col(f"row.`{doc_id}`"), F.col("hit_id")) & (F.xxhash64(full) == F.col("hit_h")), "left")
    return renewed(out, docs.columns, {
        "digest": F.col("digest"), "licenses": F.coalesce("known_as", F.array().cast("array<string>")),
        "notices": F.coalesce("hits", F.array().cast("array<struct<line: int, license: string>>")),
    })
