"""Licence scans: canonical digests of whole texts, joined to the digests of known licences.

A text is brought to one canonical form (no copyright notices, lower case, no punctuation, single blanks,
equivalent spellings, one name for the parties of the disclaimers), hashed, and looked up; lines may break
anywhere. A document is looked up as a whole and line by line, since a notice such as "Released under the
MIT License." is a whole text on a line of its own. Nothing is searched for inside a text: equal canonical
forms match, anything else does not. Known texts count with and without their titles, with any numbering of
their clauses, and with and without the appendix on how to apply them.

Defined cases: a copyright notice is one line that starts with the word or sign and goes on with ``(c)``, a
year or a name; what a notice carries on to the next line is text; a null or blank text has no licence; a text of copyright lines only is blank; repeated
rows are rows of their own; an empty table gives no rows. Columns beside id and text are not read. The
known licences are a table of any size; it is broadcast only if a check of its size allows.
"""

from __future__ import annotations

from importlib import resources

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusflow.operators.sizing import fits, skew_join

# Spellings that count as one, applied in this order to words in lower case with single blanks between them.
SPELLINGS = [
    ("licence", "license"),
    ("organisation", "organization"),
    ("sub license", "sublicense"),
    ("non infringement", "noninfringement"),
    ("merchantibility", "merchantability"),
    ("copyright owner", "copyright holder"),
    ("https ", "http "),
]
# What may follow the word copyright in the text of a licence; anything else in capitals is a name.
_PROSE = (
    "holder|owner|notice|licen[cs]e|law|act|and|or|in|of|on|to|is|as|for|with|also|interest|permission|treat|statement|"
    "disclaimer|doctrine|claim|infring|protect|material|work|right|the|that|which|shall|may|will|if|under|from"
)
COPYRIGHT = (
    r"(?m)^[ \t#*/;>-]*(?:(?i:portions[ \t]+)?(?i:copyright)(?:"
    r"[ \t:,]*(?:(?i:\(c\)|&copy;)|©|[\[<{(]?(?:\d{4}|(?i:yyyy|year)))"
    rf"|[ \t:,]+(?:(?i:by)[ \t]+)?(?!(?i:{_PROSE}))\p{{Lu}})"
    r"|(?i:\(c\))[ \t]*\d{4}|©|(?i:all rights reserved)).*$"
)
# Places where a published text names its own author or holder.
PARTIES = [
    (r"as is and .{1,100}? disclaims? all warranties", "as is and the author disclaims all warranties"),
    (r"provided by .{1,150}? as is and any", "provided by the author as is and any"),
    (r"in no event shall .{1,150}? be liable", "in no event shall the author be liable"),
    (r"neither the names? of .{1,150}? may be used to endorse", "neither the name of the author may be used to endorse"),
]

_GRANT = (
    "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted"
)
_MIT = """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:

The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.

THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."""
_ISC_END = """THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE."""
_BSD_HEAD = """Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:

1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.

2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution.
"""
_BSD_NAMES = """
3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission.
"""
_BSD_END = """
THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."""

_ZLIB = """This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable for any damages arising from the use of this software.

Permission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it and redistribute it freely, subject to the following restrictions:

1. The origin of this software must not be misrepresented; you must not claim that you wrote the original software. If you use this software in a product, an acknowledgment in the product documentation would be appreciated but is not required.

2. Altered source versions must be plainly marked as such, and must not be misrepresented as being the original software.

3. This notice may not be removed or altered from any source distribution."""
_APACHE_HEADER = """Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License. You may obtain a copy of the License at

http://www.apache.org/licenses/LICENSE-2.0

Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions and limitations under the License."""

# Public licence texts and notices (fixed values).
KNOWN = [
    ("MIT", _MIT),
    ("ISC", f"{_GRANT}, provided that the above copyright notice and this permission notice appear in all copies.\n\n{_ISC_END}"),
    ("0BSD", f"{_GRANT}.\n\n{_ISC_END}"),
    ("BSD-2-Clause", _BSD_HEAD + _BSD_END),
    ("BSD-3-Clause", _BSD_HEAD + _BSD_NAMES + _BSD_END),
    ("MIT", "Released under the MIT License."),
    ("MIT", "Licensed under the MIT License."),
    ("MIT", "SPDX-License-Identifier: MIT"),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "SPDX-License-Identifier: Apache-2.0"),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0", "SPDX-License-Identifier: GPL-3.0-only"),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC0-1.0", "Licensed under CC0 1.0."),
    ("Zlib", _ZLIB),
    ("Apache-2.0", _APACHE_HEADER),
]
# Titles that stand above the short texts, which have none of their own.
TITLES = {
    "MIT": ["MIT License", "The MIT License", "MIT License (MIT)", "The MIT License (MIT)"],
    "ISC": ["ISC License", "The ISC License", "ISC License (ISC)", "The ISC License (ISC)"],
    "0BSD": ["BSD Zero Clause License", "Zero-Clause BSD", "Zero-Clause BSD License", "BSD Zero Clause License (0BSD)"],
    "BSD-2-Clause": [
        "BSD 2-Clause License", "The BSD 2-Clause License", "The 2-Clause BSD License", "Simplified BSD License",
        "BSD 2-Clause \"Simplified\" License", "BSD License", "The BSD License",
    ],
    "BSD-3-Clause": [
        "BSD 3-Clause License", "The BSD 3-Clause License", "The 3-Clause BSD License", "New BSD License", "Modified BSD License",
        "BSD 3-Clause \"New\" or \"Revised\" License", "BSD License", "The BSD License",
    ],
    "Zlib": ["zlib License", "The zlib License", "zlib/libpng License"],
}
#: Words above this are a text that can have a title; the others are notices.
NOTICE_WORDS = 40
END = "END OF TERMS AND CONDITIONS"


def known_texts() -> list[tuple[str, str]]:
    """(license, text): every published form of the known licences and notices."""
    out = []
    for name, text in KNOWN:
        forms = [text]
        if name.startswith("BSD") or name == "Zlib":
            numbered = [("1. ", "2. ", "3. ")] + [("", "", ""), ("a. ", "b. ", "c. ")]
            forms = []
            for marks in numbered:
                form = text
                for one, other in zip(numbered[0], marks):
                    form = form.replace("\n" + one, "\n" + other)
                forms.append(form)
        titles = TITLES.get(name, []) if len(text.split()) > NOTICE_WORDS else []
        out += [(name, head + form) for form in forms for head in ["", *(f"{title}\n\n" for title in titles)]]
    for file in sorted(resources.files("corpusflow.llm").joinpath("license_texts").iterdir(), key=lambda f: f.name):
        text = file.read_text(encoding="utf-8")
        terms, end, _ = text.partition(END)
        name = file.name.removesuffix(".txt")
        out += [(name, form) for form in dict.fromkeys([text, terms + end, terms])]
    return out


def canonical(text: Column) -> Column:
    """The canonical form of a text; empty for a null."""
    out = F.lower(F.regexp_replace(F.coalesce(text, F.lit("")), COPYRIGHT, " "))
    out = F.btrim(F.regexp_replace(F.replace(out, F.lit("&"), F.lit(" and ")), r"[^\p{L}\p{N}]+", " "))
    for spelling, one in SPELLINGS:
        out = F.replace(out, F.lit(spelling), F.lit(one))
    for place, one in PARTIES:
        out = F.regexp_replace(out, place, one)
    return out


def known_digests(spark: SparkSession, known: list[tuple[str, str]] | DataFrame | None = None) -> DataFrame:
    """(digest, license): one row per canonical form; the first name in order wins a tie."""
    known = known_texts() if known is None else known
    names = known if isinstance(known, DataFrame) else spark.createDataFrame(known, "license string, text string")
    form = canonical(F.col("text"))
    rows = names.where(F.length(form) > 0).select(F.sha2(form, 256).alias("digest"), "license")
    return rows.groupBy("digest").agg(F.min("license").alias("license"))


def scan(
    docs: DataFrame, known: DataFrame | None = None, doc_id: str = "doc_id", text: str = "text"
) -> DataFrame:
    """(id, line, license): ``line`` is the number from 0 of the line that matched, or -1 for the whole text.

    Every line is hashed where its text is read; only digests are looked up, and with a list of
    licences that fits a broadcast nothing is shuffled.
    """
    known = known_digests(docs.sparkSession) if known is None else known
    content = F.col(text)
    # The whole text goes first; it counts as line -1, also where it has one line only.
    units = F.concat(F.array(content), F.split(content, "\n"))
    hashed = docs.where(content.isNotNull()).select(
        F.col(doc_id).alias("_id"), F.posexplode(F.transform(units, lambda u: F.sha2(canonical(u), 256))).alias("_at", "digest")
    )
    found = hashed.join(F.broadcast(known), "digest") if fits(known) else skew_join(hashed, known, ["digest"])
    return found.select(F.col("_id").alias(doc_id), (F.col("_at") - 1).alias("line"), "license")


def licenses_of(docs: DataFrame, known: DataFrame | None = None, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(id, license, lines): which licences each document states and on how many lines (or as a whole)."""
    found = scan(docs, known, doc_id, text)
    return found.groupBy(doc_id, "license").agg(
        F.max((F.col("line") < 0).cast("int")).cast("boolean").alias("whole"),
        F.count_if(F.col("line") >= 0).alias("lines"),
    )
