"""Licence scan by canonical digest, in DataFrame operations only.

A text is brought into a canonical form - lower case, no copyright lines, one spelling
for equivalent words, no punctuation, single spaces - and the SHA-256 digest of the whole
form is joined to the digests of known licences, which the same expressions make from
the texts in KNOWN and in the files of texts/ (whole licences, named by id up to an
underscore). Texts that differ only in what the canonical form drops are equal. Where a
licence follows a copyright notice on the notice's own line, the line is dropped from the
digest given out, and the licence is looked up by a second form without the notice alone.

A document may also hold a licence's entire text on a line of its own, such as the usual
one-sentence notices. Lines with one of the words that all known texts of one line have
(MARKS) are digested in the same way and looked up in the same digests, which by then are
a constant of the plan: license_lines names the licences found so.

Defined cases: a null text is an empty one; an empty canonical form matches nothing; a
text that several ids share gets the first of them; extra columns play no part.
"""

from __future__ import annotations

from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tablewright.llm.common import LOWER, UPPER

#: Licence texts and usual notices, by id.
KNOWN = [
    ("MIT", """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software. THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."""),
    ("ISC", """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies. THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE."""),
    ("0BSD", """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted. THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE."""),
    ("BSD-2-Clause", """Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution. THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."""),
    ("BSD-3-Clause", """Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution. 3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission. THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."""),
    ("Zlib", """This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable for any damages arising from the use of this software. Permission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it and redistribute it freely, subject to the following restrictions: 1. The origin of this software must not be misrepresented; you must not claim that you wrote the original software. If you use this software in a product, an acknowledgment in the product documentation would be appreciated but is not required. 2. Altered source versions must be plainly marked as such, and must not be misrepresented as being the original software. 3. This notice may not be removed or altered from any source distribution."""),
    ("Apache-2.0", """Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions and limitations under the License."""),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("MIT", "Released under the MIT License."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
]
#: Spellings held to be equal, after lower-casing, as pattern and replacement.
SPELLINGS = [
    (r"licence", "license"),
    (r"\bsub[- ]license", "sublicense"),
    (r"\bnon[- ]?infringement", "noninfringement"),
    (r"acknowledgement", "acknowledgment"),
    (r"organis|organiz", "organiz"),
    (r"favour", "favor"),
    (r"authoris", "authoriz"),
    (r"merchantib|merchantab", "merchantab"),
    (r"per cent|%", "percent"),
    (r"https?://", "http "),
]
#: Titles that stand above a licence's own words, and lines that name a holder: whole lines, dropped.
COPYRIGHT_LINE = r"(?md)^[^a-z\n]*(copyright[ \t]*(\(c\)|©|[0-9]|holder:|by )|\(c\)|©|all rights reserved)[^\n]*$"
TITLE_LINE = r"(?md)^[ \t]*(the )?((mit|isc|zlib|bsd [023]-clause|bsd zero clause|(simplified|new|modified) bsd) license)( \(.*\))?[ \t\r]*$"
#: First words of short licences and notices, and a notice of a holder (behind a title or not) that one of them follows on its line.
OPENINGS = r"permission is hereby granted|permission to use, copy|redistribution and use in|this software is provided 'as-is'|licensed under|released under|this work is licensed|boost software license|this font software is licensed"
NOTICE = COPYRIGHT_LINE.replace("^[^a-z\\n]*", r"^[^a-z\n]*(?:(?:the )?(?:mit|isc|zlib|bsd [023]-clause|bsd zero clause|(?:simplified|new|modified) bsd) license[^a-z\n]*)?").replace("[^\\n]*$", rf"[^\n]*?\b(?={OPENINGS})")
#: The line that ends the terms of a licence; what comes after tells how to apply it and may be left out.
END_OF_TERMS = "END OF TERMS AND CONDITIONS"
#: What isn't a letter, digit or other non-ASCII sign, and typographic signs.
PUNCTUATION = r"[\x00-\x2F\x3A-\x60\x7B-\x7F ‐-―‘-‟•…]+"


def canonical(text: Column) -> Column:
    """The canonical form of a text; null gives the empty form."""
    out = F.translate(F.coalesce(text, F.lit("")), UPPER, LOWER)
    for pattern in (COPYRIGHT_LINE, TITLE_LINE):
        out = F.regexp_replace(out, pattern, "")
    for pattern, replacement in SPELLINGS:
        out = F.regexp_replace(out, pattern, replacement)
    return F.trim(F.regexp_replace(out, PUNCTUATION, " "))


def digest(text: Column) -> Column:
    """SHA-256 of the canonical form, in lower-case hexadecimal digits."""
    return F.sha2(canonical(text).cast("binary"), 256)


def digest_behind_notice(text: Column) -> Column:
    """The digest without the notices that a licence follows on one line; null where there are none."""
    lower = F.translate(text, UPPER, LOWER)
    there = (lower.contains("copyright") | lower.contains("(c)") | lower.contains("©")) & lower.rlike(NOTICE)
    return F.when(there, digest(F.regexp_replace(lower, NOTICE, "")))


#: Words of which a line must have one to be looked up; every known text that could stand on one line has one.
MARKS = r"licen[cs]e|permission|redistribution|warrant|copyright|public domain|software"


def line_licenses(text: Column, ids: dict[str, str]) -> Column:
    """The sorted ids of licences whose entire text is a line of the text; ids by digest."""
    if not ids:
        return F.array().cast("array<string>")
    known = F.create_map(*[F.lit(x) for pair in sorted(ids.items()) for x in pair])
    lines = F.filter(F.split(F.translate(F.coalesce(text, F.lit("")), UPPER, LOWER), "\n"), lambda x: x.rlike(MARKS))
    return F.array_sort(F.array_distinct(F.array_compact(F.transform(lines, lambda x: F.try_element_at(known, digest(x))))))


def whole_licenses() -> list[tuple[str, str]]:
    """(id, text) of the files of texts/, each also without what follows its terms, and all of these also on one line (where no notice is a line to drop)."""
    out = []
    for path in sorted((Path(__file__).parent / "texts").glob("*.txt")):
        name, text = path.stem.split("_")[0], path.read_text("utf-8")
        out.append((name, text))
        if END_OF_TERMS in text:
            out.append((name, text[: text.index(END_OF_TERMS) + len(END_OF_TERMS)]))
    return out + [(name, " ".join(text.split())) for name, text in out]


def known_digests(spark: SparkSession, known: list[tuple[str, str]] | None = None) -> DataFrame:
    """(digest, license_id), one row a digest; as many rows as known (KNOWN and whole_licenses() unless given) has at most."""
    known = KNOWN + whole_licenses() if known is None else known
    rows = spark.createDataFrame(known, "license_id string, text string").filter(canonical(F.col("text")) != "")
    return rows.groupBy(digest(F.col("text")).alias("digest")).agg(F.min("license_id").alias("license_id"))


def scanned(docs: DataFrame, known: list[tuple[str, str]] | None = None) -> DataFrame:
    """Per row of docs: doc_id, digest, license_id (null: none known), is_license, and license_lines, the ids of licences that lines of the text are."""
    # texts of this module or of a caller on the driver; what is broadcast are their digests, a few kilobytes
    ids = known_digests(docs.sparkSession, known)
    second = F.broadcast(ids.select(F.col("digest").alias("second"), F.col("license_id").alias("second_id")))
    by_digest = {r.digest: r.license_id for r in ids.collect()}  # as many as texts known, about a hundred
    rows = docs.select("doc_id", digest(F.col("text")).alias("digest"), digest_behind_notice(F.col("text")).alias("second"), line_licenses(F.col("text"), by_digest).alias("license_lines"))
    found = rows.join(F.broadcast(ids), "digest", "left").join(second, "second", "left").withColumn("license_id", F.coalesce("license_id", "second_id"))
    return found.select("doc_id", "digest", "license_id", F.col("license_id").isNotNull().alias("is_license"), "license_lines")
