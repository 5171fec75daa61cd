"""License scans by canonical digest: a text is normalised, and its SHA-256 looked up among known licence digests.

Canonical form: lower case; copyright lines go; anything but letters and digits parts words; equivalent spellings become
one; "all rights reserved" goes; words are joined by one blank. Entire texts are hash-joined to the known licences;
entire lines are looked up among the known notices in the same way, by digest. Notices of several lines are looked for
by their canonical words, however they are wrapped or marked as a comment.
"""

from __future__ import annotations

import json
import re
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import documents

#: Known licences up to this number are broadcast (a row of under 200 bytes each); more are joined by shuffle.
MAX_BROADCAST = 10_000
#: One-line notices up to this number are a literal map that lines of a notice's length look up; more are joined to the lines.
MAX_LITERAL = 1_000
#: Notices of several lines that one expression takes out of a text; more take several, one behind the other.
INSIDE_AT_ONCE = 1_000

# Spellings that licence matching treats as equal (from -> to), after the SPDX matching guidelines.
SPELLINGS = {
    "acknowledgement": "acknowledgment",
    "analyse": "analyze",
    "artefact": "artifact",
    "authorisation": "authorization",
    "authorised": "authorized",
    "centre": "center",
    "favour": "favor",
    "fulfil": "fulfill",
    "initialise": "initialize",
    "judgement": "judgment",
    "labour": "labor",
    "licence": "license",
    "licences": "licenses",
    "licenced": "licensed",
    "noncommercial": "non  commercial",
    "optimise": "optimize",
    "organisation": "organization",
    "organise": "organize",
    "practise": "practice",
    "programme": "program",
    "recognise": "recognize",
    "sublicence": "sublicense",
    "sub  license": "sublicense",
    "whilst": "while",
    "wilful": "willful",
    "https": "http",
}

_COPYRIGHT = r"\n[^\p{L}\p{N}\n©(]*(?:copyright[ \t:]*(?:\(c\)|©)|(?:\(c\)|©)[ \t]*copyright|©|\(c\)[ \t]*[<\[{]?(?:year|19|20)|copyright[ \t:]*(?:by[ \t]+)?[<\[{]?(?:year|19[0-9][0-9]|20[0-9][0-9]))[^\n]*"
_APART = r"[^\p{L}\p{N}\n]+"

_BSD_HEAD = """Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:
1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.
2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution.
"""
_BSD_THIRD = "3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission.\n"
_BSD_TAIL = """THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."""
_ISC_GRANT = "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted"
_ISC_TAIL = 'THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE.'
_MIT_BODY = """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:
The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.
THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."""

# Public licence texts and notices (name, text). The operator takes any other table of them.
KNOWN: list[tuple[str, str]] = [
    ("MIT", _MIT_BODY),
    ("MIT", "MIT License\n" + _MIT_BODY),
    ("MIT", "The MIT License (MIT)\n" + _MIT_BODY),
    ("BSD-2-Clause", _BSD_HEAD + _BSD_TAIL),
    ("BSD-2-Clause", "BSD 2-Clause License\n" + _BSD_HEAD + _BSD_TAIL),
    ("BSD-3-Clause", _BSD_HEAD + _BSD_THIRD + _BSD_TAIL),
    ("BSD-3-Clause", "BSD 3-Clause License\n" + _BSD_HEAD + _BSD_THIRD + _BSD_TAIL),
    ("ISC", _ISC_GRANT + ", provided that the above copyright notice and this permission notice appear in all copies.\n" + _ISC_TAIL),
    ("ISC", "ISC License\n" + _ISC_GRANT + ", provided that the above copyright notice and this permission notice appear in all copies.\n" + _ISC_TAIL),
    ("0BSD", _ISC_GRANT + ".\n" + _ISC_TAIL),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License. You may obtain a copy of the License at\nhttp://www.apache.org/licenses/LICENSE-2.0\nUnless required by applicable law or agreed to in writing, software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions and limitations under the License."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("MIT", "Licensed under the MIT License."),
    ("MIT", "Released under the MIT License."),
]

#: Full licence texts and standard notices, a JSON object (licence, form: text or notice, text) a line.
DATA = Path(__file__).with_name("licences.jsonl")
#: A text with a notice of several lines has one of these words; others are not searched.
ANCHORS = ("license", "permission", "redistribution")
_FRANKLIN = r"51 Franklin St(?:reet)?, Fifth Floor, Boston,? MA\s+02110-1301\s+USA"
# What the Free Software Foundation has printed in place of that address.
_ADDRESSES = ("51 Franklin St, Fifth Floor, Boston, MA 02110-1301 USA", "51 Franklin Street, Fifth Floor, Boston, MA 02110-1301 USA", "59 Temple Place, Suite 330, Boston, MA 02111-1307 USA", "675 Mass Ave, Cambridge, MA 02139, USA")


def _variants(text: str) -> set[str]:
    """``text`` with and without its appendix and the line that ends the terms, and with each address of its publisher."""
    cut = re.split(r"\n[ \t]*(?:APPENDIX|Appendix|ADDENDUM)?:?[ \t]*How to (?:Apply|apply|use)[^\n]*\n", text)[0]
    made = {text, cut, re.sub(r"\n[ \t]*END OF TERMS AND CONDITIONS\s*$", "\n", cut)}
    for old in list(made):
        made |= {re.sub(_FRANKLIN, new, old) for new in _ADDRESSES}
        site = re.sub(r"write\s+to\s+the\s+Free\s+Software\s+Foundation,\s+Inc\.,\s+" + _FRANKLIN, "see <https://www.gnu.org/licenses/>", old)
        site = re.sub(_FRANKLIN, "<https://fsf.org/>", site)
        made |= {site, site.replace("Ty Coon", "Moe Ghoul")}
    return made


def known_texts() -> list[tuple[str, str, bool]]:
    """(licence, text, whether it is looked for inside of texts): KNOWN, DATA and the SPDX tags of their licences."""
    rows = [json.loads(line) for line in DATA.read_text("utf-8").splitlines()]
    found = [(name, text, False) for name, text in KNOWN]
    found += [(r["licence"], text, r["form"] == "notice") for r in rows for text in sorted(_variants(r["text"]))]
    return found + [(name, f"SPDX-License-Identifier: {name}", False) for name in sorted({n for n, _, _ in found})]


def canonical_lines(text: str) -> str:
    """SQL (Spark) for the canonical words with line breaks left, each word between blanks of its own."""
    low = f"concat('\\n', lower(coalesce({text}, '')))"
    bare = f"regexp_replace({low}, r'{_COPYRIGHT}', '\\n')"
    apart = f"concat(' ', replace(regexp_replace({bare}, r'{_APART}', '  '), '\\n', ' \\n '), ' ')"
    for old, new in SPELLINGS.items():
        apart = f"replace({apart}, ' {old} ', ' {new} ')"
    return f"replace({apart}, ' all  rights  reserved ', ' ')"


def words(lines: str) -> str:
    """SQL for canonical words joined by one blank."""
    return f"trim(regexp_replace({lines}, '[ \\n]+', ' '))"


def digest(lines: str) -> str:
    """SQL for the SHA-256 of canonical words joined by one blank."""
    return f"sha2({words(lines)}, 256)"


def with_digests(df: DataFrame, text_col: str, lengths: list[int] | None = None) -> DataFrame:
    """``df``, __words between blanks, __digest of the entire text, and __lines: digests of its lines that have words, of these lengths in words' characters if given."""
    marked = df.withColumn("__c", F.expr(canonical_lines(f"`{text_col}`")))
    lines = f"transform(filter(split(__c, '\\n'), l -> trim(l) <> ''), l -> {words('l')})"
    wanted = "" if lengths is None else f" AND length(w) IN ({', '.join(map(str, lengths or [-1]))})"
    lines = f"transform(filter({lines}, w -> w <> ''{wanted}), w -> sha2(w, 256))"
    marked = marked.withColumn("__words", F.expr(f"concat(' ', {words('__c')}, ' ')"))
    return marked.withColumn("__digest", F.expr("sha2(trim(__words), 256)")).withColumn("__lines", F.expr(lines)).drop("__c")


def known_licences(spark: SparkSession, known: list[tuple[str, str]] | None = None) -> DataFrame:
    """(licence, digest, notice, words, size): size in characters of its canonical words; notice is true where the text is one line; a digest has one name, the least.

    words are the canonical words of a notice that is looked for inside of texts, null for the others.
    """
    given = [(n, t, False) for n, t in known] if known is not None else known_texts()
    rows = spark.createDataFrame(given, "licence string, body string, inside boolean")
    rows = rows.withColumn("words", F.expr(f"IF(inside, concat(' ', {words(canonical_lines('body'))}, ' '), NULL)"))
    size = F.length(F.trim("__words")).alias("size")
    made = with_digests(rows, "body").select("licence", F.col("__digest").alias("digest"), (F.size("__lines") == 1).alias("notice"), "words", size)
    return made.groupBy("digest").agg(F.min("licence").alias("licence"), F.max("notice").alias("notice"), F.max("words").alias("words"), F.max("size").alias("size"))


def scan(docs: DataFrame, known: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id_col, digest, licence, notices): a row per row of ``docs``.

    licence is the known licence that the entire text is, null if none; notices the array of known one-line notices, a name
    for each line that is one, in order, then the names not yet there of notices of several lines inside a text that is
    no known licence as a whole, longest first; words of a longer one are not read as a shorter one. Null text and text without words have the digest of the empty text, which is
    no licence unless a known text is empty. Repeated rows get equal results. An empty table gives none. Other columns
    are not read. Whole texts are looked at, however long.
    """
    counted = known.count()
    lines = known.filter("notice")
    few = lines.limit(MAX_LITERAL + 1).count() <= MAX_LITERAL
    notices = [(r["digest"], r["licence"], r["size"]) for r in lines.collect()] if few else []
    texts = docs.select(F.col(id_col).alias("__id"), F.col(text_col).alias("__text"))
    rows = with_digests(texts, "__text", sorted({n for _, _, n in notices}) if few else None)
    if few:
        table = F.create_map(*[F.lit(x) for d, n, _ in notices for x in (d, n)]) if notices else F.expr("cast(map() as map<string,string>)")
        rows = rows.withColumn("__found", F.filter(F.transform("__lines", lambda d: F.element_at(table, d)), lambda n: n.isNotNull()))
    else:
        rows = _joined_notices(rows, lines)
    rows = _inside(rows, known.filter("words IS NOT NULL")).drop("__words", "__lines")
    right = known.select(F.col("digest").alias("__digest"), "licence")
    right = F.broadcast(right) if counted <= MAX_BROADCAST else right
    both = F.expr("IF(licence IS NULL AND size(__inside) > 0, concat(__found, array_except(__inside, __found)), __found)")
    return rows.join(right, "__digest", "left").select(F.col("__id").alias(id_col), F.col("__digest").alias("digest"), "licence", both.alias("notices"))


def _joined_notices(rows: DataFrame, notices: DataFrame) -> DataFrame:
    """``rows`` and __found, by a join of the lines' digests: once for each different text, whose key the rows then look up."""
    keyed = rows.withColumn("__key", F.sha2(F.array_join("__lines", ","), 256))
    right = notices.select(F.col("digest").alias("__d"), F.col("licence").alias("__n"))
    each = keyed.select("__key", "__lines").distinct().select("__key", F.posexplode("__lines").alias("__at", "__d")).join(right, "__d")
    # a text's notices are no more than its lines
    found = each.groupBy("__key").agg(F.array_sort(F.collect_list(F.struct("__at", "__n"))).alias("__f")).select("__key", F.col("__f.__n").alias("__found"))
    return keyed.join(found, "__key", "left").withColumn("__found", F.coalesce("__found", F.expr("cast(array() as array<string>)"))).drop("__key")


def _inside(rows: DataFrame, known: DataFrame) -> DataFrame:
    """``rows`` and __inside: names of the notices (words, licence) that lie inside __words; each is taken out before the next, shorter one is looked for."""
    none = F.expr("cast(array() as array<string>)")
    notices = sorted(((r["words"], r["licence"]) for r in known.select("words", "licence").collect()), key=lambda x: (-len(x[0]), x[0]))
    rows = rows.withColumn("__st", F.struct(F.col("__words").alias("left"), none.alias("names")))
    asked = F.expr(" OR ".join(f"contains(__words, ' {a} ')" for a in ANCHORS))
    step = lambda st, n: F.when(
        F.contains(st["left"], n["words"]), F.struct(F.replace(st["left"], n["words"], F.lit(" \n ")).alias("left"), F.concat(st["names"], F.array(n["name"])).alias("names"))
    ).otherwise(st)
    for at in range(0, len(notices), INSIDE_AT_ONCE):
        table = F.array(*[F.struct(F.lit(w).alias("words"), F.lit(n).alias("name")) for w, n in notices[at : at + INSIDE_AT_ONCE]])
        rows = rows.withColumn("__st", F.when(asked, F.aggregate(table, F.col("__st"), step)).otherwise(F.col("__st")))
    return rows.withColumn("__inside", F.col("__st.names")).drop("__st")


def op10_licence_digest(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = scan(documents(spark, sf_dir), known_licences(spark))
    return found.select("doc_id", "digest", "licence", F.array_join("notices", ",").alias("notices"))


def _duck_canonical(text: str) -> str:
    low = f"chr(10) || lower(coalesce({text}, ''))"
    bare = f"regexp_replace({low}, '{_COPYRIGHT}', chr(10), 'g')"
    apart = f"' ' || replace(regexp_replace({bare}, '{_APART}', '  ', 'g'), chr(10), ' ' || chr(10) || ' ') || ' '"
    for old, new in SPELLINGS.items():
        apart = f"replace({apart}, ' {old} ', ' {new} ')"
    return f"replace({apart}, ' all  rights  reserved ', ' ')"


def _duck_digest(words: str) -> str:
    return f"sha256(trim(regexp_replace({words}, '[ \\n]+', ' ', 'g')))"


def op10_sql() -> str:
    quote = lambda s: "'" + s.replace("'", "''") + "'"
    values = ", ".join(f"({quote(n)}, {quote(t)})" for n, t in KNOWN)
    return f"""
WITH known AS (
  SELECT digest, min(licence) AS licence, max(notice) AS notice FROM (
    SELECT licence, {_duck_digest('c')} AS digest, len(list_filter(string_split(c, chr(10)), lambda l: trim(l) <> '')) = 1 AS notice
    FROM (SELECT licence, {_duck_canonical('body')} AS c FROM (VALUES {values}) v(licence, body))
  ) GROUP BY digest
), notice AS (SELECT map(list(digest), list(licence)) AS m FROM known WHERE notice),
canon AS (SELECT doc_id, {_duck_canonical('text')} AS c FROM documents),
rows AS (
  SELECT doc_id, {_duck_digest('c')} AS digest,
         list_transform(list_filter(string_split(c, chr(10)), lambda l: trim(l) <> ''), lambda l: {_duck_digest('l')}) AS lines
  FROM canon
)
SELECT doc_id, r.digest AS digest, k.licence AS licence,
       coalesce(array_to_string(list_filter(list_transform(lines, lambda d: m[d]), lambda n: n IS NOT NULL), ','), '') AS notices
FROM rows r CROSS JOIN notice LEFT JOIN known k ON k.digest = r.digest
"""
