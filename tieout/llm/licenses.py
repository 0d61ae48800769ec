"""License scans: whole texts looked up by the digest of their canonical form.

A text is brought to canonical form: ASCII letters in lower case, copyright
lines left out, equivalent spellings replaced by one of them, and every run of
punctuation and white space made one blank. The SHA-256 of that is joined with
the digests of known licenses, which are made by the same expressions. Lines
are looked up the same way, each as an entire text, to find short notices.

The known texts come as a table; the default holds the short licenses and
notices below and the digests of entire texts in `license_digests`. It is small because licenses are: the join's strategy follows
its size. All documents are scanned by built-in functions only; of the lines,
those that match nothing leave before anything is shuffled.

Defined cases: a NULL text and a text without words have no digest and no
license. Repeated documents each get their row. Several known licenses with the
same canonical form are reported under the smallest id.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tieout.llm.common import scratch_of, table
from tieout.llm.license_digests import ENTIRE_TEXTS

# Spellings on the left count as those on the right.
SPELLINGS = (
    ("acknowledgement", "acknowledgment"),
    ("analogue", "analog"),
    ("artefact", "artifact"),
    ("authoris", "authoriz"),
    ("behaviour", "behavior"),
    ("calibre", "caliber"),
    ("cancelled", "canceled"),
    ("catalogue", "catalog"),
    ("categoris", "categoriz"),
    ("centre", "center"),
    ("customis", "customiz"),
    ("favour", "favor"),
    ("fulfil ", "fulfill "),
    ("initialis", "initializ"),
    ("judgement", "judgment"),
    ("labour", "labor"),
    ("licence", "license"),
    ("maximis", "maximiz"),
    ("minimis", "minimiz"),
    ("modelling", "modeling"),
    ("non infringement", "noninfringement"),
    ("organis", "organiz"),
    ("per cent", "percent"),
    ("practise", "practice"),
    ("recognis", "recogniz"),
    ("sub license", "sublicense"),
    ("utilis", "utiliz"),
    ("whilst", "while"),
    ("wilful", "willful"),
    ("https", "http"),
)

# Known texts by SPDX id, the short licenses in full.
_MIT = """Permission is hereby granted, free of charge, to any person obtaining a copy of this
software and associated documentation files (the "Software"), to deal in the Software without
restriction, including without limitation the rights to use, copy, modify, merge, publish,
distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the
Software is furnished to do so, subject to the following conditions:

The above copyright notice and this permission notice shall be included in all copies or
substantial portions of the Software.

THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT
NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND
NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM,
DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT
OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."""
_ISC_GRANT = """Permission to use, copy, modify, and/or distribute this software for any purpose
with or without fee is hereby granted"""
_ISC_CONDITION = """, provided that the above copyright notice and this permission notice appear in
all copies."""
_ISC_DISCLAIMER = """

THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS
SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE
AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES
WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT,
NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF
THIS SOFTWARE."""
_APACHE_NOTICE = """Licensed under the Apache License, Version 2.0 (the "License"); you may not use
this file except in compliance with the License. You may obtain a copy of the License at

http://www.apache.org/licenses/LICENSE-2.0

Unless required by applicable law or agreed to in writing, software distributed under the License
is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or
implied. See the License for the specific language governing permissions and limitations under the
License."""

KNOWN = (
    ("MIT", _MIT),
    ("MIT", "MIT License\n\n" + _MIT),
    ("MIT", "The MIT License (MIT)\n\n" + _MIT),
    ("MIT", "Released under the MIT License."),
    ("MIT", "Licensed under the MIT License."),
    ("ISC", _ISC_GRANT + _ISC_CONDITION + _ISC_DISCLAIMER),
    ("ISC", "ISC License\n\n" + _ISC_GRANT + _ISC_CONDITION + _ISC_DISCLAIMER),
    ("0BSD", _ISC_GRANT + "." + _ISC_DISCLAIMER),
    ("Apache-2.0", _APACHE_NOTICE),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("GPL-3.0-only", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-2.0-only", "This work is licensed under the GNU General Public License, version 2."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC0-1.0", "Licensed under CC0 1.0."),
)

# Notices of the other Creative Commons licenses, all versions.
NOTICES = tuple(
    (f"CC-{kind}-{version}", f"Licensed under CC {kind} {version}.")
    for kind in ("BY", "BY-SA", "BY-NC", "BY-ND", "BY-NC-SA", "BY-NC-ND")
    for version in ("1.0", "2.0", "2.5", "3.0", "4.0")
)

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
# A line that starts, comment signs aside, with a claim of copyright.
COPYRIGHT_LINE = r"(?m)^[ \t#*/;>-]*(copyright|\(c\)|\x{A9}|all rights reserved)[^\n]*$"
# Punctuation and white space but the line feed.
NOT_WORDS = (
    r"[\x{00}-\x{09}\x{0B}-\x{2F}\x{3A}-\x{60}\x{7B}-\x{7F}\x{A0}\x{2010}-\x{201F}\x{2026}]+"
)
SEVERAL_WORDS = tuple(pair for pair in SPELLINGS if " " in pair[0].strip())


def spelled(text: Column, spellings) -> Column:
    return reduce(lambda t, pair: F.replace(t, F.lit(pair[0]), F.lit(pair[1])), spellings, text)


def canonical_lines(text: Column) -> Column:
    """Lines in canonical form, blanks around them allowed; '' for NULL."""
    lower = F.translate(F.coalesce(text, F.lit("")), UPPER, LOWER)
    words = F.regexp_replace(F.regexp_replace(lower, COPYRIGHT_LINE, ""), NOT_WORDS, " ")
    return spelled(F.concat(words, F.lit(" ")), SPELLINGS)


def digest(form: Column) -> Column:
    """SHA-256 of a canonical form without blanks around it; NULL if it has no words."""
    trimmed = F.array(F.trim(form))
    return F.transform(trimmed, lambda f: F.when(f != "", F.sha2(f, 256)))[0]


def whole(lines: Column) -> Column:
    """The canonical form of all lines together."""
    return spelled(F.regexp_replace(lines, r"[ \n]+", " "), SEVERAL_WORDS)


def digests(text: Column) -> Column:
    """Array of one (digest, lines): of the text and of each of its lines that has words.

    The form is bound by a lambda and leaves through a generator, because an
    optimiser that copies it into several places makes it several times.
    """
    return F.transform(
        F.array(canonical_lines(text)),
        lambda form: F.struct(
            digest(whole(form)).alias("digest"),
            F.filter(
                F.transform(F.split(form, "\n"), digest), lambda d: d.isNotNull()
            ).alias("lines"),
        ),
    )


def known_digests(spark, known: DataFrame | None = None) -> DataFrame:
    """(digest, license) of a table (license, text), or of all texts known here."""
    entire = None
    if known is None:
        known = spark.createDataFrame([*KNOWN, *NOTICES], "license string, text string")
        entire = spark.createDataFrame(
            [tuple(row.split(" ")) for row in ENTIRE_TEXTS], "digest string, license string"
        )
    made = known.select("license", F.inline(digests(F.col("text")))).select("digest", "license")
    return (
        (made if entire is None else made.union(entire))
        .where("digest IS NOT NULL")
        .groupBy("digest")
        .agg(F.min("license").alias("license"))
    )


def license_scan(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    known: DataFrame | None = None,
) -> DataFrame:
    """Per document: its digest, the license it is, and licenses its lines are.

    Texts are read once; their digests are stored and joined from there.
    """
    scratch = scratch_of(docs.sparkSession)
    known = scratch.keep(known_digests(docs.sparkSession, known), "known")
    scanned = scratch.keep(
        docs.select(
            F.monotonically_increasing_id().alias("row"),
            F.col(id_col).alias("doc_id"),
            F.inline(digests(F.col(text_col))),
        ),
        "digests",
    )
    notices = (
        scanned.select("row", F.explode("lines").alias("digest"))
        .join(known, "digest")
        .groupBy("row")
        .agg(F.concat_ws(",", F.sort_array(F.collect_set("license"))).alias("line_licenses"))
    )
    return (
        scanned.drop("lines")
        .join(known, "digest", "left")
        .join(notices, "row", "left")
        .select(
            "doc_id",
            "digest",
            "license",
            F.coalesce("line_licenses", F.lit("")).alias("line_licenses"),
        )
    )


def op6_license_digests(spark, sf_dir):
    """Licenses of all documents."""
    return license_scan(table(spark, sf_dir, "documents").select("doc_id", "text"))


def _spelled_sql(form: str, spellings) -> str:
    for left, right in spellings:
        form = f"replace({form}, '{left}', '{right}')"
    return form


def _lines_sql(text: str) -> str:
    lower = f"translate(coalesce({text}, ''), '{UPPER}', '{LOWER}')"
    bare = f"regexp_replace({lower}, '{COPYRIGHT_LINE}', '', 'g')"
    return _spelled_sql(f"regexp_replace({bare}, '{NOT_WORDS}', ' ', 'g') || ' '", SPELLINGS)


def _digest_sql(form: str) -> str:
    return f"CASE WHEN trim({form}) <> '' THEN sha256(trim({form})) END"


_WHOLE_SQL = _spelled_sql("regexp_replace(form, '[ \\n]+', ' ', 'g')", SEVERAL_WORDS)


def _quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


ORACLE_SQL = f"""
WITH known AS (
  SELECT digest, min(license) AS license FROM (
    SELECT license, {_digest_sql(_WHOLE_SQL)} AS digest FROM (
      SELECT license, {_lines_sql("text")} AS form
      FROM (VALUES {", ".join(f"({_quoted(i)}, {_quoted(t)})" for i, t in KNOWN)}) k(license, text)
    )
  ) WHERE digest IS NOT NULL GROUP BY digest
), forms AS (
  SELECT row_number() OVER () AS row_id, doc_id, {_lines_sql("text")} AS form FROM documents
), entire AS (
  SELECT row_id, doc_id, {_digest_sql(_WHOLE_SQL)} AS digest FROM forms
), lines AS (
  SELECT row_id, unnest(string_split(form, chr(10))) AS line FROM forms
), notices AS (
  SELECT row_id, string_agg(DISTINCT license, ',' ORDER BY license) AS line_licenses
  FROM (SELECT row_id, {_digest_sql("line")} AS digest FROM lines) l
  JOIN known USING (digest) GROUP BY row_id
)
SELECT e.doc_id, e.digest, k.license, coalesce(n.line_licenses, '') AS line_licenses
FROM entire e LEFT JOIN known k ON e.digest = k.digest
LEFT JOIN notices n ON e.row_id = n.row_id
"""
