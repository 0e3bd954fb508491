"""License scan: canonical digests of whole texts and lines, joined with those of known licence texts."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Names and public texts of licences and of the notices that refer to them.
_MIT = """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and
associated documentation files (the "Software"), to deal in the Software without restriction, including without
limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the
Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:
The above copyright notice and this permission notice shall be included in all copies or substantial portions of
the Software. THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT
LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT
SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF
CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS
IN THE SOFTWARE."""
_ISC = """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is
hereby granted, provided that the above copyright notice and this permission notice appear in all copies. THE
SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL
IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT,
INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN
AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR
PERFORMANCE OF THIS SOFTWARE."""
KNOWN = [
    ("MIT", "permissive", _MIT),
    ("ISC", "permissive", _ISC),
    ("MIT", "permissive", "Licensed under the MIT License."),
    ("MIT", "permissive", "Released under the MIT License."),
    ("MIT", "permissive", "This work is licensed under the MIT License."),
    ("Apache-2.0", "permissive", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "permissive", "Released under the Apache License, Version 2.0."),
    ("Apache-2.0", "permissive", "This work is licensed under the Apache License, Version 2.0."),
    ("BSD-2-Clause", "permissive", "Licensed under the BSD 2-Clause License."),
    ("BSD-3-Clause", "permissive", "Licensed under the BSD 3-Clause License."),
    ("MPL-2.0", "weak copyleft", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("LGPL-3.0", "weak copyleft", "This work is licensed under the GNU Lesser General Public License, version 3."),
    ("GPL-2.0", "copyleft", "This work is licensed under the GNU General Public License, version 2."),
    ("GPL-3.0", "copyleft", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0", "copyleft", "Licensed under the GNU General Public License, version 3."),
    ("AGPL-3.0", "copyleft", "This work is licensed under the GNU Affero General Public License, version 3."),
    ("CC-BY-4.0", "permissive", "Licensed under CC BY 4.0."),
    ("CC-BY-SA-4.0", "copyleft", "Licensed under CC BY-SA 4.0."),
    ("CC-BY-NC-4.0", "non-commercial", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-NC-SA-4.0", "non-commercial", "Licensed under CC BY-NC-SA 4.0."),
    ("CC-BY-ND-4.0", "no derivatives", "Licensed under CC BY-ND 4.0."),
    ("CC0-1.0", "public domain", "Licensed under CC0 1.0."),
]
# Spellings that mean the same in a licence.
SPELLINGS = [
    ("licence", "license"), ("sub license", "sublicense"), ("non infringement", "noninfringement"),
    ("organisation", "organization"), ("merchantibility", "merchantability"), ("whilst", "while"), ("favour", "favor"),
    ("judgement", "judgment"), ("fulfilment", "fulfillment"), ("acknowledgement", "acknowledgment"),
    ("copyright owner", "copyright holder"), ("per cent", "percent"), ("https", "http"),
]
# A line that names a holder: after the word come a sign, a year, by, the or a placeholder, or nothing. What a wrapped
# sentence goes on with ("copyright notice and this ...", "copyright holders be liable ...") stays.
COPYRIGHT_LINE = (
    r"(?im)^[^\p{L}\p{N}\n(]*(?:copyright[ \t:]*(?:\(c\)|©|[0-9<\[{]|by |the |$)|copr\.|\(c\)|©|all rights reserved)[^\n]*$"
)
# A title above a text, as licence files have it.
TITLE = (
    r"(?i)\A[^\p{L}\p{N}\n]*(?:the )?(?:mit|expat|isc|zlib|x11|bsd|new bsd|simplified bsd|[0-9]-clause bsd|apache|boost software)"
    r"(?: [0-9][a-z0-9.\-]*)? licen[sc]e(?: \([a-z0-9 .\-]+\))?[^\p{L}\p{N}\n]*\n"
)
# Every known text has one of these words in all its spellings, so only texts with one are canonicalised.
_SIGNS = r"(?i)licen[sc]e|permission"


def canonical(text: Column) -> Column:
    """Lower case without a title and copyright lines, punctuation as single spaces, one spelling."""
    bare = F.regexp_replace(F.regexp_replace(text, TITLE, " "), COPYRIGHT_LINE, " ")
    plain = F.trim(F.regexp_replace(F.lower(bare), r"[^\p{L}\p{N}]+", " "))
    return reduce(lambda c, pair: F.replace(c, F.lit(pair[0]), F.lit(pair[1])), SPELLINGS, plain)


def known_licenses(spark: SparkSession) -> DataFrame:
    """(digest, license, category) of the fixed texts above: a few dozen rows."""
    rows = F.array(*[F.struct(*[F.lit(v).alias(n) for n, v in zip(("license", "category", "text"), row)]) for row in KNOWN])
    table = spark.range(1).select(F.inline(rows))
    return table.select(F.sha2(canonical(F.col("text")), 256).alias("digest"), "license", "category").distinct()


def scan(docs: DataFrame, known: DataFrame | None = None, id_col="doc_id", text_col="text") -> DataFrame:
    """(doc_id, scope, license, category, n_matches) of documents that are, or hold a line that is, a known text.

    The whole text and each of its lines is compared by its canonical digest; scope says which was
    equal. A text of one line counts under both. Null and empty texts match nothing; rows sharing an id add up.
    known: (digest, license, category), by default the built-in table, which is small by construction
    and so broadcast; a table of your own is joined without a hint.
    """
    given = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.col(f"`{text_col}`").cast("string").alias("text"))
    units = F.concat(
        F.array(F.struct(F.lit("document").alias("scope"), F.col("text").alias("unit"))),
        F.transform(F.split("text", "\n"), lambda line: F.struct(F.lit("line").alias("scope"), line.alias("unit"))),
    )
    signs = F.lit(True) if known is not None else F.col("unit").rlike(_SIGNS)  # a table of your own may hold any texts
    signed = given if known is not None else given.filter(F.col("text").rlike(_SIGNS))
    digests = (
        signed.select("doc_id", F.inline(units))
        .filter(signs)
        .select("doc_id", "scope", F.sha2(canonical(F.col("unit")), 256).alias("digest"))
    )
    table = F.broadcast(known_licenses(docs.sparkSession)) if known is None else known.select("digest", "license", "category").distinct()
    return digests.join(table, "digest").groupBy("doc_id", "scope", "license", "category").agg(F.count("*").alias("n_matches"))


def scan_sql() -> str:
    """The same rows in DuckDB's SQL."""
    text = lambda s: "'" + s.replace("'", "''") + "'"
    bare = f"regexp_replace(regexp_replace(unit, '{TITLE}', ' '), '{COPYRIGHT_LINE}', ' ', 'g')"
    plain = rf"trim(regexp_replace(lower({bare}), '[^\p{{L}}\p{{N}}]+', ' ', 'g'))"
    spelled = reduce(lambda c, pair: f"replace({c}, {text(pair[0])}, {text(pair[1])})", SPELLINGS, plain)
    known = ", ".join(f"({', '.join(map(text, row))})" for row in KNOWN)
    return f"""
with known as (select distinct sha256({spelled}) digest, license, category from (values {known}) k(license, category, unit)),
units as (
  select doc_id, 'document' as scope, "text" as unit from documents
  union all select doc_id, 'line', unnest(string_split("text", chr(10))) from documents),
found as (select doc_id, scope, sha256({spelled}) digest from units where regexp_matches(unit, '{_SIGNS}'))
select doc_id, scope, license, category, count(*) as n_matches from found join known using (digest)
group by doc_id, scope, license, category"""
