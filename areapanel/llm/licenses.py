"""Licence scans by canonical digests."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import save

#: Short licence texts and the notices that stand for longer ones, by SPDX id.
LICENSES = [
    ("MIT", """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:
The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.
THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."""),
    ("ISC", """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.
THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE."""),
    ("0BSD", """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted.
THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE."""),
    ("BSD-2-Clause", """Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:
1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.
2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution.
THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."""),
    ("BSD-3-Clause", """Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:
1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.
2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution.
3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission.
THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."""),
    ("MIT", "Released under the MIT License."),
    ("MIT", "Licensed under the MIT License."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC0-1.0", "Licensed under CC0 1.0."),
]

#: The canonical form of longer licences, as their publishers give them: SPDX id, characters, SHA-256.
WHOLE_TEXTS = [
    ("Apache-2.0", 9703, "cc411e5c73676ae13e68bf0fe2c031a62b3a1ef56829577a7d168699686c1e7e"),
    ("Artistic-1.0-Perl", 5683, "cc2cd6cccfacd5fb622fb0e9b9a373fa9dcb86a8c152213a2b856dfbe24fe304"),
    ("BSD-3-Clause", 1361, "21ce5e311a0ef74591e636cf6d0a236029bcaa0ee86324ac68d5748657aa8651"),
    ("CC0-1.0", 6692, "96bdc7f63190fb4bd1ae584b890300ed7517d858b34c945642a3b9b2f1612a5f"),
    ("GFDL-1.2", 19515, "f06741c6c5feec30d99f80228f0d9ea6b884eae0e790ab18a0f4257184befa86"),
    ("GFDL-1.3", 21884, "80229e90e6f40a551a447f33ef48bd361a8e3166d53f29a2d1537245e2064feb"),
    ("GPL-1.0", 11773, "f28265030cc2618a1aae8373267c1ffa00be4df7f9ec10e59f2d9e3d059e8199"),
    ("GPL-2.0", 17053, "b866f5427b78991db8012466b32f51c907f5e974fde5129a47372d0d0552e3a1"),
    ("GPL-3.0", 33277, "f3ab5ee40da170411ea6671f9845ada2aaba303ee57ba6086b373d1e66c9dc3f"),
    ("LGPL-2.0", 23955, "a3d8ea00ba614882dda24d20f22870936e9c07464f9f4bc70d157a6e7c9e835b"),
    ("LGPL-2.1", 25042, "bfd6e2cd84528b8e253b080d815b43d5156829ecdd9ca0b4fd174fcff32467aa"),
    ("LGPL-3.0", 7104, "aae2b222477171fb64e298e7965e768a9a6f85320646b266c94399ac029d42be"),
    ("MPL-1.1", 22320, "1cfb6cca26abe2169c9c61164807107b2d4a0b64955a2cf2de46fad3483acda1"),
    ("MPL-2.0", 14272, "3dacd2c104719e7227969cbdcc7d581518827199e830b9379627eec0a32f8ab7"),
]

#: Replaced in turn, after lower-casing, so that equivalent spellings are one.
SPELLINGS = [("all rights reserved", " "), ("licence", "license"), ("non-commercial", "noncommercial"), ("sub-license", "sublicense"), ("http:", "https:"), ("&", " and ")]
COPYRIGHT_LINE = r"(^|\n)[ \t]*(copyright|\(c\)|©)[^\n]*"
BLANKS_AND_MARKS = "[ \\t!-/:-@\\[-`{-~“”‘’«»–—…]+"


def canonical_lines(text: Column, notice: str = COPYRIGHT_LINE) -> Column:
    """Lines in canonical form: lower case; no punctuation, copyright lines or blank lines; one spelling for variants."""
    out = F.regexp_replace(F.replace(F.lower(text), F.lit("\r"), F.lit("")), notice, "\n")
    for old, new in SPELLINGS:
        out = F.replace(out, F.lit(old), F.lit(new))
    out = F.regexp_replace(F.regexp_replace(out, BLANKS_AND_MARKS, " "), r" ?\n[ \n]*", "\n")
    return F.btrim(out, F.lit(" \n"))


def joined(lines: Column) -> Column:
    return F.replace(lines, F.lit("\n"), F.lit(" "))


#: Fixed values, in canonical form: titles that files carry over the text of a licence.
TITLES = [
    "mit license", "the mit license", "the mit license mit", "mit license mit", "mit", "license", "isc license", "the isc license", "isc license isc", "internet systems consortium license",
    "bsd 2 clause license", "the bsd 2 clause license", "bsd 2 clause simplified license", "simplified bsd license", "freebsd license", "bsd 3 clause license", "the bsd 3 clause license",
    "bsd 3 clause new or revised license", "new bsd license", "revised bsd license", "modified bsd license", "bsd license", "the bsd license", "bsd zero clause license", "zero clause bsd license", "zero clause bsd", "0bsd license",
]
#: Pattern and what stands for it, over a text joined to one line: who holds the rights, and numbers of a list.
SLOTS = [
    ("neither the names? of .{1,200}? nor the names? of (?:its|their|any) contributors", "neither the name of the copyright holder nor the names of its contributors"),
    ("this software is provided by .{1,200}? as is and any express", "this software is provided by the copyright holders and contributors as is and any express"),
    ("in no event shall .{1,200}? be liable for any (claim|special|direct)", "in no event shall the holder be liable for any $1"),
    ("as is and .{1,200}? disclaims? all warranties", "as is and the author disclaims all warranties"),
    ("(?:^| )[1-4] (redistributions|neither)", " $1"),
]


#: A copyright line, but not a line of a wrapped sentence that goes on about copyright.
NOTICE_LINE = r"(^|\n)[ \t]*(copyright(?![ \t]+(?:notices?|holders?|owners?|licenses?|laws?|and|or)\b)|\(c\)|©)[^\n]*"


def body(text: Column, lines: Column) -> Column:
    """A text without titles over it, joined to one line, with one spelling of what holders fill in; ``lines`` is its canonical form.

    Only texts that speak of "as is" have holders to fill in.
    """
    untitled = lambda x: joined(F.regexp_replace(x, "^(?:(?:" + "|".join(TITLES) + ")(?:\n|$))+", ""))
    filled = untitled(canonical_lines(text, NOTICE_LINE))
    for pattern, one in SLOTS:
        filled = F.regexp_replace(filled, pattern, one)
    return F.when(F.rlike(text, F.lit("(?i)\\bas\\s+is\\b")), filled).otherwise(untitled(lines))


def known_digests(spark: SparkSession, known: list[tuple[str, str]] | None = None, whole: list[tuple[str, int, str]] | None = None) -> DataFrame:
    """Columns ``digest`` and ``license`` (the lesser id where two texts have one digest) and ``size`` in characters."""
    lines = spark.createDataFrame(LICENSES if known is None else known, "license string, text string").select("license", "text", canonical_lines(F.col("text")).alias("lines"))
    texts = lines.select("license", F.explode(F.array_distinct(F.array(joined(F.col("lines")), body(F.col("text"), F.col("lines"))))).alias("text"))
    made = texts.where("text <> ''").select("license", F.length("text").alias("size"), F.sha2("text", 256).alias("digest"))
    given = spark.createDataFrame((WHOLE_TEXTS if known is None else []) if whole is None else whole, "license string, size int, digest string")
    return made.unionByName(given).groupBy("digest").agg(F.min("license").alias("license"), F.min("size").alias("size"))


def license_scan(df: DataFrame, known: list[tuple[str, str]] | None = None, whole: list[tuple[str, int, str]] | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Look whole texts, and each of their lines, up among known licence texts by canonical digest.

    One row per input row: ``doc_id``, ``digest`` (of the whole canonical text),
    ``license`` (whose digest the whole text has, or the text without titles over
    it and with one spelling of its holders; else null), ``notices`` (ids of
    licences or notices that a line is equal to, ascending, comma-separated;
    empty if none) and ``n_notices`` (such lines).

    ``known`` holds (id, text), ``whole`` holds (id, characters, digest) of
    canonical texts; both are lists of licences, made by the caller, which
    don't grow with the corpus, and are broadcast.  Each text is put into
    canonical form once; a line's digest is only taken if a known text has its
    length, which loses nothing.  Where two known texts have one digest the
    lesser id stands.  A null or empty text has the digest of the empty string
    and no licence.  Very long texts are taken whole.  Rows that repeat an id
    are counted line by line together and then have the same notices.  Rows
    with a null id are left out; other columns are ignored, whatever their
    names; an empty table gives an empty result.  Everything runs in the JVM.
    """
    table = known_digests(df.sparkSession, known, whole)
    sizes = sorted(r.size for r in table.select("size").distinct().collect())
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    docs = df.select(F.col(id_col).cast("long").alias("doc_id"), text.alias("text"), canonical_lines(text).alias("lines")).where("doc_id is not null")
    lines = F.transform(F.filter(F.split("lines", "\n"), lambda x: F.length(x).isin(sizes)), lambda x: F.sha2(x, 256))
    digests = [F.sha2(joined(F.col("lines")), 256).alias("digest"), F.sha2(body(F.col("text"), F.col("lines")), 256).alias("body")]
    once = save(docs.select("doc_id", *digests, lines.alias("lines")), "license-digests")
    table = F.broadcast(table.select("digest", "license"))
    hits = once.select("doc_id", F.explode("lines").alias("digest")).join(table, "digest").groupBy("doc_id").agg(F.array_join(F.array_sort(F.collect_set("license")), ",").alias("notices"), F.count(F.lit(1)).alias("n_notices"))
    bodies = table.select(F.col("digest").alias("body"), F.col("license").alias("of_body"))
    found = once.join(table, "digest", "left").join(bodies, "body", "left").join(hits, "doc_id", "left")
    return found.select("doc_id", "digest", F.coalesce("license", "of_body").alias("license"), F.coalesce("notices", F.lit("")).alias("notices"), F.coalesce("n_notices", F.lit(0)).cast("long").alias("n_notices"))


def _sql_text(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


#: The canonical form once more, line by line and without the constants above, so that a fault in them shows.
SQL_LINES = """list_filter(list_transform(list_filter(
  string_split(replace(lower({}), chr(13), ''), chr(10)),
  lambda l: NOT regexp_matches(l, '^[ \\t]*(copyright|\\(c\\)|©)')),
  lambda l: trim(regexp_replace(translate(
    replace(replace(replace(replace(replace(replace(l, 'all rights reserved', ' '), 'licence', 'license'), 'non-commercial', 'noncommercial'), 'sub-license', 'sublicense'), 'http:', 'https:'), '&', ' and '),
    chr(9) || '!"#$%''()*+,-./:;<=>?@[\\]^_`{{|}}~“”‘’«»–—…', '                                          '), ' +', ' ', 'g'), ' ')),
  lambda l: l <> '')"""


#: The same, but lines of sentences about copyright stay.
SQL_KEPT_LINES = SQL_LINES.replace("(copyright|\\(c\\)|©)')", "(copyright|\\(c\\)|©)') OR regexp_matches(l, '^[ \\t]*copyright[ \\t]+(notice|notices|holder|holders|owner|owners|license|licenses|law|laws|and|or)\\b')")
#: A text's lines without titles, joined, with holders and numbers taken out of it, again without the constants above.
SQL_BODY = """(SELECT CASE WHEN regexp_matches({1}, '(?i)\\bas[ \\t\\n\\f\\r\\v]+is\\b') THEN
  regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(t,
    'neither the name(s)? of .{{1,200}}? nor the name(s)? of (its|their|any) contributors', 'neither the name of the copyright holder nor the names of its contributors', 'g'),
    'this software is provided by .{{1,200}}? as is and any express', 'this software is provided by the copyright holders and contributors as is and any express', 'g'),
    'in no event shall .{{1,200}}? be liable for any (claim|special|direct)', 'in no event shall the holder be liable for any \\1', 'g'),
    'as is and .{{1,200}}? disclaim(s)? all warranties', 'as is and the author disclaims all warranties', 'g'),
    '(^| )(1|2|3|4) (redistributions|neither)', ' \\3', 'g') ELSE t END
  FROM (SELECT array_to_string(u[coalesce(nullif(list_position(list_transform(u, lambda l: regexp_full_match(l,
    '(the )?mit license( mit)?|mit|license|(the )?isc license|isc license isc|internet systems consortium license|(the )?bsd (2|3) clause license|bsd 2 clause simplified license|bsd 3 clause new or revised license|(simplified|new|revised|modified) bsd license|freebsd license|(the )?bsd license|bsd zero clause license|zero clause bsd( license)?|0bsd license')), false), 0), len(u) + 1):], ' ') AS t FROM (SELECT CASE WHEN regexp_matches({1}, '(?i)\\bas[ \\t\\n\\f\\r\\v]+is\\b') THEN {2} ELSE {0} END AS u)))"""


def license_sql() -> str:
    """The query over ``documents`` for DuckDB."""
    texts = ", ".join(f"({_sql_text(i)}, {_sql_text(t)})" for i, t in LICENSES)
    whole = ", ".join(f"({_sql_text(i)}, {_sql_text(d)})" for i, _, d in WHOLE_TEXTS)
    return f"""
WITH known AS (
  SELECT digest, min(license) AS license FROM (
    SELECT sha256(unnest([array_to_string(lines, ' '), {SQL_BODY.format("lines", "text", "more")}])) AS digest, license FROM (SELECT license, text, {SQL_LINES.format("text")} AS lines, {SQL_KEPT_LINES.format("text")} AS more FROM (VALUES {texts}) t(license, text))
    UNION ALL SELECT digest, license FROM (VALUES {whole}) w(license, digest))
  WHERE digest <> sha256('') GROUP BY digest),
docs AS (SELECT doc_id, coalesce(text, '') AS text, {SQL_LINES.format("coalesce(text, '')")} AS lines, {SQL_KEPT_LINES.format("coalesce(text, '')")} AS more FROM documents WHERE doc_id IS NOT NULL),
hits AS (
  SELECT doc_id, string_agg(DISTINCT license, ',' ORDER BY license) AS notices, count(*) AS n_notices
  FROM (SELECT doc_id, unnest(lines) AS line FROM docs) l JOIN known ON sha256(line) = known.digest GROUP BY doc_id)
SELECT doc_id, sha256(array_to_string(lines, ' ')) AS digest, coalesce(known.license, b.license) AS license, coalesce(notices, '') AS notices, coalesce(n_notices, 0) AS n_notices
FROM docs LEFT JOIN known ON sha256(array_to_string(lines, ' ')) = known.digest LEFT JOIN known b ON sha256({SQL_BODY.format("lines", "text", "more")}) = b.digest LEFT JOIN hits USING (doc_id)
"""
