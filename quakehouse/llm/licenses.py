"""Op 8: licence scans by canonical digests.

Known licence texts and every text of the corpus (the whole text, and each of its
lines) go through one normalisation: lower case, copyright notices dropped
(lines of ``copyright`` or ``(c)`` with a sign, year or ``by``),
equivalent spellings replaced, every run of other characters than letters and
digits one space. Equal digests of the normalised texts are matches; the table of
known digests is fixed, so it is broadcast.

Defined results: null, empty or punctuation-only texts match nothing; rows that
repeat are matched each; documents without a match give no row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

# Public licence texts and usual notices, by SPDX identifier.
_GRANT = ("Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
          "documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation "
          "the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and "
          "to permit persons to whom the Software is furnished to do so, subject to the following conditions: The above "
          "copyright notice and this permission notice shall be included in all copies or substantial portions of the "
          "Software. THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT "
          "LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT "
          "SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION "
          "OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER "
          "DEALINGS IN THE SOFTWARE.")
_ISC = ("Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, "
        "provided that the above copyright notice and this permission notice appear in all copies. ")
_ISC_END = ("THE SOFTWARE IS PROVIDED \"AS IS\" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL "
            "IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, "
            "INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN "
            "AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR "
            "PERFORMANCE OF THIS SOFTWARE.")
KNOWN = [
    ("MIT", _GRANT),
    ("MIT", "MIT License\n" + _GRANT),
    ("MIT", "The MIT License (MIT)\n" + _GRANT),
    ("MIT", "Released under the MIT License."),
    ("MIT", "Licensed under the MIT License."),
    ("MIT", "SPDX-License-Identifier: MIT"),
    ("ISC", _ISC + _ISC_END),
    ("ISC", "ISC License\n" + _ISC + _ISC_END),
    ("ISC", "SPDX-License-Identifier: ISC"),
    ("0BSD", _ISC.split(", provided")[0] + ". " + _ISC_END),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "Released under the Apache License, Version 2.0."),
    ("Apache-2.0", "SPDX-License-Identifier: Apache-2.0"),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-NC-4.0", "This work is licensed under CC BY-NC 4.0."),
    ("CC-BY-NC-4.0", "SPDX-License-Identifier: CC-BY-NC-4.0"),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0", "Licensed under the GNU General Public License, version 3."),
    ("GPL-3.0", "SPDX-License-Identifier: GPL-3.0-only"),
]
# Notices only: licence wording may be wrapped before "copyright" or "(c)" too.
COPYRIGHT = (r"(?m)^[ \t]*(?:copyright[ \t]*(?:\(c\)|©|[0-9]{4}|by\b|[\[<{:])|\(c\)[ \t]*(?:copyright\b|[0-9]{4}|by\b)|©"
             r"|all rights reserved[.]?[ \t\r]*$)[^\n]*$")
SPELLINGS = [(r"licen[cs]e", "license"), (r"licen[cs]ed", "licensed"), (r"non commercial", "noncommercial"),
             (r"per cent", "percent"), (r"sub license", "sublicense"), (r"copyright owner", "copyright holder")]


def canonical(text: Column) -> Column:
    out = F.regexp_replace(F.lower(text), COPYRIGHT, " ")
    out = F.trim(F.regexp_replace(out, r"[^\p{L}\p{N}]+", " "))
    for said, means in SPELLINGS:
        out = F.regexp_replace(out, rf"\b{said}\b", means)
    return out


def known(spark: SparkSession, texts: list[tuple[str, str]] = KNOWN) -> DataFrame:
    """(license, digest) of the known texts."""
    return (spark.createDataFrame(texts, "license string, text string")
            .select("license", F.sha2(canonical(F.col("text")), 256).alias("digest")).distinct())


def scan(docs: DataFrame, texts: list[tuple[str, str]] = KNOWN, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per match: doc_id, unit (text or line), line (null for the whole text), license, digest."""
    base = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("body"))
    parts = F.split("body", "\n")
    # a text of one line is its own whole text
    units = base.select("doc_id", F.explode(F.concat(
        F.array(F.struct(F.lit("text").alias("unit"), F.lit(None).cast("int").alias("line"), F.col("body").alias("said"))),
        F.when(F.size(parts) > 1, F.transform(parts, lambda x, i: F.struct(
            F.lit("line").alias("unit"), i.cast("int").alias("line"), x.alias("said")))).otherwise(F.array()))).alias("u"))
    digests = units.select("doc_id", "u.unit", "u.line", F.sha2(canonical(F.col("u.said")), 256).alias("digest"))
    return digests.join(F.broadcast(known(docs.sparkSession, texts)), "digest").select("doc_id", "unit", "line", "license", "digest")
