"""Operator 2: licence scan by canonical digest lookup.  DataFrame functions only.

A text's canonical form: copyright lines gone, lower case, equivalent spellings
made one, everything but letters and digits a single space.  The SHA-256 of the
canonical form of an entire text is hash-joined to the digests of known licences
and notices; so is that of each line, each two lines in a row and each paragraph
(lines joined up to a blank one), since a notice is often a part of a larger text.
The known whole texts are MIT, ISC, 0BSD, BSD-2-Clause, BSD-3-Clause, Apache-2.0
and GPL-3.0 (``licence_texts``), with and without their usual titles; of
CC-BY-NC-4.0 only the notice is known.

Edge cases: a null text has a null digest and no licence; a text (or line) with
nothing left in canonical form matches nothing.  Null ids and repeated rows keep
their rows.  Extra columns are ignored; empty tables give empty results.
"""

from __future__ import annotations

import re
from collections.abc import Sequence
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Spellings that count as equal in licence texts.
SPELLINGS = (
    ("licence", "license"), ("licenced", "licensed"), ("sublicence", "sublicense"),
    ("organisation", "organization"), ("authorised", "authorized"), ("unauthorised", "unauthorized"),
    ("favour", "favor"), ("fulfil", "fulfill"), ("judgement", "judgment"), ("labour", "labor"),
    ("acknowledgement", "acknowledgment"), ("programme", "program"),
    ("copyright owner", "copyright holder"), ("version 2 0", "2 0"), ("version 3", "3"), ("v2 0", "2 0"), ("v3", "3"),
)

# Known licence texts and notices.
KNOWN = (
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("MIT", "Released under the MIT License."),
    ("MIT", "SPDX-License-Identifier: MIT"),
    ("Apache-2.0", "SPDX-License-Identifier: Apache-2.0"),
    ("BSD-3-Clause", "SPDX-License-Identifier: BSD-3-Clause"),
    ("GPL-3.0", "SPDX-License-Identifier: GPL-3.0-only"),
    ("ISC", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is "
            "hereby granted, provided that the above copyright notice and this permission notice appear in all copies."),
    ("0BSD", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is "
             "hereby granted."),
    ("MIT", """MIT License

Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated
documentation files (the "Software"), to deal in the Software without restriction, including without limitation the
rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit
persons to whom the Software is furnished to do so, subject to the following conditions:

The above copyright notice and this permission notice shall be included in all copies or substantial portions of the
Software.

THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE
WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR
COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR
OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."""),
)

_TEXTS = Path(__file__).parent / "licence_texts"
# File, licence, usual titles.
_WHOLE = (
    ("ISC", "ISC", ("ISC License", "The ISC License", "ISC License (ISC)")),
    ("0BSD", "0BSD", ("Zero-Clause BSD", "BSD Zero Clause License", "Zero-Clause BSD License", "0BSD")),
    ("BSD-2-Clause", "BSD-2-Clause", ("BSD 2-Clause License", "The 2-Clause BSD License", 'BSD 2-Clause "Simplified" License')),
    ("BSD-3-Clause", "BSD-3-Clause", ("BSD 3-Clause License", "The 3-Clause BSD License", "New BSD License",
                                      'BSD 3-Clause "New" or "Revised" License')),
    ("BSD-3-Clause-Regents", "BSD-3-Clause", ()),
    ("Apache-2.0", "Apache-2.0", ()),
    ("GPL-3.0", "GPL-3.0", ()),
)


def unwrapped(text: str) -> str:
    """The text with one line for each paragraph."""
    return "\n\n".join(" ".join(p.split()) for p in re.split(r"\n[ \t]*\n", text) if p.strip())


def _whole_texts() -> list[tuple[str, str]]:
    """licence_id, text of whole licences as they are met: titles, list signs, appendix and links vary."""
    mit = KNOWN[-1][1].removeprefix("MIT License\n\n")
    out = [("MIT", title + mit) for title in ("", "The MIT License\n\n", "The MIT License (MIT)\n\n", "MIT License (MIT)\n\n")]
    for name, licence, titles in _WHOLE:
        text = (_TEXTS / f"{name}.txt").read_text("utf-8")
        forms = [text, re.sub(r"(?m)^[ \t]*\d\. Re", "* Re", re.sub(r"(?m)^[ \t]*\d\. Neither", "* Neither", text))]
        if name == "Apache-2.0":
            end = "END OF TERMS AND CONDITIONS"
            terms = text[:text.index(end)]
            forms = [text, terms + end, terms, re.sub(r"(?m)^.*Copyright \[yyyy\].*$", "", text)]
        if name == "GPL-3.0":
            end = "END OF TERMS AND CONDITIONS"
            forms = [text, text[:text.index(end)] + end, text[:text.index(end)]]
            forms += [form.replace("https://", "http://") for form in forms]
        out += [(licence, f"{title}\n\n{form}") for title in ("", *titles) for form in forms]
    return out + [(licence, unwrapped(text)) for licence, text in out]


KNOWN += tuple(dict.fromkeys(_whole_texts()))

_COPYRIGHT_LINE = r"(?m)^\W*(copyright\s*(\(c\)|©|\d{4})|\(c\)\s*\d{4}|©|all rights reserved).*$"
_COPYRIGHT_SIGNS = ("copyright", "(c)", "©", "all rights reserved")
#: Everything but letters, digits and line ends: ASCII and Latin-1 signs, general and CJK punctuation.
_SIGNS = r"[\x00-\x09\x0B-\x2F:-@\[-`{-\xA9\xAB-\xB4\xB6-\xB9\xBB-\xBF -⁯　-〿]+"


def _any(column: str, parts: Sequence[str]) -> Column:
    """Whether one of the parts occurs: plain searches, far cheaper than the expressions that they guard."""
    test = F.col(column).contains(parts[0])
    for part in parts[1:]:
        test = test | F.col(column).contains(part)
    return test


#: What a text has that holds a spelling, maybe with its words on two lines.
_SPELLING_SIGNS = tuple(sign for found, _ in SPELLINGS for first, _, rest in [found.partition(" ")]
                        for sign in ((f"{first} {rest[0]}", f"{first}\n", f"{first} \n") if rest else (first,)))


def _spelling(found: str, used: str) -> tuple[str, str]:
    """Pattern and replacement of a spelling; its words may stand on two lines, and the line end stays."""
    words, kept = found.split(), used.split()
    dropped = len(words) - len(kept)
    pattern, put = words[0], "" if dropped else kept[0]
    for k in range(1, len(words)):
        pattern += (rf"(?=[ \n]) ?(?<g{k}>\n?) ?" if k <= dropped else rf"(?<g{k}> ?\n ?| )") + words[k]
        put += f"${{g{k}}}" + (kept[k - dropped] if k >= dropped else "")
    return rf"\b{pattern}\b", put


def with_canonical(df: DataFrame, text_col: str, out: str, parts: str | None = None) -> DataFrame:
    """``df`` with the canonical lines of a text (an array, empty lines left out).

    ``parts``: a column for two lines in a row and paragraphs of several lines.
    """
    df = df.withColumn("__low", F.lower(F.col(text_col)))
    open_text = F.when(_any("__low", _COPYRIGHT_SIGNS), F.regexp_replace("__low", _COPYRIGHT_LINE, " ")).otherwise(F.col("__low"))
    df = df.withColumn("__plain", F.regexp_replace(open_text, _SIGNS, " "))
    spelled = F.col("__plain")
    for found, used in SPELLINGS:
        spelled = F.regexp_replace(spelled, *_spelling(found, used))
    one_spelling = F.when(_any("__plain", _SPELLING_SIGNS), spelled).otherwise(F.col("__plain"))
    df = df.withColumn("__lines", F.transform(F.split(one_spelling, "\n"), lambda x: F.trim(x)))
    if parts:
        # Paragraphs of one line are among the lines.
        paragraphs = F.filter(F.split(F.array_join("__lines", "\n"), "\n\n+"), lambda x: F.instr(F.trim(x, F.lit("\n")), "\n") > 0)
        df = df.withColumn(parts, F.transform(paragraphs, lambda x: F.translate(F.trim(x, F.lit("\n")), "\n", " ")))
    df = df.withColumn(out, F.filter("__lines", lambda x: x != ""))
    if parts:
        rest = F.greatest(F.size(out) - 1, F.lit(0))
        pairs = F.zip_with(F.slice(out, 1, rest), F.slice(out, 2, rest), lambda a, b: F.concat(a, F.lit(" "), b))
        df = df.withColumn(parts, F.concat(pairs, parts))
    return df.drop("__low", "__plain", "__lines")


def known_licences(spark: SparkSession, known: Sequence[tuple[str, str]] = KNOWN) -> DataFrame:
    """licence_id, digest of the known texts (one row per digest)."""
    texts = with_canonical(spark.createDataFrame(list(known), "licence_id string, text string"), "text", "canon")
    return (texts.select("licence_id", F.sha2(F.array_join("canon", " "), 256).alias("digest"))
            .groupBy("digest").agg(F.min("licence_id").alias("licence_id")))


def licence_scan(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text",
                 known: Sequence[tuple[str, str]] = KNOWN) -> DataFrame:
    """doc_id, text_digest, licence_id (of the entire text), line_licences (sorted, of its lines and paragraphs) of each row."""
    spark = docs.sparkSession
    rows = docs.select(F.monotonically_increasing_id().alias("row"), F.col(id_col).alias("doc_id"),
                       F.col(text_col).alias("text"))
    units = with_canonical(rows, "text", "canon", "parts").select(
        "row", "doc_id", F.posexplode_outer(F.concat(F.array(F.array_join("canon", " ")), "canon", "parts")).alias("pos", "unit"))
    digested = units.select("row", "doc_id", "pos", F.when(F.col("unit") != "", F.sha2("unit", 256)).alias("digest"))
    # The known digests are the argument's own few rows.
    told = digested.join(F.broadcast(known_licences(spark, known)), "digest", "left")
    entire, line = F.coalesce(F.col("pos"), F.lit(0)) == 0, F.col("pos") > 0
    return (told.groupBy("row", "doc_id").agg(
        F.max(F.when(entire, F.col("digest"))).alias("text_digest"),
        F.max(F.when(entire, F.col("licence_id"))).alias("licence_id"),
        F.array_join(F.array_sort(F.collect_set(F.when(line, F.col("licence_id")))), ",").alias("line_licences"))
        .select("doc_id", "text_digest", "licence_id", "line_licences"))
