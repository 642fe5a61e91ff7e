"""Licence scans by canonical digests.

A text is brought to a canonical form: lower case, without copyright lines, with
one spelling of words that are spelled in several ways, and without punctuation.
The digest of that form is joined with the digests of known licences, so a licence
is recognised by an equality join at any size, and only a digest is shuffled. The
same join over the digests of single lines finds the short notices that stand
inside other texts.

Defined cases: a null text is an empty one; an empty canonical form matches
nothing; a document with several notices lists each once, in order; repeated rows
give repeated rows, null ids are kept. Known texts of equal canonical form name
the document by the smallest licence id. Empty tables give an empty result or no
matches. Extra columns are ignored.
"""

from __future__ import annotations

import re
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ratepanel.llm.frames import fresh

#: Words that licences spell in several ways; the first is written for the second. Fixed values.
SPELLINGS = (
    ("license", "licence"),
    ("licensed", "licenced"),
    ("licensor", "licencor"),
    ("sublicense", "sublicence"),
    ("sublicense", "sub license"),
    ("organization", "organisation"),
    ("authorized", "authorised"),
    ("authorization", "authorisation"),
    ("favor", "favour"),
    ("honor", "honour"),
    ("merchantability", "merchantibility"),
    ("noninfringement", "non infringement"),
    ("noncommercial", "non commercial"),
    ("copyright holder", "copyright owner"),
    ("percent", "per cent"),
    ("artifact", "artefact"),
    ("center", "centre"),
    ("fulfill", "fulfil"),
    ("judgment", "judgement"),
    ("program", "programme"),
    ("whilst", "while"),
)

#: Known texts: short licences in full and the usual one-line notices. Fixed values.
KNOWN = {
    "MIT": (
        "MIT License",
        "Released under the MIT License.",
        "Licensed under the MIT License.",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
        'documentation files (the "Software"), to deal in the Software without restriction, including without limitation '
        "the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to "
        "permit persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright "
        "notice and this permission notice shall be included in all copies or substantial portions of the Software. THE "
        'SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE '
        "WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS "
        "OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR "
        "OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.",
    ),
    "ISC": (
        "ISC License",
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby "
        "granted, provided that the above copyright notice and this permission notice appear in all copies. THE SOFTWARE IS "
        'PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED '
        "WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, "
        "OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION "
        "OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF "
        "THIS SOFTWARE.",
    ),
    "Apache-2.0": (
        "Apache License, Version 2.0",
        "Licensed under the Apache License, Version 2.0.",
        "Released under the Apache License, Version 2.0.",
    ),
    "GPL-3.0": (
        "GNU General Public License, version 3",
        "This work is licensed under the GNU General Public License, version 3.",
        "Licensed under the GNU General Public License, version 3.",
    ),
    "CC-BY-NC-4.0": ("Licensed under CC BY-NC 4.0.", "This work is licensed under CC BY-NC 4.0."),
    "CC-BY-4.0": ("Licensed under CC BY 4.0.", "This work is licensed under CC BY 4.0."),
}

#: Titles that files of a licence in KNOWN put before its body. Fixed values.
TITLES = {
    "MIT": ("MIT License", "The MIT License", "The MIT License (MIT)", "MIT License (MIT)"),
    "ISC": ("ISC License", "The ISC License", "ISC License (ISC)", "The ISC License (ISC)"),
}
#: Full texts by licence id, read by the driver.
TEXTS = Path(__file__).parent / "licence_texts"
#: Where the terms of a full text end, if more follows that files may leave out.
_END = re.compile(r"END OF TERMS AND CONDITIONS")

#: A copyright line begins with the word or the sign, and has the sign, a year or a place for one.
_COPYRIGHT = (
    r"(?mi)^[^\p{L}\p{N}\n]*(?:copyright\b(?=[^\n]*(?:\(c\)|©|\b[0-9]{4}\b|[\[<{](?:yyyy|year)))"
    r"|(?:\(c\)|©)(?=[^\n]*(?:copyright|\b[0-9]{4}\b|[\[<{](?:yyyy|year))))[^\n]*$|^\h*all rights reserved\.?\h*$"
)


def known_texts() -> list[tuple[str, str]]:
    """Licence and text of all known texts: notices, bodies with and without a title, full texts with and without what follows their terms."""
    rows = [(name, text) for name, texts in KNOWN.items() for text in texts]
    # The body is the longest of a licence's texts.
    rows += [(name, f"{title}\n\n{max(KNOWN[name], key=len)}") for name, titles in TITLES.items() for title in titles]
    for file in sorted(TEXTS.glob("*.txt")):
        # One licence may have several files.
        name, text = file.stem.split("_")[0], file.read_text(encoding="utf-8")
        end = _END.search(text)
        rows += [(name, text), *([(name, text[: end.end()])] if end else [])]
        if name.startswith("BSD-"):
            body = text[text.index("Redistribution and use") :]
            count = name.split("-")[1]
            titles = (f"BSD {count}-Clause License", f"The BSD {count}-Clause License", *(("BSD 3-Clause \"New\" or \"Revised\" License",) if count == "3" else ()))
            rows += [(name, body), *((name, f"{title}\n\n{body}") for title in titles)]
    return rows


def canonical(text: Column) -> Column:
    """Lower case, without copyright lines and punctuation, one spelling."""
    out = F.regexp_replace(text, _COPYRIGHT, " ")
    out = F.concat(F.lit(" "), F.regexp_replace(F.lower(out), r"[^\p{L}\p{N}]+", " "), F.lit(" "))
    for written, spelled in SPELLINGS:
        out = F.replace(out, F.lit(f" {spelled} "), F.lit(f" {written} "))
    return F.trim(out)


def digest_of(text: Column) -> Column:
    """Digest of the canonical form, also of an empty one."""
    return F.sha2(canonical(text), 256)


def known_digests(known: DataFrame) -> DataFrame:
    """`licence, digest` of known texts with `licence, text`."""
    digests = known.select("licence", digest_of(F.col("text").cast("string")).alias("digest"))
    return digests.where(F.col("digest") != F.sha2(F.lit(""), 256)).groupBy("digest").agg(F.min("licence").alias("licence"))


def built_in(spark: SparkSession) -> DataFrame:
    """`licence, text` of all known texts, as rows of the plan."""
    return spark.createDataFrame(known_texts(), "licence string, text string")


def scan(docs: DataFrame, known: DataFrame, id_column: str = "doc_id", text: str = "text") -> DataFrame:
    """Id, `text_digest`, `licence` of the entire text, and `notices`, the licences named by single lines."""
    digests = known_digests(known)
    row = fresh(docs, "row")
    plain = F.coalesce(F.col(f"`{text}`").cast("string"), F.lit(""))
    rows = docs.select(F.col(f"`{id_column}`").alias("id"), plain.alias("text"), F.xxhash64(F.col(f"`{id_column}`"), plain).alias(row))
    # Only lines that can be notices: one digest per line, the line itself is not moved.
    lines = rows.select(F.col(row).alias("at"), F.explode(F.split("text", "\n")).alias("line")).select("at", digest_of(F.col("line")).alias("digest"))
    named = lines.join(digests, "digest").groupBy("at").agg(F.sort_array(F.collect_set("licence")).alias("notices"))
    whole = rows.select("id", row, digest_of(F.col("text")).alias("text_digest"))
    told = whole.join(digests, whole.text_digest == digests.digest, "left").join(named, whole[row] == named["at"], "left")
    return told.select(F.col("id").alias(id_column), "text_digest", "licence", F.coalesce("notices", F.array().cast("array<string>")).alias("notices"))
