"""Licence scan by canonical digests.

A text is brought to a canonical form (copyright lines out, lower case, equivalent spellings made
one, everything but letters and digits turned into single blanks) and its SHA-256 is looked up among
the digests of known licence texts in the same form. Three units are looked up, each as an entire
text: the document, each of its lines, since many documents carry a notice as a line of its own, and
each run of several lines between blank lines that is not all of the document, since notices and whole
licences stand in headers. Where a line ends does not matter.

A copyright line begins with ``copyright``, ``(c)`` or the sign, and goes on with a sign, a year, a
placeholder, ``by`` or nothing but capitalised names; other lines that begin so are part of a text. One
that reflowing moved into the text, or a part of the text that it moved behind such a begin, is not
told apart.

Whole licences: those in the folder ``licenses``, MIT and ISC, each with and without its title, with
and without what follows its terms. The digest table comes from the ``known`` argument, so its size
is bounded by that argument.

Defined results: a null text counts as empty; an empty canonical form matches nothing; repeated
rows are judged each on its own; long texts are digested whole; only the id and text columns are
read, so other columns cannot clash. ``license`` is the id whose digest the whole document has, or
null; ``notices`` the sorted distinct ids of its lines and runs, comma-joined, or the empty string.
"""

from __future__ import annotations

from functools import lru_cache
from pathlib import Path

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import pick

# Spelling -> the form used, applied to whole words after lower-casing.
SPELLINGS = {
    "licence": "license", "licences": "licenses", "licenced": "licensed", "sublicence": "sublicense",
    "sub license": "sublicense", "acknowledgement": "acknowledgment", "favour": "favor",
    "merchantibility": "merchantability", "non infringement": "noninfringement",
    "organisation": "organization", "whilst": "while", "copyright holder": "copyright owner",
    "copyright holders": "copyright owners", "gnu gpl": "gnu general public license",
}

# Short notices and short licences by SPDX id.
KNOWN = {
    "Apache-2.0": [
        "Licensed under the Apache License, Version 2.0.",
        """Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in
        compliance with the License. You may obtain a copy of the License at""",
        "This project is licensed under the Apache License, Version 2.0.",
        "SPDX-License-Identifier: Apache-2.0",
    ],
    "MIT": [
        "Released under the MIT License.",
        "Licensed under the MIT License.",
        "This project is licensed under the MIT License.",
        "SPDX-License-Identifier: MIT",
        """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and
        associated documentation files (the "Software"), to deal in the Software without restriction, including
        without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell
        copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the
        following conditions: The above copyright notice and this permission notice shall be included in all
        copies or substantial portions of the Software. THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY
        KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A
        PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR
        ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM,
        OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.""",
    ],
    "ISC": [
        "SPDX-License-Identifier: ISC",
        """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is
        hereby granted, provided that the above copyright notice and this permission notice appear in all copies.
        THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE
        INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE
        FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS
        OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING
        OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE.""",
    ],
    "GPL-3.0": [
        "This work is licensed under the GNU General Public License, version 3.",
        """This program is free software: you can redistribute it and/or modify it under the terms of the GNU
        General Public License as published by the Free Software Foundation, either version 3 of the License, or
        (at your option) any later version.""",
        "Licensed under the GNU General Public License, version 3.",
        "SPDX-License-Identifier: GPL-3.0-only",
    ],
    "CC-BY-4.0": ["Licensed under CC BY 4.0.", "SPDX-License-Identifier: CC-BY-4.0"],
    "CC-BY-SA-4.0": ["Licensed under CC BY-SA 4.0.", "SPDX-License-Identifier: CC-BY-SA-4.0"],
    "CC-BY-NC-4.0": ["Licensed under CC BY-NC 4.0.", "SPDX-License-Identifier: CC-BY-NC-4.0"],
    "CC0-1.0": ["Released under CC0 1.0.", "SPDX-License-Identifier: CC0-1.0"],
    "BSD-3-Clause": ["Released under the BSD 3-Clause License.", "SPDX-License-Identifier: BSD-3-Clause"],
    "LicenseRef-reserved": ["All rights reserved."],
}

# Titles that stand over a text which does not hold its own; such texts by folder or above.
TITLES = {
    "MIT": ["MIT License", "The MIT License", "The MIT License (MIT)"],
    "ISC": ["ISC License", "The ISC License"],
    "BSD-2-Clause": ["BSD 2-Clause License", "The 2-Clause BSD License", "Simplified BSD License"],
    "BSD-3-Clause": ["BSD 3-Clause License", "The 3-Clause BSD License", "New BSD License"],
}
# The first line of the terms, below a text's own title, and the line after its terms.
TERMS_BEGIN = {
    "Apache-2.0": "   TERMS AND CONDITIONS FOR USE, REPRODUCTION, AND DISTRIBUTION", "MPL-2.0": "1. Definitions",
    "CC0-1.0": "CC0 1.0 Universal",
}
TERMS_END = "END OF TERMS AND CONDITIONS"
RESERVED = "All rights reserved."

# The patterns of the canonical form; they mean the same to Java and RE2.
COPYRIGHT_LINE = (
    r"^[^\p{L}\p{N}]*((?i:©|\(c\)[^\p{L}\p{N}]*[12][0-9]{3}|copyright[^\p{L}\p{N}]*(©|\(c\)|[12][0-9]{3}|[\[<{]|by ))"
    r"|[Cc]opyright([ \t]+[A-Z][\p{Ll}.'-]+){1,6}[^\p{L}\p{N}]*$)"
)
BLANK_LINES = r"\n([ \t\r]*\n)+"
NOT_WORD = r"[^\p{L}\p{N}]+"


def plain_lines(text: Column) -> Column:
    """The lines in lower case, words parted by single blanks; copyright and empty lines are gone."""
    lines = F.split(F.coalesce(text, F.lit("")), "\n")
    plain = F.transform(
        F.filter(lines, lambda x: ~F.rlike(x, F.lit(COPYRIGHT_LINE))),
        lambda x: F.trim(F.regexp_replace(F.lower(x), NOT_WORD, " ")),
    )
    return F.filter(plain, lambda x: x != "")


def one_spelling(plain: Column) -> Column:
    """Equivalent spellings made one, in whole words."""
    padded = F.concat(F.lit(" "), plain, F.lit(" "))
    for spelling, form in SPELLINGS.items():
        padded = F.replace(padded, F.lit(f" {spelling} "), F.lit(f" {form} "))
    return F.trim(padded)


def canonical(text: Column) -> Column:
    """The canonical form of a text."""
    return one_spelling(F.array_join(plain_lines(text), " "))


@lru_cache(maxsize=1)
def known_texts() -> dict[str, list[str]]:
    """The notices of ``KNOWN`` and the whole licences in the forms they are met in, by id."""
    texts = {name: list(found) for name, found in KNOWN.items()}
    for file in sorted((Path(__file__).parent / "licenses").glob("*.txt")):
        name, text = file.stem, file.read_text(encoding="utf-8")
        forms = [text, text[text.index(TERMS_BEGIN[name]) :]] if name in TERMS_BEGIN else [text]
        for form in list(forms):
            terms, end, after = form.partition(TERMS_END)
            forms += [terms, terms + end] if after else []
        texts.setdefault(name, []).extend(forms)
    for name, titles in TITLES.items():
        whole = texts[name][-1]
        for title in ["", *titles]:
            texts[name] += [f"{title}\n{whole}", f"{title}\n{RESERVED}\n{whole}"]
    return texts


def known_digests(docs: DataFrame, known: dict[str, list[str]]) -> dict[str, str]:
    """The id by digest of each known text, by the same expressions as the documents; bounded by ``known``."""
    rows = [(name, text) for name, texts in known.items() for text in texts]
    table = docs.sparkSession.createDataFrame(rows, "license string, text string")
    digest = F.sha2(canonical(F.col("text")), 256).alias("known_digest")
    found = table.select(digest, "license").groupBy("known_digest").agg(F.min("license").alias("license"))
    return {r["known_digest"]: r["license"] for r in found.collect()}


def scan_licenses(
    docs: DataFrame, known: dict[str, list[str]] | None = None, id_column: str = "doc_id", text_column: str = "text"
) -> DataFrame:
    """One row per document: ``doc_id``, ``digest`` of the canonical text, ``license``, ``notices``.

    ``known`` holds texts by id; without it, those of ``known_texts``.
    """
    by_digest = known_digests(docs, known_texts() if known is None else known)
    lookup = F.create_map(*[F.lit(x) for pair in by_digest.items() for x in pair]) if by_digest else None
    digests = docs.sparkSession.createDataFrame(list(by_digest.items()), "known_digest string, license string")
    runs = F.transform(F.split(F.coalesce("text", F.lit("")), BLANK_LINES), plain_lines)
    rows = pick(docs, doc_id=id_column, text=text_column).withColumn("runs", runs)
    whole = lambda lines: F.sha2(one_spelling(F.array_join(lines, " ")), 256)
    lines = F.flatten("runs")
    scanned = rows.select(
        "doc_id",
        whole(lines).alias("digest"),
        F.array_distinct(F.concat(
            F.transform(lines, lambda x: F.sha2(one_spelling(x), 256)),
            F.transform(F.filter("runs", lambda x: (F.size(x) > 1) & (F.size(x) < F.size(lines))), whole),
        )).alias("unit_digests"),
    )
    names = F.filter(F.transform("unit_digests", lambda d: lookup[d]), lambda x: x.isNotNull()) if by_digest else F.array().cast("array<string>")
    return scanned.join(F.broadcast(digests), scanned["digest"] == digests["known_digest"], "left").select(
        "doc_id", "digest", "license", F.array_join(F.array_sort(F.array_distinct(names)), ",").alias("notices")
    )
