"""License scans by canonical digest (native).

A text is normalised (case, equivalent spellings, copyright lines, punctuation, white space) and its MD5
digest looked up among the digests of known texts by a hash join. Whole documents are looked up, and so is
each of their lines, since a notice is often one line of a longer document.
"""

from __future__ import annotations

from collections.abc import Mapping
from importlib import resources

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.frames import pin

# Texts of public licences and common notices, as published.
MIT_GRANT = """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and
associated documentation files (the "Software"), to deal in the Software without restriction, including without
limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the
Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:

The above copyright notice and this permission notice shall be included in all copies or substantial portions of
the Software.
"""
AS_IS = """THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT
LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT
SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION
OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER
DEALINGS IN THE SOFTWARE.
"""
ISC_GRANT = """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee
is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.
"""
ISC_AS_IS = """THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE
INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY
SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR
PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION
WITH THE USE OR PERFORMANCE OF THIS SOFTWARE.
"""
BSD_HEAD = """Redistribution and use in source and binary forms, with or without
modification, are permitted provided that the following conditions are met:
"""
BSD_CONDITIONS = (
    """Redistributions of source code must retain the above copyright notice, this
list of conditions and the following disclaimer.
""",
    """Redistributions in binary form must reproduce the above copyright notice,
this list of conditions and the following disclaimer in the documentation
and/or other materials provided with the distribution.
""",
    """Neither the name of {} nor the names of its
contributors may be used to endorse or promote products derived from
this software without specific prior written permission.
""",
)
BSD_AS_IS = """THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS"
AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE
IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE
DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT {} OR CONTRIBUTORS BE LIABLE
FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL
DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR
SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER
CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY,
OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE
OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE.
"""


def bsd_texts(clauses: int, titles: tuple[str, ...]) -> tuple[str, ...]:
    """The text with and without a title and numbers, as its published forms have them."""
    names = ("the copyright holder", "the copyright holders", "the author") if clauses == 3 else ("",)
    return tuple(
        title + BSD_HEAD + "".join(f"{n}. {c}" if numbers else c for n, c in enumerate(BSD_CONDITIONS[:clauses], 1)).format(name)
        + BSD_AS_IS.format(holder)
        for title in ("", *titles) for numbers in (True, False) for name in names for holder in ("HOLDER", "OWNER", "HOLDERS")
    )


def published(name: str, *ends: str) -> tuple[str, ...]:
    """A text of the folder ``texts``, whole and up to each of ``ends``, after which it only says how to apply it."""
    text = (resources.files("tidemark.llm") / "texts" / f"{name}.txt").read_text("utf-8")
    return (text, *(text[: text.index(end) + len(end)] for end in ends))


KNOWN: Mapping[str, tuple[str, ...]] = {
    "MIT": (
        "MIT License\n" + MIT_GRANT + AS_IS,
        MIT_GRANT + AS_IS,
        "Released under the MIT License.",
        "Licensed under the MIT License.",
        "SPDX-License-Identifier: MIT",
    ),
    "ISC": ("ISC License\n" + ISC_GRANT + ISC_AS_IS, ISC_GRANT + ISC_AS_IS, "SPDX-License-Identifier: ISC"),
    "Apache-2.0": (
        *published("Apache-2.0", "END OF TERMS AND CONDITIONS"),
        "Licensed under the Apache License, Version 2.0.",
        'Licensed under the Apache License, Version 2.0 (the "License");',
        "SPDX-License-Identifier: Apache-2.0",
    ),
    "GPL-3.0": (
        *published("GPL-3.0", "END OF TERMS AND CONDITIONS"),
        "This work is licensed under the GNU General Public License, version 3.",
        "SPDX-License-Identifier: GPL-3.0-only",
        "SPDX-License-Identifier: GPL-3.0-or-later",
    ),
    "CC-BY-NC-4.0": ("Licensed under CC BY-NC 4.0.", "SPDX-License-Identifier: CC-BY-NC-4.0"),
    "CC-BY-4.0": ("Licensed under CC BY 4.0.", "SPDX-License-Identifier: CC-BY-4.0"),
    "BSD-3-Clause": (
        *bsd_texts(3, ("BSD 3-Clause License\n", "The 3-Clause BSD License\n")),
        "SPDX-License-Identifier: BSD-3-Clause",
    ),
    "BSD-2-Clause": (
        *bsd_texts(2, ("BSD 2-Clause License\n", "The 2-Clause BSD License\n")),
        "SPDX-License-Identifier: BSD-2-Clause",
    ),
    "MPL-2.0": (
        *published("MPL-2.0"),
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
        "SPDX-License-Identifier: MPL-2.0",
    ),
}

# Spellings that mean the same, applied in order to lower-cased text.
SPELLINGS = (
    ("licence", "license"),
    ("(c)", "copyright"),
    ("©", "copyright"),
    ("organisation", "organization"),
    ("favour", "favor"),
    ("non-infringement", "noninfringement"),
    ("sub-license", "sublicense"),
    ("http://", "https://"),
)


def canonical_lines(text: Column) -> Column:
    """Normalised lines of a text, without empty and copyright lines. NULL has none."""
    out = F.lower(F.coalesce(text, F.lit("")))
    for spelling, usual in SPELLINGS:
        out = F.replace(out, F.lit(spelling), F.lit(usual))
    out = F.regexp_replace(out, r"[^\p{L}\p{N}\n]+", " ")
    lines = F.transform(F.split(out, "\n"), lambda line: F.btrim(line))
    notice = lambda line: line.startswith("copyright ") | (line == "all rights reserved")
    return F.filter(lines, lambda line: (line != "") & ~notice(line))


def known_digests(spark: SparkSession, known: Mapping[str, tuple[str, ...]] = KNOWN) -> DataFrame:
    """(digest, license) of the known texts, a few rows. Two licences must not share a text."""
    texts = spark.createDataFrame([(name, text) for name, all_ in known.items() for text in all_], "license string, text string")
    digest = F.md5(F.array_join(canonical_lines(F.col("text")), " "))
    return texts.select(digest.alias("digest"), "license").distinct()


def license_scan(docs: DataFrame, known: DataFrame) -> DataFrame:
    """One row per document: doc_id, digest, ``license`` (that of the whole text, else NULL), ``notices``
    (licences of its lines, sorted and joined by commas, else NULL) and ``notice_lines``, their number.

    NULL and empty texts, and texts of copyright lines alone, have the digest of nothing and no licence.
    Repeated rows stay repeated. An empty table gives an empty result; extra columns are not looked at.
    """
    lines = docs.select("doc_id", canonical_lines(F.col("text").cast("string")).alias("lines"))
    digest = F.md5(F.array_join("lines", " "))
    row = lines.select("doc_id", digest.alias("digest"), F.transform("lines", lambda x: F.md5(x)).alias("line_digests"))
    row = row.withColumn("r", F.monotonically_increasing_id())
    # few lines are notices: those that are stay in the row, the rest of the digests goes no further
    notice = known.select(F.collect_set("digest").alias("notice"))  # as many as there are known texts
    row = row.crossJoin(F.broadcast(notice))
    row = pin(row.select("r", "doc_id", "digest", F.filter("line_digests", lambda x: F.array_contains("notice", x)).alias("hits")))
    hits = row.select("r", F.explode("hits").alias("digest")).join(known, "digest")
    by_row = hits.groupBy("r").agg(
        F.array_join(F.array_sort(F.collect_set("license")), ",").alias("notices"), F.count(F.lit(1)).alias("notice_lines")
    )
    out = row.drop("hits").join(known, "digest", "left").join(by_row, "r", "left")
    return out.select("doc_id", "digest", "license", "notices", F.coalesce("notice_lines", F.lit(0)).alias("notice_lines"))
