"""Licence scans by canonical digest.

A text becomes canonical by lower-casing A-Z, dropping copyright lines, taking
equivalent spellings for one and turning punctuation into single spaces.  The
SHA-256 of a whole canonical text, and of each of its lines, is looked up among
the digests of known licence texts by a hash join.
"""

from __future__ import annotations

import itertools
import json
import string
from importlib import resources

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Public licence notices and short licence texts (complete ones: licenses.json).
KNOWN: tuple[tuple[str, str], ...] = (
    ("MIT", "Released under the MIT License."),
    ("MIT", "Licensed under the MIT License."),
    ("MIT", "SPDX-License-Identifier: MIT"),
    ("MIT", "This project is licensed under the terms of the MIT license."),
    ("MIT", """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:
The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.
THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."""),
    ("ISC", """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.
THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE."""),
    ("0BSD", "SPDX-License-Identifier: 0BSD"),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "SPDX-License-Identifier: Apache-2.0"),
    ("Apache-2.0", """Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License. You may obtain a copy of the License at
http://www.apache.org/licenses/LICENSE-2.0
Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions and limitations under the License."""),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0", "SPDX-License-Identifier: GPL-3.0-only"),
    ("GPL-3.0", "SPDX-License-Identifier: GPL-3.0-or-later"),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2."),
    ("GPL-2.0", "SPDX-License-Identifier: GPL-2.0-only"),
    ("BSD-3-Clause", "SPDX-License-Identifier: BSD-3-Clause"),
    ("BSD-2-Clause", "SPDX-License-Identifier: BSD-2-Clause"),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/."),
    ("MPL-2.0", "SPDX-License-Identifier: MPL-2.0"),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC0-1.0", "This work is dedicated to the public domain under CC0 1.0."),
    ("Unlicense", "This is free and unencumbered software released into the public domain."),
)
#: Spellings taken for one: pattern over lower-case text -> replacement.
EQUIVALENT: tuple[tuple[str, str], ...] = (
    (r"\b(sub)?licen[cs](e|es|ed|ing)\b", "$1licens$2"),
    (r"\bcopyright (?:owner|holder)(s?)\b", "copyright holder$1"),
    (r"\bhttps://", "http://"),
    (r"\b(?:version|ver\.?|v\.?) ?([0-9])", "version $1"),
)
#: A whole line that states a copyright.
COPYRIGHT_LINE = r"(?m)^[^\nA-Za-z]*(?:copyright\b|\(c\)|\x{a9})[^\n]*(?:[0-9]{4}|\(c\)|\x{a9}|all rights reserved)[^\n]*$"

#: Known digests up to which they are broadcast (some 100 bytes each); beyond, Spark shuffles both sides.
BROADCAST_ROWS = 1 << 17


def canonical(text: Column) -> Column:
    """Canonical text; line breaks stay, blank lines and edges are trimmed."""
    out = F.translate(text, string.ascii_uppercase, string.ascii_lowercase)
    out = F.regexp_replace(out, COPYRIGHT_LINE, "")
    for pattern, to in EQUIVALENT:
        out = F.regexp_replace(out, pattern, to)
    out = F.regexp_replace(out, r"[^a-z0-9\n\x{80}-\x{10FFFF}]+", " ")
    out = F.regexp_replace(out, r" *\n[ \n]*", "\n")
    return F.trim(F.regexp_replace(out, r"^\n|\n$", ""))


def digest(canonical_text: Column) -> Column:
    """Digest of a whole canonical text; spellings that a line break parts are taken for one here."""
    out = F.regexp_replace(canonical_text, r"\bcopyright\n(?:owner|holder)(s?)\b", "copyright holder$1")
    out = F.regexp_replace(out, r"\b(?:version|ver|v)\n([0-9])", "version $1")
    return F.sha2(F.regexp_replace(out, r"\n", " ").cast("binary"), 256)


def complete_texts() -> list[tuple[str, str]]:
    """(license_id, body) of the complete public texts in ``licenses.json``: one
    for each choice among the alternatives of a text's pieces (with and without
    title, template lines, appendices)."""
    texts = json.loads(resources.files(__package__).joinpath("licenses.json").read_text("utf-8"))
    return [(license_id, "\n".join(p for p in choice if p)) for license_id, pieces in texts for choice in itertools.product(*pieces)]


def known_digests(spark: SparkSession, known: tuple[tuple[str, str], ...] | None = None) -> DataFrame:
    """(digest, license_id), one row per distinct canonical text (the first
    license_id, where two share one); of ``KNOWN`` and the complete texts if
    ``known`` is None."""
    rows = spark.createDataFrame(list(known) if known is not None else [*KNOWN, *complete_texts()], "license_id string, body string")
    return rows.groupBy(digest(canonical(F.col("body"))).alias("digest")).agg(F.min("license_id").alias("license_id"))


def scan(docs: DataFrame, known: DataFrame | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Licences found: the id column, ``license_id``, ``scope`` (``text``: the
    whole document is the licence; ``line``: one of its lines is) and ``n``,
    how often.

    ``known``: (digest, license_id); the built-in notices and complete texts if None.
    * NULL, empty and blank texts match nothing.
    * Repeated rows, and rows that share an id or have none, add up under it.
    * Extra columns are ignored; an empty table gives an empty result.
    """
    if known is None or known.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS:
        known = F.broadcast(known_digests(docs.sparkSession) if known is None else known)
    # no filter on the canonical text: Spark would compute it once for the filter and once more for its use
    texts = docs.select(F.col(id_col).alias("__id"), canonical(F.col(text_col).cast("string")).alias("__canonical"))
    whole = F.when(F.col("__canonical") != "", digest(F.col("__canonical")))
    lines = F.filter(F.split("__canonical", "\n"), lambda x: x != "")
    units = texts.select("__id", F.explode(F.concat(F.array(F.struct(F.lit("text").alias("scope"), whole.alias("digest"))),
                                                    F.transform(F.coalesce(lines, F.array().cast("array<string>")),
                                                                lambda x: F.struct(F.lit("line").alias("scope"), F.sha2(F.trim(x).cast("binary"), 256).alias("digest"))))).alias("unit"))
    found = units.select("__id", "unit.scope", "unit.digest").join(known.select("digest", "license_id"), "digest")
    return found.groupBy(F.col("__id").alias(id_col), "license_id", "scope").agg(F.count(F.lit(1)).alias("n"))
