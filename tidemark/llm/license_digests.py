"""Licence scans by canonical digests.

A text is brought to a canonical form: lower case, copyright lines and list
marks dropped, punctuation turned into blanks, a title before the grant dropped,
equivalent spellings made one, blanks folded. Entire texts whose digest is that
of a known licence or notice are found by an equality join. What counts as a text
is each whole document and each line of it, so a notice that stands on a line of
its own is found as well, and what follows the copyright statement on its line.
Short licences and notices are kept as texts, long ones as digests.

Defined results: a null text and one of which nothing is left match nothing;
all rows of one doc_id get the finds of all of them together; null ids are one document;
an empty table gives an empty result. Columns of the input other than the named
ones play no role.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.frames import let, packed

#: Spellings that mean the same.
SPELLINGS = (
    ("licence", "license"),
    ("licenced", "licensed"),
    ("licences", "licenses"),
    ("sub license", "sublicense"),
    ("sub licence", "sublicense"),
    ("non commercial", "noncommercial"),
    ("non infringement", "noninfringement"),
    ("merchantibility", "merchantability"),
    ("per cent", "percent"),
    ("organisation", "organization"),
    ("modelled", "modeled"),
    ("whilst", "while"),
    ("acknowledgement", "acknowledgment"),
    ("copyright owner", "copyright holder"),
    ("copyright owners", "copyright holders"),
    ("creative commons", "cc"),
    ("https", "http"),
)

_AS_IS = (
    "THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF "
    "MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT."
)
_BSD_HEAD = (
    "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are "
    "met: 1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. "
    "2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the "
    "documentation and/or other materials provided with the distribution. "
)
_BSD_THIRD = (
    "3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this "
    "software without specific prior written permission. "
)
_BSD_TAIL = (
    "THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS \"AS IS\" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT "
    "LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT "
    "HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT "
    "LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY "
    "THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF "
    "THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."
)

#: Identifiers that stand behind an SPDX tag.
SPDX = (
    "0BSD", "AGPL-3.0", "AGPL-3.0-only", "AGPL-3.0-or-later", "Apache-2.0", "BSD-2-Clause", "BSD-3-Clause", "BSL-1.0", "CC-BY-4.0", "CC-BY-NC-4.0",
    "CC-BY-SA-4.0", "CC0-1.0", "EPL-2.0", "GPL-2.0", "GPL-2.0-only", "GPL-2.0-or-later", "GPL-3.0", "GPL-3.0-only", "GPL-3.0-or-later", "ISC",
    "LGPL-2.1", "LGPL-2.1-only", "LGPL-2.1-or-later", "LGPL-3.0", "LGPL-3.0-only", "LGPL-3.0-or-later", "MIT", "MPL-2.0", "Unlicense", "Zlib",
)

#: Fixed values: (SPDX identifier or statement, text) of public licences and of notices that stand for them.
KNOWN = (
    (
        "MIT",
        "MIT License Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation "
        "files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, "
        "merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do "
        "so, subject to the following conditions: The above copyright notice and this permission notice shall be included in all copies or "
        f"substantial portions of the Software. {_AS_IS} IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR "
        "OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE "
        "OR OTHER DEALINGS IN THE SOFTWARE.",
    ),
    (
        "ISC",
        "ISC License Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, "
        "provided that the above copyright notice and this permission notice appear in all copies. THE SOFTWARE IS PROVIDED \"AS IS\" AND THE AUTHOR "
        "DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL "
        "THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA "
        "OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR "
        "PERFORMANCE OF THIS SOFTWARE.",
    ),
    ("BSD-2-Clause", _BSD_HEAD + _BSD_TAIL),
    ("BSD-3-Clause", _BSD_HEAD + _BSD_THIRD + _BSD_TAIL),
    ("MIT", "Released under the MIT License."),
    ("MIT", "Licensed under the MIT License."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "Released under the Apache License, Version 2.0."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC0-1.0", "Released under CC0 1.0."),
    ("BSD-3-Clause", "Licensed under the BSD 3-Clause License."),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    (
        "Apache-2.0",
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License. You may "
        "obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, "
        "software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express "
        "or implied. See the License for the specific language governing permissions and limitations under the License.",
    ),
    ("all-rights-reserved", "All rights reserved."),
    *((name, f"SPDX-License-Identifier: {name}") for name in SPDX),
)

#: Fixed values: (SPDX identifier, first word, digest of the canonical form) of public licences, whole and up to the end of their terms.
DIGESTS: tuple[tuple[str, str, str], ...] = (
    ("Apache-2.0", "apache", "e47c26565f57f0d69b818dcb2ba49c6432329ebac35835ef90a9a64387461b8a"),
    ("Apache-2.0", "apache", "ad5cb4a9133f7b328244a1e5dec5b807680758c9054d9aa23c537d37035c5e4d"),
    ("CC0-1.0", "cc", "9bdf0f12de289272f5d4be6a88e411cfabe8385e9ac3a96c2936d462b2a7cbc3"),
    ("GPL-1.0", "gnu", "fe80ccaae90d81557cc6613b788c47dd1819c7a5ae034f77e7d60bb6b879677e"),
    ("GPL-1.0", "gnu", "8779beee967ecd6ba7edd9e3c1f997470b1a2e73d9a5873e9f077a85b1e41497"),
    ("GPL-2.0", "gnu", "9c942f6942a3d44037aa20b92138b7de02aafd88adea708e7c93f34a145aeaa1"),
    ("GPL-2.0", "gnu", "7314c07a2d29e5446bcf514fee47b5f438deff8b1eed122fa2ee257c02b47bb7"),
    ("GPL-3.0", "gnu", "3695e90f7fe4b461853cec533de5675ab2b6b1fcafcb504d6c64ded76f675d64"),
    ("GPL-3.0", "gnu", "8c24ccf35998bd73317aa0801f6e6cbd865514baf55f246a48a8e890d1abc3d1"),
    ("LGPL-2.0", "gnu", "76e95bde887e452fdbf364b6e132f70904f43582182b76e0f71d88a2d8911ef7"),
    ("LGPL-2.0", "gnu", "60a57d5c27c9e17b09b270fac9dc922bcf9e4d0e88247b5e4953eea523993c29"),
    ("LGPL-2.1", "gnu", "3c172029ca14deedef915e5d03e83bcc73647736d10c2be07d384571ca06b440"),
    ("LGPL-2.1", "gnu", "fc956b94c2648213f33a6d97d5d091ed6f082bac4e64a8f1ef02e9643a7a502c"),
    ("LGPL-3.0", "gnu", "cb8c0f424bdd5c42a0b18285893829d988e9fb9a00d0cd604a59ebe8da7eeb45"),
    ("MPL-1.1", "mozilla", "e4a1b9e7be90fb7d822bee3b051ffa2d4a399899dd467ac4a9287190d948540c"),
    ("MPL-2.0", "mozilla", "26cc26af01574b01bd73424f1463a680ef00356f06b6dda1e111e5c7d08c8708"),
    ("GFDL-1.3", "gnu", "31bf15dcd0a3ede2d36b6c1e306bdb5ed77c42817a54742e0231f25a3869ae10"),
    ("Artistic-1.0", "the", "4834e699353522cfb463bd8b374752ecf02156bb3f5dfb53d0edb502a112a651"),
)


#: The beginning of a line that states a copyright.
_STATES = r"[^\p{L}\p{N}\n©]*(?:copyright\b(?=[^\n]*(?:\(c\)|©|\d{4}))|\(c\)|©)"
_COPYRIGHT = rf"(?m)^{_STATES}[^\n]*$"
#: Numbers and letters of a list, where a line or a clause begins.
_LIST_MARKS = r"(?m)(?:^|(?<=[:;.]))\s*\(?(?:\d{1,2}|[a-z])[.)](?=\s)"
#: A title, where the grant of a licence follows.
_TITLE = r"^(?:(?:the )?(?:[a-z0-9]+ ){0,3}license (?:[a-z0-9]+ ){0,2}?)?(?:all rights reserved )?(?=permission |redistribution )"
_CLAUSE_END = r"(?<=[.;,])\s+"


def _without_copyright(text: Column) -> Column:
    return F.regexp_replace(F.lower(F.coalesce(text, F.lit(""))), _COPYRIGHT, "")


def canonical(text: Column) -> Column:
    """The canonical form of a text, empty for null."""
    listed = F.regexp_replace(_without_copyright(text), _LIST_MARKS, " ")
    form = F.trim(F.regexp_replace(listed, r"[^\p{L}\p{N}]+", " "))
    for other, one in SPELLINGS:
        form = F.regexp_replace(form, rf"(?<![^ ]){other}(?![^ ])", one)
    return F.regexp_replace(form, _TITLE, "")


def digest(text: Column) -> Column:
    """SHA-256 of the canonical form; null where nothing is left."""
    return let(canonical(text), lambda form: F.when(form != "", F.sha2(form, 256)))


def known_digests(spark: SparkSession, known: tuple[tuple[str, str], ...] = KNOWN, digests: tuple[tuple[str, str, str], ...] = DIGESTS) -> DataFrame:
    """(known, license), one row per known text."""
    values = spark.createDataFrame(list(known), "license string, text string").select(digest(F.col("text")).alias("known"), "license")
    if digests:
        values = values.union(spark.createDataFrame([(d, name) for name, _, d in digests], "known string, license string"))
    return values.distinct()


def first_words(known: tuple[tuple[str, str], ...], digests: tuple[tuple[str, str, str], ...] = DIGESTS) -> list[str]:
    """The words with which a text must begin, after its copyright lines, to match any known one."""
    found = {re.search(r"[^\W_]+", text.lower()).group() for _, text in known} | {word for _, word, _ in digests}
    return sorted(found | {other.split()[0] for other, one in SPELLINGS if one.split()[0] in found})


def clauses(known: tuple[tuple[str, str], ...]) -> int:
    """How many clauses the known text with the most clauses has."""
    return max(len(re.findall(r"[.;,]\s", text)) + 1 for _, text in known)


def candidates(text: Column, most_clauses: int) -> Column:
    """The entire texts of a line: itself or, where it states a copyright, what follows at each clause from which a known text could fill the rest."""

    def rests(parts: Column) -> Column:
        last = F.slice(parts, F.greatest(F.size(parts) - most_clauses + 1, F.lit(1)), most_clauses)
        return F.transform(last, lambda _, i: F.concat_ws(" ", F.slice(last, i + 1, most_clauses)))

    stated = F.lower(text).rlike(rf"^{_STATES}")
    return F.when(stated, let(F.split(text, _CLAUSE_END), rests)).otherwise(F.array(text))


def scanned(
    docs: DataFrame,
    known: tuple[tuple[str, str], ...] = KNOWN,
    digests: tuple[tuple[str, str, str], ...] = DIGESTS,
    text: str = "text",
    doc_id: str = "doc_id",
) -> DataFrame:
    """(doc_id, document_license, line_licenses, n_license_lines): one row per row of ``docs``.

    A text that doesn't begin like any known one is not brought to its form.
    Only finds are summed by document; texts are never shuffled. A document's
    own licence is the least of several.
    """
    rows = packed(docs, [], doc_id=doc_id, text=text).withColumn("text", F.coalesce("text", F.lit("")))
    most = clauses(known)
    unit = lambda whole, value: F.struct(F.lit(whole).alias("whole"), value.alias("unit"))
    lines = F.flatten(F.transform(F.split("text", "\n"), lambda line: F.transform(candidates(line, most), lambda c: unit(False, c))))
    alone = F.when(F.instr("text", "\n") > 0, F.array(F.col("text"))).otherwise(candidates(F.col("text"), most))
    units = F.concat(F.transform(alone, lambda c: unit(True, c)), lines)
    units = rows.select("doc_id", F.explode(units).alias("u")).select("doc_id", "u.*")
    begin = F.regexp_extract(F.regexp_replace(_without_copyright(F.col("unit")), _LIST_MARKS, " "), r"^[^\p{L}\p{N}]*([\p{L}\p{N}]+)", 1)
    # behind a title comes a grant
    titled = F.lower("unit").rlike(r"(?:permission|redistribution)\s")
    units = units.filter(titled | begin.isin(first_words(known, digests))).withColumn("digest", digest(F.col("unit")))
    hits = units.join(known_digests(docs.sparkSession, known, digests), F.col("digest") == F.col("known"))
    found = hits.groupBy(F.col("doc_id").alias("of")).agg(
        F.min(F.when(F.col("whole"), F.col("license"))).alias("document_license"),
        F.concat_ws(",", F.array_sort(F.collect_set(F.when(~F.col("whole"), F.col("license"))))).alias("line_licenses"),
        F.sum(F.when(F.col("whole"), 0).otherwise(1)).cast("long").alias("n_license_lines"),
    )
    joined = rows.select("doc_id").join(found, F.col("doc_id").eqNullSafe(F.col("of")), "left")
    lines_found = F.coalesce("line_licenses", F.lit("")).alias("line_licenses")
    return joined.select("doc_id", "document_license", lines_found, F.coalesce("n_license_lines", F.lit(0).cast("long")).alias("n_license_lines"))
