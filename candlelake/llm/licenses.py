"""License scan by canonical digest: normalise a whole text, hash it, join it to the digests of known licences.

Normalisation: lower case, copyright lines removed, equivalent spellings unified within words, punctuation and white space
folded, so that neither line breaks nor spaces matter. A unit is a whole document, or one line of it (for one-line
notices). Both are joined by the digest of their entire normalised text; a whole document also with its copyright lines, as
long licences hold some of their own that a text with other line breaks has amid its lines. All of it is DataFrame
operations.
"""

from __future__ import annotations

import json
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import texts

# The texts of public licences and their usual one-line notices.
MIT = """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:

The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.

THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."""
ISC = """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.

THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE."""
BSD_HEAD = """Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:

1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.

2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution."""
BSD_NAMES = """3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission."""
BSD_TAIL = """THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."""
ZLIB = """This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable for any damages arising from the use of this software.

Permission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it and redistribute it freely, subject to the following restrictions:

1. The origin of this software must not be misrepresented; you must not claim that you wrote the original software. If you use this software in a product, an acknowledgment in the product documentation would be appreciated but is not required.

2. Altered source versions must be plainly marked as such, and must not be misrepresented as being the original software.

3. This notice may not be removed or altered from any source distribution."""
APACHE_NOTICE = """Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License. You may obtain a copy of the License at

    http://www.apache.org/licenses/LICENSE-2.0

Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions and limitations under the License."""

#: Names that a notice gives a licence, and its SPDX identifiers.
NAMES = {
    "MIT": (["MIT", "MIT License", "MIT License (MIT)"], ["MIT"]),
    "ISC": (["ISC", "ISC License"], ["ISC"]),
    "Zlib": (["zlib", "zlib License"], ["Zlib"]),
    "BSD-2-Clause": (["BSD-2-Clause", "BSD-2-Clause License", "Simplified BSD License"], ["BSD-2-Clause"]),
    "BSD-3-Clause": (["BSD-3-Clause", "BSD-3-Clause License", "New BSD License", "Modified BSD License"], ["BSD-3-Clause"]),
    "Apache-2.0": (["Apache-2.0", "Apache License, Version 2.0", "Apache License 2.0", "Apache-2.0 License"], ["Apache-2.0"]),
    "GPL-2.0": (["GNU General Public License, Version 2", "GNU General Public License v2.0", "GNU GPL v2", "GPL v2", "GPLv2", "GPL-2.0"], ["GPL-2.0", "GPL-2.0-only", "GPL-2.0-or-later"]),
    "GPL-3.0": (["GNU General Public License, Version 3", "GNU General Public License v3.0", "GNU GPL v3", "GPL v3", "GPLv3", "GPL-3.0"], ["GPL-3.0", "GPL-3.0-only", "GPL-3.0-or-later"]),
    "LGPL-2.1": (["GNU Lesser General Public License, Version 2.1", "GNU LGPL v2.1", "LGPL v2.1", "LGPLv2.1", "LGPL-2.1"], ["LGPL-2.1", "LGPL-2.1-only", "LGPL-2.1-or-later"]),
    "LGPL-3.0": (["GNU Lesser General Public License, Version 3", "GNU Lesser General Public License v3.0", "GNU LGPL v3", "LGPL v3", "LGPLv3", "LGPL-3.0"], ["LGPL-3.0", "LGPL-3.0-only", "LGPL-3.0-or-later"]),
    "MPL-2.0": (["Mozilla Public License, Version 2.0", "Mozilla Public License 2.0", "MPL 2.0"], ["MPL-2.0"]),
    "Unlicense": (["Unlicense"], ["Unlicense"]),
    "CC0-1.0": (["CC0", "CC0 1.0", "CC0 1.0 Universal", "Creative Commons Zero v1.0 Universal"], ["CC0-1.0"]),
} | {
    f"CC-{short}-4.0": ([f"CC {short} 4.0", f"Creative Commons {long} 4.0", f"Creative Commons {long} 4.0 License", f"Creative Commons {long} 4.0 International", f"Creative Commons {long} 4.0 International License"], [f"CC-{short}-4.0"])
    for short, long in {
        "BY": "Attribution", "BY-SA": "Attribution-ShareAlike", "BY-NC": "Attribution-NonCommercial", "BY-ND": "Attribution-NoDerivatives",
        "BY-NC-SA": "Attribution-NonCommercial-ShareAlike", "BY-NC-ND": "Attribution-NonCommercial-NoDerivatives",
    }.items()
}
NOTICES = [
    (i, f"{subject}{verb} under {article}{name}.")
    for i, (names, _) in NAMES.items() for name in names for article in ("", "the ", "a ", "the terms of the ")
    for verb in ("licensed", "released", "distributed") for subject in ("", "This work is ", "This project is ", "This software is ")
] + [(i, f"SPDX-License-Identifier: {spdx}") for i, (_, ids) in NAMES.items() for spdx in ids]


def _full_texts() -> list[tuple[str, str]]:
    """The long licences, whole and without what they append on how to apply them."""
    out = []
    for path in sorted((Path(__file__).parent / "license_texts").glob("*.txt")):
        whole = path.read_text("utf-8")
        end = whole.find("END OF TERMS AND CONDITIONS")
        out += [(path.stem, whole)] + ([(path.stem, whole[:end]), (path.stem, whole[:end] + "END OF TERMS AND CONDITIONS")] if end >= 0 else [])
    return out


#: (licence identifier, its entire text). A user may pass a table of their own with these two columns.
KNOWN_LICENSES = [
    ("MIT", MIT), ("MIT", "MIT License\n\n" + MIT), ("MIT", "The MIT License (MIT)\n\n" + MIT),
    ("ISC", ISC), ("ISC", "ISC License\n\n" + ISC),
    ("BSD-2-Clause", f"{BSD_HEAD}\n\n{BSD_TAIL}"), ("BSD-2-Clause", f"BSD 2-Clause License\n\n{BSD_HEAD}\n\n{BSD_TAIL}"),
    ("BSD-3-Clause", f"{BSD_HEAD}\n\n{BSD_NAMES}\n\n{BSD_TAIL}"), ("BSD-3-Clause", f"BSD 3-Clause License\n\n{BSD_HEAD}\n\n{BSD_NAMES}\n\n{BSD_TAIL}"),
    ("Zlib", ZLIB), ("Zlib", "zlib License\n\n" + ZLIB),
    ("Apache-2.0", APACHE_NOTICE),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0 (the \"License\")"),
    ("Apache-2.0", "SPDX-License-Identifier: Apache-2.0"),
    ("MIT", "Licensed under the MIT License."), ("MIT", "This project is licensed under the MIT License."),
    ("MIT", "Released under the MIT License."), ("MIT", "SPDX-License-Identifier: MIT"),
    ("BSD-3-Clause", "SPDX-License-Identifier: BSD-3-Clause"), ("BSD-2-Clause", "SPDX-License-Identifier: BSD-2-Clause"),
    ("ISC", "SPDX-License-Identifier: ISC"), ("Zlib", "SPDX-License-Identifier: Zlib"),
    ("GPL-3.0", "SPDX-License-Identifier: GPL-3.0-only"), ("GPL-3.0", "Licensed under the GNU General Public License, Version 3."),
    ("GPL-2.0", "SPDX-License-Identifier: GPL-2.0-only"), ("GPL-2.0", "Licensed under the GNU General Public License, Version 2."),
    ("MPL-2.0", "SPDX-License-Identifier: MPL-2.0"), ("MPL-2.0", "Licensed under the Mozilla Public License, Version 2.0."),
    ("CC-BY-4.0", "SPDX-License-Identifier: CC-BY-4.0"), ("CC-BY-4.0", "Licensed under the Creative Commons Attribution 4.0 International License."),
    ("CC0-1.0", "SPDX-License-Identifier: CC0-1.0"),
    *_full_texts(), *NOTICES,
]

#: Lines that only say whose work it is and from when; "the above copyright notice" isn't one.
COPYRIGHT_LINE = r"^[ \t]*(?:[#*/;%-]+[ \t]*)?(?:copyright[^\n]*(?:[0-9]{4}|©|\(c\))|©|\(c\)[ \t]+(?:copyright|[0-9]{4}))[^\n]*$|^[ \t]*all rights reserved\.?[ \t]*$"
#: (spelling, the one that it counts as), in lower case and applied in order. None has white space in it, so that line breaks
#: don't matter.
SPELLINGS = [
    ("licenc", "licens"), ("sub-licens", "sublicens"), ("non-infringement", "noninfringement"), ("acknowledgement", "acknowledgment"), ("favour", "favor"), ("organisation", "organization"),
    ("merchantibility", "merchantability"), ("owner", "holder"), ("https:", "http:"),
]
FOLDED = r"[^\p{L}\p{N}]+"
FOLDED_IN_LINE = r"[^\p{L}\p{N}\n]+"
#: The number of a version, as in "v2".
SHORT_VERSION = r"(^|[^\p{L}\p{N}])v([0-9])"
LONG_VERSION = r"$1version $2"


def _folded(text: Column, apart: str, cut: bool = True) -> Column:
    """The text, without copyright lines if these are cut, in one spelling; runs of characters that match ``apart`` are one
    space."""
    out = F.lower(text)
    out = F.regexp_replace(out, "(?md)" + COPYRIGHT_LINE, " ") if cut else out
    for spelling, same in SPELLINGS:
        out = F.replace(out, F.lit(spelling), F.lit(same))
    return F.regexp_replace(F.regexp_replace(out, apart, " "), SHORT_VERSION, LONG_VERSION)


def canonical(text: Column, cut: bool = True) -> Column:
    """The normalised form of a text."""
    return F.trim(_folded(text, FOLDED, cut))


def canonical_lines(text: Column) -> Column:
    """The normalised forms of a text's lines, without empty ones; joined by spaces they are that of the text."""
    lines = F.transform(F.split(_folded(text, FOLDED_IN_LINE), r"\n"), lambda x: F.trim(x))
    return F.filter(lines, lambda x: x != "")


def _sha(x: Column) -> Column:
    return F.sha2(x.cast("binary"), 256)


def digest(text: Column) -> Column:
    """Hex SHA-256 of the normalised text in UTF-8."""
    return _sha(canonical(text))


def known_digests(spark: SparkSession, licenses: list[tuple[str, str]] | None = None) -> DataFrame:
    """license_digest, license_id: one row for each distinct digest; of several licences, the first by name."""
    # One literal for all of them: a literal for each would make the plan long.
    rows = [{"license_id": i, "license_text": t} for i, t in licenses or KNOWN_LICENSES]
    rows = F.explode(F.from_json(F.lit(json.dumps(rows)), "array<struct<license_id:string,license_text:string>>"))
    both = F.explode(F.array(digest(F.col("k.license_text")), _sha(canonical(F.col("k.license_text"), cut=False))))
    return spark.range(1).select(rows.alias("k")).select(both.alias("license_digest"), "k.license_id").groupBy("license_digest").agg(F.min("license_id").alias("license_id"))


def license_scan(docs: DataFrame, known: DataFrame | None = None) -> DataFrame:
    """Per document: doc_id, text_digest, license_id (null unless the whole text is a known licence), notices (sorted array
    of the licences whose text or notice is a whole line of the text), n_notices.

    A null text counts as empty; empty or punctuation-only texts match nothing. Every line is judged, whatever its length,
    of texts of any length. Each row that repeats a doc_id, or has none, is judged for itself. An empty table gives an empty
    result; extra columns are ignored, whatever their names. ``known`` (license_digest, license_id) is a list of licences; it is
    broadcast when Spark finds it small and is joined by hash otherwise.
    """
    spark = docs.sparkSession
    known = known_digests(spark) if known is None else known
    uncut = F.when(F.lower("text").rlike("(?md)" + COPYRIGHT_LINE), _sha(canonical(F.col("text"), cut=False)))
    rows = texts(docs).select("doc_id", F.monotonically_increasing_id().alias("row"), canonical_lines(F.col("text")).alias("lines"), uncut.alias("uncut"))
    rows = rows.select("doc_id", "row", _sha(F.array_join("lines", " ")).alias("text_digest"), "uncut", F.transform(F.array_distinct("lines"), _sha).alias("lines"))
    known = known.where(F.col("license_digest") != F.sha2(F.lit("").cast("binary"), 256))
    # Lines carry their document's row through the join; the rows come from the same scan, so no key is matched up.
    units = rows.select("doc_id", "row", "text_digest", F.explode(F.concat(
        F.transform(F.array_distinct(F.array_compact(F.array("text_digest", "uncut"))), lambda x: F.struct(F.lit(True).alias("whole"), x.alias("unit"))),
        F.transform("lines", lambda x: F.struct(F.lit(False).alias("whole"), x.alias("unit"))))).alias("u"))
    units = units.select("doc_id", "row", "text_digest", "u.whole", "u.unit")
    found = units.join(known, units.unit == known.license_digest, "left").where(F.col("whole") | F.col("license_digest").isNotNull())
    out = found.groupBy("row", "doc_id", "text_digest").agg(F.min(F.when(F.col("whole"), F.col("license_id"))).alias("license_id"), F.array_sort(F.collect_set(F.when(~F.col("whole"), F.col("license_id")))).alias("notices"))
    return out.select("doc_id", "text_digest", "license_id", "notices", F.size("notices").cast("long").alias("n_notices"))


def oracle(licenses: list[tuple[str, str]] | None = None) -> str:
    """DuckDB SQL of the query's result."""
    quote = lambda x: "'" + x.replace("'", "''") + "'"

    def sha(x: str, cut: bool = True) -> str:
        x = f"regexp_replace(lower({x}), {quote('(?m)' + COPYRIGHT_LINE)}, ' ', 'g')" if cut else f"lower({x})"
        for spelling, same in SPELLINGS:
            x = f"replace({x}, {quote(spelling)}, {quote(same)})"
        x = f"regexp_replace(regexp_replace({x}, {quote(FOLDED)}, ' ', 'g'), {quote(SHORT_VERSION)}, {quote(LONG_VERSION.replace('$', chr(92)))}, 'g')"
        return f"sha256(trim({x}))"

    values = ", ".join(f"({quote(i)}, {quote(t)})" for i, t in licenses or KNOWN_LICENSES)
    return f"""
WITH k AS (SELECT h, min(i) AS i FROM (SELECT i, unnest([{sha("t")}, {sha("t", False)}]) AS h FROM (VALUES {values}) v(i, t)) GROUP BY h),
     d AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS text FROM documents),
     l AS (SELECT r, {sha("line")} AS h FROM (SELECT DISTINCT r, unnest(string_split(text, chr(10))) AS line FROM d) WHERE regexp_matches(line, '[\\p{{L}}\\p{{N}}]')),
     n AS (SELECT r, list_sort(list(DISTINCT k.i)) AS notices FROM l JOIN k USING (h) GROUP BY r)
SELECT doc_id, {sha("text")} AS text_digest, least(k.i, u.i) AS license_id, coalesce(n.notices, []) AS notices, len(coalesce(n.notices, [])) AS n_notices
FROM d LEFT JOIN k ON {sha("text")} = k.h LEFT JOIN k u ON {sha("text", False)} = u.h LEFT JOIN n USING (r)
"""
