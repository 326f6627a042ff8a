"""Licence scan by canonical digests.

A text is brought to a canonical form: A-Z in lower case, lines of copyright holders dropped, punctuation, and
with it line ends and the marks of comments, turned into single blanks, equivalent spellings made one. A line names
a holder if it begins, comment marks aside, with the word copyright and a sign or year, or a sign and a year. The digest of the entire form is hash-joined to
the digests of known licence texts. Whole documents are looked up, and so is every line of a document as a
text of its own, which finds licence notices inside other text. The known digests are a fixed, small table,
so the join shuffles no text; only matched lines are grouped. Holders and punctuation end with their line, so a text and
its lines share these steps; spellings may span lines, and are made one in both.

Edge cases: a null text counts as empty; an empty canonical form matches nothing; very long texts and lines
are digested whole; a notice that a document repeats counts each time but is named once; rows that repeat
id and text share their counts; an empty table gives an empty result; other columns of the input
are not read, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lodeworks.llm.frames import LOWER, UPPER, documents, map_batches, text_of, written

#: Rows whose texts are brought to their forms at a time, by Arrow's string functions.
ROWS = 200
FORMS = "doc_id long, row long, whole boolean, form string"

#: Steps of the canonical form as patterns and replacements, in RE2's syntax.
COPYRIGHT = (
    r"(^|\n)[ \t#*;/%!<>-]*(portions[ \t]+)?"
    r"(copyright[ \t:,]*(\(c\)|\x{A9}|[<\[]?[0-9]{4}|[<\[]year)|(\(c\)|\x{A9})[ \t]*(copyright[ \t]*)?[0-9]{4})[^\n]*"
)
PUNCTUATION = r"[\x00-\x2F\x3A-\x60\x7B-\x7F\x{A0}\x{A9}\x{2010}-\x{2027}]+"

#: Equivalent spellings, as whole words between blanks.
SPELLINGS = (
    ("all rights reserved", ""),
    ("licence", "license"), ("licences", "licenses"), ("licenced", "licensed"), ("sub license", "sublicense"),
    ("non commercial", "noncommercial"), ("organisation", "organization"), ("favour", "favor"),
    ("acknowledgement", "acknowledgment"), ("merchantibility", "merchantability"), ("per cent", "percent"),
    ("v1", "version 1"), ("v2", "version 2"), ("v3", "version 3"), ("v4", "version 4"),
    ("gnu gpl", "gnu general public license"), ("cc by", "creative commons attribution"),
    ("attribution nc", "attribution noncommercial"),
)

_AS_IS = (
    'THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO '
    "THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE "
    "AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF "
    "CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS "
    "IN THE SOFTWARE."
)
_ISC_AS_IS = (
    'THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING '
    "ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, "
    "DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, "
    "WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE "
    "USE OR PERFORMANCE OF THIS SOFTWARE."
)
_BSD_AS_IS = (
    'THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, '
    "INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE "
    "DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, "
    "SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR "
    "SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, "
    "WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE "
    "USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."
)
_BSD = (
    "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the "
    "following conditions are met:\n\n1. Redistributions of source code must retain the above copyright notice, this "
    "list of conditions and the following disclaimer.\n\n2. Redistributions in binary form must reproduce the above "
    "copyright notice, this list of conditions and the following disclaimer in the documentation and/or other "
    "materials provided with the distribution.\n\n"
)
_BSD_NAMES = (
    "3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote "
    "products derived from this software without specific prior written permission.\n\n"
)
#: Identifier, title and body of whole texts; a copy may have the title or not.
_TITLED = (
    ("MIT", "MIT License", "Permission is hereby granted, free of charge, to any person obtaining a copy of this "
     'software and associated documentation files (the "Software"), to deal in the Software without restriction, '
     "including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or "
     "sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the "
     "following conditions:\n\nThe above copyright notice and this permission notice shall be included in all copies "
     "or substantial portions of the Software.\n\n" + _AS_IS),
    ("MIT-0", "MIT No Attribution", "Permission is hereby granted, free of charge, to any person obtaining a copy of "
     'this software and associated documentation files (the "Software"), to deal in the Software without restriction, '
     "including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or "
     "sell copies of the Software, and to permit persons to whom the Software is furnished to do so.\n\n" + _AS_IS),
    ("ISC", "ISC License", "Permission to use, copy, modify, and/or distribute this software for any purpose with or "
     "without fee is hereby granted, provided that the above copyright notice and this permission notice appear in "
     "all copies.\n\n" + _ISC_AS_IS),
    ("0BSD", "BSD Zero Clause License", "Permission to use, copy, modify, and/or distribute this software for any "
     "purpose with or without fee is hereby granted.\n\n" + _ISC_AS_IS),
    ("BSD-2-Clause", "BSD 2-Clause License", _BSD + _BSD_AS_IS),
    ("BSD-3-Clause", "BSD 3-Clause License", _BSD + _BSD_NAMES + _BSD_AS_IS),
    ("Zlib", "zlib License", "This software is provided 'as-is', without any express or implied warranty. In no event "
     "will the authors be held liable for any damages arising from the use of this software.\n\nPermission is granted "
     "to anyone to use this software for any purpose, including commercial applications, and to alter it and "
     "redistribute it freely, subject to the following restrictions:\n\n1. The origin of this software must not be "
     "misrepresented; you must not claim that you wrote the original software. If you use this software in a product, "
     "an acknowledgment in the product documentation would be appreciated but is not required.\n\n2. Altered source "
     "versions must be plainly marked as such, and must not be misrepresented as being the original software.\n\n"
     "3. This notice may not be removed or altered from any source distribution."),
    ("Unlicense", "The Unlicense", "This is free and unencumbered software released into the public domain.\n\nAnyone "
     "is free to copy, modify, publish, use, compile, sell, or distribute this software, either in source code form or "
     "as a compiled binary, for any purpose, commercial or non-commercial, and by any means.\n\nIn jurisdictions that "
     "recognize copyright laws, the author or authors of this software dedicate any and all copyright interest in the "
     "software to the public domain. We make this dedication for the benefit of the public at large and to the "
     "detriment of our heirs and successors. We intend this dedication to be an overt act of relinquishment in "
     "perpetuity of all present and future rights to this software under copyright law.\n\n"
     'THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO '
     "THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE "
     "AUTHORS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR "
     "OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."
     "\n\nFor more information, please refer to <https://unlicense.org>"),
    ("Apache-2.0", "Apache License 2.0", 'Licensed under the Apache License, Version 2.0 (the "License"); you may not use '
     "this file except in compliance with the License. You may obtain a copy of the License at\n\n"
     "http://www.apache.org/licenses/LICENSE-2.0\n\nUnless required by applicable law or agreed to in writing, software "
     'distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, '
     "either express or implied. See the License for the specific language governing permissions and limitations under "
     "the License."),
    ("MPL-2.0", "Mozilla Public License 2.0", "This Source Code Form is subject to the terms of the Mozilla Public "
     "License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at "
     "http://mozilla.org/MPL/2.0/."),
)


def _gnu(name: str, version: int, later: str) -> str:
    """The notice that files under a GNU licence carry."""
    return (
        f"This program is free software: you can redistribute it and/or modify it under the terms of the {name} as "
        f"published by the Free Software Foundation, either version {version} of the License, or {later}any later "
        "version.\n\nThis program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without "
        f"even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the {name} for more "
        f"details.\n\nYou should have received a copy of the {name} along with this program. If not, see "
        "<https://www.gnu.org/licenses/>."
    )


_GNU = (
    ("GPL-2.0-or-later", "GNU General Public License", 2), ("GPL-3.0-or-later", "GNU General Public License", 3),
    ("LGPL-3.0-or-later", "GNU Lesser General Public License", 3),
    ("AGPL-3.0-or-later", "GNU Affero General Public License", 3),
)
#: Licence texts, and as fixed values notices, by identifier. More are given by `scan`'s parameter.
KNOWN = (
    *[(name, f"{title}\n\n{body}") for name, title, body in _TITLED],
    *[(name, body) for name, _, body in _TITLED],
    *[(name, _gnu(title, version, later)) for name, title, version in _GNU for later in ("(at your option) ", "")],
    ("MIT", "Released under the MIT License."),
    ("MIT", "Licensed under the MIT License."),
    ("MIT", "This project is licensed under the MIT License."),
    ("MIT", "SPDX-License-Identifier: MIT"),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "Released under the Apache License, Version 2.0."),
    ("Apache-2.0", 'Licensed under the Apache License, Version 2.0 (the "License");'),
    ("Apache-2.0", "SPDX-License-Identifier: Apache-2.0"),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0", "Licensed under the GNU General Public License, version 3."),
    ("GPL-3.0", "SPDX-License-Identifier: GPL-3.0-only"),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-NC-4.0", "This work is licensed under CC BY-NC 4.0."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC0-1.0", "SPDX-License-Identifier: CC0-1.0"),
    ("BSD-3-Clause", "SPDX-License-Identifier: BSD-3-Clause"),
)


def _cleaned(texts: pa.Array) -> pa.Array:
    """Texts without holders and punctuation, their lines still apart; two blanks between words."""
    # Offsets of 64 bits: a blank for a mark makes texts longer.
    out = pc.replace_substring_regex(pc.ascii_lower(texts.cast(pa.large_string())), COPYRIGHT, "\n")
    return pc.replace_substring_regex(out, PUNCTUATION.replace(r"\x00-\x2F", r"\x00-\x09\x0B-\x2F"), "  ")


def _spelled(texts: pa.Array) -> pa.Array:
    """Blanks around the words, equivalent spellings made one, single blanks between words."""
    blank, nothing = pa.scalar(" ", texts.type), pa.scalar("", texts.type)
    out = pc.binary_join_element_wise(blank, pc.utf8_trim(texts, " "), blank, nothing)
    for old, new in SPELLINGS:
        out = pc.replace_substring(out, _apart(old), _apart(new))
    return pc.replace_substring(out, "  ", " ")  # each word has brought one blank for either side


def _whole(cleaned: pa.Array) -> pa.Array:
    """The canonical form of each text."""
    return pc.utf8_trim(_spelled(pc.replace_substring_regex(cleaned, r" *\n[ \n]*", "  ")), " ").cast(pa.string())


def _lines(cleaned: pa.Array) -> pa.Array:
    """The canonical forms of each text's lines, as lists; each line has blanks of its own, so no spelling spans two."""
    out = _spelled(pc.replace_substring_regex(cleaned, r" *\n *", " \n "))
    return pc.split_pattern(out, "\n")


def canonical(texts: list[str]) -> list[str]:
    """The canonical forms of whole texts."""
    return _whole(_cleaned(pa.array(texts, pa.string()))).to_pylist()


def _forms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """doc_id, row, whether whole, form: of each (doc_id, row, body) the form of the text, and of its lines that have one."""
    for batch in batches:
        for at in range(0, batch.num_rows, ROWS):
            # Copied, not sliced: Arrow's ascii_lower is wrong on an array that starts inside another.
            doc_ids, rows, bodies = batch.take(pa.array(range(at, min(at + ROWS, batch.num_rows)))).columns
            cleaned = _cleaned(bodies)
            yield _batch(doc_ids, rows, True, _whole(cleaned))
            lists = _lines(cleaned)
            lines, of = pc.utf8_trim(pc.list_flatten(lists), " ").cast(pa.string()), pc.list_parent_indices(lists)
            some = pc.not_equal(lines, "")
            of = of.filter(some)
            yield _batch(doc_ids.take(of), rows.take(of), False, lines.filter(some))


def _batch(doc_ids: pa.Array, rows: pa.Array, whole: bool, forms: pa.Array) -> pa.RecordBatch:
    flags = pa.repeat(pa.scalar(whole), len(forms))
    return pa.RecordBatch.from_arrays([doc_ids, rows, flags, forms], ["doc_id", "row", "whole", "form"])


def _apart(words: str) -> str:
    """Words as they stand among others, each between blanks of its own."""
    return "".join(f" {w} " for w in words.split())


def digest(form: str) -> Column:
    return F.sha2(F.col(form).cast("binary"), 256)


def known_digests(spark: SparkSession, known=KNOWN) -> DataFrame:
    """(license, known): the digest of each text that has a form, once."""
    forms = zip([name for name, _ in known], canonical([body for _, body in known]))
    texts = spark.createDataFrame([pair for pair in forms if pair[1]], "license string, form string")
    return texts.groupBy(digest("form").alias("known")).agg(F.min("license").alias("license"))


def scan(docs: DataFrame, known=KNOWN) -> DataFrame:
    """doc_id, digest, license of the whole text, notices (named once, sorted) and n_notices of every row."""
    spark = docs.sparkSession
    table = F.broadcast(known_digests(spark, known))  # the fixed table, or the one that the caller names
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_of().alias("body"))
    forms = map_batches(rows.select("doc_id", F.xxhash64("body").alias("row"), "body"), _forms, FORMS)
    looked = forms.select("doc_id", "row", "whole", digest("form").alias("known")).join(table, "known", "left")
    # Written, so that texts are brought to their forms once: whole texts, and the few lines that are known.
    looked = written(looked.filter(F.col("whole") | F.col("license").isNotNull()), "licenses")
    found = looked.filter(~F.col("whole")).groupBy("doc_id", "row", "license").agg(F.count("*").alias("many"))
    found = found.groupBy("doc_id", "row").agg(
        F.array_join(F.sort_array(F.collect_list("license")), ",").alias("notices"), F.sum("many").alias("many")
    )
    found = written(found, "notices").toDF("at_id", "at_row", "notices", "many")
    same = F.col("doc_id").eqNullSafe(F.col("at_id")) & (F.col("row") == F.col("at_row"))
    both = looked.filter("whole").join(found, same, "left")
    return both.select(
        "doc_id", F.col("known").alias("digest"), "license", F.coalesce("notices", F.lit("")).alias("notices"),
        F.coalesce("many", F.lit(0)).cast("long").alias("n_notices"),
    )


def op1_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All of `documents`, as whole texts and line by line."""
    return scan(documents(spark, sf_dir))


def _canonical_sql(text: str) -> str:
    out = f"regexp_replace(translate({text}, '{UPPER}', '{LOWER}'), '{COPYRIGHT}', chr(10), 'g')"
    out = f"' ' || trim(regexp_replace({out}, '{PUNCTUATION}', '  ', 'g')) || ' '"
    for old, new in SPELLINGS:
        out = f"replace({out}, '{_apart(old)}', '{_apart(new)}')"
    return f"sha256(trim(regexp_replace({out}, ' +', ' ', 'g')))"


def _quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


OP1_SQL = f"""
WITH k AS (
  SELECT {_canonical_sql("body")} AS known, min(license) AS license
  FROM (VALUES {", ".join(f"({_quoted(name)}, {_quoted(body)})" for name, body in KNOWN)}) AS t(license, body)
  GROUP BY 1),
l AS (
  SELECT doc_id, {_canonical_sql("line")} AS known
  FROM (SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line FROM documents)),
n AS (
  SELECT doc_id, string_agg(license, ',' ORDER BY license) AS notices, sum(many) AS many
  FROM (SELECT doc_id, license, count(*) AS many FROM l JOIN k USING (known) GROUP BY 1, 2) GROUP BY 1),
w AS (SELECT doc_id, {_canonical_sql("coalesce(text, '')")} AS known FROM documents)
SELECT w.doc_id, w.known AS digest, k.license, coalesce(n.notices, '') AS notices,
       CAST(coalesce(n.many, 0) AS BIGINT) AS n_notices
FROM w LEFT JOIN k ON w.known = k.known LEFT JOIN n ON w.doc_id = n.doc_id"""
