"""Licence scans: texts brought to a canonical form and looked up among known digests.

The canonical form has lower case, no copyright notices, one spelling for equivalent words, and single
blanks for everything that is no letter or digit. Whole texts are joined by the SHA-256 of that
form to the digests of known licences; so is each line, for notices inside a document. All of it is
built-in functions and joins.
"""

from __future__ import annotations

from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Spellings that count as equal, after case and marks are gone.
EQUIVALENT = [
    ("licence", "license"), ("acknowledgement", "acknowledgment"), ("analogue", "analog"), ("artefact", "artifact"), ("authorisation", "authorization"),
    ("authorised", "authorized"), ("calibre", "caliber"), ("cancelled", "canceled"), ("centre", "center"), ("favour", "favor"), ("fulfil ", "fulfill "),
    ("merchantibility", "merchantability"), ("noncommercial", "non commercial"), ("organisation", "organization"), ("per cent", "percent"),
    ("sublicense", "sub license"), ("utilisation", "utilization"), ("whilst", "while"), ("wilful", "willful"), ("https", "http"),
]

_MIT_GRANT = (
    "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the"
    ' "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish,'
    " distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to"
    " the following conditions:\n\nThe above copyright notice and this permission notice shall be included in all copies or substantial portions"
    ' of the Software.\n\nTHE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE'
    " WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE"
    " LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN"
    " CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."
)
_ISC_REST = (
    'THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF'
    " MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY"
    " DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION,"
    " ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE."
)
_BSD_TERMS = (
    "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are"
    " met:\n\n1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.\n\n"
    "2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the"
    " documentation and/or other materials provided with the distribution.\n\n"
)
_BSD_NAMES = (
    "3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this"
    " software without specific prior written permission.\n\n"
)
_BSD_REST = (
    'THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT'
    " LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT"
    " HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT"
    " LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY"
    " THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF"
    " THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."
)
_USE_GRANT = "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted"

# Known texts and notices. A licence may have several.
KNOWN = [
    ("MIT", _MIT_GRANT),
    ("MIT", "MIT License\n\n" + _MIT_GRANT),
    ("MIT", "The MIT License (MIT)\n\n" + _MIT_GRANT),
    ("MIT", "Released under the MIT License."),
    ("MIT", "Licensed under the MIT License."),
    ("ISC", _USE_GRANT + ", provided that the above copyright notice and this permission notice appear in all copies.\n\n" + _ISC_REST),
    ("ISC", "ISC License\n\n" + _USE_GRANT + ", provided that the above copyright notice and this permission notice appear in all copies.\n\n" + _ISC_REST),
    ("0BSD", _USE_GRANT + ".\n\n" + _ISC_REST),
    ("BSD-2-Clause", _BSD_TERMS + _BSD_REST),
    ("BSD-2-Clause", "BSD 2-Clause License\n\n" + _BSD_TERMS + _BSD_REST),
    ("BSD-3-Clause", _BSD_TERMS + _BSD_NAMES + _BSD_REST),
    ("BSD-3-Clause", "BSD 3-Clause License\n\n" + _BSD_TERMS + _BSD_NAMES + _BSD_REST),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("LGPL-3.0", "This work is licensed under the GNU Lesser General Public License, version 3."),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC0-1.0", "Licensed under CC0 1.0."),
    ("Unlicense", "This is free and unencumbered software released into the public domain."),
    ("LicenseRef-reserved", "All rights reserved."),
]


# What a license puts after "copyright" in running text, which names no holder.
_TERMS = (
    "holders?|owners?|notices?|licen[cs]es?|licensors?|laws?|and|or|interests?|rights?|disclaimers?|statements?|permissions?|protection|treaty|"
    "treaties|status|ownership|claims?|infringement|in|on|of|to|for|is|are|as|if|that|which|the|this|these|such|with|under|applies|also|liability"
)
_MARKS = r"[^\p{L}\p{N}\n]*"
# With a sign, a year or the place for one; "(c)" alone may number a clause and needs the year.
_SIGNED = rf"{_MARKS}(?:copyright\b{_MARKS}(?:©|\(c\)|\d{{4}}|yyyy\b|year\b)|©|\(c\)[ \t]*(?:copyright\b|\d{{4}}))[^\n]*"
_NAMED = rf"{_MARKS}copyright\b[ \t:]+(?:by[ \t]+)?(?!(?:{_TERMS})\b)\p{{L}}[^\n]*"
# A name alone counts at the start of a paragraph or after another notice: elsewhere the line may be wrapped text.
# The anchor stands before the look-behind, which is dear and so is tried at the start of lines only.
NOTICE = rf"(?m)(?:^{_SIGNED}$|^(?<=\A|\n[ \t\r]{{0,80}}\n){_NAMED}$)(?:\n(?:{_SIGNED}|{_NAMED})$)*(?:\n{_MARKS}all rights reserved{_MARKS}$)?"

_APACHE_HEADER = (
    'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License. You may'
    " obtain a copy of the License at\n\n    http://www.apache.org/licenses/LICENSE-2.0\n\nUnless required by applicable law or agreed to in"
    ' writing, software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either'
    " express or implied. See the License for the specific language governing permissions and limitations under the License."
)
_MPL_HEADER = (
    "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this"
    " file, You can obtain one at https://mozilla.org/MPL/2.0/."
)


def _gnu_header(kind: str) -> str:
    return (
        f"This program is free software: you can redistribute it and/or modify it under the terms of the GNU {kind} as published by the Free"
        " Software Foundation, either version 3 of the License, or (at your option) any later version.\n\nThis program is distributed in the hope"
        " that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR"
        f" PURPOSE. See the GNU {kind} for more details.\n\nYou should have received a copy of the GNU {kind} along with this program. If not, see"
        " <https://www.gnu.org/licenses/>."
    )


def whole_texts() -> list[tuple[str, str]]:
    """Licences that are kept as files, with and without what follows their terms, and the usual file headers."""
    out = [
        ("Apache-2.0", _APACHE_HEADER), ("MPL-2.0", _MPL_HEADER), ("GPL-3.0", _gnu_header("General Public License")),
        ("LGPL-3.0", _gnu_header("Lesser General Public License")),
    ]
    for file in sorted((Path(__file__).parent / "licence_texts").glob("*.txt")):
        text = file.read_text(encoding="utf-8")
        terms, end, _ = text.partition("END OF TERMS AND CONDITIONS")
        out += [(file.stem, text), (file.stem, terms), (file.stem, terms + end)]
    return out


def canonical(text: Column, notices: bool = True) -> Column:
    """The form in which texts are compared; null stays null. Without ``notices`` copyright notices are not looked for."""
    out = F.lower(text)
    if notices:
        out = F.regexp_replace(out, NOTICE, "")
    out = F.concat(F.regexp_replace(out, "[^\\p{L}\\p{N}]+", " "), F.lit(" "))
    for one, other in EQUIVALENT:
        out = F.replace(out, F.lit(one), F.lit(other))
    return F.trim(out)


def known_digests(spark: SparkSession, texts: list[tuple[str, str]] | None = None) -> DataFrame:
    """``digest, license_id`` of known texts, each digest once."""
    rows = spark.createDataFrame(KNOWN + whole_texts() if texts is None else texts, "license_id string, text string")
    rows = rows.select(F.sha2(canonical(F.col("text")), 256).alias("digest"), "license_id")
    return rows.groupBy("digest").agg(F.min("license_id").alias("license_id"))


def scan(docs: DataFrame, known: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id, digest, license_id, notices`` for each row of ``docs``.

    ``license_id`` is the licence whose canonical text the whole text has, else null; ``notices``
    names, in order and once each, the licences that single lines have, joined by commas, else
    null. ``known`` is a table ``digest, license_id`` of any size.

    Null and empty texts, and texts without letters or digits, have a null digest and match nothing.
    Rows that repeat an id share the notices of all its texts; a row with a null id has none. Other
    columns are not looked at.
    """
    digest = lambda c, notices=True: F.sha2(F.nullif(canonical(c, notices), F.lit("")), 256)
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    whole = rows.select("id", digest(F.col("text")).alias("digest")).join(known, "digest", "left")
    lines = rows.filter("id is not null").select("id", F.explode(F.split("text", "\n")).alias("line"))
    # A line that is a copyright notice is none of the known ones, with it or without.
    found = lines.select("id", digest(F.col("line"), False).alias("digest")).join(known, "digest").select("id", "license_id").distinct()
    notices = found.groupBy("id").agg(F.array_join(F.sort_array(F.collect_set("license_id")), ",").alias("notices"))
    return whole.join(notices, "id", "left").select(F.col("id").alias(id_col), "digest", "license_id", "notices")
