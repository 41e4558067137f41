"""Licence scans: canonical digests of whole texts, joined to known licence digests.

A text is made canonical by ASCII lower case, dropping copyright lines, folding
everything that is not a letter or digit to single blanks, and one spelling for
words that count as equivalent.  The SHA-256 of the result is looked up among the
digests of the known licences.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
COPYRIGHT_LINE = r"(^|\n)[ \t]*(copyright[ \t]*(\(c\)|©|[0-9]|[,:<\[{][ \t]*|the[ \t]+[a-z0-9]+[ \t]+(authors|project|developers|contributors|team|foundation)|by[ \t])|\(c\)[ \t]|©|all rights reserved)[^\n]*"
FOLDED = r"[\x00-\x2f\x3a-\x60\x7b-\x7f\x{a0}“”‘’–—…•©]+"
# Spellings that the public licence matching guidelines count as equal.
EQUIVALENT = (
    ("acknowledgment", "acknowledgement"), ("analogue", "analog"), ("analyse", "analyze"), ("artefact", "artifact"),
    ("authorisation", "authorization"), ("authorised", "authorized"), ("calibre", "caliber"), ("cancelled", "canceled"),
    ("capitalisations", "capitalizations"), ("catalogue", "catalog"), ("categorise", "categorize"), ("centre", "center"),
    ("emphasised", "emphasized"), ("favour", "favor"), ("favourite", "favorite"), ("fulfil", "fulfill"),
    ("fulfilment", "fulfillment"), ("initialise", "initialize"), ("judgment", "judgement"), ("labelling", "labeling"),
    ("labour", "labor"), ("licence", "license"), ("maximise", "maximize"), ("modelled", "modeled"),
    ("modelling", "modeling"), ("offence", "offense"), ("optimise", "optimize"), ("organisation", "organization"),
    ("organise", "organize"), ("practise", "practice"), ("programme", "program"), ("realise", "realize"),
    ("recognise", "recognize"), ("signalling", "signaling"), ("sublicence", "sublicense"), ("utilisation", "utilization"),
    ("whilst", "while"), ("wilful", "willful"), ("http", "https"), ("noncommercial", "non commercial"),
)

MIT = """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated
documentation files (the "Software"), to deal in the Software without restriction, including without limitation the
rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit
persons to whom the Software is furnished to do so, subject to the following conditions:

The above copyright notice and this permission notice shall be included in all copies or substantial portions of the
Software.

THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE
WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR
COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR
OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."""

ISC_GRANT = """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby
granted"""
ISC_DISCLAIMER = """THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL
IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT,
INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN
ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF
THIS SOFTWARE."""

BSD_HEAD = """Redistribution and use in source and binary forms, with or without modification, are permitted provided that the
following conditions are met:

1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following
disclaimer.

2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following
disclaimer in the documentation and/or other materials provided with the distribution."""
BSD_THIRD = """3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote
products derived from this software without specific prior written permission."""
BSD_TAIL = """THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES,
INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE
DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL,
SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR
SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY,
WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF
THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."""

ZLIB = """This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held
liable for any damages arising from the use of this software.

Permission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it
and redistribute it freely, subject to the following restrictions:

1. The origin of this software must not be misrepresented; you must not claim that you wrote the original software. If
you use this software in a product, an acknowledgment in the product documentation would be appreciated but is not
required.

2. Altered source versions must be plainly marked as such, and must not be misrepresented as being the original
software.

3. This notice may not be removed or altered from any source distribution."""

APACHE_NOTICE = """Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with
the License. You may obtain a copy of the License at

http://www.apache.org/licenses/LICENSE-2.0

Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an
"AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific
language governing permissions and limitations under the License."""

UNLICENSE = """This is free and unencumbered software released into the public domain.

Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in source code form or
as a compiled binary, for any purpose, commercial or non-commercial, and by any means.

In jurisdictions that recognize copyright laws, the author or authors of this software dedicate any and all copyright
interest in the software to the public domain. We make this dedication for the benefit of the public at large and to the
detriment of our heirs and successors. We intend this dedication to be an overt act of relinquishment in perpetuity of
all present and future rights to this software under copyright law.

THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE
WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS BE
LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT
OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."""

BOOST = """Boost Software License - Version 1.0 - August 17th, 2003

Permission is hereby granted, free of charge, to any person or organization obtaining a copy of the software and
accompanying documentation covered by this license (the "Software") to use, reproduce, display, distribute, execute, and
transmit the Software, and to prepare derivative works of the Software, and to permit third-parties to whom the Software
is furnished to do so, all subject to the following:

The copyright notices in the Software and this entire statement, including the above license grant, this restriction and
the following disclaimer, must be included in all copies of the Software, in whole or in part, and all derivative works
of the Software, unless such copies or derivative works are solely in the form of machine-executable object code
generated by a source language processor.

THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE
WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE, TITLE AND NON-INFRINGEMENT. IN NO EVENT SHALL THE
COPYRIGHT HOLDERS OR ANYONE DISTRIBUTING THE SOFTWARE BE LIABLE FOR ANY DAMAGES OR OTHER LIABILITY, WHETHER IN CONTRACT,
TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE
SOFTWARE."""

WTFPL = """DO WHAT THE FUCK YOU WANT TO PUBLIC LICENSE
TERMS AND CONDITIONS FOR COPYING, DISTRIBUTION AND MODIFICATION

0. You just DO WHAT THE FUCK YOU WANT TO."""

POSTGRESQL_GRANT = """Permission to use, copy, modify, and distribute this software and its documentation for any purpose, without fee, and
without a written agreement is hereby granted, provided that the above copyright notice and this paragraph and the
following two paragraphs appear in all copies."""

ALL_PERMISSIVE = """Copying and distribution of this file, with or without modification, are permitted in any medium without royalty
provided the copyright notice and this notice are preserved. This file is offered as-is, without any warranty."""

GPL_NOTICE = """This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public
License as published by the Free Software Foundation, either version {} of the License, or (at your option) any later
version.

This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied
warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public License for more details.

You should have received a copy of the GNU General Public License along with this program. If not, see
<https://www.gnu.org/licenses/>."""

MPL_NOTICE = """This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not
distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/."""

#: Known licences: short ones whole, long ones by the notice that stands for them; a caller may give another table.
KNOWN = {
    "MIT": MIT,
    "MIT-titled": "MIT License\n\n" + MIT,
    "ISC": ISC_GRANT + ", provided that the above copyright notice and this permission notice appear in all copies.\n\n" + ISC_DISCLAIMER,
    "0BSD": ISC_GRANT + ".\n\n" + ISC_DISCLAIMER,
    "BSD-2-Clause": BSD_HEAD + "\n\n" + BSD_TAIL,
    "BSD-3-Clause": BSD_HEAD + "\n\n" + BSD_THIRD + "\n\n" + BSD_TAIL,
    "Zlib": ZLIB,
    "Apache-2.0-notice": APACHE_NOTICE,
    "BSD-1-Clause": BSD_HEAD.split("\n\n2.")[0] + "\n\n" + BSD_TAIL,
    "MIT-0": MIT.split(", subject to")[0] + ".\n\n" + MIT.split("\n\n")[2],
    "Unlicense": UNLICENSE,
    "BSL-1.0": BOOST,
    "WTFPL": WTFPL,
    "PostgreSQL-grant": POSTGRESQL_GRANT,
    "FSFAP": ALL_PERMISSIVE,
    "GPL-2.0-or-later-notice": GPL_NOTICE.format(2),
    "GPL-3.0-or-later-notice": GPL_NOTICE.format(3),
    "AGPL-3.0-or-later-notice": GPL_NOTICE.format(3).replace("GNU General", "GNU Affero General"),
    "LGPL-3.0-or-later-notice": GPL_NOTICE.format(3).replace("GNU General", "GNU Lesser General"),
    "MPL-2.0-notice": MPL_NOTICE,
}


def canonical(text: Column) -> Column:
    """Canonical form of a text (null: empty): words parted by one blank, each in its chosen spelling."""
    out = F.translate(F.coalesce(text, F.lit("")), UPPER, LOWER)
    out = F.regexp_replace(out, COPYRIGHT_LINE, "$1")
    out = F.trim(F.regexp_replace(out, FOLDED, " "))
    chosen = F.create_map(*(F.lit(x) for pair in EQUIVALENT for x in pair))
    words = F.transform(F.split(out, " ", -1), lambda w: F.coalesce(F.try_element_at(chosen, w), w))
    return F.when(F.rlike(out, F.lit(r"\b(?:" + "|".join(old for old, _ in EQUIVALENT) + r")\b")), F.array_join(words, " ")).otherwise(out)


def known_licences(spark: SparkSession) -> DataFrame:
    """The built-in licences as (license_id, text)."""
    return spark.createDataFrame(sorted(KNOWN.items()), "license_id string, text string")


def scan_licences(docs: DataFrame, known: DataFrame | None = None) -> DataFrame:
    """Name the licence that a whole text is, if it is one.

    Returns doc_id, n_canonical (code points of the canonical text), digest and
    license_id (null: none of the known ones).  Of known licences with equal
    canonical texts the smallest id is named.  Null and empty texts have the digest
    of the empty text and no licence, unless a known text is empty.  Repeated rows
    each give a row, a null id stays null, other columns are ignored, an empty
    table gives no rows.  The known digests are folded to one row each; the built-in
    table is broadcast (it has a fixed size), a caller's is joined as Spark sees fit.
    """
    table = known if known is not None else known_licences(docs.sparkSession)
    digests = table.select(F.sha2(canonical(F.col("text")).cast("binary"), 256).alias("digest"), "license_id").groupBy("digest").agg(F.min("license_id").alias("license_id"))
    read = docs.select("doc_id", canonical(F.col("text")).alias("canonical"))
    marked = read.select("doc_id", F.length("canonical").cast("long").alias("n_canonical"), F.sha2(F.col("canonical").cast("binary"), 256).alias("digest"))
    return marked.join(F.broadcast(digests) if known is None else digests, "digest", "left").select("doc_id", "n_canonical", "digest", "license_id")


def oracle() -> str:
    """The scan as DuckDB SQL over ``documents``, with the built-in licences; words are looked up one by one."""
    quoted = lambda x: "'" + x.replace("'", "''") + "'"
    form = f"translate(coalesce(text, ''), '{UPPER}', '{LOWER}')"
    form = f"regexp_replace({form}, {quoted(COPYRIGHT_LINE)}, '\\1', 'g')"
    form = f"trim(regexp_replace({form}, {quoted(FOLDED)}, ' ', 'g'), ' ')"
    cases = " ".join(f"WHEN '{old}' THEN '{new}'" for old, new in EQUIVALENT)
    form = f"array_to_string(list_transform(string_split({form}, ' '), lambda w: CASE w {cases} ELSE w END), ' ')"
    rows = ", ".join(f"({quoted(k)}, {quoted(v)})" for k, v in sorted(KNOWN.items()))
    return f"""
WITH known AS (
  SELECT sha256({form}) AS digest, min(license_id) AS license_id
  FROM (VALUES {rows}) AS k(license_id, text) GROUP BY 1
), read AS (SELECT doc_id, {form} AS canonical FROM documents)
SELECT doc_id, CAST(length(canonical) AS BIGINT) AS n_canonical, sha256(canonical) AS digest, license_id
FROM read LEFT JOIN known ON sha256(read.canonical) = known.digest
"""
