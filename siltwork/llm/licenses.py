"""Find texts that are known licences by the digest of their canonical form.

A text is lower-cased, loses its copyright lines, takes one spelling of words
that licences spell in two ways, and keeps only words with single blanks
between. The SHA-256 of that is joined with the digests of known licences. Whole
texts are looked up so, and so is each single line among the known one-line
notices.

Null texts count as empty; they and texts without words are no licence. Repeated
rows are looked up one by one. Of the input only id and text are used, so other
columns cannot clash. An empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from siltwork.llm.text import whole

# Public texts of licences and their usual notices.
_AS_IS = (
    'THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, '
    "INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR "
    "PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE "
    "FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR "
    "OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER "
    "DEALINGS IN THE SOFTWARE."
)
_GRANT = (
    "Permission is hereby granted, free of charge, to any person obtaining a copy of this "
    'software and associated documentation files (the "Software"), to deal in the Software '
    "without restriction, including without limitation the rights to use, copy, modify, merge, "
    "publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons "
    "to whom the Software is furnished to do so, subject to the following conditions: "
    "The above copyright notice and this permission notice shall be included in all copies or "
    "substantial portions of the Software. "
)
_ISC_END = (
    'THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO '
    "THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT "
    "SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR "
    "ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF "
    "CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE "
    "OR PERFORMANCE OF THIS SOFTWARE."
)
_BSD_START = (
    "Redistribution and use in source and binary forms, with or without modification, are "
    "permitted provided that the following conditions are met: "
    "1. Redistributions of source code must retain the above copyright notice, this list of "
    "conditions and the following disclaimer. "
    "2. Redistributions in binary form must reproduce the above copyright notice, this list of "
    "conditions and the following disclaimer in the documentation and/or other materials "
    "provided with the distribution. "
)
_BSD_THIRD = (
    "3. Neither the name of the copyright holder nor the names of its contributors may be used "
    "to endorse or promote products derived from this software without specific prior written "
    "permission. "
)
_BSD_END = (
    'THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS '
    "OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF "
    "MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE "
    "COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, "
    "EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF "
    "SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) "
    "HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR "
    "TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS "
    "SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."
)
_APACHE_NOTICE = (
    'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file '
    "except in compliance with the License. You may obtain a copy of the License at "
    "http://www.apache.org/licenses/LICENSE-2.0 "
    "Unless required by applicable law or agreed to in writing, software distributed under the "
    'License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, '
    "either express or implied. See the License for the specific language governing permissions "
    "and limitations under the License."
)
_GPL3_NOTICE = (
    "This program is free software: you can redistribute it and/or modify it under the terms of "
    "the GNU General Public License as published by the Free Software Foundation, either version "
    "3 of the License, or (at your option) any later version. "
    "This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; "
    "without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. "
    "See the GNU General Public License for more details. "
    "You should have received a copy of the GNU General Public License along with this program. "
    "If not, see <https://www.gnu.org/licenses/>."
)
_WTFPL = (
    "DO WHAT THE FUCK YOU WANT TO PUBLIC LICENSE TERMS AND CONDITIONS FOR COPYING, DISTRIBUTION "
    "AND MODIFICATION 0. You just DO WHAT THE FUCK YOU WANT TO."
)
LICENSES: tuple[tuple[str, str], ...] = (
    ("MIT", "MIT License " + _GRANT + _AS_IS),
    ("MIT", "The MIT License (MIT) " + _GRANT + _AS_IS),
    ("MIT", _GRANT + _AS_IS),
    (
        "ISC",
        "Permission to use, copy, modify, and/or distribute this software for any purpose with "
        "or without fee is hereby granted, provided that the above copyright notice and this "
        "permission notice appear in all copies. " + _ISC_END,
    ),
    (
        "0BSD",
        "Permission to use, copy, modify, and/or distribute this software for any purpose with "
        "or without fee is hereby granted. " + _ISC_END,
    ),
    ("BSD-2-Clause", _BSD_START + _BSD_END),
    ("BSD-2-Clause", "BSD 2-Clause License " + _BSD_START + _BSD_END),
    ("BSD-3-Clause", _BSD_START + _BSD_THIRD + _BSD_END),
    ("BSD-3-Clause", "BSD 3-Clause License " + _BSD_START + _BSD_THIRD + _BSD_END),
    ("Apache-2.0", _APACHE_NOTICE),
    ("GPL-3.0-or-later", _GPL3_NOTICE),
    ("WTFPL", _WTFPL),
    ("MIT", "Released under the MIT License."),
    ("MIT", "Licensed under the MIT License."),
    ("MIT", "SPDX-License-Identifier: MIT"),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "SPDX-License-Identifier: Apache-2.0"),
    ("GPL-3.0-only", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0-only", "SPDX-License-Identifier: GPL-3.0-only"),
    ("GPL-3.0-or-later", "SPDX-License-Identifier: GPL-3.0-or-later"),
    ("BSD-2-Clause", "SPDX-License-Identifier: BSD-2-Clause"),
    ("BSD-3-Clause", "SPDX-License-Identifier: BSD-3-Clause"),
    ("ISC", "SPDX-License-Identifier: ISC"),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC0-1.0", "SPDX-License-Identifier: CC0-1.0"),
)

# Canonical digests of whole public licence texts as their publishers
# spread them, with preamble and appendix.
DIGESTS: tuple[tuple[str, str], ...] = (
    ("Apache-2.0", "e87dea5078ce2faaea46d3475af18d30a5c0ac0f09425b60b3e0c6569f72f8d2"),
    ("Artistic-1.0-Perl", "08f1dc258c8f9e175155356aa1dd0dead8cfdec586bc1bb4c8b1452699a91702"),
    ("BSD-3-Clause", "21ce5e311a0ef74591e636cf6d0a236029bcaa0ee86324ac68d5748657aa8651"),
    ("CC0-1.0", "96bdc7f63190fb4bd1ae584b890300ed7517d858b34c945642a3b9b2f1612a5f"),
    ("GFDL-1.2", "5379e6f33e826ba185b23fd11a414555c2161fda481478babd1e73a3ae098a71"),
    ("GFDL-1.3", "93d6108daecdddc5f284cf8f2512fb0d72f6e9ee12381feb9704ba194b00c3e6"),
    ("GPL-1.0", "8f586b09c093668e2db772bdcfc1d5dc0b03e0e862fccbff035e1bf134e9b224"),
    ("GPL-2.0", "efe73660e5476cf0368fc0fc143f624ff9d1b73c4484b14a9969dd20c5786821"),
    ("GPL-3.0", "a8cd54d6683aa630f0b8d05d56184ad91dc486756da2df61c94d3e4e8d5ecb68"),
    ("LGPL-2.0", "61af4dcea4e412e8ccfb8877fd2762bd6d962f8d42a9fa2c06cf7b4613f2c908"),
    ("LGPL-2.1", "4d55922bdeafabde164d75448bbfb0b474bf952bbb541325364010900acd9891"),
    ("LGPL-3.0", "aae2b222477171fb64e298e7965e768a9a6f85320646b266c94399ac029d42be"),
    ("MPL-1.1", "3f0343dd4f3b064be36e0c6584737c9b7bb5c322721694563f9009e088ce96d1"),
    ("MPL-2.0", "f82071285728ca3ec7685ee9bc4acdae0b8267142a4d20b8f1805eabedb4a98a"),
)

# Spellings that count as equal, each with the one that is kept.
SPELLINGS: tuple[tuple[str, str], ...] = (
    ("acknowledgement", "acknowledgment"),
    ("analogue", "analog"),
    ("analyse", "analyze"),
    ("artefact", "artifact"),
    ("authorisation", "authorization"),
    ("authorised", "authorized"),
    ("calibre", "caliber"),
    ("cancelled", "canceled"),
    ("capitalisations", "capitalizations"),
    ("catalogue", "catalog"),
    ("categorise", "categorize"),
    ("centre", "center"),
    ("emphasised", "emphasized"),
    ("favour", "favor"),
    ("favourite", "favorite"),
    ("fulfil", "fulfill"),
    ("fulfilment", "fulfillment"),
    ("initialise", "initialize"),
    ("judgement", "judgment"),
    ("labelling", "labeling"),
    ("labour", "labor"),
    ("licence", "license"),
    ("licences", "licenses"),
    ("licenced", "licensed"),
    ("maximise", "maximize"),
    ("modelled", "modeled"),
    ("modelling", "modeling"),
    ("offence", "offense"),
    ("optimise", "optimize"),
    ("organisation", "organization"),
    ("organise", "organize"),
    ("practise", "practice"),
    ("programme", "program"),
    ("realise", "realize"),
    ("recognise", "recognize"),
    ("signalling", "signaling"),
    ("sublicence", "sublicense"),
    ("utilisation", "utilization"),
    ("whilst", "while"),
    ("wilful", "willful"),
)
#: A line that only names the holder of the copyright, or reserves all rights.
COPYRIGHT_LINE = (
    r"(?m)^[ \t]*(?:(?:copyright|©|\(c\))[ \t]*(?:\(c\)|©|[0-9<\[{]|by )[^\n]*"
    r"|all rights reserved\.?[ \t]*)$"
)
NOT_A_WORD = r"[^\p{L}\p{N}\n]+"
VARIANT = r"\b(?:" + "|".join(old for old, _ in SPELLINGS) + r")\b"


def canonical(text: str | Column) -> Column:
    """Canonical form; line feeds stay, so that lines can be told apart."""
    lower = F.lower(whole(text))
    claims = lower.rlike(r"(?m)^[ \t]*(?:copyright|©|\(c\)|all rights reserved)")
    kept = F.when(claims, F.regexp_replace(lower, COPYRIGHT_LINE, "")).otherwise(lower)
    plain = F.regexp_replace(kept, NOT_A_WORD, " ")
    # Few texts hold such a word; the others need one look, not forty.
    spelled = plain
    for old, new in SPELLINGS:
        spelled = F.regexp_replace(spelled, rf"\b{old}\b", new)
    return F.when(plain.rlike(VARIANT), spelled).otherwise(plain)


def one_line(plain: Column) -> Column:
    return F.trim(F.regexp_replace(plain, r"[ \n]+", " "))


def digest(line: Column) -> Column:
    return F.sha2(line, 256)


def known(spark: SparkSession) -> DataFrame:
    """Digests of ``LICENSES`` and ``DIGESTS`` with their licence, a row for each."""
    listed = F.array(
        *[F.struct(F.lit(name).alias("license"), F.lit(text).alias("text")) for name, text in LICENSES]
    )
    rows = spark.range(1).select(F.inline(listed))
    rows = rows.select("license", digest(one_line(canonical("text"))).alias("digest"))
    whole_texts = F.array(
        *[F.struct(F.lit(name).alias("license"), F.lit(d).alias("digest")) for name, d in DIGESTS]
    )
    return rows.unionByName(spark.range(1).select(F.inline(whole_texts))).distinct()


def scanned(docs: DataFrame, text: str = "text") -> DataFrame:
    """Per row: id, digest, the licence that the whole text is, and lines' notices.

    ``license`` is NULL if the whole text is no known licence. ``notices`` are
    the licences named by lines that are known notices, sorted, comma-joined.
    """
    table = known(docs.sparkSession)
    # As many entries as are listed above, so they are constants of the plan.
    entries = [(F.lit(row["digest"]), F.lit(row["license"])) for row in table.collect()]
    notices = F.create_map(*[column for entry in entries for column in entry])
    digests = F.array(*[key for key, _ in entries])
    rows = docs.select("doc_id", canonical(text).alias("__plain"))
    rows = rows.select("doc_id", "__plain", digest(one_line(F.col("__plain"))).alias("digest"))
    rows = rows.join(F.broadcast(table), "digest", "left")
    lines = F.transform(F.split("__plain", "\n"), lambda line: digest(F.trim(line)))
    hits = F.array_intersect(lines, digests)
    names = F.array_sort(F.array_distinct(F.transform(hits, lambda d: notices[d])))
    return rows.select(
        "doc_id",
        F.col("digest").alias("canonical_sha256"),
        "license",
        F.array_join(names, ",").alias("notices"),
    )
