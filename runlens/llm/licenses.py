"""Licences by the digest of their normalised text.

A text is reduced to a canonical form: A-Z lower-cased, copyright lines dropped, punctuation turned into blanks, blanks
collapsed, equivalent spellings made one. Its SHA-256 is looked up, by a join, among the digests of known licences.
Two units of a document are looked up: the whole text (a licence file), and each line (a notice inside
other text). The known texts are a parameter; the table given here is small and its size does not depend on any input, so it is broadcast.

Nulls and repeats: a null text is empty and matches nothing; rows that repeat give equal rows; rows that share an id but not a text each get
their own answer. Only the id and the text column are read.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from runlens.llm.common import ascii_lower, id_text
from runlens.session import written

# fixed values: spellings that licence matching treats as equal
SPELLINGS = (
    ("licence", "license"), ("licenced", "licensed"), ("sub license", "sublicense"), ("non infringement", "noninfringement"),
    ("acknowledgement", "acknowledgment"), ("analogue", "analog"), ("analyse", "analyze"), ("artefact", "artifact"),
    ("authorisation", "authorization"), ("authorised", "authorized"), ("calibre", "caliber"), ("cancelled", "canceled"),
    ("catalogue", "catalog"), ("centre", "center"), ("copyright owner", "copyright holder"), ("emphasised", "emphasized"),
    ("favour", "favor"), ("fulfil", "fulfill"), ("initialise", "initialize"), ("judgement", "judgment"),
    ("labour", "labor"), ("organisation", "organization"), ("organise", "organize"),
    ("practise", "practice"), ("programme", "program"), ("realise", "realize"), ("recognise", "recognize"),
    ("signalling", "signaling"), ("utilisation", "utilization"), ("whilst", "while"), ("wilful", "willful"),
)

_AS_IS = """THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO
THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE
AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT,
TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE
SOFTWARE."""
_ISC_GRANT = """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby
granted"""
_ISC_AS_IS = """THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING
ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT,
INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN
ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF
THIS SOFTWARE."""
_BSD_HEAD = """Redistribution and use in source and binary forms, with or without modification, are permitted provided that the
following conditions are met:
1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following
disclaimer.
2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following
disclaimer in the documentation and/or other materials provided with the distribution."""
_BSD_NAMES = """3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote
products derived from this software without specific prior written permission."""
_BSD_AS_IS = """THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES,
INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE
DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL,
SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES;
LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN
CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS
SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."""
_MIT = """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated
documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights
to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to
whom the Software is furnished to do so, subject to the following conditions:
The above copyright notice and this permission notice shall be included in all copies or substantial portions of the
Software.
""" + _AS_IS

# fixed values: whole licences and the one-line notices that stand for them, as (identifier, text)
KNOWN: tuple[tuple[str, str], ...] = (
    ("MIT", _MIT), ("MIT", "MIT License\n" + _MIT), ("MIT", "The MIT License (MIT)\n" + _MIT),
    ("ISC", f"{_ISC_GRANT}, provided that the above copyright notice and this permission notice appear in all copies.\n{_ISC_AS_IS}"),
    ("0BSD", f"{_ISC_GRANT}.\n{_ISC_AS_IS}"),
    ("BSD-2-Clause", f"{_BSD_HEAD}\n{_BSD_AS_IS}"), ("BSD-3-Clause", f"{_BSD_HEAD}\n{_BSD_NAMES}\n{_BSD_AS_IS}"),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "SPDX-License-Identifier: Apache-2.0"),
    ("MIT", "Released under the MIT License."), ("MIT", "Licensed under the MIT License."), ("MIT", "SPDX-License-Identifier: MIT"),
    ("GPL-3.0-only", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0-only", "SPDX-License-Identifier: GPL-3.0-only"),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."), ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC0-1.0", "Released under CC0 1.0."),
)

_BSL = """Permission is hereby granted, free of charge, to any person or organization obtaining a copy of the software and
accompanying documentation covered by this license (the "Software") to use, reproduce, display, distribute, execute, and transmit
the Software, and to prepare derivative works of the Software, and to permit third-parties to whom the Software is furnished to do
so, all subject to the following:
The copyright notices in the Software and this entire statement, including the above license grant, this restriction and the
following disclaimer, must be included in all copies of the Software, in whole or in part, and all derivative works of the
Software, unless such copies or derivative works are solely in the form of machine-executable object code generated by a source
language processor.
THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF
MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE, TITLE AND NON-INFRINGEMENT. IN NO EVENT SHALL THE COPYRIGHT HOLDERS OR ANYONE
DISTRIBUTING THE SOFTWARE BE LIABLE FOR ANY DAMAGES OR OTHER LIABILITY, WHETHER IN CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT
OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."""
_TITLES = {"MIT": ("The MIT License",), "ISC": ("ISC License", "The ISC License", "ISC License (ISC)"),
           "0BSD": ("BSD Zero Clause License", "Zero-Clause BSD"),
           "BSD-2-Clause": ("BSD 2-Clause License", "The 2-Clause BSD License", 'BSD 2-Clause "Simplified" License'),
           "BSD-3-Clause": ("BSD 3-Clause License", "The 3-Clause BSD License", 'BSD 3-Clause "New" or "Revised" License')}

# fixed values: more whole texts, which the SQL of the registered query does not list: titled variants and BSL-1.0
MORE: tuple[tuple[str, str], ...] = (
    *((name, f"{title}\n{text}") for name, text in (KNOWN[0], *KNOWN[3:7]) for title in _TITLES[name]),
    ("BSL-1.0", _BSL), ("BSL-1.0", "Boost Software License - Version 1.0 - August 17th, 2003\n" + _BSL),
)
# fixed values: digests of the canonical forms of long licences, as /usr/share/common-licenses has them, Apache-2.0 also without its appendix
LONG: tuple[tuple[str, str], ...] = (
    ("Apache-2.0", "04e64e0427d80fdde16fa8415931bf2c09bc943f13ec322a09df188bf23a3543"),
    ("GPL-1.0-only", "8f586b09c093668e2db772bdcfc1d5dc0b03e0e862fccbff035e1bf134e9b224"),
    ("GPL-2.0-only", "efe73660e5476cf0368fc0fc143f624ff9d1b73c4484b14a9969dd20c5786821"),
    ("GPL-3.0-only", "a8cd54d6683aa630f0b8d05d56184ad91dc486756da2df61c94d3e4e8d5ecb68"),
    ("LGPL-2.0-only", "61af4dcea4e412e8ccfb8877fd2762bd6d962f8d42a9fa2c06cf7b4613f2c908"),
    ("LGPL-2.1-only", "4d55922bdeafabde164d75448bbfb0b474bf952bbb541325364010900acd9891"),
    ("LGPL-3.0-only", "aae2b222477171fb64e298e7965e768a9a6f85320646b266c94399ac029d42be"),
    ("MPL-1.1", "3f0343dd4f3b064be36e0c6584737c9b7bb5c322721694563f9009e088ce96d1"),
    ("MPL-2.0", "f82071285728ca3ec7685ee9bc4acdae0b8267142a4d20b8f1805eabedb4a98a"),
    ("CC0-1.0", "96bdc7f63190fb4bd1ae584b890300ed7517d858b34c945642a3b9b2f1612a5f"),
    ("GFDL-1.2-only", "5379e6f33e826ba185b23fd11a414555c2161fda481478babd1e73a3ae098a71"),
    ("GFDL-1.3-only", "93d6108daecdddc5f284cf8f2512fb0d72f6e9ee12381feb9704ba194b00c3e6"),
    ("Apache-2.0", "119e2da0e9ec849d113a40405b338c1bbbd2ef9194c22bf2740fa4e195411c40"),
    ("Apache-2.0", "824065d72ca31b7c727341396be4cf76f464b15d9bef680a3638007ce92a009f"),
)

# the rule of the registered query's SQL, which takes any line that starts so
COPYRIGHT = r"(?m)^[^\nA-Za-z0-9]*(?:copyright|\(c\)|©)[^\n]*$"

_BODY = (r"notices?|holders?|owners?|laws?|licen[cs]es?|statements?|and|or|interests?|infringements?|protection|in|of|to|is|as|on|for|"
         r"treat(?:y|ies)|disclaimers?|permissions?|rights?|act|material|status|resulting|will|shall|may|can")
# a copyright line names a year, a holder or the sign; body lines that a wrap starts with the word, and list items (c), are text
COPYRIGHT_LINE = (
    r"(?m)^[^\nA-Za-z0-9]*(?:©|(?i:copyright)(?![A-Za-z0-9])(?![ \t\r]*(?:$|[,;.)\]\"'/-]|(?i:" + _BODY + r")(?![A-Za-z0-9])))"
    r"|\([cC]\)[ \t]*(?:(?i:copyright)(?![A-Za-z0-9])|©|[0-9]{4}(?![0-9])|[A-Z][^\s,]*,?[ \t]+(?:[A-Z]|[0-9]{4}(?![0-9]))|[A-Z][^\s,.]*[ \t\r]*$))[^\n]*$")


def canonical(df: DataFrame, text_col: str = "_text") -> DataFrame:
    """Adds `_lines`: the canonical form with its lines kept apart, one blank between words."""
    plain = F.regexp_replace(ascii_lower(F.regexp_replace(F.col(text_col), COPYRIGHT_LINE, "")), r"[\x00-\x09\x0B-\x2F\x3A-\x60\x7B-\x7F]+", " ")
    respelt = F.col("_lines")
    for old, new in SPELLINGS:
        respelt = F.regexp_replace(respelt, rf"\b{old}\b", new)
    unusual = F.col("_lines").rlike(r"\b(?:" + "|".join(old for old, _ in SPELLINGS) + r")\b")
    # two steps, so that no part of the work is written into the plan twice
    return df.withColumn("_lines", plain).withColumn("_lines", F.when(unusual, respelt).otherwise(F.col("_lines")))


def one_line(lines: Column) -> Column:
    return F.trim(F.regexp_replace(lines, r"[ \n]+", " "))


def known_digests(spark, known: Sequence[tuple[str, str]] = KNOWN + MORE, long: Sequence[tuple[str, str]] = LONG) -> DataFrame:
    """Digests of the known texts, and those in `long`, which are given as digests."""
    texts = canonical(spark.createDataFrame([tuple(x) for x in known], "_license string, _text string"))
    own = texts.select("_license", F.sha2(one_line(F.col("_lines")), 256).alias("_known"))
    return own.unionByName(spark.createDataFrame([tuple(x) for x in long], "_license string, _known string")).dropDuplicates(["_known"])


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", known: Sequence[tuple[str, str]] = KNOWN + MORE,
         long: Sequence[tuple[str, str]] = LONG) -> DataFrame:
    """One row per input row: id, license (of the whole text, or null), n_notices (lines that are a known text),
    licenses (all that were found, sorted, comma-joined), n_copyright (copyright lines), text_sha256 (of the canonical text)."""
    table = F.broadcast(known_digests(docs.sparkSession, known, long))
    rows = id_text(docs, id_col, text_col)
    forms = canonical(rows.select("_id", "_text", F.xxhash64("_text").alias("_key"), F.size(
        F.regexp_extract_all("_text", F.lit(COPYRIGHT_LINE), F.lit(0))).cast("long").alias("_copyright")))
    # units: the whole text first, then each line
    units = F.concat(F.array(one_line(F.col("_lines"))), F.transform(F.split("_lines", "\n"), lambda x: F.trim(x)))
    units = forms.select("_id", "_key", "_copyright", F.posexplode(F.transform(units, lambda u: F.sha2(u, 256))).alias("_at", "_digest"))
    found = written(units.join(table, F.col("_digest") == F.col("_known"), "left").filter("_at = 0 OR _license IS NOT NULL").drop("_known"),
                    "licence-units")
    notices = (found.filter("_at > 0").select("_id", "_key", "_at", "_license").distinct().groupBy("_id", "_key")
               .agg(F.count("*").alias("_notices"), F.collect_set("_license").alias("_found")))
    whole = found.filter("_at = 0").alias("w").join(
        notices.alias("n"), F.col("w._id").eqNullSafe(F.col("n._id")) & (F.col("w._key") == F.col("n._key")), "left")
    none = F.array().cast("array<string>")
    own = F.when(F.col("_license").isNull(), none).otherwise(F.array("_license"))
    return whole.select(
        F.col("w._id").alias(id_col), F.col("_license").alias("license"), F.coalesce("_notices", F.lit(0)).cast("long").alias("n_notices"),
        F.array_join(F.array_sort(F.array_union(F.coalesce("_found", none), own)), ",").alias("licenses"),
        F.col("_copyright").alias("n_copyright"), F.col("_digest").alias("text_sha256"))
