"""License scans by canonical digest: whole texts and lines, normalised, against known licence texts. DataFrame functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import text_or_empty

# Spellings that count as the same, as the SPDX matching guidelines list them.
SPELLINGS = (
    ("licence", "license"), ("sub license", "sublicense"), ("acknowledgement", "acknowledgment"), ("analogue", "analog"), ("analyse", "analyze"), ("artefact", "artifact"),
    ("authorisation", "authorization"), ("authorised", "authorized"), ("calibre", "caliber"), ("cancelled", "canceled"), ("capitalisations", "capitalizations"), ("catalogue", "catalog"),
    ("categorise", "categorize"), ("centre", "center"), ("emphasised", "emphasized"), ("favour", "favor"), ("favourite", "favorite"), ("fulfil ", "fulfill "), ("fulfilment", "fulfillment"),
    ("initialise", "initialize"), ("judgement", "judgment"), ("labelling", "labeling"), ("labour", "labor"), ("maximise", "maximize"), ("modelled", "modeled"), ("modelling", "modeling"),
    ("non commercial", "noncommercial"), ("offence", "offense"), ("optimise", "optimize"), ("organisation", "organization"), ("organise", "organize"), ("per cent", "percent"), ("practise", "practice"),
    ("programme", "program"), ("realise", "realize"), ("recognise", "recognize"), ("signalling", "signaling"), ("utilisation", "utilization"), ("whilst", "while"), ("wilful", "willful"),
)

_BSD = """Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:
1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.
2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution.
{third}THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."""
_ISC = """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted{notice}.
THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE."""
_MIT = """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so{condition}
THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."""
_MIT_CONDITION = ", subject to the following conditions:\nThe above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software."

# Whole licence texts, and the one-line notices that stand for one.
KNOWN = (
    ("MIT", _MIT.format(condition=_MIT_CONDITION)),
    ("MIT", "MIT License\n" + _MIT.format(condition=_MIT_CONDITION)),
    ("MIT", "The MIT License (MIT)\n" + _MIT.format(condition=_MIT_CONDITION)),
    ("MIT-0", _MIT.format(condition=".")),
    ("BSD-2-Clause", _BSD.format(third="")),
    ("BSD-3-Clause", _BSD.format(third="3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission.\n")),
    ("ISC", _ISC.format(notice=", provided that the above copyright notice and this permission notice appear in all copies")),
    ("0BSD", _ISC.format(notice="")),
    ("Apache-2.0", 'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License. You may obtain a copy of the License at\nhttp://www.apache.org/licenses/LICENSE-2.0\nUnless required by applicable law or agreed to in writing, software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions and limitations under the License.'),
    ("MIT", "Released under the MIT License."),
    ("MIT", "Licensed under the MIT License."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("GPL-3.0-only", "This work is licensed under the GNU General Public License, version 3."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("MIT", "SPDX-License-Identifier: MIT"),
    ("Apache-2.0", "SPDX-License-Identifier: Apache-2.0"),
    ("BSD-3-Clause", "SPDX-License-Identifier: BSD-3-Clause"),
    ("GPL-3.0-only", "SPDX-License-Identifier: GPL-3.0-only"),
)

# Usual titles above whole texts.
TITLES = {
    "MIT-0": ("MIT No Attribution", "MIT No Attribution License"),
    "BSD-2-Clause": ("BSD 2-Clause License", "The BSD 2-Clause License", 'BSD 2-Clause "Simplified" License', "Simplified BSD License"),
    "BSD-3-Clause": ("BSD 3-Clause License", "The BSD 3-Clause License", 'BSD 3-Clause "New" or "Revised" License', "New BSD License", "Modified BSD License"),
    "ISC": ("ISC License", "The ISC License", "ISC License (ISC)"),
    "0BSD": ("BSD Zero Clause License", "Zero-Clause BSD", "0BSD License"),
}
TITLED = tuple((name, f"{title}\n{text}") for name, text in KNOWN if "\n" in text for title in TITLES.get(name, ()))

#: Canonical digests of whole texts that are too long for this file, as published with their titles.
DIGESTS = (
    ("Apache-2.0", "045649cdaf85384ba827242062f2f3b36409835c98d297e25177cb1faf7c2847"),
    ("CC0-1.0", "96bdc7f63190fb4bd1ae584b890300ed7517d858b34c945642a3b9b2f1612a5f"),
    ("GPL-2.0-only", "e95eb1718f9f373d56cc586a5f7d1bfa11668867f6e85e982d2b6108b97d90a1"),
    ("GPL-3.0-only", "df71f3c423c11bc52456a9775329f1d9a3168a6f071654750b9eb155fb3ec0eb"),
    ("LGPL-2.1-only", "ede2b00a7c3823a62ef837da1b2e848d4151187ba307a2f23aebaeebbc80bf7c"),
    ("LGPL-3.0-only", "aae2b222477171fb64e298e7965e768a9a6f85320646b266c94399ac029d42be"),
    ("MPL-1.1", "fbe9a0b96f52e03cb474f9a7083781399c011279e85b548118563ec96e659354"),
    ("MPL-2.0", "95f6a0d094cf3da6a140310541c7b576789031b600469b70877b34f97918e4c9"),
)

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: A line that states a copyright, behind comment signs.
COPYRIGHT = r"(^|\n)[ \t*#/;%-]*(copyright|\(c\)|©|all rights reserved)[^\n]*"
#: The same, but not a line of a wrapped sentence about copyright notices, holders and such.
STATEMENT = COPYRIGHT.replace("copyright|", r"copyright(?![ \t]+(?:notices?|holders?|owners?|laws?|licen[sc]\w*|statements?|disclaimers?|interests?|protection|permissions?|treaty|and|or|in|to|is|are|as|of|on|that|which)\b)|")
#: White space, ASCII punctuation and the typographic quotes, dashes and dots.
BETWEEN = r"[\x00-\x2F\x3A-\x60\x7B-\x7F‘’“”–—…•]+"


def canonical(text: Column) -> Column:
    """The text with ASCII letters lowered, lines that state a copyright dropped, all punctuation and white space one blank, and spellings unified."""
    out = F.regexp_replace(F.translate(text, UPPER, LOWER), STATEMENT, "$1")
    out = F.concat(F.lit(" "), F.trim(F.regexp_replace(out, BETWEEN, " ")), F.lit(" "))
    for spelling, same in SPELLINGS:
        out = F.replace(out, F.lit(spelling), F.lit(same))
    return F.trim(out)


def known_digests(spark: SparkSession, known: tuple = KNOWN + TITLED, digests: tuple = DIGESTS) -> DataFrame:
    """(license, digest) of the known texts and digests; a digest that two names share goes to the first by name."""
    rows = spark.range(1).select(F.inline(F.array(*[F.struct(F.lit(n).alias("license"), F.lit(t).alias("text")) for n, t in known])))
    rows = rows.select("license", F.sha2(canonical(F.col("text")), 256).alias("known"))
    if digests:
        rows = rows.unionAll(spark.range(1).select(F.inline(F.array(*[F.struct(F.lit(n).alias("license"), F.lit(d).alias("known")) for n, d in digests]))))
    return rows.groupBy("known").agg(F.min("license").alias("license"))


def scan(docs: DataFrame, known: tuple = KNOWN + TITLED) -> DataFrame:
    """A row a document: doc_id, digest (of the canonical whole text), license (whose whole text it is, or null),
    n_notices (lines that are a known text by themselves) and notices (their licences, sorted, comma-joined).

    The known texts are a fixed list, so the hash join broadcasts them. If every known one-line text holds
    "licen", only lines that do are looked at. Null texts count as empty, whose digest is no licence's; an empty table gives no rows.
    """
    digests = known_digests(docs.sparkSession, known)
    lines = F.split(F.col("text"), "\n")
    if all("licen" in t.lower() for _, t in known if "\n" not in t):
        lines = F.filter(lines, lambda line: F.contains(F.translate(line, UPPER, LOWER), F.lit("licen")))
    names = [F.struct(F.sha2(canonical(F.lit(t)), 256).alias("known"), F.lit(name).alias("license")) for name, t in known if "\n" not in t]
    one_line = F.map_from_entries(F.array(*names)) if names else F.create_map().cast("map<string,string>")
    found = F.transform(lines, lambda line: F.element_at(one_line, F.sha2(canonical(line), 256)))
    found = F.array_sort(F.filter(found, lambda name: name.isNotNull()))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_or_empty().alias("text"))
    rows = rows.select("doc_id", F.sha2(canonical(F.col("text")), 256).alias("digest"), found.alias("found"))
    met = rows.join(F.broadcast(digests), F.col("digest") == F.col("known"), "left")
    return met.select("doc_id", "digest", "license", F.size("found").cast("long").alias("n_notices"), F.array_join(F.array_distinct("found"), ",").alias("notices"))
