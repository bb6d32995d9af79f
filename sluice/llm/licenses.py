"""Licence scans by canonical digests: whole texts, and single lines as notices, hash-joined to known licences.

Texts are made canonical before they are compared: lower case, statements of copyright gone, punctuation as one space,
equivalent spellings as one. Two texts with one canonical form are one licence, whatever their layout. In a whole text
lines that only reserve all rights go too, the licence's title may stand above its text, and a party that it names is
taken for the general word. Their SHA-256 is joined to
the digests of the known texts, which are a fixed table of some thousand rows and so are broadcast.

A line is a statement of copyright if the word or (c) begins it, or parts or portions of which it speaks, and a sign, year
or owner follows, not if a sentence goes on there. Long licences are known by the digest of their whole text, in its published wording only.

Every known text has a word that begins with a stem of ``STEMS``; a line without any cannot match, and is not made
canonical. Only built-in functions run, the known table included.

Cases: a null or empty text, or one of punctuation, matches nothing; repeated rows each return a row; ids may be null;
an empty table gives an empty one; other columns are ignored.
"""

import re
from itertools import product

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

# The wording of public licences.
TEXTS = {
    "MIT": """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files
(the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish,
distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the
following conditions:

The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.

THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF
MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY
CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE
OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.""",
    "ISC": """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that
the above copyright notice and this permission notice appear in all copies.

THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF
MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES
WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR
IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE.""",
    "0BSD": """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted.

THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF
MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES
WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR
IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE.""",
    "BSD-2-Clause": """Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following
conditions are met:

1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.

2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the
documentation and/or other materials provided with the distribution.

THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO,
THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR
CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO,
PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF
LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS
SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE.""",
    "BSD-3-Clause": """Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following
conditions are met:

1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.

2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the
documentation and/or other materials provided with the distribution.

3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this
software without specific prior written permission.

THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO,
THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR
CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO,
PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF
LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS
SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE.""",
    "Zlib": """This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable for any
damages arising from the use of this software.

Permission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it and redistribute it
freely, subject to the following restrictions:

1. The origin of this software must not be misrepresented; you must not claim that you wrote the original software. If you use this software in a
product, an acknowledgment in the product documentation would be appreciated but is not required.

2. Altered source versions must be plainly marked as such, and must not be misrepresented as being the original software.

3. This notice may not be removed or altered from any source distribution.""",
    "Apache-2.0": """Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License.
You may obtain a copy of the License at

http://www.apache.org/licenses/LICENSE-2.0

Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT
WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions and limitations
under the License.""",
}
# Digests of the whole texts of long licences, without and with the instructions below their terms.
DIGESTS: dict[str, tuple[str, ...]] = {
    "Apache-2.0": (
        "036b5ff6d47b44974c624da95e5bf0ac7ddfe5030e41dfa7ff8ac0c1daa9f32b",
        "6aa661403864282a4d084f1551e8149a5f1a7b5e8b05b6db8e1a8a28d0badc64",
        "f70a2718f78121f2da77cd6afbffffbd668d7c1fd36c85a3ef121e83cb5f48fe",
    ),
    "BSL-1.0": (
        "5fcf89bde8c0c2deb999f4cc626e1aebf90e80fdc5cd334dae008152ef4a1ded",
    ),
    "CC0-1.0": (
        "de4b88a2c819a4661af54f735069ed878216da8b4992b919b84afa18cfc0e54c",
    ),
    "GPL-2.0": (
        "efe73660e5476cf0368fc0fc143f624ff9d1b73c4484b14a9969dd20c5786821",
        "6d332dc4c3c5293a73c6c9da402f9bbc970b3bb1eb472f577e00580573469808",
        "e1270b653c300290e7c039142bccb8776f9b5d14e8a05bc4e87dc7d1614a3b34",
    ),
    "GPL-3.0": (
        "a8cd54d6683aa630f0b8d05d56184ad91dc486756da2df61c94d3e4e8d5ecb68",
        "092a7f3b82e6c22949b46388bca99e725b6e756f1c2b1e3f575447fbd44b6191",
        "ac6b52d57c0104e687039148f7b8e370e04c9bb5705bb786f8ef814eb65e8636",
    ),
    "LGPL-2.1": (
        "4d55922bdeafabde164d75448bbfb0b474bf952bbb541325364010900acd9891",
        "bf2f0c6bf1c47b3b1e3cbedeefecddd1e7db21d1919858d45c2f918efaf426df",
        "48d2010e70a815a564f914b0c7c1e80d7a6843793348fed3684c957112fe0aa4",
    ),
    "LGPL-3.0": (
        "aae2b222477171fb64e298e7965e768a9a6f85320646b266c94399ac029d42be",
    ),
    "MPL-2.0": (
        "f82071285728ca3ec7685ee9bc4acdae0b8267142a4d20b8f1805eabedb4a98a",
    ),
    "Unlicense": (
        "7a4d92cdb11d254973a073803be1148a5402f1b2ca67808cdb3ef78b596102cd",
    ),
}
# Titles above the texts.
TITLES = {
    "MIT": ("MIT License", "The MIT License", "MIT License (MIT)", "The MIT License (MIT)", "MIT"),
    "ISC": ("ISC License", "The ISC License", "ISC License (ISC)", "The ISC License (ISC)", "ISC"),
    "0BSD": ("BSD Zero Clause License", "Zero-Clause BSD", "Zero-Clause BSD License", "BSD Zero Clause License (0BSD)", "0BSD"),
    "BSD-2-Clause": ("BSD 2-Clause License", "The BSD 2-Clause License", "The 2-Clause BSD License", "Simplified BSD License", "BSD License", "BSD-2-Clause"),
    "BSD-3-Clause": (
        "BSD 3-Clause License", "The BSD 3-Clause License", "The 3-Clause BSD License", "New BSD License", "Modified BSD License", "BSD License",
        "BSD-3-Clause",
    ),
    "Zlib": ("zlib License", "The zlib License", "zlib/libpng License", "The zlib/libpng License", "zlib"),
}
# How licences are named in notices, in canonical form.
NAMES = {
    "MIT": ("the mit license", "mit license", "mit"),
    "ISC": ("the isc license", "isc license", "isc"),
    "BSD-2-Clause": ("the bsd 2 clause license", "bsd 2 clause license", "bsd 2 clause"),
    "BSD-3-Clause": ("the bsd 3 clause license", "bsd 3 clause license", "bsd 3 clause"),
    "Apache-2.0": ("the apache license version 2 0", "the apache license 2 0", "the apache 2 0 license", "apache license 2 0", "apache 2 0"),
    "MPL-2.0": ("the mozilla public license version 2 0", "the mozilla public license 2 0", "mpl 2 0"),
    "GPL-2.0": ("the gnu general public license version 2", "the gpl version 2", "gplv2", "gpl 2 0"),
    "GPL-3.0": ("the gnu general public license version 3", "the gpl version 3", "gplv3", "gpl 3 0"),
    "LGPL-3.0": ("the gnu lesser general public license version 3", "lgplv3", "lgpl 3 0"),
    "AGPL-3.0": ("the gnu affero general public license version 3", "agplv3", "agpl 3 0"),
    "CC0-1.0": ("cc0 1 0", "cc0"),
    "CC-BY-4.0": ("cc by 4 0", "the creative commons attribution 4 0 international license"),
    "CC-BY-SA-4.0": ("cc by sa 4 0", "the creative commons attribution sharealike 4 0 international license"),
    "CC-BY-NC-4.0": ("cc by nc 4 0", "the creative commons attribution noncommercial 4 0 international license"),
    "CC-BY-ND-4.0": ("cc by nd 4 0", "the creative commons attribution noderivatives 4 0 international license"),
    "Unlicense": ("the unlicense",),
}
SUBJECTS = ("", "this work is ", "this text is ", "this file is ", "this software is ", "this program is ", "this project is ", "this document is ")
VERBS = ("licensed", "released", "distributed", "published", "made available", "available")
RESERVED = "all rights reserved"
# Spellings that a comparison of licences takes as one.
SPELLINGS = {
    "acknowledgement": "acknowledgment", "analogue": "analog", "analyse": "analyze", "artefact": "artifact", "authorisation": "authorization",
    "authorised": "authorized", "cancelled": "canceled", "catalogue": "catalog", "centre": "center", "colour": "color", "favour": "favor",
    "favourite": "favorite", "fulfil": "fulfill", "fulfilment": "fulfillment", "honour": "honor", "initialise": "initialize",
    "judgement": "judgment", "labour": "labor", "licence": "license", "licences": "licenses", "licenced": "licensed", "merchantibility": "merchantability",
    "modelled": "modeled", "modelling": "modeling", "offence": "offense", "optimise": "optimize", "organisation": "organization",
    "organise": "organize", "owner": "holder", "owners": "holders", "practise": "practice", "programme": "program", "realise": "realize",
    "recognise": "recognize", "signalling": "signaling", "sublicence": "sublicense", "utilisation": "utilization", "whilst": "while",
    "wilful": "willful",
}
STEMS = ("licen", "permission", "redistribution", "reserved", "under")
# Words that go on with a sentence after "copyright".
GOES_ON = (
    "notices? holders? owners? licen[cs]es? licensors? laws? statements? permissions? interests? protections? treat(?:y|ies) disclaimers? rights? "
    "lines? infringements? patent trademark also and or on in of for to is are as that which with"
).replace(" ", "|")
# Parts of patterns, each of one line. A word of a name is taken whole or not at all, and what repeats is never tried again
# in parts: patterns take time in proportion to a line, and no stack, however long it is.
_BEGIN, _SIGN = "[^\\p{L}\\p{N}\\n©]*(?:(?:some )?(?:portions|parts|modifications)[ \\t:,-]+)?", "\\(c\\)|©|&copy;|[\\[{<]"
_YEAR = "[^\\n]*\\b(?:19|20)\\d\\d\\b"
_NAME = "(?-i:\\p{Lu})\\S*"
_OWNER = f"{_NAME}(?:[ \\t]+(?:{_NAME}|<\\S+>|&|(?:and|of|the|de|von)(?!\\S)))*+[ \\t\\r]*$"
COPYRIGHT_LINE = (
    f"(?imd)^{_BEGIN}(?:©"
    f"|copyrights?(?![\\p{{L}}\\p{{N}}])[ \\t:,.-]*+(?:{_SIGN}|\\p{{N}}|by\\b|(?!(?:{GOES_ON})\\b)(?:(?-i:\\p{{Lu}})|{_YEAR}))"
    f"|\\(c\\)[ \\t]*+(?:copyright\\b|{_SIGN}|\\p{{N}}|{_YEAR}|[^\\s.]+[ \\t\\r]*$|{_OWNER})"
    ")[^\\n]*$"
)
RESERVED_LINE = f"(?imd)^[^\\p{{L}}\\p{{N}}\\n]*+{RESERVED}[^\\p{{L}}\\p{{N}}\\n]*$"
# Where a licence names its parties, in canonical form, and the general words for them.
PARTIES = (
    ("neither the names? of [\\p{L}\\p{N} ]{1,200}? nor the names? of (?:its|their|any) contributors", "neither the name of the copyright holder nor the names of its contributors"),
    ("this software is provided by [\\p{L}\\p{N} ]{1,200}? and contributors as is", "this software is provided by the copyright holders and contributors as is"),
    ("in no event shall [\\p{L}\\p{N} ]{1,200}? or contributors be liable", "in no event shall the copyright holder or contributors be liable"),
)


def _words(text: Column) -> Column:
    return F.trim(F.regexp_replace(F.lower(text), "[^\\p{L}\\p{N}]+", " "))


def canonical(text: Column) -> Column:
    """The canonical form of a text, empty if nothing is left of it."""
    spelled = F.create_map(*[F.lit(x) for pair in SPELLINGS.items() for x in pair])
    words = F.split(_words(F.regexp_replace(text, COPYRIGHT_LINE, "")), " ")
    out = F.array_join(F.transform(words, lambda w: F.coalesce(F.try_element_at(spelled, w), w)), " ")
    for named, general in PARTIES:
        out = F.regexp_replace(out, named, general)
    return out


def digest(text: Column, whole: Column) -> Column:
    """SHA-256 of the canonical form, null if it is empty."""
    return F.sha2(F.nullif(canonical(F.when(whole, F.regexp_replace(text, RESERVED_LINE, "")).otherwise(text)), F.lit("")), 256)


def layouts() -> list[tuple[str, str]]:
    """(licence, text) of the whole texts as they are set: with and without a title, and with bullets for numbers."""
    out = [(i, f"{title}\n{t}") for i, t in TEXTS.items() for title in ("", *TITLES.get(i, ()))]
    return out + [(i, re.sub(r"(?m)^\d\. ", "* ", t)) for i, t in out if i.startswith("BSD")]


def notices() -> list[tuple[str, str]]:
    """(licence, notice) of every wording of a notice, by rule."""
    out = [(i, f"{s}{v} under {n}") for i, names in NAMES.items() for s, v, n in product(SUBJECTS, VERBS, names)]
    out += [(i, f"SPDX-License-Identifier: {i}") for i in NAMES]
    return [*out, ("all-rights-reserved", RESERVED)]


def known(spark: SparkSession, texts: dict[str, str] | None = None) -> DataFrame:
    """(digest, license_id, whole): a row for each known text and notice. ``texts`` adds or replaces whole texts."""
    texts = texts or {}
    rows = [(i, t, True) for i, t in layouts() if i not in texts] + [(i, t, True) for i, t in texts.items()] + [(i, t, False) for i, t in notices()]
    table = spark.createDataFrame(rows, "license_id string, text string, whole boolean")
    table = table.select(digest(F.col("text"), F.col("whole")).alias("digest"), "license_id", "whole")
    long = [(d, i, True) for i, digests in DIGESTS.items() if i not in texts for d in digests]
    table = table.unionByName(spark.createDataFrame(long, "digest string, license_id string, whole boolean"))
    return table.groupBy("digest", "whole").agg(F.min("license_id").alias("license_id"))


def scanned(docs: DataFrame, known_texts: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, license_id, notices, n_notices) of every row: the licence that the whole text is, the licences that its
    lines name, sorted and joined by commas, and the number of such lines."""
    stem = "|".join(STEMS)
    rows = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"), F.monotonically_increasing_id().alias("row"))
    likely = lambda text: F.lower(text).rlike(stem)
    lines = F.filter(F.split("text", "\n"), likely)
    unit = lambda text, whole: F.struct(text.alias("part"), F.lit(whole).alias("whole"))
    units = F.concat(F.array(unit(F.when(likely(F.col("text")), F.col("text")), True)), F.transform(lines, lambda x: unit(x, False)))
    parts = rows.withColumn("likely", likely(F.col("text"))).select(
        "id", "row", F.explode(F.when(F.col("likely"), units).otherwise(F.array(unit(F.lit(None).cast("string"), True)))).alias("u")
    )
    digests = parts.select("id", "row", F.col("u.whole").alias("whole"), F.when(F.col("u.part").isNotNull(), digest(F.col("u.part"), F.col("u.whole"))).alias("digest"))
    found = digests.join(F.broadcast(known_texts), ["digest", "whole"], "left")
    named = F.when(~F.col("whole"), F.col("license_id"))
    return found.groupBy("id", "row").agg(
        F.max(F.when(F.col("whole"), F.col("license_id"))).alias("license_id"),
        F.array_join(F.array_sort(F.collect_set(named)), ",").alias("notices"),
        F.count(named).alias("n_notices"),
    ).select(F.col("id").alias(id_col), "license_id", "notices", "n_notices")
