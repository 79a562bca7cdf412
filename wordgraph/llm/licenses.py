"""License scan: canonical digests of whole texts, looked up among known licences.

A text is brought to a canonical form: lower case, lines that name a holder
and "all rights reserved" dropped, punctuation and list marks reduced to single
blanks, equivalent spellings of whole words made one. The digest of that form
is joined with the digests of the known texts, which pass through the same
expression. The form is made once per text; of its lines only those as long as
some known text are hashed, as no other can have its digest. Only DataFrame
functions are used.
"""

from __future__ import annotations

import re
import textwrap
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from wordgraph.session import TableCuts

# The spellings that count as equal (left is replaced by right, as whole words).
SPELLINGS = [
    ("licence", "license"), ("licenced", "licensed"), ("sublicence", "sublicense"), ("acknowledgement",
     "acknowledgment"), ("analogue", "analog"), ("analyse", "analyze"), ("artefact", "artifact"),
    ("authorisation", "authorization"), ("authorised", "authorized"), ("calibre", "caliber"),
    ("cancelled", "canceled"), ("capitalisations", "capitalizations"), ("catalogue", "catalog"),
    ("categorise", "categorize"), ("centre", "center"), ("emphasised", "emphasized"), ("favour", "favor"),
    ("favourite", "favorite"), ("fulfil", "fulfill"), ("fulfilment", "fulfillment"), ("initialise", "initialize"),
    ("judgement", "judgment"), ("labelling", "labeling"), ("labour", "labor"), ("maximise", "maximize"),
    ("modelled", "modeled"), ("modelling", "modeling"), ("offence", "offense"), ("optimise", "optimize"),
    ("organisation", "organization"), ("organise", "organize"), ("practise", "practice"), ("programme", "program"),
    ("realise", "realize"), ("recognise", "recognize"), ("signalling", "signaling"), ("utilisation",
     "utilization"), ("whilst", "while"), ("wilful", "willful"), ("non commercial", "noncommercial"),
    ("https ", "http "),
]

# The texts of well-known short licences and notices.
KNOWN = {
    "MIT": """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and
associated documentation files (the "Software"), to deal in the Software without restriction, including without
limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the
Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:
The above copyright notice and this permission notice shall be included in all copies or substantial portions of
the Software. THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT
LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT
SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF
CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN
THE SOFTWARE.""",
    "ISC": """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is
hereby granted, provided that the above copyright notice and this permission notice appear in all copies. THE
SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL
IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT,
INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN
AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR
PERFORMANCE OF THIS SOFTWARE.""",
    "0BSD": """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is
hereby granted. THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE
INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY
SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR
PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH
THE USE OR PERFORMANCE OF THIS SOFTWARE.""",
    "Zlib": """This software is provided 'as-is', without any express or implied warranty. In no event will the authors
be held liable for any damages arising from the use of this software. Permission is granted to anyone to use this
software for any purpose, including commercial applications, and to alter it and redistribute it freely, subject to
the following restrictions: 1. The origin of this software must not be misrepresented; you must not claim that you
wrote the original software. If you use this software in a product, an acknowledgment in the product documentation
would be appreciated but is not required. 2. Altered source versions must be plainly marked as such, and must not be
misrepresented as being the original software. 3. This notice may not be removed or altered from any source
distribution.""",
    "Apache-2.0-notice": """Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file
except in compliance with the License. You may obtain a copy of the License at
http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, software
distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either
express or implied. See the License for the specific language governing permissions and limitations under the
License.""",
    "Apache-2.0-line": "Licensed under the Apache License, Version 2.0.",
    "MIT-line": "Released under the MIT License.",
    "GPL-3.0-line": "This work is licensed under the GNU General Public License, version 3.",
    "Unlicense": """This is free and unencumbered software released into the public domain. Anyone is free to copy,
modify, publish, use, compile, sell, or distribute this software, either in source code form or as a compiled binary,
for any purpose, commercial or non-commercial, and by any means. In jurisdictions that recognize copyright laws, the
author or authors of this software dedicate any and all copyright interest in the software to the public domain. We
make this dedication for the benefit of the public at large and to the detriment of our heirs and successors. We intend
this dedication to be an overt act of relinquishment in perpetuity of all present and future rights to this software
under copyright law. THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT
NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT
SHALL THE AUTHORS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR
OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE. For
more information, please refer to <https://unlicense.org>""",
    "BSL-1.0": """Permission is hereby granted, free of charge, to any person or organization obtaining a copy of the
software and accompanying documentation covered by this license (the "Software") to use, reproduce, display,
distribute, execute, and transmit the Software, and to prepare derivative works of the Software, and to permit
third-parties to whom the Software is furnished to do so, all subject to the following: The copyright notices in the
Software and this entire statement, including the above license grant, this restriction and the following disclaimer,
must be included in all copies of the Software, in whole or in part, and all derivative works of the Software, unless
such copies or derivative works are solely in the form of machine-executable object code generated by a source
language processor. THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT
NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE, TITLE AND NON-INFRINGEMENT. IN NO
EVENT SHALL THE COPYRIGHT HOLDERS OR ANYONE DISTRIBUTING THE SOFTWARE BE LIABLE FOR ANY DAMAGES OR OTHER LIABILITY,
WHETHER IN CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER
DEALINGS IN THE SOFTWARE.""",
    "CC-BY-NC-4.0-line": "Licensed under CC BY-NC 4.0.",
}

#: The full texts of longer licences, a file each, named by its SPDX name.
TEXTS = Path(__file__).parent / "license_texts"

# Title lines that stand above the texts of KNOWN and of the files.
TITLES = {
    "MIT": ["MIT License", "The MIT License", "The MIT License (MIT)", "MIT License (MIT)", "Expat License"],
    "ISC": ["ISC License", "The ISC License", "ISC License (ISC)"],
    "0BSD": ["BSD Zero Clause License", "Zero-Clause BSD", "0BSD"],
    "Zlib": ["zlib License", "The zlib License", "zlib/libpng license"],
    "BSL-1.0": ["Boost Software License - Version 1.0 - August 17th, 2003", "Boost Software License 1.0"],
    "Unlicense": ["The Unlicense", "Unlicense"],
    "BSD-2-Clause": ["BSD 2-Clause License", "The 2-Clause BSD License", 'BSD 2-Clause "Simplified" License'],
    "BSD-3-Clause": ["BSD 3-Clause License", "The 3-Clause BSD License", 'BSD 3-Clause "New" or "Revised" License'],
}

_ENDORSE = """3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or
promote products derived from this software without specific prior written permission.

"""


def known_texts() -> list[tuple[str, str]]:
    """(licence, text): the short texts, the full ones, and those with a title or list marks as they are usually found."""
    texts = dict(KNOWN) | {f.stem: f.read_text("utf-8") for f in sorted(TEXTS.glob("*.txt"))}
    two = texts["BSD-2-Clause"]
    texts["BSD-3-Clause"] = two.replace("THIS SOFTWARE IS", _ENDORSE + "THIS SOFTWARE IS", 1)
    out = list(texts.items())
    # Often the clauses have bullets in place of numbers.
    for name in ("BSD-2-Clause", "BSD-3-Clause"):
        out.append((name, texts[name].replace("1. ", "* ").replace("2. ", "* ").replace("3. ", "* ")))
    # Apache's appendix on how to apply it is often left out.
    end = "END OF TERMS AND CONDITIONS"
    body = texts["Apache-2.0"].split(end)[0]
    out += [("Apache-2.0", body + end), ("Apache-2.0", body)]
    out += [(name, f"{title}\n\n{text}") for name, text in out for title in TITLES.get(name, [])]
    return out + [(name, rewrapped(text, width)) for name, text in out for width in WIDTHS]


#: Columns at which texts are often wrapped, and a line per paragraph: lines that name a holder may then end elsewhere.
WIDTHS = [60, 65, 70, 72, 75, 76, 78, 79, 80, None]


def rewrapped(text: str, width: int | None) -> str:
    """The paragraphs of a text, wrapped anew or a line each."""
    paragraphs = [" ".join(p.split()) for p in re.split(r"\n\s*\n", text)]
    return "\n\n".join(p if width is None else "\n".join(textwrap.wrap(p, width)) for p in paragraphs)


#: What starts a line that names a holder: the word or sign with a sign, year or blank to fill in after it, at any
#: line; or at the start of a paragraph, in a line of its own, the word not followed by what licences say about notices.
_MARKS = r"[^\S\n]*[#*/;-]*[^\S\n]*"
_NOTICE = r"(?:(?:copyright|\(c\)|©)[^\S\n]*(?:\(c\)|©|[0-9]{4}|\[|<|:|copyright|by\b)|©)[^\n]*"
_OTHER = r"(?:copyright\b(?![^\S\n]+(?:notice|holder|owner|law|licen[cs]e|and|or|interest|in)s?\b)|\(c\))[^\n]{0,100}"
NOTICE_LINE = rf"(?m)^{_MARKS}{_NOTICE}$"
NOTICE_PARAGRAPH = rf"(?:\A|(?<=\n)[^\S\n]*\n)(?:{_MARKS}{_OTHER}(?:\n|\z))+(?=[^\S\n]*(?:\n|\z))"


def _spelled(x: Column) -> Column:
    """``x`` with the spellings made one; only texts that hold one of them go through the replacements."""
    one = x
    for old, new in SPELLINGS:
        one = F.regexp_replace(one, rf"\b{old}\b", new)
    return F.when(x.rlike(r"\b(?:" + "|".join(sorted({old for old, _ in SPELLINGS})) + r")\b"), one).otherwise(x)


def canonical_lines(text: Column) -> Column:
    """The text's lines in canonical form, still one below the other; empty for null."""
    x = F.lower(F.coalesce(text, F.lit("")))
    # Few texts have such lines: the others are not searched for paragraphs.
    named = F.regexp_replace(F.regexp_replace(x, NOTICE_LINE, " "), NOTICE_PARAGRAPH, "\n")
    x = F.when(x.rlike(r"copyright|\(c\)|©"), named).otherwise(x)
    x = F.when(x.contains("rights"), F.regexp_replace(x, r"all rights reserved\.?", " ")).otherwise(x)
    return _spelled(F.regexp_replace(x, r"[^\p{L}\p{N}\n]+", " "))


def canonical(lines: Column) -> Column:
    """The whole text in canonical form: the words of its canonical lines joined by single blanks."""
    return F.trim(F.regexp_replace(lines, r" ?\n[ \n]*|  +", " "))


def _digest(form: Column) -> Column:
    return F.when(form != "", F.sha2(form, 256))


def known_digests(spark: SparkSession, known: dict[str, str] | None = None) -> DataFrame:
    """``license, digest, chars`` of the known texts (``chars``: of the form); of texts with one digest the first name
    stays."""
    rows = spark.createDataFrame(sorted(set(known.items() if known else known_texts())), "license string, text string")
    form = canonical(canonical_lines(F.col("text")))
    return rows.select("license", _digest(form).alias("digest"), F.length(form).alias("chars")).groupBy("digest", "chars").agg(
        F.min("license").alias("license"))


def scan(docs: DataFrame, known: DataFrame, key: str = "doc_id", text: str = "text", cuts: TableCuts | None = None) -> DataFrame:
    """``key, digest, license, notices`` for every row.

    ``license`` is the known licence that the whole text is, else null;
    ``notices`` lists the known ones that a whole line is (sorted, each once;
    empty if none). A text without letters and digits, null and empty ones
    too, has neither a digest nor licences. Equal texts get equal answers.
    """
    cuts = cuts or TableCuts(docs.sparkSession, "licenses")
    # At most one length per known text.
    lengths = sorted(r["chars"] for r in known.select("chars").where("chars > 0").distinct().collect())
    lines = F.transform(F.split("lines", "\n"), F.trim)
    some = F.filter(lines, lambda x: F.length(x).isin(lengths)) if lengths else F.array().cast("array<string>")
    form = docs.select(F.col(key).alias("key"), canonical_lines(F.col(text)).alias("lines"))
    # Not folded into one expression with what uses it, which would make the form anew for each use.
    form = form.where(F.monotonically_increasing_id() >= 0)
    rows = cuts.cut(form.select("key", _digest(canonical(F.col("lines"))).alias("digest"),
                                F.array_sort(F.array_distinct(F.transform(some, lambda x: F.sha2(x, 256)))).alias("found")), "digests")
    names = known.select("digest", "license")
    # Equal sets of lines are looked up once.
    sets = rows.where(F.size("found") > 0).select("found").distinct()
    notices = sets.select("found", F.explode("found").alias("digest")).join(names, "digest").groupBy("found").agg(
        F.sort_array(F.collect_set("license")).alias("notices"))
    return rows.join(names, "digest", "left").join(notices, "found", "left").select(
        F.col("key").alias(key), "digest", "license",
        F.coalesce("notices", F.array().cast("array<string>")).alias("notices"))
