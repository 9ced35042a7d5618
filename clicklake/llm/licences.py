"""Licence scans by canonical digests, hash-joined with the digests of known licences.

A text's canonical form drops copyright notices, lower-cases, replaces equivalent spellings, and turns every run of ASCII
punctuation, typographic quotes, dashes and white space into one blank. Its SHA-256 digest stands for the text.
Whole texts and single lines are both looked up, as entire units; nothing is compared word by word.

A notice is a whole line: it starts with a copyright sign, or with "copyright" or "(c)" in front of a sign or a year, or
says that all rights are reserved. Prose that a line break leaves at the start of a line ("copyright holders be liable", "copyright notice")
is kept, so a text has one form in every line wrapping. Other lines that start with "copyright" or "(c)" are a name or
prose and a list item; a whole text that holds any is looked up both with and without them. A notice that runs on into the text
within its line takes that line with it, and the further lines of a wrapped notice stay.

Defined cases: a null text, or one whose canonical form is empty, matches nothing; equal documents match
alike; a line that occurs more than once in a document is one row with its count; texts of any length are scanned
whole; an empty table gives no rows; other columns are not read. Known licences are a parameter; their digests
are joined as a table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clicklake.llm.common import ascii_lower, table

#: A line that starts like a copyright notice, in the lower-cased text.
COPYRIGHT = r"^[^a-z0-9©]*(copyright|\(c\)|©|all rights reserved)"
#: Such a line that is one: a sign, a year or a place for one follows.
NOTICE = (
    r"^[^a-z0-9©]*(?:©|all rights reserved"
    r"|(?:(?:copyright|\(c\))[^a-z0-9©]*){1,3}(?:\(c\)|©|[12][0-9]{3}(?![0-9])|(?:year|yyyy)(?![a-z])))"
)
#: Such a line that is prose, from the words that follow "copyright" in licences.
PROSE = (
    r"^[^a-z0-9©]*copyright(?:s|ed|able)?(?:[^a-z0-9©]*$|[^a-z0-9©]+(?:holders?|owners?|notices?|licen[cs]es?|laws?|statements?"
    r"|interests?|claims?|rights?|disclaimers?|treaty|status|protection|permissions?|works?|material|patents?|trademarks?"
    r"|and|or|in|to|of|is|on|as|for|the|this|that|under|if|with|applies|you|your)(?![a-z]))"
)
SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F\x{00A0}\x{2010}-\x{2015}\x{2018}-\x{201F}\x{2026}\x{3000}]+"
#: Equivalent spellings, replaced in this order after punctuation has become blanks.
SPELLINGS = [
    ("licence", "license"),
    ("sub license", "sublicense"),
    ("non commercial", "noncommercial"),
    ("organisation", "organization"),
    ("acknowledgement", "acknowledgment"),
    ("redistributions", "redistribution"),
    ("copyright owner", "copyright holder"),
    ("https", "http"),
]

#: Licence texts and notices. Fixed values.
LISTED = {
    "Apache-2.0": ["Licensed under the Apache License, Version 2.0."],
    "Apache-1.1": ["Licensed under the Apache License, Version 1.1."],
    "MIT": [
        "Released under the MIT License.",
        "Licensed under the MIT License.",
        """MIT License

        Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated
        documentation files (the "Software"), to deal in the Software without restriction, including without limitation the
        rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit
        persons to whom the Software is furnished to do so, subject to the following conditions:

        The above copyright notice and this permission notice shall be included in all copies or substantial portions of the
        Software.

        THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE
        WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR
        COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR
        OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.""",
    ],
    "ISC": [
        """ISC License

        Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby
        granted, provided that the above copyright notice and this permission notice appear in all copies.

        THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL
        IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT,
        INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN
        ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF
        THIS SOFTWARE.""",
    ],
    **{
        f"GPL-{v}.0": [
            f"This work is licensed under the GNU General Public License, version {v}.",
            f"This program is licensed under the GNU General Public License, version {v}.",
        ]
        for v in (2, 3)
    },
    **{f"CC-BY-NC-{v}": [f"Licensed under CC BY-NC {v}."] for v in ("2.0", "2.5", "3.0", "4.0")},
    **{f"CC-BY-{v}": [f"Licensed under CC BY {v}."] for v in ("2.0", "2.5", "3.0", "4.0")},
}

_MIT = LISTED["MIT"][2].split("\n", 1)[1]
_ISC = LISTED["ISC"][0].split("\n", 1)[1]
_ISC_AUTHORS = _ISC.replace("AUTHOR DISCLAIMS", "AUTHORS DISCLAIM").replace("AUTHOR BE", "AUTHORS BE")
_0BSD, _0BSD_AUTHORS = (
    t.replace(", provided that the above copyright notice and this permission notice appear in all copies", "")
    for t in (_ISC, _ISC_AUTHORS)
)
_ZLIB = """
    This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held
    liable for any damages arising from the use of this software.

    Permission is granted to anyone to use this software for any purpose, including commercial applications, and to
    alter it and redistribute it freely, subject to the following restrictions:

    1. The origin of this software must not be misrepresented; you must not claim that you wrote the original
    software. If you use this software in a product, an acknowledgment in the product documentation would be
    appreciated but is not required.

    2. Altered source versions must be plainly marked as such, and must not be misrepresented as being the original
    software.

    3. This notice may not be removed or altered from any source distribution."""
_UNLICENSE = """
    This is free and unencumbered software released into the public domain.

    Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in source code
    form or as a compiled binary, for any purpose, commercial or non-commercial, and by any means.

    In jurisdictions that recognize copyright laws, the author or authors of this software dedicate any and all
    copyright interest in the software to the public domain. We make this dedication for the benefit of the public
    at large and to the detriment of our heirs and successors. We intend this dedication to be an overt act of
    relinquishment in perpetuity of all present and future rights to this software under copyright law.

    THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO
    THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE
    AUTHORS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR
    OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.

    For more information, please refer to <http://unlicense.org/>"""
_BSL = """
    Permission is hereby granted, free of charge, to any person or organization obtaining a copy of the software and
    accompanying documentation covered by this license (the "Software") to use, reproduce, display, distribute,
    execute, and transmit the Software, and to prepare derivative works of the Software, and to permit third-parties
    to whom the Software is furnished to do so, all subject to the following:

    The copyright notices in the Software and this entire statement, including the above license grant, this
    restriction and the following disclaimer, must be included in all copies of the Software, in whole or in part,
    and all derivative works of the Software, unless such copies or derivative works are solely in the form of
    machine-executable object code generated by a source language processor.

    THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO
    THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE, TITLE AND NON-INFRINGEMENT. IN NO EVENT
    SHALL THE COPYRIGHT HOLDERS OR ANYONE DISTRIBUTING THE SOFTWARE BE LIABLE FOR ANY DAMAGES OR OTHER LIABILITY,
    WHETHER IN CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR
    OTHER DEALINGS IN THE SOFTWARE."""
_BSD_HEAD = """
    Redistribution and use in source and binary forms, with or without modification, are permitted provided that the
    following conditions are met:"""
_BSD_CLAUSES = [
    """
    Redistributions of source code must retain the above copyright notice, this list of conditions and the following
    disclaimer.""",
    """
    Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the
    following disclaimer in the documentation and/or other materials provided with the distribution.""",
    """
    Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote
    products derived from this software without specific prior written permission.""",
]
_BSD_TAIL = """
    THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED
    WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A
    PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY
    DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO,
    PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER
    CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR
    OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH
    DAMAGE."""


def _bsd(clauses: int) -> list[str]:
    """The text with numbered clauses, with marks and with letters."""
    marks = [["1.", "2.", "3."], ["*", "*", "*"], ["(1)", "(2)", "(3)"], ["a.", "b.", "c."], ["i.", "ii.", "iii."]]
    given = [[f"{mark} {text}" for mark, text in zip(m, _BSD_CLAUSES[:clauses])] for m in marks]
    return ["\n\n".join([_BSD_HEAD, *each, _BSD_TAIL]) for each in given]


#: Whole texts of short licences: titles that they come with, and bodies. Each body is known without a title as well.
TEXTS = {
    "MIT": (["MIT License", "The MIT License", "The MIT License (MIT)"], [_MIT]),
    "ISC": (["ISC License", "The ISC License"], [_ISC, _ISC_AUTHORS]),
    "0BSD": (["Zero-Clause BSD", "BSD Zero Clause License", "Zero Clause BSD License", "0BSD"], [_0BSD, _0BSD_AUTHORS]),
    "BSD-2-Clause": (
        ["BSD 2-Clause License", "The 2-Clause BSD License", 'BSD 2-Clause "Simplified" License', "Simplified BSD License", "BSD License"],
        _bsd(2),
    ),
    "BSD-3-Clause": (
        [
            "BSD 3-Clause License", "The 3-Clause BSD License", 'BSD 3-Clause "New" or "Revised" License', "New BSD License",
            "Modified BSD License", "BSD License",
        ],
        _bsd(3),
    ),
    "Zlib": (["zlib License", "The zlib License", "zlib/libpng License", "The zlib/libpng License"], [_ZLIB]),
    "Unlicense": (
        ["The Unlicense", "Unlicense"],
        [_UNLICENSE, _UNLICENSE.replace("http:", "https:"), _UNLICENSE.replace("<http://unlicense.org/>", "<https://unlicense.org>")],
    ),
    "BSL-1.0": (["Boost Software License - Version 1.0 - August 17th, 2003", "Boost Software License 1.0"], [_BSL]),
}

#: Names that notices call a licence by.
NAMES = {
    "MIT": ["the MIT License", "the MIT license (MIT)", "MIT"],
    "ISC": ["the ISC License"],
    "0BSD": ["the Zero-Clause BSD License", "the BSD Zero Clause License"],
    "Zlib": ["the zlib License"],
    "Unlicense": ["the Unlicense"],
    "BSL-1.0": ["the Boost Software License, Version 1.0", "the Boost Software License 1.0"],
    "CC0-1.0": ["CC0 1.0", "CC0", "CC0 1.0 Universal", "the Creative Commons CC0 1.0 Universal License"],
    **{f"BSD-{n}-Clause": [f"the BSD {n}-Clause License", f"the {n}-Clause BSD License"] for n in (2, 3, 4)},
    **{f"Apache-{v}": [f"the Apache License, Version {v}", f"the Apache License {v}", f"Apache {v}"] for v in ("1.0", "1.1", "2.0")},
    **{
        f"MPL-{v}": [f"the Mozilla Public License, Version {v}", f"the Mozilla Public License, v. {v}", f"the Mozilla Public License {v}"]
        for v in ("1.0", "1.1", "2.0")
    },
    **{f"EPL-{v}": [f"the Eclipse Public License, Version {v}", f"the Eclipse Public License {v}"] for v in ("1.0", "2.0")},
    **{
        f"{short}-{v if '.' in v else v + '.0'}{suffix}": [
            form.format(name=name, short=short, v=v, later=later)
            for form in ("the GNU {name}, version {v}{later}", "the GNU {name} v{v}{later}", "the GNU {short} v{v}{later}", "the {short} v{v}{later}")
            for later in laters
        ]
        for short, name, versions in [
            ("GPL", "General Public License", "1 2 3"), ("LGPL", "Lesser General Public License", "2.1 3"),
            ("LGPL", "Library General Public License", "2"), ("AGPL", "Affero General Public License", "3"),
            ("GFDL", "Free Documentation License", "1.1 1.2 1.3"),
        ]
        for v in versions.split()
        for suffix, laters in [("", [""]), ("-or-later", [" or later", " or any later version"])]
    },
    **{
        f"CC-{kind}-{v}": [
            f"CC {kind} {v}", f"a Creative Commons {name} {v} {scope} License", f"the Creative Commons {name} {v} {scope} License",
            f"Creative Commons {name} {v} {scope}", f"Creative Commons {name} {v}",
        ]
        for kind, name in [
            ("BY", "Attribution"), ("BY-SA", "Attribution-ShareAlike"), ("BY-ND", "Attribution-NoDerivatives"),
            ("BY-NC", "Attribution-NonCommercial"), ("BY-NC-SA", "Attribution-NonCommercial-ShareAlike"),
            ("BY-NC-ND", "Attribution-NonCommercial-NoDerivatives"),
        ]
        for v, scope in [("1.0", "Generic"), ("2.0", "Generic"), ("2.5", "Generic"), ("3.0", "Unported"), ("4.0", "International")]
    },
}
OPENINGS = [
    "Licensed under", "Released under", "Distributed under", "Available under", "License:",
    *[f"This {what} is {how} under" for what in ("work", "program", "library", "software", "project", "file", "code", "document") for how in ("licensed", "released", "distributed")],
]


def _known() -> dict[str, list[str]]:
    known = {name: list(texts) for name, texts in LISTED.items()}
    for name, (titles, bodies) in TEXTS.items():
        known.setdefault(name, []).extend(f"{title}\n\n{body}" for title in ["", *titles] for body in bodies)
    for name, names in NAMES.items():
        known.setdefault(name, []).extend(f"{opening} {called}." for opening in OPENINGS for called in names)
        known[name].append(f"SPDX-License-Identifier: {name}")
    return known


#: Known licence texts and notices.
KNOWN = _known()
#: SHA-256 of the canonical forms of long licences, whole and up to the end of their terms.
LONG = {
    "036b5ff6d47b44974c624da95e5bf0ac7ddfe5030e41dfa7ff8ac0c1daa9f32b": "Apache-2.0",
    "6aa661403864282a4d084f1551e8149a5f1a7b5e8b05b6db8e1a8a28d0badc64": "Apache-2.0",
    "f70a2718f78121f2da77cd6afbffffbd668d7c1fd36c85a3ef121e83cb5f48fe": "Apache-2.0",
    "08f1dc258c8f9e175155356aa1dd0dead8cfdec586bc1bb4c8b1452699a91702": "Artistic-1.0-Perl",
    "96bdc7f63190fb4bd1ae584b890300ed7517d858b34c945642a3b9b2f1612a5f": "CC0-1.0",
    "15f6a8d360ffdecc988c29279c00f23e20de17f14f2a06572ab0d41de6e98b7b": "GFDL-1.2",
    "2d36daeff2ad303badb6dee8149748be25e22974dd468e1e8a55cf40f16fc01d": "GFDL-1.3",
    "6375a768fd262bf5281905a9585411d2d0fb4ea15cb08cfcba49f73fedb82abc": "GPL-1.0",
    "89f75ffda938e788be38679f9f83e317c2a03398fccf03ee60505d44d1bf9f70": "GPL-1.0",
    "8f586b09c093668e2db772bdcfc1d5dc0b03e0e862fccbff035e1bf134e9b224": "GPL-1.0",
    "6d332dc4c3c5293a73c6c9da402f9bbc970b3bb1eb472f577e00580573469808": "GPL-2.0",
    "e1270b653c300290e7c039142bccb8776f9b5d14e8a05bc4e87dc7d1614a3b34": "GPL-2.0",
    "efe73660e5476cf0368fc0fc143f624ff9d1b73c4484b14a9969dd20c5786821": "GPL-2.0",
    "092a7f3b82e6c22949b46388bca99e725b6e756f1c2b1e3f575447fbd44b6191": "GPL-3.0",
    "ac6b52d57c0104e687039148f7b8e370e04c9bb5705bb786f8ef814eb65e8636": "GPL-3.0",
    "eaab5d82fdcca441d83a1913bbf07e4de3a739e190578c0bffde24f84e93bb2a": "GPL-3.0",
    "430627da7218a92ab4a6d75d5140cdb70ee750be7a53f913299b37e0d1b0eea2": "LGPL-2.0",
    "504542bce5421b0f5a7e63ddb55443ccb300b27a65ba6bfc1370fed16a3af260": "LGPL-2.0",
    "61af4dcea4e412e8ccfb8877fd2762bd6d962f8d42a9fa2c06cf7b4613f2c908": "LGPL-2.0",
    "48d2010e70a815a564f914b0c7c1e80d7a6843793348fed3684c957112fe0aa4": "LGPL-2.1",
    "4d55922bdeafabde164d75448bbfb0b474bf952bbb541325364010900acd9891": "LGPL-2.1",
    "bf2f0c6bf1c47b3b1e3cbedeefecddd1e7db21d1919858d45c2f918efaf426df": "LGPL-2.1",
    "aae2b222477171fb64e298e7965e768a9a6f85320646b266c94399ac029d42be": "LGPL-3.0",
    "cbbde7eeab9b4d180dc00b34252f800e97fb1cddbab38ed8c0c73b956dc2cbf6": "MPL-1.1",
    "6fedd8db6adb0e102fc0f69b9e1501d2edaf25940e34910831cab46f9f5d4e4d": "MPL-2.0",
}


#: Known texts that are few enough to be broadcast: some megabytes of digests.
SHORT = 50_000


def spelled(words):
    for given, kept in SPELLINGS:
        words = F.replace(words, F.lit(given), F.lit(kept))
    return words


def canonical_line(line):
    """form and doubtful: the canonical form of a line, empty for a copyright notice, and whether it may be one."""
    lowered = ascii_lower(line)
    words = spelled(F.regexp_replace(lowered, SEPARATORS, " "))
    like = lambda pattern: F.regexp_like(lowered, F.lit(pattern))
    form = F.when(like(COPYRIGHT) & like(NOTICE), F.lit("")).otherwise(F.trim(words))
    return F.struct(form.alias("form"), (like(COPYRIGHT) & ~like(NOTICE) & ~like(PROSE)).alias("doubtful"))


def canonical_lines(text):
    return F.transform(F.split(text, "\n"), canonical_line)


def whole(lines):
    """The canonical forms of a text: with its doubtful lines, and without them. A spelling may run over two lines."""
    joined = lambda kept: spelled(F.array_join(F.transform(F.filter(lines, kept), lambda line: line["form"]), " "))
    held = joined(lambda line: line["form"] != "")
    return F.array_distinct(F.array(held, joined(lambda line: (line["form"] != "") & ~line["doubtful"])))


def known_digests(spark, known: dict[str, list[str]] = KNOWN) -> DataFrame:
    rows = [(name, text) for name, texts in known.items() for text in texts]
    forms = F.explode(whole(canonical_lines(F.col("text")))).alias("form")
    frame = spark.createDataFrame(rows, "licence string, text string").select("licence", forms).where("form <> ''")
    frame = frame.select("licence", F.sha2("form", 256).alias("digest"))
    if known is KNOWN:
        frame = frame.unionByName(spark.createDataFrame([(d, n) for d, n in LONG.items()], "digest string, licence string"))
    return frame.distinct()


def scan(docs: DataFrame, known: dict[str, list[str]] = KNOWN, key: str = "doc_id", text: str = "text") -> DataFrame:
    """key, scope (text or line), licence, units (how many lines), first_line (from 1; 0 for a whole text)."""
    numbered = docs.select(F.col(key).alias("key"), F.monotonically_increasing_id().alias("row"), F.col(text).alias("text"))
    lines = numbered.select("key", "row", canonical_lines(F.col("text")).alias("lines"))
    unit = lambda scope, line, form: F.struct(F.lit(scope).alias("scope"), line.alias("line"), form.alias("form"))
    entire = F.transform(whole(F.col("lines")), lambda form: unit("text", F.lit(0), form))
    each = F.transform("lines", lambda line, i: unit("line", i + 1, line["form"]))
    units = F.filter(F.concat(entire, each), lambda u: u["form"] != "")
    digests = F.transform(
        units, lambda u: F.struct(u["scope"].alias("scope"), u["line"].alias("line"), F.sha2(u["form"], 256).alias("digest"))
    )
    digested = known_digests(docs.sparkSession, known)
    # a list of a caller may be of any length: a short one goes to all tasks, adaptive execution decides about others
    short = sum(map(len, known.values())) <= SHORT
    found = lines.select("key", "row", F.inline(digests)).join(F.broadcast(digested) if short else digested, "digest")
    return (
        found.groupBy("key", "row", "scope", "licence")
        .agg(F.when(F.col("scope") == "text", 1).otherwise(F.count("*")).cast("long").alias("units"), F.min("line").alias("first_line"))
        .select(F.col("key").alias(key), "scope", "licence", "units", "first_line")
    )


def _sql() -> str:
    """The same scan in SQL, whose patterns know no look-ahead: a letter or digit that must not follow is one other character, or the end."""
    notice, prose = (p.replace("(?![0-9])", "(?:[^0-9]|$)").replace("(?![a-z])", "(?:[^a-z]|$)") for p in (NOTICE, PROSE))

    def spelling(words: str) -> str:
        for given, kept in SPELLINGS:
            words = f"replace({words}, '{given}', '{kept}')"
        return words

    def values(rows) -> str:
        return ", ".join("({})".format(", ".join("'" + v.replace("'", "''") + "'" for v in row)) for row in rows)

    lower = "translate(l, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    like = lambda pattern: f"regexp_matches({lower}, '{pattern}')"
    words = spelling(f"regexp_replace({lower}, '{SEPARATORS}', ' ', 'g')")
    form = f"CASE WHEN {like(COPYRIGHT)} AND {like(notice)} THEN '' ELSE trim({words}) END"
    doubtful = f"{like(COPYRIGHT)} AND NOT {like(notice)} AND NOT {like(prose)}"
    lines = f"list_transform(string_split(text, chr(10)), lambda l: {{'form': {form}, 'doubtful': {doubtful}}})"

    def entire(kept: str) -> str:
        return spelling(f"array_to_string(list_transform(list_filter(lines, lambda l: {kept}), lambda l: l.form), ' ')")

    forms = f"list_distinct([{entire("l.form <> ''")}, {entire("l.form <> '' AND NOT l.doubtful")}])"
    listed = [(name, text) for name, texts in LISTED.items() for text in texts]
    listed += [(name, f"{t}\n\n{body}") for name, (titles, bodies) in TEXTS.items() for t in ["", *titles] for body in bodies]
    listed += [(name, f"SPDX-License-Identifier: {name}") for name in NAMES]
    return f"""
WITH names(licence, called) AS (VALUES {values((n, c) for n, called in NAMES.items() for c in called)}),
openings(opening) AS (VALUES {values((o,) for o in OPENINGS)}),
given(licence, text) AS (
  VALUES {values(listed)}
  UNION ALL SELECT licence, opening || ' ' || called || '.' FROM names, openings
),
known_lines AS (SELECT licence, {lines} AS lines FROM given),
known AS (
  SELECT licence, sha256(form) AS digest FROM (SELECT licence, unnest({forms}) AS form FROM known_lines) WHERE form <> ''
  UNION VALUES {values((n, d) for d, n in LONG.items())}
),
split AS (SELECT doc_id, row_number() OVER () AS r, {lines} AS lines FROM documents),
units AS (
  SELECT doc_id, r, 'text' AS scope, 0 AS line, unnest({forms}) AS form FROM split
  UNION ALL
  SELECT doc_id, r, 'line', line, l.form FROM (
    SELECT doc_id, r, unnest(lines) AS l, unnest(range(1, len(lines) + 1)) AS line FROM split)
)
SELECT doc_id, scope, licence, CASE WHEN scope = 'text' THEN 1 ELSE count(*) END AS units, min(line)::INTEGER AS first_line
FROM (SELECT *, sha256(form) AS digest FROM units WHERE form <> '') JOIN known USING (digest) GROUP BY doc_id, r, scope, licence
"""


SQL = _sql()


def op5_licences(spark, sf_dir: str) -> DataFrame:
    return scan(table(spark, sf_dir, "documents"))
