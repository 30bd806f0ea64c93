"""Licence scan by sentence rules.

A text is split into sentences, each is normalised and looked up among known
licence sentences; the identifiers found, in order of appearance, are matched against ordered
rules (sequences of identifiers). A rule that matches takes its sentences out, so a later and
more general rule doesn't report them again.

Sentences end at ".", "!" or "?" before white space, and at line ends; a line
that goes on in lower case (behind comment signs, if any), or that follows a
line ending in a comma or in a word like "the", goes on the sentence.
Known sentences of LONG characters or more don't fit a line, so they are found
across line ends whatever the next line starts with; a blank line ends them. An SPDX identifier ends its sentence. "<name>" in
such a sentence stands for up to 80 characters. Normalised: lower case, without
comment signs and quotes, white space as one blank, no closing punctuation.

Texts without any of a few words, one of which each known sentence has, are
settled by one search; the words are picked from the known sentences given.

Null and empty texts have no licence. Very long texts are read whole, inside
their own row. A sentence that occurs twice in a row counts once. Repeated rows
are reported each. Without known sentences, rules or rows there are no rows. Other columns are never read.
"""

from __future__ import annotations

import re
from collections import Counter
from functools import lru_cache

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Sentences of licence texts, normalised, by identifier.
TEXTS = {
    "permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the software), to deal in the software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the software, and to permit persons to whom the software is furnished to do so, subject to the following conditions:": "MITperm",
    "the above copyright notice and this permission notice shall be included in all copies or substantial portions of the software": "MITnotice",
    "the software is provided as is, without warranty of any kind, express or implied, including but not limited to the warranties of merchantability, fitness for a particular purpose and noninfringement": "MITwarranty",
    "licensed under the apache license, version 2.0 (the license); you may not use this file except in compliance with the license": "Apache2head",
    "you may obtain a copy of the license at http://www.apache.org/licenses/license-2.0": "Apache2copy",
    "you may obtain a copy of the license at": "Apache2at",
    "http://www.apache.org/licenses/license-2.0": "Apache2url",
    "https://www.apache.org/licenses/license-2.0": "Apache2url",
    "unless required by applicable law or agreed to in writing, software distributed under the license is distributed on an as is basis, without warranties or conditions of any kind, either express or implied": "Apache2warranty",
    "see the license for the specific language governing permissions and limitations under the license": "Apache2details",
    "this program is free software: you can redistribute it and/or modify it under the terms of the gnu general public license as published by the free software foundation, either version 3 of the license, or (at your option) any later version": "GPL3plus",
    "this program is free software; you can redistribute it and/or modify it under the terms of the gnu general public license as published by the free software foundation; either version 2 of the license, or (at your option) any later version": "GPL2plus",
    "this program is free software; you can redistribute it and/or modify it under the terms of the gnu general public license as published by the free software foundation; version 2": "GPL2only",
    "this program is free software: you can redistribute it and/or modify it under the terms of the gnu affero general public license as published by the free software foundation, either version 3 of the license, or (at your option) any later version": "AGPL3plus",
    "this library is free software; you can redistribute it and/or modify it under the terms of the gnu lesser general public license as published by the free software foundation; either version 2.1 of the license, or (at your option) any later version": "LGPL21plus",
    "this library is free software: you can redistribute it and/or modify it under the terms of the gnu lesser general public license as published by the free software foundation, either version 3 of the license, or (at your option) any later version": "LGPL3plus",
    "this program is distributed in the hope that it will be useful, but without any warranty; without even the implied warranty of merchantability or fitness for a particular purpose": "GPLwarranty",
    "this library is distributed in the hope that it will be useful, but without any warranty; without even the implied warranty of merchantability or fitness for a particular purpose": "LGPLwarranty",
    "see the gnu general public license for more details": "GPLdetails",
    "see the gnu affero general public license for more details": "AGPLdetails",
    "see the gnu lesser general public license for more details": "LGPLdetails",
    "redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:": "BSDhead",
    "redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer": "BSDsource",
    "redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution": "BSDbinary",
    "neither the name of <name> nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission": "BSDendorse",
    "permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies": "ISCperm",
    "permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted": "0BSDperm",
    "this source code form is subject to the terms of the mozilla public license, v. 2.0": "MPL2head",
    "to the extent possible under law, <name> has waived all copyright and related or neighboring rights to <name>": "CC0waiver",
    "this is free and unencumbered software released into the public domain": "Unlicensehead",
}
#: Names that references use, by licence and identifier.
NAMES = {
    ("MIT", "MITref"): ["the mit license", "the mit licence", "mit license"],
    ("Apache-2.0", "Apache2ref"): ["the apache license, version 2.0", "the apache license 2.0", "the apache 2.0 license", "apache license 2.0"],
    ("GPL-2.0-only", "GPL2ref"): ["the gnu general public license, version 2", "the gnu gpl v2"],
    ("GPL-3.0-only", "GPL3ref"): ["the gnu general public license, version 3", "the gnu general public license v3.0", "the gnu gpl v3", "gpl-3.0"],
    ("AGPL-3.0-only", "AGPL3ref"): ["the gnu affero general public license, version 3", "the gnu agpl v3"],
    ("LGPL-2.1-only", "LGPL21ref"): ["the gnu lesser general public license, version 2.1", "the gnu lgpl v2.1"],
    ("LGPL-3.0-only", "LGPL3ref"): ["the gnu lesser general public license, version 3", "the gnu lgpl v3"],
    ("MPL-2.0", "MPL2ref"): ["the mozilla public license 2.0", "the mozilla public license, version 2.0"],
    ("BSD-2-Clause", "BSD2ref"): ["the bsd 2-clause license", "the 2-clause bsd license"],
    ("BSD-3-Clause", "BSD3ref"): ["the bsd 3-clause license", "the 3-clause bsd license"],
    ("ISC", "ISCref"): ["the isc license"],
    ("CC-BY-4.0", "CCBY4ref"): ["cc by 4.0", "a creative commons attribution 4.0 international license"],
    ("CC-BY-SA-4.0", "CCBYSA4ref"): ["cc by-sa 4.0", "a creative commons attribution-sharealike 4.0 international license"],
    ("CC-BY-NC-4.0", "CCBYNC4ref"): ["cc by-nc 4.0", "a creative commons attribution-noncommercial 4.0 international license"],
    ("CC0-1.0", "CC0ref"): ["cc0 1.0", "the cc0 1.0 universal license"],
    ("Unlicense", "Unlicenseref"): ["the unlicense"],
}
SUBJECTS = ["", "this is ", "this project is ", "this work is ", "this software is ", "this program is ", "this code is ", "the code is ", "this file is "]
VERBS = ["licensed under ", "released under ", "distributed under "]
#: Known sentences: the licences' texts, references to them by name, and SPDX lines.
SENTENCES = (
    TEXTS
    | {subject + verb + name: ref for (_, ref), names in NAMES.items() for name in names for verb in VERBS for subject in SUBJECTS}
    | {f"spdx-license-identifier: {licence.lower()}": f"SPDX-{licence}" for licence in [*(x for x, _ in NAMES), "GPL-2.0-or-later", "GPL-3.0-or-later", "AGPL-3.0-or-later", "LGPL-2.1-or-later", "LGPL-3.0-or-later", "0BSD"]}
)
#: The rules, in order: the longest sequences of a licence come first.
RULES = [
    ("MIT", ["MITperm", "MITnotice", "MITwarranty"]),
    ("MIT", ["MITperm"]),
    ("Apache-2.0", ["Apache2head", "Apache2at", "Apache2url", "Apache2warranty", "Apache2details"]),
    ("Apache-2.0", ["Apache2head", "Apache2copy", "Apache2warranty", "Apache2details"]),
    ("Apache-2.0", ["Apache2head", "Apache2at", "Apache2url"]),
    ("Apache-2.0", ["Apache2head", "Apache2copy"]),
    ("Apache-2.0", ["Apache2head"]),
    *[(licence, [head, warranty, details]) for licence, head, warranty, details in (
        ("GPL-3.0-or-later", "GPL3plus", "GPLwarranty", "GPLdetails"), ("GPL-2.0-or-later", "GPL2plus", "GPLwarranty", "GPLdetails"), ("GPL-2.0-only", "GPL2only", "GPLwarranty", "GPLdetails"),
        ("AGPL-3.0-or-later", "AGPL3plus", "GPLwarranty", "AGPLdetails"), ("LGPL-2.1-or-later", "LGPL21plus", "LGPLwarranty", "LGPLdetails"), ("LGPL-3.0-or-later", "LGPL3plus", "LGPLwarranty", "LGPLdetails"),
    )],
    *[(licence, [head]) for licence, head in (("GPL-3.0-or-later", "GPL3plus"), ("GPL-2.0-or-later", "GPL2plus"), ("GPL-2.0-only", "GPL2only"), ("AGPL-3.0-or-later", "AGPL3plus"), ("LGPL-2.1-or-later", "LGPL21plus"), ("LGPL-3.0-or-later", "LGPL3plus"))],
    ("BSD-3-Clause", ["BSDhead", "BSDsource", "BSDbinary", "BSDendorse"]),
    ("BSD-2-Clause", ["BSDhead", "BSDsource", "BSDbinary"]),
    ("ISC", ["ISCperm", "MITwarranty"]),
    ("ISC", ["ISCperm"]),
    ("0BSD", ["0BSDperm"]),
    ("MPL-2.0", ["MPL2head"]),
    ("CC0-1.0", ["CC0waiver"]),
    ("Unlicense", ["Unlicensehead"]),
    *[(licence, [ref]) for licence, ref in NAMES],
    *[(ref.removeprefix("SPDX-"), [ref]) for ref in SENTENCES.values() if ref.startswith("SPDX-")],
]
_SKIP = r"[ \t]*\r?\n[ \t*#/;%>-]*"
_GOES_ON = rf"{_SKIP}(?=[a-z(])|(?<=,|\b(?:a|of|or|and|the|under))(?:[ \t]*\r?\n[ \t*#/;%>-]*)(?=\S)"
_ENDS = r"(?<=[.!?])\s+|\r?\n"
_SIGNS = r"^[\s*#/;%>-]+|[\"'`“”]"
_CLOSING = r"[\s.!?]+$"
LONG = 80
_QUOTES = "[\"'`“”]*"
_GAP = rf"(?:[ \t]+|{_SKIP})"
#: An SPDX line ends where its identifier does, whatever the next line starts with.
_SPDX = r"(?i)(spdx-license-identifier:[ \t]*[\w.+-]+)"
_NAME = r"(?s).{1,80}?(?-s)"
#: What a long sentence is replaced by, with its number.
_TOKEN = "@known-licence-sentence-"


def _wrapped(sentence: str) -> str:
    """A pattern of the sentence with its quotes and line ends anywhere between words."""
    words = [_NAME if w == "<name>" else _QUOTES.join(re.escape(x) for x in re.findall(r"\w+|[^\w]", w)) for w in sentence.split()]
    return rf"(?i)(?<!\w){(_QUOTES + _GAP + _QUOTES).join(words)}{_QUOTES}(?!\w)"


def hint(known: dict[str, str]) -> str:
    """A pattern of a few beginnings of words, one of which every known sentence has."""
    return _hint(tuple(known))


@lru_cache(maxsize=8)
def _hint(known: tuple[str, ...]) -> str:
    rest, picked = [s.replace("<name>", " ").lower() for s in known], []
    while rest:
        counts = Counter(w for s in rest for w in {w[:6] for w in re.findall(r"[a-z0-9]+", s)} or {""})
        # the longest beginning, as it is rare in texts; of those the one of most sentences still without one
        best = max(counts, key=lambda w: (len(w), counts[w], w))
        picked.append(best)
        rest = [s for s in rest if best not in s]
    return "(?i)" + "|".join(_QUOTES.join(w) for w in sorted(picked))


def _long(known: dict[str, str]) -> list[str]:
    return sorted((s for s in known if len(s) >= LONG), key=lambda s: (-len(s), s))


def sentences(text: Column, known: dict[str, str] | None = None) -> Column:
    """Normalised sentences of a text, in order; a long known one as its token."""
    known = SENTENCES if known is None else known
    unwrapped = F.regexp_replace(text, _SPDX, "$1. ")
    for k, s in enumerate(_long(known)):
        unwrapped = F.regexp_replace(unwrapped, _wrapped(s), f". \n{_TOKEN}{k}. \n")
    split = F.split(F.regexp_replace(unwrapped, _GOES_ON, " "), _ENDS)
    # what holds no word of the known sentences needs no normalising
    likely = F.filter(split, lambda s: s.startswith(_TOKEN) | s.rlike(hint(known)))
    return F.transform(likely, lambda s: F.lower(F.regexp_replace(F.regexp_replace(F.regexp_replace(s, _SIGNS, ""), r"\s+", " "), _CLOSING, "")))


def identifiers(text: Column, known: dict[str, str] | None = None) -> Column:
    """Identifiers of the known sentences of a text, in order, without immediate repetitions."""
    known = SENTENCES if known is None else known
    lookup = known | {f"{_TOKEN}{k}": known[s] for k, s in enumerate(_long(known))}
    names = F.create_map(*[F.lit(x) for pair in lookup.items() for x in pair])
    ids = F.filter(F.transform(sentences(text, known), lambda s: F.try_element_at(names, s)), lambda i: i.isNotNull())
    # the empty first entry gives the fold a last element to compare with
    folded = F.aggregate(ids, F.array(F.lit("")), lambda a, i: F.when(F.element_at(a, -1) == i, a).otherwise(F.concat(a, F.array(i))))
    return F.slice(folded, 2, 1_000_000_000)


def recognise(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", known: dict[str, str] | None = None, rules: list[tuple[str, list[str]]] | None = None) -> DataFrame:
    """doc_id, licence, sentences (what the rule matched), n (how often): one row per document and rule that matches."""
    rules, known = RULES if rules is None else rules, SENTENCES if known is None else known
    if not known or not rules:
        return df.select(F.col(id_col).alias("doc_id"), F.lit("").alias("licence"), F.lit("").alias("sentences"), F.lit(0).alias("n")).limit(0)
    hinted = df.where(F.col(text_col).rlike(hint(known))).select(F.col(id_col).alias("doc_id"), identifiers(F.col(text_col), known).alias("ids"))
    sequence = F.concat(F.lit(" "), F.array_join("ids", "  "), F.lit(" "))
    rows = hinted.where(F.size("ids") > 0).select("doc_id", sequence.alias("open"))
    matches = []
    for k, (licence, ids) in enumerate(rules):
        wanted = "  ".join(ids)
        hits = ((F.length(F.col("open")) - F.length(F.replace(F.col("open"), F.lit(f" {wanted} "), F.lit("")))) / (len(wanted) + 2)).cast("int")
        rows = rows.withColumns({f"n{k}": hits, "open": F.replace(F.col("open"), F.lit(f" {wanted} "), F.lit(" | "))})
        matches.append(F.struct(F.lit(licence).alias("licence"), F.lit(" ".join(ids)).alias("sentences"), F.col(f"n{k}").alias("n")))
    return rows.select("doc_id", F.inline(F.filter(F.array(*matches), lambda m: m["n"] > 0)))
