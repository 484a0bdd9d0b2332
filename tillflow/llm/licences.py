"""Licences in texts by sentence rules, in DataFrame functions only.

A text is normalised (lower case, comment marks at the beginnings of lines, punctuation and white space squeezed) and
searched for the known licence sentences. A full stop, exclamation or question mark before white space ends a sentence. The
end of a line and a semicolon may begin or end one as well, or stand inside: licences are wrapped, references are not. Of two
known sentences that begin at the same place the longer one counts. The identifiers found, in the order of the text, form a sequence in which the licence rules are
looked for in their order; a rule takes the identifiers it matches and leaves a mark in their place, so that what stood around
them does not become a sequence, and a longer rule stands before one that is part of it. Identifiers that no rule takes are
reported as well.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Sentences of public licences and notices, normalised.
SENTENCES: dict[str, str] = {
    "released under the mit license": "mit-ref",
    "licensed under the mit license": "mit-ref",
    "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files the software to deal in the software without restriction including without limitation the rights to use copy modify merge publish distribute sublicense and or sell copies of the software and to permit persons to whom the software is furnished to do so subject to the following conditions": "mit-grant",
    "the above copyright notice and this permission notice shall be included in all copies or substantial portions of the software": "mit-notice",
    "the software is provided as is without warranty of any kind express or implied including but not limited to the warranties of merchantability fitness for a particular purpose and noninfringement": "mit-warranty",
    "licensed under the apache license version 2.0": "apache2-ref",
    "licensed under the apache license version 2.0 the license": "apache2-grant",
    "you may not use this file except in compliance with the license": "apache2-terms",
    "you may obtain a copy of the license at http www.apache.org licenses license 2.0": "apache2-copy",
    "this work is licensed under the gnu general public license version 3": "gpl3-ref",
    "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation either version 3 of the license or at your option any later version": "gpl3-grant",
    "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation either version 2 of the license or at your option any later version": "gpl2-grant",
    "you should have received a copy of the gnu general public license along with this program": "gpl-copy",
    "licensed under cc by nc 4.0": "cc-by-nc4-ref",
    "licensed under cc by 4.0": "cc-by4-ref",
    "licensed under cc by sa 4.0": "cc-by-sa4-ref",
    "this work is licensed under a creative commons attribution 4.0 international license": "cc-by4-ref",
    "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met": "bsd-grant",
    "redistributions of source code must retain the above copyright notice this list of conditions and the following disclaimer": "bsd-source",
    "redistributions in binary form must reproduce the above copyright notice this list of conditions and the following disclaimer in the documentation and or other materials provided with the distribution": "bsd-binary",
    "neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission": "bsd-names",
    "this library is free software you can redistribute it and or modify it under the terms of the gnu lesser general public license as published by the free software foundation either version 2.1 of the license or at your option any later version": "lgpl21-grant",
    "this library is free software you can redistribute it and or modify it under the terms of the gnu lesser general public license as published by the free software foundation either version 3 of the license or at your option any later version": "lgpl3-grant",
    "you should have received a copy of the gnu lesser general public license along with this library": "lgpl-copy",
    "this program is free software you can redistribute it and or modify it under the terms of the gnu affero general public license as published by the free software foundation either version 3 of the license or at your option any later version": "agpl3-grant",
    "you should have received a copy of the gnu affero general public license along with this program": "agpl-copy",
    "this source code form is subject to the terms of the mozilla public license v": "mpl2-terms",
    "if a copy of the mpl was not distributed with this file you can obtain one at http mozilla.org mpl 2.0": "mpl2-copy",
    "if a copy of the mpl was not distributed with this file you can obtain one at https mozilla.org mpl 2.0": "mpl2-copy",
    "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted provided that the above copyright notice and this permission notice appear in all copies": "isc-grant",
    "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted": "0bsd-grant",
    "this is free and unencumbered software released into the public domain": "unlicense-grant",
    "this software is provided as is without any express or implied warranty": "zlib-warranty",
    "permission is granted to anyone to use this software for any purpose including commercial applications and to alter it and redistribute it freely subject to the following restrictions": "zlib-grant",
    "permission is hereby granted free of charge to any person or organization obtaining a copy of the software and accompanying documentation covered by this license the software to use reproduce display distribute execute and transmit the software and to prepare derivative works of the software and to permit third parties to whom the software is furnished to do so all subject to the following": "boost-grant",
    "to the extent possible under law the person who associated cc0 with this work has waived all copyright and related or neighboring rights to this work": "cc0-waiver",
    "all rights reserved": "all-rights",
}

# Identifiers of licences as `SPDX-License-Identifier` gives them, and how a reference names some of them.
SPDX = (
    "0BSD AGPL-3.0-only AGPL-3.0-or-later Apache-2.0 Artistic-2.0 BSD-2-Clause BSD-3-Clause BSL-1.0 CC-BY-4.0 CC-BY-NC-4.0 "
    "CC-BY-SA-4.0 CC0-1.0 CDDL-1.0 EPL-2.0 EUPL-1.2 GPL-2.0-only GPL-2.0-or-later GPL-3.0-only GPL-3.0-or-later ISC "
    "LGPL-2.1-only LGPL-2.1-or-later LGPL-3.0-only LGPL-3.0-or-later MIT MIT-0 MPL-2.0 OFL-1.1 PostgreSQL Python-2.0 UPL-1.0 "
    "Unlicense WTFPL Zlib"
).split()
NAMES = {
    "AGPL-3.0": ("gnu affero general public license version 3", "gnu affero general public license v3.0"),
    "Apache-2.0": ("apache license version 2.0", "apache license 2.0", "apache 2.0 license"),
    "Artistic-2.0": ("artistic license 2.0",),
    "BSD-2-Clause": ("bsd 2 clause license", "simplified bsd license"),
    "BSD-3-Clause": ("bsd 3 clause license", "new bsd license", "modified bsd license"),
    "BSL-1.0": ("boost software license version 1.0",),
    "CDDL-1.0": ("common development and distribution license version 1.0",),
    "EPL-2.0": ("eclipse public license version 2.0", "eclipse public license 2.0"),
    "EUPL-1.2": ("european union public licence version 1.2",),
    "GPL-2.0": ("gnu general public license version 2", "gnu general public license v2.0"),
    "GPL-3.0": ("gnu general public license version 3", "gnu general public license v3.0"),
    "ISC": ("isc license",),
    "LGPL-2.1": ("gnu lesser general public license version 2.1", "gnu lesser general public license v2.1"),
    "LGPL-3.0": ("gnu lesser general public license version 3", "gnu lesser general public license v3.0"),
    "MIT": ("mit license",),
    "MPL-2.0": ("mozilla public license version 2.0", "mozilla public license 2.0"),
    "OFL-1.1": ("sil open font license version 1.1",),
    "PostgreSQL": ("postgresql license",),
    "UPL-1.0": ("universal permissive license version 1.0",),
    "Zlib": ("zlib license",),
}
SUBJECTS = ("", "this project is ", "this software is ", "this work is ", "this file is ")
VERBS = ("licensed", "released", "distributed")


def _references() -> dict[str, str]:
    """Sentences that name a licence, by rule: its SPDX line, and what is licensed, released or distributed under it."""
    spdx = {"spdx license identifier " + name.lower().replace("-", " "): f"spdx-{name.lower()}" for name in SPDX}
    return spdx | {
        f"{subject}{verb} under the {spoken}": f"ref-{name.lower()}"
        for name, all_spoken in NAMES.items() for spoken in all_spoken for subject in SUBJECTS for verb in VERBS
    }


SENTENCES = _references() | SENTENCES

# Licences by the sentences that make them up, the most specific rule first.
RULES: tuple[tuple[str, tuple[str, ...]], ...] = (
    ("MIT", ("mit-grant", "mit-notice", "mit-warranty")),
    ("MIT", ("mit-grant", "mit-notice")),
    ("Apache-2.0", ("apache2-grant", "apache2-terms", "apache2-copy")),
    ("Apache-2.0", ("apache2-grant", "apache2-terms")),
    ("GPL-3.0-or-later", ("gpl3-grant", "gpl-copy")),
    ("GPL-3.0-or-later", ("gpl3-grant",)),
    ("GPL-2.0-or-later", ("gpl2-grant", "gpl-copy")),
    ("GPL-2.0-or-later", ("gpl2-grant",)),
    ("BSD-3-Clause", ("bsd-grant", "bsd-source", "bsd-binary", "bsd-names")),
    ("BSD-2-Clause", ("bsd-grant", "bsd-source", "bsd-binary")),
    ("LGPL-2.1-or-later", ("lgpl21-grant", "lgpl-copy")),
    ("LGPL-2.1-or-later", ("lgpl21-grant",)),
    ("LGPL-3.0-or-later", ("lgpl3-grant", "lgpl-copy")),
    ("LGPL-3.0-or-later", ("lgpl3-grant",)),
    ("AGPL-3.0-or-later", ("agpl3-grant", "agpl-copy")),
    ("AGPL-3.0-or-later", ("agpl3-grant",)),
    ("MPL-2.0", ("mpl2-terms", "mpl2-copy")),
    ("MPL-2.0", ("mpl2-terms",)),
    ("Zlib", ("zlib-warranty", "zlib-grant")),
    ("ISC", ("isc-grant",)),
    ("0BSD", ("0bsd-grant",)),
    ("BSL-1.0", ("boost-grant",)),
    ("Unlicense", ("unlicense-grant",)),
    ("CC0-1.0", ("cc0-waiver",)),
    ("MIT", ("mit-ref",)),
    ("Apache-2.0", ("apache2-ref",)),
    ("GPL-3.0", ("gpl3-ref",)),
    ("CC-BY-NC-4.0", ("cc-by-nc4-ref",)),
    ("CC-BY-SA-4.0", ("cc-by-sa4-ref",)),
    ("CC-BY-4.0", ("cc-by4-ref",)),
    *((name, (f"spdx-{name.lower()}",)) for name in SPDX),
    *((name, (f"ref-{name.lower()}",)) for name in NAMES),
)

#: Every known sentence holds one of these words, so texts without any need no further look.
TRIGGER = "(?i)licen[sc]e|permission|copyright|warranty|software|redistribution|reserved|mozilla"
#: Sentences of one line, as the oracle SQL cuts them.
SENTENCE_END = r"[.!?;]+(?:[ \t\n\r\f]|$)|\n"
NOT_NORMAL = "[^a-z0-9.]+"

#: A bar is put where a sentence must end, a tilde where it may. No match is tried from the middle of a run.
_STEPS = (
    ("[|~]", " "),
    (r"(?m)^[ \t]*+(?:\.\\\"|(?:dnl|rem)(?=[ \t])|[#*/;%!<>'\"-]++)", ""),
    (r"(?<![.!?;]);++(?:[ \t\n\r\f]|$)", " ~ "),
    (r"(?<![.!?;])[.!?;]++(?:[ \t\n\r\f]|$)", " | "),
    (r"[\n\r\f]", "~"),
    ("(?<![^a-z0-9.|])[^a-z0-9.|~]*+~[^a-z0-9.|]*+", " ~ "),
    ("[^a-z0-9.|~]+", " "),
)


def _worded(sentences: list[list[str]]) -> str:
    """An expression for sequences of words, common beginnings written once; of two that fit the longer one is taken."""
    by_first: dict[str, list[list[str]]] = {}
    for first, *rest in sentences:
        by_first.setdefault(first, []).append(rest)
    parts = []
    for word, rests in by_first.items():
        more = [rest for rest in rests if rest]
        tail = f"(?: ~)? {_worded(more)}" if more else ""
        parts.append(re.escape(word) + (f"(?:{tail})?" if len(more) < len(rests) and more else tail))
    return parts[0] if len(parts) == 1 else f"(?:{'|'.join(parts)})"


_KNOWN = f"(?<=[|~] ){_worded([s.split(' ') for s in SENTENCES])}(?= [|~])"
#: Left in the place of what a rule took.
TAKEN = "|"


def sequence(ids: tuple[str, ...]) -> str:
    return "".join(f"<{name}>" for name in ids)


def identifiers(text: Column) -> Column:
    """Identifiers of the known sentences of a text, in order."""
    known = F.create_map(*[F.lit(x) for pair in SENTENCES.items() for x in pair])
    normal = F.lower(text)
    for pattern, mark in _STEPS[:-2]:
        normal = F.regexp_replace(normal, pattern, mark)
    normal = F.concat(F.lit("| "), normal, F.lit(" |"))
    for pattern, mark in _STEPS[-2:]:
        normal = F.regexp_replace(normal, pattern, mark)
    found = F.regexp_extract_all(normal, F.lit(_KNOWN), F.lit(0))
    found = F.transform(found, lambda s: F.try_element_at(known, F.replace(s, F.lit(" ~"), F.lit(""))))
    return F.when(F.rlike(text, F.lit(TRIGGER)), found).otherwise(F.array().cast("array<string>"))


def scan(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with ``sentences`` (identifiers in order), ``licences`` (sorted, each once) and ``unmatched``.

    ``unmatched`` is the sequence of the identifiers that no rule took, written ``<a><b>``. A null or empty text has none of
    the three. Other columns are kept; columns with the added names are replaced. Rows are independent.
    """
    found = docs.withColumn("sentences", identifiers(F.coalesce(F.col(text), F.lit(""))))
    start = F.struct(F.concat_ws("", F.transform("sentences", lambda x: F.concat(F.lit("<"), x, F.lit(">")))).alias("left"), F.array().cast("array<string>").alias("found"))
    rules = F.array(*[F.struct(F.lit(name).alias("name"), F.lit(sequence(ids)).alias("ids")) for name, ids in RULES])

    def step(state: Column, rule: Column) -> Column:
        named = F.concat(state["found"], F.array(rule["name"]))
        taken = F.struct(F.replace(state["left"], rule["ids"], F.lit(TAKEN)).alias("left"), named.alias("found"))
        return F.when(F.contains(state["left"], rule["ids"]), taken).otherwise(state)

    matched = F.when(F.size("sentences") > 0, F.aggregate(rules, start, step)).otherwise(start)
    found = found.withColumn("_m", matched)
    return found.withColumn("licences", F.array_sort(F.array_distinct("_m.found"))).withColumn("unmatched", F.replace(F.col("_m.left"), F.lit(TAKEN), F.lit(""))).drop("_m")
