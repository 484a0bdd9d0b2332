from __future__ import annotations

import re

from helpers import documents, frame

from tillflow.llm import licences

MIT = """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated
documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights
to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to
whom the Software is furnished to do so, subject to the following conditions:""".replace("\n", " ")
NOTICE = "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software."

WRAPPED_MIT = """MIT License

Copyright (c) 2020 Somebody

Permission is hereby granted, free of charge, to any person obtaining a copy
of this software and associated documentation files (the "Software"), to deal
in the Software without restriction, including without limitation the rights
to use, copy, modify, merge, publish, distribute, sublicense, and/or sell
copies of the Software, and to permit persons to whom the Software is
furnished to do so, subject to the following conditions:

The above copyright notice and this permission notice shall be included in all
copies or substantial portions of the Software.

THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR
IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY,
FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE
AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER
LIABILITY."""
WRAPPED_APACHE = """Copyright 2020 Somebody

Licensed under the Apache License, Version 2.0 (the "License");
you may not use this file except in compliance with the License.
You may obtain a copy of the License at

    http://www.apache.org/licenses/LICENSE-2.0

Unless required by applicable law or agreed to in writing, software
distributed under the License is distributed on an "AS IS" BASIS."""
WRAPPED_GPL3 = """This program is free software: you can redistribute it and/or modify
it under the terms of the GNU General Public License as published by
the Free Software Foundation, either version 3 of the License, or
(at your option) any later version.

You should have received a copy of the GNU General Public License
along with this program.  If not, see <https://www.gnu.org/licenses/>."""
WRAPPED_GPL2 = """This program is free software; you can redistribute it and/or modify
it under the terms of the GNU General Public License as published by
the Free Software Foundation; either version 2 of the License, or
(at your option) any later version.

You should have received a copy of the GNU General Public License along
with this program; if not, write to the Free Software Foundation, Inc."""
WRAPPED_BSD = """Redistribution and use in source and binary forms, with or without
modification, are permitted provided that the following conditions are met:

1. Redistributions of source code must retain the above copyright notice, this
   list of conditions and the following disclaimer.

2. Redistributions in binary form must reproduce the above copyright notice,
   this list of conditions and the following disclaimer in the documentation
   and/or other materials provided with the distribution."""
WRAPPED_BSD3 = (
    WRAPPED_BSD
    + """

3. Neither the name of the copyright holder nor the names of its
   contributors may be used to endorse or promote products derived from
   this software without specific prior written permission."""
)
WRAPPED_ISC = """Permission to use, copy, modify, and/or distribute this software for any
purpose with or without fee is hereby granted, provided that the above
copyright notice and this permission notice appear in all copies."""
WRAPPED_MPL = """This Source Code Form is subject to the terms of the Mozilla Public
License, v. 2.0. If a copy of the MPL was not distributed with this
file, You can obtain one at https://mozilla.org/MPL/2.0/."""
WRAPPED_LGPL = """This library is free software; you can redistribute it and/or
modify it under the terms of the GNU Lesser General Public
License as published by the Free Software Foundation; either
version 2.1 of the License, or (at your option) any later version."""
# The texts above are those of public licences and notices, which have to match word for word.
WRAPPED = {
    WRAPPED_BSD3: (["BSD-3-Clause"], ["bsd-grant", "bsd-source", "bsd-binary", "bsd-names"]),
    WRAPPED_ISC: (["ISC"], ["isc-grant"]),
    WRAPPED_MPL: (["MPL-2.0"], ["mpl2-terms", "mpl2-copy"]),
    WRAPPED_LGPL: (["LGPL-2.1-or-later"], ["lgpl21-grant"]),
    WRAPPED_MIT: (["MIT"], ["mit-grant", "mit-notice", "mit-warranty"]),
    WRAPPED_APACHE: (["Apache-2.0"], ["apache2-grant", "apache2-terms", "apache2-copy"]),
    WRAPPED_GPL3: (["GPL-3.0-or-later"], ["gpl3-grant", "gpl-copy"]),
    WRAPPED_GPL2: (["GPL-2.0-or-later"], ["gpl2-grant", "gpl-copy"]),
    WRAPPED_BSD: (["BSD-2-Clause"], ["bsd-grant", "bsd-source", "bsd-binary"]),
}


def scanned(spark, *texts):
    return [r for r in licences.scan(documents(spark, *texts)).orderBy("doc_id").collect()]


def test_reference_lines(spark):
    found = scanned(
        spark,
        "Prose here.\nReleased under the MIT License.\nMore prose.",
        "Licensed under the Apache License, Version 2.0.",
        "This work is licensed under the GNU General Public License, version 3. LICENSED under CC BY-NC 4.0!",
        "A licence to kill.",
    )
    assert [r["licences"] for r in found] == [["MIT"], ["Apache-2.0"], ["CC-BY-NC-4.0", "GPL-3.0"], []]


def test_sequences_in_order(spark):
    found = scanned(spark, f"{MIT}\n\n{NOTICE}", f"{NOTICE} {MIT}", f"{MIT}\n{NOTICE} Released under the MIT license.")
    assert found[0]["sentences"] == ["mit-grant", "mit-notice"] and found[0]["licences"] == ["MIT"] and found[0]["unmatched"] == ""
    assert found[1]["licences"] == [] and found[1]["unmatched"] == "<mit-notice><mit-grant>"
    assert found[2]["licences"] == ["MIT"]


def test_wrapped_licences(spark):
    marks = ["", "# ", " * ", "// ", ";; ", "! ", '.\\" ', "dnl "]
    texts = [(mark, end, text) for text in WRAPPED for mark in marks for end in ("\n", "\r\n")]
    found = scanned(spark, *["".join(mark + line + end for line in text.split("\n")) for mark, end, text in texts])
    for row, (mark, _, text) in zip(found, texts, strict=True):
        assert (row["licences"], row["sentences"], row["unmatched"]) == (*WRAPPED[text], ""), (mark, text)


def test_references_by_rule(spark):
    found = scanned(
        spark,
        "SPDX-License-Identifier: BSD-3-Clause\n// SPDX-License-Identifier: GPL-2.0-only\n",
        "This project is licensed under the Mozilla Public License, version 2.0. Distributed under the Boost Software License, Version 1.0.",
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted.",
        "SPDX-License-Identifier: MIT\nSPDX-License-Identifier: MIT-0\nReleased under the GNU General Public License v3.0",
    )
    assert [r["licences"] for r in found] == [["BSD-3-Clause", "GPL-2.0-only"], ["BSL-1.0", "MPL-2.0"], ["0BSD"], ["GPL-3.0", "MIT", "MIT-0"]]


def test_what_a_rule_takes_leaves_a_gap(spark):
    grant, source, binary = WRAPPED_BSD.replace("\n   ", " ").replace("or without\n", "or without ").split("\n\n")
    row = scanned(spark, "\n\n".join([grant, WRAPPED_GPL3, source, binary]))[0]
    assert (row["licences"], row["unmatched"]) == (["GPL-3.0-or-later"], "<bsd-grant><bsd-source><bsd-binary>")


def test_lines_are_sentences_too_and_words_are_whole(spark):
    found = scanned(
        spark,
        "Released under the\nMIT License\n\nAll rights reserved | ~ Released under the MIT License",
        "Licensed under the Apache License, Version 2.0\nLicensed under CC BY 4.0\nand more\nAll\n" + "\n" * 50_000 + "rights reserved",
        "Not released under the MIT License. Released under. the MIT License\nReleased under the MIT Licenses",
        "software " + "." * 50_000 + ";" * 50_000 + " " * 50_000 + "x" + "\n; " * 50_000 + "All rights reserved",
    )
    assert [r["sentences"] for r in found] == [["mit-ref"], ["apache2-ref", "cc-by4-ref", "all-rights"], [], ["all-rights"]]


def test_known_sentences_are_normal_and_hold_a_trigger():
    for sentence, name in licences.SENTENCES.items():
        assert re.search(licences.TRIGGER, sentence) or name in ("apache2-terms",), sentence
        assert sentence == re.sub("[^a-z0-9.]+", " ", sentence.lower()).strip()
    ids = set(licences.SENTENCES.values())
    assert all(set(rule) <= ids for _, rule in licences.RULES)


def test_nulls_long_texts_and_clashes(spark):
    found = scanned(spark, None, "", "word. " * 50_000 + "Released under the MIT License")
    assert [r["licences"] for r in found] == [[], [], ["MIT"]]
    docs = frame(spark, [(1, "x", "y")], "doc_id bigint, text string, licences string")
    assert licences.scan(docs).columns == ["doc_id", "text", "licences", "sentences", "unmatched"]
    assert licences.scan(docs.limit(0)).collect() == []
    plan = licences.scan(docs)._jdf.queryExecution().toString()
    assert "Python" not in plan.replace("Python-2.0", "")  # the name of a licence
