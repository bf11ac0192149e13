"""Licence sentences and rules: spans, order, wrapped lines and what is no sentence."""

import re

from rosterlake.llm import licences as L

MIT = """Permission is hereby granted, free of charge, to any person obtaining a copy
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
LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM,
OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE
SOFTWARE."""
TEXTS = {
    "mit": MIT, "prose": "He was released under the MIT license yesterday.", "line": "No end mark here\nReleased under the MIT License.\nmore",
    "several": "All rights reserved. Licensed under CC BY-NC 4.0.\nThis work is licensed under the GNU General Public License, version 3.",
    "apache": "Licensed under the Apache License, Version 2.0 (the \"License\");\nyou may not use this file except in compliance with the License.\nYou may obtain a copy of the License at\n\n"
              "    http://www.apache.org/licenses/LICENSE-2.0\n\nUnless required by applicable law or agreed to in writing, software\ndistributed under the License is distributed on an \"AS IS\" BASIS,\n"
              "WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.\nSee the License for the specific language governing permissions and\nlimitations under the License.",
    "rest": "See the GNU General Public License for more details.", "none": "nothing", "far": "x " * 200_000 + "\nAll rights reserved.", "empty": "", "null": None,
    "part": "Permission is hereby granted, free of charge.", "twice": "Released into the public domain.\n\nReleased into the public domain."}


def test_texts(spark):
    rows = spark.createDataFrame([(i, t, "x", [1]) for i, t in TEXTS.items()] + [("null", None, "x", [1])], "doc_id string, text string, licences string, sentences array<int>")
    found = L.licence_scan(rows).collect()
    assert len(found) == len(TEXTS) + 1
    names = {r.doc_id: [x.name for x in r.licences] for r in found}
    assert names == {"mit": ["MIT"], "prose": [], "line": ["MIT"], "several": ["All-Rights-Reserved", "CC-BY-NC-4.0", "GPL-3.0-only"], "apache": ["Apache-2.0"], "rest": [],
                     "none": [], "far": ["All-Rights-Reserved"], "empty": [], "null": [], "part": [], "twice": ["Public-Domain", "Public-Domain"]}
    by_id = {r.doc_id: r for r in found}
    assert by_id["rest"].unmatched == ["gpl-details"]
    assert TEXTS["far"][by_id["far"].licences[0].start:by_id["far"].licences[0].end] == "All rights reserved"
    assert MIT[by_id["mit"].licences[0].start:by_id["mit"].licences[0].end] == MIT[:-1] and len(by_id["mit"].sentences) == 4
    assert L.licence_scan(rows.limit(0)).collect() == []


def test_every_sentence_has_an_anchor_and_every_rule_known_sentences():
    assert all(re.search(L.ANCHOR, s) for sentences in L.SENTENCES.values() for s in sentences)
    assert all(i in L.SENTENCES for _, sequence in L.RULES for i in sequence)
    assert len({s for sentences in L.SENTENCES.values() for s in sentences}) == sum(map(len, L.SENTENCES.values()))


def test_bundled_against_lines(spark, bundled):
    """In these texts a licence is a line, or a sentence of one: found by plain comparison."""
    known = {s: i for i, sentences in L.SENTENCES.items() for s in sentences}
    texts = {r.doc_id: r.text or "" for r in bundled("documents").collect()}
    got = {r.doc_id: [x.name for x in r.sentences] for r in L.licence_scan(bundled("documents")).collect()}
    for i, text in texts.items():
        sentences = re.split(r"\n|[.!?;:]+(?=\s|\Z)", text)
        want = [known[n] for s in sentences if (n := " ".join(re.findall(r"[^\W_]+", s.lower()))) in known]
        assert got[i] == want
    assert any(got.values())


def test_wrapped_and_marked_up_texts_pass_the_prefilter(spark):
    """The scan finds what recognised() finds without the prefilter, whatever stands between a sentence's words."""
    gaps = (" ", "\n", "  ", "\t", "\r\n", "\n * ", " **", "_", "\u00a0", "\n# ", "/")
    texts = [gap.join(sentence.split()) for sentences in L.SENTENCES.values() for sentence in sentences for gap in gaps]
    texts += ["All rights\nreserved.", "All rights  reserved.", "This work is in the public\ndomain.", "Released under\nCC BY 4.0.", "Released under **CC BY 4.0**.", "RELEASED UNDER CC BY 4.0"]
    found = {r.doc_id: [(x.name, x.start, x.end) for x in r.sentences] for r in L.licence_scan(spark.createDataFrame(list(enumerate(texts)), "doc_id int, text string")).collect()}
    machine = L._automaton()
    assert all(L.recognised(t, machine) == found[k] for k, t in enumerate(texts))
    assert all(found[k] for k in range(len(texts) - 6, len(texts)))


BSD = """Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:
1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.
2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution.
{}THIS SOFTWARE IS PROVIDED BY {} "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED."""
NAMES = "3. Neither the name of {} nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission.\n"


def test_names_conditions_and_titles():
    machine = L._automaton()

    def licences(text):
        names, rest = L.matched(L.recognised(text, machine), text)
        return [n for n, _, _ in names], rest

    plain = re.sub(r"(?m)^[123][.] ", "", BSD), NAMES[3:]
    for holder in ("the copyright holder", "Example Inc.", "The Regents of the University of Somewhere, U.S.A.,"):
        assert licences(plain[0].format(plain[1].format(holder), holder)) == (["BSD-3-Clause"], [])
        assert licences(plain[0].format("", holder)) == (["BSD-2-Clause"], [])
    # A condition that is not known stands between: no licence, and no other one either.
    assert licences(plain[0].format("Every copy must carry a picture of a cat.\n", "X"))[0] == []
    assert licences(plain[0].format("Thank you for reading.\n", "X"))[0] == ["BSD-2-Clause"]
    assert licences(plain[0].format(plain[1].format("word " * 40), "X"))[0] == []
    for text, name in (("MIT License\n\nCopyright (c) 2020 A", "MIT"), ("SPDX-License-Identifier: MIT", "MIT"), ("# SPDX-License-Identifier: LGPL-3.0-or-later\n", "LGPL-3.0-or-later"),
                       ("Licensed under the MIT License (see LICENSE)", "MIT"), ("Licensed under the Apache-2.0 license.", "Apache-2.0"), ("Licensed under Apache-2.0", "Apache-2.0"),
                       ("Creative Commons Attribution 4.0 International License", "CC-BY-4.0"), ("The Unlicense", "Unlicense"), ("CC0 1.0 Universal", "CC0-1.0"),
                       ("This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, "
                        "You can obtain one at http://mozilla.org/MPL/2.0/.", "MPL-2.0"), ("MIT License\n\n" + MIT, "MIT"),
                       ("This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by "
                        "the Free Software Foundation; either version 2.1 of the License, or (at your option) any later version.", "LGPL-2.1-or-later")):
        assert licences(text)[0] == [name], text
