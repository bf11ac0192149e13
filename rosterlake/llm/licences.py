"""Licence scan: sentences to identifiers, identifier sequences to ordered licence rules.

A text is cut into units at line ends and at sentence ends. A known sentence, as words in
lower case without punctuation, has to fill units from the start of one to the end of one;
so a sentence may run over several lines, but a mention within a sentence is none. The
identifiers of a text, in order, are then read from the left: the first rule of the list
whose sequence follows names a licence and takes its sentences, unless a sentence between
them is not known and sets a condition; an identifier that starts no rule stays as unmatched.
A sentence may leave a place for a name.

Defined results: a null or empty text has no licence; texts of any length are read whole;
of known sentences that start together the longest counts; repeated rows are scanned each;
other columns are ignored; no rows give none.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

# Sentences of well-known licences and notices, and their identifiers.
SENTENCES = {
    "mit-grant": ["permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files the software to deal in the software without restriction including without limitation the rights to use copy modify merge publish distribute sublicense and or sell copies of the software and to permit persons to whom the software is furnished to do so subject to the following conditions"],
    "mit-notice-kept": ["the above copyright notice and this permission notice shall be included in all copies or substantial portions of the software"],
    "mit-warranty": ["the software is provided as is without warranty of any kind express or implied including but not limited to the warranties of merchantability fitness for a particular purpose and noninfringement"],
    "mit-liability": ["in no event shall the authors or copyright holders be liable for any claim damages or other liability whether in an action of contract tort or otherwise arising from out of or in connection with the software or the use or other dealings in the software"],
    "mit-named": ["released under the mit license", "licensed under the mit license", "this project is licensed under the mit license", "this work is licensed under the mit license"],
    "apache-2-named": ["licensed under the apache license version 2 0", "licensed under the apache license version 2 0 the license", "released under the apache license version 2 0", "this work is licensed under the apache license version 2 0"],
    "apache-2-comply": ["you may not use this file except in compliance with the license"],
    "apache-2-obtain": ["you may obtain a copy of the license at http www apache org licenses license 2 0", "you may obtain a copy of the license at https www apache org licenses license 2 0"],
    "apache-2-basis": ["unless required by applicable law or agreed to in writing software distributed under the license is distributed on an as is basis without warranties or conditions of any kind either express or implied"],
    "apache-2-see": ["see the license for the specific language governing permissions and limitations under the license"],
    "bsd-grant": ["redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met"],
    "bsd-source": ["redistributions of source code must retain the above copyright notice this list of conditions and the following disclaimer"],
    "bsd-binary": ["redistributions in binary form must reproduce the above copyright notice this list of conditions and the following disclaimer in the documentation and or other materials provided with the distribution"],
    "bsd-names": ["neither the name of * nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission",
                  "neither the names of * nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission",
                  "the name of * may not be used to endorse or promote products derived from this software without specific prior written permission"],
    "bsd-warranty": ["this software is provided by * as is and any express or implied warranties including but not limited to the implied warranties of merchantability and fitness for a particular purpose are disclaimed"],
    "gpl-2-or-later": ["this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation either version 2 of the license or at your option any later version"],
    "gpl-3-or-later": ["this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation either version 3 of the license or at your option any later version"],
    "gpl-2-named": ["this work is licensed under the gnu general public license version 2", "licensed under the gnu general public license version 2", "released under the gnu general public license version 2"],
    "gpl-3-named": ["this work is licensed under the gnu general public license version 3", "licensed under the gnu general public license version 3", "released under the gnu general public license version 3"],
    "gpl-hope": ["this program is distributed in the hope that it will be useful but without any warranty without even the implied warranty of merchantability or fitness for a particular purpose"],
    "gpl-received": ["you should have received a copy of the gnu general public license along with this program"],
    "gpl-details": ["see the gnu general public license for more details"],
    "lgpl-2.1-or-later": ["this library is free software you can redistribute it and or modify it under the terms of the gnu lesser general public license as published by the free software foundation either version 2 1 of the license or at your option any later version"],
    "lgpl-3-or-later": ["this library is free software you can redistribute it and or modify it under the terms of the gnu lesser general public license as published by the free software foundation either version 3 of the license or at your option any later version"],
    "agpl-3-or-later": ["this program is free software you can redistribute it and or modify it under the terms of the gnu affero general public license as published by the free software foundation either version 3 of the license or at your option any later version"],
    "mpl-2": ["this source code form is subject to the terms of the mozilla public license v 2 0"],
    "mpl-2-obtain": ["if a copy of the mpl was not distributed with this file you can obtain one at http mozilla org mpl 2 0", "if a copy of the mpl was not distributed with this file you can obtain one at https mozilla org mpl 2 0"],
    "isc-grant": ["permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted provided that the above copyright notice and this permission notice appear in all copies"],
    "isc-warranty": ["the software is provided as is and the author disclaims all warranties with regard to this software including all implied warranties of merchantability and fitness"],
    "unlicense": ["this is free and unencumbered software released into the public domain"],
    "zlib-warranty": ["this software is provided as is without any express or implied warranty"],
    "zlib-grant": ["permission is granted to anyone to use this software for any purpose including commercial applications and to alter it and redistribute it freely subject to the following restrictions"],
    "public-domain": ["this work is in the public domain", "released into the public domain"],
    "all-rights": ["all rights reserved"],
}
CC_TERMS = ("by", "by sa", "by nc", "by nd", "by nc sa", "by nc nd")
CC_VERSIONS = ("3 0", "4 0")
CC_LEADS = ("licensed under", "released under", "this work is licensed under")
SENTENCES |= {f"cc-{t.replace(' ', '-')}-{v.replace(' ', '.')}": [f"{lead} {cc} {t} {v}" for lead in CC_LEADS for cc in ("cc", "creative commons")]
              for t in CC_TERMS for v in CC_VERSIONS}
# Names as notices and titles write them, and as identifier lines do.
NAMED = {
    "MIT": ("mit license",), "Apache-2.0": ("apache license version 2 0", "apache 2 0 license", "apache license 2 0"), "ISC": ("isc license",),
    "BSD-2-Clause": ("bsd 2 clause license",), "BSD-3-Clause": ("bsd 3 clause license",), "MPL-2.0": ("mozilla public license 2 0", "mozilla public license version 2 0"),
    "GPL-2.0-only": ("gnu general public license version 2",), "GPL-3.0-only": ("gnu general public license version 3",),
    "LGPL-2.1-only": ("gnu lesser general public license version 2 1",), "LGPL-3.0-only": ("gnu lesser general public license version 3",),
    "AGPL-3.0-only": ("gnu affero general public license version 3",), "CC0-1.0": ("cc0 1 0 universal", "creative commons zero v1 0 universal"),
    "Unlicense": ("unlicense",), "Zlib": ("zlib license",), "CC-BY-4.0": ("creative commons attribution 4 0 international license",),
    "CC-BY-SA-4.0": ("creative commons attribution sharealike 4 0 international license",)}
SPDX = (*NAMED, "GPL-2.0-or-later", "GPL-3.0-or-later", "LGPL-2.1-or-later", "LGPL-3.0-or-later", "AGPL-3.0-or-later")
_PLAIN = {i: " ".join(re.findall("[a-z0-9]+", i.lower())) for i in SPDX}
LEADS = ("licensed under", "released under", "distributed under", "this work is licensed under", "this project is licensed under")
_known = {sentence for sentences in SENTENCES.values() for sentence in sentences}
SENTENCES |= {f"spdx {i}": [f"spdx license identifier {_PLAIN[i]}"] for i in SPDX}
SENTENCES |= {f"title {i}": [f"{the}{n}" for n in names for the in ("", "the ")] for i, names in NAMED.items()}
SENTENCES |= {f"named {i}": [s for lead in LEADS for n in sorted({*names, _PLAIN[i], f"{_PLAIN[i]} license"}) for the in ("", "the ") if (s := f"{lead} {the}{n}") not in _known] for i, names in NAMED.items()}

# In order: the first whose sequence follows is taken.
RULES: list[tuple[str, tuple[str, ...]]] = [
    ("MIT", ("mit-named", "mit-grant", "mit-notice-kept", "mit-warranty", "mit-liability")),
    ("MIT", ("mit-grant", "mit-notice-kept", "mit-warranty", "mit-liability")),
    ("Apache-2.0", ("apache-2-named", "apache-2-comply", "apache-2-obtain", "apache-2-basis", "apache-2-see")),
    ("BSD-3-Clause", ("bsd-grant", "bsd-source", "bsd-binary", "bsd-names", "bsd-warranty")),
    ("BSD-2-Clause", ("bsd-grant", "bsd-source", "bsd-binary", "bsd-warranty")),
    ("GPL-3.0-or-later", ("gpl-3-or-later", "gpl-hope", "gpl-details", "gpl-received")),
    ("GPL-2.0-or-later", ("gpl-2-or-later", "gpl-hope", "gpl-details", "gpl-received")),
    ("GPL-3.0-or-later", ("gpl-3-or-later",)), ("GPL-2.0-or-later", ("gpl-2-or-later",)),
    ("GPL-3.0-only", ("gpl-3-named",)), ("GPL-2.0-only", ("gpl-2-named",)),
    ("MIT", ("mit-named",)), ("Apache-2.0", ("apache-2-named",)),
    *[(f"CC-{i[3:].upper()}", (i,)) for i in SENTENCES if i.startswith("cc-")],
    ("LGPL-2.1-or-later", ("lgpl-2.1-or-later",)), ("LGPL-3.0-or-later", ("lgpl-3-or-later",)), ("AGPL-3.0-or-later", ("agpl-3-or-later",)),
    ("MPL-2.0", ("mpl-2", "mpl-2-obtain")), ("MPL-2.0", ("mpl-2",)), ("ISC", ("isc-grant", "isc-warranty")), ("Unlicense", ("unlicense",)),
    ("Zlib", ("zlib-warranty", "zlib-grant")),
    *[(i, (f"{kind} {i}",)) for kind, of in (("spdx", SPDX), ("named", NAMED)) for i in of],
    ("Public-Domain", ("public-domain",)), ("All-Rights-Reserved", ("all-rights",)),
]
# A text's title goes with what follows it, or names the licence alone.
RULES = [(name, (f"title {name}", *sequence)) for name, sequence in RULES if name in NAMED] + RULES + [(i, (f"title {i}",)) for i in NAMED]
# Words of a sentence that no rule may pass over: it is a condition that is not known.
CONDITION = re.compile(r"\b(must|shall|may\s+not|neither|endorse|provided\s+that)\b", re.I)
SLOT_WORDS = 24  # that a name in a sentence, written ``*``, may have
# Every known sentence holds one of these, whatever stands between its words; texts without any are not looked at further.
ANCHOR = r"(?i)licen[cs]e|warrant|copyright|reserved|distribut|charge|domain|released|event|universal|permi"
WORD = re.compile(r"[^\W_]+")
UNIT_END = re.compile(r"\n|[.!?;:]+(?=\s|\Z)|\s\(")


def _automaton() -> ahocorasick.Automaton:
    machine = ahocorasick.Automaton()
    for identifier, sentences in SENTENCES.items():
        for sentence in sentences:
            parts = sentence.split(" * ")
            for k, part in enumerate(parts):  # several sentences may have a part in common
                known = machine.get(f" {part} ", ())
                machine.add_word(f" {part} ", (*known, (identifier, part.count(" ") + 1, k if len(parts) > 1 else None)))
    machine.make_automaton()
    return machine


def recognised(text: str, machine: ahocorasick.Automaton) -> list[tuple[str, int, int]]:
    """Identifiers of the known sentences in a text, with the characters they span, in order."""
    spans = [m.span() for m in WORD.finditer(text)]
    if not spans:
        return []
    words = [text[s:e].lower() for s, e in spans]
    ends = {at for at in range(len(spans)) if at == len(spans) - 1 or UNIT_END.search(text[spans[at][1]:spans[at + 1][0]] + text[spans[at + 1][0]])}
    last_at, place = {}, 0  # the joined string's place of the space behind a word: the word's number
    for at, word in enumerate(words):
        place += len(word) + 1
        last_at[place] = at
    found, heads = [], {}
    for place, known in machine.iter(" " + " ".join(words) + " "):
        last = last_at[place]
        for identifier, length, part in known:
            first = last - length + 1
            if part == 0:  # a sentence up to its name
                heads.setdefault(identifier, []).append((first, last))
                continue
            starts = [first] if part is None else [f for f, end in heads.get(identifier, ())[-SLOT_WORDS:] if 0 < first - end - 1 <= SLOT_WORDS]
            found += [(f, -last, identifier) for f in starts if last in ends and (f == 0 or f - 1 in ends)]
    result, free = [], 0
    for first, last, identifier in sorted(found):
        if first >= free:
            result.append((identifier, spans[first][0], spans[-last][1]))
            free = -last + 1
    return result


def matched(sentences: list[tuple[str, int, int]], text: str = "") -> tuple[list[tuple[str, int, int]], list[str]]:
    """Licences with the characters they span, and the identifiers that no rule takes."""
    identifiers, licences, rest, at = [s[0] for s in sentences], [], [], 0
    passes = [not CONDITION.search(text, one[2], other[1]) for one, other in zip(sentences, sentences[1:])]
    while at < len(identifiers):
        for name, sequence in RULES:
            if tuple(identifiers[at:at + len(sequence)]) == sequence and all(passes[at:at + len(sequence) - 1]):
                licences.append((name, sentences[at][1], sentences[at + len(sequence) - 1][2]))
                at += len(sequence)
                break
        else:
            rest.append(identifiers[at])
            at += 1
    return licences, rest


def licence_scan(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """``doc_id, sentences, licences, unmatched`` of every document; the first two with their spans."""
    span = "struct<name:string,start:int,end:int>"
    schema = T.StructType([T.StructField("doc_id", docs.schema[id_column].dataType)])
    for name, kind in (("sentences", f"array<{span}>"), ("licences", f"array<{span}>"), ("unmatched", "array<string>")):
        schema = schema.add(name, T.DataType.fromDDL(kind))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark.sql.pandas.types import to_arrow_schema

        arrow, machine = to_arrow_schema(schema), _automaton()
        for batch in batches:
            sentences = [recognised(t, machine) if t else [] for t in batch.column(1).to_pylist()]
            results = [matched(s, t or "") for s, t in zip(sentences, batch.column(1).to_pylist())]
            named = [[[dict(zip(("name", "start", "end"), x)) for x in row] for row in rows] for rows in (sentences, [r[0] for r in results])]
            yield pa.RecordBatch.from_arrays([batch.column(0), *[pa.array(rows, f.type) for rows, f in zip((*named, [r[1] for r in results]), list(arrow)[1:])]], schema=arrow)

    # Only texts with an anchor travel to Python.
    text = F.when(F.col(f"`{text_column}`").rlike(ANCHOR), F.col(f"`{text_column}`"))
    return docs.select(F.col(f"`{id_column}`").alias("doc_id"), text.alias("text")).mapInArrow(run, schema)
