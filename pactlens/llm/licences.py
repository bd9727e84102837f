"""Licence scan by sentence rules.

Marks before the first word of a line (of comments and lists) go. A text is cut at ``. ! ? ; :`` before a
blank and at lines without a word, and normalised (A-Z lower-cased, every run of other characters than a-z
and 0-9 one space). A sentence is a line of
such a piece or several lines in a row, so a wrapped sentence is found as well as one that stands on a line
of its own. Sentences are looked up word by word in a tree of the known ones: a line whose first word
begins no known sentence costs one lookup, others as many as they agree with. From each line the longest
known sentence counts, unless it ends within one found from an earlier line. A known sentence with an inner
end is one for each of its parts. What is left of a document is the sequence of their identifiers, in order.
Licence rules are ordered lists of identifiers that must follow one another in that sequence; sentences that
are no licence sentences may stand between. The longest rules are tried first, and what a rule has matched
is taken out of the sequence.

One wording has one identifier, also where licences share it; an identifier may have many wordings. The
known sentences and rules are parameters of fixed size that every task gets; nothing is shuffled, and a task
holds one Arrow batch. Time grows with the text and not with the number of known sentences.
Rows: null or empty text has no sentences; a null doc_id is passed on; repeated rows are judged alike.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame

from pactlens.llm import common as c

# Sentences of public licences and the identifiers used here.
SENTENCES = {
    "mit-grant": "Permission is hereby granted, free of charge, to any person obtaining a copy of this"
    " software and associated documentation files (the \"Software\"), to deal in the Software without"
    " restriction, including without limitation the rights to use, copy, modify, merge, publish,"
    " distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the"
    " Software is furnished to do so, subject to the following conditions:",
    "mit0-grant": "Permission is hereby granted, free of charge, to any person obtaining a copy of this"
    " software and associated documentation files (the \"Software\"), to deal in the Software without"
    " restriction, including without limitation the rights to use, copy, modify, merge, publish,"
    " distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the"
    " Software is furnished to do so.",
    "mit-notice": "The above copyright notice and this permission notice shall be included in all copies"
    " or substantial portions of the Software.",
    "mit-warranty": "THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED,"
    " INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE"
    " AND NONINFRINGEMENT.",
    "apache2-header": "Licensed under the Apache License, Version 2.0 (the \"License\");",
    "apache2-use": "you may not use this file except in compliance with the License.",
    "apache2-basis": "Unless required by applicable law or agreed to in writing, software distributed"
    " under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY"
    " KIND, either express or implied.",
    "gpl-warranty": "This program is distributed in the hope that it will be useful, but WITHOUT ANY"
    " WARRANTY;",
    "lgpl-warranty": "This library is distributed in the hope that it will be useful, but WITHOUT ANY"
    " WARRANTY;",
    "bsd-grant": "Redistribution and use in source and binary forms, with or without modification, are"
    " permitted provided that the following conditions are met:",
    "bsd-source": "Redistributions of source code must retain the above copyright notice, this list of"
    " conditions and the following disclaimer.",
    "bsd-binary": "Redistributions in binary form must reproduce the above copyright notice, this list of"
    " conditions and the following disclaimer in the documentation and/or other materials provided with"
    " the distribution.",
    "bsd-advertising": "All advertising materials mentioning features or use of this software must display"
    " the following acknowledgement:",
    "bsd-names": "Neither the name of the copyright holder nor the names of its contributors may be used"
    " to endorse or promote products derived from this software without specific prior written"
    " permission.",
    "isc-grant": "Permission to use, copy, modify, and/or distribute this software for any purpose with or"
    " without fee is hereby granted, provided that the above copyright notice and this permission notice"
    " appear in all copies.",
    "0bsd-grant": "Permission to use, copy, modify, and/or distribute this software for any purpose with or"
    " without fee is hereby granted.",
    "isc-warranty": "THE SOFTWARE IS PROVIDED \"AS IS\" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD"
    " TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS.",
    "mpl2-header": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
    "mpl2-copy": "If a copy of the MPL was not distributed with this file, You can obtain one at"
    " https://mozilla.org/MPL/2.0/.",
    "epl2-header": "This program and the accompanying materials are made available under the terms of the"
    " Eclipse Public License 2.0 which is available at https://www.eclipse.org/legal/epl-2.0/",
    "unlicense-release": "This is free and unencumbered software released into the public domain.",
    "unlicense-grant": "Anyone is free to copy, modify, publish, use, compile, sell, or distribute this"
    " software, either in source code form or as a compiled binary, for any purpose, commercial or"
    " non-commercial, and by any means.",
    "zlib-warranty": "This software is provided 'as-is', without any express or implied warranty.",
    "zlib-liability": "In no event will the authors be held liable for any damages arising from the use of"
    " this software.",
    "zlib-grant": "Permission is granted to anyone to use this software for any purpose, including"
    " commercial applications, and to alter it and redistribute it freely, subject to the following"
    " restrictions:",
    "bsl-grant": "Permission is hereby granted, free of charge, to any person or organization obtaining a"
    " copy of the software and accompanying documentation covered by this license (the \"Software\") to"
    " use, reproduce, display, distribute, execute, and transmit the Software, and to prepare derivative"
    " works of the Software, and to permit third-parties to whom the Software is furnished to do so, all"
    " subject to the following:",
    "cc0-dedication": "To the extent possible under law, the author(s) have dedicated all copyright and"
    " related and neighboring rights to this software to the public domain worldwide.",
    "ofl-header": "This Font Software is licensed under the SIL Open Font License, Version 1.1.",
}
RULES = [
    ("BSD-4-Clause", ["bsd-grant", "bsd-source", "bsd-binary", "bsd-advertising", "bsd-names"]),
    ("BSD-3-Clause", ["bsd-grant", "bsd-source", "bsd-binary", "bsd-names"]),
    ("BSD-2-Clause", ["bsd-grant", "bsd-source", "bsd-binary"]),
    ("MIT", ["mit-grant", "mit-notice", "mit-warranty"]),
    ("MIT-0", ["mit0-grant", "mit-warranty"]),
    ("Apache-2.0", ["apache2-header", "apache2-use", "apache2-basis"]),
    ("ISC", ["isc-grant", "isc-warranty"]),
    ("0BSD", ["0bsd-grant", "isc-warranty"]),
    ("MPL-2.0", ["mpl2-header", "mpl2-copy"]),
    ("EPL-2.0", ["epl2-header"]),
    ("Unlicense", ["unlicense-release", "unlicense-grant"]),
    ("Zlib", ["zlib-warranty", "zlib-liability", "zlib-grant"]),
    ("BSL-1.0", ["bsl-grant"]),
    ("CC0-1.0", ["cc0-dedication"]),
    ("OFL-1.1", ["ofl-header"]),
]
# The GNU licences with a header of their own: identifier, versions, what they call the work, name.
GNU = [
    ("GPL", ["2", "3"], "program", "GNU General Public License", "gpl-warranty"),
    ("LGPL", ["2.1", "3"], "library", "GNU Lesser General Public License", "lgpl-warranty"),
    ("AGPL", ["3"], "program", "GNU Affero General Public License", "gpl-warranty"),
]
# Names by which a text says in one sentence under what it is licensed.
NAMES = {
    "MIT": ["MIT License", "MIT"], "Apache-2.0": ["Apache License, Version 2.0", "Apache License 2.0", "Apache 2.0 License"],
    "BSD-2-Clause": ["BSD 2-Clause License", "2-Clause BSD License"], "ISC": ["ISC License"],
    "BSD-3-Clause": ["BSD 3-Clause License", "3-Clause BSD License"], "BSL-1.0": ["Boost Software License, Version 1.0"],
    "GPL-2.0": ["GNU General Public License, version 2", "GNU General Public License v2.0", "GPLv2"],
    "GPL-3.0": ["GNU General Public License, version 3", "GNU General Public License v3.0", "GPLv3"],
    "LGPL-2.1": ["GNU Lesser General Public License, version 2.1", "LGPLv2.1"],
    "LGPL-3.0": ["GNU Lesser General Public License, version 3", "LGPLv3"],
    "AGPL-3.0": ["GNU Affero General Public License, version 3", "AGPLv3"],
    "MPL-1.1": ["Mozilla Public License, Version 1.1"], "MPL-2.0": ["Mozilla Public License, Version 2.0", "Mozilla Public License 2.0"],
    "EPL-1.0": ["Eclipse Public License 1.0"], "EPL-2.0": ["Eclipse Public License 2.0"],
    "CDDL-1.0": ["Common Development and Distribution License 1.0"], "EUPL-1.2": ["European Union Public Licence 1.2"],
    "Artistic-2.0": ["Artistic License 2.0"], "Zlib": ["zlib License"], "Unlicense": ["Unlicense"], "WTFPL": ["WTFPL"],
    "MS-PL": ["Microsoft Public License"], "PostgreSQL": ["PostgreSQL License"], "Python-2.0": ["Python Software Foundation License"],
    "OFL-1.1": ["SIL Open Font License, Version 1.1"], "ODbL-1.0": ["Open Database License", "Open Database License 1.0"],
    "GFDL-1.3": ["GNU Free Documentation License, Version 1.3"], "CC0-1.0": ["CC0 1.0", "CC0"],
}
CREATIVE = {  # fixed values: the parts of the Creative Commons licences; versions follow
    "BY": "Attribution", "BY-SA": "Attribution-ShareAlike", "BY-NC": "Attribution-NonCommercial", "BY-ND": "Attribution-NoDerivatives",
    "BY-NC-SA": "Attribution-NonCommercial-ShareAlike", "BY-NC-ND": "Attribution-NonCommercial-NoDerivatives",
}
SUBJECTS = ["", "This work is ", "This project is ", "This software is ", "This file is ", "This document is "]
ACTS = ["licensed under ", "released under ", "distributed under ", "made available under "]
ARTICLES = ["", "the ", "a ", "the terms of the "]


def gnu_rules() -> tuple[dict[str, str], list[tuple[str, list[str]]]]:
    """Sentences and rules of the GNU headers: a version alone or with later ones, either punctuation."""
    sentences, rules = {}, []
    for short, versions, work, name, warranty in GNU:
        for version in versions:
            licence = f"{short}-{version if '.' in version else version + '.0'}"
            ends = {"or-later": f"either version {version} of the License, or (at your option) any later version.", "only": f"version {version} of the License."}
            for kind, end in ends.items():
                for i, (colon, comma) in enumerate([(":", ","), (";", ","), (";", ";"), (":", ";")]):
                    key = f"{licence.lower()}-{kind}-{i}"
                    sentences[key] = (
                        f"This {work} is free software{colon} you can redistribute it and/or modify it under the terms of the {name}"
                        f" as published by the Free Software Foundation{comma} {end}"
                    )
                    rules.append((f"{licence}-{kind}", [key, warranty]))
    return sentences, rules


def openings() -> list[str]:
    """How a sentence that names a licence begins."""
    return [s + act + article for s in SUBJECTS for act in ACTS for article in ARTICLES]


def named() -> dict[str, list[str]]:
    """Licence to its names."""
    names = {k: list(v) for k, v in NAMES.items()}
    for short, words in CREATIVE.items():
        for version, kind in (("4.0", "International"), ("3.0", "Unported")):
            names[f"CC-{short}-{version}"] = [f"CC {short} {version}", f"Creative Commons {words} {version} {kind} License"]
    return names


def references() -> dict[str, list[str]]:
    """Licence to the sentences that name it."""
    return {licence: [o + name + "." for name in own for o in openings()] for licence, own in named().items()}


_BLANK_AFTER = rb"(?=[\x20\x09-\x0D])"
_END = re.compile(rb"[.!?;:]" + _BLANK_AFTER)
_MARKS = re.compile(rb"\n[^A-Za-z0-9\n]+")  # of comments and lists
_KEPT = b"abcdefghijklmnopqrstuvwxyz0123456789\n"
_FOLD = bytes(ord(chr(b).lower()) if b < 128 and chr(b).lower().encode() in [bytes([k]) for k in _KEPT] else 32 for b in range(256))
_NAME = b""  # under this key a node of the tree holds its sentence's identifier; no word is empty


def _lines(text: bytes) -> list[bytes]:
    """Normalised lines; one without a word parts sentences."""
    return _END.sub(b"\n\n", _MARKS.sub(b"\n", b"\n" + text)).translate(_FOLD).split(b"\n")


def parts(sentence: str) -> list[str]:
    """A known sentence as a text's sentences, normalised: one that holds an end of sentence is several."""
    lines = [" ".join(x.decode().split()) for x in _lines(sentence.encode())]
    return [x for x in lines if x]


def library() -> tuple[dict[str, str], list[tuple[str, list[str]]]]:
    """Wording to identifier, and licences with the identifiers of all parts of their sentences, longest first."""
    gnu, gnu_ordered = gnu_rules()
    known: dict[str, str] = {}
    of: dict[str, list[str]] = {}
    for name, sentence in {**SENTENCES, **gnu}.items():
        own = parts(sentence)
        of[name] = [known.setdefault(p, name if len(own) == 1 else f"{name}-{i}") for i, p in enumerate(own, 1)]
    rules = [(licence, [i for n in names for i in of[n]]) for licence, names in [*RULES, *gnu_ordered]]
    for licence, sentences in references().items():
        told = f"{licence.lower()}-reference"
        for sentence in sentences:
            (wording,) = parts(sentence)
            if known.setdefault(wording, told) != told:
                raise ValueError(f"{wording!r} names two licences")
        rules.append((licence, [told]))
    unique = list({(licence, tuple(ids)): None for licence, ids in rules})
    return known, [(licence, list(ids)) for licence, ids in sorted(unique, key=lambda r: -len(r[1]))]


def tree(known: dict[str, str]) -> dict:
    """Words of the known sentences as nested dictionaries."""
    root: dict = {}
    for wording, name in known.items():
        node = root
        for word in wording.encode().split():
            node = node.setdefault(word, {})
        node[_NAME] = name
    return root


def _longest(lines: list[bytes], first: int, root: dict, most: int) -> tuple[int, str]:
    """Last line and identifier of the longest known sentence that begins with line ``first``; (-1, "") if none."""
    node, found = root, (-1, "")
    for j in range(first, len(lines)):
        words = lines[j].split(None, most)  # what is longer than any sentence stays in one piece that no node has
        if not words:
            break
        for word in words:
            node = node.get(word)
            if node is None:
                return found
        if _NAME in node:
            found = (j, node[_NAME])
    return found


def identifiers(text: bytes, root: dict, most: int) -> list[str]:
    """Identifiers of the known sentences of a text, in order."""
    lines, names, reach = _lines(text), [], -1
    for i, line in enumerate(lines):
        first = line.split(None, 1)
        if first and first[0] in root:
            last, name = _longest(lines, i, root, most)
            if last > reach:
                names.append(name)
                reach = last
    return names


def _sequence(names: list[str]) -> str:
    """Identifiers with a bar on both sides of each, so that no name is found inside another."""
    return "".join(f"|{n}|" for n in names)


def _matched(names: list[str], rules: list[tuple[str, str]]) -> tuple[list[str], int]:
    """Licences whose rules match, in the order of the rules, and the number of identifiers no rule took."""
    left, found = _sequence(names), []
    for licence, ids in rules if names else ():
        if ids in left:
            left = left.replace(ids, "")
            if licence not in found:
                found.append(licence)
    return found, left.count("|") // 2


def scan(
    docs: DataFrame, known: dict[str, str] | None = None, rules: list[tuple[str, list[str]]] | None = None
) -> DataFrame:
    """One row per document: doc_id, n_licence_sentences, identifiers (comma-separated, in order),
    licences (comma-separated, in the order of the rules), n_unmatched identifiers.

    ``known`` (normalised wording to identifier) and ``rules`` (licence, identifiers) default to ``library()``.
    """
    own = library()
    known, rules = known or own[0], rules or own[1]
    most = max(len(w.split()) for w in known)
    ordered = [(licence, _sequence(ids)) for licence, ids in sorted(rules, key=lambda r: -len(r[1]))]
    rows = c.prepared(c.pick(docs, "doc_id", "text"))
    sent = docs.sparkSession.sparkContext.broadcast((tree(known), ordered))

    @c.returning
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        root, by_length = sent.value
        for batch in batches:
            raw, offsets = c.buffers(batch.column("text"))
            out: list[tuple[int, str, str, int]] = []
            for _, _, piece, at in c.slices(raw, offsets):
                data, ends = piece.tobytes(), at.tolist()
                for a, b in zip(ends[:-1], ends[1:], strict=True):
                    names = identifiers(data[a:b], root, most)
                    found, left = _matched(names, by_length)
                    out.append((len(names), ",".join(names), ",".join(found), left))
            columns = list(zip(*out, strict=True)) or [()] * 4
            kinds = (pa.int64(), pa.string(), pa.string(), pa.int64())
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), *[pa.array(x, k) for x, k in zip(columns, kinds, strict=True)]],
                names=["doc_id", "n_licence_sentences", "identifiers", "licences", "n_unmatched"],
            )

    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(
        work, f"doc_id {kind}, n_licence_sentences long, identifiers string, licences string, n_unmatched long"
    )


def oracle_sql() -> str:
    """The same rule in DuckDB, wrapped sentences included."""
    known, rules = library()
    quote = lambda s: "'" + s.replace("'", "''") + "'"
    most = max(len(w.split()) for w in known)
    told = {f"{licence.lower()}-reference" for licence in named()}
    values = ", ".join(f"({quote(k)}, {quote(v)})" for k, v in known.items() if v not in told)
    opened = ", ".join(f"({quote(parts(o)[0])})" for o in openings())
    names = ", ".join(f"({quote(parts(n)[0])}, {quote(k.lower() + '-reference')})" for k, own in named().items() for n in own)
    ordered = ", ".join(f"({quote(n)}, {quote(_sequence(ids))}, {i})" for i, (n, ids) in enumerate(rules))
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    return f"""
        WITH RECURSIVE openings(opening) AS (VALUES {opened}),
        named(licence, name) AS (VALUES {names}),
        known(sentence, name) AS (
            VALUES {values}
            UNION
            SELECT opening || ' ' || licence, name FROM openings, named
        ),
        rules(licence, ids, step) AS (VALUES {ordered}),
        texts AS (
            SELECT row_number() OVER () AS r, doc_id,
                   [trim(regexp_replace(x, '[^a-z0-9]+', ' ', 'g')) FOR x IN
                       string_split(regexp_replace(regexp_replace(chr(10) || translate(coalesce(text, ''), '{upper}', '{upper.lower()}'),
                                                   '\\n[^a-z0-9\\n]+', chr(10), 'g'),
                                    '[.!?;:]([\\x20\\x09-\\x0D])', chr(10) || chr(10) || '\\1', 'g'), chr(10))] AS lines
            FROM documents
        ),
        opened AS (
            SELECT r, lines, i FROM (SELECT r, lines, unnest(range(1, len(lines) + 1)) AS i FROM texts)
            WHERE lines[i] <> '' AND split_part(lines[i], ' ', 1) IN (SELECT split_part(sentence, ' ', 1) FROM known)
              AND EXISTS (FROM known WHERE starts_with(sentence || ' ', lines[i] || ' '))
        ),
        runs AS (
            SELECT r, i, j, array_to_string(lines[i:j], ' ') AS sentence
            FROM (SELECT r, lines, i, unnest(range(i, least(i + {most}, len(lines) + 1))) AS j FROM opened)
        ),
        longest AS (SELECT r, i, max(j) AS j, max_by(name, j) AS name FROM runs JOIN known USING (sentence) GROUP BY r, i),
        hits AS (
            SELECT * FROM longest
            QUALIFY j > coalesce(max(j) OVER (PARTITION BY r ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)
        ),
        names AS (SELECT r, list(name ORDER BY i) AS names, string_agg('|' || name || '|', '' ORDER BY i) AS seq FROM hits GROUP BY r),
        tried AS (
            SELECT r, 0 AS step, seq, CAST([] AS VARCHAR[]) AS found FROM names
            UNION ALL
            SELECT r, tried.step + 1, replace(seq, ids, ''),
                   CASE WHEN contains(seq, ids) AND NOT list_contains(found, licence) THEN list_append(found, licence) ELSE found END
            FROM tried JOIN rules ON rules.step = tried.step
        ),
        ended AS (SELECT * FROM tried WHERE step = {len(rules)})
        SELECT doc_id, CAST(coalesce(len(names), 0) AS BIGINT) AS n_licence_sentences,
               coalesce(array_to_string(names, ','), '') AS identifiers,
               coalesce(array_to_string(found, ','), '') AS licences,
               CAST(coalesce((length(seq) - length(replace(seq, '|', ''))) / 2, 0) AS BIGINT) AS n_unmatched
        FROM texts LEFT JOIN (SELECT r, names FROM names) USING (r) LEFT JOIN (SELECT r, seq, found FROM ended) USING (r)
    """
