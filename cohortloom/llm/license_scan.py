"""Licence scan by sentence rules (operator 7), in DataFrame functions only.

A text is cut into sentences twice: at line ends and sentence ends, and, for wrapped notices, at
sentence ends alone. Each sentence is normalised (lower case, all but a-z and 0-9 become one space)
and mapped to the letter of a known licence sentence, or to a blank. A text so becomes a short string
of letters, and the ordered rules are an ordered alternation over it: at each place the first rule
that fits wins, and what it covers is used up. All of it happens within a row, without a shuffle.

Hard-wrapped notices are cut a third way (blocks): at sentence ends, at lines without letters or digits
(blank ones, or with a comment sign alone), after the colon of 'conditions:' and 'met:', after ');', and before a
line that starts as a known sentence; not after 'v.'. There, sentences that are not known may stand between the parts of a BSD notice, and
'All rights reserved' before a notice's grant is part of that notice: it does not show Proprietary if no
other 'reserved' of the text does. The SQL of the query has the first two cuts only, and so is equal where a text has no
notice that the third alone finds.

Every known sentence has one of a few words (TRIGGERS), so texts without any of them are not cut at all.

Defined results: a null or empty text has no licence ('' and 0); a null doc_id stays null; repeated rows each give a row; a
very long text is scanned as a whole; ties between rules go to the earlier rule; other columns are ignored; no rows give no
rows.
"""

from __future__ import annotations

import re
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

# Known licence sentences (normalised) by identifier.
SENTENCES: dict[str, str] = {
    "apache-2.0-short": "licensed under the apache license version 2 0",
    "apache-2.0-head": "licensed under the apache license version 2 0 the license",
    "apache-2.0-use": "you may not use this file except in compliance with the license",
    "apache-2.0-copy": "you may obtain a copy of the license at http www apache org licenses license 2 0",
    "apache-2.0-asis": "unless required by applicable law or agreed to in writing software distributed under the license is distributed on an as is basis without warranties or conditions of any kind either express or implied",
    "apache-2.0-see": "see the license for the specific language governing permissions and limitations under the license",
    "mit-short": "released under the mit license",
    "mit-short-2": "licensed under the mit license",
    "mit-head": "mit license",
    "mit-grant": "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files the software to deal in the software without restriction including without limitation the rights to use copy modify merge publish distribute sublicense and or sell copies of the software and to permit persons to whom the software is furnished to do so subject to the following conditions",
    "mit-notice": "the above copyright notice and this permission notice shall be included in all copies or substantial portions of the software",
    "gpl-3.0-short": "this work is licensed under the gnu general public license version 3",
    "gpl-3.0-short-2": "licensed under the gnu general public license version 3",
    "gpl-free": "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation either version 3 of the license or at your option any later version",
    "gpl-free-2": "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation either version 2 of the license or at your option any later version",
    "gpl-hope": "this program is distributed in the hope that it will be useful but without any warranty without even the implied warranty of merchantability or fitness for a particular purpose",
    "gpl-see": "see the gnu general public license for more details",
    "cc-by-nc-4.0-short": "licensed under cc by nc 4 0",
    "cc-by-4.0-short": "licensed under cc by 4 0",
    "cc-by-sa-4.0-short": "licensed under cc by sa 4 0",
    "cc0-short": "this work is dedicated to the public domain under cc0 1 0",
    "bsd-grant": "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met",
    "bsd-short": "licensed under the bsd license",
    "bsd-name": "neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission",
    "bsd-source": "redistributions of source code must retain the above copyright notice this list of conditions and the following disclaimer",
    "bsd-binary": "redistributions in binary form must reproduce the above copyright notice this list of conditions and the following disclaimer in the documentation and or other materials provided with the distribution",
    "isc-grant": "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted provided that the above copyright notice and this permission notice appear in all copies",
    "lgpl-free": "this library is free software you can redistribute it and or modify it under the terms of the gnu lesser general public license as published by the free software foundation either version 2 1 of the license or at your option any later version",
    "lgpl-free-3": "this library is free software you can redistribute it and or modify it under the terms of the gnu lesser general public license as published by the free software foundation either version 3 of the license or at your option any later version",
    "agpl-free": "this program is free software you can redistribute it and or modify it under the terms of the gnu affero general public license as published by the free software foundation either version 3 of the license or at your option any later version",
    "gpl-title": "gnu general public license",
    "lgpl-title": "gnu lesser general public license",
    "agpl-title": "gnu affero general public license",
    "gpl-3-date": "version 3 29 june 2007",
    "agpl-3-date": "version 3 19 november 2007",
    "gpl-2-date": "version 2 june 1991",
    "lgpl-2.1-date": "version 2 1 february 1999",
    "apache-title": "apache license",
    "apache-2.0-date": "version 2 0 january 2004",
    "mpl-2.0-title": "mozilla public license version 2 0",
    "epl-2.0": "this program and the accompanying materials are made available under the terms of the eclipse public license 2 0 which is available at https www eclipse org legal epl 2 0",
    "unlicense": "this is free and unencumbered software released into the public domain",
    "mpl-2.0": "this source code form is subject to the terms of the mozilla public license v 2 0",
    "reserved": "all rights reserved",
    "gpl-2-only": "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license version 2 as published by the free software foundation",
    "gpl-2-only-2": "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation version 2",
    "gpl-3-only": "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license version 3 as published by the free software foundation",
    "apache-2.0-asf": "licensed to the apache software foundation asf under one or more contributor license agreements",
    "apache-2.0-asf-use": "the asf licenses this file to you under the apache license version 2 0 the license you may not use this file except in compliance with the license",
    "bsd-go": "use of this source code is governed by a bsd style license that can be found in the license file",
    "mit-go": "use of this source code is governed by an mit style license that can be found in the license file",
    "zlib-asis": "this software is provided as is without any express or implied warranty",
    "zlib-grant": "permission is granted to anyone to use this software for any purpose including commercial applications and to alter it and redistribute it freely subject to the following restrictions",
    "boost": "boost software license version 1 0",
    "boost-short": "distributed under the boost software license version 1 0",
    "cc-by-4.0-long": "licensed under a creative commons attribution 4 0 international license",
    "cc-by-sa-4.0-long": "licensed under a creative commons attribution sharealike 4 0 international license",
    "cc-by-nc-4.0-long": "licensed under a creative commons attribution noncommercial 4 0 international license",
    "cc-by-nd-4.0-long": "licensed under a creative commons attribution noderivatives 4 0 international license",
    "cc-by-nc-sa-4.0-long": "licensed under a creative commons attribution noncommercial sharealike 4 0 international license",
}
# Licences whose tag 'SPDX-License-Identifier: <licence>' is known.
TAGGED = ["MIT", "Apache-2.0", "BSD-2-Clause", "BSD-3-Clause", "GPL-2.0-only", "GPL-2.0-or-later", "GPL-3.0-only", "GPL-3.0-or-later", "LGPL-2.1-only", "LGPL-2.1-or-later", "LGPL-3.0-or-later", "AGPL-3.0-or-later", "MPL-2.0", "ISC", "Zlib", "BSL-1.0", "CC0-1.0", "CC-BY-4.0", "Unlicense", "EPL-2.0"]
SENTENCES |= {f"spdx-{t}": "spdx license identifier " + re.sub("[^a-z0-9]+", " ", t.lower()) for t in TAGGED}
#: A normalised sentence's parts that name a work or its holder, and what stands for all of them: whose name must not be used, what is free
#: software, and what is under a Creative Commons licence.
NAMES = [
    ("^neither the name of .{1,120} nor the names of its contributors may be used", "neither the name of the copyright holder nor the names of its contributors may be used"),
    ("^.{1,80} is free software you can redistribute it", "this is free software you can redistribute it"),
    ("^.{0,80}licensed under (a |the )?creative commons attribution", "licensed under a creative commons attribution"),
]
for _part, _common in NAMES:
    SENTENCES = {k: re.sub(_part, _common, v) for k, v in SENTENCES.items()}
#: Any sentence that begins so is a copyright notice.
NOTICE_PREFIX, NOTICE = "copyright ", "notice"

#: Ordered rules: licence, and the sequence of sentence identifiers that shows it. The first that fits wins.
RULES: list[tuple[str, list[str]]] = [
    ("Apache-2.0", ["apache-2.0-head", "apache-2.0-use", "apache-2.0-copy", "apache-2.0-asis", "apache-2.0-see"]),
    ("MIT", ["mit-head", NOTICE, "mit-grant", "mit-notice"]),
    ("GPL-3.0-or-later", ["gpl-free", "gpl-hope", "gpl-see"]),
    ("GPL-2.0-or-later", ["gpl-free-2", "gpl-hope", "gpl-see"]),
    ("MIT", ["mit-grant", "mit-notice"]),
    ("MIT", ["mit-grant"]),
    ("Apache-2.0", ["apache-2.0-head"]),
    ("Apache-2.0", ["apache-2.0-short"]),
    ("MIT", ["mit-short"]),
    ("MIT", ["mit-short-2"]),
    ("MIT", ["mit-head"]),
    ("GPL-3.0-or-later", ["gpl-free"]),
    ("GPL-2.0-or-later", ["gpl-free-2"]),
    ("GPL-3.0-only", ["gpl-3.0-short"]),
    ("GPL-3.0-only", ["gpl-3.0-short-2"]),
    ("CC-BY-NC-4.0", ["cc-by-nc-4.0-short"]),
    ("CC-BY-4.0", ["cc-by-4.0-short"]),
    ("CC-BY-SA-4.0", ["cc-by-sa-4.0-short"]),
    ("CC0-1.0", ["cc0-short"]),
    ("BSD-3-Clause", ["bsd-grant", "bsd-source", "bsd-binary", "bsd-name"]),
    ("BSD-3-Clause", ["bsd-grant", "bsd-source", "bsd-name"]),
    ("BSD-3-Clause", ["bsd-grant", "bsd-binary", "bsd-name"]),
    ("BSD-3-Clause", ["bsd-grant", "bsd-name"]),
    ("BSD-2-Clause", ["bsd-grant", "bsd-source", "bsd-binary"]),
    ("BSD", ["bsd-grant"]),
    ("BSD", ["bsd-short"]),
    ("MPL-2.0", ["mpl-2.0"]),
    ("MPL-2.0", ["mpl-2.0-title"]),
    ("ISC", ["isc-grant"]),
    ("LGPL-2.1-or-later", ["lgpl-free"]),
    ("LGPL-3.0-or-later", ["lgpl-free-3"]),
    ("AGPL-3.0-or-later", ["agpl-free"]),
    ("GPL-3.0-only", ["gpl-title", "gpl-3-date"]),
    ("GPL-2.0-only", ["gpl-title", "gpl-2-date"]),
    ("LGPL-3.0-only", ["lgpl-title", "gpl-3-date"]),
    ("LGPL-2.1-only", ["lgpl-title", "lgpl-2.1-date"]),
    ("AGPL-3.0-only", ["agpl-title", "agpl-3-date"]),
    ("Apache-2.0", ["apache-title", "apache-2.0-date"]),
    ("EPL-2.0", ["epl-2.0"]),
    ("Unlicense", ["unlicense"]),
    ("GPL-2.0-only", ["gpl-2-only"]),
    ("GPL-2.0-only", ["gpl-2-only-2"]),
    ("GPL-3.0-only", ["gpl-3-only"]),
    ("Apache-2.0", ["apache-2.0-asf-use"]),
    ("Apache-2.0", ["apache-2.0-asf"]),
    ("BSD", ["bsd-go"]),
    ("MIT", ["mit-go"]),
    ("Zlib", ["zlib-grant"]),
    ("BSL-1.0", ["boost"]),
    ("BSL-1.0", ["boost-short"]),
    ("CC-BY-4.0", ["cc-by-4.0-long"]),
    ("CC-BY-SA-4.0", ["cc-by-sa-4.0-long"]),
    ("CC-BY-NC-4.0", ["cc-by-nc-4.0-long"]),
    ("CC-BY-ND-4.0", ["cc-by-nd-4.0-long"]),
    ("CC-BY-NC-SA-4.0", ["cc-by-nc-sa-4.0-long"]),
    *[(t, [f"spdx-{t}"]) for t in TAGGED],
    ("Proprietary", [NOTICE, "reserved"]),
    ("Proprietary", ["reserved"]),
]

#: A letter for each identifier.
_ALPHABET = [chr(c) for first, last in ("AZ", "az", "\u0391\u03a1", "\u03b1\u03c1", "\u0410\u042f") for c in range(ord(first), ord(last) + 1)]
LETTER = {k: _ALPHABET[i] for i, k in enumerate([*SENTENCES, NOTICE])}
#: The rules as strings of letters, and as one ordered alternation.
SEQUENCES: dict[str, str] = {}
for _name, _ids in RULES:
    SEQUENCES.setdefault("".join(LETTER[i] for i in _ids), _name)
PATTERN = "|".join(SEQUENCES)
assert all(c.isalpha() or c == "|" for c in PATTERN)

#: A line starts as a known sentence if these words are its first, whatever signs are between them.
_STARTS = ["mit license", "permission is hereby granted", "the above copyright notice and", "this program is free software", "this program is distributed in", "redistribution and use in source", "licensed under the apache", "unless required by applicable law", "redistributions of source code", "redistributions in binary form", "neither the name of", "permission to use copy", "this library is free software", "this is free and unencumbered", "this program and the accompanying", "this source code form", "all rights reserved", "copyright c", "copyright [0-9]{4}"]
#: Ends of a sentence in the third cut.
BLOCK_END = r"(?i)(?<=[.!?]|conditions:|met:|\);)(?<! v\.)[ \t\r\n\x0B\f]+|\n[^A-Za-z0-9]*\n|\n(?=[^A-Za-z0-9\n]*(?:" + "|".join(x.replace(" ", "[^A-Za-z0-9]+") for x in _STARTS) + r")[^A-Za-z0-9])"
#: 'All rights reserved' that belongs to the notice after it.
ABSORBED = f"{LETTER['reserved']} *(?=[{''.join(LETTER[i] for i in ('bsd-grant', 'mit-grant', 'isc-grant', 'gpl-free', 'gpl-free-2', 'lgpl-free', 'lgpl-free-3', 'agpl-free', 'apache-2.0-head', 'gpl-2-only', 'gpl-2-only-2', 'gpl-3-only', 'bsd-go', 'mit-go', 'zlib-asis', 'zlib-grant'))}])"
#: What stands between a BSD notice's grant and its clauses: numbers, and clauses in other words.
BSD_GAPS = f"(?<=[{''.join(LETTER[i] for i in ('bsd-grant', 'bsd-source', 'bsd-binary'))}]) {{1,12}}(?=[{''.join(LETTER[i] for i in ('bsd-source', 'bsd-binary', 'bsd-name'))}])"
#: Every known sentence has one of these words, so a text without any of them has no known sentence.
TRIGGERS = ["license", "licence", "copyright", "permission", "reserved", "warranty", "redistribution", "domain", "june", "november", "february", "january"]
assert all(any(t in s.split() or t + "d" in s.split() for t in TRIGGERS) or "redistributions" in s for s in [*SENTENCES.values(), NOTICE_PREFIX])

_SPACE = r"[ \t\r\n\x0B\f]+"


def _letters(sentences: Column) -> Column:
    known = F.array(*[F.lit(s) for s in SENTENCES.values()])
    letters = F.lit("".join(LETTER[k] for k in SENTENCES))

    def letter(s: Column) -> Column:
        clean = F.trim(F.regexp_replace(F.lower(s), "[^a-z0-9]+", " "))
        for part, common in NAMES:
            clean = F.regexp_replace(clean, part, common)
        at = F.array_position(known, clean).cast("int")
        return F.when(at > 0, F.substring(letters, at, 1)).when(F.startswith(clean, F.lit(NOTICE_PREFIX)), F.lit(LETTER[NOTICE])).otherwise(F.lit(" "))

    return F.array_join(F.transform(sentences, letter), "")


def scan_licenses(docs: DataFrame) -> DataFrame:
    """doc_id, licences (names in order, with commas between; '' for none), n_matches, n_known."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    ended = r"([.!?])[ \t\r\n\x0B\f]+"
    by_line = F.split(F.regexp_replace(text, ended, "$1\n"), "\n")
    wrapped = F.split(F.regexp_replace(F.regexp_replace(text, _SPACE, " "), "([.!?]) ", "$1\n"), "\n")
    blocks = F.split(text, BLOCK_END)
    lower = F.lower(text)
    docs = docs.select(F.col("doc_id").cast("long"), text.alias("text"), reduce(Column.__or__, [F.contains(lower, F.lit(t)) for t in TRIGGERS]).alias("may_have"))
    cut = lambda sentences: F.when(F.col("may_have"), _letters(sentences)).otherwise(F.lit(""))
    rows = docs.select("doc_id", cut(by_line).alias("lines"), cut(wrapped).alias("wraps"), cut(blocks).alias("blocks"))
    name = F.create_map(*[F.lit(x) for pair in SEQUENCES.items() for x in pair])
    found = lambda c: F.regexp_extract_all(c, F.lit(PATTERN), F.lit(0))
    names = lambda c: F.transform(c, lambda m: name[m])
    whole = F.regexp_replace(F.regexp_replace("blocks", ABSORBED, " "), BSD_GAPS, "")
    rows = rows.withColumns({"in_lines": found(F.col("lines")), "in_wraps": found(F.col("wraps")), "in_blocks": found(whole)})
    licences = F.array_distinct(names(F.concat("in_lines", "in_wraps", "in_blocks")))
    # a copyright line of a notice, and nothing else, looked proprietary; the less specific BSD is the same notice
    part = F.col("blocks").rlike(ABSORBED) & ~F.array_contains(names(F.col("in_blocks")), "Proprietary")
    licences = F.when(part, F.array_remove(licences, "Proprietary")).otherwise(licences)
    clauses = F.arrays_overlap(names(F.col("in_blocks")), F.array(F.lit("BSD-2-Clause"), F.lit("BSD-3-Clause"))) & ~F.array_contains(names(F.col("in_blocks")), "BSD")
    licences = F.array_sort(F.when(clauses, F.array_remove(licences, "BSD")).otherwise(licences))
    return rows.select("doc_id", F.array_join(licences, ",").alias("licences"), F.greatest(F.size("in_lines"), F.size("in_wraps"), F.size("in_blocks")).cast("long").alias("n_matches"), F.length(F.replace("lines", F.lit(" "), F.lit(""))).cast("long").alias("n_known"))


def license_oracle() -> str:
    """The same in DuckDB's SQL."""
    known = "[" + ", ".join(f"'{s}'" for s in SENTENCES.values()) + "]"
    letters = "".join(LETTER[k] for k in SENTENCES)
    names = "map {" + ", ".join(f"'{k}': '{v}'" for k, v in SEQUENCES.items()) + "}"

    def seq(sentences: str) -> str:
        clean = "trim(regexp_replace(lower(s), '[^a-z0-9]+', ' ', 'g'))"
        for part, common in NAMES:
            clean = f"regexp_replace({clean}, '{part}', '{common}')"
        return f"""array_to_string(list_transform(list_transform({sentences}, lambda s: {clean}),
            lambda c: case when coalesce(list_position({known}, c), 0) > 0 then substr('{letters}', cast(list_position({known}, c) as int), 1)
                           when starts_with(c, '{NOTICE_PREFIX}') then '{LETTER[NOTICE]}' else ' ' end), '')"""

    space = r"[ \t\r\n\x0B\f]+"
    lines = rf"string_split(regexp_replace(t, '([.!?]){space}', E'\\1\n', 'g'), chr(10))"
    wraps = rf"string_split(regexp_replace(regexp_replace(t, '{space}', ' ', 'g'), '([.!?]) ', E'\\1\n', 'g'), chr(10))"
    return f"""
    with d as (select doc_id, coalesce(text, '') as t from documents),
    s as (select doc_id, {seq(lines)} as l, {seq(wraps)} as w from d),
    m as (select doc_id, l, regexp_extract_all(l, '{PATTERN}') as a, regexp_extract_all(w, '{PATTERN}') as b from s)
    select doc_id,
           array_to_string(list_sort(list_distinct(list_transform(list_concat(a, b), lambda x: {names}[x]))), ',') as licences,
           cast(greatest(len(a), len(b)) as bigint) as n_matches,
           cast(length(replace(l, ' ', '')) as bigint) as n_known
    from m"""
