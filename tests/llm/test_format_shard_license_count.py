"""Operators 2, 5, 7 and 8 against brute force, round trips and the public library."""

import hashlib
import json
import random
import zlib

import public_tokenizers
import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from cohortloom.llm import chat_format, license_scan, sharding, token_count

PIECES = ["###", "#", "</turn>", "</", "\\", "\n", ":", " ", "ok", "é", "### Assistant: ", "\\###"]


@settings(max_examples=300, deadline=None)
@given(st.lists(st.sampled_from(PIECES), max_size=8).map("".join), st.lists(st.sampled_from(PIECES), max_size=4).map("".join))
def test_every_turn_survives_the_round_trip(text, role):
    chunk, start, end, _ = chat_format.round_trip(role, text)
    assert chat_format.parse_turn(chunk) == (role, text, len(chunk), start, end)


def test_plain_text_is_not_escaped():
    assert chat_format.round_trip("user", "a \\ b")[3] == 0
    assert chat_format.round_trip("user", "a ### b")[3] == 1
    assert chat_format.round_trip("user", "\\### Assistant: </turn> ok")[3] == 2


def test_a_text_cannot_forge_a_turn():
    with pytest.raises(ValueError):
        chat_format.parse_turn("### User: a ### Assistant: b</turn>\n")


def test_chat_digests(spark):
    rows = [(1, 1, "assistant", "b\\", "x"), (1, 0, "user", None, "x"), (2, 0, None, "</turn>", "x"), (None, 0, "user", "z", "x"), (2, 0, None, "</turn>", "x"), (3, 0, "assistant", "w" * 300_000, "x")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, chunk string")
    got = {r.conv_id: r for r in chat_format.conversation_digests(chat_format.format_turns(df)).collect()}
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    assert set(got) == {1, 2, 3, None}
    assert got[1].turns_sha256 == sha("user\n\nassistant\nb\\\n") and got[1].loss_sha256 == sha("b\\") and got[1].loss_chars == 2
    assert got[2].n_turns == 2 and got[2].turns_sha256 == sha("\n</turn>\n" * 2) and got[2].loss_sha256 == sha("")
    assert got[3].loss_chars == 300_000
    empty = chat_format.conversation_digests(chat_format.format_turns(df.limit(0)))
    assert empty.count() == 0


@settings(max_examples=150, deadline=None)
@given(st.lists(st.tuples(st.sampled_from(["user", "assistant", "a:b", ""]), st.lists(st.sampled_from(PIECES), max_size=5).map("".join)), max_size=5))
def test_a_rendered_conversation_reads_back_as_its_turns(turns):
    text = "".join(chat_format.round_trip(r, t)[0] for r, t in turns)
    read = list(chat_format.parse_conversation(text))
    assert [(r, t) for r, t, _, _ in read] == turns
    assert all(chat_format.parse_turn("### User: " + text[a:b] + "</turn>\n")[1] == t for _, t, a, b in read)


def test_a_conversation_is_read_from_its_text_in_parts(spark, monkeypatch):
    rng = random.Random(5)
    rows = [(c, k, rng.choice(["user", "assistant"]), "".join(rng.choice(PIECES) for _ in range(rng.randrange(9)))) for c in range(20) for k in range(rng.randrange(1, 30))]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    whole = sorted(map(tuple, chat_format.conversation_digests(chat_format.format_turns(df)).collect()))
    monkeypatch.setattr(chat_format, "READ_CHARS", 40)
    assert sorted(map(tuple, chat_format.conversation_digests(chat_format.format_turns(df)).collect())) == whole
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    for c, n, turns, chars, loss, *_ in whole:
        mine = [r for r in rows if r[0] == c]
        said = "".join(t for _, _, r, t in mine if r == "assistant")
        assert (n, turns, chars, loss) == (len(mine), sha("".join(f"{r}\n{t}\n" for _, _, r, t in mine)), len(said), sha(said))
    forged = chat_format.format_turns(df).withColumn("loss_end", F.col("loss_end") + 1)
    with pytest.raises(Exception, match="mask"):
        chat_format.conversation_digests(forged).collect()


def test_sharding_follows_the_brute_force_order(spark):
    rng = random.Random(3)
    rows = [(i, rng.choice(["hot"] * 6 + ["a", "b", None]), None if i % 50 == 0 else "t" * rng.randrange(9), 5) for i in range(701)] + [(3, "hot", "same", 5)] * 40
    df = spark.createDataFrame(rows, "doc_id long, source string, text string, shard int")
    got = sharding.interleave(df).collect()
    assert len(got) == len(rows)
    by = {s: sorted(r.slot for r in got if r.shard == s) for s in range(8)}
    assert all(v == list(range(len(v))) for v in by.values())
    assert max(map(len, by.values())) - min(map(len, by.values())) <= 1
    for r in got[:20]:
        texts = {x[2] or "" for x in rows if x[0] == r.doc_id}
        assert any(r.size == len(t) + 1 and r.text_crc32 == zlib.crc32(t.encode()) for t in texts)
    for s in {x[1] for x in rows}:
        share = [sum(r.source == s for r in got if r.shard == k) for k in range(8)]
        assert max(share) - min(share) <= 2  # the mixture of the whole in every shard
    assert sorted(map(tuple, got), key=str) == sorted(map(tuple, sharding.interleave(df.repartition(7)).collect()), key=str)
    assert sharding.interleave(df.limit(0)).count() == 0
    assert sorted((r.doc_id, r.source or "", r.size, r.text_crc32, r.shard, r.slot) for r in got) == sorted(_brute_shards(spark, rows))


def _brute_shards(spark, rows, seed=17, n_shards=8):
    """The order, with all rows in one list; only the two seeded hashes are Spark's."""
    made = spark.createDataFrame([(i, s, len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for i, s, t, _ in rows], "doc_id long, source string, size long, crc long")
    h = F.xxhash64(F.lit(seed), "doc_id", "crc", "size")
    start = F.pmod(F.xxhash64(F.lit(seed), F.coalesce(F.concat(F.lit("="), "source"), F.lit("null"))), F.lit(1 << 16))
    sources = {}
    for r in made.withColumn("h", h).withColumn("start", start).collect():
        # the buckets of a hash are its bits from the 20th on
        sources.setdefault("null" if r.source is None else "=" + r.source, []).append(((r.h >> 20) % 4096, r.h, r.doc_id, r.size, r.crc, r.source or "", r.start))
    order = []
    for stratum, own in sources.items():
        for rank, (*_, doc_id, size, crc, source, start) in enumerate(sorted(own)):
            order.append(((65536 * rank + start) / (65536 * len(own)), stratum, rank, doc_id, source, size, crc))
    n, out = len(order), []
    for at, (_, _, _, doc_id, source, size, crc) in enumerate(sorted(order)):
        shard = max(s for s in range(n_shards) if s * n // n_shards <= at)
        out.append((doc_id, source, size, crc, shard, at - shard * n // n_shards))
    return out


def test_sources_of_one_row_spread_over_all_shards(spark):
    df = spark.range(4000).selectExpr("id as doc_id", "concat('s', id) as source", "'t' as text").unionAll(spark.createDataFrame([(9000, "s1", "long " * 300_000)], "doc_id long, source string, text string"))
    rows = sharding.interleave(df)
    assert {r["count"] for r in rows.groupBy("shard").count().collect()} <= {500, 501}
    assert rows.select(F.max("size")).first()[0] == 1_500_001


def test_license_rules(spark):
    mit = "MIT License\n\nCopyright (c) 2020 A\n\n" + license_scan.SENTENCES["mit-grant"] + ".\n" + license_scan.SENTENCES["mit-notice"] + "."
    wrapped = license_scan.SENTENCES["gpl-free"].replace(" redistribute", "\nredistribute") + ". Next."
    rows = [(1, mit), (2, None), (3, ""), (4, "Prose.\nLicensed under CC BY-NC 4.0.\nAll rights reserved."), (5, wrapped), (6, "licensed under nothing. mit license agreement"), (4, "Licensed under the Apache License, Version 2.0."), (7, "x. " * 100_000 + "MIT License")]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("licences", __import__("pyspark").sql.functions.lit(1))
    got = sorted(tuple(r)[:2] for r in license_scan.scan_licenses(df).collect())
    assert got == [(1, "MIT"), (2, ""), (3, ""), (4, "Apache-2.0"), (4, "CC-BY-NC-4.0,Proprietary"), (5, "GPL-3.0-or-later"), (6, ""), (7, "MIT")]
    assert license_scan.scan_licenses(df.limit(0)).count() == 0


WRAPPED = {
    "MIT": "Copyright (c) 2020 A Person\n\nPermission is hereby granted, free of charge, to any person obtaining a copy\nof this software and associated documentation files (the \"Software\"), to deal\nin the Software without restriction, including without limitation the rights\nto use, copy, modify, merge, publish, distribute, sublicense, and/or sell\ncopies of the Software, and to permit persons to whom the Software is\nfurnished to do so, subject to the following conditions:\n\nThe above copyright notice and this permission notice shall be included in all\ncopies or substantial portions of the Software.\n\nTHE SOFTWARE IS PROVIDED \"AS IS\".",
    "BSD-3-Clause": "Copyright (c) 2020, A Person\nAll rights reserved.\n\nRedistribution and use in source and binary forms, with or without\nmodification, are permitted provided that the following conditions are met:\n\n1. Redistributions of source code must retain the above copyright notice, this\n   list of conditions and the following disclaimer.\n\n2. Redistributions in binary form must reproduce the above copyright notice.\n\n3. Neither the name of the copyright holder nor the names of its\n   contributors may be used to endorse or promote products derived from\n   this software without specific prior written permission.\n",
    "GPL-3.0-or-later": "Copyright (C) 2020 A Person\n\nThis program is free software: you can redistribute it and/or modify\nit under the terms of the GNU General Public License as published by\nthe Free Software Foundation, either version 3 of the License, or\n(at your option) any later version.\n\nThis program is distributed in the hope that it will be useful,\nbut WITHOUT ANY WARRANTY; without even the implied warranty of\nMERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE.  See the\nGNU General Public License for more details.\n",
    "Apache-2.0": "Copyright 2020 A Person\n\nLicensed under the Apache License, Version 2.0\n(the \"License\"); you may not use this file except in\ncompliance with the License. You may obtain a copy of the License at\n\n    http://www.apache.org/licenses/LICENSE-2.0\n",
}


_BSD_HEAD = "Copyright (c) 2021, A Person\nAll rights reserved.\n\nRedistribution and use in source and binary forms, with or without\nmodification, are permitted provided that the following conditions are met:\n\n"
_BSD_CLAUSES = "1. Redistributions of source code must retain the above copyright notice, this\n   list of conditions and the following disclaimer.\n\n2. Redistributions in binary form must reproduce the above copyright notice,\n   this list of conditions and the following disclaimer in the documentation\n   and/or other materials provided with the distribution.\n\n"
_BSD_END = 'THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS"\nAND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE\nIMPLIED WARRANTIES OF MERCHANTABILITY ARE DISCLAIMED.\n'
_FREE = "This {0} is free software{1} you can redistribute it and/or\nmodify it under the terms of the GNU {2} General Public\nLicense as published by the Free Software Foundation; either\nversion {3} of the License, or (at your option) any later version.\n\nThis {0} is distributed in the hope that it will be useful,\nbut WITHOUT ANY WARRANTY.\n"
MORE_NOTICES = {
    "BSD-2-Clause": _BSD_HEAD + _BSD_CLAUSES + _BSD_END,
    "BSD-3-Clause": _BSD_HEAD + _BSD_CLAUSES + "3. Neither the name of the copyright holder nor the names of its\n   contributors may be used to endorse or promote products derived from\n   this software without specific prior written permission.\n\n" + _BSD_END,
    "ISC": "Copyright (c) 2020, A Person\n\nPermission to use, copy, modify, and/or distribute this software for any\npurpose with or without fee is hereby granted, provided that the above\ncopyright notice and this permission notice appear in all copies.\n",
    "LGPL-2.1-or-later": _FREE.format("library", ";", "Lesser", "2.1"),
    "LGPL-3.0-or-later": _FREE.format("library", ";", "Lesser", "3"),
    "AGPL-3.0-or-later": _FREE.format("program", ":", "Affero", "3"),
    "MPL-2.0": "This Source Code Form is subject to the terms of the Mozilla Public\nLicense, v. 2.0. If a copy of the MPL was not distributed with this\nfile, You can obtain one at https://mozilla.org/MPL/2.0/.\n",
    "EPL-2.0": "This program and the accompanying materials are made\navailable under the terms of the Eclipse Public License 2.0\nwhich is available at https://www.eclipse.org/legal/epl-2.0/\n\nSPDX-License-Identifier: EPL-2.0\n",
    "Unlicense": "This is free and unencumbered software released into the public domain.\n\nAnyone is free to copy it.\n",
}
TITLES = {
    "GPL-3.0-only": "                    GNU GENERAL PUBLIC LICENSE\n                       Version 3, 29 June 2007\n\nPreamble",
    "GPL-2.0-only": "                    GNU GENERAL PUBLIC LICENSE\n                       Version 2, June 1991\n",
    "LGPL-2.1-only": "                  GNU LESSER GENERAL PUBLIC LICENSE\n                       Version 2.1, February 1999\n",
    "LGPL-3.0-only": "                   GNU LESSER GENERAL PUBLIC LICENSE\n                       Version 3, 29 June 2007\n",
    "AGPL-3.0-only": "                    GNU AFFERO GENERAL PUBLIC LICENSE\n                       Version 3, 19 November 2007\n",
    "Apache-2.0": "                                 Apache License\n                           Version 2.0, January 2004\n                        http://www.apache.org/licenses/\n",
    "MPL-2.0": "Mozilla Public License Version 2.0\n==================================\n",
}


def test_more_notices_and_title_lines(spark):
    rows, want = [], []
    for name, text in MORE_NOTICES.items():
        for sign in ["", " * ", "# ", "// "]:
            rows.append((len(rows), "Some file.\n" * (len(rows) % 3) + "\n".join((sign + line).rstrip() for line in text.split("\n"))))
            want.append(name)
    for name, text in TITLES.items():
        rows.append((len(rows), text + "\nterms and conditions\n"))
        want.append(name)
    rows += [(len(rows), "nothing of that kind. Version 2. June is warm.")]
    want.append("")
    got = {r.doc_id: r.licences for r in license_scan.scan_licenses(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert [got[i] for i in range(len(rows))] == want


def test_full_wrapped_notices(spark):
    rows, want = [], []
    for name, text in WRAPPED.items():
        for sign in ["", " * ", "# ", "// "]:
            for gap in ["\n\n", "\n"]:
                rows.append((len(rows), "\n".join(sign + line for line in text.replace("\n\n", gap, 1).split("\n"))))
                want.append(name)
    rows.append((len(rows), "All rights reserved.\n\nProse.\n" + WRAPPED["BSD-3-Clause"]))
    want.append("BSD-3-Clause,Proprietary")
    got = {r.doc_id: r.licences for r in license_scan.scan_licenses(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert [got[i] for i in range(len(rows))] == want


def test_token_counts_equal_the_library(spark):
    path = public_tokenizers.path("byte_bpe_50k.json")
    t = Tokenizer.from_file(path)
    rng = random.Random(5)
    alphabet = "abct he ing'sll 12\n\t\r 　\x1c\x85 éßñ漢字🙂👩‍👩‍👧!#<|>​́²½"
    texts = ["".join(rng.choice(alphabet) for _ in range(rng.randrange(200))) for _ in range(1500)]
    texts += ["a" * 5000, "ab" * 3000, "!" * 4001, "<|endoftext|>a<|endoftext|><|endoftext|>", " <|endoftext|> x", "", "they'll we've I'm 'S", "word " * 300_000]
    df = spark.createDataFrame([(i, x, 1) for i, x in enumerate(texts)] + [(-1, None, 1)], "doc_id long, text string, n_tokens int")
    got = {r.doc_id: r for r in token_count.count_tokens(df, path).collect()}
    want = [len(e.ids) for e in t.encode_batch(texts, add_special_tokens=False)]
    assert [got[i].n_tokens for i in range(len(texts))] == want
    assert got[-1].n_tokens == 0 and got[-1].n_bytes == 0 and not got[-1].over_limit
    assert all(got[i].n_bytes == len(x.encode()) for i, x in enumerate(texts))
    assert token_count.count_tokens(df.limit(0), path).count() == 0
    again = spark.createDataFrame([(1, "word word"), (1, "word word"), (None, "word"), (2, "word word")], "doc_id long, text string").coalesce(1)
    n = len(t.encode("word word", add_special_tokens=False).ids)
    assert sorted(((r.doc_id or 0, r.n_tokens) for r in token_count.count_tokens(again, path).collect())) == [(0, len(t.encode("word", add_special_tokens=False).ids)), (1, n), (1, n), (2, n)]


def test_unknown_kinds_of_added_tokens_are_refused(tmp_path):
    with open(public_tokenizers.path("byte_bpe_50k.json"), encoding="utf-8") as f:
        spec = json.load(f)
    spec["added_tokens"][0]["lstrip"] = True
    (tmp_path / "odd.json").write_text(json.dumps(spec))
    with pytest.raises(ValueError, match="added tokens"):
        token_count.Counter(str(tmp_path / "odd.json"))


def test_a_row_repeated_for_a_third_of_the_table_is_dealt_by_pieces(spark, monkeypatch):
    rows = [(7, "same", "hot")] * 900 + [(i, f"text {i}", "ab"[i % 2]) for i in range(1800)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(5)
    whole = sorted(sharding.interleave(docs).collect())
    monkeypatch.setattr(sharding, "PIECE", 64)
    dealt = sharding.interleave(docs)
    assert sorted(dealt.collect()) == whole
    hot = [sum(r.shard == s for r in whole if r.source == "hot") for s in range(8)]
    assert max(hot) - min(hot) <= 2 and sorted((r.shard, r.slot) for r in whole) == [(s, k) for s in range(8) for k in range(sum(r.shard == s for r in whole))]


#: Notices as they stand in files, with the licence that is found.
VARIANTS = [
    ("Redistribution and use in source and binary forms, with or without\nmodification, are permitted provided that the following conditions are met:\n1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.\n2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution.\n3. Neither the name of Example Corporation nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission.\n", "BSD-3-Clause"),
    ("// Copyright 2009 The Example Authors. All rights reserved.\n// Use of this source code is governed by a BSD-style\n// license that can be found in the LICENSE file.\n", "BSD"),
    ("# Licensed to the Apache Software Foundation (ASF) under one or more\n# contributor license agreements.  See the NOTICE file distributed with\n# this work for additional information regarding copyright ownership.\n# The ASF licenses this file to You under the Apache License, Version 2.0\n# (the \"License\"); you may not use this file except in compliance with\n# the License.\n", "Apache-2.0"),
    ("/* SPDX-License-Identifier: GPL-2.0-only */\nint x;\n", "GPL-2.0-only"),
    ("# SPDX-License-Identifier: MIT\n", "MIT"),
    ("Example is free software: you can redistribute it and/or modify\nit under the terms of the GNU General Public License as published by\nthe Free Software Foundation, either version 3 of the License, or\n(at your option) any later version.\n", "GPL-3.0-or-later"),
    ("Example is free software; you can redistribute it and/or\nmodify it under the terms of the GNU Lesser General Public\nLicense as published by the Free Software Foundation; either\nversion 2.1 of the License, or (at your option) any later version.\n", "LGPL-2.1-or-later"),
    ("This program is free software; you can redistribute it and/or modify it\nunder the terms of the GNU General Public License version 2 as published by\nthe Free Software Foundation.\n", "GPL-2.0-only"),
    ("This work is licensed under the Creative Commons Attribution-ShareAlike 4.0 International License.\n", "CC-BY-SA-4.0"),
    ("The text is licensed under a Creative Commons Attribution 4.0\nInternational License.\n", "CC-BY-4.0"),
    ("Distributed under the Boost Software License, Version 1.0.\n", "BSL-1.0"),
    ("This software is provided 'as-is', without any express or implied\nwarranty.\n\nPermission is granted to anyone to use this software for any purpose,\nincluding commercial applications, and to alter it and redistribute it\nfreely, subject to the following restrictions:\n\n1. The origin of this software must not be misrepresented.\n", "Zlib"),
]


def test_variants_of_notices(spark):
    got = {r.doc_id: r.licences for r in license_scan.scan_licenses(spark.createDataFrame([(i, t) for i, (t, _) in enumerate(VARIANTS)], "doc_id long, text string")).collect()}
    assert [got[i] for i in range(len(VARIANTS))] == [name for _, name in VARIANTS]
