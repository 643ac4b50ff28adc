import brute
import pytest
from pyspark.sql import functions as F

from siltstone.llm import decontaminate, exact_dedup, licenses, pii

SCHEMA = "doc_id long, text string"
ROWS = [
    (1, None), (2, ""), (3, " "), (4, "a@b.c.d@e.f x_y@z.co 1.2.3.4.5.6.7.8 999.1.1.1 0001.2.3.255 +1 (555) 123-4567 4111 1111 1111 1111"), (4, "zz"), (5, "é@ü.com a@b.c_d@e.fg"), (5, "é@ü.com a@b.c_d@e.fg"),
    (None, "zz"), (None, ""), (6, "x" * 9000), (7, "x" * 9000), (8, "x" * 8999 + "y"), (9, "\U0001f600 +49 170 1234567 4111-1111-1111-1111 \U0001f600" * 300), (10, "1 22 " * 5000), (11, "+1" * 300),
    (12, "a.a." * 4000 + "@"), (13, " \x0b\x0c 10.0.0.1"), (14, "One two three four five six seven eight nine ten eleven, twelve"), (15, "zero one TWO three four five six seven eight nine ten Eleven"), (16, "short item"), (17, "a short ITEM here short item"),
]
BENCH = [(1, "one two three four five six seven eight nine ten eleven"), (2, "Short item"), (3, None), (4, "..."), (None, "short item"), (5, "one two three four five six seven eight nine ten eleven")]


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


@pytest.fixture(scope="module")
def docs(spark):
    wide = spark.createDataFrame(ROWS, SCHEMA)
    return wide.withColumns({c: F.lit("other") for c in ("name", "level", "l", "pos", "items", "n", "w", "h")})


def test_exact_groups_match_brute_force(docs):
    assert rows_of(exact_dedup.exact_groups(docs)) == brute.exact(ROWS)


def test_exact_groups_do_not_trust_fingerprints(docs):
    assert rows_of(exact_dedup.exact_groups(docs, block_chars=3, fingerprint=F.length)) == brute.exact(ROWS)


def test_base_pii_matches_brute_force(docs):
    assert rows_of(pii.pii_report(docs).drop("spans", "max_score")) == brute.base_pii(ROWS)


def test_pii_methods_add_and_redact(spark):
    text = "pay DE89 3704 0044 0532 0130 00 or DE88 3704 0044 0532 0130 00, ssn 123-45-6789, not 123-45-6788"
    df = spark.createDataFrame([(1, text)], SCHEMA)
    a, b = text.index("DE89"), text.index("123")
    assert pii.pii_report(df).first()["spans"] == f"iban:{a}:{a + 27},national_id:{b}:{b + 11}"
    assert "123-45-6788" in pii.redact(df).first()["text"] and "[iban]" in pii.redact(df).first()["text"]


def test_context_counts_on_both_sides(spark):
    texts = ["123-45-6789 is my ssn", "ssn 123-45-6789", "123-45-6789 alone", "ssn " + "x" * 60 + " 123-45-6789", "123-45-6789 " + "x" * 60 + " ssn", "123-45-6789, 234-56-7890 (social security)", "é 123-45-6789\n ssn"]
    got = [r["spans"] for r in pii.pii_report(spark.createDataFrame(list(enumerate(texts)), SCHEMA)).orderBy("doc_id").collect()]
    assert got == ["national_id:0:11", "national_id:4:15", "", "", "", "national_id:13:24", "national_id:2:13"]


def test_redaction(spark):
    card = "4111 1111 1111 1111"
    rows = [(1, None), (2, ""), (3, f"a +{card} b@c.de z"), (4, "x" * 10)]
    got = {r["doc_id"]: r["text"] for r in pii.redact(spark.createDataFrame(rows, SCHEMA).withColumn("personal_data", F.lit(1))).collect()}
    assert got[1] is None and got[2] == "" and got[4] == "x" * 10 and got[3] == "a +[card] [email] z"


def test_many_matches_in_one_text(spark):
    text = "mail a1@b.cd, " * 30_000
    got = pii.pii_report(spark.createDataFrame([(1, text)], SCHEMA)).first()
    assert got["n_email"] == 30_000 and got["base_sha256"] == brute.base_pii([(1, text)])[0][-1]


def test_contamination_matches_brute_force(spark, docs):
    bench = spark.createDataFrame(BENCH, "item_id long, text string")
    want = brute.leaks(ROWS, BENCH)
    assert rows_of(decontaminate.contamination(docs, bench)) == want
    assert rows_of(decontaminate.contamination(docs, bench, broadcast_windows=0)) == want
    kept = decontaminate.drop_contaminated(docs, bench)
    assert kept.columns == docs.columns and kept.count() == sum(not r[5] for r in want)


def test_empty_tables(spark):
    none, bench = spark.createDataFrame([], SCHEMA), spark.createDataFrame([], "item_id long, text string")
    assert exact_dedup.exact_groups(none).collect() == [] and pii.pii_report(none).collect() == [] and licenses.license_report(none).collect() == []
    assert decontaminate.contamination(none, bench).collect() == []
    some = spark.createDataFrame(ROWS[:3], SCHEMA)
    assert [r["n_hit"] for r in decontaminate.contamination(some, bench).collect()] == [0, 0, 0]


def test_licence_rules(spark):
    mit = ". ".join(licenses.SENTENCES[k] for k in "HIJ")
    rows = [(1, mit + "."), (2, "Licensed under the Apache License, Version 2.0."), (3, None), (4, "text\nReleased under the MIT License.\nmore. Licensed under CC BY-NC 4.0"), (5, "the license is near")]
    got = {r["doc_id"]: (r["licenses"], r["n_known"], r["n_matches"]) for r in licenses.license_report(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert got == {1: ("MIT", 3, 1), 2: ("Apache-2.0", 1, 1), 3: ("", 0, 0), 4: ("CC-BY-NC-4.0,MIT", 2, 2), 5: ("", 0, 0)}


def test_each_known_sentence_has_an_anchor():
    import re

    assert all(re.search(licenses.ANCHORS, s) for s in licenses.SENTENCES.values())


WRAPPED = {
    "MIT": """MIT License

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
AUTHORS BE LIABLE.""",
    "BSD-3-Clause": """Redistribution and use in source and binary forms, with or without
modification, are permitted provided that the following conditions are met:

1. Redistributions of source code must retain the above copyright notice, this
   list of conditions and the following disclaimer.
2. Redistributions in binary form must reproduce the above copyright notice,
   this list of conditions and the following disclaimer in the documentation
   and/or other materials provided with the distribution.
3. Neither the name of the copyright holder nor the names of its
   contributors may be used to endorse or promote products derived from
   this software without specific prior written permission.""",
    "Apache-2.0": """# Licensed under the Apache License, Version 2.0 (the "License");
# you may not use this file except in compliance with the License.
# You may obtain a copy of the License at
#
#     http://www.apache.org/licenses/LICENSE-2.0
#
# Unless required by applicable law or agreed to in writing, software
# distributed under the License is distributed on an "AS IS" BASIS,
# WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.
# See the License for the specific language governing permissions and
# limitations under the License.""",
    "GPL-3.0-or-later": """This program is free software: you can redistribute it and/or modify
it under the terms of the GNU General Public License as published by
the Free Software Foundation, either version 3 of the License, or
(at your option) any later version.

This program is distributed in the hope that it will be useful,
but WITHOUT ANY WARRANTY; without even the implied warranty of
MERCHANTABILITY.""",
}


MORE = {
    "GPL-2.0-or-later": """ * This program is free software; you can redistribute it and/or modify it
 * under the terms of the GNU General Public License as published by the
 * Free Software Foundation; either version 2 of the License, or (at your
 * option) any later version.""",
    "LGPL-2.1-or-later": """// This library is free software; you can redistribute it and/or
// modify it under the terms of the GNU Lesser General Public
// License as published by the Free Software Foundation; either
// version 2.1 of the License, or (at your option) any later version.""",
    "AGPL-3.0-or-later": """This program is free software: you can redistribute it and/or modify
it under the terms of the GNU Affero General Public License as published
by the Free Software Foundation, either version 3 of the License, or
(at your option) any later version.""",
    "MPL-2.0": """/* This Source Code Form is subject to the terms of the Mozilla Public
 * License, v. 2.0. If a copy of the MPL was not distributed with this
 * file, You can obtain one at https://mozilla.org/MPL/2.0/. */""",
    "ISC": """Permission to use, copy, modify, and/or distribute this software for any
purpose with or without fee is hereby granted, provided that the above
copyright notice and this permission notice appear in all copies.

THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH
REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY
AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE.""",
    "Unlicense": """This is free and unencumbered software released into the public domain.

Anyone is free to copy, modify, publish, use, compile, sell, or
distribute this software, either in source code form or as a compiled
binary, for any purpose, commercial or non-commercial, and by any
means.""",
    "Zlib": """This software is provided 'as-is', without any express or implied
warranty. In no event will the authors be held liable for any damages
arising from the use of this software.

Permission is granted to anyone to use this software for any purpose,
including commercial applications, and to alter it and redistribute it
freely, subject to the following restrictions:""",
    "BSL-1.0": "Distributed under the Boost Software License, Version 1.0.\n(See the file)", "CC-BY-SA-4.0": "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
    "CC0-1.0": "The person who associated CC0 with this work has waived all copyright and related or neighboring rights to this work.", "MIT": "This project is licensed under the MIT License - see the file\nfor details.",
    "Apache-2.0,GPL-2.0-only,MIT": "// SPDX-License-Identifier: (MIT OR Apache-2.0) AND GPL-2.0-only WITH Classpath-exception-2.0\nint x;", "BSD-2-Clause": "# SPDX-License-Identifier: BSD-2-Clause.",
}


def test_more_licences_are_known(spark):
    rows = spark.createDataFrame(list(enumerate(MORE.values())), SCHEMA)
    assert [r["licenses"] for r in licenses.license_report(rows).orderBy("doc_id").collect()] == list(MORE)


def test_licence_scans_keep_other_columns(spark):
    rows = spark.createDataFrame([(1, WRAPPED["MIT"], 7, 8, "a"), (1, WRAPPED["MIT"], 7, 8, "a"), (None, None, 1, 2, "b")], "doc_id long, text string, _ int, _0 int, __m string")
    got = licenses.scan_licenses(rows)
    assert got.columns == [*rows.columns, "sentence_ids", "licenses"]
    assert sorted([(r["doc_id"] or 0, r["_"], r["_0"], r["__m"], [x["license"] for x in r["licenses"]]) for r in got.collect()]) == [(0, 1, 2, "b", []), (1, 7, 8, "a", ["MIT"]), (1, 7, 8, "a", ["MIT"])]


def test_wrapped_licences_are_known(spark):
    known = {"MIT": "HIJ", "BSD-3-Clause": "STUV", "Apache-2.0": "BCDEF", "GPL-3.0-or-later": "LMN"}
    rows = [(i, sep.join(text.splitlines())) for i, (text, sep) in enumerate((t, s) for t in WRAPPED.values() for s in ("\n", "\r\n", " "))]
    got = [(r["licenses"], r["known_ids"], r["n_matches"]) for r in licenses.license_report(spark.createDataFrame(rows, SCHEMA)).orderBy("doc_id").collect()]
    assert got[::3] == got[1::3] == [(name, ids, 1) for name, ids in known.items()]
    assert got[11] == ("GPL-3.0-or-later", "LMN", 1)


def test_rows_that_repeat_a_doc_id_go_by_their_text(spark):
    rows = [(1, "a copy"), (2, "a  copy"), (2, "its own text"), (3, "twice"), (3, "twice"), (4, "twice"), (4, None), (None, "a copy")]
    got = exact_dedup.drop_exact(spark.createDataFrame(rows, SCHEMA)).collect()
    assert sorted(map(tuple, got), key=repr) == sorted([(1, "a copy"), (2, "its own text"), (3, "twice"), (3, "twice"), (4, None), (None, "a copy")], key=repr)
