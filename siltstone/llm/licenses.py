"""Licence scans by sentence rules, with DataFrame functions only.

Sentences are normalised to lower-case letters and digits and looked up among known licence sentences; each has a
one-letter identifier. A document is then a string of identifiers, a full stop for any other sentence. Ordered
rules, the most specific first, are patterns over that string; sentences that a rule has used are not used again.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Known sentences by identifier, as normalised (fixed values, from the public texts of the licences).
SENTENCES = {
    "A": "licensed under the apache license version 2 0",
    "B": "licensed under the apache license version 2 0 the license",
    "C": "you may not use this file except in compliance with the license",
    "D": "you may obtain a copy of the license at http www apache org licenses license 2 0",
    "E": "unless required by applicable law or agreed to in writing software distributed under the license is distributed on an as is basis without warranties or conditions of any kind either express or implied",
    "F": "see the license for the specific language governing permissions and limitations under the license",
    "G": "released under the mit license",
    "H": "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files the software to deal in the software without restriction including without limitation the rights to use copy modify merge publish distribute sublicense and or sell copies of the software and to permit persons to whom the software is furnished to do so subject to the following conditions",
    "I": "the above copyright notice and this permission notice shall be included in all copies or substantial portions of the software",
    "J": "the software is provided as is without warranty of any kind express or implied including but not limited to the warranties of merchantability fitness for a particular purpose and noninfringement",
    "K": "this work is licensed under the gnu general public license version 3",
    "L": "this program is free software",
    "M": "you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation either version 3 of the license or at your option any later version",
    "N": "this program is distributed in the hope that it will be useful but without any warranty",
    "O": "licensed under cc by nc 4 0",
    "P": "licensed under cc by 4 0",
    "Q": "this work is licensed under a creative commons attribution 4 0 international license",
    "R": "this work is licensed under a creative commons attribution noncommercial 4 0 international license",
    "S": "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met",
    "T": "redistributions of source code must retain the above copyright notice this list of conditions and the following disclaimer",
    "U": "redistributions in binary form must reproduce the above copyright notice this list of conditions and the following disclaimer in the documentation and or other materials provided with the distribution",
    "V": "neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission",
    "W": "this project is licensed under the mit license",
    "X": "licensed under the mit license",
    "Y": "this project is licensed under the apache license version 2 0",
    "Z": "licensed under the bsd 3 clause license",
    "À": "you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation either version 2 of the license or at your option any later version",
    "Á": "you can redistribute it and or modify it under the terms of the gnu general public license version 2 as published by the free software foundation",
    "Â": "this library is free software",
    "Ã": "you can redistribute it and or modify it under the terms of the gnu lesser general public license as published by the free software foundation either version 2 1 of the license or at your option any later version",
    "Ä": "you can redistribute it and or modify it under the terms of the gnu lesser general public license as published by the free software foundation either version 3 of the license or at your option any later version",
    "Å": "you can redistribute it and or modify it under the terms of the gnu affero general public license as published by the free software foundation either version 3 of the license or at your option any later version",
    "Æ": "this source code form is subject to the terms of the mozilla public license v",
    "Ç": "if a copy of the mpl was not distributed with this file you can obtain one at https mozilla org mpl 2 0",
    "È": "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted provided that the above copyright notice and this permission notice appear in all copies",
    "É": "the software is provided as is and the author disclaims all warranties with regard to this software including all implied warranties of merchantability and fitness",
    "Ê": "this is free and unencumbered software released into the public domain",
    "Ë": "anyone is free to copy modify publish use compile sell or distribute this software either in source code form or as a compiled binary for any purpose commercial or non commercial and by any means",
    "Ì": "this software is provided as is without any express or implied warranty",
    "Í": "in no event will the authors be held liable for any damages arising from the use of this software",
    "Î": "permission is granted to anyone to use this software for any purpose including commercial applications and to alter it and redistribute it freely subject to the following restrictions",
    "Ï": "distributed under the boost software license version 1 0",
    "Ð": "this work is licensed under a creative commons attribution sharealike 4 0 international license",
    "Ñ": "licensed under cc by sa 4 0",
    "Ò": "this work is licensed under a creative commons attribution noncommercial sharealike 4 0 international license",
    "Ó": "licensed under cc by nc sa 4 0",
    "Ô": "to the extent possible under law the author has waived all copyright and related or neighboring rights to this work",
    "Õ": "the person who associated cc0 with this work has waived all copyright and related or neighboring rights to this work",
    "Ö": "this program and the accompanying materials are made available under the terms of the eclipse public license 2 0 which is available at https www eclipse org legal epl 2 0",
    "Ù": "licensed under the gnu general public license v3 0",
    "Ú": "licensed under the gnu general public license v2 0",
    "Û": "licensed under the mozilla public license 2 0",
    "Ü": "licensed under cc0 1 0",
}

#: Other sentences that may stand between two of a rule.
GAP = r"\.{0,3}"

#: (licence, identifiers in order), tried from first to last.
RULES = (
    ("Apache-2.0", "BCDEF"), ("MIT", "HIJ"), ("BSD-3-Clause", "STUV"), ("BSD-2-Clause", "STU"), ("GPL-3.0-or-later", "LMN"), ("GPL-3.0-or-later", "LM"),
    ("GPL-2.0-or-later", "LÀN"), ("GPL-2.0-or-later", "LÀ"), ("GPL-2.0-only", "LÁ"), ("LGPL-2.1-or-later", "ÂÃ"), ("LGPL-3.0-or-later", "ÂÄ"), ("LGPL-3.0-or-later", "LÄ"), ("AGPL-3.0-or-later", "LÅ"),
    ("MPL-2.0", "ÆÇ"), ("ISC", "ÈÉ"), ("Unlicense", "ÊË"), ("Zlib", "ÌÍÎ"), ("CC0-1.0", "Ô"), ("CC0-1.0", "Õ"), ("EPL-2.0", "Ö"),
    ("Apache-2.0", "BC"), ("Apache-2.0", "A"), ("Apache-2.0", "Y"), ("MIT", "G"), ("MIT", "HI"), ("MIT", "W"), ("MIT", "X"), ("BSD-3-Clause", "Z"), ("ISC", "È"), ("Unlicense", "Ê"), ("MPL-2.0", "Æ"), ("BSL-1.0", "Ï"),
    ("GPL-3.0-only", "K"), ("GPL-3.0-only", "Ù"), ("GPL-2.0-only", "Ú"), ("MPL-2.0", "Û"), ("CC0-1.0", "Ü"),
    ("CC-BY-NC-4.0", "O"), ("CC-BY-NC-4.0", "R"), ("CC-BY-4.0", "P"), ("CC-BY-4.0", "Q"), ("CC-BY-SA-4.0", "Ð"), ("CC-BY-SA-4.0", "Ñ"), ("CC-BY-NC-SA-4.0", "Ò"), ("CC-BY-NC-SA-4.0", "Ó"),
)

#: Each known sentence has one of these words, so a text without any of them has none of the sentences.
ANCHORS = "licen[sc]e|permi|warrant|redistribut|free software|copyright|unencumbered|held liable|anyone is free|copy of the mpl"


#: A line that names licences by their short ids, and what of its words are no ids.
SPDX_TAG = "SPDX-License-Identifier:"
SPDX_LINE, _SPDX_EXCEPTION = SPDX_TAG + r"[\x20\t]*([A-Za-z0-9.+()\x20-]+)", r"(?i)\bwith\b[\x20]+[A-Za-z0-9.+-]+"


def spdx_ids(text: Column) -> Column:
    """Short ids on the SPDX lines of a text, as written there; AND, OR, brackets and exceptions are left out."""
    lines = F.when(text.contains(SPDX_TAG), F.regexp_extract_all(text, F.lit(SPDX_LINE), F.lit(1))).otherwise(F.array().cast("array<string>"))
    words = F.flatten(F.transform(lines, lambda x: F.regexp_extract_all(F.regexp_replace(x, _SPDX_EXCEPTION, ""), F.lit("[A-Za-z0-9.+-]+"), F.lit(0))))
    return F.filter(F.transform(words, lambda w: F.regexp_replace(w, "[.-]+$", "")), lambda w: (w != "") & ~F.upper(w).isin("AND", "OR"))


def rule_pattern(ids: str) -> str:
    return GAP.join(ids)


def sentence_ids(text: Column) -> Column:
    """One letter for each sentence of a text (comment marks at the beginnings of lines are no text): of known ones the identifier, of others a full stop.

    .!? followed by white space end sentences. A line, a colon, a semicolon or a dash may: a known sentence begins and ends
    at any of these, and line breaks (blank lines too), colons, semicolons and dashes within it are as spaces, so wrapped texts and
    lists give the same. Of what is left, each line is a sentence; the other three don't end those.
    """
    t = F.regexp_replace(F.translate(F.lower(text), "|#", "  "), r"[.!?][\x20\x09-\x0D]+", "|")
    t = F.regexp_replace(F.regexp_replace(t, r"[:;](?=[\x20\x09-\x0D])|[\x20\t]-+(?=[\x20\t])", "#"), r"[^a-z0-9|#\n]+", " ")
    for run, end in ((r"[ #\n]*\|[ #\n|]*", "|"), (r"[ #]*\n[ #\n]*", "\n"), (" ?#[ #]*", "#")):
        t = F.regexp_replace(t, run, end)
    t = F.concat(F.lit("|"), F.trim(t), F.lit("|"))
    for k, s in sorted(SENTENCES.items(), key=lambda x: -len(x[1])):
        t = F.regexp_replace(t, rf"(?<=[|#\n]){s.replace(' ', '[ #\\n]')}(?=[|#\n])", k)
    plain = F.split(F.regexp_replace(t, "(?<=[A-ZÀ-Þ])#|#(?=[A-ZÀ-Þ])", "|"), r"[|\n]")
    ids = F.array_join(F.transform(F.filter(plain, lambda s: F.translate(s, " #", "") != ""), lambda s: F.when(s.rlike("^[A-ZÀ-Þ]$"), s).otherwise(".")), "")
    return F.when(text.rlike(f"(?i){ANCHORS}"), ids).otherwise("")


def scan_licenses(docs: DataFrame) -> DataFrame:
    """docs with sentence_ids (string; empty where no sentence can be known) and licenses: array of (license, matches), by rule, then by
    short id on SPDX lines.

    A null or empty text has none. Rows are read by themselves: repeated rows and ids, null ids and empty tables need
    no rule. Other columns pass through; columns of these two names are replaced.
    """
    text, mark = F.coalesce("text", F.lit("")), "_"
    while any(c.startswith(mark) for c in docs.columns):
        mark += "_"
    out = docs.withColumn("sentence_ids", sentence_ids(text)).withColumn(mark, F.col("sentence_ids"))
    for i, (_, ids) in enumerate(RULES):
        pattern = rule_pattern(ids)
        out = out.withColumn(f"{mark}{i}", F.regexp_count(mark, F.lit(pattern))).withColumn(mark, F.regexp_replace(mark, pattern, "."))
    hits = F.array(*(F.struct(F.lit(name).alias("license"), F.col(f"{mark}{i}").alias("matches")) for i, (name, _) in enumerate(RULES)))
    named = F.transform(F.array(spdx_ids(text)), lambda ids: F.transform(F.array_distinct(ids), lambda x: F.struct(x.alias("license"), F.size(F.filter(ids, lambda y: y == x)).alias("matches"))))[0]
    out = out.withColumn("licenses", F.concat(F.filter(hits, lambda h: h["matches"] > 0), named))
    return out.drop(mark, *(f"{mark}{i}" for i in range(len(RULES))))


def license_report(docs: DataFrame) -> DataFrame:
    """doc_id, n_known (known sentences), known_ids (their identifiers in order), licenses (distinct, sorted, comma-joined) and n_matches of each row."""
    scanned = scan_licenses(docs.select("doc_id", "text"))
    known = F.regexp_replace("sentence_ids", r"\.", "")
    return scanned.select(
        "doc_id", F.char_length(known).cast("long").alias("n_known"), known.alias("known_ids"), F.array_join(F.array_sort(F.array_distinct(F.transform("licenses", lambda h: h["license"]))), ",").alias("licenses"),
        F.aggregate("licenses", F.lit(0).cast("long"), lambda a, h: a + h["matches"]).alias("n_matches"))


def oracle_sql() -> str:
    """The same rows from SQL with RE2 patterns."""
    known = ", ".join(f"'{s}': '{k}'" for k, s in SENTENCES.items())
    steps, last = [], "c"
    for i, (_, ids) in enumerate(RULES):
        pattern = rule_pattern(ids)
        steps.append(f"r{i} AS (SELECT * EXCLUDE (rest), len(regexp_extract_all(rest, '{pattern}')) AS m{i}, regexp_replace(rest, '{pattern}', '.', 'g') AS rest FROM {last})")
        last = f"r{i}"
    names = ", ".join(f"CASE WHEN m{i} > 0 THEN '{name}' END" for i, (name, _) in enumerate(RULES))
    total = " + ".join(f"m{i}" for i in range(len(RULES)))
    return rf"""
        WITH s AS (SELECT doc_id, coalesce(text, '') AS t, string_split(regexp_replace(coalesce(text, ''), '([.!?;])[\x20\x09-\x0D]+', '\1' || chr(10), 'g'), chr(10)) AS lines FROM documents),
        n AS (SELECT doc_id, t, list_filter(list_transform(lines, lambda x: trim(regexp_replace(lower(x), '[^a-z0-9]+', ' ', 'g'))), lambda x: x <> '') AS sentences FROM s),
        c AS (SELECT doc_id, ids, ids AS rest, spdx FROM (SELECT doc_id, CASE WHEN regexp_matches(t, '(?i){ANCHORS}')
              THEN array_to_string(list_transform(sentences, lambda x: coalesce(MAP {{{known}}}[x], '.')), '') ELSE '' END AS ids,
              list_filter(list_transform(flatten(list_transform(regexp_extract_all(t, '{SPDX_LINE}', 1), lambda x: regexp_extract_all(regexp_replace(x, '{_SPDX_EXCEPTION}', '', 'g'), '[A-Za-z0-9.+-]+'))),
                          lambda w: regexp_replace(w, '[.-]+$', '')), lambda w: w <> '' AND upper(w) NOT IN ('AND', 'OR')) AS spdx FROM n)),
        {", ".join(steps)}
        SELECT doc_id, len(replace(ids, '.', ''))::BIGINT AS n_known, replace(ids, '.', '') AS known_ids,
               array_to_string(list_sort(list_distinct(list_concat(list_filter([{names}], lambda x: x IS NOT NULL), spdx))), ',') AS licenses, ({total} + len(spdx))::BIGINT AS n_matches FROM {last}"""
