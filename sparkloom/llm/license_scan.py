"""Licence scans by sentences: known sentences become identifiers, and ordered rules read their sequence."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: A known sentence's pieces end at a line's end, or at . ! ? ; or : before white space or the text's end.
SENTENCE_END = "\\n|[.!?;:]+(?=\\s|$)"

#: Known licence sentences by identifier, as the licences have them.
SENTENCES = {
    "mit-grant": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions",
    "mit-notice": "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software",
    "mit-as-is": "THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT",
    "mit-liability": "IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE",
    "mit-released": "Released under the MIT License",
    "mit-licensed": "Licensed under the MIT License",
    "isc-grant": "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies",
    "bsd-grant": "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met",
    "bsd-source": "Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer",
    "bsd-binary": "Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution",
    "bsd-endorse": "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission",
    "apache-short": "Licensed under the Apache License, Version 2.0",
    "apache-header": "Licensed under the Apache License, Version 2.0 (the \"License\")",
    "apache-comply": "you may not use this file except in compliance with the License",
    "apache-copy": "You may obtain a copy of the License at",
    "apache-basis": "Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied",
    "gpl-free": "This program is free software",
    "gpl3-terms": "you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version",
    "gpl2-terms": "you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation; either version 2 of the License, or (at your option) any later version",
    "gpl-hope": "This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY",
    "gpl3-work": "This work is licensed under the GNU General Public License, version 3",
    "lgpl-terms": "you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version",
    "mpl2": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0",
    "cc-by": "Licensed under CC BY 4.0",
    "cc-by-work": "This work is licensed under a Creative Commons Attribution 4.0 International License",
    "cc-by-sa": "Licensed under CC BY-SA 4.0",
    "cc-by-nc": "Licensed under CC BY-NC 4.0",
    "cc-by-nc-nd": "Licensed under CC BY-NC-ND 4.0",
    "cc0": "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work",
    "unlicense": "This is free and unencumbered software released into the public domain",
    "all-rights": "All rights reserved",
}
#: Licences by the sentences that name them in this order; the first rule that fits names the licence.
RULES = (
    ("MIT", ("mit-grant", "mit-notice", "mit-as-is", "mit-liability")),
    ("MIT", ("mit-grant", "mit-as-is")),
    ("BSD-3-Clause", ("bsd-grant", "bsd-source", "bsd-binary", "bsd-endorse")),
    ("BSD-2-Clause", ("bsd-grant", "bsd-source", "bsd-binary")),
    ("Apache-2.0", ("apache-header", "apache-comply", "apache-copy", "apache-basis")),
    ("Apache-2.0", ("apache-header", "apache-comply")),
    ("GPL-3.0-or-later", ("gpl-free", "gpl3-terms")),
    ("GPL-2.0-or-later", ("gpl-free", "gpl2-terms")),
    ("LGPL-3.0-or-later", ("gpl-free", "lgpl-terms")),
    ("ISC", ("isc-grant",)),
    ("MPL-2.0", ("mpl2",)),
    ("Unlicense", ("unlicense",)),
    ("CC0-1.0", ("cc0",)),
    ("GPL-3.0", ("gpl3-work",)),
    ("Apache-2.0", ("apache-short",)),
    ("Apache-2.0", ("apache-header",)),
    ("MIT", ("mit-released",)),
    ("MIT", ("mit-licensed",)),
    ("CC-BY-NC-ND-4.0", ("cc-by-nc-nd",)),
    ("CC-BY-NC-4.0", ("cc-by-nc",)),
    ("CC-BY-SA-4.0", ("cc-by-sa",)),
    ("CC-BY-4.0", ("cc-by",)),
    ("CC-BY-4.0", ("cc-by-work",)),
    ("all-rights-reserved", ("all-rights",)),
)


def normal(sentence: str) -> str:
    kept = "".join(c if c.isascii() and c.isalnum() else " " for c in sentence.translate(str.maketrans(UPPER, LOWER)))
    return " ".join(kept.split())


#: In order: what starts a line but is no word of it goes, sentence ends and empty lines become S, other separators one space
#: or one line's end. Texts have no capitals of ASCII then, so S is a mark of ours.
#: Groups repeat possessively: others are matched by recursion, which long texts would drive too deep.
MARKS = (("\n(?:[^a-z0-9\n]++|(?:dnl|rem)(?=\\s))++", "\n"), ("[.!?;:]+(?=\\s|$)", "S"), ("[^a-z0-9S\n]+", " "), (" ?\n[ \n]+", "S"), ("[ \n]*S[ \nS]*", "S"), (" \n", "\n"))


def marked(text: Column) -> Column:
    """Words between spaces, lines' ends and S, with a mark before the first word and one after the last."""
    out = F.concat(F.lit("\n"), F.translate(text, UPPER, LOWER), F.lit("\n"))
    for pattern, to in MARKS:
        out = F.regexp_replace(out, pattern, to)
    return out


def sentence_pattern(codes: dict[str, str]) -> str:
    """Known pieces, the longest first, from a line's or a sentence's start to an end of either, over any lines between."""
    longest = sorted(codes, key=lambda c: (-len(c), c))
    return "(?<=[S\n])(?:" + "|".join(c.replace(" ", "[ \n]") for c in longest) + ")(?=[S\n])"


def pieces_of(text: str) -> list[str]:
    import re

    return [n for p in re.split(SENTENCE_END, text) if (n := normal(p))]


def tables(sentences: dict[str, str], rules) -> tuple[dict[str, str], list[tuple[str, tuple[str, ...]]]]:
    """Normalised pieces to codes, and the rules over codes: a known text of several sentences is a run of codes."""
    codes: dict[str, str] = {}
    runs: dict[str, tuple[str, ...]] = {}
    for name, text in sentences.items():
        found = pieces_of(text)
        runs[name] = tuple(codes.setdefault(p, name if len(found) == 1 else f"{name}.{i}") for i, p in enumerate(found))
    return codes, [(licence, tuple(c for name in names for c in runs[name])) for licence, names in rules]


def rule_fits(ids: Column, codes: tuple[str, ...]) -> Column:
    """Whether ``ids`` hold these codes in this order, others allowed between: one walk along them."""
    if len(codes) == 1:
        return F.array_contains(ids, codes[0])
    wanted = F.array(*map(F.lit, codes))
    reached = F.aggregate(ids, F.lit(0), lambda n, x: n + F.coalesce((F.get(wanted, n) == x).cast("int"), F.lit(0)))
    return reached == len(codes)


def rule_pattern(codes: tuple[str, ...]) -> str:
    """Regular expression over the text ``,a,b,c,`` for these codes in this order, others allowed between; for SQL."""
    import re

    return "," + ",(?:[^,]+,)*".join(re.escape(c).replace("\\-", "-") for c in codes) + ","


def anchors(codes: dict[str, str]) -> str:
    """A pattern that every known sentence meets, so that texts without it need no sentences."""
    words = ("licen[sc]e", "copyright", "permi", "redistribut", "warrant", "reserved", "software", "license", "liable", "endorse")
    import re

    found = [w for w in words if any(re.search(w, c) for c in codes)]
    missing = [c for c in codes if not any(re.search(w, c) for w in found)]
    found += sorted({max(c.split(), key=len) for c in missing})
    return "(?i)" + "|".join(found)


def scan_licenses(docs: DataFrame, sentences: dict[str, str] | None = None, rules=RULES) -> DataFrame:
    """(doc_id, n_matched, sentence_ids, licenses, license) for each row of ``docs`` (doc_id, text).

    A known sentence stands on whole lines or between sentence ends, wrapped over any lines of a paragraph, each of which
    may start with the marks of a comment; of sentences that start at one place the longest counts.
    sentence_ids: identifiers of the known sentences in the text's order, joined by commas. licenses: the licences of
    all rules that fit, each once, in rule order. license: that of the first, null without any. Null and empty
    texts match nothing; repeated rows are scanned alike; an empty table gives no rows; other columns are not read.
    The table of sentences and the rules are literals of the plan, so a scan is one pass without a shuffle.
    """
    codes, ordered = tables(sentences or SENTENCES, rules)
    table = F.create_map(*[F.lit(x) for pair in codes.items() for x in pair])
    pieces = F.regexp_extract_all(marked(F.col("text")), F.lit(sentence_pattern(codes)), F.lit(0))
    found = F.transform(pieces, lambda s: F.try_element_at(table, F.translate(s, "\n", " ")))
    ids = F.when(F.col("text").rlike(anchors(codes)), found).otherwise(F.array().cast("array<string>"))
    scanned = docs.select("doc_id", F.coalesce(ids, F.array().cast("array<string>")).alias("ids"))
    fitting = F.array_distinct(F.filter(F.array(*[F.when(rule_fits(F.col("ids"), c), F.lit(name)) for name, c in ordered]), lambda x: x.isNotNull()))
    scanned = scanned.withColumn("fitting", F.when(F.size("ids") > 0, fitting).otherwise(F.array().cast("array<string>")))
    return scanned.select("doc_id", F.size("ids").cast("long").alias("n_matched"), F.array_join("ids", ",").alias("sentence_ids"), F.array_join("fitting", ",").alias("licenses"), F.try_element_at("fitting", F.lit(1)).alias("license"))


def oracle(sentences: dict[str, str] | None = None, rules=RULES) -> str:
    codes, ordered = tables(sentences or SENTENCES, rules)
    quoted = lambda s: "'" + s.replace("'", "''") + "'"
    known = ", ".join(f"({quoted(s)}, {quoted(c)})" for s, c in codes.items())
    cases = ", ".join(f"CASE WHEN regexp_matches(',' || sentence_ids || ',', {quoted(rule_pattern(c))}) THEN {quoted(n)} END" for n, c in ordered)
    return f"""
WITH known(sentence, id) AS (VALUES {known}),
pieces AS (
  SELECT rid, unnest(parts) AS part, generate_subscripts(parts, 1) AS pos
  FROM (SELECT row_number() OVER () AS rid, regexp_split_to_array(regexp_replace(text, '[.!?;:]+(\\s|$)', chr(10) || '\\1', 'g'), chr(10)) AS parts FROM documents)),
named AS (
  SELECT rid, count(*)::BIGINT AS n, string_agg(id, ',' ORDER BY pos) AS sentence_ids
  FROM pieces JOIN known ON sentence = trim(regexp_replace(translate(part, '{UPPER}', '{LOWER}'), '[^a-z0-9]+', ' ', 'g')) GROUP BY rid),
scanned AS (
  SELECT doc_id, coalesce(n, 0) AS n_matched, coalesce(sentence_ids, '') AS sentence_ids
  FROM (SELECT row_number() OVER () AS rid, doc_id FROM documents) LEFT JOIN named USING (rid)),
fitted AS (SELECT *, list_filter([{cases}], lambda x: x IS NOT NULL) AS fits FROM scanned),
once AS (SELECT *, list_filter(fits, lambda x, i: list_position(fits, x) = i) AS fitting FROM fitted)
SELECT doc_id, n_matched, sentence_ids, coalesce(array_to_string(fitting, ','), '') AS licenses, fitting[1] AS license FROM once
"""
