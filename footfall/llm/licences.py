"""Licence scans by sentence rules.

Known licence sentences have identifiers. A text is cut into sentences, each sentence is brought
to a normal form (lower case, runs of other characters than ASCII letters and digits as one
blank, no list number in front) and looked up. Parts without letters and digits, and list numbers
alone, are no sentences. The name in the third condition of BSD-3-Clause may be any name. An
``SPDX-License-Identifier`` line is a sentence with its identifier. What a text's neighbouring sentences give is a sequence of identifiers.
Rules are sequences of identifiers with a licence, in a fixed order; a rule that matches takes
its sentences, so a longer notice is not reported as a shorter one inside it as well.

Notices are often wrapped, so each text is read line by line, with line ends as blanks, and, if it
has blank lines or copyright lines, by paragraphs: there a line without letters and digits ends a
sentence, a copyright line is a sentence of its own, and other line ends are blanks.
A licence that any reading finds is reported once. The table of sentences and rules is fixed
and small, whatever the corpus. All of it is DataFrame code.

Defined cases: a text that is null, empty or without a known notice has no licence and zero
sentences; equal texts are scanned alike, repeated rows give repeated rows; extra columns are
not read; an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from footfall.llm.common import free_names, stored

# Sentences of public licence notices, by identifier.
SENTENCES = {
    1: "Released under the MIT License.",
    2: "Licensed under the MIT License.",
    3: "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
    "documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation "
    "the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to "
    "permit persons to whom the Software is furnished to do so, subject to the following conditions:",
    4: "The above copyright notice and this permission notice shall be included in all copies or substantial portions of "
    "the Software.",
    5: "Licensed under the Apache License, Version 2.0.",
    6: "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance "
    "with the License.",
    7: "You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0.",
    8: "This work is licensed under the GNU General Public License, version 3.",
    9: "This program is free software:",
    21: "you can redistribute it and/or modify it under the terms of the GNU General Public "
    "License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later "
    "version.",
    10: "This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied "
    "warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE.",
    11: "See the GNU General Public License for more details.",
    12: "Licensed under CC BY-NC 4.0.",
    13: "Licensed under CC BY 4.0.",
    14: "Licensed under CC BY-SA 4.0.",
    15: "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    16: "Redistributions of source code must retain the above copyright notice, this list of conditions and the following "
    "disclaimer.",
    17: "Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the "
    "following disclaimer in the documentation and/or other materials provided with the distribution.",
    18: "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote "
    "products derived from this software without specific prior written permission.",
    19: "Mozilla Public License Version 2.0.",
    20: "All rights reserved.",
}

# Rules in the order in which they take sentences.
RULES = [
    ("GPL-3.0-or-later", [9, 21, 10, 11]),
    ("GPL-3.0-or-later", [9, 21, 10]),
    ("BSD-3-Clause", [16, 17, 18]),
    ("BSD-2-Clause", [16, 17]),
    ("MIT", [3, 4]),
    ("Apache-2.0", [6, 7]),
    ("GPL-3.0-or-later", [9, 21]),
    ("GPL-3.0", [8]),
    ("Apache-2.0", [6]),
    ("Apache-2.0", [5]),
    ("MIT", [3]),
    ("MIT", [1]),
    ("MIT", [2]),
    ("CC-BY-NC-4.0", [12]),
    ("CC-BY-SA-4.0", [14]),
    ("CC-BY-4.0", [13]),
    ("CC-BY-4.0", [15]),
    ("MPL-2.0", [19]),
]

# Further notices, which ORACLE_SQL does not list.
GNU_NOTICES = {  # licence: name and version in the Free Software Foundation's notices
    "GPL-2.0-or-later": ("GNU General Public License", "2"),
    "GPL-3.0-or-later": ("GNU General Public License", "3"),
    "LGPL-2.0-or-later": ("GNU Library General Public License", "2"),
    "LGPL-2.1-or-later": ("GNU Lesser General Public License", "2.1"),
    "LGPL-3.0-or-later": ("GNU Lesser General Public License", "3"),
    "AGPL-3.0-or-later": ("GNU Affero General Public License", "3"),
}
GNU_TERMS = {
    licence: f"you can redistribute it and/or modify it under the terms of the {name} as published by the Free Software "
    f"Foundation, either version {version} of the License, or (at your option) any later version."
    for licence, (name, version) in GNU_NOTICES.items()
}
GPL_2_ONLY = (
    "you can redistribute it and/or modify it under the terms of the GNU General Public License version 2 as published by "
    "the Free Software Foundation."
)
FURTHER = [  # a licence and a notice's sentences
    *((licence, [f"This {it} is free software; {terms}"]) for licence, terms in GNU_TERMS.items() for it in ("program", "library")),
    *((licence, [f"This {it} is free software:", terms]) for licence, terms in GNU_TERMS.items() for it in ("program", "library")),
    ("GPL-2.0-only", [f"This program is free software; {GPL_2_ONLY}"]),
    ("GPL-2.0-only", ["This program is free software:", GPL_2_ONLY]),
    ("GPL-2.0", ["This work is licensed under the GNU General Public License, version 2."]),
    ("ISC", [
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby "
        "granted, provided that the above copyright notice and this permission notice appear in all copies.",
    ]),
    ("ISC", [
        "Permission to use, copy, modify, and distribute this software for any purpose with or without fee is hereby "
        "granted, provided that the above copyright notice and this permission notice appear in all copies.",
    ]),
    ("CC0-1.0", [
        "To the extent possible under law, the author(s) have dedicated all copyright and related and neighboring rights to "
        "this software to the public domain worldwide.",
    ]),
    ("CC0-1.0", ["You should have received a copy of the CC0 Public Domain Dedication along with this software."]),
    ("CC0-1.0", ["CC0 1.0 Universal"]),
    ("CC0-1.0", ["Licensed under CC0 1.0."]),
    ("Unlicense", ["This is free and unencumbered software released into the public domain."]),
    ("CC-BY-4.0", ["This work is licensed under the Creative Commons Attribution 4.0 International License."]),
    *(
        (licence, [f"This work is licensed under {article} Creative Commons Attribution-{kind} 4.0 International License."])
        for licence, kind in (("CC-BY-SA-4.0", "ShareAlike"), ("CC-BY-NC-4.0", "NonCommercial"))
        for article in ("a", "the")
    ),
    # cut after "v."
    ("MPL-2.0", ["This Source Code Form is subject to the terms of the Mozilla Public License, v."]),
]


# Identifiers of the SPDX list for the licences of the rules above.
IDENTIFIERS = [
    "MIT", "ISC", "BSD-2-Clause", "BSD-3-Clause", "Apache-2.0", "MPL-2.0", "GPL-2.0-only", "GPL-2.0-or-later",
    "GPL-3.0-only", "GPL-3.0-or-later", "LGPL-2.0-only", "LGPL-2.0-or-later", "LGPL-2.1-only", "LGPL-2.1-or-later",
    "LGPL-3.0-only", "LGPL-3.0-or-later", "AGPL-3.0-only", "AGPL-3.0-or-later", "CC-BY-4.0", "CC-BY-SA-4.0", "CC-BY-NC-4.0",
    "CC0-1.0", "Unlicense",
]
FURTHER += [(licence, [f"SPDX-License-Identifier {licence}"]) for licence in IDENTIFIERS]


def plain_form(sentence: str) -> str:
    """The normal form of a known sentence, which is ASCII."""
    return " ".join("".join(c if c.isascii() and c.isalnum() else " " for c in sentence.lower()).split())


def with_further() -> tuple[dict[int, str], list[tuple[str, list[int]]]]:
    """SENTENCES and RULES with those of FURTHER behind them."""
    sentences, rules = dict(SENTENCES), list(RULES)
    numbers = {plain_form(sentence): number for number, sentence in sentences.items()}
    for licence, notice in FURTHER:
        for sentence in notice:
            number = numbers.setdefault(plain_form(sentence), max(sentences) + 1)
            sentences.setdefault(number, sentence)
        rule = (licence, [numbers[plain_form(sentence)] for sentence in notice])
        if rule not in rules:
            rules.append(rule)
    return sentences, rules


ALL_SENTENCES, ALL_RULES = with_further()

# How sentences are cut and normalised, the same in Spark and DuckDB.
SENTENCE_END = "([.!?:])[ \\t\\r\\n]+"
LINE_END = "[ \\t\\r]*\\n[ \\t\\r]*"
OTHER = "[^a-z0-9]+"

# What ends a paragraph, in Spark only.
BLANK_LINE = "\\n[^\\p{L}\\p{N}\\n]*+(?=\\n)"
COPYRIGHT_LINE = (
    "(?md)^[^\\p{L}\\p{N}\\n]*(?:(?i:portions)[ \\t]+)?"
    "(?:(?:Copyright|COPYRIGHT)\\b(?![ \\t]+(?i:notices?|holders?|owners?|laws?|licen[cs]es?|statements?|and|or)\\b)"
    "|(?i:copyright)[ \\t:]*(?:\\([cC]\\)|©|[0-9]{4})|\\([cC]\\)[ \\t]*(?:[0-9]{4}|(?i:copyright))|©)[^\\n]*"
)
PARAGRAPH_END = "\u2029"

# List numbers before a sentence, and parts that are nothing else, in Spark only.
LIST_NUMBER = "(?:[0-9]{1,2}|[A-Za-z]|[ivxIVX]{1,4})"
NUMBERED = f"^[^\\p{{L}}\\p{{N}}]*+{LIST_NUMBER}[.)][ \\t]*"
NO_SENTENCE = f"^[^\\p{{L}}\\p{{N}}]*+(?:{LIST_NUMBER}[^\\p{{L}}\\p{{N}}]*+)?$"


# A third condition of BSD-3-Clause with some name, and the name it gets.
ANY_NAME = "^neither the names? of .+ nor the names of (its|their|any) contributors may be used"
ONE_NAME = "neither the name of the copyright holder nor the names of its contributors may be used"
# A line with an identifier, which no sentence end may cut.
IDENTIFIER_LINE = "(SPDX-License-Identifier):[ \\t]*"


def normal_form(sentence: Column) -> Column:
    form = F.btrim(F.regexp_replace(F.lower(sentence), OTHER, " "))
    return F.when(F.startswith(form, F.lit("neither the name")), F.regexp_replace(form, ANY_NAME, ONE_NAME)).otherwise(form)


def with_identifiers_whole(text: Column) -> Column:
    marked = F.regexp_replace(text, IDENTIFIER_LINE, "$1 ")
    return F.when(F.contains(text, F.lit("SPDX-License-Identifier:")), marked).otherwise(text)


def cut(text: Column) -> Column:
    return F.split(F.regexp_replace(text, SENTENCE_END, "$1\n"), "\n")


def paragraphs(text: Column) -> Column:
    """The text with a line per paragraph; null if it has neither blank lines nor copyright lines."""
    apart = F.regexp_replace(text, COPYRIGHT_LINE, "\n\n$0\n\n")
    marked = F.regexp_replace(F.regexp_replace(apart, BLANK_LINE, PARAGRAPH_END), LINE_END, " ")
    return F.when(text.rlike(BLANK_LINE) | text.rlike(COPYRIGHT_LINE), F.translate(marked, PARAGRAPH_END, "\n"))


def known_sentences(spark, sentences: dict[int, str]) -> DataFrame:
    rows = [(plain_form(sentence), number) for number, sentence in sentences.items()]
    return spark.createDataFrame(rows, "form string, sentence int")


def text_key(text: str) -> Column:
    body = F.coalesce(F.col(text), F.lit(""))
    return F.struct(F.xxhash64(body).alias("a"), F.xxhash64(F.lit(7), body).alias("b"))


def sequences(docs: DataFrame, text: str, sentences: dict[int, str]) -> DataFrame:
    """text_key, layout, sequence, n_sentences: identifiers as ``<3><4>``, a bar where sentences between are unknown."""
    body = with_identifiers_whole(F.col(text))
    flow = F.regexp_replace("body", LINE_END, " ")
    cuts = docs.filter(F.length(text) > 0).select(text_key(text).alias("text_key"), body.alias("body")).select(
        "text_key",
        F.explode(
            F.array(
                F.struct(F.lit("line").alias("layout"), cut(F.col("body")).alias("parts")),
                F.struct(F.lit("flow").alias("layout"), cut(flow).alias("parts")),
                F.struct(F.lit("paragraphs").alias("layout"), cut(paragraphs(F.col("body"))).alias("parts")),
            )
        ).alias("cut"),
    )
    sentences_only = F.filter("cut.parts", lambda part: ~part.rlike(NO_SENTENCE))
    parts = cuts.select("text_key", "cut.layout", F.posexplode(sentences_only).alias("place", "part"))
    # a shorter piece than any known sentence is none of them; a long one may be so for its blanks
    parts = parts.filter(F.length("part") >= min(map(len, map(plain_form, sentences.values()))))
    parts = parts.withColumn("form", normal_form(F.regexp_replace("part", NUMBERED, "")))
    # the table of known sentences has a fixed number of rows
    hits = parts.join(F.broadcast(known_sentences(docs.sparkSession, sentences)), "form")
    hits = hits.select("text_key", "layout", "place", "sentence").distinct()
    steps = F.array_sort(F.collect_list(F.struct("place", "sentence")))
    listed = hits.groupBy("text_key", "layout").agg(steps.alias("steps"))

    def token(step, i):
        before = F.when(i > 0, F.get(F.col("steps"), i - 1)["place"])
        gap = F.when(step["place"] == before + 1, F.lit("")).otherwise(F.lit("|"))
        return F.concat(gap, F.lit("<"), step["sentence"].cast("string"), F.lit(">"))

    return listed.select(
        "text_key",
        "layout",
        F.array_join(F.transform("steps", token), "").alias("sequence"),
        F.size("steps").alias("n_sentences"),
    )


def matches(sequence: Column, rules: list[tuple[str, list[int]]]) -> Column:
    """The licences of the rules that match, each rule on what those before it have left."""
    found = []
    for licence, numbers in rules:
        pattern = F.lit("".join(f"<{number}>" for number in numbers))
        found.append(F.when(F.contains(sequence, pattern), F.lit(licence)))
        sequence = F.replace(sequence, pattern, F.lit("|"))
    return F.array_distinct(F.array_compact(F.array(*found)))


def scan(
    docs: DataFrame,
    text: str = "text",
    sentences: dict[int, str] = ALL_SENTENCES,
    rules: list[tuple[str, list[int]]] = ALL_RULES,
) -> tuple[DataFrame, list[str]]:
    """The rows of ``docs`` with two columns more, and their names: licences (sorted), n_sentences."""
    licences, count = names = free_names(docs, "licences", "n_sentences")
    own, other = free_names(docs, "licence_doc_key", "licence_text_key")
    read = sequences(docs, text, sentences).withColumn("found", matches(F.col("sequence"), rules))
    by_text = read.groupBy(F.col("text_key").alias(other)).agg(
        F.array_sort(F.array_distinct(F.flatten(F.collect_list("found")))).alias(licences),
        F.max("n_sentences").alias(count),
    )
    # as a table it has one row per text, and a join with many copies of a text can be split at run time
    by_text = stored(by_text, "licences")
    result = docs.withColumn(own, text_key(text)).join(by_text, F.col(own) == F.col(other), "left")
    return result.select(
        *docs.columns,
        F.coalesce(F.col(licences), F.array().cast("array<string>")).alias(licences),
        F.coalesce(F.col(count), F.lit(0)).alias(count),
    ), names


def digest(docs: DataFrame) -> DataFrame:
    """doc_id, licences joined by commas, n_sentences."""
    result, (licences, count) = scan(docs.select("doc_id", "text"))
    return result.select(
        "doc_id", F.array_join(licences, ",").alias("licences"), F.col(count).cast("long").alias("n_sentences")
    )


def oracle_sql() -> str:
    """The same readings, sentences and rules in SQL whose regular expressions cannot look ahead."""
    known = ", ".join(f"('{plain_form(s)}', {number})" for number, s in ALL_SENTENCES.items())
    least = min(map(len, map(plain_form, ALL_SENTENCES.values())))
    sequence, tests = "sequence", []
    for licence, numbers in ALL_RULES:
        pattern = "".join(f"<{number}>" for number in numbers)
        tests.append(f"CASE WHEN contains({sequence}, '{pattern}') THEN '{licence}' END")
        sequence = f"replace({sequence}, '{pattern}', '|')"

    def cut_sql(column: str) -> str:
        return f"string_split(regexp_replace({column}, '{SENTENCE_END}', '\\1' || chr(10), 'g'), chr(10))"

    other, number = "[^\\p{L}\\p{N}]", LIST_NUMBER
    owner = f"^{other}*(?:(?i:portions)[ \\t]+)?"
    about = "(?i:notices?|holders?|owners?|laws?|licen[cs]es?|statements?|and|or)"
    named = "(?:Copyright|COPYRIGHT)"
    dated = (
        "(?:(?i:copyright)[ \\t:]*(?:\\([cC]\\)|©|[0-9]{4})|\\([cC]\\)[ \\t]*(?:[0-9]{4}|(?i:copyright))|©)"
    )
    is_copyright = f"""(regexp_matches(line, '{owner}{dated}') OR (regexp_matches(line, '{owner}{named}\\b')
      AND NOT regexp_matches(line, '{owner}{named}[ \\t]+{about}\\b')))"""
    blank = "(?:\\n[^\\p{L}\\p{N}\\n]*)+\\n"
    return f"""
WITH known(form, sentence) AS (VALUES {known}),
bodies AS (
  SELECT doc_id, regexp_replace(text, '{IDENTIFIER_LINE}', '\\1 ', 'g') AS body FROM documents WHERE length(text) > 0
), lines AS (
  SELECT doc_id, unnest(string_split(body, chr(10))) AS line, generate_subscripts(string_split(body, chr(10)), 1) AS line_number
  FROM bodies
), apart AS (
  SELECT doc_id, bool_or({is_copyright}) AS owned, string_agg(
    CASE WHEN {is_copyright} THEN chr(10) || chr(10) || line || chr(10) || chr(10) ELSE line END, chr(10) ORDER BY line_number
  ) AS body
  FROM lines GROUP BY doc_id
), readings AS (
  SELECT doc_id, 'line' AS layout, body FROM bodies
  UNION ALL
  SELECT doc_id, 'flow', regexp_replace(body, '{LINE_END}', ' ', 'g') FROM bodies
  UNION ALL
  SELECT doc_id, 'paragraphs',
    replace(regexp_replace(regexp_replace(a.body, '{blank}', chr(8233), 'g'), '{LINE_END}', ' ', 'g'), chr(8233), chr(10))
  FROM apart a JOIN bodies b USING (doc_id)
  WHERE owned OR regexp_matches(b.body, '{blank}')
), cuts AS (
  SELECT doc_id, layout, list_filter({cut_sql("body")}, lambda p:
    NOT regexp_matches(p, '^{other}*(?:{number}{other}*)?$')) AS parts
  FROM readings
), parts AS (
  SELECT doc_id, layout, unnest(parts) AS part, generate_subscripts(parts, 1) AS place FROM cuts
), forms AS (
  SELECT *, trim(regexp_replace(lower(regexp_replace(part, '^{other}*{number}[.)][ \\t]*', '')), '{OTHER}', ' ', 'g')) AS form
  FROM parts WHERE length(part) >= {least}
), hits AS (
  SELECT DISTINCT doc_id, layout, place, sentence
  FROM forms f JOIN known k ON regexp_replace(f.form, '{ANY_NAME}', '{ONE_NAME}') = k.form
), steps AS (
  SELECT *, lag(place) OVER (PARTITION BY doc_id, layout ORDER BY place) AS before FROM hits
), read AS (
  SELECT doc_id, layout, count(*) AS n_sentences,
    string_agg(CASE WHEN place = before + 1 THEN '' ELSE '|' END || '<' || sentence || '>', '' ORDER BY place) AS sequence
  FROM steps GROUP BY doc_id, layout
), found AS (
  SELECT doc_id, n_sentences, unnest([{", ".join(tests)}]) AS licence FROM read
), by_doc AS (
  SELECT doc_id, string_agg(DISTINCT licence, ',' ORDER BY licence) AS licences, max(n_sentences) AS n_sentences
  FROM found GROUP BY doc_id
)
SELECT doc_id, coalesce(licences, '') AS licences, coalesce(n_sentences, 0) AS n_sentences
FROM documents LEFT JOIN by_doc USING (doc_id)
"""


ORACLE_SQL = oracle_sql()
