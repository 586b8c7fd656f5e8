"""Licence scans of notices as they occur in files."""

import textwrap

from footfall.llm import licences

DDL = "doc_id long, text string, licences string, form int"
S = licences.SENTENCES


def found(spark, texts, **how):
    docs = spark.createDataFrame([(i, t, "x", 1) for i, t in enumerate(texts)], DDL)
    result, (names, count) = licences.scan(docs, **how)
    assert result.columns == [*docs.columns, names, count]
    rows = sorted(result.collect(), key=lambda r: r.doc_id)
    return [(r[names], r[count]) for r in rows]


def test_notices(spark):
    texts = [
        "Some prose here. And more.\n" + S[1] + "\nOther prose.",
        "prose; " + S[1],  # part of another sentence
        f"{S[3]} {S[4]}",
        "\n".join(textwrap.wrap(f"Copyright x. {S[3]} {S[4]} The end.", 60)),
        f"{S[9]} {S[21]}\n{S[10]}\n{S[11]}",
        f"{S[9]} {S[21]} Unknown between them. {S[10]}",
        f"{S[16]} {S[17]} {S[18]}",
        f"{S[16]} {S[17]}",
        f"{S[17]} {S[16]}",  # wrong order
        f"{S[12]} {S[8]} {S[12]}",
        S[6].upper() + "   " + S[7].replace(" ", "  "),
        S[20],
        None, "", " \n ", "word " * 50_000 + ". " + S[5],
    ]
    result = found(spark, texts)
    assert result == [
        (["MIT"], 1), ([], 0), (["MIT"], 2), (["MIT"], 2), (["GPL-3.0-or-later"], 4), (["GPL-3.0-or-later"], 3),
        (["BSD-3-Clause"], 3), (["BSD-2-Clause"], 2), ([], 2), (["CC-BY-NC-4.0", "GPL-3.0"], 3), (["Apache-2.0"], 2),
        ([], 1), ([], 0), ([], 0), ([], 0), (["Apache-2.0"], 1),
    ]


def test_blanks_of_any_length(spark):
    texts = ["Released under the" + " " * 2000 + "MIT License.", "- " * 3000 + S[5], "x" * 5000 + ". " + S[5]]
    assert found(spark, texts) == [(["MIT"], 1), (["Apache-2.0"], 1), (["Apache-2.0"], 1)]


def test_names_in_conditions(spark):
    named = S[18].replace("copyright holder", "University of Nowhere")
    plural = S[18].replace("name of the copyright holder", "names of A. Author and Sons").replace("its", "their")
    numbered = f"1. {S[16]}\n2. {S[17]}\n3. {named}"
    other = "Neither the name of the game nor the rules matter."
    assert found(spark, [f"{S[16]} {S[17]} {named}", numbered, named, f"{S[16]} {S[17]} {other}"]) == [
        (["BSD-3-Clause"], 3), (["BSD-3-Clause"], 3), ([], 1), (["BSD-2-Clause"], 2)
    ]
    assert found(spark, [f"{S[16]} {S[17]} {plural.replace('A. ', 'A ')}"]) == [(["BSD-3-Clause"], 3)]


def test_identifier_lines_and_articles(spark):
    texts = [
        "// SPDX-License-Identifier: Apache-2.0\nint main() {}", "# SPDX-License-Identifier:MIT", " * SPDX-License-Identifier: GPL-2.0-only\n */",
        "SPDX-License-Identifier: Unknown-1.0", "SPDX-License-Identifier: MIT AND ISC",
        "This work is licensed under the Creative Commons Attribution 4.0 International License.",
        "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
    ]
    assert [names for names, _ in found(spark, texts)] == [
        ["Apache-2.0"], ["MIT"], ["GPL-2.0-only"], [], [], ["CC-BY-4.0"], ["CC-BY-SA-4.0"]
    ]


def test_rules_take_sentences_in_their_order(spark):
    rules = [("both", [1, 2]), ("second", [2])]
    assert found(spark, [f"{S[1]} {S[2]}", f"{S[1]} {S[2]} {S[2]}", S[2], S[1]], rules=rules) == [
        (["both"], 2), (["both", "second"], 3), (["second"], 1), ([], 1)
    ]


def test_copies_and_empty_table(spark):
    assert found(spark, [S[1]] * 7) == [(["MIT"], 1)] * 7
    assert licences.digest(spark.createDataFrame([], DDL)).count() == 0


def test_known_sentences_are_cut_and_normalised_as_themselves(spark):
    docs = spark.createDataFrame([(i, s, "x", 1) for i, s in S.items()], DDL)
    hits = {(r.layout, r.sequence) for r in licences.sequences(docs, "text", S).collect()}
    assert hits == {(layout, f"|<{i}>") for i in S for layout in ("line", "flow")}
