"""Removal of boilerplate lines by the number of distinct sites they occur on.

Every line hash gets a HyperLogLog sketch of its sites; sketches merge by aggregation, so a line
that is everywhere costs one small row per task. A line far above ``min_sites`` is boilerplate, a
line far below it is not. For lines whose estimate is so near that the sketch's error might
decide, the distinct sites are counted exactly. Boilerplate lines then go from all texts, the
same line repeated within one site does not count.

A line's normal form is the line without blanks at its ends; its key has 128 bits. Lines whose
normal form has fewer than ``min_chars`` characters stay. All of it is DataFrame code.

Defined cases: a null text is the empty text; a null site counts as no site; equal texts are
cleaned alike, repeated rows give repeated rows; an empty table gives an empty result.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from footfall.llm.common import free_names, stored

BLANKS = " \t\r"


def form_of(line: Column) -> Column:
    return F.btrim(line, F.lit(BLANKS))


def key_of(text: Column) -> Column:
    """128 bits: two hashes that do not depend on each other."""
    return F.struct(F.xxhash64(text).alias("a"), F.xxhash64(F.lit(7), text).alias("b"))


def lines_of(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), "\n")


def long_lines(docs: DataFrame, text: str, min_chars: int, *others: Column) -> DataFrame:
    """The given columns and ``key`` for each line that is long enough."""
    lines = docs.select(*others, F.explode(lines_of(F.col(text))).alias("line"))
    lines = lines.withColumn("line", form_of(F.col("line"))).filter(F.length("line") >= min_chars)
    return lines.withColumn("key", key_of(F.col("line"))).drop("line")


def marks(places: Column) -> Column:
    """For sorted places, an array that is true there, up to the last; linear in its length."""
    before = lambda i: F.when(i > 0, F.get(places, i - 1)).otherwise(-1)
    runs = F.transform(places, lambda place, i: F.concat(F.repeat(F.lit("0"), place - before(i) - 1), F.lit("1")))
    return F.transform(F.split(F.array_join(runs, ""), ""), lambda mark: mark == "1")


def boilerplate(
    docs: DataFrame, site: str, text: str, min_sites: int, min_chars: int, precision: int
) -> DataFrame:
    """key: the lines that occur on at least ``min_sites`` sites."""
    lines = long_lines(docs, text, min_chars, F.col(site).alias("site"))
    spread = stored(
        lines.groupBy("key").agg(F.hll_sketch_estimate(F.hll_sketch_agg("site", precision)).alias("sites")),
        "line-spread",
    )
    margin = 6 * 1.04 / math.sqrt(2**precision)  # six standard errors
    near = F.col("sites").between(math.floor(min_sites * (1 - margin)), math.ceil(min_sites * (1 + margin)))
    exact = (
        lines.join(spread.filter(near).select("key"), "key", "left_semi")
        .groupBy("key")
        .agg(F.count_distinct("site").alias("sites"))
    )
    sure = spread.filter(~near)
    return stored(sure.unionByName(exact).filter(F.col("sites") >= min_sites).select("key"), "boilerplate")


def without_boilerplate(
    docs: DataFrame,
    site: str = "source",
    text: str = "text",
    min_sites: int = 10,
    min_chars: int = 12,
    precision: int = 12,
) -> tuple[DataFrame, list[str]]:
    """The rows of ``docs`` with three columns more, and their names.

    cleaned, the text without boilerplate lines; n_lines and removed_lines.
    """
    names = free_names(docs, "cleaned", "n_lines", "removed_lines")
    cleaned, n_lines, removed = names
    doc_key, text_key, drop, lines = free_names(docs, "lines_doc_key", "lines_text_key", "lines_drop", "lines_all")
    common = boilerplate(docs, site, text, min_sites, min_chars, precision)
    # few lines are boilerplate; equal texts hold the same ones, so each task sends a text's once
    lines_in = docs.select(
        key_of(F.coalesce(F.col(text), F.lit(""))).alias("text_key"), F.posexplode(lines_of(F.col(text))).alias("place", "line")
    )
    lines_in = lines_in.withColumn("line", form_of(F.col("line"))).filter(F.length("line") >= min_chars)
    hits = lines_in.select("text_key", "place", key_of(F.col("line")).alias("key")).join(common, "key")
    hits = hits.select("text_key", "place").distinct()
    by_text = hits.groupBy(F.col("text_key").alias(text_key)).agg(F.sort_array(F.collect_list("place")).alias("places"))
    # as a table it has one row per text, and a join with many copies of a text can be split at run time
    by_text = stored(by_text.select(text_key, marks(F.col("places")).alias(drop)), "lines-to-drop")
    found = docs.withColumn(doc_key, key_of(F.coalesce(F.col(text), F.lit(""))))
    found = found.join(by_text, F.col(doc_key) == F.col(text_key), "left").withColumn(lines, lines_of(F.col(text)))
    stays = lambda line, i: ~F.coalesce(F.get(F.col(drop), i), F.lit(False))
    stay = F.when(F.col(drop).isNull(), F.col(lines)).otherwise(F.filter(F.col(lines), stays))
    found = found.withColumn(drop, stay)
    result = found.select(
        *docs.columns,
        F.array_join(drop, "\n").alias(cleaned),
        F.size(lines).alias(n_lines),
        (F.size(lines) - F.size(drop)).alias(removed),
    )
    return result, names


def digest(docs: DataFrame) -> DataFrame:
    """doc_id, n_lines, removed_lines, and the length and digest of the cleaned text."""
    result, (cleaned, n_lines, removed) = without_boilerplate(docs.select("doc_id", "source", "text"))
    return result.select(
        "doc_id",
        F.col(n_lines).cast("long").alias("n_lines"),
        F.col(removed).cast("long").alias("removed_lines"),
        F.length(cleaned).cast("long").alias("cleaned_chars"),
        F.sha2(F.col(cleaned).cast("binary"), 256).alias("cleaned_sha256"),
    )


ORACLE_SQL = """
WITH lines AS (
  SELECT doc_id, source, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
    generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS place
  FROM documents
), common AS (
  SELECT trim(line, ' ' || chr(9) || chr(13)) AS form
  FROM lines
  GROUP BY 1
  HAVING count(DISTINCT source) >= 10 AND length(form) >= 12
), marked AS (
  SELECT doc_id, line, place, trim(line, ' ' || chr(9) || chr(13)) IN (SELECT form FROM common) AS goes
  FROM lines
), cleaned AS (
  SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE goes) AS removed_lines,
    coalesce(string_agg(line, chr(10) ORDER BY place) FILTER (WHERE NOT goes), '') AS cleaned
  FROM marked GROUP BY doc_id
)
SELECT doc_id, n_lines, removed_lines, length(cleaned) AS cleaned_chars, sha256(cleaned) AS cleaned_sha256
FROM cleaned
"""
