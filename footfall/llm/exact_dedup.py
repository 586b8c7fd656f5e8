"""Exact deduplication by an extendible-hash index that lives in shared files.

The key of a text is the 64-bit hash of its normal form (white space deleted). Three kinds
of shared files make up the index:

* chains: one row per key, normal form and length. Building them compares whole normal forms
  byte by byte, so two texts with one key but other bytes stay apart on the key's chain.
  Copies collapse on the map side, whatever their number.
* directory: one row per bucket, the leading bits that its keys share. It starts with the
  depth that fits the number of keys; while a bucket holds more than ``capacity`` keys, the
  directory doubles and that bucket splits by one more bit. Copies of one text count once, so
  no group of copies can overfill a bucket.
* entries: what each class of equal texts keeps, written by owner tasks, each of which
  processes a range of buckets.

All of it is DataFrame code. Defined cases: a null text is the empty text; all texts that
normalise to nothing form one class; a null ``doc_id`` is larger than any other; of rows that
repeat id and text, the one with the least hash of its other columns is kept; an empty table gives an empty result.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from footfall.llm.common import ASCII_SPACE, free_names, stored

KEY_BITS = 64
#: Lanes of rows that repeat id and text.
LANES = 4096


def normal_form(text: Column) -> Column:
    """The text without its ASCII white space."""
    form = F.coalesce(text, F.lit(""))
    for blank in ASCII_SPACE:
        form = F.replace(form, F.lit(blank), F.lit(""))
    return form


def prefix(key: str, depth: int) -> Column:
    """The leading ``depth`` bits of a key as a long."""
    return F.shiftrightunsigned(F.col(key), KEY_BITS - depth) if depth else F.lit(0).cast("long")


def build_chains(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    """key, text_sha256, n_points, rows, first_id: equal normal forms of one length."""
    return stored(
        docs.select(
            F.xxhash64(normal_form(F.col(text))).alias("key"),
            normal_form(F.col(text)).alias("form"),
            F.length(F.coalesce(F.col(text), F.lit(""))).alias("n_points"),
            F.col(doc_id).alias("doc_id"),
        )
        .groupBy("key", "form", "n_points")
        .agg(F.count(F.lit(1)).alias("rows"), F.min("doc_id").alias("first_id"))
        .select("key", F.sha2(F.col("form").cast("binary"), 256).alias("text_sha256"), "n_points", "rows", "first_id"),
        "dedup-chains",
    )


def build_directory(chains: DataFrame, capacity: int) -> list[tuple[int, DataFrame]]:
    """Buckets by depth: (depth, rows of ``prefix`` and ``bucket_keys``), no bucket over ``capacity``."""
    keys = stored(chains.select("key").distinct(), "dedup-keys")
    n_keys = keys.count()
    depth = max(0, math.ceil(math.log2(max(1, n_keys) / capacity)))
    levels = []
    while True:
        cells = stored(
            keys.groupBy(prefix("key", depth).alias("prefix")).agg(F.count(F.lit(1)).alias("bucket_keys")),
            f"dedup-directory-{depth}",
        )
        levels.append((depth, cells.filter(F.col("bucket_keys") <= capacity)))
        overfull = cells.filter(F.col("bucket_keys") > capacity).select(F.col("prefix").alias("full"))
        # two keys differ somewhere in 64 bits, so at that depth no bucket holds two
        if depth == KEY_BITS or overfull.isEmpty():
            return levels
        keys = stored(keys.join(overfull, prefix("key", depth) == F.col("full"), "left_semi"), f"dedup-keys-{depth}")
        depth += 1


def build_entries(chains: DataFrame, levels: list[tuple[int, DataFrame]]) -> DataFrame:
    """What each class keeps: bucket, key, text_sha256, keep_id, keep_points, group_size.

    Owner tasks take ranges of buckets, in the order of their keys, and write them sorted.
    """
    in_buckets = None
    for depth, buckets in levels:
        part = chains.join(
            buckets.select(F.col("prefix").alias("own_prefix")), prefix("key", depth) == F.col("own_prefix")
        ).withColumn("bucket", F.shiftleft(F.col("own_prefix"), KEY_BITS - depth) if depth else F.lit(0).cast("long"))
        in_buckets = part if in_buckets is None else in_buckets.unionByName(part)
    owned = in_buckets.repartitionByRange("bucket").groupBy("bucket", "key", "text_sha256")
    # one chain row per length, so the longest is one row
    return stored(
        owned.agg(
            F.max_by("first_id", "n_points").alias("keep_id"),
            F.max("n_points").alias("keep_points"),
            F.sum("rows").alias("group_size"),
        ).sortWithinPartitions("bucket", "key"),
        "dedup-entries",
    )


def matched(docs: DataFrame, doc_id: str, text: str, capacity: int) -> tuple[DataFrame, dict[str, str]]:
    """Each row of ``docs`` with the entry of its class; the columns' names by their meaning.

    A class of any size is one entry, and no step on top needs its rows in one task, so a join
    partition with a large group of copies is split at run time.
    """
    meanings = "keep_id group_size kept text_sha256 key points keep_points salt turn row_hash entry_key entry_sha".split()
    name = dict(zip(meanings, free_names(docs, *meanings)))
    chains = build_chains(docs, doc_id, text)
    entries = build_entries(chains, build_directory(chains, capacity)).select(
        F.col("key").alias(name["entry_key"]),
        F.col("text_sha256").alias(name["entry_sha"]),
        F.col("keep_id").alias(name["keep_id"]),
        F.col("keep_points").alias(name["keep_points"]),
        F.col("group_size").alias(name["group_size"]),
    )
    keyed = docs.withColumns(
        {
            name["key"]: F.xxhash64(normal_form(F.col(text))),
            name["text_sha256"]: F.sha2(normal_form(F.col(text)).cast("binary"), 256),
            name["points"]: F.length(F.coalesce(F.col(text), F.lit(""))),
        }
    )
    same = (F.col(name["key"]) == F.col(name["entry_key"])) & (F.col(name["text_sha256"]) == F.col(name["entry_sha"]))
    found = keyed.join(entries, same)
    stays = F.col(doc_id).eqNullSafe(F.col(name["keep_id"])) & (F.col(name["points"]) == F.col(name["keep_points"]))
    return found.withColumn(name["kept"], stays), name


def with_row_hash(found: DataFrame, name: dict[str, str], columns: list[str]) -> DataFrame:
    """Orders rows that repeat id and text, however they lie; equal rows are as good as each other."""
    hashed = [c for c in columns if not isinstance(found.schema[c].dataType, T.MapType)]
    return found.withColumn(name["row_hash"], F.xxhash64(*hashed))


def first_of_repeats(found: DataFrame, name: dict[str, str]) -> DataFrame:
    """``kept`` for one row only where rows repeat id and text.

    Any number of such rows is spread over lanes, of which each has a first row; rows that go
    anyway are spread for good.
    """
    lanes = [name["key"], name["text_sha256"], name["kept"], name["salt"]]
    found = found.withColumn(name["salt"], F.pmod(F.monotonically_increasing_id(), F.lit(LANES)))
    for _ in range(2):
        # dealt anew, so that the join below can be split where a class is large
        found = found.repartition(*lanes)
        turn = F.row_number().over(Window.partitionBy(*lanes).orderBy(name["row_hash"]))
        found = found.withColumn(name["turn"], turn)
        found = found.withColumn(name["kept"], F.col(name["kept"]) & (F.col(name["turn"]) == 1))
        found = found.withColumn(name["salt"], F.when(F.col(name["kept"]), F.lit(-1)).otherwise(F.col(name["salt"])))
    return found


def exact_dedup(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", capacity: int = 100_000
) -> tuple[DataFrame, list[str]]:
    """The rows of ``docs`` with four columns more, and the names of those columns.

    keep_id, group_size, kept, text_sha256; a name that ``docs`` has already gets underscores.
    Of equal texts the one with the most code points stays, then the smallest id.
    """
    found, name = matched(docs, doc_id, text, capacity)
    names = [name[meaning] for meaning in ("keep_id", "group_size", "kept", "text_sha256")]
    found = first_of_repeats(with_row_hash(found, name, docs.columns), name)
    return found.select(*docs.columns, *names), names


def one_of_each(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", capacity: int = 100_000) -> DataFrame:
    """The rows of ``docs`` that stay."""
    found, name = matched(docs, doc_id, text, capacity)
    # what stays is dealt anew, so that the join below can be split where a class is large
    found = with_row_hash(found.filter(name["kept"]), name, docs.columns).repartition(name["key"], name["text_sha256"])
    turn = F.row_number().over(Window.partitionBy(name["key"], name["text_sha256"]).orderBy(name["row_hash"]))
    return found.withColumn(name["turn"], turn).filter(F.col(name["turn"]) == 1).select(*docs.columns)


def digest(docs: DataFrame) -> DataFrame:
    """One row per document: which row of its class stays."""
    result, (keep_id, group_size, kept, text_sha256) = exact_dedup(docs.select("doc_id", "text"))
    return result.select("doc_id", keep_id, group_size, kept, text_sha256)


ORACLE_SQL = """
WITH forms AS (
  SELECT doc_id, length(coalesce(text, '')) AS n_points,
    sha256(regexp_replace(coalesce(text, ''), '[\\x20\\x09-\\x0D]', '', 'g')) AS text_sha256
  FROM documents
)
SELECT doc_id,
  first_value(doc_id) OVER stay AS keep_id,
  count(*) OVER (PARTITION BY text_sha256) AS group_size,
  row_number() OVER stay = 1 AS kept,
  text_sha256
FROM forms
WINDOW stay AS (PARTITION BY text_sha256 ORDER BY n_points DESC, doc_id)
"""
