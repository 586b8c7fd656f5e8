"""Shards from a consistent-hash ring with virtual nodes and bounded loads.

Every shard has ``points`` virtual nodes on a ring of 64-bit hashes; they cut the ring into arcs,
and a row's home is the shard of the first point at or after the hash of its key. A shard takes at
most ``(1 + slack)`` of the mean number of rows. Rows that a full shard cannot take continue
clockwise to the next shard with room, in rounds, until all have a place.

How many rows go on depends on nothing but the number of rows in each arc. So the rows are only
counted by arc; the rounds are played on those ``shards * points`` numbers, which are all that the
driver holds, and give for each arc ranges of ranks with a shard and a first slot. Of rows that meet
at a shard without room for all, each arc keeps its proportion (rounded so that the shard is exactly
full). Ranks within an arc follow a second hash of the key, so that the rows an arc gives away stay
nearly the same when a shard joins. Ranks are taken over ranges of rows, so an arc of any size, such
as that of one key with a third of all rows, is spread over many tasks.

``slack=0`` gives shards whose counts are at most one apart; more slack moves fewer rows when the
number of shards changes, down to the plain ring's share of ``1 / (shards + 1)``.

Defined cases: a null text has no bytes and checksum 0; rows without an id share one point of the
ring; rows that repeat an id, equal or not, are rows of their own; ties of the second hash go by id,
size and checksum; an empty table gives no rows; other columns travel along on request, whatever
their names.
"""

from __future__ import annotations

from fractions import Fraction

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from footfall.llm.common import free_names, stored, with_ranks

SHARDS = 16
POINTS = 256
SEED = 42


def ring(shards: int, points: int) -> tuple[np.ndarray, np.ndarray]:
    """The hashes of all virtual nodes in order, as signed longs, and the shard of each."""
    hashes = [xxhash.xxh64_intdigest(f"{shard}/{point}", SEED) for shard in range(shards) for point in range(points)]
    position = np.array(hashes, np.uint64).view(np.int64)
    owner = np.repeat(np.arange(shards), points)
    order = np.lexsort((owner, position))
    return position[order], owner[order]


def arc_of(position: Column, points: np.ndarray) -> Column:
    """The arc that a hash lies in: the number of the first point at or after it."""

    @F.pandas_udf("int")
    def lookup(hashes: pd.Series) -> pd.Series:
        return pd.Series(np.searchsorted(points, hashes.to_numpy(np.int64)) % len(points), dtype="int32")

    return lookup(position)


def capacities(rows: int, shards: int, slack: float) -> list[int]:
    """The rows that each shard may take; without slack they add up to all rows."""
    if slack < 0:
        raise ValueError("slack must not be negative")
    if not slack:
        return [rows // shards + (shard < rows % shards) for shard in range(shards)]
    room = Fraction(slack) * rows / shards + Fraction(rows, shards)
    return [-(-room.numerator // room.denominator)] * shards


def next_open(owner: np.ndarray, is_open: np.ndarray) -> np.ndarray:
    """For each arc the first shard with room, clockwise from the arc's own."""
    arcs = len(owner)
    here = np.where(is_open[owner], np.arange(arcs), 2 * arcs)
    ahead = np.minimum.accumulate(np.concatenate([here, here + arcs])[::-1])[::-1][:arcs]
    return owner[ahead % arcs]


def overflowed(counts: list[int], owner: np.ndarray, capacity: list[int]) -> list[list[tuple[int, int, int]]]:
    """For each arc its (end, shard, shift), by rising end: ranks below ``end`` have slot rank + shift.

    Every round but the last fills a shard, so there are at most as many rounds as shards.
    """
    left, done = list(counts), [0] * len(counts)
    load = [0] * len(capacity)
    cuts: list[list[tuple[int, int, int]]] = [[] for _ in counts]
    while any(left):
        is_open = np.array([have < may for have, may in zip(load, capacity)])
        goal = next_open(owner, is_open)
        for shard in np.flatnonzero(is_open).tolist():
            arcs = [arc for arc in np.flatnonzero(goal == shard).tolist() if left[arc]]
            arriving, room = sum(left[arc] for arc in arcs), capacity[shard] - load[shard]
            come = kept = 0
            for arc in arcs:
                come += left[arc]
                until = come if arriving <= room else come * room // arriving
                take, kept = until - kept, until
                if take:
                    cuts[arc].append((done[arc] + take, shard, load[shard] - done[arc]))
                    done[arc] += take
                    left[arc] -= take
                    load[shard] += take
    return cuts


def place(
    docs: DataFrame,
    shards: int = SHARDS,
    points: int = POINTS,
    slack: float = 0.0,
    doc_id: str = "doc_id",
    text: str = "text",
    carry: list[str] | None = None,
) -> DataFrame:
    """doc_id, size, text_crc32, shard, slot of every row; with ``carry`` also those columns, as ``row``.

    ``size`` is the text's UTF-8 bytes and one, ``slot`` the row's number in its shard.
    """
    spark = docs.sparkSession
    position, owner = ring(shards, points)
    key, utf8 = F.col(doc_id).cast("string"), F.coalesce(F.col(text).cast("binary"), F.lit(b""))
    rows = docs.select(
        F.col(doc_id).alias("doc_id"),
        (F.length(utf8).cast("long") + 1).alias("size"),
        F.crc32(utf8).alias("text_crc32"),
        arc_of(F.xxhash64(key), position).alias("arc"),
        F.xxhash64(key, F.lit(1)).alias("priority"),
        F.monotonically_increasing_id().alias("row_number"),
        *([F.struct(*carry).alias("row")] if carry else []),
    )
    order = ["priority", "doc_id", "size", "text_crc32", "row_number"]
    ranked = with_ranks(stored(rows, "sharding-rows"), ["arc"], order, "rank", "sharding-ranks")

    counts = dict(ranked.groupBy("arc").agg(F.max("rank")).collect())  # one number per arc
    by_arc = [counts.get(arc, -1) + 1 for arc in range(len(owner))]
    cuts = overflowed(by_arc, owner, capacities(sum(by_arc), shards, slack))
    ranges = spark.createDataFrame(
        [(arc, cut) for arc, cut in enumerate(cuts)], "arc int, cuts array<struct<end: long, shard: int, shift: long>>"
    )
    # shards * points rows with at most as many cuts as shards each, whatever the input
    placed = ranked.join(F.broadcast(ranges), "arc").withColumn(
        "cut", F.filter("cuts", lambda cut: F.col("rank") < cut["end"])[0]
    )
    return placed.select(
        "doc_id", "size", "text_crc32", F.col("cut.shard").alias("shard"),
        (F.col("rank") + F.col("cut.shift")).alias("slot"), *(["row"] if carry else []),
    )


def write_shards(docs: DataFrame, path: str, **how) -> None:
    """Whole rows below ``path/shard=...``, each with its slot; existing names keep their meaning."""
    shard, slot = free_names(docs, "shard", "slot")
    placed = place(docs, carry=docs.columns, **how)
    rows = placed.select("row.*", F.col("slot").alias(slot), F.col("shard").alias(shard))
    rows.write.partitionBy(shard).option("compression", "zstd").parquet(path)


def digest(docs: DataFrame) -> DataFrame:
    """Counts at most one apart."""
    return place(docs).select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )
