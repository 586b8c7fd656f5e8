"""Near-duplicates by SimHash, compared bit-sliced.

A text's fingerprint has 64 bits; a bit is 1 if more than half of the hashes of its word
shingles have it. Two fingerprints link if they differ in at most ``radius`` bits, and a
component is what links reach.

Comparing. The 64 bits are cut into ``radius + 2`` blocks. Two fingerprints within the radius
agree on at least two blocks, so every pair of blocks makes a bucket key, and only fingerprints
of one bucket are compared. Inside a bucket they are stored as bit planes: word j of plane b
holds bit b of 64 fingerprints. One query is compared with 64 at a time: each plane is XORed
with the query's bit and added to counters that are bit planes themselves, two planes at a time
by a carry-save adder. After every eight planes, words whose 64 counters all exceed the radius
are abandoned. A bucket of any size is cut into blocks of at most ``block`` fingerprints, and
each pair of blocks is a piece of work of its own, so none grows with the bucket. A piece
gives a spanning forest of its links, not the pairs: at most one row per fingerprint.

Linking. Alternate large-star and small-star steps over the forest rows, in shared tables, until
nothing changes. Only distinct fingerprints take part, so copies of a text cost nothing here.

Defined cases: null and empty texts and texts without a word have fingerprint zero; a text with
fewer words than a shingle has one shingle, the whole; repeated rows share fingerprint and
component; null ids are larger than any other (a component of null ids only has a null id); an
empty table gives an empty result.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from footfall.llm.common import free_names, stored

BITS = 64
LANES = 64
SEED = 42
PLANES_PER_CHECK = 8
ITEMS = 1 << 15


def fingerprint(text: str | None, width: int) -> int:
    """The signed 64-bit SimHash of one text."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    if len(words) <= width:
        hashes = np.array([xxhash.xxh64_intdigest(joined, SEED)], np.uint64)
    else:
        lengths = np.fromiter(map(len, words), np.int64, len(words))
        ends = np.cumsum(lengths + 1) - 1
        starts = ends - lengths
        spans = zip(starts[: len(words) - width + 1].tolist(), ends[width - 1 :].tolist())
        digest = xxhash.xxh64_intdigest
        hashes = np.fromiter((digest(joined[a:b], SEED) for a, b in spans), np.uint64, len(words) - width + 1)
    ones = np.zeros(BITS, np.int64)
    for part in range(0, len(hashes), 1 << 16):  # bounded memory for texts of any length
        some = hashes[part : part + (1 << 16)].view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(some, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    bits = np.packbits(2 * ones > len(hashes), bitorder="little")
    return int(bits.view(np.int64)[0])


def with_fingerprints(docs: DataFrame, text: str, into: str, width: int = 3) -> DataFrame:
    """``docs`` with the fingerprint as a long; only the text goes to Python."""

    @F.pandas_udf("long")
    def of(texts: pd.Series) -> pd.Series:
        return pd.Series([fingerprint(t, width) for t in texts], dtype="int64")

    return docs.withColumn(into, of(F.col(text)))


def bucket_keys(fp: str, radius: int):
    """One key per pair of blocks: the pair's number above, then the bits of both blocks.

    A block has at most 64 / (radius + 2) bits, rounded up, so both fit under the number.
    """
    blocks = radius + 2
    edges = [BITS * i // blocks for i in range(blocks + 1)]

    def part(i):
        bits = edges[i + 1] - edges[i]
        return F.shiftrightunsigned(F.col(fp), edges[i]).bitwiseAND(F.lit((1 << bits) - 1)), bits

    keys = []
    for number, (i, j) in enumerate(itertools.combinations(range(blocks), 2)):
        (low, low_bits), (high, _) = part(i), part(j)
        keys.append(
            F.struct(
                F.lit(number).alias("blocks"), F.shiftleft(high, low_bits).bitwiseOR(low).alias("bits")
            )
        )
    return F.array(*keys)


def to_planes(values: np.ndarray) -> np.ndarray:
    """uint64 values, 64 per word, as planes: row b, column w holds bit b of values 64 w ... 64 w + 63."""
    lanes = np.zeros(-(-len(values) // LANES) * LANES, np.uint64)
    lanes[: len(values)] = values
    bits = np.unpackbits(lanes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")  # value, bit
    packed = np.packbits(bits.reshape(-1, LANES, BITS).transpose(2, 0, 1), axis=2, bitorder="little")
    return np.ascontiguousarray(packed).view(np.uint64)[..., 0]


def within_radius(queries: np.ndarray, planes: np.ndarray, radius: int) -> np.ndarray:
    """For query i and word i (column of ``planes``) the lanes at a distance of at most ``radius``.

    Counters are kept modulo 2 ** depth with a sticky overflow, all as bit planes.
    """
    depth = (radius + 1).bit_length()
    result = np.zeros(len(queries), np.uint64)
    alive = np.arange(len(queries))
    counters = [np.zeros(len(queries), np.uint64) for _ in range(depth)]
    over = np.zeros(len(queries), np.uint64)
    one = np.uint64(1)

    def exceeds():
        """Lanes whose counter is above the radius: a bitwise comparison, highest plane first."""
        above, equal = over.copy(), ~over
        for level in reversed(range(depth)):
            if radius >> level & 1:
                equal &= counters[level]
            else:
                above |= equal & counters[level]
                equal &= ~counters[level]
        return above

    for bit in range(0, BITS, 2):
        own = queries[alive]
        first = planes[bit, alive] ^ (np.uint64(0) - (own >> np.uint64(bit) & one))
        second = planes[bit + 1, alive] ^ (np.uint64(0) - (own >> np.uint64(bit + 1) & one))
        # carry-save: three planes of one weight become a sum and a carry of the next weight
        half = counters[0] ^ first
        carry = (counters[0] & first) | (half & second)
        counters[0] = half ^ second
        for level in range(1, depth):
            counters[level], carry = counters[level] ^ carry, counters[level] & carry
        over |= carry
        if (bit + 2) % PLANES_PER_CHECK == 0:
            lanes = ~exceeds()
            keep = lanes != 0
            if bit + 2 == BITS:
                result[alive] = lanes
            elif not keep.all():
                alive, over = alive[keep], over[keep]
                counters = [c[keep] for c in counters]
                if not len(alive):
                    break
    return result


def lowest_labels(n: int, left: np.ndarray, right: np.ndarray, label: np.ndarray | None = None) -> np.ndarray:
    """The smallest node that each of n nodes reaches over the links, beginning from ``label``."""
    label = np.arange(n) if label is None else label
    while True:
        low = np.minimum(label[left], label[right])
        new = label.copy()
        np.minimum.at(new, label[left], low)
        np.minimum.at(new, label[right], low)
        new = new[new]
        if (new == label).all():
            return label
        label = new


def forest(pieces: pd.DataFrame, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Links that connect what the given pieces of work connect, as two arrays of fingerprints.

    A row is a member of piece ``piece``: on side 0 a query, on side 1 what queries are compared
    with, on side 2 both. Each piece starts at a word of its own in the planes.
    """
    fps = pieces["fp"].to_numpy(np.int64).view(np.uint64)
    side = pieces["side"].to_numpy()
    piece = pieces["piece"].to_numpy()
    n_pieces = int(piece[-1]) + 1 if len(piece) else 0

    stored_rows = np.flatnonzero(side != 0)
    sizes = np.bincount(piece[stored_rows], minlength=n_pieces)
    words = -(-sizes // LANES)
    first_word = np.concatenate([[0], np.cumsum(words)])
    rank = np.arange(len(stored_rows)) - np.concatenate([[0], np.cumsum(sizes)])[piece[stored_rows]]
    lane = first_word[piece[stored_rows]] * LANES + rank
    row_at = np.full(first_word[-1] * LANES, -1, np.int64)
    row_at[lane] = stored_rows
    values = np.zeros(len(row_at), np.uint64)
    values[lane] = fps[stored_rows]
    planes = to_planes(values)

    asking = np.flatnonzero(side != 1)
    label = np.arange(len(fps))
    per_query = words[piece[asking]]
    bounds = np.concatenate([[0], np.cumsum(per_query)])
    for begin in range(0, int(bounds[-1]), ITEMS):
        item = np.arange(begin, min(begin + ITEMS, int(bounds[-1])))
        asker = np.searchsorted(bounds, item, side="right") - 1
        row = asking[asker]
        word = first_word[piece[row]] + item - bounds[asker]
        lanes = within_radius(fps[row], planes[:, word], radius)
        hit = np.flatnonzero(lanes)
        found, at = np.nonzero(np.unpackbits(lanes[hit].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little"))
        left, right = row[hit[found]], row_at[word[hit[found]] * LANES + at]
        real = right >= 0
        label = lowest_labels(len(fps), left[real], right[real], label)
    linked = np.flatnonzero(label != np.arange(len(fps)))
    return fps[linked].view(np.int64), fps[label[linked]].view(np.int64)


def links(prints: DataFrame, fp: str, radius: int, block: int) -> DataFrame:
    """left, right: rows that connect exactly the fingerprints that links connect."""
    keyed = (
        prints.select(F.col(fp).alias("fp"))
        .distinct()
        .select("fp", F.explode(bucket_keys("fp", radius)).alias("key"))
    )
    sizes = keyed.groupBy("key").agg(F.count(F.lit(1)).alias("members")).filter("members > 1")
    members = (
        keyed.join(sizes, "key")
        .withColumn("blocks", F.ceil(F.col("members") / block).cast("int"))
        .withColumn("own", F.pmod(F.xxhash64("fp"), F.col("blocks")).cast("int"))
    )
    # a block meets each block, itself included, in a piece of its own
    work = members.select("*", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other")).select(
        "fp",
        "key",
        F.least("own", "other").alias("low"),
        F.greatest("own", "other").alias("high"),
        F.when(F.col("own") == F.col("other"), 2).when(F.col("own") < F.col("other"), 0).otherwise(1).alias("side"),
    )
    names = ["blocks", "bits", "low", "high"]
    dealt = work.select("fp", "side", "key.*", "low", "high").repartition(*names).sortWithinPartitions(*names)

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pd.DataFrame] = []  # at most one piece

        def result(frame):
            left, right = forest(frame, radius)
            return pa.RecordBatch.from_pydict({"left": left, "right": right})

        for batch in batches:
            if not batch.num_rows:
                continue
            rows = pd.concat([*held, batch.to_pandas()], ignore_index=True)
            where = rows[names].to_numpy()
            new = np.ones(len(rows), bool)
            new[1:] = (where[1:] != where[:-1]).any(axis=1)
            rows["piece"] = np.cumsum(new) - 1
            last = int(np.flatnonzero(new)[-1])  # its piece may go on in the next batch
            held = [rows.iloc[last:].drop(columns="piece")]
            if last:
                yield result(rows.iloc[:last])
        if held:
            yield result(held[0].assign(piece=0))

    return dealt.mapInArrow(compare, "left long, right long").distinct()


def connected(edges: DataFrame, max_rounds: int = 100) -> DataFrame:
    """node, root: the smallest node that each node of an edge reaches, roots left out.

    Large-star joins each node's larger neighbours to its smallest one, small-star the smaller
    ones; a join meets a hub with one row of minimum, and skewed hubs are split at run time.
    """

    def state(frame):
        row = frame.agg(
            F.count(F.lit(1)).alias("n"), F.expr("bit_xor(xxhash64(u, v))").alias("bits")
        ).first()
        return tuple(row)

    edges = stored(edges.select(F.greatest("left", "right").alias("u"), F.least("left", "right").alias("v")), "links-0")
    before = state(edges)
    for step in range(1, max_rounds + 1):
        both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.join(low, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = large.filter("u <> v").distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").select(
            F.explode(F.array(F.struct("u", F.col("m").alias("v")), F.struct(F.col("v").alias("u"), F.col("m").alias("v")))).alias("e")
        ).select("e.*")
        edges = stored(small.filter("u <> v").distinct(), f"links-{step}")
        after = state(edges)
        if after == before:
            return edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
        before = after
    raise RuntimeError(f"components did not settle in {max_rounds} rounds")


def simhash_groups(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    width: int = 3,
    radius: int = 2,
    block: int = 4096,
) -> tuple[DataFrame, list[str]]:
    """The rows of ``docs`` with three columns more, and their names.

    fingerprint (long); component_id, the smallest ``doc_id`` that links reach; component_key,
    the smallest fingerprint that they reach.
    """
    names = free_names(docs, "fingerprint", "component_id", "component_key")
    fp, component, key = names
    node, least = free_names(docs, "simhash_node", "simhash_least")
    prints = stored(with_fingerprints(docs, text, fp, width), "fingerprints")
    roots = connected(links(prints, fp, radius, block)).toDF(node, key)
    ids = prints.groupBy(F.col(fp).alias(least)).agg(F.min(doc_id).alias(component))
    ids = ids.join(roots, F.col(least) == F.col(node), "left").withColumn(key, F.coalesce(key, least))
    whole = ids.groupBy(F.col(key).alias(node)).agg(F.min(component).alias(component))
    # one row per fingerprint: documents that share one with a third of all rows are split at run time
    by_print = ids.select(least, key).join(whole, F.col(key) == F.col(node)).select(least, component, key)
    by_print = stored(by_print, "components")
    return prints.join(by_print, F.col(fp) == F.col(least)).select(*docs.columns, *names), names


def one_of_each(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", **how) -> DataFrame:
    """The rows of ``docs`` that stay: of each component the one with the smallest id."""
    grouped, (fp, component, key) = simhash_groups(docs, doc_id, text, **how)
    (turn,) = free_names(grouped, "turn")
    smallest = grouped.filter(F.col(doc_id).eqNullSafe(F.col(component)))
    # more than one row only where rows repeat the id
    order = Window.partitionBy(key).orderBy(fp, text)
    return smallest.withColumn(turn, F.row_number().over(order)).filter(F.col(turn) == 1).select(*docs.columns)


def digest(docs: DataFrame) -> DataFrame:
    """doc_id, fingerprint in hexadecimal, component_id."""
    grouped, (fp, component, _) = simhash_groups(docs.select("doc_id", "text"))
    return grouped.select(
        "doc_id", F.lpad(F.lower(F.hex(fp)), 16, "0").alias("fingerprint"), F.col(component).alias("component_id")
    )
