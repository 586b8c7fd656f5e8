"""Phrase collocations by direct-address tiling of word pairs.

Words of a language that occur often enough get ids by falling frequency. Pairs of neighbouring ids
are split into tiles of ``2 ** bits`` by ``2 ** bits`` ids: because ids follow frequency, few tiles hold most
pairs. In a tile a pair is its own address: dense tiles are counted by ``numpy.bincount`` over the
addresses, sparse ones as sorted coordinates with counts. Frequent pairs are ranked again and get
ids of their own; the pair of such an id and the next word is a phrase that is one word longer, so
the same tiles count it, and so on up to ``max_words``. A longer phrase is only counted where its
first and its last words are frequent phrases, as no other can be frequent.

Distributed. A task turns its texts into chunks of about ``chunk_bytes``, each with a dictionary
and the texts as numbers in it; texts are read and cut once. Words are counted and ranked over all
dictionaries, and each chunk gets the ids of its own words back, never the whole vocabulary. Chunks
count their pairs before anything moves: what moves is one blob of addresses and counts per chunk
and tile. The blobs of a tile are added up in a tree with ``together`` of them under a node, so the
first tile, which every chunk has, is no hot task. Chunks get the ids of their frequent pairs back
in a join of their blobs with the tiles.

Chunks, blobs and sums are kept on the executors' disks while the next longer phrases are found; what
a lost executor had is computed again. Up to three words only phrases, ranks and totals become files
of the shared folder: in a local folder Hadoop starts three processes beside the executor for each.

Scores. A phrase of count a is cut in two in all ways; with l and r the counts of both sides, its
score is the least of ``floor(1000000 * a * a / (l * r))``. The arithmetic is that of decimals with
38 digits, exact up to counts of 14 digits.

Defined cases: a null text is the empty text, which has no words; documents without a language are
of language ``und``; repeated rows count as often as they occur; a text of any length is read whole
and cut between pieces; ties go by score, count and the phrase's bytes; an empty table gives no
rows; other columns play no part.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from functools import reduce
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import StorageLevel, TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from footfall.llm.common import stored, with_ranks
from footfall.llm.tokens import utf8

#: Texts that are cut into words at once; a list of words takes ten times their bytes.
WORDS_BYTES = 1 << 18
#: Only tiles of the first so many rows and columns can be dense within a chunk.
DENSE_TILES = 4


class Tiling(NamedTuple):
    """Sizes that decide how the work is cut, never what comes out."""

    bits: int = 11
    #: Blobs of a tile, or parts of it, that one task adds up.
    together: int = 64
    chunk_bytes: int = 8 << 20

    @property
    def cells(self) -> int:
        return 1 << 2 * self.bits

    @property
    def dense(self) -> int:
        """A tile with more pairs is counted by address, at 8 bytes a cell."""
        return self.cells // 16


# The characters between pieces.
SEPARATORS = b".,;:!?\n\x0b\x0c\r"
TO_BREAK = bytes.maketrans(SEPARATORS, b"." * len(SEPARATORS))
BETWEEN_PIECES = re.compile(b"[" + re.escape(SEPARATORS) + b"]")

PLACE = ["lang", "tile_row", "tile_column"]


Keep = Callable[[DataFrame], DataFrame]


@contextmanager
def keeping() -> Iterator[Keep]:
    """What keeps frames, computed at once, on the executors' disks; they go at the end.

    A frame left there would also answer for a later one that reads the same path, whatever is there by then.
    """
    frames = []

    def keep(frame: DataFrame) -> DataFrame:
        frames.append(frame.persist(StorageLevel.DISK_ONLY))
        frame.count()
        return frame

    try:
        yield keep
    finally:
        for frame in frames:
            frame.unpersist()


PRESS, EXPAND = zstandard.ZstdCompressor(level=1), zstandard.ZstdDecompressor()


def pressed(numbers: np.ndarray, kind: str) -> bytes:
    return PRESS.compress(numbers.astype(kind).tobytes())


def expanded(blob: bytes, kind: str) -> np.ndarray:
    return np.frombuffer(EXPAND.decompress(blob), kind)


def pressed_cells(cells: np.ndarray) -> bytes:
    """Cells in order, as distances."""
    return pressed(np.diff(cells, prepend=0), "<u4")


def expanded_cells(blob: bytes) -> np.ndarray:
    return np.cumsum(expanded(blob, "<u4"), dtype=np.int64)


def parts_of(text: bytes, most: int) -> Iterator[bytes]:
    """A text in parts of about ``most`` bytes that end between pieces."""
    begin = 0
    while len(text) - begin > most:
        end = BETWEEN_PIECES.search(text, begin + most)
        if not end:
            break
        yield text[begin : end.start()]
        begin = end.end()
    yield text[begin:]


def words_of(texts: list[bytes]) -> list[bytes]:
    """The lower-cased words of some texts, with a single point between pieces.

    No word can be a point, because points end pieces.
    """
    return b".".join(texts).lower().translate(TO_BREAK).replace(b".", b" . ").split()


def together(texts: list[bytes], most: int) -> Iterator[list[bytes]]:
    """Consecutive texts of about ``most`` bytes; a longer text is one by itself."""
    some, size = [], 0
    for text in texts:
        if some and size + len(text) > most:
            yield some
            some, size = [], 0
        some.append(text)
        size += len(text)
    if some:
        yield some


def chunked(docs: DataFrame, text: str, lang: str, most: int, keep: Keep) -> DataFrame:
    """chunk, lang, words, counts, codes: texts as numbers of words in the chunk's own dictionary.

    Code 0 is the break between pieces, code i the i-th word.
    """

    def chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 33
        waiting: dict[str, list[bytes]] = {}
        sizes: dict[str, int] = {}

        def row(name: str) -> pa.RecordBatch:
            nonlocal number
            code: dict[bytes, int] = {b".": 0}
            codes = [np.zeros(0, np.int32)]
            for texts in together(waiting.pop(name), WORDS_BYTES):
                words = words_of([b"", *texts])  # texts begin with a break
                codes.append(np.fromiter((code.setdefault(word, len(code)) for word in words), np.int32, len(words)))
            del sizes[name]
            every = np.concatenate(codes)
            counts = np.bincount(every, minlength=len(code))[1:]
            number += 1
            return pa.RecordBatch.from_arrays(
                [
                    pa.array([number], pa.int64()),
                    pa.array([name]),
                    pa.array([[word.decode() for word in list(code)[1:]]], pa.list_(pa.string())),
                    pa.array([counts], pa.list_(pa.int64())),
                    pa.array([pressed(every, "<i4")], pa.binary()),
                ],
                ["chunk", "lang", "words", "counts", "codes"],
            )

        for batch in batches:
            for name, whole in zip(batch.column(0).to_pylist(), utf8(batch.column(1))):
                for part in parts_of(whole, most):
                    waiting.setdefault(name, []).append(part)
                    sizes[name] = sizes.get(name, 0) + len(part) + 1
                    if sizes[name] >= most:
                        yield row(name)
                    elif sum(sizes.values()) > 2 * most:  # of many languages the fullest makes room
                        yield row(max(sizes, key=sizes.get))
        for name in list(waiting):
            yield row(name)

    rows = docs.select(F.coalesce(F.col(lang).cast("string"), F.lit("und")).alias("lang"), F.col(text).alias("text"))
    schema = "chunk long, lang string, words array<string>, counts array<long>, codes binary"
    return keep(rows.mapInArrow(chunks, schema))


def ranked_words(entries: DataFrame, least: int) -> DataFrame:
    """lang, phrase, f, id: the frequent words, with ids by falling frequency."""
    counts = entries.groupBy("lang", F.col("word").alias("phrase")).agg(F.sum("count").alias("f"))
    frequent = counts.filter(F.col("f") >= least).withColumn("less", -F.col("f"))
    ranked = with_ranks(frequent, ["lang"], ["less", "phrase"], "id", "collocations-words")
    return stored(ranked.drop("less"), "collocations-word-ids")


def with_word_ids(chunks: DataFrame, entries: DataFrame, words: DataFrame, keep: Keep) -> DataFrame:
    """chunk, lang, words, ids: each place's word id, -1 for other words and breaks; no ids of longer phrases yet."""
    ids = words.select("lang", F.col("phrase").alias("word"), "id")
    own = (
        # a part of the frequent words is a small table to look up in; the many entries need no order
        entries.join(ids.hint("shuffle_hash"), ["lang", "word"])
        .groupBy("chunk")
        .agg(F.collect_list(F.shiftleft("id", 32).bitwiseOR(F.col("code"))).alias("known"))
    )

    def translate(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(batch.num_rows):
                codes = expanded(batch.column(2)[at].as_py(), "<i4")
                known = batch.column(3)[at].values
                found = np.zeros(0, np.int64) if known is None else known.to_numpy(zero_copy_only=False)
                id_of = np.full(int(codes.max(initial=0)) + 1, -1, np.int32)
                id_of[found & 0xFFFFFFFF] = found >> 32
                ids = id_of[codes]
                yield chunk_row(batch, at, ids, np.zeros(0, np.int64))

    joined = chunks.select("chunk", "lang", "codes").join(own, "chunk", "left")
    return keep(joined.mapInArrow(translate, CHUNK_SCHEMA))


CHUNK_SCHEMA = "chunk long, lang string, words binary, ids binary"


def chunk_row(batch: pa.RecordBatch, at: int, words: np.ndarray, ids: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [
            batch.column(0).slice(at, 1),
            batch.column(1).slice(at, 1),
            pa.array([pressed(words, "<i4")], pa.binary()),
            pa.array([pressed(ids, "<i8")], pa.binary()),
        ],
        ["chunk", "lang", "words", "ids"],
    )


def ids_at(batch: pa.RecordBatch, at: int) -> tuple[np.ndarray, np.ndarray]:
    """The word ids and phrase ids of a chunk; phrases of one word are words."""
    words = expanded(batch.column(2)[at].as_py(), "<i4")
    ids = expanded(batch.column(3)[at].as_py(), "<i8")
    return words, ids if len(ids) else words.astype(np.int64)


def pairs_at(words: np.ndarray, ids: np.ndarray, length: int) -> np.ndarray:
    """Where a phrase of ``length`` words and the word after it may make a longer frequent phrase.

    The phrase and the one that begins a word later must both be frequent.
    """
    if len(ids) <= length:
        return np.zeros(0, np.int64)
    return np.flatnonzero((ids[:-length] >= 0) & (ids[1 : len(ids) - length + 1] >= 0) & (words[length:] >= 0))


def addresses(left: np.ndarray, right: np.ndarray, bits: int) -> np.ndarray:
    """One number per pair: the tile's row, its column (20 bits), the row and column in it."""
    tiles, low = (left >> bits) << 20 | (right >> bits), (1 << bits) - 1
    return tiles << (2 * bits) | (left & low) << bits | (right & low)


def summed(cells: np.ndarray, counts: np.ndarray | None, tiling: Tiling) -> tuple[np.ndarray, np.ndarray]:
    """Distinct cells of one tile in order, with their totals: by address if dense, else sorted."""
    if len(cells) > tiling.dense:
        totals = np.bincount(cells, counts, tiling.cells)  # doubles with weights, exact up to 2 ** 53
        cells = np.flatnonzero(totals)
        return cells, totals[cells].astype(np.int64)
    if counts is None:
        return np.unique(cells, return_counts=True)
    order = np.argsort(cells, kind="stable")
    cells = cells[order]
    first = np.flatnonzero(np.diff(cells, prepend=-1))
    return cells[first], np.add.reduceat(counts[order], first) if len(cells) else counts


def tiles_of(left: np.ndarray, right: np.ndarray, tiling: Tiling) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Row, column, cells and counts of each tile that has one of the pairs.

    Tiles of the most frequent ids that are dense are counted by address, the others from one sort.
    """
    bits, edge = tiling.bits, DENSE_TILES << tiling.bits
    keys = addresses(left, right, bits)
    low = (left < edge) & (right < edge)
    corner = (left[low] >> bits) * DENSE_TILES + (right[low] >> bits)
    for tile in np.flatnonzero(np.bincount(corner, minlength=1) > tiling.dense).tolist():
        row, column = divmod(tile, DENSE_TILES)
        mine = keys >> (2 * bits) == row << 20 | column
        yield row, column, *summed(keys[mine] & (tiling.cells - 1), None, tiling)
        keys = keys[~mine]
    keys.sort()
    first = np.flatnonzero(np.diff(keys, prepend=-1))
    counts = np.diff(first, append=len(keys))
    cells, tiles = keys[first] & (tiling.cells - 1), keys[first] >> (2 * bits)
    begins = np.flatnonzero(np.diff(tiles, prepend=-1)).tolist()
    for begin, end in zip(begins, [*begins[1:], len(tiles)]):
        tile = int(tiles[begin])
        yield tile >> 20, tile & 0xFFFFF, cells[begin:end], counts[begin:end]


BLOB_SCHEMA = "chunk long, lang string, tile_row long, tile_column long, cells binary, counts binary"


def pair_blobs(chunks: DataFrame, length: int, tiling: Tiling, keep: Keep) -> DataFrame:
    """One row per chunk and tile: the addresses of its pairs, in order, and their counts."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(batch.num_rows):
                words, ids = ids_at(batch, at)
                where = pairs_at(words, ids, length)
                if not len(where):
                    continue
                left, right = ids[where], words[where + length].astype(np.int64)
                row, column, cells, counts = zip(*tiles_of(left, right, tiling))
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(batch.column(0).take(pa.array([at] * len(row)))),
                        pa.array(batch.column(1).take(pa.array([at] * len(row)))),
                        pa.array(row, pa.int64()),
                        pa.array(column, pa.int64()),
                        pa.array([pressed_cells(c) for c in cells], pa.binary()),
                        pa.array([pressed(c, "<u4") for c in counts], pa.binary()),
                    ],
                    ["chunk", "lang", "tile_row", "tile_column", "cells", "counts"],
                )

    return keep(chunks.mapInArrow(count, BLOB_SCHEMA))


class Sum:
    """The running sum of one tile's blobs, in bounded memory."""

    def __init__(self, tiling: Tiling):
        self.tiling, self.size = tiling, tiling.cells
        self.cells, self.counts, self.waiting = [], [], 0
        self.totals: np.ndarray | None = None

    def add(self, cells: np.ndarray, counts: np.ndarray) -> None:
        self.cells.append(cells)
        self.counts.append(counts)
        self.waiting += len(cells)
        if self.waiting > self.size // 4:
            self.settle()

    def settle(self) -> None:
        cells, counts = np.concatenate(self.cells), np.concatenate(self.counts)
        self.cells, self.counts, self.waiting = [], [], 0
        if self.totals is None and len(cells) > self.size // 4:
            self.totals = np.zeros(self.size, np.int64)
        if self.totals is None:
            cells, counts = summed(cells, counts, self.tiling)
            self.cells, self.counts, self.waiting = [cells], [counts], len(cells)
        else:
            self.totals += np.bincount(cells, counts, self.size).astype(np.int64)

    def result(self) -> tuple[np.ndarray, np.ndarray]:
        if self.waiting:
            self.settle()
        if self.totals is None:
            return self.cells[0], self.counts[0]
        cells = np.flatnonzero(self.totals)
        return cells, self.totals[cells]


TILE_KEYS = ["parts", "part", *PLACE]


def added(blobs: DataFrame, least: int, width: str, tiling: Tiling) -> DataFrame:
    """One row per tile and part: the sums of its blobs; of a whole tile the cells of at least ``least``.

    ``width`` is the type of the counts that come in; those that go out are longs.
    """

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, total = None, None

        def row() -> Iterator[pa.RecordBatch]:
            cells, counts = total.result()
            if at[0] == 1:
                kept = counts >= least
                cells, counts = cells[kept], counts[kept]
            if len(cells):
                blobs = [pressed_cells(cells), pressed(counts, "<i8")]
                types = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.binary(), pa.binary()]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([value], kind) for value, kind in zip([*at, *blobs], types)],
                    [*TILE_KEYS, "cells", "counts"],
                )

        for batch in batches:
            places = list(zip(*(batch.column(i).to_pylist() for i in range(5))))
            for i, place in enumerate(places):
                if place != at:
                    if at is not None:
                        yield from row()
                    at, total = place, Sum(tiling)
                counts = expanded(batch.column(6)[i].as_py(), width).astype(np.int64)
                total.add(expanded_cells(batch.column(5)[i].as_py()), counts)
        if at is not None:
            yield from row()

    rows = blobs.select(*TILE_KEYS, "cells", "counts").repartition(*TILE_KEYS).sortWithinPartitions(*TILE_KEYS)
    return rows.mapInArrow(
        add, "parts long, part long, lang string, tile_row long, tile_column long, cells binary, counts binary"
    )


def tile_sizes(blobs: DataFrame) -> DataFrame:
    """The number of blobs of each tile."""
    return stored(blobs.groupBy(*PLACE).agg(F.count("*").alias("parts")), "collocations-sizes")


def grouped(rows: DataFrame, together: int) -> DataFrame:
    """``together`` parts of a tile become one."""
    rows = rows.withColumn("parts", F.ceil(F.col("parts") / together))
    return rows.withColumn("part", F.pmod("part", "parts"))


def frequent_pairs(blobs: DataFrame, sizes: DataFrame, least: int, tiling: Tiling, keep: Keep) -> DataFrame:
    """lang, left, right, f: the pairs of at least ``least`` occurrences over all chunks.

    A tile with few blobs is done after one step, so only the busy ones go up the tree.
    """
    most = sizes.agg(F.max("parts")).first()[0] or 1
    rows, width, done = blobs.join(sizes, PLACE).withColumn("part", F.xxhash64("chunk")), "<u4", []
    while most > tiling.together:
        most = -(-most // tiling.together)
        sums = keep(added(grouped(rows, tiling.together), least, width, tiling))
        done.append(sums.filter("parts = 1"))
        rows, width = sums.filter("parts > 1"), "<i8"
    tiles = reduce(DataFrame.unionByName, done, added(grouped(rows, tiling.together), least, width, tiling))
    bits, low = tiling.bits, (1 << tiling.bits) - 1

    def unpack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(batch.num_rows):
                cells = expanded_cells(batch.column(3)[at].as_py())
                row, column = batch.column(1)[at].as_py(), batch.column(2)[at].as_py()
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).take(pa.array(np.full(len(cells), at))),
                        pa.array(row << bits | cells >> bits),
                        pa.array(column << bits | cells & low),
                        pa.array(expanded(batch.column(4)[at].as_py(), "<i8")),
                    ],
                    ["lang", "left", "right", "f"],
                )

    return keep(tiles.select(*PLACE, "cells", "counts").mapInArrow(unpack, "lang string, left long, right long, f long"))


def with_pair_ids(
    chunks: DataFrame, blobs: DataFrame, sizes: DataFrame, pairs: DataFrame, length: int, tiling: Tiling
) -> DataFrame:
    """The chunks with ``ids`` of the frequent phrases that are one word longer.

    The ids of a tile meet its blobs, ``together`` at a time; each blob takes those of its own pairs
    back to its chunk.
    """
    bits, low = tiling.bits, F.lit((1 << tiling.bits) - 1)
    cell = F.shiftleft(F.col("left").bitwiseAND(low), bits) + F.col("right").bitwiseAND(low)
    tiles = (
        pairs.select(
            "lang",
            F.shiftright("left", bits).alias("tile_row"),
            F.shiftright("right", bits).alias("tile_column"),
            F.struct(cell.alias("cell"), "id").alias("pair"),
        )
        .groupBy(*PLACE)
        .agg(F.array_sort(F.collect_list("pair")).alias("pairs"))  # at most one per cell
    )
    parts = F.ceil(F.col("parts") / tiling.together)
    columns = [*PLACE, "chunk", "cells", "known", "ids"]
    asking = blobs.join(sizes, PLACE).select(
        F.pmod(F.xxhash64("chunk"), parts).alias("part"), *PLACE, "chunk", "cells",
        F.lit(None).cast("array<long>").alias("known"), F.lit(None).cast("array<long>").alias("ids"),
    )
    answering = tiles.join(sizes, PLACE).select(
        F.explode(F.sequence(F.lit(0).cast("long"), parts - 1)).alias("part"), *PLACE,
        F.lit(-1).cast("long").alias("chunk"), F.lit(None).cast("binary").alias("cells"),
        F.col("pairs.cell").alias("known"), F.col("pairs.id").alias("ids"),
    )
    place = ["part", *PLACE]
    meeting = answering.unionByName(asking).repartition(*place).sortWithinPartitions(*place, "chunk")

    def own(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Per part of a tile the ids come first, then the blobs."""
        at = known = ids = None
        for batch in batches:
            places = list(zip(*(batch.column(i).to_pylist() for i in range(5))))
            for i, (*here, chunk) in enumerate(places):
                if chunk < 0:
                    at = here
                    known, ids = (batch.column(c)[i].values.to_numpy(zero_copy_only=False).copy() for c in (6, 7))
                if chunk < 0 or here != at:  # no pair of this tile is frequent
                    continue
                cells = expanded_cells(batch.column(5)[i].as_py())
                mine = np.isin(known, cells, assume_unique=True)
                if not mine.any():
                    continue
                tile = (here[2] << 20 | here[3]) << (2 * bits)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(4).slice(i, 1),
                        pa.array([pressed(tile | known[mine], "<i8")], pa.binary()),
                        pa.array([pressed(ids[mine], "<i8")], pa.binary()),
                    ],
                    ["chunk", "keys", "ids"],
                )

    answers = (
        meeting.select("part", *columns)
        .mapInArrow(own, "chunk long, keys binary, ids binary")
        .groupBy("chunk")
        .agg(F.collect_list(F.struct("keys", "ids")).alias("answers"))
    )

    def translate(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(batch.num_rows):
                words, ids = ids_at(batch, at)
                answer = batch.column(4)[at].as_py()
                known = np.concatenate([expanded(a["keys"], "<i8") for a in answer])
                known_ids = np.concatenate([expanded(a["ids"], "<i8") for a in answer])
                order = np.argsort(known)
                known, known_ids = known[order], known_ids[order]
                where = pairs_at(words, ids, length)
                keys = addresses(ids[where], words[where + length].astype(np.int64), bits)
                place = np.minimum(np.searchsorted(known, keys), len(known) - 1)
                longer = np.full(len(ids), -1, np.int64)
                longer[where] = np.where(known[place] == keys, known_ids[place], -1)
                yield chunk_row(batch, at, words, longer)

    return chunks.join(answers, "chunk").mapInArrow(translate, CHUNK_SCHEMA)


def phrases(
    docs: DataFrame, text: str, lang: str, least: int, max_words: int, tiling: Tiling, keep: Keep
) -> tuple[list[DataFrame], DataFrame]:
    """For 1 to ``max_words`` words the frequent phrases (lang, phrase, f), and all words by lang (lang, n)."""
    chunks = chunked(docs, text, lang, tiling.chunk_bytes, keep)
    entries = chunks.select("chunk", "lang", F.posexplode(F.arrays_zip("words", "counts"))).select(
        "chunk", "lang", F.col("col.words").alias("word"), F.col("col.counts").alias("count"),
        (F.col("pos") + 1).cast("long").alias("code"),
    )
    totals = chunks.groupBy("lang").agg(F.sum(F.aggregate("counts", F.lit(0).cast("long"), lambda a, b: a + b)).alias("n"))
    totals = stored(totals, "collocations-totals")

    words = ranked_words(entries, least)
    found = [words.select("lang", "phrase", "f")]
    before = words.select("lang", "id", "phrase")
    state = with_word_ids(chunks, entries, words, keep)
    chunks.unpersist()
    for length in range(1, max_words):
        with keeping() as passing:
            blobs = pair_blobs(state, length, tiling, passing)
            sizes = tile_sizes(blobs)
            pairs = frequent_pairs(blobs, sizes, least, tiling, passing).withColumn("less", -F.col("f"))
            pairs = with_ranks(pairs, ["lang"], ["less", "left", "right"], "id", f"collocations-ranks-{length + 1}")
            named = (
                pairs.join(before.withColumnRenamed("id", "left").withColumnRenamed("phrase", "first"), ["lang", "left"])
                .join(words.select("lang", F.col("id").alias("right"), F.col("phrase").alias("last")), ["lang", "right"])
                .select("lang", "id", "left", "right", "f", F.concat_ws(" ", "first", "last").alias("phrase"))
            )
            longer = stored(named, f"collocations-phrases-{length + 1}")
            found.append(longer.select("lang", "phrase", "f"))
            if length + 1 < max_words:
                ids, shorter = longer.select("lang", "left", "right", "id"), state
                state = with_pair_ids(shorter, blobs, sizes, ids, length, tiling)
                # plans of kept frames hold those before twice: of many levels only the last goes without files
                state = keep(state) if length + 2 == max_words else stored(state, f"collocations-ids-{length + 1}")
                shorter.unpersist()
                before = longer.select("lang", "id", "phrase")
    return found, totals


def score(count: str = "a", left: str = "l", right: str = "r"):
    """floor(1000000 * count * count / (left * right)), exact."""
    wide = lambda name: f"CAST({name} AS DECIMAL(14, 0))"
    return F.expr(
        f"CAST(CAST(1000000 AS DECIMAL(7, 0)) * ({wide(count)} * {wide(count)}) div ({wide(left)} * {wide(right)}) AS BIGINT)"
    )


def collocations(
    docs: DataFrame,
    text: str = "text",
    lang: str = "lang",
    least: int = 10,
    max_words: int = 3,
    absorbed: int = 50,
    best: int = 2000,
    tiling: Tiling = Tiling(),
) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score: the ``best`` phrases of two to ``max_words`` words by language.

    A phrase goes if a longer one around it has at least ``absorbed`` percent of its occurrences.
    """
    with keeping() as keep:
        found, totals = phrases(docs, text, lang, least, max_words, tiling, keep)
    every = reduce(DataFrame.unionByName, found)
    candidates = reduce(DataFrame.unionByName, found[1:]).withColumn("words", F.split("phrase", " "))
    size = F.size("words")

    def joined(first, length):
        return F.array_join(F.slice("words", first, length), " ")

    cuts = candidates.select(
        "lang", "phrase", F.col("f").alias("a"), size.alias("size"), "words",
        F.explode(F.sequence(F.lit(1), size - 1)).alias("k"),
    ).select("lang", "phrase", "a", "k", joined(F.lit(1), F.col("k")).alias("first"),
             joined(F.col("k") + 1, F.col("size") - F.col("k")).alias("rest"))
    sided = cuts.join(
        every.select("lang", F.col("phrase").alias("first"), F.col("f").alias("l")), ["lang", "first"]
    ).join(every.select("lang", F.col("phrase").alias("rest"), F.col("f").alias("r")), ["lang", "rest"])
    scored = (
        sided.withColumn("score", score())
        .groupBy("lang", "phrase", "a")
        .agg(F.min(F.struct("score", "k", "l", "r")).alias("cut"))
    )

    # the phrases inside a longer one: all runs of two words or more but itself
    inner = candidates.filter(size > 2).select(
        "lang", "f", "words", size.alias("size"), F.explode(F.sequence(F.lit(2), size - 1)).alias("length")
    )
    inner = inner.withColumn("begin", F.explode(F.sequence(F.lit(1), F.col("size") - F.col("length") + 1)))
    around = inner.groupBy("lang", joined(F.col("begin"), F.col("length")).alias("phrase")).agg(F.max("f").alias("around"))

    kept = scored.join(around, ["lang", "phrase"], "left").filter(
        F.col("around").isNull() | (100 * F.col("around") < absorbed * F.col("a"))
    )
    # ranks over ranges of rows: one language may have most of the phrases
    falling = kept.select("lang", "phrase", "a", "cut.l", "cut.r", "cut.score", (-F.col("cut.score")).alias("first"), (-F.col("a")).alias("then"))
    ranked = with_ranks(falling, ["lang"], ["first", "then", "phrase"], "place", "collocations-best")
    top = ranked.filter(F.col("place") < best).withColumn("rank", F.col("place") + 1)
    return top.join(totals, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")


def digest(docs: DataFrame) -> DataFrame:
    return collocations(docs)


ORACLE_SQL = r"""
WITH texts AS (
  SELECT coalesce(lang, 'und') AS lang,
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS text
  FROM documents
), pieces AS (
  SELECT lang, unnest(regexp_split_to_array(text, '[.,;:!?\x0A-\x0D]')) AS piece FROM texts
), lists AS (
  SELECT lang, list_filter(regexp_split_to_array(piece, '[\x20\x09]+'), lambda w: w <> '') AS w FROM pieces
), totals AS (
  SELECT lang, CAST(sum(len(w)) AS BIGINT) AS n FROM lists GROUP BY lang
), runs AS (
  SELECT lang, m, unnest(list_transform(range(1, len(w) - m + 2), lambda i: array_to_string(w[i : i + m - 1], ' '))) AS phrase
  FROM lists, (VALUES (1), (2), (3)) s(m)
  WHERE len(w) >= m
), counts AS (
  SELECT lang, m, phrase, count(*) AS f FROM runs GROUP BY ALL HAVING count(*) >= 10
), cuts AS (
  SELECT c.lang, c.phrase, c.m, c.f AS a, k,
    array_to_string(string_split(c.phrase, ' ')[1 : k], ' ') AS first_words,
    array_to_string(string_split(c.phrase, ' ')[k + 1 : c.m], ' ') AS other_words
  FROM counts c, (VALUES (1), (2)) s(k)
  WHERE k < c.m
), scored AS (
  SELECT u.lang, u.phrase, u.a, k, x.f AS l, y.f AS r,
    CAST((1000000::HUGEINT * u.a * u.a) // (x.f::HUGEINT * y.f) AS BIGINT) AS score
  FROM cuts u
  JOIN counts x ON x.lang = u.lang AND x.phrase = u.first_words
  JOIN counts y ON y.lang = u.lang AND y.phrase = u.other_words
  QUALIFY row_number() OVER (PARTITION BY u.lang, u.phrase ORDER BY score, k) = 1
), around AS (
  SELECT lang, phrase, max(f) AS f
  FROM (
    SELECT lang, f, unnest([
      array_to_string(string_split(phrase, ' ')[1 : 2], ' '), array_to_string(string_split(phrase, ' ')[2 : 3], ' ')
    ]) AS phrase
    FROM counts WHERE m = 3
  )
  GROUP BY lang, phrase
)
SELECT s.lang, row_number() OVER (PARTITION BY s.lang ORDER BY score DESC, a DESC, s.phrase) AS rank,
  s.phrase, a, l, r, n, score
FROM scored s JOIN totals t ON t.lang = s.lang
LEFT JOIN around o ON o.lang = s.lang AND o.phrase = s.phrase
WHERE o.f IS NULL OR 100 * o.f < 50 * a
QUALIFY rank <= 2000
"""
