"""BPE encoding and decoding that reuses content-defined chunks.

A rolling hash over the last 16 bytes cuts each text into chunks of about ``chunk`` bytes, so
that equal passages give equal chunks wherever they stand. A chunk that occurs more than once
is encoded once, and texts are put together from the ids of their chunks. A cut may fall inside
a word; there the ids around the join are those of half words. Each join is repaired: the text
around it is encoded again, from one whole run of non-blanks before the cut run to one after it.
If the new ids do not begin and end with exactly those that the chunks have for the outer runs,
the window grows until they do, at last to the whole text.

Only texts with a shared chunk need to meet other texts. One pass counts chunk keys (128 bits).
Keys that occur more than once set bits of a filter of fixed size, whatever the number of
chunks; a text that hits no bit is encoded in the task that reads it and never leaves it. The
others go through the chunk table. If the filter fills up, more texts take that way, with the
same results. What such a text does not share is encoded where the text is put together.

Defined cases: a null text is the empty text, with no ids and an empty decoded text; repeated
rows give repeated rows; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import itertools
import re
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from footfall.llm.common import stored
from footfall.llm.tokens import PART_BYTES, Decoder, packed, parts, unpacked, utf8, word_tokenizer, worker_encoder

WINDOW = 16
RUN = re.compile(rb"[^\x20\x09-\x0D]+")
PROBES = 3
#: Chunks of fewer bytes are not worth sharing; they are encoded with what stands around them.
LEAST = 48
#: Odd, so that powers of it do not vanish modulo 2 ** 32; any odd number will do.
FACTOR = 0x9E3779B1
#: Bytes that are hashed at a time, so that the hashes stay in the processor's cache.
BLOCK = 1 << 15
#: What a byte counts in a hash.
MIXED = np.frombuffer(b"".join(xxhash.xxh32_digest(bytes([i])) for i in range(256)), ">u4").astype(np.uint32)


def hashed_below(raw: np.ndarray, bound: int) -> np.ndarray:
    """Behind which bytes the hash of the last 16 is at most ``bound``."""
    found = [np.empty(0, np.int64)]
    for begin in range(0, len(raw), BLOCK):
        low = max(0, begin - WINDOW + 1)
        h = MIXED[raw[low : begin + BLOCK]]
        step, factor = 1, FACTOR
        while step < WINDOW:  # the hash of 2 n bytes from those of its halves
            rolled = h.copy()
            rolled[step:] += h[:-step] * np.uint32(factor)
            h, step, factor = rolled, 2 * step, factor * factor % (1 << 32)
        at = np.flatnonzero(h <= np.uint32(bound)) + low
        found.append(at[at >= begin] + 1)
    return np.concatenate(found)


def cuts(texts: list[bytes], chunk: int) -> list[list[int]]:
    """Where the chunks of each text end, its length included; a cut depends on the 16 bytes before it."""
    sizes = np.array([len(t) for t in texts], np.int64)
    ends = np.cumsum(sizes)
    raw = np.frombuffer(b"".join(texts), np.uint8)
    if not len(raw):
        return [[] for _ in texts]
    after = hashed_below(raw, ((1 << 32) - 1) // chunk)
    owner = np.searchsorted(ends, after, side="right")
    known = owner < len(texts)
    after, owner = after[known], owner[known]
    begin = (ends - sizes)[owner]
    # no cut in a text's first bytes, whose window reaches over its start, nor inside a character
    good = (after - begin >= WINDOW) & ((raw[after] & 0xC0) != 0x80)
    after, owner, begin = after[good], owner[good], begin[good]
    where = np.searchsorted(owner, np.arange(len(texts) + 1)).tolist()
    local = (after - begin).tolist()
    return [
        [*local[where[i] : where[i + 1]], len(text)] if text else [] for i, text in enumerate(texts)
    ]


def keys_of(pieces: list[bytes]) -> np.ndarray:
    """128 bits of each piece as two longs, high and low."""
    return np.frombuffer(b"".join(map(xxhash.xxh3_128_digest, pieces)), ">i8").astype(np.int64).reshape(-1, 2)


def chunks_of(texts: list[bytes], chunk: int) -> list[list[bytes]]:
    return [[text[a:b] for a, b in zip([0, *ends], ends)] for text, ends in zip(texts, cuts(texts, chunk))]


def filter_words(shared: DataFrame, bits: int) -> np.ndarray:
    """A Bloom filter of the keys as uint64 words: at most bits / 64 rows come to the driver."""
    low, high = (F.pmod(F.col(name), F.lit(bits)) for name in ("low", "high"))
    spots = F.array(*(F.pmod(low + F.lit(i) * high, F.lit(bits)) for i in range(PROBES)))
    rows = (
        shared.select(F.explode(spots).alias("spot"))
        .groupBy(F.expr("spot div 64").alias("word"))
        .agg(F.expr("bit_or(shiftleft(1L, cast(spot % 64 AS int)))").alias("bits"))
        .toArrow()
    )
    words = np.zeros(bits // 64, np.int64)
    words[rows["word"].to_numpy()] = rows["bits"].to_numpy()
    return words.view(np.uint64)


def may_hold(words: np.ndarray, high: np.ndarray, low: np.ndarray) -> np.ndarray:
    held, bits = np.ones(len(low), bool), len(words) * 64
    for i in range(PROBES):
        spot = (low % bits + i * (high % bits)) % bits
        held &= (words[spot // 64] >> (spot % 64).astype(np.uint64) & np.uint64(1)).astype(bool)
    return held


def pieces_of(text: bytes, a: int, b: int, ids: np.ndarray, lengths: np.ndarray) -> list[tuple[int, int, np.ndarray]]:
    """(begin, end, ids) of what the bytes a to b hold: two runs on each side, what is between as one."""
    if len(lengths) <= 4:
        ends = np.cumsum(lengths).tolist()
        return [
            (m.start(), m.end(), ids[end - n : end])
            for m, n, end in zip(RUN.finditer(text, a, b), lengths.tolist(), ends)
        ]
    pieces, at = [], 0
    for m, n in zip(RUN.finditer(text, a, b), lengths[:2].tolist()):
        pieces.append((m.start(), m.end(), ids[at : at + n]))
        at += n
    body, until, back = text[a:b], len(ids), []
    for n in lengths[:-3:-1].tolist():
        body = body.rstrip()
        end = a + len(body)
        body = body[: len(body) - len(body.rsplit(None, 1)[-1])]
        back.append((a + len(body), end, ids[until - n : until]))
        until -= n
    return [*pieces, (pieces[1][1], back[1][0], ids[at:until]), *reversed(back)]


Segments = list[tuple[int, np.ndarray, np.ndarray]]
Encode = Callable[[list[bytes]], list[np.ndarray]]
NONE = np.empty(0, np.uint32)


class Joins:
    """The pieces of a text, and the runs that cuts parted; a run that more than one join cuts counts once."""

    def __init__(self, text: bytes, segments: Segments):
        self.text = text
        self.pieces: list[tuple[int, int, np.ndarray]] = []
        self.runs: list[list[int]] = []  # first and last piece that is not the first of its run
        at = 0
        for size, ids, lengths in segments:
            own = pieces_of(text, at, at + size, ids, lengths)
            here = len(self.pieces)
            if here and own and self.pieces[-1][1] == at == own[0][0]:
                if self.runs and self.runs[-1][1] == here - 1:
                    self.runs[-1][1] = here
                else:
                    self.runs.append([here, here])
            self.pieces += own
            at += size

    def ids_between(self, first: int, end: int) -> np.ndarray:
        return np.concatenate([NONE, *(ids for _, _, ids in self.pieces[first:end])])

    def window(self, run: list[int], reach: int) -> tuple[int, int]:
        return max(0, run[0] - 1 - reach), min(len(self.pieces), run[1] + 1 + reach)

    def text_of(self, low: int, high: int) -> bytes:
        return self.text[self.pieces[low][0] : self.pieces[high - 1][1]]

    def inner(self, run: list[int], low: int, high: int, new: np.ndarray) -> np.ndarray | None:
        """What the window's new ids have between the outer pieces, if these keep their ids."""
        left, right = self.ids_between(low, run[0] - 1), self.ids_between(run[1] + 1, high)
        end = len(new) - len(right)
        if len(left) <= end and (new[: len(left)] == left).all() and (new[end:] == right).all():
            return new[len(left) : end]
        return None

    def grown(self, run: list[int], encode: Encode) -> tuple[np.ndarray, bool]:
        """The ids of a run from wider windows; those of the whole text, and True, if none fits."""
        reach = 2
        while True:
            low, high = self.window(run, reach)
            (new,) = encode([self.text_of(low, high)])
            inner = self.inner(run, low, high, new)
            if inner is not None:
                return inner, False
            if low == 0 and high == len(self.pieces):
                return new, True
            reach *= 2

    def repaired(self, windows: Iterator[np.ndarray], encode: Encode) -> np.ndarray:
        """ids of the text, given those of each run's first window."""
        result, done = [NONE], 0
        for run, new in zip(self.runs, windows):
            inner = self.inner(run, *self.window(run, 1), new)
            if inner is None:
                inner, whole = self.grown(run, encode)
                if whole:
                    return inner
            result += [ids for _, _, ids in self.pieces[done : run[0] - 1]]
            result.append(inner)
            done = run[1] + 1
        result += [ids for _, _, ids in self.pieces[done:]]
        return np.concatenate(result)


def joined_all(texts: list[tuple[bytes, Segments]], encode: Encode) -> Iterator[np.ndarray]:
    """ids of texts from those of their segments, each (bytes, ids, ids per run), with repaired joins."""
    joins = [Joins(text, segments) for text, segments in texts]
    windows = iter(encode([own.text_of(*own.window(run, 1)) for own in joins for run in own.runs]))
    for own in joins:
        yield own.repaired(itertools.islice(windows, len(own.runs)), encode)


def joined(text: bytes, segments: Segments, tokenizer) -> np.ndarray:
    """ids of one text, with windows encoded by the tokenizer itself."""

    def encode(windows: list[bytes]) -> list[np.ndarray]:
        return [np.array(tokenizer.encode(w.decode(), add_special_tokens=False).ids, np.uint32) for w in windows]

    return next(joined_all([(text, segments)], encode))


def summary(ids: np.ndarray, decoder: Decoder, whole: bool) -> tuple:
    decoded = decoder.decode(ids)
    return (
        len(ids),
        hashlib.sha256(ids.astype("<u4").tobytes()).hexdigest(),
        hashlib.sha256(decoded.encode()).hexdigest(),
        ids.tolist() if whole else None,
        decoded if whole else None,
    )


SHARED = [("begin", "long"), ("end", "long"), ("high", "long"), ("low", "long")]
RESULT = [
    ("n_tokens", "long", pa.int64()),
    ("ids_sha256", "string", pa.string()),
    ("decoded_sha256", "string", pa.string()),
    ("ids", "array<int>", pa.list_(pa.int32())),
    ("decoded", "string", pa.string()),
]


def result_arrays(rows: list[tuple | None]) -> list[pa.Array]:
    columns = zip(*((None,) * len(RESULT) if row is None else row for row in rows))
    return [pa.array(column, kind) for column, (_, _, kind) in zip(columns, RESULT)]


def encode_documents(
    docs: DataFrame,
    tokenizer: str,
    doc_id: str = "doc_id",
    text: str = "text",
    chunk: int = 256,
    filter_bits: int = 1 << 24,
    whole: bool = False,
) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256 of each row; with ``whole`` also ids and decoded."""
    id_type = docs.schema[doc_id].dataType.simpleString()
    docs = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    ddl = ", ".join(f"{name} {kind}" for name, kind, _ in RESULT)
    names = [name for name, _, _ in RESULT]

    def keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = utf8(batch.column(0))
            for part in parts(texts):
                found = [piece for own in chunks_of(texts[part], chunk) for piece in own if len(piece) >= LEAST]
                yield pa.RecordBatch.from_arrays([pa.array(key) for key in keys_of(found).T], ["high", "low"])

    counted = docs.select("text").mapInArrow(keys, "high long, low long").groupBy("high", "low").count()
    words = filter_words(counted.filter("count > 1"), filter_bits)

    def first_pass(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Results of texts that share nothing; of the others the compressed text, and where which shared chunks stand."""
        encoder = worker_encoder(tokenizer)
        decoder = Decoder(encoder.tokenizer)
        press = zstandard.ZstdCompressor(level=1)
        for batch in batches:
            texts = utf8(batch.column(1))
            for part in parts(texts):
                some = texts[part]
                ends_in = cuts(some, chunk)
                spans = [
                    (i, a, b)
                    for i, ends in enumerate(ends_in) for a, b in zip([0, *ends], ends) if b - a >= LEAST
                ]
                marks = keys_of([some[i][a:b] for i, a, b in spans])
                hits = may_hold(words, marks[:, 0], marks[:, 1])
                owner, begin, end = np.array(spans, np.int64).reshape(-1, 3)[hits].T
                until = np.searchsorted(owner, np.arange(len(some) + 1))
                waits = (until[1:] > until[:-1]).tolist()
                ids = iter(encoder.encode([t for t, w in zip(some, waits) if not w]))
                rows = [None if w else summary(next(ids), decoder, whole) for w in waits]
                columns = [begin, end, *marks[hits].T]
                shared = pa.StructArray.from_arrays([pa.array(column) for column in columns], [name for name, _ in SHARED])
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0)[part.start : part.stop],
                        *result_arrays(rows),
                        pa.array([press.compress(t) if w else None for t, w in zip(some, waits)], pa.binary()),
                        pa.ListArray.from_arrays(pa.array(until, pa.int32()), shared),
                    ],
                    ["doc_id", *names, "body", "shared"],
                )

    shared_ddl = ", ".join(f"{name}: {kind}" for name, kind in SHARED)
    first = stored(
        docs.mapInArrow(
            first_pass, f"doc_id {id_type}, {ddl}, body binary, shared array<struct<{shared_ddl}>>"
        ).select(F.monotonically_increasing_id().alias("row"), "*"),
        "bpe-first",
    )
    waiting = first.filter("body IS NOT NULL").select("row", "body", "shared")

    def contents(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        expand, press = zstandard.ZstdDecompressor(), zstandard.ZstdCompressor(level=1)
        for batch in batches:
            found: dict[tuple[int, int], bytes] = {}
            until = batch.column(1).offsets.to_pylist()
            begins, ends, highs, lows = (column.to_pylist() for column in batch.column(1).values.flatten())
            for number, body in enumerate(batch.column(0).to_pylist()):
                data, own = expand.decompress(body), slice(until[number], until[number + 1])
                for key, a, b in zip(zip(highs[own], lows[own]), begins[own], ends[own]):
                    if key not in found:
                        found[key] = press.compress(data[a:b])
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([high for high, _ in found], pa.int64()),
                    pa.array([low for _, low in found], pa.int64()),
                    pa.array(found.values(), pa.binary()),
                ],
                ["high", "low", "piece"],
            )

    def encode_chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = worker_encoder(tokenizer)
        expand = zstandard.ZstdDecompressor()
        for batch in batches:
            pieces = [expand.decompress(piece) for piece in batch.column(2).to_pylist()]
            lengths_of, ids_of = [], []
            for part in parts(pieces):
                for ids, lengths in encoder.with_runs([encoder.runs_of(piece) for piece in pieces[part]]):
                    lengths_of.append(packed(lengths.astype(np.uint32)))
                    ids_of.append(packed(ids))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(lengths_of, pa.binary()), pa.array(ids_of, pa.binary())],
                ["high", "low", "run_ids", "chunk_ids"],
            )

    encoded = (
        waiting.select("body", "shared")
        .mapInArrow(contents, "high long, low long, piece binary")
        .dropDuplicates(["high", "low"])
        .mapInArrow(encode_chunks, "high long, low long, run_ids binary, chunk_ids binary")
    )
    nothing = F.lit(None).cast("binary")
    no_place = F.lit(-1).cast("long")
    chunk_rows = waiting.select("row", F.inline("shared")).join(encoded, ["high", "low"])
    rows = chunk_rows.select("row", "begin", "end", nothing.alias("body"), "run_ids", "chunk_ids").union(
        waiting.select("row", no_place, no_place, "body", nothing, nothing)
    )

    def put_together(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """A text's row comes first, then its shared chunks in order; the others are encoded here."""
        encoder = worker_encoder(tokenizer)
        decoder = Decoder(encoder.tokenizer)
        expand = zstandard.ZstdDecompressor()

        def results(held: list[tuple[int, bytes, list[tuple]]]) -> pa.RecordBatch:
            stretches, layouts = [], []  # a stretch is what stands between shared chunks
            for _, data, shared in held:
                layout, at = [], 0
                for begin, end, run_ids, chunk_ids in [*shared, (len(data), len(data), None, None)]:
                    if at < begin:
                        stretches.append(encoder.runs_of(data[at:begin]))
                        layout.append((begin - at, None))
                    if begin < end:
                        layout.append((end - begin, (unpacked(chunk_ids), unpacked(run_ids))))
                    at = end
                layouts.append(layout)
            own = encoder.with_runs(stretches)
            texts = [
                (data, [(size, *(next(own) if known is None else known)) for size, known in layout])
                for (_, data, _), layout in zip(held, layouts)
            ]
            found = [summary(ids, decoder, whole) for ids in joined_all(texts, encoder.encode)]
            rows = pa.array([row for row, _, _ in held], pa.int64())
            return pa.RecordBatch.from_arrays([rows, *result_arrays(found)], ["row", *names])

        held: list[tuple[int, bytes, list[tuple]]] = []  # row, text, shared chunks
        size = 0
        for batch in batches:
            for row, begin, end, body, run_ids, chunk_ids in zip(*(c.to_pylist() for c in batch.columns)):
                if begin >= 0:
                    held[-1][2].append((begin, end, run_ids, chunk_ids))
                    continue
                if size >= PART_BYTES:
                    yield results(held)
                    held, size = [], 0
                held.append((row, expand.decompress(body), []))
                size += len(held[-1][1])
        if held:
            yield results(held)

    by_row = (
        rows.repartition("row").sortWithinPartitions("row", "begin").mapInArrow(put_together, f"row long, {ddl}")
    )
    others = first.filter("body IS NOT NULL").select("row", "doc_id").join(by_row, "row").select("doc_id", *names)
    result = first.filter("body IS NULL").select("doc_id", *names).union(others)
    return result if whole else result.drop("ids", "decoded")


def digest(docs: DataFrame) -> DataFrame:
    return encode_documents(docs, word_tokenizer())
