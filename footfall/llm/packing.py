"""Packing into fixed-length sequences with a controlled mixture of sources.

Each source is a queue of documents. Deficit round-robin fills windows of ``window_sequences``
sequences: in every round a queue's deficit grows by its quantum (its target share of the window),
it sends so many tokens from its head, and what is left of a token is carried to the next round.
Documents are cut where a quantum ends, so one that is longer than its queue's quantum goes on in
the next round and a window's mixture does not depend on the documents' lengths. The stream, in the
order of rounds, is cut every ``length`` tokens, so only the very last sequence can need padding.

Which round sends a token follows from its place in its queue alone, and no task has to play the
rounds one after the other. In a common virtual time a queue sends its share of tokens per unit; the
stream's length at a time is a line with a bend where a queue ends, and round r begins when that
length reaches r windows. Running totals over partitions tell a document's place in its queue, and
so carry the deficits across windows and partitions.

A hot source is no hot task: its running total is taken in levels, over blocks of rows, over
blocks of blocks, and over one row for each of those.

Targets are shares of tokens by source. Sources that ``targets`` does not name share what it leaves
of 1, in proportion to their tokens; without ``targets`` each window has the proportions of the
whole. Targets of 1 or more in all, or without other sources, are divided by their sum. A source
with a share of 0 comes after all others, as do sources that are not named where nothing is left for
them. When a queue has run empty, the others take its part of a window in proportion to their shares.

Defined cases: a null text is the empty text and has just its end token; documents without a
source are a queue of their own; repeated rows are packed as often as they occur; an empty table
gives no pieces; targets of sources that do not occur play no part; a negative target, or one that
is no number, is an error.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from itertools import islice
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from footfall.llm.common import stored, totals_before
from footfall.llm.tokens import packed, unpacked, word_tokenizer, worker_encoder


def tokenised(docs: DataFrame, doc_id: str, text: str, source: str, tokenizer: str, end_id: int) -> DataFrame:
    """row, doc_id, queue, tokens, ids: each document encoded once, with its end token, in a shared table."""
    id_type = docs.schema[doc_id].dataType.simpleString()

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = worker_encoder(tokenizer)
        for batch in batches:
            for part, found in encoder.encode_column(batch.column(2)):
                found = [np.append(ids, np.uint32(end_id)) for ids in found]
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0)[part.start : part.stop],
                        batch.column(1)[part.start : part.stop],
                        pa.array([len(ids) for ids in found], pa.int64()),
                        pa.array([packed(ids) for ids in found], pa.binary()),
                    ],
                    ["doc_id", "queue", "tokens", "ids"],
                )

    queue = F.coalesce(F.concat(F.lit("of "), F.col(source).cast("string")), F.lit("none"))
    encoded = docs.select(F.col(doc_id).alias("doc_id"), queue.alias("queue"), F.col(text).alias("text")).mapInArrow(
        encode, f"doc_id {id_type}, queue string, tokens long, ids binary"
    )
    return stored(encoded.select(F.monotonically_increasing_id().alias("row"), "*"), "packing-ids")


class Mixture(NamedTuple):
    """When queues send: ``sent`` tokens of all queues together at the virtual times ``time``.

    ``named`` has the share and the time of the first token of each queue that targets name, and
    ``others`` those of all other queues together, which share by their tokens.
    """

    time: list[float]
    sent: list[float]
    named: dict[str, tuple[float, float]]
    others: tuple[float, float]


def mixture(totals: dict[str, int], total: int, targets: dict[str, float] | None) -> Mixture:
    """From the tokens of the queues that targets name, and of all queues."""
    wanted = {f"of {name}": float(share) for name, share in (targets or {}).items()}
    if any(not 0 <= share < float("inf") for share in wanted.values()):
        raise ValueError("targets must be numbers of at least 0")
    wanted = {queue: share for queue, share in wanted.items() if totals.get(queue)}
    rest = total - sum(totals[queue] for queue in wanted)
    left = max(0.0, 1.0 - sum(wanted.values())) if rest else 0.0
    whole = sum(wanted.values()) + left
    shares = {queue: share / whole for queue, share in wanted.items()} if whole else dict.fromkeys(wanted, 0.0)
    left = left / whole if whole else 0.0

    sizes = {queue: totals[queue] for queue in wanted} | ({None: rest} if rest else {})
    shares = shares | ({None: left} if rest else {})
    time, sent = [0.0], [0.0]
    ends = sorted((sizes[queue] / share, queue) for queue, share in shares.items() if share)
    active = sum(share for share in shares.values() if share)
    for end, queue in ends:
        sent.append(sent[-1] + active * (end - time[-1]))
        time.append(end)
        active -= shares[queue]
    last = [queue for queue, share in shares.items() if not share]
    late = sum(sizes[queue] for queue in last)
    begin = {queue: time[-1] if queue in last else 0.0 for queue in shares}
    shares |= {queue: sizes[queue] / late for queue in last}
    if late:
        time.append(time[-1] + late)
        sent.append(sent[-1] + late)
    sent[-1] = float(total)
    others = (shares.pop(None, 0.0), begin.pop(None, 0.0))
    return Mixture(time, sent, {queue: (share, begin[queue]) for queue, share in shares.items()}, others)


def places(rounds: np.ndarray, size, share, begin, of: Mixture, window: int) -> np.ndarray:
    """The queue's places at which the rounds begin, each of a queue of its own or all of one."""
    when = np.interp(rounds.astype(np.float64) * window, of.sent, of.time)
    found = np.where(when >= of.time[-1], size, np.ceil(share * (when - begin)))
    return np.clip(found, 0, size).astype(np.int64)


def rounds_at(place, share, begin, of: Mixture, window: int) -> np.ndarray:
    """The round that sends the token at a place; it may be off by one, as it is divided."""
    return (np.interp(begin + place / share, of.time, of.sent) // window).astype(np.int64)


def round_pieces(
    before: np.ndarray, tokens: np.ndarray, size: np.ndarray, share: np.ndarray, begin: np.ndarray, of: Mixture, window: int
) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """at, round, start and length of the pieces of documents; ``before`` is the place of a document's first token.

    Most documents lie within one round; those that do not are cut one by one.
    """
    number = rounds_at(before, share, begin, of, window)
    whole = (places(number, size, share, begin, of, window) <= before) & (
        places(number + 1, size, share, begin, of, window) >= before + tokens
    )
    found = [(np.flatnonzero(whole), number[whole], np.zeros(whole.sum(), np.int64), tokens[whole])]
    for at in np.flatnonzero(~whole).tolist():
        own = (share[at], begin[at], of, window)
        first = max(0, int(number[at]) - 2)
        last = int(rounds_at(before[at] + tokens[at], *own)) + 2
        end = before[at] + tokens[at]
        edges = np.clip(places(np.arange(first, last + 2), size[at], *own), before[at], end)
        edges[0], edges[-1] = before[at], end
        sent = np.flatnonzero(np.diff(edges))
        found.append((np.full(len(sent), at), first + sent, edges[sent] - before[at], np.diff(edges)[sent]))
    return tuple(np.concatenate(column) for column in zip(*found))


def in_rounds(sizes: DataFrame, window: int, targets: dict[str, float] | None) -> DataFrame:
    """row, queue, sent, round, start, length: the pieces that rounds cut documents into.

    ``sent`` is the place of the piece's first token in its queue.
    """
    totals = stored(sizes.groupBy("queue").agg(F.sum("tokens").alias("size")), "packing-queues")
    names = [f"of {name}" for name in targets or {}]
    found = {r.queue: r["size"] for r in totals.filter(F.col("queue").isin(names)).collect()} if names else {}
    total = totals.agg(F.sum("size")).first()[0] or 0
    of = mixture(found, total, targets)
    rest = total - sum(size for queue, size in found.items() if queue in of.named)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            before, tokens, size = (batch.column(i).to_numpy() for i in (2, 3, 4))
            named = [of.named.get(queue) for queue in batch.column(1).to_pylist()]
            share = np.array([n[0] if n else of.others[0] * s / rest for n, s in zip(named, size.tolist())])
            begin = np.array([n[1] if n else of.others[1] for n in named])
            at, number, start, length = round_pieces(before, tokens, size, share, begin, of, window)
            taken = pa.array(at, pa.int64())
            columns = [pa.array(c, pa.int64()) for c in (before[at] + start, number, start, length)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(taken), batch.column(1).take(taken), *columns],
                ["row", "queue", "sent", "round", "start", "length"],
            )

    placed = totals_before(sizes, "row", "tokens", "before", by=("queue",)).join(totals, "queue")
    pieces = placed.select("row", "queue", "before", "tokens", "size").mapInArrow(
        cut, "row long, queue string, sent long, round long, start long, length long"
    )
    return stored(pieces, "packing-pieces")  # a few numbers per piece, used three times


def in_stream(pieces: DataFrame) -> DataFrame:
    """row, pieces: for each document the start, length and place in the stream of its pieces.

    A round holds one stretch of each queue; in it a piece is as far from the stretch's begin as in its queue.
    """
    stretches = pieces.groupBy("round", "queue").agg(F.sum("length").alias("length"), F.min("sent").alias("first"))
    stretches = stored(stretches, "packing-rounds")
    per_round = stretches.groupBy("round").agg(F.sum("length").alias("round_tokens"))
    begins = totals_before(per_round, "round", "round_tokens", "round_begin").select("round", "round_begin")
    earlier = Window.partitionBy("round").orderBy("queue").rowsBetween(Window.unboundedPreceding, -1)
    shifts = (
        stretches.withColumn("ahead", F.coalesce(F.sum("length").over(earlier), F.lit(0)))
        .join(begins, "round")
        .select("round", "queue", (F.col("round_begin") + F.col("ahead") - F.col("first")).alias("shift"))
    )
    placed = pieces.join(shifts, ["round", "queue"]).select(
        "row", F.struct("start", "length", (F.col("sent") + F.col("shift")).alias("begin")).alias("piece")
    )
    return placed.groupBy("row").agg(F.collect_list("piece").alias("pieces"))  # of one document


def pack(
    docs: DataFrame,
    tokenizer: str,
    doc_id: str = "doc_id",
    text: str = "text",
    source: str = "source",
    length: int = 2048,
    end_id: int = 1,
    window_sequences: int = 64,
    targets: dict[str, float] | None = None,
    with_ids: bool = False,
) -> DataFrame:
    """One row per piece of a document.

    doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset, window_id, and the piece's
    ``ids`` if asked for. A window is ``window_sequences`` sequences; of each source it has its
    target, or what is left of it, give or take a token.
    """
    table = tokenised(docs, doc_id, text, source, tokenizer, end_id)
    pieces = in_rounds(table.select("row", "queue", "tokens"), length * window_sequences, targets)
    id_type = table.schema["doc_id"].dataType.simpleString()

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            lists = batch.column(2)
            pieces = zip(*(field.to_pylist() for field in lists.flatten().flatten()))  # start, length, begin
            counts = np.diff(lists.offsets.to_numpy()).tolist()
            for at, (blob, count) in enumerate(zip(batch.column(1).to_pylist(), counts)):
                ids = unpacked(blob)
                for done, size, begin in islice(pieces, count):
                    until = done + size
                    while done < until:
                        sequence, offset = divmod(begin, length)
                        piece = ids[done : min(until, done + length - offset)]
                        rows.append((at, done, len(piece), zlib.crc32(piece.tobytes()), len(ids), sequence, offset,
                                     sequence // window_sequences, piece if with_ids else None))
                        done += len(piece)
                        begin += len(piece)
            if not rows:
                continue
            at, *columns, taken_ids = zip(*rows)
            taken = pa.array(at, pa.int64())
            arrays = [batch.column(0).take(taken), *(pa.array(c, pa.int64()) for c in columns)]
            names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", "window_id"]
            if with_ids:
                arrays.append(pa.array([p.tolist() for p in taken_ids], pa.list_(pa.int32())))
                names.append("ids")
            yield pa.RecordBatch.from_arrays(arrays, names)

    placed = table.select("row", "doc_id", "ids").join(in_stream(pieces), "row").select("doc_id", "ids", "pieces")
    return placed.mapInArrow(
        cut,
        f"doc_id {id_type}, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, "
        "offset long, window_id long" + (", ids array<int>" if with_ids else ""),
    )


def digest(docs: DataFrame) -> DataFrame:
    return pack(docs, word_tokenizer())
