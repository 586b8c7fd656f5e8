"""Language-model scores of documents by stupid backoff, computed by joins on n-gram counts.

Every document is scored by the counts of all other documents: its own occurrences are taken off
each count, so a text does not prove itself likely. The score of a word is the relative frequency
of the longest n-gram that others have, ``count(n-gram) / count(its context)``, times ``alpha`` for
each order that failed; a word that no other document has counts as a frequency of one, times
``alpha`` once more. A document's score is the sum of the logarithms.

1. Groups: texts are gathered into rows of a few megabytes, in a shared table with buckets.
2. Requests: a group sends the 64-bit hash and count of each of its distinct n-grams to the slice
   of the hash range that it belongs to. A slice has a fixed share of the hashes, and there are
   as many slices as the corpus is large.
3. Count tables: a slice adds up the counts of all groups for each hash and order, and answers
   every request with the totals.
4. Higher orders: an n-gram can be in another document only if its two parts are, so from three
   words on a group asks for those n-grams only whose parts the answers so far have found.
5. Scores: a group joins its answers, takes off each document's own counts, and sums up.

An n-gram that is in every document is one number per group and never a hot key; what a task
holds is one slice of one order, or one group. Hashes and counts are packed for the shuffle.

Words are runs of characters other than ASCII blanks, with A-Z in lower case; n-grams do not
reach over a document's start. Defined cases: null and empty texts have zero words, score zero
and no mean; repeated rows are documents of their own; an empty table gives an empty result.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from footfall.llm.common import ASCII_SPACE, stored
from footfall.llm.tokens import utf8
from footfall.session import work_dir

GROUP_BYTES = 6 << 20
SLICE_CHARS = 2 << 20
MICRO = 1_000_000
BASE = 0x5851F42D4C957F2D  # odd, so it has an inverse modulo 2 ** 64
INVERSE = pow(BASE, -1, 1 << 64)
MIX = np.uint64(0x9E3779B97F4A7C15)

LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
BLANK = np.zeros(256, bool)
BLANK[list(ASCII_SPACE.encode())] = True


def mixed(h: np.ndarray) -> np.ndarray:
    """A reversible spread of the bits, so that all of them depend on all."""
    for _ in range(2):
        h = (h ^ h >> np.uint64(32)) * MIX
    return h ^ h >> np.uint64(32)


def word_hashes(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """A hash of each word, and the number of words of each text."""
    raw = LOWER[np.frombuffer(b" ".join(texts) + b" ", np.uint8)]
    blank = BLANK[raw]
    begin = np.flatnonzero(~blank & np.concatenate([[True], blank[:-1]]))
    end = np.flatnonzero(blank & ~np.concatenate([[True], blank[:-1]]))
    # polynomials of the bytes: a word's is a difference of running sums, moved to its start
    power, back = (np.full(len(raw), base, np.uint64) for base in (BASE, INVERSE))
    power[0] = back[0] = 1
    power, back = np.cumprod(power), np.cumprod(back)
    sums = np.zeros(len(raw) + 1, np.uint64)
    np.cumsum((raw.astype(np.uint64) + np.uint64(1)) * power, out=sums[1:])
    hashes = mixed((sums[end] - sums[begin]) * back[begin] + (end - begin).astype(np.uint64))
    text_end = np.cumsum([len(t) + 1 for t in texts])
    return hashes, np.diff(np.searchsorted(begin, np.concatenate([[0], text_end])))


def ngram_hashes(words: np.ndarray, order: int) -> list[np.ndarray]:
    """For n = 1 ... order the hash of the n words that end at each position; the first n - 1 mean nothing."""
    found, raw = [], words
    for n in range(1, order + 1):
        if n > 1:
            raw = np.concatenate([raw[:1], raw[:-1] * MIX + words[1:]])
        found.append(mixed(raw))
    return found


def press(values: np.ndarray) -> bytes:
    """Bytes of one weight together, then compressed."""
    planes = np.ascontiguousarray(values).view(np.uint8).reshape(len(values), values.itemsize).T
    return zstandard.ZstdCompressor(level=1).compress(np.ascontiguousarray(planes).tobytes())


def expand(blob: bytes, kind: type) -> np.ndarray:
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(blob), np.uint8)
    return np.ascontiguousarray(planes.reshape(np.dtype(kind).itemsize, -1).T).view(kind)[:, 0] if len(planes) else np.empty(0, kind)


def press_sorted(values: np.ndarray) -> bytes:
    return press(np.diff(values, prepend=np.uint64(0)))


def expand_sorted(blob: bytes) -> np.ndarray:
    return np.cumsum(expand(blob, np.uint64), dtype=np.uint64)


def slice_of(hashes: np.ndarray, slices: int) -> np.ndarray:
    """Equal ranges of the hashes, in their order."""
    return ((hashes >> np.uint64(32)) * np.uint64(slices) >> np.uint64(32)).astype(np.int64)


def places(sizes: np.ndarray) -> np.ndarray:
    """The place of each word in its text."""
    ends = np.cumsum(sizes)
    return np.arange(int(sizes.sum())) - np.repeat(ends - sizes, sizes)


def unpack_group(body: bytes) -> tuple[pa.Array, list[bytes]]:
    table = pa.ipc.open_stream(body).read_all().combine_chunks()
    return table.column(0).combine_chunks() if table.num_rows else pa.array([]), table.column(1).to_pylist()


def known_elsewhere(
    words: np.ndarray, sizes: np.ndarray, order: int, totals: dict[int, np.ndarray]
) -> tuple[list[np.ndarray], np.ndarray, np.ndarray]:
    """Per order, how often other documents have the n-gram that ends at each position of a group.

    ``totals``: for each order that is known the corpus counts of the group's distinct n-grams, in
    the order of their hashes. With those of lower orders only, the last two results are the next
    order's distinct hashes and their counts in the group.
    """
    place, doc = places(sizes), np.repeat(np.arange(len(sizes)), sizes)
    others: list[np.ndarray] = []
    distinct, counts = np.empty(0, np.uint64), np.empty(0, np.int64)
    for n, hashes in enumerate(ngram_hashes(words, order), 1):
        can = place >= n - 1
        if n > 2:  # an n-gram that others have is made of parts that others have
            can &= (others[-1] > 0) & np.concatenate([[False], others[-1][:-1] > 0])[: len(can)]
        at = np.flatnonzero(can)
        distinct, number, counts = np.unique(hashes[at], return_inverse=True, return_counts=True)
        if n not in totals:
            break
        _, which, own = np.unique(doc[at] * np.int64(len(distinct) + 1) + number, return_inverse=True, return_counts=True)
        count = np.zeros(len(place), np.int64)
        count[at] = totals[n][number].astype(np.int64) - own[which]
        others.append(count)
    return others, distinct, counts


def group_scores(others: list[np.ndarray], sizes: np.ndarray, words: int, alpha: float) -> np.ndarray:
    """Summed micro-logarithms of each document."""
    place, doc = places(sizes), np.repeat(np.arange(len(sizes)), sizes)
    order = len(others)
    longest = np.minimum(place + 1, order)
    rest = np.maximum(1, words - sizes[doc])
    chance = np.where(others[0] > 0, others[0], alpha)
    log = np.zeros(len(place))
    open_ = np.ones(len(place), bool)
    for n in range(order, 1, -1):
        hit = np.flatnonzero(open_ & (others[n - 1] > 0) & (place >= n - 1))
        log[hit] = np.log(np.power(alpha, longest[hit] - n) * others[n - 1][hit] / others[n - 2][hit - 1])
        open_[hit] = False
    left = np.flatnonzero(open_)
    log[left] = np.log(np.power(alpha, longest[left] - 1) * chance[left] / rest[left])
    micro = np.rint(log * MICRO).astype(np.int64)
    sums = np.concatenate([[0], np.cumsum(micro)])
    ends = np.cumsum(sizes)
    return sums[ends] - sums[ends - sizes]


def request(group: int, n: int, distinct: np.ndarray, counts: np.ndarray, slices: int) -> pa.RecordBatch:
    """What a group sends to each slice for one order."""
    edges = np.searchsorted(slice_of(distinct, slices), np.arange(slices + 1))
    full = np.flatnonzero(np.diff(edges))
    spans = [slice(edges[s], edges[s + 1]) for s in full]
    return pa.RecordBatch.from_arrays(
        [
            pa.array(full, pa.int64()),
            pa.array([n] * len(full), pa.int64()),
            pa.array([group] * len(full), pa.int64()),
            pa.array([press_sorted(distinct[s]) for s in spans], pa.binary()),
            pa.array([press(counts[s].astype(np.uint32)) for s in spans], pa.binary()),
        ],
        ["slice", "n", "group", "hashes", "counts"],
    )


REQUEST = "slice long, n long, group long, hashes binary, counts binary"


def answered(requests: DataFrame) -> DataFrame:
    """group, n, slice, body: the corpus counts of the hashes of each request, in their order."""

    def add_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """The count table of one slice and order at a time, and what it answers to each group."""
        at, held = None, []

        def answers():
            hashes = [expand_sorted(blob) for _, blob, _ in held]
            counts = np.concatenate([expand(blob, np.uint32) for _, _, blob in held])
            _, which = np.unique(np.concatenate(hashes), return_inverse=True)
            total = np.bincount(which, weights=counts).astype(np.uint64)[which]
            ends = np.cumsum([len(h) for h in hashes])
            return pa.RecordBatch.from_arrays(
                [
                    pa.array([group for group, _, _ in held], pa.int64()),
                    pa.array([at[1]] * len(held), pa.int64()),
                    pa.array([at[0]] * len(held), pa.int64()),
                    pa.array([press(part) for part in np.split(total, ends[:-1])], pa.binary()),
                ],
                ["group", "n", "slice", "body"],
            )

        for batch in batches:
            for part, n, group, hashes, counts in zip(*(c.to_pylist() for c in batch.columns)):
                if at != (part, n) and held:
                    yield answers()
                    held = []
                at = (part, n)
                held.append((group, hashes, counts))
        if held:
            yield answers()

    dealt = requests.repartition("slice").sortWithinPartitions("slice", "n")
    return stored(dealt.mapInArrow(add_up, "group long, n long, slice long, body binary"), "backoff-counts")


def with_answers(groups: DataFrame, answers: DataFrame) -> DataFrame:
    """group, body, answers: a row for each group; the groups' texts stay in their buckets."""
    by_group = answers.groupBy("group").agg(F.collect_list(F.struct("n", "slice", "body")).alias("answers"))
    return groups.select("group", "body").join(by_group, "group", "left")


def totals_of(answers: list[dict] | None) -> dict[int, np.ndarray]:
    totals: dict[int, list] = {}
    for answer in sorted(answers or [], key=lambda a: (a["n"], a["slice"])):
        totals.setdefault(answer["n"], []).append(expand(answer["body"], np.uint64))
    return {n: np.concatenate(parts) for n, parts in totals.items()}


def in_buckets(frame: DataFrame, name: str, by: str) -> DataFrame:
    """A shared table with the rows of a key's hash in files of their own, so that joins do not move it."""
    spark = frame.sparkSession
    table = f"footfall_{name}_{uuid.uuid4().hex}"
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    writer = frame.write.option("path", work_dir(spark, name)).option("compression", "zstd")
    writer.bucketBy(buckets, by).sortBy(by).saveAsTable(table)
    found = spark.table(table)
    spark.sql(f"DROP TABLE {table}")  # the name only; the files stay
    return found


def scores(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", order: int = 3, alpha: float = 0.4
) -> DataFrame:
    """doc_id, n_words, log_score, mean_log of each row."""
    docs = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    id_type = docs.schema["doc_id"].dataType.simpleString()

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        size = 0

        def group():
            table = pa.Table.from_batches(held)
            sink = pa.BufferOutputStream()
            with pa.ipc.new_stream(sink, table.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as out:
                out.write_table(table.combine_chunks())
            _, sizes = word_hashes(table.column("text").to_pylist())
            body = sink.getvalue().to_pybytes()
            return pa.RecordBatch.from_arrays([pa.array([int(sizes.sum())]), pa.array([body], pa.binary())], ["words", "body"])

        for batch in batches:
            ids, texts = batch.column(0), utf8(batch.column(1))
            begin = 0
            for i, value in enumerate(texts):
                size += len(value)
                if size >= GROUP_BYTES or i + 1 == len(texts):
                    held.append(
                        pa.RecordBatch.from_arrays([ids[begin : i + 1], pa.array(texts[begin : i + 1], pa.binary())], ["doc_id", "text"])
                    )
                    begin = i + 1
                    if size >= GROUP_BYTES:
                        yield group()
                        held, size = [], 0
        if held:
            yield group()

    numbered = docs.mapInArrow(gather, "words long, body binary").select(F.monotonically_increasing_id().alias("group"), "*")
    groups = in_buckets(numbered, "backoff_groups", "group")
    words = groups.agg(F.sum("words")).first()[0] or 0
    slices = max(1, -(-(docs.agg(F.sum(F.length("text"))).first()[0] or 0) // SLICE_CHARS))

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Requests for single words and pairs."""
        for batch in batches:
            for group, body in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                word, sizes = word_hashes(unpack_group(body)[1])
                place = places(sizes)
                for n, hashes in enumerate(ngram_hashes(word, min(order, 2)), 1):
                    yield request(group, n, *np.unique(hashes[place >= n - 1], return_counts=True), slices)

    answers = answered(groups.select("group", "body").mapInArrow(ask, REQUEST))
    for n in range(3, order + 1):

        def ask_next(batches: Iterator[pa.RecordBatch], n: int = n) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for group, body, found in zip(*(c.to_pylist() for c in batch.columns)):
                    word, sizes = word_hashes(unpack_group(body)[1])
                    _, distinct, counts = known_elsewhere(word, sizes, n, totals_of(found))
                    yield request(group, n, distinct, counts, slices)

        answers = answers.unionByName(answered(with_answers(groups, answers).mapInArrow(ask_next, REQUEST)))

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, body, found in zip(*(c.to_pylist() for c in batch.columns)):
                ids, texts = unpack_group(body)
                word, sizes = word_hashes(texts)
                totals = totals_of(found)
                none = np.empty(0, np.uint64)
                others, _, _ = known_elsewhere(word, sizes, order, {n: totals.get(n, none) for n in range(1, order + 1)})
                logs = group_scores(others, sizes, words, alpha) / MICRO
                mean = [value / n if n else None for value, n in zip(logs.tolist(), sizes.tolist())]
                yield pa.RecordBatch.from_arrays(
                    [ids, pa.array(sizes, pa.int64()), pa.array(logs, pa.float64()), pa.array(mean, pa.float64())],
                    ["doc_id", "n_words", "log_score", "mean_log"],
                )

    return with_answers(groups, answers).mapInArrow(
        score, f"doc_id {id_type}, n_words long, log_score double, mean_log double"
    )


def digest(docs: DataFrame) -> DataFrame:
    return scores(docs)


ORACLE_SQL = """
WITH texts AS (
  SELECT doc_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x20\\x09-\\x0D]+') AS w
  FROM documents
), words AS (
  SELECT doc_id, generate_subscripts(w, 1) AS i, unnest(w) AS g1 FROM texts
), grams AS (
  SELECT doc_id, i, g1,
    lag(g1) OVER d AS c1,
    lag(g1) OVER d || ' ' || g1 AS g2,
    lag(g1, 2) OVER d || ' ' || lag(g1) OVER d AS c2,
    lag(g1, 2) OVER d || ' ' || lag(g1) OVER d || ' ' || g1 AS g3,
    count(*) OVER (PARTITION BY doc_id) AS n_words,
    count(*) OVER () AS all_words
  FROM words WINDOW d AS (PARTITION BY doc_id ORDER BY i)
), one AS (SELECT g1 AS g, count(*) AS n FROM grams GROUP BY 1),
  two AS (SELECT g2 AS g, count(*) AS n FROM grams WHERE g2 IS NOT NULL GROUP BY 1),
  three AS (SELECT g3 AS g, count(*) AS n FROM grams WHERE g3 IS NOT NULL GROUP BY 1),
  own1 AS (SELECT doc_id, g1 AS g, count(*) AS n FROM grams GROUP BY 1, 2),
  own2 AS (SELECT doc_id, g2 AS g, count(*) AS n FROM grams WHERE g2 IS NOT NULL GROUP BY 1, 2),
  own3 AS (SELECT doc_id, g3 AS g, count(*) AS n FROM grams WHERE g3 IS NOT NULL GROUP BY 1, 2),
counts AS (
  SELECT x.doc_id, i, n_words, greatest(1, all_words - n_words) AS rest,
    a1.n - o1.n AS n1, coalesce(a2.n - o2.n, 0) AS n2, coalesce(a3.n - o3.n, 0) AS n3,
    k1.n - l1.n AS m1, k2.n - l2.n AS m2, least(i, 3) AS longest
  FROM grams x
  LEFT JOIN one a1 ON a1.g = g1 LEFT JOIN own1 o1 ON o1.doc_id = x.doc_id AND o1.g = g1
  LEFT JOIN two a2 ON a2.g = g2 LEFT JOIN own2 o2 ON o2.doc_id = x.doc_id AND o2.g = g2
  LEFT JOIN three a3 ON a3.g = g3 LEFT JOIN own3 o3 ON o3.doc_id = x.doc_id AND o3.g = g3
  LEFT JOIN one k1 ON k1.g = c1 LEFT JOIN own1 l1 ON l1.doc_id = x.doc_id AND l1.g = c1
  LEFT JOIN two k2 ON k2.g = c2 LEFT JOIN own2 l2 ON l2.doc_id = x.doc_id AND l2.g = c2
), logs AS (
  SELECT doc_id, CAST(round_even(1e6 * ln(CASE
    WHEN n3 > 0 THEN power(0.4, longest - 3) * n3 / m2
    WHEN n2 > 0 THEN power(0.4, longest - 2) * n2 / m1
    WHEN n1 > 0 THEN power(0.4, longest - 1) * n1 / rest
    ELSE power(0.4, longest - 1) * 0.4 / rest END), 0) AS BIGINT) AS micro
  FROM counts
), sums AS (SELECT doc_id, count(*) AS n, sum(micro) AS micro FROM logs GROUP BY 1)
SELECT d.doc_id, coalesce(n, 0) AS n_words, coalesce(CAST(micro AS DOUBLE), 0) / 1e6 AS log_score,
  CAST(micro AS DOUBLE) / 1e6 / n AS mean_log
FROM documents d LEFT JOIN sums USING (doc_id)
"""
