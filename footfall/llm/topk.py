"""Exact top-k search over integer vectors by no-random-access aggregation.

Vectors are dealt into blocks. A block has one list per dimension, sorted by component; for a
query, a positive component reads its list from the largest value down, a negative one from the
smallest up. Lists are read in equal steps. What has been read of a vector gives a lower bound of
its score (what is missing has the list's worst value) and an upper bound (what is missing has
the value last read, as the lists are sorted). Reading stops when few vectors outside can still
qualify, at the latest at the lists' end; the scores of those few are then resolved exactly, with
integers. Queries of a batch read the same lists in step: the part of each list that a step reads
is a matrix with zeros elsewhere, so reading and bounds are matrix products.

Each block meets each batch of queries in a piece of work of its own; a piece returns at most k
rows per query, and ranks are taken over the pieces' rows.

Defined cases: vectors that are null or hold a null, NaN or infinite component take no part, nor
do rows without an id; vectors of different lengths have no score; rows that repeat id and vector
count once, and no row is a candidate for a query with its id; scores beyond a long are the
nearest long, as are components; an empty table gives an empty result. Ties go to smaller ids.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

STEPS = 4
BATCH = 64
#: Up to so many vectors that can still qualify are resolved.
FEW = 64
LONG = 2**63 - 1


def integers(embedding: Column, scale: int) -> Column:
    """floor(scale * x) of each component, as longs."""

    def one(x):
        scaled = F.floor(F.least(F.greatest(x.cast("double") * scale, F.lit(-(2.0**62))), F.lit(2.0**62)))
        return scaled.cast("long")

    return F.transform(embedding, one)


def usable(embedding: Column) -> Column:
    """Whether a vector and all its components are finite numbers."""
    bad = F.exists(
        embedding, lambda x: x.isNull() | F.isnan(x.cast("double")) | (F.abs(x.cast("double")) == F.lit(float("inf")))
    )
    return embedding.isNotNull() & ~F.coalesce(bad, F.lit(True))


class Block:
    """The sorted lists of some vectors, whose ids ascend."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray):
        self.ids, self.vectors = ids, vectors
        order = np.argsort(vectors, axis=0, kind="stable")
        self.value = np.take_along_axis(vectors, order, axis=0)  # each column is a list, smallest value first
        self.rank = np.empty(vectors.shape, np.int32)
        np.put_along_axis(self.rank, order, np.arange(len(ids), dtype=np.int32)[:, None], axis=0)

    def search(self, query_ids: np.ndarray, queries: np.ndarray, k: int) -> list[tuple[int, int, int]]:
        """(query_id, vec_id, score) of each query's best k in this block."""
        n, dims = self.vectors.shape
        size = max(map(abs, (int(queries.max(initial=0)), int(queries.min(initial=0)))))
        most = max(map(abs, (int(self.vectors.max(initial=0)), int(self.vectors.min(initial=0)))))
        # sums are exact unless components are huge; then bounds are widened by what they may be off
        kind = np.float32 if dims * size * most < 2**24 else np.float64
        slack = 0.0 if dims * size * most < 2**52 else 1e-12 * dims * float(size) * float(most)
        # a query reads the lists of its positive components downwards, of its negative ones upwards
        sides = np.concatenate([np.maximum(queries, 0), np.minimum(queries, 0)], axis=1).astype(kind).T
        vectors = self.vectors.astype(kind)
        top, bottom = self.value[-1].astype(kind), self.value[0].astype(kind)
        worst = np.concatenate([bottom, top])[:, None]
        alive = np.arange(len(query_ids))
        score = np.zeros((n, len(alive)), kind)  # of what has been read
        found: list[tuple[int, int, int]] = []
        read = 0
        for step in range(1, STEPS + 1):
            until = n * step // STEPS
            if until == read:
                continue
            own, down = sides[:, alive], n - 1 - self.rank
            fresh = [np.where((rank >= read) & (rank < until), vectors, kind(0)) for rank in (down, self.rank)]
            score += np.concatenate(fresh, axis=1) @ own
            read = until
            lower = upper = score
            if until < n:
                unread = np.concatenate([down >= until, self.rank >= until], axis=1).astype(kind)
                last = np.concatenate([self.value[n - until], self.value[until - 1]]).astype(kind)[:, None]
                lower, upper = score + unread @ (own * worst), score + unread @ (own * last)
            here = self.ids[:, None] == query_ids[None, alive]
            kth = np.partition(np.where(here, -np.inf, lower), max(0, n - k), axis=0)[max(0, n - k)]
            may = ~here & (upper + 2 * slack >= kth)
            done = may.sum(axis=0) <= max(FEW, 4 * k) if until < n else np.ones(len(alive), bool)
            for column in np.flatnonzero(done):
                rows = np.flatnonzero(may[:, column])
                found += self.resolve(query_ids[alive[column]], queries[alive[column]], rows, k, size * most)
            alive, score = alive[~done], score[:, ~done]
            if not len(alive):
                break
        return found

    def resolve(self, query_id: int, query: np.ndarray, rows: np.ndarray, k: int, most: int) -> list[tuple[int, int, int]]:
        """Exact scores of the vectors that can qualify, and of these the best k."""
        vectors = self.vectors[rows]
        if max(1, vectors.shape[1]) * most <= LONG:
            scores = vectors @ query
            best = np.lexsort((self.ids[rows], -scores))[:k]
            return [(int(query_id), int(self.ids[rows[i]]), int(scores[i])) for i in best]
        exact = [sum(int(a) * int(b) for a, b in zip(v, query)) for v in vectors]
        exact = [max(-LONG - 1, min(LONG, s)) for s in exact]
        best = sorted(range(len(rows)), key=lambda i: (-exact[i], self.ids[rows[i]]))[:k]
        return [(int(query_id), int(self.ids[rows[i]]), exact[i]) for i in best]


def exact_topk(
    vectors: DataFrame,
    queries: DataFrame,
    k: int = 5,
    vec_id: str = "vec_id",
    embedding: str = "embedding",
    scale: int = 256,
    block: int = 8192,
    queries_together: int = 20_000,
) -> DataFrame:
    """query_id, rank, vec_id, score: the k best of ``vectors`` for each row of ``queries``."""

    def prepared(frame: DataFrame) -> DataFrame:
        frame = frame.filter(F.col(vec_id).isNotNull() & usable(F.col(embedding)))
        return frame.select(F.col(vec_id).cast("long").alias("id"), integers(F.col(embedding), scale).alias("vector"))

    # rows that repeat id and vector count once; combined where they are, whatever their number
    candidates, asking = prepared(vectors).distinct(), prepared(queries).distinct()
    blocks = max(1, -(-candidates.count() // block))
    groups = max(1, -(-asking.count() // queries_together))

    def dealt(frame: DataFrame, side: int, own: str, own_parts: int, other: str, other_parts: int) -> DataFrame:
        """Each row in its own part, once for every part of the other side."""
        return frame.select(
            F.size("vector").alias("dims"),
            F.pmod(F.xxhash64("id", "vector"), F.lit(own_parts)).cast("int").alias(own),
            F.explode(F.sequence(F.lit(0), F.lit(other_parts - 1))).alias(other),
            F.lit(side).alias("side"),
            "id",
            "vector",
        ).select("dims", "block", "group", "side", "id", "vector")

    place = ["dims", "block", "group"]
    work = (
        dealt(candidates, 0, "block", blocks, "group", groups)
        .unionByName(dealt(asking, 1, "group", groups, "block", blocks))
        .repartition(*place)
        .sortWithinPartitions(*place, "side", "id")
    )

    def matrix(batch: pa.RecordBatch) -> np.ndarray:
        flat = batch.column(5).flatten().to_numpy(zero_copy_only=False)
        return flat.reshape(batch.num_rows, -1) if batch.num_rows else flat.reshape(0, 0)

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Per piece of work the vectors come first, then the queries."""
        at, ids, rows, lists = None, [], [], None

        for batch in batches:
            keys = np.stack([batch.column(i).to_numpy() for i in range(4)], axis=1) if batch.num_rows else np.zeros((0, 4), int)
            edges = np.flatnonzero((keys[1:] != keys[:-1]).any(axis=1)) + 1
            for a, b in zip([0, *edges], [*edges, len(keys)]):
                if a == b:
                    continue
                part = batch.slice(a, b - a)
                if at != tuple(keys[a, :3]):
                    at, ids, rows, lists = tuple(keys[a, :3]), [], [], None
                if keys[a, 3] == 0:
                    ids.append(part.column(4).to_numpy())
                    rows.append(matrix(part))
                    continue
                if not ids:
                    continue
                if lists is None:
                    lists = Block(np.concatenate(ids), np.concatenate(rows))
                    ids, rows = ids[:1], rows[:1]  # the lists hold them now
                asked, query_rows = part.column(4).to_numpy(), matrix(part)
                for c in range(0, len(asked), BATCH):
                    found = lists.search(asked[c : c + BATCH], query_rows[c : c + BATCH], k)
                    yield pa.RecordBatch.from_pandas(
                        pd.DataFrame(found, columns=["query_id", "vec_id", "score"]).astype("int64"), preserve_index=False
                    )

    best = work.mapInArrow(search, "query_id long, vec_id long, score long")
    ranks = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return best.withColumn("rank", F.row_number().over(ranks)).filter(F.col("rank") <= k).select(
        "query_id", "rank", "vec_id", "score"
    )


def digest(embeddings: DataFrame) -> DataFrame:
    """Every 50th id asks all rows."""
    return exact_topk(embeddings, embeddings.filter(F.col("vec_id") % 50 == 0))


ORACLE_SQL = """
WITH vectors AS (
  SELECT DISTINCT vec_id, list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS v
  FROM embeddings
  WHERE embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scores AS (
  SELECT q.vec_id AS query_id, c.vec_id, CAST(list_inner_product(q.v, c.v) AS BIGINT) AS score
  FROM vectors q JOIN vectors c ON q.vec_id % 50 = 0 AND q.vec_id <> c.vec_id
)
SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank,
  vec_id, score
FROM scores
QUALIFY rank <= 5
"""
