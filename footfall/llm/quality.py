"""Quality classifier: histogram gradient-boosted trees over document statistics.

The statistics describe the form of a whole text: its kinds of characters, the lengths and
repetition of its words and lines, how well it compresses. Trees are grown on binned statistics
with logistic loss, and flattened: every tree is a complete binary tree in three arrays, so a
batch of documents walks down all trees at once with array lookups.

Fitting uses at most ``max_rows`` labelled rows that may be learned from (in the order of a hash
of the id; the bound is a parameter). Only their statistics come to the driver. Scoring reads
every row and whole text.

Defined cases: a null text counts as empty; labels that are null, without a document or held
out are not used; without any label of one kind every score is the share of label 1 (0.5
without labels); repeated rows are scored alike; an empty table gives an empty result.
"""

from __future__ import annotations

import math
from collections import Counter
from dataclasses import dataclass

import numpy as np
import pandas as pd
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from footfall.llm.common import free_names, is_held_out

KINDS = 12
SYMBOLS = b"|%$#&*!@~^_<>=+{}[]\\/"


def kinds_of_bytes() -> np.ndarray:
    """The kind of each byte value, for shares of characters."""
    kind = np.full(256, 11)
    for name, values in enumerate(
        (range(97, 123), range(65, 91), range(48, 58), b" ", b"\n", b"\t\r\x0b\x0c", b".,;:", b"!?", b"'\"()-", SYMBOLS)
    ):
        kind[list(values)] = np.where(kind[list(values)] == 11, name, kind[list(values)])
    kind[128:] = 10
    return kind


KIND = kinds_of_bytes()
N_STATISTICS = KINDS + 19


def statistics(text: str | None) -> np.ndarray:
    """Numbers about one whole text; all zero for an empty one."""
    raw = (text or "").encode("utf-8", "surrogatepass")
    out = np.zeros(N_STATISTICS)
    if not raw:
        return out
    size = len(raw)
    by_value = np.bincount(np.frombuffer(raw, np.uint8), minlength=256)
    out[:KINDS] = np.bincount(KIND, weights=by_value, minlength=KINDS)[:KINDS] / size
    words, lines = raw.split(), raw.split(b"\n")
    some = by_value[by_value > 0] / size
    rest = [math.log1p(size), -float((some * np.log2(some)).sum()), len(zstandard.compress(raw, 1)) / size]
    n_words = len(words)
    if n_words:
        lengths = np.fromiter(map(len, words), np.int64, n_words)
        counts = Counter(words)
        pairs = len(set(zip(words, words[1:])))
        last = b"".join([w[-1:] for w in words])
        rest += [
            math.log1p(n_words),
            lengths.mean(),
            lengths.std(),
            float(lengths.max()),
            (lengths <= 3).mean(),
            (lengths >= 12).mean(),
            len(counts) / n_words,
            max(counts.values()) / n_words,
            pairs / max(1, n_words - 1),
            (np.frombuffer(last, np.uint8) < 65).mean(),
            sum(map(bytes.isupper, words)) / n_words,
            sum(map(bytes.isalpha, words)) / n_words,
            sum(w[:1].isupper() for w in words) / n_words,
        ]
    else:
        rest += [0.0] * 13
    rest += [math.log1p(len(lines)), len(set(lines)) / len(lines), size / len(lines)]
    out[KINDS:] = rest
    return out


@dataclass(frozen=True)
class Trees:
    """Complete binary trees of one depth: node i has the children 2 i + 1 and 2 i + 2.

    A row goes right where its statistic exceeds the node's threshold.
    """

    base: float
    feature: np.ndarray  # tree, inner node
    threshold: np.ndarray  # tree, inner node
    value: np.ndarray  # tree, leaf

    def scores(self, rows: np.ndarray) -> np.ndarray:
        total = np.full(len(rows), self.base)
        n_trees, inner = self.feature.shape
        if n_trees:
            tree, row = np.arange(n_trees), np.arange(len(rows))[:, None]
            node = np.zeros((len(rows), n_trees), np.int64)
            for _ in range((inner + 1).bit_length() - 1):
                right = rows[row, self.feature[tree, node]] > self.threshold[tree, node]
                node = 2 * node + 1 + right
            total += self.value[tree, node - inner].sum(axis=1)
        return 1 / (1 + np.exp(-total))


def grow(
    rows: np.ndarray, label: np.ndarray, trees: int, depth: int, bins: int, rate: float, ridge: float
) -> Trees:
    """Boosting by second-order steps; a split is chosen from histograms of the bins."""
    inner = 2**depth - 1
    feature = np.zeros((trees, inner), np.int64)
    threshold = np.full((trees, inner), np.inf)
    value = np.zeros((trees, inner + 1))
    share = label.mean() if len(label) else 0.5
    if not len(label) or not 0 < share < 1:
        base = math.log((share + 1e-6) / (1 - share + 1e-6)) if len(label) else 0.0
        return Trees(base, feature[:0], threshold[:0], value[:0])
    base = math.log(share / (1 - share))
    n_rows, n_features = rows.shape
    edges = [np.unique(np.quantile(rows[:, f], np.arange(1, bins) / bins)) for f in range(n_features)]
    binned = np.stack([np.searchsorted(e, rows[:, f], side="left") for f, e in enumerate(edges)], axis=1)
    offset = np.arange(n_features) * bins
    margin = np.full(n_rows, base)
    for t in range(trees):
        p = 1 / (1 + np.exp(-margin))
        gradient, hessian = p - label, np.maximum(p * (1 - p), 1e-9)
        node = np.zeros(n_rows, np.int64)
        for level in range(depth):
            width = 2**level
            local = node - (width - 1)
            at = (local[:, None] * (n_features * bins) + offset + binned).ravel()
            shape = (width, n_features, bins)
            g, h = (
                np.bincount(at, weights=np.repeat(x, n_features), minlength=math.prod(shape)).reshape(shape).cumsum(axis=2)
                for x in (gradient, hessian)
            )
            all_g, all_h = g[:, :1, -1:], h[:, :1, -1:]
            gain = g**2 / (h + ridge) + (all_g - g) ** 2 / (all_h - h + ridge) - all_g**2 / (all_h + ridge)
            gain[(h < 1) | (all_h - h < 1)] = 0
            gain = gain.reshape(width, -1)
            best = gain.argmax(axis=1)
            for i in np.flatnonzero(gain[np.arange(width), best] > 1e-6):
                f, b = divmod(int(best[i]), bins)
                if b < len(edges[f]):
                    feature[t, width - 1 + i], threshold[t, width - 1 + i] = f, edges[f][b]
            right = rows[np.arange(n_rows), feature[t, node]] > threshold[t, node]
            node = 2 * node + 1 + right
        leaf = node - inner
        g = np.bincount(leaf, weights=gradient, minlength=inner + 1)
        h = np.bincount(leaf, weights=hessian, minlength=inner + 1)
        value[t] = -rate * g / (h + ridge)
        margin += value[t, leaf]
    return Trees(base, feature, threshold, value)


@F.pandas_udf(T.ArrayType(T.DoubleType()))
def statistics_of(texts: pd.Series) -> pd.Series:
    return pd.Series([statistics(text) for text in texts])


def fit(
    docs: DataFrame,
    labels: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    max_rows: int = 20_000,
    trees: int = 100,
    depth: int = 4,
    bins: int = 64,
    rate: float = 0.15,
    ridge: float = 1.0,
) -> Trees:
    """Trees learned from ``labels`` (doc_id, quality) of rows that are not held out."""
    sample = (
        labels.select(F.col("doc_id").alias("id"), F.col("quality").cast("double").alias("quality"))
        .filter(F.col("quality").isNotNull() & F.col("id").isNotNull() & ~is_held_out("id"))
        .distinct()
        .orderBy(F.xxhash64("id"), "id", "quality")
        .limit(max_rows)
    )
    # the sample has at most max_rows rows of two numbers, so it can go to every task; rows that repeat an id count once
    rows = (
        docs.select(F.col(doc_id).alias("id"), F.col(text).alias("text"))
        .join(F.broadcast(sample), "id")
        .groupBy("id", "quality")
        .agg(F.min(statistics_of("text")).alias("numbers"))
        .orderBy(F.xxhash64("id"), "id", "quality", "numbers")
        .limit(max_rows)
        .toPandas()
    )
    matrix = np.stack(rows["numbers"].to_numpy()) if len(rows) else np.zeros((0, N_STATISTICS))
    return grow(matrix, rows["quality"].to_numpy(float), trees, depth, bins, rate, ridge)


def with_score(docs: DataFrame, model: Trees, into: str, text: str = "text") -> DataFrame:
    """``docs`` with each whole text's score; only the text goes to Python."""

    @F.pandas_udf("double")
    def score(texts: pd.Series) -> pd.Series:
        if not len(texts):
            return pd.Series([], dtype=float)
        return pd.Series(model.scores(np.stack([statistics(t) for t in texts])))

    return docs.withColumn(into, score(F.col(text)))


def accepted(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", least: float = 0.5) -> DataFrame:
    """The rows of ``docs`` whose text scores at least ``least``."""
    (score,) = free_names(docs, "score")
    return with_score(docs, fit(docs, labels, doc_id, text), score, text).filter(F.col(score) >= least).drop(score)


def digest(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score, predicted."""
    scored = with_score(docs.select("doc_id", "text"), fit(docs, labels), "score")
    return scored.select(
        "doc_id", is_held_out("doc_id").alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted")
    )
