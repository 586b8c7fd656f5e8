"""K-Means user segments: vectors, training, assignment and evaluation."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark import StorageLevel
from pyspark.ml.clustering import KMeans, KMeansModel
from pyspark.ml.evaluation import ClusteringEvaluator
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from footfall.functions.rules import not_finite
from footfall.schema import FEATURE_COLUMNS

SEED = 20240101
#: Partitions of the vectors while K-Means fits. Part of the result: another number, other clusters.
LAYOUT = 64


def slot(name: str) -> Column:
    """A feature as a number: 0.0 where it is missing, NaN or infinite."""
    value = F.col(name).cast("double")
    return F.when(not_finite(value), 0.0).otherwise(F.coalesce(value, F.lit(0.0)))


def feature_deviations(features: DataFrame) -> list[float]:
    """The standard deviation of each slot, by one pass over the table."""
    return [d or 0.0 for d in features.agg(*[F.stddev_samp(slot(name)) for name in FEATURE_COLUMNS]).first()]


def prepare_features(
    features: DataFrame, scale: bool = False, deviations: Sequence[float] | None = None
) -> DataFrame:
    """Add the vector column ``features``; other columns, NULLs included, stay as they are.

    A missing average counts as 0.0 in the vector only. ``scale=True`` divides every slot
    by its standard deviation, the given one or that of the table; a slot without spread is 0.0.
    """
    if scale and deviations is None:
        deviations = feature_deviations(features)
    factors = [1.0 / d if d else 0.0 for d in deviations] if deviations else [1.0] * len(FEATURE_COLUMNS)
    slots = [f"slot_{name}" for name in FEATURE_COLUMNS]
    values = [(slot(name) * F.lit(factor)).alias(own) for name, own, factor in zip(FEATURE_COLUMNS, slots, factors)]
    assembler = VectorAssembler(inputCols=slots, outputCol="features")
    return assembler.transform(features.select("*", *values)).drop(*slots)


def feature_slots(vectors: DataFrame, keys: Sequence[str] = ("user_id",)) -> DataFrame:
    """The vector of each row as one double column per slot."""
    slots = vector_to_array("features")
    return vectors.select(
        *keys, *[slots[i].alias(name) for i, name in enumerate(FEATURE_COLUMNS)]
    )


def fixed_layout(vectors: DataFrame, partitions: int = LAYOUT) -> DataFrame:
    """Hash-partition and sort by user, so that a seed always gives the same clusters.

    K-Means samples its starting centres per partition: the same rows in another layout
    end in other clusters. So the number of partitions is part of the input, like the seed,
    and does not follow the session's shuffle partitions.
    """
    return vectors.repartition(partitions, "user_id").sortWithinPartitions("user_id")


def fit_placed(
    placed: DataFrame, k: int = 5, seed: int = SEED, tol: float = 1e-4, max_iter: int = 20
) -> KMeansModel:
    """Fit K-Means on vectors that have their layout; the caller holds them in storage."""
    kmeans = KMeans(k=k, seed=seed, tol=tol, maxIter=max_iter, featuresCol="features", predictionCol="cluster")
    return kmeans.fit(placed)


def train_kmeans(
    vectors: DataFrame,
    k: int = 5,
    seed: int = SEED,
    partitions: int = LAYOUT,
    tol: float = 1e-4,
    max_iter: int = 20,
) -> KMeansModel:
    """Fit K-Means, holding the vectors in executor storage while it iterates."""
    placed = fixed_layout(vectors.select("user_id", "features"), partitions)
    placed.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        return fit_placed(placed, k, seed, tol, max_iter)
    finally:
        placed.unpersist()


def centre_order(model: KMeansModel) -> list[int]:
    """Cluster ids in order of their centres: total events first, then the other slots."""
    centres = [tuple(centre) for centre in model.clusterCenters()]
    return sorted(range(len(centres)), key=centres.__getitem__)


def assign_segments(model: KMeansModel, vectors: DataFrame) -> DataFrame:
    """Add ``segment``: the nearest centre's position in ``centre_order``."""
    order = centre_order(model)
    position = F.array(*[F.lit(order.index(cluster)) for cluster in range(len(order))])
    return (
        model.transform(vectors)
        .withColumn("segment", F.element_at(position, F.col("cluster") + 1))
        .drop("cluster")
    )


def cluster_centers(
    spark: SparkSession, model: KMeansModel, deviations: Sequence[float] | None = None
) -> DataFrame:
    """One row per (segment, feature) with the centre's coordinate, in the feature's own unit.

    Pass the ``deviations`` that the vectors were divided by, if they were.
    """
    centres = model.clusterCenters()
    units = deviations or [1.0] * len(FEATURE_COLUMNS)
    rows = [
        (segment, feature, float(value) * unit)
        for segment, cluster in enumerate(centre_order(model))
        for feature, value, unit in zip(FEATURE_COLUMNS, centres[cluster], units)
    ]
    return spark.createDataFrame(rows, "segment int, feature string, value double")


def nearest_centroid(
    users: DataFrame, columns: Sequence[str], centroids: Sequence[Sequence[float]]
) -> DataFrame:
    """Add ``segment``, the nearest given centroid; the lowest index wins a tie."""
    values = [F.coalesce(F.col(name).cast("double"), F.lit(0.0)) for name in columns]

    def distance(centroid):
        deltas = [value - F.lit(float(c)) for value, c in zip(values, centroid)]
        return sum((d * d for d in deltas[1:]), deltas[0] * deltas[0])

    ranked = [
        F.struct(distance(centroid).alias("distance"), F.lit(index).alias("segment"))
        for index, centroid in enumerate(centroids)
    ]
    return users.withColumn("segment", F.array_min(F.array(*ranked))["segment"])


def silhouette(predictions: DataFrame) -> float | None:
    """Mean silhouette by squared Euclidean distance; None with fewer than two segments."""
    if predictions.select("segment").distinct().limit(2).count() < 2:
        return None
    evaluator = ClusteringEvaluator(predictionCol="segment", featuresCol="features")
    return evaluator.evaluate(predictions)


def segment_map(predictions: DataFrame) -> DataFrame:
    """The user -> segment table."""
    return predictions.select("user_id", "segment")
