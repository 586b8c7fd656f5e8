"""The batch programs: events to features, features to segments, segments to reports."""

from __future__ import annotations

from collections.abc import Iterable
from typing import NamedTuple

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession

from footfall.functions.rules import validate_events
from footfall.functions.time_range import filter_range
from footfall.operators import centres, reports, segments
from footfall.operators.features import user_features
from footfall.operators.temporal import behavior_profile
from footfall.schema import FEATURE_COLUMNS
from footfall.sources.events import read_events
from footfall.sources.tables import (
    read_features, read_landed, read_segments, write_features, write_segments, write_tables,
)


def read_input(spark: SparkSession, input_path: str, landed: bool = False, events: str = "parsed") -> DataFrame:
    """All events that parse, or those that break no rule, of JSON lines or of a landed table."""
    if events not in ("parsed", "valid"):
        raise ValueError(f"events must be 'parsed' or 'valid', not {events!r}")
    if landed:
        return read_landed(spark, input_path, events)
    if events == "valid":
        return validate_events(read_events(spark, input_path, keep_corrupt=True))[0]
    return read_events(spark, input_path)


def transform_events(
    spark: SparkSession,
    input_path: str,
    output_path: str,
    start: str,
    end: str,
    closed: str = "day",
    landed: bool = False,
    temporal: bool = False,
    run_date: str | None = None,
    events: str = "parsed",
) -> None:
    """Write one feature row per user active between ``start`` and ``end``.

    The input is JSON lines, or the table of the landing stream with ``landed=True``,
    where only the folders of these days are read. Of either, ``events="parsed"`` counts
    all events that parse and ``events="valid"`` those that break no rule. ``temporal=True``
    adds time-of-day, session and frequency columns from the same scan.
    """
    read = read_input(spark, input_path, landed, events)
    build = behavior_profile if temporal else user_features
    write_features(build(filter_range(read, start, end, closed)), output_path, run_date)


def single_run(table: DataFrame) -> DataFrame:
    """Refuse a table of several runs, which holds a user once per run."""
    if "run_date" in table.columns:
        raise ValueError("the table is partitioned by run_date: choose one run")
    return table


class SegmentReport(NamedTuple):
    silhouette: float | None
    centers: DataFrame
    sizes: DataFrame
    profile: DataFrame

    def tables(self) -> dict[str, DataFrame]:
        return {"centers": self.centers, "sizes": self.sizes, "profile": self.profile}


def few_rows(summary: DataFrame) -> DataFrame:
    """One row per segment, computed now, so that no storage has to be held for later tables."""
    return summary.sparkSession.createDataFrame(summary.collect(), summary.schema)


def segment_users(
    spark: SparkSession,
    features_path: str,
    output_path: str,
    k: int = 5,
    seed: int = segments.SEED,
    partitions: int | None = None,
    scale: bool = False,
    run_date: str | None = None,
    report_path: str | None = None,
    model_path: str | None = None,
    keep_ids_of: str | None = None,
) -> SegmentReport:
    """Cluster the feature table, write the segment table and describe the segments.

    The features are read once and held in executor storage, next to their vectors, for
    training, scoring and the summary; no join. The returned tables are a few rows each,
    and are written below ``report_path`` if given.

    Starting centres are drawn by a hash and rows stay where they are; with ``partitions``
    MLlib draws them, and the number of partitions is part of the result. ``model_path``
    stores what ``assign_users`` needs; ``keep_ids_of`` names an earlier one whose segment
    ids go on, and may be the same path.
    """
    features = single_run(read_features(spark, features_path, run_date))
    deviations = segments.feature_deviations(features) if scale else None
    vectors = segments.prepare_features(features, scale, deviations)
    vectors = vectors.select("user_id", *FEATURE_COLUMNS, "features")
    placed = segments.fixed_layout(vectors, partitions) if partitions else vectors
    placed = placed.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        if partitions:
            found = centres.of_model(segments.fit_placed(placed, k, seed), deviations)
        else:
            found = centres.fit(placed, k, seed, deviations=deviations)
        if keep_ids_of:
            found = centres.with_ids_of(found, centres.read_segmentation(spark, keep_ids_of))
        predictions = centres.assign(placed, found)
        write_segments(predictions, output_path, run_date)
        score = segments.silhouette(predictions)
        summary = few_rows(reports.segment_summary(predictions))
    finally:
        placed.unpersist()
    if model_path:
        centres.write_segmentation(spark, found, model_path)
    report = SegmentReport(
        silhouette=score,
        centers=centres.centre_table(spark, found),
        sizes=reports.segment_sizes(summary),
        profile=reports.segment_profile(summary),
    )
    if report_path:
        write_tables(report.tables(), report_path)
    return report


def assign_users(
    spark: SparkSession, features_path: str, model_path: str, output_path: str, run_date: str | None = None
) -> DataFrame:
    """Write the segments of a feature table by a stored fit; nothing is fitted. Returns the sizes."""
    features = single_run(read_features(spark, features_path, run_date))
    placed = centres.assign_features(features, centres.read_segmentation(spark, model_path))
    write_segments(placed, output_path, run_date)
    return reports.segment_sizes(reports.segment_summary(read_segments(spark, output_path, run_date)))


def segment_report(
    spark: SparkSession,
    features_path: str,
    segments_path: str,
    segment_ids: Iterable[int] | None = None,
    run_date: str | None = None,
    output_path: str | None = None,
) -> dict[str, DataFrame]:
    """All dashboard results for the chosen segments, each a few rows.

    The two tables are joined and reduced once for all of them. With ``output_path`` every
    table is written there, whole, in a folder of its name.
    """
    features = single_run(read_features(spark, features_path, run_date))
    placed = single_run(read_segments(spark, segments_path, run_date))
    chosen = reports.filter_segments(placed, segment_ids)
    summary = few_rows(reports.segment_summary(reports.profile_join(features, chosen)))
    result = {
        "kpis": reports.kpis(summary, text=True),
        "segment_counts": reports.segment_counts_desc(summary),
        "segment_radar": reports.segment_radar(summary),
        "segment_devices": reports.segment_devices(summary),
        "segment_details": reports.segment_details(summary),
    }
    if output_path:
        write_tables(result, output_path)
    return result
