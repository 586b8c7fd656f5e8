"""Stored tables under names, for SQL: their files stay where they are, their statistics are kept."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import DataFrame, SparkSession

from footfall.sources.tables import RUN_DATE


def quoted(name: str) -> str:
    """A name of one or more parts, such as ``db.features``, for SQL text."""
    return ".".join(f"`{part.replace('`', '``')}`" for part in name.split("."))


def register_table(spark: SparkSession, name: str, path: str) -> None:
    """Make a parquet folder an external table; partition folders become partitions.

    An existing table of this name is replaced, its files are not touched. Partitions that
    are written later appear after ``refresh_table``.
    """
    spark.sql(f"DROP TABLE IF EXISTS {quoted(name)}")
    spark.catalog.createTable(name, path=path, source="parquet")
    refresh_table(spark, name)


def is_partitioned(spark: SparkSession, name: str) -> bool:
    return any(column.isPartition for column in spark.catalog.listColumns(name))


def refresh_table(spark: SparkSession, name: str) -> None:
    """Take up files and partitions that were written or removed since."""
    spark.catalog.refreshTable(name)
    if is_partitioned(spark, name):
        spark.sql(f"MSCK REPAIR TABLE {quoted(name)} SYNC PARTITIONS")


def analyze_table(spark: SparkSession, name: str, columns: Iterable[str] | None = None) -> None:
    """Count rows, and per column its distinct values, NULLs, least and greatest value.

    Two scans, of ``columns`` only. The numbers are kept with the table until it is analyzed again.
    """
    columns = list(columns) if columns is not None else None
    which = "ALL COLUMNS" if columns is None else f"COLUMNS {', '.join(map(quoted, columns))}"
    if columns == []:
        spark.sql(f"ANALYZE TABLE {quoted(name)} COMPUTE STATISTICS")
    else:
        spark.sql(f"ANALYZE TABLE {quoted(name)} COMPUTE STATISTICS FOR {which}")


def use_statistics(spark: SparkSession) -> None:
    """Let the optimizer estimate sizes and order joins by the tables' statistics."""
    spark.conf.set("spark.sql.cbo.enabled", "true")
    spark.conf.set("spark.sql.cbo.joinReorder.enabled", "true")


def register_tables(spark: SparkSession, tables: Mapping[str, str], statistics: bool = True) -> None:
    """Register parquet folders by name and analyze them."""
    for name, path in tables.items():
        register_table(spark, name, path)
        if statistics:
            analyze_table(spark, name)
    if statistics:
        use_statistics(spark)


def run_of(spark: SparkSession, name: str, run_date: str) -> DataFrame:
    """One run's rows of a registered table."""
    return spark.table(name).filter(f"{RUN_DATE} = DATE '{run_date}'").drop(RUN_DATE)
