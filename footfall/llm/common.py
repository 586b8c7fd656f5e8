"""Helpers that several operators share."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from footfall.session import work_dir

# The white space that the operators' contracts name.
ASCII_SPACE = " \t\n\x0b\x0c\r"


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def stored(frame: DataFrame, name: str) -> DataFrame:
    """``frame`` as a table in the shared work folder.

    It cuts the lineage: a lost executor re-reads the table, wherever it runs.
    """
    spark = frame.sparkSession
    path = work_dir(spark, name)
    frame.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(frame.schema).parquet(path)


def free_names(frame: DataFrame, *wanted: str) -> list[str]:
    """The wanted names, with underscores in front until no column has them (in any case)."""
    taken = {name.lower() for name in frame.columns}
    names = []
    for name in wanted:
        while name.lower() in taken:
            name = f"_{name}"
        taken.add(name.lower())
        names.append(name)
    return names


def is_held_out(doc_id: str) -> Column:
    """Rows that no model may learn from; a row without an id is not one."""
    remainder = F.pmod(F.crc32(F.col(doc_id).cast("string").cast("binary")), F.lit(3))
    return F.coalesce(remainder == 1, F.lit(False))


def totals_before(
    rows: DataFrame, order: str, amount: str, into: str, by: tuple[str, ...] = (), spans: tuple[int, ...] = (512, 4096)
) -> DataFrame:
    """Adds the sum of ``amount`` over the rows of the same ``by`` with a smaller ``order``.

    ``order`` is a long, unique within ``by``. The sums are taken in levels: within blocks of
    ``spans[0]`` consecutive orders, over blocks within bands of ``spans[1]`` blocks, and last
    over one row per band. So a group with most of the rows is spread like any other.
    """
    inner, outer, block = free_names(rows, "inner", "outer", "block")
    if not spans:
        earlier = Window.partitionBy(*by).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
        return rows.withColumn(into, F.coalesce(F.sum(amount).over(earlier), F.lit(0)).cast("long"))
    rows = rows.withColumn(block, F.expr(f"`{order}` div {spans[0]}"))
    blocks = rows.groupBy(*by, block).agg(F.sum(amount).alias(outer))
    begin = f"{block}_begin"
    blocks = totals_before(blocks, block, outer, begin, by, spans[1:]).drop(outer)
    earlier = Window.partitionBy(*by, block).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    return (
        rows.withColumn(inner, F.coalesce(F.sum(amount).over(earlier), F.lit(0)))
        .join(blocks, [*by, block])
        .withColumn(into, (F.col(inner) + F.col(begin)).cast("long"))
        .drop(block, inner, begin)
    )


def with_ranks(rows: DataFrame, by: list[str], order: list[str], into: str, name: str) -> DataFrame:
    """Adds each row's place, from 0 and without gaps, among the rows of the same ``by`` (no nulls there).

    Rows are dealt by ranges of ``by`` and ``order``, sorted where they are and stored. What places
    the tasks after one another is one row per task and group. A group with most of the rows is
    spread over many tasks, as long as its rows differ in ``order``.
    """
    place, part, count, first = free_names(rows, "place", "part", "count", "first")
    at = F.monotonically_increasing_id()  # the task in the upper bits, the place in it below
    dealt = rows.repartitionByRange(*by, *order).sortWithinPartitions(*by, *order).withColumn(place, at)
    dealt = stored(dealt, name).withColumn(part, F.shiftright(place, 33))
    earlier = Window.partitionBy(*by).orderBy(part).rowsBetween(Window.unboundedPreceding, -1)
    begins = (
        dealt.groupBy(*by, part)
        .agg(F.count("*").alias(count), F.min(place).alias(first))
        .withColumn(first, F.coalesce(F.sum(count).over(earlier), F.lit(0)) - F.col(first))
        .drop(count)
    )
    placed = dealt.join(begins, [*by, part]).withColumn(into, F.col(place) + F.col(first))
    return placed.select(*rows.columns, into)
