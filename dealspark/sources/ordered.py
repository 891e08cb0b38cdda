"""A stored result order, for pages deep in a large result.

``page_slice`` takes the head of a result up to the page, which suits the first
pages.  ``store_ordered`` writes the rows once in result order, in files of at
most ``FILE_ROWS`` rows, and a directory of the files: rows before each file and
rows in it.  A page then opens the files that hold it and no others, so that page
1,000,000 costs what page 1 costs.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from dealspark.operators.compose import result_order
from dealspark.operators.ranking import Asc

FILE_ROWS = 100_000


def store_ordered(rows: DataFrame, path: str, order: Sequence[Asc] | None = None, file_rows: int = FILE_ROWS) -> OrderedRows:
    """Write ``rows`` in ``order`` (the result order; it must be total) and the directory under ``path``."""
    order = list(order or result_order())
    by = [k.column() for k in order]
    (rows.repartitionByRange(*by).sortWithinPartitions(*by)
     .write.mode("overwrite").option("maxRecordsPerFile", file_rows).parquet(f"{path}/rows"))
    spark = rows.sparkSession
    # A file's first key; a flag before each value puts nulls where the order has them.
    first = F.struct(*[x for i, k in enumerate(order) for x in (
        (F.col(f"`{k.name}`").isNull() == k.nulls_last).alias(f"n{i}"), F.col(f"`{k.name}`").alias(f"k{i}"))])
    files = (spark.read.schema(rows.schema).parquet(f"{path}/rows")
             .groupBy(F.col("_metadata.file_name").alias("file")).agg(F.min(first).alias("first"), F.count("*").alias("n")))
    # One row per file: the single-partition window is bounded by rows / file_rows and the range partitions.
    before = Window.orderBy("first").rowsBetween(Window.unboundedPreceding, -1)
    (files.select("file", "n", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"))
     .write.mode("overwrite").parquet(f"{path}/directory"))
    return OrderedRows(spark, path, rows.schema, tuple(order))


@dataclass(frozen=True)
class OrderedRows:
    """Rows stored by ``store_ordered``."""

    spark: SparkSession
    path: str
    schema: StructType
    order: tuple[Asc, ...]

    def files(self, low: int, high: int) -> list[tuple[str, int]]:
        """The files that hold ranks from ``low`` up to but not ``high``, and the rows before each."""
        held = self.spark.read.parquet(f"{self.path}/directory").where((F.col("before") < high) & (F.col("before") + F.col("n") > low))
        return sorted(((r["file"], r["before"]) for r in held.collect()), key=lambda x: x[1])

    def page(self, page: int, size: int, out: str = "rank") -> DataFrame:
        """Page ``page`` (1-based) of ``size`` rows, numbered over the whole result."""
        low, high = (page - 1) * size, page * size
        files = self.files(low, high)
        if not files:
            return self.spark.createDataFrame([], self.schema).withColumn(out, F.lit(None).cast("long"))
        rows = self.spark.read.schema(self.schema).parquet(*[f"{self.path}/rows/{f}" for f, _ in files])
        # The rows of the opened files only: a page and two files at the most.
        number = F.row_number().over(Window.orderBy(*[k.column() for k in self.order])) - 1 + F.lit(files[0][1])
        return rows.withColumn(out, number.cast("long")).where(F.col(out).between(low, high - 1))
