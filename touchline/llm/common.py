"""What several operators share: Arrow helpers, row keys, sizes."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from touchline.session import materialise, scratch_dir, ship_package

__all__ = ["each_batch", "materialise", "row_key", "scratch_dir", "ship_package", "sizes", "table"]

#: Rows of whole texts given to Python at a time; a text may be very long.
TEXT_BATCH = 1000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship_package(spark)
    small_batches(spark)
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def small_batches(spark: SparkSession) -> None:
    """Arrow batches of at most `TEXT_BATCH` rows in this session."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    now = int(spark.conf.get(name))
    if now <= 0 or now > TEXT_BATCH:
        spark.conf.set(name, str(TEXT_BATCH))


def each_batch(fn: Callable[[pa.RecordBatch], pa.RecordBatch]):
    """`fn` over every batch of a partition, for mapInArrow; empty batches are skipped."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                yield fn(batch)

    return run


def row_key(text: str = "text") -> Column:
    """With the document id this tells rows apart; rows alike in both are alike."""
    return F.xxhash64(F.coalesce(F.col(text), F.lit("")), F.col(text).isNull())


def sizes(df: DataFrame, part: str, size: Column) -> DataFrame:
    """One row per `part`: its total and the total of all parts before it.

    Parts are files or ranges, not rows: the window sees one row for each.
    """
    from pyspark.sql import Window

    totals = df.groupBy(part).agg(F.sum(size).alias("part_size"))
    before = Window.orderBy(part).rowsBetween(Window.unboundedPreceding, -1)
    return totals.withColumn("part_start", F.coalesce(F.sum("part_size").over(before), F.lit(0)))
