"""Table sources and sinks: bronze append with schema growth, full refresh,
report export and fitted statistics."""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F

from touchline.operators.scaling import STATS_DDL


def read_table(spark: SparkSession, path: str, evolved: bool = False) -> DataFrame:
    """A Parquet table; `evolved` merges the schemas of its appends."""
    return spark.read.option("mergeSchema", str(evolved).lower()).parquet(path)


def missing_columns(incoming: DataFrame, existing: Sequence[str]) -> list[str]:
    """Columns the table has to gain, compared without regard to case."""
    known = {c.upper() for c in existing}
    return [c for c in incoming.columns if c.upper() not in known]


def align_schema(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Every column of `columns` under its name there, as text where absent, then
    whatever else `df` has; names are compared without regard to case."""
    own = {c.upper(): c for c in df.columns}
    known = [F.col(f"`{own[c.upper()]}`") if c.upper() in own else F.lit(None).cast("string") for c in columns]
    rest = missing_columns(df, columns)
    return df.select(*[k.alias(c) for k, c in zip(known, columns)], *[F.col(f"`{c}`") for c in rest])


def append_bronze(df: DataFrame, path: str) -> None:
    """Append; new columns appear in older rows as null when read `evolved`.

    Columns that are null throughout still get written, so the table's schema
    only ever grows. Parallelism is the number of partitions.
    """
    df.write.mode("append").option("parquet.block.size", str(ROW_GROUP_BYTES)).parquet(path)


#: Bytes of a row group before it is compressed. A row group is read by one task: of wide
#: rows of text, which shrink to a tenth, groups of the usual size would leave most cores
#: without work, however many tasks the file is split for.
ROW_GROUP_BYTES = 16 << 20


def write_table(df: DataFrame, path: str, row_group: int = ROW_GROUP_BYTES) -> None:
    """Full refresh, laid out so that the next read splits without a shuffle."""
    df.write.mode("overwrite").option("parquet.block.size", str(row_group)).parquet(path)


def refresh(df: DataFrame, path: str) -> DataFrame:
    """Full refresh of a layer's table, read back for its several consumers."""
    write_table(df, path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def refresh_bucketed(df: DataFrame, path: str, keys: Sequence[str]) -> DataFrame:
    """Full refresh into as many buckets by `keys` as there are shuffle partitions, one
    sorted file each: joins and windows on these keys then need no exchange. The layout is
    known to this application's catalog; a plain read of `path` works anywhere."""
    spark = df.sparkSession
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    name = f"bucketed_{uuid.uuid4().hex}"
    writer = df.repartition(buckets, *keys).write.format("parquet").mode("overwrite").bucketBy(buckets, *keys).sortBy(*keys)
    writer.option("path", path).option("parquet.block.size", str(ROW_GROUP_BYTES)).saveAsTable(name)
    return spark.table(name)


def export_csv(df: DataFrame, path: str, first: Sequence[str] = ()) -> None:
    """Report with the `first` columns leading, written by the executors."""
    ordered = [*first, *[c for c in df.columns if c not in first]]
    df.select(*ordered).write.mode("overwrite").option("header", "true").csv(path)


def save_stats(stats: DataFrame, path: str) -> None:
    stats.write.mode("overwrite").parquet(path)


def load_stats_table(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(STATS_DDL).parquet(path)
