"""A log of messages with offsets, as a streaming source of Spark's data source API.

Messages lie in numbered partitions, each in the order of its offsets, as at a broker.
`append_log` adds a segment; the source `event_log` reads ranges of offsets, and Spark
keeps in the checkpoint which range each batch has read: a query that fails and starts
again reads that very range anew, and nothing twice after it is committed.
"""

from __future__ import annotations

import json
from collections.abc import Iterator

import pyarrow.dataset as ds
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession, Window, functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceStreamReader, InputPartition

from touchline.streaming.keyed import read_sink

SCHEMA = "partition int, offset long, key string, value string"
SEGMENTS = "partition int, segment int, first long, next long"
PARTITIONS = 8


def append_log(df: DataFrame, path: str, order: str, partitions: int = PARTITIONS) -> int:
    """Add the messages of `df` (key, value, and `order` with their sequence) as a segment
    and return its number. A key always goes to the same partition; whole numbers go by
    their remainder. The segment counts as soon as its list of offsets is there, so a
    write that fails adds nothing."""
    spark = df.sparkSession
    known = read_sink(spark, f"{path}/segments", SEGMENTS)
    ends = {r["partition"]: r["next"] for r in known.groupBy("partition").agg(F.max("next").alias("next")).collect()}
    segment = (known.agg(F.max("segment")).first()[0] or 0) + 1
    whole = F.col("key").try_cast("long")
    place = F.coalesce(F.pmod(whole, F.lit(partitions)), F.pmod(F.xxhash64("key"), F.lit(partitions))).cast("int")
    base = F.coalesce(F.try_element_at(F.create_map(*[F.lit(x) for pair in ends.items() for x in pair]), F.col("partition")), F.lit(0)) if ends else F.lit(0)
    # One task for each partition of the log, as each has one order.
    row = F.row_number().over(Window.partitionBy("partition").orderBy(order, "key", "value"))
    rows = df.withColumn("partition", place).withColumn("offset", (base + row - 1).cast("long"))
    at = f"{path}/messages/segment={segment}"
    rows.select("partition", "offset", F.col("key").cast("string").alias("key"), "value").write.mode("overwrite").partitionBy("partition").parquet(at)
    stored = spark.read.schema(SCHEMA).parquet(at)
    listed = stored.groupBy("partition").agg(F.min("offset").alias("first"), (F.max("offset") + 1).alias("next"))
    listed.withColumn("segment", F.lit(segment)).coalesce(1).write.mode("append").parquet(f"{path}/segments")
    return segment


def _open(path: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(path) if ":" in path else (fs.LocalFileSystem(), path)


class _Range(InputPartition):
    def __init__(self, partition: int, segment: int, start: int, end: int):
        self.partition, self.segment, self.start, self.end = partition, segment, start, end


class _Log:
    def __init__(self, options: dict):
        self.path = options["path"].rstrip("/")
        #: Messages of one task.
        self.step = int(options.get("rowspertask", 1_000_000))

    def segments(self) -> list[dict]:
        store, root = _open(self.path)
        if store.get_file_info(f"{root}/segments").type == fs.FileType.NotFound:
            return []
        return ds.dataset(f"{root}/segments", filesystem=store, format="parquet").to_table().to_pylist()

    def ends(self) -> dict[str, int]:
        out: dict[str, int] = {}
        for s in self.segments():
            out[str(s["partition"])] = max(s["next"], out.get(str(s["partition"]), 0))
        return out

    def ranges(self, start: dict[str, int], end: dict[str, int]) -> list[_Range]:
        out = []
        for s in self.segments():
            a = max(s["first"], start.get(str(s["partition"]), 0))
            b = min(s["next"], end.get(str(s["partition"]), 0))
            out += [_Range(s["partition"], s["segment"], at, min(b, at + self.step)) for at in range(a, b, self.step)]
        return out

    def read(self, part: _Range) -> Iterator:
        store, root = _open(self.path)
        folder = f"{root}/messages/segment={part.segment}/partition={part.partition}"
        files = ds.dataset(folder, filesystem=store, format="parquet")
        inside = (ds.field("offset") >= part.start) & (ds.field("offset") < part.end)
        for batch in files.scanner(["offset", "key", "value"], filter=inside).to_batches():
            for offset, key, value in zip(*(batch.column(c).to_pylist() for c in ("offset", "key", "value"))):
                yield part.partition, offset, key, value


class _Stream(_Log, DataSourceStreamReader):
    def initialOffset(self) -> dict:
        return {}

    def latestOffset(self) -> dict:
        return self.ends()

    def partitions(self, start: dict, end: dict) -> list[_Range]:
        return self.ranges(start, end)

    def commit(self, end: dict) -> None:
        pass


class _Batch(_Log, DataSourceReader):
    def partitions(self) -> list[_Range]:
        return self.ranges({}, self.ends())


class EventLog(DataSource):
    """Source `event_log` with option `path`: (partition, offset, key, value)."""

    @classmethod
    def name(cls) -> str:
        return "event_log"

    def schema(self) -> str:
        return SCHEMA

    def streamReader(self, schema) -> _Stream:
        return _Stream(self.options)

    def reader(self, schema) -> _Batch:
        return _Batch(self.options)


def read_log(spark: SparkSession, path: str) -> DataFrame:
    """The log as a stream, from its first offset or from where a checkpoint stands."""
    spark.dataSource.register(EventLog)
    return spark.readStream.format("event_log").load(path)


def offsets_of(spark: SparkSession, checkpoint: str, batch_id: int) -> dict[str, int]:
    """The offsets at which a batch of the query ended, as its checkpoint has them."""
    lines = [r["value"] for r in spark.read.text(f"{checkpoint}/offsets/{batch_id}").collect()]
    return json.loads(lines[2])
