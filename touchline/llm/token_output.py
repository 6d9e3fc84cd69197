"""Token ids as ORC files: run-length coded ids, row indexes, Bloom filters on ids.

Documents are put in order of `doc_id` by ranges, each range is encoded where it lies
and written as one file. Stripes are small enough that a file splits into several
read tasks; a lookup of some documents reads only row groups whose index and Bloom
filter can hold them.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast, TaskContext
from pyspark.sql import DataFrame, SparkSession, functions as F

from touchline.llm.common import each_batch, sizes
from touchline.llm.tokens import encoder, share_tokenizer

STRIPE_BYTES = 8 << 20
INDEX_ROWS = 1000
FILE_SCHEMA = "part int, doc_id long, before long, n_tokens long, ids array<int>"


def _encode(shared: Broadcast, end_id: int | None):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        before = 0
        part = TaskContext.get().partitionId()
        for batch in batches:
            if not batch.num_rows:
                continue
            values, counts = encoder(shared, end_id).encode_array(batch.column("text"))
            ends = np.concatenate([[0], np.cumsum(counts)])
            arrays = [
                pa.array(np.full(len(counts), part, np.int32)),
                batch.column("doc_id"),
                pa.array(before + ends[:-1]),
                pa.array(counts),
                pa.ListArray.from_arrays(
                    pa.array(ends.astype(np.int32)),
                    pa.array(values.view(np.int32)),
                ),
            ]
            before += int(ends[-1])
            yield pa.RecordBatch.from_arrays(arrays, ["part", "doc_id", "before", "n_tokens", "ids"])

    return run


def write_token_ids(
    docs: DataFrame,
    path: str,
    tokenizer: str,
    end_id: int | None = 0,
    stripe_bytes: int = STRIPE_BYTES,
) -> None:
    """Encode every whole text of `docs` (doc_id, text) and write ORC below `path`.

    Files follow each other in ascending `doc_id` (null ids first), rows within a file
    too; equal ids are ordered by text. A null or empty text has the end id alone.
    Other columns of `docs` are not read. An empty table gives an empty folder of ORC.
    """
    shared = share_tokenizer(docs.sparkSession, tokenizer)
    ordered = (
        docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
        .repartitionByRange("doc_id")
        .sortWithinPartitions("doc_id", "text")
    )
    (
        ordered.mapInArrow(_encode(shared, end_id), FILE_SCHEMA)
        .write.option("orc.bloom.filter.columns", "doc_id")
        .option("orc.create.index", "true")
        .option("orc.row.index.stride", str(INDEX_ROWS))
        .option("orc.stripe.size", str(stripe_bytes))
        .orc(path)
    )


def read_token_ids(spark: SparkSession, path: str, doc_ids: Iterable[int] | None = None) -> DataFrame:
    """The rows written; with `doc_ids` only those, by indexes and Bloom filters."""
    df = spark.read.schema(FILE_SCHEMA).orc(path)
    return df if doc_ids is None else df.where(F.col("doc_id").isin(list(doc_ids)))


def with_starts(df: DataFrame) -> DataFrame:
    """Adds `start`: ids in the files before this document's first one."""
    starts = sizes(df, "part", F.col("n_tokens")).select("part", "part_start")
    return df.join(starts, "part").withColumn("start", F.col("part_start") + F.col("before"))


def _digest(batch: pa.RecordBatch) -> pa.RecordBatch:
    ids = batch.column("ids")
    ends = ids.offsets.to_numpy().astype(np.int64) * 4
    values = ids.values.to_numpy(zero_copy_only=False).astype("<u4", copy=False)
    data = memoryview(np.ascontiguousarray(values)).cast("B")
    crc = [zlib.crc32(data[a:b]) for a, b in zip(ends, ends[1:])]
    arrays = [batch.column("part"), batch.column("doc_id"), batch.column("before")]
    arrays += [pa.array(np.diff(ends) // 4), pa.array(crc, pa.int64())]
    return pa.RecordBatch.from_arrays(arrays, ["part", "doc_id", "before", "n_tokens", "ids_crc32"])


def digests(df: DataFrame) -> DataFrame:
    """Per stored document its start, number of ids and crc32, from the ids read."""
    plain = df.mapInArrow(each_batch(_digest), "part int, doc_id long, before long, n_tokens long, ids_crc32 long")
    starts = sizes(df, "part", F.col("n_tokens")).select("part", "part_start")
    return plain.join(starts, "part").select(
        "doc_id", (F.col("part_start") + F.col("before")).alias("start"), "n_tokens", "ids_crc32"
    )
