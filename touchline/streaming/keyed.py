"""A table that takes no key twice, with an index of the keys it holds.

Beside its events, a table keeps sorted runs of their keys. Every batch adds a small run;
as soon as `fan_out` runs of one level are there, they are merged into one of the next
level, so after b batches there are about `fan_out * log(b)` runs, whatever the number of
batch folders. A manifest per batch lists the files of all runs with their least and
largest key. A batch reads the manifest of the batch before it, by name, and opens only
files whose range holds some of its keys; Parquet's Bloom filters and row group ranges
spare what they can of those. No folder of earlier events is listed or opened.
"""

from __future__ import annotations

import math
from bisect import bisect_left
from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from touchline.session import remove


def read_sink(spark: SparkSession, path: str, schema) -> DataFrame:
    """What a Parquet sink holds; no rows before its first batch."""
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as missing:
        if "PATH_NOT_FOUND" not in str(missing):
            raise
        return spark.createDataFrame([], schema)


@dataclass
class Lookup:
    """What a batch had to open: runs and files of the index, of how many there were."""

    batch: int
    runs: int
    files: int
    of_runs: int
    of_files: int


@dataclass
class KeyedSink:
    """A `foreachBatch` writer that skips keys its table already holds.

    An event is new if no earlier batch stored its key, however late it comes; no state is
    kept that could forget a key or drop an event. Each batch has folders of its own, so
    one that is run again replaces what it wrote. `by` partitions the table; `layout`
    ranges and sorts the files of a part; ranges split a match of any size, as hashing its id would
    not. `then` is given the new events as stored. Keys are whole numbers or text; rows
    without a key are kept once per batch. `lookups` says what each batch has opened.
    """

    path: str
    key: str = "id"
    layout: tuple[str, ...] = ()
    by: tuple[str, ...] = ()
    then: Callable[[DataFrame, int], None] | None = None
    #: Runs of one level that are merged; keys of a file; keys looked up one by one.
    fan_out: int = 8
    file_rows: int = 2_000_000
    few: int = 1000
    lookups: list[Lookup] = field(default_factory=list)

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        spark, schema = batch.sparkSession, batch.schema
        index = self._manifest(spark, schema, batch_id)
        # One row per key is kept for the several passes that follow.
        batch = batch.dropDuplicates([self.key]).persist()
        try:
            known = self._known(batch, index, batch_id)
            fresh = batch
            if known is not None:
                fresh = fresh.join(known, self.key, "left_anti").select(*batch.columns)
            if self.layout:
                # Parts of the table first: a task writes to the few that its range meets.
                order = list(dict.fromkeys((*self.by, *self.layout, self.key)))
                fresh = fresh.repartitionByRange(*order).sortWithinPartitions(*order)
            own = f"{self.path}/batch={batch_id}"
            fresh.write.mode("overwrite").partitionBy(*self.by).parquet(own)
        finally:
            batch.unpersist()
        stored = spark.read.schema(schema).parquet(own)
        self._index(spark, schema, index, stored, batch_id)
        if self.then:
            self.then(stored, batch_id)

    # --- the index ---------------------------------------------------------------

    def _at(self, name: str) -> str:
        return f"{self.path}/_keys/{name}"

    def _manifest_schema(self, schema: T.StructType) -> str:
        kind = schema[self.key].dataType.simpleString()
        return f"run string, level int, live boolean, file string, low {kind}, high {kind}, rows long"

    def _manifest(self, spark: SparkSession, schema: T.StructType, batch_id: int) -> list[dict]:
        """Files of the live runs before this batch. What the batch before it replaced can
        go now: that batch is done and will not run again."""
        if batch_id == 0:
            return []
        try:
            rows = spark.read.schema(self._manifest_schema(schema)).parquet(self._at(f"manifest-{batch_id - 1}")).collect()
        except AnalysisException as missing:
            if "PATH_NOT_FOUND" not in str(missing):
                raise
            return self._rebuilt(spark, schema, batch_id)
        for run in {r["run"] for r in rows if not r["live"]}:
            remove(spark, self._at(run))
        remove(spark, self._at(f"manifest-{batch_id - 2}"))
        return [r.asDict() for r in rows if r["live"]]

    def _rebuilt(self, spark: SparkSession, schema: T.StructType, batch_id: int) -> list[dict]:
        """One run of all keys of a table whose index is not there."""
        held = read_sink(spark, self.path, schema)
        if "batch" not in held.columns:
            return []
        keys = held.where(F.col("batch") < batch_id).select(self.key)
        return self._run(spark, schema, keys, f"run-rebuilt-{batch_id}", 1)

    def _run(self, spark: SparkSession, schema: T.StructType, keys: DataFrame, name: str, level: int, rows: int | None = None) -> list[dict]:
        """Write sorted keys and list their files."""
        keys = keys.where(F.col(self.key).isNotNull())
        rows = keys.count() if rows is None else rows
        if not rows:
            return []
        parts = math.ceil(rows / self.file_rows)
        dealt = keys.repartitionByRange(parts, self.key) if parts > 1 else keys.coalesce(1)
        writer = dealt.sortWithinPartitions(self.key).write.mode("overwrite")
        writer.option(f"parquet.bloom.filter.enabled#{self.key}", "true").option(
            f"parquet.bloom.filter.expected.ndv#{self.key}", str(min(rows, self.file_rows))
        ).parquet(self._at(name))
        stored = spark.read.schema(keys.schema).parquet(self._at(name)).select(self.key, F.col("_metadata.file_path").alias("file"))
        files = stored.groupBy("file").agg(F.min(self.key).alias("low"), F.max(self.key).alias("high"), F.count("*").alias("rows"))
        return [r.asDict() | {"run": name, "level": level, "live": True} for r in files.collect()]

    def _index(self, spark: SparkSession, schema: T.StructType, index: list[dict], stored: DataFrame, batch_id: int) -> None:
        live = index + self._run(spark, schema, stored.select(self.key), f"run-0-{batch_id}", 0)
        gone: list[dict] = []
        level = 0
        while level <= max((r["level"] for r in live), default=-1):
            own = [r for r in live if r["level"] == level]
            if len({r["run"] for r in own}) >= self.fan_out:
                keys = spark.read.schema(T.StructType([schema[self.key]])).parquet(*[r["file"] for r in own])
                name = f"run-{level + 1}-{batch_id}"
                live = [r for r in live if r["level"] != level]
                live += self._run(spark, schema, keys, name, level + 1, sum(r["rows"] for r in own))
                gone += [r | {"live": False} for r in own]
            level += 1
        listed = [tuple(r[c] for c in ("run", "level", "live", "file", "low", "high", "rows")) for r in live + gone]
        manifest = spark.createDataFrame(listed, self._manifest_schema(schema)).coalesce(1)
        manifest.write.mode("overwrite").parquet(self._at(f"manifest-{batch_id}"))

    # --- looking up --------------------------------------------------------------

    def _known(self, batch: DataFrame, index: list[dict], batch_id: int) -> DataFrame | None:
        """Stored keys that may be in the batch, of the files that may hold any."""
        spark, key = batch.sparkSession, self.key
        files: list[dict] = []
        wanted: Column | None = None
        if index:
            rows = batch.select(key).where(F.col(key).isNotNull()).limit(self.few + 1).collect()
            if len(rows) <= self.few:
                keys = sorted(r[0] for r in rows)
                files = [r for r in index if _any_between(keys, r["low"], r["high"])]
                wanted = F.col(key).isin(keys)
                # This session is the batch's own: single values reach the Bloom filters.
                spark.conf.set("spark.sql.parquet.pushdown.inFilterThreshold", str(self.few))
            else:
                spans = self._spans(batch)
                files = [r for r in index if any(a <= r["high"] and r["low"] <= b for a, b in spans)]
                wanted = F.lit(False)
                for a, b in spans:
                    wanted |= F.col(key).between(F.lit(a), F.lit(b))
        runs = lambda rows: len({r["run"] for r in rows})
        self.lookups.append(Lookup(batch_id, runs(files), len(files), runs(index), len(index)))
        if not files:
            return None
        return spark.read.schema(T.StructType([batch.schema[key]])).parquet(*[r["file"] for r in files]).where(wanted)

    def _spans(self, batch: DataFrame, most: int = 64) -> list[tuple]:
        """Ranges that cover the batch's keys and leave wide gaps out, at most `most`."""
        key = F.col(self.key)
        low, high = batch.agg(F.min(key), F.max(key)).first()
        if not isinstance(low, int) or low == high:
            return [(low, high)]
        # In doubles, as the range of two longs may not fit a long.
        place = F.floor((key.cast("double") - float(low)) / (float(high) - float(low)) * most)
        return [tuple(r)[1:] for r in batch.where(key.isNotNull()).groupBy(place).agg(F.min(key), F.max(key)).collect()]


def _any_between(keys: list, low, high) -> bool:
    at = bisect_left(keys, low)
    return at < len(keys) and keys[at] <= high
