"""The event stream: sources, deduplication, sinks and run modes."""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from touchline import config
from touchline.functions.casting import nan_to_null
from touchline.operators.events import is_live
from touchline.streaming.counters import totals
from touchline.streaming.keyed import KeyedSink, read_sink


def event_source(
    spark: SparkSession,
    fmt: str,
    options: Mapping[str, str] | None = None,
    schema: str | None = None,
    path: str | None = None,
) -> DataFrame:
    """A streaming frame from files, or from a broker where its connector is there.

    Size micro-batches with `maxFilesPerTrigger` or `maxOffsetsPerTrigger`.
    """
    reader = spark.readStream.format(fmt).options(**dict(options or {}))
    if schema:
        reader = reader.schema(schema)
    return reader.load(path) if path else reader.load()


def encode_events(df: DataFrame, key: str = "id", topic: str = "topic") -> DataFrame:
    """Key and JSON value per event, with NaN as null and nulls written out. A column
    named `topic` is not packed but kept beside them, as a broker sink routes by it."""
    doubles = {c: nan_to_null(F.col(c)) for c, t in df.dtypes if t in ("double", "float")}
    clean = df.withColumns(doubles) if doubles else df
    packed = F.struct(*[c for c in clean.columns if c != topic])
    value = F.to_json(packed, {"ignoreNullFields": "false"}).alias("value")
    routed = [F.col(topic)] if topic in clean.columns else []
    return clean.select(*routed, F.col(key).cast("string").alias("key"), value)


def decode_events(df: DataFrame, schema: str = config.LIVE_EVENT_DDL, value: str = "value") -> DataFrame:
    """The event table's columns out of JSON values; rows without an id cannot be
    stored and are left out."""
    # As rows of a generator: a filter on a struct's field would be moved below it, and every
    # message be packed and parsed a second time there.
    parsed = F.from_json(F.col(value).cast("string"), schema)
    return df.select(F.inline(F.array(parsed))).where(F.col("id").isNotNull())


def insert_ignore(
    path: str,
    key: str = "id",
    layout: tuple[str, ...] = (),
    by: tuple[str, ...] = (),
    then: Callable[[DataFrame, int], None] | None = None,
) -> KeyedSink:
    """A `foreachBatch` writer that skips keys its table already holds (see keyed)."""
    return KeyedSink(path, key, layout, by, then)


def write_routes(root: str) -> Callable[[DataFrame, int], None]:
    """A batch writer with one folder per topic and batch.

    A batch that is run again replaces its own folders, so counts stay right.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").partitionBy("topic").parquet(f"{root}/batch={batch_id}")

    return write


def run_mode(live: bool, seconds: int = config.POLL_SECONDS) -> dict:
    """Trigger of a running match, polled, or of a finished one, read to its end."""
    return {"processingTime": f"{seconds} seconds"} if live else {"availableNow": True}


def mode_for(events: DataFrame, status: Column, seconds: int = config.POLL_SECONDS) -> dict:
    """The trigger that the present status of a match asks for."""
    live = events.agg(F.max(is_live(status)).alias("live")).first()["live"]
    return run_mode(bool(live), seconds)


def event_sink(
    df: DataFrame,
    checkpoint: str,
    trigger: Mapping,
    batch_writer: Callable[[DataFrame, int], None] | None = None,
    fmt: str = "parquet",
    options: Mapping[str, str] | None = None,
    name: str | None = None,
) -> StreamingQuery:
    """Start a query into a batch writer, or into `fmt` with its options.

    For a broker pass fmt="kafka" and options such as kafka.bootstrap.servers,
    kafka.acks=all and topic; `df` then comes from `encode_events`.
    """
    totals(df.sparkSession)  # listens from the first batch on
    writer = df.writeStream.option("checkpointLocation", checkpoint).trigger(**trigger)
    if name:
        writer = writer.queryName(name)
    if batch_writer:
        return writer.foreachBatch(batch_writer).start()
    return writer.format(fmt).options(**dict(options or {})).start()


def progress(query: StreamingQuery) -> dict:
    """Batches run and rows read by a query in this application (see counters.Totals)."""
    own = totals(SparkSession.active()).of(query)
    return {"batches": own["batches"], "rows": own["rows"]}
