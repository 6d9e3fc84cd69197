"""Records of CSV files that several tasks read, whatever line breaks their cells hold.

Spark splits a file at lines, and a line may lie inside a quoted cell. Whether it does
depends on all lines before it, but only by one bit: so each block of a file is first
summed up as the bit it ends with after either bit that it may begin with. Put together
in order, these say how every block begins, and a second pass cuts every block into
records on its own. Records that reach from one block into the next, one per block at
most, are put together at last.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from touchline.session import materialise

SCAN = {"recursiveFileLookup": "true", "pathGlobFilter": "*.csv"}
#: Blocks that begin inside a cell and are broadcast, at most; beyond, lines are joined
#: with them and put in order again.
BROADCAST_BLOCKS = 500_000
WHOLE, HEAD, TAIL = 0, 1, 2


def decoded(name: str, encoded: bool = True) -> Column:
    # Listing and scan spell a path differently: scheme slashes and URL escapes.
    path = F.col(name)
    if encoded:
        path = F.url_decode(F.replace(path, F.lit("+"), F.lit("%2B")))
    return F.regexp_replace(path, "^file:/+", "file:/")


def file_id(path: Column) -> Column:
    return F.xxhash64(path)


def ends_open(line: bytes, inside: bool) -> bool:
    """Whether a quoted cell is open after the line. A quote opens a cell only at its
    start; within it, doubled quotes are one, and what follows its end up to the next
    comma belongs to it as it is."""
    at = 0
    while True:
        if inside or line[at : at + 1] == b'"':
            at += not inside
            while True:
                at = line.find(b'"', at)
                if at < 0:
                    return True
                if line[at + 1 : at + 2] != b'"':
                    break
                at += 2
            inside, at = False, at + 1
        at = line.find(b",", at) + 1
        if not at:
            return False


def cells(record: str) -> list[str | None]:
    """The cells of a record as Spark's reader has them: empty ones are null, with or
    without quotes, and a cell that goes on after its closing quote is taken as written."""
    if '"' not in record:
        return [c or None for c in record.split(",")]
    out: list[str | None] = []
    at = 0
    while True:
        if record[at : at + 1] == '"':
            end = at + 1
            while True:
                end = record.find('"', end)
                if end < 0:
                    return [*out, record[at + 1 :].replace('""', '"')]
                if record[end + 1 : end + 2] != '"':
                    break
                end += 2
            comma = record.find(",", end)
            stop = len(record) if comma < 0 else comma
            own = record[at + 1 : end].replace('""', '"')
            out.append((own or None) if stop == end + 1 else record[at:stop])
        else:
            comma = record.find(",", at)
            out.append(record[at : len(record) if comma < 0 else comma] or None)
        if comma < 0:
            return out
        at = comma + 1


def _parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = (r.decode("utf-8", "replace") for r in batch.column("record").to_pylist())
        found = pa.array([cells(t) for t in texts], pa.list_(pa.string()))
        yield pa.RecordBatch.from_arrays([batch.column("file"), found], ["file", "cells"])


def parsed(records: DataFrame) -> DataFrame:
    """(file, cells) for every record but headers."""
    rows = records.where("not first").select("file", F.col("record").cast("binary").alias("record"))
    return rows.mapInArrow(_parse, "file long, cells array<string>")


def _blocks(batch: pa.RecordBatch) -> Iterator[tuple[int, int, int, int]]:
    """(file, block, first, end) for the rows of each block of the batch."""
    file, block = batch.column("file").to_numpy(), batch.column("block").to_numpy()
    cuts = np.flatnonzero((file[1:] != file[:-1]) | (block[1:] != block[:-1])) + 1
    for a, b in zip([0, *cuts.tolist()], [*cuts.tolist(), batch.num_rows]):
        yield int(file[a]), int(block[a]), a, b


def _sum_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """For each block, whether a cell is open at its end: if it began outside one, and if
    it began inside one."""
    done: dict[tuple[int, int], list[bool]] = {}
    for batch in batches:
        lines = batch.column("line")
        for file, block, a, b in _blocks(batch):
            state = done.setdefault((file, block), [False, True])
            for line in lines.slice(a, b - a).drop_null().to_pylist():
                state[:] = [ends_open(line, s) for s in state]
    keys = list(done)
    columns = [pa.array([k[0] for k in keys], pa.int64()), pa.array([k[1] for k in keys], pa.int64())]
    columns += [pa.array([done[k][s] for k in keys], pa.bool_()) for s in (0, 1)]
    yield pa.RecordBatch.from_arrays(columns, ["file", "block", "outside", "inside"])


def _begin(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The blocks that begin inside a cell; rows come in order of file and block."""
    now, open_ = None, False
    for batch in batches:
        found = []
        for row in batch.to_pylist():
            if row["file"] != now:
                now, open_ = row["file"], False
            if open_:
                found.append(row)
            open_ = row["inside"] if open_ else row["outside"]
        yield pa.RecordBatch.from_arrays([pa.array([r[c] for r in found], pa.int64()) for c in ("file", "block")], ["file", "block"])


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Records of each block, its beginnings and ends of records that lie across blocks."""
    now, held, kind, seq = None, None, WHOLE, 0
    out: list[tuple[int, int, int, int, bytes]] = []

    def put(as_kind: int) -> None:
        nonlocal held, seq
        out.append((*now, seq, as_kind, b"\n".join(held)))
        held, seq = None, seq + 1

    def written() -> pa.RecordBatch:
        columns = [pa.array([r[k] for r in out], pa.int64()) for k in range(4)] + [pa.array([r[4] for r in out], pa.binary())]
        out.clear()
        return pa.RecordBatch.from_arrays(columns, ["file", "block", "seq", "kind", "record"])

    for batch in batches:
        opens = batch.column("open").to_pylist()
        lines = batch.column("line").to_pylist()
        for file, block, a, b in _blocks(batch):
            if (file, block) != now:
                if held is not None:
                    put(kind)
                now, seq, held = (file, block), 0, None
                if opens[a]:
                    held, kind = [], HEAD
                elif block == 0:
                    lines[a] = lines[a].removeprefix(b"\xef\xbb\xbf")
            for line in lines[a:b]:
                if held is not None:
                    held.append(line)
                    if b'"' in line and not ends_open(line, True):
                        put(HEAD if kind == HEAD else WHOLE)
                elif b'"' in line and ends_open(line, False):
                    held, kind = [line], TAIL
                elif line and line != b"\r":
                    out.append((file, block, seq, WHOLE, line))
                    seq += 1
        if out:
            yield written()
    if held is not None:
        put(kind)
    if out:
        yield written()


def csv_records(spark: SparkSession, root: str) -> DataFrame:
    """(file, record, first) for every record of every CSV file below `root`: the key of
    its path (`file_id`), its text, and whether it is the first one, the header.

    Lines end with a line feed, alone or after a carriage return; cells are set off by
    commas and quotes. Empty lines are no records. Any file of several blocks is read by
    several tasks, in two passes; no task holds more than one record and one batch of
    lines. A quote that is never closed makes one record of what follows it, as it does in
    a read by one task.
    """
    lines = (
        spark.read.options(**SCAN, lineSep="\n").text(root)
        .select(
            file_id(decoded("_metadata.file_path")).alias("file"), F.col("_metadata.file_block_start").alias("block"),
            F.monotonically_increasing_id().alias("at"), F.col("value").cast("binary").alias("line"),
        )
    )
    quoted = F.when(F.contains("line", F.lit(b'"')), F.col("line")).alias("line")
    sums = lines.select("file", "block", quoted).mapInArrow(_sum_up, "file long, block long, outside boolean, inside boolean")
    inside = materialise(
        sums.repartition("file").sortWithinPartitions("file", "block").mapInArrow(_begin, "file long, block long"), "inside"
    )
    few = inside.count() <= BROADCAST_BLOCKS
    known = inside.withColumn("open", F.lit(True))
    marked = lines.join(F.broadcast(known) if few else known, ["file", "block"], "left")
    if not few:
        marked = marked.repartition("file", "block").sortWithinPartitions("file", "block", "at")
    marked = marked.select("file", "block", F.coalesce("open", F.lit(False)).alias("open"), "line")
    cut = marked.mapInArrow(_cut, "file long, block long, seq long, kind long, record binary")
    cut = materialise(cut.withColumn("record", F.col("record").cast("string")), "records")
    first = (F.col("block") == 0) & (F.col("seq") == 0)
    whole = cut.where(F.col("kind") == WHOLE).select("file", "record", first.alias("first"))
    # At most two of these for each block; a record begins with each tail.
    begun = F.sum((F.col("kind") == TAIL).cast("int")).over(Window.partitionBy("file").orderBy("block", "kind"))
    across = cut.where(F.col("kind") != WHOLE).withColumn("begun", begun)
    parts = F.array_sort(F.collect_list(F.struct("block", "kind", "record")))
    joined = across.groupBy("file", "begun").agg(
        F.array_join(F.transform(parts, lambda p: p["record"]), "\n").alias("record"), F.max(first & (F.col("kind") == TAIL)).alias("first")
    )
    return whole.unionByName(joined.select("file", "record", "first")).withColumn("record", F.regexp_replace("record", "\r$", ""))
