"""Removal of repeated passages by induced suffix sorting of shards.

Every string of `length` bytes holds one anchor: its first run of `ANCHOR` bytes of
least hash. Equal strings have equal anchors at equal places, so strings are sharded by
their anchor's bytes; a piece of text that holds all strings of one anchor is short.
Anchors seen once have no repeated string. Where all pieces of an anchor are alike,
all their strings are repeated. The pieces that are left, one of each kind, are sorted
in shards by induced sorting with common-prefix values (see induced.py).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame, functions as F

from touchline.llm.common import each_batch, materialise, row_key
from touchline.llm.induced import repeated_starts

ANCHOR = 64
#: Bytes of pieces in one shard, about (sorting takes some 120 bytes for each); and kinds of pieces of one anchor beyond which
#: its strings are counted one by one instead, over all tasks.
SHARD_BYTES = 1_000_000
KINDS = 2000
#: Bytes of text hashed at once.
BLOCK = 1 << 20
MIX = (np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F))
PLACE = np.uint64(0xFFFFFF)


def _run_hashes(data: np.ndarray, width: int) -> np.ndarray:
    """A hash of `width` bytes from each position, put together from powers of two."""
    power, span = data.astype(np.uint64) * MIX[0], 1
    out, done = None, 0
    while True:
        if width & span:
            if out is None:
                out = power
            else:
                out = out[: len(out) - span] * MIX[0] ^ power[done:][: len(out) - span]
                out *= MIX[1]
            done += span
        span *= 2
        if span > width:
            break
        half = span // 2
        power = power[:-half] * MIX[1] + power[half:]
        power ^= power >> np.uint64(31)
    out ^= out >> np.uint64(29)
    out *= MIX[0]
    return out


def _least(value: np.ndarray, width: int) -> np.ndarray:
    step = 1
    while step * 2 <= width:
        value = np.minimum(value[:-step], value[step:])
        step *= 2
    rest = width - step
    return np.minimum(value[:-rest], value[rest:]) if rest else value


def pieces(texts: list[bytes], length: int) -> Iterator[tuple[int, int, int, int]]:
    """(text, start, strings, anchor): runs of strings with one anchor, as many starts
    as `strings`; the anchor's place is counted from the run's start."""
    blocks, size = [[]], 0
    for k, text in enumerate(texts):
        for at in range(0, max(1, len(text) - length + 1), BLOCK):
            part = text[at : at + BLOCK + length - 1]
            if size + len(part) > 2 * BLOCK:
                blocks.append([])
                size = 0
            blocks[-1].append((k, at, part))
            size += len(part)
    width = length - ANCHOR + 1
    for block in blocks:
        data = np.frombuffer(b"".join(p for _, _, p in block), np.uint8)
        n = len(data) - length + 1
        if n <= 0:
            continue
        lengths = np.array([len(p) for _, _, p in block])
        ends = np.cumsum(lengths)
        hashes = _run_hashes(data, ANCHOR)
        placed = hashes & ~PLACE | np.arange(len(hashes), dtype=np.uint64)
        anchor = (_least(placed, width)[:n] & PLACE).astype(np.int64)
        owner = np.repeat(np.arange(len(block)), lengths)[:n]
        inside = np.arange(n) + length <= ends[owner]
        first = inside & np.r_[True, (anchor[1:] != anchor[:-1]) | (owner[1:] != owner[:-1])]
        starts = np.flatnonzero(first)
        # A run ends where the next begins, or where its text has no further string.
        stop = np.minimum(np.r_[starts[1:], n], np.maximum(ends[owner[starts]] - length + 1, 0))
        base = (ends - lengths)[owner[starts]]
        for o, s, count, a in zip(owner[starts].tolist(), (starts - base).tolist(), (stop - starts).tolist(), (anchor[starts] - starts).tolist()):
            yield block[o][0], block[o][1] + s, count, a


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def _anchors(length: int, placed: bool):
    digest = xxhash.xxh3_64_intdigest

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        texts = [t or b"" for t in batch.column("text").cast(pa.binary()).to_pylist()]
        rows, keys, kinds, starts, counts = [], [], [], [], []
        for k, start, count, anchor in pieces(texts, length):
            text = texts[k]
            at = start + anchor
            rows.append(k)
            keys.append(digest(text[at : at + ANCHOR]))
            kinds.append(digest(text[start : start + count + length - 1], 1))
            starts.append(start)
            counts.append(count)
        arrays = [pa.array(np.array(x, np.uint64).view(np.int64)) for x in (keys, kinds)]
        names = ["anchor", "kind"]
        if placed:
            at = pa.array(rows, pa.int64())
            arrays += [batch.column("doc_id").take(at), batch.column("row").take(at)]
            arrays += [pa.array(starts, pa.int64()), pa.array(counts, pa.int32())]
            names += ["doc_id", "row", "start", "strings"]
        return pa.RecordBatch.from_arrays(arrays, names)

    return each_batch(run)


def _packed(batch: pa.RecordBatch) -> pa.RecordBatch:
    """Texts compressed before they move."""
    press = zstandard.ZstdCompressor(level=3)
    found = pa.array([press.compress(t or b"") for t in batch.column("text").cast(pa.binary()).to_pylist()], pa.binary())
    return pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("row"), found], ["doc_id", "row", "packed"])


def _cut(length: int):
    """The wanted pieces of each text; of an anchor of many kinds, hashes of all strings."""
    digest = xxhash.xxh3_64_intdigest

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        open_ = zstandard.ZstdDecompressor()
        out: list[list] = [[] for _ in range(6)]
        for packed, wanted in zip(batch.column("packed").to_pylist(), batch.column("wanted").to_pylist()):
            text = open_.decompress(packed)
            for w in wanted:
                piece = text[w["start"] : w["start"] + w["strings"] + length - 1]
                strings = [_signed(digest(piece[i : i + length])) for i in range(w["strings"])] if w["many"] else None
                for column, value in zip(out, (w["anchor"], w["kind"], w["copies"], w["many"], None if w["many"] else piece, strings)):
                    column.append(value)
        types = (pa.int64(), pa.int64(), pa.int64(), pa.bool_(), pa.binary(), pa.list_(pa.int64()))
        names = ["anchor", "kind", "copies", "many", "piece", "strings"]
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(out, types)], names)

    return each_batch(run)


def _runs(flags: np.ndarray) -> list[dict[str, int]]:
    edge = np.diff(np.r_[0, flags.astype(np.int8), 0])
    return [{"a": int(a), "b": int(b)} for a, b in zip(np.flatnonzero(edge == 1), np.flatnonzero(edge == -1))]


RUNS = "array<struct<a:int,b:int>>"


def _sorted_shards(length: int):
    """Runs of repeated strings of each piece; rows come sorted by shard and anchor."""

    def solve(rows: list[dict]) -> pa.RecordBatch:
        found = repeated_starts([r["piece"] for r in rows], length)
        runs = [_runs(np.ones_like(f) if r["copies"] > 1 else f) for f, r in zip(found, rows)]
        kept = [k for k, r in enumerate(runs) if r]
        return pa.RecordBatch.from_arrays(
            [
                pa.array([rows[k]["anchor"] for k in kept], pa.int64()),
                pa.array([rows[k]["kind"] for k in kept], pa.int64()),
                pa.array([runs[k] for k in kept], pa.list_(pa.struct([("a", pa.int32()), ("b", pa.int32())]))),
            ],
            ["anchor", "kind", "runs"],
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[dict] = []
        size = 0
        for batch in batches:
            for row in batch.to_pylist():
                # A shard may end wherever the anchor changes.
                if size >= SHARD_BYTES and row["anchor"] != held[-1]["anchor"]:
                    yield solve(held)
                    held, size = [], 0
                held.append(row)
                size += len(row["piece"])
        if held:
            yield solve(held)

    return run


def _kept(length: int):
    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        open_ = zstandard.ZstdDecompressor()
        sizes, spans, kept = [], [], []
        for packed, found in zip(batch.column("packed").to_pylist(), batch.column("found").to_pylist()):
            text = open_.decompress(packed)
            merged: list[list[int]] = []
            for s in sorted((s["a"], s["b"]) for s in found or []):
                if merged and s[0] <= merged[-1][1]:
                    merged[-1][1] = max(merged[-1][1], s[1])
                else:
                    merged.append([s[0], s[1]])
            edges = [0, *[x for m in merged for x in m], len(text)]
            sizes.append(len(text))
            spans.append([{"start": a, "end": b} for a, b in merged])
            kept.append(b"".join(text[a:b] for a, b in zip(edges[::2], edges[1::2])))
        kind = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
        return pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), pa.array(sizes, pa.int64()), pa.array(spans, kind), pa.array(kept, pa.binary())],
            ["doc_id", "n_bytes", "spans", "kept"],
        )

    return each_batch(run)


def remove_repeats(docs: DataFrame, length: int = 200) -> DataFrame:
    """Every row's text without the bytes of any `length`-byte string that also starts
    anywhere else in the table, the row itself included.

    Columns: doc_id, n_bytes, spans (maximal removed runs, byte offsets, end exclusive)
    and kept (bytes). Texts are UTF-8 bytes, a null one is empty; a text shorter than
    `length` loses nothing. Rows alike are copies of each other. Null ids stay null;
    other columns are not read; an empty table gives no rows.
    """
    if length <= ANCHOR:
        raise ValueError(f"length must be over {ANCHOR}")
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"), row_key().alias("row")
    )
    packed = rows.mapInArrow(each_batch(_packed), "doc_id long, row long, packed binary")
    same_row = lambda a, b: a["doc_id"].eqNullSafe(b["doc_id"]) & (a["row"] == b["row"])

    # Anchors that are seen again, and whether all their pieces are alike.
    seen = rows.select("text").mapInArrow(_anchors(length, placed=False), "anchor long, kind long")
    again = (
        seen.groupBy("anchor")
        .agg(F.count("*").alias("n"), F.min("kind").alias("least"), F.max("kind").alias("most"))
        .where("n > 1").select("anchor", (F.col("least") == F.col("most")).alias("alike"))
    )
    again = materialise(again, "anchors")
    schema = "anchor long, kind long, doc_id long, row long, start long, strings int"
    places = rows.mapInArrow(_anchors(length, placed=True), schema).join(again, "anchor")
    places = materialise(
        places.select("doc_id", "row", "start", "strings", "alike", *[F.when(~F.col("alike"), F.col(c)).alias(c) for c in ("anchor", "kind")]),
        "places",
    )

    # One piece of each kind of the anchors whose pieces differ.
    place = F.struct("doc_id", "row", "start", "strings")
    kinds = (
        places.where("not alike").groupBy("anchor", "kind").agg(F.count("*").alias("copies"), F.min(place).alias("at"))
    )
    kinds = materialise(kinds, "kinds")
    many = kinds.groupBy("anchor").count().where(F.col("count") > KINDS).select("anchor", F.lit(True).alias("many"))
    one = F.struct("at.start", "at.strings", "anchor", "kind", "copies", F.coalesce("many", F.lit(False)).alias("many"))
    wanted = (
        kinds.join(many, "anchor", "left")
        .groupBy(F.col("at.doc_id").alias("doc_id"), F.col("at.row").alias("row")).agg(F.collect_list(one).alias("wanted"))
    )
    cut = packed.join(wanted, same_row(packed, wanted)).select("packed", "wanted")
    cut = cut.mapInArrow(_cut(length), "anchor long, kind long, copies long, many boolean, piece binary, strings array<long>")
    cut = materialise(cut, "pieces")

    sorted_ = (
        cut.where("not many").select("anchor", "kind", "copies", "piece").repartition("anchor")
        .sortWithinPartitions("anchor", "kind").mapInArrow(_sorted_shards(length), f"anchor long, kind long, runs {RUNS}")
    )
    each = cut.where("many").dropDuplicates(["anchor", "kind"]).select("anchor", "kind", "copies", F.posexplode("strings").alias("p", "string"))
    twice = each.groupBy("anchor", "string").agg(F.count("*").alias("n"), F.max("copies").alias("c")).where("n > 1 or c > 1")
    counted = each.join(twice, ["anchor", "string"]).where("n > 1 or copies > 1").groupBy("anchor", "kind").agg(
        F.collect_list(F.struct(F.col("p").alias("a"), (F.col("p") + 1).alias("b"))).cast(RUNS).alias("runs")
    )
    runs = materialise(sorted_.unionByName(counted), "runs")

    # Strings back to bytes of each row: a run of starts covers length - 1 bytes more.
    whole = places.where("alike").select("doc_id", "row", F.col("start").alias("a"), (F.col("start") + F.col("strings") + length - 1).alias("b"))
    parts = places.where("not alike").join(runs, ["anchor", "kind"]).select("doc_id", "row", "start", F.explode("runs").alias("r"))
    parts = parts.select("doc_id", "row", (F.col("start") + F.col("r.a")).alias("a"), (F.col("start") + F.col("r.b") + length - 1).alias("b"))
    found = whole.unionByName(parts).groupBy("doc_id", "row").agg(F.collect_set(F.struct("a", "b")).alias("found"))
    joined = packed.join(found, same_row(packed, found), "left").select(packed["doc_id"], "packed", "found")
    return joined.mapInArrow(_kept(length), "doc_id long, n_bytes long, spans array<struct<start:long,end:long>>, kept binary")
