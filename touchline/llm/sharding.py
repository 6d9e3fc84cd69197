"""Histogram sort: exact byte counts below candidate boundaries, then one exchange.

The sort key is a hash of the text and then one of the document, so equal texts lie
together and a group of copies of any size can still be cut. Splitters are found by
counting bytes in 4096 bins, and again in 4096 bins of each bin that holds a splitter,
until each is within the tolerance. Rows move once, to the shard their key falls in.
Columns and SQL functions only.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window, functions as F

from touchline.llm.common import materialise

BITS = 12
#: Distance of a splitter from its target, as a share of a shard.
TOLERANCE = 0.0005
#: Bytes of one exchanged partition.
PARTITION_BYTES = 128 << 20
LEAST = -(1 << 63)


@dataclass(frozen=True)
class Bin:
    """Keys whose leading bits are `prefix`; past 64 bits, `first` is the whole first half."""

    bits: int
    prefix: int
    first: int | None
    below: int  # bytes of all keys before this bin


def _leading(column: str, bits: int) -> Column:
    return F.shiftright(F.col(column), 64 - bits) if bits < 64 else F.col(column)


def _edge(node: Bin) -> tuple[int, int] | None:
    """Smallest key of the bin; None: past all keys."""
    bits = node.bits if node.first is None else node.bits - 64
    low = node.prefix << (64 - bits)
    if low >= 1 << 63:
        if node.first is None or node.first == (1 << 63) - 1:
            return None
        return node.first + 1, LEAST
    return (low, LEAST) if node.first is None else (node.first, low)


def find_splitters(keys: DataFrame, shards: int, tolerance: float = TOLERANCE) -> list[tuple[int, int]]:
    """Splitters of (key1, key2, size) for `shards` ranges of near equal size.

    Each round brings at most `shards` x 4096 counts to the driver, whatever the input.
    A bin of a single row is not refined: no boundary can be nearer its target.
    """
    total = keys.agg(F.sum("size")).first()[0] or 0
    targets = {j: total * j / shards for j in range(1, shards)} if total else {}
    found: dict[int, tuple[int, int] | None] = {}
    open_bins = dict.fromkeys(targets, Bin(0, 0, None, 0))
    while open_bins:
        counts = _counts(keys, set(open_bins.values()))
        narrowed: dict[int, Bin] = {}
        for j, node in open_bins.items():
            below = node.below
            for child, size, rows in counts[node]:
                if below + size >= targets[j]:
                    break
                below += size
            at = Bin(child.bits, child.prefix, child.first, below)
            after = Bin(child.bits, child.prefix + 1, child.first, below + size)
            near = min(at, after, key=lambda b: abs(b.below - targets[j]))
            if abs(near.below - targets[j]) <= tolerance * total / shards or rows == 1 or at.bits == 128:
                found[j] = _edge(near)
            else:
                narrowed[j] = at
        open_bins = narrowed
    return [edge for _, edge in sorted(found.items()) if edge is not None]


def _counts(keys: DataFrame, nodes: set[Bin]) -> dict[Bin, list[tuple[Bin, int, int]]]:
    """Exact bytes and rows of the bins that each node falls into, in key order."""
    by_depth: dict[tuple[int, bool], list[Bin]] = {}
    for node in nodes:
        by_depth.setdefault((node.bits, node.bits >= 64), []).append(node)
    out: dict[Bin, list[tuple[Bin, int, int]]] = {}
    for (bits, second), group in by_depth.items():
        if not second:
            deeper = min(bits + BITS, 64)
            rows = keys.where(_leading("key1", bits).isin([n.prefix for n in group])) if bits else keys
            at = [F.lit(None).cast("long"), _leading("key1", deeper)]
            owner = {n.prefix: n for n in group}
        else:
            deeper = min(bits + BITS, 128)
            inside = F.lit(False)
            for n in group:
                first, prefix = (n.prefix, None) if n.first is None else (n.first, n.prefix)
                one = F.col("key1") == first
                inside |= one if prefix is None else one & (_leading("key2", bits - 64) == prefix)
            rows = keys.where(inside)
            at = [F.col("key1"), _leading("key2", deeper - 64)]
            owner = {(n.prefix, 0) if n.first is None else (n.first, n.prefix): n for n in group}
        counted = rows.groupBy(at[0].alias("first"), at[1].alias("prefix")).agg(
            F.sum("size").alias("size"), F.count("*").alias("rows")
        )
        for r in sorted(counted.collect(), key=lambda r: (r["first"] or 0, r["prefix"])):
            up = deeper - bits
            if second:
                key = (r["first"], 0 if bits == 64 else r["prefix"] >> up)
            else:
                key = r["prefix"] >> up if bits else 0
            out.setdefault(owner[key], []).append((Bin(deeper, r["prefix"], r["first"], 0), r["size"], r["rows"]))
    return out


def shard(
    docs: DataFrame, shards: int = 16, tolerance: float = TOLERANCE, partition_bytes: int = PARTITION_BYTES
) -> DataFrame:
    """Every row of `docs` (doc_id, text, ...) with its size, shard and slot.

    `size` is the text's UTF-8 bytes plus 1, a null text's 1. Shards are ranges of the
    key with near equal sums of `size`; slots run from 0 without gaps in each. Rows
    alike in all columns are told apart by their place in the input, so even these can
    be cut. Columns of `docs` named size, shard or slot give way; all others stay.
    An empty table gives no rows.
    """
    taken = ("size", "shard", "slot", "key1", "key2")
    rows = docs.select(*[f"`{c}`" for c in docs.columns if c.lower() not in taken])
    keyed = rows.select(
        "*",
        (F.coalesce(F.octet_length(F.col("text")), F.lit(0)).cast("long") + 1).alias("size"),
        F.xxhash64(F.coalesce(F.col("text"), F.lit(""))).alias("key1"),
        F.xxhash64("doc_id", F.monotonically_increasing_id()).alias("key2"),
    )
    keys = materialise(keyed.select("key1", "key2", "size"), "keys")
    splitters = find_splitters(keys, shards, tolerance)
    total = keys.agg(F.sum("size")).first()[0] or 0
    parts = max(1, -(-total // (shards * partition_bytes)))
    number = F.lit(0)
    for first, second in splitters:
        past = (F.col("key1") > first) | ((F.col("key1") == first) & (F.col("key2") >= second))
        number += past.cast("int")
    moved = (
        keyed.withColumn("shard", number)
        .withColumn("_part", F.pmod(F.xxhash64("key2"), F.lit(parts)).cast("int"))
        .repartitionById(shards * parts, (F.col("shard") * parts + F.col("_part")).cast("int"))
        .sortWithinPartitions("shard", "_part", "key1", "key2")
        .withColumn("_at", F.monotonically_increasing_id())
    )
    moved = materialise(moved, "shards")
    ranges = moved.groupBy("shard", "_part").agg(F.min("_at").alias("_first"), F.count("*").alias("_rows"))
    before = Window.partitionBy("shard").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    ranges = ranges.withColumn("_before", F.coalesce(F.sum("_rows").over(before), F.lit(0)))
    slot = F.col("_at") - F.col("_first") + F.col("_before")
    placed = moved.join(ranges, ["shard", "_part"])
    return placed.select(*[f"`{c}`" for c in rows.columns], "size", "shard", slot.alias("slot"))
