"""Best-fit packing with lower bounds from dual-feasible functions.

Each partition cuts its documents into pieces and packs them by best-fit decreasing.
A lower bound on its number of bins tells whether that packing can be bettered.
Where a gap is left, and from the emptiest bins at the end of every partition whose
bound is its total alone, pieces are exchanged: sixteen partitions pool such bins and
pack them anew, level by level, until one pool is left. What a partition passes on is
a few bins, so no pool grows with the input.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import Broadcast, TaskContext
from pyspark.sql import DataFrame, functions as F

from touchline.llm.common import materialise
from touchline.llm.tokens import encoder, share_tokenizer

POOL = 16
#: Emptiest bins that are repacked, for each bin of gap and one more.
BINS_PER_GAP = 4


def best_fit(lengths: np.ndarray, capacity: int) -> np.ndarray:
    """Bin of each piece, longest first, each into the fullest bin that holds it."""
    bins = np.zeros(len(lengths), np.int64)
    with_room: list[list[int]] = [[] for _ in range(capacity + 1)]
    rooms = 0  # bit r: some open bin has room r
    count = 0
    for i in np.argsort(-lengths, kind="stable").tolist():
        need = int(lengths[i])
        fit = rooms >> need
        if fit:
            room = need + (fit & -fit).bit_length() - 1
            chosen = with_room[room].pop()
            if not with_room[room]:
                rooms &= ~(1 << room)
        else:
            room, chosen, count = capacity, count, count + 1
        bins[i] = chosen
        left = room - need
        if left:
            with_room[left].append(chosen)
            rooms |= 1 << left
    return bins


def lower_bounds(lengths: np.ndarray, capacity: int) -> tuple[int, int]:
    """Bins that no packing can do without: by the total, and by the best of two
    families of dual-feasible functions."""
    if not len(lengths):
        return 0, 0
    total = -(-int(lengths.sum()) // capacity)
    n = np.bincount(lengths, minlength=capacity + 1).astype(np.int64)
    count, size = np.cumsum(n), np.cumsum(n * np.arange(capacity + 1))
    k = np.arange(1, capacity // 2 + 1)  # over capacity - k counts whole, under k nothing
    raised = (count[-1] - count[capacity - k]) * capacity + size[capacity - k] - size[k - 1]
    best = max(total, -(-int(raised.max(initial=0)) // capacity))
    sizes = np.arange(capacity + 1)
    for k in range(1, 33):  # rounds multiples of capacity / (k + 1) down, others up to k-ths
        exact = (k + 1) * sizes % capacity == 0
        # In units of 1 / (k * capacity), so that no rounding enters.
        value = np.where(exact, sizes * k, (k + 1) * sizes // capacity * capacity)
        best = max(best, -(-int((n * value).sum()) // (k * capacity)))
    return total, best


def _pack(pieces: pd.DataFrame, capacity: int, last: bool) -> pd.DataFrame:
    """Adds bin, offset and whether the bin's pieces should be packed again."""
    lengths = pieces["length"].to_numpy(np.int64)
    bins = best_fit(lengths, capacity)
    order = np.argsort(bins, kind="stable")
    ends = np.cumsum(lengths[order])
    first = np.r_[True, np.diff(bins[order]) != 0] if len(order) else np.zeros(0, bool)
    starts = (ends - lengths[order])[first]
    offset = np.empty(len(lengths), np.int64)
    offset[order] = ends - lengths[order] - starts[np.cumsum(first) - 1]
    count = int(bins.max(initial=-1)) + 1
    fill = np.bincount(bins, weights=lengths, minlength=count).astype(np.int64)
    total, bound = lower_bounds(lengths, capacity)
    again = np.zeros(count, bool)
    if not last and (count > bound or bound == total):
        emptiest = np.argsort(fill, kind="stable")[: BINS_PER_GAP * (count - bound + 1)]
        again[emptiest] = fill[emptiest] < capacity
    return pieces.assign(bin=bins, offset=offset, again=again[bins])


def _cut(shared: Broadcast, capacity: int, end_id: int | None, keep_ids: bool):
    """Tokens, pieces and the first packing of one partition."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        doc_ids: list = []
        pieces: list[tuple[int, int, int]] = []
        crc: list[int] = []
        kept: list[bytes] = []
        step = capacity * 4
        for batch in batches:
            values, counts = encoder(shared, end_id).encode_array(batch.column("text"))
            encoded = memoryview(values.astype("<u4", copy=False)).cast("B")
            ends = (np.cumsum(counts) * 4).tolist()
            for doc_id, begin, end in zip(batch.column("doc_id").to_pylist(), [0, *ends], ends):
                data = encoded[begin:end]
                for k, at in enumerate(range(0, len(data), step)):
                    part = bytes(data[at : at + step])
                    doc_ids.append(doc_id)
                    pieces.append((k, at // 4, len(part) // 4))
                    crc.append(zlib.crc32(part))
                    if keep_ids:
                        kept.append(part)
        if not doc_ids:
            return
        table = np.array(pieces, np.int64)
        packed = _pack(pd.DataFrame({"length": table[:, 2]}), capacity, last=False)
        part = np.full(len(doc_ids), TaskContext.get().partitionId(), np.int64)
        columns = {
            "doc_id": pa.array(doc_ids, pa.int64()),
            "piece": pa.array(table[:, 0].astype(np.int32)),
            "start": pa.array(table[:, 1]),
            "length": pa.array(table[:, 2]),
            "ids_crc32": pa.array(crc, pa.int64()),
            "part": pa.array(part),
            "bin": pa.array(packed["bin"].to_numpy()),
            "offset": pa.array(packed["offset"].to_numpy()),
            "again": pa.array(packed["again"].to_numpy()),
        }
        if keep_ids:
            columns["ids"] = pa.array([np.frombuffer(x, "<i4") for x in kept], pa.list_(pa.int32()))
        yield from pa.table(columns).to_batches(max_chunksize=10_000)

    return run


PIECE = "doc_id long, piece int, start long, length long, ids_crc32 long, part long, bin long, offset long, again boolean"


def pack_documents(
    docs: DataFrame,
    tokenizer: str,
    capacity: int = 2048,
    end_id: int | None = 0,
    keep_ids: bool = False,
) -> DataFrame:
    """Pack the token ids of every whole text into few sequences of `capacity` ids.

    One row per piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset and,
    with `keep_ids`, its ids. Only texts with more ids than `capacity` are cut. A null or
    empty text has the end id alone. Rows alike are packed as separate documents; null
    ids stay null; other columns are not read; an empty table gives no rows.
    """
    schema = PIECE + (", ids array<int>" if keep_ids else "")
    shared = share_tokenizer(docs.sparkSession, tokenizer)
    pieces = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")
    ).mapInArrow(_cut(shared, capacity, end_id, keep_ids), schema)
    pieces = materialise(pieces, "pieces")
    parts = 1 + (pieces.agg(F.max("part")).first()[0] or 0)
    done, level = [], 0
    while True:
        final = F.lit(parts == 1 and level > 0)
        settled = pieces.where(~F.col("again") | final)
        done.append(
            settled.withColumn(
                "sequence_id", F.lit(level << 56) + F.shiftleft(F.col("part"), 28) + F.col("bin")
            ).drop("part", "bin", "again")
        )
        if parts == 1 and level:
            break
        parts, level = -(-parts // POOL), level + 1
        pieces = materialise(repack(pieces.where("again"), capacity, last=parts == 1), "pieces")
    out = done[0]
    for more in done[1:]:
        out = out.unionByName(more)
    return out


def repack(pieces: DataFrame, capacity: int, last: bool) -> DataFrame:
    """Best-fit decreasing over the pooled pieces of `POOL` partitions each."""

    def run(pool: pd.DataFrame) -> pd.DataFrame:
        return _pack(pool.drop(columns=["bin", "offset", "again"]), capacity, last)[names]

    names = pieces.columns
    pooled = pieces.withColumn("part", F.floor(F.col("part") / POOL))
    return pooled.groupBy("part").applyInPandas(run, pieces.schema)


def certificate(plan: DataFrame, capacity: int = 2048) -> tuple[int, int]:
    """Sequences in `plan` and the bound below which no packing can go; the bound is
    taken from one row per length, at most `capacity` rows."""
    counts = plan.groupBy("length").count().collect()
    lengths = np.repeat([r["length"] for r in counts], [r["count"] for r in counts]).astype(np.int64)
    return plan.select("sequence_id").distinct().count(), lower_bounds(lengths, capacity)[1]
