"""Document fingerprints from improbable features.

A feature is a window of 64 bytes, or a narrow one of 8, of which a short text holds
enough; every text has both, whatever its size. A window's entropy places it in one of a
thousand bins, and the rarer a bin is among the windows of its width in the whole corpus,
the better its rank. Features that are best among their neighbours often enough are
inserted into a chain of Bloom filters for each width. Two texts are compared by the bits
that filters of one width share, less what chance gives.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from touchline.llm.common import each_batch

WINDOW = 64
BINS = 1000
#: A feature is taken if it is best in so many of the runs of `WINDOW` features it is in.
POPULAR = 16
#: Narrow features, their runs and how many of these a feature must be best in.
NARROW, NARROW_RUN, NARROW_POPULAR = 8, 16, 4
FILTER_BYTES = 256
FILTER_FEATURES = 160
HASHES = 5
#: Shared bits up to this part of the way from chance to all count as nothing.
CHANCE = 0.3
#: Bytes of text worked on at once; keeps the arrays in the processor's cache.
BLOCK = 1 << 18

_UNIT = 1 << 20


def _parts(width: int) -> np.ndarray:
    return np.array([0] + [round(-c / width * np.log2(c / width) * _UNIT) for c in range(1, width + 1)], np.int64)


_PART = {width: _parts(width) for width in (WINDOW, NARROW)}
_GAIN = {width: np.diff(part) for width, part in _PART.items()}  # entropy gained by the (c+1)th of a byte value


def entropy_bins(data: np.ndarray, width: int = WINDOW) -> np.ndarray:
    """Bin of the entropy of every window of `data`; exact integers, so that a window's
    bin does not depend on where it lies."""
    n = len(data)
    if n < width:
        return np.zeros(0, np.int32)
    before, after = np.zeros(n, np.uint8), np.zeros(n, np.uint8)
    for d in range(1, width):
        same = (data[d:] == data[:-d]).view(np.uint8)
        before[d:] += same
        after[:-d] += same
    first = _PART[width][np.bincount(data[:width], minlength=256)].sum()
    steps = _GAIN[width][before[width:]] - _GAIN[width][after[: n - width]]
    entropy = np.concatenate([[first], first + np.cumsum(steps)])
    return np.minimum(entropy * BINS // ((width.bit_length() - 1) * _UNIT), BINS).astype(np.int32)


def _blocks(texts: Sequence[bytes]) -> Iterator[tuple[int, int]]:
    """Runs of texts of about `BLOCK` bytes; a longer text is alone."""
    start = size = 0
    for i, text in enumerate(texts):
        if size and size + len(text) > BLOCK:
            yield start, i
            start, size = i, 0
        size += len(text)
    if start < len(texts):
        yield start, len(texts)


def _inside(lengths: np.ndarray, total: int, width: int) -> np.ndarray:
    """Whether `width` bytes from each position lie in one text."""
    ends = np.repeat(np.cumsum(lengths), lengths)
    return np.arange(total) + width <= ends


def histogram(texts: Sequence[bytes]) -> np.ndarray:
    """Windows in each bin, wide ones and then narrow ones."""
    counts = np.zeros((2, BINS + 1), np.int64)
    for a, b in _blocks(texts):
        lengths = np.array([len(t) for t in texts[a:b]])
        data = np.frombuffer(b"".join(texts[a:b]), np.uint8)
        for k, width in enumerate((WINDOW, NARROW)):
            bins = entropy_bins(data, width)
            counts[k] += np.bincount(bins[_inside(lengths, len(data), width)[: len(bins)]], minlength=BINS + 1)
    return counts


def _popular(
    order: np.ndarray, lengths: np.ndarray, total: int, width: int, run: int, popular: int
) -> list[np.ndarray]:
    """Start of the chosen windows of each text; the least of `order`, a number under
    2^22 for each window, is the best, and of equals the first."""
    far = np.iinfo(np.int64).max
    value = np.full(total, far)
    usable = _inside(lengths, total, width)
    value[: len(order)] = (order << 40) | np.arange(len(order))
    value[~usable] = far
    best = value.copy()
    step = 1
    while step < run:  # least of 2, 4, .. `run` from each position
        best[:-step] = np.minimum(best[:-step], best[step:])
        step *= 2
    whole = _inside(lengths, total, width + run - 1)
    at = best[whole] & ((1 << 40) - 1)
    popularity = np.bincount(at, minlength=total)
    starts = np.r_[0, np.cumsum(lengths)]
    most = np.maximum.reduceat(np.r_[popularity, 0], starts[:-1]) if total else np.zeros(len(lengths), int)
    least = np.repeat(np.minimum(most, popular), lengths)
    chosen = np.flatnonzero((popularity >= np.maximum(least, 1)) & usable)
    cuts = np.searchsorted(chosen, starts)
    out = []
    for k, n in enumerate(lengths):
        own = chosen[cuts[k] : cuts[k + 1]] - starts[k]
        if not len(own) and n >= width:  # too short for a full run: its best feature
            own = np.array([int(np.argmin(value[starts[k] : starts[k] + n - width + 1]))])
        out.append(own)
    return out


def _narrow_hashes(data: np.ndarray) -> np.ndarray:
    """A hash of every narrow window: its bytes as one number, mixed through."""
    if len(data) < NARROW:
        return np.zeros(0, np.uint64)
    h = np.lib.stride_tricks.sliding_window_view(data, NARROW).copy().view("<u8").ravel()
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def _filters(hashes: np.ndarray) -> np.ndarray:
    """Bloom filters of so many features, `FILTER_FEATURES` to a row."""
    row = np.arange(len(hashes)) // FILTER_FEATURES
    h = hashes[:, None] >> np.arange(0, 11 * HASHES, 11, dtype=np.uint64)
    bit = (h & np.uint64(FILTER_BYTES * 8 - 1)).astype(np.int64)
    bits = np.zeros((-(-len(hashes) // FILTER_FEATURES), FILTER_BYTES * 8), np.uint8)
    bits[np.repeat(row, HASHES), bit.ravel()] = 1
    return np.packbits(bits, axis=1, bitorder="little")


Chain = tuple[np.ndarray, np.ndarray]  # wide and narrow filters, one row each


def chains(texts: Sequence[bytes], rank: np.ndarray) -> list[Chain]:
    """Bloom filters of each text; an empty text has none, and one of fewer bytes than a
    narrow window has itself as its only feature."""
    out = []
    digest = xxhash.xxh3_64_intdigest
    for a, b in _blocks(texts):
        own = texts[a:b]
        lengths = np.array([len(t) for t in own])
        data = np.frombuffer(b"".join(own), np.uint8)
        total = len(data)
        wide_order = rank[0][entropy_bins(data)].astype(np.int64)
        wide = _popular(wide_order, lengths, total, WINDOW, WINDOW, POPULAR)
        # Narrow windows have few bins; within one their hash decides, wherever they lie.
        hashes = _narrow_hashes(data)
        narrow_order = (rank[1][entropy_bins(data, NARROW)].astype(np.int64) << 12) | (hashes >> np.uint64(52)).astype(np.int64)
        narrow = _popular(narrow_order, lengths, total, NARROW, NARROW_RUN, NARROW_POPULAR)
        starts = np.cumsum(lengths) - lengths
        for text, start, at, near in zip(own, starts, wide, narrow):
            few = np.array([digest(text)] if 0 < len(text) < NARROW else [], np.uint64)
            out.append((
                _filters(np.array([digest(text[i : i + WINDOW]) for i in at.tolist()], np.uint64)),
                _filters(few if len(text) < NARROW else hashes[start + near]),
            ))
    return out


def _shares(a: np.ndarray, b: np.ndarray) -> tuple[float, float]:
    """Sum over the shorter chain's filters of the best match in the other, each by the
    bits it holds, and the sum of these bits."""
    if len(a) > len(b):
        a, b = b, a
    a, b = a.view(np.uint64), b.view(np.uint64)
    ones_a, ones_b = np.bitwise_count(a).sum(axis=1).astype(float), np.bitwise_count(b).sum(axis=1).astype(float)
    total = 0.0
    for row, ones in zip(a, ones_a):
        shared = np.bitwise_count(b & row).sum(axis=1)
        most, chance = np.minimum(ones, ones_b), ones * ones_b / (FILTER_BYTES * 8)
        least = chance + CHANCE * (most - chance)
        total += ones * float(np.clip((shared - least) / np.maximum(most - least, 1e-9), 0, 1).max())
    return total, float(ones_a.sum())


def likeness(a: Chain, b: Chain) -> float:
    """0 to 1: mean over the shorter chain's filters, by the bits they hold, of the best
    match among the other's filters of that width; widths that one lacks do not count."""
    if all(x.shape == y.shape and (x == y).all() for x, y in zip(a, b)):
        return 1.0
    found = [_shares(x, y) for x, y in zip(a, b) if len(x) and len(y)]
    return sum(x for x, _ in found) / sum(n for _, n in found) if found else 0.0


def written(chain: Chain) -> str:
    """Both chains in base64, a colon between; nothing for an empty text."""
    return ":".join(base64.b64encode(x.tobytes()).decode("ascii") for x in chain) if any(map(len, chain)) else ""


def read(fingerprint: str) -> Chain:
    wide, _, narrow = fingerprint.partition(":")
    return tuple(np.frombuffer(base64.b64decode(x), np.uint8).reshape(-1, FILTER_BYTES) for x in (wide, narrow))


def rarity(docs: DataFrame) -> np.ndarray:
    """Rank of each entropy bin over all windows of the corpus, for wide and for narrow
    ones: 0 is the rarest. Only the two thousand sums reach the driver."""

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        counts = histogram([t or b"" for t in batch.column("text").cast(pa.binary()).to_pylist()]).ravel()
        bins = np.flatnonzero(counts)
        return pa.RecordBatch.from_arrays([pa.array(bins.astype(np.int32)), pa.array(counts[bins])], ["bin", "n"])

    plain = docs.select(F.col("text").cast("string").alias("text"))
    sums = plain.mapInArrow(each_batch(run), "bin int, n long").groupBy("bin").agg(F.sum("n").alias("n")).collect()
    counts = np.zeros(2 * (BINS + 1), np.int64)
    for r in sums:
        counts[r["bin"]] = r["n"]
    rank = np.empty((2, BINS + 1), np.int32)
    for own, found in zip(rank, counts.reshape(2, -1)):
        own[np.argsort(found, kind="stable")] = np.arange(BINS + 1)
    return rank


def fingerprint_documents(docs: DataFrame, rank: np.ndarray | None = None) -> DataFrame:
    """(doc_id, fingerprint) for every row; null and empty texts have the empty one."""
    rank = rarity(docs) if rank is None else rank

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        texts = [t or b"" for t in batch.column("text").cast(pa.binary()).to_pylist()]
        found = pa.array([written(c) for c in chains(texts, rank)])
        return pa.RecordBatch.from_arrays([batch.column("doc_id"), found], ["doc_id", "fingerprint"])

    plain = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return plain.mapInArrow(each_batch(run), "doc_id long, fingerprint string")


def _count_up_to(bounds: list[int], at):
    """How many of the sorted bounds are at most `at`, in two steps of a square root."""
    if not bounds:
        return F.lit(0)
    step = max(1, int(len(bounds) ** 0.5))
    coarse = F.array(*[F.lit(x).cast("long") for x in bounds[step - 1 :: step]])
    fine = F.array(*[F.lit(x).cast("long") for x in bounds])
    upto = lambda xs: F.size(F.filter(xs, lambda x: x <= at))
    return upto(coarse) * step + upto(F.slice(fine, upto(coarse) * step + 1, F.lit(step)))


def with_next(docs: DataFrame) -> DataFrame:
    """Rows in ranges of ascending doc_id, each range followed by a copy of the row that
    comes after it; the first row follows the last.

    Columns doc_id, text, bucket, copied; rows of a bucket lie in one task, in order.
    Null ids come first, rows of one id by text. Ranges hold about equally many rows;
    their bounds, one for each task, are all that the driver sees.
    """
    spark = docs.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    key = F.coalesce(F.col("doc_id"), F.lit(-(1 << 63)))
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text")
    ).withColumn("key", key)
    shares = [k / parts for k in range(1, parts)]
    bounds = rows.agg(F.percentile_approx("key", shares, max(10_000, 20 * parts)).alias("b")).first()["b"] if shares else []
    rows = rows.withColumn("bucket", _count_up_to(sorted(set(bounds or [])), F.col("key")))
    firsts = sorted(rows.groupBy("bucket").agg(F.min("key").alias("key")).collect(), key=lambda r: r["bucket"])
    if not firsts:
        return rows.select("doc_id", "text", "bucket", F.lit(False).alias("copied"))
    # The first id of each bucket is copied to the bucket before it.
    before = F.create_map(*[F.lit(x) for k, r in enumerate(firsts) for x in (r["key"], firsts[k - 1]["bucket"])])
    own = F.struct(F.col("bucket").alias("bucket"), F.lit(False).alias("copied"))
    copy = F.struct(F.try_element_at(before, F.col("key")).alias("bucket"), F.lit(True).alias("copied"))
    places = F.when(copy["bucket"].isNotNull(), F.array(own, copy)).otherwise(F.array(own))
    placed = rows.withColumn("place", F.explode(places)).select(
        "doc_id", "text", "key", F.col("place.bucket").alias("bucket"), F.col("place.copied").alias("copied")
    )
    ordered = placed.repartitionById(parts, F.col("bucket")).sortWithinPartitions("bucket", "copied", "key", "text")
    return ordered.select("doc_id", "text", "bucket", "copied")


def compare_with_edits(docs: DataFrame) -> DataFrame:
    """Fingerprints of every text and of its edit, and how alike they are.

    The edit replaces the last floor(n/4) code points by the first as many (or all) of
    the next document in ascending doc_id; the first follows the last. Columns: doc_id,
    n_chars, edited (text), fingerprint, edited_fingerprint, near_edited, near_next.
    Null texts are empty; empty fingerprints are alike, and unlike any other. An only
    row follows itself. Other columns are not read.
    """
    rank = rarity(docs)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None  # last row of the batch before: id, text, copied, chain
        for batch in batches:
            if not batch.num_rows:
                continue
            ids, texts = batch.column("doc_id").to_pylist(), batch.column("text").to_pylist()
            copied = batch.column("copied").to_pylist()
            own = chains([t.encode() for t in texts], rank)
            rows = ([held] if held else []) + list(zip(ids, texts, copied, own))
            held = rows[-1]
            pairs = [(a, b) for a, b in zip(rows, rows[1:]) if not a[2]]
            edits = []
            for (_, text, _, _), (_, following, _, _) in pairs:
                cut = len(text) // 4
                edits.append(text[: len(text) - cut] + following[:cut])
            changed = chains([e.encode() for e in edits], rank)
            columns = {
                "doc_id": pa.array([a[0] for a, _ in pairs], pa.int64()),
                "n_chars": pa.array([len(a[1]) for a, _ in pairs], pa.int64()),
                "edited_sha256": pa.array([hashlib.sha256(e.encode()).hexdigest() for e in edits], pa.string()),
                "fingerprint": pa.array([written(a[3]) for a, _ in pairs], pa.string()),
                "edited_fingerprint": pa.array([written(c) for c in changed], pa.string()),
                "near_edited": pa.array([likeness(a[3], c) for (a, _), c in zip(pairs, changed)], pa.float64()),
                "near_next": pa.array([likeness(a[3], b[3]) for a, b in pairs], pa.float64()),
            }
            yield pa.RecordBatch.from_arrays(list(columns.values()), list(columns))

    schema = (
        "doc_id long, n_chars long, edited_sha256 string, fingerprint string, "
        "edited_fingerprint string, near_edited double, near_next double"
    )
    return with_next(docs).mapInArrow(run, schema)
