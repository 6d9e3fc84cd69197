"""SimHash near-duplicates by a popcount embedding and a grid join.

A fingerprint of 64 bits is embedded as the bit counts of its 32 two-bit segments. The
Manhattan distance of two embeddings never exceeds the Hamming distance of their
fingerprints, so a link of at most r bits moves at most r segments. With the segments
in b blocks, b - r blocks or more are at distance nothing: cells of the grid are the
values of b - r blocks, and every link meets in one of the C(b, r) grids. In a cell the
fingerprints themselves are compared, and of its links only a spanning forest goes on.

A fingerprint may have further words of 64 bits. Each word then has grids of its own,
in which pairs meet that are further apart than any one word could promise, and the
bits of the first few words are compared.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, functions as F

from touchline.llm.common import each_batch, materialise, row_key
from touchline.llm.components import connected_components

SEED = 42
SEGMENTS = 32
#: Chance that two random segments have one count, as a power of a half.
SEGMENT_BITS = 1.415
#: Members that a cell may hold on average.
MATES = 1000
#: Members of a cell that meet in one task. Larger cells are dealt out in pairs of chunks.
CHUNK = 20_000
BUFFER = 200_000
SMALL = 512
#: ASCII white space parts words; upper case is lowered.
FOLD = bytes(32 if c in (9, 10, 11, 12, 13) else c + 32 if 65 <= c <= 90 else c for c in range(256))


def fingerprint(text: bytes | None, shingle: int, words: int = 1) -> tuple[int, ...]:
    """64 majority bits over the XXH64 of all shingles, as a signed number, and over as
    many further hashes, mixed from it, as `words` asks for."""
    hashes = shingle_hashes(text, shingle)
    return _words(hashes, words) if len(hashes) else (0,) * words


def shingle_hashes(text: bytes | None, shingle: int) -> np.ndarray:
    """XXH64 of every shingle in order; words fewer than a shingle are one, no words none."""
    found = text.translate(FOLD).split() if text else []
    if not found:
        return np.zeros(0, np.uint64)
    line = b" ".join(found)
    if len(found) <= shingle:
        shingles = [line]
    else:
        lengths = np.fromiter(map(len, found), np.int64, len(found))
        ends = np.cumsum(lengths + 1) - 1
        starts = (ends - lengths)[: len(found) - shingle + 1].tolist()
        shingles = [line[a:b] for a, b in zip(starts, ends[shingle - 1 :].tolist())]
    digest = xxhash.xxh64_intdigest
    return np.array([digest(s, SEED) for s in shingles], np.uint64)


def _words(hashes: np.ndarray, words: int) -> tuple[int, ...]:
    return tuple(_majority(mixed(hashes, w) if w else hashes) for w in range(words))


def mixed(hashes: np.ndarray, word: int) -> np.ndarray:
    """Further hashes from one: a step of a counter, then the bits mixed through."""
    h = hashes + np.uint64(word * 0x9E3779B97F4A7C15 % (1 << 64))
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def _majority(hashes: np.ndarray) -> int:
    ones = np.zeros(64, np.int64)
    for at in range(0, len(hashes), 30_000):
        bits = np.unpackbits(hashes[at : at + 30_000].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(axis=0, dtype=np.uint16)
    return int(np.packbits(ones * 2 > len(hashes), bitorder="little").view("<i8")[0])


def fingerprints(docs: DataFrame, shingle: int = 4, words: int = 1) -> DataFrame:
    """(doc_id, row, fp0, fp1, ...) for every row, over its whole text; `row` is the key
    of the text (see common.row_key)."""
    names = [f"fp{w}" for w in range(words)]

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        texts = batch.column("text").cast(pa.binary()).to_pylist()
        found = np.array([fingerprint(t, shingle, words) for t in texts], np.int64)
        columns = [batch.column("doc_id"), batch.column("row"), *[pa.array(found[:, w].copy()) for w in range(words)]]
        return pa.RecordBatch.from_arrays(columns, ["doc_id", "row", *names])

    plain = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), row_key().alias("row"), F.col("text").cast("string").alias("text")
    )
    return plain.mapInArrow(each_batch(run), "doc_id long, row long, " + ", ".join(f"{n} long" for n in names))


def embedding(fp: Column) -> Column:
    """Bit counts of the 32 segments, two bits each: 00, 01, 10 for 0, 1, 2."""
    mask = F.lit(0x5555555555555555)
    high, low = F.shiftrightunsigned(fp, 1).bitwiseAND(mask), fp.bitwiseAND(mask)
    return high.bitwiseXOR(low).bitwiseOR(F.shiftleft(high.bitwiseAND(low), 1))


def blocks_for(points: int, reach: int) -> int:
    """Blocks with which a cell of so many random points has about `MATES` members; any
    number over `reach` gives the same links."""
    for blocks in range(reach + 1, reach + 5):
        if points * 0.5 ** (SEGMENT_BITS * SEGMENTS * (blocks - reach) / blocks) <= MATES:
            break
    return blocks


def grids(blocks: int, reach: int) -> list[int]:
    """Masks over the embedding, one for each choice of blocks that may not differ."""
    cuts = [round(i * SEGMENTS / blocks) for i in range(blocks + 1)]
    own = [sum(3 << (2 * s) for s in range(a, b)) for a, b in zip(cuts, cuts[1:])]
    return [sum(own[i] for i in kept) for kept in combinations(range(blocks), blocks - reach)]


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def _forest(points: np.ndarray, most: int) -> list[tuple[int, int]]:
    """Links, as positions in `points`, that join all that are joined at all; each
    member is reached once."""
    links: list[tuple[int, int]] = []
    rest = np.arange(len(points))
    while len(rest):
        front, rest = [rest[0]], rest[1:]
        while front and len(rest):
            at = front.pop()
            near = np.bitwise_count(points[rest] ^ points[at]).sum(axis=1) <= most
            if near.any():
                links += [(int(at), int(x)) for x in rest[near]]
                front += list(rest[near])
                rest = rest[~near]
    return links


def _meet(words: int, most: int):
    """Links within each cell; rows come sorted by cell."""
    names = [f"fp{w}" for w in range(words)]

    def links(cell: np.ndarray, points: np.ndarray) -> np.ndarray:
        starts = np.flatnonzero(np.r_[True, cell[1:] != cell[:-1]])
        counts = np.diff(np.r_[starts, len(cell)])
        group = np.repeat(np.arange(len(starts)), counts)
        size = counts[group]
        found_a, found_b = [], []
        small = np.flatnonzero((size > 1) & (size <= SMALL))
        for step in range(1, int(size[small].max(initial=1))):
            small = small[small + step < len(cell)]
            small = small[group[small] == group[small + step]]
            apart = np.bitwise_count(points[small, 0] ^ points[small + step, 0])
            for w in range(1, words):
                apart = apart + np.bitwise_count(points[small, w] ^ points[small + step, w])
            near = apart <= most
            found_a.append(small[near])
            found_b.append(small[near] + step)
        a = np.concatenate(found_a) if found_a else np.zeros(0, np.int64)
        b = np.concatenate(found_b) if found_b else a
        # Cells with more links than members, and large cells, give a forest instead.
        many = np.bincount(group[a], minlength=len(starts)) > counts
        keep = ~many[group[a]]
        out = [np.stack([a[keep], b[keep]], axis=1)]
        for g in np.flatnonzero(many | (counts > SMALL)):
            own = points[starts[g] : starts[g] + counts[g]]
            out.append(np.array(_forest(own, most), np.int64).reshape(-1, 2) + starts[g])
        return np.concatenate(out)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        rows = 0

        def solve(last: bool) -> pa.RecordBatch | None:
            nonlocal held, rows
            whole = pa.Table.from_batches(held)
            change = np.zeros(rows, bool)
            for name in ("grid", "cell", "low", "high"):
                key = whole.column(name).to_numpy()
                change[1:] |= key[1:] != key[:-1]
            cell = np.cumsum(change)
            end = rows if last else int(np.searchsorted(cell, cell[-1]))  # the last cell may go on
            points = np.stack([whole.column(n).to_numpy()[:end] for n in names], axis=1).view(np.uint64)
            held, rows = whole.slice(end).to_batches(), rows - end
            if not end:
                return None
            found = links(cell[:end], points)
            sides = [points[found[:, side], w].view(np.int64) for side in (0, 1) for w in range(words)]
            return pa.RecordBatch.from_arrays([pa.array(x) for x in sides], [f"{s}{w}" for s in "ab" for w in range(words)])

        wait = BUFFER
        for batch in batches:
            held.append(batch)
            rows += batch.num_rows
            if rows >= wait:
                found = solve(last=False)
                if found is not None:
                    yield found
                wait = rows + BUFFER
        if rows:
            yield solve(last=True)

    return run


def linked(distinct: DataFrame, words: int, compared: int, reach: int, most: int, blocks: int) -> DataFrame:
    """Links (a0, .., b0, ..) between different points fp0, .. of a cell that differ in
    `most` or fewer bits of the `compared` first words, as far as they are needed to
    join all that are joined."""
    names = [f"fp{w}" for w in range(compared)]
    masks = grids(blocks, reach)
    places = [
        F.struct(F.lit(w * len(masks) + k).alias("grid"), F.col(f"packed{w}").bitwiseAND(F.lit(_signed(mask))).alias("cell"))
        for w in range(words)
        for k, mask in enumerate(masks)
    ]
    packed = distinct.select(*names, *[embedding(F.col(f"fp{w}")).alias(f"packed{w}") for w in range(words)])
    cells = packed.select(*names, F.explode(F.array(*places)).alias("at")).select(*names, "at.grid", "at.cell")
    large = (
        cells.groupBy("grid", "cell").count().where(F.col("count") > CHUNK)
        .select("grid", "cell", F.ceil(F.col("count") / CHUNK).cast("int").alias("chunks"))
    )
    own = F.pmod(F.xxhash64(*names), F.col("k")).cast("int")
    dealt = (
        cells.join(large, ["grid", "cell"], "left")
        .select(*names, "grid", "cell", F.coalesce("chunks", F.lit(1)).alias("k"))
        .withColumn("own", own)
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("k") - 1)))
        .select("grid", "cell", F.least("own", "other").alias("low"), F.greatest("own", "other").alias("high"), *names)
    )
    keys = ["grid", "cell", "low", "high"]
    sorted_cells = dealt.repartition(*keys).sortWithinPartitions(*keys)
    ends = [f"{s}{w}" for s in "ab" for w in range(compared)]
    return sorted_cells.mapInArrow(_meet(compared, most), ", ".join(f"{e} long" for e in ends)).distinct()


def near_duplicates(
    docs: DataFrame,
    shingle: int = 4,
    reach: int = 4,
    words: int = 1,
    compared: int = 1,
    most: int | None = None,
    blocks: int | None = None,
) -> DataFrame:
    """(doc_id, row, fp0, .., group, component_id) for every row of `docs` (doc_id, text).

    Fingerprints are linked if they share a cell of any word's grids and differ in
    `most` or fewer bits of the `compared` first words. All that differ in `reach` or
    fewer bits of a word share one; with one word and `most` left at `reach`, links are
    just these, whatever `blocks`. More words let pairs meet that differ by more in each.
    `component_id` is the smallest doc_id that links reach, the row's own included. Rows
    with one fingerprint are one point, so copies never meet one by one. Every link
    counts.

    Null and empty texts have fingerprint 0 and are linked like any other. A null doc_id
    keeps its row and counts in no minimum; a component of nulls alone has a null id.
    Other columns are not read; an empty table gives no rows.
    """
    names = [f"fp{w}" for w in range(words)]
    rows = materialise(fingerprints(docs, shingle, words), "fingerprints")
    distinct = rows.groupBy(*names).agg(F.min("doc_id").alias("first_id")).withColumn("node", _node("fp", compared))
    distinct = materialise(distinct, "distinct")
    blocks = blocks or blocks_for(distinct.count(), reach)
    links = linked(distinct, words, compared, reach, reach if most is None else most, blocks)
    found = connected_components(links.select(_node("a", compared).alias("a"), _node("b", compared).alias("b")))
    groups = distinct.join(found, "node", "left").select(*names, "first_id", F.coalesce("component", "node").alias("group"))
    least = groups.groupBy("group").agg(F.min("first_id").alias("component_id"))
    ids = groups.join(least, "group").select(*names, "group", "component_id")
    return rows.join(ids, names).select("doc_id", "row", *names, "group", "component_id")


def first_of_groups(docs: DataFrame, **settings) -> DataFrame:
    """The rows of `docs`, all columns, of which none is linked to a smaller doc_id: one
    row of each group of near-duplicates (see near_duplicates for the settings). Of
    rows alike one stays; a null doc_id stays only in a group of nulls alone."""
    found = near_duplicates(docs, **settings)
    least = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "row")).alias("first")
    return rows_of(docs, found.groupBy("group").agg(least)).dropDuplicates(KEYS).drop(*KEYS)


KEYS = ["_key_id", "_key_row"]


def rows_of(docs: DataFrame, chosen: DataFrame) -> DataFrame:
    """The rows of `docs`, and `KEYS`, that the column `first` of `chosen` names."""
    none = F.lit(-(1 << 63))
    keys = chosen.select(F.coalesce("first.doc_id", none).alias(KEYS[0]), F.col("first.row").alias(KEYS[1]))
    rows = docs.select(
        *[f"`{c}`" for c in docs.columns], F.coalesce(F.col("doc_id").cast("long"), none).alias(KEYS[0]), row_key().alias(KEYS[1])
    )
    return rows.join(keys, KEYS).select(*[f"`{c}`" for c in docs.columns], *KEYS)


def _node(prefix: str, words: int) -> Column:
    """A fingerprint as one value that can be ordered."""
    first = F.col(f"{prefix}0")
    return first if words == 1 else F.concat(*[hex_digits(F.col(f"{prefix}{w}")) for w in range(words)])


def hex_digits(fp: Column) -> Column:
    return F.lower(F.lpad(F.hex(fp), 16, "0"))
