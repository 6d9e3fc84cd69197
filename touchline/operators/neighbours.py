"""Nearest neighbours by cosine similarity with a penalty for another role.

`similar_to` scores one target against everyone. `similar_all` finds the exact
top n for everyone at once, as a block join: vectors are grouped into cells
around pivots, each target first finds how good its n-th match is at home, and
then visits only cells that could hold something as good. Blocks are stored as
one row each and read by the tasks that compare them, not shuffled; a task keeps
a short list per target over all it reads. No block holds more than about
`block_rows` vectors, whatever the data looks like.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from touchline import config
from touchline.functions.numbers import dot, unit
from touchline.operators.rows import rank_per_key
from touchline.session import materialise, spread_by

MAX_PIVOTS = 1024
ROLE_SLOTS = 64
# Rows of the bound matrix, vectors by cells, held at a time.
BOUND_ROWS = 256
BLOCK_ROWS = 4096
# Streams in which blocks are read by those they are compared with. Each sends at most one
# short list per target.
STREAMS = 8
# Targets compared with a block at a time.
SLICE_ROWS = 256
# Slack for rounding: of an angle near 0, where arccos is least exact, and of a
# score, whose last digits depend on the order of summation.
ANGLE_SLACK = 1e-6
SCORE_DIGITS = 12


def role_penalty(a: Column, b: Column, mismatch: float = config.ROLE_MISMATCH) -> Column:
    return F.when(a.eqNullSafe(b), F.lit(1.0)).otherwise(F.lit(mismatch))


def similar_to(
    pool: DataFrame,
    target: str,
    n: int = config.TOP_N,
    key: str = "player_key",
    name: str = "player_name",
    position: str = "primary_position",
    vector: str = "features",
    mismatch: float = config.ROLE_MISMATCH,
) -> DataFrame:
    """The `n` rows most similar to the first row, by key, called `target` in any
    case; rows that carry exactly its name are left out. Empty if nobody is
    called that."""
    known = pool.where(F.lower(name) == F.lower(F.lit(target))).agg(
        F.min_by(F.struct(F.col(name), F.col(position), unit(F.col(vector)).alias("v")), key)
    )
    scored = pool.withColumn("_t", known.scalar()).where(F.col(name) != F.col(f"_t.{name}"))
    score = dot(unit(F.col(vector)), F.col("_t.v")) * role_penalty(
        F.col(position), F.col(f"_t.{position}"), mismatch
    )
    return (
        scored.withColumn("similarity_score", F.round(score, SCORE_DIGITS))
        .drop("_t", vector)
        .orderBy(F.col("similarity_score").desc(), F.col(key).asc())
        .limit(n)
    )


def similar_all(
    pool: DataFrame,
    n: int = config.TOP_N,
    key: str = "player_key",
    name: str = "player_name",
    position: str = "primary_position",
    vector: str = "features",
    mismatch: float = config.ROLE_MISMATCH,
    block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """Top `n` per name: name_key, query_key, rank, match_key, match_name, similarity_score.

    One query per name in lower case (`name_key`), made with its first row by
    key, as a lookup by name would. Exact: the result equals scoring all pairs.
    """
    base = pool.select(
        F.col(key).alias("key"),
        F.col(name).alias("name"),
        F.coalesce(F.col(position).cast("string"), F.lit("")).alias("role"),
        unit(F.col(vector).cast("array<double>")).alias("vec"),
    ).withColumn("gid", F.md5(F.concat_ws(",", F.col("vec").cast("array<string>"), F.col("role"))))
    spots = _distinct_spots(base, n)
    lists = _search(spots, n, mismatch, block_rows, base.schema["key"].dataType)
    queries = rank_per_key(
        base.withColumn("name_key", F.lower("name")), ["name_key"], [F.col("key")], 1
    )
    found = queries.select("name_key", "key", "name", "gid").join(lists, "gid")
    others = F.filter("best", lambda b: b["name"] != F.col("name"))
    return found.select(
        "name_key", F.col("key").alias("query_key"), F.posexplode(F.slice(others, 1, n))
    ).select(
        "name_key",
        "query_key",
        (F.col("pos") + 1).alias("rank"),
        F.col("col.key").alias("match_key"),
        F.col("col.name").alias("match_name"),
        (F.lit(0.0) - F.col("col.minus")).alias("similarity_score"),
    )


def _shortlist(df: DataFrame, group: str, order: list[str], n: int) -> DataFrame:
    """Of each group the rows that can be among the first `n` once any one name is
    left out: at most `n` per name, of the first `n + 1` names."""
    # Ranked on its own, so that every map task sends at most `n` rows per name.
    few = rank_per_key(df, [group, "name"], order, n, "_r")
    lead = F.first(F.struct(*order)).over(Window.partitionBy(group, "name").orderBy("_r"))
    few = few.withColumn("lead", lead)
    names = Window.partitionBy(group).orderBy("lead")
    return few.withColumn("_n", F.dense_rank().over(names)).where(F.col("_n") <= n + 1)


def _distinct_spots(base: DataFrame, n: int) -> DataFrame:
    """One row per distinct vector and role, with its short list of members."""
    members = _shortlist(base, "gid", ["key"], n)
    spots = members.groupBy("gid").agg(
        F.first("role").alias("role"),
        F.first("vec").alias("vec"),
        F.collect_list(F.struct("key", "name")).alias("members"),
    )
    return materialise(spots, "spots")


def _search(
    spots: DataFrame, n: int, mismatch: float, block_rows: int, key_type: T.DataType
) -> DataFrame:
    slot = F.pmod(F.xxhash64("role"), F.lit(ROLE_SLOTS)).cast("int")
    total, slots = spots.agg(F.count(F.lit(1)), F.count_distinct(slot)).first()
    # A block is a slot's part of a cell: of about `block_rows`, however many slots there are.
    k = max(1, min(MAX_PIVOTS, math.ceil(total / (block_rows * max(1, slots)))))
    seeds = spots.orderBy(F.xxhash64("gid"), "gid").limit(k).select("vec").collect()
    if not seeds:
        return spots.select("gid").withColumn("best", F.array().cast(_best_type(key_type)))
    pivots = np.array([row["vec"] for row in seeds])

    @F.pandas_udf("cell int, angle double")
    def locate(vec: pd.Series) -> pd.DataFrame:
        angles = _angles(np.stack(vec.to_numpy()), pivots)
        cell = angles.argmin(axis=1)
        return pd.DataFrame({"cell": cell, "angle": angles[np.arange(len(cell)), cell]})

    located = spots.withColumn("slot", slot).withColumn("at", locate("vec"))
    located = located.select("*", "at.cell", "at.angle").drop("at")
    # At most MAX_PIVOTS * ROLE_SLOTS rows, whatever the size of the data.
    cells = (
        located.groupBy("slot", "cell")
        .agg(F.count(F.lit(1)).alias("n"), F.min("angle").alias("low"), F.max("angle").alias("high"))
        .withColumn("chunks", F.ceil(F.col("n") / block_rows).cast("int"))
        .toPandas()
    )
    sizes = spots.sparkSession.createDataFrame(
        cells[["slot", "cell", "chunks"]], "slot int, cell int, chunks int"
    )
    chunk = F.pmod(F.xxhash64("gid"), F.col("chunks"))
    blocks = located.join(F.broadcast(sizes), ["slot", "cell"]).select(
        "gid", "role", "vec", "members", "slot", "cell", _block_id("slot", "cell", chunk).alias("block")
    )

    def pack(block: pa.Table) -> pa.Table:
        pdf = block.to_pandas()
        floors = np.array([floor for _, floor in _best_in_block(pdf, pdf, n, mismatch)])
        vectors, slots = np.stack(pdf["vec"].to_numpy()), pdf["slot"].to_numpy()
        reach = np.zeros(len(cells), dtype=bool)
        for at in range(0, len(pdf), BOUND_ROWS):
            part = slice(at, at + BOUND_ROWS)
            bound = _cell_bounds(vectors[part], slots[part], pivots, cells, mismatch)
            reach |= (bound >= floors[part, None]).any(axis=0)
        one = {c: block[c].slice(0, 1).combine_chunks() for c in ("block", "slot", "cell")}
        all_ = {c: block[c].combine_chunks() for c in ("gid", "role", "vec", "members")}
        all_ |= {"floor": pa.array(floors), "visits": pa.array(_block_numbers(cells[reach]), pa.int64())}
        lists = {c: pa.ListArray.from_arrays(pa.array([0, len(v)], pa.int32()), v) for c, v in all_.items()}
        return pa.table(one | lists)

    members = spots.schema["members"].dataType.simpleString()
    packed = spread_by(blocks, "block").groupBy("block").applyInArrow(
        pack,
        "block long, slot int, cell int, gid array<string>, role array<string>, vec array<array<double>>, "
        f"members array<{members}>, floor array<double>, visits array<long>",
    )
    packed = materialise(packed, "blocks")
    targets = packed.select("block", "slot", "gid", "role", "vec", "floor", "visits")
    hosts = packed.select(
        *[F.col(c).alias(f"to_{c}") for c in ("block", "slot", "cell", "role", "vec", "members")]
    )
    # A pair of blocks is one row, made from what is stored by the task that scores it.
    pairs = hosts.coalesce(STREAMS).hint("shuffle_replicate_nl").join(
        targets, F.array_contains("visits", F.col("to_block"))
    )
    bounds = {(c.slot, c.cell): (c.low, c.high) for c in cells.itertuples()}

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return _score_pairs(batches, n, mismatch, pivots, bounds)

    result = T.StructType(
        [
            T.StructField("gid", T.StringType()),
            T.StructField("key", key_type),
            T.StructField("name", T.StringType()),
            T.StructField("score", T.DoubleType()),
        ]
    )
    scored = pairs.drop("visits").mapInArrow(score, result).withColumn("minus", -F.col("score"))
    # At most `STREAMS` lists per target, so that one shuffle brings them together.
    scored = scored.repartition("gid")
    short = _shortlist(scored, "gid", ["minus", "key"], n)
    best = F.sort_array(F.collect_list(F.struct("minus", "key", "name")))
    return short.groupBy("gid").agg(best.alias("best"))


def _best_type(key_type: T.DataType) -> str:
    return f"array<struct<minus: double, key: {key_type.simpleString()}, name: string>>"


def _block_id(slot: str, cell: str, chunk: Column) -> Column:
    cell_id = F.col(slot).cast("long") * MAX_PIVOTS + F.col(cell)
    return F.shiftleft(cell_id, 32) + chunk.cast("long")


def _block_numbers(cells: pd.DataFrame) -> list[int]:
    """The ids, as `_block_id` gives them, of all chunks of some cells."""
    return [
        ((int(c.slot) * MAX_PIVOTS + int(c.cell)) << 32) + chunk
        for c in cells.itertuples()
        for chunk in range(c.chunks)
    ]


def _angles(vectors: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    return np.arccos(np.clip(vectors @ pivots.T, -1.0, 1.0))


def _cell_bounds(vectors, slots, pivots, cells, mismatch) -> np.ndarray:
    """Highest score each target could reach in each cell, by the triangle
    inequality of angles. An all-zero vector stands at a right angle to
    everything, for which the bound is never below its score of 0."""
    angles = _angles(vectors, pivots)[:, cells["cell"].to_numpy()]
    gap = np.maximum(angles - cells["high"].to_numpy(), cells["low"].to_numpy() - angles)
    cosine = np.cos(np.clip(gap - ANGLE_SLACK, 0.0, math.pi))
    other = cosine * mismatch
    # Another role may share the slot; for a negative cosine it scores higher.
    same = np.maximum(cosine, other)
    alike = slots[:, None] == cells["slot"].to_numpy()[None, :]
    return np.where(alike, same, other) + 10.0**-SCORE_DIGITS


def _best_in_block(targets: pd.DataFrame, candidates: pd.DataFrame, n: int, mismatch: float):
    """For each target its best members of the block, as (key, name, score), and
    the score its n-th match reaches whichever name is left out."""
    owners, keys, names = [], [], []
    for i, members in enumerate(candidates["members"]):
        for m in members:
            owners.append(i)
            keys.append(m["key"])
            names.append(m["name"])
    owners = np.array(owners)
    # Members in key order, so that a stable sort by score breaks ties by key.
    by_key = sorted(range(len(keys)), key=keys.__getitem__)
    owners, keys, names = owners[by_key], [keys[i] for i in by_key], [names[i] for i in by_key]
    matrix = np.stack(candidates["vec"].to_numpy())
    roles = candidates["role"].to_numpy()
    first = min(len(keys), 4 * (n + 1))
    for start in range(0, len(targets), 256):
        part = targets.iloc[start : start + 256]
        cosine = np.stack(part["vec"].to_numpy()) @ matrix.T
        alike = part["role"].to_numpy()[:, None] == roles[None, :]
        scores = np.round(np.where(alike, cosine, cosine * mismatch), SCORE_DIGITS)[:, owners]
        top = np.argpartition(-scores, first - 1, axis=1)[:, :first]
        for row, some in zip(scores, top):
            some = np.sort(some)
            best, floor = _take(row, some[np.argsort(-row[some], kind="stable")], names, n)
            # A tie at the edge of `some` may hide a smaller key: sort everything.
            if len(some) < len(row) and floor <= row[some].min():
                best, floor = _take(row, np.argsort(-row, kind="stable"), names, n)
            yield [(keys[i], names[i], float(row[i])) for i in best], floor


def _matrix(lists: pa.ListArray) -> np.ndarray:
    return lists.flatten().to_numpy(zero_copy_only=False).reshape(len(lists), -1)


class _Hosts:
    """A block of vectors with their members, to compare targets with."""

    def __init__(self, batch: pa.RecordBatch, at: int):
        value = lambda c: batch.column(f"to_{c}")[at]
        self.slot, self.cell = value("slot").as_py(), value("cell").as_py()
        self.vectors = _matrix(value("vec").values)
        self.roles = value("role").as_py()
        members = value("members").values
        self.ends = np.cumsum(members.value_lengths().to_numpy())
        people = members.flatten()
        self.keys, self.names = people.field("key").to_pylist(), people.field("name").to_pylist()

    def members(self, i: int) -> Iterator[tuple]:
        first = int(self.ends[i - 1]) if i else 0
        return zip(self.keys[first : int(self.ends[i])], self.names[first : int(self.ends[i])])


class _Targets:
    """A block of targets, the score each has to reach, and its best members so far as
    (-score, key, name)."""

    def __init__(self, batch: pa.RecordBatch, at: int):
        value = lambda c: batch.column(c)[at]
        # What outlives the batch is copied.
        self.vectors = _matrix(value("vec").values).copy()
        self.gids, self.roles = value("gid").as_py(), value("role").as_py()
        self.slots = np.full(len(self.gids), value("slot").as_py())
        # Scores are computed again, and may then differ in their last digit.
        self.floors = np.array(value("floor").as_py()) - 2 * 10.0**-SCORE_DIGITS
        self.best: list[list[tuple]] = [[] for _ in self.gids]

    def offer(self, i: int, scores: np.ndarray, spots: np.ndarray, hosts: _Hosts, n: int) -> None:
        """Score of some of the hosts with target `i`."""
        first = 4 * (n + 1)
        if len(scores) > first:
            # The best ones raise the floor, and spare most of the others.
            edge = np.partition(scores, len(scores) - first)[len(scores) - first]
            self._with(i, scores, spots, max(edge, self.floors[i]), hosts, n)
        self.best[i] = self._with(i, scores, spots, self.floors[i], hosts, n)

    def _with(self, i: int, scores: np.ndarray, spots: np.ndarray, least: float, hosts: _Hosts, n: int) -> list[tuple]:
        """The best members of target `i` with those that score `least`; raises its floor.
        Rows that are alike are all listed."""
        held = list(self.best[i])
        some = scores >= least
        for score, spot in zip(scores[some].tolist(), spots[some].tolist()):
            held += [(-score, key, name) for key, name in hosts.members(spot)]
        ranked = sorted(held, key=lambda b: (b[0], b[1], b[2] or ""))
        best, floor = _take([-b[0] for b in ranked], range(len(ranked)), [b[2] for b in ranked], n)
        self.floors[i] = max(self.floors[i], floor)
        return [ranked[j] for j in best]


def _score_pairs(
    batches: Iterator[pa.RecordBatch], n: int, mismatch: float, pivots: np.ndarray, bounds: dict[tuple, tuple]
) -> Iterator[pa.RecordBatch]:
    """From pairs of blocks, the best members that each target meets in all of them."""
    targets: dict[int, _Targets] = {}
    hosts, block, key_type = None, None, None
    for batch in batches:
        key_type = batch.schema.field("to_members").type.value_type.value_type.field("key").type
        for at, (own, to) in enumerate(zip(batch.column("block").to_pylist(), batch.column("to_block").to_pylist())):
            if own not in targets:
                targets[own] = _Targets(batch, at)
            if to != block:
                hosts, block = _Hosts(batch, at), to
            _meet(targets[own], hosts, n, mismatch, pivots, bounds)
    for own in targets.values():
        found = [(gid, *b) for gid, best in zip(own.gids, own.best) for b in best]
        gids, minus, keys, names = zip(*found) if found else ((), (), (), ())
        columns = [pa.array(gids, pa.string()), pa.array(keys, key_type), pa.array(names, pa.string()), pa.array([-m for m in minus], pa.float64())]
        yield pa.RecordBatch.from_arrays(columns, ["gid", "key", "name", "score"])


def _meet(targets: _Targets, hosts: _Hosts, n: int, mismatch: float, pivots: np.ndarray, bounds: dict[tuple, tuple]) -> None:
    """Compare targets that can reach their floor in the hosts' cell with all hosts."""
    low, high = bounds[hosts.slot, hosts.cell]
    cell = pd.DataFrame({"slot": [hosts.slot], "cell": [0], "low": [low], "high": [high]})
    bound = _cell_bounds(targets.vectors, targets.slots, pivots[[hosts.cell]], cell, mismatch)[:, 0]
    reach = np.flatnonzero(bound >= targets.floors)
    codes = {role: i for i, role in enumerate({*hosts.roles, *targets.roles})}
    host_roles = np.array([codes[r] for r in hosts.roles])
    own_roles = np.array([codes[r] for r in targets.roles])
    for start in range(0, len(reach), SLICE_ROWS):
        rows = reach[start : start + SLICE_ROWS]
        cosine = targets.vectors[rows] @ hosts.vectors.T
        floors = targets.floors[rows]
        # Whether with the penalty or without, no lower cosine reaches the floor.
        least = floors - 10.0**-SCORE_DIGITS
        least = np.minimum(least, least / mismatch) if mismatch > 0 else np.full(len(rows), -np.inf)
        hits = np.flatnonzero(cosine >= least[:, None])
        at, spots = np.divmod(hits, len(host_roles))
        cosine = cosine.ravel()[hits]
        scores = np.round(np.where(own_roles[rows[at]] == host_roles[spots], cosine, cosine * mismatch), SCORE_DIGITS)
        good = np.flatnonzero(scores >= floors[at])
        at, spots, scores = at[good], spots[good], scores[good]
        starts = np.flatnonzero(np.diff(at, prepend=-1))
        for a, b in zip(starts, [*starts[1:], len(at)]):
            targets.offer(rows[at[a]], scores[a:b], spots[a:b], hosts, n)


def _take(row, order, names, n):
    seen: dict[str, int] = {}
    best = []
    for i in order:
        count = seen.get(names[i], 0)
        if count < n:
            best.append(i)
            seen[names[i]] = count + 1
            if len(seen) > n:
                return best, float(row[i])
    return best, -2.0
