"""Name matching across two feeds: blocking, scoring, best match, acceptance.

Names are compared only within a block of equal first letters. A name found
letter for letter under the same team cannot be beaten, so an equi-join settles
it. The rest of a block is cut into chunks of bounded size on both sides, and
each pair of chunks is searched in one task that hands back one row per player:
pairs are never listed, and an upper bound on the score spares most of them the
full comparison. In a large block names that hold nearly the same letters are looked
up by these first (`operators.letters`); only a name for which others could still be
better is compared with the whole block.
"""

from __future__ import annotations

import string
from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F, types as T

from touchline import config
from touchline.functions.jaro import BOOST_ABOVE, PREFIX_MAX, PREFIX_SCALE, coded, similarity_points, similarity_points_of
from touchline.functions.text import clean_name, surrogate_key
from touchline.operators.letters import near_in_letters
from touchline.operators.rows import rank_per_key
from touchline.session import materialise, spread_by

BLOCK_LETTERS = 3
CHUNK_ROWS = 2000
#: Letters cut off a name's end when a first match is looked for.
TRIMMED = 3
#: Names whose bounds are computed at a time, market names whose letters are bounded as one;
#: candidates of a name whose letters are compared first; bounds and pairs held at a time.
BOUND_ROWS = 128
TILE_ROWS = 32
FIRST = 4
HELD_BOUNDS = 1_000_000
HELD_PAIRS = 500_000
#: Pairs of names from which on a block is looked up by letters, and names of either side in
#: a task that does so. Fewer names of the left are taken where tasks would be few.
LARGE_BLOCK = 200_000_000
LETTER_ROWS = (100_000, 200_000)
LEAST_LETTER_ROWS = 10_000
#: Names of either side in a task that compares what is left of such a block with all of it.
REST_ROWS = (10_000, 100_000)
LEAST_REST_ROWS = 500
#: Points of floors within which names are bounded together.
FLOOR_STEP = 75
MATCH_COLUMNS = (
    "player_from_players", "player_from_market", "player_team", "market_team",
    "p_clean", "m_clean", "name_sim", "team_sim", "team_match", "final_score",
)
MARKET_COLUMNS = (
    "player_from_market", "market_team", "p_clean", "m_clean", "name_sim", "team_sim", "team_match", "final_score",
)
_LETTERS = string.ascii_lowercase + string.digits + " "
_SLOTS = np.array([_LETTERS.find(chr(c)) % (len(_LETTERS) + 1) for c in range(129)])
_PERFECT = (
    100 * config.MATCH_WEIGHTS["name"]
    + 100 * config.MATCH_WEIGHTS["team"]
    + config.MATCH_WEIGHTS["same_team"]
)


def names_with_blocks(df: DataFrame, name: str, team: str, accents=None) -> DataFrame:
    """Distinct (name, team) with the cleaned name and its block."""
    accents = accents or (config.NAME_ACCENTS, config.NAME_PLAIN)
    pairs = df.select(F.col(name).alias("name"), F.col(team).cast("string").alias("team"))
    return (
        pairs.where(F.col("name").isNotNull())
        .distinct()
        .withColumn("clean", clean_name(F.col("name"), *accents))
        .withColumn("same", F.lower(F.coalesce("team", F.lit(""))))
        .withColumn("block", F.left("clean", F.lit(BLOCK_LETTERS)))
    )


def block_profile(left: DataFrame, right: DataFrame) -> DataFrame:
    """Size of each shared block on both sides and the comparisons it stands for."""
    counted = left.groupBy("block").agg(F.count(F.lit(1)).alias("left_names"))
    other = right.groupBy("block").agg(F.count(F.lit(1)).alias("right_names"))
    return counted.join(other, "block").withColumn(
        "pairs", F.col("left_names") * F.col("right_names")
    )


def _market_order() -> list[Column]:
    """Tie order among the market names for one cleaned name and team."""
    return [
        F.col("final_score").desc(),
        (F.col("p_clean") == F.col("m_clean")).desc(),
        F.col("player_from_market").asc(),
        F.col("market_team").asc_nulls_first(),
    ]


def _tie_order(score: Column) -> list[Column]:
    return [
        score.desc(),
        (F.col("p_clean") == F.col("m_clean")).desc(),
        F.col("player_team").asc_nulls_first(),
        F.col("player_from_market").asc(),
        F.col("market_team").asc_nulls_first(),
    ]


def best_match(
    left: DataFrame, right: DataFrame, chunk_rows: int = CHUNK_ROWS, large_block: int = LARGE_BLOCK
) -> DataFrame:
    """The best market name per player name, over all of the player's teams.

    Inputs come from `names_with_blocks`. Scores are whole points: 0.75 name,
    0.15 team, 0.10 for the 0/1 flag of equal teams. Ties go to the letter-for-
    letter equal name, then by team and market name.
    """
    left, right = materialise(left, "names"), materialise(right, "names")
    settled = _exact_hits(left, right)
    open_left = left.join(settled.select(F.col("player_from_players").alias("name")), "name", "left_anti")
    # Names that clean to one text of one team are searched once, and found as the
    # first of them in tie order.
    wanted = open_left.select("block", "clean", "same").distinct()
    first = F.min(F.struct("name", "team"))
    offered = right.groupBy("block", "clean", "same").agg(first.alias("m")).select("block", "clean", "same", "m.*")
    searched = _search(wanted, offered, chunk_rows, large_block)
    nearest = rank_per_key(searched, ["p_clean", "same"], _market_order(), 1, "_r").drop("_r")
    back = open_left.select(
        F.col("name").alias("player_from_players"), F.col("team").alias("player_team"), F.col("clean").alias("p_clean"), "same"
    )
    ranked = rank_per_key(
        back.join(nearest, ["p_clean", "same"]), ["player_from_players"], _tie_order(F.col("final_score")), 1, "_r"
    )
    return settled.select(*MATCH_COLUMNS).unionByName(ranked.select(*MATCH_COLUMNS))


def _exact_hits(left: DataFrame, right: DataFrame) -> DataFrame:
    usable = (F.col("clean") != "") & (F.col("same") != "")
    first = (
        right.where(usable)
        .groupBy("clean", "same")
        .agg(F.min(F.struct("name", "team")).alias("m"))
    )
    hits = left.where(usable).join(first, ["clean", "same"]).select(
        F.col("name").alias("player_from_players"),
        F.col("m.name").alias("player_from_market"),
        F.col("team").alias("player_team"),
        F.col("m.team").alias("market_team"),
        F.col("clean").alias("p_clean"),
        F.col("clean").alias("m_clean"),
        F.lit(100).alias("name_sim"),
        F.lit(100).alias("team_sim"),
        F.lit(1).alias("team_match"),
        (F.lit(_PERFECT) / 100.0).alias("final_score"),
    )
    return rank_per_key(hits, ["player_from_players"], _tie_order(F.col("final_score")), 1, "_r")


@F.pandas_udf(T.IntegerType())
def _score(a: pd.Series, team_a: pd.Series, b: pd.Series, team_b: pd.Series) -> pd.Series:
    w = config.MATCH_WEIGHTS
    each = np.arange(len(a))
    teams = pd.Series([w["team"] * _team_points(s, t) + w["same_team"] * (s == t) for s, t in zip(team_a, team_b)], dtype="int32")
    return teams + (w["name"] * similarity_points_of(coded(a.tolist()), coded(b.tolist()), each, each)).astype("int32")


def _with_floor(wanted: DataFrame, offered: DataFrame) -> DataFrame:
    """Adds `floor`, a score that some market name reaches, from one market name for each
    beginning that a name shares once up to `TRIMMED` letters are cut off, by any team and by
    its own. It only spares comparisons: a name that shares none has a floor of -1."""
    cut = F.explode(F.sequence(F.lit(0), F.lit(TRIMMED)))
    key = F.left("clean", F.length("clean") - F.col("k"))
    heads = offered.select("block", "clean", "same", cut.alias("k")).withColumn("head", key)
    asked = wanted.withColumn("k", cut).withColumn("head", key)
    near = None
    for by in (["block", "head"], ["block", "head", "same"]):
        one = heads.groupBy(*by).agg(F.min(F.struct(F.col("clean").alias("c"), F.col("same").alias("s"))).alias("o"))
        found = asked.join(one, by).select("block", "clean", "same", "o")
        near = found if near is None else near.unionByName(found)
    scored = near.distinct().withColumn("floor", _score("clean", "same", "o.c", "o.s"))
    floors = scored.groupBy("block", "clean", "same").agg(F.max("floor").alias("floor"))
    return wanted.join(floors, ["block", "clean", "same"], "left").fillna({"floor": -1})


def _search(wanted: DataFrame, offered: DataFrame, chunk_rows: int, large_block: int) -> DataFrame:
    wanted, offered = materialise(wanted, "wanted"), materialise(offered, "offered")
    # At most one row per three-letter text over 37 letters, so about 52,000.
    profile = materialise(block_profile(wanted, offered), "blocks")
    large = profile.where(F.col("pairs") >= large_block)
    names = large.agg(F.sum("left_names")).first()[0]
    if not names:
        return _search_blocks(_with_floor(wanted, offered), offered, profile, chunk_rows)
    small = profile.where(F.col("pairs") < large_block)
    some = wanted.join(F.broadcast(small.select("block")), "block")
    among = offered.join(F.broadcast(small.select("block")), "block")
    found = _search_blocks(_with_floor(some, among), among, small, chunk_rows)
    looked_up = materialise(_search_letters(wanted, offered, large, names), "looked_up")
    # A name is settled once nothing that was not looked up could reach its score.
    reached = looked_up.groupBy("block", F.col("p_clean").alias("clean"), "same").agg(
        F.max("score").alias("floor"), F.max("beyond").alias("beyond")
    )
    rest = reached.where(F.col("floor") <= F.col("beyond")).select("block", "clean", "same", "floor")
    rest = materialise(rest, "rest")
    rows = _rows_for_tasks(rest, rest.count(), LEAST_REST_ROWS, REST_ROWS[0])
    others = _search_blocks(rest, offered, block_profile(rest, offered), rows, REST_ROWS[1])
    hits = looked_up.where("score >= 0").withColumn("final_score", F.col("score") / 100.0)
    return found.unionByName(others).unionByName(hits.select(*found.columns))


_FOUND = (
    "same string, player_from_market string, market_team string, p_clean string, m_clean string, "
    "name_sim int, team_sim int, team_match int"
)


def _search_letters(left: DataFrame, right: DataFrame, sizes: DataFrame, names: int) -> DataFrame:
    """For every name of the blocks in `sizes` and chunk of market names, the best of those
    that hold nearly its letters (a score of -1 if none does), and the highest score that
    others of the chunk could have (`beyond`)."""
    rows = _rows_for_tasks(left, names, LEAST_LETTER_ROWS, LETTER_ROWS[0])
    return _by_chunks(
        left, right, sizes, rows, LETTER_ROWS[1], (), _best_by_letters, f"block string, {_FOUND}, score int, beyond int"
    )


def _rows_for_tasks(df: DataFrame, names: int, least: int, most: int) -> int:
    """Names of a chunk, so that there are some chunks for every task."""
    return max(least, min(most, names // (2 * int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))))


def _search_blocks(
    left: DataFrame, right: DataFrame, sizes: DataFrame, left_rows: int, right_rows: int | None = None
) -> DataFrame:
    return _by_chunks(
        left, right, sizes, left_rows, right_rows or left_rows, ("floor",), _best_of_chunk, f"{_FOUND}, final_score double"
    )


def _by_chunks(
    left: DataFrame, right: DataFrame, profile: DataFrame, left_rows: int, right_rows: int,
    carried: tuple[str, ...], search: Callable[[pd.DataFrame, pd.DataFrame], pd.DataFrame], schema: str,
) -> DataFrame:
    """`search` over every pair of chunks of the blocks in `profile`."""
    sizes = profile.select(
        "block",
        F.ceil(F.col("left_names") / left_rows).cast("int").alias("left_chunks"),
        F.ceil(F.col("right_names") / right_rows).cast("int").alias("right_chunks"),
    )

    def chunked(df: DataFrame, own: str, other: str, *carried: str) -> DataFrame:
        return (
            df.join(F.broadcast(sizes), "block")
            .withColumn(own, F.pmod(F.xxhash64("clean", "same"), F.col(f"{own}s")).cast("int"))
            .withColumn(other, F.explode(F.sequence(F.lit(0), F.col(f"{other}s") - 1)))
            .select("block", "left_chunk", "right_chunk", "clean", "same", *carried)
        )

    keys = ["block", "left_chunk", "right_chunk"]
    return (
        spread_by(chunked(left, "left_chunk", "right_chunk", *carried), *keys)
        .groupBy(*keys)
        .cogroup(spread_by(chunked(right, "right_chunk", "left_chunk", "name", "team"), *keys).groupBy(*keys))
        .applyInPandas(search, schema)
    )


def _in_tie_order(right: pd.DataFrame) -> list[tuple]:
    """Market names so that the first of equal scores is the one to keep."""
    return sorted(
        zip(right["name"], right["team"], right["clean"], right["same"]),
        key=lambda r: (r[0], r[1] is not None, r[1] or ""),
    )


def _best_by_letters(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
    out = []
    if len(left) and len(right):
        market = _in_tie_order(right)
        block, cleans, sames = left["block"].iloc[0], left["clean"].tolist(), left["same"].tolist()
        found, beyond = near_in_letters(cleans, sames, [r[2] for r in market], [r[3] for r in market])
        nothing = (None, None, None, None)
        for i, (j, score, ns, ts, tm) in enumerate(found):
            name, market_team, m_clean, _ = nothing if score < 0 else market[j]
            out.append((block, sames[i], name, market_team, cleans[i], m_clean, ns, ts, tm, score, beyond[i]))
    return pd.DataFrame(out, columns=["block", "same", *MARKET_COLUMNS[:-1], "score", "beyond"])


def _best_of_chunk(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
    out = []
    if len(left) and len(right):
        # Names that need like scores and hold like letters lie side by side.
        by = pd.DataFrame({"step": -left["floor"] // FLOOR_STEP, "letters": left["clean"].map(_by_letters)})
        left = left.loc[by.sort_values(["step", "letters"]).index]
        market = _in_tie_order(right)
        search = _Search([r[2] for r in market], [r[3] for r in market])
        cleans, sames = left["clean"].tolist(), left["same"].tolist()
        for i, j, score, ns, ts, tm in search.over(cleans, sames, left["floor"].to_numpy()):
            name, market_team, m_clean, _ = market[j]
            out.append((sames[i], name, market_team, cleans[i], m_clean, ns, ts, tm, score / 100.0))
    return pd.DataFrame(out, columns=["same", *MARKET_COLUMNS])


@lru_cache(200_000)
def _team_points(a: str, b: str) -> int:
    return similarity_points(a, b)


class _Search:
    """Best of a chunk of market names for cleaned names and their teams."""

    def __init__(self, cleans: list[str], sames: list[str]):
        self.names, self.codes = np.array(cleans, object), coded(cleans)
        self.teams, self.team_of = np.unique(np.array(sames, object), return_inverse=True)
        self.lengths = np.maximum(self.codes[2], 1).astype(np.float32)
        # Names that hold like letters lie side by side, for bounds of many at once.
        self.order = np.argsort(np.array([_by_letters(c) for c in cleans], object), kind="stable")
        self.tiles = np.arange(0, len(cleans), TILE_ROWS)
        self.each_length, self.length_of = np.unique(self.lengths[self.order], return_inverse=True)
        self.counts = _letters(cleans)[self.order]
        self.tile_lengths = np.zeros((len(self.each_length), len(self.tiles)), bool)
        self.tile_lengths[self.length_of, np.arange(len(cleans)) // TILE_ROWS] = True

    def over(self, cleans: list[str], sames: list[str], floors: np.ndarray) -> Iterator[tuple]:
        """(name, market name, score, its parts) of the best match of each name that has one
        that reaches its floor, both as places in their lists."""
        w = config.MATCH_WEIGHTS
        counts, codes = _letters(cleans), coded(cleans)
        depth = np.minimum(counts.max(axis=0), self.counts.max(axis=0))
        ones, market = _unary(counts, depth), _unary(self.counts, depth)
        tiles = np.bitwise_or.reduceat(market, self.tiles, axis=0)
        lengths = np.maximum(codes[2], 1).astype(np.float32)
        own, own_of = np.unique(np.array(sames, object), return_inverse=True)
        most = (100 * w["team"] + w["same_team"] * np.isin(own, self.teams))[own_of]
        held, pairs = [], 0
        for at in range(0, len(cleans), BOUND_ROWS):
            part = slice(at, at + BOUND_ROWS)
            # Most pairs share too few letters for any team, and so do most tiles as a whole.
            needed = self._needed(lengths[part], floors[part] - most[part])
            least = np.min(np.where(self.tile_lengths[:, None], needed.T[:, :, None], np.inf), axis=0)
            open_ = _shared(ones[part, None], tiles[None]) >= least
            found = [self._sharing(ones[part], market, needed, some, open_[some]) for some in _row_parts(open_)]
            row, col, shared = (np.concatenate(x) for x in zip(*found))
            row, col = row + at, self.order[col]
            ts, tm = self._teams(own, own_of[row], col)
            teams = w["team"] * ts + w["same_team"] * tm
            bound = w["name"] * _name_bounds(shared, lengths[row], self.lengths[col]).astype(np.int64) + teams
            held.append([x[bound >= floors[row]] for x in (row, col, bound, ts, tm, teams)])
            pairs += len(held[-1][0])
            if pairs > HELD_PAIRS or at + BOUND_ROWS >= len(cleans):
                yield from self._best(cleans, codes, floors, *map(np.concatenate, zip(*held)))
                held, pairs = [], 0

    def _sharing(self, ones: np.ndarray, market: np.ndarray, needed: np.ndarray, some: slice, open_: np.ndarray) -> tuple:
        """Names, market names of their open tiles in order that share the letters `needed`,
        and how many they share."""
        row, tile = np.nonzero(open_)
        row = np.repeat(row + some.start, TILE_ROWS)
        col = (self.tiles[tile][:, None] + np.arange(TILE_ROWS)).ravel()
        row, col = row[col < len(self.order)], col[col < len(self.order)]
        shared = _shared(ones[row], market[col])
        good = shared >= needed[row, self.length_of[col]]
        return row[good], col[good], shared[good].astype(np.float32)

    def _teams(self, own: np.ndarray, mine: np.ndarray, col: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Points of the teams of each pair, and whether they are one."""
        pair, which = np.unique(mine * len(self.teams) + self.team_of[col], return_inverse=True)
        both = [(own[i], self.teams[j]) for i, j in zip(*divmod(pair, len(self.teams)))]
        points = np.array([_team_points(*x) for x in both], np.int64)
        return points[which], np.array([int(s == t) for s, t in both], np.int64)[which]

    def _best(self, cleans: list[str], codes: tuple, floors: np.ndarray, row, col, bound, ts, tm, teams) -> Iterator[tuple]:
        """Letters are compared for the `FIRST` highest bounds of a name, then for those
        that can still reach the best of these."""
        order = np.lexsort((-bound, row))
        place = np.empty(len(row), np.int64)
        place[order] = np.arange(len(row)) - np.searchsorted(row, row[order])
        top = floors.astype(np.int64)
        ns, score = np.zeros(len(row), np.int64), np.full(len(row), -1, np.int64)
        for turn in (place < FIRST, place >= FIRST):
            at = np.flatnonzero(turn & (bound >= top[row]))
            ns[at] = similarity_points_of(codes, self.codes, row[at], col[at])
            score[at] = config.MATCH_WEIGHTS["name"] * ns[at] + teams[at]
            np.maximum.at(top, row[at], score[at])
        # Ties: the letter-for-letter equal name, then the order of the market names.
        at = np.flatnonzero((score >= top[row]) & (score >= 0))
        unlike = np.array(cleans, object)[row[at]] != self.names[col[at]]
        at = at[np.lexsort((col[at], unlike, row[at]))]
        at = at[np.r_[True, row[at][1:] != row[at][:-1]]] if len(at) else at
        return zip(*(x[at].tolist() for x in (row, col, score, ns, ts, tm)))

    def _needed(self, lengths: np.ndarray, points: np.ndarray) -> np.ndarray:
        """Letters that a name and one of each length must share for so many points."""
        own, own_of = np.unique(lengths, return_inverse=True)
        shared = np.arange(max(own.max(), self.each_length.max()) + 1, dtype=np.float32)
        reached = config.MATCH_WEIGHTS["name"] * _name_bounds(shared, own[:, None, None], self.each_length[:, None])
        return np.stack([(reached[k] < p).sum(axis=1) for k, p in zip(own_of.tolist(), points.tolist())]).astype(np.float32)


def _name_bounds(shared: np.ndarray, n: np.ndarray, m: np.ndarray) -> np.ndarray:
    """Upper bounds in points on the similarity of names of `n` and `m` letters, from the
    letters they share. More letters never lower it."""
    jaro = np.where(shared == 0, np.float32(0), (shared / n + shared / m + np.float32(1)) / np.float32(3))
    boost = PREFIX_SCALE * PREFIX_MAX
    high = np.where(jaro > BOOST_ABOVE - 1e-5, jaro * np.float32(1 - boost) + np.float32(boost), jaro)
    return np.floor(high * np.float32(100) + np.float32(0.5 + 1e-3))


def _by_letters(text: str) -> str:
    """Letters in falling order, so that digits come last."""
    return "".join(sorted(text, reverse=True))


def _letters(texts: list[str]) -> np.ndarray:
    """How often each text holds each letter. Letters outside the cleaned alphabet share
    one slot: a looser bound."""
    slots = len(_LETTERS) + 1
    letters = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), np.uint32)
    slot = _SLOTS[np.minimum(letters, len(_SLOTS) - 1)]
    row = np.repeat(np.arange(len(texts)), [len(t) for t in texts])
    return np.bincount(row * slots + slot, minlength=len(texts) * slots).reshape(-1, slots).astype(np.int32)


def _unary(counts: np.ndarray, depth: np.ndarray) -> np.ndarray:
    """Counts as so many bits, up to the `depth` of each letter: what two such rows have in
    common is the sum of the smaller ones of their counts."""
    slot = np.repeat(np.arange(len(depth)), depth)
    step = np.arange(len(slot)) - np.repeat(np.cumsum(depth) - depth, depth)
    bits = np.zeros((len(counts), max(1, -(-len(slot) // 64)) * 64), bool)
    bits[:, : len(slot)] = counts[:, slot] > step
    return np.packbits(bits, axis=1).view(np.uint64)


def _shared(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Bits that rows have in common."""
    total = np.bitwise_count(a[..., 0] & b[..., 0]).astype(np.uint16)
    for k in range(1, a.shape[-1]):
        total += np.bitwise_count(a[..., k] & b[..., k])
    return total


def _row_parts(open_: np.ndarray) -> Iterator[slice]:
    """Runs of rows with some `HELD_BOUNDS` names in their open tiles."""
    ends, at = np.cumsum(open_.sum(axis=1)) * TILE_ROWS, 0
    while at < len(open_):
        to = int(np.searchsorted(ends, (ends[at - 1] if at else 0) + HELD_BOUNDS, side="right"))
        yield slice(at, max(to, at + 1))
        at = max(to, at + 1)


def accept(
    matches: DataFrame,
    name_above: int = config.NAME_SIMILARITY_ABOVE,
    team_above: int = config.TEAM_SIMILARITY_ABOVE,
) -> DataFrame:
    """The bridge: distinct matches that are near enough in name and team."""
    good = matches.where((F.col("name_sim") > name_above) & (F.col("team_sim") > team_above))
    return good.select(
        surrogate_key(F.col("player_from_players")).alias("canonical_player_key"),
        F.col("player_from_players").alias("canonical_player_name"),
        "player_from_market",
        "player_team",
        "market_team",
        "name_sim",
        "team_sim",
    ).distinct()
