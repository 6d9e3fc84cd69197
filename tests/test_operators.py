import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from touchline.operators import scaling
from touchline.operators.events import clean_events, explode_match, is_live, replay_offsets, route_events
from touchline.operators.matching import accept, best_match, names_with_blocks
from touchline.operators.neighbours import similar_all, similar_to
from touchline.operators.recency import recency_weighted
from touchline.operators.rows import dedup_max
from touchline.operators.scaling import fit, transform
from touchline.operators.standings import standings
from touchline.functions.jaro import similarity_points
from touchline.sources.pages import extract_embedded_json


def test_dedup_fills_gaps(spark):
    df = spark.createDataFrame([("a", 1, None), ("a", None, "x"), ("b", 2, None)], "k string, n int, s string")
    assert sorted(map(tuple, dedup_max(df, ["k"]).collect())) == [("a", 1, "x"), ("b", 2, None)]


def test_recency_weights_are_not_rescaled(spark):
    rows = [("one", 2024, 10.0), ("two", 2024, 10.0), ("two", 2023, None), ("four", 1, 1.0)]
    rows += [("four", y, 1.0) for y in (2, 3, 4)]
    df = spark.createDataFrame(rows, "k string, y int, m double")
    got = dict(map(tuple, recency_weighted(df, "k", [F.col("y").desc_nulls_first()], ["m"]).collect()))
    assert got == pytest.approx({"one": 6.0, "two": 6.0, "four": 1.0})
    scaled = recency_weighted(df, "k", [F.col("y").desc_nulls_first()], ["m"], normalize=True)
    assert dict(map(tuple, scaled.collect())) == pytest.approx({"one": 10.0, "two": 10.0, "four": 1.0})


def test_standings_levels(spark):
    matches = spark.createDataFrame(
        [("A", "B", 1, 1), ("C", "D", 2, 2), ("A", "C", 0, 0)], "home_team string, away_team string, home_goals int, away_goals int"
    )
    table = standings(matches.withColumn("season", F.lit("s"))).orderBy("Pos").collect()
    assert [(r["Pos"], r["team"], r["Pts"], r["GF"]) for r in table] == [
        (1, "C", 2, 2), (2, "A", 2, 1), (3, "D", 1, 2), (4, "B", 1, 1),
    ]


@pytest.mark.parametrize("n", [1, 2, 7, 1000, 5001])
def test_fit_equals_numpy(spark, n):
    rng = np.random.default_rng(n)
    values = np.where(rng.random(n) < 0.4, 3.0, rng.normal(size=n).round(3))
    gaps = rng.random(n) < 0.2
    gaps[0] = False
    rows = [(None if g else float(v), 5.0, None) for v, g in zip(values, gaps)]
    stats = {r["feature"]: r for r in fit(spark.createDataFrame(rows, "a double, b double, c double"), ["a", "b", "c"]).collect()}
    median = np.median(values[~gaps])
    filled = np.where(gaps, median, values)
    assert stats["a"]["median"] == pytest.approx(median, abs=1e-12)
    assert stats["a"]["mean"] == pytest.approx(filled.mean(), abs=1e-12)
    assert stats["a"]["std"] == pytest.approx(filled.std(), abs=1e-9)
    assert (stats["b"]["median"], stats["b"]["std"], stats["c"]["median"]) == (5.0, 0.0, None)


def test_missed_bracket_is_made_good(spark):
    df = spark.createDataFrame([(float(i),) for i in range(101)], "a double")
    assert scaling.exact_medians(df, {"a": 101}, {"a": (90.0, 95.0)}) == {"a": 50.0}


def test_constant_and_missing_features_scale_to_zero(spark):
    df = spark.createDataFrame([(5.0, None), (5.0, None)], "b double, c double")
    vectors = transform(df, fit(df, ["b", "c"]), ["b", "c"]).select("features").collect()
    assert [list(r[0]) for r in vectors] == [[0.0, 0.0], [0.0, 0.0]]


def _pool(seed, n):
    """Copies of one vector for a third of the rows, repeated names, zero rows."""
    rng = np.random.default_rng(seed)
    rows = []
    for i in range(n):
        kind = i % 6
        vec = [1.0, 2.0, 0.5] if kind < 2 else [0.0] * 3 if kind == 2 and i % 4 == 0 else rng.normal(size=3).round(2).tolist()
        name = f"Twin {i % 3}" if kind == 3 else f"p{i}" if i % 10 else f"P{i - 1}"
        rows.append((f"k{i:04d}", name, "GK FW MF DF".split()[int(rng.integers(4))], vec))
    return rows


def _brute(rows, n):
    unit = [np.array(r[3]) / (np.linalg.norm(r[3]) or 1.0) for r in rows]
    first = {}
    for i, r in sorted(enumerate(rows), key=lambda x: x[1][0]):
        first.setdefault(r[1].lower(), i)
    out = set()
    for low, i in first.items():
        scored = sorted(
            (-round(float(unit[i] @ unit[j]) * (1.0 if rows[i][2] == r[2] else 0.75), 12) + 0.0, r[0])
            for j, r in enumerate(rows) if r[1] != rows[i][1]
        )
        out |= {(low, rank + 1, key, round(-s, 9) + 0.0) for rank, (s, key) in enumerate(scored[:n])}
    return out


@pytest.mark.parametrize("n, block", [(150, 4096), (150, 16), (3, 4)])
def test_similar_all_equals_all_pairs(spark, n, block):
    rows = _pool(n, n)
    df = spark.createDataFrame(rows, "player_key string, player_name string, primary_position string, features array<double>")
    got = similar_all(df, 5, block_rows=block).select("name_key", "rank", "match_key", "similarity_score").collect()
    assert {(r[0], r[1], r[2], round(r[3], 9) + 0.0) for r in got} == _brute(rows, 5)


def test_similar_all_deals_each_vector_once(spark, monkeypatch):
    """Vectors that all resemble one another a little: every block visits all others."""
    from touchline.operators import neighbours

    draw = np.random.default_rng(8)
    rows = [(f"k{i:04d}", f"p{i}", "GK FW MF DF".split()[i % 4], draw.normal(size=12).tolist()) for i in range(400)]
    df = spark.createDataFrame(rows, "player_key string, player_name string, primary_position string, features array<double>")
    dealt, listed, deal, shorten = [], [], neighbours.spread_by, neighbours._shortlist
    monkeypatch.setattr(neighbours, "spread_by", lambda d, *keys: dealt.append(d) or deal(d, *keys))
    monkeypatch.setattr(neighbours, "_shortlist", lambda d, *rest: listed.append(d) or shorten(d, *rest))
    got = similar_all(df, 5, block_rows=10).select("name_key", "rank", "match_key", "similarity_score").collect()
    assert {(r[0], r[1], r[2], round(r[3], 9) + 0.0) for r in got} == _brute(rows, 5)
    assert sum(d.count() for d in dealt) == len(rows)
    assert listed[-1].count() <= len(rows) * neighbours.STREAMS * 6


def test_similar_all_lists_rows_that_come_twice_twice(spark):
    draw = np.random.default_rng(10)
    rows = [(i, f"p{i}", "GK", draw.normal(size=3).tolist()) for i in range(40)]
    rows += rows[::4]
    df = spark.createDataFrame(rows, "player_key long, player_name string, primary_position string, features array<double>")
    got = similar_all(df, 5, block_rows=8).select("query_key", "rank", "match_key").collect()
    for target in ("p0", "p1", "p22"):
        want = [r["player_key"] for r in similar_to(df, target, 5).collect()]
        assert [x[2] for x in sorted(got, key=lambda x: x[1]) if x[0] == int(target[1:])] == want


@pytest.mark.parametrize("mismatch", [0.0, -0.5, 1.5])
def test_similar_all_takes_any_penalty(spark, mismatch):
    draw = np.random.default_rng(9)
    rows = [(i, f"p{i}", "GK FW".split()[i % 2], draw.normal(size=3).tolist()) for i in range(60)]
    df = spark.createDataFrame(rows, "player_key long, player_name string, primary_position string, features array<double>")
    got = similar_all(df, 3, mismatch=mismatch, block_rows=8).select("query_key", "rank", "match_key", "similarity_score").collect()
    for r in rows:
        mine = [x for x in similar_to(df, r[1], 3, mismatch=mismatch).collect()] if r[0] % 20 == 0 else None
        if mine:
            want = [(x["player_key"], round(x["similarity_score"], 9)) for x in mine]
            assert [(x[2], round(x[3], 9)) for x in sorted(got, key=lambda x: x[1]) if x[0] == r[0]] == want


def test_similar_to_ignores_case_and_excludes_by_name(spark):
    rows = _pool(5, 60)
    df = spark.createDataFrame(rows, "player_key string, player_name string, primary_position string, features array<double>")
    got = similar_to(df, "TWIN 0", 5).select("player_name", "player_key").collect()
    want = [k for low, _, k, _ in sorted(_brute(rows, 5), key=lambda x: x[1]) if low == "twin 0"]
    assert [r["player_key"] for r in got] == want and "Twin 0" not in {r["player_name"] for r in got}
    assert similar_to(df, "nobody").count() == 0


@pytest.mark.parametrize("chunk", [2000, 5])
def test_best_match_equals_all_pairs(spark, chunk):
    rng = np.random.default_rng(3)
    stems = ["anna", "annie", "anton", "ana maria", "bob", "bo"]
    left = [(f"{rng.choice(stems)}{'' if i % 3 else i}", ["X FC", "Y United", None][i % 3]) for i in range(40)]
    right = [(f"{rng.choice(stems)}{'' if i % 4 else i}", ["x fc", "Y", None, "Z"][i % 4]) for i in range(40)]
    left.append((None, "X FC"))
    sides = [names_with_blocks(spark.createDataFrame(s, "n string, t string"), "n", "t") for s in (left, right)]
    got = {tuple(r) for r in best_match(*sides, chunk_rows=chunk).select(
        "player_from_players", "player_team", "player_from_market", "market_team", "final_score").collect()}
    want = {}
    for n, t in set(left) - {(None, "X FC")}:
        for m, u in set(right):
            if n[:3] == m[:3]:
                a, b = (t or "").lower(), (u or "").lower()
                score = 75 * similarity_points(n, m) + 15 * similarity_points(a, b) + 10 * (a == b)
                rank = (-score, n != m, t is not None, t or "", m, u is not None, u or "")
                if n not in want or rank < want[n][0]:
                    want[n] = (rank, (n, t, m, u, score / 100.0))
    want = {v[1] for v in want.values()}
    assert got == want, (sorted(map(str, got - want))[:3], sorted(map(str, want - got))[:3])


def test_floors_are_reached_and_spare_comparisons(spark, monkeypatch):
    """A name whose counterpart is in the market compares its letters with few others."""
    from touchline.operators import matching

    rows = [(f"red bolt {n * 7919 % 100003:06d}", f"club {n % 5}") for n in range(400)]
    shape = "name string, team string"
    left = names_with_blocks(spark.createDataFrame([(n, "club 9") for n, _ in rows], shape), "name", "team")
    right = names_with_blocks(spark.createDataFrame(rows, shape), "name", "team")
    floors = matching._with_floor(left.select("block", "clean", "same"), right).collect()
    assert len(floors) == 400 and min(r["floor"] for r in floors) >= 7500
    calls = []
    plain = matching.similarity_points
    monkeypatch.setattr(matching, "similarity_points", lambda a, b: calls.append(0) or plain(a, b))
    data = [(r["clean"], r["same"], r["floor"]) for r in floors]
    pdf = pd.DataFrame(data, columns=["clean", "same", "floor"])
    out = matching._best_of_chunk(pdf, right.toPandas())
    assert set(zip(out["p_clean"], out["m_clean"])) == {(n, n) for n, _ in rows}
    assert len(calls) < 400 * 20


def test_points_of_many_pairs_are_those_of_each():
    from touchline.functions.jaro import coded, similarity_points_of

    rng = np.random.default_rng(4)
    texts = ["".join(rng.choice(list("abc é😀"), n)) for n in (0, 1, 2, 3, 5, 8, 17, 40, 90) for _ in range(12)]
    texts += ["large ring 123", "large ring 321", "dwayne", "duane"]
    row, col = (x.ravel() for x in np.meshgrid(np.arange(len(texts)), np.arange(len(texts))))
    got = similarity_points_of(coded(texts), coded(texts), row, col)
    assert got.tolist() == [similarity_points(texts[i], texts[j]) for i, j in zip(row.tolist(), col.tolist())]


def test_names_of_a_hot_block_that_share_too_little_are_bounded_together(spark, monkeypatch):
    """Two thousand names of one block, in kinds of few common letters: most pairs get no
    bound of their own, and the result is that of all pairs."""
    from touchline.operators import matching

    kinds = [f"the {a}{b}" for a in ("jug", "wick", "fox") for b in ("mmm", "zzz", "kkk")]
    names = [f"{kinds[n % 9]} {n:04d}" for n in range(1800)]
    left = pd.DataFrame({"clean": [f"{n}5" for n in names], "same": "x fc", "floor": 8700})
    right = pd.DataFrame({"name": names, "team": "X FC", "clean": names, "same": "x fc"})
    bounded = []
    plain = matching._name_bounds
    monkeypatch.setattr(matching, "_name_bounds", lambda s, n, m: bounded.append(s.size) or plain(s, n, m))
    out = matching._best_of_chunk(left, right)
    assert sum(bounded) < 1800 * 1800 / 4
    found = {r.p_clean: (r.m_clean, r.name_sim) for r in out.itertuples()}
    for n in left["clean"][::90]:
        best = min(names, key=lambda m: (-similarity_points(n, m), m))
        assert found[n] == (best, similarity_points(n, best))


def test_bridge_thresholds(spark):
    df = spark.createDataFrame(
        [("A", "a", "t", "t", 88, 86), ("B", "b", "t", "t", 87, 100), ("C", "c", "t", "t", 100, 85)],
        "player_from_players string, player_from_market string, player_team string, market_team string, name_sim int, team_sim int",
    )
    assert [r["canonical_player_name"] for r in accept(df).collect()] == ["A"]


PAGE = """<script>x = {matchCentreData: {"status":"HT","home":{"teamId":1,"name":"H","players":[{"playerId":10,"name":"Ten"}]},
"away":{"teamId":2,"name":"A","players":[]},"events":[
{"id":1,"minute":3,"second":4,"teamId":1,"playerId":10,"isShot":true,"isGoal":true,"x":"bad","type":{"displayName":"Goal"}},
{"id":2,"teamId":9,"playerId":11,"cardType":{"displayName":"Yellow"},"type":"Card"},
{"id":3,"teamId":2,"playerId":10,"type":{"displayName":"OffsideGiven"}},{"id":4,"teamId":2,"type":{"displayName":"Pass"}}]},
 y: 1}</script>"""


# One line up to the comma that ends the object, as on a match page.
PAGE = PAGE.replace(",\n", ", ").replace("},  y", "},\n y").replace("}, y", "},\n y")


def test_match_document(spark):
    pages = spark.createDataFrame([("u", PAGE), ("v", "<p>none</p>")], "match_url string, html string")
    docs = extract_embedded_json(pages)
    assert [r[0] for r in docs.orderBy("match_url").select(is_live(F.col("doc.status"))).collect()] == [True, False]


def test_clean_and_route(spark):
    pages = spark.createDataFrame([("u", PAGE)], "match_url string, html string")
    events = clean_events(explode_match(extract_embedded_json(pages)))
    got = {r["id"]: r for r in events.collect()}
    assert set(got) == {1, 2}
    assert (got[1]["player_name"], got[1]["team_name"], got[1]["x"], got[1]["second"]) == ("Ten", "H", None, 4.0)
    assert (got[2]["player_name"], got[2]["minute"], got[2]["card_type"], got[2]["is_touch"]) == ("Unknown", 0, True, False)
    assert got[2]["type_display_name"] == "Card"
    routes = sorted((r["id"], r["topic"]) for r in route_events(events).collect())
    assert routes == [(1, "match.events"), (1, "match.goals"), (2, "match.cards"), (2, "match.events")]


def test_replay_over_hours_and_ties(spark):
    rows = [("m", 0, 1), ("m", 0, 2), ("m", 3, 3), ("m", 3700, 4), ("m", 3701, 5), ("n", 9, 6)]
    df = spark.createDataFrame(rows, "m string, c long, id long")
    got = {r["id"]: (r["delay_s"], r["replay_offset_s"]) for r in replay_offsets(df, "m", "c", "id", speed=1.0).collect()}
    assert got == {1: (0, 0), 2: (0, 0), 3: (3, 3), 4: (5, 8), 5: (1, 9), 6: (0, 0)}


def test_stored_index_equals_a_search_of_the_whole_pool(spark, tmp_path):
    import re

    import numpy as np

    from touchline.operators.index import NeighbourIndex
    from touchline.operators.neighbours import similar_to

    draw = np.random.default_rng(4)
    centres = draw.normal(size=(12, 6))
    rows = []
    for k in range(600):
        v = centres[k % 12] + draw.normal(size=6) * 0.05
        role = [None, "GK", "DF"][k % 3]
        rows.append((k, f"name {k // 2}", role, [float(x) for x in (np.round(v, 1) if k % 5 == 0 else v)], "kept"))
    rows += [(1000, "zero", "GK", [0.0] * 6, "kept"), (1001, "Zero", "GK", [0.0] * 6, "kept")]
    pool = spark.createDataFrame(rows, "id long, who string, part string, v array<double>, extra string")
    columns = {"key": "id", "name": "who", "position": "part", "vector": "v"}
    NeighbourIndex.build(pool, str(tmp_path / "index"), **columns, cell_rows=50)
    index = NeighbourIndex(spark, str(tmp_path / "index"))
    seen = []
    for target in ("NAME 3", "name 100", "zero", "name 222"):
        found = index.lookup(target, 7)
        seen.append(index.visited)
        want = similar_to(pool, target, 7, **columns)
        assert set(found.columns) == {"id", "who", "part", "extra", "similarity_score"}
        assert [(r["id"], r["similarity_score"]) for r in found.collect()] == [(r["id"], r["similarity_score"]) for r in want.collect()]
        plan = found._jdf.queryExecution().executedPlan().toString()
        assert re.search(r"PartitionFilters: \[[^\]]*_block", plan)
    assert seen[0][0] < seen[0][1] / 3  # most blocks are not read
    assert index.lookup("nobody").count() == 0


def _all_pairs(left, right):
    """Best of all pairs by score, letter-for-letter equality and place: (place, score, parts)."""
    best = []
    for a, s in left:
        ranked = []
        for j, (b, u) in enumerate(right):
            ns, ts, tm = similarity_points(a, b), similarity_points(s, u), int(s == u)
            ranked.append((-(75 * ns + 15 * ts + 10 * tm), a != b, j, ns, ts, tm))
        score, _, j, ns, ts, tm = min(ranked)
        best.append((j, -score, ns, ts, tm))
    return best


def test_names_near_in_letters_are_the_best_of_all_pairs_or_told_to_be_open():
    from touchline.operators.letters import near_in_letters

    draw = np.random.default_rng(12)
    for trial in range(24):
        letters = list(("ab1", "abcde 0123", "éz9😀")[trial % 3])
        word = lambda: "abc" + "".join(draw.choice(letters, draw.integers(0, (3, 8, 14)[trial % 4 % 3] + 1)))
        names, market = [word() for _ in range(25)] + [""], [word() for _ in range(80)]
        market += ["".join(draw.permutation(list(n))) for n in names[:8]] + [n[:-2] for n in names[8:14]]
        market += [n + "z" for n in names[14:20]] + [""] * (trial % 2)
        teams = ["x fc", "x fd", "y united", ""]
        left = [(n, teams[draw.integers(4)]) for n in names]
        right = [(n, teams[draw.integers(3)]) for n in market]
        got, beyond = near_in_letters(*map(list, zip(*left)), *map(list, zip(*right)))
        for found, other, want in zip(got, beyond, _all_pairs(left, right)):
            assert found == want if found[1] > other else found[1] <= want[1] <= max(found[1], other)


def test_names_of_a_large_block_are_compared_with_few(monkeypatch):
    """Of 4,000 names that differ in digits each is compared with some dozens."""
    from touchline.operators import letters

    draw = np.random.default_rng(13)
    names = [f"blue ring {n}" for n in draw.choice(900_000, 8000, replace=False) + 100_000]
    teams = [f"brand#{n} fc" for n in draw.integers(0, 25, 8000)]
    compared = []
    plain = letters.similarity_points_of
    monkeypatch.setattr(letters, "similarity_points_of", lambda a, b, i, j: compared.append(len(i)) or plain(a, b, i, j))
    got, beyond = letters.near_in_letters(names[:4000], teams[:4000], names[4000:], teams[4000:])
    assert sum(compared) < 4000 * 200
    assert sum(g[1] > b for g, b in zip(got, beyond)) > 400


def test_best_match_of_large_blocks_is_that_of_small_ones(spark, monkeypatch):
    from touchline.operators import matching

    monkeypatch.setattr(matching, "REST_ROWS", (40, 70))
    monkeypatch.setattr(matching, "LEAST_REST_ROWS", 40)
    monkeypatch.setattr(matching, "LETTER_ROWS", (40, 50))
    monkeypatch.setattr(matching, "LEAST_LETTER_ROWS", 40)
    draw = np.random.default_rng(14)
    stems = ["anna", "annie", "blue ring", "blue rod"]
    name = lambda top: f"{stems[draw.integers(4)]} {draw.integers(top)}"
    left = [(name(3000), [f"Brand#{i % 5} FC", None][i % 6 == 0]) for i in range(150)] + [("Ann", "x"), (None, "x")]
    right = [(name(3000), [f"brand#{i % 7} fc", None][i % 5 == 0]) for i in range(200)] + [("ann o'neil ", "x"), ("ann", None)]
    right += right[:20] + [(n.replace("b", "B"), t) for n, t in right[:40]]
    sides = [names_with_blocks(spark.createDataFrame(s, "n string, t string"), "n", "t") for s in (left, right)]
    want = sorted(map(str, best_match(*sides).collect()))
    # One of the two blocks is large.
    assert sorted(map(str, best_match(*sides, large_block=6000).collect())) == want and len(want) > 100
