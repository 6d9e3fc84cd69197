"""Ingestion, the layers from files to recommendations, and the streams."""

import random
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from touchline import config
from touchline.plans import silver
from touchline.plans.medallion import Medallion
from touchline.sources import csv_records, csv_tree
from touchline.sources.tables import align_schema, append_bronze, read_table
from touchline.streaming import live, matches


def _write(path, text, encoding="utf-8"):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_bytes(text if isinstance(text, bytes) else text.encode(encoding))


def test_csv_tree(spark, tmp_path):
    root = tmp_path / "raw data"
    _write(root / "La Liga/Team A+/one.csv", 'Player_Position, Player Name % ,season\nGK," Ann ",2023\nDF,nan,2024\n')
    _write(root / "La Liga/Team B/two.csv", "season,player name,saves\n2023,\"B, ob\",12.0\n")
    _write(root / "La Liga/Team B/bad.csv", b"player name,season\nJos\xe9,2022\n")
    _write(root / "top.csv", "player_name,season\nTop,2021\n")
    _write(root / "La Liga/Team B/empty.csv", "")
    _write(root / "La Liga/Team B/header.csv", "player_name,season\n")
    _write(root / "values.csv", "home,away\nx,y\n")
    files = csv_tree.scan_csv_tree(spark, str(root))
    assert {(r["file_name"], r["league"], r["team"]) for r in files.collect()} >= {
        ("one.csv", "La Liga", "Team A+"), ("top.csv", "UNKNOWN_LEAGUE", "UNKNOWN_TEAM")
    }
    bronze = csv_tree.ingest_csv_tree(spark, str(root), "b1", required=("SEASON",))
    rows = {(r["_TEAM"], r["PLAYER_NAME"], r["SEASON"], r["SAVES"], r["_PLAYER_TYPE"]) for r in bronze.collect()}
    assert rows == {
        ("Team A+", "Ann", "2023", None, "goalkeeper"),
        ("Team A+", None, "2024", None, "goalkeeper"),
        ("Team B", "B, ob", "2023", "12.0", "goalkeeper"),
        ("Team B", "Jos�", "2022", None, "outfield"),
        ("UNKNOWN_TEAM", "Top", "2021", None, "outfield"),
    }
    stats = csv_tree.load_stats(bronze, files).first()
    # Loading nothing: no bytes, a header alone, a required column missing.
    assert (stats["processed"], stats["loaded"], stats["skipped"]) == (4, 5, 3)
    why = csv_tree.check_headers(spark, str(root), files, required=("SEASON",)).where("problem is not null")
    assert {(r["file_name"], r["problem"]) for r in why.collect()} == {("empty.csv", "empty"), ("values.csv", "no column SEASON")}
    table = str(tmp_path / "bronze")
    append_bronze(bronze.select("PLAYER_NAME", "SEASON"), table)
    append_bronze(align_schema(bronze.select("SEASON", "SAVES"), ["PLAYER_NAME", "SEASON"]), table)
    grown = read_table(spark, table, evolved=True)
    assert set(grown.columns) == {"PLAYER_NAME", "SEASON", "SAVES"} and grown.count() == 10
    lower = align_schema(bronze.select(F.col("SEASON").alias("season"), F.lit("x").alias("other")), ["SEASON", "SAVES"])
    assert lower.columns == ["SEASON", "SAVES", "other"]


def test_csv_headers_and_cells_are_whole(spark, tmp_path):
    long = ",".join(f"column with a rather long name {i:05d}" for i in range(2000))
    _write(tmp_path / "r/a/b/long.csv", f"{long}\n{','.join(map(str, range(2000)))}\n")
    _write(tmp_path / "r/a/b/broken.csv", '"two\nlines","x ""y"" "\n"a\nb","\t c \t"\nnan, nan \n')
    rows = csv_tree.ingest_csv_tree(spark, str(tmp_path / "r"), "b").collect()
    assert len(rows) == 3
    wide = next(r for r in rows if r["COLUMN_WITH_A_RATHER_LONG_NAME_01999"] is not None)
    assert [wide[f"COLUMN_WITH_A_RATHER_LONG_NAME_{i:05d}"] for i in (0, 1490, 1999)] == ["0", "1490", "1999"]
    assert {(r["TWO_LINES"], r["X_Y"]) for r in rows if r is not wide} == {("a\nb", "c"), (None, None)}


@pytest.fixture
def small_blocks(spark):
    names = {"spark.sql.files.maxPartitionBytes": "300", "spark.sql.files.openCostInBytes": "1"}
    before = {k: spark.conf.get(k) for k in names}
    for k, v in names.items():
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        spark.conf.set(k, v)


@pytest.mark.parametrize("most", [1000, 0])
def test_quoted_line_breaks_are_read_by_several_tasks(spark, tmp_path, small_blocks, monkeypatch, most):
    monkeypatch.setattr(csv_records, "BROADCAST_BLOCKS", most)
    draw = random.Random(7)
    kinds = {
        "plain": "plain", "": None, '"two\nlines"': "two\nlines", '"a ""q"" b"': 'a "q" b', '5" pipe': '5" pipe', '"x\n\n\ny"': "x\n\n\ny",
        '"' + "long\n" * 60 + '"': "long\n" * 60, '"a,b"': "a,b", "é": "é", '""': None,
    }
    expected = Counter()
    for k, end in enumerate(["\n", "\r\n", "\n"]):
        rows = [[str(i), *draw.choices(list(kinds), k=2)] for i in range(40)]
        text = end.join(['number,"one\nname",other', *map(",".join, rows), "", ""])
        _write(tmp_path / f"r/f{k}.csv", ("\ufeff" if k else "") + text)
        expected.update((i, kinds[b], kinds[c]) for i, b, c in rows)
    open_ended = "4,5\n" + "6,7\n" * 60
    _write(tmp_path / "r/open.csv", f'a,b\n1,2\n3,"never closed\n{open_ended}')
    expected.update([("1", "2", None), ("3", "never closed\n" + open_ended.removesuffix("\n"), None)])
    records = csv_records.csv_records(spark, str(tmp_path / "r"))
    got = csv_records.parsed(records).select(*[F.try_element_at("cells", F.lit(k)) for k in (1, 2, 3)])
    assert Counter(map(tuple, got.collect())) == expected
    # As Spark's own reader has a file that one task must read as a whole.
    whole = spark.read.schema("a string, b string, c string").options(header="true", multiLine="true", escape='"')
    (tmp_path / "one").mkdir()
    (tmp_path / "one/f0.csv").write_bytes((tmp_path / "r/f0.csv").read_bytes())
    own = csv_records.parsed(csv_records.csv_records(spark, str(tmp_path / "one"))).select(*[F.try_element_at("cells", F.lit(k)) for k in (1, 2, 3)])
    assert Counter(map(tuple, own.collect())) == Counter(map(tuple, whole.csv(str(tmp_path / "one")).collect()))
    assert records.where("first").count() == 4
    lines = spark.read.options(**csv_records.SCAN).text(str(tmp_path / "r"))
    assert lines.rdd.getNumPartitions() > 10


def test_lines_end_inside_or_outside_of_cells():
    for line, outside, inside in [
        ("a,b", False, True), ('a,"b"', False, False), ('a,"b', True, False), ('a"b,c', False, False), ('"a""', True, False),
        ('"a"",b"', False, False), ('"a"b"c,"', True, True), ('""', False, True), ('"', True, False), ("", False, True), (',"",', False, True),
    ]:
        assert (csv_records.ends_open(line.encode(), False), csv_records.ends_open(line.encode(), True)) == (outside, inside), line


def test_a_load_counts_what_it_writes(spark, tmp_path):
    for k in range(3):
        _write(tmp_path / f"r/a/b/{k}.csv", "name,n\n" + "x,1\n" * k)
    path = str(tmp_path / "bronze")
    stats = csv_tree.load_csv_tree(spark, str(tmp_path / "r"), path, "b1")
    assert stats == {"batch": "b1", "processed": 2, "skipped": 1, "loaded": 3} and read_table(spark, path).count() == 3


def test_a_file_that_cannot_be_read_ends_the_load(spark, tmp_path):
    _write(tmp_path / "r/a/b/one.csv", "x\n1\n")
    headers = csv_tree.read_headers(spark, str(tmp_path / "r"), csv_tree.scan_csv_tree(spark, str(tmp_path / "r")))
    assert "ignoreCorruptFiles" not in open(csv_tree.__file__).read() and headers.count() == 1


def test_scratch_folder(spark):
    import pytest

    from touchline import session

    class Conf(dict):
        pass

    class Context:
        master, applicationId = "local[2]", "app-1"

    class Plain:
        conf, sparkContext = Conf(), Context()

    assert session.scratch_dir(Plain, "x").startswith(session._LOCAL["app-1"]) and not Plain.conf
    Plain.conf["spark.checkpoint.dir"] = "hdfs://shared/c/"
    assert session.scratch_dir(Plain, "x").startswith("hdfs://shared/c/touchline/x-")
    Plain.conf[session.SCRATCH] = "s3a://other"
    assert session.scratch_dir(Plain, "x").startswith("s3a://other/touchline/x-")
    Plain.conf.clear()
    for master in ("yarn", "spark://host:7077", "local-cluster[2,1,1024]"):
        Context.master = master
        with pytest.raises(ValueError):
            session.scratch_dir(Plain, "x")


def test_recommendations_where_a_key_stands_for_two_names(spark):
    from touchline.operators.neighbours import similar_all
    from touchline.plans import recommend

    features = ["f1", "f2"]
    people = [("k1", "Ann", 1.0, 0.2), ("k1", "ann ", 0.9, 0.3), ("k2", "Bob", 0.1, 1.0), ("k3", "Cy", 0.5, 0.5), ("k3", "Cy", 0.5, 0.5), ("k4", "Di", 0.8, 0.1)]
    mart = spark.createDataFrame(
        [(k, n, "Club", "FW", 20, 1.0, 90.0, a, b) for k, n, a, b in people],
        "player_key string, player_name string, club_name string, primary_position string, age int, "
        "market_value_eur double, minutes_played double, f1 double, f2 double",
    )
    stats = recommend.build_models({"OUT": (mart, features)})["OUT"]
    rows = recommend.recommend({"OUT": (mart.dropDuplicates(), stats, features)}, 5).collect()
    by_target = {}
    for r in rows:
        by_target.setdefault((r["target_player_key"], r["target_player_name"]), []).append(r)
    assert all(len(v) <= 5 and len({(r["predicted_player_key"], r["predicted_player_name"]) for r in v}) == len(v) for v in by_target.values())
    top = similar_all(recommend.scored_pool(mart, stats, features))
    scores = {(r["name_key"], r["match_key"], r["match_name"]): r["similarity_score"] for r in top.collect()}
    for r in rows:
        key = (r["target_player_name"].lower(), r["predicted_player_key"], r["predicted_player_name"])
        assert r["similarity_score"] == scores[key]


def _bronze(spark):
    columns = [
        "player_name", "season", "club", "competition", "_source_file", "club_country", "league_rank",
        "contract_expiry", "weekly_salary", "annual_salary", *config.PLAYER_TEXT, *config.PLAYER_INTS, *config.PLAYER_DOUBLES,
    ]
    people = [("Éder Militão", "DF (CB)"), ("Bob Hart", "FW"), ("Cy Lane", "DF,MF"), ("Al Keep", "GK"), ("Di Keep", " gk "), ("Eve", "GK (x)")]
    rows = []
    for i, (name, position) in enumerate(people):
        for y in range(2020, 2021 + i % 4 + 1):
            row = dict.fromkeys(columns, f"{i + y % 7}.0")
            row.update(
                player_name=name, season=f"{y}-{y + 1}", club="Sevilla", competition="1. La Liga", _source_file="f",
                club_country="esp ESP", contract_expiry="June 2027", player_position=position, current_club="Sevilla",
                goals_per_90=f"{i * (y % 5)}.5", saves=f"{i * y % 11}",
            )
            rows.append(tuple(row[c] for c in columns))
            rows.append(tuple(None if c == "goals_per_90" else row[c] for c in columns))
    rows.append(tuple(None if c == "player_name" else "x" for c in columns))
    return spark.createDataFrame(rows, ", ".join(f"{c} string" for c in columns))


def test_layers_to_recommendations(spark, tmp_path):
    market = spark.createDataFrame(
        [
            ("Eder Militao", "1", "L", "Sevilla", "2023-01-01", "25", "1.5", "2022-2023", "f", None),
            ("Éder Militão", "1", "L", "sevilla", "bad", "25.0", "9.5", "2022-2023", "f", None),
            ("Bob Hart", "2", "L", None, "2023-01-01", "x", "2.5", "2022-2023", "f", None),
            (None, "3", "L", "Z", "2023-01-01", "1", "1", "2022", "f", None),
        ],
        "player_name string, player_id string, league string, club string, date string, age string, "
        "market_value_eur string, season string, _source_file string, _load_timestamp timestamp",
    )
    m = Medallion(_bronze(spark), market, str(tmp_path / "wh"))
    stg = m["stg_players"]
    assert len(stg.columns) == 78
    assert stg.groupBy(*silver.PLAYER_KEYS).count().where("count > 1").count() == 0
    assert stg.where("competition = 'La Liga' AND club_country = 'ESP'").count() == stg.count()
    bridge = [(r["canonical_player_name"], r["player_from_market"]) for r in m["dim_player_bridge"].collect()]
    assert bridge == [("Éder Militão", "Éder Militão")]
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    m["dim_player"]
    for name in ("dim_player", "fact_outfield_stats", "fact_goalkeeper_stats"):
        plan = m.plan(name)._jdf.queryExecution().executedPlan().toString()
        assert "Bucketed: true" in plan and "SortMergeJoin" in plan
        assert not re.search(r"Exchange hashpartitioning\(player_name", plan), name
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    out, keepers = m["mart_similarity_outfield"], m["mart_similarity_goalkeeper"]
    assert len(out.columns) == 24 and len(keepers.columns) == 20
    assert {r["player_name"] for r in keepers.collect()} == {"Al Keep", "Di Keep"}
    values = {r["player_name"]: r["market_value_eur"] for r in out.collect()}
    assert values == {"Éder Militão": 9.5, "Bob Hart": 2.5, "Cy Lane": None, "Eve": None}
    report = m.plan("recommendations").collect()
    by_target = {}
    for r in report:
        by_target.setdefault(r["target_player_name"], []).append(r)
        assert r["predicted_player_name"] != r["target_player_name"]
        assert -1.000001 <= r["similarity_score"] <= 1.000001
    # 'GK (x)' sits in the outfield mart but is routed to keepers: no rows.
    assert set(by_target) == {"Éder Militão", "Bob Hart", "Cy Lane", "Al Keep", "Di Keep"}
    assert {len(by_target[n]) for n in ("Al Keep", "Di Keep")} == {1}


def test_stream_keeps_late_events_and_no_repeats(spark, tmp_path):
    schema = "id long, event_timestamp timestamp, minute int, second float, match_url string, day date"
    src, out, ck = (str(tmp_path / p) for p in ("src", "out", "ck"))
    seen = []

    def feed(*ids):
        rows = spark.createDataFrame([(i,) for i in ids], "id long")
        rows = rows.select("id", F.timestamp_seconds(F.col("id") * 60 + 1_700_000_000).alias("event_timestamp"),
                           F.lit(1).alias("minute"), F.lit(2.0).cast("float").alias("second"), F.lit("u").alias("match_url"))
        rows.withColumn("day", F.to_date("event_timestamp")).coalesce(1).write.mode("append").json(src)

    def drain():
        stream = live.event_source(spark, "json", {"maxFilesPerTrigger": "1"}, schema, src)
        then = lambda new, k: seen.extend(r["id"] for r in new.collect())
        sink = live.insert_ignore(out, layout=("match_url", "minute"), by=("day",), then=then)
        query = live.event_sink(stream, ck, live.run_mode(False), sink)
        query.awaitTermination()
        return live.progress(query)

    feed(1, 2, 2)
    assert drain()["rows"] == 3
    feed(100, 2)
    drain()
    feed(50, 101)  # 50 is seen for the first time long after later ones
    feed(1, 50, 9000)
    drain()
    want = [1, 2, 50, 100, 101, 9000]
    assert sorted(r["id"] for r in read_table(spark, out).collect()) == sorted(seen) == want
    # A batch that is run again after a failure replaces what it wrote.
    again = spark.read.schema(schema).parquet(out).where("batch = 1").drop("batch")
    live.insert_ignore(out, by=("day",))(spark.createDataFrame(again.collect(), schema), 1)
    assert sorted(r["id"] for r in read_table(spark, out).collect()) == want


def test_stream_stops_when_match_is_over(spark, tmp_path):
    src, ck = str(tmp_path / "src"), str(tmp_path / "ck")
    schema = "id long, status string, match_url string"
    spark.createDataFrame([(1, "6", "u")], schema).write.json(src)
    assert live.mode_for(spark.read.json(src), F.col("status")) == {"availableNow": True}
    stream = matches.until_over(live.event_source(spark, "json", None, schema, src), page="id")
    query = live.event_sink(stream, ck, live.run_mode(True, 1), live.insert_ignore(str(tmp_path / "out")))
    matches.wait_until_over(query, spark, ck)
    assert not query.isActive and read_table(spark, str(tmp_path / "out")).count() == 1


def test_messages_round_trip(spark):
    rows = spark.range(3).select(
        "id", F.when(F.col("id") == 1, float("nan")).otherwise(F.lit(1.5)).alias("x"), F.lit(True).alias("is_goal")
    )
    packed = live.encode_events(rows)
    assert {r["key"] for r in packed.collect()} == {"0", "1", "2"}
    assert next(r["value"] for r in packed.collect() if r["key"] == "1") == '{"id":1,"x":null,"is_goal":true}'
    topics = live.encode_events(rows.withColumn("topic", F.lit("t"))).collect()
    assert {(r["topic"], "topic" in r["value"]) for r in topics} == {("t", False)}
    back = {r["id"]: (r["x"], r["is_goal"]) for r in live.decode_events(packed).collect()}
    assert back == {0: (1.5, True), 1: (None, True), 2: (1.5, True)}


def test_feed_of_one_row_group_is_dealt_to_all_tasks(spark, tmp_path):
    """Wide rows are made by many tasks, and a dimension that needs few columns stores no feed."""
    from touchline.catalog import QUERIES, layers, load_all

    load_all()
    home = str(tmp_path)
    tables = {
        "lineitem": spark.range(200).selectExpr(
            "id AS l_orderkey", "id % 5 AS l_partkey", "id % 3 AS l_suppkey", "CAST(id % 5 + 1 AS INT) AS l_linenumber",
            "CAST(1000 + id AS DOUBLE) AS l_extendedprice", "TIMESTAMP '2020-05-01 00:00:00' AS l_shipdate"),
        "part": spark.range(5).selectExpr(
            "id AS p_partkey", "'red bolt' AS p_name", "'Brand#1' AS p_brand", "'SMALL' AS p_type", "CAST(1 AS INT) AS p_size"),
        "supplier": spark.range(3).selectExpr("id AS s_suppkey", "id AS s_nationkey"),
        "nation": spark.range(3).selectExpr("id AS n_nationkey", "'LAND' || id AS n_name", "id AS n_regionkey"),
    }
    for name, rows in tables.items():
        rows.coalesce(1).write.parquet(f"{home}/{name}.parquet")
    feed = layers.bronze_players(spark, home)
    assert feed.count() == 200
    assert feed.select(F.spark_partition_id()).distinct().count() > 1
    found = QUERIES["dim_season"](spark, home).collect()
    assert {r["season"] for r in found} == {"2020-2021", "bad"}
    assert len(QUERIES["dim_club"](spark, home).collect()) == 3
    assert not [k for k in layers._WAREHOUSES if k[1] == home]


def test_facts_and_marts_store_no_wide_table(spark, tmp_path):
    """Facts and marts compute the columns they need; only narrow tables are stored, and the
    rows are those of a warehouse that stores every table."""
    from touchline.catalog import QUERIES, layers, load_all

    load_all()
    home = str(tmp_path)
    tables = {
        "lineitem": spark.range(300).selectExpr(
            "id AS l_orderkey", "id % 30 AS l_partkey", "id % 3 AS l_suppkey", "CAST(id % 5 + 1 AS INT) AS l_linenumber",
            "CAST(1000 + id AS DOUBLE) AS l_extendedprice", "TIMESTAMP '2020-05-01 00:00:00' AS l_shipdate"),
        "part": spark.range(30).selectExpr(
            "id AS p_partkey", "'red bolt' AS p_name", "'Brand#1' AS p_brand",
            "IF(id % 2 = 0, 'ECONOMY', 'SMALL') AS p_type", "CAST(id AS INT) AS p_size"),
        "supplier": spark.range(3).selectExpr("id AS s_suppkey", "id AS s_nationkey"),
        "nation": spark.range(3).selectExpr("id AS n_nationkey", "'LAND' || id AS n_name", "id AS n_regionkey"),
    }
    for name, rows in tables.items():
        rows.coalesce(1).write.parquet(f"{home}/{name}.parquet")
    full = Medallion(layers.bronze_players(spark, home), layers.bronze_market(spark, home), f"{home}/wh")
    for name in ("fact_outfield_stats", "fact_goalkeeper_stats", "mart_similarity_goalkeeper"):
        got = QUERIES[name](spark, home)
        mart = layers.config.GOALKEEPER_MART if name.startswith("mart") else ()
        want = layers.rounded(full.plan(name), mart)
        assert got.count() and got.exceptAll(want).count() == want.exceptAll(got).count() == 0, name
    stored = set(layers.warehouse(spark, home)._stored)
    assert "dim_player" in stored and not stored & set(layers.WIDE)


def test_rows_of_keys_that_come_once_are_not_shuffled(spark, monkeypatch):
    """Marks tell keys that come again; the result is that without marks, also where a bit
    stands for many keys."""
    from touchline import config
    from touchline.operators import rows as ops
    from touchline.plans import silver

    names = ["player_name", "season", "club", "competition", "club_country", "league_rank", "contract_expiry"]
    names += ["weekly_salary", "annual_salary", "_source_file", *config.PLAYER_TEXT, *config.PLAYER_INTS, *config.PLAYER_DOUBLES]
    given = []
    for i in range(120):
        # Every fifth key comes twice, with other gaps; some keys hold nulls.
        k = i if i % 5 else i - i % 10
        key = (f"p{k}" if k % 11 else None, "2023" if k % 7 else None, f"c{k % 3}" if k % 4 else None, f"{k % 2}. L" if k % 6 else None)
        given.append(key + tuple(None if (i + j) % 4 == 0 else str((i * j) % 9) for j in range(len(names) - 4)))
    bronze = spark.createDataFrame(given, ", ".join(f"`{n}` string" for n in names)).repartition(5)
    want = sorted(map(str, silver.stg_players(bronze).collect()))
    for words in (1 << 10, 1):
        monkeypatch.setattr(ops, "MARK_WORDS", words)
        marks = silver.repeated_players(bronze).localCheckpoint()
        assert len(marks.first()["marks"]) == words
        marked = silver.stg_players(bronze, marks)
        assert marked.columns == silver.stg_players(bronze).columns
        assert sorted(map(str, marked.collect())) == want and 60 < len(want) < 110
        again = ops.may_repeat(marks, silver._key_columns())
        keyed = bronze.where("player_name IS NOT NULL AND season IS NOT NULL")
        assert keyed.where(again).count() < keyed.count() or words == 1
