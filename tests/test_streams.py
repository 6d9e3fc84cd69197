"""Streams that last: the keyed sink, ends of matches, counters and offsets."""

import os
import subprocess
import sys
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from touchline.streaming.keyed import KeyedSink


def _held(spark, path, schema="id long, v long"):
    return sorted(r["id"] for r in spark.read.schema(schema).parquet(path).collect())


def test_keyed_sink_opens_few_runs_after_many_batches(spark, tmp_path):
    path = str(tmp_path / "table")
    sink = KeyedSink(path, fan_out=3)
    batches = 27
    for k in range(batches):
        # Ten new keys, one of the batch before, and now and then one of long ago.
        ids = [*range(10 * k, 10 * k + 10), 10 * k - 1, *([3 * k] if k % 7 == 0 else [])]
        sink(spark.createDataFrame([(i, k) for i in ids if i >= 0], "id long, v long").coalesce(1), k)
    assert _held(spark, path) == list(range(10 * batches))
    assert max(x.of_runs for x in sink.lookups) <= 2 * 4  # (fan_out - 1) a level
    assert max(x.runs for x in sink.lookups) <= 3
    kept = {p.name for p in (tmp_path / "table" / "_keys").iterdir() if p.is_dir()}
    assert len(kept) <= 2 * 4 + 3 * 3 + 2  # live runs, those just merged, two manifests


@pytest.mark.parametrize("few", [1000, 2])
def test_keyed_sink_runs_a_batch_again_and_finds_late_keys(spark, tmp_path, few):
    path = str(tmp_path / "table")
    frame = lambda *ids: spark.createDataFrame([(i, 0) for i in ids], "id long, v long")
    ids = [[5, 5, 7, None, None], [-(2**62), 2**62, 7], [6, 5, 2**62, 100], [], [100, 6, 8, 9]]
    for k, own in enumerate(ids):
        sink = KeyedSink(path, fan_out=2, few=few, file_rows=2)  # a new one for each: no memory of its own
        sink(frame(*own), k)
        sink(frame(*own), k)
    got = [r["id"] for r in spark.read.schema("id long, v long").parquet(path).collect()]
    assert sorted(i for i in got if i is not None) == [-(2**62), 5, 6, 7, 8, 9, 100, 2**62] and got.count(None) == 1
    # Without its index the table is read once to make it anew.
    KeyedSink(str(tmp_path / "other"), few=few)(frame(1, 2), 0)
    (tmp_path / "other" / "_keys").rename(tmp_path / "lost")
    sink = KeyedSink(str(tmp_path / "other"), few=few)
    sink(frame(2, 3), 1)
    assert _held(spark, str(tmp_path / "other")) == [1, 2, 3] and sink.lookups[0].of_runs == 1


def test_keyed_sink_writes_parts_from_few_tasks_and_reads_a_batch_once(spark, tmp_path):
    """Before, each task wrote a file for every day, and a batch with repeats was kept whole."""
    path, off = tmp_path / "table", "spark.sql.adaptive.coalescePartitions.enabled"
    rows = [(i % 4000, i % 20, i % 95) for i in range(6000)]
    batch = spark.createDataFrame(rows, "id long, day int, minute int")
    kept = []
    sink = KeyedSink(str(path), layout=("minute",), by=("day",))
    known = sink._known
    sink._known = lambda b, *rest: kept.append(b.count()) or known(b, *rest)
    spark.conf.set(off, "false")
    try:
        sink(batch, 0)
        sink(batch.withColumn("id", F.col("id") + 2000), 1)
    finally:
        spark.conf.unset(off)
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    assert kept == [4000, 4000]
    for k in (0, 1):
        assert len(list((path / f"batch={k}").rglob("*.parquet"))) < 20 + tasks
    assert sorted(r["id"] for r in spark.read.parquet(str(path)).collect()) == list(range(6000))


def test_messages_are_packed_and_parsed_once(spark):
    from touchline.streaming import live

    events = spark.range(3).selectExpr("id", "CAST(id AS INT) AS minute", "CAST('NaN' AS FLOAT) AS x")
    decoded = live.decode_events(live.encode_events(events))
    plan = decoded._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("from_json") == 1
    assert [(r["id"], r["minute"], r["x"], r["team_name"]) for r in decoded.orderBy("id").collect()] == [(k, k, None, None) for k in range(3)]
    odd = ["{bad", None, "null", '{"minute": 1}', '{"id": "x"}', '{"id": 7, "minute": "x"}']
    messages = spark.createDataFrame([(v,) for v in odd], "value string")
    assert [(r["id"], r["minute"]) for r in live.decode_events(messages).collect()] == [(7, None)]


def test_keyed_sink_takes_text_keys(spark, tmp_path):
    path = str(tmp_path / "table")
    sink = KeyedSink(path, key="name", few=1)
    for k, names in enumerate([["b", "é", "a"], ["é", "c", "A"], ["漢", "a"]]):
        sink(spark.createDataFrame([(n,) for n in names], "name string"), k)
    got = sorted(r["name"] for r in spark.read.schema("name string").parquet(path).collect())
    assert got == sorted(["A", "a", "b", "c", "é", "漢"])


def _pages(spark, path, rows):
    schema = "match_url string, page long, status string, doc string"
    spark.createDataFrame([(m, p, s, f"{m}-{p}") for m, p, s in rows], schema).coalesce(1).write.mode("append").parquet(path)
    return schema


def test_matches_end_one_by_one_and_stay_ended(spark, tmp_path):
    from touchline.streaming import live
    from touchline.streaming.matches import match_states, until_over, wait_until_over

    src, out, ck = (str(tmp_path / p) for p in ("src", "out", "ck"))

    def start(trigger):
        pages = live.event_source(spark, "parquet", {"maxFilesPerTrigger": "1"}, schema, src)
        return live.event_sink(until_over(pages), ck, trigger, KeyedSink(out, key="doc"))

    schema = _pages(spark, src, [("a", 1, "live"), ("a", 3, "6"), ("a", 4, "live"), ("b", 1, "1"), (None, 1, "live")])
    start(live.run_mode(False)).awaitTermination()
    _pages(spark, src, [("a", 5, "live"), ("a", 2, "live"), ("b", 2, "HT"), ("c", 9, None)])  # a is over, though 2 comes late
    start(live.run_mode(False)).awaitTermination()
    states = {r["match_url"]: (r["taken"], r["over"], r["last"]) for r in match_states(spark, ck).collect()}
    assert states == {"a": (3, True, 3), "b": (2, False, None), "c": (1, True, 9)}
    query = start(live.run_mode(True, 1))
    _pages(spark, src, [("b", 3, "2"), ("b", 4, "6"), ("b", 5, "6")])
    wait_until_over(query, spark, ck)
    assert not query.isActive
    stored = spark.read.schema("doc string, last boolean").parquet(out).collect()
    assert {(r["doc"], r["last"]) for r in stored} == {
        ("a-1", False), ("a-2", False), ("a-3", True), ("b-1", False), ("b-2", False), ("b-3", False), ("b-4", True), ("c-9", True),
    }
    assert len(stored) == 8


PLAIN = """
import sys
sys.path.insert(0, sys.argv[1])
from pyspark.sql import SparkSession
home = sys.argv[2]
spark = SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false").config(
    "spark.sql.shuffle.partitions", "2").config("spark.checkpoint.dir", home).getOrCreate()
rows = [(k, u, "error" if k == 10 else "view") for u in range(2) for k in range(u * 7, u * 7 + 6)]
spark.createDataFrame(rows, "event_id long, user_id long, event_type string").coalesce(1).write.parquet(home + "/events.parquet")
from touchline import catalog
catalog.load_all()
found = catalog.QUERIES["stream_match_end"](spark, home).collect()
print("pages", sorted((r["page"], r["last_page"]) for r in found))
"""


def test_matches_end_in_a_session_that_is_not_the_librarys_own(tmp_path):
    """The state store is Spark's default one, and no process but the driver finds the package by itself."""
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    run = [sys.executable, "-c", PLAIN, str(Path(__file__).resolve().parents[1]), str(tmp_path)]
    done = subprocess.run(run, env=env, cwd=tmp_path, capture_output=True, text=True, timeout=300)
    expected = [(k, False) for k in range(6)] + [(k, k == 10) for k in range(7, 11)]
    assert f"pages {expected}" in done.stdout, done.stderr[-3000:]


def test_counts_hold_over_more_batches_than_reports_are_kept(spark, tmp_path):
    from touchline.streaming import live
    from touchline.streaming.counters import count_events, totals

    src, ck = str(tmp_path / "src"), str(tmp_path / "ck")
    rows = spark.range(120).select("id", (F.col("id") % 3 == 0).alias("is_goal"), (F.col("id") % 2 == 0).alias("is_shot"), (F.col("id") % 5 == 0).alias("card_type"))
    rows.repartition(120).write.option("maxRecordsPerFile", 1).parquet(src)
    listening = totals(spark)
    stream = count_events(live.event_source(spark, "parquet", {"maxFilesPerTrigger": "1"}, rows.schema, src))
    query = live.event_sink(stream, ck, live.run_mode(False), fmt="noop")
    query.awaitTermination()
    assert len(query.recentProgress) <= 100
    own = listening.of(query)
    files = len(list((tmp_path / "src").glob("*.parquet")))
    assert files > 100 and own["batches"] == files and own["rows"] == 120
    assert own["observed"]["sent"] == {"events": 120, "goals": 40, "shots": 40, "cards": 8}
    assert live.progress(query) == {"batches": files, "rows": 120}


def test_a_query_that_fails_reads_the_same_offsets_again(spark, tmp_path):
    from touchline.sources.event_log import append_log, offsets_of, read_log
    from touchline.streaming import live

    log, out, ck = (str(tmp_path / p) for p in ("log", "out", "ck"))
    frame = lambda a, b: spark.range(a, b).select(F.col("id").cast("string").alias("key"), F.concat(F.lit("v"), "id").alias("value"), "id")
    assert append_log(frame(0, 50), log, "id", 4) == 1
    sink, failing, ranges = KeyedSink(out, key="key"), {"yes": False}, []

    def write(batch, batch_id):
        ranges.append((batch_id, sorted((r["partition"], r["offset"]) for r in batch.collect())))
        sink(batch, batch_id)
        if failing["yes"]:
            raise RuntimeError("lost after the write")

    def run():
        query = live.event_sink(read_log(spark, log), ck, live.run_mode(False), write)
        query.awaitTermination()

    run()
    append_log(frame(50, 80), log, "id", 4)
    failing["yes"] = True
    with pytest.raises(Exception, match="lost after the write"):
        run()
    append_log(frame(70, 90), log, "id", 4)  # comes after the failed batch was planned; repeats some keys
    failing["yes"] = False
    run()  # the planned batch, and no more in a run of what is available
    run()
    assert [k for k, _ in ranges] == [0, 1, 1, 2]
    assert ranges[1][1] == ranges[2][1]  # the same range, whatever came since
    seen = [x for k, (_, rows) in enumerate(ranges) if k != 1 for x in rows]
    assert sorted(seen) == sorted({x for x in seen}) and len(seen) == 100
    stored = spark.read.schema("key string, partition int, offset long").parquet(out).collect()
    assert sorted(int(r["key"]) for r in stored) == list(range(90))
    assert all(int(r["key"]) % 4 == r["partition"] for r in stored)
    for p in range(4):  # offsets of a partition follow its keys
        own = sorted((r["offset"], int(r["key"])) for r in stored if r["partition"] == p)
        assert [k for _, k in own] == sorted(k for _, k in own)
    assert offsets_of(spark, ck, 2) == {str(p): 25 for p in range(4)}
    assert spark.read.format("event_log").load(log).count() == 100
