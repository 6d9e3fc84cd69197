"""Match events: the driver's events table in the role of a match feed."""

from __future__ import annotations

from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from touchline import config
from touchline.catalog import derive, query, table
from touchline.catalog.derived import for_duckdb
from touchline.catalog.layers import rounded
from touchline.operators import events as ev
from touchline.operators.joins import unsent, with_lookup
from touchline.session import scratch_dir, spread_by
from touchline.sources.event_log import append_log, read_log
from touchline.sources.pages import extract_embedded_json
from touchline.streaming import live
from touchline.streaming.counters import count_events, totals
from touchline.streaming.matches import until_over

# Events under the names and texts of the feed: junk coordinates, missing flags.
FEED = """SELECT event_id AS id, user_id AS playerId, event_type AS type,
    CASE WHEN event_type = 'view' THEN NULL ELSE event_type = 'purchase' END AS isGoal,
    event_type IN ('purchase', 'click') AS isShot,
    CASE WHEN event_type = 'error' THEN 'yellow' END AS cardType,
    CASE WHEN event_id % 17 = 3 THEN 'off' ELSE CAST(FLOOR(value) AS STRING) END AS x,
    CASE WHEN event_id % 13 = 3 THEN NULL WHEN event_id % 13 = 4 THEN '1e12' ELSE CAST(event_id % 95 AS STRING) END AS minute,
    CASE WHEN event_id % 19 = 3 THEN 'late' ELSE CAST(event_id % 60 AS STRING) END AS second FROM {events}"""
FEED_SQL = for_duckdb(FEED, "events")


def _feed(spark, sf_dir):
    return derive(spark, sf_dir, FEED, "events")


@query(
    "event_clean",
    f"""SELECT id, playerId AS player_id, type AS type_display_name, COALESCE(isGoal, FALSE) AS is_goal, isShot AS is_shot,
        cardType IS NOT NULL AS card_type, FALSE AS is_touch, TRY_CAST(x AS DOUBLE) AS x,
        COALESCE(TRY_CAST(minute AS INTEGER), 0) AS minute, COALESCE(TRY_CAST(second AS DOUBLE), 0) AS second,
        COALESCE(c_name, 'Unknown') AS player_name
    FROM ({FEED_SQL}) LEFT JOIN (SELECT * FROM customer WHERE c_acctbal > 0 AND c_mktsegment <> 'FURNITURE')
        ON playerId = c_custkey WHERE type <> 'signup'""",
)
def _event_clean(spark, sf_dir):
    named = ev.flatten_names(ev.rename_events(_feed(spark, sf_dir)), ("type",))
    clean = ev.drop_noise(ev.coerce_numbers(ev.ensure_flags(named)), noise="signup")
    people = table(spark, sf_dir, "customer").where("c_acctbal > 0 AND c_mktsegment <> 'FURNITURE'")
    return with_lookup(clean, people, "player_id", "c_custkey", "c_name", "player_name")


ROUTES_SQL = f"""SELECT topic, COUNT(*) AS events FROM (SELECT 'match.events' AS topic FROM ({FEED_SQL})
    UNION ALL SELECT CASE WHEN isGoal THEN 'match.goals' WHEN isShot THEN 'match.shots' ELSE 'match.cards' END
        FROM ({FEED_SQL}) WHERE isGoal OR isShot OR cardType IS NOT NULL) GROUP BY 1"""


@query("event_routes", ROUTES_SQL)
def _event_routes(spark, sf_dir):
    return ev.topic_counts(ev.route_events(ev.ensure_flags(ev.rename_events(_feed(spark, sf_dir)))))


STATUSES = """SELECT event_id, CASE event_type WHEN 'view' THEN 'Live now' WHEN 'signup' THEN 'HT' WHEN 'purchase' THEN '2'
    WHEN 'click' THEN '6' END AS status FROM {events}"""


@query(
    "live_filter",
    f"""SELECT event_id, status FROM ({for_duckdb(STATUSES, 'events')})
    WHERE LOWER(status) LIKE '%live%' OR LOWER(status) IN ('1', '2', 'ht')""",
)
def _live_filter(spark, sf_dir):
    return derive(spark, sf_dir, STATUSES, "events").where(ev.is_live(F.col("status")))


@query(
    "unsent_events",
    """SELECT event_id, user_id, event_type FROM events WHERE event_id NOT IN (SELECT event_id FROM events
        WHERE event_type = 'view' OR value > 50)""",
)
def _unsent_events(spark, sf_dir):
    events = table(spark, sf_dir, "events")
    sent = events.where("event_type = 'view' OR value > 50")
    return unsent(events, sent, "event_id").select("event_id", "user_id", "event_type")


SPEED = 600.0


@query(
    "replay_offsets",
    f"""SELECT event_id, user_id, ROUND(delay, 6) AS delay_s,
        ROUND(SUM(delay) OVER (PARTITION BY user_id ORDER BY clock, event_id ROWS UNBOUNDED PRECEDING), 6) AS replay_offset_s
    FROM (SELECT *, GREATEST(0, LEAST(COALESCE(clock - LAG(clock) OVER (PARTITION BY user_id ORDER BY clock, event_id), 0)
            / {SPEED}::DOUBLE, {config.REPLAY_CAP_SECONDS}::DOUBLE)) AS delay
        FROM (SELECT event_id, user_id, CAST(FLOOR(EPOCH(ts)) AS BIGINT) AS clock FROM events
            WHERE event_id % 11 <> 0))
    UNION ALL SELECT event_id, user_id, NULL, NULL FROM events WHERE event_id % 11 = 0""",
)
def _replay_offsets(spark, sf_dir):
    clock = F.when(F.col("event_id") % 11 != 0, F.unix_seconds(F.col("ts").cast("timestamp")))
    rows = table(spark, sf_dir, "events").select("event_id", "user_id", clock.alias("clock"))
    timed = ev.replay_offsets(rows, "user_id", "clock", "event_id", SPEED)
    return rounded(timed.drop("clock"), ("delay_s", "replay_offset_s"))


@query(
    "replay_clock",
    f"""SELECT id, player_id, ROUND(delay, 6) AS delay_s,
        ROUND(SUM(delay) OVER (PARTITION BY player_id ORDER BY clock, id ROWS UNBOUNDED PRECEDING), 6) AS replay_offset_s
    FROM (SELECT *, GREATEST(0, LEAST(COALESCE(clock - LAG(clock) OVER (PARTITION BY player_id ORDER BY clock, id), 0)
            / {config.REPLAY_SPEED}::DOUBLE, {config.REPLAY_CAP_SECONDS}::DOUBLE)) AS delay
        FROM (SELECT id, playerId AS player_id, COALESCE(TRY_CAST(minute AS INTEGER), 0) * 60
            + COALESCE(TRY_CAST(second AS DOUBLE), 0) AS clock FROM ({FEED_SQL})))""",
)
def _replay_clock(spark, sf_dir):
    """Replay by the match clock: minute and second of each cleaned event."""
    events = ev.coerce_numbers(ev.rename_events(_feed(spark, sf_dir)))
    timed = events.select("id", "player_id", ev.clock_seconds().alias("clock"))
    offsets = ev.replay_offsets(timed, "player_id", "clock", "id")
    return rounded(offsets.drop("clock"), ("delay_s", "replay_offset_s"))


# --- pages and payloads -----------------------------------------------------


@query(
    "html_extract",
    r"SELECT page_id, REGEXP_EXTRACT(html, 'track\((\d+)\)', 1) AS status FROM pages",
)
def _html_extract(spark, sf_dir):
    """Each page's tracking call is turned into the match object of a match page,
    then cut out and parsed as one."""
    script = F.regexp_replace("html", r"track\((\d+)\);", 'matchCentreData: {"status": "$1"},\n')
    pages = table(spark, sf_dir, "pages").withColumn("html", script)
    return extract_embedded_json(pages).select("page_id", F.col("doc.status").alias("status"))


# A match page per event, as text: two listed people, of whom one may be the
# event's player, nested display names, and now and then a bare word instead.
MATCH_PAGE = """SELECT event_id, '<script>require.config.params["args"] = {{matchCentreData: {{"status": "'
    || CASE WHEN event_type = 'view' THEN 'live' ELSE '6' END
    || '", "home": {{"teamId": 1, "name": "Home", "players": [{{"playerId": ' || CAST(user_id AS STRING)
    || ', "name": "Player ' || CAST(user_id AS STRING) || '"}}, {{"playerId": 900001, "name": "Keeper"}}]}}'
    || ', "away": {{"teamId": 2, "name": "Away", "players": []}}, "events": [{{"id": ' || CAST(event_id AS STRING)
    || ', "eventId": 7, "minute": ' || CAST(event_id % 95 AS STRING)
    || CASE WHEN event_id % 3 = 0 THEN '' ELSE ', "second": ' || CAST(event_id % 60 AS STRING) END
    || ', "teamId": ' || CAST(1 + event_id % 3 AS STRING)
    || CASE WHEN event_id % 7 = 3 THEN '' ELSE ', "playerId": ' || CAST(user_id + event_id % 2 AS STRING) END
    || CASE WHEN event_type = 'purchase' THEN ', "isGoal": true, "isShot": true' ELSE '' END
    || CASE WHEN event_type = 'error' THEN ', "cardType": {{"displayName": "Yellow"}}' ELSE '' END
    || ', "type": {{"displayName": "' || CASE WHEN event_type = 'click' THEN 'OffsideGiven' ELSE event_type END || '"}}'
    || ', "outcomeType": ' || CASE WHEN event_id % 5 = 0 THEN '"none"' ELSE '{{"displayName": "Successful"}}' END
    || '}}]}},' || CHR(10) || ' matchId: 3}}</script>' AS html FROM {events}"""


def _match_events(spark, sf_dir):
    pages = derive(spark, sf_dir, MATCH_PAGE, "events")
    docs = extract_embedded_json(pages).withColumn("match_url", F.lit("https://example.org/match"))
    return ev.clean_events(ev.explode_match(docs))


@query(
    "match_pages",
    """SELECT event_id AS id, user_id + event_id % 2 AS player_id, 1 + event_id % 3 AS team_id,
        CASE WHEN event_id % 2 = 0 THEN 'Player ' || CAST(user_id AS VARCHAR) ELSE 'Unknown' END AS player_name,
        CASE event_id % 3 WHEN 0 THEN 'Home' WHEN 1 THEN 'Away' ELSE 'Unknown' END AS team_name,
        event_type AS type_display_name,
        CASE WHEN event_id % 5 = 0 THEN 'none' ELSE 'Successful' END AS outcome_type_display_name,
        event_type = 'purchase' AS is_goal, event_type = 'purchase' AS is_shot, event_type = 'error' AS card_type,
        CAST(event_id % 95 AS INTEGER) AS minute,
        CASE WHEN event_id % 3 = 0 THEN 0 ELSE event_id % 60 END::DOUBLE AS second,
        event_type = 'view' AS live
    FROM events WHERE event_type <> 'click' AND event_id % 7 <> 3""",
)
def _match_pages(spark, sf_dir):
    return _match_events(spark, sf_dir).select(
        "id", "player_id", "team_id", "player_name", "team_name", "type_display_name",
        "outcome_type_display_name", "is_goal", "is_shot", "card_type", "minute", "second",
        ev.is_live(F.col("status")).alias("live"),
    )


@query(
    "json_payload",
    """SELECT event_id, CAST(JSON_EXTRACT(props, '$.k') AS INTEGER) AS k,
        '{"id":' || event_id || ',"event_type":"' || event_type || '","k":' || CAST(JSON_EXTRACT(props, '$.k') AS VARCHAR) || '}'
        AS payload, event_type AS name FROM events""",
)
def _json_payload(spark, sf_dir):
    """Unpack, pack as a keyed message, and read a name back out of it."""
    k = F.from_json("props", "k int")["k"]
    rows = table(spark, sf_dir, "events").select(F.col("event_id").alias("id"), "event_type", k.alias("k"))
    packed = live.encode_events(rows)
    return packed.select(
        F.col("key").cast("bigint").alias("event_id"),
        F.get_json_object("value", "$.k").cast("int").alias("k"),
        F.col("value").alias("payload"),
        F.get_json_object("value", "$.event_type").alias("name"),
    )


# --- streams ----------------------------------------------------------------


def _arrivals(spark, sf_dir, events):
    """Events as a stream of about four batches, each of as many files as there are
    shuffle partitions. The first three hold a third of the ids each, so two of every
    three events come hours after later ones; the last brings back half of all, as do
    repeats within each."""
    home = scratch_dir(spark, "arrivals")
    again = events.where("id % 2 = 0")
    parts = [events.where(f"id % 3 = {k}") for k in (2, 0, 1)] + [again]
    for k, part in enumerate(parts):
        spread_by(part.unionByName(part.where("id % 5 = 1")), "id").write.parquet(f"{home}/part={k}")
    options = {"maxFilesPerTrigger": spark.conf.get("spark.sql.shuffle.partitions")}
    return live.event_source(spark, "parquet", options, events.schema, f"{home}/part=*")


def _feed_events(spark, sf_dir):
    return table(spark, sf_dir, "events").select(
        F.col("event_id").alias("id"),
        F.col("user_id").alias("player_id"),
        F.col("event_type").alias("type_display_name"),
        (F.col("event_type") == "purchase").alias("is_goal"),
        F.col("event_type").isin("purchase", "click").alias("is_shot"),
        (F.col("event_type") == "error").alias("card_type"),
        F.col("value").cast("float").alias("x"),
        (F.col("event_id") % 95).cast("int").alias("minute"),
        F.lit("https://example.org/match").alias("match_url"),
        F.col("ts").cast("timestamp").alias("event_timestamp"),
    )


@query(
    "stream_dedup",
    """SELECT event_id AS id, user_id AS player_id, event_type AS type_display_name, event_type = 'purchase' AS is_goal,
        CAST(event_id % 95 AS INTEGER) AS minute, ROUND(CAST(CAST(value AS FLOAT) AS DOUBLE), 4) AS x FROM events""",
)
def _stream_dedup(spark, sf_dir):
    """Messages are packed, read back as the event table's columns and appended to
    the table, which is partitioned by day and takes no id twice."""
    home = scratch_dir(spark, "live")
    events = live.decode_events(live.encode_events(_arrivals(spark, sf_dir, _feed_events(spark, sf_dir))))
    daily = events.withColumn("day", F.to_date("event_timestamp"))
    sink = live.insert_ignore(f"{home}/table", layout=("match_url", "minute", "second"), by=("day",))
    live.event_sink(daily, f"{home}/checkpoint", live.run_mode(live=False), sink).awaitTermination()
    stored = live.read_sink(spark, f"{home}/table", config.LIVE_EVENT_DDL)
    return stored.select(
        "id", "player_id", "type_display_name", "is_goal", "minute",
        F.round(F.col("x").cast("double"), 4).alias("x"),
    )


@query("stream_routes", ROUTES_SQL)
def _stream_routes(spark, sf_dir):
    """New events go to their topics; what the table knew already goes nowhere."""
    home = scratch_dir(spark, "routes")
    events = ev.ensure_flags(_arrivals(spark, sf_dir, _feed_events(spark, sf_dir)))
    routes = live.write_routes(f"{home}/topics")
    sink = live.insert_ignore(f"{home}/table", then=lambda new, k: routes(ev.route_events(new), k))
    live.event_sink(events, f"{home}/checkpoint", live.run_mode(live=False), sink).awaitTermination()
    return ev.topic_counts(spark.read.parquet(f"{home}/topics"))


@query(
    "stream_match",
    """WITH e AS (SELECT event_id AS id, user_id + event_id % 2 AS player_id, 1 + event_id % 3 AS team_id,
        CASE WHEN event_id % 2 = 0 THEN 'Player ' || CAST(user_id AS VARCHAR) ELSE 'Unknown' END AS player_name,
        CASE event_id % 3 WHEN 0 THEN 'Home' WHEN 1 THEN 'Away' ELSE 'Unknown' END AS team_name,
        event_type AS type_display_name, CASE WHEN event_id % 5 = 0 THEN 'none' ELSE 'Successful' END AS outcome_type_display_name,
        event_type = 'purchase' AS is_goal, event_type = 'purchase' AS is_shot, event_type = 'error' AS card_type,
        CAST(event_id % 95 AS INTEGER) AS minute, CAST(CASE WHEN event_id % 3 = 0 THEN 0 ELSE event_id % 60 END AS DOUBLE) AS second
        FROM events WHERE event_type <> 'click' AND event_id % 7 <> 3)
    SELECT topic, e.*, 7::BIGINT AS event_id, FALSE AS is_touch, NULL::DOUBLE AS x, NULL::DOUBLE AS y, NULL::DOUBLE AS end_x,
        NULL::DOUBLE AS end_y, NULL::VARCHAR AS period_display_name, 'https://example.org/match' AS match_url, TRUE AS stamped
    FROM e, (VALUES ('match.events'), ('special')) t(kind), LATERAL (SELECT CASE WHEN kind = 'match.events' THEN kind
        WHEN is_goal THEN 'match.goals' WHEN is_shot THEN 'match.shots' WHEN card_type THEN 'match.cards' END AS topic) WHERE topic IS NOT NULL""",
)
def _stream_match(spark, sf_dir):
    """Match pages to messages on topics, in one stream: pages are parsed, cleaned,
    stamped, stored once, routed and packed. All columns of the event table."""
    home = scratch_dir(spark, "match")
    pages = derive(spark, sf_dir, MATCH_PAGE, "events")
    pages.unionByName(pages.where("event_id % 4 = 1")).write.parquet(f"{home}/pages")
    stream = live.event_source(spark, "parquet", None, pages.schema, f"{home}/pages")
    docs = extract_embedded_json(stream).withColumn("match_url", F.lit("https://example.org/match"))
    events = ev.stamp(ev.clean_events(ev.explode_match(docs)), F.col("match_url"))
    kept = [c.split()[0] for c in config.LIVE_EVENT_DDL.split(",")]
    events = events.select(*[F.col(c) if c in events.columns else F.lit(None).alias(c) for c in kept])
    routes = live.write_routes(f"{home}/topics")
    sink = live.insert_ignore(
        f"{home}/table", by=("match_url",), then=lambda new, k: routes(live.encode_events(ev.route_events(new)), k)
    )
    live.event_sink(events, f"{home}/checkpoint", live.run_mode(live=False), sink).awaitTermination()
    sent = spark.read.parquet(f"{home}/topics")
    parsed = sent.select("topic", F.from_json("value", config.LIVE_EVENT_DDL).alias("e")).select("topic", "e.*")
    numbers = {c: F.col(c).cast("double") for c in ("second", "x", "y", "end_x", "end_y")}
    stamped = F.col("event_timestamp").isNotNull().alias("stamped")
    return parsed.withColumns(numbers).select("topic", *[c for c in kept if c != "event_timestamp"], stamped)


@query(
    "stream_match_end",
    """WITH p AS (SELECT 'https://example.org/match/' || CAST(user_id % 40 AS VARCHAR) AS match_url, event_id AS page,
        event_type AS doc, event_type = 'error' AND event_id % 7 = 3 AS ends FROM events),
    e AS (SELECT match_url, MIN(page) FILTER (ends) AS last FROM p GROUP BY 1)
    SELECT match_url, page, doc, COALESCE(page = last, FALSE) AS last_page FROM p JOIN e USING (match_url)
    WHERE last IS NULL OR page <= last""",
)
def _stream_match_end(spark, sf_dir):
    """Forty matches polled over three runs of one query, each match up to the page that
    ends it; runs after the first know from the checkpoint which are over."""
    home = scratch_dir(spark, "match-end")
    ends = (F.col("event_type") == "error") & (F.col("event_id") % 7 == 3)
    pages = table(spark, sf_dir, "events").select(
        F.concat(F.lit("https://example.org/match/"), (F.col("user_id") % 40).cast("string")).alias("match_url"),
        F.col("event_id").alias("page"), F.when(ends, "6").otherwise("live").alias("status"), F.col("event_type").alias("doc"),
    )
    last = pages.agg(F.max("page")).first()[0] or 0
    cuts = [-1, last // 3, 2 * last // 3, last]
    for a, b in zip(cuts, cuts[1:]):
        part = pages.where((F.col("page") > a) & (F.col("page") <= b))
        spread_by(part, "page").write.mode("append").parquet(f"{home}/pages")
        stream = until_over(live.event_source(spark, "parquet", None, pages.schema, f"{home}/pages"))
        sink = live.insert_ignore(f"{home}/table", key="page")
        live.event_sink(stream, f"{home}/checkpoint", live.run_mode(live=False), sink).awaitTermination()
    stored = live.read_sink(spark, f"{home}/table", "match_url string, page long, doc string, last boolean")
    return stored.select("match_url", "page", "doc", F.col("last").alias("last_page"))


@query(
    "stream_counts",
    """SELECT 'events' AS kind, COUNT(*) AS n FROM events UNION ALL SELECT 'goals', COUNT(*) FROM events WHERE event_type = 'purchase'
    UNION ALL SELECT 'shots', COUNT(*) FROM events WHERE event_type = 'click'
    UNION ALL SELECT 'cards', COUNT(*) FROM events WHERE event_type = 'error'""",
)
def _stream_counts(spark, sf_dir):
    """What a stream has sent, observed as it passes and summed over all its batches."""
    home = scratch_dir(spark, "counts")
    events = _feed_events(spark, sf_dir)
    spread_by(events, "id").write.parquet(f"{home}/events")
    stream = count_events(live.event_source(spark, "parquet", {"maxFilesPerTrigger": "3"}, events.schema, f"{home}/events"))
    counts = totals(spark)
    query_ = live.event_sink(stream, f"{home}/checkpoint", live.run_mode(live=False), fmt="noop")
    query_.awaitTermination()
    sent = counts.of(query_)["observed"].get("sent", {})
    return spark.createDataFrame([(k, sent.get(k, 0)) for k in ("events", "goals", "shots", "cards")], "kind string, n long")


@query(
    "stream_offsets",
    """SELECT event_id AS id, CAST(event_id % 8 AS INTEGER) AS log_partition,
        ROW_NUMBER() OVER (PARTITION BY event_id % 8 ORDER BY CASE WHEN event_id % 3 = 0 THEN 1 ELSE 0 END, event_id) - 1 AS log_offset
    FROM events""",
)
def _stream_offsets(spark, sf_dir):
    """Messages of a log by partition and offset. The second run of the query is lost after
    its write, before it is committed; the next one reads the same offsets again."""
    home = scratch_dir(spark, "offsets")
    rows = table(spark, sf_dir, "events").select(F.col("event_id").alias("id"), F.col("event_type"))
    messages = live.encode_events(rows).withColumn("at", F.col("key").cast("long"))
    sink, lost = live.insert_ignore(f"{home}/table", key="key"), {"runs": 0}

    def write(batch, batch_id):
        sink(batch, batch_id)
        lost["runs"] += 1
        if lost["runs"] == 2:
            raise RuntimeError("a run that is lost")

    def run():
        live.event_sink(read_log(spark, f"{home}/log"), f"{home}/checkpoint", live.run_mode(live=False), write).awaitTermination()

    append_log(messages.where("at % 3 <> 0"), f"{home}/log", "at")
    run()
    append_log(messages.where("at % 3 = 0"), f"{home}/log", "at")
    try:
        run()
    except StreamingQueryException as failed:
        if "a run that is lost" not in str(failed):
            raise
    run()
    stored = live.read_sink(spark, f"{home}/table", "key string, partition int, offset long")
    return stored.select(F.col("key").cast("long").alias("id"), F.col("partition").alias("log_partition"), F.col("offset").alias("log_offset"))
