"""Match events: flattening, cleaning, routing, replay clock.

Everything here but `replay_offsets` is stateless and works alike on a batch
and on a stream.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from touchline import config
from touchline.functions.casting import nan_to_null


def is_live(status: Column) -> Column:
    """A match is on while its status says so or names a running period."""
    text = F.lower(F.coalesce(status.cast("string"), F.lit("")))
    return text.contains("live") | text.isin(*config.LIVE_STATUSES)


def display_name(c: Column) -> Column:
    """`displayName` of a JSON object held as text; any other text as it is."""
    return F.coalesce(F.get_json_object(c, "$.displayName"), c)


def explode_match(docs: DataFrame, doc: str = "doc", match: str = "match_url") -> DataFrame:
    """One row per event of each match document, with team and player names.

    Names come from the same document, so they are looked up within the row: no
    join and no shuffle. The last listing of an id counts.
    """
    side = {s: F.col(f"{doc}.{s}") for s in ("home", "away")}
    listed = [F.coalesce(F.col(f"{doc}.{s}.players"), F.array()) for s in side]
    people = F.concat(*listed)
    teams = F.array(*[F.struct(c["teamId"].alias("id"), c["name"].alias("name")) for c in side.values()])
    rows = docs.select(
        match,
        F.col(f"{doc}.status").alias("status"),
        people.alias("_people"),
        teams.alias("_teams"),
        F.explode(f"{doc}.events").alias("_e"),
    )
    player = F.filter("_people", lambda p: p["playerId"] == F.col("_e.playerId"))
    team = F.filter("_teams", lambda t: t["id"] == F.col("_e.teamId"))
    return rows.select(
        match,
        "status",
        "_e.*",
        F.coalesce(F.try_element_at(player, F.lit(-1))["name"], F.lit("Unknown")).alias("player_name"),
        F.coalesce(F.try_element_at(team, F.lit(-1))["name"], F.lit("Unknown")).alias("team_name"),
    )


def rename_events(df: DataFrame, names: Mapping[str, str] = config.EVENT_RENAMES) -> DataFrame:
    return df.withColumnsRenamed(dict(names))


def flatten_names(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Replace each nested column by its display name."""
    for c in columns:
        if c in df.columns:
            df = df.withColumn(f"{c}_display_name", display_name(F.col(c))).drop(c)
    return df


def ensure_flags(df: DataFrame, flags: Sequence[str] = config.EVENT_FLAGS) -> DataFrame:
    """Flag columns exist and hold true or false. A flag that is no boolean, such
    as a card, is true where anything is present."""
    kinds = dict(df.dtypes)
    made = {}
    for flag in flags:
        if flag not in kinds:
            made[flag] = F.lit(False)
        elif kinds[flag] == "boolean":
            made[flag] = F.coalesce(F.col(flag), F.lit(False))
        else:
            made[flag] = F.col(flag).isNotNull()
    return df.withColumns(made)


def coerce_numbers(
    df: DataFrame, columns: Sequence[str] = config.EVENT_NUMBERS, zeros: Sequence[str] = ("minute", "second")
) -> DataFrame:
    """Numbers where the text is one, else null; clock columns default to 0."""
    made = {}
    for c in columns:
        if c in df.columns:
            number = nan_to_null(F.col(c).try_cast("double"))
            made[c] = F.coalesce(number, F.lit(0.0)) if c in zeros else number
    if "minute" in made:
        made["minute"] = F.coalesce(made["minute"].try_cast("int"), F.lit(0))
    return df.withColumns(made)


def drop_noise(
    df: DataFrame, player: str = "player_id", kind: str = "type_display_name",
    noise: str = config.NOISE_EVENT,
) -> DataFrame:
    """Events of a player, less the noise type; events without a type stay."""
    return df.where(F.col(player).isNotNull() & ~F.col(kind).eqNullSafe(F.lit(noise)))


def clean_events(events: DataFrame) -> DataFrame:
    """From exploded match events to the columns of the event table."""
    named = flatten_names(rename_events(events), ("period", "type", "outcome_type"))
    return drop_noise(coerce_numbers(ensure_flags(named)))


def stamp(df: DataFrame, match: Column | None = None) -> DataFrame:
    """Processing time and, where given, the match each event belongs to."""
    df = df.withColumn("event_timestamp", F.current_timestamp())
    return df if match is None else df.withColumn("match_url", match)


def route_events(df: DataFrame) -> DataFrame:
    """A row per event and topic: always the main one, and the first that fits of
    goals, shots and cards."""
    special = (
        F.when(F.col("is_goal"), config.TOPIC_GOALS)
        .when(F.col("is_shot"), config.TOPIC_SHOTS)
        .when(F.col("card_type"), config.TOPIC_CARDS)
    )
    topics = F.array_compact(F.array(F.lit(config.TOPIC_ALL), special))
    return df.withColumn("topic", F.explode(topics))


def topic_counts(routed: DataFrame) -> DataFrame:
    return routed.groupBy("topic").agg(F.count(F.lit(1)).alias("events"))


def clock_seconds(minute: str = "minute", second: str = "second") -> Column:
    return F.col(minute) * 60 + F.col(second)


def replay_offsets(
    df: DataFrame,
    match: str,
    clock: str,
    event_id: str,
    speed: float = config.REPLAY_SPEED,
    cap: float = config.REPLAY_CAP_SECONDS,
    bucket_seconds: int = 3600,
) -> DataFrame:
    """Delay before each event in a replay and its offset from the start.

    The delay is the clock difference to the previous event over `speed`, never
    below 0 nor above `cap`; the offset is the running sum. Both depend on the
    distinct clock values of a match alone, so events are first reduced to those,
    and then ordered within (match, hour). A second, small window over the hours
    of a match carries clock and offset across. No task sees a whole match. Events
    without a clock or a match stay, with a null delay and offset.
    """
    ticks = df.where(F.col(clock).isNotNull()).groupBy(match, clock).agg(F.min(event_id).alias("_first"))
    ticks = ticks.withColumn("_bucket", F.floor(F.col(clock) / bucket_seconds))
    inside = Window.partitionBy(match, "_bucket").orderBy(clock)
    gap = F.col(clock) - F.lag(clock).over(inside)

    def delay(difference: Column) -> Column:
        # The first value has no difference; least and greatest would skip a null.
        seconds = F.coalesce(difference, F.lit(0)) / F.lit(speed)
        return F.greatest(F.lit(0.0), F.least(seconds, F.lit(float(cap))))

    ticks = ticks.withColumn("_delay", delay(gap))
    total = F.sum("_delay").over(inside.rowsBetween(Window.unboundedPreceding, 0))
    ticks = ticks.withColumn("_run", total)
    hours = ticks.groupBy(match, "_bucket").agg(
        F.min(clock).alias("_start"), F.max(clock).alias("_end"), F.sum("_delay").alias("_sum")
    )
    across = Window.partitionBy(match).orderBy("_bucket")
    hours = hours.withColumn("_enter", delay(F.col("_start") - F.lag("_end").over(across)))
    before = F.sum(F.col("_enter") + F.col("_sum")).over(
        across.rowsBetween(Window.unboundedPreceding, 0)
    )
    hours = hours.select(match, "_bucket", "_start", "_enter", (before - F.col("_sum")).alias("_base"))
    ticks = ticks.join(hours, [match, "_bucket"]).select(
        match,
        clock,
        "_first",
        F.when(F.col(clock) == F.col("_start"), F.col("_enter")).otherwise(F.col("_delay")).alias("_delay"),
        (F.col("_base") + F.col("_run")).alias("replay_offset_s"),
    )
    is_first = F.col(event_id) == F.col("_first")
    return (
        df.join(ticks, [match, clock], "left")
        .withColumn("delay_s", F.when(is_first, F.col("_delay")).when(~is_first, F.lit(0.0)))
        .drop("_first", "_delay")
    )
