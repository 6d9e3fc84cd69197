"""Matches that end one by one: state per match, kept in the query's checkpoint."""

from __future__ import annotations

import time
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from touchline.operators.events import is_live

STATE = "match"
PROVIDER = "spark.sql.streaming.stateStore.providerClass"
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def _ends() -> StatefulProcessor:
    """Takes a match's pages up to the first that is not live, in order of `page`.

    A class made in here goes to Python processes by value: the one that Spark starts
    beside the driver to set a processor up has none of the files shipped to executors.
    """

    class Ends(StatefulProcessor):
        def init(self, handle: StatefulProcessorHandle) -> None:
            # `last` is the page that ended the match.
            self.state = handle.getValueState(STATE, "taken long, over boolean, last long")

        def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
            taken, over, last = self.state.get() or (0, False, None)
            pages = pd.concat(list(rows)).sort_values("page", kind="stable")
            if over:
                pages = pages[pages["page"] < last]  # late pages of the match as it ran
            ended = pages.index[~pages["live"].astype(bool)] if not over else []
            if len(ended):
                over, last = True, int(pages.loc[ended, "page"].iloc[0])
                pages = pages[pages["page"] <= last]
            self.state.update((taken + len(pages), over, last))
            yield pages.assign(last=(pages["page"] == last) & ~pages["live"].astype(bool)).reset_index(drop=True)

        def close(self) -> None:
            pass

    return Ends()


def until_over(pages: DataFrame, key: str = "match_url", page: str = "page", status: str = "status") -> DataFrame:
    """Of a stream of match pages those up to the end of their match, with `last` for the
    page that ends it.

    A page is not live by its status (see is_live); the first such page of a match, by
    `page`, is its last one, and later ones are left out, in this run and, as the state
    is in the checkpoint, after any restart. A page of the running match that comes late
    is still taken. Every match ends on its own. The pages that one batch has of one match
    are held together: size batches with `maxFilesPerTrigger`. Pages without key or number
    belong to no match and are left out. Only the RocksDB store holds state of this kind,
    so queries that the session starts from here on use it.
    """
    pages.sparkSession.conf.set(PROVIDER, ROCKSDB)
    rows = pages.where(F.col(key).isNotNull() & F.col(page).isNotNull())
    rows = rows.withColumn("page", F.col(page).cast("long")).withColumn("live", F.coalesce(is_live(F.col(status)), F.lit(False)))
    # Rows go through Arrow and back; the reset index above keeps no column of its own.
    kept = T.StructType([*rows.schema.fields, T.StructField("last", T.BooleanType())])
    out = rows.groupBy(key).transformWithStateInPandas(
        statefulProcessor=_ends(), outputStructType=kept, outputMode="Append", timeMode="None"
    )
    return out.drop("live") if page == "page" else out.drop("live", "page")


def match_states(spark: SparkSession, checkpoint: str, key: str = "match_url") -> DataFrame:
    """(key, taken, over, last) for every match that the query has seen, from the state in
    its checkpoint; so a new driver knows what the one before it did."""
    state = spark.read.format("statestore").option("stateVarName", STATE).load(checkpoint)
    return state.select(F.col(f"key.{key}").alias(key), "value.*")


def wait_until_over(query: StreamingQuery, spark: SparkSession, checkpoint: str, key: str = "match_url", seconds: float = 1.0) -> None:
    """Stop a polling query as soon as all matches it has seen are over."""
    seen = None
    while query.isActive:
        done = query.lastProgress
        if done and done["batchId"] != seen and done["stateOperators"]:
            seen = done["batchId"]
            states = match_states(spark, checkpoint, key).agg(F.count("*"), F.min("over")).first()
            if states[0] and states[1]:
                break
        query.awaitTermination(seconds) if query.isActive else time.sleep(0)
    query.stop()
