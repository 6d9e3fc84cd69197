"""Counters over a whole run, from metrics that Spark observes as rows pass."""

from __future__ import annotations

import threading
import time
from collections import defaultdict

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

#: Events by the topic that they go to besides the one for all, as SQL conditions.
EVENT_COUNTS = {
    "events": "true", "goals": "is_goal", "shots": "is_shot AND NOT is_goal", "cards": "card_type AND NOT is_goal AND NOT is_shot",
}


def counted(df: DataFrame, name: str, counts: dict[str, str]) -> DataFrame:
    """`df` with an observed count of the rows for which each condition holds; they cost
    no pass of their own."""
    return df.observe(name, *[F.count_if(F.coalesce(F.expr(c), F.lit(False))).alias(k) for k, c in counts.items()])


def count_events(df: DataFrame, name: str = "sent") -> DataFrame:
    """Counts of all events and of those by topic."""
    return counted(df, name, EVENT_COUNTS)


class Totals(StreamingQueryListener):
    """Sums of every query's batches, rows and observed counts, batch by batch as they are
    committed. Unlike a query's own reports, of which the last hundred are kept, these
    leave none out; a batch that is reported again counts once."""

    def __init__(self):
        self._lock = threading.Lock()
        self._last: dict[str, int] = {}
        self._sums: dict[str, dict] = {}

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        self.add(event.progress)

    def add(self, report) -> None:
        query = str(report.id)
        with self._lock:
            if report.batchId <= self._last.get(query, -1):
                return
            self._last[query] = report.batchId
            own = self._sums.setdefault(query, {"batches": 0, "rows": 0, "observed": defaultdict(lambda: defaultdict(int))})
            own["batches"] += 1
            own["rows"] += report.numInputRows
            for name, row in (report.observedMetrics or {}).items():
                for field, value in row.asDict().items():
                    own["observed"][name][field] += value or 0

    def of(self, query: StreamingQuery, seconds: float = 30.0) -> dict:
        """What the query has done so far: batches, rows and observed counts by name.
        Reports come a little later than batches; the last one is waited for."""
        last, until = query.lastProgress, time.time() + seconds
        while last and self._last.get(str(query.id), -1) < last["batchId"] and time.time() < until:
            time.sleep(0.05)
        with self._lock:
            own = self._sums.get(str(query.id), {"batches": 0, "rows": 0, "observed": {}})
            return own | {"observed": {k: dict(v) for k, v in own["observed"].items()}}


_LISTENING: dict[str, Totals] = {}


def totals(spark: SparkSession) -> Totals:
    """The listener of this application, added when it is first asked for."""
    app = spark.sparkContext.applicationId
    if app not in _LISTENING:
        _LISTENING[app] = Totals()
        spark.streams.addListener(_LISTENING[app])
    return _LISTENING[app]
