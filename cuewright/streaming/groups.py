"""Keyed state over streams: greedy grouping of detections, and the sliding first use of a key.

Both keep, for each key, only what a later row can still meet, and event-time timers remove it when the watermark has
passed the last moment at which one could. They need the RocksDB state store, which ``stateful`` sets while a query starts.
Rows of a key are taken in the order of ``seq`` (or of time) within a micro-batch, and micro-batches in their order, so a
stream whose batches follow that order gives what the batch operators give for the whole table, however it is cut.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from ..operators.dedupe import join_or_open, key_of

_STORE = "spark.sql.streaming.stateStore.providerClass"
_ROCKS = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
#: An open group as it is kept: the fields of a group in order.
_OPEN = "group_id long, start_ms long, end_ms long, text string, x double, y double, confidence double, n long"
GROUPS = "stem long, group_id long, start_ms long, end_ms long, text string, confidence double, n long, closed boolean"
FIRSTS = "stem long, key string, seq long, at_ms long"


@contextmanager
def stateful(spark: SparkSession) -> Iterator[None]:
    """The state store that keyed processors need, for queries that start here."""
    before = spark.conf.get(_STORE, None)
    spark.conf.set(_STORE, _ROCKS)
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(_STORE)
        else:
            spark.conf.set(_STORE, before)


class GroupDetections(StatefulProcessor):
    """STM2: at most ``look_back`` open groups of a stem, and its next group number.

    A row is given out for each group that a batch has changed, and one with ``closed`` when the group can change no more:
    ``look_back`` others have come after it, or the watermark is more than the gap behind its end.
    """

    def __init__(self, look_back: int, gap_ms: float, span_ms: int, ascii_only: bool, last_end: bool):
        self.look_back, self.gap_ms, self.options = look_back, gap_ms, (gap_ms, span_ms, ascii_only, last_end)

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.open = handle.getListState("open", _OPEN)
        self.count = handle.getValueState("count", "count long")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        count = self.count.get()[0] if self.count.exists() else 0
        groups = [
            {"group_id": i, "start_ms": s, "end_ms": e, "text": t, "key": key_of(t, self.options[2]), "at": (x, y), "confidence": c, "n": n}
            for i, s, e, t, x, y, c, n in self.open.get()
        ]
        changed: dict[int, dict] = {}
        closed: list[dict] = []
        for r in pd.concat(list(rows)).sort_values("seq", kind="stable").itertuples(index=False):
            # Groups that a timer has closed hold their place: only numbers tell how far back a group is.
            near = [g for g in groups if g["group_id"] > count - self.look_back]
            group = join_or_open(near, r, self.look_back, *self.options)
            if "group_id" not in group:
                count += 1
                group["group_id"] = count
                groups.append(group)
            changed[group["group_id"]] = group
            closed += [g for g in groups if g["group_id"] <= count - self.look_back]
            groups = [g for g in groups if g["group_id"] > count - self.look_back]
        self.count.update((count,))
        self._keep(groups)
        done = {g["group_id"] for g in closed}
        yield self._rows(key, [(g, g["group_id"] in done) for g in {**changed, **{g["group_id"]: g for g in closed}}.values()])

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        mark = timerValues.getCurrentWatermarkInMs()
        groups = [dict(zip(("group_id", "start_ms", "end_ms", "text", "x", "y", "confidence", "n"), g, strict=True)) for g in self.open.get()]
        for g in groups:
            g["at"] = (g["x"], g["y"])
        late = [g for g in groups if g["end_ms"] + self.gap_ms < mark]
        self._keep([g for g in groups if g["end_ms"] + self.gap_ms >= mark])
        yield self._rows(key, [(g, True) for g in late])

    def _keep(self, groups: list[dict]) -> None:
        if groups:
            self.open.put([(g["group_id"], g["start_ms"], g["end_ms"], g["text"], *g["at"], g["confidence"], g["n"]) for g in groups])
        else:
            self.open.clear()
        for timer in list(self.handle.listTimers()):
            self.handle.deleteTimer(timer)
        if groups:
            self.handle.registerTimer(int(min(g["end_ms"] for g in groups) + self.gap_ms) + 1)

    @staticmethod
    def _rows(key: tuple, found: list[tuple[dict, bool]]) -> pd.DataFrame:
        names = ["group_id", "start_ms", "end_ms", "text", "confidence", "n"]
        return pd.DataFrame([(key[0], *(g[c] for c in names), closed) for g, closed in found], columns=["stem", *names, "closed"])

    def close(self) -> None:
        pass


def grouped_detections(stream: DataFrame, interval_ms: int = 500, look_back: int = 20, span_ms: int = 6000, watermark: str = "1 minute") -> DataFrame:
    """STM2: rows of groups as they change (stem, group_id, ..., n, closed) from a stream of detections; ``latest_groups``
    of them is the table. Rows later than the watermark are dropped, null texts count as empty."""
    # The first watermark is 0, and rows at it would be late: event time runs 1 ms ahead.
    timed = stream.withColumn("text", F.coalesce("text", F.lit(""))).withColumn("event_time", F.timestamp_millis(F.col("start_ms") + 1)).withWatermark("event_time", watermark)
    processor = GroupDetections(look_back, interval_ms * 2.2, span_ms, True, True)
    return timed.groupBy("stem").transformWithStateInPandas(processor, outputStructType=GROUPS, outputMode="Append", timeMode="EventTime")


def latest_groups(rows: DataFrame) -> DataFrame:
    """Each group as it was last: its members only grow in number, so rows that a restart repeats change nothing."""
    last = F.max_by(F.struct("start_ms", "end_ms", "text", "confidence"), F.col("n"))
    return rows.groupBy("stem", "group_id").agg(last.alias("g"), F.max("n").alias("n"), F.bool_or("closed").alias("closed")).select("stem", "group_id", "g.*", "n", "closed")


class SlidingFirst(StatefulProcessor):
    """STM5: the time of the last kept row of a key, forgotten when the watermark is beyond its window."""

    def __init__(self, window_ms: int):
        self.window_ms = window_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.last = handle.getValueState("last", "at_ms long")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        last = self.last.get()[0] if self.last.exists() else None
        out = []
        for r in pd.concat(list(rows)).sort_values(["at_ms", "seq"], kind="stable").itertuples(index=False):
            if last is None or abs(r.at_ms - last) > self.window_ms:
                last = r.at_ms
                out.append((*key, r.seq, r.at_ms))
        self.last.update((last,))
        for timer in list(self.handle.listTimers()):
            self.handle.deleteTimer(timer)
        self.handle.registerTimer(int(last + self.window_ms) + 1)
        yield pd.DataFrame(out, columns=["stem", "key", "seq", "at_ms"])

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        self.last.clear()
        yield pd.DataFrame([], columns=["stem", "key", "seq", "at_ms"])

    def close(self) -> None:
        pass


def sliding_first(stream: DataFrame, window_ms: int = 20_000, watermark: str = "1 minute") -> DataFrame:
    """STM5: of rows with one key those that no kept row precedes within ``window_ms``."""
    timed = stream.withColumn("event_time", F.timestamp_millis(F.col("at_ms") + 1)).withWatermark("event_time", watermark)
    return timed.groupBy("stem", "key").transformWithStateInPandas(SlidingFirst(window_ms), outputStructType=FIRSTS, outputMode="Append", timeMode="EventTime")
