"""Slots without events, found on the stream.

A first operator counts events per topic and tumbling slot and gives one row per
slot that had any, when the watermark closes it; so a busy topic reaches the
second operator as one row a slot, never as its events. The second keeps one
number per topic, the next slot it has not judged: a closed slot with events gives
the empty ones before it, and an event-time timer at the end of the slot due gives
those of a topic that has fallen silent. Its state is one row per topic.
"""

from __future__ import annotations

import contextlib

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
PROVIDER = "spark.sql.streaming.stateStore.providerClass"


@contextlib.contextmanager
def state_on_disk(spark: SparkSession):
    """Timers and typed state need the RocksDB store; the setting is read when a query starts."""
    old = spark.conf.get(PROVIDER, None)
    spark.conf.set(PROVIDER, ROCKSDB)
    try:
        yield
    finally:
        spark.conf.unset(PROVIDER) if old is None else spark.conf.set(PROVIDER, old)


def empty_slots(events: DataFrame, ts: str, key: str, slot_seconds: int = 600, delay: str = "1 hour") -> DataFrame:
    """(key, slot_start, alert_type) of a stream of events: each slot of a topic
    without events between its first one and the watermark. Start the query within
    ``state_on_disk``; events later than ``delay`` are not counted."""
    from pyspark.sql.streaming import StatefulProcessor

    size = slot_seconds

    class Judge(StatefulProcessor):  # a local class: workers get it by value
        def init(self, handle) -> None:
            self.handle = handle
            self.due = handle.getValueState("due", "slot bigint")

        def _frame(self, key, slots):
            import pandas as pd
            return pd.DataFrame({"key": pd.Series([str(key[0])] * len(slots), dtype="object"), "slot": pd.Series(slots, dtype="int64")})

        def _wait(self, due: int) -> None:
            for at in list(self.handle.listTimers()):
                self.handle.deleteTimer(at)
            self.due.update((due,))
            self.handle.registerTimer((due + size) * 1000)

        def handleInputRows(self, key, rows, timerValues):
            slots = sorted({int(s) for part in rows for s in part["slot"]})
            due = self.due.get()[0] if self.due.exists() else slots[0]
            empty = []
            for s in slots:
                empty.extend(range(due, s, size))
                due = max(due, s + size)
            self._wait(due)
            yield self._frame(key, empty)

        def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
            closed = timerValues.getCurrentWatermarkInMs() // 1000
            due, empty = self.due.get()[0], []
            while due + size <= closed:
                empty.append(due)
                due += size
            self._wait(due)
            yield self._frame(key, empty)

        def close(self) -> None:
            pass

    topic = F.coalesce(F.col(key).cast("string"), F.lit(""))
    counts = (events.withWatermark(ts, delay).groupBy(topic.alias("key"), F.window(ts, f"{size} seconds").alias("w"))
              .agg(F.count(F.lit(1)).alias("n")).select("key", F.unix_seconds("w.start").alias("slot"), F.window_time("w").alias("closed_at")))
    found = counts.groupBy("key").transformWithStateInPandas(
        Judge(), "key string, slot bigint", outputMode="Append", timeMode="EventTime")
    return found.select(F.col("key").alias(key), F.timestamp_seconds("slot").alias("slot_start"), F.lit("ZERO_EVENTS").alias("alert_type"))
