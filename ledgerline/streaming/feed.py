"""One streaming read of the event feed, several sinks.

``EventFeed`` runs one query over the Kafka frames. Each micro-batch is parsed
once and split into

* ``good``   deduplicated events by dt / hh (or dt alone, where a batch spans many hours),
* ``dead``   rows that failed a check, with the reason,
* ``late``   good rows older than the watermark: kept, with the watermark they missed,
* ``alerts`` no input at all, or too many bad rows,

which are committed together (``sinks.BatchTables``). What has to last from batch
to batch is small and lies in the batch log: the running maximum of the event
time. A row is late if it is older than the maximum of all earlier arrivals minus
the delay, in arrival order and whatever the cut into batches, which is what
``events.late_events`` finds in a table of the whole feed.

An event id is unique within the delay: arrivals of one batch are reduced to the
first, and ids accepted earlier are looked up among the committed good rows of
the last ``2 * delay`` of event time only (pruned by day).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.sources.sinks import BatchTables
from ledgerline.streaming import events as ev

ALERT_SCHEMA = "alert_type string, n_total bigint, n_bad bigint, bad_rate double"
MAX_TIME = "max_event_time"


class EventFeed:
    def __init__(self, base: str, delay_seconds: int = 600, bad_rate: float | None = None, key: str = "event_id",
                 ts: str = "event_time", order: Sequence[str] = ev.ARRIVAL, partition_by: Sequence[str] = ("dt", "hh")):
        self.tables = BatchTables(base, {"good": tuple(partition_by), "dead": (), "late": (), "alerts": ()})
        self.delay, self.bad_rate, self.key, self.ts, self.order = delay_seconds, bad_rate, key, ts, tuple(order)

    def _seen(self, spark: SparkSession, batch_id: int) -> str | None:
        """The maximum event time before the batch, as text; None at the start."""
        if batch_id == 0:
            return None
        row = self.tables.log_row(spark, batch_id - 1)
        if row is None:
            raise RuntimeError(f"{self.tables.base}: batch {batch_id - 1} is not in the batch log; a folder belongs to one checkpoint")
        return row["facts"].get(MAX_TIME)

    def _accepted(self, spark: SparkSession, batch_id: int, seen: str) -> DataFrame:
        """Ids of good rows that can still be the first of a copy that is not late."""
        horizon = F.lit(seen).cast("timestamp") - F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), F.lit(2 * self.delay))
        good = self.tables.read(spark, "good", before=batch_id)
        return good.where((F.col("dt") >= F.to_date(horizon)) & (F.col(self.ts) >= horizon)).select(self.key).distinct()

    def write_batch(self, frames: DataFrame, batch_id: int) -> None:
        """The ``foreachBatch`` function."""
        spark, ts = frames.sparkSession, F.col(self.ts)
        seen = self._seen(spark, batch_id)
        parsed = ev.parse_events(ev.envelope_project(frames)).persist(StorageLevel.MEMORY_AND_DISK)
        since = F.lit(seen).cast("timestamp") if seen else None
        marked = ev.running_watermark(ev.good_events(parsed), self.ts, self.delay, self.order, since=since).persist(StorageLevel.MEMORY_AND_DISK)
        try:
            got = parsed.agg(F.count(F.lit(1)).alias("rows"), F.count("reason").alias("bad"),
                             F.max(F.when(F.col("reason").isNull(), ts)).cast("string").alias("newest")).first()
            is_late = ts < F.col("watermark_ts")
            fresh = ev.first_arrival(marked.where(~F.coalesce(is_late, F.lit(False))).drop("watermark_ts"), self.key, self.order)
            if seen:
                fresh = fresh.join(self._accepted(spark, batch_id, seen), self.key, "left_anti")
            alerts = [("ZERO_EVENTS", 0, 0, None)] if got["rows"] == 0 else []
            if self.bad_rate is not None and (rate := ev.bad_rate_row(got["rows"], got["bad"], self.bad_rate)) is not None:
                alerts.append(("BAD_RATE", got["rows"], got["bad"], rate))
            newest = max(filter(None, (seen, got["newest"])), default=None)

            def facts(counts: dict[str, int]) -> dict[str, str]:
                kept = counts["good"] + counts["dead"] + counts["late"]
                return {"rows_in": str(got["rows"]), "copies": str(got["rows"] - kept), **({MAX_TIME: newest} if newest else {})}

            self.tables.commit(spark, batch_id, {
                "good": ev.event_partitions(fresh, self.ts), "dead": ev.dead_letters(parsed), "late": marked.where(is_late),
                "alerts": spark.createDataFrame(alerts, ALERT_SCHEMA)}, facts)
        finally:
            marked.unpersist()
            parsed.unpersist()

    def start(self, frames: DataFrame, checkpoint: str, trigger: dict | None = None):
        """The query over a stream of Kafka frames."""
        return (frames.writeStream.foreachBatch(self.write_batch).option("checkpointLocation", checkpoint)
                .trigger(**(trigger or {"availableNow": True})).start())

    def read(self, spark: SparkSession, name: str) -> DataFrame | None:
        return self.tables.read(spark, name)
