"""Facts joined to a versioned dimension as they arrive (J4, J7 on a stream).

``FactStream`` gives each arriving fact the dimension version valid at its time. A
fact without one points to the unknown member and waits; when a newer dimension
version is published, the waiting facts (and only they) are tried again with the
next micro-batch. Resolved facts are appended once and never rewritten; the
waiting ones are carried from batch to batch as a table of their own. Both are
committed together with the name of the dimension version used.

The history is joined by sort and merge, never broadcast: a published version is
read from files whose compressed size says little about its rows, which would
pass the driver twice a batch and grow with the dimension.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.operators.star import UNKNOWN_MEMBER, backfill_unknown, point_in_time_join
from ledgerline.sources.sinks import BatchTables

VERSION = "dim_version"


class FactStream:
    """``dimension(spark)`` gives the published (version name, history)."""

    def __init__(self, base: str, dimension: Callable[[SparkSession], tuple[str, DataFrame]], keys: Sequence[str], ts: str, sk: str,
                 attrs: Sequence[str] = (), partition_by: Sequence[str] = ()):
        self.tables = BatchTables(base, {"facts": tuple(partition_by), "waiting": ()})
        self.dimension, self.keys, self.ts, self.sk, self.attrs = dimension, list(keys), ts, sk, list(attrs)

    def published(self, spark: SparkSession) -> tuple[str, DataFrame]:
        """The dimension's version name and its history, to be joined by sort and merge."""
        version, hist = self.dimension(spark)
        return version, hist.hint("merge")

    def write_batch(self, rows: DataFrame, batch_id: int) -> None:
        """The ``foreachBatch`` function."""
        spark = rows.sparkSession
        version, hist = self.published(spark)
        joined = point_in_time_join(rows, hist, self.keys, self.ts, self.sk, self.attrs).persist(StorageLevel.MEMORY_AND_DISK)
        kept = [joined]
        try:
            unknown = F.col(self.sk) == UNKNOWN_MEMBER
            resolved, waiting = joined.where(~unknown), joined.where(unknown)
            if batch_id > 0:
                before = self.tables.log_row(spark, batch_id - 1)
                if before is None:
                    raise RuntimeError(f"{self.tables.base}: batch {batch_id - 1} is not in the batch log; a folder belongs to one checkpoint")
                old = self.waiting(spark, batch_id - 1).drop("batch_id")
                if before["facts"].get(VERSION) != version:
                    old = backfill_unknown(old, hist, self.keys, self.ts, self.sk, self.attrs).persist(StorageLevel.MEMORY_AND_DISK)
                    kept.append(old)
                    resolved = resolved.unionByName(old.where(~unknown))
                    old = old.where(unknown)
                waiting = waiting.unionByName(old)
            self.tables.commit(spark, batch_id, {"facts": resolved, "waiting": waiting}, lambda n: {VERSION: version})
        finally:
            for df in kept:
                df.unpersist()

    def waiting(self, spark: SparkSession, batch_id: int | None = None) -> DataFrame | None:
        """Facts that wait for their dimension row after the batch (the newest, unless given)."""
        last = self.tables.last(spark) if batch_id is None else batch_id
        if last is None:
            return None
        return self.tables.read(spark, "waiting", before=last + 1).where(F.col("batch_id") == last)

    def read(self, spark: SparkSession) -> DataFrame | None:
        """All facts: resolved ones, and waiting ones with the unknown member."""
        facts, waiting = self.tables.read(spark, "facts"), self.waiting(spark)
        return None if facts is None else facts.unionByName(waiting).drop("batch_id")

    def start(self, rows: DataFrame, checkpoint: str, trigger: dict | None = None):
        return (rows.writeStream.foreachBatch(self.write_batch).option("checkpointLocation", checkpoint)
                .trigger(**(trigger or {"availableNow": True})).start())
