"""Event-stream operators.

Every transformation is a plain DataFrame function, so the same code runs on
a streaming DataFrame (``readStream``) and on its batch twin (a table of the
same envelope rows). Stateful pieces use Structured Streaming's own state:
``withWatermark`` + ``dropDuplicatesWithinWatermark`` for dedupe (state is
evicted once the watermark passes) and windowed aggregates for counts.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StringType, StructField, StructType

from ledgerline.functions.columns import parse_iso_timestamp

CORRUPT = "_corrupt"

# Declared event payload (click, order and payment events in one nullable schema).
# The field names are the wire format. from_json does not enforce
# the required fields, so ``parse_events`` checks them explicitly.
EVENT_SCHEMA = StructType([
    StructField("event_id", StringType()),
    StructField("event_type", StringType()),
    StructField("event_ts", StringType()),
    StructField("user_id", StringType()),
    StructField("session_id", StringType()),
    StructField("order_id", StringType()),
    StructField("product_id", StringType()),
    StructField("amount", DoubleType()),
    StructField("status", StringType()),
    StructField("payment_method", StringType()),
    StructField("page", StringType()),
    StructField("device", StructType([StructField("os", StringType()), StructField("app_ver", StringType())])),
    StructField("ip", StringType()),
    StructField(CORRUPT, StringType()),
])
REQUIRED = ("event_id", "event_ts")

# Fixed reason codes of the dead-letter table.
SCHEMA_PARSE_FAILED = "SCHEMA_PARSE_FAILED"
MISSING_REQUIRED = "MISSING_REQUIRED"
BAD_TIMESTAMP = "BAD_TIMESTAMP"

ENVELOPE = ("key", "kafka_ingest_ts", "topic", "partition", "offset")


# ---------------------------------------------------------------- sources

def read_kafka(spark: SparkSession, bootstrap: str, topic: str, starting: str = "latest",
               max_offsets_per_trigger: int | None = None, min_partitions: int | None = None) -> DataFrame:
    """Kafka subscription (S4). Needs the Kafka connector on the classpath.

    ``max_offsets_per_trigger`` bounds a micro-batch (so a backlog after an
    outage is drained in steady batches, not one huge one); ``min_partitions``
    splits large topic partitions across more tasks.
    """
    r = (spark.readStream.format("kafka").option("kafka.bootstrap.servers", bootstrap)
         .option("subscribe", topic).option("startingOffsets", starting))
    if max_offsets_per_trigger:
        r = r.option("maxOffsetsPerTrigger", max_offsets_per_trigger)
    if min_partitions:
        r = r.option("minPartitions", min_partitions)
    return r.load()


KAFKA_FRAME_SCHEMA = ("key binary, value binary, topic string, partition int, offset long, timestamp timestamp")


def read_envelope_files(spark: SparkSession, path: str, fmt: str = "parquet", max_files: int | None = None) -> DataFrame:
    """A file stream carrying Kafka's frame columns (S4 without a broker)."""
    r = spark.readStream.format(fmt).schema(KAFKA_FRAME_SCHEMA)
    if max_files:
        r = r.option("maxFilesPerTrigger", max_files)
    return r.load(path)


def envelope_project(frames: DataFrame) -> DataFrame:
    """Kafka frame -> text envelope (S5): key/value as strings, ingest time renamed."""
    return frames.select(
        F.col("key").cast("string").alias("key"),
        F.col("value").cast("string").alias("value"),
        F.col("timestamp").alias("kafka_ingest_ts"),
        "topic", "partition", "offset",
    )


# ---------------------------------------------------------------- parse + DLQ

def parse_events(env: DataFrame, schema: StructType = EVENT_SCHEMA) -> DataFrame:
    """from_json with a corrupt-record column, typed event time and a reason.

    ``reason`` is null for good rows, otherwise the first failing check:
    unparseable JSON, a missing required field, an event time that is not
    ISO-8601.
    """
    js = F.from_json(F.col("value"), schema, {"columnNameOfCorruptRecord": CORRUPT, "mode": "PERMISSIVE"})
    # The parsed struct is produced by a one-element generator: filters on the
    # reason cannot be pushed below it, so each payload is parsed exactly once
    # (a plain projection would be inlined into every pushed-down predicate).
    parsed = env.select("*", F.inline(F.array(F.struct(js.alias("json")))))
    j = F.col("json")
    event_time = parse_iso_timestamp(j["event_ts"])
    missing = F.lit(False)
    for c in REQUIRED:
        missing = missing | j[c].isNull()
    reason = (F.when(F.col("value").isNull() | j.isNull() | j[CORRUPT].isNotNull(), F.lit(SCHEMA_PARSE_FAILED))
              .when(missing, F.lit(MISSING_REQUIRED))
              .when(event_time.isNull(), F.lit(BAD_TIMESTAMP)))
    return parsed.withColumn("event_time", event_time).withColumn("reason", reason)


def good_events(parsed: DataFrame) -> DataFrame:
    """Rows that passed every check, payload fields flattened."""
    fields = [f.name for f in EVENT_SCHEMA.fields if f.name not in (CORRUPT, "event_ts", "device")]
    keep = [c for c in parsed.columns if c in ENVELOPE]
    return parsed.where(F.col("reason").isNull()).select(
        *keep, *[F.col(f"json.{f}").alias(f) for f in fields],
        F.col("json.device.os").alias("device_os"), F.col("json.device.app_ver").alias("device_app_ver"),
        "event_time")


def dead_letters(parsed: DataFrame) -> DataFrame:
    """Dead-letter rows: envelope + raw value + reason."""
    keep = [c for c in parsed.columns if c in ENVELOPE]
    return parsed.where(F.col("reason").isNotNull()).select(*keep, "value", "reason")


def parse_props(df: DataFrame, col: str, schema: str) -> DataFrame:
    """Typed fields out of a JSON text column."""
    return df.withColumn("__p", F.from_json(F.col(col), schema)).select("*", "__p.*").drop("__p")


# ---------------------------------------------------------------- state

def dedupe_stream(good: DataFrame, key: str = "event_id", ts: str = "event_time", delay: str = "10 minutes") -> DataFrame:
    """Exact-duplicate removal with bounded state (T2, T3): a key is unique
    within the watermark delay; its state is dropped once the watermark passes."""
    return good.withWatermark(ts, delay).dropDuplicatesWithinWatermark([key])


#: Arrival order of a feed: offsets only order one partition of a topic.
ARRIVAL = ("kafka_ingest_ts", "partition", "offset")


def first_arrival(good: DataFrame, key: str = "event_id", order: Sequence[str] = ARRIVAL) -> DataFrame:
    """Batch twin of the stream dedupe: the first arrival per key. The
    ``row_number() = 1`` filter runs as a partial limit per map partition."""
    w = Window.partitionBy(key).orderBy(*[F.col(c) for c in order])
    return good.withColumn("__rn", F.row_number().over(w)).where("__rn = 1").drop("__rn")


def event_partitions(df: DataFrame, ts: str = "event_time") -> DataFrame:
    """dt / hh partition columns from event time."""
    return df.withColumn("dt", F.to_date(F.col(ts))).withColumn("hh", F.date_format(F.col(ts), "HH"))


# ---------------------------------------------------------------- late data (T4)

def running_watermark(df: DataFrame, ts: str, delay_seconds: int, order: Sequence[str] = ARRIVAL, block: Column | None = None,
                      blocks_of: int = 1024, since: Column | None = None) -> DataFrame:
    """``df`` with ``watermark_ts``: the running maximum of ``ts`` over all
    *earlier* arrivals (and ``since``, the maximum before this frame, if any) minus
    the delay; null for the first arrivals.

    The running maximum is computed without funnelling the feed through one
    task: arrivals are cut into ``block``s (a number that does not decrease along
    ``order``; the minute of the first order column, a timestamp, unless given). A
    window per block gives the in-block running maximum; the block maxima (a
    partial aggregate, one row per block) get their prefix maximum in two levels,
    groups of ``blocks_of`` blocks and the groups' own maxima, so that the one task
    of the last level sees one row per group.
    """
    if block is None:
        block = F.floor(F.unix_seconds(F.col(order[0])) / F.lit(60))
    x = df.withColumn("__blk", block)
    per_block = (x.groupBy("__blk").agg(F.max(ts).alias("__bmax"))
                 .withColumn("__grp", F.floor(F.col("__blk") / F.lit(blocks_of))))
    earlier = (Window.unboundedPreceding, -1)
    groups = per_block.groupBy("__grp").agg(F.max("__bmax").alias("__gmax"))
    groups = groups.select("__grp", F.max("__gmax").over(Window.orderBy("__grp").rowsBetween(*earlier)).alias("__gbefore"))
    in_group = F.max("__bmax").over(Window.partitionBy("__grp").orderBy("__blk").rowsBetween(*earlier))
    before = (per_block.withColumn("__gin", in_group).join(groups, "__grp")
              .select("__blk", F.greatest("__gbefore", "__gin").alias("__before")))
    w_in = Window.partitionBy("__blk").orderBy(*[F.col(c) for c in order]).rowsBetween(*earlier)
    x = x.withColumn("__inblk", F.max(ts).over(w_in)).join(before, "__blk", "left")
    seen = F.greatest(F.col("__before"), F.col("__inblk"), *([since] if since is not None else []))
    mark = seen - F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), F.lit(delay_seconds))
    return x.withColumn("watermark_ts", mark).drop("__blk", "__before", "__inblk")


def late_events(df: DataFrame, ts: str, delay_seconds: int, order: Sequence[str] = ARRIVAL, block: Column | None = None,
                blocks_of: int = 1024) -> DataFrame:
    """Rows a watermark of ``delay_seconds`` would drop, for an ordered feed (T4):
    older than ``running_watermark``."""
    return running_watermark(df, ts, delay_seconds, order, block, blocks_of).where(F.col(ts) < F.col("watermark_ts"))


def late_drop_count(progress) -> int:
    """Rows a streaming query dropped as late, from its progress report."""
    ops = (progress or {}).get("stateOperators", [])
    return int(sum(op.get("numRowsDroppedByWatermark", 0) for op in ops))


# ---------------------------------------------------------------- windows and alerts

def counts_by_window(good: DataFrame, ts: str, size: str, by=("event_type",), amount: str | None = "amount",
                     delay: str = "10 minutes") -> DataFrame:
    """Event counts (and exact amount sums) per tumbling window (T10). On a
    stream the watermark ``delay`` bounds the state; a batch is not affected."""
    if good.isStreaming:
        good = good.withWatermark(ts, delay)
    aggs = [F.count(F.lit(1)).alias("n_events")]
    if amount:
        aggs.append(F.sum(F.col(amount).cast("decimal(18,2)")).alias("total_amount"))
    return good.groupBy(F.window(F.col(ts), size).alias("w"), *by).agg(*aggs)


def bad_rate_row(n_total: int, n_bad: int, threshold: float) -> float | None:
    """The bad rate of one micro-batch if it calls for an alert, else None."""
    rate = n_bad / n_total if n_total else 0.0
    return rate if rate > threshold else None


def bad_rate_alerts(parsed: DataFrame, batch_col: Column, threshold: float) -> DataFrame:
    """Share of dead-letter rows per micro-batch, alert rows above ``threshold``."""
    per = parsed.groupBy(batch_col.alias("batch_id")).agg(
        F.count(F.lit(1)).alias("n_total"),
        F.sum(F.when(F.col("reason").isNotNull(), 1).otherwise(0)).cast("bigint").alias("n_bad"))
    per = per.withColumn("bad_rate", F.col("n_bad") / F.col("n_total"))
    return per.where(F.col("bad_rate") > F.lit(threshold)).withColumn("alert_type", F.lit("BAD_RATE"))


def _floor_to(ts: Column, seconds: int) -> Column:
    return F.timestamp_seconds(F.floor(F.unix_seconds(ts) / seconds) * seconds)


def zero_event_alerts(good: DataFrame, ts: str, slot_seconds: int = 600, partitions: int | None = None) -> DataFrame:
    """Slots of ``slot_seconds`` with no events between the first and last
    event (A6, T8). Slots are generated per day and the days are spread over
    the shuffle partitions (or ``partitions``) before the per-day expansion,
    so a long time span is not expanded in a single task."""
    t = F.col(ts)
    bounds = good.agg(_floor_to(F.min(t), slot_seconds).alias("lo"), _floor_to(F.max(t), slot_seconds).alias("hi"))
    days = bounds.select("lo", "hi", F.explode(F.sequence(F.to_date("lo"), F.to_date("hi"))).alias("day"))
    per_day = 86400 // slot_seconds
    spread = days.repartition(partitions, "day") if partitions else days.repartition("day")
    slots = (spread
             .select("lo", "hi", "day", F.explode(F.sequence(F.lit(0), F.lit(per_day - 1))).alias("k"))
             .select(F.timestamp_seconds(F.unix_seconds(F.col("day").cast("timestamp")) + F.col("k") * slot_seconds)
                     .alias("slot_start"), "lo", "hi")
             .where((F.col("slot_start") >= F.col("lo")) & (F.col("slot_start") <= F.col("hi")))
             .select("slot_start"))
    seen = good.select(_floor_to(t, slot_seconds).alias("slot_start")).distinct()
    return slots.join(seen, "slot_start", "left_anti").withColumn("alert_type", F.lit("ZERO_EVENTS"))


# ---------------------------------------------------------------- pipeline wiring

def start_event_pipeline(frames: DataFrame, out_path: str, dlq_path: str, checkpoint_base: str,
                         delay: str = "10 minutes", trigger: dict | None = None, alerts_path: str | None = None,
                         on_metrics=None, bad_rate: float | None = None):
    """Two streaming queries over one Kafka-frame stream: parsed + deduplicated
    events to ``out_path`` (dt/hh partitions, one file set per batch id) and dead
    letters to ``dlq_path``; each has its own checkpoint. The second query sees
    every input row of a batch, so the zero-event alert and, with ``bad_rate``,
    the bad-rate alert are raised there. Returns ``(good_query, dlq_query)``."""
    from ledgerline.sources.sinks import dead_letter_writer, foreach_batch_writer

    trig = trigger or {"availableNow": True}
    parsed = parse_events(envelope_project(frames))
    good = event_partitions(dedupe_stream(good_events(parsed), delay=delay))
    q_good = (good.writeStream.outputMode("append")
              .foreachBatch(foreach_batch_writer(out_path, on_metrics=on_metrics))
              .option("checkpointLocation", f"{checkpoint_base}/good").trigger(**trig).start())
    q_dlq = (parsed.writeStream.outputMode("append")
             .foreachBatch(dead_letter_writer(dlq_path, alerts_path=alerts_path, bad_rate=bad_rate))
             .option("checkpointLocation", f"{checkpoint_base}/bad").trigger(**trig).start())
    return q_good, q_dlq
