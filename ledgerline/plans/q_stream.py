"""Stream queries, run on the batch twin of the feed.

``v_raw_events`` is the Kafka feed as a table (offset, key, JSON value); the
same operator functions run on a ``readStream`` of it in the tests. Times
leave as TIMESTAMP_NTZ (UTC wall clock).
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.plans import specs as S
from ledgerline.plans.catalog import query
from ledgerline.plans.fixtures import table, view, with_views
from ledgerline.plans.spec import run_spec
from ledgerline.plans.stream_spec import DEAD, TARGET, tables_of
from ledgerline.session import ensure_checkpoint_dir
from ledgerline.streaming import events as ev
from ledgerline.streaming.feed import EventFeed
from ledgerline.streaming.slots import empty_slots, state_on_disk

TOPIC = "clickstream_events"
WATERMARK_SECONDS = 600  # fixed: 10 minutes, the default watermark
BAD_RATE_THRESHOLD = 0.02  # fixed: 2 %, the default alert threshold
BATCH_OFFSETS = 200  # offsets per simulated micro-batch


def _ntz(c):
    return F.col(c).cast("timestamp_ntz")


def frames(spark, sf):
    """The fixture feed shaped as Kafka frames (binary key/value)."""
    r = view(spark, sf, "v_raw_events")
    return r.select(F.col("msg_key").cast("binary").alias("key"), F.col("value").cast("binary").alias("value"),
                    F.lit(TOPIC).alias("topic"), F.col("kafka_partition").alias("partition"), F.col("kafka_offset").alias("offset"),
                    F.col("ingest_ts").cast("timestamp").alias("timestamp"))


def parsed(spark, sf):
    return ev.parse_events(ev.envelope_project(frames(spark, sf)))


def good(spark, sf):
    return ev.good_events(parsed(spark, sf))


def scratch(spark, name: str) -> str:
    """A new folder beside the checkpoints, which all executors reach."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def arrivals(df: DataFrame, at: str, path: str, parts: int):
    """Writes a feed in ``parts`` equal spans of its arrival time, one after the
    other; what is run between two of them sees a stream go on (and restart).
    Rows are dealt by their hash, so that a table of one row group comes in many
    files, which the stream parses on all cores."""
    lo, hi = df.agg(F.min(F.unix_micros(at)), F.max(F.unix_micros(at))).first()
    if lo is None:
        lo = hi = 0
    step = (hi - lo) // parts + 1
    slot = F.floor((F.unix_micros(at) - F.lit(lo)) / F.lit(step))
    for i in range(parts):
        part = df.where(slot == i)
        dealt = part.withColumn("__deal", F.xxhash64(*part.columns)).hint("rebalance", "__deal").drop("__deal")
        dealt.write.mode("append").parquet(path)
        yield i


# ------------------------------------------------------------------ oracle CTEs

PARSE_SQL = """
SELECT kafka_offset AS "offset", kafka_partition AS "partition", ingest_ts, msg_key AS key, value, ok,
       CASE WHEN ok THEN json_extract_string(value, '$.event_id') END AS event_id,
       CASE WHEN ok THEN json_extract_string(value, '$.event_type') END AS event_type,
       CASE WHEN ok THEN json_extract_string(value, '$.event_ts') END AS event_ts,
       CASE WHEN ok THEN json_extract_string(value, '$.user_id') END AS user_id,
       CASE WHEN ok THEN CAST(json_extract_string(value, '$.amount') AS DOUBLE) END AS amount,
       CASE WHEN ok THEN json_extract_string(value, '$.page') END AS page,
       CASE WHEN ok THEN json_extract_string(value, '$.payment_method') END AS payment_method,
       CASE WHEN ok THEN json_extract_string(value, '$.device.os') END AS device_os,
       CASE WHEN ok THEN json_extract_string(value, '$.device.app_ver') END AS device_app_ver,
       CASE WHEN ok AND regexp_matches(json_extract_string(value, '$.event_ts'), '^\\d{4}-\\d{2}-\\d{2}T\\d{2}:\\d{2}:\\d{2}')
            THEN TRY_CAST(replace(substr(json_extract_string(value, '$.event_ts'), 1, 19), 'T', ' ') AS TIMESTAMP) END AS event_time
FROM (SELECT *, value IS NOT NULL AND json_valid(value) AS ok FROM v_raw_events)"""

REASON_SQL = """
SELECT *, CASE WHEN NOT ok THEN 'SCHEMA_PARSE_FAILED'
               WHEN event_id IS NULL OR event_ts IS NULL THEN 'MISSING_REQUIRED'
               WHEN event_time IS NULL THEN 'BAD_TIMESTAMP' END AS reason
FROM p0"""

GOOD_SQL = "SELECT * FROM pr WHERE reason IS NULL"
FIRST_SQL = "SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY event_id ORDER BY ingest_ts, \"partition\", \"offset\") AS rn FROM good) WHERE rn = 1"

STREAM_CTES = [("p0", PARSE_SQL), ("pr", REASON_SQL), ("good", GOOD_SQL), ("first", FIRST_SQL)]


def stream_sql(body: str) -> str:
    return with_views(body, ["v_raw_events"], STREAM_CTES)


def _slot_sql(expr: str) -> str:
    return f"TIMESTAMP '1970-01-01 00:00:00' + to_seconds(CAST(floor(epoch({expr}) / 600) * 600 AS BIGINT))"


# ------------------------------------------------------------------ queries

@query("envelope_project", with_views(f"""
SELECT msg_key AS key, value, ingest_ts AS kafka_ingest_ts,
       '{TOPIC}' AS topic, kafka_partition AS "partition", kafka_offset AS "offset" FROM v_raw_events""", ["v_raw_events"]))
def envelope_project(spark, sf):
    """Kafka frame -> text envelope."""
    return ev.envelope_project(frames(spark, sf)).withColumn("kafka_ingest_ts", _ntz("kafka_ingest_ts"))


@query("stream_parse", stream_sql("""
SELECT "offset", key, event_id, event_type, user_id, amount, payment_method, page, device_os, device_app_ver, event_time FROM good"""))
def stream_parse(spark, sf):
    """Good events, typed, from the JSON payload."""
    g = good(spark, sf)
    return g.select("offset", "key", "event_id", "event_type", "user_id", "amount", "payment_method", "page", "device_os",
                    "device_app_ver", _ntz("event_time").alias("event_time"))


@query("stream_dlq", stream_sql('SELECT "offset", key, value, reason FROM pr WHERE reason IS NOT NULL'))
def stream_dlq(spark, sf):
    """Dead-letter rows with a reason (broken JSON, missing id, bad or incomplete time)."""
    return ev.dead_letters(parsed(spark, sf)).select("offset", "key", "value", "reason")


@query("struct_flatten", stream_sql('SELECT "offset", event_id, device_os, device_app_ver FROM good'))
def struct_flatten(spark, sf):
    """device{os, app_ver} -> device_os, device_app_ver."""
    env = ev.envelope_project(frames(spark, sf))
    p = ev.parse_events(env).where(F.col("reason").isNull())
    flat = p.select("offset", F.col("json.event_id").alias("event_id"), F.col("json.device").alias("device"))
    from ledgerline.operators.shape import flatten_struct
    return flatten_struct(flat, "device")


@query("stream_dedupe", stream_sql('SELECT "offset", event_id, event_type, event_time FROM first'))
def stream_dedupe(spark, sf):
    """T3 batch twin: first arrival per event id (re-sent copies dropped)."""
    d = ev.first_arrival(good(spark, sf))
    return d.select("offset", "event_id", "event_type", _ntz("event_time").alias("event_time"))


@query("late_events", stream_sql(f"""
SELECT "offset", event_id, event_time, watermark_ts FROM (
  SELECT *, max(event_time) OVER (ORDER BY ingest_ts, "partition", "offset" ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
            - INTERVAL {WATERMARK_SECONDS} SECOND AS watermark_ts FROM good)
WHERE event_time < watermark_ts"""))
def late_events(spark, sf):
    """T4: rows a 10-minute watermark drops (older than the max seen minus the delay)."""
    late = ev.late_events(good(spark, sf), "event_time", WATERMARK_SECONDS)
    return late.select("offset", "event_id", _ntz("event_time").alias("event_time"), _ntz("watermark_ts").alias("watermark_ts"))


@query("event_partitions", stream_sql("""
SELECT "offset", event_id, strftime(event_time, '%Y-%m-%d') AS dt, strftime(event_time, '%H') AS hh FROM first"""))
def event_partitions(spark, sf):
    """Dt and hh partition values of deduplicated events."""
    d = ev.event_partitions(ev.first_arrival(good(spark, sf)))
    return d.select("offset", "event_id", F.date_format("dt", "yyyy-MM-dd").alias("dt"), "hh")


@query("events_by_window", stream_sql("""
SELECT date_trunc('hour', event_time) AS window_start, event_type, count(*) AS n_events,
       CAST(sum(CAST(amount AS DECIMAL(18,2))) AS DOUBLE) AS total_amount
FROM first GROUP BY 1, 2"""))
def events_by_window(spark, sf):
    """Hourly event counts per type (tumbling windows)."""
    c = ev.counts_by_window(ev.first_arrival(good(spark, sf)), "event_time", "1 hour")
    return c.select(F.col("w.start").cast("timestamp_ntz").alias("window_start"), "event_type", "n_events",
                    F.col("total_amount").cast("double").alias("total_amount"))


@query("alert_bad_rate", stream_sql(f"""
SELECT * FROM (
  SELECT "offset" // {BATCH_OFFSETS} AS batch_id, count(*) AS n_total,
         CAST(sum(CASE WHEN reason IS NOT NULL THEN 1 ELSE 0 END) AS BIGINT) AS n_bad,
         sum(CASE WHEN reason IS NOT NULL THEN 1 ELSE 0 END) / count(*) AS bad_rate, 'BAD_RATE' AS alert_type
  FROM pr GROUP BY 1) WHERE bad_rate > {BAD_RATE_THRESHOLD}"""))
def alert_bad_rate(spark, sf):
    """Dead-letter share per micro-batch above 2 % -> alert row."""
    p = parsed(spark, sf)
    return ev.bad_rate_alerts(p, F.floor(F.col("offset") / BATCH_OFFSETS), BAD_RATE_THRESHOLD)


@query("alert_zero_events", stream_sql(f"""
SELECT slot_start, 'ZERO_EVENTS' AS alert_type FROM (
  SELECT unnest(generate_series(lo, hi, INTERVAL 10 MINUTE)) AS slot_start
  FROM (SELECT {_slot_sql('min(event_time)')} AS lo, {_slot_sql('max(event_time)')} AS hi FROM first))
WHERE slot_start NOT IN (SELECT DISTINCT {_slot_sql('event_time')} FROM first)"""))
def alert_zero_events(spark, sf):
    """10-minute slots with no events between the first and last one."""
    z = ev.zero_event_alerts(ev.first_arrival(good(spark, sf)), "event_time", 600)
    return z.select(_ntz("slot_start").alias("slot_start"), "alert_type")


@query("json_parse_events", """
SELECT event_id, CAST(json_extract(props, '$.k') AS BIGINT) AS k FROM events""")
def json_parse_events(spark, sf):
    """typed field out of the events' JSON props."""
    e = table(spark, sf, "events").select("event_id", "props")
    return ev.parse_props(e, "props", "k bigint").select("event_id", "k")


# ------------------------------------------------------------------ streams, run to the end of the feed

MARK_SQL = f"""
SELECT *, max(event_time) OVER (ORDER BY ingest_ts, "partition", "offset" ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
          - INTERVAL {WATERMARK_SECONDS} SECOND AS watermark_ts FROM good"""
#: Kept rows of the feed: on time, first arrival of their id. Rejected, late and copied ones complete the input.
FEED_SQL = """
SELECT 'good' AS kind, "offset", event_id, event_time, CAST(NULL AS TIMESTAMP) AS watermark_ts, CAST(NULL AS VARCHAR) AS reason FROM (
  SELECT *, row_number() OVER (PARTITION BY event_id ORDER BY ingest_ts, "partition", "offset") AS rn FROM marked
  WHERE watermark_ts IS NULL OR event_time >= watermark_ts) WHERE rn = 1
UNION ALL SELECT 'late', "offset", event_id, event_time, watermark_ts, NULL FROM marked WHERE event_time < watermark_ts
UNION ALL SELECT 'dead', "offset", NULL, NULL, NULL, reason FROM pr WHERE reason IS NOT NULL"""


def run_feed(spark, sf, parts: int = 3) -> EventFeed:
    """The feed through the one-read query, which restarts after each part."""
    base = scratch(spark, "feed")
    feed = EventFeed(f"{base}/tables", WATERMARK_SECONDS, BAD_RATE_THRESHOLD, partition_by=("dt",))
    for _ in arrivals(frames(spark, sf), "timestamp", f"{base}/in", parts):
        feed.start(ev.read_envelope_files(spark, f"{base}/in"), f"{base}/checkpoint").awaitTermination()
    return feed


@query("stream_late_table", with_views(FEED_SQL, ["v_raw_events"], [*STREAM_CTES, ("marked", MARK_SQL)]))
def stream_late_table(spark, sf):
    """One streaming read, all its sinks: events kept, late rows stored
    with the watermark they missed, dead letters."""
    feed = run_feed(spark, sf)
    none = F.lit(None)
    cols = lambda kind, **c: [F.lit(kind).alias("kind"), "offset", *[c.get(n, none.cast(t)).alias(n) for n, t in (
        ("event_id", "string"), ("event_time", "timestamp_ntz"), ("watermark_ts", "timestamp_ntz"), ("reason", "string"))]]
    good = feed.read(spark, "good").select(cols("good", event_id=F.col("event_id"), event_time=_ntz("event_time")))
    late = feed.read(spark, "late").select(cols("late", event_id=F.col("event_id"), event_time=_ntz("event_time"), watermark_ts=_ntz("watermark_ts")))
    dead = feed.read(spark, "dead").select(cols("dead", reason=F.col("reason")))
    return good.unionByName(late).unionByName(dead)


@query("stream_empty_slots", stream_sql(f"""
SELECT event_type, slot_start, 'ZERO_EVENTS' AS alert_type FROM (
  SELECT event_type, unnest(generate_series(lo, hi, INTERVAL 10 MINUTE)) AS slot_start
  FROM (SELECT event_type, {_slot_sql('min(event_time)')} AS lo FROM good GROUP BY event_type),
       (SELECT max(event_time) - INTERVAL 1 HOUR AS mark, {_slot_sql("max(event_time) - INTERVAL 1 HOUR")} - INTERVAL 10 MINUTE AS hi FROM good)) s
WHERE NOT EXISTS (SELECT 1 FROM (SELECT DISTINCT event_type, {_slot_sql('event_time')} AS slot FROM good) g
                  WHERE g.event_type = s.event_type AND g.slot = s.slot_start)"""))
def stream_empty_slots(spark, sf):
    """Per event type, the 10-minute slots that closed without an event
    (keyed state and event-time timers); the stream restarts once."""
    base = scratch(spark, "slots")
    good_rows = good(spark, sf).select("event_type", "event_time", "kafka_ingest_ts")
    for _ in arrivals(good_rows, "kafka_ingest_ts", f"{base}/in", 2):
        stream = spark.readStream.schema(good_rows.schema).parquet(f"{base}/in")
        with state_on_disk(spark):
            q = (empty_slots(stream, "event_time", "event_type", 600, "1 hour").writeStream.format("parquet").option("path", f"{base}/out")
                 .option("checkpointLocation", f"{base}/checkpoint").trigger(availableNow=True).start())
        q.awaitTermination()
    out = spark.read.schema("event_type string, slot_start timestamp, alert_type string").parquet(f"{base}/out")
    return out.withColumn("slot_start", _ntz("slot_start"))


def order_feed(spark, sf) -> DataFrame:
    """Orders as a feed: some rows sent twice, some with a priority that is no number."""
    o = table(spark, sf, "orders").select(
        F.col("o_orderkey").alias("order_key"), F.col("o_custkey").alias("buyer_key"), F.col("o_orderdate").cast("timestamp").alias("placed_at"),
        F.when(F.col("o_orderkey") % 89 == 0, F.lit("unknown")).otherwise(F.col("o_orderpriority")).alias("priority"),
        F.col("o_totalprice").cast("double").alias("price"))
    return o.unionByName(o.where("order_key % 20 = 3"))


@query("spec_stream_orders", """
WITH f AS (SELECT o_orderkey AS order_key, o_custkey AS buyer_key, CASE WHEN o_orderkey % 89 = 0 THEN 'unknown' ELSE o_orderpriority END AS priority,
                  CAST(CAST(o_totalprice AS DOUBLE) AS DECIMAL(18,2)) AS price, strftime(o_orderdate, '%Y-%m') AS month
           FROM orders WHERE o_custkey IS NOT NULL)
SELECT order_key, buyer_key, TRY_CAST(substr(priority, 1, 1) AS INTEGER) AS urgency, CAST(price AS DOUBLE) AS price, month,
       CASE WHEN TRY_CAST(substr(priority, 1, 1) AS INTEGER) IS NULL AND priority IS NOT NULL THEN 'CAST:urgency' END AS reason FROM f""")
def spec_stream_orders(spark, sf):
    """A spec in streaming mode (watermark, dedupe, contract, dead letters),
    run again after each part of the feed has arrived."""
    base = scratch(spark, "order-feed")
    for i in arrivals(order_feed(spark, sf), "placed_at", f"{base}/{S.ORDER_FEED_SPEC['source']['path']}", 3):
        run_spec(spark, S.ORDER_FEED_SPEC, base, f"{base}/out", {"run_id": f"r{i}", "run_dt": "2024-01-01"})
    tables = tables_of(S.ORDER_FEED_SPEC, f"{base}/out")
    fields = "order_key bigint, buyer_key bigint, urgency int, price double, month string"
    good_rows = tables.read(spark, TARGET).select("order_key", "buyer_key", "urgency", F.col("price").cast("double").alias("price"), "month",
                                                  F.lit(None).cast("string").alias("reason"))
    dead = tables.read(spark, DEAD).select(F.from_json("value", fields.replace("urgency int", "urgency string")).alias("v"), "reason")
    return good_rows.unionByName(dead.select("v.order_key", "v.buyer_key", F.lit(None).cast("int").alias("urgency"), "v.price", "v.month", "reason"))
