"""Structured Streaming: file-fed Kafka frames through the real stream operators."""

import os

from pyspark.sql import functions as F

from ledgerline.plans import q_stream
from ledgerline.streaming import events as ev

from .conftest import SF_SMALL


def _write_feed(spark, src_dir, n_files=3):
    """The fixture feed as Kafka frames, split into files in arrival order."""
    fr = q_stream.frames(spark, SF_SMALL).withColumn("__part", F.ntile(n_files).over(
        __import__("pyspark.sql", fromlist=["Window"]).Window.orderBy("timestamp", "partition", "offset")))
    parts = []
    for i in range(1, n_files + 1):
        d = os.path.join(src_dir, f"part{i}")
        fr.where(F.col("__part") == i).drop("__part").coalesce(1).write.parquet(d)
        parts.append(d)
    return parts


def test_pipeline_good_dlq_and_restart(spark, tmp):
    src, feed = os.path.join(tmp, "src"), os.path.join(tmp, "feed")
    out, dlq, ckpt, alerts = (os.path.join(tmp, x) for x in ("out", "dlq", "ckpt", "alerts"))
    parts = _write_feed(spark, src)
    os.makedirs(feed)
    metrics = []
    # First run sees the first two files, a restart from the checkpoint sees the third.
    for i, p in enumerate(parts):
        for f in os.listdir(p):
            if f.endswith(".parquet"):
                os.link(os.path.join(p, f), os.path.join(feed, f"f{i}-{f}"))
        if i == 0:
            continue
        if i == 2:  # an event far older than the watermark of the first run
            old = q_stream.frames(spark, SF_SMALL).limit(1).withColumn("value", F.lit(
                '{"event_id":"late1","event_ts":"2024-01-01T00:00:00+00:00"}').cast("binary"))
            old.coalesce(1).write.parquet(os.path.join(src, "late"))
            for f in os.listdir(os.path.join(src, "late")):
                if f.endswith(".parquet"):
                    os.link(os.path.join(src, "late", f), os.path.join(feed, f"late-{f}"))
        frames = ev.read_envelope_files(spark, feed)
        qg, qb = ev.start_event_pipeline(frames, out, dlq, ckpt, alerts_path=alerts, bad_rate=0.001,
                                         on_metrics=lambda b, m: metrics.append((b, m)))
        qg.awaitTermination(120)
        qb.awaitTermination(120)
        assert qg.exception() is None and qb.exception() is None
        dropped = sum(ev.late_drop_count(p) for p in qg.recentProgress)
    # the restart's batch sees the watermark of the first run: the old event is
    # dropped and counted
    assert dropped > 0

    batch_dlq = q_stream.stream_dlq(spark, SF_SMALL)
    got_dlq = spark.read.parquet(dlq)
    assert got_dlq.count() == batch_dlq.count()
    assert sorted(r.reason for r in got_dlq.select("reason").distinct().collect()) == \
        ["BAD_TIMESTAMP", "MISSING_REQUIRED", "SCHEMA_PARSE_FAILED"]

    good = spark.read.parquet(out)
    # no event id twice, partitions present, and every written id is a good event
    assert good.groupBy("event_id").count().where("count > 1").count() == 0
    assert {"dt", "hh", "batch_id"} <= set(good.columns)
    twin = q_stream.stream_dedupe(spark, SF_SMALL)
    assert good.join(twin, "event_id", "left_anti").count() == 0
    # late rows (per the batch twin) can only be missing, never extra
    assert good.count() <= twin.count()
    assert metrics, "foreachBatch reported no batches"
    # alerts count input rows: no batch was empty, every batch had bad rows
    kinds = {r.alert_type for r in spark.read.parquet(alerts).collect()}
    assert kinds == {"BAD_RATE"}
    # one closed hour moved out of the landing area, twice (as after a crash)
    hour = good.groupBy("dt", "hh").count().orderBy(F.desc("count")).first()
    table, dt = os.path.join(tmp, "events"), str(hour.dt)
    hh = f"{int(hour.hh):02d}"
    before = good.where((F.col("dt") == hour.dt) & (F.col("hh") == hour.hh)).count()
    from ledgerline.sources import sinks
    sinks.compact_hour(spark, out, table, dt, hh)
    assert spark.read.parquet(table).count() == before
    assert not os.path.exists(os.path.join(out, f"dt={dt}", f"hh={hh}"))


def test_dedupe_within_watermark_evicts_state(spark, tmp):
    rows = [("e1", "2024-01-01 00:00:00"), ("e1", "2024-01-01 00:01:00"), ("e2", "2024-01-01 00:30:00"),
            ("e3", "2024-01-01 00:40:00"), ("e1", "2024-01-01 02:00:00")]
    src = os.path.join(tmp, "dd")
    for i, (eid, ts) in enumerate(rows):  # one file a trigger, in order
        spark.createDataFrame([(eid, ts)], "event_id string, ts string").withColumn(
            "event_time", F.to_timestamp("ts")).drop("ts").coalesce(1).write.parquet(os.path.join(src, f"b{i}"))
    stream = (spark.readStream.schema("event_id string, event_time timestamp").option("maxFilesPerTrigger", 1)
              .parquet(os.path.join(src, "*")))
    q = (ev.dedupe_stream(stream, delay="10 minutes").writeStream.format("memory").queryName("dd_out")
         .option("checkpointLocation", os.path.join(tmp, "ck")).trigger(availableNow=True).start())
    q.awaitTermination(120)
    got = sorted((r.event_id, str(r.event_time)) for r in spark.table("dd_out").collect())
    # the copy one minute later is dropped; e1 two hours later is a new event, as
    # the watermark has passed its first sighting and evicted it
    assert got == [("e1", "2024-01-01 00:00:00"), ("e1", "2024-01-01 02:00:00"), ("e2", "2024-01-01 00:30:00"),
                   ("e3", "2024-01-01 00:40:00")]
    assert sum(op.get("numRowsRemoved", 0) for p in q.recentProgress for op in p["stateOperators"]) > 0


def test_windowed_counts_stream_equals_batch(spark, tmp):
    good = q_stream.good(spark, SF_SMALL).select("event_id", "event_type", "amount", "event_time", "offset")
    src = os.path.join(tmp, "win")
    good.write.parquet(src)
    stream = spark.readStream.schema(good.schema).parquet(src)
    agg = ev.counts_by_window(stream, "event_time", "1 hour")  # sets its own watermark
    assert "EventTimeWatermark" in agg._jdf.queryExecution().logical().toString()
    q = (agg.writeStream.outputMode("complete").format("memory").queryName("win_out")
         .option("checkpointLocation", os.path.join(tmp, "ckw")).trigger(availableNow=True).start())
    q.awaitTermination(120)
    s = {(r.w.start, r.event_type, r.n_events) for r in spark.table("win_out").collect()}
    b = {(r.w.start, r.event_type, r.n_events) for r in ev.counts_by_window(good, "event_time", "1 hour").collect()}
    assert s == b


def test_late_events_block_size_does_not_matter(spark):
    g = q_stream.good(spark, SF_SMALL)
    day = F.floor(F.unix_seconds("kafka_ingest_ts") / F.lit(86400))
    a = {r.offset for r in ev.late_events(g, "event_time", 600, blocks_of=3).select("offset").collect()}
    b = {r.offset for r in ev.late_events(g, "event_time", 600, block=day).select("offset").collect()}
    assert a == b and len(a) > 0


def test_late_drop_count_reads_progress():
    assert ev.late_drop_count({"stateOperators": [{"numRowsDroppedByWatermark": 3}, {}]}) == 3
    assert ev.late_drop_count(None) == 0


def test_parse_reasons_on_hand_made_rows(spark):
    rows = [
        (0, '{"event_id":"e1","event_ts":"2024-01-01T00:00:00+00:00","amount":1.5}', None),
        (1, '{"event_id":"e2","event_ts":"2024-01-01T00:00:00Z","amount":"lots"}', "SCHEMA_PARSE_FAILED"),
        (2, '{"event_id":', "SCHEMA_PARSE_FAILED"),
        (3, '{"event_ts":"2024-01-01T00:00:00+00:00"}', "MISSING_REQUIRED"),
        (4, '{"event_id":"e5","event_ts":"yesterday"}', "BAD_TIMESTAMP"),
        (5, None, "SCHEMA_PARSE_FAILED"),
        (6, '{"event_id":"e7","event_ts":"2024-01-01 10:00:00"}', None),
        (7, '{"event_id":"e8","event_ts":"12:30:00"}', "BAD_TIMESTAMP"),
        (8, '{"event_id":"e9","event_ts":"T10:00"}', "BAD_TIMESTAMP"),
        (9, '{"event_id":"e10","event_ts":"2024"}', "BAD_TIMESTAMP"),
        (10, '{"event_id":"e11","event_ts":"2024-13-01T00:00:00Z"}', "BAD_TIMESTAMP"),
        (11, '{"event_id":"e12","event_ts":"2024-01-01T00:00:00.25+01:00","payment_method":"card"}', None),
    ]
    env = spark.createDataFrame([(o, v) for o, v, _ in rows], "offset bigint, value string")
    got = {r.offset: r.reason for r in ev.parse_events(env).select("offset", "reason").collect()}
    assert got == {o: want for o, _, want in rows}
    t = ev.good_events(ev.parse_events(env)).where("offset = 0").first().event_time
    assert str(t).startswith("2024-01-01 00:00:00")


def test_streamed_upserts_equal_batch_merge(spark, tmp):
    from ledgerline.operators import change as ch
    from ledgerline.plans.fixtures import view
    from ledgerline.sources import sinks

    target = view(spark, SF_SMALL, "v_inventory")
    delta = view(spark, SF_SMALL, "v_inventory_delta")
    table = os.path.join(tmp, "inventory")
    sinks.publish_buckets(target, table, "seed", ["product_id", "warehouse_id"], 64)
    src = os.path.join(tmp, "deltas")
    for seq in (1, 2):  # later files carry later sequence numbers
        delta.where(F.col("seq") == seq).coalesce(1).write.parquet(os.path.join(src, f"seq{seq}"))
    stream = spark.readStream.schema(delta.schema).option("maxFilesPerTrigger", 1).parquet(os.path.join(src, "*"))
    writer = sinks.foreach_batch_upsert(table, ["product_id", "warehouse_id"], buckets=64)
    q = (stream.writeStream.foreachBatch(writer).option("checkpointLocation", os.path.join(tmp, "ck"))
         .trigger(availableNow=True).start())
    q.awaitTermination(120)
    want = ch.cdc_merge(target, delta, ["product_id", "warehouse_id"])
    got = sinks.read_current(spark, table)
    assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0
    # replaying the last batch does not apply it twice
    last = sinks.current_version(spark, table)
    writer(delta.where(F.col("seq") == 2), int(last[1:]))
    again = sinks.read_current(spark, table)
    assert again.exceptAll(want).count() == 0 and want.exceptAll(again).count() == 0
    # a batch of one key rewrites one bucket; the others stay where they are, and
    # versions nothing needs are gone
    one = delta.where(F.col("op") != "D").orderBy("product_id", "warehouse_id", "seq").limit(1)
    writer(one, 99)
    folder, _ = sinks.pointer(spark, table)
    assert len([n for n in os.listdir(os.path.join(table, folder)) if n.startswith(sinks.BUCKET)]) == 1
    assert sinks.read_current(spark, table).count() == ch.cdc_merge(want, one, ["product_id", "warehouse_id"]).count()
    assert len(os.listdir(os.path.join(table, sinks.POINTERS))) <= 4  # two pointers and their checksums


from hypothesis import HealthCheck, given, settings  # noqa: E402
from hypothesis import strategies as st  # noqa: E402


@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(secs=st.lists(st.integers(0, 7200), min_size=1, max_size=40), block=st.integers(1, 9))
def test_late_events_match_brute_force(spark, secs, block):
    import datetime as dt

    t0 = dt.datetime(2024, 1, 1)
    rows = [(i, t0 + dt.timedelta(seconds=s)) for i, s in enumerate(secs)]
    want, seen = set(), None
    for off, ts in rows:
        if seen is not None and ts < seen - dt.timedelta(seconds=600):
            want.add(off)
        seen = ts if seen is None else max(seen, ts)
    df = spark.createDataFrame(rows, "offset bigint, event_time timestamp")
    late = ev.late_events(df, "event_time", 600, order=("offset",), block=F.floor(F.col("offset") / F.lit(block)), blocks_of=3)
    got = {r.offset for r in late.collect()}
    assert got == want


@settings(max_examples=10, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(secs=st.lists(st.integers(0, 3 * 86400), min_size=1, max_size=30))
def test_zero_event_slots_match_brute_force(spark, secs):
    import datetime as dt

    t0 = dt.datetime(2024, 1, 1)
    slots = {s // 600 for s in secs}
    want = {t0 + dt.timedelta(seconds=600 * k) for k in range(min(slots), max(slots) + 1) if k not in slots}
    df = spark.createDataFrame([(t0 + dt.timedelta(seconds=s),) for s in secs], "event_time timestamp")
    got = {r.slot_start for r in ev.zero_event_alerts(df, "event_time", 600, partitions=3).collect()}
    assert got == want


def test_dedupe_on_rocksdb_state_store(spark, tmp):
    """The state store the scale settings recommend runs the same dedupe."""
    from ledgerline.session import scale_conf

    key = "spark.sql.streaming.stateStore.providerClass"
    old = spark.conf.get(key, None)
    spark.conf.set(key, scale_conf(1 << 30, 8)[key])
    try:
        src = os.path.join(tmp, "rk")
        spark.createDataFrame([("e1", "2024-01-01 00:00:00"), ("e1", "2024-01-01 00:02:00"), ("e2", "2024-01-01 00:05:00")],
                              "event_id string, ts string").withColumn("event_time", F.to_timestamp("ts")).drop("ts") \
            .write.parquet(src)
        stream = spark.readStream.schema("event_id string, event_time timestamp").parquet(src)
        q = (ev.dedupe_stream(stream).writeStream.format("memory").queryName("rk_out")
             .option("checkpointLocation", os.path.join(tmp, "ckr")).trigger(availableNow=True).start())
        q.awaitTermination(120)
        assert sorted(r.event_id for r in spark.table("rk_out").collect()) == ["e1", "e2"]
    finally:
        if old is None:
            spark.conf.unset(key)
        else:
            spark.conf.set(key, old)
