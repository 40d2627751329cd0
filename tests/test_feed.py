"""One-read feed, slots and streaming specs: real streams with restarts and crashes."""

import os

import pytest
from pyspark.sql import functions as F

from ledgerline.plans import q_stream
from ledgerline.plans import specs as S
from ledgerline.plans.spec import check_spec, run_spec
from ledgerline.plans.stream_spec import DEAD, TARGET, start_stream_spec, stream_spec_batch, tables_of
from ledgerline.sources import sinks
from ledgerline.streaming import events as ev
from ledgerline.streaming.feed import EventFeed
from ledgerline.streaming.slots import empty_slots, state_on_disk

from .conftest import SF_SMALL


def offsets(df):
    return sorted(r["offset"] for r in df.select("offset").collect())


def feed_over(spark, tmp, parts, name="f", crash=None, monkeypatch=None):
    """Runs the feed part by part; ``crash`` (part, table) fails that write once."""
    feed = EventFeed(os.path.join(tmp, name), 600, 0.001, partition_by=("dt",))
    src = os.path.join(tmp, name + "-in")
    queries = []
    for i in q_stream.arrivals(q_stream.frames(spark, SF_SMALL), "timestamp", src, parts):
        frames = ev.read_envelope_files(spark, src)
        if crash and crash[0] == i:
            real = sinks.write_table

            def failing(df, path, *a, **k):
                if path.endswith(crash[1]):
                    raise OSError("disk full")
                real(df, path, *a, **k)

            before = {t: (feed.read(spark, t).count() if feed.read(spark, t) is not None else 0) for t in ("good", "dead", "late")}
            monkeypatch.setattr(sinks, "write_table", failing)
            with pytest.raises(Exception, match="disk full"):
                feed.start(frames, os.path.join(tmp, name + "-ck")).awaitTermination(120)
            monkeypatch.setattr(sinks, "write_table", real)
            after = {t: (feed.read(spark, t).count() if feed.read(spark, t) is not None else 0) for t in ("good", "dead", "late")}
            assert after == before, "a half batch is visible"
        q = feed.start(frames, os.path.join(tmp, name + "-ck"))
        q.awaitTermination(120)
        assert q.exception() is None
        queries.append(q)
    return feed, queries


def test_a_feed_of_one_split_arrives_in_several_files(spark, tmp):
    path = os.path.join(tmp, "in")
    rows = spark.range(0, 100_000, 1, 1).select("id", F.timestamp_seconds("id").alias("at"), F.sha2(F.col("id").cast("string"), 512).alias("text"))
    rows = rows.unionByName(rows.where("id % 10 = 3").select(F.lit(None).cast("bigint").alias("id"), "at", F.lit(None).cast("string").alias("text")))
    seen = 0
    for _ in q_stream.arrivals(rows, "at", path, 2):
        files = spark.read.parquet(path).groupBy(F.input_file_name()).count().collect()
        total = sum(r["count"] for r in files)
        assert max(r["count"] for r in files) <= 0.6 * (total - seen), "one task would parse most of a batch"
        seen = total
    assert spark.read.parquet(path).exceptAll(rows).count() == 0 and seen == rows.count()


@pytest.fixture(scope="module")
def reference(spark, tmp_path_factory):
    return feed_over(spark, str(tmp_path_factory.mktemp("feed")), 5)


def test_five_batches_with_restarts_keep_every_row(spark, reference):
    feed, queries = reference
    rows = q_stream.frames(spark, SF_SMALL).count()
    log = feed.tables.log(spark).collect()
    assert len(log) == 5
    written = sum(r.counts[t] for r in log for t in ("good", "dead", "late"))
    copies = sum(int(r.facts["copies"]) for r in log)
    assert written + copies == rows and sum(int(r.facts["rows_in"]) for r in log) == rows
    assert offsets(feed.read(spark, "late")) == offsets(ev.late_events(q_stream.good(spark, SF_SMALL), "event_time", 600)) != []
    # one source, read by one query
    assert all(len(p["sources"]) == 1 for q in queries for p in q.recentProgress)
    assert {r.alert_type for r in feed.read(spark, "alerts").collect()} == {"BAD_RATE"}


def test_the_cut_into_batches_does_not_matter(spark, tmp, reference):
    one, _ = feed_over(spark, tmp, 2)
    for t in ("good", "dead", "late"):
        assert offsets(one.read(spark, t)) == offsets(reference[0].read(spark, t)), t


@pytest.mark.parametrize("table", ["dead", "late", "_batches/batch_id=1"])
def test_a_crash_between_two_sinks_leaves_no_half_batch(spark, tmp, monkeypatch, reference, table):
    feed, _ = feed_over(spark, tmp, 3, crash=(1, table), monkeypatch=monkeypatch)
    for t in ("good", "dead", "late"):
        assert offsets(feed.read(spark, t)) == offsets(reference[0].read(spark, t)), t


def test_a_folder_of_another_checkpoint_raises(spark, tmp):
    feed = EventFeed(os.path.join(tmp, "f"))
    with pytest.raises(RuntimeError, match="batch log"):
        feed.write_batch(q_stream.frames(spark, SF_SMALL).limit(0), 4)
    assert feed.read(spark, "good") is None


def test_an_empty_batch_is_an_alert_and_copies_in_time_are_dropped(spark, tmp):
    feed = EventFeed(os.path.join(tmp, "f"))

    def frame(*rows):
        df = spark.createDataFrame(rows, "value string, offset long, at string")
        return df.select(F.lit(None).cast("binary").alias("key"), F.col("value").cast("binary").alias("value"), F.lit("t").alias("topic"),
                         F.lit(0).alias("partition"), "offset", F.to_timestamp("at").alias("timestamp"))

    def event(i, ts):
        return f'{{"event_id":"{i}","event_ts":"2024-01-01T{ts}+00:00"}}'

    feed.write_batch(frame((event("a", "10:00:00"), 1, "2024-01-01 10:00:00"), (event("a", "10:00:00"), 2, "2024-01-01 10:00:01")), 0)
    feed.write_batch(frame((event("a", "10:00:00"), 3, "2024-01-01 10:01:00"), (event("b", "10:20:00"), 4, "2024-01-01 10:20:00"),
                           (event("c", "10:05:00"), 5, "2024-01-01 10:21:00")), 1)
    feed.write_batch(frame((event("d", "10:09:59"), 6, "2024-01-01 10:30:00"), ("{", 7, "2024-01-01 10:30:01")), 2)
    feed.write_batch(q_stream.frames(spark, SF_SMALL).limit(0), 3)
    assert offsets(feed.read(spark, "good")) == [1, 4]
    assert offsets(feed.read(spark, "late")) == [5, 6] and offsets(feed.read(spark, "dead")) == [7]
    assert [int(r.facts["copies"]) for r in feed.tables.log(spark).orderBy("batch_id").collect()] == [1, 1, 0, 0]
    assert [(r.alert_type, r.batch_id) for r in feed.read(spark, "alerts").collect()] == [("ZERO_EVENTS", 3)]
    # a replay of a committed batch gives the same rows
    feed.write_batch(frame((event("d", "10:09:59"), 6, "2024-01-01 10:30:00"), ("{", 7, "2024-01-01 10:30:01")), 2)
    assert offsets(feed.read(spark, "late")) == [5, 6] and offsets(feed.read(spark, "dead")) == [7]


# ------------------------------------------------------------------ slots

def test_slots_of_topics_with_bounded_state(spark, tmp):
    import datetime as dt

    t0 = dt.datetime(2024, 1, 1)
    at = lambda m: t0 + dt.timedelta(minutes=m)
    # topic b falls silent after minute 15; topic c starts late; a goes on
    first = [("a", at(m)) for m in (0, 5, 11, 45)] + [("b", at(m)) for m in (3, 15)]
    second = [("a", at(m)) for m in (61, 200, 300)] + [("c", at(m)) for m in (120, 151)] + [(None, at(130))]
    src, out, ck = (os.path.join(tmp, x) for x in ("in", "out", "ck"))
    for rows in (first, second):
        spark.createDataFrame(rows, "topic string, event_time timestamp").coalesce(1).write.mode("append").parquet(src)
        stream = spark.readStream.schema("topic string, event_time timestamp").parquet(src)
        with state_on_disk(spark):
            q = (empty_slots(stream, "event_time", "topic", 600, "30 minutes").writeStream.format("parquet").option("path", out)
                 .option("checkpointLocation", ck).trigger(availableNow=True).start())
        q.awaitTermination(120)
        assert q.exception() is None
    got = {(r.topic, r.slot_start) for r in spark.read.parquet(out).collect()}
    want, mark = set(), at(300 - 30)
    for topic in ("a", "b", "c", ""):
        slots = {int((t - t0).total_seconds()) // 600 for k, t in first + second if (k or "") == topic}
        want |= {(topic, at(10 * s)) for s in range(min(slots), 27) if s not in slots and at(10 * s + 10) <= mark}
    assert got == want
    state = {o["operatorName"]: o["numRowsTotal"] for o in q.recentProgress[-1]["stateOperators"]}
    assert state["transformWithStateInPandasExec"] == 4  # one number a topic, plus timers
    assert spark.conf.get("spark.sql.streaming.stateStore.providerClass", "") != "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


# ------------------------------------------------------------------ specs as streams

RUN = {"run_id": "r1", "run_dt": "2024-01-01"}


def same(a, b):
    cols = sorted(b.columns)
    a, b = a.select(cols), b.select(cols)
    return a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_a_spec_runs_as_stream_and_as_batch(spark, tmp):
    feed = q_stream.order_feed(spark, SF_SMALL)
    src = os.path.join(tmp, "order_feed")
    counts = [run_spec(spark, S.ORDER_FEED_SPEC, tmp, os.path.join(tmp, "out"), RUN) for _ in q_stream.arrivals(feed, "placed_at", src, 3)]
    tables = tables_of(S.ORDER_FEED_SPEC, os.path.join(tmp, "out"))
    good, dead = stream_spec_batch(S.ORDER_FEED_SPEC, spark.read.schema(S.ORDER_FEED_SPEC["source"]["schema"]).parquet(src), RUN)
    assert same(tables.read(spark, TARGET).drop("batch_id"), good) and same(tables.read(spark, DEAD).drop("batch_id"), dead)
    assert sum(c["rows_in"] for c in counts) == feed.count()
    assert sum(c["rows_out"] for c in counts) == good.count() and sum(c["dead"] for c in counts) == dead.count() > 0
    # nothing new: a further run adds nothing
    assert run_spec(spark, S.ORDER_FEED_SPEC, tmp, os.path.join(tmp, "out"), RUN) == {"rows_in": 0, "rows_out": 0, "dead": 0}
    assert {r.reason for r in dead.collect()} == {"CAST:urgency"}
    log = spark.read.parquet(os.path.join(tmp, "out", "_run_log")).collect()
    assert {r.status for r in log} <= {"SUCCESS", "WARN"}


def test_windows_of_a_spec_as_stream_and_as_batch(spark, tmp):
    good = q_stream.good(spark, SF_SMALL).select("event_id", "event_type", F.col("amount").cast("double").alias("amount"), "event_time", "kafka_ingest_ts")
    first = good.where(F.col("event_id").isNotNull())
    src = os.path.join(tmp, "events")
    for _ in q_stream.arrivals(first, "kafka_ingest_ts", src, 2):
        run_spec(spark, S.HOURLY_EVENTS_SPEC, tmp, os.path.join(tmp, "out"), RUN)
    got = tables_of(S.HOURLY_EVENTS_SPEC, os.path.join(tmp, "out")).read(spark, TARGET).drop("batch_id")
    rows = spark.read.schema(S.HOURLY_EVENTS_SPEC["source"]["schema"]).parquet(src)
    want, _ = stream_spec_batch(S.HOURLY_EVENTS_SPEC, rows, RUN)
    assert got.count() > 0
    # the copies sent a day later are beyond the watermark on the stream, and copies of known ids in the batch
    assert same(got, want)


def test_a_crash_in_a_streaming_spec_is_repaired_by_the_next_run(spark, tmp, monkeypatch):
    feed = q_stream.order_feed(spark, SF_SMALL)
    src, out = os.path.join(tmp, "order_feed"), os.path.join(tmp, "out")
    real = sinks.write_table
    for i in q_stream.arrivals(feed, "placed_at", src, 2):
        if i == 1:
            def failing(df, path, *a, **k):
                if path.endswith("/dead"):
                    raise OSError("disk full")
                real(df, path, *a, **k)
            monkeypatch.setattr(sinks, "write_table", failing)
            before = tables_of(S.ORDER_FEED_SPEC, out).read(spark, TARGET).count()
            with pytest.raises(Exception, match="disk full"):
                run_spec(spark, S.ORDER_FEED_SPEC, tmp, out, {**RUN, "run_id": "failed"})
            monkeypatch.setattr(sinks, "write_table", real)
            assert tables_of(S.ORDER_FEED_SPEC, out).read(spark, TARGET).count() == before
        run_spec(spark, S.ORDER_FEED_SPEC, tmp, out, RUN)
    good, _ = stream_spec_batch(S.ORDER_FEED_SPEC, spark.read.schema(S.ORDER_FEED_SPEC["source"]["schema"]).parquet(src), RUN)
    assert same(tables_of(S.ORDER_FEED_SPEC, out).read(spark, TARGET).drop("batch_id"), good)
    log = {r.run_id: r.status for r in spark.read.parquet(os.path.join(out, "_run_log")).collect()}
    assert log["failed"] == "FAILED"


@pytest.mark.parametrize("change", [
    {"sink": {}}, {"watermark": {"column": "placed_at", "lag": "1 day"}}, {"trigger": {"continuous": "1 second"}}, {"dq": {"checks": []}},
    {"transforms": [{"name": "x", "pivot": "y"}]}])
def test_unknown_options_raise(change):
    with pytest.raises(ValueError, match="unknown"):
        check_spec({**S.ORDER_FEED_SPEC, **change})


@pytest.mark.parametrize("change,message", [
    ({"watermark": None}, "needs a watermark"), ({"dedupe": {"key": ["order_key"], "order_by": ["price desc"]}}, "first arrival"),
    ({"source": {"format": "parquet", "path": "order_feed"}}, "needs a schema"),
    ({"transforms": [{"name": "x", "group_by": ["buyer_key"], "agg": {"n": "count(1)"}}]}, "a window")])
def test_what_a_stream_cannot_do_raises(spark, tmp, change, message):
    os.makedirs(os.path.join(tmp, "order_feed"))
    with pytest.raises(ValueError, match=message):
        start_stream_spec(spark, {k: v for k, v in {**S.ORDER_FEED_SPEC, **change}.items() if v is not None}, tmp, os.path.join(tmp, "out"), RUN)


# ------------------------------------------------------------------ facts on a stream

def test_waiting_facts_are_tried_when_the_dimension_moves(spark, tmp, monkeypatch):
    from ledgerline.operators import scd2, star
    from ledgerline.streaming.facts import FactStream

    def dim(rows):
        df = spark.createDataFrame(rows, "id long, v string")
        return scd2.scd2_initial(df, ["id"], ["v"], "2024-01-02 00:00:00")

    def facts(*rows):
        return spark.createDataFrame(rows, "fact long, id long, at string").withColumn("at", F.to_timestamp("at"))

    now = {"v": ("d1", dim([(1, "a")]))}
    s = FactStream(os.path.join(tmp, "s"), lambda _: now["v"], ["id"], "at", "sk", ["v"])
    assert s.read(spark) is None
    batches = [facts((1, 1, "2024-01-03"), (2, 2, "2024-01-03"), (3, 2, "2024-01-01"), (4, None, "2024-01-03")), facts((5, 2, "2024-01-04"))]
    s.write_batch(batches[0], 0)
    state = lambda: {r.fact: r.v for r in s.read(spark).collect()}
    assert state() == {1: "a", 2: None, 3: None, 4: None}
    s.write_batch(batches[1].limit(0), 1)  # the dimension stands: nothing is tried again
    assert state() == {1: "a", 2: None, 3: None, 4: None} and s.waiting(spark).count() == 3
    now["v"] = ("d2", dim([(1, "a"), (2, "b")]))
    real = sinks.write_table

    def failing(df, path, *a, **k):
        if path.endswith("/waiting"):
            raise OSError("disk full")
        real(df, path, *a, **k)

    monkeypatch.setattr(sinks, "write_table", failing)
    with pytest.raises(OSError):
        s.write_batch(batches[1], 2)
    monkeypatch.setattr(sinks, "write_table", real)
    assert state() == {1: "a", 2: None, 3: None, 4: None}  # the half batch is not seen
    for _ in range(2):  # the batch, and its replay
        s.write_batch(batches[1], 2)
        assert state() == {1: "a", 2: "b", 3: "b", 4: None, 5: "b"} and s.read(spark).count() == 5
    every = batches[0].unionByName(batches[1])
    first = star.point_in_time_join(batches[0], dim([(1, "a")]), ["id"], "at", "sk", ["v"])
    want = star.backfill_unknown(first, now["v"][1], ["id"], "at", "sk", ["v"]).unionByName(
        star.point_in_time_join(batches[1], now["v"][1], ["id"], "at", "sk", ["v"]))
    assert same(s.read(spark), want) and every.count() == want.count()


def test_published_history_is_not_sent_to_the_driver(spark, tmp):
    """A version read from files is small to the planner, whatever its rows: it was broadcast."""
    from ledgerline.operators import scd2, star
    from ledgerline.streaming.facts import FactStream

    hist = scd2.scd2_initial(spark.range(50).withColumn("v", F.lit("a")), ["id"], ["v"], "2024-01-02 00:00:00")
    sinks.publish_version(hist, os.path.join(tmp, "dim"), "v0")

    def dimension(s):
        folder, _ = sinks.pointer(s, os.path.join(tmp, "dim"))
        return folder, sinks.read_folder(s, os.path.join(tmp, "dim"), folder)

    stream = FactStream(os.path.join(tmp, "out"), dimension, ["id"], "at", "sk")
    facts = spark.range(80).withColumn("at", F.to_timestamp(F.lit("2024-01-03")))
    joined = star.point_in_time_join(facts, stream.published(spark)[1], ["id"], "at", "sk")
    again = star.backfill_unknown(joined, stream.published(spark)[1], ["id"], "at", "sk")
    for df in (joined, again):
        assert df.where("sk <> '-1'").count() == 50
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" in plan and "Broadcast" not in plan
