"""Copy-on-write history: equal to the whole rewrite, few files a day, soft delete, reruns."""

import datetime as dt
import os
import random

import pytest
from pyspark.sql import functions as F

from ledgerline.operators import scd2
from ledgerline.plans import history, jobs
from ledgerline.plans import q_change as Q
from ledgerline.plans import specs as S
from ledgerline.plans.fixtures import view
from ledgerline.sources import sinks

from .conftest import SF_SMALL

CFG = {"business_key": ["id"], "select_expr": {"id": "id", "v": "v", "w": "w"}, "dedupe": {"key": ["id"], "order_by": ["w desc"]}, "scd2_columns": ["v"]}


def ts(day):
    return f"{dt.date(2024, 1, 1) + dt.timedelta(days=day)} 00:00:00"


def snap(spark, rows):
    return spark.createDataFrame(rows, "id long, v string, w int")


def out(df):
    cols = ["id", "v", "w", "effective_from", "effective_to", "is_current"]
    return sorted((tuple(r) for r in df.select(cols).collect()), key=str)


def parquet_files(path):
    return [os.path.join(d, f) for d, _, fs in os.walk(path) for f in fs if f.endswith(".parquet")]


def test_equals_the_replay_of_whole_tables(spark, tmp):
    path = os.path.join(tmp, "h")
    for d in (1, 2, 3):
        history.scd2_daily_buckets(spark, path, view(spark, SF_SMALL, f"v_cust_d{d}"), S.DIM_CUSTOMER_CFG, Q.RUN_TS[d], f"r{d}", buckets=16)
    want = Q.hist_out(Q.cust_history(spark, SF_SMALL, 3), Q.CUST_OUT)
    got = Q.hist_out(history.read_history(spark, path), Q.CUST_OUT)
    assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0


def test_a_day_of_clustered_changes_writes_few_files_and_drops_old_versions(spark, tmp):
    path, n = os.path.join(tmp, "h"), 4000
    base = spark.range(n).select("id", (F.col("id") % 7).cast("string").alias("v"), F.lit(1).alias("w")).persist()
    assert len(history.scd2_daily_buckets(spark, path, base, CFG, ts(0), "d0", buckets=64)) == 64
    hot = [b for b, in base.select(sinks.key_bucket(["id"], 64)).distinct().limit(2).collect()]
    day = base
    for d in range(1, 5):
        in_hot = sinks.key_bucket(["id"], 64).isin(hot)
        day = day.withColumn("v", F.when(in_hot & (F.col("id") % 3 == d % 3), F.concat(F.lit(f"d{d}-"), "v")).otherwise(F.col("v"))).persist()
        changed = day.join(base, ["id", "v"], "left_anti").count()
        assert 0 < changed <= 0.04 * n
        touched = history.scd2_daily_buckets(spark, path, day, CFG, ts(d), f"d{d}", buckets=64)
        folder, _ = sinks.pointer(spark, path)
        live = sum(len(parquet_files(os.path.join(path, f, f"{sinks.BUCKET}={b}"))) for b, f in sinks._manifest(spark, path, folder)[1].items())
        written = len([f for f in parquet_files(os.path.join(path, folder)) if sinks.BUCKET in f])
        assert sorted(touched) == sorted(hot) and written < 0.05 * live
        base = day
    # an equal day writes no bucket at all
    assert history.scd2_daily_buckets(spark, path, day, CFG, ts(5), "d5", buckets=64) == []
    # every bucket is one file still, and what no kept version names is gone
    places = sinks._manifest(spark, path, sinks.pointer(spark, path)[0])[1]
    assert len(set(places.values())) == 2 and len(places) == 64
    assert not {"v=d1.a1", "v=d2.a1"} & set(sinks._versions(spark, path))
    assert len(sinks.folders(spark, path)) == 2
    whole = history.read_history(spark, path)
    assert whole.where("is_current").count() == n and whole.groupBy("id").agg(F.count_if("is_current").alias("c")).where("c <> 1").count() == 0


def plain(days, after):
    """Day by day over whole lists; ``after``: days of absence that close a key."""
    hist, seen = {}, {}
    for d, rows in days:
        now = {}
        for i, v, w in rows:
            if i is not None and (i not in now or w > now[i][1]):
                now[i] = (v, w)
        for i, (v, w) in now.items():
            versions = hist.setdefault(i, [])
            if versions and versions[-1][3] is None:
                if versions[-1][0] == v:
                    seen[i] = d
                    continue
                versions[-1][3] = d
            versions.append([v, w, d, None])
            seen[i] = d
        for i, versions in hist.items():
            if i not in now and versions[-1][3] is None and after is not None and d - seen[i] >= after:
                versions[-1][3] = d
    at = lambda d: dt.datetime(2024, 1, 1) + dt.timedelta(days=d)
    return sorted(((i, v, w, at(a), at(b) if b is not None else dt.datetime(9999, 12, 31), b is None)
                   for i, vs in hist.items() for v, w, a, b in vs), key=str)


@pytest.mark.parametrize("after", [None, 1, 3])
def test_soft_delete_over_a_replay_with_retries_and_gaps(spark, tmp, after):
    rng = random.Random(after or 0)
    path = os.path.join(tmp, "h")
    days, alive = [], {i: "a" for i in range(40)}
    for d in (0, 1, 2, 4, 5, 9, 10):  # some days have no run
        for i in rng.sample(range(45), 6):
            alive[i] = rng.choice("abc")
        for i in rng.sample(range(45), 5):
            alive.pop(i, None)
        rows = [(i, v, 2) for i, v in alive.items()] + [(i, "stale", 1) for i in rng.sample(sorted(alive), 3)] + [(None, "x", 1)]
        days.append((d, rows))
    # an equal day: closings fall due without a change in the snapshot
    days += [(11, days[-1][1]), (14, days[-1][1])]
    for k, (d, rows) in enumerate(days):
        if k == 3:  # a first attempt with another snapshot, then the right one under another id, and that one again
            history.scd2_daily_buckets(spark, path, snap(spark, rows[5:]), CFG, ts(d), "wrong", buckets=8, close_after_days=after)
        for run_id in ([f"d{d}"] if k != 3 else [f"d{d}", f"d{d}"]):
            history.scd2_daily_buckets(spark, path, snap(spark, rows), CFG, ts(d), run_id, buckets=8, close_after_days=after)
    assert out(history.read_history(spark, path)) == plain(days, after)


def test_closing_equals_the_operators_in_one_pass(spark, tmp):
    path = os.path.join(tmp, "h")
    days = [(d, [(i, "a", 1) for i in range(30) if (i + d) % 5 or d == 0]) for d in range(4)]
    hist = seen = None
    for d, rows in days:
        history.scd2_daily_buckets(spark, path, snap(spark, rows), CFG, ts(d), f"d{d}", buckets=4, close_after_days=1)
        day = snap(spark, rows)
        seen = scd2.last_seen(seen, day, ["id"], "dt", ts(d)[:10])
        hist = jobs.scd2_load(hist, day, CFG, ts(d))
        hist = scd2.close_keys(hist, scd2.soft_delete_keys(seen, ["id"], "dt", ts(d)[:10], 1), ["id"], ts(d))
    assert out(history.read_history(spark, path)) == out(hist)


def test_what_it_refuses(spark, tmp):
    path = os.path.join(tmp, "h")
    rows = snap(spark, [(1, "a", 1)])
    history.scd2_daily_buckets(spark, path, rows, CFG, ts(1), "d1", buckets=4)
    with pytest.raises(ValueError, match="older"):
        history.scd2_daily_buckets(spark, path, rows, CFG, ts(0), "d0", buckets=4)
    with pytest.raises(ValueError, match="rebuild"):
        history.scd2_daily_buckets(spark, path, rows, CFG, ts(2), "d2", buckets=8)
    with pytest.raises(ValueError, match="on_missing"):
        history.scd2_daily_buckets(spark, path, rows, CFG, ts(2), "d2", buckets=4, on_missing="close", close_after_days=2)
    empty = rows.limit(0)
    assert history.scd2_daily_buckets(spark, path, empty, CFG, ts(2), "d2", buckets=4, on_missing="close") != []
    assert history.read_history(spark, path).where("is_current").count() == 0


def test_digests_see_nulls_and_not_the_order(spark):
    one = snap(spark, [(1, None, 1), (2, "a", 2), (2, "a", 2)])
    other = snap(spark, [(2, "a", 2), (2, "a", 2), (1, None, 1)]).repartition(3)
    assert history.bucket_digests(one, ["id"], ["v", "w"], 4) == history.bucket_digests(other, ["id"], ["v", "w"], 4)
    a, b = (spark.createDataFrame([r], "id long, v string, u string") for r in ((1, None, "x"), (1, "x", None)))
    assert history.bucket_digests(a, ["id"], ["v", "u"], 4) != history.bucket_digests(b, ["id"], ["v", "u"], 4)
    assert history.rejected(snap(spark, [(None, "a", 1), (1, "b", 1)]), CFG).count() == 1


def test_stored_snapshots_join_only_what_differs(spark, tmp):
    path, n = os.path.join(tmp, "s"), 3000
    day = spark.range(n).select("id", (F.col("id") % 5).cast("string").alias("v"), F.lit(1).alias("w"))
    assert history.publish_snapshot(spark, path, day, ["id"], "d0", 32)[0] is None
    from ledgerline.operators.change import snapshot_diff
    hot = day.select(sinks.key_bucket(["id"], 32)).first()[0]
    in_hot = sinks.key_bucket(["id"], 32) == hot
    new = day.where(~(in_hot & (F.col("id") % 7 == 0))).withColumn("v", F.when(in_hot & (F.col("id") % 3 == 0), F.lit(None)).otherwise(F.col("v")))
    changes, touched = history.publish_snapshot(spark, path, new, ["id"], "d1", 32)
    want = snapshot_diff(day, new, ["id"], ["v", "w"])
    assert touched == [hot] and want.count() > 0
    assert changes.exceptAll(want).count() == 0 and want.exceptAll(changes).count() == 0
    # the scan holds the one bucket of both snapshots and no other
    assert {f.split(f"{sinks.BUCKET}=")[1].split("/")[0] for f in changes.inputFiles()} == {str(hot)}
    same, touched = history.publish_snapshot(spark, path, new, ["id"], "d2", 32)
    assert touched == [] and same.count() == 0
    back = sinks.read_current(spark, path)
    assert back.exceptAll(new).count() == 0 and new.exceptAll(back).count() == 0
    # a retry of a version builds on the one before it
    again, touched = history.publish_snapshot(spark, path, day, ["id"], "d2", 32)
    assert touched == [hot] and again.count() == want.count()
    with pytest.raises(ValueError, match="other keys"):
        history.publish_snapshot(spark, path, new.drop("w"), ["id"], "d3", 32)


def test_an_indexed_copy_reads_fewer_row_groups(spark, tmp):
    from ledgerline.operators import shape

    plain, indexed = os.path.join(tmp, "plain"), os.path.join(tmp, "indexed")
    rows = spark.range(60_000).select(F.col("id").alias("k"), (F.xxhash64("id") % 3000).alias("customer"), F.sha2(F.col("id").cast("string"), 256).alias("code"))
    rows.repartition(4).write.option("parquet.block.size", str(64 << 10)).parquet(plain)
    sinks.write_indexed(spark.read.parquet(plain), indexed, ["customer"], ["code"], rows_per_file=15_000, block_bytes=64 << 10, distinct=2000)

    def scanned(path, key):
        got = shape.lookup(spark.read.parquet(path), **key)
        out = sorted(tuple(r) for r in got.collect())
        plan = got._jdf.queryExecution().executedPlan()
        leaf = plan.collectLeaves().head()
        return out, leaf.metrics().apply("numOutputRows").value()

    one = rows.where("k = 777").first()
    for key in ({"customer": one.customer}, {"code": one.code}):
        a, read_plain = scanned(plain, key)
        b, read_indexed = scanned(indexed, key)
        assert a == b and one.k in {r[0] for r in a}
        assert read_indexed < 0.25 * read_plain, (key, read_plain, read_indexed)
