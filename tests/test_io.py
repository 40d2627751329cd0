"""Scans and sinks: formats, BOM header, idempotent partition writes, versioned publish."""

import os

from pyspark.sql import functions as F

from ledgerline.operators import meta, quality
from ledgerline.plans import specs as S
from ledgerline.plans.spec import lineage_from_spec, run_batch_spec
from ledgerline.sources import readers, sinks

from .conftest import SF_SMALL


def test_snapshot_scan_formats(spark, tmp):
    df = spark.createDataFrame([(1, "a b", 2.5), (2, None, None)], "id bigint, name string, x double")
    for fmt in ("csv", "json", "parquet"):
        base = os.path.join(tmp, fmt)
        df.write.format(fmt).option("header", True).save(readers.snapshot_path(base, "customers", "2019-01-01"))
        got = readers.read_snapshot(spark, base, "customers", "2019-01-01", fmt=fmt,
                                    schema="id bigint, name string, x double")
        assert sorted(got.collect(), key=lambda r: r.id) == sorted(df.collect(), key=lambda r: r.id)


def test_lookup_csv_with_bom(spark, tmp):
    path = os.path.join(tmp, "cat.csv")
    with open(path, "w", encoding="utf-8") as f:
        f.write("﻿product_category_name,product_category_name_english\nbeleza_saude,health_beauty\n")
    got = readers.read_table(spark, path, "csv")
    assert got.columns == ["product_category_name", "product_category_name_english"]
    lk = readers.read_lookup_csv(spark, path, ("product_category_name", "product_category_name_english"))
    assert [tuple(r) for r in lk.collect()] == [("beleza_saude", "health_beauty")]


def test_log_lines(spark, tmp):
    path = os.path.join(tmp, "gw.log")
    with open(path, "w") as f:
        f.write("2024-01-01 00:00:01 service=api request_id=r1 user_id=u1 latency_ms=12 status=500 error_code=E2\n")
        f.write("garbage line\n")
    rows = readers.read_log_lines(spark, path).orderBy("request_id").collect()
    assert rows[1].latency_ms == 12 and rows[1].error_code == "E2" and rows[1].status == 500
    assert rows[0].request_id is None and rows[0].latency_ms is None


def test_write_day_is_idempotent(spark, tmp):
    path = os.path.join(tmp, "fact")
    d1 = spark.createDataFrame([(1, "2019-01-01"), (2, "2019-01-01")], "id bigint, run_dt string")
    d2 = spark.createDataFrame([(3, "2019-01-02")], "id bigint, run_dt string")
    sinks.write_day(d1, path)
    sinks.write_day(d2, path)
    sinks.write_day(d2, path)  # re-run of day 2
    got = sorted((r.id, str(r.run_dt)) for r in spark.read.parquet(path).collect())
    assert got == [(1, "2019-01-01"), (2, "2019-01-01"), (3, "2019-01-02")]


def test_publish_version_reads_and_replaces(spark, tmp):
    table = os.path.join(tmp, "dim")
    assert sinks.read_current(spark, table) is None
    sinks.publish_version(spark.createDataFrame([(1,)], "id bigint"), table, "r1")
    cur = sinks.read_current(spark, table)
    # build the next version from the current one and publish it: no self-overwrite
    sinks.publish_version(cur.union(spark.createDataFrame([(2,)], "id bigint")), table, "r2")
    assert sorted(r.id for r in sinks.read_current(spark, table).collect()) == [1, 2]
    assert sinks.current_version(spark, table) == "r2"


def test_observe_counts_during_write(spark, tmp):
    df = spark.range(10).withColumn("bad", F.col("id") % 3 == 0)
    out, obs = meta.observe_counts(df, "m", bad_rows=F.col("bad"))
    out.write.format("noop").mode("overwrite").save()
    assert obs.get["rows"] == 10 and obs.get["bad_rows"] == 4


def test_batch_spec_from_readers(spark):
    fact = dict(S.ORDER_VALUE_SPEC)
    srcs = readers.read_spec_sources(spark, fact, SF_SMALL)
    assert set(srcs) == {"orders", "lineitem"}
    out = run_batch_spec(fact, srcs, {"run_dt": "2019-01-02", "run_id": "r"})
    assert out.count() == srcs["orders"].count()
    assert {"net_value", "dt", "run_id"} <= set(out.columns)


def test_lineage_closure(spark):
    e = meta.edges_frame(spark, [("a", "b", "x"), ("b", "c", "x"), ("c", "d", "x"), ("a", "d", "x")])
    got = {(r.upstream, r.downstream, r.depth) for r in meta.lineage_closure(e, checkpoint_every=2).collect()}
    assert ("a", "d", 1) in got and ("a", "c", 2) in got and ("b", "d", 2) in got and len(got) == 6
    assert lineage_from_spec(S.BUYER_SPEC)[0] == ("customers", "buyer_history", "scd2")


def test_quality_report_and_contract(spark):
    df = spark.createDataFrame([(1, "A", 5), (1, None, 50), (2, "Z", 7)], "id bigint, seg string, n int")
    rep = quality.dq_report(df, [{"check": "not_null", "column": "seg"},
                                 {"check": "accepted_values", "column": "seg", "values": ["A"]},
                                 {"check": "range", "column": "n", "min": 0, "max": 10},
                                 {"check": "unique", "columns": ["id"]}])
    got = {(r.check_name, r.failed) for r in rep.collect()}
    assert got == {("not_null", 1), ("accepted_values", 1), ("range", 1), ("unique", 2)}
    c = quality.contract_violations(df, [{"name": "id", "type": "bigint", "nullable": False},
                                         {"name": "seg", "type": "int"}, {"name": "zz", "type": "string"}])
    by = {r.column_name: r for r in c.collect()}
    assert by["zz"].missing and by["seg"].type_mismatch and by["seg"].cast_failures == 2
    assert quality.null_keys(df, ["seg"]).count() == 1


def test_scd2_daily_on_bucketed_history(spark, tmp):
    """Daily job on a published, bucketed history equals the in-plan chain,
    and the merge does not shuffle the history."""
    import contextlib
    import io

    from ledgerline.plans import jobs
    from ledgerline.plans import q_change as Q
    from ledgerline.plans.fixtures import view

    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    path = os.path.join(tmp, "dim_customer")
    for d in (1, 2, 3):
        cur = jobs.scd2_daily(spark, "dim_customer_t", path, view(spark, SF_SMALL, f"v_cust_d{d}"),
                              S.DIM_CUSTOMER_CFG, Q.RUN_TS[d], f"r{d}", buckets)
    want = Q.hist_out(Q.cust_history(spark, SF_SMALL, 3), Q.CUST_OUT)
    got = Q.hist_out(cur, Q.CUST_OUT)
    assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0

    # a new session without the catalog entry re-attaches the bucket spec
    spark.sql("DROP TABLE dim_customer_t__v_r3_a1")
    hist = sinks.read_current_bucketed(spark, "dim_customer_t", path, ["customer_id"], buckets)
    nxt = jobs.scd2_load(hist, view(spark, SF_SMALL, "v_cust_d3"), S.DIM_CUSTOMER_CFG, "2019-01-04 00:00:00")
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        nxt.explain()
    plan = buf.getvalue()
    assert plan.count("Exchange hashpartitioning") == 1  # only today's snapshot is shuffled
    assert "Bucketed: true" in plan


def test_run_log_and_dq_alerts(spark, tmp):
    import datetime as dt

    rep = quality.dq_report(spark.createDataFrame([(1, None), (2, "A")], "id bigint, seg string"),
                            [{"check": "not_null", "column": "seg"}, {"check": "unique", "columns": ["id"]}])
    alerts = quality.threshold_alerts(rep, "failed", 0, "DQ_FAILED").collect()
    assert [(a.check_name, a.alert_type) for a in alerts] == [("not_null", "DQ_FAILED")]
    t0 = dt.datetime(2019, 1, 2, 6, 0, 0)
    row = meta.run_log_row(spark, "r1", "2019-01-02", "dim_customer", 10, 9, 1, t0, t0 + dt.timedelta(seconds=42))
    path = os.path.join(tmp, "run_log")
    sinks.write_day(row, path)
    sinks.write_day(row, path)  # the same run logged twice stays one row
    got = spark.read.parquet(path).collect()
    assert len(got) == 1 and got[0].status == "WARN" and got[0].duration_s == 42.0


def test_daily_job_from_csv_snapshots(spark, tmp):
    """The reference's flow: daily CSV dumps under base/dt=<day>/customers,
    read as text (no inference), deduped, projected with casts, merged."""
    from ledgerline.plans import jobs
    from ledgerline.plans import q_change as Q
    from ledgerline.plans.fixtures import view

    base = os.path.join(tmp, "raw")
    for d in (1, 2, 3):
        view(spark, SF_SMALL, f"v_cust_d{d}").write.option("header", True).csv(
            readers.snapshot_path(base, "customers", Q.RUN_DT[d]))
    cols = ", ".join(f"{c} string" for c in Q.CUST_RAW)
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    path = os.path.join(tmp, "dim")
    for d in (1, 2, 3):
        snap = readers.read_snapshot(spark, base, "customers", Q.RUN_DT[d], fmt="csv", schema=cols)
        cur = jobs.scd2_daily(spark, "dim_csv", path, snap, S.DIM_CUSTOMER_CFG, Q.RUN_TS[d], f"c{d}", buckets)
    want = Q.hist_out(Q.cust_history(spark, SF_SMALL, 3), Q.CUST_OUT).withColumn(
        "customer_id", F.col("customer_id").cast("string"))
    got = Q.hist_out(cur, Q.CUST_OUT)
    assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0


def test_asof_join_on_bucketed_tables_needs_no_shuffle(spark, tmp):
    import contextlib
    import io

    from ledgerline.operators import star
    from ledgerline.plans import q_change as Q
    from ledgerline.plans.fixtures import view

    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    hist = Q.cust_history(spark, SF_SMALL, 3, on_missing="close")
    facts = view(spark, SF_SMALL, "v_orders_dated").select("order_id", "customer_id", "order_dt")
    sinks.write_bucketed(hist, "asof_dim", os.path.join(tmp, "dim"), ["customer_id"], buckets)
    sinks.write_bucketed(facts, "asof_facts", os.path.join(tmp, "facts"), ["customer_id"], buckets)
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        j = star.point_in_time_join(spark.table("asof_facts"), spark.table("asof_dim"), ["customer_id"],
                                    "order_dt", "sk", ["market"])
        buf = io.StringIO()
        with contextlib.redirect_stdout(buf):
            j.explain()
        assert "SortMergeJoin" in buf.getvalue() and "Exchange" not in buf.getvalue()
        assert j.count() == facts.count()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def test_empty_rerun_leaves_an_empty_day(spark, tmp):
    path = os.path.join(tmp, "day")
    rows = spark.createDataFrame([(1, "2019-01-01"), (2, "2019-01-02")], "id bigint, run_dt string")
    sinks.write_day(rows, path)
    sinks.write_day(rows.limit(0), path, run_dt="2019-01-02")
    assert [r.id for r in spark.read.parquet(path).collect()] == [1]


def test_lost_pointer_raises_and_attempts_never_overwrite(spark, tmp):
    import shutil

    import pytest

    table = os.path.join(tmp, "dim")
    one = spark.createDataFrame([(1,)], "id bigint")
    sinks.publish_version(one, table, "r1")
    # a retry of the version that is current may read it: it writes to a folder of its own
    sinks.publish_version(sinks.read_current(spark, table).union(one), table, "r1")
    assert sinks.read_current(spark, table).count() == 2 and sinks.base_folder(spark, table, "r1") is None
    assert sinks.base_folder(spark, table, "r2") == "v=r1.a2"
    shutil.rmtree(os.path.join(table, sinks.POINTERS))
    with pytest.raises(RuntimeError):
        sinks.read_current(spark, table)
    with pytest.raises(RuntimeError):
        sinks.publish_version(one, table, "r2")


def test_daily_job_retries_and_refuses_late_days(spark, tmp):
    import pytest

    from ledgerline.plans import jobs

    cfg = {"business_key": ["id"], "select_expr": {"id": "id", "a": "a"}, "scd2_columns": ["a"]}
    snap = lambda rows: spark.createDataFrame(rows, "id bigint, a string")
    path = os.path.join(tmp, "d")

    def run(day, run_id, rows):
        h = jobs.scd2_daily(spark, "retry_dim", path, snap(rows), cfg, f"2019-01-0{day} 00:00:00", run_id, 4, on_missing="close")
        return sorted((r.id, r.a, r.effective_from.day, r.effective_to.day, r.is_current) for r in h.collect())

    run(1, "r1", [(1, "x"), (2, "y")])
    once = run(3, "r3", [(1, "z"), (2, "y")])
    assert run(3, "r3", [(1, "z"), (2, "y")]) == once  # the same run again
    assert run(3, "other", [(1, "z"), (2, "y")]) == once  # the same day under another id
    run(5, "r5", [(1, "z")])  # closes key 2, opens nothing
    with pytest.raises(ValueError):
        run(4, "r4", [(1, "z"), (2, "q")])


def test_whole_spec_runs_in_every_mode(spark, tmp):
    import pytest

    from ledgerline.plans.fixtures import view
    from ledgerline.plans.spec import run_spec

    src, out = os.path.join(tmp, "in"), os.path.join(tmp, "out")
    for t in ("orders", "lineitem"):
        spark.read.parquet(f"{SF_SMALL}/{t}.parquet").write.parquet(f"{src}/{t}.parquet")
    got = run_spec(spark, S.ORDER_VALUE_SPEC, src, out, {"run_dt": "2019-01-02", "run_id": "b1"})
    table = spark.read.parquet(f"{out}/order_value")
    assert table.count() == got["rows_out"] > 0 and "dt" in table.columns and got["dq_failed"] == 0

    csv = dict(S.BUYER_SPEC, source={"format": "csv", "path": "customers", "options": {"header": True}})
    csv["columns"] = [dict(c, expr="cast(customer_id as bigint)") if c["name"] == "customer_id" else c for c in csv["columns"]]
    for d in (1, 2):
        view(spark, SF_SMALL, f"v_cust_d{d}").write.mode("overwrite").option("header", True).csv(f"{src}/customers")
        for _ in range(2):  # each day twice: a retry changes nothing
            run_spec(spark, csv, src, out, {"run_dt": f"2019-01-0{d}", "run_id": f"s{d}"})
    from ledgerline.plans import q_change as Q
    hist = sinks.read_current(spark, f"{out}/buyer_history")
    want = Q.hist_out(Q.cust_history(spark, SF_SMALL, 2), Q.CUST_OUT)
    mine = Q.hist_out(hist, Q.CUST_OUT)
    assert mine.exceptAll(want).count() == 0 and want.exceptAll(mine).count() == 0
    assert sinks.read_current(spark, f"{out}/buyer_current").count() == hist.where("is_current").count()
    log = {(r.run_id, r.status) for r in spark.read.parquet(f"{out}/_run_log").collect()}
    assert log == {("b1", "SUCCESS"), ("s1", "SUCCESS"), ("s2", "SUCCESS")}

    diff = {"name": "buyer_changes", "mode": "diff", "source": csv["source"], "keys": csv["keys"], "columns": csv["columns"],
            "target": {"path": "buyer_snap"}}
    first = run_spec(spark, diff, src, out, {"run_dt": "2019-01-01", "run_id": "d1"})
    assert first["rows_out"] > 0 and run_spec(spark, diff, src, out, {"run_dt": "2019-01-02", "run_id": "d2"})["rows_out"] == 0

    strict = dict(S.ORDER_VALUE_SPEC, dq={"checks": [{"check": "range", "column": "urgency", "min": 9}], "fail_over": 0})
    with pytest.raises(ValueError):
        run_spec(spark, strict, src, out, {"run_dt": "2019-01-03", "run_id": "b2"})
    failed = spark.read.parquet(f"{out}/_run_log").where("run_id = 'b2'").first()
    assert failed.status == "FAILED" and spark.read.parquet(f"{out}/order_value").where("run_id = 'b2'").count() == 0
    assert spark.read.parquet(f"{out}/_alerts").where("run_id = 'b2'").count() == 1
    with pytest.raises(ValueError):
        run_spec(spark, dict(S.ORDER_VALUE_SPEC, retries=3), src, out, {"run_dt": "2019-01-03", "run_id": "b3"})


def test_full_and_delta_jobs_write_audited_days(spark, tmp):
    from ledgerline.plans import jobs
    from ledgerline.plans.fixtures import view

    path = os.path.join(tmp, "pay")
    jobs.run_full_load(spark, view(spark, SF_SMALL, "v_payments"), S.INSTALMENTS_CFG, path, "2019-01-02", "r", "2019-01-02 06:00:00")
    assert {"run_dt", "run_id", "created_at", "updated_at"} <= set(spark.read.parquet(path).columns)
    path = os.path.join(tmp, "placed")
    feed = view(spark, SF_SMALL, "v_facts_delta")
    jobs.run_delta_append(feed, S.ORDER_TIMES_CFG, path, "2019-01-02", "r", "2019-01-02 06:00:00")
    got = spark.read.parquet(path)
    assert got.count() == feed.where("op = 'I'").select("order_id", "customer_id", "order_ts").distinct().count()
    jobs.run_delta_append(feed.limit(0), S.ORDER_TIMES_CFG, path, "2019-01-02", "r", "2019-01-02 06:00:00")
    assert not os.path.exists(os.path.join(path, "dt=2019-01-02"))


def test_own_pattern_under_a_known_name_is_not_cut_short(spark):
    df = spark.createDataFrame([("call 555-123-4567",), ("none",), (None,)], "t string")
    own = {"phone": r"[0-9]{3}-[0-9]{3}-[0-9]{4}"}
    assert meta.pii_hit_rates(df, ["t"], own).first().hit_rows == 1
    assert sum(r.n_phone or 0 for r in meta.pii_counts(df.withColumn("id", F.lit(1)), "id", "t", own).collect()) == 1


def test_unfinished_lineage_raises(spark):
    import pytest

    e = meta.edges_frame(spark, [(f"n{i:03d}", f"n{i + 1:03d}", "x") for i in range(40)])
    with pytest.raises(RuntimeError):
        meta.lineage_closure(e, max_rounds=2)


def test_run_spec_scans_each_source_once_and_counts_every_node(spark, tmp, monkeypatch):
    import pytest

    from ledgerline.operators import quality
    from ledgerline.plans import spec as sp

    src, out = os.path.join(tmp, "in"), os.path.join(tmp, "out")
    for t in ("orders", "lineitem"):
        spark.read.parquet(f"{SF_SMALL}/{t}.parquet").write.parquet(f"{src}/{t}.parquet")
    plans = []
    real = sp.stage
    monkeypatch.setattr(sp, "stage", lambda df: plans.append(df._jdf.queryExecution().executedPlan().toString()) or real(df))
    checks = [{"check": "not_null", "column": "buyer_key"}, {"check": "range", "column": "urgency", "min": 2, "max": 5},
              {"check": "freshness", "column": "placed_at", "max_age_seconds": 60}, {"check": "unique", "columns": ["order_key"]}]
    spec = dict(S.ORDER_VALUE_SPEC, dq={"checks": checks})
    got = sp.run_spec(spark, spec, src, out, {"run_dt": "2019-01-02", "run_id": "b1"})
    assert len(plans) == 1 and plans[0].count("FileScan parquet") == 2  # two sources, each once
    assert "l_comment" not in plans[0]  # observing a source does not read its other columns
    orders, lines = (spark.read.parquet(f"{src}/{t}.parquet").count() for t in ("orders", "lineitem"))
    assert got["rows_in"] == orders + lines
    table = spark.read.parquet(f"{out}/order_value")
    nodes = {r.node: r.rows for r in spark.read.parquet(f"{out}/_node_rows").collect()}
    frames = sp.spec_frames(spec, {t: spark.read.parquet(f"{src}/{t}.parquet") for t in ("orders", "lineitem")}, {"run_dt": "2019-01-02", "run_id": "b1"})
    assert nodes == {n: df.count() for n, df in frames.items()} and nodes["order_value"] == got["rows_out"] == table.count()
    want = {tuple(r) for r in quality.dq_report(table, checks, "2019-01-02 00:00:00").collect()}
    report = {tuple(r) for r in spark.read.parquet(f"{out}/_dq").select("check_name", "column_name", "rows", "failed", "passed").collect()}
    assert report == want and sum(not r[-1] for r in want) == got["dq_failed"] == 2
    # a source that nothing uses is counted on its own; an unknown one raises
    spare = dict(spec, sources={**spec["sources"], "more": {"format": "parquet", "path": "orders.parquet"}})
    assert sp.run_spec(spark, spare, src, out, {"run_dt": "2019-01-02", "run_id": "b2"})["rows_in"] == 2 * orders + lines
    with pytest.raises(Exception):
        sp.run_spec(spark, dict(spec, sources={**spec["sources"], "more": {"format": "parquet", "path": "none.parquet"}}), src, out,
                    {"run_dt": "2019-01-02", "run_id": "b3"})


def test_column_lineage_and_carried_tags(spark):
    import pytest

    from ledgerline.plans import spec as sp
    from ledgerline.plans.q_quality import _TEXT_EDGES

    sources = {t: spark.read.parquet(f"{SF_SMALL}/{t}.parquet") for t in ("documents", "labels", "orders", "lineitem")}
    assert sorted(sp.column_lineage(S.TEXT_PROFILE_SPEC, sources)) == sorted(_TEXT_EDGES)
    edges = set(sp.column_lineage(S.ORDER_VALUE_SPEC, sources))
    assert {("lineitem.l_extendedprice", "line_values.net"), ("lineitem.l_discount", "line_values.net"), ("line_values.net", "per_order.net_value"),
            ("line_values.net", "per_order.value_per_unit"), ("line_values.quantity", "per_order.value_per_unit"),
            ("line_values.order_key", "per_order.order_key"), ("valued.net_value", "order_value.net_value")} <= edges
    assert not any(down == "per_order.lines" for _, down in edges)  # count(1) reads nothing
    e = spark.createDataFrame([("a.x", "b.x"), ("b.x", "c.x"), ("c.x", "b.x"), ("a.x", "c.x"), ("z.q", "c.x")], "upstream string, downstream string")
    tags = spark.createDataFrame([("a.x", "email"), ("a.x", "email"), ("b.x", "phone")], "column_name string, tag string")
    got = {tuple(r) for r in meta.carry_tags(e, tags).collect()}
    assert got == {("a.x", "email", "a.x", 0), ("b.x", "email", "a.x", 1), ("c.x", "email", "a.x", 1), ("b.x", "phone", "b.x", 0), ("c.x", "phone", "b.x", 1)}
    assert meta.carry_tags(e, tags.limit(0)).count() == 0
    chain = spark.createDataFrame([(f"n{i:02d}", f"n{i + 1:02d}") for i in range(6)], "upstream string, downstream string")
    with pytest.raises(RuntimeError):
        meta.carry_tags(chain, spark.createDataFrame([("n00", "t")], "column_name string, tag string"), max_rounds=3)
