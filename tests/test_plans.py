"""Physical-plan properties the operators are designed for."""

import contextlib
import io

import __spark_entry__ as E

from .conftest import SF_SMALL


def plan(df, mode="formatted"):
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain(mode)
    return buf.getvalue()


def q(spark, name):
    return E.queries()[name](spark, SF_SMALL)


def test_dedupe_limits_before_the_shuffle(spark):
    p = plan(q(spark, "dedupe_lineitem_latest"))
    # a partial per-partition limit runs below the exchange, the final one above it
    assert p.count("WindowGroupLimit") >= 2
    first_limit = p.index("WindowGroupLimit")
    assert "Exchange" in p[first_limit:]


def test_key_lookup_reaches_the_scan(spark):
    p = plan(q(spark, "lookup_by_key"))
    assert "PushedFilters: [IsNotNull(o_orderkey), EqualTo(o_orderkey,4242)]" in p


def test_spec_prunes_columns_and_aggregates_partially(spark):
    p = plan(q(spark, "spec_fact_orders"))
    assert "l_tax" not in p and "l_partkey" not in p and "l_extendedprice:double" in p
    assert "partial_sum" in p and "partial_count" in p


def test_scd2_apply_joins_once(spark):
    p = plan(q(spark, "scd2_apply_customer"), "simple")
    # one full outer join between open versions and today's rows, rows emitted by Generate(inline)
    assert p.count("FullOuter") == 1
    assert "Generate inline" in p


def test_merge_uses_anti_join_not_full_outer(spark):
    p = plan(q(spark, "cdc_merge_inventory"), "simple")
    assert "LeftAnti" in p and "FullOuter" not in p


def test_no_join_is_hinted(spark):
    # adaptive execution decides by measured size
    assert "ResolvedHint" not in plan(q(spark, "dim_product_translated"), "extended")
    asof = plan(q(spark, "fact_dim_asof"), "extended")
    assert "ResolvedHint" not in asof and "SortMergeJoin LeftOuter" in plan(q(spark, "fact_dim_asof"))


def test_the_event_feed_never_meets_in_one_task(spark):
    from ledgerline.plans import q_stream

    assert "SinglePartition" not in plan(q_stream.good(spark, SF_SMALL))
    for name in ("envelope_project", "stream_parse", "stream_dlq", "struct_flatten", "stream_dedupe", "event_partitions",
                 "events_by_window", "alert_bad_rate"):
        assert "SinglePartition" not in plan(q(spark, name)), name
    # only the groups of blocks (a row per 1,024 minutes) and two scalars do
    assert plan(q(spark, "late_events")).count("SinglePartition") == 1


def test_scans_and_joins_are_not_repeated(spark):
    assert plan(q(spark, "cdc_merge_inventory"), "simple").count("lineitem.parquet") <= 7
    backfill = plan(q(spark, "fact_backfill"), "simple")
    assert backfill.count("orders.parquet") == 1
    assert plan(q(spark, "lineage_edges"), "simple").count("lineitem.parquet") == 0


def test_hot_customer_is_split_in_the_asof_join(spark):
    """A customer holding a third of the facts: adaptive execution splits its
    partition of the point-in-time join instead of running it in one task."""
    from pyspark.sql import functions as F

    from ledgerline.operators import scd2, star

    facts = spark.range(0, 30000).select(
        F.when(F.col("id") % 3 == 0, F.lit(7)).otherwise(F.col("id") % 500).alias("customer_id"),
        F.col("id").alias("order_id"), F.lit("2019-01-02").cast("date").alias("order_dt"))
    dim = spark.range(0, 500).select(F.col("id").alias("customer_id"), (F.col("id") % 5).cast("string").alias("seg"))
    hist = scd2.scd2_initial(dim, ["customer_id"], ["seg"], "2019-01-01 00:00:00")
    conf = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
            "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1024",
            "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
            "spark.sql.adaptive.advisoryPartitionSizeInBytes": "1024",
            "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    old = {k: spark.conf.get(k, None) for k in conf}
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        j = star.point_in_time_join(facts, hist, ["customer_id"], "order_dt", "sk", ["seg"])
        assert j.count() == 30000
        j.collect()
        final = plan(j, "formatted")
        assert "isFinalPlan=true" in final and "skew=true" in final
    finally:
        for k, v in old.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


def test_scale_conf_bounds():
    from ledgerline.session import scale_conf

    big = scale_conf(100 << 40, 8000)
    small = scale_conf(1 << 30, 8)
    assert int(big["spark.sql.shuffle.partitions"]) == 100_000
    assert int(small["spark.sql.shuffle.partitions"]) == 16
    assert big["spark.sql.adaptive.autoBroadcastJoinThreshold"] == str(64 << 20)


def test_salted_point_in_time_join_gives_the_same_rows(spark):
    from pyspark.sql import functions as F

    from ledgerline.operators import scd2, star

    facts = spark.range(0, 600).select(F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id") % 40).cast("long").alias("customer_id"),
                                       F.col("id").alias("order_id"), F.lit("2019-01-02").cast("date").alias("order_dt"))
    dim = spark.range(0, 30).select(F.col("id").alias("customer_id"), (F.col("id") % 5).cast("string").alias("seg"))
    hist = scd2.scd2_initial(dim, ["customer_id"], ["seg"], "2019-01-01 00:00:00")
    plain = star.point_in_time_join(facts, hist, ["customer_id"], "order_dt", "sk", ["seg"])
    salted = star.point_in_time_join(facts, hist, ["customer_id"], "order_dt", "sk", ["seg"], salts=4)
    assert salted.columns == plain.columns
    assert plain.exceptAll(salted).count() == 0 and salted.exceptAll(plain).count() == 0


def test_a_run_is_sized_by_its_inputs_and_restores_the_session(spark):
    from ledgerline.session import sized

    key = "spark.sql.shuffle.partitions"
    old = spark.conf.get(key)
    with sized(spark, [f"{SF_SMALL}/lineitem.parquet"]):
        assert int(spark.conf.get(key)) == 2 * spark.sparkContext.defaultParallelism
    assert spark.conf.get(key) == old
