"""Star-schema queries: point-in-time joins, unknown member, backfill."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from ledgerline.operators import star
from ledgerline.plans.catalog import query
from ledgerline.plans.fixtures import view, with_views
from ledgerline.plans.q_change import RUN_TS, cust_hist_ctes, cust_history, cust_views
from ledgerline.session import ensure_checkpoint_dir
from ledgerline.sources import sinks
from ledgerline.streaming.facts import FactStream

_SK_ID, _SK_FROM = "CAST(h.customer_id AS VARCHAR)", "strftime(h.effective_from, '%Y-%m-%d %H:%M:%S.%f')"
SK_SQL = f"sha256(length({_SK_ID}) || ':' || {_SK_ID} || length({_SK_FROM}) || ':' || {_SK_FROM})"
SK_OR_UNKNOWN = f"CASE WHEN h.customer_id IS NULL THEN '-1' ELSE {SK_SQL} END"
IN_RANGE_SQL = ("o.customer_id = h.customer_id AND CAST(o.order_dt AS TIMESTAMP) >= h.effective_from "
                "AND CAST(o.order_dt AS TIMESTAMP) < h.effective_to")


def _facts(spark, sf):
    f = view(spark, sf, "v_orders_dated")
    return f.select("order_id", "customer_id", "order_dt", F.col("amount").cast("double").alias("amount"))


def _out(df, *extra):
    return df.select("order_id", "customer_id", F.date_format("order_dt", "yyyy-MM-dd").alias("order_dt"), *extra)


@query("fact_dim_asof", with_views(f"""
SELECT o.order_id, o.customer_id, strftime(o.order_dt, '%Y-%m-%d') AS order_dt, CAST(o.amount AS DOUBLE) AS amount,
       {SK_OR_UNKNOWN} AS customer_sk, h.market
FROM v_orders_dated o LEFT JOIN h3 h ON {IN_RANGE_SQL}""", ["v_orders_dated"] + cust_views(3), cust_hist_ctes(3, "close")))
def fact_dim_asof(spark, sf):
    """Each order picks the customer version valid on its date."""
    hist = cust_history(spark, sf, 3, on_missing="close")
    j = star.point_in_time_join(_facts(spark, sf), hist, ["customer_id"], "order_dt", "customer_sk", ["market"])
    return _out(j, "amount", "customer_sk", "market")


@query("fact_unknown_member", with_views(f"""
SELECT o.order_id, o.customer_id, strftime(o.order_dt, '%Y-%m-%d') AS order_dt,
       {SK_OR_UNKNOWN} AS customer_sk, h.customer_id IS NULL AS is_unknown
FROM v_orders_dated o LEFT JOIN h1 h ON {IN_RANGE_SQL}""", ["v_orders_dated"] + cust_views(1), cust_hist_ctes(1)))
def fact_unknown_member(spark, sf):
    """Facts loaded on day 1 point to the unknown member when their
    customer (or its version for that date) has not arrived yet."""
    hist = cust_history(spark, sf, 1)
    j = star.point_in_time_join(_facts(spark, sf), hist, ["customer_id"], "order_dt", "customer_sk")
    return _out(j, "customer_sk", (F.col("customer_sk") == star.UNKNOWN_MEMBER).alias("is_unknown"))


def _backfill_ctes():
    ctes = cust_hist_ctes(3) + cust_hist_ctes(3, "close", h="c", with_today=False)
    ctes.append(("f1", f"""
SELECT o.order_id, o.customer_id, o.order_dt, {SK_OR_UNKNOWN} AS customer_sk
FROM v_orders_dated o LEFT JOIN h1 h ON {IN_RANGE_SQL}"""))
    ctes.append(("hf", "SELECT *, effective_from = min(effective_from) OVER (PARTITION BY customer_id) AS is_first FROM c3"))
    return ctes


@query("fact_backfill", with_views(f"""
SELECT order_id, customer_id, strftime(order_dt, '%Y-%m-%d') AS order_dt, customer_sk FROM f1 WHERE customer_sk <> '-1'
UNION ALL
SELECT o.order_id, o.customer_id, strftime(o.order_dt, '%Y-%m-%d') AS order_dt, {SK_OR_UNKNOWN} AS customer_sk
FROM (SELECT * FROM f1 WHERE customer_sk = '-1') o LEFT JOIN hf h
  ON o.customer_id = h.customer_id AND ((CAST(o.order_dt AS TIMESTAMP) >= h.effective_from AND CAST(o.order_dt AS TIMESTAMP) < h.effective_to)
                                        OR (h.is_first AND CAST(o.order_dt AS TIMESTAMP) < h.effective_from))""",
                                   ["v_orders_dated"] + cust_views(3), _backfill_ctes()))
def fact_backfill(spark, sf):
    """After days 2-3 arrive, only unknown-member rows are re-resolved."""
    f1 = star.point_in_time_join(_facts(spark, sf).drop("amount"), cust_history(spark, sf, 1),
                                 ["customer_id"], "order_dt", "customer_sk")
    later = cust_history(spark, sf, 3, on_missing="close")
    out = star.backfill_unknown(f1, later, ["customer_id"], "order_dt", "customer_sk")
    return _out(out, "customer_sk")


@query("stream_fact_backfill", with_views(f"""
SELECT order_id, customer_id, strftime(order_dt, '%Y-%m-%d') AS order_dt, customer_sk FROM f1 WHERE customer_sk <> '-1' AND order_id % 2 = 0
UNION ALL
SELECT o.order_id, o.customer_id, strftime(o.order_dt, '%Y-%m-%d'), {SK_OR_UNKNOWN}
FROM (SELECT * FROM f1 WHERE customer_sk = '-1' AND order_id % 2 = 0) o LEFT JOIN hf h
  ON o.customer_id = h.customer_id AND ((CAST(o.order_dt AS TIMESTAMP) >= h.effective_from AND CAST(o.order_dt AS TIMESTAMP) < h.effective_to)
                                        OR (h.is_first AND CAST(o.order_dt AS TIMESTAMP) < h.effective_from))
UNION ALL
SELECT o.order_id, o.customer_id, strftime(o.order_dt, '%Y-%m-%d'), {SK_OR_UNKNOWN}
FROM (SELECT * FROM v_orders_dated WHERE order_id % 2 = 1) o LEFT JOIN c3 h ON {IN_RANGE_SQL}""",
                                          ["v_orders_dated"] + cust_views(3), _backfill_ctes()))
def stream_fact_backfill(spark, sf):
    """J4/J7 on a stream: half of the facts arrive before days 2-3 of the dimension;
    the unresolved ones are tried again when its newer version is published."""
    base = f"{ensure_checkpoint_dir(spark).rstrip('/')}/facts-{uuid.uuid4().hex}"
    facts = _facts(spark, sf).drop("amount")

    def dimension(s):
        folder, _ = sinks.pointer(s, f"{base}/dim")
        return folder, sinks.read_folder(s, f"{base}/dim", folder)

    stream = FactStream(f"{base}/out", dimension, ["customer_id"], "order_dt", "customer_sk")
    for i, hist in enumerate((cust_history(spark, sf, 1), cust_history(spark, sf, 3, on_missing="close"))):
        sinks.publish_version(hist, f"{base}/dim", f"v{i}")
        facts.where(F.col("order_id") % 2 == i).write.mode("append").parquet(f"{base}/in")
        stream.start(spark.readStream.schema(facts.schema).parquet(f"{base}/in"), f"{base}/checkpoint").awaitTermination()
    return _out(stream.read(spark), "customer_sk")
