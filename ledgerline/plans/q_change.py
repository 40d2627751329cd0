"""Change-data queries: snapshot diff, CDC net ops / merge, SCD2 (C1-C10, W4, W5, U-1, U-2, B2-B4)."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from ledgerline.operators import change as ch
from ledgerline.operators import scd2
from ledgerline.operators.dedupe import dedupe_latest
from ledgerline.operators.quality import null_keys
from ledgerline.operators import shape
from ledgerline.operators.shape import filter_op
from ledgerline.plans import history, jobs
from ledgerline.plans import specs as S
from ledgerline.plans.catalog import query
from ledgerline.plans.fixtures import table, view, with_views
from ledgerline.plans.oracle_sql import (sql_dedupe, sql_hash, sql_hist_out, sql_net_ops, sql_scd2_initial,
                                         sql_scd2_step)
from ledgerline.plans.spec import run_scd2_spec
from ledgerline.session import ensure_checkpoint_dir

RUN_TS = {1: "2019-01-01 00:00:00", 2: "2019-01-02 00:00:00", 3: "2019-01-03 00:00:00"}
RUN_DT = {d: ts[:10] for d, ts in RUN_TS.items()}

CUST_RAW = ["customer_id", "customer_unique_id", "zip_code_prefix", "customer_city", "customer_state",
            "segment", "last_updated_dt"]
CUST_OUT = ["customer_id", "market", "nation", "region", "nation_code", "label"]
CUST_TRACKED = S.DIM_CUSTOMER_CFG["scd2_columns"]
CUST_SELECT_SQL = ("customer_id, segment AS market, upper(trim(customer_city)) AS nation, lower(trim(customer_state)) AS region, "
                   "CAST(zip_code_prefix AS INTEGER) AS nation_code, customer_unique_id AS label")

PROD_RAW = ["product_id", "category", "weight_g", "brand"]
PROD_OUT = ["product_id", "kind", "size_class", "brand"]
SUPP_RAW = ["supplier_id", "city", "state", "supplier_status"]
SUPP_OUT = ["supplier_id", "may_deliver", "place"]


def hist_out(h, cols):
    """History as exposed by the queries: validity bounds as yyyy-MM-dd text."""
    return h.select(*cols, "hash_diff",
                    F.date_format("effective_from", "yyyy-MM-dd").alias("effective_from"),
                    F.date_format("effective_to", "yyyy-MM-dd").alias("effective_to"), "is_current")


# ------------------------------------------------------------------ Spark side

def cust_history(spark, sf, upto: int, on_missing: str = "keep"):
    """Customer dimension after applying snapshots 1..upto (B2 per day)."""
    days = [(RUN_TS[d], view(spark, sf, f"v_cust_d{d}")) for d in range(1, upto + 1)]
    return jobs.scd2_replay(None, days, S.DIM_CUSTOMER_CFG, on_missing=on_missing)


# ------------------------------------------------------------------ oracle side

def cust_today_sql(day: int) -> str:
    return (f"SELECT {CUST_SELECT_SQL} FROM ("
            f"{sql_dedupe(f'v_cust_d{day}', ['customer_id'], 'last_updated_dt DESC NULLS LAST', CUST_RAW)})")


def cust_hist_ctes(upto: int, on_missing: str = "keep", h: str = "h", with_today: bool = True):
    """CTEs t1..t<upto> (deduped, projected snapshots) and h1..h<upto> (histories)."""
    ctes = [(f"t{d}", cust_today_sql(d)) for d in range(1, upto + 1)] if with_today else []
    ctes.append((f"{h}1", sql_scd2_initial("t1", CUST_OUT, CUST_TRACKED, RUN_TS[1])))
    for d in range(2, upto + 1):
        ctes.append((f"{h}{d}", sql_scd2_step(f"{h}{d - 1}", f"t{d}", ["customer_id"], CUST_OUT[1:], CUST_TRACKED,
                                              RUN_TS[d], on_missing)))
    return ctes


def cust_views(upto: int):
    return [f"v_cust_d{d}" for d in range(1, upto + 1)]


# ------------------------------------------------------------------ snapshot diff

DIFF_COLS = ["customer_unique_id", "zip_code_prefix", "customer_city", "customer_state", "segment"]


def _sql_diff(prev, cur, key, cols):
    changed = " OR ".join(f"p.{c} IS DISTINCT FROM c.{c}" for c in cols)
    names = ", ".join(f"CASE WHEN p.{c} IS DISTINCT FROM c.{c} THEN '{c}' END" for c in cols)
    vals = ", ".join(f"CASE WHEN c.{key} IS NOT NULL THEN c.{c} ELSE p.{c} END AS {c}" for c in cols)
    return f"""
SELECT * FROM (
  SELECT coalesce(c.{key}, p.{key}) AS {key},
         CASE WHEN p.{key} IS NULL THEN 'I' WHEN c.{key} IS NULL THEN 'D' WHEN {changed} THEN 'C' ELSE 'U' END AS op,
         CASE WHEN p.{key} IS NOT NULL AND c.{key} IS NOT NULL THEN concat_ws(',', {names}) ELSE '' END AS changed_cols,
         {vals}
  FROM {prev} p FULL OUTER JOIN {cur} c ON p.{key} = c.{key}) WHERE op <> 'U'"""


@query("snapshot_diff", with_views(
    _sql_diff("v_cust_d1", "d2", "customer_id", DIFF_COLS), ["v_cust_d1", "v_cust_d2"],
    [("d2", sql_dedupe("v_cust_d2", ["customer_id"], "last_updated_dt DESC NULLS LAST", CUST_RAW))]))
def snapshot_diff(spark, sf):
    """C1/J3/U-3: I/C/D between two daily customer snapshots, with changed columns."""
    prev = view(spark, sf, "v_cust_d1")
    cur = dedupe_latest(view(spark, sf, "v_cust_d2"), ["customer_id"], ["last_updated_dt desc"])
    return ch.snapshot_diff(prev, cur, ["customer_id"], DIFF_COLS)


@query("snapshot_diff_stored", with_views(
    _sql_diff("v_cust_d1", "d2", "customer_id", DIFF_COLS), ["v_cust_d1", "v_cust_d2"],
    [("d2", sql_dedupe("v_cust_d2", ["customer_id"], "last_updated_dt DESC NULLS LAST", CUST_RAW))]))
def snapshot_diff_stored(spark, sf):
    """The same changes against the stored snapshot, joining only the key
    buckets whose digest differs."""
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/snapshots-{uuid.uuid4().hex}"
    cols = ["customer_id", *DIFF_COLS]
    history.publish_snapshot(spark, path, view(spark, sf, "v_cust_d1").select(cols), ["customer_id"], "d1", buckets=16)
    cur = dedupe_latest(view(spark, sf, "v_cust_d2"), ["customer_id"], ["last_updated_dt desc"]).select(cols)
    changes, _ = history.publish_snapshot(spark, path, cur, ["customer_id"], "d2", buckets=16, cols=DIFF_COLS)
    return changes


@query("snapshot_diff_product", with_views(
    _sql_diff("v_prod_d1", "v_prod_d2", "product_id", ["category", "weight_g", "brand"]), ["v_prod_d1", "v_prod_d2"]))
def snapshot_diff_product(spark, sf):
    """C1 on products: inserts, deletes and weight changes."""
    return ch.snapshot_diff(view(spark, sf, "v_prod_d1"), view(spark, sf, "v_prod_d2"), ["product_id"],
                            ["category", "weight_g", "brand"])


# ------------------------------------------------------------------ CDC

ORD_DELTA = ["order_id", "customer_id", "order_status", "order_ts", "op", "seq"]
INV_DELTA = ["product_id", "warehouse_id", "on_hand_qty", "reserved_qty", "op", "seq"]


@query("cdc_net_ops", with_views(
    "SELECT order_id, customer_id, order_status, order_ts, op, CAST(seq AS BIGINT) AS seq FROM net",
    ["v_orders_delta"], [("net", sql_net_ops("v_orders_delta", ["order_id"], ORD_DELTA))]))
def cdc_net_ops(spark, sf):
    """One net op per key; same sequence -> D beats C beats I."""
    net = ch.cdc_net_ops(view(spark, sf, "v_orders_delta"), ["order_id"])
    return net.withColumn("seq", F.col("seq").cast("bigint"))


@query("cdc_net_ops_upsert_tie", with_views(
    "SELECT order_id, customer_id, order_status, order_ts, op, CAST(seq AS BIGINT) AS seq FROM net",
    ["v_orders_delta"], [("net", sql_net_ops("v_orders_delta", ["order_id"], ORD_DELTA, "upsert"))]))
def cdc_net_ops_upsert_tie(spark, sf):
    """C2 with the reference SQL's tie order (delete, then upsert: the row survives)."""
    net = ch.cdc_net_ops(view(spark, sf, "v_orders_delta"), ["order_id"], on_tie="upsert")
    return net.withColumn("seq", F.col("seq").cast("bigint"))


@query("cdc_split_ops", with_views(
    "SELECT order_id, customer_id, order_status, order_ts, CAST(seq AS BIGINT) AS seq FROM v_orders_delta WHERE op = 'C'",
    ["v_orders_delta"]))
def cdc_split_ops(spark, sf):
    """P5: the change rows of a feed, op column dropped."""
    return filter_op(view(spark, sf, "v_orders_delta"), "C").withColumn("seq", F.col("seq").cast("bigint"))


@query("cdc_upserts", with_views("""
SELECT order_id, customer_id, order_status, order_ts, op, CAST(seq AS BIGINT) AS seq, 'insert' AS upsert_kind
FROM v_orders_delta WHERE op = 'I'
UNION ALL
SELECT order_id, customer_id, order_status, order_ts, NULL AS op, CAST(seq AS BIGINT) AS seq, 'change' AS upsert_kind
FROM v_orders_delta WHERE op = 'C'""", ["v_orders_delta"]))
def cdc_upserts(spark, sf):
    """U-1: inserts union changes by name; the column missing on one side is null."""
    return ch.cdc_upserts(view(spark, sf, "v_orders_delta")).withColumn("seq", F.col("seq").cast("bigint"))


@query("fact_append", with_views("""
SELECT DISTINCT customer_id AS buyer_key, year(order_ts) || '-Q' || quarter(order_ts) AS quarter, isodow(order_ts) AS weekday, order_id AS order_key,
       '2019-01-02' AS dt
FROM v_facts_delta WHERE op = 'I'""", ["v_facts_delta"]))
def fact_append(spark, sf):
    """Insert-only fact rows of a delta, tagged with the run date; inserts
    that differ only in the sequence are one fact."""
    return jobs.delta_append(view(spark, sf, "v_facts_delta"), S.ORDER_TIMES_CFG, RUN_DT[2])


@query("cdc_merge_inventory", with_views("""
SELECT warehouse_id AS site, product_id AS part_key, greatest(on_hand_qty - reserved_qty, 0) AS free FROM v_inventory i
WHERE NOT EXISTS (SELECT 1 FROM net n WHERE n.product_id = i.product_id AND n.warehouse_id = i.warehouse_id)
UNION ALL
SELECT warehouse_id, product_id, greatest(on_hand_qty - reserved_qty, 0) FROM net WHERE op <> 'D'""",
    ["v_inventory", "v_inventory_delta"],
    [("net", sql_net_ops("v_inventory_delta", ["product_id", "warehouse_id"], INV_DELTA))]))
def cdc_merge_inventory(spark, sf):
    """Deletes and upserts applied together to the inventory state (upsert job)."""
    stock = shape.select_expr(view(spark, sf, "v_inventory"), S.FREE_STOCK_CFG["select_expr"])
    return jobs.delta_upsert(stock, view(spark, sf, "v_inventory_delta"), S.FREE_STOCK_CFG)


@query("delete_by_key", with_views("""
SELECT o_orderkey, o_custkey, o_orderstatus FROM orders o
WHERE NOT EXISTS (SELECT 1 FROM v_orders_delta d WHERE d.op = 'D' AND d.order_id = o.o_orderkey)""",
    ["v_orders_delta"]))
def delete_by_key(spark, sf):
    """Remove rows whose key is deleted in the feed (anti join)."""
    doomed = view(spark, sf, "v_orders_delta").where(F.col("op") == "D").select(F.col("order_id").alias("o_orderkey"))
    o = table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_orderstatus")
    return ch.delete_by_key(o, doomed, ["o_orderkey"])


@query("update_attribute", with_views("""
SELECT o.o_orderkey, o.o_custkey, CASE WHEN n.order_id IS NOT NULL THEN n.order_status ELSE o.o_orderstatus END AS o_orderstatus,
       o.o_totalprice
FROM orders o LEFT JOIN (SELECT * FROM net WHERE op = 'C') n ON o.o_orderkey = n.order_id""",
    ["v_orders_delta"], [("net", sql_net_ops("v_orders_delta", ["order_id"], ORD_DELTA))]))
def update_attribute(spark, sf):
    """C10 set: the status of every key whose net op is a change is overwritten."""
    net = ch.cdc_net_ops(view(spark, sf, "v_orders_delta"), ["order_id"]).where(F.col("op") == "C")
    upd = net.select(F.col("order_id").alias("o_orderkey"), "order_status")
    o = table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice")
    return ch.update_attribute(o, upd, ["o_orderkey"], {"o_orderstatus": "order_status"})


@query("facts_accumulate", with_views("""
SELECT order_id, customer_id, CAST(amount AS DOUBLE) AS amount, strftime(order_dt, '%Y-%m-%d') AS dt FROM v_orders_dated""", ["v_orders_dated"]))
def facts_accumulate(spark, sf):
    """U-2: a backfill of many days appended to the running fact table in one write,
    each day its own partition, and the table read back."""
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/facts-{uuid.uuid4().hex}"
    days = view(spark, sf, "v_orders_dated").select("order_id", "customer_id", F.col("amount").cast("double").alias("amount"),
                                                    F.date_format("order_dt", "yyyy-MM-dd").alias("dt"))
    return jobs.append_days(days, path, "dt")


NULL_KEY_SQL = """
SELECT product_id, warehouse_id, on_hand_qty, reserved_qty, op, seq FROM v_inventory_delta
UNION ALL
SELECT CAST(NULL AS BIGINT), warehouse_id, on_hand_qty, reserved_qty, op, seq FROM v_inventory_delta WHERE product_id % 35 = 0"""


@query("cdc_null_key_rejects", with_views("""
SELECT product_id, warehouse_id, on_hand_qty, op FROM nd WHERE product_id IS NULL OR warehouse_id IS NULL
UNION ALL
SELECT product_id, warehouse_id, on_hand_qty, 'kept' AS op FROM (
  SELECT product_id, warehouse_id, on_hand_qty FROM v_inventory i
  WHERE NOT EXISTS (SELECT 1 FROM net n WHERE n.product_id = i.product_id AND n.warehouse_id = i.warehouse_id)
  UNION ALL SELECT product_id, warehouse_id, on_hand_qty FROM net WHERE op <> 'D')""",
    ["v_inventory", "v_inventory_delta"],
    [("nd", NULL_KEY_SQL), ("net", sql_net_ops("(SELECT * FROM nd WHERE product_id IS NOT NULL AND warehouse_id IS NOT NULL)",
                                               ["product_id", "warehouse_id"], INV_DELTA))]))
def cdc_null_key_rejects(spark, sf):
    """Changes without a key are rejected, not merged; merging twice changes nothing."""
    delta = view(spark, sf, "v_inventory_delta")
    nd = delta.unionByName(delta.where("product_id % 35 = 0").withColumn("product_id", F.lit(None).cast("bigint")))
    keys = ["product_id", "warehouse_id"]
    merged = ch.cdc_merge(ch.cdc_merge(view(spark, sf, "v_inventory"), nd, keys), nd, keys)
    cols = ("product_id", "warehouse_id", "on_hand_qty")
    return null_keys(nd, keys).select(*cols, "op").unionByName(merged.select(*cols, F.lit("kept").alias("op")))


# ------------------------------------------------------------------ SCD2

@query("scd2_initial", with_views(sql_hist_out("h1", CUST_OUT), cust_views(1), cust_hist_ctes(1)))
def scd2_initial(spark, sf):
    """First load opens every key at the run date."""
    return hist_out(cust_history(spark, sf, 1), CUST_OUT)


@query("scd2_apply_customer", with_views(sql_hist_out("h2", CUST_OUT), cust_views(2), cust_hist_ctes(2)))
def scd2_apply_customer(spark, sf):
    """Day 2 merged into day 1's history (stale copies deduped first)."""
    return hist_out(cust_history(spark, sf, 2), CUST_OUT)


@query("scd2_expired", with_views(sql_hist_out("h3", CUST_OUT, "NOT is_current"), cust_views(3), cust_hist_ctes(3)))
def scd2_expired(spark, sf):
    """Versions closed over three days."""
    return hist_out(scd2.scd2_expired(cust_history(spark, sf, 3)), CUST_OUT)


@query("scd2_current_view", with_views(sql_hist_out("h3", CUST_OUT, "is_current"), cust_views(3), cust_hist_ctes(3)))
def scd2_current_view(spark, sf):
    """The current view after three days."""
    return hist_out(cust_history(spark, sf, 3).where(F.col("is_current")), CUST_OUT)


@query("scd2_history_close_missing", with_views(sql_hist_out("h3", CUST_OUT), cust_views(3), cust_hist_ctes(3, "close")))
def scd2_history_close_missing(spark, sf):
    """C6 with on_missing='close': keys absent from a snapshot are closed, and a
    returning key opens a new version."""
    return hist_out(cust_history(spark, sf, 3, on_missing="close"), CUST_OUT)


@query("scd2_rerun", with_views(sql_hist_out("h3", CUST_OUT), cust_views(3), cust_hist_ctes(3)))
def scd2_rerun(spark, sf):
    """The daily job over three days, day 3 run again under its own id and
    once more under another: the same table as a single run of each day."""
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/rerun-{uuid.uuid4().hex}"
    for d, run_id in ((1, "r1"), (2, "r2"), (3, "r3"), (3, "r3"), (3, "again")):
        history.scd2_daily_buckets(spark, path, view(spark, sf, f"v_cust_d{d}"), S.DIM_CUSTOMER_CFG, RUN_TS[d], run_id, buckets=8)
    return hist_out(history.read_history(spark, path), CUST_OUT)


@query("scd2_daily_soft_delete", with_views(sql_hist_out("h3", CUST_OUT), cust_views(3), cust_hist_ctes(3, "close")))
def scd2_daily_soft_delete(spark, sf):
    """The daily job closes keys missing for a day; last sightings are part of
    each day's commit, and day 2 is retried."""
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/soft-{uuid.uuid4().hex}"
    for d, run_id in ((1, "r1"), (2, "r2"), (2, "r2"), (3, "r3")):
        history.scd2_daily_buckets(spark, path, view(spark, sf, f"v_cust_d{d}"), S.DIM_CUSTOMER_CFG, RUN_TS[d], run_id, buckets=8,
                                   close_after_days=1)
    return hist_out(history.read_history(spark, path), CUST_OUT)


def _addr_sql(day: int) -> str:
    return (f"SELECT 'A' || CAST(customer_id AS VARCHAR) AS address_key, customer_id, upper(trim(customer_city)) AS nation, "
            f"lower(trim(customer_state)) AS region FROM ({sql_dedupe(f'v_addr_d{day}', ['customer_id'], 'last_updated_dt DESC NULLS LAST', CUST_RAW)})")


ADDR_OUT = ["address_key", "customer_id", "nation", "region"]


@query("dim_customer_address", with_views(sql_hist_out("h2", ADDR_OUT), ["v_addr_d1", "v_addr_d2"], [
    ("t1", _addr_sql(1)), ("t2", _addr_sql(2)), ("h1", sql_scd2_initial("t1", ADDR_OUT, S.DIM_CUSTOMER_ADDRESS_CFG["scd2_columns"], RUN_TS[1])),
    ("h2", sql_scd2_step("h1", "t2", ["address_key"], ADDR_OUT[1:], S.DIM_CUSTOMER_ADDRESS_CFG["scd2_columns"], RUN_TS[2]))]))
def dim_customer_address(spark, sf):
    """Customer addresses as a versioned dimension; movers get a new version."""
    days = [(RUN_TS[d], view(spark, sf, f"v_addr_d{d}")) for d in (1, 2)]
    return hist_out(jobs.scd2_replay(None, days, S.DIM_CUSTOMER_ADDRESS_CFG), ADDR_OUT)


def _prod_hist_ctes():
    t1 = sql_dedupe("v_prod_d1", ["product_id"], "", PROD_RAW)
    t2 = sql_dedupe("v_prod_d2", ["product_id"], "", PROD_RAW)
    sel = "product_id, category AS kind, CAST(weight_g AS INTEGER) AS size_class, brand"
    tracked = S.DIM_PRODUCT_CFG["scd2_columns"]
    return [("t1", f"SELECT {sel} FROM ({t1})"), ("t2", f"SELECT {sel} FROM ({t2})"),
            ("h1", sql_scd2_initial("t1", PROD_OUT, tracked, RUN_TS[1])),
            ("h2", sql_scd2_step("h1", "t2", ["product_id"], PROD_OUT[1:], tracked, RUN_TS[2], "close"))]


@query("scd2_apply_product", with_views(sql_hist_out("h2", PROD_OUT), ["v_prod_d1", "v_prod_d2"], _prod_hist_ctes()))
def scd2_apply_product(spark, sf):
    """C6 on products with on_missing='close' (deleted products are closed)."""
    h = jobs.scd2_load(None, view(spark, sf, "v_prod_d1"), S.DIM_PRODUCT_CFG, RUN_TS[1])
    h = jobs.scd2_load(h, view(spark, sf, "v_prod_d2"), S.DIM_PRODUCT_CFG, RUN_TS[2], on_missing="close")
    return hist_out(h, PROD_OUT)


def _supp_hist_ctes():
    t1 = sql_dedupe("v_supp_d1", ["supplier_id"], "", SUPP_RAW)
    t2 = sql_dedupe("v_supp_d2", ["supplier_id"], "", SUPP_RAW)
    sel = ("supplier_id, supplier_status = 'ACTIVE' AS may_deliver, "
           "concat_ws(', ', trim(city), upper(trim(state))) AS place")
    tracked = S.DIM_SUPPLIER_CFG["scd2_columns"]
    return [("t1", f"SELECT {sel} FROM ({t1})"), ("t2", f"SELECT {sel} FROM ({t2})"),
            ("h1", sql_scd2_initial("t1", SUPP_OUT, tracked, RUN_TS[1])),
            ("h2", sql_scd2_step("h1", "t2", ["supplier_id"], SUPP_OUT[1:], tracked, RUN_TS[2], "keep"))]


@query("scd2_apply_supplier", with_views(sql_hist_out("h2", SUPP_OUT), ["v_supp_d1", "v_supp_d2"], _supp_hist_ctes()))
def scd2_apply_supplier(spark, sf):
    """C6 on suppliers: status changes open new versions."""
    h = jobs.scd2_load(None, view(spark, sf, "v_supp_d1"), S.DIM_SUPPLIER_CFG, RUN_TS[1])
    h = jobs.scd2_load(h, view(spark, sf, "v_supp_d2"), S.DIM_SUPPLIER_CFG, RUN_TS[2])
    return hist_out(h, SUPP_OUT)


@query("spec_dim_customer", with_views(sql_hist_out("h2", CUST_OUT), cust_views(2), cust_hist_ctes(2)))
def spec_dim_customer(spark, sf):
    """The SCD2 spec (dedupe, rule-based columns, merge) over two days."""
    h = run_scd2_spec(S.BUYER_SPEC, view(spark, sf, "v_cust_d1"), None, RUN_TS[1])
    h = run_scd2_spec(S.BUYER_SPEC, view(spark, sf, "v_cust_d2"), h, RUN_TS[2])
    return hist_out(h, CUST_OUT)


def _seen_sql():
    return " UNION ALL ".join(f"SELECT customer_id, DATE '{RUN_DT[d]}' AS dt FROM v_cust_d{d}" for d in (1, 2, 3))


def _last_seen(spark, sf):
    """Last sighting per key, carried over the three days as the daily job does."""
    seen = None
    for d in (1, 2, 3):
        seen = scd2.last_seen(seen, view(spark, sf, f"v_cust_d{d}"), ["customer_id"], "dt", RUN_DT[d])
    return seen


@query("soft_delete_keys", with_views("""
SELECT customer_id, strftime(last_seen_dt, '%Y-%m-%d') AS last_seen_dt, days_missing FROM (
  SELECT customer_id, max(dt) AS last_seen_dt, CAST(date_diff('day', max(dt), DATE '2019-01-03') AS BIGINT) AS days_missing
  FROM seen GROUP BY customer_id) WHERE days_missing >= 1""", cust_views(3), [("seen", _seen_sql())]))
def soft_delete_keys(spark, sf):
    """Keys missing from the snapshots for at least one day at the run date."""
    seen = _last_seen(spark, sf)
    out = scd2.soft_delete_keys(seen, ["customer_id"], "dt", RUN_DT[3], 1)
    return out.withColumn("last_seen_dt", F.date_format("last_seen_dt", "yyyy-MM-dd"))


@query("scd2_soft_delete", with_views(f"""
SELECT customer_id, market, nation, region, nation_code, label, hash_diff,
       strftime(effective_from, '%Y-%m-%d') AS effective_from,
       strftime(CASE WHEN is_current AND customer_id IN (SELECT customer_id FROM gone) THEN TIMESTAMP '{RUN_TS[3]}' ELSE effective_to END, '%Y-%m-%d') AS effective_to,
       CASE WHEN is_current AND customer_id IN (SELECT customer_id FROM gone) THEN false ELSE is_current END AS is_current
FROM h3""", cust_views(3), cust_hist_ctes(3) + [("seen", _seen_sql()), ("gone", """
SELECT customer_id FROM seen GROUP BY customer_id HAVING date_diff('day', max(dt), DATE '2019-01-03') >= 1""")]))
def scd2_soft_delete(spark, sf):
    """C8 applied: open versions of keys missing for N days are closed."""
    seen = _last_seen(spark, sf)
    gone = scd2.soft_delete_keys(seen, ["customer_id"], "dt", RUN_DT[3], 1)
    return hist_out(scd2.close_keys(cust_history(spark, sf, 3), gone, ["customer_id"], RUN_TS[3]), CUST_OUT)


def _snaps_sql():
    return " UNION ALL ".join(f"SELECT *, DATE '{RUN_DT[d]}' AS dt FROM t{d}" for d in (1, 2, 3))


@query("scd2_from_snapshots", with_views(f"""
SELECT customer_id, market, nation, region, nation_code, label, {sql_hash(CUST_TRACKED)} AS hash_diff,
       strftime(dt, '%Y-%m-%d') AS effective_from,
       strftime(coalesce(CAST(lead(dt) OVER (PARTITION BY customer_id ORDER BY dt) AS TIMESTAMP), TIMESTAMP '9999-12-31'), '%Y-%m-%d') AS effective_to,
       lead(dt) OVER (PARTITION BY customer_id ORDER BY dt) IS NULL AS is_current
FROM (SELECT *, lag(dt) OVER w AS pdt,
             lag(market) OVER w AS p1, lag(nation) OVER w AS p2, lag(region) OVER w AS p3, lag(nation_code) OVER w AS p4
      FROM snaps WINDOW w AS (PARTITION BY customer_id ORDER BY dt))
WHERE pdt IS NULL OR market IS DISTINCT FROM p1 OR nation IS DISTINCT FROM p2 OR region IS DISTINCT FROM p3
      OR nation_code IS DISTINCT FROM p4""", cust_views(3), cust_hist_ctes(3)[:3] + [("snaps", _snaps_sql())]))
def scd2_from_snapshots(spark, sf):
    """A whole history from many daily snapshots in one pass (backfill)."""
    snaps = None
    for d in (1, 2, 3):
        raw = dedupe_latest(view(spark, sf, f"v_cust_d{d}"), ["customer_id"], ["last_updated_dt desc"])
        part = jobs.select_expr(raw, S.DIM_CUSTOMER_CFG["select_expr"]).withColumn("dt", F.to_date(F.lit(RUN_DT[d])))
        snaps = part if snaps is None else snaps.unionByName(part)
    h = scd2.scd2_from_snapshots(snaps, ["customer_id"], CUST_TRACKED, "dt")
    return hist_out(h, CUST_OUT)


@query("scd2_from_snapshots_close", with_views(sql_hist_out("h3", CUST_OUT), cust_views(3), cust_hist_ctes(3, "close")))
def scd2_from_snapshots_close(spark, sf):
    """W5 with on_missing='close': a backfill that equals the daily job's table."""
    snaps = None
    for d in (1, 2, 3):
        raw = dedupe_latest(view(spark, sf, f"v_cust_d{d}"), ["customer_id"], ["last_updated_dt desc"])
        part = jobs.select_expr(raw, S.DIM_CUSTOMER_CFG["select_expr"]).withColumn("dt", F.to_date(F.lit(RUN_DT[d])))
        snaps = part if snaps is None else snaps.unionByName(part)
    h = scd2.scd2_from_snapshots(snaps, ["customer_id"], CUST_TRACKED, "dt", on_missing="close", days=[RUN_DT[d] for d in (1, 2, 3)])
    return hist_out(h, CUST_OUT)
