"""Batch projection / dedupe / aggregate / spec queries."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from ledgerline.functions.columns import hash_diff as _hash_diff
from ledgerline.operators import aggregate as agg
from ledgerline.operators import dedupe as dd
from ledgerline.operators import shape
from ledgerline.plans import jobs
from ledgerline.plans import specs as S
from ledgerline.plans.catalog import query
from ledgerline.plans.fixtures import table, view, with_views
from ledgerline.plans.spec import run_batch_spec
from ledgerline.session import ensure_checkpoint_dir
from ledgerline.sources import sinks
from ledgerline.sources.readers import parse_log_lines, read_lookup_csv

RUN_DT, RUN_ID = "2019-01-02", "r20190102"


def order_value_sources(spark, sf):
    return {"orders": table(spark, sf, "orders"), "lineitem": table(spark, sf, "lineitem")}


MONEY = "CAST({} AS DECIMAL(18,2))"
NET_SQL = f"{MONEY.format('l_extendedprice')} * (1 - {MONEY.format('l_discount')})"


@query("spec_fact_orders", with_views(f"""
SELECT o.o_orderkey AS order_key, o.o_custkey AS buyer_key, o.o_orderdate AS placed_at, CAST(substr(o.o_orderpriority, 1, 1) AS INTEGER) AS urgency,
       CAST(a.lines AS BIGINT) AS lines, CAST(a.units AS DOUBLE) AS units, CAST(a.net_value AS DOUBLE) AS net_value,
       CAST(a.lines_returned AS BIGINT) AS lines_returned, a.last_ship,
       CAST(a.net_value AS DOUBLE) / CAST(a.units AS DOUBLE) AS value_per_unit,
       '{RUN_DT}' AS dt, '{RUN_ID}' AS run_id
FROM orders o LEFT JOIN (
  SELECT l_orderkey AS order_key, count(*) AS lines, sum({MONEY.format('l_quantity')}) AS units, sum({NET_SQL}) AS net_value,
         count(*) FILTER (WHERE l_returnflag = 'R') AS lines_returned, max(l_shipdate) AS last_ship
  FROM lineitem GROUP BY l_orderkey) a ON o.o_orderkey = a.order_key
WHERE o.o_orderkey IS NOT NULL AND o.o_custkey IS NOT NULL"""))
def spec_fact_orders(spark, sf):
    """The batch spec's plan."""
    out = run_batch_spec(S.ORDER_VALUE_SPEC, order_value_sources(spark, sf), {"run_dt": RUN_DT, "run_id": RUN_ID})
    return out.select("order_key", "buyer_key", "placed_at", "urgency", F.col("lines").cast("bigint").alias("lines"),
                      *[F.col(c).cast("double").alias(c) for c in ("units", "net_value")],
                      F.col("lines_returned").cast("bigint").alias("lines_returned"), "last_ship", "value_per_unit", "dt", "run_id")


def _date_text(c):
    return F.date_format(F.col(c), "yyyy-MM-dd")


def sql_hash(cols):
    """DuckDB text of ``hash_diff`` over ``cols``."""
    parts = ", ".join(f"coalesce(CAST({c} AS VARCHAR), '~')" for c in cols)
    return f"sha256(concat_ws('||', {parts}))"


CUST_COLS = ["customer_id", "customer_unique_id", "zip_code_prefix", "customer_city", "customer_state",
             "segment", "last_updated_dt"]

CUST_SELECT_SQL = ("customer_id, segment AS market, upper(trim(customer_city)) AS nation, lower(trim(customer_state)) AS region, "
                   "CAST(zip_code_prefix AS INTEGER) AS nation_code, customer_unique_id AS label")


@query("order_agg", """
SELECT l_orderkey AS order_id, count(*) AS item_count,
       CAST(sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS DOUBLE) AS items_total,
       CAST(sum(CAST(l_extendedprice AS DECIMAL(18,2)) * CAST(l_tax AS DECIMAL(18,2))) AS DOUBLE) AS freight_total,
       CAST(sum(CAST(l_extendedprice AS DECIMAL(18,2))) + sum(CAST(l_extendedprice AS DECIMAL(18,2)) * CAST(l_tax AS DECIMAL(18,2))) AS DOUBLE) AS order_total
FROM lineitem GROUP BY l_orderkey""")
def order_agg(spark, sf):
    """A1/A2: grouped aggregate with a post-aggregate derive."""
    items = table(spark, sf, "lineitem").select(
        F.col("l_orderkey").alias("order_id"),
        F.col("l_extendedprice").cast("decimal(18,2)").alias("price"),
        (F.col("l_extendedprice").cast("decimal(18,2)") * F.col("l_tax").cast("decimal(18,2)")).alias("freight"))
    out = agg.grouped_agg(items, ["order_id"],
                          {"item_count": F.count(F.lit(1)), "items_total": F.sum("price"), "freight_total": F.sum("freight")},
                          {"order_total": F.col("items_total") + F.col("freight_total")})
    return out.select("order_id", "item_count",
                      *[F.col(c).cast("double").alias(c) for c in ("items_total", "freight_total", "order_total")])


@query("select_expr_customer", with_views(f"SELECT {CUST_SELECT_SQL} FROM v_customers", ["v_customers"]))
def select_expr_customer(spark, sf):
    """A dimension's select_expr config over the customer snapshot."""
    return shape.select_expr(view(spark, sf, "v_customers"), S.DIM_CUSTOMER_CFG["select_expr"])


SHIP_SQL = """
SELECT order_id,
       CASE order_status WHEN 'F' THEN 'DELIVERED' WHEN 'P' THEN 'SHIPPED' WHEN 'X' THEN 'CANCELED' ELSE 'CREATED' END AS shipment_status,
       created_ts AS shipping_created_ts, shipped_ts, delivered_ts,
       created_ts, greatest(created_ts, shipped_ts, delivered_ts) AS last_updated_ts
FROM v_shipments"""


@query("derive_shipments", with_views(SHIP_SQL, ["v_shipments"]))
def derive_shipments(spark, sf):
    """Status map, null-skipping latest timestamp."""
    return jobs.derive_shipments(view(spark, sf, "v_shipments"))


SHIPMENT_COLS_SQL = """shipped_ts IS NOT NULL AND delivered_ts IS NULL AS still_out,
       date_diff('day', CAST(shipped_ts AS DATE), CAST(delivered_ts AS DATE)) AS days_on_the_way,
       strftime(shipped_ts, '%Y-%m') AS left_in, order_id AS order_key"""


@query("select_expr_shipments", with_views(f"SELECT {SHIPMENT_COLS_SQL} FROM ship", ["v_shipments"], [("ship", SHIP_SQL)]))
def select_expr_shipments(spark, sf):
    """The shipments fact config over derived shipments."""
    return shape.select_expr(jobs.derive_shipments(view(spark, sf, "v_shipments")), S.TRANSIT_CFG["select_expr"])


@query("spec_select_customer", with_views(f"SELECT {CUST_SELECT_SQL} FROM v_cust_d1", ["v_cust_d1"]))
def spec_select_customer(spark, sf):
    """Spec column list with named rules (str.lower_trim / str.upper_trim)."""
    return shape.build_select(view(spark, sf, "v_cust_d1"), S.BUYER_SPEC["columns"])


PAYMENT_COLS_SQL = """CAST(payment_installments AS BIGINT) AS months, CAST(payment_value AS DOUBLE) / payment_installments AS due_a_month,
       payment_installments > 6 AS over_half_a_year, order_id AS order_key"""


@query("audit_columns", with_views(f"""
SELECT {PAYMENT_COLS_SQL}, '2019-01-02' AS run_dt, 'r20190102' AS run_id,
       TIMESTAMP '2019-01-02 06:00:00' AS created_at, TIMESTAMP '2019-01-02 06:00:00' AS updated_at
FROM v_payments""", ["v_payments"]))
def audit_columns(spark, sf):
    """Run date, run id, and creation and update times given as an argument."""
    f = shape.select_expr(view(spark, sf, "v_payments"), S.INSTALMENTS_CFG["select_expr"])
    out = shape.add_audit_columns(f, RUN_DT, RUN_ID, load_ts="2019-01-02 06:00:00")
    return out.withColumn("run_dt", _date_text("run_dt"))


@query("lookup_by_key", """
SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate FROM orders WHERE o_orderkey = 4242""")
def lookup_by_key(spark, sf):
    """P10: get-by-key as an equality filter pushed into the Parquet scan."""
    o = table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate")
    return shape.lookup(o, o_orderkey=4242)


@query("lookup_by_status", """
SELECT o_orderkey, o_custkey, o_orderstatus, o_orderpriority FROM orders
WHERE o_orderstatus = 'P' AND o_orderpriority = '1-URGENT'""")
def lookup_by_status(spark, sf):
    """P10: secondary-attribute query (the item table's index) as pushed filters."""
    o = table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_orderstatus", "o_orderpriority")
    return shape.lookup(o, o_orderstatus="P", o_orderpriority="1-URGENT")


@query("lookup_by_index", """
SELECT 'customer' AS found_by, o_orderkey, o_custkey, CAST(o_totalprice AS DOUBLE) AS o_totalprice FROM orders WHERE o_custkey = 37
UNION ALL
SELECT 'order', o_orderkey, o_custkey, CAST(o_totalprice AS DOUBLE) FROM orders WHERE o_orderkey = 4242""")
def lookup_by_index(spark, sf):
    """P10: lookups in a copy ordered by customer, with a bloom filter on the order key."""
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/indexed-{uuid.uuid4().hex}"
    orders = table(spark, sf, "orders").select("o_orderkey", "o_custkey", F.col("o_totalprice").cast("double").alias("o_totalprice"))
    sinks.write_indexed(orders, path, ["o_custkey"], ["o_orderkey"])
    copy = spark.read.schema(orders.schema).parquet(path)
    cols = ["found_by", *orders.columns]
    return (shape.lookup(copy, o_custkey=37).withColumn("found_by", F.lit("customer")).select(cols)
            .unionByName(shape.lookup(copy, o_orderkey=4242).withColumn("found_by", F.lit("order")).select(cols)))


@query("derive_suppliers", """
SELECT s_suppkey AS supplier_id, s_name AS supplier_name, s_nationkey AS zip_code_prefix,
       CAST(s_acctbal AS DOUBLE) AS account_balance, upper(s_name) AS display_name, 'ACTIVE' AS supplier_status
FROM supplier""")
def derive_suppliers(spark, sf):
    """Rename / reshape with a constant status."""
    return shape.rename_with_constants(
        table(spark, sf, "supplier"),
        {"s_suppkey": "supplier_id", "s_name": "supplier_name", "s_nationkey": "zip_code_prefix",
         "s_acctbal": "account_balance"},
        {"supplier_status": "ACTIVE"}, {"display_name": "upper(s_name)"})


@query("dim_date", """
SELECT DISTINCT strftime(CAST(o_orderdate AS DATE), '%Y-%m-%d') AS date, CAST(year(o_orderdate) AS BIGINT) AS year,
       CAST(quarter(o_orderdate) AS BIGINT) AS quarter, CAST(month(o_orderdate) AS BIGINT) AS month, CAST(day(o_orderdate) AS BIGINT) AS day,
       strftime(o_orderdate, '%a') AS day_name
FROM orders WHERE o_orderdate IS NOT NULL""")
def dim_date(spark, sf):
    """Date dimension from order timestamps (full-load job, empty dedupe order)."""
    o = table(spark, sf, "orders").select(F.col("o_orderdate").alias("order_ts"))
    return jobs.full_load(o, S.DIM_DATE_CFG).withColumn("date", _date_text("date"))


@query("dim_payment_method", with_views("""
SELECT DISTINCT CAST(substr(payment_type, 1, 1) AS BIGINT) AS method_no, lower(substr(payment_type, 3)) AS shown_as
FROM v_payments WHERE payment_type IS NOT NULL""",
                                        ["v_payments"]))
def dim_payment_method(spark, sf):
    """A5/B1: payment-method dimension from payments (full-load job, empty dedupe order)."""
    return jobs.full_load(view(spark, sf, "v_payments").where(F.col("payment_type").isNotNull()), S.DIM_PAYMENT_METHOD_CFG)


@query("distinct_rows", with_views("""
SELECT DISTINCT customer_id, customer_unique_id, zip_code_prefix, customer_city, customer_state FROM (
  SELECT customer_id, customer_unique_id, zip_code_prefix, customer_city, customer_state FROM v_cust_d1
  UNION ALL SELECT customer_id, customer_unique_id, zip_code_prefix, customer_city, customer_state FROM v_cust_d3)""",
                                   ["v_cust_d1", "v_cust_d3"]))
def distinct_rows(spark, sf):
    """A3: exact duplicates across two snapshots removed."""
    cols = ["customer_id", "customer_unique_id", "zip_code_prefix", "customer_city", "customer_state"]
    both = view(spark, sf, "v_cust_d1").select(*cols).unionByName(view(spark, sf, "v_cust_d3").select(*cols))
    return dd.distinct_rows(both)


@query("dedupe_latest", with_views(f"""
SELECT customer_id, customer_unique_id, zip_code_prefix, customer_city, customer_state, segment,
       strftime(last_updated_dt, '%Y-%m-%d') AS last_updated_dt
FROM (SELECT *, row_number() OVER (PARTITION BY customer_id ORDER BY last_updated_dt DESC NULLS LAST,
                                   {sql_hash(CUST_COLS)} DESC) AS rn FROM v_cust_d2) WHERE rn = 1""", ["v_cust_d2"]))
def dedupe_latest(spark, sf):
    """Latest row per key by a configured order (stale copies dropped)."""
    out = dd.dedupe_latest(view(spark, sf, "v_cust_d2"), ["customer_id"], ["last_updated_dt desc"])
    return out.withColumn("last_updated_dt", _date_text("last_updated_dt"))


@query("dedupe_by_hash", with_views(f"""
SELECT customer_id, customer_unique_id, zip_code_prefix, customer_city, customer_state, segment,
       strftime(last_updated_dt, '%Y-%m-%d') AS last_updated_dt
FROM (SELECT *, row_number() OVER (PARTITION BY customer_id ORDER BY {sql_hash(CUST_COLS)} DESC) AS rn FROM v_cust_d2)
WHERE rn = 1""", ["v_cust_d2"]))
def dedupe_by_hash(spark, sf):
    """No order given, the highest whole-row hash wins."""
    out = dd.dedupe_by_hash(view(spark, sf, "v_cust_d2"), ["customer_id"])
    return out.withColumn("last_updated_dt", _date_text("last_updated_dt"))


@query("dedupe_lineitem_latest", """
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity, l_shipdate FROM (
  SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber
                               ORDER BY l_shipdate DESC NULLS LAST, l_partkey DESC NULLS LAST, l_suppkey DESC NULLS LAST) AS rn
  FROM lineitem) WHERE rn = 1""")
def dedupe_lineitem_latest(spark, sf):
    """W1 on the largest table: latest line per (order, line number)."""
    li = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_shipdate")
    return dd.dedupe_latest(li, ["l_orderkey", "l_linenumber"], ["l_shipdate desc", "l_partkey desc", "l_suppkey desc"],
                            tie_break=False)


TRACKED = ["zip_code_prefix", "customer_city", "customer_state", "segment"]


@query("hash_diff", with_views(f"SELECT customer_id, {sql_hash(TRACKED)} AS hash_diff FROM v_cust_d3", ["v_cust_d3"]))
def hash_diff(spark, sf):
    """sha2-256 row hash of tracked columns, null as '~'."""
    d = view(spark, sf, "v_cust_d3")
    return d.select("customer_id", _hash_diff(TRACKED).alias("hash_diff"))


RETURN_SQL = """
SELECT s.order_id, CAST(coalesce(r.review_score, 5) AS BIGINT) AS review_score,
       coalesce(date_diff('second', s.created_ts, s.delivered_ts) / 86400, 0.0) AS delivery_delay_days
FROM v_shipments s LEFT JOIN v_reviews r ON s.order_id = r.order_id WHERE s.order_status = 'F'"""
CHANCE_SQL = """
SELECT *, least(greatest(delivery_delay_days, 0.0::DOUBLE), 60.0::DOUBLE) AS delay_counted,
       least(greatest(0.03::DOUBLE + (5 - review_score) * 0.01::DOUBLE
                      + least(greatest(delivery_delay_days, 0.0::DOUBLE), 60.0::DOUBLE) / 60.0::DOUBLE * 0.02::DOUBLE, 0.0::DOUBLE), 0.25::DOUBLE) AS return_propensity
FROM feat"""


@query("return_features", with_views("SELECT * FROM chance", ["v_shipments", "v_reviews"], [("feat", RETURN_SQL), ("chance", CHANCE_SQL)]))
def return_features(spark, sf):
    """Review join with its default, delivery delay, clipped delay and return propensity."""
    return jobs.return_features(view(spark, sf, "v_shipments"), view(spark, sf, "v_reviews"))


@query("return_cost", with_views("""
SELECT c.order_id, c.return_propensity,
       CAST(round(CAST(o.o_totalprice AS DECIMAL(18,2)) * CAST(c.return_propensity AS DECIMAL(9,6)), 2) AS DOUBLE) AS expected_refund
FROM chance c LEFT JOIN orders o ON c.order_id = o.o_orderkey""", ["v_shipments", "v_reviews"], [("feat", RETURN_SQL), ("chance", CHANCE_SQL)]))
def return_cost(spark, sf):
    """Rounded decimal sums on the return features."""
    o = table(spark, sf, "orders").select(F.col("o_orderkey").alias("order_id"), "o_totalprice")
    out = jobs.return_cost(jobs.return_features(view(spark, sf, "v_shipments"), view(spark, sf, "v_reviews")), o, "o_totalprice")
    return out.select("order_id", "return_propensity", F.col("expected_refund").cast("double").alias("expected_refund"))


# Category translation (source name -> English name); the lookup file holds each
# kind that has a translation, the others are left out to exercise the fallback.
TRANSLATED_SQL = "SELECT DISTINCT p_type AS product_category_name, lower(p_type) || '_goods' AS product_category_name_english FROM part WHERE p_type < 'S'"


@query("dim_product_translated", with_views("""
SELECT p.p_partkey AS product_id, p.p_type AS category,
       coalesce(t.product_category_name_english, lower(p.p_type)) AS category_english, p.p_brand AS brand
FROM part p LEFT JOIN tr t ON p.p_type = t.product_category_name""", ctes=[("tr", TRANSLATED_SQL)]))
def dim_product_translated(spark, sf):
    """Category names translated through a lookup file (CSV with a header),
    written from the parts of the run and read with the lookup reader; adaptive
    execution broadcasts it if its measured size allows."""
    p = table(spark, sf, "part")
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/lookup-{uuid.uuid4().hex}"
    names = p.where(F.col("p_type") < "S").select(F.col("p_type").alias("product_category_name"),
                                                  F.concat(F.lower("p_type"), F.lit("_goods")).alias("product_category_name_english"))
    names.distinct().write.option("header", True).csv(path)
    tr = read_lookup_csv(spark, path, ("product_category_name", "product_category_name_english"))
    j = p.join(tr, p.p_type == tr.product_category_name, "left")
    return j.select(F.col("p_partkey").alias("product_id"), F.col("p_type").alias("category"),
                    F.coalesce(F.col("product_category_name_english"), F.lower("p_type")).alias("category_english"),
                    F.col("p_brand").alias("brand"))


@query("inventory_after_sales", with_views("""
SELECT coalesce(i.product_id, s.product_id) AS product_id, coalesce(i.warehouse_id, s.warehouse_id) AS warehouse_id,
       CAST(greatest(coalesce(i.on_hand_qty, 0) - coalesce(s.sold_qty, 0), 0) AS BIGINT) AS on_hand_qty,
       i.reserved_qty, CAST(coalesce(s.sold_qty, 0) AS BIGINT) AS sold_qty,
       CAST(greatest(coalesce(s.sold_qty, 0) - coalesce(i.on_hand_qty, 0), 0) AS BIGINT) AS short_qty, i.product_id IS NOT NULL AS in_stock
FROM v_inventory i FULL JOIN (
  SELECT l_partkey AS product_id, l_suppkey % 3 AS warehouse_id, CAST(sum(CAST(l_quantity AS INTEGER)) AS BIGINT) AS sold_qty
  FROM lineitem WHERE l_shipdate >= DATE '1998-01-01' GROUP BY 1, 2) s
ON i.product_id = s.product_id AND i.warehouse_id = s.warehouse_id""", ["v_inventory"]))
def inventory_after_sales(spark, sf):
    """Stock after the day's sales; what is not in stock comes out as short."""
    li = table(spark, sf, "lineitem").where(F.col("l_shipdate") >= F.lit("1998-01-01").cast("timestamp_ntz"))
    sales = li.select(F.col("l_partkey").alias("product_id"), (F.col("l_suppkey") % 3).alias("warehouse_id"),
                      F.col("l_quantity").cast("int").alias("qty"))
    out = agg.stock_after_sales(view(spark, sf, "v_inventory"), sales, ["product_id", "warehouse_id"], "on_hand_qty", "qty")
    return out.select("product_id", "warehouse_id", "on_hand_qty", "reserved_qty", "sold_qty", "short_qty", "in_stock")


@query("gold_daily_sales", """
SELECT strftime(CAST(l_shipdate AS DATE), '%Y-%m-%d') AS ship_dt, l_returnflag AS return_flag,
       count(*) AS n_lines, CAST(sum(CAST(l_quantity AS DECIMAL(18,2))) AS DOUBLE) AS qty,
       CAST(sum(CAST(l_extendedprice AS DECIMAL(18,2)) * (1 - CAST(l_discount AS DECIMAL(18,2)))) AS DOUBLE) AS revenue
FROM (SELECT DISTINCT l_orderkey, l_linenumber, l_returnflag, l_shipdate, l_quantity, l_extendedprice, l_discount
      FROM lineitem WHERE l_orderkey IS NOT NULL AND l_shipdate IS NOT NULL)
GROUP BY 1, 2""")
def gold_daily_sales(spark, sf):
    """K8: bronze (raw lines) -> silver (keyed, copies removed, only the columns
    that gold needs, written once) -> gold (daily sales per return flag)."""
    cols = ["l_orderkey", "l_linenumber", "l_returnflag", "l_shipdate", "l_quantity", "l_extendedprice", "l_discount"]
    bronze = table(spark, sf, "lineitem").select(*cols)
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/silver-{uuid.uuid4().hex}"
    dd.distinct_rows(bronze.where(F.col("l_orderkey").isNotNull() & F.col("l_shipdate").isNotNull())).write.parquet(path)
    silver = spark.read.parquet(path)
    g = agg.grouped_agg(
        silver.withColumn("ship_dt", F.date_format("l_shipdate", "yyyy-MM-dd")).withColumnRenamed("l_returnflag", "return_flag"),
        ["ship_dt", "return_flag"],
        {"n_lines": F.count(F.lit(1)),
         "qty": F.sum(F.col("l_quantity").cast("decimal(18,2)")),
         "revenue": F.sum(F.col("l_extendedprice").cast("decimal(18,2)") * (1 - F.col("l_discount").cast("decimal(18,2)")))})
    return g.select("ship_dt", "return_flag", "n_lines", F.col("qty").cast("double").alias("qty"),
                    F.col("revenue").cast("double").alias("revenue"))


@query("fact_order_items", f"""
SELECT l_orderkey AS order_key, CAST(l_linenumber AS BIGINT) AS line_no, l_partkey AS part_key, l_suppkey AS supplier_key,
       CAST({MONEY.format('l_quantity')} AS DOUBLE) AS units, CAST({NET_SQL} AS DOUBLE) AS net, '{RUN_DT}' AS dt
FROM lineitem""")
def fact_order_items(spark, sf):
    """Order-lines fact from its config."""
    return jobs.fact_load(table(spark, sf, "lineitem"), S.ORDER_LINES_CFG, RUN_DT)


@query("fact_payments", with_views(f"SELECT {PAYMENT_COLS_SQL}, '{RUN_DT}' AS dt FROM v_payments", ["v_payments"]))
def fact_payments(spark, sf):
    """Payments fact from its config."""
    return jobs.fact_load(view(spark, sf, "v_payments"), S.INSTALMENTS_CFG, RUN_DT)


@query("fact_payments_delta", with_views(f"""
SELECT DISTINCT {PAYMENT_COLS_SQL}, '{RUN_DT}' AS dt FROM v_payments p JOIN v_orders_delta d USING (order_id) WHERE d.op IN ('I', 'C')""",
                                         ["v_payments", "v_orders_delta"]))
def fact_payments_delta(spark, sf):
    """Payments of a change feed; the config takes inserts and changes."""
    feed = view(spark, sf, "v_payments").join(view(spark, sf, "v_orders_delta").select("order_id", "op"), "order_id")
    return jobs.fact_load(feed, S.INSTALMENTS_CFG, RUN_DT)


@query("fact_shipments", with_views(f"SELECT {SHIPMENT_COLS_SQL}, '{RUN_DT}' AS dt FROM ship", ["v_shipments"], [("ship", SHIP_SQL)]))
def fact_shipments(spark, sf):
    """Shipments fact from its config."""
    return jobs.fact_load(jobs.derive_shipments(view(spark, sf, "v_shipments")), S.TRANSIT_CFG, RUN_DT)


@query("fact_returns", with_views(f"""
SELECT strftime(return_ts, '%Y-%m') AS back_in, CAST(refund_amount * 100 AS BIGINT) AS cents, return_reason = 'DAMAGED' AS damage,
       CAST(order_id AS VARCHAR) || '#' || CAST(line_no AS VARCHAR) AS line, '{RUN_DT}' AS dt FROM v_returns""", ["v_returns"]))
def fact_returns(spark, sf):
    """Returns fact from its config."""
    return jobs.fact_load(view(spark, sf, "v_returns"), S.RETURN_COSTS_CFG, RUN_DT)


@query("log_parse", with_views("""
SELECT line_no, nullif(regexp_extract(line, 'service=(\\S+)', 1), '') AS service,
       nullif(regexp_extract(line, 'request_id=(\\S+)', 1), '') AS request_id,
       nullif(regexp_extract(line, 'user_id=(\\S+)', 1), '') AS user_id,
       TRY_CAST(nullif(regexp_extract(line, 'latency_ms=(\\S+)', 1), '') AS BIGINT) AS latency_ms,
       TRY_CAST(nullif(regexp_extract(line, 'status=(\\S+)', 1), '') AS BIGINT) AS status,
       nullif(regexp_extract(line, 'error_code=(\\S+)', 1), '') AS error_code,
       TRY_CAST(nullif(regexp_extract(line, '^(\\d{4}-\\d{2}-\\d{2} \\d{2}:\\d{2}:\\d{2})', 1), '') AS TIMESTAMP) AS log_ts
FROM v_log_lines""", ["v_log_lines"]))
def log_parse(spark, sf):
    """Gateway log lines -> typed fields, garbage lines keep nulls."""
    return parse_log_lines(view(spark, sf, "v_log_lines"))
