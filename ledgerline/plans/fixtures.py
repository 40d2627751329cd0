"""Derived input views (FIXTURES.md §3).

Each view is a SELECT over the driver tables that runs unchanged in Spark SQL
and DuckDB, so the Spark queries and the DuckDB oracle see the same inputs.
They turn the TPC-H-like tables into the snapshot / delta / stream shapes the
operators consume: three daily customer snapshots, product and supplier
snapshots, order and inventory change feeds, a Kafka-like raw event feed and
gateway log lines. All of them scale with the underlying tables.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

BASE_TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem",
    "events", "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
)

# name -> (dependencies, SELECT text)
VIEWS: dict[str, tuple[tuple[str, ...], str]] = {
    "v_customers": ((), """
SELECT c.c_custkey AS customer_id, c.c_name AS customer_unique_id, c.c_nationkey AS zip_code_prefix,
       '  ' || n.n_name || ' ' AS customer_city, ' ' || lower(r.r_name) AS customer_state, c.c_mktsegment AS segment
FROM customer c JOIN nation n ON c.c_nationkey = n.n_nationkey JOIN region r ON n.n_regionkey = r.r_regionkey"""),
    "v_cust_d1": (("v_customers",), """
SELECT customer_id, customer_unique_id, zip_code_prefix, customer_city, customer_state, segment, date '2017-01-01' AS last_updated_dt
FROM v_customers WHERE customer_id % 50 <> 7"""),
    "v_cust_d2": (("v_customers",), """
SELECT customer_id, customer_unique_id, zip_code_prefix, customer_city, customer_state,
       CASE WHEN customer_id % 20 = 0 THEN 'MACHINERY' ELSE segment END AS segment, date '2019-01-02' AS last_updated_dt
FROM v_customers WHERE customer_id % 40 <> 3
UNION ALL
SELECT customer_id, customer_unique_id, zip_code_prefix, customer_city, customer_state, 'STALE' AS segment, date '2016-06-01' AS last_updated_dt
FROM v_customers WHERE customer_id % 25 = 1 AND customer_id % 40 <> 3"""),
    "v_cust_d3": (("v_customers",), """
SELECT customer_id, customer_unique_id, zip_code_prefix, customer_city, customer_state,
       CASE WHEN customer_id % 30 = 1 THEN 'FURNITURE' WHEN customer_id % 90 = 2 THEN NULL ELSE segment END AS segment, date '2019-01-03' AS last_updated_dt
FROM v_customers WHERE customer_id % 40 <> 13"""),
    "v_prod_d1": ((), """
SELECT p_partkey AS product_id, p_type AS category, p_size AS weight_g, p_brand AS brand FROM part WHERE p_partkey % 100 <> 9"""),
    "v_prod_d2": ((), """
SELECT p_partkey AS product_id, p_type AS category, CASE WHEN p_partkey % 50 = 4 THEN p_size + 1 ELSE p_size END AS weight_g, p_brand AS brand
FROM part WHERE p_partkey % 100 <> 17"""),
    "v_supp_d1": ((), """
SELECT s.s_suppkey AS supplier_id, '  ' || n.n_name AS city, lower(r.r_name) AS state, 'ACTIVE' AS supplier_status
FROM supplier s JOIN nation n ON s.s_nationkey = n.n_nationkey JOIN region r ON n.n_regionkey = r.r_regionkey"""),
    "v_supp_d2": (("v_supp_d1",), """
SELECT supplier_id, city, state, CASE WHEN supplier_id % 10 = 3 THEN 'SUSPENDED' ELSE supplier_status END AS supplier_status
FROM v_supp_d1 WHERE supplier_id % 10 <> 6"""),
    "v_orders_delta": ((), """
SELECT o_orderkey AS order_id, o_custkey AS customer_id, o_orderstatus AS order_status, o_orderdate AS order_ts,
       CASE WHEN o_orderkey % 10 = 0 THEN 'D' WHEN o_orderkey % 10 < 4 THEN 'C' ELSE 'I' END AS op, 2 AS seq
FROM orders
UNION ALL
SELECT o_orderkey, o_custkey, 'X', o_orderdate, 'C', 2 FROM orders WHERE o_orderkey % 20 = 0
UNION ALL
SELECT o_orderkey, o_custkey, 'OLD', o_orderdate, 'I', 1 FROM orders WHERE o_orderkey % 20 = 1"""),
    "v_facts_delta": (("v_orders_delta",), """
SELECT order_id, customer_id, order_status, order_ts, op, seq FROM v_orders_delta
UNION ALL
SELECT order_id, customer_id, order_status, order_ts, op, seq + 1 FROM v_orders_delta WHERE op = 'I' AND order_id % 30 = 5"""),
    "v_addr_d1": (("v_cust_d1",), """
SELECT * FROM v_cust_d1"""),
    "v_addr_d2": (("v_cust_d2",), """
SELECT customer_id, customer_unique_id, zip_code_prefix, CASE WHEN customer_id % 12 = 5 THEN ' Moved ' || customer_city ELSE customer_city END AS customer_city,
       customer_state, segment, last_updated_dt FROM v_cust_d2"""),
    "v_orders_dated": ((), """
SELECT o_orderkey AS order_id, o_custkey AS customer_id, date '2018-12-31' + CAST(o_orderkey % 4 AS int) AS order_dt, CAST(o_totalprice AS decimal(18,2)) AS amount
FROM orders"""),
    "v_inventory": ((), """
SELECT l_partkey AS product_id, l_suppkey % 3 AS warehouse_id, CAST(sum(CAST(l_quantity AS int)) AS bigint) AS on_hand_qty,
       CAST(count(*) AS bigint) AS reserved_qty
FROM lineitem WHERE l_shipdate < date '1998-01-01' GROUP BY l_partkey, l_suppkey % 3"""),
    "v_inventory_delta": (("v_inventory",), """
SELECT product_id, warehouse_id, on_hand_qty + 10 AS on_hand_qty, reserved_qty, CASE WHEN product_id % 7 = 0 THEN 'D' ELSE 'C' END AS op, 1 AS seq
FROM v_inventory WHERE product_id % 5 = 0
UNION ALL
SELECT product_id, warehouse_id + 3, on_hand_qty, reserved_qty, 'I', 1 FROM v_inventory WHERE product_id % 11 = 0
UNION ALL
SELECT product_id, warehouse_id, on_hand_qty + 99, reserved_qty, 'C', 2 FROM v_inventory WHERE product_id % 35 = 0"""),
    "v_payments": ((), """
SELECT o_orderkey AS order_id, o_orderpriority AS payment_type, o_orderkey % 12 + 1 AS payment_installments, CAST(o_totalprice AS decimal(18,2)) AS payment_value FROM orders"""),
    "v_shipments": ((), """
SELECT o.o_orderkey AS order_id, o.o_orderstatus AS order_status, o.o_orderdate AS created_ts, min(l.l_shipdate) AS shipped_ts,
       CASE WHEN o.o_orderstatus = 'F' THEN max(l.l_shipdate) END AS delivered_ts
FROM orders o JOIN lineitem l ON o.o_orderkey = l.l_orderkey GROUP BY o.o_orderkey, o.o_orderstatus, o.o_orderdate"""),
    "v_reviews": ((), """
SELECT o_orderkey AS order_id, o_orderkey % 5 + 1 AS review_score FROM orders WHERE o_orderkey % 3 <> 0"""),
    "v_returns": ((), """
SELECT l_orderkey AS order_id, l_linenumber AS line_no, l_shipdate AS return_ts, CASE l_linestatus WHEN 'O' THEN 'DAMAGED' ELSE 'WRONG_ITEM' END AS return_reason,
       CAST(l_extendedprice AS decimal(18,2)) AS refund_amount
FROM lineitem WHERE l_returnflag = 'R'"""),
    "v_events_arrival": ((), """
SELECT 2 * event_id AS kafka_offset, CAST(user_id % 4 AS int) AS kafka_partition, ts AS ingest_ts, event_id,
       CASE WHEN event_id % 50 = 9 THEN ts - interval '30' minute ELSE ts END AS event_time, user_id, event_type, CAST(value AS decimal(18,2)) AS amount
FROM events"""),
    "v_raw_events": (("v_events_arrival",), """
SELECT kafka_offset, kafka_partition, ingest_ts, 'k' || CAST(event_id AS string) AS msg_key,
       CASE WHEN event_id % 200 = 0 THEN '{"event_id":'
            WHEN event_id % 200 = 1 THEN '{"event_type":"' || event_type || '","event_ts":"' || replace(substr(CAST(event_time AS string), 1, 19), ' ', 'T') || '+00:00"}'
            ELSE '{"event_id":"e' || CAST(event_id AS string) || '","event_type":"' || event_type || '","event_ts":"'
                 || CASE WHEN event_id % 200 = 2 THEN 'not-a-time' WHEN event_id % 200 = 3 THEN '12:30:00' WHEN event_id % 200 = 4 THEN '2024'
                         ELSE replace(substr(CAST(event_time AS string), 1, 19), ' ', 'T') || '+00:00' END
                 || '","user_id":"u' || CAST(user_id AS string) || '","amount":' || CAST(amount AS string)
                 || CASE WHEN event_type = 'purchase' THEN ',"payment_method":"' || CASE WHEN user_id % 3 = 0 THEN 'card' ELSE 'transfer' END || '"' ELSE '' END
                 || ',"page":"' || event_type || '","device":{"os":"' || CASE WHEN user_id % 2 = 0 THEN 'ios' ELSE 'web' END || '","app_ver":"1.' || CAST(user_id % 10 AS string) || '"}}' END AS value
FROM v_events_arrival
UNION ALL
SELECT kafka_offset + 1, kafka_partition, ingest_ts + interval '1' day, 'k' || CAST(event_id AS string),
       '{"event_id":"e' || CAST(event_id AS string) || '","event_type":"' || event_type || '","event_ts":"' || replace(substr(CAST(event_time AS string), 1, 19), ' ', 'T') || '+00:00","user_id":"u' || CAST(user_id AS string) || '","amount":' || CAST(amount AS string) || '}'
FROM v_events_arrival WHERE event_id % 100 = 5"""),
    "v_log_lines": ((), """
SELECT event_id AS line_no,
       substr(CAST(ts AS string), 1, 19) || ' service=' || event_type || ' request_id=r' || CAST(event_id AS string) || ' user_id=u' || CAST(user_id AS string)
       || CASE WHEN event_id % 100 = 3 THEN ' garbage' ELSE ' latency_ms=' || CAST(event_id % 900 AS string) || ' status=' || CASE WHEN event_type = 'error' THEN '500 error_code=E' || CAST(event_id % 4 AS string) ELSE '200' END END AS line
FROM events"""),
}


def view_closure(names) -> list[str]:
    """Views needed by ``names``, dependencies first."""
    out: list[str] = []

    def visit(n: str) -> None:
        if n in out:
            return
        for d in VIEWS[n][0]:
            visit(d)
        out.append(n)

    for n in names:
        visit(n)
    return out


def _registry(spark: SparkSession) -> dict:
    # name -> sf_dir it is registered for, kept on the session object so a
    # query that asks for the same view again does not re-resolve its files.
    reg = getattr(spark, "_ledgerline_views", None)
    if reg is None:
        reg = {}
        spark._ledgerline_views = reg
    return reg


def _tables_of(sql: str) -> list[str]:
    return [t for t in BASE_TABLES if re.search(rf"\b{t}\b", sql)]


def register_tables(spark: SparkSession, sf_dir: str, tables=BASE_TABLES) -> None:
    reg = _registry(spark)
    for t in tables:
        if reg.get(t) != sf_dir:
            spark.read.parquet(f"{sf_dir}/{t}.parquet").createOrReplaceTempView(t)
            reg[t] = sf_dir


def register_views(spark: SparkSession, sf_dir: str, names=None) -> None:
    reg = _registry(spark)
    for n in view_closure(names or VIEWS.keys()):
        if reg.get(n) == sf_dir:
            continue
        register_tables(spark, sf_dir, _tables_of(VIEWS[n][1]))
        spark.sql(VIEWS[n][1]).createOrReplaceTempView(n)
        reg[n] = sf_dir


def view(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    register_views(spark, sf_dir, [name])
    return spark.table(name)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def with_views(body: str, views=(), ctes=(), recursive: bool = False) -> str:
    """DuckDB oracle text: fixture views (and extra named CTEs) as a WITH list."""
    parts = [f"{n} AS ({VIEWS[n][1].strip()})" for n in view_closure(views)]
    parts += [f"{n} AS ({q.strip()})" for n, q in ctes]
    if not parts:
        return body.strip()
    return ("WITH RECURSIVE " if recursive else "WITH ") + ",\n".join(parts) + "\n" + body.strip()
