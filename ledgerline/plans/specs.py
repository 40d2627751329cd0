"""Spec documents and load configs of the registered queries, over the driver tables.

Fixed values: the option names a runner understands (``sources``, ``transforms``,
``joins``, ``target``, ``keys``, ``dedupe``, ``columns``, ``scd2``, ``select_expr``,
``business_key``, ``scd2_columns``, ``effective_to_open``, rule names). The
documents themselves are written for these tables. Money is summed as
DECIMAL(18,2), so totals are exact.
"""

_MONEY = "cast({} as decimal(18,2))"

#: One row per order with what its lines add up to.
ORDER_VALUE_SPEC = {
    "name": "order_value",
    "mode": "batch",
    "sources": {
        "lineitem": {"format": "parquet", "path": "lineitem.parquet"},
        "orders": {"format": "parquet", "path": "orders.parquet"},
    },
    "transforms": [
        {"name": "line_values", "input": "lineitem",
         "select": {"order_key": "l_orderkey", "quantity": _MONEY.format("l_quantity"),
                    "net": f"{_MONEY.format('l_extendedprice')} * (1 - {_MONEY.format('l_discount')})",
                    "shipped_at": "l_shipdate", "sent_back": "l_returnflag = 'R'"}},
        {"name": "per_order", "input": "line_values", "group_by": ["order_key"],
         "agg": {"lines": "count(1)", "units": "sum(quantity)", "net_value": "sum(net)",
                 "lines_returned": "count_if(sent_back)", "last_ship": "max(shipped_at)"},
         "derive": {"value_per_unit": "cast(net_value as double) / cast(units as double)"}},
        {"name": "placed", "input": "orders",
         "filter": "o_orderkey is not null and o_custkey is not null",
         "select": {"order_key": "o_orderkey", "buyer_key": "o_custkey", "placed_at": "o_orderdate",
                    "urgency": "cast(substr(o_orderpriority, 1, 1) as int)"}},
    ],
    "joins": [{"left": "placed", "right": "per_order", "type": "left", "on": ["order_key"], "output": "valued"}],
    "dq": {"checks": [{"check": "not_null", "column": "buyer_key"}, {"check": "range", "column": "urgency", "min": 1, "max": 5},
                      {"check": "unique", "columns": ["order_key"]}]},
    "target": {"path": "order_value", "input": "valued", "partition_by": ["dt"], "add_columns": {"dt": "run_dt", "run_id": "run_id"}},
}

#: What is known of a source's texts; some of it is copied out of them.
TEXT_PROFILE_SPEC = {
    "name": "text_profile",
    "mode": "batch",
    "sources": {"documents": {"format": "parquet", "path": "documents.parquet"}, "labels": {"format": "parquet", "path": "labels.parquet"}},
    "transforms": [
        {"name": "heads", "input": "documents", "select": {"doc_id": "doc_id", "source": "source", "head": "substr(text, 1, 80)", "size": "n_chars"},
         "derive": {"shout": "upper(head)", "big": "size > 1000"}},
        {"name": "marked", "input": "labels", "select": {"doc_id": "doc_id", "fine": "quality = 1"}},
    ],
    "joins": [{"left": "heads", "right": "marked", "type": "left", "on": ["doc_id"], "output": "judged"}],
    "target": {"path": "text_profile", "input": "judged"},
}

#: Orders as they arrive: each once, typed, by month; what breaks the contract is a dead letter.
ORDER_FEED_SPEC = {
    "name": "order_feed",
    "mode": "stream",
    "source": {"format": "parquet", "path": "order_feed",
               "schema": "order_key bigint, buyer_key bigint, placed_at timestamp, priority string, price double"},
    "watermark": {"column": "placed_at", "delay": "3 days"},
    "dedupe": {"key": ["order_key"]},
    "transforms": [
        {"name": "known_buyers", "filter": "buyer_key is not null"},
        {"name": "priced", "input": "known_buyers", "derive": {"month": "date_format(placed_at, 'yyyy-MM')"}},
    ],
    "columns": [
        {"name": "order_key", "expr": "order_key", "type": "bigint", "nullable": False},
        {"name": "buyer_key", "expr": "buyer_key", "type": "bigint", "nullable": False},
        {"name": "urgency", "expr": "substr(priority, 1, 1)", "type": "int"},
        {"name": "price", "expr": "price", "type": "decimal(18,2)", "nullable": False},
        {"name": "month", "expr": "month", "type": "string"},
    ],
    "target": {"path": "order_feed", "partition_by": ["month"], "add_columns": {"run_id": "run_id"}},
    "trigger": {"available_now": True},
}

#: Events per type and hour, each hour once the watermark has closed it.
HOURLY_EVENTS_SPEC = {
    "name": "hourly_events",
    "mode": "stream",
    "source": {"format": "parquet", "path": "events", "schema": "event_id string, event_type string, amount double, event_time timestamp"},
    "watermark": {"column": "event_time", "delay": "2 hours"},
    "dedupe": {"key": ["event_id"]},
    "transforms": [{"name": "hourly", "group_by": ["event_type"], "window": "1 hour",
                    "agg": {"n_events": "count(1)", "total": "sum(cast(amount as decimal(18,2)))"}}],
    "columns": [{"name": "window_start", "expr": "window_start", "type": "timestamp", "nullable": False},
                {"name": "event_type", "expr": "event_type"}, {"name": "n_events", "expr": "n_events", "type": "bigint"},
                {"name": "total", "expr": "total", "type": "decimal(18,2)"}],
    "target": {"path": "hourly_events"},
}

#: Versions of a customer's place and market.
BUYER_SPEC = {
    "name": "buyer_history",
    "mode": "scd2",
    "source": {"format": "parquet", "path": "customers"},
    "keys": {"business": ["customer_id"]},
    "dedupe": {"enabled": True, "key": ["customer_id"], "order_by": ["last_updated_dt desc"]},
    "columns": [
        {"name": "customer_id", "expr": "customer_id", "type": "bigint", "nullable": False},
        {"name": "market", "expr": "segment", "type": "string"},
        {"name": "nation", "rule": "str.upper_trim", "args": ["customer_city"], "type": "string"},
        {"name": "region", "rule": "str.lower_trim", "args": ["customer_state"], "type": "string"},
        {"name": "nation_code", "expr": "cast(zip_code_prefix as int)", "type": "int"},
        {"name": "label", "expr": "customer_unique_id", "type": "string"},
    ],
    "scd2": {"track_columns": ["market", "nation", "region", "nation_code"], "effective_to_open": "9999-12-31 00:00:00",
             "on_missing": "keep"},
    "dq": {"checks": [{"check": "not_null", "column": "nation"}, {"check": "unique", "columns": ["customer_id"]}],
           "contract": True},
    "target": {"path": "buyer_history", "write_current_view": True, "current_view_path": "buyer_current"},
}

# select_expr configs (P1), one per star-schema load.
DIM_CUSTOMER_CFG = {
    "business_key": ["customer_id"],
    "select_expr": {"customer_id": "customer_id", "market": "segment", "nation": "upper(trim(customer_city))",
                    "region": "lower(trim(customer_state))", "nation_code": "cast(zip_code_prefix as int)", "label": "customer_unique_id"},
    "dedupe": {"key": ["customer_id"], "order_by": ["last_updated_dt desc"]},
    "scd2_columns": ["market", "nation", "region", "nation_code"],
}

#: Addresses are versions of their own (an order keeps the address of its day).
DIM_CUSTOMER_ADDRESS_CFG = {
    "business_key": ["address_key"],
    "select_expr": {"address_key": "concat('A', cast(customer_id as string))", "customer_id": "customer_id",
                    "nation": "upper(trim(customer_city))", "region": "lower(trim(customer_state))"},
    "dedupe": {"key": ["customer_id"], "order_by": ["last_updated_dt desc"]},
    "scd2_columns": ["nation", "region"],
}

DIM_PRODUCT_CFG = {
    "business_key": ["product_id"],
    "select_expr": {"product_id": "product_id", "kind": "category", "size_class": "cast(weight_g as int)", "brand": "brand"},
    "dedupe": {"key": ["product_id"], "order_by": []},
    "scd2_columns": ["kind", "size_class"],
}

#: Where goods come from, and whether they may come now.
DIM_SUPPLIER_CFG = {
    "business_key": ["supplier_id"],
    "select_expr": {"may_deliver": "supplier_status = 'ACTIVE'", "place": "concat_ws(', ', trim(city), upper(trim(state)))",
                    "supplier_id": "supplier_id"},
    "dedupe": {"key": ["supplier_id"], "order_by": []},
    "scd2_columns": ["may_deliver", "place"],
}

DIM_DATE_CFG = {
    "select_expr": {"date": "to_date(order_ts)", "year": "cast(year(order_ts) as bigint)", "quarter": "cast(quarter(order_ts) as bigint)",
                    "month": "cast(month(order_ts) as bigint)", "day": "cast(day(order_ts) as bigint)", "day_name": "date_format(order_ts, 'E')"},
    "dedupe": {"key": ["date"], "order_by": [], "functional": True},
}

#: The payment methods there are: a number for joins, a text for people.
DIM_PAYMENT_METHOD_CFG = {"select_expr": {"method_no": "cast(substr(payment_type, 1, 1) as bigint)", "shown_as": "lower(substr(payment_type, 3))"},
                          "dedupe": {"key": ["method_no"], "order_by": []}}

#: ``ops`` names the change rows a load takes from a delta.
#: When do buyers order? One row per new order, by quarter and weekday (1 is Monday).
ORDER_TIMES_CFG = {"op_col": "op", "ops": ["I"], "select_expr": {
    "buyer_key": "customer_id", "quarter": "concat(year(order_ts), '-Q', quarter(order_ts))",
    "weekday": "cast(extract(dayofweek_iso from order_ts) as bigint)", "order_key": "order_id"}}

ORDER_LINES_CFG = {"select_expr": {
    "order_key": "l_orderkey", "line_no": "cast(l_linenumber as bigint)", "part_key": "l_partkey", "supplier_key": "l_suppkey",
    "units": f"cast({_MONEY.format('l_quantity')} as double)",
    "net": f"cast({_MONEY.format('l_extendedprice')} * (1 - {_MONEY.format('l_discount')}) as double)"}}

#: What is due each month, and for how long?
INSTALMENTS_CFG = {"op_col": "op", "ops": ["I", "C"], "select_expr": {
    "months": "cast(payment_installments as bigint)", "due_a_month": "cast(payment_value as double) / payment_installments",
    "over_half_a_year": "payment_installments > 6", "order_key": "order_id"}}

#: How long were goods on the way, and which are still out?
TRANSIT_CFG = {"select_expr": {
    "still_out": "shipped_ts is not null and delivered_ts is null", "days_on_the_way": "cast(datediff(delivered_ts, shipped_ts) as bigint)",
    "left_in": "date_format(shipped_ts, 'yyyy-MM')", "order_key": "order_id"}}

#: What do returns cost by month, and how much of it is damage?
RETURN_COSTS_CFG = {"select_expr": {
    "back_in": "date_format(return_ts, 'yyyy-MM')", "cents": "cast(refund_amount * 100 as bigint)", "damage": "return_reason = 'DAMAGED'",
    "line": "concat(order_id, '#', line_no)"}}

#: What is free to sell at a site?
FREE_STOCK_CFG = {"op_col": "op", "key": ["site", "part_key"], "select_expr": {
    "site": "warehouse_id", "part_key": "product_id", "free": "greatest(on_hand_qty - reserved_qty, 0)"}}
