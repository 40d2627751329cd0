"""Data-quality, contract, run-metric, lineage and PII queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from ledgerline.operators import meta, quality
from ledgerline.operators.shape import build_select
from ledgerline.plans import specs as S
from ledgerline.plans.catalog import query
from ledgerline.plans.fixtures import table, view, with_views
from ledgerline.plans.spec import column_lineage, lineage_from_spec, observed_node_rows

# Fixed accepted values: the five market segments of the source table.
SEGMENTS = ("AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY")
SEG_SQL = ", ".join(f"'{s}'" for s in SEGMENTS)
NOT_NULL_COLS = ["customer_id", "customer_unique_id", "customer_city", "segment"]


@query("dq_not_null", with_views(" UNION ALL ".join(
    f"SELECT 'not_null' AS check_name, '{c}' AS column_name, count(*) AS rows, "
    f"CAST(count(*) - count({c}) AS BIGINT) AS failed, count(*) = count({c}) AS passed FROM v_cust_d3"
    for c in NOT_NULL_COLS), ["v_cust_d3"]))
def dq_not_null(spark, sf):
    """Null count per column, one pass."""
    return quality.not_null_counts(view(spark, sf, "v_cust_d3"), NOT_NULL_COLS)


@query("dq_unique", """
SELECT l_orderkey, l_linenumber, count(*) AS n_rows FROM lineitem GROUP BY 1, 2 HAVING count(*) > 1""")
def dq_unique(spark, sf):
    """(order, line number) keys that repeat."""
    li = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber")
    return quality.duplicate_keys(li, ["l_orderkey", "l_linenumber"])


@query("dq_accepted_values", with_views(f"""
SELECT customer_id, segment FROM v_cust_d2 WHERE segment IS NOT NULL AND segment NOT IN ({SEG_SQL})""", ["v_cust_d2"]))
def dq_accepted_values(spark, sf):
    """D3: rows whose segment is outside the accepted set."""
    check = {"check": "accepted_values", "column": "segment", "values": SEGMENTS}
    return quality.rows_failing(view(spark, sf, "v_cust_d2"), check).select("customer_id", "segment")


@query("dq_range", """
SELECT l_orderkey, l_linenumber, l_quantity FROM lineitem WHERE l_quantity IS NOT NULL AND (l_quantity < 1 OR l_quantity > 45)""")
def dq_range(spark, sf):
    """Quantities outside [1, 45]."""
    check = {"check": "range", "column": "l_quantity", "min": 1, "max": 45}
    li = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity")
    return quality.rows_failing(li, check)


FRESH_RUN_TS = "2024-02-01 00:00:00"


@query("dq_freshness", f"""
SELECT max(ts) AS newest_ts,
       CAST(epoch(TIMESTAMP '{FRESH_RUN_TS}') AS BIGINT) - CAST(floor(epoch(max(ts))) AS BIGINT) AS age_seconds,
       CAST(epoch(TIMESTAMP '{FRESH_RUN_TS}') AS BIGINT) - CAST(floor(epoch(max(ts))) AS BIGINT) > 86400 AS is_stale
FROM events""")
def dq_freshness(spark, sf):
    """Newest event time and its age at the run time (limit one day)."""
    return quality.freshness(table(spark, sf, "events").select("ts"), "ts", FRESH_RUN_TS, 86400)


REPORT_CHECKS = [
    {"check": "not_null", "column": "customer_id"},
    {"check": "not_null", "column": "segment"},
    {"check": "accepted_values", "column": "segment", "values": SEGMENTS},
    {"check": "range", "column": "zip_code_prefix", "min": 0, "max": 20},
    {"check": "unique", "columns": ["customer_id"]},
    {"check": "freshness", "column": "last_updated_dt", "max_age_seconds": 86400},
]
REPORT_RUN_TS = "2019-01-03 12:00:00"


@query("dq_report", with_views(f"""
SELECT 'not_null' AS check_name, 'customer_id' AS column_name, count(*) AS rows,
       CAST(count(*) - count(customer_id) AS BIGINT) AS failed, count(*) = count(customer_id) AS passed FROM d
UNION ALL
SELECT 'not_null', 'segment', count(*), CAST(count(*) - count(segment) AS BIGINT), count(*) = count(segment) FROM d
UNION ALL
SELECT 'accepted_values', 'segment', count(*), CAST(count(*) FILTER (WHERE segment IS NOT NULL AND segment NOT IN ({SEG_SQL})) AS BIGINT),
       count(*) FILTER (WHERE segment IS NOT NULL AND segment NOT IN ({SEG_SQL})) = 0 FROM d
UNION ALL
SELECT 'range', 'zip_code_prefix', count(*), CAST(count(*) FILTER (WHERE zip_code_prefix < 0 OR zip_code_prefix > 20) AS BIGINT),
       count(*) FILTER (WHERE zip_code_prefix < 0 OR zip_code_prefix > 20) = 0 FROM d
UNION ALL
SELECT 'unique', 'customer_id', CAST(sum(n) AS BIGINT), CAST(coalesce(sum(n) FILTER (WHERE n > 1), 0) AS BIGINT),
       coalesce(sum(n) FILTER (WHERE n > 1), 0) = 0 FROM (SELECT customer_id, count(*) AS n FROM d GROUP BY 1)
UNION ALL
SELECT 'freshness', 'last_updated_dt', 1,
       CAST(epoch(TIMESTAMP '{REPORT_RUN_TS}') - epoch(CAST(max(last_updated_dt) AS TIMESTAMP)) > 86400 AS BIGINT),
       NOT (epoch(TIMESTAMP '{REPORT_RUN_TS}') - epoch(CAST(max(last_updated_dt) AS TIMESTAMP)) > 86400) FROM d""",
    ["v_cust_d2"], [("d", "SELECT * FROM v_cust_d2")]))
def dq_report(spark, sf):
    """Every check of a table as one long report (row-level checks in one pass)."""
    return quality.dq_report(view(spark, sf, "v_cust_d2"), REPORT_CHECKS, run_ts=REPORT_RUN_TS)


CONTRACT = [
    {"name": "customer_id", "type": "bigint", "nullable": False},
    {"name": "label", "type": "bigint"},
    {"name": "nation_code", "type": "bigint"},
    {"name": "nation", "type": "string"},
    {"name": "region", "type": "string"},
    {"name": "market", "type": "string", "nullable": False},
    {"name": "email", "type": "string"},
]


@query("contract_violations", with_views("""
SELECT 'customer_id' AS column_name, 'bigint' AS declared_type, 'bigint' AS actual_type, false AS missing, false AS type_mismatch,
       CAST(count(*) - count(customer_id) AS BIGINT) AS null_violations,
       CAST(count(*) FILTER (WHERE customer_id IS NOT NULL AND TRY_CAST(customer_id AS BIGINT) IS NULL) AS BIGINT) AS cast_failures FROM d
UNION ALL
SELECT 'label', 'bigint', 'string', false, true, 0,
       CAST(count(*) FILTER (WHERE label IS NOT NULL AND TRY_CAST(label AS BIGINT) IS NULL) AS BIGINT) FROM d
UNION ALL
SELECT 'nation_code', 'bigint', 'int', false, true, 0,
       CAST(count(*) FILTER (WHERE nation_code IS NOT NULL AND TRY_CAST(nation_code AS BIGINT) IS NULL) AS BIGINT) FROM d
UNION ALL
SELECT 'nation', 'string', 'string', false, false, 0, 0
UNION ALL
SELECT 'region', 'string', 'string', false, false, 0, 0
UNION ALL
SELECT 'market', 'string', 'string', false, false, CAST(count(*) - count(market) AS BIGINT), 0 FROM d
UNION ALL
SELECT 'email', 'string', NULL, true, false, NULL, NULL""",
    ["v_cust_d3"], [("d", """
SELECT customer_id, segment AS market, upper(trim(customer_city)) AS nation, lower(trim(customer_state)) AS region,
       CAST(zip_code_prefix AS INTEGER) AS nation_code, customer_unique_id AS label FROM v_cust_d3""")]))
def contract_violations(spark, sf):
    """Declared names, types and nullability checked against the output
    of the spec projection, violations counted in one aggregate."""
    out = build_select(view(spark, sf, "v_cust_d3"), S.BUYER_SPEC["columns"])
    return quality.contract_violations(out, CONTRACT)


@query("run_metrics", with_views(f"""
SELECT 'r20190102' AS run_id, '2019-01-02' AS run_dt, 'dim_customer' AS job,
       CASE WHEN count(*) FILTER (WHERE segment IS NULL OR segment NOT IN ({SEG_SQL})) > 0 THEN 'WARN' ELSE 'SUCCESS' END AS status,
       count(*) AS rows_in, count(DISTINCT customer_id) AS rows_out,
       CAST(count(*) FILTER (WHERE segment IS NULL OR segment NOT IN ({SEG_SQL})) AS BIGINT) AS dq_failed
FROM v_cust_d2""", ["v_cust_d2"]))
def run_metrics(spark, sf):
    """Rows in, rows out after keyed dedupe, DQ failures, status."""
    seg = F.col("segment")
    bad = seg.isNull() | ~seg.isin(list(SEGMENTS))
    return meta.run_metrics(view(spark, sf, "v_cust_d2"), ["customer_id"], bad, "r20190102", "2019-01-02", "dim_customer")


def _lineage_edges():
    return lineage_from_spec(S.ORDER_VALUE_SPEC) + lineage_from_spec(S.BUYER_SPEC)


def _edges_sql():
    rows = ", ".join(f"('{u}', '{d}')" for u, d, _ in _lineage_edges())
    return f"SELECT DISTINCT * FROM (VALUES {rows}) t(upstream, downstream)"


_PLACED = "SELECT o_orderkey FROM orders WHERE o_orderkey IS NOT NULL AND o_custkey IS NOT NULL"
NODE_ROWS_SQL = f"""
SELECT 'orders' AS node, count(*) AS n FROM orders
UNION ALL SELECT 'lineitem', count(*) FROM lineitem
UNION ALL SELECT 'line_values', count(*) FROM lineitem
UNION ALL SELECT 'per_order', count(*) FROM (SELECT l_orderkey FROM lineitem GROUP BY 1)
UNION ALL SELECT 'placed', count(*) FROM ({_PLACED})
UNION ALL SELECT 'valued', count(*) FROM ({_PLACED}) o LEFT JOIN (SELECT l_orderkey FROM lineitem GROUP BY 1) a ON o.o_orderkey = a.l_orderkey
UNION ALL SELECT 'order_value', count(*) FROM ({_PLACED}) o LEFT JOIN (SELECT l_orderkey FROM lineitem GROUP BY 1) a ON o.o_orderkey = a.l_orderkey"""


@query("lineage_edges", with_views("""
SELECT r.upstream, r.downstream, min(r.depth) AS depth, u.n AS upstream_rows, d.n AS downstream_rows
FROM reach r LEFT JOIN node_rows u ON r.upstream = u.node LEFT JOIN node_rows d ON r.downstream = d.node
GROUP BY r.upstream, r.downstream, u.n, d.n""", ctes=[
    ("edges", _edges_sql()),
    ("reach", """SELECT upstream, downstream, 1 AS depth FROM edges
UNION SELECT r.upstream, e.downstream, r.depth + 1 FROM reach r JOIN edges e ON r.downstream = e.upstream"""),
    ("node_rows", NODE_ROWS_SQL),
], recursive=True))
def lineage_edges(spark, sf):
    """Transitive lineage of the two specs (iterated joins), with the row
    count of every node, observed while the batch spec's target is computed."""
    closure = meta.lineage_closure(meta.edges_frame(spark, _lineage_edges()))
    frames = {"orders": table(spark, sf, "orders"), "lineitem": table(spark, sf, "lineitem")}
    counts = observed_node_rows(S.ORDER_VALUE_SPEC, frames, {"run_dt": "2019-01-02", "run_id": "r"})
    node_rows = spark.createDataFrame(list(counts.items()), "node string, rows bigint")
    up = node_rows.select(F.col("node").alias("upstream"), F.col("rows").alias("upstream_rows"))
    down = node_rows.select(F.col("node").alias("downstream"), F.col("rows").alias("downstream_rows"))
    return (closure.join(up, "upstream", "left").join(down, "downstream", "left")
            .select("upstream", "downstream", "depth", "upstream_rows", "downstream_rows"))


@query("dq_report_empty", with_views("""
SELECT 'not_null' AS check_name, 'segment' AS column_name, count(*) AS rows, CAST(0 AS BIGINT) AS failed, count(*) = 0 AS passed FROM e
UNION ALL SELECT 'unique', 'customer_id', count(*), CAST(0 AS BIGINT), count(*) = 0 FROM e
UNION ALL SELECT 'freshness', 'last_updated_dt', 1, CAST(1 AS BIGINT), false""", ["v_cust_d2"],
    [("e", "SELECT * FROM v_cust_d2 WHERE customer_id < 0")]))
def dq_report_empty(spark, sf):
    """A filter that no row passes leaves verdicts, not nulls: nothing
    failed, but the table is stale."""
    none = view(spark, sf, "v_cust_d2").where("customer_id < 0")
    return quality.dq_report(none, [{"check": "not_null", "column": "segment"}, {"check": "unique", "columns": ["customer_id"]},
                                    {"check": "freshness", "column": "last_updated_dt", "max_age_seconds": 86400}], run_ts=REPORT_RUN_TS)


PII_COLS = ["text", "source", "lang"]
PII_THRESHOLD = 0.005


@query("pii_tags", " UNION ALL ".join(
    f"SELECT '{c}' AS column_name, '{p}' AS pii_type, count(*) AS rows, "
    f"CAST(count(*) FILTER (WHERE regexp_matches({c}, '{rx}')) AS BIGINT) AS hit_rows, "
    f"count(*) FILTER (WHERE regexp_matches({c}, '{rx}')) / count(*) AS hit_rate, "
    f"count(*) FILTER (WHERE regexp_matches({c}, '{rx}')) / count(*) > {PII_THRESHOLD} AS tagged FROM documents"
    for c in PII_COLS for p, rx in meta.PII_PATTERNS.items()))
def pii_tags(spark, sf):
    """PII hit rate per document column and pattern, tagged above 0.5 %."""
    return meta.pii_hit_rates(table(spark, sf, "documents").select(*PII_COLS), PII_COLS, threshold=PII_THRESHOLD)


@query("pii_scan_documents", "SELECT doc_id, " + ", ".join(
    f"CAST(len(regexp_extract_all(text, '{rx}')) AS BIGINT) AS n_{p}" for p, rx in meta.PII_PATTERNS.items())
    + " FROM documents")
def pii_scan_documents(spark, sf):
    """D9 per document: PII matches counted over each whole text."""
    return meta.pii_counts(table(spark, sf, "documents").select("doc_id", "text"), "doc_id", "text")


#: The lineage of TEXT_PROFILE_SPEC written out, for the oracle.
_TEXT_EDGES = [("documents.doc_id", "heads.doc_id"), ("documents.source", "heads.source"), ("documents.text", "heads.head"),
               ("documents.n_chars", "heads.size"), ("documents.text", "heads.shout"), ("documents.n_chars", "heads.big"),
               ("labels.doc_id", "marked.doc_id"), ("labels.quality", "marked.fine"),
               *[(f"heads.{c}", f"judged.{c}") for c in ("doc_id", "source", "head", "size", "shout", "big")],
               ("marked.doc_id", "judged.doc_id"), ("marked.fine", "judged.fine"),
               *[(f"judged.{c}", f"text_profile.{c}") for c in ("doc_id", "source", "head", "size", "shout", "big", "fine")]]


@query("pii_lineage", with_views("""
SELECT column_name, tag, origin, min(hops) AS hops FROM carried GROUP BY ALL""", ctes=[
    ("edges(upstream, downstream)", "VALUES " + ", ".join(f"('{a}', '{b}')" for a, b in _TEXT_EDGES)),
    ("tags", " UNION ALL ".join(
        f"SELECT 'documents.{c}' AS column_name, '{t}' AS tag FROM documents HAVING count(CASE WHEN regexp_matches({c}, '{rx}') THEN 1 END) > 0"
        for c in ("text", "source") for t, rx in meta.PII_PATTERNS.items())),
    ("carried(column_name, tag, origin, hops)", """
SELECT column_name, tag, column_name, 0 FROM tags
UNION
SELECT e.downstream, c.tag, c.origin, c.hops + 1 FROM carried c JOIN edges e ON e.upstream = c.column_name""")], recursive=True))
def pii_lineage(spark, sf):
    """Personal-data tags of source columns, found in the data, carried to
    every column of a spec that is computed from them."""
    sources = {t: table(spark, sf, t) for t in ("documents", "labels")}
    found = meta.pii_hit_rates(sources["documents"], ["text", "source"])
    tags = found.where("tagged").select(F.concat(F.lit("documents."), "column_name").alias("column_name"), F.col("pii_type").alias("tag"))
    edges = spark.createDataFrame(column_lineage(S.TEXT_PROFILE_SPEC, sources), "upstream string, downstream string")
    return meta.carry_tags(edges, tags).withColumn("hops", F.col("hops").cast("bigint"))
