"""Run metadata, lineage and PII tags."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ledgerline.session import cut_lineage

RUN_LOG_SCHEMA = ("run_id string, run_dt string, job string, status string, rows_in bigint, rows_out bigint, "
                  "dq_failed bigint, started_at timestamp, finished_at timestamp, duration_s double, error string")

# Fixed PII patterns (written to behave the same in Java regex and RE2).
PII_PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Za-z]{2,}",
    "phone": r"\+[0-9]{1,3} ?\(?[0-9]{3}\)? ?[0-9]{3}-[0-9]{4}",
    "ipv4": r"[0-9]{1,3}\.[0-9]{1,3}\.[0-9]{1,3}\.[0-9]{1,3}",
}
# A literal that every match of a pattern contains: a plain substring test (fast
# byte search) skips the regex on values that cannot match. It belongs to the
# pattern's text, so a caller's own pattern of the same name is never cut short.
PII_REQUIRED = {PII_PATTERNS["email"]: "@", PII_PATTERNS["phone"]: "+"}


def _matches(c, rx: str):
    hit = c.rlike(rx)
    need = PII_REQUIRED.get(rx)
    return (c.contains(need) & hit) if need else hit


# ---------------------------------------------------------------- run metrics

def observe_counts(df: DataFrame, name: str, **conds) -> tuple[DataFrame, Observation]:
    """Attach row counters that are filled in while ``df`` is written (A10),
    instead of a second action on the same data."""
    obs = Observation(name)
    metrics = [F.count(F.lit(1)).alias("rows")]
    metrics += [F.sum(F.when(c, 1).otherwise(0)).alias(k) for k, c in conds.items()]
    return df.observe(obs, *metrics), obs


def run_log_row(spark: SparkSession, run_id: str, run_dt: str, job: str, rows_in: int, rows_out: int,
                dq_failed: int, started: dt.datetime, finished: dt.datetime, error: str | None = None) -> DataFrame:
    """One run-log row (D7); append it to the run-log table with a sink."""
    status = "FAILED" if error else ("WARN" if dq_failed else "SUCCESS")
    return spark.createDataFrame(
        [(run_id, run_dt, job, status, rows_in, rows_out, dq_failed, started, finished,
          (finished - started).total_seconds(), error)], RUN_LOG_SCHEMA)


def run_metrics(raw: DataFrame, keys: Sequence[str], dq_fail, run_id: str, run_dt: str, job: str) -> DataFrame:
    """Deterministic run metrics computed by Spark in one aggregate: rows in,
    rows out after keyed dedupe (distinct keys) and DQ failures."""
    return raw.agg(
        F.count(F.lit(1)).alias("rows_in"),
        F.count_distinct(*[F.col(k) for k in keys]).alias("rows_out"),
        F.count_if(dq_fail).alias("dq_failed"),
    ).select(F.lit(run_id).alias("run_id"), F.lit(run_dt).alias("run_dt"), F.lit(job).alias("job"),
             F.when(F.col("dq_failed") > 0, "WARN").otherwise("SUCCESS").alias("status"),
             "rows_in", "rows_out", "dq_failed")


# ---------------------------------------------------------------- lineage

def edges_frame(spark: SparkSession, edges: Sequence[tuple[str, str, str]]) -> DataFrame:
    """Lineage edges of one or more specs; their number is bounded by the spec size."""
    return spark.createDataFrame(list(edges), "upstream string, downstream string, kind string").distinct()


def lineage_closure(edges: DataFrame, max_rounds: int = 32, checkpoint_every: int = 1) -> DataFrame:
    """Every (upstream, downstream) pair connected by a path, with the
    shortest hop count (D8).

    Path doubling: each round joins the reachability table with itself, so
    paths up to 2^k hops are known after k rounds and a DAG of depth d needs
    about log2(d) rounds (one small count per round to detect the fixpoint).
    The plan is cut with a reliable checkpoint every few rounds. The result
    holds all connected pairs; its size is bounded by the specs (their nodes
    squared). Raises rather than return an unfinished closure.
    """
    reach = (edges.select("upstream", "downstream").distinct().withColumn("depth", F.lit(1))
             .groupBy("upstream", "downstream").agg(F.min("depth").alias("depth")))
    n = reach.count()
    for i in range(1, max_rounds + 1):
        a, b = reach.alias("a"), reach.alias("b")
        step = (a.join(b, F.col("a.downstream") == F.col("b.upstream"))
                .select(F.col("a.upstream"), F.col("b.downstream"), (F.col("a.depth") + F.col("b.depth")).alias("depth")))
        reach = reach.unionByName(step).groupBy("upstream", "downstream").agg(F.min("depth").alias("depth"))
        if i % checkpoint_every == 0:
            reach = cut_lineage(reach)
        m = reach.count()
        if m == n:
            return reach
        n = m
    raise RuntimeError(f"lineage deeper than 2^{max_rounds} steps: the closure is not complete")


def carry_tags(edges: DataFrame, tags: DataFrame, max_rounds: int = 64) -> DataFrame:
    """Tags carried along lineage (D9): (column_name, tag, origin, hops) for every column
    that a tagged one flows into, and the tagged ones themselves (0 hops); ``hops`` is
    the shortest way.

    ``edges`` (upstream, downstream) and ``tags`` (column_name, tag) are bounded by the
    specs. Each round joins only what the last one found new, so a round costs one
    small join and a cycle ends."""
    found = frontier = cut_lineage(tags.select("column_name", "tag", F.col("column_name").alias("origin"), F.lit(0).alias("hops")).distinct())
    key = ["column_name", "tag", "origin"]
    for _ in range(max_rounds):
        step = frontier.join(edges, frontier["column_name"] == edges["upstream"]).select(
            F.col("downstream").alias("column_name"), "tag", "origin", (F.col("hops") + 1).alias("hops")).distinct()
        frontier = cut_lineage(step.join(found, key, "left_anti"))
        if frontier.isEmpty():
            return found
        found = found.unionByName(frontier)
    raise RuntimeError(f"tags still move after {max_rounds} rounds")


def node_row_counts(frames: Mapping[str, DataFrame]) -> DataFrame:
    """Row count of every named node of a pipeline (lineage run metadata),
    each a global count (partial per task), unioned into one small frame."""
    out = None
    for name, df in frames.items():
        one = df.agg(F.count(F.lit(1)).alias("rows")).select(F.lit(name).alias("node"), "rows")
        out = one if out is None else out.unionByName(one)
    return out


# ---------------------------------------------------------------- PII

def pii_hit_rates(df: DataFrame, columns: Sequence[str], patterns: Mapping[str, str] = PII_PATTERNS,
                  threshold: float = 0.0) -> DataFrame:
    """Share of rows per string column matching each PII pattern, in one
    aggregate over whole values; ``tagged`` when the share exceeds ``threshold``."""
    aggs = [F.count(F.lit(1)).alias("__rows")]
    cells = []
    for c in columns:
        for p, rx in patterns.items():
            name = f"__{c}__{p}"
            aggs.append(F.count_if(_matches(F.col(c), rx)).alias(name))
            cells.append((c, p, name))
    one = df.agg(*aggs)
    rows = F.array(*[F.struct(F.lit(c).alias("column_name"), F.lit(p).alias("pii_type"),
                              F.col("__rows").alias("rows"), F.col(n).alias("hit_rows")) for c, p, n in cells])
    out = one.select(F.inline(rows)).withColumn(
        "hit_rate", F.when(F.col("rows") > 0, F.col("hit_rows") / F.col("rows")).otherwise(F.lit(0.0)))
    return out.withColumn("tagged", F.col("hit_rate") > F.lit(threshold))


def pii_counts(df: DataFrame, id_col: str, text_col: str, patterns: Mapping[str, str] = PII_PATTERNS) -> DataFrame:
    """Per row: number of matches of each PII pattern in the whole text."""
    def count(rx):
        n = F.regexp_count(F.col(text_col), F.lit(rx)).cast("bigint")
        need = PII_REQUIRED.get(rx)
        return F.when(F.col(text_col).contains(need), n).otherwise(
            F.when(F.col(text_col).isNotNull(), F.lit(0).cast("bigint"))) if need else n

    return df.select(id_col, *[count(rx).alias(f"n_{p}") for p, rx in patterns.items()])
