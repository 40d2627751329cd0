"""Data-quality checks, schema contract and alert rows.

Row-level checks (not null, accepted values, range) are evaluated together
in **one** aggregate pass and then turned into a long report with
``inline``; key uniqueness needs its own grouped aggregate (partial, so a hot
key costs one row per map task). Results are DataFrames, never driver loops.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

REPORT_COLS = ("check_name", "column_name", "rows", "failed", "passed")


def _fail_expr(check: Mapping) -> Column:
    kind, c = check["check"], F.col(check["column"])
    if kind == "not_null":
        return c.isNull()
    if kind == "accepted_values":
        return c.isNotNull() & ~c.isin(list(check["values"]))
    if kind == "range":
        lo, hi = check.get("min"), check.get("max")
        bad = F.lit(False)
        if lo is not None:
            bad = bad | (c < F.lit(lo))
        if hi is not None:
            bad = bad | (c > F.lit(hi))
        return c.isNotNull() & bad
    raise ValueError(f"not a row-level check: {kind}")


def _stale(newest: Column, run_ts: str, max_age_seconds: int) -> Column:
    age = F.unix_seconds(F.to_timestamp(F.lit(run_ts))) - F.unix_seconds(newest.cast("timestamp"))
    return F.coalesce(age > max_age_seconds, F.lit(True))


def row_check_aggs(checks: Sequence[Mapping], run_ts: str | None = None) -> list[Column]:
    """Aggregates of the row-level and freshness checks (``__rows``, ``__f0`` ...), for
    one pass of their own or for an observation on a table that is written anyway."""
    aggs = [F.count(F.lit(1)).alias("__rows")]
    for i, ch in enumerate(checks):
        if ch["check"] == "freshness":
            aggs.append(_stale(F.max(F.col(ch["column"])), run_ts, ch["max_age_seconds"]).cast("bigint").alias(f"__f{i}"))
        else:
            aggs.append(F.count_if(_fail_expr(ch)).alias(f"__f{i}"))
    return aggs


def row_check_rows(checks: Sequence[Mapping], got: Mapping) -> list[tuple]:
    """Report rows from the values of ``row_check_aggs``."""
    return [(ch["check"], ch["column"], 1 if ch["check"] == "freshness" else int(got["__rows"]), int(got[f"__f{i}"]), not got[f"__f{i}"])
            for i, ch in enumerate(checks)]


def row_checks_report(df: DataFrame, checks: Sequence[Mapping], run_ts: str | None = None) -> DataFrame:
    """Row-level and freshness checks in one pass -> one report row per check
    (D1, D3, D4, D5, D6). A table without rows fails no row-level check (0 rows,
    0 failed, passed) and is stale."""
    one = df.agg(*row_check_aggs(checks, run_ts))
    rows = F.array(*[F.struct(F.lit(ch["check"]).alias("check_name"), F.lit(ch["column"]).alias("column_name"),
                              (F.lit(1).cast("bigint") if ch["check"] == "freshness" else F.col("__rows")).alias("rows"),
                              F.col(f"__f{i}").alias("failed"))
                     for i, ch in enumerate(checks)])
    return one.select(F.inline(rows)).withColumn("passed", F.col("failed") == 0)


def not_null_counts(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Null count per column."""
    return row_checks_report(df, [{"check": "not_null", "column": c} for c in cols])


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Key values that occur more than once, with their count."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_rows")).where(F.col("n_rows") > 1)


def unique_report(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """D2 as a report row: rows whose key is not unique."""
    per = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
    return per.agg(
        F.lit("unique").alias("check_name"), F.lit(",".join(keys)).alias("column_name"),
        F.coalesce(F.sum("n"), F.lit(0)).cast("bigint").alias("rows"),
        F.coalesce(F.sum(F.when(F.col("n") > 1, F.col("n"))), F.lit(0)).cast("bigint").alias("failed"),
    ).withColumn("passed", F.col("failed") == 0)


def rows_failing(df: DataFrame, check: Mapping) -> DataFrame:
    """The offending rows of a row-level check."""
    return df.where(_fail_expr(check))


def freshness(df: DataFrame, ts_col: str, run_ts: str, max_age_seconds: int) -> DataFrame:
    """Newest timestamp, its age at ``run_ts`` and whether it is stale."""
    newest = F.max(F.col(ts_col)).cast("timestamp")
    age = F.unix_seconds(F.to_timestamp(F.lit(run_ts))) - F.unix_seconds(newest)
    return df.agg(newest.cast("timestamp_ntz").alias("newest_ts"), age.alias("age_seconds")).withColumn(
        "is_stale", F.col("age_seconds").isNull() | (F.col("age_seconds") > max_age_seconds))


def dq_report(df: DataFrame, checks: Sequence[Mapping], run_ts: str | None = None) -> DataFrame:
    """All checks of a table as one long report (D6). Row-level and freshness
    checks share one pass; each unique check adds a grouped aggregate."""
    one_pass = [c for c in checks if c["check"] != "unique"]
    parts = [row_checks_report(df, one_pass, run_ts)] if one_pass else []
    for c in checks:
        if c["check"] == "unique":
            parts.append(unique_report(df, c["columns"]))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def threshold_alerts(report: DataFrame, metric: str, threshold: float, alert_type: str) -> DataFrame:
    """Alert rows for a metric over a threshold."""
    return report.where(F.col(metric) > F.lit(threshold)).withColumn("alert_type", F.lit(alert_type))


def null_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows rejected by keyed operators because a business key is null."""
    cond = F.lit(False)
    for k in keys:
        cond = cond | F.col(k).isNull()
    return df.where(cond)


def contract_aggs(df: DataFrame, contract: Sequence[Mapping]) -> tuple[list[tuple], list[Column]]:
    """(name, declared type, actual type, present) of each declared column, and the
    aggregates that count nulls (``__n0`` ...) and failing casts (``__c0`` ...)."""
    actual = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    aggs, meta = [], []
    for i, c in enumerate(contract):
        name, typ = c["name"], c.get("type", "string")
        present = name in actual
        meta.append((name, typ, actual.get(name), present))
        if present:
            col = F.col(name)
            nulls = F.count_if(col.isNull()) if c.get("nullable", True) is False else F.lit(0)
            casts = F.count_if(col.isNotNull() & col.try_cast(typ).isNull())
        else:
            nulls, casts = F.lit(None), F.lit(None)
        aggs += [nulls.cast("bigint").alias(f"__n{i}"), casts.cast("bigint").alias(f"__c{i}")]
    return meta, aggs


def contract_rows(meta: Sequence[tuple], got: Mapping) -> list[tuple]:
    """Report rows from the values of ``contract_aggs``: what each column breaks."""
    out = []
    for i, (name, typ, actual, present) in enumerate(meta):
        failed = int(not present) + int(bool(present and actual != typ)) + int(got.get(f"__n{i}") or 0) + int(got.get(f"__c{i}") or 0)
        out.append(("contract", name, None, failed, failed == 0))
    return out


def contract_violations(df: DataFrame, contract: Sequence[Mapping]) -> DataFrame:
    """Check a DataFrame against declared columns.

    Per declared column: whether it exists, whether the Spark type matches,
    and (in one aggregate over the rows) how many rows break ``nullable:
    false`` and how many non-null values cannot be cast to the declared type.
    """
    meta, aggs = contract_aggs(df, contract)
    one = df.agg(*aggs)
    rows = F.array(*[F.struct(F.lit(n).alias("column_name"), F.lit(t).alias("declared_type"),
                              F.lit(a).cast("string").alias("actual_type"), F.lit(not p).alias("missing"),
                              F.lit(bool(p and a != t)).alias("type_mismatch"),
                              F.col(f"__n{i}").alias("null_violations"), F.col(f"__c{i}").alias("cast_failures"))
                     for i, (n, t, a, p) in enumerate(meta)])
    return one.select(F.inline(rows))
