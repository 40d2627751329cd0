"""Scans (S1-S3, S6, S8).

Paths are explicit arguments; readers only build lazy plans so column
pruning and filter pushdown reach the files. Text sources are read with a
declared schema (no inference pass over the data).
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

_BOM = "\ufeff"


def snapshot_path(base: str, table: str, run_dt: str, layout: str = "dt_first") -> str:
    """Daily snapshot / delta folder: ``base/dt=<run_dt>/<table>`` or ``base/<table>/dt=<run_dt>``."""
    if layout == "dt_first":
        return f"{base}/dt={run_dt}/{table}"
    return f"{base}/{table}/dt={run_dt}"


def read_table(spark: SparkSession, path: str, fmt: str = "parquet", schema: StructType | str | None = None,
               options: Mapping[str, object] | None = None) -> DataFrame:
    """One scan of csv / json / parquet / orc / text by format name."""
    r = spark.read.format(fmt)
    opts = dict(options or {})
    if fmt == "csv":
        opts.setdefault("header", True)
    for k, v in opts.items():
        r = r.option(k, str(v).lower() if isinstance(v, bool) else v)
    if schema is not None:
        r = r.schema(schema)
    return _strip_bom(r.load(path))


def read_snapshot(spark: SparkSession, base: str, table: str, run_dt: str, fmt: str = "parquet",
                  schema=None, options=None, layout: str = "dt_first") -> DataFrame:
    """A full daily dump of ``table``."""
    return read_table(spark, snapshot_path(base, table, run_dt, layout), fmt, schema, options)


def read_delta(spark: SparkSession, base: str, table: str, run_dt: str, fmt: str = "parquet",
               schema=None, options=None, layout: str = "dt_first") -> DataFrame:
    """A daily change file of ``table`` with ``op`` and ``event_dt``."""
    return read_table(spark, snapshot_path(base, table, run_dt, layout), fmt, schema, options)


def read_spec_sources(spark: SparkSession, spec: Mapping, base: str = "") -> dict[str, DataFrame]:
    """Every source of a batch spec, keyed by name (S3)."""
    out = {}
    for name, s in spec["sources"].items():
        path = s["path"] if not base else f"{base}/{s['path']}"
        out[name] = read_table(spark, path, s.get("format", "parquet"), s.get("schema"), s.get("options"))
    return out


def _strip_bom(df: DataFrame) -> DataFrame:
    """A UTF-8 byte-order mark glued to the first header name is removed."""
    first = df.columns[0] if df.columns else ""
    if first.startswith(_BOM):
        return df.withColumnRenamed(first, first[len(_BOM):])
    return df


def read_lookup_csv(spark: SparkSession, path: str, columns: tuple[str, str]) -> DataFrame:
    """Two-column reference file, e.g. a category translation."""
    schema = f"`{columns[0]}` string, `{columns[1]}` string"
    df = spark.read.option("header", True).option("encoding", "UTF-8").schema(schema).csv(path)
    return df.where(F.col(columns[0]).isNotNull())


# Gateway log line layout (S6): "<ts> service=<s> request_id=<r> user_id=<u> latency_ms=<n> status=<n> [error_code=<e>]"
LOG_FIELDS = {
    "service": r"service=(\S+)",
    "request_id": r"request_id=(\S+)",
    "user_id": r"user_id=(\S+)",
    "latency_ms": r"latency_ms=(\S+)",
    "status": r"status=(\S+)",
    "error_code": r"error_code=(\S+)",
}
LOG_TS = r"^(\d{4}-\d{2}-\d{2} \d{2}:\d{2}:\d{2})"


def parse_log_lines(lines: DataFrame, line_col: str = "line") -> DataFrame:
    """Typed fields from gateway log lines (S6); a field that is missing or
    not a number is null, so garbage lines survive with nulls."""
    def field(pat):
        return F.nullif(F.regexp_extract(F.col(line_col), pat, 1), F.lit(""))

    cols = {n: field(p) for n, p in LOG_FIELDS.items()}
    cols["latency_ms"] = cols["latency_ms"].try_cast("bigint")
    cols["status"] = cols["status"].try_cast("bigint")
    cols["log_ts"] = F.try_to_timestamp(field(LOG_TS), F.lit("yyyy-MM-dd HH:mm:ss"))
    keep = [c for c in lines.columns if c != line_col]
    return lines.select(*keep, *[v.alias(k) for k, v in cols.items()])


def read_log_lines(spark: SparkSession, path: str) -> DataFrame:
    """``*.log`` text files -> parsed fields."""
    return parse_log_lines(spark.read.text(path).withColumnRenamed("value", "line"))
