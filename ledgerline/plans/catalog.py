"""Registry of the named queries and their DuckDB oracle texts.

Every query is ``(spark, sf_dir) -> DataFrame`` over the driver tables (or
fixture views Spark derives from them) and runs the library operators; the
oracle is an independent SQL formulation of the same result. Output columns
are aliased identically on both sides; money and ratios leave as DOUBLE,
counts as BIGINT, dates as ``yyyy-MM-dd`` text, times as TIMESTAMP_NTZ.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QueryFn = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, QueryFn] = {}
ORACLES: dict[str, str] = {}


def wall_clock(df: DataFrame) -> DataFrame:
    """Session-zone timestamps leave as TIMESTAMP_NTZ (the same wall clock),
    the type the oracle's TIMESTAMP has."""
    from pyspark.sql import functions as F
    from pyspark.sql.types import TimestampType

    ltz = {f.name for f in df.schema.fields if isinstance(f.dataType, TimestampType)}
    if not ltz:
        return df
    return df.select(*[F.col(c).cast("timestamp_ntz").alias(c) if c in ltz else F.col(c) for c in df.columns])


def query(name: str, oracle: str | None = None):
    def deco(fn: QueryFn) -> QueryFn:
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")

        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return wall_clock(fn(spark, sf_dir))

        run.__name__, run.__doc__ = fn.__name__, fn.__doc__
        QUERIES[name] = run
        if oracle is not None:
            ORACLES[name] = oracle
        return fn
    return deco


def load_all() -> None:
    # Importing the modules registers their queries.
    from ledgerline.plans import q_batch, q_change, q_quality, q_star, q_stream  # noqa: F401
