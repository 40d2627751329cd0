"""Grouped aggregates and derived measures.

Every aggregate here is a plain ``groupBy().agg()`` of built-in functions, so
Spark runs a partial (map-side) aggregate before the shuffle: a key that
holds a third of all rows still shuffles one partial row per map task.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def grouped_agg(df: DataFrame, group_by: Sequence[str], aggs: Mapping[str, str | Column],
                derive: Mapping[str, str | Column] | None = None) -> DataFrame:
    """``group_by`` + named aggregate expressions, then post-aggregate derives (A1, A2)."""
    cols = [(a if isinstance(a, Column) else F.expr(a)).alias(n) for n, a in aggs.items()]
    out = df.groupBy(*group_by).agg(*cols)
    if derive:
        out = out.withColumns({n: (e if isinstance(e, Column) else F.expr(e)) for n, e in derive.items()})
    return out


def latest_of(*cols: str | Column) -> Column:
    """Row-wise maximum that skips nulls."""
    return F.greatest(*[F.col(c) if isinstance(c, str) else c for c in cols])


def map_values(c: str | Column, mapping: Mapping[str, str], default: str | None = None) -> Column:
    """Conditional value map ``when(c == k, v)...otherwise(default)`` (F8)."""
    src = F.col(c) if isinstance(c, str) else c
    out = None
    for k, v in mapping.items():
        out = F.when(src == k, F.lit(v)) if out is None else out.when(src == k, F.lit(v))
    return out.otherwise(F.lit(default)) if out is not None else F.lit(default)


def clip(c: Column, lo: float, hi: float) -> Column:
    """Clamp into ``[lo, hi]`` (F9); null stays null."""
    return F.when(c.isNull(), c).otherwise(F.least(F.greatest(c, F.lit(lo)), F.lit(hi)))


def days_between(start: str | Column, end: str | Column) -> Column:
    """Fractional days from ``start`` to ``end``."""
    s = F.col(start) if isinstance(start, str) else start
    e = F.col(end) if isinstance(end, str) else end
    return F.timestamp_diff("SECOND", s, e) / F.lit(86400)


def stock_after_sales(stock: DataFrame, sales: DataFrame, keys: Sequence[str], qty_col: str, sold_col: str) -> DataFrame:
    """Stock movement for one day.

    Sales are summed per key (partial aggregate), joined to the stock, and
    subtracted without going below zero; ``short_qty`` is what could not be
    served. Sales of a position that is not in stock are kept: all of their
    quantity is short and ``in_stock`` is false.
    """
    sold = sales.groupBy(*keys).agg(F.sum(sold_col).cast("bigint").alias("sold_qty"))
    zero = F.lit(0).cast("bigint")
    j = stock.withColumn("in_stock", F.lit(True)).join(sold, list(keys), "full_outer")
    have, want = F.coalesce(F.col(qty_col).cast("bigint"), zero), F.coalesce("sold_qty", zero)
    return j.withColumns({qty_col: F.greatest(have - want, zero), "sold_qty": want, "short_qty": F.greatest(want - have, zero),
                          "in_stock": F.coalesce("in_stock", F.lit(False))})
