"""Latest-per-key dedupe and distinct builds.

``row_number() ... = 1`` is written as a plain window filter: Spark's
optimizer turns it into a *partial* ``WindowGroupLimit`` that runs on every
map partition before the shuffle, so each partition sends at most one row per
key. A key holding a third of all rows therefore shuffles at most one row per
input partition, not a third of the table.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerline.functions.columns import hash_diff, parse_order

_RN = "__rn"


def row_hash(df: DataFrame, exclude: Sequence[str] = ()) -> Column:
    """Hash over every column (in schema order), the final tie-break."""
    return hash_diff([c for c in df.columns if c not in exclude])


def dedupe_latest(df: DataFrame, keys: Sequence[str], order_by: Sequence[str | Column] = (),
                  tie_break: bool = True) -> DataFrame:
    """Keep one row per key: the first under ``order_by``.

    ``order_by`` items are ``"col desc"``-style strings or Columns. A hash of
    the whole row, descending, is appended so the choice is deterministic
    even when the given order has ties (W2 when ``order_by`` is empty).
    """
    orders = [parse_order(o) for o in order_by]
    if tie_break or not orders:
        orders.append(row_hash(df).desc())
    w = Window.partitionBy(*keys).orderBy(*orders)
    return df.withColumn(_RN, F.row_number().over(w)).where(F.col(_RN) == 1).drop(_RN)


def dedupe_by_hash(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """No order given: keep the row with the highest whole-row hash."""
    return dedupe_latest(df, keys, ())


def distinct_rows(df: DataFrame) -> DataFrame:
    """Drop exact duplicate rows (A3); partial aggregation before the shuffle."""
    return df.dropDuplicates()


def distinct_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Distinct key tuples (A4)."""
    return df.select(*keys).distinct()


def distinct_dimension(df: DataFrame, exprs: dict[str, str], key: Sequence[str],
                       functional: bool = False) -> DataFrame:
    """Small dimension built from facts (A5): project, then one row per key.

    Rows with a null key are dropped. ``functional=True`` declares that every
    projected column is a function of the key (dim_date): then any row per key
    is the same row and ``dropDuplicates`` (a partial aggregate) suffices;
    otherwise the highest-hash row per key is kept.
    """
    proj = df.select(*[F.expr(e).alias(n) for n, e in exprs.items()])
    for k in key:
        proj = proj.where(F.col(k).isNotNull())
    if functional or set(proj.columns) == set(key):
        return proj.dropDuplicates(list(key))
    return dedupe_by_hash(proj, key)
