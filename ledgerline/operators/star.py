"""Star-schema joins: point-in-time fact -> SCD2 lookup, unknown member,
late-arriving dimension backfill (J4, J7, F10).

The fact side is the big one. Every join here is an equi-join on the
business key plus a validity-range predicate, so Spark can run a sort-merge
(or, when adaptive execution measures the dimension as small, a broadcast
hash) join; a hot key on the fact side is split by adaptive skew handling
instead of landing whole in one task. Nothing is broadcast by hint, because
a dimension's size is data-dependent.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerline.functions.columns import surrogate_key

# Fixed key of the unknown member row that facts point to when no version matches.
UNKNOWN_MEMBER = "-1"


def with_surrogate_key(hist: DataFrame, keys: Sequence[str], sk_col: str) -> DataFrame:
    """Adds a version key stable across re-runs."""
    return hist.withColumn(sk_col, surrogate_key(keys, "effective_from"))


def point_in_time_join(facts: DataFrame, hist: DataFrame, keys: Sequence[str], ts_col: str, sk_col: str,
                       attrs: Sequence[str] = (), unknown: str = UNKNOWN_MEMBER, salts: int = 1,
                       _sk_keys: Sequence[str] | None = None) -> DataFrame:
    """Each fact row picks the dimension version valid at its event time (J4):
    ``effective_from <= ts < effective_to``; no match -> the unknown member (J7).

    A hot key of unbucketed facts is split by adaptive skew handling. Facts
    bucketed by the key join without a shuffle, so nothing can be split at run
    time: with ``salts`` > 1 each key's facts are dealt over that many parts, and the
    versions are repeated once a part, at the price of the shuffle."""
    if salts > 1:
        dealt = facts.withColumn("__salt", F.pmod(F.xxhash64(*facts.columns), F.lit(salts)))
        parts = hist.withColumn("__salt", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(salts - 1).cast("long"))))
        return point_in_time_join(dealt, parts, [*keys, "__salt"], ts_col, sk_col, attrs, unknown, _sk_keys=keys).drop("__salt")
    h = with_surrogate_key(hist, _sk_keys or keys, sk_col).select(
        *[F.col(k).alias(f"__k_{k}") for k in keys], sk_col, "effective_from", "effective_to", *attrs)
    ts = F.col(ts_col).cast("timestamp")
    cond = [F.col(k) == F.col(f"__k_{k}") for k in keys]
    cond += [ts >= F.col("effective_from"), ts < F.col("effective_to")]
    j = facts.join(h, cond, "left")
    return j.select(*facts.columns, F.coalesce(F.col(sk_col), F.lit(unknown)).alias(sk_col), *attrs)


def backfill_unknown(fact: DataFrame, hist: DataFrame, keys: Sequence[str], ts_col: str, sk_col: str,
                     attrs: Sequence[str] = (), unknown: str = UNKNOWN_MEMBER) -> DataFrame:
    """Late-arriving dimension (J7): re-resolve only the rows that point to
    the unknown member, against a newer history.

    A row resolves to the version valid at its time; a row older than the
    key's first version takes that first version (the dimension row arrived
    late). Rows already resolved are left as they are. A row whose surrogate key
    is null counts as unresolved; one whose business key is null stays unknown.
    """
    open_ = F.coalesce(F.col(sk_col) == unknown, F.lit(True))  # a null key is unresolved, too
    first_from = F.min("effective_from").over(Window.partitionBy(*keys))
    h = (with_surrogate_key(hist, keys, sk_col)
         .withColumn("__first", F.col("effective_from") == first_from)
         .select(*[F.col(k).alias(f"__k_{k}") for k in keys], F.col(sk_col).alias("__sk"), "effective_from", "effective_to", "__first",
                 *[F.col(a).alias(f"__a_{a}") for a in attrs]))
    ts = F.col(ts_col).cast("timestamp")
    in_range = (ts >= F.col("effective_from")) & (ts < F.col("effective_to"))
    before_first = F.col("__first") & (ts < F.col("effective_from"))
    # one left join of all facts: resolved rows match nothing and pass as they are
    j = fact.join(h, [open_] + [F.col(k) == F.col(f"__k_{k}") for k in keys] + [in_range | before_first], "left")
    new = {sk_col: F.when(open_, F.coalesce(F.col("__sk"), F.lit(unknown))).otherwise(F.col(sk_col)),
           **{a: F.when(open_, F.col(f"__a_{a}")).otherwise(F.col(a)) for a in attrs}}
    return j.select(*[new[c].alias(c) if c in new else F.col(c) for c in fact.columns])
