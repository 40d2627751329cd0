"""Change-data operators (C1-C4, C10, J3, J6, W4, U-1).

Change feeds carry an ``op`` column (I insert, C change, D delete) and a
sequence column. Only the keys of D rows are used.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerline.functions.columns import changed_columns, differs, hash_diff

_RN = "__rn"
_L, _R = "__prev", "__cur"

# Fixed op codes of the reference's delta files.
OP_INSERT, OP_CHANGE, OP_DELETE, OP_UNCHANGED = "I", "C", "D", "U"


def with_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows whose key columns are all set; ``quality.null_keys`` has the others."""
    for k in keys:
        df = df.where(F.col(k).isNotNull())
    return df


def snapshot_diff(prev: DataFrame, cur: DataFrame, keys: Sequence[str], cols: Sequence[str] | None = None,
                  include_unchanged: bool = False, unique: bool = False) -> DataFrame:
    """Infer I / C / D (and U) rows by comparing two full snapshots.

    One full outer join on the keys; a presence flag on each side tells
    "absent" apart from "all attributes null". Change = any compared column
    differs under null-safe equality; ``changed_cols`` lists them,
    comma-joined. Output carries the current values (previous values for D).
    Rows with a null key have no identity to compare: they are left out
    (``quality.null_keys`` gives them as rejects).
    """
    cols = list(cols) if cols is not None else [c for c in cur.columns if c not in keys]
    prev, cur = with_keys(prev, keys), with_keys(cur, keys)
    if not unique:
        # One row per key and side (highest whole-row hash), so a key with many
        # copies cannot multiply in the join; same partitioning as the join.
        from ledgerline.operators.dedupe import dedupe_by_hash
        prev = dedupe_by_hash(prev.select(*keys, *cols), keys)
        cur = dedupe_by_hash(cur.select(*keys, *cols), keys)
    p = prev.select(*keys, *cols).withColumn("__in", F.lit(True)).alias(_L)
    c = cur.select(*keys, *cols).withColumn("__in", F.lit(True)).alias(_R)
    j = p.join(c, [F.col(f"{_L}.{k}") == F.col(f"{_R}.{k}") for k in keys], "full_outer")
    in_p = F.col(f"{_L}.__in").isNotNull()
    in_c = F.col(f"{_R}.__in").isNotNull()
    changed = F.lit(False)
    for n in cols:
        changed = changed | differs(F.col(f"{_L}.{n}"), F.col(f"{_R}.{n}"))
    op = (F.when(~in_p, F.lit(OP_INSERT)).when(~in_c, F.lit(OP_DELETE))
          .when(changed, F.lit(OP_CHANGE)).otherwise(F.lit(OP_UNCHANGED)))
    out = j.select(
        *[F.coalesce(F.col(f"{_R}.{k}"), F.col(f"{_L}.{k}")).alias(k) for k in keys],
        op.alias("op"),
        F.when(in_p & in_c, changed_columns(cols, _L, _R)).otherwise(F.lit("")).alias("changed_cols"),
        *[F.when(in_c, F.col(f"{_R}.{n}")).otherwise(F.col(f"{_L}.{n}")).alias(n) for n in cols],
    )
    return out if include_unchanged else out.where(F.col("op") != OP_UNCHANGED)


def op_rank(op_col: str = "op", on_tie: str = "delete"):
    """Rank of an op when two ops share a sequence number on one key.

    ``delete``: D > C > I, the generation order (a key is changed, then
    deleted). ``upsert``: C > I > D, the order the reference's SQL applied them
    (delete first, then upsert, so the row survives).
    """
    o = F.col(op_col)
    if on_tie == "delete":
        return F.when(o == OP_DELETE, 3).when(o == OP_CHANGE, 2).when(o == OP_INSERT, 1).otherwise(0)
    if on_tie == "upsert":
        return F.when(o == OP_CHANGE, 3).when(o == OP_INSERT, 2).when(o == OP_DELETE, 1).otherwise(0)
    raise ValueError("on_tie must be 'delete' or 'upsert'")


def cdc_net_ops(delta: DataFrame, keys: Sequence[str], seq_col: str = "seq", op_col: str = "op",
                on_tie: str = "delete") -> DataFrame:
    """One net change per key (C2, W4, A4): highest sequence, then op rank,
    then a whole-row hash so the pick is deterministic. The filter on
    ``row_number() = 1`` becomes a partial per-partition limit before the
    shuffle, which bounds what a hot key sends."""
    w = Window.partitionBy(*keys).orderBy(F.col(seq_col).desc_nulls_last(), op_rank(op_col, on_tie).desc(),
                                          hash_diff(delta.columns).desc())
    return delta.withColumn(_RN, F.row_number().over(w)).where(F.col(_RN) == 1).drop(_RN)


def cdc_inserts(delta: DataFrame, op_col: str = "op") -> DataFrame:
    """Insert-only fact feed (C4): keep I rows, drop the op column."""
    return delta.where(F.col(op_col) == OP_INSERT).drop(op_col)


def cdc_upserts(delta: DataFrame, op_col: str = "op") -> DataFrame:
    """Inserts and changes as one upsert set (U-1): union by name, the
    missing columns of either side are null."""
    ins = delta.where(F.col(op_col) == OP_INSERT).withColumn("upsert_kind", F.lit("insert"))
    chg = delta.where(F.col(op_col) == OP_CHANGE).drop(op_col).withColumn("upsert_kind", F.lit("change"))
    return ins.unionByName(chg, allowMissingColumns=True)


def cdc_merge(target: DataFrame, delta: DataFrame, keys: Sequence[str], seq_col: str = "seq", op_col: str = "op",
              on_tie: str = "delete") -> DataFrame:
    """Apply a change feed to a keyed current-state table.

    Deletes and upserts apply together: net op per key, then
    ``target`` minus every touched key (anti join), plus the I/C rows.
    The anti join lets the planner broadcast a small delta at run time, so
    the large target is not shuffled at all; the price is that the (small)
    delta is evaluated for both branches. A full outer join would read the
    delta once but always shuffle the whole target. Changes with a null key are
    rejected (``quality.null_keys``): nothing could ever replace such a row.
    """
    net = cdc_net_ops(with_keys(delta, keys), keys, seq_col, op_col, on_tie)
    untouched = target.join(net.select(*keys), list(keys), "left_anti")
    upserts = net.where(F.col(op_col) != OP_DELETE).select(*target.columns)
    return untouched.unionByName(upserts)


def delete_by_key(target: DataFrame, doomed: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Remove the rows whose key is in ``doomed`` (J6, C10 delete)."""
    return target.join(doomed.select(*keys), list(keys), "left_anti")


def keep_keys(target: DataFrame, wanted: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows whose key is in ``wanted`` (J6 semi join)."""
    return target.join(wanted.select(*keys), list(keys), "left_semi")


def update_attribute(target: DataFrame, updates: DataFrame, keys: Sequence[str],
                     set_cols: Mapping[str, str]) -> DataFrame:
    """Set attributes on matching keys (C10 ``set``): ``set_cols`` maps target
    column -> column of ``updates``. Keys without an update keep their values; of
    several updates of a key the one with the highest row hash counts, so the
    target's rows never multiply."""
    from ledgerline.operators.dedupe import dedupe_by_hash

    updates = dedupe_by_hash(updates.select(*keys, *dict.fromkeys(s for s in set_cols.values() if s not in keys)), keys)
    u = updates.select(*keys, *[F.col(src).alias(f"__new_{dst}") for dst, src in set_cols.items()],
                       F.lit(True).alias("__hit"))
    j = target.join(u, list(keys), "left")
    return j.select(*[
        (F.when(F.col("__hit"), F.col(f"__new_{c}")).otherwise(F.col(c)).alias(c) if c in set_cols else F.col(c))
        for c in target.columns
    ])
