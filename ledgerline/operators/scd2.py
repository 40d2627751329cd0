"""Versioned (type-2) dimensions: first load, merge, expire, soft delete,
re-run and rebuild from many snapshots (C5-C9, W5, K4).

A history row is ``<keys> <attributes> hash_diff effective_from effective_to
is_current`` with half-open validity ``[effective_from, effective_to)``; the
open version ends at ``OPEN_END``. ``scd2_apply`` always returns the whole
history, with exactly one open row per live key.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerline.functions.columns import OPEN_END, any_differs, hash_diff

HIST_COLS = ("hash_diff", "effective_from", "effective_to", "is_current")
_D, _S = "__d", "__s"


def _ts(value: str):
    return F.to_timestamp(F.lit(value))


def _valid_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    for k in keys:
        df = df.where(F.col(k).isNotNull())
    return df


def scd2_initial(today: DataFrame, keys: Sequence[str], tracked: Sequence[str], run_ts: str,
                 open_to: str = OPEN_END) -> DataFrame:
    """First load (C5): every row opens a version at ``run_ts``.
    Rows with a null business key are not loaded (see ``quality.null_keys``)."""
    return _valid_keys(today, keys).withColumns({
        "hash_diff": hash_diff(tracked),
        "effective_from": _ts(run_ts),
        "effective_to": _ts(open_to),
        "is_current": F.lit(True),
    })


def rewind(hist: DataFrame, run_ts: str, open_to: str = OPEN_END) -> DataFrame:
    """State of the history just before ``run_ts``.

    Versions opened at or after ``run_ts`` are removed, versions closed at or
    after it are reopened. Applying the same day again after a rewind gives the
    same table as applying it once. A back-dated run must be followed by a
    replay of the later days.
    """
    t = _ts(run_ts)
    kept = hist.where(F.col("effective_from") < t)
    reopen = F.col("effective_to") >= t
    return kept.withColumns({
        "effective_to": F.when(reopen, _ts(open_to)).otherwise(F.col("effective_to")),
        "is_current": F.when(reopen, F.lit(True)).otherwise(F.col("is_current")),
    })


def scd2_apply(hist: DataFrame, today: DataFrame, keys: Sequence[str], tracked: Sequence[str], run_ts: str,
               on_missing: str = "keep", open_to: str = OPEN_END, rewind_first: bool = False,
               unique_today: bool = False) -> DataFrame:
    """Merge one day's deduplicated snapshot into a full history.

    Only the open versions meet today's rows, in **one** full outer join on
    the business keys; each joined row emits its output versions through
    ``inline(array(...))`` so the join is not repeated per output kind:

    * only today                 -> new open version
    * both, a tracked column differs (null-safe) -> old closed at ``run_ts`` + new open
    * both, equal                -> old version unchanged
    * only history               -> unchanged (``on_missing="keep"``) or closed (``"close"``)

    Closed versions pass through untouched (no join).

    ``today`` must hold one row per key; unless ``unique_today`` says so, a
    keyed dedupe (highest whole-row hash) guarantees it. That dedupe is
    partitioned by the same keys as the join, so it adds no shuffle, and its
    partial per-partition limit keeps a key with many copies from landing
    whole in one task.
    """
    if on_missing not in ("keep", "close"):
        raise ValueError("on_missing must be 'keep' or 'close'")
    if rewind_first:
        hist = rewind(hist, run_ts, open_to)
    attrs = [c for c in today.columns if c not in keys and c not in HIST_COLS]
    out_cols = list(keys) + attrs + list(HIST_COLS)
    closed = hist.where(~F.col("is_current")).select(*out_cols)
    cur = hist.where(F.col("is_current")).select(*out_cols).withColumn("__in", F.lit(True)).alias(_D)
    today = _valid_keys(today, keys).select(*keys, *attrs)
    if not unique_today:
        from ledgerline.operators.dedupe import dedupe_by_hash
        today = dedupe_by_hash(today, keys)
    src = (today.withColumn("hash_diff", hash_diff(tracked))
           .withColumn("__in", F.lit(True)).alias(_S))

    j = cur.join(src, [F.col(f"{_D}.{k}") == F.col(f"{_S}.{k}") for k in keys], "full_outer")
    in_d = F.col(f"{_D}.__in").isNotNull()
    in_s = F.col(f"{_S}.__in").isNotNull()
    changed = any_differs((F.col(f"{_D}.{c}"), F.col(f"{_S}.{c}")) for c in tracked)
    run = _ts(run_ts)

    def version(side: str, frm, to, current):
        fields = [F.col(f"{side}.{c}").alias(c) for c in list(keys) + attrs + ["hash_diff"]]
        return F.struct(*fields, frm.alias("effective_from"), to.alias("effective_to"), current.alias("is_current"))

    old_kept = version(_D, F.col(f"{_D}.effective_from"), F.col(f"{_D}.effective_to"), F.col(f"{_D}.is_current"))
    old_closed = version(_D, F.col(f"{_D}.effective_from"), run, F.lit(False))
    new_open = version(_S, run, _ts(open_to), F.lit(True))

    close_missing = F.lit(on_missing == "close")
    rows = F.array(
        F.when(in_s & (~in_d | changed), new_open),
        F.when(in_d & in_s & changed, old_closed),
        F.when(in_d & in_s & ~changed, old_kept),
        F.when(in_d & ~in_s & ~close_missing, old_kept),
        F.when(in_d & ~in_s & close_missing, old_closed),
    )
    merged = j.select(F.inline(F.array_compact(rows)))
    return closed.unionByName(merged)


def check_run_order(hist: DataFrame, run_ts: str) -> bool:
    """Refuse a run older than the newest change already in the history; True if
    the history already holds changes of this very run time (it must be rewound).

    Applying an earlier day on top of later ones would close versions out of
    order; such a run needs ``rewind_first=True`` (and a replay of the later
    days). One scalar aggregate over the history.
    """
    # closings count as well: a day that only closed versions is a day, too
    closed_at = F.when(~F.col("is_current"), F.col("effective_to"))
    newest = hist.agg(F.greatest(F.max("effective_from"), F.max(closed_at)).alias("m")).first()["m"]
    run = hist.sparkSession.range(1).select(_ts(run_ts).alias("t")).first()["t"]
    if newest is not None and run < newest:
        raise ValueError(f"run {run_ts} is older than the newest version ({newest}); rewind and replay instead")
    return newest is not None and run == newest


def scd2_expired(hist: DataFrame) -> DataFrame:
    """Closed versions."""
    return hist.where(~F.col("is_current"))


def soft_delete_keys(seen: DataFrame, keys: Sequence[str], dt_col: str, run_dt: str, after_days: int) -> DataFrame:
    """Keys not seen in a snapshot for ``after_days`` days or more at ``run_dt``.

    ``seen`` is the union of daily snapshots with their ``dt_col``; the last
    sighting per key is one partial aggregate. Feed the result to
    ``close_keys`` to end their open versions.
    """
    last = seen.groupBy(*keys).agg(F.max(F.col(dt_col)).alias("last_seen_dt"))
    missing = F.datediff(F.to_date(F.lit(run_dt)), F.col("last_seen_dt"))
    return last.withColumn("days_missing", missing.cast("bigint")).where(F.col("days_missing") >= after_days)


def close_keys(hist: DataFrame, doomed: DataFrame, keys: Sequence[str], run_ts: str) -> DataFrame:
    """End the open versions of ``doomed`` keys at ``run_ts`` (soft delete)."""
    flag = doomed.select(*keys).distinct().withColumn("__doomed", F.lit(True))
    # only open versions meet the keys; closed ones pass by
    j = hist.where(F.col("is_current")).join(flag, list(keys), "left")
    hit = F.col("__doomed").isNotNull()
    ended = j.withColumns({
        "effective_to": F.when(hit, _ts(run_ts)).otherwise(F.col("effective_to")),
        "is_current": ~hit,
    }).select(*hist.columns)
    return hist.where(~F.col("is_current")).unionByName(ended)


def last_seen(previous: DataFrame | None, today: DataFrame, keys: Sequence[str], dt_col: str, run_dt: str) -> DataFrame:
    """Last sighting per key (``keys``, ``dt_col``), carried from day to day: soft
    deletes then read this and today's snapshot, not every past one."""
    now = _valid_keys(today, keys).select(*keys).withColumn(dt_col, F.to_date(F.lit(run_dt)))
    both = now if previous is None else previous.select(*keys, dt_col).unionByName(now)
    return both.groupBy(*keys).agg(F.max(dt_col).alias(dt_col))


def scd2_from_snapshots(snaps: DataFrame, keys: Sequence[str], tracked: Sequence[str], dt_col: str,
                        open_to: str = OPEN_END, on_missing: str = "keep", days: Sequence[str] = ()) -> DataFrame:
    """Build a history from many daily snapshots at once (W5, backfill).

    ``snaps`` holds one row per key and day. A row opens a version when its
    tracked values differ (null-safe) from the key's previous sighting;
    ``effective_to`` is the next version's start. With ``on_missing="keep"`` keys
    are never closed by absence; with ``"close"`` a version ends on the first of
    ``days`` (all snapshot days, in order) without the key and a returning key
    opens a new one. Either way the result equals ``scd2_apply`` day by day.
    All windows share one partitioning by key, so this costs one shuffle.
    """
    if on_missing not in ("keep", "close"):
        raise ValueError("on_missing must be 'keep' or 'close'")
    if on_missing == "close" and not days:
        raise ValueError("on_missing='close' needs the snapshot days")
    snaps = _valid_keys(snaps, keys)
    from ledgerline.operators.dedupe import dedupe_by_hash

    # one row per key and day even if a snapshot repeats a key (partial limit
    # before the shuffle; the windows below reuse the partitioning by key)
    snaps = dedupe_by_hash(snaps, [*keys, dt_col])
    w = Window.partitionBy(*keys).orderBy(F.col(dt_col))
    attrs = [c for c in snaps.columns if c not in keys and c != dt_col]
    prev_differs = F.lit(False)
    for c in tracked:
        prev_differs = prev_differs | ~F.col(c).eqNullSafe(F.lag(F.col(c)).over(w))
    first = F.lag(F.lit(1)).over(w).isNull()
    if on_missing == "close":
        # the day after a sighting; a key absent there is closed then
        nxt_day = F.element_at(F.create_map(*[x for a, b in zip(days, days[1:]) for x in (F.lit(a), F.lit(b))]) if len(days) > 1
                               else F.create_map(F.lit(""), F.lit("")), F.date_format(F.col(dt_col), "yyyy-MM-dd"))
        due = F.to_date(nxt_day)
        gone = due.isNotNull() & ~F.lead(F.to_date(F.col(dt_col))).over(w).eqNullSafe(due)
        snaps = snaps.withColumn("__gone", F.when(gone, due.cast("timestamp")))
        back = F.lag(F.col("__gone")).over(w).isNotNull()
    else:
        snaps = snaps.withColumn("__gone", F.lit(None).cast("timestamp"))
        back = F.lit(False)
    marked = snaps.withColumn("__start", first | prev_differs | back)
    # the absence that ends a version stands on its last sighting
    run = F.sum(F.col("__start").cast("int")).over(w.rowsBetween(Window.unboundedPreceding, 0))
    marked = marked.withColumn("__run", run)
    per_run = Window.partitionBy(*keys, "__run")
    marked = marked.withColumn("__closed", F.max("__gone").over(per_run)) if on_missing == "close" else marked.withColumn("__closed", F.col("__gone"))
    starts = marked.where(F.col("__start")).withColumn("effective_from", F.to_timestamp(F.col(dt_col).cast("timestamp")))
    w2 = Window.partitionBy(*keys).orderBy(F.col("effective_from"))
    nxt = F.coalesce(F.col("__closed"), F.lead(F.col("effective_from")).over(w2))
    return starts.select(
        *keys, *attrs,
        hash_diff(tracked).alias("hash_diff"),
        F.col("effective_from"),
        F.coalesce(nxt, _ts(open_to)).alias("effective_to"),
        nxt.isNull().alias("is_current"),
    )
