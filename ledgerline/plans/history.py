"""The daily SCD2 job with copy-on-write history and soft delete.

The history lies in key buckets; a version names the folder of each bucket. Its
manifest also holds a digest per bucket of the day's deduplicated snapshot (keys and
tracked columns, whatever the row order). The next day only buckets whose digest
differs can hold a new, changed or missing key; the others are neither read nor
written, so a day costs one aggregate over the snapshot and a merge of what changed.

Soft delete: keys of open versions that the snapshot no longer has are kept with
the day they were last seen in a small table beside the buckets, in the same commit.
A key missing for ``close_after_days`` days is closed, also in a bucket whose digest
did not change; one that comes back is no longer missing.

A run builds on the newest version of an *earlier* run time, so a retry, and a
second run of a day under another id or with another snapshot, replaces that day. A
run older than the newest one is refused.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.functions.columns import OPEN_END
from ledgerline.operators.dedupe import dedupe_by_hash, dedupe_latest
from ledgerline.operators.quality import null_keys
from ledgerline.operators.scd2 import close_keys, scd2_apply, scd2_initial
from ledgerline.operators.shape import select_expr
from ledgerline.sources import sinks

MISSING, LAST_SEEN = "missing", "last_seen_dt"


def bucket_digests(rows: DataFrame, keys, columns, buckets: int) -> dict[int, str]:
    """Per key bucket, a text that stands for its rows in any order: their number and
    two independent 64-bit hashes per row, added up and exclusive-or-ed. One partial
    aggregate; at most ``buckets`` rows come back."""
    cols = [*keys, *columns]
    parts = [p for c in cols for p in (F.col(c), F.col(c).isNull())]  # a null is not an absent column
    one, two = F.xxhash64(*parts), F.xxhash64(F.lit("second"), *parts)
    got = rows.groupBy(sinks.key_bucket(keys, buckets).alias("b")).agg(
        F.count(F.lit(1)).alias("n"), F.sum(one.cast("decimal(38,0)")).alias("s"), F.bit_xor(two).alias("x")).collect()
    return {r["b"]: f"{r['n']}/{r['s']}/{r['x']}" for r in got}


def _today(snapshot: DataFrame, cfg: Mapping) -> DataFrame:
    keys, dd = cfg["business_key"], cfg.get("dedupe") or {}
    rows = dedupe_latest(snapshot, dd["key"], dd.get("order_by", [])) if dd else snapshot
    rows = select_expr(rows, cfg["select_expr"])
    for k in keys:
        rows = rows.where(F.col(k).isNotNull())
    same_key = bool(dd) and list(dd["key"]) == list(keys) and all(cfg["select_expr"].get(k) == k for k in keys)
    return rows if same_key else dedupe_by_hash(rows, keys)


def _base(spark: SparkSession, table_path: str, run_ts: str) -> tuple[str | None, dict]:
    """(folder, facts) of the newest version of an earlier run time."""
    sinks.pointer(spark, table_path)  # versions without a pointer raise
    newest = None
    for folder in sinks.folders(spark, table_path):
        facts = sinks.manifest(spark, table_path, folder)["facts"]
        newest = newest or facts["run_ts"]
        if run_ts < newest:
            raise ValueError(f"run {run_ts} is older than the newest one ({newest}); rewind and replay instead")
        if facts["run_ts"] < run_ts:
            return folder, facts
    return None, {}


def scd2_daily_buckets(spark: SparkSession, table_path: str, snapshot: DataFrame, cfg: Mapping, run_ts: str, run_id: str,
                       buckets: int = 64, on_missing: str = "keep", close_after_days: int | None = None, keep: int = 2) -> list[int]:
    """One day of a dimension (see the module); gives the buckets that were rewritten.
    ``keep`` (at least 2) days stay readable."""
    if keep < 2:
        raise ValueError("a day that is run again needs the one before it")
    if close_after_days is not None and on_missing != "keep":
        raise ValueError("close_after_days needs on_missing='keep'")
    keys, tracked = cfg["business_key"], cfg["scd2_columns"]
    open_to = cfg.get("effective_to_open", OPEN_END)
    folder, facts = _base(spark, table_path, run_ts)
    shape = [list(keys), list(tracked), sorted(cfg["select_expr"].items()), buckets]
    today = _today(snapshot, cfg).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        digests = bucket_digests(today, keys, tracked, buckets)
        now = {"run_ts": run_ts, "digests": {str(b): d for b, d in digests.items()}, "shape": repr(shape)}
        bucket = sinks.key_bucket(keys, buckets)
        side = None
        if folder is None:
            touched = sorted(digests)
            if close_after_days is not None:
                side = {MISSING: today.select(*keys).limit(0).withColumn(LAST_SEEN, F.lit(None).cast("date"))}
            new, untouched = scd2_initial(today, keys, tracked, run_ts, open_to), {}
        else:
            doc = sinks.manifest(spark, table_path, folder)
            if doc["facts"]["shape"] != repr(shape):
                raise ValueError(f"{table_path}: the history was written with other keys, columns or buckets; rebuild it")
            places = {int(b): f for b, f in doc["buckets"].items()}
            before = {int(b): d for b, d in facts["digests"].items()}
            touched = sorted(b for b in {*before, *digests} if before.get(b) != digests.get(b))
            due = None
            if close_after_days is not None:
                missing, due = _missing(spark, table_path, folder, facts, today, keys, bucket, touched, run_ts, close_after_days)
                side = {MISSING: missing}
                touched = sorted({*touched, *(r[0] for r in due.select(bucket).distinct().collect())})  # bucket numbers
            hist = sinks.read_buckets(spark, table_path, folder, touched)
            day = today.where(bucket.isin(touched)) if touched else today.limit(0)
            new = scd2_apply(hist, day, keys, tracked, run_ts, on_missing=on_missing, open_to=open_to, unique_today=True)
            if due is not None:
                new = close_keys(new, due, keys, run_ts)
            untouched = {b: f for b, f in places.items() if b not in touched}
        sinks.publish_buckets(new, table_path, run_id, keys, buckets, untouched, now, side)
    finally:
        today.unpersist()
    # attempts at this day count once: a further one builds on the day before
    same_day = sum(sinks.manifest(spark, table_path, f)["facts"]["run_ts"] == run_ts for f in sinks.folders(spark, table_path))
    sinks.drop_old_versions(spark, table_path, keep - 1 + same_day)
    return touched


def _missing(spark, table_path, folder, facts, today, keys, bucket, touched, run_ts, after_days):
    """(keys still missing, keys to be closed today) with their last sighting."""
    known = spark.read.schema(_missing_schema(today, keys)).parquet(f"{table_path}/{folder}/_{MISSING}")
    # untouched buckets have the keys they had: what was missing there is missing still
    rest = known.where(~bucket.isin(touched)) if touched else known
    if touched:
        open_keys = sinks.read_buckets(spark, table_path, folder, touched).where("is_current").select(*keys)
        gone = open_keys.join(today.select(*keys), keys, "left_anti").join(known, keys, "left")
        gone = gone.withColumn(LAST_SEEN, F.coalesce(LAST_SEEN, F.to_date(F.lit(facts["run_ts"]))))
        rest = rest.unionByName(gone.select(*keys, LAST_SEEN))
    late = F.datediff(F.to_date(F.lit(run_ts)), F.col(LAST_SEEN)) >= after_days
    return rest.where(~late), rest.where(late)


def _missing_schema(today: DataFrame, keys) -> str:
    types = {f.name: f.dataType.simpleString() for f in today.schema.fields}
    return ", ".join(f"`{k}` {types[k]}" for k in keys) + f", {LAST_SEEN} date"


def read_history(spark: SparkSession, table_path: str) -> DataFrame | None:
    return sinks.read_current(spark, table_path)


def rejected(snapshot: DataFrame, cfg: Mapping) -> DataFrame:
    """Rows of a snapshot that no history takes: a null business key."""
    return null_keys(select_expr(snapshot, cfg["select_expr"]), cfg["business_key"])


# ---------------------------------------------------------------- snapshots with digests

def publish_snapshot(spark: SparkSession, table_path: str, rows: DataFrame, keys, version: str, buckets: int = 64,
                     cols=None, keep: int = 2) -> tuple[DataFrame | None, list[int]]:
    """Stores a snapshot (one row per key) in key buckets, with a digest of each, and gives
    the changes against the stored one before (None for the first) and the buckets in
    which something differs. Only those are written, and only those of both
    snapshots are joined by ``snapshot_diff``."""
    from ledgerline.operators.change import snapshot_diff

    cols = [c for c in rows.columns if c not in keys] if cols is None else list(cols)
    rows = rows.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        digests = bucket_digests(rows, keys, [c for c in rows.columns if c not in keys], buckets)
        facts = {"digests": {str(b): d for b, d in digests.items()}, "shape": repr([list(keys), rows.columns, buckets])}
        folder = sinks.base_folder(spark, table_path, version)
        if folder is None:
            written = sinks.publish_buckets(rows, table_path, version, keys, buckets, facts=facts)
            return None, sorted(digests)
        doc = sinks.manifest(spark, table_path, folder)
        if doc["facts"]["shape"] != facts["shape"]:
            raise ValueError(f"{table_path}: the stored snapshot has other keys, columns or buckets")
        before = {int(b): d for b, d in doc["facts"]["digests"].items()}
        touched = sorted(b for b in {*before, *digests} if before.get(b) != digests.get(b))
        bucket = sinks.key_bucket(keys, buckets)
        day = rows.where(bucket.isin(touched)) if touched else rows.limit(0)
        untouched = {int(b): f for b, f in doc["buckets"].items() if int(b) not in touched}
        written = sinks.publish_buckets(day, table_path, version, keys, buckets, untouched, facts)
    finally:
        rows.unpersist()
    old = sinks.read_buckets(spark, table_path, folder, touched)
    new = sinks.read_buckets(spark, table_path, written.rpartition("/")[2], touched)
    sinks.drop_old_versions(spark, table_path, max(keep, 2))  # the one before is what the changes are read from
    return snapshot_diff(old, new, keys, cols), touched
