"""Spec documents run as a stream (B4/B5, streaming mode).

``mode: stream`` compiles a spec into one Structured Streaming query:

    source -> watermark -> dedupe -> transforms -> declared columns -> contract -> target / dead letters

The same functions build the batch form of the spec (``stream_spec_batch``), so
one document runs either way with equal tables: a batch has the rows that a
stream has once its watermark is final. In a batch, windows that the watermark
would not have closed are left out, and dedupe keeps one row per key.

Rows that break the contract (a value that its declared type cannot hold, a null
in a column that is not nullable) go to the dead-letter table with the reason and the
row as JSON. Target and dead letters of a micro-batch are committed together.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.operators.shape import build_select
from ledgerline.plans.spec import check_spec
from ledgerline.sources.sinks import BatchTables

TARGET, DEAD = "target", "dead"


def _seconds(spark: SparkSession, delay: str) -> float:
    return spark.sql(f"SELECT cast(interval {delay} as interval day to second) AS d").first()["d"].total_seconds()


def _rows(spec: Mapping, source: DataFrame) -> DataFrame:
    """Watermark, dedupe and transforms, on a stream or a batch."""
    streams = source.isStreaming
    mark = spec.get("watermark")
    if mark and streams:
        source = source.withWatermark(mark["column"], mark["delay"])
    dd = spec.get("dedupe") or {}
    if dd.get("enabled", bool(dd)):
        if dd.get("order_by"):
            raise ValueError(f"{spec['name']}: a stream keeps the first arrival of a key; dedupe.order_by does not apply")
        if not mark:
            raise ValueError(f"{spec['name']}: dedupe on a stream needs a watermark")
        source = source.dropDuplicatesWithinWatermark(list(dd["key"])) if streams else source.dropDuplicates(list(dd["key"]))
    frames = {"source": source}
    last = source
    for t in spec.get("transforms", ()):
        df = frames[t["input"]] if "input" in t else last
        if "filter" in t:
            df = df.where(F.expr(t["filter"]))
        if "select" in t:
            df = df.select(*[F.expr(e).alias(n) for n, e in t["select"].items()])
        if "group_by" in t:
            df = _windowed(spec, df, t)
        if "derive" in t:
            df = df.withColumns({n: F.expr(e) for n, e in t["derive"].items()})
        frames[t["name"]] = last = df
    return last


def _windowed(spec: Mapping, df: DataFrame, t: Mapping) -> DataFrame:
    """An aggregate per tumbling window of the watermark column and ``group_by``."""
    mark, size = spec.get("watermark"), t.get("window")
    if not mark or not size:
        raise ValueError(f"{spec['name']}: {t['name']} aggregates, which on a stream needs a watermark and a window")
    ts = mark["column"]
    aggs = [F.expr(e).alias(n) for n, e in t["agg"].items()]
    out = df.groupBy(F.window(F.col(ts), size).alias("__w"), *t["group_by"]).agg(*aggs)
    if not df.isStreaming:  # what the watermark would have closed by the end
        newest = df.agg(F.unix_micros(F.max(F.col(ts).cast("timestamp"))).alias("m")).first()["m"]
        closed = 0 if newest is None else newest - int(_seconds(df.sparkSession, mark["delay"]) * 1e6)
        out = out.where(F.unix_micros(F.col("__w.end").cast("timestamp")) <= F.lit(closed))
    return out.select(F.col("__w.start").alias("window_start"), F.col("__w.end").alias("window_end"), *t["group_by"], *t["agg"])


def split_by_contract(spec: Mapping, rows: DataFrame, run_values: Mapping[str, str]) -> tuple[DataFrame, DataFrame]:
    """(target rows with the declared types and run columns, dead letters)."""
    typed, reason = [], F.lit(None).cast("string")
    for c in reversed(spec["columns"]):  # the first column that fails gives the reason
        name, kind = c["name"], c.get("type", "string")
        cast = F.col(name).try_cast(kind)
        typed.append(cast.alias(name))
        reason = F.when(F.col(name).isNotNull() & cast.isNull(), F.lit(f"CAST:{name}")).otherwise(reason)
        if c.get("nullable", True) is False:
            reason = F.when(F.col(name).isNull(), F.lit(f"NULL:{name}")).otherwise(reason)
    flat = build_select(rows, spec["columns"])
    judged = flat.select("*", reason.alias("__reason"))
    adds = [F.lit(run_values[v]).alias(n) for n, v in spec["target"].get("add_columns", {}).items()]
    good = judged.where(F.col("__reason").isNull()).select(*reversed(typed), *adds)
    dead = judged.where(F.col("__reason").isNotNull()).select(F.to_json(F.struct(*flat.columns)).alias("value"), F.col("__reason").alias("reason"))
    return good, dead


def stream_spec_batch(spec: Mapping, source: DataFrame, run_values: Mapping[str, str]) -> tuple[DataFrame, DataFrame]:
    """The spec over a table: (target rows, dead letters)."""
    check_spec(spec)
    return split_by_contract(spec, _rows(spec, source), run_values)


def tables_of(spec: Mapping, base_out: str) -> BatchTables:
    target = spec["target"]
    return BatchTables(f"{base_out}/{target['path']}", {TARGET: tuple(target.get("partition_by", ())), DEAD: ()})


def start_stream_spec(spark: SparkSession, spec: Mapping, base_in: str, base_out: str, run_values: Mapping[str, str]):
    """Starts the spec's query; its checkpoint lies beside the target."""
    check_spec(spec)
    if spec.get("mode") != "stream":
        raise ValueError(f"{spec.get('name')}: not a streaming spec")
    src = spec["source"]
    if "schema" not in src:
        raise ValueError(f"{spec['name']}: a streaming source needs a schema")
    reader = spark.readStream.format(src.get("format", "parquet")).schema(src["schema"]).options(**src.get("options", {}))
    rows = _rows(spec, reader.load(f"{base_in}/{src['path']}"))
    tables = tables_of(spec, base_out)

    def write(batch: DataFrame, batch_id: int) -> None:
        batch = batch.persist()  # the stateful part runs once for both tables
        try:
            good, dead = split_by_contract(spec, batch, run_values)
            tables.commit(batch.sparkSession, batch_id, {TARGET: good, DEAD: dead}, lambda n: {"run_id": run_values.get("run_id", "")})
        finally:
            batch.unpersist()

    trigger = spec.get("trigger") or {"available_now": True}
    trig = {"processingTime": trigger["processing_time"]} if "processing_time" in trigger else {"availableNow": True}
    return (rows.writeStream.outputMode("append").foreachBatch(write).queryName(spec["name"])
            .option("checkpointLocation", f"{tables.base}/_checkpoint").trigger(**trig).start())


def run_stream_spec(spark: SparkSession, spec: Mapping, base_in: str, base_out: str, run_values: Mapping[str, str]) -> dict[str, int]:
    """Runs the spec over what has arrived, and appends the run-log row.
    Gives the rows written by this run."""
    from ledgerline.operators import meta
    from ledgerline.plans.jobs import utc_now
    from ledgerline.sources import sinks

    if "processing_time" in (spec.get("trigger") or {}):
        raise ValueError(f"{spec['name']}: runs until stopped; use start_stream_spec")
    check_spec(spec)
    tables, started, error = tables_of(spec, base_out), utc_now(), None
    before = tables.last(spark)
    rows_in = 0
    counts = {"rows_out": 0, "dead": 0}
    try:
        query = start_stream_spec(spark, spec, base_in, base_out, run_values)
        query.awaitTermination()
        if query.exception() is not None:
            raise query.exception()
        rows_in = sum(int(p["numInputRows"]) for p in query.recentProgress)
        new = tables.log(spark).where(F.col("batch_id") > (-1 if before is None else before))
        got = new.agg(F.sum(F.col("counts")[TARGET]).alias("t"), F.sum(F.col("counts")[DEAD]).alias("d")).first()
        counts = {"rows_out": int(got["t"] or 0), "dead": int(got["d"] or 0)}
    except Exception as e:
        error = f"{type(e).__name__}: {e}"[:1000]
        raise
    finally:
        log = meta.run_log_row(spark, run_values["run_id"], run_values["run_dt"], spec["name"], rows_in, counts["rows_out"], counts["dead"],
                               started, utc_now(), error)
        sinks.write_table(log, f"{base_out}/_run_log", partition_by=("run_id", "job"))
    return {"rows_in": rows_in, **counts}
