"""Spec-driven jobs.

A spec is a plain dict (the parsed YAML/JSON document); run values such as
``run_dt`` and ``run_id`` arrive as arguments, not through templating. The
runner only composes DataFrame operations: the whole spec becomes one logical
plan that Catalyst optimises end to end (the filter on ``orders_clean`` is
pushed into the scan, unused columns are pruned, the aggregate is partial).
"""

from __future__ import annotations

import uuid
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ledgerline.operators import meta, quality
from ledgerline.operators.dedupe import dedupe_latest
from ledgerline.operators.scd2 import check_run_order, scd2_apply, scd2_initial
from ledgerline.operators.shape import build_select, current_rows

# The options a spec may carry. Anything else raises, so that no
# option is ever ignored.
_SCAN = {"format", "path", "table", "options", "schema"}
_KEYS = {
    "batch": {"name", "mode", "sources", "transforms", "joins", "target", "dq"},
    "scd2": {"name", "mode", "source", "keys", "dedupe", "columns", "scd2", "target", "dq"},
    "diff": {"name", "mode", "source", "keys", "columns", "target", "dq"},
    "stream": {"name", "mode", "source", "watermark", "dedupe", "transforms", "columns", "target", "trigger"},
}
_INNER = {
    "transform": {"name", "input", "select", "filter", "group_by", "agg", "derive"},
    "stream transform": {"name", "input", "select", "filter", "group_by", "agg", "derive", "window"},
    "watermark": {"column", "delay"},
    "trigger": {"available_now", "processing_time"},
    "join": {"left", "right", "type", "on", "output"},
    "target": {"path", "input", "format", "partition_by", "add_columns", "write_current_view", "current_view_path"},
    "dedupe": {"enabled", "key", "order_by"},
    "scd2": {"track_columns", "effective_to_open", "on_missing"},
    "dq": {"checks", "contract", "fail_over", "alert_over"},
    "column": {"name", "expr", "rule", "args", "type", "nullable"},
}


def check_spec(spec: Mapping) -> None:
    """Raises on any key the runner does not know."""
    def only(where: str, got, allowed) -> None:
        if extra := set(got) - set(allowed):
            raise ValueError(f"{spec.get('name')}: unknown {where} option(s) {sorted(extra)}")

    mode = spec.get("mode", "batch")
    if mode not in _KEYS:
        raise ValueError(f"{spec.get('name')}: unknown mode {mode!r}; known: {sorted(_KEYS)}")
    only("spec", spec, _KEYS[mode])
    for name, src in (spec.get("sources") or {}).items():
        only(f"source {name}", src, _SCAN)
    only("source", spec.get("source", {}), _SCAN)
    for t in spec.get("transforms", ()):
        only(f"transform {t.get('name')}", t, _INNER["stream transform" if mode == "stream" else "transform"])
    for j in spec.get("joins", ()):
        only(f"join {j.get('output')}", j, _INNER["join"])
    for c in spec.get("columns", ()):
        only(f"column {c.get('name')}", c, _INNER["column"])
    only("keys", spec.get("keys", {}), {"business"})
    for part in ("target", "dedupe", "scd2", "dq", "watermark", "trigger"):
        only(part, spec.get(part) or {}, _INNER[part])


def _transform(df: DataFrame, t: Mapping) -> DataFrame:
    if "filter" in t:  # over the input's columns, before the projection
        df = df.where(F.expr(t["filter"]))
    if "select" in t:
        df = df.select(*[F.expr(e).alias(n) for n, e in t["select"].items()])
    if "group_by" in t:
        aggs = [F.expr(e).alias(n) for n, e in t["agg"].items()]
        df = df.groupBy(*t["group_by"]).agg(*aggs)
    if "derive" in t:
        df = df.withColumns({n: F.expr(e) for n, e in t["derive"].items()})
    return df


def spec_frames(spec: Mapping, sources: Mapping[str, DataFrame], run_values: Mapping[str, str],
                watch=lambda name, df: df) -> dict[str, DataFrame]:
    """Every named output of a batch spec (sources, transforms, joins and the
    target, under the target's path) as lazy DataFrames; ``watch`` may wrap each
    as it is named."""
    check_spec(spec)
    frames: dict[str, DataFrame] = {}
    for name in spec["sources"]:
        frames[name] = watch(name, sources[name])
    last = None
    for t in spec.get("transforms", []):
        frames[t["name"]] = last = watch(t["name"], _transform(frames[t["input"]], t))
    for jn in spec.get("joins", []):
        left, right = frames[jn["left"]], frames[jn["right"]]
        frames[jn["output"]] = last = watch(jn["output"], left.join(right, list(jn["on"]), jn.get("type", "inner")))
    out = frames[spec["target"]["input"]] if spec["target"].get("input") else last
    adds = spec["target"].get("add_columns", {})
    if adds:
        out = out.withColumns({n: F.lit(run_values[v]) for n, v in adds.items()})
    target = spec["target"].get("path") or spec.get("name")
    frames[target] = watch(target, out)
    return frames


def run_batch_spec(spec: Mapping, sources: Mapping[str, DataFrame], run_values: Mapping[str, str]) -> DataFrame:
    """Batch mode (B5): sources -> transforms -> joins -> target columns.

    ``sources`` maps each name under ``spec["sources"]`` to a DataFrame (see
    ``sources.readers.read_spec_sources`` for reading them from a spec).
    Each transform and join output is addressable by its name; the target is
    the last output. ``target.add_columns`` maps a column to a run value:
    ``{"dt": "run_dt"}`` takes ``run_values["run_dt"]``.
    """
    return spec_frames(spec, sources, run_values)[spec["target"].get("path") or spec.get("name")]


def scd2_today(spec: Mapping, source: DataFrame) -> DataFrame:
    """The day's rows of an SCD2 spec: dedupe on the raw rows, before the projection,
    because its order column is not among the projected columns."""
    dd = spec.get("dedupe") or {}
    if dd.get("enabled", bool(dd)):
        source = dedupe_latest(source, dd["key"], dd.get("order_by", []))
    return build_select(source, spec["columns"])


def merge_today(spec: Mapping, today: DataFrame, hist: DataFrame | None, run_ts: str, rewind_first: bool = False) -> DataFrame:
    """The whole new history after ``scd2_today``'s rows."""
    keys, dd = spec["keys"]["business"], spec.get("dedupe") or {}
    tracked = spec["scd2"]["track_columns"]
    open_to = spec["scd2"].get("effective_to_open", "9999-12-31 00:00:00")
    if hist is None:
        return scd2_initial(today, keys, tracked, run_ts, open_to)
    exprs = {c["name"]: c.get("expr") for c in spec["columns"]}
    same_key = dd.get("enabled", bool(dd)) and list(dd["key"]) == list(keys) and all(exprs.get(k) == k for k in keys)
    return scd2_apply(hist, today, keys, tracked, run_ts, on_missing=spec["scd2"].get("on_missing", "keep"), open_to=open_to,
                      unique_today=same_key, rewind_first=rewind_first)


def run_scd2_spec(spec: Mapping, source: DataFrame, hist: DataFrame | None, run_ts: str, rewind_first: bool = False) -> DataFrame:
    """SCD2 mode (B4): dedupe raw rows, project with ``build_select``, merge. Returns
    the whole new history; the current view is ``current_rows`` of it."""
    check_spec(spec)
    return merge_today(spec, scd2_today(spec, source), hist, run_ts, rewind_first)


def run_diff_spec(spec: Mapping, previous: DataFrame, current: DataFrame) -> DataFrame:
    """Diff mode: the change rows between two projected snapshots."""
    from ledgerline.operators.change import snapshot_diff

    check_spec(spec)
    keys = spec["keys"]["business"]
    return snapshot_diff(build_select(previous, spec["columns"]), build_select(current, spec["columns"]), keys)


REPORT = "check_name string, column_name string, rows bigint, failed bigint, passed boolean"


class Watch:
    """Counts rows, and row-level and contract checks, of frames on their way to
    the place where they are written (A10, D6, D7): no pass of their own."""

    def __init__(self):
        self.seen: dict[str, Observation] = {}

    def __call__(self, name: str, df: DataFrame, *aggs) -> DataFrame:
        self.seen[name] = Observation(f"{name}_{uuid.uuid4().hex[:8]}")
        return df.observe(self.seen[name], F.count(F.lit(1)).alias("__rows"), *aggs)

    def get(self, name: str) -> dict:
        """The values, after the frame was written."""
        return self.seen[name].get or {"__rows": 0}

    def rows(self, name: str) -> int:
        return int(self.get(name).get("__rows") or 0)


def dq_aggs(spec: Mapping, df: DataFrame, run_ts: str | None) -> list:
    """Aggregates for the checks of the spec's ``dq`` block that go by rows."""
    dq = spec.get("dq") or {}
    by_row = [c for c in dq.get("checks", ()) if c["check"] != "unique"]
    aggs = quality.row_check_aggs(by_row, run_ts)[1:] if by_row else []
    return aggs + (quality.contract_aggs(df, spec["columns"])[1] if dq.get("contract") else [])


def dq_rows(spec: Mapping, got: Mapping, staged: DataFrame) -> list[tuple]:
    """Report rows: from the observed values, and the unique checks on what was staged."""
    dq = spec.get("dq") or {}
    checks = dq.get("checks", ())
    by_row = [c for c in checks if c["check"] != "unique"]
    out = quality.row_check_rows(by_row, got)
    out += [tuple(quality.unique_report(staged, c["columns"]).first()) for c in checks if c["check"] == "unique"]
    return out + (quality.contract_rows(quality.contract_aggs(staged, spec["columns"])[0], got) if dq.get("contract") else [])


def needed_nodes(spec: Mapping) -> set[str]:
    """The named outputs of a batch spec that the target is made of."""
    up: dict[str, set[str]] = {}
    for a, b, _ in lineage_from_spec(spec):
        up.setdefault(b, set()).add(a)
    found, todo = set(), [spec["target"].get("path") or spec.get("name")]
    while todo:
        n = todo.pop()
        if n not in found:
            found.add(n)
            todo += up.get(n, ())
    return found


def run_spec(spark: SparkSession, spec: Mapping, base_in: str, base_out: str, run_values: Mapping[str, str]) -> dict[str, int]:
    """``_run_spec`` with the session sized for the spec's inputs; a streaming spec
    runs over what has arrived since its last run."""
    from ledgerline.session import sized

    check_spec(spec)
    if spec.get("mode") == "stream":
        from ledgerline.plans.stream_spec import run_stream_spec
        return run_stream_spec(spark, spec, base_in, base_out, run_values)
    scans = list((spec.get("sources") or {}).values()) or [spec["source"]]
    with sized(spark, [f"{base_in}/{s['path']}" for s in scans]):
        return _run_spec(spark, spec, base_in, base_out, run_values)


def stage(df: DataFrame) -> DataFrame:
    """``df`` written once to the shared checkpoint folder, as columns, and read back."""
    from ledgerline.session import ensure_checkpoint_dir

    spark = df.sparkSession
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/staged-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def _run_spec(spark: SparkSession, spec: Mapping, base_in: str, base_out: str, run_values: Mapping[str, str]) -> dict[str, int]:
    """A whole run: scan the sources, transform or merge, check, write the target
    (and the current view), and append the run-log row, all under ``base_out``.

    ``run_values`` holds run_dt, run_id and run_ts. More than ``dq.fail_over``
    failed checks (default: no limit) stop the run before the target is written; the
    run log then says FAILED. Reports go to ``_dq``, alert rows of checks with
    more than ``dq.alert_over`` failed rows (default 0) to ``_alerts``, run rows to
    ``_run_log``.
    """
    from ledgerline.plans.jobs import utc_now
    from ledgerline.sources import sinks
    from ledgerline.sources.readers import read_spec_sources

    check_spec(spec)
    started = utc_now()
    target, mode = spec["target"], spec.get("mode", "batch")
    path = f"{base_out}/{target['path']}"
    run_dt, run_id = run_values["run_dt"], run_values["run_id"]
    run_ts = run_values.get("run_ts", f"{run_dt} 00:00:00")
    fmt = target.get("format", "parquet")
    error = None
    rows_in = rows_out = failed = 0
    watch = Watch()
    nodes: dict[str, int] = {}
    try:
        if mode == "batch":
            sources = read_spec_sources(spark, spec, base_in)
            node, used = target.get("path") or spec.get("name"), needed_nodes(spec)

            def named(name: str, df: DataFrame) -> DataFrame:
                return watch(name, df, *(dq_aggs(spec, df, run_ts) if name == node else ())) if name in used else df

            staged = out = stage(spec_frames(spec, sources, run_values, named)[node])  # one scan of each source
            nodes = {n: watch.rows(n) for n in watch.seen}
            rows_in = sum(nodes[n] if n in used else df.count() for n, df in sources.items())
            checked = watch.get(node)
        else:
            source = read_spec_sources(spark, {**spec, "sources": {"source": spec["source"]}}, base_in)["source"]
            rows = watch("source", source)
            today = scd2_today(spec, rows) if mode == "scd2" else build_select(rows, spec["columns"])
            staged = stage(watch("today", today, *dq_aggs(spec, today, run_ts)))
            rows_in, checked = watch.rows("source"), watch.get("today")
            nodes = {n: watch.rows(n) for n in watch.seen}
            folder = sinks.base_folder(spark, path, run_id)
            hist = None if folder is None else sinks.read_folder(spark, path, folder, fmt)
            if mode == "diff":
                plain = {**spec, "columns": [{"name": c, "expr": c} for c in staged.columns]}
                out = run_diff_spec(plain, staged.limit(0) if hist is None else hist, staged)
            else:
                again = hist is not None and check_run_order(hist, run_ts)
                out = merge_today(spec, staged, hist, run_ts, rewind_first=again)
        report = dq_rows(spec, checked, staged)
        failed = sum(not r[-1] for r in report)
        if report:
            frame = spark.createDataFrame(report, REPORT)
            stamped = frame.withColumns({"run_id": F.lit(run_id), "run_dt": F.lit(run_dt), "job": F.lit(spec["name"])})
            sinks.write_table(stamped, f"{base_out}/_dq", partition_by=("run_id", "job"))
            alerts = quality.threshold_alerts(stamped, "failed", (spec["dq"]).get("alert_over", 0), "DQ_FAILED")
            sinks.write_table(alerts, f"{base_out}/_alerts", partition_by=("run_id", "job"))
        limit = (spec.get("dq") or {}).get("fail_over")
        if limit is not None and failed > limit:
            raise ValueError(f"{spec['name']}: {failed} checks failed, more than {limit}")
        out = watch("out", out)
        parts: Sequence[str] = target.get("partition_by", ())
        if mode == "batch":
            sinks.write_table(out, path, fmt=fmt, partition_by=parts)
        elif mode == "diff":
            sinks.write_table(out.withColumn("run_dt", F.lit(run_dt)), f"{path}_changes", partition_by=("run_dt",))
            sinks.publish_version(staged, path, run_id, parts, fmt)
        else:
            written = sinks.publish_version(out, path, run_id, parts, fmt)
            if target.get("write_current_view"):
                new = spark.read.format(fmt).schema(out.schema).load(written)
                sinks.publish_version(current_view(new), f"{base_out}/{target['current_view_path']}", run_id, (), fmt)
        rows_out = watch.rows("out")
        counts = [(n, k) for n, k in nodes.items()]
        sinks.write_table(spark.createDataFrame(counts, "node string, rows bigint").withColumns(
            {"run_id": F.lit(run_id), "job": F.lit(spec["name"])}), f"{base_out}/_node_rows", partition_by=("run_id", "job"))
    except Exception as e:
        error = f"{type(e).__name__}: {e}"[:1000]
        raise
    finally:
        log = meta.run_log_row(spark, run_id, run_dt, spec["name"], rows_in, rows_out, failed, started, utc_now(), error)
        sinks.write_table(log, f"{base_out}/_run_log", partition_by=("run_id", "job"))
    return {"rows_in": rows_in, "rows_out": rows_out, "dq_failed": failed}


def current_view(hist: DataFrame) -> DataFrame:
    return current_rows(hist)


def observed_node_rows(spec: Mapping, sources: Mapping[str, DataFrame], run_values: Mapping[str, str]) -> dict[str, int]:
    """Rows of every output of a batch spec that its target is made of, counted by
    observations in the one pass that computes the target (to the no-op sink)."""
    watch, used = Watch(), needed_nodes(spec)
    frames = spec_frames(spec, sources, run_values, lambda n, df: watch(n, df) if n in used else df)
    frames[spec["target"].get("path") or spec.get("name")].write.format("noop").mode("overwrite").save()
    return {name: watch.rows(name) for name in watch.seen}


def lineage_from_spec(spec: Mapping) -> list[tuple[str, str, str]]:
    """Edges ``(upstream, downstream, kind)`` named by a spec."""
    edges: list[tuple[str, str, str]] = []
    target = spec["target"].get("path") or spec.get("name")
    if "sources" in spec:
        for name, s in spec["sources"].items():
            if s.get("path", name).partition(".")[0] != name:
                edges.append((s.get("path", name), name, "source"))
        last = None
        for t in spec.get("transforms", []):
            edges.append((t["input"], t["name"], "transform"))
            last = t["name"]
        for jn in spec.get("joins", []):
            edges.append((jn["left"], jn["output"], "join"))
            edges.append((jn["right"], jn["output"], "join"))
            last = jn["output"]
        edges.append((spec["target"].get("input") or last, target, "target"))
    else:
        src = spec["source"].get("path") or spec["source"].get("table")
        edges.append((src, target, spec.get("mode", "load")))
        if spec["target"].get("current_view_path"):
            edges.append((target, spec["target"]["current_view_path"], "current_view"))
    return edges


# ---------------------------------------------------------------- column lineage

def references(df: DataFrame, expr: str) -> set[str]:
    """Columns of ``df`` that a SQL expression reads, from its analysed plan."""
    seq = df.select(F.expr(expr).alias("x"))._jdf.queryExecution().analyzed().references().toSeq()
    return {seq.apply(i).name() for i in range(seq.size())}


def column_lineage(spec: Mapping, sources: Mapping[str, DataFrame]) -> list[tuple[str, str]]:
    """Edges ``(node.column, node.column)`` of a batch spec: what each output column is
    computed from. Only schemas are looked at."""
    frames = spec_frames(spec, {n: df.limit(0) for n, df in sources.items()},
                         {v: "" for v in spec["target"].get("add_columns", {}).values()})
    edges: list[tuple[str, str]] = []

    def link(up: str, cols, down: str, col: str) -> None:
        edges.extend((f"{up}.{c}", f"{down}.{col}") for c in sorted(cols))

    last = None
    for t in spec.get("transforms", []):
        df, up, name = frames[t["input"]], t["input"], t["name"]
        made: dict[str, set[str]] = {c: {c} for c in df.columns}  # column so far -> columns of the input
        steps = [("select", t["select"])] if "select" in t else []
        if "group_by" in t:
            steps.append(("group_by", {**{k: f"`{k}`" for k in t["group_by"]}, **t["agg"]}))
        steps += [("derive", {k: e}) for k, e in t.get("derive", {}).items()]
        now = df.where(F.expr(t["filter"])) if "filter" in t else df
        for kind, exprs in steps:
            refs = {n: set().union(*(made[c] for c in references(now, e)), set()) for n, e in exprs.items()}
            made = {**made, **refs} if kind == "derive" else refs
            part = {"select": {"select": exprs}, "derive": {"derive": exprs}}.get(kind) or {"group_by": t["group_by"], "agg": t["agg"]}
            now = _transform(now, part)
        for c in frames[name].columns:
            link(up, made[c], name, c)
        last = name
    for jn in spec.get("joins", []):
        for side in ("left", "right"):
            for c in frames[jn[side]].columns:
                link(jn[side], {c}, jn["output"], c)
        last = jn["output"]
    target = spec["target"].get("path") or spec.get("name")
    for c in frames[spec["target"].get("input") or last].columns:
        link(spec["target"].get("input") or last, {c}, target, c)
    return edges
