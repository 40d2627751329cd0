"""SQL text builders for the DuckDB oracles of the change-data queries.

These only assemble SQL strings for the independent check; nothing here runs
in Spark.
"""

from __future__ import annotations

from collections.abc import Sequence

OPEN_END_SQL = "TIMESTAMP '9999-12-31 00:00:00'"


def sql_hash(cols: Sequence[str], alias: str = "") -> str:
    pre = f"{alias}." if alias else ""
    parts = ", ".join(f"coalesce(CAST({pre}{c} AS VARCHAR), '~')" for c in cols)
    return f"sha256(concat_ws('||', {parts}))"


def sql_dedupe(src: str, keys: Sequence[str], order: str, all_cols: Sequence[str]) -> str:
    """row_number() = 1 per key, ``order`` then the whole-row hash descending."""
    o = f"{order}, " if order else ""
    return (f"SELECT * EXCLUDE (__rn) FROM (SELECT *, row_number() OVER (PARTITION BY {', '.join(keys)} "
            f"ORDER BY {o}{sql_hash(all_cols)} DESC) AS __rn FROM {src}) WHERE __rn = 1")


def sql_scd2_initial(today: str, cols: Sequence[str], tracked: Sequence[str], run_ts: str) -> str:
    return (f"SELECT {', '.join(cols)}, {sql_hash(tracked)} AS hash_diff, TIMESTAMP '{run_ts}' AS effective_from, "
            f"{OPEN_END_SQL} AS effective_to, true AS is_current FROM {today}")


def sql_scd2_step(hist: str, today: str, keys: Sequence[str], attrs: Sequence[str], tracked: Sequence[str],
                  run_ts: str, on_missing: str = "keep") -> str:
    """One SCD2 merge of ``today`` into history ``hist`` (both CTE names)."""
    cols = list(keys) + list(attrs)
    on = " AND ".join(f"d.{k} = s.{k}" for k in keys)
    d_in, s_in = f"d.{keys[0]} IS NOT NULL", f"s.{keys[0]} IS NOT NULL"
    changed = "(" + " OR ".join(f"d.{c} IS DISTINCT FROM s.{c}" for c in tracked) + ")"
    run = f"TIMESTAMP '{run_ts}'"
    d_cols = ", ".join(f"d.{c} AS {c}" for c in cols)
    s_cols = ", ".join(f"s.{c} AS {c}" for c in cols)
    hist_cols = ", ".join(cols + ["hash_diff", "effective_from", "effective_to", "is_current"])
    j = (f"(SELECT * FROM {hist} WHERE is_current) d FULL OUTER JOIN "
         f"(SELECT * FROM {today} WHERE {' AND '.join(k + ' IS NOT NULL' for k in keys)}) s ON {on}")
    parts = [
        f"SELECT {hist_cols} FROM {hist} WHERE NOT is_current",
        f"SELECT {s_cols}, {sql_hash(tracked, 's')} AS hash_diff, {run} AS effective_from, {OPEN_END_SQL} AS effective_to, "
        f"true AS is_current FROM {j} WHERE {s_in} AND (NOT ({d_in}) OR {changed})",
        f"SELECT {d_cols}, d.hash_diff, d.effective_from, {run} AS effective_to, false AS is_current FROM {j} "
        f"WHERE {d_in} AND {s_in} AND {changed}",
        f"SELECT {d_cols}, d.hash_diff, d.effective_from, d.effective_to, d.is_current FROM {j} "
        f"WHERE {d_in} AND {s_in} AND NOT {changed}",
    ]
    if on_missing == "keep":
        parts.append(f"SELECT {d_cols}, d.hash_diff, d.effective_from, d.effective_to, d.is_current FROM {j} "
                     f"WHERE {d_in} AND NOT ({s_in})")
    else:
        parts.append(f"SELECT {d_cols}, d.hash_diff, d.effective_from, {run} AS effective_to, false AS is_current "
                     f"FROM {j} WHERE {d_in} AND NOT ({s_in})")
    return "\nUNION ALL\n".join(parts)


def sql_hist_out(hist: str, cols: Sequence[str], where: str = "") -> str:
    """History as the queries expose it: validity bounds as yyyy-MM-dd text."""
    w = f" WHERE {where}" if where else ""
    return (f"SELECT {', '.join(cols)}, hash_diff, strftime(effective_from, '%Y-%m-%d') AS effective_from, "
            f"strftime(effective_to, '%Y-%m-%d') AS effective_to, is_current FROM {hist}{w}")


def sql_net_ops(delta: str, keys: Sequence[str], all_cols: Sequence[str], on_tie: str = "delete") -> str:
    if on_tie == "delete":
        rank = "CASE op WHEN 'D' THEN 3 WHEN 'C' THEN 2 WHEN 'I' THEN 1 ELSE 0 END"
    else:
        rank = "CASE op WHEN 'C' THEN 3 WHEN 'I' THEN 2 WHEN 'D' THEN 1 ELSE 0 END"
    return sql_dedupe(delta, keys, f"seq DESC NULLS LAST, {rank} DESC", all_cols)
