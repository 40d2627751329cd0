"""Column-level building blocks (scalar functions, F1-F10, U1).

Everything here returns a native ``Column`` so it stays inside whole-stage
codegen; nothing is a Python UDF.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values that must match the reference's row hash: null placeholder,
# separator and digest width of ``hash_diff``.
HASH_NULL = "~"
HASH_SEP = "||"
HASH_BITS = 256

# Fixed open end of a validity interval, as written in the reference configs.
OPEN_END = "9999-12-31 00:00:00"


def col_or_expr(c: str | Column) -> Column:
    return c if isinstance(c, Column) else F.col(c)


def hash_diff(cols: Sequence[str | Column]) -> Column:
    """sha2-256 over the ``||``-joined text of ``cols``, null as ``~``.

    Kept for parity and audit; change detection uses per-column
    null-safe equality, because this encoding collides (null vs ``~``,
    separators inside values).
    """
    parts = [F.coalesce(col_or_expr(c).cast("string"), F.lit(HASH_NULL)) for c in cols]
    return F.sha2(F.concat_ws(HASH_SEP, *parts), HASH_BITS)


def differs(a: Column, b: Column) -> Column:
    """Null-safe inequality: true when values differ, nulls compare equal."""
    return ~a.eqNullSafe(b)


def any_differs(pairs: Iterable[tuple[Column, Column]]) -> Column:
    out = F.lit(False)
    for a, b in pairs:
        out = out | differs(a, b)
    return out


def changed_columns(names: Sequence[str], left: str, right: str) -> Column:
    """Comma-joined names of columns whose values differ between two aliases."""
    flags = [F.when(differs(F.col(f"{left}.{n}"), F.col(f"{right}.{n}")), F.lit(n)) for n in names]
    return F.concat_ws(",", *flags) if flags else F.lit("")


def parse_order(spec: str | Column) -> Column:
    """``"col [asc|desc]"`` -> sort Column, Spark's default null placement.

    ``desc`` puts nulls last and ``asc`` puts them first, as plain ORDER BY does.
    """
    if isinstance(spec, Column):
        return spec
    parts = spec.strip().split()
    name = parts[0]
    direction = parts[1].lower() if len(parts) > 1 else "asc"
    if direction not in ("asc", "desc"):
        raise ValueError(f"bad order spec {spec!r}")
    c = F.col(name)
    return c.desc_nulls_last() if direction == "desc" else c.asc_nulls_first()


def safe_cast(c: str | Column, to: str) -> Column:
    """Cast that yields null on dirty text instead of failing (ANSI mode)."""
    return col_or_expr(c).try_cast(to)


#: Date, time of day and an optional zone; anything shorter (a bare time, a
#: year) is no timestamp, although a cast would accept it.
ISO_TIMESTAMP = r"^\d{4}-\d{2}-\d{2}[T ]\d{2}:\d{2}:\d{2}(\.\d+)?(Z|[+-]\d{2}:?\d{2})?$"


def parse_iso_timestamp(c: str | Column) -> Column:
    """ISO-8601 text with an optional zone suffix -> timestamp, null if invalid."""
    text = col_or_expr(c)
    return F.when(text.rlike(ISO_TIMESTAMP), F.try_to_timestamp(text))


def surrogate_key(business_keys: Sequence[str], valid_from: str | Column) -> Column:
    """Stable version key: sha2 over business keys and the version start, to the
    microsecond (F10). Every part carries its length and null has a mark of its
    own, so different keys never give one text."""
    parts = [F.col(k).cast("string") for k in business_keys]
    parts.append(F.date_format(col_or_expr(valid_from), "yyyy-MM-dd HH:mm:ss.SSSSSS"))
    sized = [F.coalesce(F.concat(F.length(p).cast("string"), F.lit(":"), p), F.lit("-")) for p in parts]
    return F.sha2(F.concat(*sized), HASH_BITS)


# ---------------------------------------------------------------- rules

def lower_trim(name: str) -> Column:
    return F.lower(F.trim(F.col(name)))


def upper_trim(name: str) -> Column:
    return F.upper(F.trim(F.col(name)))


# Rule names as the reference's specs spell them.
RULES: dict[str, Callable[..., Column]] = {
    "str.lower_trim": lower_trim,
    "str.upper_trim": upper_trim,
}


def register_rule(name: str, fn: Callable[..., Column]) -> None:
    RULES[name] = fn


def apply_rule(name: str, args: Sequence) -> Column:
    try:
        fn = RULES[name]
    except KeyError:
        raise ValueError(f"unknown rule {name!r}; known: {sorted(RULES)}") from None
    return fn(*args)
