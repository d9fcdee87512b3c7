"""Scalar column expressions.

Every function returns a ``Column`` built only from Spark's native
functions, so it stays inside whole-stage codegen; none is a Python UDF.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..fixed import (AGE_EDGES, AGE_LABELS, COST_CAP, DEFAULT_CODE, REDRAW_HIGH,  # noqa: F401
                     REDRAW_LOW, TABLET_WORD, UNIT_TYPE_PATTERN)

ColumnOrName = Column | str

# ASCII whitespace run, spelled out so every regex engine reads it alike.
WHITESPACE_RUN = r"[ \t\n\x0B\f\r]+"


def _c(c: ColumnOrName) -> Column:
    return F.col(c) if isinstance(c, str) else c


def unit_type(name: ColumnOrName) -> Column:
    """Text of the first ``(...)``; a ``/`` keeps the part before it.

    ``'Ward (MICU/SICU)'`` -> ``'MICU'``; ``'Ward (/B)'`` -> ``''``;
    no parentheses or ``()`` -> null; null -> null.
    """
    inner = F.regexp_extract(_c(name), UNIT_TYPE_PATTERN, 1)
    return F.when(inner != F.lit(""), F.split_part(inner, F.lit("/"), F.lit(1)))


def normalize_key(c: ColumnOrName, all_whitespace: bool = True) -> Column:
    """Lower-case and strip a text key.

    ``all_whitespace`` strips tabs and newlines too (pandas ``str.strip``);
    ``False`` strips spaces only (Spark ``trim``).
    """
    col = _c(c)
    edge_ws = "^" + WHITESPACE_RUN + "|" + WHITESPACE_RUN + "$"
    stripped = F.regexp_replace(col, edge_ws, "") if all_whitespace else F.trim(col)
    return F.lower(stripped)


def coerce_numeric(c: ColumnOrName, type_: str = "double") -> Column:
    """Text to number; malformed text becomes null instead of failing (ANSI-safe)."""
    return _c(c).try_cast(type_)


def null_to_zero(c: ColumnOrName) -> Column:
    return F.coalesce(_c(c), F.lit(0))


def derive_total(*cols: ColumnOrName) -> Column:
    """Sum of the given columns (null-safe: missing parts count as 0)."""
    parts = [F.coalesce(_c(c), F.lit(0)) for c in cols]
    total = parts[0]
    for p in parts[1:]:
        total = total + p
    return total


def cap_upper(c: ColumnOrName, limit: float = COST_CAP) -> Column:
    """``min(c, limit)`` that keeps null (``least`` would turn null into the cap)."""
    col = _c(c)
    return F.when(col > F.lit(limit), F.lit(limit)).otherwise(col)


def hash_number(*keys: ColumnOrName, seed: int = 42, digits: int = 15) -> Column:
    """A repeatable whole number below ``16 ** digits`` from key columns: the first
    hex digits of the MD5 of ``key|...|seed`` (any SQL engine computes the same)."""
    text = F.concat_ws("|", *[_c(k).cast("string") for k in keys], F.lit(str(seed)))
    return F.conv(F.substring(F.md5(text.cast("binary")), 1, digits), 16, 10).cast("long")


def uniform_hash(*keys: ColumnOrName, seed: int = 42) -> Column:
    """Repeatable draw in [0, 1) from key columns.

    A hash of the key, never ``rand()``: a retried task or a different
    partitioning gives every row the same value again.
    """
    return hash_number(*keys, seed=seed, digits=5).cast("double") / F.lit(float(1 << 20))


def redraw_capped(c: ColumnOrName, key: Sequence[ColumnOrName], cap: float = COST_CAP,
                  low: float = REDRAW_LOW, high: float = REDRAW_HIGH, seed: int = 42) -> Column:
    """A value exactly at ``cap`` becomes a uniform draw in ``[low, high)``."""
    col = _c(c)
    draw = F.lit(low) + F.lit(high - low) * uniform_hash(*key, seed=seed)
    return F.when(col == F.lit(cap), draw).otherwise(col)


def extract_count(size: ColumnOrName, name: ColumnOrName, word: str = TABLET_WORD) -> Column:
    """Package size if present; else the first number in a name mentioning ``word``."""
    nm = _c(name)
    first_number = F.regexp_extract(nm, r"(\d+)", 1).try_cast("int")
    from_name = F.when(F.lower(nm).contains(word), first_number)
    return F.coalesce(_c(size).cast("double"), from_name.cast("double"))


def bin_labels(c: ColumnOrName, edges: Sequence[float] = AGE_EDGES,
               labels: Sequence[str] = AGE_LABELS) -> Column:
    """Right-closed bins ``(e[i], e[i+1]] -> labels[i]``; outside, null or malformed text -> null."""
    if len(edges) != len(labels) + 1:
        raise ValueError("need one more edge than labels")
    col = _c(c).try_cast("double")
    expr = None
    for lo, hi, lab in zip(edges[:-1], edges[1:], labels):
        cond = (col > F.lit(lo)) & (col <= F.lit(hi))
        expr = F.when(cond, F.lit(lab)) if expr is None else expr.when(cond, F.lit(lab))
    return expr


def month_period(c: ColumnOrName) -> Column:
    """Timestamp or date to the first day of its month (a ``date``)."""
    return F.trunc(_c(c).cast("date"), "month")


def parse_ratio(c: ColumnOrName) -> tuple[Column, Column]:
    """``'a:b'`` -> (a, b) as doubles; malformed parts -> null."""
    parts = F.split(_c(c), ":")
    left = F.trim(F.get(parts, 0)).try_cast("double")
    right = F.trim(F.get(parts, 1)).try_cast("double")
    return left, right


def labor_cost(days: ColumnOrName, patients: ColumnOrName, wage: ColumnOrName,
               as_reference: bool = True) -> Column:
    """Nurse labour cost of a stay.

    ``hours = days * 24 / patients``. The reference multiplies by ``days``
    a second time (``as_reference=True``); ``False`` gives ``hours * wage``.
    """
    d = _c(days)
    hours = F.try_divide(d * F.lit(24), _c(patients))
    cost = hours * _c(wage)
    return cost * d if as_reference else cost


def nurse_hours(days: ColumnOrName, patients: ColumnOrName) -> Column:
    return F.try_divide(_c(days) * F.lit(24), _c(patients))


def code_tokens(codes: ColumnOrName) -> Column:
    """Commas to spaces, split on whitespace, blank tokens dropped: ``array<string>``."""
    raw = F.split(F.trim(F.regexp_replace(_c(codes), ",", " ")), WHITESPACE_RUN)
    return F.filter(raw, lambda t: t != F.lit(""))


def hashed_id(*keys: ColumnOrName) -> Column:
    """Repeatable text id: SHA-256 of the ``|``-joined key texts."""
    return F.sha2(F.concat_ws("|", *[_c(k).cast("string") for k in keys]), 256)
