"""Deterministic "first" and "most frequent" aggregates.

All are plain Spark aggregates (``min`` over a struct, ``mode``), so they
run partial/final across the shuffle and never gather a group's rows in one
place: a hot user with a third of all events is combined map-side first.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def first_by_time(value: Column | str, ts: Column | str) -> Column:
    """First non-NULL value by time; equal times are broken by the smaller value.

    NULL values are skipped; a group with only NULLs gives NULL.
    """
    v, t = _col(value), _col(ts)
    return F.min(F.when(v.isNotNull(), F.struct(t.alias("t"), v.alias("v"))))["v"]


def any_value_det(value: Column | str, ts: Column | str) -> Column:
    """A deterministic ``any_value``: the first non-NULL value recorded."""
    return first_by_time(value, ts)


def most_frequent(value: Column | str) -> Column:
    """Most frequent non-NULL value; a tie goes to the smallest value."""
    return F.mode(_col(value), deterministic=True)


def most_frequent_with_null(value: Column | str) -> Column:
    """Most frequent value of a string column where NULL counts as a value of
    its own; a tie goes to the smallest value, NULL being the smallest.

    NULL is encoded as the empty string and every value gets a leading
    U+0001, so the encoding keeps the order (NULL lowest, values in their own
    order) and the plain string ``mode`` does the counting. (``mode`` over a
    struct wrapper gave run-to-run differences when partial buffers merged.)
    """
    v = _col(value)
    encoded = F.when(v.isNull(), F.lit("")).otherwise(F.concat(F.lit("\u0001"), v))
    top = F.mode(encoded, deterministic=True)
    return F.when(top == "", F.lit(None).cast("string")).otherwise(F.substr(top, F.lit(2)))


def approx_top_value(column_name: str) -> Column:
    """Approximate most frequent value of the named column (a sketch; ties
    are not defined)."""
    return F.get(F.expr(f"approx_top_k(`{column_name}`, 1)"), 0)["item"]


def flag_any(cond: Column) -> Column:
    """1 if any row meets ``cond``, else 0 (``max`` of a 0/1 flag)."""
    return F.max(F.when(cond, F.lit(1)).otherwise(F.lit(0)))
