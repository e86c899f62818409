"""Calendar periods and engagement buckets as Column expressions.

Periods are handled as integer indexes (days, weeks or months since 1970),
so "previous period", "periods between" and "all periods from a to b" are
integer arithmetic that is the same for every grain; dates are rebuilt from
the index only for output. All of it stays inside Catalyst codegen.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

GRAINS = ("day", "week", "month")

# The report of event activity names its grains differently from the
# growth tables; both vocabularies are kept as written.
ACTIVITY_GRAIN_LABELS = {"day": "daily", "week": "weekly", "month": "monthly"}

# Event types per engagement bucket.
PRE_ENGAGEMENT_TYPES = ("like", "share", "reward_search")
TRANSACTION_TYPES = ("miles_earned", "miles_redeemed")
ENGAGEMENT_TYPES = ("all", "pre_engagement", "transaction")

_EPOCH = "1970-01-01"
# 1970-01-04 was a Sunday and 1970-01-05 a Monday.
_WEEK_ANCHOR = {"sunday": "1970-01-04", "monday": "1970-01-05"}


def _check_grain(grain: str) -> None:
    if grain not in GRAINS:
        raise ValueError(f"Invalid grain: {grain}")


def _check_week_start(week_start: str) -> None:
    if week_start not in _WEEK_ANCHOR:
        raise ValueError(f"Invalid week start: {week_start}")


def engagement_bucket(event_type: Column | str) -> Column:
    """like/share/reward_search -> pre_engagement; miles_* -> transaction; else other."""
    c = F.col(event_type) if isinstance(event_type, str) else event_type
    return (
        F.when(c.isin(*PRE_ENGAGEMENT_TYPES), F.lit("pre_engagement"))
        .when(c.isin(*TRANSACTION_TYPES), F.lit("transaction"))
        .otherwise(F.lit("other"))
    )


def engagement_types(bucket: Column | str) -> Column:
    """Engagement types an event counts under: always ``all``, plus its bucket
    unless the bucket is ``other``."""
    b = F.col(bucket) if isinstance(bucket, str) else bucket
    return F.when(
        b.isin("pre_engagement", "transaction"), F.array(F.lit("all"), b)
    ).otherwise(F.array(F.lit("all")))


def _static_index(d: Column, grain: str, week_start: str) -> Column:
    if grain == "day":
        return F.datediff(d, F.lit(_EPOCH).cast("date"))
    if grain == "week":
        days = F.datediff(d, F.lit(_WEEK_ANCHOR[week_start]).cast("date"))
        return F.floor(days / F.lit(7)).cast("int")
    return ((F.year(d) - F.lit(1970)) * F.lit(12) + F.month(d) - F.lit(1)).cast("int")


def _static_from_index(idx: Column, grain: str, week_start: str) -> Column:
    if grain == "day":
        return F.date_add(F.lit(_EPOCH).cast("date"), idx)
    if grain == "week":
        return F.date_add(F.lit(_WEEK_ANCHOR[week_start]).cast("date"), idx * F.lit(7))
    return F.add_months(F.lit(_EPOCH).cast("date"), idx)


def _by_grain(grain: str | Column, build) -> Column:
    if isinstance(grain, str):
        _check_grain(grain)
        return build(grain)
    expr = None
    for g in GRAINS:
        branch = build(g)
        expr = F.when(grain == g, branch) if expr is None else expr.when(grain == g, branch)
    return expr


def period_index(d: Column | str, grain: str | Column, week_start: str = "sunday") -> Column:
    """Integer index of the period containing date ``d``."""
    _check_week_start(week_start)
    c = F.col(d) if isinstance(d, str) else d
    return _by_grain(grain, lambda g: _static_index(c, g, week_start))


def period_from_index(idx: Column | str, grain: str | Column, week_start: str = "sunday") -> Column:
    """First day of the period with index ``idx``."""
    _check_week_start(week_start)
    c = F.col(idx) if isinstance(idx, str) else idx
    return _by_grain(grain, lambda g: _static_from_index(c, g, week_start))


def period_start(d: Column | str, grain: str | Column, week_start: str = "sunday") -> Column:
    """Start of the period containing ``d``: the day itself, its week (Sunday
    by default) or its month."""
    _check_week_start(week_start)
    c = F.col(d) if isinstance(d, str) else d

    def build(g: str) -> Column:
        if g == "day":
            return c
        if g == "month":
            return F.trunc(c, "month")
        if week_start == "monday":
            return F.trunc(c, "week")
        return F.date_sub(c, F.dayofweek(c) - F.lit(1))

    return _by_grain(grain, build)
