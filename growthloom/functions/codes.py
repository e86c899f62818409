"""First and most frequent values as aggregates of numbers.

``picks`` keeps a struct or a map of values per group, which Spark aggregates
by sorting, row by row as objects. Where a column has few values, their places
in sorted order stand for them: a value and its time fit one long, and a count
per value is a long each, so the whole aggregate is a hash aggregate of
numbers. Equal to ``picks`` in every result; columns with more values stay
with ``picks``, so nothing is left out.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from growthloom.functions.picks import first_by_time, most_frequent, most_frequent_with_null

#: Every value of a column, in order, by column.
Values = Mapping[str, Sequence[str]]

#: Most values of a column that are counted (a counter each) and that are told apart at all.
COUNTED, _BITS = 16, 8
TOLD = 1 << _BITS
# Times this far from 1970 (some 280 years) leave room for a place beside them.
_FAR = (1 << 63) // TOLD // 4
_NEVER = -(1 << 63)  # an unknown time comes first, as NULL does


def few_values(df: DataFrame, columns: Sequence[str], ts: str = "event_ts") -> dict[str, list[str]]:
    """All non-NULL values of each of the string ``columns`` that has at most TOLD of
    them. None of the columns if a time of ``df`` is too far off to be coded.

    The values are made distinct by the tasks and cut off by rank; the driver gets
    at most TOLD + 1 a column."""
    far = F.when(F.abs(F.unix_micros(ts)) >= _FAR, F.lit("far"))
    pairs = F.array(F.struct(F.lit("").alias("_column"), far.alias("_value")), *[F.struct(F.lit(c).alias("_column"), F.col(c).alias("_value")) for c in columns])
    rank = F.row_number().over(Window.partitionBy("_column").orderBy("_value"))
    ranked = df.select(F.inline(pairs)).where(F.col("_value").isNotNull()).distinct().withColumn("_rank", rank)
    found: dict[str, list[str]] = {c: [] for c in columns}
    for column, value, _ in ranked.where(F.col("_rank") <= TOLD + 1).collect():
        if column == "":
            return {}
        found[column].append(value)
    # Code points order as UTF-8 bytes do, which is how Spark orders strings.
    return {c: sorted(v) for c, v in found.items() if len(v) <= TOLD}


def counted(values: Values, columns: Sequence[str]) -> dict[str, Sequence[str]]:
    """The ``columns`` that have few enough values to be counted."""
    return {c: values[c] for c in columns if c in values and len(values[c]) <= COUNTED}


def coded(df: DataFrame, values: Values) -> DataFrame:
    """``df`` with the place of its value instead of each column of ``values``."""

    def place(column: str) -> Column:
        if not values[column]:
            return F.lit(None).cast("int")
        at = F.array_position(F.array(*[F.lit(v) for v in values[column]]), F.col(column))
        return F.when(at > 0, at.cast("int") - 1).when(at == 0, F.raise_error(F.lit(f"a value of {column} is not among those known")).cast("int"))

    return df.withColumns({c: place(c) for c in values})


def _value(place: Column, values: Sequence[str | None]) -> Column:
    return F.get(F.array(*[F.lit(v).cast("string") for v in values or [None]]), place.cast("int"))


def timed(column: str, ts: str) -> Column:
    """A coded column's value and its time as one long, by which values are in order of time, then of value."""
    return F.coalesce(F.shiftleft(F.unix_micros(ts), _BITS), F.lit(_NEVER)).bitwiseOR(F.col(column).cast("long"))


def value_of(first: Column, values: Sequence[str]) -> Column:
    """The value of a ``timed`` long."""
    return _value(first.bitwiseAND(F.lit(TOLD - 1).cast("long")), values)


def first_of(column: str, ts: str, values: Values) -> Column:
    """``first_by_time`` of a column, coded if it is among ``values``."""
    if column not in values:
        return first_by_time(column, ts)
    return value_of(F.min(timed(column, ts)), values[column])


def top_of(column: str, values: Values, with_null: bool = False) -> Column:
    """``most_frequent`` (or ``most_frequent_with_null``) of a column, coded if it is among ``values``."""
    if column not in values:
        return most_frequent_with_null(column) if with_null else most_frequent(column)
    # The count in the high bits, below it a number that is higher for smaller values:
    # the greatest is the pick, and its number the place in ``picks``.
    picks = [*reversed(values[column]), None]
    counts = [F.count(F.when(F.col(column) == i, F.lit(1))) for i in range(len(values[column]))]
    ranked = [F.shiftleft(n, 5).bitwiseOR(F.lit(len(counts) - 1 - i).cast("long")) for i, n in enumerate(counts)]
    # NULL, the smallest; where it is no value it has no count, and is the pick of a group without values.
    none = F.shiftleft(F.count(F.when(F.col(column).isNull(), F.lit(1))), 5) if with_null else F.lit(0).cast("long")
    ranked.append(none.bitwiseOR(F.lit(len(counts)).cast("long")))
    best = F.greatest(*ranked) if len(ranked) > 1 else ranked[0]
    return _value(best.bitwiseAND(F.lit(31).cast("long")), picks)


def packed(columns: Sequence[str]) -> Column:
    """Up to six coded columns as one long, NULL being a value like others."""
    cell = F.lit(0).cast("long")
    for column in columns:
        cell = F.shiftleft(cell, _BITS + 1).bitwiseOR(F.coalesce(F.col(column) + 1, F.lit(0)).cast("long"))
    return cell


def unpacked(cell: Column, columns: Sequence[str], values: Values) -> list[Column]:
    """The values of the columns that were ``packed``."""
    bits = _BITS + 1
    places = [F.shiftright(cell, bits * i).bitwiseAND(F.lit((1 << bits) - 1).cast("long")) for i in reversed(range(len(columns)))]
    return [_value(place, [None, *values[c]]).alias(c) for c, place in zip(columns, places)]
