"""Data-quality checks that return failing rows, a runner that reports
failure counts per check, and a column-contract check."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from growthloom.functions.periods import ENGAGEMENT_TYPES, GRAINS

# Accepted value lists of the checks.
EVENT_TYPES = ("like", "share", "reward_search", "miles_earned", "miles_redeemed")
BUCKETS = ("pre_engagement", "transaction", "other")
GROWTH_STATUSES = ("new", "retained", "resurrected", "churned")
CUSTOMER_STATUSES = ("new_customer", "existing_customer")
USER_TYPES = ("new", "existing")


@dataclass(frozen=True)
class Check:
    table: str
    column: str
    kind: str  # not_null | unique | accepted_values | relationships
    values: tuple = ()
    to_table: str | None = None
    to_column: str | None = None


# --- failing rows ---------------------------------------------------------

def not_null_failures(df: DataFrame, column: str) -> DataFrame:
    return df.filter(F.col(column).isNull())


def accepted_values_failures(df: DataFrame, column: str, values: Sequence) -> DataFrame:
    c = F.col(column)
    return df.filter(c.isNotNull() & ~c.isin(*values))


def unique_failures(df: DataFrame, column: str) -> DataFrame:
    """Rows whose non-NULL value occurs more than once."""
    dup = (
        df.filter(F.col(column).isNotNull())
        .groupBy(column)
        .agg(F.count(F.lit(1)).alias("_n"))
        .filter(F.col("_n") > 1)
        .select(column)
    )
    return df.join(dup, column, "left_semi")


def relationship_failures(child: DataFrame, column: str, parent: DataFrame, parent_column: str) -> DataFrame:
    """Child rows with a non-NULL key that has no parent row."""
    keys = parent.select(F.col(parent_column).alias(column)).filter(F.col(column).isNotNull())
    return child.filter(F.col(column).isNotNull()).join(keys, column, "left_anti")


def failures(check: Check, tables: Mapping[str, DataFrame]) -> DataFrame:
    df = tables[check.table]
    if check.kind == "not_null":
        return not_null_failures(df, check.column)
    if check.kind == "accepted_values":
        return accepted_values_failures(df, check.column, check.values)
    if check.kind == "unique":
        return unique_failures(df, check.column)
    if check.kind == "relationships":
        return relationship_failures(df, check.column, tables[check.to_table], check.to_column)
    raise ValueError(f"Unknown check kind: {check.kind}")


# --- the catalog ------------------------------------------------------------

def _grain_tables(prefix: str) -> dict[str, tuple[str, ...]]:
    return {f"{prefix}_{suffix}": (grain,) for grain, suffix in (("day", "daily"), ("week", "weekly"), ("month", "monthly"))}


def default_checks() -> list[Check]:
    """The checks declared on every table, built from rules per table family."""
    checks: list[Check] = [
        Check("dim_user", "user_id", "unique"),
        *[Check("dim_user", c, "not_null") for c in ("user_id", "first_seen_ts", "last_seen_ts")],
        Check("fct_events", "user_id", "not_null"),
        Check("fct_events", "user_id", "relationships", to_table="dim_user", to_column="user_id"),
        *[Check("fct_events", c, "not_null") for c in ("event_ts", "event_date", "event_type")],
        Check("fct_events", "event_type", "accepted_values", EVENT_TYPES),
        Check("fct_events", "engagement_bucket", "not_null"),
        Check("fct_events", "engagement_bucket", "accepted_values", BUCKETS),
    ]
    panel_keys = ("user_id", "period_start", "period_grain", "engagement_type", "growth_status")

    def panel(table: str, grains: tuple[str, ...], customer: bool) -> list[Check]:
        out = []
        for c in panel_keys:
            out.append(Check(table, c, "not_null"))
            if c == "period_grain":
                out.append(Check(table, c, "accepted_values", grains))
            elif c == "engagement_type":
                out.append(Check(table, c, "accepted_values", ENGAGEMENT_TYPES))
            elif c == "growth_status":
                out.append(Check(table, c, "accepted_values", GROWTH_STATUSES))
        if customer:
            out.append(Check(table, "customer_status", "accepted_values", CUSTOMER_STATUSES))
        return out

    for table, grains in _grain_tables("fct_growth_user_features").items():
        checks += panel(table, grains, customer=False)
    for table, grains in _grain_tables("int_user_features").items():
        checks += [Check(table, c, "not_null") for c in ("reporting_date", "user_id", "period_grain")]
        checks += [
            Check(table, "period_grain", "accepted_values", grains),
            Check(table, "user_type", "accepted_values", USER_TYPES),
        ]
    for table, grains in _grain_tables("int_user_growth_status").items():
        checks += panel(table, grains, customer=True)
    checks += panel("fct_growth_user_features_combined", ("day", "week", "month"), customer=False)
    checks += [
        Check("fct_user_features_performance", "reporting_date", "not_null"),
        Check("fct_user_features_performance", "period_grain", "not_null"),
        Check("fct_user_features_performance", "period_grain", "accepted_values", ("day", "week", "month")),
        Check("fct_user_features_performance", "user_type", "accepted_values", USER_TYPES),
    ]
    for table, grains in (
        ("fct_cohort_retention_combined", ("week", "month")),
        ("fct_cohort_retention_monthly", ("month",)),
        ("fct_cohort_retention_weekly", ("week",)),
    ):
        for c in ("cohort_period", "period_number", "engagement_type", "period_grain"):
            checks.append(Check(table, c, "not_null"))
            if c == "engagement_type":
                checks.append(Check(table, c, "accepted_values", ENGAGEMENT_TYPES))
            elif c == "period_grain":
                checks.append(Check(table, c, "accepted_values", grains))
    return checks


# --- runner -----------------------------------------------------------------


@dataclass(frozen=True)
class Slice:
    """A table that is part of the rows of ``base``. The checks of all slices of
    one base are counted together, in one pass over it."""

    base: DataFrame
    where: Column | None = None

    @property
    def rows(self) -> DataFrame:
        return self.base if self.where is None else self.base.where(self.where)


def grain_slices(base: DataFrame, column: str = "period_grain", grains: Sequence[str] = GRAINS) -> Callable[..., Slice]:
    """Tables of one grain each out of a base with several: ``slices("week")``;
    ``slices()`` is all of it. Rows of no known grain are in every slice, so that
    a check of the grain finds them."""

    def of(grain: str | None = None) -> Slice:
        if grain is None:
            return Slice(base)
        return Slice(base, ~F.coalesce(F.col(column).isin(*[g for g in grains if g != grain]), F.lit(False)))

    return of


def _failing(ch: Check, where: Column | None = None) -> Column:
    """Number of rows that fail a not_null or accepted_values check."""
    c = F.col(ch.column)
    bad = c.isNull() if ch.kind == "not_null" else (c.isNotNull() & ~c.isin(*ch.values))
    bad = bad if where is None else bad & where
    return F.coalesce(F.sum(F.when(bad, F.lit(1)).otherwise(F.lit(0))), F.lit(0)).cast("bigint")


def row_checks(table: str, checks: Sequence[Check] | None = None) -> dict[str, tuple[Check, Column]]:
    """name -> (check, failing rows as an aggregate): the checks of one table
    that need its rows alone, for a write to measure on its way."""
    chosen = [c for c in (checks or default_checks()) if c.table == table and c.kind in ("not_null", "accepted_values")]
    return {f"_c{i}": (c, _failing(c).alias(f"_c{i}")) for i, c in enumerate(chosen)}


def _row_level_counts(base: DataFrame, checks: list[tuple[Check, Column | None]]) -> DataFrame:
    """not_null and accepted_values checks of the slices of one base in a single scan."""
    wide = base.agg(*[_failing(ch, where).alias(f"_c{i}") for i, (ch, where) in enumerate(checks)])
    cells = F.array(
        *[
            F.struct(
                F.lit(ch.table).alias("table_name"),
                F.lit(ch.column).alias("column_name"),
                F.lit(ch.kind).alias("check_name"),
                F.coalesce(F.col(f"_c{i}"), F.lit(0).cast("bigint")).alias("failing_rows"),
            )
            for i, (ch, _) in enumerate(checks)
        ]
    )
    return wide.select(F.inline(cells))


def _count_as_row(ch: Check, rows: DataFrame) -> DataFrame:
    return rows.agg(F.count(F.lit(1)).cast("bigint").alias("failing_rows")).select(
        F.lit(ch.table).alias("table_name"),
        F.lit(ch.column).alias("column_name"),
        F.lit(ch.kind).alias("check_name"),
        "failing_rows",
    )


def _unique_count(ch: Check, df: DataFrame) -> DataFrame:
    """Rows whose value is repeated, counted from the group sizes (no join
    back to the table)."""
    groups = df.filter(F.col(ch.column).isNotNull()).groupBy(ch.column).agg(F.count(F.lit(1)).alias("_n"))
    total = groups.filter(F.col("_n") > 1).agg(F.coalesce(F.sum("_n"), F.lit(0)).cast("bigint").alias("failing_rows"))
    return total.select(
        F.lit(ch.table).alias("table_name"),
        F.lit(ch.column).alias("column_name"),
        F.lit(ch.kind).alias("check_name"),
        "failing_rows",
    )


def run_checks(tables: Mapping[str, DataFrame | Slice], checks: Sequence[Check] | None = None) -> DataFrame:
    """(table_name, column_name, check_name, failing_rows) for every check
    whose table is given. ``failing_rows`` counts the rows the check's
    failing-row query returns.

    Each table, or base of several slices, is read once for its NULL /
    accepted-value checks, once per uniqueness check and once per relationship.
    Pass materialized tables, as ``python -m growthloom test`` does. A table
    given as an unmaterialized plan is recomputed by each of those reads.
    """
    chosen = [c for c in (checks or default_checks()) if c.table in tables and (c.to_table is None or c.to_table in tables)]
    slices = {name: t if isinstance(t, Slice) else Slice(t) for name, t in tables.items()}
    frames = {name: s.rows for name, s in slices.items() if any(name in (c.table, c.to_table) and c.kind in ("unique", "relationships") for c in chosen)}
    parts: list[DataFrame] = []
    by_base: dict[int, list[tuple[Check, Column | None]]] = {}
    for ch in chosen:
        if ch.kind in ("not_null", "accepted_values"):
            by_base.setdefault(id(slices[ch.table].base), []).append((ch, slices[ch.table].where))
        elif ch.kind == "unique":
            parts.append(_unique_count(ch, frames[ch.table]))
        else:
            parts.append(_count_as_row(ch, failures(ch, frames)))
    bases = {id(s.base): s.base for s in slices.values()}
    for base, group in by_base.items():
        parts.insert(0, _row_level_counts(bases[base], group))
    if not parts:
        raise ValueError("No check applies to the given tables")
    return reduce(DataFrame.unionByName, parts)


# --- column contracts -------------------------------------------------------

@dataclass
class ContractResult:
    missing: list[str] = field(default_factory=list)  # declared, not produced
    undeclared: list[str] = field(default_factory=list)  # produced, not declared
    out_of_order: bool = False

    @property
    def ok(self) -> bool:
        return not self.missing and not self.undeclared and not self.out_of_order


def column_contract(df: DataFrame, declared: Sequence[str]) -> ContractResult:
    """Compare a DataFrame's columns with its declared contract (schema only,
    no data is read)."""
    actual = list(df.columns)
    res = ContractResult(
        missing=[c for c in declared if c not in actual],
        undeclared=[c for c in actual if c not in declared],
    )
    common = [c for c in actual if c in declared]
    res.out_of_order = common != [c for c in declared if c in actual]
    return res
