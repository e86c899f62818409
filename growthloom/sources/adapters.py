"""Adapters that turn the driver's tables into the raw event stream.

The pipeline's only input is a raw event table with the columns
``event_time, user_id, gender, event_type, transaction_category,
miles_amount, platform, utm_source, country``. Two adapters derive it from
the test tables: ``events`` (fine grained, one month) and ``orders`` (coarse,
several years). Both are row-wise maps plus a lookup join to the customer's
nation, so their cost grows linearly with the input.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from growthloom.sources.tables import read_table

RAW_COLUMNS = (
    "event_time", "user_id", "gender", "event_type", "transaction_category",
    "miles_amount", "platform", "utm_source", "country",
)

# The mappings of the test adapters.
EARNED_CATEGORIES = ("shopping", "dining", "e-commerce")  # by key % 3
REDEEMED_CATEGORIES = ("flight", "hotel")  # by key % 2
EVENTS_PLATFORMS = ("ios", "android", "web", None)  # by k % 4
EVENTS_UTM_SOURCES = ("facebook", "google", "referral", None, None)  # by k % 5
GENDERS = ("F", "M", None)  # by user_id % 3
EVENTS_TYPE_MAP = {"view": "like", "click": "share", "signup": "reward_search", "error": "error"}
ORDERS_TYPE_MAP = {
    "1-URGENT": "miles_earned",
    "2-HIGH": "miles_redeemed",
    "3-MEDIUM": "like",
    "4-NOT SPECIFIED": "share",
    "5-LOW": "reward_search",
}
ORDERS_PLATFORMS = {"O": "ios", "F": "android", "P": "web"}


def _pick(values: tuple, index: Column) -> Column:
    """``values[index]`` as a CASE expression (NULL entries give NULL)."""
    expr = None
    for i, v in enumerate(values):
        if v is None:
            continue
        expr = F.when(index == i, F.lit(v)) if expr is None else expr.when(index == i, F.lit(v))
    return expr.otherwise(F.lit(None).cast("string"))


def _map(mapping: dict, c: Column) -> Column:
    expr = None
    for k, v in mapping.items():
        expr = F.when(c == k, F.lit(v)) if expr is None else expr.when(c == k, F.lit(v))
    return expr.otherwise(F.lit(None).cast("string"))


def _miles(amount: Column) -> Column:
    return amount.cast("decimal(18,2)").cast("decimal(38,9)")


def _category(event_type: Column, key: Column) -> Column:
    return (
        F.when(event_type == "miles_earned", _pick(EARNED_CATEGORIES, key % 3))
        .when(event_type == "miles_redeemed", _pick(REDEEMED_CATEGORIES, key % 2))
        .otherwise(F.lit(None).cast("string"))
    )


def customer_country(customer: DataFrame, nation: DataFrame) -> DataFrame:
    """customer key -> nation name and market segment.

    ``nation`` is a fixed 25-row dimension; Spark broadcasts it on its own
    from the file size statistics, no hint is needed. The events then join
    this lookup on user_id as a sort-merge join (AQE may turn it into a
    broadcast once it has measured the lookup): the aggregates and windows
    keyed by user downstream reuse that partitioning instead of shuffling
    again, and AQE splits a hot user's partition.
    """
    return customer.select("c_custkey", "c_nationkey", "c_mktsegment").join(
        nation.select(F.col("n_nationkey").alias("c_nationkey"), F.col("n_name").alias("country")),
        "c_nationkey",
        "left",
    )


def events_to_raw(events: DataFrame, customer: DataFrame, nation: DataFrame) -> DataFrame:
    """Adapter A: ``events`` rows as raw events (day and week grains)."""
    k = F.get_json_object(F.col("props"), "$.k").cast("int")
    et = F.col("event_type")
    mapped_type = (
        F.when(et == "purchase", F.when(F.col("event_id") % 4 == 0, F.lit("miles_redeemed")).otherwise(F.lit("miles_earned")))
        .otherwise(_map(EVENTS_TYPE_MAP, et))
    )
    base = events.select(
        F.col("ts").alias("event_time"),
        "user_id",
        mapped_type.alias("event_type"),
        F.when(et == "purchase", _miles(F.col("value"))).alias("miles_amount"),
        k.alias("_k"),
    )
    users = customer_country(customer, nation).select(
        F.col("c_custkey").alias("user_id"), "country"
    )
    joined = base.join(users, "user_id", "left")
    return joined.select(
        "event_time",
        "user_id",
        _pick(GENDERS, F.col("user_id") % 3).alias("gender"),
        "event_type",
        _category(F.col("event_type"), F.col("_k")).alias("transaction_category"),
        "miles_amount",
        _pick(EVENTS_PLATFORMS, F.col("_k") % 4).alias("platform"),
        _pick(EVENTS_UTM_SOURCES, F.col("_k") % 5).alias("utm_source"),
        "country",
    )


def orders_to_raw(orders: DataFrame, customer: DataFrame, nation: DataFrame) -> DataFrame:
    """Adapter B: ``orders`` rows as raw events (week and month grains)."""
    mapped_type = _map(ORDERS_TYPE_MAP, F.col("o_orderpriority"))
    base = orders.select(
        F.col("o_orderdate").alias("event_time"),
        F.col("o_custkey").alias("user_id"),
        mapped_type.alias("event_type"),
        F.when(mapped_type.isin("miles_earned", "miles_redeemed"), _miles(F.col("o_totalprice"))).alias("miles_amount"),
        F.col("o_orderkey").alias("_key"),
        _map(ORDERS_PLATFORMS, F.col("o_orderstatus")).alias("platform"),
    )
    users = customer_country(customer, nation).select(
        F.col("c_custkey").alias("user_id"),
        "country",
        F.when(F.col("c_mktsegment") == "HOUSEHOLD", F.lit(None).cast("string"))
        .otherwise(F.col("c_mktsegment")).alias("utm_source"),
    )
    joined = base.join(users, "user_id", "left")
    return joined.select(
        "event_time",
        "user_id",
        _pick(GENDERS, F.col("user_id") % 3).alias("gender"),
        "event_type",
        _category(F.col("event_type"), F.col("_key")).alias("transaction_category"),
        "miles_amount",
        "platform",
        "utm_source",
        "country",
    )


def raw_events(spark: SparkSession, base_dir: str, source: str = "events") -> DataFrame:
    """Raw event stream from the test tables through adapter ``source``."""
    customer = read_table(spark, base_dir, "customer")
    nation = read_table(spark, base_dir, "nation")
    if source == "events":
        return events_to_raw(read_table(spark, base_dir, "events"), customer, nation)
    if source == "orders":
        return orders_to_raw(read_table(spark, base_dir, "orders"), customer, nation)
    raise ValueError(f"Unknown source: {source}")
