"""Operational reports over the entity tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.scalars import full_name, trimmed_length


def table_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """One labelled count per table."""
    counts = [df.agg(F.lit(name).alias("table_name"), F.count(F.lit(1)).alias("rows")) for name, df in tables.items()]
    union = counts[0]
    for other in counts[1:]:
        union = union.unionByName(other)
    return union


def table_counts_row(tables: dict[str, DataFrame]) -> DataFrame:
    """All counts in one row, one column per table."""
    counts = table_counts(tables)
    return counts.agg(*[F.sum(F.when(F.col("table_name") == name, F.col("rows"))).alias(name) for name in tables])


def key_count(df: DataFrame, key: str, value) -> DataFrame:
    """How many rows a key has."""
    return df.filter(F.col(key) == value).agg(F.count(F.lit(1)).alias("rows"))


def orders_per_user(users: DataFrame, orders: DataFrame) -> DataFrame:
    """Order count of every user, zero included. Orders are counted before the join."""
    counts = orders.groupBy("user_id").agg(F.count("order_id").alias("order_count"))
    return (
        users.select("user_id", "email")
        .join(counts, "user_id", "left")
        .withColumn("order_count", F.coalesce("order_count", F.lit(0)))
    )


def name_length_stats(users: DataFrame) -> DataFrame:
    length = trimmed_length(F.col("first_name"))
    return users.agg(F.min(length).alias("min_length"), F.max(length).alias("max_length"))


def largest_amount(orders: DataFrame) -> DataFrame:
    return orders.agg(F.max("total_amount").alias("max_total_amount"))


def balance_range(inventory: DataFrame) -> DataFrame:
    return inventory.agg(F.min("quantity").alias("min_quantity"), F.max("quantity").alias("max_quantity"))


def longest_names(users: DataFrame, n: int = 3) -> DataFrame:
    length = trimmed_length(F.col("first_name"))
    return (
        users.select("user_id", "email", length.alias("name_length"))
        .orderBy(F.col("name_length").desc(), "user_id")
        .limit(n)
    )


def recent_full_names(users: DataFrame, n: int = 3) -> DataFrame:
    name = full_name(F.col("first_name"), F.col("last_name"))
    return (
        users.select("user_id", "email", name.alias("name"), "created_at")
        .orderBy(F.col("created_at").desc(), "user_id")
        .limit(n)
        .drop("created_at")
    )


def recent_rows(df: DataFrame, time: str, key: str, n: int = 5) -> DataFrame:
    """The ``n`` newest rows of a table; ties by key."""
    return df.orderBy(F.col(time).desc(), key).limit(n)


def first_items(items: DataFrame, n: int = 10) -> DataFrame:
    """A few order items; ordered by all columns so that the choice is stable."""
    return items.orderBy("order_id", "pos", "sku", "quantity", "price").limit(n)


def orders_with_payments(orders: DataFrame, payments: DataFrame) -> DataFrame:
    """Every order with each of its payments, null payment columns when there is none.

    Written as the matches plus the unpaid orders: an order with very many payments then is a skewed
    side of an inner join, which adaptive execution splits, as it could not under an outer join.
    """
    left = orders.select("order_id", "total_amount", "placed_at")
    right = payments.select("order_id", "payment_id", "status")
    matched = right.join(left, "order_id")
    unpaid = left.join(right.select("order_id").distinct(), "order_id", "left_anti")
    return matched.unionByName(unpaid, allowMissingColumns=True)


def orders_payments_sorted(orders: DataFrame, payments: DataFrame) -> DataFrame:
    rows = orders_with_payments(orders, payments)
    return rows.select("order_id", "total_amount", "payment_id", "status", "placed_at").orderBy(
        F.col("placed_at").desc(), "order_id", "payment_id"
    )


def newest_first(df: DataFrame, time: str, key: str) -> DataFrame:
    """A whole table by time, newest first; ties by key."""
    return df.orderBy(F.col(time).desc(), key)
