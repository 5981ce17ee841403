"""Idempotent merges of accepted events into entity tables.

Each function takes the stored rows and a set of accepted events and returns the new rows. "Last" and
"first" are by ``seq``. Events are reduced to one row per key with partial aggregation before they
meet the stored table, so a key with many deliveries costs no more than a key with one. ``now`` is
the processing time written to ``updated_at``.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark import schemas as S
from tidemark.functions.scalars import signed_delta
from tidemark.operators.constraints import money


def _last(columns: list) -> Column:
    return F.max_by(F.struct(*columns), F.col("seq")).alias("_last")


def _fresh_or_stored(column: str) -> Column:
    return F.when(F.col("_last").isNotNull(), F.col(f"_last.{column}")).otherwise(F.col(column)).alias(column)


def _touched_now(now: Column | datetime) -> Column:
    return F.when(F.col("_last").isNotNull(), F.lit(now)).otherwise(F.col("updated_at")).alias("updated_at")


def merge_users(stored: DataFrame, accepted: DataFrame, now: Column | datetime) -> DataFrame:
    """Last email and names win; ``created_at`` stays that of the first accepted message."""
    fresh = accepted.groupBy("user_id").agg(
        _last(["email", "first_name", "last_name"]), F.min_by("created_at", "seq").alias("_created_at")
    )
    return stored.join(fresh, "user_id", "full_outer").select(
        "user_id",
        *[_fresh_or_stored(c) for c in ("email", "first_name", "last_name")],
        F.coalesce("created_at", "_created_at").alias("created_at"),
        _touched_now(now),
    )


def merge_orders(stored: DataFrame, accepted: DataFrame, now: Column | datetime) -> DataFrame:
    """Last user, amount and currency win; ``placed_at`` stays that of the first accepted message."""
    fresh = accepted.groupBy("order_id").agg(
        _last(["user_id", money(F.col("total_amount")).alias("total_amount"), "currency"]),
        F.min_by("placed_at", "seq").alias("_placed_at"),
    )
    return stored.join(fresh, "order_id", "full_outer").select(
        "order_id",
        *[_fresh_or_stored(c) for c in ("user_id", "total_amount", "currency")],
        F.coalesce("placed_at", "_placed_at").alias("placed_at"),
        _touched_now(now),
    )


def exploded_items(orders: DataFrame) -> DataFrame:
    """One row per item of each order; ``pos`` is the place in the array. Empty arrays give no row."""
    return orders.select("order_id", F.posexplode("items").alias("pos", "item")).select(
        "order_id",
        "pos",
        F.col("item.sku").alias("sku"),
        F.col("item.quantity").cast("int").alias("quantity"),
        money(F.col("item.price")).alias("price"),
    )


def replace_items(stored: DataFrame, accepted: DataFrame) -> DataFrame:
    """All items of a touched order are replaced by those of its last accepted message."""
    last = accepted.groupBy("order_id").agg(F.max_by("items", "seq").alias("items"))
    untouched = stored.join(accepted.select("order_id").distinct(), "order_id", "left_anti")
    return untouched.unionByName(exploded_items(last))


def merge_payments(stored: DataFrame, accepted: DataFrame, now: Column | datetime) -> DataFrame:
    """Every column follows the last accepted message."""
    columns = ["order_id", "amount", "currency", "payment_method", "status", "settled_at"]
    values = [money(F.col(c)).alias(c) if c == "amount" else F.col(c) for c in columns]
    fresh = accepted.groupBy("payment_id").agg(_last(values))
    return stored.join(fresh, "payment_id", "full_outer").select(
        "payment_id", *[_fresh_or_stored(c) for c in columns], _touched_now(now)
    )


def with_delta(stock: DataFrame) -> DataFrame:
    """Add the signed movement of each stock event."""
    return stock.withColumn("delta", signed_delta(F.col("quantity"), F.col("adjustment_type")))


def merge_inventory(stored: DataFrame, accepted: DataFrame, now: Column | datetime) -> DataFrame:
    """Balances move by the sum of accepted deltas; every delivered message counts."""
    fresh = accepted.groupBy("sku").agg(F.sum("delta").alias("_moved"))
    return stored.join(fresh, "sku", "full_outer").select(
        "sku",
        (F.coalesce(F.col("quantity"), F.lit(0)) + F.coalesce(F.col("_moved"), F.lit(0))).cast("int").alias("quantity"),
        F.when(F.col("_moved").isNotNull(), F.lit(now)).otherwise(F.col("updated_at")).alias("updated_at"),
    )


def first_deliveries(events: DataFrame) -> DataFrame:
    """Opt-in duplicate suppression: the earliest message of each ``event_id`` and sku.

    Messages without an id are no deliveries of each other and all stay.
    """
    named = events.filter("event_id <> ''")
    first = named.groupBy("event_id", "sku").agg(F.min("seq").alias("seq"))
    return named.join(first, ["event_id", "sku", "seq"], "left_semi").unionByName(events.filter("event_id = ''"))


def empty_tables(spark) -> dict[str, DataFrame]:
    return {name: spark.createDataFrame([], schema) for name, schema in S.TABLES.items()}
