"""Serving queries: a user with the latest orders, an order with its payment, recent users."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

DEFAULT_LIMIT = 5
MAX_LIMIT = 100

# Response field names.
USER_FIELDS = {
    "user_id": "userId",
    "email": "email",
    "first_name": "firstName",
    "last_name": "lastName",
    "created_at": "createdAt",
    "updated_at": "updatedAt",
    "orders": "orders",
}
ORDER_FIELDS = {
    "order_id": "orderId",
    "user_id": "userId",
    "total_amount": "totalAmount",
    "currency": "currency",
    "placed_at": "placedAt",
    "updated_at": "updatedAt",
    "payment": "payment",
}
PAYMENT_FIELDS = {
    "payment_id": "paymentId",
    "amount": "amount",
    "payment_method": "paymentMethod",
    "status": "status",
    "settled_at": "settledAt",
}
_ORDER_COLUMNS = [c for c in ORDER_FIELDS if c != "payment"]
_USER_COLUMNS = [c for c in USER_FIELDS if c != "orders"]


def only_ids(df: DataFrame, key: str, ids: Iterable[str] | DataFrame | None) -> DataFrame:
    """Point lookup by a few literal ids (pushed to the scan) or by a table of ids."""
    if ids is None:
        return df
    if isinstance(ids, DataFrame):
        return df.join(ids.select(key).distinct(), key, "left_semi")
    return df.filter(F.col(key).isin(*ids))


def latest_orders(orders: DataFrame, n: int = DEFAULT_LIMIT) -> DataFrame:
    """The ``n`` latest orders of each user with their ``rank``; ties by order id.

    The rank filter lets Spark cut each user to ``n`` rows before the shuffle.
    """
    newest = Window.partitionBy("user_id").orderBy(F.col("placed_at").desc(), F.col("order_id"))
    return orders.select(*_ORDER_COLUMNS).withColumn("rank", F.row_number().over(newest)).filter(F.col("rank") <= n)


def user_order_rows(
    users: DataFrame, orders: DataFrame, ids: Iterable[str] | DataFrame | None = None, n: int = DEFAULT_LIMIT
) -> DataFrame:
    """One row per user and latest order; users without orders have one row with null order columns."""
    chosen = only_ids(users.select(*_USER_COLUMNS), "user_id", ids)
    latest = latest_orders(only_ids(orders, "user_id", ids), n).withColumnRenamed("updated_at", "order_updated_at")
    return chosen.join(latest, "user_id", "left")


def user_with_orders(
    users: DataFrame, orders: DataFrame, ids: Iterable[str] | DataFrame | None = None, n: int = DEFAULT_LIMIT
) -> DataFrame:
    """One row per user with ``orders``, an array of at most ``n`` structs, newest first, empty if none."""
    latest = latest_orders(only_ids(orders, "user_id", ids), n)
    members = [F.col(c).cast("double").alias(c) if c == "total_amount" else F.col(c) for c in _ORDER_COLUMNS]
    gathered = latest.groupBy("user_id").agg(
        F.sort_array(F.collect_list(F.struct("rank", F.struct(*members).alias("order")))).alias("_ranked")
    )
    listed = F.transform("_ranked", lambda entry: entry["order"])
    return (
        only_ids(users.select(*_USER_COLUMNS), "user_id", ids)
        .join(gathered, "user_id", "left")
        .withColumn("orders", F.coalesce(listed, F.array()))
        .drop("_ranked")
    )


def leading_payment(payments: DataFrame) -> DataFrame:
    """One payment per order: the latest settled, ties by payment id."""
    first = Window.partitionBy("order_id").orderBy(F.col("settled_at").desc(), F.col("payment_id"))
    return (
        payments.select("order_id", *PAYMENT_FIELDS)
        .withColumn("_rank", F.row_number().over(first))
        .filter(F.col("_rank") == 1)
        .drop("_rank")
    )


def order_payment_rows(
    orders: DataFrame, payments: DataFrame, ids: Iterable[str] | DataFrame | None = None
) -> DataFrame:
    """One row per order with its leading payment's columns, null when there is none."""
    chosen = only_ids(orders.select(*_ORDER_COLUMNS), "order_id", ids)
    return chosen.join(leading_payment(only_ids(payments, "order_id", ids)), "order_id", "left")


def order_with_payment(
    orders: DataFrame, payments: DataFrame, ids: Iterable[str] | DataFrame | None = None
) -> DataFrame:
    """One row per order with a ``payment`` struct, null when no payment exists."""
    members = [F.col(c).cast("double").alias(c) if c == "amount" else F.col(c) for c in PAYMENT_FIELDS]
    payment = F.when(F.col("payment_id").isNotNull(), F.struct(*members))
    rows = order_payment_rows(orders, payments, ids).withColumn("payment", payment)
    return rows.withColumn("total_amount", F.col("total_amount").cast("double")).select(*ORDER_FIELDS)


def clamp_limit(limit: int | str | None) -> int:
    """Limits outside 1..100 and values that are no integer fall back to 5."""
    try:
        number = int(limit)
    except (TypeError, ValueError):
        return DEFAULT_LIMIT
    return number if 0 < number <= MAX_LIMIT else DEFAULT_LIMIT


def recent_users(users: DataFrame, limit: int | str | None = None) -> DataFrame:
    """The newest users by ``created_at``; ties by user id."""
    return users.select(*_USER_COLUMNS).orderBy(F.col("created_at").desc(), "user_id").limit(clamp_limit(limit))


def _renamed(value, names: dict[str, str]):
    return F.struct(*[value[old].alias(new) for old, new in names.items()])


def user_documents(found: DataFrame) -> DataFrame:
    """``(user_id, document)``: JSON of :func:`user_with_orders` rows in response naming."""
    order_fields = {c: ORDER_FIELDS[c] for c in _ORDER_COLUMNS}
    listed = F.transform("orders", lambda order: _renamed(order, order_fields))
    body = F.struct(*[(listed if c == "orders" else F.col(c)).alias(name) for c, name in USER_FIELDS.items()])
    return found.select("user_id", F.to_json(body, _JSON).alias("document"))


def order_documents(found: DataFrame) -> DataFrame:
    """``(order_id, document)``: JSON of :func:`order_with_payment` rows; ``payment`` is left out when null."""
    payment = F.when(F.col("payment").isNotNull(), _renamed(F.col("payment"), PAYMENT_FIELDS))
    body = F.struct(*[(payment if c == "payment" else F.col(c)).alias(name) for c, name in ORDER_FIELDS.items()])
    return found.select("order_id", F.to_json(body, _JSON).alias("document"))


_JSON = {"timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX"}
