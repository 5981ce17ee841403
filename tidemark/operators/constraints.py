"""Row constraints of the entity tables, as error expressions and parent checks.

Each ``*_errors`` function adds ``error`` and ``error_class`` (null when the row is fine). Nothing is
truncated or clamped to make it fit.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark import schemas as S

# The beginnings of the errors, here and in the functions below.
TOO_LONG = "String or binary data would be truncated in column "
OUT_OF_RANGE = "Arithmetic overflow error in column "


def money(value: Column) -> Column:
    """``DECIMAL(10,2)`` value of a double, null when it does not fit."""
    return value.try_cast(S.MONEY)


def in_int_range(value: Column) -> Column:
    return value.between(S.INT_MIN, S.INT_MAX)


def _too_long(columns: list[str]) -> Column:
    checks = [F.when(F.length(c) > S.LENGTH_LIMITS[c], F.lit(c)) for c in columns]
    return F.coalesce(*checks)


def _with_reason(df: DataFrame, prefix: str, long_column: Column, bad_number: Column) -> DataFrame:
    reason = F.when(long_column.isNotNull(), F.concat(F.lit(prefix + TOO_LONG), long_column)).when(
        bad_number.isNotNull(), F.concat(F.lit(prefix + OUT_OF_RANGE), bad_number)
    )
    cause = F.when(long_column.isNotNull(), F.lit("length")).when(bad_number.isNotNull(), F.lit("numeric"))
    return df.withColumns({"error": reason, "error_class": cause})


def user_errors(users: DataFrame) -> DataFrame:
    none = F.lit(None).cast("string")
    return _with_reason(
        users, "failed to upsert user: ", _too_long(["user_id", "email", "first_name", "last_name"]), none
    )


def order_errors(orders: DataFrame) -> DataFrame:
    """Errors of the order row itself; items are judged by :func:`item_errors`."""
    number = F.when(money(F.col("total_amount")).isNull(), F.lit("total_amount"))
    return _with_reason(orders, "failed to upsert order: ", _too_long(["order_id", "user_id", "currency"]), number)


def item_errors(orders: DataFrame) -> DataFrame:
    """Add ``item_error`` and ``item_error_class``: one bad item rejects the whole order."""
    prefix = "failed to insert order item: "
    long_sku = F.exists("items", lambda i: F.length(i["sku"]) > S.LENGTH_LIMITS["sku"])
    bad_number = F.exists("items", lambda i: ~in_int_range(i["quantity"]) | money(i["price"]).isNull())
    error = F.when(long_sku, F.lit(f"{prefix}{TOO_LONG}sku")).when(
        bad_number, F.lit(f"{prefix}{OUT_OF_RANGE}quantity or price")
    )
    return orders.withColumns(
        {
            "item_error": error,
            "item_error_class": F.when(long_sku, F.lit("length")).when(bad_number, F.lit("numeric")),
        }
    )


def payment_errors(payments: DataFrame) -> DataFrame:
    number = F.when(money(F.col("amount")).isNull(), F.lit("amount"))
    return _with_reason(
        payments,
        "failed to upsert payment: ",
        _too_long(["payment_id", "order_id", "currency", "payment_method", "status"]),
        number,
    )


def stock_errors(stock: DataFrame) -> DataFrame:
    """Errors a stock movement has by itself: a long sku, or a delta no balance could absorb.

    ``delta`` must be present. Whether the balance stays in range depends on the other movements and
    is decided by :mod:`tidemark.operators.stock`.
    """
    widest = S.INT_MAX - S.INT_MIN
    hopeless = F.col("delta").isNull() | ~F.col("delta").between(-widest, widest)
    return _with_reason(
        stock, "failed to upsert inventory: ", _too_long(["sku"]), F.when(hopeless, F.lit("quantity"))
    )


def parent_exists(
    children: DataFrame, accepted_parents: DataFrame, stored_parents: DataFrame, key: str, out: str = "has_parent"
) -> DataFrame:
    """Add a flag: does the parent row exist when the child message is handled?

    A parent exists if it is stored already, or if its first accepted message comes before the child.
    Parents are reduced to one row per key before the join, so only children can be skewed, and those
    are the side adaptive execution may split. Of the stored table only referenced keys are kept.
    """
    referenced = children.select(key).distinct()
    first = accepted_parents.groupBy(key).agg(F.min("seq").alias("_first_seq"))
    stored = stored_parents.select(key).join(referenced, key, "left_semi").withColumn("_stored", F.lit(True))
    known = first.join(stored, key, "full_outer")
    return (
        children.join(known, key, "left")
        .withColumn(out, F.coalesce(F.col("_stored"), F.col("_first_seq") < F.col("seq"), F.lit(False)))
        .drop("_stored", "_first_seq")
    )
