"""Serving queries on the stored tables by id, reading only the buckets of the ids."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame

from tidemark.plans import serving as Q
from tidemark.streaming.tables import EntityTables


def _ids(tables: EntityTables, key: str, ids: Iterable[str] | DataFrame) -> DataFrame:
    if isinstance(ids, DataFrame):
        return ids.select(key)
    return tables.spark.createDataFrame([(i,) for i in ids], f"{key} STRING")


def user_with_orders(tables: EntityTables, ids: Iterable[str] | DataFrame) -> DataFrame:
    """The users of the ids with their latest orders."""
    wanted = _ids(tables, "user_id", ids)
    return Q.user_with_orders(tables.find("users", wanted), tables.find_by("user_orders", wanted))


def order_with_payment(tables: EntityTables, ids: Iterable[str] | DataFrame) -> DataFrame:
    """The orders of the ids with their payment."""
    wanted = _ids(tables, "order_id", ids)
    return Q.order_with_payment(tables.find("orders", wanted), tables.find_by("order_payments", wanted))
