"""Settle a set of topic messages against the stored tables: accept, reject with reason, merge."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark import schemas as S
from tidemark.operators import constraints as C
from tidemark.operators import merge as M
from tidemark.operators.email_claims import refused_claims
from tidemark.operators.parse import MESSAGE_COLUMNS, judged_columns, parse_events, route, unroutable, with_lane
from tidemark.operators.stock import refused_moves, replayed_deliveries
from tidemark.session import staged

# The beginnings of the errors.
_NO_USER = "failed to upsert order: FOREIGN KEY conflict in column user_id"
_NO_ORDER = "failed to upsert payment: FOREIGN KEY conflict in column order_id"
_EMAIL_TAKEN = "failed to upsert user: UNIQUE KEY violation in column email"
_BALANCE = f"failed to upsert inventory: {C.OUT_OF_RANGE}quantity"


@dataclass(frozen=True)
class Verdicts:
    """Accepted and rejected events of one entity; rejected ones keep their message text and the reason.

    ``suppressed`` are repeated deliveries that change nothing, if those are looked for.
    """

    accepted: DataFrame
    rejected: DataFrame
    suppressed: DataFrame | None = None


def _rejects(df: DataFrame, error: Column | None = None, cause: Column | None = None) -> DataFrame:
    if error is not None:
        df = df.withColumns({"error": error, "error_class": cause})
    return df.select(*[c for c in MESSAGE_COLUMNS if c in df.columns], "error", "error_class")


def _split(checked: DataFrame, path: str | None) -> Verdicts:
    """Accepted and rejected rows of a judged table, which is written once for all its readers.

    The text of accepted messages is not needed any more and not written again.
    """
    return _by_verdict(staged(_with_needed_text(checked), path=path))


def _with_needed_text(checked: DataFrame) -> DataFrame:
    if "value" not in checked.columns:
        return checked
    return checked.withColumn("value", F.when(F.col("error").isNotNull(), F.col("value")))


def _by_verdict(checked: DataFrame) -> Verdicts:
    return Verdicts(
        checked.filter("error IS NULL").drop("error", "error_class"), _rejects(checked.filter("error IS NOT NULL"))
    )


def _with_refusals(checked: DataFrame, refused: DataFrame, error: str, cause: str) -> DataFrame:
    """Judged rows of which those in ``refused(seq)`` fail as well."""
    lost = checked.join(refused.withColumn("_lost", F.lit(True)), "seq", "left")
    return lost.withColumns(
        {
            "error": F.coalesce("error", F.when(F.col("_lost"), F.lit(error))),
            "error_class": F.coalesce("error_class", F.when(F.col("_lost"), F.lit(cause))),
        }
    ).drop("_lost")


def _sound(checked: DataFrame) -> DataFrame:
    return checked.filter("error IS NULL").drop("error", "error_class")


def settle_users(users: DataFrame, stored_users: DataFrame, path: str | None = None) -> Verdicts:
    """Length limits, then email uniqueness in log order."""
    checked = C.user_errors(users)
    claims = _sound(checked).select("seq", "user_id", "email")
    refused = refused_claims(claims, stored_users.select("user_id", "email"))
    return _split(_with_refusals(checked, refused, _EMAIL_TAKEN, "unique"), path)


def settle_orders(
    orders: DataFrame, accepted_users: DataFrame, stored_users: DataFrame, path: str | None = None
) -> Verdicts:
    """Row limits, then the user must exist, then every item must be sound; all or nothing."""
    checked = C.item_errors(C.order_errors(orders))
    checked = C.parent_exists(checked, accepted_users, stored_users, "user_id")
    orphan = ~F.col("has_parent")
    checked = checked.withColumns(
        {
            "error": F.coalesce("error", F.when(orphan, F.lit(_NO_USER)), "item_error"),
            "error_class": F.coalesce("error_class", F.when(orphan, F.lit("foreign_key")), "item_error_class"),
        }
    )
    return _split(checked.drop("item_error", "item_error_class", "has_parent"), path)


def settle_payments(
    payments: DataFrame, accepted_orders: DataFrame, stored_orders: DataFrame, path: str | None = None
) -> Verdicts:
    """Row limits, then the order must exist."""
    checked = C.parent_exists(C.payment_errors(payments), accepted_orders, stored_orders, "order_id")
    orphan = ~F.col("has_parent")
    checked = checked.withColumns(
        {
            "error": F.coalesce("error", F.when(orphan, F.lit(_NO_ORDER))),
            "error_class": F.coalesce("error_class", F.when(orphan, F.lit("foreign_key"))),
        }
    )
    return _split(checked.drop("has_parent"), path)


def settle_stock(
    stock: DataFrame,
    stored_inventory: DataFrame,
    dedupe_event_id: bool = False,
    seen: DataFrame | None = None,
    path: str | None = None,
) -> Verdicts:
    """Row limits, then the running balance must stay in range. If it always does, the row limits alone tell the verdicts
    and ``stock``, which should be a written table, is read for them without another copy.

    With ``dedupe_event_id`` an event id moves its sku once: deliveries after the accepted one are suppressed, those
    after a refused one are tried again. ``seen`` holds the ids accepted in earlier batches.
    """
    checked = C.stock_errors(M.with_delta(stock))
    balances = stored_inventory.select("sku", "quantity")
    if not dedupe_event_id:
        refused = refused_moves(_sound(checked).select("seq", "sku", "delta"), balances)
        if refused.isEmpty():
            return _by_verdict(_with_needed_text(checked))
        return _split(_with_refusals(checked, refused, _BALANCE, "numeric"), path)
    sound = staged(_sound(checked))
    known = sound if seen is None else sound.join(seen.select("event_id").filter("event_id <> ''").distinct(), "event_id", "left_anti")
    known = staged(known)
    tried = M.first_deliveries(known)
    refused = staged(refused_moves(tried.select("seq", "sku", "delta"), balances))
    # A refused delivery makes room for the next one of its id; what follows it on its sku is settled in one ordered replay.
    failed = tried.join(refused, "seq", "left_semi").filter("event_id <> ''").select("event_id", "sku", F.col("seq").alias("_failed"))
    again = staged(known.join(failed, ["event_id", "sku"]).filter("seq > _failed").select("sku").distinct())
    if not again.isEmpty():
        replayed = staged(replayed_deliveries(known.join(again, "sku", "left_semi"), balances))
        others = tried.join(again, "sku", "left_anti")
        refused = others.join(refused, "seq", "left_semi").select("seq").union(replayed.filter("NOT accepted").select("seq"))
        tried = others.unionByName(known.join(replayed, "seq", "left_semi"))
    verdicts = _split(_with_refusals(checked, refused, _BALANCE, "numeric"), path)
    accepted = staged(tried.join(refused, "seq", "left_anti"))
    suppressed = verdicts.accepted.join(accepted.select("seq"), "seq", "left_anti")
    return Verdicts(accepted, verdicts.rejected, suppressed)


@dataclass(frozen=True)
class Settlement:
    """Outcome of a set of messages."""

    parsed: DataFrame
    users: Verdicts
    orders: Verdicts
    payments: Verdicts
    stock: Verdicts

    def rejected(self) -> DataFrame:
        """Every failed message with ``event_id, event_type, value, error, error_class, counted``.

        The message text travels with the events that are judged, so nothing is joined back to the log.
        """
        failed = unroutable(self.parsed)
        failed = failed.select(
            *[c for c in MESSAGE_COLUMNS if c in failed.columns], "error", "error_class", "event_type", "counted"
        )
        for event_type, verdict in self._by_type():
            failed = failed.unionByName(
                verdict.rejected.withColumns({"event_type": F.lit(event_type), "counted": F.lit(True)})
            )
        return failed

    def _by_type(self) -> list[tuple[str, Verdicts]]:
        return list(zip(S.EVENT_TYPES, (self.users, self.orders, self.payments, self.stock)))

    def merged(self, stored: dict[str, DataFrame], now: Column | datetime) -> dict[str, DataFrame]:
        """New contents of the five tables."""
        return {
            "users": M.merge_users(stored["users"], self.users.accepted, now),
            "orders": M.merge_orders(stored["orders"], self.orders.accepted, now),
            "order_items": M.replace_items(stored["order_items"], self.orders.accepted),
            "payments": M.merge_payments(stored["payments"], self.payments.accepted, now),
            "inventory": M.merge_inventory(stored["inventory"], self.stock.accepted, now),
        }

    def outcomes(self) -> DataFrame:
        """``event_type, status, seq`` of every message that reached routing (one row per message)."""
        rows = self.rejected().filter("counted").select("event_type", F.lit("error").alias("status"), "seq")
        for event_type, verdict in self._by_type():
            for status, events in (("success", verdict.accepted), ("suppressed", verdict.suppressed)):
                if events is not None:
                    rows = rows.unionByName(events.select(F.lit(event_type).alias("event_type"), F.lit(status).alias("status"), "seq"))
        return rows


def settle(log: DataFrame, stored: dict[str, DataFrame], dedupe_event_id: bool = False) -> Settlement:
    """Decide every message of a log with columns ``value`` and ``seq`` against the stored tables."""
    parsed = staged(judged_columns(with_lane(parse_events(log))))
    return settle_parsed(parsed, stored, dedupe_event_id)


def settle_parsed(
    parsed: DataFrame,
    stored: dict[str, DataFrame],
    dedupe_event_id: bool = False,
    work: str | None = None,
    seen: DataFrame | None = None,
    holders: DataFrame | None = None,
) -> Settlement:
    """Decide parsed messages; ``work`` is a folder whose previous intermediate tables are replaced.

    ``stored`` must hold the users, orders and skus that the messages refer to; ``holders`` the stored users of claimed
    addresses, if ``stored`` does not.
    """
    paths = {name: f"{work}/{name}" if work else None for name in ("users", "orders", "payments", "stock")}
    users = settle_users(route(parsed, S.USER_CREATED), stored["users"] if holders is None else holders, paths["users"])
    orders = settle_orders(route(parsed, S.ORDER_PLACED), users.accepted, stored["users"], paths["orders"])
    payments = settle_payments(route(parsed, S.PAYMENT_SETTLED), orders.accepted, stored["orders"], paths["payments"])
    stock = settle_stock(route(parsed, S.INVENTORY_ADJUSTED), stored["inventory"], dedupe_event_id, seen, paths["stock"])
    return Settlement(parsed, users, orders, payments, stock)
