"""One-message-at-a-time reading of the ingest rules, used as brute force against the set-based plans."""

from __future__ import annotations

from decimal import ROUND_HALF_UP, Decimal

INT_MIN, INT_MAX = -(2**31), 2**31 - 1
LIMITS = {"userId": 36, "email": 255, "firstName": 100, "lastName": 100, "orderId": 36, "paymentId": 36,
          "currency": 3, "paymentMethod": 50, "status": 20, "sku": 50}


def money(value):
    cents = Decimal(repr(float(value))).quantize(Decimal("0.01"), rounding=ROUND_HALF_UP)
    return cents if abs(cents) < 10**8 else None


class Store:
    def __init__(self):
        self.users, self.orders, self.items, self.payments, self.inventory = {}, {}, {}, {}, {}
        self.rejected = []

    def _too_long(self, event, names):
        return any(len(event[n]) > LIMITS[n] for n in names)

    def handle(self, seq, event):
        cause = getattr(self, "on_" + event["eventType"])(event)
        if cause:
            self.rejected.append((seq, cause))

    def on_UserCreated(self, e):
        if self._too_long(e, ["userId", "email", "firstName", "lastName"]):
            return "length"
        if any(u["email"] == e["email"] for uid, u in self.users.items() if uid != e["userId"]):
            return "unique"
        row = self.users.setdefault(e["userId"], {"created_at": e["createdAt"]})
        row.update(email=e["email"], first_name=e["firstName"], last_name=e["lastName"])

    def on_OrderPlaced(self, e):
        if self._too_long(e, ["orderId", "userId", "currency"]):
            return "length"
        if money(e["totalAmount"]) is None:
            return "numeric"
        if e["userId"] not in self.users:
            return "foreign_key"
        if any(len(i["sku"]) > LIMITS["sku"] for i in e["items"]):
            return "length"
        if any(not INT_MIN <= i["quantity"] <= INT_MAX or money(i["price"]) is None for i in e["items"]):
            return "numeric"
        row = self.orders.setdefault(e["orderId"], {"placed_at": e["placedAt"]})
        row.update(user_id=e["userId"], total_amount=money(e["totalAmount"]), currency=e["currency"])
        self.items[e["orderId"]] = [(i["sku"], i["quantity"], money(i["price"])) for i in e["items"]]

    def on_PaymentSettled(self, e):
        if self._too_long(e, ["paymentId", "orderId", "currency", "paymentMethod", "status"]):
            return "length"
        if money(e["amount"]) is None:
            return "numeric"
        if e["orderId"] not in self.orders:
            return "foreign_key"
        self.payments[e["paymentId"]] = (e["orderId"], money(e["amount"]), e["status"], e["settledAt"])

    def on_InventoryAdjusted(self, e):
        if self._too_long(e, ["sku"]):
            return "length"
        delta = -e["quantity"] if e["adjustmentType"] == "subtract" else e["quantity"]
        balance = self.inventory.get(e["sku"], 0) + delta
        if not INT_MIN <= balance <= INT_MAX:
            return "numeric"
        self.inventory[e["sku"]] = balance
