"""Builders for event messages with fixed ids and times.

Fixed values: the field names and event types of the wire format.
"""

from __future__ import annotations

import json

T0 = "2025-10-20T10:00:00Z"


def _event(event_type, event_id, fields, **changes):
    body = {"eventId": event_id, "eventType": event_type, "timestamp": T0, **fields}
    body.update(changes)
    return body


def user(uid, email=None, event_id=None, **changes):
    return _event("UserCreated", event_id or f"ev-{uid}", {
        "userId": uid, "email": email if email is not None else f"{uid}@example.com",
        "firstName": "First", "lastName": "Last", "createdAt": T0}, **changes)


def order(oid, uid, items=(), **changes):
    return _event("OrderPlaced", f"ev-{oid}", {
        "orderId": oid, "userId": uid, "totalAmount": 100.0, "currency": "USD",
        "items": [dict(i) for i in items], "placedAt": T0}, **changes)


def item(sku="SKU-1", quantity=1, price=100.0):
    return {"sku": sku, "quantity": quantity, "price": price}


def payment(pid, oid, **changes):
    return _event("PaymentSettled", f"ev-{pid}", {
        "paymentId": pid, "orderId": oid, "amount": 100.0, "currency": "USD",
        "paymentMethod": "credit_card", "status": "completed", "settledAt": T0}, **changes)


def stock(sku, quantity, kind="add", **changes):
    return _event("InventoryAdjusted", f"ev-{sku}", {
        "sku": sku, "quantity": quantity, "adjustmentType": kind, "reason": "test", "adjustedAt": T0}, **changes)


def log(spark, messages, start=0):
    """A topic log; dict messages are encoded, strings are taken as they are."""
    rows = [
        (start + i, m if isinstance(m, str) else json.dumps(m, ensure_ascii=False)) for i, m in enumerate(messages)
    ]
    return spark.createDataFrame(rows, "seq bigint, value string")
