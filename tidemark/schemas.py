"""Wire fields, table schemas and limits of the order-event model."""

from __future__ import annotations

from pyspark.sql import types as T

# Event types and their partition-key field on the wire.
USER_CREATED = "UserCreated"
ORDER_PLACED = "OrderPlaced"
PAYMENT_SETTLED = "PaymentSettled"
INVENTORY_ADJUSTED = "InventoryAdjusted"
EVENT_TYPES = (USER_CREATED, ORDER_PLACED, PAYMENT_SETTLED, INVENTORY_ADJUSTED)
PARTITION_KEYS = {
    USER_CREATED: "userId",
    ORDER_PLACED: "orderId",
    PAYMENT_SETTLED: "orderId",
    INVENTORY_ADJUSTED: "sku",
}

# Wire fields per event type, (json name, column name, kind).
ENVELOPE_FIELDS = (
    ("eventId", "event_id", "string"),
    ("eventType", "event_type", "string"),
    ("timestamp", "event_time", "time"),
)
BODY_FIELDS = {
    USER_CREATED: (
        ("userId", "user_id", "string"),
        ("email", "email", "string"),
        ("firstName", "first_name", "string"),
        ("lastName", "last_name", "string"),
        ("createdAt", "created_at", "time"),
    ),
    ORDER_PLACED: (
        ("orderId", "order_id", "string"),
        ("userId", "user_id", "string"),
        ("totalAmount", "total_amount", "double"),
        ("currency", "currency", "string"),
        ("items", "items", "items"),
        ("placedAt", "placed_at", "time"),
    ),
    PAYMENT_SETTLED: (
        ("paymentId", "payment_id", "string"),
        ("orderId", "order_id", "string"),
        ("amount", "amount", "double"),
        ("currency", "currency", "string"),
        ("paymentMethod", "payment_method", "string"),
        ("status", "status", "string"),
        ("settledAt", "settled_at", "time"),
    ),
    INVENTORY_ADJUSTED: (
        ("sku", "sku", "string"),
        ("quantity", "quantity", "int"),
        ("adjustmentType", "adjustment_type", "string"),
        ("reason", "reason", "string"),
        ("adjustedAt", "adjusted_at", "time"),
    ),
}
ITEM_FIELDS = (("sku", "sku", "string"), ("quantity", "quantity", "int"), ("price", "price", "double"))

#: Column holding the decoded body of each event type in parsed output.
BODY_COLUMNS = {
    USER_CREATED: "user_body",
    ORDER_PLACED: "order_body",
    PAYMENT_SETTLED: "payment_body",
    INVENTORY_ADJUSTED: "stock_body",
}

# Column length limits, in characters.
LENGTH_LIMITS = {
    "user_id": 36,
    "email": 255,
    "first_name": 100,
    "last_name": 100,
    "order_id": 36,
    "payment_id": 36,
    "currency": 3,
    "payment_method": 50,
    "status": 20,
    "sku": 50,
}

MONEY = T.DecimalType(10, 2)
INT_MIN, INT_MAX = -(2**31), 2**31 - 1

#: Value a missing time field takes.
ZERO_TIME = "0001-01-01T00:00:00Z"


_STRING, _INT, _LONG, _TIME = T.StringType(), T.IntegerType(), T.LongType(), T.TimestampType()


def _schema(**fields: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, dtype) for name, dtype in fields.items()])


USERS = _schema(
    user_id=_STRING, email=_STRING, first_name=_STRING, last_name=_STRING, created_at=_TIME, updated_at=_TIME
)
ORDERS = _schema(
    order_id=_STRING, user_id=_STRING, total_amount=MONEY, currency=_STRING, placed_at=_TIME, updated_at=_TIME
)
ORDER_ITEMS = _schema(order_id=_STRING, pos=_INT, sku=_STRING, quantity=_INT, price=MONEY)
PAYMENTS = _schema(
    payment_id=_STRING,
    order_id=_STRING,
    amount=MONEY,
    currency=_STRING,
    payment_method=_STRING,
    status=_STRING,
    settled_at=_TIME,
    updated_at=_TIME,
)
INVENTORY = _schema(sku=_STRING, quantity=_INT, updated_at=_TIME)

TABLES = {
    "users": USERS,
    "orders": ORDERS,
    "order_items": ORDER_ITEMS,
    "payments": PAYMENTS,
    "inventory": INVENTORY,
}
#: Key each table is bucketed by; items travel with their order.
TABLE_KEYS = {
    "users": "user_id",
    "orders": "order_id",
    "order_items": "order_id",
    "payments": "payment_id",
    "inventory": "sku",
}

DEAD_LETTERS = _schema(
    batch_id=_LONG,
    partition=_INT,
    offset=_LONG,
    event_id=_STRING,
    original_data=_STRING,
    error=_STRING,
    error_class=_STRING,
    timestamp=_TIME,
    retry_count=_INT,
)

TOPIC = _schema(key=_STRING, value=_STRING, topic=_STRING, partition=_INT, offset=_LONG, timestamp=_TIME)

LOG_LINE = _schema(
    level=_STRING,
    msg=_STRING,
    eventId=_STRING,
    eventType=_STRING,
    partition=_INT,
    offset=_LONG,
    error=_STRING,
    time=_TIME,
)
