import datetime as dt
import json
from decimal import Decimal

import pytest

from tidemark import schemas as S
from tidemark.plans import reports as R
from tidemark.plans import serving as Q

T0 = dt.datetime(2025, 10, 20, 10)


def at(days):
    return T0 + dt.timedelta(days=days)


@pytest.fixture(scope="module")
def tables(spark):
    users = [(f"u{i}", f"u{i}@x", ["Ann", "Bo  ", "Cleo"][i], "Lee", at(i), at(0)) for i in range(3)]
    orders = [(f"o{i}", "u0", Decimal("1.25") * (i + 1), "USD", at(i // 2), at(0)) for i in range(7)]
    orders.append(("z", "u1", Decimal("99999999.99"), "USD", at(9), at(0)))
    items = [("o0", 0, "A", 1, Decimal("1.00")), ("o0", 1, "B", 2, Decimal("2.00"))]
    payments = [
        ("p1", "o0", Decimal("1.25"), "USD", "card", "completed", at(1), at(0)),
        ("p2", "o0", Decimal("1.25"), "USD", "card", "refunded", at(2), at(0)),
        ("p3", "z", Decimal("5.00"), "USD", "cash", "completed", at(1), at(0)),
    ]
    inventory = [("A", 50, at(0)), ("B", -50, at(1))]
    rows = {"users": users, "orders": orders, "order_items": items, "payments": payments, "inventory": inventory}
    return {name: spark.createDataFrame(r, S.TABLES[name]) for name, r in rows.items()}


def test_user_with_orders(tables):
    found = {r["user_id"]: r for r in Q.user_with_orders(tables["users"], tables["orders"]).collect()}
    assert [o["order_id"] for o in found["u0"]["orders"]] == ["o6", "o4", "o5", "o2", "o3"]
    assert found["u1"]["orders"][0]["total_amount"] == 99999999.99
    assert found["u2"]["orders"] == []
    assert Q.user_with_orders(tables["users"], tables["orders"], ["nobody"]).count() == 0
    assert [r["user_id"] for r in Q.user_with_orders(tables["users"], tables["orders"], ["u1"]).collect()] == ["u1"]


def test_lookup_by_table_of_ids(spark, tables):
    ids = spark.createDataFrame([("u2",), ("u0",), ("u0",), ("x",)], "user_id string")
    rows = Q.user_order_rows(tables["users"], tables["orders"], ids).collect()
    assert sorted((r["user_id"], r["rank"]) for r in rows if r["rank"]) == [("u0", i) for i in range(1, 6)]
    assert [r["order_id"] for r in rows if r["user_id"] == "u2"] == [None]


def test_order_with_payment(tables):
    found = {r["order_id"]: r for r in Q.order_with_payment(tables["orders"], tables["payments"]).collect()}
    assert len(found) == 8
    assert found["o0"]["payment"].asDict() == {
        "payment_id": "p2", "amount": 1.25, "payment_method": "card", "status": "refunded", "settled_at": at(2)}
    assert found["o1"]["payment"] is None


def test_documents(tables):
    users = Q.user_documents(Q.user_with_orders(tables["users"], tables["orders"]))
    doc = json.loads(users.filter("user_id = 'u1'").first()["document"])
    assert list(doc) == ["userId", "email", "firstName", "lastName", "createdAt", "updatedAt", "orders"]
    assert list(doc["orders"][0]) == ["orderId", "userId", "totalAmount", "currency", "placedAt", "updatedAt"]
    assert doc["createdAt"].startswith("2025-10-21T10:00:00")
    assert json.loads(users.filter("user_id = 'u2'").first()["document"])["orders"] == []
    orders = Q.order_documents(Q.order_with_payment(tables["orders"], tables["payments"], ["o0", "o1"]))
    docs = {r["order_id"]: json.loads(r["document"]) for r in orders.collect()}
    assert set(docs["o0"]["payment"]) == {"paymentId", "amount", "paymentMethod", "status", "settledAt"}
    assert "payment" not in docs["o1"]


@pytest.mark.parametrize("asked,given", [(0, 5), (-1, 5), (101, 5), (100, 100), (7, 7), ("abc", 5), (None, 5), ("3", 3)])
def test_limit_clamp(asked, given):
    assert Q.clamp_limit(asked) == given


def test_recent_users(tables):
    assert [r["user_id"] for r in Q.recent_users(tables["users"], 2).collect()] == ["u2", "u1"]


def test_top_orders_cut_each_user_before_the_shuffle(tables):
    plan = Q.latest_orders(tables["orders"])._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2


def test_reports(tables):
    assert {r["user_id"]: r["order_count"] for r in R.orders_per_user(tables["users"], tables["orders"]).collect()} == {
        "u0": 7, "u1": 1, "u2": 0}
    assert R.name_length_stats(tables["users"]).first() == (2, 4)
    assert R.largest_amount(tables["orders"]).first()[0] == Decimal("99999999.99")
    assert R.balance_range(tables["inventory"]).first() == (-50, 50)
    assert [r["name_length"] for r in R.longest_names(tables["users"]).collect()] == [4, 3, 2]
    assert R.recent_full_names(tables["users"], 1).first()["name"] == "Cleo Lee"
    assert [r["order_id"] for r in R.recent_rows(tables["orders"], "placed_at", "order_id", 2).collect()] == ["z", "o6"]
    assert R.first_items(tables["order_items"]).count() == 2
    assert [r["sku"] for r in R.newest_first(tables["inventory"], "updated_at", "sku").collect()] == ["B", "A"]
    assert R.key_count(tables["orders"], "user_id", "u0").first()[0] == 7
    counts = {"Users": tables["users"], "Orders": tables["orders"], "Payments": tables["payments"]}
    assert {tuple(r) for r in R.table_counts(counts).collect()} == {("Users", 3), ("Orders", 8), ("Payments", 3)}
    assert R.table_counts_row(counts).first().asDict() == {"Users": 3, "Orders": 8, "Payments": 3}


def test_orders_with_every_payment(tables):
    rows = R.orders_payments_sorted(tables["orders"], tables["payments"]).collect()
    assert [(r["order_id"], r["payment_id"]) for r in rows][:2] == [("z", "p3"), ("o6", None)]
    assert sorted(r["payment_id"] for r in rows if r["order_id"] == "o0") == ["p1", "p2"]
    assert len(rows) == 9
