import datetime as dt
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.events import item, log, order, payment, stock, user
from tests.sequential import Store
from tidemark.operators.email_claims import refused_claims
from tidemark.operators.merge import empty_tables
from tidemark.operators.stock import play, refused_moves, risky_skus
from tidemark.plans import ingest
from tidemark.plans.ingest import settle
from tidemark.session import staged

NOW = dt.datetime(2025, 11, 1)


def run(spark, messages):
    return settle(log(spark, messages), empty_tables(spark))


def causes(outcome):
    return {(r["seq"], r["error_class"]) for r in outcome.rejected().select("seq", "error_class").collect()}


def random_log(rng, n):
    """Few users, addresses, orders and skus, so that nearly every rule is contested."""
    users, mails = [f"u{i}" for i in range(8)], [f"m{i}@x" for i in range(6)]
    orders, pays = [f"o{i}" for i in range(10)], [f"p{i}" for i in range(10)]
    out = []
    for i in range(n):
        kind = rng.random()
        when = f"2025-10-{rng.randint(10, 28)}T10:00:00Z"
        if kind < 0.45:
            out.append(user(rng.choice(users), rng.choice(mails), f"e{i}", createdAt=when,
                            firstName="F" * rng.choice([1, 5, 101]), lastName=f"L{i}"))
        elif kind < 0.65:
            items = [item(rng.choice(["A", "B" * 51]) if rng.random() < 0.1 else "A", rng.randint(1, 5), 1.5)
                     for _ in range(rng.randint(0, 3))]
            out.append(order(rng.choice(orders), rng.choice(users), items, placedAt=when,
                             totalAmount=rng.choice([10.25, 99999999.994, 99999999.995, 3.0])))
        elif kind < 0.8:
            out.append(payment(rng.choice(pays), rng.choice(orders), status=rng.choice(["ok", "s" * 21]),
                               settledAt=when, amount=float(i)))
        else:
            big = rng.choice([5, 2**30, 2**31 - 1, 2**31, 2**32])
            out.append(stock(rng.choice(["s1", "s2"]), big, rng.choice(["add", "subtract"])))
    return out


@pytest.mark.parametrize("seed", range(2))
def test_random_logs_match_sequential_replay(spark, seed):
    messages = random_log(random.Random(seed), 150)
    store = Store()
    for seq, message in enumerate(messages):
        store.handle(seq, message)
    outcome = run(spark, messages)
    assert causes(outcome) == set(store.rejected)
    tables = outcome.merged(empty_tables(spark), NOW)
    users = {r["user_id"]: (r["email"], r["last_name"], r["created_at"].strftime("%Y-%m-%dT%H:%M:%SZ"))
             for r in tables["users"].collect()}
    assert users == {k: (v["email"], v["last_name"], v["created_at"]) for k, v in store.users.items()}
    orders = {r["order_id"]: (r["user_id"], r["total_amount"], r["placed_at"].strftime("%Y-%m-%dT%H:%M:%SZ"))
              for r in tables["orders"].collect()}
    assert orders == {k: (v["user_id"], v["total_amount"], v["placed_at"]) for k, v in store.orders.items()}
    items = {}
    for r in tables["order_items"].orderBy("order_id", "pos").collect():
        items.setdefault(r["order_id"], []).append((r["sku"], r["quantity"], r["price"]))
    assert items == {k: v for k, v in store.items.items() if v}
    payments = {r["payment_id"]: (r["order_id"], r["amount"], r["status"],
                                  r["settled_at"].strftime("%Y-%m-%dT%H:%M:%SZ"))
                for r in tables["payments"].collect()}
    assert payments == store.payments
    inventory = {r["sku"]: r["quantity"] for r in tables["inventory"].collect()}
    assert inventory == store.inventory


def refused_one_by_one(rows, held):
    holder, mail_of, lost = {e: u for u, e in held}, dict(held), set()
    for seq, uid, email in rows:
        if holder.get(email, uid) != uid:
            lost.add(seq)
            continue
        if mail_of.get(uid) not in (None, email):
            del holder[mail_of[uid]]
        holder[email], mail_of[uid] = uid, email
    return lost


def refused_in_rounds(spark, rows, held, rows_per_slice=1_000_000):
    claims = spark.createDataFrame(rows, "seq bigint, user_id string, email string")
    holders = spark.createDataFrame(held, "user_id string, email string")
    rounds = []
    found = [r[0] for r in refused_claims(claims, holders, rows_per_slice, on_round=rounds.append).collect()]
    assert len(found) == len(set(found))
    return set(found), rounds


@pytest.mark.parametrize("rows_per_slice", [7, 1_000_000])
def test_email_claims_in_slices(spark, rows_per_slice):
    rng = random.Random(5)
    rows = [(i, f"u{rng.randint(0, 20)}", rng.choice(["hot", "hot", "a", "b", f"own{rng.randint(0, 20)}"]))
            for i in range(90)]
    held = [("u1", "a"), ("z", "b"), ("y", "unrelated")]
    assert refused_in_rounds(spark, rows, held, rows_per_slice)[0] == refused_one_by_one(rows, held)


@pytest.mark.parametrize("users, addresses", [(3, 3), (8, 12)])
def test_email_claims_at_random(spark, users, addresses):
    rng = random.Random(users)
    rows = [(i, f"u{rng.randrange(users)}", f"a{rng.randrange(addresses)}") for i in range(70)]
    held = [("u0", "a0"), ("other", "a1")]
    assert refused_in_rounds(spark, rows, held)[0] == refused_one_by_one(rows, held)


def chains(links):
    """Users who hand their addresses on to each other, and one address that goes from user to user."""
    own = [(f"c{i}", f"own{i}") for i in range(links)]
    handed = [(f"c{i}", f"own{i + 1}") for i in reversed(range(links - 1))]
    blocked = [(f"d{i}", f"down{i}") for i in range(links)] + [(f"d{i}", f"down{i + 1}") for i in reversed(range(links))]
    passed = [claim for i in range(links) for claim in ((f"e{i}", "one"), (f"e{i}", f"left{i}"))]
    passed += [(f"f{i}", "one") for i in range(3)]
    steps = [*own, ("c%d" % (links - 1), "fresh"), *handed, *blocked, *passed]
    return [(i, *step) for i, step in enumerate(steps)], [("other", f"down{links}")]


def test_long_chains_end_in_few_rounds(spark):
    rows, held = chains(1000)
    found, rounds = refused_in_rounds(spark, rows, held)
    assert found == refused_one_by_one(rows, held) and len(found) == 1002
    assert len(rounds) <= 4


@pytest.mark.parametrize("rows_per_slice", [9, 1_000_000])
@pytest.mark.parametrize("lean", ["mixed", "filling"])
def test_stock_in_slices(spark, rows_per_slice, lean):
    rng = random.Random(11)
    rows, balance, lost = [], {"hot": 2**31 - 400}, set()
    for seq in range(90):
        sku = rng.choice(["hot", "hot", "calm", "wide"])
        delta = rng.randint(1, 50) if lean == "filling" else rng.randint(-60, 60)
        if sku == "wide":
            delta *= 2**25
        rows.append((seq, sku, delta))
        after = balance.get(sku, 0) + delta
        if -(2**31) <= after < 2**31:
            balance[sku] = after
        else:
            lost.add(seq)
    moves = spark.createDataFrame(rows, "seq bigint, sku string, delta bigint")
    balances = spark.createDataFrame([("hot", 2**31 - 400)], "sku string, quantity int")
    assert lost
    assert {r[0] for r in refused_moves(moves, balances, rows_per_slice).collect()} == lost


def test_one_refusal_replays_one_slice(spark):
    """A million movements of one sku in ten slices, of which one movement does not fit."""
    moves = spark.range(1_000_000).selectExpr(
        "id AS seq", "'hot' AS sku", f"IF(id = 654321, {2**31 - 1}L, IF(id % 2 = 0, 7L, -6L)) AS delta"
    )
    balances = spark.createDataFrame([("hot", 1000)], "sku string, quantity int")
    replays = []
    refused = refused_moves(moves, balances, rows_per_slice=100_000, on_round=replays.append)
    assert [r["seq"] for r in refused.collect()] == [654321]
    assert sum(replays) == 1 and len(replays) <= 2


def moves_one_by_one(rows, opening=0):
    balance, lost = {}, set()
    for seq, sku, delta in rows:
        after = balance.get(sku, opening) + delta
        if -(2**31) <= after < 2**31:
            balance[sku] = after
        else:
            lost.add(seq)
    return lost


@pytest.mark.parametrize("rows_per_slice, rounds", [(50, 0), (10, 4)])
def test_many_skus_need_no_slices_of_their_rows(spark, rows_per_slice, rounds):
    """Skus whose movements fit a slice are replayed at once; others have no more slices than their rows ask for."""
    rng = random.Random(3)
    rows = [(i, f"s{i % 40}", rng.randint(-3, 4) * 2**30) for i in range(1200)]
    moves = spark.createDataFrame(rows, "seq bigint, sku string, delta bigint")
    balances = spark.createDataFrame([], "sku string, quantity int")
    replays = []
    refused = refused_moves(moves, balances, rows_per_slice, on_round=replays.append)
    assert {r["seq"] for r in refused.collect()} == moves_one_by_one(rows)
    assert len(replays) <= rounds and sum(replays) <= rounds * 40


def test_play_against_one_by_one():
    rng = random.Random(2)
    for _ in range(300):
        scale = rng.choice([1, 2**20, 2**29, 2**31])
        deltas = [rng.randint(-3, 4) * scale for _ in range(rng.randrange(400))]
        opening = balance = rng.choice([0, 2**31 - 1, -(2**31), 2**30])
        accepted = []
        for delta in deltas:
            accepted.append(-(2**31) <= balance + delta < 2**31)
            balance += delta if accepted[-1] else 0
        closing, mask = play(opening, np.array(deltas, dtype=np.int64))
        assert (closing, mask.tolist()) == (balance, accepted)


def test_struct_sequence(spark):
    """The same rules hold when order is (timestamp, partition, offset)."""
    messages = [user("a", "x"), user("b", "x"), stock("s", 2**31 - 1), stock("s", 1), order("o", "a"), order("q", "b")]
    at = dt.datetime(2025, 1, 1)
    rows = [((at + dt.timedelta(seconds=i // 2), 0, i), m) for i, m in enumerate(
        r["value"] for r in log(spark, messages).orderBy("seq").collect())]
    framed = spark.createDataFrame(rows, "seq struct<timestamp: timestamp, partition: int, offset: bigint>, value string")
    outcome = settle(framed, empty_tables(spark))
    got = {(r["o"], r["error_class"]) for r in outcome.rejected().select(
        F.col("seq.offset").alias("o"), "error_class").collect()}
    assert got == {(1, "unique"), (3, "numeric"), (5, "foreign_key")}


FIXTURES = [
    ("long names", [user("u", firstName="N" * 101)], {(0, "length")}),
    ("minimal", [user("u", "q@r", firstName="", lastName="Z")], set()),
    ("missing fields", ['{"eventType": "UserCreated", "eventId": "only-id"}'], set()),
    ("large amount", [user("u"), order("o", "u", [], totalAmount=99999999.99)], set()),
    ("overflow", [user("u"), order("o", "u", [], totalAmount=1e8)], {(1, "numeric")}),
    ("large order, unknown user", [order("o", "u", [item(f"K{i}", i + 2, 3.25) for i in range(40)])],
     {(0, "foreign_key")}),
    ("order before its user", [order("o", "u"), user("u"), order("p", "u")], {(0, "foreign_key")}),
    ("payment without order", [payment("p", "o")], {(0, "foreign_key")}),
    ("email clash", [user("u", "x"), user("v", "x")], {(1, "unique")}),
    ("freed email", [user("u", "x"), user("u", "y"), user("v", "x")], set()),
    ("bad item keeps old version", [user("u"), order("o", "u", [item("A")]), order("o", "u", [item("B" * 51)])],
     {(2, "length")}),
    ("quantity out of range", [user("u"), order("o", "u", [item("A", 2**31)])], {(1, "numeric")}),
]


@pytest.mark.parametrize("name,messages,expected", FIXTURES, ids=[f[0] for f in FIXTURES])
def test_fixture_rejections(spark, name, messages, expected):
    assert causes(run(spark, messages)) == expected


def test_fixture_tables(spark):
    messages = [user(f"u{i}") for i in range(1, 4)]
    messages += [order(f"o{i}", f"u{i}", [item(f"SKU-{i}", i, 100.0)], totalAmount=100.0 * i) for i in range(1, 4)]
    messages += [payment(f"p{i}", f"o{i}") for i in range(1, 4)] + [stock(f"SKU-{i}", 50) for i in range(1, 6)]
    messages += [stock("SKU-1", 20, "subtract"), stock("SKU-9", -35, "returned")]
    messages += [user("u1", event_id="again", lastName="New", createdAt="2026-01-01T00:00:00Z")] * 3
    messages += [order("o3", "u3", [item("X"), item("Y"), item("Z")]), order("o3", "u3", [item("W")],
                                                                          placedAt="2026-01-01T00:00:00Z")]
    tables = run(spark, messages).merged(empty_tables(spark), NOW)
    counts = {name: df.count() for name, df in tables.items()}
    assert counts == {"users": 3, "orders": 3, "order_items": 3, "payments": 3, "inventory": 6}
    u1 = tables["users"].filter("user_id = 'u1'").first()
    assert (u1["last_name"], u1["created_at"].year) == ("New", 2025)
    assert tables["order_items"].filter("order_id = 'o3'").first()["sku"] == "W"
    assert tables["orders"].filter("order_id = 'o3'").first()["placed_at"].year == 2025
    balances = {r["sku"]: r["quantity"] for r in tables["inventory"].collect()}
    assert (balances["SKU-1"], balances["SKU-9"]) == (30, -35)


def test_duplicate_suppression_is_opt_in(spark):
    messages = [stock("s", 5, eventId="same")] * 4 + [stock("s", 1, eventId="other")]
    every = run(spark, messages).merged(empty_tables(spark), NOW)["inventory"].first()
    once = settle(log(spark, messages), empty_tables(spark), dedupe_event_id=True)
    assert every["quantity"] == 21
    assert once.merged(empty_tables(spark), NOW)["inventory"].first()["quantity"] == 6


def test_only_refused_messages_keep_their_text(spark):
    outcome = run(spark, [user("u"), order("o", "u"), order("p", "nobody"), stock("s", 1)])
    accepted = [v.accepted.select("value") for v in (outcome.users, outcome.orders, outcome.stock)]
    assert [r["value"] for df in accepted for r in df.collect()] == [None] * 3
    assert "nobody" in outcome.orders.rejected.first()["value"]


def test_outcomes(spark):
    messages = [user("u")] * 5 + ["{}", "garbage", user("v", f"u@example.com")]
    got = {(r["event_type"], r["status"]): r["count"] for r in run(spark, messages).outcomes()
           .groupBy("event_type", "status").count().collect()}
    assert got == {("UserCreated", "success"): 5, ("UserCreated", "error"): 1, ("", "error"): 1}


def test_settling_copies_only_what_it_reads(spark):
    rows = log(spark, [user("u1"), stock("A", 5)]).withColumns({"key": F.lit("k"), "topic": F.lit("events"), "partition": F.lit(0), "offset": F.col("seq"), "timestamp": F.lit(NOW)})
    found = settle(rows, empty_tables(spark))
    assert not {"key", "topic", "timestamp", "event_time"} & set(found.parsed.columns)
    assert {r["seq"] for r in found.outcomes().collect()} == {0, 1}


def settled_stock(spark, messages, monkeypatch):
    """The settlement, and whether the verdicts on the stock messages were written."""
    written = []

    def noted(df, path=None):
        written.append("delta" in df.columns)
        return staged(df, path)

    monkeypatch.setattr(ingest, "staged", noted)
    return run(spark, messages), any(written)


def test_stock_verdicts_are_not_written_if_no_balance_is_refused(spark, monkeypatch):
    found, written = settled_stock(spark, [stock("A", 5), stock("B" * 60, 1), stock("A", 2, "subtract"), stock("A", 5_000_000_000)], monkeypatch)
    assert not written
    assert causes(found) == {(1, "length"), (3, "numeric")}
    assert {(r["seq"], r["delta"]) for r in found.stock.accepted.collect()} == {(0, 5), (2, -2)}
    assert {r["value"] is not None for r in found.rejected().collect()} == {True}


def test_stock_verdicts_with_refused_balances(spark, monkeypatch):
    found, written = settled_stock(spark, [stock("A", 2_000_000_000), stock("A", 2_000_000_000), stock("A", 7)], monkeypatch)
    assert written
    assert causes(found) == {(1, "numeric")}
    assert {r["seq"] for r in found.stock.accepted.collect()} == {0, 2}


def test_movements_are_read_once_for_the_risky_skus(spark, tmp_path):
    path = str(tmp_path / "moves")
    spark.createDataFrame([(0, "A", 2**31), (1, "B", 1), (2, "B", None)], "seq bigint, sku string, delta bigint").write.parquet(path)
    balances = spark.createDataFrame([("A", -5), ("C", 7)], "sku string, quantity int")
    found = risky_skus(spark.read.parquet(path), balances)
    assert not [f for f in found.inputFiles() if path in f]
    assert [tuple(r) for r in found.collect()] == [("A", -5, 1)]
