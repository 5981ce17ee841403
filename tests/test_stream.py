import datetime as dt
import json
import random

import pytest
from pyspark.sql import functions as F

from tests.events import item, order, payment, stock, user
from tidemark import schemas as S
from tidemark.operators import dead_letters as D
from tidemark.operators.merge import empty_tables
from tidemark.operators.metrics import current_rate
from tidemark.operators.parse import parse_events, with_lane
from tidemark.plans import serving as Q
from tidemark.plans.ingest import settle_stock
from tidemark.sources.topic import replay_topic_files, stream_topic_files, with_seq
from tidemark.streaming.ingest_job import _parents, apply_batch, replay, start_ingest
from tidemark.streaming.lookups import order_with_payment, user_with_orders
from tidemark.streaming.tables import INDEXES, EntityTables

START = dt.datetime(2025, 10, 20, 10)
NOW = dt.datetime(2025, 11, 1)


def topic_rows(messages, first=0):
    return [
        ("k", m if isinstance(m, str) else json.dumps(m), "events", 0, first + i, START + dt.timedelta(seconds=first + i))
        for i, m in enumerate(messages)
    ]


PARTS = [
    [user("u1", "x"), user("u2", "x"), user("u3"), order("o1", "u1", [item("A"), item("B")]), "garbage"],
    [payment("p1", "o1"), user("u1", "y", createdAt="2026-01-01T00:00:00Z"), user("u2", "x"), stock("s", 50)],
    [order("o2", "u2"), order("o1", "u1", []), order("o3", "ghost"), stock("s", 20, "subtract"), payment("p2", "o9")],
    [stock("s", 2**31 - 20), user("u4", "y"), '{"eventId":"q","eventType":"Strange"}'],
]


@pytest.fixture(scope="module")
def topic(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("topic") / "log")
    first = 0
    for part in PARTS:
        rows = topic_rows(part, first)
        first += len(part)
        spark.createDataFrame(rows, S.TOPIC).coalesce(1).write.mode("append").parquet(path)
    return path


def contents(tables):
    out = {name: sorted(map(str, df.drop("updated_at").collect())) for name, df in tables.read_all().items()}
    out["dlq"] = sorted((r["offset"], r["error_class"]) for r in tables.dead_letters().collect())
    return out


@pytest.fixture(scope="module")
def streamed(spark, topic, tmp_path_factory):
    base = tmp_path_factory.mktemp("stream")
    tables = EntityTables(spark, str(base / "tables"), buckets=4)
    query = start_ingest(stream_topic_files(spark, topic, max_files=1), tables, str(base / "ck"), available_now=True)
    query.awaitTermination(600)
    assert query.exception() is None
    return tables, base, query


def test_stream_equals_one_batch_replay(spark, topic, streamed, tmp_path):
    tables, _, query = streamed
    once = EntityTables(spark, str(tmp_path / "once"), buckets=3)
    replay(once, replay_topic_files(spark, topic), now=NOW)
    assert tables.version == 3 and list(tables.batches.values()) == [3]
    assert contents(tables) == contents(once)
    assert contents(tables)["dlq"] == [(1, "unique"), (4, "parse"), (11, "foreign_key"), (13, "foreign_key"),
                                       (14, "numeric"), (15, "unique"), (16, "unknown_type")]
    u1 = tables.read("users").filter("user_id = 'u1'").first()
    assert (u1["email"], u1["created_at"].year) == ("y", 2025)
    assert tables.read("order_items").count() == 0
    assert tables.read("inventory").first()["quantity"] == 30
    counts = {(r["event_type"], r["status"]): r["n"] for r in tables.outcomes()
              .groupBy("event_type", "status").agg(F.sum("events").alias("n")).collect()}
    assert counts == {("UserCreated", "success"): 4, ("UserCreated", "error"): 2, ("OrderPlaced", "success"): 3,
                      ("OrderPlaced", "error"): 1, ("PaymentSettled", "success"): 1, ("PaymentSettled", "error"): 1,
                      ("InventoryAdjusted", "success"): 2, ("InventoryAdjusted", "error"): 1, ("Strange", "error"): 1}
    latencies = tables.stage_latencies().groupBy("version").agg(F.collect_set("stage").alias("s")).collect()
    assert {r["version"]: set(r["s"]) for r in latencies} == dict.fromkeys(range(4), {"parse", "settle", "merge", "report"})
    rates = tables.success_rate()
    assert {r["event_type"]: r["n"] for r in rates.groupBy("event_type").agg(F.sum("events").alias("n")).collect()} == {
        "UserCreated": 4, "OrderPlaced": 3, "PaymentSettled": 1, "InventoryAdjusted": 2}
    assert sorted(r["tick"] for r in rates.filter("event_type = 'PaymentSettled'").collect()) == [START + dt.timedelta(seconds=5)]
    assert {r["event_type"] for r in current_rate(rates).collect()} == set(S.EVENT_TYPES)


def test_restart_and_redelivery(spark, topic, streamed):
    """A restart reads nothing twice, and a batch delivered again changes nothing."""
    tables, base, _ = streamed
    before = contents(tables)
    again = EntityTables(spark, str(base / "tables"))
    assert (again.version, again.buckets) == (3, 4)
    query = start_ingest(stream_topic_files(spark, topic, max_files=1), again, str(base / "ck"), available_now=True)
    query.awaitTermination(600)
    assert not apply_batch(again, replay_topic_files(spark, topic), 2, source=next(iter(again.batches)))
    assert contents(again) == before


def test_replay_twice_keeps_tables_but_moves_stock(spark, tmp_path):
    messages = [user("u"), order("o", "u", [item("A")]), payment("p", "o"), stock("s", 5)]
    log = spark.createDataFrame(topic_rows(messages), S.TOPIC)
    tables = EntityTables(spark, str(tmp_path / "t"), buckets=2)
    apply_batch(tables, log, 0, NOW)
    first = contents(tables)
    apply_batch(tables, log, 1, NOW)
    second = contents(tables)
    assert {k: v for k, v in first.items() if k != "inventory"} == {k: v for k, v in second.items() if k != "inventory"}
    assert tables.read("inventory").first()["quantity"] == 10


def test_duplicate_suppression_reaches_earlier_batches(spark, tmp_path):
    tables = EntityTables(spark, str(tmp_path / "t"), buckets=2)
    first = [stock("s", 5, eventId="a"), stock("s", 5, eventId="a"), stock("s", 1, eventId="b")]
    apply_batch(tables, spark.createDataFrame(topic_rows(first), S.TOPIC), 0, NOW, dedupe_event_id=True)
    second = [stock("s", 5, eventId="a"), stock("s", 2, eventId="c")]
    apply_batch(tables, spark.createDataFrame(topic_rows(second, 3), S.TOPIC), 1, NOW, dedupe_event_id=True)
    assert tables.read("inventory").first()["quantity"] == 8


def test_uncommitted_batch_is_invisible(spark, tmp_path):
    tables = EntityTables(spark, str(tmp_path / "t"), buckets=2)
    apply_batch(tables, spark.createDataFrame(topic_rows([user("u")]), S.TOPIC), 0, NOW)
    rows = tables.read("users").withColumn("last_name", F.lit("lost"))
    tables.write_version("users", rows, 1)
    tables.append("dead_letters", D.empty_entries(spark), 1)
    reopened = EntityTables(spark, str(tmp_path / "t"), buckets=2)
    assert reopened.version == 0
    assert reopened.read("users").first()["last_name"] == "Last"


def test_a_new_stream_meets_live_tables(spark, topic, tmp_path):
    """A new checkpoint starts its batch numbers over; its messages are applied all the same."""
    tables = EntityTables(spark, str(tmp_path / "t"), buckets=2)
    replay(tables, replay_topic_files(spark, topic), now=NOW)
    before = contents(tables)
    spark.createDataFrame(topic_rows([user("b"), "garbage"], 100), S.TOPIC).coalesce(1).write.parquet(str(tmp_path / "second"))
    start_ingest(stream_topic_files(spark, str(tmp_path / "second")), tables, str(tmp_path / "ck"), available_now=True).awaitTermination(600)
    after = contents(tables)
    assert len(after["users"]) == len(before["users"]) + 1 and len(after["dlq"]) == len(before["dlq"]) + 1
    replay(tables, replay_topic_files(spark, topic), now=NOW)
    again = contents(tables)
    assert {k: again[k] for k in ("orders", "order_items", "payments")} == {k: after[k] for k in ("orders", "order_items", "payments")}
    assert tables.read("users").count() == tables.read("users").select("user_id").distinct().count() == len(after["users"])


def test_positions_read_only_the_slices_they_meet(spark, tmp_path):
    """Three batches of seven refused messages, in slices of three: a range lists the files of its own slices."""
    tables = EntityTables(spark, str(tmp_path / "t"), buckets=2)
    for version in range(3):
        rows = [(version, i % 2, 10 * version + i, f"e{version}{i}", "x", "boom", "parse", NOW, 0) for i in range(7)]
        tables.append_dead_letters(spark.createDataFrame(rows[::-1], S.DEAD_LETTERS), version, rows_per_slice=3)
        tables.commit(version, "s", version, {})
    tables.append_dead_letters(spark.createDataFrame([(3, 0, 99, "lost", "x", "boom", "parse", NOW, 0)], S.DEAD_LETTERS), 3)  # never committed
    listed = tables.dead_letter_list()
    along = [f"e{v}{i}" for v in range(3) for p in (0, 1) for i in range(7) if i % 2 == p]
    assert listed.count() == 21
    for start, stop in [(0, -1), (-1, -1), (5, 12), (20, 99), (-3, 19), (21, 30), (4, 2)]:
        found = listed.range(start, stop)
        lo, hi = (p + 21 if p < 0 else p for p in (start, stop))
        assert [r["event_id"] for r in found.orderBy("position").collect()] == along[lo : hi + 1]
        places = listed.places(lo, hi)
        folders = {tuple(f.split("/")[-3:-1]) for f in found.inputFiles()}
        assert folders == {(f"batch_id={b}", f"slice={s}") for b, s, _ in places}
    assert len(listed.places(20, 20)) == 1 and len(listed.places(0, 20)) == 9
    assert [r["event_id"] for r in listed.at(-1).collect()] == [along[-1]]
    assert [r["event_id"] for r in listed.since(19).orderBy("position").collect()] == along[19:]


def buckets_read(df, name):
    return {f.split("/")[-2] for f in df.inputFiles() if f"/{name}/" in f}


def test_lookups_read_the_buckets_of_their_ids(spark, tmp_path):
    tables = EntityTables(spark, str(tmp_path / "t"), buckets=16)
    messages = [user(f"u{i}") for i in range(60)] + [order(f"o{i}", f"u{i % 7}", [item("A")]) for i in range(60)] + [payment(f"p{i}", f"o{i}") for i in range(0, 60, 2)]
    apply_batch(tables, spark.createDataFrame(topic_rows(messages), S.TOPIC), 0, NOW)
    # Orders and payments change hands, and a user takes a new address.
    later = [order("o1", "u9", [item("B")]), payment("p0", "o5"), user("u3", "new@x"), user("u4", "u3@example.com")]
    apply_batch(tables, spark.createDataFrame(topic_rows(later, 200), S.TOPIC), 0, NOW)
    found = user_with_orders(tables, ["u1", "nobody"])
    whole = Q.user_with_orders(tables.read("users"), tables.read("orders"))
    assert found.collect() == whole.filter("user_id = 'u1'").collect()
    assert user_with_orders(tables, spark.createDataFrame([("u9",)], "user_id string")).collect() == whole.filter("user_id = 'u9'").collect()
    assert len(buckets_read(found, "users")) <= 2 and len(buckets_read(found, "orders")) <= 8
    one = order_with_payment(tables, ["o5"])
    assert one.collect() == Q.order_with_payment(tables.read("orders"), tables.read("payments")).filter("order_id = 'o5'").collect()
    assert one.first()["payment"]["payment_id"] == "p0" and order_with_payment(tables, ["o0"]).first()["payment"] is None
    assert len(buckets_read(one, "orders")) == 1 and len(buckets_read(one, "payments")) == 1
    for index, (table, value) in INDEXES.items():
        pairs = tables.read(table).select(value, S.TABLE_KEYS[table]).collect()
        assert sorted(map(tuple, tables.read(index).collect())) == sorted(map(tuple, pairs))


def test_a_small_batch_reads_few_parents(spark, tmp_path):
    tables = EntityTables(spark, str(tmp_path / "t"), buckets=32)
    messages = [user(f"u{i}") for i in range(200)] + [order(f"o{i}", f"u{i}") for i in range(200)]
    apply_batch(tables, spark.createDataFrame(topic_rows(messages), S.TOPIC), 0, NOW)
    small = [order("a", "u5"), order("b", "u6"), payment("c", "o7"), payment("d", "o8")]
    parsed = with_lane(parse_events(with_seq(spark.createDataFrame(topic_rows(small, 900), S.TOPIC))))
    parents = _parents(tables, parsed)
    assert 0 < len(buckets_read(parents["users"], "users")) <= 2 and 0 < len(buckets_read(parents["orders"], "orders")) <= 2
    apply_batch(tables, spark.createDataFrame(topic_rows([*small, order("e", "ghost")], 900), S.TOPIC), 0, NOW)
    assert tables.read("orders").count() == 202 and tables.read("payments").count() == 2
    assert [r["error_class"] for r in tables.dead_letters().collect()] == ["foreign_key"]


def test_refused_redeliveries_are_settled_in_one_replay(spark):
    """A thousand redeliveries of refused movements; every tenth message makes room again."""
    rng = random.Random(4)
    top, moves = 2**31 - 1, [(0, "q", 2**31 - 40, "fill")]
    for i in range(1, 2500):
        moves.append((i, "q", -rng.randint(1, 30), f"down{i}") if i % 10 == 0 else (i, "q", rng.randint(20, 90), f"up{rng.randrange(900)}"))
    balance, moved, accepted, refused = 0, set(), set(), set()
    for seq, _, delta, event_id in moves:
        if event_id not in moved:
            if -top - 1 <= balance + delta <= top:
                balance += delta
                moved.add(event_id)
                accepted.add(seq)
            else:
                refused.add(seq)
    assert len(refused) > 1000
    stock_rows = spark.createDataFrame([(s, k, abs(d), "subtract" if d < 0 else "add", e) for s, k, d, e in moves], "seq bigint, sku string, quantity bigint, adjustment_type string, event_id string")
    found = settle_stock(stock_rows, empty_tables(spark)["inventory"], dedupe_event_id=True)
    assert {r["seq"] for r in found.accepted.collect()} == accepted
    assert found.rejected.count() == len(refused)
    assert found.suppressed.count() == len(moves) - len(accepted) - len(refused)


def test_a_half_known_topic_moves_stock_once(spark, tmp_path):
    """A new checkpoint reads a topic from its start; what the tables took before is left out, a gap raises."""
    tables = EntityTables(spark, str(tmp_path / "t"), buckets=2)
    messages = [stock("s", 1, eventId=f"e{i}") for i in range(6)]
    rows = topic_rows(messages)
    for _ in range(2):
        apply_batch(tables, spark.createDataFrame(rows[:4], S.TOPIC), 0, NOW, skip_known=True)
    assert tables.read("inventory").first()["quantity"] == 4 and tables.offsets == {"events/0": 4} and tables.batches == {}
    spark.createDataFrame(rows, S.TOPIC).coalesce(1).write.parquet(str(tmp_path / "topic"))
    stream = stream_topic_files(spark, str(tmp_path / "topic"))
    start_ingest(stream, tables, str(tmp_path / "ck"), available_now=True, skip_known=True).awaitTermination(600)
    reopened = EntityTables(spark, str(tmp_path / "t"), buckets=2)
    assert reopened.read("inventory").first()["quantity"] == 6 and reopened.offsets == {"events/0": 6} and len(reopened.batches) == 1
    with pytest.raises(ValueError, match="missing in events/0"):
        apply_batch(reopened, spark.createDataFrame(topic_rows(messages, 20), S.TOPIC), 0, NOW, skip_known=True)
    other = [(*r[:3], 1, *r[4:]) for r in topic_rows(messages[:2], 90)]
    apply_batch(reopened, spark.createDataFrame(other, S.TOPIC), 0, NOW, skip_known=True)
    assert reopened.read("inventory").first()["quantity"] == 8 and reopened.offsets == {"events/0": 6, "events/1": 92}


def test_buckets_are_fixed(spark, tmp_path):
    apply_batch(EntityTables(spark, str(tmp_path / "t"), buckets=3), spark.createDataFrame(topic_rows([user("u")]), S.TOPIC), 0, NOW)
    with pytest.raises(ValueError, match="3 buckets"):
        EntityTables(spark, str(tmp_path / "t"), buckets=8)
    tables = EntityTables(spark, str(tmp_path / "t"))
    with pytest.raises(ValueError, match="missing"):
        apply_batch(tables, spark.createDataFrame([], S.TOPIC), 5, NOW, source="elsewhere")
    apply_batch(tables, spark.createDataFrame(topic_rows([user("u"), user("v")], 1), S.TOPIC), 0, NOW)
    assert sorted(r[0] for r in tables.read("users").select("user_id").collect()) == ["u", "v"]


def test_suppression_spares_nameless_and_refused_movements(spark, tmp_path):
    tables = EntityTables(spark, str(tmp_path / "t"), buckets=2)
    top = 2**31 - 1
    first = [stock("s", 5, eventId=""), stock("s", 7, eventId=""), stock("z", 1, eventId=""), stock("q", top, eventId="a"),
             stock("q", 100, eventId="b"), stock("q", 100, "subtract", eventId="c"), stock("q", 100, eventId="b"), stock("q", 100, eventId="b")]
    apply_batch(tables, spark.createDataFrame(topic_rows(first), S.TOPIC), 0, NOW, dedupe_event_id=True)
    assert {r["sku"]: r["quantity"] for r in tables.read("inventory").collect()} == {"s": 12, "z": 1, "q": top}
    second = [stock("q", 50, "subtract", eventId="d"), stock("q", 100, eventId="b"), stock("q", 60, eventId="e")]
    apply_batch(tables, spark.createDataFrame(topic_rows(second, 10), S.TOPIC), 0, NOW, dedupe_event_id=True)
    third = [stock("q", 10, "subtract", eventId="f"), stock("q", 60, eventId="e")]
    apply_batch(tables, spark.createDataFrame(topic_rows(third, 20), S.TOPIC), 0, NOW, dedupe_event_id=True)
    assert tables.read("inventory").filter("sku = 'q'").first()["quantity"] == top
    counts = {(r["batch_id"], r["status"]): r["n"] for r in tables.outcomes().groupBy("batch_id", "status").agg(F.sum("events").alias("n")).collect()}
    assert counts == {(0, "success"): 6, (0, "error"): 1, (0, "suppressed"): 1, (1, "success"): 1, (1, "error"): 1, (1, "suppressed"): 1, (2, "success"): 2}


@pytest.mark.parametrize("rows_per_slice", [2, 1_000_000])
def test_offsets_decide_inside_a_partition(spark, rows_per_slice):
    seconds = [10, 5, 5, 30, 7]
    rows = [("k", "{}", "events", p, i, START + dt.timedelta(seconds=s + p)) for p in (0, 1) for i, s in enumerate(seconds)]
    found = with_seq(spark.createDataFrame(rows, S.TOPIC), rows_per_slice).select("seq.*").collect()
    times = {(r["partition"], r["offset"]): (r["timestamp"] - START).seconds for r in found}
    assert times == {(p, i): s + p for p in (0, 1) for i, s in enumerate([10, 10, 10, 30, 30])}


def test_the_later_offset_wins(spark, tmp_path):
    rows = topic_rows([user("u", "old@x"), user("u", "new@x")])
    rows = [(*r[:5], START - dt.timedelta(seconds=r[4])) for r in rows]
    tables = EntityTables(spark, str(tmp_path / "t"), buckets=2)
    apply_batch(tables, spark.createDataFrame(rows, S.TOPIC), 0, NOW)
    assert tables.read("users").first()["email"] == "new@x"
