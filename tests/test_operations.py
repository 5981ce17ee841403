import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from tests.events import item, log, order, payment, stock, user
from tidemark import schemas as S
from tidemark.functions import scalars as X
from tidemark.functions.ordered import in_slices, positions, running_total
from tidemark.operators import dead_letters as D
from tidemark.operators import log_lines as L
from tidemark.operators import metrics as M
from tidemark.operators import publish as P
from tidemark.operators.parse import parse_events, route
from tidemark.sources.logs import read_log_lines, stream_log_lines

T0 = dt.datetime(2025, 10, 20, 10)


@pytest.fixture(scope="module")
def entries(spark):
    rows = [(b, p, o, f"e{b}{p}{o}", "x" * 120, "boom", "parse", T0, 0)
            for b, p, o in [(0, 0, 5), (0, 0, 9), (0, 1, 2), (1, 0, 11), (1, 0, 30), (2, 1, 3)]]
    return spark.createDataFrame(rows[::-1], S.DEAD_LETTERS)


@pytest.mark.parametrize("start,stop,expected", [
    (0, -1, [0, 1, 2, 3, 4, 5]), (-2, -1, [4, 5]), (0, 2, [0, 1, 2]), (4, 99, [4, 5]), (-99, 0, [0]), (3, 1, []),
    (-1, -1, [5]), (9, 12, [])])
@pytest.mark.parametrize("rows_per_slice", [4, 1_000_000])
def test_dead_letter_range(entries, start, stop, expected, rows_per_slice):
    got = D.entry_range(entries, start, stop, rows_per_slice).orderBy("position").collect()
    assert [r["position"] for r in got] == expected


def test_dead_letter_views(spark, entries):
    assert D.count_entries(entries).first()[0] == 6
    assert D.entry_at(entries, 0).first()["event_id"] == "e005"
    assert D.entry_at(entries, -1).first()["event_id"] == "e213"
    assert D.entry_at(entries, -7).count() == 0
    assert D.new_since(entries, 4).count() == 2
    assert D.new_since_batch(entries, 0).count() == 3
    assert D.by_cause(entries).first() == ("parse", 6)
    line = D.summary_lines(entries).first()
    assert (line["at"], line["original_preview"]) == ("2025-10-20T10:00:00Z", "x" * 100 + "...")
    raw = D.to_json_entries(entries)
    assert set(json.loads(raw.first()["entry"])) == {"eventId", "originalData", "error", "timestamp", "retryCount"}
    spoiled = raw.withColumn("entry", F.when(F.col("offset") == 5, F.lit("{not json")).otherwise(F.col("entry")))
    back = D.from_json_entries(spoiled)
    assert back.count() == 5
    assert back.filter("offset = 9").first()["timestamp"] == T0


def test_publish_round_trip(spark):
    messages = [user("u", "ü@x"), order("o", "u", [item("A", 2, 1.5)]), payment("p", "o"), stock("s", -3, "subtract")]
    source = log(spark, messages)
    parsed = parse_events(source)
    for event_type, key in zip(S.EVENT_TYPES, ["u", "o", "o", "s"]):
        events = route(parsed, event_type).withColumn("event_time", F.lit(T0))
        sent = P.to_messages(events, event_type)
        assert sent.first()["key"] == key
        again = route(parse_events(sent), event_type).drop("value")
        assert again.collect() == route(parsed, event_type).drop("value").collect()
        wire = json.loads(sent.first()["value"])
        original = next(m for m in messages if m["eventType"] == event_type)
        assert set(wire) == set(original)
        assert wire["timestamp"] == "2025-10-20T10:00:00.000000Z"


def test_partition_key_and_message_files(spark, tmp_path):
    df = spark.createDataFrame([("UserCreated", "u", "o"), ("PaymentSettled", "u", "o"), ("Other", "u", "o")],
                               "t string, u string, o string")
    key = P.partition_key(F.col("t"), {"userId": F.col("u"), "orderId": F.col("o")})
    assert [r[0] for r in df.select(key).collect()] == ["u", "o", "unknown"]
    messages = spark.range(200).select((F.col("id") % 10).cast("string").alias("key"), F.lit("{}").alias("value"))
    P.write_message_files(messages, str(tmp_path / "m"), 3)
    files = spark.read.parquet(str(tmp_path / "m")).select("key", F.input_file_name().alias("f")).distinct()
    assert files.count() == 10


def test_scalars(spark):
    row = spark.range(1).select(
        X.full_name(F.lit("A"), F.lit("B")), X.trimmed_length(F.lit("ab  ")), X.short_id(F.lit("12345678-9")),
        X.numbered("SKU", F.lit(7)), X.preview(F.lit("short")), F.repeat(F.lit("ab"), 2),
        X.signed_delta(F.lit(-(2**63)), F.lit("subtract")), X.signed_delta(F.lit(-5), F.lit("Subtract")),
        X.rfc3339(F.lit(T0)), X.full_name(F.lit(None), F.lit("B"))).first()
    assert tuple(row) == ("A B", 2, "12345678", "SKU-007", "short", "abab", None, -5, "2025-10-20T10:00:00Z", None)


LINES = [
    ('{"level":"error","msg":"UserCreated went wrong"}', "ERROR", "ERROR"),
    ("x ERROR y", "ERROR", "ERROR"),
    ("got usercreated successfully", "EVENT", "EVENT"),
    ("Message pushed to dlq", "DLQ", "DLQ"),
    ("it failed", "DLQ", "DLQ"),
    ("Processed event 1", "OK", "OK"),
    ("done successfully", "OK", "INFO"),
    ('{"eventId":"1"}', "INFO", "INFO"),
    ("nothing", "DEBUG", "INFO"),
]


def test_severity(spark):
    df = spark.createDataFrame(LINES, "value string, long string, short string")
    short = L.severity(F.col("value"), L.SHORT_SEVERITIES, L.OTHER_SHORT_SEVERITY)
    got = df.select("long", L.severity(F.col("value")).alias("a"), "short", short.alias("b")).collect()
    assert all(r["long"] == r["a"] and r["short"] == r["b"] for r in got)
    assert sum(r["lines"] for r in L.severity_counts(df).collect()) == len(LINES)


def log_line(n, event_id, level="info", day=20):
    return json.dumps({"level": level, "msg": f"m{n}", "eventId": event_id, "time": f"2025-10-{day}T10:00:{n:02d}Z"})


def test_log_source_and_views(spark, tmp_path):
    path = tmp_path / "app.log"
    lines = [log_line(1, "a"), log_line(2, "b", day=18), "not json", log_line(3, "a", "error"), log_line(0, "a")]
    path.write_text("\n".join(lines))
    parsed = read_log_lines(spark, str(path))
    assert parsed.count() == 5
    one = {r["event_id"]: r for r in L.correlation_summary(parsed).collect()}["a"]
    assert (one["lines"], one["errors"], one["first_msg"], one["last_msg"]) == (3, 1, "m0", "m3")
    ids = spark.createDataFrame([("a",)], "eventId string")
    assert [r["msg"] for r in L.correlated_lines(parsed, ids).collect()] == ["m0", "m1", "m3"]
    timed = parsed.filter("time IS NOT NULL")
    assert [r["msg"] for r in L.tail(timed, 2, ["time"]).collect()] == ["m1", "m3"]
    numbered = L.numbered_lines(timed, ["time"], rows_per_slice=2)
    assert [r["msg"] for r in numbered.orderBy("line_no").collect()] == ["m2", "m0", "m1", "m3"]
    assert L.retained(timed, F.lit(dt.datetime(2025, 10, 21))).count() == 3
    assert L.retained(parsed, F.lit(dt.datetime(2025, 10, 21))).count() == 4
    tomorrow = dt.datetime.now() + dt.timedelta(days=1)
    assert read_log_lines(spark, str(path), written_since=tomorrow).count() == 0
    query = stream_log_lines(spark, str(tmp_path)).writeStream.format("memory").queryName("lines").trigger(
        availableNow=True).start()
    query.awaitTermination(120)
    assert spark.table("lines").count() == 5


def test_rates(spark):
    rows = [(T0, "a", "success"), (T0, "a", "success"), (T0, "a", "error"),
            (T0 + dt.timedelta(seconds=5), "a", "success"), (T0, "b", "error")]
    outcomes = spark.createDataFrame(rows, "ts timestamp, event_type string, status string")
    ticks = M.processed_per_tick(outcomes)
    assert sorted((r["tick"].second, r["events"]) for r in ticks.collect()) == [(0, 2), (5, 1)]
    assert M.current_rate(ticks).first()["events"] == 1
    summary = {r["event_type"]: r for r in M.outcome_summary(outcomes).collect()}
    assert (summary["ALL"]["succeeded"], summary["ALL"]["failed"], summary["ALL"]["success_rate"]) == (3, 2, 0.6)
    assert M.processed_total(outcomes).count() == 3


def test_latency(spark):
    values = [0.004, 0.005, 0.03, 0.2, 3.0, 20.0]
    df = spark.createDataFrame([("op", v) for v in values], "operation string, duration_seconds double")
    histogram = M.latency_histogram(df, ["operation"])
    buckets = {r["le"]: r["bucket_count"] for r in histogram.collect()}
    assert buckets == {"0.005": 2, "0.01": 2, "0.025": 2, "0.05": 3, "0.1": 3, "0.25": 4, "0.5": 4, "1": 4, "2.5": 4,
                       "5": 5, "10": 5, "+Inf": 6}
    median = M.histogram_quantile(histogram, ["operation"], 0.5).first()["quantile_seconds"]
    assert median == pytest.approx(0.05)
    assert M.histogram_quantile(histogram, ["operation"], 0.99).first()["quantile_seconds"] == 10.0
    for size in (2, 1_000_000):
        exact = M.exact_quantiles(df, ["operation"], {"p50": 0.5, "p0": 0.0, "p100": 1.0}, rows_per_slice=size).first()
        assert (exact["p50"], exact["p0"], exact["p100"]) == (pytest.approx(0.115), 0.004, 20.0)
    assert M.approximate_quantiles(df, ["operation"], {"p50": 0.5}).first()["p50"] == 0.03
    assert M.mean_latency(df, ["operation"]).first()["mean_seconds"] == pytest.approx(sum(values) / 6)


def test_scans_over_a_hot_key(spark):
    rows = spark.range(1000).select((F.col("id") % 3 == 0).alias("k"), "id", F.floor(F.col("id") / 100).alias("s"))
    total = running_total(rows, ["k"], ["id"], F.lit(1), "n", "s")
    assert total.filter("id = 999").first()["n"] == 334
    placed = positions(rows, ["id"], "pos", ["s"], total="all")
    assert placed.filter("pos <> id OR all <> 1000").count() == 0


def test_slices_tell_equal_times_apart(spark):
    rows = spark.range(200).select(F.lit(1).alias("at"), "id")
    sizes = in_slices(rows, ["at", "id"], rows_per_slice=10).groupBy("slice").agg(F.count("*").alias("n"), F.min("id").alias("a"), F.max("id").alias("b")).orderBy("slice").collect()
    assert len(sizes) >= 15 and max(r["n"] for r in sizes) <= 30
    assert all(x["b"] < y["a"] for x, y in zip(sizes, sizes[1:]))


def test_gauge_keeps_its_value_over_silent_ticks(spark):
    start = dt.datetime(2025, 1, 1)
    ticks = [("a", 0, 5), ("a", 1, 7), ("a", 9000, 1), ("b", 3, 2), ("b", 9002, 4)]
    rows = spark.createDataFrame([(t, start + dt.timedelta(seconds=s), n) for t, s, n in ticks], "event_type string, tick timestamp, events bigint")
    for rows_per_slice in (2, 1_000_000):
        found = M.gauge(rows, "1 second", rows_per_slice).collect()
        got = {(r["event_type"], (r["tick"] - start).seconds): (r["events"], r["silent"]) for r in found}
        assert len(got) == len(found) == 9003 + 9000
        assert got["a", 0] == (5, False) and got["a", 1] == (7, False) and got["a", 8999] == (7, True) and got["a", 9000] == (1, False)
        assert got["a", 9002] == (1, True) and got["b", 3] == (2, False) and got["b", 9001] == (2, True) and ("b", 2) not in got


def test_rates_of_a_stream_wait_for_the_watermark(spark, tmp_path):
    """Each tick comes once; a row older than the watermark is dropped."""
    start, schema = dt.datetime(2025, 1, 1), "ts timestamp, event_type string, status string"
    batches = [[(0, "success"), (0, "success"), (1, "error"), (2, "success")], [(1, "success"), (30, "success")], [(2, "success"), (31, "success"), (60, "success")], [(90, "success")]]
    for i, batch in enumerate(batches):
        rows = [(start + dt.timedelta(seconds=s), "a", status) for s, status in batch]
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
        stream = spark.readStream.schema(schema).parquet(str(tmp_path / "in"))
        query = M.rates_of_stream(stream, "5 seconds").writeStream.format("parquet").outputMode("append").option("checkpointLocation", str(tmp_path / "ck"))
        query.trigger(availableNow=True).start(str(tmp_path / "out")).awaitTermination(300)
    found = spark.read.parquet(str(tmp_path / "out")).collect()
    assert sorted(((r["tick"] - start).seconds, r["events"]) for r in found) == [(0, 2), (1, 1), (2, 1), (30, 1), (31, 1), (60, 1)]


def test_sketches_of_ticks_merge(spark):
    durations = spark.range(20_000).selectExpr("timestamp_seconds(id) AS ts", "'op' AS operation", "double(id % 1000) AS duration_seconds")
    sketches = M.latency_sketches(durations, ["operation"], "10 minutes")
    found = M.sketched_quantiles(sketches, ["operation"], {"p50": 0.5, "p99": 0.99}).first()
    assert found["observations"] == 20_000 and abs(found["p50"] - 500) < 20 and abs(found["p99"] - 990) < 20
