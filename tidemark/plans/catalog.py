"""Named queries over the sample tables, one per operator of the engine."""

from __future__ import annotations

import uuid
from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark import schemas as S
from tidemark.operators import constraints as C
from tidemark.operators import dead_letters as D
from tidemark.operators import log_lines as L
from tidemark.operators import merge as M
from tidemark.operators import metrics as X
from tidemark.operators.email_claims import refused_claims
from tidemark.operators.parse import judged_columns, parse_events, route, with_lane
from tidemark.operators.stock import refused_moves
from tidemark.plans import ingest as I
from tidemark.plans import reports as R
from tidemark.plans import serving as Q
from tidemark.session import shared_folder, staged
from tidemark.sources import views as V
from tidemark.sources.logs import read_log_lines
from tidemark.streaming.ingest_job import replay
from tidemark.streaming.tables import EntityTables

_PROCESSED_AT = datetime(2025, 1, 1)
_PLAIN_TIMES = ("created_at", "updated_at", "placed_at", "settled_at", "first_time", "last_time", "time", "tick")
QUANTILES = {"p50": 0.5, "p95": 0.95, "p99": 0.99}
#: By how much of all durations a quantile from sketches may be off.
_RANK_ERROR = 0.02


def _plain(df: DataFrame) -> DataFrame:
    """Instants as local date-times, the form the sample tables use."""
    zoned = [f.name for f in df.schema.fields if f.name in _PLAIN_TIMES and f.dataType.typeName() == "timestamp"]
    return df.withColumns({c: F.col(c).cast("timestamp_ntz") for c in zoned}) if zoned else df


# Serving queries


def user_last5_orders(spark: SparkSession, sf: str) -> DataFrame:
    rows = Q.user_order_rows(V.users(spark, sf), V.orders(spark, sf))
    return rows.drop("updated_at", "order_updated_at")


def user_lookup(spark: SparkSession, sf: str) -> DataFrame:
    """Users named by a table of ids, with their orders counted from the nested document."""
    ids = V.table(spark, sf, "events").selectExpr("string(user_id) AS user_id")
    found = Q.user_with_orders(V.users(spark, sf), V.orders(spark, sf), ids)
    newest = F.when(F.size("orders") > 0, F.col("orders")[0]["order_id"])
    return found.select("user_id", "email", F.size("orders").alias("n_orders"), newest.alias("newest_order_id"))


def order_with_payment(spark: SparkSession, sf: str) -> DataFrame:
    return Q.order_payment_rows(V.orders(spark, sf), V.payments(spark, sf)).drop("updated_at")


def user_documents(spark: SparkSession, sf: str) -> DataFrame:
    """The nested user documents, read back: their fields, and the newest of their orders."""
    users, orders = (df.withColumns({c: F.col(c).cast("timestamp") for c in df.columns if c.endswith("_at")}) for df in (V.users(spark, sf), V.orders(spark, sf)))
    document = F.col("document")
    part = lambda path: F.get_json_object(document, path)
    return Q.user_documents(Q.user_with_orders(users, orders)).select(
        "user_id",
        F.array_join(F.json_object_keys(document), ",").alias("fields"),
        part("$.email").alias("email"),
        F.json_array_length(part("$.orders")).alias("n_orders"),
        F.array_join(F.json_object_keys(part("$.orders[0]")), ",").alias("order_fields"),
        part("$.orders[0].orderId").alias("newest_order_id"),
        part("$.orders[0].totalAmount").cast("double").alias("newest_amount"),
    )


def order_documents(spark: SparkSession, sf: str) -> DataFrame:
    """The nested order documents, read back; without a payment the field is left out."""
    orders, payments = (df.withColumns({c: F.col(c).cast("timestamp") for c in df.columns if c.endswith("_at")}) for df in (V.orders(spark, sf), V.payments(spark, sf)))
    document = F.col("document")
    part = lambda path: F.get_json_object(document, path)
    return Q.order_documents(Q.order_with_payment(orders, payments)).select(
        "order_id",
        F.array_join(F.json_object_keys(document), ",").alias("fields"),
        part("$.payment.paymentId").alias("payment_id"),
        part("$.payment.status").alias("status"),
        part("$.payment.amount").cast("double").alias("amount"),
    )


def payment_struct(spark: SparkSession, sf: str) -> DataFrame:
    """Orders with the payment as a struct that is null where there is none."""
    found = Q.order_with_payment(V.orders(spark, sf), V.payments(spark, sf))
    return found.select("order_id", F.col("payment").isNull().alias("unpaid"), F.col("payment.payment_id").alias("payment_id"), F.col("payment.status").alias("status"))


def recent_users(spark: SparkSession, sf: str) -> DataFrame:
    return Q.recent_users(V.users(spark, sf), 100)


# Reports


def _tables(spark: SparkSession, sf: str) -> dict[str, DataFrame]:
    return {
        "Users": V.users(spark, sf),
        "Orders": V.orders(spark, sf),
        "Payments": V.payments(spark, sf),
        "Inventory": V.stock_moves(spark, sf).select("sku").distinct(),
    }


def _balances(spark: SparkSession, sf: str) -> DataFrame:
    moves = M.with_delta(V.stock_moves(spark, sf))
    empty = spark.createDataFrame([], S.INVENTORY)
    return M.merge_inventory(empty, moves, _PROCESSED_AT).select("sku", "quantity")


def orders_per_user(spark: SparkSession, sf: str) -> DataFrame:
    return R.orders_per_user(V.users(spark, sf), V.orders(spark, sf))


def orders_payments_sorted(spark: SparkSession, sf: str) -> DataFrame:
    return R.orders_payments_sorted(V.orders(spark, sf), V.payments(spark, sf))


def table_counts_union(spark: SparkSession, sf: str) -> DataFrame:
    return R.table_counts(_tables(spark, sf))


def table_counts_row(spark: SparkSession, sf: str) -> DataFrame:
    return R.table_counts_row(_tables(spark, sf))


def key_count(spark: SparkSession, sf: str) -> DataFrame:
    return R.key_count(V.orders(spark, sf), "user_id", "7")


def name_length_stats(spark: SparkSession, sf: str) -> DataFrame:
    return R.name_length_stats(V.users(spark, sf))


def name_length_top3(spark: SparkSession, sf: str) -> DataFrame:
    return R.longest_names(V.users(spark, sf))


def full_name_top3(spark: SparkSession, sf: str) -> DataFrame:
    return R.recent_full_names(V.users(spark, sf))


def amount_max(spark: SparkSession, sf: str) -> DataFrame:
    return R.largest_amount(V.orders(spark, sf))


def inventory_minmax(spark: SparkSession, sf: str) -> DataFrame:
    return R.balance_range(_balances(spark, sf))


def recent_orders(spark: SparkSession, sf: str) -> DataFrame:
    rows = R.recent_rows(V.orders(spark, sf), "placed_at", "order_id")
    return rows.select("order_id", "user_id", "total_amount", "currency")


def recent_payments(spark: SparkSession, sf: str) -> DataFrame:
    rows = R.recent_rows(V.payments(spark, sf), "settled_at", "payment_id")
    return rows.select("payment_id", "order_id", "status")


def items_limit(spark: SparkSession, sf: str) -> DataFrame:
    return R.first_items(V.order_items(spark, sf))


def inventory_sorted(spark: SparkSession, sf: str) -> DataFrame:
    """Balances, newest movement first."""
    moved = V.table(spark, sf, "lineitem").groupBy(F.col("l_partkey").cast("string").alias("sku")).agg(
        F.max("l_shipdate").alias("updated_at")
    )
    return R.newest_first(_balances(spark, sf).join(moved, "sku"), "updated_at", "sku")


def users_sorted(spark: SparkSession, sf: str) -> DataFrame:
    return R.newest_first(V.users(spark, sf).select("user_id", "created_at"), "created_at", "user_id")


# Ingest: parse, constraints, merges


def parse_route_counts(spark: SparkSession, sf: str) -> DataFrame:
    parsed = parse_events(V.topic_log(spark, sf))
    cause = F.coalesce("error_class", F.lit("none")).alias("error_class")
    return parsed.groupBy("event_type", cause, "counted").agg(F.count(F.lit(1)).alias("messages"))


def constraint_rejects(spark: SparkSession, sf: str) -> DataFrame:
    """Messages that break a length, decimal or integer limit by themselves, per limit."""
    parsed = staged(with_lane(parse_events(V.topic_log(spark, sf))))
    users = C.user_errors(route(parsed, S.USER_CREATED))
    orders = C.item_errors(C.order_errors(route(parsed, S.ORDER_PLACED)))
    orders = orders.withColumns(
        {"error": F.coalesce("error", "item_error"), "error_class": F.coalesce("error_class", "item_error_class")}
    )
    payments = C.payment_errors(route(parsed, S.PAYMENT_SETTLED))
    stock = C.stock_errors(M.with_delta(route(parsed, S.INVENTORY_ADJUSTED)))
    broken = None
    for kind in (users, orders, payments, stock):
        part = kind.filter("error IS NOT NULL").select("error", "error_class")
        broken = part if broken is None else broken.unionByName(part)
    return broken.groupBy("error", "error_class").agg(F.count(F.lit(1)).alias("messages"))


def _settled_users(spark: SparkSession, sf: str) -> I.Verdicts:
    parsed = staged(parse_events(V.user_log(spark, sf)))
    return I.settle_users(route(parsed, S.USER_CREATED), spark.createDataFrame([], S.USERS))


def _settled_documents(spark: SparkSession, sf: str) -> I.Settlement:
    return I.settle(V.document_log(spark, sf), M.empty_tables(spark))


def _settled_everything(spark: SparkSession, sf: str) -> I.Settlement:
    return I.settle(V.topic_log(spark, sf), M.empty_tables(spark))


def email_conflicts(spark: SparkSession, sf: str) -> DataFrame:
    """Messages refused because another user holds the address."""
    parsed = staged(parse_events(V.user_log(spark, sf)))
    users = route(parsed, S.USER_CREATED)
    refused = I.settle_users(users, spark.createDataFrame([], S.USERS)).rejected.filter("error_class = 'unique'")
    return users.join(refused.select("seq"), "seq").select("event_id", "user_id", "email")


def upsert_users(spark: SparkSession, sf: str) -> DataFrame:
    empty = spark.createDataFrame([], S.USERS)
    return _plain(M.merge_users(empty, _settled_users(spark, sf).accepted, _PROCESSED_AT))


def replay_idempotent(spark: SparkSession, sf: str) -> DataFrame:
    """The user log applied twice: the second pass meets the stored rows of the first."""
    first = _settled_users(spark, sf).accepted
    stored = staged(M.merge_users(spark.createDataFrame([], S.USERS), first, _PROCESSED_AT))
    parsed = staged(parse_events(V.user_log(spark, sf)))
    second = I.settle_users(route(parsed, S.USER_CREATED), stored).accepted
    return _plain(M.merge_users(stored, second, _PROCESSED_AT))


def upsert_orders(spark: SparkSession, sf: str) -> DataFrame:
    accepted = _settled_documents(spark, sf).orders.accepted
    return _plain(M.merge_orders(spark.createDataFrame([], S.ORDERS), accepted, _PROCESSED_AT))


def replace_items(spark: SparkSession, sf: str) -> DataFrame:
    accepted = _settled_documents(spark, sf).orders.accepted
    return M.replace_items(spark.createDataFrame([], S.ORDER_ITEMS), accepted)


def upsert_payments(spark: SparkSession, sf: str) -> DataFrame:
    accepted = _settled_documents(spark, sf).payments.accepted
    return _plain(M.merge_payments(spark.createDataFrame([], S.PAYMENTS), accepted, _PROCESSED_AT))


def inventory_balance(spark: SparkSession, sf: str) -> DataFrame:
    parsed = staged(judged_columns(with_lane(parse_events(V.stock_log(spark, sf)))))
    empty = spark.createDataFrame([], S.INVENTORY)
    accepted = I.settle_stock(route(parsed, S.INVENTORY_ADJUSTED), empty).accepted
    return _plain(M.merge_inventory(empty, accepted, _PROCESSED_AT))


def _rejected_as(settlement: I.Settlement, cause: Column) -> DataFrame:
    return settlement.rejected().filter(cause).select("event_id", "event_type", "error")


def fk_rejects(spark: SparkSession, sf: str) -> DataFrame:
    return _rejected_as(_settled_documents(spark, sf), F.col("error_class") == "foreign_key")


def order_atomic_reject(spark: SparkSession, sf: str) -> DataFrame:
    """Orders refused as a whole because of an item."""
    return _rejected_as(_settled_documents(spark, sf), F.col("error").startswith("failed to insert order item"))


_LATER = datetime(2025, 2, 1)


def _settled_again(spark: SparkSession, sf: str, table: str) -> DataFrame:
    """A table after a first batch and a second one that meets its rows."""
    tables = _settled_documents(spark, sf).merged(M.empty_tables(spark), _PROCESSED_AT)
    stored = {**M.empty_tables(spark), **{name: staged(tables[name]) for name in {"users", "orders", table}}}
    return _plain(I.settle(V.later_log(spark, sf), stored).merged(stored, _LATER)[table])


def merge_orders_again(spark: SparkSession, sf: str) -> DataFrame:
    return _settled_again(spark, sf, "orders")


def merge_items_again(spark: SparkSession, sf: str) -> DataFrame:
    return _settled_again(spark, sf, "order_items")


def merge_payments_again(spark: SparkSession, sf: str) -> DataFrame:
    return _settled_again(spark, sf, "payments")


def merge_inventory_again(spark: SparkSession, sf: str) -> DataFrame:
    """The stock log applied twice: every delivered message counts."""
    parsed = staged(judged_columns(with_lane(parse_events(V.stock_log(spark, sf)))))
    moves = route(parsed, S.INVENTORY_ADJUSTED)
    empty = spark.createDataFrame([], S.INVENTORY)
    stored = staged(M.merge_inventory(empty, I.settle_stock(moves, empty).accepted, _PROCESSED_AT))
    return _plain(M.merge_inventory(stored, I.settle_stock(moves, stored).accepted, _LATER))


def replay_onto_tables(spark: SparkSession, sf: str) -> DataFrame:
    """Orders after the log was applied to stored tables twice, each time from its start."""
    tables = EntityTables(spark, f"{shared_folder(spark)}/replayed-{uuid.uuid4().hex}", buckets=8)
    log = staged(V.document_log(spark, sf).select(*S.TOPIC.names))
    for now in (_PROCESSED_AT, _LATER):
        replay(tables, log, now)
    return _plain(tables.read("orders"))


def balance_refusals(spark: SparkSession, sf: str) -> DataFrame:
    """Per sku the refused movements and the balance that the others leave."""
    moves = staged(V.wide_moves(spark, sf))
    refused = refused_moves(moves, spark.createDataFrame([], S.INVENTORY).select("sku", "quantity"), rows_per_slice=1000)
    told = moves.join(refused.withColumn("refused", F.lit(1)), "seq", "left")
    counted = F.when(F.col("refused").isNull(), F.col("delta")).otherwise(0)
    return told.groupBy("sku").agg(F.count("refused").alias("refused"), F.sum(counted).alias("quantity"))


def email_chain(spark: SparkSession, sf: str) -> DataFrame:
    """Messages refused where users hand their address on in chains."""
    claims, holders = V.handed_on_addresses(spark, sf)
    refused = refused_claims(claims, holders, rows_per_slice=1000)
    return claims.join(refused, "seq", "left_semi").select("user_id", "email")


def parse_odd_messages(spark: SparkSession, sf: str) -> DataFrame:
    """Missing and null fields become zero values; what else is wrong is told apart."""
    parsed = parse_events(V.odd_messages(spark, sf))
    users = route(parsed, S.USER_CREATED).select("seq", "user_id", "email", F.col("created_at").cast("string").alias("created"))
    return parsed.select("seq", "event_id", "event_type", "error_class", "counted").join(users, "seq", "left")


def keyed_publish(spark: SparkSession, sf: str) -> DataFrame:
    """Every published message with its key, type and event id as found in the JSON text."""
    envelope = F.from_json("value", "eventId STRING, eventType STRING")
    sent = V.topic_log(spark, sf).withColumn("_e", envelope)
    return sent.select("key", "partition", F.col("_e.eventId").alias("event_id"), F.col("_e.eventType").alias("event_type"))


# Dead letters


def _dead_letters(settlement: I.Settlement) -> DataFrame:
    return D.to_dead_letters(settlement.rejected(), 0, _PROCESSED_AT)


def dlq_entries(spark: SparkSession, sf: str) -> DataFrame:
    entries = _dead_letters(_settled_everything(spark, sf))
    return entries.select("event_id", "error", "error_class", "retry_count", "partition")


def dlq_by_cause(spark: SparkSession, sf: str) -> DataFrame:
    return D.by_cause(_dead_letters(_settled_everything(spark, sf)))


def dlq_count(spark: SparkSession, sf: str) -> DataFrame:
    return D.count_entries(_dead_letters(_settled_everything(spark, sf)))


def _all_dead_letters(spark: SparkSession, sf: str) -> DataFrame:
    return staged(_dead_letters(_settled_everything(spark, sf)))


def dlq_range(spark: SparkSession, sf: str) -> DataFrame:
    """From the eleventh entry to the eleventh from the end."""
    return D.entry_range(_all_dead_letters(spark, sf), 10, -11).select("position", "partition", "offset", "event_id", "error_class")


def dlq_latest(spark: SparkSession, sf: str) -> DataFrame:
    return D.entry_at(_all_dead_letters(spark, sf), -1).select("position", "partition", "offset", "event_id", "error")


def dlq_new_since(spark: SparkSession, sf: str) -> DataFrame:
    """Entries beyond the first fifty, with a preview of the message."""
    lines = D.summary_lines(D.new_since(_all_dead_letters(spark, sf), 50))
    return lines.select("partition", "offset", "event_id", "error", "at", "original_preview")


def dlq_read_entries(spark: SparkSession, sf: str) -> DataFrame:
    """Entries read from their JSON form, of which every fifth is cut short and so skipped."""
    raw = D.to_json_entries(_all_dead_letters(spark, sf))
    cut = F.when(F.col("offset") % 5 == 0, F.expr("left(entry, length(entry) - 3)")).otherwise(F.col("entry"))
    return D.from_json_entries(raw.withColumn("entry", cut)).select("partition", "offset", "event_id", "error", "retry_count")


# Metrics


def events_processed_total(spark: SparkSession, sf: str) -> DataFrame:
    return X.processed_total(_settled_everything(spark, sf).outcomes())


def outcome_summary(spark: SparkSession, sf: str) -> DataFrame:
    return X.outcome_summary(_settled_everything(spark, sf).outcomes())


def events_per_second(spark: SparkSession, sf: str) -> DataFrame:
    return X.processed_per_tick(V.outcomes(spark, sf))


def events_per_hour(spark: SparkSession, sf: str) -> DataFrame:
    return X.processed_per_tick(V.outcomes(spark, sf), "1 hour")


def current_rate(spark: SparkSession, sf: str) -> DataFrame:
    return X.current_rate(X.processed_per_tick(V.outcomes(spark, sf)))


def rate_gauge(spark: SparkSession, sf: str) -> DataFrame:
    """The gauge at every minute; silent minutes keep the value before them."""
    return _plain(X.gauge(X.processed_per_tick(V.outcomes(spark, sf), "1 minute"), "1 minute"))


def latency_sketch_quantiles(spark: SparkSession, sf: str) -> DataFrame:
    """Quantiles merged from sketches of every hour, judged by the share of durations below and up to them."""
    durations = V.durations(spark, sf)
    found = X.sketched_quantiles(staged(X.latency_sketches(durations, ["operation"], "1 hour")), ["operation"], QUANTILES)
    value = F.col("duration_seconds").cast("double")
    judged = durations.join(staged(found), "operation").groupBy("operation", "observations")
    shares = [a for q in QUANTILES for a in (F.avg((value < F.col(q)).cast("int")).alias(f"{q}_low"), F.avg((value <= F.col(q)).cast("int")).alias(f"{q}_high"))]
    near = [(F.lit(p) >= F.col(f"{q}_low") - _RANK_ERROR) & (F.lit(p) <= F.col(f"{q}_high") + _RANK_ERROR) for q, p in QUANTILES.items()]
    return judged.agg(*shares).select("operation", "observations", *[n.alias(f"{q}_near") for q, n in zip(QUANTILES, near, strict=True)])


def latency_histogram(spark: SparkSession, sf: str) -> DataFrame:
    found = X.latency_histogram(V.durations(spark, sf), ["operation"])
    return found.withColumn("total_seconds", F.col("total_seconds").cast("double"))


def latency_by_stage(spark: SparkSession, sf: str) -> DataFrame:
    found = X.latency_histogram(V.durations(spark, sf), ["stage"])
    return found.withColumn("total_seconds", F.col("total_seconds").cast("double"))


def latency_quantiles(spark: SparkSession, sf: str) -> DataFrame:
    found = X.exact_quantiles(V.durations(spark, sf), ["operation"], QUANTILES)
    return found.select("operation", *[F.round(c, 6).alias(c) for c in QUANTILES])


def latency_bucket_p95(spark: SparkSession, sf: str) -> DataFrame:
    histogram = X.latency_histogram(V.durations(spark, sf), ["operation"])
    found = X.histogram_quantile(histogram, ["operation"], 0.95)
    return found.select("operation", F.round("quantile_seconds", 6).alias("quantile_seconds"))


def latency_mean(spark: SparkSession, sf: str) -> DataFrame:
    return X.mean_latency(V.durations(spark, sf), ["operation"])


# Log lines


def _lines(spark: SparkSession, sf: str) -> DataFrame:
    return L.parse_lines(V.log_lines(spark, sf))


def log_severity(spark: SparkSession, sf: str) -> DataFrame:
    return L.severity_counts(V.log_lines(spark, sf))


def log_severity_short(spark: SparkSession, sf: str) -> DataFrame:
    label = L.severity(F.col("value"), L.SHORT_SEVERITIES, L.OTHER_SHORT_SEVERITY)
    return V.log_lines(spark, sf).groupBy(label.alias("severity")).agg(F.count(F.lit(1)).alias("lines"))


def log_correlation(spark: SparkSession, sf: str) -> DataFrame:
    return _plain(L.correlation_summary(_lines(spark, sf)))


def log_correlated_lines(spark: SparkSession, sf: str) -> DataFrame:
    lines = L.correlated_lines(_lines(spark, sf))
    return _plain(lines.select(F.col("eventId").alias("event_id"), "level", "msg", "offset", "time"))


def log_tail(spark: SparkSession, sf: str) -> DataFrame:
    """The last lines of the file, whatever they hold."""
    return L.tail(V.log_lines(spark, sf), 100, ["line_no"]).select("line_no", "value")


def log_numbered(spark: SparkSession, sf: str) -> DataFrame:
    """Structured lines numbered along time."""
    timed = _lines(spark, sf).filter(F.col("time").isNotNull()).select("time", "offset")
    return L.numbered_lines(staged(timed), ["time", "offset"], rows_per_slice=1000).select("offset", F.col("line_no").alias("n"))


def log_files(spark: SparkSession, sf: str) -> DataFrame:
    """Lines read from text files."""
    path = f"{shared_folder(spark)}/lines-{uuid.uuid4().hex}"
    V.log_lines(spark, sf).select("value").write.text(path)
    return read_log_lines(spark, path).select("value", "level", "msg", "offset")


def log_retention(spark: SparkSession, sf: str) -> DataFrame:
    kept = L.retained(_lines(spark, sf), F.lit(datetime(2024, 1, 30, 12)))
    return _plain(kept.select("time", "offset", "level", "msg"))


QUERIES = {
    f.__name__: f
    for f in (
        user_last5_orders, user_lookup, order_with_payment, recent_users, orders_per_user, orders_payments_sorted,
        table_counts_union, table_counts_row, key_count, name_length_stats, name_length_top3, full_name_top3,
        amount_max, inventory_minmax, recent_orders, recent_payments, items_limit, inventory_sorted, users_sorted,
        parse_route_counts, constraint_rejects, email_conflicts, upsert_users, replay_idempotent, upsert_orders,
        replace_items, upsert_payments, inventory_balance, fk_rejects, order_atomic_reject, keyed_publish,
        dlq_entries, dlq_by_cause, dlq_count, dlq_range, dlq_latest, dlq_new_since, events_processed_total,
        outcome_summary, events_per_second, events_per_hour, current_rate, latency_histogram, latency_by_stage,
        latency_quantiles, latency_bucket_p95, latency_mean, log_severity, log_severity_short, log_correlation,
        log_correlated_lines, log_tail, log_retention, log_numbered, log_files, user_documents, order_documents,
        payment_struct, merge_orders_again, merge_items_again, merge_payments_again, merge_inventory_again,
        replay_onto_tables, balance_refusals, email_chain, parse_odd_messages, dlq_read_entries, rate_gauge,
        latency_sketch_quantiles,
    )
}

#: Queries without expected SQL; tests use brute-force versions.
QUERIES_WITHOUT_SQL: dict = {}
