"""Expected results of the named queries, as plain SQL over the sample tables.

The SQL states the outcome of the ingest rules directly from the key rules of the sample log; it does
not build or parse any message.
"""

from __future__ import annotations

# Bounds of the latency buckets and names of the operations.
BUCKETS = (0.005, 0.01, 0.025, 0.05, 0.1, 0.25, 0.5, 1.0, 2.5, 5.0, 10.0)
OPERATIONS = (
    "upsert_user", "upsert_order", "upsert_payment", "upsert_inventory", "get_user_orders", "get_order_payment", "get_recent_users",
)

# The rules of the sample log, stated here on their own: the first fault that applies to a key, and the text of a log line.
USER_FAULT = """CASE WHEN c_custkey % 53 = 11 THEN 'broken' WHEN c_custkey % 59 = 13 THEN 'long_name'
    WHEN c_custkey % 61 = 17 THEN 'clash' WHEN c_custkey % 67 = 19 THEN 'unknown' WHEN c_custkey % 71 = 23 THEN 'bad_time' ELSE 'ok' END"""
ORDER_FAULT = """CASE WHEN o_orderkey % 83 = 21 THEN 'orphan' WHEN o_orderkey % 89 = 34 THEN 'bad_item'
    WHEN o_orderkey % 97 = 55 THEN 'too_large' WHEN o_orderkey % 101 = 8 THEN 'text_amount' WHEN o_orderkey % 113 = 60 THEN 'early' ELSE 'ok' END"""
PAYMENT_FAULT = "CASE WHEN o_orderkey % 103 = 10 THEN 'no_order' WHEN o_orderkey % 107 = 50 THEN 'long_status' ELSE 'ok' END"
STOCK_FAULT = "CASE WHEN l_orderkey % 109 = 12 THEN 'too_big' ELSE 'ok' END"
LOG_MESSAGE = """CASE WHEN event_type = 'error' THEN 'Failed to process event' WHEN event_type = 'signup' THEN 'UserCreated received'
    WHEN event_type = 'purchase' THEN 'Message pushed to DLQ' WHEN event_type = 'click' AND event_id % 10 = 0 THEN 'Heartbeat'
    WHEN event_type = 'click' THEN 'Processed event' ELSE 'Message delivered successfully' END"""

_UPDATED = "TIMESTAMP '2025-01-01 00:00:00'"
_LATER = "TIMESTAMP '2025-02-01 00:00:00'"
_CREATED = "TIMESTAMP '2020-01-01 00:00:00' + to_minutes(c_custkey)"

_USERS = f"""users AS (SELECT CAST(c_custkey AS VARCHAR) AS user_id, 'c' || c_custkey || '@example.com' AS email,
    c_mktsegment AS first_name, c_name AS last_name, {_CREATED} AS created_at, {_UPDATED} AS updated_at FROM customer)"""
_ORDERS = f"""ords AS (SELECT CAST(o_orderkey AS VARCHAR) AS order_id, CAST(o_custkey AS VARCHAR) AS user_id,
    CAST(o_totalprice AS DECIMAL(10,2)) AS total_amount, 'USD' AS currency, o_orderdate AS placed_at,
    {_UPDATED} AS updated_at FROM orders)"""
_PAYMENTS = f"""pays AS (
    SELECT 'P' || o_orderkey AS payment_id, CAST(o_orderkey AS VARCHAR) AS order_id,
        CAST(o_totalprice AS DECIMAL(10,2)) AS amount, 'credit_card' AS payment_method, 'completed' AS status,
        o_orderdate + INTERVAL 1 DAY AS settled_at FROM orders WHERE o_orderstatus = 'F'
    UNION ALL
    SELECT 'R' || o_orderkey, CAST(o_orderkey AS VARCHAR), CAST(o_totalprice AS DECIMAL(10,2)), 'credit_card',
        'refunded', o_orderdate + INTERVAL 2 DAY FROM orders
    WHERE o_orderstatus = 'F' AND o_orderpriority = '1-URGENT')"""
_BALANCES = """bal AS (SELECT CAST(l_partkey AS VARCHAR) AS sku, CAST(sum(CASE WHEN l_returnflag = 'R'
    THEN l_quantity ELSE -l_quantity END) AS INTEGER) AS quantity, max(l_shipdate) AS updated_at
    FROM lineitem GROUP BY 1)"""

_COUNTS = """SELECT 'Users' AS table_name, count(*) AS rows FROM customer
    UNION ALL SELECT 'Orders', count(*) FROM orders
    UNION ALL SELECT 'Payments', count(*) FROM pays
    UNION ALL SELECT 'Inventory', count(DISTINCT l_partkey) FROM lineitem"""

# Messages of the sample log and the outcome of each.
_DOCUMENTS = f"""
uf AS (SELECT *, {USER_FAULT} AS fault FROM customer),
ua AS (SELECT uf.*, uf.fault = 'ok' OR (uf.fault = 'clash' AND coalesce(p.fault, 'none') <> 'ok') AS accepted
    FROM uf LEFT JOIN uf p ON p.c_custkey = uf.c_custkey - 1),
um AS (SELECT ua.*, v.version FROM ua JOIN (VALUES (0), (1), (2)) v(version) ON version = 0
    OR (version = 1 AND c_custkey % 50 = 7) OR (version = 2 AND c_custkey % 43 = 5)),
oa AS (SELECT o.*, {ORDER_FAULT} AS fault, coalesce(u.accepted, false) AS known_user
    FROM orders o LEFT JOIN ua u ON u.c_custkey = o.o_custkey),
om AS (SELECT oa.*, v.version FROM oa JOIN (VALUES (0), (2)) v(version) ON version = 0 OR o_orderkey % 47 = 3),
pa AS (SELECT oa.* EXCLUDE (fault), {PAYMENT_FAULT} AS fault, oa.fault = 'ok' AND oa.known_user AS known_order
    FROM oa WHERE o_orderstatus = 'F'),
pm AS (SELECT pa.*, v.version FROM pa JOIN (VALUES (0), (2)) v(version) ON version = 0 OR o_orderkey % 37 = 4),
doc AS (
    SELECT 0 AS part, 1000000000000000 + c_custkey * 10 + version AS off,
        CASE WHEN fault = 'broken' THEN '' ELSE 'U-' || c_custkey || CASE WHEN version = 2 THEN '-2' ELSE '' END END
            AS event_id,
        CASE fault WHEN 'broken' THEN '' WHEN 'unknown' THEN 'CustomerMerged' ELSE 'UserCreated' END AS event_type,
        CASE WHEN fault = 'broken' THEN 'Failed to parse base event: not a single JSON object'
            WHEN fault = 'bad_time' THEN 'Failed to parse base event: cannot decode timestamp'
            WHEN fault = 'unknown' THEN 'unknown event type: CustomerMerged'
            WHEN fault = 'long_name'
                THEN 'failed to upsert user: String or binary data would be truncated in column first_name'
            WHEN NOT accepted THEN 'failed to upsert user: UNIQUE KEY violation in column email' END AS error,
        CASE WHEN fault IN ('broken', 'bad_time') THEN 'parse' WHEN fault = 'unknown' THEN 'unknown_type'
            WHEN fault = 'long_name' THEN 'length' WHEN NOT accepted THEN 'unique' END AS error_class,
        '{{"eventId":"U-' || c_custkey || CASE WHEN version = 2 THEN '-2' ELSE '' END || '","eventType":"'
            || CASE WHEN fault = 'unknown' THEN 'CustomerMerged' ELSE 'UserCreated' END || '","timestamp":"'
            || CASE WHEN fault = 'bad_time' THEN 'not-' ELSE '' END || '2024-01-01T00:00:00.000000Z","userId":"'
            || c_custkey || '","email":"c' || CASE WHEN fault = 'clash' THEN c_custkey - 1 ELSE c_custkey END
            || '@example.com"' AS head
    FROM um
    UNION ALL
    SELECT 1, CASE WHEN fault = 'early' THEN 0 ELSE 2000000000000000 END + o_orderkey * 10 + version,
        'O-' || o_orderkey || CASE WHEN version = 2 THEN '-2' ELSE '' END, 'OrderPlaced',
        CASE WHEN fault = 'text_amount' THEN 'failed to unmarshal OrderPlaced event: cannot decode totalAmount'
            WHEN fault = 'too_large' THEN 'failed to upsert order: Arithmetic overflow error in column total_amount'
            WHEN fault IN ('orphan', 'early') OR NOT known_user
                THEN 'failed to upsert order: FOREIGN KEY conflict in column user_id'
            WHEN fault = 'bad_item'
                THEN 'failed to insert order item: String or binary data would be truncated in column sku' END,
        CASE WHEN fault = 'text_amount' THEN 'decode' WHEN fault = 'too_large' THEN 'numeric'
            WHEN fault IN ('orphan', 'early') OR NOT known_user THEN 'foreign_key'
            WHEN fault = 'bad_item' THEN 'length' END,
        '{{"eventId":"O-' || o_orderkey || CASE WHEN version = 2 THEN '-2' ELSE '' END
            || '","eventType":"OrderPlaced","timestamp":"2024-01-01T00:00:00.000000Z","orderId":"' || o_orderkey
            || '","userId":"' || CASE WHEN fault = 'orphan' THEN 'ghost-' ELSE '' END || o_custkey || '"'
    FROM om
    UNION ALL
    SELECT 2, 3000000000000000 + o_orderkey * 10 + version,
        CASE WHEN version = 2 THEN 'Q-' ELSE 'P-' END || o_orderkey, 'PaymentSettled',
        CASE WHEN fault = 'long_status'
                THEN 'failed to upsert payment: String or binary data would be truncated in column status'
            WHEN fault = 'no_order' OR NOT known_order
                THEN 'failed to upsert payment: FOREIGN KEY conflict in column order_id' END,
        CASE WHEN fault = 'long_status' THEN 'length' WHEN fault = 'no_order' OR NOT known_order
            THEN 'foreign_key' END,
        '{{"eventId":"' || CASE WHEN version = 2 THEN 'Q-' ELSE 'P-' END || o_orderkey
            || '","eventType":"PaymentSettled","timestamp":"2024-01-01T00:00:00.000000Z","paymentId":"'
            || CASE WHEN version = 2 THEN 'Q' ELSE 'P' END || o_orderkey || '"'
    FROM pm)"""
_STOCK_ERROR = "failed to upsert inventory: Arithmetic overflow error in column quantity"
_ALL = f"""{_DOCUMENTS},
every AS (
    SELECT part, off, event_id, event_type, error, error_class, head FROM doc
    UNION ALL
    SELECT 3, 4000000000000000 + ('0x' || left(md5(concat_ws('|', l_orderkey, l_linenumber, l_partkey, l_suppkey, CAST(l_quantity AS BIGINT),
            CAST(round(l_extendedprice * 100) AS BIGINT), CAST(l_shipdate AS DATE) - DATE '1970-01-01')), 15))::BIGINT, 'I-' || l_orderkey || '-' || l_linenumber || '-' || l_partkey || '-' || l_suppkey, 'InventoryAdjusted',
        CASE WHEN {STOCK_FAULT} = 'too_big' THEN '{_STOCK_ERROR}' END,
        CASE WHEN {STOCK_FAULT} = 'too_big' THEN 'numeric' END,
        '{{"eventId":"I-' || l_orderkey || '-' || l_linenumber || '-' || l_partkey || '-' || l_suppkey
            || '","eventType":"InventoryAdjusted","timestamp":"2024-01-01T00:00:00.000000Z","sku":"' || l_partkey || '"'
    FROM lineitem),
placed AS (SELECT *, row_number() OVER (ORDER BY part, off) - 1 AS position, count(*) OVER () AS n
    FROM every WHERE error IS NOT NULL)"""

_UPSERTED_USERS = f"""WITH {_DOCUMENTS} SELECT CAST(c_custkey AS VARCHAR) AS user_id,
    'c' || CASE WHEN fault = 'clash' THEN c_custkey - 1 ELSE c_custkey END || '@example.com' AS email,
    c_mktsegment AS first_name, c_name || CASE WHEN c_custkey % 43 = 5 THEN ' II' ELSE '' END AS last_name,
    {_CREATED} AS created_at, {_UPDATED} AS updated_at FROM ua WHERE accepted"""

_DURATIONS = f"""dur AS (SELECT [{", ".join(f"'{o}'" for o in OPERATIONS)}][event_id % {len(OPERATIONS)} + 1] AS operation,
    CASE WHEN event_id % 2 = 0 THEN 'kafka_produce' ELSE 'kafka_consume' END AS stage,
    CAST(value AS DECIMAL(12,2)) * CAST(0.01 AS DECIMAL(2,2)) AS d FROM events)"""


def _histogram(by: str) -> str:
    parts = [
        f"""SELECT {by}, '{b:g}' AS le, count(*) FILTER (CAST(d AS DOUBLE) <= CAST({b} AS DOUBLE)) AS bucket_count,
        CAST(sum(d) AS DOUBLE) AS total_seconds, count(*) AS observations FROM dur GROUP BY {by}"""
        for b in BUCKETS
    ]
    parts.append(
        f"""SELECT {by}, '+Inf', count(*), CAST(sum(d) AS DOUBLE), count(*) FROM dur GROUP BY {by}"""
    )
    return " UNION ALL ".join(parts)


def _ticks(unit: str) -> str:
    return f"""SELECT date_trunc('{unit}', ts) AS tick, event_type, count(*) AS events FROM events
        WHERE event_type <> 'error' GROUP BY 1, 2"""


_LINES = f"""lines AS (SELECT *, CASE WHEN event_type = 'error' THEN 'error' ELSE 'info' END AS level,
        {LOG_MESSAGE} AS msg, event_type = 'view' AND event_id % 10 = 5 AS is_plain FROM events),
    texts AS (SELECT CASE WHEN is_plain THEN 'plain text line ' || event_id ELSE
        '{{"level":"' || level || '","msg":"' || msg || '","eventId":"E-' || user_id || '","partition":0,"offset":'
        || event_id || ',"time":"' || strftime(ts, '%Y-%m-%dT%H:%M:%S.%f') || 'Z"}}' END AS value FROM lines)"""

EXPECTED = {
    "user_last5_orders": f"""WITH {_USERS}, {_ORDERS}, ranked AS (SELECT *, row_number() OVER
        (PARTITION BY user_id ORDER BY placed_at DESC, order_id) AS r FROM ords)
        SELECT u.user_id, u.email, u.first_name, u.last_name, u.created_at, o.order_id, o.total_amount, o.currency,
            o.placed_at, CAST(o.r AS INTEGER) AS rank
        FROM users u LEFT JOIN ranked o ON o.user_id = u.user_id AND o.r <= 5""",
    "user_lookup": f"""WITH {_USERS}, {_ORDERS}, ranked AS (SELECT *, row_number() OVER
        (PARTITION BY user_id ORDER BY placed_at DESC, order_id) AS r FROM ords)
        SELECT u.user_id, u.email, CAST(count(o.order_id) AS INTEGER) AS n_orders,
            max(CASE WHEN r = 1 THEN o.order_id END) AS newest_order_id
        FROM users u LEFT JOIN ranked o ON o.user_id = u.user_id AND o.r <= 5
        WHERE u.user_id IN (SELECT CAST(user_id AS VARCHAR) FROM events) GROUP BY 1, 2""",
    "order_with_payment": f"""WITH {_ORDERS}, {_PAYMENTS}, ranked AS (SELECT *, row_number() OVER
        (PARTITION BY order_id ORDER BY settled_at DESC, payment_id) AS r FROM pays)
        SELECT o.order_id, o.user_id, o.total_amount, o.currency, o.placed_at, p.payment_id, p.amount,
            p.payment_method, p.status, p.settled_at
        FROM ords o LEFT JOIN ranked p ON p.order_id = o.order_id AND p.r = 1""",
    "recent_users": f"WITH {_USERS} SELECT * FROM users ORDER BY created_at DESC, user_id LIMIT 100",
    "orders_per_user": f"""WITH {_USERS}, {_ORDERS} SELECT u.user_id, u.email, count(o.order_id) AS order_count
        FROM users u LEFT JOIN ords o ON o.user_id = u.user_id GROUP BY 1, 2""",
    "orders_payments_sorted": f"""WITH {_ORDERS}, {_PAYMENTS}
        SELECT o.order_id, o.total_amount, p.payment_id, p.status, o.placed_at
        FROM ords o LEFT JOIN pays p ON p.order_id = o.order_id ORDER BY o.placed_at DESC, o.order_id, p.payment_id""",
    "table_counts_union": f"WITH {_PAYMENTS} {_COUNTS}",
    "table_counts_row": f"""WITH {_PAYMENTS} SELECT (SELECT count(*) FROM customer) AS "Users",
        (SELECT count(*) FROM orders) AS "Orders", (SELECT count(*) FROM pays) AS "Payments",
        (SELECT count(DISTINCT l_partkey) FROM lineitem) AS "Inventory" """,
    "key_count": f"WITH {_ORDERS} SELECT count(*) AS rows FROM ords WHERE user_id = '7'",
    "name_length_stats": """SELECT CAST(min(length(rtrim(c_mktsegment))) AS INTEGER) AS min_length,
        CAST(max(length(rtrim(c_mktsegment))) AS INTEGER) AS max_length FROM customer""",
    "name_length_top3": f"""WITH {_USERS} SELECT user_id, email, CAST(length(rtrim(first_name)) AS INTEGER)
        AS name_length FROM users ORDER BY name_length DESC, user_id LIMIT 3""",
    "full_name_top3": f"""WITH {_USERS} SELECT user_id, email, first_name || ' ' || last_name AS name FROM users
        ORDER BY created_at DESC, user_id LIMIT 3""",
    "amount_max": "SELECT max(CAST(o_totalprice AS DECIMAL(10,2))) AS max_total_amount FROM orders",
    "inventory_minmax": f"""WITH {_BALANCES} SELECT min(quantity) AS min_quantity, max(quantity) AS max_quantity
        FROM bal""",
    "recent_orders": f"""WITH {_ORDERS} SELECT order_id, user_id, total_amount, currency FROM ords
        ORDER BY placed_at DESC, order_id LIMIT 5""",
    "recent_payments": f"""WITH {_PAYMENTS} SELECT payment_id, order_id, status FROM pays
        ORDER BY settled_at DESC, payment_id LIMIT 5""",
    "items_limit": """SELECT CAST(l_orderkey AS VARCHAR) AS order_id, l_linenumber AS pos, CAST(l_partkey AS VARCHAR)
        AS sku, CAST(l_quantity AS INTEGER) AS quantity, CAST(l_extendedprice AS DECIMAL(10,2)) AS price
        FROM lineitem ORDER BY order_id, pos, sku, quantity, price LIMIT 10""",
    "inventory_sorted": f"WITH {_BALANCES} SELECT sku, quantity, updated_at FROM bal ORDER BY updated_at DESC, sku",
    "users_sorted": f"WITH {_USERS} SELECT user_id, created_at FROM users ORDER BY created_at DESC, user_id",
    "parse_route_counts": f"""WITH {_ALL} SELECT event_type, CASE WHEN error_class IN ('parse', 'unknown_type', 'decode')
        THEN error_class ELSE 'none' END AS error_class, coalesce(error_class, '') <> 'parse' AS counted,
        count(*) AS messages FROM every GROUP BY 1, 2, 3""",
    "constraint_rejects": f"""WITH {_ALL}, limits AS (
        SELECT error, error_class FROM every WHERE error_class IN ('length', 'numeric')
        UNION ALL
        SELECT 'failed to insert order item: String or binary data would be truncated in column sku', 'length'
        FROM om WHERE fault = 'bad_item' AND NOT known_user)
        SELECT error, error_class, count(*) AS messages FROM limits GROUP BY 1, 2""",
    "email_conflicts": f"""WITH {_DOCUMENTS} SELECT 'U-' || c_custkey || CASE WHEN version = 2 THEN '-2' ELSE '' END
        AS event_id, CAST(c_custkey AS VARCHAR) AS user_id, 'c' || (c_custkey - 1) || '@example.com' AS email
        FROM um WHERE fault = 'clash' AND NOT accepted""",
    "upsert_users": _UPSERTED_USERS,
    "replay_idempotent": _UPSERTED_USERS,
    "upsert_orders": f"""WITH {_DOCUMENTS} SELECT CAST(o_orderkey AS VARCHAR) AS order_id,
        CAST(o_custkey AS VARCHAR) AS user_id,
        CAST(o_totalprice + CASE WHEN o_orderkey % 47 = 3 THEN 1 ELSE 0 END AS DECIMAL(10,2)) AS total_amount,
        'USD' AS currency, o_orderdate AS placed_at, {_UPDATED} AS updated_at
        FROM oa WHERE fault = 'ok' AND known_user""",
    "replace_items": f"""WITH {_DOCUMENTS} SELECT CAST(o_orderkey AS VARCHAR) AS order_id, CAST(i - 1 AS INTEGER) AS pos,
        'SKU-' || ((o_custkey * 7 + i) % 500) AS sku, CAST(i AS INTEGER) AS quantity,
        CAST(o_totalprice AS DECIMAL(10,2)) AS price
        FROM oa JOIN (VALUES (1), (2), (3)) t(i) ON i <= o_orderkey % 4
        WHERE fault = 'ok' AND known_user AND o_orderkey % 47 <> 3""",
    "upsert_payments": f"""WITH {_DOCUMENTS} SELECT CASE WHEN version = 2 THEN 'Q' ELSE 'P' END || o_orderkey AS payment_id,
        CAST(o_orderkey AS VARCHAR) AS order_id, CAST(o_totalprice AS DECIMAL(10,2)) AS amount, 'USD' AS currency,
        'credit_card' AS payment_method, CASE WHEN version = 2 THEN 'refunded' ELSE 'completed' END AS status,
        o_orderdate + CASE WHEN version = 2 THEN INTERVAL 2 DAY ELSE INTERVAL 1 DAY END AS settled_at,
        {_UPDATED} AS updated_at FROM pm WHERE fault = 'ok' AND known_order""",
    "inventory_balance": f"""SELECT CAST(l_partkey AS VARCHAR) AS sku, CAST(sum(CASE WHEN l_returnflag = 'R'
        THEN l_quantity ELSE -l_quantity END) AS INTEGER) AS quantity, {_UPDATED} AS updated_at
        FROM lineitem WHERE {STOCK_FAULT} = 'ok' GROUP BY 1""",
    "fk_rejects": f"""WITH {_DOCUMENTS} SELECT event_id, event_type, error FROM doc
        WHERE error_class = 'foreign_key'""",
    "order_atomic_reject": f"""WITH {_DOCUMENTS} SELECT event_id, event_type, error FROM doc
        WHERE error LIKE 'failed to insert order item%'""",
    "keyed_publish": f"""WITH {_ALL}
        SELECT CAST(c_custkey AS VARCHAR) AS key, 0 AS partition,
            CASE WHEN fault <> 'broken' THEN 'U-' || c_custkey || CASE WHEN version = 2 THEN '-2' ELSE '' END END
                AS event_id,
            CASE WHEN fault = 'unknown' THEN 'CustomerMerged' WHEN fault <> 'broken' THEN 'UserCreated' END AS event_type
        FROM um
        UNION ALL SELECT CAST(o_orderkey AS VARCHAR), 1, 'O-' || o_orderkey || CASE WHEN version = 2 THEN '-2' ELSE ''
            END, 'OrderPlaced' FROM om
        UNION ALL SELECT CASE WHEN fault = 'no_order' THEN 'missing-' ELSE '' END || o_orderkey, 2,
            CASE WHEN version = 2 THEN 'Q-' ELSE 'P-' END || o_orderkey, 'PaymentSettled' FROM pm
        UNION ALL SELECT split_part(event_id, '-', 4), 3, event_id, 'InventoryAdjusted' FROM every WHERE part = 3""",
    "dlq_entries": f"""WITH {_ALL} SELECT event_id, error, error_class, 0 AS retry_count, part AS partition
        FROM every WHERE error IS NOT NULL""",
    "dlq_by_cause": f"""WITH {_ALL} SELECT error_class, count(*) AS entries FROM every
        WHERE error IS NOT NULL GROUP BY 1""",
    "dlq_count": f"WITH {_ALL} SELECT count(*) AS dlq_entries FROM every WHERE error IS NOT NULL",
    "dlq_range": f"""WITH {_ALL} SELECT position, part AS partition, off AS "offset", event_id, error_class FROM placed
        WHERE position BETWEEN 10 AND n - 11""",
    "dlq_latest": f"""WITH {_ALL} SELECT position, part AS partition, off AS "offset", event_id, error FROM placed
        WHERE position = n - 1""",
    "dlq_new_since": f"""WITH {_ALL} SELECT part AS partition, off AS "offset", event_id, error, '2025-01-01T00:00:00Z' AS at,
        left(head, 100) || '...' AS original_preview FROM placed WHERE position >= 50""",
    "events_processed_total": f"""WITH {_ALL} SELECT event_type, CASE WHEN error IS NULL THEN 'success' ELSE 'error' END
        AS status, count(*) AS events FROM every WHERE coalesce(error_class, '') <> 'parse' GROUP BY 1, 2""",
    "outcome_summary": f"""WITH {_ALL}, seen AS (SELECT * FROM every WHERE coalesce(error_class, '') <> 'parse'),
        both_kinds AS (SELECT event_type, error FROM seen UNION ALL SELECT 'ALL', error FROM seen)
        SELECT event_type, count(*) FILTER (error IS NULL) AS succeeded, count(error) AS failed,
            CAST(count(*) FILTER (error IS NULL) AS DOUBLE) / count(*) AS success_rate FROM both_kinds GROUP BY 1""",
    "events_per_second": _ticks("second"),
    "events_per_hour": _ticks("hour"),
    "current_rate": f"""WITH ticks AS ({_ticks("second")}) SELECT event_type, arg_max(events, tick) AS events,
        max(tick) AS tick FROM ticks GROUP BY 1""",
    "rate_gauge": f"""WITH ticks AS ({_ticks("minute")}),
        every_tick AS (SELECT event_type, unnest(generate_series(min(tick), (SELECT max(tick) FROM ticks), INTERVAL 1 MINUTE)) AS tick FROM ticks GROUP BY 1)
        SELECT e.event_type, e.tick, t.events, t.tick < e.tick AS silent
        FROM every_tick e ASOF JOIN ticks t ON e.event_type = t.event_type AND e.tick >= t.tick""",
    "latency_sketch_quantiles": f"""WITH {_DURATIONS} SELECT operation, count(*) AS observations, true AS p50_near, true AS p95_near,
        true AS p99_near FROM dur GROUP BY 1""",
    "latency_histogram": f"WITH {_DURATIONS} {_histogram('operation')}",
    "latency_by_stage": f"WITH {_DURATIONS} {_histogram('stage')}",
    "latency_quantiles": f"""WITH {_DURATIONS} SELECT operation,
        round(quantile_cont(CAST(d AS DOUBLE), 0.5), 6) AS p50, round(quantile_cont(CAST(d AS DOUBLE), 0.95), 6) AS p95,
        round(quantile_cont(CAST(d AS DOUBLE), 0.99), 6) AS p99 FROM dur GROUP BY 1""",
    "latency_bucket_p95": f"""WITH {_DURATIONS}, hist AS ({_histogram('operation')}),
        steps AS (SELECT operation, CASE WHEN le = '+Inf' THEN NULL ELSE CAST(le AS DOUBLE) END AS upper, bucket_count,
            observations, 0.95::DOUBLE * observations AS target FROM hist),
        edged AS (SELECT *, coalesce(lag(upper) OVER w, 0) AS lower, coalesce(lag(bucket_count) OVER w, 0) AS below
            FROM steps WINDOW w AS (PARTITION BY operation ORDER BY upper ASC NULLS LAST)),
        hit AS (SELECT *, row_number() OVER (PARTITION BY operation ORDER BY upper ASC NULLS LAST) AS r
            FROM edged WHERE bucket_count >= target AND bucket_count > below)
        SELECT operation, round(CASE WHEN upper IS NULL THEN lower
            ELSE lower + (upper - lower) * (target - below) / (bucket_count - below) END, 6) AS quantile_seconds
        FROM hit WHERE r = 1""",
    "latency_mean": f"""WITH {_DURATIONS} SELECT operation, count(*) AS observations,
        CAST(sum(d) AS DOUBLE) / count(*) AS mean_seconds FROM dur GROUP BY 1""",
    "log_severity": f"""WITH {_LINES} SELECT CASE WHEN regexp_matches(value, 'error|"level":"error"', 'i') THEN 'ERROR'
        WHEN regexp_matches(value, 'UserCreated|OrderPlaced|PaymentSettled|InventoryAdjusted', 'i') THEN 'EVENT'
        WHEN regexp_matches(value, 'DLQ|failed|Sent to DLQ', 'i') THEN 'DLQ'
        WHEN regexp_matches(value, 'Processed event|successfully', 'i') THEN 'OK'
        WHEN regexp_matches(value, 'eventId', 'i') THEN 'INFO' ELSE 'DEBUG' END AS severity, count(*) AS lines
        FROM texts GROUP BY 1""",
    "log_severity_short": f"""WITH {_LINES} SELECT CASE WHEN regexp_matches(value, 'error', 'i') THEN 'ERROR'
        WHEN regexp_matches(value, 'UserCreated|OrderPlaced|PaymentSettled|InventoryAdjusted', 'i') THEN 'EVENT'
        WHEN regexp_matches(value, 'DLQ|failed', 'i') THEN 'DLQ'
        WHEN regexp_matches(value, 'Processed event', 'i') THEN 'OK' ELSE 'INFO' END AS severity, count(*) AS lines
        FROM texts GROUP BY 1""",
    "log_correlation": f"""WITH {_LINES} SELECT 'E-' || user_id AS event_id, count(*) AS lines,
        count(*) FILTER (level = 'error') AS errors, min(ts) AS first_time, max(ts) AS last_time,
        arg_min(msg, (ts, msg)) AS first_msg, arg_max(msg, (ts, msg)) AS last_msg
        FROM lines WHERE NOT is_plain GROUP BY 1""",
    "log_correlated_lines": f"""WITH {_LINES} SELECT 'E-' || user_id AS event_id, level, msg, event_id AS "offset",
        ts AS time FROM lines WHERE NOT is_plain""",
    "log_tail": f"""WITH {_LINES}, kept AS (SELECT event_id AS line_no, CASE WHEN is_plain THEN 'plain text line ' || event_id ELSE
        '{{"level":"' || level || '","msg":"' || msg || '","eventId":"E-' || user_id || '","partition":0,"offset":'
        || event_id || ',"time":"' || strftime(ts, '%Y-%m-%dT%H:%M:%S.%f') || 'Z"}}' END AS value FROM lines)
        SELECT line_no, value FROM kept ORDER BY line_no DESC LIMIT 100""",
    "log_numbered": f"""WITH {_LINES} SELECT event_id AS "offset", row_number() OVER (ORDER BY ts, event_id) - 1 AS n
        FROM lines WHERE NOT is_plain""",
    "log_files": f"""WITH {_LINES} SELECT CASE WHEN is_plain THEN 'plain text line ' || event_id ELSE
        '{{"level":"' || level || '","msg":"' || msg || '","eventId":"E-' || user_id || '","partition":0,"offset":'
        || event_id || ',"time":"' || strftime(ts, '%Y-%m-%dT%H:%M:%S.%f') || 'Z"}}' END AS value,
        CASE WHEN NOT is_plain THEN level END AS level, CASE WHEN NOT is_plain THEN msg END AS msg,
        CASE WHEN NOT is_plain THEN event_id END AS "offset" FROM lines""",
    "log_retention": f"""WITH {_LINES} SELECT CASE WHEN NOT is_plain THEN ts END AS time,
        CASE WHEN NOT is_plain THEN event_id END AS "offset", CASE WHEN NOT is_plain THEN level END AS level,
        CASE WHEN NOT is_plain THEN msg END AS msg FROM lines WHERE is_plain OR ts >= TIMESTAMP '2024-01-29 12:00:00'""",
    "user_documents": f"""WITH {_USERS}, {_ORDERS}, ranked AS (SELECT *, row_number() OVER
        (PARTITION BY user_id ORDER BY placed_at DESC, order_id) AS r FROM ords)
        SELECT u.user_id, 'userId,email,firstName,lastName,createdAt,updatedAt,orders' AS fields, u.email,
            CAST(count(o.order_id) AS INTEGER) AS n_orders,
            CASE WHEN count(o.order_id) > 0 THEN 'orderId,userId,totalAmount,currency,placedAt,updatedAt' END AS order_fields,
            max(CASE WHEN r = 1 THEN o.order_id END) AS newest_order_id,
            max(CASE WHEN r = 1 THEN CAST(o.total_amount AS DOUBLE) END) AS newest_amount
        FROM users u LEFT JOIN ranked o ON o.user_id = u.user_id AND o.r <= 5 GROUP BY u.user_id, u.email""",
    "order_documents": f"""WITH {_ORDERS}, {_PAYMENTS}, ranked AS (SELECT *, row_number() OVER
        (PARTITION BY order_id ORDER BY settled_at DESC, payment_id) AS r FROM pays)
        SELECT o.order_id, 'orderId,userId,totalAmount,currency,placedAt,updatedAt' || CASE WHEN p.order_id IS NULL THEN '' ELSE ',payment' END
            AS fields, p.payment_id, p.status, CAST(p.amount AS DOUBLE) AS amount
        FROM ords o LEFT JOIN ranked p ON p.order_id = o.order_id AND p.r = 1""",
    "payment_struct": f"""WITH {_ORDERS}, {_PAYMENTS}, ranked AS (SELECT *, row_number() OVER
        (PARTITION BY order_id ORDER BY settled_at DESC, payment_id) AS r FROM pays)
        SELECT o.order_id, p.order_id IS NULL AS unpaid, p.payment_id, p.status
        FROM ords o LEFT JOIN ranked p ON p.order_id = o.order_id AND p.r = 1""",
    "merge_orders_again": f"""WITH {_DOCUMENTS} SELECT CAST(o_orderkey AS VARCHAR) AS order_id, CAST(o_custkey AS VARCHAR) AS user_id,
        CAST(o_totalprice + CASE WHEN o_orderkey % 3 = 0 THEN 5 WHEN o_orderkey % 47 = 3 THEN 1 ELSE 0 END AS DECIMAL(10,2)) AS total_amount,
        CASE WHEN o_orderkey % 3 = 0 THEN 'EUR' ELSE 'USD' END AS currency,
        CASE WHEN fault = 'ok' THEN o_orderdate ELSE o_orderdate + INTERVAL 9 DAY END AS placed_at,
        CASE WHEN o_orderkey % 3 = 0 THEN {_LATER} ELSE {_UPDATED} END AS updated_at
        FROM oa WHERE known_user AND (fault = 'ok' OR o_orderkey % 3 = 0)""",
    "merge_items_again": f"""WITH {_DOCUMENTS} SELECT CAST(o_orderkey AS VARCHAR) AS order_id, CAST(i - 1 AS INTEGER) AS pos,
        'SKU-' || ((o_custkey * 7 + i) % 500) AS sku, CAST(i AS INTEGER) AS quantity, CAST(o_totalprice AS DECIMAL(10,2)) AS price
        FROM oa JOIN (VALUES (1), (2), (3)) t(i) ON i <= o_orderkey % 4
        WHERE fault = 'ok' AND known_user AND o_orderkey % 47 <> 3 AND o_orderkey % 3 <> 0
        UNION ALL SELECT CAST(o_orderkey AS VARCHAR), 0, 'SKU-later', 9, CAST(1.5 AS DECIMAL(10,2)) FROM oa
        WHERE known_user AND o_orderkey % 3 = 0""",
    "merge_payments_again": f"""WITH {_DOCUMENTS}, stored AS (SELECT CASE WHEN version = 2 THEN 'Q' ELSE 'P' END || o_orderkey AS payment_id,
            o_orderkey, CAST(o_totalprice AS DECIMAL(10,2)) AS amount, 'USD' AS currency, 'credit_card' AS payment_method,
            CASE WHEN version = 2 THEN 'refunded' ELSE 'completed' END AS status,
            o_orderdate + CASE WHEN version = 2 THEN INTERVAL 2 DAY ELSE INTERVAL 1 DAY END AS settled_at, {_UPDATED} AS updated_at
            FROM pm WHERE fault = 'ok' AND known_order),
        later AS (SELECT 'P' || o_orderkey AS payment_id, o_orderkey, CAST(o_totalprice + 5 AS DECIMAL(10,2)) AS amount, 'EUR' AS currency,
            'voucher' AS payment_method, 'refunded' AS status, o_orderdate + INTERVAL 9 DAY AS settled_at, {_LATER} AS updated_at
            FROM oa WHERE o_orderstatus = 'F' AND known_user AND o_orderkey % 3 = 0)
        SELECT payment_id, CAST(o_orderkey AS VARCHAR) AS order_id, amount, currency, payment_method, status, settled_at, updated_at
        FROM (SELECT * FROM later UNION ALL SELECT * FROM stored WHERE payment_id NOT IN (SELECT payment_id FROM later))""",
    "merge_inventory_again": f"""SELECT CAST(l_partkey AS VARCHAR) AS sku, CAST(2 * sum(CASE WHEN l_returnflag = 'R'
        THEN l_quantity ELSE -l_quantity END) AS INTEGER) AS quantity, {_LATER} AS updated_at
        FROM lineitem WHERE {STOCK_FAULT} = 'ok' GROUP BY 1""",
    "replay_onto_tables": f"""WITH {_DOCUMENTS} SELECT CAST(o_orderkey AS VARCHAR) AS order_id, CAST(o_custkey AS VARCHAR) AS user_id,
        CAST(o_totalprice + CASE WHEN o_orderkey % 47 = 3 THEN 1 ELSE 0 END AS DECIMAL(10,2)) AS total_amount,
        'USD' AS currency, o_orderdate AS placed_at, {_LATER} AS updated_at FROM oa WHERE fault IN ('ok', 'early') AND known_user""",
    "balance_refusals": """WITH moves AS (SELECT user_id, event_id, CAST(round(value * 100) AS BIGINT) * 100000
            * CASE WHEN event_type IN ('view', 'click', 'signup') THEN 1 ELSE -1 END AS d FROM events),
        played AS (SELECT user_id, list_reduce(list({'b': 0::BIGINT, 'r': 0::BIGINT, 'd': d} ORDER BY event_id),
            lambda a, x: CASE WHEN a.b + x.d BETWEEN -2147483648 AND 2147483647 THEN {'b': a.b + x.d, 'r': a.r, 'd': 0::BIGINT}
                ELSE {'b': a.b, 'r': a.r + 1, 'd': 0::BIGINT} END, {'b': 0::BIGINT, 'r': 0::BIGINT, 'd': 0::BIGINT}) AS p
            FROM moves GROUP BY user_id)
        SELECT CAST(user_id AS VARCHAR) AS sku, p.r AS refused, p.b AS quantity FROM played""",
    "email_chain": """WITH c AS (SELECT c_custkey AS c, c_custkey // 6 AS chain, c_custkey % 6 AS place FROM customer)
        SELECT CAST(c AS VARCHAR) AS user_id, CASE WHEN place < 5 THEN 'own' || (c + 1) ELSE 'held' || chain END AS email
        FROM c WHERE chain % 3 = 0 AND chain * 6 + 5 <= (SELECT max(c) FROM c)""",
    "parse_odd_messages": """WITH m AS (SELECT c_custkey AS seq, c_custkey % 9 AS kind FROM customer)
        SELECT seq, CASE WHEN kind IN (1, 2, 3, 6) THEN '' ELSE 'Z-' || seq END AS event_id,
            CASE WHEN kind IN (1, 2, 3) THEN '' WHEN kind = 4 THEN 'InventoryAdjusted' ELSE 'UserCreated' END AS event_type,
            CASE WHEN kind IN (1, 2) THEN 'unknown_type' WHEN kind = 3 THEN 'parse' WHEN kind IN (4, 7) THEN 'decode' END AS error_class,
            kind <> 3 AS counted,
            CASE WHEN kind = 0 THEN '' WHEN kind IN (5, 6) THEN CAST(seq AS VARCHAR) WHEN kind = 8 THEN 'u' || seq END AS user_id,
            CASE WHEN kind IN (0, 5, 6, 8) THEN '' END AS email, CASE WHEN kind IN (0, 5, 6, 8) THEN '0001-01-01 00:00:00' END AS created
        FROM m""",
    "dlq_read_entries": f"""WITH {_ALL} SELECT part AS partition, off AS "offset", event_id, error, 0 AS retry_count FROM every
        WHERE error IS NOT NULL AND off % 5 <> 0""",
}
