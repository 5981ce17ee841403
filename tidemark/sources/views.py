"""The order-event model laid over the sample tables: entity tables, a topic log, durations and log lines.

Every view reads a whole sample table and is a plain projection of it. The log carries faults and
repeated deliveries whose kind follows from the row's key, so that each rule has something to reject
and the expected outcome can be stated in SQL.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark import schemas as S
from tidemark.operators.metrics import OPERATIONS
from tidemark.operators.publish import to_messages

UPDATED_AT = "timestamp_ntz'2025-01-01 00:00:00'"
_BASE = "timestamp_ntz'2020-01-01 00:00:00'"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _spread(df: DataFrame) -> DataFrame:
    """Give every core a share of a table that is too small to be split by its files.

    Building and parsing messages is work for the processor; a table of many files is left as it is.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df


def users(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "customer").selectExpr(
        "string(c_custkey) AS user_id",
        "concat('c', c_custkey, '@example.com') AS email",
        "c_mktsegment AS first_name",
        "c_name AS last_name",
        f"{_BASE} + c_custkey * INTERVAL '1' MINUTE AS created_at",
        f"{UPDATED_AT} AS updated_at",
    )


def orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").selectExpr(
        "string(o_orderkey) AS order_id",
        "string(o_custkey) AS user_id",
        "CAST(o_totalprice AS DECIMAL(10,2)) AS total_amount",
        "'USD' AS currency",
        "o_orderdate AS placed_at",
        f"{UPDATED_AT} AS updated_at",
    )


def order_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "lineitem").selectExpr(
        "string(l_orderkey) AS order_id",
        "l_linenumber AS pos",
        "string(l_partkey) AS sku",
        "int(l_quantity) AS quantity",
        "CAST(l_extendedprice AS DECIMAL(10,2)) AS price",
    )


def payments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One payment per finished order, and a later refund for the urgent ones."""
    finished = table(spark, sf_dir, "orders").filter("o_orderstatus = 'F'")
    kinds = "IF(o_orderpriority = '1-URGENT', array('completed', 'refunded'), array('completed'))"
    return finished.select("*", F.expr(f"explode({kinds})").alias("status")).selectExpr(
        "concat(IF(status = 'refunded', 'R', 'P'), o_orderkey) AS payment_id",
        "string(o_orderkey) AS order_id",
        "CAST(o_totalprice AS DECIMAL(10,2)) AS amount",
        "'USD' AS currency",
        "'credit_card' AS payment_method",
        "status",
        "o_orderdate + IF(status = 'refunded', INTERVAL '2' DAY, INTERVAL '1' DAY) AS settled_at",
        f"{UPDATED_AT} AS updated_at",
    )


def stock_moves(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Accepted stock movements: returned lines come back, all others leave."""
    return table(spark, sf_dir, "lineitem").selectExpr(
        "string(l_partkey) AS sku", "bigint(l_quantity) AS quantity", f"{_ADJUSTMENT} AS adjustment_type"
    )


_ADJUSTMENT = "IF(l_returnflag = 'R', 'add', 'subtract')"

# The kind of fault of a message, by its key; the first that applies.
USER_FAULT = """CASE WHEN c_custkey % 53 = 11 THEN 'broken' WHEN c_custkey % 59 = 13 THEN 'long_name'
    WHEN c_custkey % 61 = 17 THEN 'clash' WHEN c_custkey % 67 = 19 THEN 'unknown'
    WHEN c_custkey % 71 = 23 THEN 'bad_time' ELSE 'ok' END"""
ORDER_FAULT = """CASE WHEN o_orderkey % 83 = 21 THEN 'orphan' WHEN o_orderkey % 89 = 34 THEN 'bad_item'
    WHEN o_orderkey % 97 = 55 THEN 'too_large' WHEN o_orderkey % 101 = 8 THEN 'text_amount'
    WHEN o_orderkey % 113 = 60 THEN 'early' ELSE 'ok' END"""
PAYMENT_FAULT = """CASE WHEN o_orderkey % 103 = 10 THEN 'no_order' WHEN o_orderkey % 107 = 50 THEN 'long_status'
    ELSE 'ok' END"""
STOCK_FAULT = "CASE WHEN l_orderkey % 109 = 12 THEN 'too_big' ELSE 'ok' END"

# Deliveries of a message: 0 the first, 1 the same message again, 2 a newer version.
USER_VERSIONS = "filter(array(0, IF(c_custkey % 50 = 7, 1, -1), IF(c_custkey % 43 = 5, 2, -1)), v -> v >= 0)"
ORDER_VERSIONS = "filter(array(0, IF(o_orderkey % 47 = 3, 2, -1)), v -> v >= 0)"
PAYMENT_VERSIONS = "filter(array(0, IF(o_orderkey % 37 = 4, 2, -1)), v -> v >= 0)"

_PHASE = 10**15
_EVENT_TIME = "timestamp'2024-01-01T00:00:00Z'"


def _messages(events: DataFrame, event_type: str, partition: int) -> DataFrame:
    return to_messages(events, event_type).withColumn("partition", F.lit(partition))


def _with_topic_columns(messages: DataFrame) -> DataFrame:
    return messages.selectExpr("key", "value", "'events' AS topic", "partition", "seq AS offset",
                               f"{_EVENT_TIME} AS timestamp", "seq")


def user_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    base = table(spark, sf_dir, "customer").selectExpr(
        "*", f"{USER_FAULT} AS fault", f"explode({USER_VERSIONS}) AS version"
    )
    events = base.selectExpr(
        f"{_PHASE} + c_custkey * 10 + version AS seq",
        "fault",
        "concat('U-', c_custkey, IF(version = 2, '-2', '')) AS event_id",
        f"{_EVENT_TIME} AS event_time",
        "string(c_custkey) AS user_id",
        "concat('c', IF(fault = 'clash', c_custkey - 1, c_custkey), '@example.com') AS email",
        "IF(fault = 'long_name', repeat('Name ', 25), c_mktsegment) AS first_name",
        "concat(c_name, IF(version = 2, ' II', '')) AS last_name",
        f"timestamp({_BASE} + c_custkey * INTERVAL '1' MINUTE + IF(version = 2, 1, 0) * INTERVAL '1' DAY) AS created_at",
    )
    spoiled = """CASE fault WHEN 'broken' THEN left(value, length(value) - 1)
        WHEN 'unknown' THEN replace(value, '"UserCreated"', '"CustomerMerged"')
        WHEN 'bad_time' THEN replace(value, '"timestamp":"2024', '"timestamp":"not-2024') ELSE value END"""
    return _with_topic_columns(_messages(events, S.USER_CREATED, 0).withColumn("value", F.expr(spoiled)))


def order_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    base = _spread(table(spark, sf_dir, "orders")).selectExpr(
        "*", f"{ORDER_FAULT} AS fault", f"explode({ORDER_VERSIONS}) AS version"
    )
    item = """named_struct('sku', concat('SKU-', (o_custkey * 7 + i) % 500), 'quantity', bigint(i),
        'price', o_totalprice)"""
    items = f"IF(version = 2 OR o_orderkey % 4 = 0, array(), transform(sequence(1, int(o_orderkey % 4)), i -> {item}))"
    bad = """IF(fault = 'bad_item', array(named_struct('sku', repeat('S', 60), 'quantity', 1L,
        'price', o_totalprice)), array())"""
    events = base.selectExpr(
        f"IF(fault = 'early', 0, {2 * _PHASE}) + o_orderkey * 10 + version AS seq",
        "fault",
        "concat('O-', o_orderkey, IF(version = 2, '-2', '')) AS event_id",
        f"{_EVENT_TIME} AS event_time",
        "string(o_orderkey) AS order_id",
        "concat(IF(fault = 'orphan', 'ghost-', ''), o_custkey) AS user_id",
        "o_totalprice + IF(version = 2, 1, 0) + IF(fault = 'too_large', 1e8D, 0) AS total_amount",
        "'USD' AS currency",
        f"concat({items}, {bad}) AS items",
        "timestamp(o_orderdate + IF(version = 2, 1, 0) * INTERVAL '1' DAY) AS placed_at",
    )
    spoiled = """IF(fault = 'text_amount', regexp_replace(value, '"totalAmount":([^,]+)', '"totalAmount":"$1"'), value)"""
    return _with_topic_columns(_messages(events, S.ORDER_PLACED, 1).withColumn("value", F.expr(spoiled)))


def payment_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    base = _spread(table(spark, sf_dir, "orders").filter("o_orderstatus = 'F'")).selectExpr(
        "*", f"{PAYMENT_FAULT} AS fault", f"explode({PAYMENT_VERSIONS}) AS version"
    )
    events = base.selectExpr(
        f"{3 * _PHASE} + o_orderkey * 10 + version AS seq",
        "fault",
        "concat(IF(version = 2, 'Q-', 'P-'), o_orderkey) AS event_id",
        f"{_EVENT_TIME} AS event_time",
        "concat(IF(version = 2, 'Q', 'P'), o_orderkey) AS payment_id",
        "concat(IF(fault = 'no_order', 'missing-', ''), o_orderkey) AS order_id",
        "o_totalprice AS amount",
        "'USD' AS currency",
        "'credit_card' AS payment_method",
        "CASE WHEN fault = 'long_status' THEN 'completed-after-a-long-review' WHEN version = 2 THEN 'refunded' "
        "ELSE 'completed' END AS status",
        "timestamp(o_orderdate + IF(version = 2, 2, 1) * INTERVAL '1' DAY) AS settled_at",
    )
    return _with_topic_columns(_messages(events, S.PAYMENT_SETTLED, 2))


def stock_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines have no key of their own; a digest of what tells them apart gives each message its place."""
    lines = _spread(table(spark, sf_dir, "lineitem"))
    told = "l_orderkey, l_linenumber, l_partkey, l_suppkey, bigint(l_quantity), bigint(round(l_extendedprice * 100)), unix_date(date(l_shipdate))"
    digest = f"bigint(conv(left(md5(concat_ws('|', {told})), 15), 16, 10))"
    events = lines.selectExpr(
        f"{4 * _PHASE} + {digest} AS seq",
        "concat('I-', l_orderkey, '-', l_linenumber, '-', l_partkey, '-', l_suppkey) AS event_id",
        f"{_EVENT_TIME} AS event_time",
        "string(l_partkey) AS sku",
        f"IF({STOCK_FAULT} = 'too_big', 5000000000, bigint(l_quantity)) AS quantity",
        f"{_ADJUSTMENT} AS adjustment_type",
        "'line' AS reason",
        "timestamp(l_shipdate) AS adjusted_at",
    )
    return _with_topic_columns(_messages(events, S.INVENTORY_ADJUSTED, 3))


def _joined(*logs: DataFrame) -> DataFrame:
    """One log of several. The partitions stay as they are; the coalesce above the union only keeps
    the optimizer from copying the whole parse into every branch."""
    union = logs[0]
    for log in logs[1:]:
        union = union.unionByName(log)
    return union.coalesce(_NO_LIMIT)


_NO_LIMIT = 1_000_000


def document_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """User, order and payment messages."""
    return _joined(user_log(spark, sf_dir), order_log(spark, sf_dir), payment_log(spark, sf_dir))


def topic_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All four kinds of messages."""
    return _joined(
        user_log(spark, sf_dir), order_log(spark, sf_dir), payment_log(spark, sf_dir), stock_log(spark, sf_dir)
    )


def later_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A second batch: every third order is placed anew, and its payment delivered again under the old id."""
    third = _spread(table(spark, sf_dir, "orders").filter("o_orderkey % 3 = 0"))
    placed = third.selectExpr(
        f"{5 * _PHASE} + o_orderkey AS seq",
        "concat('O-', o_orderkey, '-3') AS event_id",
        f"{_EVENT_TIME} AS event_time",
        "string(o_orderkey) AS order_id",
        "string(o_custkey) AS user_id",
        "o_totalprice + 5 AS total_amount",
        "'EUR' AS currency",
        "array(named_struct('sku', 'SKU-later', 'quantity', 9L, 'price', 1.5D)) AS items",
        "timestamp(o_orderdate + INTERVAL '9' DAY) AS placed_at",
    )
    settled = third.filter("o_orderstatus = 'F'").selectExpr(
        f"{6 * _PHASE} + o_orderkey AS seq",
        "concat('P-', o_orderkey, '-3') AS event_id",
        f"{_EVENT_TIME} AS event_time",
        "concat('P', o_orderkey) AS payment_id",
        "string(o_orderkey) AS order_id",
        "o_totalprice + 5 AS amount",
        "'EUR' AS currency",
        "'voucher' AS payment_method",
        "'refunded' AS status",
        "timestamp(o_orderdate + INTERVAL '9' DAY) AS settled_at",
    )
    logs = _messages(placed, S.ORDER_PLACED, 1), _messages(settled, S.PAYMENT_SETTLED, 2)
    return _joined(*(_with_topic_columns(log) for log in logs))


def wide_moves(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(seq, sku, delta)``: movements so large that balances meet their limits again and again."""
    sign = "IF(event_type IN ('view', 'click', 'signup'), 1, -1)"
    return table(spark, sf_dir, "events").selectExpr(
        "event_id AS seq", "string(user_id) AS sku", f"bigint(round(value * 100)) * 100000 * {sign} AS delta"
    )


CHAIN = 6


def handed_on_addresses(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """``claims(seq, user_id, email)`` and ``holders(user_id, email)``: chains of users who hand their address on.

    All users first take an address of their own. Then the last user of a chain moves to a new one, and each other
    user, backwards, to the one that has just become free; in every third chain the last user wants an address that is held.
    """
    customers = table(spark, sf_dir, "customer").selectExpr("c_custkey AS c", f"c_custkey DIV {CHAIN} AS chain", f"c_custkey % {CHAIN} AS place")
    first = customers.selectExpr("c AS seq", "string(c) AS user_id", "concat('own', c) AS email")
    wanted = f"CASE WHEN place < {CHAIN - 1} THEN concat('own', c + 1) WHEN chain % 3 = 0 THEN concat('held', chain) ELSE concat('new', c) END"
    then = customers.selectExpr(f"{_PHASE} + chain * {CHAIN} + {CHAIN - 1} - place AS seq", "string(c) AS user_id", f"{wanted} AS email")
    holders = customers.filter("place = 0").selectExpr("concat('other', chain) AS user_id", "concat('held', chain) AS email")
    return first.unionByName(then), holders


def odd_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(seq, value)``: user messages with fields missing, null or of the wrong kind, by key."""
    text = """CASE c_custkey % 9
        WHEN 0 THEN concat('{"eventId":"Z-', c_custkey, '","eventType":"UserCreated"}')
        WHEN 1 THEN '{}'
        WHEN 2 THEN 'null'
        WHEN 3 THEN concat('{"eventId":"Z-', c_custkey, '","eventType":"UserCreated"} trailing')
        WHEN 4 THEN concat('{"eventId":"Z-', c_custkey, '","eventType":"InventoryAdjusted","quantity":"', c_custkey, '"}')
        WHEN 5 THEN concat('{"EVENTID":"Z-', c_custkey, '","eventtype":"UserCreated","USERID":"', c_custkey, '"}')
        WHEN 6 THEN concat('{"eventId":null,"eventType":"UserCreated","userId":"', c_custkey, '","email":null}')
        WHEN 7 THEN concat('{"eventId":"Z-', c_custkey, '","eventType":"UserCreated","email":', c_custkey, '}')
        ELSE concat('{"eventId":"Z-', c_custkey, '","eventType":"UserCreated","userId":"u', c_custkey, '","more":[1,{"a":2}]}') END"""
    return table(spark, sf_dir, "customer").selectExpr("c_custkey AS seq", f"{text} AS value")


def outcomes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").selectExpr(
        "ts", "event_type", "IF(event_type = 'error', 'error', 'success') AS status"
    )


def durations(spark: SparkSession, sf_dir: str) -> DataFrame:
    names = ", ".join(f"'{o}'" for o in OPERATIONS)
    return table(spark, sf_dir, "events").selectExpr(
        f"array({names})[int(event_id % {len(OPERATIONS)})] AS operation",
        "IF(event_id % 2 = 0, 'kafka_produce', 'kafka_consume') AS stage",
        "CAST(value AS DECIMAL(12,2)) * 0.01BD AS duration_seconds",
        "ts",
    )


# Message text per kind of sample event; the same text appears in the expected results.
LOG_MESSAGE = """CASE WHEN event_type = 'error' THEN 'Failed to process event'
    WHEN event_type = 'signup' THEN 'UserCreated received' WHEN event_type = 'purchase' THEN 'Message pushed to DLQ'
    WHEN event_type = 'click' AND event_id % 10 = 0 THEN 'Heartbeat' WHEN event_type = 'click' THEN 'Processed event'
    ELSE 'Message delivered successfully' END"""


def log_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """JSON log lines, with a few plain-text ones among them."""
    fields = f"""concat('{{"level":"', IF(event_type = 'error', 'error', 'info'), '","msg":"', {LOG_MESSAGE},
        '","eventId":"E-', user_id, '","partition":0,"offset":', event_id, ',"time":"',
        date_format(ts, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"), 'Z"}}')"""
    plain = "event_type = 'view' AND event_id % 10 = 5"
    return table(spark, sf_dir, "events").selectExpr(
        "event_id AS line_no", f"IF({plain}, concat('plain text line ', event_id), {fields}) AS value"
    )
