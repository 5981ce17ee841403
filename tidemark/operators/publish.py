"""Turn typed events into keyed topic messages."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark import schemas as S

_TIME_FORMAT = "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX"


def partition_key(event_type: Column, fields: dict[str, Column]) -> Column:
    """Topic key of an event: its entity id, or ``unknown`` for other event types.

    ``fields`` maps wire names (``userId``, ``orderId``, ``sku``) to columns.
    """
    key = F.lit("unknown")
    for kind, name in S.PARTITION_KEYS.items():
        if name in fields:
            key = F.when(event_type == kind, fields[name]).otherwise(key)
    return key


def to_messages(events: DataFrame, event_type: str) -> DataFrame:
    """``(key, value)`` messages of one event type.

    ``events`` has ``event_id``, ``event_time`` and the body columns of the type; columns such as
    ``seq`` that do not belong to the event are carried along. The event type is stamped here.
    """
    body = S.BODY_FIELDS[event_type]
    wire = [
        F.col("event_id").alias("eventId"),
        F.lit(event_type).alias("eventType"),
        F.col("event_time").alias("timestamp"),
        *[F.col(col).alias(name) for name, col, _ in body],
    ]
    key_column = next(col for name, col, _ in body if name == S.PARTITION_KEYS[event_type])
    own = {"event_id", "event_time", "key", "value", *[col for _, col, _ in body]}
    carried = [c for c in events.columns if c not in own]
    value = F.to_json(F.struct(*wire), {"timestampFormat": _TIME_FORMAT})
    return events.select(*carried, F.col(key_column).alias("key"), value.alias("value"))


def write_messages(messages: DataFrame, topic: str, brokers: str) -> None:
    """Append ``(key, value)`` messages to a Kafka topic; the broker places them by key."""
    (
        messages.select("key", "value")
        .write.format("kafka")
        .option("kafka.bootstrap.servers", brokers)
        .option("kafka.acks", "all")
        .option("topic", topic)
        .save()
    )


def write_message_files(messages: DataFrame, path: str, partitions: int | None = None) -> None:
    """Append messages to a folder of Parquet files; with ``partitions`` equal keys share a file."""
    if partitions:
        messages = messages.repartition(partitions, "key")
    messages.write.mode("append").parquet(path)
