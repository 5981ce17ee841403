"""Analysis of structured JSON log lines: severity, correlation, tail, retention."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark import schemas as S
from tidemark.functions.ordered import in_slices, positions

# Severity labels and their patterns, first match wins, case is ignored.
SEVERITIES = (
    ("ERROR", 'ERROR|"level":"error"'),
    ("EVENT", "UserCreated|OrderPlaced|PaymentSettled|InventoryAdjusted"),
    ("DLQ", "DLQ|failed|Sent to DLQ"),
    ("OK", "Processed event|successfully"),
    ("INFO", "eventId"),
)
OTHER_SEVERITY = "DEBUG"
# The shorter form used for recent activity.
SHORT_SEVERITIES = (
    ("ERROR", "ERROR"),
    ("EVENT", "UserCreated|OrderPlaced|PaymentSettled|InventoryAdjusted"),
    ("DLQ", "DLQ|failed"),
    ("OK", "Processed event"),
)
OTHER_SHORT_SEVERITY = "INFO"


def severity(line: Column, rules=SEVERITIES, other: str = OTHER_SEVERITY) -> Column:
    label = None
    for name, pattern in rules:
        matches = line.rlike(f"(?i){pattern}")
        label = F.when(matches, F.lit(name)) if label is None else label.when(matches, F.lit(name))
    return label.otherwise(F.lit(other))


def parse_lines(lines: DataFrame, column: str = "value") -> DataFrame:
    """Add the fields of :data:`tidemark.schemas.LOG_LINE`; they are null on lines that are not JSON."""
    fields = F.from_json(column, S.LOG_LINE)
    kept = [c for c in lines.columns if c != "_fields"]
    return lines.withColumn("_fields", fields).select(*kept, "_fields.*")


def severity_counts(lines: DataFrame, column: str = "value") -> DataFrame:
    return lines.groupBy(severity(F.col(column)).alias("severity")).agg(F.count(F.lit(1)).alias("lines"))


def correlation_summary(parsed: DataFrame) -> DataFrame:
    """Per event id: number of lines and errors, first and last time and message."""
    order = F.struct("time", "msg")
    return (
        parsed.filter(F.col("eventId").isNotNull())
        .groupBy(F.col("eventId").alias("event_id"))
        .agg(
            F.count(F.lit(1)).alias("lines"),
            F.count(F.when(F.lower("level") == "error", 1)).alias("errors"),
            F.min("time").alias("first_time"),
            F.max("time").alias("last_time"),
            F.min_by("msg", order).alias("first_msg"),
            F.max_by("msg", order).alias("last_msg"),
        )
    )


def correlated_lines(parsed: DataFrame, event_ids: DataFrame | None = None) -> DataFrame:
    """All lines that carry an event id, sorted by id and time; optionally only the given ids.

    A sorted listing rather than one array per id, so an id with very many lines spreads over tasks.
    """
    lines = parsed.filter(F.col("eventId").isNotNull())
    if event_ids is not None:
        lines = lines.join(event_ids.select("eventId").distinct(), "eventId", "left_semi")
    return lines.orderBy("eventId", "time", "msg")


def numbered_lines(parsed: DataFrame, order: list[str], rows_per_slice: int = 1_000_000) -> DataFrame:
    """Add ``line_no`` (0-based) in the order of ``order``."""
    return positions(in_slices(parsed, order, rows_per_slice, "_slice"), order, "line_no", ["_slice"]).drop("_slice")


def tail(lines: DataFrame, n: int, order: list[str]) -> DataFrame:
    """The last ``n`` lines, oldest first."""
    newest = lines.orderBy(*[F.col(c).desc() for c in order]).limit(n)
    return newest.orderBy(*order)


def retained(parsed: DataFrame, now: Column, hours: int = 24, time: str = "time") -> DataFrame:
    """Lines not older than ``hours``; a line without a time has no age and stays."""
    return parsed.filter(F.col(time).isNull() | (F.col(time) >= now - F.expr(f"INTERVAL {int(hours)} HOURS")))
