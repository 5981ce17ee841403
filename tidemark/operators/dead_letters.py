"""The dead-letter table: append, count, range reads by list position, causes.

An entry's list position is its place in the order (batch_id, partition, offset), which later appends
never change.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass
from datetime import datetime
from math import ceil

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark import schemas as S
from tidemark.functions.ordered import ROWS_PER_SLICE
from tidemark.functions.scalars import preview, rfc3339
from tidemark.session import shared_folder

ORDER = ["batch_id", "partition", "offset"]
_FOLDERS = {"batch_id": "batch_id BIGINT", "slice": "slice INT"}


def to_dead_letters(rejected: DataFrame, batch_id: int | Column, now: Column | datetime) -> DataFrame:
    """Dead-letter rows for failed messages that carry ``partition, offset, event_id, value, error``."""
    return rejected.select(
        F.lit(batch_id).cast("bigint").alias("batch_id"),
        F.col("partition").cast("int").alias("partition"),
        F.col("offset").cast("bigint").alias("offset"),
        "event_id",
        F.col("value").alias("original_data"),
        "error",
        "error_class",
        F.lit(now).alias("timestamp"),
        F.lit(0).alias("retry_count"),
    )


def count_entries(entries: DataFrame) -> DataFrame:
    return entries.agg(F.count(F.lit(1)).alias("dlq_entries"))


@dataclass(frozen=True)
class EntryList:
    """The list of dead letters: files of ``root/batch_id=…/slice=…``, and how many entries each of them holds.

    Slices of a batch follow each other along its order, so the sums of ``slices(batch_id, slice, entries)`` say which of
    them a range of positions meets. Only those are listed and read; an entry is numbered within its slice.
    """

    root: str
    slices: DataFrame

    def count(self) -> int:
        return self.slices.agg(F.coalesce(F.sum("entries"), F.lit(0)).alias("n")).first()["n"]

    def places(self, start: int, stop: int) -> list[tuple[int, int, int]]:
        """``(batch_id, slice, position of its first entry)`` of the slices that the range meets, in order."""
        before = Window.orderBy("batch_id", "slice").rowsBetween(Window.unboundedPreceding, -1)
        placed = self.slices.withColumn("first", F.coalesce(F.sum("entries").over(before), F.lit(0)))
        met = placed.filter((F.col("first") <= stop) & (F.col("first") + F.col("entries") > start))
        return [(r["batch_id"], r["slice"], r["first"]) for r in met.orderBy("first").collect()]

    def range(self, start: int, stop: int) -> DataFrame:
        """Entries from ``start`` to ``stop`` inclusive with their ``position``; negative ones count from the tail."""
        spark, total = self.slices.sparkSession, self.count() if start < 0 or stop < 0 else 0
        start, stop = (p + total if p < 0 else p for p in (start, stop))
        places = self.places(max(start, 0), stop)
        if not places:
            return empty_entries(spark).withColumn("position", F.lit(None).cast("bigint"))
        paths = [f"{self.root}/batch_id={b}/slice={s}" for b, s, _ in places]
        schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in S.DEAD_LETTERS.fields)
        met = spark.read.schema(f"{schema}, slice INT").option("basePath", self.root).parquet(*paths)
        firsts = spark.createDataFrame(places, "batch_id BIGINT, slice INT, _first BIGINT")
        rank = F.row_number().over(Window.partitionBy("batch_id", "slice").orderBy("partition", "offset"))
        numbered = met.withColumn("_rank", rank).join(F.broadcast(firsts) if len(places) <= 10_000 else firsts, ["batch_id", "slice"])
        placed = numbered.withColumn("position", F.col("_first") + F.col("_rank") - 1)
        return placed.filter(F.col("position").between(start, stop)).select(*S.DEAD_LETTERS.names, "position")

    def at(self, index: int) -> DataFrame:
        """The entry at one position (0 oldest, -1 latest), or no row."""
        return self.range(index, index)

    def since(self, initial_count: int) -> DataFrame:
        """Entries appended after the list held ``initial_count`` entries."""
        return self.range(max(initial_count, 0), -1)


def write_slices(entries: DataFrame, path: str, by: list[str], rows_per_slice: int = ROWS_PER_SLICE) -> DataFrame:
    """Write entries under ``path`` in slices along their order, in folders by ``by``; returns the folders' ``entries``.

    ``by`` ends with ``slice`` and begins with ``batch_id`` unless ``path`` belongs to one batch already.
    """
    spark = entries.sparkSession
    runs = ceil(entries.count() / rows_per_slice)
    if runs == 0:
        return spark.createDataFrame([], ", ".join(_FOLDERS[c] for c in by) + ", entries BIGINT")
    ranged = entries.repartitionByRange(runs, *ORDER).withColumn("slice", F.spark_partition_id())
    if "batch_id" not in by:
        ranged = ranged.drop("batch_id")
    ranged.write.mode("overwrite").partitionBy(*by).parquet(path)
    written = spark.read.schema("offset BIGINT, " + ", ".join(_FOLDERS[c] for c in by)).parquet(path)
    return written.groupBy(*by).agg(F.count(F.lit(1)).alias("entries"))


def entry_list(entries: DataFrame, rows_per_slice: int = ROWS_PER_SLICE) -> EntryList:
    """The list of all entries of a DataFrame, written to the shared folder."""
    root = f"{shared_folder(entries.sparkSession)}/entries-{uuid.uuid4().hex}"
    return EntryList(root, write_slices(entries, root, ["batch_id", "slice"], rows_per_slice))


def entry_range(entries: DataFrame, start: int, stop: int, rows_per_slice: int = ROWS_PER_SLICE) -> DataFrame:
    """Entries from ``start`` to ``stop`` inclusive; negative positions count from the tail."""
    return entry_list(entries, rows_per_slice).range(start, stop)


def entry_at(entries: DataFrame, index: int) -> DataFrame:
    """The entry at one position (0 oldest, -1 latest), or no row."""
    return entry_list(entries).at(index)


def new_since(entries: DataFrame, initial_count: int) -> DataFrame:
    """Entries appended after the list held ``initial_count`` entries."""
    return entry_list(entries).since(initial_count)


def new_since_batch(entries: DataFrame, batch_id: int) -> DataFrame:
    """Entries of later batches; prunes by the batch partition of the stored table."""
    return entries.filter(F.col("batch_id") > batch_id)


def summary_lines(entries: DataFrame) -> DataFrame:
    """Event id, error, RFC 3339 time and a short preview of the original message."""
    return entries.select(
        *ORDER,
        "event_id",
        "error",
        rfc3339(F.col("timestamp")).alias("at"),
        preview(F.col("original_data")).alias("original_preview"),
    )


def by_cause(entries: DataFrame) -> DataFrame:
    return entries.groupBy("error_class").agg(F.count(F.lit(1)).alias("entries"))


def to_json_entries(entries: DataFrame) -> DataFrame:
    """Entries in their JSON list form, one ``entry`` string per row."""
    fields = F.struct(
        F.col("event_id").alias("eventId"),
        F.col("original_data").alias("originalData"),
        "error",
        "timestamp",
        F.col("retry_count").alias("retryCount"),
    )
    return entries.select(*ORDER, F.to_json(fields, {"timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX"}).alias("entry"))


def from_json_entries(raw: DataFrame, column: str = "entry") -> DataFrame:
    """Read JSON list entries; entries that cannot be read are skipped."""
    schema = "eventId STRING, originalData STRING, error STRING, timestamp TIMESTAMP, retryCount INT, _bad STRING"
    parsed = F.from_json(column, schema, {"columnNameOfCorruptRecord": "_bad"})
    return (
        raw.withColumn("_entry", parsed)
        .filter(F.col("_entry").isNotNull() & F.col("_entry._bad").isNull())
        .select(
            *[c for c in raw.columns if c != column],
            F.col("_entry.eventId").alias("event_id"),
            F.col("_entry.originalData").alias("original_data"),
            F.col("_entry.error").alias("error"),
            F.col("_entry.timestamp").alias("timestamp"),
            F.col("_entry.retryCount").alias("retry_count"),
        )
    )


def empty_entries(spark) -> DataFrame:
    return spark.createDataFrame([], S.DEAD_LETTERS)
