"""The five entity tables as bucketed Parquet snapshots, replaced bucket by bucket and committed per batch.

Plain Parquet has no MERGE, so a batch writes new copies of the buckets it touches under its own
version folder and then commits one small file that says which version of each bucket is current, how many
buckets there are, and which batch of each source was applied last. A batch that fails before the commit leaves the
tables as they were. Versions are numbered by the tables themselves: batch numbers of different sources, or of a
source that starts over, have nothing to do with each other.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark import schemas as S
from tidemark.functions.ordered import ROWS_PER_SLICE
from tidemark.operators.dead_letters import EntryList, write_slices
from tidemark.session import staged

#: Side tables that say which rows hold a value: the table, the column with the value, the table's key. They are bucketed by
#: the value, so a batch or a lookup reads the buckets of its own values only.
INDEXES = {"user_emails": ("users", "email"), "user_orders": ("orders", "user_id"), "order_payments": ("payments", "order_id")}
#: Event ids of accepted stock movements, kept only when duplicates are to be suppressed.
STOCK_IDS = "stock_event_ids"

_SCHEMAS = {
    **S.TABLES,
    **{name: T.StructType([S.TABLES[t][value], S.TABLES[t][S.TABLE_KEYS[t]]]) for name, (t, value) in INDEXES.items()},
    STOCK_IDS: T.StructType().add("event_id", "string"),
}
_KEYS = {**S.TABLE_KEYS, **{name: value for name, (_, value) in INDEXES.items()}, STOCK_IDS: "event_id"}

#: ``bucket``: current version of a bucket of table ``name``; ``buckets``: their count; ``source``: last batch of source
#: ``name``; ``stage``: microseconds that stage ``name`` of the committed batch took; ``offset``: the
#: offset after the last one taken from topic and partition ``name``.
_COMMIT_SCHEMA = "kind STRING, name STRING, bucket INT, number BIGINT"
_DEFAULT_BUCKETS = 64


class EntityTables:
    """Reader and single writer of the tables under ``root``.

    The number of buckets is fixed with the first commit; opening the tables with another number is an error, as rows
    would be looked for in the wrong buckets.
    """

    def __init__(self, spark: SparkSession, root: str, buckets: int | None = None):
        self.spark, self.root = spark, root.rstrip("/")
        self.version, self.batches, self._current, self.offsets, stored = self._load()
        if stored and buckets not in (None, stored):
            raise ValueError(f"the tables under {root} have {stored} buckets, not {buckets}")
        self.buckets = stored or buckets or _DEFAULT_BUCKETS

    def _commits(self) -> DataFrame | None:
        try:
            return self.spark.read.schema(f"{_COMMIT_SCHEMA}, version BIGINT").parquet(f"{self.root}/commits")
        except AnalysisException:
            return None

    def _load(self) -> tuple[int, dict[str, int], dict[tuple[str, int], int], dict[str, int], int]:
        """The newest commit: a row per bucket, source and partition, so its size does not depend on the rows."""
        commits = self._commits()
        newest = commits.agg(F.max("version")).first()[0] if commits is not None else None
        if newest is None:
            return -1, {}, {}, {}, 0
        rows = commits.filter(F.col("version") == newest).collect()
        batches = {r["name"]: r["number"] for r in rows if r["kind"] == "source"}
        current = {(r["name"], r["bucket"]): r["number"] for r in rows if r["kind"] == "bucket"}
        offsets = {r["name"]: r["number"] for r in rows if r["kind"] == "offset"}
        return newest, batches, current, offsets, next(r["number"] for r in rows if r["kind"] == "buckets")

    def applied(self, source: str, batch_id: int) -> bool:
        """Whether this batch of the source is in the tables; a batch beyond the next one is an error."""
        last = self.batches.get(source, -1)
        if batch_id > last + 1:
            raise ValueError(f"batch {batch_id} of source {source} follows batch {last} here: batches in between are missing")
        return batch_id <= last

    def unseen(self, log: DataFrame) -> DataFrame:
        """The rows of a log beyond the offsets that were taken from its partitions before; a gap after those is an error."""
        place = F.concat_ws("/", "topic", "partition")
        first = {r["name"]: r["first"] for r in log.groupBy(place.alias("name")).agg(F.min("offset").alias("first")).collect()}
        known = {name: after for name, after in self.offsets.items() if name in first}
        missing = sorted(name for name, after in known.items() if first[name] > after)
        if missing:
            raise ValueError(f"offsets between what the tables hold and this batch are missing in {', '.join(missing)}")
        for name, after in known.items():
            log = log.filter((place != name) | (F.col("offset") >= after))
        return log

    def bucket_of(self, key: str) -> Column:
        return F.pmod(F.xxhash64(key), F.lit(self.buckets)).cast("int")

    def find(self, table: str, keys: DataFrame) -> DataFrame:
        """Rows of a table, or of an index, with one of the keys; only the keys' buckets are listed and read."""
        key = _KEYS[table]
        keys = keys.select(key).distinct()
        return self.read(table, self.touched(keys, table)).join(keys, key, "left_semi")

    def find_by(self, index: str, values: DataFrame) -> DataFrame:
        """Rows of the table that an index belongs to with one of the values."""
        return self.find(INDEXES[index][0], self.find(index, values))

    def reindexed(self, index: str, fresh: DataFrame, stored: DataFrame) -> tuple[DataFrame | None, list[int]]:
        """New contents of the buckets of an index that change with a batch, and their numbers.

        ``fresh`` has the values that the batch leaves, one row per key; ``stored`` the rows of those keys before it.
        """
        table, value = INDEXES[index]
        key = S.TABLE_KEYS[table]
        before = stored.select(key, F.col(value).alias("_before"))
        changed = staged(fresh.select(key, value).join(before, key, "left").filter(f"_before IS NULL OR _before <> {value}"))
        gone = changed.filter("_before IS NOT NULL").select(F.col("_before").alias(value), key)
        buckets = self.touched(changed.select(value).union(gone.select(value)), index)
        if not buckets:
            return None, []
        kept = self.read(index, buckets).join(gone, [value, key], "left_anti")
        return kept.unionByName(changed.select(value, key)), buckets

    def touched(self, keys: DataFrame, table: str) -> list[int]:
        """Buckets of ``table`` that a set of keys falls into; at most ``buckets`` numbers."""
        bucket = self.bucket_of(_KEYS[table]).alias("bucket")
        return [r["bucket"] for r in keys.select(bucket).distinct().collect()]

    def read(self, table: str, buckets: Iterable[int] | None = None) -> DataFrame:
        """Committed rows of a table, optionally of some buckets only."""
        wanted = None if buckets is None else set(buckets)
        paths = [
            f"{self.root}/{name}/version={version}/bucket={bucket}"
            for (name, bucket), version in sorted(self._current.items())
            if name == table and (wanted is None or bucket in wanted)
        ]
        if not paths:
            return self.spark.createDataFrame([], _SCHEMAS[table])
        return self.spark.read.schema(_SCHEMAS[table]).parquet(*paths)

    def read_all(self) -> dict[str, DataFrame]:
        return {name: self.read(name) for name in S.TABLES}

    def write_version(self, table: str, rows: DataFrame, version: int) -> None:
        """Write new contents of the touched buckets; readers do not see them before the commit."""
        (
            rows.select(*_SCHEMAS[table].names)
            .withColumn("bucket", self.bucket_of(_KEYS[table]))
            .hint("rebalance", "bucket")
            .write.mode("overwrite")
            .partitionBy("bucket")
            .parquet(f"{self.root}/{table}/version={version}")
        )

    def commit(
        self,
        version: int,
        source: str | None,
        batch_id: int,
        touched: dict[str, list[int]],
        stages: dict[str, float] | None = None,
        taken: dict[str, int] | None = None,
    ) -> None:
        """Make ``version`` current, all tables at once, and note the batch it came from and the offsets after it."""
        current = dict(self._current)
        for table, buckets in touched.items():
            written = self._written(table, version) if buckets else set()
            for bucket in buckets:
                if bucket in written:
                    current[(table, bucket)] = version
                else:
                    current.pop((table, bucket), None)
        batches = {**self.batches, source: batch_id} if source else self.batches
        offsets = {**self.offsets, **{name: max(after, self.offsets.get(name, 0)) for name, after in (taken or {}).items()}}
        rows = [("buckets", None, None, self.buckets)]
        rows += [("bucket", t, b, v) for (t, b), v in sorted(current.items())]
        rows += [("source", s, None, b) for s, b in sorted(batches.items())]
        rows += [("offset", name, None, after) for name, after in sorted(offsets.items())]
        rows += [("stage", name, None, round(1e6 * seconds)) for name, seconds in (stages or {}).items()]
        commit = self.spark.createDataFrame(rows, _COMMIT_SCHEMA).coalesce(1)
        commit.write.mode("overwrite").parquet(f"{self.root}/commits/version={version}")
        self.version, self.batches, self._current, self.offsets = version, batches, current, offsets

    def stage_latencies(self) -> DataFrame:
        """``(version, stage, seconds)`` of every committed batch."""
        commits = self._commits()
        if commits is None:
            return self.spark.createDataFrame([], "version BIGINT, stage STRING, seconds DOUBLE")
        seconds = (F.col("number") / 1e6).alias("seconds")
        return commits.filter("kind = 'stage'").select("version", F.col("name").alias("stage"), seconds)

    def _written(self, table: str, version: int) -> set[int]:
        """Buckets that have rows in a version; a bucket whose last item rows went away has none."""
        try:
            written = self.spark.read.schema("bucket INT").parquet(f"{self.root}/{table}/version={version}")
        except AnalysisException:
            return set()
        return {r["bucket"] for r in written.select("bucket").distinct().collect()}

    def append(self, name: str, rows: DataFrame, version: int) -> None:
        """Rows of an append-only side table; a repeated batch replaces its own rows."""
        rows.drop("batch_id").write.mode("overwrite").parquet(f"{self.root}/{name}/batch_id={version}")

    def read_appended(self, name: str, schema: str) -> DataFrame:
        """Rows of committed versions of a side table; ``schema`` includes ``batch_id``, the version."""
        try:
            rows = self.spark.read.schema(schema).parquet(f"{self.root}/{name}")
        except AnalysisException:
            return self.spark.createDataFrame([], schema)
        return rows.filter(F.col("batch_id") <= self.version)

    def append_dead_letters(self, rows: DataFrame, version: int, rows_per_slice: int = ROWS_PER_SLICE) -> None:
        """The dead letters of a batch, in slices whose sizes are noted beside them."""
        slices = write_slices(rows, f"{self.root}/dead_letters/batch_id={version}", ["slice"], rows_per_slice)
        self.append("dead_letter_slices", slices.coalesce(1), version)

    def dead_letter_list(self) -> EntryList:
        """The list of committed dead letters, read by position."""
        slices = self.read_appended("dead_letter_slices", "slice INT, entries BIGINT, batch_id BIGINT")
        return EntryList(f"{self.root}/dead_letters", slices)

    def dead_letters(self) -> DataFrame:
        return self.read_appended("dead_letters", S.DEAD_LETTERS).select(*S.DEAD_LETTERS.names)

    def outcomes(self) -> DataFrame:
        """Messages per committed version, second, event type and status."""
        return self.read_appended("outcomes", "tick TIMESTAMP, event_type STRING, status STRING, events BIGINT, batch_id BIGINT")

    def success_rate(self) -> DataFrame:
        """Accepted messages per second and event type."""
        done = self.outcomes().filter("status = 'success'")
        return done.groupBy("tick", "event_type").agg(F.sum("events").alias("events"))
