"""The ingest stream: parse, settle against the tables, merge, dead-letter, commit."""

from __future__ import annotations

import time
import uuid
from datetime import datetime, timezone

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tidemark import schemas as S
from tidemark.operators.dead_letters import to_dead_letters
from tidemark.operators.parse import judged_columns, parse_events, route, with_lane
from tidemark.plans.ingest import settle_parsed
from tidemark.session import scratch_folder, staged
from tidemark.sources.topic import with_seq
from tidemark.streaming.tables import INDEXES, STOCK_IDS, EntityTables


def _parents(tables: EntityTables, parsed: DataFrame) -> dict[str, DataFrame]:
    """Stored rows that the messages refer to, from the buckets of what they name."""
    named = {"users": S.ORDER_PLACED, "orders": S.PAYMENT_SETTLED, "inventory": S.INVENTORY_ADJUSTED}
    return {name: tables.read(name, tables.touched(route(parsed, kind), name)) for name, kind in named.items()}


def _known(tables: EntityTables, parsed: DataFrame, dedupe_event_id: bool) -> tuple[DataFrame | None, DataFrame]:
    """Event ids of the stock messages that were accepted before, and the holders of the addresses that are claimed."""
    seen = None
    if dedupe_event_id:
        ids = route(parsed, S.INVENTORY_ADJUSTED).select("event_id")
        seen = tables.read(STOCK_IDS, tables.touched(ids, STOCK_IDS))
    claimed = route(parsed, S.USER_CREATED).select("email")
    return seen, tables.read("user_emails", tables.touched(claimed, "user_emails"))


def apply_batch(
    tables: EntityTables,
    log: DataFrame,
    batch_id: int = 0,
    now: datetime | None = None,
    dedupe_event_id: bool = False,
    source: str | None = None,
    skip_known: bool = False,
) -> bool:
    """Apply one batch of topic rows; returns false when this batch of the source was committed before.

    ``source`` names a run of numbered batches. Without a name the batch stands for itself and is always applied.
    The offsets after the batch are noted for each partition; with ``skip_known`` messages before those noted are left out, whatever
    source they came from, and offsets missing in between are an error.
    Tables, dead letters and counters of a batch become visible together with its commit.
    """
    if source is not None and tables.applied(source, batch_id):
        return False
    if skip_known:
        log = tables.unseen(log)
    version = tables.version + 1
    now = now or datetime.now(timezone.utc)
    work = f"{tables.root}/work"
    stages, since = {}, time.perf_counter()

    def done(stage: str) -> None:
        nonlocal since
        stages[stage], since = time.perf_counter() - since, time.perf_counter()

    with scratch_folder(f"{work}/scratch"):
        parsed = staged(judged_columns(with_lane(parse_events(with_seq(log)))), f"{work}/parsed")
        done("parse")
        outcome = settle_parsed(parsed, _parents(tables, parsed), dedupe_event_id, work, *_known(tables, parsed, dedupe_event_id))
        done("settle")

        accepted = {
            "users": outcome.users.accepted,
            "orders": outcome.orders.accepted,
            "order_items": outcome.orders.accepted,
            "payments": outcome.payments.accepted,
            "inventory": outcome.stock.accepted,
        }
        touched: dict[str, list[int]] = {}
        for name, rows in accepted.items():
            touched[name] = touched["orders"] if name == "order_items" else tables.touched(rows, name)
        stored = {name: tables.read(name, buckets) for name, buckets in touched.items()}
        merged = outcome.merged(stored, now)
        for name, buckets in touched.items():
            if buckets:
                tables.write_version(name, merged[name], version)
        for index, (name, value) in INDEXES.items():
            key = S.TABLE_KEYS[name]
            fresh = accepted[name].groupBy(key).agg(F.max_by(value, "seq").alias(value))
            rows, touched[index] = tables.reindexed(index, fresh, stored[name])
            if rows is not None:
                tables.write_version(index, rows, version)
        if dedupe_event_id:
            ids = staged(outcome.stock.accepted.filter("event_id <> ''").select("event_id").distinct())
            touched[STOCK_IDS] = tables.touched(ids, STOCK_IDS)
            if touched[STOCK_IDS]:
                tables.write_version(STOCK_IDS, tables.read(STOCK_IDS, touched[STOCK_IDS]).union(ids).distinct(), version)
        done("merge")

        tables.append_dead_letters(staged(to_dead_letters(outcome.rejected(), version, now), f"{work}/rejected"), version)
        tick = F.date_trunc("second", F.col("seq.timestamp")).alias("tick")
        counted = outcome.outcomes().groupBy(tick, "event_type", "status").agg(F.count(F.lit(1)).alias("events"))
        tables.append("outcomes", counted, version)
        done("report")
        place = F.concat_ws("/", "topic", "partition").alias("name")
        taken = {r["name"]: r["after"] for r in log.groupBy(place).agg((F.max("offset") + 1).alias("after")).collect()}
        tables.commit(version, source, batch_id, touched, stages, taken)
    return True


def _source_id(spark: SparkSession, checkpoint: str) -> str:
    """The name of the run that a checkpoint belongs to; it lives and dies with the checkpoint's folder."""
    path = f"{checkpoint.rstrip('/')}/ingest_source"
    try:
        return spark.read.schema("source STRING").parquet(path).first()["source"]
    except AnalysisException:
        spark.createDataFrame([(f"stream-{uuid.uuid4().hex}",)], "source STRING").coalesce(1).write.parquet(path)
        return spark.read.schema("source STRING").parquet(path).first()["source"]


def start_ingest(
    topic: DataFrame,
    tables: EntityTables,
    checkpoint: str,
    available_now: bool = False,
    interval: str = "1 second",
    dedupe_event_id: bool = False,
    skip_known: bool = False,
) -> StreamingQuery:
    """Run the ingest over a streaming topic source.

    A failed batch is retried by Structured Streaming with the same number and the same messages; nothing
    is dropped and nothing is applied twice. A new checkpoint is a new source: its batches are applied to what the
    tables hold, whatever numbers they have, so a topic can be read again from its start; with ``skip_known`` only what the
    tables have not taken yet is applied, and the topic may be read from any offset they know.
    """
    source = _source_id(tables.spark, checkpoint)

    def handle(batch: DataFrame, batch_id: int) -> None:
        apply_batch(tables, batch.select(*S.TOPIC.names), batch_id, dedupe_event_id=dedupe_event_id, source=source, skip_known=skip_known)

    trigger = {"availableNow": True} if available_now else {"processingTime": interval}
    return (
        topic.writeStream.foreachBatch(handle)
        .option("checkpointLocation", checkpoint)
        .queryName("order-event-ingest")
        .trigger(**trigger)
        .start()
    )


def replay(tables: EntityTables, log: DataFrame, now: datetime | None = None, dedupe_event_id: bool = False) -> None:
    """Apply a bounded log in one batch, onto whatever the tables hold.

    Users, orders, items and payments that were there come out the same; stock moves again unless event ids are
    deduplicated.
    """
    apply_batch(tables, log, now=now, dedupe_event_id=dedupe_event_id)
