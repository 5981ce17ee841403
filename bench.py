"""Time the headline queries and one streaming ingest; print one JSON line."""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from tidemark.plans.catalog import QUERIES  # noqa: E402
from tidemark.session import local_session  # noqa: E402
from tidemark.sources import views  # noqa: E402
from tidemark.sources.topic import stream_topic_files  # noqa: E402
from tidemark.streaming.ingest_job import start_ingest  # noqa: E402
from tidemark.streaming.tables import EntityTables  # noqa: E402

HEADLINE = (
    "user_last5_orders", "order_with_payment", "recent_users", "orders_per_user", "orders_payments_sorted",
    "table_counts_union", "inventory_minmax", "parse_route_counts", "upsert_users", "upsert_orders",
    "upsert_payments", "inventory_balance", "dlq_entries", "outcome_summary", "events_per_second",
    "latency_histogram", "latency_quantiles", "log_severity", "log_correlation", "keyed_publish",
)


def timed(work) -> float:
    start = time.perf_counter()
    work()
    return round(time.perf_counter() - start, 3)


def run_query(spark, name: str, sf_dir: str) -> None:
    QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()


def stream_ingest(spark, sf_dir: str) -> tuple[float, int]:
    """Seconds and messages of a stream over the whole log, one micro-batch for each kind of message."""
    base = tempfile.mkdtemp(prefix="tidemark-bench-")
    for log in (views.user_log, views.order_log, views.payment_log, views.stock_log):
        log(spark, sf_dir).drop("seq").coalesce(1).write.mode("append").parquet(f"{base}/topic")
    messages = spark.read.parquet(f"{base}/topic").count()
    tables = EntityTables(spark, f"{base}/tables", buckets=8)

    def work():
        topic = stream_topic_files(spark, f"{base}/topic", max_files=1)
        query = start_ingest(topic, tables, f"{base}/checkpoint", available_now=True)
        query.awaitTermination()

    return timed(work), messages


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    spark = local_session(os.environ.get("BENCH_CPUS", "8"), "tidemark-bench")
    run_query(spark, "user_last5_orders", sf_dir)  # start the JVM and its file readers
    seconds = {name: timed(lambda name=name: run_query(spark, name, sf_dir)) for name in HEADLINE}
    stream_seconds, messages = stream_ingest(spark, sf_dir)
    seconds["stream_ingest"] = stream_seconds
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(sf_dir.rstrip("/")),
                "stream_messages_per_second": round(messages / stream_seconds, 1),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
