"""Named queries against their expected SQL on the smallest sample."""

import datetime as dt
from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as entry_points
from tidemark.plans.catalog import QUERIES
from tidemark.plans.expected import EXPECTED

# The queries that settle the whole log share their plans with these and with the other test files.
COVERED = [
    "user_last5_orders", "user_lookup", "order_with_payment", "orders_payments_sorted", "table_counts_row",
    "inventory_sorted", "parse_route_counts", "email_conflicts", "upsert_orders", "dlq_range", "outcome_summary",
    "keyed_publish", "latency_quantiles", "latency_bucket_p95", "log_severity", "log_correlation", "log_tail",
    "log_retention", "log_numbered", "log_files", "user_documents", "order_documents", "payment_struct",
    "merge_orders_again", "merge_items_again", "merge_payments_again", "merge_inventory_again", "replay_onto_tables",
    "balance_refusals", "email_chain", "parse_odd_messages", "dlq_read_entries", "dlq_latest", "dlq_new_since", "rate_gauge", "latency_sketch_quantiles",
]


@pytest.fixture(scope="module")
def sql(sf_dir):
    con = duckdb.connect()
    for path in Path(sf_dir).glob("*.parquet"):
        con.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    return con


def comparable(value):
    return value.isoformat() if isinstance(value, dt.datetime) else repr(value)


@pytest.mark.parametrize("name", COVERED)
def test_query_matches_sql(spark, sql, sf_dir, name):
    found = entry_points.queries()[name](spark, sf_dir)
    columns = sorted(found.columns)
    cursor = sql.execute(entry_points.oracle_sql()[name])
    places = {d[0]: i for i, d in enumerate(cursor.description)}
    assert sorted(places) == columns
    expected = sorted(tuple(comparable(r[places[c]]) for c in columns) for r in cursor.fetchall())
    assert sorted(tuple(comparable(r[c]) for c in columns) for r in found.collect()) == expected


def test_every_query_has_sql():
    assert set(QUERIES) == set(EXPECTED)
    assert set(entry_points.oracle_sql()) <= set(entry_points.queries())


def test_entry(spark):
    assert entry_points.entry(spark).count() > 0
