"""Queries with expected SQL on the smallest sample, and on small tables made to be awkward."""

from pathlib import Path

import duckdb
import pyarrow as pa
import pyarrow.parquet as pq
import pytest

from tests.llm.rows import awkward_rows
from tests.llm.test_prefix_trie import awkward_talks
from tidemark.llm.expected import EXPECTED
from tidemark.llm.queries import QUERIES


def assert_same(spark, folder, name):
    con = duckdb.connect()
    for path in Path(folder).glob("*.parquet"):
        con.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    found = QUERIES[name](spark, str(folder))
    columns = sorted(found.columns)
    cursor = con.execute(EXPECTED[name])
    places = [[d[0] for d in cursor.description].index(c) for c in columns]
    expected = sorted((repr(tuple(r[i] for i in places)) for r in cursor.fetchall()))
    assert sorted(repr(tuple(r[c] for c in columns)) for r in found.collect()) == expected


@pytest.mark.parametrize("name", sorted(EXPECTED))
def test_on_the_sample(spark, sf_dir, name):
    assert_same(spark, sf_dir, name)


@pytest.fixture(scope="module")
def small_tables(tmp_path_factory):
    folder = tmp_path_factory.mktemp("tables")
    unique = {}
    for i, row in enumerate(awkward_rows()):
        unique.setdefault(100 + i, row)  # the SQL takes ids for unique
    base = "the quick brown fox jumps over the lazy dog and runs far away from all of the noise in town today".split()
    texts = [r[1] for r in unique.values()] + [" ".join(base[:-i] or base) for i in range(4)] + [" ".join(base).upper(), " ".join(base[3:14]) + " x", "Fox, JUMPS! over"]
    ids = [*unique, *range(900, 900 + len(texts) - len(unique))]
    pq.write_table(pa.table({"doc_id": pa.array(ids, pa.int64()), "text": pa.array(texts, pa.string()), "source": pa.array([None if i % 4 == 0 else f"s{i % 4}" for i in ids], pa.string())}), folder / "documents.parquet")
    items = [(1, " ".join(base)), (2, "fox jumps"), (10, "FOX jumps, over"), (3, None), (4, "..."), (5, " ".join(base[:12])), (6, "nowhere to be found at all in any of these texts")]
    pq.write_table(pa.table({"item_id": pa.array([i for i, _ in items], pa.int64()), "text": [t for _, t in items]}), folder / "benchmark.parquet")
    link = '<p>see <a class=x href="http://{}/a">it</a> and <A HREF=//{}>that</A></p>'
    urls = [
        ("http://A.org/x", link.format("b.net", "c.net")), ("https://b.net/y?u=://z.org/", link.format("C.net:80", "d.net")), ("http://shop.com/de/1", link.format("e.net", "e.net")),
        ("http://f.net/1", link.format("shop.com", "a.org")), ("http://g.net#frag/es/", link.format("shop.com", "shop.com")), ("http://x.example.org/es/1", None), ("http://example.org/en/12", ""),
        ("http://notexample.org/en/1", "<a href='/own'>"), ("http://com/fr/", None), ("http://org", None), (None, None), ("no scheme", "x"), ("http://f.net/1", link.format("shop.com", "a.org")), ("://", None), ("http://d.net/2", link.format("h.net", "shop.com")),
    ]
    pq.write_table(pa.table({"page_id": pa.array(range(len(urls)), pa.int64()), "url": [u for u, _ in urls], "html": [h for _, h in urls]}), folder / "pages.parquet")
    talks = list(zip(*awkward_talks(), strict=True))
    named = zip(["conv_id", "turn", "role", "text"], [pa.int64(), pa.int64(), pa.string(), pa.string()], talks, strict=True)
    pq.write_table(pa.table({n: pa.array(c, t) for n, t, c in named}), folder / "conversations.parquet")
    return folder


@pytest.mark.parametrize("name", sorted(EXPECTED))
def test_on_awkward_tables(spark, small_tables, name):
    assert_same(spark, small_tables, name)
