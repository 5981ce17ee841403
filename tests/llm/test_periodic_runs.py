"""Runs against a brute-force version, and the query against the rules of its contract in plain Python."""

import hashlib
import random
import re
import zlib

import numpy as np
import pyarrow.parquet as pq
import pytest

from tests.llm.rows import AWKWARD, awkward
from tidemark.llm.periodic_runs import COVER, MODULUS, CommonExtensions, find_runs, periodic_runs
from tidemark.llm.queries import QUERIES

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def runs_of(words):
    """``(start, period, length)`` of all runs, period by period."""
    found, n = {}, len(words)
    for p in range(1, n // 4 + 1):
        i = 0
        while i + p < n:
            first = i
            while i + p < n and words[i] == words[i + p]:
                i += 1
            if i > first and i + p - first >= max(6, 4 * p):
                found.setdefault((first, i + p - first), p)
            i += i == first
    return sorted((s, p, length) for (s, length), p in found.items())


def collapsed(words, runs):
    gone = {i for s, p, length in runs for i in range(s + p, s + length)}
    return " ".join(w for i, w in enumerate(words) if i not in gone)


def test_every_remainder_is_a_difference():
    assert {(a - b) % MODULUS for a in COVER for b in COVER} == set(range(MODULUS))


def test_extensions_of_random_and_periodic_words():
    rng = np.random.default_rng(1)
    for words in (rng.integers(0, 2, 700), np.resize(rng.integers(0, 3, 37), 900), np.zeros(500, np.int64), np.zeros(0, np.int64)):
        x = np.append(words, 99)
        i = rng.integers(0, len(x), 300)
        j = rng.integers(0, len(x), 300)
        i, j = np.minimum(i, j)[i != j], np.maximum(i, j)[i != j]
        if len(i):
            expected = [next(k for k in range(len(x)) if x[a + k] != x[b + k]) for a, b in zip(i, j, strict=True)]
            assert CommonExtensions(x).common(i, j).tolist() == expected


@pytest.mark.parametrize("seed", range(4))
def test_runs_of_texts_of_a_block(seed):
    rng = random.Random(seed)
    for _ in range(40):
        texts = []
        for _ in range(rng.randrange(6)):
            words = [rng.randrange(rng.choice([1, 2, 3, 8, 50])) for _ in range(rng.randrange(120))]
            if words and rng.random() < 0.6:
                a = rng.randrange(len(words))
                p = 1 + rng.randrange((len(words) - a) // 3 + 1)
                words = [words[i if i < a else min(a + (i - a) % p, len(words) - 1)] for i in range(len(words))]
            texts.append(words)
        if rng.random() < 0.2:
            texts.append([rng.randrange(2)] * rng.randrange(900) + [5, 6, 7] * rng.randrange(300))
        bounds = np.append(0, np.cumsum([len(t) for t in texts])).astype(np.int64)
        runs = find_runs(np.array([w for t in texts for w in t], dtype=np.int64), bounds)
        found = [[] for _ in texts]
        for t, *run in zip(runs.text, runs.start, runs.period, runs.length, strict=True):
            found[t].append(tuple(run))
        assert found == [runs_of(t) for t in texts]


def expected_row(doc_id, text):
    words = WORD.findall(text or "")
    n, h = len(words), zlib.crc32(str(doc_id).encode()) if doc_id is not None else 1
    if n and h % 10 == 0:
        g = h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [words[i if i < a else a + (i - a) % p] for i in range(n)]
    runs = runs_of(words)
    best = min(runs, key=lambda r: (-r[2], r[0], r[1]), default=None)
    digest = lambda text: hashlib.sha256(text.encode()).hexdigest()
    one = (best[0], best[2], best[1], 1000 * best[2] // best[1]) if best else (None,) * 4
    lines = "".join(f"{s},{length},{p}\n" for s, p, length in runs)
    return (doc_id, n, len(runs), *one, digest(lines), digest(collapsed(words, runs)))


def test_query_on_the_sample(spark, sf_dir):
    found = sorted(tuple(r) for r in QUERIES["op12_periodic_runs"](spark, sf_dir).collect())
    docs = [r for r in pq.read_table(f"{sf_dir}/documents.parquet").to_pylist()]
    assert found == sorted(expected_row(r["doc_id"], r["text"]) for r in docs)
    assert any(r[2] for r in found)


def test_rows_it_must_bear(spark):
    rows = awkward(spark)
    found = periodic_runs(rows, keep=rows.columns).select("doc.*", "runs", "collapsed").collect()
    expected = []
    for r in rows.collect():
        words = WORD.findall(r["text"] or "")
        runs = runs_of(words) if len(words) < 10_000 else None
        expected.append((tuple(r), None if runs is None else [(s, n, p) for s, p, n in runs], None if runs is None else collapsed(words, runs)))
    found = [(tuple(r)[:-2], [tuple(x) for x in r["runs"]], r["collapsed"]) for r in found]
    assert len(found) == len(expected)
    for f, e in zip(sorted(found, key=repr), sorted(expected, key=repr), strict=True):
        assert f[0] == e[0] and (e[1] is None or f == e)
    assert periodic_runs(spark.createDataFrame([], AWKWARD), keep=["doc_id"]).count() == 0
