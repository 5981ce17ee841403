"""The trie of conversations against a brute-force version."""

import hashlib
import random
import re
import zlib
from collections import defaultdict

import pyarrow as pa
import pyarrow.parquet as pq
import pytest

from tidemark.llm import prefix_trie as P
from tidemark.llm.queries import QUERIES

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def rebuilt(rows):
    talks = defaultdict(list)
    for r in rows:
        if r["conv_id"] is not None:
            talks[r["conv_id"]].append(r)
    for turns in talks.values():
        content = lambda r: (r["role"] or "", r["text"] or "")
        digest = lambda r: hashlib.sha256(f"{len(content(r)[0])}:{''.join(content(r))}".encode()).digest()
        turns.sort(key=lambda r: (r["turn"] is not None, r["turn"] or 0, content(r)[0], digest(r)))
        turns[:] = [content(r) for r in turns]
    out = {}
    for c, own in talks.items():
        h = zlib.crc32(str(c).encode()) % 4
        base = c - (c % 20 if c >= 0 else -(-c % 20))
        out[c] = talks.get(base, [])[:h] + own[h:]
    return out


def nodes_of(talks):
    members = defaultdict(list)
    for c in sorted(talks):
        for d in range(len(talks[c]) + 1):
            members[tuple(talks[c][:d])].append(c)
    children = defaultdict(list)
    for path in members:
        if path:
            children[path[:-1]].append(path)
    leaves, saved = defaultdict(int), defaultdict(int)
    for path, convs in members.items():
        gain = (len(convs) - 1) * len(WORD.findall(path[-1][1])) if path else 0
        for d in range(len(path) + 1):
            leaves[path[:d]] += path not in children
            saved[path[:d]] += gain
    rows = []
    for path, convs in members.items():
        ends = ",".join(str(c) for c in convs if len(talks[c]) == len(path))
        parent = members[path[:-1]][0] if path else None
        rows.append((convs[0], len(path), parent, len(convs), len(children[path]), leaves[path], saved[path], hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(rows, key=repr)


COLUMNS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def found_in(spark, folder):
    found = QUERIES["op11_prefix_trie"](spark, str(folder))
    assert found.columns == COLUMNS
    return sorted((tuple(r) for r in found.collect()), key=repr)


def test_query_on_the_sample(spark, sf_dir):
    rows = pq.read_table(f"{sf_dir}/conversations.parquet").to_pylist()
    assert found_in(spark, sf_dir) == nodes_of(rebuilt(rows))


def awkward_talks():
    rng = random.Random(7)
    rows = []
    for c in [*range(-25, 60), 10**12, 10**12 + 3]:
        for turn in range(rng.choice([1, 1, 2, 3, 5])):
            role, text = rng.choice([("user", "hi there"), ("user", "  a  b c"), (None, None), ("", ""), ("us", "erhi"), ("assistant", "漢 🚨\x0bx")])
            rows.append((c, rng.choice([None, turn, turn, 0]), role, text))
    rows += rows[:5]  # repeated rows
    rows += [(None, 0, "user", "of no conversation"), (None, None, None, None)]
    rows += [(77, t, "user", f"turn {t % 3}") for t in range(300)]  # a long one
    return rows


@pytest.fixture(scope="module")
def awkward_folder(tmp_path_factory):
    folder = tmp_path_factory.mktemp("talks")
    columns = list(zip(*awkward_talks(), strict=True))
    types = [pa.int64(), pa.int64(), pa.string(), pa.string()]
    names = ["conv_id", "turn", "role", "text"]
    table = pa.table({n: pa.array(c, t) for n, c, t in zip(names, columns, types, strict=True)})
    # Extra columns with names that the operator uses itself.
    for extra in ("conv", "pos", "key", "n_words", "depth"):
        table = table.append_column(extra, pa.array(["x"] * len(table)))
    pq.write_table(table, folder / "conversations.parquet")
    return folder


@pytest.mark.parametrize("shard, turns", [(4096, 65_536), (3, 65_536), (1, 65_536), (50, 7)])
def test_awkward_talks_in_shards_of_any_size(spark, awkward_folder, shard, turns, monkeypatch):
    """The shard's size changes no result: walk the same conversations in shards of a few."""
    talks = rebuilt([dict(zip(["conv_id", "turn", "role", "text"], r, strict=True)) for r in awkward_talks()])
    expected = nodes_of(talks)
    monkeypatch.setattr(P, "SHARD", shard)
    monkeypatch.setattr(P, "SHARD_TURNS", turns)
    if shard == 4096:
        assert found_in(spark, awkward_folder) == expected
    # The two passes in this process, merged as Spark merges them.
    key = lambda t: hashlib.sha256(f"{len(t[0])}:{t[0]}{t[1]}".encode()).digest()[:16]
    order = sorted(talks)

    def batch(owned):
        rows = []
        for c in order:
            rows.append((c, -1, None, 0, *owned.get(c, (None, None))))
            rows += [(c, i, key(t), len(WORD.findall(t[1])), None, None) for i, t in enumerate(talks[c])]
        types = [pa.int64(), pa.int32(), pa.binary(), pa.int64(), pa.int64(), pa.bool_()]
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)], list("abcdef"))

    found = {}
    for part in P._owner_pass(iter([batch({})])):
        for r in part.to_pylist():
            old = found.get(r["key"], (r["conv"], r["depth"], False))
            found[r["key"]] = (min(old[0], r["conv"]), r["depth"], old[2] or r["goes_on"])
    owned = {}
    for conv, depth, goes_on in found.values():
        old = owned.get(conv, (depth, False))
        owned[conv] = (min(old[0], depth), old[1] or not goes_on)
    sums, ends = {}, defaultdict(list)
    for part in P._node_pass(iter([batch(owned)])):
        for r in part.to_pylist():
            old = sums.setdefault(r["key"], [r["conv"], r["depth"], r["parent_key"], 0, 0, 0, 0])
            old[0] = min(old[0], r["conv"])
            for i, name in enumerate(["n_convs", "n_children", "n_leaves", "saved_words"], start=3):
                old[i] += r[name]
            ends[r["key"]] += r["ended"]
    rows = [(s[0], s[1], sums[s[2]][0] if s[2] else None, *s[3:], hashlib.sha256(",".join(map(str, ends[k])).encode()).hexdigest()) for k, s in sums.items()]
    assert sorted(rows, key=repr) == expected


def test_no_conversations(spark):
    empty = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    turns = P.turn_keys(empty)
    nodes, ends = P.prefix_trie(turns, turns.select("conv"))
    assert nodes.count() == 0 and P.ends_digest(ends).count() == 0


def test_digest_goes_on_over_lists(spark):
    ends = spark.createDataFrame([(bytearray(b"a"), 5, [5, 6]), (bytearray(b"b"), 9, [9]), (bytearray(b"a"), 30, [30]), (bytearray(b"a"), -3, [-3, 1])], "key binary, first_conv long, convs array<long>")
    found = {bytes(r["key"]): r["ends_sha256"] for r in P.ends_digest(ends).collect()}
    assert found == {b"a": hashlib.sha256(b"-3,1,5,6,30").hexdigest(), b"b": hashlib.sha256(b"9").hexdigest()}
