"""The trie of conversations that begin alike, from vertical bitmaps.

Conversations are dealt into shards of neighbouring ids. A shard holds, for each position and turn, the set of its
conversations with that turn there, as bits. Going down from the set of all, the set of a node cut with a posting of the
next position is the set of a child; its bits count the members, and those without a further turn end there.

Nodes of different shards that stand for the same beginning have the same chained digest, and what is reported of a
node is a sum over shards. So that subtrees can be summed too, every node belongs to its smallest member: a first pass
finds the depth from which each conversation owns the nodes on its way, and a second one counts each node, each leaf and
each text in the shard of its owner only.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.session import staged

#: Conversations of a shard, and turns beyond which it is closed; a longer conversation is a shard of its own.
SHARD, SHARD_TURNS = 4096, 65_536

#: The digest of no turns at all.
ROOT = bytes(16)


def turn_keys(conversations: DataFrame) -> DataFrame:
    """``(conv, pos, key, n_words)``: the place of each turn of ``(conv_id, turn, role, text)``, and a digest of it.

    Turns are ordered by ``turn`` (null first), turns of the same number by role, then by digest. A null role or text
    counts as empty. Rows without ``conv_id`` belong to no conversation and are left out; repeated rows are turns of their
    own. Digests are the first half of SHA-256, so only equal turns have equal ones.
    """
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    digest = F.unhex(F.sha2(F.concat(F.length(role).cast("string"), F.lit(":"), role, text), 256))
    turns = conversations.where("conv_id IS NOT NULL").select(
        F.col("conv_id").cast("long").alias("conv"),
        "turn",
        role.alias("role"),
        F.substring(digest, 1, 16).alias("key"),
        F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")).cast("long").alias("n_words"),
    )
    order = Window.partitionBy("conv").orderBy(F.col("turn").asc_nulls_first(), "role", "key")
    return turns.withColumn("pos", F.row_number().over(order) - 1).select("conv", "pos", "key", "n_words")


def _key_after(parent: bytes, turn: bytes) -> bytes:
    return hashlib.sha256(parent + turn).digest()[:16]


@dataclass
class Conversation:
    """Turns in order, as digest and words; from which depth on the nodes are its own, and whether one has no child."""

    conv: int
    turns: list[tuple[bytes, int]]
    owns_from: int | None = None
    owns_leaf: bool = False


@dataclass
class _Node:
    bits: int
    depth: int
    key: bytes
    parent: int
    words: int
    low: int = 0
    going_on: int = 0
    children: int = 0
    leaves: int = 0
    saved: int = 0


def walk(shard: list[Conversation]) -> list[_Node]:
    """The nodes of a shard, each parent before its children; counts are what the shard's own conversations add."""
    postings: list[dict[bytes, int]] = []
    for c, conversation in enumerate(shard):
        for pos, (turn, _) in enumerate(conversation.turns):
            if pos == len(postings):
                postings.append({})
            postings[pos][turn] = postings[pos].get(turn, 0) | 1 << c
    longer = [0] * (len(postings) + 1)
    for pos, here in enumerate(postings):
        for bits in here.values():
            longer[pos] |= bits
    nodes: list[_Node] = []
    open_ = [_Node((1 << len(shard)) - 1, 0, ROOT, -1, 0)]
    while open_:
        node = open_.pop()
        at = len(nodes)
        nodes.append(node)
        node.low = (node.bits & -node.bits).bit_length() - 1
        node.going_on = rest = node.bits & longer[node.depth]
        while rest:
            first = (rest & -rest).bit_length() - 1
            turn, words = shard[first].turns[node.depth]
            child = node.bits & postings[node.depth][turn]
            rest ^= child
            open_.append(_Node(child, node.depth + 1, _key_after(node.key, turn), at, words))
    for node in reversed(nodes):
        low = shard[node.low]
        own = low.owns_from is not None and low.owns_from <= node.depth
        node.saved += node.words * (node.bits.bit_count() - own)
        node.leaves += own and low.owns_leaf and len(low.turns) == node.depth
        if node.parent >= 0:
            parent = nodes[node.parent]
            parent.children += own
            parent.leaves += node.leaves
            parent.saved += node.saved
    return nodes


def members_of(bits: int, shard: list[Conversation]) -> list[int]:
    """Ids of the conversations of a set, ascending like the shard."""
    found = []
    while bits:
        low = bits & -bits
        found.append(shard[low.bit_length() - 1].conv)
        bits ^= low
    return found


def _conversations(batches: Iterator[pa.RecordBatch]) -> Iterator[Conversation]:
    """Conversations from rows in the order of ``conv, pos``; the row of position -1 says what it owns."""
    current = None
    for batch in batches:
        for conv, pos, key, n_words, owns_from, owns_leaf in zip(*(batch.column(i).to_pylist() for i in range(6)), strict=True):
            if current is None or conv != current.conv:
                if current is not None:
                    yield current
                current = Conversation(conv, [])
            if pos < 0:
                current.owns_from, current.owns_leaf = owns_from, bool(owns_leaf)
            else:
                current.turns.append((key, n_words))
    if current is not None:
        yield current


def _shards(batches: Iterator[pa.RecordBatch]) -> Iterator[list[Conversation]]:
    shard, turns = [], 0
    for conversation in _conversations(batches):
        if shard and (len(shard) >= SHARD or turns + len(conversation.turns) > SHARD_TURNS):
            yield shard
            shard, turns = [], 0
        shard.append(conversation)
        turns += len(conversation.turns)
    if shard:
        yield shard


def _owner_pass(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per node of a shard its smallest member and whether any goes on."""
    for shard in _shards(batches):
        nodes = walk(shard)
        yield pa.RecordBatch.from_arrays(
            [
                pa.array([n.key for n in nodes], pa.binary()),
                pa.array([n.depth for n in nodes], pa.int64()),
                pa.array([shard[n.low].conv for n in nodes], pa.int64()),
                pa.array([n.going_on != 0 for n in nodes], pa.bool_()),
            ],
            ["key", "depth", "conv", "goes_on"],
        )


def _node_pass(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per node of a shard what it adds to the node, and the conversations that end there."""
    for shard in _shards(batches):
        nodes = walk(shard)
        counts = {
            "depth": [n.depth for n in nodes],
            "conv": [shard[n.low].conv for n in nodes],
            "n_convs": [n.bits.bit_count() for n in nodes],
            "n_children": [n.children for n in nodes],
            "n_leaves": [n.leaves for n in nodes],
            "saved_words": [n.saved for n in nodes],
        }
        keys = [pa.array([n.key for n in nodes], pa.binary()), pa.array([nodes[n.parent].key if n.parent >= 0 else None for n in nodes], pa.binary())]
        ended = pa.array([members_of(n.bits & ~n.going_on, shard) for n in nodes], pa.list_(pa.int64()))
        yield pa.RecordBatch.from_arrays([*keys, *(pa.array(v, pa.int64()) for v in counts.values()), ended], ["key", "parent_key", *counts, "ended"])


def prefix_trie(turns: DataFrame, members: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``(nodes, ends)`` of the conversations ``members(conv)`` with the turns ``turns(conv, pos, key, n_words)``.

    ``conv`` is unique in ``members``, and positions of a conversation are all different. Each sequence of first turns
    that some conversation has is a node; that of no turns is the root, of which every conversation is a member, also
    one without turns. ``nodes``: ``key``, ``parent_key`` (null for the root), ``conv`` and ``parent_conv`` (smallest
    members), ``depth``, ``n_convs`` (members), ``n_children``, ``n_leaves`` (nodes without children in its subtree, itself
    included), ``saved_words`` (over its subtree, words of the last turn times the members but one). ``ends``: the
    conversations that end at a node, as ``(key, first_conv, convs)``; lists of one node follow each other by
    ``first_conv`` and are bounded by a shard. Without members there are no nodes.

    A task reads conversations one after another and holds a shard; a single conversation lies in one task whole, with
    some hundred bytes a turn.
    """
    turns, members = staged(turns), staged(members)
    told = "conv long, pos int, key binary, n_words long, owns_from long, owns_leaf boolean"

    def laid_out(members: DataFrame) -> DataFrame:
        heads = members.selectExpr("conv", "-1 AS pos", "cast(NULL AS binary) AS key", "0L AS n_words", "owns_from", "owns_leaf")
        rows = heads.unionByName(turns.selectExpr("conv", "pos", "key", "n_words", "cast(NULL AS long) AS owns_from", "cast(NULL AS boolean) AS owns_leaf"))
        rows = rows.selectExpr(*(f"cast({c} AS {t}) AS {c}" for c, t in (field.split() for field in told.split(", "))))
        return rows.repartitionByRange("conv").sortWithinPartitions("conv", "pos")

    unowned = members.selectExpr("conv", "cast(NULL AS long) AS owns_from", "cast(NULL AS boolean) AS owns_leaf")
    found = laid_out(unowned).mapInArrow(_owner_pass, "key binary, depth long, conv long, goes_on boolean")
    found = found.groupBy("key").agg(F.min("depth").alias("depth"), F.min("conv").alias("conv"), F.max("goes_on").alias("goes_on"))
    owners = found.groupBy("conv").agg(F.min("depth").alias("owns_from"), F.max(~F.col("goes_on")).alias("owns_leaf"))
    owned = staged(members.join(owners, "conv", "left"))

    counts = ["n_convs", "n_children", "n_leaves", "saved_words"]
    schema = "key binary, parent_key binary, depth long, conv long, " + ", ".join(f"{c} long" for c in counts) + ", ended array<long>"
    parts = staged(laid_out(owned).mapInArrow(_node_pass, schema))
    least = [F.min(c).alias(c) for c in ("parent_key", "depth", "conv")]
    nodes = staged(parts.groupBy("key").agg(*least, *(F.sum(c).alias(c) for c in counts)))
    parents = nodes.selectExpr("key AS parent_key", "conv AS parent_conv")
    ends = parts.where("size(ended) > 0").selectExpr("key", "ended[0] AS first_conv", "ended AS convs")
    return nodes.join(parents, "parent_key", "left"), ends


def _digest_pass(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``(key, first_conv, convs)`` in order -> ``(key, ends_sha256)``, reading one list at a time."""

    def done(key: bytes, digest) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([key], pa.binary()), pa.array([digest.hexdigest()])], ["key", "ends_sha256"])

    key = digest = None
    for batch in batches:
        keys, digests = [], []
        for own, convs in zip(batch.column(0).to_pylist(), batch.column(2), strict=True):
            text = ",".join(map(str, convs.as_py())).encode()
            if own == key:
                digest.update(b"," + text)
                continue
            if key is not None:
                keys.append(key)
                digests.append(digest.hexdigest())
            key, digest = own, hashlib.sha256(text)
        yield pa.RecordBatch.from_arrays([pa.array(keys, pa.binary()), pa.array(digests, pa.string())], ["key", "ends_sha256"])
    if key is not None:
        yield done(key, digest)


def ends_digest(ends: DataFrame) -> DataFrame:
    """``(key, ends_sha256)``: SHA-256 of the ids that end at a node, in decimal, ascending, with commas between them."""
    return ends.repartition("key").sortWithinPartitions("key", "first_conv").mapInArrow(_digest_pass, "key binary, ends_sha256 string")
