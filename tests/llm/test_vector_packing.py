"""Packing: tokens come back whole, the limits hold, little is padded."""

import random
import zlib
from collections import defaultdict
from pathlib import Path

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tests.llm.rows import AWKWARD, awkward
from tidemark.llm.queries import END_ID, QUERIES, WORD_TOKENIZER
from tidemark.llm.vector_packing import Limits, WordTokenizer, pack_examples

DEFINITION = Path(WORD_TOKENIZER).read_text(encoding="utf-8")


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_str(DEFINITION)


def ids_of(tokenizer, text):
    return tokenizer.encode(text or "", add_special_tokens=False).ids


def test_units_give_the_ids_of_whole_texts(tokenizer):
    rng = random.Random(3)
    letters = "ÀÖ×÷ßœaZ9 '<|>.,\t\n\x0b\x1c\x85\xa0é́İΣ漢🚨s_tdm-"
    texts = ["".join(rng.choice(letters) for _ in range(rng.randrange(60))) for _ in range(1500)]
    texts += ["x<|startoftext|>Y <|ENDOFTEXT|>", "don't WE'LL it's'", "a\x00b \x7f", "", None, "É" * 3000, "ends in <", "|begins"]
    own = WordTokenizer(DEFINITION)
    for _ in range(2):
        ids, counts = own.encode(pa.array(texts))
        ends = np.cumsum(counts)
        for text, end, n in zip(texts, ends, counts, strict=True):
            assert ids[end - n : end].tolist() == ids_of(tokenizer, text), repr(text)


def assert_packed(pieces, ids_by_doc, limits, key=lambda r: r["doc_id"]):
    """Pieces cover every example once, sequences have no gaps and keep the limits; returns the tokens padded."""
    by_doc, by_sequence = defaultdict(list), defaultdict(list)
    for r in pieces:
        by_doc[key(r)].append(r)
        by_sequence[r["sequence_id"]].append(r)
    assert set(by_doc) == set(ids_by_doc)
    for doc, rows in by_doc.items():
        at = 0
        for r in sorted(rows, key=lambda r: r["start"]):
            assert r["start"] == at and r["length"] > 0 and r["doc_tokens"] == len(ids_by_doc[doc])
            own = np.array(ids_by_doc[doc][at : at + r["length"]], dtype="<u4").tobytes()
            assert zlib.crc32(own) == r["ids_crc32"]
            at += r["length"]
        assert at == len(ids_by_doc[doc])
    padded = 0
    for rows in by_sequence.values():
        at = 0
        for r in sorted(rows, key=lambda r: r["offset"]):
            assert r["offset"] == at
            at += r["length"]
        assert at <= limits.tokens and len(rows) <= limits.segments
        padded += 0 if at & (at - 1) == 0 else limits.tokens - at
    return padded


def test_query_on_the_sample(spark, sf_dir, tokenizer):
    docs = {r["doc_id"]: [*ids_of(tokenizer, r["text"]), END_ID] for r in pq.read_table(f"{sf_dir}/documents.parquet").to_pylist()}
    pieces = QUERIES["op13_vector_packing"](spark, sf_dir).collect()
    padded = assert_packed(pieces, docs, Limits())
    assert padded < 0.005 * sum(map(len, docs.values()))
    assert sorted(map(tuple, QUERIES["op13_vector_packing"](spark, sf_dir).collect())) == sorted(map(tuple, pieces))


def test_instruction_data_keeps_all_limits(spark, sf_dir, tokenizer):
    """Conversations, of which answers are learned from, under limits that all bind; in one window and in several."""
    turns = spark.read.parquet(f"{sf_dir}/conversations.parquet")
    talks = turns.groupBy("conv_id").agg(F.sort_array(F.collect_list(F.struct("turn", "role", "text"))).alias("turns")).repartition(3)
    parts = F.transform("turns", lambda t: F.struct(t["text"].alias("text"), (t["role"] == "assistant").alias("learn")))
    limits = Limits(tokens=512, segments=3, learned=200, least_cut=8)
    pieces = pack_examples(talks, parts, DEFINITION, END_ID, ["conv_id"], limits)
    pieces = pieces.select("doc.conv_id", "*", F.crc32("ids").alias("ids_crc32")).collect()
    expected, learned = {}, {}
    for r in talks.collect():
        ids, marks = [], []
        for t in r["turns"]:
            own = ids_of(tokenizer, t["text"])
            ids += own
            marks += [t["role"] == "assistant"] * len(own)
        expected[r["conv_id"]] = [*ids, END_ID]
        learned[r["conv_id"]] = [*marks, r["turns"][-1]["role"] == "assistant"]
    assert_packed(pieces, expected, limits, key=lambda r: r["conv_id"])
    per_sequence = defaultdict(int)
    for r in pieces:
        n = sum(learned[r["conv_id"]][r["start"] : r["start"] + r["length"]])
        assert n == r["n_learned"]
        per_sequence[r["sequence_id"]] += n
    assert max(per_sequence.values()) <= limits.learned


def test_rows_it_must_bear(spark, tokenizer):
    rows = awkward(spark).withColumn("no", F.monotonically_increasing_id())
    parts = F.array(F.struct(F.col("text").alias("text"), F.lit(True).alias("learn")))
    pieces = pack_examples(rows, parts, DEFINITION, END_ID, rows.columns).select("doc.no", "*", F.crc32("ids").alias("ids_crc32")).collect()
    expected = {r["no"]: [*ids_of(tokenizer, r["text"]), END_ID] for r in rows.collect()}
    assert_packed(pieces, expected, Limits(), key=lambda r: r["no"])
    empty = spark.createDataFrame([], AWKWARD)
    assert pack_examples(empty, parts, DEFINITION, END_ID, ["doc_id"]).count() == 0
    none = rows.where("doc_id = 3")
    for nothing in (F.lit(None), F.array(F.struct(F.lit(None).alias("text"), F.lit(None).alias("learn")))):
        found = pack_examples(none, nothing, DEFINITION, END_ID, ["no"]).collect()
        assert [(r["length"], r["n_learned"]) for r in found] == [(1, 0)] * none.count()


def test_many_tiny_examples(spark):
    """Nine thousand empty texts fill sequences up to the limit of segments."""
    rows = spark.range(9000).coalesce(1)
    parts = F.array(F.struct(F.lit("").alias("text"), F.lit(True).alias("learn")))
    sizes = pack_examples(rows, parts, DEFINITION, END_ID, ["id"]).groupBy("sequence_id").count().collect()
    assert sum(r["count"] for r in sizes) == 9000 and max(r["count"] for r in sizes) == Limits().segments
