"""The operators over the sample tables, with production parameters."""

from __future__ import annotations

from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.chunk_dedup import dedup_substrings
from tidemark.llm.decontaminate import decontaminate
from tidemark.llm.jaccard_join import jaccard_components
from tidemark.llm.language_id import identify_languages
from tidemark.llm.line_crf import quality_rules
from tidemark.llm.periodic_runs import periodic_runs
from tidemark.llm.prefix_trie import ends_digest, prefix_trie, turn_keys
from tidemark.llm.quality_knn import quality_scores
from tidemark.llm.source_mix import mix_sources
from tidemark.llm.tag_paths import extract_main_text
from tidemark.llm.token_counts import load_pieces, token_counts
from tidemark.llm.url_trust import judge_urls, rule_table
from tidemark.llm.vector_packing import pack_examples
from tidemark.session import staged


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


#: A vocabulary that marks word starts.
VOCABULARY = "/opt/tokenizers/piece_bpe_32k.model"


def op1_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words and greedy word pieces of every document."""
    found = token_counts(_table(spark, sf_dir, "documents"), load_pieces(VOCABULARY), keep=["doc_id"])
    return found.select("doc.doc_id", "n_words", "n_tokens")


def op2_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One and a half times all words, mixed from the sources by weight."""
    return mix_sources(_table(spark, sf_dir, "documents")).withColumnRenamed("id", "doc_id").drop("source")


def id_digest(modulus: int):
    """The remainder of the documents' id digest that says who may be learned from."""
    return F.crc32(F.col("doc_id").cast("string").cast("binary")) % modulus


#: From this score on a document counts as good.
GOOD_QUALITY = 0.7


def scored_quality(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``(doc, score)``, learned from the labels that are not held out."""
    return quality_scores(docs, labels, id_digest(4) != 2)


def op3_quality_knn(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The quality of every document by its nearest labelled neighbours."""
    found = scored_quality(_table(spark, sf_dir, "documents").select("doc_id", "text"), _table(spark, sf_dir, "labels"))
    found = found.select("doc.doc_id", "score")
    held_out = F.coalesce(id_digest(4) == 2, F.lit(False))
    return found.select("doc_id", held_out.alias("held_out"), "score", (F.col("score") >= GOOD_QUALITY).cast("int").alias("predicted"))


#: Rules on urls.
URL_RULES = [("allow", "org/"), ("block", "example.org/es/"), ("block", "example.org/en/1"), ("allow", "com/fr/"), ("block", "com/de/")]


def op4_url_trust(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Which urls to keep, by rules and by trust that flows between hosts."""
    judged = judge_urls(_table(spark, sf_dir, "pages"), rule_table(spark, URL_RULES), keep=["page_id"])
    return judged.select("page.page_id", "host", "path", "rule", "verdict")


def op5_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Groups of documents whose sets of three-word shingles overlap by nine tenths."""
    found = jaccard_components(_table(spark, sf_dir, "documents"), words=3, num=90, den=100)
    return found.selectExpr("id AS doc_id", "n AS n_shingles", "component AS component_id")


def op6_chunk_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document without the passages that an earlier document has."""
    found = dedup_substrings(_table(spark, sf_dir, "documents"), keep=["doc_id"])
    return found.selectExpr("doc.doc_id", "n_words", "n_removed", "first_ids AS first_doc_ids", "text")


def op7_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of each document inside ten-word windows of benchmark items."""
    found = decontaminate(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"), keep=["doc_id"])
    return found.select(
        "doc.doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )


def op8_line_crf(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base counts of every document, and whether the rules and its content lines keep it."""
    found = quality_rules(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"), keep=["doc_id"])
    return found.select("doc.doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "n_content_words")


def op10_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The language of every document, learned from those that are not held out."""
    docs = _table(spark, sf_dir, "documents")
    found = identify_languages(docs, id_digest(3) != 1, keep=["doc_id"]).select("doc.doc_id", "lang_pred", "score")
    return found.withColumn("held_out", F.coalesce(id_digest(3) == 1, F.lit(False)))


def op9_tag_path(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The main text of every page."""
    found = extract_main_text(_table(spark, sf_dir, "pages"), keep=["page_id", "url"])
    return found.select("page.*", "text", F.length("text").cast("long").alias("n_chars"))


def with_shared_beginnings(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The conversations rebuilt so that they begin with turns of the one whose id ends their twenty, and their ids."""
    convs = turns.where("pos = 0").selectExpr("conv", "conv - conv % 20 AS base", "crc32(cast(cast(conv AS string) AS binary)) % 4 AS h")
    own = turns.where("pos >= crc32(cast(cast(conv AS string) AS binary)) % 4")
    first = turns.where("pos < 3").withColumnRenamed("conv", "base")
    taken = convs.join(first, "base").where("pos < h").select("conv", "pos", "key", "n_words")
    return own.unionByName(taken), convs.select("conv")


def op11_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every beginning that rebuilt conversations share."""
    turns, members = with_shared_beginnings(staged(turn_keys(_table(spark, sf_dir, "conversations"))))
    nodes, ends = prefix_trie(turns, members)
    nodes = nodes.join(ends_digest(ends), "key", "left")
    return nodes.select(
        F.col("conv").alias("conv_id"),
        "depth",
        F.col("parent_conv").alias("parent_conv_id"),
        "n_convs",
        "n_children",
        "n_leaves",
        F.col("saved_words").alias("saved_tokens"),
        F.coalesce("ends_sha256", F.sha2(F.lit(""), 256)).alias("ends_sha256"),
    )


def with_repeats(docs: DataFrame) -> DataFrame:
    """The documents, a tenth of which (by digest of the id) repeat a stretch of their words up to the end."""
    words = F.filter(F.split(F.coalesce("text", F.lit("")), r"[\x20\x09-\x0D]+"), lambda w: w != "")
    listed = docs.select("doc_id", "text", F.crc32(F.col("doc_id").cast("string").cast("binary")).alias("h"))
    listed = listed.withColumn("words", F.when(F.expr("h % 10 = 0"), words)).withColumn("n", F.size("words"))
    placed = listed.withColumn("a", F.expr("h div 10 % nullif(n, 0)"))
    placed = placed.withColumn("p", F.expr("1 + (n - a) div (3 + h div 10 % 8)"))
    repeats = "flatten(array_repeat(slice(words, int(a + 1), int(p)), int((n - a + p - 1) div p)))"
    text = f"array_join(concat(slice(words, 1, int(a)), slice({repeats}, 1, int(n - a))), ' ')"
    return placed.select("doc_id", F.expr(f"CASE WHEN n > 0 THEN {text} ELSE text END AS text"))


def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stretches of every document that repeat four times over, and the text without the repeats."""
    found = periodic_runs(with_repeats(_table(spark, sf_dir, "documents")), keep=["doc_id"])
    lines = "array_join(transform(runs, r -> concat(r.start, ',', r.length, ',', r.period, '\n')), '')"
    best = "array_min(transform(runs, r -> struct(-r.length AS longest, r.start AS start, r.period AS period)))"
    return found.selectExpr("*", f"{best} AS best").selectExpr(
        "doc.doc_id",
        "n_words",
        "cast(size(runs) AS bigint) AS n_runs",
        "best.start AS start",
        "-best.longest AS length",
        "best.period AS period",
        "1000 * -best.longest div best.period AS exponent_milli",
        f"sha2({lines}, 256) AS runs_sha256",
        "sha2(collapsed, 256) AS collapsed_sha256",
    )


#: A tokenizer of words, and the id that ends an example.
WORD_TOKENIZER, END_ID = "/opt/tokenizers/word_bpe_49k.json", 1


def op13_vector_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's pieces in sequences of at most 2,048 tokens."""
    parts = F.array(F.struct(F.col("text").alias("text"), F.lit(True).alias("learn")))
    definition = Path(WORD_TOKENIZER).read_text(encoding="utf-8")
    found = pack_examples(_table(spark, sf_dir, "documents"), parts, definition, END_ID, keep=["doc_id"])
    return found.select("doc.doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


QUERIES = {
    "op1_token_counts": op1_token_counts,
    "op2_source_mix": op2_source_mix,
    "op3_quality_knn": op3_quality_knn,
    "op4_url_trust": op4_url_trust,
    "op5_jaccard_join": op5_jaccard_join,
    "op6_chunk_dedup": op6_chunk_dedup,
    "op7_decontaminate": op7_decontaminate,
    "op8_line_crf": op8_line_crf,
    "op9_tag_path": op9_tag_path,
    "op10_language_id": op10_language_id,
    "op11_prefix_trie": op11_prefix_trie,
    "op12_periodic_runs": op12_periodic_runs,
    "op13_vector_packing": op13_vector_packing,
}
