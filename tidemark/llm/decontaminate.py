"""Benchmark decontamination as a prefix-filtered set join.

A window of an item occurs in a document if all of its shingles do, one after the other. So the shingles of a
window are ordered by rarity in the documents, and the rarest alone is the prefix that an occurrence must hold
(the overlap asked for is the whole window). Document positions of prefix shingles are joined with the
windows; the length and position bounds say where the window would have to lie, and the words there are
compared one by one.

Documents are read twice: to count the shingles of the benchmark in them, and to find the prefix shingles. In
between only a map of fixed size goes to the tasks.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm.hash_map import hash_map, passing
from tidemark.llm.text_blocks import ALNUM, blocks, find_words, range_hashes, sequence_hashes
from tidemark.session import staged

#: Words in a shingle; windows of fewer words are one shingle.
SHINGLE = 3


def _spelled(block, words, i: int, j: int) -> list[str]:
    return [block.data[a:b].tobytes().decode() for a, b in zip(words.starts[i:j], words.ends[i:j], strict=True)]


def _window_pass(width: int):
    """``(item_id, text)`` -> a row per window: its words, and the hashes of its shingles."""

    def run(batches):
        for batch in batches:
            ids, texts, sizes, grams = [], [], [], []
            for block in blocks(batch.column(1)):
                block = block.lowered()
                words = find_words(block, ALNUM)
                hashes = range_hashes(block.data, words.starts, words.ends)
                for row, (a, b) in enumerate(zip(words.bounds[:-1], words.bounds[1:], strict=True)):
                    size = min(width, b - a)
                    if not size:
                        continue
                    spelled = _spelled(block, words, a, b)
                    shingles = sequence_hashes(hashes[a:b], min(SHINGLE, size)).view(np.int64).tolist()
                    for k in range(b - a - size + 1):
                        ids.append(batch.column(0)[block.first + row])
                        texts.append(" ".join(spelled[k : k + size]))
                        sizes.append(size)
                        grams.append(shingles[k : k + size - min(SHINGLE, size) + 1])
            yield pa.RecordBatch.from_arrays(
                [pa.array([x.as_py() for x in ids], pa.int64()), pa.array(texts, pa.string()), pa.array(sizes, pa.int32()), pa.array(grams, pa.list_(pa.int64()))],
                ["item_id", "window", "size", "grams"],
            )

    return run


def _shingles(words, hashes: np.ndarray, bits: np.ndarray, lengths: list[int]):
    """Positions and hashes of the shingles of these lengths that pass the map, within single rows."""
    rows = words.row_of_word()
    for length in lengths:
        grams = sequence_hashes(hashes, length)
        at = np.flatnonzero(passing(bits, grams))
        at = at[rows[at] == rows[at + length - 1]]
        yield rows[at], at, grams[at]


def _count_pass(shared_map, lengths: list[int]):
    def run(batches):
        for batch in batches:
            for block in blocks(batch.column(0)):
                block = block.lowered()
                words = find_words(block, ALNUM)
                hashes = range_hashes(block.data, words.starts, words.ends)
                for _, _, grams in _shingles(words, hashes, shared_map.value, lengths):
                    values, counts = np.unique(grams, return_counts=True)
                    yield pa.RecordBatch.from_arrays([pa.array(values.view(np.int64)), pa.array(counts)], ["gram", "c"])

    return run


def _candidate_pass(shared_map, lengths: list[int], width: int):
    """``(row, doc, text)`` -> ``(row, doc, n_words, found)``; ``found`` has the words around each candidate."""
    kind = pa.list_(pa.struct([("gram", pa.int64()), ("pos", pa.int32()), ("first", pa.int32()), ("near", pa.list_(pa.string()))]))

    def run(batches):
        for batch in batches:
            for block in blocks(batch.column(2)):
                part = batch.slice(block.first, block.rows)
                block = block.lowered()
                words = find_words(block, ALNUM)
                hashes = range_hashes(block.data, words.starts, words.ends)
                found: list[list] = [[] for _ in range(block.rows)]
                for rows, at, grams in _shingles(words, hashes, shared_map.value, lengths):
                    for row, i, gram in zip(rows.tolist(), at.tolist(), grams.view(np.int64).tolist(), strict=True):
                        a, b = int(words.bounds[row]), int(words.bounds[row + 1])
                        lo, hi = max(a, i - width), min(b, i + width)
                        found[row].append({"gram": gram, "pos": i - a, "first": lo - a, "near": _spelled(block, words, lo, hi)})
                sizes = pa.array(np.diff(words.bounds), pa.int64())
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), sizes, pa.array(found, kind)], ["row", "doc", "n_words", "found"])

    return run


def benchmark_hits(docs: DataFrame, benchmark: DataFrame, keep: list[str], text_col: str = "text", item_col: str = "item_id", width: int = 10) -> tuple[DataFrame, DataFrame]:
    """Documents as ``(row, doc, n_words, near)`` and the window occurrences in them as ``(row, start, size, window, items)``.

    Words are runs of digits, letters a-z (A-Z lower-cased) and characters beyond ASCII. A window is ``width``
    consecutive words of an item, or all words of a shorter item; items without a word have none. Each row of
    ``docs`` is judged for itself; ``row`` numbers the rows, ``doc`` has their ``keep`` columns. Null texts have no words.
    Only rows that are ``near`` have occurrences; they hold a shingle that the map of prefixes lets through.
    """
    spark = docs.sparkSession
    windows = staged(benchmark.select(F.col(item_col).cast("long"), F.col(text_col)).mapInArrow(_window_pass(width), "item_id long, window string, size int, grams array<long>"))
    distinct = staged(windows.groupBy("window", "size").agg(F.first("grams").alias("grams")))
    lengths = sorted(r[0] for r in distinct.select(F.least("size", F.lit(SHINGLE))).distinct().collect())
    grams = distinct.select(F.explode("grams").alias("gram")).distinct()

    every = spark.sparkContext.broadcast(hash_map(grams, "gram"))
    counts = docs.select(text_col).mapInArrow(_count_pass(every, lengths), "gram long, c long").groupBy("gram").agg(F.sum("c").alias("c"))
    ranked = distinct.select("window", "size", F.posexplode("grams").alias("at", "gram")).join(counts, "gram", "left")
    prefix = ranked.groupBy("window", "size").agg(F.min(F.struct(F.coalesce("c", F.lit(0)).alias("c"), "gram", "at")).alias("p"))
    prefix = staged(prefix.where("p.c > 0").select("window", "size", "p.gram", "p.at"))

    rarest = spark.sparkContext.broadcast(hash_map(prefix, "gram"))
    numbered = docs.select(F.monotonically_increasing_id().alias("row"), F.struct(*keep).alias("doc"), F.col(text_col).alias("text"))
    found = T.ArrayType(T.StructType.fromDDL("gram long, pos int, first int, near array<string>"))
    schema = numbered.select("row", "doc").schema.add("n_words", "long").add("found", found)
    rows = staged(numbered.mapInArrow(_candidate_pass(rarest, lengths, width), schema))

    candidates = rows.where("size(found) > 0").select("row", "n_words", F.inline("found"))
    met = candidates.join(prefix, "gram").where("pos >= at AND pos - at + size <= n_words")
    met = met.where("array_join(slice(near, pos - at - first + 1, size), ' ') = window")
    hits = staged(met.selectExpr("row", "pos - at AS start", "size", "window"))
    return rows.select("row", "doc", "n_words", (F.size("found") > 0).alias("near")), hits.join(windows.groupBy("window").agg(F.collect_set("item_id").alias("items")), "window")


def decontaminate(docs: DataFrame, benchmark: DataFrame, keep: list[str], **columns) -> DataFrame:
    """``(doc, n_words, n_hit, items)`` of every row of ``docs``: words inside window occurrences, and item ids.

    See ``benchmark_hits``. ``items`` are sorted as strings; an item with a null id is hit like others but not
    listed. Without occurrences ``n_hit`` is 0 and ``items`` empty. Overlapping windows count a word once. Only documents
    near a window are shuffled.
    """
    rows, hits = benchmark_hits(docs, benchmark, keep, **columns)
    before = Window.partitionBy("row").orderBy("start", "size").rowsBetween(Window.unboundedPreceding, -1)
    ends = hits.select("row", "start", "size").withColumn("done", F.coalesce(F.max(F.col("start") + F.col("size")).over(before), F.lit(0)))
    covered = ends.groupBy("row").agg(F.sum(F.greatest(F.lit(0), F.col("start") + F.col("size") - F.greatest("start", "done"))).alias("n_hit"))
    listed = hits.select("row", F.explode("items").alias("item")).distinct()
    listed = listed.groupBy("row").agg(F.sort_array(F.collect_list(F.col("item").cast("string"))).alias("items"))
    joined = rows.where("near").join(covered.join(listed, "row", "left"), "row", "left")
    judged = joined.select("doc", "n_words", F.coalesce("n_hit", F.lit(0)).cast("long").alias("n_hit"), F.coalesce("items", F.array().cast("array<string>")).alias("items"))
    return rows.where("NOT near").select("doc", "n_words", F.lit(0).cast("long").alias("n_hit"), F.array().cast("array<string>").alias("items")).union(judged)
