"""Substring dedup by content-defined chunking.

A chunk begins where a gear rolling hash over the bytes before a word is least among some neighbouring words, so equal
passages are cut alike wherever they stand, but for their ends, and chunks are short. Overlapping runs of neighbouring
chunks are the seeds: every passage of ``min_words`` words holds one whole. Only where seeds repeat are the passages
themselves compared, word by word, and removed everywhere but in their first document.

Documents are read twice: to count the seeds, and to find the stretches around seeds that occur more than once. In
between only a map of fixed size goes to the tasks. These stretches are cut by the hash as well, and one that an earlier
document has goes as a whole; only the first of equal stretches is taken apart into its passages. What is equal is told by 128 bits of two independent hashes.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm.hash_map import hash_map, passing
from tidemark.llm.text_blocks import SPACED, Block, RangeHashes, Words, blocks, find_words, mixed
from tidemark.session import free_shuffles, staged

#: Bytes that the rolling hash covers.
REACH = 16
#: So many words hold more bytes than the rolling hash covers, as no word is shorter than its byte and a separator.
REACH_WORDS = REACH // 2

#: Neighbouring words of which one begins a stretch.
STRETCH = 32

#: The two digests of a passage, and those of a stretch.
_DIGESTS, _WHOLE = ("digest", "check"), ("whole", "whole_check")

_GEAR = (mixed(np.arange(1, 257, dtype=np.uint64)) >> np.uint64(32)).astype(np.uint32)


def gear_hash(data: np.ndarray) -> np.ndarray:
    """At each byte the gear hash of the ``REACH`` bytes up to it: every byte's value, shifted by its distance."""
    value = _GEAR[data]
    m = 1
    while m < REACH:
        later = value.copy()
        later[m:] += value[:-m] << np.uint32(m)
        value, m = later, 2 * m
    return value


def _bounds(min_words: int) -> tuple[int, int]:
    """Words in which a chunk begins, and least words of a seed: all of a passage's seed lies in it.

    A passage agrees on the cuts from ``REACH_WORDS + near - 1`` words after its start, or earlier, to ``near`` words before
    its end, and a seed ends less than ``near`` words after its least length.
    """
    if min_words < 2 * REACH_WORDS:
        raise ValueError(f"min_words must be at least {2 * REACH_WORDS}")
    near = (min_words - REACH_WORDS + 2) // 4
    return near, min_words - REACH_WORDS + 2 - 3 * near


def first_words(block: Block, words: Words, near: int) -> np.ndarray:
    """First words of the chunks of a block: of each ``near`` neighbouring words the last one of least gear hash."""
    n = len(words.starts)
    if n < near:
        return np.zeros(0, np.int64)
    value = gear_hash(block.data)[np.maximum(words.starts - 1, 0)] & np.uint32((1 << REACH) - 1)
    least = (value.astype(np.uint64) << np.uint64(32)) | np.arange(n, 0, -1, dtype=np.uint64)
    m = 1
    while m < near:
        step = min(m, near - m)
        least = np.minimum(least[:-step], least[step:])
        m += step
    return np.unique(n - (least & np.uint64(0xFFFFFFFF)).astype(np.int64))


def seeds(block: Block, words: Words, hashes: RangeHashes, min_words: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Runs of neighbouring chunks: their first words, the word after their last, and digests; none spans two rows."""
    near, least = _bounds(min_words)
    first = first_words(block, words, near)
    end = np.searchsorted(first, first + least)
    first, after = first[end < len(first)], first[end[end < len(first)]]
    # where neighbours in a row are too far apart, as at the ends of rows, the next cut may be in a later row
    row = np.searchsorted(words.bounds, first, side="right")
    inside = after <= words.bounds[row]
    first, after = first[inside], after[inside]
    return first, after, hashes(words.starts[first], words.ends[after - 1])


def _count_inside(marked: np.ndarray, first: np.ndarray, after: np.ndarray, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
    """How many marked seeds lie in each range of words."""
    sums = np.append(0, np.cumsum(marked))
    low, high = np.searchsorted(first, begin), np.searchsorted(after, end, side="right")
    return sums[np.maximum(high, low)] - sums[low]


def _seed_pass(min_words: int):
    def run(batches):
        for batch in batches:
            for block in blocks(batch.column(0)):
                _, _, digests = seeds(block, find_words(block, SPACED), RangeHashes(block.data), min_words)
                yield pa.RecordBatch.from_arrays([pa.array(digests.view(np.int64))], ["digest"])

    return run


def _run_pass(shared_map, min_words: int):
    """``(row, id, doc, text)`` with ``n_words`` and the stretches of ``n`` passages from ``at`` on with only seeds that the map lets through.

    A stretch ends where such passages end or another cut of the gear hash, coarser than that of the chunks, comes.
    """
    near, _ = _bounds(min_words)

    def run(batches):
        for batch in batches:
            for block in blocks(batch["text"]):
                words, hashes = find_words(block, SPACED), RangeHashes(block.data)
                first, after, digests = seeds(block, words, hashes, min_words)
                repeated = passing(shared_map.value, digests)
                at = np.arange(max(len(words.starts) - min_words + 1, 0))
                row = words.row_of_word()[: len(at)]
                at = at[at + min_words <= words.bounds[row + 1]]
                at = at[_count_inside(repeated, first, after, at, at + min_words) > 0]
                at = at[_count_inside(~repeated, first, after, at + REACH_WORDS + near - 1, at + min_words - near) == 0]
                cut = np.zeros(len(words.starts) + 1, dtype=bool)
                cut[first_words(block, words, STRETCH)] = True
                heads = np.flatnonzero(np.append(True, at[1:] != at[:-1] + 1)[: len(at)] | cut[at])  # the words of a row's end begin no passage
                n = np.diff(np.append(heads, len(at)))
                row = np.searchsorted(words.bounds, at[heads], side="right") - 1
                fields = {"at": (at[heads] - words.bounds[row]).astype(np.int32), "n": n.astype(np.int32)}
                start, end = words.starts[at[heads]], words.ends[at[heads] + n + min_words - 2]
                fields |= {name: hashes(start, end, pair).view(np.int64) for pair, name in enumerate(_WHOLE)}
                runs = pa.StructArray.from_arrays([pa.array(x) for x in fields.values()], list(fields))
                offsets = np.append(0, np.cumsum(np.bincount(row, minlength=block.rows))).astype(np.int32)
                part = batch.slice(block.first, block.rows)
                added = [pa.array(np.diff(words.bounds), pa.int64()), pa.ListArray.from_arrays(pa.array(offsets), runs)]
                yield pa.RecordBatch.from_arrays([*part.columns, *added], [*batch.schema.names, "n_words", "runs"])

    return run


def _passage_pass(shared_map, min_words: int):
    """``(digest, check, id, row, at)`` of each passage of the ``runs`` whose ``key`` the map lets through."""

    def run(batches):
        for batch in batches:
            for block in blocks(batch["text"]):
                words, hashes = find_words(block, SPACED), RangeHashes(block.data)
                part = batch.slice(block.first, block.rows)
                runs = part["runs"].flatten()
                at, n, key = (runs.field(i).to_numpy() for i in range(3))
                taken = passing(shared_map.value, key.view(np.uint64))
                owner = np.repeat(np.arange(block.rows), part["runs"].value_lengths().to_numpy())
                at, n, owner = at[taken], n[taken], owner[taken]
                row = np.repeat(owner, n)
                place = np.repeat(at, n) + np.arange(len(row)) - np.repeat(np.cumsum(n) - n, n)
                begin = place + words.bounds[row]
                start, end = words.starts[begin], words.ends[begin + min_words - 1]
                digests = [pa.array(hashes(start, end, pair).view(np.int64)) for pair in range(len(_DIGESTS))]
                columns = [*digests, *(part[c].take(pa.array(row)) for c in ("id", "row")), pa.array(place, pa.int32())]
                yield pa.RecordBatch.from_arrays(columns, [*_DIGESTS, "id", "row", "at"])

    return run


def _cut_pass(min_words: int):
    """``(doc, text, n_words, n_removed, spans, first_ids)``, the texts without the passages that begin at the ``places``.

    A place holds the first word and, in its lower 32 bits, how many passages begin there one after the other.
    """

    def run(batches):
        spans_type = pa.list_(pa.struct([("start", pa.int64()), ("stop", pa.int64())]))
        for batch in batches:
            texts, removed, spans = [], [], []
            for text, places in zip(batch["text"].to_pylist(), batch["places"], strict=True):
                data, kept, end = (text or "").encode(), [], 0
                removed.append(0)
                spans.append([])
                if len(places.values):
                    place = places.values.to_numpy()
                    begin, n = place >> 32, place & 0xFFFFFFFF
                    at = np.unique(np.repeat(begin, n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n))
                    starts = np.append(find_words(Block(0, np.frombuffer(data, np.uint8), np.array([0, len(data)])), SPACED).starts, len(data))
                    gaps = np.flatnonzero(at[1:] > at[:-1] + min_words)
                    heads, ends = at[np.append(0, gaps + 1)], at[np.append(gaps, len(at) - 1)] + min_words
                    removed[-1] = int((ends - heads).sum())
                    spans[-1] = [{"start": int(starts[i]), "stop": int(starts[j])} for i, j in zip(heads, ends, strict=True)]
                    for span in spans[-1]:
                        kept.append(data[end : span["start"]])
                        end = span["stop"]
                    text = b"".join([*kept, data[end:]]).decode()
                texts.append(text)
            added = [pa.array(texts, pa.string()), batch["n_words"], pa.array(removed, pa.int64()), pa.array(spans, spans_type), batch["first_ids"]]
            yield pa.RecordBatch.from_arrays([batch["doc"], *added], ["doc", "text", "n_words", "n_removed", "spans", "first_ids"])

    return run


def dedup_substrings(docs: DataFrame, keep: list[str], id_col: str = "doc_id", text_col: str = "text", min_words: int = 50) -> DataFrame:
    """``(doc, text, n_words, n_removed, spans, first_ids)`` of every row of ``docs``; ``doc`` has its ``keep`` columns.

    ``text`` has lost every passage of ``min_words`` words or more that occurs, to the byte, before it, by id (null first),
    row and place without overlap, so everything removed stays somewhere. ``n_words`` and ``n_removed`` count words of
    the text as it was, ``spans`` are the byte ranges removed from its UTF-8 form, ``first_ids`` the ids of the documents
    where the passages occur first (of a stretch of passages that another document has as a whole, the first such one). Null texts stay null; texts without repeats stay as they are to the byte.
    """
    spark = docs.sparkSession
    digests = docs.select(text_col).mapInArrow(_seed_pass(min_words), "digest long").groupBy("digest").count()
    shared = spark.sparkContext.broadcast(hash_map(digests.where("count > 1"), "digest"))
    numbered = docs.select(F.monotonically_increasing_id().alias("row"), F.col(id_col).cast("long").alias("id"), F.struct(*keep).alias("doc"), F.col(text_col).alias("text"))
    runs = T.ArrayType(T.StructType.fromDDL("at int, n int, whole long, whole_check long"))
    rows = staged(numbered.mapInArrow(_run_pass(shared, min_words), numbered.select("*").schema.add("n_words", "long").add("runs", runs)))
    shared.unpersist()
    free_shuffles(spark)

    # dealt once, for the first of each and for the join with it, which therefore read the same rows and columns
    stretches = rows.where("size(runs) > 0").select("id", "row", F.inline("runs")).repartition(*_WHOLE)
    first = stretches.groupBy(*_WHOLE).agg(F.min(F.struct("id", "row", "at")).alias("f"))
    # equal stretches of one document may overlap, so only those of other documents go as a whole
    told = staged(stretches.join(first, list(_WHOLE)).selectExpr("row", "at", "n", "f.id AS first_id", "row = f.row AS compared"))
    compared_map = spark.sparkContext.broadcast(hash_map(told.where("compared"), F.xxhash64("row", "at")))
    free_shuffles(spark)
    again = told.where("NOT compared").select("row", "at", "n", "first_id")

    # the same with what is left, passage by passage
    keyed = F.expr("transform(runs, r -> struct(r.at AS at, r.n AS n, xxhash64(row, r.at) AS key))").alias("runs")
    inside = rows.where("size(runs) > 0").select("id", "row", "text", keyed)
    passages = inside.mapInArrow(_passage_pass(compared_map, min_words), "digest long, check long, id long, row long, at int")
    passages = passages.where("digest IS NOT NULL AND check IS NOT NULL AND row IS NOT NULL").repartition(*_DIGESTS)
    winners = passages.groupBy(*_DIGESTS).agg(F.min(F.struct("id", "row", "at")).alias("w"), F.count("*").alias("c")).where("c > 1")
    repeats = passages.join(winners.select(*_DIGESTS, "w"), list(_DIGESTS)).where(f"NOT (id <=> w.id AND row = w.row AND at < w.at + {min_words})")
    places = repeats.selectExpr("row", "at", "1 AS n", "w.id AS first_id").union(again)
    places = places.selectExpr("row", "shiftleft(cast(at AS long), 32) | n AS place", "first_id")
    # written, so that the passages are gone before the texts are dealt
    found = staged(places.groupBy("row").agg(F.collect_list("place").alias("places"), F.array_sort(F.collect_set("first_id")).alias("first_ids")))
    free_shuffles(spark)
    columns = ["doc", "text", "n_words"]
    none = "0L AS n_removed", "cast(array() AS array<struct<start: long, stop: long>>) AS spans", "cast(array() AS array<long>) AS first_ids"
    untouched = rows.where("size(runs) = 0").selectExpr(*columns, *none)
    touched = rows.where("size(runs) > 0").select("row", *columns).join(found, "row", "left")
    touched = touched.selectExpr(*columns, "coalesce(places, array()) AS places", "coalesce(first_ids, array()) AS first_ids")
    return untouched.union(touched.mapInArrow(_cut_pass(min_words), untouched.schema))
