"""Quality by nearest-neighbour voting on latent-semantic vectors.

The terms of a text are what its quality shows in, whatever the language: trigrams of character classes
(letters, capitals, digits, blanks, single symbols), and words repeated at once, in five-word windows and in
whole lines. Term weights are root frequencies times inverse document frequency over all documents; a bounded sample
of labelled documents gives the latent directions. Every document is compared with every labelled vector of the
sample, in blocks, and the nearest ones vote with their similarity.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.text_blocks import SPACED, Block, blocks, find_words, range_hashes, repeated_words

_CLASSES = 16
_CLASS_OF = np.zeros(256, dtype=np.int64)  # letters and bytes beyond ASCII
for _number, _members in enumerate((b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"0123456789", b" \t", b"\n\r", b".,;:'\"()-?", b"!", b"|", b"#", b"*", b"$", b"%", b"&", b"<>={}[]", b"@/_\\~^+`"), start=1):
    _CLASS_OF[np.frombuffer(_members, dtype=np.uint8)] = _number
_EDGE = 4  # a text begins and ends like a line
#: Terms after the trigrams: words equal to the one before, words in repeated windows, words in repeated lines.
_EXTRA = 3
TERMS = _CLASSES**3 + _EXTRA


def _line_repeats(block: Block, words, row_of_word: np.ndarray) -> np.ndarray:
    """Words in lines that equal an earlier line of their row."""
    if not len(words.starts):
        return np.zeros(0, dtype=bool)
    breaks = np.union1d(np.flatnonzero(block.data == 10) + 1, block.offsets[:-1])
    line = np.searchsorted(breaks, words.starts, side="right")
    heads = np.flatnonzero(np.append(True, (line[1:] != line[:-1]) | (row_of_word[1:] != row_of_word[:-1])))
    hashes = range_hashes(block.data, words.starts[heads], words.ends[np.append(heads[1:], len(line)) - 1])
    order = np.lexsort((heads, hashes, row_of_word[heads]))
    h, r = hashes[order], row_of_word[heads][order]
    again = np.append(False, (h[1:] == h[:-1]) & (r[1:] == r[:-1]))
    repeated = np.zeros(len(heads), dtype=bool)
    repeated[order[again]] = True
    return np.repeat(repeated, np.diff(np.append(heads, len(line))))


def term_shares(block: Block) -> np.ndarray:
    """Rows of a block -> shares of the terms: of all trigrams, and of all words."""
    rows = block.rows
    lengths = np.diff(block.offsets)
    at = np.arange(len(block.data)) + 2 * np.repeat(np.arange(rows), lengths) + 1  # an edge on either side
    classes = np.full(len(block.data) + 2 * rows, _EDGE, dtype=np.int64)
    classes[at] = _CLASS_OF[block.data]
    row = np.repeat(np.arange(rows), lengths + 2)
    gram = classes[:-2] * _CLASSES**2 + classes[1:-1] * _CLASSES + classes[2:]
    own = row[:-2] == row[2:]
    shares = np.zeros((rows, TERMS), dtype=np.float32)
    counts = np.bincount(row[:-2][own] * _CLASSES**3 + gram[own], minlength=rows * _CLASSES**3)
    shares[:, : _CLASSES**3] = counts.reshape(rows, -1) / np.maximum(lengths, 1)[:, None]

    words = find_words(block, SPACED)
    hashes = range_hashes(block.data, words.starts, words.ends)
    of = words.row_of_word()
    at_once = np.zeros(len(hashes), dtype=bool)
    at_once[1:] = (hashes[1:] == hashes[:-1]) & (of[1:] == of[:-1])
    for i, flag in enumerate((at_once, repeated_words(words, hashes, 5), _line_repeats(block, words, of))):
        shares[:, _CLASSES**3 + i] = np.bincount(of, weights=flag, minlength=rows) / np.maximum(np.diff(words.bounds), 1)
    return shares


#: Bytes and rows of text whose dense shares are held at once.
_BLOCK, _ROWS = 500_000, 512


def _count_pass(batches):
    """How many texts hold each term, per batch; term -1 counts the texts."""
    for batch in batches:
        counts = np.zeros(TERMS + 1, dtype=np.int64)
        for block in blocks(batch.column(0), _BLOCK, _ROWS):
            counts[1:] += (term_shares(block) > 0).sum(axis=0)
            counts[0] += block.rows
        at = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array((at - 1).astype(np.int32)), pa.array(counts[at])], ["term", "c"])


def _share_pass(batches):
    """``(text, label)`` -> the shares of the terms as raw floats, and the label."""
    for batch in batches:
        rows = [row.tobytes() for block in blocks(batch.column(0), _BLOCK, _ROWS) for row in term_shares(block)]
        yield pa.RecordBatch.from_arrays([pa.array(rows, pa.binary()), batch.column(1)], ["shares", "label"])


@dataclass
class QualityModel:
    """Term weights, latent directions (terms x directions), labelled unit vectors and their labels."""

    idf: np.ndarray
    directions: np.ndarray
    vectors: np.ndarray
    labels: np.ndarray
    neighbours: int
    power: float

    def latent(self, shares: np.ndarray) -> np.ndarray:
        found = (np.sqrt(shares) * self.idf) @ self.directions
        return found / np.maximum(np.linalg.norm(found, axis=1, keepdims=True), 1e-12)

    def scores(self, vectors: np.ndarray) -> np.ndarray:
        """Share of label 1 among the nearest labelled vectors, weighted by similarity; 0 without any term."""
        similar = vectors @ self.vectors.T
        k = min(self.neighbours, similar.shape[1])
        nearest = np.argpartition(similar, -k, axis=1)[:, -k:]
        weights = np.maximum(np.take_along_axis(similar, nearest, axis=1), 0.0) ** self.power
        total = weights.sum(axis=1)
        return np.divide((weights * self.labels[nearest]).sum(axis=1), total, out=np.zeros(len(total)), where=total > 0)


def fit_quality(docs: DataFrame, labels: DataFrame, max_labelled: int = 4000, directions: int = 48, neighbours: int = 15, power: float = 8.0) -> QualityModel:
    """Fit on at most ``max_labelled`` labelled rows, those of the smallest id digests.

    ``docs(id, text)`` gives the document frequencies, over all rows; ``labels(id, label)`` holds what may be learned.
    Without any label every score is 0.
    """
    counted = docs.select("text").mapInArrow(_count_pass, "term int, c long").groupBy("term").agg(F.sum("c").alias("c")).toArrow()
    frequency = np.zeros(TERMS + 1)
    frequency[counted["term"].to_numpy() + 1] = counted["c"].to_numpy()
    idf = (np.log((1 + frequency[0]) / (1 + frequency[1:])) + 1).astype(np.float32)
    chosen = labels.where("id IS NOT NULL AND label IS NOT NULL").groupBy("id").agg(F.max("label").alias("label"))
    chosen = F.broadcast(chosen.orderBy(F.xxhash64("id"), "id").limit(max_labelled))
    texts = docs.join(chosen, "id").where("length(text) > 0").groupBy("id", "label").agg(F.min("text").alias("text"))
    sample = texts.orderBy("id").select("text", "label").mapInArrow(_share_pass, "shares binary, label int").toArrow()
    model = QualityModel(idf, np.zeros((TERMS, 1), np.float32), np.zeros((1, 1), np.float32), np.zeros(1), neighbours, power)
    if sample.num_rows:
        column = sample["shares"].combine_chunks()
        rows = np.frombuffer(column.buffers()[2], dtype=np.float32, count=len(column) * TERMS).reshape(-1, TERMS)
        weighted = np.sqrt(rows)
        weighted *= idf
        weighted /= np.maximum(np.linalg.norm(weighted, axis=1, keepdims=True), 1e-12)
        # Range finder with power iterations: the leading right singular vectors of the labelled rows.
        base = np.random.default_rng(7).normal(size=(TERMS, min(directions + 8, len(rows)))).astype(np.float32)
        for _ in range(6):
            base, _ = np.linalg.qr(weighted.T @ (weighted @ base))
        _, _, turned = np.linalg.svd(weighted @ base, full_matrices=False)
        model.directions = np.ascontiguousarray((base @ turned.T)[:, :directions]).astype(np.float32)
        vectors = weighted @ model.directions
        model.vectors = vectors / np.maximum(np.linalg.norm(vectors, axis=1, keepdims=True), 1e-12)
        model.labels = sample["label"].to_numpy().astype(np.float64)
    return model


def _score_pass(model):
    def run(batches):
        for batch in batches:
            scores = [model.value.scores(model.value.latent(term_shares(block))) for block in blocks(batch.column(1), _BLOCK, _ROWS)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(np.concatenate([*scores, np.zeros(0)]))], ["doc", "score"])

    return run


def quality_scores(docs: DataFrame, labels: DataFrame, may_learn: Column, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality", **fit) -> DataFrame:
    """``(doc, score)`` of every row of ``docs``: all its columns as a struct, and a score in [0, 1].

    The higher the score, the likelier label 1. ``may_learn`` is a condition on ``labels``; other labels are not looked
    at, nor are null ones or others than 0 and 1. Whole texts count. A null or empty text has no term and scores 0.
    Of several labels of an id the largest counts, of several texts with a labelled id the first in order is learned;
    every row is scored by its own text.
    """
    known = labels.where(may_learn).select(F.col(id_col).cast("long").alias("id"), F.col(label_col).cast("int").alias("label"))
    plain = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    model = docs.sparkSession.sparkContext.broadcast(fit_quality(plain, known.where("label IN (0, 1)"), **fit))
    rows = docs.select(F.struct("*").alias("doc"), F.col(text_col).alias("text"))
    return rows.mapInArrow(_score_pass(model), rows.select("doc").schema.add("score", "double"))
