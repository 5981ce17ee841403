"""Language identification by sparse multinomial logistic regression on TF-IDF character n-grams.

N-grams of one to three characters are hashed; document frequencies count all documents that may be learned from. The weights are
trained on a bounded sample by follow-the-regularised-leader with elastic-net penalties, which leaves most of them
at exactly zero, and a temperature fitted on held-back rows of the sample calibrates the probabilities.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.text_blocks import Block, blocks, mixed

#: Hashed features.
FEATURES = 1 << 14
#: Longest n-gram.
LONGEST = 3
#: The prediction for a text without a letter.
UNDETERMINED = "und"

#: Bytes and rows whose dense counts are held at once.
_BLOCK, _ROWS = 500_000, 512
_SEEDS = mixed(np.arange(1, LONGEST + 1, dtype=np.uint64))


def _characters(block: Block) -> tuple[np.ndarray, np.ndarray]:
    """Code points and their rows: letters in lower case, other ASCII characters as blanks, edges as blanks."""
    points = np.frombuffer(block.data.tobytes().decode().encode("utf-32-le"), dtype=np.uint32)
    lengths = np.diff(np.append(0, np.cumsum(block.data & 0xC0 != 0x80))[block.offsets])
    points = np.where(((points >= 65) & (points <= 90)) | ((points >= 0xC0) & (points <= 0xDE)), points + 32, points)
    points = np.where((points < 128) & ((points < 97) | (points > 122)), 32, points)
    rows = np.repeat(np.arange(block.rows), lengths + 2)
    padded = np.full(len(rows), 32, dtype=np.uint64)
    padded[np.arange(len(points)) + 2 * np.repeat(np.arange(block.rows), lengths) + 1] = points
    return padded, rows


def gram_counts(block: Block) -> np.ndarray:
    """Rows of a block x hashed n-grams."""
    points, rows = _characters(block)
    counts = np.zeros(block.rows * FEATURES, dtype=np.int64)
    code = np.zeros(len(points), dtype=np.uint64)
    for n in range(1, LONGEST + 1):
        code = (code[: len(points) - n + 1] << np.uint64(21)) | points[n - 1 :]
        row = rows[: len(code)]
        own = (row == rows[n - 1 :]) & ((code != 32) if n == 1 else True)
        feature = mixed(code[own] ^ _SEEDS[n - 1]) % np.uint64(FEATURES)
        counts += np.bincount(row[own] * FEATURES + feature.astype(np.int64), minlength=len(counts))
    return counts.reshape(block.rows, FEATURES)


def has_letter(block: Block) -> np.ndarray:
    """Which rows hold a letter of any script."""
    lower = block.data | 0x20
    letters = np.append(0, np.cumsum((lower >= 97) & (lower <= 122)))[block.offsets]
    found = np.diff(letters) > 0
    for row in np.flatnonzero(~found):
        text = block.data[block.offsets[row] : block.offsets[row + 1]].tobytes().decode()
        found[row] = any(c.isalpha() for c in text)
    return found


@dataclass
class LanguageModel:
    """Languages in order, inverse document frequencies, weights (features x languages), biases and temperature."""

    languages: list[str]
    idf: np.ndarray
    weights: np.ndarray
    biases: np.ndarray
    temperature: float

    def vectors(self, counts: np.ndarray) -> np.ndarray:
        weighed = counts * self.idf
        return weighed / np.maximum(np.linalg.norm(weighed, axis=1, keepdims=True), 1e-12)

    def probabilities(self, counts: np.ndarray) -> np.ndarray:
        return _softmax((self.vectors(counts) @ self.weights + self.biases) / self.temperature)


def _softmax(logits: np.ndarray) -> np.ndarray:
    shifted = np.exp(logits - logits.max(axis=-1, keepdims=True))
    return shifted / shifted.sum(axis=-1, keepdims=True)


def train_ftrl(vectors: list[tuple[np.ndarray, np.ndarray]], labels: np.ndarray, classes: int, epochs: int = 4, alpha: float = 0.5, beta: float = 1.0, l1: float = 0.05, l2: float = 0.5) -> tuple[np.ndarray, np.ndarray]:
    """Weights and biases from sparse rows (features, values), one row after the other.

    The leader's weight is zero while its summed gradient stays within ``l1``; ``l2`` shrinks the others.
    """
    size = FEATURES + 1
    summed, squares = np.zeros((size, classes)), np.zeros((size, classes))
    l1s = np.where(np.arange(size) < FEATURES, l1, 0.0)[:, None]

    def leader(at):
        z, n = summed[at], squares[at]
        step = (beta + np.sqrt(n)) / alpha + l2
        return np.where(np.abs(z) <= l1s[at], 0.0, -(z - np.sign(z) * l1s[at]) / step)

    for epoch in range(epochs):
        for i in np.random.default_rng(epoch).permutation(len(labels)):
            features, values = vectors[i]
            at, x = np.append(features, FEATURES), np.append(values, 1.0)
            w = leader(at)
            error = _softmax(x @ w)
            error[labels[i]] -= 1.0
            gradient = x[:, None] * error
            before = squares[at]
            summed[at] += gradient - (np.sqrt(before + gradient**2) - np.sqrt(before)) / alpha * w
            squares[at] = before + gradient**2
    found = leader(np.arange(size))
    return found[:FEATURES], found[FEATURES]


def fit_temperature(logits: np.ndarray, labels: np.ndarray) -> float:
    """The temperature of least log-loss, by a search over a geometric grid."""
    grid = np.geomspace(0.02, 5.0, 200)
    losses = [-np.log(np.maximum(_softmax(logits / t)[np.arange(len(labels)), labels], 1e-12)).mean() for t in grid]
    return float(grid[int(np.argmin(losses))])


def _frequency_pass(batches):
    """How many texts hold each n-gram, per batch; feature -1 counts the texts."""
    for batch in batches:
        counts = np.zeros(FEATURES + 1, dtype=np.int64)
        for block in blocks(batch.column(0), _BLOCK, _ROWS):
            counts[1:] += (gram_counts(block) > 0).sum(axis=0)
            counts[0] += block.rows
        at = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array((at - 1).astype(np.int32)), pa.array(counts[at])], ["feature", "c"])


def _sample_pass(batches):
    """``(id, lang, text)`` -> ``(id, lang, features, counts)`` of the n-grams that occur."""
    for batch in batches:
        at, counts = [], []
        for block in blocks(batch.column(2), _BLOCK, _ROWS):
            for row in gram_counts(block):
                at.append(np.flatnonzero(row))
                counts.append(row[at[-1]])
        columns = pa.array(at, pa.list_(pa.int64())), pa.array(counts, pa.list_(pa.int64()))
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), *columns], ["id", "lang", "features", "counts"])


def fit_languages(docs: DataFrame, may_learn: Column, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", per_language: int = 1500, max_labelled: int = 6000) -> LanguageModel | None:
    """Fit on at most ``per_language`` rows of each language and ``max_labelled`` in all, by the smallest id digests.

    One row in five of the sample is held back for the temperature. None without a row to learn from.
    """
    plain = docs.select(F.col(id_col).cast("long").alias("id"), F.col(lang_col).alias("lang"), F.col(text_col).alias("text"), may_learn.alias("may"))
    counted = plain.where("may").select("text").mapInArrow(_frequency_pass, "feature int, c long").groupBy("feature").agg(F.sum("c").alias("c")).toArrow()
    frequency = np.zeros(FEATURES + 1)
    frequency[counted["feature"].to_numpy() + 1] = counted["c"].to_numpy()
    idf = np.log((1 + frequency[0]) / (1 + frequency[1:])) + 1

    known = plain.where("may AND id IS NOT NULL AND lang IS NOT NULL AND length(text) > 0")
    first = Window.partitionBy("lang").orderBy(F.xxhash64("id"), "id")
    chosen = known.select("id", "lang").withColumn("r", F.row_number().over(first)).where(F.col("r") <= per_language)
    chosen = F.broadcast(chosen.orderBy("r", "lang").limit(max_labelled).select("id").distinct())
    texts = known.join(chosen, "id").groupBy("id").agg(F.min(F.struct("lang", "text")).alias("t")).select("id", "t.lang", "t.text")
    sample = texts.mapInArrow(_sample_pass, "id long, lang string, features array<long>, counts array<long>").toArrow().sort_by("id")
    if sample.num_rows == 0:
        return None
    languages = sorted(set(sample["lang"].to_pylist()))
    labels = np.array([languages.index(x) for x in sample["lang"].to_pylist()])
    vectors = []
    for features, counts in zip(sample["features"], sample["counts"], strict=True):
        at = features.values.to_numpy()
        value = counts.values.to_numpy() * idf[at]
        vectors.append((at, value / max(np.linalg.norm(value), 1e-12)))
    held = np.arange(len(labels)) % 5 == 4
    weights, biases = train_ftrl([v for v, h in zip(vectors, held, strict=True) if not h], labels[~held], len(languages))
    logits = np.array([value @ weights[at] + biases for (at, value), h in zip(vectors, held, strict=True) if h])
    temperature = fit_temperature(logits, labels[held]) if held.any() else 1.0
    return LanguageModel(languages, idf, weights, biases, temperature)


def _predict_pass(model):
    def run(batches):
        for batch in batches:
            found, scores = [], []
            for block in blocks(batch.column(1), _BLOCK, _ROWS):
                lettered = has_letter(block)
                if model.value is None:
                    lettered[:] = False
                    best, p = np.zeros(block.rows, np.int64), np.zeros((block.rows, 1))
                else:
                    p = model.value.probabilities(gram_counts(block))
                    best = p.argmax(axis=1)
                found += [model.value.languages[k] if ok else UNDETERMINED for k, ok in zip(best.tolist(), lettered.tolist(), strict=True)]
                scores.append(np.where(lettered, p[np.arange(block.rows), best], 0.0))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, pa.string()), pa.array(np.concatenate([*scores, np.zeros(0)]))], ["doc", "lang_pred", "score"])

    return run


def identify_languages(docs: DataFrame, may_learn: Column, keep: list[str], text_col: str = "text", **fit) -> DataFrame:
    """``(doc, lang_pred, score)`` of every row of ``docs``; ``doc`` has its ``keep`` columns.

    ``score`` is the calibrated probability of the language predicted. A text that is null or holds no letter is
    ``UNDETERMINED`` with score 0, as is every text if there is nothing to learn from. ``may_learn`` says which rows
    may be learned from; null languages and ids are not. Of several rows of a learned id the first in order counts.
    """
    model = docs.sparkSession.sparkContext.broadcast(fit_languages(docs, may_learn, text_col=text_col, **fit))
    rows = docs.select(F.struct(*keep).alias("doc"), F.col(text_col).alias("text"))
    return rows.mapInArrow(_predict_pass(model), rows.select("doc").schema.add("lang_pred", "string").add("score", "double"))
