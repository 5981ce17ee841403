"""Quality rules with line sequence labelling: a linear-chain conditional random field marks content lines.

The lines of a text that hold a word are a chain. Each line has a few yes-or-no features, neighbouring lines
influence each other through transition weights, and Viterbi decoding finds the likeliest labels as a whole. The
weights are fitted on the lines of a bounded sample of documents of known quality, whose lines stand for content
or boilerplate. A text is kept if enough of its words are in content lines and the base rules hold.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm.text_blocks import SPACED, Block, Words, blocks, find_words, range_hashes, repeated_words

_SYMBOL = np.zeros(256, dtype=bool)
_SYMBOL[np.frombuffer(b"#*$%&|<>", dtype=np.uint8)] = True
_UPPER = np.zeros(256, dtype=bool)
_UPPER[65:91] = True
_DIGIT = np.zeros(256, dtype=bool)
_DIGIT[48:58] = True
_STOP = np.zeros(256, dtype=bool)
_STOP[np.frombuffer(b".!?:;", dtype=np.uint8)] = True


@dataclass
class Lines:
    """Lines with a word: their row, byte range, number of words, and whether an earlier line of the row equals them."""

    rows: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    words: np.ndarray
    again: np.ndarray
    first_words: np.ndarray


def find_lines(block: Block, words: Words) -> Lines:
    of = words.row_of_word()
    if not len(of):
        none = np.zeros(0, dtype=np.int64)
        return Lines(none, none, none, none, none.astype(bool), none)
    begins = np.union1d(block.offsets[:-1], np.flatnonzero(block.data == 10) + 1)
    line = np.searchsorted(begins, words.starts, side="right") - 1
    heads = np.flatnonzero(np.append(True, line[1:] != line[:-1]))
    starts = begins[line[heads]]
    ends = np.append(begins, len(block.data))[line[heads] + 1]
    ends = ends - (block.data[ends - 1] == 10)
    rows = of[heads]
    hashes = range_hashes(block.data, starts, ends)
    order = np.lexsort((starts, hashes, rows))
    again = np.zeros(len(heads), dtype=bool)
    again[order[1:]] = (hashes[order[1:]] == hashes[order[:-1]]) & (rows[order[1:]] == rows[order[:-1]])
    return Lines(rows, starts, ends, np.diff(np.append(heads, len(of))), again, heads)


def line_features(block: Block, words: Words, lines: Lines, repeated: np.ndarray) -> np.ndarray:
    """Lines x features."""

    def share(flags: np.ndarray, total: np.ndarray) -> np.ndarray:
        sums = np.append(0, np.cumsum(flags))
        return (sums[lines.ends] - sums[lines.starts]) / np.maximum(total, 1)

    size = lines.ends - lines.starts
    data = block.data
    symbols, capitals, digits, cries = (share(flags, size) for flags in (_SYMBOL[data], _UPPER[data], _DIGIT[data], data == 33))
    sums = np.append(0, np.cumsum(repeated))
    repeats = (sums[lines.first_words + lines.words] - sums[lines.first_words]) / np.maximum(lines.words, 1)
    last = words.ends[lines.first_words + lines.words - 1] - 1 if len(size) else size
    columns = [
        np.ones(len(size)), lines.words < 4, lines.words < 10, lines.words >= 25, symbols > 0.02, symbols > 0.1, capitals > 0.3,
        digits > 0.2, cries > 0.05, lines.again, repeats > 0.2, repeats > 0.6, _STOP[data[last]] if len(size) else size,
    ]
    return np.column_stack(columns).astype(np.float64)


@dataclass
class Chains:
    """Chains of lines, the longest first, so that the chains with more than ``t`` lines are the first ones."""

    first: np.ndarray
    length: np.ndarray

    @classmethod
    def of(cls, rows: np.ndarray) -> Chains:
        _, first, length = np.unique(rows, return_index=True, return_counts=True)
        order = np.argsort(-length, kind="stable")
        return cls(first[order], length[order])

    def steps(self):
        """For each place in a chain the lines that stand there."""
        for t in range(int(self.length[0]) if len(self.length) else 0):
            m = int(np.searchsorted(-self.length, -t, side="left"))
            yield t, self.first[:m] + t


@dataclass
class LineCrf:
    """Weights of the features for content over boilerplate, and of the transitions ``[from, to]``."""

    weights: np.ndarray
    transitions: np.ndarray

    def emissions(self, features: np.ndarray) -> np.ndarray:
        return np.column_stack([np.zeros(len(features)), features @ self.weights])

    def decode(self, features: np.ndarray, rows: np.ndarray) -> np.ndarray:
        """Viterbi: the likeliest labels of each chain, true for content."""
        chains, scores = Chains.of(rows), self.emissions(features)
        came = np.zeros(scores.shape, dtype=np.int8)
        for t, at in chains.steps():
            if t:
                paths = scores[at - 1][:, :, None] + self.transitions[None]
                came[at] = paths.argmax(axis=1)
                scores[at] += paths.max(axis=1)
        labels = np.zeros(len(rows), dtype=np.int8)
        last = chains.first + chains.length - 1
        labels[last] = scores[last].argmax(axis=1)
        for t, at in reversed(list(chains.steps())):
            if t:
                labels[at - 1] = came[at, labels[at]]
        return labels == 1

    def gradient(self, features: np.ndarray, rows: np.ndarray, labels: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Of the log-likelihood of the labels, by forward and backward sums."""
        chains, emitted = Chains.of(rows), self.emissions(features)
        steps = list(chains.steps())
        forward, backward = emitted.copy(), np.zeros(emitted.shape)
        for t, at in steps:
            if t:
                forward[at] += np.logaddexp.reduce(forward[at - 1][:, :, None] + self.transitions[None], axis=1)
        for t, at in reversed(steps):
            if t:
                backward[at - 1] = np.logaddexp.reduce(self.transitions[None] + (emitted[at] + backward[at])[:, None, :], axis=2)
        last = chains.first + chains.length - 1
        total = np.zeros(len(rows))
        total[chains.first] = np.logaddexp.reduce(forward[last], axis=1)
        start = np.zeros(len(rows), dtype=np.int64)
        start[chains.first] = chains.first
        total = total[np.maximum.accumulate(start)]
        content = np.exp(forward[:, 1] + backward[:, 1] - total)
        of_transitions = np.zeros((2, 2))
        follows = np.flatnonzero(np.append(False, rows[1:] == rows[:-1]))
        joint = forward[follows - 1][:, :, None] + self.transitions[None] + (emitted[follows] + backward[follows])[:, None, :]
        np.add.at(of_transitions, (labels[follows - 1], labels[follows]), 1.0)
        of_transitions -= np.exp(joint - total[follows][:, None, None]).sum(axis=0)
        return features.T @ (labels - content), of_transitions


def fit_crf(features: np.ndarray, rows: np.ndarray, labels: np.ndarray, rounds: int = 150, rate: float = 0.1, ridge: float = 1.0) -> LineCrf:
    """Maximum likelihood with a ridge penalty, by gradient steps of adapted size."""
    model = LineCrf(np.zeros(features.shape[1]), np.zeros((2, 2)))
    flat = np.zeros(len(model.weights) + 4)
    mean, square = flat.copy(), flat.copy()
    for i in range(1, rounds + 1):
        by_weight, by_transition = model.gradient(features, rows, labels)
        step = (np.concatenate([by_weight, by_transition.ravel()]) - ridge * flat) / max(len(rows), 1)
        mean, square = 0.9 * mean + 0.1 * step, 0.99 * square + 0.01 * step**2
        flat = flat + rate * (mean / (1 - 0.9**i)) / (np.sqrt(square / (1 - 0.99**i)) + 1e-9)
        model = LineCrf(flat[:-4], flat[-4:].reshape(2, 2))
    return model


def _lines_of(block: Block) -> tuple[Words, np.ndarray, Lines, np.ndarray]:
    words = find_words(block, SPACED)
    repeated = repeated_words(words, range_hashes(block.data, words.starts, words.ends), 5)
    lines = find_lines(block, words)
    return words, repeated, lines, line_features(block, words, lines, repeated)


def fit_line_crf(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality", max_labelled: int = 2000) -> LineCrf:
    """Fit on the lines of at most ``max_labelled`` labelled documents, those of the smallest id digests.

    Without a label every line counts as content.
    """
    known = labels.select(F.col(id_col).alias("id"), F.col(label_col).cast("int").alias("label")).where("id IS NOT NULL AND label IN (0, 1)")
    known = known.groupBy("id").agg(F.max("label").alias("label")).orderBy(F.xxhash64("id"), "id").limit(max_labelled)
    texts = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).where("text IS NOT NULL")
    texts = texts.join(F.broadcast(known), "id").groupBy("id", "label").agg(F.min("text").alias("text"))
    sample = texts.mapInArrow(_sample_pass, "id long, label int, features binary, n_lines long").toArrow().sort_by("id")
    sizes, marks = sample["n_lines"].to_numpy(), sample["label"].to_numpy()
    if not sizes.sum():
        return LineCrf(np.append(1.0, np.zeros(line_features(*_no_lines()).shape[1] - 1)), np.zeros((2, 2)))
    features = np.frombuffer(b"".join(sample["features"].to_pylist())).reshape(sizes.sum(), -1)
    return fit_crf(features, np.repeat(np.arange(len(sizes)), sizes), np.repeat(marks, sizes).astype(np.int64))


def _no_lines() -> tuple[Block, Words, Lines, np.ndarray]:
    block = Block(0, np.zeros(0, np.uint8), np.zeros(2, np.int64))
    words = find_words(block, SPACED)
    return block, words, find_lines(block, words), np.zeros(0, dtype=bool)


def _sample_pass(batches):
    for batch in batches:
        features, sizes = [], []
        for block in blocks(batch["text"]):
            _, _, lines, found = _lines_of(block)
            sizes.append(np.bincount(lines.rows, minlength=block.rows))
            features += [x.tobytes() for x in np.split(found, np.cumsum(sizes[-1])[:-1])]
        columns = [batch["id"], batch["label"], pa.array(features, pa.binary()), pa.array(np.concatenate([*sizes, np.zeros(0, np.int64)]), pa.int64())]
        yield pa.RecordBatch.from_arrays(columns, ["id", "label", "features", "n_lines"])


_MEASURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_content_words")


def _rule_pass(model):
    """``(doc, text)`` -> ``(doc, measures)``."""

    def run(batches):
        for batch in batches:
            found: list[list[np.ndarray]] = [[np.zeros(0, np.int64)] for _ in _MEASURES]
            for block in blocks(batch.column(1)):
                words, repeated, lines, features = _lines_of(block)
                row = np.repeat(np.arange(block.rows), np.diff(block.offsets))
                count = lambda rows, flags=None: np.bincount(rows, weights=flags, minlength=block.rows).astype(np.int64)  # noqa: B023, E731
                content = model.value.decode(features, lines.rows) if len(lines.rows) else lines.again
                measures = (
                    np.diff(words.bounds),
                    count(row, SPACED[block.data] & (block.data & 0xC0 != 0x80)),
                    count(row, _SYMBOL[block.data]),
                    count(lines.rows, lines.again),
                    count(words.row_of_word(), repeated),
                    count(lines.rows, lines.words * content),
                )
                for kept, measure in zip(found, measures, strict=True):
                    kept.append(measure)
            columns = [pa.array(np.concatenate(x), pa.int64()) for x in found]
            yield pa.RecordBatch.from_arrays([batch.column(0), *columns], ["doc", *_MEASURES])

    return run


def quality_rules(docs: DataFrame, labels: DataFrame, keep: list[str], text_col: str = "text", min_words: int = 10, max_repeat_percent: int = 20, min_content_share: float = 0.5, **fit) -> DataFrame:
    """``(doc, measures, base_failed, kept)`` of every row of ``docs``; ``doc`` has its ``keep`` columns.

    Words are runs of anything but space and tab to carriage return. ``word_chars`` counts their code points, ``n_symbols`` the
    characters ``#*$%&|<>``, ``n_dup_lines`` the lines with a word that equal an earlier one, ``n_repeat_words`` the words in
    five-word windows that the text holds twice or more, ``n_content_words`` those in lines decoded as content.
    A null text counts as empty; it has no words and fails the base rules.
    """
    model: LineCrf = fit_line_crf(docs, labels, text_col=text_col, **fit)
    shared = docs.sparkSession.sparkContext.broadcast(model)
    rows = docs.select(F.struct(*keep).alias("doc"), F.col(text_col).alias("text"))
    schema: T.StructType = rows.select("doc").schema
    for name in _MEASURES:
        schema = schema.add(name, "long")
    measured = rows.mapInArrow(_rule_pass(shared), schema)
    failed: Column = (F.col("n_words") < min_words) | (100 * F.col("n_repeat_words") > max_repeat_percent * F.col("n_words"))
    share = F.col("n_content_words") >= min_content_share * F.col("n_words")
    return measured.withColumn("base_failed", failed).withColumn("kept", ~failed & share)
