"""Runs of repeated words: stretches with a period that repeats at least four times over.

A run of period ``p`` that is long enough holds a pair of words ``(i, i + p)`` for some ``i`` of a grid whose step grows with
``p``; over all periods these grids have about ``n log n / 3`` points. From a pair of equal words the longest common
extensions to the right and to the left give the whole run. An extension compares a few words until both places fall on
samples of a difference cover; the order of the sampled suffixes and a sparse table of their common prefixes give the
rest at once. Only sampled suffixes are sorted, and only those of texts in which some pair gets as far as its samples.

Texts are handled in blocks of some megabytes inside the Arrow batches of a task, all texts of a block at once.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm.text_blocks import SPACED, Block, Words, blocks, find_words

#: A difference cover, that is every remainder is the difference of two of these modulo ``MODULUS``.
MODULUS = 31
COVER = (1, 5, 11, 24, 25, 27)

#: A run has at least this many words, and its period fits in it as many times.
MIN_WORDS = 6
MIN_PERIODS = 4

#: Pairs of words looked at together.
PAIRS = 1_000_000

_PLACE = np.full(MODULUS, -1, dtype=np.int64)
_PLACE[list(COVER)] = np.arange(len(COVER))


def _shifts() -> np.ndarray:
    """For two remainders the least step after which both places are samples."""
    found = np.full((MODULUS, MODULUS), MODULUS, dtype=np.int64)
    at = np.arange(MODULUS)
    for step in reversed(range(MODULUS)):
        hit = _PLACE[(at + step) % MODULUS] >= 0
        found[np.ix_(hit, hit)] = step
    if found.max() >= MODULUS:
        raise ValueError("not a difference cover")
    return found


_SHIFT = _shifts()


def compare(x: np.ndarray, i: np.ndarray, j: np.ndarray, most: np.ndarray, step: int = 1) -> np.ndarray:
    """How many words from ``i`` and ``j`` on agree, up to ``most``; ``step`` -1 goes to the left."""
    agree = np.zeros(len(i), dtype=np.int64)
    open_ = np.flatnonzero(most > 0)
    t = 0
    while len(open_):
        same = x[i[open_] + t * step] == x[j[open_] + t * step]
        open_ = open_[same]
        t += 1
        agree[open_] = t
        open_ = open_[most[open_] > t]
    return agree


class CommonExtensions:
    """Longest common prefixes of suffixes of ``x``; its last element must occur nowhere else."""

    def __init__(self, x: np.ndarray):
        self.x = x
        n = len(x)
        at = np.arange(-(-n // MODULUS))[:, None] * MODULUS + np.array(COVER)
        at = at.reshape(-1)
        self.at = at[at < n]
        if len(self.at):
            levels = self._sort()
            self._table = self._range_minima(self._neighbours(levels))

    def _refined(self, rank: np.ndarray, tied: np.ndarray, key: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ranks after telling tied samples apart by a further key, and the samples still tied."""
        order = np.lexsort((key, rank[tied]))
        tied, key = tied[order], key[order]
        old = rank[tied]
        new_old = np.append(True, old[1:] != old[:-1])
        new_key = new_old | np.append(True, key[1:] != key[:-1])
        place = np.arange(len(tied))
        first_old = np.maximum.accumulate(np.where(new_old, place, 0))
        first_key = np.maximum.accumulate(np.where(new_key, place, 0))
        rank = rank.copy()
        rank[tied] = old + (first_key - first_old)
        alone = new_key & np.append(new_key[1:], True)
        return rank, tied[~alone]

    def _sort(self) -> list[np.ndarray]:
        """Ranks of the samples by their first ``MODULUS``, twice, four times … as many words, until all differ."""
        samples = len(self.at)
        rank, tied = np.zeros(samples, dtype=np.int64), np.arange(samples)
        for t in range(MODULUS):
            if not len(tied):
                break
            rank, tied = self._refined(rank, tied, self.x[self.at[tied] + t])
        levels = [rank.astype(np.int32)]
        step = len(COVER)
        while len(tied):
            rank, tied = self._refined(rank, tied, rank[tied + step])
            levels.append(rank.astype(np.int32))
            step *= 2
        self.rank = levels[-1]
        return levels

    def _neighbours(self, levels: list[np.ndarray]) -> np.ndarray:
        """Common prefix of each sample with the next one in order."""
        order = np.empty(len(self.at), dtype=np.int64)
        order[self.rank] = np.arange(len(self.at))
        a, b = order[:-1].copy(), order[1:].copy()
        common = np.zeros(len(a), dtype=np.int64)
        for k in reversed(range(len(levels))):
            # Equal words hold no last element, so both places stay inside.
            same = levels[k][a] == levels[k][b]
            common[same] += MODULUS << k
            a[same] += len(COVER) << k
            b[same] += len(COVER) << k
        rest = np.full(len(a), MODULUS - 1, dtype=np.int64)
        return (common + compare(self.x, self.at[a], self.at[b], rest)).astype(np.int32)

    @staticmethod
    def _range_minima(values: np.ndarray) -> list[np.ndarray]:
        """Row ``k``: the least of each ``2**k`` neighbouring values."""
        table = [values]
        width = 1
        while 2 * width <= len(values):
            table.append(np.minimum(table[-1][:-width], table[-1][width:]))
            width *= 2
        return table

    def common(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """Words that agree from ``i`` and ``j`` on, for ``i < j``."""
        shift = _SHIFT[i % MODULUS, j % MODULUS]
        agree = compare(self.x, i, j, shift)
        on = np.flatnonzero(agree == shift)
        if len(on):
            a, b = (self.rank[p // MODULUS * len(COVER) + _PLACE[p % MODULUS]] for p in (i[on] + shift[on], j[on] + shift[on]))
            low, high = np.minimum(a, b).astype(np.int64), np.maximum(a, b).astype(np.int64)
            level = np.frexp((high - low).astype(np.float64))[1] - 1
            least = np.empty(len(on), dtype=np.int64)
            for k in np.unique(level):
                of = level == k
                least[of] = np.minimum(self._table[k][low[of]], self._table[k][high[of] - (1 << int(k))])
            agree[on] += least
        return agree


@dataclass
class Runs:
    """Runs of the texts of a block, ordered by text, start and period; ``start`` counts from the text's first word."""

    text: np.ndarray
    start: np.ndarray
    length: np.ndarray
    period: np.ndarray


def _grid(counts: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """``(text, period, point)`` of the grids of all periods that can have a run, some at a time."""
    periods = counts // MIN_PERIODS * (counts >= MIN_WORDS)
    text = np.repeat(np.arange(len(counts)), periods)
    period = np.arange(len(text)) - np.repeat(np.cumsum(periods) - periods, periods) + 1
    step = np.maximum(MIN_WORDS, MIN_PERIODS * period) - period
    points = -(-(counts[text] - period) // step)
    upto = np.cumsum(points)
    first = 0
    while first < len(text):
        last = max(first + 1, int(np.searchsorted(upto, (upto[first - 1] if first else 0) + PAIRS, side="right")))
        n = points[first:last]
        of = np.repeat(np.arange(first, last), n)
        yield text[of], period[of], (np.arange(len(of)) - np.repeat(np.cumsum(n) - n, n)) * step[of]
        first = last


def _joined(ids: np.ndarray, bounds: np.ndarray, texts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The words of some texts, with an element of its own before the first and after each; where each text begins."""
    counts = np.diff(bounds)[texts]
    begin = 1 + np.cumsum(counts + 1) - (counts + 1)
    x = np.empty(1 + int(np.sum(counts + 1)), dtype=np.int64)
    top = int(ids.max()) + 1 if len(ids) else 0
    x[0] = top + len(texts)
    x[begin + counts] = top + np.arange(len(texts))
    place = np.arange(int(counts.sum())) - np.repeat(np.cumsum(counts) - counts, counts)
    x[np.repeat(begin, counts) + place] = ids[np.repeat(bounds[texts], counts) + place]
    return x, begin


def find_runs(ids: np.ndarray, bounds: np.ndarray) -> Runs:
    """All runs of texts whose words are ``ids[bounds[t]:bounds[t + 1]]``; equal words have equal ids."""
    counts = np.diff(bounds)
    x, begin = _joined(ids, bounds, np.arange(len(counts)))
    found = [np.zeros((4, 0), dtype=np.int64)]  # text, start, end, period
    for text, period, point in _grid(counts):
        i = begin[text] + point
        equal = np.flatnonzero(x[i] == x[i + period])
        text, period, i = text[equal], period[equal], i[equal]
        j, last = i + period, len(x) - 1
        few = _SHIFT[i % MODULUS, j % MODULUS], _SHIFT[(last + 1 - i) % MODULUS, (last + 1 - j) % MODULUS]
        right, left = compare(x, i, j, few[0]), compare(x, i - 1, j - 1, few[1], -1)
        long = (right == few[0]) | (left == few[1])
        if long.any():
            right[long], left[long] = _extended(ids, bounds, text[long], i[long] - begin[text[long]], period[long])
        needed = np.maximum(MIN_WORDS, MIN_PERIODS * period) - period
        ok = right + left >= needed
        text, period, i, j = text[ok], period[ok], i[ok], j[ok]
        here = np.stack([text, i - left[ok] - begin[text], j + right[ok] - begin[text], period])
        found.append(_distinct(here))
    text, start, end, period = _distinct(np.concatenate(found, axis=1))
    order = np.lexsort((period, start, text))
    return Runs(text[order], start[order], (end - start)[order], period[order])


def _distinct(runs: np.ndarray) -> np.ndarray:
    """One run for each stretch, that of the smallest period; the others are multiples of it."""
    runs = runs[:, np.lexsort((runs[3], runs[2], runs[1], runs[0]))]
    if runs.shape[1] < 2:
        return runs
    return runs[:, np.append(True, (runs[:3, 1:] != runs[:3, :-1]).any(axis=0))]


def _extended(ids: np.ndarray, bounds: np.ndarray, text: np.ndarray, i: np.ndarray, period: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Words that agree from ``i`` and ``i + period`` to the right, and before them to the left."""
    texts, of = np.unique(text, return_inverse=True)
    x, begin = _joined(ids, bounds, texts)
    i = begin[of] + i
    right = CommonExtensions(x).common(i, i + period)
    # Backwards the place before i is len(x) - i, and that before i + period comes first.
    left = CommonExtensions(x[::-1].copy()).common(len(x) - i - period, len(x) - i)
    return right, left


def word_ids(block: Block, words: Words) -> np.ndarray:
    """A number for each word of a block; words of the same bytes have the same one."""
    lengths = words.ends - words.starts
    upto = np.cumsum(lengths)
    data = block.data[np.repeat(words.starts - (upto - lengths), lengths) + np.arange(int(lengths.sum()))]
    offsets = np.append(0, upto).astype(np.int64)
    column = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(lengths), [None, pa.py_buffer(offsets), pa.py_buffer(data)])
    return column.dictionary_encode().indices.to_numpy().astype(np.int64)


def repeated(runs: Runs, bounds: np.ndarray) -> np.ndarray:
    """Which words lie in a run after its first period."""
    change = np.zeros(int(bounds[-1]) + 1, dtype=np.int64)
    first = bounds[runs.text] + runs.start
    np.add.at(change, first + runs.period, 1)
    np.add.at(change, first + runs.length, -1)
    return np.cumsum(change)[:-1] > 0


def joined_text(block: Block, words: Words, kept: np.ndarray) -> pa.Array:
    """The kept words of each text with one space between them."""
    at = np.flatnonzero(kept)
    rows = words.row_of_word()[at]
    counts = np.bincount(rows, minlength=block.rows)
    space = np.append(rows[1:] == rows[:-1], False)[: len(at)].astype(np.int64)
    lengths = words.ends[at] - words.starts[at]
    upto = np.cumsum(lengths + space)
    size = int(upto[-1]) if len(at) else 0
    data = np.full(size, 0x20, dtype=np.uint8)
    gaps = np.repeat(np.cumsum(space) - space, lengths)
    place = np.arange(int(lengths.sum()))
    data[place + gaps] = block.data[np.repeat(words.starts[at] - (np.cumsum(lengths) - lengths), lengths) + place]
    ends = np.append(0, upto)[np.append(0, np.cumsum(counts))]
    return pa.LargeStringArray.from_buffers(block.rows, pa.py_buffer(ends.astype(np.int64)), pa.py_buffer(data)).cast(pa.string())


_RUN = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])


def _run_pass(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``(doc, text)`` -> ``(doc, n_words, runs, collapsed)``."""
    for batch in batches:
        for block in blocks(batch.column(1)):
            words = find_words(block, SPACED)
            runs = find_runs(word_ids(block, words), words.bounds)
            per_text = np.append(0, np.cumsum(np.bincount(runs.text, minlength=block.rows))).astype(np.int32)
            fields = [pa.array(v, pa.int64()) for v in (runs.start, runs.length, runs.period)]
            listed = pa.ListArray.from_arrays(pa.array(per_text), pa.StructArray.from_arrays(fields, fields=list(_RUN)))
            collapsed = joined_text(block, words, ~repeated(runs, words.bounds))
            doc = batch.column(0).slice(block.first, block.rows)
            n_words = pa.array(np.diff(words.bounds), pa.int64())
            yield pa.RecordBatch.from_arrays([doc, n_words, listed, collapsed], ["doc", "n_words", "runs", "collapsed"])


def periodic_runs(docs: DataFrame, keep: list[str], text_col: str = "text") -> DataFrame:
    """``(doc, n_words, runs, collapsed)`` of every row of ``docs``; ``doc`` has its ``keep`` columns.

    Words are stretches of anything but space and tab to carriage return. ``runs`` lists ``(start, length, period)`` by
    start, then period: stretches with that smallest period of at least six words and four periods that no neighbouring
    word extends. ``collapsed`` is the text without the words that lie in a run after its first period, joined by single
    spaces. A null or empty text has no words, no runs and an empty ``collapsed``; equal rows give equal rows. A text is
    handled whole by one task, which takes about 300 bytes a word for it.
    """
    rows = docs.select(F.struct(*keep).alias("doc"), F.col(text_col).alias("text"))
    run = T.StructType().add("start", "long").add("length", "long").add("period", "long")
    schema = rows.select("doc").schema.add("n_words", "long").add("runs", T.ArrayType(run)).add("collapsed", "string")
    return rows.mapInArrow(_run_pass, schema)
