"""Vectorised access to the UTF-8 bytes of a column of texts.

Tokenising inside Arrow batches works on one flat byte array per block of rows instead of on Python strings.
Word classes are given per byte: every class used here consists of ASCII characters, and bytes of 0x80 and
above (parts of other characters) fall on one side of it as a whole.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

#: Bytes of text handled at once; a single longer text forms a block of its own.
BLOCK_BYTES = 1_000_000

_ODD = np.uint64(0x9E3779B97F4A7C15)
_PRIME = (1 << 31) - 1
#: Bases of the polynomials modulo ``_PRIME``; each pair makes one hash.
_BASES = ((0x2545F491, 0x5851F42D), (0x14057B7E, 0x6C078965))


def byte_class(excluded: bytes) -> np.ndarray:
    """Per byte whether it belongs to a word; ``excluded`` lists the bytes that do not."""
    table = np.ones(256, dtype=bool)
    table[np.frombuffer(excluded, dtype=np.uint8)] = False
    return table


#: Words as runs of anything but space and tab to carriage return.
SPACED = byte_class(bytes([0x20, *range(0x09, 0x0E)]))
#: Words as runs of digits, a-z and characters beyond ASCII, in text whose A-Z are lower-cased.
ALNUM = byte_class(bytes([*range(0x30), *range(0x3A, 0x61), *range(0x7B, 0x80)]))

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


@dataclass
class Block:
    """Some rows of a text column: ``data[offsets[i]:offsets[i + 1]]`` are the bytes of row ``first + i``."""

    first: int
    data: np.ndarray
    offsets: np.ndarray

    @property
    def rows(self) -> int:
        return len(self.offsets) - 1

    def lowered(self) -> Block:
        """A-Z in lower case."""
        return Block(self.first, _LOWER[self.data], self.offsets)


@dataclass
class Words:
    """Words of a block: byte ranges, and for each row the range of its words."""

    starts: np.ndarray
    ends: np.ndarray
    bounds: np.ndarray

    def row_of_word(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.bounds) - 1), np.diff(self.bounds))


def blocks(column: pa.Array, size: int = BLOCK_BYTES, rows: int | None = None) -> Iterator[Block]:
    """Cut a string column into blocks of about ``size`` bytes, and ``rows`` rows at most; a null counts as an empty text."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_string()).fill_null("")
    if len(column) == 0:
        return
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, dtype=np.int64)[column.offset : column.offset + len(column) + 1]
    flat = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, dtype=np.uint8)
    first = 0
    while first < len(column):
        last = max(first + 1, int(np.searchsorted(at, at[first] + size, side="right")) - 1)
        last = last if rows is None else min(last, first + rows)
        yield Block(first, flat[at[first] : at[last]], at[first : last + 1] - at[first])
        first = last


def find_words(block: Block, inside: np.ndarray) -> Words:
    """Maximal runs of bytes of class ``inside``, ending at row boundaries."""
    n = len(block.data)
    member = np.zeros(n + 2, dtype=np.int8)
    member[1:-1] = inside[block.data]
    change = np.diff(member)
    starts, ends = np.flatnonzero(change == 1), np.flatnonzero(change == -1)
    cuts = np.unique(block.offsets[1:-1])
    cuts = cuts[(cuts > 0) & (cuts < n)]
    cuts = cuts[(member[cuts] == 1) & (member[cuts + 1] == 1)]  # a run that goes on into the next row
    if len(cuts):
        starts = np.sort(np.concatenate([starts, cuts]))
        ends = np.sort(np.concatenate([ends, cuts]))
    return Words(starts, ends, np.searchsorted(starts, block.offsets))


def mixed(values: np.ndarray) -> np.ndarray:
    """Spread 64-bit values evenly (the splitmix finaliser)."""
    x = values.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def _reduced(x: np.ndarray) -> np.ndarray:
    """Values below 2^64 as equal ones modulo ``_PRIME``, of little more than 31 bits."""
    for _ in range(2):
        x = (x & np.uint64(_PRIME)) + (x >> np.uint64(31))
    return x


def _powers_of(base: int, n: int) -> np.ndarray:
    powers = np.ones(n, dtype=np.uint32)
    m = 1
    while m < n:
        step = min(m, n - m)
        powers[m : m + step] = _reduced(powers[:step] * np.uint64(pow(base, m, _PRIME)))
        m += step
    return powers


_tables: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def _power_tables(base: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of a base and of its inverse; tables for an unusually long text are not kept."""
    if n > BLOCK_BYTES + 1:
        return _powers_of(base, n), _powers_of(pow(base, -1, _PRIME), n)
    if base not in _tables:
        _tables[base] = _powers_of(base, BLOCK_BYTES + 1), _powers_of(pow(base, -1, _PRIME), BLOCK_BYTES + 1)
    return _tables[base]


#: Sums of so many products of a byte's value and a power stay below 2^64.
_SHORT = 1 << 24


class RangeHashes:
    """64-bit hashes of byte ranges of ``data``; equal bytes give equal hashes wherever they stand.

    Each holds two polynomials modulo a prime, as those modulo a power of two have known collisions whatever the base.
    Another ``pair`` of bases gives hashes that collide independently.
    """

    def __init__(self, data: np.ndarray):
        self.data = data
        self._sums: dict[int, np.ndarray] = {}

    def _sums_of(self, base: int, powers: np.ndarray) -> np.ndarray:
        if base not in self._sums:
            terms = (self.data.astype(np.uint64) + np.uint64(1)) * powers[: len(self.data)]
            sums = np.zeros(len(self.data) + 1, dtype=np.uint64)
            np.cumsum(terms if len(terms) < _SHORT else _reduced(terms), out=sums[1:])
            self._sums[base] = sums
        return self._sums[base]

    def __call__(self, starts: np.ndarray, ends: np.ndarray, pair: int = 0) -> np.ndarray:
        value = np.zeros(len(starts), dtype=np.uint64)
        if len(starts) == 0:
            return value
        for base in _BASES[pair]:
            powers, inverses = _power_tables(base, len(self.data) + 1)
            sums = self._sums_of(base, powers)
            part = _reduced(_reduced(sums[ends] - sums[starts]) * inverses[starts])
            value = (value << np.uint64(31)) | part % np.uint64(_PRIME)
        return mixed(value + (ends - starts).astype(np.uint64) * _ODD)


def range_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, pair: int = 0) -> np.ndarray:
    """``RangeHashes`` for one use."""
    return RangeHashes(data)(starts, ends, pair)


def sequence_hashes(hashes: np.ndarray, length: int) -> np.ndarray:
    """Hash of every ``length`` consecutive values; position i covers i to i + length - 1."""
    n = len(hashes) - length + 1
    if n <= 0:
        return np.zeros(0, dtype=np.uint64)
    total = np.zeros(n, dtype=np.uint64)
    for k in range(length):
        total = mixed(total + hashes[k : k + n] + _ODD)
    return total


def repeated_words(words: Words, hashes: np.ndarray, length: int) -> np.ndarray:
    """Which words lie in a window of ``length`` words that occurs twice or more in its row."""
    covered = np.zeros(len(hashes) + 1, dtype=np.int64)
    windows = sequence_hashes(hashes, length)
    rows = words.row_of_word()
    own = np.flatnonzero(rows[: len(windows)] == rows[length - 1 :]) if len(windows) else windows
    if len(own):
        keys = mixed(windows[own] + rows[own].astype(np.uint64) * _ODD)
        order = np.argsort(keys)
        same = keys[order[1:]] == keys[order[:-1]]
        twice = np.append(same, False) | np.append(False, same)
        at = own[order[twice]]
        np.add.at(covered, at, 1)
        np.add.at(covered, at + length, -1)
    return np.cumsum(covered)[:-1] > 0
