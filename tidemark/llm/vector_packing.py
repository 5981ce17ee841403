"""Packing of examples into training sequences under limits on tokens, segments and loss-bearing tokens at once.

An example is a list of parts of which some are learned from, such as the answers of a conversation. Its tokens are cut
where they exceed a limit; what is left over is packed as vectors: a sequence is filled with the piece whose demand has
the greatest dot product with the room that is left, each dimension weighted by what the waiting pieces need of it.
When nothing fits any more and enough room is left, the best piece is cut to fill it.

Every task packs its own rows as it reads them, some thousand pieces at a time, so nothing is shuffled. The last
sequence of a task is cut into sequences whose lengths are powers of two, which need no padding either.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tidemark.llm.text_blocks import SPACED, Block, Words, blocks, find_words


@dataclass(frozen=True)
class Limits:
    """What a sequence holds at most, and the tokens a piece must have to be cut off for room that is left."""

    tokens: int = 2048
    segments: int = 256
    learned: int = 2048
    least_cut: int = 16


#: Pieces that are packed together.
WINDOW = 4096
#: Units of text whose ids a task remembers.
REMEMBERED = 500_000
#: Bytes of text, and rows, whose tokens are found together.
BLOCK_BYTES, BLOCK_ROWS = 4_000_000, 4096

_LETTER, _DIGIT, _SYMBOL, _HARD = 1, 2, 3, 4
_KIND = np.full(256, _HARD, dtype=np.uint8)
_KIND[0x21:0x7F] = _SYMBOL
_KIND[0x30:0x3A] = _DIGIT
_KIND[0x41:0x5B] = _KIND[0x61:0x7B] = _LETTER
_KIND[0x27] = _HARD  # an apostrophe may begin a contraction


def _byte_characters() -> dict[int, int]:
    """Byte-level tokenizers write a byte as its character where that is printable, else as one beyond 255, in order."""
    printable = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in printable]
    return {b: 0x100 + i for i, b in enumerate(others)}


_BYTE_CHARACTERS = _byte_characters()


def units(block: Block, words: Words) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Words cut into units whose ids do not depend on their neighbours: ``(data, starts, ends, word, whole)``.

    A word of printable ASCII and Latin-1 letters falls into stretches of letters, which are lower-cased, single digits
    and stretches of symbols. Words with other characters, apostrophes or the beginning of a special token stay
    whole.
    """
    data = block.data
    if not len(words.starts):
        return data, words.starts, words.ends, words.starts, words.starts
    kind, lower = _KIND[data], block.lowered().data
    lead = np.flatnonzero(data[:-1] == 0xC3)
    lead = lead[(data[lead + 1] != 0x97) & (data[lead + 1] != 0xB7)]  # the signs of multiplication and division
    kind[lead] = kind[lead + 1] = _LETTER
    upper = lead[data[lead + 1] < 0x9F] + 1
    lower[upper] += 0x20
    hard = kind == _HARD
    hard[:-1] |= (data[:-1] == ord("<")) & (data[1:] == ord("|"))
    upto = np.append(0, np.cumsum(hard))
    whole = upto[words.ends] > upto[words.starts]
    inside = np.zeros(len(data) + 1, dtype=np.int8)
    inside[words.starts[~whole]] += 1
    inside[words.ends[~whole]] -= 1
    inside = np.cumsum(inside[:-1], dtype=np.int8) > 0
    cut = inside.copy()
    cut[1:] &= (kind[1:] != kind[:-1]) | (kind[1:] == _DIGIT)
    cut[words.starts] = True
    starts = np.flatnonzero(cut)
    word = np.searchsorted(words.starts, starts, side="right") - 1
    ends = np.minimum(np.append(starts[1:], len(data)), words.ends[word])
    return np.where(inside, lower, data), starts, ends, word, whole[word]


class WordTokenizer:
    """Ids of texts by a tokenizer that lower-cases letters, cuts at spaces and takes letters, digits and symbols apart.

    Units of text are looked up once. Plain ones go to the model at once, all others through the whole tokenizer.
    """

    def __init__(self, definition: str):
        self._tokenizer = Tokenizer.from_str(definition)
        self._forget()

    def _forget(self) -> None:
        self._known = pa.array([], pa.large_binary())
        self._ids, self._ends = np.zeros(0, np.uint32), np.zeros(1, np.int64)

    def _learn(self, new: pa.Array, whole: np.ndarray) -> None:
        """Look up the ids of units that are not known yet."""
        model, ids, ends = self._tokenizer.model, [], []
        for unit, hard in zip(new.to_pylist(), whole.tolist(), strict=True):
            if hard:
                ids.extend(self._tokenizer.encode(unit.decode(), add_special_tokens=False).ids)
            else:
                plain = unit.decode() if unit.isascii() else unit.decode("latin-1").translate(_BYTE_CHARACTERS)
                ids.extend([token.id for token in model.tokenize(plain)])
            ends.append(len(ids))
        self._ends = np.concatenate([self._ends, self._ends[-1] + np.array(ends, dtype=np.int64)])
        self._ids = np.concatenate([self._ids, np.array(ids, dtype=np.uint32)])
        self._known = pa.concat_arrays([self._known, new])

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All ids one after another, and how many each text has."""
        flat, counts = [np.zeros(0, np.uint32)], [np.zeros(0, np.int64)]
        for block in blocks(texts, BLOCK_BYTES):
            words = find_words(block, SPACED)
            data, starts, ends, word, whole = units(block, words)
            lengths = ends - starts
            upto = np.cumsum(lengths)
            data = data[np.repeat(starts - (upto - lengths), lengths) + np.arange(int(lengths.sum()))]
            offsets = np.append(0, upto).astype(np.int64)
            column = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(lengths), [None, pa.py_buffer(offsets), pa.py_buffer(data)])
            column = column.dictionary_encode()
            which, distinct = column.indices.to_numpy(), column.dictionary
            if len(self._known) > REMEMBERED:
                self._forget()
            at = pa.compute.index_in(distinct, value_set=self._known)
            if at.null_count:
                is_whole = np.zeros(len(distinct), dtype=bool)
                is_whole[which] = whole
                new = pa.compute.is_null(at)
                self._learn(distinct.filter(new), is_whole[new.to_numpy(zero_copy_only=False)])
                at = pa.compute.index_in(distinct, value_set=self._known)
            which = at.to_numpy()[which]
            first = self._ends[which]
            n = self._ends[which + 1] - first
            done = np.cumsum(n)
            flat.append(self._ids[np.repeat(first - (done - n), n) + np.arange(int(n.sum()))])
            counts.append(np.diff(np.append(0, done)[np.searchsorted(word, words.bounds)]))
        return np.concatenate(flat), np.concatenate(counts)


@dataclass
class _Example:
    """Tokens of a row, and how many of the first ``k`` of them are learned from."""

    row: int
    ids: np.ndarray
    learned: np.ndarray

    def demand(self, start: int, stop: int) -> tuple[int, int]:
        return stop - start, int(self.learned[stop] - self.learned[start])

    def reach(self, start: int, stop: int, tokens: int, learned: int) -> int:
        """The end of the longest piece from ``start`` within both limits."""
        furthest = int(np.searchsorted(self.learned, self.learned[start] + learned, side="right")) - 1
        return min(stop, start + tokens, furthest)


@dataclass(frozen=True)
class _Piece:
    example: _Example
    start: int
    stop: int


@dataclass
class Packer:
    """Packs pieces in the order and with the limits given; ``done`` collects closed sequences."""

    limits: Limits
    waiting: dict[tuple[int, int], list[_Piece]] = field(default_factory=dict)
    count: int = 0
    done: list[list[_Piece]] = field(default_factory=list)

    def add(self, example: _Example) -> None:
        """Whole sequences of a long example are closed at once, the rest waits."""
        start, stop = 0, len(example.ids)
        while start < stop:
            end = example.reach(start, stop, self.limits.tokens, self.limits.learned)
            if end == start:  # a single token beyond a limit of no learned tokens at all
                raise ValueError("no token of an example fits into a sequence")
            if end - start == self.limits.tokens:
                self.done.append([_Piece(example, start, end)])
            else:
                self._wait(_Piece(example, start, end))
            start = end

    def _wait(self, piece: _Piece) -> None:
        self.waiting.setdefault(piece.example.demand(piece.start, piece.stop), []).append(piece)
        self.count += 1

    def _cut(self, piece: _Piece, room: list[int]) -> tuple[_Piece | None, _Piece | None]:
        """As much of a piece as the room holds, and the rest of it; nothing if that is too little."""
        least = self.limits.least_cut
        if room[1] == 0 or room[0] < least:
            return None, None
        at = piece.example.reach(piece.start, piece.stop, room[0], room[2])
        if at - piece.start < least:
            return None, None
        return _Piece(piece.example, piece.start, at), _Piece(piece.example, at, piece.stop)

    def pack(self, last: bool) -> None:
        """Close sequences of waiting pieces; what the open one holds at the end waits on, or is closed if ``last``."""
        limits = self.limits
        whole = (limits.tokens, limits.segments, limits.learned)
        kinds = list(self.waiting)
        stacks = [self.waiting[k] for k in kinds]
        place = {k: i for i, k in enumerate(kinds)}
        tokens, learned, left = (np.zeros(2 * len(kinds), dtype=np.int64) for _ in range(3))
        n = len(kinds)
        tokens[:n], learned[:n] = np.array(kinds, dtype=np.int64).reshape(-1, 2).T
        left[:n] = [len(s) for s in stacks]
        need = [int((tokens * left).sum()), int(left.sum()), int((learned * left).sum())]
        room, held = list(whole), []
        while need[1]:
            # What a piece asks of each limit, weighted by what all ask of it and by the room that is left.
            weight = [need[d] / whole[d] * room[d] / whole[d] ** 2 if whole[d] else 0.0 for d in range(3)]
            score = tokens[:n] * weight[0] + learned[:n] * weight[2] + 1.0 + weight[1]
            score[left[:n] == 0] = 0.0
            fitting = score * ((tokens[:n] <= room[0]) & (learned[:n] <= room[2]) & (room[1] > 0))
            kind, rest = int(fitting.argmax()), None
            if fitting[kind] > 0.0:
                piece = stacks[kind].pop()
            else:
                kind = int(score.argmax())
                piece, rest = self._cut(stacks[kind][-1], room)
                if piece is None:
                    self.done.append(held)
                    room, held = list(whole), []
                    continue
                stacks[kind].pop()
            left[kind] -= 1
            used = piece.example.demand(piece.start, piece.stop)
            for d, by in enumerate((used[0], 1, used[1])):
                room[d] -= by
                need[d] -= by
            if rest is not None:
                need[1] += 1
                key = rest.example.demand(rest.start, rest.stop)
                if key not in place:
                    if n == len(tokens):
                        tokens, learned, left = (np.append(v, np.zeros_like(v)) for v in (tokens, learned, left))
                    place[key] = n
                    tokens[n], learned[n] = key
                    stacks.append([])
                    n += 1
                stacks[place[key]].append(rest)
                left[place[key]] += 1
            held.append(piece)
            if room[0] == 0:
                self.done.append(held)
                room, held = list(whole), []
        self.waiting, self.count = {}, 0
        if last:
            self.done.extend(powers_of_two(held))
        else:
            for piece in held:
                self._wait(piece)


def powers_of_two(pieces: list[_Piece]) -> Iterator[list[_Piece]]:
    """The same pieces in sequences whose lengths are powers of two, the longest first."""
    left = sum(p.stop - p.start for p in pieces)
    pieces = list(reversed(pieces))
    while left:
        room, sequence = 1 << (left.bit_length() - 1), []
        left -= room
        while room:
            piece = pieces.pop()
            cut = min(piece.stop, piece.start + room)
            if cut < piece.stop:
                pieces.append(_Piece(piece.example, cut, piece.stop))
            sequence.append(_Piece(piece.example, piece.start, cut))
            room -= cut - piece.start
        yield sequence


def _examples(batch: pa.RecordBatch, tokenizer: WordTokenizer, end_id: int, first_row: int) -> Iterator[_Example]:
    """The examples of some rows: the ids of their parts and the end, which is learned like the last part."""
    parts = batch.column(1)
    bounds = _bounds(parts)
    flat = parts.flatten()
    ids, counts = tokenizer.encode(flat.field("text"))
    learn = pa.compute.fill_null(flat.field("learn"), False).to_numpy(zero_copy_only=False)
    ends = np.append(0, np.cumsum(counts))[bounds[1:]]
    last = np.append(learn, False)[np.where(np.diff(bounds) > 0, bounds[1:] - 1, len(learn))]
    ids = np.insert(ids, ends, np.uint32(end_id))
    learned = np.append(0, np.cumsum(np.insert(np.repeat(learn, counts), ends, last), dtype=np.int64))
    ends += np.arange(1, len(parts) + 1)
    for row, (a, b) in enumerate(zip([0, *ends[:-1].tolist()], ends.tolist(), strict=True)):
        yield _Example(first_row + row, ids[a:b], learned[a : b + 1])


def _bounds(lists: pa.Array) -> np.ndarray:
    """Where the elements of each list begin and end among those of all."""
    sizes = pa.compute.fill_null(pa.compute.list_value_length(lists), 0).to_numpy(zero_copy_only=False)
    return np.append(0, np.cumsum(sizes, dtype=np.int64))


_PIECE_FIELDS = ["start", "length", "n_learned", "doc_tokens", "sequence_id", "offset"]


def _pack_pass(shared, end_id: int, limits: Limits):
    """``(doc, parts)`` -> a row per piece."""

    def rows(docs: pa.Array, sequences: list[list[_Piece]], numbers: list[int]) -> pa.RecordBatch:
        columns: dict[str, list[int]] = {name: [] for name in ["row", *_PIECE_FIELDS]}
        ids, ends = [np.zeros(0, np.uint32)], [0]
        for number, pieces in zip(numbers, sequences, strict=True):
            offset = 0
            for p in pieces:
                length, learned = p.example.demand(p.start, p.stop)
                for name, value in zip(columns, (p.example.row, p.start, length, learned, len(p.example.ids), number, offset), strict=True):
                    columns[name].append(value)
                offset += length
                ids.append(p.example.ids[p.start : p.stop])
                ends.append(ends[-1] + 4 * length)
        data = np.concatenate(ids).astype("<u4")
        binary = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(ends) - 1, [None, pa.py_buffer(np.array(ends, dtype=np.int64)), pa.py_buffer(data)])
        doc = docs.take(pa.array(columns.pop("row"), pa.int64()))
        arrays = [pa.array(v, pa.int64()) for v in columns.values()]
        return pa.RecordBatch.from_arrays([doc, *arrays, binary.cast(pa.binary())], ["doc", *_PIECE_FIELDS, "ids"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer = WordTokenizer(shared.value)
        packer = Packer(limits)
        number = TaskContext.get().partitionId() << 40
        docs = None  # the rows of waiting pieces, and after them the current batch

        def closed() -> pa.RecordBatch:
            nonlocal number
            sequences, packer.done = packer.done, []
            numbers = list(range(number, number + len(sequences)))
            number += len(sequences)
            return rows(docs, sequences, numbers)

        def compacted() -> pa.Array:
            """Only the rows of waiting pieces."""
            examples = {p.example.row: p.example for stack in packer.waiting.values() for p in stack}
            kept = sorted(examples)
            for i, row in enumerate(kept):
                examples[row].row = i
            return docs.take(pa.array(kept, pa.int64()))

        for batch in batches:
            held = 0 if docs is None else len(docs)
            docs = batch.column(0) if docs is None else pa.concat_arrays([docs, batch.column(0)])
            for example in _by_bytes(batch, tokenizer, end_id, held):
                packer.add(example)
                if packer.count >= WINDOW:
                    packer.pack(last=False)
                if len(packer.done) >= WINDOW // 2:
                    yield closed()
            if packer.done:
                yield closed()
            docs = compacted()
        if docs is not None:
            packer.pack(last=True)
            yield closed()

    return run


def _by_bytes(batch: pa.RecordBatch, tokenizer: WordTokenizer, end_id: int, first_row: int) -> Iterator[_Example]:
    """The examples of a batch, some rows at a time, as the ids of a batch of long texts take much room."""
    parts = batch.column(1)
    per_part = pa.compute.fill_null(pa.compute.binary_length(parts.flatten().field("text")), 0).to_numpy(zero_copy_only=False)
    size = np.append(0, np.cumsum(per_part, dtype=np.int64))[_bounds(parts)]
    first = 0
    while first < len(parts):
        last = int(np.searchsorted(size, size[first] + BLOCK_BYTES, side="right")) - 1
        last = min(max(last, first + 1), first + BLOCK_ROWS)
        yield from _examples(batch.slice(first, last - first), tokenizer, end_id, first_row + first)
        first = last


def pack_examples(examples: DataFrame, parts: Column, definition: str, end_id: int, keep: list[str], limits: Limits = Limits()) -> DataFrame:
    """A row for each piece of an example: ``(doc, start, length, n_learned, doc_tokens, sequence_id, offset, ids)``.

    ``parts`` is an array of ``(text, learn)``; the tokens of an example are the ids of its parts by the tokenizer that
    ``definition`` describes (its JSON text; it goes to the tasks), without special tokens, and ``end_id``. ``ids`` holds
    the piece's tokens as little-endian 32-bit numbers, ``start`` the example's tokens before it, ``offset`` the tokens of
    its sequence before it. Every sequence keeps the limits; it is to be padded to ``limits.tokens`` unless its length is
    a power of two. A null text has no tokens, a null flag is not learned from, and an example without parts consists of
    ``end_id`` alone. Rows that are repeated are packed as often; an empty table gives no rows. Sequences are numbered by
    partition, so a task that is run again gives the same ones.
    """
    shared = examples.sparkSession.sparkContext.broadcast(definition)
    rows = examples.select(F.struct(*keep).alias("doc"), parts.cast("array<struct<text:string,learn:boolean>>").alias("parts"))
    schema = rows.select("doc").schema
    for name in _PIECE_FIELDS:
        schema = schema.add(name, "long")
    return rows.mapInArrow(_pack_pass(shared, end_id, limits), schema.add("ids", "binary"))
