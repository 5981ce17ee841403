import re

import tracemalloc

import numpy as np
import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st

from tidemark.llm.text_blocks import ALNUM, SPACED, blocks, find_words, range_hashes, repeated_words, sequence_hashes

TEXT = st.text(alphabet="ab A9.\n\té漢🚨 ", max_size=40)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.one_of(st.none(), TEXT), max_size=12), st.integers(1, 60))
def test_words_and_hashes(texts, size):
    seen, found = {}, []
    for block in blocks(pa.array(texts, pa.string()), size):
        words = find_words(block, SPACED)
        hashes = range_hashes(block.data, words.starts, words.ends)
        for a, b, h in zip(words.starts, words.ends, hashes, strict=True):
            word = block.data[a:b].tobytes()
            assert seen.setdefault(int(h), word) == word
        for a, b in zip(words.bounds[:-1], words.bounds[1:], strict=True):
            found.append([block.data[s:e].tobytes().decode() for s, e in zip(words.starts[a:b], words.ends[a:b], strict=True)])
    assert found == [re.findall(r"[^\x20\x09-\x0D]+", t or "") for t in texts]
    assert len(seen) == len(set(seen.values()))


@settings(max_examples=100, deadline=None)
@given(st.lists(TEXT, max_size=8))
def test_letters_and_digits(texts):
    found = []
    for block in blocks(pa.array(texts, pa.string())):
        block = block.lowered()
        words = find_words(block, ALNUM)
        found += [block.data[s:e].tobytes().decode() for s, e in zip(words.starts, words.ends, strict=True)]
    lowered = [re.sub("[A-Z]", lambda m: m[0].lower(), t) for t in texts]
    assert found == [w for t in lowered for w in re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", t)]


def test_sequences_depend_on_order():
    h = np.arange(1, 5, dtype=np.uint64)
    assert len(set(sequence_hashes(h, 2).tolist()) | set(sequence_hashes(h[::-1], 2).tolist())) == 6
    assert len(sequence_hashes(h, 5)) == 0


@settings(max_examples=100, deadline=None)
@given(st.lists(st.lists(st.sampled_from("abc"), max_size=25), max_size=5))
def test_repeated_words(rows):
    for block in blocks(pa.array([" ".join(r) for r in rows], pa.string())):
        words = find_words(block, SPACED)
        marked = repeated_words(words, range_hashes(block.data, words.starts, words.ends), 3)
        for i, (a, b) in enumerate(zip(words.bounds[:-1], words.bounds[1:], strict=True)):
            row = rows[block.first + i]
            windows = [tuple(row[k : k + 3]) for k in range(len(row) - 2)]
            expected = {k + j for k, w in enumerate(windows) if windows.count(w) > 1 for j in range(3)}
            assert set(np.flatnonzero(marked[a:b]).tolist()) == expected


def test_blocks_are_cut_by_rows_too():
    """A hundred thousand empty rows are no single block."""
    column = pa.array([None, ""] * 50_000)
    sizes = [(block.first, block.rows) for block in blocks(column, 500_000, 512)]
    assert sum(rows for _, rows in sizes) == 100_000 and max(rows for _, rows in sizes) == 512
    assert [first for first, _ in sizes] == list(range(0, 100_000, 512))


def test_dense_counts_of_many_empty_rows_take_little_room():
    """Ten thousand empty or short texts, as a task meets them."""
    from tidemark.llm import language_id, quality_knn

    column = pa.array(["", None, "a b c d e f g"] * 3333)
    tracemalloc.start()
    language_id_batches = language_id._frequency_pass(iter([pa.RecordBatch.from_arrays([column], ["text"])]))
    quality_batches = quality_knn._count_pass(iter([pa.RecordBatch.from_arrays([column], ["text"])]))
    assert all(len(list(batches)) == 1 for batches in (language_id_batches, quality_batches))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 300_000_000


def test_sequences_of_thue_and_morse_have_hashes_of_their_own():
    bits = np.array([bin(i).count("1") & 1 for i in range(4096)], dtype=np.uint8)
    for n in (1024, 2048, 4096):
        data = np.concatenate([bits[:n] + 97, 98 - bits[:n]])
        starts = np.array([0, n])
        for pair in (0, 1):
            a, b = range_hashes(data, starts, starts + n, pair)
            assert a != b


def test_hashes_do_not_depend_on_the_place_or_the_length_of_the_text():
    rng = np.random.default_rng(4)
    word = rng.integers(0, 256, 300).astype(np.uint8)
    found = set()
    for before, after in ((0, 0), (17, 5), (1_500_000, 900_000)):
        data = np.concatenate([rng.integers(0, 256, before).astype(np.uint8), word, rng.integers(0, 256, after).astype(np.uint8)])
        found.add(int(range_hashes(data, np.array([before]), np.array([before + 300]))[0]))
    assert len(found) == 1
