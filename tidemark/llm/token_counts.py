"""Token counts by a linear longest-match automaton.

The vocabulary is a trie of characters. Where a walk through it cannot go on, the greedy longest matches within the
walked string are popped and the rest of it is again a node: every node's failure link names that node, and how many
tokens are popped on the way is computed in advance. So a word is read once, character by character, and its
number of greedy word pieces is a sum; no piece is built.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.text_blocks import SPACED, blocks, find_words, range_hashes

#: Marks the beginning of a word in the vocabulary.
WORD_START = "▁"
#: Words whose counts a worker remembers; the memory is emptied when it is full.
REMEMBERED = 200_000


def load_pieces(path: str) -> list[str]:
    """The pieces of a sentencepiece model, without control and byte pieces."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    ids = (i for i in range(model.get_piece_size()) if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i)))
    return [model.id_to_piece(i) for i in ids]


class PieceCounter:
    """Counts the greedy longest pieces of a word; a character in no piece counts its UTF-8 bytes."""

    def __init__(self, pieces: list[str]):
        self.children: list[dict[str, int]] = [{}]
        whole = [False]
        for piece in pieces:
            node = 0
            for c in piece:
                if c not in self.children[node]:
                    self.children[node][c] = len(self.children)
                    self.children.append({})
                    whole.append(False)
                node = self.children[node][c]
            whole[node] = bool(piece)
        self.link = [0] * len(whole)
        self.popped = [0] * len(whole)
        self.left = [0] * len(whole)  # tokens of a word that ends at the node
        level = [0]
        while level:
            below = []
            for u in level:
                for c, v in self.children[u].items():
                    below.append(v)
                    if whole[v]:
                        self.popped[v] = 1
                    elif u == 0:
                        self.popped[v] = len(c.encode())
                    else:
                        more, self.link[v] = self._step(self.link[u], c)
                        self.popped[v] = self.popped[u] + more
                    self.left[v] = self.popped[v] + self.left[self.link[v]]
            level = below

    def _step(self, node: int, c: str) -> tuple[int, int]:
        """Tokens popped by, and the node after, reading ``c`` at ``node``."""
        tokens = 0
        while c not in self.children[node]:
            if node == 0:
                return tokens + len(c.encode()), 0
            tokens += self.popped[node]
            node = self.link[node]
        return tokens, self.children[node][c]

    def count(self, word: str) -> int:
        """Pieces of the word, its start marked."""
        tokens, node, children, popped, link = 0, 0, self.children, self.popped, self.link
        for c in WORD_START + word:
            after = children[node].get(c)
            while after is None:
                if node == 0:
                    tokens += len(c.encode())
                    after = 0
                    break
                tokens += popped[node]
                node = link[node]
                after = children[node].get(c)
            node = after
        return tokens + self.left[node]


def _count_pass(shared):
    """``(doc, text)`` -> ``(doc, n_words, n_tokens)``; equal words of a block are counted once."""

    def run(batches):
        counter: PieceCounter = shared.value
        known: dict[bytes, int] = {}
        for batch in batches:
            words_of, tokens_of = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
            for block in blocks(batch.column(1)):
                words = find_words(block, SPACED)
                _, first, inverse = np.unique(range_hashes(block.data, words.starts, words.ends), return_index=True, return_inverse=True)
                tokens = np.zeros(len(first), dtype=np.int64)
                data = block.data.tobytes()
                for i, (a, b) in enumerate(zip(words.starts[first].tolist(), words.ends[first].tolist(), strict=True)):
                    word = data[a:b]
                    n = known.get(word)
                    if n is None:
                        n = counter.count(word.decode())
                        if len(known) >= REMEMBERED:
                            known.clear()
                        if b - a <= 64:
                            known[word] = n
                    tokens[i] = n
                words_of.append(np.diff(words.bounds))
                tokens_of.append(np.bincount(words.row_of_word(), weights=tokens[inverse], minlength=block.rows).astype(np.int64))
            columns = pa.array(np.concatenate(words_of), pa.int64()), pa.array(np.concatenate(tokens_of), pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column(0), *columns], ["doc", "n_words", "n_tokens"])

    return run


def token_counts(docs: DataFrame, pieces: list[str], keep: list[str], text_col: str = "text") -> DataFrame:
    """``(doc, n_words, n_tokens)`` of every row of ``docs``; ``doc`` has its ``keep`` columns.

    Words are runs of anything but space and tab to carriage return; each is cut into the longest pieces from the left.
    A null text has no words and no tokens. The automaton goes to the tasks; its size is that of the vocabulary.
    """
    counter = docs.sparkSession.sparkContext.broadcast(PieceCounter(pieces))
    rows = docs.select(F.struct(*keep).alias("doc"), F.col(text_col).alias("text"))
    return rows.mapInArrow(_count_pass(counter), rows.select("doc").schema.add("n_words", "long").add("n_tokens", "long"))
