"""Token counts under a unigram vocabulary, with a trie shared by all pre-tokens.

A pre-token is a word with the space before it. Its best segmentation maximises the sum
of its pieces' log probabilities. Distinct pre-tokens go into a trie: the best score of
a prefix is worked out once, when its node is made, and read by every pre-token that
begins with it; the node where a pre-token ends holds its number of pieces.
"""

from __future__ import annotations

import math
import re
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from assaymill.llm.common import plain
from assaymill.llm.pieces import Pieces

_WORD = re.compile("[^ \t\n\x0b\x0c\r]+")
#: Nodes a trie may have before it starts anew; terminal counts kept, twice at most, also beyond that.
NODES, WORDS = 300_000, 400_000


def log_probabilities(n: int) -> list[float]:
    """Of the pieces by rank: rank r is drawn 1 / (r + 1) times as often as the first."""
    total = math.log(sum(1.0 / (r + 1) for r in range(n)))
    return [-math.log(r + 1) - total for r in range(n)]


def endings(vocabulary: list[bytes]) -> dict[bytes, list[int]]:
    """Lengths of the pieces that end with the same two bytes (one, for single bytes), longest first."""
    found: dict[bytes, set[int]] = {}
    for piece in vocabulary:
        found.setdefault(piece[-2:], set()).add(len(piece))
    return {end: sorted(sizes, reverse=True) for end, sizes in found.items()}


class Terminals(dict):
    """Word -> number of pieces, read off the trie where it is new.

    Counts outlive the nodes of the trie. Words met again since the last ``age`` outlive
    that as well, so common words are inserted once.
    """

    def __init__(self, trie: Trie):
        self.trie = trie
        self.older: dict[str, int] = {}

    def __missing__(self, word: str) -> int:
        found = self.older.get(word)
        if found is None:
            found = self.trie.pieces[self.trie.insert(b" " + word.encode())]
        self[word] = found
        return found

    def age(self) -> None:
        if len(self) > WORDS:
            self.older = dict(self)
            self.clear()


class Trie:
    """Prefixes of pre-tokens, each with the best score of its segmentations and their pieces."""

    def __init__(self, vocabulary: list[bytes]):
        self.number = {piece: n for n, piece in enumerate(vocabulary)}
        self.lengths = endings(vocabulary)
        self.logs = log_probabilities(len(vocabulary))
        self.clear()

        self.terminal = Terminals(self)

    def clear(self) -> None:
        self.children: dict[int, int] = {}
        self.best, self.pieces = [0.0], [0]

    def count(self, word: str) -> int:
        """Number of pieces of the pre-token of ``word``; of equal segmentations the one with the fewest."""
        return self.terminal[word]

    def insert(self, text: bytes) -> int:
        """The node of ``text``; nodes that it lacks are made and scored."""
        if len(self.best) > NODES:
            self.clear()
        node, path = 0, [0]
        children, best, pieces = self.children, self.best, self.pieces
        for end in range(1, len(text) + 1):
            key = node * 256 + text[end - 1]
            node = children.get(key, -1)
            if node < 0:
                score, few = -math.inf, 0
                for width in chain(self.lengths.get(text[max(0, end - 2) : end], ()) if end > 1 else (), (1,)):
                    start = end - width
                    if start < 0:
                        continue
                    n = self.number.get(text[start:end])
                    if n is not None:
                        before = path[start]
                        value, size = best[before] + self.logs[n], pieces[before] + 1
                        if value > score or (value == score and size < few):
                            score, few = value, size
                node = children[key] = len(best)
                best.append(score)
                pieces.append(few)
            path.append(node)
        return node


def token_counts(docs: DataFrame, vocabulary: list[bytes]) -> DataFrame:
    """doc_id, n_pretokens and n_tokens for each row of ``docs``.

    Words are runs without ASCII white space, in whole texts. A null or empty text has no
    tokens. Rows that repeat a doc_id, or have none, are counted one by one. Each task
    keeps a trie of its own, so no text is moved. An empty table gives no rows.
    """

    def run(batches):
        trie = Trie(vocabulary)
        for batch in batches:
            sizes, tokens = [], []
            for text in batch.column("text"):
                found = _WORD.findall(text.as_py())
                sizes.append(len(found))
                tokens.append(sum(map(trie.terminal.__getitem__, found)))
                trie.terminal.age()
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(np.array(sizes, dtype=np.int64)), pa.array(np.array(tokens, dtype=np.int64))],
                ["doc_id", "n_pretokens", "n_tokens"],
            )

    return plain(docs).mapInArrow(run, "doc_id bigint, n_pretokens bigint, n_tokens bigint")
