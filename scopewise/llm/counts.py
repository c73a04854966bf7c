"""Token counts by dynamic programming over a trie of distinct pre-tokens.

A unigram model gives every piece of a public vocabulary a probability by its rank (Zipf's law,
``p(rank) = 1 / ((rank + 1) * H)``). The best segmentation of a pre-token is a forward pass over its
bytes. Distinct pre-tokens are inserted into a trie, whose nodes hold the forward score of their prefix,
so that a prefix shared by many pre-tokens is computed once. The node where a pre-token ends stores its
number of tokens. Among segmentations of equal score the one with the longer last piece counts.

The trie belongs to a task and is emptied when it has ``max_nodes`` nodes, which changes no result. A
pre-token of more than ``LONG_WORD`` bytes shares little: its forward pass keeps the scores of the last
prefixes only, as many as the longest piece has bytes, and no node. Defined cases: a null text has no tokens; a null doc_id is passed on; repeated rows each get a row; no other column
is read.
"""

from __future__ import annotations

import base64
import math
from collections import Counter
from collections.abc import Iterable, Iterator
from functools import lru_cache
from pathlib import Path

import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from scopewise.llm.batches import map_batches, pieces, texts
from scopewise.llm.bpe import PATTERN

#: Nodes of a task's trie.
MAX_NODES = 1_000_000
#: Bytes of a pre-token from which on it is kept out of the trie.
LONG_WORD = 4096


def piece_scores(ranks: bytes) -> dict[bytes, float]:
    """Log probability of every piece of a rank file (base64 piece, rank)."""
    pieces_ = {base64.b64decode(a): int(b) for a, b in map(bytes.split, ranks.splitlines()) if a}
    norm = math.log(sum(1 / (rank + 1) for rank in pieces_.values()))
    return {piece: -math.log(rank + 1) - norm for piece, rank in pieces_.items()}


class SharedTrie:
    """Best score and tokens of all prefixes seen, by node; edges lead from 256 * node + byte to a node."""

    def __init__(self, scores: dict[bytes, float], max_nodes: int = MAX_NODES):
        self.scores, self.max_nodes = scores, max_nodes
        self.suffixes = {piece[i:] for piece in scores for i in range(1, len(piece))}
        self.longest = max(map(len, scores), default=1)
        self.clear()

    def clear(self) -> None:
        self.edges: dict[int, int] = {}
        self.best, self.tokens = [0.0], [0]
        self.terminal: dict[str, int] = {}

    def rolling(self, data: bytes) -> int:
        """Tokens of a pre-token of any length, in the memory of the longest piece."""
        width = self.longest + 1
        best, tokens = [0.0] * width, [0] * width
        for end in range(1, len(data) + 1):
            top, count = -math.inf, 0
            for begin in range(end - 1, -1, -1):
                piece = data[begin:end]
                score = self.scores.get(piece)
                if score is not None and (total := best[begin % width] + score) >= top:
                    top, count = total, tokens[begin % width] + 1
                if piece not in self.suffixes:
                    break
            best[end % width], tokens[end % width] = top, count
        return tokens[len(data) % width]

    def count(self, word: str) -> int:
        """Tokens of one pre-token."""
        if (known := self.terminal.get(word)) is not None:
            return known
        if len(self.best) > self.max_nodes:
            self.clear()
        data, scores, suffixes = word.encode(), self.scores, self.suffixes
        if len(data) > LONG_WORD:
            return self.rolling(data)
        edges, best, tokens = self.edges, self.best, self.tokens
        path = [0]
        for end, byte in enumerate(data, 1):
            edge = path[-1] << 8 | byte
            node = edges.get(edge)
            if node is None:
                top, count = -math.inf, 0
                for begin in range(end - 1, -1, -1):
                    piece = data[begin:end]
                    score = scores.get(piece)
                    if score is not None and (total := best[path[begin]] + score) >= top:
                        top, count = total, tokens[path[begin]] + 1
                    if piece not in suffixes:
                        break
                node = edges[edge] = len(best)
                best.append(top)
                tokens.append(count)
            path.append(node)
        self.terminal[word] = tokens[path[-1]]
        return tokens[path[-1]]


@lru_cache(maxsize=2)
def _scores(ranks: bytes) -> dict[bytes, float]:
    return piece_scores(ranks)


def _count(batches: Iterable[pa.RecordBatch], ranks: bytes, max_nodes: int) -> Iterator[pa.RecordBatch]:
    trie, split = SharedTrie(_scores(ranks), max_nodes), regex.compile(PATTERN).findall
    for piece in pieces(batches):
        words, tokens = [], []
        for text in texts(piece):
            found = split(text)
            words.append(len(found))
            tokens.append(sum(trie.count(word) * n for word, n in Counter(found).items()))
        yield pa.RecordBatch.from_arrays(
            [piece.column("doc_id"), pa.array(words, pa.int64()), pa.array(tokens, pa.int64())],
            ["doc_id", "n_words", "n_tokens"],
        )


def token_counts(docs: DataFrame, rank_file: str, max_nodes: int = MAX_NODES) -> DataFrame:
    """doc_id, n_words (pre-tokens) and n_tokens of every row; nothing is shuffled."""
    shared = docs.sparkSession.sparkContext.broadcast(Path(rank_file).read_bytes())
    return docs.select(F.col("doc_id").cast("long"), "text").transform(
        map_batches,
        lambda batches: _count(batches, shared.value, max_nodes), "doc_id long, n_words long, n_tokens long"
    )
