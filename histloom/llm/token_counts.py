"""Token counts by dynamic programming over a trie of pre-tokens.

Pre-tokens are inserted in a trie.  A node is a prefix; it holds the forward
score of the prefix (the best sum of unigram log probabilities of pieces that
spell it) and the number of tokens on that best path.  Words share the nodes of
their common prefixes, so each prefix is scored once; the count at a word's
last node is the word's token count.

The model file is one of merge type and has ranks, no probabilities.  The
unigram model used here takes them from Zipf's law: the piece of rank r has
probability 1 / ((r + 1) * H).  A character without a piece is scored as the
rarest piece less ``UNKNOWN_PENALTY`` and counts one token per UTF-8 byte."""

from __future__ import annotations

import math
from collections.abc import Callable

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import map_texts
from .pieces import DEFAULT_MODEL, MARK, Memo, Vocabulary, load_vocabulary, pre_tokens

#: Log-probability penalty of a character without a piece.
UNKNOWN_PENALTY = 10.0


def unigram_model(vocab: Vocabulary) -> dict[str, float]:
    """Log probability of every piece by the rank of its score (best first;
    equal scores by id)."""
    ranked = sorted(vocab.scores, key=lambda p: (-vocab.scores[p], vocab.ids[p]))
    harmonic = math.log(sum(1.0 / (r + 1) for r in range(len(ranked))))
    return {p: -math.log(r + 1) - harmonic for r, p in enumerate(ranked)}


def proper_suffixes(pieces) -> frozenset[str]:
    """Every suffix of a piece: once a stretch of text is none, no longer one
    that ends at the same place is a piece."""
    return frozenset(p[i:] for p in pieces for i in range(len(p)))


class PrefixTrie:
    """Nodes are numbers; 0 is the root.  After ``max_nodes`` nodes a fresh trie
    is begun, which scores prefixes anew with the same result."""

    def __init__(self, model: dict[str, float], max_nodes: int = 300_000):
        self.model, self.suffixes, self.max_nodes = model, proper_suffixes(model), max_nodes
        self.unknown = min(model.values()) - UNKNOWN_PENALTY
        self.nodes_made = 0
        self._reset()

    def _reset(self) -> None:
        self.child: dict[tuple[int, str], int] = {}
        self.forward, self.tokens = [0.0], [0]

    def _score(self, word: str, end: int, path: list[int], forward, tokens) -> tuple[float, int]:
        """Forward score and tokens of ``word[:end]`` from those of its prefixes:
        the best score, then the fewest tokens."""
        best, fewest = -math.inf, 0
        start = end - 1
        char = word[start]
        if char not in self.model:
            node = path[start]
            best, fewest = forward[node] + self.unknown, tokens[node] + len(char.encode())
        while start >= 0 and (stretch := word[start:end]) in self.suffixes:
            p = self.model.get(stretch)
            if p is not None:
                node = path[start]
                score, n = forward[node] + p, tokens[node] + 1
                if score > best or (score == best and n < fewest):
                    best, fewest = score, n
            start -= 1
        return best, fewest

    def count(self, word: str) -> int:
        """Tokens of a pre-token (spaces written as spaces)."""
        if word == "\n" or word == MARK:
            return len(word.encode())
        word = word.replace(" ", MARK)
        if len(word) > 200:                    # a row of its own instead of nodes: same scores
            forward, tokens, path = [0.0], [0], list(range(len(word) + 1))
            for end in range(1, len(word) + 1):
                best, fewest = self._score(word, end, path, forward, tokens)
                forward.append(best)
                tokens.append(fewest)
            return tokens[-1]
        if len(self.forward) > self.max_nodes:
            self._reset()
        node, path = 0, [0]
        for end in range(1, len(word) + 1):
            edge = (node, word[end - 1])
            node = self.child.get(edge, -1)
            if node < 0:
                best, fewest = self._score(word, end, path, self.forward, self.tokens)
                node = len(self.forward)
                self.child[edge] = node
                self.forward.append(best)
                self.tokens.append(fewest)
                self.nodes_made += 1
            path.append(node)
        return self.tokens[node]


def count_tokens(docs: DataFrame, model: str = DEFAULT_MODEL, memo_size: int = 300_000) -> DataFrame:
    """Token counts of every whole text: doc_id, n_pretokens, n_tokens.

    One row per document row; null and empty texts have none; only doc_id and
    text are read.  Counting stays in the task that reads the text: tries and
    the memo of terminal counts are per task and bounded, nothing is shuffled."""
    probabilities = unigram_model(load_vocabulary(model))

    def make() -> Callable[[pa.RecordBatch], pa.RecordBatch]:
        memo = Memo(PrefixTrie(probabilities).count, memo_size)
        get = memo.__getitem__

        def step(batch: pa.RecordBatch) -> pa.RecordBatch:
            n_words, n_tokens = [], []
            for text in batch.column(1):
                words = pre_tokens(text.as_py() or "")
                n_words.append(len(words))
                n_tokens.append(sum(map(get, words)))
            return pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(n_words, pa.int64()), pa.array(n_tokens, pa.int64())],
                names=["doc_id", "n_pretokens", "n_tokens"])
        return step
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return map_texts(rows, ["doc_id", "text"], "doc_id long, n_pretokens long, n_tokens long", make)
