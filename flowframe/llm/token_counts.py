"""Token counts by a linear longest-match automaton.

The vocabulary is a trie with failure links.  Where a word leaves the trie at a node,
the greedy longest-match pieces of that node's text are popped; how many they are, and
the node that stands for what remains, are computed once for each node.  So a word's
number of pieces comes from one pass over its characters, without any piece.

Words are what white space separates, prefixed by a marker (as in vocabularies whose
word-initial pieces start with it).  A word that the vocabulary cannot spell counts as
one unknown token.

Defined results: null and empty texts, and texts of white space, have no token;
repeated rows each get their counts; other columns are kept; an empty table gives an
empty result.
"""

from __future__ import annotations

import hashlib
from collections import deque
from collections.abc import Iterable

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

from flowframe.llm.common import map_text

MARKER = "▁"


class LongestMatch:
    """Numbers of greedy longest-match pieces."""

    def __init__(self, pieces: Iterable[str]) -> None:
        # node 0 is the root; fail -1: the text of the node cannot be cut into pieces
        self.next: list[dict[str, int]] = [{}]
        whole = [False]
        for piece in pieces:
            node = 0
            for c in piece:
                step = self.next[node].get(c)
                if step is None:
                    step = len(self.next)
                    self.next[node][c] = step
                    self.next.append({})
                    whole.append(False)
                node = step
            whole[node] = node != 0
        self.fail, self.popped = [-1] * len(whole), [0] * len(whole)
        queue = deque([0])
        while queue:
            node = queue.popleft()
            for c, child in self.next[node].items():
                if whole[child]:
                    self.fail[child], self.popped[child] = 0, 1
                else:
                    back, count = self.fail[node], self.popped[node]
                    while back >= 0 and c not in self.next[back]:
                        count += self.popped[back]
                        back = self.fail[back]
                    if back >= 0:
                        self.fail[child], self.popped[child] = self.next[back][c], count
                queue.append(child)

    def count(self, word: str) -> int:
        """Pieces of ``word``; 1 if it cannot be spelled, 0 if it is empty."""
        nexts, fail, popped = self.next, self.fail, self.popped
        node = total = 0
        for c in word:
            step = nexts[node].get(c)
            while step is None:
                back = fail[node]
                if back < 0:
                    return 1
                total += popped[node]
                node = back
                step = nexts[node].get(c)
            node = step
        while node:
            back = fail[node]
            if back < 0:
                return 1
            total += popped[node]
            node = back
        return total


def sentencepiece_pieces(path: str) -> list[str]:
    """The ordinary pieces of a SentencePiece vocabulary (no control, byte or unknown ones)."""
    from sentencepiece import SentencePieceProcessor

    model = SentencePieceProcessor(model_file=path)
    skip = (model.is_control, model.is_byte, model.is_unknown, model.is_unused)
    return [model.id_to_piece(i) for i in range(model.vocab_size()) if not any(f(i) for f in skip)]


_BUILT: dict[str, LongestMatch] = {}


def token_counts(docs: DataFrame, pieces: list[str], text: str = "text", marker: str = MARKER,
                 words: str = "n_words", tokens: str = "n_tokens") -> DataFrame:
    """``docs`` with the numbers of words and tokens of each whole text.

    ``pieces`` is a vocabulary: bounded by its kind, it is broadcast once; every
    Python worker builds the automaton once.
    """
    shared = docs.sparkSession.sparkContext.broadcast(pieces)
    key = hashlib.sha256("\n".join(pieces).encode()).hexdigest()

    def setup() -> LongestMatch:
        if key not in _BUILT:
            _BUILT.clear()
            _BUILT[key] = LongestMatch(shared.value)
        return _BUILT[key]

    def step(automaton: LongestMatch, texts: pa.Array) -> list[pa.Array]:
        split = pc.utf8_split_whitespace(texts.fill_null(""))
        coded = split.flatten().dictionary_encode()
        counts = np.array([automaton.count(marker + w) if w else 0 for w in coded.dictionary.to_pylist()] + [0], np.int64)
        real = np.array([bool(w) for w in coded.dictionary.to_pylist()] + [False], np.int64)
        at = split.offsets.to_numpy() - split.offsets[0].as_py()
        codes = coded.indices.to_numpy(zero_copy_only=False)
        return [pa.array(np.diff(np.concatenate(([0], np.cumsum(x[codes])))[at])) for x in (real, counts)]

    return map_text(docs, text, f"`{words}` bigint, `{tokens}` bigint", step, setup)
