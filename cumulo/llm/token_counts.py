"""Greedy longest-match token counts by a linear automaton over the vocabulary trie.

Each node knows where matching goes on when no edge fits (the failure link) and how many tokens
that settles (the popped count), so a word is read once, byte by byte, and no piece is built.

A word is matched with a leading blank, as the vocabulary's word-initial tokens have it. A word that
cannot be covered counts as one unknown token. Null or empty text: no words, no tokens. Repeated rows are
counted each, very long words like any other; an empty table gives no rows. Columns named like the results are
replaced.
"""

from __future__ import annotations

import base64
from collections import deque

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cumulo.llm.common import texts_of, words_of

# Words whose counts a task keeps at hand, beyond which the store starts anew, and bytes of a word that is kept.
KEPT_WORDS = 200_000
LONGEST_KEPT = 64


class Automaton:
    """Trie with failure links. ``step`` maps node * 256 + byte to the next node. ``parts`` is its
    plain content, from which ``of`` makes it again."""

    @classmethod
    def of(cls, parts: tuple) -> Automaton:
        out = cls.__new__(cls)
        out.step, out.fail, out.popped = parts
        return out

    @property
    def parts(self) -> tuple:
        return self.step, self.fail, self.popped

    def __init__(self, vocabulary: list[bytes]):
        self.step: dict[int, int] = {}
        token = [False]
        for piece in vocabulary:
            node = 0
            for byte in piece:
                node = self.step.setdefault(node << 8 | byte, len(token))
                if node == len(token):
                    token.append(False)
            token[node] = node > 0
        # fail -1: what was read so far cannot be cut into tokens.
        self.fail, self.popped = [-1] * len(token), [0] * len(token)
        edges: list[list[tuple[int, int]]] = [[] for _ in token]
        for at, node in self.step.items():
            edges[at >> 8].append((at & 255, node))
        queue = deque([0])
        while queue:
            parent = queue.popleft()
            for byte, node in edges[parent]:
                queue.append(node)
                if token[node]:
                    self.fail[node], self.popped[node] = 0, 1
                    continue
                at, popped = self.fail[parent], self.popped[parent]
                while at >= 0 and (at << 8 | byte) not in self.step:
                    popped += self.popped[at]
                    at = self.fail[at]
                if at >= 0:
                    self.fail[node], self.popped[node] = self.step[at << 8 | byte], popped

    def count(self, word: bytes) -> int:
        """Tokens of the word by greedy longest match; 1 if some part of it is in no token."""
        node, tokens, step, fail, popped = 0, 0, self.step, self.fail, self.popped
        for byte in word:
            following = step.get(node << 8 | byte)
            while following is None:
                if fail[node] < 0:
                    return 1
                tokens += popped[node]
                node = fail[node]
                following = step.get(node << 8 | byte)
            node = following
        while node:
            if fail[node] < 0:
                return 1
            tokens += popped[node]
            node = fail[node]
        return tokens


def vocabulary(path: str) -> list[bytes]:
    """Tokens of a file with one base64 token and its rank per line."""
    with open(path, "rb") as lines:
        return [base64.b64decode(line.split()[0]) for line in lines if line.strip()]


def count_tokens(docs: DataFrame, path: str, text: str = "text") -> DataFrame:
    """Add ``n_words`` and ``n_tokens``; the other columns stay. The automaton is broadcast: its
    size is that of the vocabulary file."""
    automaton = docs.sparkSession.sparkContext.broadcast(Automaton(vocabulary(path)).parts)
    columns = [c for c in docs.columns if c not in ("n_words", "n_tokens")]
    schema = docs.select(*columns, F.lit(0).cast("long").alias("n_words"), F.lit(0).cast("long").alias("n_tokens")).schema

    def run(batches):
        machine, known = Automaton.of(automaton.value), {}
        for batch in batches:
            words, tokens = [], []
            for value in texts_of(batch, text):
                own = words_of(value)
                total = 0
                for word in own:
                    n = known.get(word)
                    if n is None:
                        n = machine.count(b" " + word)
                        if len(known) >= KEPT_WORDS:
                            known.clear()
                        if len(word) <= LONGEST_KEPT:
                            known[word] = n
                    total += n
                words.append(len(own))
                tokens.append(total)
            out = batch.select(columns)
            yield pa.RecordBatch.from_arrays(
                [*out.columns, pa.array(words, pa.int64()), pa.array(tokens, pa.int64())],
                names=[*columns, "n_words", "n_tokens"],
            )

    return docs.mapInArrow(run, schema)
