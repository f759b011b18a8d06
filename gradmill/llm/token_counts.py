"""Token counts by greedy longest match, without building the pieces.

Words (runs without white space) are cut from the left, each time at the longest
piece of the vocabulary: the first piece from the pieces that begin a word, the
others from those that continue one. If the bare mark of a beginning is a piece too, it
begins the words that no longer beginning fits, and takes none of their
characters. A word that cannot be cut counts as one unknown token. Only the number of pieces is wanted, so a word is read once, from
left to right, by an automaton (Song et al., 2021):

* a trie holds all pieces, beginnings and continuations below roots of their own;
* where no character fits, the *failure link* of a node leads to the node for what
  is left after the longest pieces at its start have been popped, and the node
  knows how many those are. Both are computed once, in order of depth.

Every step reads a character or pops pieces that were read before, so the work is
linear in the length of the text, however long its words are. The automaton is
built on the driver from the vocabulary, whose size is fixed, and broadcast.

Counting is one pass without a shuffle. NULL and empty texts have no words; whole texts
are read however long; every row is counted, also with a NULL id or one that repeats, and
equal texts count alike. Of pieces of equal length there is only one that fits, so there
are no ties. An empty table gives an empty result. Other columns are not read.
"""

from __future__ import annotations

from collections import deque

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

#: Words whose counts a task remembers; then it forgets all and goes on.
REMEMBERED = 100_000
#: Longer words are counted anew each time: what is remembered has a size.
REMEMBERED_LENGTH = 64


class Automaton:
    """``starts`` and ``parts``: pieces that begin and that continue a word; an empty start is the bare mark."""

    def __init__(self, starts, parts):
        self.next: list[dict[str, int]] = [{}, {}]
        starts = list(starts)
        self.piece = ["" in starts, False]
        for root, pieces in ((0, starts), (1, parts)):
            for p in pieces:
                node = root
                for c in p:
                    node = self.next[node].setdefault(c, len(self.next))
                    if node == len(self.next):
                        self.next.append({})
                        self.piece.append(False)
                self.piece[node] = self.piece[node] or bool(p)
        #: where to go on when no character fits (-1: the word is unknown), and the pieces popped by that
        self.link = [-1] * len(self.next)
        self.popped = [0] * len(self.next)
        if self.piece[0]:
            self.link[0], self.popped[0] = 1, 1
        todo = deque((root, c, child) for root in (0, 1) for c, child in self.next[root].items())
        while todo:
            parent, c, node = todo.popleft()
            if self.piece[node]:
                self.link[node], self.popped[node] = 1, 1
            else:
                at, n = self.link[parent], self.popped[parent]
                while at >= 0 and c not in self.next[at]:
                    n += self.popped[at]
                    at = self.link[at]
                if at >= 0:
                    self.link[node], self.popped[node] = self.next[at][c], n
            todo.extend((node, d, child) for d, child in self.next[node].items())

    def pieces(self, word: str) -> int:
        """How many pieces a word has; 0 if it cannot be cut."""
        node = n = 0
        if not word:
            return 0
        for c in word:
            while c not in self.next[node]:
                n += self.popped[node]
                node = self.link[node]
                if node < 0:
                    return 0
            node = self.next[node][c]
        while node != 1:
            n += self.popped[node]
            node = self.link[node]
            if node < 0:
                return 0
        return n


def word_pieces(pieces: list[str], mark: str = "▁") -> tuple[list[str], list[str]]:
    """Split a vocabulary whose pieces at the beginning of a word carry ``mark``; the bare mark is an empty start."""
    starts = [p[len(mark):] for p in pieces if p.startswith(mark) and mark not in p[len(mark):]]
    return starts, [p for p in pieces if p and mark not in p]


def count(docs: DataFrame, automaton: Automaton) -> DataFrame:
    """``(doc_id, n_words, n_tokens, n_unknown)``: one row per document."""
    shared = docs.sparkSession.sparkContext.broadcast(automaton)

    def run(batches):
        known: dict[str, int] = {}
        pieces = shared.value.pieces
        for b in batches:
            rows = np.zeros((b.num_rows, 3), np.int64)
            for d, text in enumerate(b.column(1).to_pylist()):
                words = text.split() if text else []
                tokens = unknown = 0
                for w in words:
                    n = known.get(w)
                    if n is None:
                        n = pieces(w)
                        if len(w) <= REMEMBERED_LENGTH:
                            if len(known) >= REMEMBERED:
                                known.clear()
                            known[w] = n
                    tokens += n or 1
                    unknown += not n
                rows[d] = len(words), tokens, unknown
            yield pa.RecordBatch.from_arrays([b.column(0), *map(pa.array, rows.T.copy())], out.names)

    out = T.StructType([T.StructField("doc_id", docs.schema["doc_id"].dataType),
                        *(T.StructField(c, T.LongType()) for c in ("n_words", "n_tokens", "n_unknown"))])
    return docs.select("doc_id", "text").mapInArrow(run, out)
