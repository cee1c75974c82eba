"""Word-piece token counts by a linear longest-match automaton."""

from __future__ import annotations

from collections import deque

import pyarrow as pa
from pyspark.sql import DataFrame

from barflow.llm.byte_bpe import read_ranks
from barflow.llm.common import slices

#: Distinct words whose counts a task remembers.
REMEMBERED = 1 << 18


class LongestMatch:
    """A byte trie of the vocabulary with failure links and the number of pieces that following one pops.

    A node stands for a prefix of a piece. Its failure link leads to where matching goes on once the pieces
    that are settled have been taken off its front, and ``popped`` counts these. So a word is read once from
    left to right, each failure takes off settled pieces, and no piece is ever built.
    """

    def __init__(self, pieces):
        self.arcs: dict[int, int] = {}  # node * 256 + byte -> node
        is_piece = [False]
        for piece in pieces:
            node = 0
            for byte in piece:
                following = self.arcs.get(node << 8 | byte)
                if following is None:
                    following = self.arcs[node << 8 | byte] = len(is_piece)
                    is_piece.append(False)
                node = following
            is_piece[node] = is_piece[node] or node > 0
        self.link = [-1] * len(is_piece)  # -1: none, the word has no division
        self.popped = [0] * len(is_piece)
        children: dict[int, list[tuple[int, int]]] = {}
        for key, node in self.arcs.items():
            children.setdefault(key >> 8, []).append((key & 255, node))
        queue = deque([0])
        while queue:
            parent = queue.popleft()
            for byte, node in children.get(parent, ()):
                queue.append(node)
                if is_piece[node]:
                    self.link[node], self.popped[node] = 0, 1
                    continue
                state, count = self.link[parent], self.popped[parent]
                while state >= 0 and (state << 8 | byte) not in self.arcs:
                    count += self.popped[state]
                    state = self.link[state]
                if state >= 0:
                    self.link[node], self.popped[node] = self.arcs[state << 8 | byte], count

    def count(self, word: bytes) -> int:
        """Pieces of the greedy division of a word; 1 (the unknown piece) if it has none."""
        arcs, link, popped = self.arcs, self.link, self.popped
        node = total = 0
        for byte in word:
            following = arcs.get(node << 8 | byte)
            while following is None:
                total += popped[node]
                node = link[node]
                if node < 0:
                    return 1
                following = arcs.get(node << 8 | byte)
            node = following
        while node:
            total += popped[node]
            node = link[node]
            if node < 0:
                return 1
        return total


class _Memory(dict):
    """Counts of the words met, each word led by a space as the vocabulary's first pieces are."""

    def __init__(self, automaton: LongestMatch):
        super().__init__()
        self.automaton = automaton

    def __missing__(self, word: bytes) -> int:
        if len(self) >= REMEMBERED:
            self.clear()
        found = self[word] = self.automaton.count(b" " + word)
        return found


def count_pieces(docs: DataFrame, ranks_path: str) -> DataFrame:
    """``doc_id, n_words, n_tokens`` of every document.

    Words are what the six ASCII white-space characters part. A piece that begins a word has a space before it
    in the vocabulary, the others continue one. Each word is divided greedily into the longest pieces from
    the left; one that cannot be divided counts as one unknown piece. Null and empty texts have no words.
    Repeated rows and rows without an id are answered each; extra columns are ignored; an empty table gives
    no rows. The automaton is as large as the vocabulary and sent to every task; documents are not moved.
    """
    automaton = docs.sparkSession.sparkContext.broadcast(LongestMatch(read_ranks(ranks_path)))

    def run(batches):
        counts = _Memory(automaton.value)
        for batch in slices(batches):
            words, tokens = [], []
            for text in batch.column("text").to_pylist():
                found = text.encode("utf-8", "surrogatepass").split() if text else []
                words.append(len(found))
                tokens.append(sum(map(counts.__getitem__, found)))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(words, pa.int64()), pa.array(tokens, pa.int64())],
                names=["doc_id", "n_words", "n_tokens"])

    return docs.selectExpr("CAST(doc_id AS bigint) AS doc_id", "text").mapInArrow(
        run, "doc_id bigint, n_words bigint, n_tokens bigint")
