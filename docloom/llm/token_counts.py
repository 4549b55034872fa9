"""Token counts by a linear longest-match automaton.

A trie over the vocabulary, whose nodes carry a failure link and the number of
pieces that following the link pops, gives the number of greedy longest-match
pieces of a word in one pass over its characters, without building any piece.

A word is read with ``start`` before it, as pieces that start a word are written; where
no longer piece fits, ``start`` alone is a piece if the vocabulary has it. A word that
can't be covered counts as one unknown piece. Defined results: null and empty texts have no words and no
pieces; repeated rows count alike; other columns are left alone.
"""

from __future__ import annotations

from collections import deque
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docloom.llm.common import column, slices, small_batches, text_bytes


class Counter:
    """Counts the greedy pieces of ``start`` + word.

    Node 0 is the root; a word begins at the node of ``start``, which may be a piece of
    its own. ``fail[v]`` is the node to go to when v has no way on, -1 for none;
    ``pops[v]`` is the number of pieces that leaves behind.
    """

    def __init__(self, vocabulary: set[str], start: str = "▁") -> None:
        self.next: list[dict[str, int]] = [{}]
        ends = [False]
        for piece in [start, *vocabulary]:
            node = 0
            for c in piece:
                to = self.next[node].get(c)
                if to is None:
                    to = self.next[node][c] = len(self.next)
                    self.next.append({})
                    ends.append(False)
                node = to
            ends[node] = node > 0 and piece in vocabulary
        self.start = 0
        for c in start:
            self.start = self.next[self.start][c]
        self.fail = [-1] * len(self.next)
        self.pops = [0] * len(self.next)
        todo = deque([0])
        while todo:
            v = todo.popleft()
            for c, u in self.next[v].items():
                todo.append(u)
                if ends[u]:
                    self.fail[u], self.pops[u] = 0, 1
                    continue
                w, popped = self.fail[v], self.pops[v]
                while w >= 0 and c not in self.next[w]:
                    popped += self.pops[w]
                    w = self.fail[w]
                if w >= 0:
                    self.fail[u], self.pops[u] = self.next[w][c], popped

    def __call__(self, word: str) -> int:
        """The number of pieces; -1 if the word can't be covered."""
        if not word:
            return 0
        nxt, fail, pops = self.next, self.fail, self.pops
        v, n = self.start, 0
        for c in word:
            while (u := nxt[v].get(c)) is None:
                n += pops[v]
                v = fail[v]
                if v < 0:
                    return -1
            v = u
        while v:
            n += pops[v]
            v = fail[v]
            if v < 0:
                return -1
        return n


def brute_count(word: str, vocabulary: set[str], start: str = "▁") -> int:
    """The same by trying every length at every place of ``start`` + word; for tests."""
    whole = start + word if word else ""
    i = n = 0
    while i < len(whole):
        for j in range(len(whole), i, -1):
            if whole[i:j] in vocabulary:
                i, n = j, n + 1
                break
        else:
            return -1
    return n


def sentencepiece_vocabulary(path: str) -> list[str]:
    """The ordinary pieces of a sentencepiece model file."""
    import sentencepiece

    m = sentencepiece.SentencePieceProcessor(model_file=path)
    return [m.id_to_piece(i) for i in range(m.get_piece_size()) if not (m.is_control(i) or m.is_unknown(i) or m.is_byte(i))]


_COUNTERS: dict[str, Counter] = {}


def count_tokens(docs: DataFrame, path: str, most: int = 300_000) -> DataFrame:
    """doc_id, n_words, n_pieces (unknown words count one) and n_unknown of every whole text.

    Each worker builds the automaton from the vocabulary file once and keeps the
    counts of at most ``most`` distinct words.
    """

    small_batches(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if path not in _COUNTERS:
            _COUNTERS[path] = Counter(set(sentencepiece_vocabulary(path)))
        count = _COUNTERS[path]

        class Seen(dict):
            def __missing__(self, word: bytes) -> int:
                if len(self) >= most:
                    self.clear()
                n = self[word] = count(word.decode("utf-8", "replace"))
                return n

        seen = Seen()
        for b in slices(batches, "text"):
            words, pieces, unknown = [], [], []
            for text in column(b, "text"):
                found = list(map(seen.__getitem__, text.split()))
                bad = found.count(-1)
                words.append(len(found))
                pieces.append(sum(found) + 2 * bad)
                unknown.append(bad)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(words, pa.int64()), pa.array(pieces, pa.int64()), pa.array(unknown, pa.int64())], names=["doc_id", "n_words", "n_pieces", "n_unknown"])

    return docs.select("doc_id", text_bytes().alias("text")).mapInArrow(run, "doc_id bigint, n_words bigint, n_pieces bigint, n_unknown bigint")
