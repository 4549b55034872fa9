"""Language ID by cross-parsing entropy.

For each language a suffix automaton of labelled text is kept. Reading a text, the
automaton walks along the longest match; when no way on exists a phrase ends and the
walk starts anew. The phrases a text needs against a language's sample, times the
bits of a pointer into that sample and over the text's length, estimate the cross
entropy; the language with the least wins. The walk is a finite automaton with
resets, so many blocks of text step together through one table.

Fitting takes whole training texts with the smallest hashed ids, up to ``sample_chars``
characters of each language, a documented bound; every labelled language and every letter
of the samples counts. A letter that a language's sample lacks ends a
phrase there. Texts are read whole, in blocks of ``BLOCK`` symbols (a phrase ends at a
block's end).

Defined results: a null text, or one without a letter, is ``und`` with score 0; with
no labelled text every prediction is ``und``; ties go to the smaller name.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from docloom.llm.common import column, crc_mod, slices, small_batches

BLOCK = 4096
#: Cells that tables of all languages may have together; automata beyond are kept as sorted transitions.
CELLS = 60_000_000
_CODES = 0x110000
UNKNOWN = "und"
_LETTER: list[np.ndarray] = []


def letters() -> np.ndarray:
    """code point -> code point of its small letter, or 32 for what is no letter."""
    if not _LETTER:
        out = np.full(_CODES, 32, np.int32)
        for i in range(_CODES):
            c = chr(i)
            if c.isalpha():
                low = c.lower()
                out[i] = ord(low) if len(low) == 1 else i
        _LETTER.append(out)
    return _LETTER[0]


def normal(text: str) -> np.ndarray:
    """Letters small, everything else a space."""
    return letters()[np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)]


class Automata:
    """The suffix automata of some languages: state x symbol -> next state; bit 0 marks the start of a phrase.

    Each language numbers the symbols of its own sample; all others are its symbol 0,
    which has no way on anywhere. Automata are tables, the smallest first, as far as
    ``cells`` go, and sorted transitions beyond.
    """

    def __init__(self, samples: dict[str, str], cells: int = CELLS) -> None:
        self.langs = sorted(samples)
        codes = {k: normal(v) for k, v in samples.items()}
        values = np.unique(np.concatenate(list(codes.values()))) if codes else np.zeros(0, np.int32)
        self.symbol = np.zeros(_CODES, np.int32)  # 0: any letter in no sample
        self.symbol[values] = np.arange(1, len(values) + 1)
        self.bits = [np.log2(max(2, len(codes[k]))) for k in self.langs]
        self.own, ways = [], []
        for k in self.langs:
            seq = self.symbol[codes[k]]
            used = np.unique(seq)
            own = np.zeros(len(values) + 1, np.int32)
            own[used] = np.arange(1, len(used) + 1)
            self.own.append(own)
            ways.append(self._ways(own[seq].tolist()))
        size = [len(nxt) * (int(own.max()) + 1) for nxt, own in zip(ways, self.own)]
        self.steps = [None] * len(ways)
        for k in sorted(range(len(ways)), key=lambda k: size[k]):
            self.steps[k] = (self._table if size[k] <= cells else self._sorted)(ways[k], int(self.own[k].max()) + 1)
            cells -= size[k]

    @staticmethod
    def _ways(seq: list[int]) -> list[dict[int, int]]:
        """The suffix automaton: for each state, symbol -> next state."""
        nxt: list[dict[int, int]] = [{}]
        link, length, last = [-1], [0], 0
        for c in seq:
            cur = len(nxt)
            nxt.append({})
            length.append(length[last] + 1)
            link.append(0)
            p = last
            while p >= 0 and c not in nxt[p]:
                nxt[p][c] = cur
                p = link[p]
            if p >= 0:
                q = nxt[p][c]
                if length[p] + 1 == length[q]:
                    link[cur] = q
                else:
                    twin = len(nxt)
                    nxt.append(dict(nxt[q]))
                    length.append(length[p] + 1)
                    link.append(link[q])
                    while p >= 0 and nxt[p].get(c) == q:
                        nxt[p][c] = twin
                        p = link[p]
                    link[q] = link[cur] = twin
            last = cur
        return nxt

    @staticmethod
    def _arrays(nxt: list[dict[int, int]], w: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """What follows where there is no way on, by symbol: a phrase ends, the next begins with this symbol. And all transitions, by state * w + symbol."""
        start = np.ones(w, np.int64)
        for c, u in nxt[0].items():
            start[c] = u * w * 2 + 1
        at = np.fromiter((v * w + c for v, d in enumerate(nxt) for c in d), np.int64)
        to = np.fromiter((u * w * 2 for d in nxt for u in d.values()), np.int64)
        return start, at, to | (at < w)  # a phrase also begins where the walk stands at the start

    def _table(self, nxt: list[dict[int, int]], w: int) -> Callable[[np.ndarray, np.ndarray], np.ndarray]:
        start, at, to = self._arrays(nxt, w)
        table = np.empty((len(nxt), w), np.int32)
        table[:] = start
        table = table.ravel()
        table[at] = to
        return lambda state, symbol: table.take(state + symbol)

    def _sorted(self, nxt: list[dict[int, int]], w: int) -> Callable[[np.ndarray, np.ndarray], np.ndarray]:
        start, at, to = self._arrays(nxt, w)
        order = np.argsort(at)
        at, to = np.append(at[order], -1), to[order]

        def step(state: np.ndarray, symbol: np.ndarray) -> np.ndarray:
            key = state + symbol
            i = np.searchsorted(at[:-1], key)
            hit = at[i] == key
            out = start[symbol]
            out[hit] = to[i[hit]]
            return out

        return step

    def phrases(self, symbols: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        """Phrases of each block for each language. symbols: of the blocks one after another; sizes: their lengths, none 0.

        All blocks step together, the longest first, so that those still walking stand in front.
        """
        order = np.argsort(-sizes, kind="stable")
        rank = np.empty(len(sizes), np.int64)
        rank[order] = np.arange(len(sizes))
        longest = int(sizes.max(initial=0))
        alive = np.searchsorted(-sizes[order], -np.arange(longest), side="left")  # blocks longer than t
        off = np.concatenate([[0], np.cumsum(alive)])
        block = np.repeat(np.arange(len(sizes)), sizes)
        packed = np.empty(len(symbols), np.int32)
        packed[off[np.arange(len(symbols)) - (np.cumsum(sizes) - sizes)[block]] + rank[block]] = symbols
        out = np.zeros((len(self.langs), len(sizes)), np.int64)
        for k, step in enumerate(self.steps):
            own = self.own[k][packed]
            state = np.zeros(len(sizes), np.int64)
            count = np.zeros(len(sizes), np.int32)
            for t, (n, at) in enumerate(zip(alive.tolist(), off.tolist())):
                got = step(state[:n], own[at : at + n])
                count[:n] += got & 1
                state[:n] = got >> 1
            out[k] = count[rank]
        return out

    def score(self, texts: list[str | None]) -> tuple[list[str], list[float]]:
        """The language and a confidence (0 to 1) for each text."""
        langs, scores = [UNKNOWN] * len(texts), [0.0] * len(texts)
        seqs, sizes, owner = [], [], []
        for i, t in enumerate(texts):
            s = normal(t or "")
            if len(s) and (s != 32).any() and self.langs:
                seqs.append(self.symbol[s])
                n = [BLOCK] * (len(s) // BLOCK) + ([len(s) % BLOCK] if len(s) % BLOCK else [])
                sizes += n
                owner += [i] * len(n)
        if not seqs:
            return langs, scores
        sizes, own = np.array(sizes, np.int64), np.array(owner)
        counts = self.phrases(np.concatenate(seqs), sizes)
        total = np.zeros((len(self.langs), len(texts)))
        for k in range(len(self.langs)):
            total[k] = np.bincount(own, counts[k], len(texts)) * self.bits[k]
        size = np.maximum(1, np.bincount(own, sizes, len(texts)))
        rate = total / size
        best = np.argmin(rate, axis=0)
        odds = np.exp2(np.clip(-(total - total.min(axis=0)) / 8, -60, 0))
        conf = 1 / odds.sum(axis=0)
        for i in set(owner):
            langs[i], scores[i] = self.langs[best[i]], float(conf[i])
        return langs, scores


def fit(train: DataFrame, sample_chars: int = 40_000) -> dict[str, str]:
    """Training text per language: the texts with the smallest hashed ids, whole, up to ``sample_chars`` characters in all.

    The characters of each language and range of hashes tell which ranges are needed, so
    two passes serve all languages.
    """
    d = train.where("lang IS NOT NULL AND text <> '' AND doc_id IS NOT NULL").withColumn("h", F.xxhash64("doc_id"))
    d = d.select("lang", "h", "doc_id", F.shiftright("h", 48).alias("part"), F.substring("text", 1, sample_chars).alias("t")).withColumn("n", F.length("t"))
    by = Window.partitionBy("lang")
    before = Window.unboundedPreceding
    parts = d.groupBy("lang", "part").agg(F.sum("n").alias("n")).withColumn("so_far", F.sum("n").over(by.orderBy("part").rowsBetween(before, 0)))
    wanted = parts.where(F.col("so_far") - F.col("n") < sample_chars).groupBy("lang").agg(F.max("part").alias("last"))
    few = d.join(F.broadcast(wanted), "lang").where("part <= last")
    row = by.orderBy("h", "doc_id", "t")
    few = few.withColumns({"r": F.row_number().over(row), "so_far": F.sum("n").over(row.rowsBetween(before, 0))}).where(F.col("so_far") - F.col("n") < sample_chars)
    found: dict[str, list] = {}
    for r in few.select("lang", "r", "t").collect():
        found.setdefault(r["lang"], []).append((r["r"], r["t"]))
    return {k: "\n".join(t for _, t in sorted(v))[:sample_chars] for k, v in found.items()}


_BUILT: dict[str, Automata] = {}


def identify(docs: DataFrame, samples: dict[str, str]) -> DataFrame:
    """doc_id, lang_pred and score of every whole text. The samples are bounded, see ``fit``."""
    sent, key = docs.sparkSession.sparkContext.broadcast(samples), uuid.uuid4().hex

    small_batches(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if key not in _BUILT:
            _BUILT.clear()
            _BUILT[key] = Automata(sent.value)
        model = _BUILT[key]
        for b in slices(batches, "text", 3_000_000):
            langs, scores = model.score(column(b, "text"))
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(langs, pa.string()), pa.array(scores, pa.float64())], names=["doc_id", "lang_pred", "score"])

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id bigint, lang_pred string, score double")


def identify_languages(docs: DataFrame, **bounds: int) -> DataFrame:
    """Learn from the rows whose crc32(doc_id) mod 4 is not 2, predict all."""
    samples = fit(docs.where(crc_mod("doc_id", 4) != 2), **bounds)
    return identify(docs, samples).select("doc_id", (crc_mod("doc_id", 4) == 2).alias("held_out"), "lang_pred", "score")
