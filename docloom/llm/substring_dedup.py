"""Substring dedup by seed and extend.

Of every window of ``length`` words, the smallest hash among its runs of ``seed``
words is its anchor (winnowing), so equal windows have equal anchors. Documents join
on anchors. Around an anchor lies a block: the words of all windows that chose it.
Equal blocks in two documents extend the seed both ways in one step; where blocks
differ, the windows of one representative of each distinct block are compared, which
extends the seed word by word up to where the texts part. The union of the windows
also found in a document with a smaller id is what is removed; ``repeats`` returns it
as maximal runs.

Only minimum ids per key are gathered, never pairs, so a passage in a third of all
documents costs rows in proportion to its occurrences, and partial aggregation bounds
what one task gets for it.

Defined results: null and short texts lose nothing; a null doc_id is smaller than any
other; rows that repeat a doc_id don't remove each other's words.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docloom.llm.common import NULL_ID, Windows, arrow, column, every, fresh, materialise, slices, small_batches, split_words, text_bytes

LENGTH, SEED = 50, 20
_LOW = np.uint64(2**24 - 1)


def sliding_min(x: np.ndarray, width: int) -> np.ndarray:
    """Of every ``width`` neighbours, by doubling."""
    have = 1
    while have * 2 <= width:
        x = np.minimum(x[:-have], x[have:])
        have *= 2
    return np.minimum(x[: len(x) - (width - have)], x[width - have :]) if width > have else x


def anchors(win: Windows, n: int, length: int, seed: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(hash, first window, last window) of each anchor; of equal hashes in a window the rightmost."""
    grams = win.all(seed)
    keyed = (grams & ~_LOW) | (_LOW - (np.arange(len(grams), dtype=np.uint64) & _LOW))
    best = sliding_min(keyed, length - seed + 1)
    first = np.concatenate([[0], np.flatnonzero(best[1:] != best[:-1]) + 1])
    last = np.concatenate([first[1:], [n - length + 1]]) - 1
    # Where in the window the winner stands, also in texts longer than the key's 24 bits.
    place = first + (((_LOW - (best[first] & _LOW)) - first.astype(np.uint64)) & _LOW).astype(np.int64)
    return grams[place], first, last


def _keyed(docs: DataFrame, id_col: str, text: str) -> DataFrame:
    d = docs.select(F.coalesce(F.col(id_col).cast("long"), F.lit(NULL_ID)).alias("doc"), text_bytes(text).alias("text"))
    return d.withColumn("th", F.xxhash64("text"))


def repeats(docs: DataFrame, length: int = LENGTH, seed: int = SEED, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc, th, spans): per document the first and last removed window of each stretch.

    ``th`` is the text's hash: it tells rows of one id apart.
    """
    small_batches(docs.sparkSession)
    d = _keyed(docs, id_col, text)

    def occurrences(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, "text"):
            cols: list[list] = [[], [], [], [], []]
            for doc, th, h in zip(column(b, "doc"), column(b, "th"), split_words(arrow(b, "text"))):
                n = len(h)
                if n < length:
                    continue
                win = Windows(h)
                a, lo, hi = anchors(win, n, length, seed)
                for c, v in zip(cols, (a, win.at(lo, hi + length), np.full(len(a), doc), np.full(len(a), th), (lo << 32) | hi)):
                    c.append(v.view(np.int64))
            if cols[0]:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in cols], names=["a", "b", "doc", "th", "span"])

    occ = d.mapInArrow(occurrences, "a bigint, b bigint, doc bigint, th bigint, span bigint")
    shared = occ.groupBy("a").agg(F.min("doc").alias("low"), F.max("doc").alias("top"), F.min("b").alias("b0"), F.max("b").alias("b1")).where("low < top")
    # Written first, so that a skewed anchor's occurrences can be split over tasks in the join.
    shared = materialise(shared.select("a", "low", (F.col("b0") != F.col("b1")).alias("forks")), "shared")
    found = materialise(occ.join(shared, "a"), "anchors")

    # Every block of the anchor is the same: all windows are in the document with the smallest id.
    plain = found.where("NOT forks AND doc > low").select("doc", "th", "span")
    forked = found.where("forks")
    # Written before the join too, as ``first`` below.
    least = materialise(forked.groupBy("a", "b").agg(F.min("doc").alias("block_low")), "least")
    marked = materialise(forked.join(least, ["a", "b"]), "blocks")
    whole = marked.where("doc > block_low").select("doc", "th", "span")
    heads = marked.where("doc = block_low").groupBy("doc", "th").agg(F.collect_list(F.struct("a", "span", "low")).alias("heads"))

    def windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, "text"):
            cols: list[list] = [[], [], [], [], [], []]
            for doc, th, words, hs in zip(column(b, "doc"), column(b, "th"), split_words(arrow(b, "text")), column(b, "heads")):
                win = Windows(words)
                for h in hs:
                    lo, hi = h["span"] >> 32, h["span"] & 0xFFFFFFFF
                    at = np.arange(lo, hi + 1)
                    n = len(at)
                    for c, v in zip(cols, (np.full(n, h["a"]), win.at(at, at + length), np.full(n, doc), np.full(n, th), at, np.full(n, h["low"]))):
                        c.append(v.view(np.int64))
            if cols[0]:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in cols], names=["a", "w", "doc", "th", "at", "low"])

    forks = materialise(d.join(heads, ["doc", "th"]).mapInArrow(windows, "a bigint, w bigint, doc bigint, th bigint, at bigint, low bigint"), "windows")
    first = materialise(forks.groupBy("a", "w").agg(F.min("doc").alias("w_low"), F.max("doc").alias("w_top")).where("w_low < w_top").select("a", "w", "w_low"), "first")
    single = forks.where("doc > low").join(first, ["a", "w"]).where("doc > w_low").select("doc", "th", F.shiftleft("at", 32).bitwiseOR(F.col("at")).alias("span"))
    return plain.unionAll(whole).unionAll(single).groupBy("doc", "th").agg(F.collect_list("span").alias("spans"))


def removed_mask(n: int, spans: list[int], length: int) -> np.ndarray:
    s = np.array(spans, np.int64)
    edge = np.zeros(n + 1, np.int32)
    np.add.at(edge, s >> 32, 1)
    np.add.at(edge, np.minimum((s & 0xFFFFFFFF) + length, n), -1)
    return np.cumsum(edge[:n]) > 0


def maximal_repeats(docs: DataFrame, length: int = LENGTH, seed: int = SEED, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """(id, first_word, n_words): each maximal run of words that windows also found in a document with a smaller id cover."""
    spans = repeats(docs, length, seed, id_col, text)

    def runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            docs_, firsts, sizes = [], [], []
            for doc, found in zip(column(b, "doc"), column(b, "spans")):
                s = np.sort(np.array(found, np.int64))  # by first window
                lo, hi = s >> 32, np.maximum.accumulate((s & 0xFFFFFFFF) + length)
                new = np.append(True, lo[1:] > hi[:-1])
                at = np.flatnonzero(new)
                ends = hi[np.append(at[1:], len(s)) - 1]
                docs_ += [doc] * len(at)
                firsts += lo[at].tolist()
                sizes += (ends - lo[at]).tolist()
            yield pa.RecordBatch.from_arrays([pa.array(docs_, pa.int64()), pa.array(firsts, pa.int64()), pa.array(sizes, pa.int64())], names=["doc", "first_word", "n_words"])

    out = spans.select("doc", "spans").mapInArrow(runs, "doc bigint, first_word bigint, n_words bigint")
    return out.select(F.when(F.col("doc") != NULL_ID, F.col("doc")).alias(id_col), "first_word", "n_words")


def dedup(docs: DataFrame, length: int = LENGTH, seed: int = SEED, keep_text: bool = False, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row: the id, n_words, n_removed, kept_sha256, the number of maximal repeats, and the kept text on demand."""
    spans = repeats(docs, length, seed, id_col, text)
    d = _keyed(docs, id_col, text).join(spans, ["doc", "th"], "left")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, "text"):
            n, gone, sha, kept, runs = [], [], [], [], []
            for t, s in zip(column(b, "text"), column(b, "spans")):
                words = t.split()
                n.append(len(words))
                k = 0
                if s:
                    mask = removed_mask(len(words), s, length)
                    gone.append(int(mask.sum()))
                    k = int(mask[0]) + int((mask[1:] & ~mask[:-1]).sum())
                    words = [w for w, m in zip(words, mask.tolist()) if not m]
                else:
                    gone.append(0)
                runs.append(k)
                own = b" ".join(words)
                sha.append(hashlib.sha256(own).hexdigest())
                if keep_text:
                    kept.append(own.decode("utf-8", "replace") if s else t.decode("utf-8", "replace"))
            cols = [b.column(0), b.column(1), pa.array(n, pa.int64()), pa.array(gone, pa.int64()), pa.array(sha, pa.string()), pa.array(runs, pa.int64())] + [pa.array(kept, pa.string())] * keep_text
            yield pa.RecordBatch.from_arrays(cols, names=["doc", "th", "n_words", "n_removed", "kept_sha256", "n_repeats"] + ["kept"] * keep_text)

    out = d.mapInArrow(cut, "doc bigint, th bigint, n_words bigint, n_removed bigint, kept_sha256 string, n_repeats bigint" + ", kept string" * keep_text)
    return out.withColumn(id_col, F.when(F.col("doc") != NULL_ID, F.col("doc"))).select(id_col, *[c for c in out.columns if c not in ("doc", "th")])


def remove_repeats(docs: DataFrame, length: int = LENGTH, seed: int = SEED) -> DataFrame:
    """``docs`` with repeated passages cut out of ``text`` (texts without any stay as they are); emptied rows go."""
    spans = repeats(docs, length, seed)
    names = docs.columns
    c_doc, c_th, c_spans, c_new = (fresh(c, names) for c in ("_doc", "_th", "_spans", "_new"))
    d = docs.withColumn(c_doc, F.coalesce(F.col("doc_id").cast("long"), F.lit(NULL_ID))).withColumn(c_th, F.xxhash64(text_bytes("text")))
    spans = spans.select(F.col("doc").alias(c_doc), F.col("th").alias(c_th), F.col("spans").alias(c_spans))
    joined = d.join(spans, [c_doc, c_th], "left")
    from pyspark.sql.functions import arrow_udf

    @arrow_udf("string")
    def cut(t: pa.Array, s: pa.Array) -> pa.Array:
        out = []
        for own, sp in zip(t.to_pylist(), s.to_pylist()):
            if sp and own is not None:
                words = own.encode().split()
                mask = removed_mask(len(words), sp, length)
                own = b" ".join(w for w, m in zip(words, mask.tolist()) if not m).decode()
            out.append(own)
        return pa.array(out, pa.string())

    cut = cut.asNondeterministic()  # else the plan would run it once for the filter and once more for the text
    whole = F.col(c_spans).isNull()
    new = joined.withColumn(c_new, F.when(whole, F.col("text")).otherwise(cut("text", c_spans)))
    new = new.where(whole | (F.length(c_new) > 0)).withColumn("text", F.col(c_new))
    if "n_chars" in names:
        new = new.withColumn("n_chars", F.when(whole, F.col("n_chars")).otherwise(F.length("text").cast(docs.schema["n_chars"].dataType)))
    return new.select(*every(names))
