"""Toxicity by a linear-chain conditional random field with the tags clean and toxic.

Labels name documents, so the tags to learn from come first: in sampled training
documents labelled toxic, the words that are far commoner there than in the others
are tagged, and so is a word that stands between two of them. The field is then trained on segments of tagged words (features: the word
and its shape; weights by gradient ascent on the conditional likelihood) and applied
to every word of every whole text. Forward-backward gives each word's probability;
the score of a document is its largest, and runs of words over one half are its spans,
with code point offsets.

Bounds, all parameters: ``max_docs`` training documents of each label, those with the
smallest hashed ids; ``SEGMENT`` words in a segment, at most ``PER_DOC`` of one document;
``most_tagged`` words tagged on their own, ``most_words`` words with a weight.

Defined results: null and empty texts score 0; without labels every score is 0;
rows with a null label or id aren't learned from; repeated rows score alike.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docloom.llm.common import column, crc_mod, slices, small_batches, text_bytes

SEGMENT, PER_DOC = 24, 4
EDGE = b".,;:!?\"'()[]{}<>*_~"


def normal(word: bytes) -> bytes:
    return word.strip(EDGE).lower()


def shape(word: bytes) -> int:
    """0 small or other, 1 capital first, 2 all capitals, 3 with a digit."""
    if any(48 <= c <= 57 for c in word):
        return 3
    if word.isupper() and len(word) > 1:
        return 2
    return 1 if word[:1].isupper() else 0


class Field:
    """Weights of a trained field. Tags: 0 clean, 1 toxic; emissions are those of tag 1 over tag 0."""

    def __init__(self, words: dict[bytes, float], shapes: list[float], bias: float, start: float, trans: list[list[float]]) -> None:
        self.words, self.shapes, self.bias, self.start, self.trans = words, shapes, bias, start, trans

    def emission(self, word: bytes) -> float:
        return self.words.get(normal(word), 0.0) + self.shapes[shape(word)] + self.bias

    def marginals(self, e: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        """P(toxic) of each word. e: emissions of documents one after another; sizes: words of each.

        All documents step together: the ratio of the two forward (backward) values is
        carried from word to word.
        """
        if not len(e):
            return np.zeros(0)
        m = np.exp(np.array(self.trans))
        order = np.argsort(-sizes, kind="stable")
        rank = np.empty(len(sizes), np.int64)
        rank[order] = np.arange(len(sizes))
        longest = int(sizes.max())
        alive = np.searchsorted(-sizes[order], -np.arange(longest), side="left")  # documents longer than t
        off = np.concatenate([[0], np.cumsum(alive)])
        first = np.cumsum(sizes) - sizes
        doc = np.repeat(np.arange(len(sizes)), sizes)
        at = off[np.arange(len(e)) - first[doc]] + rank[doc]
        x = np.empty(len(e))
        x[at] = np.exp(np.clip(e, -30, 30))
        up = np.empty(len(e))
        n = alive[0]
        r = np.exp(self.start) * x[:n]
        up[:n] = r
        for t in range(1, longest):
            n, o = alive[t], off[t]
            r = r[:n]
            r = x[o : o + n] * (m[0, 1] + r * m[1, 1]) / (m[0, 0] + r * m[1, 0])
            up[o : o + n] = r
        q = np.ones(alive[longest - 1])
        down = np.ones(len(e))
        for t in range(longest - 2, -1, -1):
            n, k, o = alive[t], alive[t + 1], off[t + 1]
            y = x[o : o + k] * q
            nxt = np.ones(n)
            nxt[:k] = (m[1, 0] + m[1, 1] * y) / (m[0, 0] + m[0, 1] * y)
            q = nxt
            down[off[t] : off[t] + n] = q
        odds = up * down
        return (odds / (1 + odds))[at]


def train(segments: list[tuple[list[bytes], list[int]]], rounds: int = 120, rate: float = 0.15, l2: float = 2e-5, most_words: int = 20_000) -> Field:
    """Maximise the conditional log-likelihood of tagged segments (at most SEGMENT words each) by Adam."""
    count: dict[bytes, int] = {}
    for words, _ in segments:
        for w in words:
            count[normal(w)] = count.get(normal(w), 0) + 1
    vocab = {w: i for i, w in enumerate(sorted(sorted(count), key=lambda w: -count[w])[:most_words]) if count[w] >= 2 or len(count) < 1000}
    v = len(vocab)
    s, length = len(segments), max((len(w) for w, _ in segments), default=1)
    word = np.full((length, s), v, np.int64)
    shp, tag, real = np.zeros((length, s), np.int64), np.zeros((length, s), np.int64), np.zeros((length, s), bool)
    for k, (words, tags) in enumerate(segments):
        n = len(words)
        word[:n, k] = [vocab.get(normal(w), v) for w in words]
        shp[:n, k] = [shape(w) for w in words]
        tag[:n, k] = tags
        real[:n, k] = True
    # Parameters: words, (unknown word, always 0), shapes, bias, start, transitions.
    theta = np.zeros(v + 1 + 4 + 1 + 1 + 4)
    i_shape, i_bias, i_start, i_trans = v + 1, v + 5, v + 6, v + 7
    theta[i_bias] = -2.0
    m1, m2 = np.zeros_like(theta), np.zeros_like(theta)
    both = real[1:] & real[:-1]
    seen = np.array([[(both & (tag[:-1] == a) & (tag[1:] == b)).sum() for b in (0, 1)] for a in (0, 1)], float)
    for step in range(1, rounds + 1):
        e = theta[word] + theta[i_shape + shp] + theta[i_bias]
        tr = theta[i_trans:].reshape(2, 2)
        a = np.zeros((length, 2, s))
        a[0, 1] = e[0] + theta[i_start]
        for t in range(1, length):
            to0 = np.logaddexp(a[t - 1, 0] + tr[0, 0], a[t - 1, 1] + tr[1, 0])
            to1 = np.logaddexp(a[t - 1, 0] + tr[0, 1], a[t - 1, 1] + tr[1, 1]) + e[t]
            a[t, 0] = np.where(real[t], to0, a[t - 1, 0])
            a[t, 1] = np.where(real[t], to1, a[t - 1, 1])
        z = np.logaddexp(a[-1, 0], a[-1, 1])
        b = np.zeros((length, 2, s))
        pair = np.zeros((2, 2))
        for t in range(length - 2, -1, -1):
            e1 = e[t + 1]
            n0 = np.logaddexp(tr[0, 0] + b[t + 1, 0], tr[0, 1] + e1 + b[t + 1, 1])
            n1 = np.logaddexp(tr[1, 0] + b[t + 1, 0], tr[1, 1] + e1 + b[t + 1, 1])
            b[t, 0] = np.where(real[t + 1], n0, b[t + 1, 0])
            b[t, 1] = np.where(real[t + 1], n1, b[t + 1, 1])
            for i in (0, 1):
                for j in (0, 1):
                    p = np.exp(a[t, i] + tr[i, j] + (e1 if j else 0) + b[t + 1, j] - z)
                    pair[i, j] += p[real[t + 1]].sum()
        marg = np.exp(a[:, 1] + b[:, 1] - z)
        diff = np.where(real, tag - marg, 0)
        grad = np.zeros_like(theta)
        grad[: v + 1] = np.bincount(word.ravel(), diff.ravel(), v + 1)
        grad[v] = 0
        grad[i_shape:i_bias] = np.bincount(shp.ravel(), diff.ravel(), 4)
        grad[i_bias], grad[i_start] = diff.sum(), diff[0].sum()
        grad[i_trans:] = (seen - pair).ravel()
        grad = grad / max(1, s) - l2 * theta
        m1 = 0.9 * m1 + 0.1 * grad
        m2 = 0.999 * m2 + 0.001 * grad**2
        theta = theta + rate * (m1 / (1 - 0.9**step)) / (np.sqrt(m2 / (1 - 0.999**step)) + 1e-8)
    tr = theta[i_trans:].reshape(2, 2)
    return Field({w: float(theta[i]) for w, i in vocab.items()}, theta[i_shape:i_bias].tolist(), float(theta[i_bias]), float(theta[i_start]), tr.tolist())


def fit(docs: DataFrame, labels: DataFrame, max_docs: int = 2000, ratio: float = 8.0, least: int = 4, surprise: float = 24.0, most_tagged: int = 2000, most_words: int = 20_000) -> Field:
    """A field learned from at most ``max_docs`` documents of each label."""
    lab = labels.select("doc_id", "toxic").where("doc_id IS NOT NULL AND toxic IS NOT NULL").groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    order = [F.xxhash64("doc_id"), F.col("doc_id")]
    some = lab.where("toxic = 1").orderBy(*order).limit(max_docs).unionAll(lab.where("toxic = 0").orderBy(*order).limit(max_docs))
    sample = docs.select("doc_id", text_bytes().alias("text")).join(F.broadcast(some), "doc_id")  # bounded by max_docs

    def words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, "text"):
            rows = set()
            for text, toxic in zip(column(b, "text"), column(b, "toxic")):
                own = [b"", *map(normal, text.split()), b""]
                rows.update((w, xxhash.xxh3_64_intdigest(v + b" " + x) >> 1, int(toxic)) for v, w, x in zip(own, own[1:], own[2:]))
            cols = list(zip(*rows)) or [(), (), ()]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, (pa.binary(), pa.int64(), pa.int64()))], names=["word", "near", "toxic"])

    size = {r["toxic"]: r["n"] for r in some.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    if not size.get(1):
        return Field({}, [0.0] * 4, -60.0, -60.0, [[0.0, 0.0], [0.0, 0.0]])
    counts = sample.select("text", F.col("toxic").cast("long").alias("toxic")).mapInArrow(words, "word binary, near bigint, toxic bigint")
    # A word counts once for each pair of neighbours, so copies of one document don't make its words look toxic.
    counts = counts.groupBy("word", "near").agg(F.max("toxic").alias("toxic")).groupBy("word").agg(F.sum("toxic").alias("t"), F.count("*").alias("n"))
    whole = counts.agg(F.sum("t").alias("t"), F.sum("n").alias("n")).first()
    share = (whole["t"] or 0) / max(1, whole["n"] or 0)
    rate = (F.col("t") + 0.5) / (F.col("n") - F.col("t") + 0.5) * ((1 - share) / max(share, 1e-9))
    # Log-likelihood ratio of the word's places against the labels' shares: chance words of small samples stay out.
    t, o = F.col("t"), F.col("n") - F.col("t")
    g2 = 2 * (t * F.log(t / F.col("n") / share) + F.when(o > 0, o * F.log(o / F.col("n") / max(1 - share, 1e-9))).otherwise(0.0))
    tagged = {bytes(r["word"]) for r in counts.where((t >= least) & (g2 >= surprise) & (rate >= ratio) & (F.length("word") > 1)).orderBy(rate.desc(), F.col("t").desc(), "word").limit(most_tagged).select("word").collect()}

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, "text"):
            out_w, out_t = [], []
            for text, toxic in zip(column(b, "text"), column(b, "toxic")):
                w = text.split()
                tags = [int(toxic == 1 and normal(x) in tagged) for x in w]
                hits = [i for i, x in enumerate(tags) if x]
                for i, j in zip(hits, hits[1:]):
                    if j == i + 2:
                        tags[i + 1] = 1
                step = max(1, len(hits) // PER_DOC)
                starts = [max(0, i - SEGMENT // 2) for i in hits[::step]][:PER_DOC] if hits else [] if toxic else [len(w) * i // PER_DOC for i in range(PER_DOC)]
                for lo in sorted(set(starts)):
                    if w[lo : lo + SEGMENT]:
                        out_w.append(w[lo : lo + SEGMENT])
                        out_t.append(tags[lo : lo + SEGMENT])
            yield pa.RecordBatch.from_arrays([pa.array(out_w, pa.list_(pa.binary())), pa.array(out_t, pa.list_(pa.int32()))], names=["words", "tags"])

    # At most 2 * max_docs * PER_DOC segments.
    rows = sample.select("text", F.col("toxic").cast("long").alias("toxic")).mapInArrow(cut, "words array<binary>, tags array<int>").collect()
    segments = sorted(([bytes(w) for w in r["words"]], list(r["tags"])) for r in rows)
    return train(segments, most_words=most_words)


def tag(docs: DataFrame, field: Field, spans: bool = True) -> DataFrame:
    """doc_id, score and the toxic spans (code point offsets, text, probability) of every whole text."""
    sent = docs.sparkSession.sparkContext.broadcast((field.words, field.shapes, field.bias, field.start, field.trans))  # bounded vocabulary
    word_re = re.compile(rb"[^\x20\x09-\x0D]+")
    kind = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64()), ("text", pa.string()), ("probability", pa.float64())]))

    small_batches(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        f = Field(*sent.value)

        class Known(dict):
            def __missing__(self, w: bytes) -> float:
                if len(self) > 300_000:
                    self.clear()
                x = self[w] = f.emission(w)
                return x

        known = Known()
        for b in slices(batches, "text", 6_000_000):
            texts = column(b, "text")
            parts, sizes = [], []
            for t in texts:
                e = list(map(known.__getitem__, t.split()))
                parts.append(np.array(e, float))
                sizes.append(len(e))
            sizes = np.array(sizes, np.int64)
            p = f.marginals(np.concatenate(parts) if parts else np.zeros(0), sizes)
            ends = np.cumsum(sizes)
            scores, found = [], []
            for text, end, n in zip(texts, ends.tolist(), sizes.tolist()):
                own = p[end - n : end]
                scores.append(float(own.max()) if n else 0.0)
                got = []
                hits = np.flatnonzero(own >= 0.5) if n and spans else ()
                if len(hits):
                    places = [m.span() for m in word_re.finditer(text)]
                    at, chars = 0, 0  # bytes and code points so far
                    runs = np.split(hits, np.flatnonzero(np.diff(hits) > 1) + 1)
                    for r in runs:
                        lo, hi = places[r[0]][0], places[r[-1]][1]
                        chars += len(text[at:lo].decode("utf-8", "replace"))
                        at, start = lo, chars
                        said = text[lo:hi].decode("utf-8", "replace")
                        got.append({"start": start, "end": start + len(said), "text": said, "probability": float(own[r].max())})
                found.append(got)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(scores, pa.float64()), pa.array(found, kind)], names=["doc_id", "score", "spans"])

    return docs.select("doc_id", text_bytes().alias("text")).mapInArrow(run, "doc_id bigint, score double, spans array<struct<start:bigint,end:bigint,text:string,probability:double>>")


def toxicity(docs: DataFrame, labels: DataFrame, **bounds: int) -> DataFrame:
    """Learn from rows whose crc32(doc_id) mod 5 is not 0; score all."""
    field = fit(docs, labels.where(crc_mod("doc_id", 5) != 0), **bounds)
    return tag(docs, field).select("doc_id", (crc_mod("doc_id", 5) == 0).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"), F.size("spans").cast("long").alias("n_spans"), "spans")
