"""LM scoring: an interpolated modified Kneser-Ney bigram model.

Training texts are counted in Spark: each task sums the bigrams of its slices and sends
sorted hash arrays to buckets (a bucket holds all bigrams of a history; histories with
a large share of all words are split by the second word). A bucket's merged bigrams
become one file of sorted hashes and counts in the shared folder, and every word gets
an entry in a second such table: its count, the mass its history leaves to lower
orders and the number of words it follows. Workers memory-map the files, look the
distinct bigrams of a slice up in hash order, and sum log10 probabilities per text.

P(w|v) = max(c(vw) - D(c(vw)), 0) / c(v) + g(v) P1(w), with P1 the same over the
numbers of distinct histories, interpolated with 1 / (V + 1), V distinct words; an
unknown word gets the latter share, and after an unknown history P1 is used.

Words are as everywhere with A-Z in lower case; each text begins after a start mark
and ends with an end mark that is predicted. Defined results: null is the empty text,
of one token; without training texts the score is 0 per token; a null id is trained on
as an empty text's checksum says.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docloom.llm.common import SortedTable, arrow, bucket_bits, column, crc_mod, materialise, mix, shared_path, slices, small_batches, text_bytes, word_hashes

START, END = np.uint64(0x5851F42D4C957F2D), np.uint64(0x14057B7EF767814F)
_P = np.uint64(0xA24BAED4963EE407)
WORD_KINDS = ["u8", "f4", "u4"]  # count, mass left to lower orders, distinct histories
PAIR_KINDS = ["u4"]


def pair_hash(v: np.ndarray, w: np.ndarray) -> np.ndarray:
    return mix(v * _P + w)


def stream(texts: pa.Array | list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(histories, words, words per text) of the texts one after another; each ends with END."""
    h, n = word_hashes(texts, lower=True)
    n = n + 1
    ends = np.cumsum(n)
    own = np.ones(len(h) + len(n), bool)
    own[ends - 1] = False
    w = np.full(len(own), END)
    w[own] = h
    v = np.empty_like(w)
    v[1:] = w[:-1]
    v[ends - n] = START
    return v, w, n


def summed(keys: list[np.ndarray], counts: np.ndarray) -> tuple[list[np.ndarray], np.ndarray]:
    """Equal rows of keys (the last is most significant) once, with their counts added."""
    if not len(counts):
        return keys, counts
    order = np.lexsort(keys)
    keys = [k[order] for k in keys]
    new = np.ones(len(counts), bool)
    new[1:] = np.logical_or.reduce([k[1:] != k[:-1] for k in keys])
    at = np.flatnonzero(new)
    return [k[at] for k in keys], np.add.reduceat(counts[order], at)


def discounts(n: list[float]) -> list[float]:
    """D1, D2, D3+ from the numbers of things counted once to four times."""
    n1, n2, n3, n4 = n
    y = n1 / (n1 + 2 * n2) if n1 + 2 * n2 else 0.5
    d = [1 - 2 * y * n2 / n1 if n1 else y, 2 - 3 * y * n3 / n2 if n2 else 2 * y, 3 - 4 * y * n4 / n3 if n3 else 3 * y]
    return [min(max(x, 0.05), k - 0.05) for x, k in zip(d, (1, 2, 3))]


def discount(d: list[float], c: np.ndarray) -> np.ndarray:
    return np.array([0.0, *d])[np.minimum(c, 3).astype(np.int64)]


def large_histories(train: DataFrame, share: int) -> list[int]:
    """Hashes of words with at least 1/share of all words of some task and of all: at most ``share``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, kept = 0, (np.zeros(0, np.uint64), np.zeros(0, np.int64))
        for b in slices(batches, "text"):
            h, c = np.unique(word_hashes(arrow(b, "text"), lower=True)[0], return_counts=True)
            total += int(c.sum())
            (k,), c = summed([np.concatenate([kept[0], h])], np.concatenate([kept[1], c]))
            keep = c * share * 8 >= total  # lossy counting: what is dropped had too few so far
            kept = (k[keep], c[keep])
        yield pa.RecordBatch.from_arrays([pa.array(np.append(kept[0].view(np.int64), 0)), pa.array(np.append(kept[1], total)), pa.array([False] * len(kept[0]) + [True])], names=["h", "n", "all"])

    got = train.mapInArrow(run, "h bigint, n bigint, all boolean").groupBy("h", "all").agg(F.sum("n").alias("n"))
    total = got.where("all").select("n").first()
    if not total or not total["n"]:
        return []
    return [r["h"] for r in got.where(f"NOT all AND n >= {total['n'] / share}").orderBy(F.desc("n")).limit(share).select("h").collect()]


class Model:
    """Where the tables lie and what the whole corpus sums to. Small, whatever the corpus."""

    def __init__(self, pairs: str, words: str, bits: int, d2: list[float], d1: list[float], tokens: int, types: int, histories: int, left1: float) -> None:
        self.pairs, self.words, self.bits, self.d2, self.d1 = pairs, words, bits, d2, d1
        self.tokens, self.types, self.histories, self.left1 = tokens, types, histories, left1


def train_model(train: DataFrame) -> Model:
    """Count the bigrams of the column ``text`` (bytes) and lay the tables down."""
    spark = train.sparkSession
    parts, bits = int(spark.conf.get("spark.sql.shuffle.partitions")), bucket_bits(spark)
    pairs_at, words_at = shared_path(spark, "lm-pairs"), shared_path(spark, "lm-words")
    large = np.sort(np.array(large_histories(train, 8 * parts), np.int64).view(np.uint64))
    shift = np.uint64(64 - bits) if bits else None

    def top(h: np.ndarray) -> np.ndarray:
        return (h >> shift).astype(np.int64) if bits else np.zeros(len(h), np.int64)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, "text", 8_000_000):
            v, w, _ = stream(arrow(b, "text"))
            (w, v), c = summed([w, v], np.ones(len(v), np.int64))
            # The START history is as large as there are texts.
            split = np.isin(v, large) | (v == START)
            k = top(np.where(split, pair_hash(v, w), mix(v)))
            order = np.argsort(k, kind="stable")
            v, w, c, k = v[order], w[order], c[order].astype(np.uint32), k[order]
            cuts = np.concatenate([[0], np.flatnonzero(np.diff(k)) + 1, [len(k)]])
            for lo, hi in zip(cuts[:-1].tolist(), cuts[1:].tolist()):
                own = v[lo:hi]
                at = np.concatenate([[0], np.flatnonzero(own[1:] != own[:-1]) + 1])
                runs = np.diff(np.append(at, len(own))).astype(np.uint32)
                yield pa.RecordBatch.from_arrays([pa.array([int(k[lo])], pa.int32()), pa.array([own[at].tobytes()], pa.binary()), pa.array([runs.tobytes()], pa.binary()), pa.array([w[lo:hi].tobytes()], pa.binary()), pa.array([c[lo:hi].tobytes()], pa.binary())], names=["bucket", "v", "runs", "w", "c"])

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        got: dict[int, list] = {}
        for b in batches:
            for k, v, r, w, c in zip(*(column(b, x) for x in ("bucket", "v", "runs", "w", "c"))):
                got.setdefault(k, []).append((np.repeat(np.frombuffer(v, np.uint64), np.frombuffer(r, np.uint32)), np.frombuffer(w, np.uint64), np.frombuffer(c, np.uint32)))
        for k in sorted(got):
            v, w, c = (np.concatenate(x) for x in zip(*got.pop(k)))
            (w, v), c = summed([w, v], c.astype(np.int64))
            # Per history: words after it seen once, twice, more; per word: histories and occurrences.
            at = np.flatnonzero(np.append(True, v[1:] != v[:-1]))
            hist = [v[at], *(np.add.reduceat((c == i) if i < 3 else (c >= 3), at, dtype=np.int64) for i in (1, 2, 3)), np.add.reduceat(c, at)]
            (ww,), both = summed([w], np.ones(len(w), np.int64))
            (_,), occ = summed([w], c)
            zero = np.zeros(len(ww), np.int64)
            rows = [np.concatenate([hist[0], ww]), *(np.concatenate([x, zero]) for x in hist[1:]), np.concatenate([np.zeros(len(at), np.int64), both]), np.concatenate([np.zeros(len(at), np.int64), occ])]
            (h,), _ = summed([rows[0]], rows[1])
            rows = [h, *(summed([rows[0]], x)[1] for x in rows[1:])]
            often = [int((c == i).sum()) for i in (1, 2, 3, 4)]
            to = top(rows[0])
            cuts = np.concatenate([[0], np.flatnonzero(np.diff(to)) + 1, [len(to)]])
            for j, (lo, hi) in enumerate(zip(cuts[:-1].tolist(), cuts[1:].tolist())):
                cols = [pa.array([x[lo:hi].astype(np.uint32).tobytes()], pa.binary()) for x in rows[1:]]
                yield pa.RecordBatch.from_arrays([pa.array([int(to[lo])], pa.int32()), pa.array([rows[0][lo:hi].tobytes()], pa.binary()), *cols, *(pa.array([x if not j else 0], pa.int64()) for x in often)], names=["bucket", "h", "n1", "n2", "n3", "cv", "cont", "cw", "t1", "t2", "t3", "t4"])
            p = pair_hash(v, w)
            order = np.argsort(p)
            # Bucketed by history, found by pair: each file is sorted within, and named after its bucket.
            SortedTable.write(pairs_at, k, p[order], [np.minimum(c[order], 2**32 - 1).astype(np.uint32)])

    blobs = "bucket int, v binary, runs binary, w binary, c binary"
    stats = "bucket int, h binary, n1 binary, n2 binary, n3 binary, cv binary, cont binary, cw binary, t1 bigint, t2 bigint, t3 bigint, t4 bigint"
    merged = materialise(train.mapInArrow(count, blobs).repartition(parts, "bucket").mapInArrow(merge, stats), "lm-stats")
    t = merged.agg(*[F.coalesce(F.sum(f"t{i}"), F.lit(0)).alias(f"t{i}") for i in (1, 2, 3, 4)]).first()
    d2 = discounts(list(t))

    def settle(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        got: dict[int, list] = {}
        names = ("h", "n1", "n2", "n3", "cv", "cont", "cw")
        for b in batches:
            for k, *x in zip(column(b, "bucket"), *(column(b, n) for n in names)):
                got.setdefault(k, []).append([np.frombuffer(x[0], np.uint64), *(np.frombuffer(y, np.uint32) for y in x[1:])])
        for k, rows in got.items():
            h0, *cols = (np.concatenate(x) for x in zip(*rows))
            order = np.argsort(h0, kind="stable")
            h0 = h0[order]
            at = np.flatnonzero(np.append(True, h0[1:] != h0[:-1]))
            h = h0[at]
            n1, n2, n3, cv, cont, cw = (np.add.reduceat(x[order].astype(np.int64), at) for x in cols)
            left = np.where(cv > 0, (d2[0] * n1 + d2[1] * n2 + d2[2] * n3) / np.maximum(cv, 1), 0.0)
            # c(v) as a history equals the word's own count; only the start mark has none.
            SortedTable.write(words_at, k, h, [np.where(h == START, cv, cw).astype(np.uint64), left.astype(np.float32), cont.astype(np.uint32)])
            word = h != START
            yield pa.RecordBatch.from_arrays([pa.array([int(x)], pa.int64()) for x in (cw.sum(), (word & (cw > 0)).sum(), cont.sum(), *((cont == i).sum() for i in (1, 2, 3, 4)), (cont >= 3).sum())], names=["tokens", "types", "hist", "c1", "c2", "c3", "c4", "c3p"])

    s = merged.select("bucket", "h", "n1", "n2", "n3", "cv", "cont", "cw").repartition(parts, "bucket").mapInArrow(settle, "tokens bigint, types bigint, hist bigint, c1 bigint, c2 bigint, c3 bigint, c4 bigint, c3p bigint")
    s = s.agg(*[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in s.columns]).first()
    d1 = discounts([s["c1"], s["c2"], s["c3"], s["c4"]])
    left1 = (d1[0] * s["c1"] + d1[1] * s["c2"] + d1[2] * s["c3p"]) / s["hist"] if s["hist"] else 1.0
    model = Model(pairs_at, words_at, bits, d2, d1, s["tokens"], s["types"], s["hist"], left1)
    model.large = large
    return model


def score_texts(docs: DataFrame, model: Model) -> DataFrame:
    """The id, n_tokens, n_known, base_score and score of every whole text (column ``text``, bytes)."""
    m = model

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, pairs = SortedTable(m.words, m.bits, WORD_KINDS), SortedTable(m.pairs, m.bits, PAIR_KINDS)
        for b in slices(batches, "text"):
            v, w, n = stream(arrow(b, "text"))
            types, at = np.unique(np.concatenate([w, v]), return_inverse=True)
            cw, cv = at[: len(w)], at[len(w) :]
            count, left, cont = words.find(types)
            own, where = np.unique(cw * len(types) + cv, return_inverse=True)
            pv, pw = types[own % len(types)], types[own // len(types)]
            seen = find_pairs(pairs, pv, pw, m)
            c = seen[where].astype(np.int64)
            base = count.copy()
            base[types == START] = 0
            p1 = (np.maximum(cont - discount(m.d1, cont), 0) / max(1, m.histories) + m.left1 / (m.types + 1))[cw]
            hist = count[cv].astype(float)
            with np.errstate(divide="ignore", invalid="ignore"):
                p = np.where(hist > 0, np.maximum(c - discount(m.d2, c), 0) / hist + left[cv].astype(float) * p1, p1)
            ends = np.cumsum(n) - n
            bw = base[cw].astype(float)
            line = np.log10((bw + 0.5) / (m.tokens + 0.5 * (m.types + 1)))
            known = np.add.reduceat((bw > 0).astype(np.int64), ends)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(n), pa.array(known), pa.array(np.add.reduceat(line, ends)), pa.array(np.add.reduceat(np.log10(p), ends))], names=["doc_id", "n_tokens", "n_known", "base_score", "score"])

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id bigint, n_tokens bigint, n_known bigint, base_score double, score double")


def find_pairs(pairs: SortedTable, v: np.ndarray, w: np.ndarray, m: Model) -> np.ndarray:
    """Counts of bigrams: the file is chosen as in counting, the place in it by the bigram's hash."""
    p = pair_hash(v, w)
    split = np.isin(v, m.large) | (v == START)
    where = np.where(split, p, mix(v))
    top = (where >> np.uint64(64 - m.bits)).astype(np.int64) if m.bits else np.zeros(len(p), np.int64)
    order = np.lexsort([p, top])
    out = np.zeros(len(p), np.uint32)
    cuts = np.flatnonzero(np.diff(top[order])) + 1
    edges = [0, *cuts.tolist(), len(order)]
    for lo, hi in zip(edges, edges[1:]):
        part = pairs.part(int(top[order[lo]]))
        if part is None or not len(part[0]):
            continue
        q = p[order[lo:hi]]
        at = np.minimum(np.searchsorted(part[0], q), len(part[0]) - 1)
        out[order[lo:hi]] = np.where(part[0][at] == q, part[1][at], 0)
    return out


def lm_scores(docs: DataFrame) -> DataFrame:
    """Learn from rows whose crc32(doc_id) mod 5 is not 1; score all."""
    small_batches(docs.sparkSession)
    d = docs.select("doc_id", text_bytes().alias("text"))
    model = train_model(d.where(crc_mod("doc_id", 5) != 1).select("text"))
    out = score_texts(d, model)
    perplexity = F.pow(F.lit(10.0), -F.col("score") / F.col("n_tokens"))
    return out.select("doc_id", (crc_mod("doc_id", 5) == 1).alias("held_out"), "n_tokens", "n_known", F.lit(model.tokens).cast("long").alias("train_tokens"), "base_score", "score", perplexity.alias("perplexity"))
