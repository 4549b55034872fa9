"""Byte-level BPE encoding and decoding over a corpus.

The distinct pre-tokens of all texts are shuffled by hash so that each is encoded
once; their ids are laid down in the shared folder as sorted hash arrays; every text
then joins the ids of its pre-tokens back in order, by position, and decoding joins
the token-byte table.

Positions never leave the task that reads the text: rows of (document, position) for
every pre-token are a multiple of the input (README has the measured figure).

Texts are cut by the pattern, or, where it is one whose alternatives are those of
``PLAIN``, by the same rules over the classes of all characters of a slice at once.
Decoded texts are compared with the texts: where two pre-tokens share a hash, the text
is encoded word by word.

Defined results: null is the empty text, with no ids; repeated rows encode alike.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docloom.llm.common import Store, bucket_bits, column, gather, range_hashes, shared_path, slices, small_batches


# The alternatives of a common pattern, in order.
PLAIN = ["'s", "'t", "'re", "'ve", "'m", "'ll", "'d", r" ?\p{L}+", r" ?\p{N}+", r" ?[^\s\p{L}\p{N}]+", r"\s+(?!\S)", r"\s+"]
OTHER, LETTER, NUMBER, SPACE = range(4)
#: Bytes of text that a worker cuts at once.
SLICE = 2_000_000


class Encoder:
    """The ranks of a vocabulary file and the pattern that splits texts."""

    def __init__(self, path: str, pattern: str) -> None:
        with open(path, "rb") as f:
            self.ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        self.bytes_of = {v: k for k, v in self.ranks.items()}
        # White space as in Unicode's property, and no other controls.
        space = r"\x09-\x0D\x20\x85\xA0\u1680\u2000-\u200A\u2028\u2029\u202F\u205F\u3000"
        self.split = regex.compile(pattern.replace(r"[^\s", f"[^{space}").replace(r"(?!\S)", f"(?![^{space}])").replace(r"\s", f"[{space}]")).findall
        self.kinds = self._kinds(space) if pattern.split("|") == PLAIN else None
        # The decimals of each id with a comma, and its bytes, one after another.
        ids = range(max(self.bytes_of) + 1)
        self.said = self._table([b"%d," % i for i in ids])
        self.means = self._table([self.bytes_of.get(i, b"") for i in ids])

    @staticmethod
    def _kinds(space: str) -> np.ndarray:
        """The class of each code point."""
        out = np.zeros(0x110000, np.uint8)
        every = "".join(map(chr, [*range(0xD800), *range(0xE000, 0x110000)]))
        for kind, said in ((LETTER, r"\p{L}"), (NUMBER, r"\p{N}"), (SPACE, f"[{space}]")):
            out[[ord(c) for c in regex.findall(said, every)]] = kind
        return out

    @staticmethod
    def _table(parts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        size = np.array([len(p) for p in parts], np.int64)
        return np.frombuffer(b"".join(parts), np.uint8), np.cumsum(size) - size, size

    def cut(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """The bytes of all texts (and eight more), where each pre-token starts, its bytes, and the pre-tokens of each text."""
        if self.kinds is None:
            words = [self.split(t) for t in texts]
            raw = [w.encode("utf-8", "surrogatepass") for own in words for w in own]
            size = np.array([len(w) for w in raw], np.int64)
            return np.frombuffer(b"".join(raw) + bytes(8), np.uint8), np.cumsum(size) - size, size, np.array([len(w) for w in words], np.int64)
        whole = "".join(texts)
        raw = whole.encode("utf-8", "surrogatepass")
        c = np.frombuffer(whole.encode("utf-32-le", "surrogatepass"), np.uint32)
        n = len(c)
        off = np.cumsum([0, *map(len, texts)])
        first = np.zeros(n + 3, bool)
        first[off] = True
        first[n:] = True
        kind = self.kinds[c]
        new = first[:n].copy()
        new[1:] |= kind[1:] != kind[:-1]
        # The last white space before other characters stands alone, or is the space at their start.
        at = np.flatnonzero(new & (kind != SPACE) & ~first[:n])
        at = at[kind[at - 1] == SPACE]
        new[at - 1] = True
        new[at[c[at - 1] == 32]] = False
        at = np.flatnonzero(new & (c == ord("'")))
        at = at[~first[at + 1]]
        if len(at):
            a = c[at + 1]
            b = np.where(first[at + 2], 0, c[np.minimum(at + 2, n - 1)])
            short = np.isin(a, [ord(x) for x in "stmd"])
            long = (np.isin(a, [ord("r"), ord("v")]) & (b == ord("e"))) | ((a == ord("l")) & (b == ord("l")))
            new[at[short | long] + 1] = False
            ends = np.concatenate([at[short] + 2, at[long] + 3])
            ends = ends[ends < n]
            new[ends[kind[ends] == LETTER]] = True
        starts = np.flatnonzero(new)
        per = np.diff(np.searchsorted(starts, off))
        if len(raw) > n:
            width = 1 + (c > 0x7F).astype(np.int8) + (c > 0x7FF) + (c > 0xFFFF)
            starts = (np.cumsum(width, dtype=np.int64) - width)[starts]
        return np.frombuffer(raw + bytes(8), np.uint8), starts, np.diff(np.append(starts, len(raw))), per

    def encode(self, word: bytes) -> list[int]:
        """The ids of one pre-token: the pair of lowest rank merges first, the left one of equals."""
        ranks = self.ranks
        if word in ranks:
            return [ranks[word]]
        if len(word) > 200:
            return self._encode_long(word)
        parts = [word[i : i + 1] for i in range(len(word))]
        big = len(ranks) + 1
        pairs = [ranks.get(parts[i] + parts[i + 1], big) for i in range(len(parts) - 1)]
        while pairs:
            low = min(pairs)
            if low == big:
                break
            i = pairs.index(low)
            parts[i : i + 2] = [parts[i] + parts[i + 1]]
            del pairs[i]
            if i < len(pairs):
                pairs[i] = ranks.get(parts[i] + parts[i + 1], big)
            if i:
                pairs[i - 1] = ranks.get(parts[i - 1] + parts[i], big)
        return [ranks[p] for p in parts]

    def _encode_long(self, word: bytes) -> list[int]:
        """The same with a heap and a linked list, for runs without a break."""
        import heapq

        ranks, n = self.ranks, len(word)
        part: list[bytes | None] = [word[i : i + 1] for i in range(n)]
        right, left = list(range(1, n + 1)), list(range(-1, n - 1))
        heap = [(r, i, 2) for i in range(n - 1) if (r := ranks.get(word[i : i + 2])) is not None]
        heapq.heapify(heap)
        while heap:
            _, i, size = heapq.heappop(heap)
            j = right[i]
            if part[i] is None or j >= n or len(part[i]) + len(part[j]) != size:
                continue
            part[i] += part[j]
            part[j] = None
            right[i] = right[j]
            if right[i] < n:
                left[right[i]] = i
                if (r := ranks.get(part[i] + part[right[i]])) is not None:
                    heapq.heappush(heap, (r, i, len(part[i]) + len(part[right[i]])))
            k = left[i]
            if k >= 0 and (r := ranks.get(part[k] + part[i])) is not None:
                heapq.heappush(heap, (r, k, len(part[k]) + len(part[i])))
        return [ranks[p] for p in part if p is not None]

    def decode(self, ids: list[int]) -> bytes:
        return b"".join(map(self.bytes_of.__getitem__, ids))


_ENCODERS: dict[tuple[str, str], Encoder] = {}


def encoder(path: str, pattern: str) -> Encoder:
    if (path, pattern) not in _ENCODERS:
        _ENCODERS[path, pattern] = Encoder(path, pattern)
    return _ENCODERS[path, pattern]


def word_table(docs: DataFrame, path: str, pattern: str, text: str = "text", most: int = 250_000) -> tuple[str, int]:
    """Encode each distinct pre-token of all texts once, into files of the shared folder.

    A file holds: the number of words, sorted hashes (8 bytes), where each word's ids
    begin (4), then the ids (4 each). Returns the folder and the bits that choose a file.
    """
    spark = docs.sparkSession
    bits = bucket_bits(spark)
    root = shared_path(spark, "bpe-words")

    def distinct(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc, seen = encoder(path, pattern), np.zeros(0, np.uint64)
        for b in slices(batches, "t", SLICE):
            data, starts, size, _ = enc.cut([t or "" for t in column(b, "t")])
            h, at = np.unique(range_hashes(data, starts, size), return_index=True)
            if len(seen):
                new = seen[np.minimum(np.searchsorted(seen, h), len(seen) - 1)] != h
                h, at = h[new], at[new]
            seen = h if len(seen) > most else np.sort(np.concatenate([seen, h]))
            starts, size = starts[at], size[at]
            words = pa.Array.from_buffers(pa.binary(), len(h), [None, pa.py_buffer(np.append(0, np.cumsum(size)).astype(np.int32)), pa.py_buffer(gather(data, starts, size))])
            top = (h >> np.uint64(64 - bits)).astype(np.int32) if bits else np.zeros(len(h), np.int32)
            yield pa.RecordBatch.from_arrays([pa.array(top), words], names=["bucket", "word"])

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc, by = encoder(path, pattern), {}
        for b in batches:
            for k, w in zip(column(b, "bucket"), column(b, "word")):
                by.setdefault(k, set()).add(w)
        done = 0
        for k, words in by.items():
            own = sorted(words)
            size = np.array([len(w) for w in own], np.int64)
            hashes = range_hashes(np.frombuffer(b"".join(own) + bytes(8), np.uint8), np.cumsum(size) - size, size)
            got = sorted(dict(zip(hashes.tolist(), own)).items())
            ids = [enc.encode(w) for _, w in got]
            ends = np.cumsum([0, *map(len, ids)], dtype=np.uint32)
            flat = np.fromiter((i for x in ids for i in x), np.uint32, int(ends[-1]))
            Store(root).write(f"{k}", [np.array([len(got)], np.uint64), np.array([h for h, _ in got], np.uint64), ends, flat])
            done += len(got)
        yield pa.RecordBatch.from_arrays([pa.array([done], pa.int64())], names=["n"])

    words = docs.select(F.col(text).alias("t")).mapInArrow(distinct, "bucket int, word binary")
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    words.repartition(parts, "bucket").mapInArrow(encode, "n bigint").agg(F.sum("n")).collect()  # one number
    return root, bits


class WordIds:
    """Looks up the files of ``word_table``."""

    def __init__(self, root: str, bits: int) -> None:
        self.store, self.bits, self.open = Store(root), bits, {}

    def find(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """For ascending distinct hashes: the number of ids of each (0: absent), and all ids one after another."""
        count, flat = np.zeros(len(hashes), np.int64), []
        tops = (hashes >> np.uint64(64 - self.bits)).astype(np.int64) if self.bits else np.zeros(len(hashes), np.int64)
        cuts = np.flatnonzero(np.diff(tops)) + 1
        edges = [0, *cuts.tolist(), len(tops)] if len(tops) else []
        for lo, hi in zip(edges, edges[1:]):
            k = int(tops[lo])
            if k not in self.open:
                raw = self.store.read(f"{k}")
                if raw is not None:
                    n = int(raw[:8].view(np.uint64)[0])
                    a, b = 8 + 8 * n, 8 + 8 * n + 4 * (n + 1)
                    raw = (raw[8:a].view(np.uint64), raw[a:b].view(np.uint32), raw[b:].view(np.uint32))
                self.open[k] = raw
            if (part := self.open[k]) is None or not len(part[0]):
                continue
            at = np.minimum(np.searchsorted(part[0], hashes[lo:hi]), len(part[0]) - 1)
            hit = np.flatnonzero(part[0][at] == hashes[lo:hi])
            begin = part[1][at[hit]].astype(np.int64)
            size = part[1][at[hit] + 1] - begin
            count[lo + hit] = size
            flat.append(gather(part[2], begin, size))
        return count, np.concatenate(flat) if flat else np.zeros(0, np.uint32)


def joined(table: tuple[np.ndarray, np.ndarray, np.ndarray], ids: np.ndarray, count: np.ndarray) -> np.ndarray:
    """The bytes that a table has for the ids, of each run of ``count`` ids together, as an array of bytes objects."""
    data, starts, size = table
    size = size[ids]
    whole = gather(data, starts[ids], size).tobytes()
    ends = np.append(0, np.cumsum(size))[np.cumsum(count)].tolist()
    out = np.empty(len(count), object)
    out[:] = [whole[lo:hi] for lo, hi in zip([0, *ends], ends)]
    return out


def encode_documents(docs: DataFrame, path: str, pattern: str, text: str = "text", id_col: str = "doc_id", keep_ids: bool = False) -> DataFrame:
    """The id column, n_tokens, ids_sha256, decoded_sha256 (and the ids themselves) of every whole text."""
    small_batches(docs.sparkSession)
    root, bits = word_table(docs, path, pattern, text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc, table = encoder(path, pattern), WordIds(root, bits)
        for b in slices(batches, "t", SLICE):
            texts = [t or "" for t in column(b, "t")]
            data, starts, size, per = enc.cut(texts)
            words, back = np.unique(range_hashes(data, starts, size), return_inverse=True)
            count, ids = table.find(words)
            said, means = joined(enc.said, ids, count), joined(enc.means, ids, count)
            begin = np.cumsum(count) - count
            n, a, d, own = [], [], [], []
            ends = np.cumsum(per).tolist()
            for t, lo, hi in zip(texts, [0, *ends], ends):
                w = back[lo:hi]
                k, line, raw = int(count[w].sum()), b"".join(said[w].tolist())[:-1], b"".join(means[w].tolist())
                got = gather(ids, begin[w], count[w]).tolist() if keep_ids else []
                if raw != t.encode("utf-8", "surrogatepass"):
                    got = [i for x in enc.split(t) for i in enc.encode(x.encode("utf-8", "surrogatepass"))]
                    k, line, raw = len(got), b",".join([b"%d" % i for i in got]), enc.decode(got)
                n.append(k)
                a.append(hashlib.sha256(line).hexdigest())
                d.append(hashlib.sha256(raw).hexdigest())
                own.append(got if keep_ids else [])
            cols = [b.column(0), pa.array(n, pa.int64()), pa.array(a, pa.string()), pa.array(d, pa.string())] + [pa.array(own, pa.list_(pa.int32()))] * keep_ids
            yield pa.RecordBatch.from_arrays(cols, names=[id_col, "n_tokens", "ids_sha256", "decoded_sha256"] + ["ids"] * keep_ids)

    kind = docs.schema[id_col].dataType.simpleString()
    return docs.select(id_col, F.col(text).alias("t")).mapInArrow(run, f"`{id_col}` {kind}, n_tokens bigint, ids_sha256 string, decoded_sha256 string" + ", ids array<int>" * keep_ids)


def decode_ids(df: DataFrame, path: str, pattern: str, ids: str = "ids", out: str = "decoded") -> DataFrame:
    """Adds the bytes that an array of ids stands for."""
    from pyspark.sql.functions import arrow_udf

    @arrow_udf("binary")
    def decode(col: pa.Array) -> pa.Array:
        enc = encoder(path, pattern)
        return pa.array([enc.decode(x or []) for x in col.to_pylist()], pa.binary())

    return df.withColumn(out, decode(F.col(ids)))
