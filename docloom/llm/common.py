"""Helpers shared by the corpus operators: reading, slicing, hashing, shared files.

Words everywhere are runs of bytes other than 0x20 and 0x09-0x0D, which is what
``bytes.split()`` yields, so texts travel to Python workers as UTF-8 bytes.
"""

from __future__ import annotations

import atexit
import tempfile
import uuid
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from docloom.functions.folds import give_back, small_batches  # noqa: F401

#: Stands for a null document id; it sorts before every other id.
NULL_ID = -(2**63)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: ``spark.checkpoint.dir``.

    Only where that is unset and driver and executors are one process (tests) a temporary folder is set.
    """
    where = spark.conf.get("spark.checkpoint.dir", None)
    if not where:
        current = spark.sparkContext._jsc.sc().getCheckpointDir()
        if current.isDefined():
            return current.get()
        if not spark.sparkContext.master.startswith("local") or "cluster" in spark.sparkContext.master:
            raise RuntimeError("set spark.checkpoint.dir to a folder that driver and executors share")
        where = "file://" + tempfile.mkdtemp(prefix="docloom-shared-")
        spark.sparkContext.setCheckpointDir(where)
        return where
    return where


def shared_path(spark: SparkSession, name: str) -> str:
    """A fresh path in the shared folder; it is removed when the driver ends."""
    path = f"{shared_dir(spark).rstrip('/')}/docloom/{name}-{uuid.uuid4().hex}"

    def at_exit() -> None:
        try:
            remove(spark, path)
        except Exception:  # the session may already be gone
            pass

    atexit.register(at_exit)
    return path


def remove(spark: SparkSession, path: str) -> None:
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)


def materialise(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: cuts lineage, survives lost executors."""
    spark = df.sparkSession
    path = shared_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def crc_mod(col: str | Column, n: int) -> Column:
    """crc32 of the id's decimal text modulo ``n`` (a null id counts as empty text)."""
    c = F.col(col) if isinstance(col, str) else col
    return F.crc32(F.coalesce(c.cast("string"), F.lit("")).cast("binary")) % n


def text_bytes(col: str = "text") -> Column:
    """The text as UTF-8 bytes; null gives empty bytes."""
    return F.coalesce(F.col(col), F.lit("")).cast("binary")


def slices(batches: Iterable[pa.RecordBatch], col: str, limit: int = 4_000_000) -> Iterator[pa.RecordBatch]:
    """Cut Arrow batches so that each piece holds about ``limit`` bytes of ``col`` or one row; at the end memory goes back to the system."""
    for b in batches:
        if not b.num_rows:
            continue
        size = pc.fill_null(pc.binary_length(b.column(b.schema.get_field_index(col))), 0).to_numpy(zero_copy_only=False)
        part = np.cumsum(size, dtype=np.int64) // limit
        cuts = np.flatnonzero(np.diff(part)) + 1
        edges = [0, *cuts.tolist(), b.num_rows]
        for lo, hi in zip(edges, edges[1:]):
            yield b.slice(lo, hi - lo)
    give_back()


def fresh(name: str, *taken: Iterable[str]) -> str:
    """``name``, with underscores added until no column has it (names are compared without case, as Spark does)."""
    used = {c.lower() for cols in taken for c in cols}
    while name.lower() in used:
        name += "_"
    return name


def every(names: Iterable[str]) -> list[Column]:
    """Columns by their exact names, dots and all."""
    return [F.col("`" + c.replace("`", "``") + "`") for c in names]


def column(b: pa.RecordBatch, name: str) -> list:
    return b.column(b.schema.get_field_index(name)).to_pylist()


class Hashes(dict):
    """word bytes -> 64-bit hash; forgets everything when it grows past ``most``."""

    def __init__(self, most: int = 400_000) -> None:
        super().__init__()
        self.most = most

    def __missing__(self, word: bytes) -> int:
        if len(self) >= self.most:
            self.clear()
        h = self[word] = xxhash.xxh3_64_intdigest(word)
        return h

    def array(self, words: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), np.uint64, len(words))


def arrow(b: pa.RecordBatch, name: str) -> pa.Array:
    return b.column(b.schema.get_field_index(name))


_M1, _M2 = np.uint64(0xFF51AFD7ED558CCD), np.uint64(0xC4CEB9FE1A85EC53)
_S = np.uint64(33)


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser; spreads every input bit over the whole word."""
    x = x ^ (x >> _S)
    x = x * _M1
    x ^= x >> _S
    x *= _M2
    x ^= x >> _S
    return x


_SPACE = np.zeros(256, bool)
_SPACE[[32, 9, 10, 11, 12, 13]] = True
_SMALL = np.arange(256, dtype=np.uint8)
_SMALL[65:91] += 32
#: Of a word's last eight bytes, those that are its own.
_OWN = np.array([256**k - 1 for k in range(9)], np.uint64)
_C1, _C2 = np.uint64(0x8CB92BA72F3D8DD7), np.uint64(0xD1342543DE82EF95)


def range_hashes(data: np.ndarray, starts: np.ndarray, size: np.ndarray) -> np.ndarray:
    """64-bit hashes of ranges of bytes; ``data`` ends with eight bytes that are in no range."""
    eight = np.ndarray((len(data) - 7,), "<u8", data.data, strides=(1,))
    h = mix((eight[starts] & _OWN[np.minimum(size, 8)]) * _C1 + size.astype(np.uint64))
    for k in range(8, 64, 8):
        at = np.flatnonzero(size > k)
        if not len(at):
            break
        h[at] = mix(h[at] * _C2 + (eight[starts[at] + k] & _OWN[np.minimum(size[at] - k, 8)]))
    for i in np.flatnonzero(size > 64).tolist():
        h[i] = xxhash.xxh3_64_intdigest(data[starts[i] : starts[i] + size[i]].data)
    return h


def gather(data: np.ndarray, starts: np.ndarray, size: np.ndarray) -> np.ndarray:
    """The ranges of ``data``, one after another."""
    ends = np.cumsum(size)
    return data[np.repeat(starts - (ends - size), size) + np.arange(ends[-1] if len(ends) else 0)]


def word_hashes(texts: pa.Array | list[bytes], lower: bool = False) -> tuple[np.ndarray, np.ndarray]:
    """(64-bit hashes of all words, words of each text); ``lower``: A-Z count as a-z.

    Works on the bytes of all texts at once.
    """
    if isinstance(texts, list):
        texts = pa.array(texts, pa.binary())
    wide = pa.types.is_large_binary(texts.type) or pa.types.is_large_string(texts.type)
    _, offsets, raw = texts.buffers()
    if raw is None or not len(texts):
        return np.zeros(0, np.uint64), np.zeros(len(texts), np.int64)
    off = np.frombuffer(offsets, np.int64 if wide else np.int32)[texts.offset : texts.offset + len(texts) + 1].astype(np.int64)
    own = np.frombuffer(raw, np.uint8)[off[0] : off[-1]]
    off -= off[0]
    n = len(own)
    if not n:
        return np.zeros(0, np.uint64), np.zeros(len(texts), np.int64)
    data = np.zeros(n + 8, np.uint8)
    data[:n] = _SMALL[own] if lower else own
    ink = ~_SPACE[own]
    edge = ink.copy()
    edge[1:] &= ~ink[:-1]
    at = off[:-1][off[:-1] < n]
    edge[at] = ink[at]
    starts = np.flatnonzero(edge)
    edge = ink
    edge[:-1] &= _SPACE[own[1:]]
    at = off[1:][off[1:] > 0] - 1
    edge[at] = ~_SPACE[own[at]]
    size = np.flatnonzero(edge) + 1 - starts
    return range_hashes(data, starts, size), np.diff(np.searchsorted(starts, off))


def split_words(texts: pa.Array | list[bytes], lower: bool = False) -> list[np.ndarray]:
    """The hashes of each text's words."""
    h, n = word_hashes(texts, lower)
    ends = np.cumsum(n).tolist()
    return [h[lo:hi] for lo, hi in zip([0, *ends], ends)]


#: Odd, so invertible modulo 2**64: windows of a running sum can be brought to one scale.
_BASE = 0x9E3779B97F4A7C15
_POW = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_POW[0]) < n:
        size = max(n, 2 * len(_POW[0]), 4096)
        for k, base in enumerate((_BASE, pow(_BASE, -1, 2**64))):
            p = np.full(size, base, np.uint64)
            p[0] = 1
            _POW[k] = np.multiply.accumulate(p)
    return _POW[0][:n], _POW[1][:n]


class Windows:
    """Hashes of any word window of one document from its word hashes, by prefix sums."""

    def __init__(self, h: np.ndarray) -> None:
        n = len(h)
        up, self.down = _powers(n + 1)
        self.sums = np.zeros(n + 1, np.uint64)
        np.cumsum(h * up[:n], out=self.sums[1:])

    def at(self, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
        """Of the windows [lo, hi)."""
        x = (self.sums[hi] - self.sums[lo]) * self.down[lo]
        return mix(x + (hi - lo).astype(np.uint64) * _M2)

    def all(self, k: int) -> np.ndarray:
        """Of every window of ``k`` words."""
        n = len(self.sums) - 1
        x = (self.sums[k:] - self.sums[: n - k + 1]) * self.down[: n - k + 1]
        return mix(x + np.uint64(k * int(_M2) % 2**64))


def signed(x: np.ndarray) -> pa.Array:
    return pa.array(x.view(np.int64))


class Store:
    """Files of the shared folder as workers see them.

    A folder that is mounted is used in place, so its files can be memory-mapped.
    Any other scheme goes through pyarrow's file systems, and a file is then held in memory.
    """

    def __init__(self, root: str) -> None:
        self.root = root.removeprefix("file://") if root.startswith("file:///") else root.removeprefix("file:")
        self.mounted = self.root.startswith("/")

    def write(self, name: str, parts: list[np.ndarray]) -> None:
        """Whole or not at all: a task that is run again replaces its own file."""
        import os

        if self.mounted:
            os.makedirs(self.root, exist_ok=True)
            temp = f"{self.root}/.{name}-{uuid.uuid4().hex}"
            with open(temp, "wb") as f:
                for p in parts:
                    f.write(np.ascontiguousarray(p).data)
            os.replace(temp, f"{self.root}/{name}")
            return
        from pyarrow import fs

        system, base = fs.FileSystem.from_uri(self.root)
        system.create_dir(base, recursive=True)
        temp = f"{base}/.{name}-{uuid.uuid4().hex}"
        with system.open_output_stream(temp) as f:
            for p in parts:
                f.write(np.ascontiguousarray(p).tobytes())
        system.move(temp, f"{base}/{name}")

    def read(self, name: str) -> np.ndarray | None:
        """The bytes of a file, memory-mapped where that can be; None if there is none."""
        import os

        if self.mounted:
            path = f"{self.root}/{name}"
            if not os.path.exists(path) or not os.path.getsize(path):
                return None
            return np.memmap(path, np.uint8, "r")
        from pyarrow import fs

        system, base = fs.FileSystem.from_uri(self.root)
        if system.get_file_info(f"{base}/{name}").type == fs.FileType.NotFound:
            return None
        with system.open_input_file(f"{base}/{name}") as f:
            return np.frombuffer(f.read(), np.uint8)


class SortedTable:
    """Hash -> values, in files by the hash's top bits: sorted hashes, then one array for each value."""

    def __init__(self, root: str, bits: int, kinds: list[str]) -> None:
        self.store, self.bits, self.kinds = Store(root), bits, [np.dtype(k) for k in kinds]
        self.width = 8 + sum(k.itemsize for k in self.kinds)
        self.open: dict[int, list[np.ndarray] | None] = {}

    @staticmethod
    def write(root: str, bucket: int, hashes: np.ndarray, values: list[np.ndarray]) -> None:
        Store(root).write(f"{bucket}", [hashes, *values])

    def part(self, bucket: int) -> list[np.ndarray] | None:
        if bucket not in self.open:
            raw = self.store.read(f"{bucket}")
            out = None
            if raw is not None:
                n, at, out = len(raw) // self.width, 0, []
                for k in [np.dtype("u8"), *self.kinds]:
                    out.append(raw[at : at + n * k.itemsize].view(k))
                    at += n * k.itemsize
            self.open[bucket] = out
        return self.open[bucket]

    def find(self, sorted_hashes: np.ndarray) -> list[np.ndarray]:
        """For ascending distinct hashes: each value, 0 where a hash is absent."""
        out = [np.zeros(len(sorted_hashes), k) for k in self.kinds]
        tops = (sorted_hashes >> np.uint64(64 - self.bits)).astype(np.int64) if self.bits else np.zeros(len(sorted_hashes), np.int64)
        cuts = np.flatnonzero(np.diff(tops)) + 1
        edges = [0, *cuts.tolist(), len(tops)] if len(tops) else []
        for lo, hi in zip(edges, edges[1:]):
            part = self.part(int(tops[lo]))
            if part is None:
                continue
            q = sorted_hashes[lo:hi]
            at = np.minimum(np.searchsorted(part[0], q), len(part[0]) - 1)
            hit = np.flatnonzero(part[0][at] == q)
            for o, v in zip(out, part[1:]):
                o[lo + hit] = v[at[hit]]
        return out


def bucket_bits(spark: SparkSession) -> int:
    """Of a number of buckets, a power of two, that is at least the shuffle's partitions."""
    return max(0, (int(spark.conf.get("spark.sql.shuffle.partitions")) - 1).bit_length())


class Sieve:
    """Membership in a SortedTable: a bitmap of 2**24 marks lets nearly all absent keys go unsearched."""

    def __init__(self, table: SortedTable) -> None:
        self.table, self.marks = table, np.zeros(2**24, bool)
        for k in range(2**table.bits):
            if (part := table.part(k)) is not None:
                self.marks[(part[0] & np.uint64(2**24 - 1)).astype(np.int64)] = True

    def __call__(self, keys: np.ndarray) -> np.ndarray:
        out = self.marks.take((keys & np.uint64(2**24 - 1)).astype(np.int64))
        hit = np.flatnonzero(out)
        if len(hit):
            k, back = np.unique(keys[hit], return_inverse=True)
            out[hit] = self.table.find(k)[0][back] > 0
        return out
