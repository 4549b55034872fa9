"""N-gram Jaccard join, size-aware: subsets for light sets, inverted lists for heavy ones.

A document's set holds its distinct shingles. Sets of at most ``x`` elements are
light. Two light sets that link share a subset of ceil(t * larger size) elements, so
each light set lists its subsets of those fixed sizes. A set that links with a heavy
one shares an element of the rarest-first prefix of size n - ceil(t*n) + 1, so heavy
sets, and light ones large enough to link with them, enter the inverted lists of
those elements. ``x`` is where the cost of subsets and of scanned lists is least,
from the histogram of set sizes.

"Rarest first" rests on counts over all texts: the lists that a first tally finds long
hold common shingles, and those come last in the order. Lists that only one text is on
are known from a second tally, so only members of shared lists are written out, with
their texts.

Equal sets count once. Within a list, members first meet the list's head, the member
with the fewest elements before the list's own; links found are closed into components;
then lists that still hold several components have the members of different components
meet. No link is lost: members of one component need no more.

Three exact bounds spare comparisons. Elements before the first shared one, in the order
of all texts, are not shared, so positions in a list bound the intersection; a link
needs a number of lists in common that follows from both sizes; and a sketch holds, for
each of 512 classes of elements, whether a set has an odd number of them, so classes
where two sketches differ bound the elements that only one of two sets has. Pairs that
pass are verified on whole texts.

Links are counted within components, where all of them are: members of a component are
dealt to blocks, and each pair of blocks is compared on whole texts in one go.

Defined results: texts without words have no component but their own; ties and
repeated rows fall together; a null doc_id is a row of its own outside every link.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations
from math import ceil, comb

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docloom.llm.common import Sieve, SortedTable, arrow, bucket_bits, column, every, materialise, mix, shared_path, slices, small_batches, text_bytes, word_hashes

SHINGLE, PERCENT = 4, 85
_A, _B = np.uint64(0xD6E8FEB86659FD93), np.uint64(0xA0761D6478BD642F)
_S32 = np.uint64(31)
MOST_LIGHT = 16
#: Elements of sets that a worker keeps while it verifies pairs.
KEPT = 2_000_000
#: Sets of a block while links are counted.
BLOCK_SETS = 128
#: Longs of a sketch.
SKETCH = 8


def shingle_sets(texts: pa.Array | list[bytes], k: int = SHINGLE) -> list[np.ndarray]:
    """For each text, with A-Z in lower case: sorted hashes of its distinct k-word shingles (of all words, if fewer)."""
    h, sizes = word_hashes(texts, lower=True)
    ends = np.cumsum(sizes)
    full = h[: max(0, len(h) - k + 1)]
    for i in range(1, k):
        full = full * _A + h[i : len(h) - k + 1 + i]
    full = mix(full + np.uint64(k))
    out = []
    for n, end in zip(sizes.tolist(), ends.tolist()):
        if n >= k:
            s = np.sort(full[end - n : end - k + 1])
            out.append(s[np.append(True, s[1:] != s[:-1])])
        elif n:
            one = h[end - n : end - n + 1]
            for i in range(1, n):
                one = one * _A + h[end - n + i : end - n + i + 1]
            out.append(mix(one + np.uint64(n)))
        else:
            out.append(np.zeros(0, np.uint64))
    return out


def shingles(text: bytes, k: int = SHINGLE) -> np.ndarray:
    return shingle_sets([text], k)[0]


def set_id(s: np.ndarray) -> tuple[int, int]:
    """Two 64-bit hashes of a set."""
    a, b = np.add.reduce(s, dtype=np.uint64), np.add.reduce(s * (s >> _S32), dtype=np.uint64)
    two = mix(np.array([a, b], np.uint64)).view(np.int64)
    return int(two[0]), int(two[1])


def sketch(s: np.ndarray) -> list[int]:
    """For each class of elements, whether the set has an odd number of them, as longs of 64 bits."""
    odd = (np.bincount((s >> _S32).astype(np.int64) & (64 * SKETCH - 1), minlength=64 * SKETCH) & 1).astype(np.uint8)
    return np.packbits(odd).view(np.int64).tolist()


def alike(n: str, sk: str, on: str, osk: str, percent: int) -> str:
    """SQL: no more classes differ between two sketches than elements may between sets of a link."""
    differ = " + ".join(f"bit_count({sk}[{i}] ^ {osk}[{i}])" for i in range(SKETCH))
    return f"{differ} <= {n} + {on} - 2 * ceil({percent} * ({n} + {on}) / {100 + percent}.0)"


def least_overlap(n: int, percent: int) -> int:
    """ceil(t * n) in whole numbers."""
    return -(-percent * n // 100)


def subset_sizes(n: int, percent: int) -> list[tuple[int, int]]:
    """(m, c): with a set of m >= n elements, a link means c shared elements."""
    return [(m, c) for m in range(n, 100 * n // percent + 1) if (c := least_overlap(m, percent)) <= n]


def prefix_size(n: int, percent: int) -> int:
    return n - least_overlap(n, percent) + 1


def boundary(sizes: dict[int, int], percent: int = PERCENT, scan: float = 3.0) -> int:
    """The x of least cost: subset rows of sets up to x, plus ``scan`` for each list entry of the others."""
    best, pick = float("inf"), 0
    for x in range(MOST_LIGHT + 1):
        low = least_overlap(x + 1, percent)
        cost = 0.0
        for n, count in sizes.items():
            if n <= x:
                cost += count * sum(comb(n, c) for _, c in subset_sizes(n, percent))
            if n >= low or n > x:
                cost += count * scan * prefix_size(n, percent)
        if cost < best:
            best, pick = cost, x
    return pick


def prefix(key: np.ndarray, common: np.ndarray, percent: int) -> np.ndarray:
    """The first elements of a set in the order of all texts, common ones last."""
    n = len(key)
    p = prefix_size(n, percent) if n else 0
    order = (key >> np.uint64(1)) | (common.astype(np.uint64) << np.uint64(63))
    first = np.argpartition(order, p - 1)[:p] if p < n else np.arange(n)
    return key[first[np.argsort(order[first])]]


def element_keys(s: np.ndarray) -> np.ndarray:
    return mix(s + _A)


def keys(s: np.ndarray, own: np.ndarray, common: np.ndarray, x: int, percent: int) -> tuple[np.ndarray, np.ndarray]:
    """The lists that a set enters and its place on them: elements before the list's own, 0 on a subset's list.

    own: its elements' keys; common: marks of the very common ones.
    """
    n = len(s)
    out = []
    if 0 < n <= x:
        m = mix(s ^ _B)
        for size, c in subset_sizes(n, percent):
            sums = np.array([np.add.reduce(m[list(p)], dtype=np.uint64) for p in combinations(range(n), c)], np.uint64)
            out.append(mix(sums + np.uint64(size * int(_A) % 2**64)))
    subsets = sum(map(len, out))
    if n > x or n >= max(1, least_overlap(x + 1, percent)):
        out.append(prefix(own, common, percent))
    lists = np.concatenate(out) if out else np.zeros(0, np.uint64)
    return lists, np.maximum(np.arange(len(lists)) - subsets, 0)


_BLOBS = "bucket int, ks binary, cs binary"


def blobs(found: list[np.ndarray], bits: int) -> Iterator[tuple[int, bytes, bytes]]:
    """The distinct keys of a slice and their counts, one row per bucket."""
    k, c = np.unique(np.concatenate(found), return_counts=True) if found else (np.zeros(0, np.uint64), np.zeros(0, np.int64))
    top = (k >> np.uint64(64 - bits)).astype(np.int64) if bits else np.zeros(len(k), np.int64)
    cuts = np.flatnonzero(np.diff(top)) + 1
    edges = [0, *cuts.tolist(), len(k)] if len(k) else []
    for lo, hi in zip(edges, edges[1:]):
        yield int(top[lo]), k[lo:hi].tobytes(), c[lo:hi].astype(np.uint32).tobytes()


def tally(rows: DataFrame, root: str, least: int) -> None:
    """Sum blobs per bucket; keys counted ``least`` times or more go to a table of sorted hashes in the shared folder."""

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        got: dict[int, list] = {}
        for b in batches:
            for k, x, y in zip(column(b, "bucket"), column(b, "ks"), column(b, "cs")):
                got.setdefault(k, []).append((np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint32)))
        for k in list(got):
            h, c = (np.concatenate(z) for z in zip(*got.pop(k)))
            order = np.argsort(h)
            h, c = h[order], c[order].astype(np.int64)
            at = np.flatnonzero(np.append(True, h[1:] != h[:-1]))
            total = np.add.reduceat(c, at)
            keep = total >= least
            SortedTable.write(root, k, h[at][keep], [np.minimum(total[keep], 2**32 - 1).astype(np.uint32)])
        yield pa.RecordBatch.from_arrays([pa.array([1], pa.int64())], names=["n"])

    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows.repartition(parts, "bucket").mapInArrow(merge, "n bigint").agg(F.sum("n")).collect()  # one number


def each(test, per_text: list[np.ndarray]) -> list[np.ndarray]:
    """Apply a test to arrays of keys in one go."""
    if not per_text:
        return []
    return np.split(test(np.concatenate(per_text)), np.cumsum([len(x) for x in per_text])[:-1])


def components(edges: DataFrame) -> DataFrame:
    """(node, component): the smallest node of each connected part, for nodes with an edge.

    Alternating large-star and small-star steps; each step only takes minima per node.
    """
    e = materialise(edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).where("u <> v").distinct(), "edges")
    while True:
        both = e.unionAll(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
        large = both.where("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").unionAll(least.select("u", F.col("m").alias("v"))).distinct()
        e = materialise(small, "edges")
        # Done when every node points at one root and no root points on.
        tops = e.groupBy("u").agg(F.count("*").alias("n"), F.lit(1).alias("src")).where("n > 1").select("u")
        if tops.isEmpty() and e.join(e.select(F.col("u").alias("w")), F.col("v") == F.col("w"), "left_semi").isEmpty():
            break
    return e.groupBy("u").agg(F.min("v").alias("component")).select(F.col("u").alias("node"), "component").unionAll(e.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())


def id_table(ids: DataFrame, col: str) -> str:
    """The hashes of ids (one to one for longs), sorted, in a folder of the shared one: tasks filter what they read by it."""
    spark = ids.sparkSession
    bits, root = bucket_bits(spark), shared_path(spark, "ids")

    def lay(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        got: dict[int, list[int]] = {}
        for b in batches:
            for k, h in zip(column(b, "bucket"), column(b, "h")):
                got.setdefault(k, []).append(h)
        for k, hs in got.items():
            h = np.unique(np.array(hs, np.int64).view(np.uint64))
            SortedTable.write(root, k, h, [np.ones(len(h), np.uint32)])
        yield pa.RecordBatch.from_arrays([pa.array([1], pa.int64())], names=["n"])

    h = F.xxhash64(col)
    bucket = F.shiftrightunsigned(h, 64 - bits).cast("int") if bits else F.lit(0)
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    ids.select(h.alias("h"), bucket.alias("bucket")).distinct().repartition(parts, "bucket").mapInArrow(lay, "n bigint").agg(F.sum("n")).collect()  # one number
    return root


def texts_of(wanted: DataFrame, docs: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """(i1, rep, text) of the representatives in ``wanted`` (i1, rep).

    Every task filters the documents it reads by a table of their ids: no text is
    shuffled to find these few.
    """
    bits, root = bucket_bits(docs.sparkSession), id_table(wanted, "rep")

    def pick(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        among = Sieve(SortedTable(root, bits, ["u4"]))
        for b in slices(batches, "text"):
            keep = among(b.column(1).to_numpy(zero_copy_only=False).view(np.uint64))
            b = b.filter(pa.array(keep))
            ids = [set_id(s)[0] for s in shingle_sets(arrow(b, "text"), shingle)]
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), b.column(0), b.column(2)], names=["i1", "rep", "text"])

    # Rows that repeat an id may differ in text: the set's id tells them apart.
    found = docs.select("doc", F.xxhash64("doc").alias("h"), "text").mapInArrow(pick, "i1 bigint, rep bigint, text binary")
    return materialise(found.join(wanted, ["i1", "rep"], "left_semi").dropDuplicates(["i1", "rep"]), "texts")


def verified(pairs: DataFrame, reps: DataFrame, docs: DataFrame, percent: int, shingle: int = SHINGLE) -> DataFrame:
    """Of candidate pairs (s, o: ids of sets), those that link, as edges between representative documents (u, v)."""
    ids = pairs.select(F.col("s").alias("i1")).unionAll(pairs.select(F.col("o").alias("i1"))).distinct()
    texts = texts_of(reps.join(ids, "i1").select("i1", "rep"), docs, shingle)
    left = pairs.join(texts.select(F.col("i1").alias("s"), F.col("rep").alias("u"), F.col("text").alias("a")), "s")
    joined = left.join(texts.select(F.col("i1").alias("o"), F.col("rep").alias("v"), F.col("text").alias("b")), "o").select("u", "v", "a", "b")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[int, np.ndarray] = {}
        held = 0

        def of(doc: int, t: bytes) -> np.ndarray:
            nonlocal held
            if doc not in known:
                if held > KEPT:
                    known.clear()
                    held = 0
                known[doc] = shingles(t, shingle)
                held += len(known[doc])
            return known[doc]

        for b in slices(batches, "a", 2_000_000):
            us, vs = [], []
            for u, v, s, o in zip(*(column(b, x) for x in ("u", "v", "a", "b"))):
                x, y = of(u, s), of(v, o)
                both = len(x) + len(y) - len(np.union1d(x, y))
                if 100 * both >= percent * (len(x) + len(y) - both):
                    us.append(u)
                    vs.append(v)
            yield pa.RecordBatch.from_arrays([pa.array(us, pa.int64()), pa.array(vs, pa.int64())], names=["u", "v"])

    return joined.mapInArrow(run, "u bigint, v bigint")


def linked_sizes(a: list[np.ndarray], b: list[np.ndarray], weight: list[int], percent: int) -> np.ndarray:
    """For each set of ``a``, the sum of the weights of the sets of ``b`` that link with it."""
    every = np.concatenate(b)
    values, back = np.unique(every, return_inverse=True)
    sizes, w = np.array([len(s) for s in b]), np.array(weight, np.int64)
    starts = np.cumsum(sizes) - sizes
    out = np.zeros(len(a), np.int64)
    for i, s in enumerate(a):
        mark = np.zeros(len(values), np.int64)
        at = np.minimum(np.searchsorted(values, s), len(values) - 1)
        mark[at[values[at] == s]] = 1
        both = np.add.reduceat(mark[back], starts)
        out[i] = w[100 * both >= percent * (len(s) + sizes - both)].sum()
    return out


def link_counts(classes: DataFrame, comp: DataFrame, docs: DataFrame, percent: int, shingle: int = SHINGLE) -> DataFrame:
    """(i1, rep, others): the rows of other sets that link with each set of a component. classes: i1, rep, size."""
    members = materialise(classes.join(comp, classes["rep"] == comp["node"]).select("i1", "rep", "size", F.col("component").alias("c")), "members")
    texts = texts_of(members.select("i1", "rep"), docs, shingle)
    blocks = members.groupBy("c").agg(F.ceil(F.count("*") / BLOCK_SETS).cast("int").alias("of"))
    dealt = members.join(blocks, "c").withColumn("block", F.pmod(F.xxhash64("i1", "rep"), F.col("of")).cast("int")).join(texts, ["i1", "rep"])
    dealt = dealt.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("of") - 1)))
    dealt = dealt.select("i1", "rep", "size", "c", F.least("block", "other").alias("p"), F.greatest("block", "other").alias("q"), "block", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, group = None, []

        def counts() -> pa.RecordBatch:
            sets = shingle_sets([g[3] for g in group], shingle)
            left = [i for i, g in enumerate(group) if g[4] == key[1]]
            right = [i for i, g in enumerate(group) if g[4] == key[2]]
            got = np.zeros(len(group), np.int64)
            for x, y in ((left, right), (right, left))[: 1 if key[1] == key[2] else 2]:
                if x and y:
                    got[x] += linked_sizes([sets[i] for i in x], [sets[i] for i in y], [group[i][2] for i in y], percent)
            if key[1] == key[2]:
                got -= [g[2] for g in group]  # each set links with itself
            return pa.RecordBatch.from_arrays([pa.array([g[0] for g in group], pa.int64()), pa.array([g[1] for g in group], pa.int64()), pa.array(got, pa.int64())], names=["i1", "rep", "others"])

        for b in slices(batches, "text"):
            for c, p, q, *g in zip(*(column(b, x) for x in ("c", "p", "q", "i1", "rep", "size", "text", "block"))):
                if (c, p, q) != key:
                    if group:
                        yield counts()
                    key, group = (c, p, q), []
                group.append(g)
        if group:
            yield counts()

    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    found = dealt.repartition(parts, "c", "p", "q").sortWithinPartitions("c", "p", "q").mapInArrow(run, "i1 bigint, rep bigint, others bigint")
    return materialise(found.groupBy("i1", "rep").agg(F.sum("others").alias("others")), "others")


def join(docs: DataFrame, percent: int = PERCENT, star_rounds: int = 2, long_list: int = 16, shingle: int = SHINGLE, links: bool = False) -> DataFrame:
    """doc_id, n_shingles, component_id of every row, with ``links`` also n_links: how many other rows link with it. ``shingle``: words of a shingle."""
    spark: SparkSession = docs.sparkSession
    small_batches(spark)
    bits = bucket_bits(spark)
    first_at, second_at = shared_path(spark, "first-tally"), shared_path(spark, "second-tally")
    d = docs.select(F.col("doc_id").cast("long").alias("doc"), text_bytes().alias("text"))

    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, "text"):
            rows: list[tuple] = []
            found = []
            for doc, s in zip(column(b, "doc"), shingle_sets(arrow(b, "text"), shingle)):
                p = prefix_size(len(s), percent) if len(s) else 0
                k = element_keys(s)
                found.append(np.partition(k, p - 1)[:p] if p < len(k) else k)
                rows.append((doc, *(set_id(s) if len(s) else (0, 0)), len(s), None, None, None))
            rows += [(None, None, None, None, *x) for x in blobs(found, bits)]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.binary(), pa.binary()))], names=["doc", "i1", "i2", "n", "bucket", "ks", "cs"])

    both = materialise(d.mapInArrow(sets, f"doc bigint, i1 bigint, i2 bigint, n bigint, {_BLOBS}"), "sets")
    own = both.where("bucket IS NULL").select("doc", "i1", "i2", "n")
    tally(both.where("bucket IS NOT NULL").select("bucket", "ks", "cs"), first_at, long_list)
    sizes = {r["n"]: r["c"] for r in own.groupBy(F.least("n", F.lit(4 * MOST_LIGHT)).alias("n")).agg(F.count("*").alias("c")).collect()}
    x = boundary(sizes, percent)

    def entered(texts: pa.Array, common: Sieve) -> tuple[list[np.ndarray], list[np.ndarray], list[np.ndarray]]:
        """The sets of some texts, the lists they enter and their places there."""
        s = shingle_sets(texts, shingle)
        k = [element_keys(e) for e in s]
        got = [keys(e, own, c, x, percent) for e, own, c in zip(s, k, each(common, k))]
        return s, [g[0] for g in got], [g[1] for g in got]

    known = d.where("doc IS NOT NULL")
    # Documents whose set a smaller id has too need no lists of their own.
    classes = materialise(own.where("n > 0 AND doc IS NOT NULL").groupBy("i1", "i2", "n").agg(F.min("doc").alias("rep"), F.count("*").alias("size")), "classes")
    copies_at = id_table(own.where("doc IS NOT NULL").select("doc").join(classes.select(F.col("rep").alias("doc")), "doc", "left_anti"), "doc")
    hashed = known.select("doc", F.xxhash64("doc").alias("h"), "text")

    def firsts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Slices without the copies."""
        copies = Sieve(SortedTable(copies_at, bits, ["u4"]))
        for b in slices(batches, "text"):
            yield b.filter(pa.array(~copies(b.column(1).to_numpy(zero_copy_only=False).view(np.uint64))))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        common = Sieve(SortedTable(first_at, bits, ["u4"]))
        for b in firsts(batches):
            rows = list(zip(*blobs(entered(arrow(b, "text"), common)[1], bits))) or [(), (), ()]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(rows, (pa.int32(), pa.binary(), pa.binary()))], names=["bucket", "ks", "cs"])

    tally(hashed.mapInArrow(count, _BLOBS), second_at, 2)

    def shared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        common, second = Sieve(SortedTable(first_at, bits, ["u4"])), SortedTable(second_at, bits, ["u4"])

        def twice(ks: np.ndarray) -> np.ndarray:
            k, back = np.unique(ks, return_inverse=True)
            return second.find(k)[0][back] > 1

        for b in firsts(batches):
            s, ks, places = entered(arrow(b, "text"), common)
            rows = [(doc, *set_id(e), len(e), k[c].view(np.int64), at[c], sketch(e)) for doc, e, k, at, c in zip(column(b, "doc"), s, ks, places, each(twice, ks)) if c.any()]
            cols = list(zip(*rows)) or [()] * 7
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.int64()), pa.list_(pa.int32()), pa.list_(pa.int64())))], names=["doc", "i1", "i2", "n", "ks", "places", "sk"])

    # One row for each distinct set: sets of one 64-bit id but different content stay apart by representative.
    members = hashed.mapInArrow(shared, "doc bigint, i1 bigint, i2 bigint, n bigint, ks array<bigint>, places array<int>, sk array<bigint>")
    reps = materialise(members.groupBy("i1", "i2", "n").agg(F.min("doc").alias("rep"), *[F.first(c).alias(c) for c in ("ks", "places", "sk")]), "reps")
    # Each entry knows the lists just before its own: two sets that share one of those have met there.
    entries = reps.select("i1", "n", F.expr("inline(transform(ks, (k, i) -> struct(k, places[i] AS at, slice(ks, greatest(i - 2, 1), least(i, 3)) AS back)))"))
    # Heads have the fewest elements before the list's own, relative to their size: near the middle of a group of copies.
    rank = F.expr("shiftleft(at * 1000000L div n, 43) + shiftrightunsigned(i1, 21)")
    heads = entries.groupBy("k").agg(F.min("i1").alias("low"), F.max("i1").alias("top"), *[F.min_by(c, rank).alias(h) for c, h in (("i1", "head"), ("n", "hn"), ("at", "hat"))]).where("low < top").drop("low", "top")
    lists = materialise(entries.join(heads, "k"), "lists")

    def near(n: str, at: str, on: str, oat: str) -> str:
        """What two places on a list allow to be shared suffices for a link."""
        return f"{100 + percent} * least({n} - {at}, {on} - {oat}) >= {percent} * ({n} + {on})"

    def counted(pairs: DataFrame) -> DataFrame:
        """Of pairs (s, n, o, on), those alike and on as many lists together as a link needs.

        Of a link's common elements, all but n - overlap of either prefix are on both.
        """
        p = pairs.distinct()
        p = p.join(reps.select(F.col("i1").alias("s"), "n", F.col("ks").alias("a"), F.col("sk").alias("ask")), ["s", "n"])
        p = p.join(reps.select(F.col("i1").alias("o"), F.col("n").alias("on"), F.col("ks").alias("b"), F.col("sk").alias("bsk")), ["o", "on"]).where(alike("n", "ask", "on", "bsk", percent))
        low = least_overlap(x + 1, percent)
        overlap = f"ceil({percent} * (n + on) / {100 + percent}.0)"
        need = f"CASE WHEN least(n, on) < {low} THEN 1 ELSE greatest(1, {overlap} - ceil({percent} * greatest(n, on) / 100.0) + 1) END"
        return p.where(f"size(array_intersect(a, b)) >= {need}").select("s", "o").distinct()

    pairs = materialise(counted(lists.where("i1 <> head AND " + near("n", "at", "hn", "hat")).select(F.col("i1").alias("s"), "n", F.col("head").alias("o"), F.col("hn").alias("on"))), "pairs")
    edges = materialise(verified(pairs, reps, known, percent, shingle), "links")
    for k in range(1, star_rounds + 1):
        comp = components(edges)
        label = reps.select("i1", "rep").join(comp, F.col("rep") == comp["node"], "left").groupBy("i1").agg(F.min(F.coalesce("component", "rep")).alias("c"))
        open_lists = lists.select("k", "i1", "n", "at", "back").join(label, "i1")
        several = open_lists.groupBy("k").agg(F.min("c").alias("c0"), F.max("c").alias("c1")).where("c0 < c1").select("k")
        left = materialise(open_lists.join(several, "k"), "open")
        if left.isEmpty():
            break
        if k < star_rounds:
            # Another head: the least by a salted hash.
            head = left.groupBy("k").agg(F.min(F.struct(F.xxhash64("i1", F.lit(k)).alias("h"), "i1", "c", "n", "at")).alias("h"))
            more = left.join(head, "k").where("c <> h.c AND " + near("n", "at", "h.n", "h.at")).select(F.col("i1").alias("s"), "n", F.col("h.i1").alias("o"), F.col("h.n").alias("on"))
        else:
            # The smaller set of a pair must allow a link with one of its own size.
            left = left.join(reps.select("i1", "n", "sk"), ["i1", "n"])
            o = left.select("k", F.col("i1").alias("o"), F.col("c").alias("oc"), F.col("n").alias("on"), F.col("at").alias("oat"), F.col("back").alias("oback"), F.col("sk").alias("osk"))
            small = left.where(near("n", "at", "n", "at"))
            more = small.join(o, "k").where("c <> oc AND (n < on OR n = on AND i1 < o) AND " + near("n", "at", "on", "oat") + " AND " + alike("n", "sk", "on", "osk", percent) + " AND NOT arrays_overlap(back, oback)").select(F.col("i1").alias("s"), "n", "o", "on")
        more = counted(more)
        more = more.join(pairs, ["s", "o"], "left_anti").join(pairs.select(F.col("s").alias("o"), F.col("o").alias("s")), ["s", "o"], "left_anti")
        more = materialise(more, "pairs")
        pairs = pairs.unionAll(more)
        edges = materialise(edges.unionAll(verified(more, reps, known, percent, shingle)), "links")
    comp = components(edges)
    of_set = classes.join(comp, classes["rep"] == comp["node"], "left").select("i1", "i2", "n", "rep", "size", F.coalesce("component", "rep").alias("c"))
    extra = []
    if links:
        of_set = of_set.join(link_counts(classes, comp, known, percent, shingle), ["i1", "rep"], "left").withColumn("links", F.col("size") - 1 + F.coalesce("others", F.lit(0)))
        extra = [F.when(F.col("doc").isNotNull(), F.coalesce("links", F.lit(0))).otherwise(0).alias("n_links")]
    out = own.join(of_set.drop("rep", "size"), ["i1", "i2", "n"], "left")
    return out.select(F.col("doc").alias("doc_id"), F.col("n").alias("n_shingles"), F.when(F.col("doc").isNotNull(), F.coalesce("c", "doc")).alias("component_id"), *extra)


def keep_one(docs: DataFrame, percent: int = PERCENT, shingle: int = SHINGLE) -> DataFrame:
    """The rows of ``docs`` whose id is the smallest of its component, and rows without an id. Rows that repeat an id stay or go together."""
    gone = join(docs, percent, shingle=shingle).where("doc_id <> component_id").select("doc_id").distinct()
    return docs.join(gone, "doc_id", "left_anti").select(*every(docs.columns))
