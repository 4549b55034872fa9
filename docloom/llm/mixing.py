"""Mixing sources to target weights by Pfair scheduling.

Rows of a source form blocks of ``block_rows``. Block j (from 1) of a source with
weight w is released at slot floor((j-1)/w) and due by slot ceil(j/w); at each slot
the released block with the earliest deadline runs. Weights are taken exactly, as
whole numbers over their sum, so no source is ever a whole block ahead of or behind
its target weight, however long the run and however many the sources. When a source
runs out, the others' weights are scaled up and a new phase starts, so every row is
placed. Sources of weight 0 come after all others, in equal parts.

Per-source counts reach the driver. It walks the schedule once and keeps the state at
the start of each range of slots; tasks walk the ranges again, each on its own, and
give out the places of the blocks. The driver's walk is the part that grows with the
number of blocks.

Defined results: a null source is a source of its own; repeated rows each get a
place; an empty table gives an empty table; other columns pass through.
"""

from __future__ import annotations

import pickle
from collections.abc import Callable, Iterator
from fractions import Fraction
from heapq import heapify, heappop, heappush
from math import lcm

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from docloom.llm.common import column, every, fresh


def whole(weights: list) -> list[int]:
    """Whole numbers in exact proportion to the weights."""
    exact = [Fraction(w) for w in weights]
    if any(w < 0 for w in exact):
        raise ValueError("a target weight is negative")
    d = lcm(*[w.denominator for w in exact])
    return [w.numerator * (d // w.denominator) for w in exact]


class Schedule:
    """The slots of all sources, from any state on.

    In a phase's first slots every source waits with its block 1, in the order of
    weights; ``own`` holds the blocks of those that ran in this phase.
    """

    def __init__(self, blocks: list[int], weight: list[int], state: tuple | None = None) -> None:
        self.blocks = blocks
        self.placed, self.own, self.phase, self.t = state or ([0] * len(blocks), {}, 0, 0)
        live = [k for k in range(len(blocks)) if self.placed[k] < blocks[k]]
        self.weight = list(weight)
        self.total = sum(weight[k] for k in live)
        if not self.total:
            self._equal(live)
        self.order = sorted(live, key=lambda k: (-self.weight[k], k))
        # Links between the live sources in this order; the last place is the ring's head.
        n = self.head = len(self.order)
        self.after, self.before = [*range(1, n + 1), 0], [n, *range(n)]
        self.at = {k: i for i, k in enumerate(self.order)}
        self.fresh = self.after[n]
        self.waiting = [(c * self.total // self.weight[k], k, c + 1) for k, c in self.own.items() if k in self.at]
        heapify(self.waiting)
        self.ready: list[tuple] = []

    def _equal(self, live: list[int]) -> None:
        for k in live:
            self.weight[k] = 1
        self.total = len(live)

    def state(self) -> tuple:
        return list(self.placed), dict(self.own), self.phase, self.t

    def run(self, slots: int) -> Iterator[tuple[int, int, int]]:
        """(source, block, phase) of up to so many next slots."""
        w, order, after, before, own, placed = self.weight, self.order, self.after, self.before, self.own, self.placed
        for _ in range(slots):
            if after[self.head] == self.head:
                return
            t, total = self.t, self.total
            while self.waiting and self.waiting[0][0] <= t:
                _, k, j = heappop(self.waiting)
                heappush(self.ready, (-(-j * total // w[k]), -w[k], k, j))
            while self.fresh != self.head and order[self.fresh] in own:
                self.fresh = after[self.fresh]
            first = None
            if self.fresh != self.head and w[k := order[self.fresh]]:
                first = (-(-total // w[k]), -w[k], k, 1)
            if first and (not self.ready or first < self.ready[0]):
                self.fresh = after[self.fresh]
            else:
                first = heappop(self.ready)
            _, _, k, j = first
            yield k, placed[k], self.phase
            placed[k] += 1
            own[k] = j
            self.t += 1
            if placed[k] < self.blocks[k]:
                heappush(self.waiting, (j * total // w[k], k, j + 1))
                continue
            i = self.at[k]
            after[before[i]], before[after[i]] = after[i], before[i]
            self.total -= w[k]
            if not self.total:
                self._equal([x for x in order if placed[x] < self.blocks[x]])
            self.phase += 1
            self.t = 0
            own.clear()
            self.waiting.clear()
            self.ready.clear()
            self.fresh = after[self.head]


def ranges(blocks: list[int], weight: list[int], length: int) -> Iterator[tuple[int, tuple]]:
    """(first slot, state) of each range of ``length`` slots."""
    s, n = Schedule(blocks, weight), sum(blocks)
    for start in range(0, n, length):
        yield start, s.state()
        for _ in s.run(length):
            pass


def phases(blocks: dict, weight: dict, length: int) -> list[tuple]:
    """Rows (phase, source, first block, blocks, first slot, blocks, slots of the phase, slots), walked in ranges of ``length`` slots.

    A phase lasts until the first of its sources has no block left.
    """
    names = sorted(blocks, key=str)
    b, w = [blocks[k] for k in names], whole([weight[k] for k in names])
    starts: dict[int, int] = {}
    found: dict[tuple[int, int], list[tuple[int, int]]] = {}
    for start, state in ranges(b, w, length):
        for slot, (k, block, phase) in enumerate(Schedule(b, w, state).run(length), start):
            starts.setdefault(phase, slot)
            found.setdefault((phase, k), []).append((block, slot))
    ends = {p: starts.get(p + 1, sum(b)) for p in starts}
    return [(p, names[k], at[0][0], len(at), starts[p], len(at), ends[p] - starts[p], [s - starts[p] for _, s in at]) for (p, k), at in found.items()]


def root_weights(counts: dict) -> dict:
    """Target weights in proportion to the square root of each source's rows."""
    return {k: n**0.5 for k, n in counts.items()}


def block_places(spark: SparkSession, blocks: list[int], weight: list[int], length: int) -> DataFrame:
    """(_k, _block, _phase, _slot) of every block; each range of ``length`` slots is walked by a task of its own."""
    sent = spark.sparkContext.broadcast((blocks, weight))
    starts = [(start, pickle.dumps(state)) for start, state in ranges(blocks, weight, length)]

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for start, state in zip(column(b, "start"), column(b, "state")):
                got = list(zip(*Schedule(*sent.value, pickle.loads(state)).run(length)))
                yield pa.RecordBatch.from_arrays([pa.array(got[0], pa.int32()), pa.array(got[1], pa.int64()), pa.array(got[2], pa.int32()), pa.array(range(start, start + len(got[0])), pa.int64())], names=["_k", "_block", "_phase", "_slot"])

    return spark.createDataFrame(starts, "start long, state binary").repartition(max(1, len(starts))).mapInArrow(walk, "_k int, _block long, _phase int, _slot long")


def mix_sources(docs: DataFrame, target: Callable[[dict], dict] = root_weights, block_rows: int = 8, range_slots: int = 16_384) -> DataFrame:
    """``docs`` with a last column ``_mix`` (block, phase, slot, offset; another name if that one is taken); order by slot, offset to read the mix.

    Ranks within a source are counted per (source, hash bucket) and shifted by bucket
    totals, so that a source with a third of all rows is spread over many tasks. The
    places of a bucket's blocks come to it as one list.
    """
    spark = docs.sparkSession
    text = [F.col(c) for c in docs.columns if c.lower() == "text"]
    # The row travels as one column, so none of its names can clash.
    rows = docs.select(F.struct(*every(docs.columns)).alias("_row"), "source", "doc_id", F.xxhash64("doc_id", *text).alias("_h"))
    parts = max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))
    rows = rows.withColumn("_b", F.pmod(F.shiftright("_h", 32), F.lit(4 * parts)).cast("int"))
    sums = rows.groupBy("source", "_b").agg(F.count("*").alias("n"))
    counts = {r["source"]: r["n"] for r in sums.groupBy("source").agg(F.sum("n").alias("n")).collect()}
    names, weights = sorted(counts, key=lambda k: (str(k), k is None)), target(counts)
    places = block_places(spark, [-(-counts[k] // block_rows) for k in names], whole([weights[k] for k in names]), max(range_slots, 4 * len(names)))
    kind = docs.schema["source"].dataType.simpleString()
    ids = F.broadcast(spark.createDataFrame([(k, i) for i, k in enumerate(names)], f"_src {kind}, _k int"))
    buckets = sums.join(ids, F.col("source").eqNullSafe(F.col("_src"))).select("_k", "_b", "n")
    buckets = buckets.withColumn("_before", F.coalesce(F.sum("n").over(Window.partitionBy("_k").orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    block = F.explode(F.sequence(F.floor(F.col("_before") / block_rows), F.floor((F.col("_before") + F.col("n") - 1) / block_rows))).alias("_block")
    lists = buckets.select("_k", "_b", "_before", block).join(places, ["_k", "_block"]).groupBy("_k", "_b", "_before").agg(F.array_sort(F.collect_list(F.struct("_block", "_phase", "_slot"))).alias("_places"))
    ranked = rows.join(ids, rows["source"].eqNullSafe(F.col("_src"))).drop("_src")
    ranked = ranked.withColumn("_r", F.row_number().over(Window.partitionBy("_k", "_b").orderBy("_h", "doc_id"))).join(lists, ["_k", "_b"])
    ranked = ranked.withColumn("_rank", F.col("_before") + F.col("_r") - 1)
    ranked = ranked.withColumn("_block", F.floor(F.col("_rank") / block_rows)).withColumn("_offset", (F.col("_rank") % block_rows).cast("int"))
    place = F.get("_places", (F.col("_block") - F.floor(F.col("_before") / block_rows)).cast("int"))
    mixed = F.struct(F.col("_block").alias("block"), place["_phase"].alias("phase"), place["_slot"].alias("slot"), F.col("_offset").alias("offset"))
    return ranked.withColumn("_mix", mixed).select("_row.*", F.col("_mix").alias(fresh("_mix", docs.columns)))


def mix_report(docs: DataFrame) -> DataFrame:
    """doc_id, source, block, phase, slot and offset of every row."""
    return mix_sources(docs.select("doc_id", "source")).select("doc_id", "source", "_mix.block", "_mix.phase", "_mix.slot", "_mix.offset")


def in_order(mixed: DataFrame) -> DataFrame:
    """The rows of ``mix_sources`` laid out in the order of the mix, without the last column, which held it."""
    parts = int(mixed.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    *cols, mix = mixed.columns
    return mixed.repartitionByRange(parts, f"{mix}.slot", f"{mix}.offset").sortWithinPartitions(f"{mix}.slot", f"{mix}.offset").select(*every(cols))
