"""Helpers of functions that fold over the lines of one document, run in Arrow batches."""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, SparkSession
from pyspark.sql.functions import arrow_udf

_TABLE = re.compile(r"\[\[TABLE_START.*?(?:\[\[TABLE_END\]\][\r\n]*|\Z)", re.S)


def per_text(f: Callable[[str], str]) -> Callable[[Column], Column]:
    """A text function as a column function; null stays null."""
    return lambda t: batches(f)(t)


def batches(f: Callable[[str], object], kind: str = "string", arrow: pa.DataType = pa.string()):
    """A text function as an Arrow function; null stays null."""

    def run(a: pa.Array) -> pa.Array:
        out = [pa.array([None if x is None else f(x) for x in a.slice(lo, n).to_pylist()], arrow) for lo, n in pieces(a)]
        got = pa.concat_arrays(out) if out else pa.array([], arrow)
        give_back()
        return got

    return arrow_udf(run, kind)


def pieces(texts: pa.Array, limit: int = 1_000_000) -> Iterator[tuple[int, int]]:
    """(first row, rows) of pieces whose texts hold at most ``limit`` bytes or are one: as Python objects a whole batch would take many times its size."""
    lo = held = 0
    for i, n in enumerate(pc.fill_null(pc.binary_length(texts), 0).to_pylist()):
        if i > lo and held + n > limit:
            yield lo, i - lo
            lo, held = i, 0
        held += n
    if len(texts):
        yield lo, len(texts) - lo


def give_back() -> None:
    """Return freed memory to the system: a worker serves many tasks, and what allocators keep would add up."""
    import ctypes
    import sys

    pa.default_memory_pool().release_unused()
    if sys.platform == "linux":
        trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # absent outside glibc
        if trim:
            trim(0)


def small_batches(spark: SparkSession, size: str = "4m") -> None:
    """Bound the bytes of an Arrow batch sent to a Python worker, where the session doesn't say: rows differ in length a lot."""
    if not spark.conf.get("spark.sql.execution.arrow.maxBytesPerBatch", None):
        spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", size)


def outside_tables(text: str, f: Callable[[str], str]) -> str:
    """``f`` applied to what lies between table blocks; the line ends after a block are part of it, an unfinished one takes the rest."""
    out, at = [], 0
    for m in _TABLE.finditer(text):
        out += [f(text[at : m.start()]), m[0]]
        at = m.end()
    return "".join([*out, f(text[at:])])


def with_end(lines: list[str], like: str) -> str:
    """Lines as a text that ends with a line end if ``like`` does."""
    return "\n".join(lines) + ("\n" if like.endswith("\n") else "")


def from_end(text: str, n: int) -> str:
    """What follows the first ``n`` lines (one or more) as it is, after a newline for the end of the last of them, if it has one."""
    head = text.splitlines(keepends=True)[:n]
    return "\n" + text[sum(map(len, head)) :] if head[-1].splitlines() != head[-1:] else ""
