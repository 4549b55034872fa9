"""Documents as relations of lines, pages, segments and tables."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docloom.functions import tables
from docloom.functions import text as T
from docloom.functions.folds import batches, small_batches

_LINES = pa.list_(pa.string())
_SEGMENTS = pa.list_(pa.struct([("type", pa.string()), ("lines", _LINES)]))
_PAGES = pa.list_(pa.struct([("start", pa.string()), ("body", _LINES), ("end", pa.string())]))


def lines(df: DataFrame, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """(id, line_no, line), from 0."""
    return df.select(id_col, F.posexplode(T.split_lines(F.col(text))).alias("line_no", "line"))


def joined(df: DataFrame, id_col: str = "doc_id") -> DataFrame:
    rows = F.array_sort(F.collect_list(F.struct("line_no", "line")))
    return df.groupBy(id_col).agg(F.array_join(F.transform(rows, lambda x: x["line"]), "\n").alias("text"))


def _segments(text: str) -> list[dict]:
    return [{"type": "table" if s.table else "text", "lines": s.lines} for s in tables.segments(text.splitlines())]


def _pages(text: str) -> list[dict]:
    return [{"start": p.start, "body": p.body, "end": p.end} for p in tables.read_pages(text)[1]]


def cut_segments():
    return batches(_segments, "array<struct<type:string,lines:array<string>>>", _SEGMENTS)


def cut_pages():
    return batches(_pages, "array<struct<start:string,body:array<string>,end:string>>", _PAGES)


def segments(df: DataFrame, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """(id, seg_no, type, lines): runs of text and table lines of each document; each table is a segment of its own."""
    small_batches(df.sparkSession)
    return df.select(id_col, F.posexplode(cut_segments()(F.col(text))).alias("seg_no", "s")).select(id_col, "seg_no", "s.type", "s.lines")


def pages(df: DataFrame, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """(id, page_pos, page_no, start_marker, body, end_marker) of each page; a number that isn't whole is null."""
    small_batches(df.sparkSession)
    d = df.select(id_col, F.posexplode(cut_pages()(F.col(text))).alias("page_pos", "p"))
    number = F.regexp_extract("p.start", r"^\[\[PAGE_START\s*(\d+)\s*\]\]", 1)
    return d.select(id_col, "page_pos", number.try_cast("int").alias("page_no"), F.col("p.start").alias("start_marker"), "p.body", F.col("p.end").alias("end_marker"))
