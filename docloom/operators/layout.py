"""Layout operators over spans, lines and table boxes."""

from __future__ import annotations

import re
from statistics import median

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from docloom.functions import text as T


def lines_in_tables(lines: DataFrame, tables: DataFrame, shrink: float = 0.25, pad: float = 1.0) -> DataFrame:
    """Lines whose centre lies in a table's padded box, its bottom drawn in by a part of a row's height (height over rows). Joins on page, then on boxes."""
    t = tables.select("path", "page_no", "table_no", *[F.col(c).alias(f"t_{c}") for c in ("x0", "y0", "x1", "y1")], "row_count")
    cx, cy = (F.col("x0") + F.col("x1")) / 2, (F.col("y0") + F.col("y1")) / 2
    bottom = F.col("t_y1") - F.when(F.col("row_count") > 0, shrink * (F.col("t_y1") - F.col("t_y0")) / F.col("row_count")).otherwise(F.lit(0.0))
    inside = cx.between(F.col("t_x0") - pad, F.col("t_x1") + pad) & cy.between(F.col("t_y0") - pad, bottom + pad)
    return lines.join(t, ["path", "page_no"]).where(inside).select(*lines.columns, "table_no")


def outside_tables(chars: DataFrame, tables: DataFrame, pad: float = 1.0) -> DataFrame:
    """Items whose centre lies in no padded table box."""
    t = tables.select(F.col("path").alias("_p"), F.col("page_no").alias("_n"), *[F.col(c).alias(f"_{c}") for c in ("x0", "y0", "x1", "y1")])
    cx, cy = (F.col("x0") + F.col("x1")) / 2, (F.col("y0") + F.col("y1")) / 2
    inside = (F.col("path") == F.col("_p")) & (F.col("page_no") == F.col("_n")) & (cx >= F.col("_x0") - pad) & (cx <= F.col("_x1") + pad) & (cy >= F.col("_y0") - pad) & (cy <= F.col("_y1") + pad)
    return chars.join(t, inside, "left_anti")


def heading_threshold(spans: DataFrame, by: list[str], size: str = "size", over: float = 1.5) -> DataFrame:
    return spans.groupBy(*by).agg((F.percentile(size, 0.5) + over).alias("threshold"))


def reading_order(items: DataFrame) -> DataFrame:
    w = Window.partitionBy("path", "page_no").orderBy("y0", "x0", "x1", "y1")
    return items.withColumn("place", F.row_number().over(w) - 1)


def join_spans(spans: DataFrame, gap: float = 1.5) -> DataFrame:
    """Text of each line, its spans in reading order; a blank where two that meet in Latin letters or digits stand apart. Empty spans count for nothing."""
    line = ["path", "page_no", "block_no", "line_no"]
    w = Window.partitionBy(*line).orderBy("y0", "x0", "x1", "y1")
    d = spans.where("text <> ''")
    latin = F.col("text").rlike("^[A-Za-z0-9]") & F.lag("text").over(w).rlike("[A-Za-z0-9]$")
    apart = F.coalesce(latin & (F.col("x0") - F.lag("x1").over(w) > gap), F.lit(False))
    d = d.withColumns({"_piece": F.concat(F.when(apart, F.lit(" ")).otherwise(F.lit("")), F.col("text")), "_at": F.row_number().over(w)})
    return d.groupBy(*line).agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("_at", "_piece"))), lambda x: x["_piece"]), "").alias("text"))


def column_split(lines: DataFrame, by: list[str], least_lines: int = 30, least_gap: float = 90.0) -> DataFrame:
    """The x between two columns of a page: the middle of the widest gap of its sorted line starts (the first of equals).

    Pages with too few lines, a gap too narrow, or one not in the middle 20 to 80 % of the lines have none.
    """
    w = Window.partitionBy(*by).orderBy("x0")
    d = lines.withColumns({"_next": F.lead("x0").over(w), "_rank": F.row_number().over(w), "_n": F.count("*").over(Window.partitionBy(*by))})
    d = d.withColumn("_gap", F.col("_next") - F.col("x0")).where("_gap IS NOT NULL")
    best = d.groupBy(*by).agg(F.max_by(F.struct((((F.col("x0") + F.col("_next")) / 2)).alias("x"), "_gap", "_rank", "_n"), F.struct(F.col("_gap"), -F.col("_rank"))).alias("b"))
    ok = (F.col("b._n") >= least_lines) & (F.col("b._gap") > least_gap) & (F.col("b._rank") - 1 > 0.2 * F.col("b._n")) & (F.col("b._rank") - 1 < 0.8 * F.col("b._n"))
    return best.where(ok).select(*by, F.col("b.x").alias("split_x"))


# Lines that hold only a list marker.
MARKER = r"^[\s\x{3000}]*(?:[ア-ン]|[A-Z]|[a-z]|[0-9]+|[①-⑳])[\s\x{3000}]*$"


def _items(lines: DataFrame, out: str) -> DataFrame:
    """The lines of each page as one array of structs, in order."""
    item = F.struct(F.col("place"), F.col("text"), *[F.col(c).cast("double").alias(c) for c in ("x0", "y0", "x1", "y1", "size")])
    return lines.groupBy("path", "page_no").agg(F.array_sort(F.collect_list(item)).alias(out))


def _lines(df: DataFrame, items: Column) -> DataFrame:
    return df.select("path", "page_no", F.posexplode(items).alias("place", "i")).select("path", "page_no", "place", *[f"i.{c}" for c in ("text", "x0", "y0", "x1", "y1", "size")])


def merge_markers(lines: DataFrame) -> DataFrame:
    """A line that holds only a list marker joins the next line, unless that is blank; boxes are joined, the larger size counts."""
    start = F.struct(F.array().cast("array<struct<place:int,text:string,x0:double,y0:double,x1:double,y1:double,size:double>>").alias("out"), F.lit(False).alias("open"))

    def step(acc: Column, x: Column) -> Column:
        last = F.element_at(acc["out"], -1)
        joined = F.struct(
            last["place"].alias("place"), F.concat(T.strip_u(last["text"]), F.lit(" "), F.regexp_replace(x["text"], f"^{T.WS}+", "")).alias("text"), F.least(last["x0"], x["x0"]).alias("x0"), F.least(last["y0"], x["y0"]).alias("y0"),
            F.greatest(last["x1"], x["x1"]).alias("x1"), F.greatest(last["y1"], x["y1"]).alias("y1"), F.greatest(last["size"], x["size"]).alias("size"),
        )
        takes = acc["open"] & (T.strip_u(x["text"]) != "")
        return F.when(takes, F.struct(F.concat(F.slice(acc["out"], 1, F.greatest(F.size(acc["out"]) - 1, F.lit(0))), F.array(joined)).alias("out"), F.lit(False).alias("open"))).otherwise(
            F.struct(F.concat(acc["out"], F.array(x)).alias("out"), x["text"].rlike(MARKER).alias("open"))
        )

    typed = F.transform("items", lambda x: F.struct(x["place"].cast("int").alias("place"), *[x[c].alias(c) for c in ("text", "x0", "y0", "x1", "y1", "size")]))
    folded = F.when(F.size("items") > 0, F.aggregate(typed, start, step)["out"])
    return _lines(_items(lines, "items"), folded)


def glyph_runs(rows: list[dict], least: int = 3, across: float = 2.0, down: float = 6.0) -> list[dict]:
    """Lines of one CJK character that follow one another on a row or in a column become one line, if they are ``least`` or more; rows go before columns."""
    single = [len(r["text"].strip()) == 1 and bool(re.match("[\u4e00-\u9fff\u3000-\u30ff]", r["text"].strip())) for r in rows]
    mid = [((r["x0"] + r["x1"]) / 2, (r["y0"] + r["y1"]) / 2) for r in rows]

    def end(i: int, along: int, off: float) -> int:
        j = i + 1
        while j < len(rows) and single[j] and abs(mid[j][1 - along] - mid[i][1 - along]) <= off and mid[j][along] > mid[j - 1][along]:
            j += 1
        return j

    out, i = [], 0
    while i < len(rows):
        j = max(end(i, 0, across), end(i, 1, down)) if single[i] else i + 1
        run = rows[i:j] if j - i >= least else rows[i : i + 1]
        if len(run) > 1:
            box = {c: f(r[c] for r in run) for c, f in (("x0", min), ("y0", min), ("x1", max), ("y1", max))}
            out.append({**run[0], **box, "text": "".join(r["text"].strip() for r in run)})
        else:
            out += run
        i += len(run)
    return out


def merge_glyph_runs(lines: DataFrame) -> DataFrame:
    """``glyph_runs`` of every page."""
    kind = "array<struct<place:int,text:string,x0:double,y0:double,x1:double,y1:double,size:double>>"

    @F.arrow_udf(kind)
    def run(pages: pa.Array) -> pa.Array:
        return pa.array([glyph_runs(p or []) for p in pages.to_pylist()], pages.type)

    items = _items(lines.withColumn("place", F.col("place").cast("int")), "items")
    return _lines(items, run(F.col("items")))


def line_clusters(chars: list[dict], tolerance: float = 3.0) -> list[list[dict]]:
    """Characters from the top, each on the line whose mean top is within the tolerance, else on a new one; in a line from the left."""
    out: list[list[dict]] = []
    mean = 0.0
    for c in sorted(chars, key=lambda c: (c["y0"], c["x0"])):
        if out and abs(c["y0"] - mean) <= tolerance:
            out[-1].append(c)
            mean += (c["y0"] - mean) / len(out[-1])
        else:
            out.append([c])
            mean = c["y0"]
    return [sorted(x, key=lambda c: c["x0"]) for x in out]


def _word(c: str) -> bool:
    return c.isascii() and (c.isalnum() or c in "_-.")


def char_line(chars: list[dict], gap: float) -> dict | None:
    """One line of its characters: a blank where two Latin word characters stand further apart than ``gap`` median sizes; none if it is blank."""
    space = median(c["size"] for c in chars) * gap
    text, last = "", None
    for c in chars:
        if not c["text"]:
            continue
        if last and c["x0"] - last["x1"] > space and _word(last["text"][-1]) and _word(c["text"][0]) and not text.endswith(" "):
            text += " "
        text += c["text"]
        last = c
    if not text.strip():
        return None
    said = [c for c in chars if c["text"]]
    return {"text": text, **{k: f(c[k] for c in said) for k, f in (("x0", min), ("y0", min), ("x1", max), ("y1", max), ("size", max))}}


def char_lines(chars: DataFrame, tolerance: float = 3.0, gap: float = 0.6) -> DataFrame:
    """(path, page_no, place, text, x0, y0, x1, y1, size): the lines of each page's characters."""
    kind = "array<struct<text:string,x0:double,y0:double,x1:double,y1:double,size:double>>"
    item = F.struct(F.col("text"), *[F.col(c).cast("double").alias(c) for c in ("x0", "y0", "x1", "y1", "size")])

    @F.arrow_udf(kind)
    def run(pages: pa.Array) -> pa.Array:
        return pa.array([[x for g in line_clusters(p or [], tolerance) if (x := char_line(g, gap))] for p in pages.to_pylist()], pages.type)

    pages = chars.groupBy("path", "page_no").agg(F.collect_list(item).alias("items"))
    return _lines(pages, run(F.col("items")))


def table_candidates(found: DataFrame, overlap: float = 0.85, least_rows: int = 2, least_columns: int = 2) -> DataFrame:
    """Of the tables found on a page (place, box, rows: arrays of cells), those large enough that overlap none that has more cells, or as many and fuller.

    They are numbered from 1, from the top and from the left. Two overlap where their common
    part is more than ``overlap`` of what they cover together.
    """
    n_rows, n_cols = F.size("rows"), F.array_max(F.transform("rows", lambda r: F.size(r)))
    full = F.aggregate("rows", F.lit(0), lambda acc, r: acc + F.size(F.filter(r, lambda c: T.sanitize_cell(c) != "")))
    d = found.withColumns({"_cells": n_rows * n_cols, "_full": full}).where((n_rows >= least_rows) & (n_cols >= least_columns))
    box = [F.col(c).cast("double").alias(c) for c in ("x0", "y0", "x1", "y1")]
    item = F.struct((-F.col("_cells")).alias("_cells"), (-F.col("_full")).alias("_full"), F.col("place"), *box, "rows")
    pages = d.groupBy("path", "page_no").agg(F.array_sort(F.collect_list(item)).alias("items"))

    def area(x: Column) -> Column:
        return (x["x1"] - x["x0"]) * (x["y1"] - x["y0"])

    def same(a: Column, b: Column) -> Column:
        w = F.greatest(F.least(a["x1"], b["x1"]) - F.greatest(a["x0"], b["x0"]), F.lit(0.0))
        h = F.greatest(F.least(a["y1"], b["y1"]) - F.greatest(a["y0"], b["y0"]), F.lit(0.0))
        return w * h > overlap * F.greatest(area(a) + area(b) - w * h, F.lit(1e-9))

    none = F.slice("items", 1, 0)
    kept = F.aggregate("items", none, lambda acc, x: F.when(F.exists(acc, lambda y: same(x, y)), acc).otherwise(F.concat(acc, F.array(x))))
    placed = F.array_sort(F.transform(kept, lambda x: F.struct(x["y0"].alias("y0"), x["x0"].alias("x0"), x["x1"].alias("x1"), x["y1"].alias("y1"), x["place"].alias("place"), x["rows"].alias("rows"))))
    return pages.select("path", "page_no", F.posexplode(placed).alias("i", "t")).select("path", "page_no", (F.col("i") + 1).alias("table_no"), "t.place", "t.x0", "t.y0", "t.x1", "t.y1", "t.rows")


def page_text(df: DataFrame, text: str = "text", plain: str = "plain") -> DataFrame:
    """Where a page's own text is blank, its plain text."""
    return df.withColumn(text, F.when(T.strip_u(F.coalesce(F.col(text), F.lit(""))) == "", F.col(plain)).otherwise(F.col(text)))
