"""Ordered joining of texts and prioritised joining of rows, as windows and aggregates."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from docloom.functions import text as T

# Names of the first places, the end mark, and the tokens of a regular project's files in order.
PLACES = ("FIRST", "SECOND", "THIRD")
END_MARK = "=== END OF DOCUMENT ==="
TOKENS = (("【個別_入札説明書】", "MAIN"), ("【個別_入札説明書_別紙-4】", "ANNEX-4"), ("【個別_入札説明書_別紙-5】", "ANNEX-5"))
# What names a common file, an individual one and annex 5 in other projects.
COMMON = r"(?i)kyoutsu(?:u)?(?:setsumei(?:sho|syo))?|共通[\s\x{3000}]*説明書|共通_?入札説明書|共通説明"
INDIVIDUAL = r"(?i)kobetsusetsumei(?:sho|syo)"
ANNEX_5 = r"(?i)besshi[-_‐ー－–−]?[\s\x{3000}]*[5５]|別紙[\s\x{3000}]*[-_‐ー－–−]?[\s\x{3000}]*[5５]"


def _places(df: DataFrame, by: str, name: str, *first: str) -> DataFrame:
    return df.withColumn("place", F.row_number().over(Window.partitionBy(by).orderBy(*first, F.lower(name), name)) - 1)


def order_by_tokens(files: DataFrame, tokens: list[str], by: str = "project", name: str = "file_name") -> DataFrame:
    """Per project and token the first file (by small-letter name) that has it, in token order; a file may stand for several tokens."""
    ranks = F.filter(F.array(*[F.when(F.contains(F.col(name), F.lit(t)), F.lit(i)) for i, t in enumerate(tokens)]), lambda x: x.isNotNull())
    w = Window.partitionBy(by, "_rank").orderBy(F.lower(name), name)
    got = files.withColumn("_rank", F.explode(ranks)).withColumn("_n", F.row_number().over(w)).where("_n = 1")
    return _places(got, by, name, "_rank").drop("_rank", "_n")


def order_by_kind(files: DataFrame, by: str = "project", name: str = "file_name") -> DataFrame:
    """Per project the first common file, the first individual one, the first annex 5, then all files that are none of these."""
    kinds = F.filter(F.array(*[F.when(F.col(name).rlike(p), F.lit(i)) for i, p in enumerate((COMMON, INDIVIDUAL, ANNEX_5))]), lambda x: x.isNotNull())
    kinds = F.when(F.size(kinds) == 0, F.array(F.lit(3))).otherwise(kinds)
    w = Window.partitionBy(by, "_kind").orderBy(F.lower(name), name)
    got = files.withColumn("_kind", F.explode(kinds)).withColumn("_n", F.row_number().over(w)).where("_n = 1 OR _kind = 3")
    return _places(got, by, name, "_kind").drop("_kind", "_n")


def order_warnings(files: DataFrame, by: str = "project", name: str = "file_name") -> DataFrame:
    """(project, warnings): kinds of files that ``order_by_kind`` misses, or of which it leaves some out."""
    said = ("kyoutsuu", "kobetsusetsumeisho", "別紙_besshi-5")
    names = [F.array_sort(F.collect_list(F.when(F.col(name).rlike(p), F.struct(F.lower(name).alias("l"), F.col(name).alias("n"))))) for p in (COMMON, INDIVIDUAL, ANNEX_5)]
    got = files.groupBy(by).agg(*[n.alias(f"_{i}") for i, n in enumerate(names)])
    parts = [
        F.when(F.size(f"_{i}") == 0, F.lit(f"Missing {k} file.")).when(F.size(f"_{i}") > 1, F.concat(F.lit(f"Multiple {k} files; ignored: "), F.array_join(F.transform(F.slice(f"_{i}", 2, 1 << 30), lambda x: x["n"]), ", ")))
        for i, k in enumerate(said)
    ]
    return got.select(by, F.array_compact(F.array(*parts)).alias("warnings"))


def uses_tokens(files: DataFrame, tokens: list[str], by: str = "project", name: str = "file_name") -> DataFrame:
    """Adds ``regular``: whether any file of the project has a token."""
    hit = F.lit(False)
    for t in tokens:
        hit = hit | F.contains(F.col(name), F.lit(t))
    return files.withColumn("regular", F.bool_or(hit).over(Window.partitionBy(by)))


def order_files(files: DataFrame, by: str = "project", name: str = "file_name") -> DataFrame:
    """By tokens in projects that use them, by kinds of files in all others."""
    tokens = [t for t, _ in TOKENS]
    d = uses_tokens(files, tokens, by, name)
    return order_by_tokens(d.where("regular"), tokens, by, name).unionByName(order_by_kind(d.where("NOT regular"), by, name)).drop("regular")


def order_preferred(files: DataFrame, tokens: list[str], by: str = "project", name: str = "file_name", descending: bool = True) -> DataFrame:
    """All files: those with a preferred token first, then by small-letter name; reversed on demand."""
    rank = F.lit(1)
    for t in tokens:
        rank = F.when(F.contains(F.col(name), F.lit(t)), F.lit(0)).otherwise(rank)
    keys = [rank, F.lower(name), F.col(name)]
    w = Window.partitionBy(by).orderBy(*[k.desc() if descending else k.asc() for k in keys])
    return files.withColumn("place", F.row_number().over(w) - 1)


def combine_texts(ordered: DataFrame, by: str = "project", name: str = "file_name", text: str = "text", end_after: int | None = None) -> DataFrame:
    """One text per project: each file under its start mark, without the line ends at its end; the end mark last, or after one place."""
    named = len(PLACES) if end_after is None else 2
    label = F.when(F.col("place") < named, F.element_at(F.array(*map(F.lit, PLACES)), F.least(F.col("place"), F.lit(named - 1)) + 1)).otherwise(F.concat(F.lit("FILE "), (F.col("place") + 1).cast("string")))
    part = F.concat(F.lit("=== "), label, F.lit(" FILE START: "), F.col(name), F.lit(" ===\n\n"), F.regexp_replace(F.coalesce(F.col(text), F.lit("")), r"\n+\z", ""))
    if end_after is not None:
        part = F.when(F.col("place") == end_after, F.concat(part, F.lit("\n\n" + END_MARK))).otherwise(part)
    rows = F.array_sort(F.collect_list(F.struct(F.col("place").alias("place"), part.alias("part"))))
    whole = F.array_join(F.transform(rows, lambda x: x["part"]), "\n\n")
    end = "\n" if end_after is not None else f"\n\n{END_MARK}\n"
    return ordered.groupBy(by).agg(F.concat(whole, F.lit(end)).alias("text"), F.count("*").alias("n_files"))


def combine_projects(files: DataFrame, by: str = "project", name: str = "file_name", text: str = "text") -> DataFrame:
    """Order and combine in one call; projects of which no file is taken have no row."""
    return combine_texts(order_files(files, by, name), by, name, text)


def has_value(v: Column) -> Column:
    return v.isNotNull() & (T.strip_u(v.cast("string")) != "")


# Annex 5, the numbering at a name's start, marked brackets and words that a name's key lacks.
ANNEX = r"(?i)別紙[\s\x{3000}]*[-‐ー－–−]?[\s\x{3000}]*5|別紙[\s\x{3000}]*５"
NUMBERING = r"^[\x{2460}-\x{2473}0-9０-９]+[._-]?[\s\x{3000}]*"
MARKED = "|".join(f"{a}[^{b}]*(?:入札説明書|別紙|個別)[^{b}]*{b}" for a, b in (("【", "】"), (r"\[", r"\]"), ("（", "）"), (r"\(", r"\)")))
WORDS = ("入札説明書", "個別事項", "個別")


def name_key(name: Column) -> Column:
    """A file name without folder, suffix, numbering, marked brackets, annex and kind words; other brackets and underscores are blanks."""
    x = F.regexp_replace(name, r"^.*/", "")
    x = F.regexp_replace(x, r"^(.+)\.[^.]+$", "$1")
    for pattern, to in ((NUMBERING, ""), (MARKED, " "), (ANNEX, " "), *((w, " ") for w in WORDS), (r"[【】\[\]()（）_]", " ")):
        x = F.regexp_replace(x, pattern, to)
    return T.compact_spaces(x)


def is_annex(name: Column) -> Column:
    return name.rlike(ANNEX)


def coalesce_rows(rows: DataFrame, key: str, pos: str, annex: str, prefer_main: list[str], others: list[str]) -> DataFrame:
    """One row per key, made from its first main row, or its first row if it has none.

    Its empty cells take the group's first value by position. Columns that don't prefer
    main rows take the last value of an annex row instead, if there is a main row.
    ``first_pos`` orders groups by first appearance.
    """
    base = F.struct(F.col(annex), F.col(pos))
    main = F.bool_or(~F.col(annex))
    aggs = [F.min(pos).alias("first_pos"), F.count("*").alias("n_rows")]
    for c in [*prefer_main, *others]:
        v = F.when(has_value(F.col(c)), F.col(c))
        own = F.coalesce(F.min_by(v, base), F.min_by(v, F.when(v.isNotNull(), F.col(pos))))
        if c in others:
            late = F.when(v.isNotNull() & F.col(annex), F.col(pos))
            own = F.coalesce(F.when(main & F.max(late).isNotNull(), F.max_by(v, late)), own)
        aggs.append(F.coalesce(own, F.lit("")).alias(c))
    return rows.groupBy(key).agg(*aggs)


def merge_summary(rows: DataFrame, name: str = "file name", pos: str = "pos", prefer_main: tuple[str, ...] = ()) -> DataFrame:
    """Rows of a summary whose names have one key become one row. ``pos`` gives the rows' order; all other columns are strings."""
    fields = [c for c in rows.columns if c != pos]
    d = rows.select(name_key(F.col(f"`{name}`")).alias("norm_key"), is_annex(F.col(f"`{name}`")).alias("_annex"), F.col(pos), *[F.col(f"`{c}`") for c in fields])
    main = [c for c in fields if c == name or c in prefer_main]
    return coalesce_rows(d, "norm_key", pos, "_annex", main, [c for c in fields if c not in main])


def transposed(rows: DataFrame, id_col: str, fields: list[str], ids: list | None = None) -> DataFrame:
    """Fields as rows, documents as columns. The documents of one report must fit in a header; giving their ids spares a pass."""
    long = rows.select(id_col, F.explode(F.array(*[F.struct(F.lit(i).alias("seq"), F.lit(f).alias("field"), F.coalesce(F.col(f).cast("string"), F.lit("")).alias("value")) for i, f in enumerate(fields)])).alias("x"))
    return long.groupBy("x.seq", "x.field").pivot(id_col, ids).agg(F.first("x.value")).orderBy("seq").drop("seq")
