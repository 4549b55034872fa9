"""Sinks: field tables, summaries, JSON lines and text trees."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docloom.functions import text as T


def long_form(rows: DataFrame, id_col: str, fields: list[str]) -> DataFrame:
    """(id, seq, field, value): one row for each field of each document."""
    items = F.array(*[F.struct(F.lit(i).alias("seq"), F.lit(f).alias("field"), F.coalesce(F.col(f"`{f}`").cast("string"), F.lit("")).alias("value")) for i, f in enumerate(fields)])
    return rows.select(id_col, F.explode(items).alias("x")).select(id_col, "x.seq", "x.field", "x.value")


def write_csv(df: DataFrame, path: str, partition_by: list[str] | None = None) -> None:
    """Every value in quotes; each file begins with a byte order mark, as spreadsheets expect."""
    first = df.columns[0] if not partition_by else next(c for c in df.columns if c not in partition_by)
    w = df.withColumnRenamed(first, "\ufeff" + first).write.mode("overwrite").option("header", "true").option("quoteAll", "true").option("escape", '"')
    (w.partitionBy(*partition_by) if partition_by else w).csv(path)


def json_lines(df: DataFrame) -> DataFrame:
    """Each row as JSON; strings lose their blank lines."""
    cols = [T.remove_empty_lines(F.col(f"`{c}`")).alias(c) if k == "string" else F.col(f"`{c}`") for c, k in df.dtypes]
    return df.select(F.to_json(F.struct(*cols), {"ignoreNullFields": "false"}).alias("value"))


def key_values(df: DataFrame, id_col: str) -> DataFrame:
    """(id, seq, value): a line ``key: value`` for each field."""
    fields = [c for c in df.columns if c != id_col]
    return long_form(df, id_col, fields).select(id_col, "seq", F.concat_ws(": ", "field", "value").alias("value"))


def write_texts(df: DataFrame, path: str, rel_dir: str = "rel_dir", file_name: str = "file_name", text: str = "text") -> None:
    """A tree of text files: folders as in ``rel_dir``, one folder for each file's parts, whose lines are the text's."""
    df.select(rel_dir, file_name, text).write.mode("overwrite").partitionBy(rel_dir, file_name).text(path)


def extraction_log(df: DataFrame, path: str = "path", pages: str = "pages", error: str = "error") -> DataFrame:
    """(timestamp, file, pages, status, error) of each document: FAIL where there is an error."""
    bad = F.coalesce(F.col(error), F.lit("")) != ""
    return df.select(F.date_format(F.current_timestamp(), "yyyy-MM-dd'T'HH:mm:ss").alias("timestamp"), F.col(path).alias("file"), F.coalesce(F.col(pages), F.lit(0)).cast("int").alias("pages"), F.when(bad, "FAIL").otherwise("OK").alias("status"), F.coalesce(F.col(error), F.lit("")).alias("error"))


def rule_status(before: DataFrame, after: DataFrame, id_col: str, text: str = "text") -> DataFrame:
    """(id, chars_before, chars_after, changed): what a rule did to each document."""
    b = before.select(id_col, F.col(text).alias("_b"))
    a = after.select(id_col, F.col(text).alias("_a"))
    return b.join(a, id_col, "left").select(id_col, F.length("_b").alias("chars_before"), F.length("_a").alias("chars_after"), (~F.col("_b").eqNullSafe(F.col("_a"))).alias("changed"))
