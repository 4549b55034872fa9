"""Sources: text trees, CSV summaries, rule files, and gated binary documents."""

from __future__ import annotations

import importlib.util

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Suffixes of binary documents and the library each needs.
BINARY = {"pdf": "fitz", "docx": "docx", "xlsx": "openpyxl", "xls": "xlrd"}


def read_texts(spark: SparkSession, path: str, suffix: str = "txt") -> DataFrame:
    """(path, file_name, rel_dir, text) of whole text files under a folder, or of one file. An empty file has no row."""
    d = spark.read.text(path, wholetext=True, recursiveFileLookup=True, pathGlobFilter=f"*.[{suffix[0].lower()}{suffix[0].upper()}]*")
    d = d.withColumn("path", F.url_decode(F.replace(F.input_file_name(), F.lit("+"), F.lit("%2B"))))
    d = d.where(F.lower(_name()).endswith("." + suffix))
    root = "/" + path.rstrip("/").split("/")[-1] + "/"
    inside = F.substring("path", F.instr("path", F.lit(root)) + len(root), F.length("path"))
    return d.select("path", _name().alias("file_name"), F.regexp_replace(inside, "/?[^/]*$", "").alias("rel_dir"), F.regexp_replace("value", r"\A\x{feff}", "").alias("text"))


def _name() -> Column:
    return F.element_at(F.split("path", "/"), -1)


def by_project(texts: DataFrame) -> DataFrame:
    """(project, file_name, text) of the text files: a project is a file's folder."""
    return texts.select(F.element_at(F.split("path", "/"), -2).alias("project"), _name().alias("file_name"), "text").where(F.lower("file_name").endswith(".txt"))


def find_documents(spark: SparkSession, path: str) -> DataFrame:
    """(path, suffix, content) of binary documents, whatever the suffix's case."""
    d = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
    suffix = F.lower(F.regexp_extract("path", r"\.([^./]+)$", 1))
    return d.select("path", suffix.alias("suffix"), "content").where(suffix.isin(*BINARY))


def require(suffix: str) -> None:
    """Raises if the library that reads such documents is missing."""
    if importlib.util.find_spec(BINARY[suffix]) is None:
        raise RuntimeError(f"reading .{suffix} documents needs the Python library {BINARY[suffix]}")


def read_summary(spark: SparkSession, path: str) -> DataFrame:
    """A CSV summary as strings; missing cells are empty."""
    return spark.read.csv(path, header=True, multiLine=True, quote='"', escape='"', inferSchema=False).na.fill("")


def read_rules(path: str) -> list | str:
    """A YAML rule list, or the text of a rule program."""
    with open(path, encoding="utf-8-sig") as f:
        body = f.read()
    if path.endswith((".yaml", ".yml")):
        import yaml

        return yaml.safe_load(body)["steps"]
    return body


def text_pages(texts: DataFrame, text: str = "text") -> DataFrame:
    """The pages of text dumps, which form feeds part: all other columns, page_no (from 1) and text. A last form feed adds no page."""
    keep = [c for c in texts.columns if c != text]
    parts = F.split(F.regexp_replace(text, r"\x0c\z", ""), r"\x0c", -1)
    return texts.select(*keep, F.posexplode(parts).alias("page_no", text)).withColumn("page_no", F.col("page_no") + 1)


def first_table_rows(tables: DataFrame) -> DataFrame:
    """(path, row_no, cells) of each document's first table (by page, then table); rows whose cells are all empty go. ``rows`` holds arrays of cells."""
    first = tables.groupBy("path").agg(F.min_by("rows", F.struct("page_no", "table_no")).alias("rows"))
    d = first.select("path", F.posexplode("rows").alias("row_no", "cells"))
    return d.where(F.exists("cells", lambda c: F.coalesce(c, F.lit("")) != ""))
