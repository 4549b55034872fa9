"""The text operators as SQL functions of a session."""

from __future__ import annotations

from pyspark.sql import SparkSession

from docloom.functions import cleaner, normalize, tables

#: Name of each SQL function and the text function behind it.
FUNCTIONS = {
    "dl_full_width": normalize.widen,
    "dl_half_width": normalize.narrow,
    "dl_circle_numbers": normalize.circle_numbers,
    "dl_start_at_title": cleaner.start_at_title,
    "dl_cut_at_annex": cleaner.cut_at_annex,
    "dl_collapse_points": cleaner.collapse_points,
    "dl_collapse_paragraphs": cleaner.collapse_paragraphs,
    "dl_single_line": cleaner.single_line,
    "dl_marks_on_lines": tables.marks_on_lines,
    "dl_without_page_numbers": tables.without_page_numbers,
    "dl_join_tables": tables.join_tables,
    "dl_rows_outside": tables.rows_outside,
    "dl_post_clean": tables.post_clean_text,
}


def register(spark: SparkSession) -> None:
    """Make the functions known to ``spark.sql``. They run in Arrow batches; null stays null."""
    from docloom.functions.folds import batches

    for name, f in FUNCTIONS.items():
        spark.udf.register(name, batches(f))
