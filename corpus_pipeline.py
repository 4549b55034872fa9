"""The corpus pipeline: rules, near duplicates, repeated passages, mixing, encoding.

Every stage takes all rows its predecessor kept and passes every column of its input on,
whatever its name; only the last returns other columns. An empty table gives an empty one.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docloom.llm import byte_bpe, jaccard_join, mixing, quality_rules, substring_dedup
from docloom.llm.common import every, remove, shared_path, table
from docloom.llm.queries import pattern, tokenizer_path


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that fail the base rule or a learned rule go: null, empty and short texts do. Repeated rows stay or go together; a null id is judged by its text."""
    rules = quality_rules.fit(docs, table(spark, sf_dir, "labels"))
    judged = quality_rules.judge(docs, rules)
    return judged.where(F.col(judged.columns[-1])["kept"]).select(*every(docs.columns))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents linked by 80 % of shared five-word shingles, the one with the smallest id stays. Texts without words and rows without an id stay; rows that repeat an id stay or go together."""
    return jaccard_join.keep_one(docs, 80, shingle=5)


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages of 50 words that a document with a smaller id has are cut out; texts of which nothing is left go. Rows of one id don't cut each other; a null id is the smallest."""
    return substring_dedup.remove_repeats(docs)


def mixed_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All rows, laid out in the order that gives sources their target weights. A null source is one of its own; ties go by the hash of id and text."""
    return mixing.in_order(mixing.mix_sources(docs))


def encoded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, number of ids and hashes of the ids and of the bytes that they decode to. A null text is the empty one."""
    return byte_bpe.encode_documents(docs, tokenizer_path("byte_bpe_multi_50k.tiktoken"), pattern())


STAGES = [
    ("quality_rules", quality),
    ("ngram_jaccard_join", near_duplicates),
    ("substring_dedup", repeated_passages),
    ("source_mixing", mixed_sources),
    ("byte_bpe", encoded),
]

#: Learned rules and byte pair merges have no form in SQL; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each stage's rows are written to the shared folder and read again by the next; then they are removed, all but the last's."""
    docs, last = table(spark, sf_dir, "documents"), None
    for name, stage in STAGES[:-1]:
        path = shared_path(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
        if last:
            remove(spark, last)
        last = path
    return STAGES[-1][1](spark, docs, sf_dir)
