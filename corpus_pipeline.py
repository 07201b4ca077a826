"""Corpus pipeline: from raw documents to packed training sequences.

Each stage takes (spark, docs, sf_dir) and returns a table, which is written and read back
before the next one. All but the last return the columns of the documents. Stages accept
what their operators do: nulls in any column, empty and long texts, repeated rows, empty
tables and further columns, which stay as they are.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loanscope.llm import decontamination, linededup, neardup, packing, quality
from loanscope.llm.queries import CONTEXT, TOKENIZER, table
from loanscope.llm.workspace import Workspace


def good_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier keeps."""
    weights, _ = quality.fitted(docs, table(spark, sf_dir, "labels"))
    return docs.filter(quality.bad_chance(weights, F.col("text")) <= quality.REJECT_ABOVE)


def without_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without runs of lines that stand earlier; those that lose every line go."""
    made = linededup.without_repeats(docs, counts=False, emptied=False)
    if "n_chars" in docs.columns:
        made = made.withColumn("n_chars", F.char_length("text").cast(docs.schema["n_chars"].dataType))
    return made


def one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates, and one row of repeated ones."""
    found = neardup.near_duplicates(docs)
    gone = found.filter(~F.col("kept")).select("doc_id").distinct()
    left = docs.join(gone.hint("merge"), "doc_id", "left_anti")
    repeated = found.filter("kept AND doc_id IS NOT NULL").groupBy("doc_id").count().filter("count > 1")
    if not repeated.isEmpty():
        ids = repeated.select("doc_id")
        some = left.join(ids, "doc_id", "left_semi").dropDuplicates(["doc_id", "text"])
        left = left.join(ids, "doc_id", "left_anti").unionByName(some)
    return left.select(*docs.columns)


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no copy of a benchmark item."""
    return decontamination.without_benchmark(docs, table(spark, sf_dir, "benchmark"))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents in training sequences."""
    return packing.pack(docs, TOKENIZER, CONTEXT)


STAGES = [
    ("quality_classifier", good_documents),
    ("line_dedup", without_repeated_lines),
    ("minhash_neardup", one_of_each_group),
    ("benchmark_decontamination", without_benchmark),
    ("packing", packed),
]

#: Learned scores, sketches and tokenizers are beyond SQL; tests compare with plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the whole table of documents."""
    work = Workspace(spark, "pipeline")
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = work.keep(name, stage(spark, docs, sf_dir))
    return docs
