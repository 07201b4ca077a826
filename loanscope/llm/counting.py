"""Token counts through a cache keyed by content and tokenizer version.

The cache is a Parquet table of ``content`` (SHA-256 of the text's UTF-8 bytes),
``version`` (digest of tokenizer file, library and settings), ``n_bytes`` and
``n_tokens``. A run joins the distinct digests of its documents to it, encodes one
text for each digest that it lacks, appends the new counts, and joins counts back.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from loanscope.llm.tokens import Encoder
from loanscope.llm.workspace import Workspace

CACHE_SCHEMA = "content binary, n_bytes long, n_tokens long, version string"


def version_digest(tokenizer: str) -> str:
    """Digest of what decides a count: vocabulary file, library release, settings."""
    with open(tokenizer, "rb") as file:
        content = hashlib.sha256(file.read())
    content.update(Encoder.release(tokenizer).encode())
    content.update(b"add_special_tokens=False truncation=None padding=None")
    return content.hexdigest()


def normalised(text: Column) -> Column:
    """What the cache calls the content: the exact bytes, as counts depend on every byte."""
    return F.coalesce(text, F.lit(""))


def read_cache(spark: SparkSession, folder: str, version: str) -> DataFrame:
    """Counts of one version; runs that met may have appended one digest twice."""
    try:
        stored = spark.read.schema(CACHE_SCHEMA).parquet(folder)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        stored = spark.createDataFrame([], CACHE_SCHEMA)
    return (
        stored.filter(F.col("version") == version)
        .groupBy("content")
        .agg(F.max("n_bytes").alias("n_bytes"), F.max("n_tokens").alias("n_tokens"))
    )


def _encode(tokenizer: str, version: str):
    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            encoder = Encoder.load(tokenizer)
            texts = batch.column("text").to_pylist()
            n = len(texts)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("content"),
                    batch.column("n_bytes"),
                    pa.array([len(ids) for ids in encoder.encode(texts)], pa.int64()),
                    pa.array([version] * n, pa.string()),
                ],
                names=["content", "n_bytes", "n_tokens", "version"],
            )

    return encode


def count_tokens(
    docs: DataFrame, tokenizer: str, cache: str | None = None, limit: int = 1024,
    key: str = "doc_id", text: str = "text",
) -> DataFrame:
    """One row per input row: doc_id, n_bytes, n_tokens, over_limit.

    A null text is empty: no bytes, no tokens, not over the limit. Repeated rows give
    repeated rows and are encoded once; null ids stay null. Other columns are not read.
    An empty table gives no row. ``cache`` is a shared folder that later runs use again;
    without one the counts live as long as the result. Runs that meet may encode the same text
    and append the same count twice; it is the same count.
    """
    spark = docs.sparkSession
    version = version_digest(tokenizer)
    body = normalised(F.col(text))
    rows = docs.select(
        F.col(key).cast("long").alias("doc_id"),
        body.alias("text"),
        F.octet_length(body).cast("long").alias("n_bytes"),
        F.unhex(F.sha2(body.cast("binary"), 256)).alias("content"),
    )
    with Workspace(spark, "counts") as work:
        known = read_cache(spark, cache, version) if cache else None
        # One text for each digest: copies meet in the map tasks first.
        wanted = rows.select("content", "n_bytes", "text").dropDuplicates(["content"])
        if known is not None:
            wanted = wanted.join(known.select("content"), "content", "left_anti")
        fresh = wanted.select("content", "n_bytes", "text").mapInArrow(
            _encode(tokenizer, version), CACHE_SCHEMA
        )
        if cache:
            fresh.write.mode("append").parquet(cache)
            counts = read_cache(spark, cache, version)
        else:
            counts = work.table("cache", fresh)
        counted = rows.select("doc_id", "n_bytes", "content").join(
            counts.select("content", "n_tokens"), "content"
        )
        result = counted.select(
            "doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit")
        )
        return work.keep("result", result)
