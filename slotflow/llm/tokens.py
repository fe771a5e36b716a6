"""Token counts with a digest cache.

The key of a count is the SHA-256 of the text (null is the empty text; nothing else may be
normalised without changing counts) and of the tokenizer's file. Texts are reduced to one for
each digest (within each task first, so that copies are not shuffled), digests that the cache
holds are left out, the rest is encoded and appended to the cache, and the counts are joined to
the documents by digest. Encoding a digest twice (a task run again, two jobs at once) does no
harm: the cache may repeat a row, readers take one.

Digests that hold more than a share of all rows (``4 * shuffle partitions`` of them at most, so a
table that may be broadcast) are joined apart, so that no task gets all copies of one text.

Special tokens in a text count as one token each, as the library does by default. Repeated rows
each get their result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from slotflow.llm.common import shuffle_width, slices, stage
from slotflow.llm.encoding import encoder

CONTEXT = 1024


def version_of(path: str) -> str:
    with open(path, "rb") as f:
        return hashlib.sha256(f.read()).hexdigest()


def _encode(batches: Iterator[pa.RecordBatch], path: str) -> Iterator[pa.RecordBatch]:
    count = encoder(path).count
    for part in slices(batches):
        yield pa.RecordBatch.from_arrays([part.column("digest"), pa.array([count(t) for t in part.column("text").to_pylist()], pa.int64())], ["digest", "n_tokens"])


def read_cache(spark: SparkSession, cache: str) -> DataFrame:
    return spark.read.schema("digest string, n_tokens long, version string").parquet(cache)


def create_cache(spark: SparkSession, cache: str) -> None:
    """An empty cache in a new folder."""
    spark.createDataFrame([], "digest string, n_tokens long, version string").write.mode("append").parquet(cache)


def count_tokens(docs: DataFrame, path: str, cache: str) -> DataFrame:
    """(doc_id, n_bytes, n_tokens) of every row; ``cache`` is a folder of counts, appended to."""
    spark, version = docs.sparkSession, version_of(path)
    text = F.coalesce("text", F.lit(""))
    known = read_cache(spark, cache).where(F.col("version") == version).select("digest", "n_tokens")
    rows = stage(docs.select("doc_id", F.octet_length(text).cast("long").alias("n_bytes"), F.sha2(text, 256).alias("digest")), "digests")
    distinct = docs.select(F.sha2(text, 256).alias("digest"), text.alias("text")).groupBy("digest").agg(F.first("text").alias("text"))
    misses = distinct.join(known.select("digest"), "digest", "left_anti")
    counted = misses.mapInArrow(lambda it: _encode(it, path), "digest string, n_tokens long")
    counted.withColumn("version", F.lit(version)).write.mode("append").parquet(cache)
    # listed anew: the frame above keeps the files it saw
    counts = read_cache(spark, cache).where(F.col("version") == version).dropDuplicates(["digest"]).select("digest", "n_tokens")
    return _join(rows, counts)


def _join(rows: DataFrame, counts: DataFrame) -> DataFrame:
    """The counts of all rows, those of frequent digests by broadcast."""
    share = max(2, rows.count() // (4 * shuffle_width(rows.sparkSession)))
    hot = rows.groupBy("digest").agg(F.count("*").alias("n")).where(F.col("n") > share).select("digest")
    marked = rows.join(F.broadcast(hot.join(counts, "digest")), "digest", "left")
    rest = marked.where("n_tokens IS NULL").drop("n_tokens").join(counts, "digest")
    return marked.where("n_tokens IS NOT NULL").unionByName(rest).select("doc_id", "n_bytes", "n_tokens")


def report(docs: DataFrame, path: str, cache: str) -> DataFrame:
    return count_tokens(docs, path, cache).withColumn("over_limit", F.col("n_tokens") > CONTEXT)
