"""Helpers the corpus operators share: tables, staging, Arrow batches, packed columns."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, functions as F

from slotflow.session import checkpoint_dir
from slotflow.sources.staging import stage

__all__ = ["table", "stage", "shuffle_width", "slices", "text_bytes", "buckets_of", "prepare", "words_array"]

# the six ASCII white space characters that separate words
SPACES = " \t\n\x0b\x0c\r"
SLICE_BYTES = 4 << 20


def prepare(spark: SparkSession) -> SparkSession:
    """Registers the session's checkpoint folder; sets nothing that the session has."""
    checkpoint_dir(spark)
    return spark


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shuffle_width(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def words_array(text):
    """Column: the words (runs without ASCII white space) of a text, as an array; null has none."""
    return F.filter(F.split(F.coalesce(text, F.lit("")), "[ \\t-\\r]+"), lambda w: w != "")


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a string column without gaps and the offsets of its rows; nulls are empty."""
    column = column.cast(pa.large_string()).fill_null("")
    offsets = np.frombuffer(column.buffers()[1], np.int64, len(column) + 1, column.offset * 8)
    data = column.buffers()[2]
    data = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def slices(batches: Iterator[pa.RecordBatch], column: str = "text", limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """The batches cut so that each part holds about ``limit`` bytes of text (a longer text is a
    part of its own): what bounds a task's memory."""
    for batch in batches:
        if not batch.num_rows:
            continue
        sizes = pc.binary_length(batch.column(column)).fill_null(0).to_numpy(zero_copy_only=False)
        offsets = np.concatenate(([0], np.cumsum(sizes, dtype=np.int64)))
        at = 0
        while at < batch.num_rows:
            end = int(np.searchsorted(offsets, offsets[at] + limit, "right")) - 1
            end = min(max(end, at + 1), batch.num_rows)
            yield batch.slice(at, end - at)
            at = end


def buckets_of(key: np.ndarray, n: int) -> np.ndarray:
    return ((key >> np.uint64(33)) % np.uint64(n)).astype(np.int64)
