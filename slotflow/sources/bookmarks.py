"""Bookmarks over dated folders (S2, S23, X3): what a batch run has read, by partition.

A bookmark is a table with the state of each ``channel=/date=`` folder when it was read: its number
of files, their bytes and the newest modification. A run lists the files (a distributed listing,
contents are not read), takes the dates with a folder whose state differs, and keeps the listing
as the new bookmark once it has written its results. A run that dies keeps the old bookmark and its
dates are read again.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from slotflow.sources.staging import stage
from slotflow.sources.tables import path_exists

STATE = "channel string, date string, files long, bytes long, modified timestamp"


def folder_states(spark: SparkSession, path: str) -> DataFrame:
    """The state of each folder under ``path``; files outside of dated folders have a null date."""
    if not path_exists(spark, path):
        return spark.createDataFrame([], STATE)
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.json").load(path)
    part = lambda name: F.nullif(F.regexp_extract("path", f"/{name}=([^/]*)/", 1), F.lit(""))
    return files.groupBy(part("channel").alias("channel"), part("date").alias("date")).agg(
        F.count("*").alias("files"), F.sum("length").alias("bytes"), F.max("modificationTime").alias("modified"))


class Bookmark:
    """The dates of ``path`` that changed since the bookmark ``name`` under ``root`` was kept."""

    def __init__(self, spark: SparkSession, root: str, name: str, path: str):
        self.spark, self.kept, self.now = spark, f"{root.rstrip('/')}/{name}", stage(folder_states(spark, path), f"bookmark-{name}")
        then = spark.read.schema(STATE).parquet(self.kept) if path_exists(spark, self.kept) else spark.createDataFrame([], STATE)
        changed = self.now.exceptAll(then).select("date").distinct().collect()  # calendar dates
        #: the dates to read; None if files lie outside of dated folders, which are read whole
        self.dates = None if any(r["date"] is None for r in changed) else sorted(r["date"] for r in changed)

    def keep(self) -> None:
        self.now.coalesce(1).write.mode("overwrite").parquet(self.kept)
