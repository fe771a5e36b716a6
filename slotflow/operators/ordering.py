"""Sorts, top-k, date spines, unions."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from slotflow.sources.staging import stage

ROWS_A_SPLIT = 100_000  # rows that a task of a range split sorts

def sort_recent_first(df: DataFrame, date_col: str, then: str) -> DataFrame:
    """O1: date descending, then ``then`` ascending."""
    return df.orderBy(F.col(date_col).desc_nulls_last(), F.col(then).asc_nulls_first())


def leaderboard(df: DataFrame, by: str, ascending: bool = False, tie: str | None = None) -> DataFrame:
    """O2: sort by one measure (nulls last), optional tie-break column."""
    first = F.col(by).asc_nulls_last() if ascending else F.col(by).desc_nulls_last()
    cols: list[Column] = [first] + ([F.col(tie).asc_nulls_first()] if tie else [])
    return df.orderBy(*cols)


def series(df: DataFrame, source_col: str, source: str, date_col: str = "date") -> DataFrame:
    """O3: one source's rows in date order."""
    return df.filter(F.col(source_col) == F.lit(source)).orderBy(F.col(date_col).asc_nulls_first())


def latest_sources(files: DataFrame, k: int = 30, date_col: str = "file_date") -> DataFrame:
    """The ``k`` newest source files (a top-k: Spark plans TakeOrderedAndProject, each
    task keeps k rows, the driver merges k x tasks)."""
    return files.orderBy(F.col(date_col).desc_nulls_last(), F.col("file_name").desc_nulls_last()).limit(k)


def date_spine(anchors: DataFrame, as_of_col: str, days: int) -> DataFrame:
    """For each anchor row, the ``days`` dates ending at its ``as_of_col`` (fallback file
    list when no index exists): sequence + explode, no driver loop."""
    seq = F.sequence(F.date_sub(F.col(as_of_col), days - 1), F.col(as_of_col))
    return anchors.withColumn("spine_date", F.explode(seq))


def union_all(frames: list[DataFrame]) -> DataFrame:
    """Bag union by column name; columns missing on one side become null."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def ensure_parallelism(df: DataFrame) -> DataFrame:
    """Spread the rows of a table over the cluster's cores before CPU-heavy row work (JSON,
    base64) when it has fewer files than cores; at scale this is a no-op. Of what comes from files
    only the listing is looked at, so that nothing runs; other frames tell their partitions."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    n_files = len(df.inputFiles())
    return df if (n_files or df.rdd.getNumPartitions()) >= cores else df.repartition(cores)


def splits_for(df: DataFrame, amount: int | None, of_one: int) -> int:
    """Tasks of a shuffle that gives each ``of_one`` of ``amount`` (rows, bytes): as many as the
    session's, or more where there is more, so that a task's part does not grow with the input."""
    return max(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-(amount or 0) // of_one))


def number_in_groups(df: DataFrame, keys: list[str], order: list[str], column: str, rows_a_split: int | None = None) -> DataFrame:
    """``row_number`` within ``keys`` by ``order`` for groups of any size: a group's rows lie in as
    many splits of a range sort as they need, and a row's number is its place in its split plus the
    group's rows in the splits before. ``df`` is read three times (its count, the split's sample,
    the split); the numbered rows are staged and come ordered by (keys, order) within each split."""
    ordered = df.repartitionByRange(splits_for(df, df.count(), rows_a_split or ROWS_A_SPLIT), *keys, *order).sortWithinPartitions(*keys, *order)
    rows = stage(ordered.withColumn("_at", F.monotonically_increasing_id()), "numbered")
    split = F.shiftright("_at", 33)  # the id's upper bits are the split, the others the place in it
    earlier = Window.partitionBy(*keys).orderBy("_split").rowsBetween(Window.unboundedPreceding, -1)
    groups = rows.groupBy(split.alias("_split"), *keys).agg(F.min("_at").alias("_first"), F.count("*").alias("_rows"))
    before = F.coalesce(F.sum("_rows").over(earlier), F.lit(0))
    groups = stage(groups.select("_split", *[F.col(k).alias(f"_key_{k}") for k in keys], (before + 1 - F.col("_first")).alias("_shift")), "numbered-groups")
    same = (split == F.col("_split")) & reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"_key_{k}")) for k in keys])
    return rows.join(groups, same).select(*df.columns, (F.col("_at") + F.col("_shift")).alias(column))
