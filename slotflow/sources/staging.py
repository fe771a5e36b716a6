"""Staged tables: write a DataFrame to the shared checkpoint folder and read it back.

Used where a plan has a real boundary (for example the booking stream between webhook intake
and the bronze writer) and as a lineage cut that survives executor loss: the staged files
live in ``spark.checkpoint.dir`` (a shared file system on a cluster), not on an executor.
"""

from __future__ import annotations

from pyspark.sql import DataFrame

from slotflow.session import scratch_path


def stage(df: DataFrame, name: str) -> DataFrame:
    path = scratch_path(df.sparkSession, name)
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.parquet(path)


def drop_staged(df: DataFrame) -> None:
    """Delete the files behind a staged DataFrame once nothing reads it any more."""
    spark = df.sparkSession
    for path in df.inputFiles()[:1]:
        root = path.rsplit("/", 1)[0]
        jvm = spark.sparkContext._jvm
        p = jvm.org.apache.hadoop.fs.Path(root)
        fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
        if "slotflow-stage" in root and fs.exists(p):
            fs.delete(p, True)
