"""Tables on disk: partitioned writes, keyed upserts, catalog registration, run log
(S4-S12, S18, S20)."""

from __future__ import annotations

import json
import logging
import time

from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F, types as T

from slotflow import schemas
from slotflow.functions.columns import all_not_null
from slotflow.operators.upsert import held_keys, merge_versions
from slotflow.operators.windows import dedup_latest
from slotflow.sources.staging import drop_staged, stage

log = logging.getLogger(__name__)

BOOKING_PARTITIONS = ["booking_year", "booking_month", "marketing_channel"]
SPEND_PARTITIONS = ["year", "month", "channel"]
MAX_RECORDS_PER_FILE = 2_000_000
SCHEMA_FILE = "_table_schema"


def _fs_path(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def path_exists(spark: SparkSession, path: str) -> bool:
    fs, p = _fs_path(spark, path)
    return bool(fs.exists(p))


def table_exists(spark: SparkSession, path: str) -> bool:
    """A table exists at ``path`` when its folder holds a commit marker, a part file or a
    partition folder (one listing of the top level, never a recursive walk)."""
    fs, p = _fs_path(spark, path)
    if not fs.exists(p):
        return False
    for st in fs.listStatus(p):
        name = st.getPath().getName()
        if name == "_SUCCESS" or name.endswith(".parquet") or (st.isDirectory() and "=" in name):
            return True
    return False


def spread(df: DataFrame, partition_cols: list[str]) -> DataFrame:
    """Distribution for a partitioned write: a REBALANCE on the partition columns. AQE then
    sizes the write tasks from runtime statistics: a table partition holding a third of the
    data is split across several tasks (``optimizeSkewsInRebalancePartitions``), and small
    partitions are packed together, so each folder gets few, reasonably sized files."""
    return df.hint("rebalance", *partition_cols)


def write_partitioned(
    df: DataFrame,
    path: str,
    partition_cols: list[str],
    mode: str = "overwrite",
    fmt: str = "parquet",
) -> None:
    """Partitioned create (full overwrite: folders not in ``df`` are removed)."""
    (
        spread(df, partition_cols)
        .write.mode(mode)
        .option("partitionOverwriteMode", "static")
        .option("maxRecordsPerFile", MAX_RECORDS_PER_FILE)
        .partitionBy(*partition_cols)
        .format(fmt)
        .save(path)
    )


def write_silver_bookings(df: DataFrame, path: str) -> None:
    """S4."""
    write_partitioned(df, path, BOOKING_PARTITIONS)
    write_schema(df.sparkSession, path, df.schema)


def write_silver_spend(df: DataFrame, path: str) -> None:
    """S5."""
    write_partitioned(df, path, SPEND_PARTITIONS)
    write_schema(df.sparkSession, path, df.schema)


def upsert_table(
    spark: SparkSession,
    path: str,
    source: DataFrame,
    keys: list[str],
    partition_cols: list[str],
    order: list[Column] | None = None,
    partitions_follow_keys: bool = False,
) -> dict[str, int]:
    """Keyed upsert into a partitioned Parquet table; creates it when absent.

    ``order`` picks the winner among all versions of a key, those in the table and those in the
    batch alike, so that an older version that arrives late does not replace a newer one; of
    versions that tie, the batch's wins. Without it the batch (unique by key) wins.

    Only partitions the batch touches are rewritten: those of its rows, and those that hold old
    versions of its keys (found by a scan of the table's key and partition columns, which a Bloom
    filter of the batch's keys thins before it is joined to them). They are read by their folders,
    merged, staged in the checkpoint folder (a path being read cannot be overwritten) and written
    back with dynamic partition overwrite; touched partitions left without rows are removed. The
    lists of touched partitions are partition metadata, which a scan of them holds on the driver
    anyway; which of their folders exist is looked up in one listing.

    ``partitions_follow_keys``: the partition values are a function of the key (spend: (date,
    channel) -> (year, month, channel)), so old versions live in the batch's partitions and the
    scan for moved rows is skipped.

    Rerun-safe: if the job dies part-way, running it again with the same batch gives the same
    table. The table's schema is kept in ``<path>/_table_schema`` (no footers are read); columns
    that only the batch has are added to it. Returns counts for the run log."""
    obs = Observation("upsert_source")
    src = source.filter(all_not_null(keys))
    if order:
        src = dedup_latest(src, keys, order)
    src = stage(src.observe(obs, F.count(F.lit(1)).alias("rows")), "upsert-source")
    rows = int(obs.get["rows"])
    if not table_exists(spark, path):
        write_partitioned(src, path, partition_cols)
        write_schema(spark, path, src.schema)
        drop_staged(src)
        return {"rows": rows, "partitions_rewritten": -1}

    schema = _with_new_columns(read_schema(spark, path), src)
    homes = src.select(*partition_cols)
    if not partitions_follow_keys:
        table = spark.read.schema(schema).parquet(path)
        old = held_keys(table.select(*keys, *partition_cols), src, keys, rows)
        homes = homes.unionByName(old.select(*partition_cols))
    touched = homes.distinct().collect()
    folders = [_partition_folder(spark, partition_cols, row) for row in touched]
    listed = _partition_folders(spark, path, partition_cols)
    there = [f"{path.rstrip('/')}/{f}" for f in folders if f in listed]
    old = spark.read.schema(schema).option("basePath", path).parquet(*there) if there else spark.createDataFrame([], schema)
    merged = stage(merge_versions(old, src, keys, order), "upsert-merged")
    write_schema(spark, path, schema)
    (
        spread(merged, partition_cols)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .option("maxRecordsPerFile", MAX_RECORDS_PER_FILE)
        .partitionBy(*partition_cols)
        .parquet(path)
    )
    filled = {_partition_folder(spark, partition_cols, r) for r in merged.select(*partition_cols).distinct().collect()}
    for folder in set(there) - {f"{path.rstrip('/')}/{f}" for f in filled}:
        fs, p = _fs_path(spark, folder)
        fs.delete(p, True)
    for staged in (merged, src):
        drop_staged(staged)
    return {"rows": rows, "partitions_rewritten": len(touched)}


def _partition_folder(spark: SparkSession, partition_cols: list[str], row) -> str:
    """The folder of a partition within its table, with Spark's own escaping of its values."""
    name = spark.sparkContext._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.getPartitionPathString
    return "/".join(name(c, None if row[c] is None else str(row[c])) for c in partition_cols)


def _partition_folders(spark: SparkSession, path: str, partition_cols: list[str]) -> set[str]:
    """All partition folders of a table, relative to it, from one listing."""
    fs, p = _fs_path(spark, path)
    found = fs.globStatus(spark.sparkContext._jvm.org.apache.hadoop.fs.Path(p, "/".join(f"{c}=*" for c in partition_cols))) or []
    return {"/".join(st.getPath().toString().split("/")[-len(partition_cols):]) for st in found}


def write_schema(spark: SparkSession, path: str, schema: T.StructType) -> None:
    """Keeps a table's schema next to its data (a folder that scans ignore)."""
    fs, p = _fs_path(spark, f"{path.rstrip('/')}/{SCHEMA_FILE}")
    out = fs.create(p, True)
    try:
        out.write(bytearray(schema.json().encode()))
    finally:
        out.close()


def read_schema(spark: SparkSession, path: str) -> T.StructType:
    """The kept schema; of a table written by other means, the one Spark infers from a footer."""
    fs, p = _fs_path(spark, f"{path.rstrip('/')}/{SCHEMA_FILE}")
    if not fs.exists(p):
        return spark.read.parquet(path).schema
    stream = fs.open(p)
    try:
        text = spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()
    return T.StructType.fromJson(json.loads(text))


def _with_new_columns(schema: T.StructType, src: DataFrame) -> T.StructType:
    """The table's schema plus columns only the batch has; shared ones take the batch's type
    (partition columns: not the type inferred from folder names)."""
    types = {f.name: f.dataType for f in src.schema.fields}
    known = [T.StructField(f.name, types.get(f.name, f.dataType), True) for f in schema.fields]
    new = [T.StructField(n, t, True) for n, t in types.items() if n not in schema.fieldNames()]
    return T.StructType(known + new)


def write_gold(df: DataFrame, root: str, name: str) -> str:
    """Validated path, full overwrite (gold tables are small: one row per day x channel
    or coarser)."""
    if not root or not root.strip():
        raise ValueError(f"empty gold root for table {name}")
    if not name or "/" in name:
        raise ValueError(f"invalid gold table name {name!r}")
    path = f"{root.rstrip('/')}/{name}"
    df.write.mode("overwrite").parquet(path)
    return path


def register_table(spark: SparkSession, db: str, name: str, path: str, fmt: str = "parquet") -> bool:
    """Idempotent registration of a table over a location. Columns that its files gained
    (by an upsert) are added to the table, which is never gone meanwhile; partitions written since
    the last run are recovered. A failure is a warning."""
    full = f"`{db}`.`{name}`"
    try:
        spark.sql(f"CREATE DATABASE IF NOT EXISTS `{db}`")
        schema = found_schema(spark, path, fmt)
        partitions = _partition_columns(spark, path)
        columns = lambda names: ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields if f.name in names)
        by = f" PARTITIONED BY ({', '.join(f'`{c}`' for c in partitions)})" if partitions else ""
        spark.sql(f"CREATE TABLE IF NOT EXISTS {full} ({columns(schema.fieldNames())}) USING {fmt}{by} LOCATION '{path}'")
        new = [n for n in schema.fieldNames() if n not in spark.table(full).columns]
        if new:
            spark.sql(f"ALTER TABLE {full} ADD COLUMNS ({columns(new)})")
        if partitions:
            spark.sql(f"MSCK REPAIR TABLE {full}")
        spark.sql(f"REFRESH TABLE {full}")
        return True
    except Exception as e:  # noqa: BLE001 - registration must never fail the job
        log.warning("could not register %s.%s at %s: %s", db, name, path, e)
        return False


def found_schema(spark: SparkSession, path: str, fmt: str = "parquet") -> T.StructType:
    """The schema of a table's files: the kept one, else the union over all partitions, whose
    footers (or JSON documents) Spark reads in a job."""
    if fmt != "parquet":
        return spark.read.format(fmt).load(path).schema
    if path_exists(spark, f"{path.rstrip('/')}/{SCHEMA_FILE}"):
        return read_schema(spark, path)
    return spark.read.option("mergeSchema", "true").parquet(path).schema


def _partition_columns(spark: SparkSession, path: str) -> list[str]:
    """Names of a table's partition levels, as Spark finds them over all its folders (folders that
    disagree are an error); files are listed, not read."""
    own = {"path", "modificationTime", "length", "content"}
    return [c for c in spark.read.format("binaryFile").load(path).columns if c not in own]


def discover_tables(spark: SparkSession, db: str, root: str, fmt: str = "parquet") -> dict[str, bool]:
    """Registers every table found directly under ``root`` (or brings its columns and
    partitions up to date); hidden folders are left out. Returns {name: registered}."""
    fs, p = _fs_path(spark, root)
    if not fs.exists(p):
        return {}
    found = [st.getPath() for st in fs.listStatus(p) if st.isDirectory()]
    names = {f.getName(): f.toString() for f in found if not f.getName().startswith(("_", ".")) and "=" not in f.getName()}
    return {n: register_table(spark, db, n, path, fmt) for n, path in sorted(names.items()) if fmt != "parquet" or table_exists(spark, path)}


def write_bronze_spend(nested: DataFrame, path: str, ingestion_date: str) -> None:
    """One ``{records, metadata}`` JSON document per (date, channel) and source file,
    partitioned ``channel=/date=/source_file=`` (input: ``nest_spend`` output). Writing a file
    again replaces its documents, so a run can be repeated."""
    docs = nested.select(
        "records",
        F.struct(
            F.lit(ingestion_date).alias("ingestion_date"),
            "record_count",
            F.col("channel"),
            F.col("date").cast("string").alias("date"),
            "source_file",
        ).alias("metadata"),
        "channel",
        F.col("date").cast("string").alias("date"),
        "source_file",
    )
    by = ["channel", "date", "source_file"]
    docs.hint("rebalance", *by).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*by).json(path)


def hand_over(spark: SparkSession, written: str, folder: str, name: str) -> int:
    """Moves the files of a finished write, in the order of their names, to a folder that a stream
    reads, with modification times that rise in that order: they arrive one after the other although
    tasks wrote them side by side. Returns their number."""
    fs, target = _fs_path(spark, folder)
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    parts = sorted(st.getPath().toString() for st in fs.globStatus(path(path(written), "part-*")) or [])
    fs.mkdirs(target)
    first = time.time_ns() // 1_000_000 - len(parts)
    for i, part in enumerate(parts):
        fs.setTimes(path(part), first + i, -1)
        if not fs.rename(path(part), path(target, f"{name}-{i:06d}.txt")):
            raise RuntimeError(f"could not move {part}")
    return len(parts)


def replace_partition(spark: SparkSession, df: DataFrame, path: str, column: str, value: str, fmt: str) -> None:
    """Makes ``df`` the whole content of one partition (an empty one is removed)."""
    fs, p = _fs_path(spark, f"{path.rstrip('/')}/{column}={value}")
    fs.delete(p, True)
    if not df.isEmpty():
        df.withColumn(column, F.lit(value)).write.mode("append").partitionBy(column).format(fmt).save(path)


def record_run(
    spark: SparkSession,
    path: str,
    pipeline_id: str,
    execution_date: str,
    records_processed: int,
    files_processed: int,
    status: str = "completed",
    error_message: str | None = None,
) -> None:
    """Run-state log keyed (pipeline_id, execution_date); last write wins (S6 upsert)."""
    row = spark.createDataFrame(
        [(pipeline_id, execution_date, None, records_processed, files_processed, status, error_message)],
        schemas.RUN_LOG,
    ).withColumn("timestamp", F.current_timestamp())
    upsert_table(spark, path, row, ["pipeline_id", "execution_date"], ["pipeline_id"], partitions_follow_keys=True)


def read_runs(spark: SparkSession, path: str) -> DataFrame:
    """S20."""
    return spark.read.schema(schemas.RUN_LOG).parquet(path)
