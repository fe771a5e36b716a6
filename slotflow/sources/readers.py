"""Scans (S1-S3, S13, S17, S19). Every reader takes an explicit schema: no JSON inference,
so a scan is one distributed pass and types never depend on which files happen to exist."""

from __future__ import annotations

import datetime as dt
import re

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from slotflow import schemas
from slotflow.functions.columns import compute_once
from slotflow.operators.ordering import splits_for
from slotflow.sources.jsonarrays import array_elements, read_pieces
from slotflow.sources.tables import _fs_path, path_exists, read_schema, table_exists

NO_AGE_LIMIT = "36500d"
BYTES_A_SPLIT = 16 << 20  # of source files, in a task that cuts them into records

# Bronze layout: <root>/bookings/channel=<c>/date=<yyyy-MM-dd>/... and
# <root>/marketing_spend/channel=<c>/date=<yyyy-MM-dd>/source_file=<name>/... . Partition values
# are columns named channel_part / date_part, so they never shadow fields of the records
# (decision Q10).
BOOKINGS_DIR = "bookings"
SPEND_DIR = "marketing_spend"
GENERATION = "upto-"  # a compacted day's folder: batch=upto-<highest batch in it>
BAD_ARRAY, BAD_OBJECT = "not a JSON array", "not a JSON object"


def read_bronze_bookings(spark: SparkSession, path: str, multiline: bool = True, dates: list[str] | None = None) -> DataFrame:
    """Bronze booking JSON under ``path``, one object per file (``multiline``) or one per
    line. The folders' channel and date are partition columns, so a filter on ``date_part``
    prunes them; ``dates`` is such a filter. Of a compacted day the newest complete generation is
    read and the batches behind it. A document that does not parse is a row with its text in ``_corrupt_record``."""
    names = ["channel", "date", "batch"]
    fields = [*schemas.BRONZE_BOOKING.fields, T.StructField(schemas.CORRUPT, T.StringType()), *[T.StructField(n, T.StringType()) for n in names]]
    if not path_exists(spark, path):  # nothing has arrived yet (S19)
        df = spark.createDataFrame([], T.StructType(fields))
    else:
        df = (
            spark.read.schema(T.StructType(fields))
            .option("multiLine", multiline)
            .option("basePath", path)
            .option("ignoreMissingFiles", "true")
            .json(path)
        )
        df = _newest_generation(df if dates is None else df.where(F.col("date").isin(dates)), complete_generations(spark, path))
    names = [f.name for f in schemas.BRONZE_BOOKING.fields]
    return df.select(*names, schemas.CORRUPT, F.col("channel").alias("channel_part"), F.col("date").alias("date_part"))


def complete_generations(spark: SparkSession, path: str) -> dict[tuple[str, str], int]:
    """(channel, date) -> upto of the newest complete generations: one listing of folder names, as
    many as days were compacted for each channel."""
    fs, p = _fs_path(spark, path)
    plain = spark.sparkContext._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.unescapePathName
    found: dict[tuple[str, str], int] = {}
    for st in fs.globStatus(spark.sparkContext._jvm.org.apache.hadoop.fs.Path(p, f"channel=*/date=*/batch={GENERATION}*/_SUCCESS")) or []:
        channel, date, batch = (part.split("=", 1)[1] for part in st.getPath().getParent().toString().split("/")[-3:])
        key, upto = (plain(channel), plain(date)), int(batch[len(GENERATION):])
        found[key] = max(found.get(key, upto), upto)
    return found


def _newest_generation(df: DataFrame, generations: dict[tuple[str, str], int]) -> DataFrame:
    compacted = F.coalesce(F.col("batch").startswith(GENERATION), F.lit(False))
    if not generations:
        return df.where(~compacted)
    newest = df.sparkSession.createDataFrame([(*k, n) for k, n in generations.items()], "channel string, date string, upto long")
    number = F.regexp_replace("batch", f"^{GENERATION}", "").try_cast("long")
    joined = df.join(newest, ["channel", "date"], "left")
    keep = F.when(compacted, number == F.col("upto")).otherwise(F.col("upto").isNull() | F.coalesce(number > F.col("upto"), F.lit(True)))
    return joined.where(F.coalesce(keep, F.lit(False)))


def read_bronze_spend(spark: SparkSession, path: str, multiline: bool = True, dates: list[str] | None = None) -> DataFrame:
    """Bronze spend JSON, either ``{records: [...], metadata}`` documents or bare records,
    as spend records. Of ``dates``, only their folders are listed and read. A document that does
    not parse is a row with only ``_corrupt_record``."""
    fields = [*schemas.BRONZE_SPEND.fields, T.StructField(schemas.CORRUPT, T.StringType())]
    if not path_exists(spark, path) or dates == []:
        return spend_records(spark.createDataFrame([], T.StructType(fields)))
    df = (
        spark.read.schema(T.StructType(fields))
        .option("multiLine", multiline)
        .option("recursiveFileLookup", "true")
        .option("ignoreMissingFiles", "true")
        .json(path if dates is None else [f"{path.rstrip('/')}/channel=*/date={d}" for d in dates])
    )
    return spend_records(df)


def spend_records(df: DataFrame) -> DataFrame:
    """Rows of a bronze spend scan (batch or micro-batch) as spend records: the ``records`` of
    ``{records, metadata}`` documents, and bare records as they are (P4), in one pass."""
    bare = F.array(F.struct(*[F.col(f.name) for f in schemas.SPEND_RECORD.fields]))
    if schemas.CORRUPT not in df.columns:
        return df.select(F.explode(F.coalesce("records", bare)).alias("_r")).select("_r.*")
    return df.select(F.explode(F.coalesce("records", bare)).alias("_r"), schemas.CORRUPT).select("_r.*", schemas.CORRUPT)


def read_silver(spark: SparkSession, path: str, columns: dict[str, str] | None = None) -> DataFrame:
    """A silver table (Parquet, partitioned) with its kept schema, so no file footers are
    read to find columns added by later upserts. ``columns`` (name -> type) prunes the scan; a
    table without data, or not there yet, gives no rows of those types."""
    if columns and not table_exists(spark, path):
        return spark.createDataFrame([], ", ".join(f"{n} {t}" for n, t in columns.items()))
    df = spark.read.schema(read_schema(spark, path)).parquet(path)
    return df.select(*columns) if columns else df


def spend_file_paths(spark: SparkSession, source_dir: str, dates: list[str] | None = None) -> list[tuple[str, bool]]:
    """(path, empty) of the files (or folders of parts) named ``spend_data_<date>.json`` directly
    under the source folder, of the given dates if any: one listing. A date without a file is
    skipped (S19)."""
    fs, p = _fs_path(spark, source_dir)
    if not fs.exists(p):
        return []
    named = [(st, re.search(r"spend_data_(\d{4}-\d{2}-\d{2})\.json$", st.getPath().getName())) for st in fs.listStatus(p)]
    wanted = set(dates) if dates else None
    return sorted((st.getPath().toString(), st.isFile() and st.getLen() == 0) for st, m in named if m and (wanted is None or m[1] in wanted))


def read_spend_files(spark: SparkSession, source_dir: str, dates: list[str] | None = None) -> DataFrame:
    """Daily source files (JSON arrays) as (source_file, part, body, error, fields): a
    row for each element of an array, ``part`` being the path of the file it is in, with every field
    of the source and its own type as a map of variants;
    a file that is no array gives its text in parts, each with an error, and an element that is no
    object its text with an error. A bad file or record never takes others with it. A record is
    the largest thing a task holds of a file, and is parsed once; a task gets
    a bounded number of bytes (or one file)."""
    schema = "source_file string, part string, body string, error string, fields map<string,variant>"
    paths = spend_file_paths(spark, source_dir, dates)
    if not paths:
        return spark.createDataFrame([], schema)
    pieces = read_pieces(spark, [p for p, _ in paths])
    size = sum(_fs_path(spark, p)[0].getContentSummary(_fs_path(spark, p)[1]).getLength() for p, _ in paths)
    elements = array_elements(pieces.repartition(splits_for(pieces, size, BYTES_A_SPLIT), "path"))
    nothing = spark.createDataFrame([(p, False, "") for p, empty in paths if empty], "path string, whole boolean, element string")
    rows = elements.select("path", "whole", "element").unionByName(nothing)
    parsed = F.when(F.col("whole"), F.from_json("element", "map<string,variant>"))
    rows = compute_once(rows, "fields", parsed)
    error = F.when(~F.col("whole"), BAD_ARRAY).when(F.col("fields").isNull(), BAD_OBJECT)
    name = F.regexp_extract("path", r"(spend_data_\d{4}-\d{2}-\d{2}\.json)(/.*)?$", 1)
    return rows.select(name.alias("source_file"), F.col("path").alias("part"), F.when(error.isNotNull(), F.coalesce("element", F.lit("null"))).alias("body"), error.alias("error"), "fields")


def spend_fields(rows: DataFrame) -> DataFrame:
    """Readable elements of ``read_spend_files``: date and channel as text beside the fields."""
    text = lambda k: F.try_element_at("fields", F.lit(k)).cast("string").alias(k)
    return rows.where(F.col("error").isNull()).select("source_file", "part", text("date"), text("channel"), "fields")


def lookback_dates(as_of: str | dt.date, days: int = 30) -> list[str]:
    """O5 fallback list for S17: the ``days`` dates ending at ``as_of`` (a bounded list of
    file names, not data)."""
    end = as_of if isinstance(as_of, dt.date) else dt.date.fromisoformat(as_of)
    return [(end - dt.timedelta(days=i)).isoformat() for i in range(days)]


def read_booking_stream(
    spark: SparkSession,
    path: str,
    max_files_per_trigger: int | None = 100,
    latest_first: bool = False,
    max_file_age: str | None = None,
) -> DataFrame:
    """Booking envelopes arriving as JSON files (one record per line), at most
    ``max_files_per_trigger`` in a micro-batch (None: all there are). Every file is read, whatever
    its modification time, unless ``max_file_age`` is given."""
    stream = (
        spark.readStream.schema(schemas.STREAM_RECORD)
        .option("latestFirst", latest_first)
        .option("maxFileAge", max_file_age or NO_AGE_LIMIT)
    )
    if max_files_per_trigger is not None:
        stream = stream.option("maxFilesPerTrigger", max_files_per_trigger)
    return stream.json(path)
