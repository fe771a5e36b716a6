"""Source-file listings (P18): names of daily spend files and their dates."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from slotflow.functions.text import has_prefix_suffix

# Daily spend files are named spend_data_YYYY-MM-DD.json.
SPEND_FILE_PREFIX = "spend_data_"
SPEND_FILE_SUFFIX = ".json"
SPEND_FILE_DATE = r"^spend_data_(\d{4}-\d{2}-\d{2})\.json$"
INDEX_FILE = "file_index.json"


def source_dates(names: DataFrame, name_col: str = "file_name") -> DataFrame:
    """Keep spend file names (prefix/suffix test, F25) and parse their date."""
    kept = names.filter(has_prefix_suffix(F.col(name_col), SPEND_FILE_PREFIX, SPEND_FILE_SUFFIX))
    day = F.regexp_extract(F.col(name_col), SPEND_FILE_DATE, 1)
    return kept.select(F.col(name_col).alias("file_name"), F.try_to_date(day, "yyyy-MM-dd").alias("file_date"))


def list_files(spark: SparkSession, directory: str, pattern: str = "*") -> DataFrame:
    """Names of the files under ``directory`` (a distributed listing: the binaryFile source
    with a path glob; file contents are not read because only the path column is selected)."""
    df = spark.read.format("binaryFile").option("pathGlobFilter", pattern).option("recursiveFileLookup", "true").load(directory)
    return df.select(F.element_at(F.split(F.col("path"), "/"), -1).alias("file_name"), F.col("path"))


def list_source_dates(spark: SparkSession, directory: str) -> DataFrame:
    """P18 over a real directory; a file may be a folder of parts."""
    paths = spark.createDataFrame([(x,) for x in _entries(spark, directory)], "file_name string")
    name = F.regexp_extract("file_name", r"(spend_data_[^/=]*\.json)$", 1)
    return source_dates(paths.select(name.alias("file_name")).where("file_name <> ''").distinct())


def _entries(spark: SparkSession, directory: str) -> list[str]:
    """Names directly under a folder (one listing: metadata)."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(directory)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return [st.getPath().getName() for st in fs.listStatus(p)] if fs.exists(p) else []


def read_file_index(spark: SparkSession, index_path: str) -> DataFrame:
    """The source's file index document ``{"files": [name, ...]}`` as one row per name. A
    missing or unreadable index gives no rows (the caller falls back to a date spine)."""
    from pyspark.sql import types as T

    schema = T.StructType([T.StructField("files", T.ArrayType(T.StringType()))])
    idx = (
        spark.read.schema(schema)
        .option("multiLine", "true")
        .option("ignoreMissingFiles", "true")
        .option("mode", "PERMISSIVE")  # an index that does not parse has null files
        .json(index_path)
    )
    return idx.select(F.explode("files").alias("file_name"))
