"""Large JSON arrays as rows (S17, S19): files are cut at record borders, so that no task holds
more of a file than one record.

A file is read as pieces that end at closing braces (the text reader's line separator), wherever
its splits lie. Running sums over the pieces of a file tell which of these braces are text, how deep
the others lie and so which of them end an element of the root array; the pieces of one element are
joined again, and only they are ever one value. The windows are sorted, streamed and spilled.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

CLOSE = "}"


def _count(text: Column, char: str) -> Column:
    return F.length(text) - F.length(F.replace(text, F.lit(char), F.lit("")))


def read_pieces(spark: SparkSession, paths: list[str]) -> DataFrame:
    """(path, size, block, at, value): the pieces of each file, and their order."""
    pieces = spark.read.option("lineSep", CLOSE).option("recursiveFileLookup", "true").text(paths)
    return pieces.select(
        F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_size").alias("size"), F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("at"), "value",
    )


def array_elements(pieces: DataFrame) -> DataFrame:
    """(path, element, whole): the elements of each file's root array with their JSON text, one row
    each. Of a file that is no JSON array ``whole`` is false and the rows are its text in parts, in
    the order of ``number``. An empty array has no rows, an empty file no pieces."""
    in_file = Window.partitionBy("path").orderBy("block", "at")
    before = in_file.rowsBetween(Window.unboundedPreceding, -1)
    all_of = Window.partitionBy("path")
    # Escaped characters are neither quotes nor brackets; no piece ends within an escape.
    plain = F.when(F.contains("value", F.lit("\\")), F.regexp_replace("value", r"(?s)\\.", "")).otherwise(F.col("value"))
    upto = in_file.rowsBetween(Window.unboundedPreceding, 0)
    p = pieces.withColumns({"plain": plain, "quotes": _count(plain, '"'), "last": F.lead("at").over(in_file).isNull(),
                            "closed": F.sum(F.octet_length("value") + 1).over(upto) <= F.col("size")})  # a brace follows
    p = p.withColumn("inside", F.coalesce(F.sum("quotes").over(before), F.lit(0)) % 2 == 1)
    outside = F.regexp_replace(F.when(F.col("inside"), F.regexp_replace("plain", '(?s)^[^"]*("|$)', "")).otherwise(F.col("plain")), '"[^"]*("|$)', "")
    p = p.withColumns({"ends_inside": (F.col("inside").cast("int") + F.col("quotes")) % 2 == 1, "outside": outside}).drop("plain")
    closes = (F.col("closed") & ~F.col("ends_inside")).cast("int")
    p = p.withColumn("delta", _count(F.col("outside"), "{") + _count(F.col("outside"), "[") - _count(F.col("outside"), "]") - closes)
    p = p.withColumn("depth", F.sum("delta").over(upto))
    border = (closes == 1) & (F.col("depth") <= 1)
    p = p.withColumns({"border": border, "number": F.coalesce(F.sum(border.cast("long")).over(before), F.lit(0))})
    text = F.concat("value", F.when(F.col("closed"), CLOSE).otherwise(""))
    parts = p.groupBy("path", "number").agg(
        F.sort_array(F.collect_list(F.struct("block", "at", text.alias("text")))).alias("parts"),
        F.max("last").alias("last"), F.min("depth").alias("low"),
        F.max(F.when(F.col("last"), F.col("depth"))).alias("depth"), F.max(F.when(F.col("last"), F.col("ends_inside"))).alias("open"),
    )
    parts = parts.withColumn("text", F.array_join(F.transform("parts", lambda x: x["text"]), "")).drop("parts")
    # what stands between the root's brackets and commas: the first part opens the array, the others
    # follow a comma, the last one closes it
    begins = F.when(F.col("number") == 0, F.col("text").rlike(r"^\s*\[")).otherwise(F.col("text").rlike(r"^\s*,"))
    ends = ~F.col("last") | (F.col("text").rlike(r"\]\s*$") & (F.col("depth") == 0) & ~F.col("open"))
    bare_end = F.col("last") & (F.col("number") > 0) & F.col("text").rlike(r"^\s*\]\s*$")
    inner = F.regexp_replace(F.when(F.col("last"), F.regexp_replace("text", r"\]\s*$", "")).otherwise(F.col("text")), r"^\s*[\[,]", "")
    blank = F.col("last") & (F.col("number") > 0) & ~inner.rlike(r"\S")  # the others end with a brace
    read = F.from_json(F.concat(F.lit('{"r":['), inner, F.lit("]}")), "r array<string>, bad string", {"columnNameOfCorruptRecord": "bad", "allowSingleQuotes": "false"})
    parts = parts.select("path", "number", "text", (bare_end & ends).alias("bare_end"), (begins & ends & ~blank & ((F.col("low") >= 1) | F.col("last"))).alias("fits"),
                         F.explode_outer(F.array(F.when(bare_end, F.lit(None)).otherwise(read))).alias("read"))
    fits = F.col("bare_end") | (F.col("fits") & F.col("read.bad").isNull() & F.col("read.r").isNotNull())
    parts = parts.withColumn("whole", F.min(fits).over(all_of))
    rows = F.when(~F.col("whole"), F.array("text")).otherwise(F.coalesce("read.r", F.array().cast("array<string>")))
    return parts.select("path", "number", "whole", F.explode(rows).alias("element"))

