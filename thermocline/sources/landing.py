"""Landed text: whole files as rows, and files split into numbered lines.

Feeds arrive as files in a landing folder (one per station, document, float
list, ...). Spark reads them in parallel; the driver never opens one. Lines are read by
byte range (a file may be larger than a task), documents (JSON, XML) a file at a time.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T


def read_landed_text(spark: SparkSession, path: str) -> DataFrame:
    """(file, value): each file under ``path`` (a folder, searched recursively,
    or a glob) as one row."""
    reader = spark.read.option("recursiveFileLookup", "true")
    return reader.text(path, wholetext=True).select(F.col("_metadata.file_path").alias("file"), "value")


def landed_lines(text: DataFrame) -> DataFrame:
    """(file, line_no, line) from (file, value); line_no counts from 0, a trailing
    newline does not make an extra line, and CR of CRLF endings is removed."""
    body = F.regexp_replace(F.col("value"), r"\r?\n$", "")
    exploded = text.select("file", F.posexplode(F.split(body, r"\r?\n")).alias("line_no", "line"))
    return exploded.withColumn("line_no", F.col("line_no").cast("long"))


def read_landed_lines(spark: SparkSession, path: str, numbered: bool = True) -> DataFrame:
    """(file, line_no, line) for every file under ``path`` (a folder, searched recursively, or a glob).
    Without ``numbered`` the same lines as (file, line): read once and without a shuffle.

    Files are read by byte range, so one large file is read by many tasks. A range's lines come in
    order and are numbered as they are read; a count of lines for each (file, range), one row a range,
    says how many lines of the file stand before it. Lines end at LF, CRLF or CR; a trailing one makes
    no extra line. The numbers hold for one reading of the folder: files that change meanwhile break them.
    """
    # The row id is not deterministic in Spark's sense, so no filter on the result reaches the
    # scans below it: both branches read the same ranges in the same tasks and agree on the ids.
    text, file = spark.read.option("recursiveFileLookup", "true").text(path), F.col("_metadata.file_path").alias("file")
    if not numbered:
        return text.select(file, F.col("value").alias("line"))
    raw = text.select(
        file, F.col("_metadata.file_block_start").alias("_from"),
        F.monotonically_increasing_id().alias("_id"), F.col("value").alias("line"),
    )
    ranges = raw.groupBy("file", "_from").agg(F.min("_id").alias("_first"), F.count(F.lit(1)).alias("_n"))
    before = F.sum("_n").over(Window.partitionBy("file").orderBy("_from").rowsBetween(Window.unboundedPreceding, -1))
    ranges = ranges.withColumn("_before", F.coalesce(before, F.lit(0)))
    line_no = (F.col("_before") + F.col("_id") - F.col("_first")).alias("line_no")
    return raw.join(ranges, ["file", "_from"]).select("file", line_no, "line")


def file_stem(file_col: str = "file") -> F.Column:
    """Base name of a path without its extension (e.g. a station id)."""
    return F.regexp_extract(F.col(file_col), r"([^/]+?)(\.[^./]*)?$", 1)


def require_rows(df: DataFrame, message: str) -> DataFrame:
    """Raise ``message`` when ``df`` has no rows (one tiny job: ``isEmpty``)."""
    if df.isEmpty():
        raise ValueError(message)
    return df


def read_landed_table(spark: SparkSession, path: str, schema: T.StructType, fmt: str = "parquet") -> DataFrame:
    """A landed table with ``schema``'s columns, matched by *name*.

    Parquet/ORC/JSON are read with the schema (columns resolve by name; absent
    ones are NULL). CSV is read with its header as text and each schema column is
    ``try_cast`` from the same-named header column (NULL when absent), because a
    CSV reader given a schema would apply it by position.
    """
    if fmt != "csv":
        return spark.read.schema(schema).format(fmt).load(path)
    raw = spark.read.option("header", "true").csv(path)
    have = {c.lower(): c for c in raw.columns}
    cols = [
        (F.col(have[f.name.lower()]).try_cast(f.dataType) if f.name.lower() in have else F.lit(None).cast(f.dataType))
        .alias(f.name)
        for f in schema.fields
    ]
    return raw.select(*cols)
