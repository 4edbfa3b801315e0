"""Line-oriented sources: catalogue text directories and whole documents."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F


# File suffixes of compression codecs Hadoop cannot split (one task per file).
NON_SPLITTABLE_SUFFIXES = (".gz", ".zst", ".lz4", ".snappy", ".deflate")


def _directly_in(spark: SparkSession, path: str):
    """Condition on ``_metadata.file_path``: files of the folder itself (any file for a single
    file or a pattern)."""
    jvm = spark._jvm
    where = jvm.org.apache.hadoop.fs.Path(path)
    if any(c in path for c in "*?[{"):
        return F.lit(True)
    fs = where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not fs.getFileStatus(where).isDirectory():
        return F.lit(True)
    root = fs.makeQualified(where).toUri().getRawPath().rstrip("/") + "/"
    file = F.regexp_replace(F.col("_metadata.file_path"), "^[^:/]+:(//[^/]*)?", "")
    return F.regexp_replace(file, "[^/]+$", "") == root


def read_raw_lines(spark: SparkSession, path: str, spread_unsplittable: bool = True
                   ) -> DataFrame:
    """Every line of every regular file directly in ``path`` -> ``(filename, raw_line)``.

    Splittable: large plain (or bzip2) files are read by many tasks. CR, LF and CRLF all end
    a line and trailing spaces are kept. Spark skips files whose names start with ``.`` or
    ``_``. Folders below ``path``, whatever their names, are not read and don't change which
    files are. A file in a codec that cannot be split is decompressed by a single task; these
    files are scanned apart and only their lines are rebalanced, so the per-line work of one
    big compressed file does not stay in that task and other files are read without an exchange.
    """
    files = spark.read.option("recursiveFileLookup", "true").text(path).where(_directly_in(spark, path))
    name = F.lower(F.col("_metadata.file_name"))
    packed = F.lit(False)
    for suffix in NON_SPLITTABLE_SUFFIXES:
        packed = packed | name.endswith(suffix)

    def lines(part: DataFrame) -> DataFrame:
        return part.select(F.col("_metadata.file_name").alias("filename"),
                           F.col("value").alias("raw_line"))

    if not spread_unsplittable:
        return lines(files)
    return lines(files.where(~packed)).union(lines(files.where(packed)).hint("rebalance"))


def read_whole_text(spark: SparkSession, path: str) -> DataFrame:
    """Each file as one row ``(path, value)`` — for small documents such as a boundary file."""
    return (spark.read.text(path, wholetext=True)
            .select(F.col("_metadata.file_path").alias("path"), "value"))
