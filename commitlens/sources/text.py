"""Text lines with their position, whole files, and file listings."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """One row per line with ``file`` and an order key ``line`` that follows the file's byte order.

    Splittable: large files are read by many tasks. ``line`` is (split start, then a per-task increasing id), so
    ordering by (file, line) is the file order without a whole file in one row.
    """
    df = spark.read.text(path)
    return df.select(
        "value",
        F.col("_metadata.file_path").alias("file"),
        (F.col("_metadata.file_block_start").cast("decimal(38,0)") * F.lit(1 << 40)
         + F.monotonically_increasing_id().cast("decimal(38,0)") % F.lit(1 << 33)).alias("line"),
    )


def read_files_in_order(spark: SparkSession, path: str) -> DataFrame:
    """Many text files read in name order (``cat *.txt``): one row per file, ``file`` is
    the full path, unique across folders, and sorts like the glob.

    One row holds one whole file (a chapter), which is what tells whether a file ends with a newline (needed for the
    ``cat`` gluing of ``join_files=True``). For large files use :func:`read_lines`: it is splittable, and word and
    sentence questions give the same per-line results on it, since neither words nor sentences cross a newline.
    """
    df = spark.read.text(path, wholetext=True)
    return df.select(F.col("_metadata.file_path").alias("file"), F.col("value").alias("text"))


def list_files(spark: SparkSession, path: str, name_glob: str | None = None) -> DataFrame:
    """File inventory (``ls -l`` / ``find -name``): path, length, modification time; contents never read."""
    r = spark.read.format("binaryFile").option("recursiveFileLookup", True)
    if name_glob:
        r = r.option("pathGlobFilter", name_glob)
    return r.load(path).select("path", "length", "modificationTime")
