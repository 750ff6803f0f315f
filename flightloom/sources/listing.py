"""Directory listings."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def list_files(spark: SparkSession, folder: str, pattern: str = "*") -> DataFrame:
    """Files under ``folder``: path below it, url, time, etag and size. Contents are not read.

    There is no etag on a plain file system; a hash of path, time and size changes with the file.
    Spark leaves out files of size 0, which the work-list would drop anyway.
    """
    found = (
        spark.read.format("binaryFile")
        .option("pathGlobFilter", pattern)
        .option("recursiveFileLookup", "true")
        .load(folder)
    )
    return listed(found, folder)


def qualified(spark: SparkSession, folder: str) -> str:
    """The folder as its file system writes it, which every path below it starts with."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    system = path.getFileSystem(spark._jsc.hadoopConfiguration())
    return system.makeQualified(path).toString().rstrip("/")


def listed(found: DataFrame, folder: str) -> DataFrame:
    """The listing of files (path, modificationTime, length) below ``folder``, also of those that a stream brings."""
    start = F.lit(len(qualified(found.sparkSession, folder)) + 2)
    return found.select(
        F.substr(F.col("path"), start).alias("relative_path"),
        F.col("path").alias("file_url"),
        F.col("modificationTime").alias("last_modified"),
        F.md5(F.concat_ws("|", "path", "modificationTime", "length")).alias("etag"),
        F.col("length").alias("size"),
    )
