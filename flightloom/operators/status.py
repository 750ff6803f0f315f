"""The status log: one row per processed file, and reads of it."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flightloom.functions.columns import file_name_of, short_message, utc_literal
from flightloom.schemas import STATUS

# States, the name pattern of test rows, and below the texts of messages.
COMPLETED, FAILED, PENDING = "Completed", "Failed", "Pending"
TEST_NAMES = "pyspark_%"  # `_` stands for any one character
LITERAL_TEST_NAMES = r"pyspark\_%"


def status_rows(files: DataFrame, now: datetime | str) -> DataFrame:
    """Status rows from (relative_path, output_file_path, n_rows, fault) per file.

    A file with a fault is Failed, has no output and keeps the first 500 characters of the fault.
    """
    failed = F.col("fault").isNotNull()
    done = F.concat(
        F.lit("Processed "),
        F.col("n_rows").cast("string"),
        F.lit(" rows | "),
        F.col("output_file_path"),
    )
    values = {
        "file_relative_path": F.col("relative_path"),
        "input_file_name": file_name_of(F.col("relative_path")),
        "input_file_hash_rel": F.md5("relative_path"),
        "output_file_path": F.when(failed, "").otherwise(F.col("output_file_path")),
        "status": F.when(failed, FAILED).otherwise(COMPLETED),
        "status_msg": F.when(failed, short_message(F.col("fault"))).otherwise(done),
        "file_processed_dt": utc_literal(now),
    }
    return files.select(*[values[f.name].cast(f.dataType).alias(f.name) for f in STATUS.fields])


def result_messages(files: DataFrame) -> DataFrame:
    """One result line per file from (file_name, output_name, n_rows, n_columns, fault)."""
    ok = F.concat_ws(
        "",
        F.lit("SUCCESS: "), "file_name", F.lit(" -> "), "output_name",
        F.lit(" | Rows: "), "n_rows", F.lit(" | Params: "), "n_columns",
    )
    bad = F.concat_ws(
        "", F.lit("FAILED: "), "file_name", F.lit(" | Error: "), short_message(F.col("fault"))
    )
    return files.withColumn("message", F.when(F.col("fault").isNull(), ok).otherwise(bad))


def with_status(log: DataFrame, status: str = COMPLETED) -> DataFrame:
    return log.filter(F.col("status") == status)


def named_like(log: DataFrame, pattern: str = TEST_NAMES) -> DataFrame:
    return log.filter(F.col("input_file_name").like(pattern))


def named(log: DataFrame, name: str | Column) -> DataFrame:
    return log.filter(F.col("input_file_name") == name).select(
        "input_file_name", "status", "status_msg", "file_processed_dt"
    )


def latest_first(log: DataFrame) -> DataFrame:
    """Newest first; file names break ties so that the order is fixed."""
    return log.select("input_file_name", "status", "file_processed_dt").orderBy(
        F.desc("file_processed_dt"), "input_file_name"
    )


def preview(df: DataFrame, rows: int = 20) -> DataFrame:
    return df.limit(rows)
