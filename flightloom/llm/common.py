"""Helpers shared by the operators."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
NOT_SPACE = r"[^\x20\x09-\x0D]+"  # a word of the size and shingle contracts


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def whole_text(name: str = "text") -> Column:
    """The text; null counts as empty."""
    return F.coalesce(F.col(name), F.lit(""))


def ascii_lower(text: Column) -> Column:
    """A-Z in lower case, every other character as it is."""
    return F.translate(text, UPPER, UPPER.lower())


def null_safe_key(name: str) -> Column:
    """A string that is never null: 's' and the value, or 'n' for null."""
    return F.coalesce(F.concat(F.lit("s"), F.col(name).cast("string")), F.lit("n"))


def running_start(
    rows: DataFrame, group: list[str], slice_: str, order: list[str], size: str, out: str
) -> DataFrame:
    """Adds ``out``: the sum of ``size`` over all rows of the same group that come before.

    Rows are ordered by ``slice_`` and then by ``order``. Each (group, slice) is summed by its own
    task, so a group with most of the rows is spread over its slices; only the slice totals, a
    bounded number per group, are summed up per group. No column of ``group`` or ``slice_`` may be
    null. ``rows`` is evaluated twice and should be cheap to read. A null size counts as 0.
    """
    keys = [*group, slice_]
    earlier = Window.partitionBy(*group).orderBy(slice_).rowsBetween(Window.unboundedPreceding, -1)
    starts = rows.groupBy(*keys).agg(F.sum(size).alias("__total")).select(
        *keys, F.coalesce(F.sum("__total").over(earlier), F.lit(0)).alias("__before")
    )
    inside = Window.partitionBy(*keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    local = rows.withColumn("__local", F.coalesce(F.sum(size).over(inside), F.lit(0)))
    return (
        local.join(starts, keys)
        .withColumn(out, F.col("__before") + F.col("__local"))
        .drop("__before", "__local")
    )
