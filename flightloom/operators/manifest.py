"""Work-list: which listed files still have to be read, and under which flight id."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from flightloom.functions.columns import file_name_of

HASH_PREFIX = 4  # hex digits: ids are handed out in 65,536 slices of the hash range


def directory_view(
    listing: DataFrame, target_stage: str = "prepared", source_stage: str = "recordings"
) -> DataFrame:
    """Non-empty files with the hashes that identify them."""
    return listing.filter(F.col("size") > 0).select(
        "relative_path",
        "file_url",
        "last_modified",
        "etag",
        F.md5("relative_path").alias("file_hash_relpath"),
        F.md5("file_url").alias("file_hash_fileurl"),
        "size",
        F.lit(target_stage).alias("target_stage"),
        F.lit(source_stage).alias("source_stage"),
        file_name_of(F.col("relative_path")).alias("file_name"),
    )


def pending_files(view: DataFrame, status: DataFrame, retry_failed: bool = False) -> DataFrame:
    """Files without a status row. A failed file counts as done unless ``retry_failed``."""
    if retry_failed:
        status = status.filter(~F.col("status").eqNullSafe("Failed"))
    done = status.select(F.col("input_file_hash_rel").alias("file_hash_relpath")).distinct()
    return view.join(done, "file_hash_relpath", "left_anti")


def assign_flight_ids(pending: DataFrame, assigned: DataFrame) -> DataFrame:
    """One id per pending file: an id handed out before is kept, new files continue the count.

    New ids follow the order of the path hash. The hash is uniform, so the slices of its range
    are even, each is numbered by its own task, and only the slice totals (at most 65,536 rows)
    are summed up in one place. The result does not depend on how the data was partitioned.
    """
    hashes = pending.select(F.col("file_hash_relpath").alias("input_file_hash_rel")).distinct()
    known = hashes.join(assigned, "input_file_hash_rel")
    new = hashes.join(assigned, "input_file_hash_rel", "left_anti").withColumn(
        "slice", F.substring("input_file_hash_rel", 1, HASH_PREFIX)
    )
    # the highest id so far enters the running sum as a slice before all others
    counts = new.groupBy("slice").agg(F.count("*").alias("ids"))
    last = assigned.agg(F.coalesce(F.max("flight_id"), F.lit(0)).cast("long").alias("ids"))
    earlier = Window.orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.unionByName(last.withColumn("slice", F.lit(""))).select(
        "slice", F.sum("ids").over(earlier).alias("start")
    )
    inside = Window.partitionBy("slice").orderBy("input_file_hash_rel")
    numbered = (
        new.withColumn("place", F.row_number().over(inside))
        .join(F.broadcast(starts), "slice")  # at most 65,536 rows
        .select(
            "input_file_hash_rel",
            (F.col("start") + F.col("place")).cast("int").alias("flight_id"),
        )
    )
    return known.select("input_file_hash_rel", "flight_id").unionByName(numbered)
