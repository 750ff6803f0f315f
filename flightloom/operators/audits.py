"""Checks of facts the tables declare and Spark does not enforce."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def duplicate_flights(bronze: DataFrame) -> DataFrame:
    """Flight ids that occur more than once."""
    counted = bronze.groupBy("flight_id").agg(F.count(F.lit(1)).alias("n_rows"))
    return counted.filter(F.col("n_rows") > 1)


def orphan_flights(table: DataFrame, bronze: DataFrame) -> DataFrame:
    """Flight ids (with row counts) that have no metadata. NULL refers to nothing."""
    counted = (
        table.filter(F.col("flight_id").isNotNull())
        .groupBy("flight_id")
        .agg(F.count(F.lit(1)).alias("n_rows"))
    )
    return counted.join(bronze.select("flight_id").distinct(), "flight_id", "left_anti")


def name_collisions(metadata: DataFrame) -> DataFrame:
    """Output names that more than one file would write."""
    counted = metadata.groupBy("output_name").agg(
        F.count(F.lit(1)).alias("n_files"),
        F.min("flight_id").alias("first_flight"),
        F.max("flight_id").alias("last_flight"),
    )
    return counted.filter(F.col("n_files") > 1)


def table_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """One row per table."""
    return reduce(
        DataFrame.unionByName,
        [
            df.agg(F.count(F.lit(1)).alias("n_rows")).select(
                F.lit(name).alias("table_name"), "n_rows"
            )
            for name, df in tables.items()
        ],
    )
