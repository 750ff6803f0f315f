"""Row-level changes as DataFrame transforms, and as SQL for catalogs that support them."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def merge_update(
    target: DataFrame, source: DataFrame, key: str, columns: Sequence[str]
) -> DataFrame:
    """Update ``columns`` of every target row whose key is in the source.

    Source rows without a match are ignored and NULL keys never match. A target row that meets
    more than one source row fails the query. The source is reduced to one row per key first, so
    the target rows are never multiplied.
    """
    changes = source.groupBy(key).agg(
        F.count(F.lit(1)).alias("_n"),
        *[F.first(c).alias(f"_new_{c}") for c in columns],
    )
    ambiguous = F.raise_error(F.concat_ws(" ", F.lit("several source rows for"), F.col(key)))
    updated = {
        c: F.when(F.col("_n").isNull(), F.col(c))
        .when(F.col("_n") == 1, F.col(f"_new_{c}"))
        .otherwise(ambiguous)
        .alias(c)
        for c in columns
    }
    return target.join(changes, key, "left").select(
        *[updated.get(c, F.col(c)) for c in target.columns]
    )


def delete_where(table: DataFrame, predicate: Column) -> DataFrame:
    """Rows that stay; where the predicate is NULL the row stays."""
    return table.filter(~F.coalesce(predicate, F.lit(False)))


def merge_statement(table: str, source: str, key: str, columns: Sequence[str]) -> str:
    """MERGE for a catalog with row-level operations; ``source`` is a view or table name."""
    sets = ", ".join(f"t.{c} = s.{c}" for c in columns)
    return (
        f"MERGE INTO {table} t USING {source} s ON t.{key} = s.{key} "
        f"WHEN MATCHED THEN UPDATE SET {sets}"
    )


def delete_like_statement(table: str, column: str) -> str:
    """DELETE with the pattern as the named parameter ``:pattern``."""
    return f"DELETE FROM {table} WHERE {column} LIKE :pattern"
