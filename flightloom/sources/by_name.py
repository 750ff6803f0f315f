"""Loading by column name into a fixed schema."""

from __future__ import annotations

from collections import defaultdict

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T


class AmbiguousColumns(ValueError):
    """Two source columns differ only in case."""


def _converted(name: str, source: T.DataType, target: T.DataType) -> str:
    column = f"`{name}`"
    # a time that belongs in a LONG column is stored as epoch microseconds, in UTC
    if target == T.LongType() and isinstance(source, T.TimestampNTZType):
        here = f"convert_timezone('UTC', current_timezone(), {column})"
        return f"unix_micros(CAST({here} AS timestamp))"
    if target == T.LongType() and isinstance(source, T.TimestampType):
        return f"unix_micros({column})"
    return f"CAST({column} AS {target.simpleString()})"


def project_by_name(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Target columns taken from ``df`` by case-insensitive name: absent ones become NULL,
    further ones are dropped."""
    found: dict[str, list[T.StructField]] = defaultdict(list)
    for field in df.schema.fields:
        found[field.name.lower()].append(field)
    columns = []
    for target in schema.fields:
        matches = found.get(target.name.lower(), [])
        if len(matches) > 1:
            raise AmbiguousColumns(", ".join(m.name for m in matches))
        if matches:
            source = matches[0]
            value = _converted(source.name, source.dataType, target.dataType)
        else:
            value = f"CAST(NULL AS {target.dataType.simpleString()})"
        columns.append(f"{value} AS `{target.name}`")
    return df.selectExpr(*columns)


def load_by_name(
    spark: SparkSession,
    path: str,
    schema: T.StructType,
    pattern: str = "*.parquet",
    merge_columns: bool = False,
) -> DataFrame:
    """Parquet files below ``path`` in the target schema.

    One footer tells the columns of all files. If files carry different columns, ``merge_columns`` reads the
    footers of all of them.
    """
    files = (
        spark.read.option("pathGlobFilter", pattern)
        .option("recursiveFileLookup", "true")
        .option("mergeSchema", str(merge_columns).lower())
        .parquet(path)
    )
    return project_by_name(files, schema)
