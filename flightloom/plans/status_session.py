"""Reads and row changes of a status log, as an external engine would do them."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flightloom.functions.columns import utc_literal
from flightloom.operators.mutation import (
    delete_like_statement,
    delete_where,
    merge_statement,
    merge_update,
)
from flightloom.operators.status import PENDING, TEST_NAMES, named_like
from flightloom.schemas import STATUS
from flightloom.session import settle
from flightloom.sources.tables import CatalogTable, KeyedTable

FILE_NAME = "input_file_name"
UPDATED = ("status", "status_msg", "file_processed_dt")


def query_latest(log: DataFrame) -> DataFrame:
    """SQL text over the log: newest first."""
    return log.sparkSession.sql(
        """
        SELECT input_file_name, status, file_processed_dt
        FROM {log}
        ORDER BY file_processed_dt DESC, input_file_name
        """,
        log=log,
    )


def pending_rows(log: DataFrame, files: Sequence[tuple], now: datetime | str) -> DataFrame:
    """Rows for (path, name, hash, output, message) tuples, in the log's schema."""
    names = [n for n in STATUS.names if n not in ("status", "file_processed_dt")]
    given = log.sparkSession.createDataFrame(list(files), ", ".join(f"{n} string" for n in names))
    stamped = given.withColumns({"status": F.lit(PENDING), "file_processed_dt": utc_literal(now)})
    return stamped.select(*STATUS.names)


def status_table(table: CatalogTable) -> KeyedTable:
    """The status log as a table whose rows can be changed by file name."""
    return KeyedTable(table.spark, table.name, FILE_NAME, table.format)


def update_status(table: KeyedTable, changes: DataFrame) -> None:
    """``changes`` has the file name and the updated columns. A catalog that can change rows runs
    MERGE; elsewhere the buckets of the changed names are written anew."""
    if table.row_level:
        changes.createOrReplaceTempView("status_changes")
        statement = merge_statement(table.name, "status_changes", FILE_NAME, UPDATED)
        table.spark.sql(statement)
    else:
        changes = settle(changes, "status-changes")
        table.change(lambda _: changes, lambda rows: merge_update(rows, changes, FILE_NAME, UPDATED))


def delete_test_rows(table: KeyedTable, pattern: str = TEST_NAMES) -> int:
    """Delete rows by name pattern; returns how many are left, which is 0."""
    if table.row_level:
        statement = delete_like_statement(table.name, FILE_NAME)
        table.spark.sql(statement, {"pattern": pattern})
    else:
        gone = F.col(FILE_NAME).like(pattern)
        table.change(lambda rows: rows.filter(gone), lambda rows: delete_where(rows, gone))
    return named_like(table.read(), pattern).count()
