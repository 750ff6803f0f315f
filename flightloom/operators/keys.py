"""Which flights are new, and the rows that belong to them."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flightloom.session import BROADCAST_ROWS, fits_broadcast


def distinct_flights(table: DataFrame) -> DataFrame:
    return table.select("flight_id").distinct()


def new_flights(silver: DataFrame, gold: DataFrame | None) -> DataFrame:
    """Flight ids in Silver and not in Gold; all of them if there is no Gold table yet.

    Both sides are reduced to distinct ids before they meet. A NULL id belongs to no flight.
    """
    candidates = distinct_flights(silver.filter(F.col("flight_id").isNotNull()))
    if gold is None:
        return candidates
    return candidates.join(distinct_flights(gold), "flight_id", "left_anti")


def rows_of(table: DataFrame, flights: DataFrame, broadcast_rows: int = BROADCAST_ROWS) -> DataFrame:
    """Rows of the given distinct flights, which should be settled.

    A bounded id list (counted, not estimated) is broadcast, so the table is filtered where it is read and never
    shuffled.
    """
    small = fits_broadcast(flights, broadcast_rows)
    return table.join(F.broadcast(flights) if small else flights, "flight_id", "left_semi")
