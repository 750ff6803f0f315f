"""Bronze: flight metadata from the recording's attributes."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flightloom.functions.columns import (
    cast_list,
    micros_from_seconds,
    ntz_from_micros,
    output_name,
    utc_literal,
)
from flightloom.schemas import BRONZE

# Attribute name -> metadata column.
TEXT_ATTRIBUTES = {
    "FlightNumber": "flight_number",
    "AircraftTail": "aircraft_tail",
    "AircraftType": "aircraft_type",
    "DepartureAirport": "departure_airport",
    "ArrivalAirport": "arrival_airport",
}
NUMERIC_ATTRIBUTES = ("FlightDepartureUTC_epoch", "RecordedDataSeconds")


def flight_metadata(attrs: DataFrame) -> DataFrame:
    """Absent text is '', an absent time is the epoch, an absent length is 0 seconds."""
    micros = micros_from_seconds(F.col("FlightDepartureUTC_epoch"))
    carried = [c for c in attrs.columns if c not in (*TEXT_ATTRIBUTES, *NUMERIC_ATTRIBUTES)]
    return attrs.select(
        *carried,
        *[F.coalesce(F.col(a), F.lit("")).alias(c) for a, c in TEXT_ATTRIBUTES.items()],
        micros.alias("flight_departure_dttm"),
        ntz_from_micros(micros).alias("flight_departure_utc"),
        F.coalesce(F.col("RecordedDataSeconds"), F.lit(0)).cast("int").alias(
            "qar_recorded_data_seconds"
        ),
    ).withColumn("flight_date", F.to_date("flight_departure_utc"))


def with_output_name(metadata: DataFrame) -> DataFrame:
    return metadata.withColumn(
        "output_name",
        output_name(
            F.col("aircraft_tail"),
            F.col("flight_number"),
            F.col("departure_airport"),
            F.col("arrival_airport"),
            F.col("flight_departure_utc"),
        ),
    )


def bronze_rows(metadata: DataFrame, now: datetime | str) -> DataFrame:
    stamped = metadata.withColumns(
        {"created_date": utc_literal(now), "updated_date": utc_literal(now)}
    )
    return stamped.selectExpr(*cast_list(BRONZE))
