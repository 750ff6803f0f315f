"""Scalar expressions used across the operators. All of them compile to JVM code."""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from flightloom.schemas import SIGNAL_COLUMNS

# What a text signal keeps, the time format in output names, the message limit.
TEXT_STRIP_PATTERN = "[^A-Z0-9-]"
NAME_TIME_FORMAT = "yyyyMMddHHmmss"
MESSAGE_LIMIT = 500


def utc_literal(moment: datetime | str) -> Column:
    """A TIMESTAMP_NTZ constant; aware datetimes are moved to UTC first."""
    if isinstance(moment, datetime):
        if moment.tzinfo is not None:
            moment = moment.astimezone(timezone.utc).replace(tzinfo=None)
        moment = moment.isoformat(sep=" ")
    return F.lit(moment).cast(T.TimestampNTZType())


def ntz_from_micros(micros: Column) -> Column:
    """Epoch microseconds to TIMESTAMP_NTZ, whatever the session time zone is."""
    epoch = F.lit("1970-01-01 00:00:00").cast(T.TimestampNTZType())
    return F.timestamp_add("MICROSECOND", micros, epoch)


def micros_from_seconds(seconds: Column) -> Column:
    """Epoch seconds (NULL counts as 0) to whole microseconds."""
    return F.round(F.coalesce(seconds, F.lit(0)) * F.lit(1_000_000)).cast("long")


# Wind along the flight path: head positive, tail negative.
HEADWIND = "wind_speed * cos(radians(wind_direction - heading_true))"


def headwind() -> Column:
    return F.expr(HEADWIND)


def cast_list(schema: T.StructType) -> list[str]:
    """Select list that puts columns into the order and types of ``schema``."""
    return [f"CAST({f.name} AS {f.dataType.simpleString()}) AS {f.name}" for f in schema.fields]


def file_name_of(path: Column) -> Column:
    return F.element_at(F.split(path, "/"), -1)


def clean_text(value: Column) -> Column:
    """Keep capitals, digits and hyphens; everything else, lower case too, is removed."""
    return F.regexp_replace(value, TEXT_STRIP_PATTERN, "")


def lookup(table: dict[str, str] | dict[str, int], key: Column) -> Column:
    """The table's value for ``key``, NULL where it has none."""
    pairs = ", ".join(f"'{k}', {v!r}" for k, v in table.items())
    return F.try_element_at(F.expr(f"map({pairs})"), key)


def column_for_signal(param: Column) -> Column:
    """The Silver column of a recorded signal; unknown names stay as they are."""
    return F.coalesce(lookup(SIGNAL_COLUMNS, param), param)


def output_name(tail: Column, number: Column, origin: Column, target: Column, departure: Column) -> Column:
    stamp = F.date_format(departure, NAME_TIME_FORMAT)
    return F.concat(F.concat_ws("_", tail, number, origin, target, stamp), F.lit(".parquet"))


def short_message(text: Column) -> Column:
    return F.substring(text, 1, MESSAGE_LIMIT)
