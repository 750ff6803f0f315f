"""Pipeline inputs derived from the given tables. The SQL checks derive the same inputs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from flightloom.functions.columns import utc_literal
from flightloom.operators.gold import gold_rows
from flightloom.workload.ranking import running_counts
from flightloom.schemas import FLIGHT_ATTRS, SIGNAL_COLUMNS, SILVER, TEXT_COLUMNS

EARLIER = "2024-06-01 00:00:00"
NOW = "2024-06-02 12:30:00"

# Silver column -> expression on lineitem, the same text in both engines.
TELEMETRY = {
    "flight_id": "CAST(l_suppkey AS INT)",
    "flight_date": "'2024-01-01'",
    "flight_number": "concat('FL-', CAST(l_suppkey % 50 AS STRING))",
    "aircraft_tail": "concat('TL-', CAST(l_suppkey % 10 AS STRING))",
    "aircraft_type": "concat('TYPE-', CAST(l_suppkey % 3 AS STRING))",
    "arrival_airport": "concat('AP', CAST(l_suppkey % 7 AS STRING))",
    "departure_airport": "concat('AP', CAST(l_suppkey % 5 AS STRING))",
    "air_temperature": "15 - l_extendedprice / 1000",
    "airspeed": "100 + l_quantity * 8",
    "attack_angle": "l_quantity / 4",
    "baro_altitude": "l_extendedprice / 2",
    "engine_n1_1": "60 + l_quantity / 2",
    "engine_n1_2": "60 + l_discount * 400",
    "flight_phase": "CAST(l_linenumber AS INT)",
    "fuel_flow_total": "l_extendedprice / 10",
    "ground_speed": "110 + l_quantity * 8",
    "heading_magnetic": "CAST(l_orderkey % 360 AS DOUBLE) - 5",
    "heading_true": "CAST(l_orderkey % 360 AS DOUBLE)",
    "lateral_acceleration": "(l_discount - 0.05) * 4",
    "latitude": "CAST(l_partkey % 180 AS DOUBLE) - 90",
    "longitude": "CAST(l_orderkey % 360 AS DOUBLE) - 180",
    "longitudinal_acceleration": "(l_tax - 0.04) * 2",
    "mach_number": "(100 + l_quantity * 8) / 600",
    "pitch_angle": "l_quantity / 5 - 5",
    "pitch_rate": "(l_tax - 0.04) * 50",
    "radio_altitude": "l_extendedprice / 40",
    "roll_angle": "l_quantity * 2 - 50",
    "total_air_temperature": "20 - l_extendedprice / 1000",
    "vertical_acceleration": "1 + (l_discount - 0.05) * 20",
    "vertical_speed": "(l_quantity - 25) * 100",
    "wind_direction": "CAST(l_partkey % 360 AS DOUBLE)",
    "wind_speed": "l_quantity",
    "yaw_rate": "l_discount * 30 - 1.5",
    "flight_departure_dttm": "1704067200000000 + l_suppkey * 3600000000",
}

# The lines of a flight that are a sample, by rate (base samples to a sample).
RATES = {
    "at_base": "l_linenumber = 1",
    "at_all": "l_linenumber >= 1",  # about seven to one
    "at_n1": "l_linenumber <= 4",  # four to one
    "at_late": "l_linenumber >= 5",  # three to one
    "at_wind": "l_linenumber = 1 AND l_quantity > 25",  # one to two
    "at_tail": "l_linenumber = 7",  # text
}
RATE_OF = {
    "VerticalAcceleration": "at_all",
    **dict.fromkeys(["EngineN1_1", "EngineN1_2", "FuelFlowTotal"], "at_n1"),
    **dict.fromkeys(
        ["LateralAcceleration", "LongitudinalAcceleration", "PitchRate", "RollAngle", "YawRate"], "at_late"
    ),
    **dict.fromkeys(["AirTemperature", "TotalAirTemperature", "WindDirection", "WindSpeed"], "at_wind"),
}
# What is recorded other than the value of the signal's Silver column. Where metrics are
# taken of it, these are whole numbers, halves or quarters, so a mean does not depend on the order of addition.
RECORDED_AS = {
    "AirTemperature": "15 - floor(l_extendedprice / 1000)",
    "BaroAltitude": "floor(l_extendedprice) / 2",
    "EngineN1_2": "60 + round(l_discount * 400)",
    "FuelFlowTotal": "floor(l_extendedprice / 10)",
    "LateralAcceleration": "round(l_discount * 100 - 5) / 2",
    "LongitudinalAcceleration": "round(l_tax * 100 - 4) / 2",
    "PitchRate": "round(l_tax * 100 - 4) / 2",
    "TotalAirTemperature": "20 - floor(l_extendedprice / 1000)",
    "VerticalAcceleration": "1 + round(l_discount * 100 - 5) / 2",
    "YawRate": "round(l_discount * 100 - 5) / 2",
    "FlightPhase": "1 + l_orderkey % 5",
    "AircraftTail": "concat('TL-', l_returnflag, 'x', CAST(l_suppkey AS STRING), ' ')",
}


def _recorded(param: str) -> tuple[str, str, str]:
    """Rate, number and text of a known signal."""
    column = SIGNAL_COLUMNS[param]
    value = RECORDED_AS.get(param, TELEMETRY[column])
    if column in TEXT_COLUMNS:
        return "at_tail", "NULL", value
    return RATE_OF.get(param, "at_base"), value, "NULL"


RECORDED = {param: _recorded(param) for param in SIGNAL_COLUMNS}
# Signals that are no Silver column.
OTHERS = {
    "OilTemp": ("at_n1", "l_extendedprice / 100", "NULL"),
    "Flap": ("at_wind", "l_discount", "NULL"),
    "Squawk": ("at_tail", "NULL", "concat('SQ', l_linestatus, CAST(l_partkey % 10 AS STRING))"),
}
# Faults by flight % 40, as (signal, index, number, text, which samples are left).
FAULTS = {
    31: ("FlightPhase", "idx", "num_value", "str_value", "FALSE"),  # no base samples
    32: ("Longitude", "NULL", "NULL", "NULL", "idx = 0"),  # an empty signal
    33: ("HeadingTrue", "idx", "num_value", "str_value", "idx <> 2"),  # a gap
    34: ("MachNumber", "if(idx = 1, 0, idx)", "num_value", "str_value", "TRUE"),  # a repeated index
    37: ("Latitude", "idx", "NULL", "NULL", "TRUE"),  # neither numbers nor text
    36: ("PitchAngle", "idx", "NULL", "'N/A'", "TRUE"),  # text in a numeric column
}

ORDER_BLOCK = 1 << 20  # order keys per block; an order has at most seven lines


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def telemetry(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Silver shape: one row per lineitem row."""
    return table(spark, sf_dir, "lineitem").selectExpr(
        *[
            f"CAST({TELEMETRY[f.name]} AS {f.dataType.simpleString()}) AS {f.name}"
            for f in SILVER.fields
        ]
    )


def _page_path(prefix: str, suffix: str) -> Column:
    return F.concat(F.lit(prefix), F.col("page_id").cast("string"), F.lit(suffix))


def dir_listing(spark: SparkSession, sf_dir: str) -> DataFrame:
    size = F.when(F.col("page_id") % 17 == 0, 0).otherwise(F.length("html"))
    return table(spark, sf_dir, "pages").select(
        _page_path("in/", ".h5").alias("relative_path"),
        F.col("url").alias("file_url"),
        utc_literal("2024-01-01 00:00:00").alias("last_modified"),
        F.md5("url").alias("etag"),
        size.cast("long").alias("size"),
    )


def _page_file_name() -> Column:
    prefix = F.when(F.col("page_id") % 4 == 0, "pyspark_").otherwise("flight_")
    return F.concat(prefix, F.col("page_id").cast("string"), F.lit(".h5"))


def _log(pages: DataFrame) -> DataFrame:
    failed = F.col("page_id") % 5 == 0
    start = utc_literal("2024-01-01 00:00:00")
    path = _page_path("in/", ".h5")
    return pages.select(
        path.alias("file_relative_path"),
        _page_file_name().alias("input_file_name"),
        F.md5(path).alias("input_file_hash_rel"),
        _page_path("out/", ".parquet").alias("output_file_path"),
        F.when(failed, "Failed").otherwise("Completed").alias("status"),
        F.when(failed, "error").otherwise("ok").alias("status_msg"),
        F.timestamp_add("MINUTE", F.col("page_id"), start).alias("file_processed_dt"),
    )


def status_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _log(table(spark, sf_dir, "pages"))


def earlier_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The log while two thirds of the files were still pending."""
    return _log(table(spark, sf_dir, "pages").filter(F.col("page_id") % 3 == 0))


def status_updates(spark: SparkSession, sf_dir: str, now: str = NOW) -> DataFrame:
    """Every fifth page is reported again, half of them under names that are not in the log."""
    unknown = F.when(F.col("page_id") % 10 == 0, F.col("page_id") + 1_000_000)
    return (
        table(spark, sf_dir, "pages")
        .filter(F.col("page_id") % 5 == 0)
        .withColumn("page_id", F.coalesce(unknown, F.col("page_id")))
        .select(
            _page_file_name().alias("input_file_name"),
            F.lit("Completed").alias("status"),
            F.concat(F.lit("retried "), F.col("page_id").cast("string")).alias("status_msg"),
            utc_literal(now).alias("file_processed_dt"),
        )
    )


def _with_faults(samples: DataFrame) -> DataFrame:
    values = {"idx": "", "num_value": "", "str_value": ""}
    left = ""
    for rest, (param, idx, number, text, which) in FAULTS.items():
        hit = f"WHEN flight_id % 40 = {rest} AND param = '{param}' THEN"
        left += f"{hit} {which} "
        for name, value in zip(values, (idx, number, text), strict=True):
            values[name] += f"{hit} {value} "
    kept = samples.filter(f"CASE {left} ELSE TRUE END")
    return kept.selectExpr(
        "flight_id", "param", *[f"CASE {cases} ELSE {name} END AS {name}" for name, cases in values.items()]
    )


def signals(
    spark: SparkSession, sf_dir: str, order_block: int = ORDER_BLOCK, others: bool = False
) -> DataFrame:
    """Long-form samples of the 32 signals per flight, and on request of three that are no Silver column.

    A sample's index is its place among the flight's rows of that signal. All rates are counted in
    one pass over lineitem, in blocks of orders, so a large flight is not one task. Some flights have a fault.
    """
    lines = table(spark, sf_dir, "lineitem").selectExpr(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_returnflag",
        "l_linestatus", "l_extendedprice", "l_discount", "l_tax", f"l_orderkey div {order_block} AS block",
    )
    counted = running_counts(
        lines, ["l_suppkey"], "block", ["l_orderkey", "l_linenumber", "l_partkey", "l_extendedprice"], RATES
    )
    # by rate, so that a line makes only the samples it has, in code small enough to be compiled at run time
    by_rate: dict[str, list[str]] = {}
    for param, (rate, number, text) in (RECORDED | (OTHERS if others else {})).items():
        value = f"CAST({number} AS double) AS num_value, CAST({text} AS string) AS str_value"
        by_rate.setdefault(rate, []).append(f"struct('{param}' AS param, {value})")
    taken = ", ".join(
        f"if({RATES[rate]}, struct({rate} - 1 AS idx, array({', '.join(found)}) AS recorded), NULL)"
        for rate, found in by_rate.items()
    )
    samples = counted.selectExpr("CAST(l_suppkey AS int) AS flight_id", f"explode(array({taken})) AS at")
    return _with_faults(samples.selectExpr("flight_id", "at.idx AS idx", "inline(at.recorded)"))


def flight_attrs(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("s_suppkey")

    def numbered(prefix: str, modulus: int) -> Column:
        return F.concat(F.lit(prefix), (key % modulus).cast("string"))

    values = {
        "flight_id": key,
        "file_name": F.col("s_name"),
        "FlightNumber": numbered("FL-", 50),
        "AircraftTail": numbered("TL-", 10),
        "AircraftType": numbered("TYPE-", 3),
        "DepartureAirport": numbered("AP", 5),
        "ArrivalAirport": numbered("AP", 7),
        "FlightDepartureUTC_epoch": F.when(key % 10 != 9, 1704067200 + key * 3600),
        "RecordedDataSeconds": key * 10,
    }
    return table(spark, sf_dir, "supplier").select(
        *[values[f.name].cast(f.dataType).alias(f.name) for f in FLIGHT_ATTRS.fields]
    )


def repeated_attrs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The flights with every 25th twice, for the duplicate checks."""
    attrs = flight_attrs(spark, sf_dir)
    return attrs.unionByName(attrs.filter(F.col("flight_id") % 25 == 0))


def recording_path(flight_id: Column) -> Column:
    return F.concat(F.lit("in/"), flight_id.cast("string"), F.lit(".h5"))


def recordings(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Listing, attributes and samples of the flights' files, keyed by path hash."""
    path = recording_path(F.col("flight_id"))
    keyed = F.md5(path).alias("input_file_hash_rel")
    attrs = flight_attrs(spark, sf_dir)
    listing = attrs.select(
        path.alias("relative_path"),
        F.concat(F.lit("file:///"), path).alias("file_url"),
        utc_literal("2024-01-01 00:00:00").alias("last_modified"),
        F.md5(path).alias("etag"),
        (F.col("flight_id") + 1).cast("long").alias("size"),
    )
    samples = signals(spark, sf_dir).select(keyed, "param", "idx", "num_value", "str_value")
    return listing, attrs.select(keyed, *attrs.columns), samples


def gold_prev(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The Gold state before the incremental runs: every third flight is still missing."""
    before = telemetry(spark, sf_dir).filter(F.col("flight_id") % 3 != 0)
    return gold_rows(before, EARLIER)
