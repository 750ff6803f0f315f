"""Table schemas and the fixed vocabulary of recorded signals."""

from __future__ import annotations

from pyspark.sql import types as T

# Recorded signal name -> Silver column, in Silver column order.
SIGNAL_COLUMNS = {
    "FlightDate": "flight_date",
    "FlightNumber": "flight_number",
    "AircraftTail": "aircraft_tail",
    "AircraftType": "aircraft_type",
    "ArrivalAirport": "arrival_airport",
    "DepartureAirport": "departure_airport",
    "AirTemperature": "air_temperature",
    "Airspeed": "airspeed",
    "AttackAngle": "attack_angle",
    "BaroAltitude": "baro_altitude",
    "EngineN1_1": "engine_n1_1",
    "EngineN1_2": "engine_n1_2",
    "FlightPhase": "flight_phase",
    "FuelFlowTotal": "fuel_flow_total",
    "GroundSpeed": "ground_speed",
    "HeadingMagnetic": "heading_magnetic",
    "HeadingTrue": "heading_true",
    "LateralAcceleration": "lateral_acceleration",
    "Latitude": "latitude",
    "Longitude": "longitude",
    "LongitudinalAcceleration": "longitudinal_acceleration",
    "MachNumber": "mach_number",
    "PitchAngle": "pitch_angle",
    "PitchRate": "pitch_rate",
    "RadioAltitude": "radio_altitude",
    "RollAngle": "roll_angle",
    "TotalAirTemperature": "total_air_temperature",
    "VerticalAcceleration": "vertical_acceleration",
    "VerticalSpeed": "vertical_speed",
    "WindDirection": "wind_direction",
    "WindSpeed": "wind_speed",
    "YawRate": "yaw_rate",
}

# The signal whose sample count sets the row count of a flight.
BASE_SIGNAL = "FlightPhase"

TEXT_COLUMNS = (
    "flight_date",
    "flight_number",
    "aircraft_tail",
    "aircraft_type",
    "arrival_airport",
    "departure_airport",
)


def _struct(*fields: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in fields])


def _silver_type(column: str) -> T.DataType:
    if column in TEXT_COLUMNS:
        return T.StringType()
    return T.IntegerType() if column == "flight_phase" else T.DoubleType()


# Column names, types and order.
STATUS = _struct(
    ("file_relative_path", T.StringType()),
    ("input_file_name", T.StringType()),
    ("input_file_hash_rel", T.StringType()),
    ("output_file_path", T.StringType()),
    ("status", T.StringType()),
    ("status_msg", T.StringType()),
    ("file_processed_dt", T.TimestampNTZType()),
)

# Column names, types and order.
BRONZE = _struct(
    ("flight_id", T.IntegerType()),
    ("file_name", T.StringType()),
    ("flight_number", T.StringType()),
    ("aircraft_tail", T.StringType()),
    ("aircraft_type", T.StringType()),
    ("departure_airport", T.StringType()),
    ("arrival_airport", T.StringType()),
    ("flight_date", T.DateType()),
    ("flight_departure_utc", T.TimestampNTZType()),
    ("qar_recorded_data_seconds", T.IntegerType()),
    ("created_date", T.TimestampNTZType()),
    ("updated_date", T.TimestampNTZType()),
)

SILVER = _struct(
    ("flight_id", T.IntegerType()),
    *[(c, _silver_type(c)) for c in SIGNAL_COLUMNS.values()],
    ("flight_departure_dttm", T.LongType()),
)

# The Gold metrics in declared order. Counters that are INT in the
# table are listed in GOLD_INT_METRICS; all others are DOUBLE.
GOLD_METRICS = (
    "duration_sec",
    "fuel_mean_flow_kg_hr",
    "fuel_total_kg",
    "n1_mean_eng1_pct",
    "n1_mean_eng2_pct",
    "n1_max_imbalance_pct",
    "n1_mean_imbalance_pct",
    "vrtg_mean_g",
    "vrtg_max_g",
    "vrtg_min_g",
    "vrtg_std_g",
    "vrtg_exceedances_1p5g",
    "ias_min_kts",
    "ias_mean_kts",
    "ias_max_kts",
    "ias_std_kts",
    "alt_min_ft",
    "alt_mean_ft",
    "alt_max_ft",
    "alt_range_ft",
    "wind_mean_spd_kts",
    "wind_mean_hw_comp_kts",
    "wind_max_headwind_kts",
    "wind_max_tailwind_kts",
    "roll_max_deg",
    "roll_rms_deg",
    "roll_exceed_30deg",
    "pitch_rate_mean_dps",
    "pitch_rate_rms_dps",
    "pitch_rate_peak_dps",
    "pitch_rate_std_dps",
    "aoa_mean_deg",
    "aoa_max_deg",
    "aoa_std_deg",
    "aoa_events_gt10deg",
    "latg_mean_g",
    "latg_rms_g",
    "latg_peak_g",
    "latg_events_gt0p1g",
)
GOLD_INT_METRICS = ("roll_exceed_30deg", "aoa_events_gt10deg", "latg_events_gt0p1g")

GOLD = _struct(
    ("flight_id", T.IntegerType()),
    ("flight_phase", T.IntegerType()),
    *[
        (m, T.IntegerType() if m in GOLD_INT_METRICS else T.DoubleType())
        for m in GOLD_METRICS
    ],
    ("record_created_at", T.TimestampNTZType()),
    ("record_updated_at", T.TimestampNTZType()),
)

# Decoded recordings: one row per sample, keyed by the file they came from. A dataset without
# samples is one row with a NULL idx.
SIGNALS = _struct(
    ("flight_id", T.IntegerType()),
    ("param", T.StringType()),
    ("idx", T.LongType()),
    ("num_value", T.DoubleType()),
    ("str_value", T.StringType()),
)

FLIGHT_ATTRS = _struct(
    ("flight_id", T.IntegerType()),
    ("file_name", T.StringType()),
    ("FlightNumber", T.StringType()),
    ("AircraftTail", T.StringType()),
    ("AircraftType", T.StringType()),
    ("DepartureAirport", T.StringType()),
    ("ArrivalAirport", T.StringType()),
    ("FlightDepartureUTC_epoch", T.LongType()),
    ("RecordedDataSeconds", T.DoubleType()),
)

FLIGHT_IDS = _struct(
    ("input_file_hash_rel", T.StringType()),
    ("flight_id", T.IntegerType()),
)
