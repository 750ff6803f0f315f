"""Gold: one row per flight and flight phase, 39 metrics in one aggregation.

Every metric is mergeable (count, sum, min, max, central moments), so each task reduces its own
rows before the only exchange and a flight holding most of the rows costs no more than any other.
"""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flightloom.functions.columns import HEADWIND, cast_list, utc_literal
from flightloom.schemas import GOLD, GOLD_METRICS

KEYS = ("flight_id", "flight_phase")
DEFAULT_SAMPLE_RATE_HZ = 4.0

# Values derived per sample before grouping; everything else is a Silver column.
CHANNELS = {"n1_imbalance": "abs(engine_n1_1 - engine_n1_2)", "headwind": HEADWIND}

# As SQL text: one call per metric instead of one per operation when the plan is built.
STATISTICS = {
    "mean": "avg({x})",
    "max": "max({x})",
    "min": "min({x})",
    "std": "stddev_samp({x})",
    "range": "max({x}) - min({x})",
    "rms": "sqrt(avg({x} * {x}))",
    "peak": "max(abs({x}))",
    # a NULL sample is no event, a NaN sample is one
    "count_above": "sum(if({x} > {limit}D, 1, 0))",
    "count_abs_above": "sum(if(abs({x}) > {limit}D, 1, 0))",
}


@dataclass(frozen=True)
class Metric:
    """A statistic of a channel; the counters count samples beyond the limit."""

    name: str
    channel: str
    statistic: str
    limit: float | None = None

    def sql(self) -> str:
        value = STATISTICS[self.statistic].format(x=self.channel, limit=self.limit)
        return f"{value} AS {self.name}"


# The metrics, their channels and limits.
METRIC_GROUPS: dict[str, tuple[Metric, ...]] = {
    "fuel": (Metric("fuel_mean_flow_kg_hr", "fuel_flow_total", "mean"),),
    "n1": (
        Metric("n1_mean_eng1_pct", "engine_n1_1", "mean"),
        Metric("n1_mean_eng2_pct", "engine_n1_2", "mean"),
        Metric("n1_max_imbalance_pct", "n1_imbalance", "max"),
        Metric("n1_mean_imbalance_pct", "n1_imbalance", "mean"),
    ),
    "vrtg": (
        Metric("vrtg_mean_g", "vertical_acceleration", "mean"),
        Metric("vrtg_max_g", "vertical_acceleration", "max"),
        Metric("vrtg_min_g", "vertical_acceleration", "min"),
        Metric("vrtg_std_g", "vertical_acceleration", "std"),
        Metric("vrtg_exceedances_1p5g", "vertical_acceleration", "count_abs_above", 1.5),
    ),
    "ias": (
        Metric("ias_min_kts", "airspeed", "min"),
        Metric("ias_mean_kts", "airspeed", "mean"),
        Metric("ias_max_kts", "airspeed", "max"),
        Metric("ias_std_kts", "airspeed", "std"),
    ),
    "alt": (
        Metric("alt_min_ft", "baro_altitude", "min"),
        Metric("alt_mean_ft", "baro_altitude", "mean"),
        Metric("alt_max_ft", "baro_altitude", "max"),
        Metric("alt_range_ft", "baro_altitude", "range"),
    ),
    "wind": (
        Metric("wind_mean_spd_kts", "wind_speed", "mean"),
        Metric("wind_mean_hw_comp_kts", "headwind", "mean"),
        Metric("wind_max_headwind_kts", "headwind", "max"),
        Metric("wind_max_tailwind_kts", "headwind", "min"),
    ),
    "roll": (
        Metric("roll_max_deg", "roll_angle", "peak"),
        Metric("roll_rms_deg", "roll_angle", "rms"),
        Metric("roll_exceed_30deg", "roll_angle", "count_abs_above", 30.0),
    ),
    "pitch_rate": (
        Metric("pitch_rate_mean_dps", "pitch_rate", "mean"),
        Metric("pitch_rate_rms_dps", "pitch_rate", "rms"),
        Metric("pitch_rate_peak_dps", "pitch_rate", "peak"),
        Metric("pitch_rate_std_dps", "pitch_rate", "std"),
    ),
    "aoa": (
        Metric("aoa_mean_deg", "attack_angle", "mean"),
        Metric("aoa_max_deg", "attack_angle", "max"),
        Metric("aoa_std_deg", "attack_angle", "std"),
        Metric("aoa_events_gt10deg", "attack_angle", "count_above", 10.0),
    ),
    "latg": (
        Metric("latg_mean_g", "lateral_acceleration", "mean"),
        Metric("latg_rms_g", "lateral_acceleration", "rms"),
        Metric("latg_peak_g", "lateral_acceleration", "peak"),
        Metric("latg_events_gt0p1g", "lateral_acceleration", "count_abs_above", 0.1),
    ),
}


def phase_metrics(
    silver: DataFrame,
    groups: Iterable[str] = tuple(METRIC_GROUPS),
    sample_rate_hz: float = DEFAULT_SAMPLE_RATE_HZ,
) -> DataFrame:
    """Duration plus the chosen metric groups per flight and phase."""
    metrics = [m for group in groups for m in METRIC_GROUPS[group]]
    channels = dict.fromkeys(m.channel for m in metrics)
    samples = silver.selectExpr(*KEYS, *[f"{CHANNELS.get(c, c)} AS {c}" for c in channels])
    per_phase = samples.groupBy(*KEYS).agg(
        F.expr(f"count(*) / {float(sample_rate_hz)}D AS duration_sec"),
        *[F.expr(m.sql()) for m in metrics],
    )
    if "fuel_mean_flow_kg_hr" in per_phase.columns:
        burned = F.expr("fuel_mean_flow_kg_hr * (duration_sec / 3600D)")
        per_phase = per_phase.withColumn("fuel_total_kg", burned)
    return per_phase


def gold_rows(
    silver: DataFrame,
    now: datetime | str,
    sample_rate_hz: float = DEFAULT_SAMPLE_RATE_HZ,
) -> DataFrame:
    """The full Gold row set in declared column order and types."""
    stamped = phase_metrics(silver, sample_rate_hz=sample_rate_hz).withColumns(
        {"record_created_at": utc_literal(now), "record_updated_at": utc_literal(now)}
    )
    return stamped.selectExpr(*cast_list(GOLD))


def metric_names(group: str) -> list[str]:
    """The metric columns of one group in declared order."""
    chosen = {m.name for m in METRIC_GROUPS[group]}
    if group == "fuel":
        chosen |= {"duration_sec", "fuel_total_kg"}
    return [name for name in GOLD_METRICS if name in chosen]
