"""Gold from mergeable states: what each load adds to a flight's phases, put together once the flight is complete.

A state has one row per flight, phase and load: counts, sums, squares about the mean, extremes and
counters. States of several loads give the metrics that one aggregation over all samples gives.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from flightloom.functions.columns import cast_list, utc_literal
from flightloom.operators.gold import CHANNELS, DEFAULT_SAMPLE_RATE_HZ, KEYS, METRIC_GROUPS, STATISTICS, Metric
from flightloom.schemas import GOLD

SAMPLES = "samples"

# What a load keeps of a channel: name, how it is taken from samples, how it is merged.
PARTS = {
    "n": ("count({x})", "sum({p})"),
    "sum": ("sum({x})", "sum({p})"),
    "squares": ("sum({x} * {x})", "sum({p})"),
    "about": ("var_pop({x}) * count({x})", "sum({p})"),  # squares about the load's own mean
    "max": ("max({x})", "max({p})"),
    "min": ("min({x})", "min({p})"),
    "peak": ("max(abs({x}))", "max({p})"),
}
# The parts a statistic needs, and the statistic from merged parts.
FROM_PARTS = {
    "mean": (("n", "sum"), "{x}_sum / nullif({x}_n, 0)"),
    "max": (("max",), "{x}_max"),
    "min": (("min",), "{x}_min"),
    "range": (("max", "min"), "{x}_max - {x}_min"),
    "peak": (("peak",), "{x}_peak"),
    "rms": (("n", "squares"), "sqrt({x}_squares / nullif({x}_n, 0))"),
    # one sample has no deviation
    "std": (("n", "sum", "about"), "sqrt({x}_about / nullif({x}_n - 1, 0))"),
}

METRICS = [m for group in METRIC_GROUPS.values() for m in group]


def _is_counter(metric: Metric) -> bool:
    return metric.statistic.startswith("count_")


def _parts() -> list[tuple[str, str]]:
    """(channel, part) pairs in a fixed order, each once."""
    pairs = [(m.channel, part) for m in METRICS if not _is_counter(m) for part in FROM_PARTS[m.statistic][0]]
    return list(dict.fromkeys(pairs))


def phase_states(samples: DataFrame) -> DataFrame:
    """One row per flight and phase of ``samples``. A NULL id belongs to no flight."""
    channels = dict.fromkeys(m.channel for m in METRICS)
    known = samples.filter("flight_id IS NOT NULL")
    return (
        known.selectExpr(*KEYS, *[f"{CHANNELS.get(c, c)} AS {c}" for c in channels])
        .groupBy(*KEYS)
        .agg(
            F.count("*").alias(SAMPLES),
            *[F.expr(PARTS[part][0].format(x=x)).alias(f"{x}_{part}") for x, part in _parts()],
            *[F.expr(STATISTICS[m.statistic].format(x=m.channel, limit=m.limit)).alias(m.name) for m in METRICS if _is_counter(m)],
        )
    )


def merged_states(states: DataFrame) -> DataFrame:
    """One row per flight and phase. Squares about the loads' means are moved to the common mean:
    each load adds its samples times the square of the distance of the two means."""
    about = [x for x, part in _parts() if part == "about"]
    phase = Window.partitionBy(*KEYS)
    whole = states.withColumns(
        {f"{x}_mean": F.sum(f"{x}_sum").over(phase) / F.nullif(F.sum(f"{x}_n").over(phase), F.lit(0)) for x in about}
    )
    distance = "({x}_sum / nullif({x}_n, 0) - {x}_mean)"
    moved = whole.withColumns(
        {
            f"{x}_about": F.expr(f"{x}_about + {x}_n * {distance} * {distance}".format(x=x))
            for x in about
        }
    )
    return moved.groupBy(*KEYS).agg(
        F.sum(SAMPLES).alias(SAMPLES),
        *[F.expr(PARTS[part][1].format(p=f"{x}_{part}")).alias(f"{x}_{part}") for x, part in _parts()],
        *[F.sum(m.name).alias(m.name) for m in METRICS if _is_counter(m)],
    )


def gold_of_states(
    states: DataFrame, now: datetime | str, sample_rate_hz: float = DEFAULT_SAMPLE_RATE_HZ
) -> DataFrame:
    """The Gold rows of complete flights from all their states."""
    measured = merged_states(states).selectExpr(
        *KEYS,
        f"{SAMPLES} / {float(sample_rate_hz)}D AS duration_sec",
        *[
            m.name if _is_counter(m) else f"{FROM_PARTS[m.statistic][1].format(x=m.channel)} AS {m.name}"
            for m in METRICS
        ],
    )
    burned = F.expr("fuel_mean_flow_kg_hr * (duration_sec / 3600D)")
    stamped = measured.withColumns(
        {"fuel_total_kg": burned, "record_created_at": utc_literal(now), "record_updated_at": utc_literal(now)}
    )
    return stamped.selectExpr(*cast_list(GOLD))
