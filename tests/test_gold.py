"""Gold metrics on literal rows."""

import math

import pytest
from pyspark.sql import functions as F

from flightloom.operators.gold import METRIC_GROUPS, gold_rows, metric_names, phase_metrics
from flightloom.schemas import GOLD, GOLD_METRICS, SILVER
from flightloom.workload import fixtures as fx

NOW = "2024-05-05 10:00:00"


def silver(spark, rows):
    """Rows as dicts; columns that are not given are NULL."""
    full = [tuple(r.get(name) for name in SILVER.names) for r in rows]
    return spark.createDataFrame(full, SILVER)


def one(df):
    (row,) = df.collect()
    return row


def test_schema_and_audit_columns(spark):
    row_set = gold_rows(silver(spark, [{"flight_id": 1, "flight_phase": 2}]), NOW)
    assert [(f.name, f.dataType) for f in row_set.schema] == [(f.name, f.dataType) for f in GOLD]
    row = one(row_set)
    assert str(row.record_created_at) == NOW == str(row.record_updated_at)
    assert row.duration_sec == 0.25


def test_every_metric_belongs_to_a_group():
    named = [m for g in METRIC_GROUPS for m in metric_names(g) if m != "duration_sec"]
    assert sorted(["duration_sec", *named]) == sorted(GOLD_METRICS)
    assert len(METRIC_GROUPS) == 10  # and the duration


def test_single_row_has_no_deviation(spark):
    row = one(phase_metrics(silver(spark, [{"flight_id": 1, "airspeed": 200.0}]), ["ias"]))
    assert row.ias_std_kts is None
    assert (row.ias_min_kts, row.ias_mean_kts, row.ias_max_kts) == (200.0, 200.0, 200.0)


def test_null_samples_are_skipped_and_are_no_events(spark):
    rows = [{"flight_id": 1, "vertical_acceleration": v} for v in (None, 2.0, -1.6, 1.5)]
    row = one(phase_metrics(silver(spark, rows), ["vrtg"]))
    assert row.duration_sec == 1.0
    assert row.vrtg_mean_g == pytest.approx(1.9 / 3)
    assert row.vrtg_exceedances_1p5g == 2  # beyond the limit, in either direction


def test_all_null_signal(spark):
    row = one(phase_metrics(silver(spark, [{"flight_id": 1}, {"flight_id": 1}]), ["roll", "fuel"]))
    assert row.roll_max_deg is None and row.roll_rms_deg is None
    assert row.roll_exceed_30deg == 0
    assert row.fuel_total_kg is None


def test_nan_counts_as_an_event(spark):
    rows = [{"flight_id": 1, "attack_angle": v} for v in (math.nan, 11.0, -20.0, 10.0)]
    row = one(phase_metrics(silver(spark, rows), ["aoa"]))
    assert row.aoa_events_gt10deg == 2  # no absolute value here
    assert math.isnan(row.aoa_max_deg)


def test_null_phase_is_a_group_of_its_own(spark):
    rows = [{"flight_id": 1, "flight_phase": p} for p in (None, None, 3)]
    found = {r.flight_phase: r.duration_sec for r in phase_metrics(silver(spark, rows), []).collect()}
    assert found == {None: 0.5, 3: 0.25}


def test_headwind_sign(spark):
    base = {"flight_id": 1, "wind_speed": 20.0, "heading_true": 90.0}
    rows = [{**base, "wind_direction": 90.0}, {**base, "wind_direction": 270.0}]
    row = one(phase_metrics(silver(spark, rows), ["wind"]))
    assert row.wind_max_headwind_kts == pytest.approx(20.0)
    assert row.wind_max_tailwind_kts == pytest.approx(-20.0)
    assert row.wind_mean_hw_comp_kts == pytest.approx(0.0, abs=1e-9)


def test_sample_rate_changes_duration_and_fuel(spark):
    rows = [{"flight_id": 1, "fuel_flow_total": 3600.0}] * 8
    assert one(phase_metrics(silver(spark, rows), ["fuel"])).fuel_total_kg == pytest.approx(2.0)
    slow = one(phase_metrics(silver(spark, rows), ["fuel"], sample_rate_hz=1))
    assert (slow.duration_sec, slow.fuel_total_kg) == (8.0, pytest.approx(8.0))


def test_invariants(spark, sf_dir):
    telemetry = fx.telemetry(spark, sf_dir)
    gold = gold_rows(telemetry, NOW)
    slack = F.lit(1e-9)
    broken = gold.filter(
        (F.col("vrtg_min_g") > F.col("vrtg_mean_g") + slack)
        | (F.col("vrtg_mean_g") > F.col("vrtg_max_g") + slack)
        | (F.col("latg_rms_g") + slack < F.abs("latg_mean_g"))
        | (F.col("latg_peak_g") + slack < F.col("latg_rms_g"))
        | (F.abs(F.col("alt_range_ft") - (F.col("alt_max_ft") - F.col("alt_min_ft"))) > slack)
    )
    assert broken.count() == 0
    assert gold.agg(F.sum("duration_sec")).first()[0] * 4 == telemetry.count()
