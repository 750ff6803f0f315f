"""The physical plans: what is shuffled, read and broadcast."""

import re

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as contract
from flightloom.operators import signals as sg
from flightloom.operators.gold import gold_rows
from flightloom.plans.gold_job import gold_of_flights
from flightloom.operators.keys import new_flights
from flightloom.session import settle
from flightloom.workload import fixtures as fx
from flightloom.workload.queries import registry

WRITERS = {"silver_write", "gold_append", "gold_incremental", "status_append", "verify_mutation",
           "stream_load", "stream_gold", "intake_to_gold", "pipeline_repeat"}


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def exchanges(text):
    return re.findall(r"Exchange (\w+)\(", text)


@pytest.fixture(scope="module")
def silver(spark, sf_dir):
    return settle(fx.telemetry(spark, sf_dir), "silver")


@pytest.fixture(scope="module")
def samples(spark, sf_dir):
    return settle(fx.signals(spark, sf_dir), "signals")


@pytest.fixture(scope="module")
def profile(samples):
    return settle(sg.signal_profile(samples), "profile")


def test_gold_is_one_exchange_of_partial_aggregates(silver):
    text = plan(gold_rows(silver, "2024-01-01 00:00:00"))
    assert exchanges(text) == ["hashpartitioning"]
    assert text.index("partial_avg") > text.index("Exchange")
    assert "latitude" not in text and "aircraft_tail" not in text  # never read


def test_gold_of_new_flights_shuffles_no_samples(silver):
    ids = settle(new_flights(silver, None), "ids")
    few = plan(gold_of_flights(silver, ids, "2024-01-01 00:00:00"))
    assert "BroadcastHashJoin" in few and exchanges(few).count("hashpartitioning") == 1
    many = plan(gold_of_flights(silver, ids, "2024-01-01 00:00:00", broadcast_rows=0))
    assert many.index("Join") < many.index("HashAggregate")  # ids meet aggregated rows


def departures(spark, sf_dir):
    from flightloom.operators.metadata import flight_metadata

    return flight_metadata(fx.flight_attrs(spark, sf_dir)).select(
        "flight_id", "flight_departure_dttm"
    )


def test_assembly_shuffles_pieces_once(spark, sf_dir, samples, profile):
    text = plan(sg.assemble(samples, profile, departures(spark, sf_dir)))
    assert text.count("REPARTITION_BY_COL") == 1
    assert "SortMergeJoin" not in text and "hashpartitioning(flight_id#" in text
    below = text[text.index("REPARTITION_BY_COL"):]
    below = below[:below.index("departure")] if "departure" in below else below
    # rows are repeated above the exchange only; below it a sample is at most a row per slice
    above = text[:text.index("REPARTITION_BY_COL")]
    assert "sequence(first_row" in above and "sequence(first_row#" not in below.replace("sequence((first_row", "")
    # samples that share a row are averaged in the task that reads them
    assert "partial_avg(value" in below and below.index("partial_avg(value") > below.index("Exchange hashpartitioning")


def test_a_fast_signal_is_shuffled_as_its_rows(spark):
    """16 samples to a row: each task averages its own before the exchange, and a row goes on as one piece."""
    rows = spark.range(0, 1600, 1, 2).selectExpr(
        "1 AS flight_id", "'Airspeed' AS param", "id AS idx", "double(id) AS num_value", "string(NULL) AS str_value"
    )
    base = rows.filter("idx < 100").withColumn("param", F.lit("FlightPhase"))
    both = settle(rows.unionByName(base), "fast")
    profile = settle(sg.signal_profile(both), "profile")
    pieces = sg._pieces(both, profile.filter("param = 'Airspeed'"), True, "flight_id")
    text = plan(pieces)
    assert text.index("partial_avg(value") > text.index("Exchange hashpartitioning")
    assert pieces.count() == 100


def test_large_profile_is_joined_by_block(spark, sf_dir, samples, profile, monkeypatch):
    monkeypatch.setattr(sg, "BROADCAST_ROWS", 0)
    text = plan(sg.assemble(samples, profile, departures(spark, sf_dir)))
    keys = re.findall(r"ShuffledHashJoin \[([^\]]*)\]", text)
    assert any("block" in k for k in keys) and all("block" in k or "slice" in k for k in keys)


def test_strings_are_not_sorted_before_the_first_reduction(samples):
    text = plan(sg.signal_profile(samples))
    lowest = [line for line in text.splitlines() if "Aggregate" in line][-1]
    assert "HashAggregate" in lowest


def test_filters_and_columns_reach_the_scan(spark, sf_dir):
    log = contract.queries()["load_by_name"](spark, sf_dir)
    text = plan(log.filter("l_Quantity > 49").select("L_OrderKey"))
    assert "GreaterThan(l_quantity,49.0)" in text
    assert "l_returnflag" not in text


def test_no_python_workers_and_no_cross_joins(spark, sf_dir):
    for name, query in registry().items():
        if name in WRITERS:
            continue
        text = plan(query(spark, sf_dir))
        for node in ("Python", "Pandas", "CartesianProduct", "BroadcastNestedLoopJoin"):
            assert node not in text, (name, node)


def test_gold_skips_earlier_flights_in_the_scan(spark, silver):
    ids = settle(new_flights(silver.filter("flight_id > 90"), None), "ids")
    text = plan(gold_of_flights(silver, ids, "2024-01-01 00:00:00"))
    assert "GreaterThanOrEqual(flight_id,91)" in text


def test_flight_files_are_sorted_once(spark, samples, profile, sf_dir, tmp_path):
    wide = sg.assemble(samples, profile, departures(spark, sf_dir))
    ordered = wide.withColumn("flight", wide.flight_id).sortWithinPartitions("flight", "idx")
    assert plan(ordered).split("ShuffledHashJoin")[0].count("Sort ") == 1
