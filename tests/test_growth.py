"""What must not grow faster than the input: no wide rows are shuffled for want of a broadcast."""

import re

import pytest
from pyspark.sql import functions as F

from flightloom.operators import keys
from flightloom.operators import signals as sg
from flightloom.session import settle
from flightloom.workload import fixtures as fx, queries
from flightloom.workload.queries import rounded


@pytest.fixture
def large(spark):
    """As with large tables: Spark does not broadcast a side on its own account."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield spark
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_rows_of_new_flights_are_not_shuffled(large, sf_dir):
    silver = settle(fx.telemetry(large, sf_dir), "silver")
    ids = settle(silver.filter("flight_id % 3 = 0").select("flight_id").distinct(), "ids")
    few, many = keys.rows_of(silver, ids), keys.rows_of(silver, ids, broadcast_rows=0)
    assert "hashpartitioning" not in plan(few) and "hashpartitioning" in plan(many)
    assert few.exceptAll(many).isEmpty() and few.count() == many.count() == silver.filter("flight_id % 3 = 0").count()


def test_samples_of_many_flights_are_placed_where_they_are_read(large, sf_dir, monkeypatch):
    """A profile beyond the bound is broadcast as flights and shapes; the rows are those of the other two ways."""
    samples = settle(fx.signals(large, sf_dir, others=True), "samples")
    profile = settle(sg.signal_profile(samples), "profile")
    monkeypatch.setattr(sg, "INPUT_BLOCK", 100)

    def queries():
        departures = large.createDataFrame([], "flight_id int, flight_departure_dttm long")
        resampled = [sg.resample(samples, profile, [kind]) for kind in ("down", "up", "pass")]
        every = [*resampled, sg.other_signals(samples, profile), sg.assemble(samples, profile, departures)]
        return [rounded(df) for df in every]

    expected = queries()
    monkeypatch.setattr(sg, "_spread_is_small", lambda profile: False)
    shaped = queries()
    monkeypatch.setattr(sg, "BROADCAST_ROWS", 0)
    hashed = queries()
    for a, b, c in zip(expected, shaped, hashed, strict=True):
        assert "block" not in plan(b) and "block" in plan(c)
        assert "hashpartitioning(flight_id" not in plan(b) or "partial_avg" in plan(b)
        assert a.count() == b.count() == c.count() > 0
        assert a.exceptAll(b).isEmpty() and a.exceptAll(c).isEmpty()


def test_shapes_of_odd_profiles(large):
    """Flights without a length, signals without a column and a null key place the same samples as hashed."""
    rows = [(1, "FlightPhase", i, 1.0) for i in range(6)] + [(1, "Airspeed", i, float(i)) for i in range(13)]
    rows += [(2, "FlightPhase", i, 2.0) for i in range(4)] + [(2, "WindSpeed", i, float(i)) for i in range(2)]
    rows += [(3, "Airspeed", i, 1.0) for i in range(3)] + [(None, "FlightPhase", 0, 1.0), (4, "Unknown", 0, 1.0)]
    samples = large.createDataFrame([(*r, None) for r in rows], "flight_id int, param string, idx long, num_value double, str_value string")
    profile = settle(sg.signal_profile(samples), "profile").filter("base_len > 0")
    carried = profile.withColumn("slot", F.when(F.col("param") == "Airspeed", 1))
    plans = [sg._pieces(samples, carried, small, "flight_id", ["slot"]).collect() for small in (True, False)]
    assert sorted(plans[0], key=repr) == sorted(plans[1], key=repr) and len(plans[0]) == 6 + 6 + 4 + 2


@pytest.mark.parametrize("name", ["intake_to_gold", "pipeline_repeat"])
def test_the_chain_reads_samples_that_are_derived_once(spark, sf_dir, monkeypatch, name):
    given = []

    class Ended:
        def awaitTermination(self):
            pass

    def run_pipeline(spark, listing, attrs, samples, *rest):
        given.append(samples)

    def repeat_pipeline(spark, incoming, recordings, *rest):
        given.append(recordings(None)[2])
        return Ended()

    monkeypatch.setattr(queries, "run_pipeline", run_pipeline)
    monkeypatch.setattr(queries, "repeat_pipeline", repeat_pipeline)
    monkeypatch.setattr(queries, "_chain", lambda spark: (None, None, queries.fresh_table(spark, "gold"), None))
    monkeypatch.setattr(queries.CatalogTable, "read", lambda self: spark.range(0))
    assert queries.registry()[name](spark, sf_dir).isEmpty()
    assert len(given) == 2 and given[0] is given[1]
    assert "Window" not in plan(given[0]) and "lineitem" not in plan(given[0])
    expected = fx.recordings(spark, sf_dir)[2]
    assert given[0].dtypes == expected.dtypes and given[0].count() == expected.count()


@pytest.mark.parametrize("others", [False, True])
def test_samples_are_made_in_compiled_code(spark, sf_dir, others):
    """No list of all signals is interpreted for each line; a line makes the samples it has."""
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        steps = [s for s in plan(fx.signals(spark, sf_dir, others=others)).splitlines() if "Generate " in s]
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert len(steps) == 2 and all(re.search(r"\*\(\d+\) Generate", s) for s in steps)
