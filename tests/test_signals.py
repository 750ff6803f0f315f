"""Signal alignment against a plain-list model of one file."""

import re

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from flightloom.operators import signals as sg
from flightloom.schemas import SIGNALS, SILVER
from flightloom.workload import fixtures as fx
from flightloom.workload.queries import registry

COLUMN = {"FlightPhase": "flight_phase", "Airspeed": "airspeed", "EngineN1_1": "engine_n1_1",
          "WindSpeed": "wind_speed", "AircraftTail": "aircraft_tail"}


def frame(spark, flights):
    """{flight: {param: [values]}}; an empty list is a dataset without samples."""
    rows = []
    for flight, params in flights.items():
        for param, values in params.items():
            if not values:
                rows.append((flight, param, None, None, None))
            for i, v in enumerate(values):
                is_text = isinstance(v, str)
                number = None if is_text or v is None else float(v)
                rows.append((flight, param, i, number, v if is_text else None))
    return spark.createDataFrame(rows, SIGNALS)


def model(values, base_len):
    """The column one signal becomes, or None if it has the wrong length."""
    if values and isinstance(values[0], str):
        return [max(re.sub("[^A-Z0-9-]", "", v) for v in values)] * base_len
    ratio = len(values) / base_len
    if ratio > 1:
        f = int(ratio)
        column = [sum(values[i * f:(i + 1) * f]) / f for i in range(base_len)]
    elif 0 < ratio < 1:
        repeat = round(1 / ratio)
        column = [v for v in values for _ in range(repeat)][:base_len]
    else:
        column = values[:base_len]
    return column if len(column) == base_len else None


def run(spark, flights):
    samples = frame(spark, flights)
    profile = sg.signal_profile(samples).persist()
    departures = spark.createDataFrame(
        [(f, 1000 * f) for f in flights], "flight_id int, flight_departure_dttm long"
    )
    rows = sg.assemble(samples, profile, departures).orderBy("flight_id", "idx").collect()
    faults = {r.flight_id: r.fault for r in sg.rejected_flights(profile).collect()}
    profile.unpersist()
    return rows, faults


def expected(flights):
    good = {}
    for flight, params in flights.items():
        base_len = len(params.get("FlightPhase", []))
        if base_len and all(params.values()):
            columns = {p: model(v, base_len) for p, v in params.items()}
            if None not in columns.values():
                good[flight] = columns
    return good


def check(spark, flights):
    rows, faults = run(spark, flights)
    good = expected(flights)
    assert set(faults) == set(flights) - set(good)
    found = {}
    for r in rows:
        found.setdefault(r.flight_id, []).append(r)
    assert set(found) == set(good)
    for flight, columns in good.items():
        assert [r.idx for r in found[flight]] == list(range(len(columns["FlightPhase"])))
        assert all(r.flight_departure_dttm == 1000 * flight for r in found[flight])
        for param, column in columns.items():
            values = [r[COLUMN[param]] for r in found[flight]]
            assert values == (column if param == "AircraftTail" else pytest.approx(column))


NUMBERS = st.lists(st.integers(-50, 50), max_size=40)
FLIGHT = st.fixed_dictionaries(
    {"FlightPhase": st.lists(st.integers(1, 7), max_size=12)},
    optional={
        "Airspeed": NUMBERS,
        "EngineN1_1": NUMBERS,
        "WindSpeed": NUMBERS,
        "AircraftTail": st.lists(st.text("AZaz09- x", max_size=4), min_size=1, max_size=3),
    },
)


@settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(FLIGHT, min_size=6, max_size=10))
def test_against_list_model(spark, flights):
    check(spark, dict(enumerate(flights, start=1)))


def test_blocks_and_slices_do_not_show(spark, monkeypatch):
    monkeypatch.setattr(sg, "INPUT_BLOCK", 7)
    monkeypatch.setattr(sg, "OUTPUT_SLICE", 5)
    flights = {
        1: {"FlightPhase": [1] * 50, "Airspeed": list(range(173)), "WindSpeed": list(range(25)),
            "EngineN1_1": list(range(60)), "AircraftTail": ["TL-1"]},
        2: {"FlightPhase": [2] * 11, "Airspeed": list(range(11))},
    }
    check(spark, flights)
    monkeypatch.setattr(sg, "BROADCAST_ROWS", 0)
    check(spark, flights)


def test_repeat_is_rounded_half_to_even(spark):
    flights = {
        1: {"FlightPhase": [1] * 5, "WindSpeed": [7, 8]},  # 2.5 -> 2: four of five rows
        2: {"FlightPhase": [1] * 7, "WindSpeed": [7, 8]},  # 3.5 -> 4: filled
    }
    rows, faults = run(spark, flights)
    assert faults == {1: "WindSpeed fills 4 of 5 rows"}
    assert [r.wind_speed for r in rows] == [7.0, 7.0, 7.0, 7.0, 8.0, 8.0, 8.0]


def test_down_ratio_is_truncated_and_the_rest_dropped(spark):
    rows, faults = run(spark, {1: {"FlightPhase": [1, 1], "Airspeed": [1, 2, 3, 4, 99]}})
    assert not faults
    assert [r.airspeed for r in rows] == [1.5, 3.5]


@pytest.mark.parametrize(
    "params, fault",
    [
        ({"Airspeed": [1]}, "no samples of FlightPhase"),
        ({"FlightPhase": [], "Airspeed": [1]}, "no samples of FlightPhase"),
        ({"FlightPhase": [1, 2], "Airspeed": []}, "no samples of Airspeed"),
        ({"FlightPhase": [1, 2], "Airspeed": [None, None]}, "neither numbers nor text in Airspeed"),
        ({"FlightPhase": [1, 2], "Airspeed": ["FAST"]}, "text in numeric signal Airspeed"),
        ({"FlightPhase": [1] * 5, "Unknown": [1, 2]}, "Unknown fills 4 of 5 rows"),
    ],
)
def test_faults_reject_the_whole_flight(spark, params, fault):
    rows, faults = run(spark, {1: params, 2: {"FlightPhase": [1]}})
    assert faults == {1: fault}
    assert {r.flight_id for r in rows} == {2}


def test_index_gap_is_a_fault(spark):
    samples = spark.createDataFrame(
        [(1, "FlightPhase", 0, 1.0, None), (1, "FlightPhase", 2, 1.0, None)], SIGNALS
    )
    faults = sg.rejected_flights(sg.signal_profile(samples)).collect()
    assert [f.fault for f in faults] == ["gaps in FlightPhase"]


@pytest.mark.parametrize("places", [(0, 0, 2), (1, 1, 1, 3), (-1, 0, 2)])
def test_repeated_and_negative_places(spark, places):
    """Count and last place alone would look complete."""
    rows = [(1, "FlightPhase", i, 1.0, None) for i in range(3)]
    rows += [(1, "Airspeed", i, 1.0, None) for i in places]
    faults = sg.rejected_flights(sg.signal_profile(spark.createDataFrame(rows, SIGNALS))).collect()
    kind = "repeated samples" if len(set(places)) < len(places) else "gaps"
    assert [f.fault for f in faults] == [f"{kind} in Airspeed"]


def test_text_is_cleaned_and_its_maximum_used(spark):
    rows, _ = run(spark, {1: {"FlightPhase": [1, 2, 3], "AircraftTail": ["TL-1 x", "TL-9ab", "A"]}})
    assert [r.aircraft_tail for r in rows] == ["TL-9"] * 3


def test_numbers_in_a_text_column_and_text_that_is_a_number(spark):
    rows, faults = run(
        spark, {1: {"FlightPhase": [1, 2], "FlightNumber": [7, 7], "Airspeed": ["250"]}}
    )
    assert not faults
    assert [(r.flight_number, r.airspeed) for r in rows] == [("7.0", 250.0)] * 2


def test_text_base_signal_still_makes_the_rows(spark):
    rows, faults = run(spark, {1: {"FlightPhase": ["3", "3"], "Airspeed": [5, 6]}})
    assert not faults
    assert [(r.flight_phase, r.airspeed) for r in rows] == [(3, 5.0), (3, 6.0)]


def test_further_signals_become_columns_on_request(spark):
    samples = frame(spark, {1: {"FlightPhase": [1, 2], "OilTemp": [1, 3, 5, 7], "Crew": ["A1"]}})
    profile = sg.signal_profile(samples)
    departures = spark.createDataFrame([(1, 0)], "flight_id int, flight_departure_dttm long")
    columns = {**sg.SILVER_SIGNALS, "OilTemp": "double", "Crew": "string"}
    rows = sg.assemble(samples, profile, departures, columns=columns).orderBy("idx")
    assert rows.columns == ["idx", *SILVER.names, "OilTemp", "Crew"]
    assert [(r.OilTemp, r.Crew) for r in rows.collect()] == [(2.0, "A1"), (6.0, "A1")]


def test_signals_without_a_column_come_in_long_form(spark, monkeypatch):
    monkeypatch.setattr(sg, "OUTPUT_SLICE", 3)
    samples = frame(
        spark,
        {1: {"FlightPhase": [1] * 8, "OilTemp": list(range(16)), "Flap": [5, 6], "Crew": ["A1", "B2 x"], "Airspeed": [1] * 8},
         2: {"FlightPhase": [1, 2], "OilTemp": []}, 3: {"FlightPhase": [1], "Gear": [7]}},
    )
    found = sg.other_signals(samples, sg.signal_profile(samples)).collect()
    by_name = {(r.flight_id, r.name, r.idx): r.num_value if r.str_value is None else r.str_value for r in found}
    assert len(by_name) == len(found) == 25
    for i in range(8):
        assert by_name[1, "OilTemp", i] == 2 * i + 0.5
        assert by_name[1, "Flap", i] == 5 + (i >= 4) and by_name[1, "Crew", i] == "B2"
    assert by_name[3, "Gear", 0] == 7


def test_a_signal_of_one_sample_fills_slices(spark, monkeypatch):
    """It crosses the exchange as one piece per slice."""
    monkeypatch.setattr(sg, "OUTPUT_SLICE", 10)
    samples = frame(spark, {1: {"FlightPhase": [1] * 95, "WindSpeed": [4]}})
    profile = sg.signal_profile(samples)
    pieces = sg._pieces(samples, profile.filter("param = 'WindSpeed'"), True, "flight_id").collect()
    assert sorted((r.slice, r.first_row, r.last_row) for r in pieces) == [
        (i, 10 * i, min(10 * i + 9, 94)) for i in range(10)
    ]
    check(spark, {1: {"FlightPhase": [1] * 95, "WindSpeed": [4], "Airspeed": list(range(95 * 16))}})


def test_later_of_two_names_for_one_column_wins(spark):
    rows, faults = run(
        spark, {1: {"FlightPhase": [1, 2], "Airspeed": [5], "airspeed": [8, 9]}}
    )
    assert not faults
    assert [r.airspeed for r in rows] == [8.0, 9.0]


def test_known_reject_count(spark, sf_dir):
    if not sf_dir.endswith("sf0.01"):
        pytest.skip("known for sf0.01")
    profile = sg.signal_profile(fx.signals(spark, sf_dir))
    faults = dict(sg.rejected_flights(profile).collect())
    assert sum("fills" in f for f in faults.values()) == 44
    assert {n: f for n, f in faults.items() if "fills" not in f} == {
        31: "no samples of FlightPhase", 71: "no samples of FlightPhase", 72: "no samples of Longitude",
        33: "gaps in HeadingTrue", 74: "repeated samples in MachNumber", 37: "neither numbers nor text in Latitude",
        36: "text in numeric signal PitchAngle", 76: "text in numeric signal PitchAngle",
    }


def test_no_column_is_null_throughout(spark, sf_dir):
    wide = registry()["silver_wide"](spark, sf_dir)
    filled = wide.select([F.count(c).alias(c) for c in wide.columns]).first().asDict()
    assert min(filled.values()) > 0, filled


def test_numbering_in_small_blocks_is_the_same(spark, sf_dir):
    whole = fx.signals(spark, sf_dir)
    blocks = fx.signals(spark, sf_dir, order_block=97)
    assert whole.count() == blocks.count()
    assert whole.exceptAll(blocks).count() == 0


def test_counts(spark):
    flights = {1: {"FlightPhase": [1, 2], "Unknown": [1, 2], "Airspeed": [1, 2, 3, 4]},
               2: {"FlightPhase": [1, 2], "Airspeed": []}}
    frames = sg.flight_frames(sg.signal_profile(frame(spark, flights)))
    counts = sg.flight_counts(frames).collect()
    assert [(r.flight_id, r.n_rows, r.n_columns) for r in counts] == [(1, 2, 5)]
    rename = sg.rename_signals(frame(spark, flights)).select("param", "column_name").distinct()
    assert dict(rename.collect()) == {
        "FlightPhase": "flight_phase", "Unknown": "Unknown", "Airspeed": "airspeed"
    }
    assert frames.filter(F.col("fault").isNotNull()).count() == 1
    wide = spark.createDataFrame([(1, 2)], "EngineN1_1 int, Unknown int")
    assert sg.rename_columns(wide).columns == ["engine_n1_1", "Unknown"]
