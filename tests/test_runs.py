"""Whole runs: Gold job, streamed load, intake, and what happens when they are repeated."""

import dataclasses
import os
import shutil
import time
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from flightloom.operators.gold import gold_rows
from flightloom.operators.keys import new_flights
from flightloom.plans import ingest
from flightloom.plans.gold_job import GoldRun, gold_of_flights, run_gold
from flightloom.plans.ingest import IntakeTables, run_intake
from flightloom.plans.refresh import load_landed, repeat_pipeline, run_pipeline
from flightloom.schemas import BRONZE, GOLD, SILVER
from flightloom.session import fresh_path, settle
from flightloom.sources.tables import CatalogTable
from flightloom.streaming.intake import landed_files, loads_of, start_load, states_of
from flightloom.workload import fixtures as fx
from flightloom.workload.queries import fresh_table

NOW = "2024-05-05 10:00:00"

_recorded = {}


def recorded(spark, sf_dir):
    """Listing, attributes and samples, derived once for all tests."""
    if sf_dir not in _recorded:
        _recorded[sf_dir] = [settle(df, "recordings") for df in fx.recordings(spark, sf_dir)]
    return _recorded[sf_dir]


def new_table(spark):
    return fresh_table(spark, "t")


def intake_tables(spark, silver=None):
    return IntakeTables(
        new_table(spark), new_table(spark), new_table(spark), fresh_path(spark, "landing"),
        lengths=new_table(spark), silver=silver, loads=silver and loads_of(silver),
    )


@pytest.fixture(scope="module")
def telemetry(spark, sf_dir):
    return settle(fx.telemetry(spark, sf_dir), "telemetry")


def test_gold_runs_are_incremental(spark, telemetry):
    silver, gold = new_table(spark), new_table(spark)
    silver.append(telemetry.filter("flight_id % 2 = 0"))
    first = run_gold(silver, gold, NOW)
    assert first.flights > 0 and first.rows == gold.read().count()
    assert run_gold(silver, gold, NOW) == GoldRun(0, 0)
    silver.append(telemetry.filter("flight_id % 2 = 1"))
    silver.append(telemetry.limit(1).withColumn("flight_id", F.lit(None).cast("int")))
    second = run_gold(silver, gold, NOW)
    assert gold.read().count() == first.rows + second.rows
    expected = gold_rows(telemetry, NOW).drop("record_created_at").count()
    assert gold.read().count() == expected
    assert run_gold(silver, gold, NOW) == GoldRun(0, 0)


def test_many_ids_give_the_same_gold(spark, telemetry):
    ids = settle(new_flights(telemetry.filter("flight_id % 3 = 0"), None), "ids")
    keys = ["flight_id", "flight_phase", "duration_sec", "alt_max_ft", "aoa_events_gt10deg"]
    few = gold_of_flights(telemetry, ids, NOW).select(keys)
    many = gold_of_flights(telemetry, ids, NOW, broadcast_rows=0).select(keys)
    assert few.count() == many.count() > 0
    assert few.exceptAll(many).count() == 0


def test_stream_picks_up_only_new_files(spark, telemetry):
    landing, checkpoint = fresh_path(spark, "landing"), fresh_path(spark, "checkpoint")
    silver = new_table(spark)
    counts = []
    for step in (0, None, 1):
        if step is not None:
            part = telemetry.filter(F.col("flight_id") % 2 == step)
            part.coalesce(1).write.mode("append").parquet(landing)
        load_landed(spark, landing, silver, checkpoint).awaitTermination()
        counts.append(silver.read().count())
    even = telemetry.filter("flight_id % 2 = 0").count()
    assert counts == [even, even, telemetry.count()]


def load(spark, landing, silver, checkpoint=None, **options):
    load_landed(spark, landing, silver, checkpoint or fresh_path(spark, "checkpoint"), **options).awaitTermination()


def same_rows(silver, expected):
    found = silver.read().select(expected.columns)
    return found.exceptAll(expected).isEmpty() and expected.exceptAll(found).isEmpty()


def test_a_new_checkpoint_loads_only_further_files(spark, telemetry):
    landing, silver = fresh_path(spark, "landing"), new_table(spark)
    for part in (telemetry.filter("flight_id % 2 = 0"), None, telemetry.filter("flight_id % 2 = 1")):
        if part is not None:
            part.coalesce(2).write.mode("append").parquet(landing)
        load(spark, landing, silver, files_per_batch=1)
    assert same_rows(silver, telemetry)


def test_two_landing_folders(spark, telemetry):
    silver = new_table(spark)
    for odd in (0, 1):
        landing = fresh_path(spark, "landing")
        telemetry.filter(F.col("flight_id") % 2 == odd).coalesce(1).write.parquet(landing)
        load(spark, landing, silver)
    assert same_rows(silver, telemetry)


def test_old_files_are_loaded(spark, telemetry):
    landing, checkpoint, silver = fresh_path(spark, "landing"), fresh_path(spark, "checkpoint"), new_table(spark)
    telemetry.filter("flight_id % 2 = 0").coalesce(1).write.parquet(landing)
    load(spark, landing, silver, checkpoint)
    telemetry.filter("flight_id % 2 = 1").coalesce(1).write.mode("append").parquet(landing)
    loaded = {r.file_path for r in loads_of(silver).files().collect()}
    for file in Path(landing.removeprefix("file://")).glob("*.parquet"):
        if file.name not in {p.rsplit("/", 1)[-1] for p in loaded}:
            os.utime(file, (time.time() - 9 * 86_400,) * 2)
    load(spark, landing, silver, checkpoint)
    assert same_rows(silver, telemetry)


CRASHES = [("note", "before"), ("note", "after"), ("states", "after"), ("rows", "before"), ("rows", "half"), ("rows", "after")]


@pytest.mark.parametrize("step, when", CRASHES)
@pytest.mark.parametrize("same_checkpoint", [True, False])
def test_a_crash_neither_loses_nor_doubles(spark, telemetry, monkeypatch, step, when, same_checkpoint):
    """The load breaks off before, after or in the middle of one of its three writes."""
    landing, silver = fresh_path(spark, "landing"), new_table(spark)
    checkpoint = fresh_path(spark, "checkpoint")
    telemetry.repartition(2).write.parquet(landing)
    plain = CatalogTable.write_batch
    broken = {"note": loads_of(silver).table.name, "states": states_of(silver).name, "rows": silver.name}[step]

    def write(table, df, label):
        if table.name != broken:
            return plain(table, df, label)
        if when != "before":
            plain(table, df, label)
        if when == "half":  # only a part of the files has moved into place
            files = [f for f in table.rows().inputFiles() if label in f]
            assert len(files) == 2
            os.remove(files[0].removeprefix("file://"))
        raise RuntimeError("lost")

    with monkeypatch.context() as patch:
        patch.setattr(CatalogTable, "write_batch", write)
        with pytest.raises(Exception, match="lost"):
            load(spark, landing, silver, checkpoint)
    load(spark, landing, silver, checkpoint if same_checkpoint else None)
    load(spark, landing, silver, checkpoint)
    assert same_rows(silver, telemetry)
    found = states_of(silver).read().agg(F.sum("samples")).first()[0]
    assert found == telemetry.filter("flight_id IS NOT NULL").count()


def test_a_checkpoint_begun_anew_under_the_same_path(spark, telemetry):
    """The loaded file has left the landing folder, another one is there."""
    landing, silver = fresh_path(spark, "landing"), new_table(spark)
    checkpoint = fresh_path(spark, "checkpoint")
    for odd in (0, 1):
        telemetry.filter(F.col("flight_id") % 2 == odd).coalesce(1).write.mode("overwrite").parquet(landing)
        shutil.rmtree(checkpoint.removeprefix("file://"), ignore_errors=True)
        load(spark, landing, silver, checkpoint)
    assert same_rows(silver, telemetry)


def test_loaded_files_leave_the_landing_folder(spark, telemetry):
    """The source moves the files of a batch when the next one is done."""
    landing, silver = fresh_path(spark, "landing"), new_table(spark)
    checkpoint, archive = fresh_path(spark, "checkpoint"), fresh_path(spark, "archive")
    here, left = Path(landing.removeprefix("file://")), []
    for odd in (0, 1):
        telemetry.filter(F.col("flight_id") % 2 == odd).repartition(2).write.mode("append").parquet(landing)
        load(spark, landing, silver, checkpoint, archive=archive)
        for _ in range(30 * odd):  # a thread of their own moves them
            if len(list(here.glob("*.parquet"))) == 2:
                break
            time.sleep(0.1)
        left.append(len(list(here.glob("*.parquet"))))
    assert left == [2, 2] and same_rows(silver, telemetry)
    assert len(list(Path(archive.removeprefix("file://")).rglob("*.parquet"))) == 2


def test_intake_after_a_crash_and_a_load(spark, sf_dir, monkeypatch):
    """Flights that are loaded already are not written again under new names."""
    silver, gold = new_table(spark), new_table(spark)
    tables, checkpoint = intake_tables(spark, silver), fresh_path(spark, "checkpoint")
    files = recorded(spark, sf_dir)

    def crash(*_):
        raise RuntimeError("lost")

    with monkeypatch.context() as patch:
        patch.setattr(ingest, "status_rows", crash)
        with pytest.raises(RuntimeError, match="lost"):
            run_intake(*files, tables, NOW)
    load(spark, tables.landing, silver, checkpoint)
    before = silver.read().count()
    run_pipeline(spark, *files, tables, silver, gold, checkpoint, NOW)
    assert silver.read().count() == before > 0
    assert before == tables.lengths.read().agg(F.sum("n_rows")).first()[0]


def test_gold_waits_for_complete_flights(spark, telemetry):
    """A flight that arrives in two files enters Gold once, with all its rows."""
    silver, gold, lengths = new_table(spark), new_table(spark), new_table(spark)
    landing, checkpoint = fresh_path(spark, "landing"), fresh_path(spark, "checkpoint")
    flights = telemetry.filter("flight_id < 6")
    lengths.append(flights.groupBy("flight_id").agg(F.count("*").alias("n_rows")))
    half = F.col("flight_phase") <= 3
    seen = []
    for part in (flights.filter((F.col("flight_id") != 3) | half), flights.filter((F.col("flight_id") == 3) & ~half)):
        part.coalesce(1).write.mode("append").parquet(landing)
        load(spark, landing, silver, checkpoint, gold=gold, lengths=lengths)
        seen.append({r.flight_id for r in gold.read().collect()})
    assert 3 not in seen[0] and 3 in seen[1]
    expected = gold_rows(flights, NOW).select("flight_id", "flight_phase", "duration_sec")
    found = gold.read().select(expected.columns)
    assert found.exceptAll(expected).isEmpty() and found.count() == expected.count()


def test_gold_of_flights_split_over_loads(spark, telemetry):
    """States of several loads, put together, are the Gold of all samples; Silver is not read."""
    silver, gold, lengths = new_table(spark), new_table(spark), new_table(spark)
    landing, checkpoint = fresh_path(spark, "landing"), fresh_path(spark, "checkpoint")
    odd = telemetry.withColumn("airspeed", F.expr("if(longitude > 100, double('nan'), if(latitude < -80, NULL, airspeed))"))
    odd = settle(odd.withColumn("pitch_rate", F.expr("pitch_rate + 1e9")), "odd")
    lengths.append(odd.groupBy("flight_id").agg(F.count("*").alias("n_rows")))
    left = []
    for part in range(4):
        piece = odd.filter(F.pmod(F.hash("latitude", "longitude", "airspeed"), F.lit(4)) == part)
        piece.coalesce(1).write.mode("append").parquet(landing)
        load(spark, landing, silver, checkpoint, gold=gold, lengths=lengths, now=NOW)
        left.append(len(states_of(silver).batches()))
    want = settle(gold_rows(odd, NOW), "want")
    names = [c for c in want.columns if not c.startswith("record")]
    keyed = {(r.flight_id, r.flight_phase): r for r in gold.read().select(names).collect()}
    assert len(keyed) == want.count() == gold.read().count()
    for row in want.select(names).collect():
        other = keyed[row.flight_id, row.flight_phase]
        for name in names:
            assert other[name] == pytest.approx(row[name], rel=1e-9, abs=1e-6, nan_ok=True), name
    assert left[-1] == 1  # what Gold has needs no states


def test_gold_is_refreshed_without_silver(spark, telemetry, monkeypatch):
    silver, gold = new_table(spark), new_table(spark)
    telemetry_of = lambda *ids: telemetry.filter(F.col("flight_id").isin(*ids)).coalesce(1)
    landing, checkpoint = fresh_path(spark, "landing"), fresh_path(spark, "checkpoint")
    lengths = new_table(spark)
    lengths.append(telemetry.groupBy("flight_id").agg((F.count("*") + F.expr("int(flight_id = 1)")).alias("n_rows")))
    read = []
    plain, plain_write = CatalogTable.rows, CatalogTable.write_batch

    def write_batch(t, df, label):
        before = len(read)
        plain_write(t, df, label)
        del read[before:]  # writing looks up the columns only

    monkeypatch.setattr(CatalogTable, "rows", lambda t: read.append(t.name) or plain(t))
    monkeypatch.setattr(CatalogTable, "write_batch", write_batch)
    for ids in ((1, 2), (3,), (4,)):  # flight 1 stays incomplete
        telemetry_of(*ids).write.mode("append").parquet(landing)
        load(spark, landing, silver, checkpoint, gold=gold, lengths=lengths)
    assert {r.flight_id for r in gold.read().collect()} == {2, 3, 4}
    assert states_of(silver).name in read and silver.name not in read
    batches = states_of(silver).batches()
    assert len(batches) == 2 and batches[0].startswith("000000000")  # that of flight 1, and the last


def test_an_interrupted_gold_run_is_made_up_for(spark, telemetry, monkeypatch):
    silver, gold = new_table(spark), new_table(spark)
    silver.append(telemetry.filter("flight_id < 9"))
    plain = CatalogTable.write_batch

    def half(table, df, label):
        plain(table, df if table.name != gold.name else df.limit(5), label)
        if table.name == gold.name:
            raise RuntimeError("lost")

    with monkeypatch.context() as patch:
        patch.setattr(CatalogTable, "write_batch", half)
        with pytest.raises(RuntimeError, match="lost"):
            run_gold(silver, gold, NOW)
    run_gold(silver, gold, NOW)
    want = gold_rows(telemetry.filter("flight_id < 9"), NOW).select("flight_id", "flight_phase", "duration_sec")
    found = gold.read().select(want.columns)
    assert found.count() == want.count() and found.exceptAll(want).isEmpty()


def test_each_refresh_reads_the_clock(spark, telemetry):
    silver, gold = new_table(spark), new_table(spark)
    landing, checkpoint = fresh_path(spark, "landing"), fresh_path(spark, "checkpoint")
    times = iter(["2024-01-01 00:00:00", "2024-01-02 00:00:00"])
    for flight in (1, 2):
        telemetry.filter(F.col("flight_id") == flight).coalesce(1).write.mode("append").parquet(landing)
        load(spark, landing, silver, checkpoint, gold=gold, now=lambda: next(times))
    days = {(r.flight_id, str(r.record_created_at)[:10]) for r in gold.read().collect()}
    assert days == {(1, "2024-01-01"), (2, "2024-01-02")}


def test_the_chain_repeats_when_files_arrive(spark, sf_dir):
    silver, gold = new_table(spark), new_table(spark)
    tables, checkpoint, incoming = intake_tables(spark, silver), fresh_path(spark, "stream"), fresh_path(spark, "in")
    listing, attrs, samples = recorded(spark, sf_dir)
    for here in (listing.filter("relative_path < 'in/5'"), None, listing):
        if here is not None:
            here.select("relative_path").coalesce(1).write.mode("append").text(incoming)
        arrivals = []
        repeat_pipeline(
            spark, incoming, lambda found: arrivals.append(found.collect()) or (here, attrs, samples), tables, silver,
            gold, checkpoint, NOW,
        ).awaitTermination()
        # each pass lists the one file that has arrived, not the folder
        assert [len(files) for files in arrivals] == [1] * (here is not None)
        assert all(r.file_url.endswith(r.relative_path) and r.size > 0 for files in arrivals for r in files)
        assert here is None or tables.status.read().count() == here.count()
    assert gold.read().select("flight_id").distinct().count() == tables.bronze.read().count()


def test_failed_refresh_is_repeated_without_loading_twice(spark, telemetry):
    landing, checkpoint = fresh_path(spark, "landing"), fresh_path(spark, "checkpoint")
    silver = new_table(spark)
    telemetry.limit(40).coalesce(1).write.parquet(landing)
    calls = []

    def refresh():
        calls.append(1)
        if len(calls) == 1:
            raise RuntimeError("refresh lost")

    with pytest.raises(Exception, match="refresh lost"):
        stream = landed_files(spark, landing)
        start_load(stream, silver, checkpoint, after_load=refresh).awaitTermination()
    assert silver.read().count() == 40
    stream = landed_files(spark, landing)
    start_load(stream, silver, checkpoint, after_load=refresh).awaitTermination()
    assert silver.read().count() == 40 and len(calls) == 2


def test_stream_on_a_schedule(spark, telemetry):
    landing = fresh_path(spark, "landing")
    silver = new_table(spark)
    telemetry.limit(30).coalesce(1).write.parquet(landing)
    query = load_landed(
        spark, landing, silver, fresh_path(spark, "checkpoint"), every="1 second"
    )
    try:
        query.processAllAvailable()
        assert query.isActive and silver.read().count() == 30
    finally:
        query.stop()


def test_stream_into_catalog_tables(spark, telemetry):
    landing, checkpoint = fresh_path(spark, "landing"), fresh_path(spark, "checkpoint")
    silver, gold = CatalogTable(spark, "stream_silver"), CatalogTable(spark, "stream_gold")
    telemetry.filter("flight_id < 5").coalesce(1).write.parquet(landing)
    for _ in range(2):
        load_landed(spark, landing, silver, checkpoint, gold, NOW).awaitTermination()
    assert silver.read().count() == telemetry.filter("flight_id < 5").count()
    assert silver.read().columns == SILVER.names
    assert gold.read().select("flight_id").distinct().count() == (
        telemetry.filter("flight_id < 5").select("flight_id").distinct().count()
    )


def test_stream_calls_gold_after_each_load(spark, telemetry):
    landing, checkpoint = fresh_path(spark, "landing"), fresh_path(spark, "checkpoint")
    silver, gold = new_table(spark), new_table(spark)
    telemetry.filter("flight_id < 20").coalesce(1).write.parquet(landing)
    load_landed(spark, landing, silver, checkpoint, gold, NOW).awaitTermination()
    assert gold.read().select("flight_id").distinct().count() == (
        telemetry.filter("flight_id < 20").select("flight_id").distinct().count()
    )


def test_intake(spark, sf_dir):
    tables = intake_tables(spark)
    files = recorded(spark, sf_dir)
    total = files[0].count()
    assert run_intake(*files, tables, NOW).endswith(f"processed: {total}")
    assert run_intake(*files, tables, NOW).endswith("processed: 0")
    outcome = dict(tables.status.read().groupBy("status").count().collect())
    assert sum(outcome.values()) == total and outcome["Failed"] > 0
    assert tables.bronze.read().count() == outcome["Completed"]
    assert tables.ids.read().count() == total  # a failed file uses up its id
    landed = spark.read.option("recursiveFileLookup", "true").parquet(tables.landing)
    assert landed.select("flight_id").distinct().count() == outcome["Completed"]
    assert {"idx", *SILVER.names} == set(landed.columns)
    # failed files are tried again only on request, under the same id
    message = run_intake(*files, tables, NOW, retry_failed=True)
    assert message.endswith(f"processed: {outcome['Failed']}")
    assert tables.ids.read().count() == total


def test_intake_after_a_crash(spark, sf_dir, monkeypatch):
    tables = intake_tables(spark)
    files = recorded(spark, sf_dir)

    def crash(*_):
        raise RuntimeError("lost")

    with monkeypatch.context() as patch:
        patch.setattr(ingest, "status_rows", crash)
        with pytest.raises(RuntimeError, match="lost"):
            run_intake(*files, tables, NOW)
    assert not tables.status.exists()
    before = {tuple(r) for r in tables.ids.read().collect()}
    landed = spark.read.option("recursiveFileLookup", "true").parquet(tables.landing).count()
    bronze = tables.bronze.read().count()
    run_intake(*files, tables, NOW)
    assert {tuple(r) for r in tables.ids.read().collect()} == before
    assert spark.read.option("recursiveFileLookup", "true").parquet(tables.landing).count() == landed
    assert tables.bronze.read().count() == bronze
    assert tables.status.read().count() == files[0].count()


def test_intake_reads_the_slices_of_pending_files(spark, sf_dir):
    """Stored samples are laid out by hash; of three pending files at most three slices are read."""
    listing, attrs, samples = recorded(spark, sf_dir)
    stored, tables = new_table(spark), intake_tables(spark)
    ingest.store_samples(samples, stored)
    few = settle(listing.limit(3), "few")
    keys = few.select(F.md5("relative_path").alias(ingest.HASH))
    found = ingest._of_pending(stored.read(), settle(keys, "keys"))
    scan = found._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(hash_slice" in scan or "PartitionFilters: [hash_slice" in scan
    want = samples.join(keys, ingest.HASH, "left_semi")
    assert found.count() == want.count() > 0 and found.exceptAll(want.select(found.columns)).isEmpty()
    assert run_intake(few, attrs, stored.read(), tables, NOW).endswith("processed: 3")
    assert run_intake(listing, attrs, stored.read(), tables, NOW).endswith(f"processed: {listing.count() - 3}")
    others = intake_tables(spark)
    run_intake(listing, attrs, samples, others, NOW)
    columns = ["input_file_name", "status"]
    both = [t.status.read().select(columns) for t in (tables, others)]
    assert both[0].exceptAll(both[1]).isEmpty() and both[0].count() == both[1].count()


def test_signals_without_a_column_are_written_too(spark, sf_dir):
    listing, attrs, _ = recorded(spark, sf_dir)
    keyed = F.md5(fx.recording_path(F.col("flight_id"))).alias(ingest.HASH)
    samples = fx.signals(spark, sf_dir, others=True).select(keyed, "param", "idx", "num_value", "str_value")
    folder = fresh_path(spark, "others")
    tables = dataclasses.replace(intake_tables(spark), others=folder)
    run_intake(listing, attrs, samples, tables, NOW)
    found = spark.read.parquet(folder)
    assert {r.name for r in found.select("name").distinct().collect()} == {"OilTemp", "Flap", "Squawk"}
    rows = spark.read.option("recursiveFileLookup", "true").parquet(tables.landing)
    per_flight = found.filter("name = 'OilTemp'").groupBy("flight_id").count()
    assert per_flight.exceptAll(rows.groupBy("flight_id").count()).isEmpty() and not per_flight.isEmpty()


def test_file_without_samples_fails_alone(spark, sf_dir):
    tables = intake_tables(spark)
    listing, attrs, signals = recorded(spark, sf_dir)
    extra = listing.limit(1).withColumn("relative_path", F.lit("in/nothing.h5"))
    run_intake(listing.unionByName(extra), attrs, signals, tables, NOW)
    row = tables.status.read().filter("input_file_name = 'nothing.h5'").first()
    assert (row.status, row.status_msg) == ("Failed", "no samples")


def test_pipeline_without_any_good_file(spark, sf_dir):
    tables = intake_tables(spark)
    listing, attrs, signals = recorded(spark, sf_dir)
    message, run = run_pipeline(
        spark, listing, attrs, signals.filter("param <> 'FlightPhase'"), tables,
        new_table(spark), new_table(spark), fresh_path(spark, "checkpoint"), NOW,
    )
    assert run == GoldRun(0, 0)
    assert tables.status.read().filter("status = 'Failed'").count() == listing.count()


def test_pipeline_with_an_empty_listing(spark, sf_dir):
    tables = intake_tables(spark)
    listing, attrs, signals = recorded(spark, sf_dir)
    message, run = run_pipeline(
        spark, listing.limit(0), attrs, signals, tables,
        new_table(spark), new_table(spark), fresh_path(spark, "checkpoint"), NOW,
    )
    assert message.endswith("processed: 0") and run == GoldRun(0, 0)


def test_gold_command_on_catalog_tables(spark, telemetry):
    from flightloom.__main__ import gold_command, parser

    telemetry.filter("flight_id < 5").write.saveAsTable("cli_silver")
    args = parser().parse_args(["gold", "--silver", "cli_silver", "--gold", "cli_gold"])
    run = gold_command(spark, args)
    assert run.rows == spark.table("cli_gold").count() > 0
    assert gold_command(spark, args) == GoldRun(0, 0)
    telemetry.filter("flight_id = 7").write.mode("append").saveAsTable("cli_silver")
    assert gold_command(spark, args).flights == 1
    assert spark.table("cli_gold").columns == [*GOLD.names, "load_batch"]


def test_intake_with_more_files_than_are_broadcast(spark, sf_dir, monkeypatch):
    files = recorded(spark, sf_dir)
    few, many = intake_tables(spark), intake_tables(spark)
    run_intake(*files, few, NOW)
    monkeypatch.setattr(ingest, "fits_broadcast", lambda _: False)
    run_intake(*files, many, NOW)
    # the folder, which the message names too, is each run's own
    without_folder = [t.status.read().drop("output_file_path", "status_msg") for t in (few, many)]
    assert without_folder[0].exceptAll(without_folder[1]).count() == 0


def test_intake_into_catalog_tables(spark, sf_dir):
    names = ("cat_ids", "cat_bronze", "cat_status")
    tables = IntakeTables(*[CatalogTable(spark, n) for n in names], fresh_path(spark, "landing"))
    files = recorded(spark, sf_dir)
    total = files[0].count()
    assert run_intake(*files, tables, NOW).endswith(f"processed: {total}")
    assert run_intake(*files, tables, NOW).endswith("processed: 0")
    assert tables.status.read().count() == total == tables.ids.read().count()
    assert tables.bronze.read().columns == BRONZE.names
    failed = tables.status.read().filter("status = 'Failed'").count()
    message = run_intake(*files, tables, NOW, retry_failed=True)
    assert message.endswith(f"processed: {failed}")
    assert tables.ids.read().count() == total


def test_commands_from_files_to_gold(spark, sf_dir, tmp_path):
    """intake, load and run on named tables; the incoming files only set off the work."""
    from flightloom.__main__ import intake_command, load_command, parser, run_command

    listing, attrs, samples = recorded(spark, sf_dir)
    names = sorted(r.relative_path for r in listing.collect())
    for name in names:
        (tmp_path / name).parent.mkdir(parents=True, exist_ok=True)
        (tmp_path / name).write_bytes(b"x")
    attrs.write.saveAsTable("cmd_attrs")
    samples.write.saveAsTable("cmd_signals")
    common = ["--incoming", str(tmp_path), "--attrs", "cmd_attrs", "--signals", "cmd_signals", "--silver", "cmd_silver"]
    landing = ["--landing", fresh_path(spark, "landing"), "--prefix", "cmd_"]
    args = parser().parse_args(["intake", *common, *landing])
    assert intake_command(spark, args).endswith(f"processed: {len(names)}")
    stream = ["--silver", "cmd_silver", "--gold", "cmd_gold", "--checkpoint", fresh_path(spark, "stream")]
    load_command(spark, parser().parse_args(["load", *stream, *landing[:2], "--lengths", "cmd_lengths"]))
    before = spark.table("cmd_gold").count()
    assert before > 0
    run_command(spark, parser().parse_args(["run", *common, *landing, *stream[2:]]))
    assert spark.table("cmd_gold").count() == before
