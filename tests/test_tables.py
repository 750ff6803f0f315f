"""Catalog tables, loads by name, listings, catalog settings."""

import shutil
from pathlib import Path

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from flightloom.schemas import STATUS
from flightloom.session import fresh_path, settle, shared_folder
from flightloom.sources.by_name import AmbiguousColumns, load_by_name, project_by_name
from flightloom.sources.catalog import rest_catalog_settings
from flightloom.sources import tables
from flightloom.sources.listing import list_files
from flightloom.sources.tables import NOTE, CatalogTable, KeyedTable, append_whole, batch_log, write_flight_files
from flightloom.workload.queries import fresh_table

NUMBERS = T.StructType([T.StructField("id", T.IntegerType()), T.StructField("v", T.StringType())])


def numbers(spark, *ids):
    return spark.createDataFrame([(i, f"v{i}") for i in ids], NUMBERS)


def ids(table):
    return sorted(r.id for r in table.read().collect())


@pytest.fixture
def table(spark):
    return fresh_table(spark, "t")


def test_missing_table(table):
    assert not table.exists()
    assert table.read_or_none() is None


def test_append(spark, table):
    table.append(numbers(spark, 1, 2))
    table.append(numbers(spark, 3))
    assert ids(table) == [1, 2, 3]


def test_append_by_name(spark, table):
    table.append(numbers(spark, 1))
    table.append(numbers(spark, 2).select("v", "id"))
    assert sorted((r.id, r.v) for r in table.read().collect()) == [(1, "v1"), (2, "v2")]


def test_batches(spark, table):
    assert table.batches() == [] and table.batch_rows("a-0") == 0
    table.write_batch(numbers(spark, 1, 2), "a-0")
    table.write_batch(numbers(spark, 3), "b-0")
    table.write_batch(numbers(spark, 4), "a-0")
    assert ids(table) == [3, 4] and table.read().columns == NUMBERS.names
    assert table.batches() == ["a-0", "b-0"] and table.batch_rows("b-0") == 1 and table.batch_rows("c-0") == 0
    table.drop_batch("a-0")
    table.drop_batch("c-0")
    assert ids(table) == [3] and table.batches() == ["b-0"]


# -- Tables whose rows are changed -----------------------------------------------------------------


@pytest.fixture
def keyed(spark, table):
    log = KeyedTable(spark, table.name, "v", buckets=4)
    log.append(numbers(spark, *range(100)).unionByName(spark.createDataFrame([(-1, None)], NUMBERS)))
    return log


def changed(keyed, *gone, plus=0):
    """Drop the rows of some keys; the ids of the others in their buckets grow."""
    names = [f"v{i}" for i in gone]
    here = F.coalesce(F.col("v").isin(names), F.lit(False))
    keyed.change(lambda rows: rows.filter(here), lambda rows: rows.filter(~here).withColumn("id", F.col("id") + plus))


def test_changes_touch_their_buckets_only(spark, keyed):
    bucket = {r.v: r.b for r in numbers(spark, *range(100)).select("v", keyed.bucket().alias("b")).collect()}
    before = {f for f in keyed.rows().inputFiles()}
    changed(keyed, 7, plus=1000)
    same = bucket["v7"]
    want = [i if bucket[f"v{i}"] != same else i + 1000 for i in range(100) if i != 7]
    assert sorted(i for i in ids(keyed) if i not in (-1, 999)) == sorted(want)
    assert {f for f in keyed.rows().inputFiles() if f"={same}/" not in f} == {f for f in before if f"={same}/" not in f}
    assert spark.sql(f"SHOW TABLES LIKE '{keyed.name}_change_*'").isEmpty()


def test_a_bucket_can_become_empty(spark, keyed):
    rows = numbers(spark, *range(100)).select("id", keyed.bucket().alias("b")).collect()
    gone = [r.id for r in rows if r.b == rows[0].b]
    changed(keyed, *gone)
    left = [i for i in range(100) if i not in gone]
    assert [i for i in ids(keyed) if i >= 0] == left
    keyed.append(numbers(spark, gone[0]))
    assert [i for i in ids(keyed) if i >= 0] == sorted([*left, gone[0]])


def test_a_change_of_nothing(spark, keyed):
    changed(keyed)
    assert ids(keyed) == list(range(-1, 100))


@pytest.mark.parametrize("then", ["append", "change", "read"])
@pytest.mark.parametrize("step", ["write", "before", "half", "after"])
def test_a_crash_leaves_old_or_new_rows(spark, keyed, monkeypatch, step, then):
    """The change breaks off while its rows are written, before its buckets are overwritten, between the
    removal of old files and the arrival of new ones, or before its own table goes."""
    plain = KeyedTable._overwrite

    def crash(table, change):
        if step == "after":
            plain(table, change)
        if step == "half":
            for r in spark.table(change).select("key_bucket").distinct().collect():
                folder = table.spark.sql(f"DESCRIBE FORMATTED {table.name}").filter("col_name = 'Location'").first()[1]
                shutil.rmtree(f"{folder.removeprefix('file:')}/key_bucket={r[0]}")
        raise RuntimeError("lost")

    with monkeypatch.context() as patch:
        if step != "write":
            patch.setattr(KeyedTable, "_overwrite", crash)
        with pytest.raises(Exception, match="lost"):
            if step == "write":
                keyed.change(lambda rows: rows, lambda rows: rows.withColumn("id", F.raise_error(F.lit("lost")).cast("int")))
            else:
                changed(keyed, 3, 4, 5)
    want = set(range(-1, 100)) - (set() if step == "write" else {3, 4, 5})
    assert ids(keyed) == sorted(want)
    if then == "append":
        keyed.append(numbers(spark, 500))
        want |= {500}
    if then == "change":
        changed(keyed, 50)
        want -= {50}
    assert ids(KeyedTable(spark, keyed.name, "v", buckets=4)) == sorted(want)


# -- The log of batches ------------------------------------------------------------------------------


def notes(spark, name, n):
    return spark.createDataFrame([(name, None, 1, n)], NOTE)


def test_an_interrupted_batch_is_dropped(spark, table):
    log = batch_log(table)
    log.write(numbers(spark, 1, 2), notes(spark, "a", 2))
    log.write(numbers(spark, 3), notes(spark, "b", 2))  # as if a file of the batch had not arrived
    assert ids(table) == [1, 2, 3]
    tables._whole.clear()  # another process
    later = batch_log(table)
    assert [r.file_path for r in later.files().collect()] == ["a"]
    assert ids(table) == [1, 2]
    later.write(numbers(spark, 3, 4), notes(spark, "b", 2))
    assert sorted(r.file_path for r in batch_log(table).files().collect()) == ["a", "b"]
    assert ids(table) == [1, 2, 3, 4]


def test_the_log_stays_small(spark, table, monkeypatch):
    monkeypatch.setattr(tables, "COMPACT_AFTER", 4)
    log = batch_log(table)
    read = []
    for i in range(14):
        log.write(numbers(spark, i), notes(spark, f"f{i}", 1))
        read.append(len(log.table.rows().inputFiles()))
    assert max(read) <= 5 and ids(table) == list(range(14))
    assert sorted(r.file_path for r in batch_log(table).files().collect()) == sorted(f"f{i}" for i in range(14))


def test_notes_twice_count_once(spark, table, monkeypatch):
    """Folding breaks off after the common note is written."""
    log = batch_log(table)
    for i in range(3):
        log.write(numbers(spark, i), notes(spark, f"f{i}", 1))
    with monkeypatch.context() as patch:
        patch.setattr(CatalogTable, "drop_batch", lambda *_: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            log.fold(log.table.batches())
    again = batch_log(table)
    assert sorted(r.file_path for r in again.files().collect()) == ["f0", "f1", "f2"]
    again.write(numbers(spark, 3), notes(spark, "f3", 1))
    assert ids(table) == [0, 1, 2, 3]


def test_whole_appends(spark, table):
    append_whole(table, numbers(spark, 1, 2))
    append_whole(table, numbers(spark, 3))
    table.write_batch(numbers(spark, 3).limit(0), table.batches()[-1])  # the rows of the last append are lost
    tables._whole.clear()
    append_whole(table, numbers(spark, 4))
    assert ids(table) == [1, 2, 4]


def test_load_by_name(spark):
    path = fresh_path(spark, "files")
    spark.range(2).selectExpr("CAST(id AS int) AS ID", "'a' AS V", "1 AS extra").write.parquet(path)
    spark.range(2, 3).selectExpr("CAST(id AS int) AS id").write.mode("append").parquet(path)
    spark.range(9).write.mode("append").option("compression", "none").json(path)
    rows = sorted(load_by_name(spark, path, NUMBERS, merge_columns=True).collect())
    assert [tuple(r) for r in rows] == [(0, "a"), (1, "a"), (2, None)]


def test_ambiguous_names(spark):
    spark.conf.set("spark.sql.caseSensitive", "true")
    try:
        df = spark.range(1).selectExpr("id", "1 AS ID")
        with pytest.raises(AmbiguousColumns):
            project_by_name(df, NUMBERS)
    finally:
        spark.conf.unset("spark.sql.caseSensitive")


@pytest.mark.parametrize("zone", ["UTC", "America/New_York"])
def test_time_into_long_is_epoch_micros(spark, zone):
    schema = T.StructType([T.StructField("flight_departure_dttm", T.LongType())])
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        df = spark.sql("SELECT TIMESTAMP_NTZ '2024-01-01 00:00:00' AS flight_departure_dttm")
        assert project_by_name(df, schema).first()[0] == 1704067200000000
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_number_overflow_is_an_error(spark):
    df = spark.sql("SELECT 3000000000 AS id, 'x' AS v")
    with pytest.raises(Exception, match="CAST_OVERFLOW"):
        project_by_name(df, NUMBERS).collect()


def test_listing(spark, tmp_path):
    (tmp_path / "a" / "b").mkdir(parents=True)
    (tmp_path / "a" / "b" / "x.h5").write_bytes(b"12345")
    (tmp_path / "a" / "empty.h5").write_bytes(b"")  # nothing to read, so not listed
    (tmp_path / "a" / "x.txt").write_bytes(b"1")
    rows = {r.relative_path: r for r in list_files(spark, str(tmp_path), "*.h5").collect()}
    assert {p: r.size for p, r in rows.items()} == {"a/b/x.h5": 5}
    before = rows["a/b/x.h5"].etag
    (tmp_path / "a" / "b" / "x.h5").write_bytes(b"123456")
    after = list_files(spark, str(tmp_path), "x.h5").first()
    assert after.etag != before


def test_listing_of_a_folder_whose_name_occurs_earlier(spark, tmp_path, monkeypatch):
    folder = tmp_path / "e" / "f"
    folder.mkdir(parents=True)
    (folder / "x.h5").write_bytes(b"1")
    for name in (str(tmp_path / "e"), f"file:{tmp_path}/e/", f"file://{tmp_path}/e"):
        assert [r.relative_path for r in list_files(spark, name).collect()] == ["f/x.h5"]


def test_listing_reads_no_contents(spark, tmp_path):
    (tmp_path / "x.h5").write_bytes(b"1")
    plan = list_files(spark, str(tmp_path))._jdf.queryExecution().executedPlan().toString()
    assert "length#" in plan and "content#" not in plan


def test_working_folder_is_the_configured_one(spark):
    assert shared_folder(spark) == spark.conf.get("spark.checkpoint.dir")
    df = settle(numbers(spark, 1), "x")
    assert all(f.startswith(f"file://{shared_folder(spark)}/x-") for f in df.inputFiles())


def test_rest_catalog_settings():
    found = rest_catalog_settings("lake", "https://example.org/api", "secret", scope="r")
    assert found["spark.sql.catalog.lake.type"] == "rest"
    assert found["spark.sql.catalog.lake.warehouse"] == "lake"
    assert found["spark.sql.defaultCatalog"] == "lake"
    assert found["spark.sql.catalog.lake.credential"] == "secret"
    assert "spark.jars" not in found
    with pytest.raises(ValueError):
        rest_catalog_settings("lake", "https://example.org/api", "")


def test_status_schema_is_seven_columns():
    assert len(STATUS.names) == 7


def flight_rows(spark, flights, value, per_flight=3):
    rows = [(f, i, value, None if i % 2 else "t") for f in flights for i in range(per_flight)]
    return spark.createDataFrame(rows, "flight_id int, idx long, airspeed double, name string").repartition(3, "flight_id")


def read_flights(spark, path):
    found = spark.read.option("recursiveFileLookup", "true").parquet(path)
    assert found.columns == ["flight_id", "idx", "airspeed", "name"]
    return sorted((r.flight_id, r.idx, r.airspeed) for r in found.collect())


def test_a_flight_is_one_file_and_nothing_else(spark, tmp_path):
    """No checksum file beside it: a local file system starts processes for each."""
    path = f"{tmp_path}/flight files"
    write_flight_files(flight_rows(spark, range(20), 1.0), path)
    names = sorted(str(p.relative_to(path)) for p in Path(path).rglob("*"))
    files = [n for n in names if "/" in n]
    assert sorted({n.split("/")[0] for n in names}) == sorted(f"flight={i}" for i in range(20))
    assert len(files) == 20 and all(n.endswith(".parquet") for n in files)


def test_flights_are_replaced_whole_and_others_stay(spark, tmp_path):
    path = f"file://{tmp_path}/flights"
    write_flight_files(flight_rows(spark, range(20), 1.0, per_flight=5), path)
    write_flight_files(flight_rows(spark, range(10, 30), 2.0), path)
    want = [(f, i, 1.0) for f in range(10) for i in range(5)] + [(f, i, 2.0) for f in range(10, 30) for i in range(3)]
    assert read_flights(spark, path) == want
    assert len(list(Path(f"{tmp_path}/flights").iterdir())) == 30


def test_a_long_flight_comes_from_several_tasks_and_batches(spark, tmp_path):
    path = f"{tmp_path}/flights"
    rows = spark.range(60_000).selectExpr("CAST(if(id < 50000, 7, 8) AS int) AS flight_id", "id AS idx", "0.5D AS airspeed", "'a' AS name")
    for _ in range(2):
        write_flight_files(rows.repartition(4, "idx"), path)
        assert read_flights(spark, path) == [(7 if i < 50_000 else 8, i, 0.5) for i in range(60_000)]
        assert len(list(Path(path).rglob("*.parquet"))) == 8


def test_a_failed_write_leaves_the_earlier_files(spark, tmp_path):
    path = f"{tmp_path}/flights"
    write_flight_files(flight_rows(spark, range(20), 1.0), path)
    bad = flight_rows(spark, range(20), 2.0).withColumn("airspeed", F.expr("if(flight_id = 13, raise_error('no'), airspeed)"))
    with pytest.raises(Exception, match="no"):
        write_flight_files(bad, path)
    assert read_flights(spark, path) == [(f, i, 1.0) for f in range(20) for i in range(3)]


def test_another_file_system_gets_the_same_files(spark, tmp_path, monkeypatch):
    """What Spark's own writer makes there."""
    arrow, other = f"{tmp_path}/arrow", f"{tmp_path}/other"
    write_flight_files(flight_rows(spark, [1, 2, None], 1.0), arrow)
    monkeypatch.setattr(tables, "qualified", lambda spark, path: f"store:{path}")
    write_flight_files(flight_rows(spark, [1, 2, None], 1.0), other)

    def rows(path):
        found = spark.read.parquet(path)
        return found.dtypes, sorted((tuple(r) for r in found.collect()), key=repr)

    assert rows(arrow) == rows(other) and len(rows(arrow)[1]) == 9
