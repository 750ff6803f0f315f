"""Work-list, ids, merge, delete and status rows."""

import pytest
from pyspark.sql import functions as F

from flightloom.operators import audits, keys, manifest, metadata, mutation, status
from flightloom.plans import status_session
from flightloom.schemas import BRONZE, FLIGHT_ATTRS, FLIGHT_IDS, STATUS
from flightloom.workload.queries import fresh_table

NOW = "2024-05-05 10:00:00"


def log(spark, rows):
    """(name, status) pairs."""
    given = spark.createDataFrame(rows, "input_file_name string, status string")
    return given.selectExpr(
        "concat('in/', input_file_name) AS file_relative_path", "input_file_name",
        "md5(concat('in/', input_file_name)) AS input_file_hash_rel", "'' AS output_file_path",
        "status", "'' AS status_msg", "TIMESTAMP_NTZ '2024-01-01 00:00:00' AS file_processed_dt",
    )


def listing(spark, rows):
    given = spark.createDataFrame(rows, "relative_path string, size long")
    return manifest.directory_view(
        given.selectExpr("relative_path", "relative_path AS file_url",
                         "TIMESTAMP_NTZ '2024-01-01 00:00:00' AS last_modified",
                         "'' AS etag", "size")
    )


def updates(spark, rows):
    given = spark.createDataFrame(rows, "input_file_name string, status string")
    return given.selectExpr("*", "'changed' AS status_msg",
                            f"TIMESTAMP_NTZ '{NOW}' AS file_processed_dt")


def merged(spark, target, source):
    df = mutation.merge_update(
        log(spark, target), updates(spark, source), "input_file_name", status_session.UPDATED
    )
    assert df.columns == STATUS.names
    return sorted(
        ((r.input_file_name, r.status) for r in df.collect()), key=lambda p: (p[0] or "", p[1])
    )


def test_merge_updates_every_match_and_ignores_the_rest(spark):
    found = merged(
        spark,
        [("a", "Pending"), ("a", "Failed"), ("b", "Pending"), (None, "Pending")],
        [("a", "Completed"), ("nowhere", "Completed"), (None, "Completed")],
    )
    assert found == [(None, "Pending"), ("a", "Completed"), ("a", "Completed"), ("b", "Pending")]


def test_merge_can_set_null(spark):
    assert merged(spark, [("a", "Pending")], [("a", None)]) == [("a", None)]


def test_merge_with_a_repeated_source_key_fails(spark):
    with pytest.raises(Exception, match="several source rows for a"):
        merged(spark, [("a", "Pending")], [("a", "x"), ("a", "y")])
    # unless no target row meets it
    assert merged(spark, [("b", "Pending")], [("a", "x"), ("a", "y")]) == [("b", "Pending")]


def test_like_wildcard(spark):
    names = [("pyspark_1", ""), ("pysparkX1", ""), ("pyspark", ""), (None, ""), ("x", "")]
    rows = log(spark, names)

    def kept(df):
        return sorted(r.input_file_name for r in df.collect())

    assert kept(status.named_like(rows)) == ["pysparkX1", "pyspark_1"]
    assert kept(status.named_like(rows, status.LITERAL_TEST_NAMES)) == ["pyspark_1"]


def test_delete_keeps_rows_with_a_null_predicate(spark):
    rows = log(spark, [("pyspark_1", ""), (None, ""), ("x", "")])
    left = mutation.delete_where(rows, F.col("input_file_name").like("pyspark_%"))
    assert {r.input_file_name for r in left.collect()} == {None, "x"}


def test_statements_parse(spark):
    parser = spark._jsparkSession.sessionState().sqlParser()
    merge = mutation.merge_statement("a.log", "changes", "input_file_name", ["status"])
    for text in (merge, mutation.delete_like_statement("a.log", "input_file_name")):
        parser.parsePlan(text)


def test_session_round_trip(spark):
    table = status_session.status_table(fresh_table(spark, "log"))
    table.append(log(spark, [("flight_1", "Completed")]))
    new = [("/test/pyspark_a.h5", "pyspark_a.h5", "h1", "out/a", "first"),
           ("/test/pyspark_b.h5", "pyspark_b.h5", "h2", "out/b", "second")]
    table.append(status_session.pending_rows(table.read(), new, NOW))
    assert status.named_like(table.read()).count() == 2
    assert status.with_status(table.read(), status.PENDING).count() == 2
    status_session.update_status(table, updates(spark, [("pyspark_a.h5", "Completed")]))
    row = status.named(table.read(), "pyspark_a.h5").first()
    assert (row.status, row.status_msg) == ("Completed", "changed")
    assert status_session.delete_test_rows(table) == 0
    assert [r.input_file_name for r in table.read().collect()] == ["flight_1"]
    assert status_session.query_latest(table.read()).count() == 1


def test_pending(spark):
    view = listing(spark, [("in/a", 1), ("in/b", 1), ("in/c", 1), ("in/empty", 0)])
    done = log(spark, [("a", "Completed"), ("a", "Completed"), ("b", "Failed")])
    found = manifest.pending_files(view, done)
    assert [r.relative_path for r in found.collect()] == ["in/c"]
    retried = manifest.pending_files(view, done, retry_failed=True)
    assert sorted(r.relative_path for r in retried.collect()) == ["in/b", "in/c"]
    assert manifest.pending_files(view.limit(0), done).count() == 0


@pytest.mark.parametrize("partitions", [1, 7])
def test_ids_are_dense_unique_and_stable(spark, partitions):
    view = listing(spark, [(f"in/{i}", 1) for i in range(500)]).repartition(partitions)
    view = view.unionByName(view.limit(3))  # a file listed twice is one file
    first = manifest.assign_flight_ids(view, spark.createDataFrame([], FLIGHT_IDS)).collect()
    assert sorted(r.flight_id for r in first) == list(range(1, 501))
    in_order = sorted(first, key=lambda r: r.input_file_hash_rel)
    assert [r.flight_id for r in in_order] == list(range(1, 501))
    known = spark.createDataFrame([r for r in first if r.flight_id > 480], FLIGHT_IDS)
    again = {r.input_file_hash_rel: r.flight_id
             for r in manifest.assign_flight_ids(view, known).collect()}
    for r in first:
        if r.flight_id > 480:
            assert again[r.input_file_hash_rel] == r.flight_id
    fresh = sorted(i for i in again.values() if i > 500)
    assert fresh == list(range(501, 981))


def test_new_flights(spark):
    silver = spark.createDataFrame([(1,), (1,), (2,), (None,)], "flight_id int")
    gold = spark.createDataFrame([(2,), (2,)], "flight_id int")
    assert [r.flight_id for r in keys.new_flights(silver, gold).collect()] == [1]
    assert sorted(r.flight_id for r in keys.new_flights(silver, None).collect()) == [1, 2]


@pytest.mark.parametrize("zone", ["UTC", "Asia/Seoul"])
def test_metadata_defaults(spark, zone):
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        attrs = spark.createDataFrame(
            [(1, "a.h5", "F1", "T1", "X", "LAX", "ICN", 1704067200, 12.9),
             (2, "b.h5", None, None, None, None, None, None, None)],
            FLIGHT_ATTRS,
        )
        full = metadata.with_output_name(metadata.flight_metadata(attrs)).orderBy("flight_id")
        names = [r.output_name for r in full.collect()]
        assert names == ["T1_F1_LAX_ICN_20240101000000.parquet", "_____19700101000000.parquet"[1:]]
        bronze = metadata.bronze_rows(metadata.flight_metadata(attrs), NOW).orderBy("flight_id")
        assert [f.dataType for f in bronze.schema] == [f.dataType for f in BRONZE]
        one, two = bronze.collect()
        assert (str(one.flight_date), one.qar_recorded_data_seconds) == ("2024-01-01", 12)
        assert (two.flight_number, str(two.flight_departure_utc)) == ("", "1970-01-01 00:00:00")
        assert str(one.created_date) == NOW
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_status_rows(spark):
    files = spark.createDataFrame(
        [("in/x/a.h5", "out/a.parquet", 10, None), ("in/b.h5", "out/b.parquet", None, "e" * 600)],
        "relative_path string, output_file_path string, n_rows long, fault string",
    )
    good, bad = status.status_rows(files, NOW).orderBy("file_relative_path", ascending=False).collect()
    assert (good.input_file_name, good.status) == ("a.h5", "Completed")
    assert good.status_msg == "Processed 10 rows | out/a.parquet"
    assert (bad.status, bad.output_file_path, len(bad.status_msg)) == ("Failed", "", 500)


def test_audits(spark):
    bronze = spark.createDataFrame([(1,), (1,), (2,)], "flight_id int")
    silver = spark.createDataFrame([(1,), (3,), (3,), (None,)], "flight_id int")
    assert [tuple(r) for r in audits.duplicate_flights(bronze).collect()] == [(1, 2)]
    assert [tuple(r) for r in audits.orphan_flights(silver, bronze).collect()] == [(3, 2)]
    counts = audits.table_counts({"bronze": bronze, "silver": silver}).collect()
    assert [tuple(r) for r in counts] == [("bronze", 3), ("silver", 4)]


def test_fixture_expectations(spark, sf_dir):
    if not sf_dir.endswith("sf0.01"):
        pytest.skip("known for sf0.01")
    import __spark_entry__ as contract

    queries = contract.queries()
    assert queries["pending_files"](spark, sf_dir).count() == 156
    assert queries["filter_like"](spark, sf_dir).count() == 63
    assert queries["new_flights"](spark, sf_dir).count() == 34
    assert queries["dq_pk"](spark, sf_dir).count() == 4
    orphans = queries["dq_fk"](spark, sf_dir).agg(F.sum("n_rows")).first()[0]
    assert orphans == 3022
