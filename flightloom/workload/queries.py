"""One registered query per operator, on whole tables."""

from __future__ import annotations

from collections.abc import Callable
from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from flightloom.functions.columns import headwind
from flightloom.operators import audits, gold, keys, manifest, metadata, mutation, signals, status
from flightloom.plans import status_session
from flightloom.plans.gold_job import gold_of_flights, read_back, run_gold
from flightloom.plans.ingest import IntakeTables, landed_folder
from flightloom.plans.refresh import load_landed, repeat_pipeline, run_pipeline
from flightloom.schemas import SILVER
from flightloom.session import fresh_path, settle
from flightloom.sources.by_name import load_by_name
from flightloom.sources.listing import list_files
from flightloom.sources.tables import CatalogTable, append_whole, write_flight_files
from flightloom.streaming.intake import loads_of
from flightloom.workload import fixtures as fx

Query = Callable[[SparkSession, str], DataFrame]

DECIMALS = 6  # the engines add doubles in different orders

# lineitem under other names: case differs, one column is absent, the others are dropped
BY_NAME_SCHEMA = T.StructType(
    [
        T.StructField("L_OrderKey", T.LongType()),
        T.StructField("L_LINENUMBER", T.IntegerType()),
        T.StructField("l_Quantity", T.DoubleType()),
        T.StructField("L_ReturnFlag", T.StringType()),
        T.StructField("l_shipDate", T.TimestampNTZType()),
        T.StructField("l_not_recorded", T.DoubleType()),
    ]
)


def rounded(df: DataFrame) -> DataFrame:
    """Doubles at six decimals, with one zero."""
    return df.selectExpr(
        *[
            f"round({f.name}, {DECIMALS}) + 0D AS {f.name}"
            if f.dataType == T.DoubleType()
            else f.name
            for f in df.schema.fields
        ]
    )


def fresh_table(spark: SparkSession, label: str) -> CatalogTable:
    """A table name of its own for each run."""
    return CatalogTable(spark, f"{label}_{uuid4().hex}")


# -- Gold ------------------------------------------------------------------------------------


def gold_group(group: str) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        df = gold.phase_metrics(fx.telemetry(spark, sf_dir), [group])
        return rounded(df.select(*gold.KEYS, *gold.metric_names(group)))

    return run


def gold_duration(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gold.phase_metrics(fx.telemetry(spark, sf_dir), [])


def gold_full(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(gold.gold_rows(fx.telemetry(spark, sf_dir), fx.NOW))


def headwind_samples(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(
        fx.telemetry(spark, sf_dir).select(
            "flight_id", "flight_phase", headwind().alias("headwind_kts")
        )
    )


# -- Incremental -----------------------------------------------------------------------------


def _new_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return keys.new_flights(fx.telemetry(spark, sf_dir), fx.gold_prev(spark, sf_dir))


def distinct_flights(spark: SparkSession, sf_dir: str) -> DataFrame:
    return keys.distinct_flights(fx.telemetry(spark, sf_dir))


def incremental_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return keys.rows_of(fx.telemetry(spark, sf_dir), settle(_new_ids(spark, sf_dir), "new-flights"))


def gold_readback(spark: SparkSession, sf_dir: str) -> DataFrame:
    table = fresh_table(spark, "gold")
    append_whole(table, gold.gold_rows(fx.telemetry(spark, sf_dir), fx.NOW))
    return rounded(read_back(table.read(), settle(_new_ids(spark, sf_dir), "new-flights")))


def gold_append(spark: SparkSession, sf_dir: str) -> DataFrame:
    table = fresh_table(spark, "gold")
    append_whole(table, fx.gold_prev(spark, sf_dir))
    silver = fx.telemetry(spark, sf_dir)
    ids = settle(keys.new_flights(silver, table.read()), "new-flights")
    append_whole(table, gold_of_flights(silver, ids, fx.NOW))
    return rounded(table.read())


class _GivenSilver:
    """A table that is only read."""

    def __init__(self, df: DataFrame):
        self.df = df

    def read(self) -> DataFrame:
        return self.df


def gold_incremental(spark: SparkSession, sf_dir: str) -> DataFrame:
    table = fresh_table(spark, "gold")
    append_whole(table, fx.gold_prev(spark, sf_dir))
    silver = _GivenSilver(fx.telemetry(spark, sf_dir))
    run_gold(silver, table, fx.NOW)
    run_gold(silver, table, fx.NOW)  # finds nothing new
    return rounded(table.read())


# -- Files, ids, metadata --------------------------------------------------------------------


def list_given_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return list_files(spark, sf_dir, "*.parquet")


def scan_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fx.telemetry(spark, sf_dir)


def scan_sql(spark: SparkSession, sf_dir: str) -> DataFrame:
    return status_session.query_latest(fx.status_log(spark, sf_dir))


def load_named(spark: SparkSession, sf_dir: str) -> DataFrame:
    return load_by_name(spark, f"{sf_dir}/lineitem.parquet", BY_NAME_SCHEMA)


def dir_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    return manifest.directory_view(fx.dir_listing(spark, sf_dir))


def pending_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    view = manifest.directory_view(fx.dir_listing(spark, sf_dir))
    return manifest.pending_files(view, fx.earlier_log(spark, sf_dir)).select(
        "relative_path", "file_hash_relpath", "source_stage", "target_stage"
    )


def assign_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Logged files keep the id of their page; pending files continue after the highest."""
    assigned = fx.earlier_log(spark, sf_dir).select(
        "input_file_hash_rel",
        F.regexp_extract("file_relative_path", "([0-9]+)", 1).cast("int").alias("flight_id"),
    )
    view = manifest.directory_view(fx.dir_listing(spark, sf_dir))
    return manifest.assign_flight_ids(view, assigned)


def flight_metadata(spark: SparkSession, sf_dir: str) -> DataFrame:
    return metadata.bronze_rows(metadata.flight_metadata(fx.flight_attrs(spark, sf_dir)), fx.NOW)


def output_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    named = metadata.with_output_name(metadata.flight_metadata(fx.flight_attrs(spark, sf_dir)))
    return named.select("flight_id", "output_name")


# -- Signals ---------------------------------------------------------------------------------


def _settled_signals(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """The samples and their profile, each derived once and read back."""
    samples = settle(fx.signals(spark, sf_dir), "samples")
    return samples, settle(signals.signal_profile(samples), "profile")


def rename_signals(spark: SparkSession, sf_dir: str) -> DataFrame:
    renamed = signals.rename_signals(fx.signals(spark, sf_dir))
    return renamed.select("flight_id", "param", "column_name", "idx")


def clean_string(spark: SparkSession, sf_dir: str) -> DataFrame:
    cleaned = signals.clean_strings(fx.signals(spark, sf_dir))
    return cleaned.select("flight_id", "param", "idx", "clean_value")


def signal_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    profile = signals.signal_profile(fx.signals(spark, sf_dir))
    return rounded(
        profile.select("flight_id", "param", "n", "base_len", "ratio", "signal_kind")
    )


def resampled(kind: str) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        samples, profile = _settled_signals(spark, sf_dir)
        return rounded(signals.resample(samples, profile, [kind]))

    return run


def text_signal(spark: SparkSession, sf_dir: str) -> DataFrame:
    profile = signals.signal_profile(fx.signals(spark, sf_dir))
    return signals.text_signals(profile).select("flight_id", "param", "text_value", "base_len")


def _departures(spark: SparkSession, sf_dir: str) -> DataFrame:
    attrs = metadata.flight_metadata(fx.flight_attrs(spark, sf_dir))
    return attrs.select("flight_id", "flight_departure_dttm")


def _aligned(spark: SparkSession, sf_dir: str) -> DataFrame:
    samples, profile = _settled_signals(spark, sf_dir)
    frames = settle(signals.flight_frames(profile), "frames")
    return signals.assemble(samples, profile, _departures(spark, sf_dir), frames=frames)


def silver_wide(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(_aligned(spark, sf_dir))


def other_signals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The recorded signals that Silver has no column for."""
    samples = settle(fx.signals(spark, sf_dir, others=True), "samples")
    profile = settle(signals.signal_profile(samples), "profile")
    return rounded(signals.other_signals(samples, profile))


def reject_flights(spark: SparkSession, sf_dir: str) -> DataFrame:
    return signals.rejected_flights(signals.signal_profile(fx.signals(spark, sf_dir)))


def _outcomes(spark: SparkSession, sf_dir: str) -> DataFrame:
    frames = signals.flight_frames(signals.signal_profile(fx.signals(spark, sf_dir)))
    attrs = metadata.flight_metadata(fx.flight_attrs(spark, sf_dir))
    return metadata.with_output_name(attrs).join(
        frames.select("flight_id", "base_len", "n_signals", "fault"), "flight_id"
    )


def silver_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    outcome = _outcomes(spark, sf_dir).withColumns(
        {"n_rows": F.col("base_len"), "n_columns": F.col("n_signals") + 2}
    )
    return status.result_messages(outcome).select("flight_id", "n_rows", "n_columns", "message")


def silver_write(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The flights are written twice; the second write replaces the files of the first."""
    path = fresh_path(spark, "flights")
    wide = settle(_aligned(spark, sf_dir), "silver")
    write_flight_files(wide, path)
    write_flight_files(wide, path)
    return rounded(load_by_name(spark, path, SILVER))


# -- Status log ------------------------------------------------------------------------------


def status_append(spark: SparkSession, sf_dir: str) -> DataFrame:
    log = fresh_table(spark, "status")
    log.append(fx.status_log(spark, sf_dir))
    files = _outcomes(spark, sf_dir).select(
        fx.recording_path(F.col("flight_id")).alias("relative_path"),
        landed_folder("output-files").alias("output_file_path"),
        F.col("base_len").alias("n_rows"),
        "fault",
    )
    log.append(status.status_rows(files, fx.NOW))
    return log.read()


def filter_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    return status.with_status(fx.status_log(spark, sf_dir))


def filter_like(spark: SparkSession, sf_dir: str) -> DataFrame:
    return status.named_like(fx.status_log(spark, sf_dir))


def merge_update(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mutation.merge_update(
        fx.status_log(spark, sf_dir),
        fx.status_updates(spark, sf_dir),
        "input_file_name",
        status_session.UPDATED,
    )


def delete_where(spark: SparkSession, sf_dir: str) -> DataFrame:
    log = fx.status_log(spark, sf_dir)
    return mutation.delete_where(log, F.col("input_file_name").like(status.TEST_NAMES))


def verify_mutation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Merge and delete on a stored log, then count what the checks look at."""
    log = status_session.status_table(fresh_table(spark, "status"))
    log.append(fx.status_log(spark, sf_dir))
    status_session.update_status(log, fx.status_updates(spark, sf_dir))
    updated = settle(log.read(), "updated")
    status_session.delete_test_rows(log)
    return audits.table_counts(
        {
            "updated": updated.filter(F.col("status_msg").like("retried %")),
            "before_delete": status.named_like(updated),
            "after_delete": status.named_like(log.read()),
            "kept": log.read(),
        }
    )


def order_desc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return status.latest_first(fx.status_log(spark, sf_dir))


def top_recent(spark: SparkSession, sf_dir: str) -> DataFrame:
    return status.preview(status.latest_first(fx.status_log(spark, sf_dir)))


def count_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fx.telemetry(spark, sf_dir).agg(F.count(F.lit(1)).alias("n_rows"))


# -- Streams and whole runs ------------------------------------------------------------------


def _loaded(spark: SparkSession, sf_dir: str, with_gold: bool):
    """Files arrive in three portions, the last in a second folder; in between nothing new is found,
    also under a checkpoint that knows of nothing."""
    landing, other = fresh_path(spark, "landing"), fresh_path(spark, "landing")
    silver, gold_table = fresh_table(spark, "silver"), fresh_table(spark, "gold")
    first, second, third = (fresh_path(spark, "stream") for _ in range(3))
    rows = fx.telemetry(spark, sf_dir)
    lengths = None
    if with_gold:
        lengths = fresh_table(spark, "lengths")
        lengths.append(rows.groupBy("flight_id").agg(F.count("*").alias("n_rows")))
    portion = F.col("flight_id") % 3
    for folder, checkpoint, part in (
        (landing, first, 0), (landing, first, 1), (landing, first, None), (landing, second, None), (other, third, 2),
    ):
        if part is not None:
            rows.filter(portion == part).write.mode("append").parquet(folder)
        load_landed(
            spark, folder, silver, checkpoint, gold_table if with_gold else None, fx.NOW, lengths=lengths
        ).awaitTermination()
    return silver, gold_table


def stream_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _loaded(spark, sf_dir, with_gold=False)[0].read()


def stream_gold(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(_loaded(spark, sf_dir, with_gold=True)[1].read())


def _chain(spark: SparkSession):
    silver = fresh_table(spark, "silver")
    tables = IntakeTables(
        *[fresh_table(spark, label) for label in ("ids", "bronze", "status")],
        landing=fresh_path(spark, "landing"),
        lengths=fresh_table(spark, "lengths"),
        silver=silver,
        loads=loads_of(silver),
    )
    return tables, silver, fresh_table(spark, "gold"), fresh_path(spark, "stream")


def _decoded(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """The recordings with their samples derived once; every pass of the intake reads them several times."""
    listing, attrs, samples = fx.recordings(spark, sf_dir)
    return listing, attrs, settle(samples, "samples")


def intake_to_gold(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Recordings to Gold in one run; a second run over the same files changes nothing."""
    tables, silver, gold_table, checkpoint = _chain(spark)
    files = _decoded(spark, sf_dir)
    for _ in range(2):
        run_pipeline(spark, *files, tables, silver, gold_table, checkpoint, fx.NOW)
    return rounded(gold_table.read())


def pipeline_repeat(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole chain set off by two arrivals; the second brings the files with the higher hashes."""
    tables, silver, gold_table, checkpoint = _chain(spark)
    incoming = fresh_path(spark, "incoming")
    listing, attrs, samples = _decoded(spark, sf_dir)
    for arrived in (F.md5("relative_path") < "8", F.lit(True)):
        listing.filter(arrived).select("relative_path").write.mode("append").text(incoming)
        here = listing.filter(arrived)
        repeat_pipeline(
            spark, incoming, lambda arrived, here=here: (here, attrs, samples), tables, silver, gold_table, checkpoint, fx.NOW
        ).awaitTermination()
    return rounded(gold_table.read())


# -- Audits ----------------------------------------------------------------------------------


def dq_pk(spark: SparkSession, sf_dir: str) -> DataFrame:
    attrs = metadata.flight_metadata(fx.repeated_attrs(spark, sf_dir))
    return audits.duplicate_flights(metadata.bronze_rows(attrs, fx.NOW))


def dq_fk(spark: SparkSession, sf_dir: str) -> DataFrame:
    attrs = fx.flight_attrs(spark, sf_dir).filter(F.col("flight_id") % 20 != 19)
    bronze = metadata.bronze_rows(metadata.flight_metadata(attrs), fx.NOW)
    return audits.orphan_flights(fx.telemetry(spark, sf_dir), bronze)


def dq_name_collision(spark: SparkSession, sf_dir: str) -> DataFrame:
    attrs = metadata.flight_metadata(fx.repeated_attrs(spark, sf_dir))
    return audits.name_collisions(metadata.with_output_name(attrs))


def dq_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    silver = fx.telemetry(spark, sf_dir)
    return audits.table_counts(
        {
            "bronze": fx.flight_attrs(spark, sf_dir),
            "status": fx.status_log(spark, sf_dir),
            "silver": silver,
            "gold": gold.gold_rows(silver, fx.NOW),
        }
    )


def registry() -> dict[str, Query]:
    return {
        "list_files": list_given_files,
        "scan_all": scan_all,
        "scan_sql": scan_sql,
        "load_by_name": load_named,
        "silver_write": silver_write,
        "gold_append": gold_append,
        "status_append": status_append,
        "dir_view": dir_view,
        "filter_status": filter_status,
        "filter_like": filter_like,
        "assign_ids": assign_ids,
        "flight_metadata": flight_metadata,
        "output_name": output_names,
        "rename_signals": rename_signals,
        "clean_string": clean_string,
        "headwind": headwind_samples,
        "signal_profile": signal_profile,
        "resample_down": resampled("down"),
        "resample_up": resampled("up"),
        "resample_pass": resampled("pass"),
        "text_signal": text_signal,
        "silver_wide": silver_wide,
        "other_signals": other_signals,
        "reject_flights": reject_flights,
        "silver_counts": silver_counts,
        "pending_files": pending_files,
        "new_flights": _new_ids,
        "incremental_rows": incremental_rows,
        "distinct_flights": distinct_flights,
        "count_rows": count_rows,
        "gold_duration": gold_duration,
        **{f"gold_{group}": gold_group(group) for group in gold.METRIC_GROUPS},
        "gold_full": gold_full,
        "gold_readback": gold_readback,
        "gold_incremental": gold_incremental,
        "merge_update": merge_update,
        "delete_where": delete_where,
        "verify_mutation": verify_mutation,
        "order_desc": order_desc,
        "top_recent": top_recent,
        "stream_load": stream_load,
        "stream_gold": stream_gold,
        "intake_to_gold": intake_to_gold,
        "pipeline_repeat": pipeline_repeat,
        "dq_pk": dq_pk,
        "dq_fk": dq_fk,
        "dq_name_collision": dq_name_collision,
        "dq_counts": dq_counts,
    }
