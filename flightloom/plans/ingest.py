"""Batch intake: pending files to Bronze, flight files and the status log."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from flightloom.operators.manifest import assign_flight_ids, directory_view, pending_files
from flightloom.operators.metadata import bronze_rows, flight_metadata, with_output_name
from flightloom.operators.signals import (
    SILVER_SIGNALS,
    assemble,
    flight_frames,
    other_signals,
    signal_profile,
)
from flightloom.operators.status import status_rows
from flightloom.schemas import BRONZE, FLIGHT_IDS, STATUS
from flightloom.session import fits_broadcast, settle
from flightloom.sources.tables import BatchLog, CatalogTable, write_flight_files

HASH = "input_file_hash_rel"
SLICE = "hash_slice"  # partition column of stored samples: the first two digits of the hash, 256 values


@dataclass(frozen=True)
class IntakeTables:
    ids: CatalogTable
    bronze: CatalogTable
    status: CatalogTable
    landing: str  # folder of the per-flight Parquet files
    lengths: CatalogTable | None = None  # rows of each accepted flight, for Gold
    silver: CatalogTable | None = None  # with its load log: flights that are loaded are not written again
    loads: BatchLog | None = None
    others: str | None = None  # folder of the signals that Silver has no column for, in long form


def _read(table: CatalogTable, schema: T.StructType) -> DataFrame:
    found = table.read_or_none()
    return table.spark.createDataFrame([], schema) if found is None else found


def run_intake(
    listing: DataFrame,
    attrs: DataFrame,
    signals: DataFrame,
    tables: IntakeTables,
    now: datetime | str,
    retry_failed: bool = False,
    columns: dict[str, str] = SILVER_SIGNALS,
) -> str:
    """Process every listed file without a status row; one bad file does not stop the others.

    ``attrs`` and ``signals`` are the decoded recordings, keyed by ``input_file_hash_rel``;
    ``columns`` are the signal columns of the flight files (see ``assemble``). Data is
    written before Bronze and Bronze before the status rows. After a crash in between the files
    are still pending, get the ids they were given before, and overwrite the same flight folders,
    unless Silver has loaded them; a flight that already has its Bronze row does not get a second one.
    """
    pending = settle(
        pending_files(directory_view(listing), _read(tables.status, STATUS), retry_failed), "pending"
    )
    n_files = pending.count()
    if n_files:
        _process(pending, attrs, signals, tables, now, columns)
    return f"Preprocessing completed. Files processed: {n_files}"


def slice_of(hash_: Column) -> Column:
    return F.substring(hash_, 1, 2)


def store_samples(signals: DataFrame, table: CatalogTable) -> None:
    """Append decoded samples, laid out by slices of the file hash, so that intake reads those of pending files only."""
    sliced = signals.withColumn(SLICE, slice_of(F.col(HASH)))
    # a task per slice and part of it: few files, and no slice is one task
    dealt = sliced.repartition(SLICE, F.pmod(F.xxhash64(HASH, "param"), F.lit(4)))
    dealt.write.mode("append").format(table.format).partitionBy(SLICE).saveAsTable(table.name)


def _of_pending(signals: DataFrame, keys: DataFrame) -> DataFrame:
    """The samples of the pending files. Of samples laid out by ``store_samples`` only the slices that have one are
    read. A bounded key list is broadcast; with a longer one, skewed files are split by the optimizer."""
    if SLICE in signals.columns:
        touched = [r[0] for r in keys.select(slice_of(F.col(HASH))).distinct().collect()]  # at most 256
        signals = signals.filter(F.col(SLICE).isin(touched)).drop(SLICE)
    return signals.join(F.broadcast(keys) if fits_broadcast(keys) else keys, HASH, "left_semi")


def landed_folder(landing: str) -> Column:
    """Where the files of a flight lie."""
    return F.concat(F.lit(f"{landing}/flight="), F.col("flight_id").cast("string"))


def _loaded_flights(tables: IntakeTables) -> DataFrame | None:
    """Ids of the flights whose files are in Silver."""
    if tables.loads is None:
        return None
    folder = F.regexp_extract("file_path", "/flight=([0-9]+)/", 1)
    files = tables.loads.files().select(folder.alias("id")).filter("id <> ''")
    return files.select(F.col("id").cast("int").alias("flight_id")).distinct()


def _process(
    pending: DataFrame,
    attrs: DataFrame,
    signals: DataFrame,
    tables: IntakeTables,
    now: datetime | str,
    columns: dict[str, str],
) -> None:
    known = _read(tables.ids, FLIGHT_IDS)
    ids = settle(assign_flight_ids(pending, known), "flight-ids")
    tables.ids.append(ids.join(known, HASH, "left_anti"))

    files = pending.withColumnRenamed("file_hash_relpath", HASH)
    metadata = settle(
        with_output_name(
            flight_metadata(
                files.select(HASH, "relative_path", "file_name")
                .join(ids, HASH)
                .join(attrs.drop("file_name", "flight_id"), HASH, "left")
            )
        ),
        "metadata",
    )
    signals = _of_pending(signals, ids.select(HASH))
    profile = settle(signal_profile(signals, key=HASH), "profile")
    frames = settle(flight_frames(profile, HASH, columns), "frames")
    departures = metadata.select(HASH, "flight_id", "flight_departure_dttm")
    to_write, loaded = frames, _loaded_flights(tables)
    if loaded is not None:
        to_write = settle(frames.join(ids.join(loaded, "flight_id").select(HASH), HASH, "left_anti"), "to-write")
    silver = assemble(signals, profile, departures, HASH, to_write, columns)
    write_flight_files(silver, tables.landing)
    if tables.others is not None:
        further = other_signals(signals, profile, to_write, HASH, columns)
        write_flight_files(further.join(ids, HASH).drop(HASH), tables.others)

    outcome = metadata.join(frames.select(HASH, "base_len", "fault"), HASH, "left")
    # a file without any samples has no frame at all
    outcome = outcome.withColumn(
        "fault", F.when(F.col("base_len").isNull() & F.col("fault").isNull(), "no samples")
        .otherwise(F.col("fault"))
    )
    done = outcome.filter(F.col("fault").isNull())
    if tables.lengths is not None:
        lengths = done.select("flight_id", F.col("base_len").alias("n_rows"))
        noted = _read(tables.lengths, lengths.schema).select("flight_id")
        tables.lengths.append(lengths.join(noted, "flight_id", "left_anti"))
    present = _read(tables.bronze, BRONZE).select("flight_id")
    tables.bronze.append(bronze_rows(done.join(present, "flight_id", "left_anti"), now))
    tables.status.append(
        status_rows(
            outcome.select(
                "relative_path",
                landed_folder(tables.landing).alias("output_file_path"),
                F.col("base_len").alias("n_rows"),
                "fault",
            ),
            now,
        )
    )
