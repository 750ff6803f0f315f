"""Streamed load of new Parquet files into Silver, and Gold after each load."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from flightloom.operators.gold_states import phase_states
from flightloom.schemas import SILVER
from flightloom.session import fits_broadcast, settle
from flightloom.sources.tables import FILE, BatchLog, CatalogTable, batch_log

ANY_AGE = "36500d"  # files are loaded however much older than the newest they are


def landed_files(
    spark: SparkSession,
    path: str,
    schema: T.StructType = SILVER,
    files_per_batch: int | None = None,
    archive: str | None = None,
) -> DataFrame:
    """New Parquet files below ``path`` as a stream, each row with its file's path, time and length.

    With ``archive``, a folder outside ``path``, the files of a batch move there once the next batch is done, so a
    trigger lists no more than the last batch and what is not loaded.
    """
    reader = (
        spark.readStream.schema(schema)
        .option("pathGlobFilter", "*.parquet")
        .option("recursiveFileLookup", "true")
        .option("maxFileAge", ANY_AGE)
    )
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    if archive:
        reader = reader.option("cleanSource", "archive").option("sourceArchiveDir", archive)
    return reader.parquet(path).select("*", *[F.col(f"_metadata.{name}") for name in FILE.names])


def states_of(silver: CatalogTable) -> CatalogTable:
    """What loads keep for Gold."""
    return CatalogTable(silver.spark, f"{silver.name}_states", silver.format)


def loads_of(silver: CatalogTable) -> BatchLog:
    return batch_log(silver, states_of(silver))


def start_load(
    stream: DataFrame,
    silver: CatalogTable,
    checkpoint: str,
    every: str | None = None,
    after_load: Callable[[], object] | None = None,
) -> StreamingQuery:
    """Append the files of each batch that Silver does not hold yet, then call ``after_load``.

    By default everything that is there is loaded and the query ends; ``every`` (for example
    "5 minutes") keeps it running. Files are recognised by path, time and length in the load log, whatever stream
    or checkpoint they come by. Each batch is a partition of its own under a label that is used once; a
    replay finds the batch whole, or drops what is left of it and loads it again. The states that Gold
    needs are written with it. ``after_load`` must be repeatable.
    """
    loads, states = loads_of(silver), states_of(silver)

    def load(batch: DataFrame, number: int) -> None:
        held = loads.files().withColumn("held", F.lit(True))
        files = batch.groupBy(FILE.names).agg(F.count("*").alias("n_rows"))
        files = settle(files.join(held, FILE.names, "left"), "batch-files")
        new = files.filter("held IS NULL").drop("held")
        n_new, n_all = files.agg(F.count_if(F.col("held").isNull()), F.count("*")).first()
        if n_new:
            rows = batch
            if n_new < n_all:
                names = new.select(FILE.names)
                rows = batch.join(F.broadcast(names) if fits_broadcast(names) else names, FILE.names, "left_semi")
            rows = rows.drop(*FILE.names)
            loads.write(rows, new, (states, phase_states(rows)))
        if after_load is not None:
            after_load()

    writer = stream.writeStream.foreachBatch(load).option("checkpointLocation", checkpoint)
    trigger = {"processingTime": every} if every else {"availableNow": True}
    return writer.trigger(**trigger).start()
