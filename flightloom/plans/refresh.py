"""The whole chain: intake, streamed load into Silver, Gold; once or whenever files arrive."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from flightloom.plans.gold_job import Clock, GoldRun, read_clock, refresh_gold, utc_now
from flightloom.plans.ingest import IntakeTables, run_intake
from flightloom.session import settle
from flightloom.sources.listing import listed
from flightloom.sources.tables import CatalogTable
from flightloom.streaming.intake import ANY_AGE, landed_files, start_load, states_of


def load_landed(
    spark: SparkSession,
    landing: str,
    silver: CatalogTable,
    checkpoint: str,
    gold: CatalogTable | None = None,
    now: Clock = utc_now,
    every: str | None = None,
    lengths: CatalogTable | None = None,
    files_per_batch: int | None = None,
    archive: str | None = None,
) -> StreamingQuery:
    """Load new files into Silver and, given a Gold table, refresh Gold after each load.

    ``now`` is read in each refresh. With the intake's ``lengths`` a flight enters Gold when
    all its rows are in Silver. Loaded files move to ``archive`` if it is given.
    """

    def refresh() -> None:
        expected = None if lengths is None else lengths.read_or_none()
        refresh_gold(states_of(silver), gold, now, expected)

    stream = landed_files(spark, landing, files_per_batch=files_per_batch, archive=archive)
    return start_load(stream, silver, checkpoint, every=every, after_load=refresh if gold is not None else None)


def run_pipeline(
    spark: SparkSession,
    listing: DataFrame,
    attrs: DataFrame,
    signals: DataFrame,
    tables: IntakeTables,
    silver: CatalogTable,
    gold: CatalogTable,
    checkpoint: str,
    now: Clock = utc_now,
) -> tuple[str, GoldRun]:
    """One pass over everything that is new. Gold runs even if nothing was loaded, so a Gold run
    that failed earlier is made up for."""
    message = run_intake(listing, attrs, signals, tables, read_clock(now))
    try:
        load = load_landed(spark, tables.landing, silver, checkpoint)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return message, GoldRun(0, 0)  # no flight file has ever been written
    load.awaitTermination()
    expected = None if tables.lengths is None else tables.lengths.read_or_none()
    return message, refresh_gold(states_of(silver), gold, now, expected)


Recordings = Callable[[DataFrame], tuple[DataFrame, DataFrame, DataFrame]]


def repeat_pipeline(
    spark: SparkSession,
    incoming: str,
    recordings: Recordings,
    tables: IntakeTables,
    silver: CatalogTable,
    gold: CatalogTable,
    checkpoint: str,
    now: Clock = utc_now,
    every: str | None = None,
) -> StreamingQuery:
    """Run the whole chain whenever files have arrived in ``incoming``.

    The files of a batch of arrivals are the listing; no folder is listed for it. Each pass hands it to
    ``recordings``, which returns the listing, attributes and samples to work on, and the status log decides what
    is new. A pass that failed meets the same files again. Contents of incoming files are not read here.
    ``every`` repeats on a schedule; by default what is there is processed and the query ends.
    """
    arrivals = (
        spark.readStream.format("binaryFile")
        .option("recursiveFileLookup", "true")
        .option("maxFileAge", ANY_AGE)
        .schema("path string, modificationTime timestamp, length long, content binary")
        .load(incoming)
        .select("path", "modificationTime", "length")
    )

    def process(batch: DataFrame, number: int) -> None:
        # settled, as it is read more than once
        arrived = settle(listed(batch, incoming), "arrivals")
        run_pipeline(spark, *recordings(arrived), tables, silver, gold, f"{checkpoint}/load", now)

    writer = arrivals.writeStream.foreachBatch(process).option("checkpointLocation", f"{checkpoint}/arrivals")
    trigger = {"processingTime": every} if every else {"availableNow": True}
    return writer.trigger(**trigger).start()
