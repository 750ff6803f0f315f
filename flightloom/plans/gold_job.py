"""Incremental Gold run."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from datetime import datetime, timezone
from typing import Protocol

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flightloom.operators.gold import DEFAULT_SAMPLE_RATE_HZ, gold_rows
from flightloom.operators.gold_states import SAMPLES, gold_of_states
from flightloom.operators.keys import distinct_flights, new_flights, rows_of
from flightloom.session import BROADCAST_ROWS, settle
from flightloom.sources.tables import BATCH, CatalogTable, append_whole, batch_log

MOST_LABELS = 1000  # partitions that are named in a filter; with more, all states are read

Clock = Callable[[], datetime | str] | datetime | str


def utc_now() -> datetime:
    return datetime.now(timezone.utc)


def read_clock(clock: Clock) -> datetime | str:
    """The time of a run: a fixed one, or that of the given function."""
    return clock() if callable(clock) else clock


class Table(Protocol):
    def read(self) -> DataFrame: ...


@dataclass(frozen=True)
class GoldRun:
    flights: int
    rows: int


def in_id_range(silver: DataFrame, flights: DataFrame) -> DataFrame:
    """Silver between the lowest and highest of the (settled) ids. Ids grow over time, so the scan
    skips the row groups of earlier flights."""
    lowest, highest = flights.agg(F.min("flight_id"), F.max("flight_id")).first()
    if lowest is None:
        lowest, highest = 0, -1
    return silver.filter(F.col("flight_id").between(lowest, highest))


def gold_of_flights(
    silver: DataFrame,
    flights: DataFrame,
    now: datetime | str,
    sample_rate_hz: float = DEFAULT_SAMPLE_RATE_HZ,
    broadcast_rows: int = BROADCAST_ROWS,
) -> DataFrame:
    """Gold rows of the given distinct flights, which should be settled.

    A bounded id list is broadcast: Silver is filtered in the scan stage and never shuffled. Beyond
    the bound Silver is aggregated first and the ids are joined to the few rows per flight that
    are left: still no shuffle of samples, and no join key as large as a flight.
    """
    in_range = in_id_range(silver, flights)
    if flights.count() <= broadcast_rows:
        return gold_rows(rows_of(in_range, flights, broadcast_rows), now, sample_rate_hz)
    everything = gold_rows(in_range, now, sample_rate_hz)
    return everything.join(flights, "flight_id").select(everything.columns)


def run_gold(
    silver: Table,
    gold: CatalogTable,
    now: Clock,
    sample_rate_hz: float = DEFAULT_SAMPLE_RATE_HZ,
    broadcast_rows: int = BROADCAST_ROWS,
) -> GoldRun:
    """Append the metrics of flights that Gold does not have yet; a repeated run adds nothing.

    Every flight in Silver counts as complete. The new ids and rows are stored before Gold changes.
    """
    samples = silver.read()
    flights = settle(new_flights(samples, whole_rows(gold)), "new-flights")
    count = flights.count()
    if not count:
        return GoldRun(0, 0)
    rows = gold_of_flights(samples, flights, read_clock(now), sample_rate_hz, broadcast_rows)
    return GoldRun(count, append_whole(gold, rows))


def refresh_gold(
    states: CatalogTable,
    gold: CatalogTable,
    now: Clock,
    expected: DataFrame | None = None,
    sample_rate_hz: float = DEFAULT_SAMPLE_RATE_HZ,
) -> GoldRun:
    """The same from the states that loads leave (see ``gold_states``); Silver is not read.

    ``expected`` has one row (flight_id, n_rows) per accepted flight: a flight is taken when that many of its
    samples are loaded. Without it a flight is taken as it is. A load whose flights Gold has all is no longer
    needed, and its states go; so what is read here grows with the flights under way, not with Silver.
    """
    if not states.exists():
        return GoldRun(0, 0)
    present = whole_rows(gold)
    done = None if present is None else distinct_flights(present)
    # per load and flight: a narrow table, one row per flight that a load brought
    loaded = states.rows().groupBy("flight_id", BATCH).agg(F.sum(SAMPLES).alias("found"))
    waiting = settle(loaded if done is None else loaded.join(done, "flight_id", "left_anti"), "flights-under-way")
    found = waiting.groupBy("flight_id").agg(F.sum("found").alias("found"))
    if expected is not None:
        needed = expected.groupBy("flight_id").agg(F.max("n_rows").alias("n_rows"))
        found = found.join(needed, "flight_id").filter("found >= n_rows")
    flights = settle(found.select("flight_id"), "new-flights")
    count, rows = flights.count(), 0
    if count:
        rows = append_whole(gold, gold_of_states(_of_loads(states, waiting, flights), read_clock(now), sample_rate_hz))
    _retire(states, waiting.join(flights, "flight_id", "left_anti"))
    return GoldRun(count, rows)


def _of_loads(states: CatalogTable, waiting: DataFrame, flights: DataFrame) -> DataFrame:
    """The states of the given flights; only the partitions of loads that brought one of them are read."""
    brought = waiting.join(flights, "flight_id", "left_semi").select(BATCH).distinct()
    labels = [r[0] for r in brought.limit(MOST_LABELS + 1).collect()]
    rows = states.rows()
    if len(labels) <= MOST_LABELS:
        rows = rows.filter(F.col(BATCH).isin(labels))
    return rows.join(flights, "flight_id", "left_semi")


def _retire(states: CatalogTable, waiting: DataFrame) -> None:
    """Drop the states of loads none of whose flights waits any longer, in turn from the oldest on."""
    open_ = {r[0] for r in waiting.select(BATCH).distinct().collect()}  # labels of loads that are kept anyway
    for label in states.batches()[:-1]:  # the last one tells whether its load is whole
        if label not in open_:
            states.drop_batch(label)


def whole_rows(gold: CatalogTable) -> DataFrame | None:
    """Gold without what an interrupted run left."""
    if not gold.exists():
        return None
    batch_log(gold).recover()
    return gold.read()


def read_back(gold: DataFrame, flights: DataFrame) -> DataFrame:
    """The Gold rows of the (settled) flights of a run."""
    return rows_of(gold, flights)
