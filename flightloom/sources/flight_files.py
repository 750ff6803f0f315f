"""A data source that writes one folder per flight below a folder of the local or a mounted file system."""

from __future__ import annotations

import os
import shutil
from collections.abc import Iterator
from dataclasses import dataclass
from uuid import uuid4

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, WriterCommitMessage
from pyspark.sql.types import StructType
from pyspark.taskcontext import TaskContext

FLIGHT = "flight"  # the column that names the folder; it is not in the files
NO_FLIGHT = "__HIVE_DEFAULT_PARTITION__"


@dataclass
class Written(WriterCommitMessage):
    """What a task has written: its folder, with a folder per flight in it."""

    folder: str
    flights: list[str]


def runs_of(batch: pa.RecordBatch) -> Iterator[tuple[str, pa.RecordBatch]]:
    """The rows of each flight, which follow each other, with the name of its folder."""
    flights = batch.column(FLIGHT)
    keys = np.asarray(flights.fill_null(-1)), np.asarray(flights.is_null())
    changes = (keys[0][1:] != keys[0][:-1]) | (keys[1][1:] != keys[1][:-1])
    bounds = [0, *(np.flatnonzero(changes) + 1).tolist(), batch.num_rows]
    rows = batch.drop_columns([FLIGHT])
    for a, b in zip(bounds, bounds[1:]):
        if b > a:
            flight = flights[a].as_py()
            yield f"{FLIGHT}={NO_FLIGHT if flight is None else flight}", rows.slice(a, b - a)


class FlightFilesWriter(DataSourceArrowWriter):
    """Tasks write into folders of their own, which readers do not see; the commit moves those of the
    attempts that count into place, in place of the flights' earlier folders."""

    def __init__(self, path: str):
        self.path, self.staging = path, f"{path}/.staging-{uuid4().hex}"

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Written:
        done = Written(f"{self.staging}/{uuid4().hex}", [])
        name = f"part-{TaskContext.get().partitionId():05d}-{uuid4()}.snappy.parquet"
        flight, writer = None, None
        try:
            for batch in iterator:
                for found, rows in runs_of(batch):
                    if found != flight:
                        if writer:
                            writer.close()
                        os.makedirs(f"{done.folder}/{found}")  # an error if the rows are not sorted by flight
                        flight, writer = found, pq.ParquetWriter(f"{done.folder}/{found}/{name}", rows.schema)
                        done.flights.append(found)
                    writer.write_batch(rows)
        finally:
            if writer:
                writer.close()
        return done

    def commit(self, messages: list[Written | None]) -> None:
        replaced, placed = f"{self.staging}/replaced", set()
        os.makedirs(replaced)
        for message in filter(None, messages):
            for flight in message.flights:
                new, final = f"{message.folder}/{flight}", f"{self.path}/{flight}"
                if flight in placed:  # a long flight: the rows of a further task
                    for file in os.listdir(new):
                        os.rename(f"{new}/{file}", f"{final}/{file}")
                    continue
                earlier = os.path.isdir(final)
                if earlier:
                    os.rename(final, f"{replaced}/{flight}")
                try:
                    os.rename(new, final)
                except OSError:
                    if earlier:
                        os.rename(f"{replaced}/{flight}", final)
                    raise
                placed.add(flight)
        shutil.rmtree(self.staging)

    def abort(self, messages: list[Written | None]) -> None:
        shutil.rmtree(self.staging, ignore_errors=True)


class FlightFiles(DataSource):
    """``df.write.format("flight_files").mode("append").save(path)``: rows sorted by the column ``flight``."""

    @classmethod
    def name(cls) -> str:
        return "flight_files"

    def writer(self, schema: StructType, overwrite: bool) -> FlightFilesWriter:
        return FlightFilesWriter(self.options["path"])
