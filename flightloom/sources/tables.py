"""Catalog tables that jobs read, append to and change, and the log of what they hold."""

from __future__ import annotations

from collections.abc import Callable
from uuid import uuid4

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from flightloom.session import settle
from flightloom.sources.by_name import project_by_name
from flightloom.sources.flight_files import FLIGHT, FlightFiles
from flightloom.sources.listing import qualified

BATCH = "load_batch"  # partition column of tables that are written batch by batch
BUCKET = "key_bucket"  # partition column of tables whose rows are changed
ROW_LEVEL_FORMATS = ("iceberg", "delta")


class CatalogTable:
    """A named table of the session's catalog. The partition column of batches is not shown."""

    def __init__(self, spark: SparkSession, name: str, table_format: str = "parquet"):
        self.spark, self.name, self.format = spark, name, table_format

    @property
    def row_level(self) -> bool:
        """Whether the catalog can change rows by MERGE and DELETE."""
        return self.format in ROW_LEVEL_FORMATS

    def exists(self) -> bool:
        return self.spark.catalog.tableExists(self.name)

    def rows(self) -> DataFrame:
        """All columns. Streams write in sessions of their own, so the list of files is looked up anew."""
        self.spark.catalog.refreshTable(self.name)
        return self.spark.table(self.name)

    def read(self) -> DataFrame:
        return self.rows().drop(BATCH)

    def read_or_none(self) -> DataFrame | None:
        return self.read() if self.exists() else None

    def append(self, df: DataFrame) -> None:
        """Add rows by column name; the first append creates the table."""
        if self.exists():
            df = project_by_name(df, self.read().schema)
        df.write.mode("append").format(self.format).saveAsTable(self.name)

    def write_batch(self, df: DataFrame, label: str) -> None:
        """Put ``df`` into the partition ``label`` in place of what it holds."""
        if not self.exists():
            empty = df.limit(0).withColumn(BATCH, F.lit("").cast("string"))
            empty.write.format(self.format).partitionBy(BATCH).saveAsTable(self.name)
        rows = project_by_name(df, self.read().schema)
        # a stream's batch belongs to a session of its own
        rows.sparkSession.sql(
            f"INSERT OVERWRITE TABLE {self.name} PARTITION ({BATCH} = '{label}') SELECT * FROM {{rows}}",
            rows=rows,
        )

    def batches(self) -> list[str]:
        """The labels of the batches, in order; known to the catalog, no file is read."""
        if not self.exists():
            return []
        if self.row_level:
            return sorted(r[0] for r in self.rows().select(BATCH).distinct().collect())
        found = self.spark.sql(f"SHOW PARTITIONS {self.name}").collect()
        return sorted(r[0].split("=", 1)[1] for r in found)

    def batch_rows(self, label: str) -> int:
        """The rows of a batch, from the footers of its files."""
        return self.rows().filter(F.col(BATCH) == label).count() if self.exists() else 0

    def drop_batch(self, label: str) -> None:
        if not self.exists():
            return
        if self.row_level:
            self.spark.sql(f"DELETE FROM {self.name} WHERE {BATCH} = '{label}'")
        else:
            self.spark.sql(f"ALTER TABLE {self.name} DROP IF EXISTS PARTITION ({BATCH} = '{label}')")


class KeyedTable(CatalogTable):
    """A table of files whose rows can be changed.

    Rows are laid out by a hash bucket of their key, and a change touches the buckets of its keys only. Their
    new rows are first written to a table of their own, which the catalog knows once it is whole; then the
    buckets are overwritten from it and it is dropped. Until then readers take these buckets from
    there, and the next change finishes what was interrupted. So a crash at any point leaves the old rows
    or the new ones. One change at a time. Appends are not protected: a repeated run appends what is missing.
    """

    PRESENT = "is_present"

    def __init__(self, spark: SparkSession, name: str, key: str, table_format: str = "parquet", buckets: int = 32):
        super().__init__(spark, name, table_format)
        self.key, self.buckets = key, buckets

    def bucket(self) -> Column:
        return F.pmod(F.xxhash64(self.key), F.lit(self.buckets)).cast("int")

    def append(self, df: DataFrame) -> None:
        if self.row_level:
            super().append(df)
            return
        if self.exists():
            self.finish_changes()
            df = project_by_name(df, self.read().schema)
        placed = df.withColumn(BUCKET, self.bucket())
        placed.write.mode("append").format(self.format).partitionBy(BUCKET).saveAsTable(self.name)

    def _unfinished(self) -> list[str]:
        """Tables with the new rows of buckets that may not have been overwritten yet."""
        *database, name = self.name.split(".")
        where = f" IN {'.'.join(database)}" if database else ""
        found = self.spark.sql(f"SHOW TABLES{where} LIKE '{name}_change_*'").collect()
        return [".".join([*database, r.tableName]) for r in found]

    def rows(self) -> DataFrame:
        rows = super().rows()
        for change in [] if self.row_level else self._unfinished():
            new = self.spark.table(change)
            touched = [r[0] for r in new.select(BUCKET).distinct().collect()]  # at most one row a bucket
            kept = rows.filter(~F.col(BUCKET).isin(touched))
            rows = kept.unionByName(new.filter(self.PRESENT).drop(self.PRESENT))
        return rows

    def read(self) -> DataFrame:
        return self.rows().drop(BUCKET)

    def change(self, keys: Callable[[DataFrame], DataFrame], new_rows: Callable[[DataFrame], DataFrame]) -> None:
        """Put ``new_rows(rows)`` in place of the rows of all buckets that ``keys(rows)`` fall into; keys stay."""
        self.finish_changes()
        rows = self.read()
        touched = sorted(r[0] for r in keys(rows).select(self.bucket()).distinct().collect())  # at most one a bucket
        if not touched:
            return
        old = self.rows().filter(F.col(BUCKET).isin(touched)).drop(BUCKET)
        new = new_rows(old).select(*old.columns, self.bucket().alias(BUCKET), F.lit(True).alias(self.PRESENT))
        # a bucket without rows needs a trace as well
        traces = self.spark.createDataFrame([(b, False) for b in touched], f"{BUCKET} int, {self.PRESENT} boolean")
        name = f"{self.name}_change_{uuid4().hex}"
        new.unionByName(traces, allowMissingColumns=True).write.format(self.format).saveAsTable(name)
        self.finish_changes()

    def finish_changes(self) -> None:
        """Overwrite the touched buckets with their new rows; may be repeated."""
        for change in [] if self.row_level or not self.exists() else self._unfinished():
            self._overwrite(change)
            self.spark.sql(f"DROP TABLE IF EXISTS {change}")

    def _overwrite(self, change: str) -> None:
        # only the buckets that have rows; the setting is that of a session of its own
        session = self.spark.newSession()
        session.conf.set("spark.sql.sources.partitionOverwriteMode", "dynamic")
        found = session.table(change)
        new = found.filter(self.PRESENT).drop(self.PRESENT)
        columns = [c for c in session.table(self.name).columns if c != BUCKET]
        new.select(*columns, BUCKET).write.insertInto(self.name, overwrite=True)
        sizes = found.groupBy(BUCKET).agg(F.count_if(self.PRESENT).alias("n"))
        for row in sizes.filter("n = 0").collect():
            self.spark.sql(f"ALTER TABLE {self.name} DROP IF EXISTS PARTITION ({BUCKET} = {row[0]})")
        self.spark.catalog.refreshTable(self.name)


FILE = T.StructType(
    [
        T.StructField("file_path", T.StringType()),
        T.StructField("file_modification_time", T.TimestampType()),
        T.StructField("file_size", T.LongType()),
    ]
)
NOTE = T.StructType([*FILE.fields, T.StructField("n_rows", T.LongType())])
COMPACT_AFTER = 64  # batches noted one by one; beyond it they are put together
FOLDED = "+"  # ends the label of notes that were put together
_whole: dict[str, str] = {}  # the last batch that this process saw whole, by the name of the log


class BatchLog:
    """What was written to a table, batch by batch: files and their numbers of rows.

    A batch is noted with its number of rows before they are written, under a label that is never
    used again. The last one may have been interrupted: it counts if as many rows are there as were noted;
    otherwise its note and its rows are dropped. Files that move into place one by one can so
    neither be lost nor doubled, whatever stream, checkpoint or run comes next. Earlier notes are put
    together, so that a bounded number of files is read however many batches there were. One
    writer at a time.
    """

    def __init__(self, target: CatalogTable, name: str, followers: tuple[CatalogTable, ...] = ()):
        self.target, self.followers = target, followers
        self.table = CatalogTable(target.spark, name, target.format)

    def recover(self) -> list[str]:
        """Drop the last batch if it is not whole. Returns the labels that are left."""
        labels = self.table.batches()
        last = labels[-1] if labels else FOLDED
        if last.endswith(FOLDED) or last == _whole.get(self.table.name):
            return labels
        noted = self.table.rows().filter(F.col(BATCH) == last).agg(F.sum("n_rows")).first()[0]
        if self.target.batch_rows(last) == (noted or 0):
            _whole[self.table.name] = last
            return labels
        for table in (self.target, *self.followers, self.table):  # the note last: it calls for the others
            table.drop_batch(last)
        return labels[:-1]

    def write(self, rows: DataFrame, notes: DataFrame, *further: tuple[CatalogTable, DataFrame]) -> str:
        """Write a batch after noting it. ``further`` rows go to followers before the target's."""
        labels = self.recover()
        number = int(labels[-1].split("-")[0]) + 1 if labels else 0
        label = f"{number:09d}-{uuid4().hex[:12]}"
        self.table.write_batch(notes.select(NOTE.names), label)
        for table, part in further:
            table.write_batch(part, label)
        self.target.write_batch(rows, label)
        _whole[self.table.name] = label
        if len(labels) >= COMPACT_AFTER:
            self.fold(labels)
        return label

    def fold(self, labels: list[str]) -> None:
        """Put the notes of finished batches together. Notes that a crash leaves twice count once."""
        earlier = settle(self.table.rows().filter(F.col(BATCH).isin(labels)).select(NOTE.names).distinct(), "notes")
        self.table.write_batch(earlier, labels[-1].rstrip(FOLDED) + FOLDED)
        for label in labels:
            self.table.drop_batch(label)

    def files(self) -> DataFrame:
        """The files whose rows are in the target."""
        if not self.recover():
            return self.table.spark.createDataFrame([], FILE)
        return self.table.rows().select(FILE.names).distinct()


def append_whole(table: CatalogTable, df: DataFrame) -> int:
    """Append rows as one batch: after a crash the next append finds all of them or none. Returns their number."""
    rows = settle(df, "batch")
    count = rows.count()
    note = table.spark.range(1).select(
        *[F.lit(None).cast(f.dataType).alias(f.name) for f in FILE.fields], F.lit(count).cast("long").alias("n_rows")
    )
    batch_log(table).write(rows, note)
    return count


def batch_log(table: CatalogTable, *followers: CatalogTable) -> BatchLog:
    return BatchLog(table, f"{table.name}_loads", followers)


def write_flight_files(silver: DataFrame, path: str) -> None:
    """One folder per flight; writing a flight again replaces its files and no others.

    Aligned rows arrive already placed by flight and slice, so a flight of usual length is one
    file and only a very long one is several. The writer has to sort by flight in any case;
    sorting by sample as well makes the files smaller and their statistics tight.

    On a local or mounted file system Hadoop starts several processes for each file, which takes longer
    than the file; there the tasks write the files by Arrow. On any other store Spark's writer does.
    """
    # the files keep their id column
    placed = silver.withColumn(FLIGHT, F.col("flight_id"))
    order = [c for c in (FLIGHT, "name", "idx") if c in placed.columns]
    rows = placed.sortWithinPartitions(*order)
    folder = qualified(silver.sparkSession, path)
    if folder.startswith("file:"):
        silver.sparkSession.dataSource.register(FlightFiles)
        rows.write.format(FlightFiles.name()).mode("append").save(folder.removeprefix("file:"))
        return
    (
        rows.write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(FLIGHT)
        .parquet(path)
    )
