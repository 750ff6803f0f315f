"""Token ids in directly addressable codes: chunk levels, continuation bitmaps, rank directories.

A container holds the ids of consecutive documents. Each id is split into 8-bit chunks, lowest
first. Level k holds the k-th chunk of all ids that have one, in order; its bitmap has a 1 where the
id goes on in level k + 1, and its directory has the number of 1s before every 512th position. The
place of an id in the next level is thus a directory entry plus a count within one block of the
bitmap, so a single id is read with a few look-ups and nothing else is decoded.

Layout, little-endian: magic "DAC1", number of levels (uint32), then per level its length (uint64),
its chunks (bytes), its bitmap (bits, lowest first, padded to whole bytes) and its directory (uint32).
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.taskcontext import TaskContext

from flightloom.llm.common import whole_text
from flightloom.llm.encoding import encoder
from flightloom.session import fresh_path

MAGIC = b"DAC1"
CHUNK_BITS = 8
BLOCK = 512  # positions per directory entry
END_ID = 1
ROWS_AT_ONCE = 1_000
CONTAINER_IDS = 1_000_000  # a container is closed at the document that reaches it


def encode_codes(ids: np.ndarray) -> bytes:
    """The container of an array of unsigned ids."""
    levels, rest = [], ids.astype(np.uint32)
    while rest.size or not levels:
        chunks = (rest & 0xFF).astype(np.uint8)
        goes_on = rest >> CHUNK_BITS > 0
        counts = np.add.reduceat(goes_on, np.arange(0, rest.size, BLOCK), dtype=np.uint32) if rest.size else []
        directory = np.r_[0, np.cumsum(counts)[:-1]] if rest.size else np.empty(0)
        levels.append(
            np.uint64(rest.size).tobytes()
            + chunks.tobytes()
            + np.packbits(goes_on, bitorder="little").tobytes()
            + directory.astype("<u4").tobytes()
        )
        rest = rest[goes_on] >> CHUNK_BITS
    return MAGIC + np.uint32(len(levels)).tobytes() + b"".join(levels)


@dataclass
class Codes:
    """A container opened for reading; arrays are views of its bytes."""

    levels: list[tuple[np.ndarray, np.ndarray, np.ndarray]]

    @classmethod
    def open(cls, data: bytes) -> Codes:
        if data[:4] != MAGIC:
            raise ValueError("not a token container")
        at, levels = 8, []
        for _ in range(int(np.frombuffer(data, "<u4", 1, 4)[0])):
            n = int(np.frombuffer(data, "<u8", 1, at)[0])
            at += 8
            chunks = np.frombuffer(data, np.uint8, n, at)
            at += n
            bitmap = np.frombuffer(data, np.uint8, -(-n // 8), at)
            at += bitmap.size
            directory = np.frombuffer(data, "<u4", -(-n // BLOCK), at)
            at += directory.nbytes
            levels.append((chunks, bitmap, directory))
        return cls(levels)

    def __len__(self) -> int:
        return self.levels[0][0].size

    def __getitem__(self, i: int) -> int:
        """One id, by its place."""
        value, shift = 0, 0
        for chunks, bitmap, directory in self.levels:
            value |= int(chunks[i]) << shift
            if not bitmap[i >> 3] >> (i & 7) & 1:
                return value
            block = i // BLOCK
            before = bitmap[block * BLOCK // 8 : i >> 3]
            ones = int(np.bitwise_count(before).sum()) + (int(bitmap[i >> 3]) & ((1 << (i & 7)) - 1)).bit_count()
            i = int(directory[block]) + ones
            shift += CHUNK_BITS
        raise ValueError("the last level goes on")

    def all(self) -> np.ndarray:
        out = np.zeros(0, np.uint32)
        for chunks, bitmap, _ in reversed(self.levels):
            goes_on = np.unpackbits(bitmap, count=chunks.size, bitorder="little").astype(bool)
            value = chunks.astype(np.uint32)
            value[goes_on] |= out << CHUNK_BITS
            out = value
        return out


CONTAINERS = pa.schema(
    [
        ("part", pa.int32()),
        ("container", pa.int32()),
        ("start", pa.int64()),  # ids of this part before the container
        ("doc_ids", pa.list_(pa.int64())),
        ("lengths", pa.list_(pa.int64())),
        ("codes", pa.binary()),
    ]
)


def containers(batches: Iterator[pa.RecordBatch], path: str, end_id: int) -> Iterator[pa.RecordBatch]:
    """Encodes sorted rows (doc_id, text) into containers of about CONTAINER_IDS ids."""
    encode = encoder(path, space_joins_next=False).encode
    end = np.array([end_id], "<u4").tobytes()
    part, number, start = TaskContext.get().partitionId(), 0, 0
    doc_ids: list[int | None] = []
    pieces: list[bytes] = []

    def close() -> pa.RecordBatch:
        nonlocal number, start, doc_ids, pieces
        lengths = [len(p) // 4 for p in pieces]
        row = {
            "part": part, "container": number, "start": start, "doc_ids": doc_ids, "lengths": lengths,
            "codes": encode_codes(np.frombuffer(b"".join(pieces), "<u4")),
        }
        number, start, doc_ids, pieces = number + 1, start + sum(lengths), [], []
        return pa.RecordBatch.from_pylist([row], schema=CONTAINERS)

    held = 0
    for batch in batches:
        ids = batch.column(0).to_pylist()
        texts = batch.column(1)
        for i in range(0, len(ids), ROWS_AT_ONCE):
            encoded = encode(texts.slice(i, ROWS_AT_ONCE).to_pylist())
            for doc_id, tokens in zip(ids[i : i + ROWS_AT_ONCE], encoded):
                doc_ids.append(doc_id)
                pieces.append(tokens + end)
                held += len(tokens) // 4 + 1
                if held >= CONTAINER_IDS:
                    yield close()
                    held = 0
    if doc_ids:
        yield close()


def write_token_files(docs: DataFrame, path: str, tokenizer: str, end_id: int = END_ID) -> None:
    """Writes the ids of all texts, each followed by ``end_id``, in ascending order of doc_id.

    Rows are dealt by range of doc_id (equal ids by a hash of the text), so file order is id order
    and no part holds more than its share. The containers are cells of Parquet files: Spark's writer
    makes them appear as a whole, on any store, also when a task runs twice. A null id
    comes first; a null or empty text has the end id only.
    """
    rows = docs.select("doc_id", whole_text().alias("text")).withColumn("tie", F.xxhash64("text"))
    ordered = rows.repartitionByRange("doc_id", "tie").sortWithinPartitions("doc_id", "tie")
    schema = "part int, container int, start long, doc_ids array<long>, lengths array<long>, codes binary"
    ordered.select("doc_id", "text").mapInArrow(
        lambda batches: containers(batches, tokenizer, end_id), schema
    ).write.parquet(path)


READ = pa.schema(
    [("part", pa.int32()), ("local", pa.int64()), ("doc_id", pa.int64()), ("n_tokens", pa.int64()), ("ids_crc32", pa.int64())]
)


def documents_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row per document of each container, from its decoded ids."""
    for batch in batches:
        for row in range(batch.num_rows):
            part, start, doc_ids, lengths, codes = (batch.column(i)[row].as_py() for i in range(5))
            ids = Codes.open(codes).all().astype("<u4").tobytes()
            ends = np.cumsum(lengths)
            starts = ends - lengths
            crcs = [zlib.crc32(ids[a * 4 : b * 4]) for a, b in zip(starts.tolist(), ends.tolist())]
            n = len(doc_ids)
            yield pa.RecordBatch.from_arrays(
                [pa.array([part] * n, pa.int32()), pa.array(starts + start, pa.int64()),
                 pa.array(doc_ids, pa.int64()), pa.array(lengths, pa.int64()), pa.array(crcs, pa.int64())],
                schema=READ,
            )


def read_token_files(spark: SparkSession, path: str) -> DataFrame:
    """Per document of the files: doc_id, start, n_tokens, ids_crc32.

    Only the totals of the parts, one row each, are summed up in one place.
    """
    files = spark.read.parquet(path)
    sums = files.groupBy("part").agg(F.sum(F.aggregate("lengths", F.lit(0).cast("long"), lambda a, x: a + x)).alias("ids"))
    earlier = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = sums.select("part", F.coalesce(F.sum("ids").over(earlier), F.lit(0)).alias("before"))
    docs = files.select("part", "start", "doc_ids", "lengths", "codes").mapInArrow(
        documents_of, "part int, local long, doc_id long, n_tokens long, ids_crc32 long"
    )
    return docs.join(F.broadcast(starts), "part").select(  # a row per task that wrote
        "doc_id", (F.col("before") + F.col("local")).alias("start"), "n_tokens", "ids_crc32"
    )


def token_round_trip(docs: DataFrame, tokenizer: str, end_id: int = END_ID) -> DataFrame:
    """Writes the token files of ``docs`` into the shared folder and reads them back."""
    path = fresh_path(docs.sparkSession, "token-files")
    write_token_files(docs, path, tokenizer, end_id)
    return read_token_files(docs.sparkSession, path)
