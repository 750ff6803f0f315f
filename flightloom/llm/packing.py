"""Packing by deficit round-robin over source queues, at target proportions in every window."""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.taskcontext import TaskContext

from flightloom.llm.common import null_safe_key, whole_text
from flightloom.llm.encoding import encoder
from flightloom.session import settle

LENGTH = 1024  # ids per sequence
END_ID = 0
ROWS_AT_ONCE = 1_000
WINDOW = 256 * LENGTH  # ids in which the target proportions hold
QUEUES = 1024  # the largest sources, and all that have a target, have a queue each; the others share the last
WIDTH = 2  # bytes per stored id; the vocabulary has 50,257
BROADCAST_ROWS = 500_000


def tokenized(batches: Iterator[pa.RecordBatch], path: str, end_id: int) -> Iterator[pa.RecordBatch]:
    """Encodes rows (source, doc_id, text) sorted by source; keeps count of the ids of each source."""
    encode = encoder(path, space_joins_next=True, width=WIDTH).encode
    end = np.array([end_id], f"<u{WIDTH}").tobytes()
    part, source, at = TaskContext.get().partitionId(), None, 0
    for batch in batches:
        for i in range(0, batch.num_rows, ROWS_AT_ONCE):
            rows = batch.slice(i, ROWS_AT_ONCE)
            ids = [b + end for b in encode(rows.column(2).to_pylist())]
            starts = []
            for name, data in zip(rows.column(0).to_pylist(), ids):
                source, at = (source, at) if name == source else (name, 0)
                starts.append(at)
                at += len(data) // WIDTH
            yield pa.RecordBatch.from_arrays(
                [pa.array([part] * len(ids), pa.int32()), rows.column(0), rows.column(1),
                 pa.array(starts, pa.int64()), pa.array([len(b) // WIDTH for b in ids], pa.int64()),
                 pa.array(ids, pa.binary())],
                names=["part", "source_key", "doc_id", "local", "doc_tokens", "ids"],
            )


class Rounds:
    """What every queue has served before a round, and where the round's chunks stand in the stream.

    A queue's quantum is its share of the window. What is left of it after whole ids, its deficit, is
    carried to the next round: before round r a queue has been granted floor(r * window * weight /
    all weights) ids in total, and it has served these unless it ran dry. That total needs no
    history, so any task can work out any round; rounds and partitions carry deficits alike.
    """

    def __init__(self, sizes: list[int], weights: list[int], window: int):
        self.sizes, self.weights, self.window, self.whole = sizes, weights, window, sum(weights)
        self.rounds: dict[int, tuple[list[int], list[int]]] = {}

    def granted(self, queue: int, r: int) -> int:
        return r * self.window * self.weights[queue] // self.whole

    def of(self, queue: int, place: int) -> int:
        """The round that serves the id at ``place`` of a queue."""
        r = place * self.whole // (self.window * self.weights[queue])
        while self.granted(queue, r + 1) <= place:
            r += 1
        return r

    def _round(self, r: int) -> tuple[list[int], list[int]]:
        if r not in self.rounds:
            if len(self.rounds) > 64:
                self.rounds.clear()
            served = [min(n, self.granted(q, r)) for q, n in enumerate(self.sizes)]
            chunks = [min(n, self.granted(q, r + 1)) - s for q, (n, s) in enumerate(zip(self.sizes, served))]
            total, starts = sum(served), []
            for c in chunks:
                starts.append(total)
                total += c
            self.rounds[r] = served, starts
        return self.rounds[r]

    def spans(self, queue: int, start: int, length: int) -> Iterator[tuple[int, int, int]]:
        """(place in the document, place in the stream, length) of its pieces per round."""
        done = 0
        while done < length:
            r = self.of(queue, start + done)
            served, starts = self._round(r)
            end = min(length, self.granted(queue, r + 1) - start)
            yield done, starts[queue] + start + done - served[queue], end - done
            done = end


PIECES = pa.schema(
    [("doc_id", pa.int64()), ("start", pa.int64()), ("length", pa.int64()), ("ids_crc32", pa.int64()),
     ("doc_tokens", pa.int64()), ("sequence_id", pa.int64()), ("offset", pa.int64()), ("ids", pa.binary())]
)


def pieces(
    batches: Iterator[pa.RecordBatch], rounds: Rounds, length: int, with_ids: bool
) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for i in range(0, batch.num_rows, ROWS_AT_ONCE):
            out: list[tuple] = []
            rows = batch.slice(i, ROWS_AT_ONCE)
            for doc_id, queue, start, n, data in zip(*(c.to_pylist() for c in rows.columns)):
                ids = np.frombuffer(data, f"<u{WIDTH}").astype("<u4").tobytes()
                for at, place, size in rounds.spans(queue, start, n):
                    while size:
                        sequence, offset = divmod(place, length)
                        take = min(size, length - offset)
                        part = ids[at * 4 : (at + take) * 4]
                        out.append((doc_id, at, take, zlib.crc32(part), n, sequence, offset, part if with_ids else None))
                        at, place, size = at + take, place + take, size - take
            columns = [pa.array(c, f.type) for c, f in zip(zip(*out), PIECES)]
            yield pa.RecordBatch.from_arrays(columns, schema=PIECES)


def dealt_sources(sources: DataFrame, names: list[str]) -> DataFrame:
    """The rows of the named sources."""
    given = sources.sparkSession.createDataFrame([(n,) for n in names], "source_key string")
    return sources.join(F.broadcast(given), "source_key", "left_semi")  # as long as the argument


def pack(
    docs: DataFrame,
    tokenizer: str,
    targets: dict[str | None, int] | None = None,
    length: int = LENGTH,
    window: int = WINDOW,
    end_id: int = END_ID,
    queues: int = QUEUES,
    with_ids: bool = False,
) -> DataFrame:
    """Packs the ids of all texts, each followed by ``end_id``, into sequences of ``length`` ids.

    One row per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset, and ids
    (little-endian uint32) if asked for. Each source is a queue, in the order of a hash of doc_id. In every round the
    queues fill a window in turn, each with its target share, and documents are cut where a share or
    a sequence ends. ``targets`` are whole-number weights by source (others: 1); by default each
    source's weight is its number of ids, so that all queues run dry together. Every id lies in
    one piece and only the last sequence is short. A null source is a source; a null or empty
    text is the end id alone; rows that repeat are packed as often. Extra columns are ignored; an empty
    table gives no pieces.

    Texts are dealt by range of (source, hash), so a source with most of the rows is spread out, and
    encoded once. Per-task totals give each document its place in its queue.
    """
    rows = docs.select(
        null_safe_key("source").alias("source_key"), "doc_id", whole_text().alias("text"),
        F.xxhash64("doc_id", "text").alias("order"),
    )
    dealt = rows.repartitionByRange("source_key", "order").sortWithinPartitions("source_key", "order")
    stored = settle(
        dealt.select("source_key", "doc_id", "text").mapInArrow(
            lambda batches: tokenized(batches, tokenizer, end_id),
            "part int, source_key string, doc_id long, local long, doc_tokens long, ids binary",
        ),
        "tokens",
    )
    # a row per (task, source): as many as tasks and sources together, since rows are sorted
    shares = settle(stored.groupBy("source_key", "part").agg(F.sum("doc_tokens").alias("ids")), "token-shares")
    sources = shares.groupBy("source_key").agg(F.sum("ids").alias("size"))
    wanted = {"n" if k is None else f"s{k}": v for k, v in (targets or {}).items()}
    # as many rows as queues and targets
    own = sources.orderBy(F.col("size").desc(), "source_key").limit(queues - 1).collect()
    if wanted:
        given = dealt_sources(sources, list(wanted)).collect()
        own += [r for r in given if r.source_key not in {x.source_key for x in own}]
    names = [r.source_key for r in own]
    sizes = [r.size for r in own]
    queue = F.lit(len(names))
    if names:
        places = F.create_map(*[F.lit(x) for pair in zip(names, range(len(names))) for x in pair])
        queue = F.coalesce(places[F.col("source_key")], queue)
    in_queue = shares.withColumn("queue", queue)
    rest = in_queue.filter(F.col("queue") == len(names)).agg(F.sum("ids")).first()[0]
    if rest:
        sizes.append(rest)
    weights = sizes
    if targets is not None:
        weights = [wanted.get(k, 1) for k in names] + [1] * (len(sizes) - len(names))
    earlier = Window.partitionBy("queue").orderBy("source_key", "part").rowsBetween(Window.unboundedPreceding, -1)
    starts = in_queue.select(
        "source_key", "part", "queue", F.coalesce(F.sum("ids").over(earlier), F.lit(0)).alias("before")
    )
    if shares.count() <= BROADCAST_ROWS:
        starts = F.broadcast(starts)
    placed = stored.join(starts, ["source_key", "part"]).select(
        "doc_id", "queue", (F.col("before") + F.col("local")).alias("place"), "doc_tokens", "ids"
    )
    rounds = Rounds(sizes, weights, window)
    found = placed.mapInArrow(
        lambda batches: pieces(batches, rounds, length, with_ids),
        "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, ids binary",
    )
    return found if with_ids else found.drop("ids")
