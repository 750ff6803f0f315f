"""Sharding: the smallest capacity for contiguous shards of whole groups, found exactly."""

from __future__ import annotations

from bisect import bisect_right
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flightloom.llm.common import running_start, whole_text
from flightloom.session import settle

KEY_DIGITS = 16  # hex digits of SHA-256 that order the groups
FIRST_DIGITS = 4  # the coarse view has at most 65,536 cells
MORE_DIGITS = 2
SLOT_SLICES = 1024


@dataclass
class Cell:
    """Consecutive groups whose keys share a prefix; exact when it is one group."""

    prefix: str
    size: int
    groups: int


class Line:
    """The ordered cells with their running ends, and what greedy filling does on them.

    Inside a cell of several groups the place of a cut is only known to lie in the cell; ``sure``
    takes the cell's start and ``at_best`` the place itself, so the true cut is between the two.
    """

    def __init__(self, cells: list[Cell]):
        self.cells = cells
        self.ends: list[int] = []
        total = 0
        for cell in cells:
            total += cell.size
            self.ends.append(total)
        self.total = total

    def sure(self, start: int, capacity: int) -> int:
        full = bisect_right(self.ends, start + capacity)
        return max(start, self.ends[full - 1] if full else 0)

    def at_best(self, start: int, capacity: int) -> int:
        reach = start + capacity
        full = bisect_right(self.ends, reach)
        if full == len(self.ends):
            return self.total
        return reach if self.cells[full].groups > 1 else (self.ends[full - 1] if full else 0)

    def cuts(self, step, shards: int, capacity: int) -> list[int]:
        places = [0]
        for _ in range(shards):
            places.append(step(places[-1], capacity))
        return places[1:]

    def smallest(self, step, shards: int) -> int:
        """Binary search for the smallest capacity with which ``shards`` greedy shards reach the end."""
        low, high = -(-self.total // shards), self.total
        while low < high:
            middle = (low + high) // 2
            if self.cuts(step, shards, middle)[-1] >= self.total:
                high = middle
            else:
                low = middle + 1
        return low


def cells_of(groups: DataFrame, digits: int, inside: list[str] | None = None) -> list[Cell]:
    """Totals per key prefix: a bounded number of rows, whatever the number of groups."""
    if inside is not None:
        groups = groups.filter(F.substring("key", 1, len(inside[0])).isin(inside))
    rows = groups.groupBy(F.substring("key", 1, digits).alias("prefix")).agg(
        F.sum("size").alias("size"), F.count("*").alias("groups")
    )
    return sorted((Cell(*r) for r in rows.collect()), key=lambda c: c.prefix)


def minimax_cuts(groups: DataFrame, shards: int) -> tuple[int, list[str]]:
    """The smallest capacity and the first key prefix of each shard but the first.

    ``groups`` has one row (key, size) per atomic group. The search runs on totals per key prefix.
    Where a cut falls into a cell of several groups, that cell is divided further, a level of the
    key at a time, until the capacity and every cut are exact. Each level reads only the groups
    in the cells still in doubt.
    """
    digits, line = FIRST_DIGITS, Line(cells_of(groups, FIRST_DIGITS))
    while True:
        best, sure = line.smallest(line.at_best, shards), line.smallest(line.sure, shards)
        low, high = line.cuts(line.sure, shards, best), line.cuts(line.at_best, shards, sure)
        doubtful = set()
        for a, b in zip(low, high):
            i = bisect_right(line.ends, a)
            while i < len(line.cells) and (line.ends[i - 1] if i else 0) < max(b, a + 1):
                if line.cells[i].groups > 1 and a < line.total:
                    doubtful.add(line.cells[i].prefix)
                i += 1
        doubtful = {p for p in doubtful if len(p) == digits}
        if not doubtful or best == sure and low == high:
            break
        digits = min(digits + MORE_DIGITS, KEY_DIGITS)
        finer = cells_of(groups, digits, sorted(doubtful))
        kept = [c for c in line.cells if c.prefix not in doubtful]
        line = Line(sorted(kept + finer, key=lambda c: c.prefix))
    places = line.cuts(line.sure, shards, sure)[:-1]
    firsts = [bisect_right(line.ends, p) for p in places if p < line.total]
    return sure, [line.cells[i].prefix for i in firsts]


def shard_documents(docs: DataFrame, shards: int = 8) -> DataFrame:
    """Puts every document into one of ``shards`` shards by bytes; equal texts share a shard.

    Size is the UTF-8 length of the text plus 1 (null counts as empty). The atomic groups are the
    equal texts, ordered by the first 64 bits of their SHA-256; texts that agree in those bits
    would count as one group. No partition of that order into ``shards`` contiguous shards has a
    smaller largest shard. A group larger than an even share fills a shard by itself and may leave
    later shards empty. ``slot`` numbers the documents of a shard from 0 without gaps, ordered by
    a hash of doc_id, doc_id (null first) and text key; rows that repeat an id and text get slots of their own.
    Extra columns are ignored; an empty table gives an empty result.
    """
    rows = settle(
        docs.select("doc_id", whole_text().alias("text")).select(
            "doc_id",
            (F.octet_length("text") + 1).cast("long").alias("size"),
            F.crc32("text").alias("text_crc32"),
            F.substring(F.sha2("text", 256), 1, KEY_DIGITS).alias("key"),
        ),
        "sized",
    )
    groups = settle(rows.groupBy("key").agg(F.sum("size").alias("size")), "shard-groups")
    _, firsts = minimax_cuts(groups, shards)
    shard = F.lit(0)
    for first in firsts:
        shard = shard + (F.col("key") >= first).cast("int")
    placed = rows.select(
        "*",
        shard.alias("shard"),
        F.pmod(F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit(""))), F.lit(SLOT_SLICES)).alias("slice"),
        F.lit(1).alias("one"),
    )
    return running_start(placed, ["shard"], "slice", ["doc_id", "key"], "one", "slot").select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("bytes").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )
