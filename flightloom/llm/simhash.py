"""SimHash near-duplicates: meet-in-the-middle balls around the halves of every fingerprint."""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from xxhash import xxh64_intdigest

from flightloom.llm.common import whole_text
from flightloom.llm.components import connected_components
from flightloom.session import settle

SHINGLE = 4
SEED = 42
RADIUS = 4
HALF_BITS = 32
HASHES_AT_ONCE = 65_536  # keeps the bit counts of a very long text small


def fingerprint(text: str | None) -> int:
    """The 64-bit SimHash of a text as a signed number; 0 without words.

    Splitting and lower-casing bytes touches ASCII only, as the contract asks.
    """
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    ends = np.cumsum(lengths + 1) - 1
    starts = ends - lengths
    width = min(SHINGLE, len(words))
    spans = list(zip(starts[: len(words) - width + 1].tolist(), ends[width - 1 :].tolist()))
    counts = np.zeros(64, np.int64)
    for i in range(0, len(spans), HASHES_AT_ONCE):
        part = spans[i : i + HASHES_AT_ONCE]
        hashes = np.fromiter((xxh64_intdigest(joined[s:e], SEED) for s, e in part), "<u8", len(part))
        bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        counts += bits.sum(0, dtype=np.int64)
    set_bits = (counts * 2 > len(spans)).astype(np.uint8)
    return int(np.packbits(set_bits, bitorder="little").view("<i8")[0])


@F.pandas_udf(T.LongType())
def fingerprint_udf(texts: pd.Series) -> pd.Series:
    return pd.Series([fingerprint(t) for t in texts], dtype="int64")


def fingerprint_hex(fp: Column) -> Column:
    return F.lpad(F.lower(F.hex(fp)), 16, "0")


def ball_masks(bits: int, radius: int) -> list[int]:
    """What to flip to reach every value within ``radius`` of a value of ``bits`` bits."""
    return [sum(1 << i for i in flips) for k in range(radius + 1) for flips in combinations(range(bits), k)]


def ball_keys(fp: Column, radius: int) -> Column:
    """The variants under which a fingerprint is looked for.

    Of two fingerprints within ``radius``, one half differs in at most radius // 2 bits. Each half
    emits all its variants within half of that, rounded up, so the two meet at a value between
    them. For radius 4 these are 66 keys, where the ball of the whole fingerprint has 2,081.
    """
    masks = F.array(*[F.lit(m).cast("long") for m in ball_masks(HALF_BITS, -(-(radius // 2) // 2))])
    low = fp.bitwiseAND(F.lit((1 << HALF_BITS) - 1))
    high = F.shiftrightunsigned(fp, HALF_BITS)
    return F.concat(
        F.transform(masks, lambda m: low.bitwiseXOR(m)),
        F.transform(masks, lambda m: high.bitwiseXOR(m) + F.lit(1 << HALF_BITS)),
    )


def bucket_links(members: np.ndarray, radius: int) -> list[tuple[int, int]]:
    """(member, first member of its set) for the sets that the links within a bucket connect.

    Each reached fingerprint is compared with those not reached yet, and only those: in a bucket of
    near copies nearly all are reached in the first steps, and no list of pairs is ever made.
    """
    left, found = members, []
    while left.size > 1:
        root, left, queue = left[0], left[1:], [left[0]]
        while queue and left.size:
            near = np.bitwise_count(left ^ queue.pop()) <= radius
            if near.any():
                found += [(x, root) for x in left[near]]
                queue += list(left[near])
                left = left[~near]
    return found


def links_of_runs(batches: Iterator[pa.RecordBatch], radius: int) -> Iterator[pa.RecordBatch]:
    """Links from rows (key, fp) sorted by key; only the bucket at hand is held."""
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64())])
    keys, fps = np.empty(0, np.int64), np.empty(0, np.uint64)

    def emit(keys: np.ndarray, fps: np.ndarray) -> pa.RecordBatch:
        first = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]]) if keys.size else np.empty(0, int)
        sizes = np.diff(np.r_[first, keys.size])
        run = np.repeat(np.arange(first.size), sizes)
        lead = fps[first][run] if keys.size else fps
        near = np.bitwise_count(fps ^ lead) <= radius
        direct = near & (fps != lead)
        a, b = [fps[direct]], [lead[direct]]
        open_runs = np.unique(run[~near])  # some member is not linked to the first one itself
        for r in open_runs[sizes[open_runs] > 2].tolist():
            pairs = bucket_links(np.unique(fps[first[r] : first[r] + sizes[r]]), radius)
            a.append(np.array([p[0] for p in pairs], np.uint64))
            b.append(np.array([p[1] for p in pairs], np.uint64))
        pairs = np.unique(np.stack([np.concatenate(a), np.concatenate(b)], 1), axis=0).view(np.int64)
        return pa.RecordBatch.from_arrays([pa.array(pairs[:, 0]), pa.array(pairs[:, 1])], schema=schema)

    for batch in batches:
        keys = np.r_[keys, batch.column(0).to_numpy(zero_copy_only=False)]
        fps = np.r_[fps, batch.column(1).to_numpy(zero_copy_only=False).view(np.uint64)]
        if keys.size:
            whole = np.searchsorted(keys, keys[-1])  # the last bucket may go on in the next batch
            if whole:
                yield emit(keys[:whole], fps[:whole])
                keys, fps = keys[whole:], fps[whole:]
    yield emit(keys, fps)


def fingerprint_links(fps: DataFrame, radius: int = RADIUS) -> DataFrame:
    """Edges (a, b) that connect the same sets as all pairs within ``radius`` bits do.

    ``fps`` has each fingerprint once. Both ends of an edge are joined by links in one bucket."""
    keyed = fps.select(F.explode(ball_keys(F.col("fp"), radius)).alias("key"), "fp")
    return (
        keyed.repartition("key")
        .sortWithinPartitions("key")
        .mapInArrow(lambda batches: links_of_runs(batches, radius), "a long, b long")
    )


def component_of_fingerprints(rows: DataFrame, radius: int = RADIUS) -> DataFrame:
    """(fp, component_id) for each fingerprint of ``rows`` (doc_id, fp): the smallest doc_id reachable."""
    fps = settle(rows.groupBy("fp").agg(F.min("doc_id").alias("first_id")), "fingerprints")
    roots = connected_components(fingerprint_links(fps.select("fp"), radius))
    linked = roots.withColumnRenamed("node", "fp").join(fps, "fp")
    smallest = linked.groupBy("root").agg(F.min("first_id").alias("component_id"))
    of_linked = linked.join(smallest, "root").select("fp", "component_id")
    labelled = fps.join(of_linked, "fp", "left").select(
        "fp", F.coalesce("component_id", "first_id").alias("component_id")
    )
    # settled, so that the join with the documents reads shuffles only and hot keys can be split
    return settle(labelled, "component-of-fingerprints")


def near_duplicates(docs: DataFrame, radius: int = RADIUS) -> DataFrame:
    """For every row of ``docs`` its doc_id, fingerprint (hex) and component_id.

    Texts link when their fingerprints differ in at most ``radius`` bits; null and empty texts have
    fingerprint zero and link like any other. Equal fingerprints are one node, so copies never
    multiply. Rows with a null id belong to components but name none unless all its ids are null; rows that repeat
    come back as often. Extra columns are ignored; an empty table gives an empty result.
    """
    rows = settle(docs.select("doc_id", fingerprint_udf(whole_text()).alias("fp")), "hashed")
    return rows.join(component_of_fingerprints(rows, radius), "fp").select(
        "doc_id", fingerprint_hex(F.col("fp")).alias("fingerprint"), "component_id"
    )


def keep_one_of_each(docs: DataFrame, radius: int = RADIUS) -> DataFrame:
    """The rows of ``docs`` that stand for their component: those with its smallest doc_id.

    Rows that repeat this id are one document and stay together if their texts are in the component.
    """
    rows = settle(
        docs.select("doc_id", F.xxhash64(whole_text()).alias("text_hash"), fingerprint_udf(whole_text()).alias("fp")),
        "hashed",
    )
    kept = (
        rows.join(component_of_fingerprints(rows, radius), "fp")
        .filter("doc_id <=> component_id")
        .select(F.col("doc_id").alias("__id"), F.col("text_hash").alias("__hash"))
        .distinct()
    )
    hashed = docs.withColumn("__text", F.xxhash64(whole_text()))
    return hashed.join(kept, F.expr("doc_id <=> __id AND __text = __hash"), "left_semi").drop("__text")
