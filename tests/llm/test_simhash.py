import random
import re

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from flightloom.llm import simhash
from flightloom.llm.simhash import fingerprint, fingerprint_links, keep_one_of_each, near_duplicates

from edge_rows import EDGE  # noqa: I001
from test_components import brute as components_of


def plain(text):
    lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", lower)
    shingles = [" ".join(words[i : i + 4]) for i in range(max(1, len(words) - 3))] if words else []
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def expected(rows):
    fps = [(d, plain(t)) for d, t, _ in rows]
    values = sorted({f for _, f in fps})
    edges = [(a, b) for i, a in enumerate(values) for b in values[:i] if (a ^ b).bit_count() <= 4]
    root = {v: v for v in values} | dict(components_of(edges))
    least = {}
    for d, f in fps:
        if d is not None:
            least[root[f]] = min(d, least.get(root[f], d))
    return sorted(((d, f"{f:016x}", least.get(root[f])) for d, f in fps), key=repr)


def found(df):
    return sorted(map(tuple, df.collect()), key=repr)


def test_fingerprint():
    rng = random.Random(0)
    texts = [t for _, t, _ in EDGE if t is None or len(t) < 500]
    texts += [" ".join(rng.choice(["a", "B", "ç", "\x1c", " "]) for _ in range(rng.randrange(9))) for _ in range(200)]
    assert all(fingerprint(t) % 2**64 == plain(t) for t in texts)


def test_long_text_in_parts(monkeypatch):
    text = " ".join(map(str, range(500)))
    whole = fingerprint(text)
    monkeypatch.setattr(simhash, "HASHES_AT_ONCE", 7)
    assert fingerprint(text) == whole


def test_spark_hash_is_the_same(spark):
    row = spark.range(1).select(F.xxhash64(F.lit("the quick brown fox")).alias("h")).first()
    assert row.h % 2**64 == xxhash.xxh64_intdigest(b"the quick brown fox", 42)


def test_edge_rows(edge):
    assert found(near_duplicates(edge)) == expected(EDGE)


def test_whole_table(documents):
    rows = [(r.doc_id, r.text, None) for r in documents.collect()]
    assert found(near_duplicates(documents)) == expected(rows)


@pytest.mark.parametrize("radius", [2, 4, 5])
def test_links_connect_what_all_pairs_connect(spark, radius):
    """Crowded balls, chains over the radius, and loners."""
    rng = np.random.default_rng(radius)
    centers = rng.integers(0, 2**63, 6, dtype=np.uint64)
    values = [int(c) for c in centers] + [int(x) for x in rng.integers(0, 2**63, 60, dtype=np.uint64)]
    for c in centers:
        for _ in range(60):
            flips = rng.choice(64, rng.integers(0, 6), replace=False)
            values.append(int(c) ^ sum(1 << int(i) for i in flips))
    values = sorted({v - 2**64 if v >= 2**63 else v for v in values})
    fps = spark.createDataFrame([(v,) for v in values], "fp long")
    links = [tuple(r) for r in fingerprint_links(fps, radius).collect()]
    pairs = [(a, b) for i, a in enumerate(values) for b in values[:i] if ((a ^ b) % 2**64).bit_count() <= radius]
    assert components_of(links) == components_of(pairs)


def test_buckets_across_batches():
    """A bucket that spans record batches is searched as a whole."""
    import pyarrow as pa

    keys, fps = [1, 1, 2, 2, 2, 3], [0, 1, 0, 15, 255, 9]
    batches = [pa.RecordBatch.from_arrays([pa.array([k]), pa.array([f])], names=["key", "fp"]) for k, f in zip(keys, fps)]
    out = [tuple(x.values()) for b in simhash.links_of_runs(iter(batches), 4) for x in b.to_pylist()]
    assert components_of(out) == components_of([(0, 1), (0, 15), (15, 255)])


def test_one_of_each_stays(edge):
    kept = keep_one_of_each(edge)
    assert kept.columns == edge.columns
    of = {}
    for d, fp, c in expected(EDGE):
        of.setdefault(c, set()).add(d)
    ids = {r.doc_id for r in kept.collect()}
    assert ids == {min((x for x in g if x is not None), default=None) for g in of.values()}


def test_empty_table(nothing):
    assert near_duplicates(nothing).count() == 0 and keep_one_of_each(nothing).count() == 0
