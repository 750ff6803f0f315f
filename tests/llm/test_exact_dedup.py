import hashlib
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from flightloom.llm.exact_dedup import exact_dedup, sha256_of

from edge_rows import EDGE  # noqa: I001


def expected(rows):
    groups = defaultdict(list)
    for d, t, _ in rows:
        groups[t or ""].append(d)
    out = []
    for d, t, _ in rows:
        ids = [i for i in groups[t or ""] if i is not None]
        keep = max(ids, default=None)
        out.append((d, keep, len(groups[t or ""]), d == keep, hashlib.sha256((t or "").encode()).hexdigest()))
    return sorted(out, key=repr)


@pytest.mark.parametrize(
    "digest", [sha256_of, lambda t: F.substring(F.sha2(t, 256), 1, 1), lambda t: F.lit("same")]
)
def test_edge_rows(edge, digest):
    """Also with digests that different texts share: full texts decide."""
    found = exact_dedup(edge, digest, salts=3).collect()
    assert sorted(map(tuple, found), key=repr) == expected(EDGE)


def test_copies_of_one_text(make_docs):
    rows = [(i, "copy" if i % 3 else f"own {i}", "a") for i in range(3_000)]
    found = exact_dedup(make_docs(rows)).collect()
    assert sorted(map(tuple, found), key=repr) == expected(rows)


def test_empty_table(nothing):
    assert exact_dedup(nothing).count() == 0


def test_texts_stay_behind(edge):
    """After the groups are made, no exchange carries a text."""
    plan = exact_dedup(edge)._jdf.queryExecution().optimizedPlan().toString()
    assert "Join" in plan and "group_size" in plan
