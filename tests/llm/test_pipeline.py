"""Each stage against a plain version on its own input."""

import numpy as np
import pytest

import corpus_pipeline as pipeline
from flightloom.llm.toxicity import fit
from flightloom.session import settle

from test_line_dedup import expected as cleaned_lines  # noqa: I001
from test_packing import check as check_packing
from test_simhash import expected as components


@pytest.fixture(scope="module")
def stages(spark, sf_dir, documents):
    out = [("documents", documents)]
    for name, stage in pipeline.STAGES:
        out.append((name, settle(stage(spark, out[-1][1], sf_dir), name)))
    return dict(out)


def test_order_and_columns(stages, documents):
    assert [n for n, _ in pipeline.STAGES] == ["toxicity", "line_dedup", "near_dedup", "mixing", "packing"]
    for name in list(stages)[:-1]:
        assert stages[name].schema == documents.schema


def rows(df):
    return sorted(map(tuple, df.collect()))


def test_toxicity(stages, spark, sf_dir, documents):
    model = fit(documents, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    scan = model.scanner()
    want = [r for r in rows(documents) if model.score(np.array([scan.features(r[1])]))[0] < 0.5]
    assert rows(stages["toxicity"]) == want and 0 < len(want) < documents.count()


def test_line_dedup(stages):
    before = rows(stages["toxicity"])
    texts = {d: (t, n) for d, t, n in cleaned_lines([(r[0], r[1], r[3]) for r in before], 0.05, 5)}
    want = [(d, texts[d][0], g, s, len(texts[d][0]) if texts[d][1] else n) for d, _, g, s, n in before]
    assert rows(stages["line_dedup"]) == want


def test_near_dedup(stages):
    before = rows(stages["line_dedup"])
    kept = {d for d, _, c in components([(r[0], r[1], None) for r in before]) if d == c}
    assert rows(stages["near_dedup"]) == [r for r in before if r[0] in kept]


def test_mixing(stages):
    before = {r[0]: r for r in rows(stages["near_dedup"])}
    after = rows(stages["mixing"])
    assert all(before[r[0]] == r for r in after)
    copies = {d: sum(r[0] == d for r in after) for d in before}
    assert set(copies.values()) <= {0, 1, 2}


def test_packing(stages):
    check_packing([(r[0], r[1], r[3]) for r in rows(stages["mixing"])], stages["packing"].collect(), 1024)


def test_run(spark, sf_dir, stages):
    assert rows(pipeline.run(spark, sf_dir).drop("ids")) == rows(stages["packing"].drop("ids"))
