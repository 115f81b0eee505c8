"""The pipeline and the registered queries against SQL and brute force."""

from __future__ import annotations

import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).parent))

import __spark_entry__ as contract  # noqa: E402
import brute  # noqa: E402
import corpus_pipeline  # noqa: E402
from cohortry.llm.queries import ORACLES, QUERIES, toxicity_scorer  # noqa: E402
from oracle import connect, differences  # noqa: E402

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_its_sql(spark, name):
    assert differences(QUERIES[name](spark, SF), connect(SF), ORACLES[name]) == []


def test_names():
    names = set(contract.queries())
    assert "pipeline" in names
    assert all(any(n.startswith(f"op{i}_") for n in names) for i in range(1, 11))
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "exact_dedup", "near_dedup", "mixing", "packing"]


def test_pipeline(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rows = {r.doc_id: r for r in docs.collect()}
    scorer = toxicity_scorer(spark, SF)
    if scorer:
        ids = sorted(rows)
        rows = {i: rows[i] for i, s in zip(ids, scorer.scores([rows[i].text for i in ids])) if s < 0.7}
    latest = {rows[i].text or "": i for i in sorted(rows)}
    rows = {i: rows[i] for i in latest.values()}
    near = brute.near_components({i: r.text for i, r in rows.items()})
    rows = {i: rows[i] for i in rows if near[i][1] == i}
    ordered = [(i, r.source, r.text) for i, r in sorted(rows.items())]
    expected = sorted((i, *p) for (i, _, t), n in zip(ordered, brute.mix_copies(ordered)) for _ in range(n) for p in brute.cut(t))
    got = corpus_pipeline.run(spark, SF).collect()
    assert sorted((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in got) == expected
