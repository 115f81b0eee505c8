"""Every registered query against its SQL, and known values of the input."""

from __future__ import annotations

import pytest

from cohortry.plans.oracles import ORACLES
from cohortry.plans.registry import QUERIES
from cohortry.sources.respondents import respondents
from oracle import connect, differences

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def con():
    return connect(SF)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_its_sql(spark, con, name):
    assert differences(QUERIES[name](spark, SF), con, ORACLES[name]) == []


def test_every_oracle_has_a_query():
    assert set(ORACLES) <= set(QUERIES)


@pytest.mark.parametrize("sf, counts", [("0.001", (1_530, 1_488, 418)), ("0.01", (15_300, 14_886, 4_071)), ("0.1", (153_000, 148_864, 41_399))])
def test_stand_in_counts(spark, sf, counts):
    df = respondents(spark, f"/root/testdata/sf{sf}")
    row = df.selectExpr("count(*)", "count(target)", "sum(target)").first()
    assert tuple(row) == counts


def test_known_rankings(spark):
    top = QUERIES["top20_capture"](spark, SF).first()
    assert (top["contacts"], top["captured"]) == (2_821, 1_643)
    assert QUERIES["depth_to_60"](spark, SF).first()["contacts"] == 4_374
    tied = QUERIES["baseline_top20"](spark, SF).first()
    assert (tied["contacts"], tied["captured"]) == (2_633, 1_849)
    assert QUERIES["baseline_top20_expected"](spark, SF).first()["captured"] == pytest.approx(1_850.2141, abs=1e-4)


def test_known_distributions(spark):
    rows = {r["risk_points"]: (r["n_rows"], r["positives"]) for r in QUERIES["risk_distribution"](spark, SF).collect()}
    assert (rows[0], rows[5], rows[9], rows[None]) == ((203, 0), (2_347, 592), (141, 125), (1_722, 457))
    confusion = QUERIES["confusion_metrics"](spark, SF).first()
    assert (confusion["tp"], confusion["tn"], confusion["fp"], confusion["fn"]) == (3_318, 5_724, 3_826, 296)
