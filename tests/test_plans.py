"""What the physical plans must, and must not, contain."""

from __future__ import annotations

import contextlib
import io

import pytest

from cohortry.operators import bands, ranking
from cohortry.plans.registry import QUERIES, known
from cohortry.sources import reference

SF = "/root/testdata/sf0.001"


def plan(df) -> str:
    out = io.StringIO()
    with contextlib.redirect_stdout(out):
        df.explain()
    return out.getvalue()


def raw_window_in_one_task(text: str) -> bool:
    """A single-partition exchange fed by anything but an aggregate."""
    lines = text.splitlines()
    for i, line in enumerate(lines):
        if "Exchange SinglePartition" in line:
            below = " ".join(lines[i + 1 : i + 3])
            if "Aggregate" not in below:
                return True
    return False


@pytest.mark.parametrize(
    "name",
    ["global_rank_buckets", "cumulative_positives_heavy_ties", "rank_with_nulls", "gains_curve_buckets",
     "top20_capture_buckets", "depth_to_60_buckets", "auc_exact_buckets"],
)
def test_bucketed_ranking_puts_no_raw_rows_in_one_task(spark, name):
    assert not raw_window_in_one_task(plan(QUERIES[name](spark, SF)))


def test_the_check_sees_a_global_window(spark):
    df = known(spark, SF).select("id", "bmi")
    assert raw_window_in_one_task(plan(ranking.global_rank(df, "bmi", "id", strategy="window")))


def test_runs_are_bounded(spark, monkeypatch):
    """The table of offsets, one row per run, is broadcast: runs have a bound."""
    monkeypatch.setattr(ranking, "MAX_RUNS", 3)
    df = known(spark, SF).select("id", "bmi")
    ranked = ranking.global_rank(df, "bmi", "id", strategy="buckets", rows_per_task=100)
    assert sorted(r["rank"] for r in ranked.collect()) == list(range(1, df.count() + 1))
    runs = ranking.sorted_runs(df, [], ranking._rank_order("bmi", "id"), df.count(), 100)
    assert runs.select(ranking.RUN).distinct().count() <= 3


def test_range_join_broadcasts_the_small_side_only(spark):
    text = plan(bands.range_join(known(spark, SF).select("id", "bmi"), reference.bmi_bands(spark), "bmi"))
    assert "LeftOuter, BuildRight" in text and "BroadcastHashJoin" in text and "NestedLoop" not in text and "Cartesian" not in text


def test_long_band_tables_join_on_a_cell(spark):
    text = plan(QUERIES["bmi_range_join_cells"](spark, SF))
    assert "NestedLoop" not in text and "Cartesian" not in text


LEARNERS = ("scores_", "rf_", "kmeans_", "classifier_", "silhouette")


@pytest.mark.parametrize("name", sorted(n for n in QUERIES if not n.startswith(LEARNERS)))
def test_no_python_workers_and_no_cartesian_products(spark, name):
    text = plan(QUERIES[name](spark, SF))
    for forbidden in ("ArrowEvalPython", "BatchEvalPython", "MapInPandas", "FlatMapGroups", "CartesianProduct"):
        assert forbidden not in text


def test_scans_read_only_the_columns_they_need(spark):
    text = plan(QUERIES["bmi_cap"](spark, SF))
    schema = next(line for line in text.splitlines() if "orders.parquet" in line)
    assert "o_orderdate" not in schema and "o_orderstatus" not in schema


def test_stored_tables_are_filtered_in_the_scan(spark, tmp_path):
    path = str(tmp_path / "p")
    QUERIES["prepared_table"](spark, SF).write.partitionBy("Partition").parquet(path)
    text = plan(spark.read.parquet(path).where("Partition = 'Testing' and bmi > 30").select("bmi"))
    assert "PartitionFilters: [isnotnull(Partition" in text and "GreaterThan(bmi,30.0)" in text
