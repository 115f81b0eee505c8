"""The driver contract, the command line and the bench."""

from __future__ import annotations

import __spark_entry__ as contract
import bench
from cohortry import __main__ as command


def test_entry(spark):
    rows = contract.entry(spark).collect()
    assert [r["depth"] for r in rows] == [0.05, 0.10, 0.15, 0.20, 0.25, 0.30, 0.40, 0.50]


def test_names():
    queries, oracles = contract.queries(), contract.oracle_sql()
    assert set(oracles) <= set(queries)
    # The training-data queries come and go with their folder and have tests of their own.
    own = {q for q in queries if q != "pipeline" and not (q.startswith("op") and q[2:3].isdigit())}
    without = own - set(oracles)
    assert without == {
        "scores_lr", "scores_dt", "scores_rf", "scores_gbt", "classifier_comparison",
        "classifier_subgroup_recall", "classifier_gains", "classifier_thresholds", "rf_sensitivity", "kmeans_screening", "kmeans_profile",
    }


def test_bench_names_exist():
    assert set(bench.HEADLINE) <= set(contract.queries())
    assert set(bench.PLAIN) <= set(contract.queries())


def test_plain_forms_run(spark):
    for plain in bench.PLAIN.values():
        plain(spark, "/root/testdata/sf0.001")


def test_command_line(monkeypatch, capsys):
    monkeypatch.setattr(command, "get_spark", lambda master: None)
    seen = {}

    def run(spark, *arguments):
        seen["arguments"] = arguments
        return {"prepared": "out/prepared"}

    monkeypatch.setattr(command, "run_survey", run)
    command.main(["in.csv", "out", "--labels", "l.csv"])
    assert seen["arguments"] == ("in.csv", "out", "l.csv", None)
    assert capsys.readouterr().out == "prepared\tout/prepared\n"
