"""Ranking and everything read off it, against plain Python on small tables."""

from __future__ import annotations

import math
import random
from datetime import date
from decimal import Decimal

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from cohortry.operators import ranking

SCHEMA = "id long, score double, y int"
NAN = float("nan")
BUCKETS = {"strategy": "buckets", "rows_per_task": 40}


def table(kind: str, n: int = 400) -> list[tuple]:
    rng = random.Random(kind)
    scores = {
        "distinct": lambda i: rng.random(),
        "points": lambda i: float(rng.randrange(4)),
        "third": lambda i: 0.5 if i % 3 == 0 else rng.random(),
        "constant": lambda i: 1.0,
        "ragged": lambda i: rng.choice([None, NAN, 0.0, -0.0, math.inf, -math.inf, rng.random()]),
        "by_key": lambda i: float(i < 150),
    }[kind]
    return [(1000 + 3 * i, scores(i), int(rng.random() < 0.3)) for i in rng.sample(range(n), n)]


KINDS = ["distinct", "points", "third", "constant", "ragged", "by_key"]


def ordered(rows):
    def place(row):
        s = row[1]
        if s is None:
            return (2, 0.0, row[0])
        return (0, 0.0, row[0]) if math.isnan(s) else (1, -s + 0.0, row[0])

    return sorted(rows, key=place)


def frame(spark, rows, partitions=3):
    return spark.createDataFrame(rows, SCHEMA).repartition(partitions)


@pytest.mark.parametrize("kind", KINDS)
@pytest.mark.parametrize("options", [{"strategy": "window"}, BUCKETS], ids=["window", "buckets"])
def test_rank_and_running_positives(spark, kind, options):
    rows = table(kind)
    ranked = ranking.global_rank(frame(spark, rows), "score", "id", "y", **options)
    got = {r["id"]: (r["rank"], r["cum_positives"]) for r in ranked.collect()}
    running, expected = 0, {}
    for rank, (key, _, y) in enumerate(ordered(rows), start=1):
        running += y
        expected[key] = (rank, running)
    assert got == expected


@pytest.mark.parametrize("kind", KINDS)
def test_every_heavy_score_is_cut(spark, kind):
    """No run holds more than a few shares, even when one score has every row."""
    df = frame(spark, table(kind, 2_000))
    runs = ranking.sorted_runs(df, [], ranking._rank_order("score", "id"), 2_000, 400)
    assert runs.groupBy(ranking.RUN).count().agg(F.max("count")).first()[0] <= 2_000 * 6 / 20


def test_scores_that_share_a_double_are_cut(spark):
    """A third of the rows on two integers that are one double."""
    df = spark.range(3_000).selectExpr("id", "if(id % 3 = 0, 9007199254740992 + (id div 3) % 2, id) as score")
    runs = ranking.sorted_runs(df, [], ranking._rank_order("score", "id"), 3_000, 600)
    spread = runs.where("score >= 9007199254740992").groupBy(ranking.RUN).count().collect()
    assert len(spread) >= 5 and max(r["count"] for r in spread) <= 400
    ranks = [{r["id"]: r["rank"] for r in ranking.global_rank(df, "score", "id", **o).collect()} for o in ({"strategy": "window"}, BUCKETS)]
    assert ranks[0] == ranks[1]


def test_only_rows_that_decide_are_counted_for_runs(spark, monkeypatch):
    """The tasks of a figure follow the rows it orders, not all rows times its questions."""
    given, running = [], ranking.running
    monkeypatch.setattr(ranking, "running", lambda rows, group, order, sums, n, *rest: given.append((group, n, rows.count())) or running(rows, group, order, sums, n, *rest))
    curve = ranking.gains_curve(frame(spark, table("points")), "score", "id", "y", **BUCKETS).collect()
    asked = [(n, count) for group, n, count in given if "_question" in group]
    assert len(asked) == 1 and asked[0][0] == asked[0][1]
    monkeypatch.undo()
    assert curve == ranking.gains_curve(frame(spark, table("points")), "score", "id", "y", strategy="window").collect()


def test_rank_ignores_partitioning(spark):
    rows = table("third")
    one = ranking.global_rank(frame(spark, rows, 1), "score", "id", **BUCKETS).orderBy("rank").collect()
    many = ranking.global_rank(frame(spark, rows, 17), "score", "id", **BUCKETS).orderBy("rank").collect()
    assert one == many


def captured(rows, contacts):
    return sum(r[2] for r in ordered(rows)[:contacts])


@pytest.mark.parametrize("kind", KINDS)
@pytest.mark.parametrize("options", [{}, BUCKETS], ids=["auto", "buckets"])
def test_gains_depth_and_top(spark, kind, options):
    rows = table(kind, 383)
    df, n, positives = frame(spark, rows), 383, sum(r[2] for r in rows)
    curve = ranking.gains_curve(df, "score", "id", "y", **options).orderBy("depth").collect()
    assert [(r["contacts"], r["captured"]) for r in curve] == [
        (int(n * d), captured(rows, int(n * d))) for d in ranking.GAINS_DEPTHS
    ]
    captures = [r["capture"] for r in curve]
    assert captures == sorted(captures)

    top = ranking.top_fraction(df, "score", "id", "y", **options).first()
    contacts = math.ceil(n * 0.20)
    assert (top["contacts"], top["captured"]) == (contacts, captured(rows, contacts))
    assert top["lift"] * 0.20 == pytest.approx(top["capture_rate"])
    assert top["contacts_per_case"] == pytest.approx(contacts / top["captured"])

    depth = ranking.depth_to_capture(df, "score", "id", "y", **options).first()
    first = next(k for k in range(1, n + 1) if captured(rows, k) >= positives * 0.60)
    assert depth["contacts"] == first
    assert depth["depth"] == pytest.approx(first / n)


@pytest.mark.parametrize("options", [{}, BUCKETS], ids=["auto", "buckets"])
def test_no_positives_and_no_rows(spark, options):
    rows = [(i, s, 0) for i, s, _ in table("distinct", 100)]
    df = frame(spark, rows)
    top = ranking.top_fraction(df, "score", "id", "y", **options).first()
    assert (top["captured"], top["capture_rate"], top["lift"], top["contacts_per_case"]) == (0, 0.0, 0.0, None)
    assert ranking.depth_to_capture(df, "score", "id", "y", **options).first()["contacts"] == 1
    empty = spark.createDataFrame([], SCHEMA)
    assert ranking.top_fraction(empty, "score", "id", "y", **options).first()["captured"] == 0
    assert ranking.depth_to_capture(empty, "score", "id", "y", **options).first()["contacts"] is None
    assert ranking.global_rank(empty, "score", "id", "y", **options).count() == 0
    assert [r["captured"] for r in ranking.gains_curve(empty, "score", "id", "y", **options).collect()] == [0] * 8


@pytest.mark.parametrize("options", [{}, BUCKETS], ids=["auto", "buckets"])
def test_expected_ties_are_the_mean_over_orders(spark, options):
    rows = table("points", 200)
    top = ranking.top_fraction(frame(spark, rows), "score", "id", "y", ties="expected", **options).first()
    rng = random.Random(1)
    shuffled = []
    for _ in range(4_000):
        keys = rng.sample(range(len(rows)), len(rows))
        order = sorted(zip(keys, rows), key=lambda p: (-p[1][1], p[0]))
        shuffled.append(sum(r[2] for _, r in order[: top["contacts"]]))
    assert top["captured"] == pytest.approx(sum(shuffled) / len(shuffled), abs=0.15)


def test_score_groups_forms_agree(spark):
    df = frame(spark, table("third", 500))
    size = ranking.population(df, "y", "score")
    groups = [
        sorted(tuple(r) for r in ranking.score_groups(df, "score", "y", size, **o).collect())
        for o in ({"strategy": "window"}, BUCKETS)
    ]
    assert groups[0] == groups[1]
    assert sum(g[1] for g in groups[0]) == 500


def test_threshold_sweep(spark):
    df = spark.createDataFrame([(1, 0.3, 1), (2, 0.5, 0), (3, 0.2, 1), (4, 0.55, 1)], SCHEMA)
    got = {r["threshold"]: tuple(r)[1:] for r in ranking.threshold_sweep(df, "y", "score").collect()}
    assert got[0.3] == (pytest.approx(2 / 3), pytest.approx(2 / 3), 3)
    assert got[0.5] == (pytest.approx(1 / 3), 0.5, 2)
    assert got[0.6] == (0.0, None, 0)


def test_ceil_and_floor_depths():
    assert ranking.depth_contacts(101, 0.20, "ceil") == 21
    assert ranking.depth_contacts(101, 0.20, "floor") == 20


SCORES = st.one_of(st.none(), st.sampled_from([NAN, math.inf, -math.inf, 0.0, -0.0, 1.0]), st.floats(-5, 5), st.integers(0, 3).map(float))


@settings(max_examples=12, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.tuples(SCORES, st.integers(0, 1)), min_size=1, max_size=120), st.integers(5, 60))
def test_any_scores_rank_alike(spark, drawn, rows_per_task):
    rows = [(7 * i % 1009, score, y) for i, (score, y) in enumerate(drawn)]
    df = spark.createDataFrame(rows, SCHEMA).coalesce(2)
    ranked = ranking.global_rank(df, "score", "id", "y", strategy="buckets", rows_per_task=rows_per_task)
    got = [r["id"] for r in sorted(ranked.collect(), key=lambda r: r["rank"])]
    assert got == [r[0] for r in ordered(rows)]


def test_text_keys_rank_in_buckets(spark):
    df = spark.createDataFrame([("b", 0.5, 1), ("a", 0.5, 1)], "id string, score double, y int")
    assert {r["id"]: r["rank"] for r in ranking.global_rank(df, "score", "id", **BUCKETS).collect()} == {"a": 1, "b": 2}


def test_unknown_choices_are_refused(spark):
    df = frame(spark, table("points", 10))
    with pytest.raises(ValueError, match="strategy"):
        ranking.global_rank(df, "score", "id", strategy="guess")
    with pytest.raises(ValueError, match="tie"):
        ranking.top_fraction(df, "score", "id", "y", ties="best")


TYPED = {
    "bigint": ("bigint", lambda rng: 2**53 + rng.randrange(3)),
    "negative": ("bigint", lambda rng: -(2**62) + rng.choice([0, 1, 1, 1, 600])),
    "decimal": ("decimal(38,20)", lambda rng: Decimal(1) + rng.choice([0, 1, 1, 7]) * Decimal("1e-20")),
    "float": ("float", lambda rng: float(rng.randrange(3))),
    "int": ("int", lambda rng: rng.choice([None, 1, 1, 2])),
    "string": ("string", lambda rng: rng.choice(["score-a", "score-a1", "score-b", "score-b", "score-"])),
    "date": ("date", lambda rng: date(2020, 1, 1 + rng.randrange(3))),
}


@pytest.mark.parametrize("kind", sorted(TYPED))
@pytest.mark.parametrize("keys", ["bigint", "string"])
def test_buckets_equal_one_window_for_any_type(spark, kind, keys):
    name, draw = TYPED[kind]
    rng = random.Random(kind)
    rows = [(2**55 + i if keys == "bigint" else f"person-{i:05d}", draw(rng), int(rng.random() < 0.3)) for i in range(600)]
    df = spark.createDataFrame(rows, f"id {keys}, score {name}, y int").repartition(3)
    ranks = [
        {r["id"]: (r["rank"], r["cum_positives"]) for r in ranking.global_rank(df, "score", "id", "y", **options).collect()}
        for options in ({"strategy": "window"}, BUCKETS)
    ]
    assert ranks[0] == ranks[1]


def test_unknown_types_are_rejected_at_every_size(spark):
    df = spark.createDataFrame([([1], 1.0, 1)], "id array<int>, score double, y int")
    for options in ({"strategy": "auto"}, BUCKETS):
        with pytest.raises(ValueError, match="can't be ranked"):
            ranking.global_rank(df, "score", "id", "y", **options)


def test_short_runs_of_a_long_table_share_tasks(spark, monkeypatch):
    """Runs are as short as asked for, but the tasks that sort them, and so the files, are bounded."""
    monkeypatch.setattr(ranking, "LEAST_TASKS", 4)
    df = frame(spark, table("third", 2_000))
    runs = ranking.sorted_runs(df, [], ranking._rank_order("score", "id"), 2_000, 40)
    sizes = [r["count"] for r in runs.groupBy(ranking.RUN).count().collect()]
    assert len(sizes) >= 2_000 / 40 and max(sizes) <= 40
    assert runs.select(F.input_file_name()).distinct().count() <= 4
    ranked = [{r["id"]: (r["rank"], r["cum_positives"]) for r in ranking.global_rank(df, "score", "id", "y", **o).collect()} for o in ({"strategy": "window"}, BUCKETS)]
    assert ranked[0] == ranked[1]
