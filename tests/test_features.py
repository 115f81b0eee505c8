"""Training-fitted steps: medians, chi-square, selection, scaling."""

from __future__ import annotations

import math
import random

import pytest
from pyspark.ml.feature import StandardScaler
from pyspark.ml.stat import ChiSquareTest
from pyspark.sql import functions as F

from cohortry.functions.expressions import chi_square_tail
from cohortry.operators import features
from cohortry.operators.order_stats import exact_quantiles


def table(n=3_000):
    rng = random.Random(2)
    return [
        (
            i,
            rng.randrange(5) if i % 7 else None,
            rng.gauss(0, 10),
            1.0 if i % 3 == 0 else rng.random() * 4,
            rng.choice([None, math.nan, 2.5, -1.0]),
            7.0,
            int(rng.random() < 0.4),
        )
        for i in range(n)
    ]


SCHEMA = "id long, code int, wide double, third double, ragged double, same double, y int"
COLUMNS = ["code", "wide", "third", "ragged", "same"]


@pytest.fixture(scope="module")
def df(spark):
    return spark.createDataFrame(table(), SCHEMA).repartition(5).cache()


def quantile(values, q):
    known = sorted(v for v in values if v is not None and not math.isnan(v))
    return known[max(1, math.ceil(q * len(known))) - 1]


@pytest.mark.parametrize("q", [0.0, 0.1, 0.5, 0.9, 1.0])
@pytest.mark.parametrize("values_per_task", [10, 400, 1_000_000])
def test_quantiles_are_exact_however_few_values_fit_a_task(df, q, values_per_task):
    got = exact_quantiles(df, COLUMNS, q, values_per_task)
    rows = table()
    assert got == {c: quantile([r[i] for r in rows], q) for i, c in enumerate(COLUMNS, start=1)}


def test_column_of_nulls(spark):
    df = spark.createDataFrame([(1, None), (2, None)], "a int, b int")
    assert exact_quantiles(df, ["a", "b"]) == {"a": 1.0, "b": None}
    assert exact_quantiles(df, ["a", "b"], values_per_task=1) == {"a": 1.0, "b": None}
    with pytest.raises(ValueError, match="b"):
        features.fit_imputer(df, ["a", "b"])


def test_imputer_fills_and_keeps_types(df):
    imputer = features.fit_imputer(df, COLUMNS)
    filled = imputer.apply(df)
    assert filled.dtypes == df.dtypes
    assert filled.where(" or ".join(f"{c} is null or isnan({c})" for c in COLUMNS)).count() == 0
    assert imputer.table(df).count() == len(COLUMNS)


def test_approximate_imputer_is_close(df):
    exact = features.fit_imputer(df, ["wide", "same"]).medians
    approx = features.fit_imputer(df, ["wide", "same"], mode="approx").medians
    assert approx["same"] == 7.0
    assert abs(exact["wide"] - approx["wide"]) < 0.5


def test_nothing_is_learnt_from_the_test_part(df):
    """Fitted values must not move when test rows change."""
    train, test = df.where("id % 10 < 7"), df.where("id % 10 >= 7")
    changed = train.unionByName(test.withColumn("wide", F.col("wide") * 1000).withColumn("code", F.lit(4)))
    again = changed.where("id % 10 < 7")
    assert features.fit_imputer(train, COLUMNS) == features.fit_imputer(again, COLUMNS)
    assert features.fit_scaler(train, ["wide"]).deviations == pytest.approx(features.fit_scaler(again, ["wide"]).deviations)


def coded(df):
    return df.select("y", F.coalesce("code", F.lit(0)).alias("code"), (F.col("id") % 3).alias("noise"), "same",
                     (F.col("y") * 2 + F.col("id") % 2).alias("strong"))


def test_chi_square_equals_spark_ml(df):
    columns = ["code", "noise", "strong", "same"]
    ranked = features.rank_features(coded(df), columns, "y").orderBy("rank").collect()
    vectors = features.assemble(coded(df), columns, "v")
    theirs = {columns[r["featureIndex"]]: r for r in ChiSquareTest.test(vectors, "v", "y", flatten=True).collect()}
    for r in ranked:
        ml = theirs[r["feature"]]
        assert r["statistic"] == pytest.approx(ml["statistic"], abs=1e-6)
        assert r["dof"] == ml["degreesOfFreedom"]
        assert r["p_value"] == pytest.approx(ml["pValue"], abs=1e-9)
    assert [r["rank"] for r in ranked] == [1, 2, 3, 4]
    assert ranked[0]["feature"] == "strong" and ranked[-1]["feature"] == "same"


def test_chi_square_tail(spark):
    """Critical values from the published tables, and the finite sum with the library's functions."""
    known = [(3.841458820694124, 1, 0.05), (5.991464547107979, 2, 0.05), (18.307038053275146, 10, 0.05), (0.0, 5, 1.0), (9.0, 0, 1.0), (1e5, 3, 0.0)]

    def tail(statistic, dof):
        x, odd = statistic / 2, dof % 2
        powers = [odd / 2 + i for i in range(dof // 2)]
        return math.fsum(math.exp(a * math.log(x) - x - math.lgamma(a + 1)) for a in powers) + (math.erfc(math.sqrt(x)) if odd else 0.0)

    grid = [(s, d, min(1.0, tail(s, d))) for s in (1e-9, 0.01, 0.5, 1.0, 3.0, 5.99, 6.01, 12.0, 40.0, 300.0, 1_200.0) for d in (1, 2, 3, 4, 7, 12, 51, 200)]
    df = spark.createDataFrame(known + grid, "statistic double, dof bigint, p double")
    for r in df.withColumn("ours", chi_square_tail(F.col("statistic"), F.col("dof"))).collect():
        assert r["ours"] == pytest.approx(r["p"], rel=1e-10, abs=1e-14), r


def test_chi_square_of_many_values(spark):
    """More categories than Spark ML accepts; the expected counts are one half each."""
    df = spark.range(24_000).select((F.col("id") % 12_000).alias("v"), F.floor(F.col("id") / 12_000).alias("y"))
    row = features.chi_square(df, ["v"], "y").first()
    assert (row["dof"], row["statistic"]) == (11_999, pytest.approx(0.0, abs=1e-6))


def test_selection_breaks_ties_by_strength(spark):
    """All p-values underflow to zero; the stronger feature must win, not the earlier column."""
    df = spark.range(6_000).select(
        (F.col("id") % 2).alias("y"),
        F.when(F.col("id") % 10 < 3, F.lit(0)).otherwise(F.col("id") % 2).alias("weaker"),
        (F.col("id") % 2).alias("stronger"),
    )
    assert features.select_top(df, ["weaker", "stronger"], "y", 1) == ["stronger"]
    assert features.select_top(df, ["weaker", "stronger"], "y", 1, mode="ml") == ["weaker"]
    assert features.select_top(df, ["weaker", "stronger"], "y", 2) == ["weaker", "stronger"]
    report = features.selection_report(df, ["weaker", "stronger"], "y", 1).collect()
    assert [(r["rank"], r["feature"], r["n_candidates"]) for r in report] == [(1, "stronger", 2)]


def test_scaler_equals_spark_ml(df):
    columns = ["wide", "third", "same"]
    scaled = features.scaled_vector(df, features.fit_scaler(df, columns))
    vectors = features.assemble(df, columns, "raw")
    ml = StandardScaler(inputCol="raw", outputCol="ml", withStd=True, withMean=False).fit(vectors).transform(vectors)
    ours = {r["id"]: r["features"].toArray() for r in scaled.collect()}
    for r in ml.select("id", "ml").collect():
        assert ours[r["id"]] == pytest.approx(r["ml"].toArray())
    assert set(scaled.columns) == {*df.columns, "features"}


def test_assembling_a_null_is_an_error(df):
    with pytest.raises(Exception, match="(?i)null"):
        features.assemble(df, ["code"]).select("features").collect()


def test_unknown_modes(df):
    with pytest.raises(ValueError, match="mode"):
        features.fit_imputer(df, ["wide"], mode="guess")
    with pytest.raises(ValueError, match="mode"):
        features.select_top(df, ["same"], "y", 1, mode="guess")


def test_wide_columns_share_their_jobs(spark):
    """As many jobs for nine wide columns as for one."""
    columns = [f"c{i}" for i in range(9)]
    df = spark.range(4_000).select(*[((F.col("id") * (2 * i + 7) * 31) % 4_001 + F.lit(0.5)).alias(c) for i, c in enumerate(columns)]).cache()
    tracker, context = spark.sparkContext.statusTracker(), spark.sparkContext

    def jobs(names):
        context.setJobGroup(f"quantiles-{len(names)}", "")
        found = exact_quantiles(df, names, 0.5, values_per_task=50)
        context.setLocalProperty("spark.jobGroup.id", None)
        assert all(found[c] == sorted(r[0] for r in df.select(c).collect())[1_999] for c in names)
        return len(tracker.getJobIdsForGroup(f"quantiles-{len(names)}"))

    df.count()
    assert jobs(columns) <= jobs(columns[:1]) + 2
