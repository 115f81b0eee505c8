"""The registered queries: name -> callable(spark, sf_dir) -> DataFrame."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortry.operators import (
    audit, bands, cleaning, clusters, codes, features, metrics, model_tables, models, points, ranking, splitting,
)
from cohortry.plans import study
from cohortry.plans.study import STAND_IN as C
from cohortry.sources import reference, scratch
from cohortry.sources.respondents import KEY, PREDICTORS, SOURCE_TABLES, TARGET, respondents
from cohortry.sources.tables import read_csv, read_table, source_state, write_csv, write_report, write_table

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

# Small runs that make the large-table ranking run at any scale factor.
SMALL_BUCKETS = {"strategy": "buckets", "rows_per_task": 5_000}


def query(function: Query) -> Query:
    QUERIES[function.__name__] = function
    return function


def rounded(df: DataFrame, *columns: str, places: int = 6) -> DataFrame:
    return df.withColumns({c: F.round(c, places) for c in columns})


def doubles(df: DataFrame, *keep: str) -> DataFrame:
    """Round every double column but those named."""
    return rounded(df, *[f.name for f in df.schema if f.dataType.typeName() == "double" and f.name not in keep])


# --- inputs ---------------------------------------------------------------------------


def known(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cleaning.require_target(respondents(spark, sf_dir), TARGET)


def with_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Known targets with the point score and its flag on the capped BMI."""
    df = cleaning.cap(known(spark, sf_dir), C.bmi, study.BMI_CAP)
    df = points.point_score(df, points.risk_rules(C.age, C.bmi, C.sex, C.high_bp, C.activity), C.risk_points)
    return points.threshold_flag(df, C.risk_points, C.risk_flag)


def prepared(spark: SparkSession, sf_dir: str) -> DataFrame:
    return study.prepare(respondents(spark, sf_dir), C, reference.bmi_bands(spark))


_STORED: dict[tuple[str, str, str], tuple[int, str]] = {}


def stored_prepared(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Written by part to scratch storage, once per application and state of the source; later queries read it."""
    key = (spark.sparkContext.applicationId, scratch.scratch_root(spark), sf_dir)
    state = source_state(spark, *(f"{sf_dir}/{name}.parquet" for name in SOURCE_TABLES))
    table = prepared(spark, sf_dir)
    if key not in _STORED or _STORED[key][0] != state or not scratch.is_stored(spark, _STORED[key][1]):
        path = scratch.scratch_path(spark, "prepared")
        write_table(table, path, splitting.SPLIT_COLUMN)
        _STORED[key] = (state, path)
    return spark.read.schema(table.schema).parquet(_STORED[key][1]).select(*table.columns)


def training(df: DataFrame) -> DataFrame:
    return splitting.take_split(df, splitting.TRAINING)


def testing(df: DataFrame) -> DataFrame:
    return splitting.take_split(df, splitting.TESTING)


def imputed(spark: SparkSession, sf_dir: str, columns: list[str] | None = None) -> DataFrame:
    """The prepared table with all predictors imputed, or only the named ones."""
    return study.split_and_impute(stored_prepared(spark, sf_dir), C, columns=columns)[0]


def scored_by_bmi(spark: SparkSession, sf_dir: str) -> DataFrame:
    return known(spark, sf_dir).where(F.col("bmi").isNotNull())


def scored_by_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    return with_points(spark, sf_dir).where(F.col("risk_points").isNotNull())


# --- sources and sinks ----------------------------------------------------------------


@query
def csv_roundtrip(spark, sf_dir):
    df = respondents(spark, sf_dir)
    path = scratch.scratch_path(spark, "respondents_csv")
    write_csv(df, path)
    return read_csv(spark, path, df.schema)


@query
def csv_inferred(spark, sf_dir):
    path = scratch.scratch_path(spark, "codes_csv")
    write_csv(codes.observed_codes(respondents(spark, sf_dir), list(C.coded)), path)
    return read_csv(spark, path).select("variable", "code", F.col("n_rows").cast("bigint"))


@query
def report_roundtrip(spark, sf_dir):
    """A small aggregate through a one-file CSV report."""
    path = scratch.scratch_path(spark, "report")
    report = risk_distribution(spark, sf_dir)
    write_report(report, path)
    return read_csv(spark, path, report.schema)


@query
def parquet_roundtrip(spark, sf_dir):
    path = scratch.scratch_path(spark, "respondents")
    write_table(respondents(spark, sf_dir), path)
    return read_table(spark, path)


@query
def profile_columns(spark, sf_dir):
    return doubles(audit.profile(respondents(spark, sf_dir), [KEY, *PREDICTORS, TARGET]))


# --- row expressions ------------------------------------------------------------------


@query
def target_cleaning(spark, sf_dir):
    return cleaning.target_report(respondents(spark, sf_dir), TARGET)


@query
def missing_indicators(spark, sf_dir):
    df = cleaning.missing_indicators(known(spark, sf_dir), list(C.indicators))
    return df.select(KEY, *[c for c in df.columns if c.endswith("_missing")])


@query
def missing_count(spark, sf_dir):
    return cleaning.missing_count(known(spark, sf_dir), PREDICTORS).select(KEY, C.missing_count)


@query
def bmi_cap(spark, sf_dir):
    return cleaning.cap(known(spark, sf_dir), "bmi", study.BMI_CAP).select(KEY, "bmi")


@query
def bmi_cap_report(spark, sf_dir):
    return cleaning.cap_report(known(spark, sf_dir), "bmi", study.BMI_CAP)


@query
def health_day_bands(spark, sf_dir):
    return points.band(known(spark, sf_dir), "ment_hlth", "ment_hlth_band").select(KEY, "ment_hlth", "ment_hlth_band")


@query
def bmi_band_reference(spark, sf_dir):
    df = cleaning.cap(known(spark, sf_dir), "bmi", study.BMI_CAP)
    df = bands.band_by_reference(df, "bmi", reference.bmi_bands(spark), "bmi_band", study.EXPECTED_BANDS)
    return df.select(KEY, "bmi", "bmi_band")


@query
def bmi_band_asia_pacific(spark, sf_dir):
    df = bands.band_by_reference(
        known(spark, sf_dir), "bmi", reference.bmi_bands(spark, "WHO_AsiaPacific"), "bmi_band", study.EXPECTED_BANDS
    )
    return df.select(KEY, "bmi", "bmi_band")


@query
def risk_score(spark, sf_dir):
    return with_points(spark, sf_dir).select(KEY, "risk_points", "risk_flag")


@query
def comorbidity_count(spark, sf_dir):
    df = points.condition_count(known(spark, sf_dir), list(C.conditions), C.condition_count)
    return df.select(KEY, C.condition_count)


@query
def stable_split(spark, sf_dir):
    df = splitting.stable_split(known(spark, sf_dir), KEY, study.TRAINING_SHARE)
    return df.select(KEY, splitting.SPLIT_COLUMN)


@query
def class_weights(spark, sf_dir):
    return rounded(splitting.class_weights(training(prepared(spark, sf_dir)), TARGET, "balanced"), "weight")


@query
def class_weights_ratio(spark, sf_dir):
    return rounded(splitting.class_weights(training(prepared(spark, sf_dir)), TARGET, "ratio"), "weight")


@query
def weighted_rows(spark, sf_dir):
    """Training weights on the rows of both parts, summed per part and class."""
    table = stored_prepared(spark, sf_dir)
    weighted = splitting.apply_weights(table, splitting.class_weights(training(table), TARGET), TARGET)
    sums = weighted.groupBy(splitting.SPLIT_COLUMN, TARGET).agg(
        F.count("*").alias("n_rows"), F.sum("class_weight").alias("total_weight")
    )
    return rounded(sums, "total_weight", places=4)


# --- joins with reference tables ------------------------------------------------------


@query
def observed_codes(spark, sf_dir):
    return codes.observed_codes(known(spark, sf_dir), list(C.coded))


@query
def code_violations(spark, sf_dir):
    """Against labels that lack the highest age band and have one income code unlabelled."""
    v, code = F.col("variable"), F.col("code")
    labels = reference.code_labels(spark).where(~((v == "Age") & (code == 13)))
    labels = labels.withColumn("label", F.when(~((v == "Income") & (code == 3)), F.col("label")))
    return codes.validate_codes(known(spark, sf_dir), labels, list(C.coded), C.coded)


@query
def code_violations_clean(spark, sf_dir):
    return codes.validate_codes(known(spark, sf_dir), reference.code_labels(spark), list(C.coded), C.coded)


@query
def bmi_range_join(spark, sf_dir):
    df = cleaning.cap(known(spark, sf_dir), "bmi", study.BMI_CAP).select(KEY, "bmi")
    return bands.range_join(df, reference.bmi_bands(spark), "bmi")


@query
def bmi_range_join_cells(spark, sf_dir):
    """The form for long band tables: one band per tenth of a unit, with overlaps, by equi-join."""
    steps = spark.range(140, 640, 5).select(
        F.col("id").cast("int").alias("band_code"),
        (F.col("id") / 10).alias("lower"),
        ((F.col("id") + 7) / 10).alias("upper"),
    )
    return bands.range_join(known(spark, sf_dir).select(KEY, "bmi"), steps, "bmi", max_indexed=16)


def _long_bands(spark: SparkSession) -> DataFrame:
    """Five hundred bands from a tenth to forty units wide, with overlaps, gaps, unknown codes and empty bands."""
    i = F.col("id")
    width = F.when(i % 50 == 0, 400).when(i % 11 == 0, 0).otherwise(1 + i % 9)
    return spark.range(500).select(
        F.when(i % 7 != 0, (i * 37) % 500).cast("int").alias("band_code"),
        ((140 + i) / 10).alias("lower"), ((140 + i + width) / 10).alias("upper"),
    )


def _third_at_25(spark: SparkSession, sf_dir: str) -> DataFrame:
    """BMI of known respondents, of whom a third share one value."""
    return known(spark, sf_dir).select(KEY, F.when(F.col(KEY) % 3 == 0, 25.0).otherwise(F.col("bmi")).alias("bmi"))


@query
def bmi_band_long_table(spark, sf_dir):
    """First code of a long table, by its interval index."""
    return bands.band_by_reference(_third_at_25(spark, sf_dir), "bmi", _long_bands(spark), "bmi_band")


@query
def bmi_band_long_table_cells(spark, sf_dir):
    """The same by cells, as tables beyond the index are looked up."""
    return bands.band_by_reference(_third_at_25(spark, sf_dir), "bmi", _long_bands(spark), "bmi_band", max_case=16, max_indexed=16)


@query
def bmi_range_join_overlaps(spark, sf_dir):
    """All bands of the long table that hold a value, unknown codes too, by the interval index."""
    return bands.range_join(_third_at_25(spark, sf_dir), _long_bands(spark), "bmi")


@query
def bmi_band_audit_long(spark, sf_dir):
    """First codes against all bands of the long table: its overlaps and gaps must show."""
    long = _long_bands(spark).where(F.col("band_code").isNotNull())
    banded = bands.band_by_reference(_third_at_25(spark, sf_dir), "bmi", long, "bmi_band")
    return bands.audit_bands(banded, long, "bmi", "bmi_band")


def _banded(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = cleaning.cap(known(spark, sf_dir), "bmi", study.BMI_CAP)
    return bands.band_by_reference(df, "bmi", reference.bmi_bands(spark), "bmi_band", study.EXPECTED_BANDS)


@query
def bmi_band_audit(spark, sf_dir):
    return bands.audit_bands(_banded(spark, sf_dir), reference.bmi_bands(spark), "bmi", "bmi_band")


@query
def bmi_band_audit_planted(spark, sf_dir):
    """The same rows against a standard with other limits and a gap: both faults must show."""
    other = reference.bmi_bands(spark, "WHO_AsiaPacific").where("band_code <> 3")
    return bands.audit_bands(_banded(spark, sf_dir), other, "bmi", "bmi_band")


# --- aggregation ----------------------------------------------------------------------


@query
def dedup_profiles(spark, sf_dir):
    return cleaning.dedup_profiles(known(spark, sf_dir), KEY)


@query
def dedup_profiles_without_key(spark, sf_dir):
    return cleaning.dedup_profiles(cleaning.drop_identifier(known(spark, sf_dir), KEY))


@query
def risk_distribution(spark, sf_dir):
    df = with_points(spark, sf_dir)
    return df.groupBy("risk_points").agg(F.count("*").alias("n_rows"), F.sum(TARGET).alias("positives"))


@query
def band_distribution(spark, sf_dir):
    return cleaning.distribution(_banded(spark, sf_dir), "bmi_band")


@query
def comorbidity_distribution(spark, sf_dir):
    return cleaning.distribution(comorbidity_count(spark, sf_dir), C.condition_count)


@query
def target_distribution(spark, sf_dir):
    return cleaning.distribution(respondents(spark, sf_dir), TARGET)


@query
def partition_distribution(spark, sf_dir):
    return cleaning.distribution(prepared(spark, sf_dir), splitting.SPLIT_COLUMN)


@query
def confusion_table(spark, sf_dir):
    return metrics.confusion_table(with_points(spark, sf_dir), TARGET, "risk_flag")


@query
def confusion_metrics(spark, sf_dir):
    """The flag is null where a component is unknown, so the cells do not reconcile here."""
    return doubles(metrics.confusion_metrics(with_points(spark, sf_dir), TARGET, "risk_flag"))


@query
def confusion_metrics_reconciled(spark, sf_dir):
    return doubles(metrics.confusion_metrics(scored_by_points(spark, sf_dir), TARGET, "risk_flag"))


RULES = {"risk": "risk_flag", "weight": "bmi_flag", "health": "health_flag"}


def _with_rules(df: DataFrame) -> DataFrame:
    df = points.threshold_flag(df, "bmi", "bmi_flag", 30.0)
    return points.threshold_flag(df, "gen_hlth", "health_flag", 4)


@query
def subgroup_recall(spark, sf_dir):
    """On imputed answers, as the models see them: unknown incomes sit in the median band."""
    df = _with_rules(testing(imputed(spark, sf_dir, ["bmi", "gen_hlth", "risk_flag", C.group])))
    return doubles(metrics.subgroup_recall(df, C.group, TARGET, RULES, "risk"))


@query
def subgroup_recall_raw(spark, sf_dir):
    """On the answers as given: unknown incomes are a group, and a row covers all groups."""
    df = _with_rules(testing(prepared(spark, sf_dir)))
    return doubles(metrics.subgroup_recall(df, C.group, TARGET, RULES, "risk", overall=True))


@query
def baseline_metrics(spark, sf_dir):
    return doubles(metrics.baseline_metrics(testing(imputed(spark, sf_dir, ["risk_flag"])), TARGET, "risk_flag"))


@query
def baseline_summary(spark, sf_dir):
    df = testing(imputed(spark, sf_dir, ["risk_flag", "risk_points"]))
    return doubles(metrics.baseline_metrics(df, TARGET, "risk_flag", "risk_points", KEY))


@query
def cluster_profile(spark, sf_dir):
    df = training(imputed(spark, sf_dir, list(C.profiled)))
    return doubles(clusters.cluster_profile(df, "gen_hlth", [c for c in C.profiled if c != "gen_hlth"], TARGET))


@query
def train_medians(spark, sf_dir):
    table = stored_prepared(spark, sf_dir)
    return study.split_and_impute(table, C)[1].table(table)


# --- ranking --------------------------------------------------------------------------


@query
def global_rank(spark, sf_dir):
    return ranking.global_rank(scored_by_bmi(spark, sf_dir).select(KEY, "bmi"), "bmi", KEY)


@query
def global_rank_buckets(spark, sf_dir):
    return ranking.global_rank(scored_by_bmi(spark, sf_dir).select(KEY, "bmi"), "bmi", KEY, **SMALL_BUCKETS)


@query
def rank_with_nulls(spark, sf_dir):
    """Unknown scores rank last, in key order; they are many, and still no single task's load."""
    return ranking.global_rank(known(spark, sf_dir).select(KEY, "bmi"), "bmi", KEY, **SMALL_BUCKETS)


@query
def cumulative_positives(spark, sf_dir):
    df = scored_by_bmi(spark, sf_dir).select(KEY, "bmi", TARGET)
    return ranking.global_rank(df, "bmi", KEY, TARGET)


@query
def cumulative_positives_heavy_ties(spark, sf_dir):
    df = scored_by_points(spark, sf_dir).select(KEY, "risk_points", TARGET)
    return ranking.global_rank(df, "risk_points", KEY, TARGET, **SMALL_BUCKETS)


@query
def top20_capture(spark, sf_dir):
    return doubles(ranking.top_fraction(scored_by_bmi(spark, sf_dir), "bmi", KEY, TARGET))


@query
def top20_capture_buckets(spark, sf_dir):
    return doubles(ranking.top_fraction(scored_by_bmi(spark, sf_dir), "bmi", KEY, TARGET, **SMALL_BUCKETS))


@query
def depth_to_60(spark, sf_dir):
    return doubles(ranking.depth_to_capture(scored_by_bmi(spark, sf_dir), "bmi", KEY, TARGET))


@query
def depth_to_60_buckets(spark, sf_dir):
    return doubles(ranking.depth_to_capture(scored_by_bmi(spark, sf_dir), "bmi", KEY, TARGET, **SMALL_BUCKETS))


@query
def gains_curve(spark, sf_dir):
    return doubles(ranking.gains_curve(scored_by_points(spark, sf_dir), "risk_points", KEY, TARGET))


@query
def gains_curve_buckets(spark, sf_dir):
    return doubles(ranking.gains_curve(scored_by_points(spark, sf_dir), "risk_points", KEY, TARGET, **SMALL_BUCKETS))


@query
def baseline_top20(spark, sf_dir):
    return doubles(ranking.top_fraction(scored_by_points(spark, sf_dir), "risk_points", KEY, TARGET))


@query
def baseline_top20_expected(spark, sf_dir):
    df = scored_by_points(spark, sf_dir)
    return doubles(ranking.top_fraction(df, "risk_points", KEY, TARGET, ties="expected"))


@query
def threshold_sweep(spark, sf_dir):
    df = scored_by_points(spark, sf_dir).withColumn("score", F.col("risk_points") / 9.0)
    return doubles(ranking.threshold_sweep(df, TARGET, "score"))


# --- comparison and audits ------------------------------------------------------------


def _given_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three given scores with a prediction each, stored narrow, on the imputed test part."""
    df = _with_rules(testing(imputed(spark, sf_dir, ["bmi", "gen_hlth", "risk_points", "risk_flag"])))
    given: list[Column] = [
        (F.col("bmi") / 64.0).alias("weight_score"),
        (F.col("risk_points") / 9.0).alias("risk_score"),
        (F.col("gen_hlth") / 5.0).alias("health_score"),
    ]
    return scratch.stored(df.select(KEY, TARGET, *RULES.values(), *given), "scored")


@query
def evaluation_record(spark, sf_dir):
    df = _given_scores(spark, sf_dir)
    return doubles(metrics.evaluate(df, "weight", TARGET, "weight_score", "bmi_flag", KEY))


@query
def evaluation_record_buckets(spark, sf_dir):
    df = _given_scores(spark, sf_dir)
    return doubles(metrics.evaluate(df, "weight", TARGET, "weight_score", "bmi_flag", KEY, **SMALL_BUCKETS))


@query
def model_comparison(spark, sf_dir):
    names = {rule: (f"{rule}_score", flag) for rule, flag in RULES.items()}
    return doubles(metrics.compare_models(_given_scores(spark, sf_dir), names, TARGET, KEY))


@query
def auc_exact(spark, sf_dir):
    return rounded(metrics.auc(scored_by_bmi(spark, sf_dir), TARGET, "bmi"), "auc")


@query
def auc_exact_buckets(spark, sf_dir):
    return rounded(metrics.auc(scored_by_bmi(spark, sf_dir), TARGET, "bmi", **SMALL_BUCKETS), "auc")


@query
def best_by(spark, sf_dir):
    bands_of_income = known(spark, sf_dir).where(F.col("income").isNotNull()).groupBy("income").agg(
        F.sum(TARGET).alias("positives")
    )
    return audit.best_by(bands_of_income, "positives", "income")


@query
def trace_rows(spark, sf_dir):
    table = stored_prepared(spark, sf_dir)
    test = testing(table)
    n = test.count()
    ranks = ranking.global_rank(test.select(KEY, "bmi"), "bmi", KEY).select("rank").distinct()
    tables = {
        "flagged": points.threshold_flag(test, "risk_points", "flag"),
        "ranked": ranks.where(F.col("rank").between(1, n)),  # every rank once
        "known_bmi": test.where(F.col("bmi").isNotNull()),
    }
    return audit.trace_rows(tables, n)


@query
def stage_audit(spark, sf_dir):
    return audit.stage_audit(respondents(spark, sf_dir), KEY, TARGET, "bmi", study.BMI_CAP, list(C.indicators))


# --- fitted features ------------------------------------------------------------------


@query
def prepared_table(spark, sf_dir):
    return prepared(spark, sf_dir)


@query
def impute_train_median(spark, sf_dir):
    return imputed(spark, sf_dir)


@query
def recompute_after_impute(spark, sf_dir):
    """Constructed columns computed from the imputed answers instead of being imputed."""
    df = study.recompute_constructed(imputed(spark, sf_dir), C, reference.bmi_bands(spark))
    return df.select(KEY, "bmi_band", "ment_hlth_band", "risk_points", "risk_flag", "condition_count")


@query
def chi_square_scores(spark, sf_dir):
    df = imputed(spark, sf_dir)
    return rounded(features.chi_square(training(df), study.predictors(df, C), TARGET), "statistic")


@query
def chi_square_binned(spark, sf_dir):
    """As the study ranks its features: BMI in bins."""
    df = imputed(spark, sf_dir)
    return rounded(features.chi_square(training(df), study.predictors(df, C), TARGET, {C.bmi: study.BMI_BIN}), "statistic")


@query
def scale_unit_std(spark, sf_dir):
    df = imputed(spark, sf_dir)
    columns = study.predictors(df, C)
    scaled = features.fit_scaler(training(df), columns).apply(df)
    return rounded(scaled.select(KEY, splitting.SPLIT_COLUMN, *columns), *columns)


@query
def selected_features(spark, sf_dir):
    train = training(imputed(spark, sf_dir))
    candidates = study.predictors(train, C)
    ranked = features.rank_features(train, candidates, TARGET, {C.bmi: study.BMI_BIN})
    report = features.selection_report(train, candidates, TARGET, 12, ranked)
    return rounded(rounded(report, "statistic"), "p_value", places=12)


# --- models and clusters (no SQL counterpart) -----------------------------------------


def _transformed(spark: SparkSession, sf_dir: str) -> study.Transformed:
    return study.transform(imputed(spark, sf_dir), C, top=12)


def scores_of(name: str) -> Query:
    def scores(spark: SparkSession, sf_dir: str) -> DataFrame:
        parts = _transformed(spark, sf_dir)
        fitted = models.fit_classifiers(parts.train, TARGET, (name,))
        scored = models.score_models(parts.test, fitted)
        return scored.select(KEY, TARGET, f"{name}_score", f"{name}_prediction")

    scores.__name__ = f"scores_{name}"
    return scores


for _name in models.ESTIMATORS:
    query(scores_of(_name))


def _scored(spark: SparkSession, sf_dir: str, names: tuple[str, ...]) -> DataFrame:
    """The test part scored by several classifiers in one pass, stored for evaluation."""
    parts = _transformed(spark, sf_dir)
    fitted = models.fit_classifiers(parts.train, TARGET, names)
    return scratch.stored(models.score_models(parts.test, fitted).drop("features"), "scored")


@query
def classifier_comparison(spark, sf_dir):
    names = tuple(models.ESTIMATORS)
    columns = {m: (f"{m}_score", f"{m}_prediction") for m in names}
    return metrics.compare_models(_scored(spark, sf_dir, names), columns, TARGET, KEY)


@query
def classifier_subgroup_recall(spark, sf_dir):
    """Recall per income band of two classifiers against the rule's flag."""
    rules = {"risk": "risk_flag", "lr": "lr_prediction", "gbt": "gbt_prediction"}
    return metrics.subgroup_recall(_scored(spark, sf_dir, ("lr", "gbt")), C.group, TARGET, rules, "risk", overall=True)


@query
def classifier_gains(spark, sf_dir):
    return ranking.gains_curve(_scored(spark, sf_dir, ("lr",)), "lr_score", KEY, TARGET)


@query
def classifier_thresholds(spark, sf_dir):
    return ranking.threshold_sweep(_scored(spark, sf_dir, ("lr",)), TARGET, "lr_score")


@query
def rf_sensitivity(spark, sf_dir):
    parts = _transformed(spark, sf_dir)
    return models.forest_sensitivity(parts.train, parts.test, TARGET)


# Two models of our own: stumps as (column, limit, value), and coefficients.
STUMPS = (("age", 5.0, 2.0), ("age", 8.0, 1.0), ("bmi", 24.9, 1.0), ("bmi", 29.9, 2.0), ("high_bp", 0.0, 1.0))
WEIGHTS = {"age": 0.21, "bmi": 0.08, "high_bp": 0.9, "gen_hlth": 0.45, model_tables.INTERCEPT: -6.0}


def _answered(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Known respondents whose answers the stated models need are known."""
    return known(spark, sf_dir).dropna(subset=["age", "bmi", "high_bp", "gen_hlth"])


@query
def tree_table_scores(spark, sf_dir):
    """Boosted stumps, stated as a node table, over the answers; unknown answers go right."""
    columns = sorted({c for c, *_ in STUMPS})
    nodes = [
        (tree, node, columns.index(column) if node == 0 else -1, limit if node == 0 else None, *((1, 2) if node == 0 else (-1, -1)),
         value if node == 2 else -value, 0.1, "logistic2")
        for tree, (column, limit, value) in enumerate(STUMPS) for node in range(3)
    ]
    table = spark.createDataFrame(nodes, model_tables.NODES)
    df = known(spark, sf_dir)
    return rounded(model_tables.score_nodes(df, table, columns, "score").select(KEY, "score"), "score", places=9)


@query
def linear_table_scores(spark, sf_dir):
    """A stated coefficient table over the answers; an unknown answer gives no score."""
    table = spark.createDataFrame(list(WEIGHTS.items()), "feature string, coefficient double")
    return rounded(model_tables.score_linear(known(spark, sf_dir), table, "score").select(KEY, "score"), "score", places=9)


@query
def linear_table_comparison(spark, sf_dir):
    """The stated linear model against the flag's points, as records."""
    table = spark.createDataFrame(list(WEIGHTS.items()), "feature string, coefficient double")
    df = model_tables.score_linear(with_points(spark, sf_dir).dropna(subset=["age", "bmi", "high_bp", "gen_hlth", "risk_points"]), table, "linear")
    df = df.withColumns({"linear": F.round("linear", 9), "said": (F.col("linear") >= 0.5).cast("int"), "points": F.col("risk_points") / 9.0})
    named = {"linear": ("linear", "said"), "risk": ("points", "risk_flag")}
    return doubles(metrics.compare_models(df.select(KEY, TARGET, "linear", "said", "points", "risk_flag"), named, TARGET, KEY))


@query
def centre_table_profile(spark, sf_dir):
    """Respondents by the nearest of the mean answers per general health, and a profile of these clusters."""
    df, columns = _answered(spark, sf_dir), ["age", "bmi", "gen_hlth"]
    means = df.groupBy("gen_hlth").agg(F.array(*[F.round(F.avg(c), 6) for c in columns]).alias("centre"))
    assigned = model_tables.assign_clusters(df, means.select(F.col("gen_hlth").alias("cluster"), "centre"), columns)
    return doubles(clusters.cluster_profile(assigned, "cluster", ["age", "bmi"], TARGET))


def _ranked(spark, sf_dir, score, key):
    """Orders by a score and a key of any type, through the buckets."""
    df = read_table(spark, f"{sf_dir}/orders.parquet").select(F.col("o_orderkey").alias("id"), score.alias("score"), key.alias("key"))
    return ranking.global_rank(df, "score", "key", **SMALL_BUCKETS).select("id", "rank")


@query
def rank_bigint_ties(spark, sf_dir):
    """Two scores that share a double: 2^53 and 2^53 + 1."""
    score = F.lit(2**53).cast("bigint") + F.col("o_orderkey") % 2
    return _ranked(spark, sf_dir, score, F.col("o_orderkey"))


@query
def rank_decimal_ties(spark, sf_dir):
    """Decimal scores that differ in the twentieth place."""
    low, high = (F.lit(f"1.{digits:020d}").cast("decimal(38,20)") for digits in (0, 1))
    score = F.when(F.col("o_orderkey") % 2 == 1, high).otherwise(low)
    return _ranked(spark, sf_dir, score, F.col("o_orderkey"))


@query
def rank_string_key(spark, sf_dir):
    """Few scores, ties broken by a string key."""
    key = F.concat(F.lit("order-"), F.lpad(F.col("o_orderkey").cast("string"), 12, "0"))
    return _ranked(spark, sf_dir, F.col("o_orderkey") % 3, key)


@query
def kmeans_screening(spark, sf_dir):
    return clusters.screen_k(_transformed(spark, sf_dir).train)


@query
def kmeans_profile(spark, sf_dir):
    train = _transformed(spark, sf_dir).train
    screened = clusters.screen(train)
    best = audit.best_by(screened.table, "silhouette", "k").first()["k"]
    return clusters.cluster_profile(screened.models[best].transform(train), "cluster", list(C.profiled), TARGET)


@query
def silhouette(spark, sf_dir):
    df = read_table(spark, f"{sf_dir}/embeddings.parquet")
    return rounded(clusters.silhouette(df, "embedding", "label"), "silhouette")
