"""The study from survey rows to an evaluated contact list."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from cohortry.operators import bands as band_ops
from cohortry.operators import cleaning, clusters, codes, features, metrics, models, points, ranking, splitting
from cohortry.operators.audit import audit_profiles, best_by, profile, require_columns, schema_table, trace_rows
from cohortry.sources import reference, respondents
from cohortry.sources.tables import read_csv, read_table, write_report, write_table

# Plausibility cap, share of the training part, features kept.
BMI_CAP = 60.0
TRAINING_SHARE = 0.7
TOP_FEATURES = 24
EXPECTED_BANDS = 4
# BMI is continuous: the association tests count it in bins of this width.
BMI_BIN = 5.0


@dataclass(frozen=True)
class StudyColumns:
    """Which column plays which part. ``key`` may be absent from the table."""

    key: str
    target: str
    age: str
    bmi: str
    sex: str
    high_bp: str
    activity: str
    group: str
    day_counts: tuple[str, ...]
    conditions: tuple[str, ...]
    indicators: tuple[str, ...]
    coded: dict[str, str]
    profiled: tuple[str, ...]
    risk_points: str = "risk_points"
    risk_flag: str = "risk_flag"
    condition_count: str = "condition_count"
    missing_count: str = "n_missing_fields"

    @property
    def bmi_band(self) -> str:
        return f"{self.bmi}_band"


# Column names of the survey extract.
SURVEY = StudyColumns(
    key="ID",
    target="Diabetes_binary",
    age="Age",
    bmi="BMI",
    sex="Sex",
    high_bp="HighBP",
    activity="PhysActivity",
    group="Income",
    day_counts=("MentHlth", "PhysHlth"),
    conditions=("Stroke", "HeartDiseaseorAttack", "DiffWalk"),
    indicators=("Income", "HighChol", "BMI", "HvyAlcoholConsump", "CholCheck"),
    coded={v: v for v in ("GenHlth", "Age", "Education", "Income", "Sex", "Diabetes_binary")},
    profiled=("Age", "GenHlth", "Income", "BMI", "RiskTest5", "ComorbidityCount"),
    risk_points="RiskTest5",
    risk_flag="RiskTest5_flag",
    condition_count="ComorbidityCount",
)

# The stand-in table of ``sources.respondents`` with the same parts.
STAND_IN = StudyColumns(
    key=respondents.KEY,
    target=respondents.TARGET,
    age="age",
    bmi="bmi",
    sex="sex",
    high_bp="high_bp",
    activity="phys_activity",
    group="income",
    day_counts=("ment_hlth",),
    conditions=("stroke", "heart_disease", "diff_walk"),
    indicators=("income", "bmi", "ment_hlth", "phys_activity", "high_chol"),
    coded={"gen_hlth": "GenHlth", "age": "Age", "income": "Income", "sex": "Sex", "target": "Diabetes_binary"},
    profiled=("age", "gen_hlth", "income", "bmi", "risk_points", "condition_count"),
)


def predictors(df: DataFrame, c: StudyColumns) -> list[str]:
    """Every column but the key, the target and the stored split."""
    return [x for x in df.columns if x not in (c.key, c.target, splitting.SPLIT_COLUMN)]


def with_key(profiles: DataFrame, c: StudyColumns) -> DataFrame:
    """Distinct profiles with a key: the smallest of theirs, or the md5 of the profile."""
    distinct = profiles.drop(cleaning.COPIES)
    if c.key in distinct.columns:
        return distinct
    profile = F.to_json(F.struct(*distinct.columns), {"ignoreNullFields": "false"})
    return distinct.select(F.md5(profile).alias(c.key), "*")


def profiles_of(df: DataFrame, c: StudyColumns) -> DataFrame:
    return cleaning.count_profiles(df, c.key if c.key in df.columns else None)


def construct(df: DataFrame, c: StudyColumns, bands: DataFrame, expected_bands: int | None = EXPECTED_BANDS) -> DataFrame:
    """Bands, point score, flag and condition count on a cleaned table."""
    df = band_ops.band_by_reference(df, c.bmi, bands, c.bmi_band, expected_bands)
    for column in c.day_counts:
        df = points.band(df, column, f"{column}_band")
    rules = points.risk_rules(c.age, c.bmi, c.sex, c.high_bp, c.activity)
    df = points.point_score(df, rules, c.risk_points)
    df = points.threshold_flag(df, c.risk_points, c.risk_flag)
    return points.condition_count(df, list(c.conditions), c.condition_count)


def prepare(df: DataFrame, c: StudyColumns, bands: DataFrame) -> DataFrame:
    """Cleaning, construction and split: one shuffle (the duplicates), the rest projections."""
    require_columns(df, [c.target, c.bmi, *c.coded])
    return prepare_profiles(profiles_of(cleaning.require_target(df, c.target), c), c, bands)


def prepare_profiles(profiles: DataFrame, c: StudyColumns, bands: DataFrame) -> DataFrame:
    """The same from a table of profiles with their number of rows: projections only."""
    require_columns(profiles, [c.target, c.bmi, *c.coded])
    df = with_key(cleaning.require_target(profiles, c.target), c)
    base = predictors(df, c)
    df = cleaning.missing_indicators(df, list(c.indicators))
    df = cleaning.missing_count(df, base, c.missing_count)
    df = cleaning.cap(df, c.bmi, BMI_CAP)
    return splitting.stable_split(construct(df, c, bands), c.key, TRAINING_SHARE)


def split_and_impute(
    prepared: DataFrame, c: StudyColumns, mode: str = "exact", columns: list[str] | None = None
) -> tuple[DataFrame, features.FittedImputer]:
    """The whole table filled with medians of its training part, and the fitted medians.

    ``columns`` names those to fill; the others stay as they are. All predictors by default.
    """
    train = splitting.take_split(prepared, splitting.TRAINING)
    imputer = features.fit_imputer(train, columns or predictors(prepared, c), mode)
    return imputer.apply(prepared), imputer


def recompute_constructed(imputed: DataFrame, c: StudyColumns, bands: DataFrame) -> DataFrame:
    """Constructed columns again from the imputed answers, instead of being imputed themselves."""
    return construct(imputed, c, bands).select(*imputed.columns)


@dataclass(frozen=True)
class Transformed:
    train: DataFrame
    test: DataFrame
    selected: list[str]
    ranked: DataFrame


def transform(imputed: DataFrame, c: StudyColumns, top: int = TOP_FEATURES, mode: str = "strength") -> Transformed:
    """Feature selection and scaling fitted on the training part, applied to both."""
    train = splitting.take_split(imputed, splitting.TRAINING)
    test = splitting.take_split(imputed, splitting.TESTING)
    candidates = predictors(imputed, c)
    ranked = features.rank_features(train, candidates, c.target, {c.bmi: BMI_BIN})
    selected = features.select_top(train, candidates, c.target, min(top, len(candidates)), mode, ranked)
    scaler = features.fit_scaler(train, selected)
    return Transformed(features.scaled_vector(train, scaler), features.scaled_vector(test, scaler), selected, ranked)


def run_study(
    spark: SparkSession,
    source: DataFrame,
    c: StudyColumns,
    out_dir: str,
    labels: DataFrame | None = None,
    bands: DataFrame | None = None,
    overrides: dict[str, dict] | None = None,
    ks: tuple[int, ...] = clusters.SCREENED_K,
    top: int = TOP_FEATURES,
    trees: tuple[int, ...] = models.SENSITIVITY_TREES,
) -> dict[str, str]:
    """Run every stage and write its table or report under ``out_dir``; returns name -> path.

    Stages meet in stored Parquet, so each later scan reads only the columns it needs and
    no shuffle upstream is repeated. Imputation and scaling are projections with fitted
    literals over the prepared table; only their end result is written.
    """
    labels = labels if labels is not None else reference.code_labels(spark)
    bands = bands if bands is not None else reference.bmi_bands(spark)
    paths: dict[str, str] = {}

    def path(name: str) -> str:
        paths[name] = f"{out_dir.rstrip('/')}/{name}"
        return paths[name]

    def keep(name: str, df: DataFrame, partition_by: str | None = None) -> DataFrame:
        write_table(df, path(name), partition_by)
        return read_table(spark, paths[name])

    def report(name: str, df: DataFrame) -> None:
        write_report(df, path(name))

    numeric = [x for x in source.columns if x != c.key]
    report("source_schema", schema_table(source))
    report("source_profile", profile(source, numeric))
    # The only shuffle of the profile columns: duplicates and the audit are read off it.
    profiles = keep("profiles", profiles_of(source, c))
    report("stage_audit", audit_profiles(profiles, c.target, c.bmi, BMI_CAP, list(c.indicators)))

    prepared = keep("prepared", prepare_profiles(profiles, c, bands), splitting.SPLIT_COLUMN)
    report("observed_codes", codes.observed_codes(prepared, list(c.coded)).orderBy("variable", "code"))
    codes.validate_codes(prepared, labels, list(c.coded), c.coded, strict=True)
    band_ops.require_clean_bands(band_ops.audit_bands(prepared, bands, c.bmi, c.bmi_band))
    for column in (c.risk_points, c.bmi_band, c.condition_count, c.target, splitting.SPLIT_COLUMN):
        report(f"distribution_{column}", cleaning.distribution(prepared, column).orderBy(column))

    imputed, imputer = split_and_impute(prepared, c)
    report("medians", imputer.table(imputed))
    transformed = transform(imputed, c, top)
    train = keep("train", transformed.train)
    test = keep("test", transformed.test)
    n_kept, candidates = len(transformed.selected), predictors(imputed, c)
    kept = features.selection_report(train, candidates, c.target, n_kept, transformed.ranked)
    report("selected_features", kept.orderBy("rank"))
    report("class_weights", splitting.class_weights(train, c.target).orderBy("label"))

    fitted = models.fit_classifiers(train, c.target, overrides=overrides)
    scored = keep("scored", models.score_models(test, fitted).drop("features"))
    names = {m: (f"{m}_score", f"{m}_prediction") for m in fitted}
    comparison = metrics.compare_models(scored, names, c.target, c.key).persist()
    report("model_comparison", comparison)
    adrift = [r["model"] for r in comparison.where(~F.col("reconciles")).collect()]
    comparison.unpersist()
    if adrift:
        raise ValueError(f"confusion cells do not add up to the test rows for {adrift}")
    report("baseline", metrics.baseline_metrics(scored, c.target, c.risk_flag, c.risk_points, c.key))
    pointed = scored.where(F.col(c.risk_points).isNotNull())
    report("baseline_expected_ties", ranking.top_fraction(pointed, c.risk_points, c.key, c.target, ties="expected"))
    rules = {"risk": c.risk_flag} | {m: p for m, (_, p) in names.items()}
    report("subgroup_recall", metrics.subgroup_recall(scored, c.group, c.target, rules, "risk", overall=True).orderBy(c.group))
    for m, (score, prediction) in names.items():
        report(f"confusion_{m}", metrics.confusion_table(scored, c.target, prediction).orderBy(c.target, prediction))
        report(f"gains_{m}", ranking.gains_curve(scored, score, c.key, c.target))
        report(f"thresholds_{m}", ranking.threshold_sweep(scored, c.target, score))

    report("forest_sensitivity", models.forest_sensitivity(train, test, c.target, trees).orderBy("n_trees"))

    screened = clusters.screen(train, ks)
    report("cluster_screening", screened.table)
    best = best_by(screened.table, "silhouette", "k").first()["k"]
    assigned = screened.models[best].transform(train)
    report("cluster_profile", clusters.cluster_profile(assigned, "cluster", list(c.profiled), c.target).orderBy("cluster"))

    tables = {m: scored.where(F.col(p).isNotNull()) for m, (_, p) in names.items()}
    report("trace_rows", trace_rows({"scored": scored} | tables, test.count()))
    return paths


def run_survey(
    spark: SparkSession,
    csv_path: str,
    out_dir: str,
    labels_csv: str | None = None,
    bands_csv: str | None = None,
    schema: StructType | str | None = None,
    **options,
) -> dict[str, str]:
    """``run_study`` on the survey's CSV extract, with the reference tables from CSV if given.

    The extract is parsed once and stored as Parquet, which every later scan reads. Give
    its schema on large inputs: inferring it reads the text once more.
    """
    labels = read_csv(spark, labels_csv, reference.LABEL_SCHEMA) if labels_csv else None
    bands = reference.bands_of(read_csv(spark, bands_csv, reference.BAND_SCHEMA)) if bands_csv else None
    stored = f"{out_dir.rstrip('/')}/source"
    write_table(read_csv(spark, csv_path, schema), stored)
    paths = run_study(spark, read_table(spark, stored), SURVEY, out_dir, labels, bands, **options)
    return {"source": stored} | paths
