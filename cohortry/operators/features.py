"""Training-fitted feature steps: imputation, chi-square ranking, scaling, assembly."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml.feature import Imputer, UnivariateFeatureSelector, VectorAssembler
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cohortry.functions.expressions import chi_square_tail
from cohortry.operators.order_stats import exact_quantiles


@dataclass(frozen=True)
class FittedImputer:
    """Training medians by column, applied as literals in one projection."""

    medians: dict[str, float]

    def apply(self, df: DataFrame) -> DataFrame:
        filled = {}
        for c, median in self.medians.items():
            kind = df.schema[c].dataType
            fill = F.lit(float(median)).cast(kind)
            value = F.col(c)
            if isinstance(kind, (T.DoubleType, T.FloatType)):
                value = F.nanvl(value, F.lit(None).cast(kind))
            filled[c] = F.coalesce(value, fill)
        return df.withColumns(filled)

    def table(self, df: DataFrame) -> DataFrame:
        rows = [(c, float(m)) for c, m in self.medians.items()]
        return df.sparkSession.createDataFrame(rows, "feature string, median double")


def fit_imputer(train: DataFrame, columns: list[str], mode: str = "exact") -> FittedImputer:
    """Medians of the training part. ``approx`` is Spark ML's imputer, within 0.1% in rank."""
    if mode == "exact":
        medians = exact_quantiles(train, columns, 0.5)
    elif mode == "approx":
        numbers = train.select(*[F.col(c).cast("double").alias(c) for c in columns])
        model = Imputer(inputCols=columns, outputCols=[f"{c}__filled" for c in columns], strategy="median").fit(numbers)
        medians = model.surrogateDF.first().asDict()
    else:
        raise ValueError(f"unknown imputer mode {mode!r}")
    unknown = [c for c in columns if medians.get(c) is None]
    if unknown:
        raise ValueError(f"no known value to impute from in {unknown}")
    return FittedImputer({c: medians[c] for c in columns})


def assemble(df: DataFrame, columns: list[str], out: str = "features") -> DataFrame:
    """Vector of the columns; a null in any of them is an error when the rows are read."""
    return VectorAssembler(inputCols=columns, outputCol=out, handleInvalid="error").transform(df)


def chi_square(df: DataFrame, columns: list[str], label: str, widths: dict[str, float] | None = None) -> DataFrame:
    """Pearson statistic and degrees of freedom of each coded column against the label.

    Continuous columns are named in ``widths`` and counted in bins of that width. The contingency tables of all columns come from one scan with map-side combine. With
    observed counts o, row totals r and column totals c the statistic is
    ``n * sum over labels of (sum of o^2 / r) / c - n``: empty cells contribute nothing and
    the column totals fall out of the same sums. The only window spans the labels of one
    value, so a column of many values never gathers in one task.
    """
    widths = widths or {}
    values = [(F.floor(F.col(c) / widths[c]) if c in widths else F.col(c)).cast("double").alias(c) for c in columns]
    observed = (
        df.select(F.col(label).cast("double").alias("_y"), *values)
        .unpivot(["_y"], columns, "feature", "value")
        .groupBy("feature", "value", F.col("_y").alias("y"))
        .agg(F.count("*").cast("double").alias("o"))
    )
    value = Window.partitionBy("feature", "value")
    rows = observed.select(
        "feature",
        "y",
        "o",
        F.sum("o").over(value).alias("r"),
        (F.row_number().over(value.orderBy("y")) == 1).cast("bigint").alias("first"),
    )
    by_label = rows.groupBy("feature", "y").agg(
        F.sum(F.col("o") * F.col("o") / F.col("r")).alias("s"),
        F.sum("o").alias("c"),
        F.sum("first").alias("values"),
    )
    sums = by_label.groupBy("feature").agg(
        F.sum("c").alias("n"),
        F.sum(F.col("s") / F.col("c")).alias("share"),
        F.sum("values").alias("values"),
        F.count("*").alias("labels"),
    )
    return sums.select(
        "feature",
        (F.col("n") * F.col("share") - F.col("n")).alias("statistic"),
        ((F.col("values") - 1) * (F.col("labels") - 1)).alias("dof"),
    )


def rank_features(train: DataFrame, columns: list[str], label: str, widths: dict[str, float] | None = None) -> DataFrame:
    """``rank, feature, statistic, dof, p_value``, strongest association first.

    On large tables many p-values underflow to zero, so ties go to the larger statistic
    per degree of freedom, then to the name. Columns should be coded or have a width of
    their bins: the test takes each value as a category. The window orders one row per column.
    """
    tests = chi_square(train, columns, label, widths).withColumn("p_value", chi_square_tail(F.col("statistic"), F.col("dof")))
    strength = F.coalesce(F.col("statistic") / F.when(F.col("dof") > 0, F.col("dof")), F.lit(0.0))
    order = Window.orderBy(F.asc("p_value"), strength.desc(), F.asc("feature"))
    return tests.select(F.row_number().over(order).alias("rank"), "feature", "statistic", "dof", "p_value")


def select_top(
    train: DataFrame, columns: list[str], label: str, n: int, mode: str = "strength", ranked: DataFrame | None = None
) -> list[str]:
    """The ``n`` selected columns, in their original order; ``ranked`` saves ranking them again.

    ``ml`` is Spark ML's selector, in which tied p-values keep the column order and more
    than 10,000 values of a column are an error.
    """
    if mode == "strength":
        ranked = ranked if ranked is not None else rank_features(train, columns, label)
        kept = {r["feature"] for r in ranked.where(F.col("rank") <= n).collect()}
        return [c for c in columns if c in kept]
    if mode != "ml":
        raise ValueError(f"unknown selection mode {mode!r}")
    selector = UnivariateFeatureSelector(
        featuresCol="_v", labelCol="_y", outputCol="_s", selectionMode="numTopFeatures"
    ).setFeatureType("categorical").setLabelType("categorical").setSelectionThreshold(n)
    vector = assemble(train.select(*columns, F.col(label).cast("double").alias("_y")), columns, "_v")
    return [columns[i] for i in sorted(selector.fit(vector).selectedFeatures)]


def selection_report(
    train: DataFrame, columns: list[str], label: str, n: int, ranked: DataFrame | None = None
) -> DataFrame:
    """The kept features with their rank and test, and the candidate count."""
    ranked = ranked if ranked is not None else rank_features(train, columns, label)
    return ranked.where(F.col("rank") <= n).withColumn("n_candidates", F.lit(len(columns)))


@dataclass(frozen=True)
class FittedScaler:
    """Training standard deviations; a constant column scales to zero."""

    deviations: dict[str, float]

    def apply(self, df: DataFrame, suffix: str = "") -> DataFrame:
        """Scaled columns under their own names plus ``suffix``."""
        return df.withColumns({f"{c}{suffix}": self._scaled(c) for c in self.deviations})

    def _scaled(self, column: str):
        deviation = self.deviations[column]
        return F.col(column) / F.lit(deviation) if deviation > 0 else F.lit(0.0)


def fit_scaler(train: DataFrame, columns: list[str]) -> FittedScaler:
    """Sample standard deviations of all columns in one aggregation; no centring."""
    row = train.agg(*[F.stddev_samp(F.col(c).cast("double")).alias(c) for c in columns]).first()
    return FittedScaler({c: float(row[c] or 0.0) for c in columns})


def scaled_vector(df: DataFrame, scaler: FittedScaler, out: str = "features") -> DataFrame:
    """Add the vector of scaled columns; the unscaled columns stay as they are."""
    columns = list(scaler.deviations)
    scaled = scaler.apply(df, "__scaled")
    return assemble(scaled, [f"{c}__scaled" for c in columns], out).drop(*[f"{c}__scaled" for c in columns])
