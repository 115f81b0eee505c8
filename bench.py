"""Time the headline queries and print one JSON line.

``BENCH_SF_DIR`` and ``BENCH_CPUS`` choose data and cores. Each query is built and run to
the end (every row produced, none kept): once to warm up, then ``BENCH_RUNS`` times (once
if it takes seconds), of which the best counts. ``plain_form`` holds, for comparison, the
same questions asked the straightforward way: a global window, a job per count, a join per
variable, Spark ML's own.
"""

from __future__ import annotations

import json
import os
import sys
import time
from pathlib import Path

from pyspark.ml.evaluation import BinaryClassificationEvaluator, ClusteringEvaluator
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Window
from pyspark.sql import functions as F

sys.path.insert(0, str(Path(__file__).resolve().parent))

from cohortry.operators import features, ranking  # noqa: E402
from cohortry.plans import registry, study  # noqa: E402
from cohortry.plans.registry import QUERIES  # noqa: E402
from cohortry.session import get_spark  # noqa: E402
from cohortry.sources import reference  # noqa: E402

HEADLINE = (
    "dedup_profiles", "code_violations", "risk_score", "prepared_table", "impute_train_median",
    "global_rank", "global_rank_buckets", "cumulative_positives", "gains_curve", "gains_curve_buckets",
    "top20_capture", "depth_to_60", "evaluation_record", "model_comparison", "subgroup_recall",
    "confusion_metrics", "threshold_sweep", "chi_square_scores", "scale_unit_std", "auc_exact",
    "silhouette", "scores_lr", "scores_dt", "scores_rf", "scores_gbt", "kmeans_screening",
)


def drain(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def plain_code_violations(spark, sf_dir):
    """A distinct and a join per variable."""
    df, labels = registry.known(spark, sf_dir), reference.code_labels(spark)
    for ours, theirs in study.STAND_IN.coded.items():
        observed = df.select(F.col(ours).alias("code")).dropna().distinct()
        observed.join(labels.where(F.col("variable") == theirs), "code", "left_anti").count()
        observed.sort("code").toPandas()


def plain_global_rank(spark, sf_dir):
    """One window over everything, ties left open."""
    df = registry.scored_by_bmi(spark, sf_dir).select("id", "bmi")
    drain(df.select("*", F.row_number().over(Window.orderBy(F.desc("bmi")))))


def plain_gains_curve(spark, sf_dir):
    """All rows to the driver in score order, running sums there."""
    df = registry.scored_by_points(spark, sf_dir).select("risk_points", "target")
    local = df.sort(F.desc("risk_points")).toPandas()
    share = local["target"].cumsum() / local["target"].sum()
    [share.iloc[int(len(local) * depth) - 1] for depth in ranking.GAINS_DEPTHS]


def count_outcomes(df, pred):
    """A job per confusion cell."""
    for cell in ("target = 1 and {} = 1", "target = 1 and {} = 0", "target = 0 and {} = 1", "target = 0 and {} = 0"):
        df.where(cell.format(pred)).count()


def plain_confusion_metrics(spark, sf_dir):
    count_outcomes(registry.with_points(spark, sf_dir), "risk_flag")


def plain_evaluation_record(spark, sf_dir):
    """A job per figure, two of them over a global window."""
    df = registry._given_scores(spark, sf_dir)
    BinaryClassificationEvaluator(labelCol="target", rawPredictionCol="weight_score").evaluate(df)
    drain(df.groupBy("target", "bmi_flag").count())
    count_outcomes(df, "bmi_flag")
    rows, positives = df.count(), df.where("target = 1").count()
    everything = Window.orderBy(F.desc("weight_score"))
    df.select("target", F.row_number().over(everything).alias("r")).where(f"r <= {0.2 * rows} and target = 1").count()
    running = F.sum("target").over(everything.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    ranked = df.select(F.row_number().over(everything).alias("r"), running.alias("c"))
    ranked.where(f"c >= {0.6 * positives}").agg(F.min("r")).first()


def plain_subgroup_recall(spark, sf_dir):
    """A grouped table per scored table, joined on the group."""
    df = registry._with_rules(registry.testing(registry.imputed(spark, sf_dir))).where("target = 1")
    first = df.groupBy("income").agg(F.count("*"), F.sum("risk_flag"), F.sum("bmi_flag"))
    drain(first.join(df.groupBy("income").agg(F.sum("health_flag")), "income", "left").sort("income"))


def plain_chi_square_scores(spark, sf_dir):
    """Spark ML's selector on the assembled vector."""
    df = registry.training(registry.imputed(spark, sf_dir))
    features.select_top(df, study.predictors(df, study.STAND_IN), "target", 12, mode="ml")


def plain_silhouette(spark, sf_dir):
    """Spark ML's evaluator."""
    df = registry.read_table(spark, f"{sf_dir}/embeddings.parquet")
    vectors = df.select(
        array_to_vector(F.col("embedding").cast("array<double>")).alias("v"), F.col("label").cast("double").alias("c")
    )
    ClusteringEvaluator(featuresCol="v", predictionCol="c").evaluate(vectors)


PLAIN = {
    "code_violations": plain_code_violations,
    "global_rank": plain_global_rank,
    "gains_curve": plain_gains_curve,
    "confusion_metrics": plain_confusion_metrics,
    "evaluation_record": plain_evaluation_record,
    "subgroup_recall": plain_subgroup_recall,
    "chi_square_scores": plain_chi_square_scores,
    "silhouette": plain_silhouette,
}


def best(run, runs: int) -> float:
    def once() -> float:
        start = time.perf_counter()
        run()
        return time.perf_counter() - start

    warm = once()
    return round(min(once() for _ in range(1 if warm > 8 else runs)), 3)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", str(os.cpu_count() or 4))
    runs = int(os.environ.get("BENCH_RUNS", "2"))
    spark = get_spark(f"local[{cpus}]", spark__sql__shuffle__partitions=cpus, spark__driver__memory="8g")
    spark.sparkContext.setLogLevel("ERROR")
    queries = {n: best(lambda n=n: drain(QUERIES[n](spark, sf_dir)), runs) for n in HEADLINE}
    plain = {n: best(lambda f=f: f(spark, sf_dir), runs) for n, f in PLAIN.items()}
    result = {
        "metric": "headline_queries_total",
        "value": round(sum(queries.values()), 3),
        "unit": "sec",
        "queries": queries,
        "plain_form": plain,
        "sf": Path(sf_dir).name.removeprefix("sf"),
    }
    print(json.dumps(result), flush=True)
    spark.stop()


if __name__ == "__main__":
    main()
