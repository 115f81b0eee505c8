"""Classification metrics, each from one aggregation over the scored table."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortry.functions.expressions import count_where, is_positive, safe_ratio
from cohortry.operators.ranking import (
    ROWS_PER_TASK,
    Answers,
    Population,
    answers,
    depth_contacts,
    population,
    require_rankable,
    running_groups,
    score_groups,
    top_fraction,
    top_fraction_columns,
)
from cohortry.sources.scratch import stored

CELLS = ("n_rows", "tp", "tn", "fp", "fn")
TOP = ("top_contacts", "top_captured", "top_capture", "top_lift", "top_contacts_per_case")


def confusion_table(df: DataFrame, label: str, pred: str) -> DataFrame:
    return df.groupBy(label, pred).agg(F.count("*").alias("n_rows"))


def _cells(label: str, pred: str) -> list[Column]:
    """Rows, and rows by outcome, in the order of ``CELLS``."""
    y, p = F.col(label), F.col(pred)
    outcomes = [(1, 1), (0, 0), (0, 1), (1, 0)]
    cells = [F.count("*")] + [count_where((y == actual) & (p == said)) for actual, said in outcomes]
    return [c.alias(n) for c, n in zip(cells, CELLS)]


def _rates() -> list[Column]:
    tp, tn, fp, fn = (F.col(c) for c in ("tp", "tn", "fp", "fn"))
    precision = safe_ratio(tp, tp + fp, 0.0)
    recall = safe_ratio(tp, tp + fn, 0.0)
    return [
        safe_ratio(tp + tn, tp + tn + fp + fn, 0.0).alias("accuracy"),
        precision.alias("precision"),
        recall.alias("recall"),
        safe_ratio(2 * precision * recall, precision + recall, 0.0).alias("f1"),
        (tp + tn + fp + fn == F.col("n_rows")).alias("reconciles"),
    ]


def confusion_metrics(df: DataFrame, label: str, pred: str) -> DataFrame:
    """Four cells and the rates from them; null predictions fall in no cell.

    ``reconciles`` says whether the cells add up to the rows.
    """
    return df.agg(*_cells(label, pred)).select("*", *_rates())


def check_confusion(metrics: DataFrame, name: str = "table") -> None:
    row = metrics.first()
    if not row["reconciles"]:
        cells = row["tp"] + row["tn"] + row["fp"] + row["fn"]
        raise ValueError(f"{name}: confusion cells add up to {cells}, not {row['n_rows']}")


def auc(
    df: DataFrame,
    label: str,
    score: str,
    size: Population | None = None,
    strategy: str = "auto",
    rows_per_task: int = ROWS_PER_TASK,
) -> DataFrame:
    """Exact area under the ROC curve, ties counted half; null when a class is absent."""
    size = size or population(df, label, score)
    groups = score_groups(df, score, label, size, strategy, rows_per_task)
    return groups.agg(_area(size.rows, size.positives).alias("auc"))


def _area(rows: int, positives: int) -> Column:
    """Area under the curve as an aggregate over running counts by score."""
    negatives = rows - positives
    neg = F.col("n") - F.col("pos")
    neg_above = F.col("n_before") - F.col("pos_before")
    beaten = F.col("pos") * (F.lit(float(negatives)) - neg_above - neg / 2)
    return safe_ratio(F.sum(beaten), F.lit(float(positives)) * F.lit(float(negatives)))


def baseline_metrics(
    df: DataFrame, label: str, flag: str, score: str | None = None, key: str | None = None,
    fraction: float = 0.20, ties: str = "key", strategy: str = "auto", rows_per_task: int = ROWS_PER_TASK,
) -> DataFrame:
    """A rule's flag as a classifier: cells, rates, flagged rows, flagged rows per true case.

    With ``score`` and ``key`` also the capture of the rule's points at a capacity.
    """
    by_flag = df.agg(*_cells(label, flag)).select("*", *_rates())
    flagged = F.col("tp") + F.col("fp")
    out = by_flag.select(
        "tp", "tn", "fp", "fn", "precision", "recall", "f1",
        flagged.alias("flagged"),
        safe_ratio(flagged, F.col("tp")).alias("flagged_per_case"),
    )
    if score is None:
        return out
    top = top_fraction(df, score, key, label, fraction, ties, strategy, rows_per_task)
    return _one_row([out, top.select("contacts", "captured", "capture_rate", "lift", "contacts_per_case")])


def _one_row(parts: list[DataFrame]) -> DataFrame:
    """Put one-row tables side by side: stack them, then keep the only value of each column."""
    columns = [c for part in parts for c in part.columns]
    return metrics_frame(parts).agg(*[F.max(c).alias(c) for c in columns])


def compare_models(
    df: DataFrame,
    models: dict[str, tuple[str, str]],
    label: str,
    key: str,
    fraction: float = 0.20,
    target: float = 0.60,
    strategy: str = "auto",
    rows_per_task: int = ROWS_PER_TASK,
) -> DataFrame:
    """One evaluation record per model, best AUC first.

    ``models`` maps a name to its (score, prediction) columns. A record holds AUC, confusion
    metrics, capture at a capacity and depth to a target. The table is read twice, however many models there are: once to
    count rows, positives and confusion cells by model and score, from which all but ties
    follows; once for the rows of the scores at which capacity and target lie, which are ordered by key.
    """
    require_rankable(df, key, *[score for score, _ in models.values()])
    kinds = {df.schema[score].dataType.simpleString() for score, _ in models.values()}
    score_of = lambda c: F.col(c) if len(kinds) == 1 else F.col(c).cast("double")
    sides = [F.struct(F.lit(m).alias("model"), score_of(s).alias("score"), F.col(p).cast("double").alias("said")) for m, (s, p) in models.items()]
    long = df.select(F.col(key).alias("key"), F.col(label).alias("y"), is_positive(label).alias("pos"), F.explode(F.array(*sides)).alias("m"))
    long = long.select("key", "y", "pos", "m.*")
    counted = long.groupBy("model", "score").agg(F.count("*").alias("n"), F.sum("pos").alias("pos"), *_cells("y", "said"))
    counted = stored(counted, "model-scores")
    totals = {
        r["model"]: r.asDict()
        for r in counted.groupBy("model").agg(*[F.sum(c).alias(c) for c in CELLS], F.sum("pos").alias("positives"), F.count("*").alias("scores")).collect()
    }
    none = dict.fromkeys([*CELLS, "positives", "scores"], 0)
    one = next(iter(totals.values()), none)
    rows, positives = int(one["n_rows"]), int(one["positives"])
    contacts, goal = depth_contacts(rows, fraction, "ceil"), positives * target
    groups = running_groups(counted, sum(t["scores"] for t in totals.values()), strategy, rows_per_task)
    split = strategy == "buckets" or (strategy == "auto" and rows > rows_per_task)
    found = answers(
        long.select("model", "score", "key", "pos"), groups, [contacts], [goal], rows if split else None, rows_per_task, {"auc": _area(rows, positives)}
    )
    nothing = Answers([0], [None], {"auc": None})
    record = [
        (m, found.get(m, nothing).sums["auc"], *[totals.get(m, none)[c] for c in CELLS], found.get(m, nothing).captured[0], found.get(m, nothing).reached[0])
        for m in models
    ]
    schema = f"model string, auc double, {', '.join(f'{c} bigint' for c in CELLS)}, captured bigint, contacts_to_target bigint"
    top = top_fraction_columns(F.lit(contacts), F.col("captured"), positives, fraction)
    depth = safe_ratio(F.col("contacts_to_target"), F.lit(rows)).alias("depth_to_target")
    record = df.sparkSession.createDataFrame(record, schema).select(
        "model", "auc", *CELLS, *_rates(), *[c.alias(n) for c, n in zip(top, TOP)], "contacts_to_target", depth
    )
    return record.orderBy(F.col("auc").desc_nulls_last(), "model")


def evaluate(df: DataFrame, model: str, label: str, score: str, pred: str, key: str, **options) -> DataFrame:
    """The evaluation record of one model; see ``compare_models``."""
    return compare_models(df, {model: (score, pred)}, label, key, **options)


def metrics_frame(records: list[DataFrame]) -> DataFrame:
    """Stack records; columns one of them lacks are null."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), records)


def subgroup_recall(
    df: DataFrame,
    group: str,
    label: str,
    rules: dict[str, str],
    baseline: str,
    overall: bool = False,
) -> DataFrame:
    """Recall of several rules per group, and each rule's difference to the baseline rule.

    All rules sit in one table, so one aggregation does it, without joining group tables;
    a null group stays a group. ``overall`` adds a row for all groups, marked in
    ``is_overall``. Groups without positives have null recalls.
    """
    positive = F.col(label) == 1
    sums = [count_where(positive).alias("actual_positive")]
    sums += [count_where(positive & (F.col(pred) == 1)).alias(f"{r}_tp") for r, pred in rules.items()]
    if overall:
        grouped = df.rollup(group).agg(F.grouping(group).cast("int").alias("is_overall"), *sums)
    else:
        grouped = df.groupBy(group).agg(*sums)
    recalls = [safe_ratio(F.col(f"{r}_tp"), F.col("actual_positive")).alias(f"{r}_recall") for r in rules]
    differences = [
        (F.col(f"{r}_recall") - F.col(f"{baseline}_recall")).alias(f"{r}_vs_{baseline}")
        for r in rules
        if r != baseline
    ]
    return grouped.select("*", *recalls).select("*", *differences)
