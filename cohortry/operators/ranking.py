"""Global ranking by score, and the figures read off a ranked contact list.

A ranking is a total order: score descending (NaN first, null last), then key ascending.
Below ``rows_per_task`` rows one window over the whole table is the fastest form. Above
it the order is cut by sampled splitters, which are pairs (score, key) in their own types:
Spark's range partitioner draws them. So a score held by a third of the rows is cut by key, and scores
that doubles can't tell apart are cut like any others. The sorted runs are written once;
a small table of their totals gives each its offset, and running sums go over one run at a time.

Figures (capture, depth, gains) need no ranked table: rows are counted by score, and only
rows of the scores at which an answer lies are ordered by key, cut in the same way.

Splitters decide balance only, never a result.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from contextlib import contextmanager
from dataclasses import dataclass, field

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, DateType, NumericType, StringType, TimestampNTZType, TimestampType

from cohortry.functions.expressions import is_positive, safe_ratio
from cohortry.sources.scratch import stored

# Up to this many rows one window is as fast as sorted runs (measured: level at 1 to 2 million).
ROWS_PER_TASK = 1_000_000
# Runs are cut finer than that, so that tasks balance.
RUNS_PER_TASK = 4
MAX_RUNS = 65_536
# Up to so many tasks sort the runs one by one; beyond that a task sorts several runs in a row.
LEAST_TASKS = 256

RANKABLE = (NumericType, BooleanType, StringType, DateType, TimestampType, TimestampNTZType)

RUN, PLACE = "_run", "_place"
UP_TO_PREVIOUS = (Window.unboundedPreceding, -1)
UP_TO_CURRENT = (Window.unboundedPreceding, Window.currentRow)


@dataclass(frozen=True)
class Population:
    """Rows and positives of a table, the two numbers every depth is measured against.

    ``scores`` is roughly the number of distinct scores, when that was asked for.
    """

    rows: int
    positives: int
    scores: int | None = None


def population(df: DataFrame, label: str, score: str | None = None) -> Population:
    distinct = F.approx_count_distinct(score) if score else F.lit(None)
    row = df.agg(F.count("*"), F.coalesce(F.sum(is_positive(label)), F.lit(0)), distinct).first()
    return Population(int(row[0]), int(row[1]), row[2])


def depth_contacts(rows: int, fraction: float, rounding: str) -> int:
    """Contacts at a depth: ``ceil`` for a capacity, ``floor`` for the gains curve."""
    return math.ceil(rows * fraction) if rounding == "ceil" else int(rows * fraction)


def require_rankable(df: DataFrame, *columns: str) -> None:
    for column in columns:
        kind = df.schema[column].dataType
        if not isinstance(kind, RANKABLE):
            raise ValueError(f"{column!r} can't be ranked: {kind.simpleString()}")


def _splits(strategy: str, rows: int, rows_per_task: int) -> bool:
    """Whether the order is cut into runs."""
    if strategy not in ("auto", "window", "buckets"):
        raise ValueError(f"unknown ranking strategy {strategy!r}")
    return strategy == "buckets" or (strategy == "auto" and rows > rows_per_task)


def _rank_order(score: str, key: str) -> list[Column]:
    return [F.col(score).desc_nulls_last(), F.col(key).asc()]


def running(
    rows: DataFrame, group: list[str], order: list[Column], sums: list[str], n: int | None, rows_per_task: int = ROWS_PER_TASK
) -> DataFrame:
    """Add ``place`` (rows before, in the group) and ``<name>_before`` for each column of ``sums``.

    ``order`` must be a total order within a group, whose columns must be known. With ``n``, the number of all
    rows, the order is cut into runs, however many rows a group has; without it a group's rows meet in one task.
    """
    if n is None:
        w = Window.partitionBy(*group).orderBy(*order)
        before = [F.coalesce(F.sum(c).over(w.rowsBetween(*UP_TO_PREVIOUS)), F.lit(0)).alias(f"{c}_before") for c in sums]
        return rows.select("*", (F.row_number().over(w) - 1).cast("bigint").alias("place"), *before)
    ordered = sorted_runs(rows, group, order, n, rows_per_task)
    totals = ordered.groupBy(*group, RUN).agg(F.min(PLACE).alias("_first"), F.count("*").alias("_size"), *[F.sum(c).alias(f"_sum_{c}") for c in sums])
    earlier = Window.partitionBy(*group).orderBy(RUN).rowsBetween(*UP_TO_PREVIOUS)
    offset = lambda c: F.coalesce(F.sum(c).over(earlier), F.lit(0))
    # As many rows as runs and groups: two runs share a group's row or more only where a group is cut.
    offsets = totals.select(*group, RUN, (offset("_size") - F.col("_first")).alias("_shift"), *[offset(f"_sum_{c}").alias(f"_sum_{c}") for c in sums])
    if not group:
        offsets = F.broadcast(offsets)  # one row per run, of which there are MAX_RUNS at most
    joined = ordered.join(offsets, [*group, RUN])
    w = Window.partitionBy(*group, RUN).orderBy(PLACE).rowsBetween(*UP_TO_PREVIOUS)
    before = [(F.coalesce(F.sum(c).over(w), F.lit(0)) + F.col(f"_sum_{c}")).alias(f"{c}_before") for c in sums]
    return joined.select(*rows.columns, (F.col(PLACE) + F.col("_shift")).alias("place"), *before)


def sorted_runs(rows: DataFrame, group: list[str], order: list[Column], n: int, rows_per_task: int = ROWS_PER_TASK) -> DataFrame:
    """The rows in stored sorted runs, with the number of the run and the place in it.

    Every task costs the driver a hundred sampled rows, a result and a file, so short runs of a long table are not
    sorted one by one: a task sorts a longer stretch, whose places are then cut into runs of the length asked for.
    """
    runs = max(2, math.ceil(n * RUNS_PER_TASK / rows_per_task))
    tasks = max(2, min(runs, MAX_RUNS // 2, max(LEAST_TASKS, math.ceil(n * RUNS_PER_TASK / ROWS_PER_TASK))))
    by = [*[F.col(g) for g in group], *order]
    ordered = rows.repartitionByRange(tasks, *by).sortWithinPartitions(*by)
    ordered = stored(ordered.withColumn("_at", F.monotonically_increasing_id()), "sorted-runs")
    # Ids hold the task above bit 33 and the place in it below. Where tasks are runs nothing else is cut; otherwise
    # the upper bits of the place number the task's runs, and all runs together stay within MAX_RUNS.
    bits = 33 if tasks == runs else math.ceil(math.log2(max(1, n / min(runs, max(1, MAX_RUNS - tasks)))))
    return ordered.select(*rows.columns, F.shiftright("_at", bits).alias(RUN), F.col("_at").bitwiseAND((1 << bits) - 1).alias(PLACE))


def global_rank(
    df: DataFrame,
    score: str,
    key: str,
    label: str | None = None,
    strategy: str = "auto",
    rows_per_task: int = ROWS_PER_TASK,
    rows: int | None = None,
) -> DataFrame:
    """Every row with its ``rank`` and, given a label, the running ``cum_positives``.

    ``key`` is a unique column without nulls, of numbers, strings, dates or timestamps. Pass ``rows`` when the row count is known already.
    """
    require_rankable(df, score, key)
    if strategy == "auto" and rows is None:
        rows = df.count()
    order = _rank_order(score, key)
    if not _splits(strategy, rows or 0, rows_per_task):
        w = Window.orderBy(*order)
        out = df.withColumn("rank", F.row_number().over(w).cast("bigint"))
        if label:
            out = out.withColumn("cum_positives", F.sum(is_positive(label)).over(w.rowsBetween(*UP_TO_CURRENT)))
        return out
    rows = df.count() if rows is None else rows
    marked = df.withColumn("_pos", is_positive(label)) if label else df
    out = running(marked, [], order, ["_pos"] if label else [], rows, rows_per_task)
    columns = [*df.columns, (F.col("place") + 1).alias("rank")]
    if label:
        columns.append((F.col("_pos_before") + F.col("_pos")).alias("cum_positives"))
    return out.select(*columns)


@dataclass(frozen=True)
class Answers:
    """For one model: positives among the first rows at each rank asked, and the first rank that captures each goal."""

    captured: list[int]
    reached: list[int | None]
    sums: dict[str, object] = field(default_factory=dict)


def answers(
    long: DataFrame, groups: DataFrame, ranks: list[int], goals: list[float], n: int | None,
    rows_per_task: int = ROWS_PER_TASK, sums: dict[str, Column] | None = None,
) -> dict[str, Answers]:
    """Per model what a ranking by score, then key, would say, without ranking the rows.

    ``long`` has ``model, score, key, pos`` and ``groups`` their running counts by score (``model, score, n, pos, n_before,
    pos_before``). Of ``long`` only rows of at most one score per model and question are ordered, by key;
    with ``n``, the rows of a model, they are cut into runs. ``sums`` are aggregates over ``groups`` to return as well.
    """
    sums = sums or {}
    at_rank = [(F.col("n_before") < k) & (F.col("n_before") + F.col("n") >= k) for k in ranks]
    at_goal = [(F.col("pos_before") < g) & (F.col("pos_before") + F.col("pos") >= g) for g in goals]
    asked = [c.alias(f"q{i}") for i, c in enumerate([*at_rank, *at_goal])]
    ends = groups.select("*", *asked).groupBy("model").agg(
        *[F.max_by(F.struct("score", "n_before", "pos_before", "n"), f"q{i}").alias(f"b{i}") for i in range(len(asked))],
        *[F.max(f"q{i}").alias(f"q{i}") for i in range(len(asked))],
        F.sum("n").alias("n"), F.sum("pos").alias("pos"), *[c.alias(f"sum_{name}") for name, c in sums.items()],
    )
    ends = {r["model"]: r for r in ends.collect()}
    # One boundary per model and question at most: its score's rows are numbered by key.
    bounds = [(f"{m}", i, *r[f"b{i}"]) for m, r in ends.items() for i in range(len(asked)) if r[f"q{i}"]]
    ordered = sum(b[-1] for b in bounds)
    found: dict[tuple[str, int], int] = {}
    if bounds:
        kind = long.schema["score"].dataType.simpleString()
        table = long.sparkSession.createDataFrame([b[:-1] for b in bounds], f"_model string, _question int, _score {kind}, _n bigint, _pos bigint")
        met = (F.col("model") == F.col("_model")) & F.col("score").eqNullSafe(F.col("_score"))
        rows = long.join(F.broadcast(table), met).select("_model", "_question", "_n", "_pos", "key", "pos")
        rows = running(rows, ["_model", "_question"], [F.col("key").asc()], ["pos"], None if n is None else ordered, rows_per_task)
        rank, cumulated = F.col("_n") + F.col("place") + 1, F.col("_pos") + F.col("pos_before") + F.col("pos")
        question = F.col("_question")
        each = [F.max(F.when((question == i) & (rank <= k), cumulated)) for i, k in enumerate(ranks)]
        each += [F.min(F.when((question == i) & (cumulated >= g), rank)) for i, g in enumerate(goals, len(ranks))]
        for r in rows.groupBy("_model").agg(*[c.alias(f"a{i}") for i, c in enumerate(each)]).collect():
            found |= {(r["_model"], i): r[f"a{i}"] for i in range(len(each)) if r[f"a{i}"] is not None}
    out = {}
    for m, r in ends.items():
        # A rank beyond the last row captures all, one before the first nothing; a goal of nothing is reached at once.
        captured = [found.get((m, i), r["pos"] if k > 0 else 0) for i, k in enumerate(ranks)]
        reached = [found.get((m, i), 1 if g <= 0 and r["n"] else None) for i, g in enumerate(goals, len(ranks))]
        out[m] = Answers([int(c) for c in captured], reached, {name: r[f"sum_{name}"] for name in sums})
    return out


@contextmanager
def _kept(df: DataFrame) -> Iterator[DataFrame]:
    df = df.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        yield df
    finally:
        df.unpersist()


def _read_off(df: DataFrame, score: str, key: str, label: str, ask, strategy: str, rows_per_task: int) -> tuple[Population, Answers]:
    """The population, and the answers at the ranks and goals that ``ask`` derives from it.

    The narrow table is computed once and kept while it is read.
    """
    require_rankable(df, score, key)
    with _kept(df.select(F.col(score).alias("score"), F.col(key).alias("key"), is_positive(label).alias("pos"))) as narrow:
        row = narrow.agg(F.count("*"), F.coalesce(F.sum("pos"), F.lit(0))).first()
        size = Population(int(row[0]), int(row[1]))
        ranks, goals = ask(size)
        if not _splits(strategy, size.rows, rows_per_task):
            w = Window.orderBy(*_rank_order("score", "key"))
            ranked = narrow.select(
                F.row_number().over(w).cast("bigint").alias("rank"), F.sum("pos").over(w.rowsBetween(*UP_TO_CURRENT)).alias("cum_positives")
            )
            row = ranked.agg(F.count("*"), *[captured_at(k) for k in ranks], *[contacts_to(g) for g in goals]).first()
            return size, Answers([int(x) for x in row[1 : 1 + len(ranks)]], list(row[1 + len(ranks) :]))
        long = narrow.select(F.lit("").alias("model"), "*")
        counted = stored(long.groupBy("model", "score").agg(F.count("*").alias("n"), F.sum("pos").alias("pos")), "score-groups")
        groups = running_groups(counted, counted.count(), strategy, rows_per_task)
        return size, answers(long, groups, ranks, goals, size.rows, rows_per_task).get("", Answers([0] * len(ranks), [None] * len(goals)))


def running_groups(counted: DataFrame, n: int, strategy: str, rows_per_task: int) -> DataFrame:
    """Stored counts by model and score, ``n`` rows, with the counts of all higher scores."""
    split = n if _splits(strategy, n, rows_per_task) else None
    return running(counted, ["model"], [F.col("score").desc_nulls_last()], ["n", "pos"], split, rows_per_task)


def captured_at(contacts: int) -> Column:
    """Positives among the first ``contacts`` ranks, as an aggregate over rank points."""
    return F.coalesce(F.max(F.when(F.col("rank") <= contacts, F.col("cum_positives"))), F.lit(0))


def contacts_to(captured: float) -> Column:
    """Smallest rank with that many positives, null if never, as an aggregate over rank points."""
    return F.min(F.when(F.col("cum_positives") >= captured, F.col("rank")))


def top_fraction_columns(contacts: Column, captured: Column, positives: int, fraction: float) -> list[Column]:
    rate = safe_ratio(captured, F.lit(positives), 0.0)
    return [
        contacts.cast("bigint").alias("contacts"),
        captured.alias("captured"),
        rate.alias("capture_rate"),
        (rate / F.lit(fraction)).alias("lift"),
        safe_ratio(contacts, captured).alias("contacts_per_case"),
    ]


def top_fraction(
    df: DataFrame,
    score: str,
    key: str,
    label: str,
    fraction: float = 0.20,
    ties: str = "key",
    strategy: str = "auto",
    rows_per_task: int = ROWS_PER_TASK,
) -> DataFrame:
    """Capture, lift and contacts per case at a capacity of ``ceil(rows * fraction)``.

    ``ties="key"`` breaks equal scores by key. ``ties="expected"`` gives the mean over all
    orders of equal scores: the last, partly contacted score counts in proportion.
    """
    if ties == "expected":
        size = population(df, label, score)
        contacts = depth_contacts(size.rows, fraction, "ceil")
        groups = score_groups(df, score, label, size, strategy, rows_per_task)
        share = F.least(F.greatest((F.lit(contacts) - F.col("n_before")) / F.col("n"), F.lit(0.0)), F.lit(1.0))
        totals = groups.agg(F.coalesce(F.sum(F.col("pos") * share), F.lit(0.0)).alias("captured"))
    elif ties == "key":
        size, found = _read_off(df, score, key, label, lambda p: ([depth_contacts(p.rows, fraction, "ceil")], []), strategy, rows_per_task)
        contacts = depth_contacts(size.rows, fraction, "ceil")
        totals = df.sparkSession.createDataFrame([(found.captured[0],)], "captured bigint")
    else:
        raise ValueError(f"unknown tie rule {ties!r}")
    return totals.select(*top_fraction_columns(F.lit(contacts), F.col("captured"), size.positives, fraction))


def depth_to_capture(
    df: DataFrame,
    score: str,
    key: str,
    label: str,
    target: float = 0.60,
    strategy: str = "auto",
    rows_per_task: int = ROWS_PER_TASK,
) -> DataFrame:
    """Contacts, and their share of all rows, until ``target`` of the positives are reached."""
    size, found = _read_off(df, score, key, label, lambda p: ([], [p.positives * target]), strategy, rows_per_task)
    one = df.sparkSession.createDataFrame([(found.reached[0],)], "contacts bigint")
    return one.select("contacts", safe_ratio(F.col("contacts"), F.lit(size.rows)).alias("depth"))


# Depths of the gains curve and cut-offs of the threshold sweep.
GAINS_DEPTHS = (0.05, 0.10, 0.15, 0.20, 0.25, 0.30, 0.40, 0.50)
SWEEP_THRESHOLDS = (0.3, 0.4, 0.5, 0.6)


def gains_curve(
    df: DataFrame,
    score: str,
    key: str,
    label: str,
    depths: tuple[float, ...] = GAINS_DEPTHS,
    strategy: str = "auto",
    rows_per_task: int = ROWS_PER_TASK,
) -> DataFrame:
    """Capture at each depth, with ``floor(rows * depth)`` contacts; one row per depth."""
    ranks = lambda p: [depth_contacts(p.rows, d, "floor") for d in depths]
    size, found = _read_off(df, score, key, label, lambda p: (ranks(p), []), strategy, rows_per_task)
    rows = [(float(d), k, c) for d, k, c in zip(depths, ranks(size), found.captured)]
    curve = df.sparkSession.createDataFrame(rows, "depth double, contacts bigint, captured bigint")
    return curve.select("*", safe_ratio(F.col("captured"), F.lit(size.positives)).alias("capture"))


def threshold_sweep(
    df: DataFrame, label: str, score: str, thresholds: tuple[float, ...] = SWEEP_THRESHOLDS
) -> DataFrame:
    """Recall, precision and contacts of ``score >= t`` per threshold: one pass, no expansion."""
    s, y = F.col(score), F.col(label)
    sums = []
    for i, t in enumerate(thresholds):
        sums += [
            F.count(F.when((s >= t) & (y == 1), 1)).alias(f"tp{i}"),
            F.count(F.when((s >= t) & (y == 0), 1)).alias(f"fp{i}"),
            F.count(F.when((s < t) & (y == 1), 1)).alias(f"fn{i}"),
        ]
    rows = []
    for i, t in enumerate(thresholds):
        tp, fp, fn = (F.col(f"{n}{i}") for n in ("tp", "fp", "fn"))
        rows.append(
            F.struct(
                F.lit(float(t)).alias("threshold"),
                safe_ratio(tp, tp + fn).alias("recall"),
                safe_ratio(tp, tp + fp).alias("precision"),
                (tp + fp).alias("contacted"),
            )
        )
    return df.agg(*sums).select(F.inline(F.array(*rows)))


def score_groups(
    df: DataFrame,
    score: str,
    label: str,
    size: Population,
    strategy: str = "auto",
    rows_per_task: int = ROWS_PER_TASK,
) -> DataFrame:
    """One row per distinct score: rows, positives, and both for all higher scores.

    Aggregating by score first makes ties harmless: a score shared by a third of the
    rows is one row here.
    """
    groups = df.groupBy(F.col(score).alias("score")).agg(
        F.count("*").alias("n"), F.sum(is_positive(label)).alias("pos")
    )
    distinct = size.rows if size.scores is None else min(size.rows, size.scores)
    n = None
    if _splits(strategy, distinct, rows_per_task):
        groups = stored(groups, "score-groups")
        n = groups.count()
    return running(groups, [], [F.col("score").desc_nulls_last()], ["n", "pos"], n, rows_per_task).drop("place")
