"""Ranking and threshold metrics over a scored frame, for any number of groups at once.

Scores are collapsed to one row per distinct (group, score) before anything is ordered, so ties
cost nothing, and running counts use bucketed windows (see `ranking`).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from peerledger import schemas as S
from peerledger.operators.ranking import BUCKET, GROUP, grouped, score_buckets, with_offsets

SUMMARISED = ("aucpr", "auroc", "f2", "tpr", "tnr", "precision")


def checked(df: DataFrame, label: str, score: str) -> DataFrame:
    """Fail on labels other than 0/1 and on missing scores instead of returning zeros."""
    fine = F.col(label).isin(0, 1) & F.col(score).isNotNull() & ~F.isnan(F.col(score))
    message = F.lit(f"{label} must be 0 or 1 and {score} a number")
    return df.withColumn(label, F.when(fine, F.col(label)).otherwise(F.raise_error(message).cast("int")))


def _positive(label: str) -> Column:
    return F.col(label).cast("bigint")


def _class_counts(label: str) -> list[Column]:
    pos = F.sum(_positive(label))
    return [pos.alias("pos"), (F.count("*") - pos).alias("neg")]


def tie_counts(df: DataFrame, label: str, score: str, by: Sequence[str] = ()) -> DataFrame:
    """Positives and negatives per distinct score."""
    clean = df.select(*by, label, F.col(score).cast("double").alias(score))
    return checked(clean, label, score).groupBy(*by, score).agg(*_class_counts(label))


def _cumulative(
    df: DataFrame, label: str, score: str, by: Sequence[str], buckets: int | None
) -> DataFrame:
    """Tie rows with `ctp`/`cfp`: positives and negatives scored at least this high."""
    clean = df.select(*by, label, F.col(score).cast("double").alias(score))
    ties = tie_counts(score_buckets(clean, score, buckets), label, score, [*by, BUCKET])
    totals = {"_pos_above": F.sum("pos"), "_neg_above": F.sum("neg")}
    placed = with_offsets(grouped(ties, by), totals, descending=True)
    down = (
        Window.partitionBy(GROUP, BUCKET)
        .orderBy(F.col(score).desc())
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    return placed.select(
        *by,
        score,
        "pos",
        "neg",
        (F.sum("pos").over(down) + F.col("_pos_above")).alias("ctp"),
        (F.sum("neg").over(down) + F.col("_neg_above")).alias("cfp"),
    )


def _or_zero(numerator: Column, denominator: Column) -> Column:
    ratio = F.try_divide(numerator.cast("double"), denominator.cast("double"))
    return F.coalesce(ratio, F.lit(0.0))


def _rank_sums() -> list[Column]:
    tp, ctp, cfp = (F.col(c).cast("double") for c in ("pos", "ctp", "cfp"))
    return [
        F.sum(tp * ctp / (ctp + cfp)).alias("_ap"),
        F.sum(F.col("neg").cast("double") * (ctp - tp / 2)).alias("_auc"),
        F.sum("pos").alias("_p"),
        F.sum("neg").alias("_n"),
    ]


def _rank_scores() -> dict[str, Column]:
    p, n = F.col("_p").cast("double"), F.col("_n").cast("double")
    return {"aucpr": _or_zero(F.col("_ap"), p), "auroc": _or_zero(F.col("_auc"), p * n)}


def _threshold_scores() -> dict[str, Column]:
    tp, fp, fn, tn = (F.col(c) for c in ("tp", "fp", "fn", "tn"))
    return {
        "f2": _or_zero(5 * tp, 5 * tp + 4 * fn + fp),
        "tpr": _or_zero(tp, tp + fn),
        "tnr": _or_zero(tn, tn + fp),
        "precision": _or_zero(tp, tp + fp),
    }


def ranking_metrics(
    df: DataFrame,
    label: str = "label",
    score: str = "score",
    by: Sequence[str] = (),
    buckets: int | None = None,
) -> DataFrame:
    """Average precision (step sum) and AUROC (ties count half) per group; 0.0 where undefined."""
    sums = _cumulative(df, label, score, by, buckets).groupBy(*by).agg(*_rank_sums())
    return sums.select(*by, *[c.alias(n) for n, c in _rank_scores().items()])


def confusion(
    df: DataFrame,
    threshold: float = S.DEFAULT_THRESHOLD,
    label: str = "label",
    score: str = "score",
    by: Sequence[str] = (),
) -> DataFrame:
    """tp, fp, tn, fn per group, counting score >= threshold as an alert."""
    alert, hit = F.col(score) >= F.lit(float(threshold)), F.col(label) == 1
    cells = {"tp": alert & hit, "fp": alert & ~hit, "tn": ~alert & ~hit, "fn": ~alert & hit}
    rows = checked(df.select(*by, label, score), label, score)
    return rows.groupBy(*by).agg(*[F.count_if(c).alias(n) for n, c in cells.items()])


def threshold_metrics(
    df: DataFrame,
    threshold: float = S.DEFAULT_THRESHOLD,
    label: str = "label",
    score: str = "score",
    by: Sequence[str] = (),
) -> DataFrame:
    """F2, recall, specificity and precision with the four counts; empty denominators give 0.0."""
    cells = confusion(df, threshold, label, score, by)
    scores = [c.alias(n) for n, c in _threshold_scores().items()]
    return cells.select(*by, *scores, F.lit(float(threshold)).alias("threshold"), "tp", "fp", "tn", "fn")


def fold_metrics(
    df: DataFrame,
    by: Sequence[str] = ("fold",),
    threshold: float = S.DEFAULT_THRESHOLD,
    label: str = "label",
    score: str = "score",
    buckets: int | None = None,
) -> DataFrame:
    """Ranking metrics, threshold metrics and class counts per group from one tie table."""
    alert = F.col(score) >= F.lit(float(threshold))
    zero = F.lit(0).cast("bigint")
    sums = (
        _cumulative(df, label, score, by, buckets)
        .groupBy(*by)
        .agg(
            *_rank_sums(),
            F.sum(F.when(alert, F.col("pos")).otherwise(zero)).alias("tp"),
            F.sum(F.when(alert, F.col("neg")).otherwise(zero)).alias("fp"),
        )
        .withColumns({"fn": F.col("_p") - F.col("tp"), "tn": F.col("_n") - F.col("fp")})
    )
    scores = _rank_scores() | _threshold_scores()
    total = F.col("_p") + F.col("_n")
    return sums.select(
        *by,
        *[c.alias(n) for n, c in scores.items()],
        F.lit(float(threshold)).alias("threshold"),
        F.col("_p").alias("fraud_count"),
        total.alias("total_count"),
        _or_zero(F.col("_p"), total).alias("fraud_ratio"),
    )


def cv_mean(per_fold: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Plain mean of each metric over the folds of a trial."""
    return per_fold.groupBy(*by).agg(*[F.avg(m).alias(m) for m in SUMMARISED])


def cv_summary(per_fold: DataFrame, by: Sequence[str] = (), fold: str = "fold") -> DataFrame:
    """Mean, population deviation and the per-fold list (in fold order) of each metric."""
    columns = []
    for m in SUMMARISED:
        in_order = F.array_sort(F.collect_list(F.struct(F.col(fold), F.col(m).alias("v"))))
        columns += [
            F.avg(m).alias(f"{m}_mean"),
            F.stddev_pop(m).alias(f"{m}_std"),
            F.transform(in_order, lambda s: s["v"]).alias(f"{m}_scores"),
        ]
    return per_fold.groupBy(*by).agg(*columns, F.count("*").alias("n_folds"))


def threshold_sweep(
    df: DataFrame,
    thresholds: Sequence[float],
    label: str = "label",
    score: str = "score",
    by: Sequence[str] = (),
) -> DataFrame:
    """Operating points: recall, precision, F1, F2, lift and alert volume for every threshold.

    Rows are first reduced to one row per (group, number of thresholds reached), so the data is
    read and shuffled once whatever the number of thresholds.
    """
    steps = sorted({float(t) for t in thresholds})
    if not steps:
        raise ValueError("no thresholds")
    reached = F.lit(0)
    for t in steps:
        reached = reached + (F.col(score) >= F.lit(t)).cast("int")
    rows = checked(df.select(*by, label, score), label, score).withColumn("_reached", reached)
    levels = rows.groupBy(*by, "_reached").agg(*_class_counts(label))

    def above(column: str, i: int) -> Column:
        return F.sum(F.when(F.col("_reached") > i, F.col(column)).otherwise(F.lit(0).cast("bigint")))

    points = [
        F.struct(F.lit(t).alias("threshold"), above("pos", i).alias("tp"), above("neg", i).alias("fp"))
        for i, t in enumerate(steps)
    ]
    wide = levels.groupBy(*by).agg(
        F.array(*points).alias("points"), F.sum("pos").alias("_p"), F.sum("neg").alias("_n")
    )
    cells = wide.select(*by, "_p", "_n", F.explode("points").alias("x")).select(
        *by,
        "x.*",
        "_p",
        "_n",
        (F.col("_p") - F.col("x.tp")).alias("fn"),
        (F.col("_n") - F.col("x.fp")).alias("tn"),
    )
    tp, fp, fn = F.col("tp"), F.col("fp"), F.col("fn")
    scores = _threshold_scores()
    base_rate = _or_zero(F.col("_p"), F.col("_p") + F.col("_n"))
    return cells.select(
        *by,
        "threshold",
        scores["tpr"].alias("recall"),
        scores["precision"].alias("precision"),
        scores["tnr"].alias("specificity"),
        _or_zero(2 * tp, 2 * tp + fp + fn).alias("f1"),
        scores["f2"].alias("f2"),
        _or_zero(scores["precision"], base_rate).alias("lift"),
        (tp + fp).alias("alerts"),
        "tp",
        "fp",
        "tn",
        "fn",
    )
