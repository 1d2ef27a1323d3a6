"""Metrics over scored tables.

A scored table has one row per user with a label and a score.  Curves and
ranking metrics come from counts per distinct score accumulated in ranges (see
``functions.distribution``); ties between rows are broken by ``user_id``.  A
:class:`ScoreProfile` (totals and split points, one aggregate pass) can be
shared by several metrics of the same table.
"""

from __future__ import annotations

import math
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.distribution import (
    Profile,
    cumulative_by_value,
    exact_quantiles,
    profile,
    rank_rows,
)
from ..functions.numbers import ratio, ratio_or_zero

# Threshold grid, targeted share and calibration bins.
GRID_START, GRID_STEP, GRID_POINTS = 0.10, 0.005, 161
TOP_SHARE = 0.10
CALIBRATION_BINS = 10


@dataclass(frozen=True)
class ScoreProfile:
    """Totals and split points of one scored table."""

    table: Profile
    label: str
    score: str
    tie: str

    @property
    def rows(self) -> int:
        return self.table.rows

    @property
    def positives(self) -> int:
        return int(self.table.totals["positives"])


def profile_scores(
    df: DataFrame,
    label: str,
    score: str,
    tie: str = "user_id",
    rows_per_part: int | None = None,
) -> ScoreProfile:
    return ScoreProfile(
        profile(df, [score, tie], {"positives": F.col(label)}, rows_per_part), label, score, tie
    )


def _resolve(df, label, score, prof):
    return prof or profile_scores(df, label, score)


# Regression ------------------------------------------------------------------


def regression_metrics(df: DataFrame, actual: str, predictions: dict[str, str]) -> DataFrame:
    """(model, mae, rmse, r2) for several prediction columns in one aggregate.

    With a constant target R2 is 1 for perfect predictions and 0 otherwise.
    """
    y = F.col(actual)
    aggregates = [F.var_pop(y).alias("_spread")]
    for i, column in enumerate(predictions.values()):
        error = y - F.col(column)
        aggregates += [
            F.avg(F.abs(error)).alias(f"_mae{i}"),
            F.avg(error * error).alias(f"_mse{i}"),
        ]
    rows = []
    for i, name in enumerate(predictions):
        mse, spread = F.col(f"_mse{i}"), F.col("_spread")
        r2 = F.when(spread > 0, 1 - mse / spread).otherwise((mse == 0).cast("double"))
        rows.append(
            F.struct(
                F.lit(name).alias("model"),
                F.col(f"_mae{i}").alias("mae"),
                F.sqrt(mse).alias("rmse"),
                F.when(spread.isNotNull(), r2).alias("r2"),
            )
        )
    return df.agg(*aggregates).select(F.inline(F.array(*rows)))


def top_errors(df: DataFrame, actual: str, predicted: str, k: int = 15) -> DataFrame:
    """The ``k`` rows with the largest absolute error."""
    return (
        df.withColumn("absolute_error", F.abs(F.col(actual) - F.col(predicted)))
        .select("user_id", actual, predicted, "absolute_error")
        .orderBy(F.desc("absolute_error"), "user_id")
        .limit(k)
    )


# Classification at a threshold -------------------------------------------------


def _confusion_counts(df: DataFrame, label: str, predicted: Column) -> DataFrame:
    y, p = F.col(label) == 1, predicted
    return df.agg(
        F.count_if(y & p).alias("tp"),
        F.count_if(~y & p).alias("fp"),
        F.count_if(y & ~p).alias("fn"),
        F.count_if(~y & ~p).alias("tn"),
    )


def classification_metrics(df: DataFrame, label: str, score: str, threshold: float) -> DataFrame:
    """Accuracy, precision, recall and F1 at ``score >= threshold``; 0 on empty divisors."""
    tp, fp, fn, tn = (F.col(c) for c in ("tp", "fp", "fn", "tn"))
    return _confusion_counts(df, label, F.col(score) >= F.lit(float(threshold))).select(
        ratio(tp + tn, tp + tn + fp + fn).alias("accuracy"),
        ratio_or_zero(tp, tp + fp).alias("precision"),
        ratio_or_zero(tp, tp + fn).alias("recall"),
        ratio_or_zero(2 * tp, 2 * tp + fp + fn).alias("f1"),
    )


def confusion_matrix(df: DataFrame, label: str, predicted: str) -> DataFrame:
    """Rows per (label, predicted class), observed cells only."""
    return df.groupBy(
        F.col(label).cast("int").alias("label"), F.col(predicted).cast("int").alias("predicted")
    ).agg(F.count("*").alias("rows"))


def threshold_grid(df: DataFrame, label: str, score: str) -> DataFrame:
    """F1 at each of the 161 thresholds 0.10, 0.105, .. 0.90.

    Scores are counted per grid cell first; the running sums see 162 rows.
    """

    def point(index: Column) -> Column:
        return F.lit(GRID_START) + index * F.lit(GRID_STEP)

    s = F.col(score)
    guess = F.floor((s - GRID_START) / GRID_STEP)
    cell = F.when(point(guess + 1) <= s, guess + 1).when(point(guess) > s, guess - 1).otherwise(guess)
    cell = F.greatest(F.lit(-1), F.least(F.lit(GRID_POINTS - 1), cell))
    counts = df.groupBy(cell.cast("bigint").alias("cell")).agg(
        F.count("*").alias("n"), F.sum(label).alias("pos")
    )
    cells = df.sparkSession.range(-1, GRID_POINTS).withColumnRenamed("id", "cell")
    at_least = Window.orderBy(F.desc("cell")).rowsBetween(
        Window.unboundedPreceding, Window.currentRow
    )
    everything = Window.partitionBy()
    swept = cells.join(counts, "cell", "left").select(
        "cell",
        F.coalesce(F.sum("n").over(at_least), F.lit(0)).alias("flagged"),
        F.coalesce(F.sum("pos").over(at_least), F.lit(0)).alias("tp"),
        F.coalesce(F.sum("pos").over(everything), F.lit(0)).alias("positives"),
    )
    tp = F.col("tp")
    fp, fn = F.col("flagged") - tp, F.col("positives") - tp
    return swept.where(F.col("cell") >= 0).select(
        point(F.col("cell")).alias("threshold"),
        ratio_or_zero(2 * tp, 2 * tp + fp + fn).alias("f1"),
    )


def best_threshold(df: DataFrame, label: str, score: str) -> DataFrame:
    """Grid threshold with the highest F1; the lowest wins ties."""
    return threshold_grid(df, label, score).orderBy(F.desc("f1"), "threshold").limit(1)


# Ranking ---------------------------------------------------------------------


def score_steps(
    df: DataFrame, label: str, score: str, prof: ScoreProfile | None = None
) -> DataFrame:
    """Per distinct score, from the top: rows, positives and their running counts."""
    prof = _resolve(df, label, score, prof)
    return cumulative_by_value(
        df, score, {"n": F.lit(1), "pos": F.col(label)}, prof.table.cuts[score]
    )


def roc_curve(
    df: DataFrame, label: str, score: str, prof: ScoreProfile | None = None
) -> DataFrame:
    """(threshold, fpr, tpr) at every distinct score plus the origin (threshold NULL)."""
    prof = _resolve(df, label, score, prof)
    negatives = prof.rows - prof.positives
    steps = score_steps(df, label, score, prof)
    fp = F.col("cum_n") - F.col("cum_pos")
    points = steps.select(
        F.col(score).cast("double").alias("threshold"),
        ratio(fp, F.lit(negatives)).alias("fpr"),
        ratio(F.col("cum_pos"), F.lit(prof.positives)).alias("tpr"),
    )
    start = steps.sparkSession.range(1).select(
        F.lit(None).cast("double").alias("threshold"), F.lit(0.0).alias("fpr"), F.lit(0.0).alias("tpr")
    )
    return points.unionByName(start)


def pr_curve(df: DataFrame, label: str, score: str, prof: ScoreProfile | None = None) -> DataFrame:
    """(threshold, precision, recall) per distinct score plus the end point (NULL, 1, 0)."""
    prof = _resolve(df, label, score, prof)
    steps = score_steps(df, label, score, prof)
    points = steps.select(
        F.col(score).cast("double").alias("threshold"),
        ratio(F.col("cum_pos"), F.col("cum_n")).alias("precision"),
        ratio(F.col("cum_pos"), F.lit(prof.positives)).alias("recall"),
    )
    end = steps.sparkSession.range(1).select(
        F.lit(None).cast("double").alias("threshold"),
        F.lit(1.0).alias("precision"),
        F.lit(0.0).alias("recall"),
    )
    return points.unionByName(end)


def ranking_metrics(
    df: DataFrame, label: str, score: str, prof: ScoreProfile | None = None
) -> DataFrame:
    """One row: tie-aware ROC-AUC, step-wise average precision and its lift.

    All are NULL when a class is missing.  Trapezoids are summed as exact
    integers, so the area does not depend on the order of partitions.
    """
    prof = _resolve(df, label, score, prof)
    positives, negatives = prof.positives, prof.rows - prof.positives
    steps = score_steps(df, label, score, prof)
    pos, neg = F.col("pos"), F.col("n") - F.col("pos")
    whole = "decimal(19,0)"
    trapezoid = neg.cast(whole) * (2 * F.col("cum_pos") - pos).cast(whole)
    precision = F.col("cum_pos") / F.col("cum_n")
    area = F.sum(trapezoid).cast("double") / 2
    pairs = float(positives) * float(negatives)
    ap = F.sum(ratio(pos, F.lit(positives)) * precision)
    return steps.agg(
        F.try_divide(area, F.lit(pairs)).alias("roc_auc"),
        ap.alias("pr_auc"),
        F.try_divide(ap, F.try_divide(F.lit(float(positives)), F.lit(float(prof.rows)))).alias(
            "pr_auc_lift"
        ),
    )


def probability_metrics(df: DataFrame, label: str, score: str) -> DataFrame:
    """One row: Brier score, prevalence and the no-skill PR-AUC."""
    error = F.col(score) - F.col(label)
    prevalence = ratio(F.sum(label), F.count(label))
    return df.agg(
        F.avg(error * error).alias("brier_score"),
        prevalence.alias("prevalence"),
        prevalence.alias("no_skill_pr_auc"),
    )


def top_share_metrics(
    df: DataFrame, label: str, score: str, prof: ScoreProfile | None = None
) -> DataFrame:
    """Precision, recall and lift among the top 10 % of scores, at least one row.

    The counts per score tell where the cut falls; only the rows tied at that
    one score are put in order, by ``user_id``.
    """
    prof = _resolve(df, label, score, prof)
    k = max(1, math.ceil(prof.rows * TOP_SHARE))
    steps = score_steps(df, label, score, prof)
    last = F.max_by(F.struct(score, "n", "pos", "cum_n", "cum_pos"), "cum_n")
    cut = steps.where(F.col("cum_n") - F.col("n") < k).agg(last.alias("cut")).first()["cut"]
    found = 0
    if cut is not None:
        found = cut["cum_pos"] or 0
        if cut["cum_n"] > k:
            ties = cumulative_by_value(
                df.where(F.col(score).eqNullSafe(F.lit(cut[score]))),
                prof.tie,
                {"n": F.lit(1), "pos": F.col(label)},
                prof.table.cuts[prof.tie],
                descending=False,
            )
            inside = ties.where(F.col("cum_n") <= k - (cut["cum_n"] - cut["n"]))
            found += (inside.agg(F.sum("pos")).first()[0] or 0) - (cut["pos"] or 0)
    hits = F.lit(int(found))
    precision = ratio(hits, F.lit(min(k, prof.rows)))
    prevalence = F.try_divide(F.lit(float(prof.positives)), F.lit(float(prof.rows)))
    return df.sparkSession.range(1).select(
        precision.alias("precision_at_top_10pct"),
        ratio(hits, F.lit(max(1, prof.positives))).alias("recall_at_top_10pct"),
        F.try_divide(precision, prevalence).alias("lift_at_top_10pct"),
    )


def lift_curve(
    df: DataFrame, label: str, score: str, prof: ScoreProfile | None = None
) -> DataFrame:
    """Cumulative lift at every population share, best scores first."""
    prof = _resolve(df, label, score, prof)
    ranked = rank_rows(df.select(prof.tie, score, label), score, prof.tie, label, prof.table)
    prevalence = F.try_divide(F.lit(float(prof.positives)), F.lit(float(prof.rows)))
    return ranked.select(
        prof.tie,
        F.col("rank").cast("bigint").alias("rank"),
        (F.col("rank") / F.lit(float(prof.rows))).alias("population"),
        F.try_divide(ratio(F.col(f"cum_{label}"), F.col("rank")), prevalence).alias("lift"),
    )


def calibration_curve(
    df: DataFrame,
    label: str,
    score: str,
    bins: int = CALIBRATION_BINS,
    rows_per_part: int | None = None,
) -> DataFrame:
    """Mean score and observed rate per quantile bin, non-empty bins only.

    Inner edges are exact quantiles; a score equal to an edge belongs to the
    bin below it, so ties share a bin.
    """
    wanted = {f"q{i}": i / bins for i in range(1, bins)}
    edges = exact_quantiles(df, score, wanted, rows_per_part).first()
    s = F.col(score)
    slot = sum((s > F.lit(edges[q])).cast("int") for q in wanted)
    return df.groupBy(slot.alias("bin")).agg(
        F.avg(s).alias("mean_predicted"),
        ratio(F.sum(label), F.count("*")).alias("observed_rate"),
        F.count("*").alias("rows"),
    )


def classifier_report(
    df: DataFrame,
    label: str,
    score: str,
    thresholds: dict[str, float],
    prof: ScoreProfile | None = None,
) -> DataFrame:
    """All classifier metrics, one row per named threshold."""
    prof = _resolve(df, label, score, prof)
    at = [
        classification_metrics(df, label, score, t).select(
            F.lit(1).alias("_one"), F.lit(name).alias("cutoff"), F.lit(float(t)).alias("threshold"), "*"
        )
        for name, t in thresholds.items()
    ]
    report = reduce(DataFrame.unionByName, at)
    for piece in (
        ranking_metrics(df, label, score, prof),
        probability_metrics(df, label, score),
        top_share_metrics(df, label, score, prof),
    ):
        report = report.join(piece.withColumn("_one", F.lit(1)), "_one")
    return report.drop("_one")
