import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.conftest import frame
from valuetide.functions.distribution import (
    cumulative_by_value,
    exact_quantiles,
    histogram,
    profile,
    rank_rows,
)
from valuetide.operators import evaluation as ev

SCORED = "user_id long, y int, p double"


def make(seed, n=300, hot=True, levels=60):
    """Scores with ties; a third of the rows may share one score."""
    rng = random.Random(seed)
    rows = []
    for i in rng.sample(range(10 * n), n):
        p = 0.5 if hot and rng.random() < 1 / 3 else rng.randrange(levels) / levels
        rows.append((i, int(rng.random() < 0.2 + 0.5 * p), p))
    return rows


def brute_auc(rows):
    pos = [p for _, y, p in rows if y]
    neg = [p for _, y, p in rows if not y]
    wins = sum((a > b) + 0.5 * (a == b) for a in pos for b in neg)
    return wins / (len(pos) * len(neg))


def brute_ap(rows):
    total, cum_n, cum_pos, ap = sum(y for _, y, _ in rows), 0, 0, 0.0
    for s in sorted({p for *_, p in rows}, reverse=True):
        hit = [y for _, y, p in rows if p == s]
        cum_n, cum_pos = cum_n + len(hit), cum_pos + sum(hit)
        ap += sum(hit) / total * cum_pos / cum_n
    return ap


# A low limit splits even small tables into many ranges.
PARTS = [1_000_000, 20]


@pytest.mark.parametrize("rows_per_part", PARTS)
@pytest.mark.parametrize("seed", [1, 2])
def test_ranking_metrics(spark, seed, rows_per_part):
    rows = make(seed)
    df = frame(spark, rows, SCORED)
    prof = ev.profile_scores(df, "y", "p", rows_per_part=rows_per_part)
    assert bool(prof.table.cuts["p"]) == (rows_per_part == 20)
    found = ev.ranking_metrics(df, "y", "p", prof).first()
    assert found["roc_auc"] == pytest.approx(brute_auc(rows), abs=1e-12)
    assert found["pr_auc"] == pytest.approx(brute_ap(rows), abs=1e-12)
    prevalence = sum(y for _, y, _ in rows) / len(rows)
    assert found["pr_auc_lift"] == pytest.approx(brute_ap(rows) / prevalence, abs=1e-12)


def test_average_precision_is_step_wise(spark):
    df = frame(spark, [(1, 1, 0.9), (2, 0, 0.8), (3, 1, 0.7)], SCORED)
    assert ev.ranking_metrics(df, "y", "p").first()["pr_auc"] == pytest.approx(5 / 6)


def test_one_class_gives_null(spark):
    df = frame(spark, [(1, 0, 0.9), (2, 0, 0.8)], SCORED)
    found = ev.ranking_metrics(df, "y", "p").first()
    assert tuple(found) == (None, None, None)
    assert ev.top_share_metrics(df, "y", "p").first()["lift_at_top_10pct"] is None


@pytest.mark.parametrize("rows_per_part", PARTS)
def test_ranks_break_ties_by_user(spark, rows_per_part):
    rows = make(3)
    df = frame(spark, rows, SCORED)
    prof = profile(df, ["p", "user_id"], rows_per_part=rows_per_part)
    found = rank_rows(df, "p", "user_id", "y", prof).collect()
    expected = sorted(rows, key=lambda r: (-r[2], r[0]))
    running = 0
    by_rank = {r["rank"]: r for r in found}
    assert len(by_rank) == len(rows)
    for i, (uid, y, _) in enumerate(expected, 1):
        running += y
        assert (by_rank[i]["user_id"], by_rank[i]["cum_y"]) == (uid, running)


def test_a_shared_score_is_split_by_user(spark):
    df = spark.range(2000).selectExpr("id AS user_id", "1 AS y", "0.5D AS p")
    prof = profile(df, ["p", "user_id"], rows_per_part=100)
    assert len(prof.cuts["user_id"]) >= 15
    ranked = rank_rows(df, "p", "user_id", "y", prof)
    assert ranked.where("rank != user_id + 1 OR cum_y != user_id + 1").count() == 0


@pytest.mark.parametrize("rows_per_part", PARTS)
@pytest.mark.parametrize("n", [1, 7, 10, 251])
def test_top_share_and_lift_curve(spark, n, rows_per_part):
    rows = make(n, n=n)
    df = frame(spark, rows, SCORED)
    prof = ev.profile_scores(df, "y", "p", rows_per_part=rows_per_part)
    order = sorted(rows, key=lambda r: (-r[2], r[0]))
    k = max(1, math.ceil(n * 0.10))
    hits, total = sum(y for _, y, _ in order[:k]), sum(y for _, y, _ in rows)
    found = ev.top_share_metrics(df, "y", "p", prof).first()
    assert found["precision_at_top_10pct"] == pytest.approx(hits / k)
    assert found["recall_at_top_10pct"] == pytest.approx(hits / max(1, total))
    curve = ev.lift_curve(df, "y", "p", prof).orderBy("rank").collect()
    assert [r["population"] for r in curve] == pytest.approx([i / n for i in range(1, n + 1)])
    if total:
        assert curve[-1]["lift"] == pytest.approx(1.0)


def test_curves_end_points(spark):
    rows = make(5)
    df = frame(spark, rows, SCORED)
    roc = ev.roc_curve(df, "y", "p").orderBy("fpr", "tpr").collect()
    assert (roc[0]["fpr"], roc[0]["tpr"], roc[0]["threshold"]) == (0.0, 0.0, None)
    assert (roc[-1]["fpr"], roc[-1]["tpr"]) == (1.0, 1.0)
    x, y = [r["fpr"] for r in roc], [r["tpr"] for r in roc]
    assert np.trapezoid(y, x) == pytest.approx(brute_auc(rows))
    pr = ev.pr_curve(df, "y", "p")
    assert pr.count() == len({p for *_, p in rows}) + 1
    assert pr.where("threshold IS NULL").first()["precision"] == 1.0


def test_threshold_grid_against_brute_force(spark):
    # 0.1 + i * 0.005 itself, so that "at least" is exercised on grid points.
    points = [0.1 + i * 0.005 for i in range(161)]
    rng = random.Random(9)
    rows = [(i, rng.randrange(2), rng.choice([*points, 0.0, 0.05, 0.95, 1.0])) for i in range(500)]
    df = frame(spark, rows, SCORED)
    grid = ev.threshold_grid(df, "y", "p").orderBy("threshold").collect()
    assert [g["threshold"] for g in grid] == points

    def f1(t):
        tp = sum(y for _, y, p in rows if p >= t)
        fp = sum(1 - y for _, y, p in rows if p >= t)
        fn = sum(y for _, y, p in rows if p < t)
        return 2 * tp / (2 * tp + fp + fn) if tp + fp + fn else 0.0

    scores = [f1(t) for t in points]
    assert [g["f1"] for g in grid] == scores
    best = ev.best_threshold(df, "y", "p").first()
    assert best["threshold"] == points[int(np.argmax(scores))]


def test_lowest_threshold_wins_ties(spark):
    df = frame(spark, [(1, 1, 0.95), (2, 0, 0.02)], SCORED)
    assert ev.best_threshold(df, "y", "p").first()["threshold"] == 0.1


def test_classification_and_probability_metrics(spark):
    df = frame(spark, [(1, 1, 0.9), (2, 0, 0.6), (3, 1, 0.4), (4, 0, 0.1)], SCORED)
    found = ev.classification_metrics(df, "y", "p", 0.6).first()
    assert tuple(found) == (0.5, 0.5, 0.5, 0.5)
    nobody = ev.classification_metrics(df, "y", "p", 2.0).first()
    assert (nobody["precision"], nobody["recall"], nobody["f1"]) == (0.0, 0.0, 0.0)
    brier = ev.probability_metrics(df, "y", "p").first()
    assert brier["brier_score"] == pytest.approx((0.01 + 0.36 + 0.36 + 0.01) / 4)
    assert brier["prevalence"] == brier["no_skill_pr_auc"] == 0.5


def test_report_has_one_row_per_threshold(spark):
    df = frame(spark, make(4), SCORED)
    report = ev.classifier_report(df, "y", "p", {"selected": 0.3, "fixed_0_5": 0.5}).collect()
    assert {(r["cutoff"], r["threshold"]) for r in report} == {("selected", 0.3), ("fixed_0_5", 0.5)}
    assert len({r["roc_auc"] for r in report}) == 1


@pytest.mark.parametrize("rows_per_part", PARTS)
def test_calibration_bins(spark, rows_per_part):
    rows = make(6)
    p = np.array([r[2] for r in rows])
    edges = np.percentile(p, np.linspace(0, 1, 11) * 100)
    slots = np.searchsorted(edges[1:-1], p)
    df = frame(spark, rows, SCORED)
    found = ev.calibration_curve(df, "y", "p", rows_per_part=rows_per_part).orderBy("bin").collect()
    assert [r["bin"] for r in found] == sorted(set(slots))
    for r in found:
        mine = slots == r["bin"]
        assert r["rows"] == mine.sum()
        assert r["mean_predicted"] == pytest.approx(p[mine].mean())
        assert r["observed_rate"] == pytest.approx(np.array([x[1] for x in rows])[mine].mean())


def test_regression_metrics(spark):
    df = frame(spark, [(1, 3.0, 2.0), (2, 5.0, 5.0), (3, 1.0, 4.0)], "user_id long, a double, p double")
    df = df.withColumn("zero", F.lit(0.0))
    found = {r["model"]: r for r in ev.regression_metrics(df, "a", {"m": "p", "z": "zero"}).collect()}
    assert found["m"]["mae"] == pytest.approx(4 / 3)
    assert found["m"]["rmse"] == pytest.approx(math.sqrt(10 / 3))
    assert found["m"]["r2"] == pytest.approx(1 - 10 / 8)
    flat = df.withColumn("a", F.lit(2.0))
    assert ev.regression_metrics(flat, "a", {"z": "zero"}).first()["r2"] == 0.0
    assert ev.regression_metrics(flat, "a", {"a": "a"}).first()["r2"] == 1.0


def test_top_errors(spark):
    df = frame(spark, [(i, 0.0, float(i)) for i in range(40)], "user_id long, a double, p double")
    assert [r["user_id"] for r in ev.top_errors(df, "a", "p").collect()] == list(range(39, 24, -1))


@pytest.mark.parametrize("rows_per_part", PARTS)
@pytest.mark.parametrize("n", [1, 2, 5, 333])
def test_quantiles_match_numpy(spark, n, rows_per_part):
    rng = random.Random(n)
    values = [float(rng.randrange(50)) for _ in range(n)]
    df = frame(spark, [(v,) for v in values] + [(None,)], "v double")
    wanted = {"a": 0.0, "b": 0.25, "c": 0.5, "d": 0.75, "e": 0.99, "f": 1.0}
    row = exact_quantiles(df, "v", wanted, rows_per_part).first()
    assert list(row) == pytest.approx(list(np.quantile(values, list(wanted.values()))))


def test_quantile_of_nothing_is_null(spark):
    assert exact_quantiles(frame(spark, [], "v double"), "v", {"m": 0.5}).first()["m"] is None


def test_cumulative_counts_do_not_depend_on_parts(spark):
    df = frame(spark, make(8), SCORED)
    cuts = profile(df, ["p"], rows_per_part=10).cuts["p"]
    args = ("p", {"n": F.lit(1), "pos": F.col("y")})
    assert sorted(cumulative_by_value(df, *args, cuts).collect()) == sorted(
        cumulative_by_value(df, *args, []).collect()
    )


def test_histogram_keeps_empty_bins_and_the_top_edge(spark):
    df = frame(spark, [(0.0,), (1.0,), (10.0,), (None,)], "v double")
    found = [r["rows"] for r in histogram(df, "v", 5).orderBy("bin").collect()]
    assert found == [2, 0, 0, 0, 1]
    flat = histogram(frame(spark, [(3.0,)], "v double"), "v", 4).orderBy("bin").collect()
    assert (flat[0]["left_edge"], flat[-1]["right_edge"]) == (2.5, 3.5)
    assert sum(r["rows"] for r in flat) == 1


def test_default_settings_cross_ranges(spark):
    df = spark.range(20_000).selectExpr("id AS user_id", "(id * 7919 % 20000) / 20000.0D AS p", "CAST(id % 3 = 0 AS INT) AS y")
    prof = ev.profile_scores(df, "y", "p")
    assert len(prof.table.cuts["p"]) >= 3
    steps = ev.score_steps(df, "y", "p", prof)
    assert steps.agg({"cum_n": "max"}).first()[0] == 20_000
    assert exact_quantiles(df, "p", {"m": 0.5}).first()["m"] == pytest.approx(9999.5 / 20000)


def test_quantiles_with_infinite_values(spark):
    df = spark.range(400).selectExpr("IF(id % 2 = 0, CAST('Infinity' AS DOUBLE), CAST(id AS DOUBLE)) AS v")
    row = exact_quantiles(df, "v", {"low": 0.25, "high": 0.9}, 20).first()
    assert row["low"] == pytest.approx(np.quantile([i for i in range(400) if i % 2] + [1e9] * 200, 0.25))
    assert row["high"] == float("inf")


def test_top_share_with_one_score_for_all(spark):
    df = spark.range(1000).selectExpr("id AS user_id", "0.5D AS p", "CAST(id < 60 AS INT) AS y")
    row = ev.top_share_metrics(df, "y", "p").first()
    assert row["precision_at_top_10pct"] == pytest.approx(0.6)
