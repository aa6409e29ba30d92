import random

import pytest
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.sql import functions as F

from plumbline.operators import metrics


def pairs(spark, truth, guess):
    return spark.createDataFrame(list(zip(truth, guess)), "y int, pred int")


@pytest.mark.parametrize(
    "truth, guess, expected, matrix",
    [
        ([1, 0, 1, 0, 1], [1, 0, 1, 0, 1], (1.0, 1.0, 1.0, 1.0), [[2, 0], [0, 3]]),
        ([1, 1, 0, 0], [0, 0, 1, 1], (0.0, 0.0, 0.0, 0.0), [[0, 2], [2, 0]]),
        ([0, 0, 1, 1, 1], [0, 1, 0, 1, 1], (0.6, 2 / 3, 2 / 3, 2 / 3), [[1, 1], [1, 2]]),
        ([1, 1, 0, 0], [0, 0, 0, 0], (0.5, 0.0, 0.0, 0.0), [[2, 0], [2, 0]]),
    ],
)
def test_score_binary(spark, truth, guess, expected, matrix):
    row = metrics.score_binary(pairs(spark, truth, guess), "y", "pred").first()
    assert [row[m] for m in metrics.METRICS] == pytest.approx(list(expected))
    assert row["matrix"] == matrix


def from_cells(spark, tn, fp, fn, tp):
    cells = [(0, 0, tn), (0, 1, fp), (1, 0, fn), (1, 1, tp)]
    df = spark.createDataFrame(cells, "y int, pred int, n int")
    return df.select("y", "pred", F.explode(F.sequence(F.lit(1), "n")))


def test_published_account_scores_follow_from_their_matrix(spark):
    row = metrics.score_binary(from_cells(spark, 775, 260, 85, 289), "y", "pred").first()
    assert [round(row[m], 4) for m in metrics.METRICS] == [0.7551, 0.5264, 0.7727, 0.6262]


def test_mean_and_population_deviation_count_folds_without_hits(spark):
    df = spark.createDataFrame([(0, 1.0), (1, 0.0), (2, 0.5), (3, 0.5)], "fold int, f1 double")
    row = metrics.mean_std_over_folds(df, ["f1"]).first()
    assert (row["mean"], row["std"], row["n_folds"]) == (0.5, 0.354, 4)


def brute_auc(rows):
    positives = [p for y, p in rows if y]
    negatives = [p for y, p in rows if not y]
    wins = sum((a > b) + 0.5 * (a == b) for a in positives for b in negatives)
    return wins / (len(positives) * len(negatives))


def brute_ap(rows):
    total, found, result = sum(y for y, _ in rows), 0, 0.0
    seen = 0
    for score in sorted({p for _, p in rows}, reverse=True):
        at = [y for y, p in rows if p == score]
        found += sum(at)
        seen += len(at)
        result += sum(at) / total * (found / seen)
    return result


@pytest.mark.parametrize("levels, hot", [(7, 0.0), (5000, 0.0), (50, 0.4)])
def test_ranking_metrics_equal_brute_force(spark, levels, hot):
    """Few levels, many levels, and one score that holds 40 % of the rows."""
    rng = random.Random(levels)
    rows = [(int(rng.random() < 0.3), 0.5 if rng.random() < hot else rng.randrange(levels) / levels) for _ in range(800)]
    df = spark.createDataFrame(rows, "y int, p double").repartition(6)
    assert metrics.roc_auc(df, "y", "p").first()[0] == pytest.approx(brute_auc(rows))
    assert metrics.average_precision(df, "y", "p").first()[0] == pytest.approx(brute_ap(rows))
    evaluator = BinaryClassificationEvaluator(rawPredictionCol="p", labelCol="y", numBins=0)
    assert metrics.roc_auc(df, "y", "p").first()[0] == pytest.approx(evaluator.evaluate(df))


def test_auc_without_positives_is_null(spark):
    assert metrics.roc_auc(spark.createDataFrame([(0, 0.1), (0, 0.2)], "y int, p double"), "y", "p").first()[0] is None


def test_majority_class_takes_the_smaller_label_on_a_tie(spark):
    train = spark.createDataFrame([(1,), (0,)], "y int")
    assert metrics.predict_majority(train, train, "y").select("predicted_label").distinct().collect()[0][0] == 0


def test_group_rate_ignores_missing_labels_and_adds_a_total(spark):
    df = spark.createDataFrame([("a", 1), ("a", None), ("b", 0)], "product string, y int")
    rows = {r["product"]: (r["n"], r["n_positive"], r["rate_pct"]) for r in metrics.group_rate(df, "product", "y").collect()}
    assert rows == {"a": (1, 1, 100.0), "b": (1, 0, 0.0), None: (2, 1, 50.0)}


def test_histogram_puts_the_longest_text_in_the_last_bin(spark):
    df = spark.createDataFrame([("x" * n,) for n in range(1, 82)], "t string")
    bins = {r["bin"]: r["n"] for r in metrics.length_histogram(df, "t").collect()}
    assert sum(bins.values()) == 81 and max(bins) == 39 and bins[39] == 3
