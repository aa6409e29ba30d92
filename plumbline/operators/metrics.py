"""Metrics of binary classifiers. Every metric is a grouped aggregate; `by` may hold a fold, a model, both or nothing."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plumbline.functions.numbers import ratio, rounded
from plumbline.operators.ranking import range_bucket, range_cuts, running_totals
from plumbline.operators.unpivot import long_form

METRICS = ["accuracy", "precision", "recall", "f1"]
CELLS = ["tn", "fp", "fn", "tp"]


def _cell(truth: int, guess: int, y: str, pred: str) -> Column:
    return F.count_if((F.col(y) == truth) & (F.col(pred) == guess))


def unscored_rows(df: DataFrame, y: str, pred: str) -> DataFrame:
    """The rows that no cell counts: a label or prediction that is missing or not 0 or 1."""
    known = F.coalesce(F.col(y).isin(0, 1) & F.col(pred).isin(0, 1), F.lit(False))
    return df.filter(~known)


def every_row_scored(df: DataFrame, y: str, pred: str) -> DataFrame:
    """df, whose job fails on the first row that no cell would count."""
    known = F.coalesce(F.col(y).isin(0, 1) & F.col(pred).isin(0, 1), F.lit(False))
    fault = F.raise_error(F.concat_ws(" ", F.lit("unscored row: label"), F.col(y), F.lit("prediction"), F.col(pred)))
    return df.withColumn(y, F.when(known, F.col(y)).otherwise(fault.cast(dict(df.dtypes)[y])))


def confusion_matrix(df: DataFrame, y: str, pred: str, by: list[str] = []) -> DataFrame:
    """The four cells and `[[tn, fp], [fn, tp]]`; empty cells are 0.

    Rows of `unscored_rows` are in no cell; pass `every_row_scored(df, ...)` to have them refused.
    """
    cells = df.groupBy(*by).agg(
        _cell(0, 0, y, pred).alias("tn"),
        _cell(0, 1, y, pred).alias("fp"),
        _cell(1, 0, y, pred).alias("fn"),
        _cell(1, 1, y, pred).alias("tp"),
    )
    return cells.withColumn("matrix", F.array(F.array("tn", "fp"), F.array("fn", "tp")))


def _scores() -> dict[str, Column]:
    tn, fp, fn, tp = (F.col(c) for c in CELLS)
    return {
        "accuracy": ratio(tp + tn, tp + tn + fp + fn),
        "precision": ratio(tp, tp + fp),
        "recall": ratio(tp, tp + fn),
        "f1": ratio(2 * tp, 2 * tp + fp + fn),
    }


def score_binary(df: DataFrame, y: str, pred: str, by: list[str] = []) -> DataFrame:
    """Accuracy, precision, recall and F1 (0 where the divisor is 0) with the confusion matrix."""
    return confusion_matrix(df, y, pred, by).withColumns(_scores())


def per_fold_metrics(df: DataFrame, y: str, pred: str, by: list[str] = ["fold"]) -> DataFrame:
    """`score_binary` per fold with the number of test rows and of positive ones, in one pass."""
    scored = score_binary(df, y, pred, by)
    tn, fp, fn, tp = (F.col(c) for c in CELLS)
    return scored.withColumns({"n_test": tn + fp + fn + tp, "n_positive_test": fn + tp})


def mean_std_over_folds(per_fold: DataFrame, metrics: list[str] = METRICS, by: list[str] = [], digits: int = 3):
    """Mean and population standard deviation of each metric over the folds, one row per metric."""
    rows = long_form(per_fold.select(*by, *metrics), by, metrics, "metric", "value")
    return rows.groupBy(*by, "metric").agg(
        rounded(F.avg("value"), digits).alias("mean"),
        rounded(F.stddev_pop("value"), digits).alias("std"),
        F.count("value").alias("n_folds"),
    )


def model_comparison(preds: DataFrame, y: str, pred: str, models: list[str], digits: int = 3) -> DataFrame:
    """Per metric the mean and deviation of every model over the same folds, side by side.

    `preds` is long: one row per model and id, with its fold.
    """
    per_fold = per_fold_metrics(preds, y, pred, ["model", "fold"])
    stats = mean_std_over_folds(per_fold, by=["model"], digits=digits)
    wide = stats.groupBy("metric").pivot("model", models)
    return wide.agg(F.max("mean").alias("mean"), F.max("std").alias("std"))


def pooled_confusion(preds: DataFrame, y: str, pred: str) -> DataFrame:
    """Confusion cells per model over all folds together."""
    return confusion_matrix(preds, y, pred, ["model"])


def _score_steps(df: DataFrame, y: str, p: str, by: list[str], more: dict[str, Column]) -> DataFrame:
    """Per distinct score the positives and negatives at it and all of them up to it, from the highest score down."""
    steps = df.groupBy(*by, p).agg(
        F.sum(F.col(y).cast("long")).alias("pos"),
        F.sum((1 - F.col(y)).cast("long")).alias("neg"),
        *(value.alias(name) for name, value in more.items()),
    )
    falling = steps.withColumn("_down", -F.col(p))
    cuts = range_cuts(df.select((-F.col(p)).alias("_down")), "_down")
    bucketed = range_bucket(falling, "_down", cuts)
    measures = {"pos_to": F.col("pos"), "neg_to": F.col("neg")}
    return running_totals(bucketed, by, F.col("_range"), len(cuts) + 2, [F.col("_down")], measures).drop("_range", "_down")


def _curve_sums(df: DataFrame, y: str, p: str, by: list[str], more: dict[str, Column] = {}) -> DataFrame:
    """Totals over the distinct scores from which every ranking metric follows; `more` are counts to carry along."""
    steps = _score_steps(df, y, p, by, more)
    # A positive outranks the negatives after it and ties with those at its own score.
    beaten = F.col("pos").cast("double") * (F.col("neg_to") - F.col("neg") / 2)
    at_recall = F.col("pos").cast("double") * F.col("pos_to") / (F.col("pos_to") + F.col("neg_to"))
    squares = F.col("pos") * F.pow(1 - F.col(p), 2) + F.col("neg") * F.pow(F.col(p), 2)
    return steps.groupBy(*by).agg(
        F.sum("pos").alias("n_pos"),
        F.sum("neg").alias("n_neg"),
        F.sum(beaten).alias("_losses"),
        F.sum(at_recall).alias("_precision_mass"),
        F.sum(squares).alias("_squares"),
        *(F.sum(name).alias(name) for name in more),
    )


def _auc() -> Column:
    pairs = F.col("n_pos").cast("double") * F.col("n_neg")
    return F.lit(1.0) - F.try_divide(F.col("_losses"), pairs)


def roc_auc(df: DataFrame, y: str, p: str, by: list[str] = []) -> DataFrame:
    """Area under the ROC curve, equal scores counted half; NULL if a class is missing."""
    return _curve_sums(df, y, p, by).select(*by, _auc().alias("roc_auc"))


def average_precision(df: DataFrame, y: str, p: str, by: list[str] = []) -> DataFrame:
    """Precision weighted by the recall it adds, one step per distinct score; not interpolated."""
    sums = _curve_sums(df, y, p, by)
    return sums.select(*by, ratio(F.col("_precision_mass"), F.col("n_pos")).alias("average_precision"))


def brier_score(df: DataFrame, y: str, p: str, by: list[str] = []) -> DataFrame:
    return df.groupBy(*by).agg(F.avg(F.pow(F.col(p) - F.col(y), 2)).alias("brier_score"))


def score_ranked(df: DataFrame, y: str, pred: str, p: str, by: list[str]) -> DataFrame:
    """The binary scores, ROC AUC, average precision and Brier score of every group in one row, without a join:
    the confusion cells and squared errors are counted per distinct score along with the classes."""
    cells = {name: _cell(truth, guess, y, pred) for name, (truth, guess) in zip(CELLS, [(0, 0), (0, 1), (1, 0), (1, 1)])}
    return _curve_sums(df, y, p, by, cells).select(
        *by,
        *(value.alias(name) for name, value in _scores().items()),
        _auc().alias("roc_auc"),
        ratio(F.col("_precision_mass"), F.col("n_pos")).alias("pr_auc"),
        (F.col("_squares") / (F.col("n_pos") + F.col("n_neg"))).alias("brier_score"),
    )


def group_rate(df: DataFrame, group: str, label: str, digits: int = 1) -> DataFrame:
    """Per group the labelled rows, the positives and their share in percent, with a total row (`group` NULL)."""
    return (
        df.rollup(group)
        .agg(F.count(label).alias("n"), F.sum(label).cast("long").alias("n_positive"))
        .withColumn("rate_pct", rounded(100 * ratio(F.col("n_positive"), F.col("n"), None), digits))
    )


def class_balance(df: DataFrame, label: str, part: str) -> DataFrame:
    """Rate of positives and negatives per positive, per part and overall (`part` NULL)."""
    y = F.col(label)
    return df.rollup(part).agg(
        F.count(y).alias("n"),
        F.avg(y).alias("positive_rate"),
        ratio(F.sum(1 - y), F.sum(y), None).alias("neg_pos_ratio"),
    )


def majority_class(train: DataFrame, label: str) -> DataFrame:
    """The most frequent class, the smaller label on a tie; one row."""
    counts = train.groupBy(label).agg(F.count(F.lit(1)).alias("n"))
    return counts.orderBy(F.desc("n"), F.asc(label)).limit(1)


def predict_majority(train: DataFrame, test: DataFrame, label: str) -> DataFrame:
    """The test rows with the majority class of the training rows as prediction and as certain probability."""
    top = majority_class(train, label).select(label).scalar()
    return test.withColumn("predicted_label", top).withColumn("p", F.col("predicted_label").cast("double"))


def length_histogram(df: DataFrame, text: str, bins: int = 40) -> DataFrame:
    """Rows per equal-width bin of text length; the largest length falls in the last bin."""
    lengths = df.select(F.length(text).alias("len")).filter(F.col("len").isNotNull())
    low = lengths.agg(F.min("len")).scalar()
    high = lengths.agg(F.max("len")).scalar()
    span = F.greatest(high - low, F.lit(1))
    at = F.least(F.floor((F.col("len") - low) * bins / span), F.lit(bins - 1)).cast("int")
    filled = lengths.groupBy(at.alias("bin")).agg(F.count(F.lit(1)).alias("n"))
    width = (high - low) / F.lit(float(bins))
    return filled.select("bin", (low + F.col("bin") * width).alias("bin_start"), "n")


def parse_failure_count(df: DataFrame, flag: str = "parse_failed", by: list[str] = []) -> DataFrame:
    return df.groupBy(*by).agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col(flag)).alias("n_parse_failures"))


def error_slice(df: DataFrame, truth: int, guess: int, n: int, width: int, key: str, y: str, pred: str, text: str):
    """The first `n` rows of one confusion cell in id order, with the text cut to `width` characters."""
    cell = df.filter((F.col(y) == truth) & (F.col(pred) == guess))
    return cell.withColumn(text, F.substring(text, 1, width)).orderBy(key).limit(n)
