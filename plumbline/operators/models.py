"""Classical baselines: balanced logistic regression on text, boosted trees on account tables, a phrase rule."""

from __future__ import annotations

import re
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from functools import reduce
from typing import TypeVar

from pyspark import inheritable_thread_target
from pyspark.ml import PipelineModel
from pyspark.ml.classification import (
    GBTClassificationModel,
    GBTClassifier,
    LogisticRegression,
    LogisticRegressionModel,
)
from pyspark.ml.feature import CountVectorizerModel, StringIndexer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from plumbline.functions.numbers import flag_to_int, number_or_zero, rounded
from plumbline.operators.features import (
    english_stop_words,
    ngram_vocabulary,
    part_term_counts,
    sliced_vectorizer,
    vectorizer,
    with_terms,
)
from plumbline.operators.metrics import predict_majority, score_ranked
from plumbline.operators.sampling import stratified_kfold
from plumbline.storage import checkpointed, name_checkpoints

Result = TypeVar("Result")

#: Training rows per partition, least and most. A fit is a long series of jobs over cached rows; many parts only add scheduling.
TRAIN_ROWS = 25_000
MOST_TRAIN_ROWS = 500_000
#: Texts in a partition of a fit, least and most, and the fits on texts that run side by side: each holds its vectors in memory.
TRAIN_TEXTS = 1_000
MOST_TRAIN_TEXTS = 50_000
TEXT_FITS = 2


def for_each_fold(spark: SparkSession, k: int, fit: Callable[[int], Result], beside: int | None = None) -> list[Result]:
    """Results of `fit` for the folds 0..k-1. The fits do not depend on each other, so their jobs run side by side, `beside` at a time."""
    with ThreadPoolExecutor(max_workers=beside or k) as pool:
        return list(pool.map(inheritable_thread_target(spark)(fit), range(k)))


@dataclass(frozen=True)
class TextParams:
    """Settings of the text baseline."""

    max_features: int = 5000
    min_df: int = 2
    longest: int = 2
    max_iter: int = 1000
    c: float = 1.0
    tol: float = 1e-5  # leaves every component of the mean loss gradient below 1e-4
    stop_words: tuple[str, ...] | None = None

    def stop_list(self) -> list[str]:
        return list(self.stop_words) if self.stop_words is not None else english_stop_words()


def balanced_weights(df: DataFrame, label: str) -> DataFrame:
    """Row weight n / (2 n_class), so both classes weigh the same."""
    totals = df.agg(F.struct(F.count(label).alias("n"), F.sum(label).alias("n1"))).scalar()
    staged = df.withColumn("_totals", totals)
    of_class = F.when(F.col(label) == 1, F.col("_totals.n1")).otherwise(F.col("_totals.n") - F.col("_totals.n1"))
    return staged.withColumn("weight", F.col("_totals.n") / (2.0 * of_class)).drop("_totals")


def fit_balanced_lr(df: DataFrame, label: str, n_rows: int, params: TextParams, features: str = "features") -> LogisticRegressionModel:
    """L2 logistic regression. Spark averages the loss over the weights, which sum to n, hence 1 / (C n)."""
    estimator = LogisticRegression(
        featuresCol=features,
        labelCol=label,
        weightCol="weight",
        regParam=1.0 / (params.c * n_rows),
        elasticNetParam=0.0,
        standardization=False,
        maxIter=params.max_iter,
        tol=params.tol,
    )
    return estimator.fit(balanced_weights(df, label))


def fold_vocabularies(df: DataFrame, folds: str, k: int, params: TextParams) -> DataFrame:
    """`(held_out, term, tf, df)`: the vocabulary of each training part, from one count over all folds.

    A term is counted once, in all and in each fold; a training part's counts are the totals minus its own fold's. Most
    terms are in fewer than `min_df` texts of all, and so of any part; they go before there is a row for each part.
    """
    cells = part_term_counts(df, folds, k).filter(F.col("df") >= params.min_df)
    parts = (
        F.struct(
            F.lit(i).alias("held_out"),
            (F.col("tf") - F.col(f"tf_{i}")).alias("tf"),
            (F.col("df") - F.col(f"df_{i}")).alias("df"),
        )
        for i in range(k)
    )
    each = cells.select("term", F.explode(F.array(*parts)).alias("_part")).select("_part.held_out", "term", "_part.tf", "_part.df")
    return each.filter(F.col("df") >= params.min_df)


def fit_text_model(train: DataFrame, vocabulary: DataFrame, label: str, params: TextParams) -> tuple[PipelineModel, LogisticRegressionModel, list[str]]:
    """Vectorizer and classifier of one training part; `train` has `terms`."""
    n_rows = train.count()
    transform, names = vectorizer(vocabulary, n_rows)
    vectors = transform.transform(train).select(label, "features").persist()
    try:
        model = fit_balanced_lr(vectors, label, n_rows, params)
    finally:
        vectors.unpersist()
    return transform, model, names


def cross_val_predict(df: DataFrame, key: str, label: str, text: str, k: int = 5, params: TextParams = TextParams()) -> DataFrame:
    """Out-of-fold prediction of every row: `(key, label, fold, predicted_label, p)`.

    Vocabulary, weights and model are fitted anew on each training part. The loop runs over the k folds only; all
    work inside is distributed. Texts are cut into terms twice, for the vocabularies and for the counts of their terms (at
    most `k * max_features`): those are held, once for all folds, and not the terms, which are larger than the texts.
    """
    spark = df.sparkSession
    folds = checkpointed(stratified_kfold(df, key, label, k))
    # The texts are joined to their folds before they are cut into terms: a text is smaller than its n-grams.
    texts = folds.join(df.select(key, text), key)
    terms = with_terms(texts, text, params.stop_list(), params.longest).select(key, label, "fold", "terms")
    counted = fold_vocabularies(terms, "fold", k, params).persist()

    def vocabulary(fold: int) -> DataFrame:
        own = counted.filter(F.col("held_out") == fold)
        return checkpointed(own.orderBy(F.desc("tf"), F.asc("term")).limit(params.max_features))

    try:
        counted.count()
        vocabularies = for_each_fold(spark, k, vocabulary)
    finally:
        counted.unpersist()
    every = sorted({row["term"] for one in vocabularies for row in one.select("term").collect()})
    counts = CountVectorizerModel.from_vocabulary(every, inputCol="terms", outputCol="counts")
    rows = counts.transform(terms).select(key, label, "fold", "counts").persist()

    def out_of_fold(fold: int) -> DataFrame:
        n_rows = sum(n for other, n in sizes.items() if other != fold)
        transform = sliced_vectorizer(every, vocabularies[fold], n_rows)
        train = transform.transform(rows.filter(F.col("fold") != fold)).select(label, "features")
        # An iteration is a job over all rows, which the fit holds as blocks; a small task costs more than its rows.
        parts = max(1, min(-(-n_rows // TRAIN_TEXTS), 2 * spark.sparkContext.defaultParallelism), -(-n_rows // MOST_TRAIN_TEXTS))
        model = fit_balanced_lr(train.coalesce(parts), label, n_rows, params)
        scored = model.transform(transform.transform(rows.filter(F.col("fold") == fold)))
        return scored.select(
            key,
            label,
            "fold",
            F.col("prediction").cast("int").alias("predicted_label"),
            vector_to_array("probability")[1].alias("p"),
        )

    try:
        sizes = {row["fold"]: row["count"] for row in rows.groupBy("fold").count().collect()}
        return checkpointed(reduce(DataFrame.unionByName, for_each_fold(spark, k, out_of_fold, TEXT_FITS)))
    finally:
        rows.unpersist()


def top_terms(df: DataFrame, label: str, text: str, n: int = 10, params: TextParams = TextParams()) -> DataFrame:
    """The terms with the largest coefficients of a fit on all rows, for reading only."""
    spark = df.sparkSession
    terms = with_terms(df.select(label, text), text, params.stop_list(), params.longest).select(label, "terms").persist()
    try:
        vocabulary = ngram_vocabulary(terms, params.min_df, params.max_features)
        _, model, names = fit_text_model(terms, vocabulary, label, params)
    finally:
        terms.unpersist()
    pairs = list(zip(names, model.coefficients.toArray().tolist()))  # at most max_features
    table = spark.createDataFrame(pairs, "term string, coef double")
    return table.orderBy(F.desc("coef"), F.asc("term")).limit(n).withColumn("coef", rounded(F.col("coef"), 3))


@dataclass(frozen=True)
class AccountColumns:
    """Roles of the columns of an account table."""

    key: str
    label: str
    categorical: tuple[str, ...]
    boolean: tuple[str, ...]
    numeric: tuple[str, ...]
    text_numbers: tuple[str, ...]

    def features(self) -> list[str]:
        return [*self.numeric, *self.text_numbers, *self.boolean, *(f"{c}_index" for c in self.categorical)]


# The roles of the columns of the published account table.
CHURN_ACCOUNTS = AccountColumns(
    key="customerID",
    label="Churn",
    categorical=(
        "gender",
        "MultipleLines",
        "InternetService",
        "OnlineSecurity",
        "OnlineBackup",
        "DeviceProtection",
        "TechSupport",
        "StreamingTV",
        "StreamingMovies",
        "Contract",
        "PaymentMethod",
    ),
    boolean=("SeniorCitizen", "Partner", "Dependents", "PhoneService", "PaperlessBilling"),
    numeric=("tenure", "MonthlyCharges"),
    text_numbers=("TotalCharges",),
)


def clean_accounts(df: DataFrame, roles: AccountColumns) -> DataFrame:
    """Text numbers with 0 for blanks, flags and the label as 0/1; everything else unchanged."""
    numbers = {c: number_or_zero(F.col(c)) for c in roles.text_numbers}
    flags = {c: flag_to_int(F.col(c)) for c in (*roles.boolean, roles.label)}
    return df.withColumns({**numbers, **flags})


def coercion_report(df: DataFrame, column: str, tenure: str) -> DataFrame:
    """How many texts are no number, and how many of those belong to accounts without any tenure."""
    bad = F.col(column).try_cast("double").isNull()
    return df.agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.count_if(bad).alias("n_coerced"),
        F.count_if(bad & (F.col(tenure) == 0)).alias("n_coerced_without_tenure"),
        F.sum(number_or_zero(F.col(column))).alias("total"),
    )


def encode_categorical(df: DataFrame, columns: tuple[str, ...]) -> DataFrame:
    """Nominal codes in `<column>_index`, most frequent first; unseen values get a code of their own."""
    outputs = [f"{c}_index" for c in columns]
    indexer = StringIndexer(
        inputCols=list(columns), outputCols=outputs, handleInvalid="keep", stringOrderType="frequencyDesc"
    )
    return indexer.fit(df).transform(df)


def assemble(df: DataFrame, roles: AccountColumns) -> DataFrame:
    """Cleaned accounts with one feature vector that keeps the nominal marks."""
    encoded = encode_categorical(clean_accounts(df, roles), roles.categorical)
    assembler = VectorAssembler(inputCols=roles.features(), outputCol="features", handleInvalid="keep")
    return assembler.transform(encoded).select(roles.key, roles.label, "features")


@dataclass(frozen=True)
class TreeParams:
    """Settings of the boosted trees."""

    trees: int = 300
    depth: int = 4
    rate: float = 0.05
    rows: float = 0.8
    columns: str = "0.8"
    bins: int = 64
    seed: int = 42


def train_partitions(spark: SparkSession, n_rows: int, beside: int = 1) -> int:
    """Partitions of a fit that shares the cores with `beside - 1` others: two a core, fewer if they would be tiny.

    A large table gets more only where a partition would hold over `MOST_TRAIN_ROWS` rows, as each task of each level costs as much as
    thousands of rows.
    """
    share = -(-2 * spark.sparkContext.defaultParallelism // beside)
    return max(1, min(-(-n_rows // TRAIN_ROWS), share), -(-n_rows // MOST_TRAIN_ROWS))


def fit_gbt_churn(df: DataFrame, label: str, params: TreeParams = TreeParams(), beside: int = 1) -> GBTClassificationModel:
    """Boosted trees with a positive row weighing as much as the negatives per positive.

    A level of a tree is a job, so the rows are put into as few partitions as `train_partitions` says, whatever the number of
    shuffle partitions; no row moves through a shuffle. Spark draws the rows of a tree by partition.
    """
    counts = df.agg(F.count(F.lit(1)).alias("n"), F.avg(label).alias("rate")).first()
    positive = F.lit((1 - counts["rate"]) / counts["rate"])
    weighted = df.withColumn("weight", F.when(F.col(label) == 1, positive).otherwise(1.0))
    estimator = GBTClassifier(
        labelCol=label,
        weightCol="weight",
        maxIter=params.trees,
        maxDepth=params.depth,
        stepSize=params.rate,
        subsamplingRate=params.rows,
        featureSubsetStrategy=params.columns,
        maxBins=params.bins,
        seed=params.seed,
        checkpointInterval=10,
    )
    name_checkpoints(df.sparkSession)  # else the lineage grows with the trees
    return estimator.fit(weighted.coalesce(train_partitions(df.sparkSession, counts["n"], beside)))


def gbt_scores(model: GBTClassificationModel, df: DataFrame, key: str, label: str) -> DataFrame:
    """`(key, label, predicted_label, p)`."""
    return model.transform(df).select(
        key,
        F.col(label).cast("int").alias(label),
        F.col("prediction").cast("int").alias("predicted_label"),
        vector_to_array("probability")[1].alias("p"),
    )


def cv_score(df: DataFrame, key: str, label: str, k: int, params: TreeParams, digits: int = 4) -> DataFrame:
    """Mean and population deviation of ROC AUC and F1 over k stratified folds; each fold is fitted once."""
    folds = stratified_kfold(df, key, label, k).select(key, "fold")
    rows = checkpointed(df.join(folds, key)).persist()  # every task brings the lineage of its rows along

    def out_of_fold(fold: int) -> DataFrame:
        model = fit_gbt_churn(rows.filter(F.col("fold") != fold), label, params, beside=k)
        return gbt_scores(model, rows.filter(F.col("fold") == fold), key, label).withColumn("fold", F.lit(fold))

    try:
        rows.count()
        scored = checkpointed(reduce(DataFrame.unionByName, for_each_fold(df.sparkSession, k, out_of_fold)))
        per_fold = score_ranked(scored, label, "predicted_label", "p", ["fold"])
    finally:
        rows.unpersist()
    long = per_fold.unpivot(["fold"], ["roc_auc", "f1"], "metric", "value")
    return long.groupBy("metric").agg(
        rounded(F.avg("value"), digits).alias("mean"), rounded(F.stddev_pop("value"), digits).alias("std")
    )


def feature_importance_top(model: GBTClassificationModel, df: DataFrame, names: list[str], n: int = 10) -> DataFrame:
    """Gain share of the `n` most used features."""
    pairs = list(zip(names, model.featureImportances.toArray().tolist()))  # one per feature
    table = df.sparkSession.createDataFrame(pairs, "feature string, importance double")
    shown = table.withColumn("importance", rounded(F.col("importance"), 4))
    return shown.orderBy(F.desc("importance"), F.asc("feature")).limit(n)


def baseline_lift(train: DataFrame, test: DataFrame, scored: DataFrame, label: str, name: str) -> DataFrame:
    """All scores of a model and of the majority class on the same test rows, one row each."""
    columns = [label, "predicted_label", "p"]
    both = scored.select(F.lit(name).alias("model"), *columns).unionByName(
        predict_majority(train, test, label).select(F.lit("majority_class").alias("model"), *columns)
    )
    return score_ranked(both, label, "predicted_label", "p", ["model"])


def phrase_signal_classifier(df: DataFrame, text: str, phrases: tuple[str, ...]) -> DataFrame:
    """1 where one of the phrases stands in the text as whole words, with the first such span as evidence.

    The phrases are a parameter and become one pattern, matched inside the scan.
    """
    pattern = r"(?:^|[^\p{L}\p{N}_])(" + "|".join(map(re.escape, phrases)) + r")(?:[^\p{L}\p{N}_]|$)"
    span = F.regexp_extract(F.lower(text), pattern, 1)
    marked = df.withColumn("evidence", span)
    return marked.withColumn("predicted_label", (F.col("evidence") != "").cast("int"))

