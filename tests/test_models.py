import numpy as np
import pytest
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from plumbline.operators import features, models

TEXTS = [
    "I closed my account because the fees are high",
    "The fees are high and nobody answers",
    "They closed my account without notice",
    "nobody answers the phone",
    "I closed my account and I am leaving the bank",
    "the phone line was cut and nobody answers",
    "a",
]
STOP = ["the", "and", "are", "my", "am", "was"]


@pytest.fixture(scope="module")
def rows(spark):
    labelled = [(i, t, int("closed" in t)) for i, t in enumerate(TEXTS)]
    df = spark.createDataFrame(labelled, "id long, t string, y int").repartition(3)
    return features.with_terms(df, "t", STOP).persist()


def grams(text):
    words = [w for w in text.lower().split() if len(w) > 1 and w not in STOP]
    return words + [f"{a} {b}" for a, b in zip(words, words[1:])]


def expected_vocabulary():
    counts = {}
    for text in TEXTS:
        for term in grams(text):
            tf, docs = counts.setdefault(term, [0, set()])
            counts[term] = [tf + 1, docs | {text}]
    return {t: (tf, len(docs)) for t, (tf, docs) in counts.items() if len(docs) >= 2}


def test_vocabulary(rows):
    found = {r["term"]: (r["tf"], r["df"]) for r in features.ngram_vocabulary(rows).collect()}
    assert found == expected_vocabulary()


def test_long_weights_equal_the_vectors(rows):
    vocabulary = features.ngram_vocabulary(rows)
    long = features.tfidf_weights(rows, "id", vocabulary, F.lit(len(TEXTS)))
    by_pair = {(r["id"], r["term"]): r["weight"] for r in long.collect()}
    transform, names = features.vectorizer(vocabulary, len(TEXTS))
    for row in transform.transform(rows).select("id", vector_to_array("features").alias("v")).collect():
        for name, value in zip(names, row["v"]):
            assert value == pytest.approx(by_pair.get((row["id"], name), 0.0), abs=1e-12)
    one = {t: np.log((1 + 7) / (1 + d)) + 1 for t, (_, d) in expected_vocabulary().items()}
    terms = [t for t in grams(TEXTS[0]) if t in one]
    norm = np.sqrt(sum(one[t] ** 2 for t in set(terms)))
    assert by_pair[(0, "closed")] == pytest.approx(one["closed"] / norm)


def test_fold_vocabularies_equal_a_count_per_training_part(rows):
    folded = rows.withColumn("fold", (F.col("id") % 3).cast("int"))
    params = models.TextParams()
    found = models.fold_vocabularies(folded, "fold", 3, params)
    for fold in range(3):
        direct = features.term_counts(folded.filter(F.col("fold") != fold)).filter("df >= 2")
        one = found.filter(F.col("held_out") == fold).drop("held_out")
        assert one.exceptAll(direct).count() == 0 and direct.exceptAll(one).count() == 0


def test_logistic_regression_solves_the_balanced_objective(rows):
    params = models.TextParams()
    transform, model, _ = models.fit_text_model(rows, features.ngram_vocabulary(rows), "y", params)
    local = transform.transform(rows).select("y", vector_to_array("features").alias("v")).collect()
    x = np.array([r["v"] for r in local])
    y = np.array([r["y"] for r in local])
    weight = np.where(y == 1, len(y) / (2 * y.sum()), len(y) / (2 * (1 - y).sum()))
    beta = model.coefficients.toArray()
    p = 1 / (1 + np.exp(-(x @ beta + model.intercept)))
    gradient = (x.T @ (weight * (p - y)) + beta / params.c) / len(y)
    assert abs(gradient).max() < 1e-4


def test_out_of_fold_predictions_cover_every_row_once(spark):
    texts = [(i, f"{'we are leaving now' if i % 4 == 0 else 'all is well here'} case {i % 5}", int(i % 4 == 0)) for i in range(40)]
    df = spark.createDataFrame(texts, "id long, t string, y int")
    out = models.cross_val_predict(df, "id", "y", "t", 2, models.TextParams(max_iter=30)).collect()
    assert sorted(r["id"] for r in out) == list(range(40))
    assert all(r["predicted_label"] == r["y"] for r in out)


def test_cross_validation_holds_counts_and_not_terms(spark, monkeypatch):
    texts = [(i, f"{'we are leaving now' if i % 4 == 0 else 'all is well here'} case {i % 5} only{i}", int(i % 4 == 0)) for i in range(40)]
    df = spark.createDataFrame([*texts, (40, None, 0)], "id long, t string, y int").repartition(40)
    held, fits, now = [], [], set()
    fit = models.LogisticRegression.fit

    def seen_fit(self, train):
        now.add(id(train))
        fits.append((len(now), train.rdd.getNumPartitions(), train.storageLevel.useMemory))
        try:
            return fit(self, train)
        finally:
            now.discard(id(train))

    monkeypatch.setattr(type(df), "persist", lambda self, *level: held.append(self) or type(df).cache(self))
    monkeypatch.setattr(models.LogisticRegression, "fit", seen_fit)
    out = models.cross_val_predict(df, "id", "y", "t", 5, models.TextParams(max_iter=5)).collect()
    assert sorted(r["id"] for r in out) == list(range(40))
    assert [one.columns for one in held] == [["held_out", "term", "tf", "df"], ["id", "y", "fold", "counts"]]
    assert len(fits) == 5 and all(beside <= 2 and parts <= 8 and not kept for beside, parts, kept in fits)


def test_sliced_counts_give_the_vectors_of_a_vocabulary(spark, rows):
    vocabulary = features.ngram_vocabulary(rows, max_features=6)
    transform, names = features.vectorizer(vocabulary, 7)
    every = sorted({*names, "answers", "bank", "zz", "a", "closed my"})
    counts = models.CountVectorizerModel.from_vocabulary(every, inputCol="terms", outputCol="counts").transform(rows)
    sliced = features.sliced_vectorizer(every, vocabulary, 7).transform(counts).select("id", "features").collect()
    direct = transform.transform(rows).select("id", "features").collect()
    assert {r["id"]: r["features"] for r in sliced} == {r["id"]: r["features"] for r in direct}


def test_accounts_are_cleaned(spark):
    roles = models.AccountColumns("id", "churn", ("plan",), ("flag",), ("tenure",), ("total",))
    df = spark.createDataFrame(
        [(1, "a", "Yes", 0, " ", "No"), (2, "b", "0", 3, "12.5", "Yes"), (3, "a", "maybe", 1, "7", "1")],
        "id long, plan string, flag string, tenure int, total string, churn string",
    )
    rows = models.clean_accounts(df, roles).orderBy("id").collect()
    assert [(r["flag"], r["total"], r["churn"]) for r in rows] == [(1, 0.0, 0), (0, 12.5, 1), (None, 7.0, 1)]
    report = models.coercion_report(df, "total", "tenure").first()
    assert (report["n_coerced"], report["n_coerced_without_tenure"]) == (1, 1)


def test_trees_beat_the_majority_class(spark):
    roles = models.AccountColumns("id", "churn", ("plan",), ("flag",), ("tenure",), ("total",))
    df = spark.range(300).select(
        "id",
        F.when(F.col("id") % 2 == 0, "a").otherwise("b").alias("plan"),
        F.lit("Yes").alias("flag"),
        (F.col("id") % 10).cast("int").alias("tenure"),
        F.col("id").cast("string").alias("total"),
        F.when(F.col("id") % 10 < 4, "Yes").otherwise("No").alias("churn"),
    )
    rows = models.assemble(df, roles).persist()
    model = models.fit_gbt_churn(rows, "churn", models.TreeParams(trees=5))
    scored = models.gbt_scores(model, rows, "id", "churn")
    labels = rows.select("id", F.col("churn").cast("int").alias("churn"))
    lift = {r["model"]: r for r in models.baseline_lift(labels, labels, scored, "churn", "trees").collect()}
    assert lift["trees"]["roc_auc"] > 0.95 and lift["majority_class"]["roc_auc"] == 0.5
    assert lift["majority_class"]["pr_auc"] == pytest.approx(0.4)
    assert models.feature_importance_top(model, rows, roles.features()).first()["feature"] == "tenure"


def test_trees_are_fitted_on_partitions_by_rows(spark, monkeypatch):
    seen = []
    fit = models.GBTClassifier.fit
    monkeypatch.setattr(models.GBTClassifier, "fit", lambda self, df: seen.append(df.rdd.getNumPartitions()) or fit(self, df))
    rows = models.VectorAssembler(inputCols=["x"], outputCol="features").transform(
        spark.range(90).select(F.col("id"), (F.col("id") % 10).cast("double").alias("x"), (F.col("id") % 10 < 4).cast("int").alias("y"))
    ).repartition(40)
    params = models.TreeParams(trees=2)
    assert models.gbt_scores(models.fit_gbt_churn(rows, "y", params), rows, "id", "y").filter("predicted_label = y").count() == 90
    monkeypatch.setattr(models, "TRAIN_ROWS", 20)
    models.fit_gbt_churn(rows, "y", params)
    assert seen == [1, 5]


def test_tree_partitions_follow_the_cores_and_not_the_rows(spark, monkeypatch):
    seen = []
    fit = models.GBTClassifier.fit
    monkeypatch.setattr(models.GBTClassifier, "fit", lambda self, df: seen.append(df.rdd) or fit(self, df))
    monkeypatch.setattr(models, "TRAIN_ROWS", 1)
    rows = models.VectorAssembler(inputCols=["x"], outputCol="features").transform(
        spark.range(90).select(F.col("id"), (F.col("id") % 10).cast("double").alias("x"), (F.col("id") % 10 < 4).cast("int").alias("y"))
    ).repartition(40)
    params = models.TreeParams(trees=2)
    models.fit_gbt_churn(rows, "y", params)
    monkeypatch.setattr(models, "MOST_TRAIN_ROWS", 5)
    models.fit_gbt_churn(rows, "y", params)
    assert [rdd.getNumPartitions() for rdd in seen] == [8, 18]  # two a core; no more than five rows in one
    monkeypatch.setattr(models, "MOST_TRAIN_ROWS", 500)
    seen.clear()
    scores = {r["metric"]: r["mean"] for r in models.cv_score(rows, "id", "y", 2, params).collect()}
    assert scores["roc_auc"] == 1.0
    assert all(rdd.getNumPartitions() <= 4 for rdd in seen) and len(seen) == 2
    assert not any("Shuffled" in rdd.toDebugString().decode() for rdd in seen)  # no lineage that each task would read


@pytest.mark.parametrize("buckets, most, fewer", [(2**20, 5, True), (2**20, 40, True), (64, 5, True), (8, 3, False), (2**20, 5000, False)])
def test_vocabulary_of_counted_buckets_is_that_of_all_terms(spark, monkeypatch, buckets, most, fewer):
    monkeypatch.setattr(features, "BUCKETS", buckets, raising=False)
    texts = [(i, [f"w{(i * j * j) % (7 + j)}" for j in range(40)] + [f"once{i}"] * 3 + [f"rare{i}_{j}" for j in range(9)]) for i in range(60)]
    rows = spark.createDataFrame([*texts, (60, []), (61, None), (61, ["w1", "w1"])], "id bigint, terms array<string>")
    counts = features.term_counts(rows).filter("df >= 2").collect()
    wanted = sorted(((r["term"], r["tf"], r["df"]) for r in counts), key=lambda r: (-r[1], r[0]))[:most]
    counted, count = [], features.term_counts
    monkeypatch.setattr(features, "term_counts", lambda df, **named: counted.append(count(df, **named)) or counted[-1])
    found = [(r["term"], r["tf"], r["df"]) for r in features.ngram_vocabulary(rows, 2, most).collect()]
    assert sorted(found, key=lambda r: (-r[1], r[0])) == wanted
    every = count(rows).count()
    assert all((df.count() < every / 2) == fewer for df in counted)


def test_terms_are_the_runs_of_letters_and_digits(spark):
    texts = ["Straße 12 a_b É É x ÀÉ", "THE end, of the_end 中文字 ½½", "", "x", None, "ΑΣ ΑΣ I'm"]
    rows = spark.createDataFrame(list(enumerate(texts)), "id int, t string")
    found = {r["id"]: r["terms"] for r in features.with_terms(rows, "t", ["The", "of"], 3).collect()}
    assert found == {
        0: ["straße", "12", "a_b", "àé", "straße 12", "12 a_b", "a_b àé", "straße 12 a_b", "12 a_b àé"],
        1: ["end", "the_end", "中文字", "½½", "end the_end", "the_end 中文字", "中文字 ½½", "end the_end 中文字", "the_end 中文字 ½½"],
        2: [], 3: [], 5: ["ας", "ας", "ας ας"],
    }
