"""Text features and classical models."""

from __future__ import annotations

from pyspark.sql import functions as F

from plumbline.operators import features, metrics, models
from plumbline.operators.sampling import stratified_split
from plumbline.plans.registry import query
from plumbline.plans.views import ACCOUNT_ROLES, K, PHRASES, sql
from plumbline.storage import checkpointed
from plumbline.session import spread

STOP = ["the", "of", "and", "in", "to", "de", "la", "que", "die", "und"]
TREES = models.TreeParams()

_TERMS = f"""SELECT complaint_id, list_concat(t, list_transform(range(1, length(t)), lambda i: t[i] || ' ' || t[i + 1])) AS grams
             FROM (SELECT complaint_id, list_filter(regexp_extract_all(lower(narrative), '[\\p{{{{L}}}}\\p{{{{N}}}}_]{{{{2,}}}}'),
                       lambda x: x NOT IN ({", ".join(f"'{w}'" for w in STOP)})) AS t FROM {{source}})"""
_VOCABULARY = """SELECT term, tf, df FROM (SELECT term, CAST(sum(n) AS BIGINT) AS tf, count(*) AS df
                     FROM counted GROUP BY term) WHERE df >= 2 ORDER BY tf DESC, term LIMIT 5000"""
_COUNTED = "SELECT complaint_id, term, count(*) AS n FROM (SELECT complaint_id, unnest(grams) AS term FROM grams) GROUP BY ALL"


def terms(v):
    texts = spread(v.complaints.select("complaint_id", "narrative"))
    return features.with_terms(texts, "narrative", STOP)


@query(
    "m1_ngram_vocabulary",
    sql(
        "complaints",
        "SELECT term, tf, df FROM vocabulary",
        grams=_TERMS.format(source="complaints"),
        counted=_COUNTED,
        vocabulary=_VOCABULARY,
    ),
)
def m1(v):
    return features.ngram_vocabulary(terms(v))


@query(
    "m2_tfidf_weights",
    sql(
        "complaints",
        """SELECT complaint_id, term, round(w / sqrt(sum(w * w) OVER (PARTITION BY complaint_id)), 6) AS weight
           FROM (SELECT complaint_id, term, n * (ln((1 + (SELECT count(*) FROM complaints)) / CAST(1 + df AS DOUBLE)) + 1) AS w
                 FROM counted JOIN vocabulary USING (term))""",
        grams=_TERMS.format(source="complaints"),
        counted=_COUNTED,
        vocabulary=_VOCABULARY,
    ),
)
def m2(v):
    rows = terms(v)
    n_texts = v.complaints.agg(F.count("narrative")).scalar()
    weights = features.tfidf_weights(rows, "complaint_id", features.ngram_vocabulary(rows), n_texts)
    return weights.withColumn("weight", F.round("weight", 6))


@query(
    "m4_fold_vocabularies",
    sql(
        "golden folds",
        """SELECT CAST(k AS INTEGER) AS held_out, term, CAST(sum(n) AS BIGINT) AS tf, count(*) AS df
           FROM counted JOIN folds USING (complaint_id), range(5) AS r(k) WHERE fold <> k
           GROUP BY k, term HAVING count(*) >= 2""",
        grams=_TERMS.format(source="golden"),
        counted=_COUNTED,
    ),
)
def m4_vocabularies(v):
    rows = features.with_terms(v.golden.select("complaint_id", "narrative"), "narrative", STOP)
    folded = rows.join(v.folds.select("complaint_id", "fold"), "complaint_id")
    return models.fold_vocabularies(folded, "fold", K, models.TextParams())


@query("m3_balanced_logistic_regression")
def m3(v):
    """In-sample scores of one fit on all labelled texts."""
    params = models.TextParams()
    rows = features.with_terms(
        v.golden.select("complaint_id", "churn_signal", "narrative"), "narrative", params.stop_list()
    ).select("complaint_id", "churn_signal", "terms")
    rows = rows.persist()
    vocabulary = features.ngram_vocabulary(rows, params.min_df, params.max_features)
    transform, model, _ = models.fit_text_model(rows, vocabulary, "churn_signal", params)
    rows.unpersist()
    scored = model.transform(transform.transform(rows))
    return scored.select("complaint_id", "churn_signal", F.col("prediction").cast("int").alias("predicted_label"))


@query("m4_cross_val_predict")
def m4(v):
    return models.cross_val_predict(v.golden, "complaint_id", "churn_signal", "narrative", K)


@query("m5_top_terms")
def m5(v):
    return models.top_terms(v.golden, "churn_signal", "narrative")


def split_accounts(v):
    rows = checkpointed(models.assemble(v.accounts, ACCOUNT_ROLES))
    parts = stratified_split(rows, "customer_id", "churn", 0.2).select("customer_id", "part")
    both = rows.join(parts, "customer_id")
    return both.filter("part = 'train'").drop("part"), both.filter("part = 'test'").drop("part")


@query("m6_gbt_churn")
def m6(v):
    train, test = split_accounts(v)
    model = models.fit_gbt_churn(train.persist(), "churn", TREES)
    train.unpersist()
    return models.gbt_scores(model, test, "customer_id", "churn")


@query("m7_cv_score")
def m7(v):
    train, _ = split_accounts(v)
    return models.cv_score(train, "customer_id", "churn", K, TREES)


@query("m8_feature_importance_top10")
def m8(v):
    train, _ = split_accounts(v)
    model = models.fit_gbt_churn(train.persist(), "churn", TREES)
    train.unpersist()
    return models.feature_importance_top(model, train, ACCOUNT_ROLES.features())


@query("m9_baseline_lift")
def m9(v):
    train, test = split_accounts(v)
    model = models.fit_gbt_churn(train.persist(), "churn", TREES)
    train.unpersist()
    scored = models.gbt_scores(model, test, "customer_id", "churn")
    labels = [df.select("customer_id", F.col("churn").cast("int").alias("churn")) for df in (train, test)]
    return models.baseline_lift(labels[0], labels[1], scored, "churn", "boosted_trees")


@query(
    "m10_phrase_signal_classifier",
    sql(
        "complaints",
        rf"""SELECT complaint_id, regexp_extract(lower(narrative), '(?:^|[^\p{{L}}\p{{N}}_])({"|".join(PHRASES)})(?:[^\p{{L}}\p{{N}}_]|$)', 1) AS evidence,
                CASE WHEN regexp_matches(lower(narrative), '(?:^|[^\p{{L}}\p{{N}}_])({"|".join(PHRASES)})(?:[^\p{{L}}\p{{N}}_]|$)') THEN 1 ELSE 0 END
                    AS predicted_label
            FROM complaints""",
    ),
)
def m10(v):
    marked = models.phrase_signal_classifier(v.complaints, "narrative", PHRASES)
    return marked.select("complaint_id", "evidence", "predicted_label")


@query(
    "k1_classifier_stability",
    sql(
        "fold_long",
        """SELECT metric, round_even(avg(value), 3) AS mean, round_even(stddev_pop(value), 3) AS std, count(*) AS n_folds
           FROM fold_long WHERE model = 'lexicon' GROUP BY metric""",
    ),
)
def stability(v):
    """How good the phrase rule is, and how stable, on the shared folds."""
    preds = models.phrase_signal_classifier(v.golden, "narrative", PHRASES).select("complaint_id", "predicted_label")
    judged = v.folds.join(preds, "complaint_id")
    return metrics.mean_std_over_folds(metrics.per_fold_metrics(judged, "churn_signal", "predicted_label"))
