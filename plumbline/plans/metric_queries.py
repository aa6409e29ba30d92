"""Joins of labels and predictions, and the metrics on them."""

from __future__ import annotations

from pyspark.sql import functions as F

from plumbline.operators import joins, metrics, validation
from plumbline.plans.registry import query
from plumbline.plans.views import K, sql

_SCORES = """coalesce((tp + tn) / nullif(CAST(tn + fp + fn + tp AS DOUBLE), 0), 0.0) AS accuracy,
             coalesce(tp / nullif(CAST(tp + fp AS DOUBLE), 0), 0.0) AS precision,
             coalesce(tp / nullif(CAST(tp + fn AS DOUBLE), 0), 0.0) AS recall,
             coalesce(2 * tp / nullif(CAST(2 * tp + fp + fn AS DOUBLE), 0), 0.0) AS f1"""
_ROUNDED = "round(accuracy, 6) AS accuracy, round(precision, 6) AS precision, round(recall, 6) AS recall, round(f1, 6) AS f1"
_POOLED = """SELECT model, CAST(sum(tn) AS BIGINT) AS tn, CAST(sum(fp) AS BIGINT) AS fp,
                 CAST(sum(fn) AS BIGINT) AS fn, CAST(sum(tp) AS BIGINT) AS tp FROM cells GROUP BY model"""


def six(df, *columns):
    return df.withColumns({c: F.round(F.col(c), 6) for c in columns})


@query(
    "p4_domain_membership",
    sql("golden_raw", """SELECT complaint_id, churn_signal IN (0, 1) AS valid_label,
                             product IN ('en', 'fr') AS in_vocabulary FROM golden_raw"""),
)
def p4(v):
    rows = v.golden_raw.select("complaint_id", "product", F.col("churn_signal").isin(0, 1).alias("valid_label"))
    return joins.in_vocabulary(rows, "product", ("en", "fr")).drop("product")


@query("p5_drop_identifier", "SELECT c_nationkey, c_acctbal, c_mktsegment FROM customer")
def p5(v):
    return v.read("customer").drop("c_custkey", "c_name")


@query(
    "p6_coerce_numeric_default",
    sql(
        "accounts",
        """SELECT count(*) AS n_rows, count(*) FILTER (WHERE try_cast(total AS DOUBLE) IS NULL) AS n_coerced,
               count(*) FILTER (WHERE try_cast(total AS DOUBLE) IS NULL AND tenure = 0) AS n_coerced_without_tenure,
               round(sum(coalesce(try_cast(total AS DOUBLE), 0.0)), 2) AS total FROM accounts""",
    ),
)
def p6(v):
    from plumbline.operators.models import coercion_report

    return coercion_report(v.accounts, "total", "tenure").withColumn("total", F.round("total", 2))


@query(
    "p7_bool_to_int",
    sql("accounts", """SELECT customer_id, CASE urgent WHEN 'Yes' THEN 1 ELSE 0 END AS urgent,
                           CASE churn WHEN 'Yes' THEN 1 ELSE 0 END AS churn FROM accounts"""),
)
def p7(v):
    from plumbline.operators.models import clean_accounts
    from plumbline.plans.views import ACCOUNT_ROLES

    return clean_accounts(v.accounts, ACCOUNT_ROLES).select("customer_id", "urgent", "churn")


@query(
    "p8_encode_categorical",
    sql(
        "accounts",
        """SELECT customer_id, CAST(s.code AS DOUBLE) AS segment_index, CAST(t.code AS DOUBLE) AS nation_index
           FROM accounts a JOIN segments s ON s.segment = a.segment JOIN nations t ON t.nation = a.nation""",
        segments="SELECT segment, row_number() OVER (ORDER BY count(*) DESC, segment) - 1 AS code FROM accounts GROUP BY segment",
        nations="SELECT nation, row_number() OVER (ORDER BY count(*) DESC, nation) - 1 AS code FROM accounts GROUP BY nation",
    ),
)
def p8(v):
    from plumbline.operators.models import encode_categorical

    return encode_categorical(v.accounts, ("segment", "nation")).select("customer_id", "segment_index", "nation_index")


@query(
    "p9_literal_provenance",
    sql("complaints", "SELECT complaint_id, '' AS churn_signal, 'rule v1' AS labeler_model FROM complaints"),
)
def p9(v):
    return v.complaints.select(
        "complaint_id", F.lit("").alias("churn_signal"), F.lit("rule v1").alias("labeler_model")
    )


@query(
    "p10_error_slice",
    sql(
        "golden preds",
        """SELECT complaint_id, churn_signal, predicted_label, substr(narrative, 1, 200) AS narrative
           FROM golden JOIN (SELECT complaint_id, predicted_label FROM preds WHERE model = 'length') USING (complaint_id)
           WHERE churn_signal = 0 AND predicted_label = 1 ORDER BY complaint_id LIMIT 5""",
    ),
)
def p10(v):
    rows = joins.label_prediction_join(v.golden, v.pred("length"), "complaint_id", ["predicted_label"])
    cell = metrics.error_slice(rows, 0, 1, 5, 200, "complaint_id", "churn_signal", "predicted_label", "narrative")
    return cell.select("complaint_id", "churn_signal", "predicted_label", "narrative")


@query(
    "v1_required_columns",
    sql(
        "golden_raw",
        """SELECT 'complaint_id' AS column_name, true AS present, count(complaint_id) AS n_values,
                  count(*) - count(complaint_id) AS n_null FROM golden_raw
           UNION ALL SELECT 'product', true, count(product), count(*) - count(product) FROM golden_raw
           UNION ALL SELECT 'narrative', true, count(narrative), count(*) - count(narrative) FROM golden_raw
           UNION ALL SELECT 'churn_signal', true, count(churn_signal), count(*) - count(churn_signal) FROM golden_raw""",
    ),
)
def v1(v):
    return validation.required_columns_report(v.golden_raw)


@query(
    "v2_drop_ambiguous",
    sql("golden_raw", "SELECT count(*) FILTER (WHERE ambiguous) AS n_ambiguous_dropped FROM golden_raw"),
)
def v2(v):
    return validation.drop_ambiguous(v.golden_raw)[1]


@query(
    "v3_validate_labels",
    sql(
        "golden_raw",
        """SELECT count(*) AS n_rows, count(*) FILTER (WHERE churn_signal IS NULL) AS n_unlabeled,
               count(*) FILTER (WHERE churn_signal NOT IN (0, 1)) AS n_out_of_range,
               count(*) FILTER (WHERE churn_signal = 1) AS n_positive FROM golden_raw WHERE NOT ambiguous""",
    ),
)
def v3(v):
    return validation.label_report(v.golden_raw)


@query("v4_load_golden_set", sql("golden", "SELECT complaint_id, product, narrative, churn_signal FROM golden"))
def v4(v):
    kept, _ = validation.load_golden_set(v.golden_raw)
    return kept.select("complaint_id", "product", "narrative", "churn_signal")


@query(
    "v7_dataset_assertions",
    sql(
        "golden folds preds",
        f"""SELECT 'golden_rows' AS "check", count(*) AS found, CAST(NULL AS BIGINT) AS expected, true AS ok FROM golden
           UNION ALL SELECT 'golden_positives', CAST(sum(churn_signal) AS BIGINT), NULL, true FROM golden
           UNION ALL SELECT 'golden_bad_labels', count(*) FILTER (WHERE churn_signal NOT IN (0, 1)), 0, true FROM golden
           UNION ALL SELECT 'fold_rows', count(*), NULL, true FROM folds
           UNION ALL SELECT 'fold_values', count(DISTINCT fold), {K}, count(DISTINCT fold) = {K} FROM folds
           UNION ALL SELECT 'fold_bad_values', count(*) FILTER (WHERE fold NOT BETWEEN 0 AND {K - 1}), 0, true FROM folds
           UNION ALL SELECT 'prediction_rows', count(*), NULL, true FROM folds
           UNION ALL SELECT 'prediction_null_labels', count(*) FILTER (WHERE predicted_label IS NULL), 0, true FROM preds
           UNION ALL SELECT 'prediction_null_folds', count(*) FILTER (WHERE fold IS NULL), 0, true FROM folds""",
    ),
)
def v7(v):
    preds = joins.label_fold_join(v.pred("length"), v.folds, "complaint_id")
    return validation.dataset_assertions(v.golden, v.folds, preds, None, None, K)


@query(
    "j1_label_fold_join",
    sql("golden folds", """SELECT g.complaint_id, product, narrative, g.churn_signal, fold
                           FROM golden g JOIN folds USING (complaint_id)"""),
)
def j1(v):
    golden = v.golden.select("complaint_id", "product", "narrative", "churn_signal")
    return joins.label_fold_join(golden, v.folds, "complaint_id")


@query(
    "j2_label_prediction_join",
    sql("golden preds", """SELECT complaint_id, churn_signal, predicted_label FROM golden
                           JOIN (SELECT complaint_id, predicted_label FROM preds WHERE model = 'lexicon') USING (complaint_id)"""),
)
def j2(v):
    golden = v.golden.select("complaint_id", "churn_signal")
    return joins.label_prediction_join(golden, v.pred("lexicon"), "complaint_id", ["predicted_label"])


@query(
    "j3_anti_join_todo",
    sql("complaints", """SELECT complaint_id, product FROM complaints
                         WHERE complaint_id NOT IN (SELECT doc_id FROM labels)"""),
)
def j3(v):
    done = v.read("labels").select(F.col("doc_id").alias("complaint_id"))
    return joins.anti_join_todo(v.complaints, done, "complaint_id").select("complaint_id", "product")


@query(
    "j4_semi_join_ids",
    sql("golden folds", """SELECT complaint_id, CASE WHEN fold = 0 THEN 'test' ELSE 'train' END AS part
                           FROM golden JOIN folds USING (complaint_id)"""),
)
def j4(v):
    inside, outside = joins.semi_join_ids(v.golden.select("complaint_id"), v.folds.filter("fold = 0"), "complaint_id")
    return inside.withColumn("part", F.lit("test")).unionByName(outside.withColumn("part", F.lit("train")))


@query(
    "j6_strict_lookup_join",
    sql("preds folds", """SELECT complaint_id, predicted_label, fold FROM folds
                          JOIN (SELECT complaint_id, predicted_label FROM preds WHERE model = 'length') USING (complaint_id)"""),
)
def j6(v):
    preds = joins.label_prediction_join(v.golden.select("complaint_id"), v.pred("length"), "complaint_id", ["predicted_label"])
    return joins.strict_lookup_join(preds, v.folds, "complaint_id", ["fold"])


@query(
    "j7_attach_narrative",
    sql("complaints preds", """SELECT complaint_id, predicted_label, narrative FROM complaints
                               JOIN (SELECT complaint_id, predicted_label FROM preds WHERE model = 'length') USING (complaint_id)"""),
)
def j7(v):
    return joins.attach_narrative(v.pred("length"), v.complaints, "complaint_id")


@query(
    "a1_group_rate",
    sql(
        "golden",
        """SELECT product, count(churn_signal) AS n, CAST(sum(churn_signal) AS BIGINT) AS n_positive,
               round_even(100 * (sum(churn_signal) / CAST(count(churn_signal) AS DOUBLE)), 1) AS rate_pct
           FROM golden GROUP BY ROLLUP (product)""",
    ),
)
def a1(v):
    return metrics.group_rate(v.golden, "product", "churn_signal")


@query(
    "a2_class_balance",
    sql(
        "folds",
        """SELECT part, count(*) AS n, round(avg(churn_signal), 6) AS positive_rate,
               round(sum(1 - churn_signal) / CAST(nullif(sum(churn_signal), 0) AS DOUBLE), 6) AS neg_pos_ratio
           FROM (SELECT churn_signal, CASE WHEN fold = 0 THEN 'test' ELSE 'train' END AS part FROM folds)
           GROUP BY ROLLUP (part)""",
    ),
)
def a2(v):
    part = F.when(F.col("fold") == 0, "test").otherwise("train")
    return six(metrics.class_balance(v.folds.withColumn("part", part), "churn_signal", "part"), "positive_rate", "neg_pos_ratio")


@query(
    "a3_confusion_matrix",
    sql("cells", f"""SELECT model, tn, fp, fn, tp, format('[[{{}},{{}}],[{{}},{{}}]]', tn, fp, fn, tp) AS matrix
                     FROM ({_POOLED})"""),
)
def a3(v):
    cells = metrics.confusion_matrix(v.judged, "churn_signal", "predicted_label", ["model"])
    return cells.withColumn("matrix", F.to_json("matrix"))


@query(
    "a4_score_binary",
    sql("cells", f"SELECT model, {_ROUNDED} FROM (SELECT model, {_SCORES} FROM ({_POOLED}))"),
)
def a4(v):
    scores = metrics.score_binary(v.judged, "churn_signal", "predicted_label", ["model"])
    return six(scores.select("model", *metrics.METRICS), *metrics.METRICS)


@query(
    "a5_per_fold_metrics",
    sql("fold_scores", f"""SELECT fold, tn, fp, fn, tp, n_test, n_positive_test, {_ROUNDED}
                           FROM fold_scores WHERE model = 'length'"""),
)
def a5(v):
    preds = v.judged.filter(F.col("model") == "length")
    per_fold = metrics.per_fold_metrics(preds, "churn_signal", "predicted_label")
    return six(per_fold.drop("matrix"), *metrics.METRICS)


@query(
    "a6_mean_std_over_folds",
    sql(
        "fold_long",
        """SELECT metric, round_even(avg(value), 3) AS mean, round_even(stddev_pop(value), 3) AS std, count(*) AS n_folds
           FROM fold_long WHERE model = 'length' GROUP BY metric""",
    ),
)
def a6(v):
    preds = v.judged.filter(F.col("model") == "length")
    return metrics.mean_std_over_folds(metrics.per_fold_metrics(preds, "churn_signal", "predicted_label"))


@query(
    "a7_model_comparison",
    sql(
        "fold_long",
        """SELECT metric,
               round_even(avg(value) FILTER (WHERE model = 'lexicon'), 3) AS lexicon_mean,
               round_even(stddev_pop(value) FILTER (WHERE model = 'lexicon'), 3) AS lexicon_std,
               round_even(avg(value) FILTER (WHERE model = 'length'), 3) AS length_mean,
               round_even(stddev_pop(value) FILTER (WHERE model = 'length'), 3) AS length_std
           FROM fold_long GROUP BY metric""",
    ),
)
def a7(v):
    return metrics.model_comparison(v.judged, "churn_signal", "predicted_label", ["lexicon", "length"])


@query("a7_pooled_confusion", sql("cells", f"SELECT model, tn, fp, fn, tp FROM ({_POOLED})"))
def a7_pooled(v):
    return metrics.pooled_confusion(v.judged, "churn_signal", "predicted_label").drop("matrix")


_AUC = """SELECT {by} round(sum(CASE WHEN a.p > b.p THEN 1.0 WHEN a.p = b.p THEN 0.5 ELSE 0.0 END)
              / CAST(count(*) AS DOUBLE), 6) AS roc_auc
          FROM scored a JOIN scored b ON a.y = 1 AND b.y = 0 {on} {group}"""
_STEPS = """SELECT p, sum(y) AS pos, sum(sum(y)) OVER (ORDER BY p DESC) AS pos_to,
                sum(count(*)) OVER (ORDER BY p DESC) AS all_to, sum(sum(y)) OVER () AS n_pos FROM scored GROUP BY p"""
_AP = "sum(pos / CAST(n_pos AS DOUBLE) * (pos_to / CAST(all_to AS DOUBLE)))"


@query("a8_roc_auc", sql("scored", _AUC.format(by="", on="", group="")))
def a8(v):
    return six(metrics.roc_auc(v.scored, "y", "p"), "roc_auc")


@query(
    "a8_roc_auc_by_product",
    sql("scored", f"""SELECT g.product, r.roc_auc FROM (SELECT DISTINCT product FROM scored) g LEFT JOIN
        ({_AUC.format(by="a.product,", on="AND a.product = b.product", group="GROUP BY a.product")}) r USING (product)"""),
)
def a8_groups(v):
    return six(metrics.roc_auc(v.scored, "y", "p", ["product"]), "roc_auc")


@query(
    "a8_roc_auc_lineitem",
    """SELECT round((sum(r) FILTER (WHERE y = 1) - n1 * (n1 + 1) / 2) / (n1 * CAST(n0 AS DOUBLE)), 6) AS roc_auc
       FROM (SELECT y, sum(y) OVER () AS n1, sum(1 - y) OVER () AS n0,
                 rank() OVER (ORDER BY p) + (count(*) OVER (PARTITION BY p) - 1) / 2.0 :: DOUBLE AS r
             FROM (SELECT CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END AS y, l_extendedprice AS p FROM lineitem))
       GROUP BY n1, n0""",
)
def a8_lines(v):
    rows = v.read("lineitem").select(
        (F.col("l_returnflag") == "R").cast("int").alias("y"), F.col("l_extendedprice").alias("p")
    )
    return six(metrics.roc_auc(rows, "y", "p"), "roc_auc")


@query("a9_average_precision", sql("scored", f"SELECT round({_AP}, 6) AS average_precision FROM ({_STEPS})"))
def a9(v):
    return six(metrics.average_precision(v.scored, "y", "p"), "average_precision")


@query("a10_brier_score", sql("scored", "SELECT round(avg((p - y) * (p - y)), 6) AS brier_score FROM scored"))
def a10(v):
    return six(metrics.brier_score(v.scored, "y", "p"), "brier_score")


@query(
    "a11_score_ranked",
    sql(
        "scored",
        f"""SELECT 'rule' AS model, {_ROUNDED}, (SELECT * FROM ({_AUC.format(by="", on="", group="")})) AS roc_auc,
                (SELECT round({_AP}, 6) FROM ({_STEPS})) AS pr_auc,
                (SELECT round(avg((p - y) * (p - y)), 6) FROM scored) AS brier_score
            FROM (SELECT {_SCORES} FROM (SELECT
                count(*) FILTER (WHERE y = 0 AND predicted_label = 0) AS tn,
                count(*) FILTER (WHERE y = 0 AND predicted_label = 1) AS fp,
                count(*) FILTER (WHERE y = 1 AND predicted_label = 0) AS fn,
                count(*) FILTER (WHERE y = 1 AND predicted_label = 1) AS tp FROM scored))""",
    ),
)
def a11(v):
    rows = v.scored.withColumn("model", F.lit("rule"))
    scores = metrics.score_ranked(rows, "y", "predicted_label", "p", ["model"])
    return six(scores, *metrics.METRICS, "roc_auc", "pr_auc", "brier_score")


@query(
    "a27_length_histogram",
    sql(
        "complaints",
        """SELECT CAST(least((n - lo) * 40 // greatest(hi - lo, 1), 39) AS INTEGER) AS bin,
               round(any_value(lo) + least((n - lo) * 40 // greatest(hi - lo, 1), 39) * (any_value(hi - lo) / 40.0 :: DOUBLE), 6)
                   AS bin_start, count(*) AS n
           FROM (SELECT length(narrative) AS n, min(length(narrative)) OVER () AS lo, max(length(narrative)) OVER () AS hi
                 FROM complaints) GROUP BY least((n - lo) * 40 // greatest(hi - lo, 1), 39)""",
    ),
)
def a27(v):
    return six(metrics.length_histogram(v.complaints, "narrative"), "bin_start")


@query(
    "a28_majority_class",
    sql(
        "folds",
        """SELECT complaint_id, churn_signal, fold, (SELECT churn_signal FROM folds WHERE fold <> 0 GROUP BY churn_signal
               ORDER BY count(*) DESC, churn_signal LIMIT 1) AS predicted_label,
               CAST((SELECT churn_signal FROM folds WHERE fold <> 0 GROUP BY churn_signal
               ORDER BY count(*) DESC, churn_signal LIMIT 1) AS DOUBLE) AS p
           FROM folds WHERE fold = 0""",
    ),
)
def a28(v):
    folds = v.folds
    return metrics.predict_majority(folds.filter("fold <> 0"), folds.filter("fold = 0"), "churn_signal")


