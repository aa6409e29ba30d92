import pytest
from pyspark.sql import functions as F

from plumbline.operators import joins, validation

SCHEMA = "complaint_id long, product string, narrative string, churn_signal double, ambiguous boolean"


def golden(spark, *rows):
    return spark.createDataFrame([(i + 1, "Credit card", "text", *row) for i, row in enumerate(rows)], SCHEMA)


def test_valid_set(spark):
    kept, dropped = validation.load_golden_set(golden(spark, (1.0, False), (0.0, None)))
    assert [r["churn_signal"] for r in kept.orderBy("complaint_id").collect()] == [1, 0]
    assert dropped.first()[0] == 0


def test_ambiguous_rows_are_left_out(spark):
    kept, dropped = validation.load_golden_set(golden(spark, (1.0, False), (None, True)))
    assert (kept.count(), dropped.first()[0]) == (1, 1)


def test_missing_columns(spark):
    with pytest.raises(ValueError, match="missing required columns"):
        validation.load_golden_set(golden(spark, (1.0, False)).select("complaint_id", "narrative"))


def test_unlabelled_rows_come_before_bad_values(spark):
    with pytest.raises(ValueError, match="1 unlabeled"):
        validation.load_golden_set(golden(spark, (None, False), (2.0, False)))


def test_labels_out_of_range(spark):
    with pytest.raises(ValueError, match="must be 0 or 1"):
        validation.load_golden_set(golden(spark, (2.0, False)))


def test_labels_are_truncated_before_the_check(spark):
    kept, _ = validation.load_golden_set(golden(spark, (0.5, False)))
    assert kept.first()["churn_signal"] == 0


def test_failed_checks_are_named(spark):
    labels = golden(spark, (1.0, False), (0.0, False)).withColumn("churn_signal", F.col("churn_signal").cast("int"))
    folds = spark.createDataFrame([(1, 0), (2, 7)], "complaint_id long, fold int")
    preds = spark.createDataFrame([(1, 0, None), (2, 1, 1)], "complaint_id long, fold int, predicted_label int")
    report = validation.dataset_assertions(labels, folds, preds, 2, 2, 2)
    with pytest.raises(ValueError) as error:
        validation.require_ok(report)
    for name in ("golden_positives", "fold_values", "fold_bad_values", "prediction_null_labels"):
        assert name in str(error.value)


def test_strict_lookup_fails_on_a_missing_key(spark):
    left = spark.createDataFrame([(1,), (2,)], "id long")
    right = spark.createDataFrame([(1, 0)], "id long, fold int")
    with pytest.raises(Exception, match="no entry for id 2"):
        joins.strict_lookup_join(left, right, "id", ["fold"]).collect()
