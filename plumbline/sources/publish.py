"""The four published tables with their checks."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from plumbline.operators.joins import strict_lookup_join
from plumbline.operators.sampling import sort_for_publish
from plumbline.operators.validation import dataset_assertions, require_ok
from plumbline.schemas import FOLDS, MODEL_PREDICTIONS, TFIDF_PREDICTIONS
from plumbline.sources.files import csv_scan, write_csv


def publish_dataset(
    spark: SparkSession,
    folder: str,
    golden: DataFrame,
    folds: DataFrame,
    text_predictions: DataFrame,
    model_predictions: DataFrame,
    k: int,
    n_rows: int | None = None,
    n_positive: int | None = None,
) -> DataFrame:
    """Write golden set, folds and both prediction tables in id order, then check what was written.

    Predictions get their fold by id; an id without a fold stops the job. Returns the report of all checks.
    """
    key = "complaint_id"
    fold_of = folds.select(key, "fold")
    looked_up = {
        "text": strict_lookup_join(text_predictions, fold_of, key, ["fold"]),
        "model": strict_lookup_join(model_predictions, fold_of, key, ["fold"]),
    }
    tables = {
        "golden_set": (golden, golden.schema),
        "cv_folds": (fold_of, FOLDS),
        "tfidf_predictions": (looked_up["text"], TFIDF_PREDICTIONS),
        "llm_predictions": (looked_up["model"], MODEL_PREDICTIONS),
    }
    written = {}
    for name, (table, schema) in tables.items():
        path = f"{folder}/{name}"
        write_csv(sort_for_publish(table.select(*schema.fieldNames()), key), path)
        written[name] = csv_scan(spark, path, schema)
    reports = []
    for name in ("tfidf_predictions", "llm_predictions"):
        checks = dataset_assertions(
            written["golden_set"], written["cv_folds"], written[name], n_rows, n_positive, k
        )
        reports.append(checks.select(F.lit(name).alias("predictions"), *checks.columns))
    return require_ok(reports[0].unionByName(reports[1]))
