"""Checks of label tables and published tables. Each check is an aggregate pass, reported as rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plumbline.operators.unpivot import long_form
from plumbline.schemas import GOLDEN_REQUIRED


def missing_columns(df: DataFrame, required=GOLDEN_REQUIRED) -> list[str]:
    return [c for c in required if c not in df.columns]


def validate_required_columns(df: DataFrame, required=GOLDEN_REQUIRED) -> DataFrame:
    """The table itself; an error that names the columns it lacks."""
    absent = missing_columns(df, required)
    if absent:
        raise ValueError(f"missing required columns: {absent}")
    return df


def required_columns_report(df: DataFrame, required=GOLDEN_REQUIRED) -> DataFrame:
    """One row per required column: whether it is there and how many rows have a value."""
    present = [c for c in required if c in df.columns]
    counts = df.agg(
        F.count(F.lit(1)).alias("_rows"),
        *(F.count(c).alias(c) for c in present),
        *(F.lit(None).cast("long").alias(c) for c in required if c not in present),
    )
    rows = long_form(counts, ["_rows"], list(required), "column_name", "n_values")
    return rows.select(
        "column_name",
        F.col("column_name").isin(present).alias("present"),
        "n_values",
        (F.col("_rows") - F.col("n_values")).alias("n_null"),
    )


def is_ambiguous():
    return F.coalesce(F.col("ambiguous"), F.lit(False))


def drop_ambiguous(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Rows not marked ambiguous, and a one-row count of the others; an unmarked row stays."""
    if "ambiguous" not in df.columns:
        return df, df.agg(F.lit(0).cast("long").alias("n_ambiguous_dropped"))
    count = df.agg(F.count_if(is_ambiguous()).alias("n_ambiguous_dropped"))
    return df.filter(~is_ambiguous()), count


def label_report(df: DataFrame, label: str = "churn_signal") -> DataFrame:
    """Counts over the rows that are not ambiguous: all, unlabelled, outside {0, 1} after truncation."""
    kept, _ = drop_ambiguous(df)
    as_int = F.col(label).cast("int")
    return kept.agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.count_if(F.col(label).isNull()).alias("n_unlabeled"),
        F.count_if(as_int.isNotNull() & ~as_int.isin(0, 1)).alias("n_out_of_range"),
        F.count_if(as_int == 1).alias("n_positive"),
    )


def validate_labels(df: DataFrame, label: str = "churn_signal") -> DataFrame:
    """The rows with the label as a 0/1 integer; an error for missing labels first, then for other values."""
    counts = label_report(df, label).first()
    if counts["n_unlabeled"]:
        raise ValueError(f"{counts['n_unlabeled']} unlabeled rows that are not ambiguous: finish the review first")
    if counts["n_out_of_range"]:
        raise ValueError(f"{label} must be 0 or 1 in every row that is not ambiguous")
    return df.withColumn(label, F.col(label).cast("int"))


def load_golden_set(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """A checked label table without its ambiguous rows, and the number of rows left out."""
    validate_required_columns(df)
    kept, dropped = drop_ambiguous(df)
    return validate_labels(kept), dropped


def dataset_assertions(
    golden: DataFrame,
    folds: DataFrame,
    predictions: DataFrame,
    n_rows: int | None,
    n_positive: int | None,
    k: int,
) -> DataFrame:
    """One row per check of the published tables: what was found, what was expected, whether they agree."""
    labels = golden.agg(
        F.count(F.lit(1)).alias("golden_rows"),
        F.sum("churn_signal").cast("long").alias("golden_positives"),
        F.count_if(~F.coalesce(F.col("churn_signal").isin(0, 1), F.lit(False))).alias("golden_bad_labels"),
    )
    dealt = folds.groupBy("fold").count()  # one row per fold
    fold_counts = dealt.agg(
        F.sum("count").alias("fold_rows"),
        F.count_if(F.col("fold").between(0, k - 1)).alias("fold_values"),
        F.count_if(~F.coalesce(F.col("fold").between(0, k - 1), F.lit(False))).alias("fold_bad_values"),
    )
    scored = predictions.agg(
        F.count(F.lit(1)).alias("prediction_rows"),
        F.count_if(F.col("predicted_label").isNull()).alias("prediction_null_labels"),
        F.count_if(F.col("fold").isNull()).alias("prediction_null_folds"),
    )
    expected = {
        "golden_rows": n_rows,
        "golden_positives": n_positive,
        "golden_bad_labels": 0,
        "fold_rows": n_rows,
        "fold_values": k,
        "fold_bad_values": 0,
        "prediction_rows": n_rows,
        "prediction_null_labels": 0,
        "prediction_null_folds": 0,
    }
    parts = [long_form(part, [], part.columns, "check", "found") for part in (labels, fold_counts, scored)]
    report = parts[0].unionByName(parts[1]).unionByName(parts[2])
    goal = F.create_map(*(F.lit(x) for kv in expected.items() if kv[1] is not None for x in kv))
    wanted = F.try_element_at(goal, F.col("check")).cast("long")
    return report.select(
        "check", "found", wanted.alias("expected"), F.coalesce(F.col("found") == wanted, F.lit(True)).alias("ok")
    )


def require_ok(report: DataFrame) -> DataFrame:
    """The report, or an error that names the checks that failed."""
    failed = [row["check"] for row in report.filter("not ok").collect()]
    if failed:
        raise ValueError(f"dataset checks failed: {failed}")
    return report

