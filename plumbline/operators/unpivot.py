"""Wide one-row reports as rows."""

from __future__ import annotations

from pyspark.sql import DataFrame


def long_form(df: DataFrame, ids: list[str], values: list[str], name: str, value: str) -> DataFrame:
    """One row per value column, without a shuffle."""
    return df.unpivot(ids, values, name, value).select(*ids, name, value)
