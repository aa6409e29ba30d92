"""What was loaded: rows, columns, types."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plumbline.operators.unpivot import long_form


def ingest_profile(tables: dict[str, DataFrame]) -> DataFrame:
    """Rows and columns per table."""
    rows = [
        df.agg(F.count(F.lit(1)).alias("n_rows")).select(
            F.lit(name).alias("table_name"), "n_rows", F.lit(len(df.columns)).cast("long").alias("n_columns")
        )
        for name, df in tables.items()
    ]
    return reduce(DataFrame.unionByName, rows)


def describe_table(df: DataFrame) -> DataFrame:
    """Name, type and number of values of every column, from one pass."""
    counts = df.agg(*(F.count(c).alias(c) for c in df.columns))
    types = F.create_map(*(F.lit(x) for pair in df.dtypes for x in pair))
    rows = long_form(counts, [], df.columns, "column_name", "n_values")
    return rows.select("column_name", F.element_at(types, F.col("column_name")).alias("column_type"), "n_values")
