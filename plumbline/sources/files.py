"""CSV, JSON and Parquet in and out."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from plumbline.sources import versions
from plumbline.sources.csv_records import csv_records

_REJECT = "_rejected"
_CSV = {
    "header": "true",
    "quote": '"',
    "escape": '"',
    "ignoreLeadingWhiteSpace": "false",
    "ignoreTrailingWhiteSpace": "false",
}


def _parsed(spark: SparkSession, path: str, schema: T.StructType, multi_line: bool) -> DataFrame:
    """(record, row, fault): each record with the schema's columns as text, and what is wrong with it or null."""
    records, headers = csv_records(spark, path, multi_line)
    names = schema.fieldNames()
    for found in headers or [[]]:
        missing = [n for n in names if n not in found]
        if missing:
            raise ValueError(f"missing columns: {', '.join(missing)}")
    options = {**_CSV, "header": "false", "multiLine": "true", "mode": "PERMISSIVE", "columnNameOfCorruptRecord": _REJECT}
    read = F.lit(None)
    for number, found in enumerate(headers):
        fields = ", ".join(f"c{i} string" for i in range(len(found)))
        row = F.from_csv("record", f"{fields}, {_REJECT} string", options)
        wanted = F.struct(*(row[f"c{found.index(n)}"].alias(f"c{i}") for i, n in enumerate(names)), row[_REJECT].alias(_REJECT))
        read = F.when(F.col("header") == number, wanted).otherwise(read)
    rows = records.withColumn("row", read)
    fault = F.when(F.col("row").isNull() | F.col(f"row.{_REJECT}").isNotNull(), F.concat(F.lit("wrong number of fields: "), F.col("record")))
    for i, f in enumerate(schema.fields):
        value = F.col(f"row.c{i}")
        bad = value.isNotNull() & value.try_cast(f.dataType).isNull()
        fault = fault.when(bad, F.concat(F.lit(f"{f.name} holds "), value))
    return rows.select("record", "row", fault.alias("fault"))


def _typed(schema: T.StructType) -> list[Column]:
    return [F.col(f"row.c{i}").try_cast(f.dataType).alias(f.name) for i, f in enumerate(schema.fields)]


def csv_scan(spark: SparkSession, path: str, schema: T.StructType, multi_line: bool = True) -> DataFrame:
    """A CSV file or folder with headers, under an explicit schema; an empty field is NULL.

    Columns are found by their names in the header of each file, whatever their order; further ones are left out. A missing
    column is an error at once, a row with the wrong number of fields or a value that is not of its type when it is read, also by
    a count or by a query that leaves that column out. With `multi_line` texts may hold line breaks; either way a large file is
    read by many tasks. Row order is not kept.
    """
    rows = _parsed(spark, path, schema, multi_line)
    sound = F.when(F.col("fault").isNull(), F.lit(True)).otherwise(F.raise_error(F.col("fault")).cast("boolean"))
    return rows.where(sound).select(*_typed(schema))  # a filter, which no plan leaves out


def csv_scan_skip_errors(
    spark: SparkSession, path: str, schema: T.StructType, multi_line: bool = True
) -> tuple[DataFrame, DataFrame]:
    """Readable rows, and the text of the others instead of losing them silently.

    Columns are found by their names, as in `csv_scan`. A row is bad if it has the wrong number of fields or a field that is not
    of its column's type; every field of the schema is judged, whichever columns are selected later.
    """
    rows = _parsed(spark, path, schema, multi_line)
    kept = rows.where("fault IS NULL").select(*_typed(schema))
    return kept, rows.where("fault IS NOT NULL").select(F.col("record").alias("line"))


def write_csv(df: DataFrame, path: str) -> None:
    df.write.options(**_CSV).mode("overwrite").csv(path)


def latest_snapshot(spark: SparkSession, root: str, prefix: str) -> str:
    """Path of the snapshot whose name sorts last; an error if there is none.

    Only file names are read. One text comes to the driver.
    """
    listing = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(root).select("path")
    found = F.regexp_extract("path", rf"^(.*/\Q{prefix}\E[^/]*)", 1)
    name = F.regexp_extract(found, r"([^/]*)$", 1)
    last = listing.filter(found != "").agg(F.max(F.struct(name.alias("name"), found.alias("path")))["path"]).first()[0]
    if last is None:
        raise FileNotFoundError(f"no {prefix}* below {root}")
    return last


def replace_table(df: DataFrame, path: str) -> DataFrame:
    """Put df in place of what the table held, in one step, and read it back.

    Readers see the old table or the new one whole, and df may read the table that it replaces; old versions stay until
    `versions.drop_versions`. Read such a table with `table_scan`.
    """
    return versions.publish_version(df, path)


def append_table(df: DataFrame, path: str) -> None:
    df.write.mode("append").parquet(path)


def table_scan(spark: SparkSession, path: str, columns: list[str] | None = None) -> DataFrame:
    """A Parquet table, or the last version of one that `replace_table` wrote."""
    df = versions.read_version(spark, path) if versions.is_versioned(spark, path) else spark.read.parquet(path)
    return df.select(*columns) if columns else df


def atomic_replace_write(df: DataFrame, path: str, partition: str) -> None:
    """Replace the partitions that `df` holds; each is staged and moved into place when the job commits."""
    writer = df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    writer.partitionBy(partition).parquet(path)


def write_result_document(df: DataFrame, path: str) -> None:
    """One JSON object per row, nested columns as nested objects."""
    df.write.mode("overwrite").json(path)


def date_window_extract(df: DataFrame, column: str, since: str | None, until: str | None) -> DataFrame:
    """Rows with `since` <= date <= `until`; either end may be open. The bounds reach the file scan."""
    out = df
    if since:
        out = out.filter(F.col(column) >= F.lit(since).cast("date"))
    if until:
        out = out.filter(F.col(column) < F.date_add(F.lit(until).cast("date"), 1))
    return out


def project_rename(df: DataFrame, names: dict[str, str]) -> DataFrame:
    """Chosen columns under new names; old names may hold blanks."""
    return df.select(*(F.col(f"`{old}`").alias(new) for old, new in names.items()))


def explode_keyed_json(df: DataFrame, document: str, value_ddl: str, key: str, value: str) -> DataFrame:
    """Rows of JSON documents that map ids to values, the id as an integer; a document that is not such a map is an error.

    Read a document that spans lines with `wholetext`.
    """
    read = F.from_json(F.col(document), f"map<string,{value_ddl}>")
    message = F.concat(F.lit("not a map of ids: "), F.substring(F.col(document), 1, 80))
    failed = F.raise_error(message).cast(f"map<string,{value_ddl}>")
    entries = F.when(F.col(document).isNull() | read.isNotNull(), read).otherwise(failed)
    rows = df.select(F.explode(entries).alias("_k", value))
    return rows.select(F.col("_k").cast("bigint").alias(key), value)
