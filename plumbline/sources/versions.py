"""Tables whose content changes in one step: data lands in a folder of its own, then an empty file with its name is created.

Creating a file is one step in every store that Spark writes to, and it is all that a reader looks for. So readers see a
folder whole or not at all, whatever a job that is still running, or was stopped, has left beside it.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

MARKS = "_marks"


def _store(spark: SparkSession, path: str):
    """The file system of a path and the path as it knows it."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()), place


def marks(spark: SparkSession, path: str) -> list[str]:
    """The names that were marked in a folder, in order; none if there is no such folder."""
    store, place = _store(spark, f"{path}/{MARKS}")
    if not store.exists(place):
        return []
    names = (status.getPath().getName() for status in store.listStatus(place))
    return sorted(n for n in names if not n.startswith((".", "_")))


def mark(spark: SparkSession, path: str, name: str) -> None:
    store, place = _store(spark, f"{path}/{MARKS}/{name}")
    store.create(place, False).close()


def _version(name: str) -> tuple[int, str]:
    number, _, folder = name.partition(".")
    return int(number), folder


def is_versioned(spark: SparkSession, path: str) -> bool:
    return bool(marks(spark, path))


def versions(spark: SparkSession, path: str) -> list[int]:
    return [_version(n)[0] for n in marks(spark, path)]


def read_version(spark: SparkSession, path: str, number: int | None = None) -> DataFrame:
    """One version of a table, the last one by default. The frame stays with that version, whatever is published later."""
    known = [_version(n) for n in marks(spark, path)]
    found = [folder for n, folder in known if number is None or n == number]
    if not found:
        raise FileNotFoundError(f"no version {'' if number is None else number} of {path}")
    return spark.read.parquet(f"{path}/{found[-1]}")


def publish_version(df: DataFrame, path: str) -> DataFrame:
    """Write df as the next version of the table, and read it back; df may read the table itself.

    Of two jobs that publish at the same time the later one fails and its version is not seen.
    """
    spark = df.sparkSession
    number = max(versions(spark, path), default=0) + 1
    folder = f"data-{uuid.uuid4().hex}"
    df.write.parquet(f"{path}/{folder}")
    if max(versions(spark, path), default=0) >= number:
        raise RuntimeError(f"version {number} of {path} was published meanwhile")
    mark(spark, path, f"{number:012d}.{folder}")
    return spark.read.parquet(f"{path}/{folder}")


def drop_versions(spark: SparkSession, path: str, keep: int = 1) -> None:
    """Delete all but the last versions, and what stopped jobs left; not while other jobs read or write the table."""
    names = marks(spark, path)
    kept = {_version(n)[1] for n in names[len(names) - keep :]}
    for name in names[: len(names) - keep]:
        store, place = _store(spark, f"{path}/{MARKS}/{name}")
        store.delete(place, False)
    store, root = _store(spark, path)
    for status in store.listStatus(root):
        name = status.getPath().getName()
        if name.startswith("data-") and name not in kept:
            store.delete(status.getPath(), True)


def append_part(df: DataFrame, path: str, name: str) -> None:
    """Add a part to a table of parts; a part of that name that was left unfinished is replaced."""
    df.write.mode("overwrite").parquet(f"{path}/{name}")
    mark(df.sparkSession, path, name)


def read_parts(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """All finished parts; before the first one an empty table."""
    names = marks(spark, path)
    if not names:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(*(f"{path}/{n}" for n in names))
