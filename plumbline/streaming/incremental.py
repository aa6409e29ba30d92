"""Incremental jobs: resumed appends, monthly drops, repeatable reruns, retries of missing rows."""

from __future__ import annotations

import time
import uuid
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from plumbline.operators.joins import anti_join_todo, latest_per_key
from plumbline.operators.responses import attach_proposals
from plumbline.sources.files import append_table, replace_table
from plumbline.sources.versions import append_part, read_parts


def table_or_empty(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """The table at a path; before the first write an empty one."""
    from pyspark.errors import AnalysisException

    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def resume_append(
    source: DataFrame, target: str, work: Callable[[DataFrame], DataFrame], key: str, schema: T.StructType, slices: int = 1
) -> DataFrame:
    """Do the rows whose id the target lacks and append their results; a rerun goes on where the last one ended.

    The rows are done in `slices` parts by hash of the id. A part counts once its files are complete, so a run that is
    stopped keeps all parts that it finished, and what it left of the next one is never read.
    """
    spark = source.sparkSession
    run = uuid.uuid4().hex
    done = read_parts(spark, target, schema)
    for number in range(slices):
        own = source.filter(F.pmod(F.xxhash64(key), F.lit(slices)) == number) if slices > 1 else source
        append_part(work(anti_join_todo(own, done, key)).select(*schema.fieldNames()), target, f"part-{run}-{number:06d}")
    return read_parts(spark, target, schema)


def stream_append(
    spark: SparkSession, source: str, schema: T.StructType, target: str, checkpoint: str, work: Callable[[DataFrame], DataFrame]
) -> DataFrame:
    """The same as a file stream: the checkpoint remembers which files are done, each run takes the new ones."""
    stream = work(spark.readStream.schema(schema).parquet(source))
    query = (
        stream.writeStream.format("parquet")
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start(target)
    )
    query.awaitTermination()
    return spark.read.parquet(target)


def monthly_drop_ingest(
    spark: SparkSession, source: str, schema: T.StructType, target: str, checkpoint: str, key: str, version: str
) -> DataFrame:
    """Fold new drops into a table with one row per id, the one of the latest drop.

    Each drop is appended under its batch number, so a repeated batch overwrites only its own part and no batch
    rewrites the table; readers take the latest row per id.
    """

    def land(batch: DataFrame, number: int) -> None:
        latest = latest_per_key(batch, key, version)
        part = latest.withColumn("batch", F.lit(number).cast("long"))
        part.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("batch").parquet(target)

    query = (
        spark.readStream.schema(schema)
        .parquet(source)
        .writeStream.foreachBatch(land)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return latest_per_key(spark.read.parquet(target).drop("batch"), key, version)


def idempotent_rerun(job: Callable[[], DataFrame], target: str) -> DataFrame:
    """Run a job and put its result in place of the last one; running it again gives the same table."""
    return replace_table(job(), target)


def retry_missing(
    template: DataFrame, target: str, ask: Callable[[DataFrame], DataFrame], key: str, model: str, schema: T.StructType
) -> DataFrame:
    """Ask for every row without a proposal, append what came back, and return what is still missing."""
    spark = template.sparkSession
    todo = anti_join_todo(template, table_or_empty(spark, target, schema), key)
    labelled, _ = attach_proposals(todo, ask(todo), key, model)
    append_table(labelled.select(*schema.fieldNames()), target)
    return anti_join_todo(template, spark.read.schema(schema).parquet(target), key)


def score_with(
    df: DataFrame,
    scorer: Callable[[pd.DataFrame], pd.DataFrame],
    schema: str | T.StructType,
    attempts: int = 3,
    delay_s: float = 8.0,
    retry_on: tuple[type[Exception], ...] = (ConnectionError, TimeoutError, OSError),
) -> DataFrame:
    """Apply any Python scorer to batches of rows; a failing batch is tried again, then fails the task.

    Spark repeats a failed task on its own, so a lost executor costs only its open batches.
    """

    def scored(batch: pd.DataFrame) -> pd.DataFrame:
        for attempt in range(1, attempts + 1):
            try:
                return scorer(batch)
            except retry_on:
                if attempt == attempts:
                    raise
                time.sleep(delay_s)
        raise ValueError("attempts must be 1 or more")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        return map(scored, batches)

    return df.mapInPandas(run, schema)
