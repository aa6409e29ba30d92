"""From documents to packed training sequences: five stages, each written and read again by the next."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from plumbline.llm.catalog import ship
from plumbline.llm.decontamination import drop_leaking
from plumbline.llm.line_dedup import REMOVED, remove_repeats
from plumbline.llm.near_texts import one_of_each
from plumbline.llm.packing import digests, pack
from plumbline.llm.toxicity import keep_clean
from plumbline.storage import run_folder


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are predicted toxic go."""
    ship(spark)
    return keep_clean(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages that stand in an earlier document go from the texts; n_chars counts what is left. No document goes."""
    ship(spark)
    done = remove_repeats(docs)
    if "n_chars" in docs.columns:
        counted = F.when(F.col(REMOVED) > 0, F.length("text").cast("bigint")).otherwise(F.col("n_chars"))
        done = done.withColumn("n_chars", counted.cast(docs.schema["n_chars"].dataType))
    return done.select(*docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents that are near copies (five-word shingles, Jaccard 0.8), the one with the smallest id stays."""
    ship(spark)
    return one_of_each(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a passage of the benchmark go."""
    ship(spark)
    return drop_leaking(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row per piece of a document in a training sequence."""
    import public_tokenizers

    ship(spark)
    return digests(pack(docs, public_tokenizers.path("byte_bpe_50k.json")))


STAGES = [
    ("toxicity", toxicity),
    ("line dedup", line_dedup),
    ("SimHash near-dedup", near_duplicates),
    ("benchmark decontamination", decontamination),
    ("packing", packing),
]

#: The stages learn, hash and tokenize; SQL cannot express them.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents; what a stage returns is written before the next one starts."""
    folder = run_folder(spark, "pipeline")
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for number, (_, stage) in enumerate(STAGES):
        path = f"{folder}/{number}.parquet"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
