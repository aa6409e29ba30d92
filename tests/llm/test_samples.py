from pyspark.sql import functions as F

from plumbline.llm.sampling import smallest_hashes


def test_sample_is_the_smallest_hashes(spark):
    df = spark.range(30_000).withColumnRenamed("id", "doc_id")
    wanted = {r[0] for r in df.orderBy(F.xxhash64(F.lit("s"), "doc_id")).limit(700).collect()}
    assert {r[0] for r in smallest_hashes(df, "s", "doc_id", 700, 30_000).collect()} == wanted
    assert smallest_hashes(df, "s", "doc_id", 40_000, 30_000).count() == 30_000
    assert smallest_hashes(df.limit(0), "s", "doc_id", 5, 0).count() == 0
