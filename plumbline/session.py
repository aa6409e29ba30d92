"""Session defaults shared by the tests and the bench."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def build_session(app: str, master: str | None = None, **conf: str) -> SparkSession:
    """A session with adaptive execution on and UTC timestamps; `conf` entries win over the defaults.

    Shuffle partitions are left to the cluster's own setting unless the caller gives them: adaptive
    execution coalesces small ones, so a large initial number is the safe choice for large inputs.
    """
    settings = {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
        **conf,
    }
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def spread(scan: DataFrame) -> DataFrame:
    """A file scan with at least one partition per core, for work that costs far more than moving the rows.

    Only inputs with fewer splits than cores are moved; a large table has many more splits and stays as it is.
    Give it a plain scan: the number of partitions is then known without running anything.
    """
    cores = scan.sparkSession.sparkContext.defaultParallelism
    return scan.repartition(cores) if scan.rdd.getNumPartitions() < cores else scan
