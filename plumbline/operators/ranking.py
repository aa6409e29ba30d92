"""Row numbers and running totals over one whole ordering without passing it through one task.

The ordering is cut into buckets that follow it, at least as many as the session has shuffle partitions, so that a bucket is
no more than a partition's share. A bucket table (partly aggregated in the map tasks) gives each bucket the total of all earlier
ones; a window inside the bucket adds the rest. Totals of many buckets are added up in a tree: no window sees more than
`FAN` rows of a group at a level. A hot group is spread over all its buckets, so it never lands in one task.
"""

from __future__ import annotations

from math import ceil, log

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from plumbline.functions.text import id_hash

FAN = 256  # children of a node in the tree of bucket totals
MAX_PARTIAL_LIMIT = 1000  # largest literal bound for which Spark cuts each group inside the map tasks


def _group_key(by: list[str]) -> Column:
    """One non-null text per group, so that groups with NULLs are joined like any other."""
    if not by:
        return F.lit("")
    parts = (F.coalesce(F.concat(F.lit("v"), F.col(c).cast("string")), F.lit("n")) for c in by)
    return F.concat_ws("\x1f", *parts)


def width(spark: SparkSession) -> int:
    """How many parts an ordering is cut into at least."""
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def _earlier(totals: DataFrame, names: list[str], buckets: int) -> DataFrame:
    """(_g, _b, _o_name): what the group's earlier buckets have together, added up in a tree."""
    before = Window.partitionBy("_g").orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    own = lambda over: {f"_o_{n}": F.coalesce(F.sum(f"_t_{n}").over(over), F.lit(0)) for n in names}
    if buckets <= FAN:
        return totals.withColumns(own(before)).select("_g", "_b", *(f"_o_{n}" for n in names))
    leaves = totals.withColumn("_c", F.floor(F.col("_b") / FAN).cast("int"))
    nodes = leaves.groupBy("_g", F.col("_c").alias("_b")).agg(*(F.sum(f"_t_{n}").alias(f"_t_{n}") for n in names))
    above = _earlier(nodes, names, ceil(buckets / FAN)).select("_g", F.col("_b").alias("_c"), *(F.col(f"_o_{n}").alias(f"_a_{n}") for n in names))
    inside = Window.partitionBy("_g", "_c").orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    joined = leaves.withColumns(own(inside)).join(above, ["_g", "_c"])
    return joined.select("_g", "_b", *((F.col(f"_o_{n}") + F.col(f"_a_{n}")).alias(f"_o_{n}") for n in names))


def running_totals(
    df: DataFrame,
    by: list[str],
    bucket: Column,
    buckets: int,
    order: list[Column],
    measures: dict[str, Column],
    across_groups: bool = False,
    extra: DataFrame | None = None,
) -> DataFrame:
    """Add, per measure, the total over all rows before and including this one.

    `bucket` is a number below `buckets` that does not decrease along `order` inside a group. With `across_groups` the
    totals run on from one group to the next, in the order of `by`. `extra` holds further columns per `by`, to be attached
    on the way.
    """
    keyed = df.withColumns({"_g": _group_key(by), "_b": bucket.cast("int")})
    sums = [F.sum(value).alias(f"_t_{name}") for name, value in measures.items()]
    totals = keyed.groupBy("_g", "_b", *by).agg(*sums)
    offsets = _earlier(totals.drop(*by), list(measures), buckets)
    if across_groups:
        groups = totals.groupBy("_g", *by).agg(*(F.sum(f"_t_{m}").alias(f"_t_{m}") for m in measures))
        earlier = Window.partitionBy(F.lit(0)).orderBy(*by).rowsBetween(Window.unboundedPreceding, -1)  # one row per group
        starts = groups.select("_g", *(F.coalesce(F.sum(f"_t_{m}").over(earlier), F.lit(0)).alias(f"_s_{m}") for m in measures))
        offsets = offsets.join(starts, "_g").select("_g", "_b", *((F.col(f"_o_{m}") + F.col(f"_s_{m}")).alias(f"_o_{m}") for m in measures))
    carried = []
    if extra is not None:
        # by the group's text, so that a group with a NULL keeps its rows
        offsets = offsets.join(extra.withColumn("_g", _group_key(by)).drop(*by), "_g")
        carried = [c for c in extra.columns if c not in by]
    offsets = offsets.select("_g", "_b", *(f"_o_{m}" for m in measures), *carried)
    inside = Window.partitionBy("_g", "_b").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    local = keyed.withColumns({m: F.sum(value).over(inside) for m, value in measures.items()})
    joined = local.join(offsets, ["_g", "_b"])
    return joined.withColumns({m: F.col(m) + F.col(f"_o_{m}") for m in measures}).drop(
        "_g", "_b", *(f"_o_{m}" for m in measures)
    )


def hash_ranked(
    df: DataFrame,
    key: str,
    by: tuple[str, ...] | list[str] = (),
    seed: str | None = None,
    across_groups: bool = False,
    extra: DataFrame | None = None,
    name: str = "rank",
) -> DataFrame:
    """1-based position of every row in its group, in the order of the hash of its id.

    `key` must tell the rows apart. A seed gives another, equally stable order.
    """
    hashed = df.withColumn("_h", seeded_hash(key, seed))
    digits = max(1, ceil(log(width(df.sparkSession), 16)))
    out = running_totals(
        hashed,
        list(by),
        F.conv(F.substring("_h", 1, digits), 16, 10),
        16**digits,
        [F.col("_h"), F.col(key)],
        {name: F.lit(1).cast("long")},
        across_groups,
        extra,
    )
    return out.drop("_h")


def seeded_hash(key: str, seed: str | None) -> Column:
    if seed is None:
        return id_hash(F.col(key))
    return F.md5(F.concat(F.lit(f"{seed}:"), F.col(key).cast("string")))


def range_cuts(df: DataFrame, column: str) -> list[float]:
    """Cut points that split a numeric column into about equal parts, twice as many as shuffle partitions."""
    buckets = 2 * width(df.sparkSession)
    shares = [i / buckets for i in range(1, buckets)]
    found = df.stat.approxQuantile(column, shares, 0.5 / buckets)
    return sorted(set(found))


def range_bucket(df: DataFrame, column: str, cuts: list[float], name: str = "_range") -> DataFrame:
    """Number of the part that a value falls in; equal values always share one."""
    staged = df.withColumn("_as_double", F.col(column).cast("double"))
    bounds = [float("-inf"), *cuts, float("inf")]
    bucketizer = Bucketizer(splits=bounds, inputCol="_as_double", outputCol=name, handleInvalid="keep")
    return bucketizer.transform(staged).drop("_as_double")


def order_ranked(df: DataFrame, key: str, name: str = "rank") -> DataFrame:
    """1-based position of every row in the order of a numeric id."""
    cuts = range_cuts(df, key)
    bucketed = range_bucket(df, key, cuts)
    ranked = running_totals(bucketed, [], F.col("_range"), len(cuts) + 2, [F.col(key)], {name: F.lit(1).cast("long")})
    return ranked.drop("_range")


def top_per_group(df: DataFrame, by: list[str], order: list[Column], n: int) -> DataFrame:
    """The first `n` rows of every group, exactly, reading the input once.

    Each map task keeps its own first `n` rows of a group, groups of tasks merge theirs, then the group is cut
    once more. No task sees more than a bounded multiple of `n` rows of a group, however large the group is.
    """
    if n > MAX_PARTIAL_LIMIT:
        raise ValueError(f"top_per_group keeps at most {MAX_PARTIAL_LIMIT} rows of a group; rank the rows instead")
    by_task = F.pmod(F.spark_partition_id(), F.lit(256))
    first = Window.partitionBy(*by, "_task").orderBy(*order)
    last = Window.partitionBy(*by).orderBy(*order)
    merged = df.withColumn("_task", by_task).withColumn("_n", F.row_number().over(first)).filter(F.col("_n") <= n)
    return merged.withColumn("_n", F.row_number().over(last)).filter(F.col("_n") <= n).drop("_n", "_task")

