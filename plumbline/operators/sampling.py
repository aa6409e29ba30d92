"""Deterministic samples, folds, splits and batches. All orders come from hashes of ids, never from row order."""

from __future__ import annotations

from functools import reduce
from math import ceil, log

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from plumbline.operators.ranking import hash_ranked, order_ranked, seeded_hash, width


def narrative_filter(df: DataFrame, text: str, shortest: int, longest: int) -> DataFrame:
    """Rows with a text of `shortest` to `longest` characters, both ends included."""
    return df.filter(F.col(text).isNotNull() & F.length(text).between(shortest, longest))


def equals(df: DataFrame, column: str, value) -> DataFrame:
    return df.filter(F.col(column) == F.lit(value))


def hash_thresholds(df: DataFrame, stratum: str, quotas: dict[str, int], key: str, sorted_rows: int = 10_000) -> dict[str, str | None]:
    """Per stratum the hash of the last row that its quota takes, None if it takes all; strata without rows are left out.

    Rows are counted by the first digits of their hash; the digits in which the quota ends are refined, those rows alone being
    counted again, until at most `sorted_rows` rows of a stratum are left to be sorted. Counts are added up in the map tasks,
    and one row a stratum reaches the driver each time.
    """
    digits = max(2, ceil(log(width(df.sparkSession), 16)))
    hashed = df.select(F.col(stratum).alias("s"), seeded_hash(key, None).alias("h"))
    edges, need = {s: "" for s in quotas}, {s: n for s, n in quotas.items() if n > 0}
    found: dict[str, str | None] = {s: "" for s, n in quotas.items() if n <= 0}
    length, ready = 0, {}

    def inside(strata):
        return reduce(lambda a, b: a | b, ((F.col("s") == s) & F.col("h").startswith(edges[s]) for s in strata))

    while need:
        length = min(32, length + digits)
        counts = hashed.filter(inside(need)).groupBy("s", F.substring("h", 1, length).alias("p")).agg(F.count(F.lit(1)).alias("n"))
        upto = F.sum("n").over(Window.partitionBy("s").orderBy("p"))
        last = F.max("upto").over(Window.partitionBy("s"))
        wanted = _lookup(F.col("s"), need)
        steps = counts.withColumn("upto", upto).withColumn("all", last).withColumn("wanted", wanted)
        edge = steps.filter((F.col("upto") >= F.least("wanted", "all")) & (F.col("upto") - F.col("n") < F.least("wanted", "all")))
        rows = edge.collect()
        for s in set(need) - {r["s"] for r in rows}:
            need.pop(s)
        for r in rows:
            s = r["s"]
            if r["all"] <= need[s]:
                found[s] = None
                need.pop(s)
                continue
            edges[s], need[s] = r["p"], need[s] - (r["upto"] - r["n"])
            if r["n"] <= sorted_rows or length == 32:
                ready[s] = need.pop(s)
    if ready:
        place = F.row_number().over(Window.partitionBy("s").orderBy("h"))
        ends = hashed.filter(inside(ready)).withColumn("n", place).filter(F.col("n") == _lookup(F.col("s"), ready))
        found |= {r["s"]: r["h"] for r in ends.collect()}
    return found


def hash_ordered_sample(df: DataFrame, stratum: str, quotas: dict[str, int], key: str) -> DataFrame:
    """Per stratum the first rows by hash of the id, as many as its quota; a larger quota only adds rows.

    The sample is a filter on df: hashes up to the threshold that `hash_thresholds` finds. Ids must tell rows apart; rows
    with one id are taken or left together. Strata that are not in `quotas`, and null ones, are left out.
    """
    ends = hash_thresholds(df, stratum, quotas, key)
    hashed = seeded_hash(key, None)
    kept = ((F.col(stratum) == s) & (F.lit(True) if h is None else hashed <= h) for s, h in ends.items())
    return df.filter(reduce(lambda a, b: a | b, kept, F.lit(False)))


def _lookup(value: Column, table: dict[str, int]) -> Column:
    branches = list(table.items())
    first = F.when(value == branches[0][0], F.lit(branches[0][1]))
    return reduce(lambda acc, kv: acc.when(value == kv[0], F.lit(kv[1])), branches[1:], first)


def seeded_sample(df: DataFrame, key: str, n: int, seed: int | str) -> DataFrame:
    """`n` rows without replacement, the same ones for the same seed."""
    return df.orderBy(seeded_hash(key, str(seed)), key).limit(n)


def ordered_limit(df: DataFrame, key: str, n: int) -> DataFrame:
    return df.orderBy(key).limit(n)


def first_n_sample(df: DataFrame, order: list[str], n: int) -> DataFrame:
    """The first `n` rows of an explicit order."""
    return df.orderBy(*order).limit(n)


def sort_head_desc(df: DataFrame, value: str, n: int, tie_break: str) -> DataFrame:
    """The `n` largest values; ties go by the tie-break column."""
    return df.orderBy(F.desc(value), F.asc(tie_break)).limit(n)


def sort_for_publish(df: DataFrame, key: str) -> DataFrame:
    """Rows in id order; a range-partitioned sort, so the files of a later write follow the order."""
    return df.orderBy(key)


def stratified_kfold(df: DataFrame, key: str, label: str, k: int) -> DataFrame:
    """`(key, label, fold)`, the label-sorted rows dealt to the folds in turn.

    Every id gets one fold; class counts and fold sizes differ by at most 1 between folds. Only the id and the
    label are shuffled, so a wide table is joined back by id.
    """
    narrow = df.select(key, label)
    ranked = hash_ranked(narrow, key, [label], across_groups=True, name="_n")
    return ranked.select(key, label, ((F.col("_n") - 1) % k).cast("int").alias("fold"))


def test_quotas(df: DataFrame, label: str, fraction: float) -> DataFrame:
    """Rows per class that go to the test part: floor of the share, what is left to the largest remainders."""
    counts = df.groupBy(label).agg(F.count(F.lit(1)).alias("_n_class"))
    whole = Window.partitionBy(F.lit(0))  # one row per class
    shared = counts.withColumn("_n_all", F.sum("_n_class").over(whole))
    shared = shared.withColumn("_n_test", F.ceil(F.lit(fraction) * F.col("_n_all")))
    product = F.col("_n_test") * F.col("_n_class")
    shared = shared.withColumns({"_base": F.floor(product / F.col("_n_all")), "_rest": product % F.col("_n_all")})
    turn = F.row_number().over(whole.orderBy(F.desc("_rest"), F.asc(label)))
    missing = F.col("_n_test") - F.sum("_base").over(whole)
    quota = F.col("_base") + F.when(turn <= missing, 1).otherwise(0)
    return shared.select(label, quota.alias("_quota"))


def stratified_split(df: DataFrame, key: str, label: str, fraction: float) -> DataFrame:
    """`(key, label, part)` with an exact number of test rows in total and per class."""
    narrow = df.select(key, label)
    quotas = test_quotas(narrow, label, fraction)
    ranked = hash_ranked(narrow, key, [label], extra=quotas, name="_n")
    part = F.when(F.col("_n") <= F.col("_quota"), F.lit("test")).otherwise(F.lit("train"))
    return ranked.select(key, label, part.alias("part"))


def batch_assign(df: DataFrame, key: str, size: int) -> DataFrame:
    """Consecutive batches of `size` rows in id order, numbered from 0."""
    ranked = order_ranked(df, key, "_n")
    at = F.col("_n") - 1
    columns = {"batch": F.floor(at / size).cast("long"), "position": (at % size).cast("int")}
    return ranked.withColumns(columns).drop("_n")


def fold_holdout(df: DataFrame, k: int) -> DataFrame:
    """Every row once per fold number, as a test row of its own fold and a train row of the others."""
    each = df.withColumn("held_out", F.explode(F.sequence(F.lit(0), F.lit(k - 1))))
    role = F.when(F.col("fold") == F.col("held_out"), F.lit("test")).otherwise(F.lit("train"))
    return each.withColumn("role", role)


def union_strata(frames: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)
