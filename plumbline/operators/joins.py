"""Joins of labels, folds, predictions and responses by id, and set operations on ids."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from plumbline.functions.text import word_set


def label_fold_join(golden: DataFrame, folds: DataFrame, key: str) -> DataFrame:
    return golden.join(folds.select(key, "fold"), key)


def label_prediction_join(golden: DataFrame, preds: DataFrame, key: str, columns: list[str]) -> DataFrame:
    return golden.join(preds.select(key, *columns), key)


def anti_join_todo(df: DataFrame, done: DataFrame, key: str) -> DataFrame:
    """Rows whose id is not done yet."""
    return df.join(done.select(key), key, "left_anti")


def semi_join_ids(df: DataFrame, ids: DataFrame, key: str) -> tuple[DataFrame, DataFrame]:
    """Rows whose id is listed, and the others."""
    listed = ids.select(key)
    return df.join(listed, key, "left_semi"), df.join(listed, key, "left_anti")


def proposal_match(batch: DataFrame, proposals: DataFrame, key: str) -> tuple[DataFrame, DataFrame]:
    """Batch rows with their proposal, and those without one. `proposals` holds `id`, `position` and payload
    columns; the last position of an id counts, ids outside the batch are ignored."""
    payload = [c for c in proposals.columns if c not in ("id", "position")]
    latest = proposals.groupBy("id").agg(F.max_by(F.struct(*payload), F.col("position")).alias("_p"))
    found = batch.join(latest.withColumnRenamed("id", key), key, "left")
    matched = found.filter(F.col("_p").isNotNull()).select(*batch.columns, *(f"_p.{c}" for c in payload))
    return matched, found.filter(F.col("_p").isNull()).select(*batch.columns)


def raise_unless(sound: Column, message: Column) -> Column:
    """A filter's condition that holds for every row, or fails the job.

    It counts as changing from row to row, so that the optimizer neither tries it on made-up rows nor moves it.
    """
    return F.when(sound | (F.rand() < 0), F.lit(True)).otherwise(F.raise_error(message).cast("boolean"))


def strict_lookup_join(df: DataFrame, dim: DataFrame, key: str, columns: list[str]) -> DataFrame:
    """Rows with the looked-up columns; the job fails on the first id that the lookup side lacks.

    The check is a filter above the join, so a count or a select of other columns runs it too.
    """
    looked = df.join(dim.select(key, *columns, F.lit(True).alias("_hit")), key, "left")
    message = F.concat(F.lit(f"no entry for {key} "), F.coalesce(F.col(key).cast("string"), F.lit("NULL")))
    return looked.filter(raise_unless(F.coalesce("_hit", F.lit(False)), message)).drop("_hit")


def attach_narrative(preds: DataFrame, golden: DataFrame, key: str) -> DataFrame:
    return strict_lookup_join(preds, golden, key, ["narrative"])


def pair_overlap(df: DataFrame, group: str, text: str) -> DataFrame:
    """Over all unordered pairs of rows in a group: how many there are, how many words they share in total and
    how many pairs hold the same text.

    Counted from per-word and per-text totals, so no pair is ever formed: a word held by c rows is shared by
    c(c-1)/2 pairs.
    """

    def pairs(n: Column) -> Column:
        return (n * (n - 1) / 2).cast("long")

    rows = df.groupBy(group).agg(pairs(F.count(F.lit(1))).alias("n_pairs"))
    words = df.select(group, F.explode(word_set(F.col(text))).alias("word"))
    held = words.groupBy(group, "word").agg(F.count(F.lit(1)).alias("c"))
    shared = held.groupBy(group).agg(F.sum(pairs(F.col("c"))).alias("shared_words"))
    copies = df.groupBy(group, text).agg(F.count(F.lit(1)).alias("c"))
    same = copies.groupBy(group).agg(F.sum(pairs(F.col("c"))).alias("same_text_pairs"))
    joined = rows.join(shared, group, "left").join(same, group, "left")
    return joined.fillna(0, ["shared_words", "same_text_pairs"])


def candidate_pairing(a: DataFrame, b: DataFrame, key: str, text: str) -> DataFrame:
    """Two candidates of an id in both orders: forward (a, b) and swapped (b, a)."""
    left = a.select(key, F.col(text).alias("_a"))
    both = left.join(b.select(key, F.col(text).alias("_b")), key)
    forward = F.struct(F.lit("forward").alias("order"), F.col("_a").alias("candidate_a"), F.col("_b").alias("candidate_b"))
    swapped = F.struct(F.lit("swapped").alias("order"), F.col("_b").alias("candidate_a"), F.col("_a").alias("candidate_b"))
    return both.select(key, F.inline(F.array(forward, swapped)))


def paired_condition_join(df: DataFrame, key: list[str], condition: str, value: str, names: tuple[str, str]):
    """The value of an id under two conditions side by side, for the ids that have both; one shuffle."""
    first, second = (F.max(F.when(F.col(condition) == c, F.col(value))).alias(c) for c in names)
    pairs = df.filter(F.col(condition).isin(*names)).groupBy(*key).agg(first, second)
    return pairs.filter(F.col(names[0]).isNotNull() & F.col(names[1]).isNotNull())


def sweep_expand(prompts: DataFrame, values: list[float], n_repeats: int) -> DataFrame:
    """Every prompt once per parameter value and repeat 1..n; both lists are parameters, so nothing is shuffled."""
    each = prompts.withColumn("value", F.explode(F.array(*(F.lit(v) for v in values))))
    return each.withColumn("repeat", F.explode(F.sequence(F.lit(1), F.lit(n_repeats))))


def model_availability_filter(wanted: DataFrame, catalogue: DataFrame, key: str) -> DataFrame:
    """Requested models with a flag whether the catalogue has them."""
    listed = catalogue.select(key).distinct().withColumn("_hit", F.lit(True))
    found = wanted.join(listed, key, "left")
    return found.withColumn("available", F.coalesce(F.col("_hit"), F.lit(False))).drop("_hit")


def in_vocabulary(df: DataFrame, value: str, vocabulary: tuple[str, ...]) -> DataFrame:
    """Flag whether the value belongs to a closed vocabulary given as a parameter."""
    return df.withColumn("in_vocabulary", F.coalesce(F.col(value).isin(*vocabulary), F.lit(False)))


def id_difference(all_ids: DataFrame, done: DataFrame, key: str) -> DataFrame:
    """Distinct ids that are not done."""
    return all_ids.select(key).subtract(done.select(key))


def set_equality_check(a: DataFrame, b: DataFrame, key: str) -> DataFrame:
    """Ids only in one of two sets, counted: equal sets give two zeros."""
    tagged = a.select(key, F.lit(1).alias("in_a"), F.lit(0).alias("in_b")).unionByName(
        b.select(key, F.lit(0).alias("in_a"), F.lit(1).alias("in_b"))
    )
    sides = tagged.groupBy(key).agg(F.max("in_a").alias("in_a"), F.max("in_b").alias("in_b"))
    only_a = F.count_if((F.col("in_a") == 1) & (F.col("in_b") == 0))
    only_b = F.count_if((F.col("in_a") == 0) & (F.col("in_b") == 1))
    return sides.agg(only_a.alias("only_in_a"), only_b.alias("only_in_b")).withColumn(
        "equal", (F.col("only_in_a") == 0) & (F.col("only_in_b") == 0)
    )


def append_results(old: DataFrame, new: DataFrame) -> DataFrame:
    return old.unionByName(new)


def latest_per_key(df: DataFrame, key: str, version: str) -> DataFrame:
    """One row per id, the one with the highest version; partly aggregated before the shuffle."""
    others = [c for c in df.columns if c != key]
    kept = df.groupBy(key).agg(F.max_by(F.struct(*others), F.col(version)).alias("_row"))
    return kept.select(key, *(f"_row.{c}" for c in others))


def numbered(df: DataFrame, by: list[str], order: list[Column], name: str) -> DataFrame:
    """Position in a group whose size is bounded by its definition."""
    return df.withColumn(name, F.row_number().over(Window.partitionBy(*by).orderBy(*order)))
