"""How alike the outputs of one setting are."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plumbline.functions.numbers import rounded
from plumbline.functions.text import jaccard, word_set

BLOCK = 64  # expected word sets per block


def _pair_sum(left: Column, right: Column, same_block: Column) -> Column:
    """Sum of m_a * m_b * jaccard(a, b) over the pairs of two blocks; inside one block each pair once."""

    def row_sum(a: Column) -> Column:
        weight = a["m"] * F.lit(1.0)
        return F.aggregate(
            right,
            F.lit(0.0),
            lambda acc, b: acc
            + F.when(~same_block | (a["id"] < b["id"]), weight * b["m"] * jaccard(a["words"], b["words"])).otherwise(0.0),
        )

    return F.aggregate(left, F.lit(0.0), lambda acc, a: acc + row_sum(a))


def diversity_stats(df: DataFrame, setting: str, text: str, digits: int = 4) -> DataFrame:
    """Per setting the outputs, the distinct ones and the mean word overlap over all unordered pairs (1 if none).

    Outputs with the same words are merged first and weigh by their number, so copies cost nothing. The mean over
    all pairs of different word sets has no shorter form, so it is taken block against block: a setting with many
    word sets is dealt to ever more blocks of bounded size, each pair of blocks is one small task item, and only
    its sum leaves it.
    """
    outputs = df.groupBy(setting, text).agg(F.count(F.lit(1)).alias("copies"))
    counts = outputs.groupBy(setting).agg(
        F.count(F.lit(1)).alias("distinct_outputs"), F.sum("copies").cast("long").alias("n")
    )
    sets = (
        outputs.withColumn("words", F.sort_array(word_set(F.col(text))))
        .groupBy(setting, "words")
        .agg(F.sum("copies").alias("m"))
    )
    n_sets = sets.groupBy(setting).agg(
        F.ceil(F.count(F.lit(1)) / BLOCK).cast("int").alias("n_blocks"),
        F.sum(F.col("m") * (F.col("m") - 1) / 2).alias("within_sum"),
    )
    # Blocks are joined on the setting, whose own aggregate has the same partitioning.
    identity = F.sha2(F.concat_ws(" ", "words"), 256)
    placed = sets.join(n_sets.select(setting, "n_blocks"), setting).select(
        setting,
        "n_blocks",
        F.pmod(F.xxhash64("words"), F.col("n_blocks")).cast("int").alias("block"),
        F.struct(identity.alias("id"), "words", "m").alias("item"),
    )
    met = placed.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("n_blocks") - 1)))
    pairs = met.groupBy(
        setting, F.least("block", "other").alias("low"), F.greatest("block", "other").alias("high")
    ).agg(
        F.collect_list(F.when(F.col("block") == F.least("block", "other"), F.col("item"))).alias("left_items"),
        F.collect_list(F.when(F.col("block") == F.greatest("block", "other"), F.col("item"))).alias("right_items"),
    )
    across = pairs.groupBy(setting).agg(
        F.sum(_pair_sum(F.col("left_items"), F.col("right_items"), F.col("low") == F.col("high"))).alias("across_sum")
    )
    total = counts.join(n_sets, setting).join(across, setting)
    n_pairs = F.col("n") * (F.col("n") - 1) / 2
    mean = F.when(n_pairs == 0, F.lit(1.0)).otherwise((F.col("within_sum") + F.col("across_sum")) / n_pairs)
    return total.select(setting, "distinct_outputs", "n", rounded(mean, digits).alias("avg_pairwise_jaccard"))
