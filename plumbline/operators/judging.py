"""Bias of model judges: groundedness, position, self-preference and verbosity."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plumbline.functions.numbers import ratio, rounded
from plumbline.operators.unpivot import long_form


def preferred_model(choice: Column, when_a: str, when_b: str) -> Column:
    """The model behind a judge's A / B / tie."""
    return F.when(choice == "A", F.lit(when_a)).when(choice == "B", F.lit(when_b)).when(choice == "tie", F.lit("tie"))


def with_winners(comparisons: DataFrame, model_a: str, model_b: str) -> DataFrame:
    """Winner of the forward order (A is model a) and of the swapped one (A is model b)."""
    return comparisons.withColumns(
        {
            "forward_winner": preferred_model(F.col("forward"), model_a, model_b),
            "swapped_winner": preferred_model(F.col("swapped"), model_b, model_a),
        }
    )


def groundedness_summary(scores: DataFrame, score: str = "score", digits: int = 2) -> DataFrame:
    """Scored rationales and their mean; NULL if there are none."""
    return scores.agg(F.count(score).alias("n_scored"), rounded(F.avg(score), digits).alias("mean_score"))


def position_bias(winners: DataFrame, digits: int = 3) -> DataFrame:
    """Per judge how often the same model wins in both orders."""
    same = F.col("forward_winner") == F.col("swapped_winner")
    return winners.groupBy("judge").agg(
        F.count(F.lit(1)).alias("n_narratives"),
        F.count_if(same).alias("n_consistent"),
        rounded(F.avg(same.cast("int")), digits).alias("consistency_rate"),
    )


def self_preference(winners: DataFrame, digits: int = 3) -> DataFrame:
    """Per judge and over all (`judge` NULL): wins of the judge's own model in each order, and their pooled share."""
    forward = F.count_if(F.col("forward_winner") == F.col("own_model"))
    swapped = F.count_if(F.col("swapped_winner") == F.col("own_model"))
    counted = winners.rollup("judge").agg(
        F.count(F.lit(1)).alias("n_judgments"), forward.alias("own_forward"), swapped.alias("own_swapped")
    )
    pooled = ratio(F.col("own_forward") + F.col("own_swapped"), 2 * F.col("n_judgments"), None)
    return counted.withColumn("own_pooled_rate", rounded(pooled, digits))


def verbosity_bias(originals: DataFrame, padded: DataFrame, key: str) -> DataFrame:
    """How many padded rationales score higher than the original; a missing score counts as 0."""
    joined = padded.select(key, F.col("score").alias("_padded")).join(
        originals.select(key, F.col("score").alias("_original")), key, "left"
    )
    higher = F.coalesce("_padded", F.lit(0)) > F.coalesce("_original", F.lit(0))
    return joined.agg(F.count(F.lit(1)).alias("n_padded"), F.count_if(higher).alias("n_increased"))


def judge_bias_report(
    scores: DataFrame, winners: DataFrame, originals: DataFrame, padded: DataFrame, key: str, first_judge: str
) -> DataFrame:
    """All four measures as rows `(section, measure, value)`; the position figures are those of the first judge."""
    position = position_bias(winners.filter(F.col("judge") == first_judge))
    own = self_preference(winners).filter(F.col("judge").isNull())
    sections = {
        "groundedness": groundedness_summary(scores),
        "position_bias": position.drop("judge"),
        "self_preference": own.drop("judge"),
        "verbosity_bias": verbosity_bias(originals, padded, key),
    }
    rows = None
    for section, part in sections.items():
        as_numbers = part.select(*(F.col(c).cast("double").alias(c) for c in part.columns))
        long = long_form(as_numbers, [], part.columns, "measure", "value")
        long = long.select(F.lit(section).alias("section"), "measure", "value")
        rows = long if rows is None else rows.unionByName(long)
    return rows
