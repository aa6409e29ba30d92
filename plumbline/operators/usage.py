"""Time, tokens and throughput of model calls."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plumbline.functions.numbers import bytes_to_gb, ns_to_ms, ns_to_s, ratio, rounded
from plumbline.operators.joins import paired_condition_join
from plumbline.operators.sampling import seeded_sample


def duration_stats(df: DataFrame, ms: str, by: list[str] = [], digits: int = 1) -> DataFrame:
    return df.groupBy(*by).agg(
        rounded(F.avg(ms), digits).alias("mean_ms"),
        rounded(F.min(ms), digits).alias("min_ms"),
        rounded(F.max(ms), digits).alias("max_ms"),
    )


def paired_delta_stats(pairs: DataFrame, first: str, second: str, digits: int = 2) -> DataFrame:
    """Means under both conditions, mean of second - first and its largest size."""
    delta = F.col(second) - F.col(first)
    return pairs.agg(
        F.count(F.lit(1)).alias("n_pairs"),
        rounded(F.avg(first), digits).alias("mean_first"),
        rounded(F.avg(second), digits).alias("mean_second"),
        rounded(F.avg(delta), digits).alias("mean_delta"),
        F.max(F.abs(delta)).alias("max_abs_delta"),
    )


def _call_rate(tokens: str, ns: str) -> Column:
    return F.when(F.col(ns) > 0, F.col(tokens) / ns_to_s(F.col(ns)))


def tokens_per_second(calls: DataFrame, by: list[str] = ["model"], digits: int = 1) -> DataFrame:
    """Mean over the calls of their own rate; calls without a duration do not count."""
    return calls.groupBy(*by).agg(rounded(F.avg(_call_rate("eval_count", "eval_duration_ns")), digits).alias("tokens_per_s"))


def quant_summary(calls: DataFrame, sizes: DataFrame, digits: int = 3) -> DataFrame:
    """Per model its size, load times, token rate, mean duration and the two validity rates.

    `calls` has a `phase` (cold, warm or sample); `sizes` holds one row per model.
    """
    sample = F.col("phase") == "sample"

    def load_ms(phase: str) -> Column:
        return F.avg(F.when(F.col("phase") == phase, ns_to_ms(F.col("load_duration_ns"))))

    stats = calls.groupBy("model").agg(
        load_ms("cold").alias("cold_load_ms"),
        load_ms("warm").alias("warm_load_ms"),
        F.avg(F.when(sample, _call_rate("eval_count", "eval_duration_ns"))).alias("tokens_per_s"),
        F.avg(F.when(sample, ns_to_ms(F.col("eval_duration_ns")))).alias("mean_eval_ms"),
        F.avg(F.when(sample, F.col("schema_valid").cast("int"))).alias("schema_valid_rate"),
        F.avg(F.when(sample, F.col("loose_match").cast("int"))).alias("loose_match_rate"),
    )
    shown = [c for c in stats.columns if c != "model"]
    sized = stats.join(sizes, "model").withColumn("size_gb", bytes_to_gb(F.col("size_bytes")))
    return sized.select("model", *(rounded(F.col(c), digits).alias(c) for c in ["size_gb", *shown]))


def latency_throughput(df: DataFrame, ms: str, by: list[str] = [], digits: int = 3) -> DataFrame:
    """Rows, total time, mean and population deviation per row in seconds, and rows per second."""
    seconds = F.col(ms) / 1000
    stats = df.groupBy(*by).agg(
        F.count(ms).alias("n_rows"),
        F.sum(seconds).alias("total_s"),
        F.avg(seconds).alias("mean_s_per_row"),
        F.stddev_pop(seconds).alias("std_s_per_row"),
    )
    stats = stats.withColumns(
        {"total_min": F.col("total_s") / 60, "rows_per_s": ratio(F.col("n_rows"), F.col("total_s"))}
    )
    shown = ["total_s", "total_min", "mean_s_per_row", "std_s_per_row", "rows_per_s"]
    return stats.select(*by, "n_rows", *(rounded(F.col(c), digits).alias(c) for c in shown))


def token_estimate(calls: DataFrame, key: str, n: int, seed: int, digits: int = 1) -> DataFrame:
    """Mean prompt, response and total tokens over a seeded sample of calls."""
    sample = seeded_sample(calls.select(key, "prompt_eval_count", "eval_count"), key, n, seed)
    total = F.avg("prompt_eval_count") + F.avg("eval_count")
    return sample.agg(
        F.count(F.lit(1)).alias("n_sampled"),
        rounded(F.avg("prompt_eval_count"), digits).alias("mean_prompt_tokens"),
        rounded(F.avg("eval_count"), digits).alias("mean_response_tokens"),
        rounded(total, digits).alias("mean_total_tokens"),
    )


def cost_multiple(fast_rate: DataFrame, slow_rate: DataFrame, digits: int = 1) -> DataFrame:
    """How many times the rows per second of the second system the first one reaches; 0 if the second is 0."""
    slow = slow_rate.select("rows_per_s").scalar()
    return fast_rate.select(
        F.col("rows_per_s").alias("fast_rows_per_s"),
        slow.alias("slow_rows_per_s"),
        rounded(ratio(F.col("rows_per_s"), slow), digits).alias("multiple"),
    )


def chars_per_token(df: DataFrame, key: str, models: list[str], digits: int = 3) -> DataFrame:
    """Characters per token of every text, one column per model."""
    per_model = (
        F.max(F.when(F.col("model") == m, rounded(F.col("n_chars") / F.col("n_tokens"), digits))).alias(m) for m in models
    )
    return df.groupBy(key).agg(F.max("n_chars").alias("n_chars"), *per_model)


def template_overhead(calls: DataFrame, by: list[str]) -> DataFrame:
    """Tokens a chat template adds: templated minus raw."""
    pairs = paired_condition_join(calls, by, "mode", "prompt_eval_count", ("raw", "templated"))
    return pairs.withColumn("overhead", F.col("templated") - F.col("raw"))
