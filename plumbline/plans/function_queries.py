"""Column expressions by themselves, over the driver's tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from plumbline.functions import numbers, payloads, text
from plumbline.operators.responses import batch_prompts
from plumbline.plans.registry import query
from plumbline.plans.sampling_queries import _WORDS
from plumbline.plans.views import sql


@query("f1_char_length", sql("complaints", "SELECT complaint_id, length(narrative) AS n_points FROM complaints"))
def f1(v):
    return v.complaints.select("complaint_id", F.length("narrative").cast("bigint").alias("n_points"))


@query(
    "f3_whitespace_tokens",
    sql("turn_pairs", f"SELECT complaint_id, array_to_string(list_sort({_WORDS.format('a')}), '|') AS words FROM turn_pairs"),
)
def f3(v):
    return v.turn_pairs.select("complaint_id", F.array_join(F.sort_array(text.word_set(F.col("a"))), "|").alias("words"))


@query(
    "f4_jaccard",
    sql(
        "turn_pairs",
        """SELECT complaint_id, round(CASE WHEN length(list_concat(x, y)) = 0 THEN 1.0
                  ELSE length(list_intersect(x, y)) / CAST(length(list_distinct(list_concat(x, y))) AS DOUBLE) END, 6) AS overlap
           FROM words""",
        words=f"SELECT complaint_id, {_WORDS.format('a')} AS x, {_WORDS.format('b')} AS y FROM turn_pairs",
    ),
)
def f4(v):
    return v.turn_pairs.select("complaint_id", F.round(text.jaccard(text.word_set(F.col("a")), text.word_set(F.col("b"))), 6).alias("overlap"))


@query("f8_classification_parse", sql("classified_rows", "SELECT complaint_id, predicted_label, parse_failed, rationale FROM classified_rows"))
def f8(v):
    value = payloads.parsed(F.col("response"))
    label = payloads.truthy(value, "$.churn_signal")
    return v.classified.select(
        "complaint_id",
        F.coalesce(label.cast("int"), F.lit(0)).alias("predicted_label"),
        label.isNull().alias("parse_failed"),
        F.when(label.isNull(), F.lit("")).otherwise(payloads.rationale_text(value)).alias("rationale"),
    )


@query("f9_rounding", "SELECT o_orderkey, round_even(o_orderkey / 8.0 :: DOUBLE, 2) AS half_to_even FROM orders")
def f9(v):
    return v.read("orders").select("o_orderkey", numbers.rounded(F.col("o_orderkey") / F.lit(8.0), 2).alias("half_to_even"))


@query(
    "f10_unit_conversion",
    """SELECT o_orderkey, o_orderkey / 1000000.0 :: DOUBLE AS ms, o_orderkey / 1000000000.0 :: DOUBLE AS s,
              o_custkey / 1000000000.0 :: DOUBLE AS gb FROM orders""",
)
def f10(v):
    key = F.col("o_orderkey")
    return v.read("orders").select(
        "o_orderkey", numbers.ns_to_ms(key).alias("ms"), numbers.ns_to_s(key).alias("s"), numbers.bytes_to_gb(F.col("o_custkey")).alias("gb")
    )


@query(
    "f12_batch_prompt",
    sql(
        "complaints",
        """SELECT complaint_id // 4 AS batch, count(*) AS n_rows,
                  md5(concat('Label these.', chr(10), chr(10), string_agg(
                      concat('--- narrative id=', complaint_id, ' ---', chr(10), narrative, chr(10)), chr(10) ORDER BY complaint_id))) AS prompt_md5
           FROM complaints WHERE narrative IS NOT NULL GROUP BY complaint_id // 4""",
    ),
)
def f12(v):
    rows = v.complaints.filter(F.col("narrative").isNotNull()).select(
        F.expr("complaint_id div 4").alias("batch"), (F.col("complaint_id") % 4).alias("position"), "complaint_id", "narrative"
    )
    prompts = batch_prompts(rows, "batch", "position", "complaint_id", "narrative", "Label these.")
    return prompts.select("batch", "n_rows", F.md5("prompt").alias("prompt_md5"))


@query(
    "f16_default",
    "SELECT d.doc_id, coalesce(CAST(l.quality AS VARCHAR), '') AS evidence FROM documents d LEFT JOIN labels l USING (doc_id)",
)
def f16(v):
    known = v.read("documents").select("doc_id").join(v.read("labels"), "doc_id", "left")
    return known.select("doc_id", text.or_empty(F.col("quality")).alias("evidence"))


@query(
    "f17_date_suffix",
    """SELECT o_orderkey, replace(concat(CASE WHEN o_orderkey % 3 = 0 THEN 'start' ELSE CAST(CAST(o_orderdate AS DATE) AS VARCHAR) END, '_',
              CASE WHEN o_orderkey % 5 = 0 THEN 'now' ELSE CAST(CAST(o_orderdate AS DATE) AS VARCHAR) END), '-', '') AS suffix FROM orders""",
)
def f17(v):
    day, key = F.col("o_orderdate").cast("date"), F.col("o_orderkey")
    suffix = text.window_suffix(F.when(key % 3 != 0, day), F.when(key % 5 != 0, day))
    return v.read("orders").select("o_orderkey", suffix.alias("suffix"))
