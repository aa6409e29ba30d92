"""Model replies: parsing, validity, tokens, time, judges, diversity."""

from __future__ import annotations

from pyspark.sql import functions as F

from plumbline.operators import diversity, joins, judging, responses, sampling, usage
from plumbline.plans.registry import query
from plumbline.plans.views import hex_digit, sql


@query(
    "p11_usable_response_filter",
    sql("classified_rows", "SELECT complaint_id, rationale FROM classified_rows WHERE NOT parse_failed AND rationale <> ''"),
)
def p11(v):
    rows = responses.classify_responses(v.classified, "response", "eval_duration_ns")
    return responses.usable_response_filter(rows).select("complaint_id", "rationale")


@query("v5_schema_valid_strict", sql("extracted_flags", "SELECT complaint_id, schema_valid FROM extracted_flags"))
def v5(v):
    return responses.extraction_flags(v.extracted, "response", "true_product").select("complaint_id", "schema_valid")


@query("v6_schema_valid_keys_only", sql("extracted_flags", "SELECT complaint_id, has_keys FROM extracted_flags"))
def v6(v):
    return responses.extraction_flags(v.extracted, "response", "true_product").select("complaint_id", "has_keys")


@query(
    "f6_loose_product_match",
    sql("extracted_flags", "SELECT complaint_id, product, loose_match FROM extracted_flags"),
)
def f6(v):
    flags = responses.extraction_flags(v.extracted, "response", "true_product")
    return flags.select("complaint_id", "product", "loose_match")


@query(
    "f7_json_parse_flag",
    sql("calls", """SELECT id, json_valid(response) AS parsed, CASE WHEN json_valid(response)
                        THEN CAST(json_extract_string(response, '$.k') AS INTEGER) END AS k FROM calls"""),
)
def f7(v):
    from plumbline.functions.payloads import parsed

    read = v.calls.select("id", parsed(F.col("response")).alias("v"))
    return read.select("id", F.col("v").isNotNull().alias("parsed"), F.try_variant_get("v", "$.k", "int").alias("k"))


@query(
    "l3_classify_responses",
    sql("classified_rows", """SELECT complaint_id, product, predicted_label, parse_failed, rationale, eval_duration_ms
                              FROM classified_rows"""),
)
def l3(v):
    return responses.classify_responses(v.classified, "response", "eval_duration_ns")


@query(
    "a29_parse_failure_count",
    sql("classified_rows", """SELECT product, count(*) AS n, count(*) FILTER (WHERE parse_failed) AS n_parse_failures
                              FROM classified_rows GROUP BY product"""),
)
def a29(v):
    from plumbline.operators.metrics import parse_failure_count

    rows = responses.classify_responses(v.classified, "response", "eval_duration_ns")
    return parse_failure_count(rows, by=["product"])


@query(
    "a13_duration_stats",
    sql("calls", """SELECT model, round_even(avg(eval_duration_ns / 1000000.0 :: DOUBLE), 1) AS mean_ms,
                        round_even(min(eval_duration_ns / 1000000.0 :: DOUBLE), 1) AS min_ms,
                        round_even(max(eval_duration_ns / 1000000.0 :: DOUBLE), 1) AS max_ms FROM calls GROUP BY model"""),
)
def a13(v):
    from plumbline.functions.numbers import ns_to_ms

    timed = v.calls.withColumn("ms", ns_to_ms(F.col("eval_duration_ns")))
    return usage.duration_stats(timed, "ms", ["model"])


_RATES = """count(*) AS n_samples, round_even(avg(CAST(json_parsed AS INTEGER)), 3) AS json_parse_rate,
            round_even(avg(CAST(schema_valid AS INTEGER)), 3) AS schema_valid_rate,
            round_even(avg(CAST(loose_match AS INTEGER)), 3) AS loose_match_rate"""


@query("a14_extraction_rates", sql("extracted_flags", f"SELECT {_RATES} FROM extracted_flags"))
def a14(v):
    return responses.extraction_rates(responses.extraction_flags(v.extracted, "response", "true_product"))


@query(
    "l4_extraction_report",
    sql(
        "extracted_flags",
        f"""SELECT model, {_RATES}, round_even(avg(ms), 3) AS mean_ms, round_even(min(ms), 3) AS min_ms,
                round_even(max(ms), 3) AS max_ms FROM extracted_flags GROUP BY model""",
    ),
)
def l4(v):
    return responses.extraction_report(v.extracted, "response", "true_product", "ms", ["model"])


# Two conditions of one text: its reply with free wording and with the closed vocabulary.
_CONDITIONS = """SELECT complaint_id, 'free' AS condition, response, n_chars // 4 AS eval_count FROM both_replies
                 UNION ALL SELECT complaint_id, 'closed', concat('{"product": "', product, '"}'), n_chars // 5
                 FROM both_replies"""
_BOTH = """SELECT e.complaint_id, e.response, c.product, c.n_chars FROM extracted e JOIN complaints c USING (complaint_id)"""
_PAIRS = """SELECT complaint_id, max(eval_count) FILTER (WHERE condition = 'free') AS free,
                max(eval_count) FILTER (WHERE condition = 'closed') AS closed FROM conditions GROUP BY complaint_id"""
_DELTAS = """SELECT count(*) AS n_pairs, round_even(avg(free), 2) AS mean_first, round_even(avg(closed), 2) AS mean_second,
                 round_even(avg(closed - free), 2) AS mean_delta, max(abs(closed - free)) AS max_abs_delta FROM pairs"""


def conditions(v):
    both = v.extracted.select("complaint_id", "response").join(
        v.complaints.select("complaint_id", "product", "n_chars"), "complaint_id"
    )
    closed = F.concat(F.lit('{"product": "'), F.col("product"), F.lit('"}'))
    free_row = F.struct(
        F.lit("free").alias("condition"), F.col("response").alias("response"), F.expr("n_chars div 4").alias("eval_count")
    )
    closed_row = F.struct(
        F.lit("closed").alias("condition"), closed.alias("response"), F.expr("n_chars div 5").alias("eval_count")
    )
    return both.select("complaint_id", F.inline(F.array(free_row, closed_row)))


@query(
    "j10_paired_condition_join",
    sql("extracted", "SELECT complaint_id, free, closed FROM pairs", both_replies=_BOTH, conditions=_CONDITIONS, pairs=_PAIRS),
)
def j10(v):
    return joins.paired_condition_join(conditions(v), ["complaint_id"], "condition", "eval_count", ("free", "closed"))


@query(
    "a15_paired_delta_stats",
    sql("extracted", _DELTAS, both_replies=_BOTH, conditions=_CONDITIONS, pairs=_PAIRS),
)
def a15(v):
    pairs = joins.paired_condition_join(conditions(v), ["complaint_id"], "condition", "eval_count", ("free", "closed"))
    return usage.paired_delta_stats(pairs, "free", "closed")


@query(
    "l5_enum_effect_report",
    sql(
        "extracted",
        f"""SELECT *, (SELECT count(*) FROM products WHERE condition = 'free' AND product IN ('en', 'fr', 'de')) AS listed_first,
                (SELECT count(*) FROM products WHERE condition = 'closed' AND product IN ('en', 'fr', 'de')) AS listed_second
            FROM ({_DELTAS})""",
        both_replies=_BOTH,
        conditions=_CONDITIONS,
        pairs=_PAIRS,
        products="""SELECT condition, CASE WHEN json_valid(response) THEN json_extract_string(response, '$.product') END
                        AS product FROM conditions""",
    ),
)
def l5(v):
    return responses.enum_effect_report(conditions(v), "complaint_id", ("free", "closed"), ("en", "fr", "de"))


_RATE = "CASE WHEN eval_duration_ns > 0 THEN eval_count / (eval_duration_ns / 1000000000.0 :: DOUBLE) END"


@query(
    "a16_tokens_per_second",
    sql("calls", f"SELECT model, round_even(avg({_RATE}), 1) AS tokens_per_s FROM calls GROUP BY model"),
)
def a16(v):
    return usage.tokens_per_second(v.calls)


@query(
    "a17_quant_summary",
    sql(
        "calls",
        f"""SELECT model, round_even(size_bytes / 1000000000.0 :: DOUBLE, 3) AS size_gb,
               round_even(avg(load_duration_ns / 1000000.0 :: DOUBLE) FILTER (WHERE phase = 'cold'), 3) AS cold_load_ms,
               round_even(avg(load_duration_ns / 1000000.0 :: DOUBLE) FILTER (WHERE phase = 'warm'), 3) AS warm_load_ms,
               round_even(avg({_RATE}) FILTER (WHERE phase = 'sample'), 3) AS tokens_per_s,
               round_even(avg(eval_duration_ns / 1000000.0 :: DOUBLE) FILTER (WHERE phase = 'sample'), 3) AS mean_eval_ms,
               round_even(avg(CAST(json_valid(response) AS INTEGER)) FILTER (WHERE phase = 'sample'), 3) AS schema_valid_rate,
               round_even(avg(CAST(prompt_eval_count > 50 AS INTEGER)) FILTER (WHERE phase = 'sample'), 3) AS loose_match_rate
           FROM calls JOIN (SELECT event_type AS model, CAST(sum(length(props)) * 100000 AS BIGINT) AS size_bytes
                            FROM events GROUP BY event_type) USING (model)
           GROUP BY model, size_bytes""",
    ),
)
def a17(v):
    from plumbline.functions.payloads import parsed

    calls = v.calls.withColumns(
        {"schema_valid": parsed(F.col("response")).isNotNull(), "loose_match": F.col("prompt_eval_count") > 50}
    )
    sizes = (
        v.read("events")
        .groupBy(F.col("event_type").alias("model"))
        .agg((F.sum(F.length("props")) * 100000).alias("size_bytes"))
    )
    return usage.quant_summary(calls, sizes)


_LATENCY = """SELECT {by} count(value) AS n_rows, round_even(sum(value / 1000.0 :: DOUBLE), 3) AS total_s,
                  round_even(sum(value / 1000.0 :: DOUBLE) / 60, 3) AS total_min,
                  round_even(avg(value / 1000.0 :: DOUBLE), 3) AS mean_s_per_row,
                  round_even(stddev_pop(value / 1000.0 :: DOUBLE), 3) AS std_s_per_row,
                  round_even(count(value) / sum(value / 1000.0 :: DOUBLE), 3) AS rows_per_s FROM calls {rest}"""


@query("a18_latency_throughput", sql("calls", _LATENCY.format(by="model,", rest="GROUP BY model")))
def a18(v):
    return usage.latency_throughput(v.calls, "value", ["model"])


@query(
    "a19_token_estimate",
    sql(
        "calls",
        """SELECT count(*) AS n_sampled, round_even(avg(prompt_eval_count), 1) AS mean_prompt_tokens,
               round_even(avg(eval_count), 1) AS mean_response_tokens,
               round_even(avg(prompt_eval_count) + avg(eval_count), 1) AS mean_total_tokens
           FROM (SELECT * FROM calls ORDER BY md5('42:' || CAST(id AS VARCHAR)), id LIMIT 30)""",
    ),
)
def a19(v):
    return usage.token_estimate(v.calls, "id", 30, 42)


@query(
    "a20_cost_multiple",
    sql(
        "calls",
        """SELECT fast_rows_per_s, slow_rows_per_s, round_even(fast_rows_per_s / slow_rows_per_s, 1) AS multiple
           FROM (SELECT round_even(count(value) / sum(value / 1000.0 :: DOUBLE), 3) AS fast_rows_per_s
                 FROM calls WHERE model = 'view'),
                (SELECT round_even(count(value) / sum(value / 1000.0 :: DOUBLE), 3) AS slow_rows_per_s
                 FROM calls WHERE model = 'error')""",
    ),
)
def a20(v):
    rates = [usage.latency_throughput(v.calls.filter(F.col("model") == m), "value") for m in ("view", "error")]
    return usage.cost_multiple(*rates)


@query(
    "a30_chars_per_token",
    sql(
        "complaints",
        """SELECT complaint_id, n_chars, round_even(n_chars / CAST(n_chars // 4 + 1 AS DOUBLE), 3) AS coarse,
               round_even(n_chars / CAST(n_chars // 3 + 1 AS DOUBLE), 3) AS fine FROM complaints""",
    ),
)
def a30(v):
    counts = F.array(
        F.struct(F.lit("coarse").alias("model"), F.expr("n_chars div 4 + 1").alias("n_tokens")),
        F.struct(F.lit("fine").alias("model"), F.expr("n_chars div 3 + 1").alias("n_tokens")),
    )
    rows = v.complaints.select("complaint_id", "n_chars", F.inline(counts))
    return usage.chars_per_token(rows, "complaint_id", ["coarse", "fine"])


@query(
    "a31_template_overhead",
    sql(
        "calls",
        """SELECT model, raw, templated, templated - raw AS overhead FROM
           (SELECT model, min(prompt_eval_count) AS raw, min(prompt_eval_count) + max(prompt_eval_count) AS templated
            FROM calls GROUP BY model)""",
    ),
)
def a31(v):
    probe = v.calls.groupBy("model").agg(F.min("prompt_eval_count").alias("lo"), F.max("prompt_eval_count").alias("hi"))
    raw = F.struct(F.lit("raw").alias("mode"), F.col("lo").alias("prompt_eval_count"))
    templated = F.struct(F.lit("templated").alias("mode"), (F.col("lo") + F.col("hi")).alias("prompt_eval_count"))
    return usage.template_overhead(probe.select("model", F.inline(F.array(raw, templated))), ["model"])


_WORD_SETS = r"""SELECT setting, repeat, output, list_distinct(list_filter(
                     regexp_split_to_array(lower(output), '[ \t\n\r\f\x0B]+'), lambda x: x <> '')) AS w FROM outputs"""
_EACH = """SELECT a.setting, a.output = b.output AS same, length(list_intersect(a.w, b.w)) AS shared,
               CASE WHEN length(list_concat(a.w, b.w)) = 0 THEN 1.0
                    ELSE length(list_intersect(a.w, b.w)) / CAST(length(list_distinct(list_concat(a.w, b.w))) AS DOUBLE)
               END AS jaccard
           FROM word_sets a JOIN word_sets b ON a.setting = b.setting AND a.repeat < b.repeat"""


@query(
    "j8_pairwise_self_join",
    sql(
        "outputs",
        """SELECT setting, coalesce(n_pairs, 0) AS n_pairs, coalesce(shared_words, 0) AS shared_words,
               coalesce(same_text_pairs, 0) AS same_text_pairs
           FROM (SELECT DISTINCT setting FROM outputs)
           LEFT JOIN (SELECT setting, count(*) AS n_pairs, CAST(sum(shared) AS BIGINT) AS shared_words,
                          count(*) FILTER (WHERE same) AS same_text_pairs FROM each_pair GROUP BY setting) USING (setting)""",
        word_sets=_WORD_SETS,
        each_pair=_EACH,
    ),
)
def j8(v):
    return joins.pair_overlap(v.outputs, "setting", "output")


_DIVERSITY = """SELECT setting, distinct_outputs, n, round_even(coalesce(m, 1.0), 4) AS avg_pairwise_jaccard
                FROM (SELECT setting, count(DISTINCT output) AS distinct_outputs, count(*) AS n FROM outputs GROUP BY setting)
                LEFT JOIN (SELECT setting, avg(jaccard) AS m FROM each_pair GROUP BY setting) USING (setting)"""


@query("a12_diversity_stats", sql("outputs", _DIVERSITY, word_sets=_WORD_SETS, each_pair=_EACH))
def a12(v):
    return diversity.diversity_stats(v.outputs, "setting", "output")


@query(
    "j9_candidate_pairing",
    sql(
        "turn_pairs",
        """SELECT complaint_id, 'forward' AS "order", a AS candidate_a, b AS candidate_b FROM turn_pairs
           UNION ALL SELECT complaint_id, 'swapped', b, a FROM turn_pairs""",
    ),
)
def j9(v):
    a = v.turn_pairs.select("complaint_id", F.col("a").alias("text"))
    b = v.turn_pairs.select("complaint_id", F.col("b").alias("text"))
    return joins.candidate_pairing(a, b, "complaint_id", "text")


@query(
    "j11_sweep_expand",
    sql(
        "outputs",
        """SELECT prompt_id, value, CAST(repeat AS INTEGER) AS repeat, n
           FROM (SELECT setting * 100 + repeat AS prompt_id, length(output) AS n FROM outputs),
                (VALUES (0.0 :: DOUBLE), (0.7 :: DOUBLE), (1.5 :: DOUBLE)) AS t(value), range(1, 4) AS r(repeat)""",
    ),
)
def j11(v):
    prompt_id = F.col("setting") * 100 + F.col("repeat")
    prompts = v.outputs.select(prompt_id.alias("prompt_id"), F.length("output").cast("long").alias("n"))
    return joins.sweep_expand(prompts, [0.0, 0.7, 1.5], 3)


@query(
    "j12_model_availability",
    sql(
        "calls",
        """SELECT model, n_calls, coalesce(available, false) AS available
           FROM (SELECT model, count(*) AS n_calls FROM calls GROUP BY model)
           LEFT JOIN (SELECT model, true AS available FROM calls GROUP BY model HAVING max(value) > 350) USING (model)""",
    ),
)
def j12(v):
    wanted = v.calls.groupBy("model").agg(F.count(F.lit(1)).alias("n_calls"))
    catalogue = v.calls.groupBy("model").agg(F.max("value").alias("top")).filter(F.col("top") > 350)
    return joins.model_availability_filter(wanted, catalogue, "model")


# Batch replies. Some ids do not come back, some come back twice and the second counts, some replies are cut.
_HEAD = "substr(narrative, 1, 24)"
_BATCHED = """SELECT complaint_id, product, narrative, (row_number() OVER (ORDER BY complaint_id) - 1) // 10 AS batch,
                  substr(md5(CAST(complaint_id AS VARCHAR)), 1, 1) AS h FROM complaints"""
_GOOD = "substr(md5(CAST(batch AS VARCHAR)), 1, 1) <> '0'"


def batched(v):
    rows = v.complaints.select("complaint_id", "product", "narrative")
    return sampling.batch_assign(rows, "complaint_id", 10)


def replies(v):
    """One reply per batch of ten texts, with prose around the array."""
    h = hex_digit("complaint_id")
    label = F.when(h < "8", 1).otherwise(0)
    quote = F.when(h < "8", F.substring("narrative", 1, 24))
    sure = F.when(h < "c", "high")
    first = F.to_json(F.struct(F.col("complaint_id").alias("id"), F.lit(0).alias("label"), F.lit("[x]").alias("evidence")))
    last = F.to_json(
        F.struct(F.col("complaint_id").alias("id"), label.alias("label"), quote.alias("evidence"), sure.alias("confidence"))
    )
    items = F.when(h == "0", F.array().cast("array<string>")).when(h == "1", F.array(first, last)).otherwise(F.array(last))
    one = batched(v).select("batch", "position", items.alias("items"))
    joined = one.groupBy("batch").agg(F.flatten(F.sort_array(F.collect_list(F.struct("position", "items")))["items"]).alias("all"))
    body = F.concat(F.lit("Here you are: ```json\n["), F.concat_ws(",", "all"), F.lit("]\n``` see [XXXX]"))
    cut = F.concat(F.lit("Here: ["), F.concat_ws(",", "all"), F.lit(', {"id": 1'))
    broken = F.substring(F.md5(F.col("batch").cast("string")), 1, 1) == "0"
    return joined.select("batch", F.when(broken, cut).otherwise(body).alias("reply"))


@query(
    "l2_explode_proposals",
    sql(
        "complaints",
        f"""SELECT batch, complaint_id AS id, CASE WHEN h < '8' THEN 1 ELSE 0 END AS label,
                CASE WHEN h < '8' THEN {_HEAD} END AS evidence, CASE WHEN h < 'c' THEN 'high' END AS confidence
            FROM batched WHERE h <> '0' AND {_GOOD}
            UNION ALL SELECT batch, complaint_id, 0, '[x]', NULL FROM batched WHERE h = '1' AND {_GOOD}""",
        batched=_BATCHED,
    ),
)
def l2(v):
    rows, _ = responses.explode_proposals(replies(v), "reply", ["batch"])
    return rows.drop("position")


@query(
    "f19_payload_rejects",
    sql("complaints", f"SELECT batch FROM batched WHERE NOT ({_GOOD}) GROUP BY batch", batched=_BATCHED),
)
def f19(v):
    _, rejects = responses.explode_proposals(replies(v), "reply", ["batch"])
    return rejects.select("batch")


def prelabelled(v):
    rows, _ = responses.explode_proposals(replies(v), "reply", [])
    return responses.attach_proposals(v.complaints.select("complaint_id", "product", "narrative"), rows, "complaint_id", "rule v1")


_SQUEEZE = r"trim(lower(regexp_replace({}, '\s+', ' ', 'g')))"
_PRELABELLED = f"""SELECT complaint_id, product, narrative, CASE WHEN h < '8' THEN 1 ELSE 0 END AS proposed_label,
                       CASE WHEN h < '8' THEN {_HEAD} ELSE '' END AS evidence_quote,
                       CASE WHEN h < 'c' THEN 'high' ELSE '' END AS confidence,
                       CASE WHEN h < '8' AND {_HEAD} <> '' THEN
                           contains({_SQUEEZE.format("narrative")}, {_SQUEEZE.format(_HEAD)}) ELSE true END AS evidence_verbatim,
                       'rule v1' AS labeler_model
                   FROM batched WHERE h <> '0' AND {_GOOD}"""


@query("j5_proposal_match", sql("complaints", "SELECT * FROM prelabelled", batched=_BATCHED, prelabelled=_PRELABELLED))
def j5(v):
    return prelabelled(v)[0]


@query(
    "x4_retry_missing_ids",
    sql("complaints", f"SELECT complaint_id FROM batched WHERE h = '0' OR NOT ({_GOOD})", batched=_BATCHED),
)
def x4_ids(v):
    return prelabelled(v)[1].select("complaint_id")


@query(
    "a22_proposal_summary",
    sql(
        "complaints",
        """SELECT count(*) AS n, count(*) FILTER (WHERE proposed_label = 1) AS n_proposed_positive,
               count(*) FILTER (WHERE evidence_verbatim) AS n_verbatim FROM prelabelled""",
        batched=_BATCHED,
        prelabelled=_PRELABELLED,
    ),
)
def a22(v):
    return responses.proposal_summary(prelabelled(v)[0])


def reviewed(v):
    h = hex_digit("complaint_id")
    answer = (
        F.when(h < "6", "").when(h < "9", "0").when(h < "b", "1").when(h < "d", "a").when(h < "e", "s")
    )
    decisions = v.complaints.select("complaint_id", answer.alias("answer")).filter("answer is not null")
    return responses.apply_review(prelabelled(v)[0], decisions, "complaint_id")


_REVIEWED = """SELECT complaint_id, proposed_label, churn_signal,
                   CASE WHEN churn_signal IS NOT NULL THEN false WHEN answer = 'a' THEN true END AS ambiguous,
                   CASE WHEN churn_signal IS NOT NULL THEN churn_signal <> proposed_label WHEN answer = 'a' THEN false END
                       AS human_overrode
               FROM (SELECT *, CASE answer WHEN '' THEN proposed_label WHEN '0' THEN 0 WHEN '1' THEN 1 END AS churn_signal
                     FROM (SELECT *, CASE WHEN k < '6' THEN '' WHEN k < '9' THEN '0' WHEN k < 'b' THEN '1'
                                          WHEN k < 'd' THEN 'a' WHEN k < 'e' THEN 's' END AS answer
                           FROM (SELECT *, substr(md5(CAST(complaint_id AS VARCHAR)), 1, 1) AS k FROM prelabelled)))"""


@query(
    "l6_apply_review",
    sql("complaints", "SELECT * FROM reviewed", batched=_BATCHED, prelabelled=_PRELABELLED, reviewed=_REVIEWED),
)
def l6(v):
    return reviewed(v).select("complaint_id", "proposed_label", "churn_signal", "ambiguous", "human_overrode")


@query(
    "a21_review_summary",
    sql(
        "complaints",
        """SELECT count(*) AS n_total, count(*) FILTER (WHERE churn_signal IS NOT NULL OR coalesce(ambiguous, false)) AS n_reviewed,
               count(*) FILTER (WHERE churn_signal IS NOT NULL) AS n_labelled,
               count(*) FILTER (WHERE churn_signal = 1) AS n_positive,
               count(*) FILTER (WHERE churn_signal IS NOT NULL AND human_overrode) AS n_overrides,
               count(*) FILTER (WHERE coalesce(ambiguous, false)) AS n_ambiguous,
               count(*) FILTER (WHERE churn_signal IS NULL AND NOT coalesce(ambiguous, false)) AS n_remaining FROM reviewed""",
        batched=_BATCHED,
        prelabelled=_PRELABELLED,
        reviewed=_REVIEWED,
    ),
)
def a21(v):
    return responses.review_summary(reviewed(v))


@query(
    "l1_build_requests",
    sql(
        "complaints",
        """SELECT batch, count(*) AS n_rows, md5(concat('Label these.', chr(10), chr(10), string_agg(
               concat('--- narrative id=', complaint_id, ' ---', chr(10), narrative, chr(10)), chr(10) ORDER BY complaint_id)))
               AS prompt_md5
           FROM (SELECT *, (row_number() OVER (ORDER BY complaint_id) - 1) // 10 AS batch FROM complaints
                 WHERE complaint_id NOT IN (SELECT doc_id FROM labels)) GROUP BY batch""",
    ),
)
def l1(v):
    done = v.read("labels").select(F.col("doc_id").alias("complaint_id"))
    requests = responses.build_requests(v.complaints, done, "complaint_id", "narrative", 10, "Label these.")
    return requests.select("batch", "n_rows", F.md5("prompt").alias("prompt_md5"))


@query(
    "a23_groundedness_summary",
    sql("judge_scores", "SELECT count(score) AS n_scored, round_even(avg(score), 2) AS mean_score FROM judge_scores"),
)
def a23(v):
    return judging.groundedness_summary(v.judge_scores)


def winners(v):
    return judging.with_winners(v.comparisons, "a", "b")


_POSITION = """SELECT judge, count(*) AS n_narratives, count(*) FILTER (WHERE forward_winner = swapped_winner) AS n_consistent,
                   round_even(avg(CAST(forward_winner = swapped_winner AS INTEGER)), 3) AS consistency_rate
               FROM winners GROUP BY judge"""
_SELF = """SELECT judge, count(*) AS n_judgments, count(*) FILTER (WHERE forward_winner = own_model) AS own_forward,
               count(*) FILTER (WHERE swapped_winner = own_model) AS own_swapped,
               round_even((count(*) FILTER (WHERE forward_winner = own_model) +
                   count(*) FILTER (WHERE swapped_winner = own_model)) / CAST(2 * count(*) AS DOUBLE), 3) AS own_pooled_rate
           FROM winners GROUP BY ROLLUP (judge)"""
_VERBOSE = """SELECT count(*) AS n_padded,
                  count(*) FILTER (WHERE coalesce(p.score, 0) > coalesce(o.score, 0)) AS n_increased
              FROM padded_scores p LEFT JOIN judge_scores o USING (complaint_id)"""


@query(
    "f15_preference_map",
    sql("winners", "SELECT complaint_id, judge, forward_winner, swapped_winner FROM winners"),
)
def f15(v):
    return winners(v).select("complaint_id", "judge", "forward_winner", "swapped_winner")


@query("a24_position_bias", sql("winners", _POSITION))
def a24(v):
    return judging.position_bias(winners(v))


@query("a25_self_preference", sql("winners", _SELF))
def a25(v):
    return judging.self_preference(winners(v))


@query("a26_verbosity_bias", sql("padded_scores judge_scores", _VERBOSE))
def a26(v):
    return judging.verbosity_bias(v.judge_scores, v.padded_scores, "complaint_id")


@query(
    "l7_judge_bias_report",
    sql(
        "winners judge_scores padded_scores",
        """SELECT 'groundedness' AS section, 'n_scored' AS measure, CAST(count(score) AS DOUBLE) AS value FROM judge_scores
           UNION ALL SELECT 'groundedness', 'mean_score', round_even(avg(score), 2) FROM judge_scores
           UNION ALL SELECT 'position_bias', 'n_narratives', n_narratives FROM position WHERE judge = 'judge_a'
           UNION ALL SELECT 'position_bias', 'n_consistent', n_consistent FROM position WHERE judge = 'judge_a'
           UNION ALL SELECT 'position_bias', 'consistency_rate', consistency_rate FROM position WHERE judge = 'judge_a'
           UNION ALL SELECT 'self_preference', 'n_judgments', n_judgments FROM own WHERE judge IS NULL
           UNION ALL SELECT 'self_preference', 'own_forward', own_forward FROM own WHERE judge IS NULL
           UNION ALL SELECT 'self_preference', 'own_swapped', own_swapped FROM own WHERE judge IS NULL
           UNION ALL SELECT 'self_preference', 'own_pooled_rate', own_pooled_rate FROM own WHERE judge IS NULL
           UNION ALL SELECT 'verbosity_bias', 'n_padded', n_padded FROM padding
           UNION ALL SELECT 'verbosity_bias', 'n_increased', n_increased FROM padding""",
        position=_POSITION,
        own=_SELF,
        padding=_VERBOSE,
    ),
)
def l7(v):
    return judging.judge_bias_report(
        v.judge_scores, winners(v), v.judge_scores, v.padded_scores, "complaint_id", "judge_a"
    )
