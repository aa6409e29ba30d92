import itertools
import random

import pytest
from pyspark.sql import functions as F

from plumbline.functions.payloads import has_keys, is_valid_extraction, parsed, proposals_in
from plumbline.functions.text import is_verbatim, jaccard, loose_match, padded, word_set
from plumbline.operators import diversity, joins, judging, responses, usage


def column(spark, values, expression):
    df = spark.createDataFrame(list(enumerate(values)), "i int, v string")
    return [r[0] for r in df.select(expression(F.col("v")), "i").orderBy("i").collect()]


@pytest.mark.parametrize(
    "reply, label, failed, rationale",
    [
        ('{"churn_signal": true, "rationale": "r"}', 1, False, "r"),
        ('{"churn_signal": "false", "rationale": "r"}', 1, False, "r"),
        ('{"churn_signal": null}', 0, False, ""),
        ('{"churn_signal": 0, "rationale": 7}', 0, False, "7"),
        ('{"churn_signal": 0.5, "rationale": ""}', 1, False, ""),
        ('{"churn_signal": [], "rationale": "r"}', 0, False, "r"),
        ('{"churn_signal": [0], "rationale": "r"}', 1, False, "r"),
        ('{"churn_signal": {}, "rationale": "r"}', 0, False, "r"),
        ('{"churn_signal": {"a": 1}, "rationale": "r"}', 1, False, "r"),
        ('{"rationale": "r"}', 0, True, ""),
        ("[1]", 0, True, ""),
        ('{"churn_signal": tr', 0, True, ""),
        ("", 0, True, ""),
        (None, 0, True, ""),
    ],
)
def test_classifier_replies(spark, reply, label, failed, rationale):
    df = spark.createDataFrame([(1, reply, 1_250_000)], "id int, response string, ns long")
    row = responses.classify_responses(df, "response", "ns").first()
    assert (row["predicted_label"], row["parse_failed"], row["rationale"]) == (label, failed, rationale)
    assert row["eval_duration_ms"] == 1.2  # half to even


def test_extraction_rules(spark):
    good = '{"product": "p", "issue_summary": "s", "urgency": "low", "mentions_legal_action": true, "more": 1}'
    replies = [
        good,
        good.replace('"low"', '"none"'),
        good.replace("true", '"true"'),
        good.replace('"s"', "null"),
        '{"product": "p"}',
        "[]",
        "{",
    ]
    assert column(spark, replies, lambda v: is_valid_extraction(parsed(v))) == [True] + [False] * 6
    assert column(spark, replies, lambda v: has_keys(parsed(v))) == [True] * 4 + [False] * 3


def test_payload_arrays(spark):
    item = '{"id": 1, "label": 1, "evidence": "a [XXXX] \\" ]", "confidence": "high"}'
    replies = [f"```json\n[{item}]\n``` and [more]", f"[{item}, {item}", "no array", "[]", f"x [{item}]"]
    found = column(spark, replies, proposals_in)
    assert [None if f is None else len(f) for f in found] == [1, None, None, 0, 1]
    assert found[0][0]["evidence"] == 'a [XXXX] " ]'


def test_last_proposal_of_an_id_counts(spark):
    batch = spark.createDataFrame([(1, "One  text"), (2, "other")], "complaint_id long, narrative string")
    rows = spark.createDataFrame(
        [(1, 0, 0, "x", "low"), (1, 1, 1, "one TEXT", None), (9, 2, 1, "", "")],
        "id long, position int, label int, evidence string, confidence string",
    )
    done, missing = responses.attach_proposals(batch, rows, "complaint_id", "m")
    row = done.first()
    assert (row["proposed_label"], row["evidence_verbatim"], row["confidence"]) == (1, True, "")
    assert [r["complaint_id"] for r in missing.collect()] == [2]


def test_review_answers(spark):
    rows = [(i, 1) for i in range(6)]
    proposals = spark.createDataFrame(rows, "complaint_id long, proposed_label int")
    answers = spark.createDataFrame([(0, ""), (1, "0"), (2, "1"), (3, "a"), (4, "s")], "complaint_id long, answer string")
    out = responses.apply_review(proposals, answers, "complaint_id").orderBy("complaint_id").collect()
    assert [(r["churn_signal"], r["ambiguous"], r["human_overrode"]) for r in out] == [
        (1, False, False),
        (0, False, True),
        (1, False, False),
        (None, True, False),
        (None, None, None),
        (None, None, None),
    ]
    row = responses.review_summary(responses.apply_review(proposals, answers, "complaint_id")).first()
    assert row.asDict() == dict(
        n_total=6, n_reviewed=4, n_labelled=3, n_positive=2, n_overrides=1, n_ambiguous=1, n_remaining=2
    )


def brute_jaccard(a, b):
    x, y = set(a.lower().split()), set(b.lower().split())
    return 1.0 if not x and not y else len(x & y) / len(x | y)


def test_diversity_equals_brute_force_over_many_blocks(spark):
    """A hot setting with 300 different word sets and a third of its rows being copies of one text."""
    rng = random.Random(3)
    words = [f"w{i}" for i in range(40)]
    hot = [" ".join(rng.sample(words, rng.randrange(1, 9))) for _ in range(300)] + ["Same  text"] * 90 + ["text same"] * 60
    groups = {"hot": hot, "one": ["single"], "empty": ["", " "], "apart": ["a", "b"]}
    rows = [(g, t) for g, texts in groups.items() for t in texts]
    df = spark.createDataFrame(rows, "setting string, output string").repartition(5)
    for row in diversity.diversity_stats(df, "setting", "output", 9).collect():
        texts = groups[row["setting"]]
        pairs = list(itertools.combinations(texts, 2))
        expected = sum(brute_jaccard(a, b) for a, b in pairs) / len(pairs) if pairs else 1.0
        assert row["avg_pairwise_jaccard"] == pytest.approx(expected, abs=1e-8)
        assert (row["distinct_outputs"], row["n"]) == (len(set(texts)), len(texts))


def test_pair_overlap_equals_brute_force(spark):
    texts = ["a b c", "b c d", "b c d", "", "x"]
    row = joins.pair_overlap(spark.createDataFrame([(1, t) for t in texts], "g int, t string"), "g", "t").first()
    pairs = list(itertools.combinations(texts, 2))
    assert row["n_pairs"] == len(pairs)
    assert row["shared_words"] == sum(len(set(a.split()) & set(b.split())) for a, b in pairs)
    assert row["same_text_pairs"] == 1


def test_text_functions(spark):
    df = spark.createDataFrame([("A b  C", "a  B c"), ("x", ""), ("x", None)], "n string, q string")
    assert [r[0] for r in df.select(is_verbatim(F.col("q"), F.col("n"))).collect()] == [True, True, True]
    assert [r[0] for r in df.select(padded(F.lit("end.."), " More.")).collect()][0] == "end. More."
    assert [r[0] for r in df.select(loose_match(F.lit(" Credit card"), F.lit("CREDITS"))).collect()][0] is True
    both = jaccard(word_set(F.lit("")), word_set(F.lit(" ")))
    assert df.select(both).first()[0] == 1.0


def test_judge_bias(spark):
    rows = [(1, "j", "a", "A", "B"), (2, "j", "a", "A", "A"), (3, "j", "a", "tie", "tie")]
    df = spark.createDataFrame(rows, "complaint_id long, judge string, own_model string, forward string, swapped string")
    won = judging.with_winners(df, "a", "b")
    assert judging.position_bias(won).first()["consistency_rate"] == 0.667
    total = judging.self_preference(won).filter("judge is null").first()
    assert (total["own_forward"], total["own_swapped"], total["own_pooled_rate"]) == (2, 1, 0.5)
    originals = spark.createDataFrame([(1, 3), (2, None)], "complaint_id long, score int")
    others = spark.createDataFrame([(1, 3), (2, 1), (3, 2), (4, None)], "complaint_id long, score int")
    row = judging.verbosity_bias(originals, others, "complaint_id").first()
    assert (row["n_padded"], row["n_increased"]) == (4, 2)


def test_token_rates_are_means_of_ratios(spark):
    calls = spark.createDataFrame([("m", 10, 10**9), ("m", 40, 2 * 10**9), ("m", 5, 0), ("z", 5, 0)],
                                  "model string, eval_count long, eval_duration_ns long")
    rates = {r["model"]: r["tokens_per_s"] for r in usage.tokens_per_second(calls).collect()}
    assert rates == {"m": 15.0, "z": None}


def test_cost_multiple_is_zero_without_a_divisor(spark):
    fast, slow = (spark.createDataFrame([(x,)], "rows_per_s double") for x in (4943.0, 0.333))
    none = spark.createDataFrame([(0.0,)], "rows_per_s double")
    assert usage.cost_multiple(fast, slow).first()["multiple"] == 14843.8
    assert usage.cost_multiple(fast, none).first()["multiple"] == 0.0


def test_proposals_with_loose_numbers_and_nested_evidence(spark):
    from plumbline.operators.responses import explode_proposals

    reply = 'Here: [{"id": 1, "label": "1"}, {"id": "2", "label": 1.0, "evidence": ["a", "[b"]}, {"id": 3, "label": true}, {"id": 4, "label": "x"}] end'
    rows, rejects = explode_proposals(spark.createDataFrame([(reply,)], "r string"), "r", [])
    assert [(r["id"], r["label"]) for r in rows.orderBy("position").collect()] == [(1, 1), (2, 1), (3, 1), (4, None)]
    assert rejects.count() == 0


def test_arrays_end_where_their_bracket_closes_at_any_depth(spark):
    import random

    from plumbline.functions import payloads

    def brute(text):
        start = at = text.find("[")
        depth, quoted = 0, False
        while 0 <= at < len(text):
            c = text[at]
            if quoted:
                at += c == "\\"
                quoted = c != '"'
            elif c == '"':
                quoted = True
            elif c in "[]":
                depth += 1 if c == "[" else -1
                if depth == 0:
                    return text[start : at + 1]
            at += 1
        return ""

    rnd = random.Random(1)
    texts = ["".join(rnd.choice(["[", "]", '"', "\\", "a", "{", "\u00e9", "\n", ","]) for _ in range(rnd.randint(0, 25))) for _ in range(2000)]
    texts += ["so " + "[" * 50 + "1" + "]" * 50 + " it is", '[ "a]" ]]', ""]
    rows = spark.createDataFrame([(t,) for t in texts], "t string").select("t", payloads.payload_array(F.col("t")).alias("p")).collect()
    assert [r["p"] for r in rows] == [brute(r["t"]) for r in rows]
    deep = '[{"id": 1, "label": 1, "evidence": "e", "confidence": "high", "more": ' + "[" * 40 + "]" * 40 + "}]"
    found = spark.createDataFrame([(deep,), (None,)], "t string").select(payloads.proposals_in(F.col("t")).alias("p")).collect()
    assert [p["id"] for p in found[0]["p"]] == [1] and found[1]["p"] is None


def test_a_proposal_without_a_usable_label_is_asked_for_again(spark):
    batch = spark.createDataFrame([(1, "one"), (2, "two"), (3, "three")], "complaint_id long, narrative string")
    reply = '[{"id": 1, "label": 1, "evidence": "one"}, {"id": 2, "label": "perhaps", "evidence": "two"}, {"id": 3, "evidence": "three"}]'
    rows, _ = responses.explode_proposals(spark.createDataFrame([(0, reply)], "batch int, r string"), "r", ["batch"])
    assert rows.count() == 3
    labelled, missing = responses.attach_proposals(batch, rows.drop("batch"), "complaint_id", "m")
    assert [(r["complaint_id"], r["proposed_label"]) for r in labelled.collect()] == [(1, 1)]
    assert sorted(r["complaint_id"] for r in missing.collect()) == [2, 3]
