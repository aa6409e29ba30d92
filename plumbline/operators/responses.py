"""Requests for a model and the tables of its replies."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plumbline.functions.numbers import ns_to_ms, rounded
from plumbline.functions.payloads import (
    has_keys,
    is_valid_extraction,
    parsed,
    proposals_in,
    rationale_text,
    text_at,
    truthy,
)
from plumbline.functions.text import is_verbatim, loose_match, or_empty
from plumbline.operators.joins import anti_join_todo, in_vocabulary, paired_condition_join, proposal_match
from plumbline.operators.sampling import batch_assign
from plumbline.operators.usage import duration_stats, paired_delta_stats

def single_prompt(narrative: Column, rubric: str) -> Column:
    """Prompt for one narrative."""
    return F.concat(F.lit(rubric), F.lit("\n\nNARRATIVE:\n"), narrative)


def batch_prompts(df: DataFrame, batch: str, position: str, key: str, text: str, rubric: str) -> DataFrame:
    """One prompt per batch, its narratives in row order. Batches have a fixed small size."""
    blocks = F.transform(
        F.sort_array(F.collect_list(F.struct(position, key, text))),
        lambda row: F.concat(
            F.lit("--- narrative id="), row[key].cast("string"), F.lit(" ---\n"), row[text], F.lit("\n")
        ),
    )
    return df.groupBy(batch).agg(
        F.count(F.lit(1)).alias("n_rows"), F.concat_ws("\n", F.lit(rubric), F.lit(""), blocks).alias("prompt")
    )


def build_requests(df: DataFrame, done: DataFrame, key: str, text: str, size: int, rubric: str) -> DataFrame:
    """Prompts for the rows that are not done, in consecutive batches."""
    todo = anti_join_todo(df.select(key, text), done, key)
    return batch_prompts(batch_assign(todo, key, size), "batch", "position", key, text, rubric)


def explode_proposals(replies: DataFrame, reply: str, carry: list[str]) -> tuple[DataFrame, DataFrame]:
    """Typed proposals of batch replies with their position, and the replies that hold no readable array."""
    read = replies.withColumn("_items", proposals_in(F.col(reply)))
    rows = read.filter(F.col("_items").isNotNull()).select(*carry, F.posexplode("_items").alias("position", "_p"))
    rejects = read.filter(F.col("_items").isNull()).select(*carry, reply)
    return rows.select(*carry, "position", "_p.id", "_p.label", "_p.evidence", "_p.confidence"), rejects


def attach_proposals(batch: DataFrame, proposals: DataFrame, key: str, model: str) -> tuple[DataFrame, DataFrame]:
    """Pre-labelled rows in the published layout, and the rows to ask for again.

    A proposal whose label is no number or is missing answers nothing: its row is asked for again.
    """
    matched, missing = proposal_match(batch, proposals.filter(F.col("label").isNotNull()), key)
    quote = or_empty(F.col("evidence"))
    labelled = matched.select(
        *batch.columns,
        F.col("label").cast("int").alias("proposed_label"),
        quote.alias("evidence_quote"),
        or_empty(F.col("confidence")).alias("confidence"),
        is_verbatim(quote, F.col("narrative")).alias("evidence_verbatim"),
        F.lit(model).alias("labeler_model"),
    )
    return labelled, missing


def proposal_summary(df: DataFrame) -> DataFrame:
    return df.agg(
        F.count(F.lit(1)).alias("n"),
        F.count_if(F.col("proposed_label") == 1).alias("n_proposed_positive"),
        F.count_if("evidence_verbatim").alias("n_verbatim"),
    )


def classify_responses(df: DataFrame, reply: str, duration_ns: str) -> DataFrame:
    """Label, rationale and failure flag of every reply; a reply without a readable label counts as 0 and failed."""
    read = df.withColumn("_v", parsed(F.col(reply)))
    label = read.withColumn("_label", truthy(F.col("_v"), "$.churn_signal"))
    failed = F.col("_label").isNull()
    return label.withColumns(
        {
            "predicted_label": F.coalesce(F.col("_label").cast("int"), F.lit(0)),
            "parse_failed": failed,
            "rationale": F.when(failed, F.lit("")).otherwise(rationale_text(F.col("_v"))),
            "eval_duration_ms": rounded(ns_to_ms(F.col(duration_ns)), 1),
        }
    ).drop("_v", "_label", reply, duration_ns)


def usable_response_filter(df: DataFrame) -> DataFrame:
    """Rows with a readable reply and a rationale."""
    return df.filter(~F.col("parse_failed") & (F.col("rationale") != ""))


def extraction_flags(df: DataFrame, reply: str, true_product: str) -> DataFrame:
    """Whether a reply is JSON, has the required keys, meets the strict rules and names the right product."""
    read = df.withColumn("_v", parsed(F.col(reply)))
    strict = is_valid_extraction(F.col("_v"))
    match = loose_match(F.col(true_product), text_at(F.col("_v"), "$.product"))
    return read.withColumns(
        {
            "json_parsed": F.col("_v").isNotNull(),
            "has_keys": has_keys(F.col("_v")),
            "schema_valid": strict,
            "product": text_at(F.col("_v"), "$.product"),
            "loose_match": strict & F.coalesce(match, F.lit(False)),
        }
    ).drop("_v")


def extraction_rates(flags: DataFrame, by: list[str] = [], digits: int = 3) -> DataFrame:
    """Shares over all samples, failed ones included."""

    def share(flag: str, name: str) -> Column:
        return rounded(F.avg(F.col(flag).cast("int")), digits).alias(name)

    return flags.groupBy(*by).agg(
        F.count(F.lit(1)).alias("n_samples"),
        share("json_parsed", "json_parse_rate"),
        share("schema_valid", "schema_valid_rate"),
        share("loose_match", "loose_match_rate"),
    )


def extraction_report(df: DataFrame, reply: str, true_product: str, ms: str, by: list[str], digits: int = 3) -> DataFrame:
    """Validity rates and durations per group."""
    flags = extraction_flags(df, reply, true_product)
    return extraction_rates(flags, by, digits).join(duration_stats(flags, ms, by, digits), by)


def enum_effect_report(df: DataFrame, key: str, names: tuple[str, str], vocabulary: tuple[str, ...], digits: int = 2):
    """Free against closed vocabulary: token means, their difference, and how often the product is a listed one.

    `df` has one row per id and condition, with its reply and token count.
    """
    read = df.withColumn("product", text_at(parsed(F.col("response")), "$.product"))
    flagged = in_vocabulary(read, "product", vocabulary)
    deltas = paired_delta_stats(paired_condition_join(flagged, [key], "condition", "eval_count", names), *names, digits)

    def hits(name: str) -> Column:
        return F.count_if((F.col("condition") == name) & F.col("in_vocabulary"))

    found = flagged.agg(F.struct(hits(names[0]).alias("first"), hits(names[1]).alias("second"))).scalar()
    listed = deltas.withColumn("_hits", found)
    return listed.withColumns({"listed_first": F.col("_hits.first"), "listed_second": F.col("_hits.second")}).drop("_hits")


def apply_review(proposals: DataFrame, decisions: DataFrame, key: str) -> DataFrame:
    """Proposals with the reviewer's decision: '' accepts, '0' and '1' set the label, 'a' marks ambiguous,
    's' or no answer leaves the row open."""
    answered = proposals.join(decisions.select(key, "answer"), key, "left")
    answer = F.lower(F.trim("answer"))
    label = F.when(answer == "", F.col("proposed_label")).when(answer.isin("0", "1"), answer.cast("int"))
    marked = answered.withColumn("churn_signal", label.cast("int"))
    settled = F.col("churn_signal").isNotNull()
    overrode = F.when(settled, F.col("churn_signal") != F.col("proposed_label")).when(answer == "a", F.lit(False))
    ambiguous = F.when(settled, F.lit(False)).when(answer == "a", F.lit(True))
    return marked.withColumns({"ambiguous": ambiguous, "human_overrode": overrode}).drop("answer")


def review_summary(df: DataFrame) -> DataFrame:
    """How far a review has come."""
    labelled = F.col("churn_signal").isNotNull()
    ambiguous = F.coalesce("ambiguous", F.lit(False))
    return df.agg(
        F.count(F.lit(1)).alias("n_total"),
        F.count_if(labelled | ambiguous).alias("n_reviewed"),
        F.count_if(labelled).alias("n_labelled"),
        F.count_if(F.col("churn_signal") == 1).alias("n_positive"),
        F.count_if(labelled & F.coalesce("human_overrode", F.lit(False))).alias("n_overrides"),
        F.count_if(ambiguous).alias("n_ambiguous"),
        F.count_if(~(labelled | ambiguous)).alias("n_remaining"),
    )
