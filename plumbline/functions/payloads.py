"""Column expressions over model replies that should hold JSON.

A reply is parsed once into a VARIANT. Where a Python reader and Spark differ, Spark's rule holds: `NaN`
and objects with a repeated key count as not parseable.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from plumbline.schemas import EXTRACTION_KEYS, URGENCY_LEVELS

# What a reply is made of from its first bracket on: strings, brackets, and all between them. A string without an end goes to
# the end. Possessive repeats keep the match linear in the length of the reply.
_TOKEN = r'(?s)("(?:[^"\\]++|\\.)*+"|"(?:[^"\\]++|\\.)*+|\[|\]|[^"\[\]]++)'

# Ids and labels are read as text, so that "1", 1.0 and true are understood like 1.
PROPOSAL_DDL = "array<struct<id:string,label:string,evidence:string,confidence:string>>"


def parsed(reply: Column) -> Column:
    """The reply as a VARIANT, NULL where it is no JSON."""
    return F.try_parse_json(reply)


def kind(value: Column, path: str) -> Column:
    """Type name at a path: NULL for a missing key, VOID for a JSON null."""
    return F.schema_of_variant(F.variant_get(value, path, "variant"))


def has_keys(value: Column, keys: tuple[str, ...] = EXTRACTION_KEYS) -> Column:
    """Whether every key is present; a JSON null counts as present."""
    present = (F.variant_get(value, f"$.{key}", "variant").isNotNull() for key in keys)
    return F.coalesce(reduce(Column.__and__, present), F.lit(False))


def text_at(value: Column, path: str) -> Column:
    return F.try_variant_get(value, path, "string")


def is_valid_extraction(value: Column) -> Column:
    """All keys there, two texts, an urgency level and a flag; further keys are allowed."""
    checks = (
        has_keys(value),
        kind(value, "$.product") == "STRING",
        kind(value, "$.issue_summary") == "STRING",
        kind(value, "$.urgency") == "STRING",
        text_at(value, "$.urgency").isin(*URGENCY_LEVELS),
        kind(value, "$.mentions_legal_action") == "BOOLEAN",
    )
    return F.coalesce(reduce(Column.__and__, checks), F.lit(False))


def truthy(value: Column, path: str) -> Column:
    """Whether the value at the path counts as true: not null, false, zero, '', [] or {}. NULL if missing."""
    name = kind(value, path)
    as_text = text_at(value, path)
    return (
        F.when(name.isNull(), F.lit(None).cast("boolean"))
        .when(name == "VOID", F.lit(False))
        .when(name == "BOOLEAN", F.try_variant_get(value, path, "boolean"))
        .when(name == "STRING", as_text != "")
        .when(name.startswith("ARRAY"), ~as_text.isin("[]"))
        .when(name.startswith("OBJECT"), ~as_text.isin("{}"))
        .otherwise(F.try_variant_get(value, path, "double") != 0)
    )


def rationale_text(value: Column) -> Column:
    """The rationale as text: '' if the key is missing."""
    name = kind(value, "$.rationale")
    return F.when(name.isNull(), F.lit("")).when(name == "VOID", F.lit("None")).otherwise(text_at(value, "$.rationale"))


def payload_array(reply: Column) -> Column:
    """Text of the first JSON array in a reply, '' if there is none or it does not end.

    The array ends at the bracket that closes its first one, at any depth; brackets inside strings do not count.
    """
    rest = F.substring(reply, F.nullif(F.locate("[", reply), F.lit(0)), F.length(reply))
    tokens = F.regexp_extract_all(rest, F.lit(_TOKEN), F.lit(1))
    start = F.struct(F.lit(0).alias("depth"), F.lit(0).alias("read"), F.lit(False).alias("ended"))

    def step(state: Column, token: Column) -> Column:
        depth = state["depth"] + F.when(token == "[", 1).when(token == "]", -1).otherwise(0)
        after = F.struct(depth.alias("depth"), (state["read"] + F.length(token)).alias("read"), (depth == 0).alias("ended"))
        return F.when(state["ended"], state).otherwise(after)

    end = F.aggregate(tokens, start, step)
    found = F.coalesce(F.when(end["ended"], F.substring(rest, F.lit(1), end["read"])), F.lit(""))
    return F.when(reply.isNotNull(), found)


def proposals_in(reply: Column) -> Column:
    """Typed proposal objects of a batch reply, NULL if the reply holds no readable array."""
    found = F.from_json(F.nullif(payload_array(reply), F.lit("")), PROPOSAL_DDL, {"mode": "PERMISSIVE"})
    return F.transform(found, lambda p: F.struct(
        whole_number(p["id"]).alias("id"), whole_number(p["label"]).cast("int").alias("label"),
        p["evidence"].alias("evidence"), p["confidence"].alias("confidence"),
    ))


def whole_number(value: Column) -> Column:
    """A number, a number in quotes or a truth value as a long; NULL for anything else."""
    truth = F.when(value == "true", F.lit(1)).when(value == "false", F.lit(0)).cast("bigint")
    return F.coalesce(value.try_cast("bigint"), truth, value.try_cast("double").try_cast("bigint"))
