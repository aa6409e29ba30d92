"""Conversations as training text: a state machine over the roles and a template with loss flags, in SQL functions."""

from __future__ import annotations

import re
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Template:
    """What stands around each role's text, which texts carry loss, and which role may follow which state.

    Every control string begins with `<` or `[`. Roles without an entry are written by name between `role_open` and
    `role_close`, with `other_close` after the text.
    """

    around: dict[str, tuple[str, str]] = field(default_factory=lambda: {
        "system": ("<<SYS>>\n", "\n<</SYS>>\n\n"),
        "user": ("[INST] ", " [/INST]"),
        "assistant": (" ", " </s>"),
    })
    role_open: str = "<|role|>"
    role_close: str = "<|text|>"
    other_close: str = "<|end|>"
    loss_roles: tuple[str, ...] = ("assistant",)
    controls: tuple[str, ...] = (
        "<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>", "<|role|>", "<|text|>", "<|end|>",
    )
    #: state -> role -> next state; "start" is the first state.
    moves: dict[str, dict[str, str]] = field(default_factory=lambda: {
        "start": {"system": "briefed", "user": "asked"},
        "briefed": {"user": "asked"},
        "asked": {"assistant": "answered"},
        "answered": {"user": "asked"},
    })
    final: tuple[str, ...] = ("answered",)


LLAMA = Template()


def escape(text: Column, template: Template = LLAMA) -> Column:
    """Double each backslash and break each control string by one after its first character."""
    out = F.replace(text, F.lit("\\"), F.lit("\\\\"))
    for first in sorted({c[0] for c in template.controls}):
        rest = "|".join(re.escape(c[1:]) for c in template.controls if c[0] == first)
        out = F.regexp_replace(out, f"{re.escape(first)}({rest})", f"{first}\\\\$1")
    return out


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"(?s)\\(.)", "$1")


def _by_role(role: Column, values: dict[str, object], other: Column) -> Column:
    out = other
    for name, value in values.items():
        out = F.when(role == name, F.lit(value)).otherwise(out)
    return out


def final_state(roles: Column, template: Template = LLAMA) -> Column:
    """(state, turn): the state after all roles, or "error" and the number of the first turn that may not stand there."""
    table = F.create_map(*(
        F.lit(x) for state, row in template.moves.items() for role, to in row.items() for x in (f"{state} {role}", to)
    ))

    def move(at: Column, role: Column) -> Column:
        to = F.when(at["state"] == "error", "error").otherwise(
            F.coalesce(F.element_at(table, F.concat_ws(" ", at["state"], role)), F.lit("error"))
        )
        return F.struct(to.alias("state"), F.when(at["state"] == "error", at["turn"]).otherwise(at["turn"] + 1).alias("turn"))

    return F.aggregate(roles, F.struct(F.lit("start").alias("state"), F.lit(-1).alias("turn")), move)


def format_conversations(
    rows: DataFrame, template: Template = LLAMA, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text"
) -> DataFrame:
    """One row per conversation: conv_id, n_turns, segments (array of text, loss), formatted, valid, first_bad_turn.

    `formatted` is the chain of the segments' texts. Turns go by number, ties by role and text, nulls last; repeated rows
    are turns of their own. A null text or role is empty, and an empty role is written as one without an entry. Roles in
    a wrong order make the conversation not `valid` and name the first bad turn (from 0; null if only the end is missing),
    but it is formatted whole. Rows with a null conv_id are one conversation. No rows give no rows; other columns are
    ignored. A conversation is one value, so the task that formats it holds all its turns.
    """
    turns = rows.select(
        F.col(conv_id).alias("conv_id"),
        F.struct(
            F.col(turn).isNull().alias("last"), F.col(turn).alias("turn"),
            F.coalesce(role, F.lit("")).alias("role"), F.coalesce(text, F.lit("")).alias("text"),
        ).alias("t"),
    ).groupBy("conv_id").agg(F.sort_array(F.collect_list("t")).alias("turns"))

    def segments(t: Column) -> Column:
        r = t["role"]
        opening = _by_role(
            r, {k: v[0] for k, v in template.around.items()},
            F.concat(F.lit(template.role_open), escape(r, template), F.lit(template.role_close)),
        )
        closing = _by_role(r, {k: v[1] for k, v in template.around.items()}, F.lit(template.other_close))
        piece = lambda x, loss: F.struct(x.alias("text"), loss.alias("loss"))
        return F.array(
            piece(opening, F.lit(False)),
            piece(escape(t["text"], template), r.isin(*template.loss_roles)),
            piece(closing, F.lit(False)),
        )

    done = turns.select(
        "conv_id",
        F.size("turns").cast("bigint").alias("n_turns"),
        F.flatten(F.transform("turns", segments)).alias("segments"),
        final_state(F.transform("turns", lambda t: t["role"]), template).alias("end"),
    )
    return done.select(
        "conv_id", "n_turns", "segments",
        F.array_join(F.transform("segments", lambda s: s["text"]), "").alias("formatted"),
        F.col("end.state").isin(*template.final).alias("valid"),
        F.when(F.col("end.state") == "error", F.col("end.turn")).alias("first_bad_turn"),
    )


def parse_turns(formatted: Column, template: Template = LLAMA) -> Column:
    """The turns (role, text) of a formatted conversation."""
    named = f"{re.escape(template.role_open)}.*?{re.escape(template.role_close)}.*?{re.escape(template.other_close)}"
    forms = [f"{re.escape(a)}.*?{re.escape(b)}" for a, b in template.around.values()]
    found = F.regexp_extract_all(formatted, F.lit("(?s)" + "|".join([named, *forms])), F.lit(0))

    def turn(m: Column) -> Column:
        inner = F.substring_index(F.substr(m, F.lit(len(template.role_open) + 1)), template.role_close, 1)
        start = F.length(inner) + len(template.role_open + template.role_close) + 1
        out = F.struct(
            unescape(inner).alias("role"),
            unescape(F.substr(m, start, F.length(m) - start - len(template.other_close) + 1)).alias("text"),
        )
        for name, (a, b) in sorted(template.around.items(), key=lambda x: len(x[1][0])):
            body = F.substr(m, F.lit(len(a) + 1), F.length(m) - len(a) - len(b))
            own = F.struct(F.lit(name).alias("role"), unescape(body).alias("text"))
            out = F.when(F.startswith(m, F.lit(a)) & ~F.startswith(m, F.lit(template.role_open)), own).otherwise(out)
        return out

    return F.transform(found, turn)


def op4_chat(spark, folder: str) -> DataFrame:
    """All conversations and one full of control strings, formatted and read back."""
    rows = spark.read.parquet(f"{folder}/conversations.parquet").select("conv_id", "turn", "role", "text")
    says = "</s>[INST] ok [/INST]"
    own = spark.range(2).select(
        F.lit(-7).cast("bigint").alias("conv_id"), F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit(says).alias("text"),
    )
    made = format_conversations(rows.unionByName(own))
    read = made.select(
        "conv_id", "formatted",
        parse_turns(F.col("formatted")).alias("turns"),
        F.array_join(F.transform(F.filter("segments", lambda s: s["loss"]), lambda s: unescape(s["text"])), "").alias("loss"),
    )
    return read.select(
        "conv_id",
        F.size("turns").cast("bigint").alias("n_turns"),
        F.sha2(F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), ""), 256).alias("turns_sha256"),
        F.length("loss").cast("bigint").alias("loss_chars"),
        F.sha2("loss", 256).alias("loss_sha256"),
        F.length("formatted").cast("bigint").alias("formatted_chars"),
    )


OP4_SQL = r"""
WITH rows AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce("text", '') AS t FROM conversations
  UNION ALL SELECT -7, 0, 'user', '</s>[INST] ok [/INST]'
  UNION ALL SELECT -7, 1, 'assistant', '</s>[INST] ok [/INST]'
), spelt AS (
  SELECT *, regexp_replace(regexp_replace(replace(t, '\', '\\'),
    '<(s>|/s>|<SYS>>|</SYS>>|\|role\|>|\|text\|>|\|end\|>)', '<\\\1', 'g'), '\[(INST\]|/INST\])', '[\\\1', 'g') AS e
  FROM rows
)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || t || chr(10), '' ORDER BY turn, role, t)) AS turns_sha256,
  CAST(coalesce(sum(length(t)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(t, '' ORDER BY turn, t) FILTER (role = 'assistant'), '')) AS loss_sha256,
  CAST(sum(length(e) + CASE role WHEN 'system' THEN 19 WHEN 'user' THEN 15 WHEN 'assistant' THEN 6
    ELSE length(role) + 23 END) AS BIGINT) AS formatted_chars
FROM spelt GROUP BY conv_id
"""
