"""Column expressions over text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def id_hash(key: Column) -> Column:
    """Hash of an id taken as text; md5 because every engine computes the same value."""
    return F.md5(key.cast("string"))


def word_set(text: Column) -> Column:
    """Distinct lower-cased words between runs of white space."""
    return F.array_distinct(F.array_remove(F.split(F.lower(text), r"[ \t\n\r\f\x0B]+"), ""))


def jaccard(a: Column, b: Column) -> Column:
    """Shared share of two word sets; two empty sets count as equal."""
    union = F.size(F.array_union(a, b))
    return F.when(union == 0, F.lit(1.0)).otherwise(F.size(F.array_intersect(a, b)) / union)


def squeezed(text: Column) -> Column:
    """White-space runs as one blank, no blank at the ends, lower case."""
    return F.lower(F.trim(F.regexp_replace(text, r"(?U)\s+", " ")))


def is_verbatim(evidence: Column, narrative: Column) -> Column:
    """Whether the quote occurs in the narrative; no quote needs no evidence."""
    quote = F.coalesce(evidence, F.lit(""))
    return (quote == "") | F.coalesce(F.contains(squeezed(narrative), squeezed(quote)), F.lit(False))


def loose_match(true_value: Column, found: Column) -> Column:
    """Whether the first word of the true value occurs in the found value, ignoring case."""
    first = F.lower(F.regexp_extract(true_value, r"^\s*(\S+)", 1))
    return F.contains(F.lower(found), first)


def padded(rationale: Column, filler: str) -> Column:
    """The rationale without its trailing dots, then one dot and the filler."""
    return F.concat(F.rtrim(rationale, F.lit(".")), F.lit("."), F.lit(filler))


def snapshot_suffix(since: str | None, until: str | None) -> str:
    """Name suffix of a bounded extract, dates without dashes."""
    return f"{since or 'start'}_{until or 'now'}".replace("-", "")


def window_suffix(since: Column, until: Column) -> Column:
    """`snapshot_suffix` of two columns of dates; a missing date is an open end."""
    ends = (F.coalesce(c.cast("string"), F.lit(name)) for c, name in ((since, "start"), (until, "now")))
    return F.replace(F.concat_ws("_", *ends), F.lit("-"), F.lit(""))


def or_empty(value: Column) -> Column:
    """The value as text, '' where it is missing."""
    return F.coalesce(value.cast("string"), F.lit(""))
