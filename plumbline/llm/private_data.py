"""Personal data: fixed shapes as seeds, and contexts bootstrapped from them for identifiers of other shapes."""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from plumbline.llm.graph import landed
from plumbline.storage import run_folder

KINDS = ("email", "ip", "card", "phone")
EMAIL, IP, CARD, PHONE = range(4)

#: Rounds in which patterns and instances score each other.
ROUNDS = 3
#: A pattern is trusted for a kind if this share of its instances is of the kind ...
CONFIDENCE = 0.8
#: ... and so many different ones are.
SUPPORT = 3
#: An instance belongs to a kind if this share of its contexts has a trusted pattern.
ACCEPTED = 0.5
#: Longer candidates are known by a digest, and have no kind unless they are seeds.
LONGEST = 320
#: Code points on either side of a candidate that its context is read from.
REACH = 100

#: The shapes that the contract names.
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_LOCAL = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-"

_SIGN = re.compile(r"[0-9@][^ \t-\r]*")
_DIGIT = re.compile(r"[0-9]")
_LETTER = re.compile(r"[^\W\d_]|@")
_SPACE = " \t\n\x0b\x0c\r"
_EDGE = ".,;:!?\"'`()[]{}<>=*#$%&|/\\_~^-"


# ---- seeds ----


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        n = int(d) * (1 + i % 2)
        total += n - 9 if n > 9 else n
    return total % 10 == 0


def only_digits(text: str) -> str:
    return "".join(c for c in text if "0" <= c <= "9")


def emails(text: str) -> Iterator[tuple[int, int]]:
    """Leftmost matches of local part, @ and domain, found from each @ in linear time."""
    low = 0
    at = text.find("@")
    while at >= 0:
        start = low + len(text[low:at].rstrip(_LOCAL))
        found = _DOMAIN.match(text, at + 1) if start < at else None
        if found:
            yield start, found.end()
        low = found.end() if found else at + 1
        at = text.find("@", low)


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind, end) of emails, addresses, cards and phones, in order; matches that fail their kind's check go."""
    out = [(a, EMAIL, b) for a, b in emails(text)] if "@" in text else []
    if _DIGIT.search(text):
        if "." in text:
            for m in _IP.finditer(text):
                if all(len(x.lstrip("0")) <= 3 and int(x.lstrip("0") or 0) <= 255 for x in m[0].split(".")):
                    out.append((m.start(), IP, m.end()))
        for m in _CARD.finditer(text):
            if m.end() - m.start() >= 12 and 12 <= len(d := only_digits(m[0])) <= 19 and luhn(d):
                out.append((m.start(), CARD, m.end()))
        if "+" in text:
            for m in _PHONE.finditer(text):
                if 9 <= len(only_digits(m[0])) <= 15:
                    out.append((m.start(), PHONE, m.end()))
        out.sort()
    return out


# ---- candidates ----


def fits(text: str) -> list[int]:
    """The kinds that a candidate of no fixed shape may have, by its letters and digits.

    One that has the shape of a kind but fails that kind's check is none.
    """
    local, at, host = text.partition("@")
    if at:
        return [EMAIL] if local and host and "@" not in host else []
    if _LETTER.search(text):
        return [IP] if re.fullmatch(r"[0-9A-Fa-f]{0,4}(?::[0-9A-Fa-f]{0,4}){2,7}", text) else []
    if _IP.fullmatch(text) or _PHONE.fullmatch(text):
        return []
    digits = only_digits(text)
    out = [CARD] if 12 <= len(digits) <= 19 and luhn(digits) else []
    return out + ([PHONE] if 7 <= len(digits) <= 15 and not (len(digits) >= 12 and _CARD.fullmatch(text)) else [])


def candidate_spans(text: str, seeds: list[tuple[int, int, int]]) -> list[tuple[int, int]]:
    """Words with a digit or an @ beside the seeds, without punctuation at the edges; words of numbers in a row are one."""
    taken = iter([*seeds, (len(text) + 1, 0, len(text) + 1)])
    reach, nxt = 0, next(taken)  # the end of the seeds passed, the next seed
    out: list[tuple[int, int]] = []
    low, numbers = 0, False  # the end of the last word; whether the last candidate has only numbers
    for m in _SIGN.finditer(text):
        start = max(low, 1 + max(text.rfind(c, low, m.start()) for c in _SPACE))
        end = low = m.end()
        while nxt[0] < end:
            reach, nxt = max(reach, nxt[2]), next(taken)
        if start < reach:
            continue
        word = text[start:end]
        start += len(word) - len(word.lstrip(_EDGE))
        end -= len(word) - len(word.rstrip(_EDGE))
        if not _DIGIT.search(text, start, end) and "@" not in text[start:end]:
            continue
        number = not _LETTER.search(text, start, end)
        if number and numbers and text[out[-1][1] : start] in (" ", ") ", " ("):
            out[-1] = (out[-1][0], end)
        else:
            out.append((start, end))
        numbers = number
    return out


def context(text: str, start: int, end: int) -> tuple[str, str, str]:
    """The two words before and the word behind, lower-cased, digits as 0; empty where the text ends."""
    before = text[max(0, start - REACH) : start].split()[-2:]
    behind = text[end : end + REACH].split(None, 1)[:1]
    words = [*[""] * (2 - len(before)), *before, *(behind or [""])]
    return tuple(_DIGIT.sub("0", w.lower()) for w in words)


def patterns(words: tuple[str, str, str]) -> list[str]:
    """Lexical patterns of a context, `_` for the instance: two words before, one before, one on either side."""
    second, first, behind = words
    out = [f"{first} _"] if first else []
    out += [f"{second} {first} _"] if second and first else []
    return out + ([f"{first} _ {behind}"] if first and behind else [])


_SPAN = T.StructType([
    T.StructField("start", T.IntegerType()), T.StructField("kind", T.IntegerType()), T.StructField("end", T.IntegerType()),
    T.StructField("text", T.StringType()), T.StructField("base", T.BooleanType()),
])
_CANDIDATE = T.StructType([
    T.StructField("start", T.IntegerType()), T.StructField("end", T.IntegerType()), T.StructField("seed", T.IntegerType()),
    T.StructField("kinds", T.ArrayType(T.IntegerType())), T.StructField("text", T.StringType()),
    T.StructField("context", T.StringType()), T.StructField("patterns", T.ArrayType(T.StringType())),
])


def scanned(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    """(doc_id, mark, spans, candidates) of every row: seeds, and all candidates with their patterns; mark names the text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark.sql.pandas.types import to_arrow_type

        for batch in batches:
            marks, spans, candidates = [], [], []
            for t in batch.column(1).to_pylist():
                t = t or ""
                marks.append(hashlib.blake2b(t.encode("utf-8", "surrogatepass"), digest_size=16).digest())
                seeds = base_spans(t)
                spans.append([{"start": a, "kind": k, "end": b, "text": t[a:b], "base": True} for a, k, b in seeds])
                own = []
                for a, b, seed in [(a, b, k) for a, k, b in seeds] + [(a, b, None) for a, b in candidate_spans(t, seeds)]:
                    words = context(t, a, b)
                    own.append({
                        "start": a, "end": b, "seed": seed, "kinds": fits(t[a:b]) if seed is None and b - a <= LONGEST else [], "text": t[a:b].lower() if b - a <= LONGEST else hashlib.blake2b(t[a:b].encode("utf-8", "surrogatepass")).hexdigest(),
                        "context": " ".join([words[0], words[1], "_", words[2]]), "patterns": patterns(words),
                    })
                candidates.append(own)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(marks, pa.binary()), *(pa.array(x, to_arrow_type(T.ArrayType(s))) for x, s in ((spans, _SPAN), (candidates, _CANDIDATE)))],
                ["doc_id", "mark", "spans", "candidates"],
            )

    schema = T.StructType([
        T.StructField("doc_id", docs.schema[doc_id].dataType), T.StructField("mark", T.BinaryType()),
        T.StructField("spans", T.ArrayType(_SPAN)), T.StructField("candidates", T.ArrayType(_CANDIDATE)),
    ])
    return docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text")).mapInArrow(run, schema)


# ---- bootstrapping ----


def bootstrap(found: DataFrame, folder: str, rounds: int = ROUNDS, confidence: float = CONFIDENCE, support: int = SUPPORT) -> tuple[DataFrame, DataFrame] | None:
    """Trusted patterns (pattern, kind, confidence) and instances of no fixed shape (text, kind, score); None if none are.

    The graph has an edge from each instance to each pattern of each of its different contexts; copies count once. A
    round scores patterns by the mean score of their instances, then instances by the share of their contexts that
    have a trusted pattern. Seeds keep a score of one. All steps are joins and aggregates over written tables.
    """
    each = found.select(F.explode("candidates").alias("c")).select("c.*")
    edges = each.select("text", "context", "patterns").distinct().select("text", "context", F.explode("patterns").alias("pattern"))
    edges = landed(edges, f"{folder}/edges.parquet")
    seeds = each.where("seed IS NOT NULL").select("text", F.col("seed").alias("kind")).distinct().withColumn("score", F.lit(1.0))
    seeds = landed(seeds, f"{folder}/seeds.parquet")
    loose = each.where("seed IS NULL").select("text", F.explode("kinds").alias("kind")).distinct().join(seeds.select("text").distinct(), "text", "left_anti")
    loose = landed(loose, f"{folder}/loose.parquet")
    pairs = landed(edges.select("pattern", "text").distinct(), f"{folder}/pairs.parquet")
    sizes = landed(pairs.groupBy("pattern").agg(F.count(F.lit(1)).alias("n")), f"{folder}/sizes.parquet")
    contexts = landed(edges.join(loose.select("text").distinct(), "text", "left_semi").groupBy("text").agg(F.countDistinct("context").alias("n")), f"{folder}/contexts.parquet")
    scores, instances, trusted = seeds, None, None
    for number in range(rounds):
        mass = pairs.join(scores, "text").groupBy("pattern", "kind").agg(F.sum("score").alias("mass"), F.count(F.lit(1)).alias("support"))
        sure = mass.where(F.col("support") >= support).join(sizes, "pattern").withColumn("confidence", F.col("mass") / F.col("n"))
        trusted = landed(sure.where(F.col("confidence") >= confidence).select("pattern", "kind", "confidence"), f"{folder}/trusted-{number}.parquet")
        sure = edges.join(trusted, "pattern").join(loose, ["text", "kind"]).select("text", "kind", "context").distinct()
        scored = sure.groupBy("text", "kind").agg(F.count(F.lit(1)).alias("sure")).join(contexts, "text").select("text", "kind", (F.col("sure") / F.col("n")).alias("score"))
        instances = landed(scored.where(F.col("score") >= ACCEPTED), f"{folder}/instances-{number}.parquet")
        if instances.isEmpty():
            return None
        scores = seeds.unionByName(instances)
    return trusted, instances


def find_private(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", rounds: int = ROUNDS, confidence: float = CONFIDENCE, support: int = SUPPORT) -> DataFrame:
    """(doc_id, spans) for every row: array of (start, kind, end, text, base) by start and kind, kinds as numbers of `KINDS`.

    Places are code points of the whole text, ends exclusive. Seeds (`base`) always stay. A candidate beside them is added if one
    of its patterns is trusted and its text is an accepted instance of that kind; of several kinds the surest counts, then the first. Null
    and empty texts have no spans; repeated rows and ids come back as they are; other columns are ignored; an empty table
    gives no rows.
    """
    folder = run_folder(docs.sparkSession, "private")
    found = landed(scanned(docs, doc_id, text), f"{folder}/scanned.parquet")
    learned = bootstrap(found, f"{folder}/bootstrap", rounds, confidence, support)
    if learned is None:
        return found.select("doc_id", "spans")
    trusted, instances = learned
    each = found.select("mark", F.explode("candidates").alias("c")).where("c.seed IS NULL AND size(c.kinds) > 0")
    places = each.select("mark", "c.start", "c.end", "c.text", "c.patterns").distinct()
    known = places.join(instances, "text").select("mark", "start", "end", "text", "kind", "score", F.explode("patterns").alias("pattern"))
    sure = known.join(trusted, ["pattern", "kind"]).groupBy("mark", "start", "end", "text").agg(
        F.min(F.struct((-F.col("score")).alias("score"), "kind")).alias("best")
    )
    span = F.struct("start", F.col("best.kind").alias("kind"), "end", "text", F.lit(False).alias("base"))
    more = landed(sure.groupBy("mark").agg(F.collect_list(span).alias("more")), f"{folder}/more.parquet")
    both = F.when(F.col("more").isNull(), F.col("spans")).otherwise(F.array_sort(F.concat("spans", "more")))
    return found.join(more, "mark", "left").select("doc_id", both.alias("spans"))


def op12_pii(spark: SparkSession, folder: str) -> DataFrame:
    """Personal data of every document, as counts and digests of spans."""
    found = find_private(spark.read.parquet(f"{folder}/documents.parquet"))
    base = F.filter("spans", lambda s: s["base"])
    names = F.array(*map(F.lit, KINDS))
    written = lambda spans: F.array_join(F.transform(spans, lambda s: F.concat_ws(":", names[s["kind"]], s["start"], s["end"])), ",")
    of = lambda kind: F.filter(base, lambda s: s["kind"] == kind)
    counts = [F.size(of(k)).cast("bigint").alias(f"n_{name}") for k, name in enumerate(KINDS)]
    return found.select("doc_id", *counts, F.sha2(written(base), 256).alias("base_sha256"), written(F.col("spans")).alias("spans"))
