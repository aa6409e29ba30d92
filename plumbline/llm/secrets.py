"""Secrets in texts: candidates by shape, false findings removed by a random forest; SQL functions and Spark ML only."""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.pipeline import Pipeline
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from plumbline.llm.sampling import smallest_hashes
from plumbline.storage import checkpointed

#: Shapes of a candidate word: a run of key characters with a digit, or the start of a known kind of key.
RUN = r"[A-Za-z0-9_+/=.\-]{8,}"
KINDS = {
    "cloud key": r"(AKIA|ASIA)[0-9A-Z]{16}",
    "host token": r"(ghp|gho|ghs|ghr)_[A-Za-z0-9]{20,}|glpat-[A-Za-z0-9_\-]{16,}",
    "chat token": r"xox[abprs]-[A-Za-z0-9\-]{10,}",
    "service key": r"(sk|pk|rk)[_\-][A-Za-z0-9_\-]{16,}",
    "signed token": r"eyJ[A-Za-z0-9_\-]+\.[A-Za-z0-9_\-]+",
    "private key": r"-----BEGIN",
}
#: Words that name a secret, and words that name other strings of the same shape.
NAMED = r"token|passw|passwd|pwd|secret|api_?key|apikey|access_?key|auth|bearer|credential|private"
OTHER = r"commit|revision|checksum|sha\d*|md5|digest|uuid|guid|etag|version|build|example|sample|dummy|placeholder|https?:|www\."
PATHS = r"(?i)test|example|sample|mock|fixture|docs?/"
SHAPED = f"^(?=.*[0-9])(?=.*[A-Za-z]).*{RUN}|^.*(?i:{NAMED})[^=:]*[=:].{{4,}}|{'|'.join(KINDS.values())}"
#: The end of the words before a value that a name is given to.
GIVEN = rf"(?i:{NAMED})[^=:\s]*\s?[=:]+>?$"
#: Where one word is cut in pieces: before a further name with a sign, between quoted values, before a known kind of key
#: and between long runs of key characters.
CUT = "|".join([
    r"""["'`]?[,;&?|{}\[\]()<>#]+(?=["'`]?[A-Za-z_][A-Za-z0-9_.\-]{0,40}["'`]?[=:])""",
    r"""(?<=["'`])[\]}]*,[\[{]*(?=["'`])""",
    rf"[,;&?|]+(?=[\"'`]?(?:{'|'.join(KINDS.values())}))",
    r"(?<=[A-Za-z0-9_+/=.\-]{16})[,;|]+(?=[A-Za-z0-9_+/=.\-]{16})",
])
#: Words of the corpus that count as its dictionary, and letter pairs that count as common.
DICTIONARY, PAIRS = 4000, 250
#: Labelled findings that the forest is fitted on, at most.
SAMPLE_FINDINGS = 20_000
TREES, DEPTH, SEED = 40, 8, 17
THRESHOLD = 0.5
AROUND = 3

FEATURES = [
    "length", "digits", "uppers", "lowers", "marks", "turns", "turn_rate", "distinct", "entropy", "common_pairs",
    "dictionary", "named", "named_far", "other", "assigned", "quoted", "known_kind", "path_other",
]


# ---- candidates ----


def pieces(rows: DataFrame) -> DataFrame:
    """`rows` (word, before and others) with a row for each candidate piece of the word, in place of the word.

    A further piece has the words before it only through the name that its value belongs to. A word that only as a whole
    has the shape of a candidate, or only its place, stays whole.
    """
    cut = F.filter(F.split("word", CUT), lambda x: x != "")
    name = F.regexp_extract(F.array_join(F.slice("_cut", F.lit(1), F.col("_p.i")), " "), r"""([A-Za-z0-9_.\-]+)["'`]?[=:][^=:]*$""", 1)
    own = F.rlike("_p.piece", F.lit(r"""^["'`]?[A-Za-z0-9_.\-]+["'`]?[=:]"""))
    shaped = F.filter(
        F.transform("_cut", lambda x, i: F.struct(i.alias("i"), x.alias("piece"))),
        lambda c: (F.length(c["piece"]) >= 8) & F.rlike(c["piece"], F.lit(SHAPED)),
    )
    whole = F.array(F.struct(F.lit(0).alias("i"), F.col("word").alias("piece")))
    cut_rows = rows.withColumn("_cut", cut).withColumn("_p", shaped)
    cut_rows = cut_rows.withColumn("_p", F.explode(F.when(F.size("_p") > 0, F.col("_p")).otherwise(whole)))
    before = F.when(F.col("_p.i") == 0, F.col("before")).when(own | (name == ""), "").otherwise(F.concat(name, F.lit(" =")))
    return cut_rows.withColumns({"before": before, "word": F.col("_p.piece")}).drop("_cut", "_p")


def candidates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", path: str | None = None) -> DataFrame:
    """(doc_id, position, word, before, after, path): what could hold a secret, with up to three words on either side.

    `position` is the number of the white-space word in the text, from 0; a word with several assigned values or keys gives
    a row for each, with its piece as `word`. A word of four characters or more right behind a secret's name and a sign
    is a candidate whatever its shape.
    """
    words = docs.select(
        F.col(doc_id).alias("doc_id"),
        F.split(F.trim(F.coalesce(F.col(text), F.lit(""))), r"\s+").alias("words"),
        F.coalesce(F.col(path).cast("string") if path else F.lit(None).cast("string"), F.lit("")).alias("path"),
        F.coalesce(F.rlike(F.col(text), F.lit(r"[=:>]\s")), F.lit(False)).alias("signs"),
    )
    given = lambda c: (
        (F.length(c["word"]) >= 4)
        & F.coalesce(F.right(c["last"], F.lit(1)).isin("=", ":", ">"), F.lit(False))
        & F.rlike(F.concat_ws(" ", c["second_last"], c["last"]), F.lit(GIVEN))
    )
    shaped = lambda c: (F.length(c["word"]) >= 8) & F.rlike(c["word"], F.lit(SHAPED))
    blank = F.array(F.lit(""))
    # the words before each word stand beside it: a look back into the array would split the text again for each word
    lasts = F.zip_with(F.concat(blank, "words"), F.concat(blank, blank, "words"), lambda x, y: F.struct(x.alias("last"), y.alias("second_last")))
    placed = F.transform("words", lambda w, i: F.struct(i.alias("position"), w.alias("word")))
    beside = F.zip_with(placed, lasts, lambda x, y: F.struct(
        x["position"].alias("position"), x["word"].alias("word"), y["last"].alias("last"), y["second_last"].alias("second_last")
    ))
    bare = lambda found: F.transform(found, lambda c: F.struct(c["position"].alias("position"), c["word"].alias("word")))
    found = F.when(F.col("signs"), bare(F.filter(beside, lambda c: shaped(c) | given(c)))).otherwise(F.filter(placed, shaped))
    rows = words.withColumn("found", found).where(F.size("found") > 0).withColumn("c", F.explode("found"))
    start = F.greatest(F.col("c.position") + 1 - AROUND, F.lit(1))
    return pieces(rows.select(
        "doc_id",
        F.col("c.position").cast("bigint").alias("position"),
        F.col("c.word").alias("word"),
        F.array_join(F.slice("words", start, F.col("c.position") + 1 - start), " ").alias("before"),
        F.array_join(F.slice("words", F.col("c.position") + 2, F.lit(AROUND)), " ").alias("after"),
        "path",
    ))


# ---- statistics of the corpus ----


def corpus_words(docs: DataFrame, text: str = "text") -> DataFrame:
    """(word, n) of the lower-case letter words of all texts, at most twelve letters long."""
    split = F.split(F.lower(F.coalesce(F.col(text), F.lit(""))), r"[^\p{L}]+")
    return docs.select(F.explode(split).alias("word")).where("length(word) BETWEEN 2 AND 12").groupBy("word").agg(F.count(F.lit(1)).alias("n"))


def statistics(docs: DataFrame, text: str = "text") -> tuple[list[str], list[str]]:
    """The `DICTIONARY` most frequent words of four letters or more and the `PAIRS` most frequent letter pairs."""
    words = checkpointed(corpus_words(docs, text))
    top = words.where("length(word) >= 4").orderBy(F.desc("n"), "word").limit(DICTIONARY)
    pairs = words.select(
        F.explode(F.transform(F.sequence(F.lit(1), F.length("word") - 1), lambda i: F.substr("word", i, F.lit(2)))).alias("pair"), "n"
    ).groupBy("pair").agg(F.sum("n").alias("n")).orderBy(F.desc("n"), "pair").limit(PAIRS)
    return [r["word"] for r in top.collect()], [r["pair"] for r in pairs.collect()]


# ---- features ----


def value_of(word: Column) -> Column:
    """The part of a piece after its name and sign, without quotes and closing marks.

    Of several names in a row the last that names a secret counts, or else the first.
    """
    bare = F.regexp_replace(word, r"^[\"'`(\[{<#*$%&!?]+|[\"'`)\]}>,;.#*$%&!?]+$", "")
    named = rf"""^(?:[^"'`=]*(?i:{NAMED})[A-Za-z0-9_.\-]{{0,20}}|[A-Za-z_.\-]{{2,30}})["'`]?[=:]+(?=.{{4}})"""
    return F.regexp_replace(F.regexp_replace(bare, named, ""), r"^[\[{(\"'`]+", "")


def features(found: DataFrame, dictionary: list[str], pairs: list[str]) -> DataFrame:
    """The columns of `found` and `value` and `FEATURES`."""
    value = F.col("value")
    count = lambda pattern: F.regexp_count(value, F.lit(pattern)).cast("double")
    size = F.greatest(F.length(value), F.lit(1)).cast("double")
    chars = F.split(value, "")
    share = lambda c: (F.length(value) - F.length(F.replace(value, c, F.lit("")))) / size
    letters = F.regexp_replace(F.lower(value), r"[^\p{L}]", "")
    letter_pairs = F.when(
        F.length(letters) >= 2, F.transform(F.sequence(F.lit(1), F.length(letters) - 1), lambda i: F.substr(letters, i, F.lit(2)))
    ).otherwise(F.array().cast("array<string>"))
    parts = F.regexp_extract_all(F.lower(value), F.lit(r"\p{L}{4,}"), F.lit(0))
    known = lambda items, table: F.filter(items, lambda x: x.isin(*table) if table else F.lit(False))
    covered = F.aggregate(known(parts, dictionary), F.lit(0), lambda a, x: a + F.length(x))
    near = F.concat_ws(" ", F.substring_index("before", " ", -2), F.regexp_extract("word", r"^[^=:]*[=:]", 0))
    near = F.regexp_replace(near, "[#*$%&|!?]+", "")
    has = lambda x, pattern: F.rlike(x, F.lit(f"(?i){pattern}")).cast("double")
    turns = count(r"(?<=[a-z])(?=[A-Z0-9])|(?<=[A-Z])(?=[0-9])|(?<=[0-9])(?=[A-Za-z])")
    return found.withColumn("value", value_of(F.col("word"))).withColumns({
        "length": size,
        "digits": count("[0-9]") / size,
        "uppers": count("[A-Z]") / size,
        "lowers": count("[a-z]") / size,
        "marks": count("[^A-Za-z0-9]") / size,
        "turns": turns,
        "turn_rate": turns / size,
        "distinct": F.size(F.array_distinct(chars)) / size,
        "entropy": F.aggregate(F.array_distinct(F.filter(chars, lambda c: c != "")), F.lit(0.0), lambda a, c: a - share(c) * F.log2(share(c))),
        "common_pairs": F.size(known(letter_pairs, pairs)) / F.greatest(F.size(letter_pairs), F.lit(1)).cast("double"),
        "dictionary": covered / size,
        "named": has(near, NAMED),
        "named_far": has(F.col("before"), NAMED),
        "other": has(F.concat_ws(" ", near, F.col("word"), F.col("before")), OTHER),
        "assigned": has(near, r"[=:]\s*$"),
        "quoted": F.rlike("word", F.lit("[\"'`]")).cast("double"),
        "known_kind": F.rlike("value", F.lit("|".join(KINDS.values()))).cast("double"),
        "path_other": F.rlike("path", F.lit(PATHS)).cast("double"),
    })


# ---- labelled findings ----


def derived_findings(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", rows: int = SAMPLE_FINDINGS) -> DataFrame:
    """Labelled findings in the shape of `candidates`, with `label`, put together from the documents.

    Secrets are digests of the ids behind the names that secrets have; false findings are digests behind the names of
    checksums and versions, words of the text with numbers, addresses, dates and placeholders. The words around come from
    the texts. At most `rows` findings, from documents by hash of the id.
    """
    words = F.split(F.trim(F.coalesce(F.col(text), F.lit(""))), r"\s+")
    known = docs.where(F.col(doc_id).isNotNull()).select(F.col(doc_id).cast("string").alias("id"), F.slice(words, 1, 8).alias("w"))
    some = smallest_hashes(known.dropDuplicates(["id"]), "findings", "id", -(-rows // 20), known.count())
    at = lambda i: F.coalesce(F.get("w", F.lit(i)), F.lit("of"))
    hex_ = lambda n, salt: F.substr(F.sha2(F.concat(F.lit(salt), F.col("id")), 512), F.lit(1), F.lit(n))
    raw = lambda n, salt: F.substr(
        F.regexp_replace(F.base64(F.unhex(F.sha2(F.concat(F.lit(salt), F.col("id")), 512))), "[^A-Za-z0-9]", ""), F.lit(1), F.lit(n)
    )
    digits = lambda n, salt: F.substr(F.regexp_replace(F.sha2(F.concat(F.lit(salt), F.col("id")), 512), "[a-f]", ""), F.lit(1), F.lit(n))
    text_ = F.lit
    join = lambda *x: F.concat(*x)
    made = [
        # label, word, the word right before
        (1, join(text_('"'), hex_(40, "a"), text_('"')), text_("token =")),
        (1, join(text_('"'), F.upper(hex_(40, "A")), text_('"')), text_("TOKEN =")),
        (1, join(text_("password="), hex_(18, "b")), at(1)),
        (1, join(text_("api_key="), raw(32, "c")), at(2)),
        (1, join(text_("secret:"), raw(24, "d")), at(3)),
        (1, join(text_("AKIA"), F.upper(raw(16, "e"))), text_("access_key =")),
        (1, join(text_("ghp_"), raw(36, "f")), at(0)),
        (1, join(text_("'"), raw(20, "g"), text_("';")), text_("password :")),
        (1, join(text_("sk-"), raw(40, "h")), text_("Bearer")),
        (1, join(text_("passwd="), raw(10, "i"), digits(2, "i")), at(4)),
        (1, join(text_("auth_token="), hex_(32, "j")), at(5)),
        (0, hex_(40, "k"), text_("commit")),
        (0, join(text_("md5:"), hex_(32, "l")), text_("checksum")),
        (0, join(hex_(8, "m"), text_("-"), hex_(4, "n"), text_("-"), hex_(4, "o"), text_("-"), hex_(12, "p")), text_("uuid")),
        (0, join(at(2), at(3), digits(3, "q")), at(1)),
        (0, join(text_("password=example"), digits(3, "r")), at(1)),
        (0, join(digits(2, "s"), text_("@mail"), digits(1, "t"), text_(".example.com")), at(1)),
        (0, join(text_("https://"), at(2), text_(".example.net/"), at(3), text_("?id="), digits(5, "u")), at(1)),
        (0, join(text_("v"), digits(1, "v"), text_("."), digits(2, "w"), text_("."), digits(3, "x"), text_("-beta")), text_("version")),
        (0, text_("token=xxxxxxxxxxxx1"), at(1)),
        (0, join(text_("+1(0"), digits(2, "y"), text_(")"), digits(7, "z"), at(1)), at(2)),
    ]
    rows_ = F.array(*(F.struct(F.lit(k).cast("double").alias("label"), w.alias("word"), b.alias("near")) for k, w, b in made))
    return pieces(some.select("w", F.explode(rows_).alias("f")).select(
        F.col("f.word").alias("word"),
        F.concat_ws(" ", at(6), at(7), F.col("f.near")).alias("before"),
        F.concat_ws(" ", at(5), at(4)).alias("after"),
        F.lit("").alias("path"), F.col("f.label").alias("label"),
    ))


def fit(findings: DataFrame, dictionary: list[str], pairs: list[str]) -> PipelineModel | None:
    """A forest over labelled findings (word, before, after, path, label of 0 or 1); None unless both labels are there."""
    known = checkpointed(features(findings.where("label IS NOT NULL AND word IS NOT NULL"), dictionary, pairs))
    if known.select("label").distinct().count() < 2:
        return None
    stages = [
        VectorAssembler(inputCols=FEATURES, outputCol="features"),
        RandomForestClassifier(featuresCol="features", labelCol="label", numTrees=TREES, maxDepth=DEPTH, seed=SEED),
    ]
    return Pipeline(stages=stages).fit(known)


# ---- operator ----


def kind_of(value: Column) -> Column:
    out = F.lit("assigned value")
    for name, pattern in reversed(KINDS.items()):
        out = F.when(F.rlike(value, F.lit(pattern)), name).otherwise(out)
    return out


def find_secrets(
    docs: DataFrame, findings: DataFrame | None = None, doc_id: str = "doc_id", text: str = "text", path: str | None = None,
    threshold: float = THRESHOLD,
) -> DataFrame:
    """One row per candidate: doc_id, position, word, value, kind, score, is_secret; `word` is the piece of the word that holds it.

    The forest learns from `findings` (at most `SAMPLE_FINDINGS` of them are used, by hash), or from `derived_findings`.
    Null and empty texts have no candidates; equal candidates at different places are rows of their own; a repeated id
    gives its rows again; a null id is kept. Without labelled findings every candidate counts as a secret. Empty tables
    give no rows; other columns are ignored.
    """
    dictionary, pairs = statistics(docs, text)
    if findings is None:
        findings = derived_findings(docs, doc_id, text)
    else:
        findings = findings.orderBy(F.xxhash64("word", "before"), "word").limit(SAMPLE_FINDINGS)
    model = fit(findings, dictionary, pairs)
    found = features(candidates(docs, doc_id, text, path), dictionary, pairs)
    if model is None:
        scored = found.withColumn("score", F.lit(1.0))
    else:
        from pyspark.ml.functions import vector_to_array

        scored = model.transform(found).withColumn("score", vector_to_array("probability")[1])
    return scored.select(
        "doc_id", "position", "word", "value", kind_of(F.col("value")).alias("kind"), "score",
        (F.col("score") >= threshold).alias("is_secret"),
    )


def op8_secrets(spark: SparkSession, folder: str) -> DataFrame:
    """Every candidate of every document, with its score."""
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    return find_secrets(docs, path="source").select(
        "doc_id", "position", "word", F.sha2("value", 256).alias("value_sha256"), F.length("value").cast("bigint").alias("value_chars"),
        "kind", "score", "is_secret",
    )
