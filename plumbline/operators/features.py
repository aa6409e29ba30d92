"""Word n-gram vocabularies and TF-IDF weights."""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.ml.feature import CountVectorizerModel, ElementwiseProduct, Normalizer, StopWordsRemover, VectorSlicer
from pyspark.ml.linalg import Vectors
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from plumbline.storage import checkpointed

#: Runs of `[\p{L}\p{N}_]`; the ranges are tried first, which is faster.
TOKEN = r"[a-z0-9_\p{L}\p{N}]{2,}+"
#: Numbers that terms are hashed to before they are counted one by one.
BUCKETS = 2**20


def english_stop_words() -> list[str]:
    """Spark's own list; callers may pass a longer one."""
    return StopWordsRemover.loadDefaultStopWords("english")


def with_terms(df: DataFrame, text: str, stop_words: list[str], longest: int = 2, out: str = "terms") -> DataFrame:
    """Add the 1- to `longest`-grams of a text; stop words are taken out before words are joined."""
    stop = [word.lower() for word in stop_words]
    words = F.regexp_extract_all(F.lower(text), F.lit(TOKEN), F.lit(0))
    staged = df.filter(F.col(text).isNotNull()).withColumn("_raw", words)
    staged = staged.withColumn("_n1", F.filter("_raw", lambda word: ~word.isin(stop)))
    for n in range(2, longest + 1):
        size = F.greatest(F.size("_n1") - (n - 1), F.lit(0))
        heads, tails = F.slice(f"_n{n - 1}", F.lit(1), size), F.slice("_n1", F.lit(n), size)
        staged = staged.withColumn(f"_n{n}", F.zip_with(heads, tails, lambda head, tail: F.concat(head, F.lit(" "), tail)))
    grams = [f"_n{n}" for n in range(1, longest + 1)]
    return staged.withColumn(out, F.concat(*grams)).drop("_raw", *grams)


def _term_rows(df: DataFrame, terms: str) -> DataFrame:
    """One row per text and distinct term, with its count `n`, read off the runs of the sorted array.

    Nothing is shuffled. The outer form of `inline` keeps the optimizer from deriving a "not empty" filter, which
    would compute the whole expression again below every step.
    """
    size = F.size("_sorted")
    ends = F.filter(
        F.when(size > 0, F.sequence(F.lit(1), size)).otherwise(F.array().cast("array<int>")),
        lambda i: (i == size) | (F.get("_sorted", i - 1) != F.get("_sorted", i)),
    )
    starts = F.slice(F.concat(F.array(F.lit(0)), "_ends"), F.lit(1), F.size("_ends"))
    runs = F.zip_with(
        "_ends", starts, lambda e, s: F.struct(F.get("_sorted", e - 1).alias("term"), (e - s).alias("n"))
    )
    staged = df.withColumn("_sorted", F.sort_array(terms)).withColumn("_ends", ends)
    others = [c for c in df.columns if c != terms]
    rows = staged.select(*others, runs.alias("_runs")).select(*others, F.inline_outer("_runs"))
    return rows.filter(F.col("term").isNotNull())


def term_counts(df: DataFrame, by: list[str] = [], terms: str = "terms") -> DataFrame:
    """Occurrences and texts per term, from one pass and one shuffle of partly aggregated rows."""
    return _term_rows(df.select(*by, terms), terms).groupBy(*by, "term").agg(F.sum("n").cast("long").alias("tf"), F.count(F.lit(1)).alias("df"))


def part_term_counts(df: DataFrame, part: str, parts: int, terms: str = "terms") -> DataFrame:
    """`term_counts` over all rows, with those of the parts 0 to `parts - 1` in `tf_<i>` and `df_<i>`; one shuffle as well."""
    n, one = F.col("n"), F.lit(1)
    within = [F.col(part) == i for i in range(parts)]
    sums = [F.sum(F.when(own, n).otherwise(0)).cast("long").alias(f"tf_{i}") for i, own in enumerate(within)]
    sums += [F.count(F.when(own, one)).alias(f"df_{i}") for i, own in enumerate(within)]
    return _term_rows(df.select(part, terms), terms).groupBy("term").agg(F.sum(n).cast("long").alias("tf"), F.count(one).alias("df"), *sums)


def _listed(terms: str, value: str, numbers: list[int]) -> Column:
    """The terms of the array whose `value`, an expression over `t`, is among the numbers."""
    return F.expr(f"filter(`{terms}`, t -> {value} IN ({', '.join(f'{n}L' for n in numbers) or 'NULL'}))")


def ngram_vocabulary(df: DataFrame, min_df: int = 2, max_features: int = 5000, terms: str = "terms") -> DataFrame:
    """The most frequent terms that occur in `min_df` texts or more; ties go by the term.

    Most n-grams stand in a text or two and are never counted one by one. Occurrences are first counted by a hash of
    the term, and a term is at most as frequent as its bucket: once the last term of a vocabulary is as frequent as
    the buckets that were left out, no term of theirs can be in it. If it is not, its frequency is the bound of a
    second count, which leaves no such bucket out. At most `8 * max_features` numbers of buckets come to the driver.
    """
    every = df.select(F.explode_outer(terms).alias("term")).filter(F.col("term").isNotNull())
    bucket = f"pmod(xxhash64({{}}), {BUCKETS}L)"
    buckets = every.groupBy(F.expr(bucket.format("term")).alias("bucket")).agg(F.count(F.lit(1)).alias("n")).persist()

    def most_frequent(texts: DataFrame) -> DataFrame:
        frequent = term_counts(texts, terms=terms).filter(F.col("df") >= min_df)
        return checkpointed(frequent.orderBy(F.desc("tf"), F.asc("term")).limit(max_features))

    def within(rows: list) -> DataFrame:
        return df.withColumn(terms, _listed(terms, bucket.format("t"), [row["bucket"] for row in rows]))

    try:
        wide = 2 * max_features
        first = buckets.orderBy(F.desc("n")).limit(wide + 1).collect()
        if len(first) <= wide:
            return most_frequent(df)
        left_out = first[-1]["n"]  # the most occurrences of a bucket, and so of a term, that is not counted
        found = most_frequent(within([row for row in first if row["n"] > left_out]))
        last = found.agg(F.count(F.lit(1)).alias("terms"), F.min("tf").alias("tf")).first()
        if last["terms"] == max_features and last["tf"] > left_out:
            return found
        least = last["tf"] if last["terms"] == max_features else min_df
        rows = buckets.filter(F.col("n") >= least).limit(8 * max_features + 1).collect()
        return most_frequent(within(rows) if len(rows) <= 8 * max_features else df)
    finally:
        buckets.unpersist()


def idf(n_texts: Column, df: Column) -> Column:
    return F.log((1 + n_texts) / (1 + df)) + 1


def tfidf_weights(df: DataFrame, key: str, vocabulary: DataFrame, n_texts: Column, terms: str = "terms") -> DataFrame:
    """Long table `(key, term, weight)`: count times idf, each text scaled to length 1.

    The vocabulary has at most `max_features` rows, a bound the caller sets, so its hashes come to the driver and it is
    broadcast; other terms are left out before a text's terms are counted. Only terms in it are shuffled, once, and no
    text is gathered in one value.
    """
    weights = vocabulary.select("term", idf(n_texts, F.col("df")).alias("_idf"))
    hashes = [row["hash"] for row in vocabulary.select(F.xxhash64("term").alias("hash")).collect()]
    counted = _term_rows(df.select(key, _listed(terms, "xxhash64(t)", hashes).alias(terms)), terms)
    known = counted.join(F.broadcast(weights), "term").withColumn("_w", F.col("n") * F.col("_idf"))
    length = F.sqrt(F.sum(F.col("_w") * F.col("_w")).over(Window.partitionBy(key)))
    return known.select(key, "term", (F.col("_w") / length).alias("weight"))


def vectorizer(vocabulary: DataFrame, n_texts: int, terms: str = "terms", out: str = "features") -> tuple[PipelineModel, list[str]]:
    """Transformer from terms to TF-IDF vectors; it runs inside the scan, without a shuffle.

    The vocabulary comes to the driver: at most `max_features` rows.
    """
    names, weights = _idf_weights(vocabulary, n_texts)
    counts = CountVectorizerModel.from_vocabulary(names, inputCol=terms, outputCol="_counts")
    return PipelineModel([counts, *_weighted(weights, out)]), names


def sliced_vectorizer(every: list[str], vocabulary: DataFrame, n_texts: int, counts: str = "counts", out: str = "features") -> PipelineModel:
    """Transformer from counts of the terms `every`, in their order, to the vectors that `vectorizer` gives for a vocabulary of them."""
    names, weights = _idf_weights(vocabulary, n_texts)
    place = {term: i for i, term in enumerate(every)}
    own = VectorSlicer(inputCol=counts, outputCol="_counts", indices=[place[term] for term in names])
    return PipelineModel([own, *_weighted(weights, out)])


def _idf_weights(vocabulary: DataFrame, n_texts: int) -> tuple[list[str], list[float]]:
    rows = vocabulary.select("term", idf(F.lit(n_texts), F.col("df")).alias("idf")).orderBy("term").collect()
    return [row["term"] for row in rows], [row["idf"] for row in rows]


def _weighted(weights: list[float], out: str) -> list:
    weighted = ElementwiseProduct(scalingVec=Vectors.dense(weights), inputCol="_counts", outputCol="_weighted")
    return [weighted, Normalizer(p=2.0, inputCol="_weighted", outputCol=out)]
