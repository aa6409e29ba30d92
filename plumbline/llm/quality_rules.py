"""Quality rules: gradient-boosted trees over document statistics, monotonic where a rule should be."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from plumbline.llm.sampling import smallest_hashes
from plumbline.storage import checkpointed

SPACES = " \t\n\x0b\x0c\r"
SYMBOLS = "#*$%&|<>"
MIN_WORDS = 50
#: At most this share of the words may stand in repeated three-word windows, in hundredths.
MAX_REPEAT = 50
#: Labelled documents that the trees are fitted on, at most.
SAMPLE_DOCS = 20_000
THRESHOLD = 0.5
COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_distinct", "n_digits", "n_upper", "n_ends"]


# ---- statistics ----


def repeat_words(words: list[bytes], numbers: dict[bytes, int]) -> int:
    """How many words stand in a three-word window that occurs at least twice."""
    n = len(words)
    if n < 4:
        return 0
    at = np.fromiter(map(numbers.__getitem__, words), np.int64, n)
    size = len(numbers)
    if size < 2_000_000:
        key = (at[:-2] * size + at[1:-1]) * size + at[2:]
    else:
        _, pair = np.unique(at[:-1] * size + at[1:], return_inverse=True)
        key = pair[:-1].astype(np.int64) * size + at[2:]
    order = np.argsort(key, kind="stable")
    same = key[order][1:] == key[order][:-1]
    twice = np.zeros(n - 2, bool)
    twice[order[1:][same]] = True
    twice[order[:-1][same]] = True
    marked = np.zeros(n, bool)
    for shift in range(3):
        marked[shift : n - 2 + shift] |= twice
    return int(marked.sum())


def text_counts(text: str | None) -> tuple[int, ...]:
    """The counts of `COUNTS` of a whole text; null is the empty text."""
    text = text or ""
    raw = text.encode("utf-8", "surrogatepass")
    words = raw.split()
    numbers = {w: i for i, w in enumerate(dict.fromkeys(words))}
    lines = [x for x in text.split("\n") if x.strip(SPACES)]
    return (
        len(words),
        len(text) - sum(map(text.count, SPACES)),
        sum(map(text.count, SYMBOLS)),
        len(lines) - len(set(lines)),
        repeat_words(words, numbers),
        len(lines),
        len(numbers),
        sum(map(raw.count, (b"0", b"1", b"2", b"3", b"4", b"5", b"6", b"7", b"8", b"9"))),
        sum(1 for w in words if b"A" <= w[:1] <= b"Z"),
        sum(map(raw.count, (b". ", b".\n", b"! ", b"? "))),
    )


def statistics(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, the `COUNTS`) of every row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [text_counts(t) for t in batch.column(1).to_pylist()]
            table = np.array(found, np.int64).reshape(-1, len(COUNTS))
            yield pa.RecordBatch.from_arrays([batch.column(0), *map(pa.array, table.T.copy())], ["doc_id", *COUNTS])

    chosen = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    schema = T.StructType([chosen.schema["doc_id"], *(T.StructField(c, T.LongType()) for c in COUNTS)])
    return chosen.mapInArrow(run, schema)


#: Measures that the trees see, and how the score may move as each rises (-1: it may only fall).
MEASURES = {
    "log_words": 0,
    "word_length": 0,
    "symbol_share": -1,
    "dup_line_share": -1,
    "repeat_share": -1,
    "words_per_line": 0,
    "distinct_share": 0,
    "digit_share": 0,
    "upper_share": 0,
    "end_share": 0,
}


def measures(c: dict[str, np.ndarray]) -> np.ndarray:
    words, chars, lines = (np.maximum(c[k], 1).astype(float) for k in ("n_words", "word_chars", "n_lines"))
    return np.column_stack([
        np.log1p(c["n_words"]), c["word_chars"] / words, c["n_symbols"] / chars, c["n_dup_lines"] / lines,
        c["n_repeat_words"] / words, c["n_words"] / lines, c["n_distinct"] / words, c["n_digits"] / chars,
        c["n_upper"] / words, c["n_ends"] / words,
    ])


# ---- trees ----


@dataclass
class Trees:
    """All trees in flat node arrays; leaves point to themselves, so that every row takes the same number of steps."""

    roots: np.ndarray
    feature: np.ndarray
    cut: np.ndarray
    left: np.ndarray
    right: np.ndarray
    value: np.ndarray
    base: float
    depth: int

    def margin(self, x: np.ndarray) -> np.ndarray:
        out = np.full(len(x), self.base)
        rows = np.arange(len(x))
        for root in self.roots:
            node = np.full(len(x), root)
            for _ in range(self.depth):
                node = np.where(x[rows, self.feature[node]] <= self.cut[node], self.left[node], self.right[node])
            out += self.value[node]
        return out

    def probability(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.margin(x), -30, 30)))


def fit_trees(
    x: np.ndarray, y: np.ndarray, moves: list[int], trees: int = 80, depth: int = 4, rate: float = 0.15,
    bins: int = 64, ridge: float = 1.0, min_weight: float = 2.0,
) -> Trees:
    """Second-order boosting of the logistic loss on binned measures.

    A split is taken only if its two leaf values keep the order that `moves` asks of the measure, and every node hands its
    children bounds at the middle of the two, so that no leaf further down breaks the order.
    """
    n, m = x.shape
    cuts = [np.unique(np.quantile(x[:, j], np.linspace(0, 1, bins + 1)[1:-1])) for j in range(m)]
    binned = np.column_stack([np.searchsorted(cuts[j], x[:, j], side="left") for j in range(m)])
    rate0 = np.clip(y.mean(), 1e-3, 1 - 1e-3)
    base = float(np.log(rate0 / (1 - rate0)))
    margin = np.full(n, base)
    feature, cut, left, right, value, roots = [], [], [], [], [], []

    def leaf(g, h, low, high):
        return float(np.clip(-g / (h + ridge), low, high))

    def add(v):
        feature.append(0), cut.append(0.0), value.append(v)
        left.append(len(value) - 1), right.append(len(value) - 1)
        return len(value) - 1

    for _ in range(trees):
        p = 1 / (1 + np.exp(-margin))
        grad, hess = p - y, np.maximum(p * (1 - p), 1e-9)
        root = add(0.0)
        roots.append(root)
        todo = [(root, np.arange(n), 0, -np.inf, np.inf)]
        while todo:
            node, rows, level, low, high = todo.pop()
            g, h = grad[rows].sum(), hess[rows].sum()
            value[node] = rate * leaf(g, h, low, high)
            best = None
            if level < depth:
                for j in range(m):
                    b = binned[rows, j]
                    size = len(cuts[j]) + 1
                    gl = np.cumsum(np.bincount(b, grad[rows], size))[:-1]
                    hl = np.cumsum(np.bincount(b, hess[rows], size))[:-1]
                    gr, hr = g - gl, h - hl
                    wl = np.clip(-gl / (hl + ridge), low, high)
                    wr = np.clip(-gr / (hr + ridge), low, high)
                    gain = -(gl * wl + 0.5 * (hl + ridge) * wl**2) - (gr * wr + 0.5 * (hr + ridge) * wr**2)
                    w = leaf(g, h, low, high)
                    gain += g * w + 0.5 * (h + ridge) * w**2
                    gain[(hl < min_weight) | (hr < min_weight)] = -1
                    if moves[j]:
                        gain[moves[j] * (wr - wl) < 0] = -1
                    if len(gain) and (at := int(gain.argmax())) >= 0 and gain[at] > 1e-6 and (best is None or gain[at] > best[0]):
                        best = (gain[at], j, at, wl[at], wr[at])
            if best is None:
                margin[rows] += value[node]
                continue
            _, j, at, wl, wr = best
            feature[node], cut[node] = j, float(cuts[j][at])
            middle = (wl + wr) / 2
            bounds = {1: ((low, middle), (middle, high)), -1: ((middle, high), (low, middle))}
            lb, rb = bounds.get(moves[j], ((low, high), (low, high)))
            goes = binned[rows, j] <= at
            left[node], right[node] = add(0.0), add(0.0)
            todo += [(left[node], rows[goes], level + 1, *lb), (right[node], rows[~goes], level + 1, *rb)]
    arrays = (np.array(a) for a in (roots, feature, cut, left, right, value))
    return Trees(*arrays, base, depth)


# ---- operator ----


def labelled_counts(stats: DataFrame, labels: DataFrame, sample_docs: int = SAMPLE_DOCS):
    """Measures and labels of at most `sample_docs` labelled documents, by hash of the id."""
    known = labels.where("doc_id IS NOT NULL AND quality IS NOT NULL").groupBy("doc_id").agg((F.min("quality") > 0).cast("int").alias("y"))
    chosen = smallest_hashes(known, "rules", "doc_id", sample_docs, known.count())
    rows = stats.join(F.broadcast(chosen), "doc_id").orderBy("doc_id").select("y", *COUNTS).collect()
    table = np.array(rows, np.int64).reshape(-1, len(COUNTS) + 1)
    return measures(dict(zip(COUNTS, table[:, 1:].T))), table[:, 0]


def judge(stats: DataFrame, trees: Trees | None, threshold: float = THRESHOLD) -> DataFrame:
    """Adds score, base_failed and kept to `statistics`; without trees only the base rules decide."""
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT * F.col("n_words"))
    if trees is None:
        scored = stats.withColumn("score", F.lit(1.0))
    else:
        shared = stats.sparkSession.sparkContext.broadcast(trees)
        names = stats.columns

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                found = measures({c: batch.column(names.index(c)).to_numpy() for c in COUNTS})
                yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(shared.value.probability(found))], [*names, "score"])

        scored = stats.mapInArrow(run, T.StructType([*stats.schema.fields, T.StructField("score", T.DoubleType())]))
    return scored.withColumn("base_failed", failed).withColumn("kept", ~failed & (F.col("score") >= threshold))


def quality_rules(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", sample_docs: int = SAMPLE_DOCS) -> DataFrame:
    """(doc_id, `COUNTS`, score, base_failed, kept) of every row.

    Null and empty texts have zero counts and fail the base rules. Repeated ids stay rows of their own; of contradicting
    labels the worse counts; null ids are never learned from. Labels of one class or none leave the base rules alone.
    Empty tables give no rows; other columns are ignored.
    """
    stats = checkpointed(statistics(docs, doc_id, text))
    x, y = labelled_counts(stats, labels, sample_docs)
    trees = fit_trees(x, y, list(MEASURES.values())) if len(y) and 0 < y.mean() < 1 else None
    return judge(stats, trees)


def op10_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    """Counts and verdict of every document."""
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    return quality_rules(docs, spark.read.parquet(f"{folder}/labels.parquet")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "score"
    )
