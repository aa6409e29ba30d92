"""Quality by co-training: one classifier reads the text, one the page's metadata, and each teaches the other."""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from plumbline.llm.quality_rules import COUNTS, measures, text_counts
from plumbline.llm.sampling import smallest_hashes
from plumbline.storage import checkpointed

#: Bounds of what is fitted on: labelled and unlabelled documents.
LABELLED, UNLABELLED = 8000, 8000
#: Hashed word features of the text view, hashed value features of the metadata view.
WORD_BINS, META_BINS = 128, 64
ROUNDS = 5
#: Share of the unlabelled pool that one view labels for the other in a round.
TEACH = 0.02
CONFIDENT = 0.9
THRESHOLD = 0.5
CACHE_WORDS = 400_000


# ---- views ----


class TextView:
    """Counts and measures of the text, and how its words fall into hashed bins."""

    def __init__(self):
        self.bins: dict[str, int] = {}

    def __call__(self, texts: list[str | None]) -> np.ndarray:
        counts = np.array([text_counts(t) for t in texts], np.int64).reshape(-1, len(COUNTS))
        bags = np.zeros((len(texts), WORD_BINS), np.float32)
        for row, text in enumerate(texts):
            words = (text or "").lower().split()
            if not words:
                continue
            try:
                at = np.fromiter(map(self.bins.__getitem__, words), np.int64, len(words))
            except KeyError:
                if len(self.bins) > CACHE_WORDS:
                    self.bins.clear()
                for w in words:
                    if w not in self.bins:
                        self.bins[w] = zlib.crc32(w.encode("utf-8", "surrogatepass")) % WORD_BINS
                at = np.fromiter(map(self.bins.__getitem__, words), np.int64, len(words))
            bags[row] = np.sqrt(np.bincount(at, minlength=WORD_BINS) / len(words))
        return np.hstack([measures(dict(zip(COUNTS, counts.T))), bags])


def meta_view(n: int, columns: dict[str, list], numeric: set[str]) -> np.ndarray:
    """Logarithms of the `numeric` columns, values of the others in hashed bins; nulls are a value of their own."""
    bins, numbers = np.zeros((n, META_BINS), np.float32), []
    for name, values in columns.items():
        if name in numeric:
            known = np.array([np.nan if v is None else float(v) for v in values])
            numbers.append(np.where(np.isnan(known), 0, np.sign(known) * np.log1p(np.abs(known))))
            numbers.append(np.isnan(known).astype(float))
        else:
            at = [zlib.crc32(f"{name}={v}".encode("utf-8", "surrogatepass")) % META_BINS for v in values]
            bins[np.arange(n), at] += 1
    return np.column_stack([bins, *numbers])


# ---- classifiers ----


@dataclass
class Classifier:
    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray
    bias: float
    slope: float = 1.0
    shift: float = 0.0

    def margin(self, x: np.ndarray) -> np.ndarray:
        return ((x - self.mean) / self.scale) @ self.weights + self.bias

    def log_odds(self, x: np.ndarray) -> np.ndarray:
        """The calibrated margin."""
        return self.slope * self.margin(x) + self.shift


def logistic(x: np.ndarray, y: np.ndarray, weight: np.ndarray, ridge: float, rounds: int = 50) -> tuple[np.ndarray, float]:
    x = np.hstack([x, np.ones((len(x), 1))])
    penalty = np.r_[np.full(x.shape[1] - 1, ridge), 1e-6]
    w = np.zeros(x.shape[1])
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        h = weight * np.maximum(p * (1 - p), 1e-6)
        step = np.linalg.solve((x.T * h) @ x + np.diag(penalty), x.T @ (weight * (p - y)) + penalty * w)
        step *= min(1.0, 5.0 / max(1e-12, np.abs(step).max()))
        w = w - step
        if np.abs(step).max() < 1e-6:
            break
    return w[:-1], float(w[-1])


def fit_view(x: np.ndarray, y: np.ndarray, ridge: float = 1.0) -> Classifier:
    """Classes of equal weight, features of equal scale."""
    mean, scale = x.mean(0), x.std(0)
    scale = np.where(scale > 1e-9, scale, 1.0)
    weight = np.where(y > 0, 0.5 / max(y.mean(), 1e-9), 0.5 / max(1 - y.mean(), 1e-9))
    return Classifier(mean, scale, *logistic((x - mean) / scale, y, weight, ridge))


def calibrate(view: Classifier, x: np.ndarray, y: np.ndarray) -> None:
    w, b = logistic(view.margin(x)[:, None], y, np.ones(len(y)), 1e-2)
    view.slope, view.shift = float(max(w[0], 0.0)), b


@dataclass
class Model:
    text: Classifier
    meta: Classifier
    prior: float

    def log_odds(self, text: np.ndarray, meta: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Text view, metadata view, and both: evidence adds up once the prior is counted once."""
        a, b = self.text.log_odds(text), self.meta.log_odds(meta)
        return a, b, a + b - self.prior


def co_train(
    text: np.ndarray, meta: np.ndarray, y: np.ndarray, text_pool: np.ndarray, meta_pool: np.ndarray,
    rounds: int = ROUNDS, teach: float = TEACH,
) -> Model:
    """One in four labelled rows calibrates, the others teach.

    In each round a view labels the pool rows it is most sure of, in the proportion of the classes, and they are added to
    what the *other* view learns from. A row is labelled once.
    """
    hold = np.arange(len(y)) % 4 == 3
    if min(y[hold].sum(), (1 - y[hold]).sum()) < 5 or min(y[~hold].sum(), (1 - y[~hold]).sum()) < 5:
        hold = np.zeros(len(y), bool)
    learn = ~hold
    labels = {"text": [(text[learn], y[learn])], "meta": [(meta[learn], y[learn])]}
    free = np.ones(len(text_pool), bool)
    share = y[learn].mean()
    views: dict[str, Classifier] = {}
    for number in range(rounds + 1):
        for name, rows in labels.items():
            views[name] = fit_view(np.concatenate([r[0] for r in rows]), np.concatenate([r[1] for r in rows]))
        if number == rounds:
            break
        for teacher, pupil, own, other in (("text", "meta", text_pool, meta_pool), ("meta", "text", meta_pool, text_pool)):
            p = 1 / (1 + np.exp(-np.clip(views[teacher].margin(own), -30, 30)))
            for label, sure, n in ((1.0, p, share), (0.0, 1 - p, 1 - share)):
                open_rows = np.flatnonzero(free & (sure >= CONFIDENT))
                picked = open_rows[np.argsort(-sure[open_rows], kind="stable")][: max(1, round(teach * len(own) * n))]
                if len(picked):
                    free[picked] = False
                    labels[pupil].append((other[picked], np.full(len(picked), label)))
    check = hold if hold.any() else learn
    calibrate(views["text"], text[check], y[check])
    calibrate(views["meta"], meta[check], y[check])
    prior = np.clip(y.mean(), 1e-3, 1 - 1e-3)
    return Model(views["text"], views["meta"], float(np.log(prior / (1 - prior))))


# ---- operator ----


def sample(docs: DataFrame, labels: DataFrame, labelled: int = LABELLED, unlabelled: int = UNLABELLED) -> DataFrame:
    """docs of at most so many labelled and unlabelled ids, by hash, with `_y` (null: unlabelled) and without texts of others."""
    known = labels.where("doc_id IS NOT NULL AND quality IS NOT NULL").groupBy("doc_id").agg((F.min("quality") > 0).cast("int").alias("_y"))
    some = smallest_hashes(known, "known", "doc_id", labelled, known.count())
    rest = docs.select("doc_id").where("doc_id IS NOT NULL").join(known, "doc_id", "left_anti").distinct()
    pool = smallest_hashes(rest, "pool", "doc_id", unlabelled, rest.count()).withColumn("_y", F.lit(None).cast("int"))
    ids = some.unionByName(pool).withColumnRenamed("doc_id", "_id")
    return docs.join(F.broadcast(ids), F.col("doc_id") == F.col("_id")).drop("_id")


SCORES = ["text_score", "meta_score", "score"]


def quality(docs: DataFrame, labels: DataFrame, metadata: list[str], doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, text_score, meta_score, score, kept) of every row of docs; `metadata` names the second view's columns.

    Null and empty texts and null metadata have features of their own. Repeated ids are scored row by row; of
    contradicting labels the worse counts. Without labels of both classes all scores are 1. Empty tables give no rows;
    other columns are ignored.
    """
    source = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"), *(F.col(m).alias(f"m_{m}") for m in metadata))
    names = source.columns
    numeric = {f.name for f in source.schema.fields if isinstance(f.dataType, T.NumericType)}

    def views(batch: pa.RecordBatch, view: TextView):
        columns = {c: batch.column(i).to_pylist() for i, c in enumerate(names) if i > 1}
        return view(batch.column(1).to_pylist()), meta_view(batch.num_rows, columns, numeric)

    def featured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        view = TextView()
        for batch in batches:
            a, b = views(batch, view)
            rows = [r.tobytes() for r in a.astype(np.float64)], [r.tobytes() for r in b.astype(np.float64)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(batch.num_columns - 1), *(pa.array(r, pa.binary()) for r in rows)],
                ["doc_id", "_y", "a", "b"],
            )

    kind = source.schema["doc_id"].dataType.simpleString()
    chosen = sample(source, labels).mapInArrow(featured, f"doc_id {kind}, _y int, a binary, b binary")
    rows = checkpointed(chosen).orderBy("doc_id").collect()
    y = np.array([np.nan if r["_y"] is None else float(r["_y"]) for r in rows])
    known = ~np.isnan(y)
    if not known.any() or y[known].min() == y[known].max():
        return source.select("doc_id", *(F.lit(1.0).alias(s) for s in SCORES), F.lit(True).alias("kept"))
    a, b = (np.array([np.frombuffer(r[k]) for r in rows]) for k in ("a", "b"))
    model = co_train(a[known], b[known], y[known], a[~known], b[~known])
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        view = TextView()
        for batch in batches:
            odds = shared.value.log_odds(*views(batch, view))
            found = [1 / (1 + np.exp(-np.clip(o, -30, 30))) for o in odds]
            yield pa.RecordBatch.from_arrays([batch.column(0), *map(pa.array, found)], ["doc_id", *SCORES])

    done = source.mapInArrow(scored, T.StructType([source.schema["doc_id"], *(T.StructField(s, T.DoubleType()) for s in SCORES)]))
    return done.withColumn("kept", F.col("score") >= THRESHOLD)


def op6_quality_cotraining(spark: SparkSession, folder: str) -> DataFrame:
    """Every document scored by both views."""
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    return quality(docs, spark.read.parquet(f"{folder}/labels.parquet"), ["lang", "source", "n_chars"])
