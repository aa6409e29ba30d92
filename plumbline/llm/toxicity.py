"""Toxic language by a subsequence string kernel machine over the words of sentences."""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from plumbline.llm.columns import Lately, parts_of, released, set_aside
from plumbline.llm.sampling import smallest_hashes
from plumbline.storage import checkpointed

#: The kernel compares gapped subsequences of three characters; each skipped character costs this factor.
DECAY = 0.6
#: Character classes: 0 is none of a letter's business (marks, digits), 1 and 2 are the ends of a word.
LETTERS = 45
WINDOW = 14
#: Words that a worker keeps scored.
CACHE_WORDS = 60_000
#: Bounds of what is fitted on: labelled documents of a class, windows of a class, landmarks.
SAMPLE_DOCS = 4000
SAMPLE_WINDOWS = 8000
LANDMARKS = 160
THRESHOLD = 0.3
HELD_OUT = 2
FLOOR = -3.0
#: A text is judged by so many of its words.
TOP = 4
#: How far, in standard deviations, a word must stand out in toxic sentences to be a witness.
STANDS_OUT = 5.0


# ---- windows ----

_SENTENCE = re.compile(r"[.!?\n]+(?=\s|$)|\n")
_SPELT = re.compile(r"(?<!\S)\w(?: \w){2,}(?!\S)")
_EDGE = "\"'.,;:!?()[]{}|*#$%&<>«»“”„‚‘’-–—_/\\~^`+="


def words_of(text: str) -> list[str]:
    """The lower-cased words, with runs of single characters ("i d i o t") joined as one more word each."""
    low = text.lower()
    return low.split() + [m.group().replace(" ", "") for m in _SPELT.finditer(low)]


@cache
def letter_class(c: str) -> int:
    if not c.isalpha():
        return 0
    return 3 + (ord(c) - 97 if "a" <= c <= "z" else 26 + ord(c) % (LETTERS - 29))


def windows_of(word: str) -> list[tuple[int, ...]]:
    """Class codes of a word between its ends; long words are cut into overlapping windows."""
    codes = [letter_class(c) for c in word.strip(_EDGE)]
    if not any(codes):
        return []
    codes = [1, *codes, 2]
    if len(codes) <= WINDOW + 2:
        return [tuple(codes)]
    step = WINDOW // 2
    return [tuple(codes[i : i + WINDOW + 2]) for i in range(0, len(codes) - WINDOW - 2 + step, step)]


# ---- kernel ----


@cache
def _triples(n: int):
    i, j, k = (np.array(x, np.int32) for x in zip(*((a, b, c) for c in range(n) for b in range(c) for a in range(b))))
    return i, j, k, (DECAY ** (k - i - 2)).astype(np.float32)


@cache
def _gaps(n: int) -> np.ndarray:
    s, i = np.indices((n, n))
    return np.where(i < s, DECAY ** np.maximum(s - 1 - i, 0), 0).astype(np.float32)


def features(codes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For windows of one length: feature numbers and weights (rows x triples), and the length of each row's vector."""
    n = codes.shape[1]
    i, j, k, weight = _triples(n)
    a, b, c = codes[:, i], codes[:, j], codes[:, k]
    number = (a * LETTERS + b) * LETTERS + c
    weight = weight * ((a > 0) & (b > 0) & (c > 0))
    same = ((codes[:, :, None] == codes[:, None, :]) & (codes[:, :, None] > 0)).astype(np.float32)
    gap = _gaps(n)
    two = same * (gap @ same @ gap.T)
    three = same * (gap @ two @ gap.T)
    return number, weight, np.sqrt(np.maximum(three.sum((1, 2)), 1e-12))


def by_length(windows: list[tuple[int, ...]], chunk: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(positions, codes) of windows of one length, at most `chunk` at a time."""
    groups: dict[int, list[int]] = {}
    for at, w in enumerate(windows):
        groups.setdefault(len(w), []).append(at)
    for places in groups.values():
        for low in range(0, len(places), chunk):
            at = places[low : low + chunk]
            yield np.array(at), np.array([windows[i] for i in at], np.int32)


def kernel(windows: list[tuple[int, ...]], landmarks: list[tuple[int, ...]]) -> np.ndarray:
    """The normalised subsequence kernel of all windows with all landmarks."""
    dense = np.zeros((LETTERS**3, len(landmarks)), np.float32)
    for at, codes in by_length(landmarks, 512):
        number, weight, size = features(codes)
        np.add.at(dense, (number, np.broadcast_to(at[:, None], number.shape)), weight / size[:, None])
    out = np.zeros((len(windows), len(landmarks)), np.float32)
    used = np.flatnonzero(dense.any(1))
    place = np.zeros(LETTERS**3, np.int32)
    place[used] = np.arange(1, len(used) + 1)
    rows = np.concatenate([np.zeros((1, len(landmarks)), np.float32), dense[used]])
    for at, codes in by_length(windows, 256):
        number, weight, size = features(codes)
        out[at] = np.einsum("bt,btm->bm", weight / size[:, None], rows[place[number]], optimize=False)
    return out


def score_windows(windows: list[tuple[int, ...]], weights: np.ndarray, bias: float) -> np.ndarray:
    out = np.full(len(windows), FLOOR, np.float32)
    for at, codes in by_length(windows, 512):
        number, weight, size = features(codes)
        out[at] = (weights[number] * weight).sum(1) / size + bias
    return out


# ---- machine ----


def fit_svm(x: np.ndarray, y: np.ndarray, cost: float = 8.0, rounds: int = 40) -> np.ndarray:
    """Squared hinge loss with classes of equal weight, by Newton steps on the rows inside the margin; bias last."""
    x = np.hstack([x, np.ones((len(x), 1))]).astype(np.float64)
    sign = np.where(y > 0, 1.0, -1.0)
    weight = cost * np.where(y > 0, 0.5 / max(1, (y > 0).sum()), 0.5 / max(1, (y <= 0).sum())) * 100
    w = np.zeros(x.shape[1])
    ridge = np.eye(x.shape[1])
    ridge[-1, -1] = 1e-6

    def loss(v):
        return 0.5 * v @ ridge @ v + (weight * np.maximum(0, 1 - sign * (x @ v)) ** 2).sum()

    for _ in range(rounds):
        inside = sign * (x @ w) < 1
        xi = x[inside]
        gradient = ridge @ w - 2 * xi.T @ (weight[inside] * (sign[inside] - xi @ w))
        step = np.linalg.solve(ridge + 2 * (xi.T * weight[inside]) @ xi, gradient)
        rate = 1.0
        while rate > 1e-4 and loss(w - rate * step) > loss(w) - 1e-12:
            rate /= 2
        if rate <= 1e-4 or np.abs(step).max() < 1e-7:
            break
        w = w - rate * step
    return w


def fit_curve(x: np.ndarray, y: np.ndarray, weight: np.ndarray, ridge: float = 1.0) -> tuple[np.ndarray, float]:
    """Logistic curve over the measures of documents, with smoothed targets."""
    up, down = weight[y > 0].sum(), weight[y <= 0].sum()
    target = np.where(y > 0, (up + 1) / (up + 2), 1 / (down + 2))
    x = np.hstack([x, np.ones((len(x), 1))])
    penalty = np.diag([ridge] * (x.shape[1] - 1) + [1e-6])
    w = np.zeros(x.shape[1])
    w[-1] = np.log((up + 1) / (down + 1))
    for _ in range(100):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        gradient = x.T @ (weight * (p - target)) + penalty @ w
        hess = (x.T * (weight * np.maximum(p * (1 - p), 1e-6))) @ x + penalty
        step = np.linalg.solve(hess, gradient)
        step *= min(1.0, 2.0 / max(1e-9, np.abs(step).max()))
        w = w - step
        if np.abs(step).max() < 1e-6:
            break
    return w[:-1], float(w[-1])


@dataclass
class Model:
    """Margin of a window and, from a text's measures, the logistic curve of its score."""

    weights: np.ndarray
    bias: float
    slope: np.ndarray | None = None
    shift: float = 0.0


class Scorer:
    """Measures of texts; the margins of words are kept."""

    def __init__(self, weights: np.ndarray, bias: float, kept: int = CACHE_WORDS):
        self.weights, self.bias, self.margins = weights, bias, Lately(kept)

    def _learn(self, words: list[str]) -> None:
        parts, owner = [], []
        for at, word in enumerate(words):
            for w in windows_of(word):
                parts.append(w)
                owner.append(at)
        found = np.full(len(words), FLOOR, np.float32)
        if parts:
            np.maximum.at(found, owner, score_windows(parts, self.weights, self.bias))
        self.margins.now.update(zip(words, found.tolist()))

    def __call__(self, texts: list[str | None]) -> np.ndarray:
        """The `TOP` largest margins of each text's different words, `FLOOR` where it has fewer, and how many words."""
        out = np.full((len(texts), TOP + 1), FLOOR)
        out[:, TOP] = 0
        for low in range(0, len(texts), 128):
            sets = [set(words_of(t or "")) for t in texts[low : low + 128]]
            self.margins.make_room()
            new = self.margins.missing(set().union(*sets))
            if new:
                self._learn(list(new))
            keep = self.margins.now.__getitem__
            for at, words in enumerate(sets):
                found = np.fromiter(map(keep, words), np.float32, len(words))
                if len(found) > TOP:
                    found = np.partition(found, -TOP)[-TOP:]
                out[low + at, : len(found)] = np.sort(found)[::-1]
                out[low + at, TOP] = np.log1p(len(words))
        return np.maximum(out, FLOOR)


MEASURES = "_measures"


def measured(docs: DataFrame, model: Model, text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """The columns `keep` of docs (all by default) and the measures of its text."""
    keep = docs.columns if keep is None else keep
    weights, bias = docs.sparkSession.sparkContext.broadcast(model.weights), model.bias
    at = keep.index(text) if text in keep else len(keep)  # a text that is kept goes to the worker once
    chosen = docs.select(*(F.col(f"`{c}`") for c in keep), *[F.col(f"`{text}`").alias(MEASURES)][: at == len(keep)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(weights.value, bias)
        for part in parts_of(batches):
            found = scorer(part.column(at).to_pylist())
            lists = pa.ListArray.from_arrays(np.arange(0, found.size + 1, TOP + 1, dtype=np.int32), found.ravel())
            yield pa.RecordBatch.from_arrays([*part.columns[: len(keep)], lists], [*keep, MEASURES])

    schema = T.StructType([*chosen.schema.fields[: len(keep)], T.StructField(MEASURES, T.ArrayType(T.DoubleType()))])
    return chosen.mapInArrow(released(run), schema)


# ---- training ----


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string")) % 4 == HELD_OUT, F.lit(False))


def labelled_sample(labels: DataFrame, sample_docs: int = SAMPLE_DOCS) -> tuple[DataFrame, dict[int, int]]:
    """(doc_id, toxic, part) of at most `sample_docs` documents a class, by hash of the id, and the counts of all.

    Held-out ids, null ids and null labels are left out; a document with both labels counts as toxic. One in four
    documents has part 0, on which the curve is fitted, the others are learned from.
    """
    known = labels.where("doc_id IS NOT NULL AND toxic IS NOT NULL").where(~held_out(F.col("doc_id")))
    known = known.groupBy("doc_id").agg((F.max("toxic") > 0).cast("int").alias("toxic"))
    counts = {r["toxic"]: r["n"] for r in known.groupBy("toxic").agg(F.count(F.lit(1)).alias("n")).collect()}
    one = lambda k: smallest_hashes(known.where(F.col("toxic") == k), "sample", "doc_id", sample_docs, counts.get(k, 0))
    part = F.pmod(F.xxhash64(F.lit("part"), "doc_id"), F.lit(4))
    return one(1).union(one(0)).select("doc_id", "toxic", part.alias("part")), counts


def sentence_words(docs: DataFrame) -> DataFrame:
    """(doc_id, text, toxic) to distinct (word, toxic, sentence): a copied sentence counts once."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in parts_of(batches):
            words, toxic, sentence = [], [], []
            for text, label in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                for part in _SENTENCE.split(text or ""):
                    found = {w.strip(_EDGE) for w in words_of(part)}
                    mark = xxhash.xxh64_intdigest(part.strip().lower().encode("utf-8", "surrogatepass")) >> 1
                    words += found
                    toxic += [label] * len(found)
                    sentence += [mark] * len(found)
            yield pa.RecordBatch.from_arrays(
                [pa.array(words, pa.string()), pa.array(toxic, pa.int32()), pa.array(sentence, pa.int64())],
                ["word", "toxic", "sentence"],
            )

    found = docs.select("text", "toxic").mapInArrow(released(run), "word string, toxic int, sentence bigint")
    return found.where("word <> ''").distinct()


def fit(docs: DataFrame, labels: DataFrame, sample_docs: int = SAMPLE_DOCS, landmarks: int = LANDMARKS) -> Model | None:
    """Learn from the sentences of a bounded sample of labelled documents; None without labels of both classes.

    A word is a witness if it stands in sentences of toxic documents far more often than chance has it; words of clean
    documents are counterexamples. The machine is fitted on both in the space of landmarks, then twice more with the
    clean words that came out highest among all of the sample. The curve is fitted on documents that were not learned from.
    """
    ids, counts = labelled_sample(labels, sample_docs)
    if not counts.get(0) or not counts.get(1):
        return None
    ids = checkpointed(ids)
    chosen = checkpointed(
        docs.select("doc_id", "text").join(F.broadcast(ids), "doc_id").select("doc_id", "text", "toxic", "part")
    )
    sizes = {(r["toxic"], r["learn"]): r["n"] for r in ids.groupBy("toxic", (F.col("part") != 0).alias("learn")).agg(F.count(F.lit(1)).alias("n")).collect()}
    apart = sizes.get((1, False), 0) >= 20 and sizes.get((0, False), 0) >= 20
    learn = chosen.where("part <> 0") if apart else chosen
    seen = checkpointed(
        sentence_words(learn).groupBy("word").agg(
            F.count(F.when(F.col("toxic") == 1, 1)).alias("up"), F.count(F.when(F.col("toxic") == 0, 1)).alias("down")
        )
    )
    total = seen.agg(F.sum("up").alias("up"), F.sum("down").alias("down")).first()
    up, down = max(1, total["up"] or 0), max(1, total["down"] or 0)
    expected = (F.col("up") + F.col("down")) * (up / (up + down))
    lift = (F.col("up") / up) / ((F.col("down") + 1) / down)
    witness = (F.col("up") >= 3) & (lift >= 3) & (F.col("up") - expected >= STANDS_OUT * F.sqrt(expected))
    place = F.xxhash64(F.lit("word"), "word")
    positive = [r["word"] for r in seen.where(witness).orderBy(F.desc("up"), "word").limit(SAMPLE_WINDOWS).collect()]
    rest = seen.where(~witness & (F.col("down") > 0))
    negative = [r["word"] for r in rest.orderBy(F.desc("down"), "word").limit(SAMPLE_WINDOWS // 2).collect()]
    negative += [r["word"] for r in rest.orderBy(place, "word").limit(SAMPLE_WINDOWS // 2).collect()]
    if not positive or not negative:
        return None
    model = None
    for mined in range(3):
        pos = [w for word in positive for w in windows_of(word)[:2]]
        neg = list(dict.fromkeys(w for word in negative for w in windows_of(word)))
        taken = set(pos)
        neg = [w for w in neg if w not in taken]
        half = landmarks // 2
        marks = list(dict.fromkeys(pos))[:half]
        marks += neg[-(landmarks - len(marks)):]
        gram = kernel(marks, marks).astype(np.float64)
        values, vectors = np.linalg.eigh(gram)
        good = values > 1e-6 * values[-1]
        project = vectors[:, good] / np.sqrt(values[good])
        x = np.concatenate([kernel(pos, marks), kernel(neg, marks)]) @ project
        w = fit_svm(x, np.r_[np.ones(len(pos)), np.zeros(len(neg))])
        alpha = project @ w[:-1]
        weights = np.zeros(LETTERS**3, np.float32)
        for at, codes in by_length(marks, 512):
            number, weight, size = features(codes)
            np.add.at(weights, number, weight * (alpha[at] / size)[:, None])
        model = Model(weights, float(w[-1]))
        if mined < 2:
            found = measured(rest.select("word"), model, "word").orderBy(F.desc(F.col(MEASURES)[0]), "word")
            hard = found.select("word").limit(SAMPLE_WINDOWS // 4)
            negative += [r["word"] for r in hard.collect()]
    judged = measured(chosen.where("part = 0") if apart else chosen, model, "text", ["toxic"]).collect()
    y = np.array([r["toxic"] for r in judged])
    share = {k: counts[k] / max(1, (y == k).sum()) for k in (0, 1)}
    scale = len(y) / max(1e-9, sum(share[k] * (y == k).sum() for k in (0, 1)))
    model.slope, model.shift = fit_curve(
        np.array([r[MEASURES] for r in judged]), y, np.array([share[k] * scale for k in y.tolist()])
    )
    return model


# ---- operator ----


def curve(model: Model) -> Column:
    z = F.lit(model.shift)
    for i, slope in enumerate(model.slope.tolist()):
        z = z + F.col(MEASURES)[i] * slope
    return 1 / (1 + F.exp(-z))


def score(docs: DataFrame, model: Model | None, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, score) for every row of docs; without a model every score is 0.

    Null and empty texts have the lowest margin. Repeated rows are scored alike; an empty table gives no rows; other
    columns are ignored.
    """
    if model is None:
        return docs.select(F.col(doc_id).alias("doc_id"), F.lit(0.0).alias("score"))
    return measured(docs, model, text, [doc_id]).select(F.col(doc_id).alias("doc_id"), curve(model).alias("score"))


def keep_clean(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """The documents whose score is below the threshold, with all their columns; nothing is shuffled.

    Null and empty texts have the lowest margin and stay; repeated rows stay or go together; an empty table gives no rows. Without
    labels of both classes all stay.
    """
    model = fit(docs, labels)
    if model is None:
        return docs
    aside, back = set_aside(docs, [MEASURES])
    return measured(aside, model).where(curve(model) < threshold).drop(MEASURES).withColumnsRenamed(back)


def op9_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    """Every document scored by a machine that is fitted on the labels."""
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    model = fit(docs, spark.read.parquet(f"{folder}/labels.parquet"))
    return score(docs, model).select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), "score",
        (F.col("score") >= THRESHOLD).cast("int").alias("predicted"),
    )
