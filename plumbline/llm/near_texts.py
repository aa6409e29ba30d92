"""One document of each group of near copies: SimHash finds candidates, the Jaccard index of word shingles decides."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plumbline.llm.columns import parts_of, released
from plumbline.llm.graph import components, landed
from plumbline.llm.simhash import DISTANCE, SEED, Cost, bit_counts, fold_bits, links, pairs_between
from plumbline.storage import run_folder

#: Two texts are near copies if their shingles of so many words have this Jaccard index or more.
SHINGLE = 5
SIMILARITY = 0.8
#: Candidates are fingerprints of shorter shingles, which an edit disturbs less, with at most so many differing bits.
PRINT_SHINGLE = 2
PRINT_DISTANCE = 9
#: A text's shingles are kept in so many bits, each the parity of the shingles that fall on it; a column holds 64 of them.
SKETCH_BITS = 256
SKETCH = [f"s{i}" for i in range(SKETCH_BITS // 64)]


def words_of(text: str | None) -> list[bytes]:
    """A-Z are lowered, words end at ASCII white space."""
    return (text or "").encode("utf-8", "surrogatepass").lower().split()


def shingle_hashes(text: str | None, k: int = SHINGLE) -> np.ndarray:
    """Different shingles of a text by hash, in order."""
    return _hashes(words_of(text), k)


def _hashes(words: list[bytes], k: int) -> np.ndarray:
    if not words:
        return np.zeros(0, np.uint64)
    shingles = map(b" ".join, zip(*(words[i:] for i in range(k)))) if len(words) >= k else [b" ".join(words)]
    return np.unique(np.fromiter(map(xxhash.xxh64_intdigest, shingles, repeat(SEED)), np.uint64))


def jaccard(a: np.ndarray, b: np.ndarray) -> float:
    """Of two sets of hashes; two empty ones are equal."""
    both = len(np.intersect1d(a, b, assume_unique=True))
    return both / (len(a) + len(b) - both) if len(a) + len(b) else 1.0


def set_fingerprints(texts: list[str | None], k: int = PRINT_SHINGLE) -> np.ndarray:
    """SimHash fingerprints of the different shingles of each text; common ones count once, so they don't make texts alike."""
    return _fingerprints([shingle_hashes(t, k) for t in texts])


def _fingerprints(sets: list[np.ndarray]) -> np.ndarray:
    sizes = np.array([len(s) for s in sets], np.int64)
    out = np.zeros(len(sets), np.uint64)
    full = np.flatnonzero(sizes)
    if len(full):
        starts = np.concatenate([[0], np.cumsum(sizes[full])[:-1]])
        out[full] = fold_bits(bit_counts(np.concatenate([sets[i] for i in full]), starts), sizes[full])
    return out


def sketches(sets: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Size of each set of hashes, and its sketch: two sketches differ in no more bits than their sets in elements."""
    sizes = np.array([len(s) for s in sets], np.int64)
    hashes = np.concatenate([np.zeros(0, np.uint64), *sets])
    places = np.repeat(np.arange(len(sets)), sizes) * SKETCH_BITS + (hashes % np.uint64(SKETCH_BITS)).astype(np.int64)
    odd = (np.bincount(places, minlength=len(sets) * SKETCH_BITS) & 1).astype(np.uint8)
    return sizes, np.packbits(odd.reshape(len(sets), SKETCH_BITS), axis=1, bitorder="little").view(np.int64)


def may_be_near(similarity: float) -> Cost:
    """Sizes and sketches of texts to the least share of their shingles in which two of them differ; infinite if too large.

    Sets with a Jaccard index of s or more differ in at most (1 - s) / (1 + s) of the sum of their sizes.
    """
    most = (1 - similarity) / (1 + similarity) + 1e-9

    def of(sizes: np.ndarray, *sketch: np.ndarray):
        def cost(a: np.ndarray, b: np.ndarray) -> np.ndarray:
            apart = np.abs(sizes[a] - sizes[b])
            bits = sum(np.bitwise_count(s[a] ^ s[b]).astype(np.int64) for s in (c.view(np.uint64) for c in sketch))
            share = np.maximum(apart, bits) / np.maximum(sizes[a] + sizes[b], 1)
            return np.where(share <= most, share, np.inf)

        return cost

    return of


def _prints(docs: DataFrame, print_shingle: int, shingle: int) -> DataFrame:
    """(doc, fp, mark, size and sketch): fingerprint, digest of the lowered words of each text, its shingles in short."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts_of(batches):
            words = [words_of(t) for t in part.column(1).to_pylist()]
            marks = [hashlib.blake2b(b" ".join(w), digest_size=16).digest() for w in words]
            fps = _fingerprints([_hashes(w, print_shingle) for w in words])
            sizes, sketch = sketches([_hashes(w, shingle) for w in words])
            yield pa.RecordBatch.from_arrays(
                [part.column(0), pa.array(fps.view(np.int64)), pa.array(marks, pa.binary()), pa.array(sizes), *map(pa.array, np.ascontiguousarray(sketch.T))],
                ["doc", "fp", "mark", "size", *SKETCH],
            )

    kind = docs.schema["doc"].dataType.simpleString()
    short = ", ".join(f"{c} bigint" for c in ("size", *SKETCH))
    return docs.select("doc", "text").mapInArrow(released(run), f"doc {kind}, fp bigint, mark binary, {short}")


def _similar(edges: DataFrame, docs: DataFrame, shingle: int, similarity: float, path: str) -> DataFrame:
    """The edges (a, b) of documents whose texts are near copies."""
    ends = edges.select(F.explode(F.array("a", "b")).alias("doc")).distinct()
    kind = docs.schema["doc"].dataType.simpleString()

    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in parts_of(batches):
            found = [shingle_hashes(t, shingle).tobytes() for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, pa.binary())], ["doc", "shingles"])

    some = docs.join(ends, "doc", "left_semi").select("doc", "text").mapInArrow(released(sets), f"doc {kind}, shingles binary")
    some = landed(some.dropDuplicates(["doc"]), f"{path}/shingles.parquet")
    left = some.select(F.col("doc").alias("a"), F.col("shingles").alias("sa"))
    right = some.select(F.col("doc").alias("b"), F.col("shingles").alias("sb"))

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in parts_of(batches):
            pairs = zip(batch.column(2).to_pylist(), batch.column(3).to_pylist())
            near = [jaccard(np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)) >= similarity for x, y in pairs]
            yield batch.filter(pa.array(near, pa.bool_())).select([0, 1])

    # Sets of sizes further apart than the threshold can't be that similar; two empty ones are equal.
    size = some.select("doc", F.octet_length("shingles").alias("size"))
    sized = edges.join(size.toDF("a", "na"), "a").join(size.toDF("b", "nb"), "b")
    sized = sized.where(F.least("na", "nb") >= F.greatest("na", "nb") * (similarity - 1e-9)).select("a", "b")
    both = sized.join(left, "a").join(right, "b").select("a", "b", "sa", "sb")
    return landed(both.mapInArrow(released(judge), f"a {kind}, b {kind}"), f"{path}/similar.parquet")


def one_of_each(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    shingle: int = SHINGLE,
    similarity: float = SIMILARITY,
    print_shingle: int = PRINT_SHINGLE,
    distance: int = PRINT_DISTANCE,
) -> DataFrame:
    """The documents without those that are near copies of one with a smaller id, with all their columns.

    Texts with the same words are linked at once. Fingerprints with at most two differing bits are linked next, and the first documents
    of these groups at up to `distance` bits, so that most of a large group of near copies is one class before all texts are
    searched: the last search takes every pair of different texts in different classes at up to `distance` bits. A link
    counts only if the texts' shingles have a Jaccard index of `similarity` or more; pairs whose sizes and sketches show that they
    can't reach it (`may_be_near`) are never made. Of connected documents the smallest id stays.

    Ids are whole numbers. Rows with one id stay or go together, by the smallest digest of their texts; rows with a null id stay. Null and
    empty texts are copies of each other. An empty table gives no rows.
    """
    path = run_folder(docs.sparkSession, "near")
    named = docs.select(F.col(doc_id).alias("doc"), F.col(text).alias("text")).where("doc IS NOT NULL")
    prints = landed(_prints(named, print_shingle, shingle), f"{path}/prints.parquet")
    short = ["size", *SKETCH]
    one = prints.groupBy("doc").agg(F.min(F.struct("mark", "fp", *short)).alias("x")).select("doc", "x.*")
    texts = one.groupBy("mark").agg(F.min(F.struct(F.col("doc").alias("first"), "fp", *short)).alias("x")).select("mark", "x.*")
    texts = landed(texts, f"{path}/texts.parquet")
    firsts = landed(texts.groupBy("fp").agg(F.min(F.struct("first", *short)).alias("x")).select("fp", "x.*"), f"{path}/firsts.parquet")
    same = texts.join(firsts.select("fp", F.col("first").alias("b")), "fp").where("first <> b").select(F.col("first").alias("a"), "b")
    cost = may_be_near(similarity)

    def linked(fps: DataFrame, bits: int, name: str) -> DataFrame:
        found = landed(links(fps.select("fp", *short), distance=bits, cost=cost), f"{path}/links-{name}.parquet")
        ends = found.join(fps.select(F.col("fp").alias("a"), F.col("first").alias("x")), "a").join(fps.select(F.col("fp").alias("b"), F.col("first").alias("y")), "b")
        return ends.select(F.col("x").alias("a"), F.col("y").alias("b"))

    close = landed(same.unionByName(linked(firsts, DISTANCE, "close")), f"{path}/close.parquet")
    close = _similar(close, named, shingle, similarity, f"{path}/close-checked")
    groups = components(close.select(F.col("a").cast("bigint").alias("a"), F.col("b").cast("bigint").alias("b")))
    inner = groups.where("node <> root").select(F.col("node").alias("first"))
    edges = close
    if distance > DISTANCE:
        heads = landed(firsts.join(inner, "first", "left_anti"), f"{path}/heads.parquet")
        wide = landed(linked(heads, distance, "wide"), f"{path}/wide.parquet")
        edges = close.unionByName(_similar(wide, named, shingle, similarity, f"{path}/wide-checked"))
    # The links so far are a spanning forest of the candidates, which has gaps where one of its links failed.
    edges = edges.select(F.col("a").cast("bigint").alias("a"), F.col("b").cast("bigint").alias("b"))
    known = landed(components(edges), f"{path}/known.parquet")
    entries = texts.select("fp", F.col("first").cast("bigint").alias("doc"), *short).join(known.withColumnRenamed("node", "doc"), "doc", "left")
    entries = landed(entries.select("fp", "doc", F.coalesce("root", "doc").alias("class"), *short), f"{path}/entries.parquet")
    kind = docs.schema[doc_id].dataType
    rest = landed(pairs_between(entries, distance=distance, cost=cost), f"{path}/rest.parquet")
    rest = _similar(rest.select(F.col("a").cast(kind).alias("a"), F.col("b").cast(kind).alias("b")), named, shingle, similarity, f"{path}/rest-checked")
    edges = edges.unionByName(rest.select(F.col("a").cast("bigint").alias("a"), F.col("b").cast("bigint").alias("b")))
    parts = landed(components(edges), f"{path}/parts.parquet")
    least = parts.groupBy("root").agg(F.min("node").alias("stays"))
    gone_texts = parts.join(least, "root").where("node <> stays").select(F.col("node").alias("first"))
    copies = one.join(texts.select("mark", "first"), "mark").select("doc", "first")
    gone = copies.where("doc <> first").select("doc").union(copies.join(gone_texts, "first").select("doc")).distinct()
    gone = landed(gone.select(F.col("doc").alias("_gone")), f"{path}/gone.parquet")
    return docs.join(gone, docs[doc_id] == gone["_gone"], "left_anti")
