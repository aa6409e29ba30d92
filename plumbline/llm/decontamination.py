"""Benchmark passages in documents: latent semantic retrieval, then longest common subsequences and answers."""

from __future__ import annotations

import sys
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from plumbline.llm.columns import parts_of, released, set_aside
from plumbline.llm.graph import landed
from plumbline.storage import run_folder

#: Words of a passage when terms are counted and the factors are fitted.
PASSAGE = 64
RANK = 48
OVERSAMPLE = 16
#: Texts whose terms are kept in one row for the fit, characters that are cut and words that are searched at a time.
TOGETHER = 64
CUT = 2**20
SEARCHED = 8192
#: Rows that are added one after another when runs of rows are summed.
PIECE = 16
#: Multiplications of a product that numpy does in one thread.
SMALL = 250_000
#: Benchmark items that one search holds; more are searched in blocks.
BLOCK_ITEMS = 2000
#: Terms in more than this share of the passages carry no weight.
COMMON = 0.2
COSINE = 0.6
#: Shares of an item's words in one common subsequence: a leak, or one if the answer stands there too.
LEAK = 0.8
PARAPHRASE = 0.6
#: Items with fewer words name nothing and are not searched.
LEAST_WORDS = 5
GROWTH = 1.5
#: Pairs whose words are compared at a time.
CHUNK = 20_000
_MARKS = "\"'.,;:!?()[]{}|*#$%&<>«»“”„‚‘’-–—_/\\~^`+="


def terms_of(text: str | None) -> list[str]:
    """Lower-case words; marks separate words as white space does."""
    text = (text or "").lower()
    for mark in _MARKS:
        text = text.replace(mark, " ")
    return text.split()


#: Characters that part words: the marks and white space, as `str.split` has it. All of them take one to three bytes.
_BREAKS = {ord(c) for c in _MARKS} | {c for c in range(sys.maxunicode + 1) if chr(c).isspace()}
_BREAK = np.zeros(2**16, bool)
_BREAK[sorted(_BREAKS)] = True
_BREAK_BYTE = _BREAK[:256] & (np.arange(256) < 128)
#: First bytes of the breaks that are longer.
_LEAD = np.zeros(256, bool)
_LEAD[sorted({chr(c).encode()[0] for c in _BREAKS if c > 127})] = True


def _breaks(text: np.ndarray) -> np.ndarray:
    """Which bytes of UTF-8 text belong to characters that part words."""
    parts = _BREAK_BYTE[text]
    at = np.flatnonzero(_LEAD[text])
    if len(at):
        first, second = text[at].astype(np.int32), text[at + 1].astype(np.int32) & 63
        three = first >= 0xE0
        third = text[np.minimum(at + 2, len(text) - 1)].astype(np.int32) & 63
        code = np.where(three, (first & 15) << 12 | second << 6 | third, (first & 31) << 6 | second)
        found = _BREAK[code]
        at, three = at[found], three[found]
        parts[at] = parts[at + 1] = True
        parts[at[three] + 2] = True
    return parts


class Numbers:
    """Texts to the numbers of their terms, 0 for a term outside the benchmark.

    The words are those of `terms_of`; some texts are cut and looked up at a time, without an object for each word.
    """

    def __init__(self, vocabulary: dict[str, int]):
        self.terms = pa.array([f"{term} ".encode() for term in vocabulary], pa.binary())
        self.number = np.array([0, *vocabulary.values()], np.int32)

    def of(self, texts: list[str | None]) -> Iterator[np.ndarray]:
        held, size = [], 0
        for text in texts:
            held.append((text or "").lower().encode())
            size += len(held[-1])
            if size >= CUT:
                yield from self._of(held)
                held, size = [], 0
        yield from self._of(held)

    def _of(self, texts: list[bytes]) -> Iterator[np.ndarray]:
        joined = np.frombuffer(b" ".join([*texts, b""]), np.uint8)
        parts = _breaks(joined)
        words = np.flatnonzero(parts[1:] & ~parts[:-1]) + 1  # the byte behind each word
        # Words without what lies between them, each with a blank behind it.
        keep = ~parts
        keep[words] = True
        body = np.where(parts, np.uint8(32), joined)[keep]
        ends = np.flatnonzero(body == 32).astype(np.int32) + 1
        offsets = np.concatenate([np.zeros(1, np.int32), ends])
        column = pa.Array.from_buffers(pa.binary(), len(ends), [None, pa.py_buffer(offsets), pa.py_buffer(body)])
        found = pc.fill_null(pc.index_in(column, value_set=self.terms), -1).to_numpy(zero_copy_only=False)
        ids = self.number[found + 1]
        stop = np.searchsorted(words, np.cumsum([len(t) + 1 for t in texts]))
        yield from (ids[low:high] for low, high in zip([0, *stop.tolist()], stop.tolist()))


# ---- items ----


@dataclass
class Item:
    item_id: object
    terms: np.ndarray
    answer: np.ndarray
    masks: dict[int, int]


def read_items(rows: list[tuple]) -> tuple[list[Item], dict[str, int]]:
    """Items (id, text, answer or None) and the numbers of their terms, from 1.

    Without an answer the text's last sentence of at least three words stands for it.
    """
    vocabulary: dict[str, int] = {}
    number = lambda words: np.array([vocabulary.setdefault(w, len(vocabulary) + 1) for w in words], np.int32)
    items = []
    for item_id, text, answer in rows:
        terms = number(terms_of(text))
        if len(terms) < LEAST_WORDS:
            continue
        if answer is None:
            parts = [p for p in map(terms_of, (text or "").replace("\n", ". ").split(". ")) if len(p) >= 3]
            last = parts[-1] if parts else []
        else:
            last = terms_of(answer)
        masks: dict[int, int] = {}
        for at, t in enumerate(terms.tolist()):
            masks[t] = masks.get(t, 0) | 1 << at
        items.append(Item(item_id, terms, number(last), masks))
    return items, vocabulary


def common_length(masks: dict[int, int], n: int, words: list[int]) -> int:
    """Length of the longest common subsequence of an item of n words and `words`, a bit for each of the item's words."""
    full = (1 << n) - 1
    v = full
    for w in words:
        if m := masks.get(w):
            u = v & m
            v = ((v + u) | (v - u)) & full
    return n - v.bit_count()


def stands_in(answer: list[int], words: list[int]) -> bool:
    at = iter(words)
    return bool(answer) and all(a in at for a in answer)


# ---- factors ----


def _unit(x: np.ndarray) -> np.ndarray:
    return x / np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-12)


def _times(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """a b', some rows at a time: on small products numpy starts no threads, whose waiting costs a task more than they save."""
    rows = max(1, SMALL // b.size)
    return np.concatenate([a[i : i + rows] @ b.T for i in range(0, len(a), rows)])


@dataclass
class Space:
    """The place of each term in the factors, as a vector as long as the term is rare; row 0 is no term."""

    vocabulary: dict[str, int]
    load: np.ndarray


def kept_terms(docs: DataFrame, vocabulary: dict[str, int]) -> DataFrame:
    """(ids): the numbers of the terms of all texts, some texts a row, each filled up to whole passages.

    Texts are cut into words once for the fit; what is kept is smaller than the texts.
    """
    shared, kind = docs.sparkSession.sparkContext.broadcast(vocabulary), id_type(len(vocabulary))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        numbers = Numbers(shared.value)
        for part in parts_of(batches, TOGETHER):
            found = []
            for ids in numbers.of(part.column(0).to_pylist()):
                found += [ids.astype(kind), np.zeros(-len(ids) % PASSAGE, kind)]
            yield pa.RecordBatch.from_arrays([pa.array([np.concatenate(found).tobytes()], pa.binary())], ["ids"])

    return landed(docs.select("text").mapInArrow(released(run), "ids binary"), f"{run_folder(docs.sparkSession, 'terms')}/ids.parquet")


def id_type(terms: int) -> type:
    return np.uint16 if terms < 2**16 else np.int32


def passage_rows(ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(passage, term) of the benchmark terms of texts, cut every `PASSAGE` words."""
    at = np.flatnonzero(ids > 0)
    return at // PASSAGE, ids[at]


def count_passages(kept: DataFrame, terms: int) -> tuple[np.ndarray, int]:
    """In how many passages of all documents each term stands, and how many passages there are."""
    size, kind = terms + 1, id_type(terms)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(size, np.int64)
        for part in parts_of(batches, 1):
            ids = np.frombuffer(part.column(0)[0].as_py(), kind)
            passage, term = passage_rows(ids)
            pairs = np.unique(passage * size + term)
            counts += np.bincount(pairs % size, minlength=size)
            counts[0] += len(ids) // PASSAGE
        used = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(counts[used])], ["term", "n"])

    found = kept.mapInArrow(run, "term bigint, n bigint").groupBy("term").agg(F.sum("n").alias("n"))
    counts = np.zeros(size, np.int64)
    for r in found.collect():  # a row for each term of the block of items
        counts[r["term"]] = r["n"]
    total = int(counts[0])
    counts[0] = 0
    return counts, total


def _sum_matrices(parts: DataFrame) -> DataFrame:
    """(block, body) rows of equal shapes to one row for each block; sums as it reads."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for block, body in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                own = np.frombuffer(body)
                sums[block] = sums[block] + own if block in sums else own
        if sums:
            yield pa.RecordBatch.from_arrays(
                [pa.array(list(sums), pa.int64()), pa.array([s.tobytes() for s in sums.values()])], ["block", "body"]
            )

    return parts.repartition("block").mapInArrow(run, parts.schema)


def _sums_of(rows: np.ndarray, which: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """The sums of `rows[which]` from each start to the next.

    Runs are cut into pieces of at most `PIECE`; all first rows of the pieces are added at once, then all second ones.
    """
    sizes = np.diff(np.append(starts, len(which)))
    pieces = -(-sizes // PIECE)
    first = np.cumsum(pieces) - pieces
    nth = np.arange(pieces.sum()) - np.repeat(first, pieces)
    places = np.repeat(starts, pieces) + nth * PIECE
    sizes = np.minimum(np.repeat(sizes, pieces) - nth * PIECE, PIECE)
    order = np.argsort(-sizes, kind="stable")
    longest = places[order]
    sums = rows[which[longest]]
    for step in range(1, sizes.max()):
        left = int((sizes > step).sum())
        sums[:left] += rows[which[longest[:left] + step]]
    back = np.empty_like(order)
    back[order] = np.arange(len(order))
    return np.add.reduceat(sums[back], first, axis=0)


def _product(kept: DataFrame, idf: np.ndarray, right: np.ndarray, gram: bool) -> np.ndarray:
    """With A the TF-IDF matrix of the passages: A'(A right), or (A right)'(A right) if `gram`."""
    shared = kept.sparkSession.sparkContext.broadcast((idf, right))
    size, rank = right.shape
    kind, rows = id_type(size - 1), 512
    rows_small = max(1, SMALL // rank**2)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        idf, right = shared.value
        scaled = right * idf[:, None]
        total = np.zeros((rank, rank) if gram else (size, rank))
        for part in parts_of(batches, 1):
            passage, term = passage_rows(np.frombuffer(part.column(0)[0].as_py(), kind))
            weighs = idf[term] > 0
            passage, term = passage[weighs], term[weighs]
            if not len(term):
                continue
            new = np.r_[True, passage[1:] != passage[:-1]]
            sums = _sums_of(scaled, term, np.flatnonzero(new))
            if gram:
                for i in range(0, len(sums), rows_small):
                    total += sums[i : i + rows_small].T @ sums[i : i + rows_small]
                continue
            order = np.argsort(term, kind="stable")
            term = term[order]
            starts = np.flatnonzero(np.r_[True, term[1:] != term[:-1]])
            of_term = _sums_of(sums, (np.cumsum(new) - 1)[order], starts)
            total[term[starts]] += of_term * idf[term[starts]][:, None]
        for block, low in enumerate(range(0, len(total), rows)):
            yield pa.RecordBatch.from_arrays([pa.array([block], pa.int64()), pa.array([total[low : low + rows].tobytes()])], ["block", "body"])

    found = _sum_matrices(kept.mapInArrow(run, "block bigint, body binary")).collect()
    return np.concatenate([np.frombuffer(r["body"]).reshape(-1, rank) for r in sorted(found, key=lambda r: r["block"])])


def fit_space(docs: DataFrame, vocabulary: dict[str, int], rank: int = RANK, seed: int = 7) -> Space:
    """Randomised SVD of the TF-IDF passages of all documents over the benchmark's terms.

    The range of the matrix is found from random directions after one power step, both products being sums over the
    tasks; the factors come from the small matrix in that range.
    """
    kept = kept_terms(docs, vocabulary)
    counts, total = count_passages(kept, len(vocabulary))
    idf = np.where((counts > 0) & (counts <= max(1, COMMON * total)), np.log((1 + total) / (1 + counts)) + 1, 0.0)
    unseen = counts == 0
    idf[unseen] = np.log(1 + total) + 1
    idf[0] = 0
    size = len(vocabulary) + 1
    wide = min(rank + OVERSAMPLE, size)
    start = np.random.default_rng(seed).standard_normal((size, wide))
    if not total:
        return Space(vocabulary, idf[:, None] * start)
    basis, _ = np.linalg.qr(_product(kept, idf, start, False))
    values, vectors = np.linalg.eigh(_product(kept, idf, basis, True))
    values, vectors = values[::-1][:rank], vectors[:, ::-1][:, :rank]
    good = values > 1e-9 * max(values[0], 1e-12)
    if not good.any():
        return Space(vocabulary, idf[:, None] * start)
    factors = basis @ vectors[:, good]
    # Factors of equal strength and terms of a length set by rarity alone: a term of a frequent language or topic would
    # otherwise be drowned by a single term of a rare one in the same window.
    return Space(vocabulary, _unit(factors / np.sqrt(values[good])) * idf[:, None])


# ---- search ----


@dataclass
class Group:
    """Items of similar length and the windows they share; `member` tells which terms an item has."""

    items: list[Item]
    sizes: np.ndarray
    step: int
    width: int
    vectors: np.ndarray
    blank: np.ndarray
    member: np.ndarray


class Searcher:
    """Leaks of a block of items in texts, whose windows are compared together.

    A window is looked at if it has enough of the benchmark's words to hold the paraphrase share of an item of its
    group, which loses nothing; then the cosine of the window and each item is taken in the latent space. Pairs at
    `COSINE` or above that share enough words go to the subsequence check.
    """

    def __init__(self, items: list[Item], space: Space):
        self.numbers, self.load = Numbers(space.vocabulary), space.load.astype(np.float32)
        self.weighs = np.abs(self.load).sum(1) > 0
        self.groups: list[Group] = []
        longest = max((len(i.terms) for i in items), default=0)
        low, high = 0, LEAST_WORDS
        while low < longest:
            if own := [i for i in items if low < len(i.terms) <= high]:
                sizes = np.array([len(i.terms) for i in own])
                step = max(2, int(sizes.min()) // 2)
                vectors = np.array([self.load[i.terms].sum(0) for i in own])
                member = np.zeros((len(own), len(self.load)), np.uint8)
                for row, item in enumerate(own):
                    member[row, item.terms] = 1
                blank = np.linalg.norm(vectors, axis=1) < 1e-9
                self.groups.append(Group(own, sizes, step, int(sizes.max()) + step, _unit(vectors), blank, member))
            low, high = high, max(high + 1, int(high * GROWTH))
        #: Empty places between texts, so that a window with a step on both sides meets one text only.
        self.gap = np.zeros(max((g.width + 2 * g.step for g in self.groups), default=0), np.int32)

    def __call__(self, texts: list[str | None]) -> list[dict[object, float]]:
        """For each text item_id to the share of its words found in order, for the leaked items."""
        out, held, size = [], [], 0
        for ids in self.numbers.of(texts):
            held.append(ids)
            size += len(ids)
            if size >= SEARCHED:
                out += self._search(held)
                held, size = [], 0
        return out + self._search(held)

    def _search(self, texts: list[np.ndarray]) -> list[dict[object, float]]:
        found: list[dict[object, float]] = [{} for _ in texts]
        ids = np.concatenate([self.gap, *(part for text in texts for part in (text, self.gap))])
        inside = np.concatenate([[0], np.cumsum(ids > 0)])
        if not inside[-1]:
            return found
        sizes = np.array([len(t) for t in texts])
        stop = np.cumsum(sizes + len(self.gap))
        at = np.flatnonzero(self.weighs[ids])
        sums = None
        for g in self.groups:
            windows_of = -(-np.maximum(1, sizes - g.width + g.step) // g.step)
            owner = np.repeat(np.arange(len(texts)), windows_of)
            place = np.arange(len(owner)) - np.repeat(np.cumsum(windows_of) - windows_of, windows_of)
            starts = (stop - sizes)[owner] + place * g.step
            ends = np.minimum(starts + g.width, stop[owner])
            keep = inside[ends] - inside[np.minimum(starts, ends)] >= np.ceil(PARAPHRASE * g.sizes.min())
            owner, starts, ends = owner[keep], starts[keep], ends[keep]
            if not len(starts):
                continue
            if sums is None:
                sums = np.zeros((len(at) + 1, self.load.shape[1]), np.float32)
                sums[1:] = np.cumsum(self.load[ids[at]], axis=0, dtype=np.float64)
            windows = sums[np.searchsorted(at, ends)] - sums[np.searchsorted(at, starts)]
            length = np.sqrt(np.einsum("ij,ij->i", windows, windows))
            near = _times(windows, g.vectors) >= np.maximum(COSINE * length, 1e-6)[:, None]
            if g.blank.any():
                near[:, g.blank] = True
            w, i = np.nonzero(near)
            for low in range(0, len(w), CHUNK):
                part = w[low : low + CHUNK]
                self._compare(g, ids, starts[part], i[low : low + CHUNK], [found[o] for o in owner[part].tolist()])
        return found

    def _compare(self, g: Group, ids: np.ndarray, starts: np.ndarray, i: np.ndarray, founds: list[dict]) -> None:
        """The windows, a step longer on both sides inside their texts, that share enough words with the item, in order."""
        wide = g.width + 2 * g.step
        words = np.lib.stride_tricks.sliding_window_view(ids, wide)[starts - g.step]
        shared = g.member.ravel().take((i * g.member.shape[1])[:, None] + words).sum(1, dtype=np.uint8 if wide < 256 else np.int64)
        for k in np.flatnonzero(shared >= PARAPHRASE * g.sizes[i]).tolist():
            item, n, found = g.items[i[k]], int(g.sizes[i[k]]), founds[k]
            if found.get(item.item_id, 0.0) >= 1.0:
                continue
            row = words[k].tolist()
            there = 0  # places of the item whose words stand in the window at all, in whatever order
            for t in item.masks.keys() & set(row):
                there |= item.masks[t]
            if there.bit_count() < PARAPHRASE * n:
                continue
            share = common_length(item.masks, n, row) / n
            if share >= LEAK or (share >= PARAPHRASE and stands_in(item.answer.tolist(), row)):
                found[item.item_id] = max(found.get(item.item_id, 0.0), share)


LEAKS, BEFORE = "_leaks", "_leaks_before"


def _searched(docs: DataFrame, items: list[Item], space: Space, keep: list[str]) -> DataFrame:
    """The columns `keep` and, last, the leaks (item_id, share) of the text."""
    shared = docs.sparkSession.sparkContext.broadcast((items, space))
    at = keep.index("text") if "text" in keep else len(keep)  # a text that is kept goes to the worker once
    chosen = docs.select(*(F.col(f"`{c}`") for c in keep), *[F.col("text").alias(LEAKS)][: at == len(keep)])
    kind = T.ArrayType(T.StructType([T.StructField("item_id", T.LongType()), T.StructField("share", T.DoubleType())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        search = Searcher(*shared.value)
        form = pa.list_(pa.struct([("item_id", pa.int64()), ("share", pa.float64())]))
        for batch in parts_of(batches):
            found = [[{"item_id": i, "share": s} for i, s in sorted(x.items())] for x in search(batch.column(at).to_pylist())]
            yield pa.RecordBatch.from_arrays([*batch.columns[: len(keep)], pa.array(found, form)], [*keep, LEAKS])

    return chosen.mapInArrow(released(run), T.StructType([*chosen.schema.fields[: len(keep)], T.StructField(LEAKS, kind)]))


def item_blocks(benchmark: DataFrame, answer: str | None, block_items: int) -> Iterator[list[tuple]]:
    """The items (id, text, answer) in blocks of bounded size; null ids and null texts are left out."""
    rows = benchmark.where("item_id IS NOT NULL AND text IS NOT NULL").select(
        "item_id", "text", F.col(answer).alias("answer") if answer else F.lit(None).cast("string").alias("answer")
    ).distinct()
    blocks = max(1, -(-rows.count() // block_items))
    placed = rows.withColumn("block", F.pmod(F.xxhash64("item_id"), F.lit(blocks)))
    for block in range(blocks):
        yield sorted((tuple(r)[:3] for r in placed.where(F.col("block") == block).collect()), key=str)


def leaks(docs: DataFrame, benchmark: DataFrame, answer: str | None = None, keep: list[str] | None = None, block_items: int = BLOCK_ITEMS) -> DataFrame:
    """The columns `keep` of docs (all by default) and `_leaks`, an array of (item_id, share) of each row.

    docs has doc_id and text, the benchmark item_id (an integer) and text, and an answer column if it is named. Words are
    lower-cased and bare of marks at their edges. A document leaks an item if 80 % of the item's words stand in order in a
    window of it, or 60 % and the answer. Null and empty texts leak nothing; an item given twice counts once; items of
    under five words are not searched; empty tables give no leaks. Blocks of items are searched one after another. Columns of
    docs named `_leaks` or `_leaks_before` are left out.
    """
    docs = docs.drop(LEAKS, BEFORE)
    keep = docs.columns if keep is None else keep
    out = docs.withColumn(LEAKS, F.array().cast("array<struct<item_id:bigint,share:double>>"))
    before = None
    for rows in item_blocks(benchmark, answer, block_items):
        items, vocabulary = read_items(rows)
        if not items:
            continue
        space = fit_space(docs, vocabulary)
        if before is None:
            out = _searched(docs, items, space, docs.columns)
        else:
            more = _searched(out.withColumnRenamed(LEAKS, before), items, space, [*docs.columns, before])
            out = more.select(*docs.columns, F.concat(F.col(before), F.col(LEAKS)).alias(LEAKS))
        before = BEFORE
    return out.select(*(F.col(f"`{c}`") for c in keep), LEAKS)


def drop_leaking(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The documents without leaks, with all their columns; nothing is shuffled.

    Null and empty texts stay; repeated rows stay or go together; an empty table gives no rows.
    """
    aside, back = set_aside(docs, [LEAKS, BEFORE])
    return leaks(aside, benchmark).where(F.size(LEAKS) == 0).drop(LEAKS).withColumnsRenamed(back)


def op7_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    """The leaked items of every document."""
    docs = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text")
    found = leaks(docs, spark.read.parquet(f"{folder}/benchmark.parquet"), keep=["doc_id"])
    return found.select(
        "doc_id", (F.size(LEAKS) > 0).alias("leaked"), F.col(f"{LEAKS}.item_id").alias("item_ids"),
        F.array_max(f"{LEAKS}.share").alias("best_share"),
    )
