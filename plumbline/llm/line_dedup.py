"""Passages that many documents share, found as content-defined chunks of lines."""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from plumbline.llm.columns import parts_of, released, set_aside
from plumbline.storage import checkpointed, run_folder

#: A passage goes if it has so many words and several lines, or so many words in one line.
RUN_WORDS = 20
LINE_ALONE_WORDS = 50

_END = re.compile(r"[.!?] +|\n")
_MULTIPLIER = 0x9E3779B97F4A7C15
_INVERSE = pow(_MULTIPLIER, -1, 2**64)


def lines_of(text: str) -> list[str]:
    """The text cut after each line feed and after the spaces behind a sentence's end; nothing is lost."""
    out, at = [], 0
    for m in _END.finditer(text):
        out.append(text[at : m.end()])
        at = m.end()
    if at < len(text):
        out.append(text[at:])
    return out


def full_lines(text: str) -> list[str]:
    """The lines that are not white space; places are counted in them."""
    return [x for x in lines_of(text) if not x.isspace()]


def _powers(base: int, n: int) -> np.ndarray:
    """base ** 0, base ** 1, ... modulo 2 ** 64."""
    out = np.full(n, base, np.uint64)
    out[:1] = 1
    return np.multiply.accumulate(out)


def chunks_of_all(texts: list[list[str]]) -> tuple[np.ndarray, ...]:
    """(text, hash, first line, lines) of the chunks of several texts, given as their full lines.

    Chunks are the shortest runs of several lines with `RUN_WORDS` words, one from each line on and one up to each line,
    and the lines with `LINE_ALONE_WORDS` words. So they depend on their own lines alone; a passage that is large enough
    has one at its first line and one at its last, and its chunks cover all of it, whatever stands around it.
    """
    sizes = np.array([len(x) for x in texts], np.int64)
    n = int(sizes.sum())
    starts = np.cumsum(sizes) - sizes
    owner = np.repeat(np.arange(len(texts)), sizes)
    low, high = starts[owner], (starts + sizes)[owner]
    bare = [x.strip() for lines in texts for x in lines]
    hashes = np.fromiter((xxhash.xxh64_intdigest(x.encode("utf-8", "surrogatepass")) for x in bare), np.uint64, n)
    words = np.fromiter((len(x.split()) for x in bare), np.int64, n)
    total = np.concatenate([[0], np.cumsum(words)])
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(hashes * _powers(_MULTIPLIER, n), dtype=np.uint64)])
    at = np.arange(n)
    ahead = np.maximum(np.searchsorted(total, total[:-1] + RUN_WORDS), at + 2)
    back = np.minimum(np.searchsorted(total, total[1:] - RUN_WORDS, "right") - 1, at - 1)
    fits, backs, alone = ahead <= high, back >= low, words >= LINE_ALONE_WORDS
    backs[backs] &= ahead[back[backs]] != at[backs] + 1  # else the same chunk
    first = np.concatenate([at[fits], back[backs], at[alone]])
    end = np.concatenate([ahead[fits], at[backs] + 1, at[alone] + 1])
    mixed = (sums[end] - sums[first]) * _powers(_INVERSE, n + 1)[first]
    return owner[first], mixed.view(np.int64), first - low[first], end - first


def chunks_of(lines: list[str]) -> list[tuple[int, int, int]]:
    """(hash, first line, lines) of each chunk of one text."""
    _, *found = chunks_of_all([lines])
    return list(zip(*(x.tolist() for x in found)))


def chunk_bytes(lines: list[str], at: int, n: int) -> bytes:
    return "\n".join(x.strip() for x in lines[at : at + n]).encode("utf-8", "surrogatepass")


def occurrences(docs: DataFrame) -> DataFrame:
    """(doc_id, hash, at, lines) of every chunk of every text; docs has doc_id and text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for low in range(0, batch.num_rows, 512):
                part = batch.slice(low, 512)
                owner, hashes, at, lines = chunks_of_all([full_lines(t or "") for t in part.column(1).to_pylist()])
                yield pa.RecordBatch.from_arrays(
                    [part.column(0).take(pa.array(owner)), pa.array(hashes), *(pa.array(x.astype(np.int32)) for x in (at, lines))],
                    ["doc_id", "hash", "at", "lines"],
                )

    kind = docs.schema["doc_id"].dataType.simpleString()
    found = docs.select("doc_id", "text").where("doc_id IS NOT NULL")
    return found.mapInArrow(released(run), f"doc_id {kind}, hash bigint, at int, lines int")


def covering(chunks: list[tuple[int, int]]) -> list[int]:
    """Numbers of few chunks (first line, lines) that cover the same lines as all of them."""
    order = sorted(range(len(chunks)), key=chunks.__getitem__)
    out, covered, i = [], 0, 0
    while i < len(order):
        reach = max(covered, chunks[order[i]][0])
        best = -1
        while i < len(order) and chunks[order[i]][0] <= reach:
            if (end := sum(chunks[order[i]])) > covered:
                best, covered = order[i], end
            i += 1
        if best >= 0:
            out.append(best)
    return out


def repeated_runs(chunks: DataFrame) -> DataFrame:
    """(doc_id, at, lines, hash, first) of chunks that cover what is to be removed, by hash.

    The first place of a chunk is the smallest (doc_id, at), and it stays; so does a chunk that overlaps it.
    """
    first = chunks.groupBy("hash").agg(F.min(F.struct("doc_id", "at")).alias("first"), F.count(F.lit(1)).alias("n"))
    first = checkpointed(first.where("n > 1").drop("n"))  # so that Spark can split a frequent hash in the join
    again = chunks.join(first, "hash").where(
        "struct(doc_id, at) <> first AND (doc_id <> first.doc_id OR at >= first.at + lines)"
    )
    listed = again.groupBy("doc_id").agg(F.collect_set(F.struct("at", "lines", "hash", "first")).alias("again"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in parts_of(batches):
            lists = batch.column(1)
            flat = lists.flatten()
            ends = np.cumsum(lists.value_lengths().to_numpy())
            at, lines = flat.field("at").to_pylist(), flat.field("lines").to_pylist()
            owner, kept = [], []
            for row, (low, high) in enumerate(zip([0, *ends[:-1].tolist()], ends.tolist())):
                some = covering(list(zip(at[low:high], lines[low:high])))
                owner += [row] * len(some)
                kept += [low + i for i in some]
            rows = flat.take(pa.array(kept, pa.int64()))
            ids = batch.column(0).take(pa.array(owner, pa.int64()))
            yield pa.RecordBatch.from_arrays([ids, *(rows.field(k) for k in RUN_COLUMNS)], ["doc_id", *RUN_COLUMNS])

    kind = chunks.schema["doc_id"].dataType.simpleString()
    return listed.mapInArrow(released(run), f"doc_id {kind}, at int, lines int, hash bigint, first struct<doc_id: {kind}, at: int>")


RUN_COLUMNS = ["at", "lines", "hash", "first"]
TODO = "_todo"


def _with_lists(docs: DataFrame, lists: DataFrame) -> DataFrame:
    """docs with all its columns and, last, the list of its id or null.

    Both uses shuffle the documents in the same way, so that Spark shuffles the texts once and reads them twice.
    """
    listed = lists.withColumnRenamed("doc_id", "_listed")
    return docs.join(listed, docs["doc_id"] == listed["_listed"], "left").select(*(docs[c] for c in docs.columns), TODO)


def first_texts(docs: DataFrame, runs: DataFrame) -> DataFrame:
    """(hash, body): the bytes of each chunk at its first place."""
    wanted = runs.select("first", "hash", "lines").distinct().groupBy(F.col("first.doc_id").alias("doc_id")).agg(
        F.collect_list(F.struct("first.at", "lines", "hash")).alias(TODO)
    )
    text = docs.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in parts_of(batches):
            hashes, bodies = [], []
            for t, todo in zip(batch.column(text).to_pylist(), batch.column(batch.num_columns - 1).to_pylist()):
                lines = full_lines(t or "") if todo else []
                for c in todo or []:
                    hashes.append(c["hash"])
                    bodies.append(chunk_bytes(lines, c["at"], c["lines"]))
            yield pa.RecordBatch.from_arrays([pa.array(hashes, pa.int64()), pa.array(bodies, pa.binary())], ["hash", "body"])

    found = _with_lists(docs, wanted).mapInArrow(released(run), "hash bigint, body binary")
    return found.groupBy("hash").agg(F.min("body").alias("body"))


REMOVED = "removed_words"


def without(text: str, gone: set[int]) -> str:
    """The text without the full lines of these numbers and without the white space lines between them; empty if all go."""
    out, held, place, last = [], [], 0, True
    for x in lines_of(text):
        if x.isspace():
            held.append(x)
            continue
        if not (last and place in gone):
            out += held
        held.clear()
        if not (last := place in gone):
            out.append(x)
        place += 1
    return "".join([*out, *held]) if len(gone) < place else ""


def remove_repeats(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The documents with all their columns, their texts without repeated passages, and `removed_words`.

    Passages are runs of lines that stand in an earlier document, or earlier in the same one, byte for byte, except for
    white space around lines and lines of it: at least 20 words in several lines, or 50 in one. All of them are found.
    The first place (smallest id, then position) keeps the passage. A text that is repeated whole becomes empty; no row goes. Null and empty texts stay as
    they are; rows with a null id are not searched. Rows with one id count as one document. A column named
    `removed_words` is replaced. An empty table gives no rows.
    """
    spark = docs.sparkSession
    own = {"doc_id": doc_id, "text": text}
    aside, back = set_aside(docs.drop(REMOVED), [TODO, *(name for name, given in own.items() if given != name)])
    source = aside.withColumnsRenamed({given: name for name, given in own.items()})
    folder = run_folder(spark, "lines")
    occurrences(source).write.parquet(f"{folder}/chunks.parquet")
    repeated_runs(spark.read.parquet(f"{folder}/chunks.parquet")).write.parquet(f"{folder}/runs.parquet")
    runs = spark.read.parquet(f"{folder}/runs.parquet")
    bodies = first_texts(source, runs)
    lists = runs.join(bodies, "hash").groupBy("doc_id").agg(F.collect_list(F.struct("at", "lines", "body")).alias(TODO))
    joined = _with_lists(source, lists)
    names = source.columns
    at_text = names.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in parts_of(batches):
            texts, counts = [], []
            for t, todo in zip(batch.column(at_text).to_pylist(), batch.column(batch.num_columns - 1).to_pylist()):
                gone: set[int] = set()
                if todo and t:
                    lines = full_lines(t)
                    for c in todo:
                        if chunk_bytes(lines, c["at"], c["lines"]) == c["body"]:
                            gone.update(range(c["at"], c["at"] + c["lines"]))
                    counts.append(sum(len(lines[i].split()) for i in gone))
                    texts.append(without(t, gone) if gone else t)
                else:
                    counts.append(0)
                    texts.append(t)
            columns = batch.columns[:-1]
            columns[at_text] = pa.array(texts, columns[at_text].type)
            yield pa.RecordBatch.from_arrays([*columns, pa.array(counts, pa.int64())], [*names, REMOVED])

    done = joined.mapInArrow(released(run), T.StructType([*source.schema.fields, T.StructField(REMOVED, T.LongType())]))
    return done.withColumnsRenamed(own).withColumnsRenamed(back)


def op3_line_dedup(spark: SparkSession, folder: str) -> DataFrame:
    """Every document without the passages that stand in an earlier one."""
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    return remove_repeats(docs).select("doc_id", "text", REMOVED)
