"""Records of CSV files, cut in parallel although quoted fields may hold line breaks.

Spark's text reader splits a file at line feeds. Whether a split begins inside a quoted field follows from the number of
quotes before it, so one pass counts quotes: a bit for each split, added up along the file. A second pass then cuts each
split into records by itself. A record that begins in one split and ends in a later one leaves a piece in each; the pieces,
at most two for each split, are put together by the place where the record begins.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from plumbline.storage import run_folder

_MARK = "﻿"


def _lines(spark: SparkSession, path: str) -> DataFrame:
    """(value, file, block, split): lines in file order, with the first byte of their split and a hash of both."""
    read = spark.read.option("lineSep", "\n").text(path)
    named = read.select("value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"))
    return named.withColumn("split", F.xxhash64("file", "block"))


def _runs(batch: pa.RecordBatch) -> Iterator[tuple[int, pa.RecordBatch]]:
    """The parts of a batch that lie in one split each."""
    split = batch.column(3).to_numpy()
    cuts = [0, *(np.flatnonzero(split[1:] != split[:-1]) + 1).tolist(), len(split)]
    for a, b in zip(cuts, cuts[1:]):
        if b > a:
            yield int(split[a]), batch.slice(a, b - a)


def _flips(lines: pa.Array, quotes: bool) -> np.ndarray:
    """For each line whether an odd number of quotes stands in this and the lines before it."""
    if not quotes:
        return np.zeros(len(lines), np.int64)
    return np.cumsum(pc.count_substring(lines, '"').to_numpy(zero_copy_only=False)) & 1


def _measured(quotes: bool):
    names = ["file", "block", "split", "flips", "odd", "header"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        state = None  # of the split being read: file, block, split, parity, whether a line ended at odd parity, header lines, header read

        def row():
            file, block, split, parity, odd, header, _ = state
            values = (file, block, split, bool(parity), bool(odd), None if block else "\n".join(header))
            kinds = (pa.string(), pa.int64(), pa.int64(), pa.bool_(), pa.bool_(), pa.string())
            return pa.RecordBatch.from_arrays([pa.array([v], k) for v, k in zip(values, kinds)], names)

        for batch in batches:
            for split, part in _runs(batch):
                if state is None or state[2] != split:
                    if state is not None:
                        yield row()
                    state = [part.column(1)[0].as_py(), part.column(2)[0].as_py(), split, 0, False, [], False]
                parity = _flips(part.column(0), quotes) ^ state[3]
                if not state[1] and not state[6]:
                    for at, line in enumerate(part.column(0)):
                        state[5].append(line.as_py())
                        if not parity[at]:
                            state[6] = True
                            break
                state[3] = int(parity[-1])
                state[4] = state[4] or bool(parity.any())
        if state is not None:
            yield row()

    return run


def _cut(quotes: bool, splits: np.ndarray, opened: np.ndarray, begun: np.ndarray, kinds: np.ndarray, pieces: bool):
    """The records of each split, or the pieces of those that lie in several."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, held, file, at = None, [], "", 0
        parity, leading, first = 0, False, False

        def out(records, whole_kind):
            if pieces:
                return None
            return pa.RecordBatch.from_arrays([pa.array([whole_kind] * len(records), pa.int32()), pa.array(records, pa.string())], ["header", "record"])

        def piece(key, text, kind):
            values = (kind, file, key, block, text)
            types = (pa.int32(), pa.string(), pa.int64(), pa.int64(), pa.string())
            return pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(values, types)], ["header", "file", "begun", "block", "record"])

        def left():
            """What is open at the end of a split: a record that goes on, or a split inside one record."""
            if held and pieces:
                return piece(int(begun[at]) if leading else block, "\n".join(held), int(kinds[at]))
            return None

        for batch in batches:
            for split, part in _runs(batch):
                if split != current:
                    if current is not None and (rest := left()) is not None:
                        yield rest
                    at = int(np.searchsorted(splits, split))
                    if at >= len(splits) or splits[at] != split:
                        raise RuntimeError("the files or their splits have changed since they were first read")
                    current, held = split, []
                    file, block = part.column(1)[0].as_py(), part.column(2)[0].as_py()
                    parity, leading, first = int(opened[at]), bool(opened[at]), block == 0
                ends = _flips(part.column(0), quotes) ^ parity
                lines = part.column(0).to_pylist()
                done = []
                for line, inside in zip(lines, ends.tolist()):
                    if inside:
                        held.append(line)
                        continue
                    if held or leading:
                        held.append(line)
                        line = "\n".join(held)
                        held = []
                    if leading:
                        leading = False
                        if pieces:
                            yield piece(int(begun[at]), line, int(kinds[at]))
                    elif first:
                        first = False
                    elif line and line != "\r":
                        done.append(line[:-1] if line[-1] == "\r" else line)
                parity = int(ends[-1])
                if done and (rows := out(done, int(kinds[at]))) is not None:
                    yield rows
        if current is not None and (rest := left()) is not None:
            yield rest

    return run


def header_names(header: str) -> list[str]:
    import csv

    return next(csv.reader([header.lstrip(_MARK).rstrip("\r")]), [])


def csv_records(spark: SparkSession, path: str, multi_line: bool = True) -> tuple[DataFrame, list[list[str]]]:
    """(header, record) of all files, without their header lines, and the column names of each different header.

    `header` is the number of the file's own header in that list. With `multi_line` quoted fields may hold line breaks.
    Empty lines are no records. The files are read three times, by as many tasks as their size gives. For each split 17
    bytes reach the driver and the tasks, a share of about one in ten million. An empty folder gives no headers.
    """
    lines = _lines(spark, path)
    kinds = "file string, block bigint, split bigint, flips boolean, odd boolean, header string"
    seen = lines.mapInArrow(_measured(multi_line), kinds)
    folder = run_folder(spark, "csv")
    seen.write.parquet(f"{folder}/splits.parquet")
    seen = spark.read.parquet(f"{folder}/splits.parquet")
    headers = [r[0] for r in seen.where("header IS NOT NULL").select("header").distinct().orderBy("header").collect()]
    whole = Window.partitionBy("file")
    before = whole.orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    opened = F.coalesce(F.sum(F.col("flips").cast("int")).over(before) % 2 == 1, F.lit(False))
    # a record ends in a split unless it is open from its first to its last line
    marked = seen.withColumn("opened", opened).withColumn("name", F.max("header").over(whole))
    ends = F.when(~F.col("opened") | F.col("odd"), F.col("block"))
    placed = marked.withColumn("begun", F.last(ends, ignorenulls=True).over(before))
    number = F.array_position(F.array(*map(F.lit, headers)), F.col("name")).cast("int") - 1 if headers else F.lit(0)
    table = placed.select("split", "opened", F.coalesce("begun", F.lit(-1).cast("bigint")).alias("begun"), F.coalesce(number, F.lit(-1)).alias("n")).toArrow()
    order = np.argsort(table.column("split").to_numpy())
    columns = [table.column(c).to_numpy()[order] for c in ("split", "opened", "begun", "n")]
    records = lines.mapInArrow(_cut(multi_line, *columns, False), "header int, record string")
    if multi_line:
        parts = lines.mapInArrow(_cut(multi_line, *columns, True), "header int, file string, begun bigint, block bigint, record string")
        pieces = F.transform(F.array_sort(F.collect_list(F.struct("block", "record"))), lambda p: p["record"])
        joined = parts.groupBy("header", "file", "begun").agg(F.array_join(pieces, "\n").alias("record"))
        records = records.unionByName(joined.select("header", F.regexp_replace("record", "\r$", "").alias("record")))
    return records, [header_names(h) for h in headers]
