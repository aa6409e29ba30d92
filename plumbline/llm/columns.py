"""What workers hold of a table: names of columns, parts of batches, values of words."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame

#: Texts that a worker holds as Python objects at a time.
TEXTS = 256


def set_aside(df: DataFrame, reserved: list[str]) -> tuple[DataFrame, dict[str, str]]:
    """df with columns of reserved names under free ones, and the names to give back afterwards (`withColumnsRenamed`).

    Names are compared without regard to case, as Spark does.
    """
    taken = {c.lower() for c in df.columns} | {r.lower() for r in reserved}
    low = {r.lower() for r in reserved}
    there = {}
    for column in df.columns:
        if column.lower() in low:
            free = f"{column}_"
            while free.lower() in taken:
                free += "_"
            taken.add(free.lower())
            there[column] = free
    return df.withColumnsRenamed(there), {free: column for column, free in there.items()}


def parts_of(batches: Iterator[pa.RecordBatch], rows: int = TEXTS) -> Iterator[pa.RecordBatch]:
    """The rows in batches of at most `rows`; a worker's lists and strings are those of one of them."""
    for batch in batches:
        for low in range(0, batch.num_rows, rows):
            yield batch.slice(low, rows)


def released(run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]) -> Callable:
    """run; after it the memory of its batches goes back to the system, as the worker stays for tasks of other stages."""

    def done(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from run(batches)
        pa.default_memory_pool().release_unused()

    return done


class Lately:
    """Values of the words that were met lately, about `most` of them and those of one call.

    `now` takes new words; when it has half of `most`, it becomes `before`, from which only words that are met again come back.
    Frequent words so keep their values, and the many that stand in one text only go.
    """

    def __init__(self, most: int):
        self.half, self.now, self.before = most // 2, {}, {}

    def __len__(self) -> int:
        return len(self.now) + len(self.before)

    def make_room(self) -> None:
        if len(self.now) > self.half:
            self.before, self.now = self.now, {}

    def missing(self, words: set[str]) -> set[str]:
        """Those of the words that have no value; the others are in `now`."""
        new = words.difference(self.now)
        again = new.intersection(self.before)
        self.now.update((word, self.before[word]) for word in again)
        return new - again
