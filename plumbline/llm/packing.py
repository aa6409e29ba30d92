"""Token sequences packed by Karmarkar-Karp differencing."""

from __future__ import annotations

import heapq
import json
from collections.abc import Iterator
from functools import cache
from operator import itemgetter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plumbline.llm.columns import released

CAPACITY = 2048
END_ID = 1
#: Windows that one differencing run fills, except at the end of a partition; bounds a task's memory.
BLOCK_WINDOWS = 64
#: What is left of a document after its full sequences is cut into pieces of at most this many ids.
PIECE = 256
#: Share of a block's windows that is left free, so that near-equal windows fit.
SLACK = 1 / 128
#: Words whose ids a worker keeps from one batch to the next.
CACHE_WORDS = 150_000
#: Bits of the sequence id that number the sequences of one partition.
SEQUENCE_BITS = 33


#: All white space but the space and the line feed.
OTHER_SPACE = "\t\x0b\x0c\r\x1c\x1d\x1e\x1f\x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"


#: What a tokenizer's file says if texts can be read word by word, and how it writes space and line feed.
WORDWISE = {
    "normalizer": None,
    "pre_tokenizer": {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": True},
    "truncation": None,
    "padding": None,
}
WORDWISE_MODEL = {"type": "BPE", "dropout": None, "continuing_subword_prefix": None, "end_of_word_suffix": None, "byte_fallback": False}
SEPARATORS = {" ": "\u0120", "\n": "\u010a"}


class Encoder:
    """The ids of a byte-level tokenizer, with the ids of words that come again kept.

    The tokenizer's pattern gives the last space before a word to that word, so no token reaches over a space that opens
    or closes a run of white space. A text whose white space is single spaces and line feeds is therefore the chain of
    its words, each with the space or line feed before it; a comma or stop after letters is a token of its own. All other
    texts, and those that name a special token, go to the tokenizer whole; so do all texts where the tokenizer's file
    names another normalizer, pattern or kind of model than `WORDWISE`.
    """

    def __init__(self, path: str, kept: int = CACHE_WORDS):
        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        self.by_words = all(spec.get(k) == v for k, v in WORDWISE.items()) and all(
            spec["model"].get(k) == v for k, v in WORDWISE_MODEL.items()
        )
        self.tokenizer = Tokenizer.from_file(path)
        if not self.by_words:
            return
        special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.whole = ["  ", "\n\n", " \n", "\n ", *OTHER_SPACE, *special]
        vocabulary = self.tokenizer.get_vocab(with_added_tokens=True)
        self.opens = {}  # by separator: the tokens that begin with it
        for mark, letter in SEPARATORS.items():
            self.opens[mark] = np.zeros(max(vocabulary.values()) + 1, bool)
            self.opens[mark][[i for token, i in vocabulary.items() if token[:1] == letter]] = True
        self.kept, self.ids = kept, {}
        self.ends = {x: self._encode([x])[0] for x in ",."}

    def _encode(self, texts: list[str]) -> list[bytes]:
        done = self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        return [np.array(x.ids, "<u4").tobytes() for x in done]

    def _spelt(self, words: list[str], mark: str) -> list[bytes]:
        """The ids of words, each behind a separator: they are read in rows, and cut where a token opens with it."""
        out: list[bytes] = []
        rows = [words[i : i + 1024] for i in range(0, len(words), 1024)]
        for row, ids in zip(rows, self._encode([mark + mark.join(row) for row in rows])):
            cuts = (4 * np.flatnonzero(self.opens[mark][np.frombuffer(ids, "<u4")])).tolist()
            if len(cuts) != len(row):
                raise ValueError("a token reaches over a separator")
            out += [ids[a:b] for a, b in zip(cuts, [*cuts[1:], len(ids)])]
        return out

    def _learn(self, words: set[str]) -> None:
        """Keep the ids of new words."""
        ends, known = self.ends, self.ids
        closed, lines, ends_of_text = [], [], []
        bare = set()
        for word in words:
            if word[-1:] in ends and word[:-1].isalpha():
                closed.append(word)
                if word[:-1] not in known:
                    bare.add(word[:-1])
            elif word[:1] != "\n":
                bare.add(word)
            else:
                (lines if len(word) > 1 else ends_of_text).append(word)
        spelt = list(bare)
        known.update(zip(spelt, self._spelt(spelt, " ")))
        known.update(zip(lines, self._spelt([w[1:] for w in lines], "\n")))
        known.update(zip(ends_of_text, self._encode(ends_of_text)))
        known.update((word, known[word[:-1]] + ends[word[-1]]) for word in closed)

    def __call__(self, texts: list[str]) -> list[bytes]:
        """The ids of each text as little-endian unsigned 32-bit numbers."""
        if not self.by_words:
            return self._encode(texts)
        whole = [i for i, t in enumerate(texts) if t.endswith(" ") or any(x in t for x in self.whole)]
        apart = set(whole)
        split = [[] if i in apart else t.replace("\n", " \n").split(" ") for i, t in enumerate(texts)]
        opening = [i for i, words in enumerate(split) if words]
        firsts = dict(zip(whole + opening, self._encode([texts[i] for i in whole] + [split[i][0] for i in opening])))
        tails = [words[1:] for words in split]
        if len(self.ids) > self.kept:
            self.ids.clear()
        new = set().union(*tails)
        new -= self.ids.keys()
        self._learn(new)
        keep = self.ids.__getitem__
        return [b"".join([firsts[i], *map(keep, words)]) for i, words in enumerate(tails)]


@cache
def encoder(path: str) -> Encoder:
    import os

    os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark runs one task per core
    return Encoder(path)


FIRST = itemgetter(0)


def difference(sizes: list[int], windows: int) -> list[list[int]]:
    """Karmarkar-Karp: the items of each of `windows` windows with near-equal sums.

    Every item starts as a partial partition with one filled window. The two partitions with the largest imbalance are
    merged, the fullest windows of one with the emptiest of the other, until one partition is left.
    """
    if not sizes:
        return [[] for _ in range(windows)]
    # A node is an item (>= 0) or a pair of nodes (< 0, into `pairs`); only filled windows of a partition are stored.
    pairs: list[tuple[int, int]] = []
    heap = [(-size, i, [(-size, i)]) for i, size in enumerate(sizes)]
    heapq.heapify(heap)
    order = len(sizes)
    while len(heap) > 1:
        a, b = heapq.heappop(heap)[2], heapq.heappop(heap)[2]
        if len(a) < len(b):
            a, b = b, a
        # (-sum, node) in rising order, empty windows last: the fullest of b meets the emptiest of a
        filled = len(a)
        width = min(windows, filled + len(b))
        empty = width - filled
        for at, (size, node) in zip(range(width - 1 - empty, -1, -1), b[empty:]):
            pairs.append((a[at][1], node))
            a[at] = (a[at][0] + size, -1 - len(pairs))
        a += b[:empty][::-1]
        a.sort(key=FIRST)
        heapq.heappush(heap, (a[0][0] - (a[-1][0] if width == windows else 0), order, a))
        order += 1
    out = []
    for _, node in heap[0][2]:
        items, todo = [], [node]
        while todo:
            x = todo.pop()
            if x >= 0:
                items.append(x)
            else:
                todo.extend(pairs[-2 - x])
        out.append(items)
    return out + [[] for _ in range(windows - len(out))]


def fill(sizes: list[int], capacity: int = CAPACITY) -> list[list[int]]:
    """Windows of at most `capacity`: the fewest that hold the sum, and more for as long as one would overflow."""
    if any(s > capacity for s in sizes):
        raise ValueError("an item is larger than a window")
    windows = -(-sum(sizes) // capacity)
    while True:
        found = difference(sizes, windows)
        if all(sum(sizes[i] for i in w) <= capacity for w in found):
            return [w for w in found if w]
        windows += 1


def pack(
    docs: DataFrame,
    tokenizer: str,
    doc_id: str = "doc_id",
    text: str = "text",
    capacity: int = CAPACITY,
    end_id: int = END_ID,
    block_windows: int = BLOCK_WINDOWS,
) -> DataFrame:
    """One row per piece: doc_id, start, length, ids (binary, 32-bit little-endian), doc_tokens, sequence_id, offset.

    A document's ids and `end_id` are cut at multiples of `capacity`. Full pieces are sequences of their own. The rest of
    each document, in pieces of at most `PIECE` ids, waits until it fills `block_windows` windows but for `SLACK`, and is
    packed by differencing: a task holds one block, and nothing is shuffled. Padding is about `SLACK`, and less than a
    window more at the end of a partition. Pieces lie in a sequence without gaps from 0. Null and empty texts are the end id alone; repeated ids are packed as rows of their own;
    an empty table gives no rows; other columns are ignored.
    """
    kind = docs.schema[doc_id].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        encode = encoder(tokenizer)
        end = np.array([end_id], "<u4").tobytes()
        number = TaskContext.get().partitionId() << SEQUENCE_BITS
        waiting: list[tuple] = []  # (doc, start, ids, doc_tokens)
        held = 0
        full = int(block_windows * capacity * (1 - SLACK)) - PIECE
        names = ["doc_id", "start", "length", "ids", "doc_tokens", "sequence_id", "offset"]

        def rows(placed, ids_type):
            cols = list(zip(*placed))
            return pa.RecordBatch.from_arrays(
                [pa.array(cols[0], ids_type), *(pa.array(c, pa.int64()) for c in cols[1:3]), pa.array(cols[3], pa.binary()), *(pa.array(c, pa.int64()) for c in cols[4:])],
                names,
            )

        def settle(ids_type):
            nonlocal number
            placed = []
            for window in fill([len(w[2]) // 4 for w in waiting], capacity):
                offset = 0
                for i in window:
                    doc, start, ids, total = waiting[i]
                    placed.append((doc, start, len(ids) // 4, ids, total, number, offset))
                    offset += len(ids) // 4
                number += 1
            waiting.clear()
            return rows(placed, ids_type)

        ids_type = None
        for batch in batches:
            ids_type = batch.schema.field(0).type
            for low in range(0, batch.num_rows, 256):
                part = batch.slice(low, 256)
                placed = []
                for doc, ids in zip(part.column(0).to_pylist(), encode([t or "" for t in part.column(1).to_pylist()])):
                    ids += end
                    total, step = len(ids) // 4, 4 * capacity
                    for at in range(0, len(ids), step):
                        piece = ids[at : at + step]
                        if len(piece) == step:
                            placed.append((doc, at // 4, capacity, piece, total, number, 0))
                            number += 1
                            continue
                        for low_at in range(0, len(piece), 4 * PIECE):
                            waiting.append((doc, (at + low_at) // 4, piece[low_at : low_at + 4 * PIECE], total))
                            held += len(waiting[-1][2]) // 4
                            if held >= full:
                                yield settle(ids_type)
                                held = 0
                if placed:
                    yield rows(placed, ids_type)
        if waiting:
            yield settle(ids_type)

    schema = f"doc_id {kind}, start bigint, length bigint, ids binary, doc_tokens bigint, sequence_id bigint, offset bigint"
    return docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text")).mapInArrow(released(run), schema)


def digests(pieces: DataFrame) -> DataFrame:
    """The pieces with ids_crc32 in place of the ids."""
    return pieces.select(
        "doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset"
    )


def op2_packing(spark, folder: str) -> DataFrame:
    """All documents packed into sequences of 2,048 ids."""
    import public_tokenizers

    docs = spark.read.parquet(f"{folder}/documents.parquet")
    return digests(pack(docs, public_tokenizers.path("byte_bpe_50k.json")))
