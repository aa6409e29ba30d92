"""Near-duplicates by SimHash fingerprints, joined through hierarchical indexes in Gray order."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plumbline.llm.graph import components
from plumbline.storage import checkpointed

BITS = 64
DISTANCE = 2
SHINGLE = 3
SEED = 42
#: A node of the index with more fingerprints than this is split by further masked bits.
NODE_ROWS = 4096
#: Bits by which one level of the distributed index narrows what the levels above left free; after the last, a node
#: has at most 2 ** 14 fingerprints.
LEVELS = ((22, 21, 21), (14, 14, 14), (9, 9, 10), (6, 6, 6))
FAN = 8
ONES = np.uint64(0x0101010101010101)
#: The further columns of a node to a cost of pairs of its positions; a pair with an infinite cost is none.
Cost = Callable[..., np.ndarray]


# ---- fingerprints ----


def bit_counts(hashes: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """How many hashes of each run have each bit set; runs begin at `starts` and none is empty."""
    n = len(hashes)
    cuts = np.unique(np.concatenate([starts, np.arange(0, n, 255)]))  # a byte counts to 255
    lanes = np.empty((len(cuts), BITS), np.uint8)
    for bit in range(8):
        sums = np.add.reduceat((hashes >> np.uint64(bit)) & ONES, cuts)
        lanes[:, bit::8] = sums.view(np.uint8).reshape(-1, 8)
    return np.add.reduceat(lanes, np.searchsorted(cuts, starts), axis=0, dtype=np.int64)


def fold_bits(counts: np.ndarray, totals: np.ndarray) -> np.ndarray:
    """A bit is 1 where it is set in over half of the hashes."""
    return np.packbits(2 * counts > totals[:, None], axis=1, bitorder="little").view(np.uint64).ravel()


def text_fingerprints(texts: list[str | None], k: int = SHINGLE, chunk: int = 200_000) -> np.ndarray:
    out = np.zeros(len(texts), np.uint64)
    hashes: list[np.ndarray] = []
    rows: list[int] = []
    held = 0

    def settle():
        nonlocal held
        if rows:
            sizes = np.array([len(h) for h in hashes])
            starts = np.concatenate([[0], np.cumsum(sizes)[:-1]])
            out[rows] = fold_bits(bit_counts(np.concatenate(hashes), starts), sizes)
        hashes.clear(), rows.clear()
        held = 0

    for row, text in enumerate(texts):
        words = (text or "").encode("utf-8", "surrogatepass").lower().split()
        if not words:
            continue
        shingles = map(b" ".join, zip(*(words[i:] for i in range(k)))) if len(words) >= k else [b" ".join(words)]
        n = max(1, len(words) - k + 1)
        hashes.append(np.fromiter(map(xxhash.xxh64_intdigest, shingles, repeat(SEED)), np.uint64, n))
        rows.append(row)
        held += n
        if held >= chunk:
            settle()
    settle()
    return out


def fingerprints(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", shingle: int = SHINGLE) -> DataFrame:
    """(doc_id, fp): the fingerprint of the whole text as a signed long.

    A-Z are lowered, words end at space and \\x09-\\x0D, shingles have `shingle` words; shorter texts are one shingle. A null
    text, an empty text and one of white space only have fingerprint zero.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = text_fingerprints(batch.column(1).to_pylist(), shingle)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found.view(np.int64))], ["doc_id", "fp"])

    kind = docs.schema[doc_id].dataType.simpleString()
    return docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text")).mapInArrow(run, f"doc_id {kind}, fp bigint")


# ---- index ----


def gray_rank(x: Column) -> Column:
    """The place of a fingerprint in the reflected Gray code."""
    for shift in (1, 2, 4, 8, 16, 32):
        x = x.bitwiseXOR(F.shiftrightunsigned(x, shift))
    return x


def _children(free: int, widths: tuple[int, ...]) -> list[int]:
    """Masks of the given numbers of bits that cut `free` in three, from the top."""
    bits = [b for b in range(BITS - 1, -1, -1) if free >> b & 1]
    out, at = [], 0
    for width in widths:
        out.append(sum(1 << b for b in bits[at : at + width]))
        at += width
    return out


def node_masks(distance: int = DISTANCE) -> list[dict[str, list[tuple[str, int]]]]:
    """For each level: the masks of the nodes by the path of the node above.

    Two fingerprints with at most two differing bits agree on one of three disjoint masks, and so at each level below. For
    n bits there are n + 1 masks, and two levels.
    """
    levels, above = [], {"": 0}
    for depth in range(len(LEVELS) if distance == DISTANCE else 2):
        level = {}
        for path, mask in above.items():
            free = ~mask & (2**BITS - 1)
            share, more = divmod(free.bit_count(), distance + 1)
            widths = LEVELS[depth] if distance == DISTANCE else tuple(share + (i < more) for i in range(distance + 1))
            level[path] = [(f"{path}{i:x}", mask | m) for i, m in enumerate(_children(free, widths))]
        levels.append(level)
        above = dict(x for row in level.values() for x in row)
    return levels


def _signed(x: int) -> int:
    return x - 2**BITS if x >> (BITS - 1) else x


class Forest:
    """Classes of positions; keeps only links that join two classes."""

    def __init__(self, n: int):
        self.root = np.arange(n)
        self.links: list[tuple[int, int]] = []

    def find(self, i: int) -> int:
        root = self.root
        while root[i] != i:
            root[i] = root[root[i]]
            i = root[i]
        return int(i)

    def add(self, a: np.ndarray, b: np.ndarray) -> None:
        top = self.root
        while True:  # flat roots let most pairs go in one step
            flat = top[top]
            if np.array_equal(flat, top):
                break
            top[:] = flat
        keep = top[a] != top[b]
        for x, y in zip(a[keep].tolist(), b[keep].tolist()):
            rx, ry = self.find(x), self.find(y)
            if rx != ry:
                self.root[max(rx, ry)] = min(rx, ry)
                self.links.append((x, y))


def near_pairs(
    fps: np.ndarray,
    distance: int = DISTANCE,
    chunk: int = 100_000,
    classes: np.ndarray | None = None,
    cost: Callable[[np.ndarray, np.ndarray], np.ndarray] | None = None,
) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Positions of linked fingerprints, all pairs, some at a time; `fps` are in Gray order. Pairs inside a class are left out.

    Eight neighbours share a node one level up, which holds the bits on which all of them agree. Two nodes that differ
    in more than `distance` of their common agreed bits have no links below them, so the whole pair of groups goes; so
    does a pair of nodes that have one class only. With a cost, pairs of infinite cost are left out and the cheapest of those
    yielded together come first.
    """
    full = np.uint64(2**BITS - 1)
    levels = [(fps, np.full(len(fps), full))]
    ends = [(classes, classes)]
    while len(levels[-1][0]) > FAN:
        bits, masks = levels[-1]
        starts = np.arange(0, len(bits), FAN)
        first = np.repeat(bits[starts], np.diff(np.append(starts, len(bits))))
        differs = np.bitwise_or.reduceat((bits ^ first) & masks, starts)
        masks = np.bitwise_and.reduceat(masks, starts) & ~differs
        levels.append((bits[starts] & masks, masks))
        if classes is not None:
            ends.append((np.minimum.reduceat(ends[-1][0], starts), np.maximum.reduceat(ends[-1][1], starts)))
    top = len(levels[-1][0])
    a, b = np.triu_indices(top)
    work = [(len(levels) - 1, a, b)]
    inside = np.arange(FAN)
    while work:
        level, a, b = work.pop()
        if len(a) > chunk:
            work += [(level, a[i : i + chunk], b[i : i + chunk]) for i in range(0, len(a), chunk)]
            continue
        bits, masks = levels[level]
        near = np.bitwise_count((bits[a] ^ bits[b]) & masks[a] & masks[b]) <= distance
        if classes is not None:
            low, high = ends[level]
            near &= np.minimum(low[a], low[b]) != np.maximum(high[a], high[b])
        a, b = a[near], b[near]
        if level == 0:
            apart = a != b
            a, b = a[apart], b[apart]
            if cost is not None:
                price = cost(a, b)
                order = np.argsort(price, kind="stable")[: np.count_nonzero(np.isfinite(price))]
                a, b = a[order], b[order]
            yield a, b
            continue
        below = len(levels[level - 1][0])
        left = (a[:, None, None] * FAN + inside[:, None] + 0 * inside).reshape(-1)
        right = (b[:, None, None] * FAN + inside + 0 * inside[:, None]).reshape(-1)
        keep = (left < below) & (right < below) & (left <= right)
        if keep.any():
            work.append((level - 1, left[keep], right[keep]))


def gray_join(
    fps: np.ndarray,
    distance: int = DISTANCE,
    chunk: int = 100_000,
    cost: Callable[[np.ndarray, np.ndarray], np.ndarray] | None = None,
) -> list[tuple[int, int]]:
    """Positions of linked fingerprints, as a spanning forest of the links; see `near_pairs`."""
    forest = Forest(len(fps))
    for a, b in near_pairs(fps, distance, chunk, cost=cost):
        forest.add(a, b)
    return forest.links


def _chunk(distance: int) -> int:
    return 100_000 if distance == DISTANCE else 10_000  # wide searches prune little, so a chunk grows to 64 times its pairs


def _whole_nodes(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, ...]]:
    """The columns behind node and pattern of each node with two rows or more; rows are sorted by node and pattern.

    A node that goes on in the next batch waits for it.
    """
    held: tuple[np.ndarray, ...] | None = None
    for batch in batches:
        rows = (np.array(batch.column(0).to_pylist(), dtype=object), *(c.to_numpy() for c in batch.columns[1:]))
        if held is not None:
            rows = tuple(np.concatenate(x) for x in zip(held, rows))
        node, pattern = rows[:2]
        if not len(node):
            continue
        cut = np.flatnonzero((node[1:] != node[:-1]) | (pattern[1:] != pattern[:-1])) + 1
        for s, e in zip([0, *cut.tolist()], cut.tolist()):
            if e - s > 1:
                yield tuple(x[s:e] for x in rows[2:])
        held = tuple(x[cut[-1] if len(cut) else 0 :] for x in rows)
    if held is not None and len(held[0]) > 1:
        yield held[2:]


def _node_pairs(batches: Iterator[pa.RecordBatch], distance: int, cost: Cost | None = None) -> Iterator[pa.RecordBatch]:
    """(a, b): all pairs of documents of different classes in one node, by (path, pattern, fp, doc, class, what the cost takes)."""
    for fps, docs, classes, *more in _whole_nodes(batches):
        for a, b in near_pairs(fps.view(np.uint64), distance, _chunk(distance), classes, cost and cost(*more)):
            if not len(a):
                continue
            x, y = docs[a], docs[b]
            yield pa.RecordBatch.from_arrays([pa.array(np.minimum(x, y)), pa.array(np.maximum(x, y))], ["a", "b"])


def _node_links(batches: Iterator[pa.RecordBatch], distance: int = DISTANCE, cost: Cost | None = None) -> Iterator[pa.RecordBatch]:
    """Rows (path, pattern, fp, what the cost takes) sorted by node and Gray rank; a node that goes on in the next batch waits for it."""
    held: tuple[np.ndarray, ...] | None = None
    chunk = _chunk(distance)

    def linked(node, pattern, fps, *more):
        cut = np.flatnonzero((node[1:] != node[:-1]) | (pattern[1:] != pattern[:-1])) + 1
        starts = np.concatenate([[0], cut])
        ends = np.append(cut, len(fps))
        a, b = [], []
        for s, e in zip(starts[ends - starts > 1].tolist(), ends[ends - starts > 1].tolist()):
            for x, y in gray_join(fps[s:e], distance, chunk, cost and cost(*(c[s:e] for c in more))):
                a.append(s + x), b.append(s + y)
        return pa.RecordBatch.from_arrays(
            [pa.array(fps[a].view(np.int64)), pa.array(fps[b].view(np.int64))], ["a", "b"]
        ) if a else None

    for batch in batches:
        rows = (
            np.array(batch.column(0).to_pylist(), dtype=object),
            batch.column(1).to_numpy(),
            batch.column(2).to_numpy().view(np.uint64),
            *(c.to_numpy() for c in batch.columns[3:]),
        )
        if held is not None:
            rows = tuple(np.concatenate(x) for x in zip(held, rows))
        node, pattern, fps = rows[:3]
        if not len(fps):
            continue
        changes = np.flatnonzero((node[1:] != node[:-1]) | (pattern[1:] != pattern[:-1]))
        last = int(changes[-1]) + 1 if len(changes) else 0
        if last and (out := linked(*(x[:last] for x in rows))) is not None:
            yield out
        held = tuple(x[last:] for x in rows)
    if held is not None and len(held[2]) and (out := linked(*held)) is not None:
        yield out


def _in_nodes(fps: DataFrame, node_rows: int, distance: int) -> DataFrame:
    """(path, pattern, fp and the other columns of fps) sorted by node and Gray rank, each node in one task.

    Three masks of about 21 bits are the top nodes. Nodes with more than `node_rows` members are split by masks over
    their free bits, three children each, until they fit or few bits are free; so no task gathers more than that of one
    node, and no link is lost.
    """
    own_columns = ["fp", *(c for c in fps.columns if c != "fp")]
    placed = fps.select(F.lit("").alias("path"), *own_columns)
    kept = []
    masks = node_masks(distance)
    for depth, level in enumerate(masks):
        child = F.lit(None)
        for path, rows in level.items():
            own = F.array(*(
                F.struct(F.lit(p).alias("path"), F.col("fp").bitwiseAND(F.lit(_signed(m))).alias("pattern"))
                for p, m in rows
            ))
            child = own if path == "" else F.when(F.col("path") == path, own).otherwise(child)
        nodes = placed.select(F.explode(child).alias("n"), *own_columns).select("n.path", "n.pattern", *own_columns)
        if depth == len(masks) - 1:
            kept.append(nodes)
            break
        full = checkpointed(nodes.groupBy("path", "pattern").count().where(F.col("count") > node_rows).select("path", "pattern"))
        if full.isEmpty():
            kept.append(nodes)
            break
        kept.append(nodes.join(full, ["path", "pattern"], "left_anti"))
        placed = checkpointed(nodes.join(full, ["path", "pattern"], "left_semi").select("path", *own_columns))
    nodes = kept[0]
    for more in kept[1:]:
        nodes = nodes.union(more)
    ordered = nodes.repartition("path", "pattern").sortWithinPartitions("path", "pattern", gray_rank(F.col("fp")))
    return ordered.select("path", "pattern", *own_columns)


def links(fps: DataFrame, node_rows: int = NODE_ROWS, distance: int = DISTANCE, cost: Cost | None = None) -> DataFrame:
    """Distinct fingerprints (fp) to links (a, b) that connect all pairs with at most `distance` differing bits.

    Inside a node (see `_in_nodes`) the members are in Gray order and joined by `gray_join`. A cost takes the other columns of fps, and
    pairs of infinite cost are not linked.
    """
    nodes = _in_nodes(fps if cost else fps.select("fp"), node_rows, distance)
    return nodes.mapInArrow(lambda batches: _node_links(batches, distance, cost), "a bigint, b bigint")


def pairs_between(texts: DataFrame, node_rows: int = NODE_ROWS, distance: int = DISTANCE, cost: Cost | None = None) -> DataFrame:
    """(fp, doc, class), all longs, to each pair (a, b) of documents of different classes with at most `distance` differing bits.

    A cost takes the other columns of texts, and pairs of infinite cost are left out.
    """
    own = ["fp", "doc", "class"]
    nodes = _in_nodes(texts.select(*own, *(c for c in texts.columns if cost and c not in own)), node_rows, distance)
    return nodes.mapInArrow(lambda batches: _node_pairs(batches, distance, cost), "a bigint, b bigint").distinct()


# ---- operator ----


def near_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", node_rows: int = NODE_ROWS) -> DataFrame:
    """(doc_id, fp, component_id) for every row: documents linked by fingerprints at two or fewer differing bits.

    The component id is the smallest id that links reach. Equal fingerprints are merged before anything is paired, so a
    group of copies costs one entry. Repeated ids keep their rows; rows with a null id take part and come back with the
    component's smallest id, null only if no member has one. An empty table gives no rows. Other columns are ignored.
    """
    found = checkpointed(fingerprints(docs, doc_id, text))
    distinct = checkpointed(found.groupBy("fp").agg(F.min("doc_id").alias("first")))
    parts = components(links(distinct.select("fp"), node_rows)).withColumnRenamed("node", "fp")
    placed = distinct.join(parts, "fp", "left")
    named = placed.where("root IS NOT NULL").groupBy("root").agg(F.min("first").alias("component_id"))
    by_print = placed.join(named, "root", "left").select("fp", F.coalesce("component_id", "first").alias("component_id"))
    return found.join(by_print, "fp").select("doc_id", "fp", "component_id")


def op5_simhash(spark, folder: str) -> DataFrame:
    """Fingerprint and component of every document."""
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    return near_duplicates(docs).select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"
    )
