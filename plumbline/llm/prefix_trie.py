"""A trie of conversation prefixes, with subtree totals by parallel tree contraction."""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from plumbline.llm.graph import landed
from plumbline.storage import run_folder

#: Conversations of one block of ids share the opening of the first.
BLOCK = 20
#: An opening has fewer turns than this.
OPENING = 4
#: Ids that one piece of a list of members holds.
PIECE_IDS = 4096

_KEY = ["k1", "k2", "k3"]
_ABOVE = ["p1", "p2", "p3"]


# ---- turns ----


def turn_digests(turns: DataFrame) -> DataFrame:
    """(conv_id, turn, a, b, words): half of the SHA-256 of each turn's role and text, and the words of its text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            digests, words = [], []
            for role, text in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist()):
                role, text = (role or "").encode("utf-8", "surrogatepass"), (text or "").encode("utf-8", "surrogatepass")
                digests.append(hashlib.sha256(b"%d:" % len(role) + role + text).digest()[:16])
                words.append(len(text.split()))
            lanes = np.frombuffer(b"".join(digests), "<i8").reshape(-1, 2)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), *(pa.array(np.ascontiguousarray(x)) for x in lanes.T), pa.array(words, pa.int64())],
                ["conv_id", "turn", "a", "b", "words"],
            )

    kind = turns.schema["turn"].dataType.simpleString()
    known = turns.select(F.col("conv_id").cast("bigint").alias("conv_id"), "turn", "role", "text").where("conv_id IS NOT NULL")
    return known.mapInArrow(run, f"conv_id bigint, turn {kind}, a bigint, b bigint, words bigint")


def _earlier(pieces: DataFrame, add: Callable[[str | Column], Column], columns: dict[str, str | Column]) -> DataFrame:
    """For each (conv_id, part): what the conversation's earlier parts have together; `columns` by name, added by `add`."""
    before = Window.partitionBy("conv_id").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    summed = pieces.groupBy("conv_id", "part").agg(*(add(c).alias(n) for n, c in columns.items()))
    return summed.select("conv_id", "part", *(F.coalesce(add(n).over(before), F.lit(0)).alias(n) for n in columns))


def placed_turns(turns: DataFrame, folder: str) -> DataFrame:
    """The digests with `at`, the place in the conversation from 0, and `part`.

    Turns are dealt out by ranges of (conv_id, turn, digest), so a long conversation lies in many parts; each part counts
    its own turns and adds those of the earlier parts.
    """
    order = [F.col("turn").asc_nulls_first(), F.col("a"), F.col("b")]
    dealt = turn_digests(turns).repartitionByRange("conv_id", *order).withColumn("part", F.spark_partition_id())
    dealt = landed(dealt, f"{folder}/turns.parquet")
    own = F.row_number().over(Window.partitionBy("conv_id", "part").orderBy(*order)).cast("bigint") - 1
    earlier = _earlier(dealt, F.sum, {"_before": F.lit(1)})
    placed = dealt.withColumn("_own", own).join(earlier, ["conv_id", "part"])
    return landed(
        placed.select("conv_id", "part", (F.col("_own") + F.col("_before")).alias("at"), "a", "b", "words"), f"{folder}/placed.parquet"
    )


def rebuilt(placed: DataFrame, folder: str, block: int = BLOCK, opening: int = OPENING) -> tuple[DataFrame, DataFrame]:
    """(conv_id, part, depth, a, b, words) of the turns of rebuilt conversations, and (conv_id) of all conversations.

    A conversation's first h turns, h = crc32(conv_id) % `opening`, give way to those of the first conversation of its
    block; that one's opening has at most `opening` - 1 turns, whatever its length.
    """
    first = (F.col("at") < opening - 1) & (F.pmod("conv_id", F.lit(block)) == 0)
    heads = placed.where(first).groupBy(F.col("conv_id").alias("base")).agg(
        F.sort_array(F.collect_list(F.struct("at", "a", "b", "words"))).alias("head")
    )
    ids = placed.select("conv_id").distinct()
    ids = ids.withColumns({"base": F.col("conv_id") - F.pmod("conv_id", F.lit(block)), "h": (F.crc32(F.col("conv_id").cast("string")) % opening).cast("int")})
    head = F.slice(F.coalesce("head", F.slice("none", 1, 0)), F.lit(1), F.col("h")).alias("head")
    none = F.array(F.struct(*(F.lit(0).cast("bigint").alias(c) for c in ("at", "a", "b", "words")))).alias("none")
    convs = ids.join(heads, "base", "left").select("conv_id", "h", "head", none).select("conv_id", "h", head)
    convs = landed(convs, f"{folder}/conversations.parquet")
    lent = convs.select("conv_id", F.posexplode("head").alias("i", "t")).select(
        "conv_id", F.lit(-1).alias("part"), (F.col("i") + 1).cast("bigint").alias("depth"), "t.a", "t.b", "t.words"
    )
    shift = convs.select("conv_id", "h", F.size("head").alias("m"))
    own = placed.join(shift, "conv_id").where("at >= h").select(
        "conv_id", "part", (F.col("at") - F.col("h") + F.col("m") + 1).alias("depth"), "a", "b", "words"
    )
    return own.unionByName(lent), convs.select("conv_id")


def prefixes(turns: DataFrame, convs: DataFrame, folder: str) -> DataFrame:
    """(conv_id, depth, k1, k2, k3, p1, p2, p3, words): the key of each prefix and of the prefix above.

    A key is the exclusive or of 3 x 64 bits of hash of each turn with its depth, so keys add up over parts of a long
    conversation; equal prefixes have equal keys, and others differ but for one in 2 ** 192.
    """
    lanes = {k: F.xxhash64(F.lit(n), "depth", "a", "b") for n, k in enumerate(("x1", "x2", "x3"))}
    hashed = landed(turns.withColumns(lanes), f"{folder}/rebuilt.parquet")
    inside = Window.partitionBy("conv_id", "part").orderBy("depth").rowsBetween(Window.unboundedPreceding, 0)
    earlier = _earlier(hashed, F.bit_xor, dict(zip(("e1", "e2", "e3"), lanes)))
    local = hashed.withColumns({k: F.bit_xor(x).over(inside) for k, x in zip(_KEY, lanes)}).join(earlier, ["conv_id", "part"])
    keyed = local.withColumns({k: F.col(k).bitwiseXOR(F.col(e)) for k, e in zip(_KEY, ("e1", "e2", "e3"))})
    above = [F.col(k).bitwiseXOR(F.col(x)).alias(p) for k, x, p in zip(_KEY, lanes, _ABOVE)]
    zero = F.lit(0).cast("bigint")
    roots = convs.select("conv_id", zero.alias("depth"), *(zero.alias(k) for k in _KEY), *(F.lit(None).cast("bigint").alias(p) for p in _ABOVE), zero.alias("words"))
    return landed(keyed.select("conv_id", "depth", *_KEY, *above, "words").unionByName(roots), f"{folder}/prefixes.parquet")


# ---- members ----


def member_lists(ends: DataFrame, key: list[str]) -> DataFrame:
    """(key, ends_sha256) of (key, conv_id): SHA-256 of the ids of each key in rising order, joined by commas.

    Ids are sorted over ranges of (key, id), so many tasks share a large key; they leave pieces of `PIECE_IDS` ids, and the
    task that hashes a key reads its pieces one by one.
    """
    n = len(key)
    kinds = ", ".join(f"{k} bigint" for k in key)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cols = [c.to_numpy() for c in batch.columns]
            if not len(cols[0]):
                continue
            new = np.append(True, np.any([c[1:] != c[:-1] for c in cols[:n]], axis=0))
            starts = np.flatnonzero(new)
            ends_ = np.append(starts[1:], len(new))
            cuts = [(s, min(s + PIECE_IDS, e)) for a, e in zip(starts.tolist(), ends_.tolist()) for s in range(a, e, PIECE_IDS)]
            at = np.array([s for s, _ in cuts])
            ids = cols[n].tolist()
            bodies = [",".join(map(str, ids[s:e])) for s, e in cuts]
            yield pa.RecordBatch.from_arrays([*(pa.array(c[at]) for c in cols), pa.array(bodies)], [*key, "first", "ids"])

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, sha = None, None
        for batch in batches:
            done = []
            for *own, _, ids in zip(*(c.to_pylist() for c in batch.columns)):
                if own != last:
                    if last is not None:
                        done.append((*last, sha.hexdigest()))
                    last, sha = own, hashlib.sha256(ids.encode())
                else:
                    sha.update(b"," + ids.encode())
            if done:
                yield _rows(done)
        if last is not None:
            yield _rows([(*last, sha.hexdigest())])

    def _rows(done):
        cols = list(zip(*done))
        return pa.RecordBatch.from_arrays([*(pa.array(c, pa.int64()) for c in cols[:n]), pa.array(cols[n])], [*key, "ends_sha256"])

    sorted_ids = ends.select(*key, "conv_id").repartitionByRange(*key, "conv_id").sortWithinPartitions(*key, "conv_id")
    pieces = sorted_ids.mapInArrow(cut, f"{kinds}, first bigint, ids string")
    return pieces.repartition(*key).sortWithinPartitions(*key, "first").mapInArrow(hashed, f"{kinds}, ends_sha256 string")


# ---- contraction ----


def subtree_totals(tree: DataFrame, measures: list[str], folder: str) -> DataFrame:
    """(node, measures): sums of each measure over a node and all below it.

    tree has node, up (null for roots), kids (number of children) and the measures. Rounds of rake and compress shrink it:
    rake adds all leaves to their parents and takes them away, with their totals final; compress takes away all nodes with
    one child, which point past their chain (found by doubling), with what the chain adds below them. Each round at least
    halves the tree, and a chain of n nodes takes log n joins, so depth does not count. At the end the rounds are run
    backwards, and each node of a chain gets its total from the chain's end.

    `node` must be unique. Every step is a join or an aggregate over written tables, which Spark can split when one node has
    most children. An empty tree gives no rows.
    """
    alive = landed(tree.select("node", "up", F.col("kids").cast("bigint").alias("kids"), *measures), f"{folder}/alive-0.parquet")
    add = lambda names, other: [(F.col(m) + F.coalesce(F.col(f"{other}_{m}"), F.lit(0))).alias(m) for m in names]
    summed = lambda df, by, other: df.groupBy(F.col(by).alias("node")).agg(
        F.count(F.lit(1)).alias(f"{other}_n"), *(F.sum(m).alias(f"{other}_{m}") for m in measures)
    )
    raked, chains, number = [], [], 0
    while True:
        number += 1
        leaves = alive.where("kids = 0")
        raked.append(leaves.select("node", *measures))
        fed = summed(leaves.where("up IS NOT NULL"), "up", "r")
        rest = alive.where("kids > 0").join(fed, "node", "left").select(
            "node", "up", (F.col("kids") - F.coalesce("r_n", F.lit(0))).alias("kids"), *add(measures, "r")
        )
        rest = landed(rest, f"{folder}/rest-{number}.parquet")
        left = rest.agg(F.count(F.lit(1)).alias("n"), F.count(F.when(F.col("kids") == 1, 1)).alias("unary")).first()
        if not left["n"]:
            break
        if not left["unary"]:
            alive = rest
            continue
        unary = rest.where("kids = 1")
        child = rest.where("up IS NOT NULL").select(F.col("up").alias("node"), F.col("node").alias("to"), (F.col("kids") == 1).alias("more"))
        above = unary.select(F.col("node").alias("up"), F.lit(True).alias("inner"))
        chain = unary.drop("kids").join(child, "node").join(above, "up", "left")
        chain = landed(chain.select("node", "up", "to", "more", F.col("inner").isNull().alias("top"), *measures), f"{folder}/chain-{number}-0.parquet")
        step = 0
        while not chain.where("more").isEmpty():
            step += 1
            on = chain.select(F.col("node").alias("to"), F.col("to").alias("past"), F.col("more").alias("on"), *(F.col(m).alias(f"c_{m}") for m in measures))
            chain = chain.join(on, "to", "left").select(
                "node", "up", F.coalesce("past", "to").alias("to"), F.coalesce("on", F.lit(False)).alias("more"), "top", *add(measures, "c")
            )
            chain = landed(chain, f"{folder}/chain-{number}-{step}.parquet")
        chains.append(chain.select("node", "to", *measures))
        tops = chain.where("top")
        over = tops.select(F.col("to").alias("node"), F.col("up").alias("over"), F.lit(True).alias("moved"))
        gains = summed(tops.where("up IS NOT NULL"), "up", "g")
        kept = rest.where("kids <> 1").join(over, "node", "left").join(gains, "node", "left").select(
            "node", F.when(F.col("moved"), F.col("over")).otherwise(F.col("up")).alias("up"), "kids", *add(measures, "g")
        )
        alive = landed(kept, f"{folder}/alive-{number}.parquet")
    known = reduce(DataFrame.unionByName, raked)
    for number, chain in reversed(list(enumerate(chains))):
        end = known.select(F.col("node").alias("to"), *(F.col(m).alias(f"c_{m}") for m in measures))
        back = landed(chain.join(end, "to").select("node", *add(measures, "c")), f"{folder}/back-{number}.parquet")
        known = known.unionByName(back)
    return known


# ---- operator ----


def prefix_trie(conversations: DataFrame, block: int = BLOCK, opening: int = OPENING) -> DataFrame:
    """One row per distinct prefix of rebuilt conversations, the empty one included.

    conversations has conv_id (whole numbers), turn, role and text; other columns are ignored. Turns are ordered by turn,
    null first; equal turn numbers stand in the order of a digest of role and text, repeated rows one after the other. Null
    roles and texts are empty; rows with a null conv_id belong to no conversation and go. An empty table gives no rows.
    """
    folder = run_folder(conversations.sparkSession, "trie")
    placed = placed_turns(conversations, folder)
    turns, convs = rebuilt(placed, folder, block, opening)
    rows = prefixes(turns, convs, folder)
    nodes = rows.groupBy("depth", *_KEY).agg(
        F.min("conv_id").alias("conv_id"), F.count(F.lit(1)).alias("n_convs"), F.max("words").alias("words"), *(F.max(p).alias(p) for p in _ABOVE)
    )
    nodes = landed(nodes, f"{folder}/nodes.parquet")
    above = nodes.select((F.col("depth") + 1).alias("depth"), *(F.col(k).alias(p) for k, p in zip(_KEY, _ABOVE)), F.col("conv_id").alias("parent_conv_id"))
    linked = landed(nodes.join(above, ["depth", *_ABOVE], "left"), f"{folder}/linked.parquet")
    kids = linked.where("depth > 0").groupBy(F.col("parent_conv_id").alias("conv_id"), (F.col("depth") - 1).alias("depth")).agg(F.count(F.lit(1)).alias("n_children"))
    counted = linked.join(kids, ["conv_id", "depth"], "left").withColumn("n_children", F.coalesce("n_children", F.lit(0)).cast("bigint"))
    counted = landed(counted, f"{folder}/counted.parquet")
    tree = counted.select(
        F.struct("conv_id", "depth").alias("node"),
        F.when(F.col("depth") > 0, F.struct(F.col("parent_conv_id").alias("conv_id"), (F.col("depth") - 1).alias("depth"))).alias("up"),
        F.col("n_children").alias("kids"),
        (F.col("n_children") == 0).cast("bigint").alias("n_leaves"),
        ((F.col("n_convs") - 1) * F.col("words")).alias("saved_tokens"),
    )
    totals = subtree_totals(tree, ["n_leaves", "saved_tokens"], f"{folder}/contraction")
    totals = totals.select("node.conv_id", "node.depth", "n_leaves", "saved_tokens")
    ends = rows.groupBy("conv_id").agg(F.max(F.struct("depth", *_KEY)).alias("end")).select("end.*", "conv_id")
    lists = member_lists(ends, ["depth", *_KEY])
    nothing = F.lit(hashlib.sha256(b"").hexdigest())
    joined = counted.join(totals, ["conv_id", "depth"]).join(lists, ["depth", *_KEY], "left")
    return joined.select(
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", F.coalesce("ends_sha256", nothing).alias("ends_sha256")
    )


def op11_prefix_trie(spark: SparkSession, folder: str) -> DataFrame:
    """The trie of all conversations after their openings are shared within blocks."""
    return prefix_trie(spark.read.parquet(f"{folder}/conversations.parquet"))
