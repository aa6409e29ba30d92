import hashlib
import random
import re
import zlib
from collections import defaultdict

from pyspark.sql import functions as F

from plumbline.llm import prefix_trie

COLUMNS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def brute(rows):
    convs = defaultdict(list)
    for conv_id, turn, role, text in rows:
        if conv_id is not None:
            convs[conv_id].append((turn is not None, turn or 0, role or "", text or ""))
    convs = {c: [t[2:] for t in sorted(v)] for c, v in convs.items()}
    built = {}
    for c, own in convs.items():
        h = zlib.crc32(str(c).encode()) % 4
        built[c] = tuple(convs.get(c - c % 20, [])[:h] + own[h:])
    members, ends = defaultdict(set), defaultdict(list)
    for c, turns in built.items():
        for d in range(len(turns) + 1):
            members[turns[:d]].add(c)
        ends[turns].append(c)
    below = defaultdict(set)
    for p in members:
        if p:
            below[p[:-1]].add(p)
    out, totals = set(), {}
    for p in sorted(members, key=len, reverse=True):
        words = len(re.findall("[^\x20\x09-\x0d]+", p[-1][1])) if p else 0
        leaves, saved = sum(totals[b][0] for b in below[p]) or 1, sum(totals[b][1] for b in below[p])
        totals[p] = (leaves, saved + (len(members[p]) - 1) * words)
        sha = hashlib.sha256(",".join(map(str, sorted(ends[p]))).encode()).hexdigest()
        out.add((min(members[p]), len(p), min(members[p[:-1]]) if p else None, len(members[p]), len(below[p]), *totals[p], sha))
    return out


def found(df):
    assert df.columns == COLUMNS
    rows = [tuple(r) for r in df.collect()]
    assert len(rows) == len(set(rows))
    return set(rows)


def test_whole_table_against_brute_force(spark):
    from plumbline.llm.catalog import QUERIES

    folder = "/root/testdata/sf0.01"
    rows = [tuple(r) for r in spark.read.parquet(f"{folder}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    df = QUERIES["op11_prefix_trie"](spark, folder)
    assert {k for n, k in df.dtypes if n != "ends_sha256"} == {"bigint"}
    assert found(df) == brute(rows)


def test_shared_openings_long_and_hot_conversations(spark):
    rnd = random.Random(2)
    rows = [(c, t, rnd.choice(["user", "assistant"]), rnd.choice(["a", "a b", "c d\te"])) for c in range(60) for t in range(rnd.randint(1, 6))]
    rows += [(c, t, "user", "same words here") for c in range(100, 180) for t in range(3)]  # copies
    rows += [(200, t, "user", f"turn {t // 7}") for t in range(400)] + [(220, t, "user", f"turn {t // 7}") for t in range(333)]  # long ones
    rows += [(c, None, None, None) for c in (301, 302, 303)] + [(311, 0, "user", None), (320, 5, None, "late"), (321, -1, "user", "x")]
    rows += [(340, 1, "user", "b"), (340, 1, "user", "b"), (None, 1, "user", "nobody's"), (2**40, 0, "system", "far")]
    rnd.shuffle(rows)
    df = spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string").repartition(5)
    df = df.withColumn("part", F.lit("clash")).withColumn("depth", F.lit(9)).withColumn("node", F.lit(None))
    assert found(prefix_trie.prefix_trie(df)) == brute(rows)


def test_ties_have_one_order(spark):
    rows = [(1, 1, "user", x) for x in "abc"] + [(1, None, "user", "first")]
    schema = "conv_id bigint, turn bigint, role string, text string"
    one = found(prefix_trie.prefix_trie(spark.createDataFrame(rows, schema)))
    assert one == found(prefix_trie.prefix_trie(spark.createDataFrame(rows[::-1], schema).repartition(3)))
    assert prefix_trie.prefix_trie(spark.createDataFrame([], schema)).count() == 0


def test_contraction_of_any_tree(spark):
    from plumbline.storage import run_folder

    rnd = random.Random(4)
    for shape in ("random", "chain", "star", "broom"):
        up = {0: None}
        for i in range(1, 120):
            up[i] = {"random": rnd.randrange(max(0, i - 12), i), "chain": i - 1, "star": 0, "broom": i - 1 if i < 60 else 59}[shape]
        kids = defaultdict(int)
        for p in up.values():
            kids[p] += 1
        value = {i: rnd.randint(-5, 50) for i in up}
        total = dict(value)
        for i in sorted(up, reverse=True):
            if up[i] is not None:
                total[up[i]] += total[i]
        tree = spark.createDataFrame([(i, up[i], kids[i], value[i]) for i in up], "node bigint, up bigint, kids bigint, v bigint")
        sums = prefix_trie.subtree_totals(tree, ["v"], run_folder(spark, "tree"))
        assert dict(sums.collect()) == total
