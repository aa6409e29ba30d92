import random

import numpy as np
import pytest
import xxhash

from plumbline.llm import graph, near_texts, simhash


def fingerprint(text):
    words = [w for w in (text or "").encode().lower().split()]
    if not words:
        return 0
    shingles = [b" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))]
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def classes(prints):
    """doc -> smallest linked doc, from (doc, fingerprint) pairs."""
    root = {d: d for d, _ in prints}

    def find(d):
        while root[d] != d:
            d = root[d]
        return d

    for i, (a, x) in enumerate(prints):
        for b, y in prints[:i]:
            if (x ^ y).bit_count() <= 2:
                low, high = sorted((find(a), find(b)))
                root[high] = low
    return {d: find(d) for d, _ in prints}


def test_query_equals_brute_force(spark, folder, texts):
    rows = simhash.op5_simhash(spark, folder).collect()
    prints = [(d, fingerprint(t)) for d, t in sorted(texts.items())]
    assert {r["doc_id"]: r["fingerprint"] for r in rows} == {d: f"{p:016x}" for d, p in prints}
    assert {r["doc_id"]: r["component_id"] for r in rows} == classes(prints)


def clustered(n, seed):
    random.seed(seed)
    out = set()
    while len(out) < n:
        x = random.getrandbits(64)
        for _ in range(random.randint(1, 12)):
            out.add(x)
            for _ in range(random.randint(0, 3)):
                x ^= 1 << random.randrange(64)
    return sorted(out)[:n]


def rank(x):
    for s in (1, 2, 4, 8, 16, 32):
        x ^= x >> s
    return x


def test_gray_join_finds_all_links():
    for n in (2, 9, 70, 700):
        values = sorted(clustered(n, n), key=rank)
        links = simhash.gray_join(np.array(values, np.uint64), chunk=500)
        forest = [(i, v) for i, v in enumerate(values)]
        joined = simhash.Forest(n)
        joined.add(*(np.array([x[k] for x in links], np.int64) for k in (0, 1)))
        found = {i: joined.find(i) for i in range(n)}
        assert len({(found[i], c) for i, c in classes(forest).items()}) == len(set(found.values())) == len(set(classes(forest).values()))


@pytest.mark.parametrize("node_rows", [4, 4096])
def test_split_nodes_lose_no_link(spark, node_rows):
    center = 0x0123456789ABCDEF
    hot = [center ^ (1 << a) ^ (1 << b) for a in range(0, 24) for b in range(a)]
    values = sorted(set(clustered(150, 5) + hot))
    signed = np.array(values, np.uint64).view(np.int64).tolist()
    fps = spark.createDataFrame([(v,) for v in signed], "fp bigint")
    roots = {r["node"]: r["root"] for r in graph.components(simhash.links(fps, node_rows)).collect()}
    wanted = classes(list(enumerate(values)))
    got = {i: roots.get(v, ("own", v)) for i, v in enumerate(signed)}
    assert len({(wanted[i], got[i]) for i in got}) == len(set(wanted.values())) == len(set(got.values()))


def test_children_share_the_free_bits_out():
    above = {"": 0}
    for level in simhash.node_masks():
        for path, rows in level.items():
            own = [mask & ~above[path] for _, mask in rows]
            assert sum(m.bit_count() for m in own) == (own[0] | own[1] | own[2]).bit_count()
        above = dict(x for rows in level.values() for x in rows)
    final = [m for rows in simhash.node_masks()[-1].values() for _, m in rows]
    assert all(64 - m.bit_count() <= 14 for m in final)


def test_components_of_chains_and_stars(spark):
    edges = [(i, i + 1) for i in range(60)] + [(1000, 1000 + i) for i in range(1, 300)] + [(5, 5), (None, 3), (0, 1)]
    rows = graph.components(spark.createDataFrame(edges, "a bigint, b bigint")).collect()
    roots = {r["node"]: r["root"] for r in rows}
    assert len(rows) == len(roots) == 61 + 300
    assert len({roots[i] for i in range(61)}) == 1 and len({roots[1000 + i] for i in range(300)}) == 1 and roots[0] != roots[1000]
    assert graph.components(spark.createDataFrame([], "a bigint, b bigint")).count() == 0


def test_odd_documents(spark, odd, none):
    rows = simhash.near_duplicates(odd).collect()
    assert len(rows) == odd.count()
    found = {r["doc_id"]: r["component_id"] for r in rows}
    assert found[1] == found[2] == found[3] == 1 and found[4] == found[6] == 4 and found[5] == 5 and found[None] is None
    assert simhash.near_duplicates(none).count() == 0
    kept = near_texts.one_of_each(odd)
    assert kept.columns == odd.columns
    assert sorted(str(r["doc_id"]) for r in kept.collect()) == ["1", "4", "4", "5", "None"]
