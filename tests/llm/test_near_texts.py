import random
from itertools import combinations

import numpy as np

from plumbline.llm import near_texts


def brute_shingles(text):
    words = (text or "").split()
    return {" ".join(words[i : i + 5]).lower() for i in range(max(1, len(words) - 4))} if words else set()


def index(a, b):
    return len(a & b) / len(a | b) if a | b else 1.0


def near_pairs(texts):
    sets = {i: brute_shingles(t) for i, t in texts.items()}
    return [(i, j) for i, j in combinations(sorted(texts), 2) if index(sets[i], sets[j]) >= 0.8]


def edited(rnd, words, n):
    out = list(words)
    for i in rnd.sample(range(len(out)), n):
        out[i] = f"new{rnd.randrange(10**6)}"
    return out


def groups_left(spark, texts):
    df = spark.createDataFrame([(i, t, 0, "x") for i, t in texts.items()], "doc_id bigint, text string, fp int, mark string")
    kept = near_texts.one_of_each(df)
    assert kept.columns == df.columns
    return {r["doc_id"] for r in kept.collect()}


def test_near_copies_at_the_threshold_are_found(spark):
    rnd = random.Random(3)
    texts = {}
    for g in range(150):
        words = [f"w{int(rnd.paretovariate(0.6))}" for _ in range(rnd.choice([90, 150, 300]))]
        texts[10 * g] = " ".join(words)
        for k in (1, 2):
            texts[10 * g + k] = " ".join(edited(rnd, words, max(1, len(words) // rnd.choice([50, 80, 120]))))
    pairs = near_pairs(texts)
    kept = groups_left(spark, texts)
    later = {j for i, j in pairs}
    assert len(later) > 200
    assert len(later - kept) >= 0.9 * len(later)  # recall
    assert set(texts) - kept <= later  # nothing else goes


def test_a_large_group_and_unlike_texts(spark):
    rnd = random.Random(4)
    words = [f"w{rnd.randrange(500)}" for _ in range(200)]
    texts = {i: " ".join(edited(rnd, words, 2)) for i in range(300)}
    texts |= {1000 + i: " ".join(f"v{rnd.randrange(10**6)}" for _ in range(60)) for i in range(40)}
    kept = groups_left(spark, texts)
    assert {i for i in kept if i >= 1000} == {i for i in texts if i >= 1000}
    assert 0 in kept and len([i for i in kept if i < 1000]) <= 3


def test_documents_of_the_tables(spark):
    rows = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text").collect()
    texts = {r["doc_id"]: r["text"] for r in rows}
    pairs = near_pairs(texts)
    kept = groups_left(spark, texts)
    later = {j for _, j in pairs}
    assert len(later - kept) >= 0.9 * len(later) and set(texts) - kept <= later


def test_odd_documents(spark, odd, none):
    kept = sorted((r["doc_id"] is None, r["doc_id"] or 0) for r in near_texts.one_of_each(odd).collect())
    assert kept == [(False, 1), (False, 4), (False, 4), (False, 5), (True, 0)]  # 2 and 3 are empty like 1; 6 is a copy of 4
    assert near_texts.one_of_each(none).count() == 0


def test_links_are_kept_where_the_forest_has_a_link_that_fails(spark):
    rnd = random.Random(4)
    rounds = [f"hub a{i} b{i}" for i in range(60)]
    first = " ".join(rounds + ["hub"])
    rnd.shuffle(rounds)
    second = " ".join(rounds + ["hub"])  # the same pairs of words, other passages
    third = second + " hub"
    one, two, three = map(near_texts.shingle_hashes, (first, second, third))
    assert near_texts.jaccard(one, two) < 0.8 <= near_texts.jaccard(two, three)
    docs = spark.createDataFrame([(1, first), (2, second), (3, third)], "doc_id bigint, text string")
    assert sorted(r["doc_id"] for r in near_texts.one_of_each(docs).collect()) == [1, 2]


def test_pairs_that_cannot_be_near_copies_are_not_made(spark, tmp_path, monkeypatch):
    """Texts of one fingerprint whose passages differ: the pairs grew with the square of their number."""
    rnd = random.Random(5)
    rounds = [f"hub a{i} b{i}" for i in range(60)]
    texts = {}
    for i in range(100):
        rnd.shuffle(rounds)
        texts[10 * i] = " ".join(rounds + ["hub"])
        texts[10 * i + 1] = texts[10 * i] + " hub"
    monkeypatch.setattr(near_texts, "run_folder", lambda spark, label: str(tmp_path))
    assert groups_left(spark, texts) == {10 * i for i in range(100)}
    made = {name: spark.read.parquet(f"{tmp_path}/{name}.parquet").count() for name in ("close", "wide", "rest")}
    assert sum(made.values()) <= 4 * len(texts)


def test_sketches_never_rule_out_near_copies():
    rnd = np.random.default_rng(6)
    sets, ruled_out = [np.zeros(0, np.uint64), np.zeros(0, np.uint64)], 0
    for size in (1, 4, 5, 9, 40, 300, 3000):
        whole = rnd.integers(0, 2**64, size, np.uint64)
        sets += [np.unique(np.append(whole[cut:], rnd.integers(0, 2**64, more, np.uint64))) for cut in (0, 0, size // 9, size // 5, size // 2) for more in (0, size // 9)]
    for similarity in (0.5, 0.8, 1.0):
        sizes, sketch = near_texts.sketches(sets)
        cost = near_texts.may_be_near(similarity)(sizes, *sketch.T)
        for a, b in combinations(range(len(sets)), 2):
            may = np.isfinite(cost(np.array([a]), np.array([b])))[0]
            assert may or near_texts.jaccard(sets[a], sets[b]) < similarity
            ruled_out += not may
    assert ruled_out > 1000
