import hashlib
import random
import re

from hypothesis import given, settings
from hypothesis import strategies as st

from plumbline.llm import private_data as pd

SHAPES = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def passes(kind, text):
    digits = [int(c) for c in text if c.isdigit()]
    if kind == "ip":
        return all(int(x) <= 255 for x in text.split("."))
    if kind == "card":
        doubled = [sum(divmod(2 * d, 10)) if i % 2 else d for i, d in enumerate(digits[::-1])]
        return 12 <= len(digits) <= 19 and sum(doubled) % 10 == 0
    return kind == "email" or 9 <= len(digits) <= 15


def brute(text):
    found = [(m.start(), k, m.end()) for k, (kind, shape) in enumerate(SHAPES.items()) for m in re.finditer(shape, text) if passes(kind, m[0])]
    return sorted(found)


def written(spans):
    return ",".join(f"{pd.KINDS[k]}:{a}:{b}" for a, k, b in spans)


@settings(max_examples=400, deadline=None)
@given(st.text(alphabet="a@.-+ (14)0é\n", max_size=60))
def test_seeds_equal_the_shapes(text):
    assert pd.base_spans(text) == brute(text)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.sampled_from(["4111 1111-1111 1111", "1.2.3.4", "999.1.1.1", "x@y.com", "+1 (523) 555-1055", "+", "@", ".", " ", "z", "é", "0255.1.2.3.4"]), max_size=9))
def test_seeds_equal_the_shapes_of_pieces(parts):
    text = "".join(parts)
    seeds = pd.base_spans(text)
    assert seeds == brute(text)
    for a, b in pd.candidate_spans(text, seeds):
        assert a < b and not any(a < e and s < b for s, _, e in seeds)


def test_long_texts_take_linear_time():
    import time

    started = time.time()
    for text in ("1" * 2_000_000, "a" * 2_000_000 + "@", "a.b@" * 300_000, "+1 " * 500_000, "1.1." * 400_000, "x9 " * 200_000, "-" * 1_000_000 + "9"):
        seeds = pd.base_spans(text)
        pd.candidate_spans(text, seeds)
    assert time.time() - started < 60


def test_whole_documents_against_brute_force(spark):
    from plumbline.llm.catalog import QUERIES

    folder = "/root/testdata/sf0.01"
    texts = {r["doc_id"]: r["text"] or "" for r in spark.read.parquet(f"{folder}/documents.parquet").collect()}
    df = QUERIES["op12_pii"](spark, folder)
    assert df.columns == ["doc_id", "n_email", "n_ip", "n_card", "n_phone", "base_sha256", "spans"]
    rows = df.collect()
    assert sorted(r["doc_id"] for r in rows) == sorted(texts)
    for r in rows:
        spans = brute(texts[r["doc_id"]])
        assert [r[f"n_{k}"] for k in pd.KINDS] == [sum(s[1] == i for s in spans) for i in range(4)]
        assert r["base_sha256"] == hashlib.sha256(written(spans).encode()).hexdigest()
        assert set(filter(None, written(spans).split(","))) <= set(r["spans"].split(","))


def planted(n=12):
    rnd = random.Random(5)
    word = lambda: "".join(rnd.choice("abcdefghij") for _ in range(5))
    rows = []
    for i in range(n):
        rows.append((i, f"{word()} {word()} call me: +1 (523) 555-1{i:03} {word()} {word()} costs 19{i:02} {word()} id {rnd.randrange(10**8, 10**9)} {word()}"))
        rows.append((100 + i, f"{word()} mail to: user{i}@host{i}.example.com {word()}"))
    rows.append((200, f"{word()} call me: 555 20{9:02} 77 today, mail to: bob@localhost then {word()} 5552098877 {word()}"))
    rows.append((201, f"please call me: 1234567890123 {word()}"))  # the shape of a card that fails its check
    return rows


def test_contexts_of_seeds_find_other_shapes(spark):
    rows = planted()
    df = spark.createDataFrame([(*r, "clash", 1) for r in rows], "doc_id bigint, text string, mark string, kind int")
    found = {r["doc_id"]: [(s["text"], pd.KINDS[s["kind"]], s["base"]) for s in r["spans"]] for r in pd.find_private(df).collect()}
    assert found[200] == [("555 2009 77", "phone", False), ("bob@localhost", "email", False)]
    assert found[201] == []
    assert all(len(found[i]) == 1 and found[i][0][2] for i, _ in rows if i < 200)


def test_found_identifiers_lead_to_further_patterns(spark):
    rows = planted()
    for i in range(4):  # a second context, never beside a seed, of numbers that the first one finds
        rows += [(300 + 10 * k + i, f"call me: 555 77{i} 12{i} {word}") for k, word in enumerate(("so", "then", "or"))]
        rows += [(340 + i, f"ring number 555 77{i} 12{i}")]
    rows += [(350, "or ring number 444 00 777")]
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    find = lambda **k: {r["doc_id"]: len(r["spans"]) for r in pd.find_private(df, **k).collect()}
    first, later = find(rounds=1, confidence=0.5), find(rounds=3, confidence=0.5)
    assert first[300] == later[300] == 1 and first[350] == 0 and later[350] == 1


def test_odd_documents(spark, odd, none):
    rows = pd.find_private(odd).collect()
    assert len(rows) == odd.count() and all(r["spans"] == [] for r in rows)
    assert pd.find_private(none).count() == 0
    same = spark.createDataFrame([(1, "a@b.co"), (1, "a@b.co"), (None, "é a@b.co")], "doc_id bigint, text string")
    assert sorted(len(r["spans"]) for r in pd.find_private(same).collect()) == [1, 1, 1]
