from pyspark.sql import functions as F

from plumbline.llm import line_dedup


def prose(seed, sentences):
    import random

    rnd = random.Random(seed)
    return " ".join(" ".join(rnd.choice("abcdefghijklmnop") * rnd.randint(2, 6) for _ in range(rnd.randint(6, 11))).capitalize() + "." for _ in range(sentences))


def run(spark, rows):
    df = spark.createDataFrame(rows, "doc_id bigint, text string").withColumn("hash", F.lit(1)).withColumn("at", F.lit("x"))
    out = line_dedup.remove_repeats(df)
    assert out.columns == [*df.columns, "removed_words"]
    return {r["doc_id"]: r for r in out.collect()}


def test_lines_lose_nothing():
    for text in ("", "a", "a. b.\n\nc!  d? e\n", " \n", "x.y. z\r\n"):
        assert "".join(line_dedup.lines_of(text)) == text


def test_shared_passages_keep_their_first_place(spark):
    passage = prose(0, 9)
    rows = [(i, f"{prose(100 + i, 5)} {passage}{' ' if i % 2 else chr(10)}{prose(200 + i, 5)}") for i in range(1, 40)]
    rows += [(50, "Licensed to all of them who read it."), (51, "Licensed to all of them who read it."), (52, prose(7, 6))]
    found = run(spark, rows)
    assert found[1]["text"] == rows[0][1] and found[1]["removed_words"] == 0
    for i, text in rows[1:39]:
        assert passage not in found[i]["text"] and found[i]["removed_words"] >= 40
        assert prose(100 + i, 5)[:60] in found[i]["text"] and prose(200 + i, 5)[-60:] in found[i]["text"]
    for i, text in rows[39:]:
        assert found[i]["text"] == text


def test_chunks_do_not_depend_on_what_stands_before():
    passage = line_dedup.lines_of(prose(3, 30) + " ")
    inside = {h for h, *_ in line_dedup.chunks_of(passage)}
    for i in range(5):
        mixed = {h for h, *_ in line_dedup.chunks_of(line_dedup.lines_of(prose(i, i + 1) + " ") + passage)}
        assert len(inside & mixed) >= len(inside) - 2


def test_copies_nulls_repeated_rows_and_empty_tables(spark):
    text = prose(5, 12)
    found = run(spark, [(1, text), (2, text), (3, None), (4, ""), (5, "word " * 50_000)])
    assert found[1]["text"] == text and found[2]["text"].strip() == "" and found[3]["text"] is None and found[4]["text"] == ""
    twice = spark.createDataFrame([(1, text), (1, text), (None, text)], "doc_id bigint, text string")
    assert [r["text"] for r in line_dedup.remove_repeats(twice).collect()] == [text] * 3
    assert line_dedup.remove_repeats(twice.limit(0)).count() == 0


def test_bytes_decide_not_hashes(spark, monkeypatch):
    lines = line_dedup.lines_of(prose(1, 8))
    assert line_dedup.chunk_bytes(lines, 0, 3) != line_dedup.chunk_bytes(lines, 1, 3)


def test_short_passages_go_at_every_place(spark):
    long = " ".join(f"long{i}" for i in range(55)) + "."
    passages = [long] + [" ".join(f"Part{n} {' '.join(f'p{n}q{k}w{j}' for j in range(24 // n))}." for k in range(n)) for n in (2, 3, 4)]
    rows, gap = [], " "
    for number, passage in enumerate(passages):
        for i in range(1, 13):
            gap = "\n\n" if i % 3 == 0 else " "
            rows.append((100 * number + i, f"{prose(1000 * number + i, 3)}{gap}{passage}{gap}{prose(5000 + 1000 * number + i, 3)}"))
    found = run(spark, rows)
    for number, passage in enumerate(passages):
        for i in range(1, 13):
            row = found[100 * number + i]
            assert (passage in row["text"]) == (i == 1) and row["removed_words"] == (0 if i == 1 else len(passage.split()))
            assert i == 1 or row["text"].split() == f"{prose(1000 * number + i, 3)} {prose(5000 + 1000 * number + i, 3)}".split()


def test_one_line_or_few_words_stay(spark):
    short, line = "Some few words of it. And some more.", " ".join(f"single{i}" for i in range(40)) + "."
    rows = [(i, f"{prose(i, 2)}\n\n{[short, line][i % 2]}\n\n{prose(50 + i, 2)}") for i in range(1, 13)]
    assert all(found["removed_words"] == 0 for found in run(spark, rows).values())


def test_first_place_inside_a_text_stays(spark):
    lines = [f"Turn {i} goes round and round." for i in range(3)]
    found = run(spark, [(1, " ".join(lines * 40))])
    assert found[1]["text"].strip().startswith(" ".join([*lines, lines[0]])) and len(found[1]["text"].split()) <= 7 * 6


def test_chunks_cover_what_brute_force_finds():
    import random

    rnd = random.Random(1)
    for _ in range(200):
        words = [rnd.choice([1, 5, 9, 15, 30, 60]) for _ in range(rnd.randint(1, 9))]
        passage = [" ".join(f"l{i}w{j}" for j in range(n)) + "." for i, n in enumerate(words)]
        around = [["x."], ["y " * 30 + "y."]]
        both = [{(h, n): at for h, at, n in line_dedup.chunks_of(a + passage + a)} for a in around]
        shared = [(both[0][k], k[1]) for k in both[0].keys() & both[1].keys()]
        kept = line_dedup.covering(shared)
        large = sum(words) >= 20 and len(words) > 1
        for some in (shared, [shared[i] for i in kept]):
            places = {i for at, n in some for i in range(at, at + n)}
            wanted = set(range(1, len(words) + 1)) if large else {1} if words[0] >= 50 else set()
            assert places == wanted
