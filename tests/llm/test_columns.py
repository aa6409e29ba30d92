"""Columns of the caller with names that the operators use inside."""

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from plumbline.llm import columns, decontamination, line_dedup, packing, toxicity
from plumbline.llm.columns import set_aside


def test_names_come_back(spark):
    df = spark.createDataFrame([(1, 2, 3, 4)], "_todo int, _TODO_ int, x int, doc_id int")
    aside, back = set_aside(df, ["_todo", "DOC_ID"])
    assert aside.columns == ["_todo__", "_TODO_", "x", "doc_id_"]
    assert aside.withColumnsRenamed(back).columns == df.columns
    assert set_aside(df, ["other"])[0].columns == df.columns


def test_line_dedup_keeps_columns_of_its_own_names(spark):
    passage = " ".join(f"word{i}" for i in range(60)) + "."
    rows = [(1, f"first. {passage}", "a", 7, 8), (2, f"second. {passage}", "b", 9, 10)]
    df = spark.createDataFrame(rows, "k bigint, body string, _todo string, doc_id int, text int")
    found = line_dedup.remove_repeats(df, doc_id="k", text="body")
    assert found.columns == [*df.columns, "removed_words"]
    one, two = found.orderBy("k").collect()
    assert tuple(one)[:5] == rows[0] and two["body"].strip() == "second." and (two["_todo"], two["doc_id"], two["text"]) == ("b", 9, 10)


def test_filters_keep_columns_of_their_own_names(spark, folder, documents):
    extra = documents.withColumns({"_measures": F.lit("m"), "_leaks": F.lit("l"), "_leaks_before": F.lit(1)})
    labels, benchmark = (spark.read.parquet(f"{folder}/{n}.parquet") for n in ("labels", "benchmark"))
    clean, bare = toxicity.keep_clean(extra, labels), decontamination.drop_leaking(extra, benchmark)
    for kept in (clean, bare):
        assert kept.columns == extra.columns
        row = kept.first()
        assert (row["_measures"], row["_leaks"], row["_leaks_before"]) == ("m", "l", 1)
    assert {r["doc_id"] for r in bare.select("doc_id").collect()} == {r["doc_id"] for r in decontamination.drop_leaking(documents, benchmark).select("doc_id").collect()}


def test_batches_are_cut():
    batch = pa.RecordBatch.from_arrays([pa.array(range(10))], ["x"])
    parts = list(columns.parts_of(iter([batch, batch.slice(0, 0), batch.slice(2, 3)]), 4))
    assert [p.num_rows for p in parts] == [4, 4, 2, 3]
    assert [x for p in parts for x in p.column(0).to_pylist()] == [*range(10), 2, 3, 4]


def test_released_passes_rows_on():
    batch = pa.RecordBatch.from_arrays([pa.array(range(10))], ["x"])
    assert [p.num_rows for p in columns.released(columns.parts_of)(iter([batch, batch]))] == [10, 10]


def test_words_that_come_again_stay():
    held = columns.Lately(100)
    for call in range(50):
        words = {"often", *(f"{call}-{i}" for i in range(20))}
        held.make_room()
        new = held.missing(words)
        assert ("often" in new) == (call == 0) and len(new) == 20 + (call == 0)
        held.now.update((w, call) for w in new)
        assert words <= held.now.keys() and held.now["often"] == 0
    assert len(held) <= 100 + 2 * 21


def rare_words(n, each=1000):
    """Texts of words that stand in one of them only, and one word that all have."""
    return [" ".join(["often", *(f"w{low + i}q" for i in range(each))]) for low in range(0, n, each)]


def test_scorer_holds_few_words_and_scores_alike(monkeypatch):
    weights = np.random.default_rng(5).standard_normal(toxicity.LETTERS**3).astype(np.float32)
    texts = rare_words(3000, 20)
    whole = toxicity.Scorer(weights, 0.0)(texts)
    few = toxicity.Scorer(weights, 0.0, kept=50)
    assert np.array_equal(np.concatenate([few(texts[i : i + 7]) for i in range(0, len(texts), 7)]), whole)
    monkeypatch.setattr(toxicity, "score_windows", lambda windows, *_: np.zeros(len(windows), np.float32))
    scorer = toxicity.Scorer(weights, 0.0)
    for text in rare_words(200_000):
        scorer([text])
    assert len(scorer.margins) < 70_000


def test_encoder_holds_few_words():
    encode = packing.Encoder(public_tokenizers.path("byte_bpe_50k.json"))
    for text in rare_words(200_000):
        encode([text])
    assert len(encode.ids) < 160_000


@pytest.mark.parametrize("name", ["text", "doc_id"])
def test_texts_go_to_workers_once(spark, documents, monkeypatch, name):
    model = toxicity.Model(np.zeros(toxicity.LETTERS**3, np.float32), 0.0, np.ones(toxicity.TOP + 1), 0.0)
    items, vocabulary = decontamination.read_items([(1, "one two three four five six", None)])
    space = decontamination.Space(vocabulary, np.ones((len(vocabulary) + 1, 2)))
    sent, real = [], type(documents).mapInArrow
    monkeypatch.setattr(type(documents), "mapInArrow", lambda df, *x: (sent.append(df.columns), real(df, *x))[1])
    keep = documents.columns if name == "text" else ["doc_id"]
    rows = [toxicity.measured(documents, model, "text", keep), decontamination._searched(documents, items, space, keep)]
    assert [len(columns) for columns in sent] == 2 * [len(documents.columns) if name == "text" else 2]
    for found in rows:
        assert found.columns[:-1] == keep and found.select(*keep).exceptAll(documents.select(*keep)).isEmpty()
        assert found.count() == documents.count()
