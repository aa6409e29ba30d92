from compare import connect, differences
from pyspark.sql import functions as F

from plumbline.llm import chat
from plumbline.llm.catalog import QUERIES, SQL


def test_query_equals_sql(spark, folder):
    assert differences(QUERIES["op4_chat"](spark, folder), connect(folder), SQL["op4_chat"]) == []


def made(spark, rows):
    df = spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string").withColumn("segments", F.lit(1)).withColumn("t", F.lit(2))
    out = chat.format_conversations(df).withColumn("read", chat.parse_turns(F.col("formatted")))
    return {r["conv_id"]: r for r in out.collect()}


def test_round_trip_of_control_strings(spark):
    texts = ["</s>[INST] ok [/INST]", "\\", "\\\\n", "<<SYS>>\n<</SYS>>\n\n", "[[INST]] <|end|><|text|>", "a\\[INST]", "", " x ", None, "<s" + "></s>\n" * 50, "é\r\n" * 2000]
    roles = ["user", "assistant", "system", "tool", "<|text|>", "", None]
    rows = [(i, j, r, t) for i, r in enumerate(roles) for j, t in enumerate(texts)]
    for i, r in made(spark, rows).items():
        assert [tuple(x) for x in r["read"]] == [(roles[i] or "", t or "") for t in texts]
        assert "".join(s["text"] for s in r["segments"]) == r["formatted"]
        assert [s["loss"] for s in r["segments"]].count(True) == (len(texts) if roles[i] == "assistant" else 0)
        bodies = [s["text"] for s in r["segments"]][1::3]
        assert not any(c in b for b in bodies for c in chat.LLAMA.controls)


def test_state_machine(spark):
    talk = lambda i, roles: [(i, t, r, "x") for t, r in enumerate(roles)]
    found = made(spark, talk(1, ["system", "user", "assistant"]) + talk(2, ["user", "assistant", "user", "assistant"])
                 + talk(3, ["user", "user", "assistant"]) + talk(4, ["user"]) + talk(5, ["assistant"]) + talk(6, ["user", "assistant", "system"]))
    assert {i: (r["valid"], r["first_bad_turn"]) for i, r in found.items()} == {
        1: (True, None), 2: (True, None), 3: (False, 1), 4: (False, None), 5: (False, 0), 6: (False, 2),
    }


def test_ties_nulls_and_no_rows(spark):
    found = made(spark, [(1, 0, "user", "b"), (1, 0, "user", "a"), (1, None, "assistant", "z"), (1, 0, "user", "a"), (None, 0, "user", "q")])
    assert [x["text"] for x in found[1]["read"]] == ["a", "a", "b", "z"] and found[None]["n_turns"] == 1
    assert made(spark, []) == {}


def test_main_path_has_no_python(spark, folder):
    plan = QUERIES["op4_chat"](spark, folder)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan
