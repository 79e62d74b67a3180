"""Reply trees against a plain walk."""

import random

from pyspark.sql import functions as F

from skyloom.llm import chat

SCHEMA = "tree_id long, msg_id long, parent_id long, role string, text string, score double"


def test_texts_come_back_and_hold_no_marks(spark):
    texts = ["", "\\", "<turn:x>\n", "</turn>", "\\(", "\\\\(", "\\\\\\<", "a\\\\<b>", "(", ")\\", r"\### Assistant: </turn> ok", "é\n\n🙂", "<>" * 50 + "\\" * 51]
    texts += ["".join(random.Random(i).choices("\\<>()a\n", k=30)) for i in range(200)]
    rows = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string").withColumn("hidden", chat.hide(F.col("t"))).withColumn("back", chat.show(F.col("hidden"))).collect()
    assert all(r.back == texts[r.i] and "<" not in r.hidden and ">" not in r.hidden for r in rows)


def test_paths_scores_and_ranks(spark):
    rows = [
        (1, 1, None, "user", "q", 0.0), (1, 2, 1, "assistant", "bad", 1.0), (1, 3, 1, "assistant", "good", 3.0), (1, 4, 3, "user", "more", None), (1, 5, 4, "assistant", "end", 1.0), (1, 6, 2, "user", "hm", 3.0),
        (2, 1, 99, "user", None, 1.0), (2, 1, 99, "user", None, 1.0), (3, 1, 2, "user", "circle", 1.0), (3, 2, 1, "user", "circle", 1.0), (None, 7, None, None, "x", 0.0), (4, None, None, "user", "no id", 1.0),
    ]
    got = {}
    for r in chat.paths(spark.createDataFrame(rows, SCHEMA)).collect():
        got.setdefault((r.tree_id, r.leaf_id, r.path_rank, r.score), []).append((r.pos, r.role, r.text))
    want = {
        (1, 5, 1, 4.0): ["q", "good", "more", "end"], (1, 6, 2, 4.0): ["q", "bad", "hm"], (2, 1, 1, 1.0): [None], (None, 7, 1, 0.0): ["x"],
    }
    assert {k: [t for _, _, t in sorted(v, key=lambda x: x[0])] for k, v in got.items()} == want
    best = chat.conversations(spark.createDataFrame(rows, SCHEMA), best=1)
    assert {(r.tree_id, r.leaf_id) for r in best.collect()} == {(1, 5), (2, 1), (None, 7)}


def test_a_deep_chain_is_one_conversation(spark):
    rows = [(5, i, i - 1 if i else None, "assistant" if i % 2 else "user", f"t{i} <x>", 0.0) for i in range(300)]
    back = chat.read_back(chat.conversations(spark.createDataFrame(rows, SCHEMA).repartition(3))).collect()
    assert len(back) == 1 and [t.text for t in back[0].turns] == [f"t{i} <x>" for i in range(300)]
    assert back[0].learnt == [f"t{i} <x>" for i in range(1, 300, 2)]
    assert all("<" not in back[0].formatted[x.start : x.stop] for x in back[0].loss)


def test_linear_conversations(spark):
    rows = [(1, 2, "assistant", "b"), (1, 1, "user", "a"), (1, 2, "assistant", "a"), (2, None, None, None), (2, 1, "assistant", None), (None, 1, "user", "x")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    back = chat.read_back(chat.conversations(chat.linear(df.withColumn("score", F.lit("clash"))))).collect()
    got = {r.tree_id: [(t.role, t.text) for t in r.turns] for r in back}
    assert got == {1: [("user", "a"), ("assistant", "a"), ("assistant", "b")], 2: [("", ""), ("assistant", "")], None: [("user", "x")]}
    assert {r.tree_id: r.learnt for r in back} == {1: ["a", "b"], 2: [""], None: []}
    assert chat.conversations(chat.linear(df.where("false"))).count() == 0
