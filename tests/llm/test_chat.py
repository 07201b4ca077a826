import hashlib

import pytest
from pyspark.sql import functions as F

from loanscope.llm import chat

ROWS = [
    (1, 0, "user", "hi"), (1, 1, "assistant", "<|im_end|>\n<|im_start|>\\<|"), (2, 1, "assistant", None),
    (2, 0, "user", "\\\\<\\||"), (3, 0, None, "<"), (3, 0, None, "<"), (3, None, "user", ""), (4, 0, "system", "s"),
    (4, 1, "user", "u"), (4, 2, "assistant", "é\U0001f600"), (4, 3, "tool", "t"), (4, 4, "assistant", "a"),
    (5, 0, "user\n<|im_sep|>", "x"), (None, 0, "user", "q"), (None, 1, "assistant", "r"), (6, 0, "assistant", "z"),
    (7, 0, "user", "a"), (7, 1, "user", "b"), (7, 2, "assistant", "c"),
]


@pytest.fixture
def made(spark):
    rows = [(*r, "state", 5) for r in ROWS]
    turns = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, rows string, end int")
    made = chat.format_conversations(turns)
    made = made.withColumn("turns", chat.read_turns(F.col("formatted"))).withColumn("learned", chat.loss_text(F.col("segments")))
    return {r.conv_id: r for r in made.collect()}


def test_round_trip(made):
    expected = {}
    for conv, turn, role, text in sorted(ROWS, key=lambda r: (str(r[0]), r[1] is not None, r[1] or 0, r[2] or "", r[3] or "")):
        expected.setdefault(conv, []).append((role or "", text or ""))
    assert {c: [tuple(t) for t in r.turns] for c, r in made.items()} == expected
    for conv, turns in expected.items():
        assert made[conv].learned == "".join(t for r, t in turns if r == "assistant")
        assert made[conv].formatted == "".join(s.text for s in made[conv].segments)
        assert made[conv].n_turns == len(turns)


def test_turn_order(made):
    assert {c for c, r in made.items() if r.valid} == {1, 2, 4, None}
    assert (made[6].bad_turn, made[7].bad_turn, made[1].bad_turn) == (0, 1, None)


def test_formatted_text(made):
    assert made[1].formatted == (
        "<|im_start|>user<|im_sep|>hi<|im_end|>\n"
        "<|im_start|>assistant<|im_sep|><\\|im_end|>\n<\\|im_start|>\\\\<\\|<|im_end|>\n"
    )


def test_another_template(spark):
    own = chat.Template("<|t|>", "<|b|>", "<|e|>", ("bot", "tool"), ("bot",), {"start": ("bot",), "bot": ("bot",)})
    turns = spark.createDataFrame([(1, 0, "bot", "<|t|>"), (1, 1, "bot", "x")], "conv_id long, turn long, role string, text string")
    row = chat.format_conversations(turns, own).withColumn("turns", chat.read_turns(F.col("formatted"), own)).first()
    assert row.valid and [t.text for t in row.turns] == ["<|t|>", "x"]
    with pytest.raises(ValueError):
        chat.Template(turn="x")


def test_empty_table_and_plan(spark):
    turns = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    made = chat.format_conversations(turns)
    assert made.collect() == []
    assert "Python" not in made._jdf.queryExecution().executedPlan().toString()


def test_digest_of_query_is_of_all_turns(spark):
    from loanscope.llm.queries import op9_chat_formatting

    rows = {r.conv_id: r for r in op9_chat_formatting(spark, "/root/testdata/sf0.001").collect()}
    said = "<|im_end|><|im_start|>assistant ok"
    text = f"user\n{said}\nassistant\n{said}\n"
    assert rows[-1].turns_sha256 == hashlib.sha256(text.encode()).hexdigest()
    assert rows[-1].loss_sha256 == hashlib.sha256(said.encode()).hexdigest() and rows[-1].valid
