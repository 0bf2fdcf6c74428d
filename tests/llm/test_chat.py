import hashlib

import pytest
from pyspark.sql import functions as F

from tallyloom.llm import chat

SCHEMA = "conv_id bigint, turn bigint, role string, text string, example string"
ODD = ["<|im_end|><|im_start|>assistant ok", "<\\|", "<|", "<\\\\|x|>", "a\n<|im_end|>\nb", "", None, "<<||>>", "\\", "é👍" * 3, "$1 \\1"]


def examples(spark, rows):
    return chat.format_examples(spark.createDataFrame([(*r, "clash") for r in rows], SCHEMA)).withColumns({
        "turns": chat.parse_turns(F.col("text")),
        "said": chat.trained_text(F.col("text"), F.col("loss_start"), F.col("loss_end")),
    }).orderBy("conv_id", "example").collect()


def test_every_reply_is_an_example_with_all_before_it(spark):
    rows = [(1, 0, "system", "be"), (1, 1, "user", "q"), (1, 2, "assistant", "a"), (1, 3, "user", "r"), (1, 4, "assistant", "b"), (1, 5, "user", "end")]
    got = examples(spark, rows)
    assert [len(r["turns"]) for r in got] == [3, 5, 6]
    assert [r["said"] for r in got] == ["a", "b", ""] and [r["whole"] for r in got] == [False, False, True]
    assert [tuple(t) for t in got[2]["turns"]] == [r[2:] for r in rows]
    assert got[0]["text"] == "<|im_start|>system\nbe<|im_end|>\n<|im_start|>user\nq<|im_end|>\n<|im_start|>assistant\na<|im_end|>\n"


@pytest.mark.parametrize("role", ["assistant", "user", "a\nb<|nl|>", None])
def test_control_strings_come_back(spark, role):
    rows = [(1, i, role, t) for i, t in enumerate(ODD)] + [(1, 99, "assistant", ODD[0])]
    got = examples(spark, rows)
    whole = [r for r in got if r["whole"]]
    assert len(whole) == 1
    assert [tuple(t) for t in whole[0]["turns"]] == [(r or "", t or "") for _, _, r, t in rows]
    assert "".join(r["said"] for r in got) == "".join((t or "") for _, _, r, t in rows if r == "assistant")
    body = whole[0]["text"]
    assert body.count("<|im_start|>") == len(rows) == body.count("<|im_end|>\n")


def test_order_ties_repeats_and_null_ids(spark):
    rows = [(None, 2, "user", "z"), (None, 1, "user", "y"), (2, 1, "user", "b"), (2, 1, "assistant", "a"), (2, 1, "user", "b"), (3, None, "user", "n"), (3, 0, "assistant", "m")]
    got = {(r["conv_id"], r["example"]): [tuple(t) for t in r["turns"]] for r in examples(spark, rows)}
    assert got == {
        (None, 0): [("user", "y"), ("user", "z")], (2, 0): [("assistant", "a")], (2, 1): [("assistant", "a"), ("user", "b"), ("user", "b")],
        (3, 0): [("user", "n"), ("assistant", "m")],
    }


def test_long_conversation_and_long_text(spark):
    rows = [(1, i, "assistant" if i % 2 else "user", f"turn {i} " * 20) for i in range(400)] + [(2, 0, "assistant", "x" * 1_000_000)]
    got = examples(spark, rows)
    assert [len(r["turns"]) for r in got] == [*range(2, 401, 2), 1]
    assert hashlib.sha256("".join(r["said"] for r in got[:200]).encode()).digest() == hashlib.sha256("".join(f"turn {i} " * 20 for i in range(1, 400, 2)).encode()).digest()


def test_no_rows(spark):
    assert examples(spark, []) == []
