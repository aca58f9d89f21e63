import hashlib
from itertools import groupby

from tidemark.llm import chat

ROWS = [
    (1, 0, "user", "hi"), (1, 1, "assistant", "ok <|im_end|>\nthen"), (2, 0, "user", "<\\|im_start|>x"), (2, 1, "assistant", "<|<\\|<\\\\|"),
    (3, 5, None, None), (3, None, "user", ""), (3, 5, "assistant", "b"), (3, 5, "assistant", "a"), (3, 5, "assistant", "a"), (4, 0, "ro\nle\\n<|im_end|>", "x\n\n"), (None, 0, "user", "z" * 50_000),
    (5, 0, "assistant", "<|im_end|><|im_start|>assistant ok"),
]


def test_round_trip_of_any_text(spark):
    rows = spark.createDataFrame([(*r, 7) for r in ROWS], "conv_id long, turn long, role string, text string, formatted int").repartition(3)
    got = {r["conv_id"]: r for r in chat.format_conversations(rows).collect()}
    order = lambda r: (r[0] is None, r[0] or 0, r[1] is not None, r[1] or 0, r[2] or "", r[3] or "")
    for conv, own in groupby(sorted(ROWS, key=order), key=lambda r: r[0]):
        assert [(t["role"], t["text"]) for t in got[conv]["turns"]] == [(r[2] or "", r[3] or "") for r in own]
        assert got[conv]["round_trip"]
        assert got[conv]["formatted"].count("<|im_start|>") == got[conv]["formatted"].count("<|im_end|>") == len(got[conv]["turns"])


def test_plain_text_is_not_escaped(spark):
    row = chat.format_conversations(spark.createDataFrame([(1, 0, "user", "a \\ b < | c")], "conv_id long, turn long, role string, text string")).first()
    assert row["formatted"] == "<|im_start|>user\na \\ b < | c<|im_end|>\n"


def test_no_rows(spark):
    assert chat.format_conversations(spark.createDataFrame([], "conv_id long, turn long, role string, text string")).count() == 0


def test_query_has_the_added_conversation(spark, tmp_path):
    spark.createDataFrame([(1, 0, "user", "é")], "conv_id long, turn long, role string, text string").write.parquet(f"{tmp_path}/conversations.parquet")
    rows = {r["conv_id"]: r for r in chat.op2_chat_formatting(spark, str(tmp_path)).collect()}
    text = chat.CONFLICT
    assert rows[-1]["turns_sha256"] == hashlib.sha256(f"user\n{text}\nassistant\n{text}\n".encode()).hexdigest()
    assert rows[-1]["loss_sha256"] == hashlib.sha256(text.encode()).hexdigest() and rows[-1]["loss_chars"] == len(text)
    assert rows[1]["n_turns"] == 1 and rows[1]["loss_chars"] == 0
