from pyspark.sql import functions as F

from custofold.llm import chat

SCHEMA = "conv_id long, turn long, role string, text string, blocks string"


def read_back(spark, rows):
    made = chat.format_chats(spark.createDataFrame(rows, SCHEMA))
    back = made.select(
        "conv_id",
        "formatted",
        chat.parse(F.col("formatted")).alias("turns"),
        chat.masked(F.col("formatted"), F.col("loss_runs")).alias("loss"),
    )
    return {r["conv_id"]: r for r in back.collect()}


def turns(row):
    return [(t["role"], t["text"]) for t in row["turns"]]


def test_texts_with_control_strings_come_back(spark):
    nasty = ["<|turn|>", "<|end|>", "&lt;|end|>", "&amp;", "&", "<", "<|", "|>", "<|more|>", "", "<|text|>\n\\", "é😀&<|"]
    rows = [(1, i, "user" if i % 3 else "assistant", t, "x") for i, t in enumerate(nasty)]
    got = read_back(spark, rows)[1]
    assert turns(got) == [(r[2], r[3]) for r in rows]
    assert got["loss"] == [r[3] for r in rows if r[2] == "assistant"]


def test_neighbours_of_one_role_share_a_block(spark):
    rows = [(1, 0, "user", "a", None), (1, 1, "user", "b", None), (1, 2, "assistant", "c", None), (1, 3, "user", "d", None)]
    got = read_back(spark, rows)[1]
    assert got["formatted"] == "<|turn|>user<|text|>a<|more|>b<|end|><|turn|>assistant<|text|>c<|end|><|turn|>user<|text|>d<|end|>"
    assert turns(got) == [("user", "a"), ("user", "b"), ("assistant", "c"), ("user", "d")]


def test_nulls_ties_and_repeated_rows(spark):
    rows = [
        (None, 1, "assistant", None, None),
        (2, None, None, "first", None),
        (2, 1, "user", "b", None),
        (2, 1, "user", "a", None),
        (2, 1, "user", "a", None),
        (2, 0, "<|end|>", "odd role", None),
        (3, 0, "user", "x" * 300_000, None),
    ]
    got = read_back(spark, rows)
    assert turns(got[None]) == [("assistant", "")] and got[None]["loss"] == [""]
    assert turns(got[2]) == [("", "first"), ("<|end|>", "odd role"), ("user", "a"), ("user", "a"), ("user", "b")]
    assert turns(got[3]) == [("user", "x" * 300_000)] and got[3]["loss"] == []


def test_empty_table(spark):
    assert read_back(spark, []) == {}
