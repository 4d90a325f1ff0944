import random

import numpy as np
from tokenizers import Tokenizer

from custofold.llm import bpe
from custofold.llm.queries import tokenizer_file

PIECES = [
    " ", "  ", "\n", "\n\n", "\t", " ", " ", "'s", "'ll", "'", "a", "Word", "été", "12", "3", "²", "½", "!!", "...",
    "<|endoftext|>", "<|endof", "text|>", "日本語", "é", "​", "😀", "-", "_", "\r\n", "\x1c", "x" * 40,
]


def texts(n, size, seed):
    rnd = random.Random(seed)
    return ["".join(rnd.choice(PIECES) for _ in range(rnd.randrange(size))) for _ in range(n)]


def whole(values):
    file = Tokenizer.from_file(tokenizer_file())
    ids = [e.ids for e in file.encode_batch(values, add_special_tokens=False)]
    return ids, [file.decode(i, skip_special_tokens=False) for i in ids]


def check(spark, values, chunk_bytes):
    docs = spark.createDataFrame([(i, t, "x") for i, t in enumerate(values)], "doc_id long, text string, ids string")
    got = {r["doc_id"]: r for r in bpe.encode_documents(docs, tokenizer_file(), chunk_bytes).collect()}
    ids, back = whole([t or "" for t in values])
    assert len(got) == len(values)
    for i in range(len(values)):
        assert np.frombuffer(got[i]["ids"], "<u4").tolist() == ids[i]
        assert got[i]["decoded"] == back[i]


def test_agrees_with_the_library(spark):
    shared = texts(3, 400, 1)
    values = [*texts(60, 200, 2), None, "", "<|endoftext|>", *shared, *("a b " + t for t in shared), "word " * 5000]
    for chunk_bytes in (8, 64, 1024):
        check(spark, values, chunk_bytes)


def test_a_text_without_any_safe_place(spark):
    check(spark, ["x1" * 4000, "\n" * 3000, " " * 3000, "日本" * 2000], 16)


def test_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert bpe.encode_documents(docs, tokenizer_file()).count() == 0


def test_chunks_of_a_shared_passage_are_the_same():
    own = bpe.ChunkCoder(tokenizer_file(), 64)
    passage = " ".join(f"word{i}" for i in range(400)).encode()
    ends = []
    for before in (b"", b"some other beginning "):
        data = np.frombuffer(before + passage, np.uint8)
        ends.append({int(e) - len(before) for e in own.cuts(data)})
    assert len(ends[0] & ends[1]) > 10
    assert {e for e in ends[0] ^ ends[1] if e > bpe.WINDOW} == set()
