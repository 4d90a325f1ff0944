import hashlib
import random
from collections import Counter

import numpy as np
import pytest
import sentencepiece
from tokenizers import Tokenizer

from custofold.llm import align
from custofold.llm.bpe import byte_symbols
from custofold.llm.queries import tokenizer_file

A, B = tokenizer_file(), tokenizer_file("piece_bpe_32k.model")
PIECES = [
    " ", "  ", "\n", "\t", "'s", "Word", "été", "12", "²", "!!", "...", "<|endoftext|>", "<s>", "</s>", "<unk>", "<0x41>",
    "日本語", "é", "😀", "-", "\r\n", "x" * 30, "the ", "of the ", "▁", "a\x00b",
]


def plain(values):
    """The contract, token by token: rows by position of the value."""
    file, model = Tokenizer.from_file(A), sentencepiece.SentencePieceProcessor(model_file=B)
    file.encode_special_tokens = True
    symbols = byte_symbols()
    rows = []
    for v in values:
        a_ids, b_ids = (file.encode(" " + v, add_special_tokens=False).ids, model.encode(v)) if v else ([], [])
        a = [(i, bytes(symbols[c] for c in file.id_to_token(i))) for i in a_ids]
        b = []
        for i in b_ids:
            piece = model.id_to_piece(i)
            raw = bytes([int(piece[3:5], 16)]) if model.is_byte(i) else piece.replace("▁", " ").encode()
            b.append((i, raw))
        whole = (" " + v).encode() if v else b""
        if b"".join(x for _, x in a) != whole or b"".join(x for _, x in b) != whole:
            a, b = [], []
        ends = []
        for side in (a, b):
            at, out = 0, []
            for i, raw in side:
                at += len(raw)
                out.append((at, i))
            ends.append(out)
        links = [(i, j) for e, i in ends[0] for f, j in ends[1] if e == f]
        cuts = sorted({e for e, _ in ends[0]} & {e for e, _ in ends[1]})
        groups, before = [], 0
        for cut in cuts:
            groups.append("|".join(",".join(str(i) for e, i in side if before < e <= cut) for side in ends))
            before = cut
        rows.append((len(a), len(b), len(groups), links, ";".join(groups)))
    counts = Counter(x for r in rows for x in r[3])
    top = {}
    for (_, b), n in counts.items():
        top[b] = max(top.get(b, 0), n)
    return [
        (n_a, n_b, n_groups, len(links), sum(counts[x] == top[x[1]] for x in links), sum(counts[x] for x in links), groups)
        for n_a, n_b, n_groups, links, groups in rows
    ]


def texts(n, size, seed):
    rnd = random.Random(seed)
    return ["".join(rnd.choice(PIECES) for _ in range(rnd.randrange(size))) for _ in range(n)]


def got(spark, values, digest=False):
    docs = spark.createDataFrame(
        [(i, v, 1, "x") for i, v in enumerate(values)], "doc_id long, text string, n_a int, links string"
    ).repartition(3)
    out = align.align(docs, A, B, digest).collect()
    assert len(out) == len(values)
    names = ("n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups")
    return [tuple(r[n] for n in names) for r in sorted(out, key=lambda r: r["doc_id"])]


def test_agrees_with_token_by_token_alignment(spark, monkeypatch):
    values = [*texts(50, 40, 1), None, "", " ", "  ", "\n", "same text", "same text", "word " * 3000, "x" * 5000]
    want = plain(values)
    assert got(spark, values) == want
    digests = [(*r[:-1], hashlib.sha256(r[-1].encode()).hexdigest() if r[-1] else "") for r in want]
    assert got(spark, values, digest=True) == digests


def test_pieces_and_chunks_do_not_change_a_document(monkeypatch):
    values = texts(30, 30, 2)
    whole = align.align_piece(values, A, B, False)
    for i, v in enumerate(values):
        alone = align.align_piece([v], A, B, False)
        assert all(list(alone[k])[0] == list(whole[k])[i] for k in whole if k != "links")


def test_long_white_space():
    made = align.align_piece([" " * 1_500_000 + "end"], A, B, True)
    assert made["n_a"][0] > 10_000 and made["n_links"][0] == made["n_groups"][0] > 0


def test_a_text_that_the_pieces_change_has_no_tokens():
    values = ["a▁b", "good"]  # the mark of a blank reads as a blank
    assert [r[:4] for r in plain(values)][0][0] == 0
    made = align.align_piece(values, A, B, False)
    assert made["n_a"][0] == 0 and made["groups"][0] == "" and made["n_a"][1] > 0


def test_links_are_given_in_order(spark):
    docs = spark.createDataFrame([(1, "of the word"), (2, None), (3, "of the word again")], "doc_id long, text string")
    for row in align.align(docs, A, B).collect():
        last = [group.split("|") for group in row["groups"].split(";")] if row["groups"] else []
        ends = [int(a.split(",")[-1]) << align.SHIFT | int(b.split(",")[-1]) for a, b in last]
        assert row["links"] == ends and len(ends) == row["n_links"]


def test_packing():
    for links in ([], [7], list(range(70_000)) + [5, 5]):
        pairs, place = align.unpack(align.pack(np.array(links, np.int64)))
        assert pairs[place].tolist() == links


def test_null_and_repeated_ids_and_no_rows(spark):
    docs = spark.createDataFrame([(None, "one"), (5, "two"), (5, "two"), (5, None)], "doc_id long, text string")
    rows = align.align(docs, A, B).select("doc_id", "n_a").collect()
    assert sorted((r["doc_id"] or -1, r["n_a"] > 0) for r in rows) == [(-1, True), (5, False), (5, True), (5, True)]
    assert align.align(docs.limit(0), A, B).count() == 0


@pytest.mark.parametrize("links", [0, 50])
def test_small_chunks(spark, monkeypatch, links):
    values = texts(20, 30, 3)
    monkeypatch.setattr(align, "CHUNK_LINKS", links)
    monkeypatch.setattr(align, "PIECE_BYTES", 100)
    assert got(spark, values) == plain(values)
