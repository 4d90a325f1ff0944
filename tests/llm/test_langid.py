import math
from collections import Counter, defaultdict

from custofold.llm import langid
from custofold.llm.common import in_fold

TRAIN = [("abab abba", "x"), ("abba", "x"), ("cdcd dccd é", "y"), ("zz", None), (None, "x"), ("", "y")]


def brute(text, lang, order):
    """Bits of a text by the definition, with plain dictionaries."""
    after = defaultdict(Counter)
    for t, own in TRAIN:
        if own == lang and t:
            raw = b"\n" * order + t.encode()
            for i in range(order, len(raw)):
                for k in range(order + 1):
                    after[raw[i - k : i]][raw[i]] += 1
    bits = 0.0
    raw = b"\n" * order + text.encode()
    for i in range(order, len(raw)):
        for k in range(order, -1, -1):
            seen = after.get(raw[i - k : i])
            if not seen:
                continue
            n, u = sum(seen.values()), len(seen)
            if seen[raw[i]]:
                bits -= math.log2(seen[raw[i]] / (n + u))
                break
            bits -= math.log2(u / (n + u))
        else:
            bits += 8
    return bits


def test_code_lengths_are_exact(spark):
    docs = spark.createDataFrame([(i, t, g) for i, (t, g) in enumerate(TRAIN)], "doc_id long, text string, lang string")
    for order in (1, 3):
        trees = langid.train(docs, order=order)
        assert trees.langs == ["x", "y"]
        import numpy as np

        for text in ("abab", "dcd", "qé", "a" * 300):
            raw = np.frombuffer(text.encode(), np.uint8)
            got = trees.lengths(raw, np.array([0]))[0]
            for k, lang in enumerate(trees.langs):
                assert abs(got[k] - brute(text, lang, order)) < 1e-3 * max(1, got[k])


def test_counts_that_fill_many_blocks(spark):
    import numpy as np

    docs = spark.createDataFrame([(i, t, g) for i, (t, g) in enumerate(TRAIN)], "doc_id long, text string, lang string")
    texts = ["abab", "dcd", "qé", "é abba cdcd", "", "a" * 300]
    asked = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    for order in (1, 3):
        whole, cut = langid.train(docs, order=order), langid.train(docs, order=order, max_grams=3)
        assert len(whole.parts) == 1 and len(cut.parts) > 3 and cut.langs == ["x", "y"]
        for text in texts:
            got = cut.lengths(np.frombuffer(text.encode(), np.uint8), np.array([0]))[0]
            for k, lang in enumerate(cut.langs):
                assert abs(got[k] - brute(text, lang, order)) < 1e-3 * max(1, got[k])
        one, many = ({r["doc_id"]: r for r in langid.predict(asked, m).collect()} for m in (whole, cut))
        for k in range(len(texts)):
            assert one[k]["lang_pred"] == many[k]["lang_pred"] and abs(one[k]["score"] - many[k]["score"]) < 1e-4


def test_defined_cases(spark):
    docs = spark.createDataFrame([(i, t, g) for i, (t, g) in enumerate(TRAIN)], "doc_id long, text string, lang string")
    trees = langid.train(docs)
    rows = [(1, None, "k"), (2, "", "k"), (3, "12 !", "k"), (4, "abba", "k"), (4, "abba", "k"), (5, "dc" * 200_000, "k"), (None, "é", None)]
    got = langid.predict(spark.createDataFrame(rows, "doc_id long, text string, score string"), trees).collect()
    assert [(r["doc_id"], r["lang_pred"]) for r in got[:6]] == [(1, "und"), (2, "und"), (3, "und"), (4, "x"), (4, "x"), (5, "y")]
    assert [r["score"] for r in got[:3]] == [0.0, 0.0, 0.0] and all(0 < r["score"] <= 1 for r in got[3:])


def test_nothing_learned(spark):
    docs = spark.createDataFrame([], "doc_id long, text string, lang string")
    trees = langid.train(docs)
    got = langid.predict(spark.createDataFrame([(1, "abc")], "doc_id long, text string"), trees).collect()
    assert [(r["lang_pred"], r["score"]) for r in got] == [("und", 0.0)]
    assert langid.predict(docs, trees).count() == 0


def test_held_out_rows_of_each_language(spark):
    """The contract's split; every language by itself is found and is right where it is named."""
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    out = in_fold("doc_id", 3, 1)
    got = langid.predict(docs.where(out), langid.train(docs.where(~out))).where("lang IS NOT NULL").select("lang", "lang_pred").collect()
    for lang in {r["lang"] for r in got}:
        own, named = [r for r in got if r["lang"] == lang], [r for r in got if r["lang_pred"] == lang]
        right = sum(r["lang_pred"] == lang for r in own)
        assert right >= 0.95 * len(own) and right >= 0.95 * len(named) and own, lang
    assert len({r["lang"] for r in got}) >= 4
