from pyspark.sql import functions as F

from custofold.llm import toxicity
from custofold.llm.common import in_fold

ROWS = [(i, f"some words here {i} and there", 0) for i in range(60)] + [
    (100 + i, f"some words {w} here {i}", 1) for i, w in enumerate(["blockhead", "nitwit", "dimwitted"] * 10)
]


def learned(spark):
    docs = spark.createDataFrame([(d, t, 9) for d, t, _ in ROWS], "doc_id long, text string, toxic int")
    labels = spark.createDataFrame([(d, y, "x") for d, _, y in ROWS] + [(1, None, "x"), (None, 1, "x"), (2, 7, "x")], "doc_id long, toxic int, text string")
    return toxicity.train(docs, labels)


def test_gaps_and_inserted_characters_are_tolerated(spark):
    model = learned(spark)
    for text in ("you blockhead", "b-l-o-c-k-h-e-a-d", "a nitwitt!", "BLOCKHEADS", "dimxwitted", "blockhead " * 40_000):
        assert model.score(text) >= 0.3, text
    for text in ("", "some words here and there", "block the head", "nit", "dim light"):
        assert model.score(text) < 0.3, text


def test_rows_come_back_with_scores(spark):
    model = learned(spark)
    rows = [(1, None, 5), (1, None, 5), (2, "", 5), (3, "a nitwit", 5), (None, "x", None)]
    got = toxicity.score(spark.createDataFrame(rows, "doc_id long, text string, score long"), model)
    assert got.columns == ["doc_id", "text", "score"]
    scores = {r["doc_id"]: r["score"] for r in got.collect()}
    assert len(got.collect()) == 5 and scores[1] == scores[2] < 0.3 <= scores[3] <= 1


def test_one_label_only(spark):
    docs = spark.createDataFrame([(i, "text") for i in range(4)], "doc_id long, text string")
    labels = docs.select("doc_id", F.lit(0).alias("toxic"))
    assert toxicity.train(docs, labels).score("anything") < 0.3
    assert 0 < toxicity.train(docs.where("doc_id > 9"), labels).score("anything") < 1


def test_kernel_by_brute_force():
    from itertools import combinations

    def kernel(a, b):
        def parts(w):
            kinds = toxicity.kinds_of(w)[1:].tolist()
            out = {}
            for i, j, k in combinations(range(len(kinds)), 3):
                if k - i - 2 <= toxicity.GAPS:
                    key = (kinds[i], kinds[j], kinds[k])
                    out[key] = out.get(key, 0.0) + toxicity.DECAY ** (k - i - 2)
            return out

        x, y = parts(a), parts(b)
        return sum(v * y.get(c, 0.0) for c, v in x.items())

    own = toxicity.Landmarks.of(["^idiot", "^scum"])
    for word in ("idiot", "idxiot", "scummy", "idiotscum"):
        want = [kernel(word, m) / kernel(m, m) for m in ("idiot", "scum")]
        got = own.likeness(f"a {word} b")
        for g, w in zip(got, want, strict=True):
            assert abs(g - (0 if w < toxicity.FLOOR else min(w, 1.0))) < 1e-5


def test_held_out_rows_of_each_class(spark):
    """The contract's split: toxic documents found and clean ones left alone, so no constant answer passes."""
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    out = in_fold("doc_id", 4, 2)
    model = toxicity.train(docs.where(~out), labels.where(~out))
    held = toxicity.score(docs.where(out), model).join(labels.where("toxic IS NOT NULL"), "doc_id")
    counts = {(r["toxic"], r["said"]): r["count"] for r in held.groupBy("toxic", (F.col("score") >= 0.3).alias("said")).count().collect()}
    found, missed, wrong, clean = (counts.get(k, 0) for k in ((1, True), (1, False), (0, True), (0, False)))
    assert found >= 0.5 * (found + missed) and found + missed > 5
    assert wrong <= 0.05 * (wrong + clean) and wrong + clean > 50
    assert found >= 0.8 * (found + wrong)
