"""Very long texts, empty tables, repeated rows and null ids, where the operators' own tests do not have them."""

import numpy as np
from tokenizers import Tokenizer

from custofold.llm import bpe, decontam, forest, passages, toxicity
from custofold.llm.queries import tokenizer_file

WORDS = [f"w{i}" for i in range(250_000)]
LONG = " ".join(WORDS)


def docs_of(spark, *texts):
    return spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")


def test_the_end_of_a_long_text_is_compared_with_the_benchmark(spark):
    item = [f"item{i}" for i in range(20)]
    bench = spark.createDataFrame([(1, " ".join(item))], "item_id long, text string")
    got = decontam.overlaps(docs_of(spark, LONG + " " + " ".join(item), LONG), bench).collect()
    assert [(r["doc_id"], r["start_word"], r["end_word"]) for r in got] == [(0, len(WORDS), len(WORDS) + 20)]
    assert decontam.overlaps(docs_of(spark), bench).count() == decontam.overlaps(docs_of(spark, "x"), bench.limit(0)).count() == 0


def test_long_near_copies_are_linked(spark):
    other = " ".join(f"v{i}" for i in range(200_000))
    rows = forest.near_duplicates(docs_of(spark, LONG, LONG + " and more", other), words=3, percent=85).collect()
    assert {r["doc_id"]: (r["component_id"], r["n_shingles"]) for r in rows} == {
        0: (0, len(WORDS) - 2), 1: (0, len(WORDS)), 2: (2, 200_000 - 2)
    }


def test_a_passage_at_the_end_of_a_long_text(spark):
    (row,) = passages.shared_passages(docs_of(spark, LONG, "before " + " ".join(WORDS[-60:]))).collect()
    assert {row["start_word"], row["other_start"]} == {1, len(WORDS) - 60} and row["matched"] == 60


def test_no_rows_to_score_for_toxicity(spark):
    docs = docs_of(spark, *(f"fine words {i}" for i in range(30)), *(f"you blockhead {i}" for i in range(30)))
    labels = spark.createDataFrame([(i, int(i >= 30)) for i in range(60)], "doc_id long, toxic int")
    model = toxicity.train(docs, labels)
    assert toxicity.score(docs.limit(0), model).count() == 0
    assert toxicity.train(docs, labels.limit(0)) is not None


def test_repeated_rows_and_null_ids_are_encoded(spark):
    rows = [(1, "same text"), (1, "same text"), (None, "same text"), (None, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    ids = Tokenizer.from_file(tokenizer_file()).encode("same text", add_special_tokens=False).ids
    got = [(r["doc_id"], np.frombuffer(r["ids"], "<u4").tolist()) for r in bpe.encode_documents(docs, tokenizer_file()).collect()]
    assert sorted(got, key=repr) == sorted([(1, ids), (1, ids), (None, ids), (None, [])], key=repr)
