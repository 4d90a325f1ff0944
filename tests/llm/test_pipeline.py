"""Each stage of the pipeline against a plain version of its rule."""

import random
from collections import defaultdict

import pytest
from tokenizers import Tokenizer

import corpus_pipeline
from custofold.llm.queries import tokenizer_file

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def words(n, seed, letters="abcdefghij"):
    rnd = random.Random(seed)
    return ["".join(rnd.choice(letters) for _ in range(rnd.randrange(2, 8))) for _ in range(n)]


@pytest.fixture(scope="module")
def corpus(spark, tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("corpus"))
    line = " ".join(words(12, 1))
    item = words(25, 2)
    texts = [" ".join(words(60, 100 + i, "abcdef" if i % 2 else "uvwxyz")) for i in range(30)]
    copied = texts[4].split(" ")
    texts += [" ".join(copied), " ".join(["zz", *copied[1:]]), " ".join(["other"] * 30)]
    texts += [f"{t}\n{line}" for t in (" ".join(words(60, 300 + i)) for i in range(6))]
    texts += [" ".join(words(20, 3) + item + words(20, 4)), "1234 !!", "", None]
    rows = [(i, t, "x" if t and i % 2 else "y", "s", len(t or "")) for i, t in enumerate(texts)]
    spark.createDataFrame(rows, SCHEMA).write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame([(1, " ".join(item))], "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    return folder, rows, line


def kept_lines(rows):
    holders = defaultdict(set)
    for doc, text in rows:
        for x in text.split("\n"):
            holders[x.strip().lower()].add(doc)

    def stays(doc, x):
        key = x.strip().lower()
        return len(key) < 40 or len(holders[key]) < 5 or doc == max(holders[key])

    return [(d, "\n".join(x for x in t.split("\n") if stays(d, x))) for d, t in rows]


def shingles(text):
    w = text.split()
    return {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set()


def test_stages_by_brute_force(spark, corpus):
    folder, rows, line = corpus
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    columns = docs.columns
    seen = {}
    for name, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, folder)
        seen[name] = docs.collect()
        if name != "bpe":
            assert docs.columns == columns
        docs = spark.createDataFrame(seen[name], docs.schema)
    texts = {d: t for d, t, *_ in rows}

    first = [r["doc_id"] for r in seen["language_id"]]
    assert sorted(first) == [d for d, t in texts.items() if t and any(c.isalpha() for c in t)]

    second = {r["doc_id"]: r for r in seen["line_dedup"]}
    want = kept_lines([(d, texts[d]) for d in first])
    assert {d: r["text"] for d, r in second.items()} == dict(want)
    assert all(r["n_chars"] == len(r["text"]) for r in second.values())

    left = dict(want)
    for d in sorted(left):
        for e in sorted(left):
            if e < d and e in left and d in left:
                a, b = shingles(left[d]), shingles(left[e])
                if 100 * len(a & b) >= 80 * len(a | b):
                    del left[d]
    assert sorted(r["doc_id"] for r in seen["minhash_near_dedup"]) == sorted(left)

    (leaky,) = [d for d in left if "".join(words(25, 2)) in left[d].replace(" ", "")]
    assert sorted(r["doc_id"] for r in seen["benchmark_decontamination"]) == sorted(set(left) - {leaky})

    file = Tokenizer.from_file(tokenizer_file())
    ids = {r["doc_id"]: r for r in seen["bpe"]}
    for d in set(left) - {leaky}:
        expected = file.encode(left[d], add_special_tokens=False).ids
        assert ids[d]["n_tokens"] == len(expected)
        assert ids[d]["ids"] == b"".join(i.to_bytes(4, "little") for i in expected)


def test_run_is_its_stages_and_an_empty_corpus_runs(spark, corpus, tmp_path):
    folder, rows, _ = corpus
    assert corpus_pipeline.run(spark, folder).count() > 25
    empty = str(tmp_path)
    spark.read.parquet(f"{folder}/documents.parquet").where("doc_id < 0").write.parquet(f"{empty}/documents.parquet")
    spark.read.parquet(f"{folder}/benchmark.parquet").write.parquet(f"{empty}/benchmark.parquet")
    assert corpus_pipeline.run(spark, empty).count() == 0
