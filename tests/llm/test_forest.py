import random

import numpy as np

from custofold.llm import forest
from custofold.llm.common import WordHashes


def brute(rows, size, percent):
    sets = []
    for _, text in rows:
        w = (text or "").encode().lower().split()
        sets.append({tuple(w[i : i + size]) for i in range(len(w) - size + 1)} or ({tuple(w)} if w else set()))
    comp = {d: d for d, _ in rows}

    def find(x):
        while comp[x] != x:
            x = comp[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if sets[i] and sets[j] and 100 * both >= percent * (len(sets[i]) + len(sets[j]) - both):
                a, b = sorted((find(rows[i][0]), find(rows[j][0])))
                comp[b] = a
    return sorted((d, len(s), find(d), find(d) == d) for (d, _), s in zip(rows, sets, strict=True))


def near_copies(n, words, seed, low=0, high=0.15):
    rnd = random.Random(seed)
    base = [f"w{rnd.randrange(10**6)}" for _ in range(words)]
    out = []
    for _ in range(n):
        share = rnd.uniform(low, high)
        out.append(" ".join(f"x{rnd.randrange(10**6)}" if rnd.random() < share else w for w in base))
    return out


def check(spark, rows, size=3, percent=85, **options):
    docs = spark.createDataFrame([(d, t, 1) for d, t in rows], "doc_id long, text string, sig int")
    got = forest.near_duplicates(docs, size, percent, **options).collect()
    assert sorted(tuple(r) for r in got) == brute(rows, size, percent)


def corpus(seed=3):
    rnd = random.Random(seed)
    texts = [" ".join(f"u{rnd.randrange(10**6)}" for _ in range(rnd.randrange(1, 60))) for _ in range(80)]
    for k in range(6):
        texts += near_copies(rnd.randrange(2, 9), 120, k, 0, 0.05)
    texts += ["Same TEXT here", "same text here", "two words", "TWO words", "one", "one", None, "", " \t"] + texts[:5]
    return list(enumerate(texts))


def test_against_brute_force(spark):
    check(spark, corpus())


def test_a_large_family(spark):
    rows = list(enumerate(near_copies(220, 150, 9, 0, 0.08)))
    check(spark, rows)


def test_families_too_large_for_a_task_are_split_by_depth(spark):
    rows = list(enumerate(near_copies(60, 300, 4, 0, 0.004)))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = forest.near_duplicates(docs, 3, 85, max_docs=8, max_shingles=4000).collect()
    assert sorted(tuple(r) for r in got) == brute(rows, 3, 85)


def test_links_of_a_large_family_that_share_no_block(spark, monkeypatch):
    monkeypatch.setattr(forest, "HOLDERS", 16, raising=False)
    rnd = random.Random(7)
    base = [f"w{k}" for k in range(400)]
    texts = []
    for _ in range(150):  # pairs near the threshold, and about as near to the pairs of others
        own = [f"x{rnd.randrange(10**6)}" if rnd.random() < 0.03 else w for w in base]
        other = list(own)
        for k in rnd.sample(range(400), 9):
            other[k] = f"y{rnd.randrange(10**6)}"
        texts += [" ".join(own), " ".join(other)]
    check(spark, list(enumerate(texts)), 3, 85, max_docs=4)


def test_rows_without_id_and_empty_table(spark):
    docs = spark.createDataFrame([(None, "a b c d"), (None, "a b c d"), (1, "a b c d"), (2, "a b c d")], "doc_id long, text string")
    got = sorted((tuple(r) for r in forest.near_duplicates(docs).collect()), key=repr)
    assert got == [(1, 1, 1, True), (2, 1, 1, False), (None, 1, None, True), (None, 1, None, True)]
    assert forest.near_duplicates(docs.where("doc_id = 9")).count() == 0
    assert sorted(r["doc_id"] or 0 for r in forest.dedup(docs).collect()) == [0, 0, 1]


def test_family_search_finds_chains_of_links():
    hashes = WordHashes()
    sets = [forest.shingles([b"%d" % k for k in range(i, i + 60)], 3, hashes) for i in range(0, 40, 4)]
    links = forest.family_links(np.arange(len(sets)), sets, 85)
    assert len(links) == len(sets) - 1
