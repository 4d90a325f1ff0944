import math
from collections import Counter

import numpy as np
from pyspark.sql import functions as F

from custofold.llm import brown


def rows_of(spark, texts):
    return spark.createDataFrame([(i, t, 0) for i, t in enumerate(texts)], "doc_id long, text string, word int")


def scored(spark, texts, train=lambda i: i % 3 != 1, **options):
    training = F.col("doc_id").isin([i for i in range(len(texts)) if train(i)])
    got = brown.score_documents(rows_of(spark, texts), training, ~training, **{"vocabulary": 30, "local": 50, "classes": 4, **options})
    return sorted(got.collect(), key=lambda r: r["doc_id"])


def texts(n=60, seed=2):
    rng = np.random.default_rng(seed)
    left, right = [f"l{i}" for i in range(40)], [f"R{i}" for i in range(40)]
    out = [" ".join(rng.choice(left if k % 2 else right) for k in range(rng.integers(1, 80))) for _ in range(n)]
    return [*out, "", None, " \t\n", "never seen words é", "l1 " * 3000]


def test_base_scores_and_counts_are_those_of_the_formula(spark):
    values = texts()
    got = scored(spark, values, rounds=2)
    tokens = [[*(t or "").encode().lower().split(), b"\n"] for t in values]
    counts = Counter(w for i, ws in enumerate(tokens) if i % 3 != 1 for w in ws)
    n, v = sum(counts.values()), len(counts)
    assert len(got) == len(values)
    for row, ws in zip(got, tokens, strict=True):
        want = sum(math.log10((counts[w] + 0.5) / (n + 0.5 * (v + 1))) for w in ws)
        assert abs(row["base_score"] - want) < 1e-6 * max(1, abs(want))
        assert (row["n_tokens"], row["n_known"], row["train_tokens"]) == (len(ws), sum(counts[w] > 0 for w in ws), n)
        assert row["held_out"] == (row["doc_id"] % 3 == 1)


def test_scores_are_those_of_the_class_model(spark):
    """By brute force from the model's classes: counts of class bigrams, kinds and tokens."""
    values = texts()
    docs = rows_of(spark, values)
    training = docs.where("doc_id % 3 <> 1")
    model, counts, total = brown.train(training, vocabulary=30, local=50, classes=4, rounds=3)
    words = model.words
    tokens = [[*(t or "").encode().lower().split()] for t in values]
    learned = [ws for i, ws in enumerate(tokens) if i % 3 != 1]
    end = words.all_classes - 1
    moves, kinds, sums, word_n = Counter(), Counter(), Counter(), Counter()
    for ws in learned:
        seq = [end, *map(words.class_of_word, ws), end]
        moves.update(zip(seq, seq[1:], strict=False))
        word_n.update(ws)
        word_n[b"\n"] += 1
    for w, k in word_n.items():
        c = end if w == b"\n" else words.class_of_word(w)
        kinds[c] += 1
        sums[c] += k
    out_of = Counter()
    for (a, _), k in moves.items():
        out_of[a] += k
    base = total + 0.5 * (len(word_n) + 1)
    got = {r["doc_id"]: r["score"] for r in brown.score(docs, model, counts, total, F.lit(True)).collect()}
    for i, ws in enumerate(tokens):
        seq = [end, *map(words.class_of_word, ws), end]
        want = 0.0
        for a, b, w in zip(seq, seq[1:], [*ws, b"\n"], strict=False):
            move = (moves[a, b] + 0.5) / (out_of[a] + 0.5 * words.all_classes)
            p = brown.MIX * move / (sums[b] + 0.5 * (kinds[b] + 1)) + (1 - brown.MIX) / base
            want += math.log10((word_n[w] + 0.5) * p)
        assert abs(got[i] - want) < 1e-6 * max(1, abs(want))


def test_exchange_finds_the_two_kinds_of_words(spark):
    values = texts(200)[:200]
    got = scored(spark, values, vocabulary=80, local=80, classes=2, rounds=6)
    better = sum(r["score"] - r["base_score"] for r in got if r["held_out"]) / sum(r["n_tokens"] for r in got if r["held_out"])
    assert better > 0.1  # knowing the kind that comes next is worth nearly log10(2) less what mixing takes


def test_repeated_rows_and_rows_without_id(spark):
    docs = spark.createDataFrame([(1, "a b"), (1, "a b"), (1, "c"), (None, "a"), (None, "a")], "doc_id long, text string")
    got = brown.score_documents(docs, F.lit(True), F.lit(False), vocabulary=2, local=2, classes=2).collect()
    assert sorted((r["doc_id"] or 0, r["n_tokens"], r["n_known"]) for r in got) == [(0, 2, 2), (0, 2, 2), (1, 2, 2), (1, 3, 3), (1, 3, 3)]
    assert len({r["score"] for r in got}) == 3


def test_nothing_to_learn_from_and_nothing_to_score(spark):
    docs = rows_of(spark, ["a b", None])
    got = brown.score_documents(docs, F.lit(False), F.lit(True)).collect()
    assert [round(r["base_score"], 9) for r in got] == [0.0, 0.0] and all(math.isfinite(r["score"]) for r in got)
    assert brown.score_documents(docs.where("doc_id > 5"), F.lit(True), F.lit(False)).count() == 0


def test_placing_gives_the_class_that_an_exchange_gives():
    rng = np.random.default_rng(4)
    for _ in range(50):
        width, free = 9, 5
        side, other = np.divmod(np.flatnonzero(rng.random(2 * width) < 0.4), width)
        n = rng.integers(1, 30, len(side))
        own = int(rng.integers(free, width))
        matrix = rng.integers(0, 50, (width, width)).astype(float)
        matrix[own] += np.bincount(other[side == 0], n[side == 0], width)
        matrix[:, own] += np.bincount(other[side == 1], n[side == 1], width)
        assert brown.best_place(own, side, other, n, matrix, free) == brown.best_class(own, side, other, n, matrix, free)


def test_words_beyond_the_exchange_are_placed_by_what_stands_beside_them(spark):
    values = texts(200)[:200]
    training = rows_of(spark, values)
    model, _, _ = brown.train(training, vocabulary=20, local=80, classes=2, rounds=6)
    left = {model.words.class_of_word(f"l{i}".encode()) for i in range(40)}
    right = {model.words.class_of_word(f"r{i}".encode()) for i in range(40)}
    assert len(left) == len(right) == 1 and left != right and max(left | right) < 2


def test_words_seen_once_stay_with_those_never_seen(spark):
    model, _, _ = brown.train(rows_of(spark, ["a b a b once", "b a b a"]), vocabulary=1, local=10, classes=2)
    words = model.words
    assert words.class_of_word(b"a") < 2 and words.class_of_word(b"b") < 2
    assert words.class_of_word(b"once") == 2 + brown.ending(b"once", words.rare)


def test_rounds_end_when_the_likelihood_stops_to_rise(spark, monkeypatch):
    steps = []
    once = brown.exchange_round
    monkeypatch.setattr(brown, "exchange_round", lambda *a: steps.append(a[-1]) or once(*a))
    brown.train(rows_of(spark, texts(60)[:60]), vocabulary=80, local=80, classes=2, rounds=40)
    assert 3 <= len(steps) < 40


def test_runs_hold_every_text_between_ends_and_words_are_found_once():
    import pyarrow as pa

    column = pa.array(["a b", "", "A c a", None, "d"]).fill_null("")
    whole = [t for run in brown.runs_of(column, 4) for t in run[1:]]
    assert whole == [b"a", b"b", b"\n", b"\n", b"a", b"c", b"a", b"\n", b"\n", b"d", b"\n"]
    assert all(run[0] == run[-1] == brown.END for run in brown.runs_of(column, 4))
    asked = []
    memo = brown.Numbers(lambda w: asked.append(w) or len(asked), 99)
    for run in brown.runs_of(column, 4):
        memo.of(run)
    assert asked == [b"a", b"b", b"c", b"d"] and memo.of([b"a", brown.END, b"d"]).tolist() == [1, 99, 4]


def test_training_splits_its_texts_twice_and_counts_from_stored_numbers(spark):
    """Once to count words and once to number them; the numbers give the bigrams of all steps."""
    values = [t or "" for t in texts(20)]
    words = brown.Words({b"l1": 0, b"r1": 1, b"l2": 2}, 2, np.array([0, 1, 2 + brown.ending(b"l2", 3)]), 2, 3)
    runs = brown.numbered(rows_of(spark, values), words)
    assert runs.columns == ["run"]
    tokens = [[b"\n", *t.encode().lower().split(), b"\n"] for t in values]
    place = {b"\n": 6, **{w: words.place_of_word(w) for ws in tokens for w in ws if w != b"\n"}}
    number = {w: 5 if w == b"\n" else p if p < 2 else 2 + brown.ending(w, 3) for w, p in place.items()}
    pairs = Counter((number[a], number[b]) for ws in tokens for a, b in zip(ws, ws[1:], strict=False))
    got = {divmod(r["code"], 6): r["n"] for r in brown.vocabulary_bigrams(runs, words).collect()}
    assert got == pairs
    class_of = {w: 5 if w == b"\n" else words.class_of_word(w) for w in place}
    pairs = Counter((class_of[a], class_of[b]) for ws in tokens for a, b in zip(ws, ws[1:], strict=False))
    matrix = brown.class_bigrams(runs, words)
    assert {(a, b): matrix[a, b] for a, b in zip(*np.nonzero(matrix), strict=True)} == pairs
