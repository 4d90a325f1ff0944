import numpy as np
from pyspark.sql import functions as F

from custofold.llm import hamming

SCHEMA = "vec_id long, embedding array<float>, score string"


def brute(rows, queries, k):
    out = {}
    for q, v in queries:
        found = sorted((-float(np.dot(np.float64(v), np.float64(w))), i) for i, w in rows if i != q)
        out[q] = [i for _, i in found[:k]]
    return out


def found(spark, rows, is_query, k=5, **options):
    df = spark.createDataFrame([(i, v, "x") for i, v in rows], SCHEMA)
    got = {}
    for r in sorted(hamming.nearest(df, is_query, k, **options).collect(), key=lambda r: (r["query_id"], r["rank"])):
        got.setdefault(r["query_id"], []).append(r["vec_id"])
        assert r["rank"] == len(got[r["query_id"]])
    return got


def test_recall_on_vectors_of_many_lengths(spark):
    rng = np.random.default_rng(1)
    x = rng.normal(size=(3000, 24)) * rng.uniform(0.5, 2, size=(3000, 1))
    rows = [(i, v.tolist()) for i, v in enumerate(x.astype(np.float32))]
    got = found(spark, rows, F.col("vec_id") % 50 == 0, 10)
    want = brute(rows, [r for r in rows if r[0] % 50 == 0], 10)
    assert np.mean([len(set(got[q]) & set(w)) / 10 for q, w in want.items()]) > 0.9


def test_copies_ties_and_unusable_vectors(spark):
    rows = [(i, [1.0, 0.0]) for i in range(300)] + [(400, [0.5, 0.5]), (401, [0.0, 2.0])]
    odd = [(500, None), (501, [0.0, 0.0]), (502, [None, 1.0]), (503, [float("nan"), 1.0]), (504, [1.0]), (None, [9.0, 9.0]), (505, [float("inf"), 1.0])]
    got = found(spark, rows + odd, F.col("vec_id").isin(7, 401, 501, 504), 4)
    assert got == {7: [0, 1, 2, 3], 401: [400, 0, 1, 2]}


def test_fewer_candidates_than_asked_for_and_repeated_ids(spark):
    got = found(spark, [(1, [1.0, 0.0]), (2, [0.0, 1.0]), (2, [0.0, 1.0]), (3, [1.0, 1.0])], F.col("vec_id") < 3, 20)
    assert got == {1: [3, 2, 2], 2: [3, 1]}
    assert found(spark, [], F.lit(True)) == {}
    assert found(spark, [(1, None)], F.lit(True)) == {}


def test_the_index_finds_every_code_within_the_radius():
    rng = np.random.default_rng(3)
    codes = rng.integers(0, 256, size=(500, 4), dtype=np.uint8)
    codes[:50] = codes[0] ^ (rng.random((50, 4)) < 0.3).astype(np.uint8)
    index = hamming.MultiIndex(codes)
    for radius in (0, 1, 3, 5, 9, 32):
        for q in codes[:5]:
            distance = hamming.POPULATION[codes ^ q].sum(axis=1)
            assert index.within(q, radius)[0].tolist() == np.flatnonzero(distance <= radius).tolist()
