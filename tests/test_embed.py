import random
from collections import defaultdict

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from custofold.operators import assemble, attach, collect_subdocs, fold_documents, place, stack_values
from custofold.operators.sizing import PART


def hot_rows():
    """Key h holds most rows and many distinct values, key c holds copies of one value, the rest are small."""
    rng = random.Random(1)
    rows = [("h", f"v{i}") for i in range(400)] + [("h", f"v{rng.randrange(400)}") for _ in range(300)]
    rows += [("c", "same")] * 500 + [(f"k{i}", f"v{j}") for i in range(20) for j in range(i % 4 + 1)]
    rng.shuffle(rows)
    return rows


def as_sets(rows):
    out = defaultdict(set)
    for k, v in rows:
        out[k].add(v)
    return dict(out)


def test_collect_is_sorted_and_distinct(spark):
    df = spark.createDataFrame([("a", "2"), ("a", "1"), ("a", "2"), (None, "x"), ("b", None)], "k string, v string")
    got = {r.k: (r.vs, r[PART]) for r in collect_subdocs(df, ["k"], "v", "vs").collect()}
    assert got == {"a": (["1", "2"], 0), "b": ([], 0)}


@pytest.mark.parametrize("limit", [1, 7, 50, 1000])
def test_oversize_keys_are_continued_not_cut(spark, limit):
    rows = hot_rows()
    df = spark.createDataFrame(rows, "k string, v string").repartition(6)
    got = collect_subdocs(df, ["k"], "v", "vs", max_items=limit).collect()
    together, parts = defaultdict(list), defaultdict(int)
    for r in got:
        together[r.k] += r.vs
        parts[r.k] += 1
        assert r.vs == sorted(r.vs)
    assert {k: sorted(v) for k, v in together.items()} == {k: sorted(v) for k, v in as_sets(rows).items()}
    assert parts["c"] == 1
    if limit >= 400:
        assert set(parts.values()) == {1}
    if limit == 50:
        assert parts["h"] == 8 and max(len(r.vs) for r in got) < 100


def test_placing_without_broadcast_gives_the_same_parts(spark):
    df = spark.createDataFrame(hot_rows(), "k string, v string")
    small = {tuple(r) for r in place(df, ["k"], 50).collect()}
    shuffled = {tuple(r) for r in place(df, ["k"], 50, max_bytes=0).collect()}
    assert small == shuffled and {r[2] for r in small} == set(range(8))


def test_fold_keeps_every_value_of_a_hot_document(spark):
    base = spark.createDataFrame([("h", "hot"), ("k1", "one"), ("lonely", "l")], "k string, name string")
    rows = spark.createDataFrame(hot_rows(), "k string, v string")
    other = rows.select("k", F.upper("v").alias("w"))
    values = stack_values(base, {"v": rows, "w": other}, ["k"])
    docs = fold_documents(values, ["k"], max_items=60).collect()
    assert {r.k for r in docs} == {"h", "k1", "lonely"}  # keys without a base row are no documents
    mains = {r.k: r for r in docs if r[PART] == 0}
    assert {k: r.name for k, r in mains.items()} == {"h": "hot", "k1": "one", "lonely": "l"}
    assert (mains["lonely"].v, mains["lonely"].w) == (None, None)
    assert {r.name for r in docs if r[PART] > 0} == {"hot"}  # the base stands on every part
    hot = [r for r in docs if r.k == "h"]
    assert sorted(x for r in hot for x in r.v or []) == sorted(as_sets(hot_rows())["h"])
    assert sorted(x for r in hot for x in r.w or []) == sorted(v.upper() for v in as_sets(hot_rows())["h"])
    assert max(len(r.v or []) + len(r.w or []) for r in hot) < 130


def test_incomplete_keys_match_nothing(spark):
    base = spark.createDataFrame([("a", None, "n"), ("a", "i", "y")], "k string, s string, name string")
    section = spark.createDataFrame([("a", None, "v1"), ("a", "i", "v2")], "k string, s string, v string")
    for shape in ("array", "rows"):
        got = {r.name: r.v for r in assemble(base, {"v": section}, ["k", "s"], shape).collect()}
        assert got == {"n": None, "y": ["v2"] if shape == "array" else "v2"}


def test_attach_shapes(spark):
    base = spark.createDataFrame([("a", 1), ("b", 2), (None, 3)], "k string, n int")
    section = spark.createDataFrame([("a", "x"), ("a", "y"), ("a", "x")], "k string, v string")
    assert {(r.k, tuple(r.v or [])) for r in attach(base, section, ["k"]).collect()} == {("a", ("x", "y")), ("b", ())}
    assert sorted((r.k, r.v or "") for r in attach(base, section, ["k"], "rows").collect()) == [("a", "x"), ("a", "y"), ("b", "")]
    with pytest.raises(ValueError):
        attach(base, section, ["k"], "other")


def test_rows_multiply_and_arrays_do_not(spark):
    base = spark.createDataFrame([("a", 1)], "k string, n int")
    two = spark.createDataFrame([("a", "x"), ("a", "y")], "k string, v string")
    three = spark.createDataFrame([("a", i) for i in range(3)], "k string, w int")
    assert assemble(base, {"v": two, "w": three}, ["k"], "rows").count() == 6
    (doc,) = assemble(base, {"v": two, "w": three}, ["k"]).collect()
    assert (doc.v, doc.w) == (["x", "y"], [0, 1, 2])


def test_documents_take_one_shuffle(spark, tmp_path):
    base = spark.createDataFrame([("a", 1)], "k string, n int")
    two = spark.createDataFrame([("a", "x"), ("a", "y")], "k string, v string")
    path = str(tmp_path / "values")
    stack_values(base, {"v": two}, ["k"]).write.parquet(path)
    docs = fold_documents(spark.read.parquet(path), ["k"])
    assert docs._jdf.queryExecution().executedPlan().toString().count("Exchange") == 1


def test_parts_take_one_shuffle(spark, tmp_path):
    """Values of keys that are split into parts are dealt to tasks once, also where a later step goes by the first key."""
    base = spark.createDataFrame([(f"k{i}", "s", i) for i in range(30)], "k string, s string, n int")
    rows = spark.createDataFrame([(f"k{i}", "s", f"v{j}") for i in range(30) for j in [*range(i), 0]], "k string, s string, v string")
    path = str(tmp_path / "values")
    stack_values(base, {"v": rows}, ["k", "s"]).write.parquet(path)
    docs = fold_documents(spark.read.parquet(path), ["k", "s"], max_items=4, by=["k"])
    last = docs.withColumn("last", F.max(PART).over(Window.partitionBy("k")))
    assert last._jdf.queryExecution().executedPlan().toString().count("Exchange") == 1
    got = defaultdict(list)
    for r in last.collect():
        got[r.k] += r.v or []
        assert r.n == int(r.k[1:]) and r.last == -(-(max(r.n, 1) + 1) // 4) - 1  # the base counts, copies do not
    assert {k: sorted(v) for k, v in got.items()} == {f"k{i}": sorted(f"v{j}" for j in range(max(i, 1))) for i in range(30)}


@pytest.mark.parametrize("bounds", [{}, {"max_bytes": 0}])
def test_keys_too_large_for_a_task_get_the_same_parts(spark, bounds):
    df = spark.createDataFrame([*hot_rows(), (None, "x"), (None, "y")], "k string, v string")
    anchor = F.col("v").isin("v0", "same")
    for marks in (None, anchor):
        own = sorted(map(tuple, place(df, ["k"], 50, marks).distinct().fillna("").collect()))
        split = sorted(map(tuple, place(df, ["k"], 50, marks, block_rows=100, **bounds).distinct().fillna("").collect()))
        assert own == split and {r[2] for r in own if r[0] == "h"} == set(range(8))
