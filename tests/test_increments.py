"""Snapshots, bucketed reads, skewed lookups, parts by bytes, row numbers, and templates."""

import json
import random
import shutil
from collections import Counter
from pathlib import Path

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from custofold.operators import (
    Lookup,
    Snapshot,
    collect_subdocs,
    fold_documents,
    lookup,
    lookup_spread,
    place_bytes,
    read_bucketed,
    reconcile,
    row_index,
    stack_values,
    with_bucket,
)
from custofold.operators.lookup import frequent
from custofold.operators.match import KEY_BUCKET, key_bucket
from custofold.operators.snapshot import SLICE
from custofold.schemas import LOOKUP
from custofold.sources import Store, by_template, drift, read_variants


@pytest.fixture
def store(spark, tmp_path):
    return Store(spark, str(tmp_path / "tables"))


def rows_of(df):
    return sorted(map(tuple, df.collect()), key=repr)


# ------------------------------------------------------------------ snapshot

CHANGES = "k string, flag string, t int, v string"


def changes(seed, n=60):
    rnd = random.Random(seed)
    return [
        (rnd.choice(["a", "b", "c", None, *map(str, range(8))]), rnd.choice(["IN", "UP", "DL", None]), rnd.randrange(9), rnd.choice("xy"))
        for _ in range(n)
    ]


def snapshot(store, buckets=4):
    return Snapshot(store, "snap", ["k"], ["t"], buckets, "flag", "IN")


def test_batches_give_what_one_batch_gives(spark, store):
    first, second = (spark.createDataFrame(changes(i), CHANGES) for i in (1, 2))
    kept = snapshot(store)
    for batch in (first, second, second):
        kept.update(batch)
    assert rows_of(kept.read()) == rows_of(reconcile(first.unionByName(second), ["k"], ["t"], "flag", "IN"))
    kept.update(first.limit(0))
    kept.compact()
    assert rows_of(kept.read()) == rows_of(reconcile(first.unionByName(second), ["k"], ["t"], "flag", "IN"))


def test_untouched_buckets_are_not_read(spark, store):
    kept = snapshot(store, 8)
    kept.update(spark.createDataFrame([(str(i), "UP", 1, "old") for i in range(40)], CHANGES))
    batch = spark.createDataFrame([("7", "UP", 2, "new")], CHANGES)
    (mine,) = kept.touched(batch)
    merged = kept.merged(batch, [mine])
    plan = merged._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(SLICE" in plan or f"PartitionFilters: [(SLICE#" in plan or "PartitionFilters: [SLICE" in plan
    folder = Path(store.base) / "snap" / "v0"
    others = [p for p in folder.iterdir() if p.name.startswith(SLICE) and not p.name.startswith(f"{SLICE}={mine}-")]
    assert len(others) > 3
    for p in others:
        shutil.move(p, folder.parent / f"away-{p.name}")  # the update works without them
    kept.update(batch)
    for p in others:
        shutil.move(folder.parent / f"away-{p.name}", p)
    assert Counter(r.v for r in kept.read().collect()) == {"old": 39, "new": 1}
    assert sorted(kept.live().values()) == [1] * (len(kept.live()) - 1) + [2]


def test_an_update_that_fails_changes_nothing(spark, store, monkeypatch):
    kept = snapshot(store)
    kept.update(spark.createDataFrame(changes(3), CHANGES))
    before = rows_of(kept.read())
    plain = Store.overwrite
    monkeypatch.setattr(Store, "overwrite", lambda *_: 1 / 0)
    with pytest.raises(ZeroDivisionError):
        kept.update(spark.createDataFrame(changes(4), CHANGES))
    monkeypatch.setattr(Store, "overwrite", plain)
    assert rows_of(kept.read()) == before
    kept.update(spark.createDataFrame(changes(5), CHANGES))
    both = spark.createDataFrame(changes(3) + changes(5), CHANGES)
    assert rows_of(kept.read()) == rows_of(reconcile(both, ["k"], ["t"], "flag", "IN"))


# ------------------------------------------------------------------ bucketed read


def files_read(df):
    """Runs the frame; how many files its scans have opened."""
    df.collect()
    found, todo = 0, [df._jdf.queryExecution().executedPlan()]
    while todo:
        node = todo.pop()
        name = node.getClass().getSimpleName()
        if name == "AdaptiveSparkPlanExec":
            todo.append(node.executedPlan())
        elif name.endswith("QueryStageExec"):
            todo.append(node.plan())
        elif name == "FileSourceScanExec":
            found += node.metrics().apply("numFiles").value()
        else:
            todo += [node.children().apply(i) for i in range(node.children().size())]
    return found


def test_only_the_buckets_asked_for_are_opened(spark, store):
    rows = spark.range(2000).select(F.col("id").alias("k"), (F.col("id") * 2).alias("v"))
    store.append(with_bucket(rows, ["k"], 32).repartition(KEY_BUCKET), "t", [KEY_BUCKET])
    table = store.read("t")
    for asked in ([5], [5, 6, 5, None, 99999]):  # each with a plan of its own, which counts from nothing
        keys = spark.createDataFrame([(str(a) if a is not None else None,) for a in asked], "k string")
        found = read_bucketed(table, keys.select(F.col("k").cast("long").alias("k")), ["k"], ["v"], 32)
        opened = files_read(found)
        assert rows_of(found) == [(10,)] if asked == [5] else rows_of(found) == [(10,), (12,)]
        assert "dynamicpruning" in found._jdf.queryExecution().executedPlan().toString()
        buckets = {r[0] for r in keys.select(key_bucket(["k"], 32)).collect()}
        assert 0 < opened <= len(buckets) < 6


# ------------------------------------------------------------------ skewed lookup


def values(spark, rows):
    return Lookup.of(spark.createDataFrame(rows, LOOKUP), max_bytes=0)


def test_spread_lookup_is_a_lookup(spark):
    table = values(spark, [("S", "hot", "a", "OK"), ("S", "hot", "b", "OK"), ("S", "1", "one", "OK"), ("S", "2", "off", "STOP"), ("T", "1", "t", "OK")])
    codes = ["hot"] * 300 + [None] * 100 + [str(i % 5) for i in range(100)]
    rows = spark.createDataFrame([(i, "T" if i % 3 == 0 else "S", c) for i, c in enumerate(codes)], "id int, s string, c string")
    for how in ({"set_name": "S"}, {"set_col": "s"}):
        assert rows_of(lookup_spread(rows, table, "c", "out", **how)) == rows_of(lookup(rows, table, "c", "out", **how))
    assert rows_of(lookup_spread(rows.limit(0), table, "c", "out", set_name="S")) == []
    with pytest.raises(ValueError):
        lookup_spread(rows, table, "c", "out")


def test_a_code_with_half_of_the_rows_is_spread(spark):
    table = values(spark, [("S", str(i), f"v{i}", "OK") for i in range(2000)])
    code = F.when(F.col("id") % 2 == 0, "7").when(F.col("id") % 5 > 0, (F.col("id") % 2000).cast("string"))
    rows = spark.range(40_000).select("id", code.alias("c"))
    assert [(json.loads(r[0])["c"], r[1]) for r in frequent(rows, ["c"], 16).collect()][0][0] == "7"
    before = {k: spark.conf.get(k) for k in ("spark.sql.shuffle.partitions", "spark.sql.adaptive.enabled")}
    spark.conf.set("spark.sql.shuffle.partitions", "16")
    spark.conf.set("spark.sql.adaptive.enabled", "false")  # its own skew handling is not what is looked at
    try:
        def sizes(df):
            counts = [r["count"] for r in df.groupBy(F.spark_partition_id().alias("p")).count().collect()]
            return max(counts), sorted(counts)[len(counts) // 2]

        plain, _ = sizes(lookup(rows, table, "c", "out", set_name="S"))
        largest, median = sizes(lookup_spread(rows, table, "c", "out", set_name="S"))
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert plain > 20_000 and largest < 2 * median


# ------------------------------------------------------------------ parts by bytes


def brute_parts(sizes, limit):
    """Sizes in their order, in parts as the rule says."""
    if sum(sizes) <= limit:
        return [0] * len(sizes)
    big = [s > limit / 2 for s in sizes]
    largest = max((s for s, b in zip(sizes, big, strict=True) if not b), default=0)
    out, at, seen = [], 0, 0
    for s, b in zip(sizes, big, strict=True):
        out.append(seen if b else sum(big) + at // (limit - largest + 1))
        seen, at = seen + b, at + (0 if b else s)
    return out


def size(v):
    return len(json.dumps({"v": v}, separators=(",", ":"), ensure_ascii=False).encode())


def test_parts_by_bytes_against_brute_force(spark):
    rnd = random.Random(6)
    data = {k: {rnd.choice("abcé") * rnd.randrange(1, 90) + str(i) for i in range(n)} for k, n in {"x": 60, "y": 3, "z": 25}.items()}
    rows = [(k, v) for k, vs in data.items() for v in vs] * 2
    df = spark.createDataFrame([*rows, (None, "n")], "k string, v string").repartition(3)
    got = {(r.k, r.v): r.DOC_PART for r in place_bytes(df, ["k"], 150).collect()}
    for k, vs in data.items():
        ordered = sorted(vs, key=str.encode)
        assert [got[k, v] for v in ordered] == brute_parts([size(v) for v in ordered], 150)
    assert len(got) == sum(map(len, data.values())) + 1 and got[None, "n"] == 0


@pytest.mark.parametrize("block_rows, broadcast", [(10, 1 << 20), (7, 0)])
def test_parts_by_bytes_in_blocks(spark, block_rows, broadcast):
    vs = [f"value {i} {'x' * (i % 40)}" for i in range(300)] + ["y" * 130, "z" * 500]
    df = spark.createDataFrame([("k", v) for v in vs] + [("small", "s")], "k string, v string")
    parts = {}
    for r in place_bytes(df, ["k"], 200, block_rows=block_rows, broadcast_bytes=broadcast).where("k = 'k'").collect():
        parts.setdefault(r.DOC_PART, []).append(r.v)
    assert sorted(v for p in parts.values() for v in p) == sorted(vs)
    assert sorted(parts) == list(range(len(parts)))
    assert all(sum(map(size, p)) <= 200 or len(p) == 1 for p in parts.values())
    assert len(parts) < 1.6 * sum(map(size, vs)) / 200


def test_collected_and_folded_by_bytes(spark, store):
    df = spark.createDataFrame([("k", f"value {i}") for i in range(50)] + [("l", "one")], "k string, v string")
    rows = collect_subdocs(df, ["k"], "v", "v", max_bytes=100).collect()
    assert sorted(v for r in rows if r.k == "k" for v in r.v) == sorted(f"value {i}" for i in range(50))
    assert all(sum(size(v) for v in r.v) <= 100 and r.v == sorted(r.v) for r in rows)
    base = spark.createDataFrame([("k", "K"), ("l", "L")], "k string, name string")
    stacked = store.materialize(stack_values(base, {"v": df.unionByName(df.limit(3).withColumn("k", F.lit("m")))}, ["k"]), "s")
    docs = fold_documents(stacked, ["k"], max_bytes=200).collect()
    assert {r.k for r in docs} == {"k", "l"} and all(r.name == r.k.upper() for r in docs)
    parts = sorted(r.DOC_PART for r in docs if r.k == "k")
    assert len(parts) > 3 and parts == list(range(len(parts)))
    assert sorted(v for r in docs if r.k == "k" for v in r.v or []) == sorted(f"value {i}" for i in range(50))


# ------------------------------------------------------------------ row numbers


def test_row_index_is_dense_and_ordered(spark, store):
    rnd = random.Random(8)
    data = [(rnd.choice([1, 1, 1, rnd.randrange(50), None]), i) for i in range(500)]
    df = spark.createDataFrame(data, "a int, b int").repartition(5)
    numbered = row_index(store, df, [F.col("a").desc_nulls_last(), "b"], "n")
    got = {(r.a, r.b): r.ROW_INDEX for r in numbered.collect()}
    want = sorted(data, key=lambda r: (r[0] is None, -(r[0] or 0), r[1]))
    assert [got[r] for r in want] == list(range(500))
    assert "Window" not in numbered._jdf.queryExecution().executedPlan().toString()
    assert row_index(store, df.limit(0), ["b"], "none").count() == 0


# ------------------------------------------------------------------ templates


def test_records_by_template(spark, tmp_path):
    lines = [
        '{"a": "1", "n": 2, "odd ]\' name": "x", "extra": {"b": 1}}', '{"a": 7, "n": "3", "flag": true}',
        '{"a": null, "n": 1.5, "extra": [1]}', "{broken", "[1, 2]", "null", "", '{"a": "dup", "A": "other"}',
    ]
    (tmp_path / "in.json").write_text("\n".join(lines) + "\n")
    template = T.StructType(
        [T.StructField("a", T.StringType()), T.StructField("n", T.LongType()), T.StructField("odd ]' name", T.StringType()), T.StructField("flag", T.BooleanType())]
    )
    rows = read_variants(spark, str(tmp_path / "in.json"))
    assert rows.where("LINE IS NULL").isEmpty() and rows.count() == 8
    got = rows_of(by_template(rows, template))
    assert got == sorted([("1", 2, "x", None), ("7", 3, None, True), (None, 1, None, None), ("dup", None, None, None)], key=repr)
    found = {(r.COLUMN, r.PROBLEM, r.FOUND): r.N for r in drift(rows, template).collect()}
    assert found == {
        ("a", "mistyped", "BIGINT"): 1, ("n", "mistyped", "STRING"): 1, ("n", "mistyped", "DECIMAL"): 1,
        ("extra", "unknown", "OBJECT"): 1, ("extra", "unknown", "ARRAY"): 1, ("A", "unknown", "STRING"): 1,
        (None, "malformed", "NONE"): 2, (None, "malformed", "ARRAY"): 1, (None, "malformed", "VOID"): 1,
    }
    assert drift(rows.limit(0), template).count() == 0
