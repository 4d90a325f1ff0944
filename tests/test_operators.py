import random

import pytest
from pyspark.sql import functions as F

from custofold.operators import (
    Lookup,
    edges_both_ends,
    edges_oriented,
    edges_within,
    event_counts,
    latest_by,
    lookup,
    lookup_constant,
    measure,
    merge_verified,
    priority_pick,
    read_matching,
    reconcile,
    request_key,
    unpivot_typed,
    verification_requests,
    verification_results,
    with_match,
    without_match,
)
from custofold.schemas import LOOKUP
from tests.helpers import VALUE_SETS, plan_text, value_sets


def pairs(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


# ------------------------------------------------------------------ lookup


@pytest.mark.parametrize("max_bytes", [1 << 20, 0])
def test_lookup_hit_miss_blocked_and_doubled(spark, max_bytes):
    table = Lookup.of(spark.createDataFrame(VALUE_SETS, LOOKUP), max_bytes)
    assert table.small == (max_bytes > 0)
    rows = spark.createDataFrame([(c,) for c in ["B1", "B2", "B3", "B4", "B5", "B9", None]], "code string")
    got = lookup(rows, table, "code", "brand", set_name="RD BRAND NAMES")
    assert pairs(got) == pairs(
        spark.createDataFrame(
            [("B1", "brand 1"), ("B2", None), ("B3", None), ("B4", None), ("B5", "brand 5a"), ("B5", "brand 5b"),
             ("B9", None), (None, None)], "code string, brand string")
    )
    if max_bytes:
        assert "BroadcastHashJoin" in plan_text(got)


def test_lookup_with_the_set_in_a_column(spark):
    rows = spark.createDataFrame(
        [("RD DISABILITY", "D"), ("RD BRAND NAMES", "D"), (None, "D")], "s string, code string"
    )
    got = lookup(rows, value_sets(spark), "code", "v", set_col="s")
    assert {(r.s, r.v) for r in got.collect()} == {("RD DISABILITY", "disabled"), ("RD BRAND NAMES", None), (None, None)}
    with pytest.raises(ValueError):
        lookup(rows, value_sets(spark), "code", "v")


def test_lookup_constant(spark):
    rows = spark.createDataFrame([(1,), (2,)], "id int")
    table = value_sets(spark)
    got = lookup_constant(rows, table, "RD BRAND NAMES", "B5", "v")
    assert pairs(got) == [(1, "brand 5a"), (1, "brand 5b"), (2, "brand 5a"), (2, "brand 5b")]
    assert pairs(lookup_constant(rows, table, "RD BRAND NAMES", "B2", "v")) == [(1, None), (2, None)]
    assert "Join" not in plan_text(got)


def test_measure(spark):
    m = measure(spark.createDataFrame([("ab", None), ("c", "def")], "a string, b string"))
    assert (m.rows, m.text_bytes, m.small(1000), m.small(10)) == (2, 6, True, False)


# ------------------------------------------------------------------ matching


def test_match_null_keys(spark):
    left = spark.createDataFrame([(1, "a"), (None, "b"), (3, "c")], "k int, v string")
    right = spark.createDataFrame([(1,), (1,), (None,)], "k int")
    assert {r.v for r in with_match(left, right, ["k"]).collect()} == {"a"}
    assert {r.v for r in without_match(left, right, ["k"]).collect()} == {"b", "c"}
    assert {r.v for r in with_match(left, right, ["k"], null_safe=True).collect()} == {"a", "b"}
    assert {r.v for r in without_match(left, right, ["k"], null_safe=True).collect()} == {"c"}
    assert pairs(read_matching(left, right, ["k"], ["v"])) == [("a",)]


def test_event_counts(spark):
    df = spark.createDataFrame([(1, "x"), (1, "x"), (None, "x")], "k int, v string")
    assert {(r.k, r.CNT) for r in event_counts(df, ["k"]).collect()} == {(1, 2), (None, 1)}


# ------------------------------------------------------------------ picks


def test_latest_by_does_not_depend_on_input_order(spark):
    rows = [("a", 1, "x"), ("a", 2, "z"), ("a", 2, "y"), ("a", None, "n"), ("b", None, "q"), (None, 5, "p")]
    seen = set()
    for seed in range(4):
        random.Random(seed).shuffle(rows)
        df = spark.createDataFrame(rows, "k string, t int, v string").repartition(3)
        seen.add(tuple(pairs(latest_by(df, ["k"], "t"))))
    assert len(seen) == 1
    assert set(next(iter(seen))) == {("a", 2, "y"), ("b", None, "q"), (None, 5, "p")}


def test_picks_are_cut_before_the_shuffle(spark):
    df = spark.range(100).select((F.col("id") % 3).alias("k"), "id")
    for picked in (latest_by(df, ["k"], "id"), priority_pick(df, ["k"], "id", [5])):
        text = plan_text(picked)
        before_shuffle = text[text.rindex("Exchange"):]
        assert "WindowGroupLimit" in before_shuffle and "Partial" in before_shuffle


def test_priority_pick(spark):
    df = spark.createDataFrame(
        [(1, "R"), (1, "A"), (1, "C"), (2, "R"), (2, "A"), (3, None), (3, "R"), (4, None), (4, "X")], "k int, s string"
    )
    assert pairs(priority_pick(df, ["k"], "s", ["C", "A", "R"])) == [(1, "C"), (2, "A"), (3, "R"), (4, "X")]


# ------------------------------------------------------------------ reshaping


def test_unpivot_reads_once_and_keeps_every_cell(spark, tmp_path):
    path = str(tmp_path / "wide")
    spark.range(50).select("id", F.lit("b").alias("b"), F.lit(None).cast("string").alias("h")).write.parquet(path)
    df = spark.read.parquet(path)
    got = unpivot_typed(df, [("one", "b"), ("two", "b"), ("three", "h")], "t", "v", ["id"])
    assert got.count() == 150
    assert plan_text(got).count("FileScan") == 1
    assert {(r.t, r.v) for r in got.collect()} == {("one", "b"), ("two", "b"), ("three", None)}


def test_edges(spark):
    e = spark.createDataFrame(
        [(1, 2, "SB"), (1, 2, "SB"), (1, 9, "SB"), (2, 3, "OO"), (3, 1, "??")], "a int, b int, k string"
    )
    known = spark.createDataFrame([(1,), (2,), (3,), (3,)], "id int")
    assert pairs(edges_within(e, "a", "b", known)) == [(1, 2, "SB"), (2, 3, "OO"), (3, 1, "??")]
    assert pairs(edges_oriented(e, "a", "b", "k", ["SB"], ["OO"])) == [
        (1, 2, "SB"), (1, 2, "SB"), (1, 9, "SB"), (3, 2, "OO")]
    assert pairs(edges_both_ends(e.where("k = 'SB'"), "a", "b", "id")) == [(1, "SB"), (2, "SB"), (9, "SB")]
    assert edges_both_ends(e, "a", "b", "id", distinct=False).count() == 10


# ------------------------------------------------------------------ reconcile


def brute_reconcile(rows):
    """Distinct inserts, and the latest change of each key by (time, then smallest value)."""
    best = {}
    for k, flag, t, v in rows:
        if flag not in (None, "IN") and ((k not in best) or (-best[k][2], best[k][1], best[k][3]) > (-t, flag, v)):
            best[k] = (k, flag, t, v)
    return {r for r in rows if r[1] == "IN"} | set(best.values())


def test_reconcile_against_brute_force(spark):
    rng = random.Random(3)
    rows = [
        (rng.choice(["a", "a", "a", "b", "c", None]), rng.choice(["IN", "UP", "DL", None]), rng.randrange(6), rng.choice("xyz"))
        for _ in range(300)
    ]
    df = spark.createDataFrame(rows, "k string, flag string, t int, v string").repartition(5)
    got = reconcile(df, ["k"], ["t"], flag="flag")
    assert sorted(map(tuple, got.collect()), key=repr) == sorted(brute_reconcile(rows), key=repr)


# ------------------------------------------------------------------ address verification


def test_requests_and_results(spark):
    df = spark.createDataFrame([("k1", "A & <B>", None), ("k2", None, "x")], "request_key string, l1 string, l2 string")
    sent = verification_requests(df, ["l1", "l2"])
    texts = {r.request_key: r.payload for r in sent.collect()}
    assert "<av:AddressLine1>A &amp; &lt;B&gt;</av:AddressLine1><av:AddressLine2></av:AddressLine2>" in texts["k1"]
    # A request has the element names of a response, so its lines and key can be read back.
    back = {r.request_key: r for r in verification_results(sent, "payload").collect()}
    assert back["k1"].addressLine1 == "A & <B>" and back["k2"].addressLine2 == "x"
    assert back["k1"].uprn is None and len(back["k1"]) == 11
    other = verification_requests(df, ["l1"], prefix="q", namespace="urn:q")
    assert '<q:SEQ_NUM>k1</q:SEQ_NUM>' in {r.request_key: r.payload for r in other.collect()}["k1"]


def test_results_of_a_broken_text_are_null(spark):
    df = spark.createDataFrame([("not xml",)], "r string")
    assert set(verification_results(df, "r").first()) == {None}


def test_merge_verified(spark):
    addresses = spark.createDataFrame([("1", "a"), ("2", "b"), ("3", "c")], "request_key string, line string")
    answers = spark.createDataFrame([("1", "u", "?"), ("1", "u", "?"), ("2", None, "V")], "request_key string, uprn string, code string")
    got = {r.request_key: (r.line, r.verified_uprn, r.verified_code) for r in merge_verified(addresses, answers).collect()}
    assert got == {"1": ("a", "u", None), "2": ("b", None, "V"), "3": ("c", None, None)}
    assert merge_verified(addresses, answers).count() == 3


def test_request_key_tells_null_from_blank(spark):
    df = spark.createDataFrame([("a", None), ("a", ""), (None, "a")], "x string, y string")
    assert len({r[0] for r in df.select(request_key("x", "y")).collect()}) == 3
