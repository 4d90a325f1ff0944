import random
from collections import defaultdict

import numpy as np
from pyspark.sql import functions as F

from custofold.llm import lines

SPACE = " \t\n\x0b\x0c\r"


def key(line):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in line.strip(SPACE))


def brute(rows, min_chars, min_docs):
    holders = defaultdict(set)
    for doc, text in rows:
        for line in (text or "").split("\n"):
            if len(key(line)) >= min_chars and doc is not None:
                holders[key(line)].add(doc)
    out = []
    for doc, text in rows:
        own = (text or "").split("\n")
        gone = [
            doc is not None and len(key(x)) >= min_chars and len(holders[key(x)]) >= min_docs and doc < max(holders[key(x)])
            for x in own
        ]
        out.append((doc, len(own), sum(gone), "\n".join(x for x, g in zip(own, gone, strict=True) if not g)))
    return sorted(out, key=repr)


def check(spark, rows, min_chars=5, min_docs=3):
    docs = spark.createDataFrame([(d, t, 7) for d, t in rows], "doc_id long, text string, pos int")
    made = lines.line_bitmaps(docs, min_chars, min_docs).withColumn("kept", lines.keep_lines(F.col("text"), F.col("keep")))
    got = [(r["doc_id"], r["n_lines"], r["n_dropped"], r["kept"]) for r in made.collect()]
    assert sorted(got, key=repr) == brute(rows, min_chars, min_docs)


def test_against_brute_force(spark):
    rnd = random.Random(5)
    pool = ["short", "ÉTÉ line", "été line", "A Line", "a line ", "\ta LINE\r", "", " ", "x" * 50, "ãline", "Ãline", "日本語の行です", "É", "ß-line"]
    for least in (2, 5):
        rows = [(i, "\n".join(rnd.choice(pool) for _ in range(rnd.randrange(6)))) for i in range(60)]
        check(spark, rows, 5, least)


def test_nulls_repeated_rows_and_long_texts(spark):
    rows = [(None, "common line"), (1, None), (2, ""), (3, "common line\nown line"), (3, "common line\nown line")]
    rows += [(3, "other text\ncommon line"), (4, "common line"), (5, "common line\n" * 3000), (6, "common line")]
    check(spark, rows)


def test_a_line_that_most_documents_hold(spark):
    check(spark, [(i, f"the common line\nown line {i}") for i in range(3000)], 5, 5)


def colliding_lines():
    """Two lines of 64 bytes with the same xxhash64: the fifth word makes up for another first one."""
    p1, p2 = np.uint64(0x9E3779B185EBCA87), np.uint64(0xC2B2AE3D27D4EB4F)
    back = np.uint64(pow(int(p2), -1, 2**64))
    chars = np.array([c for c in range(33, 127) if not 65 <= c <= 90], np.uint8)
    first = np.random.default_rng(1).choice(chars, (1_000_000, 8))
    with np.errstate(over="ignore"):
        sums = np.uint64(42) + p1 + p2 + first.view("<u8").ravel() * p2
        lane = ((sums << np.uint64(31)) | (sums >> np.uint64(33))) * p1
        fifth = np.frombuffer(b"abcdefgh", "<u8")[0] + (lane[0] - lane) * back
    fits = np.isin(fifth.view(np.uint8).reshape(-1, 8), chars).all(axis=1)
    other = np.flatnonzero(fits)[1]
    return [(first[k].tobytes() + b"-" * 24 + fifth[k].tobytes() + b"-" * 24).decode() for k in (0, other)]


def test_lines_that_collide_in_one_hash(spark):
    one, two = colliding_lines()
    frame = spark.createDataFrame([(one, two)], "a string, b string")
    assert one != two and frame.where(F.xxhash64("a") == F.xxhash64("b")).count() == 1
    check(spark, [(1, one), (2, one), (3, two)], 5, 3)


def test_empty_table(spark):
    check(spark, [])


def test_the_sort_streams_and_texts_stay_where_they_are(spark, monkeypatch):
    """Above the range exchange stands a sort by document and position; no exchange holds a text."""
    plans = []
    write = lines.stored

    def noted(df):
        plans.append(df._jdf.queryExecution().executedPlan().toString())
        return write(df)

    monkeypatch.setattr(lines, "stored", noted)
    docs = spark.createDataFrame([(i, f"the common line\nown line {i}") for i in range(50)], "doc_id long, text string")
    made = lines.line_bitmaps(docs, 5, 3)
    assert made.where("n_dropped > 0").count() == 49
    ranged = plans[1]
    window, sort, ranges = (ranged.index(x) for x in ("Window [", "Sort [a", "rangepartitioning(a"))
    assert window < sort < ranges and "doc_id" in ranged[sort:ranges].split("\n")[0]
    assert ranged.count("hashpartitioning(") == 1  # one row per hash and slot
    plan = made._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "Exchange hashpartitioning" not in plan


def test_a_document_counts_once_however_often_it_holds_a_line(spark):
    check(spark, [(1, "common line\n" * 9), (2, "common line\nown line\ncommon line")], 5, 3)
    check(spark, [(i, "common line\ncommon line") for i in range(3)], 5, 3)
