import random
from itertools import combinations

from custofold.llm import decontam


def words(n, seed):
    rnd = random.Random(seed)
    return [f"w{rnd.randrange(10**6)}" for _ in range(n)]


def test_masks_hit_every_stretch():
    for least, masks in decontam.MASKS:
        upper = {13: 13, 10: 12, 5: 9}[least]
        for n in range(least, upper + 1):
            wrong = n - -(-decontam.PERCENT * n // 100)
            for bad in combinations(range(n), wrong):
                assert any(
                    not set(bad) & {o + m for m in mask} for mask in masks for o in range(n - mask[-1])
                ), (n, bad)


def found(spark, texts, items, **options):
    docs = spark.createDataFrame([(i, t, "x") for i, t in enumerate(texts)], "doc_id long, text string, item_id string")
    bench = spark.createDataFrame([(i, t, 1) for i, t in items], "item_id long, text string, doc_id int")
    return sorted(tuple(r)[:4] for r in decontam.overlaps(docs, bench, **options).collect())


def test_substituted_words_and_marks(spark):
    item, other = words(30, 1), words(9, 2)
    changed = ["zzz" if i % 6 == 3 else w for i, w in enumerate(item)]
    texts = [
        "a b " + " ".join(item).upper() + ". c",
        "q " + " ".join(changed),
        " ".join(item[:12]),
        " ".join(item[:13]) + " end",
        " ".join("zzz" if i % 3 else w for i, w in enumerate(item)),
        "x " + " ".join(w + "," for w in other) + " y",
        None,
        "",
        "| | " + " | ".join(item),
    ]
    items = [(7, " ".join(item)), (8, " ".join(other)), (9, "three words only"), (None, " ".join(words(20, 3))), (10, None)]
    want = [(0, 7, 2, 32), (1, 7, 1, 31), (3, 7, 0, 13), (5, 8, 1, 10), (8, 7, 2, 61)]
    assert found(spark, texts, items) == want
    assert found(spark, texts, items, block_bytes=300) == want


def test_clean_keeps_the_other_rows(spark):
    item = words(20, 1)
    docs = spark.createDataFrame([(1, " ".join(item)), (2, "fine"), (2, "fine"), (3, None)], "doc_id long, text string")
    bench = spark.createDataFrame([(1, " ".join(item))], "item_id long, text string")
    assert sorted(r["doc_id"] for r in decontam.clean(docs, bench).collect()) == [2, 2, 3]
    assert decontam.clean(docs.where("doc_id > 9"), bench).count() == 0
    assert decontam.clean(docs, bench.where("item_id > 9")).count() == 4
