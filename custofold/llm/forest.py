"""Near-duplicate documents by an LSH forest.

Every document has a MinHash signature. The forest holds several orders of it: in each tree the documents are
sorted by their signature read in that tree's order, all trees in one range-partitioned sort. Documents that
stand next to each other with a long common prefix are neighbours, and neighbours whose signatures agree well
are joined into families (connected components of neighbours). The prefix that is asked for is short, and a
crowded region is not cut off: each document only looks at its next neighbours, however many share its prefix.

A family is then searched exactly, on full shingle sets, in one task: its sets travel once. What the task
returns is a forest of links, not pairs. Inside a task the search compares blocks of documents with all others
and stops when everything outside the largest component was compared, so a family of copies costs few blocks.
A family too large for a task (``max_docs`` or ``max_shingles``) is searched in blocks instead: in every tree its
documents are sorted and cut into blocks that overlap by half, each of which is searched in the same way. The
fuller a region, the longer the prefix that the documents of a block share. Blocks of all trees chain the
copies of a very large family together. What they leave apart is then joined exactly: linked documents share one
of their rarest shingles (a prefix of the set, rarest first, as long as the rule may miss shingles), so documents of
different components are joined on those, bounded by the places of what they share, and verified on full sets.
So the rule holds in a family of any size. Exact copies (equal shingle sets) are one document throughout.

Two documents are linked if the intersection of their sets is at least ``percent`` hundredths of the union.

Defined cases: null and empty texts have an empty set and are linked with nothing; with fewer words than a
shingle has, all words are one shingle. Rows without ``doc_id`` are returned with a null component, kept and
linked with nothing. Rows that share a ``doc_id`` are judged one by one. Other columns are left behind.
Very long texts are compared on all their shingles. A pair that is exactly as similar as asked is linked; of equal
copies the smallest ``doc_id`` stays. An empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from custofold.llm.common import WordHashes, binaries, documents_of, mix, stored, trimmed, words_of
from custofold.llm.components import components

TREES, HASHES = 16, 48
#: Positions of the signature that every tree reads first; together they use each position once.
PREFIX = HASHES // TREES
NEIGHBOURS = 3
MAX_DOCS, MAX_SHINGLES = 4096, 4_000_000
BLOCK = 128
#: Holders of a shingle that one task pairs with all others.
HOLDERS = 2048


def shingles(words: list[bytes], size: int, hashes: WordHashes) -> np.ndarray:
    """The distinct shingles of a text as sorted 64-bit hashes."""
    if not words:
        return np.empty(0, np.uint64)
    own = hashes(words)
    size = min(size, len(words))
    found = np.full(len(words) - size + 1, size, np.uint64)
    for k in range(size):
        found = mix(found * np.uint64(0x9E3779B97F4A7C15) + own[k : len(own) - size + 1 + k])
    return np.unique(found)


def tree_order(tree: int) -> np.ndarray:
    """The order in which a tree reads a signature: its own first positions, then the others in a fixed shuffle."""
    own = np.arange(tree * PREFIX, (tree + 1) * PREFIX)
    rest = np.setdiff1d(np.arange(HASHES), own)
    return np.concatenate([own, np.random.default_rng(tree).permutation(rest)])


def _pairs_of_sets(own: np.ndarray) -> tuple[int, int]:
    """A 128-bit print of a set."""
    import xxhash

    raw = own.tobytes()
    return xxhash.xxh3_64_intdigest(raw) - 2**63, xxhash.xxh64_intdigest(raw) - 2**63


def signatures(docs: DataFrame, words: int) -> DataFrame:
    """``doc_id``, size and print of the shingle set, and the signature (32-bit values, packed)."""
    salts = mix(np.arange(1, HASHES + 1, dtype=np.uint64))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = WordHashes()
        for batch in batches:
            sizes, high, low, packed = [], [], [], []
            for text in words_of(batch.column("text")):
                own = shingles(text, words, hashes)
                sizes.append(len(own))
                a, b = _pairs_of_sets(own)
                high.append(a)
                low.append(b)
                packed.append(signature(own, salts).tobytes() if len(own) else b"")
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(sizes, pa.int64()), pa.array(high), pa.array(low), binaries(packed)],
                names=["doc_id", "n_shingles", "high", "low", "sig"],
            )

    kind = docs.schema["doc_id"].dataType.simpleString()
    return documents_of(docs).mapInArrow(trimmed(run), f"doc_id {kind}, n_shingles long, high long, low long, sig binary")


def signature(own: np.ndarray, salts: np.ndarray) -> np.ndarray:
    """The upper 32 bits of the smallest value that each hash function gives to the set."""
    out = np.empty(len(salts), np.uint32)
    for begin in range(0, len(salts), 16):
        part = own[None, :] * (salts[begin : begin + 16, None] | np.uint64(1))
        part ^= part >> np.uint64(29)
        part *= np.uint64(0xBF58476D1CE4E5B9)
        out[begin : begin + 16] = (part.min(axis=1) >> np.uint64(32)).astype(np.uint32)
    return out


def tree_rows(distinct: DataFrame) -> DataFrame:
    """One row per document and tree: ``place`` (tree and prefix), ``order`` (a byte of each value in tree order)."""
    orders = [tree_order(t) for t in range(TREES)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column("doc_id").to_numpy(zero_copy_only=False)
            if not len(ids):
                continue
            sig = np.stack([np.frombuffer(b, np.uint32) for b in batch.column("sig").to_pylist()])
            bytes_of = (sig & np.uint32(255)).astype(np.uint8)
            for tree, order in enumerate(orders):
                place = np.full(len(ids), tree + 1, np.uint64)
                for k in order[:PREFIX]:
                    place = mix(place * np.uint64(31) + sig[:, k])
                read = np.ascontiguousarray(bytes_of[:, order[PREFIX:]])
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(place.view(np.int64)),
                        binaries([r.tobytes() for r in read]),
                        pa.array(ids),
                    ],
                    names=["place", "order", "doc_id"],
                )

    return distinct.mapInArrow(trimmed(run), "place long, order binary, doc_id long")


def neighbour_links(rows: DataFrame, agree: float) -> DataFrame:
    """Links of documents that stand near each other in a sorted range, share its prefix, and agree well."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place, ids = np.empty(0, np.int64), np.empty(0, np.int64)
        read = np.empty((0, HASHES - PREFIX), np.uint8)
        for batch in batches:
            if not batch.num_rows:
                continue
            place = np.concatenate([place, batch.column("place").to_numpy(zero_copy_only=False)])
            ids = np.concatenate([ids, batch.column("doc_id").to_numpy(zero_copy_only=False)])
            fresh = np.frombuffer(b"".join(batch.column("order").to_pylist()), np.uint8)
            read = np.concatenate([read, fresh.reshape(-1, HASHES - PREFIX)])
            for step in range(1, NEIGHBOURS + 1):
                near = np.flatnonzero(place[step:] == place[:-step])
                same = (read[near] == read[near + step]).sum(axis=1) + PREFIX
                near = near[same >= agree * HASHES]
                yield pa.RecordBatch.from_arrays([pa.array(ids[near]), pa.array(ids[near + step])], names=["a", "b"])
            place, ids, read = place[-NEIGHBOURS:], ids[-NEIGHBOURS:], read[-NEIGHBOURS:]

    return rows.mapInArrow(run, "a long, b long")


def family_links(ids: np.ndarray, sets: list[np.ndarray], percent: int) -> list[tuple[int, int]]:
    """Links that connect exactly the documents of a family that the linking rule connects.

    Every document outside the largest component is compared with all others; two documents inside it need no
    comparison. Counts of common shingles come from lists of the documents that hold each shingle.
    """
    n = len(ids)
    sizes = np.array([len(s) for s in sets])
    values, code = np.unique(np.concatenate(sets), return_inverse=True)
    owner = np.repeat(np.arange(n), sizes)
    by_code = np.argsort(code, kind="stable")
    holders, begins = owner[by_code], np.searchsorted(code[by_code], np.arange(len(values) + 1))
    starts = np.concatenate([[0], np.cumsum(sizes)])
    label = np.arange(n)
    compared = np.zeros(n, bool)
    links = []
    while True:
        largest = np.bincount(label, minlength=n).argmax()
        todo = np.flatnonzero(~compared & (label != largest))
        if not compared.any():
            todo = np.arange(n)
        if not len(todo):
            return links
        for x in todo[:BLOCK]:
            compared[x] = True
            own = code[starts[x] : starts[x + 1]]
            lists = [holders[begins[c] : begins[c + 1]] for c in own]
            common = np.bincount(np.concatenate(lists), minlength=n)
            near = np.flatnonzero(100 * common >= percent * (sizes + sizes[x] - common))
            for y in near[label[near] != label[x]]:
                if label[y] != label[x]:
                    low, high = sorted((label[x], label[y]))
                    label[label == high] = low
                    links.append((int(ids[x]), int(ids[y])))


def search_groups(members: DataFrame, docs: DataFrame, words: int, percent: int) -> DataFrame:
    """Links inside every group (``grp``, ``doc_id``), searched on full sets; a group fits into a task."""

    def sets_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = WordHashes()
        for batch in batches:
            packed = [shingles(w, words, hashes).tobytes() for w in words_of(batch.column("text"))]
            yield pa.RecordBatch.from_arrays(
                [batch.column("grp"), batch.column("doc_id"), binaries(packed)], names=["grp", "doc_id", "own"]
            )

    def search(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.drop_duplicates("doc_id").sort_values("doc_id")
        sets = [np.frombuffer(b, np.uint64) for b in frame["own"]]
        found = family_links(frame["doc_id"].to_numpy(), sets, percent)
        return pd.DataFrame(found, columns=["a", "b"], dtype="int64")

    # A shuffle join at every size: adaptive execution would broadcast small memberships and shuffle large ones.
    return (
        documents_of(docs)
        .hint("merge")
        .join(members, "doc_id")
        .select("grp", "doc_id", "text")
        .mapInArrow(trimmed(sets_of), "grp string, doc_id long, own binary")
        .groupBy("grp")
        .applyInPandas(search, "a long, b long")
    )


def overlapping_blocks(rows: DataFrame, max_docs: int, max_shingles: int) -> DataFrame:
    """Blocks (``grp``) of documents that stand together in a tree, each document in two that overlap.

    The depth adapts to the region: the fuller it is, the longer the prefix that the documents of a block share.
    Rows come sorted by family, place and order; a block holds half of what a task may take from either side.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task = TaskContext.get().partitionId()
        region, block, docs, size = None, 0, 0, 0
        for batch in batches:
            groups, ids = [], []
            columns = [batch.column(n).to_pylist() for n in ("family", "place", "doc_id", "n_shingles")]
            for family, place, doc, n in zip(*columns, strict=True):
                if region != (family, place):
                    region, block, docs, size = (family, place), 0, 0, 0
                elif docs + 1 > max_docs // 2 or size + n > max_shingles // 2:
                    block, docs, size = block + 1, 0, 0
                docs, size = docs + 1, size + n
                groups += [f"{family}.{place}.{task}.{block}", f"{family}.{place}.{task}.{block + 1}"]
                ids += [doc, doc]
            yield pa.RecordBatch.from_arrays([pa.array(groups, pa.string()), pa.array(ids, pa.int64())], names=["grp", "doc_id"])

    return rows.mapInArrow(run, "grp string, doc_id long")


def sized_families(members: DataFrame, max_docs: int, max_shingles: int) -> DataFrame:
    """The members, and whether their family fits into a task (``fit``)."""
    fits = members.groupBy("family").agg(
        ((F.count(F.lit(1)) <= max_docs) & (F.sum("n_shingles") <= max_shingles)).alias("fit")
    )
    return stored(members.join(fits, "family"))


def fitting_groups(sized: DataFrame, trees: DataFrame, max_docs: int, max_shingles: int) -> DataFrame:
    """Families that fit into a task as they are; the others in blocks of every tree.

    ``sized`` has ``family``, ``doc_id``, ``n_shingles`` and ``fit``; ``trees`` the rows of ``tree_rows``.
    """
    whole = sized.where("fit").select(F.col("family").cast("string").alias("grp"), "doc_id")
    rest = sized.where("NOT fit").select("family", "doc_id", "n_shingles").join(trees, "doc_id")
    ranges = int(sized.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    order = ["family", "place", "order", "doc_id"]
    dealt = rest.repartitionByRange(ranges, *order[:3]).sortWithinPartitions(*order)
    return whole.unionByName(overlapping_blocks(dealt, max_docs, max_shingles))


def links_across(members: DataFrame, docs: DataFrame, words: int, percent: int) -> DataFrame:
    """All links of two documents of one family with different labels (``family``, ``doc_id``, ``label``).

    A document has ``percent`` hundredths of its shingles at least in common with one that it is linked with, so
    the two share a shingle among the rarest of either, if those are one more than the others. No family,
    shingle or document has to fit into a task: holders of a shingle meet in salted parts.
    """

    def sets_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = WordHashes()
        for batch in batches:
            packed = [shingles(w, words, hashes).tobytes() for w in words_of(batch.column("text"))]
            named = [batch.column(n) for n in ("family", "label", "doc_id")]
            yield pa.RecordBatch.from_arrays([*named, binaries(packed)], names=["family", "label", "doc_id", "own"])

    def rows_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            named = [batch.column(n).to_numpy(zero_copy_only=False) for n in ("family", "label", "doc_id")]
            for k, packed in enumerate(batch.column("own").to_pylist()):
                own = np.frombuffer(packed, np.int64)
                columns = [np.full(len(own), c[k]) for c in named]
                yield pa.RecordBatch.from_arrays(
                    [*map(pa.array, columns), pa.array(np.full(len(own), len(own))), pa.array(own)],
                    names=["family", "label", "doc_id", "n", "shingle"],
                )

    def verified(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            linked = []
            for x, y in zip(batch.column("own_a").to_pylist(), batch.column("own_b").to_pylist(), strict=True):
                x, y = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
                common = len(np.intersect1d(x, y, assume_unique=True))
                linked.append(100 * common >= percent * (len(x) + len(y) - common))
            yield batch.select(["a", "b"]).filter(pa.array(linked, pa.bool_()))

    read = documents_of(docs).hint("merge").join(members, "doc_id").select("family", "label", "doc_id", "text")
    sets = read.mapInArrow(trimmed(sets_of), "family long, label long, doc_id long, own binary")
    own = stored(sets.groupBy("doc_id").agg(F.min(F.struct("own", "family", "label")).alias("x")).select("doc_id", "x.*"))
    held = own.mapInArrow(rows_of, "family long, label long, doc_id long, n long, shingle long")
    known = held.groupBy("family", "shingle").agg(
        F.count(F.lit(1)).alias("holders"), (F.min("label") < F.max("label")).alias("across")
    )
    rarest = Window.partitionBy("doc_id").orderBy("holders", "shingle")
    ranked = held.join(known, ["family", "shingle"]).withColumn("at", F.row_number().over(rarest))
    begins = stored(ranked.where(f"across AND at <= n - ({percent} * n + 99) div 100 + 1"))
    parts = F.ceil(F.col("holders") / HOLDERS).cast("int")

    def side(name: str, salt: Column) -> DataFrame:
        named = [F.col(c).alias(f"{c}_{name}") for c in ("label", "n", "at")]
        return begins.select("family", "shingle", F.col("doc_id").alias(name), *named, salt.alias("salt"))

    met = side("a", F.pmod(F.xxhash64("doc_id"), parts).cast("int")).join(
        side("b", F.explode(F.sequence(F.lit(0), parts - 1))), ["family", "shingle", "salt"]
    )
    pairs = (
        met.where(f"a < b AND label_a <> label_b AND 100 * least(n_a, n_b) >= {percent} * greatest(n_a, n_b)")
        .groupBy("a", "b", "n_a", "n_b")
        .agg(F.count(F.lit(1)).alias("c"), F.max("at_a").alias("at_a"), F.max("at_b").alias("at_b"))
        # Beyond the last shingle that they share here, they share no more than either has left.
        .where(f"{100 + percent} * (c + least(n_a - at_a, n_b - at_b)) >= {percent} * (n_a + n_b)")
        .select("a", "b")
    )
    first, second = (own.select(F.col("doc_id").alias(x), F.col("own").alias(f"own_{x}")) for x in "ab")
    return pairs.join(first, "a").join(second, "b").select("a", "b", "own_a", "own_b").mapInArrow(verified, "a long, b long")


def near_duplicates(
    docs: DataFrame,
    words: int = 5,
    percent: int = 80,
    max_docs: int = MAX_DOCS,
    max_shingles: int = MAX_SHINGLES,
) -> DataFrame:
    """``doc_id``, ``n_shingles``, ``component_id`` (smallest document that links lead to) and ``kept``."""
    rows = stored(signatures(docs, words))
    filled = rows.where("n_shingles > 0 AND doc_id IS NOT NULL")
    classes = filled.groupBy("high", "low").agg(F.min(F.struct(F.col("doc_id").cast("long").alias("doc_id"), "n_shingles", "sig")).alias("first"))
    distinct = stored(classes.select("high", "low", "first.*"))
    ranges = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    trees = tree_rows(distinct.select("doc_id", "sig"))
    ordered = trees.repartitionByRange(ranges, "place", "order").sortWithinPartitions("place", "order", "doc_id")
    families = components(neighbour_links(ordered, percent / 100 - 0.25))
    named = families.select(F.col("node").alias("doc_id"), F.col("component").alias("family"))
    heads = families.select(F.col("component").alias("doc_id"), F.col("component").alias("family")).distinct()
    members = stored(named.unionByName(heads).join(distinct.select("doc_id", "n_shingles"), "doc_id"))
    sized = sized_families(members, max_docs, max_shingles)
    groups = fitting_groups(sized, trees, max_docs, max_shingles)
    named_docs = docs.where("doc_id IS NOT NULL")
    links = search_groups(groups, named_docs, words, percent)
    large = sized.where("NOT fit").select("family", "doc_id")
    if large.isEmpty():
        merged = components(links)
    else:
        links = stored(links)
        labels = components(links).select(F.col("node").alias("doc_id"), F.col("component"))
        labelled = large.distinct().join(labels, "doc_id", "left").select(
            "family", "doc_id", F.coalesce("component", "doc_id").alias("label")
        )
        merged = components(links.unionByName(links_across(labelled, named_docs, words, percent)))
    reached = distinct.select("high", "low", F.col("doc_id").alias("node")).join(merged, "node", "left").select(
        "high", "low", F.coalesce("component", "node").alias("found")
    )
    component: Column = F.when(F.col("n_shingles") > 0, F.col("found")).otherwise(F.col("doc_id").cast("long"))
    out = rows.drop("sig").join(reached, ["high", "low"], "left")
    return out.select(
        "doc_id",
        "n_shingles",
        F.when(F.col("doc_id").isNotNull(), component).alias("component_id"),
        (F.col("doc_id").isNull() | (F.col("doc_id") == component)).alias("kept"),
    )


def dedup(docs: DataFrame, words: int = 5, percent: int = 80) -> DataFrame:
    """The rows of the smallest document of every component; rows that share its ``doc_id`` stay alike."""
    gone = near_duplicates(docs, words, percent).where("NOT kept").select("doc_id").distinct()
    return docs.hint("merge").join(gone, "doc_id", "left_anti")
