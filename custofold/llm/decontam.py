"""Benchmark decontamination by spaced seeds.

Words are lower-cased and stripped of marks at their ends. A seed is a hash of words at the fixed places of a
mask; the places in between may differ. Seeds of the benchmark are joined with the seeds of the documents;
every hit names a diagonal (place in the document minus place in the item), and the item is compared word by
word along it. A document overlaps an item if, in some stretch of ``window`` words (the whole item, if it is
shorter), at least ``percent`` hundredths of the words agree. For each length of item the masks below hit every
such stretch whatever the places of the differing words (checked by a test), so the join loses nothing.

The benchmark is measured and taken in blocks below ``block_bytes``; each block is broadcast and joined in the
map task that reads the documents, so texts are never shuffled, whatever the size of the benchmark.

Defined cases: null and empty texts overlap nothing. Items of fewer than five words are no evidence and take
no part. Words that consist of marks only are passed over. Repeated rows are judged alike. A null ``item_id``
is reported as null. Other columns of the documents are kept by ``mark``; ``leaks`` is replaced.
A very long text is searched to its end. Overlaps with several items, or several in one place, are all
reported. No documents give no rows; without items nothing overlaps.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from custofold.llm.common import mix, trimmed, words_of

WINDOW, PERCENT = 13, 80
LEAST_WORDS = 5
BLOCK_BYTES = 16_000_000
#: By the least number of words of an item: masks that hit every stretch of that length at 80 percent.
MASKS = (
    (13, ((0, 1, 2, 4, 6, 7), (0, 1, 4, 5, 6, 7))),
    (10, ((0, 1, 2, 4, 5), (0, 1, 3, 6, 7), (0, 1, 2, 3, 4))),
    (5, ((0, 1, 2), (0, 1, 3))),
)
EDGES = re.compile(r"^[\W_]+|[\W_]+$")
LEAKS = T.ArrayType(
    T.StructType(
        [
            T.StructField("item_id", T.LongType()),
            T.StructField("start_word", T.LongType()),
            T.StructField("end_word", T.LongType()),
            T.StructField("matched", T.LongType()),
            T.StructField("similarity", T.DoubleType()),
        ]
    )
)


def normal(word: bytes) -> str:
    return EDGES.sub("", word.decode("utf-8", "replace").lower())


@dataclass
class Seeds:
    """The items of one block: word numbers, and the sorted seeds of every mask that they need."""

    ids: list
    vocabulary: dict[str, int]
    items: list[np.ndarray]
    tables: list[tuple[tuple[int, ...], np.ndarray, np.ndarray, np.ndarray]]
    window: int
    percent: int

    @staticmethod
    def of(rows: list[tuple], window: int = WINDOW, percent: int = PERCENT) -> Seeds:
        vocabulary: dict[str, int] = {}
        ids, items = [], []
        for item_id, text in rows:
            found = [w for w in map(normal, (text or "").encode().split()) if w]
            if len(found) >= LEAST_WORDS:
                ids.append(item_id)
                items.append(np.array([vocabulary.setdefault(w, len(vocabulary) + 1) for w in found], np.int64))
        tables = []
        upper = np.inf
        for least, masks in MASKS:
            chosen = [i for i, item in enumerate(items) if least <= len(item) < upper]
            upper = least
            for mask in masks if chosen else ():
                parts = [seed_hashes(items[i], mask) for i in chosen]
                hashes = np.concatenate(parts)
                owner = np.repeat(chosen, [len(p) for p in parts])
                place = np.concatenate([np.arange(len(p)) for p in parts])
                order = np.argsort(hashes, kind="stable")
                tables.append((mask, hashes[order], owner[order], place[order]))
        return Seeds(ids, vocabulary, items, tables, window, percent)


def seed_hashes(words: np.ndarray, mask: tuple[int, ...]) -> np.ndarray:
    """The seed at every place where the mask fits; 0 where a chosen word is unknown (number 0)."""
    n = len(words) - mask[-1]
    if n <= 0:
        return np.empty(0, np.uint64)
    out = np.zeros(n, np.uint64)
    known = np.ones(n, bool)
    for m in mask:
        part = words[m : m + n]
        known &= part > 0
        out = mix(out * np.uint64(31) + part.astype(np.uint64))
    out[~known] = 0
    return out


class Matcher:
    """Finds overlaps of texts with the items of a block."""

    def __init__(self, seeds: Seeds):
        self.seeds = seeds
        self.numbers: dict[bytes, int] = {}
        # A bit per seed hash: most places of a document end here.
        self.sieves = []
        for _, hashes, _, _ in seeds.tables:
            sieve = np.zeros(1 << 20, bool)
            sieve[hashes & np.uint64((1 << 20) - 1)] = True
            self.sieves.append(sieve)

    def number(self, words: list[bytes]) -> np.ndarray:
        """Numbers of words: 0 for one that no item has, -1 for marks only."""
        known = self.numbers
        if len(known) > 250_000:
            known.clear()
        try:
            return np.fromiter(map(known.__getitem__, words), np.int64, len(words))
        except KeyError:
            for w in words:
                if w not in known:
                    plain = normal(w)
                    known[w] = self.seeds.vocabulary.get(plain, 0) if plain else -1
            return np.fromiter(map(known.__getitem__, words), np.int64, len(words))

    def overlaps(self, words: list[bytes]) -> list[tuple]:
        """(item, first word, end word, words that agree, share of the stretch) of every overlap."""
        numbers = self.number(words)
        where = np.flatnonzero(numbers >= 0)
        numbers = numbers[where]
        found = set()
        for (mask, hashes, owner, place), sieve in zip(self.seeds.tables, self.sieves, strict=True):
            own = seed_hashes(numbers, mask)
            maybe = np.flatnonzero(sieve[own & np.uint64((1 << 20) - 1)] & (own != 0))
            if not len(maybe):
                continue
            low, high = np.searchsorted(hashes, own[maybe], "left"), np.searchsorted(hashes, own[maybe], "right")
            for at, a, b in zip(maybe.tolist(), low.tolist(), high.tolist(), strict=True):
                for k in range(a, b):
                    found.add((int(owner[k]), at - int(place[k])))
        out = []
        for item, diagonal in sorted(found):
            span = self.verify(numbers, item, diagonal)
            if span:
                begin, end, matched = span
                out.append(
                    (self.seeds.ids[item], int(where[begin]), int(where[end - 1]) + 1, matched, matched / (end - begin))
                )
        return out

    def verify(self, numbers: np.ndarray, item: int, diagonal: int) -> tuple[int, int, int] | None:
        words = self.seeds.items[item]
        window = min(self.seeds.window, len(words))
        same = np.zeros(len(words), bool)
        begin, end = max(0, -diagonal), min(len(words), len(numbers) - diagonal)
        if end - begin < window:
            return None
        same[begin:end] = words[begin:end] == numbers[begin + diagonal : end + diagonal]
        sums = np.concatenate([[0], np.cumsum(same)])
        starts = np.arange(begin, end - window + 1)
        good = starts[100 * (sums[starts + window] - sums[starts]) >= self.seeds.percent * window]
        if not len(good):
            return None
        inside = np.flatnonzero(same[good[0] : good[-1] + window]) + good[0]
        first, last = int(inside[0]), int(inside[-1]) + 1
        return first + diagonal, last + diagonal, len(inside)


def blocks_of(benchmark: DataFrame, block_bytes: int = BLOCK_BYTES) -> Iterator[list[tuple]]:
    """The items in blocks whose texts stay below the given size (or hold one item)."""
    items = benchmark.select(F.col("item_id").cast("long").alias("item_id"), F.coalesce("text", F.lit("")).alias("text"))
    total = items.agg(F.sum(F.octet_length("text")).alias("b")).first()["b"] or 0
    count = 1 + 2 * total // block_bytes
    for k in range(count):
        yield [tuple(r) for r in items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(count)) == k).collect()]


def mark(
    docs: DataFrame,
    benchmark: DataFrame,
    window: int = WINDOW,
    percent: int = PERCENT,
    block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """The rows with ``leaks``: all overlaps with benchmark items (an empty array if there are none)."""
    kept = [f for f in docs.schema.fields if f.name != "leaks"]
    names = [f.name for f in kept]
    schema = T.StructType([*kept, T.StructField("leaks", LEAKS)])
    kind = pa.list_(
        pa.struct(
            [
                ("item_id", pa.int64()),
                ("start_word", pa.int64()),
                ("end_word", pa.int64()),
                ("matched", pa.int64()),
                ("similarity", pa.float64()),
            ]
        )
    )
    fields = [kind.value_type.field(i).name for i in range(5)]
    out = docs.select(*names).withColumn("leaks", F.array().cast(LEAKS))
    for rows in blocks_of(benchmark, block_bytes):
        sent = docs.sparkSession.sparkContext.broadcast(Seeds.of(rows, window, percent))

        def run(batches: Iterator[pa.RecordBatch], sent=sent) -> Iterator[pa.RecordBatch]:
            matcher = Matcher(sent.value)
            for batch in batches:
                before = batch.column("leaks").to_pylist()
                found = [
                    [*old, *(dict(zip(fields, o, strict=True)) for o in matcher.overlaps(words))]
                    for old, words in zip(before, words_of(batch.column("text").fill_null("")), strict=True)
                ]
                yield pa.RecordBatch.from_arrays(
                    [*(batch.column(n) for n in names), pa.array(found, kind)], names=[*names, "leaks"]
                )

        out = out.mapInArrow(trimmed(run), schema)
    return out


def overlaps(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """One row per document and overlap: ``doc_id``, ``item_id``, the words from ``start_word`` up to ``end_word``."""
    marked = mark(docs.select("doc_id", "text"), benchmark, **options)
    return marked.select("doc_id", F.inline("leaks"))


def clean(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """The rows that overlap no benchmark item."""
    return mark(docs, benchmark, **options).where(F.size("leaks") == 0).drop("leaks")
