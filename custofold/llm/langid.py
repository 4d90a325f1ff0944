"""Language identification by prediction by partial matching over bytes.

For every language the training texts give a byte context tree: how often each byte follows each context of 0
to ``order`` bytes. A text is scored by its exact code length under those frozen counts: a byte that was seen
after the longest context costs -log2(c / (n + u)) (c times the byte, n all bytes, u kinds of bytes after this
context); otherwise the escape -log2(u / (n + u)) is paid and the next shorter context decides, down to a
uniform byte. The language with the shortest code wins; the score is its share when all learned languages are
equally likely beforehand.

Counts cover every byte of every training text, and none is cut. They are a Spark table; where it has more than
``max_grams`` rows it is broadcast in blocks, and each text is passed over once for each. A block holds whole
ranges of the two bytes before the last one: all strings and contexts of two bytes or more that a byte is looked
up in share those, and the counts of shorter ones are in every block. So each byte is scored in one block, and
exactly.

Defined cases: null texts and texts without a letter are ``und`` with score 0, as is every text if nothing was
learned. Ties go to the first language by name. Rows without language train nothing. Repeated rows train as
often as they occur. Very long texts are scored on all their bytes. An empty table gives no rows. Other columns are kept; ``lang_pred`` and ``score`` are replaced.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from custofold.llm.common import stored, texts, trimmed

UNDECIDED = "und"
ORDER = 3
#: Rows of a block of the table of counts.
MAX_GRAMS = 2_000_000
PIECE_BYTES = 1_000_000


def gram_codes(data: np.ndarray, starts: np.ndarray, order: int) -> np.ndarray:
    """For every byte the code of itself and the ``order`` bytes before it; before a text there are line ends."""
    padded = np.full(len(data) + order * len(starts), 10, np.uint8)
    lengths = np.diff(np.append(starts, len(data)))
    where = np.arange(len(data)) + np.repeat(order * np.arange(1, len(starts) + 1), lengths)
    padded[where] = data
    code = np.zeros(len(data), np.int64)
    for back in range(order, -1, -1):
        code = (code << 8) | padded[where - back]
    return code


def count_grams(docs: DataFrame, lang: str, order: int = ORDER) -> DataFrame:
    """How often each string of ``order`` + 1 bytes occurs in the texts of each language."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            langs = batch.column("lang").dictionary_encode()
            names = langs.dictionary.to_pylist()
            which = langs.indices.to_numpy(zero_copy_only=False)
            data, offsets = texts(batch.column("text"))
            starts, lengths = offsets[:-1], np.diff(offsets)
            for begin, end in pieces(offsets):
                part = data[offsets[begin] : offsets[end]]
                codes = gram_codes(part, starts[begin:end] - offsets[begin], order)
                owner = np.repeat(which[begin:end], lengths[begin:end])
                found = pd.Series(codes * len(names) + owner).value_counts(sort=False)
                key = found.index.to_numpy()
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([names[i] for i in (key % len(names)).tolist()], pa.string()),
                        pa.array(key // len(names)),
                        pa.array(found.to_numpy()),
                    ],
                    names=["lang", "gram", "n"],
                )

    rows = docs.select(F.col(lang).cast("string").alias("lang"), "text").where("lang IS NOT NULL AND text IS NOT NULL")
    return (
        rows.mapInArrow(trimmed(run), "lang string, gram long, n long")
        .groupBy("lang", "gram")
        .agg(F.sum("n").alias("n"))
    )


def pieces(offsets: np.ndarray) -> Iterator[tuple[int, int]]:
    """Row ranges of about ``PIECE_BYTES`` bytes, one row at least."""
    begin, rows = 0, len(offsets) - 1
    while begin < rows:
        end = int(np.searchsorted(offsets, offsets[begin] + PIECE_BYTES, side="right")) - 1
        end = min(max(end, begin + 1), rows)
        yield begin, end
        begin = end


#: Counts as arrays: number of the language, string, how often it occurs.
Counts = tuple[np.ndarray, np.ndarray, np.ndarray]


class ContextTrees:
    """Code lengths of all learned languages, from the counts of strings of ``order`` + 1 bytes.

    A block has the strings whose two bytes before the last are in ``part`` (first and last, as a number), and in
    ``short`` the counts of all strings of two bytes.
    """

    def __init__(
        self, langs: list[str], known: Counts, order: int, part: tuple[int, int] | None = None, short: Counts | None = None
    ):
        self.langs, self.order, self.part = langs, order, part
        k = len(langs)
        self.levels = []  # per order: known strings, their bits; known contexts, bits of an escape
        for size in range(order + 1):
            lang, gram, n = short if short is not None and size < 2 else known
            code = gram & ((1 << 8 * (size + 1)) - 1)  # the last size + 1 bytes
            strings, at = np.unique(code, return_inverse=True)
            counts = np.zeros((len(strings), k))
            np.add.at(counts, (at, lang), n)
            contexts, owner = np.unique(strings >> 8, return_inverse=True)
            total, kinds = np.zeros((2, len(contexts), k))
            np.add.at(total, owner, counts)
            np.add.at(kinds, owner, counts > 0)
            with np.errstate(divide="ignore", invalid="ignore"):
                escape = np.where(total > 0, -np.log2(kinds / (total + kinds)), 0.0)
                seen = -np.log2(counts / (total + kinds)[owner])
            shorter = np.full((len(strings), k), 8.0) if size == 0 else self.bits(strings & ((1 << 8 * size) - 1), size - 1)
            bits = np.where(counts > 0, seen, escape[owner] + shorter)
            self.levels.append((pd.Index(strings), bits.astype(np.float32), pd.Index(contexts), escape.astype(np.float32)))

    def bits(self, code: np.ndarray, size: int) -> np.ndarray:
        """Bits of the last byte of each code after the ``size`` bytes before it, for every language."""
        strings, known, contexts, escape = self.levels[size]
        at = strings.get_indexer(code)
        out = known[at]
        miss = np.flatnonzero(at < 0)
        if len(miss):
            missing = code[miss]
            where = contexts.get_indexer(missing >> 8)
            paid = np.where((where >= 0)[:, None], escape[where], 0.0)
            if size:
                paid = paid + self.bits(missing & ((1 << 8 * size) - 1), size - 1)
            else:
                paid = paid + 8.0
            out[miss] = paid
        return out

    def lengths(self, data: np.ndarray, starts: np.ndarray) -> np.ndarray:
        """Bits of every text under every language; of a block, those of the bytes that it is to score."""
        out = np.zeros((len(starts), len(self.langs)))
        filled = np.flatnonzero(np.diff(np.append(starts, len(data))) > 0)
        if len(filled):
            codes = gram_codes(data, starts, self.order)
            if self.part is None:
                bits = self.bits(codes, self.order)
            else:
                middle = (codes >> 8) & 0xFFFF
                own = np.flatnonzero((middle >= self.part[0]) & (middle <= self.part[1]))
                bits = np.zeros((len(codes), len(self.langs)), np.float32)
                bits[own] = self.bits(codes[own], self.order)
            out[filled] = np.add.reduceat(bits, starts[filled], axis=0, dtype=np.float64)
        return out


def middle_bytes() -> Column:
    """The two bytes before the last one of a string, as a number."""
    return F.shiftright("gram", 8).bitwiseAND(0xFFFF)


@dataclass
class Model:
    """The stored counts, and how they are cut into blocks; a block comes to the driver when it is asked for."""

    counted: DataFrame
    langs: list[str]
    order: int
    parts: list[tuple[int, int]]

    def counts(self, rows: DataFrame) -> Counts:
        found = rows.select("lang", "gram", "n").toArrow()
        lang = pd.Index(self.langs).get_indexer(found.column("lang").to_pandas())
        return lang, found.column("gram").to_numpy(), found.column("n").to_numpy()

    def blocks(self) -> Iterator[ContextTrees]:
        if len(self.parts) < 2:
            yield ContextTrees(self.langs, self.counts(self.counted), self.order)
            return
        two = F.col("gram").bitwiseAND(0xFFFF).alias("gram")
        short = self.counts(self.counted.groupBy("lang", two).agg(F.sum("n").alias("n")))  # 65,536 a language at most
        for part in self.parts:
            yield ContextTrees(self.langs, self.counts(self.counted.where(middle_bytes().between(*part))), self.order, part, short)

    def lengths(self, data: np.ndarray, starts: np.ndarray) -> np.ndarray:
        """Bits of every text under every language."""
        return sum(trees.lengths(data, starts) for trees in self.blocks())


def train(docs: DataFrame, lang: str = "lang", order: int = ORDER, max_grams: int = MAX_GRAMS) -> Model:
    """The counts of every value of ``lang``, in blocks of at most ``max_grams`` rows or one pair of bytes."""
    counted = stored(count_grams(docs, lang, order))
    names = sorted(r["lang"] for r in counted.select("lang").distinct().collect())
    sizes = counted.groupBy(middle_bytes().alias("middle")).count().orderBy("middle").collect()  # 65,536 rows at most
    parts, held = [], 0
    for r in sizes:
        if not parts or held + r["count"] > max_grams:
            parts.append(r["middle"])
            held = 0
        held += r["count"]
    # The first block goes from 0 and the last to the end, so that bytes that no block knows are scored, too.
    begins = [0, *parts[1:]]
    return Model(counted, names, order, list(zip(begins, [*(b - 1 for b in begins[1:]), 0xFFFF], strict=True)))


def predict(docs: DataFrame, learned: Model) -> DataFrame:
    """The rows with ``lang_pred`` and ``score``."""
    kept = [f for f in docs.schema.fields if f.name not in ("lang_pred", "score")]
    names = [f.name for f in kept]
    bits_type = T.ArrayType(T.DoubleType())
    summed = T.StructType([*kept, T.StructField("__bits", bits_type)])
    schema = T.StructType([*kept, T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())])
    scored, blocks = docs.select(*names), len(learned.parts)
    for number, trees in enumerate(learned.blocks()):
        model = docs.sparkSession.sparkContext.broadcast(trees)
        first, last = number == 0, number == blocks - 1

        def run(batches: Iterator[pa.RecordBatch], model=model, first=first, last=last) -> Iterator[pa.RecordBatch]:
            own = model.value
            labels = np.array(own.langs, object)
            for batch in batches:
                data, offsets = texts(batch.column("text").fill_null(""))
                bits = np.zeros((batch.num_rows, len(labels)))
                if not first:
                    bits += batch.column("__bits").flatten().to_numpy().reshape(bits.shape)
                if len(labels):
                    for begin, end in pieces(offsets):
                        part = data[offsets[begin] : offsets[end]]
                        bits[begin:end] += own.lengths(part, offsets[begin:end] - offsets[begin])
                rows = [batch.column(n) for n in names]
                if not last:
                    ends = np.arange(batch.num_rows + 1, dtype=np.int32) * len(labels)
                    lists = pa.ListArray.from_arrays(pa.array(ends), pa.array(bits.ravel()))
                    yield pa.RecordBatch.from_arrays([*rows, lists], names=[*names, "__bits"])
                    continue
                best, score = np.zeros(batch.num_rows, np.int64), np.zeros(batch.num_rows)
                if len(labels) and batch.num_rows:
                    more = bits - bits.min(axis=1, keepdims=True)
                    best = bits.argmin(axis=1)
                    score = 1.0 / np.exp2(-np.minimum(more, 1000.0)).sum(axis=1)
                chosen = pa.array(labels[best] if len(labels) else [None] * batch.num_rows, pa.string())
                yield pa.RecordBatch.from_arrays([*rows, chosen, pa.array(score)], names=[*names, "lang_pred", "score"])

        scored = scored.mapInArrow(trimmed(run), schema if last else summed)
    decided = F.coalesce(F.col("text").rlike(r"\p{L}"), F.lit(False)) & F.col("lang_pred").isNotNull()
    return scored.withColumn("score", F.when(decided, F.col("score")).otherwise(0.0)).withColumn(
        "lang_pred", F.when(decided, F.col("lang_pred")).otherwise(UNDECIDED)
    )
