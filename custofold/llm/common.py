"""What several operators share: written intermediate tables, text columns, Arrow and hash helpers."""

from __future__ import annotations

import ctypes
import tempfile
import uuid
from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def shared_folder(spark: SparkSession) -> str:
    """A new folder name below the folder that the cluster shares.

    Without ``spark.checkpoint.dir`` a temporary folder serves, but only where driver and executors are one process.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if not shared:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        shared = tempfile.mkdtemp(prefix="custofold-")
    return f"{shared.rstrip('/')}/{uuid.uuid4().hex}"


def stored(df: DataFrame) -> DataFrame:
    """The frame written as a table in the shared folder and read back: lost executors lose none of it."""
    path = shared_folder(df.sparkSession)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def id_text(doc_id: str = "doc_id") -> Column:
    """The id as text; a missing id is the empty text."""
    return F.coalesce(F.col(doc_id).cast("string"), F.lit(""))


def in_fold(doc_id: str, folds: int, fold: int) -> Column:
    """Whether crc32 of the id as text leaves this remainder."""
    return F.crc32(id_text(doc_id)) % folds == fold


def documents_of(docs: DataFrame, *more: str) -> DataFrame:
    """``doc_id`` and ``text`` (null: empty), and the named columns; other columns are left behind."""
    return docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"), *more)


def texts(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a text column one after the other, and where each row begins (one more entry than rows)."""
    column = column.cast(pa.large_string())
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    data = column.buffers()[2]
    data = np.frombuffer(data, np.uint8) if data is not None else np.empty(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def words_of(column: pa.Array) -> Iterator[list[bytes]]:
    """The words of each text: lower-cased A-Z, split at ASCII white space (what ``bytes`` does)."""
    data, offsets = texts(column)
    raw = data.tobytes().lower()
    for begin, end in zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True):
        yield raw[begin:end].split()


def binaries(values: list[bytes]) -> pa.Array:
    return pa.array(values, pa.binary())


def trimmed(run: Callable[[Iterator], Iterator]) -> Callable[[Iterator], Iterator]:
    """The batch function, giving free memory back to the machine at the end of a task.

    Workers are reused: what one stage has freed but still holds would count beside the next stage's needs.
    """

    def task(batches: Iterator) -> Iterator:
        yield from run(batches)
        pa.default_memory_pool().release_unused()
        try:
            ctypes.CDLL("libc.so.6").malloc_trim(0)
        except (OSError, AttributeError):
            pass  # not a GNU C library

    return task


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser (xor, shift, multiply): equal inputs give equal hashes on every machine."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class WordHashes:
    """64-bit hashes of words, kept for the words of a task so that each is hashed once; forgets all when full."""

    def __init__(self, limit: int = 250_000):
        self.known: dict[bytes, int] = {}
        self.limit = limit

    def __call__(self, words: list[bytes]) -> np.ndarray:
        import xxhash

        known = self.known
        if len(known) > self.limit:
            known.clear()
        try:
            return np.fromiter(map(known.__getitem__, words), np.uint64, len(words))
        except KeyError:
            for w in words:
                if w not in known:
                    known[w] = xxhash.xxh3_64_intdigest(w)
            return np.fromiter(map(known.__getitem__, words), np.uint64, len(words))


@lru_cache(maxsize=1)
def _bytes_and_powers(size: int) -> tuple[np.ndarray, ...]:
    """A number for each byte (A-Z as a-z), which bytes are white space, powers of an odd number and of its inverse."""
    factor = 0x9E3779B97F4A7C15
    lower = np.arange(256)
    lower[65:91] += 32
    space = np.zeros(256, bool)
    space[[9, 10, 11, 12, 13, 32]] = True
    powers, inverses = (
        np.cumprod(np.array([1] + [x] * size, np.uint64)) for x in (factor, pow(factor, -1, 1 << 64))
    )
    return mix(lower.astype(np.uint64) + np.uint64(1)), space, powers, inverses


def word_hashes(column: pa.Array, size: int = 1 << 18) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """64-bit hashes of the words of a text column, for some rows at a time (about ``size`` bytes).

    Each time the number of the first row, the hashes of all its words, and where the words of each row begin
    (one more entry than rows). A word is a polynomial of its bytes, from running sums over all bytes.
    """
    data, offsets = texts(column)
    first = 0
    while first < len(column):
        last = max(first + 1, int(np.searchsorted(offsets, offsets[first] + size, side="right")) - 1)
        part = data[offsets[first] : offsets[last]]
        cuts = offsets[first : last + 1] - offsets[first]
        # Powers are kept for texts of the usual size; a longer one has its own.
        known = _bytes_and_powers(size) if len(part) <= size else _bytes_and_powers.__wrapped__(len(part))
        codes, spaces, powers, inverses = known
        space = spaces[part]
        edge = np.zeros(len(part) + 1, bool)  # between two bytes of different rows
        edge[cuts] = True
        before, after = edge[:-1].copy(), edge[1:].copy()
        before[1:] |= space[:-1]
        after[:-1] |= space[1:]
        begins, ends = np.flatnonzero(before & ~space), np.flatnonzero(after & ~space) + 1
        sums = np.zeros(len(part) + 1, np.uint64)
        np.cumsum(codes[part] * powers[: len(part)], out=sums[1:])
        yield first, mix((sums[ends] - sums[begins]) * inverses[begins]), np.searchsorted(begins, cuts)
        first = last
