"""Byte-level BPE with reuse of content-defined chunks.

A rolling hash over the bytes of a text sets chunk ends where the text itself says so, so a passage that many
documents share falls into the same chunks wherever it stands. A chunk is encoded once per task and its ids
are reused; documents are first dealt out by content (``by_content``), so that copies and documents with a
common passage meet in one task. Texts that very many rows share are spread over several tasks.

Chunks may end anywhere, even inside a word, so the joins have to be repaired. Between a letter and a
blank the pre-tokenizer always splits. The ids of a chunk are therefore kept only between its first and last
such place; what lies between the last place of one chunk and the first of the next is encoded anew as one
piece (the seam), which grows over as many chunks as it takes to reach such a place. Ids then agree exactly
with those of the whole text.

Works for byte-level BPE files whose ids follow the order of merges and whose pre-tokenizer is the byte-level
pattern (checked when loading). Special tokens in a text are recognised, as the tokenizers library does.

Defined cases: null text counts as empty and has no ids. Repeated rows are encoded like any other, and so are
rows without id. Very long texts are encoded chunk by chunk. An empty table gives no rows. Other columns are kept; columns named ``ids`` and ``decoded`` are replaced.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from custofold.llm.common import id_text, mix, texts, trimmed

# Fixed value: the splitting pattern of byte-level tokenizer files.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
WINDOW = 16
CHUNK_BYTES = 1024
MEMORY_BYTES = 24_000_000
PIECE_ROWS = 128
HOT_ROWS, HOT_LINES = 2_000, 10_000


def byte_symbols() -> dict[str, int]:
    """The visible character that stands for each byte in a byte-level vocabulary: printable ones for themselves."""
    own = [*range(ord("!"), ord("~") + 1), *range(ord("¡"), ord("¬") + 1), *range(ord("®"), ord("ÿ") + 1)]
    rest = [b for b in range(256) if b not in set(own)]
    return {chr(b): b for b in own} | {chr(256 + i): b for i, b in enumerate(rest)}


def safe_places(text: str) -> tuple[int, int]:
    """The first and the last place between a letter and a blank; -1 where there is none."""
    first = text.find(" ", 1)
    while first > 0 and not text[first - 1].isalpha():
        first = text.find(" ", first + 1)
    last = text.rfind(" ", 1)
    while last > 0 and not text[last - 1].isalpha():
        last = text.rfind(" ", 1, last)
    return first, last


class ChunkCoder:
    """Encodes and decodes texts with one tokenizer file, keeping the ids of chunks it has met."""

    def __init__(self, path: str, chunk_bytes: int = CHUNK_BYTES):
        import tiktoken

        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        pre = spec["pre_tokenizer"] or {}
        plain = pre.get("type") == "ByteLevel" and pre.get("use_regex", True) and not pre.get("add_prefix_space")
        if spec["model"]["type"] != "BPE" or spec["normalizer"] or not plain:
            raise ValueError("not a plain byte-level BPE file")
        symbols = byte_symbols()
        added = {t["content"]: t["id"] for t in spec["added_tokens"]}
        if any(" " in t["content"] or t["lstrip"] or t["rstrip"] or t["single_word"] for t in spec["added_tokens"]):
            raise ValueError("special tokens that take in blanks are not supported")
        vocab = {k: i for k, i in spec["model"]["vocab"].items() if k not in added}
        merges = [m.split(" ") if isinstance(m, str) else m for m in spec["model"]["merges"]]
        order = [vocab[a + b] for a, b in merges]
        if order != sorted(order):
            raise ValueError("the ids do not follow the order of merges")
        ranks = {bytes(symbols[c] for c in k): i for k, i in vocab.items()}
        self.coding = tiktoken.Encoding("file", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens=added)
        self.special = frozenset(added)
        self.bits = max(1, chunk_bytes.bit_length() - 1)
        self.gears = mix(np.arange(1, 257, dtype=np.uint64))
        self.known: dict[bytes, tuple] = {}
        self.held = 0

    def cuts(self, data: np.ndarray) -> np.ndarray:
        """Positions after which a chunk ends: the hash of the last bytes has zeros on top, and a character ends."""
        if len(data) < WINDOW:
            return np.empty(0, np.int64)
        gear = self.gears[data]
        rolling = gear.copy()
        span = 1
        while span < WINDOW:  # doubles the number of bytes that each hash covers
            rolling[span:] = rolling[span:] + (rolling[:-span] << np.uint64(span))
            span *= 2
        ends = np.flatnonzero(rolling[WINDOW - 1 : -1] >> np.uint64(64 - self.bits) == 0) + WINDOW
        return ends[(data[ends] & 0xC0) != 0x80]

    def encode(self, text: str) -> np.ndarray:
        return np.array(self.coding.encode(text, allowed_special=self.special, disallowed_special=()), np.uint32)

    def chunk(self, raw: bytes) -> tuple:
        """What comes before its first safe place, the ids up to the last one, and what comes after; or no ids."""
        found = self.known.get(raw)
        if found is None:
            text = raw.decode()
            first, last = safe_places(text)
            if first < last:
                found = (text[:first], self.encode(text[first:last]), text[last:])
            else:
                found = (text, None, "")
            if self.held > MEMORY_BYTES:
                self.known.clear()
                self.held = 0
            self.known[raw] = found
            self.held += len(raw) * 3
        return found

    def ids(self, raw: bytes, ends: list[int]) -> np.ndarray:
        """The ids of one text, given its chunk ends."""
        parts: list[np.ndarray] = []
        seam = ""
        begin = 0
        for end in [*ends, len(raw)]:
            head, body, tail = self.chunk(raw[begin:end])
            seam += head
            if body is not None:
                if seam:
                    parts.append(self.encode(seam))
                parts.append(body)
                seam = tail
            begin = end
        if seam:
            parts.append(self.encode(seam))
        return np.concatenate(parts) if parts else np.empty(0, np.uint32)

    def decode(self, ids: np.ndarray) -> str:
        return self.coding.decode(ids.tolist(), errors="replace")


@lru_cache(maxsize=1)
def coder(path: str, chunk_bytes: int) -> ChunkCoder:
    return ChunkCoder(path, chunk_bytes)


def by_content(docs: DataFrame) -> DataFrame:
    """Rows dealt out by the smallest hash among their lines, so copies and near copies mostly meet.

    A line that is the smallest of very many rows is hot: its rows are spread by id over one part per
    ``hot`` rows. ``hot`` is at least a ten-thousandth of all rows, so the broadcast table of hot lines has
    ten thousand rows at most.
    """
    line = F.array_min(F.transform(F.split(F.coalesce("text", F.lit("")), "\n"), lambda x: F.xxhash64(x)))
    counts = docs.select(line.alias("__hot")).groupBy("__hot").count()
    hot = counts.agg(F.greatest(F.lit(HOT_ROWS), F.ceil(F.sum("count") / HOT_LINES)).alias("hot")).first()["hot"]
    parts = counts.where(F.col("count") > hot).select("__hot", F.ceil(F.col("count") / hot).alias("__parts"))
    own = docs.withColumn("__print", line)
    joined = own.join(F.broadcast(parts), own["__print"] == parts["__hot"], "left")
    salt = F.pmod(F.xxhash64(id_text()), F.coalesce("__parts", F.lit(1)))
    return joined.repartition(F.col("__print"), salt).drop("__print", "__hot", "__parts")


def encode(docs: DataFrame, path: str, chunk_bytes: int = CHUNK_BYTES) -> DataFrame:
    """The rows with ``ids`` (unsigned 32-bit little-endian, packed) and ``decoded`` (the text of those ids)."""
    kept = [f for f in docs.schema.fields if f.name not in ("ids", "decoded")]
    schema = T.StructType([*kept, T.StructField("ids", T.BinaryType()), T.StructField("decoded", T.StringType())])
    names = [f.name for f in kept]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = coder(path, chunk_bytes)
        for batch in batches:
            for begin in range(0, batch.num_rows, PIECE_ROWS):  # small pieces bound the memory of long texts
                piece = batch.slice(begin, PIECE_ROWS)
                data, offsets = texts(piece.column("text").fill_null(""))
                ends = own.cuts(data)
                raw = data.tobytes()
                ids, back = [], []
                bounds = np.searchsorted(ends, offsets, side="left").tolist()
                for i, (a, b) in enumerate(zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True)):
                    # a window that reaches into the text before would depend on the neighbour
                    inside = ends[bounds[i] : bounds[i + 1]] - a
                    inside = inside[inside >= WINDOW]
                    found = own.ids(raw[a:b], inside.tolist())
                    ids.append(found.astype("<u4").tobytes())
                    back.append(own.decode(found))
                yield pa.RecordBatch.from_arrays(
                    [*(piece.column(n) for n in names), pa.array(ids, pa.binary()), pa.array(back, pa.string())],
                    names=[*names, "ids", "decoded"],
                )

    return docs.select(*names).mapInArrow(trimmed(run), schema)


def encode_documents(docs: DataFrame, path: str, chunk_bytes: int = CHUNK_BYTES) -> DataFrame:
    """``encode`` after dealing the rows out by content."""
    return encode(by_content(docs), path, chunk_bytes)
