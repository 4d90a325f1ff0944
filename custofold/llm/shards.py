"""Token ids in raw binary shards, with a minimal perfect hash from document keys to their places.

``write`` sorts documents by key (a range exchange), encodes them, and lets every task write shards::

    ids of all documents, each followed by the end id (2 bytes an id where the vocabulary allows, else 4)
    where each document ends, in ids (8 bytes a document)
    the keys (4 bytes of length, all ones for a null key; then UTF-8 text)
    footer: documents, ids, bytes of the keys, bytes an id

Shards follow each other in the order of keys. A file's name is new in every attempt of a task; only the names in
the table of shards, which Spark commits when all tasks are done, are ever read, so a lost executor leaves
at most a file that nobody looks at. The index is built from the shards' own tables: keys are dealt by hash to
parts of about ``KEYS_PER_PART``, and each part is one file: the perfect hash (module ``perfect``), then an entry
a slot with a fingerprint of the key, the shard, and the place in it.

``read`` looks up many keys at once: keys go to the tasks of their parts, places to the tasks of their
shards, which read along. ``Reader.get`` looks up one key with a few small reads: one block a level, one entry,
and the ids.

Defined cases: a null text counts as empty and has the end id alone. Null keys sort first. Rows with one key,
however many, are all kept, in the order of a hash of their texts; they are a *run*, and one that goes on in the next shards has an
entry in each. Very long texts are never cut: a shard ends after the document that fills it. An empty table gives an
empty folder of no shards. Columns other than the key and ``text`` are left behind, so none can clash. A key that was never
written is told by the fingerprint (it is taken for another one with probability 2^-32).
"""

from __future__ import annotations

import struct
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from custofold.llm import perfect
from custofold.llm.bpe import coder
from custofold.llm.common import texts, trimmed

SHARD_TOKENS = 1 << 25
KEYS_PER_PART = 1 << 15
PIECE_BYTES = 1_000_000
READ_TOKENS = 500_000
TASK_TOKENS = 4_000_000
FOOTER = struct.Struct("<QQQQ")
NO_KEY = 0xFFFFFFFF
ENTRY = np.dtype(
    [("print", "<u4"), ("shard", "<u4"), ("begin", "<u8"), ("tokens", "<u8"), ("doc", "<u4"), ("docs", "<u4"), ("more", "<u4")]
)
SHARDS = "part long, seq long, path string, docs long, tokens long, runs long, first string, last string"


def opened(uri: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(uri)


def key_bytes(key: str | None, ordinal: int = 0) -> bytes:
    """What is hashed: the key and the ordinal of its run; a null key is like no text."""
    own = b"\x00" if key is None else b"\x01" + key.encode()
    return own + b"\x00" + ordinal.to_bytes(4, "little") if ordinal else own


def hashes(keys: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Two 64-bit hashes and a fingerprint of each key."""
    import xxhash

    both = b"".join(map(xxhash.xxh3_128_digest, keys))
    low, high = np.frombuffer(both, "<u8").reshape(-1, 2).T
    prints = np.fromiter(map(xxhash.xxh32_intdigest, keys), np.uint32, len(keys))
    return low.astype(np.uint64), high.astype(np.uint64), prints


def part_of(low: np.ndarray, parts: int) -> np.ndarray:
    return ((low >> np.uint64(32)) * np.uint64(parts) >> np.uint64(32)).astype(np.int64)


class Coder:
    """Ids of whole texts; strings of special tokens are those tokens, as the tokenizers library takes them."""

    def __init__(self, path: str):
        own = coder(path, 1024)
        self.path, self.coding, self.special, self.plain = path, own.coding, set(own.special), None
        self.width = 2 if self.coding.n_vocab <= 1 << 16 else 4

    def encode(self, text: str) -> np.ndarray:
        try:
            return self.coding.encode_to_numpy(text, allowed_special=self.special, disallowed_special=())
        except ValueError:  # the regular expression gives up on very long runs of white space
            if self.plain is None:
                from tokenizers import Tokenizer

                self.plain = Tokenizer.from_file(self.path)
            return np.array(self.plain.encode(text, add_special_tokens=False).ids, np.uint32)


class ShardWriter:
    def __init__(self, folder: str, part: int, seq: int, width: int):
        self.part, self.seq, self.kind = part, seq, f"<u{width}"
        self.uri = f"{folder}/{part:06d}-{seq:06d}-{uuid.uuid4().hex}.ids"
        system, path = opened(self.uri)
        self.file = system.open_output_stream(path)
        self.ends: list[int] = []
        self.keys: list[str | None] = []
        self.tokens = self.runs = 0

    def add(self, key: str | None, ids: np.ndarray) -> None:
        self.file.write(ids.astype(self.kind).tobytes())
        self.tokens += len(ids)
        self.runs += not self.keys or key != self.keys[-1]
        self.ends.append(self.tokens)
        self.keys.append(key)

    def close(self) -> tuple:
        names = b"".join(
            struct.pack("<I", NO_KEY) if k is None else struct.pack("<I", len(raw := k.encode())) + raw for k in self.keys
        )
        self.file.write(np.array(self.ends, "<u8").tobytes())
        self.file.write(names)
        self.file.write(FOOTER.pack(len(self.ends), self.tokens, len(names), int(self.kind[2:])))
        self.file.close()
        return (self.part, self.seq, self.uri, len(self.ends), self.tokens, self.runs, self.keys[0], self.keys[-1])


class ShardFile:
    """A shard opened for reading."""

    def __init__(self, uri: str):
        system, path = opened(uri)
        self.file = system.open_input_file(path)
        size = self.file.size()
        self.docs, self.tokens, self.names, self.width = FOOTER.unpack(self.at(size - FOOTER.size, FOOTER.size))

    def at(self, begin: int, size: int) -> bytes:
        return self.file.read_at(size, begin)

    def ids(self, begin: int, tokens: int) -> np.ndarray:
        return np.frombuffer(self.at(begin * self.width, tokens * self.width), f"<u{self.width}").astype("<u4")

    def ends(self, doc: int, docs: int) -> np.ndarray:
        return np.frombuffer(self.at(self.tokens * self.width + 8 * doc, 8 * docs), "<u8").astype(np.int64)

    def keys(self) -> list[str | None]:
        raw = self.at(self.tokens * self.width + 8 * self.docs, self.names)
        out, at = [], 0
        while at < len(raw):
            (size,) = struct.unpack_from("<I", raw, at)
            at += 4
            if size == NO_KEY:
                out.append(None)
            else:
                out.append(raw[at : at + size].decode())
                at += size
        return out

    def close(self) -> None:
        self.file.close()


def pieces(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    _, offsets = texts(batch.column("text"))
    begin = 0
    while begin < batch.num_rows:
        end = max(begin + 1, int(np.searchsorted(offsets, offsets[begin] + PIECE_BYTES)) - 1)
        yield batch.slice(begin, end - begin)
        begin = end


def rows_batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_pylist([dict(zip(schema.names, r, strict=True)) for r in rows], schema=schema)


def write_shards(docs: DataFrame, key: str, folder: str, tokenizer: str, end_id: int, shard_tokens: int) -> DataFrame:
    """Encode documents in the order of keys into shards; the rows of ``SHARDS``, stored."""
    system, path = opened(f"{folder}/ids")
    system.create_dir(path, recursive=True)
    schema = pa.schema(
        [(n, pa.int64()) for n in ("part", "seq")]
        + [("path", pa.string())]
        + [(n, pa.int64()) for n in ("docs", "tokens", "runs")]
        + [("first", pa.string()), ("last", pa.string())]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, part, seq, out = Coder(tokenizer), TaskContext.get().partitionId(), 0, None
        end = np.array([end_id], np.uint32)
        for batch in batches:
            for piece in pieces(batch):
                for k, text in zip(piece.column("key").to_pylist(), piece.column("text").to_pylist(), strict=True):
                    if out is None:
                        out = ShardWriter(f"{folder}/ids", part, seq, own.width)
                        seq += 1
                    out.add(k, np.concatenate([own.encode(text).astype(np.uint32), end]))
                    if out.tokens >= shard_tokens:
                        yield rows_batch([out.close()], schema)
                        out = None
        if out is not None:
            yield rows_batch([out.close()], schema)

    spread = F.pmod(F.monotonically_increasing_id(), F.lit(1 << 12))  # parts even the copies of one document
    rows = docs.select(F.col(key).alias("id"), F.coalesce("text", F.lit("")).alias("text"))
    rows = rows.withColumns({"tie": F.xxhash64("text"), "spread": spread})
    order = [F.col(c).asc_nulls_first() for c in ("id", "tie", "spread")]
    dealt = rows.repartitionByRange(*order).sortWithinPartitions(*order)
    dealt.select(F.col("id").cast("string").alias("key"), "text").mapInArrow(trimmed(run), SHARDS).write.parquet(
        f"{folder}/written"
    )
    return docs.sparkSession.read.schema(SHARDS).parquet(f"{folder}/written")


def number_shards(written: DataFrame, folder: str) -> DataFrame:
    """Shards with their numbers, the ids before each, and how runs go on from one to the next; stored.

    One row a shard: a window over them is small, and is read once.
    """
    order = Window.orderBy("part", "seq")
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    shards = written.select(
        (F.row_number().over(order) - 1).alias("shard"),
        "path",
        "docs",
        "tokens",
        "runs",
        F.coalesce(F.sum("tokens").over(before), F.lit(0)).alias("start"),
        (F.col("first").eqNullSafe(F.lag("last").over(order)) & F.lag("path").over(order).isNotNull()).alias("joined"),
    )
    order = Window.orderBy("shard")
    chain = F.max(F.when(~(F.col("joined") & (F.col("runs") == 1)), F.col("shard"))).over(
        order.rowsBetween(Window.unboundedPreceding, -1)
    )
    shards = shards.select(
        "*",
        F.when(F.col("joined"), F.col("shard") - chain).otherwise(0).cast("long").alias("ordinal"),
        F.coalesce(F.lead("joined").over(order), F.lit(False)).alias("goes_on"),
    )
    shards.coalesce(1).write.parquet(f"{folder}/shards")
    return written.sparkSession.read.schema(shards.schema).parquet(f"{folder}/shards")


PLACES = T.StructType(
    [
        T.StructField(n, T.LongType())
        for n in ("hash_part", "low", "high", "print", "shard", "begin", "tokens", "doc", "docs", "more")
    ]
)


def shard_places(path: str, shard: int, ordinal: int, goes_on: bool, parts: int) -> pa.RecordBatch:
    """One row for each run of a shard."""
    file = ShardFile(path)
    keys, ends = file.keys(), np.concatenate([[0], file.ends(0, file.docs)])
    file.close()
    first = np.array([i for i, k in enumerate(keys) if not i or k != keys[i - 1]], np.int64)
    upto = np.concatenate([first[1:], [len(keys)]])
    base = hashes([key_bytes(keys[i]) for i in first.tolist()])
    low, high, prints = hashes([key_bytes(keys[i], ordinal if i == 0 else 0) for i in first.tolist()])
    more = np.zeros(len(first), np.int64)
    more[-1] = goes_on
    columns = [
        part_of(base[0], parts), low.view(np.int64), high.view(np.int64), prints.astype(np.int64),
        np.full(len(first), shard), ends[first], ends[upto] - ends[first], first, upto - first, more,
    ]
    return pa.RecordBatch.from_arrays([pa.array(c.astype(np.int64)) for c in columns], names=PLACES.names)


def runs_of(batches: Iterator[pa.RecordBatch], column: str) -> Iterator[pa.Table]:
    """The rows of each value of a column by which the batches are sorted."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        values = np.asarray(batch.column(column))
        cuts = [0, *(np.flatnonzero(np.diff(values)) + 1).tolist(), batch.num_rows]
        for a, b in zip(cuts[:-1], cuts[1:], strict=True):
            if b > a:
                if held and held[0].column(column)[0].as_py() != values[a]:
                    yield pa.Table.from_batches(held)
                    held = []
                held.append(batch.slice(a, b - a))
    if held:
        yield pa.Table.from_batches(held)


def write_index(shards: DataFrame, folder: str, parts: int) -> DataFrame:
    """``hash_part``, ``index_path``: the files of the index; stored."""
    system, path = opened(f"{folder}/index")
    system.create_dir(path, recursive=True)

    def places(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in batch.to_pylist():
                yield shard_places(r["path"], r["shard"], r["ordinal"], r["goes_on"], parts)

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("hash_part", pa.int64()), ("index_path", pa.string())])
        for table in runs_of(batches, "hash_part"):
            low, high = (np.asarray(table[c]).view(np.uint64) for c in ("low", "high"))
            made = perfect.build(low, high)
            entries = np.zeros(len(low), ENTRY)
            slots = perfect.lookup(made, low, high)
            for name in ENTRY.names:
                entries[name][slots] = np.asarray(table[name])
            part = table["hash_part"][0].as_py()
            uri = f"{folder}/index/{part:06d}-{uuid.uuid4().hex}.mph"
            system, path = opened(uri)
            with system.open_output_stream(path) as file:
                file.write(made)
                file.write(entries.tobytes())
            yield rows_batch([(part, uri)], schema)

    found = shards.select("path", "shard", "ordinal", "goes_on").repartition("shard").mapInArrow(trimmed(places), PLACES)
    sorted_ = found.repartition("hash_part").sortWithinPartitions("hash_part")
    made = sorted_.mapInArrow(trimmed(build), "hash_part long, index_path string")
    made.write.parquet(f"{folder}/parts")
    return shards.sparkSession.read.schema(made.schema).parquet(f"{folder}/parts")


@dataclass(frozen=True)
class Written:
    """A folder of shards with its index."""

    folder: str
    parts: int
    shards: DataFrame
    index: DataFrame


def write(
    docs: DataFrame,
    folder: str,
    tokenizer: str,
    end_id: int = 0,
    key: str = "doc_id",
    shard_tokens: int = SHARD_TOKENS,
    keys_per_part: int = KEYS_PER_PART,
) -> Written:
    """Write the documents' ids to a new folder of a file system that all executors reach."""
    shards = number_shards(write_shards(docs, key, folder, tokenizer, end_id, shard_tokens), folder)
    runs = shards.agg(F.sum("runs")).first()[0] or 0
    parts = max(1, -(-runs // keys_per_part))
    return Written(folder, parts, shards, write_index(shards, folder, parts))


def probe(uri: str, keys: list[str | None]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Which keys are there, and their entries; again for those that go on in the next shard."""
    system, path = opened(uri)
    with system.open_input_file(path) as file:
        data = file.read()
    n, _, size = perfect.size_of(data)
    entries = np.frombuffer(data, ENTRY, n, size)
    rest, ordinal = np.arange(len(keys)), 0
    while len(rest):
        low, high, prints = hashes([key_bytes(keys[i], ordinal) for i in rest.tolist()])
        slots = perfect.lookup(data, low, high)
        hit = slots >= 0
        hit[hit] = entries["print"][slots[hit]] == prints[hit]
        rest, found = rest[hit], entries[slots[hit]]
        yield rest, found
        rest = rest[found["more"] > 0]
        ordinal += 1


def find(keys: DataFrame, written: Written, key: str = "doc_id") -> DataFrame:
    """The places of the distinct keys that are there: the key, ``shard``, ``begin``, ``tokens``, ``doc``, ``docs``."""
    parts = written.parts
    kind = keys.schema[key].dataType
    asked = keys.select(F.col(key).alias("id")).distinct().withColumn("key", F.col("id").cast("string"))

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            low, _, _ = hashes([key_bytes(k) for k in batch.column("key").to_pylist()])
            yield batch.append_column("hash_part", pa.array(part_of(low, parts)))

    dealt = asked.mapInArrow(
        deal, T.StructType([T.StructField("id", kind), T.StructField("key", T.StringType()), T.StructField("hash_part", T.LongType())])
    )
    placed = T.StructType(
        [T.StructField("id", kind), *[T.StructField(n, T.LongType()) for n in ("shard", "begin", "tokens", "doc", "docs")]]
    )

    def look(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in runs_of(batches, "hash_part"):
            ids = table["id"].combine_chunks()
            for rows, found in probe(table["index_path"][0].as_py(), table["key"].to_pylist()):
                columns = [ids.take(pa.array(rows)), *(pa.array(found[n].astype(np.int64)) for n in placed.names[1:])]
                yield pa.RecordBatch.from_arrays(columns, names=placed.names)

    together = dealt.join(written.index, "hash_part").repartition("hash_part").sortWithinPartitions("hash_part")
    return together.mapInArrow(trimmed(look), placed).withColumnRenamed("id", key)


def fetch(places: DataFrame, written: Written, key: str = "doc_id") -> DataFrame:
    """One row a document: the key, ``start`` (ids of all documents before it), ``n_tokens``, and ``ids`` (packed
    unsigned 32-bit little-endian numbers). Every task reads along the shards of its places."""
    numbers = [T.StructField(n, T.LongType()) for n in ("start", "n_tokens")]
    out = T.StructType([places.schema[key], *numbers, T.StructField("ids", T.BinaryType())])
    kinds = list(to_arrow_schema(out).types)

    def documents(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        """Shard, key, ids before the shard, and the bounds in the shard of every document."""
        file, opened_path = None, None
        for batch in batches:
            for r in batch.to_pylist():
                if r["path"] != opened_path:
                    file, opened_path = ShardFile(r["path"]), r["path"]
                begin = r["begin"]
                ends = file.ends(r["doc"], r["docs"]).tolist() if r["docs"] > 1 else [begin + r["tokens"]]
                for end in ends:
                    yield file, r[key], r["start"], begin, end
                    begin = end

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []

        def together() -> pa.RecordBatch:
            file, first, last = held[0][0], held[0][3], held[-1][4]
            # consecutive documents: their ids are one buffer, cut by offsets
            bounds = np.array([0, *(h[4] - first for h in held)], np.int32) * 4
            data = pa.py_buffer(file.ids(first, last - first).tobytes())
            columns = [[h[1] for h in held], [h[2] + h[3] for h in held], [h[4] - h[3] for h in held]]
            arrays = [pa.array(c, t) for c, t in zip(columns, kinds, strict=False)]
            arrays.append(pa.Array.from_buffers(pa.binary(), len(held), [None, pa.py_buffer(bounds), data]))
            return pa.RecordBatch.from_arrays(arrays, names=out.names)

        for doc in documents(batches):
            if held and (doc[0] is not held[0][0] or doc[3] != held[-1][4] or doc[4] - held[0][3] > READ_TOKENS):
                yield together()
                if doc[0] is not held[0][0]:
                    held[0][0].close()
                held = []
            held.append(doc)
        if held:
            yield together()

    named = places.join(written.shards.select("shard", "path", "start"), "shard")
    # places are small, what they stand for is not: tasks by the ids to read
    tasks = -(-(written.shards.agg(F.sum("tokens")).first()[0] or 1) // TASK_TOKENS)
    along = named.repartitionByRange(tasks, "shard", "begin").sortWithinPartitions("shard", "begin")
    return along.select(key, "path", "start", "begin", "tokens", "doc", "docs").mapInArrow(trimmed(run), out)


def read(keys: DataFrame, written: Written, key: str = "doc_id") -> DataFrame:
    """The documents of the distinct keys in a frame; keys that were never written give no row."""
    return fetch(find(keys, written, key), written, key)


class Reader:
    """Keyed access from one process, with a number of small reads that does not depend on the size of the folder."""

    def __init__(self, written: Written):
        self.parts = {r["hash_part"]: r["index_path"] for r in written.index.collect()}
        self.shards = {r["shard"]: (r["path"], r["start"]) for r in written.shards.collect()}
        self.n_parts = written.parts

    def entry(self, key: str | None, ordinal: int) -> np.void | None:
        base, _, _ = hashes([key_bytes(key)])
        low, high, prints = hashes([key_bytes(key, ordinal)])
        uri = self.parts.get(int(part_of(base, self.n_parts)[0]))
        if uri is None:
            return None
        system, path = opened(uri)
        with system.open_input_file(path) as file:
            head = file.read_at(perfect.HEAD.size + 8 * 64, 0)
            _, levels, size = perfect.size_of(head)
            first = perfect.head_size(levels)

            def block(numbers: np.ndarray) -> np.ndarray:
                at = first + int(numbers[0]) * perfect.BLOCK.itemsize
                return np.frombuffer(file.read_at(perfect.BLOCK.itemsize, at), perfect.BLOCK)

            (slot,) = perfect.slots(low, high, np.frombuffer(head, "<u8", levels, perfect.HEAD.size), block)
            if slot < 0:
                return None
            (found,) = np.frombuffer(file.read_at(ENTRY.itemsize, size + int(slot) * ENTRY.itemsize), ENTRY)
        return found if found["print"] == prints[0] else None

    def get(self, key: object) -> list[tuple[int, np.ndarray]]:
        """``start`` and the ids of every document with this key."""
        out, ordinal, more = [], 0, True
        text = None if key is None else str(key)
        while more and (found := self.entry(text, ordinal)) is not None:
            path, start = self.shards[int(found["shard"])]
            file = ShardFile(path)
            begin = int(found["begin"])
            ids = file.ids(begin, int(found["tokens"]))
            ends = file.ends(int(found["doc"]), int(found["docs"])) if found["docs"] > 1 else [begin + len(ids)]
            file.close()
            at = begin
            for end in map(int, ends):
                out.append((start + at, ids[at - begin : end - begin]))
                at = end
            more, ordinal = bool(found["more"]), ordinal + 1
        return out
