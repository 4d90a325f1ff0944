"""Two tokenizers' tokens of the same text, aligned where they end at the same byte.

Both tokenizers encode a blank and the text. In every piece of a batch the two lists of ids are flattened with
their parent indices, token lengths are summed up within each document (a running sum less its value where the
document begins), and an Acero hash join on (document, end) pairs the tokens that end together: the *links*.
Ends that both sides have cut the two sequences into *groups*.

How often an id pair is linked in the whole corpus is counted in two steps: ``Table.group_by`` counts each chunk
of documents in its task, Spark adds up the chunks' counts. The sums travel back to the chunks by a join on the
pair and meet the chunk's links there, so no table of pairs is broadcast or collected, and a pair that stands in
every document has one row a chunk. The largest sum of every id of the second tokenizer is broadcast: it has at
most as many rows as that vocabulary.

Defined cases: a null or empty text, and one whose tokens do not give back its bytes on either side, has no
tokens: zeros and the empty text of groups. Special tokens' strings are ordinary text. Very long texts are whole
pieces of their own. Repeated rows and equal ids are rows like any other; a null id stays null. Ties: every pair
that reaches the largest count of its second id is best. An empty table gives no rows. Columns other than
``doc_id`` and ``text`` are left behind, so none can clash.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from custofold.llm.bpe import coder
from custofold.llm.common import documents_of, stored, texts, trimmed

PIECE_BYTES = 400_000
CHUNK_LINKS = 2_000_000
#: A pair of ids in one number: the second id in the low bits.
SHIFT = 20

PER_DOCUMENT = ("n_a", "n_b", "n_groups", "n_links")
#: A row for each piece: its documents' numbers, and all their links, packed (``pack``).
ALIGNED = T.StructType(
    [
        T.StructField("chunk", T.LongType()),
        *[T.StructField(n, T.ArrayType(T.LongType())) for n in ("doc_id", *PER_DOCUMENT)],
        T.StructField("groups", T.ArrayType(T.StringType())),
        T.StructField("links", T.BinaryType()),
    ]
)
COUNTED = T.StructType(
    [
        *[T.StructField(n, T.LongType()) for n in ("doc_id", *PER_DOCUMENT)],
        T.StructField("groups", T.StringType()),
        T.StructField("n_best", T.LongType()),
        T.StructField("count_sum", T.LongType()),
        T.StructField("links", T.ArrayType(T.LongType())),
    ]
)


class ByteTokens:
    """Ids of a byte-level BPE file, and the bytes of every id."""

    def __init__(self, path: str):
        self.path = path
        self.coding = coder(path, 1024).coding
        self.bytes_of = pa.array([self._bytes(i) for i in range(self.coding.n_vocab)], pa.large_binary())

    def _bytes(self, i: int) -> bytes:
        try:
            return self.coding.decode_single_token_bytes(i)
        except KeyError:
            return b""

    def encode(self, values: list[str]) -> pa.ListArray:
        """Ids of a blank and each text. The regular expression gives up on very long runs of white space; there the
        tokenizers library steps in."""
        out = []
        for v in values:
            try:
                ids = self.coding.encode_to_numpy(" " + v, allowed_special=set(), disallowed_special=())
            except ValueError:
                ids = np.array(plain_file(self.path).encode(" " + v, add_special_tokens=False).ids, np.int32)
            out.append(ids.astype(np.int32))
        return list_of(out)


@lru_cache(maxsize=1)
def plain_file(path: str):
    from tokenizers import Tokenizer

    file = Tokenizer.from_file(path)
    file.encode_special_tokens = True
    return file


class PieceTokens:
    """Ids of a sentencepiece model that puts a blank before the text, and the bytes of every id."""

    def __init__(self, path: str):
        import sentencepiece

        self.model = model = sentencepiece.SentencePieceProcessor(model_file=path)
        pieces = [model.id_to_piece(i) for i in range(model.get_piece_size())]
        self.bytes_of = pa.array(
            [
                bytes([int(p[3:-1], 16)]) if model.is_byte(i)
                else b"" if model.is_control(i) or model.is_unknown(i)
                else p.replace("▁", " ").encode()
                for i, p in enumerate(pieces)
            ],
            pa.large_binary(),
        )

    def encode(self, values: list[str]) -> pa.ListArray:
        return list_of([np.array(ids, np.int32) for ids in self.model.encode(values, num_threads=1)])


@lru_cache(maxsize=2)
def tokens_of(path: str) -> ByteTokens | PieceTokens:
    return ByteTokens(path) if path.endswith(".json") else PieceTokens(path)


def list_of(arrays: list[np.ndarray]) -> pa.ListArray:
    offsets = np.zeros(len(arrays) + 1, np.int32)
    np.cumsum([len(a) for a in arrays], out=offsets[1:])
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate([*arrays, np.empty(0, np.int32)])))


def lengths_of(table: pa.Array) -> np.ndarray:
    return np.diff(np.frombuffer(table.buffers()[1], np.int64)[: len(table) + 1]).astype(np.int32)


class Side:
    """One tokenizer's tokens of a piece: flat ids, their documents and ends, in the order of documents."""

    def __init__(self, lists: pa.ListArray, bytes_of: pa.Array, lengths: np.ndarray):
        self.ids = pc.list_flatten(lists)
        self.parents = pc.list_parent_indices(lists)
        self.offsets = np.asarray(lists.offsets).astype(np.int64)
        size = lengths[np.asarray(self.ids)].astype(np.int64)
        total = np.asarray(pc.cumulative_sum(pa.array(size)))
        before = np.concatenate([[0], total])[self.offsets[:-1]]
        self.ends = total - np.repeat(before, np.diff(self.offsets))
        self.bytes_of = bytes_of

    def same_bytes(self, data: np.ndarray, bounds: np.ndarray) -> np.ndarray:
        """For each document, whether its tokens' bytes are those between its bounds."""
        joined = pc.take(self.bytes_of, self.ids)
        ends = np.frombuffer(joined.buffers()[1], np.int64)[: len(joined) + 1]
        raw = np.frombuffer(joined.buffers()[2], np.uint8) if len(joined) else np.empty(0, np.uint8)
        own = ends[self.offsets] if len(joined) else np.zeros(len(self.offsets), np.int64)
        same = np.diff(own) == np.diff(bounds)
        if same.all() and np.array_equal(raw[: own[-1]], data):
            return same
        for d in np.flatnonzero(same):
            same[d] = np.array_equal(raw[own[d] : own[d + 1]], data[bounds[d] : bounds[d + 1]])
        return same

    def table(self, side: str) -> pa.Table:
        key = np.asarray(self.parents, np.int64) << 40 | self.ends
        return pa.table({"end": pa.array(key), side: pa.array(np.arange(len(key), dtype=np.int32))})

    def groups(self, matched: np.ndarray) -> np.ndarray:
        """The number of each token's group in the piece: a new one begins after an end that both sides have."""
        parents = np.asarray(self.parents)
        new = matched[:-1] & ((self.ends[1:] != self.ends[:-1]) | (parents[1:] != parents[:-1]))
        return np.concatenate([[0], np.cumsum(new)]) if len(matched) else np.empty(0, np.int64)


@lru_cache(maxsize=1)
def written(ids: int) -> pa.Array:
    """Every id in decimals, followed by a comma, a bar, a semicolon, or nothing."""
    return pa.array([f"{i}{s}" for i in range(ids) for s in (",", "|", ";", "")], pa.large_string())


def group_texts(a: Side, b: Side, matched_a: np.ndarray, matched_b: np.ndarray) -> tuple[np.ndarray, np.ndarray, list[bytes]]:
    """Groups of each document: how many, and as ``a1,a2|b1;a3|b2,b3``."""
    in_a, in_b = a.groups(matched_a), b.groups(matched_b)
    n = int(in_a[-1]) + 1 if len(in_a) else 0
    count_a, count_b = np.bincount(in_a, minlength=n), np.bincount(in_b, minlength=n)
    upto_a, upto_b = np.cumsum(count_a), np.cumsum(count_b)
    first = np.concatenate([in_a, [n]])[a.offsets]  # the first group of each document; documents without tokens: the next
    codes = np.empty(len(in_a) + len(in_b), np.int64)
    mark = np.zeros(len(in_a), np.int64)
    mark[upto_a - 1] = 1
    codes[np.arange(len(in_a)) + (upto_b - count_b)[in_a]] = np.asarray(a.ids, np.int64) * 4 + mark
    mark = np.zeros(len(in_b), np.int64)
    last = np.full(n, 2, np.int64)
    last[first[1:][np.diff(first) > 0] - 1] = 3
    mark[upto_b - 1] = last
    codes[np.arange(len(in_b)) + upto_a[in_b]] = np.asarray(b.ids, np.int64) * 4 + mark
    out = pc.take(written(max(len(a.bytes_of), len(b.bytes_of))), pa.array(codes))
    ends = np.frombuffer(out.buffers()[1], np.int64)[: len(out) + 1] if len(out) else np.zeros(1, np.int64)
    raw = memoryview(out.buffers()[2]) if len(out) else memoryview(b"")
    bounds = ends[a.offsets + b.offsets]
    return np.diff(first), bounds, [raw[x:y] for x, y in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True)]


def align_piece(values: list[str], path_a: str, path_b: str, digest: bool) -> dict[str, list]:
    """Columns of ``ALIGNED`` (without chunk and id) for some texts."""
    coders = tokens_of(path_a), tokens_of(path_b)
    given = pa.array([" " + v if v else "" for v in values], pa.large_string())
    data, bounds = texts(given)
    lists = [c.encode(values) for c in coders]
    sides = [Side(x, c.bytes_of, lengths_of(c.bytes_of)) for x, c in zip(lists, coders, strict=True)]
    good = sides[0].same_bytes(data, bounds) & sides[1].same_bytes(data, bounds) & (np.diff(bounds) > 0)
    if not good.all():
        blank = [
            list_of([np.asarray(x[i].values) if g else np.empty(0, np.int32) for i, g in enumerate(good)]) for x in lists
        ]
        sides = [Side(x, c.bytes_of, lengths_of(c.bytes_of)) for x, c in zip(blank, coders, strict=True)]
    a, b = sides
    joined = a.table("a").join(b.table("b"), keys="end", join_type="inner", use_threads=False)
    pairs = np.sort(np.asarray(joined["a"]).astype(np.int64) << 32 | np.asarray(joined["b"]))
    ia, ib = pairs >> 32, pairs & 0xFFFFFFFF
    matched = np.zeros(len(a.ends), bool), np.zeros(len(b.ends), bool)
    matched[0][ia], matched[1][ib] = True, True
    n_groups, _, written_groups = group_texts(a, b, *matched)
    numbers = np.asarray(a.ids, np.int64)[ia] << SHIFT | np.asarray(b.ids, np.int64)[ib]
    at = np.searchsorted(ia, a.offsets)
    return {
        "n_a": np.diff(a.offsets),
        "n_b": np.diff(b.offsets),
        "n_groups": n_groups,
        "n_links": np.diff(at),
        "groups": [
            (hashlib.sha256(g).hexdigest() if digest and len(g) else str(g, "ascii")) for g in written_groups
        ],
        "links": numbers,
    }


def pack(links: np.ndarray) -> bytes:
    """Links in few bytes: the distinct pairs, commonest first, and the place of each link's pair among them."""
    pairs, place, n = np.unique(links, return_inverse=True, return_counts=True)
    first = np.argsort(-n, kind="stable")
    rank = np.empty(len(pairs), np.int64)
    rank[first] = np.arange(len(pairs))
    width = 2 if len(pairs) <= 1 << 16 else 4
    raw = pairs[first].astype("<u8").tobytes() + rank[place].astype(f"<u{width}").tobytes()
    return np.array([len(pairs), len(links)], "<u8").tobytes() + pa.compress(raw, codec="zstd", asbytes=True)


def unpack(packed: bytes | memoryview) -> tuple[np.ndarray, np.ndarray]:
    """The distinct pairs, and the place among them of every link."""
    n_pairs, n_links = np.frombuffer(packed, "<u8", 2).tolist()
    width = 2 if n_pairs <= 1 << 16 else 4
    raw = pa.decompress(packed[16:], 8 * n_pairs + width * n_links, codec="zstd", asbytes=True)
    return np.frombuffer(raw, "<i8", n_pairs), np.frombuffer(raw, f"<u{width}", n_links, 8 * n_pairs)


def pieces(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """Runs of rows with about ``PIECE_BYTES`` of text; a longer text stands alone."""
    _, offsets = texts(batch.column("text"))
    begin = 0
    while begin < batch.num_rows:
        end = max(begin + 1, int(np.searchsorted(offsets, offsets[begin] + PIECE_BYTES)) - 1)
        yield batch.slice(begin, end - begin)
        begin = end


def links(docs: DataFrame, path_a: str, path_b: str, digest: bool = False) -> DataFrame:
    """``ALIGNED`` for all documents, piece by piece, dealt into chunks of about ``CHUNK_LINKS`` links."""
    kinds = to_arrow_schema(ALIGNED).types

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chunk, held = TaskContext.get().partitionId() << 32, 0
        for batch in batches:
            for piece in pieces(batch):
                made = align_piece(piece.column("text").to_pylist(), path_a, path_b, digest)
                if held > CHUNK_LINKS:
                    chunk, held = chunk + 1, 0
                held += int(np.sum(made["n_links"]))
                row = [
                    [chunk],
                    [piece.column("doc_id").to_pylist()],
                    *([np.asarray(made[n]).tolist()] for n in PER_DOCUMENT),
                    [made["groups"]],
                    [pack(made["links"])],
                ]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(row, kinds, strict=True)], names=ALIGNED.names)

    whole = documents_of(docs).select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return whole.mapInArrow(trimmed(run), ALIGNED)


def chunk_counts(linked: DataFrame) -> DataFrame:
    """``chunk``, ``pair``, ``n``: how often a chunk links each id pair."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, list[np.ndarray]] = {}
        size = 0

        def counted() -> Iterator[pa.RecordBatch]:
            for chunk, arrays in held.items():
                table = pa.table({"pair": np.concatenate(arrays)})
                out = table.group_by("pair", use_threads=False).aggregate([([], "count_all")])
                out = out.rename_columns(["pair", "n"]).combine_chunks()
                out = out.append_column("chunk", pa.array(np.full(out.num_rows, chunk, np.int64)))
                yield from out.select(["chunk", "pair", "n"]).to_batches(max_chunksize=100_000)
            held.clear()

        for batch in batches:
            for chunk, packed in zip(batch.column("chunk").to_pylist(), batch.column("links"), strict=True):
                pairs, place = unpack(memoryview(packed.as_buffer()))
                held.setdefault(chunk, []).append(pairs[place])
                size += len(place)
                if size > 2 * CHUNK_LINKS:
                    yield from counted()
                    size = 0
        yield from counted()

    return linked.select("chunk", "links").mapInArrow(trimmed(run), "chunk long, pair long, n long")


def corpus_counts(partial: DataFrame) -> DataFrame:
    """``pair``, ``total``, and whether no other pair of the same second id has a larger total."""
    totals = partial.groupBy("pair").agg(F.sum("n").alias("total"))
    second = F.col("pair").bitwiseAND(F.lit((1 << SHIFT) - 1).cast("long"))
    tops = totals.groupBy(second.alias("b")).agg(F.max("total").alias("top"))
    joined = totals.withColumn("b", second).join(F.broadcast(tops), "b")  # as many rows as the vocabulary at most
    return joined.select("pair", "total", (F.col("total") == F.col("top")).alias("best"))


def with_counts(linked: DataFrame, flagged: DataFrame, with_links: bool) -> DataFrame:
    """Each document's ``n_best`` and ``count_sum``; a chunk's documents meet the counts of the chunk's pairs."""

    kinds = to_arrow_schema(COUNTED).types

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        known = right["pair"].combine_chunks() if right.num_rows else pa.array([], pa.int64())
        total = np.concatenate([np.asarray(right["total"]), [0]]).astype(np.int64)
        best = np.concatenate([right["best"].to_numpy(), [False]]).astype(np.int64)
        out = []
        for row in left.drop_columns(["links"]).to_pylist():
            pairs, place = unpack(memoryview(left["links"][len(out)].as_buffer()))
            at = np.asarray(pc.index_in(pa.array(pairs), value_set=known).fill_null(len(total) - 1))
            offsets = np.cumsum([0, *row["n_links"]])
            sums = [np.diff(np.concatenate([[0], np.cumsum(v[at][place])])[offsets]) for v in (best, total)]
            links = pairs[place] if with_links else None
            lists = [links[x:y] if with_links else None for x, y in zip(offsets[:-1], offsets[1:], strict=True)]
            columns = [row["doc_id"], *(row[n] for n in PER_DOCUMENT), row["groups"], *sums, lists]
            out.append(pa.Table.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds, strict=True)], COUNTED.names))
        return pa.concat_tables(out or [to_arrow_schema(COUNTED).empty_table()])

    return linked.groupby("chunk").cogroup(flagged.groupby("chunk")).applyInArrow(run, COUNTED)


def align(docs: DataFrame, path_a: str, path_b: str, digest: bool = False, with_links: bool = True) -> DataFrame:
    """One row per document: ``COUNTED``. ``groups`` is text, or with ``digest`` its sha256 ('' without tokens).

    ``links`` holds the linked id pairs in order, the first id times 2**20 plus the second (null if not wanted).
    ``path_a`` is a byte-level BPE file (.json), ``path_b`` a sentencepiece model.
    """
    linked = stored(links(docs, path_a, path_b, digest))
    partial = stored(chunk_counts(linked))
    # a chunk that two tasks have counted names a pair twice, which does no harm
    flagged = partial.select("chunk", "pair").join(corpus_counts(partial), "pair")
    return with_counts(linked, flagged, with_links)
