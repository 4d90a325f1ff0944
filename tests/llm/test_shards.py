import random
import zlib

import numpy as np
import pytest
from tokenizers import Tokenizer

from custofold.llm import perfect, shards
from custofold.llm.queries import tokenizer_file

PIECES = [" ", "  ", "\n", "word", "été", "12", "!", "!!", "<|endoftext|>", "日本", "é", "😀", "\r\n", "the ", "!\x00"]


def encoded(texts):
    file = Tokenizer.from_file(tokenizer_file())
    return [[*e.ids, 0] for e in file.encode_batch(texts, add_special_tokens=False)]


def docs_of(spark, rows, kind="long"):
    return spark.createDataFrame(
        [(k, t, "x", 1) for k, t in rows], f"doc_id {kind}, text string, ids string, start int"
    ).repartition(3)


def read_all(spark, rows, folder, kind="long", **sizes):
    docs = docs_of(spark, rows, kind)
    written = shards.write(docs, str(folder / "out"), tokenizer_file(), **sizes)
    got = shards.read(docs.select("doc_id"), written).collect()
    return written, sorted((r["start"], r["doc_id"], r["n_tokens"], bytes(r["ids"])) for r in got) if kind == "long" else got


def texts(n, size, seed):
    rnd = random.Random(seed)
    return ["".join(rnd.choice(PIECES) for _ in range(rnd.randrange(size))) for _ in range(n)]


@pytest.mark.parametrize("sizes", [{}, {"shard_tokens": 200, "keys_per_part": 7}])
def test_every_document_comes_back_in_order(spark, tmp_path, sizes):
    values = [*texts(60, 60, 1), "", "same", "same", "word " * 20_000, "!" * 50]
    keys = random.Random(2).sample(range(-500, 5000), len(values))
    written, got = read_all(spark, list(zip(keys, values, strict=True)), tmp_path, **sizes)
    want, start = [], 0
    for k, ids in sorted(zip(keys, encoded(values), strict=True)):
        want.append((start, k, len(ids), np.array(ids, "<u4").tobytes()))
        start += len(ids)
    assert got == want
    assert written.shards.count() > (10 if sizes else 0)
    assert [zlib.crc32(g[3]) for g in got] == [zlib.crc32(np.array(i, "<u4").tobytes()) for _, i in sorted(zip(keys, encoded(values), strict=True))]


def test_repeated_and_null_keys_over_many_shards(spark, tmp_path):
    values = texts(40, 30, 3)
    rows = [(7, v) for v in values] + [(None, v) for v in values[:25]] + [(7, "copy")] * 30 + [(9, None), (1, "one")]
    docs = docs_of(spark, rows)
    written = shards.write(docs, str(tmp_path / "out"), tokenizer_file(), shard_tokens=40, keys_per_part=2)
    assert written.shards.where("joined and runs = 1").count() > 3  # one key fills several shards
    got = sorted((r["start"], r["doc_id"], bytes(r["ids"])) for r in shards.read(docs.select("doc_id"), written).collect() if r["doc_id"] is not None)
    everything = shards.read(docs.select("doc_id"), written).collect()
    assert len(everything) == len(rows)
    starts = sorted((r["start"], r["n_tokens"]) for r in everything)
    assert all(a + n == b for (a, n), (b, _) in zip(starts, starts[1:], strict=False)) and starts[0][0] == 0
    assert [k for _, k, _ in got] == [1, *[7] * 70, 9]
    want = sorted(np.array(i, "<u4").tobytes() for i in encoded([v or "" for k, v in rows if k == 7]))
    assert sorted(ids for _, k, ids in got if k == 7) == want
    assert all(r["start"] < got[0][0] for r in everything if r["doc_id"] is None)
    reader = shards.Reader(written)
    assert sorted(ids.astype("<u4").tobytes() for _, ids in reader.get(7)) == want
    assert [start for start, _ in reader.get(7)] == [s for s, k, _ in got if k == 7]
    assert len(reader.get(None)) == 25 and reader.get(9)[0][1].tolist() == [0]
    assert reader.get(8) == [] and reader.get("seven") == []


def test_absent_keys_give_no_row(spark, tmp_path):
    written, _ = read_all(spark, [(i, f"text {i}") for i in range(100)], tmp_path, keys_per_part=20)
    asked = spark.range(95, 20_000).withColumnRenamed("id", "doc_id")
    assert sorted(r["doc_id"] for r in shards.read(asked, written).collect()) == [95, 96, 97, 98, 99]
    assert written.index.count() == written.parts == 5


def test_text_keys_and_four_byte_ids(spark, tmp_path, monkeypatch):
    written, got = read_all(spark, [("b", "two"), ("a\x00", "one"), ("", "none"), (None, "null")], tmp_path, "string")
    order = [r["doc_id"] for r in sorted(got, key=lambda r: r["start"])]
    assert order == [None, "", "a\x00", "b"]
    writer = shards.ShardWriter(str(tmp_path), 0, 0, 4)
    writer.add("k", np.array([70_000, 0], np.uint32))
    file = shards.ShardFile(writer.close()[2])
    assert file.ids(0, 2).tolist() == [70_000, 0] and file.keys() == ["k"]


def test_empty_table(spark, tmp_path):
    written, got = read_all(spark, [], tmp_path)
    assert got == [] and written.shards.count() == 0 and shards.Reader(written).get(1) == []


def test_files_that_were_not_committed_are_not_read(spark, tmp_path):
    rows = [(i, f"text {i}") for i in range(50)]
    written, got = read_all(spark, rows, tmp_path)
    stray = shards.ShardWriter(str(tmp_path / "out" / "ids"), 0, 0, 2)
    stray.add("3", np.array([1, 2], np.uint32))
    stray.close()
    again = shards.read(docs_of(spark, rows).select("doc_id"), written).collect()
    assert sorted((r["start"], r["doc_id"], r["n_tokens"], bytes(r["ids"])) for r in again) == got


def test_perfect_hash_is_minimal():
    rnd = np.random.default_rng(4)
    for n in (0, 1, 2, 5, 3000):
        low, high = rnd.integers(0, 1 << 63, (2, n), dtype=np.uint64)
        made = perfect.build(low, high)
        assert sorted(perfect.lookup(made, low, high).tolist()) == list(range(n))
        assert len(made) <= 200 + n  # about four bits a key, in blocks of 64 bytes
        others = perfect.lookup(made, low + np.uint64(1), high)
        assert ((others >= -1) & (others < n)).all()
    with pytest.raises(ValueError, match="same hash"):
        perfect.build(np.array([3, 3], np.uint64), np.array([4, 4], np.uint64))


def test_keyed_access_reads_little(spark, tmp_path, monkeypatch):
    written, _ = read_all(spark, [(i, f"text {i}") for i in range(3000)], tmp_path)
    reader, sizes = shards.Reader(written), []
    plain = shards.opened

    class Counting:
        def __init__(self, file):
            self.file = file

        def __enter__(self):
            return self

        def __exit__(self, *_):
            self.file.close()

        def read_at(self, size, at):
            sizes.append(size)
            return self.file.read_at(size, at)

        def __getattr__(self, name):
            return getattr(self.file, name)

    class System:
        def __init__(self, system):
            self.system = system

        def open_input_file(self, path):
            return Counting(self.system.open_input_file(path))

    def counted(uri):
        system, path = plain(uri)
        return System(system), path

    monkeypatch.setattr(shards, "opened", counted)
    for k in (0, 1234, 2999):
        sizes.clear()
        assert len(reader.get(k)) == 1
        assert len(sizes) < 15 and sum(sizes) < 2000
