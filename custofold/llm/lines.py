"""Line dedup: which lines of which documents stay, as compressed bitmaps.

Lines whose key (white space stripped, A-Z lowered) is long enough and found in enough documents stay only in
the largest ``doc_id`` that holds it. Only hashes travel: the (key hash, document, position) rows are
range-partitioned by hash and one of ``SLOTS`` slots of documents, and each range is sorted by document (descending) and
position. A window streams the sorted rows: the first of a hash and slot is its first occurrence, and the rank that
its last row has reached is the number of its documents. One row per hash and slot goes on; the slots of a hash are
merged by their greatest document and summed numbers. A hash that a third of all documents holds is so spread over
many ranges.

The bitmap of a document is a list of runs of kept lines (``start``, ``length``), as run-length bitmap containers
hold it. ``keep_lines`` applies a bitmap to its text. The positions that are lost are a stored table, which has no row
for a document that loses nothing: Spark knows its size, and sends it to the texts below
``spark.sql.autoBroadcastJoinThreshold``. Above it documents are shuffled with their texts to meet their positions.

Defined cases: a null or empty text is one empty line. Rows that share a ``doc_id`` count as one document and
are judged alike, each by its own lines. A row without ``doc_id`` is no document: it counts for nothing and
keeps all its lines. Very long texts are split whole; of the documents that hold a line the largest ``doc_id``
keeps it, all of its rows alike. An empty table gives no rows. Hashes have 128 bits: two of 64, one by xxhash64 of the key and one of its md5.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from custofold.llm.common import documents_of, stored

SPACE = " \t\n\x0b\x0c\r"
SLOTS = 64
RUNS = "array<struct<start:int,length:int>>"


def lowered(text: Column) -> Column:
    """A text that is equal for two texts if they are equal after lowering A-Z.

    ``lower`` alone would also lower other letters. A text of ASCII only may use it; any other is read byte by
    byte as Latin-1 first. There it lowers A-Z and lead bytes C0 to DE, which become E0 to FE; as the number of
    continuation bytes still tells the two apart, different texts stay different.
    """
    ascii_only = F.octet_length(text) == F.char_length(text)
    return F.when(ascii_only, F.lower(text)).otherwise(F.lower(F.decode(F.encode(text, "UTF-8"), "ISO-8859-1")))


def long_lines(text: Column, min_chars: int) -> Column:
    """Position and 128-bit key hash (``pos``, ``a``, ``b``) of every line whose key is long enough."""

    def key(line: Column) -> Column:
        return F.when(F.octet_length(line) >= min_chars, F.btrim(line, F.lit(SPACE)))

    def hashed(stripped: Column, pos: Column) -> Column:
        low = F.transform(F.array(stripped), lowered)[0]
        return F.when(
            F.char_length(stripped) >= min_chars,
            F.transform(
                F.array(low),
                lambda k: F.struct(
                    pos.cast("int").alias("pos"), F.xxhash64(k).alias("a"), F.xxhash64(F.md5(k)).alias("b")
                ),
            )[0],
        )

    keys = F.transform(F.split(text, "\n"), key)
    return F.filter(F.transform(keys, hashed), lambda h: h.isNotNull())


def runs_of(dropped: Column, n_lines: Column) -> Column:
    """Runs of kept lines from the sorted positions of dropped ones."""
    edges = F.concat(F.array(F.lit(-1)), dropped, F.array(n_lines))
    gaps = F.transform(
        F.sequence(F.lit(0), F.size(edges) - 2),
        lambda i: F.struct(
            (F.get(edges, i) + 1).cast("int").alias("start"),
            (F.get(edges, i + 1) - F.get(edges, i) - 1).cast("int").alias("length"),
        ),
    )
    return F.filter(gaps, lambda g: g["length"] > 0)


def lost_lines(docs: DataFrame, min_chars: int = 40, min_docs: int = 5) -> DataFrame:
    """Per document (``doc_id`` and ``print``, a hash of its text) the sorted positions of the lines it loses."""
    ranges = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    held = stored(
        documents_of(docs)
        .where(F.col("doc_id").isNotNull())
        .select("doc_id", F.xxhash64("text").alias("print"), F.inline(long_lines(F.col("text"), min_chars)))
    )
    # The window needs what the ranges give, so there is no other exchange and the sort stays. The keepers are
    # stored, so that the join below has an exchange on either side that can be split where it is skewed.
    slot = F.pmod(F.xxhash64("doc_id"), F.lit(SLOTS)).cast("int")
    ranged = held.select("a", "b", slot.alias("slot"), "doc_id", "pos").repartitionByRange(ranges, "a", "b", "slot")
    stream = Window.partitionBy("a", "b", "slot").orderBy(F.desc("doc_id"), "pos")
    # A document counts once, however often it holds the line: ranks go by document, in the order that the sort gives.
    by_doc = Window.partitionBy("a", "b", "slot").orderBy(F.desc("doc_id"))
    ends = (
        ranged.withColumn("first", F.first("doc_id").over(stream))
        .withColumn("last", F.lead("doc_id").over(stream).isNull())
        .withColumn("docs", F.dense_rank().over(by_doc))
        .where("last")
    )
    keepers = stored(
        ends.groupBy("a", "b")
        .agg(F.max("first").alias("keeper"), F.sum("docs").alias("n"))
        .where(F.col("n") >= min_docs)
        .select("a", "b", "keeper")
    )
    return stored(
        held.join(keepers, ["a", "b"])
        .where("doc_id < keeper")
        .groupBy("doc_id", "print")
        .agg(F.sort_array(F.collect_set("pos")).alias("lost"))
    )


def line_bitmaps(docs: DataFrame, min_chars: int = 40, min_docs: int = 5) -> DataFrame:
    """Every row with ``n_lines``, ``n_dropped`` and the runs of kept lines (``keep``) beside its columns."""
    own = docs.withColumn("__text", F.coalesce("text", F.lit(""))).withColumn("__print", F.xxhash64("__text"))
    lost = lost_lines(docs, min_chars, min_docs).select(
        F.col("doc_id").alias("__id"), F.col("print").alias("__lost_print"), F.col("lost").alias("__lost")
    )
    n_lines = F.size(F.split("__text", "\n"))
    dropped = F.coalesce("__lost", F.array().cast("array<int>"))
    return (
        own.join(lost, (F.col("doc_id") == F.col("__id")) & (F.col("__print") == F.col("__lost_print")), "left")
        .withColumn("n_lines", n_lines.cast("long"))
        .withColumn("n_dropped", F.size(dropped).cast("long"))
        .withColumn("keep", runs_of(dropped, n_lines).cast(RUNS))
        .drop("__id", "__lost_print", "__lost", "__text", "__print")
    )


def keep_lines(text: Column, keep: Column) -> Column:
    """The kept lines of a text, joined by line ends; the empty text if none is kept."""
    lines = F.split(F.coalesce(text, F.lit("")), "\n")
    kept = F.flatten(F.transform(keep, lambda r: F.slice(lines, r["start"] + 1, r["length"])))
    return F.array_join(kept, "\n")
