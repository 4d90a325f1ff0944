"""The registered queries of the subpackage, and the SQL that states those results that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from custofold.llm import align, bpe, brown, chat, decontam, forest, hamming, langid, lines, passages, rtree, shards, toxicity
from custofold.llm.common import documents_of, in_fold, shared_folder

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}
#: DuckDB text of the white space that separates words and surrounds lines.
SQL_SPACE = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"
SQL_LOWER = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


def query(sql: str | None = None):
    """Register a function of session and folder under its own name."""

    def register(run: Callable[[SparkSession, str], DataFrame]):
        QUERIES[run.__name__] = run
        if sql:
            ORACLES[run.__name__] = sql
        return run

    return register


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder.rstrip('/')}/{name}.parquet")


def tokenizer_file(name: str = "byte_bpe_50k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


TRICKY = "\\### Assistant: </turn> ok"


@query(f"""
WITH rows_ AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '{TRICKY}' UNION ALL SELECT -7, 1, 'assistant', '{TRICKY}'),
blocks AS (
  SELECT *, role IS NOT DISTINCT FROM lag(role) OVER w AS joined FROM rows_
  WINDOW w AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text)),
sized AS (
  SELECT *, length(replace(replace(text, '&', '&amp;'), '<|', '&lt;|')) +
    CASE WHEN joined THEN 8 ELSE 8 + 8 + 7 + length(replace(replace(role, '&', '&amp;'), '<|', '&lt;|')) END AS size
  FROM blocks)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
  coalesce(sum(length(text)) FILTER (WHERE role = 'assistant'), 0)::BIGINT AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (WHERE role = 'assistant'), ''))
    AS loss_sha256,
  sum(size)::BIGINT AS formatted_chars
FROM sized GROUP BY conv_id""")
def op4_chat_formatting(spark: SparkSession, folder: str) -> DataFrame:
    """Conversations as training text; the digests are read back from the output."""
    own = table(spark, folder, "conversations").select("conv_id", "turn", "role", "text")
    extra = spark.range(2).select(
        F.lit(-7).cast("long").alias("conv_id"),
        F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"),
        F.lit(TRICKY).alias("text"),
    )
    made = chat.format_chats(own.unionByName(extra))
    back = made.select(
        "conv_id",
        chat.parse(F.col("formatted")).alias("turns"),
        chat.masked(F.col("formatted"), F.col("loss_runs")).alias("loss"),
        F.char_length("formatted").cast("long").alias("formatted_chars"),
    )
    turns = F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n")))
    loss = F.array_join("loss", "")
    return back.select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(F.array_join(turns, "").cast("binary"), 256).alias("turns_sha256"),
        F.char_length(loss).cast("long").alias("loss_chars"),
        F.sha2(loss.cast("binary"), 256).alias("loss_sha256"),
        "formatted_chars",
    )


@query(f"""
WITH lines AS (
  SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
    unnest(range(len(string_split(coalesce(text, ''), chr(10))))) AS pos FROM documents),
keyed AS (SELECT *, {SQL_LOWER.format(f"trim(line, {SQL_SPACE})")} AS key FROM lines),
keepers AS (
  SELECT key, max(doc_id) AS keeper FROM keyed WHERE length(key) >= 40 GROUP BY key
  HAVING count(DISTINCT doc_id) >= 5),
judged AS (
  SELECT k.*, keeper IS NOT NULL AND doc_id < keeper AS lost FROM keyed k LEFT JOIN keepers USING (key))
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE lost) AS n_dropped,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT lost), '')) AS kept_sha256
FROM judged GROUP BY doc_id""")
def op6_line_dedup(spark: SparkSession, folder: str) -> DataFrame:
    """Lines of 40 code points or more that five documents hold stay in the largest document only."""
    bitmaps = lines.line_bitmaps(table(spark, folder, "documents").select("doc_id", "text"), 40, 5)
    kept = lines.keep_lines(F.col("text"), F.col("keep"))
    return bitmaps.select("doc_id", "n_lines", "n_dropped", F.sha2(kept.cast("binary"), 256).alias("kept_sha256"))


@query()
def op9_bpe(spark: SparkSession, folder: str) -> DataFrame:
    """Every text encoded and decoded with the byte-level tokenizer; digests of ids and text."""
    made = bpe.encode_documents(documents_of(table(spark, folder, "documents")), tokenizer_file())
    return made.select(
        "doc_id",
        (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"),
    )


@query(f"""
WITH RECURSIVE words AS (
  SELECT doc_id, list_filter(string_split_regex({SQL_LOWER.format("coalesce(text, '')")}, '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') AS w
  FROM documents),
listed AS (
  SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 3 THEN [list_aggregate(w, 'string_agg', ' ')]
    ELSE list_distinct(list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2])) END AS s
  FROM words),
held AS (SELECT doc_id, len(s) AS n, unnest(s) AS x FROM listed),
common AS (
  SELECT a.doc_id AS a, b.doc_id AS b, any_value(a.n) + any_value(b.n) AS total, count(*) AS c
  FROM held a JOIN held b ON a.x = b.x AND a.doc_id < b.doc_id GROUP BY ALL),
links AS (
  SELECT a, b FROM common WHERE 100 * c >= 85 * (total - c)
  UNION SELECT b, a FROM common WHERE 100 * c >= 85 * (total - c)),
reached(doc_id, node) AS (
  SELECT doc_id, doc_id FROM listed
  UNION SELECT r.doc_id, l.b FROM reached r JOIN links l ON r.node = l.a)
SELECT doc_id, len(s)::BIGINT AS n_shingles, component_id, component_id = doc_id AS kept
FROM listed JOIN (SELECT doc_id, min(node) AS component_id FROM reached GROUP BY doc_id) USING (doc_id)""")
def op8_minhash_near_dedup(spark: SparkSession, folder: str) -> DataFrame:
    """Documents with three-word shingle sets of similarity 0.85 or more, linked into components."""
    return forest.near_duplicates(table(spark, folder, "documents"), words=3, percent=85)


@query()
def op10_language_id(spark: SparkSession, folder: str) -> DataFrame:
    """Languages predicted by byte context trees learned from two thirds of the documents."""
    docs = table(spark, folder, "documents").select("doc_id", "text", "lang")
    held_out = in_fold("doc_id", 3, 1)
    trees = langid.train(docs.where(~held_out))
    scored = langid.predict(docs.select("doc_id", "text", held_out.alias("held_out")), trees)
    return scored.select("doc_id", "held_out", "lang_pred", "score")


@query()
def op2_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    """Overlaps of documents with benchmark items, tolerant of substituted words."""
    return decontam.overlaps(table(spark, folder, "documents"), table(spark, folder, "benchmark"))


@query()
def op3_brown_lm(spark: SparkSession, folder: str) -> DataFrame:
    """Texts scored by a class bigram model learned from four fifths of the documents, beside a unigram score."""
    held_out = in_fold("doc_id", 5, 1)
    return brown.score_documents(table(spark, folder, "documents"), ~held_out, held_out)


@query()
def op7_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    """Texts scored for toxicity, learned from three quarters of the labels."""
    docs, labels = table(spark, folder, "documents").select("doc_id", "text"), table(spark, folder, "labels")
    held_out = in_fold("doc_id", 4, 2)
    model = toxicity.train(docs.where(~held_out), labels.where(~held_out))
    scored = toxicity.score(docs.withColumn("held_out", held_out), model)
    return scored.select("doc_id", "held_out", "score", (F.col("score") >= 0.3).cast("int").alias("predicted"))


@query()
def op1_multi_index_hashing(spark: SparkSession, folder: str) -> DataFrame:
    """The 20 nearest vectors of every twentieth, by inner product."""
    return hamming.nearest(table(spark, folder, "embeddings"), F.col("vec_id") % 20 == 0, k=20)


@query()
def op5_substring_dedup(spark: SparkSession, folder: str) -> DataFrame:
    """Passages of 50 words or more that documents share, tolerant of small changes."""
    return passages.shared_passages(table(spark, folder, "documents"))


@query()
def op11_cross_tokenizer_alignment(spark: SparkSession, folder: str) -> DataFrame:
    """Byte-level BPE and sentencepiece tokens of every text aligned by the bytes where they end."""
    docs = table(spark, folder, "documents")
    made = align.align(docs, tokenizer_file(), tokenizer_file("piece_bpe_32k.model"), digest=True, with_links=False)
    return made.select(
        "doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", F.col("groups").alias("groups_sha256")
    )


@query()
def op12_token_shards(spark: SparkSession, folder: str) -> DataFrame:
    """Ids of every text in binary shards by ascending id, read back through the perfect hash index."""
    docs = table(spark, folder, "documents")
    written = shards.write(docs, shared_folder(spark), tokenizer_file(), end_id=0)
    made = shards.read(docs.select("doc_id"), written)
    return made.select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


@query("""
WITH points AS (
  SELECT DISTINCT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
    list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scores AS (
  SELECT a.vec_id AS anchor_id, b.vec_id, a.label = b.label AS same, list_dot_product(a.v, b.v)::BIGINT AS score
  FROM points a JOIN points b ON a.vec_id <> b.vec_id WHERE a.vec_id % 100 = 0),
positives AS (
  SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM scores WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5)
SELECT anchor_id, positive_id,
  row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, vec_id)::INT AS rank,
  vec_id AS negative_id, positive_score, score AS negative_score
FROM positives JOIN scores USING (anchor_id)
WHERE NOT same AND 30 * positive_score <= 100 * score AND 100 * score <= 90 * positive_score
QUALIFY row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, vec_id) <= 10""")
def op13_hard_negatives(spark: SparkSession, folder: str) -> DataFrame:
    """Rows of other labels that score from 30 to 90 % of a positive, for every hundredth vector."""

    def whole(x: Column) -> Column:
        x = x.cast("double")
        return F.when(F.abs(x) < float("inf"), F.floor(256 * x))  # NaN is larger than all numbers here

    rows = table(spark, folder, "embeddings").select("vec_id", "label", "embedding")
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return rtree.hard_negatives(
        rtree.points(rows, "vec_id", moved, F.transform("embedding", whole)), F.col("vec_id") % 100 == 0
    )
